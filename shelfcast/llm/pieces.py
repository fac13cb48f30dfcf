"""Encoding and decoding with a merge-type piece model, by the last piece of every prefix.

The merges of such a model leave exactly one last piece for each prefix of a text. A piece that ends at a
position is that last piece if the last piece of the prefix before it may stand next to it, that is, if
merging the two pieces' characters gives the two pieces again. All pieces that end at a position come
from one Aho-Corasick automaton; the answers for pairs are kept. From the last piece of the whole text
the ids are read off backwards. Nothing is ever merged over the whole text, so work is linear in it.

No piece has a word mark behind another character, and characters outside the vocabulary never merge.
Texts are therefore cut before word marks and around line ends (both are checked on loading), and the
ids of a chunk are kept for the next time that it occurs.

Defined results: null is treated as the empty text, which has only the begin and end ids; characters
outside the vocabulary become byte pieces; equal rows get equal ids; texts of any length are encoded whole; an
empty table gives an empty result; other columns pass through, but for those called like a result. A model that
normalises its texts is refused on loading.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .staging import slices

MARK = "▁"
#: What a normaliser would change: widths, ligatures, accents, runs of blanks, line ends, control characters.
NORMAL = ("", "a b", " a  b ", "Ａｂ ﬁ ² ½ e\u0301 é", "a\tb\r\nc\u200b\u00a0d\u3000", "x\u0001\ufeffy", "İ ß ſ")
KEPT_CHUNKS = 500_000
KEPT_PAIRS = 1_000_000
KEPT_LENGTH = 64
PUNCTUATION = frozenset(".,;:!?)]}|\"'")
OUTPUT_BYTES = 8 << 20


class PieceModel:
    """The vocabulary of a model file and the tables of this method. Only reading it uses the library."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        # the texts go to the pieces as they are, with blanks as marks and one mark in front
        if any(model.normalize(t) != (MARK + t.replace(" ", MARK) if t else "") for t in NORMAL):
            raise ValueError("a model that normalises its texts needs that done first")
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        self.text_of: list[str] = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.id_of: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_id: dict[int, int] = {}
        self.byte_of: dict[int, int] = {}
        self.silent = {self.begin, self.end}
        self.automaton = ahocorasick.Automaton()
        for i, piece in enumerate(self.text_of):
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.byte_of[i] = int(piece[3:5], 16)
            elif model.is_control(i):
                self.silent.add(i)
            elif not model.is_unknown(i):
                self.id_of[piece] = i
                self.score[piece] = model.get_score(i)
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.length = [len(p) for p in self.text_of]
        self.plain = [p.replace(MARK, " ") if p in self.id_of else None for p in self.text_of]
        self.inside = {p[k : k + 2] for p in self.id_of for k in range(len(p) - 1)}
        inner = any(MARK in p.lstrip(MARK) for p in self.id_of)
        single = all(c in self.id_of for p in self.id_of for c in p)
        if not single:
            raise ValueError("every character of a piece must be a piece")
        ends = "" if "\n" in self.id_of else r"\n"
        self.chunk = re.compile(r"(?s).+" if inner else rf"{MARK}*[^{MARK}{ends}]+|{MARK}+" + (r"|\n+" if ends else ""))
        self.alone: dict[int, bool] = {}
        self.pairs: dict[int, bool] = {}
        self.chunks: dict[str, tuple[bytes, str]] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging itself: best score first, leftmost among equals."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stands_alone(self, piece: int) -> bool:
        """Whether merging a piece's characters gives the piece."""
        known = self.alone.get(piece)
        if known is None:
            known = self.alone[piece] = self.merged(self.text_of[piece]) == [self.text_of[piece]]
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether two pieces may stand next to each other. Unknown characters (-1) stop all merging."""
        if left < 0:
            return self.stands_alone(right)
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            a, b = self.text_of[left], self.text_of[right]
            known = self.merged(a + b) == [a, b]
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def last_pieces(self, text: str) -> list[int]:
        """For each prefix but the empty one its unique last piece; -1 after an unknown character."""
        last = [-1] * (len(text) + 1)
        done, known = -1, self.pairs.get
        for at, (piece, length) in self.automaton.iter(text):
            if at == done:
                continue
            start = at + 1 - length
            left = last[start] if start else -1
            fits = self.stands_alone(piece) if left < 0 else known(left << 32 | piece)
            if fits is None:
                fits = self.compatible(left, piece)
            if fits:
                last[at + 1] = piece
                done = at
        return last

    def encode_chunk(self, text: str) -> list[int]:
        last, ids, at = self.last_pieces(text), [], len(text)
        while at:
            piece = last[at]
            if piece < 0:
                at -= 1
                raw = text[at].encode()
                ids += [self.byte_id[b] for b in reversed(raw)] if self.byte_id else [self.unknown]
            else:
                ids.append(piece)
                at -= self.length[piece]
        ids.reverse()
        return ids

    def _chunk(self, text: str) -> tuple[bytes, str]:
        known = self.chunks.get(text)
        if known is None:
            if len(text) > 1 and text[-1] in PUNCTUATION and text[-2:] not in self.inside:
                # no piece joins these two characters: the word in front may be known already
                a, b = self._chunk(text[:-1]), self._chunk(text[-1])
                return a[0] + b[0], a[1] + b[1]
            ids = self.encode_chunk(text)
            known = struct.pack(f"<{len(ids)}I", *ids), self._decode(ids)
            if len(text) <= KEPT_LENGTH:
                if len(self.chunks) >= KEPT_CHUNKS:
                    self.chunks.clear()
                self.chunks[text] = known
        return known

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """Ids with begin and end as little-endian 32-bit integers, and the text decoded from them."""
        edges = (np.array([i], "<u4").tobytes() for i in (self.begin, self.end))
        begin, end = edges
        if not text:
            return begin + end, ""
        parts = [self._chunk(c) for c in self.chunk.findall(MARK + text.replace(" ", MARK))]
        return b"".join([begin, *[p[0] for p in parts], end]), "".join([p[1] for p in parts])[1:]

    def _decode(self, ids: list[int]) -> str:
        parts = [self.plain[i] for i in ids]
        if None not in parts:
            return "".join(parts)
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            byte = self.byte_of.get(i)
            if byte is not None:
                raw.append(byte)
                continue
            if raw:
                out.append(_text_of_bytes(bytes(raw)))
                raw.clear()
            if i in self.silent:
                continue
            out.append(" ⁇ " if i == self.unknown else self.text_of[i].replace(MARK, " "))
        if raw:
            out.append(_text_of_bytes(bytes(raw)))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space that encoding put in front is taken away."""
        text = self._decode(ids)
        first = next((i for i in ids if i not in self.silent), None)
        marked = first is not None and first not in self.byte_of and self.text_of[first].startswith(MARK)
        return text[1:] if marked else text


def _text_of_bytes(raw: bytes) -> str:
    """UTF-8, with a replacement character for each byte that is not part of a character."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for size in (1, 2, 3, 4):
                try:
                    out.append(raw[at : at + size].decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


def encoded(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", count: str = "n_tokens", decoded: str = "decoded"
) -> DataFrame:
    """``docs`` without the text; its ids (little-endian 32-bit), their number and the decoded text."""
    kept = [c for c in docs.columns if c not in (text, ids, count, decoded)]
    made = [StructField(count, LongType()), StructField(ids, BinaryType()), StructField(decoded, StringType())]
    schema = StructType([docs.schema[c] for c in kept] + made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in slices(batches):
            model = model or PieceModel(path)
            start, size, out = 0, 0, []

            def packed(start: int, out: list[tuple[bytes, str]], batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                part = batch.slice(start, len(out))
                numbers = pa.array([len(raw) // 4 for raw, _ in out], pa.int64())
                raws, texts = pa.array([r for r, _ in out], pa.binary()), pa.array([t for _, t in out], pa.string())
                columns = [*[part.column(c) for c in kept], numbers, raws, texts]
                return pa.RecordBatch.from_arrays(columns, names=[*kept, count, ids, decoded])

            for row, value in enumerate(batch.column(text)):
                out.append(model.encode(value.as_py()))
                size += len(out[-1][0]) + len(out[-1][1])
                if size > OUTPUT_BYTES:
                    yield packed(start, out)
                    start, size, out = row + 1, 0, []
            if out:
                yield packed(start, out)

    return docs.select(*kept, text).mapInArrow(run, schema)
