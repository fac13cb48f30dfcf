"""URL rules as one bit-parallel automaton over canonical URLs.

A canonical URL is the lower-cased host followed by the path. Rules are globs over it: ``*`` stands for any
characters but ``/``, ``**`` for any characters. All globs are packed side by side into the bits of a row of
64-bit words: one bit for the start and one for each plain character of a glob. Reading a character
moves every active bit one place on, where the next position's mask has the character (Shift-And), and
keeps bits that have a star behind them. The carry of the shift runs from word to word; it cannot leak
into the next glob, since a start bit matches no character. All URLs of a batch advance together, and all
globs at once, so the cost is one pass over the characters times the number of words.

Two rule sets run in the same automaton: host-and-path rules, of which the longest that fits decides, and
the general globs, which decide where no such rule fits.

Defined results: a URL that is null or has no ``://`` has an empty host and path, fits no rule and is
allowed; an empty host fits no rule, but its path may fit a glob; an empty path fits no rule, since rule paths
begin with ``/``; URLs of any length are read whole; equal rows are judged alike; an empty table gives an empty
result; other columns pass through, but for those called like a result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from .staging import slices

# Fixed values of the contract: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Globs for URLs that no rule covers: hosts and paths of spam, gambling and adult sites.
BLOCKED = (
    "*casino*/**",
    "*casino*",
    "*adult*/**",
    "*adult*",
    "*porn*/**",
    "*porn*",
    "*xxx*/**",
    "*xxx*",
    "*-bets*/**",
    "*-bets*",
    "*betting*/**",
    "*betting*",
    "*pills*/**",
    "*pills*",
    "*viagra*/**",
    "*viagra*",
    "**/wp-login*",
    "**/cgi-bin/**",
    "**.exe",
)
#: Bytes of the padded character matrix of a batch.
MATRIX_BYTES = 8 << 20


class GlobSet:
    """Globs packed into words; ``match`` tells for each text which of them fit it whole."""

    def __init__(self, globs: Sequence[str]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        chars: list[tuple[int, int]] = []
        stars: list[tuple[int, bool]] = []
        at = 0
        for glob in globs:
            raw = glob.encode()
            self.starts.append(at)
            k = 0
            while k < len(raw):
                if raw[k] == ord("*"):
                    wide = raw[k : k + 2] == b"**"
                    stars.append((at, wide))
                    k += 1 + wide
                else:
                    at += 1
                    chars.append((at, raw[k]))
                    k += 1
            self.ends.append(at)
            at += 1
        self.words = max(1, -(-at // 64))
        self.step = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        for bit, char in chars:
            self.step[char, bit >> 6] |= np.uint64(1 << (bit & 63))
        for bit, wide in stars:
            self.stay[:, bit >> 6] |= np.uint64(1 << (bit & 63))
            if not wide and not any(b == bit and w for b, w in stars):
                self.stay[ord("/"), bit >> 6] &= np.uint64(~(1 << (bit & 63)) & (1 << 64) - 1)
        self.initial = np.zeros(self.words, np.uint64)
        for bit in self.starts:
            self.initial[bit >> 6] |= np.uint64(1 << (bit & 63))

    def match(self, texts: Sequence[bytes]) -> np.ndarray:
        """A boolean for each text and glob."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-lengths, kind="stable")
        out = np.zeros((len(texts), len(self.ends)), bool)
        at = 0
        while at < len(order):
            longest = max(1, int(lengths[order[at]]))
            chunk = order[at : at + max(1, MATRIX_BYTES // longest)]
            out[chunk] = self._advance([texts[i] for i in chunk], lengths[chunk])
            at += len(chunk)
        return out

    def _advance(self, texts: list[bytes], lengths: np.ndarray) -> np.ndarray:
        """``match`` for texts in order of falling length; those that have ended drop out at the back."""
        longest = int(lengths[0])
        # one row for each place in the text, so that a step reads consecutive bytes
        matrix = np.frombuffer(b"".join(t.ljust(longest, b"\0") for t in texts), np.uint8)
        matrix = np.ascontiguousarray(matrix.reshape(len(texts), longest).T) if longest else None
        active = np.tile(self.initial, (len(texts), 1))
        alive = np.searchsorted(-lengths, -np.arange(longest), side="left")
        one, top = np.uint64(1), np.uint64(63)
        for k in range(longest):
            n = alive[k]
            chars, state = matrix[k, :n], active[:n]
            moved = state << one
            moved[:, 1:] |= state[:, :-1] >> top
            active[:n] = (moved & self.step[chars]) | (state & self.stay[chars])
        bits = np.array(self.ends)
        return (active[:, bits >> 6] >> (bits & 63).astype(np.uint64)) & one != 0


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host with A-Z lower-cased and path of a URL; both empty without ``://``."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [k for k in map(rest.find, "/?#") if k >= 0]
    cut = min(ends, default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    path = tail.split("#", 1)[0].split("?", 1)[0] if tail.startswith("/") else ""
    return host.translate(_LOWER), path


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def judged(
    pages: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    blocked: Sequence[str] = BLOCKED,
) -> DataFrame:
    """``pages`` and its ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``."""
    made = ("host", "path", "rule", "verdict")
    kept = [c for c in pages.columns if c not in made]
    schema = StructType([pages.schema[c] for c in kept] + [StructField(c, StringType()) for c in made])
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    globs = [g for _, host, path in ranked for g in (f"{host}{path}**", f"*.{host}{path}**")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = GlobSet([*globs, *blocked])
        for batch in slices(batches):
            parts = [host_and_path(u.as_py()) for u in batch.column(url)]
            fits = automaton.match([(h + p).encode() for h, p in parts])
            by_rule = fits[:, : len(globs)].reshape(len(parts), len(ranked), 2).any(axis=2)
            bad = fits[:, len(globs) :].any(axis=1)
            names, verdicts = [], []
            for row, (host, path) in enumerate(parts):
                first = int(by_rule[row].argmax()) if len(ranked) and path and by_rule[row].any() else None
                if first is None:
                    names.append(None)
                    verdicts.append("block" if bad[row] else "allow")
                else:
                    verdict, rule_host, rule_path = ranked[first]
                    names.append(rule_host + rule_path)
                    verdicts.append(verdict)
            text = pa.string()
            new = [pa.array([h for h, _ in parts], text), pa.array([p for _, p in parts], text)]
            new += [pa.array(names, text), pa.array(verdicts, text)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *new], names=[*kept, *made])

    return pages.mapInArrow(run, schema)
