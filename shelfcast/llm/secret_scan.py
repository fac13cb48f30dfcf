"""Secrets in texts by assignment-aware lexing.

Three base patterns (assignments to sensitive names, access key ids, long hexadecimal runs) are joined
by a lexer for source and configuration syntax. At every ``=``, ``:``, ``:=``, ``=>``, ``?=`` or
``+=`` it reads the name on the left (quoted keys, dotted and subscripted names, annotated declarations) and the
expression on the right: quoted literals (also in backticks and over several lines), bare values, names, sums of
those, and lists, parentheses and calls of them, however deep. A name on the right stands for the
literals last assigned to it, so a constant is followed to the names that it flows into; a dotted name, or a
word that is written like a name, is never a literal itself. A literal is scored by the most sensitive of its
target names and by its own form (length, mixture of characters, no placeholder); literals that are joined by
``+`` or stand side by side are scored as the one value that they make. Under a clear password name a short
literal or one with blanks is enough. Literals that reach ``THRESHOLD`` are spans of kind ``literal``, unless a
base span holds them already.

Open brackets are kept on a stack and what a bracket holds is remembered by its place, so an assignment within
other assignments' brackets is not read again for each of them: a text of any length and depth is read in
linear time.

Defined results: null and empty texts have no spans; offsets are code points, ends exclusive; equal rows
get equal spans; an empty table gives an empty result; other columns pass through, but for one that is called
like the result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from .staging import slices

# Fixed values of the contract: base patterns and the order of kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # as [0-9a-f]+ with the short runs dropped
KINDS = ("assign", "access", "hex", "literal")
MIN_ASSIGN, MIN_ACCESS = 12, 18

THRESHOLD = 0.5
MIN_LITERAL = 8
MIN_PASSWORD = 6
# Parts of names and how far they mark a value as secret; two or more add up, one at most counts.
SENSITIVE = {
    "password": 1.0,
    "passwd": 1.0,
    "pwd": 0.9,
    "passphrase": 1.0,
    "secret": 1.0,
    "token": 0.9,
    "apikey": 1.0,
    "credential": 0.9,
    "credentials": 0.9,
    "auth": 0.5,
    "authorization": 0.7,
    "bearer": 0.8,
    "key": 0.4,
    "api": 0.4,
    "access": 0.4,
    "private": 0.5,
    "signing": 0.5,
    "encryption": 0.5,
    "client": 0.2,
    "salt": 0.5,
    "webhook": 0.4,
}
# Sensitive words inside a part that neither case nor punctuation divides.
INSIDE = re.compile(
    r"password|passwd|pwd|passphrase|secret(?!ar)|token(?!i[sz])|apikey|credentials?"
    r"|(?:access|private|signing|encryption|client|auth)(?:key|salt)"
)
PAIR = re.compile(r"(.+)(key|salt)")
PASSWORD = re.compile(r"(?i)(?:password|passwd|pwd|passphrase)[_\d]*$")
PLACEHOLDER = re.compile(
    r"(?i)example|change.?me|your[_-]|placeholder|dummy|redacted|^(?:true|false|none|null|undefined)$|^(.)\1*$|\$\{|<[^>]*>"
)
OPERATOR = re.compile(r":=|=>|[?+]=|[=:]")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
LEFT = re.compile(r"""[A-Za-z0-9_.$\-"'\[\] \t]""")
NAME = re.compile(r"""(?:^|[^A-Za-z0-9_.$\-])\$?([A-Za-z_][A-Za-z0-9_.$\-]*)(?:\[?["']([A-Za-z0-9_.\-]+)["']\]?)?["']?[ \t]*$""")
KEY = re.compile(r"[A-Za-z0-9_.\-]+")
VALUE = re.compile(
    r'''[ \t]*(?:[rbuf]{0,2}(?:"""((?:[^"\\]++|\\.|"(?!""))*+)"""|\'{3}((?:[^'\\]++|\\.|'(?!''))*+)\'{3}'''
    r"""|"(?!"")((?:[^"\\\n]|\\.)*)"|'(?!'')((?:[^'\\\n]|\\.)*)')|`((?:[^`\\]++|\\.)*+)`|([A-Za-z0-9+/_.=\-]+))""",
    re.IGNORECASE | re.DOTALL,
)
TRIPLE, QUOTED, BARE = (1, 2, 5), (1, 2, 3, 4, 5), 6
OPENER = re.compile(r"\s*(?:new[ \t]+)?(?:([A-Za-z_][A-Za-z0-9_.]*)?\(|\[)")
LOOKUP = re.compile(r"(?i)(?:getenv|get|env|getproperty|environ|config|input|prompt|open)$")
ARGUMENT = re.compile(r"\s*[A-Za-z_][A-Za-z0-9_]*[ \t]*=(?!=)")
WITHIN = re.compile(r"\s*")
CLOSER = re.compile(r"\s*[\])]")
PLUS = re.compile(r"[ \t]*\+")
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*$")
# A word that is written like a name: dotted, or in parts of letters; but not a signed token of three encoded parts.
REFERENCE = re.compile(r"(?!eyJ[\w-]+\.[\w-]+\.)[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)+$|[A-Za-z]+(?:_[A-Za-z]+)+$")


def name_score(name: str) -> float:
    listed = [p.lower() for p in PARTS.findall(name)]
    parts, joined = {*listed}, {a + b for a, b in zip(listed, listed[1:], strict=False)}
    return min(1.0, sum(SENSITIVE.get(p, 0.0) for p in parts | joined) + sum(map(_inside_score, parts - {*SENSITIVE})))


def _inside_score(part: str) -> float:
    """The sensitive words inside an unknown part."""
    score = 0.0
    for word in set(INSIDE.findall(part)):
        pair = None if word in SENSITIVE else PAIR.fullmatch(word)
        score += SENSITIVE[pair[1]] + SENSITIVE[pair[2]] if pair else SENSITIVE[word]
    return score


def password_score(value: str, quoted: bool) -> float:
    """1 for what can be a password under a name that says so, else 0.

    Bare values must mix letters and digits, and values with blanks hold a digit or a sign, since prose seldom does.
    """
    if len(value) < MIN_PASSWORD or len(set(value)) < 3 or PLACEHOLDER.search(value):
        return 0.0
    if IDENTIFIER.match(value) and name_score(value) > 0:
        return 0.0
    digit, sign = any(c.isdigit() for c in value), any(not (c.isalnum() or c.isspace()) for c in value)
    if not quoted:
        return float(digit and any(c.isalpha() for c in value) and not any(c.isspace() for c in value))
    return float(digit or sign or not any(c.isspace() for c in value))


def literal_score(value: str) -> float:
    """How far a literal looks generated: length, entropy and mixture of characters, from 0 to 1."""
    if len(value) < MIN_LITERAL or PLACEHOLDER.search(value) or any(c.isspace() for c in value):
        return 0.0
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    mixed = (any(c.isdigit() for c in value) + any(c.isalpha() for c in value) + any(not c.isalnum() for c in value)) / 2
    return min(1.0, len(value) / 16) * min(1.0, entropy / 3.0) * min(1.0, mixed)


def _target(text: str, at: int) -> str | None:
    """The name that the operator at ``at`` assigns to."""
    start = at
    while start > 0 and LEFT.match(text, start - 1):
        start -= 1
    left = text[start:at]
    key = _quoted_key(left)
    if key:
        return key
    name = NAME.search(left)
    if not name:
        return None
    # in "name: type = value" the operator's neighbour is the type
    if text[at] == "=" and start > 0 and text[start - 1] == ":":
        before = _target(text, start - 1)
        return before or name[1]
    return name[2] or name[1]


def _quoted_key(left: str) -> str | None:
    """The quoted key that ends a left side, with or without a closing bracket."""
    left = left.rstrip(" \t")
    if left.endswith("]"):
        left = left[:-1].rstrip(" \t")
    if not left or left[-1] not in "\"'":
        return None
    opened = left.rfind(left[-1], 0, len(left) - 1)
    return left[opened + 1 : -1] if opened >= 0 and KEY.fullmatch(left, opened + 1, len(left) - 1) else None


# One value: its pieces as (start, end, text, quoted); several where literals are joined.
Value = list[tuple[int, int, str, bool]]


def _pieces(value: re.Match, group: int) -> list[Value]:
    """The value of a match; of a string over several lines each line, without its blanks, is a value."""
    whole, start = value[group], value.start(group)
    if group not in TRIPLE or "\n" not in whole:
        return [[(start, value.end(group), whole, group != BARE)]]
    out = []
    for line in whole.split("\n"):
        if inner := line.strip():
            first = start + line.index(inner)
            out.append([(first, first + len(inner), inner, False)])
        start += len(line) + 1
    return out


class _Nodes:
    """What was read so far: nodes with their values and the nodes that flow into them, names, brackets."""

    def __init__(self) -> None:
        self.values: list[list[Value]] = []
        self.sources: list[list[int]] = []
        self.known: dict[str, int] = {}
        #: By the place behind an opening bracket: its node, the place behind it, whether it was closed.
        self.brackets: dict[int, tuple[int, int, bool]] = {}

    def add(self, values: list[Value], sources: list[int]) -> int:
        self.values.append(values)
        self.sources.append(sources)
        return len(self.values) - 1


def _expression(text: str, at: int, nodes: _Nodes) -> tuple[list[Value], list[int]]:
    """The values of the expression at ``at``, and the nodes of its names and brackets.

    What is given to a look-up is the name of a setting and no literal.
    """
    values: list[Value] = []
    sources: list[int] = []
    outer: list[tuple[int, list[Value], list[int]]] = []
    join = False  # the next literal goes on with the last value

    def left(closed: bool) -> None:
        """Leave the innermost bracket: it becomes a node of the one around it."""
        nonlocal values, sources
        place, around, others = outer.pop()
        node = nodes.add(values, sources)
        nodes.brackets[place] = (node, at, closed)
        values, sources = around, [*others, node]

    def ended() -> tuple[list[Value], list[int]]:
        while outer:
            left(False)
        return values, sources

    while True:
        read = False
        while (opener := OPENER.match(text, at)) and (outer or "\n" not in opener[0]):
            if opener[1] and LOOKUP.search(opener[1]):
                return ended()
            at = opener.end()
            if at in nodes.brackets:
                node, at, closed = nodes.brackets[at]
                sources.append(node)
                if not closed:
                    return ended()
                read = True
                break
            outer.append((at, values, sources))
            values, sources, join = [], [], False
        value, group = None, 0
        if not read:
            if outer:
                if argument := ARGUMENT.match(text, at):
                    at, join = argument.end(), False
                    if OPENER.match(text, at):
                        continue
                at = WITHIN.match(text, at).end()
            value = VALUE.match(text, at)
        if value:
            group = next(g for g in (*QUOTED, BARE) if value[g] is not None)
            word = value[group]
            if group == BARE and IDENTIFIER.match(word) and word in nodes.known:
                sources.append(nodes.known[word])
            elif word and not (group == BARE and (outer or REFERENCE.match(word))):
                found = _pieces(value, group)
                if join and values and len(found) == 1:
                    values[-1] = values[-1] + found[0]
                else:
                    values += found
            at = value.end()
        closed = read
        while outer and (closer := CLOSER.match(text, at)):
            at = closer.end()
            left(True)
            closed = True
        if not value and not closed:
            return ended()
        joinable = bool(value) and group in QUOTED and not closed
        if plus := PLUS.match(text, at):
            at, join = plus.end(), joinable
            continue
        after = WITHIN.match(text, at).end() if outer else at
        if outer and text[after : after + 1] == ",":
            at, join = after + 1, False
        elif outer and group in QUOTED and text[after : after + 1] in ('"', "'", "`"):
            join = joinable
        else:
            return ended()


def scored_literals(text: str) -> Iterator[tuple[int, int, float]]:
    """(start, end, score) of the literals that are assigned, constants followed to all their targets.

    Every assignment is a node that knows its literals and, for each name on its right, the node which
    that name stood for. Read backwards, the sensitivity of targets flows to what they were made of, so
    the work is linear in the text however constants are chained.
    """
    nodes = _Nodes()
    flow: list[float] = []
    clear: list[bool] = []
    for operator in OPERATOR.finditer(text):
        at, end = operator.span()
        readable = VALUE.match(text, end) or OPENER.match(text, end)
        name = _target(text, at) if readable else None
        if not name:
            continue
        values, sources = _expression(text, end, nodes)
        if operator[0] == "+=" and name in nodes.known:
            sources.append(nodes.known[name])
        nodes.known[name] = nodes.add(values, sources)
        flow += [0.0] * (len(nodes.values) - len(flow))
        clear += [False] * (len(nodes.values) - len(clear))
        flow[-1], clear[-1] = name_score(name), bool(PASSWORD.search(name))
    # a node is made after all that flow into it
    for node in range(len(flow) - 1, -1, -1):
        for source in nodes.sources[node]:
            flow[source] = max(flow[source], flow[node])
            clear[source] |= clear[node]
        if flow[node]:
            for value in nodes.values[node]:
                whole, quoted = "".join(v[2] for v in value), value[0][3]
                score = flow[node] * literal_score(whole)
                if clear[node] and score < THRESHOLD:
                    score = max(score, THRESHOLD * password_score(whole, quoted))
                for start, end, _, _ in value:
                    yield start, end, score


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, start of the secret itself), each kind leftmost and not overlapping."""
    found = [(0, *m.span(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(1, *m.span(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [(2, *m.span(), m.start()) for m in HEX.finditer(text)]
    return found


def scan(text: str | None) -> list[tuple[int, int, int, int, float]]:
    """(start, kind, end, start of the secret, score) of all spans in order."""
    if not text:
        return []
    base = base_spans(text)
    scores: dict[tuple[int, int], float] = {}
    for start, end, score in scored_literals(text):
        if score >= THRESHOLD:
            scores[start, end] = max(score, scores.get((start, end), 0.0))
    found = [(start, kind, end, secret, 1.0) for kind, start, end, secret in base]
    if scores:
        edges = sorted((start, end) for _, start, end, _ in base)
        reach, starts, ends = 0, [], []
        for start, end in edges:
            reach = max(reach, end)
            starts.append(start)
            ends.append(reach)
        for (start, end), score in scores.items():
            k = bisect_right(starts, start) - 1
            if k < 0 or ends[k] < end:
                found.append((start, 3, end, start, score))
    return sorted(found)


def redact(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with the value of each span replaced by ``mark``."""
    spans = scan(text)
    if not spans:
        return text
    out, at = [], 0
    for start, end in sorted((secret, end) for _, _, end, secret, _ in spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPANS = ArrayType(
    StructType(
        [
            StructField("kind", StringType()),
            StructField("start", IntegerType()),
            StructField("end", IntegerType()),
            StructField("score", DoubleType()),
        ]
    )
)
_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
)


def with_spans(docs: DataFrame, text: str = "text", name: str = "spans") -> DataFrame:
    """``docs`` without the text, and the array of its spans."""
    kept = [c for c in docs.columns if c not in (text, name)]
    schema = StructType([docs.schema[c] for c in kept] + [StructField(name, SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            spans = [
                [{"kind": KINDS[kind], "start": a, "end": b, "score": s} for a, kind, b, _, s in scan(t.as_py())]
                for t in batch.column(text)
            ]
            columns = [batch.column(c) for c in kept] + [pa.array(spans, _ARROW)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, name])

    return docs.select(*kept, text).mapInArrow(run, schema)


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with secrets replaced in the text; ``n_chars``, where present, follows the new text."""
    columns, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            place = columns.index(text)
            old = batch.column(place).to_pylist()
            new = [redact(t) for t in old]
            if "n_chars" in columns:
                at = columns.index("n_chars")
                sizes = batch.column(at).to_pylist()
                sizes = [n if a == b else len(b) for a, b, n in zip(old, new, sizes, strict=True)]
                batch = batch.set_column(at, "n_chars", pa.array(sizes, batch.schema.field(at).type))
            yield batch.set_column(place, text, pa.array(new, batch.schema.field(place).type))

    return docs.mapInArrow(run, schema)


def joined(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of some kinds, comma-joined."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
