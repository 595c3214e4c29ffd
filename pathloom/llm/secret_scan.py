"""Secret scan: fixed patterns plus assignment-aware lexing.

Patterns give the base spans. Texts that name something sensitive are then
lexed: strings, names, assignment signs and line ends of source and
configuration syntax become name-literal pairs (``name = "…"``, ``name: …``,
``{"name": "…"}``, ``name = other + "…"``, ``f(name="…")``, ``name = f("…")``), with
plain, triple-quoted and prefixed strings. A value without quotes runs up to white
space, a comma, a bracket or a quote. The lexer goes through a text once, in time
linear in its length, whatever its quotes and escapes. Names bound to literals are
propagated as constants, in either order and through concatenations, and each
pair whose target name is sensitive is scored by that name and by how random
its literal is. Literals that score enough are spans of kind ``lexed``, unless
base spans already cover all of them.

Defined cases: null text is empty, with zero spans; spans are in code points,
end exclusive; repeated rows are scanned each; an empty table gives an empty
result; a cyclic constant resolves to nothing; other columns are ignored by
``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.llm.common import in_parts, texts_of

# The base patterns, in the order in which kinds sort.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "lexed")

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(ACCESS)
_HEX = re.compile(HEX[:-1] + "{%d,}" % LEAST["hex"])  # a run is greedy, so its long matches are the same
#: Which texts can have a span of a kind at all; run over whole columns at once.
_MAY = {"assign": r"(?i)password|passwd|secret|token|api_?key", "access": "AKIA[A-Z0-9]", "hex": HEX[:-1] + "{%d}" % LEAST["hex"], "lexed": r"(?i)pass|pwd|secret|token|key|credential|auth"}

#: Weight of a target name's word; a pair counts from THRESHOLD on.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "secret": 1.0, "token": 0.9, "credential": 0.9, "credentials": 0.9, "apikey": 1.0, "auth": 0.7, "key": 0.5}
#: Words that tell a name also where they end a longer one, as in dbpwd.
RUN_TOGETHER = ("password", "passwd", "passphrase", "pwd", "secret", "token", "apikey")
STRONGER = {"api", "access", "private", "secret", "client", "signing", "encryption", "auth"}
THRESHOLD = 0.6
_PLACEHOLDER = re.compile(
    r"(?i)\A(?:\$\{.*\}|\$[a-z_]\w*|<.*>|%\(.*\)s|\{\{.*\}\}|change_?me.*|example.*|your[_-].*|none|null|true|false|x+|\*+|\.+"
    r"|[a-z][a-z0-9+.-]*://[^@\s]*|[.~]?(?:/[\w.-]+)+/?)\Z"  # addresses without a user, and paths
)
_NAME = r"[^\W\d][\w.-]*"
#: An apostrophe within a word opens nothing.
_QUOTE = r"(?:(?:(?<!\w)[rRbBuUfF]{1,2})?\"|(?<!\w)[rRbBuUfF]{0,2}')"
_LEX = re.compile(rf"(?P<quote>{_QUOTE})|(?P<op>:=|=>|==|[=:])|(?P<plus>\+)|(?P<end>[\n;,{{}}()\[\]])|(?P<name>{_NAME})|(?P<bare>[^\s\"'=:+;,{{}}()\[\]]++)")
#: A value without quotes ends at white space, a comma, a bracket or a quote; at a semicolon only if a line's end or the next pair follows.
_VALUE = re.compile(r"[ \t(]*+(?:(?P<quoted>" + _QUOTE + r")|(?P<run>(?:[^\s,;(){}\[\]\"']|;(?!\s|\Z|[\w .-]{1,64}=))++))")
_OF_CHAIN = re.compile(rf"({_NAME})(?::=|=>|=|:)\Z")
_ONLY_NAME = re.compile(rf"{_NAME}\Z")
_CLOSED = {q: re.compile(rf"(?:[^{q}\\\n]++|\\.)*+{q}") for q in "\"'"}
_TRIPLE = {q: re.compile(rf"(?:[^{q}\\]++|\\.|{q}(?!{q}{q}))*+{q}{q}{q}", re.DOTALL) for q in "\"'"}
_ARGUMENT = re.compile(rf"\(\s*+(?:{_NAME}\s*+=\s*+)?(?={_QUOTE})")
#: Calls whose argument names a secret and is none itself.
_LOOKUP = re.compile(r"(?i)env|get|input|read|find|load|config|lookup|prompt|param")
_REPEATED = re.compile(r"(?i)\A(?:x+|\*+|\.+)\Z")
#: Characters at either end of a literal that tell a placeholder.
ENDS = 64
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def name_score(name: str) -> float:
    """How sensitive a target name is, from its words (snake, kebab, dotted or camel case)."""
    words = [w.lower() for w in _WORD.findall(name)]
    joined = {a + b for a, b in zip(words, words[1:], strict=False)}
    ends = [SENSITIVE[x] for w in words for x in RUN_TOGETHER if w.endswith(x)]
    score = max([*(SENSITIVE.get(w, 0.0) for w in [*words, *joined]), *ends], default=0.0)
    return min(1.0, score + 0.4) if score and STRONGER & set(words[:-1]) else score


class Value:
    """What the score needs of a literal or of a concatenation, however long: its length, its characters and its ends."""

    __slots__ = ("n", "chars", "head", "tail")

    def __init__(self, text: str = ""):
        self.n, self.chars, self.head, self.tail = len(text), Counter(text), text[:ENDS], text[-ENDS:]

    def add(self, other: Value) -> None:
        if self.n < ENDS:
            self.head = (self.head + other.head)[:ENDS]
        self.tail = (self.tail + other.tail)[-ENDS:]
        self.n += other.n
        self.chars.update(other.chars)

    def placeholder(self) -> bool:
        if self.n <= ENDS:
            return bool(_PLACEHOLDER.match(self.head))
        # longer ones are told by their ends, but for those of one repeated character
        return bool(_PLACEHOLDER.match(self.head + self.tail)) and not (_REPEATED.match(self.head) and len({c.lower() for c in self.chars}) > 1)

    def score(self) -> float:
        if self.n < 8 or self.placeholder() or any(c.isspace() for c in self.chars):
            return 0.0
        n = self.n
        entropy = -sum(c / n * math.log2(c / n) for c in self.chars.values())
        classes = sum(any(f(c) for c in self.chars) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
        return min(1.0, entropy / math.log2(min(n, 64)) * (0.7 + 0.15 * classes))


def value_score(value: str) -> float:
    """How random a literal is: its entropy against a random one's of that length, placeholders and short ones none."""
    return Value(value).score()


class _Strings:
    """Where string literals of a text end. Each character is looked at a bounded number of times.

    A quote that nothing closes on its line is no string, and then no other of its kind on that line is tried; a triple quote
    that nothing closes is none, and then no other of its kind in the text is tried.
    """

    def __init__(self, text: str):
        self.text, self.dead, self.no_triple = text, {'"': -1, "'": -1}, set()

    def at(self, m: re.Match, group: str) -> tuple[int, int, int] | None:
        """(start, end, where to go on) of the literal whose opening quote ``m`` has matched, without quotes, or None."""
        q, start = m[group][-1], m.end(group)
        if self.text.startswith(q * 2, start) and q not in self.no_triple:
            if closed := _TRIPLE[q].match(self.text, start + 2):
                return start + 2, closed.end() - 3, closed.end()
            self.no_triple.add(q)
        if start <= self.dead[q]:
            return None
        if closed := _CLOSED[q].match(self.text, start):
            return start, closed.end() - 1, closed.end()
        line = self.text.find("\n", start)
        self.dead[q] = len(self.text) if line < 0 else line
        return None


Operand = tuple[str, str, int, int]


def pairs(text: str) -> list[tuple[str, list[Operand]]]:
    """Name-literal pairs: a target name, and the operands bound to it as (kind, value, start, end)."""
    found: list[tuple[str, list[Operand]]] = []
    strings, target, operands, last, wants, at = _Strings(text), None, [], None, False, 0

    def shut() -> None:
        nonlocal target, operands, wants
        if target is not None and operands:
            found.append((target, operands))
        target, operands, wants = None, [], False

    while True:
        if wants and (m := _VALUE.match(text, at)):
            wants = False
            if m["quoted"]:
                if literal := strings.at(m, "quoted"):
                    start, end, at = literal
                    operands.append(("string", text[start:end], start, end))
                    last = text[start:end]
                    continue
                at = m.end("quoted")  # nothing closes it: what follows is read as if it stood without quotes
                m = _VALUE.match(text, at)
                if not m or not m["run"]:
                    continue
            value, start, at = m["run"], m.start("run"), m.end("run")
            follows = text[at : at + 1]
            if follows in ("'", '"') and (chain := _OF_CHAIN.match(value)):  # a=b="…"
                operands.append(("name", chain[1], start, start + len(chain[1])))
                shut()
                target, wants = chain[1], True
                continue
            if follows in ("'", '"') and value.endswith("+"):  # a+"…"
                value, wants = value[:-1], True
                if not value:
                    continue
            if follows == "(" and _ONLY_NAME.match(value):  # a call: its one literal, if it has just one
                literal = None
                if (opened := _ARGUMENT.match(text, at)) and not _LOOKUP.search(value):
                    literal = strings.at(_LEX.match(text, opened.end()), "quote")
                if literal and text[literal[2] : literal[2] + ENDS].lstrip().startswith(")"):
                    start, end, at = literal
                    operands.append(("string", text[start:end], start, end))
                last = None
                continue
            operands.append(("name" if _ONLY_NAME.match(value) else "bare", value, start, start + len(value)))
            last = value if _ONLY_NAME.match(value) else None
            continue
        wants = False
        m = _LEX.search(text, at)
        if not m:
            break
        kind, at = m.lastgroup, m.end()
        if kind == "op":
            if m.group() != "==" and last is not None:
                shut()  # of a chain a = b = "…", or the pair before on this line
                target, wants = last, True
        elif kind == "plus":
            wants = target is not None and bool(operands)
        elif kind == "end":
            shut()
            last = None
        else:
            shut()
            if kind == "quote":
                literal = strings.at(m, "quote")
                if literal:
                    at = literal[2]
                last = text[literal[0] : literal[1]] if literal else None
            else:
                last = m.group() if kind == "name" else None
    shut()
    return found


def lexed_spans(text: str) -> list[tuple[int, int]]:
    """Spans of the literals that reach a sensitive name."""
    bound = pairs(text)
    known: dict[str, list] = {}
    for name, operands in bound:
        known.setdefault(name, operands)  # the first binding of a name is its constant
    for _, operands in bound:
        for i in range(len(operands) - 1, -1, -1):  # a+b is a sum if both are constants, else a literal with a plus sign
            kind, value, start, _ = operands[i]
            parts = value.split("+") if kind == "bare" and "+" in value else []
            if parts and all(x in known for x in parts):
                places = [start + len("+".join(parts[:j])) + bool(j) for j in range(len(parts))]
                operands[i : i + 1] = [("name", x, at, at + len(x)) for x, at in zip(parts, places, strict=True)]

    def inner(operands: list) -> list[str]:
        return [value for kind, value, _, _ in operands if kind == "name" and value in known]

    values: dict[str, Value | None] = {}  # each constant once, so that neither depth nor repeats count

    def joined(operands: list) -> Value | None:
        out = Value()
        for kind, value, _, _ in operands:
            part = values[value] if kind == "name" and value in known else Value(value)
            if part is None:
                return None
            out.add(part)
        return out

    def resolve(names: list[str]) -> None:
        open_, stack = set(), [(x, False) for x in names]
        while stack:
            name, done = stack.pop()
            if done:
                open_.discard(name)
                values[name] = None if name in cyclic else joined(known[name])
            elif name not in values and name not in open_:
                open_.add(name)
                stack.append((name, True))
                for x in inner(known[name]):
                    if x in open_:
                        cyclic.add(name)
                    elif x not in values:
                        stack.append((x, False))

    def reached(operands: list, seen: set[str]) -> Iterator[list]:
        """The operands and those of all constants in them that are not in ``seen``."""
        stack = [operands]
        while stack:
            yield (now := stack.pop())
            for x in inner(now):
                if x not in seen:
                    seen.add(x)
                    stack.append(known[x])

    spans, told, cyclic = set(), set(), set()
    for name, operands in bound:
        weight = name_score(name)
        if not weight:
            continue
        resolve(inner(operands))
        if known[name] is operands:
            resolve([name])
        elif name in (x for now in reached(operands, set()) for x in inner(now)):
            continue  # it takes itself in
        value = values[name] if known[name] is operands else joined(operands)
        if value is not None and weight * value.score() >= THRESHOLD:
            for now in reached(operands, told):
                spans |= {(s, e) for kind, x, s, e in now if e > s and not (kind == "name" and x in known)}
    return sorted(spans)


def spans(text: str, may: tuple[bool, bool, bool, bool] = (True, True, True, True)) -> list[tuple[str, int, int]]:
    """All spans of a text as (kind, start, end), base and lexed, in order. ``may`` tells which kinds it can have."""
    base = []
    if may[0]:
        base += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if may[1]:
        base += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    if may[2]:
        base += [("hex", *m.span()) for m in _HEX.finditer(text)]
    more = []
    if may[3]:
        covered: list[list[int]] = []  # the base spans' union, in order
        for a, b in sorted((s, e) for _, s, e in base):
            if covered and a <= covered[-1][1]:
                covered[-1][1] = max(covered[-1][1], b)
            else:
                covered.append([a, b])
        for s, e in lexed_spans(text):
            at = bisect_right(covered, s, key=lambda x: x[0]) - 1
            if at < 0 or covered[at][1] < e:
                more.append(("lexed", s, e))
    return sorted(base + more, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _told(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def _scan_column(column: pa.Array) -> Iterator[tuple[str, list[tuple[str, int, int]]]]:
    may = [pc.fill_null(pc.match_substring_regex(column, _MAY[k]), False).to_pylist() for k in KINDS]
    for text, *which in zip(texts_of(column), *may, strict=True):
        yield text, spans(text, tuple(which)) if any(which) else []


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_lexed long, base_sha256 string, spans string"


def scan(docs: DataFrame, also: str | None = None) -> DataFrame:
    """``docs(doc_id, text)`` → counts, digest of the base spans and all spans, one row per row.

    ``also`` names a second text column, whose spans come as a column ``<also>_spans``.
    """
    schema, more = (f"{SCHEMA}, {also}_spans string", [F.col(also).cast("string")]) if also else (SCHEMA, [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for _, found in _scan_column(b.column(1)):
                n = Counter(k for k, _, _ in found)
                base = _told([x for x in found if x[0] != "lexed"])
                rows.append((n["assign"], n["access"], n["hex"], n["lexed"], hashlib.sha256(base.encode()).hexdigest(), _told(found)))
            kinds = [*[pa.int64()] * 4, pa.string(), pa.string()]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            second = [pa.array([_told(found) for _, found in _scan_column(b.column(2))], pa.string())] if also else []
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)), *second], names=[x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *more).mapInArrow(in_parts(run), schema)


def hide(text: str, found: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with each span, or run of overlapping spans, replaced by ``mark``."""
    out, at, last = [], 0, -1
    for _, s, e in sorted(found, key=lambda x: x[1:]):
        if s >= last:
            out += [text[at:s] if s >= at else "", mark]
        last = at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with secrets in the column ``text`` replaced; ``n_chars``, if there, follows. Null stays null."""
    schema, names = docs.schema, docs.columns
    place, chars = names.index(text), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            changed: dict[int, str] = {}
            for i, (whole, found) in enumerate(_scan_column(b.column(place))):
                if found:
                    changed[i] = hide(whole, found, mark)
            columns = list(b.columns)
            if changed:
                values = columns[place].to_pylist()
                for i, x in changed.items():
                    values[i] = x
                columns[place] = pa.array(values, columns[place].type)
                if chars is not None:
                    values = columns[chars].to_pylist()
                    for i, x in changed.items():
                        values[i] = len(x)
                    columns[chars] = pa.array(values, columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return docs.mapInArrow(in_parts(run), schema)
