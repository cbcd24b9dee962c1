"""Secret scans by assignment-aware lexing.

Three base kinds are found by their patterns. Beside them, a lexer reads a text as source or configuration: names, quoted
and bare literals, and the signs that assign (``=``, ``:``, ``:=``, ``=>``, or an XML-like attribute). It gives name-literal
pairs; a name that was given literals before hands them on when it is assigned to another name, and ``+`` or a mere blank
between quoted literals adds up their parts. A pair's score grows with how sensitive the target's name is and how much its
literals look like random characters; literals that reach the threshold become spans of kind ``literal``.

Defined results: a null text is empty; a text without secrets has counts 0, the SHA-256 of the empty string and empty spans.
Of equal literal spans, one is reported. Spans are in code points, the end exclusive. Repeated rows give repeated rows. An
empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache
from hashlib import sha256
from math import log2
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlake.llm.frames import byte_texts, in_slices, record

# The base kinds in their order, their patterns and least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
KINDS = ("assign", "access", "hex", "literal")
LEAST = {"assign": 6, "access": 20, "hex": 24}
# end of fixed values

_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
#: Bytes of hexadecimal digits become ``x``, all others a blank, so that a long run is easy to see.
_HEX_BYTES = bytes(120 if b in b"0123456789abcdef" else 32 for b in range(256))
_HEX_RUN = b"x" * LEAST["hex"]

# How sensitive a name is, by the words in it: the greatest value counts.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.7, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.8, "credentials": 0.8, "bearer": 0.8, "authorization": 0.7, "auth": 0.6, "signature": 0.5, "salt": 0.5,
    "key": 0.4, "dsn": 0.5,
}
#: Two words that together say more than each alone.
SENSITIVE_PAIRS = {
    ("api", "key"): 1.0, ("access", "key"): 1.0, ("secret", "key"): 1.0, ("private", "key"): 1.0, ("encryption", "key"): 1.0,
    ("signing", "key"): 1.0, ("account", "key"): 0.9, ("master", "key"): 0.9, ("connection", "string"): 0.7,
}
HARMLESS = re.compile(
    r"(?:change_?me|example|sample|placeholder|dummy|redacted|your|my|test|xxx+|none|null|true|false|todo|undefined|\*+|<.*>|\$\{.*\}|%.*%)",
    re.IGNORECASE,
)
THRESHOLD = 0.5

_TOKEN = re.compile(
    r"""(?P<name>[A-Za-z_$][A-Za-z0-9_$]*(?:[.-][A-Za-z0-9_$]+)*)"""
    r"""|(?P<bare>[A-Za-z0-9/_][A-Za-z0-9+/_.=~-]*)"""
    r"""|(?P<sign>:=|=>|==|!=|<=|>=|[=:+])"""
    r"""|(?P<line>\n)|(?P<blank>[ \t\r]+)|(?P<other>.)""",
    re.ASCII | re.DOTALL,
)
#: What stands between a quote and the next of its kind, or the line's end if there is none.
_QUOTED = {
    '"': re.compile(r"""[^"\\\n]*(?:\\.[^"\\\n]*)*""", re.DOTALL),
    "'": re.compile(r"""[^'\\\n]*(?:\\.[^'\\\n]*)*""", re.DOTALL),
    "`": re.compile(r"[^`\n]*"),
}
_BARE = re.compile(r"[A-Za-z0-9+/_.=~!@#%^*?-]+", re.ASCII)
_NAME_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: A keyword before a name is not a value handed on.
_KEYWORDS = {"const", "let", "var", "export", "set", "final", "static", "public", "private", "string", "str", "def", "return", "new"}


class Span(NamedTuple):
    start: int
    order: int
    end: int

    @property
    def text(self) -> str:
        return f"{KINDS[self.order]}:{self.start}:{self.end}"


def base_spans(text: str, raw: bytes) -> list[Span]:
    """The base kinds' matches, leftmost and not overlapping within a kind; ``raw`` is the text's bytes."""
    spans = []
    lower = raw.lower()
    if any(word in lower for word in _ASSIGN_WORDS):
        spans += [Span(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if b"AKIA" in raw:
        spans += [Span(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    if _HEX_RUN in raw.translate(_HEX_BYTES):
        spans += [Span(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= LEAST["hex"]]
    return spans


class Literal(NamedTuple):
    start: int
    end: int
    value: str


class Value:
    """What an assignment puts together: literals of its own and the values of other names, which it shares with them.

    ``a = a + a`` doubles a value, so that neither its text nor its literals are ever written out here: what is known of the
    text are its length, how often each character occurs, its kinds of characters, and its first and last ones.
    """

    __slots__ = ("parts", "counts", "length", "short", "told")
    #: Up to this length the text of several parts is kept.
    SHORT = 64

    def __init__(self, parts: list[Literal | Value]) -> None:
        self.parts = parts
        self.counts: Counter | None = None
        self.told = False

    def _below(self, known: Callable[[Value], bool]) -> Iterator[Value]:
        """The values below this one for which ``known`` is false and this one, each after its parts."""
        stack = [self]
        while stack:
            value = stack[-1]
            more = [part for part in value.parts if isinstance(part, Value) and not known(part)]
            if more and not known(value):
                stack += more
                continue
            stack.pop()
            if not known(value):
                yield value

    def literals(self) -> Iterator[Literal]:
        """The literals in it that no value has told before."""
        for value in self._below(lambda v: v.told):
            value.told = True
            yield from (part for part in value.parts if isinstance(part, Literal))

    def measured(self) -> Value:
        for value in self._below(lambda v: v.counts is not None):
            counts: Counter = Counter()
            texts: list[str | None] = []
            for part in value.parts:
                own = Counter(part.value) if isinstance(part, Literal) else part.counts
                for character, n in own.items():
                    counts[character] += n
                texts.append(part.value if isinstance(part, Literal) else part.short)
            value.length = sum(counts.values())
            if value.length > 1 << 200:  # shares are all that matters
                counts = Counter({c: max(1, n >> 100) for c, n in counts.items()})
                value.length = sum(counts.values())
            value.short = texts[0] if len(texts) == 1 else None
            if len(texts) > 1 and value.length <= Value.SHORT and None not in texts:
                value.short = "".join(texts)
            value.counts = counts
        return self


def tokens(text: str) -> Iterator[tuple[str, int, int]]:
    """Kind, start and end of all tokens. No stretch of the text is read again: a quote without its partner is a sign of its
    own, and so are, without a look, the quotes of its kind up to where the search for the partner ended."""
    at, size = 0, len(text)
    single = dict.fromkeys(_QUOTED, -1)
    match = _TOKEN.match
    while at < size:
        quote = text[at]
        if quote in single:
            if at > single[quote]:
                end = _QUOTED[quote].match(text, at + 1).end()
                if end < size and text[end] == quote:
                    yield "string", at, end + 1
                    at = end + 1
                    continue
                single[quote] = end
            yield "other", at, at + 1
            at += 1
            continue
        found = match(text, at)
        yield found.lastgroup, at, found.end()
        at = found.end()


def assignments(text: str) -> Iterator[tuple[str, Value]]:
    """Names and what is assigned to them, in text order, constants propagated."""
    known: dict[str, Value] = {}
    target: str | None = None  # the last name seen
    waiting: str | None = None  # the name that an assignment is filling
    parts: list[Literal | Value] = []
    plus = adjacent = False  # whether more may be added to the parts
    skip_to = 0
    for kind, start, end in tokens(text):
        if start < skip_to or kind == "blank":
            continue
        quoted = kind == "string"
        token = text[start:end]
        value = token[1:-1] if quoted else token
        if waiting is not None:
            if quoted and (plus or adjacent or not parts):
                parts.append(Literal(start + 1, end - 1, value))
                plus, adjacent = False, True
                continue
            if kind in ("name", "bare") and (plus or not parts):
                whole = _BARE.match(text, start)
                if kind == "name" and value in known:
                    parts.append(known[value])
                elif not parts and whole and any(c.isdigit() for c in whole[0]):
                    parts.append(Literal(start, whole.end(), whole[0]))
                    skip_to = whole.end()
                plus = adjacent = False
                if not parts:
                    waiting = None
                continue
            if token == "+" and parts:
                plus = True
                continue
            if parts:
                known[waiting] = Value(parts)
                yield waiting, known[waiting]
            waiting, parts, plus, adjacent = None, [], False, False
        if kind == "name" and value.lower() not in _KEYWORDS:
            target = value
        elif quoted:
            target = value if len(value) <= 64 and _NAME_WORDS.search(value) else None
        elif kind == "sign" and token in ("=", ":", ":=", "=>") and target is not None:
            waiting, target = target, None
        elif kind in ("line", "other", "bare", "sign"):
            target = None
    if waiting is not None and parts:
        yield waiting, Value(parts)


def pairs(text: str) -> Iterator[tuple[str, list[Literal]]]:
    """Names and the literals in what is assigned to them, each literal once, by the first name that it reaches."""
    return ((name, list(value.literals())) for name, value in assignments(text))


def sensitivity(name: str) -> float:
    """How much a name promises a secret, 0 to 1."""
    words = [w.lower() for w in _NAME_WORDS.findall(name)]
    single = max((SENSITIVE.get(w, 0.0) for w in words), default=0.0)
    return max([single, *(SENSITIVE_PAIRS.get(pair, 0.0) for pair in zip(words, words[1:], strict=False))])


def randomness(value: str | Value) -> float:
    """How much a literal, or several put together, looks like a secret rather than a word or a placeholder, 0 to 1."""
    measured = (Value([Literal(0, len(value), value)]) if isinstance(value, str) else value).measured()
    counts, length = measured.counts, measured.length
    if length < 6 or any(c.isspace() for c in counts):
        return 0.0
    if measured.short is not None and HARMLESS.fullmatch(measured.short):
        return 0.0
    entropy = -sum(n / length * log2(n / length) for n in counts.values())
    kinds = sum(any(map(test, counts)) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return min(1.0, entropy / 3.5) * min(1.0, 0.4 + 0.2 * kinds)


@cache
def least_words(threshold: float) -> list[tuple[bytes, ...]]:
    """Words that a text must hold, all of one entry, to have a name sensitive enough for any literal."""
    entries = {(word,): value for word, value in SENSITIVE.items()} | SENSITIVE_PAIRS
    found = {tuple(word.encode() for word in words) for words, value in entries.items() if value >= threshold}
    return sorted(words for words in found if len(words) == 1 or not any((word,) in found for word in words))


def literal_spans(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """Literals whose targets' names and own looks make them likely secrets."""
    found = set()
    weights: dict[str, float] = {}
    for name, value in assignments(text):
        weight = weights.get(name)
        if weight is None:
            weight = weights[name] = sensitivity(name)
        if weight and not value.told and weight * randomness(value) >= threshold:
            found.update(Span(p.start, 3, p.end) for p in value.literals() if p.end > p.start)
    return sorted(found)


def scan_text(raw: bytes, threshold: float = THRESHOLD) -> tuple:
    """Counts of the base kinds, the digest of base spans, and all spans."""
    text = raw.decode("utf-8", "replace")
    base = sorted(base_spans(text, raw))
    lower = raw.lower()
    lexed = any(all(word in lower for word in words) for words in least_words(threshold))
    more = literal_spans(text, threshold) if lexed else []
    counts = Counter(s.order for s in base)
    digest = sha256(",".join(s.text for s in base).encode()).hexdigest()
    return counts[0], counts[1], counts[2], digest, ",".join(s.text for s in sorted(base + more))


def scan_secrets(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` per row."""
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").cast("binary").alias("text")
    )
    kinds = [pa.int64()] * 4 + [pa.string()] * 2
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = [scan_text(text, threshold) for text in byte_texts(batch["text"])]
            yield record(schema, batch["doc_id"], *zip(*found, strict=True))

    return rows.mapInArrow(scan, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
