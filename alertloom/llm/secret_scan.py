"""Secret scans: fixed patterns, and assignments read with their names and constants.

Patterns give the base spans. Beside them, texts are lexed as source and configuration
syntax: `name = value`, `name: value` and `name => value` pairs, where a name may be a key in
`x["key"]` and a value is literals and names joined by `+`. A name's text is remembered in order, so that a secret put together from
constants is seen where it is assigned. A pair counts if its name and its value score enough.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # as of all runs, those of 24 or more
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20

# The sign between a name and its value, and what a value begins with.
SIGN = re.compile(r"""(?:=>|:=|[:=](?![=:]))[\x20\t]*(?=["'`A-Za-z0-9_$(])""")
NAME_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-")
NAME_START = re.compile(r"[A-Za-z_]")
TERM = re.compile(
    r"""(?:[rRbBuUfF]{1,2}(?=["']))?(?P<quoted>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\\n]|\\.)*`)"""
    r"""|(?P<name>[A-Za-z_][A-Za-z0-9_.]*)|(?P<bare>[^\s"'`+,;(){}\[\]]+)"""
)
PLUS = re.compile(r"\x20*\+\x20*")
ESCAPE = re.compile(r"\\(.)")

# What a part of a name adds: its words are split at _ . - and at capitals.
NAME_SCORES = {
    "password": 3, "passwd": 3, "pwd": 3, "passphrase": 3, "secret": 3, "token": 2,
    "credential": 3, "credentials": 3, "apikey": 3, "key": 1, "auth": 1, "private": 1,
    "access": 1, "api": 1, "bearer": 2, "signature": 1, "salt": 1, "session": 1,
}
# Parts that tell that the value names or measures a secret rather than being one.
NAME_EXCUSES = {"file", "path", "url", "name", "length", "size", "count", "type", "hint", "ttl", "policy"}
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|change.?me|example.*|your.*|none|null|true|false|todo|test|<.*>|\$\{?.*)$")
SCORE = 4
MIN_VALUE = 8
# Values above this many characters are kept as what their score needs: constants put into
# constants can be far longer than the text.
WHOLE = 4096


@dataclass(frozen=True)
class Long:
    """A long value: its size, how often it has each character, how it begins and ends."""

    size: int
    counts: Counter
    head: str
    tail: str

    def placeholder(self) -> bool:
        """What PLACEHOLDER says of the whole value, which holds no line break."""
        alike = {c.lower() for c in self.counts}
        return (
            alike in ({"x"}, {"*"}, {"."})
            or self.head.lower().startswith(("example", "your", "$"))
            or (self.head[0] == "<" and self.tail == ">")
        )


def _joined(parts: list[str | Long]) -> str | Long:
    size = sum(len(p) if isinstance(p, str) else p.size for p in parts)
    if size <= WHOLE:
        return "".join(parts)
    counts, head, tail = Counter(), "", ""
    for part in parts:
        counts.update(part if isinstance(part, str) else part.counts)
        if len(head) < MIN_VALUE:
            head += (part if isinstance(part, str) else part.head)[:MIN_VALUE]
        tail = (part[-1:] if isinstance(part, str) else part.tail) or tail
    return Long(size, counts, head, tail)


def entropy(value: str | Long) -> float:
    """Bits for each character, by the value's own frequencies."""
    counts, size = (Counter(value), len(value)) if isinstance(value, str) else (value.counts, value.size)
    return -sum(n / size * math.log2(n / size) for n in counts.values()) if size else 0.0


def name_score(name: str) -> int:
    words = {w.lower() for part in re.split(r"[_.\-]", name) for w in WORD.findall(part)}
    words |= {a + b for a in ("api", "pass") for b in ("key", "word", "phrase") if {a, b} <= words}
    return 0 if words & NAME_EXCUSES else sum(NAME_SCORES.get(w, 0) for w in words)


def value_score(value: str | Long) -> int:
    """0 for what cannot be a secret; more for length, mixed kinds of character, and entropy."""
    if isinstance(value, Long):
        size, letters, excused = value.size, "".join(value.counts), value.placeholder()
    else:
        size, letters, excused = len(value), value, PLACEHOLDER.match(value)
    if size < MIN_VALUE or " " in letters or excused:
        return 0
    kinds = sum(bool(re.search(k, letters)) for k in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return 1 + (size >= 16) + (kinds >= 2) + (kinds >= 3) + (entropy(value) >= 3.0)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern matches that are long enough."""
    found = []
    if ":" in text or "=" in text:
        found += [
            (m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE
        ]
    found += [
        (m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH
    ]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def _value(text: str, at: int, constants: dict[str, str | Long]) -> tuple[str | Long | None, int, int]:
    """The value of an expression, its end, and how many literals it has; None if unknown, and then read no further."""
    parts, end, literals = [], at, 0
    while True:
        term = TERM.match(text, end)
        if not term:
            break
        end = term.end()
        if term["name"] is not None:
            # An unquoted word is itself, unless it names a constant.
            more = TERM.match(text, end)
            if more and more["bare"] is not None and more.start() == end:
                parts.append(term["name"] + more["bare"])
                end = more.end()
            elif term["name"] in constants:
                parts.append(constants[term["name"]])
                literals += 1
            elif parts or PLUS.match(text, end):
                return None, end, literals
            else:
                parts.append(term["name"])
        elif term["bare"] is not None:
            parts.append(term["bare"])
        else:
            literals += 1
            parts.append(ESCAPE.sub(r"\1", term["quoted"][1:-1]))
        plus = PLUS.match(text, end)
        if not plus or not TERM.match(text, plus.end()):
            break
        end = plus.end()
    return (_joined(parts) if parts else None), end, literals


def _name(text: str, low: int, sign: int) -> str | None:
    """The name before a sign, plain or quoted or the key in `x["key"]`, read back to `low` at most."""
    end = sign
    while end > low and text[end - 1] in " \t":
        end -= 1
    if end > low and text[end - 1] == "]":
        end -= 1
        if end == low or text[end - 1] not in "\"'":
            return None
    quote = text[end - 1] if end > low and text[end - 1] in "\"'" else ""
    end -= len(quote)
    start = end
    while start > low and text[start - 1] in NAME_CHARACTERS:
        start -= 1
    if quote:
        whole = start < end and start > low and text[start - 1] == quote and NAME_START.match(text, start)
        return text[start:end] if whole else None
    first = NAME_START.search(text, start, end)
    return text[first.start() : end] if first else None


def assignments(text: str) -> Iterator[tuple[str, str | Long, int, int, int]]:
    """(name, value, start of the value, its end, literals in it), constants put in."""
    constants: dict[str, str | Long] = {}
    at = 0
    low = 0  # names lie behind the sign or the value before
    while sign := SIGN.search(text, at):
        name = _name(text, low, sign.start())
        low = at = sign.end()
        if name is None:
            continue
        value, end, literals = _value(text, at, constants)
        constants.pop(name, None)  # what it was is over, known or not
        if value is None:
            continue
        if literals:
            constants[name] = value
        yield name, value, at, end, literals
        low = at = max(at, end)


def literal_spans(text: str, threshold: int = SCORE) -> list[tuple[int, int, str]]:
    """Values whose name is sensitive and whose score, name and value together, is enough."""
    if "=" not in text and ":" not in text:
        return []
    found = []
    for name, value, start, end, _ in assignments(text):
        by_name = name_score(name)
        by_value = value_score(value) if by_name else 0
        if by_value and by_name + by_value >= threshold:
            found.append((start, end, "literal"))
    return found


def all_spans(text: str) -> list[tuple[int, int, str]]:
    """Base spans, and literals that are not inside one of them; by start, then kind."""
    base = sorted(base_spans(text))
    starts = [b[0] for b in base]
    reach = list(accumulate((b[1] for b in base), max, initial=0))  # of those that start so early
    more = [s for s in literal_spans(text) if reach[bisect_right(starts, s[0])] < s[1]]
    return sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_literal, base_sha256, spans) of every row.

    Spans are code points of the whole text, `kind:start:end`, comma-joined by start and then
    kind. A null text counts as empty: no spans. Repeated rows give repeated results.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {kind: [] for kind in KINDS}
            digests, spans = [], []
            for text in batch.column(1):
                found = all_spans(text.as_py() or "")
                for kind in KINDS:
                    counts[kind].append(sum(s[2] == kind for s in found))
                base = joined([s for s in found if s[2] != "literal"])
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                spans.append(joined(found))
            yield pa.record_batch(
                {
                    "doc_id": batch.column(0),
                    **{f"n_{k}": pa.array(v, pa.int64()) for k, v in counts.items()},
                    "base_sha256": pa.array(digests, pa.string()),
                    "spans": pa.array(spans, pa.string()),
                }
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run,
        "doc_id long, n_assign long, n_access long, n_hex long, n_literal long, "
        "base_sha256 string, spans string",
    )
