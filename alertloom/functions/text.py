"""Text rules: truthiness, fallbacks, keyword classes, templates."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def blank_to_null(value: Column) -> Column:
    """Blank text counts as missing. No trimming: a space is not blank."""
    return F.nullif(value, F.lit(""))


def is_filled(value: Column) -> Column:
    return blank_to_null(value).isNotNull()


def first_filled(
    fields: Sequence[Column], last: Column, default: str | None = None
) -> Column:
    """First field that is neither null nor blank, else ``last`` as it stands.

    The default replaces ``last`` only where that is null, so a blank last field
    gives a blank result.
    """
    tail = last if default is None else F.coalesce(last, F.lit(default))
    return F.coalesce(*[blank_to_null(f) for f in fields], tail)


def keyword_class(
    value: Column, rules: Sequence[tuple[Sequence[str], str]], default: str
) -> Column:
    """Class of the first rule one of whose keywords occurs in the text.

    Case does not matter and the test is for substrings, not words.
    """
    lowered = F.lower(value)
    result = None
    for words, label in rules:
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(lowered, F.lit(word.lower()))
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return F.lit(default) if result is None else result.otherwise(default)


def head(value: Column, length: int) -> Column:
    """The first ``length`` characters."""
    return F.substring(value, 1, length)


def alphanumeric_head(value: Column, length: int) -> Column:
    """Cut first, then drop everything but letters and digits."""
    return F.regexp_replace(head(value, length), r"[^\p{IsAlphabetic}\p{IsDigit}]", "")


def fill(template: str, values: Mapping[str, Column]) -> Column:
    """Fill a fixed text. A placeholder without a value is an error at once."""
    parts: list[Column] = []
    end = 0
    for match in _PLACEHOLDER.finditer(template):
        if match.start() > end:
            parts.append(F.lit(template[end : match.start()]))
        parts.append(values[match.group(1)].cast("string"))
        end = match.end()
    if end < len(template):
        parts.append(F.lit(template[end:]))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def line_if_filled(template: str, name: str, value: Column) -> Column:
    """A line of text where the field is filled, nothing elsewhere."""
    return F.when(is_filled(value), fill(template, {name: value})).otherwise("")


def dollars(value: Column) -> Column:
    """Whole dollars with thousands separators, without the sign."""
    return F.format_number(value, 0)


def decimals(value: Column, places: int) -> Column:
    """Fixed decimals without separators, rounded from the exact binary value.

    Only a value that lies exactly between two goes to the even one, and a value
    that rounds to nothing has no sign. Of doubles past fifteen digits those shown
    are the fewest that name the double.
    """
    shown = F.replace(F.format_number(value.cast("double"), places), F.lit(","), F.lit(""))
    nothing = F.lit("-" + format(0, f".{places}f"))
    return F.when(shown == nothing, F.lit(format(0, f".{places}f"))).otherwise(shown)
