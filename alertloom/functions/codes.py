"""Code to label maps, flags and risk rules."""

from __future__ import annotations

from itertools import chain
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from alertloom.fixed import codes as fixed


def lookup(code: Column, mapping: Mapping[str, str], default: Column | str) -> Column:
    """Value of a small fixed map, with a default for anything not in it."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    if not mapping:
        return fallback
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(pairs, code.cast("string")), fallback)


def label(code: Column, code_type: str) -> Column:
    """Label of a coded field; an unknown code or map gives ``Unknown``."""
    return lookup(code, fixed.CODE_MAPS.get(code_type, {}), fixed.UNKNOWN)


def yes_no(code: Column) -> Column:
    return F.when(code == "1", "Yes").otherwise("No")


def sex(code: Column) -> Column:
    return lookup(code, fixed.SEX, fixed.UNKNOWN)


def risk_by_seriousness(serious: Column, other: Column) -> Column:
    return (
        F.when(serious == "1", "Critical").when(other == "1", "High").otherwise("Medium")
    )


def recall_class(value: Column) -> Column:
    return F.coalesce(value, F.lit(fixed.DEFAULT_RECALL_CLASS))


def risk_by_recall_class(value: Column) -> Column:
    """Only the bare classes count; any other spelling is Medium."""
    return lookup(recall_class(value), fixed.RECALL_CLASS_RISK, fixed.DEFAULT_RISK)
