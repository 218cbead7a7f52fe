"""Validity rules: a plain dict compiled to column predicates.

    {"age": {"min": 18, "max": 100}, "status": {"allowed": ["Open", "Closed"]}}

Rules for columns the table does not have are ignored by the operators.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import fold
from plumbline.functions.values import FLOAT_TYPES, INTEGRAL_TYPES, as_number, is_missing, is_text

Rule = Mapping[str, Any]
Rules = Mapping[str, Rule]


def _bound(value: Any, dtype: T.DataType) -> Any:
    # A whole bound on an integer column stays an integer literal, so that the
    # comparison reaches the Parquet reader without a cast around the column.
    if isinstance(dtype, INTEGRAL_TYPES) and float(value).is_integer() and abs(value) < 2**63:
        return int(value)
    return value


def outside_range(ref: str, dtype: T.DataType, rule: Rule) -> Column | None:
    """True where the value is below `min` or above `max`; never true for a missing value.

    NaN sorts above every number in Spark, so the upper bound also asks for a
    value that is at most infinity.
    """
    sql = as_number(ref, dtype)
    if sql is None:
        return None
    number = F.expr(sql)
    tests = []
    if "min" in rule:
        tests.append(number < F.lit(_bound(rule["min"], dtype)))
    if "max" in rule:
        above = number > F.lit(_bound(rule["max"], dtype))
        if isinstance(dtype, FLOAT_TYPES) or is_text(dtype):
            above = above & (number <= F.lit(float("inf")))
        tests.append(above)
    return reduce(or_, tests) if tests else None


def allowed_values(rule: Rule) -> list[str]:
    """The allow-list in folded form."""
    return sorted({str(a).strip().lower() for a in rule["allowed"]})


def outside_allowed(ref: str, dtype: T.DataType, rule: Rule) -> Column | None:
    """True where a present value is not in the allow-list, ignoring case and padding."""
    if "allowed" not in rule:
        return None
    allowed = allowed_values(rule)
    text = ref if is_text(dtype) else f"CAST({ref} AS STRING)"
    return ~F.expr(fold(text)).isin(allowed) & ~F.expr(is_missing(ref, dtype))


def violates(ref: str, dtype: T.DataType, rule: Rule) -> Column | None:
    """Range or allow-list violation; None when the rule says nothing about this type."""
    tests = [outside_range(ref, dtype, rule), outside_allowed(ref, dtype, rule)]
    tests = [t for t in tests if t is not None]
    return reduce(or_, tests) if tests else None
