"""Predicate trees compiled to one three-valued Column, closed with a single ``coalesce``."""

from __future__ import annotations

import numbers

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..config import Predicate
from ..errors import DataContractError, SpecError
from .scalars import is_missing

_ORDERINGS = ("ge", "gt", "le", "lt")


def _comparable(kind: T.DataType, value) -> bool:
    """Whether a stored value of this type can equal the literal at all."""
    if isinstance(kind, T.StringType):
        return isinstance(value, str)
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return isinstance(value, (bool, numbers.Number))
    return True


def _typed(kind: T.DataType, column: Column, value) -> tuple[Column, Column]:
    if isinstance(kind, T.BooleanType) and not isinstance(value, bool):
        return column.cast("int"), F.lit(value)
    if isinstance(kind, T.NumericType) and isinstance(value, bool):
        return column, F.lit(int(value))
    return column, F.lit(value)


def _equals(kind, column, value) -> Column:
    if value is None or not _comparable(kind, value):
        return F.lit(False)
    left, right = _typed(kind, column, value)
    return left == right


def _field(frame: DataFrame, rule: Predicate) -> Column:
    if rule.field not in frame.columns:
        raise DataContractError(f"A predicate names an unknown column: {rule.field}")
    missing = is_missing(frame, rule.field)
    if rule.op == "is_missing":
        return missing
    if rule.op == "not_missing":
        return ~missing
    column, kind = F.col(rule.field), frame.schema[rule.field].dataType
    if rule.op in _ORDERINGS:
        if rule.value is None or not _comparable(kind, rule.value):
            raise SpecError(f"{rule.op} on {rule.field} needs a value of the column's kind.")
        left, right = _typed(kind, column, rule.value)
        test = {"ge": left >= right, "gt": left > right, "le": left <= right, "lt": left < right}[rule.op]
    elif rule.op in ("in", "not_in"):
        usable = [v for v in rule.value if v is not None and _comparable(kind, v)]
        if isinstance(kind, T.BooleanType):
            column, usable = column.cast("int"), [v + 0 for v in usable]
        elif isinstance(kind, T.NumericType):
            usable = [v + 0 for v in usable]
        test = column.isin(*usable) if usable else F.lit(False)
        test = ~test if rule.op == "not_in" else test
    else:
        test = _equals(kind, column, rule.value)
        test = ~test if rule.op == "ne" else test
    return F.when(~missing, test)


def three_valued(frame: DataFrame, rule: Predicate) -> Column:
    """True, false, or null where a needed value is missing."""
    if rule.field is not None:
        return _field(frame, rule)
    if rule.negate is not None:
        return ~three_valued(frame, rule.negate)
    parts = [three_valued(frame, p) for p in (rule.all_of or rule.any_of)]
    result = parts[0]
    for part in parts[1:]:
        result = (result & part) if rule.all_of else (result | part)
    return result


def predicate_mask(frame: DataFrame, rule: Predicate) -> Column:
    """Whether a row is selected; unknown never selects, negated or not."""
    return F.coalesce(three_valued(frame, rule), F.lit(False))
