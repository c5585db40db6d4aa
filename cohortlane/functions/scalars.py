"""Small Column expressions shared by the operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

FLOATING = (T.DoubleType, T.FloatType)


def age_on(birth_date: Column, reference: dt.date) -> Column:
    """Completed calendar years at ``reference``; null for an unknown, unreadable or later birth."""
    birth = birth_date.try_cast("date")
    later_in_year = (F.month(birth) > reference.month) | (
        (F.month(birth) == reference.month) & (F.dayofmonth(birth) > reference.day)
    )
    years = F.lit(reference.year) - F.year(birth) - later_in_year.cast("int")
    return F.when(birth <= F.lit(reference), years).cast("int")


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def finite(value: Column) -> Column:
    return F.when(is_finite(value), value)


def parsed(value: Column) -> Column:
    """A number or null: text that is not a number never fails the job."""
    return value.try_cast("double")


def number_of(frame: DataFrame, name: str) -> Column:
    """The column as a finite double, else null."""
    return finite(parsed(F.col(name)))


def evidence_number(number: Column, text: Column) -> Column:
    """The numeric field if present, else the text field read as a number."""
    stored = parsed(number)
    return F.coalesce(F.when(~F.isnan(stored), stored), parsed(text))


def is_missing(frame: DataFrame, name: str) -> Column:
    kind = frame.schema[name].dataType
    column = F.col(name)
    return (column.isNull() | F.isnan(column)) if isinstance(kind, FLOATING) else column.isNull()


def small_count(value: Column, threshold: int = 20) -> Column:
    return (value > 0) & (value <= threshold)


def title_label(value: Column) -> Column:
    return F.initcap(F.replace(value, F.lit("_"), F.lit(" ")))


def sentence_label(value: Column) -> Column:
    spaced = F.replace(value, F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.substring(spaced, 1, 1)), F.lower(F.substring(spaced, 2, 1_000_000)))


def fixed(value: Column, decimals: int) -> Column:
    return F.format_string(f"%.{decimals}f", value.cast("double"))


def significant(value: Column, digits: int = 3) -> Column:
    """``digits`` significant digits without trailing zeros, exponent form outside 1e-4..10**digits."""
    value = value.cast("double")
    exponent = F.floor(F.log10(F.abs(value)))
    scale = F.pow(F.lit(10.0), exponent - (digits - 1))
    rounded = F.round(value / scale) * scale
    exponent = F.floor(F.log10(F.abs(rounded)) + F.lit(1e-12))
    text = F.format_string(f"%.{digits - 1}e", value)
    mantissa = F.regexp_replace(F.split(text, "e")[0], r"\.?0+$", "")
    scientific = F.concat(mantissa, F.lit("e"), F.split(text, "e")[1])
    places = F.greatest(F.lit(digits - 1) - exponent, F.lit(0)).cast("int")
    plain = rounded.cast("decimal(38,12)").cast("string")
    plain = F.when(places > 0, F.regexp_replace(plain, r"\.?0+$", "")).otherwise(
        F.regexp_replace(plain, r"\..*$", "")
    )
    return (
        F.when(value == 0, F.lit("0"))
        .when((exponent < -4) | (exponent >= digits), scientific)
        .otherwise(plain)
    )


def thousands(value: Column) -> Column:
    return F.format_number(value.cast("long"), 0)


def p_text(value: Column) -> Column:
    return F.when(value < 0.001, F.lit("<0.001")).otherwise(fixed(value, 3))


def count_percent(n: Column, percent: Column, decimals: int = 1) -> Column:
    return F.concat(n.cast("long").cast("string"), F.lit(" ("), fixed(percent, decimals), F.lit("%)"))


def fraction_percent(n: Column, total: Column, percent: Column, decimals: int = 1) -> Column:
    return F.concat(
        n.cast("long").cast("string"), F.lit("/"), total.cast("long").cast("string"),
        F.lit(" ("), fixed(percent, decimals), F.lit("%)"),
    )
