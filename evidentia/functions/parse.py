"""Strict parsing: a value is NULL and its status says why; nothing is repaired."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions.text import blank_to_null, full_match, trimmed

#: The least score of each band, from the best.
BANDS = ((92, "A"), (81, "B"), (69, "C"), (55, "D"), (39, "E"), (21, "F"))
MOST_UNSIGNED = (1 << 64) - 1


def strict_integer(text: Column, kind: str = "int", signed: bool = True) -> Column:
    """Digits only, with a minus at most; NULL where the type does not hold them."""
    plain = trimmed(text)
    return F.when(full_match(plain, "-?[0-9]+" if signed else "[0-9]+"), plain.try_cast(kind))


def strict_unsigned(text: Column) -> Column:
    """An unsigned 64-bit number as decimal(20,0)."""
    value = strict_integer(text, "decimal(38,0)", signed=False)
    return F.when(value <= F.lit(str(MOST_UNSIGNED)).cast("decimal(38,0)"), value).cast("decimal(20,0)")


def rounded_small(text: Column) -> Column:
    """Text to smallint as an engine that rounds decimals does it."""
    return F.round(trimmed(text).try_cast("decimal(38,10)"), 0).try_cast("smallint")


def date_of(text: Column, pattern: str = "y-M-d") -> Column:
    return F.try_to_timestamp(trimmed(text), F.lit(pattern)).cast("date")


#: How sources write a moment or a day.
MOMENTS = ("y-M-d H:m", "y-M-d H:m:s", "y-M-d")


def timestamp_of(text: Column) -> Column:
    """A moment in any of the sources' forms; NULL for any other."""
    return F.coalesce(*(F.try_to_timestamp(trimmed(text), F.lit(p)) for p in MOMENTS))


def band(score: Column) -> Column:
    out = F.when(score.isNull(), F.lit(None))
    for least, letter in BANDS:
        out = out.when(score >= least, letter)
    return out.otherwise("G")


#: How amounts, pounds and other currencies are written.
_AMOUNT = r"[0-9][0-9,]*(\.[0-9]{1,2})?"
_POUNDS = rf"(£|GBP[ \t\n\f\r]*){_AMOUNT}"
_OTHER_CURRENCIES = "[$€₹¥]"


def _step(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns made once: later steps read them, where a projection would be merged and each use made anew."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def with_money(df: DataFrame, text: Column, low: str = "low", high: str = "high", status: str = "status") -> DataFrame:
    """df with low and high (decimal(18,2)) and status of a cost in pounds, one amount or a range."""
    c, kept = F.col, df.columns
    out = _step(df, __shown=blank_to_null(text))
    out = _step(out, __upper=F.upper("__shown"))
    shape = (
        F.when(c("__shown").isNull(), "MISSING")
        .when(F.contains("__shown", F.lit("Â£")), "ENCODING_ERROR")
        .when(c("__shown").rlike(_OTHER_CURRENCIES), "NON_GBP_CURRENCY")
        .when(full_match(c("__upper"), rf"{_POUNDS}\s*-\s*{_POUNDS}"), "RANGE")
        .when(full_match(c("__upper"), _POUNDS), "SINGLE")
        .when(full_match(c("__shown"), _AMOUNT), "BARE_NUMBER_UNSUPPORTED")
        .otherwise("UNSUPPORTED_FORMAT")
    )
    out = _step(out, __shape=shape)
    ranged = c("__shape").isin("RANGE", "SINGLE")
    out = _step(out, __digits=F.when(ranged, F.regexp_replace("__upper", r"GBP|£|,|\s", "")))
    first, second = (F.split_part("__digits", F.lit("-"), F.lit(k)).try_cast("decimal(18,2)") for k in (1, 2))
    out = _step(out, __low=first, __high=F.when(c("__shape") == "RANGE", second).otherwise(first))
    parsed, ordered = c("__low").isNotNull() & c("__high").isNotNull(), c("__low") <= c("__high")
    said = F.when(ranged & ~parsed, "NUMERIC_OVERFLOW").when(ranged & ~ordered, "INVALID_BOUNDS").when(c("__shape") == "RANGE", "RANGE_PARSED").when(c("__shape") == "SINGLE", "SINGLE_VALUE_PARSED").otherwise(c("__shape"))
    good = ranged & parsed & ordered
    return out.select(*(c(f"`{k}`") for k in kept), F.when(good, c("__low")).alias(low), F.when(good, c("__high")).alias(high), said.alias(status))
