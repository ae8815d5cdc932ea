"""Text clean-up, region labels and column-name rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Defaults and labels of the reports.
UNKNOWN_REGION = "未知"
UNKNOWN_NAME = "unknown"
UNKNOWN_VERSION = "unk"
NULL_LABEL = "null"
TYPE_TODAY = "periodic"
TYPE_HISTORY = "history"

_BLANKS = " \t\r\n"


def clean_product_id(col: Column) -> Column:
    """Drop line breaks, written out (backslash + n) or real, then outer spaces."""
    return F.trim(F.replace(F.replace(col, F.lit("\\n"), F.lit("")), F.lit("\n"), F.lit("")))


def money(col: Column) -> Column:
    """Amount text to ``decimal(18,2)``; anything that is not a number becomes null."""
    return col.try_cast("decimal(18,2)")


def cents(amount: Column) -> Column:
    """``decimal(18,2)`` as whole cents: exact, and cheaper to sum than decimals.

    A sum beyond 92 quadrillion fails under ANSI rules, which ``build_session`` sets.
    """
    return (amount * 100).cast("bigint")


def from_cents(col: Column) -> Column:
    """Whole cents as ``decimal(18,2)``; sums beyond its range become null."""
    exact = col.cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")
    return exact.try_cast("decimal(18,2)")


def lower_or(col: Column, default: str) -> Column:
    return F.coalesce(F.lower(col), F.lit(default))


def region_part(region: Column, index: int) -> Column:
    """One part of ``country|province|city|district``; blank and ``0`` count as unknown."""
    part = F.btrim(F.get(F.split(region, r"\|"), F.lit(index)), F.lit(_BLANKS))
    return F.when(F.contains(region, F.lit("|")) & ~part.isin("", "0"), part)


def region_label(province: Column, city: Column, district: Column) -> Column:
    """``province|city|district`` with the word ``null`` for unknown parts."""
    return F.concat_ws("|", *[F.coalesce(c, F.lit(NULL_LABEL)) for c in (province, city, district)])


def camel(name: str) -> str:
    """``UPPER_UNDERSCORE`` (any case) to ``lowerCamel``."""
    head, *rest = name.lower().split("_")
    return head + "".join(word[:1].upper() + word[1:] for word in rest)


def camel_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[camel(name) for name in df.columns])
