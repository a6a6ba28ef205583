"""Filters built from data."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.arguments import COMPARE, comparison, safe_identifier
from ledgerline.functions.expressions import month


def known_column(df: DataFrame, name: object) -> str:
    """The name, if it is a plain identifier and a column of the table."""
    text = safe_identifier(name)
    if text not in df.columns:
        raise ValueError(f"unknown column {text!r}: there are {', '.join(df.columns)}")
    return text


def conditions(df: DataFrame, equal: dict | None = None, compare: list[dict] | None = None) -> Column:
    """All of some equalities {column: value} and comparisons {column, operator, value}."""
    found = [F.col(known_column(df, c)) == v for c, v in (equal or {}).items()]
    found += [COMPARE[comparison(x.get("operator"))](F.col(known_column(df, x.get("column"))), x.get("value")) for x in compare or []]
    return reduce(and_, found, F.lit(True))


def between(df: DataFrame, time: str, start, end, partition: str | None = None) -> DataFrame:
    """Rows with start <= time < end, and the months that can hold them where the table is partitioned by month."""
    kept = df.where((F.col(time) >= F.lit(start)) & (F.col(time) < F.lit(end)))
    if partition:
        kept = kept.where(F.col(partition).between(month(F.lit(start).cast("timestamp")), month(F.lit(end).cast("timestamp"))))
    return kept


def recent(df: DataFrame, time: str, span: str) -> DataFrame:
    """Rows of the last ``span`` before the latest row, not before now: data may be old.

    The latest time is a scalar subquery, so the comparison is a filter at the scan.
    """
    latest = df.agg(F.max(time)).scalar()
    return df.where(F.col(time) > latest - F.expr(f"interval {span}"))
