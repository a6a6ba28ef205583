"""Rows that are versions of one another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.schemas import Table


def latest_by_key(df: DataFrame, key: list[str] | tuple[str, ...], *order: str | Column) -> DataFrame:
    """The row of highest ``order`` per key.

    One aggregate with a map-side combine: a key with very many versions does not
    gather them in one task, as a ranking window would.
    """
    rank = F.struct(*(F.col(c) if isinstance(c, str) else c for c in order))
    rows = df.groupBy(*key).agg(F.max_by(F.struct(*df.columns), rank).alias("__row"))
    return rows.select("__row.*")


def merged(df: DataFrame, table: Table, *tiebreak: str) -> DataFrame:
    """A base table without superseded versions; as it is where the table keeps none."""
    return latest_by_key(df, table.key, table.version, *tiebreak) if table.version else df


def latest_checkpoint(offsets: DataFrame, source_name: str, checkpoint_name: str) -> DataFrame:
    """At most one row: the named checkpoint as last updated."""
    named = offsets.where((F.col("source_name") == source_name) & (F.col("checkpoint_name") == checkpoint_name))
    return named.orderBy(F.col("updated_at").desc_nulls_last()).limit(1)


def current_state(changes: DataFrame, key: list[str], *order: str, deleted: str = "__deleted") -> DataFrame:
    """Rows as they stand after a log of changes: the last per key, without deleted ones."""
    last = latest_by_key(changes, key, *order)
    return last.where(F.coalesce(F.lower(F.col(deleted).cast("string")), F.lit("false")) != "true").drop(deleted)
