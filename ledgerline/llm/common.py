"""Helpers that the training-data operators share.

Words are maximal runs of characters outside ``[\\x20\\x09-\\x0D]``; texts that
are null count as empty. Internal columns start with ``__`` so that they do not
clash with columns of a caller's table.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import fresh_path, shared_folder

WHITE = r"[\x20\x09-\x0D]"
NOT_WHITE = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def words(column: Column) -> Column:
    """Array of the words of a text; empty for null."""
    return F.array_remove(F.split(text_or_empty(column), f"{WHITE}+"), "")


def shingles(word_array: Column, k: int = 5) -> Column:
    """64-bit hashes of all runs of ``k`` words in order.

    A text of 1 to k-1 words has one shingle, all its words; an empty text none.
    ``word_array`` must be a column of a table, not an expression, as every
    element refers to it.
    """
    n = F.size(word_array)
    runs = F.transform(word_array, lambda w, i: F.xxhash64(w, *(F.get(word_array, i + j) for j in range(1, k))))
    return F.slice(runs, 1, F.when(n < k, F.least(n, F.lit(1))).otherwise(n - (k - 1)))


def stash(df: DataFrame) -> DataFrame:
    """Writes a table to the shared folder as Parquet and reads it again.

    For what is used more than once and is costly to compute: an executor that is
    lost takes nothing with it.
    """
    path = fresh_path(df.sparkSession, "table")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Rows of an Arrow batch at most in what is written inside: for rows that are long arrays, of which executor and worker each hold a batch."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(most, int(before)) if int(before) > 0 else most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def discard(*stashes: DataFrame) -> None:
    """Deletes stashed tables that nothing reads any more: all that was made of them has been written."""
    for df in stashes:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """``checkpoint()`` into the shared folder. For narrow tables: its files are not compressed."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph: one row ``(node, component)`` per node.

    ``edges`` has columns ``a`` and ``b`` of one orderable type; rows with a null
    are dropped, loops are allowed and give a component of one node. A component's id
    is its smallest node. Alternates large-star and small-star steps: the minimum
    of each neighbourhood is a map-side combined aggregate, and the step back to
    the edges is a plain equi-join that adaptive execution may split when a node
    has very many neighbours. Rounds grow with the logarithm of the longest path.
    No edge: an empty table.
    """
    clean = edges.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull())
    both = clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = cut_lineage(both)
    edges_before = current.count()
    for _ in range(max_rounds):
        # Large star: every larger neighbour of a node points to the node's smallest.
        directed = current.where("a <> b")
        around = directed.unionByName(directed.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            around.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        # Small star: a node and its smaller neighbours point to the smallest of them.
        lower = large.where("a <> b").distinct()
        least = lower.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            lower.join(least, "a")
            .select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("s"))
            .select(F.col("s.b").alias("a"), F.col("s.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        loops = current.where("a = b")
        before, current = current, cut_lineage(small.unionByName(loops).distinct())
        edges_now = current.count()
        # Settled when the round has changed no edge.
        if edges_now == edges_before and current.join(before, ["a", "b"], "left_anti").isEmpty():
            break
        edges_before = edges_now
    else:
        raise RuntimeError(f"components are not settled after {max_rounds} rounds")
    pairs = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = pairs.select(F.col("component").alias("node"), "component")
    return pairs.unionByName(roots).groupBy("node").agg(F.min("component").alias("component"))
