"""Mixing sources to target word counts by entropy balancing.

Each document gets a rate between 0 and ``most`` copies. Among all rates that
meet the word constraint of each source, those nearest to one copy each in
(bounded) relative entropy are exponential tilts of the document's own words:
``rate = most / (1 + (most - 1) * exp(-lambda[source] * words / scale))``. The dual is
convex with one multiplier per source; Newton steps for all sources run at once
over the histogram of document sizes per source, which Spark aggregates from all
documents. Rates are then rounded to whole copies: a fixed hash of the document
decides, against a threshold per source that makes the copies' words meet the
target.

All sums that decide anything are sums of integers or decimals, so reruns agree
whatever the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import cut_lineage, stash, table, words

BINS = 8192
#: Sources up to which their rows are broadcast; with more the joins shuffle, and adaptive execution splits large sources.
BROADCAST_SOURCES = 50_000


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def draw(*columns: str) -> Column:
    """A number in (0, 1) that depends on the values only."""
    return (F.pmod(F.xxhash64(*columns), F.lit(2**30)) + 0.5) / float(2**30)


def in_order(rows: DataFrame, *order: Column) -> DataFrame:
    """Adds ``place``, the row number by ``order`` from 0. Ranges of rows are sorted, each by itself; one window sees one row for each range."""
    ranged = stash(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("__range").agg(F.count("*").alias("n")).select("__range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*order)) - 1
    return ranged.join(F.broadcast(starts), "__range").withColumn("place", F.col("__start") + inside).drop("__range", "__start")  # as many starts as shuffle partitions


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float, rounds: int = 200) -> DataFrame:
    """(source, source_size, target) from (source, size) totals, one row per source.

    Sources in code-point order, null last, take ``weights`` in turn. Their targets
    are the smaller of ``most`` times their size and a common level times their
    weight, with the level at which all add up to ``share`` of all sizes. What stands above a limit
    is reshared until no further source does: each round is one sum over all sources, and levels only rise.
    """
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights)).cast("int"))
    ranked = in_order(sizes.select("source", "source_size"), F.col("source").asc_nulls_last())
    ranked = cut_lineage(ranked.select("source", "source_size", weight.alias("weight"), (most * F.col("source_size").cast("double")).alias("top")))
    exact = lambda name: F.coalesce(F.sum(F.col(name).cast("decimal(32,6)")), F.lit(0)).alias(name)
    whole = ranked.agg(exact("source_size"), exact("weight")).first()
    budget = share * float(whole["source_size"])
    level, limited = 0.0, -1
    for _ in range(rounds):
        over = ranked.where(F.col("top") < level * F.col("weight")).agg(F.count("*").alias("n"), exact("top"), exact("weight")).first()
        if over["n"] <= limited:
            break
        limited, left = over["n"], float(whole["weight"] - over["weight"])
        level = (budget - float(over["top"])) / left if left else float("inf")
    else:
        raise RuntimeError(f"targets are not settled after {rounds} rounds")
    return ranked.select("source", "source_size", F.least("top", F.lit(level) * F.col("weight")).alias("target"))


def by_source(rows: DataFrame, sources: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with the columns of their source, whose name comes as ``s``; null is a source. ``sources`` is checkpointed."""
    named = sources.withColumnRenamed("source", "s")
    if sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        named = F.broadcast(named)
    return rows.join(named, F.col("source").eqNullSafe(F.col("s")), how)


def rate(most: float) -> Column:
    """Copies expected of a document, from ``size`` and its source's ``lam`` and ``scale``."""
    tilt = most / (1 + (most - 1) * F.exp(-F.col("lam") * F.col("size") / F.col("scale")))
    return F.when(F.col("full"), F.lit(float(most))).otherwise(tilt)


def balance(histogram: DataFrame, goals: DataFrame, most: float, rounds: int = 40) -> DataFrame:
    """(source, source_size, target, scale, full, lam): the dual's solution for each source.

    ``histogram`` has (source, size, n). A Newton step that leaves the bracket known
    so far is replaced by its middle. Starts from the solution for documents of one size;
    stops when every source is within a ten-thousandth of its target. Where the rounds end before,
    fill() still closes the gap.
    """
    squares = F.col("n").cast("decimal(20,0)") * F.col("size") * F.col("size")
    spread = histogram.groupBy("source").agg(
        F.try_divide(F.sum(squares).cast("double"), F.sum(F.col("n") * F.col("size")).cast("double")).alias("scale")
    ).select("source", F.coalesce("scale", F.lit(1.0)).alias("scale"))
    state = cut_lineage(
        goals.join(spread, goals["source"].eqNullSafe(spread["source"]))
        .select(goals["source"], "source_size", "target", "scale")
        .withColumn("full", F.col("target") >= most * F.col("source_size") * (1 - 1e-9))
        .withColumn("share", F.try_divide(F.col("target"), F.col("source_size").cast("double")))
        .withColumn("lam", F.when(F.col("full") | (F.col("share") <= 0) | F.col("share").isNull(), 0.0).otherwise(F.log((most - 1) * F.col("share") / (most - F.col("share")))))
        .drop("share")
        .withColumns({"low": F.lit(None).cast("double"), "high": F.lit(None).cast("double")})
    )
    exact = lambda c: F.sum(c.cast("decimal(32,6)")).cast("double")
    for _ in range(rounds):
        r = rate(most)
        words_now = F.col("n") * F.col("size") * r
        slope = words_now * (1 - r / most) * F.col("size") / F.col("scale")
        met = (
            by_source(histogram, state)
            .groupBy("source")
            .agg(exact(words_now).alias("now"), exact(slope).alias("slope"))
            .withColumnRenamed("source", "s")
        )
        off = F.col("now") - F.col("target")
        step = state.join(met, F.col("source").eqNullSafe(F.col("s"))).withColumns(
            {
                "done": F.col("full") | (F.abs(off) <= 1e-4 * F.greatest("target", F.lit(1.0))),
                "high": F.when(off > 0, F.col("lam")).otherwise(F.col("high")),
                "low": F.when(off <= 0, F.col("lam")).otherwise(F.col("low")),
                "newton": F.col("lam") - F.coalesce(F.try_divide(off, F.col("slope")), F.signum(off) * 1e9),
            }
        )
        widest = F.greatest(8 * F.abs("lam"), F.lit(2.0))
        inside = (
            F.when(F.col("low").isNull(), F.greatest("newton", F.col("high") - widest))
            .when(F.col("high").isNull(), F.least("newton", F.col("low") + widest))
            .when((F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high")), F.col("newton"))
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        state = cut_lineage(
            step.withColumn("lam", F.when(F.col("done"), F.col("lam")).otherwise(inside)).select(*state.columns, "done")
        )
        left = state.where("not done").count()
        state = state.drop("done")
        if not left:
            break
    return cut_lineage(state.select("source", "source_size", "target", "scale", "full", "lam"))


def plan(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: what copies() needs. ``sizes`` has (source, size, u), one row per document."""
    histogram = cut_lineage(sizes.groupBy("source", "size").agg(F.count("*").alias("n")))
    totals = histogram.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    solved = balance(histogram, targets(totals, weights, share, most), most)
    return fill(by_source(sizes, solved).drop("s"), solved, most)


def fill(rated: DataFrame, solved: DataFrame, most: float, passes: int = 3) -> DataFrame:
    """Adds to each source ``steps``: which documents get one copy more than their whole rate.

    Documents stand in bins by their hash less the fraction of their rate. A pass
    takes bins from where the last one stopped while their words fit the gap to the target;
    later passes look only at documents no larger than the gap that is left.
    """
    binned = rated.select("source", "size", _bin(most).alias("bin"), (_whole(most) * F.col("size")).alias("base"))
    floor = binned.groupBy("source").agg(F.sum("base").alias("base")).withColumnRenamed("source", "s")
    state = cut_lineage(solved.join(floor, F.col("source").eqNullSafe(F.col("s"))).select(
        solved["*"],
        (F.col("target") - F.col("base")).alias("gap"),
        F.lit(0).alias("low"),
        F.array().cast("array<struct<low:int,high:int,most:double>>").alias("steps"),
    ))
    upto = Window.partitionBy("source").orderBy("bin")
    for _ in range(passes):
        open_bins = (
            by_source(binned, state.select("source", "gap", "low"))
            .where((F.col("bin") >= F.col("low")) & (F.col("bin") < 2 * BINS) & (F.col("size") <= F.col("gap")))
            .groupBy("source", "bin", "gap")
            .agg(F.sum("size").alias("more"))
            .withColumn("more", F.sum("more").over(upto))
            .where("more <= gap")
        )
        best = open_bins.groupBy("source").agg((F.max("bin") + 1).alias("high"), F.max("more").alias("more")).withColumnRenamed("source", "s")
        high = F.coalesce("high", "low")
        state = cut_lineage(
            state.join(best, F.col("source").eqNullSafe(F.col("s")), "left").select(
                *solved.columns,
                (F.col("gap") - F.coalesce("more", F.lit(0))).alias("gap"),
                high.alias("low"),
                F.concat("steps", F.array(F.struct(F.col("low"), high.alias("high"), F.col("gap").alias("most")))).alias("steps"),
            )
        )
    return state.drop("gap", "low")


def _whole(most: float) -> Column:
    return F.floor(rate(most) + 1e-12)


def _bin(most: float) -> Column:
    fraction = rate(most) - _whole(most)
    full = rate(most) >= most - 1e-12
    return F.when(full, 2 * BINS).otherwise(F.floor((F.col("u") - fraction + 1) * BINS)).cast("int")


def copies(docs: DataFrame, per_source: DataFrame, most: float = 2.0) -> DataFrame:
    """Adds source_size, target and copies (whole, 0 to ``most``) to (.., source, size, u)."""
    inside = lambda s: (F.col("__bin") >= s["low"]) & (F.col("__bin") < s["high"]) & (F.col("size") <= s["most"])
    extra = F.exists("steps", inside).cast("int")
    return (
        by_source(docs, per_source, "left")
        .withColumn("__bin", _bin(most))
        .withColumn("copies", (_whole(most) + extra).cast("int"))
        .drop("s", "__bin", "scale", "full", "lam", "steps")
    )


def mix(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The documents, each as often as the mix takes it (0 to ``most`` times), columns unchanged.

    ``docs`` has doc_id, text and source. A null text has no words; a null source
    is a source like others. Rows that agree in doc_id and text get the same
    decision. An empty table stays empty; documents without words are kept once.
    """
    columns = docs.columns
    narrow = lambda d: d.withColumns({"size": word_count(F.col("text")), "u": draw("doc_id", "text")})
    inner = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("__row"), "doc_id", "text", "source")
    per_source = plan(stash(narrow(docs.select("doc_id", "text", "source")).select("source", "size", "u")), weights, share, most)
    taken = copies(narrow(inner).drop("doc_id", "text"), per_source, most)
    times = F.when(F.col("size") == 0, 1).otherwise(F.col("copies"))
    return taken.select("__row", F.explode(F.array_repeat(F.lit(0), times)).alias("__n")).select("__row.*")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, its source's size and target, and the words and copies that the mix takes of every document.

    A null text has no words, a null source is one like others; rows that agree in id and text have one decision.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sizes = stash(
        docs.withColumns({"size": word_count(F.col("text")), "u": draw("doc_id", "text")}).drop("text")
    )
    mixed = copies(sizes, plan(sizes.drop("doc_id")))
    return mixed.select("doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
