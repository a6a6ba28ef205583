"""Quality of documents by hierarchical empirical Bayes.

A logistic classifier over hashed single words and pairs of words, and over counts of the whole text, gives each document's
evidence; it is fitted on a bounded sample of labelled rows. Evidence is averaged
by site and by path below it in grouped aggregation over all documents. A site's
mean is shrunk towards the global one and a path's towards its site's, the more
the fewer documents there are; the strength of both priors is estimated from
the spread between groups. A document's posterior log-odds are its evidence
plus what its path adds to the global log-odds.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import stash, table, words
from ledgerline.llm.quality_rules import text_counts

#: Rows that the classifier is fitted on at most, those of smallest hash of doc_id.
FIT_ROWS = 20_000
#: Buckets that words and pairs of words are hashed to.
BUCKETS = 512
FEATURES = {
    "log_words": "ln(1 + n_words)",
    "few_words": "cast(n_words < 10 as double)",
    "symbols": "least(coalesce(try_divide(n_symbols, n_words), 0), 2)",
    "any_symbols": "ln(1 + n_symbols)",
    "repeats": "coalesce(try_divide(n_repeat_words, n_words), 0)",
    "same_lines": "coalesce(try_divide(n_dup_lines, n_lines), 0)",
    "bangs": "least(coalesce(try_divide(n_bangs, n_words), 0), 2)",
    "plain": "coalesce(try_divide(n_plain, n_words), 0)",
    "stops": "least(coalesce(try_divide(n_stops, n_words), 0), 1)",
    "word_length": "least(coalesce(try_divide(word_chars, n_words), 0), 20) / 5",
}


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights, the constant last, by Newton steps with a ridge on the scaled features."""
    if not len(y):
        return np.zeros(x.shape[1] + 1)
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def logit(p: Column) -> Column:
    bounded = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(bounded / (1 - bounded))


def grams(word_array: Column) -> Column:
    """The bucket of each word and of each pair of neighbours. ``word_array`` must be a column of a table, not an expression."""
    single = F.transform(word_array, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))
    pairs = F.transform(word_array, lambda w, i: F.pmod(F.xxhash64(w, F.get(word_array, i + 1)), F.lit(BUCKETS)).cast("int"))
    return F.concat(single, F.slice(pairs, 1, F.greatest(F.size(word_array) - 1, F.lit(0))))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's grams as counts by bucket over the root of their number."""
    for batch in batches:
        bags = [np.bincount(g.values.to_numpy(), minlength=BUCKETS) / max(len(g.values), 1) ** 0.5 for g in batch.column("__grams")]
        kept = {n: batch.column(n) for n in batch.schema.names if n != "__grams"}
        yield pa.RecordBatch.from_pydict(kept | {"bag": pa.array([b.astype(np.float32) for b in bags], pa.list_(pa.float32()))})


def measured(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, site, path, ``more`` columns, FEATURES and __grams of every row."""
    with_words = docs.select("doc_id", "site", "path", *more, "text").withColumn("__words", words(F.col("text")))
    counted = text_counts(with_words.withColumn("__buckets", grams(F.col("__words"))).drop("__words"))
    return counted.select("doc_id", "site", "path", *more, *(F.expr(e).cast("double").alias(k) for k, e in FEATURES.items()), F.col("__buckets").alias("__grams"))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int) -> np.ndarray:
    """Weights of FEATURES, of the buckets, and the constant: from at most ``fit_rows`` labelled rows, which come to the driver."""
    chosen = (
        labels.where("quality in (0, 1) and doc_id is not null")
        .select("doc_id", F.col("quality").cast("double").alias("__y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "__y")
        .limit(fit_rows)
    )
    rows = measured(docs.select("doc_id", "site", "path", "text").join(F.broadcast(chosen), "doc_id"), "__y")
    first = rows.select("doc_id", "__y", *FEATURES, "__grams").orderBy(F.xxhash64("doc_id"), "doc_id", "__y", *FEATURES, F.xxhash64("__grams")).limit(fit_rows)
    schema = ", ".join(["doc_id bigint", "__y double", *(f"{k} double" for k in FEATURES), "bag array<float>"])
    found = first.mapInArrow(_bags, schema).toArrow()
    plain = np.column_stack([found.column(k).to_numpy() for k in FEATURES]).reshape(-1, len(FEATURES))
    bags = found.column("bag").combine_chunks().flatten().to_numpy().reshape(-1, BUCKETS).astype(float)
    data, y = np.hstack([plain, bags]), found.column("__y").to_numpy()
    order = np.lexsort((*data[:, : len(FEATURES)].T, y, found.column("doc_id").to_numpy()))  # the same fit in any order of rows
    return fit_logistic(data[order], y[order])


def _strength(groups: DataFrame, mean: str, prior: Column, n: str) -> float:
    """Documents that a prior is worth, by moments of the group means around it: between 1 and 10,000."""
    inside = F.sum(F.col(n) * F.col(mean) * (1 - F.col(mean)))
    around = F.sum(F.col(n) * (F.col(mean) - prior) * (F.col(mean) - prior))
    row = groups.agg(inside.alias("a"), around.alias("b"), F.sum(n).alias("n"), F.count("*").alias("k")).first()
    if not row["n"] or not row["b"]:
        return 10_000.0
    within, between = row["a"] / row["n"], row["b"] / row["n"]
    between -= within * row["k"] / row["n"]
    return float(min(max(within / between if between > 0 else 10_000.0, 1.0), 10_000.0))


def classify(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, least: float = 0.5) -> DataFrame:
    """doc_id, evidence, path_mean, quality and kept (quality >= least) for every row.

    ``docs`` has doc_id, text, site and path (null is a group like others); ``labels`` has doc_id and quality
    (0 or 1; other values are left out). Null and empty texts have zero counts. Without labels all evidence
    is 0.5 and everything is kept. Rows are never dropped; an empty table stays empty. Repeated rows come out as often as they
    are and count as often in their site's and path's means; a document with several labels stands in the fit once for each. Whole texts of any length;
    further columns are not passed on, whatever their names.
    """
    weights = fit(docs, labels, fit_rows)
    score = F.lit(float(weights[-1]))
    for name, weight in zip(FEATURES, weights):
        score = score + F.col(name) * float(weight)
    by_bucket = F.from_json(F.lit(json.dumps(list(map(float, weights[len(FEATURES) : -1])))), "array<double>")
    of_grams = F.aggregate("__grams", F.lit(0.0), lambda total, b: total + F.get(by_bucket, b))
    score = score + of_grams / F.sqrt(F.greatest(F.size("__grams"), F.lit(1)))
    scored = stash(measured(docs).select("doc_id", "site", "path", score.alias("score")))
    scored = scored.withColumn("evidence", 1 / (1 + F.exp(-F.least(F.greatest("score", F.lit(-30.0)), F.lit(30.0)))))

    exact = F.sum(F.col("evidence").cast("decimal(20,9)"))  # decimals: the same sum in any order
    paths = stash(scored.groupBy("site", "path").agg(F.count("*").alias("n"), exact.cast("double").alias("total")))
    paths = paths.withColumn("mean", F.col("total") / F.col("n"))
    sites = paths.groupBy("site").agg(F.sum("n").alias("sn"), F.sum("total").alias("st")).withColumn("smean", F.col("st") / F.col("sn"))
    whole = sites.agg(F.sum("sn").alias("n"), F.sum("st").alias("t")).first()
    top = whole["t"] / whole["n"] if whole["n"] else 0.5
    k_site = _strength(sites, "smean", F.lit(top), "sn")
    sites = sites.withColumn("sprior", (F.col("st") + k_site * top) / (F.col("sn") + k_site)).withColumnRenamed("site", "__site")
    joined = paths.join(sites, F.col("site").eqNullSafe(F.col("__site"))).drop("__site")
    k_path = _strength(joined, "mean", F.col("sprior"), "n")
    means = joined.select(
        F.col("site").alias("__site"),
        F.col("path").alias("__path"),
        ((F.col("total") + k_path * F.col("sprior")) / (F.col("n") + k_path)).alias("path_mean"),
    )
    on = F.col("site").eqNullSafe(F.col("__site")) & F.col("path").eqNullSafe(F.col("__path"))
    shift = logit(F.col("path_mean")) - logit(F.lit(float(top)))
    return (
        scored.join(means, on, "left")
        .withColumn("quality", F.round(1 / (1 + F.exp(-(F.col("score") + shift))), 6))
        .select("doc_id", F.round("evidence", 6).alias("evidence"), F.round("path_mean", 6).alias("path_mean"), "quality", (F.col("quality") >= least).alias("kept"))
    )


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source as the site and language as the path below it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("site"), F.col("lang").alias("path"))
    return classify(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
