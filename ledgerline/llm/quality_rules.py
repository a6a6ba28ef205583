"""Quality rules combined by weak supervision.

Rules look at counts of a whole text and vote good (1), bad (-1) or abstain (0).
Expectation-maximisation over all documents estimates how often each rule gives
each vote on good and on bad documents; a document's posterior probability of
being good replaces the demand that it passes every rule.

Votes depend on a document only through its pattern, one of at most 3^9 = 19683.
Spark counts the patterns over all documents (map-side combined), so the
iterations work on a table whose size does not depend on the corpus, and the
posterior of every document is then one lookup of its pattern.
"""

from __future__ import annotations

from math import exp, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import NOT_WHITE, shingles, stash, table, text_or_empty, words

#: (name, votes bad where, votes good where) over the columns of text_counts().
RULES = (
    ("length", "n_words < 10", "n_words >= 40"),
    ("word_length", "word_chars < 2.5 * n_words or word_chars > 15 * n_words", "word_chars between 3.5 * n_words and 9 * n_words"),
    ("symbols", "n_symbols > 0.25 * n_words", "n_symbols <= 0.01 * n_words"),
    ("symbol_share", "n_symbols > 0.04 * word_chars", "n_symbols <= 0.002 * word_chars"),
    ("plain_words", "n_plain < 0.6 * n_words", "n_plain >= 0.9 * n_words"),
    ("repetition", "100 * n_repeat_words > 20 * n_words", "100 * n_repeat_words <= 2 * n_words"),
    ("lines", "n_dup_lines > 0.3 * n_lines", "n_dup_lines = 0 and n_lines > 1"),
    ("shouting", "n_bangs > 0.2 * n_words", "n_bangs <= 0.01 * n_words"),
    ("sentences", "n_words >= 10 and n_stops < 0.005 * n_words", "n_stops between 0.03 * n_words and 0.4 * n_words"),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bangs", "n_plain", "n_stops")
BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"
#: Prior rates of bad, abstaining and good votes on good and on bad documents, prior share of good ones, weight of priors by document.
GOOD_PRIOR, BAD_PRIOR, SHARE, STRENGTH = (0.04, 0.26, 0.70), (0.50, 0.30, 0.20), 0.8, 0.05
#: Iterations end when no posterior moves by SETTLED, after ROUNDS at most; documents of at least LEAST are kept.
ROUNDS, SETTLED, LEAST = 100, 1e-9, 0.5


def _removed(text: Column, pattern: str) -> Column:
    """Characters of ``text`` that ``pattern`` matches."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _without(text: Column, part: str) -> Column:
    """Occurrences of a fixed string."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("bigint")


def text_counts(docs: DataFrame, text: str = "text", k: int = 5) -> DataFrame:
    """Adds COUNTS (long) and base_failed for every row; a null text counts as empty."""
    value = text_or_empty(F.col(text))
    lines = F.filter(F.split(value, "\n"), lambda x: x.rlike(NOT_WHITE))
    n = F.size("__w")
    counted = docs.withColumns({"__w": words(F.col(text)), "__lines": lines}).withColumns(
        {
            "n_words": n.cast("bigint"),
            "word_chars": F.length(F.array_join("__w", "")).cast("bigint"),
            "n_symbols": _removed(value, r"[#*$%&|<>]+").cast("bigint"),
            "n_lines": F.size("__lines").cast("bigint"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
            "n_bangs": _without(value, "!!"),
            "n_plain": F.regexp_count(value, F.lit(rf"(?<!{NOT_WHITE})[\p{{L}}'’-]++[.,;:?!]?+(?!{NOT_WHITE})")).cast("bigint"),
            "n_stops": _without(value, "."),
            "__grams": F.when(n >= k, shingles(F.col("__w"), k)).otherwise(F.array().cast("array<bigint>")),
        }
    )
    # Most texts repeat no window: only the others sort positions.
    none = F.array().cast("array<int>")
    some = F.size(F.array_distinct("__grams")) < F.size("__grams")
    sorted_grams = F.sort_array(F.transform("__grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    equal = lambda x, j: F.equal_null(F.get("__spots", j)["g"], x["g"])
    repeated = F.filter("__spots", lambda x, j: ((j > 0) & equal(x, j - 1)) | equal(x, j + 1))
    starts = F.sort_array(F.transform(repeated, lambda x: x["i"]))
    covered = F.aggregate(
        F.transform("__starts", lambda p, j: F.least(F.lit(k), F.coalesce(F.get("__starts", j + 1), p + k) - p)),
        F.lit(0).cast("bigint"),
        lambda total, x: total + x,
    )
    return (
        counted.withColumn("__spots", F.when(some, sorted_grams).otherwise(F.array().cast("array<struct<g:bigint,i:int>>")))
        .withColumn("__starts", F.when(F.size("__spots") > 0, starts).otherwise(none))
        .withColumn("n_repeat_words", F.when(F.size("__starts") > 0, covered).otherwise(F.lit(0).cast("bigint")))
        .withColumn("base_failed", F.expr(BASE_FAILED))
        .drop("__w", "__lines", "__grams", "__spots", "__starts")
    )


def vote_pattern() -> Column:
    """Base-3 number of the votes: digit 0 bad, 1 abstain, 2 good, first rule lowest."""
    total = F.lit(0)
    for j, (_, bad, good) in enumerate(RULES):
        total = total + F.expr(f"case when {bad} then 0 when {good} then 2 else 1 end") * (3**j)
    return total.cast("int")


def _digits(pattern: int) -> list[int]:
    return [pattern // 3**j % 3 for j in range(len(RULES))]


def fit(patterns: dict[int, int], rounds: int = ROUNDS, strength: float = STRENGTH) -> dict[int, float]:
    """Posterior probability of good for each vote pattern, from counts of patterns.

    Starts from the balance of votes. ``strength`` times the number of documents
    is the weight of a prior that good documents get good votes and bad ones bad
    votes, which keeps the two classes from trading places. No patterns: {}.
    """
    total = sum(patterns.values())
    if not total:
        return {}
    votes = {p: _digits(p) for p in patterns}
    post = {}
    for p, d in votes.items():
        good, bad = d.count(2), d.count(0)
        post[p] = (1 + good) / (2 + good + 3 * bad)
    prior = {1: GOOD_PRIOR, 0: BAD_PRIOR}
    weight = strength * total + 1
    for _ in range(rounds):
        share, rates = 0.0, {0: [], 1: []}
        for side in (0, 1):
            mass = {p: n * (post[p] if side else 1 - post[p]) for p, n in patterns.items()}
            whole = sum(mass.values())
            if side:
                share = min(max((whole + SHARE * weight) / (total + weight), 1e-6), 1 - 1e-6)
            for j in range(len(RULES)):
                got = [weight * x for x in prior[side]]
                for p, m in mass.items():
                    got[votes[p][j]] += m
                rates[side].append([log(x / (whole + weight)) for x in got])
        new = {}
        for p, d in votes.items():
            odds = log(share / (1 - share)) + sum(rates[1][j][v] - rates[0][j][v] for j, v in enumerate(d))
            new[p] = 1 / (1 + exp(-max(min(odds, 500), -500)))
        moved = max(abs(new[p] - post[p]) for p in new)
        post = new
        if moved < SETTLED:
            break
    return post


def judge(docs: DataFrame, text: str = "text", least: float = LEAST, keep_text: bool = True) -> DataFrame:
    """Adds COUNTS, base_failed, quality (posterior, 6 decimals) and kept to every row.

    kept is false where base_failed, else quality >= least. Rows are never dropped;
    null, empty, repeated and very long texts are rows like others; an empty table
    stays empty. Columns of ``docs`` with the added names are replaced. The counts
    are made once and written to the shared folder, with the text only if it is
    kept.
    """
    spark = docs.sparkSession
    docs = docs.drop(*(set(docs.columns) - {text}) & {*COUNTS, "base_failed", "quality", "kept"})
    counted = text_counts(docs, text).withColumn("__p", vote_pattern())
    counted = stash(counted if keep_text else counted.drop(text))
    patterns = {r["__p"]: r["count"] for r in counted.groupBy("__p").count().collect()}  # at most 3^9 rows
    rows = [(p, round(q, 6)) for p, q in fit(dict(sorted(patterns.items()))).items()]
    lookup = spark.createDataFrame(rows, "__p int, quality double")
    return (
        counted.join(F.broadcast(lookup), "__p", "left")
        .drop("__p")
        .withColumn("kept", ~F.col("base_failed") & (F.coalesce("quality", F.lit(0.0)) >= least))
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """judge() of all documents, without their texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, keep_text=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )
