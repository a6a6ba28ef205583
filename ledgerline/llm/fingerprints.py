"""Document fingerprints by winnowing.

Tokens are words, each hashed once; a gram is the polynomial hash of five words' hashes in a row (Karp and Rabin's), so the words
themselves are not read again. Of each window of eight grams the smallest hash is kept, the rightmost of equal ones, with its
position. Two texts that share a run of at least 12 words (window + gram - 1)
share a fingerprint of it, and nothing shorter than a gram can match.
"""

from __future__ import annotations

import json
from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stash, table, text_or_empty, words

GRAM, WINDOW = 5, 8
#: Hash and position share a long: 36 and 28 bits.
PLACES = 2**28 - 1
#: A prime and the base of the polynomial: a product of a hash below the first and the second fits a long.
PRIME, BASE = 2**36 - 5, 94_906_267
#: Buckets of documents at most; their first documents are broadcast.
MOST_BUCKETS = 2**16
#: Keys for each bucket that its bounds are chosen from.
SAMPLED = 8


def rolled(word_hashes: Column, k: int = GRAM) -> Column:
    """64-bit hashes of all runs of ``k`` words from the words' hashes.

    A text of 1 to k-1 words has one gram, all its words; an empty text none. ``word_hashes`` must be a column
    of a table, not an expression, as every element refers to it.
    """

    def run(w: Column, i: Column) -> Column:
        value = w
        for j in range(1, k):
            following = F.get(word_hashes, i + j)
            value = F.when(following.isNull(), value).otherwise((value * BASE + following) % PRIME)
        return F.xxhash64(value)

    n = F.size(word_hashes)
    return F.slice(F.transform(word_hashes, run), 1, F.when(n < k, F.least(n, F.lit(1))).otherwise(n - (k - 1)))


def hashed_words(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.pmod(F.xxhash64(w), F.lit(PRIME)))


def keyed(grams: Column) -> Column:
    """Longs that sort by hash, then from right to left."""
    return F.transform(grams, lambda g, i: g.bitwiseAND(F.lit(~PLACES)).bitwiseOR(F.lit(PLACES) - i.cast("bigint")))


def winnowed(keys: str, window: int) -> Column:
    """The kept keys in order of position. Fewer grams than a window: one window of all of them."""
    lowest = F.transform(keys, lambda x, i: F.least(x, *(F.get(keys, i + j) for j in range(1, window))))
    n = F.size(keys)
    return F.array_distinct(F.slice(lowest, 1, F.when(n < window, F.least(n, F.lit(1))).otherwise(n - (window - 1))))


def with_fingerprint(df: DataFrame, text: str, name: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Adds array<bigint> ``name``: packed hashes and positions of the text's fingerprint.

    Null and empty texts have an empty one; texts of fewer words than a gram have
    the hash of all their words.
    """
    return (
        df.withColumn("__w", hashed_words(F.col(text)))
        .withColumn("__g", rolled(F.col("__w"), gram))
        .withColumn("__k", keyed(F.col("__g")))
        .withColumn(name, winnowed("__k", window))
        .drop("__w", "__g", "__k")
    )


def hashes(fingerprint: str) -> Column:
    return F.array_distinct(F.transform(fingerprint, lambda x: F.shiftrightunsigned(x, 28)))


def written(fingerprint: str) -> Column:
    """``position:hash`` of each kept gram, comma-joined; positions count words from 0."""
    return F.array_join(
        F.transform(
            fingerprint,
            lambda x: F.concat((F.lit(PLACES) - x.bitwiseAND(F.lit(PLACES))).cast("string"), F.lit(":"), F.hex(F.shiftrightunsigned(x, 28))),
        ),
        ",",
    )


def likeness(a: str, b: str) -> Column:
    """Share of the hashes of both that are common (Jaccard); two empty fingerprints are alike."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, 1.0).otherwise(common / union)


#: What documents are ordered by: null ids last, then ids downwards, then the texts' hashes.
KEY = "struct<n:int,id:bigint,h:bigint>"


def order_key() -> Column:
    return F.struct(F.col("doc_id").isNull().cast("int").alias("n"), F.coalesce(F.bitwise_not(F.col("doc_id").cast("bigint")), F.lit(0)).alias("id"), F.xxhash64("text").alias("h"))


def place_in(bounds: list[tuple], key: Column) -> Column:
    """How many of the sorted bounds are at or below a key: found in one part of them, by the parts' first ones."""
    width = isqrt(max(len(bounds) - 1, 0)) + 1
    parts = [bounds[i : i + width] for i in range(0, len(bounds), width)] or [[]]
    written = lambda x: json.dumps(x, separators=(",", ":"))
    named = lambda b: dict(zip(("n", "id", "h"), b))
    starts = F.from_json(F.lit(written([named(p[0]) for p in parts if p])), f"array<{KEY}>")
    all_parts = F.from_json(F.lit(written([[named(b) for b in p] for p in parts])), f"array<array<{KEY}>>")
    part = F.greatest(F.size(F.filter(starts, lambda b: b <= key)) - 1, F.lit(0))
    return part * width + F.size(F.filter(F.get(all_parts, part), lambda b: b <= key))


def neighbourhoods(docs: DataFrame, per_bucket: int = 64, most_buckets: int = MOST_BUCKETS) -> DataFrame:
    """Lays documents out so that each stands in one bucket with the next by descending doc_id.

    ``docs`` has doc_id and text. Adds __key, the order, __b, the bucket, and __guest: the first
    document of each bucket is also a guest of the bucket before it (of the last,
    for the first bucket), so a window over one bucket finds every next document
    and the texts are shuffled once. Buckets hold about equally many documents, however their ids lie and repeat: their bounds are
    quantiles of the keys, from a sample of a bounded number of them, which decides nothing else. Rows that agree in id
    and text have one key and stand together. Null ids come last.
    """
    keys = stash(docs.select(order_key().alias("k")))
    n = keys.count()
    buckets = max(1, min(ceil(n / per_bucket), most_buckets))
    share = min(1.0, SAMPLED * buckets / max(n, 1))
    sampled = sorted(tuple(r) for r in keys.sample(share, seed=1).select("k.*").limit(2 * SAMPLED * buckets).collect())
    bounds = sorted({sampled[len(sampled) * i // buckets] for i in range(1, buckets)}) if sampled else []
    heads = keys.groupBy(place_in(bounds, F.col("k")).alias("__bucket")).agg(F.min("k").alias("__key"))
    order = Window.orderBy("__bucket")  # at most most_buckets narrow rows
    before = F.coalesce(F.lag("__bucket").over(order), F.max("__bucket").over(Window.partitionBy()))
    heads = heads.select(F.col("__bucket").alias("__head"), F.col("__key").alias("__first"), before.alias("__before"))
    placed = docs.withColumn("__key", order_key()).withColumn("__bucket", place_in(bounds, F.col("__key")))
    spread = placed.join(F.broadcast(heads), (F.col("__bucket") == F.col("__head")) & (F.col("__key") == F.col("__first")), "left")
    own = F.struct(F.col("__bucket").alias("b"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("__before").alias("b"), F.lit(True).alias("guest"))
    spread = spread.withColumn("__at", F.explode(F.when(F.col("__before").isNull(), F.array(own)).otherwise(F.array(own, guest))))
    return spread.select(*docs.columns, "__key", F.col("__at.b").alias("__b"), F.col("__at.guest").alias("__guest"))


def compare(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every row of ``docs`` (doc_id, text).

    The edited text has its last third replaced by the start of the next document's, by descending doc_id, after the last the first; equal
    ids go by their texts' hashes, null ids last. Null texts count as empty; two empty fingerprints are alike. Repeated rows come out as often as they
    are; an empty table stays empty. Whole texts of any length; further columns of ``docs`` are left out, whatever their names.
    """
    plain = docs.select("doc_id", text_or_empty(F.col("text")).alias("text"))
    placed = with_fingerprint(neighbourhoods(plain).repartition("__b"), "text", "print")
    ahead = Window.partitionBy("__b").orderBy("__guest", "__key", "text")
    pairs = placed.withColumns({"next_text": F.lead("text").over(ahead), "next_print": F.lead("print").over(ahead)}).where("not __guest")
    n = F.length("text")
    part = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - part), F.substring(F.col("next_text"), F.lit(1), part))
    both = with_fingerprint(pairs.withColumn("edited", edited).withColumn("n_chars", n.cast("bigint")).drop("text", "next_text"), "edited", "edited_print")
    sets = both.withColumns({"__a": hashes("print"), "__e": hashes("edited_print"), "__n": hashes("next_print")})
    return sets.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written("print").alias("fingerprint"),
        written("edited_print").alias("edited_fingerprint"),
        likeness("__a", "__e").alias("near_edited"),
        likeness("__a", "__n").alias("near_next"),
    )


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """compare() of all documents."""
    return compare(table(spark, sf_dir, "documents"))
