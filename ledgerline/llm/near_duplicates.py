"""Near-duplicate classes by DartMinHash.

A document is the bag of its five-word shingles, weighted by their counts. Darts
are thrown, by hashing, at the plane of weight and rank over each shingle; a
document catches those below its weight. Each dart names one of DARTS coordinates, and the document
keeps the dart of lowest rank per coordinate. Two documents agree in a coordinate
with the probability of their weighted Jaccard similarity, as the darts below
both weights are the same darts. Work is in proportion to a document's shingles
plus DARTS * log(DARTS), not their product, and is done for many documents at once.

Signatures are cut into bands; documents that share a band meet in a bucket. In
a bucket every document is compared with one pivot, exactly. Those far from it are
compared with a second pivot, the member near most first pivots: in a group of
copies of one text that is the text itself. Linked documents form classes by
connected components. Where a bucket still holds several classes, its members of different classes are
compared with each other, in buckets of all sizes alike, unless an exact filter
says that they cannot be near. Shingles are put in one order, rare ones first. Of two texts
of sizes x and y with a similarity of at least LEAST, the first common shingle
in that order has at least LEAST / (1 + LEAST) * (x + y) shingles from it to the end in
both; pairs without a common shingle so early are left out. Copies of a text
that are far from it differ from it in more shingles than that leaves room for, so they
meet only if they have a difference in common. The filter loses no pair: what is missed are pairs that share
no band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_rows, connected_components, discard, shingles, stash, table, words

DARTS, ROWS = 192, 6  # 32 bands: a pair at similarity 0.8 shares none with probability 6e-5
LEAST = 0.8
#: Ends of the rank cells: darts of one cell are thrown together. The last length is used again for higher ranks.
CELLS = tuple(2.0**i for i in range(-7, 4))
#: Texts of an Arrow batch: their shingles are arrays, and a comparison has two of them.
TEXTS = 2000
#: Shingles whose darts are thrown together, if no single text has more.
AT_ONCE = 1 << 14


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply, twice)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _darts(regions: np.ndarray, cell: int, low: float, length: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(regions hit, dart names, ranks) in one rank cell of unit-weight regions; Poisson many in each."""
    seed = mixed(regions + np.uint64(0x9E3779B97F4A7C15 * (cell + 1) % 2**64))
    u = _uniform(seed)
    hit, names, chance, i = [], [], np.exp(-length), 0
    left, total = np.flatnonzero(u >= chance), chance
    while left.size:
        hit.append(left)
        names.append(mixed(seed[left] + np.uint64(0xD1B54A32D192ED03 * (i + 1) % 2**64)))
        i += 1
        chance *= length / i
        total += chance
        left = left[u[left] >= total] if chance > 1e-17 else left[:0]
    if not names:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0)
    name = np.concatenate(names)
    return np.concatenate(hit), name, low + length * _uniform(mixed(name ^ np.uint64(0x5851F42D4C957F2D)))


def signatures(grams: np.ndarray, sizes: np.ndarray, darts: int = DARTS) -> np.ndarray:
    """uint64 names of the earliest dart per text and coordinate; a row of zeros for no shingles.

    ``grams`` are the shingle hashes, with repeats, of one text after the other, ``sizes`` of
    them for each. The i-th occurrence of a shingle in a text is a region of weight from
    i-1 to i, so equal counts make equal regions.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((grams, owner))
    ordered = grams.astype(np.uint64)[order]  # owners stay in place
    starts = np.flatnonzero(np.concatenate(([True], (ordered[1:] != ordered[:-1]) | (owner[1:] != owner[:-1])))) if len(ordered) else np.empty(0, np.int64)
    nth = np.arange(len(ordered)) - np.repeat(starts, np.diff(np.append(starts, len(ordered))))
    best_rank, best_name = np.full(len(sizes) * darts, np.inf), np.zeros(len(sizes) * darts, np.uint64)
    with np.errstate(over="ignore"):
        regions = mixed(ordered + np.uint64(0xA0761D6478BD642F) * (nth.astype(np.uint64) + np.uint64(1)))
        cell, low = 0, 0.0
        while True:
            length = CELLS[cell] - low if cell < len(CELLS) else CELLS[-1]
            open_texts = (sizes > 0) & np.isinf(best_rank).reshape(-1, darts).any(1)  # later cells have higher ranks
            if not open_texts.any():
                return best_name.reshape(-1, darts)
            inside = open_texts[owner]
            here = owner[inside]
            hit, names, ranks = _darts(regions[inside], cell, low, length)
            at = here[hit] * darts + (names % np.uint64(darts)).astype(np.int64)
            better = ranks < best_rank[at]
            at, names, ranks = at[better], names[better], ranks[better]
            np.minimum.at(best_rank, at, ranks)
            best = ranks == best_rank[at]
            best_name[at[best]] = 0
            np.maximum.at(best_name, at[best], names[best])
            low, cell = low + length, cell + 1


def signature(grams: np.ndarray, darts: int = DARTS) -> np.ndarray | None:
    """The signature of one text; None for no shingles."""
    return signatures(grams, np.array([len(grams)]), darts)[0] if len(grams) else None


def band_keys(sigs: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """Of signatures, one for each row."""
    keys = np.zeros((len(sigs), sigs.shape[1] // rows), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(rows):
            keys = mixed(keys * np.uint64(31) + sigs[:, j::rows][:, : keys.shape[1]] + np.uint64(j))
        return mixed(keys + np.arange(keys.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("grams")
        flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        keys, first = [], 0
        while first < len(sizes):
            start = ends[first] - sizes[first]
            last = max(first + 1, int(np.searchsorted(ends, start + AT_ONCE, "right")))
            keys.append(band_keys(signatures(flat[start : ends[last - 1]], sizes[first:last])).astype(np.int64))
            first = last
        full = sizes > 0
        own = np.concatenate(keys)[full] if keys else np.empty((0, 1), np.int64)
        offsets = np.concatenate(([0], np.cumsum(full * own.shape[1]))).astype(np.int32)
        bands = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(own.ravel(), pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(sizes, pa.int64()), bands], ["id", "key", "size", "bands"])


def words_key(text: str) -> Column:
    """Equal for texts of the same words in the same order."""
    return F.sha2(F.array_join(words(F.col(text)), " "), 256)


def near_classes(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """(id, key, class, component) for each distinct (id, text) of ``docs`` (doc_id, text).

    ``key`` is a hash of the text's words. Texts with the same words are copies: one stands for all of
    them. Null and empty texts have no words and are copies of each other. Texts are told apart by their words
    and not by their ids, so a null or repeated id may stand in several classes: ``component`` names the class, and
    ``class`` is its smallest id, null if it has none. Repeated rows come out once; an empty table gives an empty one.
    """
    with arrow_rows(docs.sparkSession, TEXTS):
        return _classes(docs.select(F.col("doc_id").alias("id"), "text"), least)


def _classes(texts: DataFrame, least: float) -> DataFrame:
    signed = (
        texts.withColumn("__w", words(F.col("text")))
        .select("id", F.sha2(F.array_join("__w", " "), 256).alias("key"), shingles(F.col("__w")).alias("grams"))
        .mapInArrow(_bands, "id long, key string, size long, bands array<bigint>")
    )
    keyed = stash(signed)
    far_off = F.col("distance") > 1 - least + 1e-9
    # Equal keys have equal bands, so those of any copy will do. A node's number is drawn once, as its row is written, so no two texts share one.
    nodes = keyed.groupBy("key").agg(F.min("id").alias("id"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    nodes = stash(nodes.withColumn("rep", F.monotonically_increasing_id()))
    members = nodes.where("size > 0").select("rep", "id", "size", F.explode("bands").alias("band"))
    full = members.groupBy("band").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("rep", "band").alias("h"), "rep", "size")).alias("p")).where("n > 1")
    buckets = stash(members.join(full.select("band", F.col("p.rep").alias("pivot"), F.col("p.size").alias("pivot_size")), "band"))
    # The text of a node is read from a row of its smallest id; where it has no id, from one without.
    place = F.coalesce("id", F.xxhash64("key")).alias("place")
    bags = stash(
        texts.withColumn("key", words_key("text"))
        .select("key", place, "text")
        .join(nodes.join(buckets.select("rep").distinct(), "rep", "left_semi").select("rep", "key", place), ["key", "place"])
        .dropDuplicates(["rep"])
        .select(F.col("rep").alias("id"), words(F.col("text")).alias("__w"))
        .select("id", shingles(F.col("__w")).alias("grams"))
        .mapInArrow(_bags, "id long, grams array<bigint>")
    )

    def compared(pairs: DataFrame) -> DataFrame:
        """(a, b, distance) of (a, b, sa, sb), where the sizes sa and sb of both allow the similarity."""
        fit = F.least("sa", "sb") >= (least - 1e-9) * F.greatest("sa", "sb")
        return stash(distances(pairs.where(fit & (F.col("a") != F.col("b"))).select("a", "b").distinct(), bags))

    first = compared(buckets.select(F.col("rep").alias("a"), F.col("pivot").alias("b"), F.col("size").alias("sa"), F.col("pivot_size").alias("sb")))
    near_first = first.where(~far_off).select("a", "b")

    # Members far from their pivot against the member of their bucket that is near most first pivots.
    far = (
        buckets.where("rep <> pivot")
        .join(near_first.select(F.col("a").alias("rep"), F.col("b").alias("pivot")), ["rep", "pivot"], "left_anti")
        .select("band", "rep", "size", "pivot", "pivot_size")
    )
    far = stash(far)
    opened = buckets.join(far.select("band").distinct(), "band", "left_semi")
    degree = near_first.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("d"))
    best = (
        opened.join(degree, "rep", "left")
        .groupBy("band")
        .agg(F.max(F.struct(F.coalesce("d", F.lit(0)).alias("d"), F.xxhash64("rep").alias("h"), "rep", "size")).alias("q"))
        .select("band", F.col("q.rep").alias("b"), F.col("q.size").alias("sb"))
    )
    against = far.select("band", F.explode(F.array(F.struct(F.col("rep").alias("a"), F.col("size").alias("sa")), F.struct(F.col("pivot").alias("a"), F.col("pivot_size").alias("sa")))).alias("m"))
    second = compared(against.select("band", "m.a", "m.sa").distinct().join(best, "band"))
    linked = near_first.unionByName(second.where(~far_off).select("a", "b"))
    so_far = connected_components(linked)

    # Buckets of several classes: their members against those of other classes.
    placed = (
        opened.select("band", "rep", "size")
        .join(so_far.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
    )
    mixed_bands = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("band")
    placed = stash(placed.join(mixed_bands, "band", "left_semi"))
    third = compared(early_pairs(placed.select("rep", "size", "component").distinct(), bags, least))
    extra = third.where(~far_off).select("a", "b")
    classes = connected_components(so_far.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(extra))
    named = stash(
        nodes.select("rep", "key", "id")
        .join(classes.withColumnRenamed("node", "rep"), "rep", "left")
        .select("key", "id", F.coalesce("component", "rep").alias("component"))
    )
    discard(nodes, buckets, bags, first, far, second, placed, third)
    ids = named.groupBy("component").agg(F.min("id").alias("class"))
    named = named.drop("id").join(ids, "component")
    return keyed.select("id", "key").distinct().join(named, "key").select("id", "key", "class", "component")


def early_pairs(texts: DataFrame, bags: DataFrame, least: float) -> DataFrame:
    """(a, b, sa, sb), with repeats: all pairs of different components that can have the similarity ``least``.

    ``texts`` has rep, size and component. No pair of that similarity is left out, whatever the order of
    shingles; putting rare ones first leaves few others.
    """
    share = least / (1 + least)
    grams = texts.join(bags.withColumnRenamed("id", "rep"), "rep").select("rep", "size", "component", F.explode("grams").alias("gram"))
    # A shingle of one text only is common to no pair; such shingles come first in the order, and their number is enough.
    counts = grams.groupBy("gram").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    ordered = (
        grams.join(counts.where("n > 1"), "gram")
        .groupBy("rep", "size", "component")
        .agg(F.sort_array(F.collect_list(F.struct("n", "gram", (F.col("low") != F.col("high")).alias("open")))).alias("grams"))
    )
    # What is left from a shingle to the end bounds the common shingles, and so the size of the other text.
    early = stash(
        ordered.select("rep", "size", "component", F.size("grams").alias("m"), F.posexplode("grams").alias("i", "g"))
        .where("g.open")
        .select("rep", "size", "component", F.col("g.gram").alias("gram"), (F.col("m") - F.col("i")).alias("rest"))
        .where(F.col("rest") >= least * F.col("size") - 1e-6)
        .withColumn("most", F.col("rest") / share - F.col("size") + 1e-6)
    )
    # Two members of a shingle's largest component need no comparison, so one of each pair is of another.
    parts = early.groupBy("gram", "component").agg(F.count("*").alias("n"), F.min("size").alias("size"))
    grouped = parts.groupBy("gram").agg(
        F.max(F.struct("n", "component")).alias("large"), F.min("size").alias("smallest"), F.count("*").alias("k")
    )
    useful = early.join(grouped.where("k > 1").select("gram", "smallest", F.col("large.component").alias("large")), "gram").where("most >= smallest")
    one = useful.where("component <> large").select("gram", F.col("rep").alias("a"), F.col("size").alias("sa"), F.col("component").alias("ca"), F.col("most").alias("ma"))
    two = useful.select("gram", F.col("rep").alias("b"), F.col("size").alias("sb"), F.col("component").alias("cb"), F.col("most").alias("mb"))
    fit = (F.col("ca") != F.col("cb")) & (F.col("sb") <= F.col("ma")) & (F.col("sa") <= F.col("mb"))
    met = one.join(two, "gram").where(fit)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sa", "sb")


def distances(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """(a, b, distance): one less the exact weighted Jaccard similarity of shingle counts."""
    left = pairs.join(bags.withColumnRenamed("id", "a").withColumnRenamed("grams", "ga"), "a")
    both = left.join(bags.withColumnRenamed("id", "b").withColumnRenamed("grams", "gb"), "b").select("a", "b", "ga", "gb")
    return both.mapInArrow(_distances, "a long, b long, distance double")


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        one, two = batch.column("ga"), batch.column("gb")
        out = [_distance(one[i].values.to_numpy(), two[i].values.to_numpy()) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], ["a", "b", "distance"])


def _distance(x: np.ndarray, y: np.ndarray) -> float:
    """Of two arrays of numbered hashes."""
    both = np.sort(np.concatenate((x, y)))
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 1 - common / (len(both) - common)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bags = [_numbered(np.sort(grams.values.to_numpy())).view(np.int64) for grams in batch.column("grams")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(bags, pa.list_(pa.int64()))], ["id", "grams"])


def _numbered(x: np.ndarray) -> np.ndarray:
    """Of sorted hashes with repeats, a hash of each and of how many equal ones are before it."""
    first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    nth = np.arange(len(x)) - np.repeat(first, np.diff(np.append(first, len(x))))
    with np.errstate(over="ignore"):
        return mixed(x.astype(np.uint64) + np.uint64(0xA0761D6478BD642F) * (nth.astype(np.uint64) + np.uint64(1)))


def class_heads(classes: DataFrame) -> DataFrame:
    """(component, head): of each class the row that stays, by id; a null id only if there is no other."""
    return classes.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id", "key")).alias("head"))


def keep_one(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The documents without all but one of each class: the smallest id's row, columns unchanged.

    Of rows that repeat an id with the same text one stays. Null ids stay only where
    their class has no other.
    """
    columns = docs.columns
    heads = class_heads(near_classes(docs.select("doc_id", "text"), least))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("__row"), "doc_id", F.col("text").alias("__text"))
    keyed = rows.select("__row", "doc_id", words_key("__text").alias("__key"))
    # Copies are reduced before the shuffle; the join then needs no other.
    single = keyed.groupBy("__key").agg(F.min_by("__row", F.struct(F.col("doc_id").isNull(), "doc_id")).alias("__row"))
    return single.join(heads.select(F.col("head.key").alias("__key")), "__key", "left_semi").select("__row.*")


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, class_id and whether it is the one kept.

    Classes of null ids only have a null class_id; a repeated id may be the class_id of two.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    classes = near_classes(docs)
    kept = (F.col("key") == F.col("head.key")) & F.col("id").eqNullSafe(F.col("head.id"))
    return classes.join(class_heads(classes), "component").select(F.col("id").alias("doc_id"), F.col("class").alias("class_id"), kept.alias("kept"))
