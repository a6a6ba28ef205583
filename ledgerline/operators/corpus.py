"""File corpora: what changed since the last manifest, chunks, and nearest vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The file types that are indexed.
SUFFIXES = (".txt", ".md", ".pdf", ".docx", ".csv", ".json", ".yaml", ".yml", ".xml", ".html", ".htm", ".log", ".py", ".sql", ".rst")


def manifest_diff(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """(path, state): new, changed, unchanged or removed, from tables of path and sha256."""
    now = files.select("path", F.col("sha256").alias("__now"))
    then = manifest.select("path", F.col("sha256").alias("__then"))
    state = (
        F.when(F.col("__then").isNull(), "new")
        .when(F.col("__now").isNull(), "removed")
        .when(F.col("__now") == F.col("__then"), "unchanged")
        .otherwise("changed")
    )
    return now.join(then, "path", "full").select("path", state.alias("state"))


def removed(files: DataFrame, manifest: DataFrame) -> DataFrame:
    return manifest.join(files.select("path"), "path", "left_anti")


def supported(path: Column) -> Column:
    """Whether a file is indexed: a known suffix and no name that starts with a dot."""
    name = F.lower(F.regexp_extract(path, r"([^/]*)$", 1))
    known = F.lit(False)
    for suffix in SUFFIXES:
        known = known | name.endswith(suffix)
    return known & ~name.startswith(".")


def file_id(path: Column, sha256: Column) -> Column:
    """A readable and unique id: the path in plain characters and the start of the content's hash."""
    return F.concat(F.trim(F.regexp_replace(path, r"[^A-Za-z0-9]+", "-"), F.lit("-")), F.lit("-"), F.substring(sha256, 1, 16))


def sync_plan(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """(path, action, sha256, file_id, old_file_id) of every path in ``files`` (path, sha256) or ``manifest`` (path, sha256, file_id).

    index: new or changed; skip: as it was; remove: gone, or no longer of a supported type; unsupported: never indexed. ``old_file_id`` is what is to be deleted.
    """
    now = files.select("path", "sha256", F.lit(True).alias("__there"))
    then = manifest.select("path", F.col("sha256").alias("__sha"), F.col("file_id").alias("__id"))
    both = now.join(then, "path", "full")
    there, known, good = F.col("__there").isNotNull(), F.col("__sha").isNotNull(), supported(F.col("path"))
    same = there & known & (F.col("sha256") == F.col("__sha"))
    action = F.when(known & ~(there & good), "remove").when(~good, "unsupported").when(same, "skip").otherwise("index")
    own = F.when(action == "index", file_id(F.col("path"), F.col("sha256"))).when(action == "skip", F.col("__id"))
    old = F.when((action == "remove") | (action == "index"), F.col("__id"))
    return both.select("path", action.alias("action"), "sha256", own.alias("file_id"), old.alias("old_file_id"))


def sync_report(plan: DataFrame, results: DataFrame) -> DataFrame:
    """(path, state, file_id, error): indexed, skipped, removed, unsupported or failed, from ``results`` (path, error) of what was to be indexed.

    A path without a result has failed as well: nobody knows that it is indexed. Of several results of a path an error counts.
    """
    outcome = results.groupBy("path").agg(F.max("error").alias("error"), F.lit(True).alias("__tried"))
    met = plan.join(outcome, "path", "left")
    tried, to_do = F.col("__tried").isNotNull(), F.col("action") == "index"
    wrong = F.when(to_do, F.coalesce("error", F.when(~tried, "no result")))
    done = F.when(wrong.isNotNull(), "failed").when(to_do, "indexed").when(F.col("action") == "skip", "skipped").when(F.col("action") == "remove", "removed").otherwise("unsupported")
    return met.select("path", done.alias("state"), "file_id", wrong.alias("error"), "sha256")


def synced_manifest(report: DataFrame) -> DataFrame:
    """The manifest after a run: what is indexed or was skipped. A failed path has no entry, so the next run tries it again."""
    kept = report.where(F.col("state").isin("indexed", "skipped"))
    return kept.select("path", "sha256", "file_id")


def chunks(docs: DataFrame, text: str = "text", size: int = 1500, overlap: int = 100) -> DataFrame:
    """A row per stretch of ``size`` characters, each starting ``overlap`` before the end of the one before."""
    step = size - overlap
    count = F.greatest(F.lit(1), F.ceil((F.length(text) - overlap) / step)).cast("int")
    spread = docs.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), count - 1)))
    return spread.withColumn("chunk", F.substring(F.col(text), F.col("chunk_no") * step + 1, F.lit(size))).drop(text)


def nearest(vectors: DataFrame, query: list[float] | Column, k: int, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k vectors of highest cosine similarity to one query, such as a scalar subquery; equal ones by id."""
    given = query.cast("array<double>") if isinstance(query, Column) else F.array(*(F.lit(float(x)) for x in query))
    vectors, q = vectors.select(id, vector, given.alias("__q")), F.col("__q")
    add = lambda a, x: a + x
    dot = F.aggregate(F.zip_with(F.col(vector), q, lambda a, b: a.cast("double") * b), F.lit(0.0), add)
    norm = lambda c: F.sqrt(F.aggregate(F.transform(c, lambda a: a.cast("double") * a.cast("double")), F.lit(0.0), add))
    similarity = F.round(F.try_divide(dot, norm(F.col(vector)) * norm(q)).cast("decimal(38,6)"), 4).cast("double")
    return vectors.select(id, similarity.alias("similarity")).orderBy(F.desc_nulls_last("similarity"), id).limit(k)
