"""Many nearest-vector searches at once, against an index of lists.

Centroids are fitted on a bounded sample. Every vector goes to the list of its nearest centroid; a query is compared with the lists whose centroids are nearest to
it. A list is cut into as many parts as its vectors fill, by a hash of the id, so a list that many vectors share is many tasks' work. In exact mode lists play no part: all vectors are dealt to
parts. Queries meet a part in blocks, as products of matrices of bounded size, and only the best of each query leave it.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import written

#: Vectors of the sample for each centroid, and of a part of a list.
SAMPLED, PART = 64, 4096
#: Vectors of a part in exact mode, queries that meet a part at once, and numbers of a matrix that is made of them.
SEARCHED, ASKED, CELLS = 16384, 16384, 1 << 20
#: Centroids at most: they are sent to every task.
MOST_LISTS = 4096


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; zeros stay."""
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(lengths > 0, lengths, 1)


def matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.to_list(), np.float64) if len(column) else np.empty((0, 1))


def nearest(points: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and likeness of the centroid that is nearest to each point."""
    step = max(1, CELLS // len(found))
    pairs = [(b.argmax(1), b.max(1)) for b in (points[k : k + step] @ found.T for k in range(0, len(points), step))]
    return np.concatenate([n for n, _ in pairs]), np.concatenate([m for _, m in pairs])


def highest(asked: np.ndarray, stored: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, stored vector, similarity) of the k stored vectors that are most like each query, equal ones as they stand."""
    step, out = max(1, CELLS // len(stored)), []
    for start in range(0, len(asked), step):
        likeness = np.round(asked[start : start + step] @ stored.T, 4) + 0.0
        width = likeness.shape[1]
        least = np.partition(likeness, width - k, axis=1)[:, width - k, None] if width > k else -np.inf
        query, at = np.nonzero(likeness >= least)
        order = np.lexsort((at, -likeness[query, at], query))
        query, at = query[order], at[order]
        best = np.arange(len(query)) - np.searchsorted(query, query) < k
        query, at = query[best], at[best]
        out.append((query + start, at, likeness[query, at]))
    return tuple(np.concatenate(c) for c in zip(*out))


def centroids(sample: np.ndarray, lists: int, rounds: int = 12, seed: int = 1) -> np.ndarray:
    """Spherical k-means over a sample that fits in memory; a centroid that loses all its vectors starts again at the vector that is worst served."""
    rng = np.random.default_rng(seed)
    points = unit(sample)
    found = points[rng.choice(len(points), min(lists, len(points)), replace=False)]
    for _ in range(rounds):
        near, best = nearest(points, found)
        sums = np.zeros_like(found)
        np.add.at(sums, near, points)
        for empty in np.flatnonzero(np.bincount(near, minlength=len(found)) == 0):
            worst = int(best.argmin())
            sums[empty], best[worst] = points[worst], np.inf
        found = unit(sums)
    return found


class VectorIndex:
    """Lists of ``vectors`` (id, vector array). Rows without a vector are left out; all vectors have one length."""

    def __init__(self, vectors: DataFrame, id: str, vector: str, lists: int | None = None, seed: int = 1):
        known = vectors.where(F.col(vector).isNotNull()).select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        self.rows = known.count()
        self.lists = min(lists or max(1, round(self.rows**0.5)), MOST_LISTS)
        wanted = SAMPLED * self.lists
        share = min(1.0, 1.2 * wanted / max(self.rows, 1))
        sample = known.sample(share, seed=seed).limit(wanted).select("vector").toPandas()["vector"]
        if not len(sample):
            sample = known.limit(wanted).select("vector").toPandas()["vector"]
        self.centroids = centroids(matrix(sample), self.lists, seed=seed) if len(sample) else np.empty((0, 1))
        lists = written(self._near(known, 1).select("id", "vector", F.get("lists", F.lit(0)).alias("list")))
        parts = [(r["list"], ceil(r["count"] / PART)) for r in lists.groupBy("list").count().collect()]  # a row for each list
        self.parts = max((n for _, n in parts), default=1)
        self.sizes = vectors.sparkSession.createDataFrame(parts, "list int, parts int")
        self.vectors = lists.join(F.broadcast(self.sizes), "list").select("id", "vector", "list", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"))

    def _near(self, rows: DataFrame, most: int) -> DataFrame:
        """(id, vector, lists) with the ``most`` nearest lists of each row, the nearest first."""
        found = self.centroids

        def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch) or not len(found):
                    continue
                points = unit(matrix(batch["vector"]))
                if most == 1:
                    lists = nearest(points, found)[0][:, None]
                else:
                    step = max(1, CELLS // len(found))
                    lists = np.concatenate([np.argsort(-(points[k : k + step] @ found.T), axis=1, kind="stable")[:, :most].astype(np.int32) for k in range(0, len(points), step)])
                yield batch.assign(lists=list(lists.astype(np.int32)))

        return rows.select("id", "vector").mapInPandas(near, f"id {rows.schema['id'].dataType.simpleString()}, vector array<double>, lists array<int>")

    def search(self, queries: DataFrame, id: str, vector: str, k: int = 10, probes: int | None = 8) -> DataFrame:
        """(query, id, similarity, place) of the k vectors of highest cosine similarity to each query, equal ones by id; ``probes``: lists that are searched, None for an exact search.

        A query without a vector has no result; a query that is one of the vectors finds itself. Similarities are rounded to 4 places, by which they are ordered.
        """
        asked = queries.where(F.col(vector).isNotNull()).select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        kind, own = asked.schema["id"].dataType.simpleString(), self.vectors.schema["id"].dataType.simpleString()
        numbers = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        if probes:
            near = self._near(asked, min(probes, max(len(self.centroids), 1))).select("id", "vector", F.explode("lists").alias("list"))
            spread, cell = near.join(F.broadcast(self.sizes), "list").withColumn("part", numbers(F.col("parts"))).drop("parts"), ["list", "part", "block"]
            stored = self.vectors
        else:
            parts = max(1, ceil(self.rows / SEARCHED))
            spread, cell = asked.withColumn("part", numbers(F.lit(parts))), ["part", "block"]
            stored = self.vectors.select("id", "vector", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"))
        blocks = max(1, ceil(asked.count() / ASKED))
        spread = spread.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int"))
        stored = stored.withColumn("block", numbers(F.lit(blocks)))

        def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame({"query": [], "id": [], "similarity": []})
            right = right.sort_values("id")
            query, at, likeness = highest(unit(matrix(left["vector"])), unit(matrix(right["vector"])), k)
            return pd.DataFrame({"query": left["id"].to_numpy()[query], "id": right["id"].to_numpy()[at], "similarity": likeness})

        found = spread.groupBy(*cell).cogroup(stored.groupBy(*cell)).applyInPandas(best, f"query {kind}, id {own}, similarity double")
        # At most k from each part that a query met.
        ordered = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("similarity")).alias("far"), "id"))), 1, k)
        placed = found.groupBy("query").agg(ordered.alias("__best")).select("query", F.posexplode("__best").alias("place", "b"))
        return placed.select("query", F.col("b.id").alias("id"), (-F.col("b.far")).alias("similarity"), (F.col("place") + 1).alias("place"))

    def probes_for(self, queries: DataFrame, id: str, vector: str, k: int = 10, least: float = 0.95, most: int = 256, seed: int = 1) -> int:
        """Lists to search for a recall of ``least`` on a sample of at most ``most`` queries, whose exact results are found for it."""
        sample = queries.where(F.col(vector).isNotNull()).orderBy(F.xxhash64(id, F.lit(seed))).limit(most)
        exact = self.search(sample, id, vector, k, probes=None)
        asked = {r[id]: r[vector] for r in sample.select(id, vector).collect()}
        placed = exact.join(self.vectors.select("id", "list"), "id").select("query", "list").collect()  # at most k for each query of the sample
        if not placed:
            return len(self.centroids)
        order = {q: np.argsort(np.argsort(-(unit(np.array([v], np.float64)) @ self.centroids.T)[0], kind="stable"), kind="stable") for q, v in asked.items()}
        ranks = sorted(int(order[r["query"]][r["list"]]) for r in placed)
        return ranks[min(len(ranks) - 1, ceil(least * len(ranks)) - 1)] + 1


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact result's rows that were found."""
    total = exact.count()
    return found.join(exact, ["query", "id"], "left_semi").count() / total if total else 1.0
