"""Tables whose rows are replaced and deleted by key in place.

Rows lie in buckets by a hash of their key, in files that a manifest lists with the least and greatest values of their columns. An upsert reads and writes the buckets
of its keys, a delete the files whose values can match; all other files stay as they are. A new version is a new manifest, which is
written last and never over another: a crash before that leaves the old version, and of two writers at once one fails. Readers see one version, whatever is written meanwhile.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, IntegerType, StructField, StructType

from ledgerline.operators.versions import latest_by_key
from ledgerline.session import file_system

BUCKETS = 64


class KeyedTable:
    """A table in a folder. ``key`` are its columns that tell rows apart; null is a value like others."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: list[str], buckets: int = BUCKETS):
        if missing := set(key) - set(schema.fieldNames()) or ({"no key"} if not key else set()):
            raise ValueError(f"not columns of the table: {', '.join(sorted(missing))}")
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path.rstrip("/"), schema, key, buckets
        self.measured = [f.name for f in schema.fields if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, BinaryType)]

    # Versions

    def versions(self) -> list[int]:
        store, folder = file_system(self.spark, f"{self.path}/_manifests")
        return sorted(int(s.getPath().getName().removesuffix(".json")) for s in store.listStatus(folder)) if store.exists(folder) else []

    def files(self, version: int | None = None) -> list[dict[str, Any]]:
        """bucket, path, rows, and least and greatest values (as text) of each file of a version, the last one by default."""
        known = self.versions()
        if version is None and not known:
            return []
        rows = self.spark.read.text(f"{self.path}/_manifests/{version or known[-1]:020d}.json").collect()  # a line for each file
        return [json.loads(r["value"]) for r in rows]

    def _swap(self, files: list[dict[str, Any]], after: int) -> int:
        """Makes ``files`` the version after ``after``; raises where another writer has made one."""
        store, path = file_system(self.spark, f"{self.path}/_manifests/{after + 1:020d}.json")
        if store.exists(path):
            raise RuntimeError(f"version {after + 1} has been written by another")
        part = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_parts/{uuid.uuid4().hex}")
        out = store.create(part, False)
        out.write("\n".join(json.dumps(f) for f in files).encode())
        out.close()
        store.mkdirs(path.getParent())
        if not store.rename(part, path):  # never over one that is there
            raise RuntimeError(f"version {after + 1} has been written by another")
        return after + 1

    # Rows

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows([f["path"] for f in self.files(version)])

    def _rows(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*(F.col(k) for k in self.key)), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame) -> list[dict[str, Any]]:
        """New files of rows, a bucket's in one task, with what a manifest says of them."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        rows.select(*self.schema.fieldNames(), self._bucket().alias("__bucket")).repartition(self.buckets, "__bucket").write.partitionBy("__bucket").parquet(folder)
        store, path = file_system(self.spark, folder)
        if not any(s.isDirectory() for s in store.listStatus(path)):
            return []  # no rows
        made = self.spark.read.schema(StructType([*self.schema.fields, StructField("__bucket", IntegerType())])).parquet(folder)
        ends = [f(F.col(c)).cast("string").alias(f"{n}:{c}") for c in self.measured for n, f in (("least", F.min), ("most", F.max))]
        found = made.groupBy(F.col("_metadata.file_path").alias("__path"), "__bucket").agg(F.count("*").alias("__rows"), *ends).collect()  # a row for each file
        return [
            {"bucket": r["__bucket"], "path": r["__path"], "rows": r["__rows"], "least": {c: r[f"least:{c}"] for c in self.measured}, "most": {c: r[f"most:{c}"] for c in self.measured}}
            for r in sorted(found, key=lambda r: (r["__bucket"], r["__path"]))
        ]

    def upsert(self, changes: DataFrame, *order: str, deleted: str | None = None) -> int:
        """The version in which each key of ``changes`` has its row of highest ``order``, or none where that row's ``deleted`` is true.

        Rows of other keys stay. Changes that repeat are one change; an empty table of changes makes no version.
        """
        names = self.schema.fieldNames()
        gone = F.coalesce(F.col(deleted).cast("boolean"), F.lit(False)) if deleted else F.lit(False)
        last = latest_by_key(changes.select(*names, *({*order} - {*names}), gone.alias("__gone")), self.key, *order).select(*names, "__gone")
        known, before = self.versions(), self.files()
        touched = {r[0] for r in last.select(self._bucket()).distinct().collect()}  # at most one for each bucket
        if not touched:
            return known[-1] if known else 0
        old = self._rows([f["path"] for f in before if f["bucket"] in touched])
        same = [old[k].eqNullSafe(F.col(f"__{k}")) for k in self.key]
        kept = old.join(last.select(*(F.col(k).alias(f"__{k}") for k in self.key)), same, "left_anti")
        made = self._write(kept.unionByName(last.where(~F.col("__gone")).drop("__gone")))
        return self._swap([f for f in before if f["bucket"] not in touched] + made, known[-1] if known else 0)

    def delete(self, column: str, low: Any = None, high: Any = None) -> int:
        """The version without rows with low <= column < high (None: no such end). Rows without a value stay.

        Only files whose least and greatest values let a row match are read, and only those with such a row are written again.
        """
        kind = self.schema[column].dataType
        bound = lambda v: F.lit(v).cast(kind)
        inside = lambda c: (F.lit(True) if low is None else c >= bound(low)) & (F.lit(True) if high is None else c < bound(high))
        known, before = self.versions(), self.files()
        can = self._can_match(before, column, kind, low, high)
        if not can:
            return known[-1] if known else 0
        rows = self._rows([f["path"] for f in can])
        hit = {r[0] for r in rows.where(inside(F.col(column))).select(F.col("_metadata.file_path")).distinct().collect()}  # at most one for each file
        if not hit:
            return known[-1]
        left = self._rows([f["path"] for f in can if f["path"] in hit]).where(~F.coalesce(inside(F.col(column)), F.lit(False)))
        return self._swap([f for f in before if f["path"] not in hit] + self._write(left), known[-1])

    def _can_match(self, files: list[dict[str, Any]], column: str, kind, low: Any, high: Any) -> list[dict[str, Any]]:
        if column not in self.measured:
            return files
        ends = self.spark.createDataFrame([(i, f["least"][column], f["most"][column]) for i, f in enumerate(files)], "i int, least string, most string")
        least, most = F.col("least").cast(kind), F.col("most").cast(kind)
        fits = (F.lit(True) if low is None else most >= F.lit(low).cast(kind)) & (F.lit(True) if high is None else least < F.lit(high).cast(kind))
        return [files[r["i"]] for r in ends.where(fits).orderBy("i").collect()]

    def vacuum(self, keep: int = 1) -> int:
        """Deletes manifests but the last ``keep``, and folders that none of these names; returns how many. No writer may be at work."""
        known = self.versions()
        used = {f["path"].rpartition("/__bucket=")[0].rpartition("/")[2] for v in known[-keep:] for f in self.files(v)}
        store, folder = file_system(self.spark, f"{self.path}/data")
        gone = [s.getPath() for s in store.listStatus(folder) if s.getPath().getName() not in used] if store.exists(folder) else []
        gone += [file_system(self.spark, f"{self.path}/_manifests/{v:020d}.json")[1] for v in known[:-keep]]
        for path in gone:
            store.delete(path, True)
        return len(gone)
