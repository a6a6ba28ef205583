"""Batches of a stream that are written exactly once, also when their ids come again.

A batch's rows have a folder of their own, which a repeated write replaces; that a batch is complete, a mark says that is written after it. Readers take marked
batches only, and a marked batch is not written again. So a crash before the mark leaves nothing to be seen, and one after it, or a lost checkpoint, repeats nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerline.session import file_system


class Ledger:
    """The batches of one stream in a folder; ``stream`` parts several streams that write into it."""

    def __init__(self, spark: SparkSession, path: str, stream: str):
        if not stream.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"not a stream's name: {stream!r}")
        self.spark, self.path, self.stream = spark, path.rstrip("/"), stream

    def _mark(self, batch_id: int) -> str:
        return f"{self.path}/_ledger/{self.stream}/{batch_id:020d}"

    def _rows(self, batch_id: int) -> str:
        return f"{self.path}/{self.stream}/{batch_id:020d}"

    def done(self, batch_id: int) -> bool:
        store, mark = file_system(self.spark, self._mark(batch_id))
        return store.exists(mark)

    def ids(self) -> list[int]:
        """The complete batches."""
        store, folder = file_system(self.spark, f"{self.path}/_ledger/{self.stream}")
        return sorted(int(s.getPath().getName()) for s in store.listStatus(folder)) if store.exists(folder) else []

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Writes a batch that has no mark and marks it: for foreachBatch."""
        if self.done(batch_id):
            return
        batch.write.mode("overwrite").parquet(self._rows(batch_id))
        store, mark = file_system(self.spark, self._mark(batch_id))
        store.create(mark, False).close()

    def once(self, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        """Another write, such as an upsert that may be repeated, with marked batches left out."""

        def run(batch: DataFrame, batch_id: int) -> None:
            if not self.done(batch_id):
                write(batch, batch_id)
                store, mark = file_system(self.spark, self._mark(batch_id))
                store.create(mark, False).close()

        return run

    def table(self, schema: StructType) -> DataFrame:
        """The rows of all complete batches; none yet: an empty table."""
        ids = self.ids()
        return self.spark.read.schema(schema).parquet(*map(self._rows, ids)) if ids else self.spark.createDataFrame([], schema)
