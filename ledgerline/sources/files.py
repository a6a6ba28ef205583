"""Folders of files with their content's hash."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.corpus import supported


#: Bytes of a file up to which its content is a value of a row; longer files are read in pieces of that size.
PIECE = 64 * 1024 * 1024


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for uri in batch.column("path").to_pylist():
            store, path = fs.FileSystem.from_uri(uri)
            digest = hashlib.sha256()
            with store.open_input_stream(path) as f:
                while piece := f.read(PIECE):
                    digest.update(piece)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array(found, pa.string())], ["path", "length", "sha256"])


def folder_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path below the folder, length, sha256, supported) of every file at any depth; Spark itself passes over empty files and names that start with a dot.

    Long files are hashed in pieces, so a file may be of any length.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    path = F.regexp_replace(F.col("path"), f"^.*?{folder.rstrip('/').rpartition('/')[2]}/", "")
    short = files.where(F.col("length") <= PIECE).select("path", "length", F.sha2("content", 256).alias("sha256"))
    long = files.where(F.col("length") > PIECE).select("path", "length").mapInArrow(_hashed, "path string, length long, sha256 string")
    return short.unionByName(long).withColumn("path", path).withColumn("supported", supported(F.col("path")))
