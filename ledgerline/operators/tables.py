"""Functions that take a table and give one: decoding of payloads by receiver, and the first rows of each outer row."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import Row

from ledgerline.sources.metrics import uncompressed, write_request


class Decoded:
    """Write requests of one receiver, in the order of their numbers, to samples; a payload whose number is not above the last one's is a repeat and left out."""

    def __init__(self) -> None:
        self.last: int | None = None

    def eval(self, row: Row) -> Iterator[tuple[Any, ...]]:
        if row["content"] is None or self.last is not None and row["number"] <= self.last:
            return
        self.last = row["number"]
        for labels, time, value in write_request(uncompressed(bytes(row["content"]))):
            yield row["receiver"], row["number"], labels, time, value


def decoded(spark: SparkSession, payloads: DataFrame) -> DataFrame:
    """(receiver, number, labels, timestamp, value) of (receiver, number, content), by a table function over each receiver's payloads.

    A receiver's payloads are one task's work. Null content gives nothing; a payload of a number that its receiver has had gives nothing more.
    """
    decode = F.udtf(Decoded, returnType="receiver string, number bigint, labels map<string,string>, timestamp bigint, value double")
    return decode(payloads.select("receiver", "number", "content").asTable().partitionBy("receiver").orderBy("number"))


def first_of_each(outer: DataFrame, inner: DataFrame, on: dict[str, str], order: list[Column], n: int) -> DataFrame:
    """Each outer row with the first n inner rows that match it: a lateral join. ``on`` names inner columns by outer ones, which have other names; outer rows without a match go."""
    matched = inner
    for outer_name, inner_name in on.items():
        matched = matched.where(F.col(inner_name) == F.col(outer_name).outer())
    return outer.lateralJoin(matched.orderBy(*order).limit(n))
