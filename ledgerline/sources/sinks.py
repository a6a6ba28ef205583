"""Writing tables: appends by month, idempotent creation, clearing and deleting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.functions.expressions import month
from ledgerline.schemas import TABLES, Table

PROTECTED = frozenset(["system", "information_schema"])


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def create_table(spark: SparkSession, table: Table, database: str = "default") -> None:
    """The table, partitioned by the month of its time where it has one; nothing if it is there."""
    if not spark.catalog.tableExists(f"{database}.{table.name}"):
        frame = spark.createDataFrame([], table.schema)
        writer = _placed(frame, table).write.mode("ignore")
        (writer.partitionBy("yyyymm") if table.month_of else writer).saveAsTable(f"{database}.{table.name}")


def _placed(df: DataFrame, table: Table) -> DataFrame:
    return df.withColumn("yyyymm", month(F.col(table.month_of))) if table.month_of else df


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Columns that are missing or null take their default."""
    return df.withColumns({c: F.coalesce(F.col(c), d) if c in df.columns else d for c, d in defaults.items()})


def append(df: DataFrame, table: Table, path: str) -> None:
    """Adds rows to the table's files, sorted within files by its key so that readers can skip row groups."""
    placed = _placed(df.select(*table.schema.fieldNames()), table)
    writer = placed.sortWithinPartitions(*(["yyyymm"] if table.month_of else []), *table.key).write.mode("append")
    (writer.partitionBy("yyyymm") if table.month_of else writer).parquet(path)


def read(spark: SparkSession, table: Table, path: str) -> DataFrame:
    month_field = [StructField("yyyymm", StringType())] if table.month_of else []
    return spark.read.schema(StructType([*table.schema.fields, *month_field])).parquet(path)


def clear(spark: SparkSession, database: str) -> list[str]:
    """Empties all tables of a database but not its views; their names."""
    if database.lower() in PROTECTED:
        raise ValueError(f"{database} is not cleared")
    names = [t.name for t in spark.catalog.listTables(database) if t.tableType != "VIEW" and not t.isTemporary]
    for name in names:
        spark.sql(f"TRUNCATE TABLE `{database}`.`{name}`")
    return names


def delete_where(spark: SparkSession, path: str, gone: Column, target: str) -> None:
    """Writes the rows without those that match to another place; null does not match."""
    spark.read.parquet(path).where(~F.coalesce(gone, F.lit(False))).write.mode("overwrite").parquet(target)


def create_all(spark: SparkSession, database: str = "default") -> None:
    for table in TABLES.values():
        create_table(spark, table, database)
