"""Column expressions: times, JSON, labels, and means that do not depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def best_effort_time(text: Column) -> Column:
    """A timestamp from ISO text (naive is UTC) or epoch seconds; null for anything else."""
    return F.coalesce(
        F.try_to_timestamp(text),
        F.timestamp_seconds(text.try_cast("double")),
    )


def hour(time: Column) -> Column:
    return F.date_trunc("hour", time)


def minute(time: Column) -> Column:
    return F.date_trunc("minute", time)


def month(time: Column) -> Column:
    """yyyyMM, by which large tables are partitioned."""
    return F.date_format(time, "yyyyMM")


def iso_millis(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def millis(time: Column) -> Column:
    """Cut to milliseconds."""
    return F.date_trunc("millisecond", time)


def json_text(document: Column, path: str) -> Column:
    """A value at a JSON path as text; empty where there is none."""
    return F.coalesce(F.get_json_object(document, path), F.lit(""))


def json_int(document: Column, path: str) -> Column:
    """A whole number at a JSON path; 0 where there is none."""
    return F.coalesce(F.get_json_object(document, path).try_cast("bigint"), F.lit(0).cast("bigint"))


def canonical_labels(labels: Column) -> Column:
    """JSON of a map with sorted keys and no spaces."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(labels))))


def fingerprint(labels_json: Column) -> Column:
    return F.sha2(labels_json, 256)


def exact_sum(value: Column) -> Column:
    """A sum of doubles through decimals: the same in any order of rows, to 6 places."""
    return F.sum(value.cast("decimal(28,6)")).cast("double")


def exact_mean(value: Column, digits: int = 2) -> Column:
    """A mean through decimals, rounded half up."""
    mean = F.sum(value.cast("decimal(28,6)")).cast("decimal(38,6)") / F.count(value)
    return F.when(F.count(value) > 0, F.round(mean, digits)).cast("double")


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """A rounded ratio; null for a whole of zero."""
    return F.round(F.try_divide(part.cast("decimal(20,0)"), whole.cast("decimal(20,0)")), digits).cast("double")


def p95(value: Column) -> Column:
    """The exact 95th percentile with linear interpolation, to 6 places; null without values."""
    return F.percentile(value, 0.95).cast("decimal(38,6)").cast("double")


def latest_value(value: Column, *order: Column) -> Column:
    """The last value that is not null; later columns of ``order`` break ties."""
    return F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))


def readable_size(size: Column) -> Column:
    """Bytes in the largest unit of 1024 that leaves at least one, with two decimals."""
    units = ["B", "KiB", "MiB", "GiB", "TiB", "PiB"]
    power = F.greatest(F.lit(0), F.least(F.lit(5), F.floor(F.log2(F.greatest(size.cast("double"), F.lit(1.0))) / 10).cast("int")))
    return F.format_string("%.2f %s", size / F.pow(F.lit(1024.0), power), F.get(F.array(*map(F.lit, units)), power))


def text_hash(text: Column) -> Column:
    """Absolute value of the 32-bit hash that multiplies by 31 and adds each code point."""
    codes = F.transform(F.split(text, ""), lambda c: F.ascii(c).cast("bigint"))
    folded = F.aggregate(codes, F.lit(0).cast("bigint"), lambda h, c: F.pmod(h * 31 + c, F.lit(2**32)))
    return F.when(folded >= 2**31, F.lit(2**32) - folded).otherwise(folded)


def usage(body: Column) -> Column:
    """Struct (input, output, total, unit) of a completion's token counts; null where the answer has none."""
    shape = "usage struct<prompt_tokens:bigint,completion_tokens:bigint,total_tokens:bigint>"
    found = F.from_json(body, shape)["usage"]
    named = (("prompt_tokens", "input"), ("completion_tokens", "output"), ("total_tokens", "total"))
    return F.when(found.isNotNull(), F.struct(*(found[a].alias(b) for a, b in named), F.lit("TOKENS").alias("unit")))


def level(value: Column, steps: list[tuple[float | None, str]]) -> Column:
    """The name of the last step at or below a value; a step of None is the one that all values reach."""
    found = F.lit(None).cast("string")
    for least, name in steps:
        found = F.when(F.lit(True) if least is None else value >= least, name).otherwise(found)
    return found
