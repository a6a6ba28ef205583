"""Documents that are parsed once: stored as variants, with the fields that are asked for most as columns of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fields of log documents that become columns: name, path and type.
PROMOTED = {
    "service": ("$.service.name", "string"),
    "level": ("$.log.level", "string"),
    "status_code": ("$.http.status_code", "int"),
    "latency_ms": ("$.http.latency_ms", "int"),
    "city": ("$.geo.city", "string"),
}


def field(path: str, kind: str, document: str = "document") -> Column:
    """A value of a document by its path; null where there is none or it is no such value."""
    return F.try_variant_get(document, path, kind)


def parsed(rows: DataFrame, text: str = "document_json", promoted: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """``rows`` with ``document``, a variant, and the promoted fields in place of the text.

    The text is parsed once, all fields come from the variant. Text that is no JSON gives a null document and stays in
    ``document_text``, so nothing is lost; null text gives null.
    """
    known = rows.withColumn("document", F.try_parse_json(text))
    wrong = F.when(F.col("document").isNull(), F.col(text)).alias("document_text")
    fields = PROMOTED if promoted is None else promoted
    kept = [c for c in rows.columns if c != text]
    return known.select(*kept, "document", wrong, *(field(p, k).alias(n) for n, (p, k) in fields.items()))


def shapes(documents: DataFrame, *by: str, document: str = "document") -> DataFrame:
    """(by, schema): the type that all documents of a group have in common."""
    return documents.where(F.col(document).isNotNull()).groupBy(*by).agg(F.schema_of_variant_agg(document).alias("schema"))
