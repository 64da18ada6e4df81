"""Typed fields of JSON texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import free_name


def json_fields(df: DataFrame, column: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """``df`` with fields of a JSON text, each ``name: (path, type)``, from one parse of the text.

    The text becomes a VARIANT once; paths go into objects and lists (``$.a.b[0]``). A text that is no
    JSON, a path that is not there and a value that does not fit its type give NULL.
    """
    parsed = free_name("parsed", {*df.columns, *fields})
    # the parse stands in a row of its own, so that no field repeats it
    rows = df.withColumn(parsed, F.try_parse_json(F.col(f"`{column}`")))
    found = [F.try_variant_get(F.col(parsed), path, kind).alias(name) for name, (path, kind) in fields.items()]
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], *found)
