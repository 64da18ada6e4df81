"""File readers: JSON lines, word lists and four kinds of delimited text."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.values import locale_number
from millrace.session import scratch_path, staged

# Rare in text: lets the CSV reader hand over raw lines. A line that does hold it comes whole
# as a corrupt record.
_NO_SEPARATOR = "\u0001"
# Lines that the CSV reader skips: nothing but characters up to the blank.
_BLANK = r"\A[\x00-\x20]*\z"
_OBJECT = r"\A[ \t\r\n]*\{"


def _schema(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_json_docs(
    spark: SparkSession,
    path: str | list[str],
    text: str = "reviewText",
    category: str = "category",
    extra: str | None = None,
    on_bad: str = "drop",
) -> DataFrame:
    """JSON lines as typed rows; other fields are ignored.

    A line that is no JSON object is dropped and does not count as a document,
    or fails the job with ``on_bad="fail"``. ``extra`` adds columns, as DDL; such a
    field is NULL where it does not fit its type, and its document stays.
    """
    if on_bad not in ("drop", "fail"):
        raise ValueError("on_bad is 'drop' or 'fail'")
    fields = T.StructType().add(text, "string").add(category, "string")
    for field in _schema(extra).fields if extra else []:
        fields = fields.add(field)
    as_text = [T.StructField(f.name, T.StringType()) for f in fields]
    parsed = (
        spark.read.text(path)
        .where(~F.rlike("value", F.lit(_BLANK)))
        .select(
            F.rlike("value", F.lit(_OBJECT)).alias("is_object"),
            F.from_json(
                "value",
                T.StructType([*as_text, T.StructField("_bad", T.StringType())]),
                {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"},
            ).alias("doc"),
        )
    )
    good = F.col("is_object") & F.col("doc").isNotNull() & F.col("doc._bad").isNull()
    if on_bad == "fail":
        kept = parsed.where(F.when(good, True).otherwise(F.raise_error("not a JSON object")))
    else:
        kept = parsed.where(good)

    def typed(field: T.StructField) -> Column:
        raw = F.col("doc").getField(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.from_json(raw, field.dataType)
        return raw if isinstance(field.dataType, T.StringType) else raw.try_cast(field.dataType)

    return kept.select(*[typed(f).alias(f.name) for f in fields])


def read_wordlist(spark: SparkSession, path: str, name: str = "term") -> DataFrame:
    """One word per line, taken as it stands, each once."""
    return spark.read.text(path).select(F.col("value").alias(name)).distinct()


def read_csv_quoted(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType, header: bool = True
) -> DataFrame:
    """Quoted CSV with declared columns.

    With ``header`` the columns are found by their names in each file's own header, so files may
    order them differently and have others besides. A file without a declared column gives NULL for
    it; a column that no file has is an error. Without ``header`` columns go by position.
    """
    if not header:
        return spark.read.schema(_schema(schema)).csv(path, header=False, quote='"', escape='"')
    return _by_header(spark, path, [(f.name, f.name, f.dataType) for f in _schema(schema).fields], raw_names)


def sanitized_names(header: list[str]) -> list[str]:
    """Header names as plain identifiers.

    Other characters become dots, a leading digit gets an ``X`` in front and a
    repeated name a number behind: ``Country Code`` is ``Country.Code`` and
    ``2020`` is ``X2020``.
    """
    seen: dict[str, int] = {}
    names = []
    for raw in header:
        name = re.sub(r"[^\w.]", ".", raw)
        if not re.match(r"[^\W\d_]|\.(?!\d)", name):
            name = f"X{name}"
        count = seen.get(name, 0)
        seen[name] = count + 1
        names.append(f"{name}.{count}" if count else name)
    return names


def read_csv_header(spark: SparkSession, path: str | list[str], columns: dict[str, str]) -> DataFrame:
    """Comma CSV whose columns are found by their sanitized header names, in each file's own header.

    ``columns`` maps such a name to ``"new_name type"``; others are not read. Types are declared and not
    inferred, a value that does not fit is NULL. A file without a wanted column gives NULL for it;
    a column that no file has is an error.
    """
    wanted = []
    for source, target in columns.items():
        name, kind = target.split(None, 1)
        wanted.append((source, name, kind))
    return _by_header(spark, path, wanted, identifier_names)


def raw_names(names: Column) -> Column:
    """Header names as they stand."""
    return names


def identifier_names(names: Column) -> Column:
    """:func:`sanitized_names` as an expression over an array of names."""
    plain = F.transform(names, lambda n: F.regexp_replace(n, r"(?U)[^\w.]", "."))
    led = F.transform(
        plain, lambda n: F.when(F.rlike(n, F.lit(r"(?U)\A([^\W\d_]|\.(?!\d))")), n).otherwise(F.concat(F.lit("X"), n))
    )

    def numbered(name: Column, at: Column) -> Column:
        before = F.size(F.filter(F.slice(led, F.lit(1), at), lambda other: other == name))
        return F.when(before > 0, F.concat_ws(".", name, before.cast("string"))).otherwise(name)

    return F.transform(led, numbered)


def _header_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(_file, line)``: the first line of each file that is not blank, which lies in its first part."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")
    )
    first = lines.where((F.col("_start") == 0) & ~F.rlike("value", F.lit(_BLANK)))
    return first.groupBy("_file").agg(F.regexp_replace(F.first("value"), "\\A\ufeff", "").alias("line"))


def _by_header(
    spark: SparkSession,
    path: str | list[str],
    wanted: list[tuple[str, str, T.DataType | str]],
    names: Callable[[Column], Column],
) -> DataFrame:
    """Columns ``(header name, new name, type)``, each at its place in the header of the row's file.

    The headers become a small table of files and places. A column that has the same place in all
    files is taken from there; where places differ, rows meet that table by their file.
    """
    headers = staged(_header_lines(spark, path), "headers")
    width = headers.agg(F.max(F.size(F.split("line", ",")))).first()[0] or 1
    fields = ", ".join(f"c{i} string" for i in range(width))
    row = F.from_csv("line", fields, {"quote": '"', "escape": '"'})
    parsed = headers.select("_file", row.alias("row"))
    parsed = parsed.select("_file", names(F.array(*[F.col(f"row.c{i}") for i in range(width)])).alias("names"))
    place = [F.coalesce(F.array_position("names", F.lit(source)), F.lit(0)) - 1 for source, _, _ in wanted]
    places = staged(parsed.select("_file", *[p.alias(f"p{i}") for i, p in enumerate(place)]), "places")
    # as many different places as there are columns at most
    found = places.agg(*[F.collect_set(f"p{i}").alias(f"p{i}") for i in range(len(wanted))]).first()
    for i, (source, _, _) in enumerate(wanted):
        if found[f"p{i}"] == [-1]:
            raise ValueError(f"no file has a column {source!r}")
    rows = spark.read.schema(fields).csv(path, header=True, quote='"', escape='"')
    if any(len(found[f"p{i}"]) > 1 for i in range(len(wanted))):
        rows = rows.select("*", F.col("_metadata.file_path").alias("_file")).join(places, "_file")
    out = []
    for i, (_, name, kind) in enumerate(wanted):
        known = sorted(p for p in found[f"p{i}"] if p >= 0)
        value = F.lit(None).cast("string")
        for p in known:
            value = F.col(f"c{p}") if len(found[f"p{i}"]) == 1 else F.when(F.col(f"p{i}") == p, F.col(f"c{p}")).otherwise(value)
        text = kind == "string" or isinstance(kind, T.StringType)
        out.append((value if text else value.try_cast(kind)).alias(name))
    return rows.select(*out)


def read_delimited_text(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType,
    delimiter: str = ",",
    header: bool = True,
    null_marker: str = r"\N",
) -> DataFrame:
    """Plain delimited rows: a quote is data and a delimiter always splits.

    Missing trailing fields are NULL, surplus fields are ignored and a value that
    does not parse is NULL. An empty text field stays an empty string, and a blank line is a
    row. With ``header`` the first line of every file that is not blank is left out.
    """
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    if header:
        raw = spark.read.schema("line string, raw string").csv(
            path, sep=_NO_SEPARATOR, quote="", header=True, columnNameOfCorruptRecord="raw"
        )
        blank = lines.where(F.rlike("line", F.lit(_BLANK)))
        lines = raw.select(F.coalesce("raw", "line").alias("line")).unionAll(blank)
    parts = lines.select(F.split("line", f"\\Q{delimiter}\\E", -1).alias("part"))
    out = []
    for position, field in enumerate(_schema(schema).fields):
        value = F.get("part", F.lit(position))
        value = F.when(value != F.lit(null_marker), value)
        if not isinstance(field.dataType, T.StringType):
            value = value.try_cast(field.dataType)
        out.append(value.alias(field.name))
    return parts.select(*out)


def read_csv_locale(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType,
    sep: str = ";",
    decimal_mark: str = ",",
    na: str = ".",
) -> DataFrame:
    """Headerless CSV with its own separator, decimal mark and missing-value token.

    Only ``na`` means missing, so ``NA`` and ``-`` are ordinary values.
    """
    fields = _schema(schema).fields
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    raw = spark.read.schema(text).csv(path, sep=sep, nullValue=na, quote='"', escape='"')
    out = []
    for field in fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            value = locale_number(value, decimal_mark, field.dataType)
        elif not isinstance(field.dataType, T.StringType):
            value = value.try_cast(field.dataType)
        out.append(value.alias(field.name))
    return raw.select(*out)


def read_multi(
    spark: SparkSession, paths: str | list[str], schemas: dict[str, str | T.StructType]
) -> dict[str, DataFrame]:
    """Several quoted CSV tables mixed in one input set, told apart by column count.

    A line belongs to the table with as many columns as the line has fields; a
    line that repeats the name of the first column in its first field is a header. Lines of
    other widths are left out. The input is scanned once: its lines are sorted into the
    tables in the scratch folder, and each table is read from its part.
    """
    declared = {name: _schema(schema) for name, schema in schemas.items()}
    unquoted = F.regexp_replace("value", '"([^"]|"")*"', "")
    width = F.size(F.split(unquoted, ",", -1))
    of_table = F.lit(None).cast("string")
    for name, schema in declared.items():
        of_table = F.when(width == len(schema.fields), name).otherwise(of_table)
    path = scratch_path(spark, "mixed-lines")
    sorted_out = spark.read.text(paths).select("value", of_table.alias("of_table"))
    sorted_out.where(F.col("of_table").isNotNull()).write.partitionBy("of_table").parquet(path)
    lines = spark.read.schema("value string, of_table string").parquet(path)
    tables = {}
    for name, schema in declared.items():
        text = ", ".join(f"`{f.name}` string" for f in schema.fields)
        rows = (
            lines.where(F.col("of_table") == name)
            .select(F.from_csv("value", text, {"quote": '"', "escape": '"'}).alias("row"))
            .where(~F.col("row").getField(schema.fields[0].name).eqNullSafe(schema.fields[0].name))
        )
        tables[name] = rows.select(
            *[F.col("row").getField(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
        )
    return tables
