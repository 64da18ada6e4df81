"""Text and CSV output."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WRITE_MODES = ("overwrite", "errorifexists")


def write_text_lines(df: DataFrame, path: str, mode: str = "overwrite", sep: str = "\t") -> None:
    """One line of text per row, columns joined by ``sep``.

    ``overwrite`` replaces an existing directory once the new lines are complete, ``errorifexists`` refuses.
    """
    _publish(df.sparkSession, path, mode, lambda target: _lines(df, sep).write.text(target))


def write_single_text(df: DataFrame, path: str, mode: str = "overwrite", sep: str = "\t") -> None:
    """Text output in one file, in the order of ``df``.

    Tasks write part files, which keep the order of a sorted frame by their numbers; then the file
    system puts their bytes together, without a row passing through one task.
    """
    spark = df.sparkSession

    def write(target: str) -> None:
        parts = f"{target}.parts"
        try:
            _lines(df, sep).write.text(parts)
            _concatenate(spark, parts, f"{target}/part-00000.txt")
        finally:
            _files(spark, parts)[0].delete(_path(spark, parts), True)

    _publish(spark, path, mode, write)


def write_csv_rows(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV without a header, one field per column; replaces or refuses as :func:`write_text_lines` does."""
    _publish(
        df.sparkSession, path, mode, lambda target: df.write.csv(target, header=False, quote='"', escape='"')
    )


def _lines(df: DataFrame, sep: str) -> DataFrame:
    columns = [F.col(f"`{c}`").cast("string") for c in df.columns]
    return df.select(F.concat_ws(sep, *columns).alias("value"))


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of a path and its configuration."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return _path(spark, path).getFileSystem(conf), conf


def _publish(spark: SparkSession, path: str, mode: str, write: Callable[[str], None]) -> None:
    """Write beside ``path`` and swap by renaming, so that readers see the old output or the new one.

    When the job fails what it wrote is deleted and the old output stays. The old one goes last: should
    the swap itself be cut short, it lies beside ``path`` under a name that ends in ``.old``.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode is one of {WRITE_MODES}")
    files, _ = _files(spark, path)
    target = _path(spark, path)
    if mode == "errorifexists" and files.exists(target):
        raise FileExistsError(f"{path} exists already")
    mark = uuid.uuid4().hex
    parent, name = path.rstrip("/").rpartition("/")[::2]
    # names that Spark's readers pass over
    beside, old = (f"{parent}/_{name}.{mark}.{kind}" if parent else f"_{name}.{mark}.{kind}" for kind in ("new", "old"))
    try:
        write(beside)
        if files.exists(target):
            if mode == "errorifexists":
                raise FileExistsError(f"{path} exists already")
            _rename(files, target, _path(spark, old))
        try:
            _rename(files, _path(spark, beside), target)
        except OSError:
            if files.exists(_path(spark, old)):
                _rename(files, _path(spark, old), target)
            raise
    finally:
        files.delete(_path(spark, beside), True)
    files.delete(_path(spark, old), True)


def _rename(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"cannot rename {source} to {target}")


def _concatenate(spark: SparkSession, folder: str, target: str) -> None:
    """Put the part files of ``folder`` together, in the order of their numbers."""
    files, conf = _files(spark, folder)
    listed = [status.getPath() for status in files.listStatus(_path(spark, folder))]
    parts = sorted((p for p in listed if p.getName().startswith("part-")), key=lambda p: p.getName())
    out = files.create(_path(spark, target), True)
    try:
        for part in parts:
            stream = files.open(part)
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, conf, False)
            finally:
                stream.close()
    finally:
        out.close()


def show_rows(df: DataFrame, rows: int = 20, truncate: bool = True) -> None:
    """Print the first rows."""
    df.show(rows, truncate=truncate)
