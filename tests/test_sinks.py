import os

import pytest
from conftest import rows

from millrace.sinks import writers


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame([("a", "x,y"), ("b", 'q"r')], "k string, v string")


def test_text_overwrites_or_refuses(spark, pairs, tmp_path):
    path = str(tmp_path / "out")
    writers.write_text_lines(pairs, path)
    writers.write_text_lines(pairs, path)
    assert rows(spark.read.text(path)) == [("a\tx,y",), ('b\tq"r',)]
    with pytest.raises(Exception, match="(?i)exists"):
        writers.write_text_lines(pairs, path, mode="errorifexists")
    with pytest.raises(ValueError):
        writers.write_text_lines(pairs, path, mode="append")


def test_single_file(pairs, tmp_path):
    path = str(tmp_path / "one")
    writers.write_single_text(pairs.repartition(4), path)
    assert sum(f.startswith("part-") for f in os.listdir(path)) == 1
    with pytest.raises(Exception, match="(?i)exists"):
        writers.write_single_text(pairs, path, mode="errorifexists")
    assert os.listdir(tmp_path) == ["one"]


def test_single_file_keeps_the_order_of_many_parts(spark, tmp_path):
    n = 20_000
    df = spark.range(n).selectExpr("(id * 7919) % 20000 AS k", "concat('é', id) AS v").repartition(13)
    path = str(tmp_path / "sorted")
    for part_rows in (0, 700):  # also where a task writes several files
        spark.conf.set("spark.sql.files.maxRecordsPerFile", part_rows)
        writers.write_single_text(df.repartitionByRange(37, "k").sortWithinPartitions("k"), path)
        (name,) = [f for f in os.listdir(path) if f.startswith("part-")]
        with open(f"{path}/{name}", encoding="utf-8") as stream:
            lines = stream.read().split("\n")
        assert lines.pop() == "" and [int(line.split("\t")[0]) for line in lines] == list(range(n))
    spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    writers.write_single_text(df.where("k < 0"), path)
    assert spark.read.text(path).count() == 0


@pytest.mark.parametrize("write", [writers.write_text_lines, writers.write_single_text, writers.write_csv_rows])
def test_a_job_that_fails_leaves_the_old_output(spark, pairs, tmp_path, write):
    path = str(tmp_path / "kept")
    write(pairs, path)
    before = rows(spark.read.text(path))
    broken = spark.range(1000).repartition(8).selectExpr("IF(id = 777, raise_error('broken'), 'x') AS k")
    with pytest.raises(Exception, match="broken"):
        write(broken, path)
    assert rows(spark.read.text(path)) == before and os.listdir(tmp_path) == ["kept"]
    own = spark.read.text(path)
    write(own.unionAll(own), path)  # what is read is there until the new lines are
    assert spark.read.text(path).count() == 2 * len(before)


def test_csv_has_real_columns(spark, pairs, tmp_path):
    path = str(tmp_path / "csv")
    writers.write_csv_rows(pairs, path)
    assert rows(spark.read.text(path)) == [('a,"x,y"',), ('b,"q""r"',)]


def test_show(pairs, capsys):
    writers.show_rows(pairs, 1)
    assert "only showing top 1 row" in capsys.readouterr().out
