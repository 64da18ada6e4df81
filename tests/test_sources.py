import pytest
from conftest import rows
from pyspark.sql import types as T

from millrace.functions.text import category_or_unknown
from millrace.operators.terms import tokenize
from millrace.session import scratch_root
from millrace.sources import catalog, readers
from millrace.sources.schemas import FORUM_TABLES


def write(path, *lines):
    path.write_text("".join(f"{line}\n" for line in lines), encoding="utf-8")
    return str(path)


GOOD = '{"reviewText":"a","category":"B","stars":5}'


def test_json_lines_drop_what_is_no_object(spark, tmp_path):
    path = write(tmp_path / "r.json", GOOD, "{bad", '{"category":"C"}', "", "[1]", f"[{GOOD}]", '"x"', "null")
    docs = readers.read_json_docs(spark, path)
    assert rows(docs) == [("a", "B"), (None, "C")]
    assert docs.count() == 2
    assert rows(tokenize(docs, "reviewText", keep=[])) == [("a",)]


def test_json_lines_after_a_tab_and_with_extras_of_another_type(spark, tmp_path):
    lines = ["\t" + GOOD, '{"reviewText":"t","n":"x1","l":[1,2]}', '{"reviewText":"u","n":"7","l":"no"}', "\t[1]"]
    docs = readers.read_json_docs(spark, write(tmp_path / "r.json", *lines), extra="n bigint, l array<int>")
    assert rows(docs) == [("a", "B", None, None), ("t", None, None, [1, 2]), ("u", None, 7, None)]
    strict = readers.read_json_docs(spark, write(tmp_path / "s.json", *lines[:3]), extra="n bigint", on_bad="fail")
    assert strict.count() == 3


def test_json_lines_missing_category(spark, tmp_path):
    docs = readers.read_json_docs(spark, write(tmp_path / "r.json", '{"reviewText":"a"}'))
    assert rows(docs.select(category_or_unknown(docs.category))) == [("?",)]


def test_json_lines_fail_mode(spark, tmp_path):
    path = write(tmp_path / "r.json", GOOD, "{bad")
    with pytest.raises(Exception, match="not a JSON object"):
        readers.read_json_docs(spark, path, on_bad="fail").collect()
    good = write(tmp_path / "g.json", GOOD)
    assert rows(readers.read_json_docs(spark, good, on_bad="fail")) == [("a", "B")]
    with pytest.raises(ValueError):
        readers.read_json_docs(spark, path, on_bad="ignore")


def test_wordlist_is_exact_and_distinct(spark, tmp_path):
    path = write(tmp_path / "w.txt", "the", " the", "The", "the")
    assert rows(readers.read_wordlist(spark, path)) == [(" the",), ("The",), ("the",)]


def test_quoted_csv(spark, tmp_path):
    path = write(tmp_path / "q.csv", '"id","name"', '"1","a, ""b"""', "2,")
    got = rows(readers.read_csv_quoted(spark, path, "id bigint, name string"))
    assert got == [(1, 'a, "b"'), (2, None)]


def test_csv_by_header_name(spark, tmp_path):
    path = write(tmp_path / "p.csv", "Country Name,Country Code,2019,2020", "A,AAA,1,2", "B,BBB,,x")
    got = readers.read_csv_header(
        spark, path, {"Country.Code": "code string", "X2020": "population bigint"}
    )
    assert rows(got) == [("AAA", 2), ("BBB", None)]


def test_every_file_has_its_own_header(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    write(folder / "a.csv", "Name,2020", "x,1")
    write(folder / "b.csv", "2020,Name", "2,y", '"3","z, w"')
    write(folder / "c.csv", "", "\ufeffother,Name", "7,only a name")
    write(folder / "d.csv", "2020")
    write(folder / "e.csv", "Name,2020,Name,extra", "first,4,second,e", "short")
    got = readers.read_csv_header(spark, str(folder), {"Name": "name string", "X2020": "n bigint"})
    assert rows(got) == sorted(
        [("x", 1), ("y", 2), ("z, w", 3), ("only a name", None), ("first", 4), ("short", None)],
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )
    second = readers.read_csv_header(spark, str(folder), {"Name.1": "again string"})
    assert [r.again for r in second.where("again IS NOT NULL").collect()] == ["second"]
    with pytest.raises(ValueError, match="no file has a column 'absent'"):
        readers.read_csv_header(spark, str(folder), {"absent": "a string"})


def test_quoted_csv_goes_by_names(spark, tmp_path):
    folder = tmp_path / "named"
    folder.mkdir()
    write(folder / "a.csv", "b,a", "2,1")
    write(folder / "b.csv", "a,c,b", "3,9,4", "x,9,5")
    got = readers.read_csv_quoted(spark, str(folder), "a bigint, b bigint")
    assert got.columns == ["a", "b"] and rows(got) == [(1, 2), (3, 4), (None, 5)]
    one = readers.read_csv_quoted(spark, str(folder / "a.csv"), "a bigint, b bigint")
    assert rows(one) == [(1, 2)] and "Join" not in one._jdf.queryExecution().toString()
    with pytest.raises(ValueError, match="no file has"):
        readers.read_csv_quoted(spark, str(folder), "A bigint")


def test_a_large_file_keeps_its_header_in_all_parts(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        write(tmp_path / "l1.csv", "k,v", *[f"{i},{i * 2}" for i in range(20_000)])
        write(tmp_path / "l2.csv", "v,k", *[f"{i * 2},{i}" for i in range(20_000, 40_000)])
        both = [str(tmp_path / "l1.csv"), str(tmp_path / "l2.csv")]
        got = readers.read_csv_header(spark, both, {"k": "k bigint", "v": "v bigint"})
        assert got.rdd.getNumPartitions() > 5
        assert got.where("v = 2 * k").selectExpr("count(*)", "sum(k)").first()[:] == (40_000, sum(range(40_000)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_names_agree_with_the_expression(spark):
    header = ["Country Code", "2020", "ok", "ok", "_x", ".5", "a-b", "été", "ok", "X2020", "2020", ".a", "a.b"]
    df = spark.createDataFrame([(header,)], "names array<string>")
    assert df.select(readers.identifier_names(df.names)).first()[0] == readers.sanitized_names(header)


def test_header_names_become_identifiers():
    header = ["Country Code", "2020", "ok", "ok", "_x", ".5", "a-b"]
    assert readers.sanitized_names(header) == [
        "Country.Code", "X2020", "ok", "ok.1", "X_x", "X.5", "a.b",
    ]


def test_delimited_text_takes_quotes_as_data(spark, tmp_path):
    schema = "id bigint, name string, at timestamp_ntz"
    path = write(
        tmp_path / "t.csv",
        "id,name,at",
        '1,"x,y",2020-01-01 00:00:00',
        "2,z,2020-01-01 00:00:00,surplus",
        "x,",
        r"4,\N,2020-01-01",
    )
    got = readers.read_delimited_text(spark, path, schema)
    when = "2020-01-01 00:00:00"
    text = [tuple(None if v is None else str(v) for v in r) for r in got.orderBy("id").collect()]
    assert text == [
        (None, "", None),
        ("1", '"x', None),
        ("2", "z", when),
        ("4", None, when),
    ]


def test_delimited_text_keeps_control_characters_and_blank_lines(spark, tmp_path):
    schema = "id bigint, name string, n int"
    path = write(tmp_path / "a.csv", "id,name,n", "1,x\u0001y,5", "", "\t", "2,\u0001,", "\u0001")
    other = write(tmp_path / "b.csv", "id,name,n", "3,z,6")
    got = readers.read_delimited_text(spark, [path, other], schema)
    blank = (None, None, None)
    assert rows(got) == sorted([(1, "x\u0001y", 5), blank, blank, (2, "\u0001", None), blank, (3, "z", 6)], key=lambda t: tuple((v is None, str(v)) for v in t))
    assert readers.read_delimited_text(spark, path, schema, header=False).count() == 6


def test_locale_csv_missing_token(spark, tmp_path):
    path = write(tmp_path / "l.csv", '"Namibia";"NA";"1,5";TRUE', '"B";.;.;.', '"C";"-";"x";FALSE')
    got = readers.read_csv_locale(
        spark, path, "name string, code string, rate double, developed boolean"
    )
    assert rows(got) == [("B", None, None, None), ("C", "-", None, False), ("Namibia", "NA", 1.5, True)]


def test_mixed_tables_are_told_apart_by_width(spark, tmp_path):
    path = write(
        tmp_path / "m.csv", "t_dat,c", "id,name,age", "2020,7", '7,"a, b",31', '8,"c ""d""",', "2021,8"
    )
    tables = readers.read_multi(
        spark, path, {"sales": "t_dat string, c bigint", "people": "id bigint, name string, age int"}
    )
    assert rows(tables["sales"]) == [("2020", 7), ("2021", 8)]
    assert rows(tables["people"]) == [(7, "a, b", 31), (8, 'c "d"', None)]


def test_forum_tables(spark, tmp_path):
    assert len(catalog.create_forum_tables(spark, "forum", str(tmp_path / "db"))) == 6
    assert len(list((tmp_path / "db").iterdir())) == 6
    for name, ddl in FORUM_TABLES.items():
        assert spark.table(f"forum.{name}").schema == T.StructType.fromDDL(ddl)
    spark.sql("DROP DATABASE forum CASCADE")


def test_load_replaces_and_copies(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    catalog.load_into_table(df, "loaded")
    catalog.load_into_table(df, "loaded")
    assert rows(spark.table("loaded")) == rows(df)


def test_bucketed_tables_join_without_a_shuffle(spark):
    from conftest import plan_of

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = spark.range(1000)
        left = catalog.load_into_table(ids, "bucket_left", bucket_by="id", buckets=4)
        right = catalog.load_into_table(ids, "bucket_right", bucket_by="id", buckets=4)
        joined = left.join(right, "id")
        assert "Exchange" not in plan_of(joined)
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_schema_report_counts_present_values(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id bigint, `odd name` string")
    assert rows(catalog.schema_report(df)) == [(1, "id", "bigint", 2), (2, "odd name", "string", 1)]


def test_views_are_visible_to_sql(spark):
    catalog.register_views({"some_view": spark.range(3)})
    assert spark.sql("SELECT count(*) FROM some_view").first()[0] == 3


def test_scratch_folder_is_the_configured_one(spark):
    assert scratch_root(spark).startswith(spark.conf.get("spark.checkpoint.dir") + "/millrace-")
    assert scratch_root(spark) == scratch_root(spark)


def test_settings_of_the_session_stay(spark):
    from millrace.session import tune

    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert tune(spark).conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    context = SimpleNamespace(master="spark://host:7077", applicationId="none", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session)
