"""WARC archives: round trip, revisits, rolling, determinism."""

from __future__ import annotations

import glob
import gzip
import hashlib

import pytest

from millrace.llm import warc
from millrace.llm.runtime import ready
from millrace.session import scratch_path

LONG = "<p>" + "same " * 40 + "</p>"


@pytest.fixture(scope="module")
def pages(spark):
    ready(spark)
    rows = [(k, f"http://h/{k}", f"<p>page {k} é\r\n\r\n</p>" * 8, "x") for k in range(60)]
    rows += [(k, f"http://h/{k} b\n", LONG, "x") for k in (103, 101, 170)]
    rows += [(180, None, "", "x"), (181, None, None, "x"), (182, "u", "short", "x"), (183, "u", "short", "x")]
    rows += [(-5, "u", "negative " * 30, "x"), (None, "u", LONG, "x"), (190, "u", "twice " * 50, "x"), (190, "u", "twice " * 50, "x")]
    rows += [(1, "u", LONG, None)]  # an id used twice, with another payload
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, payload string").repartition(3)


def expected(rows):
    firsts = {}
    for r in rows:
        html = (r.html or "").encode()
        if len(html) >= 100 and r.page_id is not None:
            firsts[html] = min(firsts.get(html, r.page_id), r.page_id)
    out = []
    for r in rows:
        html = (r.html or "").encode()
        first = firsts.get(html, r.page_id)
        again = first != r.page_id
        out.append((r.page_id, len(html), hashlib.sha256(html).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, pages):
    got = warc.warc_round_trip(pages, roll_bytes=2000).collect()
    assert sorted(map(tuple, got), key=str) == expected(pages.collect())


def test_archives_roll_and_repeat(spark, pages):
    contents = []
    for _ in range(2):
        folder = scratch_path(spark, "warc")
        manifest = warc.write_warc(pages.coalesce(1), folder, roll_bytes=1500).collect()
        files = sorted(glob.glob(f"{folder.removeprefix('file://')}/*.warc.gz"))
        assert len(files) == len(manifest) > 5
        assert not glob.glob(f"{folder.removeprefix('file://')}/.*.tmp")
        contents.append([open(f, "rb").read() for f in files])
        assert sum(m.n_records for m in manifest) == pages.count()
    assert contents[0] == contents[1]
    text = gzip.decompress(contents[0][0])
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")


def test_damage_is_found(spark, pages, tmp_path):
    good = warc.page_record(7, "http://h", b"payload", None, False)
    path = f"{tmp_path}/a.warc.gz"
    open(path, "wb").write(good)
    assert [warc.page_of_record(*r)[0] for r in warc.read_records(path)] == [7]
    open(path, "wb").write(gzip.compress(gzip.decompress(good).replace(b"payload", b"PAYLOAD")))
    with pytest.raises(ValueError):
        list(warc.read_records(path))
    open(path, "wb").write(good[:-9])
    with pytest.raises(ValueError):
        list(warc.read_records(path))


def test_record_ids():
    for page in (0, 1, -1, 2**63 - 1, -(2**63), None):
        assert warc.page_of(warc.record_id(page, "0123abcd")) == page


def test_empty(spark):
    assert warc.warc_round_trip(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


def test_equal_archives_from_other_partitions(spark, monkeypatch):
    """More pages than Spark samples for its own ranges, dealt out differently each time."""
    monkeypatch.setattr(warc, "SMALL_RANGE_BYTES", 40_000)
    n = 60_000
    base = ready(spark).range(n).selectExpr(
        "id * 37 % 60000 AS page_id", "concat('http://h/', id) AS url", "repeat(concat('page ', id % 50000, ' '), 3) AS html"
    )
    contents = []
    for tasks in (3, 16):
        folder = scratch_path(spark, "warc")
        manifest = warc.write_warc(base.repartition(tasks), folder, level=1)
        assert manifest.selectExpr("sum(n_records)").first()[0] == n
        files = sorted(glob.glob(f"{folder.removeprefix('file://')}/*.warc.gz"))
        contents.append({f.rpartition("/")[2]: hashlib.sha256(open(f, "rb").read()).hexdigest() for f in files})
    assert contents[0] == contents[1] and 20 < len(contents[0]) < 80
    sizes = [r.n_records for r in manifest.collect()]
    assert max(sizes) < 2 * n / len(sizes)
