"""Deterministic sharded WARC archives, written and read by tasks.

Records are sorted by ranges of the page id, one shuffle of the pages. A range is written
into archives that are rolled when their compressed size is reached, each record a
gzip member of its own with regenerated headers and digests. Number and bounds of the ranges follow
from the pages alone, by counts and by a sample that a hash of the page chooses, so
the same pages give the same archives whichever tasks write them. Archives get their name when
they are complete; a manifest lists them, and readers go by the manifest.

Pages with equal payloads of at least ``min_bytes``: the one with the smallest page id is
stored as response, the others as revisits of it, without the payload. Which page comes
first is settled on digests alone, aggregated before any shuffle; the outcome joins the
pages inside the range shuffle, as rows of its own ahead of the page they belong to.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.files import PendingFile, open_input
from millrace.operators.ranges import range_number
from millrace.session import scratch_path, staged

MANIFEST = "part bigint, number bigint, path string, n_records bigint, n_bytes bigint"
RESULT = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
ROLL_BYTES = 256 << 20
MIN_BYTES = 100
#: Payload bytes of a range: at most about the first; less of them while there are fewer than so many ranges.
RANGE_BYTES, SMALL_RANGE_BYTES, FEW_RANGES = 256 << 20, 8 << 20, 200
#: Sampled pages per range.
SAMPLED = 100
#: All records carry this date, so that equal pages give equal archives.
DATE = "1970-01-01T00:00:00Z"
LEVEL = 6
CHUNK = 1 << 20

# Fixed values of the WARC 1.1 format
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"


def record_id(page_id: int | None, tie: str) -> str:
    """A record id that holds the page id; ``tie`` (8 hex digits) tells repeated pages apart."""
    bits = f"{(page_id or 0) & (1 << 64) - 1:016x}"
    return f"<urn:uuid:{bits[:8]}-{bits[8:12]}-8{int(page_id is None):03x}-8000-{bits[12:]}{tie}>"


def page_of(identifier: str) -> int | None:
    parts = identifier.strip("<>").removeprefix("urn:uuid:").split("-")
    if parts[2] != "8000":
        return None
    bits = int(parts[0] + parts[1] + parts[4][:4], 16)
    return bits - (1 << 64) if bits >> 63 else bits


def _member(headers: dict[str, str], block: bytes, level: int) -> bytes:
    headers |= {
        "WARC-Date": DATE,
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Length": str(len(block)),
    }
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()).encode() + b"\r\n"
    press = zlib.compressobj(level, zlib.DEFLATED, 31)
    return press.compress(head) + press.compress(block) + press.compress(b"\r\n\r\n") + press.flush()


def page_record(
    page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool, level: int = LEVEL
) -> bytes:
    """The compressed record of a page; a revisit keeps the HTTP head and no payload."""
    digest = hashlib.sha256(payload).hexdigest()
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or f"urn:page:{page_id}")
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page_id, digest[:8]),
        "WARC-Target-URI": uri,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": HTTP_TYPE,
    }
    if revisit:
        headers |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(first, digest[:8])}
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return _member(headers, head.encode() + (b"" if revisit else payload), level)


def info_record(name: str, level: int = LEVEL) -> bytes:
    """The first record of an archive."""
    return _member(
        {
            "WARC-Type": "warcinfo",
            "WARC-Record-ID": record_id(None, hashlib.sha256(name.encode()).hexdigest()[:8]),
            "WARC-Filename": name,
            "Content-Type": "application/warc-fields",
        },
        b"format: WARC File Format 1.1\r\n",
        level,
    )


class ArchiveWriter:
    """Writes records to one archive after the other."""

    def __init__(self, folder: str, part: int, roll_bytes: int, level: int):
        self.folder, self.part, self.roll_bytes, self.level = folder, part, roll_bytes, level
        self.file: PendingFile | None = None
        self.n_records = self.number = 0
        self.done: list[tuple[int, int, str, int, int]] = []

    def move_to(self, part: int) -> None:
        """Go on with another range, in an archive of its own."""
        if part != self.part:
            self.roll()
            self.part, self.number = part, 0

    def add(self, record: bytes) -> None:
        if self.file is None:
            name = f"pages-{self.part:08d}-{self.number:05d}.warc.gz"
            self.file = PendingFile(f"{self.folder}/{name}")
            self.file.write(info_record(name, self.level))
        self.file.write(record)
        self.n_records += 1
        if self.file.size >= self.roll_bytes:
            self.roll()

    def roll(self) -> None:
        if self.file is not None:
            self.file.commit()
            self.done.append((self.part, self.number, self.file.uri, self.n_records, self.file.size))
            self.file, self.n_records, self.number = None, 0, self.number + 1


def revisits(digests: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_id, digest, first_id`` of pages whose payload a page with a smaller id has.

    A null id counts as larger than any other; pages with null ids only are responses.
    """
    long = digests.where(F.col("n_bytes") >= min_bytes)
    firsts = (
        long.groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("first_id").isNotNull())
        .drop("n")
    )
    joined = long.select("page_id", "digest").join(firsts, "digest")
    return joined.where(~F.col("page_id").eqNullSafe(F.col("first_id"))).distinct()


def range_bounds(digests: DataFrame) -> DataFrame:
    """``(_one, _cuts)``: one row with the ascending ``(page_id, digest)`` at which ranges begin.

    Depends on the set of pages only: which pages are sampled is settled by their hash, and
    the sample, about ``SAMPLED`` pages per range, is numbered in one order.
    """
    totals = digests.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    rows, size = totals
    ranges = max(1, min(FEW_RANGES, size // SMALL_RANGE_BYTES), size // RANGE_BYTES)
    one_in = max(1, rows // (SAMPLED * ranges))
    every = max(1, rows // (one_in * ranges))
    chosen = digests.where(F.pmod(F.xxhash64("page_id", "digest"), F.lit(one_in)) == 0)
    nth = F.row_number().over(Window.orderBy("page_id", "digest"))
    cut = chosen.select("page_id", "digest", nth.alias("nth")).where(F.col("nth") % every == 0)
    cuts = F.array_sort(F.collect_list(F.struct("page_id", "digest")))
    return staged(cut.agg(cuts.alias("_cuts")).select(F.lit(0).alias("_one"), "_cuts"), "range-bounds")


def write_warc(
    pages: DataFrame,
    folder: str,
    roll_bytes: int = ROLL_BYTES,
    min_bytes: int = MIN_BYTES,
    level: int = LEVEL,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Write ``pages`` as archives below ``folder``; the manifest, one row per archive, comes back.

    A null html is an empty payload, a null url is replaced by one made of the page id.
    Repeated rows become records of their own; with the smallest id of their payload they
    are all responses. Pages without an id stand first in the order. An empty table writes
    no archive.
    """
    spark = pages.sparkSession
    html = F.encode(F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(f"`{id_col}`").cast("bigint").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        html.alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    digests = staged(rows.select("page_id", "digest", F.length("payload").alias("n_bytes")), "digests")
    ahead = revisits(digests, min_bytes).select(
        "page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest",
        "first_id", F.lit(0).alias("kind"),
    )
    rows = rows.withColumns({"first_id": F.lit(None).cast("bigint"), "kind": F.lit(1)}).unionByName(ahead)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(folder, -1, roll_bytes, level)
        known: tuple = ()
        fields = ("part", "page_id", "url", "payload", "digest", "first_id", "kind")
        for batch in batches:
            for part, page_id, url, payload, digest, first_id, kind in zip(*(batch.column(n).to_pylist() for n in fields)):
                writer.move_to(part)
                if kind == 0:
                    known = (page_id, digest, first_id)
                    continue
                again = known[:2] == (page_id, digest)
                writer.add(page_record(page_id, url, payload, known[2] if again else None, again, level))
        writer.roll()
        if writer.done:
            names = ("part", "number", "path", "n_records", "n_bytes")
            yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*writer.done)))))

    # an equi-join with the one row of bounds: a key that is always 0, though the planner does not see it
    bounds = range_bounds(digests)
    n_ranges = bounds.select(F.size("_cuts")).first()[0] + 1
    rows = rows.withColumn("_one", F.pmod(F.hash("page_id"), F.lit(1))).join(bounds, "_one")
    part = range_number(F.col("_cuts"), F.struct("page_id", "digest"))
    rows = rows.withColumn("part", part).drop("_one", "_cuts")
    dealt = rows.repartitionByRange(n_ranges, "part").sortWithinPartitions("part", "page_id", "digest", "kind", "url")
    dealt.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_records(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record, one record in memory at a time; checks block digests."""
    stream = open_input(uri)
    pending = b""
    while True:
        unzip, parts = zlib.decompressobj(31), []
        while not unzip.eof:
            pending = pending or stream.read(CHUNK)
            if not pending:
                break
            parts.append(unzip.decompress(pending))
            pending = unzip.unused_data
        if not unzip.eof:
            if parts:
                raise ValueError(f"{uri} ends inside a record")
            return
        head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        block = rest[: int(headers["Content-Length"])]
        if lines[0].encode() != VERSION or rest[len(block) :] != b"\r\n\r\n":
            raise ValueError(f"{uri} has a broken record")
        if headers["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise ValueError(f"{uri} has a record with a wrong digest")
        yield headers, block


def page_of_record(headers: dict[str, str], block: bytes) -> tuple:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of a page record."""
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"wrong payload in {headers['WARC-Record-ID']}")
    refers = headers.get("WARC-Refers-To")
    return page_of(headers["WARC-Record-ID"]), length, digest, kind, page_of(refers) if refers else None


def read_warc(manifest: DataFrame) -> DataFrame:
    """Page records of the archives in ``manifest``, a task an archive."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = [page_of_record(*r) for r in read_records(path) if r[0]["WARC-Type"] != "warcinfo"]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    n_files = max(1, manifest.count())
    dealt = manifest.select("path", "part", "number").repartitionByRange(n_files, "part", "number")
    return dealt.select("path").mapInArrow(read, RESULT)


def warc_round_trip(pages: DataFrame, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write the archives below the scratch folder and read them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_warc(write_warc(pages, folder, roll_bytes))
