"""WARC archives of captures, and a globally ordered index over them by external merge.

Writing: each capture becomes one WARC/1.1 record, built column-wise and written by
Spark's text writer with the record terminator (two CRLFs) as line separator, so an
archive is a plain uncompressed WARC file in any store Spark writes to, and a byte offset
finds a record. Captures with equal payloads (same SHA-1) of at least ``MIN_REVISIT``
bytes share one response record, that of the largest id; the rest are revisit records
that carry the HTTP header only and refer to it.

Reading: archives are read as whole files (bounded by ``FILE_BYTES``, but for a single longer
record: captures of a size class share files, fewer of them the longer they are) and parsed by
Content-Length; a response's digest is recomputed from the payload read. Each file gives
one run of index lines sorted by (URL key, timestamp, id, file, offset). Runs are cut at
global split points, and for every key range the slices of all runs are merged k ways by
a loser tree. The split points are full index keys, so a URL with any number of captures
spreads over ranges; a range holds about ``RANGE_ROWS`` lines (``MAX_RANGES`` bounds the
split points kept on the driver).

Defined cases: NULL payload is empty; NULL id is written as ``null``, is the response only
if no id is known in its group; rows that repeat the largest id are all responses; NULL or
empty URL has the key ``-``; white space and control characters in a URL become ``%20``.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkmart.llm.common import stored
from linkmart.session import scratch_dir

MIN_REVISIT = 1000
#: Payload bytes of an archive; a size class spans a factor of ``CLASS_FACTOR``.
FILE_BYTES = 64 << 20
RECORDS_PER_FILE = 4000
CLASS_FACTOR = 16
RANGE_ROWS = 20_000
MAX_RANGES = 16_384
SAMPLE_PER_RANGE = 40
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE = ("urlkey string, at string, id bigint, file string, offset bigint, length bigint, url string, "
        "record_type string, payload_bytes bigint, payload_digest string, refers_to bigint")
KEY = ("urlkey", "at", "id", "file", "offset")


def write_archives(
    spark: SparkSession, captures: DataFrame, path: str,
    min_revisit: int = MIN_REVISIT, records_per_file: int = RECORDS_PER_FILE, file_bytes: int = FILE_BYTES,
) -> None:
    """Write ``captures(id long, url, at timestamp, payload string)`` as WARC files at ``path``."""
    page = captures.select(
        F.col("id").cast("long").alias("id"),
        F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "%20").alias("url"),
        F.date_format(F.to_utc_timestamp("at", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"),
        F.coalesce("payload", F.lit("")).alias("payload"),
    ).withColumns({"digest": F.sha1(F.col("payload").cast("binary")), "bytes": F.octet_length("payload").cast("long")})

    shared = page.where(F.col("bytes") >= min_revisit).groupBy("digest").agg(
        F.count("*").alias("n"),
        F.max("id").alias("to_id"),
        F.max(F.when(F.col("id").isNotNull(), F.struct("id", "url", "at"))).alias("to"),
    ).where("n > 1 AND to_id IS NOT NULL")
    shared = stored(spark, shared.select("digest", "to_id", F.col("to.url").alias("to_url"), F.col("to.at").alias("to_at")), "warc-shared")

    r = page.join(shared, "digest", "left")
    revisit = F.col("to_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("to_id"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(CRLF * 2))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    name = lambda c: F.concat(F.lit("<urn:capture:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    field = lambda key, value: F.concat(F.lit(f"{key}: "), F.coalesce(value, F.lit("")), F.lit(CRLF))
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        field("WARC-Record-ID", name("id")),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-Date", F.col("at")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(
            field("WARC-Profile", F.lit(PROFILE)),
            field("WARC-Refers-To", name("to_id")),
            field("WARC-Refers-To-Target-URI", F.col("to_url")),
            field("WARC-Refers-To-Date", F.col("to_at")),
        )).otherwise(F.lit("")),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF), block,
    )
    sizes, size = size_classes(records_per_file, file_bytes), F.col("bytes") + F.octet_length("url")
    # one write for each size class there is; a class's longest payload and URL times its records stays in the bound
    number = F.array_size(F.filter(F.array(*[F.lit(top) for top, _ in sizes[:-1]]), lambda top: size > top))
    present = page.select(number.alias("c")).distinct().collect()  # a row per class, of which there are few
    for c in sorted(x.c for x in present) or [0]:
        low, (high, records) = sizes[c - 1][0] if c else -1, sizes[c]
        of_class = r.where((size > low) & (size <= high))
        of_class.select(record.alias("value")).write.mode("append").option("lineSep", CRLF * 2) \
            .option("maxRecordsPerFile", records).text(path)


def size_classes(records_per_file: int, file_bytes: int) -> list[tuple[int, int]]:
    """(longest payload and URL, records of a file) of each class: those of which
    ``records_per_file`` fit in a file, then ``CLASS_FACTOR`` times longer ones, until one fills it."""
    top, out = max(1, file_bytes // records_per_file), []
    while top < file_bytes:
        out.append((top, min(records_per_file, file_bytes // top)))
        top *= CLASS_FACTOR
    return [*out, (1 << 62, 1)]


def url_key(url: str | None) -> str:
    """Sort key of a URL: reversed host, path, sorted query; scheme, ``www``, default port,
    fragment and a trailing slash do not count."""
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:]*)(:\d+)?([^?#]*)(?:\?([^#]*))?", (url or "").strip().lower())
    host, port, path, query = m.groups()
    host = re.sub(r"^www\d*\.", "", host)
    if not host and not path:
        return "-"
    key = ",".join(reversed(host.split("."))) + ("" if port in (None, ":80", ":443") else port) + ")" + (path.rstrip("/") or "/")
    return key + ("?" + "&".join(sorted(query.split("&"))) if query else "")


def parse_archive(data: bytes, file: str):
    """Index lines (tuples in the order of ``LINE``) of one archive, in file order."""
    at, end = 0, len(data)
    urn = lambda x: None if x is None or x == "<urn:capture:null>" else int(x[len("<urn:capture:"):-1])
    while at < end:
        head = data.index(b"\r\n\r\n", at)
        lines = data[at:head].decode().split(CRLF)
        if not lines[0].startswith("WARC/1."):
            raise ValueError(f"{file}: no record at byte {at}")
        f = dict(x.split(": ", 1) for x in lines[1:])
        body, n = head + 4, int(f["Content-Length"])
        stop = body + n
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"{file}: the record at byte {at} is cut short")
        http = data.index(b"\r\n\r\n", body, stop)
        digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
        if f["WARC-Type"] == "response":
            size = stop - http - 4
            if hashlib.sha1(memoryview(data)[http + 4:stop]).hexdigest() != digest:
                raise ValueError(f"{file}: payload digest differs at byte {at}")
        else:
            size = int(re.search(rb"\r\nContent-Length: (\d+)", data[body:http + 2])[1])
        url = f["WARC-Target-URI"]
        yield (url_key(url), f["WARC-Date"], urn(f["WARC-Record-ID"]), file, at, stop - at, url,
               f["WARC-Type"], size, digest, urn(f.get("WARC-Refers-To")))
        at = stop + 4


def _order(line) -> tuple:
    return (line[0], line[1], line[2] is not None, line[2] or 0, line[3], line[4])


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """One row per archive under ``path``: its index lines sorted by key, as ``run``."""

    def run(batches):
        for batch in batches:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                lines = sorted(parse_archive(data.as_buffer().to_pybytes(), file.rsplit("/", 1)[-1]), key=_order)
                names = [x.split()[0] for x in LINE.split(", ")]
                if lines:
                    rows = pa.StructArray.from_arrays([pa.array(c) if i not in _LONGS else pa.array(c, pa.int64())
                                                       for i, c in enumerate(zip(*lines))], names)
                    yield pa.record_batch([pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), rows)], names=["run"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, f"run array<struct<{_struct()}>>")


_LONGS = {i for i, x in enumerate(LINE.split(", ")) if x.endswith("bigint")}


def _struct() -> str:
    return ", ".join(f"{a}: {b}" for a, b in (x.split() for x in LINE.split(", ")))


def loser_tree_merge(runs: list[list]):
    """Merge sorted lists: yields (run number, place in it) in global order.

    Each inner node keeps the loser of its match; a new head replays one leaf-to-root path.
    """
    k = len(runs)
    heads, tree = [0] * k, [-1] * max(1, k)

    def beats(a: int, b: int) -> bool:
        """Whether run a's head goes before run b's (an ended run loses, ties to the first)."""
        if a == -1 or b == -1:
            return a == -1
        ended_a, ended_b = heads[a] >= len(runs[a]), heads[b] >= len(runs[b])
        if ended_a or ended_b:
            return not ended_a
        x, y = runs[a][heads[a]], runs[b][heads[b]]
        return x < y or (x == y and a < b)

    def replay(winner: int) -> None:
        node = (winner + k) // 2
        while node > 0:
            if beats(tree[node], winner):
                tree[node], winner = winner, tree[node]
            node //= 2
        tree[0] = winner

    for leaf in range(k):  # -1 wins every match until all leaves have played
        replay(leaf)
    for _ in range(sum(map(len, runs))):
        w = tree[0]
        yield w, heads[w]
        heads[w] += 1
        replay(w)


def merge_runs(spark: SparkSession, runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The lines of all ``runs`` with ``position`` (0-based place in global key order) and
    ``capture_no`` (1-based place in the history of the URL key)."""
    lines = runs.select(F.explode("run").alias("x"))
    total = lines.count()
    ranges = max(1, min(MAX_RANGES, -(-total // range_rows)))
    want = ranges * SAMPLE_PER_RANGE
    step = max(1, total // want)
    sample = lines.where(F.pmod(F.xxhash64(*[f"x.{c}" for c in KEY]), F.lit(step)) == 0).select(*[f"x.{c}" for c in KEY])
    keys = sorted(_order(r) for r in sample.collect()) if ranges > 1 else []
    cuts = [keys[len(keys) * i // ranges] for i in range(1, ranges)] if keys else []
    kind = f"array<struct<{_struct()}>>"

    def cut(batches):
        for batch in batches:
            for run in batch.column(0):
                rows = run.values
                order = list(zip(*(rows.field(c).to_pylist() for c in KEY)))
                places = [0] * len(cuts)
                for i, c in enumerate(cuts):
                    places[i] = bisect_right(order, c, key=_order)
                bounds = [0, *places, len(order)]
                full = [(i, a, b) for i, (a, b) in enumerate(zip(bounds, bounds[1:])) if b > a]
                offsets = pa.array([full[0][1], *(b for _, _, b in full)], pa.int32()) if full else pa.array([0], pa.int32())
                yield pa.record_batch([pa.array([i for i, _, _ in full], pa.int32()), pa.ListArray.from_arrays(offsets, rows)], names=["part", "run"])

    def merge(table: pa.Table) -> pa.Table:
        slices = table.column("run").combine_chunks()
        rows = slices.flatten()
        order = [_order(x) for x in zip(*(rows.field(c).to_pylist() for c in KEY))]
        starts, runs_, at = [], [], 0
        for n in slices.value_lengths().to_pylist():
            starts.append(at)
            runs_.append(order[at:at + n])
            at += n
        rows = rows.take(pa.array([starts[r] + i for r, i in loser_tree_merge(runs_)], pa.int64()))
        part = table.column("part")[0].as_py()
        names = [rows.type.field(i).name for i in range(rows.type.num_fields)]
        return pa.table([pa.array([part] * len(rows), pa.int32()), pa.array(range(len(rows)), pa.int64()), *rows.flatten()], names=["part", "place", *names])

    slices = runs.mapInArrow(cut, f"part int, run {kind}")
    merged = stored(spark, slices.groupBy("part").applyInArrow(merge, f"part int, place bigint, {LINE}"), "warc-index")
    before = merged.groupBy("part").agg(F.count("*").alias("n")).select(  # at most MAX_RANGES rows
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    placed = stored(spark, merged.join(before, "part").withColumn("position", F.col("base") + F.col("place")).drop("part", "place", "base"), "warc-placed")
    first = stored(spark, placed.groupBy("urlkey").agg(F.min("position").alias("first")), "warc-first")
    return placed.join(first, "urlkey").withColumn("capture_no", F.col("position") - F.col("first") + 1).drop("first")


def archive_and_index(
    spark: SparkSession, captures: DataFrame, min_revisit: int = MIN_REVISIT,
    records_per_file: int = RECORDS_PER_FILE, range_rows: int = RANGE_ROWS, path: str | None = None, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write ``captures(id, url, at, payload)`` as archives, read them back and return the
    merged index: one row per capture in the columns of ``LINE``, position and capture_no."""
    path = path or scratch_dir(spark, "warc")
    write_archives(spark, captures, path, min_revisit, records_per_file, file_bytes)
    return merge_runs(spark, stored(spark, read_runs(spark, path), "warc-runs"), range_rows)
