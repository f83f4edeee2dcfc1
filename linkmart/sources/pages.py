"""Paged JSON sources.

A page is one JSON document ``{"data": [record, ...], ...}`` with up to ``PAGE_SIZE``
records, landed as ``<root>/source=<name>[/run=<id>]/page=<n>/<file>``. Files are read
whole; source, run and page come from the folders; records are VARIANTs so strings, numbers,
nulls and arrays stay distinguishable. A run is one extraction of a source: its pages are
applied after those of earlier runs, in the order of the run ids with digits read as
numbers; pages without a run folder are one run, in which a page landed again comes after
its earlier landing. A source either has run folders or has none.

A folder and a file for each page cost more than the page once there are many, so pages may
also lie packed in ``page=packed/<file>``, a line ``<page>\\t<text in base64>`` each and up to
``PACKED_PAGES`` in a file (see ``pack_pages``). A packed page's ``file`` is that of its line.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmart.functions.json_ops import exact_numbers, json_kind
from linkmart.sources.tables import _fs

# Records per page; pages end at the first empty or short page.
PAGE_SIZE = 50
PACKED = "packed"
PACKED_PAGES = 256

#: Digits to which a number in a run id is padded.
_DIGITS = 40


def landed_runs(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """``(source, run, folder)`` of every run landed under ``path``, '' for a source without run
    folders. Lists the folders of sources and runs, not those of pages."""
    fs, root = _fs(spark, path)

    def folders(at, name):
        if not fs.exists(at):
            return
        listed = fs.listStatusIterator(at)
        while listed.hasNext():
            st = listed.next()
            if st.isDirectory() and st.getPath().getName().startswith(f"{name}="):
                yield unquote(st.getPath().getName()[len(name) + 1:]), st.getPath()

    found = []
    for source, at in folders(root, "source"):
        if next(folders(at, "page"), None):  # a source's first folder shows its layout
            found.append((source, "", at.toString()))
        found += [(source, run, folder.toString()) for run, folder in folders(at, "run")]
    return sorted(found)


def run_key(run: str) -> str:
    """Text whose order is the order of runs: digits count as numbers (``9`` before ``10``)."""
    return re.sub(r"\d+", lambda m: m.group().zfill(_DIGITS), run)


def run_order(run: Column) -> Column:
    """``run_key`` of a column."""
    padded = F.regexp_replace(run, r"(\d+)", "0" * _DIGITS + "$1")
    return F.regexp_replace(padded, rf"\d*(\d{{{_DIGITS}}})", "$1")


def pack_pages(pages: DataFrame, path: str, mode: str) -> None:
    """Land ``source[, run], page, value``, the text of each page, packed. Rows that lie together
    by ``PACKED_PAGES`` consecutive page numbers give few files."""
    line = F.concat(F.coalesce(F.col("page").cast("string"), F.lit("")), F.lit("\t"), F.translate(F.base64(F.col("value").cast("binary")), "\r\n", ""))
    keys = [c for c in ("source", "run") if c in pages.columns]
    (pages.select(*keys, F.lit(PACKED).alias("page"), line.alias("value"))
     .write.mode(mode).option("maxRecordsPerFile", PACKED_PAGES).partitionBy(*keys, "page").text(path))


def _unpacked(files: DataFrame, page: Column) -> DataFrame:
    """One row per page: ``files`` with ``_page`` (text), ``_file`` and ``_content`` for path and content.
    (``inline_outer`` for the reason given in ``page_rows``.)"""
    lines = F.filter(F.split(F.col("content").cast("string"), "\n"), lambda x: x != "")
    packed = F.transform(lines, lambda x, i: F.struct(
        F.split_part(x, F.lit("\t"), F.lit(1)).alias("_page"), F.concat("path", F.lit("#"), F.lpad(i.cast("string"), 9, "0")).alias("_file"),
        F.unbase64(F.split_part(x, F.lit("\t"), F.lit(2))).alias("_content")))
    single = F.array(F.struct(page.alias("_page"), F.col("path").alias("_file"), F.col("content").alias("_content")))
    kept = [c for c in files.columns if c not in ("content", "length")]
    return files.select(*kept, F.inline_outer(F.when(page == PACKED, packed).otherwise(single))).where("_file IS NOT NULL")


def _located(files: DataFrame, source: Column, run: Column, page: Column) -> DataFrame:
    """``source, run, page, file, modified, records`` of whole pages; ``page`` is the folder's text.

    ``records`` holds the elements of ``data`` as ``(value VARIANT, text)``; it is NULL for a
    page that is cut off, no JSON object, or whose ``data`` is neither an array nor missing.
    In a whole page in which single records do not parse, the others do, and those have a
    NULL value and their ``text``."""
    text = F.try_validate_utf8(F.col("_content").cast("string"))
    parsed = _unpacked(files, page).select(source.alias("source"), run.alias("run"), F.col("_page").try_cast("int").alias("page"), F.col("_file").alias("file"),
                          F.col("modificationTime").alias("modified"), text.alias("_t"), F.try_parse_json(exact_numbers(text)).alias("_v"))
    data = F.try_variant_get("_v", "$.data", "variant")
    kind = json_kind(data)
    whole = F.transform(F.try_variant_get(data, "$", "array<variant>"),
                        lambda x: F.struct(x.alias("value"), F.lit(None).cast("string").alias("text")))
    # an object by its first and last character that fails to parse fails inside
    closed = F.col("_t").rlike(r"^\s*\{") & F.col("_t").rlike(r"\}\s*$")
    parts = F.transform(F.from_json("_t", "data array<string>")["data"],
                        lambda x: F.struct(F.try_parse_json(exact_numbers(x)).alias("value"), x.alias("text")))
    none = F.array().cast("array<struct<value:variant,text:string>>")
    records = F.when(json_kind(F.col("_v")) == "object", F.when(kind.isNull() | (kind == "null"), none).when(kind == "array", whole)) \
        .when(F.col("_v").isNull() & closed, parts)
    return parsed.select("source", "run", "page", "file", "modified", records.alias("records"))


_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def read_pages(spark: SparkSession, path: str, runs: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Landed pages, one row per page (see ``_located``), however their JSON is laid out.

    Source, run and page are the partition columns of the folders, as text, so a filter on
    them prunes the files read. ``runs`` (of ``landed_runs``) restricts the read, and the
    listing of page files, to those runs. Spark's scans leave zero-byte files out: such a
    page is missing (see ``missing_pages``)."""
    runs = landed_runs(spark, path) if runs is None else runs
    place = [F.col("source"), F.coalesce("run", F.lit("")), F.col("page")]
    out = None
    for keys, folders in (("source string, run string, page string", [f for _, run, f in runs if run]),
                          ("source string, page string", [f for _, run, f in runs if not run])):
        if folders:
            # user-given types keep 007 as it is; pages of a source without runs lie one folder higher
            files = spark.read.format("binaryFile").schema(f"{_FILE}, {keys}").option("basePath", path).load(folders)
            located = _located(files if "run" in files.columns else files.withColumn("run", F.lit(None).cast("string")), *place)
            out = located if out is None else out.unionByName(located)
    if out is None:
        nothing = spark.createDataFrame([], f"{_FILE}, source string, run string, page string")
        return _located(nothing, *place)
    return out


def read_pages_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Same columns as ``read_pages`` as a file stream; one page per micro-batch by
    default. File order is not page order: ``run`` and ``page`` travel as columns, taken from
    the path (a stream has one set of partition columns, which not every source may have)."""

    def place(name: str) -> Column:
        found = F.regexp_extract("path", f"/{name}=([^/]+)/", 1)
        return F.when(found != "", F.coalesce(F.try_url_decode(F.try_url_decode(found)), found))

    files = spark.readStream.format("binaryFile").schema(_FILE).option("recursiveFileLookup", True) \
        .option("maxFilesPerTrigger", files_per_trigger).load(path)
    return _located(files, place("source"), F.coalesce(place("run"), F.lit("")), place("page"))


def load_id(rows: DataFrame) -> Column:
    """Names the landing a row came from: the same for a replay, another for each landing."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("run", "file", "modified") if c in rows.columns]
    return F.concat_ws("|", *parts) if parts else F.lit("")


def page_rows(pages: DataFrame) -> DataFrame:
    """One row per record, and one without ``pos`` for a page that has none:
    ``source_name, run, page, file, modified, bad, n, pos, value VARIANT, text``; ``bad`` tells
    whether the page is malformed, ``n`` is the number of its records.
    (``posexplode_outer``: an inner one makes the optimizer infer a pre-filter that parses twice.)"""
    return pages.select(
        F.col("source").alias("source_name"), "run", "page", "file", "modified",
        F.col("records").isNull().alias("bad"), F.coalesce(F.array_size("records"), F.lit(0)).cast("long").alias("n"),
        F.posexplode_outer("records").alias("pos", "_r"),
    ).select("source_name", "run", "page", "file", "modified", "bad", "n", "pos", "_r.value", "_r.text")


def explode_records(pages: DataFrame) -> DataFrame:
    """One row per element of ``data``: ``source_name, run, page, file, modified, pos, value
    VARIANT, text``. A missing or JSON-null ``data`` is an empty page; malformed pages give
    no rows here (see ``malformed_pages``)."""
    return page_rows(pages).where(F.col("pos").isNotNull()).drop("bad", "n")


def malformed_pages(pages: DataFrame) -> DataFrame:
    """Pages that are cut off, no JSON object, or whose ``data`` is no array."""
    return pages.where(F.col("records").isNull()).select(F.col("source").alias("source_name"), "run", "page")


def page_sizes(pages: DataFrame) -> DataFrame:
    """``source, run, page, bad, n``: whether each page is malformed and its records."""
    return pages.select("source", "run", "page", F.col("records").isNull().alias("bad"),
                        F.coalesce(F.array_size("records"), F.lit(0)).cast("long").alias("n"))


def missing_pages(pages: DataFrame) -> DataFrame:
    """``source_name, run, page``: where a gap in the page numbers of a run starts. A join of
    each page with its successor, so a run of any length spreads over tasks."""
    at = pages.select(F.col("source").alias("source_name"), "run", "page").distinct()
    last = at.groupBy("source_name", "run").agg(F.max("page").alias("last"))
    after = at.select("source_name", "run", (F.col("page") + 1).alias("page")).unionByName(
        at.select("source_name", "run", F.lit(0).alias("page")).distinct())
    return after.join(at, ["source_name", "run", "page"], "left_anti").join(last, ["source_name", "run"]) \
        .where("page < last").select("source_name", "run", "page")


def page_report(pages: DataFrame) -> DataFrame:
    """Per source: pages, records, malformed pages, missing page numbers, and whether
    the listing ends properly (every page but the last is full, the last is short)."""
    sizes = page_sizes(pages).withColumnRenamed("source", "source_name")
    agg = sizes.groupBy("source_name").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("n").alias("records"),
        F.count_if("bad").alias("malformed"),
        (F.max("page") + 1 - F.count_distinct("page")).alias("missing_pages"),
        F.max_by("n", "page").alias("last_page_records"),
        F.count_if((F.col("n") < PAGE_SIZE)).alias("short_pages"),
    )
    return agg.withColumn(
        "complete",
        (F.col("malformed") == 0) & (F.col("missing_pages") == 0)
        & (F.col("last_page_records") < PAGE_SIZE) & (F.col("short_pages") == 1),
    )


def ingest_pages(pages: DataFrame, now, on_malformed: str = "fail",
                 on_duplicate: str = "last") -> tuple[dict, DataFrame]:
    """Batch ingestion of landed pages: ``({source: incoming records}, quarantine)``.

    Incoming records are ``(id, payload, _order)`` with ``_order = (run, page, pos)``, so the
    refresh job keeps the latest record per id (``latest_per_key``, a partial aggregate).
    Malformed and missing pages raise (``on_malformed="fail"``), or malformed ones become ``malformed_page``
    quarantine rows (``"quarantine"``). ``on_duplicate="error"`` raises when one page
    holds the same id twice (a single-page upsert in the modelled database fails the
    same way); ``"last"`` lets the later position win. The source list is the distinct
    source names."""
    from linkmart.operators.records import label_records, quarantine

    bad_pages = malformed_pages(pages)
    if on_malformed == "fail":
        wrong = bad_pages.withColumn("kind", F.lit("malformed")).unionByName(missing_pages(pages).withColumn("kind", F.lit("missing")))
        first = wrong.orderBy("source_name", "page").first()
        if first is not None:
            raise ValueError(f"{first['kind']} page {first['page']} of {first['source_name']}")
    labelled = label_records(explode_records(pages))
    good = labelled.where(F.col("reason").isNull())
    bad = labelled.where(F.col("reason").isNotNull())
    if on_duplicate == "error":
        from linkmart.operators.upsert import DuplicateKeyError

        dup = (good.groupBy("source_name", "run", "page", "file", "id").count()
               .where(F.col("count") > 1).first())
        if dup is not None:
            raise DuplicateKeyError(
                f"id {dup['id']!r} twice on page {dup['page']} of {dup['source_name']}")
    if on_malformed == "quarantine":
        bad = bad.unionByName(bad_pages.select(
            "source_name", "run", "page", F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("id"),
            F.lit(None).cast("string").alias("payload"), F.lit("malformed_page").alias("reason")),
            allowMissingColumns=True)
    sources = [r[0] for r in pages.select("source").distinct().collect()]  # one per folder
    incoming = {
        s: good.where(F.col("source_name") == s).select(
            "id", "payload", F.struct(run_order(F.col("run")).alias("run"), F.col("page").cast("long").alias("page"),
                                      "modified", F.col("pos").cast("long").alias("pos")).alias("_order"))
        for s in sources
    }
    return incoming, quarantine(bad, now, load_id(bad))
