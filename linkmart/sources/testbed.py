"""Raw-shaped entity records derived from the driver's generated tables.

Every frame is built row-wise from a given table (no grouping except the bounded
per-(user, day) change log and the bounded 50-record pages), so the work grows with the
tables. Faults are injected by key modulo so plain SQL can state the expected result:

orders (entity with a link array ``customers`` and a long-form date), key k = o_orderkey
  name        k%17=0 absent | k%19=0 '   ' | k%23=0 JSON null | else ' Order <k> '
  order_date  k%7=0 ISO 'yyyy-MM-dd' (not parsed) | else 'Month D, YYYY'
  customers   k%29=0 JSON null | k%31=0 absent | k%37=0 [] | else [u] + (k%5=0: [u])
              + (k%11=0: [dangling url 'x<k>']) + (k%13=0: [u + '/'])
  status      batch 2: o_orderstatus || '2' when k%4=0
  batch 2 leaves out k%41=0
customers: id, name, segment (batch 2: lower(segment) when c_custkey%3=0)
parts: id, name, brand; suppliers: id, name
users: latest event per (user_id, day) from events: event_type, name, props (JSON)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmart.sources.pages import PACKED_PAGES, PAGE_SIZE, pack_pages

# Fixed values used by both the Spark side and the oracle SQL.
BASE_URL = "https://api.example.test/v1"
T1 = "2024-02-01 00:00:00"
T2 = "2024-02-02 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. ``spark.sql.files.maxPartitionBytes`` sets the size of its splits."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` dealt over the cluster by their key. A file is read by as many tasks as it has
    row groups or splits, and records cost far more to make than their columns to read."""
    return rows.repartition(key)


def url(entity: str, key) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit(f"{BASE_URL}/{entity}/"), k.cast("string"))


def _var(c: Column) -> Column:
    return c.cast("variant")


def _json_null() -> Column:
    return F.parse_json(F.lit("null"))


def _absent() -> Column:
    return F.lit(None).cast("variant")


def _payload(**fields: Column) -> Column:
    """Compact JSON text with keys in sorted order (the canonical form): SQL NULL fields
    are left out, ``JSON-null fields are written as ``null``."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))


def _mod(k: Column, m: int) -> Column:
    return (k % m) == 0


def order_records(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    o = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    k = F.col("o_orderkey")
    if batch == 2:
        o = o.where(~_mod(k, 41))
    u = url("customers", "o_custkey")
    empty = F.array().cast("array<string>")
    links = F.concat(
        F.array(u),
        F.when(_mod(k, 5), F.array(u)).otherwise(empty),
        F.when(_mod(k, 11), F.array(url("customers", F.concat(F.lit("x"), k.cast("string")))))
        .otherwise(empty),
        F.when(_mod(k, 13), F.array(F.concat(u, F.lit("/")))).otherwise(empty),
    )
    customers = (
        F.when(_mod(k, 29), _json_null()).when(_mod(k, 31), _absent())
        .when(_mod(k, 37), _var(empty)).otherwise(_var(links))
    )
    name = (
        F.when(_mod(k, 17), _absent()).when(_mod(k, 19), _var(F.lit("   ")))
        .when(_mod(k, 23), _json_null())
        .otherwise(_var(F.concat(F.lit(" Order "), k.cast("string"), F.lit(" "))))
    )
    odate = F.when(_mod(k, 7), F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
        F.date_format("o_orderdate", "MMMM d, yyyy"))
    status = F.col("o_orderstatus")
    if batch == 2:
        status = F.when(_mod(k, 4), F.concat(status, F.lit("2"))).otherwise(status)
    return o.select(
        k.cast("string").alias("id"),
        _payload(customers=customers, id=_var(k.cast("string")), name=name,
                 order_date=_var(odate), priority=_var(F.col("o_orderpriority")),
                 status=_var(status)).alias("payload"),
    )


def customer_records(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    c = spread(table(spark, sf_dir, "customer"), "c_custkey")
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    if batch == 2:
        seg = F.when(_mod(k, 3), F.lower(seg)).otherwise(seg)
    return c.select(
        k.cast("string").alias("id"),
        _payload(id=_var(k.cast("string")), name=_var(F.col("c_name")),
                 segment=_var(seg)).alias("payload"),
    )


def part_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey").cast("string")
    return p.select(k.alias("id"), _payload(
        brand=_var(F.col("p_brand")), id=_var(k), name=_var(F.col("p_name"))).alias("payload"))


def supplier_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey").cast("string")
    return s.select(k.alias("id"), _payload(id=_var(k), name=_var(F.col("s_name"))).alias("payload"))


def as_raw(records: DataFrame, extracted_at: str = T1) -> DataFrame:
    """``(id, payload, extracted_at)`` as a raw table loaded at ``extracted_at``."""
    return records.select("id", "payload", F.lit(extracted_at).cast("timestamp").alias("extracted_at"))


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily batches of the ``users`` entity from ``events``: the latest event per
    (user, day) -> ``id, day, payload, name, event_type, props``. ``max_by`` is a partial
    aggregate, so a hot user is combined map-side."""
    e = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "props")
    last = F.max_by(F.struct("event_type", "props"), F.struct("ts", "event_id"))
    daily = e.groupBy("user_id", F.date_trunc("day", "ts").alias("day")).agg(last.alias("_e"))
    uid = F.col("user_id").cast("string")
    name = F.concat(F.lit("user-"), uid)
    props = F.try_parse_json(F.col("_e.props"))
    return daily.select(
        uid.alias("id"),
        "day",
        _payload(event_type=_var(F.col("_e.event_type")), id=_var(uid), name=_var(name),
                 props=props).alias("payload"),
        name.alias("name"),
        F.col("_e.event_type").alias("event_type"),
        F.to_json(props).alias("props"),
    )


def customer_page_records(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    """Customers as API records for landing: page = c_custkey div 50, pos = c_custkey % 50.
    Record faults: k%97=0 a JSON string (not_a_dict); k%89=0 no id; k%83=0 id 0 (falsy)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    if batch == 2:
        seg = F.when(_mod(k, 3), F.lower(seg)).otherwise(seg)
    good = _payload(id=_var(k.cast("string")), name=_var(F.col("c_name")), segment=_var(seg))
    json = (
        F.when(_mod(k, 97), F.concat(F.lit('"broken-'), k.cast("string"), F.lit('"')))
        .when(_mod(k, 89), _payload(name=_var(F.col("c_name"))))
        .when(_mod(k, 83), _payload(id=_var(F.lit(0)), name=_var(F.col("c_name"))))
        .otherwise(good)
    )
    return c.select(
        F.lit("customers").alias("source"),
        (k / PAGE_SIZE).cast("long").cast("int").alias("page"),
        (k % PAGE_SIZE).cast("int").alias("pos"),
        json.alias("json"),
    )


def corrupt_page() -> Column:
    """Page text in which pages with page % 9 = 4 are cut off (malformed JSON)."""
    return F.when((F.col("page") % 9) == 4, F.expr("substring(_b, 1, length(_b) - 3)")).otherwise(F.col("_b"))


def user_page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users change log as daily extractions: run = day, page = user_id div 50, so every
    run lands the same pages again with what changed; a page holds at most PAGE_SIZE records."""
    ch = user_changes(spark, sf_dir)
    uid = F.col("id").cast("long")
    return ch.select(
        F.lit("users").alias("source"),
        F.date_format("day", "yyyy-MM-dd").alias("run"),
        (uid / PAGE_SIZE).cast("long").alias("page"),
        (uid % PAGE_SIZE).cast("int").alias("pos"),
        F.col("payload").alias("json"),
        "id",
    )


def user_page_time() -> Column:
    """Load time of a users page: the start of its run's day, in the session time zone (the
    same wall-clock midnight ``date_trunc('day', ...)`` gives)."""
    return F.to_date("run").cast("timestamp")


def customer_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers extracted twice (runs 1 and 2): the second time lower(segment) where
    c_custkey%3=0; the same broken records both times."""
    first = customer_page_records(spark, sf_dir).withColumn("run", F.lit("1"))
    again = customer_page_records(spark, sf_dir, batch=2).withColumn("run", F.lit("2"))
    return first.unionByName(again)


def extraction_records(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    """Customers and suppliers as one extraction of each, key k on page k div 50:

    run 8   both, as they are
    run 9   customers from page 1 on, lower(segment) where k%3=0
    run 10  both: customers with segment || '10' where k%4=0, suppliers with name || '10' where k%2=0

    A row without json on the page after the last key makes an empty page, with which a
    source ends whose last page is full."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    seg = F.col("c_mktsegment")
    if run == "9":
        c, seg = c.where(k >= PAGE_SIZE), F.when(_mod(k, 3), F.lower(seg)).otherwise(seg)
    if run == "10":
        seg = F.when(_mod(k, 4), F.concat(seg, F.lit("10"))).otherwise(seg)
    out = c.select(F.lit("customers").alias("source"), k.alias("k"), _payload(
        id=_var(k.cast("string")), name=_var(F.col("c_name")), segment=_var(seg)).alias("json"))
    if run != "9":
        sup, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
        name = F.col("s_name")
        if run == "10":
            name = F.when(_mod(k, 2), F.concat(name, F.lit("10"))).otherwise(name)
        out = out.unionByName(sup.select(F.lit("suppliers").alias("source"), k.alias("k"), _payload(
            id=_var(k.cast("string")), name=_var(name)).alias("json")))
    ends = out.groupBy("source").agg((F.max("k") + PAGE_SIZE).alias("k"), F.lit(None).cast("string").alias("json"))
    out = out.unionByName(ends)
    return out.select("source", F.lit(run).alias("run"), F.expr("cast(k div 50 as int)").alias("page"),
                      F.expr("cast(k % 50 as int)").alias("pos"), "json")


def broken_extraction_page() -> Column:
    """Page text in which customers' page 2 of run 8 and page 1 of run 10 are cut off."""
    cut = (F.col("source") == "customers") & (
        ((F.col("run") == "8") & (F.col("page") == 2)) | ((F.col("run") == "10") & (F.col("page") == 1)))
    return F.when(cut, F.expr("substring(_b, 1, length(_b) - 3)")).otherwise(F.col("_b"))


def land_pages(records: DataFrame, out_dir: str, source: str = "source", page: str = "page",
               pos: str = "pos", json: str = "json", run: str | None = None,
               body: Column | None = None, mode: str = "overwrite") -> None:
    """Land one JSON page per (source[, run], page), packed, from one-record-per-row input.

    Pages are bounded groups (``pos < PAGE_SIZE``), so gathering a page's records is a
    bounded ``collect_list``; ``sort_array`` on (pos, json) fixes the record order. One exchange
    brings the pages of a file together. ``body`` (over source/page and the page's text ``_b``)
    replaces what is written. ``mode="append"`` lands more pages next to earlier ones."""
    keys = ["source", *(["run"] if run else []), "page"]
    columns = dict(zip(keys, [source, *([run] if run else []), page]))
    rows = records.select(*[F.col(c).alias(k) for k, c in columns.items()], F.col(pos).alias("p"), F.col(json).alias("j"))
    rows = rows.withColumn("_file", F.floor(F.col("page") / PACKED_PAGES)).repartition(*keys[:-1], "_file")
    grouped = rows.groupBy(*keys, "_file").agg(F.sort_array(F.collect_list(F.struct("p", "j"))).alias("_r"))
    grouped = grouped.withColumn("_b", F.concat(
        F.lit('{"data":['), F.array_join(F.transform("_r", lambda x: x["j"]), ","), F.lit("]}")))
    pack_pages(grouped.select(*keys, (F.col("_b") if body is None else body).alias("value")), out_dir, mode)
