"""The modelled warehouse's eight entities over the driver's tables: every staging, link,
snapshot, dimension and fact model of the catalog, with the SQL that states its rows.

Records come from four tables, key k: games and bosses from part, staff and places from supplier,
characters, dungeons and items from customer, monsters from orders.

  name       '<table> <k> ' (a space behind it, which staging trims); batch 2: '*' before that
             space where k%3=0
  batch 2    leaves out k%41=0
  links      k%29=0 JSON null | k%31=0 absent | else [u], again [u] where k%5=0, a dangling one
             where k%11=0, one with a slash behind it where k%13=0; u is the url of id k
  games      released_date in long form, ISO where k%5=0; publisher absent where k%7=0
  characters gender JSON null where k%6=0
  places     no description

A layer's query gives all its models as (model, row): the model's columns in their order as
text, ``~`` for NULL, with ``|`` between them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmart.operators.snapshots import META
from linkmart.plans.catalog import WAREHOUSE
from linkmart.session import scratch_dir, sized_session
from linkmart.sources import testbed as tb

# The tables behind the entities.
TABLES = {
    "games": ("part", "p_partkey"), "bosses": ("part", "p_partkey"), "staff": ("supplier", "s_suppkey"),
    "places": ("supplier", "s_suppkey"), "characters": ("customer", "c_custkey"), "dungeons": ("customer", "c_custkey"),
    "items": ("customer", "c_custkey"), "monsters": ("orders", "o_orderkey"),
}


# -- records ------------------------------------------------------------------------------


def _links(target: str, k: Column) -> Column:
    u, none = tb.url(target, k), F.array().cast("array<string>")
    urls = F.concat(
        F.array(u), F.when(k % 5 == 0, F.array(u)).otherwise(none),
        F.when(k % 11 == 0, F.array(tb.url(target, F.concat(F.lit("x"), k.cast("string"))))).otherwise(none),
        F.when(k % 13 == 0, F.array(F.concat(u, F.lit("/")))).otherwise(none))
    return F.when(k % 29 == 0, tb._json_null()).when(k % 31 == 0, tb._absent()).otherwise(tb._var(urls))


def _attributes(entity: str, k: Column) -> dict[str, Column]:
    text = {
        "games": {"description": F.col("p_type"), "developer": F.col("p_brand")},
        "bosses": {"description": F.col("p_type")},
        "characters": {"description": F.col("c_name"), "race": F.col("c_mktsegment")},
        "dungeons": {"description": F.col("c_mktsegment")}, "items": {"description": F.col("c_name")},
        "monsters": {"description": F.col("o_orderpriority")},
    }
    out = {name: tb._var(c) for name, c in text.get(entity, {}).items()}
    if entity == "games":
        day = F.date_add(F.lit("1990-01-01").cast("date"), k.cast("int"))
        date = F.when(k % 5 == 0, F.date_format(day, "yyyy-MM-dd")).otherwise(F.date_format(day, "MMMM d, yyyy"))
        publisher = F.when(k % 7 == 0, tb._absent()).otherwise(tb._var(F.concat(F.lit("Publisher "), F.col("p_size").cast("string"))))
        out |= {"released_date": tb._var(date), "publisher": publisher}
    if entity == "characters":
        out["gender"] = F.when(k % 6 == 0, tb._json_null()).otherwise(tb._var(F.when(k % 2 == 0, F.lit("f")).otherwise(F.lit("m"))))
    return out


def records(spark: SparkSession, sf_dir: str, entity: str, batch: int) -> DataFrame:
    """``(id, payload)`` of one entity's batch (see the module)."""
    table, key = TABLES[entity]
    rows, k = tb.spread(tb.table(spark, sf_dir, table), key), F.col(key)
    star = F.lit("")
    if batch == 2:
        rows, star = rows.where(k % 41 != 0), F.when(k % 3 == 0, F.lit("*")).otherwise(F.lit(""))
    name = F.concat(F.lit(f"{table} "), k.cast("string"), star, F.lit(" "))
    fields = {"id": tb._var(k.cast("string")), "name": tb._var(name), **_attributes(entity, k),
              **{lk.key: _links(lk.target, k) for lk in WAREHOUSE.entity(entity).links}}
    return rows.select(k.cast("string").alias("id"), tb._payload(**fields).alias("payload"))


_BUILT: dict = {}


def warehouse(spark: SparkSession, sf_dir: str):
    """(raw, snapshots) after both batches, built once per session and table folder, in a session
    sized by the records (see ``sized_session``), which also runs what is read from them."""
    from linkmart.plans.refresh import ingest_and_snapshot
    from linkmart.sources.tables import _fs

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), spark.conf.get("spark.sql.session.timeZone"))
    if key in _BUILT:
        fs, p = _fs(spark, _BUILT[key][0])
        if fs.exists(p):
            sized_session(spark, *_BUILT[key][3:])
            return _BUILT[key][1:3]
    out, rows = scratch_dir(spark, "warehouse"), sum(tb.table(spark, sf_dir, t).count() for t, _ in TABLES.values())
    own = sized_session(spark, rows)
    for batch, now in ((1, tb.T1), (2, tb.T2)):
        raw, snaps = ingest_and_snapshot(own, WAREHOUSE, {e: records(own, sf_dir, e, batch) for e in TABLES}, out, now)
    _BUILT[key] = (out, raw, snaps, rows, own)
    return raw, snaps


# -- queries --------------------------------------------------------------------------------


def _as_text(model: str, df: DataFrame) -> DataFrame:
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        text = F.to_json(c) if f.dataType.typeName() == "array" else c.cast("string")
        parts.append(F.coalesce(text, F.lit("~")))
    return df.select(F.lit(model).alias("model"), F.concat_ws("|", *parts).alias("row"))


def _layer(models: dict[str, DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [_as_text(name, df) for name, df in models.items()])


def _models(spark, sf_dir):
    from linkmart.plans.models import build_models

    return build_models(WAREHOUSE, *warehouse(spark, sf_dir))


def warehouse_staging(spark, sf_dir):
    """The eight staging models, read through their views."""
    from linkmart.plans.models import register_views

    models = _models(spark, sf_dir)
    names, own = register_views(models, "warehouse_"), models.staged["games"].sparkSession  # the views' session
    return _layer({n.removeprefix("warehouse_"): own.table(n) for n in names if n.startswith("warehouse_stg_")})


def warehouse_links(spark, sf_dir):
    """The nine link models."""
    return _layer({f"int_{e}__{lk}": df for (e, lk), df in _models(spark, sf_dir).links.items()})


def warehouse_snapshots(spark, sf_dir):
    """The eight snapshots, all versions."""
    _, snaps = warehouse(spark, sf_dir)
    out = {}
    for spec in WAREHOUSE.entities:
        out[f"snapshot_{spec.name}"] = snaps[spec.name].select(spec.key, *[k for k, _ in spec.snapshot_columns()], *META)
    return _layer(out)


def warehouse_dimensions(spark, sf_dir):
    """The eight dimensions."""
    return _layer({f"dim_{name}": df for name, df in _models(spark, sf_dir).dims.items()})


def warehouse_facts(spark, sf_dir):
    """The nine facts."""
    return _layer(_models(spark, sf_dir).facts)


def warehouse_checks(spark, sf_dir):
    """Every check of the whole catalog in one report."""
    from linkmart.operators.checks import check_report
    from linkmart.operators.deadletters import dead_letters
    from linkmart.plans.refresh import generated_checks

    raw, models = warehouse(spark, sf_dir)[0], _models(spark, sf_dir)
    tables = models.tables() | {"dead_letters": dead_letters(raw, WAREHOUSE.entities)}
    tables |= {f"{name}__current": df.where("is_current") for name, df in tables.items() if name.startswith("dim_")}
    return check_report(generated_checks(WAREHOUSE, models), tables)


QUERIES = {f.__name__: f for f in (
    warehouse_staging, warehouse_links, warehouse_snapshots, warehouse_dimensions, warehouse_facts, warehouse_checks)}


# -- the same rows in SQL ------------------------------------------------------------------

_T1, _T2 = f"TIMESTAMP '{tb.T1}'", f"TIMESTAMP '{tb.T2}'"
_DAY = "(DATE '1990-01-01' + CAST(k AS INTEGER))"

# Text attributes per entity in the models' order, as SQL over the table.
_TEXTS = {
    "staff": [], "places": ["NULL"], "bosses": ["p_type"], "items": ["c_name"], "dungeons": ["c_mktsegment"], "monsters": ["o_orderpriority"],
    "games": ["p_type", "p_brand", "CASE WHEN k % 7 = 0 THEN NULL ELSE 'Publisher ' || p_size END"],
    "characters": ["c_name", "CASE WHEN k % 6 = 0 THEN NULL WHEN k % 2 = 0 THEN 'f' ELSE 'm' END", "c_mktsegment"],
}
# Prefix, and per link its field, target and fact.
_PREFIX = {"staff": "staff", "games": "game", "characters": "character", "monsters": "monster", "dungeons": "dungeon",
           "bosses": "boss", "places": "place", "items": "item"}
_LINKS = {
    "staff": [("worked_on", "games")], "games": [], "characters": [("appearances", "games")], "monsters": [("appearances", "games")],
    "dungeons": [("appearances", "games")], "bosses": [("appearances", "games"), ("dungeons", "dungeons")],
    "places": [("appearances", "games"), ("inhabitants", "characters")], "items": [("games", "games")],
}
_FACTS = [
    ("fct_staff_games", "staff", "worked_on", "games", False), ("fct_character_appearances", "characters", "appearances", "games", False),
    ("fct_monster_appearances", "monsters", "appearances", "games", False), ("fct_dungeon_appearances", "dungeons", "appearances", "games", False),
    ("fct_item_appearances", "items", "games", "games", False), ("fct_boss_appearances", "bosses", "appearances", "games", True),
    ("fct_boss_dungeons", "bosses", "dungeons", "dungeons", True), ("fct_place_appearances", "places", "appearances", "games", True),
    ("fct_place_inhabitants", "places", "inhabitants", "characters", True),
]
#: Entities whose description the snapshot keeps as JSON.
_QUOTED = ("monsters", "dungeons")


def _urls(target: str) -> str:
    u = f"'{tb.BASE_URL}/{target}/' || k"
    return (f"CASE WHEN k % 29 = 0 OR k % 31 = 0 THEN NULL ELSE list_concat([{u}], CASE WHEN k % 5 = 0 THEN [{u}] ELSE [] END, "
            f"CASE WHEN k % 11 = 0 THEN ['{tb.BASE_URL}/{target}/x' || k] ELSE [] END, CASE WHEN k % 13 = 0 THEN [{u} || '/'] ELSE [] END) END")


def _source(e: str) -> str:
    """One row per key: its text columns t0.., its names in both batches, and whether it changed."""
    table, key = TABLES[e]
    texts = "".join(f", {t} AS t{i}" for i, t in enumerate(_TEXTS[e]))
    return (f"(SELECT *{texts}, CAST(k AS VARCHAR) AS id, '{table} ' || k || ' ' AS n1, '{table} ' || k || '* ' AS n2, "
            f"(k % 3 = 0 AND k % 41 <> 0) AS changed FROM (SELECT *, {key} AS k FROM {table}))")


def _text(*columns: str) -> str:
    return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)


def _versions(e: str) -> str:
    """All versions of an entity with its surrogate key."""
    cols = "id, k, " + "".join(f"t{i}, " for i in range(len(_TEXTS[e])))
    return (f"(SELECT {cols}n1 AS name, {_T1} AS t_from, CASE WHEN changed THEN {_T2} END AS t_to, md5(id || '|' || CAST({_T1} AS VARCHAR)) AS sk "
            f"FROM {_source(e)} UNION ALL SELECT {cols}n2, {_T2}, NULL, md5(id || '|' || CAST({_T2} AS VARCHAR)) FROM {_source(e)} WHERE changed)")


def _texts(e: str, quoted: bool = False) -> list[str]:
    names = [f"t{i}" for i in range(len(_TEXTS[e]))]
    return [f"""'"' || {n} || '"'""" for n in names] if quoted and e in _QUOTED else names


def _date(e: str) -> list[str]:
    return [f"CASE WHEN k % 5 = 0 THEN NULL ELSE {_DAY} END"] if e == "games" else []


def _date_text(e: str) -> list[str]:
    return [f"CASE WHEN k % 5 = 0 THEN strftime({_DAY}, '%Y-%m-%d') ELSE strftime({_DAY}, '%B %-d, %Y') END"] if e == "games" else []


def _unnested(e: str, target: str) -> str:
    return (f"(SELECT id, url, list_last(string_split(url, '/')) AS ref FROM (SELECT id, unnest({_urls(target)}) AS url FROM {_source(e)}))")


def _rows(model: str, columns: list[str], source: str) -> str:
    return f"SELECT '{model}' AS model, {_text(*columns)} AS row FROM {source}"


def _fact(name: str, e: str, target: str, current: bool) -> tuple[list[str], str]:
    only = " AND {0}.t_to IS NULL" if current else ""
    extra = [f"a.t0"] if e in _QUOTED and not current else []
    right = [f"CASE WHEN b.k % 5 = 0 THEN NULL ELSE {_DAY.replace('k AS', 'b.k AS')} END"] if not current else []
    left = [f"""'"' || {c} || '"'""" for c in extra]
    source = (f"{_unnested(e, target)} l LEFT JOIN {_versions(e)} a ON a.id = l.id{only.format('a')} "
              f"LEFT JOIN {_versions(target)} b ON b.id = l.ref{only.format('b')}")
    return ["a.sk", "l.id", "a.name", *left, "b.sk", "l.ref", "b.name", *right], source


def _layers() -> dict[str, str]:
    staging, links, snapshots, dims, facts = [], [], [], [], []
    for e, fields in _LINKS.items():
        arrays = [f"to_json({_urls(t)})" for _, t in fields]
        trimmed = "trim(CASE WHEN changed THEN n2 ELSE n1 END)"
        staging.append(_rows(f"stg_{e}", ["id", trimmed, *_texts(e), *_date(e), *arrays, f"CASE WHEN changed THEN {_T2} ELSE {_T1} END"], _source(e)))
        links += [_rows(f"int_{e}__{f}", ["id", "url", "ref"], _unnested(e, t)) for f, t in fields]
        json = [f"CASE WHEN k % 29 = 0 THEN 'null' ELSE CAST(to_json({_urls(t)}) AS VARCHAR) END" for _, t in fields]
        meta = ["sk", "t_from", "t_from", "t_to"]
        snapshots.append(_rows(f"snapshot_{e}", ["id", "name", *_texts(e, True), *_date_text(e), *json, *meta], _versions(e)))
        dims.append(_rows(f"dim_{e}", ["sk", "id", "name", *_texts(e, True), *_date(e), "t_from", "t_to", "t_to IS NULL"], _versions(e)))
    for name, e, _, target, current in _FACTS:
        facts.append(_rows(name, *_fact(name, e, target, current)))
    layers = {"staging": staging, "links": links, "snapshots": snapshots, "dimensions": dims, "facts": facts}
    return {f"warehouse_{name}": "\nUNION ALL\n".join(parts) for name, parts in layers.items()}


def _checks_sql() -> str:
    rows = []

    def row(name: str, model: str, test: str, failures: str) -> None:
        rows.append(f"SELECT '{test}__{name}' AS check_name, '{model}' AS model, '{test}' AS test, CAST({failures} AS BIGINT) AS failures")

    for e, p in _PREFIX.items():
        for model, test, column in [
            (f"stg_{e}", "not_null", f"{p}_id"), (f"stg_{e}", "unique", f"{p}_id"), (f"stg_{e}", "not_null", f"{p}_name"),
            (f"dim_{e}", "not_null", f"{p}_sk"), (f"dim_{e}", "unique", f"{p}_sk"), (f"dim_{e}", "not_null", f"{p}_id"),
            (f"dim_{e}__current", "unique", f"{p}_id"), (f"dim_{e}", "not_null", f"{p}_name"),
        ]:
            row(f"{model}__{column}", model, test, "0")
    ids = {("places", "inhabitants"): "inhabitant_id", ("bosses", "dungeons"): "dungeon_id"}
    for name, e, field, target, current in _FACTS:
        columns, source = _fact(name, e, target, current)
        p, ref = _PREFIX[e], ids.get((e, field), "game_id")
        row(f"{name}__{p}_id", name, "not_null", "0")
        row(f"{name}__{p}_id__dim_{e}__{p}_id", name, "relationships", "0")
        row(f"{name}__{ref}", name, "not_null", "0")
        row(f"{name}__{ref}__dim_{target}__{_PREFIX[target]}_id", name, "relationships",
            f"(SELECT count(*) FROM {source} WHERE b.sk IS NULL)")
    row("dead_letters", "dead_letters", "count", "0")
    return "SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (" + "\nUNION ALL ".join(rows) + ")"


ORACLE_SQL = {**_layers(), "warehouse_checks": _checks_sql()}
