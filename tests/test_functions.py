import datetime as dt

from pyspark.sql import functions as F

from linkmart.functions import (
    as_variant, canonical_json, is_truthy, json_array_text, json_kind, json_text, json_value,
    parse_long_date, surrogate_key, url_tail_regex, url_tail_split,
)


def _one(spark, col, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"x {typ}")
    return df.select(col(F.col("x")).alias("r")).first()["r"]


def test_json_text_and_value(spark):
    rows = [('{"a":"  a ","b":null,"c":3,"d":{"z":1},"e":[1,"x"],"f":true}',)]
    df = spark.createDataFrame(rows, "p string").select(as_variant("p").alias("v"))
    r = df.select(
        json_text("v", "a").alias("a"), json_text("v", "b").alias("b"),
        json_text("v", "missing").alias("m"), json_text("v", "c").alias("c"),
        json_text("v", "d").alias("d"), json_text("v", "f").alias("f"),
        json_value("v", "b").alias("vb"), json_value("v", "missing").alias("vm"),
        json_value("v", "e").alias("ve"),
    ).first()
    assert r["a"] == "  a " and r["b"] is None and r["m"] is None and r["c"] == "3"
    assert r["d"] == '{"z":1}' and r["f"] == "true"
    assert r["vb"] == "null" and r["vm"] is None and r["ve"] == '[1,"x"]'


def test_canonical_json_ignores_key_order_and_space(spark):
    df = spark.createDataFrame([('{ "b": 1.50, "a": [1, 2.0] }', '{"a":[1,2],"b":1.5}')], "x string, y string")
    r = df.select(canonical_json("x").alias("x"), canonical_json("y").alias("y")).first()
    assert r["x"] == r["y"] == '{"a":[1,2],"b":1.5}'
    bad = spark.createDataFrame([('{"a":1,"a":2}',), ("nope",)], "x string")
    assert [r[0] for r in bad.select(canonical_json("x")).collect()] == [None, None]


def test_is_truthy_matches_python(spark):
    import json

    values = [None, "", "x", " ", 0, 0.0, 1, -2.5, False, True, [], [0], {}, {"a": 1}, "0"]
    rows = [(json.dumps(v),) for v in values]
    df = spark.createDataFrame(rows, "j string")
    got = [r[0] for r in df.select(is_truthy(as_variant("j"))).collect()]
    assert got == [bool(v) for v in values]
    kinds = [r[0] for r in df.select(json_kind(as_variant("j"))).collect()]
    assert kinds[:4] == ["null", "string", "string", "string"]
    assert kinds[8] == "boolean" and kinds[10] == "array" and kinds[12] == "object"


def test_json_array_text(spark):
    rows = [('{"l":["a",null,["b"],{"c":1}]}',), ('{"l":null}',), ('{"l":"x"}',), ("{}",), ('{"l":[]}',)]
    df = spark.createDataFrame(rows, "p string")
    got = [r[0] for r in df.select(json_array_text(as_variant("p"), "l")).collect()]
    assert got[0] == ["a", None, '["b"]', '{"c":1}']
    assert got[1:4] == [None, None, None] and got[4] == []


def test_url_tails(spark):
    rows = [("https://h/api/games/g1",), ("https://h/g1/",), ("g1",), (None,), ("",)]
    df = spark.createDataFrame(rows, "u string")
    r = df.select(url_tail_split("u").alias("s"), url_tail_regex("u").alias("r")).collect()
    assert [x["s"] for x in r] == ["g1", "", "g1", None, ""]
    assert [x["r"] for x in r] == ["g1", None, "g1", None, None]


def test_parse_long_date(spark):
    cases = {
        "November 21, 1998": dt.date(1998, 11, 21), "april 6, 2000": dt.date(2000, 4, 6),
        " May 06, 2011 ": dt.date(2011, 5, 6), "2017-03-03": None, "March 2017": None,
        "Foo 12, 2000": None, "February 30, 2000": None, "Sept 1, 1990": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = dict(df.select("t", parse_long_date("t").alias("d")).collect())
    assert got == cases


def test_surrogate_key_matches_md5_text(spark):
    import hashlib

    df = spark.createDataFrame([("7", dt.datetime(2024, 1, 1, 0, 0, 7, 170000))], "id string, ts timestamp")
    got = df.select(surrogate_key("id", "ts")).first()[0]
    assert got == hashlib.md5(b"7|2024-01-01 00:00:07.17").hexdigest()
    nul = spark.createDataFrame([(None, None)], "id string, ts timestamp")
    assert nul.select(surrogate_key("id", "ts")).first()[0] == hashlib.md5(b"|").hexdigest()


def test_canonical_json_compares_numbers_by_value(spark):
    groups = [
        ['{"a":100}', '{"a":1e2}', '{ "a" : 100.0 }', '{"a":1.0E+2}', '{"a":10000e-2}'],
        ['{"a":0}', '{"a":-0}', '{"a":-0.0}', '{"a":0e5}'],
        ['{"a":12345678901234567890123456789}', '{"a":1.2345678901234567890123456789e28}'],
        ['{"a":1e40}', '{"a":10000000000000000000000000000000000000000}', '{"a":100e38}'],
        ['{"a":10000000000000000000000000000000000000001}'],
        ['{"a":0.001,"b":[1,{"c":1.5}]}', '{"b":[1e0,{"c":150e-2}],"a":1e-3}'],
        ['{"a":"1e2"}'], ['{"a":"100"}'], ['{"a":"x\\" 1e2"}'], ['{"a":1e500}'], ['{"a":2e500}'],
    ]
    texts = [(i, t) for i, g in enumerate(groups) for t in g]
    rows = spark.createDataFrame(texts, "g int, t string").select("g", canonical_json("t").alias("c")).collect()
    found = {}
    for r in rows:
        found.setdefault(r["g"], set()).add(r["c"])
    assert all(len(c) == 1 and None not in c for c in found.values()), found
    assert len(set().union(*found.values())) == len(groups)
    assert found[0] == {'{"a":100}'} and found[3] == {'{"a":1' + "0" * 40 + "}"}


def test_canonical_numbers_are_exact(spark):
    import random
    from decimal import Decimal, getcontext

    getcontext().prec = 200
    rnd = random.Random(5)
    texts = [f"{rnd.randrange(-10**rnd.randrange(1, 46), 10**45)}e{rnd.randrange(-30, 30)}" for _ in range(300)]
    rows = spark.createDataFrame([(t, f'{{"a":{t}}}') for t in texts], "t string, p string").select("t", canonical_json("p").alias("c"))
    for r in rows.collect():
        assert Decimal(r["c"][5:-1]) == Decimal(r["t"]) and "e" not in r["c"].lower()
