"""The modelled warehouse's eight entities and nine facts through the refresh job."""

import json

from pyspark.sql import functions as F

from linkmart.plans.catalog import WAREHOUSE
from linkmart.plans.refresh import refresh

H = "https://api.example.test/api"


def _recs(spark, rows):
    return spark.createDataFrame([(r["id"], json.dumps(r, sort_keys=True, separators=(",", ":")))
                                  for r in rows], "id string, payload string")


def _batch(spark, boss_name="Boss One"):
    g = lambda i: f"{H}/games/{i}"
    return {
        "games": _recs(spark, [
            {"id": "g1", "name": "Game One", "description": "d", "developer": "N", "publisher": "N",
             "released_date": "November 21, 1998"},
            {"id": "g2", "name": "Game Two", "released_date": "2000-04-27"},
        ]),
        "staff": _recs(spark, [{"id": "s1", "name": "Staffer", "worked_on": [g("g1"), g("g2")]}]),
        "characters": _recs(spark, [{"id": "c1", "name": "Hero", "gender": "m", "race": "human",
                                     "appearances": [g("g1"), g("missing")]}]),
        "monsters": _recs(spark, [{"id": "m1", "name": "Crawler", "description": "spits",
                                   "appearances": [g("g1")]}]),
        "dungeons": _recs(spark, [{"id": "d1", "name": "Old Cave", "appearances": [g("g1")]}]),
        "bosses": _recs(spark, [{"id": "b1", "name": boss_name, "appearances": [g("g1")],
                                 "dungeons": [f"{H}/dungeons/d1"]}]),
        "places": _recs(spark, [{"id": "p1", "name": "Village", "appearances": [g("g1")],
                                 "inhabitants": [f"{H}/characters/c1"]}]),
        "items": _recs(spark, [{"id": "i1", "name": "  ", "games": [g("g2") + "/"]}]),
    }


def test_refresh_builds_every_fact_and_check(spark, scratch):
    out = scratch("warehouse")
    refresh(spark, WAREHOUSE, _batch(spark), out, "2024-01-01 00:00:00")
    w = refresh(spark, WAREHOUSE, _batch(spark, "Boss Two"), out, "2024-01-02 00:00:00")
    assert {f.name for f in WAREHOUSE.facts} <= set(w)
    sg = w["fct_staff_games"]
    assert sg.columns == ["staff_sk", "staff_id", "staff_name", "game_sk", "game_id", "game_name",
                          "released_date"]
    dates = {r["game_id"]: r["released_date"] for r in sg.collect()}
    assert str(dates["g1"]) == "1998-11-21" and dates["g2"] is None
    assert w["fct_monster_appearances"].columns[3] == "monster_description"
    inh = w["fct_place_inhabitants"].first()
    assert inh["inhabitant_id"] == "c1" and inh["character_name"] == "Hero"
    # boss renamed in run 2: two versions; "current" facts see only the new name
    assert w["dim_bosses"].count() == 2
    ba = w["fct_boss_appearances"].collect()
    assert [r["boss_name"] for r in ba] == ["Boss Two"]
    dl = {(r["source_name"], r["error_type"]) for r in w["dead_letters"].collect()}
    assert ("characters", "invalid_appearances_link") in dl
    assert ("items", "empty_name") in dl and ("items", "invalid_games_link") in dl
    rep = {r["check_name"]: r["failures"] for r in w["checks"].collect()}
    assert rep["unique__dim_games__game_sk"] == 0
    assert rep["relationships__fct_character_appearances__game_id__dim_games__game_id"] == 1
    assert rep["count__dead_letters"] == 0


def test_refresh_with_some_entities_only(spark, scratch):
    out = scratch("partial")
    batch = _batch(spark)
    w = refresh(spark, WAREHOUSE, {"games": batch["games"], "staff": batch["staff"]}, out,
                "2024-01-01 00:00:00")
    assert set(w) == {"dim_games", "dim_staff", "fct_staff_games", "dead_letters", "checks"}
    assert w["fct_staff_games"].count() == 2
    # a later run with only games keeps staff from the previous run
    w2 = refresh(spark, WAREHOUSE, {"games": batch["games"]}, out, "2024-01-02 00:00:00")
    assert w2["fct_staff_games"].count() == 2 and w2["dim_staff"].count() == 1


def test_refresh_keeps_requested_versions(spark, scratch):
    from linkmart.sources.tables import VersionedTable

    out = scratch("vacuum")
    for day in (1, 2, 3):
        refresh(spark, WAREHOUSE, {"games": _batch(spark)["games"]}, out,
                f"2024-01-0{day} 00:00:00", keep_versions=2)
    assert VersionedTable(spark, f"{out}/raw/games").versions() == [2, 3]
    assert VersionedTable(spark, f"{out}/snapshots/games/current").versions() == [2, 3]
