"""Damaged feeds, names in other spellings, local times at clock changes."""

import datetime as dt
import json
import random
import unicodedata
import zoneinfo

import pytest
from pyspark.sql import functions as F

from matchmill.functions.times import local_time_kind, zone_instant
from matchmill.operators.names import folded_name, fuzzy_join, fuzzy_names, unmatched
from matchmill.sources.publication import GateError, Load
from matchmill.sources.quarantine import Level, damage_report, landed_texts, split_feed


def test_damage_is_kept_aside_and_its_neighbours_are_read(spark, tmp_path, rows):
    good = {"games": [{"id": "1", "score": 2}, {"id": "2", "score": "two"}, {"id": " ", "score": 1}, {"id": "4"}, "word", None]}
    for name, text in {"a": json.dumps(good), "b": json.dumps(good)[:-20], "c": "{}", "d": '{"games": []}', "e": ""}.items():
        (tmp_path / f"{name}.json").write_text(text)
    payloads = landed_texts(spark, str(tmp_path)).withColumn("source", F.substring_index("source", "/", -1))
    read, aside = split_feed(payloads, [Level("games", "id string, score bigint")], ["id"])
    assert rows(read) == [("a.json", "1", 2), ("a.json", "4", None)]
    found = {(r.source, r.place): (r.reason, r.text) for r in aside.collect()}
    assert found[("a.json", "1")] == ("unreadable element", '{"id":"2","score":"two"}')
    assert found[("a.json", "2")][0] == "key missing" and found[("c.json", "")] == ("list missing", "{}")
    assert {k[1] for k in found if k[0] == "a.json"} == {"1", "2", "4", "5"}
    assert found[("b.json", "")][0] == "unreadable payload" and ("d.json", "") not in found
    assert {(r.source, r.reason): r.parts for r in damage_report(aside).collect()}[("a.json", "unreadable element")] >= 2
    # The good rows count against the gate.
    load = Load(spark, str(tmp_path / "lake"), "one")
    load.write("games", read, 3)
    with pytest.raises(GateError, match="games missing_rows: 1"):
        load.publish()


def plain_fold(name):
    special = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "ł": "l", "þ": "th", "ı": "i", "ħ": "h"}
    text = "".join(special.get(c, c) for c in name.lower())
    text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return " ".join(text.split())


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("edits", [0, 1, 2])
def test_fuzzy_names_against_all_pairs(spark, edits):
    rng = random.Random(edits)
    words = ["Türkiye", "Turkey", "Côte d'Ivoire", "Curaçao", "São  Tomé", "Łódź", "Straße", "Peru", "Per", "ét", ""]
    mine = [None, " ", *words, *("".join(rng.choice("aábc ") for _ in range(rng.randint(0, 5))) for _ in range(60))]
    theirs = [None, "", "Turkiye", "curacao", "strasse", "Sao Tome", "lodz", "PERU", "et", *("".join(rng.choice("abc ") for _ in range(rng.randint(1, 5))) for _ in range(20))]
    left = spark.createDataFrame([(n,) for n in mine], "name string")
    right = spark.createDataFrame([(n,) for n in theirs], "other string")
    got = {r.name: (r.other, r.edits) for r in fuzzy_names(left, right, "name", "other", edits).collect()}
    assert set(got) == {n for n in mine if n is not None}
    first = {}
    for n in sorted(n for n in theirs if n and plain_fold(n)):
        first.setdefault(plain_fold(n), n)
    for name in got:
        key = plain_fold(name)
        near = sorted((distance(key, k), k) for k in first if distance(key, k) <= edits) if key else []
        assert got[name] == ((first[near[0][1]], near[0][0]) if near else (None, None)), name


def test_every_row_keeps_its_match_and_the_rest_is_reported(spark, rows):
    left = spark.createDataFrame([(k, "Peru" if k < 50 else None if k == 50 else "Atlantis") for k in range(53)], "id long, name string")
    right = spark.createDataFrame([("Perú",), ("Chad",)], "team string")
    joined = fuzzy_join(left, right, "name", "team")
    assert joined.count() == 53 and joined.filter("team = 'Perú' and edits = 0").count() == 50
    assert rows(unmatched(joined, "name", "team")) == sorted([(None, 1), ("Atlantis", 2)], key=repr)
    assert fuzzy_join(left, right.limit(0), "name", "team").filter("team is null").count() == 53
    assert spark.range(1).select(folded_name(F.lit("  ÉCOLE\tß ")).alias("x")).first().x == "ecole ss"


@pytest.mark.parametrize("zone", ["America/Chicago", "Europe/Berlin", "Asia/Kolkata", "Australia/Lord_Howe", "America/Mexico_City"])
def test_local_times_at_clock_changes(spark, zone):
    times = [dt.datetime(y, m, d) + dt.timedelta(minutes=15 * k) for y, m, d in ((2024, 3, 10), (2024, 11, 3), (2024, 3, 31), (2024, 10, 27), (2024, 4, 7), (2024, 10, 6)) for k in range(20)]
    frame = spark.createDataFrame([(t,) for t in times] + [(None,)], "t timestamp_ntz")
    at, z = F.col("t"), F.lit(zone)
    got = frame.select("t", local_time_kind(at, z).alias("kind"), zone_instant(at, z).alias("a"), zone_instant(at, z, later=True).alias("b")).collect()
    info, utc = zoneinfo.ZoneInfo(zone), dt.timezone.utc
    for r in got:
        if r.t is None:
            assert (r.kind, r.a, r.b) == (None, None, None)
            continue
        found = sorted({u for m in range(-18 * 60, 18 * 60, 15) if (u := r.t + dt.timedelta(minutes=m)).replace(tzinfo=utc).astimezone(info).replace(tzinfo=None) == r.t})
        assert r.kind == ("gap", "once", "twice")[len(found)], r
        if found:
            assert (r.a, r.b) == (found[0], found[-1])
