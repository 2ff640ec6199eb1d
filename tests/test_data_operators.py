import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from cadenza.functions import zones
from cadenza.operators import delivery, nested, snapshots, timestamps

UTC = datetime.timezone.utc


def at(i):
    return datetime.datetime(2026, 1, 1, tzinfo=UTC) + datetime.timedelta(minutes=i)


SNAP = "v int, k string, loaded timestamp, a string, b int, _key string, change_kind string"


def brute_changes(rows):
    last = {}
    for v, k, t, a, b, *_ in rows:
        if v is not None and k is not None:
            x = ((t is not None, t), (a is not None, a or ""), (b is not None, b or 0))
            if (v, k) not in last or x > last[v, k][0]:
                last[v, k] = (x, (a, b))
    versions = [v for v, _ in last]
    out = set()
    for v in range(min(versions) + 1, max(versions) + 1) if versions else []:
        for k in {k for _, k in last}:
            old, new = last.get((v - 1, k)), last.get((v, k))
            if old is None and new is not None:
                out.add((v, k, "added"))
            elif new is None and old is not None:
                out.add((v, k, "removed"))
            elif old and new and old[1] != new[1]:
                out.add((v, k, "changed"))
    return out


def changes(spark, rows):
    df = spark.createDataFrame(rows, SNAP)
    return {(r.v, r.k, r.change_kind) for r in snapshots.snapshot_changes(df, "v", "k", "loaded", ["a", "b"]).collect()}


def test_snapshots_brute_force(spark):
    r = random.Random(3)
    rows = [(r.choice([1, 2, 3, 5, None]), r.choice(["x", "y", "z", "hot", "hot", None]), at(r.randrange(5)) if r.random() < 0.9 else None, r.choice(["p", "q", None]), r.choice([1, 2, None]), "c", "c") for _ in range(120)]
    assert changes(spark, rows) == brute_changes(rows)


def test_snapshots_gap_and_fields(spark):
    rows = [(1, "x", at(0), "p", 1, "", ""), (3, "x", at(0), None, 1, "", ""), (4, "x", at(0), "q", 2, "", ""), (4, "x", at(1), None, 2, "", "")]
    assert changes(spark, rows) == {(2, "x", "removed"), (3, "x", "added"), (4, "x", "changed")}
    df = snapshots.snapshot_changes(spark.createDataFrame(rows, SNAP), "v", "k", "loaded", ["a", "b"]).where("change_kind = 'changed'")
    assert df.first().changed_fields == ["b"]


def test_snapshots_empty(spark):
    assert changes(spark, []) == set()


def test_snapshots_no_second_shuffle(spark):
    df = spark.createDataFrame([(1, "x", at(0), "p", 1, "", "")], SNAP)
    plan = snapshots.snapshot_changes(df, "v", "k", "loaded", ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1
    assert "hashpartitioning(_key" not in plan  # the window takes the ranges as they are


MSG = "id string, received timestamp, row bigint, producer string, covered boolean"


def brute_surplus(rows):
    first = {}
    for i, t, n, *_ in rows:
        if i is not None:
            first[i] = min(first.get(i, (True, 0, n + 10**9)), (t is None, t and t.timestamp() or 0, n))
    return {(i, n) for i, t, n, *_ in rows if i is not None and (t is None, t and t.timestamp() or 0, n) != first[i]}


@pytest.mark.parametrize("batch", [3, 10_000])
def test_deliveries_brute_force(spark, batch):
    r = random.Random(batch)
    ids = ["1300000000000001", "1300000000000002", "1300000000000003", "1300000000000005", "0300000000000005", "300000000000005", "12", "", " 1300000000000001", "abc", "é", "9" * 40, None, "1300000000065535", "1300000000065536"]
    rows = [(r.choice([*ids, *["1300000000000002"] * 8]), at(r.randrange(9)) if r.random() < 0.9 else None, n, "p", None) for n in range(400)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df = spark.createDataFrame(rows, MSG).repartition(5)
        got = [(x.message_id, x.row_id) for x in delivery.surplus_rows(df, "id", "received", "row").collect()]
        assert len(got) == len(set(got)) and set(got) == brute_surplus(rows)
        kept = delivery.exactly_once(df, "id", "received", "row").collect()
        assert {x.row for x in kept} == {n for _, _, n, *_ in rows} - {n for _, n in brute_surplus(rows)}
        ranges = {(x.producer, x.lo, x.hi, x.n) for x in delivery.seen_ranges(df, "id", "received", "row").collect()}
        assert ("16:1300", 1, 3, 3) in ranges and ("16:1300", 65535, 65535, 1) in ranges and ("16:1300", 65536, 65536, 1) in ranges
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_deliveries_empty_and_seen(spark):
    empty = spark.createDataFrame([], MSG)
    assert delivery.surplus_rows(empty, "id", "received", "row").count() == 0
    old = spark.createDataFrame([("1300000000000001", at(0), 1, "", None), ("1300000000000002", at(0), 2, "", None)], MSG)
    new = spark.createDataFrame([("1300000000000002", at(5), 3, "", None), ("1300000000000003", at(5), 4, "", None), ("odd", at(5), 5, "", None), (None, at(5), 6, "", None)], MSG)
    seen = delivery.seen_ranges(old, "id", "received", "row")
    fresh = delivery.not_seen(new, "id", seen)
    assert {x.row for x in fresh.collect()} == {4, 5, 6} and fresh.columns == new.columns
    merged = delivery.merge_seen(seen, delivery.seen_ranges(fresh, "id", "received", "row")).collect()
    assert [(x.producer, x.lo, x.hi, x.n) for x in merged] == [("16:1300", 1, 3, 3)]


R = datetime.datetime(2026, 3, 1, 23, 30, tzinfo=UTC)
CASES = [
    ("2026-08-14T12:38:40.862Z", None, "2026-08-14T12:38:40.862"), ("2026-08-14 12:38", "Europe/Paris", "2026-08-14T10:38:00"), ("2025-10-26 02:30:00", "Europe/Paris", "2025-10-26T00:30:00"),
    ("2026-03-29 02:30:00", "Europe/Paris", "2026-03-29T01:30:00"), ("2025-11-02 01:30", "America/Toronto", "2025-11-02T05:30:00"), ("Thu, 12 Feb 2026 14:17:00 GMT", "Africa/Tunis", "2026-02-12T14:17:00"),
    ("Wed, 19 Mar 2025 17:35:28 +0100", None, "2025-03-19T16:35:28"), ("1782857932", "Europe/Paris", "2026-06-30T22:18:52"), ("1781594926341", None, "2026-06-16T07:28:46.341"), ("20250727T130230Z", None, "2025-07-27T13:02:30"),
    ("06/09/2025 20:36", "Europe/London", "2025-09-06T19:36:00"), ("15.07.2025 03:18", None, "2025-07-15T03:18:00"), ("Jun 11, 2025, 1:41 PM", None, "2025-06-11T13:41:00"), ("Mar 8, 2026, 12:05 AM", None, "2026-03-08T00:05:00"),
    ("25 août 2026 à 19h54", "Europe/Paris", "2026-08-25T17:54:00"), ("Vendredi 26 décembre 2025 de 17:30 à 18:30 UTC+1", None, "2025-12-26T16:30:00"), ("Friday, May 23, 2025 at 2:00 PM UTC-4", None, "2025-05-23T18:00:00"),
    ("July 29, 2026 · 1:00 AM", None, "2026-07-29T01:00:00"), ("Du 14 septembre 2025 à 21h15 au 15 septembre 2025 à 0h45", None, "2025-09-14T21:15:00"), ("sam. 20 févr. 2027 à 2 h 00", None, "2027-02-20T02:00:00"),
    ("Mercredi 17 septembre à 18h30", "Europe/Paris", "2026-09-17T16:30:00"), ("1er mars à 9h00", None, "2026-03-01T09:00:00"), ("28 février à 9h00", None, "2027-02-28T09:00:00"), ("29 février à 9h00", None, "2028-02-29T09:00:00"),
    ("Jun 28 at 3:30 AM – Jun 30 at 11:59 PM UTC+2", None, "2026-06-28T01:30:00"), ("2025-12-01 21:35:21 EST", "Europe/Paris", "2025-12-02T02:35:21"), ("2026-08-16T05:15:02+02", None, "2026-08-16T03:15:02"),
    ("17/06/2025 01:00 - 03:00", None, "2025-06-17T01:00:00"), ("2090-07-01 12:00", "Europe/Paris", "2090-07-01T10:00:00"),
    *[(x, None, None) for x in (None, "", " ", "hier", "N/A", "-", "2026-02-30T10:00:00Z", "0000-00-00T00:00:00Z", "2026-08-14", "Mardi 18 mars 2025", "25:00", "2026-08-14 25:10", "13:70 5 mai 2026", "2025-12-01 21:35:21 XYZ", "x" * 5000, "1" * 5000)],
    ("2026-08-14 12:38", "Nowhere/City", None),
]


def test_instants(spark):
    rows = [(i, v, z, R, "mine", "mine") for i, (v, z, _) in enumerate(CASES)]
    df = timestamps.instants(spark.createDataFrame(rows, "i int, v string, z string, r timestamp, _v string, raw string"), "v", "z", "r")
    got = {x.i: x for x in df.collect()}
    for i, (v, _, wanted) in enumerate(CASES):
        us = got[i].utc_us
        assert (None if us is None else (datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=us)).isoformat(timespec="milliseconds" if us % 1_000_000 else "seconds")) == wanted, v
        assert got[i]._v == got[i].raw == "mine"
    assert df.where("utc_us is not null").count() == sum(w is not None for _, _, w in CASES)
    assert timestamps.instants(spark.createDataFrame([], "v string, z string, r timestamp"), "v", "z", "r").count() == 0


def test_instants_of_long_texts(spark):
    texts = ["2026-10-01T20:00:00Z", " " * 200 + "2026-10-01T20:00:00Z" + "\n" * 200, "2026-10-01" + " " * 150 + "20:00:00", "x" * 200 + " 2026-10-01T20:00:00Z"]
    df = spark.createDataFrame([(i, t, "UTC", None) for i, t in enumerate(texts)], "i int, v string, z string, r timestamp")
    got = {x.i: x.utc_us for x in timestamps.instants(df, "v", "z", "r").collect()}
    assert got[0] is not None and got[1] == got[2] == got[0] and got[3] is None


@pytest.mark.parametrize("zone", ["Europe/Paris", "America/Toronto", "Africa/Tunis", "Australia/Lord_Howe", "Africa/Casablanca", "Europe/Dublin"])
def test_zone_tables(zone):
    import zoneinfo

    import numpy as np

    z, r = zoneinfo.ZoneInfo(zone), random.Random(1)
    local = [datetime.datetime(1990, 1, 1) + datetime.timedelta(minutes=r.randrange(60 * 24 * 365 * 60)) for _ in range(3000)]
    wanted = [x.replace(tzinfo=z).timestamp() for x in local]
    epoch = datetime.datetime(1970, 1, 1)
    got = zones.to_utc(np.array([(x - epoch) // datetime.timedelta(microseconds=1) for x in local]), zone, zones.tables())
    assert [int(w) for w in wanted] == [int(g // 1_000_000) for g in got]
    assert zones.version()


def test_nested_json(spark):
    deep = "[" * 100_000
    record = {"id": "1", "location": {"name": "L"}, "childEvents": [{"ticketsInfo": [{"buyUrl": "u0"}, None, {"buyUrl": ""}]}, {"location": {"name": 5}}], "name": None, "ticketsInfo": {"buyUrl": ["v", "w"]}}
    rows = [(1, json.dumps(record)), (2, None), (3, ""), (4, '{"location": {"name": "cut'), (5, "[]"), (6, "null"), (7, '[{"location": {"name": "R"}}]'), (8, deep), (9, '{"x": {"location": {"name": "é"}}}')]
    flat = nested.flatten_json(spark.createDataFrame(rows, "k bigint, p string"), "k", "p")
    got = {tuple(r) for r in nested.leaves(flat, ["ticketsInfo.buyUrl", "location.name"]).collect()}
    assert got == {
        (1, "location.name", "", "L"), (1, "childEvents.ticketsInfo.buyUrl", "0.0", "u0"), (1, "childEvents.location.name", "1", "5"), (1, "ticketsInfo.buyUrl", "0", "v"), (1, "ticketsInfo.buyUrl", "1", "w"),
        (7, "location.name", "0", "R"), (9, "x.location.name", "", "é"),
    }
    links = {(r.path, r.positions, r.parent_path, r.parent_positions) for r in flat.where("row_id = 1").collect()}
    assert ("childEvents.ticketsInfo", "0.0", "childEvents", "0") in links and ("location", "", "", "") in links


def test_nested_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, ({"n": "a"}, [{"u": "x"}, None, {"u": None}])), (2, (None, []))], "id bigint, s struct<location:struct<n:string>, media:array<struct<u:string>>>").select("id", "s.*")
    flat = nested.flatten_columns(df, "id", ["location", "media"])
    assert {(r.row_id, r.tag, r.positions) for r in flat.where("tag <> ''").collect()} == {(1, "location", ""), (1, "media", "0"), (1, "media", "2")}
    typed = nested.flat_table(flat, "location", "n string, missing int").collect()
    assert [(r.n, r.missing, r.parent_path) for r in typed] == [("a", None, "")]
    nested.write_flat(flat, str(tmp_path / "flat"))
    assert spark.read.parquet(str(tmp_path / "flat")).where("tag = 'media'").count() == 2
    assert nested.flatten_columns(df.limit(0), "id", ["location", "media"]).count() == 0
    assert df.where(F.lit(False)).count() == 0
