import datetime
import json

import pytest
from pyspark.sql import functions as F

from cadenza import tables
from cadenza.html import ops, tree
from cadenza.operators import execute, nested, publish, social, state
from cadenza.sources import sinks

D = datetime.date
TODAY = D(2026, 9, 12)
EVENT = "uid string, venue_id string, venue_name string, category string, title string, start_date date, end_date date, start_min int, end_min int, location_name string, url string, price string, summary string, status string, recurring boolean"


def events(spark, *rows):
    return spark.createDataFrame([(u, v, v, None, t, d, None, m, None, None, None, None, None, None, None) for u, v, t, d, m in rows], EVENT)


def test_calendar_is_one_file(spark, tmp_path):
    rows = [(f"u{i:04}", "v", "Titre, n° " + "é" * 60, TODAY + datetime.timedelta(i % 7), 600) for i in range(200)]
    sinks.write_ics(events(spark, *rows).repartition(5), str(tmp_path / "ics"))
    (file,) = (tmp_path / "ics").glob("part-*")
    raw = file.read_bytes().decode()
    lines = raw.split("\r\n")
    assert lines[0] == "BEGIN:VCALENDAR" and lines[-2:] == ["END:VCALENDAR", ""] and "\n" not in raw.replace("\r\n", "")
    starts = [x for x in lines if x.startswith("DTSTART")]
    assert len(starts) == 200 and starts == sorted(starts) and all(len(x.encode()) <= 75 for x in lines)


@pytest.mark.parametrize("rows", [0, 3])
def test_json_is_one_document(spark, tmp_path, rows):
    e = events(spark, *[(f"u{i}", "b", f"t{i}", TODAY - datetime.timedelta(i), None) for i in range(rows)])
    v = spark.createDataFrame([("a", "A", 1.5), ("b", "B", None)], "id string, name string, lat double")
    sinks.write_events_json(v, e, TODAY, "2026-09-12T08:00:00+02:00", str(tmp_path / "json"))
    (file,) = (tmp_path / "json").glob("part-*")
    d = json.loads(file.read_text())
    assert d["today"] == "2026-09-12" and [(x["id"], x["event_count"]) for x in d["venues"]] == [("a", 0), ("b", rows)] and [x["title"] for x in d["events"]] == [f"t{i}" for i in reversed(range(rows))]


def test_report_counts_new_events_by_state(spark):
    e = spark.createDataFrame([(u, "s", "v", TODAY, TODAY, None, None, None, None) for u in ("old", "new", "new")], "uid string, source_url string, venue_id string, start_date date, first_seen date, end_date date, verifier string, title_truncated boolean, image string")
    assert sinks.run_report(e, TODAY, e.where("uid = 'old'")).first().events_new == 1 and sinks.run_report(e, TODAY).first().events_new == 2
    assert [sinks.exit_status(*x) for x in ((0, 0), (3, 0), (3, 1))] == [0, 1, 0]


def test_nested_broken_texts(spark):
    payloads = [r'{"ticketsInfo": {"buyUrl": "a\ud800b", "x\udc00": "😀"}}', '{"ticketsInfo": {"buyUrl": NaN}}', '{"a": Infinity}', '{"location": {"name": "ok"}}', "{", "", None]
    df = spark.createDataFrame(list(enumerate(payloads)), "k bigint, p string")
    got = {(r.row_id, r.field_path): r.leaf_value for r in nested.leaves(nested.flatten_json(df, "k", "p"), ["ticketsInfo.buyUrl", "location.name", "ticketsInfo.x�"]).collect()}
    assert got == {(0, "ticketsInfo.buyUrl"): "a�b", (0, "ticketsInfo.x�"): "😀", (3, "location.name"): "ok"}


def test_json_rule_times_and_fields(spark):
    raw = '{"l": [{"t": "A", "d": "20260925", "h": "1830", "u": "/e/1", "s": "<p>' + "mot " * 100 + '</p>", "p": " "}, {"t": "B", "d": "20260926", "h": "x", "u": "mailto:x"}]}'
    f = {"title": ops.Field("t"), "date": ops.Field("d"), "time": ops.Field("h"), "url": ops.Field("u"), "summary": ops.Field("s"), "price": ops.Field("p")}
    rule = execute.JsonRule("l", f, date_format="%Y%m%d", time_format="%H%M")
    a, b = execute.apply_rules(spark.createDataFrame([("https://x.example/api", raw)], "url string, raw string"), [rule], TODAY).orderBy("title").collect()
    assert (a.start_min, a.url, len(a.summary) <= 240, a.summary[-3:], a.price) == (1110, "https://x.example/e/1", True, "...", None)
    assert (b.start_min, b.url, b.summary) == (None, None, None)


def test_health_and_projection(spark):
    stats = spark.createDataFrame([("none", 0, 0, 0, 0, None), ("undated", 4, 0, 4, 0, 0.0), ("failing", 4, 3, 0, 1, 0.75), ("json", 4, 3, 0, 1, 0.75), ("fell", 4, 0, 1, 0, 0.0), ("fine", 4, 1, 0, 3, 0.25), ("new", 2, 0, 1, 0, 0.0)], "doc_url string, items_seen int, failures int, undated int, events int, failure_ratio double")
    known = spark.createDataFrame([("json", "json", 0), ("fell", "html", 5)], "doc_url string, kind string, last_event_count int")
    got = {r.doc_url: r.problem for r in execute.health(stats, known).collect()}
    assert got == {"none": "no items matched", "undated": "date selector matches nothing in any item", "failing": "3/4 items failed to parse", "json": None, "fell": "0 events where the last run had 5", "fine": None, "new": None}


def test_requests_handles_and_last_ok(spark):
    row = lambda *cs: list(spark.range(1).select(*cs).first())
    d = F.lit(TODAY)
    assert [json.loads(x) for x in row(social.instagram_request(F.lit("u"), d, 5), social.facebook_posts_request(F.lit("u"), d, 5), social.facebook_events_request(F.lit("https://f/p/"), 5))] == [
        {"directUrls": ["u"], "resultsType": "posts", "resultsLimit": 5, "onlyPostsNewerThan": "2026-09-12", "addParentData": False},
        {"startUrls": [{"url": "u"}], "resultsLimit": 5, "captionText": False, "onlyPostsNewerThan": "2026-09-12"},
        {"startUrls": ["https://f/p/upcoming_hosted_events"], "maxEvents": 5},
    ]
    assert row(*[social.instagram_handle(F.lit(x)) for x in ("https://www.instagram.com/le.lieu/reels/?hl=fr", "le.lieu/", " ", None)]) == ["https://www.instagram.com/le.lieu/"] * 2 + [None, None]
    assert row(*[social.facebook_handle(F.lit(x)) for x in ("https://facebook.com/people/Lieu/123/", "https://www.facebook.com/lieu/past_hosted_events", "lieu")]) == ["https://www.facebook.com/people/Lieu/123/", *["https://www.facebook.com/lieu/"] * 2]
    before = F.lit(D(2026, 9, 1))
    assert row(*[social.last_ok_after(before, F.lit(ok), F.lit(n), TODAY) for ok, n in ((True, 0), (True, 2), (False, 0), (None, None))]) == [TODAY, *[D(2026, 9, 1)] * 3]


def test_islands_and_queue(spark):
    d = lambda n: TODAY + datetime.timedelta(n)
    rows = [("v", "a", d(0), d(9)), ("v", "b", d(3), None), ("v", "c", d(9), d(12)), ("v", "d", d(13), None), ("w", "e", d(0), None), (None, "f", d(0), d(2)), (None, "g", d(1), None), (None, "h", d(5), None)]
    got = {r.uid: r.island for r in publish.islands(spark.createDataFrame(rows, "venue_id string, uid string, start_date date, end_date date")).collect()}
    assert got == {"a": d(0), "b": d(0), "c": d(0), "d": d(13), "e": d(0), "f": d(0), "g": d(0), "h": d(5)}
    queue = state.stalest_first(spark.createDataFrame([("s1", d(0)), ("s2", None), ("s3", d(-1)), ("s0", d(0)), ("s4", None)], "source_url string, seen date"), "seen", 3)
    assert {(r.source_url, r.place, r.deferred) for r in queue.collect()} == {("s2", 1, False), ("s4", 2, False), ("s3", 3, False), ("s0", 4, True), ("s1", 5, True)}


def test_shared_images_of_any_rule(spark):
    rows = [("d", 1, "x"), ("d", 1, "x"), ("d", 1, "y"), ("d", 2, "x"), ("d", 2, "y"), (None, 1, "z"), (None, 1, "z"), ("e", 1, None), ("e", 1, None)]
    got = sorted(map(str, execute.drop_shared_images(spark.createDataFrame(rows, "doc_url string, rule_no int, image string")).collect()))
    assert got == sorted(f"Row(doc_url={d!r}, rule_no={n}, image={i!r})" for d, n, i in [("d", 1, None), ("d", 1, None), ("d", 1, "y"), ("d", 2, "x"), ("d", 2, "y"), (None, 1, None), (None, 1, None), ("e", 1, None), ("e", 1, None)])


def test_pictures():
    item = tree.parse('<div><img src="data:image/gif;base64,x"><img width=16 height=16 src="/i.png"><picture><source srcset="/w.webp 1x, /w2.webp 2x"><img src="/l.svg?x"></picture><img data-src=" /a.jpg "></div>')
    assert ops.first_image(item, "https://x.example/p/") == "https://x.example/w.webp" and ops.usable_image("//x.example/a.JPG", "http://y.example/") == "http://x.example/a.JPG"
    assert ops.usable_image("ftp://x.example/a.jpg", "") is None and ops.usable_image(None, "") is None and ops.usable_image("http://[", "") is None
    page = tree.parse('<section data-date="2026-10-01"><div><p><b>x</b><time datetime="2026-11-02T20:00">y</time></p></div></section>')
    nodes = {n.name: n for n in page.elements()}
    assert ops.iso_dates(nodes["p"]) == ["2026-11-02"] and ops.iso_dates(nodes["b"]) == ["2026-10-01"] and ops.iso_dates(tree.parse("<i>x</i>")) == []
    assert execute.json_image({"a": {"b": {"c": {"d": {"photo": "https://x.example/1"}}}}}) is None and execute.json_image([{"photo": {"sizes": {"large": "https://x.example/l.jpg"}}}]) == "https://x.example/l.jpg"


def test_written_tables_are_discarded(spark):
    df = tables.written(spark.range(3).toDF("x"), "t")
    path = tables._WRITTEN[-1][1]
    assert df.count() == 3
    tables.discard()
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    assert not fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs)
