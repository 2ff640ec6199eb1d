import datetime
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cadenza.functions import dates, text
from cadenza.html import css, ops, tree
from cadenza.operators import execute, publish, runs, social, state, validate
from cadenza.sources import connectors, sinks
from cadenza.sources.store import Store, read_venues
from cadenza.streaming import agenda

D = datetime.date
TODAY = D(2026, 9, 12)


# dates


@pytest.mark.parametrize(
    ("written", "start", "end", "a", "b"),
    [
        ("Le mardi 15 septembre à 18 h 30", D(2026, 9, 15), None, 1110, None), ("du 6 au 7 juin", D(2027, 6, 6), D(2027, 6, 7), None, None), ("12 Sep 2026 @ 21:00", D(2026, 9, 12), None, 1260, None),
        ("19 Sept.", D(2026, 9, 19), None, None, None), ("2026-09-25T18:30", D(2026, 9, 25), None, 1110, None), ("20260925", D(2026, 9, 25), None, None, None), ("15/09/26 14h-19h", D(2026, 9, 15), None, 840, 1140),
        ("du 12 septembre au 3 octobre 2026", D(2026, 9, 12), D(2026, 10, 3), None, None), ("6 & 7 juin", D(2027, 6, 6), D(2027, 6, 7), None, None), ("du 28 décembre au 3 janvier 2027", D(2026, 12, 28), D(2027, 1, 3), None, None),
        ("samedi 5 septembre", D(2026, 9, 5), None, None, None), ("2026-09-25T00:00:00", D(2026, 9, 25), None, None, None), ("31/02/2026", None, None, None, None), ("mercredi 15 septembre 2026", None, None, None, None), ("", None, None, None, None), (None, None, None, None, None),
        ("29 février", None, None, None, None), ("x" * 20_000, None, None, None, None),
    ],
)
def test_dates(spark, written, start, end, a, b):
    p = spark.createDataFrame([(written,)], "t string").select(dates.parse_date(F.col("t"), TODAY).alias("p")).first().p
    assert (p.start, p.end, p.start_min, p.end_min) == (start, end, a, b)
    assert (p.error is None) == (start is not None)


def test_date_formats(spark):
    df = spark.createDataFrame([("20260925 18h30",), ("x",)], "t string").select(dates.parse_date_format(F.col("t"), "%Y%m%d %Hh%M").alias("p"))
    assert [(r.p.start, r.p.start_min, r.p.error) for r in df.collect()] == [(D(2026, 9, 25), 1110, None), (None, None, "format mismatch")]
    with pytest.raises(ValueError):
        dates.parse_date_format(F.lit("x"), "%Q")


def test_text(spark):
    row = lambda *cs: spark.range(1).select(*cs).first()
    s = F.lit("  L’Été à Sète ﬁn ")
    r = row(text.normalize_text(s), text.slugify(s), text.strip_accents(F.lit("Ωέ Ŝ é")), text.title_tokens(s), text.clip(F.lit("un deux trois"), 9), text.strip_markup(F.lit("<b>a</b>&amp;b")), text.extract(F.lit("Salle : Le\nBleu"), r"salle : (.*)"))
    assert list(r) == ["l'été à sète ﬁn".replace("ﬁ", "fi"), "l-ete-a-sete-fin", "Ωε S e", ["ete", "sete", "fin"], "un deu...", "a &b", "Le\nBleu"]
    assert row(text.slugify(F.lit("??")))[0] == "venue" and row(text.slugify(F.lit(None).cast("string")))[0] is None
    r = row(text.overlap(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("a"))), text.overlap(F.array().cast("array<string>"), F.array(F.lit("a"))), text.jaccard(F.array(F.lit("a")), F.array(F.lit("b"))), text.extends_prefix(F.lit("Été long"), F.lit("ete")), text.absolute_url(F.lit("https://x.example/a/b"), F.lit("../c")))
    assert list(r) == [1.0, 0.0, 0.0, True, "https://x.example/c"]


# runs and state

EV = "source string, title string, url string, start_date date, end_date date, start_min int, pos int, uid string"


def days(*ns, title="t", pos=0, **k):
    return [("s", title, k.get("url"), TODAY + datetime.timedelta(n), None, None, pos + i, f"{title}{pos + i}") for i, n in enumerate(ns)]


def test_collapse(spark):
    rows = [*days(0, 1, 4, 5), *days(0, 1, title="short", pos=10), *days(0, 4, 8, 9, 10, title="gaps", pos=20)]
    got = {(r.title, r.pos): (r.end_date, r.folded_rows) for r in runs.collapse_runs(spark.createDataFrame(rows, EV), ["source", "title", "url"], "pos").collect()}
    day = lambda n: TODAY + datetime.timedelta(n)
    assert got == {("t", 0): (day(5), 4), ("short", 10): (None, 1), ("short", 11): (None, 1), ("gaps", 20): (None, 1), ("gaps", 21): (None, 1), ("gaps", 22): (day(10), 3)}
    assert runs.collapse_runs(spark.createDataFrame([], EV), ["source", "title", "url"], "pos").count() == 0


def test_continue(spark):
    known = spark.createDataFrame([("s", "t", None, TODAY - datetime.timedelta(5), TODAY, None, 0, "K"), ("s", "t", None, TODAY, None, None, 1, "single")], EV)
    new = spark.createDataFrame([*days(1, 3, 9), *days(2, title="other", pos=10)], EV)
    got = {r.pos: (r.start_date, r.end_date, r.continued_uid) for r in runs.continue_runs(new, known, ["source", "title", "url"], "pos").collect()}
    assert got[0] == (TODAY - datetime.timedelta(5), TODAY + datetime.timedelta(3), "K") and 1 not in got and got[2][2] is None and got[10][2] is None


ST = "uid string, source_url string, start_date date, end_date date, image string, image_source string, first_seen date, last_seen date"


def test_merge_over_days(spark):
    def rows(uids, source="s"):
        return spark.createDataFrame([(u, source, TODAY + datetime.timedelta(30), None, f"i{u}", f"src{u}", TODAY, TODAY, i) for i, u in enumerate(uids)], ST + ", pos int")

    events, sources, missing = spark.createDataFrame([], ST), spark.createDataFrame([], "source_url string, uid string"), spark.createDataFrame([], "source_url string, uid string, n int")
    ok = spark.createDataFrame([("s", 1, None)], "source_url string, rank int, error string")
    seen = []
    for uids, fetched in [("abcdef", ok), ("abcde", ok), ("a", ok), ("abcde", ok), ("abcde", ok), ("abcde", spark.createDataFrame([("s", 1, "boom")], "source_url string, rank int, error string"))]:
        m = state.merge_sources(events, sources, missing, rows(uids), fetched, TODAY)
        keep = [spark.createDataFrame(df.collect(), df.schema) for df in (m.events, m.sources, m.missing)]
        events, sources, missing = keep
        seen.append(("".join(sorted(r.uid for r in events.collect())), {r.uid: r.n for r in missing.collect()}, [r.level for r in m.alerts.collect()]))
    assert seen == [("abcdef", {}, []), ("abcdef", {"f": 1}, []), ("abcdef", {"f": 1}, ["warning"]), ("abcdef", {"f": 2}, []), ("abcde", {}, []), ("abcde", {}, ["error"])]


def test_merge_owner_and_image(spark):
    old = spark.createDataFrame([("u", "a", TODAY, None, "old", "pic", D(2026, 1, 1), D(2026, 1, 1))], ST)
    new = spark.createDataFrame([("u", "a", TODAY, None, None, "pic", TODAY, TODAY, 1), ("u", "b", TODAY, None, "new", None, TODAY, TODAY, 1)], ST + ", pos int")
    fetched = spark.createDataFrame([("a", 1, None), ("b", 2, None)], "source_url string, rank int, error string")
    m = state.merge_sources(old, old.select("source_url", "uid"), spark.createDataFrame([], "source_url string, uid string, n int"), new, fetched, TODAY)
    r = m.events.first()
    assert (r.source_url, r.image, r.image_source, r.first_seen, r.last_seen) == ("b", "old", "pic", D(2026, 1, 1), TODAY)


# publication


def brute_fold(items):
    rank = publish.SOURCE_RANK
    items = sorted(items, key=lambda r: (rank.get(r["source_kind"], 9), r["start_date"], r["start_min"] or 0, r["venue_name"], r["title"], r["uid"]))
    ranged = lambda r: r["end_date"] is not None and r["end_date"] > r["start_date"]
    tok = lambda r: {w for w in r["title"].split() if len(w) > 1 and w not in text.STOPWORDS}

    def sim(a, b, least):
        return bool(tok(a) and tok(b)) and len(tok(a) & tok(b)) / min(len(tok(a)), len(tok(b))) >= least

    def same(a, b):
        if a["venue_id"] != b["venue_id"]:
            return False
        both = a["start_min"] is not None and b["start_min"] is not None
        event = a["start_date"] == b["start_date"] and not (a["source_url"] == b["source_url"] and a["source_kind"] == "html") and not (both and a["start_min"] != b["start_min"]) and sim(a, b, 0.5 if both else 0.75)
        run = ranged(a) and ranged(b) and a["end_date"] == b["end_date"] and (tok(a) == tok(b) if a["source_url"] == b["source_url"] else sim(a, b, 0.75))
        return event or run

    kept, into = [], {}
    for r in items:
        k = next((k for k in kept if same(r, k)), None)
        if k is None:
            kept.append(r)
        else:
            into[r["uid"]] = k["uid"]
    for r in kept:
        if not ranged(r):
            c = next((k for k in kept if ranged(k) and k["venue_id"] == r["venue_id"] and k["start_date"] <= r["start_date"] <= k["end_date"] and sim(r, k, 0.75)), None)
            if c:
                into[r["uid"]] = c["uid"]
    return into


def test_fold_brute_force(spark):
    r = random.Random(11)
    rows = []
    for i in range(250):
        start = TODAY + datetime.timedelta(r.randrange(12))
        title = " ".join(r.sample(["alpha", "beta", "gamma", "delta", "le", "rock"], r.randrange(1, 5)))
        rows.append({"uid": f"u{i:03d}", "venue_id": r.choice("ab"), "venue_name": "V", "source_kind": r.choice(["json", "html", "facebook", "instagram", "other"]), "source_url": r.choice(["s1", "s2", "s3"]), "start_date": start, "end_date": r.choice([None, None, start, start + datetime.timedelta(r.randrange(1, 4))]), "start_min": r.choice([None, 600, 1200]), "title": title, "image_source": None})
    df = spark.createDataFrame(pd.DataFrame(rows).astype({"start_min": "Int64"}).astype(object).where(lambda x: x.notna(), None).to_dict("records"), "uid string, venue_id string, venue_name string, source_kind string, source_url string, start_date date, end_date date, start_min int, title string, image_source string")
    got = {x.uid: x.folded_into for x in publish.published(df).collect()}
    assert len(got) == 250 and {k: v for k, v in got.items() if v} == brute_fold(rows)


def test_ics(spark, tmp_path):
    e = spark.createDataFrame([("u1", "Titre, long; é" + "x" * 90, TODAY, None, 1320, None, False, "V", "Salle", "cat", "Libre", None, "https://x.example/1", "cancelled"), ("u2", "J", TODAY, D(2026, 9, 14), None, None, True, "V", None, None, None, "r", None, "scheduled")], "uid string, title string, start_date date, end_date date, start_min int, end_min int, recurring boolean, venue_name string, location_name string, category string, price string, summary string, url string, status string")
    got = {r.uid: r.vevent.split("\r\n") for r in sinks.ics_lines(e).collect()}
    assert all(len(line.encode()) <= 75 for v in got.values() for line in v)
    one = "\r\n".join(got["u1"]).replace("\r\n ", "").split("\r\n")
    assert "DTSTART;TZID=Europe/Paris:20260912T220000" in one and "DTEND;TZID=Europe/Paris:20260913T000000" in one and one[1].startswith("SUMMARY:Titre\\, long\\; é") and "LOCATION:V - Salle" in one and "STATUS:CANCELLED" in one
    assert "DTEND;VALUE=DATE:20260915" in got["u2"]
    sinks.write_ics(e, str(tmp_path / "ics"))
    assert spark.read.text(str(tmp_path / "ics")).where("value like 'BEGIN:VEVENT%'").count() == 2


# HTML

PAGE = """<html><head><title>Agenda - Le Lieu</title><meta property="og:title" content="Agenda"></head><body><ul class="l">
<li class="event" data-date="2026-09-20"><h3>Un concert...</h3><span class="date">mardi 15 septembre 2026</span><span class="time">20h30 - 22h</span><img src="/a.jpg" width=20 height=20><img data-src="/b.jpg" src="data:x">
<li class="event"><h3>Expo</h3><span class="date">du 20 au 25 septembre</span><a href="/x">lien</a>
<li class="event" data-date="2026-09-22"><h3>Iso</h3><span class="date">14h</span><li class="event"></li><li class="event"><h3>Rien</h3></ul><p>un<p>deux</body></html>"""


def test_tree_and_css():
    root = tree.parse(PAGE)
    assert [n.text() for n in css.select(root, "ul.l > li:first-of-type h3, p:last-of-type")] == ["Un concert...", "deux"]
    assert len(css.select(root, "li")) == 5 and len(css.select(root, "li:not([data-date])")) == 3
    assert [n.text() for n in css.select(root, "h3 + span, li:nth-child(2) > a[href^='/']")] == ["mardi 15 septembre 2026", "du 20 au 25 septembre", "lien", "14h"]
    for bad in ("", "li >", ":nope", "[x"):
        with pytest.raises(ValueError):
            css.select(root, bad)
    assert tree.parse(None).text() == "" and tree.parse("<b>a<i>b</b>c").text() == "a b c"
    assert ops.title_candidates(PAGE) == ["Agenda"]
    assert ops.first_image(root, "https://x.example/p") == "https://x.example/b.jpg"
    assert ops.agenda_links('<a href="/agenda/">Programme</a><a href="/a">x</a><a href="https://y.example/agenda">z</a>', "https://x.example/") == [("https://x.example/agenda/", "Programme", 2)]
    assert ops.social_links('<a href="https://www.instagram.com/p/1">a</a><a href="https://www.instagram.com/lieu/">b</a>') == ("lieu", None)


RULE = execute.HtmlRule(item="li.event", fields={"title": ops.Field("h3"), "date": ops.Field(".date"), "time": ops.Field(".time"), "url": ops.Field("a", "href")})


def test_html_rules(spark):
    docs = spark.createDataFrame([("https://x.example/a", PAGE), ("n", None), ("b", "<p>no list</p>")], "url string, raw string")
    df = execute.apply_rules(docs, [RULE], TODAY)
    got = {(r.doc_url, r.title): r for r in df.where("failure is null").collect()}
    a = got["https://x.example/a", "Un concert"]
    assert (a.start_date, a.start_min, a.end_min, a.title_truncated, a.image) == (D(2026, 9, 15), 1230, 1320, True, "https://x.example/b.jpg")
    assert got["https://x.example/a", "Expo"].end_date == D(2026, 9, 25) and got["https://x.example/a", "Expo"].url == "https://x.example/x"
    assert (got["https://x.example/a", "Iso"].start_date, got["https://x.example/a", "Iso"].start_min) == (D(2026, 9, 22), 840)
    assert sorted(r.failure for r in df.where("failure is not null").collect()) == ["no items for selector: li.event", "no items for selector: li.event", "undated"]
    s = {r.doc_url: r for r in execute.statistics(df).collect()}["https://x.example/a"]
    assert (s.items_seen, s.failures, s.undated, s.events) == (4, 0, 1, 3)


def test_runs_of_siblings(spark):
    raw = "<div><h3>A</h3><p>12/10/2026</p><h3>B</h3><p>13/10/2026</p>x</div>"
    rule = execute.HtmlRule(item="h3", run=True, fields={"title": ops.Field("h3"), "date": ops.Field("p")})
    got = execute.apply_rules(spark.createDataFrame([("u", raw)], "url string, raw string"), [rule], TODAY).collect()
    assert {(r.title, r.start_date) for r in got} == {("A", D(2026, 10, 12)), ("B", D(2026, 10, 13))}


def test_json_rules(spark):
    raw = '{"l": [{"t": "A <b>x</b>", "h": "18h", "img": {"sizes": {"medium": "https://x.example/m.jpg"}}, "s": [{"d": "20260925"}, {"d": "20261001"}, {"d": "bad"}]}, {"t": null, "s": [{"d": "20260925"}]}, {"s": 3}]}'
    rule = execute.JsonRule("l", {"title": ops.Field("item.t"), "date": ops.Field("d"), "time": ops.Field("item.h")}, expand_path="s", date_format="%Y%m%d")
    df = execute.apply_rules(spark.createDataFrame([("u", raw), ("v", "{")], "url string, raw string"), [rule], TODAY)
    assert {(r.title, r.start_date, r.start_min, r.image) for r in df.where("failure is null").collect()} == {("A x", D(2026, 9, 25), 1080, None), ("A x", D(2026, 10, 1), 1080, None)}
    assert sorted(r.failure.split(":")[0] for r in df.where("failure is not null").collect()) == ["empty title", "invalid JSON", "no date found"]
    assert execute.resolve({"a": [{"b": 1}, {"b": [2]}]}, "a.b") == [1, [2]] and execute.resolve({"a": [5]}, "a.0") == 5 and execute.resolve(3, "a") is None
    assert execute.json_image({"x": {"cover": {"url": "https://x.example/c.png"}}}) == "https://x.example/c.png" and execute.json_image({"logo": "https://x.example/l.svg"}) is None


# validation, social, sources


def test_check_events(spark):
    docs = spark.createDataFrame([("d", "Le Concert de  Été\nsamedi 12 septembre à 20h, entrée libre", "raw https://x.example/in-raw", ["https://x.example/l/"])], "url string, text string, raw string, links array<string>")
    rows = [
        (1, "d", "concert de ete", "https://x.example/l", ["samedi 12 septembre"], TODAY, None, True), (2, "d", "absent", "https://x.example/no", ["court", "dimanche jamais écrit"], TODAY - datetime.timedelta(1), None, True),
        (3, "d", "absent", "https://x.example/no", ["mardi"], TODAY, TODAY - datetime.timedelta(3), False), (4, "missing", "t", None, [], TODAY, None, True), (5, "d", "Concert de Été", "https://x.example/in-raw", None, TODAY + datetime.timedelta(900), None, True),
    ]
    got = {r.i: [p.split(":")[0].split(" (")[0] for p in r.problems] for r in validate.check_events(spark.createDataFrame(rows, "i int, doc_url string, title string, url string, evidence array<string>, start_date date, end_date date, grounded_text boolean"), docs, TODAY).collect()}
    assert got[1] == []
    assert got[2] == ["evidence too short to be meaningful", "evidence not found verbatim in source", "title not found in source", "url not present in source", "event is in the past", "weekday mismatch"]
    assert [p.split(" 2026")[0] for p in got[3]] == ["event is in the past", "end_date", "weekday mismatch"] and got[4] == ["document missing"] and len(got[5]) == 1


def test_windows_and_posts(spark):
    t = "a" * 50 + "QUOTE" + "b" * 50 + "OTHER" + "c" * 50
    w = spark.createDataFrame([(t, ["QUOTE", "OTHER", "none"]), (t, ["none"]), (t, [])], "t string, q array<string>").select(validate.evidence_windows(F.col("t"), F.col("q"), 10).alias("w"), validate.evidence_windows(F.col("t"), F.col("q"), 30).alias("v")).collect()
    assert w[0].w == "a" * 10 + "QUOTE" + "b" * 10 + "\n[...]\n" + "b" * 10 + "OTHER" + "c" * 10 and "[...]" not in w[0].v and w[1].w == "a" * 20 and w[2].w == "a" * 20
    p = spark.createDataFrame([(1, "Concert de Lou samedi", 0, TODAY, "Concert de Lou", "https://no.example", ["Concert de Lou"], TODAY, None, False), (2, "x", 0, TODAY, "y", None, ["zz"], TODAY - datetime.timedelta(9), None, False), (3, None, 1, TODAY, "y", None, [], TODAY + datetime.timedelta(400), None, True)], "i int, post_text string, n_images int, published date, title string, url string, evidence array<string>, start_date date, end_date date, from_image boolean")
    got = {r.i: (len(r.problems), r.url) for r in validate.check_posts(p, TODAY).collect()}
    assert got == {1: (0, None), 2: (4, None), 3: (1, None)}


def test_social(spark):
    r = spark.range(1).select(social.instagram_handle(F.lit("@le.lieu")), social.instagram_handle(F.lit("https://www.instagram.com/le.lieu/?hl=fr")), social.instagram_handle(F.lit("https://instagram.com/p/")), social.facebook_handle(F.lit("https://fr-fr.facebook.com/lelieu/events?x=1")), social.coerce_timestamp(F.lit("2026-10-01T17:00:00Z")), social.coerce_timestamp(F.lit("1700000000000")), social.coerce_timestamp(F.lit("x"))).first()
    assert list(r)[:4] == ["https://www.instagram.com/le.lieu/", "https://www.instagram.com/le.lieu/", None, "https://www.facebook.com/lelieu/"] and r[4] == datetime.datetime(2026, 10, 1, 17) and r[5] is None and r[6] is None
    e = spark.createDataFrame([("1", "N", datetime.datetime(2026, 10, 1, 22, 30), "3 days", "u", "p", "x " * 300, "L")], "id string, name string, start timestamp, duration string, url string, price string, description string, location_name string")
    x = social.event_rows(e).first()
    assert (x.start_date, x.start_min, x.end_date, len(x.summary)) == (D(2026, 10, 2), 30, D(2026, 10, 4), 200)
    cache = "source_key string, published timestamp, pos int, title_key string, start_date date, end_date date, verdict string, url string, post_url string, image_urls array<string>"
    t0 = datetime.datetime(2026, 9, 1)
    rows = [("s", t0, 0, "a", TODAY, None, "accept", None, "p1", ["i1"]), ("s", t0 + datetime.timedelta(1), 0, "a", TODAY, None, None, "u", "p2", []), ("s", t0, 1, "b", TODAY, None, "reject", None, "p", None), ("s", t0, 2, "c", D(2026, 1, 1), None, "accept", None, "p", None)]
    got = social.rebuild(spark.createDataFrame(rows, cache), TODAY).collect()
    assert [(g.title_key, g.url, g.image_source) for g in got] == [("a", "u", None)]
    acts = spark.createDataFrame([([("1", None), (None, "no_results")],), ([(None, "no_results")],), ([(None, "boom"), (None, "no_results")],)], "items array<struct<id:string,error:string>>").select(social.actor_result(F.col("items")).alias("r")).collect()
    assert [(len(a.r.usable), a.r.error) for a in acts] == [(1, None), (0, None), (0, "boom")]


def test_sources(spark, tmp_path):
    (tmp_path / "v.json").write_text('{"venues": [{"name": "Le Théâtre"}, {"name": "B", "id": "b", "web": false}, {"id": "x"}]}')
    assert {(r.id, r.map_name, r.web, r.category) for r in read_venues(spark, str(tmp_path / "v.json")).collect()} == {("le-theatre", "Le Théâtre", True, "autre"), ("b", "B", False, "autre")}
    store = Store(spark, str(tmp_path / "store"))
    assert store.read("t", "a int").count() == 0
    for i in range(3):
        store.write("t", spark.createDataFrame([(i,)], "a int"), i)
    assert [r.a for r in store.read("t", "a int").collect()] == [2]
    pages = spark.createDataFrame([("u", "<body><i c=1></body></html>"), ("v", "none")], "url string, raw string")
    parts = spark.createDataFrame([("u", "1", "<i c=2>", True), ("u", "2", "<i c=1>", True), ("u", "9", "never", True)], "url string, cursor string, html string, more boolean")
    got = {r.url: (r.raw, r.pages_added) for r in connectors.with_more_pages(pages, parts, r"c=(\d)").collect()}
    assert got == {"u": ("<body><i c=1>\n<i c=2>\n<i c=1>\n</body></html>", 2), "v": ("none", 0)}
    d = connectors.to_documents(spark.createDataFrame([("https://x.example/", "html", '<p>a <a href="/b">b</a></p>'), ("j", "json", "{}")], "url string, kind string, raw string")).collect()
    assert [(r.text, r.links) for r in d] == [("a b (https://x.example/b)", ["https://x.example/b"]), ("{}", [])]


def test_stream(spark, tmp_path):
    source, store = tmp_path / "in", Store(spark, str(tmp_path / "state"))
    schema = "id string, received timestamp, row bigint"
    t = datetime.datetime(2026, 1, 1)
    for i, ids in enumerate([["1300000000000001", "1300000000000002", "odd", None], ["1300000000000002", "1300000000000003", "odd", None, "1300000000000003"]]):
        spark.createDataFrame([(x, t, 10 * i + k) for k, x in enumerate(ids)], schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        agenda.exactly_once_stream(stream, "id", "received", "row", store, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    got = sorted(r.row for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [0, 1, 2, 3, 11, 13]
    assert [(r.producer, r.lo, r.hi) for r in store.read("seen", "producer string, lo bigint, hi bigint, n bigint").collect()] == [("16:1300", 1, 3)]


@pytest.mark.parametrize("written", [("odd",), ("odd", "seen")])
def test_stream_replay(spark, tmp_path, written):
    """The query died after the state of batch 1 was written, wholly or in part, and before the batch was committed."""
    source, store = tmp_path / "in", Store(spark, str(tmp_path / "state"))
    schema, t = "id string, received timestamp, row bigint", datetime.datetime(2026, 1, 1)

    def deliver(first, ids):
        if ids:
            spark.createDataFrame([(x, t, first + k) for k, x in enumerate(ids)], schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        agenda.exactly_once_stream(stream, "id", "received", "row", store, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
        return sorted(r.row for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert deliver(0, ["1300000000000001", "odd"]) == [0, 1]
    assert deliver(10, ["1300000000000001", "1300000000000002", "odd", "strange"]) == [0, 1, 11, 13]
    for table in {"odd", "seen"} - set(written):
        for pointer in (tmp_path / "state" / table / "_pointers").glob("*000000000001~*"):
            pointer.unlink()
    for name in ("1", ".1.crc"):
        (tmp_path / "cp" / "commits" / name).unlink(missing_ok=True)
    assert deliver(20, []) == [0, 1, 11, 13]
    assert deliver(30, ["1300000000000002", "1300000000000003", "strange"]) == [0, 1, 11, 13, 31]


def test_stream_windows(spark, tmp_path):
    t = datetime.datetime(2026, 1, 1, 10)
    rows = [(t + datetime.timedelta(minutes=m), k) for m, k in ((0, "a"), (10, "a"), (70, "a"), (5, "b"), (200, "a"))]
    spark.createDataFrame(rows, "at timestamp, k string").coalesce(1).write.parquet(str(tmp_path / "in"))
    for i, f in enumerate((agenda.windowed_counts, agenda.sessions)):
        stream = f(spark.readStream.schema("at timestamp, k string").parquet(str(tmp_path / "in")), "at", "k")
        stream.writeStream.outputMode("complete" if i == 0 else "append").format("memory").queryName(f"q{i}").option("checkpointLocation", str(tmp_path / f"cp{i}")).trigger(availableNow=True).start().awaitTermination(60)
    assert {(r.window_start, r.k, r.n) for r in spark.table("q0").collect()} == {(t, "a", 2), (t + datetime.timedelta(hours=1), "a", 1), (t, "b", 1), (t + datetime.timedelta(hours=3), "a", 1)}
    # Sessions come out when the watermark, two hours behind the latest row, has passed them.
    assert {(r.session_start, r.k, r.n) for r in spark.table("q1").collect()} == {(t, "a", 2), (t + datetime.timedelta(minutes=5), "b", 1)}


def test_at_venue(spark):
    rows = [("salle (a|b)", "La SALLE B"), (None, "x"), ("a", None), ("(", "x"), ("café", "au CAFE"), ("nope", "x"), (r"\S+ 1", "été 1")]
    df = spark.createDataFrame(rows, "p string, l string").select("p", "l", validate.at_venue(F.col("p"), F.col("l")).alias("ok"))
    assert [r.ok for r in df.collect()] == [True, True, True, True, True, False, True]
