import datetime
import json

from pyspark.sql import functions as F

from cadenza.html import ops
from cadenza.operators import routes


def test_routes(spark):
    code = "fetch('/api/v1/users'); get(\"/api/events/list\"); x=`https://x.example/wp-json/agenda`; fetch('/api/v1/users'); '/img/a.png'"
    df = routes.collect_routes(spark.createDataFrame([("s", 0, code), ("s", 1, "'/programme'"), ("t", 0, None)], "site string, pos int, code string"))
    assert [(r.route, r.eventful, r.place) for r in df.orderBy("place").collect()] == [("/api/events/list", True, 1), ("https://x.example/wp-json/agenda", True, 2), ("/programme", True, 3), ("/api/v1/users", False, 4)]
    got = [r.candidate for r in routes.with_prefixes(df, ["/proxy/"], 4).orderBy("turn").collect()]
    assert got == ["/api/events/list", "/proxy/api/events/list", "https://x.example/wp-json/agenda", "/programme"]


def test_sample_json():
    v = {"a": [1, 2, 3], "b": {"c": {"d": {"e": 1}}}, "t": "x" * 500}
    s = routes.sample_json(v)
    assert s["a"] == [1, 2, "… 1 more"] and s["b"]["c"]["d"] == "{…}" and len(s["t"]) == 161
    text = json.dumps({"l": [{"n": i} for i in range(50)]})
    assert len(routes.trimmed_json(text, 120)) <= 120 and json.loads(routes.trimmed_json(text, 120))["l"][0] == {"n": 0} and len(routes.trimmed_json(text, 5)) == 5


def test_snippets(spark):
    today = datetime.date(2026, 9, 12)
    df = spark.createDataFrame([("Bal le 12 octobre 2026 à 20h. " + "x" * 300 + " puis 2026-01-02 fin, le 31 févr. 2026",), ("rien",), (None,)], "t string")
    got = [r.s for r in df.select(ops.snippets_column(F.col("t"), today).alias("s")).collect()]
    assert [(x.tag, x.day) for x in got[0]] == [("upcoming", "2026-10-12"), ("past", "2026-01-02")] and got[0][0].text.startswith("Bal le 12 octobre 2026 à 20h.") and got[1] == [] and got[2] == []
    assert ops.date_snippets("le 31 févr. 2026", today)[0][0] == "unparsed"


def test_pages():
    page = '<script type="application/ld+json">{"@type": "Event", "x": [{"@type": "MusicEvent"}]}</script><script type="application/ld+json">{</script><link href="/wp-json/"><a href="/cal?ical=1">c</a><a href="/agenda#x">Le programme</a><a href="/agenda">x</a><a href="https://o.example/agenda">o</a><a href="/contact">c</a><a href="https://www.instagram.com/p/">p</a><a href="https://instagram.com/le.lieu/?hl=fr">i</a><a href="https://www.facebook.com/lelieu/events">f</a><a href="https://www.facebook.com/LeLieu">f</a> 12 octobre 2026'
    s = ops.page_signals(page, "https://x.example/")
    assert (s["jsonld_events"], s["wordpress"], s["events_calendar_plugin"], s["dates"], s["ics_links"]) == ("2", "true", "false", "1", "https://x.example/cal?ical=1")
    assert ops.agenda_links(page, "https://x.example/") == [("https://x.example/agenda", "Le programme", 2)] and len(ops.agenda_links(page, "https://x.example/", same_host=False)) == 3
    assert ops.social_links(page) == ("le.lieu", "LeLieu") and ops.social_links(None) == (None, None) and ops.agenda_links(None, "") == []
