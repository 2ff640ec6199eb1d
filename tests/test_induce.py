import datetime
import random

from pyspark.sql import functions as F

from cadenza.functions import dates
from cadenza.operators import execute, induce

TODAY = datetime.date(2026, 9, 12)
D = datetime.date
CARDS = "<nav><a href=/a>12/10/2026</a></nav><div class=list>" + "".join(f'<div class="card c{i}"><h3 class="t"><a href="/e/{i}">Concert numéro {i}</a></h3><span class="when">{10 + i} octobre 2026</span><span class="heure">20h30</span><p class="lieu">Salle {i}</p></div>' for i in range(6)) + "</div>"
DAYS = "<ul>" + "".join(f'<li class="jour" data-date="2026-10-{10 + i}"><b class="titre">Séance {i}</b> 20h</li>' for i in range(5)) + "</ul>"
RANGES = "".join(f'<article class="expo"><h2>Expo {i}</h2><div><time datetime="2026-10-0{i + 1}">x</time><time datetime="2026-11-0{i + 1}">y</time></div></article>' for i in range(4))
FLAT = "<div id=l>" + "".join(f'<div class="d">{10 + i} octobre 2026</div><div class="n">Titre {i}</div><div class="h">19h</div>' for i in range(5)) + "</div>"
PROSE = "<p>Rendez-vous le 12 octobre 2026 puis le 14 octobre 2026, en ville.</p>"


def test_layouts(spark):
    docs = spark.createDataFrame([("cards", CARDS), ("days", DAYS), ("ranges", RANGES), ("flat", FLAT), ("prose", PROSE), ("none", None)], "url string, raw string")
    got = {r.url: r for r in induce.inductions(docs, TODAY).collect()}
    assert got["prose"].rule is None and got["none"].rule is None
    wanted = {"cards": ("Concert numéro 0", D(2026, 10, 10), 6), "days": ("Séance 0", D(2026, 10, 10), 5), "ranges": ("Expo 0", D(2026, 10, 1), 4), "flat": ("Titre 0", D(2026, 10, 10), 5)}
    for url, (title, day, n) in wanted.items():
        assert got[url].accepted and got[url].events == n, got[url]
        events = execute.apply_rules(docs.where(F.col("url") == url), [induce.rule_from_json(got[url].rule)], TODAY).where("failure is null").orderBy("start_date").collect()
        assert (len(events), events[0].title, events[0].start_date) == (n, title, day)
    ranges = execute.apply_rules(docs.where("url = 'ranges'"), [induce.rule_from_json(got["ranges"].rule)], TODAY).orderBy("start_date").first()
    assert ranges.end_date == D(2026, 11, 1)
    cards = execute.apply_rules(docs.where("url = 'cards'"), [induce.rule_from_json(got["cards"].rule)], TODAY).orderBy("start_date").first()
    assert (cards.location_name, cards.start_min) == ("Salle 0", 1230)


def test_agreement(spark):
    a = spark.createDataFrame([("d", "x", TODAY), ("d", "y", TODAY), ("e", "x", TODAY)], "doc_url string, title string, start_date date")
    b = spark.createDataFrame([("d", "x", TODAY), ("d", "x", D(2026, 1, 1)), ("f", "x", TODAY)], "doc_url string, title string, start_date date")
    assert {r.doc_url: r.agreement for r in induce.agreement(a, b).collect()} == {"d": 0.5, "e": 0.0, "f": 0.0}


def test_native_dates_agree(spark):
    """The native parser against the one used inside trees, on random texts."""
    r = random.Random(6)
    words = ["le", "du", "au", "et", "mardi", "samedi", "12", "3", "1er", "31", "septembre", "sept.", "juin", "février", "2026", "2027", "à", "20h", "18:30", "2026-09-25", "15/09/2026", "30/02/26", "20261001", "&", "-", "mai"]
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(1, 7))) for _ in range(1500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", dates.fold(F.col("t")).alias("f"), dates.parse_date(F.col("t"), TODAY)["start"].alias("d"), dates.parse_date(F.col("t"), TODAY)["error"].alias("e")).collect()
    for x in rows:
        mine = dates.first_day(x.f, TODAY)
        if x.e in ("weekday mismatch", "invalid time"):
            continue
        assert mine == x.d, (x.t, mine, x.d, x.e)
