from cadenza.operators import enrich


def test_complete_titles(spark, monkeypatch):
    monkeypatch.setattr(enrich, "FETCHES", 2)
    page = lambda t: f"<title>{t} - Le Lieu</title><h1>{t}</h1>"
    events = [(f"u{i}", "v", "https://x.example/agenda", f"https://x.example/{i}", "Un titre", True, i) for i in range(4)] + [
        ("k", "v", "https://x.example/agenda", "https://x.example/k", "Connu", True, 0), ("o", "v", "https://x.example/agenda", "https://y.example/o", "Un titre", True, 0), ("w", "v", "https://x.example/agenda", "https://x.example/0", "Entier", False, 0), ("n", "w", "https://x.example/agenda", None, "Un", None, 0)
    ]
    known = spark.createDataFrame([("k", "Connu entier", "https://x.example/k"), ("u1", "Un titre", None)], "uid string, title string, title_completed_from string")
    pages = spark.createDataFrame([("https://x.example/0", page("un TITRE complet")), ("https://x.example/1", page("Autre chose")), ("https://x.example/2", page("Un titre trop tard")), ("https://y.example/o", page("Un titre ailleurs"))], "url string, html string")
    df = enrich.complete_titles(spark.createDataFrame(events, "uid string, venue_id string, source_url string, url string, title string, title_truncated boolean, pos int"), known, pages)
    got = {r.uid: (r.title, r.title_completed_from) for r in df.collect()}
    assert got["u0"] == ("un TITRE complet", "https://x.example/0") and got["k"] == ("Connu entier", "https://x.example/k")
    assert all(got[u][1] is None for u in ("u1", "u2", "u3", "o", "w", "n")) and got["u2"][0] == "Un titre"
    c = enrich.completion_counts(df).first()
    assert (c.truncated, c.completed, c.without_page) == (6, 2, 0)


def test_image_state(spark):
    events = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "image_source string")
    todo, orphans = enrich.image_state(events, spark.createDataFrame([("b",), ("c",)], "url string"))
    assert [r.url for r in todo.collect()] == ["a"] and [r.url for r in orphans.collect()] == ["c"]
    f = spark.createDataFrame([("https://x.example/1", "HTTP 404: gone"), ("https://x.example/2", "HTTP 404: no"), ("https://y.example/", "too big")], "url string, error string")
    assert [tuple(r) for r in enrich.failure_counts(f).collect()] == [("x.example", "HTTP 404", 2), ("y.example", "too big", 1)]
