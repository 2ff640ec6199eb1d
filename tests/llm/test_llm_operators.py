import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from cadenza.llm import bpe, canonical, leakage, multiset, reading, truncation



# p1


def titles(n=40):
    r = random.Random(5)
    ends = ["chansons traditionnelles et réarrangées", "histoire populaire des luttes ouvrières", "dialogue entre danse contemporaine et percussions"]
    return [f"Concert {''.join(r.choice('bdfglmnprstv') + r.choice('aeiou') for _ in range(3)).title()} : {r.choice(ends)}" for _ in range(n)]


def test_cut_texts(spark):
    rows = [(i, "free", t, None, None) for i, t in enumerate(titles(60))]
    cut = [t[:45] for t in titles(25)]
    rows += [(100 + i, "capped", t, None, None) for i, t in enumerate(cut)]
    rows += [(200, "free", "Concert Zuzu : dialogue entre danse […]", None, None), (201, "free", "Concert Zuzu : dialogue entre danse… Lire la suite", "https://x.example", True), (202, "free", "Zuzu, ou presque...", None, False)]
    rows += [(203, "free", "Zuzu (concert", None, None), (204, None, "Concert Momo : histoire populaire des luttes ouvri", None, None), (205, "free", None, None, True), (206, "free", "", None, None), (207, "free", "…", None, None), (208, "free", "x" * 50_000, None, None), (209, "free", "Concert Zuzu : dialogue entre danse […]" + " " * 90 + "\u00a0\n", None, None)]
    df = spark.createDataFrame(rows, "row_id bigint, s string, t string, c string, said boolean").withColumn("mark", F.lit("m")).withColumn("tokens", F.lit(1))
    got = {r.row: r.reason for r in truncation.cut_texts(df, "row_id", "s", "t", "c").collect()}
    assert {i for i in range(60) if got[i]} == set()
    assert all(got[100 + i] for i in range(len(cut)))
    assert got[200] == "mark" and got[201] is None and got[202] is None and got[203] == "unfinished" and got[204] == "transfer" and got[208] is None and got[209] == "mark"
    assert not {205, 206, 207} & set(got)
    share = {r.source: (r.texts, r.cut) for r in truncation.by_source(truncation.cut_texts(df, "row_id", "s", "t", "c")).collect()}
    assert share["capped"] == (25, 25) and share[None] == (1, 1)
    assert truncation.cut_texts(df.limit(0), "row_id", "s", "t").count() == 0


def test_cut_at_bytes(spark):
    rows = [(i, "free", t) for i, t in enumerate(titles(60))]
    ends = ["chansons traditionnelles", "histoire populaire des luttes", "dialogue entre danse contemporaine et percussions"]
    # Cut at 42 bytes: 30 whole texts of 42, 4 in a character of two, three or four bytes, written with U+FFFD, so 44 bytes.
    cut = [f"Concert {'bdfgl'[i % 5]}{'aeiou'[i // 5 % 5]}zuzu{i:02d} : {ends[2]}".encode()[:42].decode() for i in range(30)]
    split = [f"Soir {'bdfgl'[i]}: {ends[0]}".ljust(60, "x").encode()[:42 - k] + c.encode()[:k] for i, (c, k) in enumerate((("é", 1), ("€", 2), ("🎤", 3), ("é", 1)))]
    split = [b.decode("utf-8", "replace") for b in split]
    assert {len(t.encode()) for t in cut} == {42} and max(len(t.encode()) for t in split) == 44
    rows += [(100 + i, "bytes", t) for i, t in enumerate(cut)] + [(200 + i, "bytes", t) for i, t in enumerate(split)]
    rows += [(300, "bytes", "Zuzu : inconnu de tout le monde ici, qwrtz"), (301, "bytes", "Zuzu : inconnu de tout le monde, qwrt")]
    df = spark.createDataFrame(rows, "row_id bigint, s string, t string")
    shaped = truncation._shaped(df, "row_id", "s", "t", None)
    assert [(r.source, r.limit_bytes) for r in truncation.spikes(shaped).collect() if r.source == "bytes"] == [("bytes", 42)]
    got = {r.row: r.reason for r in truncation.cut_texts(df, "row_id", "s", "t").collect()}
    assert all(got[100 + i] for i in range(30)) and all(got[200 + i] == "unfinished" for i in range(4))
    assert got[300] == "limit" and got[301] is None and not any(got[i] for i in range(60))


# p3

SAME = ["Вечер поэзии", "👨‍👩‍👧 en famille ❤️", "« œuvre » – l’été… 12 h\tà\n20 h", "μουσική", "", "plain", "éàüç ŷ", "می‌خواهم"]
CHANGED = {
    "Ｃｏｎｃｅｒｔ": "Concert", "ﬁn de ﬂot": "fin de flot", "été": "été", "a​b﻿": "ab", "Salle 2": "Salle 2", "ciné‑club": "ciné-club", "Siрola": "Sipola", "Сoncert": "Concert",
    "Vatɑ": "Vata", "соncеrt": "concert", "d­é": "dé", "Soirе́e": "Soirée", "Вeчер": "Вечер", "x‍y": "xy", "Ａ　Ｂ": "A B",
}


def test_canonical(spark):
    for t in SAME:
        assert canonical.canonical(t) == t
    for t, wanted in CHANGED.items():
        assert canonical.canonical(t) == wanted and canonical.canonical(wanted) == wanted, t
    long = "mot " * 50_000 + "ﬁn"
    df = spark.createDataFrame([(t,) for t in [*SAME, *CHANGED, None, long]], "t string")
    got = {r.t: (r.c, r.v) for r in df.select("t", canonical.canonical_form(F.col("t")).alias("c"), canonical.has_variants(F.col("t")).alias("v")).collect()}
    assert all(got[t] == (t, False) for t in SAME) and got[None] == (None, False)
    assert all(got[t] == (w, True) for t, w in CHANGED.items()) and got[long][0].endswith("fin")


def test_canonical_quick_check_is_safe():
    import re

    beyond = re.compile(canonical.BEYOND)
    for n in range(0x250, 0x3000):
        t = f"a{chr(n)}b"
        if unicodedata.category(chr(n)) != "Cn" and canonical.canonical(t) != t:
            assert beyond.search(t), hex(n)


def test_canonical_equivalence_of_all_characters():
    for n in range(0x80, 0x32000):
        if 0xD800 <= n <= 0xDFFF or unicodedata.category(chr(n)) == "Cn":
            continue
        for text in (chr(n), f"a{chr(n)}b"):
            once = canonical.canonical(text)
            assert {canonical.canonical(unicodedata.normalize(form, text)) for form in ("NFC", "NFD")} == {once}, hex(n)
            assert canonical.canonical(once) == once, hex(n)


def test_canonical_forms(spark):
    pairs = {"Ⅳ": "IV", "ｶﾞ": "ガ", "Å": "Å", "Ω": "Ω", "한": "한", "𝐇𝐞𝐥𝐥𝐨": "Hello", "ﻼ": "لا", "тhéâtre": "тhéâtre", "cοncerτ": "concert", "օpera": "opera", "Ꭺpollo": "Apollo", "क़": "क़"}
    same = ["②", "m²", "½", "kΩ", "œuvre", "Концерт", "…", "क़"[:1]]
    df = spark.createDataFrame([(t,) for t in (*pairs, *same)], "t string")
    got = {r.t: r.c for r in df.select("t", canonical.canonical_form(F.col("t")).alias("c")).collect()}
    assert all(got[t] == unicodedata.normalize("NFC", w) for t, w in pairs.items()), got
    assert all(got[t] == t for t in same)


# p4


def norm(v):
    if v is None:
        return None
    return "".join(c for c in v.lower() if unicodedata.category(c)[0] in "LMN")


def test_multiset_brute_force(spark):
    r = random.Random(7)
    pick = lambda xs: r.choice(xs)
    rows = [(i, pick(["La Forge", "la-forge", "LAFORGE", None, "", "«»"]), pick(["2026-10-01", "2026.10.01", "20261001", None]), pick(["Été", "été!", "Ete", "  É T É ", None, "?", "x" * 20_000])) for i in range(300)]
    rows += [(1000 + i, "hot", "hot", "hot") for i in range(200)]
    df = spark.createDataFrame(rows, "k bigint, v string, s string, t string").withColumn("_a", F.lit(1)).withColumn("copies", F.lit(2))
    first, wanted = {}, set()
    for k, *vs in rows:
        key = tuple(map(norm, vs))
        if key in first:
            wanted.add((first[key], k))
        else:
            first[key] = k
    got = [(x.first_id, x.copy_id) for x in multiset.copies(df, "k", ["v", "s", "t"]).collect()]
    assert len(got) == len(wanted) and set(got) == wanted
    assert {x.first_id: x.copies for x in multiset.groups(df, "k", ["v", "s", "t"]).collect()}[1000] == 200
    assert multiset.copies(df.limit(0), "k", ["v", "s", "t"]).count() == 0


def test_multiset_hot_fingerprint(spark):
    """A third of all rows are one record, over many batches; their order is mixed."""
    rows = [((i * 7919) % 9_973, *(("Hot !", "H") if i % 3 == 0 else (f"t{i % 4_001}", None))) for i in range(9_973)]
    df = spark.createDataFrame(rows, "k bigint, v string, t string").repartition(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = {(x.first_id, x.copy_id) for x in multiset.copies(df, "k", ["v", "t"]).collect()}
        counted = {x.first_id: x.copies for x in multiset.groups(df, "k", ["v", "t"]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    members = {}
    for k, v, t in rows:
        members.setdefault((v, t), []).append(k)
    assert got == {(min(ks), k) for ks in members.values() for k in ks if k != min(ks)}
    assert counted == {min(ks): len(ks) for ks in members.values()}


def test_multiset_order_and_collisions(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a", "b"), (2, "b", "a"), (3, "a", "b"), (4, "b", "a"), (5, "a", None), (6, None, "a")], "k bigint, v string, t string")
    assert {(x.first_id, x.copy_id) for x in multiset.copies(df, "k", ["v", "t"]).collect()} == {(1, 3), (2, 4)}
    monkeypatch.setattr(multiset, "fingerprint", lambda fields: (F.lit(0).cast("bigint"), F.lit(0).cast("bigint")))
    assert {(x.first_id, x.copy_id) for x in multiset.copies(df, "k", ["v", "t"]).collect()} == {(1, 3), (2, 4)}


# p8


def test_encoding(spark):
    path = bpe.DEFAULT_VOCABULARY
    try:
        tokenizer = __import__("tokenizers").Tokenizer.from_file(path)
    except Exception:
        pytest.skip("no vocabulary")
    tokenizer.encode_special_tokens = True
    texts = [None, "", " ", "L'été à Sète,  c'est  long…\n\n\tOui !", "<|endoftext|> x", "日本 𝒞𝒶 👩‍🎤", "a" * 3000, "é" * 900 + " fin", "x y　 z", "ab" * 200, "\r\n \x01 ", "Rofiresivo " * 50]
    rows = [(i, t) for i, t in enumerate(texts)] * 1
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("_w", F.lit(1)).withColumn("ids", F.lit(2))
    out = bpe.encode(df, "doc_id", "text")
    got = {r.doc_id: r.ids for r in out.collect()}
    for i, t in rows:
        assert got[i] == (tokenizer.encode(t, add_special_tokens=False).ids if t else []), t
    back = {r.doc_id: r.t for r in out.select("doc_id", bpe.decode(F.col("ids")).alias("t")).collect()}
    assert all(back[i] == (t or "") for i, t in rows)
    assert bpe.encode(df.limit(0), "doc_id", "text").count() == 0


# p9


def brute_leaks(docs, items, least):
    grams = {}
    for i, t in items:
        w = leakage.words_of(t)
        for k in range(len(w) - least + 1):
            grams.setdefault(tuple(w[k : k + least]), set()).add(i)
    return {(d, i) for d, t in docs for w in [leakage.words_of(t)] for k in range(len(w) - least + 1) for i in grams.get(tuple(w[k : k + least]), ())}


def test_leaks_brute_force(spark):
    r = random.Random(2)
    words = ["un", "deux", "Trois", "été", "Ete", "a", "b"]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [(i, say(r.randrange(0, 30))) for i in range(12)] + [(50, None), (51, ""), (52, "un deux trois")]
    docs = [(i, say(r.randrange(0, 120))) for i in range(60)] + [(100, None), (101, ""), (102, "<b>" + (items[0][1] or "") + "</b>" + " x" * 10_000)]
    docs += [(200 + i, "q " + items[1][1] + " z") for i in range(30)]
    least = 6
    got = leakage.leaks(spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit(1)), "doc_id", "text", spark.createDataFrame(items, "item_id bigint, text string"), "item_id", "text", least)
    rows = got.collect()
    assert {(x.doc_id, x.item_id) for x in rows} == brute_leaks(docs, items, least)
    for x in rows:
        d, i = leakage.words_of(dict(docs)[x.doc_id]), leakage.words_of(dict(items)[x.item_id])
        assert d[x.doc_word : x.doc_word + x.words] == i[x.item_word : x.item_word + x.words]
        assert not any(d[a : a + x.words + 1] == i[b : b + x.words + 1] for a in range(len(d) - x.words) for b in range(len(i) - x.words)) or len(d) > 1000
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert leakage.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), "doc_id", "text", empty, "item_id", "text").count() == 0


def test_leaks_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(leakage, "BLOCK_ITEMS", 2)
    items = [(i, " ".join(f"w{i}x{k}" for k in range(15))) for i in range(5)]
    docs = spark.createDataFrame([(1, "début " + items[0][1].upper() + "!"), (2, items[3][1].replace(" ", ", <em>") + " " + items[4][1])], "doc_id bigint, text string")
    got = leakage.leaks(docs, "doc_id", "text", spark.createDataFrame(items, "item_id bigint, text string"), "item_id", "text")
    assert {(x.doc_id, x.item_id, x.words) for x in got.collect()} == {(1, 0, 15), (2, 3, 15), (2, 4, 15)}
    assert leakage.without_leaks(docs, "doc_id", got).count() == 0


def test_words():
    assert leakage.words_of("<b>L’É</b>té&nbsp;à **Sète** _x_ co-op <br/>fin") == ["l", "ete", "a", "sete", "x", "co", "op", "fin"]


def test_suffix_array():
    r = random.Random(4)
    import numpy as np

    ids = np.array([r.randrange(4) for _ in range(300)])
    order = leakage.suffix_array(ids, 300)
    assert order.tolist() == sorted(range(300), key=lambda i: ids[i:].tolist())


# p10


def test_label_targets(spark):
    rows = [(1, "a", 2), (1, "a", 4), (1, "b", 2), (1, "c", None), (1, "c", 9), (2, None, 5), (3, "a", 0)]
    got = {r.doc_id: r.target for r in reading.label_targets(spark.createDataFrame(rows, "doc_id bigint, rater string, reading_level int")).collect()}
    assert got == {1: [0, 0.75, 0, 0.25, 0], 2: [0, 0, 0, 0, 1]}


def test_reading_levels(spark):
    r = random.Random(9)
    pool = [["Le chat joue dans la cour.", "Tu veux rire ou chanter ?"], ["On se retrouve sur la place du village pour partager un repas."], ["Depuis plusieurs années la compagnie propose une programmation variée."], ["La délégation territoriale conditionne la restructuration de la gouvernance."], ["La phénoménologie de la réception excède ontologiquement la clôture herméneutique du corpus."]]
    make = lambda level: " ".join(r.choice(pool[level if r.random() < 0.85 else r.randrange(5)]) for _ in range(30))
    docs = [(i, make(i % 5)) for i in range(200)] + [(900, None), (901, ""), (902, "court"), (903, "\n".join(["Le chat joue dans la cour."] * 5000)), (904, "!" * 500)]
    labels = [(i, f"r{k}", max(1, min(5, i % 5 + 1 + (r.random() < 0.1)))) for i in range(60) for k in range(2)] + [(1, None, None), (77777, "r", 3), (2, "r", 9)]
    documents = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("reading_level", F.lit("x"))
    model = reading.train(documents.select("doc_id", "text"), spark.createDataFrame(labels, "doc_id bigint, rater string, reading_level int"))
    got = {x.doc_id: x for x in reading.levels(documents, "doc_id", "text", model).collect()}
    assert not {900, 901, 902, 904} & set(got) and got[903].reading_level == 1
    held = [i for i in range(60, 200)]
    assert sum(got[i].reading_level == i % 5 + 1 for i in held) >= 0.9 * len(held)
    assert all(abs(x.p1 + x.p2 + x.p3 + x.p4 + x.p5 - 1) < 1e-6 for x in got.values())
    nothing = reading.train(documents.select("doc_id", "text"), spark.createDataFrame([], "doc_id bigint, rater string, reading_level int"))
    empty = reading.levels(documents, "doc_id", "text", nothing)
    assert nothing is None and empty.count() == 0 and empty.columns == reading.levels(documents, "doc_id", "text", model).columns


def test_reading_level_of_long_labelled_documents(spark):
    same = "Le texte commence ici. " * 1000  # over 20,000 characters that all of them share
    pool = ["Tu veux rire ou chanter ? ", "La restructuration conditionne la gouvernance. "]
    docs = [(i, same + pool[i % 2] * 300) for i in range(20)]
    labels = spark.createDataFrame([(i, "r", 1 + 4 * (i % 2)) for i in range(12)], "doc_id bigint, rater string, reading_level int")
    documents = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {x.doc_id: x.reading_level for x in reading.levels(documents, "doc_id", "text", reading.train(documents, labels)).collect()}
    assert got == {i: 1 + 4 * (i % 2) for i in range(20)}


@pytest.mark.parametrize("n", [1, 4, 12, 70])
def test_reading_model_is_fitted_alike_for_all_sizes(monkeypatch, n):
    import numpy as np

    held, calls = [], reading.document_features
    monkeypatch.setattr(reading, "document_features", lambda model, docs: held.append((model, docs)) or calls(model, docs))
    texts = [f"Commun {'rare' if i in (1, 2) else ''} seul{chr(97 + i // 26)}{chr(97 + i % 26)}." for i in range(n)]
    model = reading.fit(texts, np.eye(5)[np.arange(n) % 5])
    assert sum(len(docs) for _, docs in held) == n and (n == 1 or all(m is not model.sentence for m, _ in held))
    assert [bool(model.sentence.known[reading._hash(w)]) for w in ("wcommun", "wrare", "wseulaa")] == [n > 1, n > 2, False]
