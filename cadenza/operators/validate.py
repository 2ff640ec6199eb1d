"""Grounding of extracted events in their documents, with reasons."""

from __future__ import annotations

import datetime
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.dates import WEEKDAYS
from cadenza.functions.text import let, normalize_text, strip_accents

HORIZON_DAYS = 540
LEAST_EVIDENCE = 12
LEAST_POST_EVIDENCE = 8
LEAD_DAYS = 300
RADIUS = 700
_WEEKDAY_WORD = r"(?i)\b(" + "|".join(WEEKDAYS) + r")\b"


def weekday_problem(evidence: Column, start: Column) -> Column:
    """FL-2: a reason where the evidence (an array of texts) names exactly one weekday and the date is another."""
    named = F.array_distinct(F.transform(F.regexp_extract_all(F.array_join(evidence, " "), F.lit(_WEEKDAY_WORD), F.lit(1)), F.lower))
    actual = F.get(F.array(*[F.lit(w) for w in WEEKDAYS]), F.weekday(start))
    return let(named, lambda n: F.when((F.size(n) == 1) & (F.get(n, F.lit(0)) != actual), F.concat(F.lit("weekday mismatch: evidence says "), F.get(n, F.lit(0)), F.lit(" but "), start.cast("string"), F.lit(" is a "), actual)))


def date_problems(start: Column, end: Column, today: Column) -> list[Column]:
    """Reasons about the dates, each null where there is none."""
    last = F.coalesce(end, start)
    return [
        F.when(last < today, F.concat(F.lit("event is in the past ("), start.cast("string"), F.lit(" .. "), last.cast("string"), F.lit(")"))),
        F.when(start > F.date_add(today, HORIZON_DAYS), F.concat(F.lit("start_date "), start.cast("string"), F.lit(" is implausibly far in the future"))),
        F.when(end < start, F.concat(F.lit("end_date "), end.cast("string"), F.lit(" before start_date "), start.cast("string"))),
    ]


def normalized_documents(documents: DataFrame, key: str = "url", text: str = "text") -> DataFrame:
    """Each document's normalised text, once, before events are joined to it."""
    return documents.withColumn("norm", normalize_text(F.col(text))).withColumn("norm_plain", strip_accents(F.col("norm")))


def check_events(events: DataFrame, documents: DataFrame, today: datetime.date) -> DataFrame:
    """FL-1: ``events`` (doc_url, title, url, evidence, start_date, end_date, grounded_text) with ``problems``, an array of
    reasons, empty where the event passes. ``documents`` (url, text, raw, links) are normalised once each; the large
    columns are dropped right after the comparison. An event without document keeps its date checks and gets the reason
    that the document is missing. Text and url are not checked where grounded_text is false.
    """
    now = F.lit(today)
    docs = normalized_documents(documents).select(F.col("url").alias("doc_url"), "norm", "norm_plain", "raw", "links")
    quotes = F.coalesce("evidence", F.array().cast("array<string>"))
    joined = events.withColumn("_title", normalize_text(F.col("title"))).join(docs, "doc_url", "left")
    # Python functions can't stand inside lambdas: the quotes are normalised as one text, separated by a control character.
    norm_quotes = F.split(normalize_text(F.array_join(quotes, "\x01")), "\\s*\x01\\s*")
    joined = joined.withColumn("_quotes", F.when(F.size(quotes) > 0, norm_quotes).otherwise(F.array().cast("array<string>")))
    joined = joined.withColumn("_plain", F.split(strip_accents(F.array_join("_quotes", "\x01")), "\x01")).withColumn("_plain_title", strip_accents(F.col("_title")))
    checked = F.coalesce(F.col("grounded_text"), F.lit(True))
    quote_problems = F.transform(
        F.arrays_zip("_quotes", "_plain"),
        lambda q: F.when(F.length(q["_quotes"]) < LEAST_EVIDENCE, F.concat(F.lit("evidence too short to be meaningful: "), q["_quotes"]))
        .when(~(F.col("norm").contains(q["_quotes"]) | F.col("norm_plain").contains(q["_plain"])), F.concat(F.lit("evidence not found verbatim in source: "), F.left(q["_quotes"], F.lit(80)))),
    )
    title_problem = F.when(~(F.col("norm").contains(F.col("_title")) | F.col("norm_plain").contains(F.col("_plain_title"))), F.concat(F.lit("title not found in source: "), F.col("title")))
    u = F.trim("url")
    bare = F.regexp_replace(u, "/+$", "")
    known = F.array_union(F.coalesce("links", F.array().cast("array<string>")), F.array("doc_url", F.regexp_replace("doc_url", "/+$", "")))
    listed = F.array_contains(known, u) | F.array_contains(known, bare) | F.array_contains(known, F.concat(u, F.lit("/"))) | F.col("raw").contains(u)
    url_problem = F.when(F.coalesce(u, F.lit("")) != "", F.when(~listed, F.concat(F.lit("url not present in source: "), u)))
    lost = F.when(F.col("norm").isNull(), F.lit("document missing"))
    texts = F.when(checked, F.when(lost.isNotNull(), F.array(lost)).otherwise(F.concat(F.when(F.size("_quotes") > 0, quote_problems).otherwise(F.array().cast("array<string>")), F.array(title_problem, url_problem))))
    rest = F.array(*date_problems(F.col("start_date"), F.col("end_date"), now), weekday_problem(quotes, F.col("start_date")))
    problems = F.array_compact(F.concat(F.coalesce(texts, F.array().cast("array<string>")), rest))
    return joined.withColumn("problems", problems).drop("_title", "_plain_title", "_quotes", "_plain", "norm", "norm_plain", "raw", "links")


def check_posts(events: DataFrame, today: datetime.date) -> DataFrame:
    """FL-3 for events read from a post (post_text, n_images, published DATE, title, url, evidence, start_date, end_date,
    from_image): ``problems``, and ``url`` nulled where the caption doesn't hold it."""
    caption = normalize_text(F.coalesce("post_text", F.lit("")))
    quotes = F.coalesce("evidence", F.array().cast("array<string>"))
    e = events.withColumn("_caption", caption).withColumn("_title", normalize_text(F.col("title"))).withColumn("_quotes", F.split(normalize_text(F.array_join(quotes, "\x01")), "\\s*\x01\\s*"))
    pictured = F.coalesce("from_image", F.lit(False))
    texts = F.transform(
        F.when(F.size(quotes) > 0, F.col("_quotes")).otherwise(F.array().cast("array<string>")),
        lambda q: F.when(F.length(q) < LEAST_POST_EVIDENCE, F.concat(F.lit("evidence too short: "), q)).when(~F.col("_caption").contains(q), F.concat(F.lit("evidence not verbatim in caption: "), F.left(q, F.lit(80)))),
    )
    ahead = F.datediff("start_date", "published")
    own = F.array(
        F.when(pictured & (F.coalesce("n_images", F.lit(0)) == 0), F.lit("from_image is true but the post has no image")),
        F.when(~pictured & ~F.col("_caption").contains(F.col("_title")), F.concat(F.lit("title not found in caption: "), F.col("title"))),
        F.when(ahead < 0, F.lit("start_date before the post publication date (recap or wrong year)")),
        F.when(ahead > LEAD_DAYS, F.concat(F.lit("start_date is "), ahead.cast("string"), F.lit(" days after the post: wrong year"))),
        date_problems(F.col("start_date"), F.col("end_date"), F.lit(today))[0],
        date_problems(F.col("start_date"), F.col("end_date"), F.lit(today))[2],
        weekday_problem(quotes, F.col("start_date")),
    )
    problems = F.array_compact(F.concat(F.when(pictured, F.array().cast("array<string>")).otherwise(texts), own))
    in_caption = F.coalesce(F.contains(F.coalesce("post_text", F.lit("")), F.trim("url")), F.lit(False))
    return e.withColumn("problems", problems).withColumn("url", F.when(in_caption, F.col("url"))).drop("_caption", "_title", "_quotes")


def repeats(df: DataFrame, answer: str, key: Column, pos: str) -> DataFrame:
    """FL-4: rows whose key already came in the same answer."""
    w = Window.partitionBy(answer, "_key").orderBy(pos)
    return df.withColumn("_key", key).withColumn("_n", F.row_number().over(w)).where("_n > 1").drop("_key", "_n")


def evidence_windows(text: Column, quotes: Column, radius: int = RADIUS) -> Column:
    """DOC-22: the text around each quote that it holds, overlapping windows merged, joined by a mark; its beginning where
    it holds none. One pass over the sorted intervals."""

    def span(q: Column) -> Column:
        at = F.position(q, text)
        return F.when(at > 0, F.struct(F.greatest(F.lit(0), at - 1 - radius).alias("a"), F.least(F.length(text), at - 1 + F.length(q) + radius).alias("b")))

    found = F.array_sort(F.array_compact(F.transform(quotes, span)))
    none = F.array().cast("array<struct<a:int,b:int>>")

    def extend(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], x["b"]).alias("b"))))
        return F.when(F.size(done) == 0, F.array(x)).otherwise(F.when(x["a"] <= F.try_element_at(done, F.lit(-1))["b"], grown).otherwise(F.concat(done, F.array(x))))

    merged = F.aggregate(found.cast("array<struct<a:int,b:int>>"), none, extend)
    parts = F.transform(merged, lambda s: F.substring(text, s["a"] + 1, s["b"] - s["a"]))
    return let(parts, lambda p: F.when(F.size(p) > 0, F.array_join(p, "\n[...]\n")).otherwise(F.left(text, F.lit(2 * radius))))


def at_venue(pattern: Column, location: Column) -> Column:
    """FL-7: does a place fit a venue's own pattern (Python's dialect, any case, accents off on both sides)? Without pattern
    or place it does, and so it does where the pattern is no regular expression: one bad venue fails no job."""

    @F.pandas_udf("boolean")
    def fits(patterns: pd.Series, places: pd.Series) -> pd.Series:
        compiled: dict[str, re.Pattern | None] = {}
        for p in patterns.dropna().unique():
            try:
                compiled[p] = re.compile(p, re.I)
            except re.error:
                compiled[p] = None
        return pd.Series([p is None or t is None or compiled[p] is None or compiled[p].search(t) is not None for p, t in zip(patterns, places, strict=True)], dtype=bool)

    plain = strip_accents(normalize_text(location))
    return F.when(pattern.isNull() | location.isNull(), F.lit(True)).otherwise(fits(strip_accents(pattern), plain))


def present_in(pieces: DataFrame, piece: str, piece_key: str, texts: DataFrame, text: str, text_key: str) -> DataFrame:
    """JN-6 over an equality: pieces whose text of the same key holds them verbatim."""
    held = texts.select(F.col(text_key).alias("_k"), F.col(text).alias("_t"))
    return pieces.join(held, (F.col(piece_key) == F.col("_k")) & F.col("_t").contains(F.col(piece)), "left_semi")
