"""Texts that were cut at a source's limit or in transfer.

Per source, the lengths of its texts (in characters and in bytes) are histogrammed; a spike at the maximum is the
source's limit. A text is cut where it stands at such a limit or bears what a source puts in place of the rest, and
does not end as texts end. Few titles close with punctuation, so how texts end is counted over the whole corpus: the
last words of a text are ``open`` where they are nearly always followed by more (as a word, or as the start of a longer
word), and ``closed`` where they often end a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.canonical import canonical_form
from cadenza.tables import small_side, written

# What stands in place of the rest. The first kind is never an author's; plain dots may be.
EXPLICIT = r"(?i)\s*(?:(?:\.{2,}|…)\s*(?:lire la suite|en savoir \+|voir plus|read more|more)|(?:>>|»)\s*(?:voir plus|lire la suite|en savoir \+|read more)|\[\s*(?:…|\.{2,})\s*\]|\(\s*(?:…|\.{2,})\s*\)|&hellip;|&#8230;|&#x2026;)\s*$"
DOTS = r"\s*(?:…|\.{2,})\s*$"
ENTITIES = ("amp", "nbsp", "quot", "hellip", "eacute", "egrave", "ecirc", "agrave", "acirc", "ccedil", "icirc", "ocirc", "ugrave", "ucirc", "rsquo", "lsquo", "laquo", "raquo", "oelig", "euro")
_STARTS = "|".join(sorted({e[:n] for e in ENTITIES for n in range(2, len(e) + 1)}))  # at least two letters: R&B is whole
BROKEN = rf"\ufffd\s*$|&(?:#x?[0-9a-fA-F]{{0,6}}|(?:{_STARTS}))$"
UNFINISHED = r"(?:[(\[«,:+&/]|\s[-–—])\s*$"
TOKEN = r"([\p{L}\p{N}]+|\+)"
MARK_CHARS = 48  # in which a mark is looked for, from the last sign on
BLANKS = " \t\r\n\u00a0\u2003\u2007\u2009\u202f\u3000"  # that may follow it, in any number
SUPPORT = 5  # word pairs seen less often in different texts say nothing about how texts end
EVIDENCE = 9  # continuations from which an ending can be open
OPEN, CLOSED = 0.1, 0.3  # share of the occurrences that end a text: below it is open, from it on closed
LEAST_PAIR = 12  # occurrences from which the last two words are judged, else the last one is
SPIKE = 3  # a limit's length has so many times the mean of the ten lengths that lie 3 to 12 below it, and so many texts
PARTIAL = r"\ufffd+\s*$"  # left of a character that a cut by bytes went through
PARTIAL_BYTES = 3  # at most so many bytes of it stood below the limit, before it was replaced by a sign of 3 bytes
LIMIT_OPEN = 0.25  # share of open endings at a limit
STYLE_OPEN = 0.3  # of a source's dotted texts, for the dots to be its mark of cutting


def _shaped(df: DataFrame, row: str, source: str, text: str, completed: str | None) -> DataFrame:
    """Row keys, lengths, marks and words. Staged, so that each costly expression is evaluated once, and most of them
    only where a cheap test of the text's end allows a match."""
    raw, tail, stem = F.col("raw"), F.col("tail"), F.col("stem")
    marked = tail.contains("…") | tail.contains("..") | tail.contains("&") | tail.contains(">>") | tail.contains("»")
    explicit = F.regexp_extract(tail, EXPLICIT, 0)
    first = df.where(F.col(text).rlike(r"[\p{L}\p{N}+]")).select(
        F.col(row).alias("row"),
        F.col(source).alias("source"),
        F.col(text).alias("raw"),
        F.rtrim(F.col(text), F.lit(BLANKS)).alias("body"),
        (F.col(completed).isNotNull() if completed else F.lit(False)).alias("completed"),
    )
    first = first.withColumn("tail", F.right("body", F.lit(MARK_CHARS)))
    found = first.withColumn("_explicit", F.when(marked, F.nullif(explicit, F.lit("")))).withColumn("_dots", F.when(marked & F.col("_explicit").isNull(), F.nullif(F.regexp_extract(tail, DOTS, 0), F.lit(""))))
    cut = found.select(
        "row", "source", "raw", "tail", "completed",
        F.when(F.col("_explicit").isNotNull(), F.lit("explicit")).otherwise(F.coalesce(F.btrim("_dots"), F.lit(""))).alias("mark"),
        F.when(F.coalesce("_explicit", "_dots").isNull(), F.col("body")).otherwise(F.left("body", F.length("body") - F.length(F.coalesce("_explicit", "_dots")))).alias("stem"),
    )

    def opened(a: str, b: str) -> Column:
        return stem.contains(a) & (F.length(F.translate(stem, a, "")) < F.length(F.translate(stem, b, "")))

    broken = (tail.contains("\ufffd") | tail.contains("&")) & tail.rlike(BROKEN)
    tokens = F.regexp_extract_all(F.lower(canonical_form(stem)), F.lit(TOKEN), F.lit(1))
    partial = tail.contains("\ufffd") & tail.rlike(PARTIAL)
    return cut.select(
        "row", "source", "completed", "mark",
        F.length(raw).alias("chars"),
        F.octet_length(F.when(partial, F.regexp_replace(raw, PARTIAL, "")).otherwise(raw)).alias("bytes"),
        partial.alias("partial"),
        (broken | F.right(stem, F.lit(4)).rlike(UNFINISHED) | opened("(", ")") | opened("«", "»")).alias("unfinished"),
        tokens.alias("tokens"),
    ).withColumn("same", F.xxhash64("tokens"))


def _lengths(texts: DataFrame, *columns: str) -> DataFrame:
    """(*columns, unit, len, partial): the lengths of the unmarked texts; partial ones are less than their source's limit
    in bytes by up to PARTIAL_BYTES."""
    lengths = texts.where("mark = '' and not completed").select(*columns, "partial", F.explode(F.create_map(F.lit("chars"), "chars", F.lit("bytes"), "bytes")).alias("unit", "len"))
    return lengths.withColumn("partial", F.col("partial") & (F.col("unit") == "bytes"))


def _reaches(length: Column, limit: Column, partial: Column) -> Column:
    return (length == limit) | (partial & length.between(limit - PARTIAL_BYTES, limit))


def _at_limit() -> Column:
    """Whether a text joined to its source's limits stands at one."""
    none = F.lit(False)
    return F.coalesce(_reaches(F.col("chars"), F.col("limit_chars"), none), none) | F.coalesce(_reaches(F.col("bytes"), F.col("limit_bytes"), F.col("partial")), none)


def spikes(shaped: DataFrame) -> DataFrame:
    """(source, limit_chars, limit_bytes): where a source's histogram ends in a spike of different texts, by its lengths
    alone. Too wide for a verdict, it keeps a large source's cut texts out of the count of how texts end."""
    histogram = _lengths(shaped, "source", "same").groupBy("source", "unit", "len", "partial").agg(F.count(F.lit(1)).alias("n"), F.min("same").alias("least"), F.max("same").alias("most"))
    top = F.max("len").over(Window.partitionBy("source", "unit"))
    at_top = _reaches(F.col("len"), F.col("limit"), F.col("partial"))
    near = (F.col("len") >= F.col("limit") - 12) & (F.col("len") <= F.col("limit") - 3) & ~at_top
    different = F.min(F.when(at_top, F.col("least"))) != F.max(F.when(at_top, F.col("most")))
    return (
        histogram.withColumn("limit", top).groupBy("source", "unit", "limit")
        .agg(F.sum(F.when(at_top, F.col("n")).otherwise(0)).alias("n"), different.alias("different"), F.sum(F.when(near, F.col("n")).otherwise(0)).alias("below"))
        .where((F.col("n") >= SPIKE) & F.col("different") & (F.col("n") >= SPIKE * F.col("below") / 10))
        .groupBy("source").agg(F.max(F.when(F.col("unit") == "chars", F.col("limit"))).alias("limit_chars"), F.max(F.when(F.col("unit") == "bytes", F.col("limit"))).alias("limit_bytes"))
    )


def endings(shaped: DataFrame) -> DataFrame:
    """(before, word, ends, dotted, goes_on): over different texts, how often ``word`` (or a longer word that starts with
    it) after ``before`` goes on, how often the text ends with it, and how often with dots; ``before`` is null for any.
    Texts with an explicit mark, and those at a spike of their source, don't count as ends."""
    limit = small_side(spikes(shaped), "spikes")
    s = shaped.alias("s")
    cut = F.when((F.col("mark") == "explicit") | _at_limit(), 2).when(F.col("mark") != "", 1).otherwise(0)
    texts = s.join(limit.alias("l"), F.col("s.source").eqNullSafe(F.col("l.source")), "left").groupBy("tokens", cut.alias("cut")).agg(F.lit(1).alias("_one"))
    n = F.size("tokens")
    each = F.transform(
        "tokens",
        lambda w, i: F.struct(F.coalesce(F.get(F.col("tokens"), i - 1), F.lit("")).alias("before"), w.alias("word"), F.when(i == n - 1, F.col("cut")).alias("last")),
    )
    pairs = texts.select(F.explode(each).alias("t")).groupBy("t.before", "t.word", "t.last").agg(F.count(F.lit(1)).alias("n"))
    both = pairs.select(F.explode(F.array(F.col("before"), F.lit(None).cast("string"))).alias("before"), "word", "last", "n")
    counted = lambda hit: F.sum(F.when(hit, F.col("n")).otherwise(0))
    # Many a name follows one word once; only pairs with support go on to have their beginnings counted.
    whole = (
        both.groupBy("before", "word").agg(counted(F.col("last") == 0).alias("ends"), counted(F.col("last") == 1).alias("dotted"), counted(F.col("last").isNull()).alias("inner"), F.sum("n").alias("n"))
        .where(F.col("n") >= SUPPORT)
    )
    starts = F.transform(F.sequence(F.lit(1), F.length("word")), lambda k: F.struct(F.substring(F.col("word"), F.lit(1), k).alias("word"), (k == F.length("word")).alias("whole")))
    own = lambda c: F.sum(F.when(F.col("s.whole"), F.col(c)).otherwise(0))
    return (
        whole.select("before", F.explode(starts).alias("s"), "ends", "dotted", "inner", "n")
        .groupBy("before", "s.word")
        .agg(own("ends").alias("ends"), own("dotted").alias("dotted"), F.sum(F.when(F.col("s.whole"), F.col("inner")).otherwise(F.col("n"))).alias("goes_on"))
        .where(F.col("ends") + F.col("dotted") + F.col("goes_on") >= SUPPORT)
    )


def _judged(shaped: DataFrame) -> DataFrame:
    table = endings(shaped)
    n = F.size("tokens")
    tail = shaped.select(
        "row", "source", "chars", "bytes", "partial", "mark", "unfinished", "completed",
        "same",
        F.coalesce(F.get("tokens", n - 2), F.lit("")).alias("before"),
        F.get("tokens", n - 1).alias("word"),
    )
    pair = table.where("before is not null").select("before", "word", F.col("ends").alias("e2"), F.col("dotted").alias("d2"), F.col("goes_on").alias("m2"))
    single = table.where("before is null").select("word", F.col("ends").alias("e1"), F.col("goes_on").alias("m1"))
    joined = tail.join(pair, ["before", "word"], "left").join(single, "word", "left")

    def is_open(e: Column, m: Column) -> Column:
        return F.coalesce((m >= EVIDENCE) & (e < OPEN * (e + m)), F.lit(False))

    def is_closed(e: Column, m: Column) -> Column:
        return F.coalesce((e >= SUPPORT) & (e >= CLOSED * (e + m)), F.lit(False))

    e1, m1, e2, m2 = (F.col(c) for c in ("e1", "m1", "e2", "m2"))
    by_pair = F.coalesce(e2 + m2 >= LEAST_PAIR, F.lit(False))
    ending = (
        F.when(by_pair & is_open(e2, m2), "open").when(by_pair & is_closed(e2, m2), "closed")
        .when(is_open(e1, m1), "open").when(~by_pair & is_closed(e1, m1), "closed").otherwise("unknown")
    )
    formula = e2 + F.col("d2")
    always = F.coalesce((formula >= SUPPORT) & (m2 <= 0.02 * formula), F.lit(False))
    return joined.select("row", "source", "chars", "bytes", "partial", "mark", "unfinished", "completed", "same", ending.alias("ending"), always.alias("always"))


def limits(judged: DataFrame) -> DataFrame:
    """(source, unit, limit): the spike at the maximum of a source's length histogram, over its different texts. Partial
    ones are as good as open."""
    lengths = _lengths(judged, "source", "same", "ending")
    different = lengths.groupBy("source", "unit", "len", "partial", "same").agg(F.max((F.col("partial") | (F.col("ending") == "open")).cast("int")).alias("open"))
    histogram = different.groupBy("source", "unit", "len", "partial").agg(F.count(F.lit(1)).alias("n"), F.sum("open").alias("open"))
    top = F.max("len").over(Window.partitionBy("source", "unit"))
    at_top = _reaches(F.col("len"), F.col("limit"), F.col("partial"))
    near = (F.col("len") >= F.col("limit") - 12) & (F.col("len") <= F.col("limit") - 3) & ~at_top
    return (
        histogram.withColumn("limit", top).groupBy("source", "unit", "limit")
        .agg(
            F.sum(F.when(at_top, F.col("n")).otherwise(0)).alias("n"),
            F.sum(F.when(at_top, F.col("open")).otherwise(0)).alias("open"),
            F.sum(F.when(near, F.col("n")).otherwise(0)).alias("below"),
        )
        .where((F.col("n") >= SPIKE) & (F.col("n") >= SPIKE * F.col("below") / 10) & (F.col("open") >= LIMIT_OPEN * F.col("n")))
        .select("source", "unit", "limit")
    )


def cut_texts(df: DataFrame, row: str, source: str, text: str, completed: str | None = None) -> DataFrame:
    """(row, source, reason): every text with its reason for being cut, or a null reason.

    ``completed`` names a column that is set where the text was made whole afterwards (never cut). What a parser said of a
    text is disregarded. Null, blank and wordless texts have no row.
    A null source is a source. The judged rows are written once into the shared folder, as they are read three times.
    """
    judged = written(_judged(_shaped(df, row, source, text, completed)), "judged")
    limit = limits(judged).groupBy("source").agg(F.max(F.when(F.col("unit") == "chars", F.col("limit"))).alias("limit_chars"), F.max(F.when(F.col("unit") == "bytes", F.col("limit"))).alias("limit_bytes"))
    limit = small_side(limit, "limits")
    styles = (
        judged.where("mark not in ('', 'explicit') and not completed").groupBy("source", "mark")
        .agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("ending") == "open").cast("int")).alias("open"))
        .where((F.col("open") >= 2) & (F.col("open") >= STYLE_OPEN * F.col("n"))).select("source", "mark", F.lit(True).alias("style"))
    )
    styles = small_side(styles, "styles")
    j, at_limit = judged.alias("j"), _at_limit()
    rows = j.join(limit.alias("l"), F.col("j.source").eqNullSafe(F.col("l.source")), "left").join(
        styles.alias("s"), F.col("j.source").eqNullSafe(F.col("s.source")) & (F.col("j.mark") == F.col("s.mark")), "left"
    )
    mark, is_open = F.col("j.mark"), F.col("ending") == "open"
    reason = (
        F.when(F.col("completed"), F.lit(None).cast("string"))
        .when(mark == "explicit", "mark")
        .when((mark != "") & F.col("style").isNotNull() & ~F.col("always"), "mark")
        .when((mark != "") & (is_open | F.col("unfinished")), "mark")
        .when((mark == "") & F.col("unfinished"), "unfinished")
        .when((mark == "") & is_open & at_limit, "limit")
        .when((mark == "") & is_open, "transfer")
        .when((mark == "") & at_limit & (F.col("ending") == "unknown"), "limit")
    )
    return rows.select("row", F.col("j.source").alias("source"), reason.alias("reason"))


def by_source(cut: DataFrame) -> DataFrame:
    """How often each source cuts: (source, texts, cut, share)."""
    return cut.groupBy("source").agg(F.count(F.lit(1)).alias("texts"), F.count("reason").alias("cut")).withColumn("share", F.round(F.col("cut") / F.col("texts"), 6))
