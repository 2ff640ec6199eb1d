"""Instants written in many notations, as microseconds since 1970-01-01T00:00:00Z.

A value is reduced to a mask of character classes (``9999-n-nan:n:n.fa`` for an ISO instant). Every mask is mapped once,
in ``PARSERS``, to the places its year, month, day, time and zone stand at among the value's numbers and words; the
fields are then read by these places inside the JVM. Local times go through versioned zone transition tables in Arrow
batches (``functions.zones``).
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions import zones

# Month names and their short forms in French and English, accents taken off.
MONTHS = {
    1: ("janvier", "janv", "jan", "january"),
    2: ("fevrier", "fevr", "fev", "feb", "february"),
    3: ("mars", "mar", "march"),
    4: ("avril", "avr", "apr", "april"),
    5: ("mai", "may"),
    6: ("juin", "jun", "june"),
    7: ("juillet", "juil", "jul", "july"),
    8: ("aout", "aou", "aug", "august"),
    9: ("septembre", "sept", "sep", "september"),
    10: ("octobre", "oct", "october"),
    11: ("novembre", "nov", "november"),
    12: ("decembre", "dec", "december"),
}
# Minutes east of UTC of zone abbreviations.
ABBREVIATIONS = {
    "z": 0, "ut": 0, "utc": 0, "gmt": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120, "mez": 60, "mesz": 120, "eet": 120, "eest": 180, "msk": 180,
    "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
}


def _spec(kind: str, mask: str, order: str, *, month_word: int = -1, ampm: int = -1, zone: int = -1, offset: bool = False) -> tuple[str, tuple]:
    """order names the value's numbers from the left: y, m, d, H, M, S, f; anything else is passed over."""
    places = {c: i for i, c in enumerate(order) if c in "ymdHMSf"}
    return mask, (kind, *(places.get(c, -1) for c in "ymdHMSf"), month_word, ampm, zone, offset)


def _parsers() -> dict[str, tuple]:
    made: list[tuple[str, tuple]] = []
    for width, kind in ((10, "s"), (13, "ms"), (16, "us")):
        made.append(_spec(f"epoch_{kind}", "9" * width, ""))
    offsets = [s + o for s in "+-" for o in ("n", "n:n", "9999")]
    times = (("n:n", "HM"), ("n:n:n", "HMS"), ("n:n:n.f", "HMSf"))
    # 2026-08-14T12:38:40.862Z, 2026-08-14 12:38, 2026-08-14 12:38:40 CEST, 2026-08-14T12:38:40+02:00
    for sep, (glue, words), (time, order) in itertools.product("-/.", (("a", 1), (" ", 0)), times):
        base = f"9999{sep}n{sep}n{glue}{time}"
        made.append(_spec("plain", base, "ymd" + order))
        for gap in ("", " "):
            made.append(_spec("plain", f"{base}{gap}a", "ymd" + order, zone=words))
            made += [_spec("plain", f"{base}{gap}{o}", "ymd" + order, offset=True) for o in offsets]
            made += [_spec("plain", f"{base}{gap}a{o}", "ymd" + order, offset=True) for o in offsets]
    # 20260814T123840Z
    for tail, zone in (("", -1), ("a", 1)):
        made += [_spec("compact", f"{'9' * 8}a{'9' * 6}{tail}", "", zone=zone), _spec("compact", f"{'9' * 8}a9999{tail}", "", zone=zone)]
    made += [_spec("compact", f"{'9' * 8}a{'9' * 6}{o}", "", offset=True) for o in offsets]
    # 14/08/2026 12:38, 14.08.2026 à 12h38, 17/06/2025 01:00 - 03:00: the day stands before the month
    for sep, (time, order), tail in itertools.product("/.-", (*times, ("nan", "HM")), ("", " - n:n", " – n:n", " - nan")):
        for glue in (" ", " a ", ", "):
            base, hour_word = f"n{sep}n{sep}9999{glue}{time}", (glue == " a ") + (time == "nan")
            made.append(_spec("plain", base + tail, "dmy" + order))
            if not tail:
                made.append(_spec("plain", base + " a", "dmy" + order, zone=hour_word))
                made += [_spec("plain", base + g + o, "dmy" + order, offset=True) for o in offsets for g in ("", " ", " a")]
    # Thu, 12 Feb 2026 14:17:00 GMT; Wed, 11 Mar 2026, 18:45 CET
    for day, comma, (time, order) in itertools.product((("a, ", 1), ("a ", 1), ("", 0)), (" ", ", "), times[:2]):
        base = f"{day[0]}n a 9999{comma}{time}"
        made += [_spec("plain", base, "dy" + order, month_word=day[1]), _spec("plain", base + " a", "dy" + order, month_word=day[1], zone=day[1] + 1)]
        made += [_spec("plain", base + g + o, "dy" + order, month_word=day[1], offset=True) for o in offsets for g in ("", " ", " a")]
    # Jun 11, 2025, 1:41 PM; July 29, 2026 · 1:00 AM; Friday, May 23, 2025 at 2:00 PM UTC+1
    for day, glue in itertools.product((("a, ", 1), ("", 0)), (", ", " · ", " a ", " ")):
        base, mw = f"{day[0]}a n, 9999{glue}n:n", day[1]
        half = mw + 1 + (glue == " a ")
        for gap in (" ", ""):
            made += [_spec("plain", f"{base}{gap}a", "dyHM", month_word=mw, ampm=half), _spec("plain", f"{base}{gap}a a", "dyHM", month_word=mw, ampm=half, zone=half + 1)]
            made += [_spec("plain", f"{base}{gap}a{g}{o}", "dyHM", month_word=mw, ampm=half, offset=True) for o in offsets for g in (" a", " ")]
    # 25 août 2026 à 19h54; Vendredi 26 décembre 2025 de 17:30 à 18:30 UTC+1; sam. 20 févr. 2027 à 2 h 00
    for day, (time, hour_words) in itertools.product((("", 0), ("a ", 1), ("a, ", 1)), (("n:n", 0), ("nan", 1), ("n a n", 1), ("na", 1), ("n a", 1))):
        base, mw, order = f"{day[0]}n a 9999 a {time}", day[1], "dyH" if time in ("na", "n a") else "dyHM"
        last = mw + 1 + hour_words
        for end, words in (("", 0), (f" a {time}", 1 + hour_words), (f" - {time}", hour_words), (f" – {time}", hour_words)):
            made.append(_spec("plain", base + end, order, month_word=mw))
            made.append(_spec("plain", f"{base}{end} a", order, month_word=mw, zone=last + words + 1))
            made += [_spec("plain", base + end + g + o, order, month_word=mw, offset=True) for o in offsets for g in (" a", " ")]
    # Du 14 septembre 2025 à 21h15 au 14 septembre 2025 à 23h45
    for time, other in itertools.product(("nan", "n:n", "n a n"), repeat=2):
        made.append(_spec("plain", f"a n a 9999 a {time} a n a 9999 a {other}", "dyHM", month_word=1))
    # Mercredi 17 septembre à 18h30: the year is the receiving day's or the next
    for day, time, end in itertools.product((("", 0), ("a ", 1), ("a, ", 1)), ("nan", "n:n", "n a n"), ("", " a nan", " a n:n", " - n:n")):
        base = f"{day[0]}n a a {time}{end}"
        made.append(_spec("yearless", base, "dHM", month_word=day[1]))
        made += [_spec("yearless", f"{base} a{o}", "dHM", month_word=day[1], offset=True) for o in offsets]
    # Jun 28 at 3:30 AM – Jun 30 at 11:59 PM UTC+2; Tue, Jun 17 at 1:00 AM
    for day, end in itertools.product((("", 0), ("a, ", 1)), ("", " – a n a n:n a", " - a n a n:n a", " – n:n a", " - n:n a")):
        base, mw = f"{day[0]}a n a n:n a{end}", day[1]
        made.append(_spec("yearless", base, "dHM", month_word=mw, ampm=mw + 2))
        made.append(_spec("yearless", f"{base} a", "dHM", month_word=mw, ampm=mw + 2, zone=mw + 3 + end.count("a")))
        made += [_spec("yearless", f"{base} a{o}", "dHM", month_word=mw, ampm=mw + 2, offset=True) for o in offsets]
    table: dict[str, tuple] = {}
    for mask, spec in made:
        table.setdefault(mask, spec)
    return table


#: Of each mask: kind, places of y m d H M S f among the numbers, of month, am/pm and zone among the words, offset at the end.
PARSERS = _parsers()

_ACCENTED, _PLAIN = "àâäéèêëîïôöùûüç", "aaaeeeeiioouuuc"


def _clean(value: Column) -> Column:
    text = F.regexp_replace(F.translate(F.lower(value), _ACCENTED, _PLAIN), r"[\s   ]+", " ")
    text = F.regexp_replace(text, r"\b1er\b", "1")
    return F.trim(F.regexp_replace(text, r"\b([ap])\.?\s?m\.?(?=$|[^\p{L}])", "$1m"))


def shape_mask(cleaned: Column) -> Column:
    """Words as ``a``, one or two digits as ``n``, other numbers as so many nines, fractions of a second as ``f``."""
    mask = F.regexp_replace(cleaned, r"\p{L}+\.?", "a")
    mask = F.regexp_replace(mask, r"[0-9]", "9")
    mask = F.regexp_replace(mask, r"(?<!9)99?(?!9)", "n")
    return F.regexp_replace(mask, r"(:n)[.,](?:9+|n)", "$1.f")


def _lookup(key: Column, choices: dict) -> Column:
    """A literal table as one membership test per distinct result."""
    grouped = defaultdict(list)
    for k, v in choices.items():
        if v is not None:
            grouped[v].append(k)
    out = None
    for v, keys in grouped.items():
        hit = key.isin(keys)
        out = F.when(hit, F.lit(v)) if out is None else out.when(hit, F.lit(v))
    return F.lit(None).cast("int") if out is None else out


def _zoned() -> Callable:
    known = zones.tables()

    @F.pandas_udf("bigint")
    def local_to_utc(own: pd.Series, local_us: pd.Series, zone: pd.Series) -> pd.Series:
        at = local_us.to_numpy(dtype="float64", na_value=np.nan)
        ok, values = ~np.isnan(at), local_us.fillna(0).to_numpy(dtype="int64")
        out, valid = np.zeros(len(values), np.int64), np.zeros(len(values), bool)
        codes, names = pd.factorize(zone.fillna("UTC"))
        for i, name in enumerate(names):
            here = ok & (codes == i)
            if (utc := zones.to_utc(values[here], name, known)) is not None:
                out[here], valid[here] = utc, True
        return own.astype("Int64").fillna(pd.Series(pd.array(out, dtype="Int64")).mask(~valid))

    return local_to_utc.asNondeterministic()  # else a filter on the result is rewritten into the whole parsing, many times over


def instants(df: DataFrame, value: str, zone: str, received: str, out: str = "utc_us") -> DataFrame:
    """``df`` with ``out``: the instant as UTC microseconds, null where the value denotes none.

    Without zone of its own a value is local time in ``zone`` (an IANA name; null is UTC, an unknown name gives null):
    the earlier instant of a repeated time, the offset before the jump for a skipped one. Numeric dates have the day
    first unless the year comes first. Without a year the first such date on or after the UTC day of ``received`` is
    meant (null without it). Of a span the start counts. Null, empty, unreadable and impossible values, and dates
    without a time of day, give null.
    """
    fields = ("kind", "y", "m", "d", "H", "M", "S", "f", "mw", "ap", "zw", "off")
    raw, zone_name, received_at = F.col("raw"), F.col("zone"), F.col("received")
    rest = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != out])  # apart, so that no name clashes
    step = df.select(rest.alias("rest"), F.col(value).alias("raw"), F.col(zone).alias("zone"), F.col(received).alias("received"))
    step = step.withColumn("_v", _clean(raw))
    # Texts without a digit are not tokenised.
    step = step.withColumn("_mask", shape_mask(F.when(F.col("_v").rlike("[0-9]"), F.col("_v")))).withColumn("_spec", F.expr(_SPEC_OF_MASK))
    step = step.withColumn("_n", F.when(F.col("_spec").isNotNull(), F.regexp_extract_all(F.col("_v"), F.lit("([0-9]+)"), F.lit(1))))
    step = step.withColumn("_w", F.when(F.col("_spec").isNotNull(), F.regexp_extract_all(F.col("_v"), F.lit(r"(\p{L}+)"), F.lit(1))))

    def part(name: str) -> Column:
        return F.expr(f"get({_literal_array(fields.index(name))}, _spec)")

    def number(name: str) -> Column:
        return F.get(F.col("_n"), part(name)).try_cast("bigint")

    def word(name: str) -> Column:
        return F.get(F.col("_w"), part(name))

    kind = F.coalesce(part("kind"), F.lit("none"))
    first = F.get(F.col("_n"), F.lit(0))
    compact = kind == "compact"
    second = F.get(F.col("_n"), F.lit(1))
    months = _lookup(word("mw"), {name: m for m, names in MONTHS.items() for name in names})
    has_month_word = part("mw").isNotNull()
    digits = lambda text, at, n: text.substr(at, n).try_cast("bigint")
    step = step.select(
        "*",
        kind.alias("_kind"),
        F.when(compact, digits(first, 1, 4)).otherwise(number("y")).alias("_y"),
        F.when(compact, digits(first, 5, 2)).when(has_month_word, months).otherwise(number("m")).alias("_mo"),
        F.when(compact, digits(first, 7, 2)).otherwise(number("d")).alias("_d"),
        F.when(compact, digits(second, 1, 2)).otherwise(number("H")).alias("_h"),
        F.when(compact, digits(second, 3, 2)).when(part("M").isNull(), F.lit(0)).otherwise(number("M")).alias("_mi"),
        F.when(compact & (F.length(second) == 6), digits(second, 5, 2)).when(compact | part("S").isNull(), F.lit(0)).otherwise(number("S")).alias("_s"),
        F.when(part("f").isNull(), F.lit(0)).otherwise(F.rpad(F.get(F.col("_n"), part("f")).substr(1, 6), 6, "0").try_cast("bigint")).alias("_us"),
        F.when(part("ap").isNotNull(), F.coalesce(word("ap"), F.lit("?"))).alias("_ampm"),
        F.when(part("zw").isNotNull(), F.coalesce(word("zw"), F.lit("?"))).alias("_zone_word"),
        F.when(F.coalesce(part("off"), F.lit(False)), F.regexp_extract(F.col("_v"), r"([+-][0-9]{1,4}(?::[0-9]{2})?)$", 1)).alias("_off"),
    )
    hour = (
        F.when(F.col("_ampm").isNull(), F.col("_h"))
        .when(F.col("_ampm").isin("am", "pm") & F.col("_h").between(1, 12), F.col("_h") % 12 + F.when(F.col("_ampm") == "pm", 12).otherwise(0))
    )
    received_day = F.floor(F.unix_micros(received_at) / F.lit(86_400_000_000)).cast("int")
    day_of = lambda y, mo, d: F.unix_date(F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(mo.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0")).try_cast("date"))
    year0 = F.year(F.date_from_unix_date(received_day))
    upcoming = F.array_min(F.filter(F.transform(F.sequence(year0, year0 + 8), lambda y: day_of(y, F.col("_mo"), F.col("_d"))), lambda x: x >= received_day))
    day = F.when(F.col("_kind") == "yearless", upcoming).when(F.col("_kind") != "none", day_of(F.col("_y"), F.col("_mo"), F.col("_d")))
    off, sign = F.col("_off"), F.when(F.col("_off").startswith("-"), -1).otherwise(1)
    off_digits = F.regexp_replace(off, "[^0-9]", "")
    off_h = F.when(F.length(off_digits) <= 2, off_digits).otherwise(off_digits.substr(F.lit(1), F.length(off_digits) - 2)).try_cast("int")
    off_m = F.when(F.length(off_digits) <= 2, F.lit(0)).otherwise(F.right(off_digits, F.lit(2)).try_cast("int"))
    minutes = (
        F.when(off.isNotNull(), F.when((off_h <= 18) & (off_m <= 59), sign * (off_h * 60 + off_m)))
        .when(F.col("_zone_word").isNotNull(), _lookup(F.col("_zone_word"), ABBREVIATIONS))
    )
    has_zone = off.isNotNull() | F.col("_zone_word").isNotNull()
    valid = hour.between(0, 23) & F.col("_mi").between(0, 59) & F.col("_s").between(0, 59)
    local = F.when(valid, day.cast("bigint") * 86_400_000_000 + hour * 3_600_000_000 + F.col("_mi") * 60_000_000 + F.col("_s") * 1_000_000 + F.col("_us"))
    epoch = F.when(F.col("_kind") == "epoch_s", first.try_cast("bigint") * 1_000_000).when(F.col("_kind") == "epoch_ms", first.try_cast("bigint") * 1000).when(F.col("_kind") == "epoch_us", first.try_cast("bigint"))
    step = step.withColumn("_local", local).withColumn("_minutes", minutes).withColumn("_own", has_zone)
    own = F.coalesce(epoch, F.when(F.col("_own"), F.col("_local") - F.col("_minutes").cast("bigint") * 60_000_000))
    return step.select("rest.*", _zoned()(own, F.when(~F.col("_own"), F.col("_local")), zone_name).alias(out))


def _sql(v: object) -> str:
    return "null" if v == -1 and v is not False else f"'{v}'" if isinstance(v, str) else str(v).lower()


def _literal_array(i: int) -> str:
    """The i-th part of every parser, by the parser's number."""
    return f"array({', '.join(_sql(s[i]) for s in _SPEC_IDS)})"


_SPEC_IDS = {spec: i for i, spec in enumerate(dict.fromkeys(PARSERS.values()))}
_MASKS_OF = {i: [m for m, s in PARSERS.items() if _SPEC_IDS[s] == i] for i in _SPEC_IDS.values()}
#: The table as SQL text, which is parsed at once: a test of membership per parser.
_SPEC_OF_MASK = "case " + " ".join(f"when _mask in ({', '.join(map(_sql, masks))}) then {i}" for i, masks in _MASKS_OF.items()) + " end"
