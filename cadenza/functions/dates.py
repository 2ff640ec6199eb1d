"""Dates and times written in French, English months, and machine notation.

A folded text is first reduced to its shape: numbers, months and weekdays become one letter each, and all else stays as it
is written. ``NOTATIONS`` are small expressions over shapes; the first notation whose shape occurs decides, and its
values are read by their place among the text's numbers and month names. Errors are data. The result is struct(start,
end, start_min, end_min, year_inferred, weekday, error); times are minutes of the day.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadenza.functions.text import let, strip_accents

WEEKDAYS = ("lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi", "dimanche")
# The names by which a month is written, accents taken off.
MONTHS = (
    ("janvier", "janv", "jan", "january"),
    ("fevrier", "fev", "feb", "february"),
    ("mars", "mar", "march"),
    ("avril", "avr", "apr", "april"),
    ("mai", "may"),
    ("juin", "jun", "june"),
    ("juillet", "juil", "jul", "july"),
    ("aout", "aug", "august"),
    ("septembre", "sept", "sep", "september"),
    ("octobre", "oct", "october"),
    ("novembre", "nov", "november"),
    ("decembre", "dec", "december"),
)


def _month_words() -> dict[str, int]:
    """Every accepted spelling; a French name of six letters or more may be broken off after its fourth."""
    words = {n: i for i, names in enumerate(MONTHS, 1) for n in names}
    for i, (name, *_) in enumerate(MONTHS, 1):
        if len(name) > 5:
            words |= {name[:k]: i for k in range(4, len(name))}
    return words


MONTH_WORDS = _month_words()
MONTH_WORD = rf"\b(?:{'|'.join(sorted(MONTH_WORDS))})\b"
WEEKDAY_WORD = rf"\b(?:{'|'.join(WEEKDAYS)})\b"

#: Replaced one after another: W a weekday, M a month, C a day in eight digits, Y four digits, D two, S one, N any others.
#: Folded texts have no capital letters of their own.
SHAPE = (
    (WEEKDAY_WORD, "W"), (MONTH_WORD, "M"), (r"(?<!\d)20\d{6}(?!\d)", "C"), (r"(?<!\d)\d{4}(?!\d)", "Y"), (r"(?<!\d)\d\d(?!\d)", "D"), (r"(?<!\d)\d(?!\d)", "S"), (r"\d+", "N"),
)
NUMBERS = "CYDSN"
_DAY, _MONTH_YEAR = "[DS](?:er)?", r"M(?:\.? Y)?"
#: In the order in which they are looked for.
NOTATIONS = {
    "iso": r"\bY-D-D(?:[t ][DS]:D)?",
    "compact": r"\bC\b",
    "numeric": r"\b[DS]/[DS]/[YD]\b",
    "span": rf"\bdu {_DAY}(?: M\.?)?(?: Y)? au {_DAY} {_MONTH_YEAR}",
    "pair": rf"\b{_DAY} ?(?:[-–/&]|et) ?{_DAY} {_MONTH_YEAR}",
    "single": rf"(?:\bW\.? )?\b{_DAY} {_MONTH_YEAR}",
}
#: A valid clock time: 20h, 20h30, 20 heures, 20:30.
CLOCK = r"(?<![\p{L}\d_])(?:[01]?\d|2[0-3])\s*(?:h(?:eures?)?|:)\s*(?:[0-5]\d)?(?!\d)"

_RESULT = "struct<start:date,end:date,start_min:int,end_min:int,year_inferred:boolean,weekday:string,error:string>"


def fold(text: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(strip_accents(text), r"(?U)\s+", " ")))


def shape(folded: Column) -> Column:
    for pattern, letter in SHAPE:
        folded = F.regexp_replace(folded, pattern, letter)
    return folded


def month_number(word: Column) -> Column:
    out = F.lit(None).cast("int")
    for i in range(12, 0, -1):
        out = F.when(word.isin([w for w, m in MONTH_WORDS.items() if m == i]), F.lit(i)).otherwise(out)
    return out


def day(y: Column, m: Column, d: Column) -> Column:
    """The date, or null where the calendar has none."""
    return F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0")).try_cast("date")


def times_of(text: Column) -> Column:
    """Every valid clock time in the text, as minutes of the day."""

    def minutes(clock: Column) -> Column:
        return let(F.split(clock, "[^0-9]+"), lambda p: F.get(p, F.lit(0)).cast("int") * 60 + F.coalesce(F.nullif(F.get(p, F.lit(1)), F.lit("")).cast("int"), F.lit(0)))

    return F.transform(F.regexp_extract_all(text, F.lit(CLOCK), F.lit(0)), minutes)


def parse_times(text: Column) -> Column:
    """FN-9: struct(start_min, end_min) of the first two clock times; the letter h in lower case."""
    return let(times_of(text), lambda t: F.struct(F.get(t, F.lit(0)).alias("start_min"), F.get(t, F.lit(1)).alias("end_min")))


def weekday_of(d: Column) -> Column:
    return F.get(F.array(*[F.lit(w) for w in WEEKDAYS]), F.weekday(d))


def infer_year(month: Column, dom: Column, today: Column, weekday: Column) -> Column:
    """FN-11: of last, this and next year's such days (on the weekday, if one is named) the first from today, else the
    last; null if there is none."""
    years = F.array(*[F.year(today) + k for k in (-1, 0, 1)])
    dated = F.filter(F.transform(years, lambda y: day(y, month, dom)), lambda d: d.isNotNull() & (weekday.isNull() | (weekday == "") | (weekday_of(d) == weekday)))
    return let(dated, lambda ds: F.coalesce(F.array_min(F.filter(ds, lambda d: d >= today)), F.array_max(ds)))


def _made(start: Column, end: Column, a: Column, b: Column, inferred: Column, weekday: Column, error: Column) -> Column:
    return F.struct(
        start.cast("date").alias("start"), end.cast("date").alias("end"), a.cast("int").alias("start_min"), b.cast("int").alias("end_min"),
        inferred.cast("boolean").alias("year_inferred"), weekday.cast("string").alias("weekday"), error.cast("string").alias("error"),
    )


def _occurrence(c: Column, name: str) -> Column:
    """Where the notation first occurs in the shape: its letters, its numbers and months as written, its own weekday; null
    where it doesn't."""
    pattern = NOTATIONS[name]
    at = F.regexp_instr(c["shape"], F.lit(pattern))

    def read(x: Column) -> Column:
        letters = lambda text, kinds: F.length(F.regexp_replace(text, f"[^{kinds}]", ""))
        part = lambda array, kinds: F.slice(array, letters(x["before"], kinds) + 1, letters(x["match"], kinds))
        return F.struct(
            F.split(F.regexp_replace(x["match"], f"[^{NUMBERS}]", ""), "").alias("kinds"), part(c["numbers"], NUMBERS).alias("numbers"),
            part(c["months"], "M").alias("months"), F.get(part(c["weekdays"], "W"), F.lit(0)).alias("weekday"),
        )

    return F.when(at > 0, let(F.struct(F.left(c["shape"], at - 1).alias("before"), F.regexp_extract(c["shape"], pattern, 0).alias("match")), read))


def parse_date(text: Column, today: Column | datetime.date, folded: bool = False) -> Column:
    """FN-10. ``folded`` texts have been through ``fold`` already (needed inside lambdas, where no Python can run). Null,
    blank and dateless texts give an error. A date that the calendar lacks lets the next notation try in ISO, compact and
    numeric notation, and is an error in the others. Month names are whole words."""
    now = F.lit(today) if isinstance(today, datetime.date) else today
    no = F.lit(None)
    error = lambda why: _made(no, no, no, no, no, no, F.lit(why))

    def body(c: Column) -> Column:
        times, named = c["times"], F.get(c["weekdays"], F.lit(0))
        first, second = F.get(times, F.lit(0)), F.get(times, F.lit(1))

        def number(x: Column, i: int) -> Column:
            return F.get(x["numbers"], F.lit(i)).try_cast("int")

        def certain(d: Column) -> Column:
            return F.when(d.isNotNull(), _made(d, no, first, second, F.lit(False), named, no))

        def iso(x: Column) -> Column:
            def timed(d: Column) -> Column:
                clock = F.when(number(x, 3).between(0, 23) & number(x, 4).between(0, 59), number(x, 3) * 60 + number(x, 4))
                others = F.filter(F.slice(times, 1, 2), lambda t: t != clock)
                # Midnight is how machines write a day without a time.
                from_clock = F.when(clock > 0, F.array(clock)).otherwise(F.array().cast("array<int>"))
                both = F.concat(from_clock, others)
                return F.when(clock.isNull(), error("invalid time")).otherwise(_made(d, no, F.get(both, F.lit(0)), F.get(both, F.lit(1)), F.lit(False), named, no))

            return let(day(number(x, 0), number(x, 1), number(x, 2)), lambda d: F.when(F.size(x["numbers"]) == 3, certain(d)).when(d.isNotNull(), timed(d)))

        def compact(x: Column) -> Column:
            n = F.get(x["numbers"], F.lit(0))
            return certain(day(n.substr(1, 4), n.substr(5, 2), n.substr(7, 2)))

        def numeric(x: Column) -> Column:
            y = number(x, 2)
            return certain(day(F.when(y < 100, y + 2000).otherwise(y), number(x, 1), number(x, 0)))

        def worded(x: Column) -> Column:
            """Days, months and years apart, each in order: a span, a pair or a single day."""
            pairs = F.arrays_zip(x["kinds"].alias("k"), x["numbers"].alias("n"))
            of = lambda year: F.transform(F.filter(pairs, lambda p: (p["k"] == "Y") == F.lit(year)), lambda p: p["n"].cast("int"))
            months = F.transform(x["months"], month_number)
            return let(F.struct(of(False).alias("days"), of(True).alias("years"), months.alias("months"), x["weekday"].alias("own")), dated)

        def dated(v: Column) -> Column:
            last_day, last_month, y = F.element_at(v["days"], -1), F.element_at(v["months"], -1), F.try_element_at(v["years"], F.lit(-1))
            several = F.size(v["days"]) > 1
            weekday = F.when(~several, F.coalesce(v["own"], F.when(y.isNull(), named)))
            end = F.when(y.isNull(), infer_year(last_month, last_day, now, weekday)).otherwise(day(y, last_month, last_day))

            def one(d: Column) -> Column:
                wrong = y.isNotNull() & (weekday_of(d) != weekday)
                return (
                    F.when(d.isNull(), F.when(y.isNull(), error("no such date")).otherwise(error("invalid date")))
                    .when(wrong, error("weekday mismatch")).otherwise(_made(d, no, first, second, y.isNull(), weekday, no))
                )

            def span(d: Column) -> Column:
                month = F.get(v["months"], F.lit(0))
                begin = day(F.year(d) - (month > last_month).cast("int"), month, F.get(v["days"], F.lit(0)))
                return let(begin, lambda s: F.when(s.isNull() | d.isNull(), error("invalid range")).otherwise(_made(s, d, first, second, y.isNull(), named, no)))

            return let(end, lambda d: F.when(several, span(d)).otherwise(one(d)))

        readers: dict[str, Callable[[Column], Column]] = {"iso": iso, "compact": compact, "numeric": numeric}
        if_there = lambda read: lambda x: F.when(x.isNotNull(), read(x))
        machine = [let(_occurrence(c, n), if_there(read)) for n, read in readers.items()]
        written = F.coalesce(*[_occurrence(c, n) for n in NOTATIONS if n not in readers])
        return F.coalesce(F.when(c["shape"] == "", error("empty date text")), *machine, let(written, if_there(worded)), error("no date found"))

    def context(t: Column) -> Column:
        every = lambda pattern: F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        return F.struct(shape(t).alias("shape"), every(r"\d+").alias("numbers"), every(MONTH_WORD).alias("months"), every(WEEKDAY_WORD).alias("weekdays"), times_of(t).alias("times"))

    plain_text = F.coalesce(text, F.lit(""))
    return let(plain_text if folded else fold(plain_text), lambda t: let(context(t), body)).cast(_RESULT)


_SHAPE = [(re.compile(p, re.A), letter) for p, letter in SHAPE]
_NOTATIONS = {n: re.compile(p, re.A) for n, p in NOTATIONS.items()}


def _calendar_day(y: int, m: int, d: int) -> datetime.date | None:
    try:
        return datetime.date(y, m, d)
    except ValueError:
        return None


def first_day(folded: str, today: datetime.date) -> datetime.date | None:
    """The first day of a folded text as ``parse_date`` reads it, for code that walks trees outside Spark."""
    letters = folded
    for pattern, letter in _SHAPE:
        letters = pattern.sub(letter, letters)
    words = {"N": re.findall(r"[0-9]+", folded), "M": re.findall(MONTH_WORD, folded, re.A), "W": re.findall(WEEKDAY_WORD, folded, re.A)}

    def read(m: re.Match, kinds: str, of: str) -> list[str]:
        at = sum(c in kinds for c in letters[: m.start()])
        return words[of][at : at + sum(c in kinds for c in m[0])]

    for name, notation in _NOTATIONS.items():
        if not (m := notation.search(letters)):
            continue
        numbers = read(m, NUMBERS, "N")
        if name in ("iso", "compact", "numeric"):
            a, b, c = (int(numbers[0][k]) for k in (slice(4), slice(4, 6), slice(6, 8))) if name == "compact" else map(int, numbers[:3])
            found = _calendar_day(a, b, c) if name != "numeric" else _calendar_day(c + 2000 * (c < 100), b, a)
            if found:
                return found
            continue
        kinds = [c for c in m[0] if c in NUMBERS]
        days = [int(n) for n, k in zip(numbers, kinds, strict=True) if k != "Y"]
        years = [int(n) for n, k in zip(numbers, kinds, strict=True) if k == "Y"]
        months = [MONTH_WORDS[w] for w in read(m, "M", "M")]
        weekday = next(iter(read(m, "W", "W") or ([] if years else words["W"])), None) if len(days) == 1 else None
        candidates = years[-1:] or [today.year - 1, today.year, today.year + 1]
        ends = [e for y in candidates if (e := _calendar_day(y, months[-1], days[-1])) and weekday in (None, WEEKDAYS[e.weekday()])]
        end = min((e for e in ends if e >= today), default=max(ends, default=None))
        return end if len(days) == 1 or end is None else _calendar_day(end.year - (months[0] > months[-1]), months[0], days[0])
    return None


# The strptime directives that have a pattern letter.
_DIRECTIVES = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%y": "yy", "%b": "MMM", "%B": "MMMM", "%I": "hh", "%p": "a"}


def parse_date_format(text: Column, fmt: str) -> Column:
    """A value in a strptime format. No match is final."""
    pattern, i = "", 0
    while i < len(fmt):
        if fmt[i : i + 2] in _DIRECTIVES:
            pattern, i = pattern + _DIRECTIVES[fmt[i : i + 2]], i + 2
        elif fmt[i] == "%":
            raise ValueError(f"unknown directive {fmt[i : i + 2]}")
        else:
            pattern, i = pattern + (f"'{fmt[i]}'" if fmt[i].isalpha() else fmt[i]), i + 1
    clock = any(d in fmt for d in ("%H", "%I", "%M"))
    no = F.lit(None)

    def body(at: Column) -> Column:
        minutes = F.hour(at) * 60 + F.minute(at) if clock else no
        return F.when(at.isNull(), _made(no, no, no, no, no, no, F.lit("format mismatch"))).otherwise(_made(F.to_date(at), no, minutes, no, F.lit(False), no, no))

    return let(F.try_to_timestamp(F.trim(text), F.lit(pattern)), body).cast(_RESULT)
