"""Published artefacts: lines of an iCalendar, the events as JSON, the run's report."""

from __future__ import annotations

import datetime
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.publish import counts_by_venue

ZONE = "Europe/Paris"
OCTETS = 75


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in (";", ","):
        out = F.replace(out, F.lit(c), F.lit(f"\\{c}"))
    return F.regexp_replace(out, r"\r?\n", r"\\n")


def folded(line: Column) -> Column:
    """A content line cut at OCTETS octets without breaking a character; what follows starts with a blank."""

    def step(state: Column, c: Column) -> Column:
        n = F.octet_length(c)
        wraps = state["used"] + n > OCTETS
        return F.struct(F.when(wraps, F.concat(state["text"], F.lit("\r\n "), c)).otherwise(F.concat(state["text"], c)).alias("text"), F.when(wraps, n + 1).otherwise(state["used"] + n).alias("used"))

    long = F.aggregate(F.split(line, ""), F.struct(F.lit("").alias("text"), F.lit(0).alias("used")), step, lambda s: s["text"])
    return F.when(F.octet_length(line) <= OCTETS, line).otherwise(long)


def ics_lines(events: DataFrame) -> DataFrame:
    """SNK-2: (uid, start_date, vevent): each event's lines, joined by CRLF. Timed events last two hours unless they say
    otherwise; others, and recurring ones, are whole days whose end is the day after the last."""
    day = lambda d: F.date_format(d, "yyyyMMdd")
    clock = lambda d, m: F.concat(day(F.date_add(d, F.floor(m / 1440).cast("int"))), F.lit("T"), F.lpad(F.floor((m % 1440) / 60).cast("string"), 2, "0"), F.lpad((m % 60).cast("string"), 2, "0"), F.lit("00"))
    timed = F.col("start_min").isNotNull() & ~F.coalesce("recurring", F.lit(False))
    last = F.coalesce("end_date", "start_date")
    end_min = F.coalesce("end_min", F.col("start_min") + 120)
    # An end before the start on the same day is after midnight.
    end_min = F.when((last == F.col("start_date")) & (end_min <= F.col("start_min")), end_min + 1440).otherwise(end_min)
    place = F.concat_ws(" - ", "venue_name", F.when(F.col("location_name") != F.col("venue_name"), F.col("location_name")))
    about = F.array_join(F.filter(F.array("summary", F.concat(F.lit("Prix : "), F.col("price")), F.col("url")), lambda x: x.isNotNull() & (x != "")), "\n")
    lines = F.array_compact(
        F.array(
            F.lit("BEGIN:VEVENT"),
            folded(F.concat(F.lit("SUMMARY:"), escaped(F.col("title")))),
            F.when(timed, F.concat(F.lit(f"DTSTART;TZID={ZONE}:"), clock(F.col("start_date"), F.col("start_min")))).otherwise(F.concat(F.lit("DTSTART;VALUE=DATE:"), day(F.col("start_date")))),
            F.when(timed, F.concat(F.lit(f"DTEND;TZID={ZONE}:"), clock(last, end_min))).otherwise(F.concat(F.lit("DTEND;VALUE=DATE:"), day(F.date_add(last, 1)))),
            F.concat(F.lit("UID:"), F.col("uid")),
            F.when(F.col("category").isNotNull(), F.concat(F.lit("CATEGORIES:"), escaped(F.col("category")))),
            F.when(about != "", folded(F.concat(F.lit("DESCRIPTION:"), escaped(about)))),
            F.when(place != "", folded(F.concat(F.lit("LOCATION:"), escaped(place)))),
            F.when(F.col("status") == "cancelled", F.lit("STATUS:CANCELLED")),
            F.when(F.col("url").isNotNull(), folded(F.concat(F.lit("URL:"), F.col("url")))),
            F.lit("END:VEVENT"),
        )
    )
    return events.select("uid", "start_date", F.array_join(lines, "\r\n").alias("vevent"))


def _write_lines(lines: DataFrame, path: str, separator: str) -> None:
    """One file of lines in the order of ``_at``, as a file that others load can't be in parts. The lines are sorted by
    ranges, which one writer takes up in turn."""
    lines.orderBy("_at").select("line").coalesce(1).write.option("lineSep", separator).text(path)


def _numbered(rows: DataFrame, *order: Column) -> DataFrame:
    return rows.select(F.struct(F.lit(1).alias("part"), *[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("_at"), "line")


def _around(rows: DataFrame, head: str, foot: str) -> DataFrame:
    """The rows between a first and a last line."""
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema["_at"].dataType.fields[1:]]
    frame = lambda part, line: rows.sparkSession.range(1).select(F.struct(F.lit(part).alias("part"), *none).alias("_at"), F.lit(line).alias("line"))
    return rows.unionByName(frame(0, head)).unionByName(frame(2, foot))


def write_ics(events: DataFrame, path: str) -> None:
    """SNK-2: one calendar that programs can load, in a single file under ``path``."""
    body = _numbered(ics_lines(events).withColumnRenamed("vevent", "line"), F.col("start_date"), F.col("uid"))
    _write_lines(_around(body, "BEGIN:VCALENDAR\r\nVERSION:2.0\r\nPRODID:-//cadenza//agenda//FR", "END:VCALENDAR"), path, "\r\n")


def event_json(events: DataFrame) -> DataFrame:
    """A line of JSON per event, in publication order."""
    return events.orderBy("start_date", F.coalesce("start_min", F.lit(0)), "venue_name", "title").select(F.to_json(F.struct(*events.columns)).alias("line"))


def venue_json(venues: DataFrame, events: DataFrame) -> DataFrame:
    """Venues with the number of their events; ``venues`` may have any further columns."""
    rest = [c for c in venues.columns if c not in ("id", "name")]
    counted = counts_by_venue(venues, events).select("id", "name", "event_count").join(venues.select("id", *rest), "id")
    return counted.select("id", F.to_json(F.struct("id", "name", *rest, "event_count")).alias("line"))


def write_events_json(venues: DataFrame, events: DataFrame, today: datetime.date, generated_at: str, path: str) -> None:
    """SNK-1: one JSON document with ``generated_at``, ``today``, ``venues`` (with their counts) and ``events`` in publication
    order, a record a line, in a single file under ``path``."""
    keys = [F.col("start_date"), F.coalesce("start_min", F.lit(0)), F.col("venue_name"), F.col("title"), F.to_json(F.struct(*events.columns))]
    places = venue_json(venues, events).select(F.struct(F.lit(1).alias("part"), F.col("id").alias("key")).alias("_at"), "line")
    dated = events.select(F.row_number().over(Window.partitionBy("start_date").orderBy(*keys)).alias("_n"), "start_date", F.to_json(F.struct(*events.columns)).alias("line"))
    listed = dated.select(F.struct(F.lit(3).alias("part"), F.concat_ws("/", F.coalesce(F.col("start_date").cast("string"), F.lit("")), F.lpad(F.col("_n").cast("string"), 12, "0")).alias("key")).alias("_at"), "line")
    spark = events.sparkSession
    fixed = lambda part, line: spark.range(1).select(F.struct(F.lit(part).alias("part"), F.lit("").alias("key")).alias("_at"), F.lit(line).alias("line"))
    # A comma stands before every record but the first of its list.
    commas = lambda rows: rows.join(rows.agg(F.min("_at").alias("_first")), F.col("_at") == F.col("_first"), "left").select("_at", F.concat(F.when(F.col("_first").isNull(), ",").otherwise(""), "line").alias("line"))
    head = f'{{"generated_at": {json.dumps(generated_at)}, "today": "{today}", "venues": ['
    parts = [fixed(0, head), commas(places), fixed(2, '], "events": ['), commas(listed), fixed(4, "]}")]
    _write_lines(reduce(DataFrame.unionByName, parts), path, "\n")


def run_report(rows: DataFrame, today: datetime.date, before: DataFrame | None = None) -> DataFrame:
    """SNK-3, AG-1, AG-2: one row of counters over the state's rows. New are the uids that the state ``before`` the run lacks
    (all, where there was none)."""
    upcoming = F.coalesce("end_date", "start_date") >= F.lit(today)
    known = before.select("uid").distinct().withColumn("_known", F.lit(True)) if before is not None else None
    marked = rows.join(known, "uid", "left") if known is not None else rows.withColumn("_known", F.lit(None).cast("boolean"))
    return marked.agg(
        F.count(F.lit(1)).alias("events"), F.count(F.when(upcoming, 1)).alias("events_upcoming"), F.countDistinct(F.when(F.col("_known").isNull(), F.col("uid"))).alias("events_new"),
        F.countDistinct("source_url").alias("sources"), F.countDistinct("venue_id").alias("venues"), F.count(F.when(F.col("verifier") == "accept", 1)).alias("verified"),
        F.count(F.when(F.col("title_truncated"), 1)).alias("titles_truncated"), F.count("image").alias("images"),
    )


def exit_status(sources_total: int, sources_ok: int) -> int:
    """SNK-6: 1 where sources were asked and none answered, else 0."""
    return int(sources_total > 0 and sources_ok == 0)
