"""The keyed state of published events and its merge with freshly extracted ones.

Tables: ``events`` (uid, source_url, start_date, end_date, image, image_source, first_seen, last_seen and any others),
``sources`` (source_url, uid: the uids a source is answerable for), ``missing`` (source_url, uid, n).
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MISSING_RUNS = 3  # runs without an event after which it is dropped
GUARD_LEAST = 5  # live events from which a source is guarded
GUARD_RATIO = 0.5  # share of them that a run must bring


def still_upcoming(today: Column) -> Column:
    """FL-8."""
    return F.coalesce("end_date", "start_date") >= today


@dataclass
class Merged:
    events: DataFrame
    sources: DataFrame
    missing: DataFrame
    alerts: DataFrame
    counts: DataFrame


def guard(events: DataFrame, sources: DataFrame, new: DataFrame, fetched: DataFrame, today: datetime.date) -> DataFrame:
    """Per fetched source: ``live`` (its upcoming events in the state), ``found`` and whether the run is ``guarded``."""
    live = sources.join(events.where(still_upcoming(F.lit(today))).select("uid"), "uid", "left_semi").groupBy("source_url").agg(F.countDistinct("uid").alias("live"))
    found = new.groupBy("source_url").agg(F.countDistinct("uid").alias("found"))
    both = fetched.select("source_url", "error").join(live, "source_url", "left").join(found, "source_url", "left").na.fill(0, ["live", "found"])
    fell = (F.col("live") >= GUARD_LEAST) & ((F.col("found") == 0) | (F.col("found") < F.col("live") * (1 - GUARD_RATIO)))
    return both.withColumn("guarded", F.col("error").isNull() & fell)


def merge_sources(events: DataFrame, sources: DataFrame, missing: DataFrame, new: DataFrame, fetched: DataFrame, today: datetime.date) -> Merged:
    """One run. ``fetched`` (source_url, rank, error): sources of this run; one with an error keeps all its events.

    Of several new rows of a uid the one of the source with the highest rank counts, then the largest ``pos`` (``new``
    needs ``pos``): sources are merged in that order and the last one owns the event. A refreshed event keeps
    first_seen, and its image while the source still points at the same picture or at none. Events that a source no
    longer brings are counted, and dropped at MISSING_RUNS; while the volume guard is on nothing is counted.
    """
    ok = fetched.where("error is null").select("source_url", "rank")
    usable = new.join(ok, "source_url")
    # The last writer of each uid.
    payload = [c for c in events.columns if c != "uid"]
    newest = usable.groupBy("uid").agg(F.max(F.struct("rank", "pos", F.struct(*[F.col(c) for c in payload]).alias("row"))).alias("_m")).select("uid", "_m.row.*")
    state = guard(events, sources, new, fetched, today)
    watched = sources.join(state.where("error is null").select("source_url", "guarded"), "source_url")
    brought = usable.select("source_url", "uid").distinct()
    absent = watched.join(brought, ["source_url", "uid"], "left_anti").join(events.select("uid"), "uid", "left_semi")
    counted = absent.where("not guarded").join(missing, ["source_url", "uid"], "left").select("source_url", "uid", (F.coalesce("n", F.lit(0)) + 1).alias("n"))
    dropped = counted.where(F.col("n") >= MISSING_RUNS)
    kept_counts = missing.join(brought, ["source_url", "uid"], "left_anti").join(counted, ["source_url", "uid"], "left_anti").select("source_url", "uid", "n")
    old = events.select("uid", *[F.col(c).alias(f"_old_{c}") for c in payload], F.lit(True).alias("_in_state"))
    fresh = newest.withColumn("_in_new", F.lit(True))
    joined = old.join(fresh, "uid", "full_outer")
    refreshed = F.col("_in_new").isNotNull()
    source_image = F.coalesce("image_source", F.col("_old_image_source"))
    special = {
        "first_seen": F.coalesce("_old_first_seen", "first_seen"),
        "last_seen": F.lit(today),
        "image_source": F.when(F.col("_in_state").isNotNull(), source_image).otherwise(F.col("image_source")),
        "image": F.when(F.col("_in_state").isNotNull() & source_image.eqNullSafe(F.col("_old_image_source")), F.col("_old_image")).otherwise(F.col("image")),
    }
    columns = [F.when(refreshed, special.get(c, F.col(c))).otherwise(F.col(f"_old_{c}")).alias(c) for c in payload]
    # A dropped event that another source brought in the same run stays.
    merged = joined.join(dropped.select("uid", F.lit(True).alias("_gone")).distinct(), "uid", "left").where(F.col("_gone").isNull() | refreshed).select("uid", *columns)
    good = ok.select("source_url")
    answerable = merged.select("source_url", "uid").join(good, "source_url", "left_semi").unionByName(sources.join(good, "source_url", "left_anti").select("source_url", "uid"))
    alerts = state.where("error is not null or guarded").select(
        "source_url",
        F.when(F.col("error").isNotNull(), "error").otherwise("warning").alias("level"),
        F.when(F.col("error").isNotNull(), F.concat(F.lit("source failed, last verified state kept: "), F.col("error")))
        .otherwise(F.format_string("event count dropped from %d to %d; previous events kept", "live", "found")).alias("message"),
    )
    still = counted.where(F.col("n") < MISSING_RUNS).unionByName(kept_counts).join(merged.select("uid"), "uid", "left_semi").select("source_url", "uid", "n")
    return Merged(merged, answerable, still, alerts, state.where("error is null").select("source_url", F.col("found").alias("event_count")))


def expire(events: DataFrame, today: datetime.date) -> tuple[DataFrame, DataFrame]:
    """ST-5: (still upcoming, past)."""
    keep = F.coalesce(still_upcoming(F.lit(today)), F.lit(True))
    return events.where(keep), events.where(~keep)


def forget(events: DataFrame, venue_id: str, kinds: list[str] | None = None) -> DataFrame:
    """ST-5: without a venue's events, or those of some source kinds alone."""
    own = (F.col("venue_id") == venue_id) & (F.col("source_kind").isin(kinds) if kinds is not None else F.lit(True))
    return events.where(~F.coalesce(own, F.lit(False)))


def without_orphans(bookkeeping: DataFrame, events: DataFrame) -> DataFrame:
    """Rows of ``sources`` or ``missing`` whose event is still in the state."""
    return bookkeeping.join(events.select("uid"), "uid", "left_semi")


def stalest_first(sources: DataFrame, checked: str, budget: int) -> DataFrame:
    """ST-8: a source's place in the queue (never checked first, then by address), and whether the budget reaches it. Sources
    are counted by day of their last check; a place is the days before plus the place within the day, so that the only
    window over everything has a row for each day."""
    by_day = sources.groupBy(F.col(checked).alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    order = Window.orderBy(F.col("_day").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_day.withColumn("_before", F.coalesce(F.sum("_n").over(order), F.lit(0)))
    within = F.row_number().over(Window.partitionBy(checked).orderBy("source_url"))
    ranked = sources.withColumn("_place", within).join(offsets, F.col(checked).eqNullSafe(F.col("_day")))
    return ranked.select(*sources.columns, (F.col("_place") + F.col("_before")).cast("int").alias("place")).withColumn("deferred", F.col("place") > budget)
