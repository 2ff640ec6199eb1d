"""Publication: one entry for each real-world event, across sources.

Folding is greedy and depends on the order, so a group is folded in one place; all its predicates need the same
venue and intervals that share a day. Groups are therefore islands of overlapping intervals within a venue, not
whole venues, and inside a group candidates are found by first and last day.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.text import overlap, title_tokens

# The preference among kinds of sources.
SOURCE_RANK = {"json": 0, "html": 1, "facebook": 2, "instagram": 3}
_FOLDED = ["uid", "folded_into", "image_from"]
STRICT, LOOSE = 0.75, 0.5  # token overlap; the loose one where both clock times agree


def islands(df: DataFrame) -> DataFrame:
    """``df`` with ``island``: the first day of its group of intervals of a venue that share days.

    No window runs over a venue, which may hold a third of all rows: its rows are reduced to one row for each first day with
    the latest last day (partial aggregation), the days are walked in order, and the groups' first days are joined back
    by venue and day."""
    last = F.coalesce("end_date", "start_date")
    days = df.groupBy(F.col("venue_id").alias("_v"), F.col("start_date").alias("_d")).agg(F.max(last).alias("_last"))
    by_venue = Window.partitionBy("_v").orderBy("_d")
    before = F.max("_last").over(by_venue.rowsBetween(Window.unboundedPreceding, -1))
    first = F.when(F.coalesce(F.col("_d") > before, F.lit(True)), F.col("_d"))
    numbered = days.select("_v", "_d", first.alias("_first")).withColumn("island", F.max("_first").over(by_venue)).drop("_first")
    return df.join(numbered, F.col("venue_id").eqNullSafe(F.col("_v")) & (F.col("start_date") == F.col("_d"))).select(*df.columns, "island")


def _similar(a: frozenset, b: frozenset, least: float) -> bool:
    return bool(a) and bool(b) and len(a & b) / min(len(a), len(b)) >= least


def fold_sorted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows that come sorted by venue and island, folded island by island: (uid, folded_into, image_from). No more than a
    batch and the island that goes on from it are held."""
    held: list[dict] = []
    last: tuple | None = None
    for batch in batches:
        out = []
        for r in batch.to_dict("records"):
            if held and (r["venue_id"], r["island"]) != last:
                out += fold_island(held)
                held = []
            last = (r["venue_id"], r["island"])
            held.append(r)
        yield pd.DataFrame(out, columns=_FOLDED)
    yield pd.DataFrame(fold_island(held), columns=_FOLDED)


def fold_island(items: list[dict]) -> list[tuple[str, str | None, str | None]]:
    """items: uid, source_kind, source_url, start_date, end_date, start_min, venue_name, title, image_source, tokens.
    Gives uid, folded_into (null if kept) and image_from (the uid whose picture a kept row takes over)."""
    for r in items:
        r["t"] = frozenset(r["tokens"])
        r["timed"] = None if pd.isna(r["start_min"]) else int(r["start_min"])
        r["range"] = not pd.isna(r["end_date"]) and r["end_date"] > r["start_date"]
        r["into"], r["picture"] = None, None if pd.isna(r["image_source"]) or not r["image_source"] else r["uid"]
    items.sort(key=lambda r: (SOURCE_RANK.get(r["source_kind"], 9), r["start_date"], r["timed"] or 0, r["venue_name"] or "", r["title"] or "", r["uid"]))
    kept: list[dict] = []
    by_start: dict = defaultdict(list)
    by_end: dict = defaultdict(list)

    def same_event(a: dict, b: dict) -> bool:
        if a["source_url"] == b["source_url"] and a["source_kind"] == "html":
            return False
        both = a["timed"] is not None and b["timed"] is not None
        return not (both and a["timed"] != b["timed"]) and _similar(a["t"], b["t"], LOOSE if both else STRICT)

    def same_run(a: dict, b: dict) -> bool:
        return a["t"] == b["t"] if a["source_url"] == b["source_url"] else _similar(a["t"], b["t"], STRICT)

    def give(winner: dict, loser: dict) -> None:
        loser["into"] = winner["uid"]
        if winner["picture"] is None and loser["picture"] is not None:
            winner["picture"] = loser["picture"]

    for r in items:
        found = next((k for k in by_start[r["start_date"]] if same_event(r, kept[k])), None)
        if r["range"]:
            run = next((k for k in by_end[r["end_date"]] if same_run(r, kept[k])), None)
            found = run if found is None else found if run is None else min(found, run)
        if found is not None:
            give(kept[found], r)
            continue
        by_start[r["start_date"]].append(len(kept))
        if r["range"]:
            by_end[r["end_date"]].append(len(kept))
        kept.append(r)
    by_token: dict[str, list[int]] = defaultdict(list)
    for i, k in enumerate(kept):
        for t in k["t"] if k["range"] else ():
            by_token[t].append(i)
    for r in kept:
        if not r["range"]:
            # A similar title shares a word, so only ranges with one of its words are looked at, in their order.
            ranges = (kept[i] for i in sorted({i for t in r["t"] for i in by_token.get(t, ())}))
            cover = next((k for k in ranges if k["start_date"] <= r["start_date"] <= k["end_date"] and _similar(r["t"], k["t"], STRICT)), None)
            if cover:
                give(cover, r)
    return [(r["uid"], r["into"], r["picture"] if r["into"] is None and r["picture"] != r["uid"] else None) for r in items]


def published(df: DataFrame) -> DataFrame:
    """(uid, folded_into, image_from) of every event; published are those with a null ``folded_into``. ``uid`` must be
    unique; rows without venue are one venue's, rows without a start date are left out."""
    needed = islands(df.where("start_date is not null").withColumn("tokens", title_tokens(F.col("title"))))
    columns = ["venue_id", "island", "uid", "source_kind", "source_url", "start_date", "end_date", "start_min", "venue_name", "title", "image_source", "tokens"]
    placed = needed.select(*columns).repartition("venue_id", "island").sortWithinPartitions("venue_id", "island")
    return placed.mapInPandas(fold_sorted, "uid string, folded_into string, image_from string")


def in_order(df: DataFrame) -> DataFrame:
    """TK-1."""
    return df.orderBy("start_date", F.coalesce("start_min", F.lit(0)), "venue_name", "title")


def counts_by_venue(venues: DataFrame, events: DataFrame) -> DataFrame:
    """AG-3, JN-3: every venue with the number of its events, 0 included. Events are counted before the join."""
    counted = events.groupBy(F.col("venue_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return venues.join(counted, "id", "left").select("id", "name", F.coalesce("n", F.lit(0)).cast("bigint").alias("event_count"))


def covered_by_ranges(singles: DataFrame, ranges: DataFrame) -> DataFrame:
    """JN-8: (uid, range_uid) of single days inside a range of the same venue with a similar title; of several ranges the
    first by start and uid. Ranges are spread over the months they touch, so the join has an equality on (venue, month)."""
    month = lambda c: F.year(c) * 12 + F.month(c)
    wide = ranges.where("end_date > start_date").select(
        F.col("venue_id").alias("rv"), F.col("uid").alias("range_uid"), F.col("start_date").alias("rs"), F.col("end_date").alias("re"), title_tokens(F.col("title")).alias("rt"),
        F.explode(F.sequence(month(F.col("start_date")), month(F.col("end_date")))).alias("rm"),
    )
    single = singles.where("end_date is null or end_date <= start_date").select("uid", "venue_id", "start_date", title_tokens(F.col("title")).alias("t"), month(F.col("start_date")).alias("m"))
    hit = (F.col("venue_id") == F.col("rv")) & (F.col("m") == F.col("rm")) & F.col("start_date").between(F.col("rs"), F.col("re"))
    return single.join(wide, hit).where(overlap(F.col("t"), F.col("rt")) >= STRICT).groupBy("uid").agg(F.min(F.struct("rs", "range_uid")).alias("b")).select("uid", "b.range_uid")
