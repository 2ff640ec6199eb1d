"""Cut titles made whole from detail pages, and the state of cached pictures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.text import extends_prefix, host
from cadenza.html.ops import titles_column

FETCHES = 20  # detail pages looked at for one venue in a run


def complete_titles(events: DataFrame, known: DataFrame, pages: DataFrame) -> DataFrame:
    """``events`` (uid, venue_id, source_url, url, title, title_truncated, pos) with ``title`` and ``title_completed_from``.

    An answer that the state already has (``known``: uid, title, title_completed_from) comes first. Otherwise the page of
    the event's own address is asked, if it lies on the host of the event's source; of each venue the first FETCHES
    different addresses in the order of ``pos`` count. The first candidate of a page that goes on where the cut title
    ends is taken. Each page is parsed once. The uid stays as it is.
    """
    answers = known.where("title_completed_from is not null").select("uid", F.col("title").alias("_known"), F.col("title_completed_from").alias("_from"))
    joined = events.join(answers, "uid", "left")
    asking = joined.where(F.coalesce("title_truncated", F.lit(False)) & F.col("_known").isNull() & (host(F.col("url")) == host(F.col("source_url"))))
    first = asking.groupBy("venue_id", "url").agg(F.min("pos").alias("pos"))
    turn = F.row_number().over(Window.partitionBy("venue_id").orderBy("pos", "url"))
    wanted = first.withColumn("_turn", turn).where(F.col("_turn") <= FETCHES).select("venue_id", "url")
    read = pages.join(wanted.select("url").distinct(), "url", "left_semi").select("url", titles_column(F.col("html")).alias("_titles"))
    candidates = asking.join(wanted, ["venue_id", "url"], "left_semi").select("uid", "url", "title").join(read, "url").select("uid", "url", "title", F.posexplode("_titles").alias("_n", "_candidate"))
    best = candidates.where(extends_prefix(F.col("_candidate"), F.col("title"))).groupBy("uid").agg(F.min(F.struct("_n", "_candidate", "url")).alias("_b")).select("uid", F.col("_b._candidate").alias("_whole"), F.col("_b.url").alias("_page"))
    rest = [c for c in events.columns if c not in ("title", "title_completed_from")]
    completed = joined.join(best, "uid", "left")
    return completed.select(*rest, F.coalesce("_known", "_whole", "title").alias("title"), F.coalesce("_from", "_page").alias("title_completed_from"))


def completion_counts(events: DataFrame) -> DataFrame:
    """AG-9."""
    cut = F.coalesce("title_truncated", F.lit(False))
    return events.agg(F.count(F.when(cut, 1)).alias("truncated"), F.count(F.when(cut & F.col("title_completed_from").isNotNull(), 1)).alias("completed"), F.count(F.when(cut & F.col("url").isNull(), 1)).alias("without_page"))


def failure_counts(failures: DataFrame) -> DataFrame:
    """AG-8: (host, reason, n), most frequent first; a reason is the text before its colon."""
    return failures.groupBy(host(F.col("url")).alias("host"), F.substring_index("error", ":", 1).alias("reason")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "host", "reason")


def image_state(events: DataFrame, cached: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ST-11, JN-5: (pictures that events show and the cache lacks, cached files that no event shows)."""
    shown = events.where("image_source is not null").select(F.col("image_source").alias("url")).distinct()
    return shown.join(cached, "url", "left_anti"), cached.join(shown, "url", "left_anti")
