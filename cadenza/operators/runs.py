"""Daily repetitions as date ranges. Rows need ``start_date``, ``end_date``, ``start_min`` and a
position column that orders equal rows; ``keys`` say which rows are the same entry (source, title key, url)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_RUN = 3  # rows that make a run
MAX_CLOSED = 2  # days without an entry that don't break one


def _last(row: str = "") -> Column:
    return F.coalesce(F.col(f"{row}end_date"), F.col(f"{row}start_date"))


def mark_runs(df: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    """``df`` with ``run`` (its number within the key) and ``run_rows``. A run breaks where a row starts more than
    MAX_CLOSED + 1 days after the last day of the row before it. Rows without a start date are alone in a run."""
    dated = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    order = Window.partitionBy(*names).orderBy(F.col("start_date"), F.coalesce("start_min", F.lit(0)), F.col(pos))
    fresh = F.coalesce(F.datediff("start_date", F.lag(_last()).over(order)) > MAX_CLOSED + 1, F.lit(True))
    numbered = df.select("*", *dated).withColumn("_new", fresh.cast("int")).withColumn("run", F.sum("_new").over(order))
    return numbered.withColumn("run_rows", F.count(F.lit(1)).over(Window.partitionBy(*names, "run"))).drop("_new")


def collapse_runs(df: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    """ST-1/2: a run of MIN_RUN rows or more becomes its first row with the run's last day as ``end_date``; shorter
    runs stay as they are. ``folded_rows`` says how many rows a row stands for."""
    marked = mark_runs(df, keys, pos)
    names = [f"_k{i}" for i in range(len(keys))]
    run = Window.partitionBy(*names, "run").orderBy("start_date", F.coalesce("start_min", F.lit(0)), F.col(pos))
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    long = F.col("run_rows") >= MIN_RUN
    return (
        marked.withColumn("_place", F.row_number().over(run)).withColumn("_end", F.max(_last()).over(whole))
        .where(~long | (F.col("_place") == 1))
        .withColumn("end_date", F.when(long, F.col("_end")).otherwise(F.col("end_date")))
        .withColumn("folded_rows", F.when(long, F.col("run_rows")).otherwise(F.lit(1).cast("bigint")))
        .drop("_place", "_end", "run", "run_rows", *names)
    )


def continue_runs(df: DataFrame, known: DataFrame, keys: Sequence[str], pos: str, uid: str = "uid") -> DataFrame:
    """ST-3: a row that starts inside a known range of its key (or up to MAX_CLOSED + 1 days after it) takes the first
    day of the earliest such range; several rows of one range become the first of them with the latest last day.

    ``known`` has the keys, ``uid``, ``start_date`` and ``end_date``; only rows that end after they start are ranges.
    The ranges of one key don't overlap when they come out of ``collapse_runs``, so a row meets few of them.
    """
    ranges = known.where("end_date > start_date").select(*[F.col(k).alias(f"_q{i}") for i, k in enumerate(keys)], F.col(uid).alias("_uid"), F.col("start_date").alias("_from"), F.col("end_date").alias("_to"))
    same = [F.coalesce(F.col(k), F.lit("")) == F.coalesce(F.col(f"_q{i}"), F.lit("")) for i, k in enumerate(keys)]
    inside = (F.col("start_date") > F.col("_from")) & (F.col("start_date") <= F.date_add("_to", MAX_CLOSED + 1))
    condition = inside
    for s in same:
        condition = condition & s
    hit = df.join(ranges, condition).groupBy(F.col(pos).alias("_pos")).agg(F.min(F.struct("_from", "_uid")).alias("_hit"))
    joined = df.join(hit, F.col(pos) == F.col("_pos"), "left").withColumn("_run", F.coalesce(F.concat(F.lit("run:"), F.col("_hit._uid").cast("string")), F.concat(F.lit("row:"), F.col(pos).cast("string"))))
    by_run = Window.partitionBy("_run").orderBy(pos)
    end = F.max(_last()).over(by_run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    continued = F.col("_hit").isNotNull()
    return (
        joined.withColumn("_end", end).withColumn("_place", F.row_number().over(by_run)).where("_place = 1")
        .withColumn("start_date", F.when(continued, F.col("_hit._from")).otherwise(F.col("start_date")))
        .withColumn("end_date", F.when(continued, F.col("_end")).otherwise(F.col("end_date")))
        .withColumn("continued_uid", F.col("_hit._uid"))
        .select(*df.columns, "continued_uid")
    )


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """EX-1, TK-5: the first row of each key. One aggregate with partial combining instead of a window, so that a hot
    key's rows are reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.struct(*rest).alias("_row"))).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best._row.*").select(*df.columns)
