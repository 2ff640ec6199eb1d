"""Addresses found in a site's scripts, and JSON cut down to its shape."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROUTE = r"[\"'`(]((?:https?://[\w.-]+)?/[\w./-]*(?:api|v\d|wp-json|agenda|events?|evenements?|programme|seances?)[\w./-]*)"
EVENTFUL = r"(?i)agenda|event|evenement|programme|seance|session"
MOST = 30


def collect_routes(scripts: DataFrame, most: int = MOST, pattern: str = ROUTE) -> DataFrame:
    """``scripts`` (site, pos, code): (site, route, first_pos, eventful, place) of each site's different routes, those that
    look like events first, then in order of appearance; ``most`` is the report's length. Routes are made distinct
    with partial aggregation before they are ranked."""
    found = scripts.select("site", "pos", F.posexplode(F.regexp_extract_all("code", F.lit(pattern), F.lit(1))).alias("_i", "route"))
    first = found.groupBy("site", "route").agg(F.min(F.struct("pos", "_i")).alias("_f")).select("site", "route", F.col("_f.pos").alias("first_pos"), F.col("_f._i").alias("_i"), F.col("route").rlike(EVENTFUL).alias("eventful"))
    place = F.row_number().over(Window.partitionBy("site").orderBy(F.desc("eventful"), "first_pos", "_i", "route"))
    return first.withColumn("place", place).where(F.col("place") <= most).drop("_i")


def with_prefixes(routes: DataFrame, prefixes: list[str], most: int = 12) -> DataFrame:
    """JN-10: every relative route alone and behind each prefix, as a list inside the row, without a join."""
    variants = F.array("route", *[F.concat(F.lit(p.rstrip("/")), F.col("route")) for p in prefixes])
    each = routes.select("site", "place", F.posexplode(F.when(F.col("route").startswith("/"), variants).otherwise(F.array("route"))).alias("_n", "candidate"))
    n = F.row_number().over(Window.partitionBy("site").orderBy("place", "_n"))
    return each.withColumn("turn", n).where(F.col("turn") <= most).select("site", "candidate", "turn")


def sample_json(value: Any, items: int = 2, depth: int = 3, chars: int = 160) -> Any:
    """DOC-4: the value's shape: the first elements of lists, texts clipped, and a mark for what lies deeper."""
    if isinstance(value, str):
        return value if len(value) <= chars else value[:chars] + "…"
    if isinstance(value, (dict, list)) and depth == 0:
        return "{…}" if isinstance(value, dict) else "[…]"
    if isinstance(value, dict):
        return {k: sample_json(v, items, depth - 1, chars) for k, v in value.items()}
    if isinstance(value, list):
        rest = [f"… {len(value) - items} more"] if len(value) > items else []
        return [sample_json(v, items, depth - 1, chars) for v in value[:items]] + rest
    return value


def trimmed_json(text: str, most: int) -> str:
    """DOC-4: JSON with as many list elements as fit ``most`` characters; cut hard where not even one does."""
    value = json.loads(text)
    for n in (8, 6, 4, 3, 2, 1):
        if len(out := json.dumps(sample_json(value, n, 99, 200), ensure_ascii=False)) <= most:
            return out
    return out[:most]
