"""Queries of the general data problems: p2 snapshots, p5 deliveries, p6 timestamps, p7 nested records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators import delivery, nested, snapshots, timestamps
from cadenza.tables import load

SNAPSHOT_FIELDS = ("venue_id", "title", "start_date", "start_min", "end_date", "location_name", "price", "status")
MESSAGES = (("instagram_posts", "id"), ("facebook_posts", "postId"), ("facebook_events", "id"))
INSTANTS = (("instagram_posts", "timestamp"), ("facebook_posts", "time"), ("facebook_events", "utcStartDate"), ("facebook_events", "dateTimeSentence"))
LEAVES = ("ticketsInfo.buyUrl", "location.name", "childPosts.displayUrl", "photo_image.uri")
NESTED = (("facebook_events", ("location", "ticketsInfo", "childEvents")), ("instagram_posts", ("childPosts",)), ("facebook_posts", ("media",)))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def p2_changes(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.snapshot_changes(load(spark, d, "event_snapshots"), "snapshot_no", "uid", "loaded_at", SNAPSHOT_FIELDS)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_changes(spark, d).select("snapshot_no", "uid", "change_kind")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _union([delivery.surplus_rows(load(spark, d, t), c, "received_at", "row_id").select(F.lit(t).alias("table_name"), "message_id", "row_id") for t, c in MESSAGES])


def p5_ranges(spark: SparkSession, d: str) -> DataFrame:
    return _union([delivery.seen_ranges(load(spark, d, t), c, "received_at", "row_id").select(F.lit(t).alias("table_name"), "producer", "lo", "hi", "n") for t, c in MESSAGES])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    parts = []
    for t, c in INSTANTS:
        found = timestamps.instants(load(spark, d, t).select("row_id", c, "feed_zone", "received_at"), c, "feed_zone", "received_at").where("utc_us is not null")
        parts.append(found.select(F.lit(t).alias("table_name"), F.lit(c).alias("field_name"), "row_id", "utc_us"))
    return _union(parts)


def _flat(spark: SparkSession, d: str) -> list[tuple[str, DataFrame]]:
    parts = [(t, nested.flatten_columns(load(spark, d, t), "row_id", columns)) for t, columns in NESTED]
    return [*parts, ("raw_items", nested.flatten_json(load(spark, d, "raw_items").where("kind <> 'event' or kind is null"), "raw_id", "payload"))]


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    found = [nested.leaves(flat, LEAVES).select(F.lit(t).alias("table_name"), "row_id", "field_path", "positions", "leaf_value") for t, flat in _flat(spark, d)]
    # An image's uri counts only where the image belongs to a medium.
    return _union(found).where("field_path not like '%photo_image.uri' or field_path = 'media.photo_image.uri' or field_path like '%.media.photo_image.uri'")


def p7_tickets(spark: SparkSession, d: str) -> DataFrame:
    return _union([nested.flat_table(flat, "ticketsInfo", "buyUrl string, price string, title string").select(F.lit(t).alias("table_name"), "*") for t, flat in _flat(spark, d)])


QUERIES = {"p2_found": p2_found, "p2_changes": p2_changes, "p5_found": p5_found, "p5_ranges": p5_ranges, "p6_found": p6_found, "p7_found": p7_found, "p7_tickets": p7_tickets}

_LATEST = f"""
latest as (select snapshot_no, uid, {", ".join(SNAPSHOT_FIELDS)} from event_snapshots where uid is not null and snapshot_no is not null
           qualify row_number() over (partition by snapshot_no, uid order by loaded_at desc nulls last, {", ".join(f"{c} desc nulls last" for c in SNAPSHOT_FIELDS)}) = 1),
bounds as (select min(snapshot_no) lo, max(snapshot_no) hi from latest),
pairs as (select coalesce(b.snapshot_no, a.snapshot_no + 1) snapshot_no, coalesce(b.uid, a.uid) uid,
          case when a.uid is null then 'added' when b.uid is null then 'removed'
               when {" or ".join(f"a.{c} is distinct from b.{c}" for c in SNAPSHOT_FIELDS)} then 'changed' end change_kind,
          {", ".join(f"case when a.{c} is distinct from b.{c} then '{c}' end f{i}" for i, c in enumerate(SNAPSHOT_FIELDS))}
          from latest a full join latest b on a.uid = b.uid and b.snapshot_no = a.snapshot_no + 1)"""
_PAIRS = "from pairs, bounds where change_kind is not null and snapshot_no > lo and snapshot_no <= hi"
_FIRST = """select '{t}' table_name, "{c}" message_id, row_id from {t} where "{c}" is not null
            qualify row_number() over (partition by "{c}" order by received_at nulls last, row_id) > 1"""
_RANGES = """select '{t}' table_name, producer, min(n) lo, max(n) hi, count(*) n from (
  select producer, n, n - row_number() over (partition by producer, n >> 16 order by n) island, n >> 16 block from (
    select distinct length("{c}") || ':' || substr("{c}", 1, 4) producer, cast(substr("{c}", 5) as bigint) n from {t} where regexp_full_match("{c}", '[0-9]{{5,22}}')))
  group by producer, block, island"""

_TREES = " union all ".join(
    [f"select '{t}' table_name, row_id, to_json({{{', '.join(f'{chr(39)}{c}{chr(39)}: {c}' for c in columns)}}}) j from {t}" for t, columns in NESTED]
    + ["select 'raw_items', raw_id, cast(case when json_valid(payload) then payload end as json) from raw_items where kind <> 'event' or kind is null"]
)
_LEAVES = rf"""select table_name, row_id, trim(regexp_replace(regexp_replace(fullkey, '\[[0-9]+\]', '', 'g'), '^\$\.?', ''), '.') field_path,
  array_to_string(regexp_extract_all(fullkey, '\[([0-9]+)\]', 1), '.') positions, atom ->> '$' leaf_value
  from (select s.table_name, s.row_id, t.fullkey, t.atom from ({_TREES}) s, json_tree(s.j) t where t.atom is not null)
  where regexp_matches(regexp_replace(fullkey, '\[[0-9]+\]', '', 'g'), '\.(ticketsInfo\.buyUrl|location\.name|childPosts\.displayUrl|media\.photo_image\.uri)$') and (atom ->> '$') <> ''"""

# Objects of the name ticketsInfo, alone or in arrays, with the key of the object that holds them.
_TICKETS = rf"""with o as (select s.table_name, s.row_id, t.fullkey, t.value v from ({_TREES}) s, json_tree(s.j) t
    where t.type = 'OBJECT' and regexp_matches(regexp_replace(t.fullkey, '(\[[0-9]+\])+$', ''), '\.ticketsInfo$')),
  k as (select *, regexp_replace(regexp_replace(fullkey, '(\[[0-9]+\])+$', ''), '\.ticketsInfo$', '') up from o)
  select table_name, row_id, trim(regexp_replace(regexp_replace(fullkey, '\[[0-9]+\]', '', 'g'), '^\$\.?', ''), '.') path, array_to_string(regexp_extract_all(fullkey, '\[([0-9]+)\]', 1), '.') positions,
    trim(regexp_replace(regexp_replace(up, '\[[0-9]+\]', '', 'g'), '^\$\.?', ''), '.') parent_path, array_to_string(regexp_extract_all(up, '\[([0-9]+)\]', 1), '.') parent_positions,
    v ->> '$.buyUrl' "buyUrl", v ->> '$.price' price, v ->> '$.title' title from k"""

SQL = {
    "p7_found": _LEAVES,
    "p7_tickets": _TICKETS,
    "p2_changes": f"with {_LATEST} select snapshot_no, uid, change_kind, case when change_kind = 'changed' then list_filter([{', '.join(f'f{i}' for i in range(len(SNAPSHOT_FIELDS)))}], lambda x: x is not null) else [] end changed_fields {_PAIRS}",
    "p2_found": f"with {_LATEST} select snapshot_no, uid, change_kind {_PAIRS}",
    "p5_found": " union all ".join(_FIRST.format(t=t, c=c) for t, c in MESSAGES),
    "p5_ranges": " union all ".join(_RANGES.format(t=t, c=c) for t, c in MESSAGES),
}
