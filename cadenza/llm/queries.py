"""Queries of the text problems and their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import bpe, canonical, leakage, multiset, reading, truncation
from cadenza.tables import load

EVENT_FIELDS = ("venue_id", "start_date", "title")
TEXTS = (("agenda_events", "row_id", "title"), ("venues", "id", "location_filter"), ("instagram_posts", "row_id", "caption"))


def _cut(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_texts(load(spark, d, "agenda_events"), "row_id", "source_url", "title", "title_completed_from")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _cut(spark, d).where("reason is not null").select(F.col("row").alias("row_id"))


def p1_sources(spark: SparkSession, d: str) -> DataFrame:
    return truncation.by_source(_cut(spark, d)).withColumnRenamed("source", "source_url")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    parts = [load(spark, d, t).where(canonical.unstable(F.col(c))).where(canonical.has_variants(F.col(c))).select(F.lit(t).alias("table_name"), F.col(k).cast("string").alias("row_key")) for t, k, c in TEXTS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p3_canonical(spark: SparkSession, d: str) -> DataFrame:
    parts = [load(spark, d, t).select(F.lit(t).alias("table_name"), F.col(k).cast("string").alias("row_key"), canonical.canonical_form(F.col(c)).alias("text")) for t, k, c in TEXTS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _raw_events(spark: SparkSession, d: str) -> DataFrame:
    """The records of the valid payloads of kind event."""
    record = F.from_json("payload", ", ".join(f"{c} string" for c in EVENT_FIELDS) + ", _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"})
    return load(spark, d, "raw_items").where("kind = 'event' and payload is not null").select("raw_id", record.alias("_r")).where("_r._corrupt_record is null").select("raw_id", "_r.*")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    events = multiset.copies(load(spark, d, "agenda_events"), "row_id", EVENT_FIELDS).select(F.lit("agenda_events").alias("table_name"), "first_id", "copy_id")
    return events.unionByName(multiset.copies(_raw_events(spark, d), "raw_id", EVENT_FIELDS).select(F.lit("raw_items").alias("table_name"), "first_id", "copy_id"))


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    events = multiset.groups(load(spark, d, "agenda_events"), "row_id", EVENT_FIELDS).select(F.lit("agenda_events").alias("table_name"), "first_id", "copies")
    return events.unionByName(multiset.groups(_raw_events(spark, d), "raw_id", EVENT_FIELDS).select(F.lit("raw_items").alias("table_name"), "first_id", "copies"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode(load(spark, d, "documents"), "doc_id", "text")


def p9_matches(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(load(spark, d, "documents"), "doc_id", "text", load(spark, d, "eval_items"), "item_id", "text")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_matches(spark, d).select("doc_id", "item_id")


def p9_clean(spark: SparkSession, d: str) -> DataFrame:
    return leakage.without_leaks(load(spark, d, "documents"), "doc_id", p9_found(spark, d)).select("doc_id")


def p10_levels(spark: SparkSession, d: str) -> DataFrame:
    documents = load(spark, d, "documents")
    return reading.levels(documents, "doc_id", "text", reading.train(documents, load(spark, d, "level_labels")))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_levels(spark, d).select("doc_id", "reading_level")


QUERIES = {"p1_found": p1_found, "p1_sources": p1_sources, "p3_found": p3_found, "p3_canonical": p3_canonical, "p4_found": p4_found, "p4_groups": p4_groups, "p8_ids": p8_ids, "p9_found": p9_found, "p9_matches": p9_matches, "p9_clean": p9_clean, "p10_found": p10_found, "p10_levels": p10_levels}

# The signs of canonical.UNSTABLE and ALIKE in SQL's notation.
_SIGNS = "".join(
    rf"\x{{{c}}}" if "-" not in c else rf"\x{{{c[:4]}}}-\x{{{c[5:]}}}"
    for c in "FF01-FF5E FFE0-FFE6 FB00-FB06 0300-034E 0350-036F 00AD 034F 061C 180E 200B 200E 200F 202A-202E 2060-2064 2066-206F FEFF 200C 200D 00A0 1680 2000-200A 202F 205F 3000 2010 2011 FE63 0251 0261".split()
)
_WORDS = r"regexp_extract_all(strip_accents(lower(regexp_replace(regexp_replace(regexp_replace(text, '<br[^<>]*>', ' ', 'gi'), '</?[a-zA-Z][^<>]*>', '', 'g'), '[*]+', '', 'g'))), '[\p{L}\p{N}]+')"
_NORM = r"lower(regexp_replace({}, '[^\p{{L}}\p{{M}}\p{{N}}]+|[\x{{FE00}}-\x{{FE0F}}\x{{200B}}-\x{{200D}}]', '', 'g'))"
_RECORDS = f"""
records as (
  select 'agenda_events' table_name, row_id id, {_NORM.format("venue_id")} v, {_NORM.format("cast(start_date as varchar)")} s, {_NORM.format("title")} t from agenda_events
  union all
  select 'raw_items', raw_id, {_NORM.format("payload ->> '$.venue_id'")}, {_NORM.format("payload ->> '$.start_date'")}, {_NORM.format("payload ->> '$.title'")}
  from raw_items where kind = 'event' and json_valid(payload))"""
SQL = {
    "p4_found": f"with {_RECORDS}, f as (select *, min(id) over (partition by table_name, v, s, t) first_id from records) select table_name, first_id, id copy_id from f where id <> first_id",
    "p4_groups": f"with {_RECORDS} select table_name, min(id) first_id, count(*) copies from records group by table_name, v, s, t",
    "p3_found": " union all ".join(
        rf"""select '{t}' table_name, cast({k} as varchar) row_key from {t}
  where regexp_matches(regexp_replace({c}, '([\x{{1F000}}-\x{{1FAFF}}\x{{2600}}-\x{{27BF}}\x{{FE0F}}])\x{{200D}}', '\1', 'g'), '[{_SIGNS}]|\p{{Latin}}[\p{{Cyrillic}}\p{{Greek}}]|[\p{{Cyrillic}}\p{{Greek}}]\p{{Latin}}')"""
        for t, k, c in TEXTS
    ),
    "p9_found": rf"""with d as (select doc_id, {_WORDS} w from documents), i as (select item_id, {_WORDS} w from eval_items),
  dg as (select doc_id, array_to_string(list_slice(w, p, p + 12), ' ') g from (select doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) p from d) where len(w) >= 13),
  ig as (select item_id, array_to_string(list_slice(w, p, p + 12), ' ') g from (select item_id, w, unnest(range(1, greatest(len(w) - 11, 1))) p from i) where len(w) >= 13)
  select distinct doc_id, item_id from dg join ig using (g)""",
}
SQL["p9_clean"] = f"select doc_id from documents where doc_id not in (select doc_id from ({SQL['p9_found']}))"
