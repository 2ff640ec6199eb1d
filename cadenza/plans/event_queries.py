"""Queries of the event operators, each over whole tables, and their SQL equivalents. The clock is a parameter."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.functions import dates, text
from cadenza.html import ops
from cadenza.operators import execute, induce, publish, runs, social, state, validate
from cadenza.sources import sinks
from cadenza.tables import load, spread

TODAY = datetime.date(2026, 9, 12)
SPLIT = datetime.date(2026, 10, 1)
_T = f"date '{TODAY}'"
_S = f"date '{SPLIT}'"
QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):  # noqa: ANN202
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _events(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "agenda_events")


def _firsts(spark: SparkSession, d: str) -> DataFrame:
    """EX-1 over the agenda: the first row of each source, title (trimmed, any case) and day."""
    e = _events(spark, d).withColumn("title_k", F.lower(F.trim("title")))
    return runs.first_per_key(e.select("source_url", "title_k", "start_date", "row_id", "url", "title", "start_min", "end_date"), ["source_url", "title_k", "start_date"], F.col("row_id"))


_FIRSTS = """firsts as (select source_url, lower(trim(title, ' ')) title_k, start_date, row_id, url, title, start_min, end_date from agenda_events
  qualify row_number() over (partition by source_url, lower(trim(title, ' ')), start_date order by row_id) = 1)"""
_RUNS = """marked as (select *, case when start_date - lag(coalesce(end_date, start_date)) over w <= 3 then 0 else 1 end fresh from {t}
    window w as (partition by source_url, coalesce(title_k, ''), coalesce(url, '') order by start_date, coalesce(start_min, 0), row_id)),
  numbered as (select *, sum(fresh) over (partition by source_url, coalesce(title_k, ''), coalesce(url, '') order by start_date, coalesce(start_min, 0), row_id rows unbounded preceding) run from marked),
  whole as (select *, count(*) over r n, max(coalesce(end_date, start_date)) over r last_day,
    row_number() over (partition by source_url, coalesce(title_k, ''), coalesce(url, ''), run order by start_date, coalesce(start_min, 0), row_id) place
    from numbered window r as (partition by source_url, coalesce(title_k, ''), coalesce(url, ''), run)),
  folded as (select source_url, title_k, start_date, row_id, url, title, start_min, case when n >= 3 then last_day else end_date end end_date, case when n >= 3 then n else 1 end folded_rows
    from whole where n < 3 or place = 1)"""
_KEYS = ["source_url", "title_k", "url"]


@_query(f"with {_FIRSTS} select source_url, start_date, row_id, title from firsts")
def dedup_keep_first(spark: SparkSession, d: str) -> DataFrame:
    return _firsts(spark, d).select("source_url", "start_date", "row_id", "title")


@_query(f"with {_FIRSTS}, {_RUNS.format(t='firsts')} select row_id, start_date, end_date, folded_rows from folded")
def collapse_runs(spark: SparkSession, d: str) -> DataFrame:
    return runs.collapse_runs(_firsts(spark, d), _KEYS, "row_id").select("row_id", "start_date", "end_date", "folded_rows")


@_query(
    f"with {_FIRSTS}, upcoming as (select * from firsts where coalesce(end_date, start_date) >= {_T}), {_RUNS.format(t='upcoming')}"
    " select row_id, source_url, title, start_date, end_date, start_min, folded_rows from folded"
)
def publish_upcoming(spark: SparkSession, d: str) -> DataFrame:
    up = _firsts(spark, d).where(state.still_upcoming(F.lit(TODAY)))
    return runs.collapse_runs(up, _KEYS, "row_id").select("row_id", "source_url", "title", "start_date", "end_date", "start_min", "folded_rows").orderBy("start_date", F.coalesce("start_min", F.lit(0)), "title", "row_id")


@_query(
    f"""with {_FIRSTS}, early as (select * from firsts where start_date < {_S}), {_RUNS.format(t="early")},
  known as (select * from folded where end_date > start_date),
  late as (select * from firsts where start_date >= {_S}),
  hits as (select l.row_id, min(struct_pack(f := k.start_date, u := k.row_id)) h from late l join known k on l.source_url = k.source_url and coalesce(l.title_k, '') = coalesce(k.title_k, '')
    and coalesce(l.url, '') = coalesce(k.url, '') and l.start_date > k.start_date and l.start_date <= k.end_date + 3 group by 1),
  joined as (select l.*, h.h.u known_id, h.h.f known_start from late l left join hits h using (row_id)),
  placed as (select *, max(coalesce(end_date, start_date)) over (partition by coalesce('k' || known_id, 'r' || row_id)) last_day, row_number() over (partition by coalesce('k' || known_id, 'r' || row_id) order by row_id) place from joined)
  select row_id, coalesce(known_start, start_date) start_date, case when known_id is null then end_date else last_day end end_date, known_id continued_uid from placed where place = 1"""
)
def continue_runs(spark: SparkSession, d: str) -> DataFrame:
    firsts = _firsts(spark, d)
    known = runs.collapse_runs(firsts.where(F.col("start_date") < F.lit(SPLIT)), _KEYS, "row_id")
    return runs.continue_runs(firsts.where(F.col("start_date") >= F.lit(SPLIT)), known, _KEYS, "row_id", "row_id").select("row_id", "start_date", "end_date", "continued_uid")


_STATE = f"""
  olds as (select * from agenda_events where (date '1970-01-01' + cast(floor(epoch(ingested_at) / 86400) as int)) < {_T} qualify row_number() over (partition by uid order by row_id desc) = 1),
  news as (select * from agenda_events where (date '1970-01-01' + cast(floor(epoch(ingested_at) / 86400) as int)) >= {_T}),
  newest as (select * from news qualify row_number() over (partition by uid order by source_url desc, row_id desc) = 1),
  fetched as (select distinct source_url from news),
  live as (select source_url, count(distinct uid) live from olds where coalesce(end_date, start_date) >= {_T} group by 1),
  found as (select source_url, count(distinct uid) found from news group by 1),
  guard as (select source_url, coalesce(live, 0) live, coalesce(found, 0) found, coalesce(live, 0) >= 5 and coalesce(found, 0) < coalesce(live, 0) * 0.5 guarded from fetched left join live using (source_url) left join found using (source_url)),
  absent as (select o.source_url, o.uid from olds o join guard g using (source_url) where not guarded and not exists (select 1 from news n where n.source_url = o.source_url and n.uid = o.uid))"""


def _merged(spark: SparkSession, d: str) -> state.Merged:
    """The rows ingested before the day are the state (the last row of each uid), with two misses of every event; the
    later ones are a run of their sources, in the order of their addresses."""
    e = _events(spark, d)
    columns = ["uid", "source_url", "start_date", "end_date", "image", "image_source", "first_seen", "last_seen", "title"]
    day = F.date_from_unix_date(F.floor(F.unix_micros("ingested_at") / F.lit(86_400_000_000)).cast("int"))
    old = e.where(day < F.lit(TODAY)).groupBy("uid").agg(F.max(F.struct("row_id", F.struct(*columns[1:]).alias("r"))).alias("b")).select("uid", "b.r.*")
    new = e.where(day >= F.lit(TODAY)).select(*columns, F.col("row_id").alias("pos"))
    fetched = new.select("source_url").distinct().select("source_url", F.col("source_url").alias("rank"), F.lit(None).cast("string").alias("error"))
    sources = old.select("source_url", "uid")
    return state.merge_sources(old, sources, sources.withColumn("n", F.lit(2)), new, fetched, TODAY)


@_query(
    f"""with {_STATE} select coalesce(n.uid, o.uid) uid, case when n.uid is null then o.source_url else n.source_url end source_url,
  case when n.uid is null then o.title else n.title end title, case when n.uid is null then o.start_date else n.start_date end start_date,
  coalesce(o.first_seen, n.first_seen) first_seen, case when n.uid is null then o.last_seen else {_T} end last_seen,
  case when n.uid is null then o.image when o.uid is not null and coalesce(n.image_source, o.image_source) is not distinct from o.image_source then o.image else n.image end image
  from olds o full join newest n on o.uid = n.uid where n.uid is not null or o.uid not in (select uid from absent)"""
)
def merge_upsert(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d).events.select("uid", "source_url", "title", "start_date", "first_seen", "last_seen", "image")


@_query(f"with {_STATE} select source_url, 'warning' level_name, 'event count dropped from ' || live || ' to ' || found || '; previous events kept' message from guard where guarded")
def merge_guard(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d).alerts.withColumnRenamed("level", "level_name")


@_query(f"with {_STATE} select o.source_url, o.uid, cast(2 as int) n from olds o where not exists (select 1 from news n where n.source_url = o.source_url and n.uid = o.uid) and (o.source_url not in (select source_url from fetched) or o.source_url in (select source_url from guard where guarded))")
def missing_counter(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d).missing


@_query(f"select row_id, coalesce(coalesce(end_date, start_date) >= {_T}, true) upcoming from agenda_events where venue_id <> 'theatre-aux-etoiles' or source_kind not in ('json', 'html') or venue_id is null or source_kind is null")
def expire_and_forget(spark: SparkSession, d: str) -> DataFrame:
    kept = state.forget(_events(spark, d), "theatre-aux-etoiles", ["json", "html"])
    ahead, past = state.expire(kept, TODAY)
    return ahead.select("row_id", F.lit(True).alias("upcoming")).unionByName(past.select("row_id", F.lit(False).alias("upcoming")))


@_query("select v.id, v.name, count(e.row_id) event_count from venues v left join agenda_events e on e.venue_id = v.id group by 1, 2")
def venue_counts(spark: SparkSession, d: str) -> DataFrame:
    return publish.counts_by_venue(load(spark, d, "venues"), _events(spark, d))


@_query()
def publish_fold(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d)
    return publish.published(runs.first_per_key(e.select("uid", "row_id", "venue_id", "source_kind", "source_url", "start_date", "end_date", "start_min", "venue_name", "title", "image_source"), ["uid"], F.col("row_id")))


_TOKENS = r"list_filter(list_distinct(regexp_extract_all(strip_accents(lower(title)), '[a-z0-9]+')), lambda x: length(x) > 1 and x not in ('de','du','des','la','le','les','l','d','a','au','aux','et','en','un','une','the','of','avec','par','sur'))"


@_query(
    f"""with s as (select snapshot_no, uid, min(venue_id) venue_id, min(start_date) start_date, max(end_date) end_date, min(title) title from event_snapshots group by 1, 2),
  u as (select snapshot_no || '/' || uid uid, snapshot_no || '/' || venue_id venue_id, start_date, end_date, title, {_TOKENS} k from s),
  w as (select venue_id, min(start_date) start_date, max(start_date) end_date, 'run ' || min(uid) uid, min(struct_pack(t := title, k := k)).k k from u where len(k) > 0 group by venue_id, list_min(k)),
  r as (select venue_id, k, start_date, end_date, uid from u where end_date > start_date union all select venue_id, k, start_date, end_date, uid from w where end_date > start_date),
  p as (select a.uid, r.uid range_uid, r.start_date rs from u a join r on a.venue_id = r.venue_id and a.start_date between r.start_date and r.end_date
    where (a.end_date is null or a.end_date <= a.start_date) and len(a.k) > 0 and len(r.k) > 0 and len(list_intersect(a.k, r.k)) >= 0.75 * least(len(a.k), len(r.k)))
  select uid, range_uid from p qualify row_number() over (partition by uid order by rs, range_uid) = 1"""
)
def range_contains(spark: SparkSession, d: str) -> DataFrame:
    """JN-8 in every delivery of the events: the ranges are those published, and those that run from the first to the last day
    on which a venue has titles with the same first word in the alphabet."""
    s = load(spark, d, "event_snapshots").groupBy("snapshot_no", "uid").agg(F.min("venue_id").alias("venue_id"), F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"), F.min("title").alias("title"))
    u = s.select(F.concat_ws("/", "snapshot_no", "uid").alias("uid"), F.when(F.col("venue_id").isNotNull(), F.concat_ws("/", "snapshot_no", "venue_id")).alias("venue_id"), "start_date", "end_date", "title")
    titled = u.withColumn("k", F.array_min(text.title_tokens(F.col("title")))).where("k is not null").groupBy("venue_id", "k")
    spans = titled.agg(F.min("start_date").alias("start_date"), F.max("start_date").alias("end_date"), F.concat(F.lit("run "), F.min("uid")).alias("uid"), F.min("title").alias("title")).select(*u.columns)
    return publish.covered_by_ranges(u, u.unionByName(spans))


_KEY = r"strip_accents(lower(trim(regexp_replace(replace(replace(title, '…', '...'), '’', ''''), '\s+', ' ', 'g'))))"


@_query(rf"select snapshot_no, uid, epoch_us(loaded_at) loaded_us, {_KEY} title_key, trim(regexp_replace({_KEY}, '[^a-z0-9]+', '-', 'g'), '-') slug, substr(sha1(concat_ws('|', venue_id, {_KEY}, cast(start_date as varchar))), 1, 12) made_uid from event_snapshots where title is not null")
def normalize_slug_uid(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("title")
    return load(spark, d, "event_snapshots").where(t.isNotNull()).select("snapshot_no", "uid", F.unix_micros("loaded_at").alias("loaded_us"), text.title_key(t).alias("title_key"), text.slugify(t, "").alias("slug"), text.event_uid(F.col("venue_id"), t, F.col("start_date")).alias("made_uid"))


@_query(rf"select snapshot_no, uid, epoch_us(loaded_at) loaded_us, array_to_string(list_sort({_TOKENS}), ' ') tokens from event_snapshots where title is not null")
def title_tokens(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "event_snapshots").where("title is not null").select("snapshot_no", "uid", F.unix_micros("loaded_at").alias("loaded_us"), F.array_join(F.array_sort(text.title_tokens(F.col("title"))), " ").alias("tokens"))


_WS = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0085}\x{000B}]"


@_query(
    rf"""select row_id, regexp_replace(title, '{_WS}*(?:\.{{3}}|…){_WS}*$', '') bare, title <> regexp_replace(title, '{_WS}*(?:\.{{3}}|…){_WS}*$', '') truncated,
  case when length(f) <= 40 then f else rtrim(substr(f, 1, 37)) || '...' end clipped from (select row_id, title, trim(regexp_replace(title, '{_WS}+', ' ', 'g')) f from agenda_events)"""
)
def strip_and_clip(spark: SparkSession, d: str) -> DataFrame:
    t = text.strip_ellipsis(F.col("title"))
    return _events(spark, d).select("row_id", t["title"].alias("bare"), t["truncated"].alias("truncated"), text.clip(F.col("title"), 40).alias("clipped"))


@_query("select doc_id, substr(sha256(text), 1, 16) content_hash from documents")
def content_hash(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", text.content_hash(F.col("text")).alias("content_hash"))


_FR_MONTHS = ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre")


def _french(day):  # noqa: ANN001, ANN202
    names = F.get(F.array(*[F.lit(m) for m in _FR_MONTHS]), F.month(day) - 1)
    return F.concat_ws(" ", F.get(F.array(*[F.lit(w) for w in dates.WEEKDAYS]), F.weekday(day)), F.when(F.dayofmonth(day) == 1, F.lit("1er")).otherwise(F.dayofmonth(day).cast("string")), names)


def _parsed(e: DataFrame, written) -> DataFrame:  # noqa: ANN001
    return spread(e.select("row_id", written.alias("w"))).select("row_id", dates.parse_date(F.col("w"), TODAY).alias("p")).select("row_id", F.col("p.start").alias("d1"), F.col("p.end").alias("d2"), F.col("p.start_min").alias("m1"), F.col("p.year_inferred").alias("inferred"), F.col("p.error").alias("problem"))


@_query("select row_id, start_date d1, cast(null as date) d2, start_min m1, false inferred, cast(null as varchar) problem from agenda_events where start_date is not null")
def date_parse_fr(spark: SparkSession, d: str) -> DataFrame:
    day, m = F.col("start_date"), F.col("start_min")
    clock = F.when(m.isNotNull(), F.concat(F.lit(" à "), F.floor(m / 60).cast("string"), F.lit(" h "), F.lpad((m % 60).cast("string"), 2, "0"))).otherwise("")
    return _parsed(_events(spark, d).where("start_date is not null"), F.concat(F.lit("Le "), _french(day), F.lit(" "), F.year(day).cast("string"), clock))


@_query(
    """with e as (select row_id, start_date, case when end_date >= start_date then end_date else start_date end last_day from agenda_events where start_date is not null),
  r as (select *, try_cast(format('{:04d}-{:02d}-{:02d}', year(last_day) - case when month(start_date) > month(last_day) then 1 else 0 end, month(start_date), day(start_date)) as date) begun from e)
  select row_id, case when row_id % 4 <> 3 then start_date else begun end d1, case when row_id % 4 = 3 and begun is not null then last_day end d2, cast(null as int) m1,
    case when row_id % 4 = 3 and begun is null then null else false end inferred, case when row_id % 4 = 3 and begun is null then 'invalid range' end problem from r"""
)
def date_parse_formats(spark: SparkSession, d: str) -> DataFrame:
    day, k = F.col("start_date"), F.col("row_id") % 4
    last = F.coalesce(F.when(F.col("end_date") >= day, F.col("end_date")), day)
    span = F.concat(F.lit("du "), F.dayofmonth(day).cast("string"), F.lit(" "), F.get(F.array(*[F.lit(m) for m in _FR_MONTHS]), F.month(day) - 1), F.lit(" au "), F.dayofmonth(last).cast("string"), F.lit(" "), F.get(F.array(*[F.lit(m) for m in _FR_MONTHS]), F.month(last) - 1), F.lit(" "), F.year(last).cast("string"))
    written = F.when(k == 0, day.cast("string")).when(k == 1, F.date_format(day, "yyyyMMdd")).when(k == 2, F.date_format(day, "d/M/yy")).otherwise(span)
    return _parsed(_events(spark, d).where("start_date is not null"), written)


@_query(
    f"""with c as (select row_id, start_date, weekday, unnest([year({_T}) - 1, year({_T}), year({_T}) + 1]) y from (select row_id, start_date, isodow(start_date) weekday from agenda_events where start_date is not null)),
  v as (select *, try_cast(y || '-' || lpad(cast(month(start_date) as varchar), 2, '0') || '-' || lpad(cast(day(start_date) as varchar), 2, '0') as date) d from c),
  g as (select row_id, min(d) filter (where d >= {_T} and isodow(d) = weekday) a, max(d) filter (where isodow(d) = weekday) b from v group by 1)
  select row_id, coalesce(a, b) d1, cast(null as date) d2, cast(null as int) m1, case when coalesce(a, b) is null then null else true end inferred, case when coalesce(a, b) is null then 'no such date' end problem from g"""
)
def year_inference(spark: SparkSession, d: str) -> DataFrame:
    return _parsed(_events(spark, d).where("start_date is not null"), _french(F.col("start_date")))


@_query(f"""with p as (select row_id, start_date, end_date, list_distinct([lower(x) for x in regexp_extract_all(array_to_string(coalesce(evidence, []), ' '), '(?i)\\b(lundi|mardi|mercredi|jeudi|vendredi|samedi|dimanche)\\b', 1)]) w, ['lundi','mardi','mercredi','jeudi','vendredi','samedi','dimanche'][isodow(start_date)] a from agenda_events)
  select row_id, array_to_string(list_filter([case when coalesce(end_date, start_date) < {_T} then 'past' end, case when start_date > {_T} + 540 then 'far' end, case when end_date < start_date then 'order' end, case when len(w) = 1 and w[1] <> a then 'weekday' end], lambda x: x is not null), ',') reasons from p""")
def reasons_check(spark: SparkSession, d: str) -> DataFrame:
    found = F.array(*validate.date_problems(F.col("start_date"), F.col("end_date"), F.lit(TODAY)), validate.weekday_problem(F.coalesce("evidence", F.array().cast("array<string>")), F.col("start_date")))
    names = F.array(*[F.lit(n) for n in ("past", "far", "order", "weekday")])
    kept = F.filter(F.transform(found, lambda r, i: F.when(r.isNotNull(), F.get(names, i))), lambda n: n.isNotNull())
    return _events(spark, d).select("row_id", F.array_join(kept, ",").alias("reasons"))


@_query("""select e.row_id, e.location_name from agenda_events e join venues v on e.venue_id = v.id
  where v.location_filter is null or e.location_name is null or coalesce(try(regexp_matches(strip_accents(lower(e.location_name)), '(?i)' || strip_accents(v.location_filter))), true)""")
def location_rule(spark: SparkSession, d: str) -> DataFrame:
    v = load(spark, d, "venues").select(F.col("id").alias("venue_id"), "location_filter")
    joined = _events(spark, d).select("row_id", "venue_id", "location_name").join(v, "venue_id")
    return joined.where(validate.at_venue(F.col("location_filter"), F.col("location_name"))).select("row_id", "location_name")


@_query("""with n as (select row_id, source_url, image, count(image) over (partition by venue_id, source_url, image) same, count(*) over (partition by venue_id, source_url) every from agenda_events)
  select row_id, case when not (same >= 2 and same > 0.5 * every) then image end image from n""")
def shared_value_rule(spark: SparkSession, d: str) -> DataFrame:
    return execute.drop_shared_images(_events(spark, d), "venue_id", "source_url").select("row_id", "image")


@_query(f"""select count(*) events, count(*) filter (where coalesce(end_date, start_date) >= {_T}) events_upcoming, count(distinct uid) filter (where uid not in (select uid from agenda_events where uid is not null and (date '1970-01-01' + cast(floor(epoch(ingested_at) / 86400) as int)) < {_T})) events_new, count(distinct source_url) sources,
  count(distinct venue_id) venues, count(*) filter (where verifier = 'accept') verified, count(*) filter (where title_truncated) titles_truncated, count(image) images from agenda_events""")
def run_report(spark: SparkSession, d: str) -> DataFrame:
    """AG-2: new are the events that no row before the day has."""
    e = _events(spark, d)
    day = F.date_from_unix_date(F.floor(F.unix_micros("ingested_at") / F.lit(86_400_000_000)).cast("int"))
    return sinks.run_report(e, TODAY, e.where(day < F.lit(TODAY)))


@_query("select verifier, source_kind, count(*) n, count(distinct uid) uids, min(start_date) first_day from agenda_events group by 1, 2")
def verdict_counts(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d).groupBy("verifier", "source_kind").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("uid").alias("uids"), F.min("start_date").alias("first_day"))


@_query(f"""with known as (select distinct uid from agenda_events where (date '1970-01-01' + cast(floor(epoch(ingested_at) / 86400) as int)) < {_T} and verifier = 'accept')
  select e.row_id, k.uid is not null reused from agenda_events e left join known k on e.uid = k.uid where (date '1970-01-01' + cast(floor(epoch(e.ingested_at) / 86400) as int)) >= {_T}""")
def verdict_reuse(spark: SparkSession, d: str) -> DataFrame:
    day = F.date_from_unix_date(F.floor(F.unix_micros("ingested_at") / F.lit(86_400_000_000)).cast("int"))
    e = _events(spark, d)
    known = e.where((day < F.lit(TODAY)) & (F.col("verifier") == "accept")).select("uid").distinct().withColumn("_known", F.lit(True))
    return e.where(day >= F.lit(TODAY)).join(known, "uid", "left").select("row_id", F.col("_known").isNotNull().alias("reused"))


@_query("select row_id, id, postid from (select p.row_id, p.postId postid, e.id from facebook_posts p left join (select distinct id from facebook_events) e on p.postId = e.id) where id is null")
def anti_not_cached(spark: SparkSession, d: str) -> DataFrame:
    posts = load(spark, d, "facebook_posts").select("row_id", F.col("postId").alias("postid"), F.lit("facebook").alias("platform"), F.col("postId").alias("id"))
    cache = load(spark, d, "facebook_events").select(F.lit("facebook").alias("platform"), "id")
    return social.not_cached(posts, cache).select("row_id", F.lit(None).cast("string").alias("id"), "postid")


@_query(f"""select e.row_id from agenda_events e where (date '1970-01-01' + cast(floor(epoch(e.ingested_at) / 86400) as int)) >= {_T} and not exists (select 1 from agenda_events o where o.last_seen = {_T} and o.uid = e.uid and o.source_url <> e.source_url)""")
def anti_published_elsewhere(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d)
    day = F.date_from_unix_date(F.floor(F.unix_micros("ingested_at") / F.lit(86_400_000_000)).cast("int"))
    return social.published_elsewhere(e.where(day >= F.lit(TODAY)), e, TODAY).select("row_id")


@_query(f"select row_id from agenda_events where {_T} - last_seen <= 30")
def retention(spark: SparkSession, d: str) -> DataFrame:
    return social.kept(_events(spark, d), "last_seen", TODAY, 30).select("row_id")


@_query(f"""with s as (select source_url, max(last_seen) seen from agenda_events group by 1)
  select source_url, row_number() over (order by seen asc nulls first, source_url) place, row_number() over (order by seen asc nulls first, source_url) > 100 deferred,
  greatest({_T} - 30, least(coalesce(seen, {_T} - 30) - 2, {_T} - 7)) since, {_T} - seen >= 1 or seen is null due from s""")
def stalest_first(spark: SparkSession, d: str) -> DataFrame:
    s = _events(spark, d).groupBy("source_url").agg(F.max("last_seen").alias("seen"))
    return state.stalest_first(s, "seen", 100).select("source_url", "place", "deferred", social.fetch_window(F.col("seen"), TODAY).alias("since"), social.is_due(F.lit("instagram"), F.col("seen"), TODAY).alias("due"))


@_query("""with s as (select distinct snapshot_no, venue_id, title from event_snapshots where title is not null), g as (select snapshot_no, venue_id, list(title) t from s group by 1, 2),
  n as (select snapshot_no from s group by 1), a as (select g.snapshot_no + 1 snapshot_no, venue_id, t from g where snapshot_no + 1 in (select snapshot_no from n)), b as (select * from g where snapshot_no - 1 in (select snapshot_no from n))
  select coalesce(a.snapshot_no, b.snapshot_no) snapshot_no, coalesce(a.venue_id, b.venue_id) venue_id, round(len(list_intersect(coalesce(a.t, []), coalesce(b.t, []))) / len(list_distinct(list_concat(coalesce(a.t, []), coalesce(b.t, [])))), 6) agreement
  from a full join b on a.snapshot_no = b.snapshot_no and a.venue_id is not distinct from b.venue_id""")
def jaccard_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Title sets of each two consecutive snapshots by venue, from one aggregate of distinct titles: shared over all. A row
    stands for its own snapshot and, as the one before, for the next."""
    s = load(spark, d, "event_snapshots").where("title is not null")
    known = s.select("snapshot_no").distinct()
    both = s.select("venue_id", "title", F.explode(F.array(F.struct(F.col("snapshot_no").alias("at"), F.lit(2).alias("side")), F.struct((F.col("snapshot_no") + 1).alias("at"), F.lit(1).alias("side")))).alias("x")).select("venue_id", "title", "x.*")
    pairs = both.join(known, F.col("at") == F.col("snapshot_no"), "left_semi").join(known.select((F.col("snapshot_no") + 1).alias("after")), F.col("at") == F.col("after"), "left_semi")
    sides = pairs.groupBy("at", "venue_id", "title").agg(F.min("side").alias("lo"), F.max("side").alias("hi"))
    return sides.groupBy(F.col("at").alias("snapshot_no"), "venue_id").agg(F.round(F.sum((F.col("lo") < F.col("hi")).cast("int")) / F.count(F.lit(1)), 6).alias("agreement"))


@_query("select uid, row_id, start_date from agenda_events qualify row_number() over (partition by venue_id order by start_date, coalesce(start_min, 0), row_id) <= 3")
def topk_per_venue(spark: SparkSession, d: str) -> DataFrame:
    """TK-3: the next three entries of each venue (a report of a fixed size by venue)."""
    w = Window.partitionBy("venue_id").orderBy("start_date", F.coalesce("start_min", F.lit(0)), "row_id")
    return _events(spark, d).withColumn("_n", F.row_number().over(w)).where("_n <= 3").select("uid", "row_id", "start_date")


@_query("""select raw_id, payload ->> '$.title' title, payload ->> '$.start_date' start_date, payload ->> '$.price' price, payload ->> '$.location_name' location_name from raw_items where kind = 'event' and json_valid(payload)""")
def json_project(spark: SparkSession, d: str) -> DataFrame:
    fields = ("title", "start_date", "price", "location_name")
    record = F.from_json("payload", ", ".join(f"{c} string" for c in fields) + ", _bad string", {"columnNameOfCorruptRecord": "_bad"})
    return load(spark, d, "raw_items").where("kind = 'event' and payload is not null").select("raw_id", record.alias("r")).where("r._bad is null").select("raw_id", *[f"r.{c}" for c in fields])


@_query("""select row_id, pos - 1 pos, c.displayUrl display_url, ownerUsername owner from (select row_id, ownerUsername, unnest(childPosts) c, generate_subscripts(childPosts, 1) pos from instagram_posts)""")
def json_unnest_parent(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "instagram_posts").select("row_id", F.col("ownerUsername").alias("owner"), F.posexplode("childPosts").alias("pos", "c")).select("row_id", F.col("pos").cast("bigint").alias("pos"), F.col("c.displayUrl").alias("display_url"), "owner")


@_query("""with i as (select row_id, id, shortCode, list_concat([displayUrl], coalesce(images, []), coalesce([c.displayUrl for c in childPosts], [])) u from instagram_posts where error is null)
  select row_id, coalesce(nullif(id, ''), nullif(shortCode, '')) id, least(4, len(list_distinct(list_filter(u, lambda x: x is not null and (starts_with(x, 'http://') or starts_with(x, 'https://')))))) images from i where coalesce(nullif(id, ''), nullif(shortCode, '')) is not null""")
def instagram_images(spark: SparkSession, d: str) -> DataFrame:
    """SRC-10 with every time readable, so that the images can be held against SQL."""
    items = load(spark, d, "instagram_posts").withColumn("timestamp", F.lit("0"))
    posts = social.instagram_posts(items.withColumn("shortCode", F.col("shortCode")).withColumn("caption", F.col("row_id").cast("string")))
    return posts.select(F.col("text").cast("bigint").alias("row_id"), "id", F.size("image_urls").cast("bigint").alias("images"))


@_query()
def facebook_normalized(spark: SparkSession, d: str) -> DataFrame:
    return social.facebook_posts(load(spark, d, "facebook_posts"))


@_query("""select row_id, id, trim(name) name, location.name location_name, coalesce(isCanceled, false) cancelled, ticketsInfo.buyUrl ticket_url from facebook_events where id <> '' and trim(name) <> ''""")
def facebook_event_fields(spark: SparkSession, d: str) -> DataFrame:
    items = load(spark, d, "facebook_events").withColumn("url", F.col("row_id").cast("string"))
    return social.facebook_events(items).select(F.col("url").cast("bigint").alias("row_id"), "id", "name", "location_name", "cancelled", "ticket_url")


@_query()
def facebook_event_rows(spark: SparkSession, d: str) -> DataFrame:
    return social.event_rows(social.facebook_events(load(spark, d, "facebook_events")))


_HANDLE = "trim(case when regexp_extract({c}, '(?i){site}\\.com/({name})', 1) <> '' then regexp_extract({c}, '(?i){site}\\.com/({name})', 1) else trim(ltrim(trim({c}, ' '), '@'), '/') end, '/')"
_FOUND = "(select venue_id id, regexp_replace(lower(coalesce(min(source_url), '')), '^https?://([a-z0-9.-]+).*$', '\\1') site from agenda_events where venue_id is not null group by 1)"


@_query(
    f"""with d as {_FOUND}, v as (select v.id, coalesce(v.instagram, '@' || d.site) i, coalesce(v.facebook, 'https://www.facebook.com/' || d.site || '/events') f from venues v left join d using (id)),
  h as (select id, {_HANDLE.format(c="i", site="instagram", name="[A-Za-z0-9_.]+")} i, regexp_replace({_HANDLE.format(c="f", site="facebook", name="[^?#[:space:]]+")}, '/(?:events|upcoming_hosted_events|past_hosted_events|posts|about)$', '') f from v),
  u as (select id, case when i <> '' and i not like '%/%' and lower(i) not in ('p', 'reel', 'reels', 'explore', 'stories', 'accounts', 'tv') then 'https://www.instagram.com/' || i || '/' end i, case when f <> '' then 'https://www.facebook.com/' || f || '/' end f from h)
  select id venue_id, 'instagram' kind, i handle from u where i is not null union all select id, 'facebook', f from u where f is not null union all select id, 'facebook-events', f from u where f is not null"""
)
def venue_sources(spark: SparkSession, d: str) -> DataFrame:
    """SRC-14, SRC-15: a venue's own accounts, else those named after the host of its pages."""
    site = F.regexp_replace(F.lower(F.coalesce(F.min("source_url"), F.lit(""))), r"^https?://([a-z0-9.-]+).*$", "$1")
    found = _events(spark, d).where("venue_id is not null").groupBy("venue_id").agg(site.alias("site"))
    discovered = found.select("venue_id", F.concat(F.lit("@"), "site").alias("instagram"), F.concat(F.lit("https://www.facebook.com/"), "site", F.lit("/events")).alias("facebook"))
    return social.venue_sources(load(spark, d, "venues"), discovered)


@_query()
def instagram_normalized(spark: SparkSession, d: str) -> DataFrame:
    """SRC-10, SRC-13 on the times as they were delivered."""
    return social.instagram_posts(load(spark, d, "instagram_posts"))


@_query(
    rf"""select substr(sha1(concat_ws('|', s.venue_id, {_KEY.replace("title", "s.title")}, cast(s.start_date as varchar))), 1, 12) uid, s.venue_id, v.name venue_name, v.category, s.title, s.start_date, s.end_date, coalesce(s.end_date > s.start_date, false) recurring, {_T} first_seen, v.lat, v.lng
  from event_snapshots s left join venues v on s.venue_id = v.id where s.title is not null and s.start_date is not null"""
)
def event_projection(spark: SparkSession, d: str) -> DataFrame:
    """EX-11 over the delivered events."""
    no = lambda c, kind="string": F.lit(None).cast(kind).alias(c)
    rows = load(spark, d, "event_snapshots").select(
        "venue_id", "title", no("title_truncated", "boolean"), "start_date", "end_date", "start_min", no("end_min", "int"), "location_name", no("url"), "price", no("summary"), "status",
        no("event_type"), no("image"), no("evidence"), no("source_url"), no("source_kind"), no("verifier"), no("verifier_reason"),
    )
    return execute.to_events(rows, load(spark, d, "venues"), TODAY).select("uid", "venue_id", "venue_name", "category", "title", "start_date", "end_date", "recurring", "first_seen", "lat", "lng")


@_query(
    """with s as (select source_url, source_kind, count(*) items_seen, count(*) filter (where title_truncated) failures, count(*) filter (where location_name is null) undated, count(*) filter (where verifier = 'accept') events, count(distinct venue_id) + 2 last_count from agenda_events group by 1, 2)
  select source_url || '|' || source_kind doc_url, case when events = 0 and undated = items_seen then 'date selector matches nothing in any item' when failures / items_seen > 0.5 and source_kind = 'html' then failures || '/' || items_seen || ' items failed to parse'
    when events = 0 and last_count >= 3 then '0 events where the last run had ' || last_count end problem from s where source_url is not null and source_kind is not null"""
)
def rule_health(spark: SparkSession, d: str) -> DataFrame:
    """EX-10 over figures of each source and kind that stand in for those of a run."""
    e = _events(spark, d).where("source_url is not null and source_kind is not null").withColumn("doc_url", F.concat_ws("|", "source_url", "source_kind"))
    count = lambda hit: F.count(F.when(hit, 1))
    s = e.groupBy("doc_url", F.col("source_kind").alias("kind")).agg(
        F.count(F.lit(1)).alias("items_seen"), count(F.col("title_truncated")).alias("failures"), count(F.col("location_name").isNull()).alias("undated"), count(F.col("verifier") == "accept").alias("events"), (F.countDistinct("venue_id") + 2).alias("last_event_count")
    ).withColumn("failure_ratio", F.col("failures") / F.col("items_seen"))
    return execute.health(s.drop("kind", "last_event_count"), s.select("doc_url", "kind", "last_event_count")).select("doc_url", "problem")


@_query(f"select source_url, case when max(last_seen) = {_T} and count(*) filter (where verifier = 'uncertain') = 0 then {_T} else min(last_seen) end last_ok from agenda_events group by 1")
def last_ok(spark: SparkSession, d: str) -> DataFrame:
    """ST-9: a source seen today moves on, unless some of its rows are pending."""
    s = _events(spark, d).groupBy("source_url").agg(F.min("last_seen").alias("before"), (F.max("last_seen") == F.lit(TODAY)).alias("ok"), F.count(F.when(F.col("verifier") == "uncertain", 1)).alias("pending"))
    return s.select("source_url", social.last_ok_after(F.col("before"), F.col("ok"), F.col("pending"), TODAY).alias("last_ok"))


def _listings(spark: SparkSession, d: str) -> DataFrame:
    """Listing pages written from the agenda, a page for each source and day: a list and, for every third row, cards."""
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    e = _events(spark, d).where("title is not null and start_date is not null and trim(title) <> ''")
    row = F.col("row_id").cast("string")
    entry = F.concat(F.lit('<li class="event"><a href="https://x.example/e/'), row, F.lit('">+</a><h3>'), esc(F.col("title")), F.lit('</h3><span class="date">'), F.date_format("start_date", "dd/MM/yyyy"), F.lit("</span></li>"))
    card = F.concat(F.lit('<article class="card"><a class="t" href="/c/'), row, F.lit('">'), esc(F.col("title")), F.lit('</a><time datetime="'), F.col("start_date").cast("string"), F.lit('">x</time></article>'))
    written = e.select("source_url", "start_date", F.struct("row_id", F.when(F.col("row_id") % 3 == 0, card).alias("card"), F.when(F.col("row_id") % 3 != 0, entry).alias("entry")).alias("x"))
    grouped = written.groupBy("source_url", "start_date").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    parts = lambda c: F.array_join(F.transform("xs", lambda x: x[c]), "")
    return grouped.select(F.concat("source_url", F.lit("#"), F.col("start_date").cast("string")).alias("url"), F.concat(F.lit('<ul class="agenda">'), parts("entry"), F.lit("</ul>"), parts("card")).alias("raw"))


LISTING = execute.HtmlRule(item="ul.agenda > li.event", fields={"title": ops.Field("h3"), "date": ops.Field(".date"), "url": ops.Field("a", "href")})
CARDS = execute.HtmlRule(item="article.card", fields={"title": ops.Field("a.t"), "date": ops.Field("time", "datetime"), "url": ops.Field("a.t", "href")})


@_query(
    rf"""with e as (select *, regexp_replace(regexp_replace(title, '^{_WS}+|{_WS}+$', '', 'g'), '{_WS}*(?:\.{{3}}|…){_WS}*$', '') bare from agenda_events where title is not null and start_date is not null and trim(title, ' ') <> '')
  select bare title, start_date, case when row_id % 3 = 0 then regexp_extract(source_url, '^[a-z]+://[^/]+') || '/c/' || row_id else 'https://x.example/e/' || row_id end url from e where bare <> ''
  qualify row_number() over (partition by source_url, start_date, lower(bare) order by case when row_id % 3 = 0 then 1 else 0 end, row_id) = 1"""
)
def css_items(spark: SparkSession, d: str) -> DataFrame:
    """EX-1, EX-2, EX-7 over the listing pages, with two rules and several selectors."""
    return execute.apply_rules(_listings(spark, d), [LISTING, CARDS], TODAY).where("failure is null").select("title", "start_date", "url")


@_query()
def induced_rules(spark: SparkSession, d: str) -> DataFrame:
    """IN-1..5 over one listing page for each month of a source."""
    pages = _listings(spark, d).withColumn("month", F.substring_index(F.substring("url", -10, 7), "#", -1)).withColumn("source", F.substring_index("url", "#", 1))
    joined = pages.groupBy("source", "month").agg(F.array_join(F.array_sort(F.collect_list("raw")), "").alias("raw"))
    return induce.inductions(joined.select(F.concat_ws("#", "source", "month").alias("url"), "raw"), TODAY)


@_query(
    """with s as (select distinct snapshot_no, venue_id, title, start_date from event_snapshots where venue_id is not null and title is not null and start_date is not null), n as (select distinct snapshot_no from s),
  a as (select (snapshot_no + 1) || '|' || venue_id venue_id, title, start_date from s where snapshot_no + 1 in (select snapshot_no from n)), b as (select snapshot_no || '|' || venue_id venue_id, title, start_date from s where snapshot_no - 1 in (select snapshot_no from n)),
  j as (select coalesce(a.venue_id, b.venue_id) v, coalesce(a.title, b.title) t, a.venue_id is not null ia, b.venue_id is not null ib from a full join b on a.venue_id = b.venue_id and a.title = b.title and a.start_date = b.start_date),
  s2 as (select v, t, bool_or(ia) ha, bool_or(ib) hb, count(*) filter (where ia and ib) hit, count(*) filter (where ib) wanted from j group by 1, 2),
  c as (select v, count(*) filter (where ha and hb) shared, count(*) n, sum(hit) hit, sum(wanted) wanted, count(*) filter (where ha) na, count(*) filter (where hb) nb from s2 group by 1)
  select v venue_id, round(case when na = 0 or nb = 0 then 0 else least(shared / n, hit / wanted) end, 6) agreement from c where v is not null"""
)
def reader_agreement(spark: SparkSession, d: str) -> DataFrame:
    """FN-19: each snapshot as read, the next as reference, by snapshot and venue."""
    s = load(spark, d, "event_snapshots").where("venue_id is not null and title is not null and start_date is not null")
    known = s.select("snapshot_no").distinct()
    keyed = lambda df, n: df.withColumn("_n", n).select("_n", F.concat_ws("|", "_n", "venue_id").alias("venue_id"), "title", "start_date")
    read = keyed(s, F.col("snapshot_no") + 1).join(known, F.col("_n") == F.col("snapshot_no"), "left_semi")
    reference = keyed(s, F.col("snapshot_no")).join(known, F.col("_n") == F.col("snapshot_no") + 1, "left_semi")
    return induce.agreement(read, reference, "venue_id")


@_query()
def html_text(spark: SparkSession, d: str) -> DataFrame:
    p = _listings(spark, d)
    return p.select("url", ops.text_column(F.col("raw"), F.col("url")).alias("text"))


@_query(
    r"""with e as (select distinct on (uid) * from agenda_events order by uid, row_id),
  x as (select *, replace(replace(replace(replace(title, '\', '\\'), ';', '\;'), ',', '\,'), chr(10), '\n') t, coalesce(end_date, start_date) l from e where start_date is not null and title is not null)
  select uid, 'SUMMARY:' || t summary, case when start_min is not null and not coalesce(recurring, false) then 'DTSTART;TZID=Europe/Paris:' || strftime(start_date, '%Y%m%d') || 'T' || lpad(cast(start_min // 60 as varchar), 2, '0') || lpad(cast(start_min % 60 as varchar), 2, '0') || '00'
    else 'DTSTART;VALUE=DATE:' || strftime(start_date, '%Y%m%d') end dtstart, case when start_min is null or coalesce(recurring, false) then 'DTEND;VALUE=DATE:' || strftime(l + 1, '%Y%m%d') end dtend_day from x"""
)
def ics_lines(spark: SparkSession, d: str) -> DataFrame:
    """SNK-2, unfolded again, line by line."""
    e = runs.first_per_key(_events(spark, d), ["uid"], F.col("row_id")).where("start_date is not null and title is not null")
    v = sinks.ics_lines(e).select("uid", F.split(F.replace("vevent", F.lit("\r\n "), F.lit("")), "\r\n").alias("l"))
    line = lambda start: F.get(F.filter("l", lambda x: x.startswith(start)), F.lit(0))
    return v.select("uid", line("SUMMARY:").alias("summary"), line("DTSTART").alias("dtstart"), line("DTEND;VALUE=DATE").alias("dtend_day"))


@_query()
def evidence_windows(spark: SparkSession, d: str) -> DataFrame:
    docs = load(spark, d, "documents").where("text is not null")
    quotes = F.array(F.substring("text", 1, 20), F.substring(F.col("text"), F.greatest(F.lit(1), F.floor(F.length("text") * 2 / 3).cast("int")), F.lit(30)))
    return docs.select("doc_id", validate.evidence_windows(F.col("text"), quotes, 100).alias("context"))


@_query("""with p as (select o_custkey, o_orderkey, o_orderdate from orders), c as (select c_custkey, c_name, n_name from customer join nation on c_nationkey = n_nationkey)
  select c_custkey, c_name, n_name, count(o_orderkey) orders, max(o_orderdate) last_order from c left join p on c_custkey = o_custkey group by 1, 2, 3""")
def directory_counts(spark: SparkSession, d: str) -> DataFrame:
    """JN-3, JN-4 on the star schema: orders are counted before they are joined."""
    counted = load(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"), F.max("o_orderdate").alias("last_order"))
    c = load(spark, d, "customer").join(load(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.join(counted, "c_custkey", "left").select("c_custkey", "c_name", "n_name", F.coalesce("orders", F.lit(0)).alias("orders"), "last_order")


@_query("""with e as (select *, case when epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id order by ts, event_id) <= 1800000000 then 0 else 1 end fresh from events),
  s as (select *, sum(fresh) over (partition by user_id order by ts, event_id rows unbounded preceding) session_no from e)
  select user_id, session_no, count(*) n, min(event_id) first_event, epoch_us(max(ts)) - epoch_us(min(ts)) length_us from s group by 1, 2""")
def sessionize(spark: SparkSession, d: str) -> DataFrame:
    """DOC-6, ST-1 as sessions: a gap of more than half an hour starts a new one."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    e = load(spark, d, "events").withColumn("_us", us).withColumn("_new", F.when(F.col("_us") - F.lag("_us").over(w) <= 1_800_000_000, 0).otherwise(1))
    s = e.withColumn("session_no", F.sum("_new").over(w))
    return s.groupBy("user_id", "session_no").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"), (F.max("_us") - F.min("_us")).alias("length_us"))
