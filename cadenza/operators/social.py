"""Posts and structured events of social networks."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.text import clip

ZONE = "Europe/Paris"
MOST_IMAGES = 4
LAST_SECOND = 253_402_300_800  # the year 10000
POST_DAYS, FAILURE_DAYS = 180, 30
WINDOW_LEAST, WINDOW_MOST = 7, 30
INTERVAL = {"facebook-events": 7}  # days between two fetches; others 1
# Parts of a network's addresses that name no account.
_IG_PATHS = ("p", "reel", "reels", "explore", "stories", "accounts", "tv")


def coerce_timestamp(value: Column) -> Column:
    """SRC-13: an epoch number or an ISO text, with or without zone (then UTC), as an instant; null if unreadable."""
    text = F.trim(value.cast("string"))
    seconds = text.try_cast("double")
    epoch = F.timestamp_seconds(F.when(F.abs(seconds) < LAST_SECOND, seconds))
    iso = F.regexp_replace(text, "[zZ]$", "+00:00")
    has_zone = iso.rlike(r"[+-]\d{2}:?\d{2}$")
    zoned = F.when(has_zone, iso).otherwise(F.concat(iso, F.when(F.length(iso) == 10, F.lit("T00:00:00+00:00")).otherwise(F.lit("+00:00"))))
    return F.when(text.rlike(r"^-?\d+(\.\d+)?$"), epoch).when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}|$)"), zoned.try_cast("timestamp"))


def _images(*parts: Column) -> Column:
    every = F.concat(*[F.coalesce(p, F.array().cast("array<string>")) for p in parts])
    return F.slice(F.array_distinct(F.filter(every, lambda u: u.isNotNull() & u.rlike("^https?://"))), 1, MOST_IMAGES)


def instagram_posts(items: DataFrame) -> DataFrame:
    """SRC-10: (platform, id, url, published, text, image_urls). Error items, and items without id or readable time, are
    left out."""
    key = F.coalesce(F.nullif(F.col("id"), F.lit("")), F.nullif(F.col("shortCode"), F.lit("")))
    at = coerce_timestamp(F.col("timestamp"))
    children = F.transform(F.coalesce("childPosts", F.array().cast(items.schema["childPosts"].dataType)), lambda c: c["displayUrl"])
    return (
        items.where(F.col("error").isNull())
        .select(
            F.lit("instagram").alias("platform"), key.alias("id"),
            F.coalesce("url", F.concat(F.lit("https://www.instagram.com/p/"), F.col("shortCode"), F.lit("/"))).alias("url"),
            at.alias("published"), F.coalesce("caption", F.lit("")).alias("text"),
            _images(F.array("displayUrl"), F.col("images"), children).alias("image_urls"),
        )
        .where("id is not null and published is not null")
    )


def facebook_posts(items: DataFrame) -> DataFrame:
    """SRC-11: as above; of each medium the full picture comes before its thumbnail; ``image_text`` has the distinct
    texts read from the pictures, one a line."""
    media = F.coalesce("media", F.array().cast(items.schema["media"].dataType))
    pictures = F.transform(media, lambda m: F.coalesce(m["photo_image"]["uri"], m["thumbnail"]))
    read = F.array_distinct(F.filter(F.transform(media, lambda m: F.trim(m["ocrText"])), lambda t: t.isNotNull() & (t != "")))
    return items.select(
        F.lit("facebook").alias("platform"), F.col("postId").alias("id"), "url", coerce_timestamp(F.col("time")).alias("published"),
        F.coalesce("text", F.lit("")).alias("text"), _images(pictures).alias("image_urls"), F.array_join(read, "\n").alias("image_text"),
    ).where("id is not null and id <> '' and published is not null")


def facebook_events(items: DataFrame) -> DataFrame:
    """SRC-12: structured events with an id and a name, flat."""
    return items.where("id is not null and name is not null and id <> '' and trim(name) <> ''").select(
        "id", "url", F.trim("name").alias("name"), coerce_timestamp(F.col("utcStartDate")).alias("start"), F.col("dateTimeSentence").alias("date_sentence"),
        F.coalesce("description", F.lit("")).alias("description"), F.col("location.name").alias("location_name"), F.coalesce("isCanceled", F.lit(False)).alias("cancelled"),
        F.coalesce("isPast", F.lit(False)).alias("is_past"), "duration", F.col("ticketsInfo.price").alias("price"), F.col("ticketsInfo.buyUrl").alias("ticket_url"), F.col("imageUrl").alias("image_url"),
    )


def event_rows(events: DataFrame) -> DataFrame:
    """FN-18: structured events as agenda rows in local time; a duration of N days ends N - 1 days later."""
    local = F.from_utc_timestamp("start", ZONE)
    days = F.regexp_extract(F.coalesce("duration", F.lit("")), r"(?i)(\d+)\s*days?", 1).try_cast("int")
    first = F.to_date(local)
    return events.where("start is not null").select(
        "id", F.col("name").alias("title"), first.alias("start_date"), (F.hour(local) * 60 + F.minute(local)).alias("start_min"),
        F.when(days > 1, F.date_add(first, days - 1)).alias("end_date"), "location_name", "url", "price", F.nullif(clip(F.col("description"), 200), F.lit("")).alias("summary"),
    )


def actor_result(items: Column) -> Column:
    """SRC-8: of a run's items (structs with ``error``): struct(usable, error). All of kind no_results is an empty run;
    other errors without a usable item are the run's error."""
    good = F.filter(items, lambda x: x["error"].isNull())
    bad = F.filter(items, lambda x: x["error"].isNotNull() & (x["error"] != "no_results"))
    return F.struct(good.alias("usable"), F.when((F.size(good) == 0) & (F.size(bad) > 0), F.get(bad, F.lit(0))["error"]).alias("error"))


def instagram_request(profile: Column, since: Column, limit: int) -> Column:
    """SRC-9: an actor's input as JSON."""
    fixed = [F.lit("posts").alias("resultsType"), F.lit(limit).alias("resultsLimit"), since.cast("string").alias("onlyPostsNewerThan"), F.lit(False).alias("addParentData")]
    return F.to_json(F.struct(F.array(profile).alias("directUrls"), *fixed))


def facebook_posts_request(page: Column, since: Column, limit: int) -> Column:
    """SRC-9."""
    start = F.array(F.struct(page.alias("url"))).alias("startUrls")
    return F.to_json(F.struct(start, F.lit(limit).alias("resultsLimit"), F.lit(False).alias("captionText"), since.cast("string").alias("onlyPostsNewerThan")))


def facebook_events_request(page: Column, limit: int) -> Column:
    """SRC-9: of the page's upcoming events."""
    return F.to_json(F.struct(F.array(F.concat(F.rtrim(page, F.lit("/")), F.lit("/upcoming_hosted_events"))).alias("startUrls"), F.lit(limit).alias("maxEvents")))


def _account(value: Column, site: str, name: str) -> Column:
    """The account named by an address of the site, or the value itself without an @ before and slashes around it."""
    linked = F.regexp_extract(value, rf"(?i){site}\.com/({name})", 1)
    bare = F.btrim(F.ltrim(F.btrim(value), F.lit("@")), F.lit("/"))
    return F.btrim(F.when(linked != "", linked).otherwise(bare), F.lit("/"))


def instagram_handle(value: Column) -> Column:
    """SRC-14: an address, @name or name as the account's address; null for addresses of posts and the like, and where
    nothing is named."""
    name = _account(value, "instagram", r"[A-Za-z0-9_.]+")
    return F.when((name != "") & ~name.contains("/") & ~F.lower(name).isin(*_IG_PATHS), F.concat(F.lit("https://www.instagram.com/"), name, F.lit("/")))


def facebook_handle(value: Column) -> Column:
    """SRC-14: as above; one page behind the account (its events, posts or about page) is taken off."""
    name = F.regexp_replace(_account(value, "facebook", r"[^?#\s]+"), r"/(?:events|upcoming_hosted_events|past_hosted_events|posts|about)$", "")
    return F.when(name != "", F.concat(F.lit("https://www.facebook.com/"), name, F.lit("/")))


def last_ok_after(previous: Column, fetched_ok: Column, pending: Column, today: datetime.date) -> Column:
    """ST-9: the day from which the next fetch counts: today after a good fetch, but what it was before where posts were
    deferred or not available (``pending`` of them), so that they are asked for again."""
    return F.when(F.coalesce(fetched_ok, F.lit(False)) & (F.coalesce(pending, F.lit(0)) == 0), F.lit(today)).otherwise(previous)


def venue_sources(venues: DataFrame, discovered: DataFrame) -> DataFrame:
    """SRC-15, JN-4: (venue_id, kind, handle): an Instagram source and two of Facebook; the venue's own entry wins over the
    discovered one (``discovered``: venue_id, instagram, facebook)."""
    d = discovered.select(F.col("venue_id").alias("id"), F.col("instagram").alias("_ig"), F.col("facebook").alias("_fb"))
    known = venues.join(d, "id", "left").select(F.col("id").alias("venue_id"), instagram_handle(F.coalesce("instagram", "_ig")).alias("ig"), facebook_handle(F.coalesce("facebook", "_fb")).alias("fb"))
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("handle")) for k, c in (("instagram", "ig"), ("facebook", "fb"), ("facebook-events", "fb"))])
    return known.select("venue_id", F.inline(rows)).where("handle is not null")


def fetch_window(last_ok: Column, today: datetime.date) -> Column:
    """FL-9: the day from which posts are asked for."""
    now = F.lit(today)
    oldest = F.date_sub(now, WINDOW_MOST)
    return F.greatest(oldest, F.least(F.date_sub(F.coalesce(last_ok, oldest), 2), F.date_sub(now, WINDOW_LEAST)))


def is_due(kind: Column, last_fetched: Column, today: datetime.date) -> Column:
    """FL-9."""
    interval = F.when(kind == "facebook-events", INTERVAL["facebook-events"]).otherwise(1)
    return last_fetched.isNull() | (F.datediff(F.lit(today), last_fetched) >= interval)


def not_cached(posts: DataFrame, cache: DataFrame) -> DataFrame:
    """FL-10, JN-5: posts that were never analysed."""
    return posts.join(cache.select("platform", "id"), ["platform", "id"], "left_anti")


def kept(df: DataFrame, on: str, today: datetime.date, days: int = POST_DAYS) -> DataFrame:
    """FL-16: rows not older than the retention."""
    return df.where(F.datediff(F.lit(today), F.col(on)) <= days)


def retry(urls: DataFrame, failures: DataFrame, today: datetime.date, days: int = 14) -> DataFrame:
    """FL-15, ST-11: ``urls`` with ``decision``: cached, skip (failed within ``days``) or download."""
    recent = failures.where(F.datediff(F.lit(today), F.col("failed_on")) < days).select("url").distinct().withColumn("_failed", F.lit(True))
    decision = F.when(F.coalesce("cached", F.lit(False)), "cached").when(F.col("_failed").isNotNull(), "skip").otherwise("download")
    return urls.join(recent, "url", "left").withColumn("decision", decision).drop("_failed")


def rebuild(post_events: DataFrame, today: datetime.date) -> DataFrame:
    """ST-7: of each source's cached events (source_key, published, pos, title_key, start_date, end_date, verdict, url,
    post_url, image_urls) the upcoming accepted ones, the latest post winning a title and day; the url defaults to the
    post's, the image is its first."""
    usable = post_events.where((F.col("verdict").isNull() | (F.col("verdict") == "accept")) & (F.coalesce("end_date", "start_date") >= F.lit(today)))
    keys = ["source_key", "title_key", "start_date"]
    rest = [c for c in usable.columns if c not in keys]
    best = usable.groupBy(*keys).agg(F.max(F.struct("published", "pos", F.struct(*rest).alias("row"))).alias("b")).select(*keys, "b.row.*")
    return best.withColumn("url", F.coalesce("url", "post_url")).withColumn("image_source", F.get("image_urls", F.lit(0)))


def published_elsewhere(events: DataFrame, published: DataFrame, today: datetime.date) -> DataFrame:
    """FL-12: events that no other source brought in this run."""
    other = published.where(F.col("last_seen") == F.lit(today)).select(F.col("uid").alias("_u"), F.col("source_url").alias("_s")).distinct()
    return events.join(other, (F.col("uid") == F.col("_u")) & (F.col("source_url") != F.col("_s")), "left_anti")
