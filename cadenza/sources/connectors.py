"""Where the network and the models would be: protocols, and implementations over
tables, so that every plan runs offline."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cadenza.html.ops import links_column, text_column


class Fetcher(Protocol):
    def fetch(self, urls: DataFrame) -> DataFrame:
        """(url, kind, raw, error) of each requested (url, kind)."""


class Verifier(Protocol):
    def judge(self, events: DataFrame) -> DataFrame:
        """(uid, verdict, reason); a missing row is no verdict."""


class TableFetcher:
    """Documents that were fetched before."""

    def __init__(self, documents: DataFrame) -> None:
        self.documents = documents.select("url", "raw")

    def fetch(self, urls: DataFrame) -> DataFrame:
        found = urls.join(self.documents, "url", "left")
        return found.select("url", "kind", "raw", F.when(F.col("raw").isNull(), "not found").alias("error"))


class TableVerifier:
    def __init__(self, verdicts: DataFrame) -> None:
        self.verdicts = verdicts

    def judge(self, events: DataFrame) -> DataFrame:
        return events.select("uid").join(self.verdicts, "uid").select("uid", "verdict", "reason")


def to_documents(bodies: DataFrame) -> DataFrame:
    """SRC-6: (url, kind, raw) with ``text`` and ``links``: read from the markup of html, the body itself otherwise."""
    html = F.col("kind") == "html"
    raw = F.when(html, F.col("raw"))
    return bodies.withColumn("text", F.when(html, text_column(raw, F.col("url"))).otherwise(F.col("raw"))).withColumn(
        "links", F.coalesce(F.when(html, links_column(raw, F.col("url"))), F.array().cast("array<string>"))
    )


def last_cursor(text: Column, pattern: str) -> Column:
    """SRC-7: the last match of the cursor pattern (its first group)."""
    import re

    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(1 if re.compile(pattern).groups else 0)), F.lit(-1))


def with_more_pages(pages: DataFrame, fragments: DataFrame, pattern: str, most: int = 12) -> DataFrame:
    """SRC-7 over a table of answers: ``pages`` (url, raw), ``fragments`` (url, cursor, html, more). From a page's last
    cursor on, answers are followed until there is none, a cursor comes again, a fragment is empty, ``more`` is false or
    ``most`` pages are reached; the fragments go before the page's last </body>. Each round is one join by (url, cursor).
    """
    answers = fragments.select(F.col("url").alias("_u"), F.col("cursor").alias("_c"), "html", "more").dropDuplicates(["_u", "_c"])
    empty = F.array().cast("array<string>")
    state = pages.select("url", "raw", last_cursor(F.col("raw"), pattern).alias("cursor"), empty.alias("seen"), empty.alias("parts"))
    for _ in range(most):
        usable = F.col("cursor").isNotNull() & ~F.array_contains("seen", F.col("cursor"))
        joined = state.join(answers, (F.col("url") == F.col("_u")) & (F.col("cursor") == F.col("_c")), "left")
        came = F.coalesce(usable & F.col("html").isNotNull() & (F.trim("html") != ""), F.lit(False))
        following = F.when(came & F.coalesce("more", F.lit(False)), last_cursor(F.col("html"), pattern))
        state = joined.select("url", "raw", following.alias("cursor"), F.when(came, F.array_append("seen", F.col("cursor"))).otherwise(F.col("seen")).alias("seen"), F.when(came, F.array_append("parts", F.col("html"))).otherwise(F.col("parts")).alias("parts"))
    added = F.array_join("parts", "\n")
    at = F.length("raw") - F.length(F.substring_index(F.lower("raw"), "</body>", -1)) - 7
    whole = F.when(F.size("parts") == 0, F.col("raw")).when(F.lower("raw").contains("</body>"), F.concat(F.left("raw", at), F.lit("\n"), added, F.lit("\n"), F.col("raw").substr(at + 1, F.length("raw")))).otherwise(F.concat("raw", F.lit("\n"), added))
    return state.select("url", whole.alias("raw"), F.size("parts").alias("pages_added"))


def usable_images(fetched: DataFrame, most_bytes: int = 10 * 1024 * 1024) -> DataFrame:
    """SRC-16: (url, status, content_type, bytes) with the reason for which a picture can't be used."""
    reason = (
        F.when(F.col("status") != 200, F.concat(F.lit("HTTP "), F.col("status").cast("string")))
        .when(~F.coalesce(F.col("content_type").startswith("image/"), F.lit(False)), "not an image").when(F.col("bytes") > most_bytes, "too big")
    )
    return fetched.withColumn("problem", reason)


class HttpDocuments(DataSource):
    """SRC-5 as a data source: spark.read.format("http_documents").option("urls", "a b").load(); an address per partition.
    Answers that fail are rows with an error."""

    @classmethod
    def name(cls) -> str:
        return "http_documents"

    def schema(self) -> str:
        return "url string, raw string, error string"

    def reader(self, schema: object) -> DataSourceReader:
        return _HttpReader(self.options.get("urls", "").split(), float(self.options.get("timeout", "40")))


class _HttpReader(DataSourceReader):
    def __init__(self, urls: list[str], timeout: float) -> None:
        self.urls, self.timeout = urls, timeout

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(u) for u in self.urls]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import urllib.request

        try:
            request = urllib.request.Request(partition.value, headers={"Accept-Language": "fr-FR,fr;q=0.9"})
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:  # noqa: S310
                yield partition.value, answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace"), None
        except (OSError, ValueError) as e:
            yield partition.value, None, f"{type(e).__name__}: {e}"
