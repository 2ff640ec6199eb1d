"""Passages of evaluation items inside training documents.

Every Arrow batch of documents is a shard (or several, where its texts are very long). Its words are mapped to the numbers of the items' vocabulary; runs too short
to hold a passage are dropped, and a suffix array is built over the rest. Every suffix of every item is then searched
in it by bisection, all at once; from the suffixes that share its first words the longest verbatim matches and their
places are read. Documents are neither shuffled nor joined.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 13  # consecutive words of an item that make a leak
BLOCK_ITEMS = 20_000  # items searched in one pass; more are searched in blocks, each in a pass of its own
BLOCK_CHARS = 32_000_000
SHARD_CHARS = 32_000_000

_BREAK = re.compile(r"</?(?:br|p|div|li|ul|ol|tr|td|th|h[1-6]|hr|blockquote)\b[^<>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
_LINK = re.compile(r"!?\[([^\[\]]*)\]\([^()\s]*\)")
_EMPHASIS = re.compile(r"\*+|~~|`+|(?<![^\W_])_+|_+(?![^\W_])")
_MARKS = re.compile(r"[̀-ͯ᪰-᫿᷀-᷿⃐-⃿︀-️]+")
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """Words: unbroken runs of letters and digits, without case, accents and inline markup. Null gives none."""
    if not text:
        return []
    if "<" in text:
        text = _TAG.sub("", _BREAK.sub(" ", text))
    if "&" in text:
        text = html.unescape(text)
    if "](" in text:
        text = _LINK.sub(r"\1", text)
    if "*" in text or "_" in text or "`" in text or "~" in text:
        text = _EMPHASIS.sub("", text)
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFD", text))
    return _WORD.findall(text.casefold())


class Items:
    """A block of evaluation items as numbers: the query suffixes."""

    def __init__(self, rows: list[tuple[int, str | None]], least: int) -> None:
        self.least = least
        self.number: dict[str, int] = {}
        ids, items, starts = [], [], []
        for item, text in rows:
            seq = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            for i in range(len(seq) - least + 1):
                items.append(item)
                starts.append((len(ids) + i, i))
            ids += [*seq, 0]
        self.ids = np.array([*ids, *[0] * least], np.int64)
        self.item = np.array(items, np.int64)
        self.at = np.array([a for a, _ in starts], np.int64)
        self.word = np.array([w for _, w in starts], np.int64)


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their first ``depth`` numbers or more, by prefix doubling."""
    rank, width = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1, 1
    order = np.argsort(rank, kind="stable")
    while width < depth:
        second = np.zeros_like(rank)
        second[:-width] = rank[width:]
        order = np.lexsort((second, rank))
        new = np.empty_like(rank)
        step = (rank[order][1:] != rank[order][:-1]) | (second[order][1:] != second[order][:-1])
        new[order] = np.concatenate(([1], 1 + np.cumsum(step)))
        rank, width = new, width * 2
        if rank.max() == len(rank):
            break
    return order


def _bound(ids: np.ndarray, order: np.ndarray, queries: np.ndarray, right: bool) -> np.ndarray:
    """For each query (a row of words), the first place in ``order`` whose words are not less (or greater, if right)."""
    lo, hi = np.zeros(len(queries), np.int64), np.full(len(queries), len(order), np.int64)
    width = np.arange(queries.shape[1])
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) // 2
        there = ids[order[mid][:, None] + width]
        differ = there != queries[open_]
        first = differ.argmax(1)
        rows = np.arange(len(open_))
        less = np.where(differ[rows, first], there[rows, first] < queries[open_][rows, first], right)
        lo[open_[less]] = mid[less] + 1
        hi[open_[~less]] = mid[~less]


def search(texts: list[str | None], items: Items) -> list[tuple[int, int, int, int, int]]:
    """(place in texts, item id, words matched, first word in the text, first word in the item): the longest match of
    each pair that reaches ``items.least`` words."""
    parts, docs, offsets, total = [], [], [], 0
    for d, text in enumerate(texts):
        found = words_of(text)
        if len(found) < items.least:
            continue
        seq = np.array([items.number.get(w, 0) for w in found], np.int64)
        cuts = np.flatnonzero(np.diff(np.concatenate(([0], (seq > 0).astype(np.int8), [0]))))
        for s, e in zip(cuts[::2], cuts[1::2], strict=True):
            if e - s >= items.least:
                parts.append(np.append(seq[s:e], 0))
                docs.append(np.full(e - s + 1, d))
                offsets.append(np.arange(s, e + 1))
                total += e - s + 1
    if not total or not len(items.at):
        return []
    least = items.least
    ids = np.concatenate([*parts, np.zeros(least, np.int64)])
    doc, offset = np.concatenate(docs), np.concatenate(offsets)
    order = suffix_array(ids, least)
    order = order[order < total]
    queries = items.ids[items.at[:, None] + np.arange(least)]
    lo, hi = _bound(ids, order, queries, False), _bound(ids, order, queries, True)
    hits = np.flatnonzero(hi > lo)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for q in hits:
        a, item = int(items.at[q]), int(items.item[q])
        for p in order[lo[q] : hi[q]]:
            if offset[p] and items.word[q] and ids[p - 1] == items.ids[a - 1] and p and doc[p - 1] == doc[p]:
                continue  # the match begins a word earlier
            n = least
            while ids[p + n] and ids[p + n] == items.ids[a + n]:
                n += 1
            key = (int(doc[p]), item)
            if key not in best or n > best[key][0]:
                best[key] = (n, int(offset[p]), int(items.word[q]))
    return [(d, item, *found) for (d, item), found in best.items()]


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[str | None]]]:
    """(keys, texts) of at most a batch, cut where their texts exceed SHARD_CHARS."""
    for b in batches:
        keys, texts, chars = [], [], 0
        for k, t in zip(b.column(0), b.column(1), strict=True):
            keys.append(k.as_py())
            texts.append(t.as_py())
            chars += len(texts[-1] or "")
            if chars > SHARD_CHARS:
                yield keys, texts
                keys, texts, chars = [], [], 0
        yield keys, texts


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple[int, str]]]:
    block: list[tuple[int, str]] = []
    chars = 0
    for r in items.where(F.col(text).isNotNull()).select(F.col(key).cast("bigint"), F.col(text)).toLocalIterator():
        block.append((r[0], r[1]))
        chars += len(r[1])
        if len(block) >= BLOCK_ITEMS or chars >= BLOCK_CHARS:
            yield block
            block, chars = [], 0
    if block:
        yield block


def leaks(documents: DataFrame, doc_key: str, doc_text: str, items: DataFrame, item_key: str, item_text: str, least: int = WORDS) -> DataFrame:
    """(doc_id, item_id, words, doc_word, item_word): the longest passage of an item in a document, from ``least`` words.

    Places count words from 0. Null and empty texts, and items shorter than ``least`` words, match nothing. The items
    are the query set and travel to the tasks in blocks of a fixed size; keys must be unique.
    """
    spark = documents.sparkSession
    schema = "doc_id bigint, item_id bigint, words int, doc_word int, item_word int"
    out_type = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("words", pa.int32()), ("doc_word", pa.int32()), ("item_word", pa.int32())])
    texts = documents.select(F.col(doc_key).cast("bigint").alias("doc_id"), F.col(doc_text).alias("text"))
    result = None
    for block in _blocks(items, item_key, item_text):
        held = spark.sparkContext.broadcast(Items(block, least))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for keys, texts in shards(batches):
                rows = [(keys[d], *rest) for d, *rest in search(texts, held.value)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 5, out_type, strict=True)], schema=out_type)

        part = texts.mapInArrow(run, schema)
        result = part if result is None else result.unionByName(part)
    return spark.createDataFrame([], schema) if result is None else result


def without_leaks(documents: DataFrame, doc_key: str, found: DataFrame) -> DataFrame:
    """The documents in which no item was found."""
    return documents.join(found.select(F.col("doc_id").alias(doc_key)).distinct(), doc_key, "left_anti")
