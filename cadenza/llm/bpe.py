"""Token ids of whole texts by a byte-level BPE vocabulary file.

The merges of a word are folded by Spark's higher-order functions over the array of its bytes' ids, with the vocabulary's
rank map as a literal: pairs of ids are hashed into buckets, so a lookup is an index and a short scan. The corpus's most
frequent distinct words (over all documents) are folded once and become a second literal map; a document is walked in
chunks of words, and in each only its other distinct words are folded, once, so that time grows with the text. Nothing but the word counts is shuffled. Words over ``LONG`` bytes, for which a fold
would take quadratic time, are merged with a heap in Arrow batches.
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.text import let
from cadenza.tables import spread

DEFAULT_VOCABULARY = os.environ.get("CADENZA_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.json"
# Fixed value: the published pattern that splits text before the merges; (?U) gives \s its Unicode meaning.
PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BUCKETS = 16_384  # a power of two
HOT_WORDS = 32_768  # at most so many distinct words are collected, each of at most HOT_BYTES
HOT_BYTES = 64
LONG = 512
CHUNK_WORDS = 256  # a text is walked in pieces of so many words, within which its other words are looked up
NONE = 2**31 - 1


def _byte_characters() -> list[str]:
    """The printable character by which byte-level vocabularies write each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256))
    shifted = {b: 256 + next(rest) for b in range(256) if b not in plain}
    return [chr(b if b in plain else shifted[b]) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    byte_ids: list[int]
    merges: dict[int, int]  # left id * 65536 + right id: merged id; smaller merged ids come first

    @classmethod
    def read(cls, path: str = DEFAULT_VOCABULARY) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, merges, last = model["vocab"], {}, -1
        for m in model["merges"]:
            a, b = m.split(" ") if isinstance(m, str) else m
            merged = vocab[a + b]
            if merged <= last or merged >= 65536:
                raise ValueError("merged ids must be below 65536 and rise with the rank")
            merges.setdefault(vocab[a] * 65536 + vocab[b], merged)
            last = merged
        return cls([vocab[c] for c in _byte_characters()], merges)


def _bucket(a: int, b: int) -> int:
    return (a * 31 + b * 7919) & (BUCKETS - 1)


def merge_long(data: bytes, vocabulary: Vocabulary) -> list[int]:
    """The same merges by a heap over a linked list, in O(n log n)."""
    ids: list[int | None] = [vocabulary.byte_ids[b] for b in data]
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := vocabulary.merges.get(ids[i] * 65536 + ids[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        m, i, a, b = heapq.heappop(heap)
        j = after[i] if ids[i] is not None else n
        if ids[i] != a or j >= n or ids[j] != b:
            continue
        ids[i], ids[j] = m, None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right < n and (k := vocabulary.merges.get(ids[left] * 65536 + ids[right])) is not None:
                heapq.heappush(heap, (k, left, ids[left], ids[right]))
    return [x for x in ids if x is not None]


def _long_words(vocabulary: Vocabulary) -> Callable:
    @F.pandas_udf("array<array<int>>")
    def run(words: pd.Series) -> pd.Series:
        return words.map(lambda ws: [merge_long(w.encode(), vocabulary) for w in ws], na_action="ignore")

    return run


def _literal(value: list, kind: str) -> Column:
    """A nested literal; the optimizer folds the parsing away."""
    return F.from_json(F.lit(json.dumps(value, separators=(",", ":"))), kind)


def _tables(vocabulary: Vocabulary) -> list[Column]:
    """The rank map and the ids of the bytes, as fields of a struct. It stands in an expression once, bound by ``let``: each
    copy would be written out in the plan's text and sent with every task."""
    keys: list[list[int]] = [[] for _ in range(BUCKETS)]
    values: list[list[int]] = [[] for _ in range(BUCKETS)]
    for pair, merged in vocabulary.merges.items():
        at = _bucket(pair >> 16, pair & 65535)
        keys[at].append(pair)
        values[at].append(merged)
    return [_literal(keys, "array<array<bigint>>").alias("keys"), _literal(values, "array<array<int>>").alias("values"), _literal(vocabulary.byte_ids, "array<int>").alias("bytes")]


def _ids_of(tables: Column) -> Callable[[Column], Column]:
    """The fold of a word's bytes, over the bound ``_tables``."""

    def rank(a: Column, b: Column) -> Column:
        at = (a * 31 + b * 7919).bitwiseAND(BUCKETS - 1)
        place = F.array_position(F.get(tables["keys"], at), a.cast("bigint") * 65536 + b) - 1
        return F.coalesce(F.get(F.get(tables["values"], at), place.cast("int")), F.lit(NONE))

    def step(state: Column, _: Column) -> Column:
        t, r = state.getField("t"), state.getField("r")
        best = F.array_min(r)

        def merged(p: Column) -> Column:  # p: place of the pair, from 1
            n = F.size(t)
            left = F.when(p > 1, F.array(rank(F.get(t, p - 2), best))).otherwise(F.array().cast("array<int>"))
            right = F.when(p + 1 < n, F.array(rank(best, F.get(t, p + 1)))).otherwise(F.array().cast("array<int>"))
            return F.struct(
                F.concat(F.slice(t, F.lit(1), p - 1), F.array(best), F.slice(t, p + 2, n)).alias("t"),
                F.concat(F.slice(r, F.lit(1), F.greatest(p - 2, F.lit(0))), left, right, F.slice(r, p + 2, n)).alias("r"),
            )

        return F.when(F.coalesce(best, F.lit(NONE)) == NONE, state).otherwise(merged(F.array_position(r, best).cast("int")))

    def ids_of(word: Column) -> Column:
        digits = F.hex(F.encode(word, "UTF-8"))
        n = F.octet_length(word)
        start = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(tables["bytes"], F.conv(F.substring(digits, i * 2 + 1, F.lit(2)), 16, 10).cast("int")))
        pairs = lambda t: F.transform(F.sequence(F.lit(0), n - 2), lambda i: rank(F.get(t, i), F.get(t, i + 1)))
        begin = F.transform(F.array(start), lambda t: F.struct(t.alias("t"), pairs(t).alias("r")))
        folded = F.aggregate(F.sequence(F.lit(1), n - 1), F.get(begin, F.lit(0)), step, lambda s: s.getField("t"))
        return F.when(n == 1, start).otherwise(folded)

    return ids_of


def split_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """(word, n) over all texts."""
    return df.select(F.explode(split_words(F.col(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _place(word: Column) -> Column:
    return F.hash(word).bitwiseAND(BUCKETS - 1)


def hot_words(df: DataFrame, text: str, tables: list[Column], k: int = HOT_WORDS) -> list[tuple[int, str, list[int]]]:
    """(bucket, word, ids) of the k most frequent words of the corpus: a cache of bounded size, on which no result depends."""
    top = word_counts(df, text).where((F.octet_length("word") <= HOT_BYTES) & (F.col("n") > 1)).orderBy(F.desc("n"), "word").limit(k)
    ids = let(F.struct(*tables), lambda t: _ids_of(t)(F.col("word")))
    return [(r.at, r.word, r.ids) for r in top.repartition("word").select(_place(F.col("word")).alias("at"), "word", ids.alias("ids")).collect()]


def encode(df: DataFrame, key: str, text: str, path: str = DEFAULT_VOCABULARY, out: str = "ids") -> DataFrame:
    """(key, ids): the ids of each whole text, without special tokens; their strings are ordinary text. Null and empty
    texts give the empty list. The vocabulary is read on the driver alone."""
    vocabulary = Vocabulary.read(path)
    tables = _tables(vocabulary)
    df = spread(df.select(key, text))
    words: list[dict[str, list[int]]] = [{} for _ in range(BUCKETS)]
    for at, word, word_ids in hot_words(df, text, tables):
        words[at][word] = word_ids
    tables.append(_literal(words, "array<map<string,array<int>>>").alias("hot"))
    empty = F.array().cast("array<array<int>>")
    split = df.select(F.col(key), split_words(F.col(text)).alias("_w"))
    # Words for which a fold would take quadratic time leave for Python once a document; most documents have none.
    long = F.filter(F.array_distinct("_w"), lambda w: F.octet_length(w) > LONG)
    parts = split.select(key, "_w", long.alias("_long"))
    parts = parts.withColumn("_long_ids", F.coalesce(_long_words(vocabulary)(F.when(F.size("_long") > 0, F.col("_long"))), empty))

    def place(words: Column, w: Column) -> Column:
        return (F.array_position(words, w) - 1).cast("int")

    def hot(t: Column, w: Column) -> Column:
        return F.try_element_at(F.get(t["hot"], _place(w)), w)

    def chunk_ids(t: Column, chunk: Column) -> Column:
        rare = F.filter(F.array_distinct(chunk), lambda w: hot(t, w).isNull() & (F.octet_length(w) <= LONG))
        # Bound as values before the words are walked: named inside the walk, they would be folded again for every word.
        bound = let(rare, lambda names: F.struct(names.alias("names"), F.transform(names, _ids_of(t)).alias("ids")))

        def walk(known: Column) -> Column:
            own = lambda w: F.get(known["ids"], place(known["names"], w))
            long_ids = lambda w: F.get(F.col("_long_ids"), place(F.col("_long"), w))
            return F.flatten(F.transform(chunk, lambda w: F.coalesce(hot(t, w), own(w), long_ids(w))))

        return let(bound, walk)

    n = F.size("_w")
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(CHUNK_WORDS))).otherwise(F.array().cast("array<int>"))
    chunk = lambda at: F.slice(F.col("_w"), at + 1, F.lit(CHUNK_WORDS))
    found = let(F.struct(*tables), lambda t: F.flatten(F.transform(starts, lambda at: let(chunk(at), lambda c: chunk_ids(t, c)))))
    return parts.select(key, F.coalesce(found, F.array().cast("array<int>")).alias(out))


def decode(ids: Column, path: str = DEFAULT_VOCABULARY) -> Column:
    """The text of an id list, by concatenating binary pieces. An unknown id gives null."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    byte_of = {c: b for b, c in enumerate(_byte_characters())}
    pieces = [""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        pieces[i] = bytes(byte_of[c] for c in token).hex()
    table = _literal(pieces, "array<string>")
    return F.decode(F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")), "UTF-8")


def vocabulary_ids(words: Sequence[str], path: str = DEFAULT_VOCABULARY) -> list[list[int]]:
    """Ids of words outside Spark, for tests and small lists."""
    vocabulary = Vocabulary.read(path)
    return [merge_long(w.encode(), vocabulary) for w in words]
