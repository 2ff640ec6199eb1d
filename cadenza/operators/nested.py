"""Deeply nested records as related flat tables.

One depth-first pass emits a tagged row per object (and per scalar inside an array): the table tag, its own key, its
parent's key and its scalar fields. The visitor runs over JSON texts in Arrow batches; typed columns are pruned and
written as JSON inside the JVM first. ``flat_table`` applies a schema to one tag; ``write_flat`` writes all
of them, partitioned by tag.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLAT = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("tag", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("positions", T.StringType()),
        T.StructField("parent_path", T.StringType()),
        T.StructField("parent_positions", T.StringType()),
        T.StructField("payload", T.MapType(T.StringType(), T.StringType())),
    ]
)
SCALAR = "value"  # the payload's only key for a scalar inside an array


def _name(path: str) -> str:
    return path.rpartition(".")[2]


def _scalar(x: object) -> str:
    """A value as text; half a pair of surrogates, which no text may hold, becomes the replacement character."""
    return _sound(x) if isinstance(x, str) else json.dumps(x)


def _sound(s: str) -> str:
    return s if s.isascii() else s.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _no_number(name: str) -> object:
    raise ValueError(f"{name} is no JSON value")


def visit_json(text: str | None) -> Iterator[tuple[str, str, str, str | None, str, list[tuple[str, str]]]]:
    """(tag, path, positions, parent path, parent positions, payload) of each object, depth first, without recursion."""
    if text is None:
        return
    try:
        root = json.loads(text, parse_constant=_no_number)
    except (ValueError, RecursionError):
        return
    stack: list[tuple] = [(root, "", "", None, "")]
    while stack:
        x, path, at, parent, parent_at = stack.pop()
        if isinstance(x, dict):
            below, payload = [], []
            for name, v in x.items():
                k = _sound(name)
                if isinstance(v, (dict, list)):
                    below.append((v, f"{path}.{k}" if path else k, at, path, at))
                elif v is not None:
                    payload.append((k, _scalar(v)))
            yield _name(path), path, at, parent, parent_at, payload
            stack += reversed(below)
        elif isinstance(x, list):
            stack += [(v, path, f"{at}.{i}" if at else str(i), parent, parent_at) for i, v in reversed(list(enumerate(x)))]
        elif x is not None:
            yield _name(path), path, at, parent, parent_at, [(SCALAR, _scalar(x))]


def flatten_json(df: DataFrame, row: str, payload: str) -> DataFrame:
    """FLAT rows of JSON texts. Null, empty, invalid texts (NaN and Infinity are invalid) and such nested
    deeper than the parser goes emit nothing; of
    a repeated name the last value counts."""
    schema = pa.schema([("row_id", pa.int64()), *[(n, pa.string()) for n in FLAT.names[1:-1]], ("payload", pa.map_(pa.string(), pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in schema]
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for emitted in visit_json(text):
                    for column, v in zip(out, (key, *emitted), strict=True):
                        column.append(v)
                if len(out[0]) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)
                    out = [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return df.select(F.col(row).cast("bigint").alias("row_id"), F.col(payload).cast("string").alias("payload")).mapInArrow(run, FLAT)


def flatten_columns(df: DataFrame, row: str, columns: Sequence[str]) -> DataFrame:
    """FLAT rows of the nested ``columns`` (structs, arrays and maps, of any depth), as ``flatten_json`` emits them. The
    record's root has the path ''. A null object or field emits nothing, and rows without any nested value are dropped
    inside the JVM. Nothing is shuffled."""
    there = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(True)) for c in columns], F.lit(False))
    return flatten_json(df.where(there).select(F.col(row), F.to_json(F.struct(*columns)).alias("_nested")), row, "_nested")


def leaves(flat: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """(row_id, field_path, positions, leaf_value) of the non-empty values at the two-name paths ``wanted``, as
    ``location.name``, wherever they stand."""
    found = []
    for w in wanted:
        tag, field = w.rsplit(".", 1)
        path = F.when(F.col("path") == "", F.lit(field)).otherwise(F.concat("path", F.lit(f".{field}")))
        own = F.struct(path.alias("field_path"), F.try_element_at("payload", F.lit(field)).alias("leaf_value"))
        found.append(F.when((F.col("tag") == tag) & F.col("payload").isNotNull(), own))
        inside = (F.col("path") == w) | F.col("path").endswith(f".{w}")
        found.append(F.when(inside, F.struct(F.col("path").alias("field_path"), F.try_element_at("payload", F.lit(SCALAR)).alias("leaf_value"))))
    return (
        flat.where(F.col("tag").isin([n for w in wanted for n in w.split(".")]))
        .select("row_id", "positions", F.explode(F.array_compact(F.array(*found))).alias("_f"))
        .select("row_id", "_f.field_path", "positions", "_f.leaf_value")
        .where("leaf_value is not null and leaf_value <> ''")
    )


def flat_table(flat: DataFrame, tag: str, schema: str) -> DataFrame:
    """The rows of one tag with typed columns, and the keys that link them to their parent. A value that can't be read
    as its column's type is null."""
    fields = T._parse_datatype_string(schema).fields
    typed = [F.try_element_at("payload", F.lit(f.name)).try_cast(f.dataType).alias(f.name) for f in fields]
    return flat.where(F.col("tag") == tag).select("row_id", "path", "positions", "parent_path", "parent_positions", *typed)


def write_flat(flat: DataFrame, path: str) -> None:
    """All tables in one pass, partitioned by tag."""
    flat.write.partitionBy("tag").parquet(path)
