"""Tables kept between runs: a new directory for each version and a pointer to the last."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions.text import slugify

VENUE = T.StructType(
    [
        *[T.StructField(n, T.StringType()) for n in ("id", "name", "city", "category", "map_name", "website", "instagram", "facebook")],
        T.StructField("web", T.BooleanType()), T.StructField("social", T.BooleanType()), T.StructField("lat", T.DoubleType()), T.StructField("lng", T.DoubleType()),
        T.StructField("location_filter", T.StringType()), T.StructField("all_screenings", T.BooleanType()), T.StructField("enabled", T.BooleanType()),
    ]
)


def read_venues(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: {"venues": [...]} with the defaults filled in. Entries without a name are left out."""
    v = spark.read.schema(T.StructType([T.StructField("venues", T.ArrayType(VENUE))])).option("multiLine", True).json(path).select(F.inline("venues"))
    return with_defaults(v.where("name is not null"))


def with_defaults(venues: DataFrame) -> DataFrame:
    return venues.withColumns(
        {
            "id": F.coalesce("id", slugify(F.col("name"))), "map_name": F.coalesce("map_name", "name"), "category": F.coalesce("category", F.lit("autre")),
            "web": F.coalesce("web", F.lit(True)), "social": F.coalesce("social", F.lit(True)), "all_screenings": F.coalesce("all_screenings", F.lit(False)), "enabled": F.coalesce("enabled", F.lit(True)),
        }
    )


class Store:
    """Versioned Parquet tables under one folder. A version is visible once its pointer is written, so a run that dies
    leaves the last whole one; the pointer is itself a one-row table, so any file system that Spark knows will do. Of two
    versions with one run's number the later written one counts."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _current(self, table: str, before: int | None = None) -> str | None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{table}/_pointers")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return None
        pointers = [(*s.getPath().getName().split("~"), s.getModificationTime()) for s in fs.listStatus(path)]
        runs = [(int(run), written, version) for run, version, written in pointers if before is None or int(run) < before]
        return f"{self.folder}/{table}/{max(runs)[2]}" if runs else None

    def read(self, table: str, schema: T.StructType | str, before: int | None = None) -> DataFrame:
        """The last version, or the last of the runs numbered below ``before``; an empty table where there is none."""
        at = self._current(table, before)
        kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        return self.spark.read.schema(kind).parquet(at) if at else self.spark.createDataFrame([], kind)

    def write(self, table: str, df: DataFrame, run: int) -> None:
        version = f"v{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder}/{table}/{version}")
        jvm = self.spark.sparkContext._jvm
        pointer = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{table}/_pointers/{run:012d}~{version}")
        fs = pointer.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(pointer.getParent())
        fs.create(pointer, True).close()
