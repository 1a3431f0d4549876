"""Tables with a position per row, header clean-up, required columns, path catalogue and literal sources."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclasses.dataclass(frozen=True)
class Paths:
    """Where the stages of a pipeline keep their files."""

    root: str = "data"

    def __getattr__(self, name: str) -> str:
        if name in ("raw", "cleaned", "final", "output", "training", "models"):
            return f"{self.root}/{name}"
        raise AttributeError(name)


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.strip() for c in df.columns))


def require(df: DataFrame, *columns: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def with_position(df: DataFrame, pos: str = "pos") -> DataFrame:
    """An increasing position in reading order, without a shuffle: file order, then row order; it has gaps."""
    return df.withColumn(pos, F.monotonically_increasing_id())


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return trim_headers(spark.read.parquet(path))


def csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    r = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return trim_headers(r.schema(schema).csv(path) if schema else r.csv(path))


def literal(spark: SparkSession, values: list, column: str = "text") -> DataFrame:
    return spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"pos BIGINT, {column} STRING")


def splits(spark: SparkSession, paths: dict[str, str], schema: str = "instruction STRING, response STRING") -> DataFrame:
    """Several JSONL splits as one frame with a split column."""
    out = None
    for name, p in paths.items():
        one = spark.read.schema(schema).json(p).withColumn("split", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def first_rows(df: DataFrame, n: int, pos: str = "pos") -> DataFrame:
    return df.orderBy(pos).limit(n)
