"""JSON lines: strict, blank-skipping, numbered fail-fast and permissive readers, and the writer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palmleaf.functions.text import strip
from palmleaf.runtime import distributed_rank

PAIR = "instruction STRING, response STRING"


def read_strict(spark: SparkSession, path: str, schema: str = PAIR) -> DataFrame:
    """Every line must parse; an error ends the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value): 1-based numbers over all files in name order, blank lines counted."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_m"))
    ranked = distributed_rank(raw, None, [F.col("_f"), F.col("_b"), F.col("_m")], "line")
    return ranked.select((F.col("line") + 1).alias("line"), "value")


def read_skipping_blanks(spark: SparkSession, path: str, schema: str = PAIR) -> DataFrame:
    """Blank lines skipped; a bad line ends the read."""
    x = spark.read.text(path).filter(strip(F.col("value")) != "")
    return x.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_permissive(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, bad lines). records(line, kind, has_instruction, has_response, instruction, response, record): kind is
    OBJECT or what else the line holds. bad(line, error). Of a name given twice the last value counts."""
    x = read_lines(spark, path).filter(strip(F.col("value")) != "")
    typed = F.from_json("value", PAIR)
    opened = strip(F.col("value"))
    whole = F.try_parse_json(opened)
    # An object with a repeated name does not parse as a variant, but the typed reader takes it.
    twice = whole.isNull() & opened.startswith("{") & F.json_object_keys(opened).isNotNull()
    y = x.select("line", "value", whole.alias("v"), twice.alias("twice"), typed.alias("t"))
    bad = y.filter(F.col("v").isNull() & ~F.coalesce("twice", F.lit(False))).select("line", F.lit("not valid JSON").alias("error"), "value")
    good = y.filter(F.col("v").isNotNull() | F.col("twice"))
    is_object = F.col("twice") | F.schema_of_variant("v").startswith("OBJECT")
    keys = F.json_object_keys("value")
    records = good.select("line", F.when(is_object, F.lit("OBJECT")).otherwise(F.schema_of_variant("v")).alias("kind"), "value", "t", keys.alias("keys"))
    has = lambda c: F.coalesce(F.array_contains("keys", c), F.lit(False)) & (F.col("kind") == "OBJECT")
    return records.select("line", "kind", has("instruction").alias("has_instruction"), has("response").alias("has_response"), F.col("t.instruction").alias("instruction"), F.col("t.response").alias("response"), F.col("value").alias("record")), bad


def route(records: DataFrame) -> DataFrame:
    """A status per record: not an object, missing instruction, missing response, or to be validated; each record has
    the first that applies."""
    status = F.when(F.col("kind") != "OBJECT", "Record is not a JSON object").when(~F.col("has_instruction"), "Missing instruction").when(~F.col("has_response"), "Missing response").otherwise("Validate")
    return records.withColumn("status", status)


def read_checked(spark: SparkSession, path: str) -> DataFrame:
    """(line, instruction, response): fails at the first bad line or record without both texts, naming the line."""
    records, bad = read_permissive(spark, path)
    first = bad.agg(F.min("line")).first()[0]
    if first is not None:
        raise ValueError(f"line {first}: not valid JSON")
    empty = records.filter((F.col("kind") != "OBJECT") | (F.coalesce(strip(F.col("instruction")), F.lit("")) == "") | (F.coalesce(strip(F.col("response")), F.lit("")) == "")).agg(F.min("line")).first()[0]
    if empty is not None:
        raise ValueError(f"line {empty}: instruction or response is empty")
    return records.select("line", strip(F.col("instruction")).alias("instruction"), strip(F.col("response")).alias("response"))


def write(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One object per line, characters as they are; nulls are left out."""
    df.write.mode(mode).json(path)


def write_routed(df: DataFrame, reason: str, kept: str, paths: tuple[str, str]) -> None:
    """Kept rows to the first path, the others with their reason to the second. Materialise df before: it is read twice."""
    write(df.filter(F.col(reason) == kept).drop(reason), paths[0])
    write(df.filter(F.col(reason) != kept), paths[1])
