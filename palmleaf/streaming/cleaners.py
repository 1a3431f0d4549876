"""The stateless cleaners and the deduplication over streams of pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palmleaf.functions import text as X


def clean_stream(df: DataFrame, version: int = 1) -> DataFrame:
    """The response filters' cleaning, with the reason a pair is rejected or null; the same plan on a stream or a table."""
    i, r = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("instruction", "response"))
    if version == 1:
        out = df.withColumns({"clean_instruction": X.clean_instruction_v1(i), "clean_response": X.clean_response_v1(r)})
        bad = (F.col("clean_instruction") == "") | (F.length("clean_response") < 2)
        return out.withColumn("reason", F.when(bad, F.lit("Empty or too short after cleaning")))
    out = df.withColumns({"clean_instruction": X.clean_instruction_v2(i), "clean_response": X.clean_response_v2(r)})
    return out.withColumn("reason", F.when(F.col("clean_instruction") == "", F.lit("Empty instruction")).when(X.is_garbage(F.col("clean_response")), F.lit("OCR garbage / too short")))


def dedup_stream(df: DataFrame, time: str, delay: str = "1 day") -> DataFrame:
    """Pairs seen within the delay are dropped; state is bounded by the watermark."""
    keyed = df.withColumns({"_ki": X.casefold(F.col("clean_instruction")), "_kr": X.casefold(F.col("clean_response"))})
    return keyed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["_ki", "_kr"]).drop("_ki", "_kr")


def counts_by_window(df: DataFrame, time: str, width: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """Pairs per window of event time and reason, late ones up to the delay."""
    return df.withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), F.coalesce("reason", F.lit("Kept")).alias("reason")).agg(F.count(F.lit(1)).alias("pairs")).select(F.col("w.start").alias("window_start"), "reason", "pairs")
