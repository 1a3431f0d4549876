"""Corpus curation: noise removal and two response filters, each one classified frame from which all outputs derive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palmleaf.functions import text as X
from palmleaf.operators.keep_first import keep_first, mark_first
from palmleaf.runtime import materialize

KEPT = "Kept"


def _texts(df: DataFrame, pos: str) -> DataFrame:
    return df.select(pos, *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"raw_{c[0]}") for c in ("instruction", "response")))


def improve(df: DataFrame, pos: str = "pos") -> DataFrame:
    """(pos, instruction, response, modified): spaces, commas, abbreviations, stray capitals and a trailing foreign word
    cleaned away; pairs with an empty side dropped; equal pairs dropped, the first one kept. Null counts as empty."""
    x = _texts(df, pos)
    x = x.select(pos, X.improve_text(F.col("raw_i")).alias("instruction"), X.improve_noise(X.improve_text(F.col("raw_r"))).alias("response"), "raw_r")
    x = materialize(x.filter((F.col("instruction") != "") & (F.col("response") != "")), "improved")
    x = keep_first(x, [F.col("instruction"), F.col("response")], pos)
    return x.select(pos, "instruction", "response", (F.col("response") != F.col("raw_r")).alias("modified"))


def improve_report(df: DataFrame, pos: str = "pos") -> DataFrame:
    """One row: pairs read, kept, modified, dropped as empty or duplicate, and how many still hold Latin (at most 20)."""
    x = _texts(df, pos).select(X.improve_text(F.col("raw_i")).alias("i"), X.improve_noise(X.improve_text(F.col("raw_r"))).alias("r"))
    zero = F.lit(0).cast("long")
    read = x.agg(F.count(F.lit(1)).alias("records"), F.count_if((F.col("i") == "") | (F.col("r") == "")).alias("dropped_empty"))
    kept = improve(df, pos).agg(F.count(F.lit(1)).alias("kept"), F.count_if("modified").alias("modified"), F.count_if(X.has_latin(F.col("response"))).alias("latin"))
    both = read.select("records", "dropped_empty", *(zero.alias(c) for c in ("kept", "modified", "latin"))).unionByName(kept.select(zero.alias("records"), zero.alias("dropped_empty"), "kept", "modified", "latin"))
    one = both.agg(*(F.sum(c).alias(c) for c in both.columns))
    return one.select("records", "kept", "modified", "dropped_empty", (F.col("records") - F.col("dropped_empty") - F.col("kept")).alias("duplicates_removed"), F.least("latin", F.lit(20)).alias("latin_left"))


def _classified(x: DataFrame, pos: str, reason, duplicate: str) -> DataFrame:
    """A reason per row: the given ones first, then duplicates among the survivors only. Cleaned once, written once."""
    x = materialize(x.withColumn("reason", reason), "classified")
    live = x.filter(F.col("reason").isNull())
    live = mark_first(live, [X.casefold(F.col("instruction")), X.casefold(F.col("cleaned_response"))], pos)
    live = live.withColumn("reason", F.when(F.col("is_first"), F.lit(KEPT)).otherwise(F.lit(duplicate))).drop("is_first")
    return x.filter(F.col("reason").isNotNull()).unionByName(live)


def classify_v1(df: DataFrame, pos: str = "pos", least: int = 2, foreign: str = X.LATIN) -> DataFrame:
    """(pos, instruction, cleaned_response, raw_i, raw_r, reason) by the first filter. Null counts as empty."""
    x = _texts(df, pos)
    x = x.select(pos, "raw_i", "raw_r", X.clean_instruction_v1(F.col("raw_i")).alias("instruction"), X.clean_response_v1(F.col("raw_r"), foreign).alias("cleaned_response"))
    short = (F.col("instruction") == "") | (F.length("cleaned_response") < max(least, 1))
    return _classified(x, pos, F.when(short, F.lit("Empty or too short after cleaning")), "Duplicate after cleaning")


def classify_v2(df: DataFrame, pos: str = "pos", least: int = 3, foreign: str = X.LATIN) -> DataFrame:
    """The same by the second filter, which also removes scanning residue."""
    x = _texts(df, pos)
    x = x.select(pos, "raw_i", "raw_r", X.clean_instruction_v2(F.col("raw_i")).alias("instruction"), X.clean_response_v2(F.col("raw_r"), foreign).alias("cleaned_response"))
    reason = F.when(F.col("instruction") == "", F.lit("Empty instruction")).when(X.is_garbage(F.col("cleaned_response"), least), F.lit("OCR garbage / too short"))
    return _classified(x, pos, reason, "Duplicate")


def kept(x: DataFrame, pos: str = "pos") -> DataFrame:
    return x.filter(F.col("reason") == KEPT).select(pos, "instruction", F.col("cleaned_response").alias("response"))


def removed(x: DataFrame, pos: str = "pos", cleaned: bool = True) -> DataFrame:
    cols = [F.col("raw_i").alias("instruction"), F.col("raw_r").alias("response"), *([F.col("cleaned_response")] if cleaned else []), F.col("reason")]
    return x.filter(F.col("reason") != KEPT).select(pos, *cols)


def filter_report(x: DataFrame, strip_raw: bool) -> DataFrame:
    """One row: rows per outcome, rows changed, and the recheck of what was kept."""
    is_kept = F.col("reason") == KEPT
    raw = X.strip(F.col("raw_r")) if strip_raw else F.col("raw_r")
    return x.agg(
        F.count(F.lit(1)).alias("records"), F.count_if(is_kept).alias("kept"), F.count_if(F.col("reason").startswith("Duplicate")).alias("duplicates"), F.count_if(~is_kept & ~F.col("reason").startswith("Duplicate")).alias("rejected"),
        F.count_if(is_kept & (F.col("cleaned_response") != raw)).alias("modified"), F.count_if(is_kept & X.has_latin(F.col("cleaned_response"))).alias("latin_left"), F.count_if(is_kept & X.has_repeated_mark(F.col("cleaned_response"))).alias("repeated_marks_left"),
    )
