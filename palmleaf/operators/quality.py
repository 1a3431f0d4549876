"""Corpus validation: counts, duplicate flags, suspicious records, and the verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palmleaf.functions import text as X
from palmleaf.operators.keep_first import mark_first

MIN_INSTRUCTION, MIN_RESPONSE, MAX_INSTRUCTION, MAX_RESPONSE = 2, 1, 500, 1000
REASONS = (("Contains English/Latin characters", X.has_latin), ("Contains dictionary abbreviation", X.has_abbreviation), ("Contains repeated punctuation", X.has_repeated_mark))


def _stripped(df: DataFrame, pos: str) -> DataFrame:
    return df.select(pos, *(X.strip(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in ("instruction", "response")), *(F.col(c).isNull().alias(f"null_{c}") for c in ("instruction", "response")))


def duplicate_flags(df: DataFrame, pos: str = "pos") -> DataFrame:
    """(pos, is_duplicate): pairs that an earlier row has too, ignoring case and outer spaces; empty ones included."""
    x = _stripped(df, pos)
    x = mark_first(x, [X.casefold(F.col("instruction")), X.casefold(F.col("response"))], pos)
    return x.select(pos, (~F.col("is_first")).alias("is_duplicate"))


def suspicious(df: DataFrame, pos: str = "pos") -> DataFrame:
    """(pos, instruction, response, reasons): responses with at least one reason, reasons in fixed order."""
    x = _stripped(df, pos)
    why = F.array_compact(F.array(*(F.when(test(F.col("response")), F.lit(name)) for name, test in REASONS)))
    return x.select(pos, "instruction", "response", why.alias("reasons")).filter(F.size("reasons") > 0)


def validate(df: DataFrame, pos: str = "pos", bad_lines: int = 0, missing_instruction: int = 0, missing_response: int = 0) -> DataFrame:
    """One row of counts and averages with PASS or FAIL. Lengths and suspicious responses are only warnings."""
    x = mark_first(_stripped(df, pos), [X.casefold(F.col("instruction")), X.casefold(F.col("response"))], pos)
    x = x.withColumns({"ni": F.length("instruction"), "nr": F.length("response")})
    flags = [test(F.col("response")) for _, test in REASONS]
    out = x.agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("ni") == 0).alias("empty_instruction"), F.count_if(F.col("nr") == 0).alias("empty_response"),
        F.count_if((F.col("ni") > 0) & (F.col("ni") < MIN_INSTRUCTION)).alias("short_instruction"), F.count_if((F.col("nr") > 0) & (F.col("nr") < MIN_RESPONSE)).alias("short_response"),
        F.count_if(F.col("ni") > MAX_INSTRUCTION).alias("long_instruction"), F.count_if(F.col("nr") > MAX_RESPONSE).alias("long_response"), F.count_if(flags[0] | flags[1] | flags[2]).alias("suspicious"),
        F.count_if(~F.col("is_first")).alias("duplicates"), F.coalesce(F.avg(F.when(F.col("ni") > 0, F.col("ni"))), F.lit(0.0)).alias("avg_instruction_length"), F.coalesce(F.avg(F.when(F.col("nr") > 0, F.col("nr"))), F.lit(0.0)).alias("avg_response_length"),
    )
    for name, n in (("bad_lines", bad_lines), ("missing_instruction", missing_instruction), ("missing_response", missing_response)):
        out = out.withColumn(name, F.lit(n).cast("long"))
    critical = sum((F.col(c) for c in ("missing_instruction", "missing_response", "empty_instruction", "empty_response", "duplicates")), F.col("bad_lines"))
    return out.withColumn("critical", critical).withColumn("status", F.when(F.col("critical") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")))
