"""Dictionary curation: cleaning, standardising, rule issues, fixes, and expansion into instruction pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palmleaf.functions import arrays as A
from palmleaf.functions import text as X
from palmleaf.operators.keep_first import keep_first, reindex


def clean(df: DataFrame, pos: str = "pos", missing: str = "pandas") -> DataFrame:
    """Rows with a missing column dropped; texts stripped, spaces collapsed, zero-width characters removed; repeated
    rows dropped, the first one kept; empty texts dropped; re-indexed. missing="sql" takes only null for missing.
    """
    value = X.na_to_null if missing == "pandas" else (lambda c: c)
    x = df.select(pos, *(value(F.col(c).cast("string")).alias(c) for c in ("english", "tulu"))).na.drop(subset=["english", "tulu"])
    for c in ("english", "tulu"):
        x = x.withColumn(c, X.clean_unicode(X.collapse_spaces(X.strip(F.col(c)))))
    x = keep_first(x, [F.col("english"), F.col("tulu")], pos).filter((F.col("english") != "") & (F.col("tulu") != ""))
    return reindex(x, pos).select("row_index", "english", "tulu")


def standardize(df: DataFrame, pos: str = "pos") -> DataFrame:
    """Comma and space notation made uniform, repeated rows dropped. A missing text becomes the word nan, as it is
    written by the tool chain this follows."""
    x = df.select(pos, *(X.standardize(F.coalesce(X.na_to_null(F.col(c).cast("string")), F.lit("nan"))).alias(c) for c in ("english", "tulu")))
    return keep_first(x, [F.col("english"), F.col("tulu")], pos)


# Rule, suggested fix and severity of each issue, in the order in which issues are reported.
RULES = (
    ("english", "Missing Value", "Fill the missing English word", "High"),
    ("tulu", "Missing Value", "Fill the missing Tulu meaning", "High"),
    ("tulu", "English Found in Tulu", "Review manually", "Low"),
    ("english", "Digits Found", "Remove digits", "Medium"),
    ("tulu", "Digits Found", "Remove digits", "Medium"),
    ("tulu", "Special Character", "Remove special character", "Medium"),
    ("tulu", "Duplicate Meaning", "Keep one occurrence", "Medium"),
    ("tulu", "Consecutive Commas", "Replace with single comma", "Medium"),
    ("tulu", "Multiple Spaces", "Replace with single space", "Low"),
)


def _condition(issue: str, c: Column) -> Column:
    return {
        "Missing Value": lambda: (c == "") | (F.lower(c) == "nan"), "English Found in Tulu": lambda: X.has_latin(c), "Digits Found": lambda: X.has_digit(c), "Special Character": lambda: X.has_special(c),
        "Duplicate Meaning": lambda: A.has_duplicates(A.meanings(c)), "Consecutive Commas": lambda: X.has_double_comma(c), "Multiple Spaces": lambda: X.has_double_space(c),
    }[issue]()


def issues(df: DataFrame, pos: str = "pos") -> DataFrame:
    """(row_no, rule_no, column_name, original_value, issue, suggested_fix, severity): one row per rule an entry breaks."""
    x = df.select((F.col(pos) + 2).alias("row_no"), *(X.strip(F.coalesce(X.na_to_null(F.col(c).cast("string")), F.lit("nan"))).alias(c) for c in ("english", "tulu")))
    found = []
    for k, (col, issue, fix, severity) in enumerate(RULES):
        name = col.capitalize()
        row = F.struct(F.lit(k + 1).alias("rule_no"), F.lit(name).alias("column_name"), F.col(col).alias("original_value"), F.lit(issue).alias("issue"), F.lit(fix).alias("suggested_fix"), F.lit(severity).alias("severity"))
        found.append(F.when(_condition(issue, F.col(col)), row))
    return x.select("row_no", F.explode(F.array_compact(F.array(*found))).alias("i")).select("row_no", "i.*")


def count_by(df: DataFrame, column: str) -> DataFrame:
    """Value counts, nulls dropped."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def _apply(issue: Column | str, c: Column) -> Column:
    plain = {"Digits Found": X.remove_digits(c), "Special Character": X.remove_special(c), "Duplicate Meaning": A.distinct_meanings(c), "Consecutive Commas": X.collapse_commas(c)}
    if isinstance(issue, str):
        return X.fix_format(plain[issue])
    out = c
    for name, fixed in plain.items():
        out = F.when(issue == name, fixed).otherwise(out)
    return X.fix_format(out)


FIX_ORDER = {"english": ("Digits Found",), "tulu": ("Digits Found", "Special Character", "Duplicate Meaning", "Consecutive Commas")}


def fix(df: DataFrame, pos: str = "pos") -> DataFrame:
    """The issues of medium severity fixed in the order of the rules, each flagged on the original value and each
    followed by the standard formatting; rows that became empty and repeated rows dropped. No join: a cell's fixes fold
    in the row.
    """
    x = df.select(pos, *(F.coalesce(X.na_to_null(F.col(c).cast("string")), F.lit("nan")).alias(c) for c in ("english", "tulu")))
    flags = {(c, i): f"_{c}_{k}" for c, names in FIX_ORDER.items() for k, i in enumerate(names)}
    x = x.withColumns({f: _condition(i, X.strip(F.col(c))) for (c, i), f in flags.items()})
    for (c, i), f in flags.items():
        x = x.withColumn(c, F.when(F.col(f), _apply(i, F.col(c))).otherwise(F.col(c)))
    x = x.select(pos, "english", "tulu").filter((X.strip(F.col("english")) != "") & (X.strip(F.col("tulu")) != ""))
    return keep_first(x, [F.col("english"), F.col("tulu")], pos)


def fix_from_report(df: DataFrame, report: DataFrame, pos: str = "pos") -> DataFrame:
    """The fixes a report lists (row_no = pos + 2, column_name, issue, severity) applied to the table.

    Low severity, missing values and rows outside the table are skipped; a cell's listed fixes are applied in rule
    order, once each. The report is grouped by row before it is joined, so one row of the table meets one row of it.
    """
    wanted = report.filter((F.col("severity") != "Low") & (F.col("issue") != "Missing Value")).select((F.col("row_no") - 2).alias(pos), F.concat(F.lower("column_name"), F.lit("/"), F.col("issue")).alias("what"))
    per_row = wanted.groupBy(pos).agg(F.collect_set("what").alias("_what"))  # at most one per column and issue
    x = df.select(pos, *(F.col(c).cast("string").alias(c) for c in ("english", "tulu"))).join(per_row, pos, "left")
    for c, names in FIX_ORDER.items():
        for i in names:
            x = x.withColumn(c, F.when(F.array_contains("_what", f"{c}/{i}"), _apply(i, F.col(c))).otherwise(F.col(c)))
    return x.select(pos, "english", "tulu")


def instruction_pairs(df: DataFrame, pos: str = "pos") -> tuple[DataFrame, DataFrame]:
    """(pairs, quarantine). Entries with both texts, the first of each english as stored; five questions per entry: the
    second answered by all meanings, the others by the first. Entries without a meaning go to quarantine, with a reason.
    """
    x = df.select(pos, *(X.na_to_null(F.col(c).cast("string")).alias(c) for c in ("english", "tulu"))).na.drop(subset=["english", "tulu"])
    x = keep_first(x, [F.col("english")], pos)
    x = x.select(pos, X.strip(F.col("english")).alias("english"), A.meanings(X.strip(F.col("tulu"))).alias("m"))
    asked = F.array(*(F.struct(F.lit(k).alias("template_no"), X.fill_template(t, F.col("english")).alias("instruction")) for k, t in enumerate(X.TEMPLATES)))
    good = x.filter(F.size("m") > 0).select(pos, "m", F.explode(asked).alias("t"))
    pairs = good.select(pos, "t.template_no", "t.instruction", F.when(F.col("t.template_no") == 1, F.array_join("m", ", ")).otherwise(A.first(F.col("m"))).alias("response"))
    return pairs, x.filter(F.size("m") == 0).select(pos, "english", F.lit("No meaning").alias("reason"))


def conversation_pairs(df: DataFrame, pos: str = "pos") -> DataFrame:
    """Pairs of the two conversation columns: renamed, rows with a null dropped, stripped, repeated rows dropped."""
    x = df.select(pos, F.col("tulu_text").cast("string").alias("instruction"), F.col("response_tulu").cast("string").alias("response")).na.drop(subset=["instruction", "response"])
    x = keep_first(x, [F.col("instruction"), F.col("response")], pos)
    return x.select(pos, X.strip(F.col("instruction")).alias("instruction"), X.strip(F.col("response")).alias("response"))


def merge(parts: list[DataFrame], seed: int = 42) -> DataFrame:
    """(src_order, pos, instruction, response, shuffle_key): all parts, none deduplicated, with a reproducible random
    order to sort by."""
    out = None
    for k, p in enumerate(parts):
        p = p.select(F.lit(k).alias("src_order"), F.col("pos").cast("long").alias("pos"), "instruction", "response")
        out = p if out is None else out.unionByName(p)
    return out.withColumn("shuffle_key", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("src_order").cast("string"), F.col("pos").cast("string"), "instruction")))
