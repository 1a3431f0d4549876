"""Every query of the core over the test tables, with its SQL where SQL can say it."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from palmleaf.functions import arrays as A
from palmleaf.functions import text as X
from palmleaf.functions.tokenize import DIRECTORY, FILES, comes_back, public_tokenizers, token_ids
from palmleaf.operators import curation as C
from palmleaf.operators import dictionary as D
from palmleaf.operators import examples as E
from palmleaf.operators import quality as Q
from palmleaf.operators import split as S
from palmleaf.operators.packed import unpack
from palmleaf.plans import oracles as O
from palmleaf.runtime import materialize, read_table, shared_dir
from palmleaf.sources import jsonl, tables, xlsx
from palmleaf.sources import reports as texts


def _dictionary(spark, d):
    return read_table(spark, d, "clean_dictionary").withColumnRenamed("entry_id", "pos")


def _pairs(spark, d):
    return read_table(spark, d, "train").withColumnRenamed("record_id", "pos")


def _talks(spark, d):
    return read_table(spark, d, "raw_conversations").withColumnRenamed("conv_id", "pos")


def p1_found(spark, d):
    return unpack(read_table(spark, d, "clean_dictionary"), "entry_id", "tulu")


def dictionary_clean(spark, d):
    return D.clean(_dictionary(spark, d))


def dictionary_standardize(spark, d):
    return D.standardize(_dictionary(spark, d))


def dictionary_issues(spark, d):
    return D.issues(_dictionary(spark, d))


def dictionary_issue_summary(spark, d):
    return D.count_by(D.issues(_dictionary(spark, d)), "issue")


def dictionary_severity_summary(spark, d):
    return D.count_by(D.issues(_dictionary(spark, d)), "severity")


def dictionary_fix(spark, d):
    return D.fix(_dictionary(spark, d))


def dictionary_fix_from_report(spark, d):
    return D.fix_from_report(_dictionary(spark, d), read_table(spark, d, "validation_report"))


def instruction_pairs(spark, d):
    return D.instruction_pairs(_dictionary(spark, d))[0]


def instruction_quarantine(spark, d):
    """The dictionary with the cells of slashes emptied of their texts, so that some entries have no meaning."""
    marks_only = F.when(F.col("tulu").contains("/"), F.lit(" , ,")).otherwise(F.col("tulu"))
    return D.instruction_pairs(_dictionary(spark, d).withColumn("tulu", marks_only))[1]


def conversation_pairs(spark, d):
    return D.conversation_pairs(_talks(spark, d))


def merge_corpus(spark, d):
    made = D.instruction_pairs(_dictionary(spark, d))[0].withColumn("pos", F.col("pos") * 5 + F.col("template_no"))
    return D.merge([made, D.conversation_pairs(_talks(spark, d))])


def improve_corpus(spark, d):
    return C.improve(_pairs(spark, d))


def improve_report(spark, d):
    return C.improve_report(_pairs(spark, d))


def filter_v1(spark, d):
    return C.kept(C.classify_v1(_pairs(spark, d)))


def filter_v1_removed(spark, d):
    return C.removed(C.classify_v1(_pairs(spark, d)))


def filter_v1_report(spark, d):
    return C.filter_report(C.classify_v1(_pairs(spark, d)), True)


def filter_v2(spark, d):
    return C.kept(C.classify_v2(_pairs(spark, d)))


def filter_v2_removed(spark, d):
    return C.removed(C.classify_v2(_pairs(spark, d)), cleaned=False)


def filter_v2_report(spark, d):
    return C.filter_report(C.classify_v2(_pairs(spark, d)), False)


def duplicate_flags(spark, d):
    return Q.duplicate_flags(_pairs(spark, d))


def suspicious_records(spark, d):
    return Q.suspicious(_pairs(spark, d))


def validate_corpus(spark, d):
    return Q.validate(_pairs(spark, d))


def split_assign(spark, d):
    return S.assign(_pairs(spark, d))


def split_stats(spark, d):
    return S.stats(S.assign(_pairs(spark, d)))


def _three(spark, d):
    out = None
    for name in ("train", "validation", "test"):
        one = read_table(spark, d, name).select(F.lit(name).alias("split"), "instruction", "response")
        out = one if out is None else out.unionByName(one)
    return out


def split_pair_leaks(spark, d):
    return S.leaks(_three(spark, d), S.pair_key())


def split_word_leaks(spark, d):
    return S.leaks(_three(spark, d), X.casefold(X.template_word(F.coalesce("instruction", F.lit("")))))


def chat_render(spark, d):
    x = _pairs(spark, d).select("pos", X.strip(F.col("instruction")).alias("i"), X.strip(F.col("response")).alias("r")).filter("i <> '' AND r <> ''")
    return x.select("pos", E.render_prompt(F.col("i")).alias("prompt"), E.render_full(F.col("i"), F.col("r")).alias("full_text"))


def chat_turns(spark, d):
    x = read_table(spark, d, "raw_conversations").na.drop(subset=["tulu_text", "response_tulu"])
    turns = F.array(*(F.struct(F.lit(role).alias("role"), X.strip(F.col(c)).alias("content")) for role, c in (("user", "tulu_text"), ("assistant", "response_tulu"))))
    return x.select("conv_id", E.render_turns(turns).alias("rendered"))


def label_mask(spark, d):
    return E.examples(_pairs(spark, d))


def padded_batches(spark, d):
    return E.pad_batches(E.examples(_pairs(spark, d)))


def token_efficiency(spark, d):
    return E.token_efficiency(read_table(spark, d, "documents"))


def best_tokenizer(spark, d):
    return E.best_tokenizer(E.token_efficiency(read_table(spark, d, "documents")))


def public_token_efficiency(spark, d):
    return E.token_efficiency(read_table(spark, d, "documents"), tokenizers=public_tokenizers())


def label_mask_public(spark, d):
    return E.examples(_pairs(spark, d), tokenize=token_ids(f"{DIRECTORY}/byte_bpe_multi_50k.tiktoken"))


def scalar_functions(spark, d):
    r = F.col("response")
    return _pairs(spark, d).select(
        "pos", X.collapse_spaces(r).alias("squeezed"), X.standardize(r).alias("standardized"), X.fix_format(r).alias("fix_formatted"), X.remove_digits(r).alias("no_digits"), X.remove_special(r).alias("no_special"),
        X.collapse_punctuation(r).alias("one_mark"), X.no_space_before_punctuation(r).alias("tight_marks"), X.casefold(r).alias("folded"), F.length(r).alias("characters"), F.replace(r, F.lit(" "), F.lit("")).alias("no_spaces"),
        X.has_latin(r).alias("latin"), X.has_digit(r).alias("digit"), X.has_special(r).alias("special"), X.has_double_comma(r).alias("double_comma"), X.has_double_space(r).alias("double_space"), X.has_repeated_mark(r).alias("repeated_mark"), X.has_abbreviation(r).alias("abbreviation"),
        A.meanings(r).alias("parts"), A.first(A.meanings(r)).alias("first_part"),
    )


def first_rows(spark, d):
    return tables.first_rows(_pairs(spark, d).select("pos", "instruction", "response"), 10)


def run_projection(spark, d):
    n = read_table(spark, d, "train").agg(F.count(F.lit(1)).alias("n"))
    sizes = n.select("n", F.explode(F.array(F.lit(16), F.lit(32), F.lit(64))).alias("batch_size"))
    return sizes.select("batch_size", E.project_run(F.lit(20), F.lit(94.0), F.col("n"), F.col("batch_size"), F.lit(3)).alias("hours"))


def templates(spark, d):
    return tables.literal(spark, list(X.TEMPLATES), "template")


def answer_ids(spark, d):
    return E.answers(_pairs(spark, d))


def failing_tokenizers(spark, d):
    """One tokenizer that works, one whose file is missing, one that fails while it runs."""
    broken = {"characters": F.length, "missing": _missing, "raising": lambda c: F.when(F.length(c) >= 0, F.raise_error(F.lit("broken"))).cast("long")}
    return E.token_efficiency(read_table(spark, d, "documents"), tokenizers=broken)


def _missing(c):
    raise FileNotFoundError("no vocabulary")


def _folder(spark):
    return f"{shared_dir(spark)}/palmleaf-files-{uuid.uuid4().hex}"


def jsonl_strict(spark, d):
    """The training pairs written as JSON lines and read strictly."""
    path = _folder(spark)
    jsonl.write(read_table(spark, d, "train").select("record_id", "instruction", "response"), path)
    return jsonl.read_strict(spark, path, "record_id BIGINT, instruction STRING, response STRING")


def jsonl_skipping_blanks(spark, d):
    """The same with a blank line after each record."""
    path = _folder(spark)
    lines = F.explode(F.array(F.to_json(F.struct("record_id", "instruction", "response")), F.lit("  "), F.lit("")))
    read_table(spark, d, "train").select(lines.alias("value")).write.text(path)
    return jsonl.read_skipping_blanks(spark, path, "record_id BIGINT, instruction STRING, response STRING")


def jsonl_line_numbers(spark, d):
    """The numbers of the lines of several files: each from 1 on once, blank ones counted."""
    path = _folder(spark)
    read_table(spark, d, "train").select(F.explode(F.array(F.lit("x"), F.lit(""))).alias("value")).write.text(path)
    n = jsonl.read_lines(spark, path)
    return n.agg(F.count(F.lit(1)).alias("lines"), F.countDistinct("line").alias("numbers"), F.min("line").alias("first_line"), F.max("line").alias("last_line"), F.count_if(F.col("value") == "x").alias("filled"))


def jsonl_checked(spark, d):
    """The pairs with both texts through the reader that ends at the first bad line."""
    path = _folder(spark)
    both = read_table(spark, d, "train").filter((X.strip(F.coalesce("instruction", F.lit(""))) != "") & (X.strip(F.coalesce("response", F.lit(""))) != ""))
    jsonl.write(both.select("instruction", "response"), path)
    return jsonl.read_checked(spark, path).groupBy("instruction", "response").agg(F.count(F.lit(1)).alias("records"))


def jsonl_routes(spark, d):
    """How the permissive reader routes lines of all kinds: pairs, objects without them, numbers, arrays and broken text."""
    path = _folder(spark)
    kinds = (F.to_json(F.struct("instruction", "response")), F.col("meta"), F.col("record_id").cast("string"), F.to_json(F.array("record_id")), F.concat(F.lit("{ "), F.col("record_id")), F.concat(F.lit('{"instruction": null, "response": "'), F.col("record_id"), F.lit('"}')))
    read_table(spark, d, "train").select(F.explode(F.array(*kinds)).alias("value")).filter("value IS NOT NULL").write.text(path)
    records, bad = jsonl.read_permissive(spark, path)
    routed = jsonl.route(records).groupBy("status").agg(F.count(F.lit(1)).alias("records"), F.count("instruction").alias("instructions"), F.count("response").alias("responses"))
    return routed.unionByName(bad.agg(F.lit("Bad JSON").alias("status"), F.count(F.lit(1)).alias("records"), F.lit(0).cast("long").alias("instructions"), F.lit(0).cast("long").alias("responses")))


def jsonl_splits(spark, d):
    paths = {}
    for name in ("train", "validation", "test"):
        paths[name] = _folder(spark)
        jsonl.write(read_table(spark, d, name).select("instruction", "response"), paths[name])
    return tables.splits(spark, paths).groupBy("split", "instruction", "response").agg(F.count(F.lit(1)).alias("records"))


def routed_files(spark, d):
    """Kept and removed rows of the first filter, written to two places and read again."""
    path = _folder(spark)
    rows = materialize(C.classify_v1(_pairs(spark, d)), "classified").select("pos", "reason")
    jsonl.write_routed(rows, "reason", "Kept", (f"{path}/kept", f"{path}/removed"))
    kept = spark.read.schema("pos BIGINT").json(f"{path}/kept").withColumn("reason", F.lit("Kept"))
    return kept.unionByName(spark.read.schema("pos BIGINT, reason STRING").json(f"{path}/removed"))


def sheets(spark, d):
    """The dictionary written as spreadsheets by the executors and read back with inferred types."""
    path = _folder(spark).removeprefix("file:")
    t = read_table(spark, d, "clean_dictionary").select(F.col("entry_id").alias(" entry_id "), "english", "tulu", "page_no", (F.col("page_no") / 4).alias("quarter"), (F.col("page_no") > 9).alias("late"))
    xlsx.write_parts(t, path)
    return tables.require(xlsx.read(spark, path).drop("file", "pos"), "entry_id", "english", "tulu")


def ratio_checks(spark, d):
    """What the check of split ratios says of each set."""
    rows = []
    for ratios in ((0.9, 0.05, 0.05), (0.8, 0.1, 0.2), (1.0,), (0.7, 0.2, 0.1), ()):
        try:
            S.check_ratios([("", r) for r in ratios])
            rows.append((str(list(ratios)), "OK"))
        except ValueError as e:
            rows.append((str(list(ratios)), str(e)))
    return spark.createDataFrame(rows, "ratios STRING, verdict STRING")


def token_round_trips(spark, d):
    """Texts whose ids decode to the same text again, for the vocabularies of bytes, in one pass."""
    names = [n for n in FILES if n.startswith("byte_bpe")]
    docs = read_table(spark, d, "documents").filter("text IS NOT NULL").select(F.col("text"), *(comes_back(f"{DIRECTORY}/{n}")(F.col("text")).alias(f"s{k}") for k, n in enumerate(names)))
    sums = docs.agg(F.count(F.lit(1)).alias("texts"), *(F.count_if(F.col(f"s{k}")).alias(f"n{k}") for k in range(len(names))))
    return sums.select("texts", F.explode(F.array(*(F.struct(F.lit(n).alias("tokenizer"), F.col(f"n{k}").alias("same")) for k, n in enumerate(names)))).alias("t")).select("t.tokenizer", "texts", "t.same")


def mask_checks(spark, d):
    """Of the examples with a public tokenizer: labels are masked first and the ids after that, as long as the ids."""
    x = E.examples(_pairs(spark, d), tokenize=token_ids(f"{DIRECTORY}/byte_bpe_multi_50k.tiktoken"))
    masked = F.size(F.filter("labels", lambda v: v == A.MASKED))
    good = (F.slice("labels", masked + 1, F.size("labels")) == F.slice("input_ids", masked + 1, F.size("labels"))) & (F.size("labels") == F.size("input_ids")) & (F.size("attention_mask") == F.size("input_ids")) & (F.size("input_ids") <= 256)
    return x.agg(F.count(F.lit(1)).alias("examples"), F.every(good).alias("labels_follow"), F.every(masked > 0).alias("prompts_masked"))


def reports(spark, d):
    """The improvement report as text and as JSON."""
    r = materialize(C.improve_report(_pairs(spark, d)), "report")
    return spark.createDataFrame([("text", texts.as_text(r, "Improvement")), ("json", texts.as_json(r))], "kind STRING, report STRING")


def existence_guards(spark, d):
    """What is said of inputs that are not there."""
    rows = []
    for what, read in (("table", lambda: read_table(spark, d, "no_such_table")), ("lines", lambda: jsonl.read_strict(spark, f"{d}/none.jsonl")), ("workbook", lambda: xlsx.read(spark, f"{d}/none.xlsx")), ("vocabulary", lambda: token_ids(f"{DIRECTORY}/none.model"))):
        try:
            read()
            rows.append((what, "found"))
        except FileNotFoundError:
            rows.append((what, "missing"))
        except AnalysisException as e:
            rows.append((what, "missing" if "PATH_NOT_FOUND" in str(e) else str(e)))
    return spark.createDataFrame(rows, "what STRING, verdict STRING")


_ALL = (
    p1_found, dictionary_clean, dictionary_standardize, dictionary_issues, dictionary_issue_summary, dictionary_severity_summary, dictionary_fix, dictionary_fix_from_report, instruction_pairs, instruction_quarantine,
    conversation_pairs, merge_corpus, improve_corpus, improve_report, filter_v1, filter_v1_removed, filter_v1_report, filter_v2, filter_v2_removed, filter_v2_report, duplicate_flags, suspicious_records, validate_corpus,
    split_assign, split_stats, split_pair_leaks, split_word_leaks, chat_render, chat_turns, label_mask, padded_batches, token_efficiency, best_tokenizer, public_token_efficiency, label_mask_public, scalar_functions, first_rows, run_projection, templates,
    answer_ids, failing_tokenizers, jsonl_strict, jsonl_skipping_blanks, jsonl_line_numbers, jsonl_checked, jsonl_routes, jsonl_splits, routed_files, sheets, ratio_checks,
    token_round_trips, mask_checks, reports, existence_guards,
)
QUERIES = {f.__name__: f for f in _ALL}
ORACLES = {
    "p1_found": O.PACKED, "dictionary_clean": O.CLEAN, "dictionary_standardize": O.STANDARD, "dictionary_issues": O.ISSUES, "dictionary_issue_summary": O.ISSUE_SUMMARY, "dictionary_severity_summary": O.SEVERITY_SUMMARY,
    "dictionary_fix": O.FIXED, "dictionary_fix_from_report": O.REPORT_FIXED, "instruction_pairs": O.PAIRS + "SELECT * FROM p", "instruction_quarantine": O.NO_MEANING, "conversation_pairs": O.CONVERSATIONS, "merge_corpus": O.MERGED,
    "improve_corpus": O.IMPROVED, "improve_report": O.IMPROVE_REPORT, "filter_v1": O.KEPT_1, "filter_v1_removed": O.REMOVED_1, "filter_v1_report": O.REPORT_1, "filter_v2": O.KEPT_2, "filter_v2_removed": O.REMOVED_2, "filter_v2_report": O.REPORT_2,
    "duplicate_flags": O.DUPLICATES, "suspicious_records": O.SUSPICIOUS, "validate_corpus": O.VALIDATION, "split_assign": O.SPLITS, "split_stats": O.SPLIT_STATS, "split_pair_leaks": O.PAIR_LEAKS, "split_word_leaks": O.WORD_LEAKS,
    "chat_render": O.CHAT, "chat_turns": O.TURNS, "label_mask": O.MASKS, "padded_batches": O.PADDED, "token_efficiency": O.TOKENS, "best_tokenizer": O.BEST, "scalar_functions": O.SCALARS, "first_rows": O.PREVIEW, "run_projection": O.PROJECTION, "templates": O.LITERALS,
    "answer_ids": O.ANSWERS, "failing_tokenizers": O.FAILING, "jsonl_strict": O.LINES, "jsonl_skipping_blanks": O.LINES, "jsonl_line_numbers": O.LINE_NUMBERS, "jsonl_checked": O.CHECKED, "jsonl_routes": O.ROUTES, "jsonl_splits": O.SPLIT_LINES, "routed_files": O.ROUTED, "sheets": O.SHEETS, "ratio_checks": O.RATIOS,
    "token_round_trips": O.ROUND_TRIPS, "mask_checks": O.MASK_CHECKS, "reports": O.REPORTS, "existence_guards": O.GUARDS,
}
