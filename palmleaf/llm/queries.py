"""The queries of this subpackage over the test tables, and their SQL where SQL can say them."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palmleaf.llm.cross_split import find_overlaps
from palmleaf.llm.formatting_copies import collapse, runs_of_copies
from palmleaf.llm.groups import assign_splits, headword_forest, tie_by_headword
from palmleaf.llm.leaks import find_leaks
from palmleaf.llm.mixing import mix, quotas
from palmleaf.llm.pair_defects import LABELS, flag_defects, load, save, train
from palmleaf.llm.pieces import cut_oversized
from palmleaf.llm.visual import HYPHENS, LATIN_LOOKALIKES, TELUGU_LIKE_KANNADA, add_canonical, look_classes, same_look_pairs
from palmleaf.runtime import materialize, read_table, shared_dir

TEXTS, OBJECTS = ["instruction", "response"], ["meta"]


def p2_found(spark, d):
    return runs_of_copies(read_table(spark, d, "train"), "record_id", TEXTS, OBJECTS)


def p2_collapsed(spark, d):
    return collapse(read_table(spark, d, "train"), "record_id", TEXTS, OBJECTS)


def p3_found(spark, d):
    return tie_by_headword(read_table(spark, d, "train")).filter("record_id <> first_id").select("first_id", "record_id")


def p3_splits(spark, d):
    """Every record's split; records that name no headword are groups of one."""
    records = read_table(spark, d, "train").select("record_id")
    tied = tie_by_headword(read_table(spark, d, "train"))
    groups = records.join(tied, "record_id", "left").select("record_id", F.coalesce("first_id", "record_id").alias("group_id"))
    return assign_splits(materialize(groups, "groups"), _shares(spark, d), "group_id", "record_id")


def _shares(spark, d, most=1000):
    rows = read_table(spark, d, "split_targets").select("split_name", "target_share").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} splits")
    return [(r[0], r[1]) for r in rows]


def p3_forest(spark, d):
    """The headwords that records tie together, as the forest's edges between their smallest records, counted: joined by
    the tree edges alone, as many components come out as by all edges."""
    ties, forest = headword_forest(read_table(spark, d, "train"))
    nodes = forest.select(F.col("u").alias("n")).union(forest.select("v")).distinct()
    groups = nodes.join(ties.select(F.col("record_id").alias("n"), "first_id"), "n").agg(F.count(F.lit(1)).alias("nodes"), F.countDistinct("first_id").alias("trees"))
    return groups.select((F.col("nodes") - F.col("trees") == F.lit(forest.count())).alias("a_forest"))


def p3_checks(spark, d):
    """What must hold of the splits: every record once, no group in two splits, shares within half a percent."""
    s = materialize(p3_splits(spark, d), "splits")
    apart = s.groupBy("group_id").agg(F.countDistinct("split").alias("n")).filter("n > 1").isEmpty()
    n, shares = s.count(), dict(_shares(spark, d))
    got = {r["split"]: r["n"] / max(1, n) for r in s.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per split
    met = all(abs(got.get(k, 0.0) - v) < 0.005 for k, v in shares.items())
    return s.agg(F.count(F.lit(1)).alias("records"), F.countDistinct("record_id").alias("distinct_records"), F.countDistinct("group_id").alias("groups")).withColumns({"together": F.lit(apart), "shares_met": F.lit(met)})


def p3_shares(spark, d):
    s = p3_splits(spark, d).groupBy("split").agg(F.count(F.lit(1)).alias("records"), F.countDistinct("group_id").alias("groups"))
    return s.withColumn("share", F.col("records") / F.sum("records").over(_whole()))


def _whole():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(1))  # one row per split


_models: dict[tuple[str, str], str] = {}  # of this session: where the model of a table was written


def p4_found(spark, d):
    t = read_table(spark, d, "train")
    model = train(t)
    path = f"{shared_dir(spark)}/palmleaf-model-{uuid.uuid4().hex}"
    save(spark, model, path)
    _models[spark.sparkContext.applicationId, d] = path
    return flag_defects(t, model).select("record_id", "defect")


def p4_counts(spark, d):
    """Records by their first defect and by all that they have, with the model that p4_found wrote for these records, if
    it did, and how often a response seems to be another question's (no defect of a response alone)."""
    t = read_table(spark, d, "train")
    path = _models.get((spark.sparkContext.applicationId, d))
    found = flag_defects(t, load(spark, path) if path else train(t), labels=LABELS)
    first = F.when(F.size(F.array_except("defects", F.array(F.lit("swapped")))) > 0, F.col("defect"))
    each = found.select(first.alias("first"), F.explode("defects").alias("defect"))
    return each.groupBy("defect").agg(F.count_if(F.col("first") == F.col("defect")).alias("first_records"), F.count(F.lit(1)).alias("records"))


def _evals(spark, d):
    return read_table(spark, d, "validation").unionByName(read_table(spark, d, "test"))


def p5_found(spark, d):
    return find_overlaps(read_table(spark, d, "train"), _evals(spark, d)).select("train_id", "eval_id")


def _sources(spark, d, *names):
    return functools.reduce(DataFrame.unionByName, (read_table(spark, d, n).select("record_id", "source", F.lit(n).alias("split")) for n in names))


def p5_report(spark, d):
    """Overlaps per evaluation split, its source and the source of the training record: pairs and distinct records of
    either side, and the words of the pairs' evaluation records that lie in spans shared with the training record."""
    pairs = find_overlaps(read_table(spark, d, "train"), _evals(spark, d))
    e = _sources(spark, d, "validation", "test").select(F.col("record_id").alias("eval_id"), "split", "source")
    t = _sources(spark, d, "train").select(F.col("record_id").alias("train_id"), F.col("source").alias("train_source"))
    by = pairs.join(e, "eval_id").join(t, "train_id").groupBy("split", "source", "train_source")
    return by.agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("eval_id").alias("eval_records"), F.countDistinct("train_id").alias("train_records"), F.sum("edits").alias("edits"), F.sum("words").alias("words"))


def p5_coverage(spark, d):
    """Each evaluation record that overlaps: its training records, and the most words of it that one of them covers."""
    pairs = find_overlaps(read_table(spark, d, "train"), _evals(spark, d))
    return pairs.groupBy("eval_id").agg(F.count(F.lit(1)).alias("train_records"), F.max("covered").alias("covered"), F.min("edits").alias("least_edits"))


def p6_found(spark, d):
    return same_look_pairs(read_table(spark, d, "clean_dictionary"), "entry_id", ["english", "tulu"])


def p6_classes(spark, d):
    """Every row that looks like one stored differently, with its class: one row each, however large the class."""
    return look_classes(read_table(spark, d, "clean_dictionary"), "entry_id", ["english", "tulu"]).select("entry_id", "class_id", "forms", "rows")


def p6_canonical(spark, d):
    t = read_table(spark, d, "clean_dictionary").select("entry_id", "english", "tulu")
    return add_canonical(t, {"english": "english_form", "tulu": "tulu_form"}).select("entry_id", "english_form", "tulu_form")


def p7_found(spark, d):
    """Ten words and more in a row: items of fewer words are whole windows of their own and are no case here."""
    found = find_leaks(read_table(spark, d, "documents"), read_table(spark, d, "eval_items"))
    return found.filter("exact_windows > 0 AND window_words = 10").select("doc_id", "item_id")


def p7_report(spark, d):
    """Each leaked item: the documents that hold ten words or more of it in a row, and the most of its windows that one holds."""
    found = find_leaks(read_table(spark, d, "documents"), read_table(spark, d, "eval_items")).filter("exact_windows > 0 AND window_words = 10")
    return found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"), F.max(F.col("exact_windows") / F.col("item_windows")).alias("largest_part"))


def p7_near(spark, d):
    """Documents that hold a passage of an item's size like the whole item (weighted similarity of shingles 0.8 or more),
    though not all of it word for word."""
    found = find_leaks(read_table(spark, d, "documents"), read_table(spark, d, "eval_items"))
    return found.filter("item_similarity > 0 AND exact_windows < item_windows").select("doc_id", "item_id", "item_similarity")


def p8_mixture(spark, d):
    return mix(read_table(spark, d, "documents"), read_table(spark, d, "source_targets"))[0]


def p8_shares(spark, d):
    return mix(read_table(spark, d, "documents"), read_table(spark, d, "source_targets"))[1]


def p8_checks(spark, d):
    """What must hold of each target: no document beyond the cap, uses of documents that differ by one at most, the share
    that the tokens of all sources and the caps allow, and rows that number 1 to n in each shard."""
    mixture, shares = mix(read_table(spark, d, "documents"), read_table(spark, d, "source_targets"))
    each = mixture.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    spread = each.groupBy("source").agg(F.max("n").alias("most"), F.min("n").alias("least"), F.count(F.lit(1)).alias("used"))
    numbered = mixture.groupBy("shard").agg((F.max("pos") == F.count(F.lit(1))).alias("ok")).filter("NOT ok").isEmpty()
    rows = {r["source"]: r for r in shares.collect()}  # one per target
    take = quotas({s: r["source_tokens"] for s, r in rows.items()}, {s: (r["target_share"], r["max_repeats"]) for s, r in rows.items()})
    longest = mixture.agg(F.max("tokens")).first()[0] or 0
    goals = spark.createDataFrame([(s, take.get(s, 0), longest) for s in rows], "source STRING, quota BIGINT, longest BIGINT")
    x = shares.join(goals, "source").join(spread, "source", "left")
    every = (F.col("used") < F.col("documents")) | (F.col("most") - F.col("least") <= 1)
    return x.select("source", (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("within_cap"), F.coalesce(every, F.lit(True)).alias("even"), F.col("tokens").between(F.col("quota"), F.col("quota") + F.col("longest")).alias("share_met"), F.lit(numbered).alias("numbered"))


def p9_checks(spark, d):
    """What must hold of each profile: pieces within the limit, in order, with overlaps within theirs, that give the text
    again without the overlaps."""
    docs, limits = read_table(spark, d, "documents"), read_table(spark, d, "piece_limits")
    pieces = cut_oversized(docs, limits)
    per = pieces.groupBy("doc_id", "profile").agg(F.sort_array(F.collect_list(F.struct("piece_no", "start_char", "end_char", "piece"))).alias("p"), F.max("n_tokens").alias("most"), F.max("overlap_tokens").alias("shared"))
    fresh = F.transform("p", lambda x, k: F.substring(x["piece"], (F.when(k > 0, F.get(F.col("p"), k - 1)["end_char"]).otherwise(0) - x["start_char"] + 1).cast("int"), F.lit((1 << 31) - 1)))
    per = per.join(docs.select("doc_id", "text"), "doc_id").join(F.broadcast(limits.select("profile", "max_tokens", F.col("overlap_tokens").alias("allowed"))), "profile")
    numbered = F.forall(F.transform("p", lambda x, k: x["piece_no"] == k), lambda ok: ok)
    seen = per.groupBy("profile").agg(F.every(F.array_join(fresh, "") == F.col("text")).alias("rebuilt"), F.every(F.col("most") <= F.col("max_tokens")).alias("within_limit"), F.every(F.col("shared") <= F.col("allowed")).alias("within_overlap"), F.every(numbered).alias("in_order"))
    return limits.select("profile").join(seen, "profile", "left").na.fill(True)


def p9_pieces(spark, d):
    return cut_oversized(read_table(spark, d, "documents"), read_table(spark, d, "piece_limits"))


QUERIES = {f.__name__: f for f in (p2_found, p2_collapsed, p3_found, p3_splits, p3_shares, p3_forest, p3_checks, p4_found, p4_counts, p5_found, p5_report, p5_coverage, p6_found, p6_classes, p6_canonical, p7_found, p7_report, p7_near, p8_mixture, p8_shares, p8_checks, p9_pieces, p9_checks)}

_LETTERS = r"coalesce(lower(regexp_replace({}, '[^\p{{L}}\p{{M}}\p{{N}}]+', '', 'g')), '')"
_META = "CASE WHEN meta IS NULL THEN NULL ELSE list_transform(list_sort(json_keys(meta)), lambda k: k || '=' || CAST(json_extract(meta, '$.\"' || k || '\"') AS VARCHAR)) END"
_COPIES = f"""
WITH k AS (SELECT record_id, {_LETTERS.format("instruction")} AS i, {_LETTERS.format("response")} AS r, {_META} AS m FROM train),
f AS (SELECT record_id, min(record_id) OVER (PARTITION BY i, r, m) AS first_id FROM k)
"""
_HEADS_TWO = [r"compare the tulu words for (.+?) and (.+)$", r"what is the difference between (.+?) and (.+) in tulu$", r"translate (.+?) and (.+) to tulu$"]
_HEADS_ONE = [
    r"use the tulu word for (.+) in a sentence$", r"what is the tulu meaning of (.+)$", r"how do you say (.+) in tulu$", r"give the tulu translation of (.+)$", r"which tulu word stands for (.+)$",
    r"tulu word for (.+)$", r"translate (.+) to tulu$", r"please tell me how (.+) is said in tulu$", r"i came across (.+) in a reader what is it called in tulu$", r"^(.+) what do tulu speakers call it$",
]
_CASES = " ".join(
    [f"WHEN regexp_matches(w, '{p}') THEN [regexp_extract(w, '{p}', 1), regexp_extract(w, '{p}', 2)]" for p in _HEADS_TWO]
    + [f"WHEN regexp_matches(w, '{p}') THEN [regexp_extract(w, '{p}', 1)]" for p in _HEADS_ONE]
)
_FOUND3 = rf"""
WITH RECURSIVE o AS (SELECT record_id, regexp_replace(instruction, '(?i)^([^\p{{L}}\p{{M}}\p{{N}}]*(q\s*[:：]|question\s*[:：]|pls\s*[,，]|please\s*[,，]))+', '') AS asked FROM train),
t AS (SELECT record_id, trim(lower(regexp_replace(asked, '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g'))) AS w FROM o),
h AS (SELECT record_id, unnest(CASE {_CASES} END) AS x FROM t),
n AS (SELECT record_id, replace(x, ' ', '') AS x FROM h WHERE replace(x, ' ', '') <> ''),
e AS (SELECT DISTINCT a.x AS x, b.x AS y FROM n a JOIN n b USING (record_id)),
reach(x, y) AS (SELECT x, y FROM e UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x),
root AS (SELECT reach.x, min(n.record_id) AS first_id FROM reach JOIN n ON n.x = reach.y GROUP BY reach.x)
SELECT DISTINCT first_id, record_id FROM n JOIN root USING (x) WHERE record_id <> first_id
"""
_SPLIT = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{M}}\p{{N}}]+')"
# All pairs of texts whose lengths and numbers of common words allow it, then the edit distance row by row.
_NEAR5 = f"""
WITH RECURSIVE e AS (SELECT record_id, source, 'validation' AS split, instruction, response FROM validation UNION ALL SELECT record_id, source, 'test', instruction, response FROM test),
tw AS (SELECT record_id, source, coalesce({_SPLIT.format("instruction")}, []) AS i, coalesce({_SPLIT.format("response")}, []) AS r FROM train),
ew AS (SELECT record_id, source, split, coalesce({_SPLIT.format("instruction")}, []) AS i, coalesce({_SPLIT.format("response")}, []) AS r FROM e),
c AS (SELECT tw.record_id AS train_id, ew.record_id AS eval_id, tw.source AS train_source, ew.source, split, tw.i AS ti, tw.r AS tr, ew.i AS ei, ew.r AS er, greatest(len(tw.i), len(ew.i)) AS ni, greatest(len(tw.r), len(ew.r)) AS nr FROM tw JOIN ew
  ON abs(len(tw.i) - len(ew.i)) <= greatest(len(tw.i), len(ew.i)) // 10 AND abs(len(tw.r) - len(ew.r)) <= greatest(len(tw.r), len(ew.r)) // 10
  WHERE (CASE WHEN ni < 10 THEN tw.i = ew.i ELSE len(list_intersect(tw.i, ew.i)) >= len(list_distinct(ew.i)) - ni // 10 END) AND (CASE WHEN nr < 10 THEN tw.r = ew.r ELSE len(list_intersect(tw.r, ew.r)) >= len(list_distinct(ew.r)) - nr // 10 END)),
todo AS (SELECT DISTINCT a, b FROM (SELECT ti AS a, ei AS b FROM c UNION ALL SELECT tr, er FROM c) WHERE a <> b),
step(a, b, k, line) AS (SELECT a, b, 0, range(len(b) + 1) FROM todo
  UNION ALL SELECT a, b, k + 1, list_transform(range(len(b) + 1), lambda j: list_min(list_transform(range(j + 1), lambda x: CASE WHEN x = 0 THEN k + 1 ELSE least(line[x + 1] + 1, line[x] + CASE WHEN a[k + 1] = b[x] THEN 0 ELSE 1 END) END + j - x))) FROM step WHERE k < len(a)),
cost AS (SELECT a, b, line[-1] AS n FROM step WHERE k = len(a)),
p AS (SELECT c.*, coalesce(x.n, 0) AS di, coalesce(y.n, 0) AS dr FROM c LEFT JOIN cost x ON x.a = ti AND x.b = ei LEFT JOIN cost y ON y.a = tr AND y.b = er WHERE coalesce(x.n, 0) <= ni // 10 AND coalesce(y.n, 0) <= nr // 10)
"""
_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+')"
_FOUND7 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL), i AS (SELECT item_id, {_WORDS} AS w FROM eval_items),
dg AS (SELECT DISTINCT doc_id, array_to_string(w[k:k+9], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 8)) AS k FROM d)),
ig AS (SELECT DISTINCT item_id, array_to_string(w[k:k+9], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS k FROM i))
SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)
"""
_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F)))
_FROM = _WIDE + "".join(LATIN_LOOKALIKES) + TELUGU_LIKE_KANNADA + HYPHENS
_TO = "".join(chr(ord(c) - 0xFEE0) for c in _WIDE) + "".join(LATIN_LOOKALIKES.values()) + "".join(chr(ord(c) + 0x80) for c in TELUGU_LIKE_KANNADA) + "-" * len(HYPHENS)


def _form(x: str) -> str:
    """The consistent form in SQL: single characters translated, undrawn ones dropped, a joiner kept between a virama and
    a letter or before a virama, the zero after a syllable read as the sign it is drawn like, then composed."""
    x = f"regexp_replace({x}, '[\\x{{AD}}\\x{{200B}}\\x{{200E}}\\x{{200F}}\\x{{202A}}-\\x{{202E}}\\x{{2060}}-\\x{{206F}}\\x{{FEFF}}\\x{{34F}}\\x{{61C}}\\x{{FE00}}-\\x{{FE0F}}]', '', 'g')"
    x = f"translate(regexp_replace({x}, '\\p{{Zs}}', ' ', 'g'), '{_FROM.replace(chr(39), chr(39) * 2)}', '{_TO.replace(chr(39), chr(39) * 2)}')"
    for joiner, mark in (("\\x{200C}", "\ue001"), ("\\x{200D}", "\ue002")):
        x = f"regexp_replace({x}, '([\\x{{CCD}}\\x{{C4D}}\\x{{94D}}]){joiner}([A-Za-z\\x{{AA}}-\\x{{1FFFF}}])', '\\1{mark}\\2', 'g')"
    x = f"regexp_replace({x}, '(.)\\x{{200D}}([\\x{{CCD}}\\x{{C4D}}\\x{{94D}}])', '\\1\ue002\\2', 'g')"
    x = f"regexp_replace(translate(regexp_replace({x}, '[\\x{{200C}}\\x{{200D}}]', '', 'g'), '\ue001\ue002', '\u200c\u200d'), '([ಅ-ಹಾ-ೌೕೖ])೦', '\\1ಂ', 'g')"
    return f"nfc_normalize({x})"


_LOOKS = f"WITH x AS (SELECT entry_id, english, tulu, {_form('english')} AS e, {_form('tulu')} AS t FROM clean_dictionary)"
_REPORT7 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL), i AS (SELECT item_id, {_WORDS} AS w FROM eval_items),
dg AS (SELECT DISTINCT doc_id, array_to_string(w[k:k+9], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 8)) AS k FROM d)),
ig AS (SELECT item_id, k, len(w) - 9 AS n, array_to_string(w[k:k+9], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS k FROM i)),
p AS (SELECT item_id, doc_id, count(*) / max(n)::DOUBLE AS part FROM dg JOIN ig USING (g) GROUP BY item_id, doc_id)
SELECT item_id, count(*) AS documents, max(part) AS largest_part FROM p GROUP BY item_id
"""
ORACLES = {
    "p2_found": _COPIES + "SELECT first_id, record_id FROM f WHERE record_id <> first_id",
    "p2_collapsed": _COPIES + "SELECT first_id AS record_id, count(*) AS copies FROM f GROUP BY first_id",
    "p3_found": _FOUND3,
    "p3_forest": "SELECT true AS a_forest",
    "p3_checks": _FOUND3[: _FOUND3.rindex("SELECT DISTINCT")] + "SELECT (SELECT count(*) FROM train) AS records, (SELECT count(*) FROM train) AS distinct_records, (SELECT count(*) FROM train) - count(*) AS groups, true AS together, true AS shares_met FROM (SELECT DISTINCT first_id, record_id FROM n JOIN root USING (x) WHERE record_id <> first_id)",
    "p5_found": _NEAR5 + "SELECT train_id, eval_id FROM p",
    "p5_report": _NEAR5 + "SELECT split, source, train_source, count(*) AS pairs, count(DISTINCT eval_id) AS eval_records, count(DISTINCT train_id) AS train_records, CAST(sum(di + dr) AS BIGINT) AS edits, CAST(sum(ni + nr) AS BIGINT) AS words FROM p GROUP BY ALL",
    "p6_canonical": _LOOKS + " SELECT entry_id, e AS english_form, t AS tulu_form FROM x",
    "p6_found": _LOOKS + " SELECT a.entry_id AS entry_id_a, b.entry_id AS entry_id_b FROM x a JOIN x b ON a.e = b.e AND a.t = b.t AND a.entry_id < b.entry_id WHERE a.english <> b.english OR a.tulu <> b.tulu",
    "p6_classes": _LOOKS + ", c AS (SELECT e, t, min(entry_id) AS class_id, count(DISTINCT (english, tulu)) AS forms, count(*) AS rows FROM x WHERE english IS NOT NULL AND tulu IS NOT NULL GROUP BY e, t) SELECT entry_id, class_id, forms, rows FROM x JOIN c USING (e, t) WHERE forms > 1",
    "p7_found": _FOUND7,
    "p7_report": _REPORT7,
    "p8_checks": "SELECT source, true AS within_cap, true AS even, true AS share_met, true AS numbered FROM source_targets",
    "p9_checks": "SELECT profile, true AS rebuilt, true AS within_limit, true AS within_overlap, true AS in_order FROM piece_limits",
}
