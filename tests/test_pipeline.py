import json
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from palmleaf.operators import curation as C
from palmleaf.operators import dictionary as D
from palmleaf.operators import examples as E
from palmleaf.operators import quality as Q
from palmleaf.operators import split as S
from palmleaf.operators.keep_first import keep_first, mark_first, reindex
from palmleaf.runtime import distributed_rank, drop_materialized, hot_join, materialize, release_all, shared_dir

DICT = "pos BIGINT, english STRING, tulu STRING, note STRING"
PAIR = "pos BIGINT, instruction STRING, response STRING"


def entries(spark, *rows):
    return spark.createDataFrame([(k, *r, "x") for k, r in enumerate(rows)], DICT)


def pairs(spark, *rows):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], PAIR)


def test_clean(spark, rows):
    df = entries(spark, ("a ​ b", " ಕ "), (None, "x"), ("NA", "x"), ("a ​ b", "ಕ"), ("​", "x"), ("c", "ಗ"))
    assert rows(D.clean(df)) == [(0, "a  b", "ಕ"), (1, "c", "ಗ")]
    assert D.clean(entries(spark).limit(0)).count() == 0


def test_issues_in_rule_order(spark, rows):
    df = entries(spark, ("", "a1,,a,a1  #"), ("x2", None))
    got = [(r["row_no"], r["rule_no"]) for r in D.issues(df).orderBy("row_no", "rule_no").collect()]
    assert got == [(2, 1), (2, 3), (2, 5), (2, 6), (2, 8), (2, 9), (3, 2), (3, 3), (3, 4)]
    assert D.issues(entries(spark, ("x", "nan"))).select("issue").distinct().count() == 2


def test_fix_keeps_the_order_quirk(spark, rows):
    assert rows(D.fix(entries(spark, ("a", "ಒಂಜಿ1,,ರಡ್ಡ್"), ("b", "ಕ,,ಗ"), ("c1", "ಕ, ಗ ,ಕ"), ("1", "x")))) == [(0, "a", "ಒಂಜಿ, , ರಡ್ಡ್"), (1, "b", "ಕ, ಗ"), (2, "c", "ಕ, ಗ")]


def test_fix_from_report_skips_low_missing_and_outside(spark, rows):
    report = spark.createDataFrame([(2, "Tulu", "Digits Found", "Medium"), (2, "Tulu", "Digits Found", "Medium"), (3, "Tulu", "Multiple Spaces", "Low"), (4, "English", "Missing Value", "High"), (99, "Tulu", "Digits Found", "Medium"), (None, None, None, None)], "row_no BIGINT, column_name STRING, issue STRING, severity STRING")
    assert rows(D.fix_from_report(entries(spark, ("a", "ಕ1"), ("b", "ಗ  ಗ"), (None, "ಜ")), report)) == [(0, "a", "ಕ"), (1, "b", "ಗ  ಗ"), (2, None, "ಜ")]


def test_instruction_pairs(spark, rows):
    df = entries(spark, ("a ", "x, y"), ("a ", "z"), ("b", ", ,"), ("{}%", "q"))
    good, bad = D.instruction_pairs(df)
    got = rows(good)
    assert len(got) == 10 and (0, 1, "What is the Tulu meaning of a?", "x, y") in got and (3, 0, "Translate '{}%' to Tulu.", "q") in got
    assert rows(bad) == [(2, "b", "No meaning")]


def test_conversation_and_merge(spark, rows):
    talks = spark.createDataFrame([(1, " a", "b", 1), (2, " a", "b", 2), (3, None, "c", 3)], "pos BIGINT, tulu_text STRING, response_tulu STRING, pos2 BIGINT")
    c = D.conversation_pairs(talks)
    assert rows(c) == [(1, "a", "b")]
    m = D.merge([c, c])
    assert [r["src_order"] for r in m.orderBy("src_order").collect()] == [0, 1] and rows(D.merge([c, c])) == rows(m)


def test_filters_route_every_row(spark, rows):
    df = pairs(spark, ("q", "ಮನೆ"), ("Q", "ಮನೆ"), ("q", "y"), (None, "ಮನೆ"), ("q2", None), ("q", "ಗೆ"))
    x = C.classify_v1(df)
    assert {r["pos"]: r["reason"] for r in x.collect()} == {0: "Kept", 1: "Duplicate after cleaning", 2: "Empty or too short after cleaning", 3: "Empty or too short after cleaning", 4: "Empty or too short after cleaning", 5: "Kept"}
    y = C.classify_v2(df)
    assert {r["pos"]: r["reason"] for r in y.collect()} == {0: "Kept", 1: "Duplicate", 2: "OCR garbage / too short", 3: "Empty instruction", 4: "OCR garbage / too short", 5: "OCR garbage / too short"}
    for z in (x, y):
        assert C.kept(z).count() + C.removed(z).count() == 6
    r = C.filter_report(x, True).first()
    assert (r["records"], r["kept"], r["duplicates"], r["rejected"], r["latin_left"]) == (6, 2, 1, 3, 0)
    assert C.filter_report(C.classify_v1(pairs(spark).limit(0)), True).first()["records"] == 0


def test_improve(spark):
    df = pairs(spark, ("q", "ನೀರ್ n. water"), ("q", "ನೀರ್"), ("", "x"), ("z", "adj."))
    assert [tuple(r) for r in C.improve(df).collect()] == [(0, "q", "ನೀರ್", True)]
    r = C.improve_report(df).first()
    assert (r["records"], r["kept"], r["dropped_empty"], r["duplicates_removed"]) == (4, 1, 2, 1)


def test_validation(spark):
    df = pairs(spark, ("Straße", "ಕ"), ("STRASSE", "ಕ"), ("q", "a adj. !!"), (None, None), (None, ""))
    r = Q.validate(df).first()
    assert (r["records"], r["duplicates"], r["empty_instruction"], r["suspicious"], r["short_instruction"], r["status"]) == (5, 2, 2, 1, 1, "FAIL")
    assert Q.suspicious(df).first()["reasons"] == [n for n, _ in Q.REASONS]
    assert Q.validate(pairs(spark).limit(0)).first()["status"] == "PASS"


@pytest.mark.parametrize("n, sizes", [(10, (9, 0, 1)), (704, (633, 35, 36))])
def test_split_sizes(spark, n, sizes):
    df = spark.createDataFrame([(k, f"ಕ{k}", "x") for k in range(n)], PAIR)
    a = S.assign(df)
    assert tuple(a.filter(F.col("split") == s).count() for s in ("train", "validation", "test")) == sizes


def test_split_groups_stay_together(spark):
    df = spark.createDataFrame([(k, f"Tulu word for {'W' if k % 2 else 'w'}{k // 4}.", "x") for k in range(400)], PAIR)
    a = S.assign(df)
    assert a.count() == 400 and a.groupBy("word").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0
    st = {r["split"]: r["words"] for r in S.stats(a).collect()}
    assert st == {"train": 90, "validation": 5, "test": 5}
    with pytest.raises(ValueError):
        S.check_ratios((("a", 0.5), ("b", 0.4)))
    assert set(S.python_order(range(20), range(10)).values()) <= {"train", "validation", "test"}


def test_leaks(spark, rows):
    df = spark.createDataFrame([("train", "A", "b"), ("test", "a", "B"), ("validation", "c", None), ("train", "c", None)], "split STRING, instruction STRING, response STRING")
    assert rows(S.leaks(df, S.pair_key())) == [("test|train", 1), ("train|validation", 1)]


def test_chat(spark):
    df = pairs(spark, ("hi", "\n\nಕ"), ("a", "<think>z</think>ಗ"), ("", "x"))
    got = [r["f"] for r in df.select(E.render_full(F.col("instruction"), F.col("response")).alias("f")).collect()]
    assert got[0] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n<think>\n\n</think>\n\nಕ<|im_end|>\n"
    assert "z" not in got[1]
    ex = E.examples(df, limit=80).orderBy("pos").collect()
    assert len(ex) == 2
    for r in ex:
        assert len(r["input_ids"]) == len(r["labels"]) == len(r["attention_mask"]) <= 80
        cut = r["labels"].count(-100)
        assert r["labels"][cut:] == r["input_ids"][cut:] and cut > 0
    p = E.pad_batches(E.examples(df)).collect()
    assert len({len(r["input_ids"]) for r in p}) == 1


def test_token_efficiency(spark):
    t = spark.createDataFrame([("ಕಿ a",), ("",), (None,)], "text STRING")
    got = {r["tokenizer"]: (r["status"], r["tokens"]) for r in E.token_efficiency(t, tokenizers={**E.TOKENIZERS, "broken": lambda c: F.col("no_such_column")}).collect()}
    assert got == {"characters": ("SUCCESS", 4), "utf8_bytes": ("SUCCESS", 8), "words": ("SUCCESS", 2), "broken": ("FAILED", None)}
    assert E.best_tokenizer(E.token_efficiency(t)).first()["tokenizer"] == "words"


def test_public_tokenizers(spark):
    from palmleaf.functions.tokenize import DIRECTORY, FILES, encoder, public_tokenizers, token_ids

    texts = ["ಕಿ a", "", None, "Tulu word for x."]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "pos INT, text STRING")
    got = {r["tokenizer"]: (r["status"], r["tokens"]) for r in E.token_efficiency(df, tokenizers={**public_tokenizers(), "none": lambda c: token_ids("/no/file")(c)}).collect()}
    assert got.pop("none")[0] == "FAILED"
    assert got == {f: ("SUCCESS", sum(len(i) for i in encoder(f"{DIRECTORY}/{f}")([t for t in texts if t]))) for f in FILES}
    ids = token_ids(f"{DIRECTORY}/{FILES[2]}")
    assert [r[0] for r in df.orderBy("pos").select(ids("text")).collect()][1:3] == [[], None]
    pair = spark.createDataFrame([(0, "q", "a")], "pos BIGINT, instruction STRING, response STRING")
    r = E.examples(pair, tokenize=ids).first()
    assert 0 < r["labels"].count(-100) < len(r["labels"])


ODD = ["a", "Ka", "ಕಿ", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", "\u180e", "\u200b", "　", "1", "'s", ".", "😀", "<|endoftext|>", "é", "e\u0301"]


def test_round_trips_are_those_of_whole_texts(spark, monkeypatch):
    from palmleaf.functions import tokenize as K

    rng = random.Random(3)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(40))) for _ in range(400)] + ["", "word " * 40_000, "ಕಿ" * 300, "\n" * 200 + "x", "ಕಿ，1b'sx." * 10_000, "ಕಿ，" * 30_000 + "K"]
    df = spark.createDataFrame([*enumerate(texts), (len(texts), None)], "pos INT, text STRING")
    for n in K.FILES:
        path = f"{K.DIRECTORY}/{n}"
        encode, decode = K.encoder(path), K.decoder(path)
        plain = [decode(encode([t]))[0] == t for t in texts]
        assert [r[0] for r in df.orderBy("pos").select(K.comes_back(path)("text")).collect()] == [*plain, None]
        with monkeypatch.context() as m:  # a decoder that loses characters
            m.setattr(K, "decoder", lambda p, d=decode: lambda ids: [b.replace("K", "").replace("😀", "?") for b in d(ids)])
            assert list(K.RoundTrips(path).check(texts)) == [p and "K" not in t and "😀" not in t for t, p in zip(texts, plain)]


def test_round_trips_encode_a_stretch_once_and_a_group_at_a_time(monkeypatch):
    from palmleaf.functions import tokenize as K

    for n in (n for n in K.FILES if n.startswith("byte_bpe")):
        sizes, encode = [], K.encoder(f"{K.DIRECTORY}/{n}")
        with monkeypatch.context() as m:
            m.setattr(K, "encoder", lambda p, e=encode, s=sizes: lambda texts: (s.append(sum(map(len, texts))), e(texts))[1])
            trips = K.RoundTrips(f"{K.DIRECTORY}/{n}")
        assert all(trips.check(["word " * 20_000, "a word"] * 50)) and sum(sizes) < 20
        sizes.clear()
        texts = [" ".join(f"{k}x{j}" for j in range(200)) for k in range(500)]
        assert all(trips.check(texts)) and max(sizes) <= K.GROUP < sum(sizes)
        sizes.clear()
        assert all(trips.check(texts[-9:])) and not sizes
        assert all(trips.check(["ಕಿ，1b'sx." * 10_000])) and max(sizes) <= K.GROUP < sum(sizes)
        assert 0 < len(trips.known) <= K.KNOWN
        for lo in range(0, 0x3200, 500):  # any character between others
            forms = [f"{k}{c}{c} {c}'{c}s{c}\n\n{c}1{c}\u3000{c}ಕಿ" for c in map(chr, range(lo, lo + 500)) if not "\ud800" <= c <= "\udfff" for k in ("a ", "..")]
            for pattern in (K.STRETCH, K.RUN):
                assert encode(forms) == [sum(encode(pattern.findall(t)), []) for t in forms]


def test_round_trips_take_bounded_memory():
    """A batch of 2,000 texts of 600 characters through the three vocabularies of bytes: it took 853 MB at once."""
    code = """
import resource, pandas as pd
from palmleaf.functions import tokenize as K
K.F.pandas_udf = lambda kind: lambda f: f
texts = pd.Series(["".join(chr(0xC95 + (k * 7 + j * j) % 31) + ("\\u0cbf " if j % 5 == 0 else "\\u0cc1") for j in range(600)) for k in range(2000)])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for n in K.FILES[:3]:
    assert K.comes_back(f"{K.DIRECTORY}/{n}")(texts).all()
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(__file__)), capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert int(out.stdout) < 300


def test_keep_first_with_a_hot_key(spark):
    df = spark.range(3000).select(F.col("id").alias("pos"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.lit(1).alias("is_first"))
    k = keep_first(df, [F.col("k")], "pos")
    assert k.count() == 2001 and k.filter("k = 'hot'").first()["pos"] == 0
    assert mark_first(df, [F.col("k")], "pos", "f").count() == 3000


def test_distributed_rank(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("g"), (F.col("id") * 7).alias("rank_group"))
    got = distributed_rank(df, "g", [F.desc("id")], "rank", "rank_group").collect()
    for g in range(3):
        own = sorted((r for r in got if r["g"] == g), key=lambda r: -r["id"])
        assert [r["rank"] for r in own] == list(range(len(own)))
        total = 0
        for r in own:
            assert r["rank_w"] == total
            total += r["rank_group"]
    assert [r["row_index"] for r in reindex(df.filter("id > 500"), "id").orderBy("id").collect()] == list(range(499))
    assert distributed_rank(df.limit(0), "g", [F.col("id")], "rank").count() == 0


def test_hot_join(spark):
    left = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("k"), "id")
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    right = counts.select("k", F.upper("k").alias("u"))
    got = hot_join(left, right, "k", counts)
    assert got.count() == 9000 and got.filter(F.col("u") != F.upper("k")).count() == 0
    assert hot_join(left.limit(0), right, "k", counts.limit(0)).count() == 0


def test_materialize_reads_the_session_setting(spark, tmp_path):
    class Conf:
        def get(self, name, default):
            return f"file://{tmp_path}/" if name == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    assert shared_dir(Session()) == f"file://{tmp_path}"
    df = materialize(spark.range(5))
    assert df.count() == 5 and all("/palmleaf-" in f for f in df.inputFiles())
    drop_materialized(df)
    with pytest.raises(Exception):
        df.count()


def test_release_all(spark):
    df = materialize(spark.range(3))
    release_all(spark)
    with pytest.raises(Exception):
        df.count()


def test_report_texts(spark):
    from palmleaf.sources import reports

    one = spark.createDataFrame([(1, 2.0)], "records INT, share DOUBLE")
    assert "Records : 1" in reports.as_text(one, "T") and json.loads(reports.as_json(one)) == {"records": 1, "share": 2.0}
    with pytest.raises(ValueError):
        reports.one_row(one.union(one))


def test_python_order_beyond_the_driver(spark):
    words, singles = [f"w{k:03d}" for k in range(57)], list(range(100, 133))
    want = S.python_order(words, singles)
    a, b = S.assign_python_order(spark.createDataFrame([(w,) for w in words * 2], "word STRING"), spark.createDataFrame([(k,) for k in singles], "pos BIGINT"))
    assert {r[0]: r[1] for r in a.collect()} | {r[0]: r[1] for r in b.collect()} == want
    assert S.python_positions(spark, []).count() == 0


def test_padding_counts_examples_not_positions(spark):
    x = spark.createDataFrame([(k * 7, [1] * (k + 1), [1] * (k + 1), [1] * (k + 1)) for k in range(20)], "pos BIGINT, input_ids ARRAY<INT>, labels ARRAY<INT>, attention_mask ARRAY<INT>")
    got = {r["pos"]: (r["batch_no"], len(r["input_ids"]), sum(r["attention_mask"]), r["labels"].count(-100)) for r in E.pad_batches(x).collect()}
    assert got == {k * 7: (k // 16, 16 if k < 16 else 20, k + 1, (16 if k < 16 else 20) - k - 1) for k in range(20)}


def test_failing_tokenizer_is_a_row(spark):
    bad = F.pandas_udf(lambda x: x.map(lambda t: 1 // 0), "long")
    got = E.token_efficiency(spark.createDataFrame([("ab",), (None,)], "text STRING"), tokenizers={"n": F.length, "bad": bad}).collect()
    assert [(r["tokenizer"], r["status"], r["tokens"]) for r in got] == [("n", "SUCCESS", 2), ("bad", "FAILED", None)]
