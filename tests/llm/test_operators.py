import collections
import random

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from palmleaf.llm import pair_defects as P
from palmleaf.llm.cross_split import _adjacent, common, edits, find_overlaps, overlap_classes, stride
from palmleaf.llm.formatting_copies import collapse, runs_of_copies
from palmleaf.llm.groups import assign_splits, headwords, spanning_forest, tie_by_headword
from palmleaf.llm.codepoints import Words, gram_hash
from palmleaf.llm.leaks import Index, bounds, find_leaks, weights
from palmleaf.llm.mixing import Tree, mix, permuted, quotas
from palmleaf.llm.pieces import cut_oversized
from palmleaf.llm.tokens import Counter, count_tokens
from palmleaf.llm.visual import add_canonical, canonical, look_classes, same_look_pairs

RECORD = "record_id BIGINT, instruction STRING, response STRING, meta STRING, first_id STRING, k STRING"


def records(spark, *rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], RECORD)


def words(s):
    return regex.findall(r"[\p{L}\p{M}\p{N}]+", (s or "").lower())


# 2


def test_copies_in_other_formatting(spark, rows):
    df = records(spark, (5, "A b.", "ಕ", '{"a": 1, "b": "x"}'), (3, "ab", " ಕ!", '{"b":"x","a":1}'), (4, "ab", "ಕ", None), (6, "a B", "ಕ", None), (7, None, None, None), (8, "", "-", None), (9, "ab", "ಕ", '{"a": 2}'), (None, "ab", "ಕ", None))
    assert rows(runs_of_copies(df, "record_id", ["instruction", "response"], ["meta"])) == [(3, 5), (4, 6), (7, 8)]
    assert rows(collapse(df, "record_id", ["instruction", "response"], ["meta"])) == [(3, 2), (4, 2), (7, 2), (9, 1)]
    assert runs_of_copies(df.limit(0), "record_id", ["instruction"]).count() == 0


def test_a_third_of_all_rows_are_copies(spark):
    df = spark.range(6000).select(F.col("id").alias("record_id"), F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("instruction"), F.lit("x" * 50).alias("response"))
    got = runs_of_copies(df.repartition(5), "record_id", ["instruction", "response"], partitions=16)
    assert got.count() == 1999 and got.select("first_id").distinct().collect() == [(0,)]


def test_bad_json_counts_by_its_text(spark, rows):
    df = records(spark, (1, "a", "b", "{bad"), (2, "a", "b", " {bad "), (3, "a", "b", '{"x": 1, "x": 2}'))
    assert rows(runs_of_copies(df, "record_id", ["instruction", "response"], ["meta"])) == [(1, 2)]


# 3


def test_headwords(spark):
    cases = {
        "Translate 'to Run' to Tulu.": ["torun"], "pls, what is the  Tulu meaning of half-grown cat??": ["halfgrowncat"], "Compare the Tulu words for \"a b\" and 'C'.": ["ab", "c"], "translate ‘a‘ and ‘b‘ to tulu": ["a", "b"],
        "I came across \"x\" in a reader; what is it called in Tulu?": ["x"], "Use the Tulu word for 'x' in a sentence.": ["x"], "ಕ?": [], None: [], "": [], "Compare the Tulu words for 'a' and 'A'.": ["a"],
        "Q: to climb - what do Tulu speakers call it?": ["toclimb"], " question : x; what do Tulu speakers call it": ["x"], "pls, pure cow - what do Tulu speakers call it?": ["purecow"], "Q & A - what do Tulu speakers call it?": ["qa"], "Tulu word for question: x": ["questionx"],
    }
    df = spark.createDataFrame([(k, c) for k, c in enumerate(cases)], "k INT, c STRING")
    assert [r[1] for r in sorted(df.select("k", headwords(F.col("c"))).collect())] == list(cases.values())


@pytest.mark.parametrize("seed", [1, 2])
def test_forest_against_union_find(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(40)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in pairs:
        if u is not None:
            parent[find(u)] = find(v)
    least = {}
    for x in list(parent):
        least[find(x)] = min(x, least.get(find(x), x))
    labels, forest = spanning_forest(spark.createDataFrame(pairs, "u BIGINT, v BIGINT"))
    assert {r["node"]: r["root"] for r in labels.collect()} == {x: least[find(x)] for x in parent}
    assert forest.count() == len(parent) - len(least)
    assert spanning_forest(spark.createDataFrame([], "u BIGINT, v BIGINT"))[0].count() == 0


def test_ties_and_splits(spark):
    ask = lambda k: f"Compare the Tulu words for 'w{k}' and 'w{k + 1}'." if k % 10 == 0 else f"Tulu word for w{k % 500}."
    df = records(spark, *((k, ask(k) if k % 3 else "Tulu word for hot.", "x", None) for k in range(3000)), (9000, None, None, None), (9001, "ಕ", None, None))
    tied = tie_by_headword(df)
    assert tied.count() == 3000 and tied.filter("first_id > record_id").count() == 0
    assert tied.filter("first_id = 0").count() >= 1000
    groups = df.select("record_id").join(tied, "record_id", "left").select("record_id", F.coalesce("first_id", "record_id").alias("g"))
    got = assign_splits(groups, [("train", 0.8), ("validation", 0.1), ("test", 0.1)], "g", "record_id")
    share = {r["split"]: r["n"] / 3002 for r in got.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert abs(share["train"] - 0.8) < 0.02 and abs(share["validation"] - 0.1) < 0.02
    assert got.groupBy("g").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0 and got.count() == 3002
    assert assign_splits(groups.limit(0), [("a", 1.0)], "g", "record_id").count() == 0
    assert tie_by_headword(df.limit(0)).count() == 0


# 4

GOOD = [(f"Tulu word for w{k} x{k}.", "ಕಿಮ್ಮ ಗೂಡು" if k % 2 else f"ಮನೆ{'ಕಗಜಡತಪ'[k % 6]}, ಇಲ್ಲ್") for k in range(150)] + [(f"ನೀರ್ ಏರ್ ಕೊರ್ಪೆರ್ {'ಕಗಜಡತಪ'[k % 6]}?", f"ಅವು {'ಕಗಜಡತಪ'[k % 6]}ನ ಮನೆ ಉಂಡು. ಯಾನ್ ಬರ್ಪೆ ಕಲ್ಪುವೆ, ಪೋಪೆ ಕೆಲಸ ಮಲ್ಪುವೆ.") for k in range(150)]


UNSEEN = (
    "This is a task I am afraid I can not carry out.", "Apologies, that lies outside of my competence.", "Translating that is not something I'm capable of.", "My training does not let me respond to this.", "I would like to help, but I have no knowledge of this term.",
    "No can do, sorry.", "Regrettably, your query cannot be answered by me.", "I'm unsure how to translate this, so I won't.", "Sorry, not able to do that one.", "We regret to inform you that this cannot be provided.",
)


def test_defects_on_rows_and_phrases_not_seen():
    rng = random.Random(1)
    rows = list(GOOD)
    rng.shuffle(rows)
    m = P.fit(sorted(rows[:220]))
    assert min(m.report[x] for x in P.REPORTED) > 0.9 and set(m.report) == set(P.LABELS)  # on phrases of their own
    ins, res, y, _ = P.synthesize(sorted(rows[220:]), seed=99)
    own = [k for k, label in enumerate(P.LABELS) if label in P.REPORTED]
    p = (P.scores(m, pa.array(ins, pa.string()), pa.array(res, pa.string())) >= m.thresholds)[:, own]
    first = np.where(p.any(axis=1), p.argmax(axis=1), -1)
    want = np.where(y[:, own].any(axis=1), y[:, own].argmax(axis=1), -1)
    assert (first == want).mean() > 0.95
    asked = pa.array(["Tulu word for water."] * len(UNSEEN))
    refused = P.scores(m, asked, pa.array(UNSEEN))[:, P.LABELS.index("refusal")] >= m.thresholds[P.LABELS.index("refusal")]
    assert refused.mean() >= 0.9  # written by hand, none from the parts that training puts together


def test_copied_spans_against_plain_reading():
    rng = random.Random(8)

    def plain(r, i):
        def inside(x):
            for size in range(1, len(x) + 1):
                if len(x) % size == 0 and x == x[:size] * (len(x) // size):
                    return any(i[k : k + size] == x[:size] for k in range(len(i) - size + 1))
            return False

        k = 0
        while k < min(2, len(r)) and r[k] not in i:
            k += 1
        return inside(r), k > 0 and inside(r[k:]), len(r) > len(i) + 2 and bool(i) and r[: len(i)] == i

    pairs = [(["a"], [])]
    for _ in range(400):
        i = [rng.choice("abcd") for _ in range(rng.randrange(0, 9))]
        a = rng.randrange(len(i) + 1)
        r = [*rng.choices("xyz", k=rng.randrange(3)), *(i[a : a + rng.randrange(1, 6)] * rng.randrange(1, 4))] if rng.random() < 0.8 else [*i, "q", "r", "s"]
        pairs.append((i, r))
    words_ = [P.Words(pa.array([" ".join(x) for x in col])) for col in zip(*pairs)]
    shared = np.array([w in i for i, r in pairs for w in r], bool)
    got = P._spans(words_[1], words_[0], shared, np.arange(len(pairs)))
    assert [tuple(bool(g[k]) for g in got) for k in range(len(pairs))] == [plain(r, i) for i, r in pairs]


def test_model_is_written_and_read(spark, tmp_path):
    m = P.fit(sorted(GOOD)[:60], epochs=3)
    P.save(spark, m, f"{tmp_path}/model")
    back = P.load(spark, f"{tmp_path}/model")
    ins, res = (pa.array(x) for x in zip(*GOOD[:50]))
    assert np.allclose(P.scores(m, ins, res), P.scores(back, ins, res)) and np.allclose(m.thresholds, back.thresholds) and back.script == m.script


def test_flagging(spark):
    df = records(spark, *((k, *r, None) for k, r in enumerate(GOOD)), (1000, GOOD[0][0], None, None), (1001, GOOD[0][0], "I'm sorry, but I cannot translate this.", None), (1002, "Tulu word for w0 x0.", "w0 x0", None), (1003, "Tulu word for w0 x0.", "காடு மலை", None), (1004, None, "ಕಿಮ್ಮ (ಕಿ", None))
    m = P.train(df)
    got = {r["record_id"]: r["defect"] for r in P.flag_defects(df, m).collect()}
    assert {k: v for k, v in got.items() if k >= 1000} == {1000: "empty", 1001: "refusal", 1002: "copy", 1003: "wrong_language", 1004: "truncated"}
    assert sum(k < 1000 for k in got) <= 3
    assert P.flag_defects(df.limit(0), m).count() == 0 and P.train(df.limit(0)).report == {}
    assert len(P.scores(m, pa.array([None, ""], pa.string()), pa.array(["x" * 200_000, None], pa.string()))) == 2


# 5


def test_edits():
    rng = random.Random(5)

    def full(a, b):
        d = list(range(len(b) + 1))
        for x in a:
            e = [d[0] + 1]
            for j, y in enumerate(b):
                e.append(min(e[-1] + 1, d[j + 1] + 1, d[j] + (x != y)))
            d = e
        return d[-1]

    for _ in range(500):
        a = [rng.randrange(4) for _ in range(rng.randrange(12))]
        b = [rng.randrange(4) for _ in range(rng.randrange(12))]
        for most in (0, 1, 3, 20):
            assert edits(a, b, most) == min(full(a, b), most + 1)
    assert all(stride(m) >= 1 for m in range(18, 500))


def test_one_opening_of_all_records(spark):
    """A phrase that all records begin with makes one interval; it is not compared all with all, and nothing is missed."""
    say = lambda k, last: f"it is an old saying of ours that {' '.join(f'x{(k * 31 + j * 7) % 997}' for j in range(5))} {last}"
    train = [(k, f"please tell me now what is meant by the word w{k}", say(k, "end"), None) for k in range(1500)]
    evals = [(10_000 + k, f"please tell me now what is meant by the word w{k}", say(k, "other"), None) for k in range(0, 1500, 10)]
    got = find_overlaps(records(spark, *train), records(spark, *evals), hot_pairs=1000)
    assert {(r["train_id"], r["eval_id"]) for r in got.collect()} >= {(k, 10_000 + k) for k in range(0, 1500, 10)}


def test_neighbours_in_any_batches():
    """The scan of the sorted array gives the same rows however it is cut into batches, and they are the right ones."""
    rng = np.random.default_rng(4)
    words_ = rng.integers(0, 2, (400, 12)).astype(np.uint8)
    key = np.zeros((400, 44), np.uint8)
    key[:, 8::3] = words_
    key[:, 7] = rng.integers(0, 3, 400)
    key = key[np.lexsort(key.T[::-1])]
    side, need = rng.integers(0, 8, 400) == 0, rng.integers(5, 10, 400)
    need[side] = 0
    batch = pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in key], pa.binary()), pa.array(side.astype(np.int8)), pa.array(need.astype(np.int8)), pa.array(range(400))], names=["key", "side", "need", "id"])
    want = []
    for k in range(400):
        near = common(np.repeat(key[k : k + 1], 400, axis=0), key)
        if near[side != side[k]].max() >= max(5, need[k]):
            want.append(k)
    breaks = np.flatnonzero(common(key[1:], key[:-1]) < 5) + 1
    ends = {*range(breaks[0]), *range(breaks[-1], 400)}  # these may go on in the next partition
    for size in (400, 1, 7, 50):
        got = [i for b in _adjacent(batch.slice(lo, size) for lo in range(0, 400, size)) for i in b.column(3).to_pylist()]
        assert got == sorted({*want, *ends})
    assert 20 < len(want) < 380


def test_common_prefixes():
    a = np.zeros((3, 44), np.uint8)
    b = a.copy()
    b[1, 14] = 1
    b[2, 0] = 1
    assert common(a, b).tolist() == [12, 2, 0]


def test_overlaps_against_brute_force(spark):
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(40)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))

    def change(t):
        w = t.split()
        for _ in range(rng.randrange(0, max(1, len(w) // 8) + 1)):
            k = rng.randrange(len(w) + 1)
            op = rng.randrange(3)
            if op == 0:
                w.insert(k, rng.choice(vocabulary))
            elif w and op == 1:
                w.pop(min(k, len(w) - 1))
            elif w:
                w[min(k, len(w) - 1)] = rng.choice(vocabulary)
        return rng.choice([" ", ", ", "  "]).join(w).upper()

    train = [(k, text(rng.choice([0, 3, 9, 10, 12, 19, 25])), text(rng.choice([0, 1, 9, 11, 18, 19, 20, 31, 45, 60])), None) for k in range(150)]
    evals = [(1000 + k, change(t[1]), change(t[2]), None) for k, t in enumerate(train)] + [(2000, None, None, None), (2001, train[3][1], None, None)]
    train += [(500 + k, train[k][1], train[k][2].replace(" ", "-"), None) for k in range(20)] + [(700, None, None, None)]
    want = set()
    for i, a, b, _ in train:
        for j, x, y, _ in evals:
            d = [(words(p), words(q)) for p, q in ((a, x), (b, y))]
            if all(edits(p, q, max(len(p), len(q)) // 10) <= max(len(p), len(q)) // 10 for p, q in d):
                want.add((i, j))
    for most in (1 << 17, 1):  # all intervals plain, and all of several records split by rare words
        got = find_overlaps(records(spark, *train), records(spark, *evals), hot_pairs=most).collect()
        assert len(want) > 60 and {(r["train_id"], r["eval_id"]) for r in got} == want and len(got) == len(want)
    links, members = overlap_classes(records(spark, *train), records(spark, *evals))
    assert links.count() < len(want) and members.count() == len({i for i, _ in want}) + len({j for _, j in want})
    assert find_overlaps(records(spark, *train).limit(0), records(spark, *evals)).count() == 0


# 6


def test_covered_words(spark):
    w = [f"w{k}" for k in range(40)]
    texts = [
        (w[:3], w[:17]), ([], []), (w[:2], w[:4]),  # copies of any length count whole
        (w[:12], w[10:30]),  # both texts, each on its own
        (["q"], (w[:5] + ["x"]) * 4), (["p"], w[:20]),  # the same span again; a word changed between two spans
    ]
    train = [(k, " ".join(i), " ".join(r), None) for k, (i, r) in enumerate(texts)]
    evals = [(100 + k, i, r, None) for k, i, r, _ in train]
    evals[4] = (104, "q", " ".join((w[:5] + ["x"]) * 3 + w[:5] + ["y"]), None)
    evals[5] = (105, "p", " ".join(w[:8] + ["x"] + w[9:20]), None)
    got = {(r["train_id"], r["eval_id"]): r["covered"] for r in find_overlaps(records(spark, *train), records(spark, *evals)).collect()}
    assert got == {(0, 100): 20, (1, 101): 0, (2, 102): 6, (3, 103): 32, (4, 104): 24, (5, 105): 20}


def test_look_alikes_of_many_scripts():
    alike = {"ᎪꮯꓮՏհցⲟ𝐚ｆﬁ": "AcAShgoaffi", "Ёлка": "Ëлкa", "а\u0301": "á", "ಂ౦": "ಂ೦", "ಕ౦": "ಕಂ", "ᎪᏟᎬ": "ACE", "ꓬꓳꓴ": "YOU", "a\u200d b\u2009c": "a b c"}
    assert canonical(pa.array(list(alike))).to_pylist() == list(alike.values())
    assert canonical(pa.array(list(alike.values()))).to_pylist() == list(alike.values())  # a form is its own form


def test_look_classes(spark, rows):
    df = spark.createDataFrame([(7, "cap"), (2, "сap"), (3, "cap"), (9, "ｃap"), (4, "map"), (5, None), (None, "cap"), (6, "map")], "id BIGINT, e STRING")
    assert rows(look_classes(df, "id", ["e"])) == [(2, 2, 2, 3, 4), (3, 2, 3, 3, 4), (7, 2, 3, 3, 4), (9, 2, 9, 3, 4)]
    assert look_classes(df.limit(0), "id", ["e"]).count() == 0
    assert same_look_pairs(df, "id", ["e"]).count() == 5


def test_same_look_pairs(spark, rows):
    df = spark.createDataFrame([(1, "cap", "ಕ", "z"), (2, "сap", "ಕ", "z"), (3, "cap", "ಕ", "z"), (4, "cap", None, "z"), (5, "Cap", "ಕ", "z"), (None, "сap", "ಕ", "z")], "id BIGINT, e STRING, t STRING, look_0 STRING")
    assert rows(same_look_pairs(df, "id", ["e", "t"])) == [(1, 2), (2, 3)]
    assert same_look_pairs(df.limit(0), "id", ["e", "t"]).count() == 0
    assert [r["n"] for r in add_canonical(df, {"e": "n"}).orderBy("id").collect()] == ["cap", "cap", "cap", "cap", "cap", "Cap"]
    with pytest.raises(ValueError):
        add_canonical(df, {"e": "E"})
    hot = spark.range(4000).select(F.col("id"), F.when(F.col("id") == 0, F.lit("сap")).otherwise(F.lit("cap")).alias("e"))
    assert same_look_pairs(hot, "id", ["e"]).count() == 3999


# 7


def test_leaks_against_brute_force(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["ka", "gu", "MA", "ne", "li"]) + str(rng.randrange(9)) for _ in range(n))
    items = [(k, text(rng.randrange(5, 40)), "x") for k in range(30)]
    docs = []
    for k in range(200):
        w = text(rng.randrange(0, 120)).split()
        if k % 2:
            it = rng.choice(items)[1].split()
            a = rng.randrange(len(it))
            at = rng.randrange(len(w) + 1)
            w[at:at] = it[a : a + rng.randrange(1, 20)]
        docs.append((k, ", ".join(w).lower() if k % 3 else " ".join(w), "y"))
    docs += [(900, None, "y"), (901, "", "y"), (None, items[0][1], "y"), (902, " ".join(i[1] for i in items) * 30, "y")]
    index = collections.defaultdict(set)
    for i, t, _ in items:
        w = words(t)
        for k in range(len(w) - 9):
            index[tuple(w[k : k + 10])].add(i)
    want = {(d, i) for d, t, _ in docs if d is not None for w in [words(t)] for k in range(len(w) - 9) for i in index.get(tuple(w[k : k + 10]), ())}
    D = spark.createDataFrame(docs, "doc_id BIGINT, text STRING, item_id STRING")
    I = spark.createDataFrame(items, "item_id BIGINT, text STRING, doc_id STRING")  # noqa: E741
    for size in (64 << 20, 20_000):  # one block of items, and several
        got = find_leaks(D, I, index_bytes=size).filter("exact_windows > 0 AND window_words = 10").collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)
    assert find_leaks(D.limit(0), I).count() == 0 and find_leaks(D, I.limit(0)).count() == 0
    assert [sum(b for _, b in bounds(r)) for r in (0, 1, 2, 3)] == [64] * 4


# 8


def test_leaked_items_with_changed_words(spark):
    w = [f"w{k}" for k in range(60)]
    other = [f"o{k}" for k in range(50)]
    passages = {1: w, 2: w[:30] + ["x"] + w[31:], 3: w[:20] + ["x"] + w[20:], 4: w[:30], 5: w[:59], 8: w[30:] + w[:30], 6: [*w[:10], *"xyz", *w[13:26], *"xyz", *w[29:]]}
    docs = spark.createDataFrame([(k, " ".join(other + p + other[::-1])) for k, p in passages.items()] + [(7, " ".join(w[2:]))], "doc_id BIGINT, text STRING")
    got = {r["doc_id"]: r for r in find_leaks(docs, spark.createDataFrame([(1, " ".join(w))], "item_id BIGINT, text STRING")).collect()}
    near = {k: r["item_similarity"] for k, r in got.items()}
    assert set(got) == {*passages, 7} and near[1] == 1 and near[4] == near[6] == 0
    assert all(0.8 <= near[k] < 1 for k in (2, 3, 5, 7)), near
    assert near[8] > 0.8  # halves in the other order
    assert got[2]["windows"] == 41 and near[2] > 41 / 51  # a changed word costs ten windows of 51


def test_short_items_are_found_whole(spark):
    items = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e f g"), (3, "a b c d"), (4, "q r s t u v w x y")], "item_id BIGINT, text STRING")
    docs = spark.createDataFrame([(1, "x a b c d e y"), (2, "A, b; c d e f g"), (3, "a b c d f"), (4, "q r s t u v w x z")], "doc_id BIGINT, text STRING")
    got = {(r["doc_id"], r["item_id"]): r for r in find_leaks(docs, items).filter("exact_windows > 0").collect()}
    assert set(got) == {(1, 1), (2, 1), (2, 2)} and all(r["item_similarity"] == 1 and r["window_words"] < 10 for r in got.values())


def test_recall_of_passages_with_edits(spark):
    """Passages of items with planted edits, against the similarity of every item-sized window of every document."""
    rng = random.Random(12)
    items = {k: [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(25, 160))] for k in range(25)}
    docs = {}
    for k in range(150):
        w = list(items[k % 25])
        for _ in range(rng.randrange(0, 5)):
            at = rng.randrange(len(w))
            w[at : at + rng.randrange(2)] = [f"n{rng.randrange(999)}"] * rng.randrange(2)
        around = [f"f{rng.randrange(999)}" for _ in range(40)]
        docs[k] = around[:20] + w + around[20:]

    def grams(w):
        return {tuple(w[j : j + 5]) for j in range(len(w) - 4)}

    index = Index(np.array([0]), pa.array(["a b c d e f g h i j"]), 10, 5, 2)
    assert index.size.tolist() == [1]
    weight = {}

    def similarity(a, b):
        for g in (a | b) - set(weight):
            weight[g] = float(weights(gram_hash(Words(pa.array([" ".join(g)])).hash, 5))[0])
        both = sum(weight[g] for g in a & b)
        return both / (sum(weight[g] for g in a) + sum(weight[g] for g in b) - both)

    want = {}
    for k, w in docs.items():
        own, n = grams(items[k % 25]), len(items[k % 25])
        best = max(similarity(own, grams(w[j : j + n])) for j in range(max(0, 14), min(len(w) - n, 27) + 1))
        if best >= 0.8:
            want[k, k % 25] = best
    D = spark.createDataFrame([(k, " ".join(w)) for k, w in docs.items()], "doc_id BIGINT, text STRING")
    I = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id BIGINT, text STRING")  # noqa: E741
    got = {(r["doc_id"], r["item_id"]): r["item_similarity"] for r in find_leaks(D, I).filter("item_similarity > 0").collect()}
    assert len(want) > 40 and set(want) <= set(got)  # recall 1
    assert all(got[p] >= want[p] - 1e-9 for p in want)


def test_mixing(spark):
    rng = random.Random(4)
    docs = [(k, " ".join(["water"] * rng.randrange(0, 60)), rng.choice(["a", "a", "a", "b", "c", None])) for k in range(600)] + [(900, None, "a")]
    D = spark.createDataFrame(docs, "doc_id BIGINT, text STRING, source STRING")
    T = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 3), ("z", 0.1, 2)], "source STRING, target_share DOUBLE, max_repeats INT")
    m, s = mix(D, T, shard_tokens=1000, block_tokens=256)
    got, by = m.collect(), {r["source"]: r for r in s.collect()}
    uses = collections.Counter((r["doc_id"], r["source"]) for r in got)
    assert max(n for (_, src), n in uses.items() if src == "a") == 1 and max(n for (_, src), n in uses.items() if src == "b") <= 3
    assert by["z"]["actual_share"] == 0 and abs(sum(r["actual_share"] for r in by.values()) - 1) < 1e-9
    for src in "ab":
        assert by[src]["tokens"] == sum(r["tokens"] for r in got if r["source"] == src)
    for shard in {r["shard"] for r in got}:
        assert sorted(r["pos"] for r in got if r["shard"] == shard) == list(range(1, 1 + sum(r["shard"] == shard for r in got)))
    held = {r["source"]: r["actual_share"] for r in mix(D, T, hold_shares=True, shard_tokens=2000, block_tokens=256)[1].collect()}
    assert abs(held["a"] - 0.5 / 0.9) < 0.01
    assert mix(D.limit(0), T)[0].count() == 0 and mix(D, T.limit(0))[0].count() == 0


def test_quotas_and_tree():
    assert quotas({"a": 100, "b": 10}, {"a": (0.5, 1), "b": (0.5, 2), "c": (0.3, 1)}) == {"a": 90, "b": 20}
    assert quotas({"a": 100, "b": 10, "d": 50}, {"a": (0.3, 3), "b": (0.3, 2), "d": (0.4, 9)}) == {"a": 60, "b": 20, "d": 80}
    assert quotas({"a": 100, "b": 10}, {"a": (0.5, 1), "b": (0.5, 2)}, wanted=10_000) == {"a": 100, "b": 20}
    assert quotas({"a": 100, "b": 10}, {"a": (0.5, 1), "b": (0.5, 2)}, hold_shares=True) == {"a": 20, "b": 20}
    blocks = [100, 7, 0, 300]
    source = np.repeat(np.arange(4), blocks)
    block = np.concatenate([np.arange(b) for b in blocks])
    shard = Tree(blocks, 6, 1).place(source, block)
    sizes = np.bincount(shard, minlength=6)
    assert sizes.sum() == 407 and sizes.max() - sizes.min() <= 3
    some = np.arange(0, 407, 5)  # another task, other blocks: the same places
    assert (Tree(blocks, 6, 1).place(source[some], block[some]) == shard[some]).all()


@pytest.mark.parametrize("m", [1, 2, 3, 17, 1000, 4096])
def test_permutation(m):
    p = permuted(np.arange(m), m, 3)
    assert sorted(p.tolist()) == list(range(m))
    if m >= 1000:
        steps = np.diff(p) % m
        assert len(np.unique(steps)) > m // 2  # no arithmetic progression
        assert abs(np.corrcoef(np.arange(m), p)[0, 1]) < 0.1


# 9


def test_token_counts_equal_the_tokenizer(spark):
    rng = random.Random(6)
    c = Counter()
    texts = ["".join(rng.choice(["a", "Ka", "ಕಿ", " ", "  ", "\n", "\n\n", "\t", "　", "1", "'s", ".", "“", "😀", "\x0b"]) for _ in range(rng.randrange(40))) for _ in range(500)]
    assert c.count(pa.array(texts)).tolist() == [c.size(t) for t in texts]
    got = count_tokens(spark.createDataFrame([(1, None), (2, ""), (3, "a b")], "id INT, text STRING"), ["id"], "text")
    assert {r["id"]: r["tokens"] for r in got.collect()} == {1: 0, 2: 0, 3: 2}


def test_pieces(spark):
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice(["water", "ನೀರ್", "e.g.", "x" * 60, "Dr.", "gift"]) + rng.choice([" ", ". ", ", ", "\n", "\n\n", "? ", "  "]) for _ in range(n))
    docs = [(k, text(rng.randrange(0, 200)), k) for k in range(40)] + [(50, None, 0), (51, "", 0), (52, "ಕಿ" * 3000, 0), (53, "a" * 5000, 0), (54, "\n" * 2000 + "x", 0), (55, "short", 0)]
    D = spark.createDataFrame(docs, "doc_id BIGINT, text STRING, piece BIGINT")
    L = spark.createDataFrame([("s", 40, 8), ("m", 100, 0)], "profile STRING, max_tokens INT, overlap_tokens INT")
    c, at = Counter(), {d: t for d, t, _ in docs}
    got = collections.defaultdict(list)
    for r in cut_oversized(D, L).collect():
        got[r["doc_id"], r["profile"]].append(r)
    assert set(got) == {(d, p) for d, t in at.items() for p, m in (("s", 40), ("m", 100)) if t and c.size(t) > m}
    for (d, p), rs in got.items():
        most, overlap = (40, 8) if p == "s" else (100, 0)
        rs.sort(key=lambda r: r["piece_no"])
        end = 0
        for k, r in enumerate(rs):
            assert r["piece_no"] == k and r["piece"] == at[d][r["start_char"] : r["end_char"]]
            assert c.size(r["piece"]) <= most and r["overlap_tokens"] <= overlap
            assert r["start_char"] <= end < r["end_char"] and (overlap or r["start_char"] == end)
            end = r["end_char"]
        assert end == len(at[d])
    assert cut_oversized(D.limit(0), L).count() == 0 and cut_oversized(D, L.limit(0)).count() == 0
    with pytest.raises(ValueError):
        cut_oversized(D, spark.createDataFrame([("x", 8, 8)], "profile STRING, max_tokens INT, overlap_tokens INT"))


def test_cuts_prefer_strong_boundaries(spark):
    para = "one two three. four five six."
    D = spark.createDataFrame([(1, f"{para}\n\n{para}\n\n{para}")], "doc_id BIGINT, text STRING")
    L = spark.createDataFrame([("p", 12, 0)], "profile STRING, max_tokens INT, overlap_tokens INT")
    assert [r["piece"].strip() for r in cut_oversized(D, L).orderBy("piece_no").collect()] == [para] * 3
