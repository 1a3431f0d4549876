import math
import random

import pytest

from palmleaf.operators.packed import ITEM_KIND, clean, edge_scores, lattice, parse, posteriors, unpack, viterbi

CASES = {
    '["a", "b"]': ["a", "b"], "a, b (c, d), e": ["a", "b (c, d)", "e"], '"x ""y""","z, w"': ['x "y"', "z, w"], "1. a 2. b 3. c": ["a", "b", "c"], "(1) a (2) b": ["a", "b"], "- a\n- b (c, d)": ["a", "b (c, d)"],
    "2,500 k; b": ["2,500 k", "b"], '"a, b"': [], "'K, K'; 'L'": ["K, K", "L"], "a, ,b": ["a", "b"], "a,": [], "೧) ಕ ೨) ಗ": ["ಕ", "ಗ"], "N/A": [], "nan": [], "a-b": [], "“a, b”,c,d": ["a, b", "c", "d"], "a / b,c | d": ["a", "b", "c", "d"],
    "a\tb": ["a", "b"], "• x\n• y": ["x", "y"], "1. a": [], "x, x": ["x", "x"], "": [], "   ": [], "a.": [], "೩,೦೦೦ ಕ": [], "a (b, c": ["a (b", "c"], 'a "b, c': ['a "b', "c"], ",;,": [], "ab *": [],
}


def test_notations(spark):
    df = spark.createDataFrame([(k, c, "z") for k, c in enumerate(CASES)] + [(98, None, "z"), (None, "p;q", "z")], "id BIGINT, cell STRING, value STRING")
    got = {}
    for r in unpack(df, "id", "cell").orderBy("id", "pos").collect():
        got.setdefault(r["id"], []).append(r["value"])
    assert got.pop(None) == ["p", "q"]
    assert got == {k: v for k, (c, v) in enumerate(CASES.items()) if v}


def test_long_values(spark):
    """Unfamiliar values are parted whatever their length: four of 50 characters, two of 100, five of 300."""
    cells = [[f"{chr(97 + k)}{no} " + chr(97 + k) * (size - 3) for k in range(many)] for no, (many, size) in enumerate([(4, 50), (2, 100), (5, 300)])]
    df = spark.createDataFrame([(no, mark.join(c)) for no, (c, mark) in enumerate(zip(cells, [", ", "; ", ","]))], "id BIGINT, cell STRING")
    got = [(r["id"], r["value"]) for r in unpack(df, "id", "cell").orderBy("id", "pos").collect()]
    assert got == [(no, v) for no, c in enumerate(cells) for v in c]


def test_positions_and_copies(spark):
    df = spark.createDataFrame([(k, "a, b") for k in range(3000)] + [(5000, "c; d; c")], "id BIGINT, cell STRING")
    got = unpack(df, "id", "cell")
    assert got.count() == 6003
    assert [tuple(r) for r in got.filter("id = 5000").orderBy("pos").collect()] == [(5000, 1, "c"), (5000, 2, "d"), (5000, 3, "c")]
    assert unpack(df.limit(0), "id", "cell").count() == 0


def test_long_cell(spark):
    df = spark.createDataFrame([(1, ", ".join(f"v{k}" for k in range(2000)))], "id BIGINT, cell STRING")
    assert unpack(df, "id", "cell").count() == 2000


def segmented(spark, cells):
    got = [[] for _ in cells]
    for r in unpack(spark.createDataFrame(list(enumerate(cells)), "id BIGINT, cell STRING"), "id", "cell").orderBy("id", "pos").collect():
        got[r["id"]].append(r["value"])
    return got


@pytest.mark.parametrize("part,hold", [(";", ","), (",", ";"), ("#", "|")])
def test_learned_marks(spark, part, hold):
    """Which mark parts values is learned: the values of the lists hold the other one, and their halves occur nowhere else."""
    rng = random.Random(1)
    vocabulary = [f"a{k}{hold} b{k}" for k in range(30)]
    lists = [rng.sample(vocabulary, rng.randrange(2, 5)) for _ in range(200)]
    assert segmented(spark, [f"{part} ".join(x) for x in lists]) == lists


def test_values_that_hold_many_marks(spark):
    """Values of six and three inner marks that recur beside different texts stay whole; a plain split would cut them."""
    six = "a, b, c, d, e, f, g"
    assert segmented(spark, [f"x{k % 40} | {six}" if k % 2 else f"{six} | y{k % 40}" for k in range(80)]) == [[f"x{k % 40}", six] if k % 2 else [six, f"y{k % 40}"] for k in range(80)]
    colours = "red, white, blue, green"
    assert segmented(spark, [f"w{k}; {colours}" if k < 100 else f"w{k - 100}; z{k}" for k in range(200)]) == [[f"w{k}", colours] if k < 100 else [f"w{k - 100}", f"z{k}"] for k in range(200)]


def test_repeated_lists_are_no_values(spark):
    """A list that recurs is still parted where its mark parts values elsewhere."""
    cells = ["p, q", "p, q | r", "s | p, q"] * 3 + [f"v{k % 7}, v{(k * 3) % 11}" for k in range(60)]
    assert segmented(spark, cells)[:3] == [["p", "q"], ["p", "q", "r"], ["s", "p", "q"]]


def test_lattice():
    assert lattice("") == [(0, 1)] and lattice(",,") == [(0, 1), (0, 3), (1, 2), (2, 3)]
    assert lattice(";,,") == [(0, 1), (0, 2), (0, 4), (1, 2), (1, 4), (2, 3), (3, 4)]  # no value beside a mark that it holds
    assert len(lattice("," * 2000)) == 2002
    for marks in (",,", ";,,|", ",;,;,"):
        n, edges = len(marks) + 1, lattice(marks)
        scores = edge_scores(edges, marks, [1.0 + k % 3 for k in range(len(edges))], {",": 0.7, ";": 0.2})
        paths = [[]]
        while any((p[-1][1] if p else 0) < n for p in paths):
            paths = [q for p in paths for q in ([p] if p and p[-1][1] == n else [[*p, e] for e in edges if e[0] == (p[-1][1] if p else 0)])]
        weight = [math.exp(sum(scores[edges.index(e)] for e in p)) for p in paths]
        want = [sum(w for p, w in zip(paths, weight) if e in p) / sum(weight) for e in edges]
        assert posteriors(n, edges, scores) == pytest.approx(want)
        assert viterbi(n, edges, scores) == paths[weight.index(max(weight))]
    assert viterbi(3, lattice(",,"), [0.0] * 4) == [(0, 1), (1, 2), (2, 3)]  # ties part


def test_clean():
    assert [clean(x) for x in (' "a" ', "* a", "-", '"a" b "c"', "'it''s'")] == ["a", "a", "", '"a" b "c"', "it's"]
    assert [[c[2] for c in g] for g in parse("(1) a (b, c) (2) d; # e #")[2]] == [[ITEM_KIND], [";", "#"]]
