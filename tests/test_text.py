import random
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palmleaf.functions import arrays as A
from palmleaf.functions import text as X

GOLDEN = [
    ("ನೀರ್", "ನೀರ್", "ನೀರ್", "ನೀರ್"), ("ನೀರ್ n. water", "ನೀರ್", "ನೀರ್", "ನೀರ್"), ("ಮನೆ pron. ಇಲ್ಲ್", "ಮನೆ pro ಇಲ್ಲ್", "ಮನೆ ಇಲ್ಲ್", "ಮನೆ ಇಲ್ಲ್"), ("ಮನೆ. . ಇಲ್ಲ್", "ಮನೆ.. ಇಲ್ಲ್", "ಮನೆ. ಇಲ್ಲ್", "ಮನೆ.. ಇಲ್ಲ್"),
    ("ಮನೆ,,ಇಲ್ಲ್ ..", "ಮನೆ,ಇಲ್ಲ್", "ಮನೆ, ಇಲ್ಲ್", "ಮನೆ,ಇಲ್ಲ್."), ("half-grown- ಕೂಸು", "half-grown- ಕೂಸು", "ಕೂಸು", "ಕೂಸು"), ("y", "y", "", ""), ("3.5 ಮನೆ", "3.5 ಮನೆ", "3. 5 ಮನೆ", "3.5 ಮನೆ"),
    ("ಮನೆ\nwater ಇಲ್ಲ್", "ಮನೆ water ಇಲ್ಲ್", "ಇಲ್ಲ್", "ಮನೆ ಇಲ್ಲ್"), ("A ಮನೆ T. ಇಲ್ಲ್", "ಮನೆ . ಇಲ್ಲ್", "ಮನೆ ಇಲ್ಲ್", "ಮನೆ ಇಲ್ಲ್"), ("ಪಾ ರುಪತ್ಯ್ಯ", "ಪಾ ರುಪತ್ಯ್ಯ", "ಪಾ ರುಪತ್ಯ್ಯ", "ಪಾರುಪತ್ಯ್ಯ"), ("", "", "", ""),
]


def col(spark, values):
    return spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k INT, c STRING")


def apply(spark, values, *fs):
    return [tuple(r)[1:] for r in sorted(col(spark, values).select("k", *(f(F.col("c")).alias(f"f{n}") for n, f in enumerate(fs))).collect())]


def test_golden_cleaners(spark):
    got = apply(spark, [g[0] for g in GOLDEN], lambda c: X.improve_noise(X.improve_text(c)), X.clean_response_v1, X.clean_response_v2)
    assert got == [g[1:] for g in GOLDEN]


def test_white_space_and_digits_match_unicode_for_all_characters(spark):
    chars = [chr(c) for c in range(0x3100) if unicodedata.category(chr(c)) not in ("Cs", "Cn")]
    got = apply(spark, [f"a{c}b" for c in chars], lambda c: X.collapse_spaces(c) == "a b", X.has_digit)
    for c, (space, digit) in zip(chars, got):
        assert space == bool(re.fullmatch(r"\s", c)) or c == " ", hex(ord(c))
        assert digit == bool(re.fullmatch(r"\d", c)), hex(ord(c))


def test_casefold_equals_the_standard_one(spark):
    chars = [chr(c) for c in [*range(0x250), *range(0x370, 0x590), *range(0x1E00, 0x2000), *range(0xFB00, 0xFB20), 0x10400] if unicodedata.category(chr(c)) not in ("Cs", "Cn")]
    assert [g[0] for g in apply(spark, chars, X.casefold)] == [c.casefold() for c in chars]


def test_portable_word_boundary(spark):
    assert apply(spark, ["ಕಿT", "xT", "T", "A B"], X.remove_isolated_capitals) == [("ಕಿ",), ("xT",), ("",), (" ",)]


def test_template_word(spark):
    cases = {"Translate 'Ability' to Tulu.": "Ability", "tulu word for ability.": "ability", "What is the Tulu meaning of x?": "x", "How do you say a b in Tulu?": "a b", "ಕ?": None, "Tulu word for  .": None, "": None, "Give the Tulu translation of a{}%$1.": "a{}%$1"}
    assert [g[0] for g in apply(spark, list(cases), X.template_word)] == list(cases.values())


def test_templates_keep_braces_and_signs(spark):
    for t in X.TEMPLATES:
        assert apply(spark, ["a{0}%s$1"], lambda c, t=t: X.fill_template(t, c)) == [(t.replace("{}", "a{0}%s$1"),)]


def test_garbage(spark):
    assert [g[0] for g in apply(spark, ["ಗೆ", "ಮನೆ", "ೌ್್್", "", "ab", "a b c"], X.is_garbage)] == [True, False, False, True, True, False]
    assert apply(spark, ["್್್್"], X.is_garbage) == [(True,)]


def test_meanings(spark):
    got = apply(spark, ["a, b ,a", ", ,", "", "x"], A.meanings, A.distinct_meanings, lambda c: A.has_duplicates(A.meanings(c)), lambda c: A.first(A.meanings(c)))
    assert got == [(["a", "b", "a"], "a, b", True, "a"), ([], "", False, None), ([], "", False, None), (["x"], "x", False, "x")]


def test_code_points_round_trip(spark):
    texts = ["ಕಿ😀a", "", "\n x"]
    assert [("".join(map(chr, g[0])),) for g in apply(spark, texts, A.code_points)] == [(t,) for t in texts]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=" \t\nabA.,;:!?ಕಿ೧1\xa0", max_size=30), min_size=1, max_size=40))
def test_properties(spark, texts):
    got = apply(spark, texts, X.collapse_spaces, lambda c: X.collapse_spaces(X.collapse_spaces(c)), X.collapse_punctuation, lambda c: X.collapse_punctuation(X.collapse_punctuation(c)), lambda c: X.has_latin(X.clean_response_v1(c)), lambda c: X.has_repeated_mark(X.clean_response_v1(c)), X.strip)
    for t, (a, aa, p, pp, latin, marks, s) in zip(texts, got):
        assert a == aa == re.sub(r"\s+", " ", t)
        assert p == pp == re.sub(r"[.,;:!?]{2,}", lambda m: m[0][0], t)
        assert not latin and not marks
        assert s == t.strip()


def test_nulls_stay_null(spark):
    fs = [X.standardize, X.fix_format, X.clean_response_v1, X.casefold, A.meanings, X.template_word, X.has_digit]
    assert apply(spark, [None], *fs) == [(None,) * len(fs)]


@pytest.mark.parametrize("n", [100_000])
def test_very_long_text(spark, n):
    t = ("ಮನೆ, water. " * (n // 12)).strip()
    assert apply(spark, [t], lambda c: F.length(X.clean_response_v1(c)) > 0) == [(True,)]


def test_random_strings_against_plain_python(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(" ,.;:!?aZಕ೧\t\n ") for _ in range(rng.randrange(30))) for _ in range(300)]

    def standard(t):
        t = re.sub(r"\s+", " ", t.strip())
        return re.sub(r",\s*", ", ", re.sub(r"\s+,", ",", t)).strip()

    assert [g[0] for g in apply(spark, texts, X.standardize)] == [standard(t) for t in texts]
