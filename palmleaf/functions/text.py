"""Scalar text functions as column expressions. Classes are spelt out so that Java matches what Unicode says."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

# Portable classes: Unicode white space, word characters, decimal digits.
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
NOT_WS_OR_PUNCT = r"[^\s\x0b\x1c-\x1f\x85\p{Z}.,;:!?]"
WORD = r"[\p{L}\p{N}_]"
DIGITS = r"\p{Nd}+"
SPECIAL = r"[#@%^&*=+{}<>|~`$]"
PUNCT = r"[.,;:!?]"
LATIN = "[A-Za-z]"
# Fixed values, in the order in which they are removed: the order decides what is left of "pron.".
ABBREVIATIONS = ("adj.", "adv.", "v.", "n.", "s.", "pron.", "prep.", "conj.", "interj.", "aux.")
ABBREVIATIONS_CF = (*ABBREVIATIONS, "cf.")
# Literal corrections of scanned text, applied in order.
OCR_CORRECTIONS = (("ಪಾ ರುಪತ್ಯ್ಯ", "ಪಾರುಪತ್ಯ್ಯ"), ("ಪ್ರಮಾಣಪೂರ್ವಕಾ ದ್", "ಪ್ರಮಾಣಪೂರ್ವಕಾದ್"))
# Responses that are scanning residue.
GARBAGE_WORDS = ("ಿ", "ಾ", "ು", "ೂ", "ೆ", "ೇ", "ೈ", "ೊ", "ೋ", "ೌ", "ಓ", "ಗೆ", "ಗಿ", "ತಿ", "ಗ", "ದ", "ಕ್")
NA_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def text(c: Column) -> Column:
    return c.cast("string")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"\A{WS}+|{WS}+\z", "")


def collapse_spaces(c: Column) -> Column:
    return F.regexp_replace(c, WS + "+", " ")


def remove_zero_width(c: Column) -> Column:
    return F.regexp_replace(c, r"[\x{200B}-\x{200D}\x{FEFF}]", "")


def clean_unicode(c: Column) -> Column:
    return strip(remove_zero_width(c))


def remove_extra_spaces(c: Column) -> Column:
    return strip(collapse_spaces(c))


def comma_spacing(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, WS + "+,", ","), "," + WS + "*", ", ")


def normalize_commas(c: Column) -> Column:
    return strip(comma_spacing(c))


def standardize(c: Column) -> Column:
    return strip(comma_spacing(collapse_spaces(strip(c))))


def fix_format(c: Column) -> Column:
    """The formatting that follows every applied fix."""
    return strip_set(collapse_spaces(comma_spacing(c)))


def strip_set(c: Column) -> Column:
    return F.regexp_replace(c, r"\A[ ,]+|[ ,]+\z", "")


def remove_digits(c: Column) -> Column:
    return F.regexp_replace(c, DIGITS, "")


def remove_special(c: Column) -> Column:
    return F.regexp_replace(c, SPECIAL, "")


def collapse_commas(c: Column) -> Column:
    return F.regexp_replace(c, ",+", ",")


def no_space_before_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, WS + "+([.,;:!?])", "$1")


def space_after_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, f"({PUNCT})(?={NOT_WS_OR_PUNCT})", "$1 ")


def collapse_punctuation(c: Column) -> Column:
    """A run of marks becomes its first one."""
    return F.regexp_replace(c, f"({PUNCT}){PUNCT}+", "$1")


def remove_literals(c: Column, words=ABBREVIATIONS_CF) -> Column:
    return functools.reduce(lambda x, w: F.replace(x, F.lit(w), F.lit("")), words, c)


def remove_isolated_capitals(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?<!{WORD})[A-Z](?!{WORD})", "")


def remove_trailing_word(c: Column) -> Column:
    return F.regexp_replace(c, WS + r"+[A-Za-z]+\z", "")


def strip_edges_plain(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"\A[.,;: ]+", ""), r"[.,;: ]+\z", "")


def strip_edges(c: Column) -> Column:
    edge = r"[.,;:\-\s\x0b\x1c-\x1f\x85\p{Z}]+"
    return F.regexp_replace(F.regexp_replace(c, r"\A" + edge, ""), edge + r"\z", "")


def drop_foreign_tokens(c: Column, foreign: str = LATIN) -> Column:
    """Tokens between single spaces that hold a foreign letter go, the spaces between the others stay.

    Equal to splitting on one space, filtering and joining: the kept tokens are joined by one space each.
    """
    return F.array_join(F.filter(F.split(c, " ", -1), lambda t: ~t.rlike(foreign)), " ")


def drop_foreign_words(c: Column, foreign: str = LATIN) -> Column:
    """Words between any white space; what remains is joined by single spaces."""
    return F.array_join(F.filter(F.split(strip(c), WS + "+", -1), lambda t: ~t.rlike(foreign)), " ")


def ocr_corrections(c: Column) -> Column:
    return functools.reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), OCR_CORRECTIONS, c)


@functools.cache
def fold_tables() -> tuple[dict[str, str], dict[str, str]]:
    """What case folding changes beyond lower case: (one character to one, one to several)."""
    one, many = {}, {}
    for n in range(0x110000):
        if 0xD800 <= n < 0xE000:
            continue
        low = chr(n).lower()
        for ch in low:
            to = ch.casefold()
            if to != ch:
                (one if len(to) == 1 else many)[ch] = to
    return one, many


def casefold(c: Column) -> Column:
    one, many = fold_tables()
    x = F.translate(F.lower(c), "".join(one), "".join(one.values()))
    full = functools.reduce(lambda y, p: F.replace(y, F.lit(p[0]), F.lit(p[1])), many.items(), x)
    return F.when(x.rlike("[" + "".join(many) + "]"), full).otherwise(x)


def improve_text(c: Column) -> Column:
    return strip(no_space_before_punctuation(collapse_commas(collapse_spaces(strip(c)))))


def improve_noise(c: Column) -> Column:
    x = remove_trailing_word(remove_isolated_capitals(remove_literals(c, ABBREVIATIONS)))
    return strip(strip_edges_plain(collapse_spaces(x)))


def clean_response_v1(c: Column, foreign: str = LATIN) -> Column:
    x = collapse_punctuation(drop_foreign_tokens(remove_literals(strip(c)), foreign))
    x = space_after_punctuation(no_space_before_punctuation(x))
    return strip(strip_edges(collapse_punctuation(collapse_spaces(x))))


def clean_instruction_v1(c: Column) -> Column:
    return strip(collapse_spaces(collapse_punctuation(strip(c))))


def clean_response_v2(c: Column, foreign: str = LATIN) -> Column:
    x = collapse_punctuation(ocr_corrections(drop_foreign_words(remove_literals(strip(c)), foreign)))
    return strip(no_space_before_punctuation(collapse_spaces(x)))


def clean_instruction_v2(c: Column) -> Column:
    return strip(no_space_before_punctuation(collapse_spaces(collapse_punctuation(strip(c)))))


def has_latin(c: Column) -> Column:
    return c.rlike(LATIN)


def has_digit(c: Column) -> Column:
    return c.rlike(r"\p{Nd}")


def has_special(c: Column) -> Column:
    return c.rlike(SPECIAL)


def has_double_comma(c: Column) -> Column:
    return c.contains(",,")


def has_double_space(c: Column) -> Column:
    return c.rlike(WS + "{2,}")


def has_repeated_mark(c: Column) -> Column:
    return c.rlike(r"([.,;:!?])\1+")


def has_abbreviation(c: Column) -> Column:
    return c.rlike(rf"(?iu)(?<!{WORD})(?:adj|adv|pron|prep|conj|interj|aux|cf)\.")


def is_missing(c: Column) -> Column:
    return c.isNull() | (strip(c) == "") | (F.lower(strip(c)) == "nan")


def na_to_null(c: Column) -> Column:
    """Texts that spreadsheet readers take for missing values become null."""
    return F.when(~c.isin(*NA_TEXTS), c)


def is_garbage(c: Column, least: int = 3) -> Column:
    x = F.replace(c, F.lit(" "), F.lit(""))
    return (F.length(x) < least) | x.isin(*GARBAGE_WORDS) | x.rlike(r"\A[\x{0CCD}-\x{0CE3}]+\z")


# The five question templates and how a headword is read back from them.
TEMPLATES = ("Translate '{}' to Tulu.", "What is the Tulu meaning of {}?", "How do you say {} in Tulu?", "Give the Tulu translation of {}.", "Tulu word for {}.")
EXTRACT = (
    "^Translate ['\"]([^\\n]+?)['\"] to Tulu\\.$", "^What is the Tulu meaning of ([^\\n]+?)\\?$", "^How do you say ([^\\n]+?) in Tulu\\?$", "^Give the Tulu translation of ([^\\n]+?)\\.$", "^Tulu word for ([^\\n]+?)\\.$",
)


def fill_template(template: str, word: Column) -> Column:
    before, after = template.split("{}")
    return F.concat(F.lit(before), word, F.lit(after))


def template_word(c: Column) -> Column:
    """The headword a template instruction names, or null. Outer white space does not count."""
    c = strip(c)
    found = F.coalesce(*(F.nullif(F.regexp_extract(c, "(?iu)" + p, 1), F.lit("")) for p in EXTRACT))
    return F.nullif(strip(found), F.lit(""))
