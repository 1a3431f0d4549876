"""One consistent form for text that looks the same: table gathers, expansion offsets and vectorised composition."""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palmleaf.llm.codepoints import TABLE, chunks, clip, codepoints, to_strings

# Letters of other scripts that are drawn like a Latin letter, script by script, each above what it is like
# (the public confusables data names these pairs). Letters drawn like one in another style or width, and ligatures, follow
# from their decompositions and are in no list.
LOOKALIKES = {
    "cyrillic": ("асԁеһіјӏорԛѕԝхуѵАВСЕНІЈКМОРԚЅТԜХУҮԌӀгѡ",
                 "acdehijlopqswxyvABCEHIJKMOPQSTWXYYGIrw"),
    "greek": ("αινορυϲϳγΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ",
              "aivopucjyABEZHIKMNOPTYXCJ"),
    "armenian": ("օհցոսզյքԼՍՏՕ",
                 "ohgnuqjpLUSO"),
    "coptic": ("ⲟⲣⲥⲭⲁⲓⲩⲂⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲌⲀ",
               "opcxaiyBHIKMNOPCTYXZA"),
    "cherokee": ("ᎠᎡᎢᎥᎩᎪᎫᎬᎳᎷᎻᎽᏀᏃᏏᏚᏞᏟᏢᏦᏙᏔᏒᏕᏜᏴᏳꮯꮪꮩꮓꮃꮁ",
                 "DRTiYAJEWMHYGZbSLCPKVWRSBBGcsvzwr"),
    "lisu": ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ",
             "BPDTGKJCZFMNLSRVHWXYAEIOU"),
    "latin": ("ɡɑⅼⅰⅴⅹⅽⅾⅿ",
              "galivxcdm"),
}
LATIN_LOOKALIKES = {a: b for line, to in LOOKALIKES.values() for a, b in zip(line, to, strict=True)}
# Telugu signs, letters and digits that are drawn like the Kannada one at the same place of its block.
TELUGU_LIKE_KANNADA = "ంఃఅఆఇఒఓఔజఞణయఱల౦౧౨౯"
# Hyphens drawn as the ASCII one; characters that are not drawn besides those of category Cf.
HYPHENS = "‐‑﹣－"
UNDRAWN = "͏ᅟᅠ឴឵᠋᠌᠍᠏ㅤﾠ" + "".join(map(chr, range(0xFE00, 0xFE10)))
JOINERS = (0x200C, 0x200D)
# Kannada: the digit zero is drawn like the anusvara; after a letter or vowel sign it can only stand for that.
ZERO, ANUSVARA, SYLLABLE = 0x0CE6, 0x0C82, ((0x0C85, 0x0CB9), (0x0CBE, 0x0CCC), (0x0CD5, 0x0CD6))


def _one(ch: str) -> str:
    if ord(ch) in JOINERS:
        return ch
    cat = unicodedata.category(ch)
    if cat == "Cf" and not unicodedata.name(ch, "").startswith(("ARABIC", "SYRIAC", "KAITHI")) or ch in UNDRAWN:
        return ""
    if cat == "Zs":
        return " "
    if ch in HYPHENS:
        return "-"
    if 0xAC00 <= ord(ch) < 0xD7A4:
        return ch
    kind = unicodedata.decomposition(ch)
    if kind.startswith(("<wide>", "<narrow>", "<font>")) or 0xFB00 <= ord(ch) <= 0xFB06:
        ch = unicodedata.normalize("NFKC", ch)
    out = unicodedata.normalize("NFD", ch)
    return "".join(LATIN_LOOKALIKES.get(c, chr(ord(c) + 0x80) if c in TELUGU_LIKE_KANNADA else c) for c in out)


@functools.cache
def expansion() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(how many code points each one becomes, where they begin, all of them)."""
    size = np.ones(TABLE + 2, np.int64)
    changed: dict[int, str] = {}
    for c in range(TABLE):
        if c < 0x80 or 0xD800 <= c < 0xE000:
            continue
        ch = chr(c)
        to = _one(ch)
        if to != ch:
            changed[c] = to
            size[c] = len(to)
    begin = np.zeros(TABLE + 2, np.int64)
    np.cumsum(size[:-1], out=begin[1:])
    flat = np.repeat(np.arange(TABLE + 2, dtype=np.uint32), size)
    for c, to in changed.items():
        flat[begin[c] : begin[c] + len(to)] = [ord(x) for x in to]
    return size, begin, flat


@functools.cache
def combining() -> tuple[np.ndarray, np.ndarray]:
    """(canonical combining class, whether the code point is the second of some composition)."""
    t = np.zeros(TABLE + 2, np.uint8)
    for c in range(0x300, TABLE):
        t[c] = unicodedata.combining(chr(c))
    keys, _ = compositions()
    second = np.zeros(TABLE + 2, bool)
    second[np.unique(keys & 0x1FFFFF)] = True
    return t, second


@functools.cache
def compositions() -> tuple[np.ndarray, np.ndarray]:
    """Sorted first << 21 | second of all canonical compositions, and what each gives."""
    found = []
    for c in range(TABLE):
        d = unicodedata.decomposition(chr(c)) if not 0xD800 <= c < 0xE000 else ""
        if d and d[0] != "<" and " " in d and unicodedata.normalize("NFC", chr(c)) == chr(c):
            a, b = (int(x, 16) for x in d.split())
            found.append((a << 21 | b, c))
    found.sort()
    return np.array([k for k, _ in found], np.int64), np.array([v for _, v in found], np.uint32)


def _drop(cps, row, keep):
    return cps[keep], row[keep]


def _order(cps, row, ccc_of) -> None:
    """Canonical order of marks, in place."""
    while True:
        ccc = ccc_of[clip(cps)]
        swap = np.flatnonzero((ccc[:-1] > ccc[1:]) & (ccc[1:] > 0) & (row[:-1] == row[1:]))
        if not len(swap):
            return
        swap = swap[np.append(True, np.diff(swap) > 1)] if len(swap) > 1 else swap
        cps[swap], cps[swap + 1] = cps[swap + 1].copy(), cps[swap].copy()


def canonical(col: pa.Array) -> pa.Array:
    """The form under which texts that look the same are equal. Nulls stay null."""
    cps, offsets = codepoints(col)
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    size, begin, flat = expansion()
    far = cps >= TABLE  # the later planes are kept, but for their undrawn ones
    at = clip(cps)
    k = size[at]
    undrawn = far & ((cps >= 0xE0000) & (cps < 0xE0200))
    k[undrawn] = 0
    shift = np.repeat(begin[at] - np.cumsum(k) + k, k) + np.arange(k.sum())
    out = flat[shift]
    src_far = np.repeat(far, k)
    out[src_far] = np.repeat(cps, k)[src_far]
    cps, row = out, np.repeat(row, k)
    zero = np.flatnonzero(cps == ZERO)
    zero = zero[zero > 0]
    if len(zero):
        prev = cps[zero - 1]
        inside = np.zeros(len(zero), bool)
        for lo, hi in SYLLABLE:
            inside |= (prev >= lo) & (prev <= hi)
        cps[zero[inside & (row[zero] == row[zero - 1])]] = ANUSVARA
    ccc_of, second_of = combining()
    _order(cps, row, ccc_of)
    # A joiner is drawn only between a virama (and marks) and a letter after it, or (ZWJ) before a virama.
    joiner = (cps == JOINERS[0]) | (cps == JOINERS[1])
    if joiner.any():
        ccc, place = ccc_of[clip(cps)], np.arange(len(cps))
        same_next = np.append(row[1:] == row[:-1], False)
        same_prev = np.append(False, row[1:] == row[:-1])
        starter = np.maximum.accumulate(np.where(ccc == 0, place, -1))
        virama = np.maximum.accumulate(np.where(ccc == 9, place, -1))
        prev_virama = same_prev & np.append(False, (virama > starter)[:-1])
        next_virama = same_next & np.append(ccc[1:] == 9, False)
        nxt = np.append(cps[1:], 0)
        letter = np.isin(np.searchsorted([0x41, 0x5B, 0x61, 0x7B, 0xAA], nxt, side="right"), [1, 3, 5]) & same_next
        keep = ~joiner | (prev_virama & letter) | ((cps == JOINERS[1]) & next_virama & same_prev)
        cps, row = _drop(cps, row, keep)
        _order(cps, row, ccc_of)
    keys, values = compositions()
    while len(cps):
        at = clip(cps)
        mark = np.flatnonzero(second_of[at])
        if not len(mark):
            break
        ccc = ccc_of[at]
        starter = np.maximum.accumulate(np.where(ccc == 0, np.arange(len(cps)), -1))
        before = np.where(mark > 0, starter[np.maximum(mark - 1, 0)], -1)
        mark, before = mark[before >= 0], before[before >= 0]
        free = (row[before] == row[mark]) & ((mark - 1 == before) | (ccc[mark - 1] < ccc[mark]) & (ccc[mark - 1] > 0))
        mark, before = mark[free], before[free]
        want = cps[before].astype(np.int64) << 21 | cps[mark]
        pos = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        hit = keys[pos] == want
        mark, before, pos = mark[hit], before[hit], pos[hit]
        if not len(mark):
            break
        one = np.append(True, before[1:] != before[:-1])  # one composition per starter and pass
        one[1:] &= before[1:] != mark[:-1]
        mark, before, pos = mark[one], before[one], pos[one]
        cps[before] = values[pos]
        keep = np.ones(len(cps), bool)
        keep[mark] = False
        cps, row = _drop(cps, row, keep)
    ends = np.searchsorted(row, np.arange(n + 1))
    text = to_strings(cps, ends)
    if col.null_count:
        import pyarrow.compute as pc

        text = pc.if_else(pc.is_valid(col), text, pa.scalar(None, pa.string()))
    return text


def add_canonical(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """df with one more column for each of cols (source -> new name): its text in the consistent form.

    Null stays null, empty stays empty; other columns are untouched, whatever their names. A new name that df already
    has (in any case) is an error, told before anything runs.
    """
    taken = {c.lower() for c in df.columns}
    for new in cols.values():
        if new.lower() in taken:
            raise ValueError(f"column {new} exists already")
    schema = T.StructType([*df.schema.fields, *(T.StructField(c, T.StringType()) for c in cols.values())])
    sources = list(cols)
    names = [*df.columns, *cols.values()]
    where = [df.columns.index(c) for c in sources]

    def run(batches):
        for batch in batches:
            parts = [batch]
            for source in sources:  # bounded in every text
                parts = (p for whole in parts for p in chunks(whole, source, 1 << 21))
            for part in parts:
                extra = [canonical(part.column(i).cast(pa.string())) for i in where]
                yield pa.RecordBatch.from_arrays([*part.columns, *extra], names=names)

    return df.mapInArrow(run, schema)


def _looks(df: DataFrame, key: str, cols: list[str]) -> tuple[DataFrame, DataFrame, list[str], list[str]]:
    """(rows with their stored forms, stored forms of the looks that have several of them, names of forms and looks)."""
    look = [f"look_{i}" for i in range(len(cols))]
    form = [f"form_{i}" for i in range(len(cols))]
    base = df.select(F.col(key).cast("long").alias("k"), *(F.col(c).cast("string").alias(f) for c, f in zip(cols, form)))
    base = base.filter(F.col("k").isNotNull()).na.drop(subset=form)
    forms = add_canonical(base.groupBy(*form).agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("first")), dict(zip(form, look)))
    several = forms.groupBy(*look).agg(F.count(F.lit(1)).alias("forms"), F.sum("n").alias("rows"), F.min("first").alias("class_id")).filter("forms > 1")
    return base, forms.join(several, look), form, look


def look_classes(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """(key, class_id, form_id, forms, rows): every row that looks like a row stored differently, once.

    class_id is the smallest key of all rows of its look, form_id that of the rows stored as it is; forms and rows count
    those of the class. One row a row, however large a class is; rows of the same stored form are never paired.
    """
    base, forms, form, look = _looks(df, key, cols)
    rows = base.join(forms.select(*form, "class_id", F.col("first").alias("form_id"), "forms", "rows"), form)
    return rows.select(F.col("k").alias(key), "class_id", "form_id", "forms", "rows")


def same_look_pairs(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """(key_a, key_b), key_a < key_b: rows whose cols all look the same while at least one is stored differently.

    Rows with a null in key or cols are in no pair. Rows stored the same are never compared with one another: pairs
    are sought between the distinct stored forms of a look, and only then turned into rows, so a third of all rows in
    one stored form costs nothing beyond its true pairs. look_classes() tells the same in one row for each row.
    """
    base, forms, form, look = _looks(df, key, cols)
    a = forms.select("class_id", F.col("first").alias("form_a"))
    b = forms.select("class_id", F.col("first").alias("form_b"))
    pairs = a.join(b, "class_id").filter(F.col("form_a") < F.col("form_b")).select("form_a", "form_b")
    rows = base.join(forms.select(*form, "first"), form).select("k", "first")
    left, right = (rows.select(F.col("first").alias(f"form_{x}"), F.col("k").alias(f"k{x}")) for x in "ab")
    ids = pairs.join(left, "form_a").join(right, "form_b")
    return ids.select(F.least("ka", "kb").alias(f"{key}_a"), F.greatest("ka", "kb").alias(f"{key}_b"))
