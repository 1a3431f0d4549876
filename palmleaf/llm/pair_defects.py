"""Defective prompt and response pairs: a multi-label linear classifier over hashed n-grams and pair features.

The labelled rows are synthetic: responses of a bounded sample are emptied, refused, copied, put in another language,
truncated and swapped with those of other rows; thresholds are calibrated on rows and phrases that the fit has not
seen.
"""

from __future__ import annotations

import dataclasses
import io
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palmleaf.llm.codepoints import INVERSE, PRIME, U64, Words, chunks, clip, gram_hash, powers, splitmix, word_table

BY_PAIR = ("copy",)  # judged by pair features alone: no word makes a text a copy
GRAM_STEP = 10.0  # grams are means over a text; this is their step against the pair features
LABELS = ("empty", "refusal", "copy", "wrong_language", "truncated", "swapped")
REPORTED = LABELS[:5]  # the defects of a response alone, in the order in which one is told
BITS = 20
SLACK = 0.003
# Fillers that stand in place of an answer.
FILLERS = ("", " ", "\n", " ", "​", "-", "--", "_", "...", "…", "?", '""', "''", "()", "*", ".", "N/A", "n/a", "NA", "nan", "NaN", "null", "NULL", "none", "None", "nil", "TBD", "todo", "unknown", "no answer", "[empty]", "not available")
# Phrases that decline to answer, put together as opening + body + ending.
REFUSALS = {
    "en": (
        ("", "Sorry, ", "I'm sorry, but ", "I am sorry, but ", "Unfortunately, ", "Apologies, ", "I apologize, but ", "I regret that ", "I'm afraid "),
        ("I cannot translate this", "I can't help with that request", "I cannot answer that", "I am unable to answer this question", "I'm not able to help with this", "I won't be able to provide that", "I don't have a Tulu word for it", "I do not know the answer", "as a language model I do not know Tulu", "as an AI I cannot help with this", "this is not something I can assist with", "it is not possible for me to give a translation", "answering this is beyond what I can do", "I have no answer to this", "I must decline this request"),
        ("", " at the moment", ". Try another question", ". Please ask a native speaker", ". Please ask someone else"),
    ),
    "tcy": (
        ("", "ಕ್ಷಮಿಸಲೆ, ", "ಮಾಪು ಮಲ್ಪುಲೆ, ", "ಬೇಜಾರ್ ಮಲ್ಪೊಡ್ಚಿ, "),
        ("ಎನ್ಡ ಉಂದು ಆಪುಜ್ಜಿ", "ಎಂಕ್ ಉತ್ತರ ಕೊರಿಯೆರೆ ಆಪುಜ್ಜಿ", "ಯಾನ್ ಉಂದೆನ್ ಅನುವಾದ ಮಲ್ಪರೆ ಆಪುಜ್ಜಿ", "ಈ ಪ್ರಶ್ನೆಗ್ ಉತ್ತರ ಎನ್ಡ ಇಜ್ಜಿ", "ಉಂದೆನ್ ಪಣ್ಯೆರೆ ಎನ್ಡ ಸಾದ್ಯ ಇಜ್ಜಿ", "ಎಂಕ್ ಗೊತ್ತುಜ್ಜಿ", "ಎಂಕ್ ಉಂದು ತೆರಿಯಂದ್", "ಎನ್ಡ ಸಾಧ್ಯ ಇಜ್ಜಿ"),
        ("", ", ಬೇತೆ ಏರೆಡಾಂಡಲ ಕೇನ್ಲೆ", ", ಬೇತೆ ಪ್ರಶ್ನೆ ಕೇನ್ಲೆ"),
    ),
    "kn": (
        ("", "ಕ್ಷಮಿಸಿ, ", "ದಯವಿಟ್ಟು ಕ್ಷಮಿಸಿ, "),
        ("ನನಗೆ ಇದನ್ನು ಅನುವಾದಿಸಲು ಸಾಧ್ಯವಿಲ್ಲ", "ನಾನು ಈ ಪ್ರಶ್ನೆಗೆ ಉತ್ತರಿಸಲು ಸಾಧ್ಯವಿಲ್ಲ", "ನನಗೆ ಗೊತ್ತಿಲ್ಲ", "ಈ ಪ್ರಶ್ನೆಗೆ ನನ್ನ ಬಳಿ ಉತ್ತರ ಇಲ್ಲ"),
        ("", ", ಬೇರೆ ಪ್ರಶ್ನೆ ಕೇಳಿ"),
    ),
    "hi": (("", "क्षमा करें, ", "माफ़ कीजिए, "), ("मैं इसका अनुवाद नहीं कर सकता", "मैं इस प्रश्न का उत्तर नहीं दे सकता", "मुझे नहीं पता", "मैं इसमें मदद नहीं कर सकता"), ("", ", कृपया किसी और से पूछें")),
}
# Labels put before a copied text, endings of sentences, brackets and quotes that come in pairs.
LABEL_WORDS = ("Answer: ", "A: ", "Q: ", "Question: ", "Response: ", "Translation: ", "> ", "* ", "- ", "ಉತ್ತರ: ", "ಪ್ರಶ್ನೆ: ", "")
ENDINGS = ".!?।॥。！？"
PAIRS = {"(": ")", "[": "]", "{": "}", "“": "”", "«": "»", "「": "」"}
OPENERS, CLOSERS = "".join(PAIRS), "".join(PAIRS.values())
# Fixed value: where a question names its headword.
ASKED = "[\"'“‘](.+)[\"'”’]|(?i:meaning of|translation of|word for|stands for) (.+?)[?.!\\s]*$|(?i:you say) (.+) (?i:in tulu)"
KANNADA = (0x0C80, 0x0CFF)  # the script of answers, unless another is given
# What English refusals are put together from.
WHO = ("I", "We", "As an AI, I", "As a language model, I", "This assistant", "The system", "I, being a machine,", "At this time I")
CANNOT = ("cannot", "can't", "can not", "am unable to", "am not able to", "won't", "will not", "am not allowed to", "must decline to", "have to refuse to", "do not have the ability to", "am not permitted to", "could not", "am not in a position to", "refuse to", "decline to", "would rather not")
DO = ("translate", "answer", "help with", "assist with", "provide", "give", "respond to", "comply with", "complete", "fulfil", "share", "handle", "process", "offer", "supply", "produce")
WHAT = ("this", "that", "it", "this request", "your request", "this question", "that query", "a translation", "the Tulu word", "this word", "an answer", "what you asked", "such requests", "the term")
LACKS = ("is beyond my abilities", "is outside my abilities", "falls outside what I can do", "is not something I can do", "is not possible for me", "lies beyond my knowledge", "goes against my guidelines", "is against policy", "is more than I am able to do", "exceeds my capabilities", "is not within my knowledge", "is unknown to me")
LACK = ("I have no answer for", "I have no translation for", "I do not know", "I don't know", "I lack the knowledge for", "I am not familiar with", "There is no way for me to give", "No translation is available for", "No answer can be given for", "I have no information about", "I'm not sure about", "I am not capable of giving")

DENSE = (
    "bias", "no_words", "short_plain", "hardly_kannada", "foreign_words", "mostly_foreign", "foreign_letters", "one_foreign", "all_copied", "copied_span", "copied_span_label", "copied_then_more",
    "left_open", "no_end", "sentences", "no_end_sentences", "prompt_kannada", "asks_sentence", "no_end_where_sentence", "long", "ends_with_comma", "list_like", "sentence_for_word", "word_for_sentence",
)


@dataclasses.dataclass
class Model:
    buckets: np.ndarray  # the hash buckets that were seen, sorted
    grams: np.ndarray  # labels x buckets
    dense: np.ndarray  # labels x len(DENSE)
    thresholds: np.ndarray
    report: dict
    script: tuple[int, int] = KANNADA

    def wide(self) -> np.ndarray:
        """labels x 2 ** BITS: built once in each worker."""
        out = self.__dict__.get("_wide")
        if out is None:
            out = np.zeros((len(LABELS), 1 << BITS), np.float32)
            out[:, self.buckets] = self.grams
            self.__dict__["_wide"] = out
        return out

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_wide"}


def save(spark, model: Model, path: str) -> None:
    """The model as a table of one row, with its arrays as one binary value."""
    out = io.BytesIO()
    np.savez_compressed(out, buckets=model.buckets, grams=model.grams, dense=model.dense, thresholds=model.thresholds, script=np.array(model.script), f1=np.array([model.report.get(x, np.nan) for x in LABELS]))
    spark.createDataFrame([(",".join(LABELS), out.getvalue())], "labels STRING, arrays BINARY").write.mode("overwrite").parquet(path)


def load(spark, path: str) -> Model:
    row = spark.read.parquet(path).first()
    if row["labels"] != ",".join(LABELS):
        raise ValueError(f"a model of other labels: {row['labels']}")
    x = np.load(io.BytesIO(bytes(row["arrays"])))
    report = {label: float(f) for label, f in zip(LABELS, x["f1"]) if f == f}
    return Model(x["buckets"], x["grams"], x["dense"], x["thresholds"], report, tuple(int(k) for k in x["script"]))


def _sum(mask: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row[mask], minlength=n)[:n]


def _any_of(cps: np.ndarray, chars: str) -> np.ndarray:
    return np.isin(cps, np.array([ord(c) for c in chars], np.uint32))


class _Rolling:
    """Hashes of any stretches of a column's words, from sums over all of them."""

    def __init__(self, w: Words):
        n = len(w.hash)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(w.hash * powers(PRIME, n), dtype=U64, out=self.sums[1:])
        self.back = powers(INVERSE, n + 1)

    def __call__(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.back[start]


def _divisors(n: int) -> list[int]:
    low = [d for d in range(1, math.isqrt(n) + 1) if n % d == 0]
    return low + [n // d for d in reversed(low) if d * d < n]


def _spans(r: Words, i: Words, shared: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For these rows: whether the response is one span of the instruction, perhaps repeated; the same after up to two
    words that the instruction has not; and whether it is the instruction's text with more after it. Linear in the words
    (times the number of ways to divide the response into equal parts)."""
    hr, hi = _Rolling(r), _Rolling(i)
    nr, ni = r.count[rows].astype(np.int64), i.count[rows].astype(np.int64)

    def inside(skip):
        start, size = r.first[rows] + skip, nr - skip
        part = size.copy()  # the shortest part that the text repeats
        for n in np.unique(size[size > 0]):
            at = np.flatnonzero(size == n)
            for d in _divisors(int(n))[:-1]:
                at = at[part[at] == n]
                rest = np.full(len(at), n - d)
                same = hr(start[at], rest) == hr(start[at] + d, rest)
                part[at[same]] = d
        out = np.zeros(len(rows), bool)
        some = np.flatnonzero((size > 0) & (part <= ni))
        many = ni[some] - part[some] + 1
        who = np.repeat(some, many)
        at = i.first[rows][who] + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        hit = hi(at, part[who]) == hr(start[who], part[who])
        out[who[hit]] = True
        return out

    own = np.append(shared, [True, True])
    end = r.first[rows] + nr
    lead = np.where((nr > 0) & ~own[r.first[rows]], 1, 0)
    lead += (lead == 1) & (r.first[rows] + 1 < end) & ~own[np.minimum(r.first[rows] + 1, len(shared))]
    more = (nr > ni + 2) & (ni > 0)
    at = np.flatnonzero(more)
    more[at] = hr(r.first[rows][at], ni[at]) == hi(i.first[rows][at], ni[at])
    return inside(np.zeros(len(rows), np.int64)), inside(lead) & (lead > 0), more


def features(instruction: pa.Array, response: pa.Array, script: tuple[int, int] = KANNADA) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(dense features, gram bucket, gram row, gram weight) of each pair; a null text counts as an empty one."""
    r, i = Words(response), Words(instruction)
    n = len(r.offsets) - 1
    nr, ni = r.count.astype(np.int64), i.count.astype(np.int64)
    c, off = r.cps, r.offsets
    row = np.repeat(np.arange(n), np.diff(off))
    word_char = word_table()[clip(c)] if len(c) else np.zeros(0, bool)
    kn = (c >= script[0]) & (c <= script[1]) & word_char
    digit = (c >= 48) & (c <= 57)
    letters = _sum(word_char & ~digit, row, n)
    foreign = _sum(word_char & ~kn & ~digit, row, n)
    first = r.cps[r.starts] if len(r.starts) else np.zeros(0, np.uint32)
    kw = _sum((first >= script[0]) & (first <= script[1]), r.row, n)
    dw = _sum((first >= 48) & (first <= 57), r.row, n)
    fw = nr - kw - dw
    ic = i.cps[i.starts] if len(i.starts) else np.zeros(0, np.uint32)
    ikw = _sum((ic >= script[0]) & (ic <= script[1]), i.row, n)
    # Words of the response that the instruction has too.
    pair = splitmix(r.row.astype(U64)) ^ r.hash
    shared = np.isin(pair, splitmix(i.row.astype(U64)) ^ i.hash)
    ns = _sum(shared, r.row, n)
    span, span_label, more = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool)
    near = np.flatnonzero((nr > 0) & (nr - ns <= np.maximum(2, nr // 2)) & (ns > 0))
    if len(near):
        span[near], span_label[near], more[near] = _spans(r, i, shared, near)
    # Brackets and quotes left open; straight quotes count by parity.
    opened = np.zeros(n, bool)
    for o, s in PAIRS.items():
        opened |= _sum(c == ord(o), row, n) > _sum(c == ord(s), row, n)
    opened |= _sum(c == 34, row, n) % 2 == 1
    # The last character that is drawn, closing marks aside.
    drawn = ~_any_of(c, CLOSERS + "\"'’ \t\n\r ​‌‍﻿") & (c > 32)
    last = np.full(n, -1, np.int64)
    at = np.flatnonzero(drawn)
    last[row[at]] = at
    tail = np.where(last >= 0, c[np.maximum(last, 0)] if len(c) else 0, 0)
    ended = _any_of(tail, ENDINGS) & (last >= 0)
    end = np.flatnonzero(_any_of(c, ENDINGS))
    if len(end):
        ok = (end > off[row[end]]) & (end + 1 < off[row[end] + 1])
        end = end[ok]
        space = (c[end + 1] <= 32) | (c[end + 1] == 0xA0)
        end = end[kn[end - 1] & space] if len(end) else end
    inner = np.bincount(row[end], minlength=n)[:n] if len(end) else np.zeros(n, np.int64)
    marks = _sum(_any_of(c, ",;/|\n\t、，•·"), row, n)
    per = nr / (marks + 1)
    sentences = (inner > 0) | (per >= 5)
    conv = (ikw * 2 > ni) & (ni > 0)
    asks = _sum(i.hash == Words(pa.array(["sentence"])).hash[0], i.row, n) > 0
    has = nr > 0
    cols = {
        "bias": np.ones(n), "no_words": ~has, "short_plain": has & (nr <= 2) & (kw == 0), "hardly_kannada": has & (fw > 0) & (kw * 4 <= fw), "foreign_words": has & (fw > kw) & (fw >= 2),
        "mostly_foreign": has & (foreign * 2 > letters) & ((kw == 0) | (fw >= 2)), "foreign_letters": foreign / np.maximum(letters, 1), "one_foreign": has & (fw == 1) & (kw > 0),
        "all_copied": has & (ns == nr), "copied_span": 2 * span, "copied_span_label": 2 * (span_label & ~span), "copied_then_more": more,
        "left_open": opened & has, "no_end": has & ~ended, "sentences": has & sentences, "no_end_sentences": has & ~ended & sentences, "prompt_kannada": conv, "asks_sentence": asks, "no_end_where_sentence": has & ~ended & (conv | asks) & (kw > 0),
        "long": nr >= 4, "ends_with_comma": has & _any_of(tail, ",:;-–—…"), "list_like": marks > 0,
        "sentence_for_word": (ni > 0) & ~conv & ~asks & (inner > 0) & (nr >= 6), "word_for_sentence": (conv | asks) & (nr > 0) & (nr <= 3),
    }
    dense = np.stack([np.asarray(cols[x], np.float32) for x in DENSE], axis=1)
    two = gram_hash(r.hash, 2)
    same = r.row[1:] == r.row[:-1] if len(r.row) > 1 else np.zeros(0, bool)
    grams = np.concatenate([r.hash, two[same]])
    # Two buckets each, so that one collision alone decides nothing.
    bucket = np.concatenate([grams >> U64(64 - BITS), grams & U64((1 << BITS) - 1)]).astype(np.int64)
    grow = np.concatenate([r.row, r.row[:-1][same]] * 2) if len(r.row) else np.zeros(0, np.int64)
    weight = (1 / np.maximum(1, np.bincount(grow, minlength=n)))[grow] if len(grow) else np.zeros(0)
    return dense, bucket, grow, weight.astype(np.float32)


def scores(m: Model, instruction: pa.Array, response: pa.Array) -> np.ndarray:
    """Probability of each label for each pair."""
    dense, bucket, grow, weight = features(instruction, response, m.script)
    z, wide = dense @ m.dense.T, m.wide()
    for k in range(len(LABELS)):
        z[:, k] += np.bincount(grow, wide[k, bucket] * weight, minlength=len(z))[: len(z)]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _pick(rng, items, held: bool | None):
    """One of the items; of every fifth of them only if held, of the others only if not."""
    if held is not None and len(items) >= 5:
        items = [x for k, x in enumerate(items) if (k % 5 == 2) == held]
    return items[rng.integers(len(items))]


def _refusal(rng, held: bool | None) -> tuple[str, str]:
    """A refusal and an apology that may stand before an answer as well."""
    lang = rng.choice(["en", "en", "en", "en", "tcy", "tcy", "kn", "hi"])
    a, b, c = REFUSALS[lang]
    body = _pick(rng, b, held)
    if lang == "en" and rng.random() < 0.6:
        kind = rng.integers(3)
        what = _pick(rng, WHAT, held)
        body = f"{_pick(rng, WHO, held)} {_pick(rng, CANNOT, held)} {_pick(rng, DO, held)} {what}" if kind == 0 else f"{what} {_pick(rng, LACKS, held)}" if kind == 1 else f"{_pick(rng, LACK, held)} {what}"
    s = a[rng.integers(len(a))] + body + c[rng.integers(len(c))]
    return (s[0].upper() + s[1:]) + rng.choice([".", "!", "", ".", "।" if lang != "en" else "."]), a[rng.integers(1, len(a))]


def _other_script(text: str, rng, script: tuple[int, int]) -> str:
    """The same letters in another Indic script."""
    shift = int(rng.choice([x for x in (0x0900, 0x0980, 0x0A80, 0x0B80, 0x0C00, 0x0C80, 0x0D00) if x != script[0]])) - script[0]
    return "".join(chr(ord(x) + shift) if script[0] <= ord(x) <= script[1] else x for x in text)


def synthesize(rows: list[tuple[str, str]], seed: int = 7, script: tuple[int, int] = KANNADA, apart: bool = True) -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
    """Instructions, responses, 0/1 labels, and which are held out: every row as it is and in each defective form, beside
    harmless look-alikes. A fifth of the rows is held out with all its forms; apart, they have phrases of their own too
    (fillers are a closed list)."""
    rng = np.random.default_rng(seed)
    ins, res, lab, out = [], [], [], []
    kept_out = False

    letter = re.compile(f"[{chr(script[0])}-{chr(script[1])}]")

    def own(text):
        return len(letter.findall(text))

    def add(i, r, *labels):
        mine = own(r)
        if sum(map(str.isalpha, r)) - mine > max(mine, 3) and labels and labels != ("swapped",):  # a refusal or copy in English is in another language too
            labels = (*labels, "wrong_language")
        ins.append(i)
        res.append(r)
        lab.append([x in labels for x in LABELS])
        out.append(kept_out)

    english = [i for i, _ in rows if not own(i)]
    kinds = [own(i) * 2 > len(i) for i, _ in rows]
    of_kind = {k: [r for (_, r), c in zip(rows, kinds) if c == k] for k in (False, True)}

    for (i, r), conv in zip(rows, kinds):
        kept_out = bool(rng.random() < 0.2)
        held = kept_out if apart else None
        add(i, r)
        add(i, FILLERS[rng.integers(len(FILLERS))], "empty")
        ref, apology = _refusal(rng, held)
        add(i, ref, "refusal")
        others = of_kind[True] if of_kind[True] and rng.random() < 0.5 else of_kind[conv]  # a list of words would look cut short where sentences are due
        add(i, others[rng.integers(len(others))], "swapped")
        lead = LABEL_WORDS[rng.integers(len(LABEL_WORDS))]
        head = re.search(ASKED, i)
        what = next(filter(None, head.groups())) if head and rng.random() < 0.6 else i
        copied = lead + rng.choice([what, what, what.rstrip("?.!") + rng.choice(["", ".", "!"]), f"'{what}'", f"{what}, {what}", f"{what} {what}", what.lower()])
        add(i, copied, "copy")
        if english:
            other = english[rng.integers(len(english))]
            words = other.split()
            k = int(rng.integers(2, 8)) if not conv else int(rng.integers(6, 30))
            picked = [words[rng.integers(len(words))].strip("'\"?.,()“”") for _ in range(k)]
            if rng.random() < 0.3 and not conv:
                picked = ["a", "word", "for", *picked[:2]]
            if rng.random() < 0.2:
                picked = [r.split()[0].strip(ENDINGS + ",") + ":", *picked, *picked[:3]]
            add(i, " ".join(picked) + (rng.choice([".", "?", "!"]) if conv else ""), "wrong_language")
        add(i, _other_script(r, rng, script), "wrong_language")
        # Truncation: sentences cut before the end, lists cut inside a bracket or quote.
        words = r.split()
        sentence = conv or len(words) >= 6 and r.rstrip()[-1:] in ENDINGS
        if sentence and len(words) > 3:
            cut = " ".join(words[: int(rng.integers(2, len(words)))])
            if rng.random() < 0.3:
                cut = cut[: -int(rng.integers(1, 3))]
            cut = cut.rstrip(ENDINGS + CLOSERS + ' "') + rng.choice(["", "", "", ",", ":", " -", "…", " (", " “"])
            add(i, cut, "truncated")
        else:
            add(i, f"{r.rstrip('.!?')}{rng.choice([' (', ', “', ' [', ', "'])}{r[: int(rng.integers(0, len(r)))]}", "truncated")
        # Harmless: stray abbreviation or foreign word, apology and answer, question and answer, wrapped answer.
        kind = rng.integers(6)
        if kind == 0:
            add(i, f"{r} {rng.choice(['adj.', 'n.', 'v.', 'adv.'])}") if not sentence else add(i, " ".join([*words[:1], "river", *words[1:]]))
        elif kind == 1:
            add(i, apology + r)
        elif kind == 2:
            add(i, f"{i} {r}")
        elif kind == 3:
            a, b = rng.choice(["()", "“”", '""', "[]"])
            add(i, a + r + b)
        elif kind == 4 and not sentence:
            add(i, rng.choice([f"* {r}", f"{r}.", f"{r},", f"{r}!", f" {r} ", f"{r} ({r})"]))
    return ins, res, np.array(lab, np.float32), np.array(out, bool)


def _descend(dense, bucket, grow, weight, y, order, used: int, epochs: int, rate: float):
    """AdaGrad on the logistic loss of each label: (gram weights, dense weights)."""
    begin = np.searchsorted(grow, np.arange(len(y) + 1))
    wg, wd = np.zeros((len(LABELS), used), np.float32), np.zeros((len(LABELS), len(DENSE)), np.float32)
    gg, gd = np.full_like(wg, 1e-4), np.full_like(wd, 1e-2)
    scale = np.float32(GRAM_STEP)
    batch = min(2048, max(64, len(order) // 40))  # a small sample still gets its number of steps
    for _ in range(epochs):
        for lo in range(0, len(order), batch):
            at = order[lo : lo + batch]
            cnt = begin[at + 1] - begin[at]
            ix = np.repeat(begin[at] - np.cumsum(cnt) + cnt, cnt) + np.arange(cnt.sum())
            who, w = np.repeat(np.arange(len(at)), cnt), weight[ix]
            some, b = np.unique(bucket[ix], return_inverse=True)
            for k in range(len(LABELS)):
                z = dense[at] @ wd[k] + np.bincount(who, wg[k, some][b] * w, minlength=len(at))
                e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[at, k]).astype(np.float32)
                d = dense[at].T @ e / len(at)
                gd[k] += d * d
                wd[k] -= rate * d / np.sqrt(gd[k])
                if LABELS[k] in BY_PAIR:
                    continue
                g = np.bincount(b, e[who] * w, minlength=len(some)).astype(np.float32) / len(at)
                gg[k, some] += (g * scale) ** 2
                wg[k, some] -= rate * scale * g / np.sqrt(gg[k, some])
    return wg, wd


def _fitted(ins, res, y, chosen, script, seed, epochs, rate) -> Model:
    dense, bucket, grow, weight = features(pa.array(ins, pa.string()), pa.array(res, pa.string()), script)
    by = np.argsort(grow, kind="stable")
    used, bucket = np.unique(bucket[by], return_inverse=True)  # only the buckets that occur are trained
    order = np.random.default_rng(seed).permutation(chosen)
    wg, wd = _descend(dense, bucket, grow[by], weight[by], y, order, len(used), epochs, rate)
    return Model(used, wg, wd, np.full(len(LABELS), 0.5), {}, script)


def fit(rows: list[tuple[str, str]], seed: int = 7, epochs: int = 10, rate: float = 1.0, script: tuple[int, int] = KANNADA) -> Model:
    """A model of all rows and phrases, with the thresholds of one that has not seen the held-out ones: those with the
    best F1 on them (of those within SLACK of it the one nearest to a half); `report` gives the F1."""
    ins, res, y, held = synthesize(rows, seed, script)
    trial = _fitted(ins, res, y, np.flatnonzero(~held), script, seed, epochs, rate)
    test = np.flatnonzero(held)
    want, p = y[test] > 0, scores(trial, pa.array([ins[t] for t in test], pa.string()), pa.array([res[t] for t in test], pa.string()))
    ins, res, y, _ = synthesize(rows, seed + 1, script, apart=False)
    m = _fitted(ins, res, y, np.arange(len(y)), script, seed, epochs, rate)
    for k, name in enumerate(LABELS):
        cuts = np.linspace(0.05, 0.95, 19)
        hits = p[:, k, None] >= cuts
        f1 = 2 * (hits & want[:, k, None]).sum(axis=0) / np.maximum(1, hits.sum(axis=0) + want[:, k].sum())
        good = cuts[f1 >= f1.max() - SLACK]
        m.thresholds[k], m.report[name] = good[np.abs(good - 0.5).argmin()], round(float(f1.max()), 4)
    return m


def train(df: DataFrame, instruction: str = "instruction", response: str = "response", sample_rows: int = 4500, sample_chars: int = 1 << 26, seed: int = 7, script: tuple[int, int] = KANNADA) -> Model:
    """A model fitted on at most sample_rows distinct rows of at most sample_chars characters in all, taken by the order
    of their hash: the only bounds on what it sees. Texts are taken whole; one that would pass sample_chars is left out.

    Rows whose response is plainly no sound answer (no word of the script, or an open end) are left out of the sample
    before defects are put in; the classifier, not this filter, judges the corpus.
    """
    i, r = F.col(instruction).cast("string"), F.col(response).cast("string")
    letters = rf"[\x{{{script[0]:04X}}}-\x{{{script[1]:04X}}}]"
    sound = r.rlike(letters) & (F.length(i) > 0)
    conv = i.rlike(letters)
    ends = r.rlike(r"[.!?।॥][)\]”\"'’\s]*\z")
    closed = ~r.rlike(r"[(\[“][^)\]”]*\z")
    pool = df.select(i.alias("i"), r.alias("r"), F.xxhash64(i, r, F.lit(seed)).alias("h"), conv.alias("c")).filter(sound & closed & (~conv | ends))
    wants = {False: sample_rows * 2 // 3, True: sample_rows // 3}
    totals = {x["c"]: x["n"] for x in pool.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    # The hashes are uniform: a cut that leaves about twice the wanted rows bounds what is sent; copies count once.
    below = F.lit(False)
    for kind, want in wants.items():
        cut = min((1 << 63) - 1, -(1 << 63) + ((2 * want + 1000) << 64) // max(1, totals.get(kind, 0)))
        below = below | ((F.col("c") == kind) & (F.col("h") <= cut))
    most = 4 * sample_rows + 4000
    sizes = pool.filter(below).select("c", "h", (F.length("i") + F.length("r")).alias("n")).distinct().limit(most + 1).collect()
    if len(sizes) > most:
        raise RuntimeError("the sample's hashes are not uniform")
    room, picked = sample_chars, []
    for kind, want in wants.items():
        few = [x for x in sorted((x for x in sizes if x["c"] == kind), key=lambda x: x["h"])]
        for x in few[:want]:
            if x["n"] <= room:
                room -= x["n"]
                picked.append(x["h"])
    chosen = df.sparkSession.createDataFrame([(h,) for h in picked], "h BIGINT")
    rows = pool.filter(below).join(F.broadcast(chosen), "h", "left_semi").select("i", "r").distinct().collect() if picked else []
    rows = sorted({(x[0], x[1]) for x in rows if not any(b in x[1] for _, bodies, _ in REFUSALS.values() for b in bodies)})
    none = np.zeros(0, np.int64)
    return fit(rows, seed, script=script) if rows else Model(none, np.zeros((len(LABELS), 0), np.float32), np.zeros((len(LABELS), len(DENSE)), np.float32), np.full(len(LABELS), 2.0), {}, script)


def flag_defects(df: DataFrame, model: Model, key: str = "record_id", instruction: str = "instruction", response: str = "response", labels: tuple[str, ...] = REPORTED) -> DataFrame:
    """(key, defect, score, defects): every row that has one of these labels, with the first that applies in the order
    of LABELS, and all that do.

    A null instruction or response counts as an empty text; a null key is kept as null; repeated rows are each judged;
    other columns play no part. Whole texts are read. An empty table gives no rows.
    """
    held = df.sparkSession.sparkContext.broadcast(model)  # the buckets of the sample, at most labels x 2^BITS weights
    src = df.select(F.col(key).cast("long").alias("k"), F.col(instruction).cast("string").alias("i"), F.col(response).cast("string").alias("r"))
    asked = np.array([x in labels for x in LABELS])

    def run(batches):
        m = held.value
        for batch in batches:
            for part in chunks(batch, "r", 1 << 19):
                for piece in chunks(part, "i", 1 << 19):
                    p = scores(m, piece.column(1), piece.column(2))
                    hit = (p >= m.thresholds) & asked
                    at = np.flatnonzero(hit.any(axis=1))
                    if len(at):
                        which = hit[at].argmax(axis=1)
                        every = [[LABELS[k] for k in np.flatnonzero(h)] for h in hit[at]]
                        yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(at)), pa.array([LABELS[w] for w in which], pa.string()), pa.array(p[at, which].astype(np.float64)), pa.array(every, pa.list_(pa.string()))], names=[key, "defect", "score", "defects"])

    return src.mapInArrow(run, f"{key} BIGINT, defect STRING, score DOUBLE, defects ARRAY<STRING>")
