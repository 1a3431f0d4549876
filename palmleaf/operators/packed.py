"""Several values packed in one field: EM segmentation over the column, Viterbi lattices over each cell.

Every mark between two stretches of text is a candidate cut; the candidate values between them span a lattice, in which
quoted and bracketed spans are atomic. How often each text is a value and how often each kind of mark parts values are
learned from the whole column; the best path of each lattice gives its values.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palmleaf.runtime import drop_materialized, hot_join, materialize

# Quotes with their ends, texts that stand for null, bullets, and marks that never part values.
QUOTES = {'"': '"', "“": "”", "„": "”", "«": "»", "‘": "’", "'": "'", "「": "」"}
NULL_TEXTS = ("", "nan", "na", "n/a", "null", "none", "nil", "-", "?")
BULLETS = "-*•·–—▪◦‣"
HYPHENS, STOPS = "-‐‑﹣－֊־", ".．｡。।॥…"
ITEM = re.compile(r"(?:(?<=\s)|\A)(\(?)(\d{1,3})([.)])(?=\s|[^\W\d])")
FRESH = re.compile(rf"[\s{re.escape(BULLETS)}]*(?:\(?\d{{1,3}}[.)]\s)?[\s{re.escape(BULLETS)}]*")
ITEM_KIND = ""  # an item number as a kind of cut
EVEN = 0.5  # the rate of a mark that nothing is known of


@functools.cache
def _classes() -> tuple[re.Pattern, frozenset]:
    """(a pattern of all marks, the ones that are never a cut: hyphens, full stops, quotes and brackets)."""
    spans, never, start = [], set(HYPHENS + STOPS + "\"'"), None
    for c in range(0x20001):  # the planes after these hold no marks
        cat = unicodedata.category(chr(c)) if c < 0x20000 else ""
        inside = cat[:1] in ("P", "S") or cat in ("Cc", "Zl", "Zp")
        if cat in ("Ps", "Pe", "Pi", "Pf", "Sk"):
            never.add(chr(c))
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            spans.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return re.compile(f"[{''.join(spans)}]"), frozenset(never)


def is_null_text(s: str | None) -> bool:
    return s is None or s.strip().lower() in NULL_TEXTS


def _quote_end(s: str, i: int, hi: int) -> int:
    """The end of the quoted span that opens at i; 0 if it is not closed. A doubled quote inside is text."""
    close, k = QUOTES[s[i]], i + 1
    while True:
        k = s.find(close, k, hi)
        if k < 0:
            return 0
        if close == s[i] and s[k + 1 : k + 2] == close:
            k += 2
        elif close in "'’" and s[k + 1 : k + 2] and not (s[k + 1].isspace() or s[k + 1] in ")]" or _is_cut(s[k + 1])):
            k += 1
        else:
            return k + 1


def _is_cut(c: str) -> bool:
    marks, never = _classes()
    return c not in never and marks.match(c) is not None


def _bracket_end(s: str, i: int, hi: int) -> int:
    depth = 0
    for k in range(i, hi):
        depth += (s[k] == "(") - (s[k] == ")")
        if not depth:
            return k + 1
    return 0


def _empty(text: str) -> bool:
    t = text.strip()
    return not t or t in BULLETS or t[0] in QUOTES and not clean(t)


def candidates(s: str) -> tuple[int, int, list[tuple[int, int, str]]]:
    """(start and end of the cell's text, its candidate cuts as start, end and kind)."""
    marks, never = _classes()
    spots = [m.start() for m in marks.finditer(s)]
    lo, hi = 0, len(s)
    if not spots:
        return lo, hi, []
    t = s.strip()
    if len(t) > 1 and t[0] == "[" and t[-1] == "]":  # list notation
        lo, hi = s.index("[") + 1, s.rindex("]")
    cuts: list[tuple[int, int, str]] = []
    held: list[tuple[int, int]] = []
    last, skip, bare = lo, lo, 0
    for p in spots:
        if p < skip or p >= hi:
            continue
        c = s[p]
        if c in QUOTES and (c in "“„«「" or FRESH.fullmatch(s, last, p)):
            end = _quote_end(s, p, hi)
            if end:
                held.append((p, end))
                skip = end
            continue
        if c == "(":
            end = _bracket_end(s, p, hi) if bare <= p else 0
            if not end:
                bare = hi  # unclosed to the end: so are the ones after it, unless an item number
            elif not ITEM.match(s, p):
                held.append((p, end))
                skip = end
            continue
        if c == "[":
            last = p + 1
        if c in never:
            continue
        if c in BULLETS and s[p + 1 : p + 2].isspace() and FRESH.fullmatch(s, last, p):
            continue
        if c in ",，" and 0 < p < len(s) - 1 and s[p - 1].isdigit() and s[p + 1].isdigit():
            continue
        cuts.append((p, p + 1, c))
        last = p + 1
    # Item numbers count from the first one at the cell's start, each one more than the one before.
    if ")" in s or "." in s:
        free = [m for m in ITEM.finditer(s, lo, hi) if not any(a <= m.start() < b for a, b in held)]
        if free and not s[lo : free[0].start()].strip():
            expect = None
            for m in free:
                if bool(m[1]) and m[3] != ")":
                    continue
                if expect is None or int(m[2]) == expect:
                    cuts.append((m.start(), m.end(), ITEM_KIND))
                    expect = int(m[2]) + 1
            cuts.sort()
    return lo, hi, cuts


Gap = list[tuple[int, int, str]]  # the neighbouring cuts that stand between two atoms


def parse(s: str) -> tuple[int, int, list[Gap]]:
    """(start, end, gaps) of a cell: the gaps part stretches that hold something; marks at the ends are text so far."""
    lo, hi, cuts = candidates(s)
    gaps: list[Gap] = []
    at, begun, open_gap = lo, False, False
    for cut in cuts:
        if not _empty(s[at : cut[0]]):
            gaps.append([cut])
            begun = open_gap = True
        elif begun:
            gaps[-1].append(cut)
        elif cut[2] == ITEM_KIND:
            lo = cut[1]
        at = cut[1]
    if open_gap and _empty(s[at:hi]):
        gaps.pop()
    return lo, hi, gaps


def tidy(s: str, lo: int, hi: int, listed) -> str:
    """The text of a span as a value: without list marks, item number, bullet and white space around it, and without the
    quotes around the whole of it."""
    while True:
        while lo < hi and (s[lo].isspace() or s[lo] in listed):
            lo += 1
        while lo < hi and (s[hi - 1].isspace() or s[hi - 1] in listed):
            hi -= 1
        if hi - lo > 1 and s[lo] in BULLETS and s[lo + 1].isspace():
            lo += 1
            continue
        return clean(s[lo:hi])


def clean(v: str) -> str:
    """A value as stored: without outer white space, bullet, and the quotes around the whole of it."""
    v = v.strip()
    while len(v) > 1 and v[0] in BULLETS and v[1].isspace():
        v = v[1:].strip()
    if v in BULLETS:
        return ""
    if len(v) > 1 and v[0] in QUOTES and v[-1] == QUOTES[v[0]]:
        inner, q = v[1:-1], QUOTES[v[0]]
        if q != v[0] and q not in inner or q == v[0] and q not in inner.replace(q + q, ""):
            return inner.replace(q + q, q).strip() if q == v[0] else inner.strip()
    return v


def reduce_gaps(gaps: list[Gap], seen: dict[str, int]) -> Gap:
    """One cut for each gap: of several neighbouring marks the kind that stands alone between texts most often, together
    with the item numbers beside it."""
    out = []
    for g in gaps:
        if len(g) > 1:
            main = max(g, key=lambda c: (seen.get(c[2], 0), -c[0]))
            whole = [main, *(c for c in g if c[2] == ITEM_KIND)]
            g = [(min(c[0] for c in whole), max(c[1] for c in whole), main[2])]
        out.append(g[0])
    return out


Edge = tuple[int, int]  # first atom, last atom + 1


def lattice(marks: str) -> list[Edge]:
    """The candidate values of a cell with these kinds of cuts, in order: spans of atoms that hold no cut of the kinds
    before and after them (the cell's ends are kinds of their own), for a cell is parted by all marks of a kind it uses
    or by none of it.

    Spans between the same two kinds never overlap, so there are at most (kinds + 1) a cut: linear in the cell.
    """
    return _short_lattice(marks) if len(marks) <= 16 else _lattice(marks)


def _lattice(marks: str) -> list[Edge]:
    n = len(marks) + 1
    ahead: list[dict[str, int]] = [{}] * (n + 1)  # for each atom, the end of the span up to the next cut of each kind
    ahead[n] = {"": n}
    for i in range(n - 1, 0, -1):
        ahead[i] = {**ahead[i + 1], marks[i - 1]: i}
    out = []
    for i in range(n):
        ends = ahead[i + 1]
        stop = ends.get(marks[i - 1], n) if i else n
        out += [(i, j) for j in sorted(ends.values()) if j <= stop]
    return out


_short_lattice = functools.lru_cache(1 << 14)(_lattice)  # the same few kinds of cuts in most cells


def _add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a)) if b > -math.inf else a


def edge_scores(edges: list[Edge], marks: str, weights: list[float], rates: dict[str, float]) -> list[float]:
    """Log score of every edge: the weight of its value, the mark after it parts values, the marks inside it do not."""
    on, off = _rate_logs(marks, tuple(rates.items()))
    return [(math.log(w) if w != 1.0 else 0.0) + on[j - 1] + off[j - 1] - off[i] for (i, j), w in zip(edges, weights)]


@functools.lru_cache(1 << 14)
def _rate_logs(marks: str, rates: tuple) -> tuple[list[float], list[float]]:
    """(log rate of each mark and 0 for the cell's end, log sums of what the marks before each atom do not part)."""
    known, off = dict(rates), [0.0]
    for k in marks:
        off.append(off[-1] + math.log(1 - known.get(k, EVEN)))
    return [math.log(known.get(k, EVEN)) for k in marks] + [0.0], off


def posteriors(n: int, edges: list[Edge], scores: list[float]) -> list[float]:
    """Probability of each edge, by forward and backward sums (in one step where there are only two paths)."""
    if len(edges) == 1:
        return [1.0]
    if len(edges) == n + 1:  # each atom, or all of them
        odds = scores[1] - (sum(scores) - scores[1])
        whole = 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0
        return [whole if j - i == n else 1 - whole for i, j in edges]
    ahead, back = [-math.inf] * (n + 1), [-math.inf] * (n + 1)
    ahead[0] = back[n] = 0.0
    for (i, j), s in zip(edges, scores):
        ahead[j] = _add(ahead[j], ahead[i] + s)
    for (i, j), s in zip(reversed(edges), reversed(scores)):
        back[i] = _add(back[i], back[j] + s)
    return [math.exp(min(0.0, ahead[i] + s + back[j] - ahead[n])) for (i, j), s in zip(edges, scores)]


def viterbi(n: int, edges: list[Edge], scores: list[float]) -> list[Edge]:
    """The best path; of equal ones the one with most values."""
    best: list = [(-math.inf, None)] * (n + 1)
    best[0] = (0.0, None)
    for edge, s in zip(edges, scores):
        i, j = edge
        s += best[i][0] + 1e-6 * (j < n)
        if s > best[j][0]:
            best[j] = (s, edge)
    out, at = [], n
    while at:
        out.append(best[at][1])
        at = out[-1][0]
    return out[::-1]


def _hash(v: str) -> int:
    return xxhash.xxh64_intdigest(v.encode("utf-8", "surrogatepass")) - (1 << 63)


def _flat(names, types, columns):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


_I64, _TEXT, _REAL = pa.int64(), pa.string(), pa.float64()


def _kinds(batches):
    """How often each kind of cut stands alone between two texts; one row per kind and batch."""
    for batch in batches:
        n: dict[str, int] = {}
        for cell in batch.column(0).to_pylist():
            for g in () if is_null_text(cell) else parse(cell)[2]:
                if len(g) == 1:
                    n[g[0][2]] = n.get(g[0][2], 0) + 1
        yield _flat(["kind", "n"], [_TEXT, _I64], [list(n), list(n.values())])


def _spread(seen: dict[str, int]):
    """One row per cell: its kinds of cuts and, for each edge, hashes of its value and of the texts beside it, and its
    probability while nothing is known. What stands at a cell's ends is no text, so it is different in each cell."""

    def run(batches):
        for batch in batches:
            rows = []
            for cid, cell in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if is_null_text(cell):
                    continue
                lo, hi, gaps = parse(cell)
                cuts = reduce_gaps(gaps, seen)
                marks = "".join(c[2] for c in cuts)
                edges = lattice(marks)
                begin, end = [lo, *(c[1] for c in cuts)], [*(c[0] for c in cuts), hi]
                value = [_hash(tidy(cell, begin[i], end[j - 1], seen)) for i, j in edges]
                one = {i: v for (i, j), v in zip(edges, value) if j == i + 1}
                left = [one[i - 1] if i else cid for i, _ in edges]
                right = [one[j] if j <= len(cuts) else cid for _, j in edges]
                n = len(edges)  # of one path, of two even ones, or of more
                post = [1.0] if n == 1 else [0.5] * n if n == len(cuts) + 2 else posteriors(len(cuts) + 1, edges, edge_scores(edges, marks, [1.0] * n, {}))
                rows.append((cid, marks, value, left, right, post))
            if rows:
                yield _flat(["cid", "marks", "value", "before", "after", "post"], [_I64, _TEXT, pa.list_(_I64), pa.list_(_I64), pa.list_(_I64), pa.list_(_REAL)], zip(*rows))

    return run


LATTICE = "cid BIGINT, marks STRING, value ARRAY<BIGINT>, before ARRAY<BIGINT>, after ARRAY<BIGINT>, post ARRAY<DOUBLE>"
STEP = "cid BIGINT, e INT, value BIGINT, post DOUBLE, kind STRING, part DOUBLE, hold DOUBLE, sure_part DOUBLE, sure_hold DOUBLE"
_STEP = [_I64, pa.int32(), _I64, _REAL, _TEXT, _REAL, _REAL, _REAL, _REAL]
_STEP_NAMES = ["cid", "e", "value", "post", "kind", "part", "hold", "sure_part", "sure_hold"]


def _weighted(batch):
    """(cell id, kinds, edges, values, weights, edges with a shared value) of each row."""
    cols = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
    for cid, marks, value, shared in zip(*cols):
        edges = lattice(marks)
        weights = [1.0] * len(edges)
        own: dict[int, float] = {}
        for x in shared or ():
            own[value[x["e"]]] = own.get(value[x["e"]], 0.0) + x["post"]
        for x in shared or ():
            weights[x["e"]] = 1.0 + max(0.0, x["c"] - own[value[x["e"]]])
        yield cid, marks, edges, value, weights, shared or ()


def _learn(rates):
    """E step: probabilities of the shared edges, and how often each kind of cut parts values (rows with a kind)."""

    def run(batches):
        for batch in batches:
            rows, seen = [], {}
            for cid, marks, edges, value, weights, shared in _weighted(batch):
                post = posteriors(len(marks) + 1, edges, edge_scores(edges, marks, weights, rates))
                on = [0.0] * (len(marks) + 1)
                for (_, j), p in zip(edges, post):
                    on[j - 1] += p
                for k, p in zip(marks, on):
                    t = seen.setdefault(k, [0.0] * 4)
                    t[0] += p
                    t[1] += 1 - p
                    t[2] += max(0.0, 2 * p - 1)
                    t[3] += max(0.0, 1 - 2 * p)
                rows.extend((cid, x["e"], value[x["e"]], post[x["e"]], None, None, None, None, None) for x in shared)
            rows.extend((None, None, None, None, k, *t) for k, t in seen.items())
            if rows:
                yield _flat(_STEP_NAMES, _STEP, zip(*rows))

    return run


def _decode(rates):
    def run(batches):
        for batch in batches:
            rows = []
            for cid, marks, edges, _, weights, _ in _weighted(batch):
                path = viterbi(len(marks) + 1, edges, edge_scores(edges, marks, weights, rates))
                if len(path) > 1:
                    rows.append((cid, [j for _, j in path]))
            if rows:
                yield _flat(["cid", "ends"], [_I64, pa.list_(pa.int32())], zip(*rows))

    return run


def _values(seen: dict[str, int], listed: frozenset):
    """The values of each cell from the ends of its path, as text."""

    def run(batches):
        for batch in batches:
            rows = []
            for cell, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lo, hi, gaps = parse(cell)
                cuts = reduce_gaps(gaps, seen)
                begin, end = [lo, *(c[1] for c in cuts)], [*(c[0] for c in cuts), hi]
                rows.append((cell, [tidy(cell, begin[i], end[j - 1], listed) for i, j in zip([0, *ends], ends)]))
            if rows:
                yield _flat(["cell", "parts"], [_TEXT, pa.list_(_TEXT)], zip(*rows))

    return run


def _rates(stats: dict[str, tuple[float, float]]) -> dict[str, float]:
    """The rate of each kind, drawn with the weight of two cuts towards the rate of all kinds."""
    on, off = sum(a for a, _ in stats.values()), sum(b for _, b in stats.values())
    pooled = (on + 1) / (on + off + 2)
    return {k: min(1 - 1e-6, max(1e-6, (a + 2 * pooled) / (a + b + 2))) for k, (a, b) in stats.items()}


def unpack(df: DataFrame, key: str, column: str, *, settled: float = 0.01, max_rounds: int = 50) -> DataFrame:
    """(key, pos, value): one row per value of the cells of `column` that hold two or more, pos counted from 1.

    EM over the distinct cells. A value weighs one more than its frequency: how often it is expected to be a value in
    the other cells (a new value weighs 1). Texts that always have the same text before or after them, wherever they
    occur, give no evidence: they may be pieces of something longer. The first round counts only what the values tell
    about the marks; later rounds use the marks' rates too, and the rounds end when no rate moves by more than `settled`
    (that they do not within max_rounds is an error; from the ninth round on rates move half as far as in the round
    before, so they do). Ties part.

    Each round sends the edges whose value other cells have as well to that value's count and back; all other edges stay.
    Values that more than 1/64 of these edges have are joined by broadcast. A cell that a third of all rows repeat is
    segmented once; its rows get the values through a join that broadcasts the few hot cells.

    Nulls, blanks and texts that stand for null give no rows, nor do cells of one value; rows with a null key keep it;
    repeated rows each give theirs; other columns are ignored, whatever their names. Empty tables give no rows.
    """
    base = df.select(F.col(key).alias("k"), F.col(column).cast("string").alias("cell")).filter(F.col("cell").isNotNull())
    cells = materialize(base.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).withColumn("cid", F.monotonically_increasing_id()), "cells")
    kinds = cells.select("cell").mapInArrow(_kinds, "kind STRING, n BIGINT").groupBy("kind").agg(F.sum("n").alias("n"))
    seen = {r["kind"]: r["n"] for r in kinds.collect()}  # at most one row per mark there is
    lattices = materialize(cells.select("cid", "cell").mapInArrow(_spread(seen), LATTICE), "lattice")
    edges = lattices.select("cid", "marks", F.posexplode(F.arrays_zip("value", "before", "after", "post")).alias("e", "x")).select("cid", "marks", "e", "x.*")
    free = edges.groupBy("value").agg(F.count(F.lit(1)).alias("n"), *(f(c).alias(f"{c}_{f.__name__}") for c in ("before", "after") for f in (F.min, F.max)))
    free = materialize(free.filter("n > 1 AND before_min <> before_max AND after_min <> after_max").select("value", "n"), "free")
    total = free.agg(F.sum("n")).first()[0] or 0
    hot = [r[0] for r in free.filter(F.col("n") > max(1000, total // 64)).select("value").collect()]  # fewer than 64

    def joined(left, right):
        if not hot:
            return left.join(right, "value")
        is_hot = F.col("value").isin(hot)
        return left.filter(is_hot).join(F.broadcast(right.filter(is_hot)), "value").unionByName(left.filter(~is_hot).join(right.filter(~is_hot), "value"))

    several = lattices.filter("marks <> ''").select("cid", "marks", "value")
    alone = joined(lattices.filter("marks = ''").select(F.col("value")[0].alias("value")), free.select("value"))
    alone = materialize(alone.groupBy("value").agg(F.count(F.lit(1)).cast("double").alias("post")), "alone")  # cells of one value
    step = materialize(joined(edges.filter("marks <> ''").select("cid", "e", "value", "post"), free.select("value")).withColumn("kind", F.lit(None).cast("string")), "step")
    rates: dict[str, float] = {}
    for turn in range(max_rounds):
        live = step.filter("kind IS NULL").select("cid", "e", "value", "post")
        counts = live.select("value", "post").unionByName(alone).groupBy("value").agg(F.sum("post").alias("c"))
        known = joined(live, counts).groupBy("cid").agg(F.collect_list(F.struct("e", "post", "c")).alias("shared"))
        ready = materialize(several.join(known, "cid", "left"), "ready")
        nxt = materialize(ready.mapInArrow(_learn(rates), STEP), "step")
        stats = nxt.filter("kind IS NOT NULL").groupBy("kind").agg(*(F.sum(c).alias(c) for c in ("part", "hold", "sure_part", "sure_hold"))).collect()  # at most one row per mark
        now = _rates({r["kind"]: (r["part"], r["hold"]) if turn else (r["sure_part"], r["sure_hold"]) for r in stats})
        pull = 0.5 ** max(0, turn - 7)
        now = {k: rates.get(k, EVEN) + pull * (x - rates.get(k, EVEN)) for k, x in now.items()}
        drop_materialized(step)
        step = nxt
        moved = max((abs(now[k] - rates.get(k, EVEN)) for k in now), default=0.0)
        rates = now
        if moved <= settled:
            break
        drop_materialized(ready)
    else:
        raise RuntimeError(f"rates still move after {max_rounds} rounds")
    paths = ready.mapInArrow(_decode(rates), "cid BIGINT, ends ARRAY<INT>").join(cells.select("cid", "cell"), "cid").select("cell", "ends")
    listed = frozenset(k for k in seen if rates.get(k, EVEN) >= EVEN)
    decoded = materialize(paths.mapInArrow(_values(seen, listed), "cell STRING, parts ARRAY<STRING>"), "decoded")
    for t in (lattices, free, alone, step, ready):
        drop_materialized(t)
    rows = hot_join(base, decoded, "cell", cells.select("cell", "n"))
    return rows.select(F.col("k").alias(key), F.posexplode("parts").alias("pos", "value")).withColumn("pos", (F.col("pos") + 1).cast("int"))
