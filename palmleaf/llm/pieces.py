"""Cutting oversized texts at natural boundaries: agglomerative merging of atoms, weakest boundaries first."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palmleaf.llm.codepoints import chunks
from palmleaf.llm.tokens import TOKENIZER, Counter

# What ends a sentence or a clause, what may follow it, and short words whose stop ends nothing.
SENTENCE, CLAUSE, CLOSING = ".!?।॥…。！？", ",;:、，；：", ")]}\"'”’»"
ABBREVIATIONS = {"dr", "mr", "mrs", "ms", "st", "no", "vs", "etc", "e.g", "i.e", "cf", "adj", "adv", "n", "v"}
ENDS = frozenset(SENTENCE + CLAUSE + CLOSING)
PARAGRAPH, LINE, STOP, COMMA, WORD, INSIDE = 5, 4, 3, 2, 1, 0


def strength(word: str, white: str, following: str) -> int:
    """How natural a cut is after a word, given the white space after it and the next word."""
    lines = white.count("\n") + white.count(" ") + 2 * white.count(" ")
    if lines > 1:
        return PARAGRAPH
    if lines:
        return LINE
    bare = word.strip().rstrip(CLOSING)
    if bare[-1:] and bare[-1] in SENTENCE:
        if bare[-1] == "." and (bare[:-1].lower().lstrip("([\"'“‘") in ABBREVIATIONS or following.strip()[:1].islower()):
            return WORD
        return STOP
    return COMMA if bare[-1:] and bare[-1] in CLAUSE else WORD


class Cutter:
    def __init__(self, tokenizer: str = TOKENIZER):
        self.counter = Counter(tokenizer)

    def clusters(self, text: str, most: int) -> list[tuple[int, int]]:
        """(length, tokens) of the parts of a word longer than `most` tokens: grapheme clusters, or characters."""
        out = []
        for g in regex.findall(r"\X", text):
            n = self.counter.size(g)
            if n <= most:
                out.append((len(g), n))
            else:
                out.extend((1, self.counter.size(c)) for c in g)
        return out

    @staticmethod
    def words(text: str, starts, ends, word, tokens):
        """(start, end, tokens, strength of the cut after) of a text's words, each with the white space that follows."""
        begin, end, size, after = [], [], [], []
        k, n = 0, len(starts)
        while k < n:
            at, t = starts[k], 0
            while k < n and not word[k]:  # white space at the very start
                t += tokens[k]
                k += 1
            head = k
            if k < n:
                t += tokens[k]
                k += 1
            begin.append(at)
            if k < n and word[k] and text[ends[head] - 1] not in ENDS:  # one space follows, no mark before it
                s, last = WORD, ends[head]
            else:
                while k < n and not word[k]:
                    t += tokens[k]
                    k += 1
                last = ends[k - 1]
                white = text[ends[head] : last] if head < n else text[at:last]
                following = text[starts[k] : ends[k]] if k < n else ""
                s = strength(text[starts[head] : ends[head]] if head < n else "", white or following[:1], following)
            end.append(last)
            size.append(t)
            after.append(s)
        return begin, end, size, after

    def atoms(self, text: str, words, most: int):
        """(end positions, tokens, strengths): the words, those longer than `most` tokens as their grapheme clusters,
        whose counts are an upper bound."""
        begin, end, size, after = words
        if max(size) <= most:
            return end, size, after
        e2, s2, a2 = [], [], []
        for b, e, t, s in zip(begin, end, size, after):
            if t <= most:
                e2.append(e)
                s2.append(t)
                a2.append(s)
                continue
            for length, m in self.clusters(text[b:e], most):
                b += length
                e2.append(b)
                s2.append(m)
                a2.append(INSIDE)
            a2[-1] = s
        return e2, s2, a2

    @staticmethod
    def merge(size, after, most: int) -> list[tuple[int, int]]:
        """Ranges of atoms after merging. Equal to merging single atoms: a unit between stronger cuts that fits is
        always merged whole before any cut around it comes up, so such units are the atoms that enter the heap."""
        total = np.concatenate([[0], np.cumsum(size)])
        after = np.asarray(after)
        blocks: list[tuple[int, int]] = []

        def units(lo, hi, level):
            if total[hi] - total[lo] <= most or hi - lo == 1:
                blocks.append((lo, hi))
                return
            while level > INSIDE:
                inner = np.flatnonzero(after[lo : hi - 1] >= level) + lo + 1
                if len(inner):
                    break
                level -= 1
            if level == INSIDE:
                inner = np.arange(lo + 1, hi)
            edge = [lo, *inner.tolist(), hi]
            for x, y in zip(edge, edge[1:]):
                units(x, y, level - 1 if level > INSIDE else INSIDE)

        units(0, len(size), PARAGRAPH)
        n = len(blocks)
        lo = [b[0] for b in blocks]
        hi = [b[1] for b in blocks]
        weight = [int(total[b[1]] - total[b[0]]) for b in blocks]
        left, right, alive, version = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n, [0] * n
        heap = [(int(after[hi[k] - 1]), weight[k] + weight[k + 1], k, 0, 0) for k in range(n - 1) if weight[k] + weight[k + 1] <= most]
        heapq.heapify(heap)
        while heap:
            _, w, k, va, vb = heapq.heappop(heap)
            j = right[k] if alive[k] else -1
            if not alive[k] or j < 0 or version[k] != va or version[j] != vb:
                continue
            hi[k], weight[k], right[k] = hi[j], w, right[j]
            alive[j] = False
            version[k] += 1
            if right[k] >= 0:
                left[right[k]] = k
                if weight[k] + weight[right[k]] <= most:
                    heapq.heappush(heap, (int(after[hi[k] - 1]), weight[k] + weight[right[k]], k, version[k], version[right[k]]))
            if left[k] >= 0 and weight[left[k]] + weight[k] <= most:
                heapq.heappush(heap, (int(after[lo[k] - 1]), weight[left[k]] + weight[k], left[k], version[left[k]], version[k]))
        return [(lo[k], hi[k]) for k in range(n) if alive[k]]

    def cut(self, text: str, words, limit: int, overlap: int):
        """(piece number, start, end, tokens, overlap tokens) of each piece of a text over the limit."""
        most = max(1, limit - overlap)
        end, size, after = self.atoms(text, words, most)
        total = np.concatenate([[0], np.cumsum(size)]).tolist()
        whole = len(end) == len(words[1])
        inside = np.asarray(after) == INSIDE
        for no, (lo, hi) in enumerate(self.merge(size, after, most)):
            back = lo
            if no:
                while back > 0 and total[lo] - total[back - 1] <= overlap:
                    back -= 1
            begin = end[back - 1] if back else 0
            shared, n = total[lo] - total[back], total[hi] - total[back]
            if not whole and inside[max(0, back - 1) : hi].any():  # counts of cut words are bounds: count again
                n = self.counter.size(text[begin : end[hi - 1]])
                shared = self.counter.size(text[begin : end[lo - 1]]) if lo and back < lo else 0
            yield no, begin, end[hi - 1], n, shared


def cut_oversized(docs: DataFrame, limits: DataFrame, *, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, profile, piece_no, start_char, end_char, n_tokens, overlap_tokens, piece): pieces of the texts that exceed
    a profile's max_tokens, in order.

    Cuts are ranked paragraph, line, sentence, clause, word; a word is cut (between grapheme clusters) only if it alone
    exceeds the limit. Each piece but the first begins with the whole words that end the piece before it, as many as
    have at most the profile's overlap_tokens; with them it has at most max_tokens. Leaving out the overlaps, the pieces
    give the text again, white space included. Texts within the limit, null and empty texts give no rows; a repeated
    text gives its rows for each document; a null id stays null. limits is a small configuration (profile, max_tokens >
    overlap_tokens >= 0), checked here.
    """
    rows = limits.select("profile", "max_tokens", "overlap_tokens").limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("more than 1,000 profiles")
    profiles = [(r[0], int(r[1]), int(r[2] or 0)) for r in rows if r[1] is not None]
    if any(not 0 <= o < m or m < 4 for _, m, o in profiles):
        raise ValueError("max_tokens must be at least 4 and more than overlap_tokens")
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    smallest = min((m for _, m, _ in profiles), default=0)
    names = ["doc_id", "profile", "piece_no", "start_char", "end_char", "n_tokens", "overlap_tokens", "piece"]
    types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def run(batches):
        cutter = Cutter(tokenizer)
        for batch in batches:
            for part in chunks(batch, "text", 1 << 20):
                cps, offsets, starts, ends, row, word, tokens = cutter.counter.stretches(part.column(1))
                per = np.bincount(row, weights=tokens, minlength=part.num_rows) if len(row) else np.zeros(part.num_rows)
                first = np.searchsorted(row, np.arange(part.num_rows + 1))
                out: list[tuple] = []
                for k in np.flatnonzero(per > smallest):
                    a, b = first[k], first[k + 1]
                    body = cps[offsets[k] : offsets[k + 1]].tobytes().decode("utf-32-le", "surrogatepass")
                    words = cutter.words(body, (starts[a:b] - offsets[k]).tolist(), (ends[a:b] - offsets[k]).tolist(), word[a:b].tolist(), tokens[a:b].tolist())
                    for name, m, o in profiles:
                        if per[k] > m:
                            who = part.column(0)[int(k)].as_py()
                            out.extend((who, name, no, x, y, n, s, body[x:y]) for no, x, y, n, s in cutter.cut(body, words, m, o))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return src.mapInArrow(run, "doc_id BIGINT, profile STRING, piece_no INT, start_char BIGINT, end_char BIGINT, n_tokens BIGINT, overlap_tokens BIGINT, piece STRING")
