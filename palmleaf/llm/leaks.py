"""Evaluation texts inside a corpus: SimHash windows, multi-index Hamming blocks, weighted-shingle verification."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palmleaf.llm.codepoints import U64, Words, chunks, gram_hash, splitmix

SCHEMA = "doc_id BIGINT, item_id BIGINT, windows BIGINT, exact_windows BIGINT, item_windows BIGINT, window_words BIGINT, similarity DOUBLE, item_similarity DOUBLE"


def simhash(shingles: np.ndarray, per: int) -> np.ndarray:
    """64-bit SimHash of every `per` consecutive shingles."""
    n = len(shingles) - per + 1
    if n <= 0:
        return np.zeros(0, U64)
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1)
    votes = bits[:n].copy() if per < 256 else bits[:n].astype(np.int32)
    for j in range(1, per):
        votes += bits[j : j + n]
    return np.packbits(votes > per // 2, axis=1).view(U64).ravel()


def weights(shingles: np.ndarray) -> np.ndarray:
    """A weight in 1..2 for each shingle, fixed by its hash: the same on both sides of every comparison."""
    return 1 + (shingles >> U64(40)).astype(np.float64) / (1 << 24)


def bounds(radius: int) -> list[tuple[int, int]]:
    """radius + 1 bit blocks (shift, bits): two fingerprints within the radius agree in one of them."""
    k = radius + 1
    cut = [round(64 * j / k) for j in range(k + 1)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


WORD_BYTES = 56  # what a word of an item takes in an index, at most: hashes, fingerprint, and its place in three blocks


class Index:
    """Fingerprints of all windows of the items, by Hamming block. Texts are kept once, as word and shingle hashes; a
    window is its first word's place."""

    FLAGS = 22

    def __init__(self, ids: np.ndarray, texts: pa.Array, window: int, shingle: int, radius: int):
        w = Words(texts)
        self.window, self.shingle, self.radius, self.per = window, shingle, radius, window - shingle + 1
        start = np.arange(max(0, len(w.hash) - window + 1), dtype=np.int32)
        start = start[w.row[start] == w.row[start + window - 1]] if len(start) else start
        self.words, self.start = w.hash, start
        self.sh = gram_hash(w.hash, shingle)
        self.finger = simhash(self.sh, self.per)[start] if len(start) else np.zeros(0, U64)
        self.first, self.length, self.source = w.first, w.count, w.row
        self.no, of = np.unique(np.asarray(ids, np.int64), return_inverse=True)
        self.item_of_row = of.astype(np.int32)
        self.size = np.bincount(self.item_of_row[w.row[start]], minlength=len(self.no)) if len(start) else np.zeros(len(self.no), np.int64)
        self.blocks = []
        for shift, bits in bounds(radius):
            key = ((self.finger >> U64(shift)) & U64((1 << bits) - 1)).astype(np.uint32 if bits <= 32 else U64)
            order = np.argsort(key, kind="stable").astype(np.int32)
            flags = np.zeros(1 << self.FLAGS, bool)
            flags[self.short(key)] = True
            self.blocks.append((U64(shift), U64((1 << bits) - 1), key[order], order, flags))

    def item(self, win: np.ndarray) -> np.ndarray:
        """Number of the item that windows belong to."""
        return self.item_of_row[self.source[self.start[win]]].astype(np.int64)

    def short(self, key: np.ndarray) -> np.ndarray:
        return (splitmix(key) >> U64(64 - self.FLAGS)).astype(np.int64)

    def candidates(self, finger: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (position in finger, window of the index) within the radius."""
        at, win = [], []
        for shift, mask, keys, order, flags in self.blocks:
            key = ((finger >> shift) & mask).astype(keys.dtype)
            hit = np.flatnonzero(flags[self.short(key)])
            if not len(hit):
                continue
            lo = np.searchsorted(keys, key[hit], side="left")
            n = np.searchsorted(keys, key[hit], side="right") - lo
            a = np.repeat(hit, n)
            b = order[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
            near = np.bitwise_count(finger[a] ^ self.finger[b]) <= self.radius
            at.append(a[near])
            win.append(b[near])
        if not at:
            e = np.zeros(0, np.int64)
            return e, e
        pair = np.unique(np.concatenate(at).astype(np.int64) * max(1, len(self.finger)) + np.concatenate(win))
        return pair // max(1, len(self.finger)), pair % max(1, len(self.finger))

    def verify(self, a: np.ndarray, b: np.ndarray, words: np.ndarray, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weighted Jaccard similarity of the shingles, and whether all words are the same in order."""
        x = shingles[a[:, None] + np.arange(self.per)]
        y = self.sh[self.start[b][:, None] + np.arange(self.per)]
        common = (weights(x) * (x[:, :, None] == y[:, None, :]).any(axis=2)).sum(axis=1)
        union = weights(x).sum(axis=1) + weights(y).sum(axis=1) - common
        exact = (words[a[:, None] + np.arange(self.window)] == self.words[self.start[b][:, None] + np.arange(self.window)]).all(axis=1)
        return np.maximum(common / union, exact), exact

    def passage(self, row: int, found: np.ndarray, sh: np.ndarray, lo: int, hi: int) -> float:
        """The best weighted Jaccard similarity of an item with the item-sized windows of the words lo..hi that hold a
        window found."""
        at = int(self.first[row])
        own, per = np.unique(self.sh[at : at + int(self.length[row]) - self.shingle + 1]), self.shingle - 1
        size = min(int(self.length[row]), hi - lo)
        starts = np.unique(np.clip(np.unique(found)[:, None] - np.arange(size - self.window + 1), lo, hi - size))
        weight, best = weights(own).sum(), 0.0
        for k in range(0, len(starts), 256):
            x = np.sort(sh[starts[k : k + 256, None] + np.arange(size - per)], axis=1)
            once = np.ones(x.shape, bool)
            once[:, 1:] = x[:, 1:] != x[:, :-1]
            held = weights(x) * once
            common = (held * (own[np.minimum(np.searchsorted(own, x), len(own) - 1)] == x)).sum(axis=1)
            best = max(best, float((common / (held.sum(axis=1) + weight - common)).max()))
        return min(best, 1.0)


def find_leaks(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, shingle: int = 5, radius: int = 2, similarity: float = 0.8, index_bytes: int = 128 << 20) -> DataFrame:
    """One row per (document, item) of which some passages are alike.

    Every `window`-word window of every item is fingerprinted, and the whole of an item of fewer words (of `shingle` or
    more); every window of every document is looked up by radius + 1 Hamming blocks, so no fingerprint within the radius
    is missed, and each candidate is verified by the exact weighted similarity of its word shingles. window_words tells
    the windows' size for the item. exact_windows counts distinct windows of the item found word for word.

    item_similarity is that of the whole item with the document's best passage of the item's size, changed words
    included; 0 if under `similarity`. Such a passage holds `window` words of the item unchanged (at 0.8, 10 and 5
    words, repeated shingles aside), so those around the windows found are compared. Documents are never shuffled.

    The items are broadcast in blocks whose index takes at most index_bytes in a worker (WORD_BYTES for each word,
    counted beforehand); each block is one pass over the documents, so more items cost more passes and no more memory.

    Rows with a null id are left out. Null, empty and short texts (under `shingle` words) match nothing; equal items each
    get their own rows; extra columns on either side are ignored; empty tables give no rows.
    """
    n = F.regexp_count(F.lower("t"), F.lit(r"[\p{L}\p{M}\p{N}]+"))
    it = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).cast("string").alias("t")).filter(F.col("i").isNotNull() & F.col("t").isNotNull())
    it = it.withColumn("n", n).filter(F.col("n") >= shingle)
    sizes = [r[0] for r in it.select(F.least("n", F.lit(window)).alias("w")).distinct().collect()]  # at most window
    total = it.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-int(total) * WORD_BYTES // index_bytes))
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    out = None if sizes else docs.sparkSession.createDataFrame([], SCHEMA)
    for k in range(blocks if sizes else 0):
        part = it if blocks == 1 else it.filter(F.pmod(F.xxhash64("i"), F.lit(blocks)) == k)
        rows = part.select("i", "t", F.least("n", F.lit(window)).alias("w")).collect()  # about index_bytes / WORD_BYTES words
        held = docs.sparkSession.sparkContext.broadcast({w: ([r[0] for r in rows if r[2] == w], [r[1] for r in rows if r[2] == w]) for w in sizes})
        found = src.mapInArrow(_scan(held, shingle, radius, similarity), SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out


_built: dict = {}


def _scan(held, shingle, radius, similarity):
    key = uuid.uuid4().hex  # of these indexes, in every worker process

    def run(batches):
        have = _built.get(key)
        if have is None:
            have = [Index(np.array(ids, np.int64), pa.array(texts, pa.string()), size, shingle, radius) for size, (ids, texts) in sorted(held.value.items()) if ids]
            _built.clear()
            _built[key] = have
        for batch in batches:
            for part in chunks(batch, "text"):
                w = Words(part.column(1))
                for ix in have:
                    yield from _look(ix, part, w, shingle, similarity)

    return run


def _look(ix: Index, part, w: Words, shingle: int, similarity: float):
    """The rows of a slice of documents for one index."""
    window = ix.window
    n = len(w.hash) - window + 1
    if n <= 0 or not len(ix.finger):
        return
    sh = gram_hash(w.hash, shingle)
    inside = w.row[:n] == w.row[window - 1 :]
    at, win = [], []
    for lo in range(0, n, 1 << 15):  # the bit matrix stays in cache
        hi = min(n, lo + (1 << 15))
        a, b = ix.candidates(simhash(sh[lo : hi + ix.per - 1], ix.per))
        at.append(a + lo)
        win.append(b)
    a, b = np.concatenate(at), np.concatenate(win)
    keep = inside[a]
    a, b = a[keep], b[keep]
    if not len(a):
        return
    sim, exact = ix.verify(a, b, w.hash, sh)
    keep = sim >= similarity
    a, b, sim, exact = a[keep], b[keep], sim[keep], exact[keep]
    if not len(a):
        return
    pair = w.row[a].astype(np.int64) * len(ix.no) + ix.item(b)
    u, inv = np.unique(pair, return_inverse=True)

    def distinct(m):
        """Distinct windows of the item per pair."""
        one = np.unique(np.stack([pair[m], b[m]]), axis=1)[0]
        return np.searchsorted(one, u, side="right") - np.searchsorted(one, u, side="left")

    best, whole = np.zeros(len(u)), np.zeros(len(u))
    np.maximum.at(best, inv, sim)
    item = u % len(ix.no)
    source = ix.source[ix.start[b]].astype(np.int64)
    texts = w.row[a].astype(np.int64) * len(ix.length) + source
    order = np.argsort(texts, kind="stable")
    for g in np.split(order, np.flatnonzero(np.diff(texts[order])) + 1):
        r = int(w.row[a[g[0]]])
        near = ix.passage(int(source[g[0]]), a[g], sh, int(w.first[r]), int(w.first[r] + w.count[r]))
        if near >= similarity:
            whole[inv[g[0]]] = max(whole[inv[g[0]]], near)
    size = np.full(len(u), window, np.int64)
    yield pa.RecordBatch.from_arrays(
        [part.column(0).take(pa.array(u // len(ix.no))), *map(pa.array, (ix.no[item], distinct(np.ones(len(b), bool)), distinct(exact), ix.size[item].astype(np.int64), size, best, whole))],
        names=["doc_id", "item_id", "windows", "exact_windows", "item_windows", "window_words", "similarity", "item_similarity"],
    )
