"""Mixing sources to target weights: exact block quotas dealt to output shards by a hypergeometric splitting tree."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palmleaf.llm.codepoints import splitmix
from palmleaf.llm.tokens import TOKENIZER, count_tokens
from palmleaf.runtime import distributed_rank, drop_materialized, materialize


def quotas(totals: dict[str, int], targets: dict[str, tuple[float, int]], wanted: int | None = None, hold_shares: bool = False) -> dict[str, int]:
    """Tokens to take of each source: its share of the wanted total, at most its tokens times its cap.

    The total is by default what the targeted sources hold. What sources lack, whether they have no documents or reach
    their cap, is made up by the others in the ratio of their targets, as far as their own caps allow; so the mixture has
    the wanted total and the uncapped sources keep their ratio. With hold_shares the total shrinks until no source with
    documents lacks anything instead: all of them keep their ratio, at the size that the scarcest allows.
    """
    most = {s: t * targets[s][1] for s, t in totals.items() if t > 0 and s in targets and targets[s][0] > 0 and targets[s][1] > 0}
    if not most:
        return {}
    left = float(sum(totals[s] for s in most) if wanted is None else wanted)
    share = sum(targets[s][0] for s in most)
    if hold_shares:
        left = min(left, *(m * share / targets[s][0] for s, m in most.items()))
    open_, out = dict(most), {}
    while open_:
        share = sum(targets[s][0] for s in open_)
        full = {s for s, m in open_.items() if left * targets[s][0] / share >= m}
        if not full:
            out |= {s: math.floor(left * targets[s][0] / share + 1e-6) for s in open_}
            break
        for s in full:
            out[s] = open_.pop(s)
            left -= out[s]
    return {s: out[s] for s in most}


class Tree:
    """Blocks of each source over output shards. A node's left half gets its part of the node's blocks, drawn without
    replacement (multivariate hypergeometric), the right half the rest, so every source's sum is exact.

    A draw depends on the seed and the node alone: every task works out the nodes that its blocks pass, and no table of
    all shards exists anywhere.
    """

    def __init__(self, blocks, shards: int, seed: int):
        self.blocks, self.shards, self.seed = np.asarray(blocks, np.int64), shards, seed
        self.draws: dict[int, np.ndarray] = {}

    def left(self, have: np.ndarray, size: int, path: int) -> np.ndarray:
        if path not in self.draws:
            total = int(have.sum())
            n = round(total * (size // 2) / size)
            rng = np.random.default_rng([self.seed, path])
            # Draws of more than a billion at once are beyond the generator: they are split in proportion instead.
            self.draws[path] = have * n // max(1, total) if total > 999_999_999 else rng.multivariate_hypergeometric(have, n, method="marginals") if total else have
        return self.draws[path]

    def place(self, source: np.ndarray, block: np.ndarray) -> np.ndarray:
        """The shard of each block (of a source, by number)."""
        out = np.zeros(len(block), np.int64)
        todo = [(0, self.shards, self.blocks, 1, np.arange(len(block)), block.astype(np.int64))]
        while todo:
            lo, hi, have, path, at, no = todo.pop()
            if hi - lo == 1:
                out[at] = lo
                continue
            left, mid = self.left(have, hi - lo, path), lo + (hi - lo) // 2
            first = no < left[source[at]]
            if first.any():
                todo.append((lo, mid, left, path * 2, at[first], no[first]))
            if not first.all():
                rest = ~first
                todo.append((mid, hi, have - left, path * 2 + 1, at[rest], no[rest] - left[source[at[rest]]]))
        return out


def permuted(x: np.ndarray, m: int, seed: int) -> np.ndarray:
    """A pseudo-random permutation of 0..m-1 at x: a Feistel network over the next power of four, walked until inside."""
    half = np.uint64(max(1, (max(1, m - 1).bit_length() + 1) // 2))
    low = (np.uint64(1) << half) - np.uint64(1)
    keys = np.random.default_rng(seed).integers(0, 1 << 63, 6).astype(np.uint64)
    out, todo = np.asarray(x).astype(np.uint64), np.arange(len(x))
    while len(todo):
        y = out[todo]
        a, b = y >> half, y & low
        for k in keys:
            a, b = b, a ^ (splitmix(b ^ k) & low)
        y = a << half | b
        out[todo] = y
        todo = todo[y >= np.uint64(m)]
    return out.astype(np.int64)


def mix(docs: DataFrame, targets: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", total_tokens: int | None = None, hold_shares: bool = False, shard_tokens: int = 1 << 21, block_tokens: int = 1 << 15, seed: int = 5, tokenizer: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """(mixture, shares).

    mixture(shard, pos, doc_id, source, copy_no, tokens): one row per use of a document, in the order of the shard.
    shares(source, target_share, actual_share, tokens, uses, documents, most_uses, max_repeats, source_tokens): one row per
    target; what capped sources lack the others make up (quotas()).

    Documents of a source follow one another in a fixed random order; a source that is used q tokens goes round that
    order until q is reached, so no document is used more than once more than another and never more than the cap, and
    the quota is met to within one document. The rounds are cut into blocks, the tree gives each shard (one for about
    shard_tokens of the mixture) its number of blocks of each source, and the blocks, in a random order, are dealt to the
    shards and shuffled inside them.

    Documents without a source, of a source without a target, or without any token are not used; a target without
    documents has share 0. targets is a small configuration (one row per source, bounded by check); ids may repeat: each row is a document.
    """
    spark = docs.sparkSession
    goal = targets.select("source", "target_share", "max_repeats").limit(10_001).collect()
    if len(goal) > 10_000:
        raise ValueError("more than 10,000 targets")
    want = {r[0]: (float(r[1] or 0), int(r[2] or 0)) for r in goal if r[0] is not None}
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(text).cast("string").alias("text")).filter(F.col("source").isin([*want]))
    sized = materialize(count_tokens(base, ["doc_id", "source"], "text", tokenizer=tokenizer).filter("tokens > 0"), "sized")
    totals = {r[0]: r[1] for r in sized.groupBy("source").agg(F.sum("tokens")).collect()}  # one row per target
    take = quotas(totals, want, total_tokens, hold_shares)
    names = sorted(take)
    ranked = distributed_rank(sized, "source", [F.xxhash64("doc_id", "tokens", F.lit(seed)), F.col("doc_id")], "rank", "tokens")
    plan = spark.createDataFrame([(s, k, take[s], totals[s]) for k, s in enumerate(names)], "source STRING, sno INT, quota BIGINT, total BIGINT")
    uses = ranked.join(F.broadcast(plan), "source").filter(F.col("rank_w") < F.col("quota"))
    last = F.floor((F.col("quota") - F.col("rank_w") - 1) / F.col("total"))
    uses = uses.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    uses = uses.select("doc_id", "source", "sno", (F.col("copy") + 1).cast("int").alias("copy_no"), "tokens", F.floor((F.col("copy") * F.col("total") + F.col("rank_w")) / block_tokens).cast("long").alias("block"))
    blocks = [-(-take[s] // block_tokens) for s in names]
    shards = max(1, min(sum(blocks), -(-sum(take.values()) // shard_tokens)))

    def place(batches):
        tree = Tree(blocks, shards, seed)
        for batch in batches:
            sno, block = batch.column(2).to_numpy(), batch.column(5).to_numpy().copy()
            for k in np.unique(sno):
                block[sno == k] = permuted(block[sno == k], blocks[k], seed + int(k))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), batch.column(4), pa.array(tree.place(sno, block))], names=["doc_id", "source", "copy_no", "tokens", "shard"])

    placed = uses.mapInArrow(place, "doc_id BIGINT, source STRING, copy_no INT, tokens BIGINT, shard BIGINT")
    order = Window.partitionBy("shard").orderBy(F.xxhash64("doc_id", "copy_no", F.lit(seed)), "doc_id", "copy_no")
    mixture = materialize(placed.withColumn("pos", F.row_number().over(order).cast("long")).select("shard", "pos", "doc_id", "source", "copy_no", "tokens"), "mixture")
    drop_materialized(sized)
    real = mixture.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("uses"), F.sum((F.col("copy_no") == 1).cast("long")).alias("documents"), F.max("copy_no").alias("most_uses"))
    whole = real.agg(F.sum("tokens")).first()[0] or 0
    goals = spark.createDataFrame([(s, w[0], w[1], totals.get(s, 0)) for s, w in want.items()], "source STRING, target_share DOUBLE, max_repeats INT, source_tokens BIGINT")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    shares = F.broadcast(goals).join(real, "source", "left") if whole else goals.select("*", *(F.lit(None).cast("long").alias(c) for c in ("tokens", "uses", "documents", "most_uses")))
    shares = shares.select("source", "target_share", (F.coalesce(F.col("tokens"), F.lit(0)) / F.lit(float(max(1, whole)))).alias("actual_share"), zero("tokens"), zero("uses"), zero("documents"), zero("most_uses"), "max_repeats", "source_tokens")
    return mixture, shares
