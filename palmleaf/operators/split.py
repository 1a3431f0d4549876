"""Grouped splits of exact sizes without leakage, their statistics and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palmleaf.functions import text as X
from palmleaf.runtime import distributed_rank, hot_join, materialize

RATIOS = (("train", 0.9), ("validation", 0.05), ("test", 0.05))


def check_ratios(ratios=RATIOS) -> None:
    if abs(sum(r for _, r in ratios) - 1) > 1e-9:
        raise ValueError("split ratios must sum to 1")


def _label(rank: Column, n: int, ratios) -> Column:
    """By rank: each split takes the whole part of its ratio, the last one what is left."""
    out, end = F.lit(ratios[-1][0]), []
    for name, r in ratios[:-1]:
        end.append(((end[-1][1] if end else 0) + int(n * r), name))
        end[-1] = (name, end[-1][0])
    for name, upto in reversed(end):
        out = F.when(rank < upto, F.lit(name)).otherwise(out)
    return out


def assign(df: DataFrame, pos: str = "pos", ratios=RATIOS, seed: int = 42) -> DataFrame:
    """(pos, word, split): all records of a headword in one split, records without one split on their own.

    Groups and single records are each put in a random order (md5 of the seed and their key) and cut at the ratios. The
    order is ranked by range partitions, not by a global sort in one task.
    """
    check_ratios(ratios)
    x = materialize(df.select(pos, X.casefold(X.template_word(F.coalesce(F.col("instruction").cast("string"), F.lit("")))).alias("word")), "words")
    heads = materialize(x.filter(F.col("word").isNotNull()).groupBy("word").agg(F.count(F.lit(1)).alias("n")), "heads")
    order = lambda c: F.md5(F.concat_ws("|", F.lit(str(seed)), c.cast("string")))
    groups = distributed_rank(heads, None, [order(F.col("word")), F.col("word")], "rank")
    groups = groups.select("word", _label(F.col("rank"), heads.count(), ratios).alias("split"))
    singles = x.filter(F.col("word").isNull())
    rest = distributed_rank(singles, None, [order(F.col(pos)), F.col(pos)], "rank").select(pos, "word", _label(F.col("rank"), singles.count(), ratios).alias("split"))
    named = hot_join(x.filter(F.col("word").isNotNull()), groups, "word", heads).select(pos, "word", "split")
    return named.unionByName(rest)


def stats(assigned: DataFrame) -> DataFrame:
    """(split, records, share, words): share in percent, two places."""
    per = assigned.groupBy("split").agg(F.count(F.lit(1)).alias("records"), F.countDistinct("word").alias("words"))
    total = F.sum("records").over(Window.partitionBy(F.lit(1)))  # one row per split
    return per.select("split", "records", F.round(100.0 * F.col("records") / total, 2).alias("share"), "words")


def leaks(df: DataFrame, key: Column, split: str = "split") -> DataFrame:
    """(pair, shared): how many distinct keys each two splits have in common, from one aggregation.

    The splits of a key are at most as many as there are splits; pairs without any are not listed.
    """
    per = df.select(key.alias("key"), split).filter(F.col("key").isNotNull()).groupBy("key").agg(F.sort_array(F.collect_set(split)).alias("s")).filter(F.size("s") > 1)
    two = F.flatten(F.transform("s", lambda a: F.transform(F.filter("s", lambda b: b > a), lambda b: F.concat_ws("|", a, b))))
    return per.select(F.explode(two).alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("shared"))


def pair_key(instruction: str = "instruction", response: str = "response") -> Column:
    return F.struct(*(X.casefold(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in (instruction, response)))


def python_order(keys: list, singles: list, ratios=RATIOS, seed: int = 42) -> dict:
    """The same cut after the standard generator's shuffles, for key lists small enough for the driver: key or single ->
    split. Groups are shuffled first, then single records, with one generator."""
    import random

    check_ratios(ratios)
    rng, out = random.Random(seed), {}
    for items in (list(keys), list(singles)):
        rng.shuffle(items)
        at = 0
        for name, r in ratios[:-1]:
            n = int(len(items) * r)
            out.update(dict.fromkeys(items[at : at + n], name))
            at += n
        out.update(dict.fromkeys(items[at:], ratios[-1][0]))
    return out


def python_positions(spark, sizes: list[int], seed: int = 42) -> DataFrame:
    """(list_no, at, item): where the standard generator's shuffles, one list after the other, put item 0..n-1 of each.

    The generator is one sequence by definition, so one task draws it, knowing sizes only: 8 bytes an item of the
    longest list. Keys and rows stay where they are and join by rank; nothing comes to the driver.
    """

    def run(batches):
        import random
        from array import array

        import pyarrow as pa

        for _ in batches:
            rng = random.Random(seed)
            for no, n in enumerate(sizes):
                items = array("q", range(n))
                rng.shuffle(items)
                for lo in range(0, n, 1 << 16):
                    part = items[lo : lo + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array([no] * len(part), pa.int32()), pa.array(range(lo, lo + len(part)), pa.int64()), pa.array(part, pa.int64())], names=["list_no", "at", "item"])

    return spark.range(0, 1, 1, 1).mapInArrow(run, "list_no INT, at BIGINT, item BIGINT")


def assign_python_order(heads: DataFrame, singles: DataFrame, word: str = "word", pos: str = "pos", ratios=RATIOS, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """((word, split), (pos, split)): the ratios cut after the standard generator's shuffles of the distinct words, in
    their order, and then of the single records, in theirs."""
    check_ratios(ratios)
    ranked = [distributed_rank(heads.select(word).distinct(), None, [F.col(word)], "item"), distributed_rank(singles.select(pos), None, [F.col(pos)], "item")]
    sizes = [x.count() for x in ranked]
    places = materialize(python_positions(heads.sparkSession, sizes, seed), "places")
    out = []
    for no, (x, c) in enumerate(zip(ranked, (word, pos))):
        at = places.filter(F.col("list_no") == no).select("item", "at")
        out.append(x.join(at, "item").select(c, _label(F.col("at"), sizes[no], ratios).alias("split")))
    return out[0], out[1]
