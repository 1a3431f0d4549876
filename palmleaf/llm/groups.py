"""Splits that keep related records together: headwords tie records, Borůvka contraction finds what is tied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palmleaf.runtime import distributed_rank, drop_materialized, hot_join, materialize

# The questions that name a headword, as their words in lower case; (.+) is the headword.
ASK_TWO = (r"compare the tulu words for (.+?) and (.+)$", r"what is the difference between (.+?) and (.+) in tulu$", r"translate (.+?) and (.+) to tulu$")
ASK_ONE = (
    r"use the tulu word for (.+) in a sentence$", r"what is the tulu meaning of (.+)$", r"how do you say (.+) in tulu$", r"give the tulu translation of (.+)$", r"which tulu word stands for (.+)$", r"tulu word for (.+)$",
    r"translate (.+) to tulu$", r"please tell me how (.+) is said in tulu$", r"i came across (.+) in a reader what is it called in tulu$", r"^(.+) what do tulu speakers call it$",
)


# What may open a question and is no part of it.
OPENINGS = r"(?i)\A(?:[^\p{L}\p{M}\p{N}]*(?:(?:q|question)\s*[:：]|(?:pls|please)\s*[,，]))+"


def question_words(c: Column) -> Column:
    """The words of an instruction in lower case, one space between them, without what opens the question."""
    asked = F.regexp_replace(c.cast("string"), OPENINGS, " ")
    return F.trim(F.lower(F.regexp_replace(asked, r"[^\p{L}\p{M}\p{N}]+", " ")))


def named_in(words: Column, ask_two=ASK_TWO, ask_one=ASK_ONE) -> Column:
    """The distinct headwords that question_words() name, each without spaces; none: empty. The questions are patterns
    with one or two groups; of those that match the leftmost counts, then the first. One pass of one pattern a text."""
    every = "|".join([*ask_two, *ask_one])
    two = len(ask_two)
    first = "".join(f"${k}" for k in [*range(1, 2 * two, 2), *range(2 * two + 1, 2 * two + len(ask_one) + 1)])
    second = "".join(f"${k}" for k in range(2, 2 * two + 1, 2))
    named = F.regexp_replace(words, f"\\A.*?(?:{every})", f"\u0001{first}\u0001{second}")
    bare = F.transform(F.split(named, "\u0001", -1), lambda w: F.replace(w, F.lit(" "), F.lit("")))
    return F.coalesce(F.when(named.startswith("\u0001"), F.array_distinct(F.filter(bare, lambda w: w != ""))), F.array().cast("array<string>"))


def headwords(c: Column) -> Column:
    return named_in(question_words(c))


def spanning_forest(edges: DataFrame, max_rounds: int = 64) -> tuple[DataFrame, DataFrame]:
    """Connected components of edges(u, v) by Borůvka contraction: (labels(node, root), forest(u, v)).

    In each round every component takes its least edge by a fixed random weight that is unique per edge, the picked
    edges join the persisted forest, and the components are contracted by pointer jumping; at least half of them vanish
    per round. root is the smallest node of its component. Every round ends in written tables; only counts reach the
    driver. Loops, repeated edges and nulls are allowed (null ends are dropped); nodes without an edge have no label.
    max_rounds halvings are enough for 2^max_rounds nodes; edges left after them are an error.
    """
    pair = edges.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"), F.col("u").isNull().alias("n1"), F.col("v").isNull().alias("n2"))
    pair = pair.filter(~F.col("n1") & ~F.col("n2")).select("a", "b").distinct()
    live = materialize(pair.filter("a <> b").select("a", "b", F.struct(F.xxhash64("a", "b").alias("w"), F.col("a").alias("u"), F.col("b").alias("v")).alias("e")), "edges")
    nodes = pair.select(F.col("a").alias("node")).union(pair.select("b")).distinct()
    labels = materialize(nodes.select("node", F.col("node").alias("root")), "labels")
    forest = None
    for _ in range(max_rounds):
        if live.isEmpty():
            break
        both = live.select("a", "b", "e").union(live.select(F.col("b"), F.col("a"), "e"))
        pick = materialize(both.groupBy("a").agg(F.min(F.struct("e", "b")).alias("m")).select(F.col("a").alias("node"), F.col("m.b").alias("up"), F.col("m.e").alias("e")), "pick")
        new = pick.select("e.u", "e.v").distinct()
        forest = new if forest is None else forest.union(new)
        # Two components that picked the same edge point at each other: the smaller is the root.
        back = pick.select(F.col("node").alias("up"), F.col("up").alias("upup"))
        tree = pick.select("node", "up").join(back, "up", "left")
        tree = tree.select("node", F.when((F.col("upup") == F.col("node")) & (F.col("node") < F.col("up")), F.col("node")).otherwise(F.col("up")).alias("up"))
        tree = materialize(tree, "tree")
        while True:
            above = tree.select(F.col("node").alias("up"), F.col("up").alias("upup"))
            jumped = materialize(tree.join(above, "up").select("node", F.col("upup").alias("up"), (F.col("up") != F.col("upup")).alias("moved")), "tree")
            moved = not jumped.filter("moved").isEmpty()
            drop_materialized(tree)
            tree = jumped.select("node", "up")
            if not moved:
                break
        relabel = tree.select(F.col("node").alias("root"), "up")
        merged = labels.join(relabel, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        labels_next = materialize(merged, "labels")
        drop_materialized(labels)
        labels = labels_next
        ra, rb = tree.select(F.col("node").alias("a"), F.col("up").alias("ra")), tree.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        kept = live.join(ra, "a").join(rb, "b").filter("ra <> rb")
        kept = kept.groupBy(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).agg(F.min("e").alias("e"))
        live_next = materialize(kept, "edges")
        drop_materialized(live)
        live = live_next
    if not live.isEmpty():
        raise RuntimeError(f"components are not contracted after {max_rounds} rounds")
    least = labels.groupBy("root").agg(F.min("node").alias("least"))
    out = labels.join(least, "root").select("node", F.col("least").alias("root"))
    if forest is None:
        forest = pair.filter("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v"))
    return materialize(out, "labels"), materialize(forest.distinct(), "forest")


def tie_by_headword(df: DataFrame, key: str = "record_id", instruction: str = "instruction", ask_two=ASK_TWO, ask_one=ASK_ONE) -> DataFrame:
    """(key, first_id): every record that names a headword, with the smallest key of all records tied to it."""
    return headword_forest(df, key, instruction, ask_two, ask_one)[0]


def headword_forest(df: DataFrame, key: str = "record_id", instruction: str = "instruction", ask_two=ASK_TWO, ask_one=ASK_ONE) -> tuple[DataFrame, DataFrame]:
    """(ties, forest): ties(key, first_id) are the records that name a headword, with the smallest key of all records tied
    to it; forest(u, v) is the written spanning forest of the headwords, each by its smallest record.

    Edges join the headwords that one record names; a headword of a third of all rows is one node, counted before any
    shuffle of rows, and its rows get their root by broadcast of the few hot headwords. Rows with a null key, and rows
    whose instruction is null or names none, are not returned.
    """
    asked = df.select(F.col(key).cast("long").alias("k"), question_words(F.col(instruction)).alias("w")).filter(F.col("k").isNotNull() & F.col("w").rlike("[a-z]"))
    named = asked.select("k", named_in(F.col("w"), ask_two, ask_one).alias("hw")).filter(F.size("hw") > 0)
    named = materialize(named, "named")
    heads = materialize(named.select("k", F.explode("hw").alias("h")).groupBy("h").agg(F.min("k").alias("node"), F.count(F.lit(1)).alias("n")), "heads")
    # A record that names several headwords chains them; equal pairs are merged before the join.
    chain = named.filter(F.size("hw") > 1).select(F.explode(F.arrays_zip(F.slice("hw", 1, F.size("hw") - 1).alias("x"), F.slice(F.col("hw"), F.lit(2), F.size("hw") - 1).alias("y"))).alias("p"))
    chain = chain.select(F.least("p.x", "p.y").alias("x"), F.greatest("p.x", "p.y").alias("y")).distinct()
    of = heads.select("h", "node")
    edges = chain.join(of.select(F.col("h").alias("x"), F.col("node").alias("u")), "x").join(of.select(F.col("h").alias("y"), F.col("node").alias("v")), "y").select("u", "v")
    labels, forest = spanning_forest(edges)
    roots = heads.join(labels.withColumnRenamed("root", "r"), "node", "left").select("h", F.coalesce("r", "node").alias("first_id"))
    one = named.select("k", F.col("hw")[0].alias("h"))
    return hot_join(one, roots, "h", heads.select("h", "n")).select(F.col("k").alias(key), "first_id"), forest


def assign_splits(groups: DataFrame, shares: list[tuple[str, float]], group: str, key: str, seed: int = 11) -> DataFrame:
    """(key, split, group): all rows of a group under one label, the labels in the given shares of rows.

    The groups are put in bands by the power of two of their size and each band is dealt systematically: the labels
    follow one another along the band's random order at their rates, from a start carried over from the band before.
    A band's rates are what is still wanted of each label; a label that wants less than one group of the band gets none
    of it. The largest bands are dealt first, so the small ones even out what these left.
    """
    total = sum(s for _, s in shares)
    if not shares or total <= 0 or any(s < 0 for _, s in shares):
        raise ValueError("shares must be positive")
    spark = groups.sparkSession
    sized = groups.groupBy(F.col(group).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    sized = materialize(sized.withColumn("band", F.floor(F.log2(F.col("n").cast("double"))).cast("int")), "sized")
    bands = sorted(((r["band"], r["m"], r["rows"]) for r in sized.groupBy("band").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("rows")).collect()), reverse=True)  # at most 63 rows
    order = sorted(shares, key=lambda x: x[1])  # the largest share takes what the others leave
    left = sum(b[2] for b in bands)
    want = {name: left * s / total for name, s in order}
    carry = {name: (k + 0.5) / len(order) for k, (name, _) in enumerate(order)}
    plan = []
    for band, m, rows in bands:
        rest = 1.0
        line = [band]
        count = float(m)
        top = order[-1][0]
        for name, _ in order[:-1]:
            rate = max(0.0, want[name]) / left if left else 0.0
            if want[name] < 2.0**band and name != top:
                rate = 0.0
            q = min(1.0, rate / rest) if rest > 1e-12 else 0.0
            line += [q, carry[name]]
            end = count * q + carry[name]
            hits = float(int(end))
            carry[name] = end - hits
            want[name] -= hits * rows / m
            count -= hits
            rest -= rate
        want[top] -= count * rows / m
        left -= rows
        plan.append(tuple(line))
    fields = "band INT" + "".join(f", q{k} DOUBLE, o{k} DOUBLE" for k in range(len(order) - 1))
    table = F.broadcast(spark.createDataFrame(plan, fields)) if plan else spark.createDataFrame([], fields)
    ranked = distributed_rank(sized, "band", [F.xxhash64("g", F.lit(seed)), F.col("g")], "rank").join(table, "band")
    r, label, free = F.col("rank").cast("double"), F.lit(None).cast("string"), F.lit(True)
    for k, (name, _) in enumerate(order[:-1]):
        before, after = F.floor(r * F.col(f"q{k}") + F.col(f"o{k}")), F.floor((r + 1) * F.col(f"q{k}") + F.col(f"o{k}"))
        label = F.when(free & (after > before), F.lit(name)).otherwise(label)
        free = free & (after <= before)
        r = r - before
    dealt = ranked.select("g", "n", F.coalesce(label, F.lit(order[-1][0])).alias("split"))
    rows = groups.select(F.col(key), F.col(group).alias("g"))
    return hot_join(rows, dealt.select("g", "split"), "g", sized.select("g", "n")).select(key, "split", F.col("g").alias(group))
