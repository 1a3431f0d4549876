"""Records that differ only in formatting: canonical keys, range partitions, external sort, scan of adjacent runs."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palmleaf.runtime import materialize


def letters(c: Column) -> Column:
    """The letters, marks and digits of a text in lower case, all else dropped; null has none."""
    return F.coalesce(F.lower(F.regexp_replace(c.cast("string"), r"[^\p{L}\p{M}\p{N}]+", "")), F.lit(""))


def json_key(c: Column) -> Column:
    """A JSON text by its names and values alone: order of names and spacing do not count.

    Null is its own key. A text that is no JSON counts by its letters and signs without outer spaces.
    """
    parsed = F.try_parse_json(c)
    return F.when(c.isNull(), F.lit("0")).otherwise(F.coalesce(F.concat(F.lit("j"), F.to_json(parsed)), F.concat(F.lit("t"), F.trim(c))))


OUT = "record_id BIGINT, first_id BIGINT, head BOOLEAN, pid INT, head_key STRING, tail_key STRING, tail_first BIGINT, head_first BIGINT, whole BOOLEAN"


def runs_of_copies(df: DataFrame, key: str, texts: list[str], objects: list[str] = (), partitions: int | None = None) -> DataFrame:
    """(record_id, first_id, copies_seen = 1) for every record that has a copy before it, by canonical texts and objects.

    The canonical records are range-partitioned by a 128-bit digest and their id, so that a group of copies as large
    as a third of all rows spreads over many tasks; each partition is sorted externally by digest, full keys and id;
    adjacent records are compared by their full keys. A run that goes on in the next partition is stitched by one
    boundary row per partition. Rows with a null key column take no part. Empty tables give no rows.
    """
    spark = df.sparkSession
    names = [f"k{i}" for i in range(len(texts) + len(objects))]
    cols = [letters(F.col(c)) for c in texts] + [json_key(F.col(c)) for c in objects]
    keyed = df.select(F.col(key).cast("long").alias("record_id"), *(c.alias(n) for c, n in zip(cols, names))).filter(F.col("record_id").isNotNull())
    keyed = keyed.select("record_id", F.xxhash64(*names).alias("h1"), F.xxhash64(*reversed(names), F.lit(7)).alias("h2"), *names)
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = keyed.repartitionByRange(n, "h1", "h2", "record_id").sortWithinPartitions("h1", "h2", *names, "record_id")
    scanned = materialize(placed.mapInArrow(_scan(names), OUT), "copies")
    # One row per partition.
    edges = scanned.filter(F.col("head_key").isNotNull()).select("pid", "head_key", "head_first", "tail_key", "tail_first", "whole").collect()
    fix, last_key, last_first = [], None, None
    for e in sorted(edges, key=lambda r: r["pid"]):
        head_first = e["head_first"]
        if e["head_key"] == last_key:
            head_first = last_first
            fix.append((e["pid"], head_first))
        last_key, last_first = e["tail_key"], head_first if e["whole"] else e["tail_first"]
    rows = scanned.filter(F.col("head_key").isNull()).select("record_id", "first_id", "head", "pid")
    if fix:
        table = F.broadcast(spark.createDataFrame(fix, "pid INT, carried BIGINT"))
        rows = rows.join(table, "pid", "left").withColumn("first_id", F.when(F.col("head") & F.col("carried").isNotNull(), F.col("carried")).otherwise(F.col("first_id")))
    return rows.filter("record_id <> first_id").select("first_id", "record_id")


def _digest(row: tuple) -> str:
    d = hashlib.blake2b(digest_size=32)
    for x in row:
        b = x.encode("utf-8", "surrogatepass")
        d.update(len(b).to_bytes(8, "big") + b)
    return d.hexdigest()


def _scan(names: list[str]):
    schema = pa.schema([("record_id", pa.int64()), ("first_id", pa.int64()), ("head", pa.bool_()), ("pid", pa.int32()), ("head_key", pa.string()), ("tail_key", pa.string()), ("tail_first", pa.int64()), ("head_first", pa.int64()), ("whole", pa.bool_())])

    def run(batches):
        pid = TaskContext.get().partitionId()
        last: tuple | None = None  # full key of the run in progress
        first = None
        head_key, head_first, in_head = None, None, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids = batch.column(0).to_numpy()
            cols = [batch.column(batch.schema.get_field_index(c)) for c in names]
            new = np.ones(n, bool)
            if n > 1:
                same = None
                for c in cols:
                    eq = pc.equal(c.slice(1), c.slice(0, n - 1))
                    same = eq if same is None else pc.and_(same, eq)
                new[1:] = ~same.to_numpy(zero_copy_only=False)
            top = tuple(c[0].as_py() for c in cols)
            new[0] = top != last
            if head_key is None:
                head_key, head_first = _digest(top), int(ids[0])
            start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            firsts = np.where(start >= 0, ids[np.maximum(start, 0)], first if first is not None else 0)
            runs = np.cumsum(new)
            head = (runs <= (1 if last is None else 0)) if in_head else np.zeros(n, bool)
            keep = (firsts != ids) | head
            k = int(keep.sum())
            if k:
                none = [pa.nulls(k, t) for t in (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_())]
                yield pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(firsts[keep]), pa.array(head[keep]), pa.array(np.full(k, pid, np.int32)), *none], schema=schema)
            in_head = bool(in_head and head[-1])
            last, first = tuple(c[n - 1].as_py() for c in cols), int(firsts[-1])
        if last is not None:
            yield pa.RecordBatch.from_pylist([{"pid": pid, "head_key": head_key, "head_first": head_first, "tail_key": _digest(last), "tail_first": first, "whole": in_head}], schema=schema)

    return run


def collapse(df: DataFrame, key: str, texts: list[str], objects: list[str] = ()) -> DataFrame:
    """One row per distinct record: the smallest key of its copies and how many there are (exact, itself included)."""
    dup = runs_of_copies(df, key, texts, objects)
    counts = dup.groupBy("first_id").agg(F.count(F.lit(1)).alias("more"))
    ids = df.select(F.col(key).cast("long").alias("record_id")).filter(F.col("record_id").isNotNull())
    kept = ids.join(dup.select("record_id"), "record_id", "left_anti")
    out = kept.join(counts, kept["record_id"] == counts["first_id"], "left")
    return out.select("record_id", (F.coalesce(F.col("more"), F.lit(0)) + 1).cast(T.LongType()).alias("copies"))
