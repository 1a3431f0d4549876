"""Session, shared storage and partition-level helpers used by every operator."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def session(app: str = "palmleaf", master: str | None = None, **conf: str) -> SparkSession:
    """A session for tests and bench; a cluster passes its own."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    }
    return b.config(map=base | conf).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Read from spark.checkpoint.dir; a local one is set only where none is given."""
    have = spark.conf.get("spark.checkpoint.dir", None)
    if have:
        return have.rstrip("/")
    jsc = spark.sparkContext._jsc.sc()
    now = jsc.getCheckpointDir()
    if now.isDefined():
        return now.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="palmleaf-")
    spark.sparkContext.setCheckpointDir("file://" + own)
    return jsc.getCheckpointDir().get().rstrip("/")


_written: set[str] = set()


def materialize(df: DataFrame, tag: str = "t") -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/palmleaf-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.add(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    _written.discard(path)


def drop_materialized(df: DataFrame) -> None:
    """Delete the files behind a materialized frame that nothing reads any more."""
    for parent in {os.path.dirname(f) for f in df.inputFiles()}:
        if "/palmleaf-" in parent:
            _delete(df.sparkSession, parent)


@atexit.register
def _at_exit() -> None:
    """Written tables end with the driver's process."""
    spark = SparkSession.getActiveSession() if _written else None
    if spark is not None:
        try:
            release_all(spark)
        except Exception:  # noqa: BLE001 - the session may be gone already
            _written.clear()


def release_all(spark: SparkSession) -> None:
    """Delete every table this session wrote to the shared folder. Results not yet stored are lost with them."""
    for path in list(_written):
        _delete(spark, path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table by name. A scan of fewer splits than there are cores is dealt to all cores; larger ones are left as they are."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df


def free_name(df: DataFrame, want: str) -> str:
    """A column name that clashes with none of df (names compare without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    name = want
    while name.lower() in taken:
        name = "_" + name
    return name


def distributed_rank(df: DataFrame, group: str | None, order: list, rank: str, weight: str | None = None) -> DataFrame:
    """Rows of df with their 0-based rank (and, with weight, the weight summed over the rows before: rank + "_w")
    by `order` inside `group`, without a single-task window.

    The rows are range-partitioned and sorted once and written to the shared folder; each file-local run then gets its
    start from the counts of the runs before it. Those counts are one row per (partition, group): bounded by the
    number of partitions, never by rows.
    """
    spark = df.sparkSession
    g = F.col(group) if group else F.lit(0)
    rid, grp = free_name(df, "_rid"), free_name(df, "_grp")
    keyed = df.withColumn(grp, g)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = [F.col(grp).asc_nulls_first(), *order]
    placed = keyed.repartitionByRange(n, *sort).sortWithinPartitions(*sort).withColumn(rid, F.monotonically_increasing_id())
    placed = materialize(placed, "rank")
    pid = F.shiftright(F.col(rid), 33)
    aggs = [F.count(F.lit(1)).alias("n"), F.min(rid).alias("first")]
    if weight:
        aggs.append(F.sum(F.col(weight).cast("double" if dict(df.dtypes)[weight] in ("double", "float") else "long")).alias("w"))
    runs = placed.groupBy(pid.alias("pid"), F.col(grp).alias("g")).agg(*aggs).collect()
    runs.sort(key=lambda r: r["pid"])
    seen: dict = {}
    rows = []
    for r in runs:
        c, w = seen.get(r["g"], (0, 0))
        rows.append((r["pid"], r["g"], c - r["first"], w))
        seen[r["g"]] = (c + r["n"], w + ((r["w"] or 0) if weight else 0))
    gtype = placed.schema[grp].dataType
    wtype = T.DoubleType() if weight and dict(df.dtypes)[weight] in ("double", "float") else T.LongType()
    p_, g_, o_, w_ = (free_name(placed, n) for n in ("_pid", "_g", "_off", "_w"))
    offs = spark.createDataFrame(rows, T.StructType([T.StructField(p_, T.LongType()), T.StructField(g_, gtype), T.StructField(o_, T.LongType()), T.StructField(w_, wtype)]))
    out = placed.join(F.broadcast(offs), (pid == offs[p_]) & F.col(grp).eqNullSafe(offs[g_]))
    out = out.withColumn(rank, F.col(rid) + F.col(o_))
    if weight:
        before = Window.partitionBy(p_, grp).orderBy(rid).rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn(rank + "_w", F.col(w_) + F.coalesce(F.sum(weight).over(before), F.lit(0)))
    return out.drop(p_, g_, o_, w_, grp, rid)


def hot_join(left: DataFrame, right: DataFrame, key: str, counts: DataFrame, how: str = "inner", parts: int = 64) -> DataFrame:
    """left JOIN right on key where right has one row per key and left may hold a third of its rows under one key.

    counts(key, n) are left's rows per key, already aggregated. Keys with more than 1/parts of all rows are hot: there
    can be fewer than `parts` of them, so their rows of right are broadcast; all other keys are joined by shuffle.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = [r[0] for r in counts.filter(F.col("n") > F.lit(max(1000, total // parts))).select(key).limit(parts + 1).collect()]
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    a = left.filter(is_hot).join(F.broadcast(right.filter(is_hot)), key, how)
    b = left.filter(~is_hot).join(right.filter(~is_hot), key, how)
    return a.unionByName(b)
