"""The same or nearly the same record in two splits: a suffix array over the splits' texts, word by word.

Suffixes are range-partitioned and sorted by their context and words; the common prefixes of neighbours of different
splits give the candidates, which are verified in full and whose shared spans are merged to coverage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palmleaf.llm.codepoints import U64, Words, chunks, span_hash, splitmix
from palmleaf.runtime import drop_materialized, materialize

PREFIX = 5  # no pair within the tolerance shares less in one place than so many words
DEEP = 12  # words of a suffix that the array is sorted by, more than any common prefix that is asked for
WORD = 3  # bytes of a word's hash in the array
ENDS_UPTO, STRIDE_FROM = 19, 18
CLIP = (1 << 20) - 1
HOT_BUCKETS, WORD_BUCKETS = 1 << 20, 1 << 16
PRIME_2 = U64(0xD6E8FEB86659FD93)
SUFFIX = "key BINARY, side BYTE, need BYTE, cls LONG, id LONG, ni INT, nr INT, si LONG, sr LONG"
TRAIN = ("cls", "ni", "nr", "si", "sr")


def tolerance(n):
    """The edits allowed between texts of which the longer has n words."""
    return n // 10


def stride(m: int) -> int:
    """Distance of sampled suffixes of a text of m >= STRIDE_FROM words.

    A partner has at most n words with n - tolerance(n) <= m; with e edits between them some unbroken shared span has
    at least (n - e) / (e + 1) words. Sampling this often puts a sampled position with PREFIX words into every one.
    """
    n, least = max(m, 20), 1 << 30
    while n - tolerance(n) <= m:
        e = tolerance(n)
        least = min(least, -(-(n - e) // (e + 1)))
        n += 1
    return max(1, least - PREFIX + 1)


STRIDES = np.array([stride(m) if m >= STRIDE_FROM else 1 for m in range(400)])


def _bag(h: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """For each text 64 parities of its words: every edit changes at most two of them."""
    bit = U64(1) << (h >> U64(58))
    out = np.zeros(n, U64)
    np.bitwise_xor.at(out, row, bit)
    return out


def class_keys(i: Words, r: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the instruction's words, of the response's, and 128 bits of both): equal words, equal hashes."""
    hi, hr = (span_hash(w.hash, w.first, w.first + w.count) for w in (i, r))
    gi, gr = (span_hash(splitmix(w.hash ^ PRIME_2), w.first, w.first + w.count) for w in (i, r))
    return hi, hr, splitmix(hi * U64(3) + splitmix(hr)), splitmix(gi * U64(5) + splitmix(gr ^ PRIME_2))


def _starts(w: Words, every: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, position, words that a partner's suffix must share) of the suffixes of the texts of 9 or more words that
    enter the array: all of an evaluation text; of a training text that allows one edit the first and the last half (one
    of them is unbroken), of a longer one a sample that cannot miss."""
    n = w.count.astype(np.int64)
    if every:
        rows = np.flatnonzero(n >= 9)
        k = n[rows] - PREFIX + 1
        row = np.repeat(rows, k)
        return row, np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k), np.zeros(len(row), np.int64)
    ends = np.flatnonzero((n >= 9) & (n <= ENDS_UPTO))
    half = np.maximum(PREFIX, n[ends] // 2)
    rows, pos, need = [ends, ends], [np.zeros(len(ends), np.int64), n[ends] - half], [half, half]
    long = np.flatnonzero(n >= STRIDE_FROM)
    if len(long):
        step = STRIDES[np.minimum(n[long], len(STRIDES) - 1)]
        k = (n[long] - PREFIX) // step + 1
        rows.append(np.repeat(long, k))
        pos.append((np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)) * np.repeat(step, k))
        need.append(np.full(int(k.sum()), PREFIX))
    return np.concatenate(rows), np.concatenate(pos), np.concatenate(need)


def _suffixes(batches):
    for batch in batches:
        for part in _both(batch):
            i, r = Words(part.column(2)), Words(part.column(3))
            hi, hr, cls, _ = class_keys(i, r)
            side, ids = part.column(0).to_numpy(), part.column(1).to_numpy()
            _, one = np.unique(np.stack([cls, side.astype(U64)]), axis=1, return_index=True)  # copies within a batch count once
            alone = np.zeros(len(ids), bool)
            alone[one] = True
            ni, nr = i.count.astype(np.int64), r.count.astype(np.int64)
            si, sr = _bag(i.hash, i.row, len(ids)), _bag(r.hash, r.row, len(ids))
            rows, ctx, needs, words = [], [], [], []

            def add(row, at, need, context, w, keep):
                keep = keep & alone[row]
                row, at = row[keep], at[keep]
                if not len(row):
                    return
                rows.append(row)
                ctx.append(context[keep])
                needs.append(need[keep])
                if w is None:
                    words.append(np.zeros((len(row), DEEP), np.uint32))
                    return
                here = (w.first[row] + at)[:, None] + np.arange(DEEP)
                inside = here < (w.first[row] + w.count[row])[:, None]
                words.append(np.where(inside, w.hash[np.minimum(here, len(w.hash) - 1)] >> U64(40), 0).astype(np.uint32))

            # Both texts short: no edit is allowed, the shared prefix is the whole record.
            short = np.arange(len(ids))
            add(short, short * 0, short * 0, cls, None, (ni <= 9) & (nr <= 9))
            for ev in (False, True):
                mine = (side > 0) == ev
                row, at, need = _starts(i, ev)
                add(row, at, need, splitmix(hr[row] + U64(1)), i, mine[row] & (nr[row] <= 9))
                row, at, need = _starts(r, ev)
                add(row, at, need, splitmix(hi[row] + U64(2)), r, mine[row] & (ni[row] <= 9))
                add(row, at, need, np.full(len(row), 3, U64), r, mine[row] & (ni[row] >= 9))
            if not rows:
                continue
            row = np.concatenate(rows)
            width = 8 + WORD * DEEP
            key = np.empty((len(row), width), np.uint8)
            key[:, :8] = np.concatenate(ctx).astype(">u8").view(np.uint8).reshape(-1, 8)
            key[:, 8:] = np.concatenate(words).astype(">u4").view(np.uint8).reshape(-1, DEEP, 4)[:, :, 1:].reshape(-1, WORD * DEEP)
            binary = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer((np.arange(len(row) + 1) * width).astype(np.int32)), pa.py_buffer(key.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [binary, pa.array(side[row].astype(np.int8)), pa.array(np.concatenate(needs).astype(np.int8)), *(pa.array(x) for x in (cls[row].view(np.int64), ids[row], np.minimum(ni[row], CLIP).astype(np.int32), np.minimum(nr[row], CLIP).astype(np.int32), si[row].view(np.int64), sr[row].view(np.int64)))],
                names=["key", "side", "need", "cls", "id", "ni", "nr", "si", "sr"],
            )


def _both(batch):
    """Slices of the batch bounded in both texts."""
    for part in chunks(batch, "r", 1 << 20):
        yield from chunks(part, "i", 1 << 20)


def _keys(batch) -> np.ndarray:
    """The keys of a batch, a row of 8 + WORD * DEEP bytes each."""
    col, width = batch.column(0), 8 + WORD * DEEP
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + batch.num_rows + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[off[0] : off[0] + batch.num_rows * width].reshape(batch.num_rows, width)


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The words that keys have in common at their start, row by row; 0 where the contexts differ."""
    same = a == b
    words = same[:, 8:].reshape(len(a), DEEP, WORD).all(axis=2)
    return np.where(same[:, :8].all(axis=1), np.minimum.accumulate(words, axis=1).sum(axis=1), 0)


def _adjacent(batches):
    """The suffixes that share PREFIX words with one of the other split, a training suffix as many as it needs.

    In the sorted array the longest prefix that a suffix shares with any of the other split is the one that it shares
    with the nearest of them before or after it. Suffixes wait for the next one of the other split for as long as the
    array's common prefix with them lasts: at most one partition. The first and the last interval of a partition may go
    on in the next, so they are kept whole.
    """
    waiting: list[pa.RecordBatch] = []  # the interval at the end of what was read
    first = True

    def judged(block, whole):
        key, side, need = _keys(block), block.column(1).to_numpy() > 0, block.column(2).to_numpy()
        n = len(side)
        best = np.zeros(n, np.int64)
        for mine in (False, True):
            other = np.where(side != mine, np.arange(n), -1)
            before = np.maximum.accumulate(other)
            after = (n - 1 - np.maximum.accumulate(np.where(other[::-1] >= 0, np.arange(n), -1)))[::-1]
            for near in (before, np.where(after < n, after, -1)):
                at = np.flatnonzero((side == mine) & (near >= 0))
                best[at] = np.maximum(best[at], common(key[at], key[near[at]]))
        keep = (best >= np.maximum(PREFIX, need)) | whole
        return block.filter(pa.array(keep)) if keep.any() else None

    last = None  # the key before
    for batch in batches:
        if not batch.num_rows:
            continue
        key = _keys(batch)
        before = key[:1] if last is None else last
        breaks = np.flatnonzero(common(key, np.concatenate([before, key[:-1]])) < PREFIX)
        breaks = breaks[breaks > 0] if last is None else breaks
        last = key[-1:].copy()
        if not len(breaks):
            waiting.append(batch)
            continue
        end = int(breaks[-1])
        block = pa.Table.from_batches([*waiting, batch.slice(0, end)]).combine_chunks().to_batches()
        if block:
            whole = np.zeros(block[0].num_rows, bool)
            whole[: block[0].num_rows - end + int(breaks[0]) if first else 0] = True
            out = judged(block[0], whole)
            if out is not None:
                yield out
        first, waiting = False, [batch.slice(end)]
    yield from waiting


def edits(a: list, b: list, most: int) -> int:
    """Words to insert, remove or replace to turn a into b; most + 1 if it takes more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    ea, eb = len(a), len(b)
    while ea > lo and eb > lo and a[ea - 1] == b[eb - 1]:
        ea, eb = ea - 1, eb - 1
    a, b = a[lo:ea], b[lo:eb]
    if not a or not b:
        return len(a) + len(b)
    big = most + 1
    row = {j: j for j in range(min(len(b), most) + 1)}
    for x in range(1, len(a) + 1):
        now = {}
        for j in range(max(0, x - most), min(len(b), x + most) + 1):
            v = x if j == 0 else min(row.get(j, big) + 1, now.get(j - 1, big) + 1, row.get(j - 1, big) + (a[x - 1] != b[j - 1]))
            now[j] = min(v, big)
        row = now
        if min(row.values()) > most:
            return big
    return row.get(len(b), big)


def covered(a: list, b: list) -> int:
    """Words of b inside the spans of PREFIX or more words that it shares with a; all of them where the texts are equal.

    Every suffix of b is extended to the longest prefix it has in common with a suffix of a, and the spans are merged.
    A span of PREFIX or more words is the union of the PREFIX-word spans inside it, so these are looked up instead.
    """
    if a == b:
        return len(b)
    known = {tuple(a[k : k + PREFIX]) for k in range(len(a) - PREFIX + 1)}
    total = end = 0
    for k in range(len(b) - PREFIX + 1):
        if tuple(b[k : k + PREFIX]) in known:
            total += k + PREFIX - max(end, k)
            end = k + PREFIX
    return total


def _verify(batches):
    for batch in batches:
        out = []
        for part in chunks(batch, "tr", 1 << 20):
            for piece in chunks(part, "er", 1 << 20):
                w = [Words(piece.column(piece.schema.get_field_index(c))) for c in ("ti", "tr", "ei", "er")]
                keys = [k.view(np.int64) for k in (*class_keys(w[0], w[1])[2:], *class_keys(w[2], w[3])[2:])]
                for k in range(piece.num_rows):
                    t = [x.hash[x.first[k] : x.first[k] + x.count[k]].tolist() for x in w]
                    mi, mr = tolerance(max(len(t[0]), len(t[2]))), tolerance(max(len(t[1]), len(t[3])))
                    di = edits(t[0], t[2], mi)
                    dr = edits(t[1], t[3], mr) if di <= mi else mr + 1
                    if di <= mi and dr <= mr:
                        longest = max(len(t[0]), len(t[2])) + max(len(t[1]), len(t[3]))
                        out.append((*(int(x[k]) for x in keys), di + dr, longest, covered(t[0], t[2]) + covered(t[1], t[3])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["tc", "tc2", "ec", "ec2", "edits", "words", "covered"])


def _classes(batches):
    for batch in batches:
        for part in _both(batch):
            keys = class_keys(Words(part.column(2)), Words(part.column(3)))[2:]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(k.view(np.int64)) for k in keys)], names=["side", "id", "cls", "cls2"])


def _count_words(batches):
    """(bucket, n): how often words of each bucket of hashes occur; at most WORD_BUCKETS rows a batch."""
    for batch in batches:
        n = np.zeros(WORD_BUCKETS, np.int64)
        for part in _both(batch):
            for c in (2, 3):
                n += np.bincount((Words(part.column(c)).hash >> U64(48)).astype(np.int64), minlength=WORD_BUCKETS)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], names=["bucket", "n"])


def _rare_words(often):
    """(side, id, token): of each record as many of its rarest words, the further ones of a word told apart, as there can
    be edits, and one more. Two records within the tolerance have one of them in common, whatever the order of words."""

    def run(batches):
        count = np.asarray(often.value)
        for batch in batches:
            for part in _both(batch):
                i, r = Words(part.column(2)), Words(part.column(3))
                row = np.concatenate([i.row, r.row])
                token = np.concatenate([i.hash, splitmix(r.hash)])
                n = count[np.concatenate([i.hash, r.hash]) >> U64(48)]
                order = np.lexsort((token, row))
                row, token, n = row[order], token[order], n[order]
                new = np.append(True, (row[1:] != row[:-1]) | (token[1:] != token[:-1])) if len(row) else np.zeros(0, bool)
                at = np.arange(len(row))
                token = splitmix(token + (at - np.maximum.accumulate(np.where(new, at, 0))).astype(U64))
                order = np.lexsort((token, n, row))
                row, token = row[order], token[order]
                keep = at - np.searchsorted(row, row) <= (i.count // 9 + r.count // 9)[row]
                row, token = row[keep], token[keep]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)), pa.array(token.view(np.int64))], names=["side", "id", "token"])

    return run


def _pairs(shared: DataFrame, by: list[str]) -> DataFrame:
    """(tid, eid): one pair of records for each two classes that meet in an interval and can be within the tolerance."""
    same = ["prefix", *by]
    t = shared.filter("side = 0").groupBy(*same, "need", *TRAIN, "key").agg(F.min("id").alias("tid")).withColumnRenamed("key", "tkey")
    e = shared.filter("side = 1").groupBy(*same, *(F.col(c).alias(f"e_{c}") for c in TRAIN), F.col("key").alias("ekey")).agg(F.min("id").alias("eid"))

    def near(c, bag):
        m = F.greatest(c, f"e_{c}")
        allowed = F.floor(m / 10)
        return (m >= CLIP) | ((F.abs(F.col(c) - F.col(f"e_{c}")) <= allowed) & (F.bit_count(F.col(bag).bitwiseXOR(F.col(f"e_{bag}"))) <= 2 * allowed))

    long_enough = F.expr(f"need <= {PREFIX} OR substring(tkey, 1, 8 + {WORD} * need) = substring(ekey, 1, 8 + {WORD} * need)")
    met = t.join(e, same).filter(near("ni", "si") & near("nr", "sr") & long_enough)
    return met.groupBy(*TRAIN, *(f"e_{c}" for c in TRAIN)).agg(F.min("tid").alias("tid"), F.min("eid").alias("eid")).select("tid", "eid")


def overlap_classes(train: DataFrame, evals: DataFrame, key: str = "record_id", instruction: str = "instruction", response: str = "response", hot_pairs: int = 1 << 17) -> tuple[DataFrame, DataFrame]:
    """(links, members) between classes of records with the same words.

    links(tc, tc2, ec, ec2, edits, words, covered): classes of the training and of the evaluation side whose instruction
    and response are each at most a tenth of the longer text's words apart. members(side, id, cls, cls2): the records of
    these classes (side 0 is the training side). A class is 128 bits of its words' hashes.

    Suffixes are range-partitioned by context (the other text, where it is too short for any edit), words and id, so that
    a phrase that a third of all records hold spreads over many tasks. Classes meet in the intervals of PREFIX common
    words; an interval in which more than hot_pairs of them would meet is split by the records' rarest words, of which
    two records within the tolerance share one: nothing is skipped, and no interval is compared all with all.
    """
    spark = train.sparkSession
    cols = [F.col(key).cast("long").alias("id"), F.col(instruction).cast("string").alias("i"), F.col(response).cast("string").alias("r")]
    base = train.select(F.lit(0).cast("byte").alias("side"), *cols).unionByName(evals.select(F.lit(1).cast("byte").alias("side"), *cols)).filter("id IS NOT NULL")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    array = base.mapInArrow(_suffixes, SUFFIX).repartitionByRange(n, "key", "id").sortWithinPartitions("key", "id")
    shared = materialize(array.mapInArrow(_adjacent, SUFFIX), "shared")
    prefixed = shared.withColumn("prefix", F.expr(f"substring(key, 1, 8 + {WORD} * {PREFIX})"))
    met = prefixed.groupBy("prefix").agg(F.sum(1 - F.col("side")).alias("t"), F.sum("side").alias("e")).filter(F.col("t").cast("double") * F.col("e") > hot_pairs)
    bucket = F.pmod(F.xxhash64("prefix"), F.lit(HOT_BUCKETS)).cast("int")
    hot = materialize(met.select(bucket.alias("bucket")).distinct(), "hot")  # at most HOT_BUCKETS rows
    if hot.isEmpty():
        pairs = _pairs(prefixed, [])
    else:
        placed = prefixed.withColumn("bucket", bucket)
        warm = materialize(placed.join(F.broadcast(hot), "bucket", "left_semi"), "warm")
        records = materialize(base.join(warm.select("side", "id").distinct(), ["side", "id"], "left_semi").select("side", "id", "i", "r"), "records")
        often = np.zeros(WORD_BUCKETS, np.int64)
        for r in records.mapInArrow(_count_words, "bucket INT, n BIGINT").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most WORD_BUCKETS rows
            often[r["bucket"]] = r["n"]
        rare = records.mapInArrow(_rare_words(spark.sparkContext.broadcast(often)), "side BYTE, id BIGINT, token BIGINT")
        split = warm.join(rare, ["side", "id"])
        pairs = _pairs(placed.join(F.broadcast(hot), "bucket", "left_anti"), []).unionByName(_pairs(split, ["token"])).distinct()
    pairs = materialize(pairs, "pairs")
    text = base.select("side", "id", "i", "r")
    tt = text.filter("side = 0").select(F.col("id").alias("tid"), F.col("i").alias("ti"), F.col("r").alias("tr"))
    et = text.filter("side = 1").select(F.col("id").alias("eid"), F.col("i").alias("ei"), F.col("r").alias("er"))
    wanted_t, wanted_e = pairs.select("tid").distinct(), pairs.select("eid").distinct()
    both = pairs.join(tt.join(wanted_t, "tid", "left_semi"), "tid").join(et.join(wanted_e, "eid", "left_semi"), "eid")
    links = both.select("ti", "tr", "ei", "er").mapInArrow(_verify, "tc LONG, tc2 LONG, ec LONG, ec2 LONG, edits LONG, words LONG, covered LONG")
    links = materialize(links.groupBy("tc", "tc2", "ec", "ec2").agg(F.min("edits").alias("edits"), F.max("words").alias("words"), F.max("covered").alias("covered")), "links")
    for t in (shared, hot, pairs):
        drop_materialized(t)
    linked = links.select(F.lit(0).cast("byte").alias("side"), F.col("tc").alias("cls"), F.col("tc2").alias("cls2")).union(links.select(F.lit(1).cast("byte"), "ec", "ec2")).distinct()
    return links, base.mapInArrow(_classes, "side BYTE, id LONG, cls LONG, cls2 LONG").join(linked, ["side", "cls", "cls2"], "left_semi").select("side", "id", "cls", "cls2")


def find_overlaps(train: DataFrame, evals: DataFrame, key: str = "record_id", instruction: str = "instruction", response: str = "response", hot_pairs: int = 1 << 17) -> DataFrame:
    """(train_id, eval_id, edits, words, covered): the links of overlap_classes() as pairs of records.

    edits and words (of the longer texts) are sums over instruction and response, and so is covered: the evaluation
    text's words in spans of PREFIX or more words shared with the same text of the training record, each merged on its
    own, or all its words where the two are equal.

    A null text has no words; two texts without words are the same. Rows with a null key are left out. Extra columns
    are ignored. Empty tables give no rows.
    """
    links, members = overlap_classes(train, evals, key, instruction, response, hot_pairs)
    tm = members.filter("side = 0").select(F.col("id").alias("train_id"), F.col("cls").alias("tc"), F.col("cls2").alias("tc2"))
    em = members.filter("side = 1").select(F.col("id").alias("eval_id"), F.col("cls").alias("ec"), F.col("cls2").alias("ec2"))
    return links.join(em, ["ec", "ec2"]).join(tm, ["tc", "tc2"]).select("train_id", "eval_id", "edits", "words", "covered")
