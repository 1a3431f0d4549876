"""Token counts by a public byte-level BPE: every distinct stretch of text is encoded once per worker."""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palmleaf.llm.codepoints import TABLE, char_mix, chunks, clip, codepoints, runs, span_hash

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the public pre-tokenizer pattern of the byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The code points of Unicode's White_Space property.
WHITE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
CACHE = 1 << 20


@functools.cache
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def white_table() -> np.ndarray:
    t = np.zeros(TABLE + 2, bool)
    t[list(WHITE)] = True
    return t


class Counter:
    """Counts by stretches the pattern never joins: a word with the one space before it, or the white space left over."""

    def __init__(self, path: str = TOKENIZER):
        self.enc = encoding(path)
        self.known: dict[int, int] = {}

    def size(self, text: str) -> int:
        return len(self.enc.encode_ordinary(text))

    def stretches(self, col: pa.Array):
        """(code points, row offsets, start, end, row, is a word, tokens) of all stretches of all rows, in order."""
        cps, offsets = codepoints(col)
        white = white_table()[clip(cps)]
        ws, we, wr = runs(~white, offsets)
        if len(ws):
            take = (ws > offsets[wr]) & (cps[np.maximum(ws - 1, 0)] == 32)
            ws = ws - take
        inside = np.zeros(len(cps) + 1, np.int64)
        np.add.at(inside, ws, 1)
        np.add.at(inside, we, -1)
        rest = np.cumsum(inside)[: len(cps)] == 0
        ss, se, sr = runs(rest, offsets)
        # White space before a word: the pattern takes all but the last character, then that one.
        cut = (se < offsets[sr + 1]) & (se - ss > 1) if len(ss) else np.zeros(0, bool)
        attached = np.zeros(len(ss), bool)
        if len(ss):
            at = np.searchsorted(ws, se)
            hit = at < len(ws)
            attached[hit] = (ws[at[hit]] == se[hit]) & (cps[se[hit]] == 32) if len(ws) else False
        cut &= ~attached
        extra = se[cut] - 1
        se = se.copy()
        se[cut] -= 1
        starts = np.concatenate([ws, ss, extra])
        ends = np.concatenate([we, se, extra + 1])
        row = np.concatenate([wr, sr, sr[cut]])
        word = np.concatenate([np.ones(len(ws), bool), np.zeros(len(ss) + len(extra), bool)])
        order = np.argsort(starts, kind="stable")
        starts, ends, row, word = starts[order], ends[order], row[order], word[order]
        h = span_hash(char_mix()[clip(cps)], starts, ends)
        uniq, first, inv = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) > CACHE:
            self.known.clear()
        new = [k for k, x in enumerate(uniq.tolist()) if x not in self.known]
        if new:
            raw = cps.tobytes()
            texts = [raw[4 * a : 4 * b].decode("utf-32-le", "surrogatepass") for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
            for k, t in zip(new, texts):
                self.known[int(uniq[k])] = self.size(t)
        size = np.fromiter((self.known[x] for x in uniq.tolist()), np.int64, len(uniq))
        return cps, offsets, starts, ends, row, word, size[inv] if len(uniq) else np.zeros(0, np.int64)

    def count(self, col: pa.Array) -> np.ndarray:
        _, offsets, _, _, row, _, tokens = self.stretches(col)
        return np.bincount(row, weights=tokens, minlength=len(offsets) - 1).astype(np.int64) if len(row) else np.zeros(len(offsets) - 1, np.int64)


def count_tokens(df: DataFrame, keep: list[str], text: str, out: str = "tokens", tokenizer: str = TOKENIZER) -> DataFrame:
    """The columns `keep` of df and the number of tokens of each whole text; null and empty texts have none."""
    src = df.select(*keep, F.col(text).cast("string").alias("_text"))

    def run(batches):
        c = Counter(tokenizer)
        for batch in batches:
            for part in chunks(batch, "_text", 1 << 21):
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(c.count(part.columns[-1]))], names=[*keep, out])

    fields = ", ".join(f"`{c}` {t}" for c, t in src.dtypes[:-1])
    return src.mapInArrow(run, f"{fields}, `{out}` BIGINT")
