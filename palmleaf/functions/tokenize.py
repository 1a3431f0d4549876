"""Public tokenizers as Arrow UDFs over columns: the libraries and vocabulary files are parameters, loaded per worker."""

from __future__ import annotations

import base64
import functools
import itertools
import os
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the public pre-tokenizer pattern of byte-level BPE vocabularies given as ranks.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DIRECTORY = "/opt/tokenizers"
# Fixed value: the code points of Unicode's White_Space property.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The pattern never joins white space to what stands before it: the ids of a text are those of its stretches in turn.
STRETCH = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
# Nor does it join letters or digits to a mark or to white space after them.
RUN = re.compile(r"[\W_]*[^\W_]+|[\W_]+")
GROUP = 1 << 16  # characters that are tokens at a time; a token takes some hundred bytes
KNOWN, SHORT = 1 << 17, 64  # stretches remembered a worker, and the characters of the longest of them
FILES = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken", "word_bpe_49k.json", "piece_bpe_32k.model")


@functools.cache
def _tiktoken(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a worker has one core
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


@functools.cache
def encoder(path: str):
    """texts -> lists of ids, by the kind of file."""
    if path.endswith(".json"):
        t = _tokenizer(path)
        return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    if path.endswith(".tiktoken"):
        e = _tiktoken(path)
        return lambda texts: [e.encode_ordinary(x) for x in texts]
    import sentencepiece

    s = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: s.encode(texts, num_threads=1)


def _check(path: str) -> None:
    if not os.path.exists(path):
        raise FileNotFoundError(path)


def token_ids(path: str):
    """A function of a text column to its token ids; null stays null."""
    _check(path)

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else i for t, i in zip(texts, encoder(path)([t or "" for t in texts]))])

    return ids


def token_count(path: str):
    """A function of a text column to its number of tokens; only the count goes back to the JVM."""
    _check(path)

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([len(i) for i in encoder(path)([t or "" for t in texts])])

    return count


@functools.cache
def decoder(path: str):
    """Lists of ids -> texts, by the kind of file."""
    if path.endswith(".json"):
        t = _tokenizer(path)
        return lambda ids: t.decode_batch(ids, skip_special_tokens=False)
    if path.endswith(".tiktoken"):
        return lambda ids: [_tiktoken(path).decode_bytes(i).decode("utf-8", "surrogatepass") for i in ids]
    import sentencepiece

    s = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda ids: [s.decode(i) for i in ids]


def _by_stretches(path: str) -> bool:
    """Whether the ids of a text are those of its stretches: byte-level BPE that neither changes nor adds text."""
    if not path.endswith(".json"):
        return path.endswith(".tiktoken")
    from tokenizers import decoders, models, pre_tokenizers

    t = _tokenizer(path)
    cut = t.pre_tokenizer
    by_bytes = isinstance(t.model, models.BPE) and not t.model.dropout and isinstance(t.decoder, decoders.ByteLevel) and isinstance(cut, pre_tokenizers.ByteLevel) and cut.use_regex and not cut.add_prefix_space
    whole = t.normalizer is None and t.post_processor is None and t.truncation is None and t.padding is None
    return by_bytes and whole and all(a.special for a in t.get_added_tokens_decoder().values())


def _groups(texts: Iterable[str]) -> Iterator[list[str]]:
    """The texts in order, in lists of about GROUP characters: one text at least."""
    group, n = [], 0
    for t in texts:
        if group and n + len(t) > GROUP:
            yield group
            group, n = [], 0
        group.append(t)
        n += len(t)
    if group:
        yield group


def _cut(pattern: re.Pattern, text: str) -> Iterable[str]:
    """All matches; of a large text one by one."""
    return pattern.findall(text) if len(text) <= GROUP else map(re.Match.group, pattern.finditer(text))


class RoundTrips:
    """Which texts come back from their ids, with the ids of one group of texts at a time in memory.

    A text whose stretches all come back does so too, so each distinct stretch is encoded once as long as it is
    remembered. One with a stretch that does not is encoded as a whole, as are all texts of other tokenizers.
    """

    def __init__(self, path: str):
        self.encode, self.decode, self.by_stretches = encoder(path), decoder(path), _by_stretches(path)
        self.known: set[str] = set()

    def whole(self, texts: Iterable[str]) -> Iterator[bool]:
        for group in _groups(texts):
            yield from (t == b for t, b in zip(group, self.decode(self.encode(group))))

    def failing(self, texts: list[str]) -> set[str]:
        """The stretches of the texts that do not come back; of one larger than a group, the runs are tried."""
        stretches = itertools.chain.from_iterable(_cut(STRETCH, t) for t in texts)
        bad: set[str] = set()
        while some := set(itertools.islice(stretches, GROUP)):
            new = list(some - self.known - bad)
            bad.update(x for x in new if len(x) > GROUP and not all(self.whole(_cut(RUN, x))))
            new = [x for x in new if len(x) <= GROUP]
            bad.update(x for x, same in zip(new, self.whole(new)) if not same)
            if len(self.known) + len(new) > KNOWN:
                self.known.clear()
            self.known.update(x for x in new if len(x) <= SHORT and x not in bad)
        return bad

    def check(self, texts: list[str]) -> Iterator[bool]:
        if not self.by_stretches:
            yield from self.whole(texts)
            return
        for group in _groups(texts):
            bad = self.failing(group)
            for t in group:
                yield not bad or bad.isdisjoint(_cut(STRETCH, t)) or next(self.whole([t]))


@functools.cache
def round_trips(path: str) -> RoundTrips:
    return RoundTrips(path)


def comes_back(path: str):
    """A function of a text column to whether its ids decode to the same text; null stays null."""
    _check(path)

    @F.pandas_udf("boolean")
    def same(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else s for t, s in zip(texts, round_trips(path).check([t or "" for t in texts]))])

    return same


def public_tokenizers(directory: str = DIRECTORY) -> dict:
    """Name -> token counter, failing for a file that is not there only when it is used."""

    def make(name: str):
        def count(c: Column) -> Column:
            return token_count(f"{directory}/{name}")(c)

        return count

    return {name: make(name) for name in FILES}
