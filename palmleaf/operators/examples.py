"""Training examples: chat rendering, token ids, prompt masks, batch padding, token statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palmleaf.functions import arrays as A
from palmleaf.functions import text as X
from palmleaf.runtime import distributed_rank

# The marks of the chat format.
START, END, THINK = "<|im_start|>", "<|im_end|>", "<think>\n\n</think>\n\n"


def render_prompt(instruction: Column) -> Column:
    return F.concat(F.lit(f"{START}user\n"), instruction, F.lit(f"{END}\n{START}assistant\n"))


def render_full(instruction: Column, response: Column) -> Column:
    """A question and its answer; the empty thinking block is part of the answer."""
    after = F.element_at(F.split(response, "</think>", -1), -1)
    body = F.regexp_replace(F.when(response.contains("</think>"), after).otherwise(response), r"\A\n+", "")
    return F.concat(F.lit(f"{START}user\n"), instruction, F.lit(f"{END}\n{START}assistant\n{THINK}"), body, F.lit(f"{END}\n"))


def render_turns(messages: Column) -> Column:
    """Any number of turns (array of role and content); the thinking block only in the last answer."""
    n = F.size(messages)
    turn = F.transform(messages, lambda m, i: F.concat(F.lit(START), m["role"], F.lit("\n"), F.when((m["role"] == "assistant") & (i == n - 1), F.lit(THINK)).otherwise(F.lit("")), m["content"], F.lit(f"{END}\n")))
    return F.array_join(turn, "")


def examples(df: DataFrame, pos: str = "pos", limit: int = 256, tokenize: Callable[[Column], Column] = A.code_points) -> DataFrame:
    """(pos, input_ids, labels, attention_mask): rows with both texts; ids cut at the limit; the prompt masked."""
    x = df.select(pos, X.strip(F.col("instruction").cast("string")).alias("i"), X.strip(F.col("response").cast("string")).alias("r")).filter((F.col("i") != "") & (F.col("r") != ""))
    x = x.select(pos, A.truncate(tokenize(render_full(F.col("i"), F.col("r"))), limit).alias("input_ids"), A.truncate(tokenize(render_prompt(F.col("i"))), limit).alias("prompt"))
    return x.select(pos, "input_ids", A.mask_prompt(F.col("input_ids"), F.least(F.size("prompt"), F.size("input_ids"))).alias("labels"), A.ones(F.col("input_ids")).alias("attention_mask"))


def answers(df: DataFrame, pos: str = "pos", tokenize: Callable[[Column], Column] = A.code_points) -> DataFrame:
    """(pos, answer_ids): the ids of each whole example after those of its prompt."""
    x = df.select(pos, *(X.strip(F.col(c).cast("string")).alias(n) for c, n in (("instruction", "i"), ("response", "r")))).filter((F.col("i") != "") & (F.col("r") != ""))
    x = x.select(pos, tokenize(render_full(F.col("i"), F.col("r"))).alias("ids"), tokenize(render_prompt(F.col("i"))).alias("prompt"))
    return x.select(pos, A.drop_prompt(F.col("ids"), F.size("prompt")).alias("answer_ids"))


def pad_batches(df: DataFrame, pos: str = "pos", batch: int = 16, pad_id: int = 0) -> DataFrame:
    """Examples padded on the right to the longest of their batch; labels with the mask value. Every batch but the last
    has `batch` examples, in the order of pos; repeated positions follow one another."""
    x = distributed_rank(df, None, [F.col(pos).asc_nulls_first()], "batch_no").withColumn("batch_no", F.floor(F.col("batch_no") / batch).cast("long"))
    longest = x.groupBy("batch_no").agg(F.max(F.size("input_ids")).alias("longest"))
    y = x.join(longest, "batch_no")
    to = F.col("longest")
    return y.select(pos, "batch_no", A.pad(F.col("input_ids"), to, pad_id).alias("input_ids"), A.pad(F.col("labels"), to, A.MASKED).alias("labels"), A.pad(F.col("attention_mask"), to, 0).alias("attention_mask"))


TOKENIZERS: dict[str, Callable[[Column], Column]] = {
    "characters": F.length,
    "utf8_bytes": F.octet_length,
    "words": lambda c: F.when(X.strip(c) == "", F.lit(0)).otherwise(F.size(F.split(X.strip(c), X.WS + "+", -1))),
}


EFFICIENCY = "tokenizer STRING, status STRING, texts BIGINT, characters BIGINT, tokens BIGINT"


def token_efficiency(texts: DataFrame, column: str = "text", tokenizers: dict | None = None) -> DataFrame:
    """(tokenizer, status, texts, characters, tokens, average_tokens, characters_per_token): one row per tokenizer.

    All tokenizers share one pass over the texts. One that cannot be planned gets a FAILED row; if the pass itself fails,
    each tokenizer is given a pass of its own and those that fail then get the row. Runs at once; only sums come back.
    """
    tokenizers = TOKENIZERS if tokenizers is None else tokenizers
    c = F.col(column).cast("string")
    x = texts.filter(c.isNotNull())

    def sums(names):
        each = (F.coalesce(F.sum(tokenizers[n](c)), F.lit(0)).cast("long") for n in names)
        return x.agg(F.count(F.lit(1)).alias("texts"), F.coalesce(F.sum(F.length(c)), F.lit(0)).alias("characters"), *(t.alias(f"t_{k}") for k, t in enumerate(each)))

    def attempt(names):
        try:
            return list(sums(names).first())
        except Exception:  # noqa: BLE001 - any failure of a tokenizer is its result
            return None

    names = list(tokenizers)
    together = attempt(names)
    rows = []
    for k, n in enumerate(names):
        got = [*together[:2], together[2 + k]] if together else attempt([n])
        rows.append((n, "SUCCESS", *got) if got else (n, "FAILED", None, None, None))
    out = texts.sparkSession.createDataFrame(rows, EFFICIENCY)
    return out.select("*", F.try_divide(F.col("tokens").cast("double"), "texts").alias("average_tokens"), F.when(F.col("status") == "SUCCESS", F.coalesce(F.try_divide(F.col("characters").cast("double"), "tokens"), F.lit(0.0))).alias("characters_per_token"))


def best_tokenizer(efficiency: DataFrame) -> DataFrame:
    return efficiency.filter("status = 'SUCCESS'").orderBy("tokens", "tokenizer").limit(1)


def project_run(steps: Column, seconds: Column, records: Column, batch: Column, epochs: Column) -> Column:
    """Hours a whole run takes at the pace of a trial run."""
    return F.floor(records / batch) * epochs / (steps / seconds) / 3600
