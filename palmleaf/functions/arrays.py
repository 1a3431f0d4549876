"""Array functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palmleaf.functions.text import strip

MASKED = -100


def meanings(c: Column) -> Column:
    """The comma-separated parts, stripped, empty ones dropped."""
    return F.filter(F.transform(F.split(c, ",", -1), strip), lambda x: x != "")


def distinct_meanings(c: Column) -> Column:
    """Each part once, in the order first seen, joined."""
    return F.array_join(F.array_distinct(meanings(c)), ", ")


def has_duplicates(a: Column) -> Column:
    return F.size(a) != F.size(F.array_distinct(a))


def first(a: Column) -> Column:
    return F.get(a, 0)


def mask_prompt(full: Column, prompt_length: Column) -> Column:
    """Labels: the ids, with the prompt's places masked."""
    return F.transform(full, lambda x, i: F.when(i < prompt_length, F.lit(MASKED)).otherwise(x))


def drop_prompt(full: Column, prompt_length: Column) -> Column:
    """The ids after the prompt's places; none if the prompt is all there is."""
    return F.slice(full, prompt_length + 1, F.greatest(F.size(full) - prompt_length, F.lit(0)))


def ones(a: Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(a))


def truncate(a: Column, n: int) -> Column:
    return F.slice(a, 1, n)


def pad(a: Column, to: Column, value) -> Column:
    return F.concat(a, F.array_repeat(F.lit(value), F.greatest(to - F.size(a), F.lit(0))))


def code_points(c: Column) -> Column:
    """A deterministic tokenisation: one id per character."""
    chars = F.filter(F.split(c, "", -1), lambda x: x != "")
    return F.transform(chars, F.ascii)
