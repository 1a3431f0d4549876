"""Text and JSON reports from one-row frames."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame


def one_row(df: DataFrame) -> dict:
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("a report is one row")
    return rows[0].asDict(recursive=True)


def as_text(df: DataFrame, title: str) -> str:
    row = one_row(df)
    width = max(map(len, row), default=0)
    body = [f"{k.replace('_', ' ').capitalize():<{width}} : {f'{v:.2f}' if isinstance(v, float) else v}" for k, v in row.items()]
    return "\n".join([title, "=" * len(title), *body, ""])


def as_json(df: DataFrame) -> str:
    return json.dumps(one_row(df), ensure_ascii=False, indent=2, default=str)
