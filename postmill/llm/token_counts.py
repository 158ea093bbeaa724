"""Token counts by prefix dynamic programming.

``token_table`` gives each document the table of its prefixes: ``steps`` holds one signed
little-endian 16-bit number per character, by which the count of the prefix changes when the
character is added; running sums are the exact counts the library would give for the cut text.
``counts_at`` and ``fitting`` answer truncation and budget questions from the table.

Null text counts as empty (no characters, no tokens, an empty table). A null ``doc_id`` is kept.
Repeated rows give repeated rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from postmill.llm.bpe import prefix_table
from postmill.llm.common import map_texts, texts_of


def token_table(docs: DataFrame, vocabulary: str, limit: int = 512, keep_steps: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_tokens, fit_chars (the longest prefix of at most ``limit`` tokens), steps."""

    def work(batch, texts):
        tables = prefix_table(vocabulary).steps(texts)
        totals, fits = [], []
        for table in tables:
            counts = np.cumsum(table, dtype=np.int32)
            totals.append(int(counts[-1]) if len(counts) else 0)
            within = np.flatnonzero(counts <= limit)
            fits.append(int(within[-1]) + 1 if len(within) else 0)
        out = {
            "doc_id": batch.column("doc_id").to_pylist(),
            "n_bytes": [len(t.encode()) for t in texts],
            "n_tokens": totals,
            "fit_chars": fits,
        }
        if keep_steps:
            out["steps"] = [t.astype("<i2").tobytes() for t in tables]
        return out

    schema = "doc_id long, n_bytes long, n_tokens long, fit_chars long" + ", steps binary" * keep_steps
    return map_texts(texts_of(docs), work, schema)


def counts_at(steps: str | Column, n_chars: str | Column) -> Column:
    """Tokens of the first ``n_chars`` characters; beyond the end, of the whole text."""

    @pandas_udf("long")
    def at(tables: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series(
            [int(np.frombuffer(t, "<i2")[: max(0, int(n))].sum(dtype=np.int64)) for t, n in zip(tables, ends, strict=True)]
        )

    return at(steps, n_chars)


def fitting(steps: str | Column, budget: str | Column) -> Column:
    """Characters of the longest prefix that takes at most ``budget`` tokens."""

    @pandas_udf("long")
    def fit(tables: pd.Series, budgets: pd.Series) -> pd.Series:
        out = []
        for t, b in zip(tables, budgets, strict=True):
            within = np.flatnonzero(np.cumsum(np.frombuffer(t, "<i2"), dtype=np.int64) <= int(b))
            out.append(int(within[-1]) + 1 if len(within) else 0)
        return pd.Series(out, dtype="int64")

    return fit(steps, budget)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars; nothing is shuffled."""
    return token_table(docs, vocabulary, limit, keep_steps=False).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fit_chars"
    )
