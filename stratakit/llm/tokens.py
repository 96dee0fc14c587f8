"""Sizes of texts in tokens of a public tokenizer; the vocabulary file is a parameter and is read on each worker."""

from __future__ import annotations

import os
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Vocabulary used when none is named (a file for the ``tokenizers`` library).
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.encode_special_tokens = True
    return loaded


def count_tokens(texts: list[str], path: str = VOCABULARY) -> list[int]:
    return [len(e) for e in _tokenizer(path).encode_batch(texts, add_special_tokens=False)]


def token_count(text: Column, path: str = VOCABULARY) -> Column:
    """Tokens of the whole text; 0 for null and empty texts."""

    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        out: list[int] = []
        part: list[str] = []
        size = 0
        for t in texts.fillna(""):
            part.append(t)
            size += len(t)
            if size > 1_000_000:
                out += count_tokens(part, path)
                part, size = [], 0
        return pd.Series(out + (count_tokens(part, path) if part else []), dtype="int64")

    return count.asNondeterministic()(text)
