"""Token counts of a model's tokenizer, for budgets."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that a worker hands to the tokenizer together.
BATCH = 1000


def token_count(body: Column, tokenizer_path: str) -> Column:
    """Tokens of a text without special tokens, as a long; null counts as empty.

    ``tokenizer_path`` names a tokenizer file that every executor can open; a
    worker loads it once.
    """

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        known = Tokenizer.from_file(tokenizer_path)
        known.encode_special_tokens = True
        for series in batches:
            texts, sizes = series.fillna("").tolist(), []
            for at in range(0, len(texts), BATCH):
                sizes += [len(e.ids) for e in known.encode_batch_fast(texts[at : at + BATCH], add_special_tokens=False)]
            yield pd.Series(sizes, dtype="int64")

    return count.asNondeterministic()(body)
