"""Token counts of whole texts: Arrow functions that return lengths only.

Each Arrow batch is cut into slices of about ``slice_bytes`` of text, so a few very
long documents cannot make a slice large; within a slice texts are cut at
white space where the tokenizer drops it (a safe boundary, see ``tokens``) and one
library call encodes what the slice's words add.  No text is truncated or padded and no
special token is added.

Defined cases: null text is empty (0 bytes, 0 tokens); repeated rows are counted
each; a null id stays null; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import byte_slices, tidy, utf8


def counter(path: str, slice_bytes: int, cache_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from strata.llm.tokens import encoder
        enc = encoder(path, cache_words)
        for batch in batches:
            for part in byte_slices(batch, "text", slice_bytes):
                texts = utf8(part, "text")
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.fromiter(map(len, texts), np.int64, len(texts))),
                     pa.array(np.fromiter((len(i) // enc.dtype.itemsize for i in enc.ids(texts)), np.int64, len(texts)))],
                    names=["doc_id", "n_bytes", "n_tokens"])

    return tidy(run)


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 slice_bytes: int = 1 << 20, cache_words: int = 300_000) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) per row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(counter(tokenizer_path, slice_bytes, cache_words),
                           "doc_id long, n_bytes long, n_tokens long")
