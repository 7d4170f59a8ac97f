"""Token counts: pieces are counted once per distinct pre-token and weighted by frequency."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lithos.llm._text import raw, sums, text_slices
from lithos.llm.word_pieces import WIDE_SLICE, WordPieces


def token_counts(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str | Column = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every whole text, as the tokenizers library counts under ``tokenizer``.

    In each bounded slice of documents the distinct pre-tokens are found, the pieces of each are
    counted once, and those counts are joined by dictionary index to the documents' pre-token
    frequencies and summed; no list of ids is made for a document. Nothing is shuffled, so no key
    or source can be hot, and a lost task is simply run again.

    Null and empty texts have 0 bytes and 0 tokens; repeated ids give a row each; a null id stays
    null; other columns are ignored; an empty table gives no rows. Special strings within a text
    count as the library's default has them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = WordPieces.of(tokenizer)
        for batch in batches:
            for part in text_slices(batch, limit=WIDE_SLICE):
                index, starts, ids = pieces.frequencies(part.column("text"))
                per_chunk = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                _, off = raw(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.diff(off)), pa.array(sums(per_chunk[index], starts))], ["id", "n_bytes", "n_tokens"])

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), (F.col(text_col) if isinstance(text_col, str) else text_col).alias("text"))
    return chosen.mapInArrow(run, "id long, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)
