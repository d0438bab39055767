"""Substring deduplication by looking up windows among those of the documents before.

The corpus in (doc_id, place) order is cut into blocks by anchor: a block holds the index of all windows around one anchor,
from every document. Every window is looked up by its hash; those that an earlier place has indexed are duplicates, and
the runs of words that they cover are the duplicate spans. There is no Lempel-Ziv parse: no longest match, no reference
position and no factor boundary.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from seasonlens.llm.repeats import (
    Windows, binary_parts, covered, in_order, repeated_rows, repeated_windows, run_hashes, spans_of, texts_of, with_starts,
)

WORDS = 20
GRAM = 5


def _words(data: bytes) -> np.ndarray:
    words = data.split()
    return np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


WINDOWS = Windows(WORDS, GRAM, _words)


def _describe(data: bytes, first: list[int], number: list[int]) -> list[bytes]:
    """The hashes of the windows of each anchor."""
    hashes = run_hashes(_words(data), WORDS).tobytes()
    return [hashes[8 * at:8 * (at + n)] for at, n in zip(first, number)]


def _later(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of each row that an earlier row of its group, or an earlier window of the row, has indexed."""
    data, ends = binary_parts(batch.column(4))
    numbers, anchor = np.diff(ends) // 8, batch.column(0).to_numpy()
    group = np.repeat(np.cumsum(np.concatenate([[False], anchor[1:] != anchor[:-1]])), numbers)
    order, same = in_order(data.view(np.uint64))
    picked = np.zeros(len(group), dtype=bool)
    picked[order[1:][same & (group[order[1:]] == group[order[:-1]])]] = True
    # rows of the same text, repeated, index their windows together: neither is before the other
    rows = np.where(repeated_rows(batch), 0, np.arange(batch.num_rows))
    return np.maximum.accumulate(rows), numbers, picked


def _not_first(where: Column, first: Column) -> Column:
    return ~where.eqNullSafe(first)


def _cleaned(with_text: bool):
    def fn(data: bytes, first: np.ndarray, count: np.ndarray) -> tuple:
        words = data.split()
        gone = covered(first, count, WORDS, len(words))
        kept = b" ".join(compress(words, (~gone).tolist()))
        spans = ",".join(f"{a}:{b}" for a, b in spans_of(gone))
        found = (len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), spans)
        return (*found, kept.decode("utf-8", "replace")) if with_text else found

    return fn


def remove_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256, spans and, unless turned off, kept.

    Words are what stands between ASCII white space, unchanged. Every word goes that is in a window of 20 words whose
    words also start earlier: in a document with a smaller id, or further left in the same one; windows are judged
    on the input. spans are the removed runs (``start:end`` in words, comma-joined), kept the other words joined by
    spaces. A null text has no words; a null id is smaller than any other. Texts that share an id are ordered by a
    hash of the text; equal rows are the same document and get the same result. Other columns are ignored. The search
    runs when this is called; windows are compared by 64-bit hashes within a group of equal 64-bit anchors.
    """
    texts = texts_of(docs, id_col, text_col)
    found = repeated_windows(texts, WINDOWS, _describe, _later, _not_first)
    made = [("n_words", pa.int64(), "long"), ("n_removed", pa.int64(), "long"), ("kept_sha256", pa.string(), "string"), ("spans", pa.string(), "string")]
    if with_text:
        made.append(("kept", pa.string(), "string"))
    return with_starts(texts, found, _cleaned(with_text), made).select(F.col("id").alias(id_col), *[name for name, _, _ in made])
