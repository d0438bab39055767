"""Removal of byte strings that occur more than once, by a hash-compared suffix sort.

The suffixes that can share 200 bytes with another are those around anchors that occur again. Of each group, the
suffixes are sorted by the polynomial hash of their first 200 bytes, from hashes of the prefixes, so that comparing two
takes no longer for long strings. Neighbours with equal hashes are compared byte by byte before anything is removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonlens.llm.repeats import (
    Windows, binary_parts, covered, in_order, repeated_rows, repeated_windows, run_hashes, spans_of, texts_of, with_starts,
)

BYTES = 200
GRAM = 64


def _bytes(data: bytes) -> np.ndarray:
    # 251 is odd and no byte maps to 0, so that runs of one byte have different hashes by length
    return (np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)


WINDOWS = Windows(BYTES, GRAM, _bytes)


def _describe(data: bytes, first: list[int], number: list[int]) -> list[bytes]:
    """The bytes that the windows of each anchor cover."""
    return [data[at:at + n + BYTES - 1] for at, n in zip(first, number)]


def _again(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of each row that any other window of its group equals.

    Rows that send the same bytes repeat each other as a whole; different bytes are compared once each. Equal windows have equal
    anchors, so those of several groups are compared in one go.
    """
    kinds = batch.column(4).dictionary_encode()
    of = kinds.indices.to_numpy().astype(np.int64)
    data, ends = binary_parts(kinds.dictionary)
    numbers = np.diff(ends) - (BYTES - 1)
    picked = _again_by_bytes(data, ends[:-1], numbers)
    # a repeated row is the same document again: its windows do not repeat each other
    times = np.bincount(of[~repeated_rows(batch)], minlength=len(numbers))
    return of, numbers, picked | np.repeat(times > 1, numbers)


def _again_by_bytes(data: np.ndarray, begins: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Which windows equal another one; the ``numbers`` windows of each string begin at ``begins`` and the places after it."""
    at = np.arange(int(numbers.sum())) + np.repeat(begins - (np.cumsum(numbers) - numbers), numbers)
    order, same = in_order(run_hashes(_bytes(data), BYTES)[at])
    picked, after = np.zeros(len(at), dtype=bool), np.zeros(len(at), dtype=np.int64)
    after[order[:-1][same]] = order[1:][same]
    one = np.flatnonzero(after)
    if not len(one):
        return picked
    # windows side by side, whose neighbours in the order of hashes lie equally far away, are compared byte by byte in one go
    other = after[one]
    place, shift = at[one], at[other] - at[one]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 1) | (np.diff(shift) != 0)]))
    lengths = np.diff(np.append(first, len(one))) + (BYTES - 1)
    places = np.arange(int(lengths.sum())) + np.repeat(place[first] - (np.cumsum(lengths) - lengths), lengths)
    differ = np.zeros(len(places) + 1, dtype=np.int64)
    np.cumsum(data[places] != data[places + np.repeat(shift[first], lengths)], out=differ[1:])
    starts = np.arange(len(one)) + np.repeat(np.arange(len(first)) * (BYTES - 1), lengths - (BYTES - 1))
    equal = differ[starts + BYTES] == differ[starts]
    picked[one[equal]] = picked[other[equal]] = True
    return picked


def _all(where: Column, first: Column) -> Column:
    return F.lit(True)


def _cleaned(with_bytes: bool):
    def fn(data: bytes, first: np.ndarray, count: np.ndarray) -> tuple:
        gone = covered(first, count, BYTES, len(data))
        kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
        found = (len(data), int(gone.sum()), len(spans_of(gone)), hashlib.sha256(kept).hexdigest())
        return (*found, kept) if with_bytes else found

    return fn


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_bytes: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256 and, unless turned off, kept (binary).

    Texts are UTF-8 bytes. Every byte goes that is in a string of 200 bytes which starts anywhere else as well, in
    any document, the same included; strings are judged on the input and never cross documents. A null text is
    empty. Null ids are ids like any other. Rows that repeat id and text are one document that comes again, and do
    not repeat each other; texts that share an id are told apart. Other columns are ignored. The search runs when
    this is called.
    """
    texts = texts_of(docs, id_col, text_col)
    found = repeated_windows(texts, WINDOWS, _describe, _again, _all)
    made = [("n_bytes", pa.int64(), "long"), ("n_removed", pa.int64(), "long"), ("n_spans", pa.int64(), "long"), ("kept_sha256", pa.string(), "string")]
    if with_bytes:
        made.append(("kept", pa.binary(), "binary"))
    return with_starts(texts, found, _cleaned(with_bytes), made).select(F.col("id").alias(id_col), *[name for name, _, _ in made])
