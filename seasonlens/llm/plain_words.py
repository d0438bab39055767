"""Words of plain texts by number, so that each distinct word of a batch is looked at once.

A plain text has no characters that normalisation may join with others, change in number, or take for white space beyond
that of ASCII. Its words are what stands between white space, in lower case.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: a text with any of these is not plain
NOT_PLAIN = "[\x00-\x08\x0e-\x1f\x7f-\xa0\u0130\u0300-\U0010ffff]"
#: marks that may follow a word
MARKS = ".,;:!?"
#: rows of a batch whose distinct words are looked up together; their words are no Python objects, so they may be more
ROWS_AT_ONCE = 1024


def plain(texts: pa.Array, special: Iterable[str] = ()) -> np.ndarray:
    """Which texts are plain and hold none of the ``special`` strings."""
    found = pc.invert(pc.match_substring_regex(texts, NOT_PLAIN))
    for text in special:
        found = pc.and_(found, pc.invert(pc.match_substring(texts, text)))
    return found.to_numpy(zero_copy_only=False)


def numbered(texts: pa.Array) -> tuple[list[str], pa.Array, np.ndarray]:
    """The words of plain texts, the number of the word at every place, and where each text's places begin.

    Words that differ in case only come more than once. White space at the ends of a text gives an empty word.
    """
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
    words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    return [word.lower() for word in words], coded.indices, bounds.astype(np.int64)


def joined(ids: list[bytes], numbers: pa.Array, bounds: np.ndarray) -> list[np.ndarray]:
    """Ids of every text, from the little-endian 32-bit ids of each distinct word."""
    sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
    ends = np.concatenate([[0], np.cumsum(sizes)])
    lists = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), dtype="<u4")))
    values = lists.take(numbers).flatten().to_numpy()
    places = np.concatenate([[0], np.cumsum(sizes[numbers.to_numpy()])])
    return np.split(values, places[bounds[1:-1]]) if len(bounds) > 1 else []


def marks_cut_off(cut: Callable[[str], list[str]]) -> str:
    """The marks that ``cut``, which cuts texts into words, sets apart from a word before them."""
    return "".join(mark for mark in MARKS if cut("ab") == ["ab"] and cut("ab" + mark) == ["ab", *cut(mark)])


def of_letters(word: str) -> bool:
    """Whether a word is of ASCII letters alone."""
    return word.isascii() and word.isalpha()


def without_mark(word: str, marks: str) -> str:
    """The word of letters that only a mark follows, or else the word as it is."""
    return word[:-1] if word[-1:] in marks and of_letters(word[:-1]) else word
