"""BPE encoding and decoding with the vocabulary and merges of a tokenizer file.

Words are merged many at a time. Every pair that a merge exists for is mapped to all its positions in the words of a
batch of the partition; the active ranks are applied in ascending order, each at its positions from the left, and the
lists of the pairs that arise beside a merge are updated. A pair that arises with a lower rank than the one in hand goes
first, so every word ends as it would alone.

Special strings, normalisation and the cut into words are those of the file. Its cut drops white space, so parts of a
text between white space are independent: they are encoded once and remembered, in lower case. The distinct parts of plain
texts are looked up once for a batch. Texts with characters that normalisation may change across parts, or with special
strings, are normalised and cut as a whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from seasonlens.llm.arrow import pieces as small_batches
from seasonlens.llm.plain_words import joined, marks_cut_off, numbered, of_letters, plain, without_mark

#: bytes of parts and their ids that a Python worker remembers, in two generations
BYTES_KEPT = 48 << 20
#: what an entry takes besides its characters and ids
ENTRY = 150


class Merges:
    """The merges of a vocabulary, as pairs of ids."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        self.size = max(vocab.values(), default=0) + 1
        self.rank_of: dict[int, int] = {}
        self.pairs: list[tuple[int, int, int]] = []
        for left, right in merges:
            a, b = vocab[left], vocab[right]
            self.rank_of[a * self.size + b] = len(self.pairs)
            self.pairs.append((a, b, vocab[left + right]))
        keys = np.fromiter(self.rank_of, dtype=np.int64, count=len(self.rank_of))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.key_ranks = np.fromiter(self.rank_of.values(), dtype=np.int64, count=len(keys))[order]

    def symbols(self, word: str) -> list[int]:
        """Ids of a word's characters, the last one with the mark of a word's end; unknown ones are left out."""
        found = map(self.vocab.get, [*word[:-1], word[-1] + self.suffix])
        return [i for i in found if i is not None]

    def places(self, symbol: np.ndarray, after: np.ndarray) -> dict[int, list[int]]:
        """By rank, the positions of each pair that has one, in ascending order."""
        at = np.flatnonzero(after >= 0)
        if not len(at) or not len(self.keys):
            return {}
        pair = symbol[at] * self.size + symbol[at + 1]
        near = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        has = self.keys[near] == pair
        at, rank = at[has], self.key_ranks[near[has]]
        order = np.argsort(rank, kind="stable")
        ranks, first = np.unique(rank[order], return_index=True)
        return {r: part.tolist() for r, part in zip(ranks.tolist(), np.split(at[order], first[1:]))}

    def __call__(self, words: list[str]) -> list[list[int]]:
        """Ids of every word (none is empty)."""
        symbol: list[int] = []
        bounds = [0]
        for word in words:
            symbol += self.symbols(word)
            bounds.append(len(symbol))
        after = list(range(1, len(symbol) + 1))
        before = list(range(-1, len(symbol) - 1))
        for low, high in zip(bounds, bounds[1:]):
            if low < high:
                before[low] = after[high - 1] = -1
        places = self.places(np.array(symbol, dtype=np.int64), np.array(after, dtype=np.int64))
        size, rank_of = self.size, self.rank_of.get
        active = list(places)
        heapify(active)
        while active:
            rank = heappop(active)
            left, right, joined = self.pairs[rank]
            waiting = places.pop(rank)
            waiting.sort()
            lowest = rank
            for done, at in enumerate(waiting):
                if lowest < rank:
                    places.setdefault(rank, []).extend(waiting[done:])
                    heappush(active, rank)
                    break
                gone = after[at]
                if symbol[at] != left or gone < 0 or symbol[gone] != right:
                    continue  # an earlier merge has taken part of the pair
                after[at] = following = after[gone]
                symbol[at], symbol[gone] = joined, -1
                if following >= 0:
                    before[following] = at
                    found = rank_of(joined * size + symbol[following])
                    if found is not None:
                        if found in places:
                            places[found].append(at)
                        else:
                            places[found] = [at]
                            heappush(active, found)
                            lowest = min(lowest, found)
                previous = before[at]
                if previous >= 0:
                    found = rank_of(symbol[previous] * size + joined)
                    if found is not None:
                        if found in places:
                            places[found].append(previous)
                        else:
                            places[found] = [previous]
                            heappush(active, found)
                            lowest = min(lowest, found)
        return [[i for i in symbol[low:high] if i >= 0] for low, high in zip(bounds, bounds[1:])]


class Memory:
    """Ids (as 32-bit little-endian bytes) of parts of texts, in two generations of bounded size."""

    def __init__(self, limit: int = BYTES_KEPT):
        self.limit, self.held = limit // 2, 0
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def renew(self) -> None:
        """Forget the older generation if the newer one is full."""
        if self.held > self.limit:
            self.known, self.older, self.held = {}, self.known, 0

    def add(self, part: str, ids: bytes) -> None:
        self.known[part] = ids
        self.held += len(part) + len(ids) + ENTRY

    def missing(self, parts: Iterable[str]) -> list[str]:
        """Which of the parts have to be learned; those of the older generation are taken over."""
        new = []
        for part in set(parts).difference(self.known):
            if part in self.older:
                self.add(part, self.older[part])
            else:
                new.append(part)
        return new


class Bpe:
    """Ids of texts as the tokenizers library gives them without special tokens added."""

    def __init__(self, path: str, limit: int = BYTES_KEPT):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, added = spec["model"], spec["added_tokens"]
        other = [name for name in ("unk_token", "continuing_subword_prefix", "dropout", "byte_fallback", "ignore_merges") if model.get(name)]
        if model["type"] != "BPE" or other or spec.get("decoder") or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"{path} uses settings that are not supported: {other}")
        self.file = Tokenizer.from_file(path)
        merges = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.merge = Merges(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.special = {token["content"]: token["id"] for token in added}
        self.splits = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        # words of letters are remembered as words only
        self.parts, self.words = Memory(limit // 4), Memory(limit)
        self.marks = marks_cut_off(lambda text: [word for word, _ in self.cut(text)])

    def cut(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        return self.file.pre_tokenizer.pre_tokenize_str(text)

    def learn(self, words: Iterable[str]) -> None:
        new = self.words.missing(words)
        for word, ids in zip(new, self.merge(new)):
            self.words.add(word, np.array(ids, dtype="<u4").tobytes())

    def learn_parts(self, parts: list[str]) -> None:
        """Cut the parts, which normalisation leaves as they are, into words and merge all of these together."""
        new = self.parts.missing(parts)
        if not new:
            return
        words = self.cut(" ".join(new))
        self.learn(word for word, _ in words)
        ids = self.words.known
        at, end, last = 0, 0, len(words)
        for part in new:
            end += len(part)
            found = []
            while at < last and words[at][1][0] < end:
                found.append(ids[words[at][0]])
                at += 1
            end += 1
            self.parts.add(part, b"".join(found))

    def whole(self, text: str) -> bytes:
        """Ids of a text that is normalised as a whole, between its special strings."""
        out, at = [], 0
        bounds = [(m.start(), m.end()) for m in self.splits.finditer(text)]
        for low, high in [*bounds, (len(text), len(text))]:
            words = [word for word, _ in self.cut(self.file.normalizer.normalize_str(text[at:low]))] if low > at else []
            self.learn(words)
            out += map(self.words.known.__getitem__, words)
            if high > low:
                out.append(np.array([self.special[text[low:high]]], dtype="<u4").tobytes())
            at = high
        return b"".join(out)

    def of_words(self, words: list[str]) -> list[bytes]:
        """Ids of every word of plain texts; a mark that is cut off is remembered apart from the letters before it."""
        letters = [without_mark(word, self.marks) for word in words]
        alone = [bool(self.marks) and of_letters(part) for part in letters]
        self.learn(part for part, is_word in zip(letters, alone) if is_word)
        self.learn_parts([*self.marks, *(part for part, is_word in zip(letters, alone) if not is_word)])
        known, parts = self.words.known, self.parts.known
        return [
            (known if is_word else parts)[part] + (parts[word[-1]] if len(part) < len(word) else b"")
            for part, word, is_word in zip(letters, words, alone)
        ]

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """Ids of every text, none of them null, as 32-bit numbers."""
        self.parts.renew()
        self.words.renew()
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        chosen = plain(texts, self.special)
        words, numbers, bounds = numbered(texts.filter(pa.array(chosen)))
        found = iter(joined(self.of_words(words), numbers, bounds))
        rest = map(self.whole, texts.filter(pa.array(~chosen)).to_pylist())
        return [next(found) if easy else np.frombuffer(next(rest), dtype="<u4") for easy in chosen.tolist()]


@lru_cache(maxsize=1)
def names_of(path: str) -> pa.Array:
    """The pieces and special strings of a tokenizer file by their ids."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    names = {i: name for name, i in spec["model"]["vocab"].items()} | {token["id"]: token["content"] for token in spec["added_tokens"]}
    return pa.array([names.get(i) for i in range(max(names, default=-1) + 1)], pa.string())


def decode(names: pa.Array, ids: pa.Array) -> pa.Array:
    """The pieces (by their ids) of every list of ids, joined by spaces; ids without a piece are left out, a null list is null."""
    ids = ids.cast(pa.list_(pa.int64()))
    values = pc.if_else(pc.and_(pc.greater_equal(ids.flatten(), 0), pc.less(ids.flatten(), len(names))), ids.flatten(), None)
    lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int64())
    lists = pa.LargeListArray.from_arrays(offsets, names.take(values))
    joined = pc.binary_join(pc.fill_null(lists, pa.scalar([], lists.type)) if lists.null_count else lists, " ")
    if values.null_count or names.null_count:
        joined = pa.array([" ".join(x for x in found if x is not None) for found in lists.to_pylist()], pa.string())
    return pc.if_else(ids.is_valid(), joined, None)


@lru_cache(maxsize=1)
def tokenizer_of(path: str) -> Bpe:
    """The tokenizer of a Python worker, which later tasks of the worker find with its words."""
    return Bpe(path)


def encoded(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ids (array of int) of every whole text.

    An empty, blank or null text has no ids. Repeated rows are encoded each; other columns are ignored, an empty
    table gives no rows.
    """
    kind = docs.schema[id_col]
    schema = T.StructType([T.StructField(id_col, kind.dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]):
        out, tokenizer = to_arrow_schema(schema), tokenizer_of(tokenizer_path)
        for batch in small_batches(batches):
            found = tokenizer.encode(pc.fill_null(batch.column(1), ""))
            offsets = np.concatenate([[0], np.cumsum([len(ids) for ids in found])])
            ids = np.concatenate([np.zeros(0, dtype=np.int32), *found]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(out.field(0).type), lists.cast(out.field(1).type)], schema=out)

    read = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string").alias("__text"))
    return read.mapInArrow(run, schema)


def decoded(rows: DataFrame, tokenizer_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids: the pieces of the vocabulary, joined by spaces.

    No ids give an empty text, a null list gives null, and ids beyond the vocabulary are left out. A column already
    named ``out_col`` is replaced.
    """
    kept = [name for name in rows.columns if name != out_col]
    schema = T.StructType([rows.schema[name] for name in kept] + [T.StructField(out_col, T.StringType())])
    at = kept.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]):
        out, names = to_arrow_schema(schema), names_of(tokenizer_path)
        for batch in small_batches(batches):
            columns = [batch.column(i).cast(out.field(i).type) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, decode(names, batch.column(at)).cast(out.field(len(kept)).type)], schema=out)

    return rows.select(*(F.col(f"`{name}`") for name in kept)).mapInArrow(run, schema)
