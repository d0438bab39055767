"""Packing of tokenized documents into sequences of fixed length.

Documents are tokenized once and cut into pieces of at most a sequence: full sequences first, then the rest. Pieces
are dealt to groups by a hash of their document; each group is packed alone by first-fit decreasing. A tournament tree
over the free room of the sequences finds the first that a piece fits into in logarithmic time.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonlens.llm.arrow import kept_by_worker
from seasonlens.llm.arrow import pieces as small_batches
from seasonlens.llm.plain_words import ROWS_AT_ONCE, joined, marks_cut_off, numbered, of_letters, plain, without_mark

LENGTH = 4096
END = 2
#: documents of a group on average, and pieces that are packed at a time at most
GROUP_DOCS = 8192
GROUP_PIECES = 65_536
#: words of a generation whose ids a Python worker remembers; it holds two
WORDS_KEPT = 250_000
#: places for the hashes of words that were met once, which are remembered when they are met again; a power of two
PLACES = 1 << 22
#: what the strings of special tokens begin with
SPECIAL = "<|"


class WordEncoder:
    """Ids of whole texts as little-endian 32-bit numbers, the same as the tokenizer gives for the text at once.

    The tokenizer lowers the case and never looks past white space, so words are remembered in lower case. The distinct
    words of plain texts are looked up once for a batch; a mark that the tokenizer cuts off is remembered apart from the word
    before it. A word is remembered from the second batch on that it is met in, as most are met once. New words that are letters go to the tokenizer's model one by one, others are encoded together and told apart
    by their offsets. Texts with characters that normalisation may change across words, or with the strings of special
    tokens, are encoded as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.marks = marks_cut_off(self.cut)
        #: whether the model gives for words of letters what the tokenizer does
        self.direct = all(self.tokenizer.encode(word, add_special_tokens=False).ids == self.of_model(word) for word in ("a", "the", "qzxjkvw"))
        #: words seen since the last change of generations, and those of the generation before
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: new words of the batch in hand
        self.learnt: dict[str, bytes] = {}
        self.met, self.places = bytearray(PLACES), 0

    def cut(self, text: str) -> list[str]:
        cutter = self.tokenizer.pre_tokenizer
        return [word for word, _ in cutter.pre_tokenize_str(text)] if cutter else [text]

    def of_model(self, word: str) -> list[int]:
        return [token.id for token in self.tokenizer.model.tokenize(word)]

    def learn(self, words: Iterable[str]) -> None:
        """Look up all the words, those of the older generation as they are; those met before are remembered for later batches."""
        rest, older = [], self.older.get
        self.learnt = learnt = {}
        for word in set(words).difference(self.known):
            ids = older(word)
            if ids is not None:
                self.known[word] = ids
            elif self.direct and of_letters(word):
                learnt[word] = np.array(self.of_model(word), dtype="<u4").tobytes()
            else:
                rest.append(word)
        if rest:
            learnt.update(self.told_apart(rest))
        for word, ids in learnt.items():
            at = hash(word) % PLACES
            if self.met[at]:
                self.known[word] = ids
            else:
                self.met[at] = 1
                self.places += 1

    def told_apart(self, rest: list[str]) -> Iterable[tuple[str, bytes]]:
        """Words and their ids, from one text of all of them."""
        found = self.tokenizer.encode(" ".join(rest), add_special_tokens=False)
        data = np.array(found.ids, dtype="<u4").tobytes()
        starts = np.cumsum([0] + [len(word) + 1 for word in rest[:-1]])
        first = np.searchsorted(np.array([at for at, _ in found.offsets]), starts) * 4
        ends = [*first[1:].tolist(), len(data)]
        return zip(rest, map(data.__getitem__, map(slice, first.tolist(), ends)))

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def renew(self) -> None:
        if len(self.known) > WORDS_KEPT:
            self.known, self.older = {}, self.known
        if self.places > PLACES // 2:
            self.met, self.places = bytearray(PLACES), 0

    def of_words(self, words: list[str]) -> list[bytes]:
        """Ids of every word of plain texts."""
        found = [*map(self.known.get, words)]
        new = [at for at, ids in enumerate(found) if ids is None]
        parts = [without_mark(words[at], self.marks) for at in new]
        self.learn([*parts, *self.marks])
        known, learnt = self.known, self.learnt
        marks = {mark: learnt[mark] if mark in learnt else known[mark] for mark in self.marks}
        for at, part in zip(new, parts):
            ids = learnt[part] if part in learnt else known[part]
            found[at] = ids if len(part) == len(words[at]) else ids + marks[words[at][-1]]
        self.learnt = {}
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text, none of them null."""
        self.renew()
        chosen = plain(texts, [SPECIAL])
        words, numbers, bounds = numbered(texts.filter(pa.array(chosen)))
        found = iter(joined(self.of_words(words), numbers, bounds))
        return [next(found).tobytes() if easy else self.whole(texts[at].as_py()) for at, easy in enumerate(chosen.tolist())]


@kept_by_worker
def encoder(path: str) -> WordEncoder:
    """The encoder of a Python worker, which later tasks of the worker find with its words."""
    return WordEncoder(path)


def cuts(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document of n ids."""
    whole = n // length * length
    found = [(at, length) for at in range(0, whole, length)]
    if n > whole:
        found.append((whole, n - whole))
    return found


def tokenized(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
              with_ids: bool = False) -> DataFrame:
    """The pieces of every document: id, start, length, ids_crc32, doc_tokens and, if asked for, ids."""
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([END], dtype="<u4").tobytes()

    def run(batches):
        for batch in small_batches(batches, ROWS_AT_ONCE, keep=encoder):
            rows, starts, lengths, sums, totals, ids = [], [], [], [], [], []
            for row, found in enumerate(encoder(tokenizer_path).encode(pc.fill_null(batch.column(1), ""))):
                data = found + end
                for start, size in cuts(len(data) // 4, length):
                    part = data[4 * start:4 * (start + size)]
                    rows.append(row)
                    starts.append(start)
                    lengths.append(size)
                    sums.append(zlib.crc32(part))
                    totals.append(len(data) // 4)
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
            columns = [batch.column(0).take(pa.array(rows, pa.int64()))] + [pa.array(c, pa.int64()) for c in (starts, lengths, sums, totals)]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, schema)


class Tournament:
    """Free room of sequences in order; finds the first one with enough of it."""

    def __init__(self, sequences: int, length: int):
        self.leaves = 1 << max(0, sequences - 1).bit_length()
        self.room = [length] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """The first sequence that has ``size`` left, and the room it had."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        had = room[at]
        room[at] = had - size
        found = at - self.leaves
        while at > 1:
            at //= 2
            most = max(room[2 * at], room[2 * at + 1])
            if room[at] == most:
                break
            room[at] = most
        return found, had


def first_fit_decreasing(lengths: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of every piece, and the number of sequences."""
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    full = int((lengths == length).sum())
    sequence[order[:full]] = np.arange(full)
    rest = order[full:]
    tree = Tournament(len(rest), length)
    used = 0
    for i in rest.tolist():
        at, had = tree.place(int(lengths[i]))
        sequence[i], offset[i] = full + at, length - had
        used = max(used, at + 1)
    return sequence, offset, full + used


def pack(pieces: DataFrame, n_docs: int, length: int = LENGTH, group_docs: int = GROUP_DOCS) -> DataFrame:
    """Pieces (id, start, length, ...) with sequence_id and offset, packed in groups of about ``group_docs`` documents.

    A group of which more than ``GROUP_PIECES`` come is packed in parts. Sequence numbers hold the group in the upper
    bits.
    """
    groups = max(1, -(-n_docs // group_docs))
    group = F.pmod(F.xxhash64("id", "doc_tokens", F.lit("group")), F.lit(groups)).alias("group")
    dealt = pieces.select(group, *pieces.columns).repartition("group")
    dealt = dealt.sortWithinPartitions("group", "id", "start", "ids_crc32")

    def run(batches: Iterator[pa.RecordBatch]):
        held: list[pa.RecordBatch] = []
        current, used = None, 0

        def packed():
            nonlocal used
            table = pa.Table.from_batches(held).combine_chunks()
            sequence, offset, n = first_fit_decreasing(table.column("length").to_numpy(), length)
            numbers = (current << 32) + used + sequence
            used += n
            out = table.drop_columns(["group"]).append_column("sequence_id", pa.array(numbers)).append_column("offset", pa.array(offset))
            held.clear()
            yield from out.to_batches(max_chunksize=8192)

        for batch in batches:
            of = batch.column(0).to_numpy()
            bounds = np.flatnonzero(np.diff(of)) + 1
            for low, high in zip([0, *bounds.tolist()], [*bounds.tolist(), len(of)]):
                if low == high:
                    continue
                if of[low] != current:
                    if held:
                        yield from packed()
                    current, used = int(of[low]), 0
                held.append(batch.slice(low, high - low))
                if sum(b.num_rows for b in held) >= GROUP_PIECES:
                    yield from packed()
        if held:
            yield from packed()

    schema = ", ".join(f"`{name}` {kind}" for name, kind in pieces.dtypes) + ", sequence_id long, offset long"
    return dealt.mapInArrow(run, schema)


def packed_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                     length: int = LENGTH, with_ids: bool = False, group_docs: int = GROUP_DOCS) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id and offset; with ``with_ids`` also ids.

    A document is the ids of its whole text, a null text being empty, and id 2. Every id is in exactly one piece, and
    the pieces of a sequence follow each other from offset 0 without gaps. Rows are packed each, repeated ones and
    those without an id too; an empty table gives no piece. Other columns are ignored.
    """
    packed = pack(tokenized(docs, tokenizer_path, id_col, text_col, length, with_ids), docs.count(), length, group_docs)
    return packed.withColumnRenamed("id", id_col)
