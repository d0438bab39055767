"""Repeated windows of symbols across documents, found through shared anchors.

A window of ``length`` symbols holds ``length - gram + 1`` grams; the one with the least hash is its anchor. Equal windows
have equal anchors, so a window can only repeat if its anchor occurs more than once. Only anchors are counted over the
corpus, one for some seven or seventy windows; windows are looked at only around anchors that occur again. Those are
gathered by anchor, each group in (document, place) order. The windows of an anchor that occurs more than ``GROUP`` times
are not gathered: Spark aggregates them by their hashes, on the map side first, and what it finds is joined back. So no
group that is held in Python grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from seasonlens.llm.arrow import pieces
from seasonlens.llm.shingles import mixed
from seasonlens.session import stage, unstage

#: occurrences of an anchor that are gathered in one group
GROUP = 20_000
#: repeated window hashes of frequent anchors up to which they are broadcast (at most some 60 MB)
BROADCAST_ROWS = 500_000
#: rows of small groups that are judged together
ROWS_JUDGED = 1 << 12
#: bits of the filter for repeated anchors: a fixed 32 MB, whatever the corpus
FILTER_BITS = 28
FILTER_BLOCKS = 16

_BASE = 0x9E3779B97F4A7C15 | 1


@dataclass(frozen=True)
class Windows:
    """How texts become symbols, and which windows and grams of them count."""

    length: int
    gram: int
    symbols: Callable[[bytes], np.ndarray]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    up, down = np.full(n + 1, _BASE, dtype=np.uint64), np.full(n + 1, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_POWERS = powers(1 << 12)


def run_hashes(symbols: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` symbols, from polynomial hashes of the prefixes."""
    global _POWERS
    n = len(symbols)
    if n < length:
        return np.zeros(0, dtype=np.uint64)
    if len(_POWERS[0]) <= n:
        _POWERS = powers(max(n, 2 * len(_POWERS[0])))
    up, down = _POWERS
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(symbols * up[:n], out=prefix[1:])
    return mixed((prefix[length:] - prefix[:n - length + 1]) * down[:n - length + 1])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value in every run of ``width``."""
    run = 1
    while run < width:
        step = min(run, width - run)
        values = np.minimum(values[:-step], values[step:])
        run += step
    return values


def anchors(symbols: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each run of windows with one anchor: the anchor's hash, the first window and how many there are.

    The anchor of a window is its first gram with the least hash, so equal windows have it at the same place.
    """
    n = len(symbols) - windows.length + 1
    if n <= 0:
        return (np.zeros(0, dtype=np.uint64), *[np.zeros(0, dtype=np.int64)] * 2)
    grams, width = run_hashes(symbols, windows.gram), windows.length - windows.gram + 1
    least = sliding_least(grams, width)
    across = np.arange(width)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    done: list[np.ndarray] = []
    ends = np.append(first[1:], n)
    # where the least value falls, it is that of the gram that has just come in; else it has to be looked for
    place = first + (width - 1)
    look = np.flatnonzero(np.concatenate([[True], least[first[1:]] > least[first[1:] - 1]]))
    place[look] = first[look] + grams[first[look][:, None] + across].argmin(axis=1)
    # a run of windows with one least value goes on beyond its place if the same gram comes again
    while len(first):
        done.append(first)
        more = place + 1 < ends
        first, ends = place[more] + 1, ends[more]
        place = first + grams[first[:, None] + across].argmin(axis=1)
    first = np.sort(np.concatenate(done))
    return least[first], first, np.diff(np.append(first, n))


def tag(data: bytes) -> bytes:
    """128 bits that tell texts apart that share an id."""
    return xxh3_128_digest(data)


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))


def _anchored(windows: Windows):
    """Per row: id, tag, compressed text and, in lists, its anchors and how many windows each has, from the first window on."""

    def run(batches):
        for batch in compressed_pieces(batches):
            found = [anchors(windows.symbols(data), windows) for data in batch[0]]
            ends = pa.array(np.cumsum([0, *[len(f[0]) for f in found]]), pa.int32())
            lists = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, dtype=np.int64) for i in (0, 2)]
            kinds = (pa.int64(), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(values.view(np.int64)).cast(kind)) for values, kind in zip(lists, kinds)]
            yield pa.RecordBatch.from_arrays([*batch[1].columns, *lists], names=["id", "tag", "data", "anchors", "windows"])

    return run


def _bits(batches):
    """Which bits of the filter the anchors set, by block."""
    for batch in batches:
        at = np.unique(batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
        parts = np.split(at, np.searchsorted(at, np.arange(1, FILTER_BLOCKS) * ((1 << FILTER_BITS) // FILTER_BLOCKS)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(FILTER_BLOCKS), pa.int32()), pa.array([part.astype(np.int32).tobytes() for part in parts], pa.binary())],
            names=["block", "bits"],
        )


def _set_bits(batches):
    size = (1 << FILTER_BITS) // FILTER_BLOCKS
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found.setdefault(block, np.zeros(size, dtype=bool))[np.frombuffer(bits, dtype=np.int32) - block * size] = True
    for block, bits in found.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["block", "bits"]
        )


def repeat_filter(shared: DataFrame) -> np.ndarray:
    """A bit for each leading part of a repeated anchor: others need not be sent to find out that they are unique."""
    spread = shared.select("anchor").mapInArrow(_bits, "block int, bits binary").repartition(FILTER_BLOCKS, "block")
    size = (1 << FILTER_BITS) // FILTER_BLOCKS // 8
    found = np.zeros((FILTER_BLOCKS, size), dtype=np.uint8)
    for row in spread.mapInArrow(_set_bits, "block int, bits binary").collect():
        found[row["block"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    return found.reshape(-1)


def compressed_pieces(batches):
    """The bytes of the texts of some rows at a time, and the rows: id, tag and compressed text."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in pieces(batches):
        data = [text.encode("utf-8", "surrogatepass") for text in batch.column(1).to_pylist()]
        yield data, pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([tag(d) for d in data], pa.binary()), pa.array([press.compress(d) for d in data], pa.binary())],
            names=["id", "tag", "data"],
        )


def compressed(batches):
    """id, tag and compressed text: texts cross shuffles as small as they get."""
    for _, rows in compressed_pieces(batches):
        yield rows


def _hits(batches, chosen):
    """Some rows at a time, with the texts' bytes and, for the anchors that ``chosen`` marks: row, anchor, first window and how many."""
    unpress = zstandard.ZstdDecompressor()
    for batch in pieces(batches):
        found, number = [batch.column(i).flatten().to_numpy().astype(np.int64) for i in (3, 4)]
        sizes = pc.list_value_length(batch.column(3)).to_numpy()
        kept = np.flatnonzero(chosen(found))
        row = np.repeat(np.arange(batch.num_rows), sizes)[kept]
        # the windows of a text stand side by side
        before = np.concatenate([[0], np.cumsum(number)])
        first = before[kept] - before[np.cumsum(sizes) - sizes][row]
        ends = np.cumsum(np.bincount(row, minlength=batch.num_rows)).tolist()
        texts = ((unpress.decompress(batch.column(2)[i].as_py()), low, high) for i, (low, high) in enumerate(zip([0, *ends], ends)) if high > low)
        yield batch, texts, row, found[kept], first, number[kept]


def _gathered(describe, repeated, frequent: np.ndarray):
    """For each anchor of a document that may come again and is not ``frequent``, what the group needs to know of its windows."""

    def run(batches):
        bits = repeated.value

        def chosen(found: np.ndarray) -> np.ndarray:
            at = (found.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool) & ~np.isin(found, frequent)

        for batch, texts, row, anchor, first, number in _hits(batches, chosen):
            places, count, what = first.tolist(), number.tolist(), []
            for data, low, high in texts:
                what += describe(data, places[low:high], count[low:high])
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), *[batch.column(i).take(rows) for i in (0, 1)], pa.array(first), pa.array(what, pa.binary())],
                names=["anchor", "id", "tag", "place", "what"],
            )

    return run


def _hashed(windows: Windows, frequent: np.ndarray):
    """For each ``frequent`` anchor of a document, the hashes of its windows."""

    def run(batches):
        for batch, texts, row, _, first, number in _hits(batches, lambda found: np.isin(found, frequent)):
            places, count, found = first.tolist(), number.tolist(), [np.zeros(0, dtype=np.int64)]
            for data, low, high in texts:
                hashes = run_hashes(windows.symbols(data), windows.length).view(np.int64)
                found += [hashes[at:at + n] for at, n in zip(places[low:high], count[low:high])]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(number)]), pa.int32()), pa.array(np.concatenate(found)))
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i).take(rows) for i in (0, 1)], pa.array(first), lists], names=["id", "tag", "place", "hashes"]
            )

    return run


def _as_runs(batches):
    for batch in pieces(batches):
        starts = [runs(np.sort(np.array(at, dtype=np.int64))) for at in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(starts, pa.binary())], names=["id", "tag", "starts"])


def _frequent(hashed: DataFrame, picks, kind: str) -> DataFrame:
    """id, tag and starts of the windows of frequent anchors that ``picks`` chooses.

    Windows are told apart by their 64-bit hashes. A hash is aggregated on the map side before anything is sent, so one
    that occurs in many documents is a few rows in each task; those that occur in one place only are not joined back.
    """
    windows = hashed.select("id", "tag", "place", F.posexplode("hashes").alias("at", "hash")).select(
        "hash", F.struct("id", "tag", (F.col("place") + F.col("at")).alias("place")).alias("where")
    )
    again = stage(
        windows.groupBy("hash").agg(F.min("where").alias("first"), F.max("where").alias("last")).filter(~F.col("first").eqNullSafe(F.col("last"))).select("hash", "first"),
        "repeat-hashes",
    )
    # a hash that is hot is so on the side of the windows only; what is too large to broadcast is split by Spark
    again = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
    picked = windows.join(again, "hash").filter(picks(F.col("where"), F.col("first")))
    places = picked.select("where.id", "where.tag", F.col("where.place").alias("start"))
    return places.groupBy("id", "tag").agg(F.collect_set("start").alias("at")).mapInArrow(_as_runs, f"id {kind}, tag binary, starts binary")


def _whole(batches, most: int):
    """The rows anew, in batches of whole groups: as many groups as have ``most`` rows together, or one that has more."""
    rest = None
    for batch in batches:
        rows = batch if rest is None else pa.concat_batches([rest, batch])
        of = rows.column(0).to_numpy()
        # the last group may go on in the next batch
        begins = np.flatnonzero(of[1:] != of[:-1]) + 1
        low = 0
        while len(begins) and low < begins[-1]:
            high = begins[max(np.searchsorted(begins, low + most, "right") - 1, np.searchsorted(begins, low, "right"))]
            yield rows.slice(low, high - low)
            low = high
        rest = rows.slice(low)
    if rest is not None and rest.num_rows:
        yield rest


def _groups(judge):
    """Judge the groups of rows with one anchor, some at a time; partitions are sorted by it, id, tag and place."""
    most = min(GROUP, ROWS_JUDGED)

    def run(batches):
        for batch in _whole(batches, most):
            found = _found(batch, *judge(batch))
            if found.num_rows:
                yield found

    return run


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values of a binary column, one after the other, and where each begins and the last ends."""
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, dtype=np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return data[ends[0]:ends[-1]], ends - ends[0]


def repeated_rows(batch: pa.RecordBatch) -> np.ndarray:
    """Which rows are the row before them once more: the same anchor, id, text and place."""
    again = np.zeros(batch.num_rows, dtype=bool)
    anchor, id_, tag_, place = [batch.column(i) for i in range(4)]
    tags = binary_parts(tag_)[0].view(np.uint64).reshape(-1, 2)
    no_id = id_.is_null().to_numpy(zero_copy_only=False)
    same_id = pc.fill_null(pc.equal(id_.slice(1), id_.slice(0, len(id_) - 1)), False).to_numpy(zero_copy_only=False)
    same = [values[1:] == values[:-1] for values in (anchor.to_numpy(), place.to_numpy(), tags[:, 0], tags[:, 1])]
    again[1:] = np.logical_and.reduce(same) & (same_id | (no_id[1:] & no_id[:-1]))
    return again


def in_order(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of hashes in the order of (hash, place), and which of them, but for the first, have the hash of the one before."""
    # the place is put into the last bits, so that plain numbers are sorted; should hashes differ there only, they are sorted whole
    last = np.uint64((1 << max(1, len(hashes)).bit_length()) - 1)
    order = (np.sort((hashes & ~last) | np.arange(len(hashes), dtype=np.uint64)) & last).astype(np.int64)
    sorted_ = hashes[order]
    same = sorted_[1:] == sorted_[:-1]
    if np.count_nonzero(((sorted_[1:] ^ sorted_[:-1]) & ~last) == 0) > np.count_nonzero(same):
        order = np.argsort(hashes, kind="stable")
        sorted_ = hashes[order]
        same = sorted_[1:] == sorted_[:-1]
    return order, same


def _edges(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of marked places begin, and where they end."""
    steps = np.diff(np.concatenate([[False], marked, [False]]).view(np.int8))
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def runs(starts: np.ndarray) -> bytes:
    """Sorted numbers as runs: the first and how many, as little-endian 64-bit numbers."""
    first = np.concatenate([[0], np.flatnonzero(np.diff(starts) != 1) + 1])
    return np.stack([starts[first], np.diff(np.append(first, len(starts)))], axis=1).astype("<i8").tobytes()


def _found(batch: pa.RecordBatch, of: np.ndarray, numbers: np.ndarray, picked: np.ndarray) -> pa.RecordBatch:
    """id, tag and ``runs`` of the rows with picked windows.

    Row i has the windows of kind ``of[i]``; the kinds have ``numbers`` windows each, and ``picked`` tells of those of all kinds,
    one after the other, which are picked.
    """
    begins = np.cumsum(numbers) - numbers
    # a place between any two kinds, so that no run goes on from one to the next
    apart = np.zeros(len(picked) + len(numbers), dtype=bool)
    apart[np.arange(len(picked)) + np.repeat(np.arange(len(numbers)), numbers)] = picked
    first, end = _edges(apart)
    begins += np.arange(len(numbers))
    kind = np.searchsorted(begins, first, "right") - 1
    many = np.bincount(kind, minlength=len(numbers))
    of_kind = np.cumsum(many) - many
    rows = np.flatnonzero(many[of])
    sizes = many[of[rows]]
    ends = np.cumsum(sizes)
    taken = np.arange(int(sizes.sum())) + np.repeat(of_kind[of[rows]] - (ends - sizes), sizes)
    place = np.repeat(batch.column(3).to_numpy()[rows], sizes)
    data = np.stack([place + (first - begins[kind])[taken], (end - first)[taken]], axis=1).astype("<i8")
    offsets = np.concatenate([[0], ends * 16]).astype(np.int32)
    starts = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    rows = pa.array(rows)
    return pa.RecordBatch.from_arrays([batch.column(1).take(rows), batch.column(2).take(rows), starts], names=["id", "tag", "starts"])


def repeated_windows(texts: DataFrame, windows: Windows, describe, judge, picks) -> DataFrame:
    """id, tag and starts (binary ``runs``, one or more pieces) of the windows that are picked, staged.

    ``describe(data, first, number)`` is what is sent of the windows of each anchor of a text; ``judge(rows)`` gets
    the rows (anchor, id, tag, place, what) of whole groups in order and gives the last three arguments of ``_found``. Of an anchor with more
    than ``GROUP`` occurrences, those windows whose hash comes in more than one place and for which ``picks`` (a condition
    on the place of the window and the first place of its hash, in order) holds.
    """
    kind = dict(texts.dtypes)["id"]
    anchored = stage(
        texts.mapInArrow(_anchored(windows), f"id {kind}, tag binary, data binary, anchors array<long>, windows array<int>"), "repeat-places"
    )
    counts = anchored.select(F.explode("anchors").alias("anchor")).groupBy("anchor").agg(F.count(F.lit(1)).alias("times"))
    shared = stage(counts.filter("times > 1"), "repeat-anchors")
    repeated = texts.sparkSession.sparkContext.broadcast(repeat_filter(shared))
    # there is at most one for GROUP anchors of the corpus
    frequent = np.array([row["anchor"] for row in shared.filter(F.col("times") > GROUP).select("anchor").collect()], dtype=np.int64)
    rows = anchored.mapInArrow(_gathered(describe, repeated, frequent), f"anchor long, id {kind}, tag binary, place long, what binary")
    sorted_ = rows.repartition("anchor").sortWithinPartitions("anchor", "id", "tag", "place")
    found = sorted_.mapInArrow(_groups(judge), f"id {kind}, tag binary, starts binary")
    hashed = None
    if len(frequent):
        hashed = stage(anchored.mapInArrow(_hashed(windows, frequent), f"id {kind}, tag binary, place long, hashes array<long>"), "repeat-frequent")
        found = found.unionByName(_frequent(hashed, picks, kind))
    found = stage(found, "repeat-windows")
    for done in (anchored, shared, hashed):
        unstage(done)
    return found


def with_starts(texts: DataFrame, found: DataFrame, fn, made) -> DataFrame:
    """id and the columns ``made`` that ``fn(data, first, count)`` gives for every text, from the runs of its starts."""
    kind = dict(texts.dtypes)["id"]
    starts = found.groupBy("id", "tag").agg(F.collect_set("starts").alias("starts"))
    packed = texts.mapInArrow(compressed, f"id {kind}, tag binary, data binary")
    same = packed["id"].eqNullSafe(starts["id"]) & (packed["tag"] == starts["tag"])
    joined = packed.join(starts, same, "left").select(packed["id"], "data", "starts")

    def run(batches):
        unpress = zstandard.ZstdDecompressor()
        for batch in pieces(batches):
            sizes = pc.fill_null(pc.list_value_length(batch.column(2)), 0).to_numpy()
            parts, ends = binary_parts(batch.column(2).flatten())
            ends = ends[np.cumsum([0, *sizes])].tolist()
            out = []
            for row, (low, high) in enumerate(zip(ends, ends[1:])):
                first, count = parts[low:high].view("<i8").reshape(-1, 2).T
                out.append(fn(unpress.decompress(batch.column(1)[row].as_py()), first, count))
            columns = [pa.array([o[i] for o in out], kind) for i, (_, kind, _) in enumerate(made)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", *[name for name, _, _ in made]])

    return joined.mapInArrow(run, f"id {kind}, " + ", ".join(f"{name} {sql}" for name, _, sql in made))


def covered(first: np.ndarray, count: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of ``size`` symbols windows of ``length`` cover that start at ``count`` places from each of ``first`` on."""
    if not len(first):
        return np.zeros(size, dtype=bool)
    edges = np.bincount(first, minlength=size + 1) - np.bincount(first + count + (length - 1), minlength=size + 1)
    return np.cumsum(edges[:-1]) > 0


def spans_of(gone: np.ndarray) -> list[tuple[int, int]]:
    """The maximal runs of places that are gone, end exclusive."""
    return list(zip(*[edge.tolist() for edge in _edges(gone)]))
