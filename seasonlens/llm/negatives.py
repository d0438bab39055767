"""Hard negatives of anchors: rows of another label that score within a window below a positive's score.

Anchors are a stated part of the rows and meet all rows in blocks: tiles of anchors and blocks of candidates become
matrices of 64-bit integers, whose product Strassen's recursion computes (odd sizes are padded with zeros, and
arithmetic modulo 2 ** 64 keeps the result exact whatever the sums in between). A first pass keeps each anchor's best
rows of its label, a second one the best rows within the window of each of these. Every task keeps bounded heaps,
which Spark merges by rank: no row of the product outlives its tile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seasonlens.session import stage

EVERY = 100
POSITIVES = 5
NEGATIVES = 5
#: components are multiplied by this and floored
SCALE = 256
#: a negative scores at least this many hundredths of the positive's score, and no more than it
LEAST_PERCENT = 80
TILE = 512
#: rows of a block at most, and bytes of it for wide vectors
BLOCK = 4096
BLOCK_BYTES = 4 << 20
#: bytes of the anchors that are broadcast at a time
WAVE_BYTES = 32 << 20
LEAF = 16

NOTHING = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two integer matrices modulo 2 ** 64."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return np.einsum("ik,kj->ij", a, b)
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    out = np.empty((2 * i, 2 * l), dtype=np.int64)
    p1, p4 = strassen(a11 + a22, b11 + b22, leaf), strassen(a22, b21 - b11, leaf)
    p5, p7 = strassen(a11 + a12, b22, leaf), strassen(a12 - a22, b21 + b22, leaf)
    out[:i, :l] = p1 + p4 - p5 + p7
    p3 = strassen(a11, b12 - b22, leaf)
    out[:i, l:] = p3 + p5
    p2 = strassen(a21 + a22, b11, leaf)
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + strassen(a21 - a11, b11 + b12, leaf)
    return out[:m, :n]


class Heaps:
    """The ``k`` best (score, id) of each of ``m`` lists: higher scores first, then smaller ids."""

    def __init__(self, m: int, k: int):
        self.k = k
        self.score = np.full((m, k), NOTHING)
        self.id = np.zeros((m, k), dtype=np.int64)

    def offer(self, scores: np.ndarray, may: np.ndarray, ids: np.ndarray) -> None:
        """Merge the columns of ``scores`` (one list per row) for which ``may`` holds."""
        hit = may & (scores >= self.score[:, -1:])
        if np.count_nonzero(hit) > 4 * hit.shape[0] * self.k and hit.shape[1] > self.k:
            masked = np.where(hit, scores, NOTHING)
            hit &= scores >= np.partition(masked, -self.k, axis=1)[:, -self.k, None]
        row, column = np.nonzero(hit)
        if len(row):
            self.merge(row, scores[row, column], ids[column])

    def merge(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(row)
        held = self.score[touched] > NOTHING
        row = np.concatenate([np.repeat(touched, self.k).reshape(-1, self.k)[held], row])
        score = np.concatenate([self.score[touched][held], score])
        ids = np.concatenate([self.id[touched][held], ids])
        # scores are far from the least integer, so the sign can change
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        place = np.arange(len(row)) - np.repeat(first, np.diff(first, append=len(row)))
        best = place < self.k
        self.score[touched] = NOTHING
        self.score[row[best], place[best]] = score[best]
        self.id[row[best], place[best]] = ids[best]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, place = np.nonzero(self.score > NOTHING)
        return row, self.score[row, place], self.id[row, place]


def packed(rows: DataFrame, width: int, most: int) -> DataFrame:
    """Rows (id, label, v) as blocks of at most ``most`` rows of 64-bit integers, in order of their ids."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                ids = part.column(0).to_numpy()
                order = np.argsort(ids, kind="stable")
                lists = part.column(2)
                lengths = lists.value_lengths().to_numpy()
                values = np.zeros((len(ids), width), dtype=np.int64)
                row = np.repeat(np.arange(len(ids)), lengths)
                starts = np.cumsum(lengths) - lengths
                values[row, np.arange(len(row)) - np.repeat(starts, lengths)] = lists.flatten().to_numpy()
                parts = [ids[order], part.column(1).to_numpy()[order], values[order]]
                yield pa.RecordBatch.from_arrays([pa.array([x.astype("<i8").tobytes()], pa.binary()) for x in parts], names=["ids", "labels", "v"])

    return rows.mapInArrow(run, "ids binary, labels binary, v binary")


def _whole_numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<i8")


def _products(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    """A row (batch and place), its tile, the anchors' ids and labels, the candidates' ids and labels, and the scores."""
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns))
        for at in range(batch.num_rows):
            ids, labels, v, tile_ids, tile_labels, tile_v = (columns[name][at].as_py() for name in ("ids", "labels", "v", "tile_ids", "tile_labels", "tile_v"))
            ids, tile_ids = _whole_numbers(ids), _whole_numbers(tile_ids)
            scores = strassen(_whole_numbers(tile_v).reshape(-1, width), _whole_numbers(v).reshape(-1, width).T)
            yield batch, at, columns["tile"][at].as_py(), tile_ids, _whole_numbers(tile_labels), ids, _whole_numbers(labels), scores


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` of each list with their rank; Spark limits each group before the shuffle too."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id")))
    return found.withColumn("rank", place).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = EVERY,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE, least_percent: int = LEAST_PERCENT) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Components are scaled and floored to integers. Anchors are the rows of which the id is divisible by ``every``;
    anchors equal in id, label and vector are one. Its positives are the ``positives`` best rows of its label with
    another id. Rows without an id, a label or a vector, or with a null or non-finite component, take no part; a vector
    that is shorter than others is padded with zeros, an empty one scores 0. Repeated rows take a place each; equal
    scores go by the smaller id. A positive with a score below zero has no window. No anchors or no rows give an
    empty result. Scores of a hundredfold must fit 64 bits, otherwise a ValueError is raised. The blocks, the anchors
    and the positives are staged when this is called.
    """
    x = F.col(f"`{vector_col}`")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    known = F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & x.isNotNull() & finite
    clean = rows.filter(known).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda total, c: total + c.cast("double") * c.cast("double"))
    anchor = F.col("id") % every == 0
    size = clean.agg(F.max(F.size("v")).alias("width"), F.max(norm).alias("norm"), F.count(F.when(anchor, 1)).alias("anchors")).first()
    width = max(1, size.width or 0)
    if (size.norm or 0.0) * 100 >= 2.0 ** 62:
        raise ValueError("components are too large for scores of 64 bits")

    block = max(1, min(BLOCK, BLOCK_BYTES // (8 * width)))
    blocks = stage(packed(clean, width, block), "candidates")
    waves = max(1, -(-size.anchors * 8 * (width + 2) // WAVE_BYTES))
    # a tile holds rows of one task; tasks of some tiles each
    dealt = clean.filter(anchor).distinct().repartition(max(1, -(-size.anchors // (4 * TILE))), "id")
    tiles = packed(dealt, width, min(TILE, block)).select(*(F.col(name).alias(f"tile_{name}") for name in ("ids", "labels", "v")))
    tiles = stage(tiles.withColumn("tile", F.monotonically_increasing_id()), "anchors")
    # one row per tile without its anchors: waves of equal numbers of tiles
    numbers = tiles.select("tile", ((F.row_number().over(Window.orderBy("tile")) - 1) % waves).alias("wave"))
    tiles = tiles.join(numbers, "tile")

    def first_pass(batches: Iterator[pa.RecordBatch]):
        heaps: dict[int, tuple[Heaps, np.ndarray]] = {}
        for _, _, tile, own, label, ids, labels, scores in _products(batches, width):
            heap, _ = heaps.setdefault(tile, (Heaps(len(own), positives), own))
            heap.offer(scores, (labels == label[:, None]) & (ids != own[:, None]), ids)
        for tile, (heap, own) in heaps.items():
            row, score, ids = heap.entries()
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(row), tile), row, own[row], score, ids)], names=["tile", "row", "anchor_id", "score", "id"])

    def second_pass(batches: Iterator[pa.RecordBatch]):
        heaps: dict[int, list[Heaps]] = {}
        tops: dict[int, np.ndarray] = {}
        for batch, at, tile, own, label, ids, labels, scores in _products(batches, width):
            if tile not in tops:
                top = np.full((len(own), positives), -1, dtype=np.int64)
                given = batch.column(batch.schema.get_field_index("given"))[at].values
                top[given.field("row").to_numpy(), given.field("rank").to_numpy() - 1] = given.field("score").to_numpy()
                tops[tile], heaps[tile] = top, [Heaps(len(own), negatives) for _ in range(positives)]
            other = labels != label[:, None]
            for slot, heap in enumerate(heaps[tile]):
                most = tops[tile][:, slot, None]
                least = -(-least_percent * most // 100)
                heap.offer(scores, other & (scores <= most) & (scores >= least), ids)
        for tile, of in heaps.items():
            for slot, heap in enumerate(of):
                row, score, ids = heap.entries()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (np.full(len(row), tile), row, np.full(len(row), slot + 1, dtype=np.int32), score, ids)],
                    names=["tile", "row", "slot", "score", "id"])

    def met(tiles: DataFrame, run, schema: str) -> DataFrame:
        """Every block with every tile, one wave of tiles being broadcast at a time."""
        found = [
            blocks.withColumn("wave", F.lit(wave)).join(F.broadcast(tiles.filter(F.col("wave") == wave)), "wave").drop("wave").mapInArrow(run, schema)
            for wave in range(waves)
        ]
        whole = found[0]
        for part in found[1:]:
            whole = whole.unionByName(part)
        return whole

    found = met(tiles, first_pass, "tile long, row long, anchor_id long, score long, id long")
    top = stage(_best(found, ["tile", "row"], positives), "positives")
    given = top.groupBy("tile").agg(F.collect_list(F.struct("row", "rank", "score")).alias("given"))
    found = met(tiles.join(given, "tile"), second_pass, "tile long, row long, slot int, score long, id long")
    window = _best(found, ["tile", "row", "slot"], negatives).select("tile", "row", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    top = top.select("tile", "row", F.col("rank").alias("slot"), "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return window.join(top, ["tile", "row", "slot"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
