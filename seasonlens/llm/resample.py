"""Importance resampling towards a target distribution over hashed word n-grams.

A document is read once: its words, each after one separator, are run through one CRC, and the running CRC after every
word is stored. An n-gram is the bytes between two places of that text, so its CRC is the one at its end plus (in
GF(2)) the one at its start, shifted by as many zero bytes as the n-gram has. A shift is linear and applied by four
look-ups. No n-gram is ever built as a string.

Features are counted per bucket in every task first, so a bucket costs one row per task however frequent it is.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonlens.llm.arrow import pieces as small_batches
from seasonlens.session import stage

BUCKETS = 10_000
MOST_WORDS = 3
LEAST_WORDS = 20
PERCENT = 5
#: n-grams up to this many bytes are shifted by one table, longer ones by powers of two
SHORT = 128

_SEPARATE = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


class Shifts:
    """CRC-32 values shifted by zero bytes."""

    def __init__(self):
        byte = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1).astype(np.uint32)
        #: what one byte of the input does to a register of which the low byte is the index
        self.step = byte
        table = [(np.arange(256, dtype=np.uint32) << (8 * at)).astype(np.uint32) for at in range(4)]
        short = [table]
        for _ in range(SHORT):
            table = [self.step[part & 0xFF] ^ (part >> 8) for part in table]
            short.append(table)
        #: by length, byte of the register and its value
        self.short = np.array(short, dtype=np.uint32)
        self.powers = [self.short[1]]

    def power(self, at: int) -> np.ndarray:
        """The table for 2 ** at bytes."""
        while len(self.powers) <= at:
            last = self.powers[-1]
            self.powers.append(np.array([self._apply(last, part) for part in last], dtype=np.uint32))
        return self.powers[at]

    @staticmethod
    def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return table[0][crc & 0xFF] ^ table[1][(crc >> 8) & 0xFF] ^ table[2][(crc >> 16) & 0xFF] ^ table[3][crc >> 24]

    def __call__(self, crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        by_byte = self.short.reshape(-1)
        at = np.minimum(lengths, SHORT).astype(np.int64) << 10
        out = by_byte[at + (crc & 0xFF)]
        for byte in (1, 2, 3):
            out ^= by_byte[at + (byte << 8) + ((crc >> (8 * byte)) & 0xFF)]
        for i in np.flatnonzero(lengths > SHORT).tolist():
            value, left = crc[i:i + 1], int(lengths[i])
            for bit in range(left.bit_length()):
                if left >> bit & 1:
                    value = self._apply(self.power(bit), value)
            out[i] = value[0]
        return out

    def separator(self, crc: np.ndarray) -> np.ndarray:
        """The CRC after one more space."""
        register = ~crc
        return ~(self.step[(register & 0xFF) ^ 32] ^ (register >> 8))


@lru_cache(maxsize=1)
def shifts() -> Shifts:
    return Shifts()


def running(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts one after the other: the CRC before each word and after it, with the bytes so far; words per text.

    The first text place of a document has no word before it; it holds CRC 0 at 0 bytes.
    """
    crcs: list[int] = []
    sizes: list[int] = []
    counts = []
    crc32 = zlib.crc32
    for text in texts:
        words = text.translate(_SEPARATE).split()
        counts.append(len(words))
        if words:
            spaced = (b" " + b"\n ".join(words)).split(b"\n")
            crcs += accumulate(spaced, lambda crc, word: crc32(word, crc), initial=0)
            sizes.append(0)
            sizes += map(len, spaced)
    return np.array(crcs, dtype=np.uint32), np.array(sizes, dtype=np.int64), np.array(counts, dtype=np.int64)


def features(texts: list[bytes], most: int = MOST_WORDS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and bucket of every feature, and the number of words per text."""
    after, sizes, counts = running(texts)
    shift = shifts()
    ends = np.cumsum(sizes)
    # where an n-gram begins that follows the word of this place: after one more separator
    begin_crc, begin_at = shift.separator(after), ends + 1
    places = np.where(counts > 0, counts + 1, 0)
    text_of = np.repeat(np.arange(len(texts)), places)
    found_text, found_bucket = [], []
    for n in range(1, most + 1):
        if len(after) <= n:
            break
        same = np.flatnonzero(text_of[n:] == text_of[:-n])
        crc = after[same + n] ^ shift(begin_crc[same], ends[same + n] - begin_at[same])
        found_text.append(text_of[same])
        found_bucket.append((crc % np.uint32(buckets)).astype(np.int64))
    none = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(found_text or none), np.concatenate(found_bucket or none), counts


def _bytes(column: pa.Array) -> list[bytes]:
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def bucket_counts(texts: DataFrame, text_col: str = "text", most: int = MOST_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """bucket and n (features in it, repeats counted) over all rows; buckets without a feature are left out."""

    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for piece in small_batches([batch]):
                total += np.bincount(features(_bytes(piece.column(0)), most, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    read = texts.select(F.col(f"`{text_col}`").cast("string").alias("__text"))
    return read.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """What a feature adds to a weight, by bucket, from the counts of both sides."""
    whole, wanted = float(sum(documents.values()) + buckets), float(sum(target.values()) + buckets)

    def gain(bucket: int) -> int:
        had, want = float(documents.get(bucket, 0) + 1), float(target.get(bucket, 0) + 1)
        return math.floor(1000 * math.log(want * whole / (had * wanted)))

    return np.array([gain(bucket) for bucket in range(buckets)], dtype=np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_WORDS) -> DataFrame:
    """id, n_features, n_words and weight of every row."""
    schema = T.StructType([docs.schema[id_col]] + [T.StructField(name, T.LongType()) for name in ("n_features", "n_words", "weight")])

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in small_batches(batches):
            of, bucket, words = features(_bytes(batch.column(1)), most, len(gain))
            n = np.bincount(of, minlength=len(words)).astype(np.int64)
            # whole numbers below 2 ** 53 add up exactly in doubles
            weight = np.bincount(of, weights=gain[bucket].astype(np.float64), minlength=len(words)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(words), pa.array(weight)], names=schema.names)

    read = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("__text"))
    return read.mapInArrow(run, schema)


def noise(id_col: str, seed: int) -> Column:
    """A thousand times a Gumbel variate of the id, floored; null ids are hashed as no characters."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    uniform = (F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             percent: int = PERCENT, least_words: int = LEAST_WORDS, most: int = MOST_WORDS, buckets: int = BUCKETS, seed: int = 42) -> DataFrame:
    """id, n_features, weight, score and rank of every row; rank is null for rows that are not drawn.

    Of the rows with at least ``least_words`` words ``percent`` in a hundred are drawn without replacement, by the
    highest scores. Null, empty and blank texts have no feature, weight 0 and are not drawn. Repeated rows count and are
    drawn each; rows of equal score and id rank in an order of no meaning. An empty table on either side is counted as
    such: gains are then those of one side alone. Other columns are ignored. Counts run when this is called: two
    tables of at most ``buckets`` rows come to the driver, and the scores are staged.
    """
    def counts(df: DataFrame, column: str) -> dict[int, int]:
        return {row.bucket: row.n for row in bucket_counts(df, column, most, buckets).collect()}

    gain = gains(counts(docs, text_col), counts(target, target_text_col), buckets)
    scored = weights(docs, gain, id_col, text_col, most)
    scored = stage(scored.withColumn("score", F.col("weight") + noise(id_col, seed)).withColumn("__row", F.monotonically_increasing_id()), "scores")
    may = F.col("n_words") >= least_words
    draw = scored.filter(may).count() * percent // 100
    # the draw is sorted by ranges: blocks of the whole order, numbered from the first, without one task for all
    order = [F.col("score").desc(), F.col(f"`{id_col}`").asc(), F.col("__row").asc()]
    blocks = stage(scored.filter(may).repartitionByRange(*order).withColumn("__block", F.spark_partition_id()), "order")
    sizes = blocks.groupBy("__block").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))
    # one row per block of the order
    starts = sizes.select("__block", F.coalesce(before, F.lit(0)).alias("__before"))
    within = F.row_number().over(Window.partitionBy("__block").orderBy(*order))
    rank = F.col("__before") + within
    ranked = blocks.join(F.broadcast(starts), "__block").withColumn("rank", F.when(rank <= draw, rank).cast("long"))
    columns = [F.col(f"`{id_col}`"), "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(scored.filter(~may).withColumn("rank", F.lit(None).cast("long")).select(*columns))
