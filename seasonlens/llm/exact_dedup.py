"""Exact deduplication by an extendible-hash index on shared files.

Each distinct text is one index entry under the 64-bit fingerprint of its text. Leading fingerprint bits choose
the bucket: the directory starts with one bucket and doubles, splitting a bucket that holds too many entries by
one more bit, until no bucket is overfull or the directory has its full depth. The entries are written to the
shared folder by ranges of (bucket, fingerprint), so that every owner task writes one key range; entries with the
same fingerprint are chained there. Documents look up their fingerprint. A chain of one entry answers at once, as
its texts were already compared byte by byte when the entry was built (the grouping key holds the text itself);
in a longer chain the document's text is compared with that of each entry.

Copies are merged before the first shuffle, so that a text with a third of all rows is one row per map task, and
the look-up is a join of narrow rows, which adaptive execution splits where a fingerprint is hot.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seasonlens.session import stage

#: entries of a bucket beyond which it is split
BUCKET_ENTRIES = 4096
#: bits of the directory at most: 65,536 cells of 20 bytes, which bounds what is broadcast
MAX_DEPTH = 16


def directory(entries: DataFrame, n_entries: int, bucket_entries: int = BUCKET_ENTRIES, max_depth: int = MAX_DEPTH) -> DataFrame:
    """The directory cells: cell (leading bits of the fingerprint at full depth), depth and bucket.

    A cell's bucket is its shortest prefix that is not overfull, which is where repeated doubling ends. A bucket
    that is overfull at full depth stays so: its owner range is longer, its results are the same.
    """
    depth = min(max_depth, max(1, ceil(log2(max(1, n_entries) / bucket_entries)) + 2)) if n_entries > bucket_entries else 1
    cells = entries.groupBy(cell(F.col("key"), depth).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    levels = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth")).withColumn(
        "prefix", F.expr(f"shiftright(cell, {depth} - depth)")
    )
    sizes = levels.groupBy("depth", "prefix").agg(F.sum("n").alias("size"))
    chosen = levels.join(sizes, ["depth", "prefix"]).groupBy("cell").agg(
        F.coalesce(F.min(F.when(F.col("size") <= bucket_entries, F.col("depth"))), F.lit(depth)).alias("depth")
    )
    return chosen.withColumn("bucket", F.expr(f"shiftleft(1, depth) + shiftright(cell, {depth} - depth)")).withColumn(
        "full_depth", F.lit(depth)
    )


def cell(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth).cast("int")


def build_index(rows: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """Entries (bucket, key, chain, keep_id, group_size, text_sha256) of rows (id, key, text), staged."""
    entries = stage(
        rows.groupBy("key", "text")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("key", "keep_id", "group_size", F.sha2("text", 256).alias("text_sha256")),
        "dedup-entries",
    )
    cells = stage(directory(entries, entries.count(), bucket_entries), "dedup-directory")
    depth = (cells.agg(F.max("full_depth")).first() or [None])[0] or 1
    owned = (
        entries.withColumn("cell", cell(F.col("key"), depth))
        .join(F.broadcast(cells.select("cell", "bucket")), "cell")
        .repartitionByRange("bucket", "key")
    )
    chained = owned.withColumn("chain", F.count(F.lit(1)).over(W.partitionBy("bucket", "key")))
    return stage(chained.select("bucket", "key", "chain", "keep_id", "group_size", "text_sha256"), "dedup-index")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    fingerprint: Callable[[Column], Column] = F.xxhash64,
    bucket_entries: int = BUCKET_ENTRIES,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept and text_sha256.

    Texts are equal when their bytes are; a null text is an empty one. Of equal texts the row with the largest id
    stays; a null id is smaller than any other and stays only in a group without ids. Rows that repeat the id and
    the text of the row that stays are the same document and all marked kept. Other columns are ignored, whatever
    their names; an empty table gives an empty result. The index is built when this is called.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    ).withColumn("key", fingerprint(F.col("text")).cast("long"))
    index = build_index(rows, bucket_entries)
    found = rows.select("id", "key").join(index.filter("chain = 1"), "key").drop("key", "bucket", "chain")
    chains = index.filter("chain > 1").select("key").distinct()
    if not chains.isEmpty():
        found = found.unionByName(_in_chains(rows.join(chains, "key", "left_semi")))
    kept = F.col("id").eqNullSafe(F.col("keep_id"))
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def _in_chains(rows: DataFrame) -> DataFrame:
    """The same answer for rows whose fingerprint stands for several texts, found by comparing the texts."""
    chained = rows.groupBy("key", "text").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return rows.join(chained, ["key", "text"]).select(
        "id", "keep_id", "group_size", F.sha2("text", 256).alias("text_sha256")
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A row stays if its id is the largest of its text; rows without an id are looked up by their text's digest.
    """
    stays = exact_dedup(docs, id_col, text_col).filter("kept").select(
        F.col(id_col).alias("__id"), F.col("text_sha256").alias("__sha")
    ).distinct()
    sha = F.sha2(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), 256)
    return docs.join(stays, F.col(f"`{id_col}`").eqNullSafe(F.col("__id")) & (sha == F.col("__sha")), "left_semi")
