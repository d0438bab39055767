"""Benchmark decontamination: item-sized windows of documents against benchmark items.

Words, shingles, fingerprints and similarities are all built-in column functions. A window has as many words as the
item that it is held against. Windows worth a fingerprint are those where enough of the shingles occur in some item of
that size; any window that is similar enough has them, so nothing is lost. Windows and items get 64-bit SimHash
fingerprints of their words. The fingerprints are cut into 8 blocks: two that differ in at most RADIUS = 15 bits differ
in at most one bit of some block, so looking up every block, with every bit flipped on the items' side, finds all pairs
within the radius. Similar pairs can lie beyond any radius, so pairs that share one of their rarest shingles are looked up
as well: of two sides with n shingles, m in common, the first n - m + 1 in any one order share at least one, which makes
the lookup complete. All pairs are verified by the exact similarity of their weighted five-word shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonlens.session import stage

SHINGLE = 5
SIMILARITY = 0.75
#: bits that fingerprints may differ in: one less than twice the number of blocks
RADIUS = 15
BLOCKS = 8
#: rows up to which the benchmark's side or the documents found are broadcast (about 32 MB); beyond it they are shuffled
BROADCAST_ROWS = 500_000


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-case words between ASCII white space; empty for a null text."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def shingle_hashes(words: Column) -> Column:
    """One hash per run of five words; of fewer words, one of the whole sequence."""
    last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
    return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))
    )


def n_shingles(n_words: Column) -> Column:
    return F.greatest(n_words - (SHINGLE - 1), F.lit(1))


def weighted(shingles: Column) -> Column:
    """The shingles with the number of their occurrence, so that common elements add up the lesser weights."""
    return F.transform(
        shingles, lambda x, i: F.xxhash64(x, F.size(F.filter(F.slice(shingles, F.lit(1), i), lambda y: y == x)))
    )


def simhash(words: Column) -> Column:
    """64 bits; each is the sign of the words' votes, a word voting by that bit of its hash."""
    def vote(b):
        return F.aggregate(words, F.lit(0), lambda s, h: s + F.call_function("shiftright", h, b).bitwiseAND(F.lit(1)).cast("int") * 2 - 1)

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(63)),
        F.lit(0).cast("bigint"),
        lambda bits, b: bits.bitwiseOR(F.when(vote(b) >= 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))),
    )


def _block(print_: Column, block: Column) -> Column:
    return F.call_function("shiftright", print_, block * 8).bitwiseAND(F.lit(255)).cast("int")


def items_of(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """item_id, n_words, shingles, weighted shingles and fingerprint of every item that has words."""
    words = benchmark.select(
        F.col(f"`{item_col}`").alias("item_id"), word_hashes(F.col(f"`{text_col}`").cast("string")).alias("words")
    ).distinct().filter(F.size("words") > 0)
    shingled = words.withColumn("shingles", shingle_hashes(F.col("words")))
    return shingled.select(
        "item_id", F.size("words").alias("n_words"), "shingles", weighted(F.col("shingles")).alias("item_weights"),
        simhash(F.col("words")).alias("item_print"),
    )


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _windows(texts: DataFrame, items: DataFrame) -> DataFrame:
    """Per document, the windows (n_words, start) that hold enough shingles of items of that size."""
    known = _small(stage(items.select(F.explode("shingles").alias("shingle"), "n_words").distinct(), "leak-shingles"))
    # one select per step, and no filter that would be pushed below them: a lambda evaluates what it refers to once
    # for each element, so what it refers to must be a column
    shingles = (
        texts.select("id", "text_key", word_hashes(F.col("text")).alias("words"))
        .select("id", "text_key", shingle_hashes(F.col("words")).alias("shingles"))
        .select("id", "text_key", F.size("shingles").alias("total"), F.posexplode_outer("shingles").alias("at", "shingle"))
    )
    hits = shingles.join(known, "shingle")
    places = hits.groupBy("id", "text_key", "n_words", "total").agg(F.sort_array(F.collect_set("at")).alias("places"))
    held = n_shingles(F.col("n_words"))
    need = F.ceil(F.lit(SIMILARITY) * held).cast("int")
    # the first place of the run that reaches the demand within the window; moved left at the end of the text
    starts = F.filter(
        F.transform(
            "places",
            lambda at, i: F.when(
                F.get("places", i + need - 1) <= at + held - 1, F.greatest(F.least(at, F.col("total") - held), F.lit(0))
            ),
        ),
        lambda at: at.isNotNull(),
    )
    found = places.select("id", "text_key", "n_words", F.array_distinct(starts).alias("starts")).filter(F.size("starts") > 0)
    return found.groupBy("id", "text_key").agg(F.collect_list(F.struct("n_words", "starts")).alias("windows"))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Documents that hold a benchmark item: one row (id, item_id) with the best window.

    start_word and n_words place the window, hamming is the distance of the fingerprints, similarity twice the common
    weight of the shingles over the weights of both, at least ``SIMILARITY``; of equal ones, the first window.
    Texts are compared by their lower-case words. An item or a text without words, or null, matches nothing; an item
    with fewer than five words is found only as a whole text. Repeated rows give one result; rows that share an id but
    not the text are searched each and give one row for the id. Other columns are ignored. Runs when it is called.
    """
    return _leaks(_texts(docs, id_col, text_col), stage(items_of(benchmark, item_col, item_text_col), "leak-items")).groupBy(
        "id", "item_id"
    ).agg(
        F.max(F.struct("similarity", (-F.col("hamming")).alias("near"), (-F.col("start")).alias("early"), "n_words")).alias("best")
    ).select(
        F.col("id").alias(id_col), "item_id", (-F.col("best.early")).alias("start_word"), "best.n_words",
        (-F.col("best.near")).alias("hamming"), "best.similarity",
    )


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_key"))


def _leaks(texts: DataFrame, items: DataFrame) -> DataFrame:
    """id, text_key, n_words, start, item_id, hamming and similarity of all similar windows."""
    windows = _small(stage(_windows(texts, items), "leak-windows"))
    same = texts["id"].eqNullSafe(windows["id"]) & (texts["text_key"] == windows["text_key"])
    spread = (
        texts.join(windows, same)
        .select(texts["id"], texts["text_key"], word_hashes(F.col("text")).alias("words"), F.explode("windows").alias("w"))
        .select("id", "text_key", "words", "w.n_words", F.explode("w.starts").alias("start"))
        .select(
            "id", "text_key", "n_words", "start", F.slice("words", F.col("start") + 1, F.col("n_words")).alias("words")
        )
        .withColumn("content", F.xxhash64("words"))
    )
    spread = stage(spread, "leak-spread")
    # windows with the same words are fingerprinted and verified once, however many documents hold them
    contents = stage(
        spread.groupBy("n_words", "content")
        .agg(F.first("words").alias("words"))
        .withColumn("shingles", shingle_hashes(F.col("words")))
        .select("n_words", "content", weighted(F.col("shingles")).alias("weights"), simhash(F.col("words")).alias("print")),
        "leak-contents",
    )
    pairs = _candidates(contents, items).drop("hamming").unionByName(_sharing(contents, items)).distinct()
    verified = contents.join(pairs, ["n_words", "content"]).join(
        items.select("item_id", F.col("n_words").alias("item_words"), "item_weights", "item_print"),
        ["item_id"],
    ).filter("item_words = n_words")
    common = F.size(F.array_intersect("weights", "item_weights"))
    scored = verified.select(
        "n_words", "content", "item_id", F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))).alias("hamming"),
        (2 * common / (F.size("weights") + F.size("item_weights"))).alias("similarity"),
    ).filter(F.col("similarity") >= SIMILARITY)
    return spread.select("id", "text_key", "n_words", "start", "content").join(scored, ["n_words", "content"])


def _candidates(contents: DataFrame, items: DataFrame) -> DataFrame:
    """n_words, content, item_id and hamming of all pairs of one size within the radius."""
    blocks = F.sequence(F.lit(0), F.lit(BLOCKS - 1))
    probes = contents.select("n_words", "content", "print", F.explode(blocks).alias("block")).withColumn(
        "value", _block(F.col("print"), F.col("block"))
    )
    flips = F.array(*[F.lit(0)] + [F.lit(1 << b) for b in range(8)])
    index = (
        items.select("n_words", "item_id", "item_print", F.explode(blocks).alias("block"))
        .withColumn("value", _block(F.col("item_print"), F.col("block")))
        .select("n_words", "item_id", "item_print", "block", F.explode(F.transform(flips, lambda x: F.col("value").bitwiseXOR(x))).alias("value"))
    )
    near = probes.join(index, ["n_words", "block", "value"]).withColumn(
        "hamming", F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    )
    return near.filter(F.col("hamming") <= RADIUS).select("n_words", "content", "item_id", "hamming").distinct()


def _sharing(contents: DataFrame, items: DataFrame) -> DataFrame:
    """n_words, content and item_id of all pairs of one size that share one of the shingles that each must look up.

    The order is that of the number of items with the shingle, the rarest first; it decides cost, never results.
    """
    held = items.withColumn("item_key", F.xxhash64("item_weights")).select("n_words", "item_id", "item_key", F.explode("item_weights").alias("shingle"))
    often = stage(held.groupBy("n_words", "shingle").agg(F.count(F.lit(1)).alias("often")), "leak-often")
    n = n_shingles(F.col("n_words"))
    asked = n - F.ceil(F.lit(SIMILARITY) * n).cast("int") + 1

    def first(shingled: DataFrame, keys: list[str]) -> DataFrame:
        """The shingles to look up; those of no item come before all others and find nothing."""
        ranked = shingled.join(often, ["n_words", "shingle"], "left").groupBy(*keys).agg(
            F.sort_array(F.collect_list(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "shingle"))).alias("ranked")
        )
        return ranked.select(*keys, F.explode(F.slice("ranked", F.lit(1), asked)).alias("at")).filter("at.often > 0").select(*keys, "at.shingle")

    probes = first(contents.select("n_words", "content", F.explode("weights").alias("shingle")), ["n_words", "content"])
    index = first(held, ["n_words", "item_id", "item_key"])
    return probes.join(index, ["n_words", "shingle"]).select("n_words", "content", "item_id").distinct()


def clean_rows(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` without a benchmark item, with all their columns."""
    items = stage(items_of(benchmark, item_col, item_text_col), "leak-items")
    found = _small(
        stage(
            _leaks(_texts(docs, id_col, text_col), items).select(F.col("id").alias("__id"), F.col("text_key").alias("__key")).distinct(),
            "leak-found",
        )
    )
    key = F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    return docs.join(found, F.col(f"`{id_col}`").eqNullSafe(F.col("__id")) & (key == F.col("__key")), "left_anti")
