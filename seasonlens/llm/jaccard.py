"""Near-duplicate join: Jaccard similarity of word shingles with adaptive multi-match prefixes.

Shingles are ordered from rare to frequent by counts over all documents. A set of n shingles that is similar to
another shares at least ceil(0.75 n) with it, so the first n - ceil(0.75 n) + k of both must share k. Each document
chooses the k with the least estimated cost: a longer prefix has more postings to read, but asks for more matches and
so leaves fewer candidates. k is at least ``least_matches(n)``, which grows with n. So of the prefix shingles that turn
out to be shared with another document at all, the most frequent ones, up to one less than the matches that any
partner must have, need not be joined on: a similar pair still meets on its rarest common shingle.

This runs twice. The first prefixes are chosen by an estimate of the counts, and a document that shares too few of them
is linked with nothing. Of the others, whole sets are counted: who shares less than ceil(0.75 n) shingles with all of them
together has no links either, so a passage that many documents have in common makes no candidates of them. The rest choose
their prefixes anew by exact counts, and those are joined. How far a prefix counts depends on the pair: two sets of n need an overlap
of 6/7 n, so a shingle beyond the first n / 7 and the matches asked for is no sign of them. The shingles that a large group of near
copies shares come after those that tell a copy from the others, and so only copies close to one another meet on them.

Documents with equal sets are one class, compared once. Links are used for connected components only, so pairs that
are known to be connected need no check: first every class is compared with a few hubs of each shingle it shares,
then only candidate pairs from different components are, all of them. A group of n near copies of one text thus costs
about n comparisons instead of n * n, and no link between components is lost.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seasonlens.llm.arrow import pieces
from seasonlens.llm.components import components
from seasonlens.llm.shingles import set_key, shingle_set
from seasonlens.session import stage

PERCENT = 75
#: counters of the frequency estimate and bits of a shingle's hash that choose one; the estimate that tasks get holds
#: a byte for each, a fixed 16 MB, whatever the corpus
COUNTER_BITS = 24
BLOCKS = 16
#: shingles that a task counts at a time; a counter that is met once among them is not passed on
COUNTED_AT_ONCE = 1 << 22
#: an estimate of f is kept as 4 log2(f)
FREQUENCY = np.where(np.arange(256) > 0, 2.0 ** (np.arange(256) / 4), 0.0)
#: common shingles to ask for in the first prefixes at most, beyond the least; a cost choice that loses no pair
MOST_MATCHES = 255
#: cost of comparing a candidate against reading one posting
COMPARE_COST = 4.0
#: rows of 8 bytes up to which the keys of candidates are broadcast (some 30 MB in memory); beyond it they are shuffled
BROADCAST_ROWS = 500_000
#: the same for keys with their sketches, rows of 40 bytes
BROADCAST_SKETCHES = 100_000
#: hubs of a shingle in each round, before all candidate pairs that are left are compared
HUBS = (1, 2)
#: 64-bit words of a set's sketch, which tells pairs apart that meet on what a large group has in common
SKETCH = tuple(f"sketch_{i}" for i in range(4))
POSTINGS_AT_ONCE = 1 << 18


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Shingles that a set of n shares with any similar one at least."""
    return -(-n * percent // 100)


def _counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - COUNTER_BITS)).astype(np.int32)


def _profiles(batches):
    """Per row: id, code, n, key; now and then, the counters met more than once, by block. Copies in a task count once."""
    seen: set[int] = set()
    met: list[np.ndarray] = []
    held, id_type = 0, None

    def counted():
        counters, counts = np.unique(np.concatenate(met), return_counts=True)
        met.clear()
        counters, counts = counters[counts > 1], counts[counts > 1].astype(np.uint32)
        ends = np.searchsorted(counters, np.arange(1, BLOCKS) << (COUNTER_BITS - 4))
        parts = list(zip(np.split(counters, ends), np.split(counts, ends)))
        return pa.RecordBatch.from_arrays(
            [pa.nulls(BLOCKS, id_type), *[pa.nulls(BLOCKS, pa.int64())] * 3, pa.array(range(BLOCKS), pa.int32()),
             pa.array([c.tobytes() for c, _ in parts], pa.binary()), pa.array([n.tobytes() for _, n in parts], pa.binary())],
            names=["id", "code", "n", "key", "block", "counters", "counts"],
        )

    for batch in pieces(batches):
        sizes, keys, id_type = [], [], batch.column(0).type
        for text in batch.column(2).to_pylist():
            hashes = shingle_set(text or "")
            key = set_key(hashes)
            sizes.append(len(hashes))
            keys.append(key)
            if key is not None and key not in seen:
                seen.add(key)
                met.append(_counter(hashes))
                held += len(hashes)
        none = pa.nulls(len(sizes), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.nulls(len(sizes), pa.int32()), none, none],
            names=["id", "code", "n", "key", "block", "counters", "counts"],
        )
        if held >= COUNTED_AT_ONCE:
            yield counted()
            held = 0
    if held:
        yield counted()


def _sums(batches):
    """block -> sums of its counters."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            block = batch.column(0)[i].as_py()
            counters = np.frombuffer(batch.column(1)[i].as_buffer(), dtype=np.int32) - (block << (COUNTER_BITS - 4))
            if block not in total:
                total[block] = np.zeros(1 << (COUNTER_BITS - 4), dtype=np.uint64)
            total[block][counters] += np.frombuffer(batch.column(2)[i].as_buffer(), dtype=np.uint32)
    return total


def _add_sparse(batches):
    for block, total in _sums(batches).items():
        counters = np.flatnonzero(total)
        counts = np.minimum(total[counters], 0xFFFFFFFF).astype(np.uint32)
        counters = (counters + (block << (COUNTER_BITS - 4))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([counters.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary())],
            names=["block", "counters", "counts"],
        )


def _add_levels(batches):
    for block, total in _sums(batches).items():
        # what chance puts into a counter is no sign of a frequent shingle
        mean = float(total.mean())
        noise = mean + 4 * math.sqrt(mean) + 2
        levels = np.where(total > noise, np.minimum(255, 4 * np.log2(np.maximum(total, 1))), 0).astype(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([levels.tobytes()], pa.binary())], names=["block", "levels"]
        )


def frequency_estimate(counted: DataFrame) -> np.ndarray:
    """By counter, the level of the frequency of its shingles; 0 where nothing is known to be frequent."""
    spread = counted.withColumn("spread", F.spark_partition_id() % 8).repartition("block", "spread")
    partly = spread.select("block", "counters", "counts").mapInArrow(_add_sparse, "block int, counters binary, counts binary")
    merged = partly.repartition(BLOCKS, "block").mapInArrow(_add_levels, "block int, levels binary")
    levels = np.zeros((BLOCKS, (1 << COUNTER_BITS) // BLOCKS), dtype=np.uint8)
    for row in merged.collect():
        levels[row["block"]] = np.frombuffer(row["levels"], dtype=np.uint8)
    return levels.reshape(-1)


def least_matches(n: int) -> int:
    """The matches that every set of n shingles asks for at least: where the cost is least without frequent shingles."""
    return max(1, math.isqrt(n))


def matches_to_ask(frequencies: np.ndarray, n: int, percent: int = PERCENT) -> int:
    """The number of prefix matches with the least estimated cost, given frequencies from rare to frequent.

    Reading the postings of a prefix costs their number; of the documents read, at most that number divided by the
    matches asked for can have enough matches to be compared.
    """
    overlap = least_overlap(n, percent)
    least = least_matches(n)
    most = max(least, min(MOST_MATCHES, overlap))
    start = n - overlap + 1
    prefix = frequencies[:start + most - 1]
    if most == least or not prefix.any():
        return least
    read = np.cumsum(prefix + 1.0)[start + least - 2:]
    asked = np.arange(least, least + len(read))
    return int(np.argmin(read + COMPARE_COST * read / asked)) + least


def _postings(frequency, percent: int):
    """Prefix shingles of each distinct set of the task: token, key and packed size.

    The packed size holds n (32 bits), the matches to ask for (31 bits) and whether the token is known to be frequent (1 bit).
    """

    def run(batches):
        estimate = frequency.value
        seen: set[int] = set()
        tokens, keys, sizes, held = [], [], [], 0
        for batch in pieces(batches):
            for text in batch.column(0).to_pylist():
                hashes = shingle_set(text or "")
                key = set_key(hashes)
                if key is None or key in seen:
                    continue
                seen.add(key)
                n = len(hashes)
                often = estimate[_counter(hashes)]
                order = np.argsort(often, kind="stable")
                asked = matches_to_ask(FREQUENCY[often[order]], n, percent)
                order = order[:n - least_overlap(n, percent) + asked]
                tokens.append(hashes[order])
                keys.append(np.full(len(order), key, dtype=np.int64))
                sizes.append((n << 32) + asked * 2 + (often[order] > 0).astype(np.int64))
                held += len(order)
                if held >= POSTINGS_AT_ONCE:
                    yield _posting_batch(tokens, keys, sizes)
                    tokens, keys, sizes, held = [], [], [], 0
        if held:
            yield _posting_batch(tokens, keys, sizes)

    return run


def _posting_batch(tokens, keys, sizes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(keys)), pa.array(np.concatenate(sizes))],
        names=["token", "key", "size"],
    )


def _members(frequency):
    """Every shingle of the sets: token, key and packed size (n, no matches, whether the token is known to be frequent)."""

    def run(batches):
        estimate = frequency.value
        for batch in pieces(batches):
            tokens, keys, sizes, held = [], [], [], 0
            for key, hashes in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes = np.frombuffer(hashes.as_buffer(), dtype=np.uint64)
                tokens.append(hashes)
                keys.append(np.full(len(hashes), key, dtype=np.int64))
                sizes.append((len(hashes) << 32) + (estimate[_counter(hashes)] > 0).astype(np.int64))
                held += len(hashes)
                if held >= POSTINGS_AT_ONCE:
                    yield _posting_batch(tokens, keys, sizes)
                    tokens, keys, sizes, held = [], [], [], 0
            if held:
                yield _posting_batch(tokens, keys, sizes)

    return run


def _similar(percent: int):
    """The pairs whose exact similarity is high enough."""

    def run(batches):
        for batch in pieces(batches):
            kept = []
            for i in range(batch.num_rows):
                one = np.frombuffer(batch.column(2)[i].as_buffer(), dtype=np.uint64)
                other = np.frombuffer(batch.column(3)[i].as_buffer(), dtype=np.uint64)
                both = len(np.intersect1d(one, other, assume_unique=True))
                kept.append(100 * both >= percent * (len(one) + len(other) - both))
            chosen = batch.filter(pa.array(kept, pa.bool_()))
            yield pa.RecordBatch.from_arrays([chosen.column(0), chosen.column(1)], names=["a", "b"])

    return run


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    sets = sets.join(keys, "key", "left_semi")
    one = sets.select(F.col("key").alias("a"), F.col("hashes").alias("one"))
    other = sets.select(F.col("key").alias("b"), F.col("hashes").alias("other"))
    return pairs.join(one, "a").join(other, "b").select("a", "b", "one", "other").mapInArrow(_similar(percent), "a long, b long")


def _n(size: str):
    return F.expr(f"shiftright({size}, 32)")


def _k(size: str):
    return F.expr(f"shiftright({size}, 1) % 2147483648")


def _least_overlap(n, percent: int):
    return F.ceil(n * percent / F.lit(100))


def _unjoined(n, percent: int):
    """How many of a set's most frequent shared shingles are not joined on: any partner has more matches than that."""
    smallest = _least_overlap(n, percent)
    # the square root is exact: whole numbers below 2^52
    return F.greatest(F.floor(F.sqrt(smallest)), F.lit(1)) - 1


def _overlap(percent: int):
    """Shingles that the sets of a similar pair of packed sizes have in common at least."""
    return F.ceil(percent * (_n("size_a") + _n("size_b")) / F.lit(100 + percent))


def _meets(percent: int):
    """Whether sets of the two packed sizes can be similar at all, and the shingle stands in the prefix of both for this pair."""
    n_a, n_b = _n("size_a"), _n("size_b")
    beyond = F.least(_k("size_a"), _k("size_b")) - _overlap(percent)
    return (
        (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b))
        & (F.col("place_a") <= n_a + beyond) & (F.col("place_b") <= n_b + beyond)
    )


def _enough(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with enough matches, from one row (a, b, size_a, size_b) for each common joined shingle that ``_meets``.

    A similar pair has at least k of its overlap in the first n - overlap + k of both sets. With k the smaller of both
    demands these prefixes end no later than those that the sets chose, so what is missing are at most those of the last
    unjoined shingles that still stand in them.
    """
    # a pair may come in either order, from one token this way and from another that way
    swap = F.col("a") > F.col("b")
    pairs = pairs.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
        F.when(swap, F.col("size_b")).otherwise(F.col("size_a")).alias("size_a"),
        F.when(swap, F.col("size_a")).otherwise(F.col("size_b")).alias("size_b"),
    )
    counted = pairs.groupBy("a", "b", "size_a", "size_b").agg(F.count(F.lit(1)).alias("matches"))
    asked = F.least(_k("size_a"), _k("size_b"))
    missing = [
        _unjoined(_n(size), percent) - (_overlap(percent) - _least_overlap(_n(size), percent)) - (_k(size) - asked)
        for size in ("size_a", "size_b")
    ]
    return counted.filter(F.col("matches") >= asked - F.greatest(*missing, F.lit(0))).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles and component_id.

    Two documents are linked when their sets of distinct five-word shingles have a Jaccard similarity of ``percent``
    or more; component_id is the smallest id reachable over links. Words are what stands between ASCII white space,
    with A-Z in lower case; a text with fewer words is one shingle. A text without words, or null, has no shingle and
    no links, and its component is its own id. Null ids take part as documents without an id: they carry links, but
    their component is the smallest id that is not null, if there is one. Repeated rows have equal sets and so one
    component. Other columns are ignored. The join runs when this is called; sets are told apart by 64-bit keys.
    """
    text = F.col(f"`{text_col}`").cast("string")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("code"), text.alias("text"))
    kind = dict(texts.dtypes)["id"]
    profiled = stage(
        texts.mapInArrow(_profiles, f"id {kind}, code long, n long, key long, block int, counters binary, counts binary"),
        "jaccard-profiles",
    )
    rows = profiled.filter("block is null").select("id", "code", "n", "key")
    labels = _labels(texts, rows, profiled.filter("block is not null").select("block", "counters", "counts"), percent)
    classes = rows.filter("key is not null").groupBy("key").agg(F.min("id").alias("least"))
    named = classes.join(labels, classes["key"] == labels["node"], "left").select(
        "key", "least", F.coalesce("label", "key").alias("label")
    )
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    found = named.join(least, "label").select("key", "component_id")
    answered = rows.filter("key is not null").join(found, "key").select("id", "n", "component_id")
    alone = rows.filter("key is null").select("id", "n", F.col("id").alias("component_id"))
    return answered.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _labels(texts: DataFrame, rows: DataFrame, counted: DataFrame, percent: int) -> DataFrame:
    """node and label of every class that is linked with another."""
    spark = texts.sparkSession
    frequency = spark.sparkContext.broadcast(frequency_estimate(counted))
    postings = texts.select("text").mapInArrow(_postings(frequency, percent), "token long, key long, size long")
    shared = _shared(postings).groupBy("key", "size").agg(F.count(F.lit(1)).alias("shared"))
    kept = stage(shared.filter(F.col("shared") > _unjoined(_n("size"), percent)).select("key"), "jaccard-kept")
    sets = _sets(texts, rows, kept)
    members = sets.mapInArrow(_members(frequency), "token long, key long, size long")
    shared = stage(_prefixes(_shared(members, exact=True), percent), "jaccard-postings")
    frequency.unpersist()
    active = stage(shared.filter(F.col(SKETCH[0]).isNotNull()).select("key", *SKETCH), "jaccard-keys")
    shared = shared.drop(*SKETCH)
    label = active.select(F.col("key").alias("node"), F.col("key").alias("label"))
    links, round_ = None, 0
    while True:
        last = round_ >= len(HUBS)
        open_ = stage(_open_lists(shared, label), "jaccard-open")
        pairs = _all_pairs(open_, active, percent) if last else _hub_pairs(open_, round_, percent)
        pairs = stage(_enough(pairs, percent), "jaccard-pairs")
        new = stage(_compared(pairs, sets, percent), "jaccard-links")
        found = not new.isEmpty()
        if found:
            links = new if links is None else stage(links.unionByName(new), "jaccard-links")
            joined = components(links)
            label = stage(
                active.join(joined, active["key"] == joined["node"], "left").select(
                    F.col("key").alias("node"), F.coalesce("label", "key").alias("label")
                ),
                "jaccard-labels",
            )
        if last:
            return label
        round_ = round_ + 1 if found else len(HUBS)


def _shared(postings: DataFrame, exact: bool = False) -> DataFrame:
    """token, key, size and n, the number of sets, of the tokens that more than one set has.

    A frequent token may be hot and is known to be shared; its sets are only counted if ``exact``, on the map side first.
    Of the others, one sort finds the shared ones.
    """
    rare = postings.filter("size % 2 = 0")
    token = W.partitionBy("token")
    rare = rare.select("*", F.min("key").over(token).alias("low"), F.max("key").over(token).alias("high"), F.count("key").over(token).alias("n"))
    rare = rare.filter("low <> high").drop("low", "high")
    often = postings.filter("size % 2 = 1")
    if exact:
        often = often.join(often.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "token")
    else:
        often = often.withColumn("n", F.lit(1 << 62))
    both = rare.unionByName(often).select("token", "key", F.expr("size - size % 2").alias("size"), "n")
    return both if exact else both.distinct()


def _sketch(over) -> list:
    """The words of a set's sketch: every bit is the parity of the shared tokens that fall on it."""
    bit = F.expr("shiftleft(1L, cast(token & 63 as int))")
    word = F.expr(f"pmod(shiftright(token, 6), {len(SKETCH)})")
    return [F.bit_xor(F.when(word == i, bit).otherwise(F.lit(0))).over(over).alias(name) for i, name in enumerate(SKETCH)]


def _prefixes(shared: DataFrame, percent: int) -> DataFrame:
    """Of sets that share enough of their shingles, those to join on: token, key, size and how many the set shares.

    ``shared`` holds the shared tokens of whole sets with exact counts. What a set does not share comes first in its order,
    so the place of a shared token decides for how many matches a prefix that ends there may ask. The costs are those of
    ``matches_to_ask``. The row of a set's first shared token, which is always joined on if any is, also holds the sketch
    of all that the set shares.
    """
    n, overlap = _n("size"), _least_overlap(_n("size"), percent)
    of_set = W.partitionBy("key")
    in_order = of_set.orderBy("n", "token").rowsBetween(W.unboundedPreceding, 0)
    placed = shared.select(
        "token", "key", "size", F.row_number().over(of_set.orderBy("n", "token")).alias("place"),
        F.count(F.lit(1)).over(of_set).alias("shared"), F.sum("n").over(in_order).alias("read"),
    ).filter(F.col("shared") >= overlap)
    asked = F.col("place") - F.col("shared") + overlap
    cost = F.when(asked >= F.greatest(F.floor(F.sqrt(n)), F.lit(1)), F.col("read") * (1 + COMPARE_COST / asked))
    costed = placed.withColumn("asked", asked).withColumn("cost", cost)
    chosen = costed.select("*", F.min_by("asked", "cost").over(of_set).alias("chosen"), *_sketch(of_set))
    joined = chosen.filter(F.col("asked") <= F.col("chosen") - _unjoined(n, percent))
    return joined.select(
        "token", "key", (F.col("size") + 2 * F.col("chosen")).alias("size"), "shared",
        (F.col("asked") + n - overlap).cast("int").alias("place"),
        *(F.when(F.col("place") == 1, F.col(name)).alias(name) for name in SKETCH),
    )


def _sets(texts: DataFrame, rows: DataFrame, keys: DataFrame) -> DataFrame:
    """key and hashes of the classes, each from the text of one row; rows without an id are told apart by their texts."""
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "code")).alias("row")
    chosen = rows.join(keys, "key", "left_semi").groupBy("key").agg(first)
    chosen = broadcast_if_small(
        stage(chosen.select("key", F.col("row.id").alias("chosen"), F.col("row.code").alias("of_text")), "jaccard-chosen")
    )
    brought = texts.join(chosen, texts["id"].eqNullSafe(chosen["chosen"]) & (texts["code"] == chosen["of_text"])).select("key", "text")
    sets = brought.mapInArrow(_checked_sets, "key long, hashes binary")
    return stage(sets.groupBy("key").agg(F.first("hashes").alias("hashes")), "jaccard-sets")


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast if a count has shown that it fits."""
    return F.broadcast(df) if df.count() <= rows else df


def _checked_sets(batches):
    """key and set of rows (key, text), once for the copies in a task; a row whose text is another one is left out."""
    seen: set[int] = set()
    for batch in pieces(batches):
        keys, sets = [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if key in seen:
                continue
            hashes = shingle_set(text or "")
            if set_key(hashes) == key:
                seen.add(key)
                keys.append(key)
                sets.append(hashes.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], names=["key", "hashes"])


def _open_lists(shared: DataFrame, label: DataFrame) -> DataFrame:
    """Postings of tokens that classes of different components share, with their components."""
    named = shared.join(label, shared["key"] == label["node"]).select("token", "key", "size", "shared", "place", "label")
    spread = named.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    return named.join(spread.select("token"), "token")


def _hub_pairs(open_: DataFrame, round_: int, percent: int) -> DataFrame:
    """Every posting with the hubs of its token.

    The first hub is the class that has most shingles in common with others, as the original of many copies has; the
    later ones are those whose keys have the least hashes, by other hashes in each round.
    """
    what = F.struct("key", "size", "place", "label")
    if round_ == 0:
        chosen = [F.max_by(what, F.struct("shared", "key"))]
    else:
        chosen = [F.min_by(what, F.xxhash64(F.col("key"), F.lit(100 * round_ + i))) for i in range(HUBS[round_])]
    hubs = open_.groupBy("token").agg(F.array_distinct(F.array(*chosen)).alias("hubs"))
    pairs = open_.join(hubs, "token").select("key", "size", "place", "label", F.explode("hubs").alias("hub")).filter("label <> hub.label")
    return pairs.select(
        F.col("key").alias("a"), F.col("hub.key").alias("b"), F.col("size").alias("size_a"), F.col("hub.size").alias("size_b"),
        F.col("place").alias("place_a"), F.col("hub.place").alias("place_b"),
    ).filter(_meets(percent)).select("a", "b", "size_a", "size_b")


def _may_overlap(percent: int):
    """Whether two sets can have enough in common by their sketches.

    A bit in which the sketches differ stands for one token at least that only one of the sets has. The rest of what both
    share with others, two of each common token, is therefore no less than twice the overlap of a similar pair.
    """
    apart = sum((F.bit_count(F.col(f"{name}_a").bitwiseXOR(F.col(name))) for name in SKETCH), F.lit(0))
    return apart <= F.col("shared_a") + F.col("shared") - 2 * _overlap(percent)


def _all_pairs(open_: DataFrame, active: DataFrame, percent: int) -> DataFrame:
    """All pairs of a token's postings from different components that can be similar by the sketches of ``active``.

    One side is what is outside a token's largest component, so that a large component costs its size times the few
    others, not its square. Copies that differ from each other in other places meet on most of what their group has in
    common; their sketches tell them apart, so they make no rows.
    """
    counted = open_.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = counted.groupBy("token").agg(F.max_by("label", F.struct("n", "label")).alias("main"))
    tagged = open_.join(largest, "token").join(broadcast_if_small(active, BROADCAST_SKETCHES), "key")
    one = tagged.filter("label <> main").select(
        "token", F.col("key").alias("a"), F.col("size").alias("size_a"), F.col("place").alias("place_a"), F.col("label").alias("label_a"),
        *(F.col(name).alias(f"{name}_a") for name in ("shared", *SKETCH)),
    )
    other = tagged.select(
        "token", F.col("key").alias("b"), F.col("size").alias("size_b"), F.col("place").alias("place_b"), "label", "main", "shared", *SKETCH
    )
    met = one.join(other, "token").filter("label_a <> label and (label = main or a < b)").filter(_meets(percent))
    return met.filter(_may_overlap(percent)).select("a", "b", "size_a", "size_b")
