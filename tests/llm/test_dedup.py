"""Exact and near duplicates, removal of repeated substrings: against brute force."""

import hashlib
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from rows import by_id
from xxhash import xxh3_64_intdigest

from seasonlens import session
from seasonlens.llm import exact_dedup, jaccard, repeats, substrings, suffixes
from seasonlens.llm.components import components
from seasonlens.llm.shingles import shingle_set

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sample_texts(seed, n=60):
    """Random texts with copies, near copies and shared passages."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(300)]
    passages = [" ".join(rng.choices(words, k=rng.randint(18, 45))) for _ in range(4)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.15:
            texts.append(rng.choice(texts))
        elif texts and kind < 0.35:
            old = rng.choice(texts).split(" ")
            old[rng.randrange(len(old))] = "changed"
            texts.append(" ".join(old))
        else:
            text = rng.choices(words, k=rng.randint(0, 120))
            if kind > 0.6:
                text.insert(rng.randint(0, len(text)), rng.choice(passages))
            texts.append(" ".join(text))
    return list(enumerate(texts))


# exact copies


def check_exact(rows, df):
    groups = {}
    for i, text in rows:
        groups.setdefault(text or "", []).append(i)
    found = sorted(df.collect(), key=repr)
    assert len(found) == len(rows)
    want = []
    for i, text in rows:
        ids = [x for x in groups[text or ""] if x is not None]
        keep = max(ids) if ids else None
        want.append((i, keep, len(groups[text or ""]), i == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def test_exact_copies(make):
    rows = [(i, text) for i, text in sample_texts(1)] + [(100, None), (101, "")]
    check_exact(rows, exact_dedup.exact_dedup(make(rows)))


def test_exact_copies_when_fingerprints_collide(make):
    rows = sample_texts(2)
    found = exact_dedup.exact_dedup(make(rows), fingerprint=lambda text: F.length(text) % 3, bucket_entries=2)
    check_exact(rows, found)


def test_exact_copies_of_awkward_rows(awkward, empty):
    found = exact_dedup.exact_dedup(awkward)
    check_exact([(r.doc_id, r.text) for r in awkward.collect()], found)
    assert exact_dedup.exact_dedup(empty).count() == 0
    stays = exact_dedup.deduplicated(awkward)
    assert stays.columns == awkward.columns
    assert sorted(r.doc_id for r in stays.collect()) == [2, 3, 6, 7, 7, 8, 9]


def test_directory_splits_overfull_buckets(spark):
    entries = spark.range(1000).select(F.xxhash64("id").alias("key"))
    cells = exact_dedup.directory(entries, 1000, bucket_entries=20)
    full = cells.first().full_depth
    sizes = (
        entries.withColumn("cell", exact_dedup.cell(F.col("key"), full)).join(cells, "cell").groupBy("bucket", "depth").count().collect()
    )
    assert sum(r["count"] for r in sizes) == 1000
    assert all(r["count"] <= 20 or r.depth == full for r in sizes)
    assert len({r.depth for r in sizes}) > 1


# near copies


def check_near(rows, df):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, text in rows:
        words = WORD.findall((text or "").translate(lower))
        sets[i] = {tuple(words[j:j + 5]) for j in range(max(1, len(words) - 4))} if words else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = list(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    found = by_id(df)
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("seed", [3, 4])
def test_near_copies(make, seed):
    rows = sample_texts(seed, 80)
    check_near(rows, jaccard.near_duplicates(make(rows)))


def test_group_of_near_copies_in_chains(make):
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(30):
        base = list(base)
        base[(7 * i) % 100] = f"x{i}"
        rows.append((i, " ".join(base)))
    check_near(rows, jaccard.near_duplicates(make(rows)))


def test_copies_that_differ_in_other_places_make_no_pairs(make, monkeypatch):
    rng = random.Random(6)
    rows, words = [], []
    for i in range(40):
        if i % 10 < 8:
            words = [f"w{j}" for j in range(120)]
            places = rng.sample(range(5, 115), 3)
        else:
            places = [rng.randrange(5, 115)]
        for at in places:
            words[at] = rng.choice("xy")
        rows.append((i, " ".join(words)))
    rounds, all_pairs = [], jaccard._all_pairs
    monkeypatch.setattr(jaccard, "_all_pairs", lambda *args: rounds.append(all_pairs(*args)) or rounds[-1])
    check_near(rows, jaccard.near_duplicates(make(rows)))
    assert [pairs.distinct().count() <= 100 for pairs in rounds] == [True]


def test_sketches_keep_every_pair(spark):
    rng = random.Random(8)
    pool = [rng.getrandbits(64) - (1 << 63) for _ in range(160)]
    sets = {key: set(rng.sample(pool, rng.randint(105, 155))) for key in range(1, 60)}
    rows = [(token, key, len(tokens) << 32, 2) for key, tokens in sets.items() for token in tokens]
    posted = jaccard._prefixes(spark.createDataFrame(rows, "token long, key long, size long, n long"), 75)
    sizes = by_id(posted.filter("sketch_0 is not null"), "key")
    assert sorted(sizes) == sorted(sets)
    one = spark.createDataFrame(
        [(k, r["size"], r.shared, *(r[name] for name in jaccard.SKETCH)) for k, r in sizes.items()], ["key", "size", "shared", *jaccard.SKETCH]
    )
    other = one.select(*(F.col(name).alias({"key": "a", "size": "size_a"}.get(name, f"{name}_a")) for name in one.columns))
    pairs = other.join(one.withColumnsRenamed({"key": "b", "size": "size_b"}), F.col("a") < F.col("b"))
    kept = {(r.a, r.b) for r in pairs.filter(jaccard._may_overlap(75)).collect()}
    similar = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert similar <= kept and similar and len(kept) < 59 * 29


def test_near_copies_of_awkward_rows(awkward, empty):
    found = jaccard.near_duplicates(awkward).collect()
    assert len(found) == awkward.count()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None}
    assert got[1] == (0, 1) and got[2] == (0, 2) and got[3] == (0, 3)
    assert got[4] == (1, 4) and got[7] == (1, 4) and got[5][1] == got[6][1] == 5
    assert {r.component_id for r in found if r.doc_id is None} == {4, None}
    assert jaccard.near_duplicates(empty).count() == 0


def test_matches_asked_for_keep_every_pair():
    rng = random.Random(5)
    import numpy as np

    for _ in range(300):
        n = rng.randint(1, 200)
        often = np.sort(np.array([rng.choice([0, 0, 0, 5, 1000]) for _ in range(n)]))
        asked = jaccard.matches_to_ask(often, n)
        assert jaccard.least_matches(n) <= asked <= max(jaccard.least_matches(n), jaccard.least_overlap(n))


def test_shingles_depend_on_word_order():
    assert len(shingle_set("a b b a c")) == 1
    assert shingle_set("a b b a c").tolist() != shingle_set("b a a b c").tolist()
    assert shingle_set("A b").tolist() == shingle_set("a\tB").tolist() != shingle_set("a b c").tolist()


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    found = components(spark.createDataFrame(links, "a long, b long"))
    want = {i: find(i) for pair in links if pair[0] != pair[1] for i in pair}
    assert {r.node: r.label for r in found.collect()} == want


# repeated words and bytes


def repeated_words(rows):
    seen, found = set(), {}
    for i, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for start in range(len(words) - 19):
            window = tuple(words[start:start + 20])
            if window in seen:
                gone[start:start + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        found[i] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return found


def repeated_bytes(rows):
    texts = {i: (text or "").encode() for i, text in rows}
    count = Counter(data[at:at + 200] for data in texts.values() for at in range(len(data) - 199))
    found = {}
    for i, data in texts.items():
        gone = [False] * len(data)
        for at in range(len(data) - 199):
            if count[data[at:at + 200]] > 1:
                gone[at:at + 200] = [True] * 200
        spans = sum(g and not (at and gone[at - 1]) for at, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        found[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return found


@pytest.mark.parametrize("group", [20_000, 3])
def test_repeated_words(make, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    rows = [*sample_texts(7), (200, "same word " * 40), (201, None), (202, "same " * 25)]
    found = by_id(substrings.remove_substrings(make(rows)))
    assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in found.items()} == repeated_words(rows)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in found.values())


@pytest.mark.parametrize("group", [20_000, 3])
def test_repeated_bytes(make, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    rows = [*sample_texts(8), (200, "ab" * 150), (201, None), (202, "z" * 450), (203, "é" * 120)]
    found = by_id(suffixes.remove_repeats(make(rows)))
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in found.items()} == repeated_bytes(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found.values())


@pytest.mark.parametrize("length, gram", [(20, 5), (200, 64), (6, 2)])
def test_anchors(length, gram):
    rng = random.Random(length)
    for _ in range(100):
        kinds = rng.choice([1, 2, 3, 1000])
        symbols = np.array([rng.randrange(kinds) for _ in range(rng.randint(0, 400))], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        grams = repeats.run_hashes(symbols, gram)
        want = []
        for start in range(len(symbols) - length + 1):
            place = start + int(grams[start:start + length - gram + 1].argmin())
            if want and want[-1][1] == place:
                want[-1][3] += 1
            else:
                want.append([int(grams[place]), place, start, 1])
        found = repeats.anchors(symbols, repeats.Windows(length, gram, None))
        assert [tuple(map(int, row)) for row in zip(*found)] == [(h, start, n) for h, _, start, n in want]


@pytest.mark.parametrize("remove", [substrings.remove_substrings, suffixes.remove_repeats])
@pytest.mark.parametrize("broadcast", [0, 500_000])
def test_no_group_of_a_hot_window_is_held_in_python(spark, make, monkeypatch, remove, broadcast):
    """A passage in every row: with more than GROUP rows, none of its windows may be gathered."""
    hot, largest = " ".join(f"w{i}" for i in range(60)), spark.sparkContext.accumulator(0)
    passage = [(i, f"{i} {hot} {i}") for i in range(40)] + [(None, hot), (None, hot), (3, f"3 {hot} 3")]
    monkeypatch.setattr(repeats, "GROUP", 10)
    monkeypatch.setattr(repeats, "BROADCAST_ROWS", broadcast)
    real = repeats._groups

    def counting(judge):
        def judged(rows):
            if len(rows) > 10:
                largest.add(1)
            return judge(rows)

        return real(judged)

    monkeypatch.setattr(repeats, "_groups", counting)
    found = {(r.doc_id, r.n_removed) for r in remove(make(passage)).collect()}
    assert largest.value == 0
    if remove is substrings.remove_substrings:
        assert found == {(None, 0), *[(i, 60) for i in range(40)]}
    else:
        assert {i for i, _ in found} == {None, *range(40)} and all(n >= len(hot) for _, n in found)


@pytest.mark.parametrize("group", [20_000, 3])
def test_texts_of_one_id_whose_hashes_begin_alike(make, monkeypatch, group):
    """Two texts without an id, equal in the first 23 bits of their hashes: only the one with the passage loses words."""
    monkeypatch.setattr(repeats, "GROUP", group)
    hot = " ".join(f"w{i:03}" for i in range(60))
    kinds = (lambda i: f"{hot} {i}", lambda i: " ".join(f"{i}x{j}" for j in range(45)))
    begin = {xxh3_64_intdigest(kinds[0](i).encode()) >> 41: kinds[0](i) for i in range(5000)}
    clean = next(text for text in map(kinds[1], range(100_000)) if xxh3_64_intdigest(text.encode()) >> 41 in begin)
    dirty = begin[xxh3_64_intdigest(clean.encode()) >> 41]
    rows = [(None, dirty), (None, clean), *[(i, f"{i} {hot}") for i in range(5)]]
    # equal windows of the rows without an id come first, so dirty keeps its words and clean has none to lose
    words = {r.n_words: r.n_removed for r in substrings.remove_substrings(make(rows + [(-1, hot)])).collect() if r.doc_id is None}
    assert words == {61: 0, 45: 0}
    bytes_ = {r.n_bytes: r.n_removed for r in suffixes.remove_repeats(make(rows)).collect() if r.doc_id is None}
    assert bytes_[len(clean)] == 0 and bytes_[len(dirty)] >= len(hot)
    later = [(1, hot), (2, dirty), (2, clean)]
    words = {(r.doc_id, r.n_words): r.n_removed for r in substrings.remove_substrings(make(later)).collect()}
    assert words == {(1, 60): 0, (2, 61): 60, (2, 45): 0}


def test_repeats_of_awkward_rows(awkward, empty):
    found = substrings.remove_substrings(awkward).collect()
    assert len(found) == awkward.count()
    got = {r.doc_id: r for r in found}
    assert got[1].n_words == got[2].n_words == got[3].n_words == 0
    assert got[6].n_removed == got[6].n_words and 0 < got[5].n_removed < got[5].n_words
    assert suffixes.remove_repeats(awkward).count() == awkward.count()
    assert substrings.remove_substrings(empty).count() == 0
    assert suffixes.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("size", [1, 7, 10_000])
def test_groups_are_judged_together(size):
    """Rows of many anchors, some repeated, judged in a few whole batches: what brute force picks of each row."""
    rng, rows = random.Random(size), []
    for anchor in range(30):
        texts = [bytes(rng.choice(b"ab") for _ in range(230)) for _ in range(2)]
        group = [(None if i == 5 else i, i.to_bytes(16, "big"), rng.randrange(2), rng.choice(texts)[:rng.randint(200, 230)]) for i in range(rng.randint(1, 6))]
        rows += [(anchor, *row) for row in sorted(group + group[:1], key=lambda row: (row[0] is not None, row[0] or 0))]
    kinds = {"anchor": pa.int64(), "id": pa.int64(), "tag": pa.binary(), "place": pa.int64(), "what": pa.binary()}
    batch = pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*rows), kinds.values())], names=list(kinds))
    whole = [part for part in repeats._whole((batch.slice(at, size) for at in range(0, len(rows), size)), 20)]
    assert pa.concat_batches(whole).equals(batch) and (2 < len(whole) < 15 if size == 10_000 else len(whole) <= 30)
    assert all(a["anchor"][-1] != b["anchor"][0] for a, b in zip(whole, whole[1:]))
    found = Counter()
    for part in repeats._groups(suffixes._again)(iter([batch])):
        for i, tag, starts in zip(*[column.to_pylist() for column in part.columns]):
            runs = np.frombuffer(starts, dtype="<i8").reshape(-1, 2).tolist()
            found[i, tag, tuple(start for first, count in runs for start in range(first, first + count))] += 1
    once = list(dict.fromkeys(rows))
    times = Counter((row[0], row[4][at:at + 200]) for row in once for at in range(len(row[4]) - 199))
    want = Counter()
    for anchor, i, tag, place, what in rows:
        starts = tuple(place + at for at in range(len(what) - 199) if times[anchor, what[at:at + 200]] > 1)
        want[i, tag, starts] += bool(starts)
    assert found == +want


def test_order_of_hashes_that_differ_in_the_last_bits():
    hashes = np.array([9, 8, 9, 1 << 60, 8, 9, (1 << 60) + 1, 1 << 60], dtype=np.uint64)
    order, same = repeats.in_order(hashes)
    assert order.tolist() == [1, 4, 0, 2, 5, 3, 7, 6] and same.tolist() == [True, False, True, True, False, True, False]
    assert repeats.in_order(hashes[:0])[0].tolist() == []


def test_staged_tables_are_removed_when_done_with(spark):
    folder = Path(session.staging_dir(spark))
    df = session.stage(spark.range(3), "numbers")
    assert df.count() == 3 and list(folder.glob("*/numbers-*"))
    session.unstage(df)
    session.unstage(spark.range(3))
    session.unstage(None)
    assert not list(folder.glob("*/numbers-*"))
