"""Resampling, BPE and hard negatives against brute force and the tokenizers library."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from rows import by_id

from seasonlens.llm import bpe, negatives, resample
from seasonlens.llm.queries import QUERIES, tokenizer

# resampling


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def buckets_of(text, buckets=10_000):
    words = words_of(text)
    return [zlib.crc32(" ".join(words[i:i + n]).encode()) % buckets for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def resampled(docs, target, percent=5, least=20):
    had = Counter(b for _, t in docs for b in buckets_of(t))
    want = Counter(b for t in target for b in buckets_of(t))
    s_all, t_all = had.total(), want.total()
    rows = []
    for i, text in docs:
        found = buckets_of(text)
        weight = sum(math.floor(1000 * math.log((want[b] + 1) * (s_all + 10_000) / ((had[b] + 1) * (t_all + 10_000)))) for b in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, len(words_of(text)) >= least])
    may = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    drawn = {id(r): at for at, r in enumerate(may[:percent * len(may) // 100], 1)}
    return [(*r[:4], drawn.get(id(r))) for r in rows]


TEXTS = [None, "", " .,; ", "One two THREE one two", "é" * 300 + " b " + "Z" * 5000 + " q", "a\x00b\x7fc ÀÉ àé", "x1 2y-3z"]


@pytest.mark.parametrize("text", TEXTS)
def test_features(text):
    of, found, words = resample.features([b"before it", (text or "").encode(), b"", b"after that"])
    assert sorted(found[of == 1].tolist()) == sorted(buckets_of(text))
    assert words.tolist() == [2, len(words_of(text)), 0, 2]


def test_shifts():
    rng = np.random.default_rng(1)
    lengths = np.array([*range(140), 1000, 65_537, 3_000_000])
    data = [rng.bytes(int(n)) for n in lengths]
    before = zlib.crc32(b"before")
    whole = np.array([zlib.crc32(b"before" + x) for x in data], dtype=np.uint32)
    found = whole ^ resample.shifts()(np.full(len(data), before, dtype=np.uint32), lengths)
    assert found.tolist() == [zlib.crc32(x) for x in data]


def test_resample(make):
    rng = random.Random(3)
    pool = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(pool, k=rng.randint(0, 60)))) for i in range(300)] + list(enumerate(TEXTS, 1000))
    docs += [(2000, docs[0][1] + " tail" * 20), (2001, docs[0][1] + " tail" * 20), (None, "no id " * 30)]
    target = make([(1, " ".join(pool[:9] * 3)), (2, None), (3, "")])
    found = resample.resample(make(docs), target, percent=30)
    key = lambda r: (r[0] is not None, r[0] or 0)
    want = resampled(docs, [" ".join(pool[:9] * 3), None, ""], 30)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)
    assert [f.dataType for f in found.schema][1:] == [T.LongType()] * 4


def test_resample_edges(awkward, empty):
    rows = resample.resample(awkward, empty).collect()
    assert len(rows) == awkward.count() and all(r.weight == 0 and r.n_features == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert resample.resample(empty, awkward).collect() == []


def test_repeated_rows_are_drawn_each(make):
    text = "same words here " * 10
    found = resample.resample(make([(7, text)] * 40), make([(1, "here")]), percent=50).collect()
    assert sorted(r.rank for r in found if r.rank) == list(range(1, 21)) and len(found) == 40


# BPE


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer("word_bpe_49k.json"))


def mixed_texts(n):
    rng = random.Random(n)
    pool = [chr(c) for c in (*range(0x500), 0x130, 0x3a3, 0x3c2, 0x2028, 0x3000, 0xac00, 0x1100, 0x1161, 0x301, 0x1f600, 0x200d, 0xfb01, 0x2126)]
    plain = "abcdefghijklmnop AB'sll \n"
    ends = ["", "<|endoftext|>", "<|startoftext|> x", "<|END", "<|endoftext|><|endoftext|>"]
    return ["".join(rng.choice(pool if rng.random() < 0.3 else plain) for _ in range(rng.randint(0, 60))) + rng.choice(ends) for _ in range(n)]


def test_encodes_as_the_library(make, library):
    texts = [*mixed_texts(1500), "aaaaaaaaaaa", "ababab" * 50, "x" * 50_000, "it's WE'LL 'S", "ΑΣ ΟΔΟΣ", "1234 5,6.7", "é é"]
    path = tokenizer("word_bpe_49k.json")
    found = by_id(bpe.decoded(bpe.encoded(make(list(enumerate(texts))), path), path))
    for i, text in enumerate(texts):
        want = library.encode(text, add_special_tokens=False).ids
        assert found[i].ids == want, text[:80]
        assert found[i].decoded == library.decode(want, skip_special_tokens=False)


def test_query_digests(spark, sf_dir, library):
    found = by_id(QUERIES["op13_bpe"](spark, sf_dir))
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        got = found[row.doc_id]
        assert got.n_tokens == len(ids) and got.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def merged_alone(word, rank_of):
    """The least rank first, from the left."""
    parts = list(word)
    while True:
        ranks = [(rank_of[pair], at) for at, pair in enumerate(zip(parts, parts[1:])) if pair in rank_of]
        if not ranks:
            return parts
        at = min(ranks)[1]
        parts[at:at + 2] = [parts[at] + parts[at + 1]]


def test_pair_index_of_any_merges():
    """Also merges that make one piece in two ways, so that lower ranks arise."""
    rng = random.Random(5)
    for _ in range(60):
        pieces, merges = list("abc"), []
        while len(merges) < 25:
            pair = (rng.choice(pieces), rng.choice(pieces))
            if pair not in merges and len(pair[0] + pair[1]) < 9:
                merges.append(pair)
                pieces.append(pair[0] + pair[1])
        rng.shuffle(merges)
        vocab = {piece: i for i, piece in enumerate(dict.fromkeys(pieces))}
        names = list(vocab)
        words = ["".join(rng.choices("abc", k=rng.randint(1, 14))) for _ in range(40)]
        rank_of = {pair: rank for rank, pair in enumerate(merges)}
        got = bpe.Merges(vocab, merges)(words)
        assert [[names[i] for i in ids] for ids in got] == [merged_alone(word, rank_of) for word in words]


def test_small_memory_gives_the_same(library):
    small = bpe.Bpe(tokenizer("word_bpe_49k.json"), limit=2000)
    texts = mixed_texts(400)
    found = [ids for at in range(0, 400, 7) for ids in small.encode(texts[at:at + 7])]
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_of_letters_are_merged_once_with_any_mark(library, monkeypatch):
    whole = bpe.Bpe(tokenizer("word_bpe_49k.json"))
    merged = []
    merge = whole.merge
    monkeypatch.setattr(whole, "merge", lambda words: (merged.extend(words), merge(words))[1])
    texts = ["Bretel, bretel. bretel! it's é, bretel.' bretel", "bretel? <|endoftext|> a1,", " ", "a\x00b \u0130", "ÀB, 'll. x\xb5;"]
    for _ in range(2):
        assert [ids.tolist() for ids in whole.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert merged.count("bretel") == 1 and not any("bretel" in part for part in whole.parts.known if part != "bretel.'")


def test_bpe_edges(awkward, empty):
    path = tokenizer("word_bpe_49k.json")
    found = bpe.decoded(bpe.encoded(awkward, path), path).collect()
    assert len(found) == awkward.count()
    assert all(r.ids == [] and r.decoded == "" for r in found if r.doc_id in (1, 2, 3))
    assert bpe.encoded(empty, path).collect() == []


def test_decode_ids_without_a_piece(library):
    names = bpe.names_of(tokenizer("word_bpe_49k.json"))
    ids = pa.array([[5, 99_999_999, 6], None, [], [-1]], pa.list_(pa.int64()))
    assert bpe.decode(names, ids).to_pylist() == [library.decode([5, 6]), None, "", ""]


# hard negatives


@pytest.mark.parametrize("m, k, n, leaf", [(1, 1, 1, 1), (7, 5, 9, 1), (33, 64, 70, 8), (64, 64, 64, 16), (3, 100, 2, 1)])
def test_strassen(m, k, n, leaf):
    rng = np.random.default_rng(m)
    a, b = rng.integers(-2**40, 2**40, (m, k)), rng.integers(-2**15, 2**15, (k, n))
    assert (negatives.strassen(a, b, leaf) == a @ b).all()


def test_heaps_merge():
    rng = np.random.default_rng(2)
    heaps, rows = negatives.Heaps(6, 4), [[] for _ in range(6)]
    for size in (1, 3, 50, 200, 2):
        scores, may, ids = rng.integers(-5, 5, (6, size)), rng.random((6, size)) < 0.7, rng.integers(0, 1000, size)
        heaps.offer(scores, may, ids)
        for i in range(6):
            rows[i] += [(-s, d) for s, d, ok in zip(scores[i], ids, may[i]) if ok]
    row, score, ids = heaps.entries()
    assert [[(-s, d) for r, s, d in zip(row, score, ids) if r == i] for i in range(6)] == [sorted(x)[:4] for x in rows]


def mined(rows, every=100):
    clean = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            clean.append((i, label, [math.floor(256 * x) for x in v]))
    out = set()
    for i, label, v in dict.fromkeys((i, label, tuple(v)) for i, label, v in clean if i % every == 0):
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, other) for j, other, w in clean)
        for score, j, _ in [s for s in scored if s[2] == label and s[1] != i][:5]:
            window = [s for s in scored if s[2] != label and -80 * score <= -100 * s[0] <= -100 * score]
            out |= {(i, j, rank, n, -score, -s) for rank, (s, n, _) in enumerate(window[:5], 1)}
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("score", F.lit("x")).withColumn("id", F.lit(1))


def test_hard_negatives(spark):
    rng = np.random.default_rng(4)
    rows = [(i, np.round(rng.normal(0.05, 0.2, 13), 2).astype(np.float32).tolist(), int(rng.integers(0, 3))) for i in range(900)]
    rows += [(i, rows[3][1], rows[3][2]) for i in range(1000, 1100)]  # one common vector
    rows += [(2000, None, 1), (2100, rows[0][1], None), (2200, [float("nan")] * 13, 1), (2300, [None] * 13, 1), (2400, [float("inf")] * 13, 2)]
    rows += [(None, rows[0][1], 1), (2500, [], 1), (2600, rows[1][1][:4], 0), (2700, rows[2][1], 2), (2700, rows[2][1], 2)]
    got = negatives.hard_negatives(vectors(spark, rows).repartition(5)).collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == mined(rows)


def test_hard_negatives_in_waves(spark, monkeypatch):
    """Small tiles, blocks and waves give the same."""
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0.1, 0.3, 5).astype(np.float32).tolist(), int(rng.integers(0, 2))) for i in range(300)]
    for name, value in (("TILE", 4), ("BLOCK", 16), ("WAVE_BYTES", 700), ("LEAF", 2)):
        monkeypatch.setattr(negatives, name, value)
    got = negatives.hard_negatives(vectors(spark, rows).repartition(3), every=10).collect()
    assert set(map(tuple, got)) == mined(rows, every=10)


def test_hard_negatives_edges(spark):
    assert negatives.hard_negatives(vectors(spark, [])).collect() == []
    assert negatives.hard_negatives(vectors(spark, [(1, [1.0], 1), (2, [1.0], 2)])).collect() == []
    with pytest.raises(ValueError):
        negatives.hard_negatives(vectors(spark, [(0, [1e30], 1)]))
