"""Ranked search, resampling and sharding against plain Python on small, odd tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from zonewise.llm import lexical, order, resample, shards

LOWER = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Columns beside id and text have names that the operators use themselves.
DOCS = "doc_id bigint, text string, key bigint, t string, n bigint, shard int, slot bigint, score bigint, rank int, place int, hub int"
ITEMS = "item_id bigint, text string, doc_id int, q int, score int"


def words(text):
    return TERM.findall((text or "").encode().translate(LOWER))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2, 3, 4, 5, 6, 7, 8) for i, t in rows], DOCS).repartition(3)


def items(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], ITEMS)


def odd_texts(seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdéß") for _ in range(rng.randint(1, 4))) for _ in range(90)]
    word = lambda: vocabulary[min(int(rng.expovariate(0.05)), 89)]
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 70)))) for i in range(80)]
    rows += [(100 + k, rows[5][1]) for k in range(30)] + [(rows[6][0], rows[6][1])] * 2 + [(7, "another text of an id")]
    rows += [(200, None), (201, ""), (202, " \n-"), (None, rows[5][1]), (None, "no id a b c"), (203, "Ab,aB_AB"), (204, "é É"),
             (205, "w" * 500 + " " + "w" * 500), (206, "a " * 5000), (207, " ".join(f"u{k}" for k in range(4000)))]
    return rows


# op11

def ranked(rows, asked, k):
    docs = [(i, collections.Counter(words(t))) for i, t in rows]
    docs = [(i, c, c.total()) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for *_, n in docs)
    df = collections.Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in asked:
        scores = []
        for i, c, n in docs:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t in words(text) if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, place + 1, None if none else i, -s) for place, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("limits", [{}, {"ITEMS": 3, "_BLOCK_ROWS": 7, "_COUNTED": 50, "_LOOKED_UP": 4, "BROADCAST_ROWS": 0}, {"KEY_BITS": 1, "HASHES": 1}])
def test_ranked_search(spark, monkeypatch, limits):
    rows = odd_texts(1)
    asked = [(k, rows[k * 3][1]) for k in range(8)] + [(50, None), (51, ""), (52, "unheard of"), (3, rows[9][1]), (3, rows[9][1]), (None, "a b c"),
                                                       (53, "w" * 500), (54, rows[11][1] + " " + rows[11][1]), (55, "AB é")]
    for name, value in limits.items():
        monkeypatch.setattr(lexical, name, value)
    got = [tuple(r) for r in lexical.ranked(documents(spark, rows), items(spark, asked), 5).collect()]
    assert sorted(got, key=repr) == ranked(rows, asked, 5)


def test_ranked_search_of_nothing(spark):
    docs, asked = documents(spark, [(1, "a b")]), items(spark, [(1, "a")])
    assert lexical.ranked(docs.filter("false"), asked).count() == 0
    assert lexical.ranked(docs, asked.filter("false")).count() == 0
    assert lexical.ranked(documents(spark, [(1, None), (2, "--")]), asked).count() == 0
    assert lexical.ranked(docs.filter("false"), asked).columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_are_never_too_low():
    rows = [(i, (t or "").encode()) for i, t in odd_texts(2)]
    held = []
    for i, t in rows:
        found = lexical.terms_of(t)
        if found:
            counts = np.fromiter(found.values(), np.int64, len(found))
            held.append((i, 0, int(counts.sum()), lexical.T.word_hashes(list(found)), counts))
    (block,) = lexical._block(held).to_pylist()
    asked = [lexical.terms_of(t) for _, t in rows[:20]]
    terms = sorted({t for c in asked for t in c})
    at = {t: k for k, t in enumerate(terms)}
    of = [(np.array([at[t] for t in c], np.int64), np.array(list(c.values()), np.int64)) for c in asked]
    found = lexical.Items(list(range(20)), terms, of, len(held), sum(h[2] for h in held), np.arange(1, len(terms) + 1))
    bound = found.bounds(block["sizes"], block["classes"], block["slices"])
    texts = [t for _, t in rows if lexical.terms_of(t)]
    exact = np.array([[found.score(q, lexical.terms_of(t), found.norm(lexical.terms_of(t).total())) for t in texts] for q in range(20)])
    assert (bound >= exact).all() and (bound > 0).mean() < 0.99 and (exact > 0).any()


# op13

def drawn(rows, target, percent, least):
    features = lambda t: (w := words(t)) and w + [a + b" " + b for a, b in zip(w, w[1:])]
    bucket = lambda x: zlib.crc32(x) % 10_000
    source, wanted = (collections.Counter(bucket(f) for _, t in x for f in features(t)) for x in (rows, target))
    all_source, all_wanted = source.total() + 10_000, wanted.total() + 10_000
    gain = lambda k: math.floor(1000 * math.log((wanted[k] + 1) * all_source / ((source[k] + 1) * all_wanted)))
    out = []
    for i, t in rows:
        found = [gain(bucket(f)) for f in features(t)]
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words(t)), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, r in enumerate(able):
        r.append(place + 1 if place < percent * len(able) // 100 else None)
    return sorted((tuple(r) if len(r) == 6 else (*r, None) for r in out), key=repr)


@pytest.mark.parametrize("size", [1 << 20, 100])
def test_resampling(spark, monkeypatch, size):
    monkeypatch.setattr(resample, "PART_BYTES", size)
    monkeypatch.setattr(resample.T, "PART_BYTES", size)
    rows = odd_texts(3)
    target = [(k, rows[k * 5][1]) for k in range(9)] + [(90, None), (91, "")]
    got = resample.resampled(documents(spark, rows), items(spark, target), 40, 10)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == drawn(rows, target, 40, 10)


def test_resampling_of_nothing(spark):
    docs, target = documents(spark, [(1, "a b " * 20), (2, "c")]), items(spark, [(1, "a")])
    assert resample.resampled(docs.filter("false"), target).count() == 0
    rows = resample.resampled(docs, target.filter("false"), 100).collect()
    assert sorted((r.doc_id, r["rank"]) for r in rows) == [(1, 1), (2, None)]


def test_text_in_pieces_has_the_same_features(monkeypatch):
    text = " ".join(f"w{k % 50}" for k in range(900)).encode()
    (whole,) = resample._stretches([text])
    one, _ = resample._features(whole, 10_000)
    want = np.bincount(one.bucket, one.count, 10_000)
    monkeypatch.setattr(resample.T, "PART_BYTES", 300)
    monkeypatch.setattr(resample.T.pieces, "__defaults__", (300,))
    monkeypatch.setattr(resample, "PART_BYTES", 500)
    cut = [resample._features(s, 10_000)[0] for s in resample._stretches([text]) if s]
    assert len(cut) > 3 and (sum(np.bincount(c.bucket, c.count, 10_000) for c in cut) == want).all()


def test_equal_hashes_of_different_words_get_slots_of_their_own():
    data = b"alpha omega alpha omegas alphas"
    starts, ends = np.array([0, 6, 12, 18, 25]), np.array([5, 11, 17, 24, 31])
    found = resample.Interned(data, starts, ends, np.full(5, 7, np.uint64), 10_000)
    assert found.slot[0] == found.slot[2] and len(set(found.slot.tolist())) == 4
    assert [int(found.bucket[s]) for s in found.slot] == [zlib.crc32(data[a:b]) % 10_000 for a, b in zip(starts, ends)]
    assert found.count[found.slot].tolist() == [2, 1, 2, 1, 1]


# op12

def split_groups(rows):
    at = collections.defaultdict(collections.Counter)
    for r, group in rows:
        at[group][r.shard] += 1
    return [c for c in at.values() if c.total() > 1 and len(c) > 1]


def sharded(spark, rows, n, **more):
    got = shards.sharded(documents(spark, rows), n, **more).collect()
    texts = collections.defaultdict(set)
    for i, t in rows:
        texts[len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), i].add(t or "")
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows if i is not None)
    counts = collections.Counter(r.shard for r in got)
    assert len(got) == len(rows) and set(counts) <= set(range(n))
    assert max(counts.values()) - min(counts[k] for k in range(n)) <= 1
    for k in range(n):
        mine = sorted((r for r in got if r.shard == k), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(counts[k]))
        ids = [r.doc_id for r in mine if r.doc_id is not None]
        assert ids == sorted(ids) and all(r.doc_id is None for r in mine[len(ids):])
    return [(r, (r.size, r.text_crc32)) for r in got]


def test_shards_are_even_and_keep_groups_together(spark):
    rows = odd_texts(4) + [(1000 + k, f"copy {k // 4}") for k in range(160)]
    assert len(split_groups(sharded(spark, rows, 4))) <= 1
    assert sorted((r.doc_id or 0, r.shard) for r, _ in sharded(spark, rows, 4)) == sorted((r.doc_id or 0, r.shard) for r, _ in sharded(spark, rows, 4))


def test_a_group_of_half_the_rows_fills_shards(spark):
    rows = [(k, "the same") for k in range(200)] + [(200 + k, f"text {k}") for k in range(120)] + [(400 + k, f"pair {k // 2}") for k in range(80)]
    found = split_groups(sharded(spark, rows, 8))
    assert len(found) <= 3
    big = max(found, key=lambda c: c.total())
    assert len(big) <= 5  # 200 rows of one text and quotas of 50


def test_only_groups_leave_no_room(spark):
    """Without loose rows groups that don't fit are cut at the quotas' borders alone."""
    rows = [(k, f"group {k // 10}") for k in range(300)]
    assert len(split_groups(sharded(spark, rows, 7))) <= 14
    sharded(spark, [(k, "one text") for k in range(50)], 8)
    sharded(spark, [(1, "a"), (2, "b"), (3, "a")], 16)
    assert shards.sharded(documents(spark, [(1, "a")]).filter("false")).count() == 0


def test_groups_that_fit_are_not_cut(spark):
    """Only the text of half the rows is, and without loose rows the two groups of ten that fit no shard of 42 or 43."""
    rows = [(k, "the same 3") for k in range(200)] + [(200 + k, f"text 3 {k}") for k in range(120)] + [(400 + k, f"pair 3 {k // 2}") for k in range(80)]
    (big,) = split_groups(sharded(spark, rows, 8))
    assert big.total() == 200
    assert len(split_groups(sharded(spark, [(k, f"group {k // 10}") for k in range(300)], 7))) == 2


def test_groups_at_a_border_are_packed():
    room = [3, 9, 5]
    assert shards.packed({7: 5, 8: 2, 9: 4, 6: 10}, room) == {7: 2, 9: 1, 8: 0} and room == [3, 9, 5]
    assert shards.packed({}, [0, 0]) == {} and shards.packed({1: 1}, [0, 0]) == {}


def test_moves_stay_within_the_room():
    rng = np.random.default_rng(5)
    for _ in range(50):
        wanted, room = rng.integers(0, 1000, (6, 6)), rng.integers(-50, 200, 6)
        share = np.array(shards.granted(wanted.tolist(), room.tolist()))
        flow = wanted * share
        assert ((share >= 0) & (share <= 1)).all()
        assert (flow.sum(0) <= np.maximum(room + flow.sum(1), 0) + 1).all()


def test_links_through_several_hubs(spark):
    """A chain of hubs that share members comes together as far as the quotas allow."""
    rows = [(h, n) for h in range(12) for n in (3 * h, 3 * h + 1, 3 * h + 2, (3 * h + 3) % 36)]
    links = spark.createDataFrame([(h, n, n * 7919 % 101, xxhash.xxh64_intdigest(bytes([n])) % 4) for h, n in rows], "hub bigint, node bigint, pick bigint, shard int")
    cut = lambda x: sum(c - 1 for c in x.groupBy("hub").agg(F.countDistinct("shard").alias("c")).toPandas().c)
    found = shards.propagated(links, [12] * 4)
    assert cut(found) < cut(links)
    assert found.groupBy("node").agg(F.countDistinct("shard").alias("c")).filter("c > 1").count() == 0


# numbers

def test_numbers_of_rows(spark):
    rng = random.Random(6)
    rows = [(rng.choice([None, 0, 1, 1, 1, 2]), rng.randint(0, 50)) for _ in range(500)]
    table = spark.createDataFrame(rows, "g int, v int").repartition(5)
    got = sorted((tuple(r) for r in order.numbered(table, [F.col("v").desc()], by="g").collect()), key=repr)
    want, at = [], collections.Counter()
    for g, v in sorted(rows, key=lambda r: (repr(r[0]), -r[1])):
        want.append((g, v, at[g]))
        at[g] += 1
    assert got == sorted(want, key=repr)
    assert sorted(r.place for r in order.numbered(table, [F.col("v")]).collect()) == list(range(500))
    assert order.numbered(table.filter("false"), [F.col("v")]).count() == 0
