"""Ranked search by words: bit-sliced Bloom signatures bound every document's score, exact scores decide."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonewise.llm import text as T
from zonewise.session import checkpointed

K = 20
#: Bits of a signature for each key, and those that a key sets.
KEY_BITS, HASHES = 10, 4
#: Documents and keys of a block of signatures.
_BLOCK_ROWS, _BLOCK_KEYS = 1_024, 400_000
#: Terms counted in a task before it passes them on, and terms looked up in a block at a time.
_COUNTED, _LOOKED_UP = 200_000, 4_096
#: Items, and bytes of their texts, that go through the index together.
ITEMS, ITEM_BYTES = 1_000, 1 << 20
#: Candidates that are sent to every task; more are joined.
BROADCAST_ROWS = 1_000_000
_INDEX = pa.schema([
    ("ids", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("classes", pa.int32()),
    ("slices", pa.binary()), ("terms", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))])
_INDEX_DDL = "ids array<bigint>, keys array<bigint>, sizes array<bigint>, classes int, slices binary, terms array<binary>, counts array<bigint>"


def terms_of(text: bytes | None) -> Counter:
    """A text's terms, in lower case, and how often each occurs; very long ones by a digest."""
    found: Counter = Counter()
    for piece in T.pieces(text or b""):
        found.update(piece.translate(T.WORD_TABLE).split())
    for long in [t for t in found if len(t) > 64]:
        found[b"\0" + xxhash.xxh3_128_digest(long)] = found.pop(long)
    return found


def _rows_of(hashes: np.ndarray, level: int, height: int) -> np.ndarray:
    """(keys, HASHES): the slices of terms that occur 2^level times at least."""
    key = T.mix(hashes + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    step = T.mix(key) | np.uint64(1)
    return ((key[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) % np.uint64(height)).astype(np.int64)


def _block(docs: list[tuple]) -> pa.RecordBatch:
    """A block's slices: one bit a document, packed, for each row of the signatures."""
    ids, keys, sizes, hashes, counts = zip(*docs)
    at = np.repeat(np.arange(len(docs)), [len(h) for h in hashes])
    hashes, counts = np.concatenate(hashes), np.concatenate(counts)
    levels = int(counts.max()).bit_length()
    chosen = [np.flatnonzero(counts >= 1 << c) for c in range(levels)]
    most = int(sum(np.bincount(at[c], minlength=len(docs)) for c in chosen).max())
    height = -(-KEY_BITS * most // 64) * 64
    bits = np.zeros((height, len(docs)), bool)
    for level, rows in enumerate(chosen):
        bits[_rows_of(hashes[rows], level, height), at[rows][:, None]] = True
    return T.batch(_INDEX, [ids], [keys], [sizes], [levels], [np.packbits(bits, axis=1).tobytes()], [None], [None])


def _indexed(batches) -> Iterator[pa.RecordBatch]:
    held, weight, df = defaultdict(list), Counter(), Counter()
    for b in batches:
        for doc, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            found = terms_of(text.as_py())
            if not found:
                continue
            df.update(found.keys())
            counts = np.fromiter(found.values(), np.int64, len(found))
            # documents of like sizes share a block, so that its height suits them all
            like = len(found).bit_length()
            held[like].append((doc, key, int(counts.sum()), T.word_hashes(list(found)), counts))
            weight[like] += len(found)
            if len(held[like]) == _BLOCK_ROWS or weight[like] > _BLOCK_KEYS:
                yield _block(held.pop(like))
                del weight[like]
        if len(df) > _COUNTED:
            yield T.batch(_INDEX, *[[None]] * 5, [list(df)], [list(df.values())])
            df = Counter()
    for docs in held.values():
        yield _block(docs)
    yield T.batch(_INDEX, *[[None]] * 5, [list(df)], [list(df.values())])


def texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, key, t): a row's id, a hash of its text, and its text."""
    return docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.xxhash64(F.col(text).cast("binary")).alias("key"),
                       F.col(text).cast("binary").alias("t"))


def index(rows: DataFrame) -> DataFrame:
    """The signatures of `texts`, written as a table: blocks of documents, and rows of terms with the number of
    documents that hold them, part by part."""
    T.small_batches(rows.sparkSession)
    return checkpointed(rows.mapInArrow(_indexed, _INDEX_DDL), "signatures")


@dataclass
class Items:
    """Some items, and what scores them: different terms, their weights, and the terms of each item with repeats."""

    ids: list
    terms: list[bytes]
    of: list[tuple[np.ndarray, np.ndarray]]
    n_docs: int
    n_terms: int
    weights: np.ndarray | None = None

    def norm(self, size: int) -> int:
        return 75 + 25 * size * self.n_docs // self.n_terms

    def bounds(self, sizes: list[int], levels: int, slices: bytes) -> np.ndarray:
        """(items, documents of a block): a score that the exact one doesn't exceed.

        A document whose signature lacks a term at level c holds it fewer than 2^c times. Signatures show terms that
        aren't there, so levels are only ever too high.
        """
        n = len(sizes)
        bits = np.frombuffer(slices, np.uint8).reshape(-1, -(-n // 8))
        norms, size = np.array([self.norm(s) for s in sizes], np.int64), np.array(sizes, np.int64)
        out, below = np.zeros((len(self.ids), n)), np.zeros(n)
        steps = []
        for level in range(levels):
            most = np.minimum((2 << level) - 1, size)
            here = ((10**9 * most) // (1000 * most + 12 * norms)).astype(float)
            steps.append(here - below)
            below = here
        hashes = T.word_hashes(self.terms)
        for low in range(0, len(self.terms), _LOOKED_UP):
            found, alive = None, np.arange(low, min(low + _LOOKED_UP, len(self.terms)))
            for level in range(levels):
                seen = np.bitwise_and.reduce(bits[_rows_of(hashes[alive], level, len(bits))], axis=1)
                found = seen if found is None else found[kept] & seen
                kept = found.any(axis=1)
                alive = alive[kept]
                if not len(alive):
                    break
                held = np.unpackbits(found[kept], axis=1, count=n).astype(float)
                place = np.full(len(self.terms), -1)
                place[alive] = np.arange(len(alive))
                for q, (which, times) in enumerate(self.of):
                    at = place[which]
                    use = at >= 0
                    if use.any():
                        # whole numbers below 2^53, so exact
                        out[q] += (self.weights[which[use]] * times[use]) @ held[at[use]] * steps[level]
        return out

    def score(self, q: int, found: Counter, norm: int) -> int:
        total = 0
        for t, times in zip(*(x.tolist() for x in self.of[q])):
            tf = found.get(self.terms[t], 0)
            if tf:
                total += int(self.weights[t]) * times * (10**9 * tf // (1000 * tf + 12 * norm))
        return total


def _in_blocks(items: DataFrame, n_docs: int, n_terms: int) -> Iterator[Items]:
    """The items (item, t), a bounded number at a time."""
    def made(rows):
        known: dict[bytes, int] = {}
        of = []
        for _, found in rows:
            which = [known.setdefault(t, len(known)) for t in found]
            of.append((np.array(which, np.int64), np.array(list(found.values()), np.int64)))
        return Items([i for i, _ in rows], list(known), of, n_docs, n_terms)

    held, size = [], 0
    for r in items.toLocalIterator():
        text = bytes(r.t or b"")
        if held and (len(held) == ITEMS or size + len(text) > ITEM_BYTES):
            yield made(held)
            held, size = [], 0
        held.append((r.item, terms_of(text)))
        size += len(text)
    if held:
        yield made(held)


def _weights(table: DataFrame, items: Items) -> np.ndarray:
    """Of the block's terms, by the number of documents that hold them."""
    spark = table.sparkSession
    asked = spark.createDataFrame([(bytearray(t),) for t in items.terms], "term binary")
    counted = table.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).select(F.col("x.terms").alias("term"), F.col("x.counts").alias("n"))
    df = {bytes(r.term): r.n for r in counted.join(F.broadcast(asked), "term").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return np.array([math.floor(1000 * math.log((2 * items.n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in items.terms], np.int64)


def _likely(blocks: DataFrame, items: Items, k: int) -> DataFrame:
    """(q, doc, key): the k documents with the highest bounds for each item."""
    schema = pa.schema([("q", pa.int32()), ("bound", pa.float64()), ("doc", pa.int64()), ("key", pa.int64())])

    def one(batches):
        best: list[list[tuple]] = [[] for _ in items.ids]
        for b in batches:
            for r in b.to_pylist():
                bound = items.bounds(r["sizes"], r["classes"], r["slices"])
                ids, keys = r["ids"], r["keys"]
                for q, row in enumerate(bound):
                    floor = best[q][-1][0] if len(best[q]) == k else 0
                    at = np.flatnonzero((row > 0) & (row >= floor))
                    if len(at) > k:  # all of the highest, and of those that tie with the last
                        at = at[row[at] >= np.partition(row[at], -k)[-k]]
                    if len(at):
                        best[q] = sorted([*best[q], *((row[a], ids[a], keys[a]) for a in at.tolist())], key=_first)[:k]
        rows = [(q, *x) for q, found in enumerate(best) for x in found]
        yield T.batch(schema, *(zip(*rows) if rows else ([], [], [], [])))

    found = blocks.mapInArrow(one, "q int, bound double, doc bigint, key bigint")
    order = Window.partitionBy("q").orderBy(F.col("bound").desc(), F.col("doc").asc_nulls_last(), "key")
    return found.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).select("q", "doc", "key")


def _first(x: tuple) -> tuple:
    """Highest score first, then smallest id, rows without an id last."""
    return -x[0], x[1] is None, x[1] or 0


def _possible(blocks: DataFrame, items: Items, least: list[tuple]) -> DataFrame:
    """(q, doc, key): all documents whose bound does not prove that they come after an item's k-th known score."""
    schema = pa.schema([("q", pa.int32()), ("doc", pa.int64()), ("key", pa.int64())])

    def one(batches):
        for b in batches:
            for r in b.to_pylist():
                bound = items.bounds(r["sizes"], r["classes"], r["slices"])
                for q, row in enumerate(bound):
                    score, doc, _ = least[q]
                    at = [a for a in np.flatnonzero((row > 0) & (row >= score)).tolist()
                          if row[a] > score or _first((score, r["ids"][a])) <= _first((score, doc))]
                    if at:
                        yield T.batch(schema, [q] * len(at), [r["ids"][a] for a in at], [r["keys"][a] for a in at])

    return blocks.mapInArrow(one, "q int, doc bigint, key bigint")


def _scored(rows: DataFrame, asked: DataFrame, items: Items, k: int) -> DataFrame:
    """(q, doc, score) by whole texts: of the pairs (q, doc, key) that are asked for, a task's k best for each item."""
    schema = pa.schema([("q", pa.int32()), ("doc", pa.int64()), ("score", pa.int64())])

    def one(batches):
        best: list[list[tuple]] = [[] for _ in items.ids]
        for b in batches:
            for doc, text, asks in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                found = terms_of(text.as_py())
                norm = items.norm(found.total())
                for q in asks:
                    score = items.score(q, found, norm)
                    if score > 0 and (len(best[q]) < k or _first((score, doc)) < _first(best[q][-1])):
                        best[q] = sorted([*best[q], (score, doc)], key=_first)[:k]
        rows = [(q, doc, score) for q, found in enumerate(best) for score, doc in found]
        yield T.batch(schema, *(zip(*rows) if rows else ([], [], [])))

    asked = checkpointed(asked.distinct().groupBy("doc", "key").agg(F.collect_list("q").alias("asks")), "candidates") \
        .withColumnsRenamed({"doc": "of", "key": "of_key"})
    few = asked.count() <= BROADCAST_ROWS
    both = rows.join(F.broadcast(asked) if few else asked, rows.doc.eqNullSafe(asked.of) & (rows.key == asked.of_key))
    return both.select("doc", "t", "asks").mapInArrow(one, "q int, doc bigint, score bigint")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the highest scores above 0 for each row of `items`.

    The score adds, over an item's terms with repeats, weight * (10^9 tf div (1000 tf + 12 m)) in whole numbers, where
    the weight falls with the documents that hold the term and m grows with the document's size. An index of
    signatures is built in one pass over the documents: a task's blocks of documents, sliced by bit, with the levels 1,
    2, 4, ... of how often a term occurs. Items go through it in blocks. Weighted sums of slices bound each score; the
    k highest bounds are scored exactly, and then every document whose bound reaches the k-th of these scores (equal
    ones by id), so nothing is lost. Ties go by ascending doc_id, rows without an id last. Null and empty texts, of
    documents and items, have no terms. Repeated rows are rows of their own, items too. Other columns are not read.
    """
    rows = texts(docs, doc_id, text)
    table = index(rows)
    blocks = table.filter("slices IS NOT NULL").select("ids", "keys", "sizes", "classes", "slices")
    seen = blocks.select(F.size("sizes").alias("n"), F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("l")) \
        .agg(F.sum("n"), F.sum("l")).first()
    spark, out = docs.sparkSession, None
    asked = items.select(F.col(item_id).alias("item"), F.col(item_text).cast("binary").alias("t"))
    kind = asked.schema["item"].dataType.simpleString()
    for part in _in_blocks(asked, *seen) if seen[0] else ():
        part.weights = _weights(table, part)
        first = defaultdict(list)
        for r in _top(_scored(rows, _likely(blocks, part, k), part, k), k).collect():
            first[r.q].append((r.score, r.doc, True))
        least = [sorted(first[q], key=_first)[-1] if len(first[q]) == k else (0, None, False) for q in range(len(part.ids))]
        found = _top(_scored(rows, _possible(blocks, part, least), part, k), k)
        names = spark.createDataFrame(list(enumerate(part.ids)), f"q int, item_id {kind}")
        found = checkpointed(found.join(F.broadcast(names), "q").select(
            "item_id", "rank", F.col("doc").alias("doc_id"), "score"), "ranked")
        out = found if out is None else out.union(found)
    return out if out is not None else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
