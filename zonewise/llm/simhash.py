"""Near-duplicates by SimHash, found through the codewords of a covering code."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.llm import text as T
from zonewise.llm.components import bounded, components
from zonewise.session import checkpointed

SHINGLE, SEED, THRESHOLD = 3, 42, 3
BROADCAST_IDS = 1_000_000
_CODED = (1 << 31) - 1


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """64 bits: a bit is 1 if more than half of the shingles' hashes have it."""
    counts, total, tail = np.zeros(64, np.int64), 0, []
    for piece in T.pieces(text.lower() if text else b""):
        words = tail + piece.split()
        tail = words[-(size - 1):] if size > 1 else []
        shingles = map(b" ".join, zip(*(words[k:] for k in range(size))))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
        total += len(hashes)
        for at in range(0, len(hashes), 1 << 16):
            block = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED) if tail else 0
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fp) of every row with an id; a null or empty text has fingerprint 0. `fp` is signed."""
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("binary").alias("t"))
    return _printed(rows.filter("doc_id IS NOT NULL"))


def _printed(rows: DataFrame) -> DataFrame:
    """`rows`, whose columns are numbers and a binary `t` at the end, with `fp` in place of `t`."""
    T.small_batches(rows.sparkSession)
    names = rows.columns[:-1]
    schema = pa.schema([(c, pa.int64()) for c in [*names, "fp"]])

    def one(batches):
        for b in batches:
            prints = [fingerprint(t.as_py()) for t in b.column(len(names))]
            yield T.batch(schema, *b.columns[:-1], pa.array(np.array(prints, np.uint64).view(np.int64)))

    return rows.mapInArrow(one, ", ".join(f"{c} bigint" for c in schema.names))


def _syndrome(x: Column) -> Column:
    """Of 31 bits under the Hamming code: the (1-based) place of the bit that is off a codeword, or 0."""
    checks = [sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1) for k in range(5)]
    bits = [F.shiftleft(F.bit_count(x.bitwiseAND(F.lit(m))).bitwiseAND(F.lit(1)), k) for k, m in enumerate(checks)]
    return sum(bits[1:], bits[0])


def _flips(reach: int) -> list[list[int]]:
    """By syndrome: the flips of at most `reach` of the half's 32 bits that lead to a codeword."""
    out = []
    for s in range(32):
        near = [(1 << (s - 1) if s else 0)]
        pairs = [(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 32) if s and i < i ^ s and i != s and i ^ s]
        free = [f | 1 << 31 for f in near if f.bit_count() < reach]
        out.append(near + [*free, *pairs] * (reach > 1))
    return out


def _anchors(half: Column, index: Column, reach: int) -> Column:
    """Keys of the codewords within `reach` of a half: 31 bits of the Hamming code, whose covering radius is 1, and
    one bit that is free."""
    table = F.array(*[F.array(*[F.lit(f).cast("bigint") for f in flips]) for flips in _flips(reach)])
    flips = F.element_at(table, (_syndrome(half.bitwiseAND(F.lit(_CODED))) + 1).cast("int"))
    return F.transform(flips, lambda f: half.bitwiseXOR(f) + F.shiftleft(index.cast("bigint"), 32))


def links(prints: DataFrame) -> DataFrame:
    """Pairs (f, g), f < g, of different fingerprints in `prints` (column fp) that differ in 1 to 3 bits.

    Two such fingerprints differ in at most one bit in one of their halves. The anchors of a half are the codewords
    of a covering code of radius 1: each fingerprint is at home with its nearest anchor and is copied to all anchors
    within 1 + 1 bits, 17 at most, so that the two meet at the home of either. A pair that meets in both halves is
    kept for the first. Input fingerprints are different, so one has at most 43,744 partners, whatever the input's
    size. Neither side is sent to every task: Spark doesn't see that the copies are 17 times the rows it reads.
    """
    halves = prints.select("fp", F.posexplode(F.array(
        F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32))).alias("i", "half"))
    homes = halves.select(F.col("fp").alias("f"), F.col("i"), F.element_at(_anchors(F.col("half"), F.col("i"), 1), 1).alias("anchor"))
    copies = halves.select(F.col("fp").alias("g"), F.explode(_anchors(F.col("half"), F.col("i"), 2)).alias("anchor"))
    differ = F.col("f").bitwiseXOR(F.col("g"))
    in_first = F.bit_count(differ.bitwiseAND(F.lit(0xFFFFFFFF)))
    return homes.hint("merge").join(
        copies, (homes.anchor == copies.anchor) & (F.col("f") < F.col("g")) & (F.bit_count(differ) <= THRESHOLD)
        & ((F.col("i") == 0) == (in_first <= 1))
    ).select("f", "g")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): documents whose fingerprints link, directly or through others.

    component_id is the smallest doc_id of the group. Equal fingerprints are one node, named by its smallest doc_id,
    so copies are never paired. Null and empty texts have fingerprint 0 and link like any other; rows without an id
    take no part; a repeated id keeps a row per occurrence; other columns are not read; an empty table gives no
    rows.
    """
    prints = checkpointed(fingerprints(docs, id_column, text_column), "fingerprints")
    nodes = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    n = nodes.count()
    left, right = bounded(nodes.toDF("f", "u"), n), bounded(nodes.toDF("g", "v"), n)
    edges = links(nodes).join(left, "f").join(right, "g").select("u", "v")
    group = components(edges)
    found = nodes.join(bounded(group, group.count()), "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(bounded(found, n), "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each group of near-duplicates stays, as it is: that with the smallest id, rows without an id last,
    and the smallest hash of all its columns.

    Groups are components of linked fingerprints, so two texts under one id are judged each by itself, and of equal
    rows one stays. The rows that go are known by two hashes of their columns; these are sent to every task if they
    are at most BROADCAST_IDS, and joined otherwise. An empty table stays empty.
    """
    lead = "_" * (1 + max(map(len, docs.columns)))
    one, two, mark = lead + "one", lead + "two", lead + "mark"
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumns({one: F.xxhash64(*columns), two: F.xxhash64(F.lit("row"), *columns)})
    prints = checkpointed(_printed(marked.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(one).alias("one"), F.col(two).alias("two"),
        F.col(text_column).cast("binary").alias("t"))), "fingerprints")
    nodes = checkpointed(prints.select("fp").distinct(), "nodes")
    group = components(links(nodes).toDF("u", "v")).withColumnRenamed("node", "fp")
    rows = prints.join(bounded(group, group.count()), "fp", "left").select(F.coalesce("component", "fp").alias("group"), "doc_id", "one", "two") \
        .groupBy("group", "doc_id", "one", "two").agg(F.count("*").alias("n"))
    rows = checkpointed(rows, "groups")
    first = rows.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "one", "two")).alias("first"))
    judged = rows.join(bounded(first, rows.count()), "group").select(
        F.struct(F.col("one").alias("a"), F.col("two").alias("b")).alias(mark),
        ((F.col("one") == F.col("first.one")) & (F.col("two") == F.col("first.two"))).alias("stays"), "n")
    judged = checkpointed(judged.filter("NOT stays OR n > 1"), "copies")
    again = judged.filter("stays").count()
    found = judged.count()
    sent = lambda x: bounded(x.select(mark), found, BROADCAST_IDS)
    same = (F.col(one) == F.col(f"{mark}.a")) & (F.col(two) == F.col(f"{mark}.b"))
    kept = marked.join(sent(judged), same, "left_anti")
    if again:  # rows that are there more than once and stay, once each
        kept = kept.union(marked.join(sent(judged.filter("stays")), same, "left_semi").dropDuplicates([one, two]))
    return kept.select(*columns)
