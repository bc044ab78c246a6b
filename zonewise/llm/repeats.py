"""Removal of repeated byte strings by prefix doubling over sampled positions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewise.llm import spans
from zonewise.llm import text as T
from zonewise.session import checkpointed

LENGTH = 400
#: One position in so many is an anchor, by the hash of its next bytes; strings are grouped by their distance from it.
EVERY, GRAM, BLOCK = 64, 16, 128
#: Text a bucket gets on average, rows of a bucket that a task sorts, bytes of a text looked at together.
BUCKET_BYTES, AT_ONCE, _SEGMENT, _PART_BYTES = 8 << 20, 4_000_000, 1 << 20, 4 << 20
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MATCHED, _OPEN = 0, 1
_PACKED_DDL = "bucket bigint, rows bigint, packed binary"
_PACKED = pa.schema([("bucket", pa.int64()), ("rows", pa.int64()), ("packed", pa.binary())])
_SPANS_DDL = "kind bigint, doc_id bigint, at bigint, n bigint"
_SPANS = pa.schema([(c, pa.int64()) for c in ("kind", "doc_id", "at", "n")])
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Rolling:
    """Hashes of any substring of `data`, from sums of its bytes times powers of an odd base (modulo 2^64)."""

    def __init__(self, data: np.ndarray, base: int) -> None:
        n = len(data) + 1
        if base not in _powers or len(_powers[base][0]) < n:
            size = max(n, 1 << 16)
            back = pow(base, -1, 1 << 64)
            _powers[base] = tuple(
                np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)))) for b in (base, back))
        up, self.back = _powers[base]
        self.sums = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n - 1], out=self.sums[1:])

    def at(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return T.mix((self.sums[end] - self.sums[start]) * self.back[start])

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return T.mix((self.sums[length:] - self.sums[:n]) * self.back[:n])


def _items(data: np.ndarray, count: int, length: int) -> tuple[np.ndarray, ...]:
    """The strings of `length` bytes that start at the first `count` positions, in groups that share an anchor and a
    block of distances from it: (first start, number, rank pair, full) per group, then first start and number of
    runs of strings without an anchor.

    The rank pair names the two halves of the bytes that all strings of the block, here or anywhere, have in common;
    `full` names the bytes that this group's strings cover, with their distances.
    """
    one, two = Rolling(data, _BASES[0]), Rolling(data, _BASES[1])
    anchors = np.flatnonzero(one.all(GRAM) < np.uint64((1 << 64) // EVERY))
    before = np.concatenate(([-1], anchors[:-1])) if len(anchors) else anchors
    low, high = np.maximum(before + 1, anchors + GRAM - length), np.minimum(anchors, count - 1)
    some = low <= high
    anchors, low, high = anchors[some], low[some], high[some]
    bare = np.ones(count, bool)
    cover = np.zeros(count + 1, np.int64)
    np.add.at(cover, low, 1)
    np.add.at(cover, high + 1, -1)
    bare = np.cumsum(cover[:-1]) == 0
    first, last = (anchors - high) // BLOCK, (anchors - low) // BLOCK
    times = last - first + 1
    row = np.repeat(np.arange(len(anchors)), times)
    block = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    anchor = anchors[row]
    nearest = np.maximum(anchor - high[row], block * BLOCK)
    farthest = np.minimum(anchor - low[row], block * BLOCK + BLOCK - 1)
    core, half = anchor - block * BLOCK, (length - BLOCK + 1) // 2
    ranks = one.at(core, core + half) + block.astype(np.uint64) * np.uint64(_BASES[1])
    pair = (T.mix(ranks) & np.uint64(0xFFFFFFFF00000000)) | (one.at(core + half, core + length - BLOCK + 1) >> np.uint64(32))
    full = T.mix(two.at(anchor - farthest, anchor - nearest + length) + (nearest * length + farthest).astype(np.uint64))
    start, end = T.runs(bare)
    return anchor - farthest, farthest - nearest + 1, pair, full, start, end - start


def _segments(size: int, length: int):
    """Ranges of starts of a text, so that a very long one is looked at in parts."""
    for low in range(0, size - length + 1, _SEGMENT):
        yield low, min(low + _SEGMENT, size - length + 1)


def _packed(bucket_of: np.ndarray, columns: list[np.ndarray]):
    """Rows packed by bucket."""
    order = np.argsort(bucket_of, kind="stable")
    buckets = bucket_of[order]
    table = np.stack([c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64) for c in columns])[:, order]
    edges = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1], [True])))
    rows = [
        (int(buckets[a]), int(b - a), zstandard.compress(np.ascontiguousarray(table[:, a:b]).tobytes(), 3))
        for a, b in zip(edges[:-1], edges[1:])
    ]
    return T.batch(_PACKED, *zip(*rows))


def _unpacked(packed: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), np.int64).reshape(-1, rows)


def _spans(kind: int, docs, at, n) -> pa.RecordBatch:
    return T.batch(_SPANS, np.full(len(docs), kind), docs, at, n)


def _same(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal rows are neighbours, and whether a row there begins a new value."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    return order, new


def _groups(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group of each row, and sizes of the groups."""
    group = np.cumsum(new) - 1
    return group, np.bincount(group, minlength=int(new.sum()))


def _sampled(batches, length: int, buckets: int):
    """Groups of strings of each document, packed by the first rank. Of equal ones in a part of the input one
    travels, marked as matched already; a group without an anchor goes on by position."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(2)), 0).to_pylist()
        for low, high in T.parts(sizes, _PART_BYTES):
            found = []
            ids, tags = (c.slice(low, high - low).to_pylist() for c in b.columns[:2])
            for doc, tag, text, size in zip(ids, tags, b.column(2).slice(low, high - low), sizes[low:high]):
                if size < length:
                    continue
                data = np.frombuffer(text.as_py(), np.uint8)
                for begin, end in _segments(size, length):
                    start, n, pair, full, bare, m = _items(data[begin:end + length - 1], end - begin, length)
                    base = spans.place(tag, begin)
                    kinds = np.concatenate((np.zeros(len(start), np.int64), np.full(len(bare), 2)))
                    fill = np.arange(len(bare), dtype=np.uint64) * np.uint64(_BASES[0]) + np.uint64(doc & 0xFFFFFFFF)
                    found.append((
                        np.concatenate((pair, T.mix(fill))), np.concatenate((full, fill)), np.full(len(kinds), doc),
                        base + np.concatenate((start, bare)), np.concatenate((n, m)), kinds))
            if found:
                pair, full, docs, at, n, kinds = (np.concatenate(x) for x in zip(*found))
                order, new = _same(kinds, pair, full)
                pair, full, docs, at, n, kinds = (x[order] for x in (pair, full, docs, at, n, kinds))
                group, count = _groups(new)
                twice = (count[group] > 1) & (kinds == 0)
                kinds = np.where(twice, 1, kinds)
                keep = new | (kinds == 2)
                # 0: alone so far, 1: matched, one of them to meet others, 2: no anchor, 3: matched and done
                kinds = np.where(keep, kinds, 3)
                yield _packed((pair >> np.uint64(32)).astype(np.int64) % buckets, [pair, full, docs, at, n, kinds])


def _ranked(batches, at_once: int):
    """Sorts each bucket by rank pair and drops strings whose first rank, or pair, is unique; equal groups of the
    rest are matched, others with the same pair stay open, to be compared string by string. In a bucket of more than
    `at_once` rows all stay open."""
    held, size, bucket, crowded = [], 0, None, False

    def out():
        pair, full, docs, at, n, kinds = np.concatenate(held, axis=1)
        passed = (kinds == 1) | (kinds == 3)
        yield _spans(_MATCHED, docs[passed], at[passed], n[passed])
        bare = kinds == 2
        if crowded:
            bare = kinds != 3
        yield _spans(_OPEN, docs[bare], at[bare], n[bare])
        if crowded:
            return
        use = kinds < 2
        pair, full, docs, at, n, kinds = (x[use] for x in (pair, full, docs, at, n, kinds))
        for unread in (32, 0):  # the first rank, then the pair
            order, new = _same(pair >> unread)
            group, count = _groups(new)
            again = order[count[group] > 1]
            pair, full, docs, at, n, kinds = (x[again] for x in (pair, full, docs, at, n, kinds))
        order, new = _same(pair, full)
        pair, full, docs, at, n, kinds = (x[order] for x in (pair, full, docs, at, n, kinds))
        group, count = _groups(new)
        matched = (count[group] > 1) | (kinds == 1)
        yield _spans(_MATCHED, docs[matched], at[matched], n[matched])
        # one of each matched kind meets the rest of its pair, if there is a rest
        order, first = _same(pair)
        by_pair, _ = _groups(first)
        rest = np.bincount(by_pair, ~matched[order], minlength=len(first))[by_pair] > 0
        stay = np.zeros(len(pair), bool)
        stay[order] = rest
        stay &= ~matched | new
        yield _spans(_OPEN, docs[stay], at[stay], n[stay])

    for b in batches:
        for key, rows, packed in zip(*(c.to_pylist() for c in b.columns[:2]), b.column(2)):
            if key != bucket:
                if held:
                    yield from out()
                held, size, bucket, crowded = [], 0, key, False
            held.append(_unpacked(packed.as_py(), rows))
            size += rows
            if size > at_once or crowded:
                crowded = True
                yield from out()
                held = []
    if held:
        yield from out()


def _positions(batches, length: int, buckets: int):
    """Two hashes of every string that is still open, packed by the first; equal ones in a part of the input are
    matched, and one of them travels."""
    for b in batches:
        for low, high in T.parts([sum(c) for c in b.column(3).to_pylist()], 1 << 20):
            found = []
            for doc, packed, lows, counts in zip(*(c.slice(low, high - low).to_pylist() for c in b.columns)):
                data = np.frombuffer(spans.text_of(packed), np.uint8)
                tag = lows[0] >> spans.AT_BITS
                lows = spans.offsets(lows)
                starts, ends = T.merged(lows, lows + np.array(counts))
                for x, y in zip(starts.tolist(), ends.tolist()):
                    for s in range(x, y, _SEGMENT):
                        e = min(s + _SEGMENT, y)
                        piece = data[s:e + length - 1]
                        hashes = (Rolling(piece, base).all(length) for base in _BASES)
                        found.append((*hashes, np.full(e - s, doc), spans.place(tag, s) + np.arange(e - s)))
            if found:
                one, two, docs, at = (np.concatenate(x) for x in zip(*found))
                order, new = _same(one, two)
                one, two, docs, at = (x[order] for x in (one, two, docs, at))
                group, count = _groups(new)
                kinds = np.where(count[group] > 1, np.where(new, 1, 3), 0)
                yield _packed((one % np.uint64(buckets)).astype(np.int64), [one, two, docs, at, kinds])


def _repeated(batches, at_once: int):
    """Of each bucket the strings that occur twice. A bucket that grows beyond `at_once` rows is cut down to its
    different strings."""
    held, size, bucket = [], 0, None

    def out():
        """Matched positions, and the different strings as they go on."""
        one, two, docs, at, kinds = np.concatenate(held, axis=1)
        done = kinds == 3
        gone_docs, gone_at = docs[done], at[done]
        one, two, docs, at, kinds = (x[~done] for x in (one, two, docs, at, kinds))
        order, new = _same(one, two)
        one, two, docs, at, kinds = (x[order] for x in (one, two, docs, at, kinds))
        group, count = _groups(new)
        matched = (count[group] > 1) | (kinds == 1)
        left = np.stack((one, two, docs, at, np.where(matched, 1, 0)))[:, new]
        docs, at = np.concatenate((gone_docs, docs[matched])), np.concatenate((gone_at, at[matched]))
        order = np.lexsort((at, docs))
        docs, at = docs[order], at[order]
        start = np.flatnonzero(np.concatenate(([True], (docs[1:] != docs[:-1]) | (at[1:] > at[:-1] + 1)))) if len(docs) else order
        last = np.append(start[1:] - 1, len(docs) - 1).astype(np.int64) if len(docs) else order
        return _spans(_MATCHED, docs[start], at[start], at[last] - at[start] + 1), left

    for b in batches:
        for key, rows, packed in zip(*(c.to_pylist() for c in b.columns[:2]), b.column(2)):
            if key != bucket:
                if held:
                    yield out()[0]
                held, size, bucket = [], 0, key
            held.append(_unpacked(packed.as_py(), rows))
            size += rows
            if size > at_once:
                found, left = out()
                yield found
                held, size = [left], 0
    if held:
        yield out()[0]


def repeated_strings(rows: DataFrame, length: int = LENGTH, at_once: int = AT_ONCE) -> DataFrame:
    """(doc_id, at, n): runs of `n` positions from `at` whose next `length` bytes also start anywhere else.

    Prefix doubling with ranks for the positions: a string is ranked by its first half, strings with a unique rank
    go, then by the pair of ranks at the next offset, strings with a unique pair go, until the whole length is
    compared. Not every position travels: strings that start near each other share the next anchor, a position that
    its own next bytes choose, so equal strings share it too, and they are ranked as one group by the bytes that all
    of them have. Groups that are equal as a whole are settled in one row. What is open, at the edges of repeats, is
    settled by position.
    """
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    buckets = 8 + size // BUCKET_BYTES

    def dealt(packed, counted):
        return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda it: counted(it, at_once), _SPANS_DDL)

    ranked = checkpointed(dealt(rows.mapInArrow(lambda it: _sampled(it, length, buckets), _PACKED_DDL), _ranked), "ranks")
    still = spans.with_marks(rows, ranked.filter(F.col("kind") == _OPEN), "inner")
    settled = dealt(still.mapInArrow(lambda it: _positions(it, length, buckets), _PACKED_DDL), _repeated)
    return ranked.filter(F.col("kind") == _MATCHED).union(settled).drop("kind")


def without_repeats(docs: DataFrame, length: int = LENGTH, at_once: int = AT_ONCE) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans (removed runs), lows and sizes (the runs), `kept` (bytes
    left).

    A byte goes if a string of `length` bytes over it also starts anywhere else, in another document or this one;
    overlaps count. Strings are judged on the input. A text is its bytes in UTF-8, whole, a null one empty; shorter
    texts lose nothing. A repeated row of an id is compared like any other document's; rows that share an id and a
    text all lose what repeats. Rows without an id keep everything and match nothing. Other columns are not read; an
    empty table gives no rows.
    """
    rows = spans.prepared(docs)
    marks = repeated_strings(rows.filter("doc_id IS NOT NULL"), length, at_once)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("lows", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("kept", pa.binary())])

    def one(batches):
        for b in batches:
            for doc, packed, lows, counts in zip(*b.columns):
                text, starts, ends = spans.text_of(packed.as_py()), np.zeros(0, np.int64), np.zeros(0, np.int64)
                if lows.as_py():
                    low = spans.offsets(lows.as_py())
                    starts, ends = T.merged(low, low + np.array(counts.as_py()) + length - 1)
                kept = b"".join(text[x:y] for x, y in zip([0, *ends.tolist()], [*starts.tolist(), len(text)]))
                yield T.batch(schema, [doc.as_py()], [len(text)], [len(text) - len(kept)], [len(starts)], [starts], [ends - starts], [kept])

    return spans.with_marks(rows, marks).mapInArrow(
        one, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, lows array<bigint>, sizes array<bigint>, kept binary")
