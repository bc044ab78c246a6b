"""Removal of documents that repeat benchmark items, found with suffix arrays of the documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from zonewise.llm import text as T
from zonewise.session import checkpointed

WINDOW = 13
#: Text of the benchmark that a task holds at once; a larger benchmark is searched for block by block.
BLOCK_BYTES = 4 << 20
_END = np.uint64(0)
_RESULT = ("doc_id bigint, t binary, n_words bigint, lows array<bigint>, highs array<bigint>, items array<string>, "
           "longest bigint, longest_at bigint, longest_item string, longest_item_at bigint")
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("t", pa.binary()), ("n_words", pa.int64()), ("lows", pa.list_(pa.int64())),
    ("highs", pa.list_(pa.int64())), ("items", pa.list_(pa.string())), ("longest", pa.int64()), ("longest_at", pa.int64()),
    ("longest_item", pa.string()), ("longest_item_at", pa.int64())])


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(T.WORD_TABLE).split() if text else []


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.maximum(T.word_hashes(words), np.uint64(1))


class Suffixes:
    """The benchmark's suffixes that start a window, cut to the window's length, each different one once."""

    def __init__(self, items: list[tuple[str, bytes]], window: int) -> None:
        places: dict[bytes, list[tuple[str, int]]] = {}
        for item, text in items:
            words = words_of(text)
            row = np.zeros(len(words) + window, np.uint64)
            row[:len(words)] = _hashes(words)
            for at in range(max(len(words) - window, 0) + 1 if words else 0):
                places.setdefault(row[at:at + window].tobytes(), []).append((item, at))
        self.window, self.places = window, list(places.values())
        self.rows = np.frombuffer(b"".join(places), np.uint64).reshape(-1, window)
        self.lengths = (self.rows != _END).sum(1)
        lead = min(2, int(self.lengths.min(initial=window)))
        self.leads = [np.unique(_lead(self.rows[:, 0], self.rows[:, 1] if lead > 1 else None))] * lead

    def may_start(self, hashes: np.ndarray) -> np.ndarray:
        """Places of a text at which some suffix could match: its first one or two words are those of one."""
        if not self.leads or not len(hashes):
            return np.zeros(0, np.int64)
        after = np.append(hashes[1:], _END) if len(self.leads) > 1 else None
        return np.flatnonzero(np.isin(_lead(hashes, after), self.leads[0], kind="sort"))


def _lead(one: np.ndarray, two: np.ndarray | None) -> np.ndarray:
    return one if two is None else T.mix(one * np.uint64(0x9E3779B97F4A7C15) + two)


def _bound(array: np.ndarray, rows: np.ndarray, lengths: np.ndarray, upper: bool) -> np.ndarray:
    """Binary search of each row's first words in a sorted array of rows: the first place that is not smaller, or
    (upper) the first that is larger."""
    low, high = np.zeros(len(rows), np.int64), np.full(len(rows), len(array), np.int64)
    use = np.arange(rows.shape[1])[None, :] < lengths[:, None]
    while (open_ := low < high).any():
        mid = (low + high) // 2
        seen = array[np.minimum(mid, len(array) - 1)]
        differ = (seen != rows) & use
        at = differ.argmax(1)[:, None]
        a, b = np.take_along_axis(seen, at, 1)[:, 0], np.take_along_axis(rows, at, 1)[:, 0]
        same = ~differ.any(1)
        right = open_ & (np.where(same, upper, a < b))
        low, high = np.where(right, mid + 1, low), np.where(open_ & ~right, mid, high)
    return low


def search(texts: list[bytes | None], suffixes: Suffixes) -> Iterator[tuple]:
    """For each text of a shard: number of words, places and lengths of matched windows, and their numbers.

    The shard's suffix array holds the places that some suffix of the benchmark could start at, sorted by their next
    `window` words; every suffix of the benchmark is looked up in it by binary search.
    """
    window = suffixes.window
    words = [words_of(t) for t in texts]
    sizes = np.array([len(w) for w in words])
    base = np.cumsum(sizes + window) - (sizes + window)
    sequence = np.zeros(int((sizes + window).sum()), np.uint64)
    for w, at in zip(words, base.tolist()):
        sequence[at:at + len(w)] = _hashes(w)
    starts = suffixes.may_start(sequence)
    rows = sequence[starts[:, None] + np.arange(window)] if len(starts) else np.zeros((0, window), np.uint64)
    order = np.lexsort(rows.T[::-1]) if len(rows) else np.zeros(0, np.int64)
    starts, rows = starts[order], rows[order]
    found_at = found_row = np.zeros(0, np.int64)
    if len(rows):
        first = _bound(rows, suffixes.rows, suffixes.lengths, False)
        counts = _bound(rows, suffixes.rows, suffixes.lengths, True) - first
        found_row = np.repeat(np.arange(len(first)), counts)
        inside = np.arange(len(found_row)) - np.repeat(np.cumsum(counts) - counts, counts)
        found_at = starts[first[found_row] + inside]
        by_place = np.argsort(found_at, kind="stable")
        found_at, found_row = found_at[by_place], found_row[by_place]
    borders = np.searchsorted(found_at, np.append(base, len(sequence)))
    for k, n in enumerate(sizes.tolist()):
        mine = slice(borders[k], borders[k + 1])
        yield n, found_at[mine] - base[k], found_row[mine]


def _longest(places: np.ndarray, rows: np.ndarray, suffixes: Suffixes) -> tuple:
    """The longest verbatim match: words, place in the text, item, place in the item; the first of several."""
    best, before, now, last = (0, None, None, None), {}, {}, None
    for at, row in zip(places.tolist(), rows.tolist()):
        if at != last:
            before, now = now if last is not None and at == last + 1 else {}, {}
            last = at
        for item, place in suffixes.places[row]:
            start = now[item, place] = before.get((item, place - 1), at)
            length = at - start + int(suffixes.lengths[row])
            if length > best[0]:
                best = (length, start, item, place - (at - start))
    return best


def _items(items: DataFrame, window: int) -> Iterator[Suffixes]:
    """The benchmark in blocks of bounded size."""
    rows = items.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("binary").alias("t")) \
        .filter("i IS NOT NULL AND t IS NOT NULL").distinct()
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    for k in range(blocks):
        block = rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).orderBy("i", "t").collect()
        yield Suffixes([(r.i, bytes(r.t)) for r in block], window)


def _searched(batches, suffixes: Suffixes, more: bool):
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist()
        for low, high in T.parts(sizes):
            part = b.slice(low, high - low).to_pydict()
            out = {name: [] for name in _ARROW.names}
            for k, (n, places, rows) in enumerate(search(part["t"], suffixes)):
                lows, highs = T.merged(
                    np.concatenate((part["lows"][k] or [], places)).astype(np.int64),
                    np.concatenate((part["highs"][k] or [], places + suffixes.lengths[rows])).astype(np.int64))
                hit = {item for r in np.unique(rows).tolist() for item, _ in suffixes.places[r]}
                best = max((part["longest"][k] or 0, part["longest_at"][k], part["longest_item"][k], part["longest_item_at"][k]),
                           _longest(places, rows, suffixes), key=lambda x: x[0])
                for name, value in zip(_ARROW.names, (
                        part["doc_id"][k], part["t"][k] if more else None, n, lows, highs, sorted({*(part["items"][k] or []), *hit}), *best)):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=_ARROW)


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside a matched window), lows and highs (the matched runs of
    words), items (ids whose windows occur, as sorted strings), longest, longest_at, longest_item, longest_item_at
    (the longest verbatim match of a window or more), contaminated (n_hit is a twentieth of the words or more).

    Each part of the input is a shard with its own suffix array, so no document is shuffled. The benchmark is looked
    up in blocks of bounded size; a block's result is an input of the next. Null and empty texts have no words;
    items without id or text take no part, an item of fewer words than the window is one window, and equal ids are
    one item. Repeated documents give a row each. Other columns are not read.
    """
    T.small_batches(docs.sparkSession)
    found = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("t"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in (x.split(" ") for x in _RESULT.split(", ")[2:])])
    blocks = list(_items(items, window)) or [Suffixes([], window)]
    for k, block in enumerate(blocks):
        more = k + 1 < len(blocks)
        found = found.mapInArrow(lambda it, s=block, m=more: _searched(it, s, m), _RESULT)
        if more and k % 4 == 3:
            found = checkpointed(found, "matches")
    n_hit = F.aggregate(F.zip_with("highs", "lows", lambda h, w: h - w), F.lit(0).cast("bigint"), lambda a, x: a + x)
    found = found.drop("t").withColumn("n_hit", n_hit)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def _cleaned(batches, suffixes: Suffixes, at: int, carried: bool, more: bool):
    """The rows that matches up to this block don't make contaminated. What they matched follows their own columns."""
    for b in batches:
        texts = b.column(at).cast(pa.binary())
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        for low, high in T.parts(sizes):
            part = b.slice(low, high - low)
            before = [c.to_pylist() for c in part.columns[-2:]] if carried else [[[]] * part.num_rows] * 2
            lows, highs, keep = [], [], []
            for k, (n, places, rows) in enumerate(search(texts.slice(low, high - low).to_pylist(), suffixes)):
                starts, ends = T.merged(np.concatenate((before[0][k], places)).astype(np.int64),
                                        np.concatenate((before[1][k], places + suffixes.lengths[rows])).astype(np.int64))
                n_hit = int((ends - starts).sum())
                keep.append(not n_hit or 20 * n_hit < n)
                lows.append(starts)
                highs.append(ends)
            own = part.columns[:-2] if carried else part.columns
            names = part.schema.names[:len(own)]
            if more:
                own += [pa.array(x, pa.list_(pa.int64())) for x in (lows, highs)]
                names += _marks(names)
            yield pa.RecordBatch.from_arrays(own, names).filter(pa.array(keep))


def _marks(names: list[str]) -> list[str]:
    """Names of two columns that aren't among `names`."""
    lead = "_" * (1 + max(map(len, names)))
    return [lead + "lows", lead + "highs"]


def decontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that aren't contaminated, as they are. Each row goes through block after block with what it
    matched and is judged by itself; without a shuffle."""
    T.small_batches(docs.sparkSession)
    at, found = docs.columns.index("text"), docs
    carried = StructType([*docs.schema.fields, *(StructField(m, ArrayType(LongType())) for m in _marks(docs.columns))])
    blocks = list(_items(items, window))
    for k, block in enumerate(blocks):
        more = k + 1 < len(blocks)
        found = found.mapInArrow(lambda it, s=block, c=k > 0, m=more: _cleaned(it, s, at, c, m), carried if more else docs.schema)
        if more and k % 4 == 3:
            found = checkpointed(found, "clean")
    return found
