"""Removal of repeated word windows, counted in buckets of super-k-mers."""

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

WINDOW, SEED_WORDS = 13, 3
#: Text that a bucket gets on average, and windows of a bucket that a task sorts; those of a fuller bucket become rows of
#: their own.
BUCKET_BYTES, AT_ONCE = 8 << 20, 4_000_000
_PART_BYTES = 8 << 20
_ODD, _OTHER = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_SENT = "bucket bigint, rows bigint, covered bigint, packed binary"
_FOUND = "doc_id bigint, at bigint, n bigint, a bigint, b bigint"
_SENT_ARROW = pa.schema([("bucket", pa.int64()), ("rows", pa.int64()), ("covered", pa.int64()), ("packed", pa.binary())])
_FOUND_ARROW = pa.schema([(c, pa.int64()) for c in ("doc_id", "at", "n", "a", "b")])


def _super_kmers(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, first window and number of windows of each stretch of windows that share a minimiser."""
    seeds = T.chain(T.word_hashes(words), SEED_WORDS, _ODD)
    span = window - SEED_WORDS + 1
    place = np.lib.stride_tricks.sliding_window_view(seeds, span).argmin(1) + np.arange(len(seeds) - span + 1)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    return seeds[place[first]].view(np.int64), first, np.diff(np.concatenate((first, [len(place)])))


def _packed(rows: list[tuple], covered: list[tuple]) -> bytes:
    """Super-k-mers (document, place, number of windows, words), then places of covered ones, as one string."""
    numbers = np.array([r[:3] for r in rows + covered], np.int64)
    return zstandard.compress(numbers.T.tobytes() + b" ".join([r[3] for r in rows]), 3)


def _unpacked(packed: bytes, rows: int, covered: int) -> tuple[np.ndarray, bytes]:
    data = zstandard.decompress(packed)
    size = 24 * (rows + covered)
    return np.frombuffer(data[:size], np.int64).reshape(3, -1), data[size:]


def _sent(batches, window: int, buckets: int):
    """The super-k-mers of each document, packed by bucket. Of equal ones in a part of the input only that of the
    smallest doc_id travels as text; it covers the others, which go as places alone."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(2)), 0).to_pylist()
        for low, high in T.parts(sizes, _PART_BYTES):
            rows, least = [], {}
            ids, tags, texts = (c.slice(low, high - low) for c in b.columns)
            for doc, tag, text in zip(ids.to_pylist(), tags.to_pylist(), texts):
                words, base = [], 0
                for piece in T.pieces(text.as_py() or b"", _PART_BYTES):
                    words += piece.split()
                    if len(words) < window:
                        continue
                    for key, at, n in zip(*(x.tolist() for x in _super_kmers(words, window))):
                        packed = b" ".join(words[at:at + n + window - 1])
                        rows.append((doc, spans.place(tag, base + at), n, packed, key % buckets))
                        if doc < least.get(packed, doc + 1):
                            least[packed] = doc
                    base += len(words) - window + 1  # the next piece begins with the first window that isn't whole yet
                    words = words[1 - window:]
            sent = {}
            for row in rows:
                sent.setdefault(row[4], ([], []))[row[0] != least[row[3]]].append(row)
            if sent:
                out = [(k, len(x), len(y), _packed(x, y)) for k, (x, y) in sent.items()]
                yield T.batch(_SENT_ARROW, *zip(*out))


def _windows(numbers: np.ndarray, words: bytes, window: int) -> np.ndarray:
    """Two numbers, document and place of every window of some super-k-mers."""
    docs, places, counts = numbers
    hashes = T.word_hashes(words.split())
    ones, twos = T.chain(hashes, window, _ODD), T.chain(T.mix(hashes), window, _OTHER)
    row = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (np.cumsum(counts + window - 1) - (counts + window - 1))[row] + inside
    return np.stack((ones[at].view(np.int64), twos[at].view(np.int64), docs[row], places[row] + inside))


def _covered(ones, twos, docs, places):
    """Documents and places of the windows that a smaller document has too, as stretches (document, place, number)."""
    order = np.lexsort((docs, twos, ones))
    ones, twos, docs, places = ones[order], twos[order], docs[order], places[order]
    new = np.concatenate(([True], (ones[1:] != ones[:-1]) | (twos[1:] != twos[:-1])))
    hit = docs > docs[np.flatnonzero(new)][np.cumsum(new) - 1]
    docs, places = docs[hit], places[hit]
    order = np.lexsort((places, docs))
    docs, places = docs[order], places[order]
    new = np.flatnonzero(np.concatenate(([True], (docs[1:] != docs[:-1]) | (places[1:] > places[:-1] + 1)))) if len(docs) else order
    last = np.concatenate((new[1:] - 1, [len(docs) - 1])).astype(np.int64) if len(docs) else order
    return docs[new], places[new], places[last] - places[new] + 1


def _counted(batches, window: int, at_once: int):
    """Sorts the windows of each bucket, whose rows arrive one after another, and gives the covered ones. A bucket
    of more than `at_once` windows isn't held: its windows go on with their numbers, one a row."""
    held, size, bucket, full = [], 0, None, False

    def out(full):
        found = np.concatenate(held, axis=1)
        if full:
            return T.batch(_FOUND_ARROW, found[2], found[3], np.ones_like(found[2]), found[0], found[1])
        docs, places, counts = _covered(*found)
        none = pa.nulls(len(docs), pa.int64())
        return T.batch(_FOUND_ARROW, docs, places, counts, none, none)

    for b in batches:
        for key, rows, covered, packed in zip(*(c.to_pylist() for c in b.columns[:3]), b.column(3)):
            if key != bucket:
                if held:
                    yield out(full)
                held, size, bucket, full = [], 0, key, False
            numbers, words = _unpacked(packed.as_py(), rows, covered)
            if covered:
                none = pa.nulls(covered, pa.int64())
                yield T.batch(_FOUND_ARROW, *numbers[:, rows:], none, none)
            held.append(_windows(numbers[:, :rows], words, window))
            size += held[-1].shape[1]
            full |= size > at_once
            if full:
                yield out(full)
                held = []
    if held:
        yield out(full)


def covered_windows(docs: DataFrame, window: int = WINDOW, at_once: int = AT_ONCE) -> DataFrame:
    """(doc_id, at, n): stretches of `n` windows from `at` that also start in a document with a smaller doc_id."""
    size = docs.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    buckets = 8 + size // BUCKET_BYTES
    sent = docs.mapInArrow(lambda it: _sent(it, window, buckets), _SENT)
    found = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda it: _counted(it, window, at_once), _FOUND)
    found = checkpointed(found, "windows")
    crowded = found.filter("a IS NOT NULL")
    least = crowded.groupBy("a", "b").agg(F.min("doc_id").alias("least"))
    late = crowded.join(least, ["a", "b"]).filter("doc_id > least").select("doc_id", "at", "n")
    return found.filter("a IS NULL").select("doc_id", "at", "n").union(late)


def without_repeats(docs: DataFrame, window: int = WINDOW, at_once: int = AT_ONCE) -> DataFrame:
    """Per document: doc_id, n_words, n_removed and `kept`, the words left, joined by one space.

    A word goes if a window of `window` words over it also starts in a document with a smaller doc_id. Windows are
    judged on the input. Consecutive windows whose least seed of three words is the same one travel as one packed
    string to the bucket of that seed, where two 64-bit numbers of each window are sorted; equal windows always
    meet, as they share their least seed.

    The texts meet their marks compressed. Documents of fewer words than the window lose nothing; a null text has no
    words and an empty `kept`. Rows with the same id are one document's, compared with those of smaller ids only, so
    exact repeats of a row keep what it keeps. Rows without an id keep everything. Other columns are not read; an
    empty table gives no rows.
    """
    rows = spans.prepared(docs)
    marks = covered_windows(rows.filter("doc_id IS NOT NULL"), window, at_once)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])

    def one(batches):
        for b in batches:
            for doc, text, lows, counts in zip(*(b.column(k) for k in range(4))):
                doc, lows, counts = doc.as_py(), lows.as_py(), counts.as_py()
                words = spans.text_of(text.as_py()).split()
                kept = words
                if lows:
                    low, count = spans.offsets(lows), np.array(counts)
                    starts, ends = T.merged(low, low + count + window - 1)
                    kept, at = [], 0
                    for x, y in zip(starts.tolist(), ends.tolist()):
                        kept += words[at:x]
                        at = y
                    kept += words[at:]
                yield T.batch(schema, [doc], [len(words)], [len(words) - len(kept)], [b" ".join(kept)])

    return spans.with_marks(rows, marks).mapInArrow(one, "doc_id bigint, n_words bigint, n_removed bigint, kept binary")
