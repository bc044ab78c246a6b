"""SentencePiece encoding with a relational lattice, and decoding."""

from __future__ import annotations

import hashlib
import itertools
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise.llm import text as T
from zonewise.session import checkpointed

SPACE = "▁"
#: A longer word is not held with its ids: it is encoded where it occurs, in stretches of so many characters.
LONGEST = 256
#: Words that every task holds with their ids, the most frequent ones, in some 22 bytes each; others are joined.
DICTIONARY = 4_000_000
#: Packed words of all parts, each part's different ones, that a bucket of the vocabulary gets on average.
BUCKET_BYTES = 1 << 18
_PART_BYTES = 8 << 20
#: Different words that a task of the vocabulary adds up before they travel, and rows that it passes on at a time.
_HELD, _ROWS = 1_000_000, 50_000
#: What a character without a piece of its own costs below the lowest score.
UNKNOWN = 10.0
#: Pieces of a model at most; its table is sent to every executor.
MOST_PIECES = 1_000_000
_STRETCH = re.compile(" *[^ ]+| +")
_WORD = rf"{SPACE}*[^{SPACE}]+|{SPACE}+"
_SEEDS = (42, xxhash.xxh64_intdigest(b"word", 42))


def _pattern(pieces: list[str]) -> str:
    """Words end before a space sign and, if no piece holds both, between letters and other characters. Letters that
    some piece joins with others count as others."""
    pairs = {p[k:k + 2] for p in pieces for k in range(len(p) - 1)}
    others: set[str] = set()
    while len(others) < 100:
        letter = rf"(?:(?![{re.escape(''.join(sorted(others)))}])[^\W\d_])" if others else r"[^\W\d_]"
        sort = re.compile(letter)
        mixed = {a if sort.match(a) else b for a, b in pairs if bool(sort.match(a)) != bool(sort.match(b))}
        if not mixed:
            return rf"{SPACE}*(?:{letter}+|(?:(?!{letter}|{SPACE})[\s\S])+)|{SPACE}+"
        others |= mixed
    return _WORD


@dataclass
class Model:
    """Pieces of a SentencePiece model that stand for text (piece, id, score), the ids of bytes, the bytes of each
    id, and the pattern of the words that no piece reaches beyond."""

    pieces: list[tuple[str, int, float]]
    of_byte: list[int]
    texts: list[bytes]
    pattern: str = field(default="")

    def __post_init__(self) -> None:
        if any(SPACE in p.lstrip(SPACE) for p, _, _ in self.pieces):
            raise ValueError("a piece goes on into another word")
        if len(self.pieces) > MOST_PIECES:
            raise ValueError(f"more than {MOST_PIECES} pieces")
        self.pattern = _pattern([p.lstrip(SPACE) for p, _, _ in self.pieces])

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.pieces, "piece string, id int, score double")


def load(path: str) -> Model:
    import sentencepiece

    file = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, of_byte, texts = [], [0] * 256, []
    for i in range(file.get_piece_size()):
        piece, text = file.id_to_piece(i), b""
        if file.is_byte(i):
            text = bytes([int(piece[3:5], 16)])
            of_byte[text[0]] = i
        elif not (file.is_control(i) or file.is_unknown(i) or file.is_unused(i)):
            pieces.append((piece, i, float(file.get_score(i))))
            text = piece.replace(SPACE, " ").encode()
        texts.append(text)
    return Model(pieces, of_byte, texts)


def signed(text: str) -> str:
    """The text with a space sign for each space and one before it; an empty text stays empty."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def words_of(text: str | None, pattern: re.Pattern) -> list[str]:
    return pattern.findall(signed(text or ""))


class Splitter:
    """The words of some texts as numbers, in order of their first occurrence.

    A text is cut at spaces first; each different stretch between them meets the pattern once. A text that holds the
    space sign itself is split as a whole.
    """

    def __init__(self, pattern: re.Pattern) -> None:
        self.pattern, self.numbers, self.stretches = pattern, {}, {}

    def _known(self, words: list[str]) -> list[int]:
        return [self.numbers.setdefault(w, len(self.numbers)) for w in words]

    def split(self, text: str) -> list[int]:
        if not text:
            return []
        if SPACE in text:
            return self._known(words_of(text, self.pattern))
        out: list[int] = []
        stretches = self.stretches
        for x in _STRETCH.findall(" " + text):
            found = stretches.get(x)
            if found is None:
                found = stretches[x] = self._known(self.pattern.findall(x.replace(" ", SPACE)))
            out += found
        return out


def _letters(pattern: re.Pattern) -> str:
    """A pattern of what is one word after a space sign, whatever its length: some letters, none if in doubt."""
    found = [c for c in map(chr, range(0x41, 0x250)) if c.isalpha() and pattern.fullmatch(f"{SPACE}a{c}a")]
    return f"^[{''.join(found)}]+$" if found else "^a^"


def split_texts(texts: pa.Array, pattern: re.Pattern, letters: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of some texts, frequent ones first, the numbers of all words in order, and how many each text
    has: what `words_of` gives, for many texts at once.

    Texts are cut at every space; an empty cut is a space more before the next one, or at the end. Each different
    stretch, a cut with the spaces before it, meets the pattern once, unless it is all `letters`.
    """
    texts = pc.replace_substring(pc.fill_null(texts, ""), SPACE, " ")
    lengths = np.zeros(len(texts), np.int64)
    some = np.flatnonzero(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    if not len(some):
        return pa.array([], pa.string()), lengths[:0], lengths
    cuts = pc.split_pattern(texts.take(pa.array(some)), " ")
    borders = cuts.offsets.to_numpy()
    coded = cuts.flatten().dictionary_encode()
    stretch, different, more = coded.indices.to_numpy(), coded.dictionary, []
    blank = pc.equal(different, "").to_numpy(zero_copy_only=False)
    if blank.any():
        ends = np.zeros(len(stretch), bool)
        ends[borders[1:] - 1] = True
        at = np.flatnonzero(~blank[stretch] | ends)
        text_of = np.repeat(np.arange(len(some)), np.diff(borders))[at]
        spaces = at - np.maximum(np.concatenate(([-1], at[:-1])), borders[text_of] - 1)
        stretch, odd = stretch[at], np.flatnonzero(spaces > 1)
        kinds, place = np.unique(spaces[odd] * len(different) + stretch[odd], return_inverse=True)
        more = [SPACE * (k // len(different)) + different[k % len(different)].as_py() for k in kinds.tolist()]
        stretch = stretch.copy()
        stretch[odd] = len(different) + place
        borders = np.searchsorted(text_of, np.arange(len(some) + 1))
    plain = pc.match_substring_regex(different, letters).to_numpy(zero_copy_only=False)
    single, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
    found = [pattern.findall(SPACE + x) for x in different.take(pa.array(rest)).to_pylist()] + [pattern.findall(x) for x in more]
    many = np.ones(len(different) + len(more), np.int64)
    first = np.empty(len(many), np.int64)
    others = np.concatenate((rest, np.arange(len(different), len(many))))
    many[others] = [len(x) for x in found]
    first[single] = np.arange(len(single))
    first[others] = len(single) + np.cumsum(many[others]) - many[others]
    words = pa.concat_arrays([pc.binary_join_element_wise(SPACE, different.take(pa.array(single)), ""),
                              pa.array([w for x in found for w in x], pa.string())]).dictionary_encode()
    each = many[stretch]
    sequence = words.indices.to_numpy()[_ragged(first[stretch], each)]
    sums = np.concatenate(([0], np.cumsum(each)))[borders]
    lengths[some] = sums[1:] - sums[:-1]
    # frequent words get small numbers, equally frequent ones lie in order
    by_name, counts = pc.sort_indices(words.dictionary).to_numpy(), np.bincount(sequence, minlength=len(words.dictionary))
    order = by_name[np.argsort(-counts[by_name], kind="stable")][:np.count_nonzero(counts)]
    number = np.empty(len(counts), np.int64)
    number[order] = np.arange(len(order))
    return words.dictionary.take(pa.array(order)), number[sequence], lengths


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs of `sizes` from `starts`, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class LongWords:
    """Ids of a word of any length, by the lattice and the order of edges that `encoded` has.

    The word is gone through in stretches, which carry the best scores of the last positions that a piece can reach
    back to; of each position only its best edge stays.
    """

    def __init__(self, model: Model) -> None:
        self.edges = {p: (s, i) for p, i, s in model.pieces}
        self.longest = max((len(p) for p, _, _ in model.pieces), default=1)
        self.lowest = min((s for *_, s in model.pieces), default=0.0) - UNKNOWN
        self.of_byte = model.of_byte

    def ids(self, word: str) -> np.ndarray:
        edges, scores, sizes, numbers = self.edges, [0.0], array("i"), array("i")
        for low in range(0, len(word), LONGEST):
            first = max(low - self.longest, 0)  # the position of scores[0]
            for end in range(low + 1, min(low + LONGEST, len(word)) + 1):
                best, size, number = None, 1, -1
                for start in range(max(end - self.longest, 0), end):
                    edge = edges.get(word[start:end])
                    if edge is None:
                        if start < end - 1:
                            continue
                        edge = self.lowest, -1
                    score = scores[start - first] + edge[0]
                    if best is None or score > best:
                        best, size, number = score, end - start, edge[1]
                scores.append(best)
                sizes.append(size)
                numbers.append(number)
            del scores[:-(self.longest + 1)]
        out, at = array("i"), len(word)
        while at:
            number = numbers[at - 1]
            if number < 0:
                out.extend(self.of_byte[b] for b in reversed(word[at - 1].encode()))
            else:
                out.append(number)
            at -= sizes[at - 1]
        return np.frombuffer(out, np.int32)[::-1]


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 in the bytes that they need, lowest bytes first, compressed."""
    width = max((int(numbers.max(initial=0)).bit_length() + 7) // 8, 1)
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]
    return bytes([width]) + zstandard.compress(np.ascontiguousarray(planes.T).tobytes(), 6)


def _unpacked(packed: bytes) -> np.ndarray:
    width, planes = packed[0], np.frombuffer(zstandard.decompress(packed[1:]), np.uint8)
    out = np.zeros((len(planes) // width, 4), np.uint8)
    out[:, :width] = planes.reshape(width, -1).T
    return out.view("<u4")[:, 0].astype(np.int64)


def _words_packed(words: list[str] | pa.Array) -> bytes:
    words = pa.array(words, pa.string()) if isinstance(words, list) else words
    sizes = _packed(pc.binary_length(words).to_numpy(zero_copy_only=False))
    return len(sizes).to_bytes(4, "little") + sizes + zstandard.compress(b"".join(words.cast(pa.binary()).to_pylist()), 6)


def _words_array(packed: bytes) -> pa.Array:
    at = 4 + int.from_bytes(packed[:4], "little")
    ends, text = np.cumsum(np.concatenate(([0], _unpacked(packed[4:at])))), zstandard.decompress(packed[at:])
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(text))


def _words_unpacked(packed: bytes) -> list[str]:
    return _words_array(packed).to_pylist()


def parted(docs: DataFrame, model: Model) -> DataFrame:
    """The texts as numbers of words, written as a table: a row for a part of the documents, of some 8 MB, with their
    doc_ids, the number of words of each, and packed its different words, how often they occur, and the sequence of all
    words. A text is split here and nowhere else."""
    T.small_batches(docs.sparkSession)
    schema = pa.schema([("ids", pa.list_(pa.int64())), ("sizes", pa.binary()), ("words", pa.binary()), ("counts", pa.binary()),
                        ("sequence", pa.binary())])
    pattern_text = model.pattern

    def row(ids, texts, pattern, letters):
        words, numbers, lengths = split_texts(pa.concat_arrays(texts), pattern, letters)
        return T.batch(schema, [pa.concat_arrays(ids).to_pylist()], [_packed(lengths)], [_words_packed(words)],
                       [_packed(np.bincount(numbers, minlength=len(words)))], [_packed(numbers)])

    def one(batches):
        pattern, ids, texts, held = re.compile(pattern_text), [], [], 0
        letters = _letters(pattern)
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist()
            for low, high in T.parts(sizes, _PART_BYTES):
                size = sum(sizes[low:high])
                if held and held + size > _PART_BYTES:
                    yield row(ids, texts, pattern, letters)
                    ids, texts, held = [], [], 0
                ids.append(b.column(0).slice(low, high - low))
                texts.append(b.column(1).slice(low, high - low))
                held += size
        if ids:
            yield row(ids, texts, pattern, letters)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("t"))
    parts = rows.mapInArrow(one, "ids array<bigint>, sizes binary, words binary, counts binary, sequence binary")
    return checkpointed(parts.withColumn("part", F.monotonically_increasing_id()), "parts")


def vocabulary(parts: DataFrame) -> DataFrame:
    """(word, n): the different words of all parts, up to LONGEST characters, and how often they occur, dealt out by
    word. Each task adds up its own counts before they travel."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def added(tables):
        found = pa.concat_tables(tables).group_by("word", use_threads=False).aggregate([("n", "sum")])
        return pa.table({"word": found["word"], "n": found["n_sum"]}, schema)

    def one(batches):
        held, size, last = [], 0, 0
        for b in batches:
            for words, counts in zip(b.column(0), b.column(1)):
                some = pa.table({"word": _words_array(words.as_py()), "n": _unpacked(counts.as_py())}, schema)
                held.append(some.filter(pc.less_equal(pc.utf8_length(some["word"]), LONGEST)))
                size += len(held[-1])
                if size > last + _HELD:
                    held = [added(held)]
                    last = size = len(held[0])
                    if size > _HELD:
                        yield from held[0].to_batches(_ROWS)
                        held, size, last = [], 0, 0
        if held:
            yield from added(held).to_batches(_ROWS)

    size = parts.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    rows = parts.select("words", "counts").mapInArrow(one, "word string, n bigint")
    return rows.repartition(8 + size // BUCKET_BYTES, "word").groupBy("word").agg(F.sum("n").alias("n"))


def encoded(words: DataFrame, model: Model) -> DataFrame:
    """(word, n, ids) of different words: the pieces of the best path through each word's lattice.

    Substrings up to the longest piece's length meet the piece table, whose matches are the edges of the lattice; a
    character without a piece of its own gets an edge that stands for the ids of its bytes. Edges are grouped by
    word and folded in the order of their ends: the best path to a position is the best one over the edges that end
    there. Of equal scores the longer last piece wins. `words` is dealt out by word, and edges stay where their word
    is.
    """
    table = model.table(words.sparkSession)
    longest = max((len(p) for p, _, _ in model.pieces), default=1)
    lowest = min((s for _, _, s in model.pieces), default=0.0) - UNKNOWN
    of_byte = F.array(*[F.lit(i) for i in model.of_byte])
    ends = words.select("word", "n", F.explode(F.sequence(F.lit(1), F.char_length("word"))).alias("end"))
    parts = ends.select("*", F.explode(F.sequence(F.greatest(F.col("end") - longest, F.lit(0)), F.col("end") - 1)).alias("start"))
    cut = parts.withColumn("piece", F.expr("substring(word, start + 1, end - start)"))
    edges = cut.join(F.broadcast(table), "piece", "left").filter((F.col("id").isNotNull()) | (F.col("end") == F.col("start") + 1))
    # the edge of a character without a piece has its place, below zero, for an id
    number = F.coalesce("id", -F.col("end"))
    edge = F.struct("end", "start", F.coalesce("score", F.lit(lowest)).alias("score"), number.alias("id"))
    lattice = edges.select("word", "n", edge.alias("edge")).groupBy("word").agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list("edge")).alias("edges"))
    begin = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids")))

    def step(best, edge):
        """`best` has the best path to every position up to the end of the edge before."""
        score = F.element_at(best, edge.start + 1).score + edge.score
        path = F.array(F.struct(score.alias("score"), F.array_append(F.element_at(best, edge.start + 1).ids, edge.id).alias("ids")))
        return F.when(F.size(best) == edge.end, F.concat(best, path)).when(
            score > F.element_at(best, -1).score, F.concat(F.slice(best, F.lit(1), edge.end), path)).otherwise(best)

    paths = lattice.select("word", "n", F.aggregate("edges", begin, step, lambda best: F.element_at(best, -1).ids).alias("ids"))
    as_bytes = lambda i: F.transform(
        F.regexp_extract_all(F.hex(F.encode(F.substr(F.col("word"), -i, F.lit(1)), "UTF-8")), F.lit("(..)")),
        lambda x: F.element_at(of_byte, (F.conv(x, 16, 10) + 1).cast("int")))
    spelled = F.flatten(F.transform("ids", lambda i: F.when(i >= 0, F.array(i)).otherwise(as_bytes(i))))
    return paths.withColumn("ids", F.when(F.exists("ids", lambda i: i < 0), spelled).otherwise(F.col("ids")))


class Dictionary:
    """Ids of words, found by two hashes. It takes some 22 bytes a word: a model's ids fit two bytes as a rule."""

    def __init__(self, keys: np.ndarray, checks: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> None:
        order, starts = np.argsort(keys), np.cumsum(sizes, dtype=np.int64) - sizes
        self.keys, self.checks, self.sizes = keys[order], checks[order], sizes[order]
        self.ids = np.empty_like(flat)
        at = 0
        for low in range(0, len(order), 1 << 17):
            some = order[low:low + (1 << 17)]
            found = flat[_ragged(starts[some], sizes[some].astype(np.int64))]
            self.ids[at:at + len(found)] = found
            at += len(found)

    def __getstate__(self):
        return self.keys, self.checks, self.ids, self.sizes

    def __setstate__(self, state) -> None:
        self.keys, self.checks, self.ids, self.sizes = state

    def find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word the number of its ids, 0 if it isn't here, and one after the other the ids of those that are."""
        counts = np.zeros(len(words), np.int64)
        if not len(self.keys) or not len(words):
            return counts, np.zeros(0, np.int32)
        if not hasattr(self, "ends"):
            self.ends = np.cumsum(self.sizes, dtype=np.int64)
        raw = words.cast(pa.binary()).to_pylist()
        keys = np.fromiter((xxhash.xxh64_intdigest(w, _SEEDS[0]) for w in raw), np.uint64, len(raw))
        order = np.argsort(keys)  # places in order are near each other
        at = np.empty(len(raw), np.int64)
        at[order] = np.minimum(np.searchsorted(self.keys, keys[order]), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == keys)
        checks = np.fromiter((xxhash.xxh64_intdigest(raw[h], _SEEDS[1]) & 0xFFFFFFFF for h in hit.tolist()), np.uint32, len(hit))
        hit = hit[self.checks[at[hit]] == checks]
        counts[hit] = self.sizes[at[hit]]
        return counts, self.ids[_ragged(self.ends[at[hit]] - counts[hit], counts[hit])].astype(np.int32)


def _step() -> Column:
    """An eighth of a doubling of `n`."""
    return F.floor(F.log2("n") * 8).cast("int")


def frequent_enough(least: int | None) -> Column:
    return F.lit(False) if least is None else _step() >= least


def dictionary(words: DataFrame, size: int = DICTIONARY) -> tuple[Dictionary, int | None, bool]:
    """The words (word, n, ids) that occur most often, `size` at most, the lowest step of `n` among them, and whether
    there are others: words of the same step are in or out together."""
    counts = sorted(((r.s, r.c) for r in words.groupBy(_step().alias("s")).agg(F.count("*").alias("c")).collect()), reverse=True)
    least, total = None, 0
    for step, count in counts:
        if total + count > size:
            break
        least, total = step, total + count
    schema = pa.schema([(c, pa.binary()) for c in ("keys", "checks", "sizes", "narrow", "wide")])

    def packed(batches):
        """A task's words in as few bytes as they need, a row for some of them."""
        held, size = [], 0
        for b in itertools.chain(batches, [None]):
            if held and (b is None or size > _HELD):
                some = pa.Table.from_batches(held).combine_chunks()
                flat = pc.list_flatten(some["ids"]).to_numpy()
                kind = flat.max(initial=0) >= 1 << 16
                yield T.batch(schema, [some["k"].to_numpy().tobytes()], [some["c"].to_numpy().astype(np.uint32).tobytes()],
                              [pc.list_value_length(some["ids"]).to_numpy().astype(np.uint16).tobytes()],
                              [b"" if kind else flat.astype(np.uint16).tobytes()], [flat.astype(np.int32).tobytes() if kind else b""])
                held, size = [], 0
            if b is not None:
                held.append(b)
                size += len(b)

    rows = words.filter(frequent_enough(least)).select(
        F.xxhash64("word").alias("k"), F.xxhash64(F.lit("word"), "word").bitwiseAND(F.lit(0xFFFFFFFF)).alias("c"), "ids") \
        .mapInArrow(packed, "keys binary, checks binary, sizes binary, narrow binary, wide binary").toArrow()

    def column(name: str, kind: type) -> np.ndarray:
        return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x.as_buffer(), kind) for x in rows[name])])

    if any(pc.binary_length(rows["wide"]).to_pylist()):
        flat = np.concatenate([np.frombuffer(w.as_buffer(), np.int32) if len(w.as_buffer()) else np.frombuffer(x.as_buffer(), np.uint16)
                               for x, w in zip(rows["narrow"], rows["wide"])])
    else:
        flat = column("narrow", np.uint16)
    of = column("keys", np.uint64), column("checks", np.uint32), column("sizes", np.uint16), flat
    del rows
    pa.default_memory_pool().release_unused()
    return Dictionary(*of), least, total < sum(c for _, c in counts)


def _written(words: DataFrame) -> DataFrame:
    """`words` written to the shared folder. Few words are in a task, so their edges are grouped without sorting."""
    conf, name = words.sparkSession.conf, "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = conf.get(name)
    conf.set(name, "1000000")
    try:
        return checkpointed(words, "words")
    finally:
        conf.set(name, before)


def encode(docs: DataFrame, model: Model, size: int = DICTIONARY, digests: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, ids (array of piece ids); with `digests` n_tokens, ids_sha256 and text_sha256 as
    `with_digests` has them, made in the same pass.

    Texts become numbers of words once (`parted`), and different words are encoded once each. Every task holds the most
    frequent words with their ids; the others that a part of the documents has meet the table of all words, and come
    back to that part, whose sequences then take ids in place of numbers. Words of more than LONGEST characters
    are encoded where they occur. A null or empty text has no ids; a word is encoded with the space signs before it.
    Repeated documents give a row each, rows without an id too. Other columns are not read.
    """
    context = docs.sparkSession.sparkContext
    parts = parted(docs, model)
    words = _written(encoded(vocabulary(parts), model))
    frequent, least, others = dictionary(words, size)
    frequent, long_words = context.broadcast(frequent), context.broadcast(LongWords(model))
    rare_schema = pa.schema([("part", pa.int64()), ("at", pa.int32()), ("word", pa.string())])

    def rare(batches):
        for b in batches:
            for part, words in zip(b.column(0).to_pylist(), b.column(1)):
                words = _words_array(words.as_py())
                counts, _ = frequent.value.find(words)
                left = np.flatnonzero((counts == 0) & (pc.utf8_length(words).to_numpy() <= LONGEST))
                if len(left):
                    yield T.batch(rare_schema, np.full(len(left), part), left, words.take(pa.array(left)))

    if others:
        wanted = parts.select("part", "words").mapInArrow(rare, "part bigint, at int, word string")
        own = wanted.join(words.filter(~frequent_enough(least)).select("word", "ids"), "word") \
            .groupBy("part").agg(F.collect_list(F.struct("at", "ids")).alias("own"))
        parts = parts.join(own, "part", "left")
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("ids", pa.list_(pa.int32()))]
    if digests:
        fields[2:2] = [("n_tokens", pa.int64())]
        fields += [("ids_sha256", pa.string()), ("text_sha256", pa.string())]
    schema, texts = pa.schema(fields), model.texts

    def finish(batches):
        for b in batches:
            for ids, sizes, words, packed, *own in zip(*b.columns):
                words = _words_array(words.as_py())
                counts, flat = frequent.value.find(words)
                known = np.flatnonzero(counts)
                more = [(k, long_words.value.ids(words[k].as_py())) for k in np.flatnonzero(pc.utf8_length(words).to_numpy() > LONGEST).tolist()]
                if own and own[0].is_valid:
                    found = own[0].values
                    lists = found.field("ids")
                    more += zip(found.field("at").to_pylist(), np.split(lists.flatten().to_numpy(), np.cumsum(pc.list_value_length(lists).to_numpy())))
                starts = np.zeros(len(words), np.int64)
                starts[known] = np.cumsum(counts[known]) - counts[known]
                if more:
                    places, lists = [k for k, _ in more], [x for _, x in more]
                    counts[places] = [len(x) for x in lists]
                    starts[places] = len(flat) + np.cumsum(counts[places]) - counts[places]
                    flat = np.concatenate((flat, *lists))
                yield from _finished(schema, ids.values, _unpacked(sizes.as_py()), _unpacked(packed.as_py()), flat[_ragged(starts, counts)], counts, texts)

    columns = ["ids", "sizes", "words", "sequence", *(["own"] if others else [])]
    return parts.select(columns).mapInArrow(finish, "doc_id bigint, n_words bigint, n_tokens bigint, ids array<int>, ids_sha256 string, text_sha256 string"
                                            if digests else "doc_id bigint, n_words bigint, ids array<int>")


def _finished(schema: pa.Schema, docs: pa.Array, sizes: np.ndarray, sequence: np.ndarray, flat: np.ndarray, counts: np.ndarray,
              texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """The rows of a part: `flat` has the ids of its words, `counts` of each, which the sequence asks for."""
    digests, starts = len(schema) > 3, np.cumsum(counts) - counts
    if digests:
        of_id = pa.array([str(i) for i in range(len(texts))]).cast(pa.binary()), pa.array(texts, pa.binary())
        ends = pa.array(np.append(starts, counts.sum()), pa.int32())
        spelled = [pc.binary_join(pa.ListArray.from_arrays(ends, of.take(pa.array(flat))), between).to_pylist()
                   for of, between in zip(of_id, (b",", b""))]
    ends = np.cumsum(sizes)
    for low in range(0, len(sizes), 200):
        some = sequence[ends[low] - sizes[low]:ends[min(low + 200, len(sizes)) - 1]]
        many = counts[some]
        offsets = np.concatenate(([0], np.cumsum(many)))
        ids = flat[_ragged(starts[some], many)]
        borders = np.concatenate(([0], np.cumsum(sizes[low:low + 200])))
        lists = pa.ListArray.from_arrays(pa.array(offsets[borders], pa.int32()), pa.array(ids, pa.int32()))
        columns = [docs[low:low + 200], sizes[low:low + 200], lists]
        if digests:
            columns[2:2] = [np.diff(offsets[borders])]
            listed, hashes = some.tolist(), ([], [])
            for x, y in zip(borders[:-1].tolist(), borders[1:].tolist()):
                mine = listed[x:y]
                hashes[0].append(hashlib.sha256(b",".join([spelled[0][w] for w in mine])).hexdigest())
                text = b"".join([spelled[1][w] for w in mine])
                hashes[1].append(hashlib.sha256((text[1:] if text[:1] == b" " else text).decode(errors="replace").encode()).hexdigest())
            columns += hashes
        yield T.batch(schema, *columns)


def decoded(ids: list[int] | np.ndarray, texts: list[bytes]) -> str:
    """The text of some ids: that of their pieces, without the space that stands for its beginning. Bytes that are
    no UTF-8 come back as U+FFFD."""
    text = b"".join([texts[i] for i in ids])
    return (text[1:] if text[:1] == b" " else text).decode(errors="replace")


def decode(rows: DataFrame, model: Model) -> DataFrame:
    """`rows` (doc_id, n_words, ids) with `text` in place of `ids`; null ids give a null text."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("text", pa.string())])
    texts = model.texts

    def one(batches):
        for b in batches:
            for doc, n, ids in zip(*b.columns):
                yield T.batch(schema, [doc.as_py()], [n.as_py()], [None if not ids.is_valid else decoded(ids.values.to_numpy(), texts)])

    return rows.select("doc_id", "n_words", "ids").mapInArrow(one, "doc_id bigint, n_words bigint, text string")


def with_digests(rows: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, n_words, n_tokens, ids, ids_sha256 (of the ids, comma-joined), text_sha256 (of the
    decoded text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())),
                        ("ids_sha256", pa.string()), ("text_sha256", pa.string())])
    texts = model.texts

    def one(batches):
        for b in batches:
            for doc, n, ids in zip(*b.columns):
                numbers = ids.values.to_numpy()
                yield T.batch(schema, [doc.as_py()], [n.as_py()], [len(numbers)], [numbers],
                              [hashlib.sha256(",".join(map(str, numbers.tolist())).encode()).hexdigest()],
                              [hashlib.sha256(decoded(numbers, texts).encode()).hexdigest()])

    return rows.select("doc_id", "n_words", "ids").mapInArrow(
        one, "doc_id bigint, n_words bigint, n_tokens bigint, ids array<int>, ids_sha256 string, text_sha256 string")
