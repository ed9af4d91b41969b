"""Phrase collocations from word-level FM-indexes, one per shard.

A task gathers the pieces of its documents, per language, into shards of some SHARD words and indexes
each: the Burrows-Wheeler transforms of the word sequence and of its reverse. Words become phrases by
extending an interval of one transform and keeping that of the other in step; the size of an interval
is the phrase's count in the shard, and what the transforms hold within the two intervals are its left
and right extensions. Suffixes are sorted by as many words as the longest phrase has, which is all that
intervals of such phrases depend on.

Counts are summed across shards, level by level. A phrase of k + 1 words is looked for only where its
first and its last k words are frequent over all shards, so the many phrases met once are never spelled
out. A frequent word gets a number (the place in the first shard that has it), which returns to all its
shards; a longer phrase is known by the numbers of its words. Words cross the network as rows and are
summed as they stream by in order. Longer phrases cross it as blocks, one per shard and part of their
hashes: columns of numbers in order of their places, differences where neighbours are alike, bytes of equal
weight together and compressed. A task sums one part. What is frequent returns to its shards as places.
One shard names a phrase for all. The indexes themselves stay where they are: they are bucketed by
shard, and so is what returns to them.

Exact: counts are 64-bit, scores are quotients of 38-digit decimals.

Defined cases: a null text is empty, a null language is ``und``. Every row counts, repeated ones too;
identifiers and other columns are not read. An empty table, and one without frequent phrases, give an
empty result. Texts of any length are read in stretches that end at a piece's end; a single piece may
have some 16 million words.
"""

from __future__ import annotations

import collections
import functools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork.llm.common import landed, landed_by, map_batches, read_table, record_batch
from tillwork.llm.hashing import mix
from tillwork.llm.registry import query
from tillwork.session import shuffle_partitions

#: Words of a shard, and words a task holds of all languages together.
SHARD = 1 << 21
HELD = 1 << 22
#: Bytes of a text looked at together, and rows of a batch handed back.
STRETCH = 1 << 20
ROWS = 1 << 16
#: Occurrences extended together.
STEP = 1 << 18
#: Phrases of a shard packed together, and words of the input for each part that a task sums, at most.
PACKED = 1 << 19
SUMMED = 1 << 21

# The characters that end a piece.
ENDS = re.compile(rb"[.,;:!?\n-\r]")
_END = b"\xff"  # in no UTF-8 text
_TABLE = bytes(
    0xFF if ENDS.match(bytes([b])) else b + 32 if 65 <= b <= 90 else b for b in range(256)
)

#: Bits of a shard's number within its partition, and of a place within a shard.
_SHARDS, _PLACES = 16, 24
_LOW = 0xFFFFFFFF

INDEX = pa.schema(
    [("shard", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64())]
    + [(part, pa.binary()) for part in ("words", "forward", "backward")]
)
PLACED = [("shard", pa.int64()), ("place", pa.int64()), ("edges", pa.int64())]
WORDS = pa.schema([("lang", pa.string()), ("word", pa.string()), *PLACED])
KEPT = pa.schema([("shard", pa.int64()), ("packed", pa.binary())])
BLOCKS = pa.schema([("part", pa.int32()), ("shard", pa.int64()), ("packed", pa.binary())])
GRAMS = pa.schema(
    [("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32())]
    + [(count, pa.int64()) for count in ("f", "lefts", "rights")]
)


def _ddl(schema: pa.Schema) -> str:
    names = {"int64": "long", "int32": "int"}
    return ", ".join(f"{f.name} {names.get(str(f.type), str(f.type))}" for f in schema)


def _stretches(body: bytes) -> Iterator[bytes]:
    begin = 0
    while len(body) - begin > STRETCH and (end := ENDS.search(body, begin + STRETCH)):
        yield body[begin : end.end()]
        begin = end.end()
    yield body[begin:]


class _Gathered:
    """The pieces of one language as word numbers, zero at the end of each."""

    def __init__(self):
        self.numbers: dict[bytes, int] = collections.defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.numbers[_END] = 0
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, body: bytes) -> int:
        tokens = body.translate(_TABLE).replace(_END, b" \xff ").split()
        tokens.append(_END)
        part = np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens))
        part = part[(part > 0) | (np.concatenate([[0], part[:-1]]) > 0)]
        self.parts.append(part)
        self.size += len(part)
        return len(part)


def _sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes, sorted by their first ``depth`` symbols or more: in one go where these
    fit into 63 bits, else by doubling."""
    rank, reach = text.astype(np.int64), 1
    bits = max(int(rank.max(initial=0)).bit_length(), 1)
    if bits * depth <= 63:
        padded = np.concatenate([rank, np.zeros(depth, np.int64)])
        for k in range(1, depth):
            rank = rank << bits | padded[k : k + len(text)]
        return np.argsort(rank)
    while True:
        after = np.concatenate([rank[reach:], np.zeros(min(reach, len(rank)), np.int64)])[: len(rank)]
        rank = rank * (int(rank.max(initial=0)) + 1) + after
        reach *= 2
        if reach >= depth:
            return np.argsort(rank)
        rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)


def _transform(text: np.ndarray, depth: int) -> bytes:
    before = text[_sorted_suffixes(text, depth) - 1]
    # Low bytes together, high bytes together: most high ones are zero.
    planes = before.astype("<i4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes))


class _Side:
    """One transform with its rank structure: the places of every symbol, in order."""

    def __init__(self, packed: bytes):
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
        self.bwt = np.ascontiguousarray(raw.reshape(4, -1).T).view("<i4").ravel()
        self.n = len(self.bwt)
        self._places = np.sort(self.bwt * np.int64(self.n) + np.arange(self.n))
        #: First symbol of a suffix, and the row of the suffix one word shorter.
        self.first = np.repeat(
            np.arange(self.bwt.max(initial=0) + 1, dtype=np.int32), np.bincount(self.bwt)
        )
        self.next = (self._places - self.first * np.int64(self.n)).astype(np.int32)
        self._inside = np.concatenate([[0], np.cumsum(self.bwt > 0, dtype=np.int32)], dtype=np.int32)

    def extended(self, symbol: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Where the interval begins once ``symbol`` stands before its phrases."""
        return np.searchsorted(self._places, symbol * np.int64(self.n) + lo)

    def followed(self, lo: np.ndarray, f: np.ndarray) -> np.ndarray:
        """How often the phrases have a word there."""
        return self._inside[lo + f] - self._inside[lo]


class ShardIndex:
    """Both transforms of a shard, and the phrases their intervals stand for."""

    def __init__(self, row: pa.RecordBatch):
        self.shard, self.lang = row["shard"][0].as_py(), row["lang"][0].as_py()
        self._row = row
        words = zstandard.ZstdDecompressor().decompress(row["words"][0].as_py())
        self.words = pa.array(words.split(b" "), pa.binary()).cast(pa.string())

    @functools.cached_property
    def forward(self) -> _Side:
        return _Side(self._row["forward"][0].as_py())

    @functools.cached_property
    def backward(self) -> _Side:
        return _Side(self._row["backward"][0].as_py())

    def single_words(self) -> tuple[np.ndarray, np.ndarray]:
        """Intervals, alike in both transforms, of every word."""
        f = np.bincount(self.forward.bwt, minlength=len(self.words) + 1)
        return (np.cumsum(f) - f)[1:], f[1:]

    def kept(self, words: int) -> dict[str, np.ndarray]:
        """What the row brings of frequent phrases, by place. A word's place is its own number."""
        blocks = self._row[f"kept_{words}"][0].as_py()
        if not blocks:
            return {}
        rows, _ = _unpacked(blocks, RETURNED)
        rows = rows[np.argsort(rows["at"])]
        return {name: rows[name].astype(np.int64) for name in RETURNED.names}

    def spelled(self, lo: np.ndarray, words: int) -> np.ndarray:
        """Word numbers of the phrases whose intervals begin at ``lo``."""
        out, row = np.empty((len(lo), words), np.int64), lo
        for k in range(words):
            out[:, k] = self.forward.first[row]
            row = self.forward.next[row]
        return out

    def backward_rows(self, spelled: np.ndarray) -> np.ndarray:
        lo = np.searchsorted(self.backward.first, spelled[:, 0])
        for k in range(1, spelled.shape[1]):
            lo = self.backward.extended(spelled[:, k], lo)
        return lo

    def to_the_right(self, lo, rlo, f) -> Iterator[tuple[np.ndarray, ...]]:
        """Every extension by one word, some STEP occurrences at a time: its intervals, its count."""
        ends = np.cumsum(f)
        cuts = np.searchsorted(ends, np.arange(STEP, ends[-1] if len(f) else 0, STEP)) + 1
        for part in np.split(np.arange(len(f)), np.unique(cuts)):
            if len(part):
                part = slice(part[0], part[-1] + 1)
                yield self._extended(lo[part], rlo[part], f[part])

    def _extended(self, lo, rlo, f) -> tuple[np.ndarray, ...]:
        owner = np.repeat(np.arange(len(f)), f)
        begin = np.cumsum(f) - f
        symbol = self.backward.bwt[np.arange(len(owner)) - begin[owner] + rlo[owner]]
        kinds = len(self.words) + 1
        key, count = np.unique(owner * kinds + symbol, return_counts=True)
        owner, symbol = key // kinds, key % kinds
        before = np.cumsum(count) - count
        # Lesser words of the same phrase come first in the forward transform.
        new_lo = lo[owner] + before - before[np.searchsorted(owner, owner)]
        real = symbol > 0
        owner, symbol = owner[real], symbol[real]
        return new_lo[real], self.backward.extended(symbol, rlo[owner]), count[real]

    def edges(self, lo, rlo, f) -> np.ndarray:
        """How often phrases begin a piece, and how often they end one, in one number."""
        begins, ends = f - self.forward.followed(lo, f), f - self.backward.followed(rlo, f)
        return begins.astype(np.int64) << 32 | ends

    def named(self, numbers: np.ndarray, f, lefts, rights) -> Iterator[pa.RecordBatch]:
        """Phrases in full, with counts of them and of their sides."""
        words = numbers.shape[1]
        for begin in range(0, len(numbers), ROWS):
            part = slice(begin, begin + ROWS)
            some = [self.words.take(pa.array(column - 1)) for column in numbers[part].T]
            phrase = pc.binary_join_element_wise(*some, " ") if words > 1 else some[0]
            same = (pa.repeat(self.lang, len(phrase)), pa.repeat(pa.scalar(words, pa.int32()), len(phrase)))
            counts = (pa.array(count[part], pa.int64()) for count in (f, lefts, rights))
            yield pa.RecordBatch.from_arrays([same[0], phrase, same[1], *counts], schema=GRAMS)

    def placed(self, schema: pa.Schema, keys: list, lo, rlo, f, at=None) -> pa.RecordBatch:
        """Phrases by their keys: the shard, the interval and the count in one number, the edges."""
        place = (lo if at is None else at) << 32 | f
        return record_batch(schema, *keys, pa.repeat(self.shard, len(lo)), place, self.edges(lo, rlo, f))


def _row_of(words: int) -> np.dtype:
    """A phrase in a block: the numbers of its words, its interval's begin and size, its edges."""
    numbers = [(f"word_{k}", "<i8") for k in range(words)]
    return np.dtype(numbers + [(name, "<i4") for name in ("lo", "f", "begins", "ends")])


#: What returns to a shard of a frequent phrase: where it is and how often there, and for all shards, its
#: number if it is a word, and its sums if this shard names it.
RETURNED = np.dtype(
    [("at", "<i4"), ("own", "<i4")] + [(name, "<i8") for name in ("number", "f", "lefts", "rights")]
)
#: Neighbours in order of their places are alike in these: blocks have their differences.
_ALIKE = {"word_0", "lo", "at"}


def _spread(rows: np.ndarray) -> np.ndarray:
    """A hash of the words of each phrase."""
    out = np.zeros(len(rows), np.uint64)
    for name in rows.dtype.names:
        if name.startswith("word_"):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + rows[name].astype(np.uint64))
    return out


def _packed(rows: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Rows, which this changes, as blocks that begin at ``first``."""
    for name in _ALIKE.intersection(rows.dtype.names):
        whole = rows[name].copy()
        rows[name][1:] -= whole[:-1]
        rows[name][first] = whole[first]
    raw = rows.view(np.uint8).reshape(len(rows), rows.dtype.itemsize)
    pack = zstandard.ZstdCompressor(level=1).compress
    return [pack(raw[a:b].T.tobytes()) for a, b in zip(first, [*first[1:], len(rows)])]


def _unpacked(blocks: list[bytes], row: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The rows of blocks, and how many each block has."""
    unpack = zstandard.ZstdDecompressor().decompress
    planes = [np.frombuffer(unpack(block), np.uint8).reshape(row.itemsize, -1) for block in blocks]
    sizes = np.array([part.shape[1] for part in planes])
    raw = np.empty((sizes.sum(), row.itemsize), np.uint8)
    first = np.cumsum(sizes) - sizes
    for begin, part in zip(first, planes):
        raw[begin : begin + part.shape[1]] = part.T
    rows = raw.view(row).ravel()
    for name in _ALIKE.intersection(row.names):
        step = rows[name].copy()
        sums = np.cumsum(step, dtype=step.dtype)
        rows[name] = sums - np.repeat(sums[first] - step[first], sizes)
    return rows, sizes


def _blocks(shard: int, rows: np.ndarray, parts: int) -> pa.RecordBatch:
    """Phrases of a shard, in order of their places, as a block for each part."""
    part = (_spread(rows) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    part = part.astype(np.uint16 if parts <= 1 << 16 else np.uint32)
    order = np.argsort(part, kind="stable")
    part = part[order]
    first = np.flatnonzero(np.diff(part.astype(np.int64), prepend=-1))
    return record_batch(BLOCKS, part[first].astype(np.int32), [shard] * len(first), _packed(rows[order], first))


def _returns(shard: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """What returns to each shard, as a block."""
    order = np.lexsort((columns["at"], shard))
    rows = np.empty(len(shard), RETURNED)
    for name in RETURNED.names:
        rows[name] = columns[name][order]
    first = np.flatnonzero(np.diff(shard[order], prepend=-1))
    return record_batch(KEPT, shard[order][first], _packed(rows, first))


def shard_indexes(docs: DataFrame, max_words: int = 3, lang: str = "lang", text: str = "text") -> DataFrame:
    """The index of every shard: number, language, and compressed, its words and both transforms."""
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, held = collections.defaultdict(_Gathered), 0
        number = TaskContext.get().partitionId() << _SHARDS

        def ended(name: str) -> pa.RecordBatch:
            nonlocal held, number
            shard = gathered.pop(name)
            held -= shard.size
            number += 1
            body = np.concatenate(shard.parts)
            words = b" ".join(word for word in shard.numbers if word != _END)
            turned = np.concatenate([body[:-1][::-1], [0]])
            packed = [zstandard.ZstdCompressor(level=1).compress(words)]
            packed += [_transform(side, max_words) for side in (body, turned)]
            n_words = int(np.count_nonzero(body))
            return record_batch(INDEX, [number], [name], [n_words], *([part] for part in packed))

        for batch in batches:
            for name, body in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                for stretch in _stretches(body):
                    held += gathered[name].add(stretch)
                    if gathered[name].size >= SHARD:
                        yield ended(name)
                    elif held >= HELD:
                        yield ended(max(gathered, key=lambda other: gathered[other].size))
        for name in list(gathered):
            yield ended(name)

    return map_batches(rows, work, _ddl(INDEX))


def _opened(batches: Iterable[pa.RecordBatch]) -> Iterator[ShardIndex]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield ShardIndex(batch.slice(i, 1))


def _word_places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for index in _opened(batches):
        lo, f = index.single_words()
        for begin in range(0, len(lo), ROWS):
            part = slice(begin, begin + ROWS)
            keys = [pa.repeat(index.lang, len(lo[part])), index.words[part]]
            number = np.arange(begin, begin + len(lo[part])) + 1
            yield index.placed(WORDS, keys, lo[part], lo[part], f[part], number)


def _names(max_words: int):
    """The phrases this shard names for all, with their sums over all shards."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index in _opened(batches):
            for words in range(1, max_words + 1):
                kept = index.kept(words)
                names = kept["f"] > 0 if kept else np.zeros(0, bool)
                if names.any():
                    at = kept["at"][names]
                    numbers = index.spelled(at, words) if words > 1 else at[:, None]
                    yield from index.named(numbers, *(kept[c][names] for c in ("f", "lefts", "rights")))

    return work


def _longer(words: int, parts: int):
    """Phrases one word longer than the kept ones, where the last words are kept as well, in blocks."""
    row = _row_of(words + 1)

    def found_in(index: ShardIndex) -> Iterator[np.ndarray]:
        single, kept = index.kept(1), index.kept(words)
        numbers = np.zeros(len(index.words) + 1, np.int64)
        numbers[single["at"]] = single["number"]
        lo = kept["at"] if words > 1 else np.searchsorted(index.forward.first, kept["at"])
        f = kept["own"]
        rlo = index.backward_rows(index.spelled(lo, words))
        for found in index.to_the_right(lo, rlo, f):
            # The row one word shorter lies in the interval of the last words.
            shorter = index.forward.next[found[0]]
            of = np.searchsorted(lo, shorter, "right") - 1
            both = (of >= 0) & (shorter < lo[of] + f[of])
            new_lo, new_rlo, count = (a[both] for a in found)
            rows = np.empty(len(new_lo), row)
            for k, spelled in enumerate(index.spelled(new_lo, words + 1).T):
                rows[f"word_{k}"] = numbers[spelled]
            edges = index.edges(new_lo, new_rlo, count)
            rows["lo"], rows["f"], rows["begins"], rows["ends"] = new_lo, count, edges >> 32, edges & _LOW
            yield rows

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index in _opened(batches):
            held, size = [], 0
            for rows in found_in(index):
                held.append(rows)
                size += len(rows)
                if size >= PACKED:
                    yield _blocks(index.shard, np.concatenate(held), parts)
                    held, size = [], 0
            if size:
                yield _blocks(index.shard, np.concatenate(held), parts)

    return work


def _summed(words: int, least: int, returns: bool):
    """The blocks of a part to its frequent phrases, as a block per shard; one shard of a phrase also gets
    the sums. Without ``returns`` no other shard gets any."""

    def changes(columns: list[np.ndarray]) -> np.ndarray:
        new = np.zeros(len(columns[0]), bool)
        new[:1] = True
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
        return new

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, blocks = [], []
        for batch in batches:
            shards += batch["shard"].to_pylist()
            blocks += batch["packed"].to_pylist()
        if not blocks:
            return
        rows, sizes = _unpacked(blocks, _row_of(words))
        shard = np.repeat(np.array(shards), sizes)
        hashes = _spread(rows)
        order = np.argsort(hashes)
        keys = [rows[f"word_{k}"][order] for k in range(words)]
        new = changes(keys)
        if new.sum() > changes([hashes[order]]).sum():
            # Phrases of one hash may alternate.
            order = np.lexsort([rows[f"word_{k}"] for k in range(words)])
            new = changes([rows[f"word_{k}"][order] for k in range(words)])
        first = np.flatnonzero(new)
        f, begins, ends = (
            np.add.reduceat(rows[c][order], first, dtype=np.int64) for c in ("f", "begins", "ends")
        )
        of = np.cumsum(new) - 1
        stays = np.flatnonzero((f >= least)[of] & (returns | new))
        of, leads, at = of[stays], new[stays].astype(np.int64), order[stays]
        counts = {name: count[of] * leads for name, count in (("f", f), ("lefts", f - begins), ("rights", f - ends))}
        yield _returns(shard[at], at=rows["lo"][at], own=rows["f"][at], number=np.zeros(len(at)), **counts)

    return work


def _merged(keys: list[str], least: int, returns: bool):
    """Placed words in order of their hash to those that are frequent, as a block per shard; the first
    shard of a phrase also gets the sums. Without ``returns`` no other shard gets any. Holds ROWS rows,
    or the rows of one hash: at most one a shard and phrase."""

    def changes(rows: pa.Table, names: list[str]) -> np.ndarray:
        new = np.zeros(rows.num_rows, bool)
        new[:1] = True
        for name in names:
            column = rows[name].combine_chunks()
            new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        return new

    def sums(rows: pa.Table) -> pa.RecordBatch:
        new = changes(rows, keys)
        if new.sum() > changes(rows, ["_hash"]).sum():
            # Phrases of one hash may alternate.
            rows = rows.sort_by([(name, "ascending") for name in ("_hash", *keys)])
            new = changes(rows, keys)
        first = np.flatnonzero(new)
        shard, place, edges = (rows[c].to_numpy() for c in ("shard", "place", "edges"))
        f = np.add.reduceat(place & _LOW, first)
        begins, ends = np.add.reduceat(edges >> 32, first), np.add.reduceat(edges & _LOW, first)
        of = np.cumsum(new) - 1
        leads = new.astype(np.int64)
        stays = np.flatnonzero((f >= least)[of] & (returns | new))
        of, leads, shard = of[stays], leads[stays], shard[stays]
        number = (rows["shard"].to_numpy()[first] << _PLACES | place[first] >> 32)[of]
        counts = {name: count[of] * leads for name, count in (("f", f), ("lefts", f - begins), ("rights", f - ends))}
        return _returns(shard, at=place[stays] >> 32, own=place[stays] & _LOW, number=number, **counts)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= ROWS:
                rows = pa.Table.from_batches(held).combine_chunks()
                last = np.flatnonzero(changes(rows, ["_hash"]))[-1]
                if last:
                    yield sums(rows.slice(0, last))
                held = rows.slice(last).to_batches()
                size = rows.num_rows - last if last else 0
        if sum(batch.num_rows for batch in held):
            yield sums(pa.Table.from_batches(held).combine_chunks())

    return work


def _returned(kept: DataFrame, words: int) -> DataFrame:
    """shard, and the blocks of its frequent phrases, in the buckets of the indexes."""
    name = f"kept_{words}"
    return landed_by(kept.groupBy("shard").agg(F.collect_list("packed").alias(name)), "shard", name)


def _frequent_words(placed: DataFrame, least: int, returns: bool) -> DataFrame:
    """One exchange: a word has at most one row in a shard. A single number to sort by lets Spark sort by
    radix. The first shards number words: small numbers."""
    keys = ["lang", "word"]
    in_order = placed.repartition(*keys).withColumn("_hash", F.xxhash64(*keys)).sortWithinPartitions("_hash", "shard")
    kept = map_batches(in_order, _merged(keys, least, returns), _ddl(KEPT))
    # Rows are narrow, and batches bounded in bytes anyway.
    placed.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    return _returned(kept, 1)


def _frequent_phrases(shards: DataFrame, words: int, parts: int, least: int, returns: bool) -> DataFrame:
    """Phrases of ``words`` words that extend the kept ones. A part's blocks are those of one task."""
    blocks = map_batches(shards, _longer(words - 1, parts), _ddl(BLOCKS)).repartitionById(parts, "part")
    return _returned(map_batches(blocks, _summed(words, least, returns), _ddl(KEPT)), words)


def phrase_counts(index: DataFrame, max_words: int = 3, least: int = 10) -> DataFrame:
    """lang, phrase, words, f, lefts, rights of every phrase of up to ``max_words`` words that occurs
    ``least`` times or more. ``lefts`` and ``rights`` count the occurrences with a word before and after
    them in their piece. ``index``: of ``shard_indexes`` for as many words, landed."""
    total = index.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    parts = max(shuffle_partitions(index.sparkSession), -(-total // SUMMED))
    levels = [_frequent_words(map_batches(index, _word_places, _ddl(WORDS)), least, max_words > 1)]
    for words in range(2, max_words + 1):
        shards = index
        for level in {0, words - 2}:
            shards = shards.join(levels[level], "shard")
        levels.append(_frequent_phrases(shards, words, parts, least, words < max_words))
    shards = index
    for level in levels:
        shards = shards.join(level, "shard", "left")
    return map_batches(shards, _names(max_words), _ddl(GRAMS))


def collocations(
    docs: DataFrame, max_words: int = 3, least: int = 10, inside_percent: int = 50, top: int = 2000
) -> DataFrame:
    """Each language's ``top`` phrases of two words or more: lang, rank, phrase, a, l, r, n, score."""
    index = landed_by(shard_indexes(docs, max_words), "shard", "fm-index")
    frequent = landed(phrase_counts(index, max_words, least), "phrase-counts")
    totals = index.groupBy("lang").agg(F.sum("n_words").alias("n"))
    candidates = frequent.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    # Phrases inside a longer one, with the most frequent of those around them.
    part = F.explode(
        F.expr(
            "flatten(transform(sequence(2, words - 1), size -> "
            "transform(sequence(1, words - size + 1), b -> array_join(slice(split(phrase, ' '), b, size), ' '))))"
        )
    )
    around = (
        candidates.where("words > 2")
        .select("lang", part.alias("phrase"), F.col("a").alias("longer"))
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    alone = candidates.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a"))
    )
    split = F.split("phrase", " ")

    def some(begin, size):
        return F.array_join(F.slice(split, begin, size), " ")

    # Both parts of a cut make the phrase: it need not travel with them.
    cuts = alone.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "a", "k", some(F.lit(1), F.col("k")).alias("first"), some(F.col("k") + 1, F.col("words")).alias("rest")
    )
    for known, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(frequent.select("lang", F.col("phrase").alias(known), F.col("f").alias(count)), ["lang", known])
    a, left, right = (F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r"))
    score = F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), left * right)
    scored = cuts.groupBy("lang", F.concat_ws(" ", "first", "rest").alias("phrase"), "a").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    )
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, 1 AS words, unnest(w) AS phrase FROM worded
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM worded
  UNION ALL SELECT lang, 3,
    unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM worded),
counts AS (SELECT lang, words, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE words = 1 GROUP BY lang),
candidates AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE words > 1 AND f >= 10),
cuts AS (
  SELECT lang, words, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM candidates, unnest([1, 2]) AS u(k) WHERE k < words),
scores AS (
  SELECT c.lang, c.words, c.phrase, c.a, k, x.f AS l, y.f AS r,
    (1000000 * c.a::HUGEINT * c.a) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = head JOIN counts y ON y.lang = c.lang AND y.phrase = tail),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (
  SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM candidates WHERE words = 3),
alone AS (
  SELECT * FROM lowest t WHERE NOT EXISTS (
    SELECT 1 FROM parts p WHERE t.words = 2 AND p.lang = t.lang AND p.phrase = t.phrase AND 100 * p.a >= 50 * t.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
  n::BIGINT AS n, score::BIGINT AS score
FROM alone JOIN totals USING (lang) QUALIFY rank <= 2000
"""


@query(SQL)
def op12_phrase_mining(spark, sf_dir):
    """The collocations of two and three words of every language."""
    return collocations(read_table(spark, sf_dir, "documents"))
