"""Suffix-array deduplication, over bytes.

Only places that winnowed anchors point to can hold a long repeat. An anchor's frame is all that the runs
of LEAST bytes touch whose least gram it is, so every run lies in one frame. Anchors that occur once are
dropped; where the whole frame around an anchor occurs again, all of it is repeated; for each of the remaining
different frames of an anchor, one occurrence is cut out. Frames that share an anchor meet in one task,
which joins them to stretches of text, leaves out what lies in no run of LEAST bytes that occurs twice by
hash, sorts all suffixes of the rest (prefix doubling), and scans the common prefixes of neighbours with
a stack: that walks the tree of common-prefix intervals. An interval whose
suffixes are preceded by different bytes cannot be extended to the left: it is a maximal repeat, with
all its occurrences.

An anchor with more than CROWD different frames (a passage in very many places) is dealt in parts, by
stretch of a document. Each part is sorted like others and also reports its runs of LEAST bytes by hash, one row for
those that it found repeated; counting them finds what occurs once in several parts.

Defined cases: a null text is empty. Identifiers play no part in what is removed; rows that repeat
identifier and text are different places. Texts shorter than LEAST bytes keep everything; an empty
table gives an empty result. Columns besides doc_id and text play no part.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.anchors import ROW, OwnWinnowing, Winnowing, anchor_rows, covered, keyed, same_row, with_spans
from tillwork.llm.common import landed, map_batches, read_table, record_batch
from tillwork.llm.hashing import Runs, mix, run_hashes
from tillwork.llm.registry import query

LEAST = 200
WINNOWING = OwnWinnowing(least=LEAST, gram=40)
#: Different frames of one anchor that are sorted together.
CROWD = 4096
#: Bytes of frames of several anchors that are sorted together; bounds memory only.
TOGETHER = 1 << 20

_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def _units(text: str) -> np.ndarray:
    return _BYTE[np.frombuffer(text.encode(), np.uint8)]


def suffix_array(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and how much each shares with the one before it, where that is at
    least ``least`` (else 0).

    Prefixes double in length; only suffixes that are not told apart yet are sorted again. A rank is
    the place of the first suffix of equal prefix, so ranks of the others stay.
    """
    n = len(symbols)
    ranks, step = [], 1
    dense = symbols
    if n and (symbols.min() < 0 or symbols.max() >= (1 << 16) - 1):
        dense = np.unique(symbols, return_inverse=True)[1]
    if n >= 4 and dense.max() < (1 << 16) - 1:
        # Four symbols at once.
        wide = np.concatenate([dense.astype(np.uint64) + np.uint64(1), np.zeros(3, np.uint64)])
        key = wide[:n]
        for k in range(1, 4):
            key = key << np.uint64(16) | wide[k : n + k]
        step = 4
    else:
        key = symbols
    rank, active = np.zeros(n, np.int32), np.arange(n)
    while True:
        by_key = np.argsort(key)
        active, key = active[by_key], key[by_key]
        at = np.arange(len(active))
        group = rank[active]
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        new = np.concatenate([[True], key[1:] != key[:-1]]) | new_group
        first = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[active] = group + first - np.maximum.accumulate(np.where(new_group, at, 0))
        ranks.append(rank)
        alone = new & np.concatenate([new[1:], [True]])
        active = np.sort(active[~alone])
        if not len(active):
            break
        later = np.zeros(len(active), np.int64)
        inside = active + step < n
        later[inside] = rank[active[inside] + step] + 1
        key = rank[active].astype(np.int64) * (n + 1) + later
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)

    first_step = step >> (len(ranks) - 1)
    level = max((i for i in range(len(ranks)) if first_step << i <= least), default=0)
    shared = np.zeros(n, np.int64)
    pairs = np.arange(1, n)
    if first_step <= least:
        pairs = pairs[ranks[level][order[:-1]] == ranks[level][order[1:]]]
    a, b = order[pairs - 1], order[pairs]
    begin = a.copy()
    for i in [*range(len(ranks) - 1, -1, -1), *([-1] * (first_step - 1))]:
        inside = (a < n) & (b < n)
        look = symbols if i < 0 else ranks[i]
        same = np.zeros(len(a), bool)
        same[inside] = look[a[inside]] == look[b[inside]]
        reach = 1 if i < 0 else first_step << i
        a, b = a + same * reach, b + same * reach
    length = a - begin
    shared[pairs] = np.where(length >= least, length, 0)
    return order, shared


def maximal_repeats(
    order: np.ndarray, shared: np.ndarray, before: np.ndarray, least: int
) -> Iterator[tuple[int, np.ndarray]]:
    """(length, places) of every repeat of ``least`` or more that extends neither way.

    ``before`` is the symbol before each place, different for each place where text begins.
    """
    previous = before[order]
    changes = np.concatenate([[0], np.cumsum(previous[1:] != previous[:-1])])
    long = np.concatenate([shared >= least, [False]])
    edges = np.flatnonzero(long[1:] != long[:-1]) + 1
    for first, stop in zip(edges[::2], edges[1::2]):
        # Suffixes first - 1 .. stop - 1 share at least so much with their neighbours.
        open_: list[list[int]] = []  # [length, leftmost suffix] of the intervals around the scan
        kinds = changes[first - 1 : stop].tolist()
        for i, length in enumerate([*shared[first:stop].tolist(), 0], first):
            left = i - 1
            while open_ and open_[-1][0] > length:
                whole, left = open_.pop()
                # Left-diverse: the symbols before the occurrences are not all the same.
                if kinds[i - first] > kinds[left - first + 1]:
                    yield whole, order[left:i]
            if length and (not open_ or open_[-1][0] < length):
                open_.append([length, left])


def stretches(frames: list[tuple]) -> tuple[np.ndarray, np.ndarray, list, np.ndarray, np.ndarray]:
    """Frames (owner, start, bytes) joined to stretches of text, each byte of a text once.

    Gives symbols (bytes; a different one after each stretch), the symbol before each place, the
    owners, and for every place its owner's number and its place in the owner's text.
    """
    by_owner = defaultdict(list)
    for owner, start, data in frames:
        by_owner[owner].append((start, data))
    symbols, owners, numbers, places, breaks = [], [], [], [], 0
    for owner, parts in by_owner.items():
        parts.sort(key=lambda part: part[0])
        joined: list[tuple[int, bytearray]] = []
        for start, data in parts:
            if joined and start <= joined[-1][0] + len(joined[-1][1]):
                begin, text = joined[-1]
                text += data[max(0, begin + len(text) - start) :]
            else:
                joined.append((start, bytearray(data)))
        for begin, text in joined:
            symbols.append(np.frombuffer(bytes(text), np.uint8).astype(np.int64))
            symbols.append(np.array([256 + breaks]))
            breaks += 1
            numbers.append(np.full(len(text) + 1, len(owners)))
            places.append(np.arange(begin, begin + len(text) + 1))
        owners.append(owner)
    flat = np.concatenate(symbols)
    before = np.concatenate([[-1], flat[:-1]])
    return flat, before, owners, np.concatenate(numbers), np.concatenate(places)


def met_twice(
    symbols: np.ndarray, before: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols that lie in a run of ``least`` whose hash occurs twice, with a new symbol after each
    piece; the symbols before them; and where they come from.

    Every run of ``least`` symbols in a repeat occurs twice, so repeats stay whole, and what follows
    two occurrences differs or is cut off. Runs of equal hash that differ only leave more to sort.
    """
    n = len(symbols)
    starts = np.arange(max(0, n - least + 1))
    hashes = Runs(mix(symbols.astype(np.uint64) + np.uint64(1))).hashes(starts, starts + least)
    by_hash = np.argsort(hashes)
    equal = np.diff(hashes[by_hash]) == 0
    twice = np.zeros(len(starts), np.int64)
    twice[by_hash[1:][equal]] = 1
    twice[by_hash[:-1][equal]] = 1
    depth = np.zeros(n + 1, np.int64)
    depth[: len(starts)] += twice
    depth[least : least + len(starts)] -= twice
    at = np.flatnonzero(np.cumsum(depth)[:n])
    stops = np.append(np.flatnonzero(np.diff(at) > 1) + 1, len(at)) if len(at) else at
    fresh = symbols.max() + 1 + np.arange(len(stops))
    return np.insert(symbols[at], stops, fresh), np.insert(before[at], stops, 0), np.insert(at, stops, 0)


def _suffix_sorted(least: int):
    schema = pa.schema([(name, pa.int64()) for name in ("_id", "_row", "start", "end", "h1", "h2")])

    def repeats(frames: list[tuple], split: bool) -> Iterator[pa.RecordBatch]:
        symbols, before, owners, number, place = stretches(frames)
        n = len(symbols)
        reach = np.zeros(n, np.int64)
        again, ahead, origin = met_twice(symbols, before, least)
        order, shared = suffix_array(again, least) if len(again) else (again, again)
        for length, places in maximal_repeats(order, shared, ahead, least):
            places = origin[places]
            reach[places] = np.maximum(reach[places], length)

        def rows(at, start, end, h1, h2) -> pa.RecordBatch:
            ids = pa.array([owners[i][0] for i in number[at].tolist()], pa.int64())
            return record_batch(schema, ids, [owners[i][1] for i in number[at].tolist()], start, end, h1, h2)

        # Repeats that overlap are one span.
        ends = np.maximum.accumulate(np.arange(n) + reach)
        at = np.flatnonzero(reach)
        if len(at):
            fresh = np.concatenate([[True], at[1:] > ends[at[:-1]]])
            first = at[fresh]
            last = np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(at) - 1]])
            stop = ends[at[last]]
            none = pa.nulls(len(first), pa.int64())
            yield rows(first, place[first], place[first] + stop - first, none, none)
        if split:
            # Others of this anchor are elsewhere: every run is reported, known repeats once (with
            # an end); those that were met once may still be met there.
            room = np.flatnonzero(symbols > 255)[np.cumsum(symbols > 255) - (symbols > 255)] - np.arange(n)
            starts = np.flatnonzero(room >= least)
            h1, h2 = run_hashes(_BYTE[np.minimum(symbols, 255)], starts, least)
            known = ends[starts] - starts >= least
            _, one = np.unique(h1[known], return_index=True)
            keep = np.sort(np.concatenate([np.flatnonzero(~known), np.flatnonzero(known)[one]]))
            at, known = starts[keep], known[keep]
            yield rows(at, place[at], pa.array(place[at] + least, mask=~known), h1[keep], h2[keep])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames, size, last = [], 0, None
        for batch in batches:
            columns = ("_id", "_row", "start", "bytes", "gram", "part", "parts")
            for id_, row, start, data, gram, part, parts in zip(
                *(batch.column(c).to_pylist() for c in columns)
            ):
                # Rows come sorted by anchor and part, and those of one meet here. Split anchors are
                # sorted by themselves, others together.
                key = (gram, part, parts > 1)
                if frames and key != last and (size >= TOGETHER or key[2] or last[2]):
                    yield from repeats(frames, last[2])
                    frames, size = [], 0
                last = key
                frames.append(((id_, row), start, data))
                size += len(data)
        if frames:
            yield from repeats(frames, last[2])

    return work


def _cut_out():
    schema = pa.schema(
        [
            ("_id", pa.int64()), ("_row", pa.int64()), ("gram", pa.int64()), ("parts", pa.int64()),
            ("start", pa.int64()), ("bytes", pa.binary()),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = ("_id", "_row", "_text", "_at")
            for id_, row, text, spots in zip(*(batch.column(c).to_pylist() for c in columns)):
                data = text.encode()
                for spot in spots:
                    start = spot["at"] - (spot["room"] >> 32)
                    frame = data[start : spot["at"] + (spot["room"] & 0xFFFFFFFF)]
                    out.append((id_, row, spot["gram"], spot["parts"], start, frame))
            if out:
                yield record_batch(schema, *zip(*out))

    return work


def counted_frames(seeds: DataFrame) -> DataFrame:
    """Every different frame of an anchor, how often it occurs, and one of its places.

    Any place will do: all are whole repeats where there are several. The first one needs fixed space in
    a hash table; the least as a struct would sort all seeds twice.
    """
    one = (F.first(name).alias(name) for name in ("_id", "_row", "at", "room"))
    return seeds.groupBy("gram", "frame").agg(F.count("*").alias("n"), *one)


def repeated_spans(rows: DataFrame, winnowing: Winnowing = WINNOWING, crowd: int = CROWD) -> DataFrame:
    """Spans of bytes (_id, _row, start, end) that also start elsewhere."""
    anchors = landed(anchor_rows(rows, winnowing, _units), "suffix-anchors")
    shared = anchors.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    seeds = landed(anchors.join(landed(shared, "suffix-shared"), "gram"), "suffix-seeds")

    frames = landed(counted_frames(seeds), "suffix-frames-counted")
    whole = seeds.join(frames.where("n > 1").select("gram", "frame"), ["gram", "frame"]).select(
        "_id",
        "_row",
        (F.col("at") - F.shiftright("room", 32)).alias("start"),
        (F.col("at") + F.col("room").bitwiseAND(0xFFFFFFFF)).alias("end"),
    )

    several = frames.groupBy("gram").agg(F.count("*").alias("frames")).where("frames > 1")
    # Landed, so that the frames of a crowded anchor are split over tasks.
    ones = frames.join(landed(several, "suffix-several"), "gram").select(
        "_id", "_row", "at", "gram", "room", F.ceil(F.col("frames") / crowd).alias("parts")
    )
    spots = ones.groupBy("_id", "_row").agg(F.collect_list(F.struct("at", "gram", "room", "parts")).alias("_at"))
    found = rows.alias("d").join(spots.alias("p"), same_row("d", "p")).select("d.*", "p._at")
    schema = f"{ROW}, gram long, parts long, start long, bytes binary"
    cut = landed(map_batches(found, _cut_out(), schema), "suffix-frames")

    # By stretches of a document, which may hold an anchor very often.
    part = F.pmod(F.xxhash64("_id", "_row", F.shiftright("start", 14)), F.col("parts"))
    dealt = cut.withColumn("part", part).repartition("gram", "part").sortWithinPartitions("gram", "part")
    schema = f"{ROW}, start long, end long, h1 long, h2 long"
    scanned = landed(map_batches(dealt, _suffix_sorted(winnowing.least), schema), "suffix-repeats")
    repeats = scanned.where("h1 IS NULL").select("_id", "_row", "start", "end")

    # Parts of several anchors may report one place.
    runs = scanned.where("h1 IS NOT NULL").groupBy("_id", "_row", "start", "h1", "h2")
    runs = runs.agg(F.max("end").alias("end"))
    twice = runs.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    across = runs.where("end IS NULL").join(twice, ["h1", "h2"]).select(
        "_id", "_row", "start", (F.col("start") + winnowing.least).alias("end")
    )
    return whole.union(repeats).union(across)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
            ("n_spans", pa.int64()), ("kept_bytes", pa.binary()),
        ]
    )
    for batch in batches:
        out = []
        texts, lists = batch.column("_text").to_pylist(), batch.column("_spans").to_pylist()
        for text, spans in zip(texts, lists):
            data = text.encode()
            if not spans:
                out.append((len(data), 0, 0, data))
                continue
            gone = covered(spans, len(data))
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            out.append((len(data), int(gone.sum()), runs, kept))
        if out:
            yield record_batch(schema, batch.column("_id"), *zip(*out))


def without_repeats(docs: DataFrame, winnowing: Winnowing = WINNOWING, crowd: int = CROWD) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, and kept_bytes."""
    rows = keyed(docs)
    cut = with_spans(rows, repeated_spans(rows, winnowing, crowd))
    return map_batches(
        cut, _kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_bytes binary"
    )


@query()
def op7_suffix_dedup(spark, sf_dir):
    """What every document keeps."""
    kept = without_repeats(read_table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256")
    )
