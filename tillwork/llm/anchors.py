"""Winnowed anchors: where long equal runs in different places must show.

A text is a sequence of units (words or bytes). Of every ``least - gram + 1`` neighbouring grams the
one of the least hash is an anchor, so any two equal runs of ``least`` units have an anchor in common,
at the same place within the run. Around an anchor, its frame is all that a run of ``least`` units
through the anchor can touch; equal frames mean that all those runs are equal.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.common import map_batches, record_batch
from tillwork.llm.hashing import Runs, mix, run_hashes, winnowed

#: Units whose hashes are held at once; longer texts are gone through in overlapping parts.
PART = 1 << 20

ROW = "_id long, _row long"


@dataclass(frozen=True)
class Winnowing:
    """Runs of ``least`` units, found by grams of ``gram`` units."""

    least: int
    gram: int

    #: What ``anchors`` gives besides places.
    columns = ("gram", "frame")

    @property
    def reach(self) -> int:
        """How far a run through an anchor extends before it."""
        return self.least - self.gram

    def _frames(self, at: np.ndarray, grams: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the frames of anchors begin and end in ``n`` units."""
        return np.maximum(at - self.reach, 0), np.minimum(at + self.least, n)

    def _given(self, at, grams, frames, first, last) -> tuple[np.ndarray, ...]:
        return at, grams, frames

    def anchors(self, units: np.ndarray) -> tuple[np.ndarray, ...]:
        """Places of the anchors, hashes of their grams, hashes of their frames."""
        n, found = len(units), []
        if n < self.least:
            empty = np.empty(0, np.uint64)
            return self._given(np.empty(0, np.int64), empty, empty, *[np.empty(0, np.int64)] * 2)
        for begin in range(0, n, PART):
            low, high = max(0, begin - 2 * self.least), min(n, begin + PART + 2 * self.least)
            runs = Runs(units[low:high])
            starts = np.arange(high - low - self.gram + 1)
            grams = runs.hashes(starts, starts + self.gram)
            at = winnowed(grams, self.reach + 1)
            first, last = self._frames(at, grams[at], high - low)
            mine = (at + low >= begin) & (at + low < begin + PART) & (last - first >= self.least)
            at, first, last = at[mine], first[mine], last[mine]
            with np.errstate(over="ignore"):
                shape = mix(((at - first) << 32 | (last - at)).astype(np.uint64))
                frames = mix(runs.hashes(first, last) + shape)
            found.append(self._given(at + low, grams[at], frames, first + low, last + low))
        return tuple(np.concatenate(parts) for parts in zip(*found))

    def runs_through(self, units: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """Starts of all runs of ``least`` units through the anchors, and two hashes of each."""
        n = len(units)
        starts = np.unique((at[:, None] - np.arange(self.reach + 1)[None, :]).ravel())
        starts = starts[(starts >= 0) & (starts + self.least <= n)]
        return starts, *run_hashes(units, starts, self.least)


class OwnWinnowing(Winnowing):
    """Frames of only those runs whose least gram (of equal ones the first) the anchor is.

    Which gram of a run is the least depends on the run alone, so equal runs still meet at one anchor;
    but every run lies in one frame, frames are shorter, and more of them are equal. ``room`` tells how
    far a frame reaches before (high bits) and after its anchor.
    """

    columns = ("gram", "frame", "room")

    def _frames(self, at: np.ndarray, grams: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        # A lesser gram within reach of an anchor is an anchor too.
        first = np.maximum(at - self.reach, 0)
        last = np.minimum(at, n - self.least)
        for side in (-1, 1):
            left, step = np.arange(len(at)), 0
            while len(left):
                step += 1
                left = left[(left + side * step >= 0) & (left + side * step < len(at))]
                other = left + side * step
                left, other = (a[abs(at[other] - at[left]) <= self.reach] for a in (left, other))
                lesser = grams[other] <= grams[left] if side < 0 else grams[other] < grams[left]
                ends, by = left[lesser], at[other[lesser]]
                if side < 0:
                    first[ends] = np.maximum(first[ends], by + 1)
                else:
                    last[ends] = np.minimum(last[ends], by - self.reach - 1)
                left = left[~lesser]
        return first, last + self.least

    def _given(self, at, grams, frames, first, last) -> tuple[np.ndarray, ...]:
        return at, grams, frames, ((at - first) << 32 | (last - at)).astype(np.int64)


def keyed(docs: DataFrame) -> DataFrame:
    """Identifier, a hash that tells rows of the same identifier apart, and text (null: empty)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("_id"),
        F.xxhash64("doc_id", text).alias("_row"),
        text.alias("_text"),
    )


def same_row(a: str, b: str):
    return (F.col(f"{a}._row") == F.col(f"{b}._row")) & F.col(f"{a}._id").eqNullSafe(F.col(f"{b}._id"))


def anchor_rows(rows: DataFrame, winnowing: Winnowing, units_of: Callable) -> DataFrame:
    """_id, _row, at, gram and frame of every anchor, and what else the winnowing gives."""
    names = ("_id", "_row", "at", *winnowing.columns)
    schema = pa.schema([(name, pa.int64()) for name in names])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, found = [], []
            for i, text in enumerate(batch.column("_text").to_pylist()):
                anchors = winnowing.anchors(units_of(text))
                owners.append(np.full(len(anchors[0]), i))
                found.append(anchors)
            if owners:
                owner = pa.array(np.concatenate(owners))
                yield record_batch(
                    schema,
                    batch.column("_id").take(owner),
                    batch.column("_row").take(owner),
                    *(np.concatenate(parts).view(np.int64) for parts in zip(*found)),
                )

    return map_batches(rows, work, ", ".join(f"{name} long" for name in names))


def covered(spans: list[dict] | None, n: int) -> np.ndarray:
    """Which of ``n`` units lie in a span; spans may overlap and reach over the ends."""
    depth = np.zeros(n + 1, np.int64)
    if spans:
        starts = np.clip(np.array([s["start"] for s in spans]), 0, n)
        ends = np.clip(np.array([s["end"] for s in spans]), 0, n)
        np.add.at(depth, starts, 1)
        np.add.at(depth, ends, -1)
    return np.cumsum(depth)[:n] > 0


def with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``rows`` with the list of their spans (_id, _row, start, end); null where there are none."""
    lists = spans.groupBy("_id", "_row").agg(F.collect_list(F.struct("start", "end")).alias("_spans"))
    return (
        rows.alias("d")
        .join(lists.alias("s"), same_row("d", "s"), "left")
        .select("d._id", "d._text", "s._spans")
    )
