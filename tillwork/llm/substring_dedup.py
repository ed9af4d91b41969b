"""Substring deduplication by seed and extend, over words.

Documents are joined on winnowed anchors (seeds). An anchor that occurs in several documents is
extended both ways: where the whole frame around it equals that of a document with a smaller
identifier, every run through it is repeated; the first documents of the different frames are extended
word by word, as the runs of LEAST words through the anchor. Overlapping runs add up to the maximal
repeats, whose words are removed.

A group of equal seeds is never gathered: it is only counted and reduced to the smallest identifier,
per frame and per run. Equal hashes stand for equal words (an anchor's and its frame's, or two of a
run: 128 bits together).

Defined cases: a null text has no words. Rows without identifier keep all words and take none from
others. Rows of equal identifier take nothing from each other. Texts shorter than LEAST words keep
everything; an empty table gives an empty result. Columns besides doc_id and text play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.anchors import ROW, Winnowing, anchor_rows, covered, keyed, same_row, with_spans
from tillwork.llm.common import WORD, landed, map_batches, read_table, record_batch
from tillwork.llm.hashing import word_hashes, words_in
from tillwork.llm.registry import query

LEAST = 50
WINNOWING = Winnowing(least=LEAST, gram=10)


def _units(text: str) -> np.ndarray:
    return word_hashes(words_in(text))


def repeated_spans(rows: DataFrame, winnowing: Winnowing = WINNOWING) -> DataFrame:
    """Spans of words (_id, _row, start, end) that also start in a document with a smaller _id."""
    owned = rows.where("_id IS NOT NULL")
    anchors = anchor_rows(owned, winnowing, _units)
    shared = anchors.groupBy("gram").agg(F.min("_id").alias("lo"), F.max("_id").alias("hi"))
    shared = landed(shared.where("lo < hi").select("gram"), "shared-seeds")
    seeds = landed(anchors.join(shared, "gram"), "seeds")

    frames = landed(seeds.groupBy("gram", "frame").agg(F.min("_id").alias("first")), "frames")
    several = frames.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    known = seeds.join(frames, ["gram", "frame"])
    whole = known.where("_id > first").select(
        "_id", "_row", (F.col("at") - winnowing.reach).alias("start"), (F.col("at") + winnowing.least).alias("end")
    )

    places = (
        known.where("_id = first")
        .join(several, "gram")
        .groupBy("_id", "_row")
        .agg(F.collect_set("at").alias("_at"))
    )
    found = owned.alias("d").join(places.alias("p"), same_row("d", "p")).select("d.*", "p._at")
    runs = landed(map_batches(found, _extended(winnowing), f"{ROW}, start long, h1 long, h2 long"), "runs")
    first = landed(runs.groupBy("h1", "h2").agg(F.min("_id").alias("first")), "first-runs")
    extended = runs.join(first, ["h1", "h2"]).where("_id > first").select(
        "_id", "_row", "start", (F.col("start") + winnowing.least).alias("end")
    )
    return whole.union(extended)


def _extended(winnowing: Winnowing):
    schema = pa.schema([(name, pa.int64()) for name in ("_id", "_row", "start", "h1", "h2")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                starts, h1, h2 = winnowing.runs_through(_units(row["_text"]), np.array(row["_at"]))
                n = len(starts)
                yield record_batch(
                    schema, np.full(n, row["_id"]), np.full(n, row["_row"]), starts, h1, h2
                )

    return work


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())]
    )
    for batch in batches:
        out = []
        texts, lists = batch.column("_text").to_pylist(), batch.column("_spans").to_pylist()
        for text, spans in zip(texts, lists):
            words = words_in(text)
            gone = covered(spans, len(words))
            kept = [w for w, g in zip(words, gone.tolist()) if not g] if spans else words
            out.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
        if out:
            yield record_batch(schema, batch.column("_id"), *zip(*out))


def without_repeats(docs: DataFrame, winnowing: Winnowing = WINNOWING) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, and the words it keeps as kept_text."""
    rows = keyed(docs)
    cut = with_spans(rows, repeated_spans(rows, winnowing))
    return map_batches(cut, _cut, "doc_id long, n_words long, n_removed long, kept_text string")


SQL = rf"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
runs AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + {LEAST - 1}], ' ')) AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {LEAST - 2})) AS i FROM words WHERE len(w) >= {LEAST})
),
repeated AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY run) AS first FROM runs) WHERE doc_id > first
),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {LEAST})) AS place FROM repeated
),
marked AS (
  SELECT u.doc_id, u.place, u.word, g.place IS NOT NULL AS is_gone
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM words) u
  LEFT JOIN gone g ON u.doc_id = g.doc_id AND u.place = g.place
)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(m.n, 0)::BIGINT AS n_removed,
  sha256(coalesce(m.kept, '')) AS kept_sha256
FROM words w LEFT JOIN (
  SELECT doc_id, count(*) FILTER (is_gone) AS n, string_agg(word, ' ' ORDER BY place) FILTER (NOT is_gone) AS kept
  FROM marked GROUP BY doc_id) m ON w.doc_id = m.doc_id
"""


@query(SQL)
def op6_substring_dedup(spark, sf_dir):
    """What every document keeps."""
    kept = without_repeats(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
