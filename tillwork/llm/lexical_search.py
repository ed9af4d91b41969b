"""Ranked lexical search by buckets of impact vectors in order of length.

A document's impact vector holds, for every term of some query, the saturated frequency of the term in
the document times the square root of the term's weight; a query's vector holds its counts times the
same root, so that a score is an inner product. Vectors are dealt by length into ranges; a task goes
through its buckets from the longest vector down. With what a query's tenth result has by then:

* Cauchy-Schwarz drops a bucket whose longest vector cannot reach it,
* inside, a few coordinates where the query is large, and Cauchy-Schwarz over the others, bound every
  vector of the bucket (coordinate bounds),
* survivors are scored exactly, in 64-bit integers.

Bounds are doubles with room for their rounding, so that none drops a result; only strictly lesser
vectors are dropped, so ties are decided by identifier. The longest vectors of all are searched first:
their tenth results are thresholds that every task begins with.

Queries are dealt into blocks of some BLOCK vector entries, sent to all tasks; each block is one pass
over the vectors. Terms meet the queries' vocabulary by a join whose kind the planner chooses by size.

Defined cases: a null text has no terms. Every row is a document, and every row of the queries a query
of its own: repeated rows rank one by one, with their identifiers. A null identifier comes after all
others among equal scores. Queries without a term that weighs something have no results, and an empty
table gives an empty one. Other columns are not read.
"""

from __future__ import annotations

import collections
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork.llm.common import landed, map_batches, read_table, record_batch
from tillwork.llm.registry import query

#: Entries of the query vectors sent to the tasks at once.
BLOCK = 1 << 20
#: Vectors searched first, for thresholds.
HEAD = 4096
#: Coordinates of a query that bound the vectors of a bucket.
FOCUS = 8
#: Room for rounding: far above what sums of doubles lose, far below any pruning.
ROOM = 1 + 1e-9

# Letters, digits and all beyond ASCII make terms; only A-Z are lower-cased.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)

_LISTS = pa.schema(
    [("_row", pa.int64()), ("_id", pa.int64()), ("_n", pa.int64())]
    + [("term", pa.list_(pa.string())), ("tf", pa.list_(pa.int64()))]
)
_FOUND = pa.schema([("_item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def term_rows(rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """_row, _id, _n, term, tf: every term of every text, and under the empty term its number of
    terms. A text without terms has no rows."""
    numbered = rows.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(key).cast("long").alias("_id"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, terms, counts, ends = [], [], [], [0]
            for body in batch["_text"].to_pylist():
                found = collections.Counter(body.translate(_TABLE).split())
                sizes.append(found.total())
                if found:
                    terms.append(b"")
                    counts.append(sizes[-1])
                terms.extend(found.keys())
                counts.extend(found.values())
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            lists = (pa.array(terms, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch["_row"], batch["_id"], pa.array(sizes, pa.int64())]
                + [pa.ListArray.from_arrays(ends, values) for values in lists],
                schema=_LISTS,
            )

    lists = map_batches(numbered, work, "_row long, _id long, _n long, term array<string>, tf array<long>")
    return lists.select("_row", "_id", "_n", F.inline(F.arrays_zip("term", "tf")))


def impact_vectors(docs: DataFrame, vocabulary: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The vectors of all documents over the vocabulary (term, term_id), and the terms' weights:
    (_row, _id, length, terms, impacts), (term_id, w)."""
    spark = docs.sparkSession
    size_row = spark.range(1).select(F.lit("").alias("term"), F.lit(-1).cast("long").alias("term_id"))
    known = landed(vocabulary.unionByName(size_row), "vocabulary")
    postings = landed(
        term_rows(docs, key).join(known, "term").select("_row", "_id", "_n", "term_id", "tf"), "postings"
    )
    sizes = postings.where("term_id = -1").agg(F.count("*"), F.coalesce(F.sum("tf"), F.lit(0))).first()
    n_docs, n_terms = sizes
    postings = postings.where("term_id >= 0")
    weight = F.floor(1000 * F.ln(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    weights = landed(
        postings.groupBy("term_id")
        .agg(F.count("*").alias("df"))
        .select("term_id", weight.cast("long").alias("w"))
        .where("w > 0"),
        "weights",
    )
    share = F.call_function("div", 75 * F.col("_n") * F.lit(n_docs), F.lit(max(n_terms, 1)))
    impact = F.call_function("div", 1_000_000_000 * F.col("tf"), 1000 * F.col("tf") + 8 * (25 + share))
    entries = postings.join(weights, "term_id").withColumn("impact", impact)
    vectors = entries.groupBy("_row", "_id").agg(
        F.sqrt(F.sum(F.col("w") * F.col("impact").cast("double") * F.col("impact"))).alias("length"),
        F.collect_list(F.struct("term_id", "impact")).alias("entries"),
    )
    vectors = vectors.select(
        "_row", "_id", "length", F.col("entries.term_id").alias("terms"), F.col("entries.impact").alias("impacts")
    )
    return landed(vectors, "impact-vectors"), weights


class QueryBlock:
    """Query vectors with the thresholds they begin with."""

    def __init__(self, items: pa.Table, thresholds: dict[int, int], top: int):
        self.items = items["_item"].to_numpy()
        self.top = top
        self.start = np.array([thresholds.get(i, 0) for i in self.items.tolist()], np.int64)
        self.terms, self.exact, self.value = [], [], []
        for entries in items["entries"].to_pylist():
            w = np.array([e["w"] for e in entries], np.int64)
            c = np.array([e["tf"] for e in entries], np.int64)
            order = np.argsort(-(c * np.sqrt(w)), kind="stable")
            self.terms.append(np.array([e["term_id"] for e in entries], np.int64)[order])
            self.exact.append((c * w)[order])
            self.value.append(np.stack([c * np.sqrt(w), np.sqrt(w)])[:, order])
        self.ends = np.cumsum([0, *(len(t) for t in self.terms)])
        self.flat = np.concatenate([np.empty(0, np.int64), *self.terms])
        self.length = np.array([np.sqrt((v[0] ** 2).sum()) for v in self.value])
        self.rest = [
            np.sqrt(max((v[0] ** 2).sum() - (v[0][:FOCUS] ** 2).sum(), 0)) for v in self.value
        ]


class _Search:
    """The best results of every query of a block among the buckets seen so far."""

    def __init__(self, block: QueryBlock):
        self.block = block
        self.least = block.start.copy()
        none = np.empty(0, np.int64)
        self.best = [(none, none.astype(bool), none) for _ in block.items]

    def bucket(self, batch: pa.RecordBatch) -> None:
        block = self.block
        length = batch["length"].to_numpy()
        live = np.flatnonzero(block.length * (length.max() * ROOM) >= np.maximum(self.least, 1))
        if not len(live):
            return
        owner = np.repeat(np.arange(len(length)), batch["terms"].value_lengths().to_numpy())
        terms = batch["terms"].flatten().to_numpy()
        order = np.argsort(terms, kind="stable")
        terms, owner = terms[order], owner[order]
        impact = batch["impacts"].flatten().to_numpy()[order]
        first = np.searchsorted(terms, block.flat)
        last = np.searchsorted(terms, block.flat, "right")
        ids = batch["_id"].fill_null(0).to_numpy()
        missing = batch["_id"].is_null().to_numpy(zero_copy_only=False)
        squared = length**2
        for q in live.tolist():
            begin, end = block.ends[q], block.ends[q + 1]
            places = list(zip(first[begin:end].tolist(), last[begin:end].tolist(), strict=True))
            near, used = np.zeros(len(length)), np.zeros(len(length))
            for (low, high), value, root in zip(places[:FOCUS], *block.value[q][:, :FOCUS]):
                if low < high:
                    coordinate = impact[low:high] * root
                    near[owner[low:high]] += coordinate * value
                    used[owner[low:high]] += coordinate**2
            least = max(self.least[q], 1)
            bound = near + block.rest[q] * np.sqrt(np.maximum(squared * ROOM - used, 0))
            able = (bound * ROOM >= least) & (length * block.length[q] * ROOM >= least)
            if not able.any():
                continue
            score = np.zeros(len(length), np.int64)
            for (low, high), weight in zip(places, block.exact[q].tolist(), strict=True):
                if low < high:
                    score[owner[low:high]] += impact[low:high] * weight
            good = np.flatnonzero(able & (score >= least))
            if len(good):
                self._keep(q, ids[good], missing[good], score[good])

    def _keep(self, q: int, ids: np.ndarray, missing: np.ndarray, score: np.ndarray) -> None:
        ids, missing, score = (
            np.concatenate(both) for both in zip(self.best[q], (ids, missing, score), strict=True)
        )
        order = np.lexsort((ids, missing, -score))[: self.block.top]
        self.best[q] = (ids[order], missing[order], score[order])
        if len(order) == self.block.top:
            self.least[q] = max(self.least[q], score[order[-1]])

    def results(self) -> pa.RecordBatch:
        sizes = [len(score) for _, _, score in self.best]
        ids, missing, score = (np.concatenate([np.empty(0, np.int64), *part]) for part in zip(*self.best))
        return record_batch(
            _FOUND,
            np.repeat(self.block.items, sizes),
            pa.array(ids, mask=missing.astype(bool)),
            score,
        )


def _searched(vectors: DataFrame, block: QueryBlock) -> DataFrame:
    """What the tasks find, each in its own part of the vectors, in their order."""
    sent = vectors.sparkSession.sparkContext.broadcast(block)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _Search(sent.value)
        for batch in batches:
            if batch.num_rows:
                search.bucket(batch)
        if len(sent.value.items):
            yield search.results()

    return map_batches(vectors, work, "_item long, doc_id long, score long")


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("_item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(items: DataFrame, docs: DataFrame, top: int = 10, item_key: str = "item_id") -> DataFrame:
    """item_id, rank, doc_id, score: each query's ``top`` documents with a score above zero."""
    spark = docs.sparkSession
    wanted = landed(term_rows(items, item_key), "query-terms").where("term != ''")
    vocabulary = landed(
        wanted.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id()), "query-words"
    )
    vectors, weights = impact_vectors(docs, vocabulary)
    queries = wanted.join(vocabulary, "term").join(weights, "term_id")
    queries = landed(
        queries.groupBy(F.col("_row").alias("_item"), F.col("_id").alias("_item_id")).agg(
            F.collect_list(F.struct("term_id", "w", "tf")).alias("entries")
        ),
        "queries",
    )
    entries = queries.agg(F.coalesce(F.sum(F.size("entries")), F.lit(0))).first()[0]
    blocks = -(-entries // BLOCK)
    in_order = vectors.repartitionByRange(F.desc("length"), "_row").sortWithinPartitions(F.desc("length"))
    if blocks > 1:
        in_order = landed(in_order, "vectors-by-length")
    head = vectors.orderBy(F.desc("length"), "_row").limit(HEAD)
    found = spark.createDataFrame([], "_item long, doc_id long, score long, rank int")
    for number in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == number).toArrow()
        first = _best(_searched(head, QueryBlock(part, {}, top)), top).where(F.col("rank") == top)
        thresholds = {row["_item"]: row["score"] for row in first.collect()}
        found = found.unionByName(_best(_searched(in_order, QueryBlock(part, thresholds, top)), top))
    return found.join(queries.select("_item", "_item_id"), "_item").select(
        F.col("_item_id").alias(item_key), "rank", "doc_id", "score"
    )


SQL = r"""
WITH doc_terms AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
item_terms AS (
  SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
sizes AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM doc_terms WHERE len(terms) > 0),
tfs AS (
  SELECT id, doc_id, n, term, count(*) AS tf
  FROM (SELECT id, doc_id, len(terms) AS n, unnest(terms) AS term FROM doc_terms) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM tfs, sizes GROUP BY term, n_docs),
impacts AS (
  SELECT id, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)) AS impact
  FROM tfs, sizes),
scores AS (
  SELECT item, item_id, id, doc_id, sum(w * impact)::BIGINT AS score
  FROM item_terms JOIN impacts USING (term) JOIN weights USING (term) GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""


@query(SQL)
def op11_lexical_search(spark, sf_dir):
    """The ten best documents for every benchmark item."""
    return search(read_table(spark, sf_dir, "benchmark"), read_table(spark, sf_dir, "documents"))
