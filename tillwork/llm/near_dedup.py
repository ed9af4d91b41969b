"""Near-duplicates by ProbMinHash over weighted word shingles, banding and verification.

Five consecutive words are a shingle, its weight grows with the logarithm of how often the text has
it. Each shingle sends arrivals of a Poisson process whose rate is its weight; an arrival falls on one
of COMPONENTS places, and the earliest arrival at a place wins it. A shingle stops as soon as its next
arrival is later than the latest winner, so only some n + m log m arrivals are made for n shingles and
m places. Two texts agree on a place with the probability Jaccard similarity of their weights. Places
form BANDS bands of ROWS; texts that agree on a whole band are compared exactly.

Equal texts are one node. In a bucket all nodes are compared with one centre, the node with the most
company in all its buckets, so a large group of copies of one text costs comparisons in proportion to
its size. Only buckets that then still hold several classes are looked at again, in two steps. First
sketches, a byte for each place, are dealt to pairs of blocks of some BLOCK nodes and compared as arrays:
nodes outside a bucket's largest class against all, those inside it only against those outside. Nodes
that agree with none of another class end there. Then the texts of the others, and no more, go to the
pairs of blocks in which they agree with some, in parts of some BLOCK_BYTES of text; a pair is compared
exactly in the first bucket that it shares, while its classes are still apart. What comes out is links,
not pairs.

Sketches must agree on ``agreeing`` of the COMPONENTS places, by default five standard deviations below
what texts of the least similarity agree on, so 6e-7 of such pairs are lost. With ``agreeing=0`` every
pair of a bucket is compared exactly.

Defined cases: a text of fewer than five words has one shingle, all its words; one without words has
none and is like equal texts only. A null text counts as empty. Rows of equal text share a class;
null identifiers come after all others in the choice of the one that stays. Other columns, whatever their names, pass through
``keep_one_of_each``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.common import landed, map_batches, read_table, record_batch, set_aside
from tillwork.llm.components import components
from tillwork.llm.hashing import mix, word_hashes, words_in
from tillwork.llm.registry import query

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 5
COMPONENTS = BANDS * ROWS
#: Shingles whose arrivals are made together; bounds memory, not what is compared.
TOGETHER = 1 << 19

#: Nodes of one bucket whose sketches are compared with each other in one place, and the bytes of text
#: in one place; what is more is dealt in pairs of blocks. Both change how work is dealt, not its result.
BLOCK = 2048
BLOCK_BYTES = 16 << 20


def expected_agreement(least: float) -> int:
    """Five standard deviations below the places that texts of the least similarity agree on."""
    return int(COMPONENTS * least - 5 * (COMPONENTS * least * (1 - least)) ** 0.5)


_STEP = 0x9E3779B97F4A7C15


def weighted_shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of a text, ascending, and their weights."""
    words = word_hashes(words_in(text))
    if not len(words):
        return np.empty(0, np.uint64), np.empty(0)
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    with np.errstate(over="ignore"):
        runs = np.full(n, width, np.uint64)
        for k in range(width):
            runs = mix(runs + words[k : k + n])
    shingles, counts = np.unique(runs, return_counts=True)
    return shingles, 1 + np.log(counts)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The sum over shared i of 1 / sum over j of max(a_j / a_i, b_j / b_i).

    In order of the ratio a_j / b_j the inner sum is a prefix sum of b and a suffix sum of a.
    """
    if not len(a[0]) or not len(b[0]):
        return 0.0
    union = np.union1d(a[0], b[0])
    x, y = np.zeros(len(union)), np.zeros(len(union))
    x[np.searchsorted(union, a[0])] = a[1]
    y[np.searchsorted(union, b[0])] = b[1]
    ratio = np.divide(x, y, out=np.full(len(union), np.inf), where=y > 0)
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    sum_x = np.concatenate([[0.0], np.cumsum(x)])
    sum_y = np.concatenate([[0.0], np.cumsum(y)])
    shared = (x > 0) & (y > 0)
    below = np.searchsorted(ratio, ratio[shared], side="left")
    inner = (sum_x[-1] - sum_x[below]) / x[shared] + sum_y[below] / y[shared]
    return float((1 / inner).sum())


def signatures(
    shingles: np.ndarray, weights: np.ndarray, owner: np.ndarray, owners: int, m: int = COMPONENTS
) -> np.ndarray:
    """The winning shingle at each of ``m`` places of each of ``owners`` texts, one row a text."""
    earliest = np.full(owners * m, np.inf)
    winner = np.zeros(owners * m, np.uint64)
    latest = np.full(owners, np.inf)
    time = np.zeros(len(shingles))
    turn = 0
    while len(shingles):
        turn += 1
        with np.errstate(over="ignore"):
            draw = mix(shingles + np.uint64(turn * _STEP % (1 << 64)))
            place = (mix(draw ^ np.uint64(_STEP)) % np.uint64(m)).astype(np.int64)
        time = time - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / weights
        slot = owner * m + place
        np.minimum.at(earliest, slot, time)
        won = earliest[slot] == time
        winner[slot[won]] = shingles[won]
        alive = np.unique(owner)
        latest[alive] = earliest.reshape(owners, m)[alive].max(axis=1)
        on = time < latest[owner]
        shingles, weights, owner, time = shingles[on], weights[on], owner[on], time[on]
    return winner.reshape(owners, m)


def band_keys(texts: list[str | None]) -> tuple[list[list[int]], list[bytes]]:
    """The keys of each text's bands, none for a text without words, and a byte for each place."""
    keys: list[list[int]] = [[] for _ in texts]
    sketches = [b"" for _ in texts]
    batch: list[tuple[int, np.ndarray, np.ndarray]] = []

    def flush() -> None:
        if not batch:
            return
        sizes = [len(s) for _, s, _ in batch]
        owner = np.repeat(np.arange(len(batch)), sizes)
        winners = signatures(
            np.concatenate([s for _, s, _ in batch]),
            np.concatenate([w for _, _, w in batch]),
            owner,
            len(batch),
        ).reshape(len(batch), BANDS, ROWS)
        with np.errstate(over="ignore"):
            key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(batch), BANDS)).copy()
            for row in range(ROWS):
                key = mix(key * np.uint64(_STEP) + winners[:, :, row])
        sketch = winners.reshape(len(batch), COMPONENTS).astype(np.uint8)
        for row, (i, _, _) in enumerate(batch):
            keys[i], sketches[i] = key[row].view(np.int64).tolist(), sketch[row].tobytes()
        batch.clear()

    together = 0
    for i, text in enumerate(texts):
        shingles, weights = weighted_shingles(text)
        if len(shingles):
            batch.append((i, shingles, weights))
            together += len(shingles)
        if together >= TOGETHER:
            flush()
            together = 0
    flush()
    return keys, sketches


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("_id", pa.int64()), ("_node", pa.binary()), ("_bands", pa.list_(pa.int64())),
            ("_sketch", pa.binary()),
        ]
    )
    for batch in batches:
        found = band_keys(batch.column("_text").to_pylist())
        yield record_batch(schema, batch.column("_id"), batch.column("_node"), *found)


@lru_cache(maxsize=64)
def _remembered(text: str) -> tuple[np.ndarray, np.ndarray]:
    return weighted_shingles(text)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("similarity", pa.float64())])
    for batch in batches:
        similar = [
            probability_jaccard(_remembered(x), _remembered(y))
            for x, y in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist())
        ]
        yield record_batch(schema, batch.column("a"), batch.column("b"), similar)


def _keyed(docs: DataFrame) -> DataFrame:
    """Identifier, text and node: 128 bits of the text's SHA-256 stand for equal texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    node = F.unhex(F.substring(F.sha2(text, 256), 1, 32))
    return docs.select(F.col("doc_id").cast("long").alias("_id"), node.alias("_node"), text.alias("_text"))


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""
    a = texts.select(F.col("_node").alias("a"), F.col("_text").alias("ta"))
    b = texts.select(F.col("_node").alias("b"), F.col("_text").alias("tb"))
    rows = pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb")
    schema = "a binary, b binary, similarity double"
    return map_batches(rows, _verify, schema).where(F.col("similarity") >= least - 1e-9)


def _candidates(key: int, apart: list[np.ndarray], classes, bands, sketches, agreeing: int):
    """Rows of a group, and for each the rows of other classes it may be similar to, likeliest first.

    One of the two is always outside the group's largest class. ``apart`` holds block numbers that must
    differ. A pair belongs to the first bucket that it shares.
    """
    band = np.array(bands)
    sketch = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(bands), COMPONENTS)
    here = int(np.flatnonzero(band[0] == key)[0])
    number = {c: i for i, c in enumerate(dict.fromkeys(classes))}
    code = np.array([number[c] for c in classes])
    outside = code != np.bincount(code).argmax()
    for x in np.flatnonzero(outside):
        other = (code != code[x]) & ~outside
        other[x + 1 :] |= code[x + 1 :] != code[x]
        for block in apart:
            other &= block != block[x]
        ys = np.flatnonzero(other)
        agree = (sketch[ys] == sketch[x]).sum(axis=1)
        ys, agree = ys[agree >= agreeing], agree[agree >= agreeing]
        first = (band[ys] == band[x]).argmax(axis=1) == here
        ys, agree = ys[first], agree[first]
        if len(ys):
            yield int(x), ys[np.argsort(-agree, kind="stable")]


def _grouped(
    batches: Iterator[pa.RecordBatch], by: list[str], others: list[str]
) -> Iterator[tuple[tuple, list[tuple]] | None]:
    """Groups of two rows or more that lie together, as key and columns; None at the end of a batch."""
    key, rows = None, []
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in by))
        for at, row in zip(keys, zip(*(batch.column(c).to_pylist() for c in others))):
            if at != key:
                if len(rows) > 1:
                    yield key, list(zip(*rows))
                key, rows = at, []
            rows.append(row)
        yield None
    if len(rows) > 1:
        yield key, list(zip(*rows))


_PAIRED = "_key long, _i long, _j long, _node binary, _class binary, _block long, _bytes long"


def _may_link(agreeing: int):
    """The rows of a pair of blocks whose sketches agree with one of another class."""
    schema = pa.schema(
        [
            ("_key", pa.int64()), ("_i", pa.int64()), ("_j", pa.int64()), ("_node", pa.binary()),
            ("_class", pa.binary()), ("_block", pa.int64()), ("_bytes", pa.int64()),
        ]
    )
    others = ["_node", "_class", "_block", "_bytes", "_bands", "_sketch"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, ["_key", "_i", "_j"], others):
            if group is None:
                continue
            (key, i, j), (nodes, classes, blocks, sizes, bands, sketches) = group
            met = np.zeros(len(nodes), bool)
            apart = [np.array(blocks)] if i != j else []
            for x, ys in _candidates(key, apart, classes, bands, sketches, agreeing):
                met[x] = True
                met[ys] = True
            found = [(key, i, j, nodes[x], classes[x], blocks[x], sizes[x]) for x in np.flatnonzero(met)]
            if found:
                yield record_batch(schema, *zip(*found))

    return work


def _apart(least: float, agreeing: int):
    """Links between the classes of a pair of blocks."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("similarity", pa.float64())])
    others = ["_node", "_class", "_block", "_part", "_bands", "_sketch", "_text"]

    def links(key: int, i: int, j: int, p: int, q: int, columns: list[tuple]) -> list[tuple]:
        nodes, classes, blocks, parts, bands, sketches, texts = columns
        parent = {c: c for c in classes}

        def root(c: bytes) -> bytes:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        apart = ([np.array(blocks)] if i != j else []) + ([np.array(parts)] if p != q else [])
        found = []
        for x, ys in _candidates(key, apart, classes, bands, sketches, agreeing):
            for y in ys.tolist():
                one, two = root(classes[x]), root(classes[y])
                if one != two:
                    similarity = probability_jaccard(_remembered(texts[x]), _remembered(texts[y]))
                    if similarity >= least - 1e-9:
                        parent[one] = two
                        found.append((min(nodes[x], nodes[y]), max(nodes[x], nodes[y]), similarity))
        return found

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, ["_key", "_i", "_j", "_p", "_q"], others):
            if group is not None and (out := links(*group[0], group[1])):
                yield record_batch(schema, *zip(*out))

    return work


def _met_in_pairs(classed: DataFrame, centres: DataFrame) -> DataFrame:
    """Rows (_key, _node, _class) of buckets with several classes, dealt to pairs of blocks (_i, _j).

    Blocks of nodes outside the bucket's largest class come first. Those nodes go to every block, the
    others to the blocks outside: a bucket with few nodes outside costs in proportion to its size. A bucket
    of at most BLOCK nodes is one block.
    """
    counts = classed.groupBy("_key", "_class").agg(F.count("*").alias("n"))
    several = counts.groupBy("_key").agg(
        F.max(F.struct("n", "_class")).alias("most"), F.sum("n").alias("all")
    )
    several = several.where("all > most.n").select(
        "_key",
        F.col("most._class").alias("_largest"),
        F.ceil((F.col("all") - F.col("most.n")) / BLOCK).alias("_outer"),
        F.when(F.col("all") <= BLOCK, 0).otherwise(F.ceil(F.col("most.n") / BLOCK)).alias("_inner"),
    )
    within = (F.col("_class") == F.col("_largest")) & (F.col("_inner") > 0)
    inner = F.pmod(F.xxhash64("_node"), F.greatest("_inner", F.lit(1)))
    block = F.when(within, F.col("_outer") + inner).otherwise(F.pmod(F.xxhash64("_node"), F.col("_outer")))
    last = F.when(within, F.col("_outer")).otherwise(F.col("_outer") + F.col("_inner")) - 1
    return (
        classed.join(landed(several.join(centres, "_key"), "several"), "_key")
        .where("_node != _centre")  # compared with all of them already
        .withColumn("_block", block)
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .select(
            "_key", "_node", "_class", "_block",
            F.least("_block", "_other").alias("_i"), F.greatest("_block", "_other").alias("_j"),
        )
    )


def _in_parts(rows: DataFrame) -> DataFrame:
    """Rows of pairs of blocks, dealt to pairs of parts (_p, _q) of some BLOCK_BYTES of text."""
    by = ["_key", "_i", "_j"]
    sizes = rows.groupBy(*by).agg(F.ceil(F.sum("_bytes") / BLOCK_BYTES).alias("_parts"))
    return (
        rows.join(landed(sizes, "parts"), by)
        .withColumn("_part", F.pmod(F.xxhash64("_node", F.lit(1)), F.col("_parts")))
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
        .withColumn("_p", F.least("_part", "_other"))
        .withColumn("_q", F.greatest("_part", "_other"))
        .select(*by, "_p", "_q", "_node", "_class", "_block", "_part")
    )


def similar_links(
    docs: DataFrame, least: float = SIMILARITY, agreeing: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Every (_id, _node), and verified links (a, b) that connect all nodes found similar."""
    agreeing = expected_agreement(least) if agreeing is None else agreeing
    schema = "_id long, _node binary, _bands array<long>, _sketch binary"
    signed = landed(map_batches(_keyed(docs), _sign, schema), "signatures")
    nodes = signed.groupBy("_node").agg(
        F.min(F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("id")))["id"].alias("_id"),
        F.first("_bands").alias("_bands"),
        F.first("_sketch").alias("_sketch"),
    )
    banded = nodes.select("_node", F.explode("_bands").alias("_key"))
    shared = banded.groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1")
    buckets = landed(banded.join(landed(shared, "shared-keys"), "_key"), "buckets")
    company = buckets.groupBy("_node").agg(F.sum("_n").alias("_company"))
    wanted = company.join(nodes, "_node").select("_node", "_id", "_bands", "_sketch", "_company")
    found = _keyed(docs).alias("d").join(
        wanted.alias("w"),
        (F.col("d._node") == F.col("w._node")) & F.col("d._id").eqNullSafe(F.col("w._id")),
    )
    found = found.select("d._node", "d._text", "w._bands", "w._sketch", "w._company")
    texts = landed(found.dropDuplicates(["_node"]), "texts")

    rows = buckets.join(texts.select("_node", "_company"), "_node")
    centres = rows.groupBy("_key").agg(F.max(F.struct("_company", "_node"))["_node"].alias("_centre"))
    centres = landed(centres, "centres")
    pairs = (
        buckets.join(centres, "_key")
        .where("_node != _centre")
        .select(F.least("_node", "_centre").alias("a"), F.greatest("_node", "_centre").alias("b"))
        .distinct()
    )
    links = landed(_verified(pairs, texts, least), "links").select("a", "b")

    # What is still apart within a bucket of three or more.
    label = components(links).select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    classed = (
        buckets.where("_n > 2")
        .join(label, "_node", "left")
        .select("_key", "_node", F.coalesce("_label", "_node").alias("_class"))
    )
    sketches = texts.select("_node", "_bands", "_sketch", F.octet_length("_text").cast("long").alias("_bytes"))
    dealt = _met_in_pairs(classed, centres).join(sketches, "_node").repartition("_key", "_i", "_j")
    dealt = dealt.sortWithinPartitions("_key", "_i", "_j")
    met = landed(map_batches(dealt, _may_link(agreeing), _PAIRED), "met")
    by = ["_key", "_i", "_j", "_p", "_q"]
    rows = _in_parts(met).join(texts.select("_node", "_bands", "_sketch", "_text"), "_node")
    dealt = rows.repartition(*by).sortWithinPartitions(*by)
    schema = "a binary, b binary, similarity double"
    more = landed(map_batches(dealt, _apart(least, agreeing), schema), "links").select("a", "b")
    return signed.select("_id", "_node"), links.union(more)


def near_classes(
    docs: DataFrame, least: float = SIMILARITY, agreeing: int | None = None
) -> DataFrame:
    """One row per document: doc_id, its node, class_id (least identifier), class_size, kept."""
    members, links = similar_links(docs, least, agreeing)
    classes = components(links)
    label = classes.select(F.col("node").alias("_node"), "label")
    rows = members.join(label, "_node", "left").withColumn("label", F.coalesce("label", "_node"))
    first = F.min(F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("id"), F.col("_node").alias("node")))
    heads = rows.groupBy("label").agg(first.alias("head"), F.count("*").alias("class_size"))
    return rows.join(landed(heads, "heads"), "label").select(
        F.col("_id").alias("doc_id"),
        F.col("_node").alias("node"),
        F.col("head.id").alias("class_id"),
        "class_size",
        (F.col("_id").eqNullSafe(F.col("head.id")) & (F.col("_node") == F.col("head.node"))).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One document of each class, in the columns of ``docs``."""
    docs, columns = set_aside(docs, "_id", "_node")
    stay = near_classes(docs, least).where("kept").select(F.col("doc_id").alias("_id"), F.col("node").alias("_node"))
    text = F.coalesce(F.col("text"), F.lit(""))
    node = F.unhex(F.substring(F.sha2(text, 256), 1, 32))
    rows = docs.withColumns({"_id": F.col("doc_id"), "_node": node})
    return (
        rows.alias("d")
        .join(
            stay.alias("s"),
            F.col("d._id").eqNullSafe(F.col("s._id")) & (F.col("d._node") == F.col("s._node")),
            "left_semi",
        )
        .dropDuplicates(["_id", "_node"])
        .select(*columns)
    )


@query()
def op10_near_dedup(spark, sf_dir):
    """The class of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return near_classes(docs).select("doc_id", "class_id", "class_size", "kept")
