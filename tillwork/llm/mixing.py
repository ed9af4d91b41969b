"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the budget by its weight; a source above its cap (so many epochs) is
clamped, and the excess goes to the others by weight until none is above. Clamping in rounds ends at
one water level, the same that one pass over the sources in order of cap / weight finds, so no loop
is needed. A target then means whole repetitions of every document and one further pass over part of
them: documents in a seeded order, as long as that brings the source nearer to its target.

The order is cut in BUCKETS per source. Sums by bucket come first, so a source with a third of all
rows is spread over its buckets, and only rows of one bucket are ever ordered together. The table of
sources is ranked in ranges: a row's sums are those of the ranges before its own, and of the rows before
it in there. So there may be as many sources as documents; what one task orders as a whole is one row
per range.

Defined cases: a null text has size 0, a null source is a source of its own (last in order), a null
identifier is ordered like an empty one. A document of size 0 is repeated as its place in the order
says. Sources without words have target 0; an empty table gives an empty result. Repeated rows are
drawn one by one. Other columns, whatever their names, pass through; the result adds one struct column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork.llm.common import landed, read_table, set_aside, word_count
from tillwork.llm.registry import query

#: Of the first, second and third source by code point, and so on in turn.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 17
BUCKETS = 16384


def in_ranges(df: DataFrame, name: str, *order) -> DataFrame:
    """``df`` landed in ranges of an order, with the range of each row as ``_part``."""
    return landed(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name)


def with_sums_before(df: DataFrame, name: str, order, **values) -> DataFrame:
    """``df`` with sums of values over all rows earlier in an order, which must have no ties."""
    parts = in_ranges(df, name, *order)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = parts.groupBy("_part").agg(*(F.sum(value).alias(k) for k, value in values.items()))
    whole = whole.select("_part", *(F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(f"{k}_") for k in values))
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = {
        k: F.col(f"{k}_") + F.coalesce(F.sum(value).over(within), F.lit(0)) for k, value in values.items()
    }
    return parts.join(whole, "_part").withColumns(sums).drop("_part", *(f"{k}_" for k in values))


def source_targets(sources: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs=MAX_EPOCHS):
    """``sources`` (_src, _source_size) with the target of each."""
    named = sources.withColumn("_unnamed", F.col("_src") == "")
    turn = F.col("_rank") % len(weights)
    ranked = with_sums_before(named, "mix-ranked", ("_unnamed", "_src"), _rank=F.lit(1))
    weighted = ranked.select(
        "*",
        F.get(F.array(*map(F.lit, weights)), turn).alias("_weight"),
        (F.col("_source_size") * max_epochs).alias("_cap"),
    ).withColumn("_level", F.col("_cap") / F.col("_weight"))
    # Sources in the order in which a rising level reaches their caps.
    order = ("_level", "_unnamed", "_src")
    levelled = with_sums_before(
        weighted, "mix-levelled", order, _spent=F.col("_cap"), _passed=F.col("_weight")
    )
    totals = levelled.agg(
        (F.sum("_source_size") * F.lit(float(share))).alias("_budget"), F.sum("_weight").alias("_all")
    )
    stepped = levelled.crossJoin(totals).withColumns(
        {"_rest": F.col("_budget") - F.col("_spent"), "_weights": F.col("_all") - F.col("_passed")}
    ).withColumn(
        "_clamped", F.col("_cap") * F.col("_weights") <= F.col("_rest") * F.col("_weight")
    )
    poured = stepped.agg(
        F.coalesce(F.sum(F.when(F.col("_clamped"), F.col("_cap"))), F.lit(0)).alias("_full"),
        F.sum(F.when(~F.col("_clamped"), F.col("_weight"))).alias("_open"),
    )
    target = F.when(F.col("_clamped"), F.col("_cap").cast("double")).otherwise(
        (F.col("_budget") - F.col("_full")) * F.col("_weight") / F.col("_open")
    )
    return stepped.crossJoin(poured).select("_src", "_source_size", target.alias("_target"))


#: Columns the mix works with.
WORKING = (
    "_src _size _draw _bucket _bucket_size _source_size _target _before _whole _part _copies _level _cap"
).split()


def mix_documents(
    docs: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs=MAX_EPOCHS, seed=SEED, into="mix"
) -> DataFrame:
    """``docs`` with one more column ``into``: size, source_size, target, copies, taken. A column of
    that name is replaced, all others pass through."""
    docs, columns = set_aside(docs.drop(into), *WORKING)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = (
        docs.withColumns(
            {
                "_src": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")),
                "_size": word_count(F.col("text")),
                "_draw": F.md5(name),
            }
        )
        .withColumn(
            "_bucket",
            F.floor(F.conv(F.substring("_draw", 1, 4), 16, 10).cast("int") * BUCKETS / 65536),
        )
    )
    buckets = rows.groupBy("_src", "_bucket").agg(F.sum("_size").alias("_bucket_size"))
    buckets = landed(buckets, "mix-buckets")
    sources = buckets.groupBy("_src").agg(F.sum("_bucket_size").alias("_source_size"))
    targets = source_targets(sources, weights, share, max_epochs)
    whole = F.when(
        F.col("_source_size") > 0, F.floor(F.col("_target") / F.col("_source_size"))
    ).otherwise(0)
    earlier = Window.partitionBy("_src").orderBy("_bucket")
    cuts = (
        buckets.withColumn("_before", F.sum("_bucket_size").over(earlier) - F.col("_bucket_size"))
        .drop("_bucket_size")
        .join(targets, "_src")
        .withColumn("_whole", whole)
        .withColumn("_part", F.col("_target") - F.col("_whole") * F.col("_source_size"))
    )
    drawn = Window.partitionBy("_src", "_bucket").orderBy("_draw", "doc_id", "_size")
    upto = F.sum("_size").over(drawn.rowsBetween(Window.unboundedPreceding, 0))
    # The further pass takes a document if its middle lies below the part to be taken.
    extra = (F.col("_before") + upto) * 2 - F.col("_size") <= F.col("_part") * 2
    copies = F.col("_whole") + extra.cast("long")
    mix = F.struct(
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        F.col("_copies").alias("copies"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )
    return (
        rows.join(cuts, ["_src", "_bucket"])
        .withColumn("_copies", F.least(copies, F.lit(max_epochs)))
        .select(*columns, mix.alias(into))
    )


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: documents as often as it takes them, in the columns of ``docs``."""
    docs, columns = set_aside(docs, "_mix", "_time")
    times = F.explode(F.array_repeat(F.lit(0), F.col("_mix.copies").cast("int")))
    return mix_documents(docs, **settings, into="_mix").withColumn("_time", times).select(*columns)


SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS draw
  FROM documents
),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [{", ".join(map(str, WEIGHTS))}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}] AS w
  FROM sized GROUP BY source
),
stepped AS (
  SELECT *, {MAX_EPOCHS} * source_size AS cap,
    sum(source_size) OVER () * {SHARE}::DOUBLE AS budget,
    coalesce(sum({MAX_EPOCHS} * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS spent,
    sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws
  FROM sources
  WINDOW o AS (ORDER BY {MAX_EPOCHS} * source_size / w, source NULLS LAST)
),
clamped AS (SELECT *, cap * ws <= (budget - spent) * w AS full_ FROM stepped),
targets AS (
  SELECT source, source_size, CASE WHEN full_ THEN cap::DOUBLE ELSE
    (budget - coalesce(sum(cap) FILTER (full_) OVER (), 0)) * w / sum(w) FILTER (NOT full_) OVER ()
    END AS target
  FROM clamped
),
drawn AS (
  SELECT s.*, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
    sum(size) OVER (PARTITION BY s.source ORDER BY draw, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (size * least({MAX_EPOCHS}, whole + CASE WHEN upto * 2 - size <= (target - whole * source_size) * 2
    THEN 1 ELSE 0 END))::BIGINT AS taken
FROM drawn
"""


@query(SQL)
def op8_mix_sources(spark, sf_dir):
    """What the mix takes of every document."""
    mixes = mix_documents(read_table(spark, sf_dir, "documents"))
    return mixes.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")
