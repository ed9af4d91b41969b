"""Exact deduplication by a tree of merged digest runs.

Documents shrink to (digest, identifier) rows. Each row belongs to one of RUNS runs; in every round
FAN_IN neighbouring runs are merged into one, and a merge keeps one row per text: the identifier that
stays, and how many rows it stands for. Spark sorts the runs by digest and merges them (a sort
aggregate) before and after each exchange, and an exchange deals rows by digest and run, so a text
that makes up a third of all rows is spread over all runs first and is one row per run from then on.

A merge is verified: rows meet only if SHA-256, a second independent hash and the length all agree.

Defined cases: a null text counts as empty. A null identifier is smaller than every other. Rows that
repeat both identifier and text are one document: all are reported, one is kept. Other columns, whatever
their names, pass through ``drop_copies``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.common import landed, read_table, set_aside
from tillwork.llm.registry import query

RUNS = 64
FAN_IN = 8

KEY = ("_sha", "_check", "_bytes")


def _digests(text: str = "text") -> dict[str, Column]:
    body = F.coalesce(F.col(text), F.lit(""))
    return {
        "_sha": F.unhex(F.sha2(body, 256)),
        "_check": F.xxhash64(body),
        "_bytes": F.octet_length(body),
    }


def _members(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per identifier and text, with the number of rows that repeat both."""
    rows = docs.select(F.col(doc_id).alias("_id"), *(c.alias(k) for k, c in _digests(text).items()))
    return rows.groupBy("_id", *KEY).agg(F.count("*").alias("_rows"))


def merge_runs(members: DataFrame, keep: str = "max") -> DataFrame:
    """One row per text: the identifier that stays and the number of rows, by rounds of merges."""
    choose = {"max": F.max, "min": F.min}[keep]
    run = F.pmod(F.xxhash64("_id"), F.lit(RUNS))
    merged = members.select(*KEY, F.struct("_id").alias("_stays"), "_rows", run.alias("_run"))
    runs = RUNS
    while runs > 1:
        runs = -(-runs // FAN_IN)
        merged = (
            merged.withColumn("_run", F.floor(F.col("_run") / FAN_IN) if runs > 1 else F.lit(0))
            .groupBy(*KEY, "_run")
            .agg(choose("_stays").alias("_stays"), F.sum("_rows").alias("_rows"))
        )
    return merged.select(*KEY, F.col("_stays._id").alias("_keep_id"), F.col("_rows").alias("_size"))


def copy_groups(
    docs: DataFrame, keep: str = "max", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every document, dropped ones too, with the identifier that stays and its group's size."""
    members = _members(docs, doc_id, text)
    # Landed, so that a hot text is split over tasks on the members' side of the join.
    together = members.join(landed(merge_runs(members, keep), "merged-runs"), list(KEY))
    copy = F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int")))
    return together.withColumn("_copy", copy).select(
        F.col("_id").alias(doc_id),
        F.col("_keep_id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_id").eqNullSafe(F.col("_keep_id")) & (F.col("_copy") == 1)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame, keep: str = "max", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents that stay, in their columns."""
    docs, columns = set_aside(docs, *KEY, "_keep_id")
    members = _members(docs, doc_id, text)
    stay = merge_runs(members, keep).select(*KEY, F.col("_keep_id"))
    keys = [*KEY, "_keep_id"]
    return (
        docs.withColumns(_digests(text) | {"_keep_id": F.col(doc_id)})
        .alias("d")
        .join(
            stay.alias("s"),
            [F.col(f"d.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys],
            "left_semi",
        )
        .dropDuplicates(keys)
        .select(*columns)
    )


SQL = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER same
    AND row_number() OVER (PARTITION BY t, doc_id) = 1 AS kept,
  sha256(t) AS text_sha256
FROM texts
WINDOW same AS (PARTITION BY t)
"""


@query(SQL)
def op4_exact_dedup(spark, sf_dir):
    """The group of every document; of equal texts the row with the largest identifier stays."""
    return copy_groups(read_table(spark, sf_dir, "documents"))
