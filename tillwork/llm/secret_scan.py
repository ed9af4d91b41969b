"""Secret scans over an incremental ledger of blobs.

Every historical version of a file is addressed by the SHA-256 of its text, so equal texts under any
paths are one blob. The ledger holds, per blob, which rules at which version have scanned it and what
they found. A run scans only the pairs of blob and rule version that the ledger lacks, appends them,
and joins the findings of the ledger back to all paths: a copy costs nothing, a new rule version
rescans with that rule alone, and a lost run is repeated from what earlier runs have committed.

Each run of the ledger is a folder of its own, written by one Spark job; readers use the runs that
ended (those with a success marker), so an interrupted run is as if it had not begun. Two runs at the
same time may scan the same pair; its findings are equal and count once.

Spans are places of code points, end exclusive. A rule's matches are leftmost and do not overlap;
their places come from the lengths of the text between them and of the matches.

Defined cases: a null text is an empty one. Rows that repeat path and text are each reported. A null
path is a path like others. Other columns pass through ``with_findings``. An empty table gives an
empty result, and an empty text no findings.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.common import landed, read_table
from tillwork.llm.registry import query
from tillwork.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``hints``: texts without any of them cannot match (none: look at all).
    ``group`` and ``least``: a match counts if that group has so many characters."""

    kind: str
    pattern: str
    hints: tuple[str, ...] = ()
    group: int = 0
    least: int = 0
    version: int = 1

    @property
    def pair(self) -> str:
        return f"{self.kind}@{self.version}"


# Public notations of credentials.
_ASSIGN = (
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
    r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
BASE_RULES = (
    Rule("assign", _ASSIGN, group=2, least=6),
    # The shortest length stands in the pattern: a run of such characters is matched whole or not.
    Rule("access", r"AKIA[A-Z0-9]{16,}", ("AKIA",)),
    Rule("hex", r"[0-9a-f]{24,}"),
)
RULES = (
    *BASE_RULES,
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", ("-----BEGIN ",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", ("eyJ",)),
    Rule("login", r"[a-z][a-z0-9+.-]{1,20}://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/:@]+@", ("://",)),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", ("xox",)),
)

SPAN = "struct<order:int,kind:string,start:long,end:long>"
LEDGER = f"_blob binary, scanned array<string>, findings array<{SPAN}>"


def spans_of(text: Column, rule: Rule, order: int = 0) -> Column:
    """The rule's matches in a text as an array of spans, by place."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, rule.pattern, -1)
    # Pairs of what lies before a match and the match; a running end place folds over them.
    steps = F.arrays_zip(
        F.slice(between, 1, F.size(found)).alias("before"), found.alias("match")
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(None).cast(f"array<{SPAN}>").alias("out"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.char_length(pair["before"])
        end = begin + F.char_length(pair["match"])
        span = F.struct(
            F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"), begin.alias("start"), end.alias("end")
        )
        counts = F.lit(True)
        if rule.least:
            counts = F.char_length(F.regexp_extract(pair["match"], rule.pattern, rule.group)) >= rule.least
        none = F.array().cast(f"array<{SPAN}>")
        kept = F.when(counts, F.array(span)).otherwise(none)
        return F.struct(end.alias("at"), F.concat(F.coalesce(state["out"], none), kept).alias("out"))

    folded = F.aggregate(steps, start, step, lambda state: state["out"])
    # Only texts with a match are split and folded.
    likely = text.rlike(rule.pattern)
    for i, hint in enumerate(rule.hints):
        there = text.contains(hint)
        hinted = there if i == 0 else hinted | there
    if rule.hints:
        likely = hinted & likely
    return F.coalesce(F.when(likely, folded), F.array().cast(f"array<{SPAN}>"))


def addressed(versions: DataFrame, text: str = "text", carry: str = "*") -> DataFrame:
    """Rows with the address of their text (``_blob``) beside the row, or one column of it (``_row``)."""
    body = F.coalesce(F.col(text), F.lit(""))
    return versions.select(
        F.struct(carry).alias("_row"), body.alias("_text"), F.unhex(F.sha2(body, 256)).alias("_blob")
    )


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    """All runs of the ledger that ended, or None before the first."""
    root = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    done = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, "run-*/_SUCCESS"))
    runs = [str(status.getPath().getParent()) for status in done or []]
    return spark.read.schema(LEDGER).parquet(*runs) if runs else None


def unseen(blobs: DataFrame, known: DataFrame | None, rules: Iterable[Rule]) -> DataFrame:
    """Rows of ``blobs`` with the rule versions that have not scanned them (``_todo``), if any."""
    pairs = F.array(*(F.lit(rule.pair) for rule in rules))
    if known is None:
        return blobs.withColumn("_todo", pairs)
    seen = (
        known.select("_blob", F.explode("scanned").alias("_pair"))
        .groupBy("_blob")
        .agg(F.collect_set("_pair").alias("_seen"))
    )
    todo = F.array_except(pairs, F.coalesce("_seen", F.array().cast("array<string>")))
    return (
        blobs.join(seen, "_blob", "left").withColumn("_todo", todo).drop("_seen").where(F.size("_todo") > 0)
    )


def scan(versions: DataFrame, ledger: str, rules: Iterable[Rule] = RULES, text: str = "text") -> DataFrame:
    """Scan what the ledger lacks of the texts of ``versions``, append it, and return the ledger.

    Copies meet on their address before any rule looks at them, first within a task, then across.
    """
    spark, rules = versions.sparkSession, tuple(rules)
    rows = addressed(versions, text).select("_blob", "_text")
    todo = unseen(rows, read_ledger(spark, ledger), rules)
    once = todo.groupBy("_blob").agg(F.first("_text").alias("_text"), F.first("_todo").alias("_todo"))
    found = F.concat(
        *(
            F.when(F.array_contains("_todo", rule.pair), spans_of(F.col("_text"), rule, order)).otherwise(
                F.array().cast(f"array<{SPAN}>")
            )
            for order, rule in enumerate(rules)
        )
    )
    run = scratch_path(spark, "run").rsplit("/", 1)[-1]
    once.select("_blob", F.col("_todo").alias("scanned"), found.alias("findings")).write.parquet(
        f"{ledger.rstrip('/')}/{run}"
    )
    return read_ledger(spark, ledger)


def findings_of(known: DataFrame, rules: Iterable[Rule] = RULES) -> DataFrame:
    """What the present versions of ``rules`` have found in each blob: by place, then rule."""
    kinds = F.array(*(F.lit(rule.pair) for rule in rules))
    return (
        known.where(F.arrays_overlap("scanned", kinds) & (F.size("findings") > 0))
        .select("_blob", "scanned", F.explode("findings").alias("_f"))
        # A run's findings of a kind are those of the version that run has scanned with.
        .where(
            F.exists(
                F.array_intersect("scanned", kinds), lambda p: F.split_part(p, F.lit("@"), F.lit(1)) == F.col("_f.kind")
            )
        )
        .groupBy("_blob")
        .agg(
            F.array_sort(
                F.collect_set(
                    F.struct(
                        F.col("_f.start").alias("start"),
                        F.col("_f.order").alias("order"),
                        F.col("_f.kind").alias("kind"),
                        F.col("_f.end").alias("end"),
                    )
                )
            ).alias("findings")
        )
    )


def with_findings(
    versions: DataFrame,
    known: DataFrame,
    rules: Iterable[Rule] = RULES,
    text: str = "text",
    carry: str = "*",
) -> DataFrame:
    """Every row of ``versions`` as one struct (``version``) with its text's findings. Name the path
    in ``carry`` where the texts need not come along."""
    rows = addressed(versions, text, carry).select("_row", "_blob")
    # Landed, so that a blob with very many paths is split over tasks.
    found = landed(findings_of(known, rules), "findings")
    return rows.join(found, "_blob", "left").select(
        F.col("_row").alias("version"),
        F.col("_blob").alias("blob"),
        F.coalesce(
            "findings", F.array().cast("array<struct<start:long,order:int,kind:string,end:long>>")
        ).alias("findings"),
    )


def _of_kinds(*kinds: str) -> Column:
    return F.filter("findings", lambda span: span["kind"].isin(*kinds))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(versions: DataFrame, ledger: str, rules: Iterable[Rule] = RULES) -> DataFrame:
    """Scan and report per row: base findings by kind, their digest, and all spans."""
    found = with_findings(versions, scan(versions, ledger, rules), rules, carry="doc_id")
    base = _of_kinds(*(rule.kind for rule in BASE_RULES))
    return found.select(
        F.col("version.doc_id").alias("doc_id"),
        *(
            F.size(_of_kinds(rule.kind)).cast("long").alias(f"n_{rule.kind}") for rule in BASE_RULES
        ),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("findings")).alias("spans"),
    )


def _sql() -> str:
    """The same by splitting and extracting in DuckDB."""

    def places(order: int, rule: Rule) -> str:
        pattern = rule.pattern.replace("'", "''")
        counts = f"WHERE length(regexp_extract(m, '{pattern}', {rule.group})) >= {rule.least}" if rule.least else ""
        return f"""
  SELECT id, {order} AS kind_order, '{rule.kind}' AS kind, place - length(m) AS b, place AS e FROM (
    SELECT id, m, sum(length(gap) + length(m)) OVER (PARTITION BY id ORDER BY i) AS place FROM (
      SELECT id, unnest(found) AS m, unnest(gaps[1:len(found)]) AS gap, generate_subscripts(found, 1) AS i
      FROM (SELECT id, regexp_extract_all(t, '{pattern}') AS found, regexp_split_to_array(t, '{pattern}') AS gaps
        FROM texts))) {counts}"""

    union = "\n  UNION ALL".join(places(order, rule) for order, rule in enumerate(RULES))
    base = ", ".join(f"'{rule.kind}'" for rule in BASE_RULES)
    counts = ",\n  ".join(
        f"count(kind) FILTER (kind = '{rule.kind}') AS n_{rule.kind}" for rule in BASE_RULES
    )
    listed = "string_agg(kind || ':' || b::BIGINT || ':' || e::BIGINT, ',' ORDER BY b, kind_order)"
    return f"""
WITH texts AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({union})
SELECT any_value(doc_id) AS doc_id,
  {counts},
  sha256(coalesce({listed} FILTER (kind IN ({base})), '')) AS base_sha256,
  coalesce({listed} FILTER (kind IS NOT NULL), '') AS spans
FROM texts LEFT JOIN spans USING (id)
GROUP BY id
"""


@query(_sql())
def op13_secret_scan(spark, sf_dir):
    """The secrets of every document, through a ledger that begins empty."""
    return report(read_table(spark, sf_dir, "documents"), scratch_path(spark, "blob-ledger"))
