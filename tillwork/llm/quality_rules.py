"""Line-first cleaning: rules judge each line, failing lines go, and a document that loses too much
of its text goes as a whole.

Only built-in expressions, one pass, no shuffle: every figure is computed within its row.

Defined cases: a null text has no words and no lines, so it counts 0 everywhere and fails the base
rules; so does an empty one. Repeated rows are judged alike. Other columns pass through; columns that
``judge_documents`` adds replace ones of the same name. A text must fit into one task's memory.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.common import SPACE, WORD, bound, read_table, set_aside, words_of
from tillwork.llm.registry import query

WINDOW = 5

#: Wording of page furniture, looked for in short lines.
BOILERPLATE = (
    "accept cookies|cookie policy|privacy policy|terms of use|terms of service|all rights reserved|"
    "enable javascript|lorem ipsum|click here|read more|sign in|log in|sign up|subscribe now|"
    "back to top|share this"
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules, and of the text a document may lose."""

    symbol_percent: int = 10  # symbols per character of the line
    exclaim_percent: int = 30  # exclamation and question marks per word ...
    exclaim_least: int = 3  # ... where there are so many
    separators_percent: int = 30  # menu separators per word ...
    separators_least: int = 2  # ... where there are so many
    boilerplate_chars: int = 120  # only lines up to this length are held against the wording list
    lost_percent: int = 30  # words in failing lines, of all words


RULES = LineRules()


def _without(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, f"[{characters}]+", ""))


def _repeated_window_words(words: Column) -> Column:
    """Words inside windows of WINDOW words that the text has twice or more.

    Windows are compared by 64-bit hashes. Sorting (hash, position) brings equal windows together;
    the positions, sorted, give the union of the windows as a sum of steps.
    """
    size = F.size(words)

    def windows() -> Column:
        return F.transform(
            F.sequence(F.lit(0), size - WINDOW),
            lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))),
        )

    def same(sorted_, i, x):
        return F.coalesce(F.get(sorted_, i)["h"] == x["h"], F.lit(False))

    def positions(sorted_: Column) -> Column:
        twice = F.filter(
            sorted_, lambda x, i: same(sorted_, i - 1, x) | same(sorted_, i + 1, x)
        )
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def union(starts: Column) -> Column:
        steps = F.transform(
            starts,
            lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - at, F.lit(WINDOW))),
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def covered(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        slow = bound(F.sort_array(pairs), lambda s: bound(positions(s), union))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), slow).otherwise(0)

    return F.when(size >= WINDOW, bound(windows(), covered)).otherwise(0)


def _fails(line: Column, rules: LineRules) -> Column:
    """Whether a rule fails the line. Marks and words are counted only where a mark occurs."""

    def judge(words: Column) -> Column:
        symbols, exclaims, separators = (_without(line, x) for x in ("#*$%&|<>", "!?", "|»›·"))
        return (
            (symbols * 100 > rules.symbol_percent * F.char_length(line))
            | ((exclaims >= rules.exclaim_least) & (exclaims * 100 > rules.exclaim_percent * words))
            | (
                (separators >= rules.separators_least)
                & (separators * 100 > rules.separators_percent * words)
            )
        )

    marked = F.when(line.rlike("[#*$%&|<>!?»›·]"), bound(F.regexp_count(line, F.lit(WORD)), judge))
    furniture = (F.char_length(line) <= rules.boilerplate_chars) & F.lower(line).rlike(BOILERPLATE)
    return line.rlike(WORD) & (F.coalesce(marked, F.lit(False)) | furniture)


#: What ``judge_documents`` adds.
JUDGED = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_failed_lines n_lost_words clean_text "
    "base_failed kept"
).split()


def judge_documents(docs: DataFrame, rules: LineRules = RULES, text: str = "text") -> DataFrame:
    """``docs`` with the base figures, the lines' verdict, ``kept``, and the text without its failing
    lines in ``clean_text`` (null where the text is null). Columns of these names are replaced."""
    docs, columns = set_aside(docs, "_w", "_l")
    body = F.coalesce(F.col(text), F.lit(""))

    def count(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            _repeated_window_words(words).cast("long").alias("n_repeat_words"),
        )

    def lines_of(lines: Column) -> Column:
        worded = F.filter(lines, lambda x: x.rlike(WORD))
        return F.struct(
            (F.size(worded) - F.size(F.array_distinct(worded))).cast("long").alias("n_dup_lines"),
            bound(F.transform(lines, lambda x: _fails(x, rules)), lambda f: clean(lines, f)).alias(
                "clean"
            ),
        )

    def clean(lines: Column, fails: Column) -> Column:
        failed = F.filter(lines, lambda x, i: F.get(fails, i))
        lost = F.aggregate(failed, F.lit(0), lambda n, x: n + F.regexp_count(x, F.lit(WORD)))
        return F.struct(
            F.size(failed).cast("long").alias("n"),
            lost.cast("long").alias("lost"),
            F.array_join(F.filter(lines, lambda x, i: ~F.get(fails, i)), "\n").alias("text"),
        )

    words = words_of(body)
    lines = F.split(body, "\n")
    base_failed = (F.col("n_words") < 10) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * 20
    )
    judged = (
        docs.withColumns({"_w": bound(words, count), "_l": bound(lines, lines_of)})
        .withColumns(
            {
                "n_words": F.col("_w.n_words"),
                "word_chars": F.char_length(F.regexp_replace(body, SPACE, "")).cast("long"),
                "n_symbols": _without(body, "#*$%&|<>").cast("long"),
                "n_dup_lines": F.col("_l.n_dup_lines"),
                "n_repeat_words": F.col("_w.n_repeat_words"),
                "n_failed_lines": F.col("_l.clean.n"),
                "n_lost_words": F.col("_l.clean.lost"),
                "clean_text": F.when(F.col(text).isNotNull(), F.col("_l.clean.text")),
            }
        )
        .drop("_w", "_l")
        .withColumn("base_failed", base_failed)
        .withColumn(
            "kept",
            ~F.col("base_failed")
            & (F.col("n_lost_words") * 100 <= F.col("n_words") * rules.lost_percent),
        )
    )
    return judged.select(*columns, *(name for name in JUDGED if name not in docs.columns))


def keep_clean(docs: DataFrame, rules: LineRules = RULES) -> DataFrame:
    """The documents that pass, without their failing lines, in the columns of ``docs``."""
    docs, columns = set_aside(docs, *JUDGED)
    judged = judge_documents(docs, rules).where("kept").withColumn("text", F.col("clean_text"))
    if "n_chars" in docs.columns:
        judged = judged.withColumn(
            "n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)
        )
    return judged.select(*columns)


SQL = rf"""
WITH body AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT doc_id, t, regexp_extract_all(t, '{WORD}') AS w, string_split(t, chr(10)) AS all_lines
  FROM body
),
counted AS (
  SELECT *, list_transform(all_lines, lambda l: {{
      'line': l, 'n': len(regexp_extract_all(l, '{WORD}')), 'c': length(l),
      'sym': length(l) - length(regexp_replace(l, '[#*$%&|<>]', '', 'g')),
      'exc': length(l) - length(regexp_replace(l, '[!?]', '', 'g')),
      'sep': length(l) - length(regexp_replace(l, '[|»›·]', '', 'g')),
      'boil': regexp_matches(lower(l), '{BOILERPLATE}')}}) AS ls
  FROM split
),
judged AS (
  SELECT *, list_filter(ls, lambda x: x.n > 0 AND (
      x.sym * 100 > {RULES.symbol_percent} * x.c
      OR (x.exc >= {RULES.exclaim_least} AND x.exc * 100 > {RULES.exclaim_percent} * x.n)
      OR (x.sep >= {RULES.separators_least} AND x.sep * 100 > {RULES.separators_percent} * x.n)
      OR (x.c <= {RULES.boilerplate_chars} AND x.boil))) AS failed,
    list_transform(list_filter(ls, lambda x: x.n > 0), lambda x: x.line) AS worded
  FROM counted
),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM split
        WHERE len(w) >= {WINDOW})
),
twice AS (
  SELECT doc_id, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
),
covered AS (
  SELECT doc_id, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW})))::BIGINT AS n FROM (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice)
  GROUP BY doc_id
),
figures AS (
  SELECT j.doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '{SPACE}', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(worded) - len(list_distinct(worded)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(failed)::BIGINT AS n_failed_lines,
    coalesce(list_sum(list_transform(failed, lambda x: x.n)), 0)::BIGINT AS n_lost_words
  FROM judged j LEFT JOIN covered c USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
    AND n_lost_words * 100 <= n_words * {RULES.lost_percent} AS kept,
  n_failed_lines, n_lost_words
FROM figures
"""


@query(SQL)
def op1_quality_rules(spark, sf_dir):
    """The base figures and the verdict of every document."""
    return judge_documents(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_failed_lines", "n_lost_words",
    )
