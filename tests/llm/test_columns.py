"""Columns named like an operator's own pass through whole."""

import pytest
from pyspark.sql import functions as F

TEXTS = [
    (1, "One day the old man went down to the river and sat there for a while, thinking.", "a"),
    (2, "A second text, quite unlike the first, was written here by somebody else entirely today.", "b"),
    (3, None, None),
]


def with_columns(spark, names):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string, source string")
    return docs.withColumns({name: F.concat(F.lit(f"KEEP {name} "), "doc_id") for name in names})


def functions():
    from tillwork.llm import exact_dedup, mixing, near_dedup, quality_rules

    yield "exact", exact_dedup.drop_copies, [*exact_dedup.KEY, "_keep_id", "_run", "_rows", "_SHA"]
    yield "near", near_dedup.keep_one_of_each, ["_id", "_node", "label", "class_id", "_ID"]
    yield "mixed", mixing.mixed, [*mixing.WORKING, "mix", "_mix", "_time", "_rank", "_weight", "_SRC"]
    yield "clean", quality_rules.keep_clean, [*quality_rules.JUDGED, "_w", "_l", "KEPT"]


def distinct(names):
    """Without names that differ in case only: one table cannot hold both."""
    return list({name.lower(): name for name in names}.values())


@pytest.mark.parametrize("name", ["exact", "near", "mixed", "clean"])
def test_all_together(spark, name):
    check(spark, name, distinct(next(names for n, _, names in functions() if n == name)))


@pytest.mark.parametrize(("name", "working"), [("near", ["_node"]), ("mixed", ["_target"]), ("clean", ["_w"])])
def test_one_alone(spark, name, working):
    check(spark, name, working)


def check(spark, name, names):
    (function,) = (f for n, f, _ in functions() if n == name)
    out = function(with_columns(spark, names))
    assert out.columns == ["doc_id", "text", "source", *names]
    rows = out.collect()
    assert rows
    for row in rows:
        assert [row[c] for c in names] == [f"KEEP {c} {row.doc_id}" for c in names]


def test_columns_of_documents_judged_mixed_and_decoded(spark):
    from tillwork.llm.bpe import decode_documents, encode_documents, public_vocabulary
    from tillwork.llm.mixing import mix_documents
    from tillwork.llm.quality_rules import judge_documents

    pytest.importorskip("public_tokenizers")
    vocabulary = public_vocabulary(spark)
    for function, names in (
        (judge_documents, ["_w", "_l"]),
        (mix_documents, ["_target", "_copies"]),
        (lambda d: decode_documents(encode_documents(d, vocabulary), vocabulary), ["_decoded"]),
    ):
        for row in function(with_columns(spark, names)).collect():
            assert [row[c] for c in names] == [f"KEEP {c} {row.doc_id}" for c in names]
