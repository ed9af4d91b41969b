"""All queries of this subpackage, registered by importing their modules."""

from __future__ import annotations

import corpus_pipeline  # noqa: F401
from tillwork.llm import (  # noqa: F401
    bpe,
    exact_dedup,
    lexical_search,
    license_scan,
    mixing,
    near_dedup,
    phrase_mining,
    quality_model,
    quality_rules,
    secret_scan,
    substring_dedup,
    suffix_dedup,
    warc,
)
from tillwork.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
