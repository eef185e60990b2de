"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from millrace.llm import (  # noqa: F401
    bit_sliced,
    collocations,
    decontamination,
    jaccard_join,
    language,
    packing,
    periodic_runs,
    quality,
    token_counts,
    token_files,
    toxicity,
    url_filter,
    warc,
)
from millrace.llm.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
