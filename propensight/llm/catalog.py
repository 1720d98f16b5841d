"""Queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from propensight.llm import (alignment, contamination, extraction, language, mixing, near_dups, neighbours, phrases, pii,
                            substrings, top_k, urls, warc)

MODULES = (extraction, contamination, language, warc, pii, substrings, urls, mixing, near_dups, neighbours, alignment,
           phrases, top_k)
QUERIES = {name: getattr(m, name) for m in MODULES for name in sorted(vars(m)) if name.startswith("op") and name[2].isdigit()}
ORACLES = {name: sql for m in MODULES for name, sql in getattr(m, "SQL", {}).items()}
