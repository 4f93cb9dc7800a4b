"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import importlib

#: A module for each operator; each has QUERIES and may have SQL.
MODULES = ["lm_bloom", "jump_shard", "token_counts", "bin_slack", "size_aware_join", "mixture_langid", "qgram_decon", "collision_dedup",
           "sparse_suffix", "pii_bootstrap", "pair_maxscore", "block_rotation", "bin_completion"]

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _name in MODULES:
    _module = importlib.import_module(f"gridmart.llm.{_name}")
    QUERIES.update(_module.QUERIES)
    SQL.update(getattr(_module, "SQL", {}))
