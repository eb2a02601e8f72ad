"""All registered queries of this package and their SQL texts."""

from __future__ import annotations

import importlib

MODULES = [importlib.import_module(f"talweg.llm.{m}") for m in ("sharding", "tokens", "quality", "extract", "linededup", "jaccard", "packing", "decontaminate", "warc", "topk", "onlinepack", "resample", "codes", "pipeline")]
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
