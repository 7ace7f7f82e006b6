"""All queries of this folder; importing the modules registers them."""

from __future__ import annotations

import importlib

MODULES = ["url_rules", "exact_dedup", "decontaminate", "simple8b", "packing", "toxicity", "quality", "ngram_join", "chat", "warc", "collocations", "cover_codes", "mixing"]

for _name in MODULES:
    importlib.import_module(f"cuadra.llm.{_name}")

from cuadra.llm.common import QUERIES, SQL  # noqa: E402,F401
