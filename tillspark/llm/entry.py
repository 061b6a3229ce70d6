"""The queries of this subpackage, by name."""

from importlib import import_module

import corpus_pipeline

MODULES = ["winnowing", "sentencepiece_bpe", "token_files", "dart_minhash", "sparse_suffix", "language_id", "quality", "mixing", "extendible_sharding", "curve_search",
           "merkle", "collocations", "packing"]


def queries() -> dict:
    out = {}
    for name in MODULES:
        out.update(import_module(f"tillspark.llm.{name}").QUERIES)
    out["pipeline"] = corpus_pipeline.run
    return out


def oracle_sql() -> dict[str, str]:
    out = {}
    for name in MODULES:
        out.update(getattr(import_module(f"tillspark.llm.{name}"), "SQL", {}))
    return out
