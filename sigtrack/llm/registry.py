"""The queries of this subpackage and, where SQL can express them, the same in DuckDB's SQL."""

from __future__ import annotations

import importlib

#: Query name and the module that has it under that name.
_QUERIES = {
    "op1_simhash": "simhash",
    "op2_langid": "langid",
    "op3_licenses": "licenses",
    "op4_pack": "packing",
    "op5_repair_ids": "repair",
    "op6_quality": "quality",
    "op7_embeddings": "embeddings",
    "op8_html": "webpage",
    "op9_mix": "mixing",
    "op10_chat": "chat",
    "op9_blocks": "mixing",
    "op11_scaled_sketch": "scaled_sketch",
    "op12_collocations": "collocations",
    "op13_centroids": "centroids",
}


def queries():
    return {name: getattr(importlib.import_module(f"{__package__}.{module}"), name) for name, module in _QUERIES.items()}


def oracle_sql():
    out = {}
    for name, module in _QUERIES.items():
        sql = getattr(importlib.import_module(f"{__package__}.{module}"), "ORACLE", {})
        if name in sql:
            out[name] = sql[name]
    return out
