"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from importlib import import_module

#: One module per operator; each has QUERIES and ORACLES.
MODULES = ["chat", "mixing", "licenses", "warc", "hamming_search", "substring_dedup", "simhash", "decontamination", "toxicity", "context_mixing"]


def _gather(kind: str) -> dict:
    out: dict = {}
    for m in MODULES:
        out |= getattr(import_module(f"sievecraft.llm.{m}"), kind)
    return out


QUERIES = _gather("QUERIES")
ORACLES = _gather("ORACLES")
