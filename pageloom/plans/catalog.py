"""All registered queries."""

from __future__ import annotations

import importlib

from pageloom.plans.registry import REGISTRY, Query

MODULES = (
    "url_queries",
    "text_queries",
    "markup_queries",
    "prune_queries",
    "score_queries",
    "extract_queries",
    "flow_queries",
    "meta_queries",
    "link_queries",
    "corpus_queries",
    "ingest_queries",
)


def all_queries() -> dict[str, Query]:
    for module in MODULES:
        importlib.import_module(f"pageloom.plans.{module}")
    return dict(REGISTRY)
