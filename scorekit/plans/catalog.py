"""All registered queries: importing the query modules fills the registry."""

from __future__ import annotations

from . import q_cardio, q_clean, q_contracts, q_ensemble, q_features, q_io, q_misc, q_models, q_profile, q_scale, q_trees  # noqa: F401
from .registry import REGISTRY, oracle_text, run_query


def query_names() -> list[str]:
    return list(REGISTRY)


def queries() -> dict:
    return {name: (lambda spark, sf, _n=name: run_query(_n, spark, sf)) for name in REGISTRY}


def oracle_sql() -> dict:
    out = {}
    for name in REGISTRY:
        text = oracle_text(name)
        if text is not None:
            out[name] = text
    return out
