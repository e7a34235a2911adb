"""All registered queries, imported for their registration side effect."""

from __future__ import annotations

from . import q_encode, q_frame, q_metrics, q_models, q_profile, q_split  # noqa: F401
from .registry import REGISTRY


def queries():
    return {n: q.fn for n, q in REGISTRY.items()}


def oracle_sql():
    return {n: q.sql for n, q in REGISTRY.items() if q.sql is not None}
