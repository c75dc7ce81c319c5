"""All registered queries."""

from __future__ import annotations

from cohortlift.plans import (  # noqa: F401
    clean_queries, encode_queries, evaluate_queries, feature_queries, fit_queries, model_queries, profile_queries,
    source_queries,
)
from cohortlift.plans.base import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
