"""All registered queries."""

from __future__ import annotations

from auditlens.plans import (  # noqa: F401  (they register)
    cleaning,
    comparing,
    encoding,
    explaining,
    fairness,
    modelling,
    profiling,
    quality,
)
from auditlens.plans.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
