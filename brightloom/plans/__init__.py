"""Registered queries, one module per group of operators."""

from importlib import import_module
from importlib.util import find_spec

MODULES = (
    "sources relational timeseries quality eda anomaly features segments modeling text search kpi monitoring "
    "fairness inference udfs"
).split()


def load_all() -> None:
    for m in MODULES:
        if find_spec(f"brightloom.plans.{m}"):
            import_module(f"brightloom.plans.{m}")
