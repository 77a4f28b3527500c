"""Layered table pipelines (bronze, silver, gold) as plain Spark jobs."""

from terrace.plans.runs import run_all, run_gold, run_pipeline
from terrace.plans.spec import load_spec, table_spec

__all__ = ["load_spec", "run_all", "run_gold", "run_pipeline", "table_spec"]
