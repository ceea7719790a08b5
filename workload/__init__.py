"""Checked queries: every operator run on the shared test tables, with its SQL twin."""

from importlib import import_module

MODULES = ("q_sources", "q_clean", "q_patterns", "q_recommend", "q_segments", "q_model")


def load_all() -> None:
    """Import the query modules, which register their queries."""
    for name in MODULES:
        import_module(f"workload.{name}")
