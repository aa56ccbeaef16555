"""Registered queries: each module wires the table views to operators and states the SQL twin."""

from importlib import import_module

MODULES = ("merge_plans", "graph_plans", "stats_plans", "edge_plans", "text_plans", "change_plans", "consensus_plans", "quality_plans", "source_plans")


def load_all() -> None:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
