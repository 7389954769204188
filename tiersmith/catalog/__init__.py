"""Every operator as a runnable query over the driver tables."""

from __future__ import annotations

from importlib import import_module

MODULES = ["ingest", "silver", "warehouse", "quality", "views", "dashboards", "histories", "kept", "pipeline"]


def load_all() -> None:
    """Import the query modules; importing one registers its queries."""
    for name in MODULES:
        import_module(f"tiersmith.catalog.{name}")
