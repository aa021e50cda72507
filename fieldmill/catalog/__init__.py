"""Registered queries, each with its SQL counterpart where one exists."""

from .base import REGISTRY, Entry, Tables, register

__all__ = ["REGISTRY", "Entry", "Tables", "load_all", "register"]


def load_all() -> dict[str, Entry]:
    """Import every section and return the filled registry."""
    from . import (  # noqa: F401
        aggregates,
        cleaning,
        evaluation,
        jobs,
        models,
        scalars,
        scans,
        splits,
        tables,
        windows,
    )

    return REGISTRY
