"""All registered queries."""

from __future__ import annotations

from . import catalog_games, catalog_history, catalog_joins, catalog_model, catalog_shape, catalog_sources, catalog_training  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
