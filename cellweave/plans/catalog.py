"""All named queries of the engine and their SQL."""

from __future__ import annotations

from . import derived, files, flagship, labels_and_time, learned, profiles, quality_of_models, scalars, space_and_joins  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
