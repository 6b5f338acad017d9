"""All queries for the driver's tables by name, and SQL for comparison."""

from __future__ import annotations

from . import naming, quality, rankings, relational, safety  # noqa: F401
from .base import ORACLE_SQL, QUERIES  # noqa: F401
