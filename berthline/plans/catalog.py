"""Registered queries over the driver's tables, each with its DuckDB twin.

Every query reads the given tables whole. Double outputs are rounded to four
decimals on both sides so that value hashes do not depend on summation order.
"""

from __future__ import annotations

from . import q_encode, q_events, q_history, q_io, q_rows  # noqa: F401  (registration side effects)
from .registry import ORACLES, QUERIES, register

__all__ = ["ORACLES", "QUERIES", "register"]
