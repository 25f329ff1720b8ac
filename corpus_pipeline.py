"""A training-data pipeline over ``documents``: five stages, each stored before the next."""

from __future__ import annotations

from changeloom.llm.stages import STAGES, run

#: SQL cannot express the fitted stages; tests/llm compares them with brute force.
ORACLE_SQL = None

__all__ = ["ORACLE_SQL", "STAGES", "run"]
