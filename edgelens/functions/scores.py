"""Directional scores and how the two directions combine into one, as SQL expressions."""

from __future__ import annotations

from enum import Enum


def nan_to_null(score: str) -> str:
    """NaN carries no ranking information; treat it as a missing score."""
    return f"CASE WHEN NOT isnan({score}) THEN {score} END"


def _if_both_present(a: str, b: str, combined: str) -> str:
    return f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {combined} END"


def strict_greatest(a: str, b: str) -> str:
    """Larger of two values, NULL if either is NULL (``greatest`` alone skips NULLs)."""
    return _if_both_present(a, b, f"greatest({a}, {b})")


def strict_least(a: str, b: str) -> str:
    """Smaller of two values, NULL if either is NULL (``least`` alone skips NULLs)."""
    return _if_both_present(a, b, f"least({a}, {b})")


class ScoreFn(str, Enum):
    """How the A->B and B->A scores of a contact become its ranking score."""

    OPTIMISTIC = "greatest"
    PESSIMISTIC = "least"

    def of(self, a: str, b: str) -> str:
        return strict_greatest(a, b) if self is ScoreFn.OPTIMISTIC else strict_least(a, b)
