"""The four inclusive bounds that each attribute family can carry."""

from __future__ import annotations

import math
from dataclasses import dataclass
from numbers import Integral


@dataclass(frozen=True)
class Bounds:
    """Bounds on a pair of values, one for each end of an edge, as SQL conditions.

    ``*_both`` must hold at both ends, ``*_either`` at one end at least. The
    ``*_both`` bounds always reject NULL, also when they are as wide as can be:
    an edge whose end has no value for the attribute never qualifies.
    """

    min_both: float
    max_both: float
    min_either: float
    max_either: float
    whole_numbers: bool = True

    def endpoint(self, column: str) -> str:
        """The part of the condition that one end decides alone."""
        return f"{column} BETWEEN {self._low(self.min_both)} AND {self._high(self.max_both)}"

    def across(self, a: str, b: str) -> list[str]:
        """The clauses that need both ends, leaving out those ``endpoint`` implies."""
        clauses = []
        if self.min_either > self.min_both:
            low = self._low(self.min_either)
            clauses.append(f"({a} >= {low} OR {b} >= {low})")
        if self.max_either < self.max_both:
            high = self._high(self.max_either)
            clauses.append(f"({a} <= {high} OR {b} <= {high})")
        return clauses

    def condition(self, a: str, b: str) -> str:
        """The whole test on a pair of columns."""
        return " AND ".join([self.endpoint(a), self.endpoint(b), *self.across(a, b)])

    # A double literal would make Spark cast a bigint column and lose the pushdown
    # into the scan, so bounds on whole numbers become the equivalent integer bound.

    def _low(self, bound: float) -> str:
        return self._literal(bound, math.ceil)

    def _high(self, bound: float) -> str:
        return self._literal(bound, math.floor)

    def _literal(self, bound: float, to_whole) -> str:
        if math.isinf(bound):
            return f"double('{bound}')"
        if not self.whole_numbers:
            return f"{float(bound)!r}D"
        whole = int(bound) if isinstance(bound, Integral) else to_whole(bound)
        # Beyond the range of bigint a bound is the same as at its end.
        return str(min(max(whole, -(2**63) + 1), 2**63 - 1))
