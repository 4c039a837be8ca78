"""Invariants that a run must meet before its month is published (CHK1, CHK3-CHK5)."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Decimal


class BrokenInvariant(RuntimeError):
    """The month was not published."""


@dataclass(frozen=True)
class Gate:
    """``found`` must be within ``tolerance`` of ``wanted``. None stands for no rows, which is 0."""

    name: str
    found: Decimal | None
    wanted: Decimal | None
    tolerance: Decimal

    def holds(self) -> bool:
        return abs(Decimal(self.found or 0) - Decimal(self.wanted or 0)) <= self.tolerance


def check_all(gates: Iterable[Gate]) -> None:
    broken = [g for g in gates if not g.holds()]
    if broken:
        raise BrokenInvariant("; ".join(f"{g.name}: {g.found} where {g.wanted} is due" for g in broken))
