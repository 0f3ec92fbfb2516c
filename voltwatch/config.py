"""Column roles and scale knobs shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Columns:
    """Names of the roles a telemetry table plays.

    ``entity=None`` selects the global variant of every per-entity operator
    (the whole table is one series).  ``tie`` breaks equal timestamps so that
    row order, and with it every lag and rolling frame, is deterministic.
    """

    entity: str | None
    time: str
    tie: str | None = None
    sensors: tuple[str, ...] = ()
    label: str | None = None
    parent: str | None = None

    def order(self) -> list[str]:
        return [self.time] + ([self.tie] if self.tie else [])

    def keys(self) -> list[str]:
        return ([self.entity] if self.entity else []) + self.order()

    def with_(self, **kw) -> "Columns":
        return replace(self, **kw)


@dataclass(frozen=True)
class Scale:
    """Thresholds that decide the physical strategy, never the result.

    hot_entity_rows   an entity with more rows is split into time segments so
                      that no single task holds it; windows get carries/halos.
    segment_rows      rows of such a segment, about (at most hot_entity_rows).
    broadcast_rows    a per-entity statistics table is broadcast only when the
                      number of entities is known to be at most this.
    approx_accuracy   accuracy of the percentile sketch used for segment cuts.
    """

    hot_entity_rows: int = 4_000_000
    segment_rows: int = 500_000
    broadcast_rows: int = 2_000_000
    approx_accuracy: int = 10_000


DEFAULT_SCALE = Scale()
