"""Column roles: which column of a table plays which part in an operator."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    """Names of the columns an operator works on.

    ``part`` are the coarse keys (season, round), ``entity`` the competitor, ``seq`` its dense
    lap counter, ``run`` a consecutive stretch inside the entity, ``measure`` the analysed value,
    ``age`` a counter that drops at a reset, ``rank`` the order among entities at one ``seq`` and
    ``category`` a low-cardinality label.
    """

    part: tuple[str, ...] = ()
    entity: str = "entity"
    seq: str = "seq"
    run: str = "run"
    measure: str = "measure"
    age: str = "age"
    rank: str = "rank"
    category: str = "category"

    @property
    def keys(self) -> list[str]:
        return [*self.part, self.entity]

    @property
    def run_keys(self) -> list[str]:
        return [*self.part, self.entity, self.run]

    @property
    def seq_keys(self) -> list[str]:
        return [*self.part, self.seq]

    @property
    def row_keys(self) -> list[str]:
        return [*self.part, self.entity, self.seq]


#: Roles of the landed race tables (columns as delivered by the timing feed).
RACE = Roles(
    part=("year", "round"),
    entity="Driver",
    seq="LapNumber",
    run="Stint",
    measure="LapTime_seconds",
    age="TyreLife",
    rank="Position",
    category="Compound",
)
