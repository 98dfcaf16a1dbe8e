"""Segment rules compiled to one filter column."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, functions as F

_COMPARE = {
    "equals": lambda c, v, _: c == v,
    "not_equals": lambda c, v, _: c != v,
    "greater_than": lambda c, v, _: c > v,
    "less_than": lambda c, v, _: c < v,
    "gte": lambda c, v, _: c >= v,
    "lte": lambda c, v, _: c <= v,
    "in": lambda c, v, _: c.isin(*v),
    "not_in": lambda c, v, _: ~c.isin(*v),
    "contains": lambda c, v, _: c.contains(v),
    "between": lambda c, v, end: c.between(v, end),
}
OPERATORS = tuple(_COMPARE)


@dataclass(frozen=True)
class Condition:
    field: str
    operator: str
    value: Any
    value_end: Any = None

    def column(self) -> Column:
        if self.operator not in _COMPARE:
            raise ValueError(f"unknown operator {self.operator!r}")
        if self.operator == "between" and self.value_end is None:
            raise ValueError(f"between on {self.field!r} needs an end value")
        return _COMPARE[self.operator](F.col(self.field), self.value, self.value_end)


@dataclass(frozen=True)
class Criteria:
    logic: str = "AND"
    conditions: tuple[Condition, ...] = ()
    groups: tuple["Criteria", ...] = field(default=())

    @classmethod
    def from_dict(cls, spec: dict) -> "Criteria":
        return cls(
            spec.get("logic", "AND"),
            tuple(Condition(**r) for r in spec.get("rules", ())),
            tuple(cls.from_dict(g) for g in spec.get("nested_criteria", ())),
        )

    @property
    def is_empty(self) -> bool:
        return not self.conditions and not self.groups

    def column(self) -> Column:
        """A filter on plain columns, so it can reach the scan."""
        if self.logic not in ("AND", "OR"):
            raise ValueError(f"unknown logic {self.logic!r}")
        parts = [c.column() for c in self.conditions]
        parts += [g.column() for g in self.groups if not g.is_empty]
        if not parts:
            raise ValueError("empty criteria would match every user")
        return reduce(and_ if self.logic == "AND" else or_, parts)


def tag_segments(df, segments: dict[str, Criteria], id_column: str = "user_id"):
    """(user, segment) rows for every segment a user matches; one pass over the input."""
    matched = F.array_remove(F.array(*[
        F.when(criteria.column(), F.lit(name)).otherwise(F.lit(""))
        for name, criteria in segments.items()
    ]), "")
    # an outer explode, because a plain one evaluates the array again as a filter
    tagged = df.select(id_column, F.explode_outer(matched).alias("segment_id"))
    return tagged.where(F.col("segment_id").isNotNull())
