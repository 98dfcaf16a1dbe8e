"""Segment rules as data: an index of rules is met with users, so that plans do not grow with the rules.

A rule set becomes clauses, each an AND of conditions; a segment is any of its clauses. The
constants of a field, sorted, cut its values into classes: each constant is one, and so is
each gap between two. A condition is then a few spans of classes. A user's value gets its
class by binary search, and a user meets only the clauses whose most selective condition
holds its class; what is left of such a clause is judged on classes alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from adlumen.operators.rules import OPERATORS, Condition, Criteria

#: Clauses of one rule set; nested ANDs of ORs multiply.
MAX_CLAUSES = 1_000
_INDEX = T.StructType([
    T.StructField("segment_id", T.StringType()), T.StructField("field", T.IntegerType()), T.StructField("spans", T.ArrayType(
        T.ArrayType(T.IntegerType()))), T.StructField("conditions", T.ArrayType(T.StructType([
            T.StructField("field", T.IntegerType()), T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType())))])))])


def clauses(criteria: Criteria) -> list[tuple[Condition, ...]]:
    """Disjunctive normal form: any clause, all of its conditions."""
    if criteria.logic not in ("AND", "OR"):
        raise ValueError(f"unknown logic {criteria.logic!r}")
    if criteria.is_empty:
        raise ValueError("empty criteria would match every user")
    parts = [[(c,)] for c in criteria.conditions] + [clauses(g) for g in criteria.groups if not g.is_empty]
    if criteria.logic == "OR":
        out = [clause for part in parts for clause in part]
    else:
        size = 1
        for part in parts:
            size *= len(part)
        if size > MAX_CLAUSES:
            raise ValueError(f"a rule set of {size} clauses")
        out = [tuple(c for clause in chosen for c in clause) for chosen in product(*parts)]
    if len(out) > MAX_CLAUSES:
        raise ValueError(f"a rule set of {len(out)} clauses")
    return out


@dataclass(frozen=True)
class RuleIndex:
    """``fields`` with the sorted constants and substrings of each, and ``entries`` of clauses."""

    fields: tuple[str, ...]
    bounds: tuple[tuple, ...]
    parts: tuple[tuple[str, ...], ...]
    entries: tuple

    @classmethod
    def build(cls, segments: dict[str, Criteria]) -> RuleIndex:
        found = {name: clauses(criteria) for name, criteria in segments.items()}
        every = [c for own in found.values() for clause in own for c in clause]
        for c in every:
            if c.operator not in OPERATORS:
                raise ValueError(f"unknown operator {c.operator!r}")
        fields = tuple(sorted({c.field for c in every}))
        bounds, parts = [], []
        for f in fields:
            own = [c for c in every if c.field == f]
            constants = {v for c in own if c.operator != "contains" for v in _constants(c)}
            # one type for all: 5 and 0.5 may both be constants of a field
            constants = {float(v) for v in constants} if any(isinstance(v, float) for v in constants) else constants
            bounds.append(tuple(sorted(constants)))
            parts.append(tuple(sorted({c.value for c in own if c.operator == "contains"})))
        at = {f: i for i, f in enumerate(fields)}
        entries = []
        for name, own in found.items():
            for clause in own:
                judged = [(at[c.field], _spans(c, bounds[at[c.field]], parts[at[c.field]])) for c in clause]
                # the condition that holds the fewest classes leads to the clause
                widths = [sum(b - a + 1 for a, b in spans) if spans and spans[0][0] >= 0 else 1 << 30 for _, spans in judged]
                first = widths.index(min(widths))
                entries.append((name, *judged[first], [j for i, j in enumerate(judged) if i != first]))
        return cls(fields, tuple(bounds), tuple(parts), tuple(entries))

    def table(self, spark: SparkSession) -> DataFrame:
        """A row for each clause."""
        rows = [(n, f, [list(x) for x in s], [(g, [list(x) for x in t]) for g, t in rest]) for n, f, s, rest in self.entries]
        return spark.createDataFrame(rows, _INDEX)

    def _class(self, i: int, value: Column) -> Column:
        """2n + 1 at the n-th constant (from 0), 2n before it; null for a null value."""
        bounds = self.bounds[i]
        if not bounds:
            return F.when(value.isNotNull(), F.lit(0))
        constants, n = F.lit(list(bounds)), len(bounds)
        steps = [1 << k for k in reversed(range(n.bit_length()))]
        # how many constants are at most the value, a halving step at a time
        place = F.aggregate(F.lit(steps), F.lit(0), lambda at, step: F.when(
            (at + step <= n) & (F.get(constants, at + step - 1) <= value), at + step).otherwise(at))
        return F.when(value.isNotNull(), 2 * place - F.coalesce((F.get(constants, place - 1) == value).cast("int"), F.lit(0)))

    def classed(self, users: DataFrame, id_column: str) -> DataFrame:
        """id and for each field its class; then, negative, which of its substrings it holds."""
        own = []
        for i, f in enumerate(self.fields):
            value = F.col(f)
            held = F.array(self._class(i, value))
            if self.parts[i]:
                known = F.lit(list(self.parts[i]))
                hits = F.transform(known, lambda p, at: F.when(F.contains(value.cast("string"), p), -at - 1))
                held = F.concat(held, F.filter(hits, lambda x: x.isNotNull()))
            own.append(held)
        return users.select(F.col(id_column).alias("_id"), F.array(*own).alias("classes"))


def _constants(c: Condition) -> list:
    if c.operator == "between":
        if c.value_end is None:
            raise ValueError(f"between on {c.field!r} needs an end value")
        return [c.value, c.value_end]
    return list(c.value) if c.operator in ("in", "not_in") else [c.value]


def _spans(c: Condition, bounds: tuple, parts: tuple) -> list[tuple[int, int]]:
    """Classes for which a condition holds; a substring is the negative class of its own."""
    last = 2 * len(bounds)
    if c.operator == "contains":
        at = -parts.index(c.value) - 1
        return [(at, at)]
    at = [2 * bounds.index(v) + 1 for v in _constants(c)]
    if c.operator in ("equals", "in"):
        return sorted({(a, a) for a in at})
    if c.operator in ("not_equals", "not_in"):
        spans, first = [], 0
        for a in sorted(set(at)):
            spans.append((first, a - 1))
            first = a + 1
        return [*spans, (first, last)]
    low, high = {"greater_than": (at[0] + 1, last), "gte": (at[0], last), "less_than": (0, at[0] - 1), "lte": (0, at[0]),
                 "between": (at[0], at[-1])}[c.operator]
    return [(low, high)] if low <= high else []


def tag_by_index(users: DataFrame, index: RuleIndex, id_column: str = "user_id") -> DataFrame:
    """(user, segment) rows for every segment a user matches, once each; like ``tag_segments``.

    The index is a table: Spark broadcasts it while it is small and joins it otherwise. A
    user row is copied once for each field that leads to clauses, not once for each rule.
    """
    spark = users.sparkSession
    rules = index.table(spark)
    leading = sorted({f for _, f, _, _ in index.entries})
    classed = index.classed(users, id_column)
    asked = classed.select("_id", "classes", F.explode(F.lit(leading)).alias("field")).select(
        "_id", "classes", "field", F.explode(F.get("classes", F.col("field"))).alias("held"))
    doors = rules.select("segment_id", "conditions", "field", F.explode("spans").alias("s")).select(
        "segment_id", "conditions", "field", F.explode(F.sequence(F.get("s", 0), F.get("s", 1))).alias("held"))

    def holds(condition: Column) -> Column:
        return F.exists(F.get("classes", condition["field"]), lambda held: F.exists(
            condition["spans"], lambda s: held.between(F.get(s, 0), F.get(s, 1))))

    met = asked.join(doors, ["field", "held"])
    return met.where(F.forall("conditions", holds)).select(F.col("_id").alias(id_column), "segment_id").distinct()
