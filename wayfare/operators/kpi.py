"""KPI tables as grouping sets: several tables of one fact table from one scan.

A ``Kpi`` names keys, measures, what is derived from the rounded measures, and which
rows count. It builds its table by itself (``build``), or together with others
(``in_one_pass``): each row is expanded to one per table inside the task that read it,
and partial sums are made there, so one scan and one exchange of partial rows feed all.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact

#: Which table a row of a common pass belongs to.
SET = "_set"


@dataclass(frozen=True)
class Kpi:
    """One table. ``only`` keeps the rows that count; it is decided by the columns ``only_by`` alone."""

    keys: Sequence[str | Column]
    measures: Sequence[Column]
    derived: Callable[[], dict[str, Column]] | None = None
    only: Callable[[], Column] | None = None
    only_by: Sequence[str] = ()
    having: Callable[[], Column] | None = None

    def names(self, facts: DataFrame) -> tuple[list[str], list[str]]:
        """Names of the keys and of the measures."""
        columns = facts.groupBy(*self.keys).agg(*self.measures).columns
        return columns[: len(self.keys)], columns[len(self.keys) :]

    def finish(self, table: DataFrame) -> DataFrame:
        out = table.withColumns(self.derived()) if self.derived else table
        return out.filter(self.having()) if self.having else out

    def build(self, facts: DataFrame) -> DataFrame:
        rows = facts.filter(self.only()) if self.only else facts
        return self.finish(rows.groupBy(*self.keys).agg(*self.measures))


def in_one_pass(facts: DataFrame, kpis: Mapping[str, Kpi], summed: Sequence[str] = ()) -> DataFrame:
    """The rows of all tables, ``SET`` naming the table: all keys, and all measures for each row.

    Measures of one name must be the same in all tables. ``summed`` names columns that are only summed
    exactly: they become decimals once per row, not once for each of the tables that a row is expanded to.
    """
    keyed, wanted, sets = facts.withColumns({c: exact(c) for c in summed}), {}, {}
    for name, kpi in kpis.items():
        keys, measures = kpi.names(facts)
        for key, column in zip(keys, kpi.keys):
            keyed = keyed if isinstance(column, str) else keyed.withColumn(key, column)
        for measure, column in zip(measures, kpi.measures):
            if str(wanted.setdefault(measure, column)) != str(column):
                raise ValueError(f"two measures are named {measure}")
        sets[name] = list(dict.fromkeys([*keys, *kpi.only_by]))
    if len({frozenset(s) for s in sets.values()}) < len(sets):
        raise ValueError("two tables have the same keys")
    every = list(dict.fromkeys(k for s in sets.values() for k in s))
    cube = keyed.groupingSets(list(sets.values()), *every).agg(F.grouping_id().alias("_id"), *wanted.values())
    which = F.lit(None)
    for name, keys in sets.items():
        which = F.when(F.col("_id") == sum(1 << k for k, key in enumerate(reversed(every)) if key not in keys), name).otherwise(which)
    kept = F.lit(True)
    for name, kpi in kpis.items():
        if kpi.only:
            kept = kept & ((F.col(SET) != name) | F.coalesce(kpi.only(), F.lit(False)))
    return cube.withColumn(SET, which).drop("_id").filter(kept)


def part(cube: DataFrame, facts: DataFrame, name: str, kpi: Kpi) -> DataFrame:
    """One table out of a common pass, the same as ``kpi.build(facts)``; ``facts`` gives names only."""
    keys, measures = kpi.names(facts)
    return kpi.finish(cube.filter(F.col(SET) == name).select(*keys, *measures))
