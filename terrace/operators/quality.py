"""Named data-quality rules over a DataFrame, batch or streaming.

A rule holds when its predicate is TRUE; FALSE and NULL are violations. All drop
rules of a set become one conjunctive filter that Catalyst can push towards the
scan, and all counters of a set are computed in a single pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN = "warn"
DROP = "drop"
FAILED_RULES = "failed_rules"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    action: str = DROP

    def __post_init__(self) -> None:
        if self.action not in (WARN, DROP):
            raise ValueError(f"rule {self.name}: action must be '{WARN}' or '{DROP}', not '{self.action}'")

    @property
    def holds(self) -> Column:
        return F.expr(self.predicate)

    @property
    def violated(self) -> Column:
        return ~F.coalesce(self.holds, F.lit(False))


def rules(named: Mapping[str, str], action: str) -> list[Rule]:
    """Rules from a name -> predicate mapping, all with one action."""
    return [Rule(name, predicate, action) for name, predicate in named.items()]


def resolve(df: DataFrame, rule_set: Iterable[Rule]) -> list[Rule]:
    """Analyse every predicate against ``df`` so that a bad one is reported by rule name."""
    checked = list(rule_set)
    names = [r.name for r in checked]
    repeated = {n for n in names if names.count(n) > 1}
    if repeated:
        raise ValueError(f"rule names repeat: {sorted(repeated)}")
    try:
        df.select(*[r.holds.cast("boolean").alias(r.name) for r in checked])
    except AnalysisException:
        for r in checked:
            try:
                df.select(r.holds.cast("boolean"))
            except AnalysisException as e:
                raise ValueError(f"rule {r.name}: cannot evaluate '{r.predicate}': {e}") from e
        raise
    return checked


def counters(rule_set: list[Rule]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows")] + [F.count_if(r.violated).alias(r.name) for r in rule_set]


def expect(df: DataFrame, rule_set: Iterable[Rule], observe: Observation | str | None = None) -> DataFrame:
    """Apply ``rule_set``: warn rules keep every row, drop rules remove violating rows.

    With ``observe`` the violations of all rules are counted on the way (before the
    filter): pass an ``Observation`` for a batch frame, a metric name for a stream,
    whose counts then arrive per micro-batch in the progress events.
    """
    checked = resolve(df, rule_set)
    if observe is not None:
        df = df.observe(observe, *counters(checked))
    drops = [r.holds for r in checked if r.action == DROP]
    return df.filter(reduce(lambda a, b: a & b, drops)) if drops else df


def quality_report(df: DataFrame, rule_set: Iterable[Rule]) -> DataFrame:
    """One row per rule: rule, action, passed, violations. One aggregate pass over ``df``."""
    checked = resolve(df, rule_set)
    counts = df.agg(*counters(checked))
    entries = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.action).alias("action"),
                (F.col("rows") - F.col(f"`{r.name}`")).alias("passed"),
                F.col(f"`{r.name}`").alias("violations"),
            )
            for r in checked
        ]
    )
    return counts.select(F.inline(entries))


def failed_rules(rule_list: Iterable[Rule]) -> Column:
    """Names of the rules a row violates."""
    names = F.array(*[F.when(r.violated, F.lit(r.name)) for r in rule_list]).cast("array<string>")
    return F.filter(names, lambda n: n.isNotNull())


def quarantine(df: DataFrame, rule_set: Iterable[Rule], column: str = FAILED_RULES) -> DataFrame:
    """The rows ``expect`` drops, each with the names of the drop rules it violates."""
    drops = [r for r in resolve(df, rule_set) if r.action == DROP]
    any_violated = reduce(lambda a, b: a | b, [r.violated for r in drops], F.lit(False))
    return df.filter(any_violated).withColumn(column, failed_rules(drops))
