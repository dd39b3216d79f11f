"""Corrections held as data.

A `Fix` describes what happens to one column: the first matching `Case` wins,
and rows without one go through the steps in order. All fixes of a table read
the uncorrected row, so a case may look at any column.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from skyledger.functions.text import blank_to_null
from skyledger.operators.lookups import rebalanced


@dataclass(frozen=True)
class Case:
    """`when`: column -> accepted values; `like`: column -> regular expression.

    `strip` removes trailing characters before the values are compared.
    """

    then: str | None
    when: dict[str, tuple[str, ...]] | None = None
    like: dict[str, str] | None = None
    strip: str = ""

    def condition(self) -> Column:
        def read(name: str) -> Column:
            return F.rtrim(F.col(name), F.lit(self.strip)) if self.strip else F.col(name)

        tests = [read(name).isin(*values) for name, values in (self.when or {}).items()]
        tests += [read(name).rlike(pattern) for name, pattern in (self.like or {}).items()]
        return reduce(lambda a, b: a & b, tests)

    def covers(self, later: Case) -> bool:
        """Whether every row that `later` accepts is accepted here, told from the data of the two."""
        when, like = later.when or {}, later.like or {}
        wider = all(column in when and set(when[column]) <= set(values) for column, values in (self.when or {}).items())
        return self.strip == later.strip and wider and all(like.get(column) == pattern for column, pattern in (self.like or {}).items())


@dataclass(frozen=True)
class Strip:
    """Remove all trailing characters found in `chars`."""

    chars: str = "?"

    def apply(self, c: Column) -> Column:
        return F.rtrim(c, F.lit(self.chars))


@dataclass(frozen=True)
class Replace:
    """Replace text wherever it occurs, also inside words."""

    old: str
    new: str = ""

    def apply(self, c: Column) -> Column:
        return F.replace(c, F.lit(self.old), F.lit(self.new))


@dataclass(frozen=True)
class Regex:
    """Replace what a regular expression matches, optionally only in values that
    are LIKE a cheaper pattern."""

    pattern: str
    new: str = ""
    like: str | None = None

    def apply(self, c: Column) -> Column:
        replaced = F.regexp_replace(c, self.pattern, self.new)
        return F.when(c.like(self.like), replaced).otherwise(c) if self.like else replaced


Step = Strip | Replace | Regex


@dataclass(frozen=True)
class Fix:
    column: str
    cases: tuple[Case, ...] = ()
    steps: tuple[Step, ...] = ()

    def expression(self) -> Column:
        fallback = apply_steps(F.col(self.column), self.steps)
        if not self.cases:
            return fallback
        first, *rest = self.cases
        chain = F.when(first.condition(), F.lit(first.then))
        for case in rest:
            chain = chain.when(case.condition(), F.lit(case.then))
        return chain.otherwise(fallback)

    def effects(self) -> list[Column]:
        """Of each case, then each step, whether it decides the row: the first case that matches, or a step that changes its input."""
        taken, found, value = F.lit(False), [], F.col(self.column)
        for case in self.cases:
            matches = F.coalesce(case.condition(), F.lit(False))
            found.append(~taken & matches)
            taken = taken | matches
        for step in self.steps:
            after = step.apply(value)
            found.append(~taken & ~after.eqNullSafe(value))
            value = after
        return found

    def covered(self) -> list[int]:
        """Numbers, from 1, of the cases that no row can reach, because one earlier case accepts all of theirs."""
        return [i + 1 for i, case in enumerate(self.cases) if any(earlier.covers(case) for earlier in self.cases[:i])]


def apply_steps(c: Column, steps: Iterable[Step]) -> Column:
    """Run steps one after the other; a value with nothing left is null."""
    fixed = reduce(lambda value, step: step.apply(value), steps, c)
    return blank_to_null(fixed) if steps else fixed


def correct(df: DataFrame, fixes: Iterable[Fix]) -> DataFrame:
    """One projection for all fixes of a table."""
    expressions = {fix.column: fix.expression() for fix in fixes}
    return df.withColumns(expressions) if expressions else df


@dataclass(frozen=True)
class Audit:
    """What the rules of one correcting pass did; read it after an action on the corrected rows."""

    fixes: tuple[Fix, ...]
    seen: Observation

    def hits(self) -> list[tuple[str, int, str, int, bool]]:
        """(column, number of the rule, ``case`` or ``step``, rows it decided, whether an earlier case covers it), rules never hit too.

        A step counts each row that it changes; a case, the rows it is the first to match.
        """
        got, rows = self.seen.get, []
        for f, fix in enumerate(self.fixes):
            covered = fix.covered()
            for i in range(1, len(fix.cases) + len(fix.steps) + 1):
                kind = "case" if i <= len(fix.cases) else "step"
                rows.append((fix.column, i, kind, int(got.get(f"f{f}_{i}") or 0), i in covered))
        return rows


def correct_audited(df: DataFrame, fixes: Iterable[Fix]) -> tuple[DataFrame, Audit]:
    """``correct``, with the hits of every rule observed in the same pass: no other scan, no shuffle."""
    fixes = tuple(fixes)
    figures = [F.count_if(effect).alias(f"f{f}_{i}") for f, fix in enumerate(fixes) for i, effect in enumerate(fix.effects(), 1)]
    seen = Observation()
    return correct(df.observe(seen, F.count(F.lit(1)).alias("rows"), *figures), fixes), Audit(fixes, seen)


def exact(column: str, values: dict[str, str | None]) -> Fix:
    """First-match value mapping."""
    return Fix(column, cases=tuple(Case(new, when={column: (old,)}) for old, new in values.items()))


def correct_from_table(df: DataFrame, rules: DataFrame, column: str, match: str, replacement: str, order: str) -> DataFrame:
    """First-match value mapping by a rules table of any size.

    The rules are reduced to one per value before the left join, so no row can
    multiply, and rebalanced: adaptive execution then broadcasts them if small, or
    splits skewed values of the other side if not.
    """
    first = rebalanced(
        rules.groupBy(F.col(match).alias("__match")).agg(
            F.min_by(F.struct(F.col(replacement).alias("value")), F.col(order)).alias("__rule")
        )
    )
    joined = df.join(first, F.col(column) == F.col("__match"), "left")
    fixed = F.when(F.col("__rule").isNotNull(), F.col("__rule.value")).otherwise(F.col(column))
    return joined.withColumn(column, fixed).select(*df.columns)
