"""Declarative standardization rules, each compiled to a single expression.

A rule is data (an ordered list of cases).  Compiling it yields one SQL
``CASE WHEN`` text, turned into a Column with a single ``F.expr`` call: the
whole rule crosses from Python to the JVM once (instead of one call per
``when``/``lit``/function node), and the result is an ordinary Catalyst
expression that stays inside whole-stage codegen.

Semantics: first matching case wins; a NULL condition never matches; an
absent default yields NULL.  Rule inputs are column names.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


# ---------------------------------------------------------------- SQL text helpers
def ident(name: str) -> str:
    """A column name as a quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def sql_lit(v: Any) -> str:
    """A Python value as a SQL literal."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def case_sql(cases: Iterable[tuple[str, Any]], default: Any = None) -> str:
    """``CASE WHEN c1 THEN v1 ... [ELSE default] END`` from (condition SQL, value) pairs."""
    parts = [f"WHEN {cond} THEN {sql_lit(value)}" for cond, value in cases]
    if not parts:
        return sql_lit(default)
    tail = f" ELSE {sql_lit(default)}" if default is not None else ""
    return "CASE " + " ".join(parts) + tail + " END"


def upper_sql(x: str) -> str:
    return f"trim(upper({x}))"


def title_sql(x: str) -> str:
    return f"trim(initcap({x}))"


# ---------------------------------------------------------------- Column helpers
def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_title(c: str) -> Column:
    """``trim(initcap(c))``: words split on spaces only."""
    return F.expr(title_sql(ident(c)))


# ---------------------------------------------------------------- rule kinds
@dataclass(frozen=True)
class Membership:
    """label <- key in {values}; compared after ``normalize``."""

    groups: Sequence[tuple[str, Sequence[str]]]
    default: Any = None
    normalize: str = "upper"  # "upper" | "title" | "none"

    def key_sql(self, x: str) -> str:
        return {"upper": upper_sql, "title": title_sql}.get(self.normalize, lambda v: v)(x)

    def sql(self, x: str) -> str:
        k = self.key_sql(x)
        return case_sql(
            ((f"{k} IN ({', '.join(sql_lit(v) for v in vals)})", label) for label, vals in self.groups), self.default
        )

    def apply(self, c: str) -> Column:
        return F.expr(self.sql(ident(c)))


@dataclass(frozen=True)
class Substring:
    """label <- normalized text contains needle; rules are tried in order."""

    needles: Sequence[tuple[str, str]]
    default: Any = None

    def sql(self, x: str) -> str:
        k = upper_sql(x)
        return case_sql(((f"contains({k}, {sql_lit(n)})", label) for n, label in self.needles), self.default)

    def apply(self, c: str) -> Column:
        return F.expr(self.sql(ident(c)))


@dataclass(frozen=True)
class Flag:
    """YES/NO standardizer: ``YES -> yes``, ``NO -> no``, anything else (NULL too) -> default."""

    default: str
    yes: str = "Yes"
    no: str = "No"

    def sql(self, x: str) -> str:
        return Membership(((self.yes, ("YES",)), (self.no, ("NO",))), self.default).sql(x)

    def apply(self, c: str) -> Column:
        return F.expr(self.sql(ident(c)))


@dataclass(frozen=True)
class Ranges:
    """Numeric bucketing.  Each case is ``(low, high, label)`` with ``low`` inclusive,
    ``high`` exclusive and ``None`` meaning unbounded; first match wins, so cases may
    overlap (descending thresholds).  NULL input falls through to ``default``."""

    cases: Sequence[tuple[float | None, float | None, str]]
    default: Any = None

    def sql(self, x: str) -> str:
        compiled = []
        for low, high, label in self.cases:
            terms = ([f"{x} >= {sql_lit(low)}"] if low is not None else []) + (
                [f"{x} < {sql_lit(high)}"] if high is not None else []
            )
            compiled.append((" AND ".join(terms) or f"{x} IS NOT NULL", label))
        return case_sql(compiled, self.default)

    def apply(self, c: str) -> Column:
        return F.expr(self.sql(ident(c)))


@dataclass(frozen=True)
class Rule:
    """An arbitrary ordered case list (condition SQL, value) over several columns."""

    cases: Sequence[tuple[str, Any]] = field(default_factory=tuple)
    default: Any = None

    def sql(self) -> str:
        return case_sql(self.cases, self.default)

    def apply(self) -> Column:
        return F.expr(self.sql())


def indicator_sum_sql(cols: Iterable[str], value: str = "Yes") -> str:
    terms = [f"CASE WHEN {ident(c)} = {sql_lit(value)} THEN 1 ELSE 0 END" for c in cols]
    return f"CAST({' + '.join(terms) or '0'} AS INT)"


def indicator_sum(cols: Iterable[str], value: str = "Yes") -> Column:
    """Number of columns equal to ``value`` (NULL counts as not equal), as INT."""
    return F.expr(indicator_sum_sql(cols, value))
