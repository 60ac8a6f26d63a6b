"""The check object shared by all table checks.

A check knows how to produce its *failing rows* (zero rows = pass) and a
*failures* measure over them.  Checks whose failures are a plain aggregate over
one table also expose that aggregate (``fused``), so the runner can compute
many of them in a single scan."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_COND = re.compile(r"^\s*(>=|<=|!=|==|=|>|<)\s*(-?\d+(?:\.\d+)?)\s*$")


def threshold(expr: str) -> Callable[[Column], Column]:
    """Parse a threshold such as '!=0', '>10', '<1' into a predicate on a Column."""
    m = _COND.match(expr)
    if not m:
        raise ValueError(f"bad threshold {expr!r}; expected e.g. '!=0', '>10'")
    op, num = m.group(1), float(m.group(2))
    ops = {">=": Column.__ge__, "<=": Column.__le__, "!=": Column.__ne__, "==": Column.__eq__,
           "=": Column.__eq__, ">": Column.__gt__, "<": Column.__lt__}
    return lambda c: ops[op](c, F.lit(num))


@dataclass
class Check:
    """A table assertion.

    ``rows`` builds the failing-rows DataFrame.  ``measure`` turns failing rows
    into the failures number (default: their count).  ``fused`` — when set — is
    an aggregate Column over ``source`` giving the same number, so that the
    runner can fuse it with other checks on the same table."""

    name: str
    relation: str
    rows: Callable[[], DataFrame]
    source: DataFrame | None = None
    fused: Column | None = None
    measure: Callable[[DataFrame], Column] | None = None
    warn_if: str = "!=0"
    error_if: str = "!=0"
    severity: str = "error"
    meta: dict = field(default_factory=dict)
    #: What the check needs to know of a part of the table, and how two parts combine:
    #: name -> (aggregate over the rows, 'sum' / 'min' / 'max'); ``verdict`` gives the
    #: failures from the combined values.
    state: dict[str, tuple[Column, str]] | None = None
    verdict: Callable[[Callable[[str], Column]], Column] | None = None
    #: Checks on values: (text of a row's value, NULL for none; whether a value with so
    #: many rows fails).  Parts combine by adding the rows of each value.
    keyed: tuple[Column, Callable[[Column], Column]] | None = None

    def __post_init__(self):
        if self.state is None and self.keyed is None and self.fused is not None:
            self.state, self.verdict = {"n": (self.fused, "sum")}, lambda s: s("n")

    def failing_rows(self) -> DataFrame:
        return self.rows()

    def failures(self) -> DataFrame:
        """One row, one column ``failures`` (bigint)."""
        rows = self.rows()
        m = self.measure(rows) if self.measure else F.count(F.lit(1))
        return rows.agg(F.coalesce(m.cast("bigint"), F.lit(0).cast("bigint")).alias("failures"))

    def store_failures(self, path: str, mode: str = "overwrite") -> None:
        """Keep the failing rows as a Parquet table for later inspection."""
        self.rows().write.mode(mode).parquet(path)

    def configured(self, warn_if: str | None = None, error_if: str | None = None,
                   severity: str | None = None,
                   measure: Callable[[DataFrame], Column] | None = None) -> Check:
        """Thresholds ('!=0', '>10', …), severity ('error' / 'warn') and a
        custom failures measure over the failing rows (which disables fusion)."""
        if measure is not None:
            self.measure = measure
            self.fused = self.state = self.keyed = None
        if warn_if is not None:
            self.warn_if = warn_if
        if error_if is not None:
            self.error_if = error_if
        if severity is not None:
            if severity not in ("error", "warn"):
                raise ValueError("severity must be 'error' or 'warn'")
            self.severity = severity
        return self

    def status(self, failures: Column) -> Column:
        """'fail' / 'warn' / 'pass' from the thresholds and severity."""
        err = threshold(self.error_if)(failures)
        warn = threshold(self.warn_if)(failures)
        if self.severity == "warn":
            return F.when(err | warn, F.lit("warn")).otherwise(F.lit("pass"))
        return F.when(err, F.lit("fail")).when(warn, F.lit("warn")).otherwise(F.lit("pass"))


def filtered(df: DataFrame, where) -> DataFrame:
    return df if where is None else df.where(where)


def where_col(where) -> Column:
    if where is None:
        return F.lit(True)
    return F.expr(where) if isinstance(where, str) else where


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
