"""Column-expression helpers shared by the operators.

All of these build JVM-side expressions, so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source semantics: missing-value tokens a
# CSV reader treats as NULL, and the MDQI grade ladder (lower bound, grade).
MISSING_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN",
                  "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
                  "NaN", "None", "n/a", "nan", "null"]
GRADE_LADDER = [(99.0, "S"), (95.0, "A"), (80.0, "B")]  # same ladder as plans.fixed.GRADES
GRADE_FLOOR = "C"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truthy(pred: Column) -> Column:
    """Two-valued predicate: a comparison with a missing value is false."""
    return F.coalesce(pred, F.lit(False))


def nan_to_null(c: str | Column) -> Column:
    """NaN is a missing value, as in a pandas column."""
    c = col_of(c)
    return F.when(~F.isnan(c), c)


def round_half_even(c: str | Column, digits: int = 2) -> Column:
    """Round the scaled binary value half to even (numpy ``around``)."""
    scale = float(10 ** digits)
    return F.rint(col_of(c) * F.lit(scale)) / F.lit(scale)


def safe_div(num: Column, den: Column) -> Column:
    """num / den, 0 when den is 0 (zero-division -> 0 convention)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den)


def qi(n: Column, e: Column) -> Column:
    """Quality indicator (N - E) / N * 100, 0 when N is 0."""
    return F.when(n > 0, (n - e).cast("double") / n * F.lit(100.0)).otherwise(F.lit(0.0))


def grade(score: Column) -> Column:
    out = None
    for lower, g in GRADE_LADDER:
        out = F.when(score >= lower, F.lit(g)) if out is None else out.when(score >= lower, F.lit(g))
    return out.otherwise(F.lit(GRADE_FLOOR))


def null_count_expr(cols: Iterable[str]) -> Column:
    """Number of NULL cells among ``cols`` in one row (row-local, no shuffle).
    One array expression, so its size is linear in the columns."""
    flags = [F.col(c).isNull() for c in cols]
    return F.size(F.filter(F.array(*flags), lambda x: x)) if flags else F.lit(0)


def any_of(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    out = preds[0]
    for p in preds[1:]:
        out = out | p
    return out


def all_of(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


def sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))


def softplus(c: Column) -> Column:
    """log(1 + exp(z)) computed without overflow."""
    return F.greatest(c, F.lit(0.0)) + F.log1p(F.exp(-F.abs(c)))
