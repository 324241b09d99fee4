"""Row rules and column repairs.

Every rule is a null-safe predicate: a comparison with a missing value is
false, so ``drop_*`` keeps such rows and ``keep_*`` drops them, exactly as a
boolean mask over a pandas frame behaves.  All rules are row-local: no shuffle.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import (all_of, any_of, nan_to_null, null_count_expr,
                               round_half_even, truthy)


def drop_where(df: DataFrame, pred: Column) -> DataFrame:
    """Drop rows where ``pred`` is true; NULL counts as false (row kept)."""
    return df.where(~truthy(pred))


def keep_where(df: DataFrame, pred: Column) -> DataFrame:
    """Keep rows where ``pred`` is true; NULL counts as false (row dropped)."""
    return df.where(truthy(pred))


def non_positive(cols: Sequence[str]) -> Column:
    return any_of([F.col(c) <= 0 for c in cols])


def drop_non_positive(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """B1: drop a row when any of ``cols`` is <= 0."""
    return drop_where(df, non_positive(cols))


def label_reason_contradiction(label: str, ok_value: str, reason: str,
                               none_token: str = "None") -> Column:
    """B2: a passed part that still carries a failure reason."""
    return (F.col(label) == ok_value) & F.col(reason).isNotNull() & (F.col(reason) != none_token)


def order_contradiction(first: str, second: str) -> Column:
    """``first >= second`` (e.g. injection time not shorter than the cycle)."""
    return F.col(first) >= F.col(second)


def drop_contradiction(df: DataFrame, pred: Column) -> DataFrame:
    return drop_where(df, pred)


def out_of_limits(limits: Mapping[str, tuple[float, float]]) -> Column:
    return any_of([(F.col(c) < lo) | (F.col(c) > hi) for c, (lo, hi) in limits.items()])


def drop_out_of_limits(df: DataFrame, limits: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Drop when a value lies outside [lo, hi]; the limits themselves are kept."""
    return drop_where(df, out_of_limits(limits))


def in_range(limits: Mapping[str, tuple[float, float]]) -> Column:
    return all_of([F.col(c).between(lo, hi) for c, (lo, hi) in limits.items()])


def keep_in_range(df: DataFrame, limits: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Keep only rows inside every closed range (a NULL fails)."""
    return keep_where(df, in_range(limits))


def missing_any(cols: Sequence[str]) -> Column:
    return any_of([F.col(c).isNull() for c in cols])


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in ``cols`` (all columns when omitted)."""
    return df.na.drop(how="any", subset=list(cols) if cols else None)


def row_missing_rate(cols: Sequence[str]) -> Column:
    return null_count_expr(cols).cast("double") / F.lit(float(len(cols)))


def drop_sparse_rows(df: DataFrame, cols: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """Drop rows whose share of NULL sensors is strictly above ``threshold``."""
    return df.where(~(row_missing_rate(cols) > threshold))


def keep_label_domain(df: DataFrame, col: str, domain: Sequence) -> DataFrame:
    """Keep rows whose label is in ``domain``; NULL is invalid."""
    return df.where(truthy(F.col(col).isin(list(domain))))


def feature_columns(df: DataFrame, target: str, leakage: Sequence[str] = (),
                    ids: Sequence[str] = ()) -> list[str]:
    """Feature list without the target, leakage columns and identifiers."""
    drop = {target, *leakage, *ids}
    return [c for c in df.columns if c not in drop]


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    """Constant column (machine id, source label)."""
    return df.withColumn(name, F.lit(value))


def align_features(df: DataFrame, cols: Sequence[str], fill=0) -> DataFrame:
    """Select ``cols`` in order; absent columns become ``fill``."""
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(fill).alias(c) for c in cols])


def round_columns(df: DataFrame, cols: Sequence[str], digits: int = 2) -> DataFrame:
    """Round half to even on the scaled value."""
    return df.withColumns({c: round_half_even(c, digits) for c in cols})


def label_by_rule(df: DataFrame, pred: Column, name: str = "status_label") -> DataFrame:
    """1 where the rule holds, else 0 (NULL comparisons count as false)."""
    return df.withColumn(name, F.when(truthy(pred), F.lit(1)).otherwise(F.lit(0)))


def clip_columns(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Clip each column to [lo, hi]; NULL stays NULL."""
    return df.withColumns({
        c: F.when(F.col(c).isNull(), F.col(c)).otherwise(F.least(F.greatest(F.col(c), F.lit(lo)), F.lit(hi)))
        for c, (lo, hi) in bounds.items()})


def is_infinite(c: str) -> Column:
    return F.abs(F.col(c)) == F.lit(float("inf"))


def replace_infinite(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """B16 (first half): +-Inf becomes NULL; impute afterwards."""
    return df.withColumns({c: F.when(~truthy(is_infinite(c)), F.col(c)) for c in cols})


def fill_values(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """Broadcast a per-column statistic to every row (NULL -> value)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if v is not None})


def impute_median(df: DataFrame, cols: Sequence[str], medians: Mapping[str, float] | None = None) -> DataFrame:
    """NULL -> exact column median (NULLs ignored in the median)."""
    if medians is None:
        from ..functions.quantiles import quantile_wide
        q = quantile_wide(df, cols, [0.5])
        medians = {c: q[c].get(0.5) for c in cols}
    return fill_values(df, medians)


def na_normalise(df: DataFrame, tokens: Sequence[str] | None = None,
                 cols: Sequence[str] | None = None) -> DataFrame:
    """A2: NaN -> NULL in float columns, missing tokens -> NULL in strings."""
    from ..functions.exprs import MISSING_TOKENS
    tokens = list(tokens if tokens is not None else MISSING_TOKENS)
    wanted = set(cols) if cols else None
    repl = {}
    for f in df.schema.fields:
        if wanted is not None and f.name not in wanted:
            continue
        t = f.dataType.typeName()
        if t in ("double", "float"):
            repl[f.name] = nan_to_null(f.name)
        elif t == "string":
            repl[f.name] = F.when(~truthy(F.col(f.name).isin(tokens)), F.col(f.name))
    return df.withColumns(repl) if repl else df
