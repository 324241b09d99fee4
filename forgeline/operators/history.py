"""Value history and change detection over telemetry (I1-I6, batch side).

Per-key ordering never puts a whole key in one task: top-k per key runs in
two stages over hash-salted sub-keys (each keeps at most k rows), and the
previous reading of a row is found by an equi-join on (key, ordinal - 1)
whose keys are unique, so a hot machine spreads over all tasks.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import join_on_keys
from ..functions.ordinals import with_ordinal


def top_k_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                  salts: int = 64, name: str | None = None) -> DataFrame:
    """Rows ranked 1..k per key in ``order`` (which must be a total order).

    Stage 1 ranks inside (key, salt) groups -- a hot key is split ``salts``
    ways -- and keeps k rows per group; stage 2 ranks the <= k * salts
    survivors of each key."""
    keys = list(keys)
    salt = F.pmod(F.xxhash64(*[o for o in df.columns]), F.lit(salts))
    s1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    stage1 = df.withColumn("_salt", salt).withColumn("_r1", F.row_number().over(s1)).where(F.col("_r1") <= k)
    s2 = Window.partitionBy(*keys).orderBy(*order)
    out = stage1.withColumn("_rk", F.row_number().over(s2)).where(F.col("_rk") <= k).drop("_salt", "_r1")
    return out.withColumnRenamed("_rk", name) if name else out.drop("_rk")


def value_changes(df: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """Rows whose value differs (NULL-aware) from the previous reading of
    the same key; the first reading of a key counts as a change.  Adds
    ``prev_value``."""
    od = with_ordinal(df, [key], order, "_ord")
    prev = od.select(F.col(key).alias("_pk"), (F.col("_ord") + 1).alias("_pord"), F.col(value).alias("prev_value"))
    joined = od.join(prev, F.col(key).eqNullSafe(F.col("_pk")) & (F.col("_ord") == F.col("_pord")), "left")
    changed = (F.col("_pord").isNull()) | ~(F.col(value).eqNullSafe(F.col("prev_value")))
    return joined.where(changed).drop("_pk", "_pord", "_ord")


def alarms(df: DataFrame, value: str, limit: float, key: str, template: str) -> DataFrame:
    """Rows above ``limit`` with a message ``format_string(template, key, value)``."""
    return (df.where(F.col(value) > limit)
            .withColumn("message", F.format_string(template, F.col(key), F.col(value))))


def read_history(df: DataFrame, key: str, ts: str, start, end, n: int, tiebreak: str | None = None,
                 date_col: str | None = None) -> DataFrame:
    """A node's raw values in [start, end], the oldest ``n`` per key.

    On a history table partitioned by date, pass ``date_col``: the implied
    date range is added so only the matching partitions are read."""
    rng = df.where(F.col(ts).between(F.lit(start), F.lit(end)))
    if date_col:
        rng = rng.where(F.col(date_col).between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    order = [F.col(ts).asc()] + ([F.col(tiebreak).asc()] if tiebreak else [])
    return top_k_per_key(rng, [key], order, n)


def retain(df: DataFrame, key: str, ts: str, n: int, age: str, tiebreak: str | None = None) -> DataFrame:
    """I4: keep the newest ``n`` values of each key that are also within
    ``age`` (an interval literal such as '1 day') of the key's newest value."""
    newest = df.groupBy(key).agg(F.max(ts).alias("_newest"))  # one row per key
    order = [F.col(ts).desc()] + ([F.col(tiebreak).desc()] if tiebreak else [])
    top = top_k_per_key(df, [key], order, n)
    return (join_on_keys(top, newest, [key])
            .where(F.col(ts) >= F.col("_newest") - F.expr(f"INTERVAL {age}")).drop("_newest"))


def compact_history(df: DataFrame, key: str, ts: str, n: int, age: str, path: str,
                    tiebreak: str | None = None) -> None:
    """I4 as a job: apply the retention and rewrite the history table
    partitioned by date (the output path must differ from the input's)."""
    kept = retain(df, key, ts, n, age, tiebreak).withColumn("date", F.to_date(F.col(ts)))
    kept.write.mode("overwrite").partitionBy("date").parquet(path)


def to_local(df: DataFrame, ts: str, tz: str, name: str = "ts_local", clock: str = "clock") -> DataFrame:
    """UTC wall time -> local wall time in ``tz`` and its HH:mm:ss text
    (``convert_timezone`` on timestamp_ntz: no session-zone dependence)."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col(ts))
    return df.withColumn(name, local).withColumn(clock, F.date_format(F.col(name), "HH:mm:ss"))


def latest_values(df: DataFrame, key: str, ts: str, value: str, tiebreak: str | None = None) -> DataFrame:
    """The newest reading per key by ``max_by`` (partial aggregation;
    a hot key is reduced map-side)."""
    order = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)
    return df.groupBy(key).agg(F.max_by(value, order).alias(value), F.max(ts).alias(ts))
