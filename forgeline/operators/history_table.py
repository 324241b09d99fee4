"""A history table under retention, compacted partition by partition (I4).

Rows stand in date partitions; a manifest names, per date, the version whose files hold
it.  Adding rows applies the retention to the keys that the new rows touch, finds the
dates that gain or lose rows, and writes only those dates anew, as a new version; all
other dates keep their files.  The manifest of a version is written last, by a single
committed job, and readers follow the newest manifest: they see the table before or
after an addition, never between.  A failed addition leaves files that no manifest
names, and may be repeated."""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.joins import join_on_keys
from .history import retain


class HistoryTable:
    """The newest ``n`` rows of every key that are within ``age`` of its newest one.
    ``tiebreak`` tells rows of one key and time apart; a repeated row counts once."""

    def __init__(self, spark: SparkSession, path: str, key: str, ts: str, n: int, age: str, tiebreak: str, date: str = "date"):
        self.spark, self.path, self.date = spark, path.rstrip("/"), date
        self.key, self.ts, self.tiebreak = key, ts, tiebreak
        self.identity = [key, ts, tiebreak]
        self.retain: Callable[[DataFrame], DataFrame] = lambda df: retain(df, key, ts, n, age, tiebreak=tiebreak)

    def manifest(self) -> tuple[int, dict[str, str]]:
        """Number of the newest version (0: none), and {date: folder} (a row per date)."""
        try:
            told = self.spark.read.schema(f"version long, {self.date} string, folder string").parquet(f"{self.path}/manifest/*")
            rows = told.where(F.col("version") == told.agg(F.max("version")).first()[0]).collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, {}
        return rows[0]["version"], {r[self.date]: r["folder"] for r in rows if r["folder"] is not None}

    def _files(self, dates: dict[str, str], schema) -> DataFrame:
        if not dates:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{folder}/{self.date}={d}" for d, folder in dates.items()])

    def read(self) -> DataFrame:
        _, dates = self.manifest()
        if not dates:
            raise ValueError("the table has no rows")
        return self.spark.read.parquet(*[f"{self.path}/data/{folder}/{self.date}={d}" for d, folder in dates.items()])

    def add(self, rows: DataFrame) -> list[str]:
        """Adds rows, applies the retention, and returns the dates written anew."""
        version, dates = self.manifest()
        day = F.date_format(F.col(self.ts), "yyyy-MM-dd")
        schema = rows.schema
        old = self._files(dates, schema)
        touched_keys = rows.select(self.key).distinct().withColumn("_hit", F.lit(True))
        mine = join_on_keys(old, touched_keys, [self.key]).drop("_hit")
        kept = self.retain(mine.unionByName(rows).dropDuplicates(self.identity)).checkpoint()
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in self.identity]
        minus = lambda a, b: a.alias("a").join(b.alias("b"), same[0] & same[1] & same[2], "left_anti")
        lost = minus(mine, kept).select(*self.identity).checkpoint()
        gained = minus(kept, mine)
        changed = sorted(r[0] for r in lost.select(day).union(gained.select(day)).distinct().collect())  # at most a row per date
        if not changed:
            return []
        keep_old = minus(self._files({d: f for d, f in dates.items() if d in set(changed)}, schema), lost)
        folder = f"v{version + 1}-{uuid.uuid4().hex[:8]}"
        now = keep_old.unionByName(gained).withColumn(self.date, day)
        now.repartition(self.date).write.partitionBy(self.date).parquet(f"{self.path}/data/{folder}")
        left = {r[0] for r in self.spark.read.parquet(f"{self.path}/data/{folder}").select(F.col(self.date).cast("string")).distinct().collect()} if not now.isEmpty() else set()
        told = {d: f for d, f in dates.items() if d not in set(changed)} | {d: folder for d in left}
        listed = [(version + 1, d, f) for d, f in told.items()] or [(version + 1, None, None)]
        self.spark.createDataFrame(listed, f"version long, {self.date} string, folder string").coalesce(1).write.parquet(f"{self.path}/manifest/{folder}")
        return changed


__all__ = ["HistoryTable"]
