"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.session import ensure_checkpoint_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage,
    so that later jobs neither recompute it nor depend on one executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def text_of(df: DataFrame, text: str = "text") -> Column:
    """The text column with NULL read as the empty string."""
    return F.coalesce(df[text], F.lit(""))


def crc_mod(col: Column, mod: int) -> Column:
    """crc32 of the value as text, modulo ``mod`` (0 for a NULL value)."""
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % mod, F.lit(0))


def task_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


HOT_ROWS, HOT_KEYS = 100_000, 1_000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` left-joined with the one row that ``groups`` has of each key; the
    column ``size`` of ``groups`` is how many rows join that key.

    A key is hot when it joins more than HOT_ROWS rows and more than the HOT_KEYS-th
    part of all.  So at most HOT_KEYS keys are hot, which are broadcast; their rows,
    and those with a NULL key, are dealt by row, the others go through one shuffle
    by key.  Give rows that can have no match a NULL key."""
    names = [c for c in groups.columns if c not in (key, size)]
    groups = cut(groups)
    total = groups.agg(F.sum(size)).first()[0] or 0
    least = max(HOT_ROWS, total // HOT_KEYS)
    k, v, s, w, by = fresh(rows, "_hot_key", "_hot_value", "_key", "_value", "_by")
    value = F.struct(F.lit(True).alias("known"), *names)
    hot = groups.where(F.col(size) > least).select(F.col(key).alias(k), value.alias(v))
    cold = groups.where(F.col(size) <= least).select(F.col(key).alias(s), F.lit(0).cast("long").alias(w + "salt"), value.alias(w))
    found = rows.join(F.broadcast(hot), rows[key] == F.col(k), "left").withColumn(by, F.when(F.col(k).isNotNull() | rows[key].isNull(), F.monotonically_increasing_id() + 1).otherwise(0))
    found = found.join(cold, (found[key] == cold[s]) & (found[by] == cold[w + "salt"]), "left")
    return found.select(*rows.columns, *[F.coalesce(F.col(f"{v}.{c}"), F.col(f"{w}.{c}")).alias(c) for c in names])


def remove_rows(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows whose (id, content) isn't in ``gone`` (doc_id, content), all
    columns as they were; the content is the xxhash64 of the text."""
    d, c = fresh(docs, "_gone_id", "_gone_content")
    other = gone.select(F.col("doc_id").alias(d), F.col("content").alias(c))
    return docs.join(other, (F.xxhash64(text_of(docs, text)) == other[c]) & docs[id_col].eqNullSafe(other[d]), "left_anti")
