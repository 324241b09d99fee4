"""Deterministically dirtied views of the driver tables.

The generated tables hold no faults (no NULLs, no duplicates), so each
workload reads a view that injects them from id arithmetic over the *whole*
table: every row is read and kept; ids only decide which cell is faulted.
Each view exists twice with identical meaning: as DataFrame code (what the
queries run) and as a SQL CTE (what the DuckDB oracle runs).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAN = float("nan")
INF = float("inf")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- sensor feed
def sensor_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry feed from ``events``: machine = user, temperature = value/10,
    pressure = user/100.  Faults: NULL temperature (id % 20 = 5), NaN
    temperature (id % 40 = 7), pressure 999.9 (id % 30 = 10), and a second
    reading of the same (machine, ts) one step later in ``seq`` with
    temperature + 1 (id % 50 = 15)."""
    return sensor_feed(table(spark, sf_dir, "events"))


def sensor_feed(events: DataFrame) -> DataFrame:
    """The sensor mapping of ``sensor_raw`` over any events frame (batch or
    streaming): a self-union, so it also runs on a ``readStream`` source."""
    ev = events.select("event_id", "ts", "user_id", "value")
    eid = F.col("event_id")
    base = ev.select(
        "event_id", "ts", F.col("user_id").alias("machine_id"),
        F.when(eid % 20 == 5, F.lit(None).cast("double"))
         .when(eid % 40 == 7, F.lit(NAN))
         .otherwise(F.col("value") / F.lit(10.0)).alias("temperature"),
        F.when(eid % 30 == 10, F.lit(999.9))
         .otherwise(F.col("user_id").cast("double") / F.lit(100.0)).alias("pressure"))
    first = base.select((eid * 2).alias("seq"), "machine_id", "ts", "temperature", "pressure")
    again = base.where(eid % 50 == 15).select(
        (eid * 2 + 1).alias("seq"), "machine_id", "ts",
        (F.col("temperature") + F.lit(1.0)).alias("temperature"), "pressure")
    return first.unionByName(again)


SENSOR_RAW_SQL = """
sensor_base AS (
  SELECT event_id, ts, user_id AS machine_id,
         CASE WHEN event_id % 20 = 5 THEN NULL
              WHEN event_id % 40 = 7 THEN CAST('NaN' AS DOUBLE)
              ELSE value / CAST(10.0 AS DOUBLE) END AS temperature,
         CASE WHEN event_id % 30 = 10 THEN CAST(999.9 AS DOUBLE)
              ELSE CAST(user_id AS DOUBLE) / CAST(100.0 AS DOUBLE) END AS pressure
  FROM events),
sensor_raw AS (
  SELECT event_id * 2 AS seq, machine_id, ts, temperature, pressure FROM sensor_base
  UNION ALL
  SELECT event_id * 2 + 1 AS seq, machine_id, ts, temperature + CAST(1.0 AS DOUBLE) AS temperature, pressure
  FROM sensor_base WHERE event_id % 50 = 15),
sensor_norm AS (
  SELECT seq, machine_id, ts,
         CASE WHEN isnan(temperature) THEN NULL ELSE temperature END AS temperature,
         CASE WHEN isnan(pressure) THEN NULL ELSE pressure END AS pressure
  FROM sensor_raw)"""

SENSOR_CLEAN_SQL = SENSOR_RAW_SQL + """,
sensor_dedup AS (
  SELECT * FROM sensor_norm
  QUALIFY row_number() OVER (PARTITION BY machine_id, ts ORDER BY seq) = 1),
sensor_kept AS (
  SELECT seq, machine_id, ts,
         round_even(temperature * CAST(100 AS DOUBLE), 0) / CAST(100 AS DOUBLE) AS temperature,
         round_even(pressure * CAST(100 AS DOUBLE), 0) / CAST(100 AS DOUBLE) AS pressure
  FROM sensor_dedup
  WHERE seq IS NOT NULL AND machine_id IS NOT NULL AND ts IS NOT NULL
    AND temperature IS NOT NULL AND pressure IS NOT NULL
    AND temperature BETWEEN 0 AND 100 AND pressure BETWEEN 0 AND 5),
sensor_clean AS (
  SELECT seq, machine_id, ts, temperature, pressure,
         CASE WHEN temperature >= 28.0 OR pressure >= 1.4 THEN 1 ELSE 0 END AS status_label
  FROM sensor_kept)"""


# ------------------------------------------------------- injection cycles
def cycles_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moulding cycles from ``lineitem``: key (ts=shipdate, equip=suppkey,
    part=partkey); injection_time = qty/10, cycle_time = price/10000,
    barrel_temperature = 200 + tax*1000, pass_or_fail / reason from the
    return flag.  Faults are injected from orderkey/linenumber arithmetic."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    base = li.select(
        (ok * 8 + ln).alias("cycle_id"),
        F.col("l_shipdate").alias("ts"), F.col("l_suppkey").alias("equip_cd"),
        F.col("l_partkey").alias("part_name"),
        F.when(ok % 41 == 7, -F.col("l_quantity") / F.lit(10.0))
         .otherwise(F.col("l_quantity") / F.lit(10.0)).alias("injection_time"),
        F.when(ok % 43 == 8, F.lit(0.0))
         .otherwise(F.col("l_extendedprice") / F.lit(10000.0)).alias("cycle_time"),
        F.when(ok % 31 == 2, F.lit(None).cast("double"))
         .when(ok % 37 == 11, F.lit(20.0))
         .when(ok % 47 == 13, F.lit(450.0))
         .when(ok % 53 == 17, F.lit(50.0))
         .when(ok % 59 == 19, F.lit(400.0))
         .otherwise(F.lit(200.0) + F.col("l_tax") * F.lit(1000.0)).alias("barrel_temperature"),
        F.when(ok % 89 == 1, F.lit(None).cast("string"))
         .when(F.col("l_returnflag") == "R", F.lit("N")).otherwise(F.lit("Y")).alias("pass_or_fail"),
        F.when(F.col("l_returnflag") == "R", F.lit("short shot"))
         .when(ok % 7 == 0, F.lit("None"))
         .when(ok % 61 == 5, F.lit("flash")).alias("reason"))
    again = base.where(F.col("cycle_id") % 97 == 3).withColumn("cycle_id", -F.col("cycle_id"))
    return base.unionByName(again)


CYCLES_RAW_SQL = """
cycles_base AS (
  SELECT l_orderkey * 8 + l_linenumber AS cycle_id,
         l_shipdate AS ts, l_suppkey AS equip_cd, l_partkey AS part_name,
         CASE WHEN l_orderkey % 41 = 7 THEN -l_quantity / CAST(10.0 AS DOUBLE)
              ELSE l_quantity / CAST(10.0 AS DOUBLE) END AS injection_time,
         CASE WHEN l_orderkey % 43 = 8 THEN CAST(0.0 AS DOUBLE)
              ELSE l_extendedprice / CAST(10000.0 AS DOUBLE) END AS cycle_time,
         CASE WHEN l_orderkey % 31 = 2 THEN NULL
              WHEN l_orderkey % 37 = 11 THEN CAST(20.0 AS DOUBLE)
              WHEN l_orderkey % 47 = 13 THEN CAST(450.0 AS DOUBLE)
              WHEN l_orderkey % 53 = 17 THEN CAST(50.0 AS DOUBLE)
              WHEN l_orderkey % 59 = 19 THEN CAST(400.0 AS DOUBLE)
              ELSE CAST(200.0 AS DOUBLE) + l_tax * CAST(1000.0 AS DOUBLE) END AS barrel_temperature,
         CASE WHEN l_orderkey % 89 = 1 THEN NULL
              WHEN l_returnflag = 'R' THEN 'N' ELSE 'Y' END AS pass_or_fail,
         CASE WHEN l_returnflag = 'R' THEN 'short shot'
              WHEN l_orderkey % 7 = 0 THEN 'None'
              WHEN l_orderkey % 61 = 5 THEN 'flash' END AS reason
  FROM lineitem),
cycles_raw AS (
  SELECT * FROM cycles_base
  UNION ALL
  SELECT -cycle_id AS cycle_id, ts, equip_cd, part_name, injection_time, cycle_time,
         barrel_temperature, pass_or_fail, reason
  FROM cycles_base WHERE cycle_id % 97 = 3)"""


# ------------------------------------------------------------ wide sensors
WIDE_SENSORS = ["s_qty", "s_price", "s_disc", "s_tax", "s_sparse", "s_const", "s_mix"]


def wide_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide sensor table from ``lineitem`` (one row per line):
    s_qty, s_price, s_disc, s_tax with NULL / +-Inf faults, s_sparse (NULL
    in most rows), s_const (one value), s_mix (sparse rows fault many
    sensors at once), label in {-1, 1} from the line status with invalid
    values (0 and NULL), and an exact sensor copy under another id.
    (row_id, part, supp) is unique: row_id alone repeats in the data."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_linestatus")
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    rid = ok * 8 + ln
    sparse_row = ok % 67 == 3
    nul = F.lit(None).cast("double")
    base = li.select(
        rid.alias("row_id"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"),
        F.when(sparse_row | (ok % 23 == 4), nul).otherwise(F.col("l_quantity")).alias("s_qty"),
        F.when(sparse_row, nul).when(ok % 71 == 9, F.lit(INF))
         .otherwise(F.col("l_extendedprice")).alias("s_price"),
        F.when(sparse_row, nul).when(ok % 73 == 10, F.lit(-INF))
         .otherwise(F.col("l_discount")).alias("s_disc"),
        F.when(sparse_row, nul).when(ok % 29 == 6, F.lit(5.0))
         .otherwise(F.col("l_tax")).alias("s_tax"),
        F.when(ok % 5 < 3, nul).otherwise(F.col("l_quantity") * F.lit(2.0)).alias("s_sparse"),
        F.lit(7.5).alias("s_const"),
        F.when(sparse_row, nul).otherwise(F.col("l_extendedprice") / F.col("l_quantity")).alias("s_mix"),
        F.when(ok % 79 == 2, F.lit(0)).when(ok % 83 == 5, F.lit(None).cast("int"))
         .when(F.col("l_linestatus") == "F", F.lit(1)).otherwise(F.lit(-1)).alias("label"))
    again = base.where(F.col("row_id") % 101 == 7).withColumn("row_id", -F.col("row_id"))
    return base.unionByName(again)


WIDE_RAW_SQL = """
wide_base AS (
  SELECT l_orderkey * 8 + l_linenumber AS row_id, l_partkey AS part, l_suppkey AS supp,
         CASE WHEN l_orderkey % 67 = 3 OR l_orderkey % 23 = 4 THEN NULL ELSE l_quantity END AS s_qty,
         CASE WHEN l_orderkey % 67 = 3 THEN NULL WHEN l_orderkey % 71 = 9 THEN CAST('Infinity' AS DOUBLE)
              ELSE l_extendedprice END AS s_price,
         CASE WHEN l_orderkey % 67 = 3 THEN NULL WHEN l_orderkey % 73 = 10 THEN CAST('-Infinity' AS DOUBLE)
              ELSE l_discount END AS s_disc,
         CASE WHEN l_orderkey % 67 = 3 THEN NULL WHEN l_orderkey % 29 = 6 THEN CAST(5.0 AS DOUBLE)
              ELSE l_tax END AS s_tax,
         CASE WHEN l_orderkey % 5 < 3 THEN NULL ELSE l_quantity * CAST(2.0 AS DOUBLE) END AS s_sparse,
         CAST(7.5 AS DOUBLE) AS s_const,
         CASE WHEN l_orderkey % 67 = 3 THEN NULL ELSE l_extendedprice / l_quantity END AS s_mix,
         CASE WHEN l_orderkey % 79 = 2 THEN 0 WHEN l_orderkey % 83 = 5 THEN NULL
              WHEN l_linestatus = 'F' THEN 1 ELSE -1 END AS label
  FROM lineitem),
wide_raw AS (
  SELECT * FROM wide_base
  UNION ALL
  SELECT -row_id AS row_id, part, supp, s_qty, s_price, s_disc, s_tax, s_sparse, s_const, s_mix, label
  FROM wide_base WHERE row_id % 101 = 7)"""


WIDE_COLUMNS = 512  # of the derived wide view: eight columns from each of 64 dimensions


def wide_column(j: int, at: str) -> str:
    """Column j of the wide view as an expression over ``at`` (dimension -> SQL)."""
    a, b = at.format(j % 64), at.format((j * 5 + 3) % 64)
    return (a, f"{a} * {a}", f"{a} * {b}", f"{a} + {b}", f"{a} - 3 * {b}", f"1000 + {a}", f"abs({a})", f"{a} * {a} * {a}")[j // 64]


def sensor_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sensor table of WIDE_COLUMNS columns c0.. from ``embeddings``, with sparse and
    constant columns, sparse rows, missing cells, infinities, outliers, exact copies
    under the negative id and invalid labels.

    A row becomes some sixteen times as wide here, so the vectors, of which a file split
    holds very many, are dealt over all tasks first."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    emb = emb.select("vec_id", F.col("embedding").cast("array<double>").alias("x"), "label")
    rows = emb.select(F.explode(F.expr("IF(vec_id % 101 = 7, array(vec_id, -vec_id), array(vec_id))")).alias("row_id"), "vec_id", "x",
                      F.expr(SENSOR_LABEL).alias("label"))
    return rows.select("row_id", *[F.expr(_sensor_cell(j, wide_column(j, "x[{}]"))).alias(f"c{j}") for j in range(WIDE_COLUMNS)], "label")


SENSOR_LABEL = "CASE WHEN vec_id % 79 = 2 THEN 0 WHEN vec_id % 83 = 5 THEN NULL WHEN label % 2 = 0 THEN 1 ELSE -1 END"


def _sensor_cell(j: object, value: str) -> str:
    """The cell of column ``j`` (a number, or the name of SQL's column of it)."""
    inf = "CAST('Infinity' AS DOUBLE)"
    return (f"CASE WHEN {j} % 41 = 7 THEN CAST(7.5 AS DOUBLE) WHEN {j} % 37 = 5 AND vec_id % 5 < 3 OR vec_id % 67 = 3 AND {j} % 10 <> 0 OR (vec_id + {j}) % 29 = 0 THEN NULL "
            f"WHEN (vec_id * 3 + {j}) % 997 = 1 THEN {inf} WHEN (vec_id * 3 + {j}) % 997 = 2 THEN -{inf} "
            f"WHEN (vec_id + {j} * 7) % 211 = 3 THEN 10000 + {value} ELSE {value} END")


_SENSOR_VALUES = "[" + ", ".join(wide_column(j, "x[{}+1]") for j in range(WIDE_COLUMNS)) + "]"
SENSOR_ARRAY_SQL = f"""
sa_x AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x, {SENSOR_LABEL} AS label FROM embeddings),
sa_r AS (SELECT vec_id, vec_id AS row_id, x, label FROM sa_x UNION ALL SELECT vec_id, -vec_id, x, label FROM sa_x WHERE vec_id % 101 = 7),
sa_v AS (SELECT vec_id, row_id, label, unnest({_SENSOR_VALUES}) AS value, unnest(range({WIDE_COLUMNS})) AS j FROM sa_r),
sensor_array AS (SELECT row_id, label, j, {_sensor_cell("j", "value")} AS v FROM sa_v)"""


# ------------------------------------------------------------- scored labels
def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation input: ``labels`` joined to ``documents``; y = quality,
    score = n_chars / (n_chars + 1000) (a monotone map of the length into
    [0, 1))."""
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"))
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return (lab.join(doc, "doc_id")
            .select("doc_id", "y", (F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0))).alias("score")))


SCORED_SQL = """
scored AS (
  SELECT l.doc_id, l.quality AS y,
         d.n_chars / (d.n_chars + CAST(1000.0 AS DOUBLE)) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def with_sql(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes)
