"""Crash-shaped test tables derived from the driver's TPC-H-like tables.

The real crash CSVs are not available, so ``units``, ``persons`` and
``damages`` are projections of ``lineitem`` and ``orders``. Every column
rule is one SQL expression that runs unchanged on Spark and on DuckDB, so
the Spark jobs and the DuckDB oracle read exactly the same rows. Because
the tables are projections, Spark prunes them: a query that needs one crash
column reads only the lineitem columns behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixture column rules (name, SQL expression), in table order.
# ---------------------------------------------------------------------------
UNITS_RULES: list[tuple[str, str]] = [
    ("CRASH_ID", "l_orderkey"),
    ("UNIT_NBR", "l_linenumber"),
    ("VEH_BODY_STYL_ID",
     "CASE WHEN l_partkey % 20 = 0 THEN 'MOTORCYCLE' WHEN l_partkey % 20 = 1 THEN 'POLICE MOTORCYCLE' "
     "WHEN l_partkey % 20 = 2 THEN 'NA' WHEN l_partkey % 20 = 3 THEN 'UNKNOWN' WHEN l_partkey % 20 = 4 THEN NULL "
     "WHEN l_partkey % 20 = 5 THEN 'BUS' WHEN l_partkey % 20 < 11 THEN 'PASSENGER CAR, 4-DOOR' "
     "WHEN l_partkey % 20 < 15 THEN 'PICKUP' ELSE 'SPORT UTILITY VEHICLE' END"),
    ("VEH_MAKE_ID",
     "CASE WHEN (l_partkey + l_suppkey) % 37 = 0 THEN 'NA' WHEN (l_partkey + l_suppkey) % 37 = 1 THEN NULL "
     "WHEN (l_partkey + l_suppkey) % 37 < 12 THEN 'FORD' WHEN (l_partkey + l_suppkey) % 37 < 20 THEN 'CHEVROLET' "
     "WHEN (l_partkey + l_suppkey) % 37 < 26 THEN 'TOYOTA' WHEN (l_partkey + l_suppkey) % 37 < 30 THEN 'DODGE' "
     "WHEN (l_partkey + l_suppkey) % 37 < 33 THEN 'HONDA' WHEN (l_partkey + l_suppkey) % 37 < 35 THEN 'NISSAN' "
     "ELSE 'MAZDA' END"),
    ("VEH_COLOR_ID",
     "CASE WHEN l_suppkey % 16 = 0 THEN 'NA' WHEN l_suppkey % 16 = 1 THEN '99' WHEN l_suppkey % 16 = 2 THEN '98' "
     "WHEN l_suppkey % 16 = 3 THEN NULL ELSE concat('C', CAST((l_suppkey * l_partkey) % 16 AS STRING)) END"),
    ("VEH_LIC_STATE_ID",
     "CASE WHEN l_partkey % 40 = 0 THEN 'NA' WHEN l_partkey % 40 = 1 THEN '98' WHEN l_partkey % 40 = 2 THEN NULL "
     "ELSE concat('S', CAST((l_partkey * 3 + l_suppkey) % 33 AS STRING)) END"),
    ("VEH_HNR_FL",
     "CASE WHEN l_returnflag = 'R' THEN 'Y' WHEN l_returnflag = 'N' THEN 'N' ELSE NULL END"),
    ("CONTRIB_FACTR_1_ID",
     "CASE WHEN l_suppkey % 7 = 0 THEN 'FAILED TO CONTROL SPEED' WHEN l_suppkey % 7 = 1 THEN 'UNDER INFLUENCE - ALCOHOL' "
     "WHEN l_suppkey % 7 = 2 THEN NULL ELSE 'NONE' END"),
    ("CONTRIB_FACTR_2_ID",
     "CASE WHEN l_partkey % 11 = 0 THEN 'UNSAFE SPEED' WHEN l_partkey % 11 = 1 THEN 'HAD BEEN DRINKING' "
     "WHEN l_partkey % 11 = 2 THEN NULL ELSE 'NONE' END"),
    ("CONTRIB_FACTR_P1_ID",
     "CASE WHEN l_orderkey % 13 = 0 THEN 'SPEEDING - (OVERLIMIT)' WHEN l_orderkey % 13 = 1 THEN 'HAD BEEN DRINKING' "
     "ELSE NULL END"),
    ("VEH_DMAG_SCL_1_ID",
     "CASE WHEN l_partkey % 12 < 8 THEN concat('DAMAGED ', CAST(l_partkey % 12 AS STRING)) "
     "WHEN l_partkey % 12 = 8 THEN 'NO DAMAGE' WHEN l_partkey % 12 = 9 THEN 'NA' "
     "WHEN l_partkey % 12 = 10 THEN 'INVALID VALUE' ELSE NULL END"),
    ("VEH_DMAG_SCL_2_ID",
     "CASE WHEN l_suppkey % 10 < 6 THEN 'NA' WHEN l_suppkey % 10 < 9 THEN concat('DAMAGED ', CAST(l_suppkey % 8 AS STRING)) "
     "ELSE NULL END"),
    ("FIN_RESP_TYPE_ID",
     "CASE WHEN l_linestatus = 'O' THEN 'PROOF OF LIABILITY INSURANCE' WHEN l_returnflag = 'A' THEN NULL "
     "ELSE 'SURETY BOND' END"),
    ("DEATH_CNT",
     "CAST(CASE WHEN l_quantity >= 47 THEN 2 WHEN l_quantity >= 40 THEN 1 ELSE 0 END AS INTEGER)"),
    ("TOT_INJRY_CNT",
     "CAST(CASE WHEN l_partkey % 97 = 5 THEN NULL WHEN l_partkey % 500 = 7 AND l_quantity >= 30 "
     "THEN CAST(l_quantity AS INTEGER) - 20 ELSE l_linenumber END AS INTEGER)"),
]
UNITS_COPY_RULE = "l_partkey % 50 = 0"

PERSONS_RULES: list[tuple[str, str]] = [
    ("CRASH_ID", "l_orderkey"),
    ("UNIT_NBR", "l_linenumber"),
    ("PRSN_NBR", "CAST(l_suppkey % 3 + 1 AS INTEGER)"),
    ("PRSN_TYPE_ID",
     "CASE WHEN l_suppkey % 3 = 0 THEN 'DRIVER' WHEN l_suppkey % 3 = 1 THEN 'PASSENGER/OCCUPANT' "
     "ELSE 'DRIVER OF MOTORCYCLE TYPE VEHICLE' END"),
    ("PRSN_GNDR_ID",
     "CASE WHEN (l_suppkey + l_orderkey) % 9 < 5 THEN 'MALE' WHEN (l_suppkey + l_orderkey) % 9 < 7 THEN 'FEMALE' "
     "WHEN (l_suppkey + l_orderkey) % 9 = 7 THEN 'NA' ELSE NULL END"),
    ("PRSN_AIRBAG_ID",
     "CASE WHEN l_partkey % 8 < 3 THEN 'NOT DEPLOYED' WHEN l_partkey % 8 < 6 THEN 'DEPLOYED, FRONT' "
     "ELSE 'NOT APPLICABLE' END"),
    ("PRSN_INJRY_SEV_ID",
     "CASE WHEN l_quantity >= 45 THEN 'KILLED' WHEN l_quantity >= 25 THEN 'POSSIBLE INJURY' ELSE 'NOT INJURED' END"),
    ("PRSN_ETHNICITY_ID",
     "CASE WHEN l_partkey % 14 = 0 THEN 'NA' WHEN l_partkey % 14 = 1 THEN 'UNKNOWN' WHEN l_partkey % 14 = 2 THEN 'OTHER' "
     "WHEN l_partkey % 14 = 3 THEN NULL WHEN l_partkey % 20 = 5 THEN 'BLACK' WHEN l_partkey % 14 < 9 THEN 'WHITE' "
     "WHEN l_partkey % 14 < 12 THEN 'HISPANIC' ELSE 'BLACK' END"),
    ("DRVR_LIC_TYPE_ID",
     "CASE WHEN l_suppkey % 6 = 0 THEN 'DRIVER LICENSE' WHEN l_suppkey % 6 = 1 THEN 'COMMERCIAL DRIVER LIC.' "
     "WHEN l_suppkey % 6 = 2 THEN 'OCCUPATIONAL' WHEN l_suppkey % 6 = 3 THEN 'UNLICENSED' "
     "WHEN l_suppkey % 6 = 4 THEN 'ID CARD' ELSE NULL END"),
    ("DRVR_LIC_STATE_ID",
     "CASE WHEN l_partkey % 15 = 0 THEN 'NA' WHEN l_partkey % 15 = 1 THEN 'Unknown' WHEN l_partkey % 15 = 2 THEN 'Other' "
     "WHEN l_partkey % 15 = 3 THEN NULL WHEN l_partkey % 15 < 12 THEN 'Texas' ELSE 'Louisiana' END"),
    ("DRVR_ZIP",
     "CASE WHEN l_suppkey % 5 = 0 THEN NULL "
     "ELSE concat('0', CAST(7800 + (l_suppkey * l_suppkey + l_partkey) % 60 AS STRING)) END"),
    ("PRSN_ALC_RSLT_ID",
     "CASE WHEN (l_orderkey + l_partkey) % 10 = 0 THEN 'Positive' WHEN (l_orderkey + l_partkey) % 10 < 5 THEN 'NA' "
     "ELSE NULL END"),
    ("DEATH_CNT", "CAST(CASE WHEN l_quantity >= 45 THEN 1 ELSE 0 END AS INTEGER)"),
]
PERSONS_COPY_RULE = "l_partkey % 60 = 0"

DAMAGES_RULES: list[tuple[str, str]] = [
    ("CRASH_ID", "o_orderkey"),
    ("DAMAGED_PROPERTY",
     "CASE o_orderpriority WHEN '1-URGENT' THEN 'NONE' WHEN '2-HIGH' THEN 'NONE1' WHEN '3-MEDIUM' THEN 'FENCE' "
     "WHEN '4-NOT SPECIFIED' THEN 'GUARDRAIL' ELSE NULL END"),
]
DAMAGES_EXTRA_RULE = "o_orderkey % 10 = 0"
DAMAGES_EXTRA_VALUE = "NONE"


def _projected_with_copies(source: DataFrame, rules, copy_rule: str) -> DataFrame:
    """Project ``rules`` and emit a second, identical row where ``copy_rule``.

    One scan: each source row explodes into one or two copies instead of a
    UNION ALL that would read the source twice.
    """
    copies = F.expr(f"CASE WHEN {copy_rule} THEN 2 ELSE 1 END")
    exploded = source.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return exploded.selectExpr(*[f"{expr} AS {name}" for name, expr in rules])


def units_from(lineitem: DataFrame) -> DataFrame:
    return _projected_with_copies(lineitem, UNITS_RULES, UNITS_COPY_RULE)


def persons_from(lineitem: DataFrame) -> DataFrame:
    return _projected_with_copies(lineitem, PERSONS_RULES, PERSONS_COPY_RULE)


def damages_from(orders: DataFrame) -> DataFrame:
    """One damage row per order plus an extra ``NONE`` row on every 10th order."""
    base = F.expr(DAMAGES_RULES[1][1])
    values = F.when(F.expr(DAMAGES_EXTRA_RULE), F.array(base, F.lit(DAMAGES_EXTRA_VALUE))).otherwise(F.array(base))
    return orders.select(
        F.col("o_orderkey").alias("CRASH_ID"),
        F.explode(values).alias("DAMAGED_PROPERTY"),
    )


# --------------------------------------------------------------------------
# The same tables as SQL text for the DuckDB oracle (a WITH clause prefix).
# --------------------------------------------------------------------------
def _select_sql(rules, table: str, where: str | None = None) -> str:
    cols = ", ".join(f"{expr} AS {name}" for name, expr in rules)
    return f"SELECT {cols} FROM {table}" + (f" WHERE {where}" if where else "")


def fixture_cte_sql() -> str:
    """``WITH units AS (...), persons AS (...), damages AS (...)``."""
    units = f"{_select_sql(UNITS_RULES, 'lineitem')} UNION ALL {_select_sql(UNITS_RULES, 'lineitem', UNITS_COPY_RULE)}"
    persons = (f"{_select_sql(PERSONS_RULES, 'lineitem')} UNION ALL "
               f"{_select_sql(PERSONS_RULES, 'lineitem', PERSONS_COPY_RULE)}")
    damages = (f"{_select_sql(DAMAGES_RULES, 'orders')} UNION ALL "
               f"SELECT o_orderkey AS CRASH_ID, '{DAMAGES_EXTRA_VALUE}' AS DAMAGED_PROPERTY "
               f"FROM orders WHERE {DAMAGES_EXTRA_RULE}")
    return f"WITH units AS ({units}), persons AS ({persons}), damages AS ({damages})"


# Source columns that identify a row; hashing on all of them spreads rows
# evenly (only exact duplicate source rows would share a task).
LINEITEM_ROW_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
ORDERS_ROW_KEY = ["o_orderkey", "o_custkey"]

# Types of the source columns the fixture reads (the driver's tables).
LINEITEM_COLUMNS = ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                    "l_quantity DOUBLE, l_returnflag STRING, l_linestatus STRING")
ORDERS_COLUMNS = "o_orderkey BIGINT, o_custkey BIGINT, o_orderpriority STRING"
ROWS_PER_TASK = 1 << 20  # source rows of a partition that `spread_to` deals out, about; what a task holds of them does not follow the input


def _in_even_splits(df: DataFrame, tasks: int) -> bool:
    """Whether ``tasks`` tasks share the rows of a source as it is split: none has more than two even shares (counted from the footers)."""
    splits = df.groupBy(F.spark_partition_id().alias("split")).agg(F.count(F.lit(1)).alias("n"))
    largest, rows = splits.agg(F.max("n"), F.sum("n")).first()
    return bool(rows) and largest * tasks <= 2 * rows and (tasks == 1 or largest < rows)


def load_fixture(spark: SparkSession, sf_dir: str, spread_to: int | None = None, streamed: bool = False):
    """The three crash tables for one scale-factor folder of the test data.

    The sources are read with their known column types, so no footer-reading
    job runs to infer a schema, and only the columns the rules use are read.
    ``spread_to`` hash-partitions the sources on their row keys first: for the
    test folders, whose files are single row groups and so single splits. It
    gives the least number of partitions: more rows than ``ROWS_PER_TASK`` for
    each make more of them (the rows are counted from the files' footers). The
    hash includes columns the crash tables do not expose, so downstream plans
    keep their own exchanges. ``streamed`` is for rows that are only written, one
    by one: their number in a task costs no memory, so a source that is
    split evenly enough for ``spread_to`` tasks is not shuffled. Nothing is cached.
    """
    from crashlens.sources.catalog import CrashTables

    lineitem = spark.read.schema(LINEITEM_COLUMNS).parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.schema(ORDERS_COLUMNS).parquet(f"{sf_dir}/orders.parquet")
    if spread_to:
        def dealt(df: DataFrame, key: list[str]) -> DataFrame:
            if streamed and _in_even_splits(df, spread_to):
                return df
            return df.repartition(max(spread_to, -(-df.count() // ROWS_PER_TASK)), *key)

        lineitem, orders = dealt(lineitem, LINEITEM_ROW_KEY), dealt(orders, ORDERS_ROW_KEY)
    return CrashTables(person=persons_from(lineitem), units=units_from(lineitem), damages=damages_from(orders))
