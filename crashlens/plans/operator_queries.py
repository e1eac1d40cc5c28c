"""One query per generic operator, on the driver's native tables or the fixture.

These show each operator is generic (not tied to the crash columns) and
give every operator its own oracle check. Each takes ``(spark, sf_dir)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlens.functions import any_of, first_digits, first_int, not_in
from crashlens.operators import (
    Tag,
    best_k,
    count_distinct_per,
    count_groups_having,
    dense_rank_all,
    distinct_projection,
    global_count,
    having_match,
    in_top_k,
    join_count,
    join_renaming,
    lacking_match,
    number_per_group,
    ordered,
    rank_band,
    rank_band_wide,
    tagged_aggregates,
    top_k,
    top_per_group,
)
from crashlens.plans.analyses import FACTOR_COLUMNS
from crashlens.sources.fixture import load_fixture


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Fixed values used by the operator queries.
SEGMENTS = ["BUILDING", "MACHINERY"]


def op_project(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"))


def op_with_column(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber").withColumn("twice", F.col("l_linenumber") + F.col("l_linenumber"))


def op_drop(spark, sf_dir):
    return _t(spark, sf_dir, "nation").drop("n_regionkey")


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def op_filter_eq(spark, sf_dir):
    return _t(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").select(*_ORDER_COLS)


def op_filter_ne(spark, sf_dir):
    return _t(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "F").select(*_ORDER_COLS)


def op_filter_gt(spark, sf_dir):
    return _t(spark, sf_dir, "part").filter(F.col("p_size") > 40).select("p_partkey", "p_size")


def op_filter_in(spark, sf_dir):
    return _t(spark, sf_dir, "customer").filter(F.col("c_mktsegment").isin(SEGMENTS)).select("c_custkey", "c_mktsegment")


def op_filter_not_in(spark, sf_dir):
    return _t(spark, sf_dir, "customer").filter(not_in("c_mktsegment", SEGMENTS)).select("c_custkey", "c_mktsegment")


def op_filter_like(spark, sf_dir):
    return _t(spark, sf_dir, "orders").filter(F.col("o_orderpriority").like("%HIGH%")).select(
        "o_orderkey", "o_orderpriority")


def op_filter_not_null(spark, sf_dir):
    units = load_fixture(spark, sf_dir).units
    return units.filter(F.col("VEH_MAKE_ID").isNotNull()).select("CRASH_ID", "UNIT_NBR", "VEH_MAKE_ID")


def op_filter_bool(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    cond = ((F.col("l_returnflag") == "R") | (F.col("l_returnflag") == "A")) & ~(F.col("l_linestatus") == "F")
    return li.filter(cond).select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")


def op_filter_then_project(spark, sf_dir):
    return _t(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey")


def op_select_then_filter(spark, sf_dir):
    """The filter comes after the projection that drops its column."""
    orders = _t(spark, sf_dir, "orders")
    return orders.select("o_orderkey", "o_custkey").filter(orders.o_orderpriority == "1-URGENT")


def op_having(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    sums = li.groupBy("l_orderkey").agg(F.sum("l_linenumber").alias("sum_line"))
    return sums.filter(F.col("sum_line") > 20)


def op_having_count(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return count_groups_having(li, ["l_orderkey"], F.sum("l_linenumber"), lambda s: s > 20)


def op_in_top_k(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    top = top_k(li, "l_suppkey", 3)
    return in_top_k(li, "l_suppkey", top).select("l_orderkey", "l_linenumber", "l_suppkey")


def op_any_column(spark, sf_dir):
    units = load_fixture(spark, sf_dir).units
    return units.filter(any_of(FACTOR_COLUMNS, lambda c: c.like("%SPEED%"))).select("CRASH_ID", "UNIT_NBR", *FACTOR_COLUMNS)


def op_join_one_key(spark, sf_dir):
    region = _t(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return _t(spark, sf_dir, "nation").join(region, "n_regionkey", "inner").select(
        "n_nationkey", "n_name", "n_regionkey", "r_name")


def op_join_two_keys(spark, sf_dir):
    t = load_fixture(spark, sf_dir)
    return join_count(t.units, t.person, ["CRASH_ID", "UNIT_NBR"], by_left=["VEH_MAKE_ID"])


def op_join_broadcast(spark, sf_dir):
    """A small side that Spark broadcasts by its own size threshold."""
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "inner").select("c_custkey", "n_name")


def op_join_name_clash(spark, sf_dir):
    t = load_fixture(spark, sf_dir)
    units = t.units.select("CRASH_ID", "UNIT_NBR", "VEH_MAKE_ID", "DEATH_CNT")
    people = t.person.select("CRASH_ID", "UNIT_NBR", "PRSN_TYPE_ID", "DEATH_CNT")
    return join_renaming(units, people, ["CRASH_ID", "UNIT_NBR"], "_U", "_P")


def op_semi_join(spark, sf_dir):
    customer = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return having_match(customer, orders, ["c_custkey"])


def op_anti_join(spark, sf_dir):
    customer = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return lacking_match(customer, orders, ["c_custkey"])


def op_anti_join_urgent(spark, sf_dir):
    """Customers without any 1-URGENT order (non-empty on the test data)."""
    customer = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    urgent = _t(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("c_custkey"))
    return lacking_match(customer, urgent, ["c_custkey"])


def op_group_count(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


def op_group_count_two(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


def op_group_sum(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.sum("l_linenumber").alias("sum_line"))


def op_count_nonnull(spark, sf_dir):
    units = load_fixture(spark, sf_dir).units
    return units.groupBy("VEH_BODY_STYL_ID").agg(F.count("VEH_MAKE_ID").alias("n"))


def op_count_distinct(spark, sf_dir):
    return count_distinct_per(_t(spark, sf_dir, "lineitem"), ["l_suppkey"], ["l_orderkey"])


def op_global_count(spark, sf_dir):
    return global_count(_t(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "P"))


def op_distinct(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct()


def op_distinct_keys(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").select("l_orderkey").distinct()


def op_distinct_projection(spark, sf_dir):
    """Body styles of the distinct whole vehicle rows, counted; the rows are told apart by fingerprints."""
    units = load_fixture(spark, sf_dir).units
    return distinct_projection(units, ["VEH_BODY_STYL_ID"]).groupBy("VEH_BODY_STYL_ID").agg(F.count(F.lit(1)).alias("n"))


def op_tagged_aggregates(spark, sf_dir):
    """Three aggregates of ``lineitem`` from one pass."""
    tags = [
        Tag("returned", F.col("l_returnflag") == "R", ["l_suppkey"], "l_linenumber"),
        Tag("by_flag", F.col("l_linestatus") == "F", ["l_returnflag"]),
        Tag("late", F.col("l_linenumber") > 5, (), "l_linenumber"),
    ]
    return tagged_aggregates(_t(spark, sf_dir, "lineitem"), tags)


def op_dense_rank(spark, sf_dir):
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_size")
    return dense_rank_all(spark, part, "p_size", descending=True, rank_name="rnk")


def _status_counts(spark, sf_dir):
    return _t(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def op_row_number(spark, sf_dir):
    return number_per_group(_status_counts(spark, sf_dir), "o_orderpriority", ordered("n", ["o_orderstatus"]), "rn")


def op_top_per_group(spark, sf_dir):
    return top_per_group(_status_counts(spark, sf_dir), "o_orderpriority", ordered("n", ["o_orderstatus"]))


def op_rank_band(spark, sf_dir):
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_size")
    return rank_band(part, "p_size", 3, 5, rank_name="rnk")


def op_rank_band_wide(spark, sf_dir):
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_size")
    return rank_band_wide(spark, part, "p_size", 3, 40)


def op_sort_desc(spark, sf_dir):
    supplier = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return supplier.orderBy(F.col("s_acctbal").desc_nulls_last(), F.col("s_suppkey").asc_nulls_last())


def op_top_k(spark, sf_dir):
    return top_k(_t(spark, sf_dir, "part"), "p_brand", 5)


def op_best_k(spark, sf_dir):
    supplier = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return best_k(supplier, "s_acctbal", "s_suppkey", 10)


def op_regexp_number(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", first_digits("p_brand").alias("brand_digits"))


def op_try_cast(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    return part.select(
        "p_partkey",
        first_digits("p_brand").try_cast("int").alias("brand_number"),
        F.col("p_type").try_cast("int").alias("type_number"),
    )


def op_case_when(spark, sf_dir):
    units = load_fixture(spark, sf_dir).units
    return units.select("CRASH_ID", "UNIT_NBR", "VEH_DMAG_SCL_1_ID", first_int("VEH_DMAG_SCL_1_ID").alias("dmg_1"))


OPERATOR_QUERIES = {name: fn for name, fn in globals().items() if name.startswith("op_") and callable(fn)}

OPERATOR_SQL: dict[str, str] = {
    "op_project": "SELECT p_partkey, p_brand AS brand FROM part",
    "op_with_column": "SELECT l_orderkey, l_linenumber, l_linenumber + l_linenumber AS twice FROM lineitem",
    "op_drop": "SELECT n_nationkey, n_name FROM nation",
    "op_filter_eq": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders "
                    "WHERE o_orderstatus = 'F'",
    "op_filter_ne": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders "
                    "WHERE o_orderstatus <> 'F'",
    "op_filter_gt": "SELECT p_partkey, p_size FROM part WHERE p_size > 40",
    "op_filter_in": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
    "op_filter_not_in": "SELECT c_custkey, c_mktsegment FROM customer "
                        "WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')",
    "op_filter_like": "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority LIKE '%HIGH%'",
    "op_filter_not_null": "@fixture SELECT CRASH_ID, UNIT_NBR, VEH_MAKE_ID FROM units WHERE VEH_MAKE_ID IS NOT NULL",
    "op_filter_bool": "SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem "
                      "WHERE (l_returnflag = 'R' OR l_returnflag = 'A') AND NOT (l_linestatus = 'F')",
    "op_filter_then_project": "SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'",
    "op_select_then_filter": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'",
    "op_having": "SELECT l_orderkey, CAST(sum(l_linenumber) AS BIGINT) AS sum_line FROM lineitem "
                 "GROUP BY l_orderkey HAVING sum(l_linenumber) > 20",
    "op_having_count": "SELECT count(*) AS n FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey "
                       "HAVING sum(l_linenumber) > 20) g",
    "op_in_top_k": "SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey IN "
                   "(SELECT l_suppkey FROM lineitem GROUP BY l_suppkey "
                   "ORDER BY count(*) DESC, l_suppkey ASC NULLS LAST LIMIT 3)",
    "op_any_column": "@fixture SELECT CRASH_ID, UNIT_NBR, CONTRIB_FACTR_1_ID, CONTRIB_FACTR_2_ID, CONTRIB_FACTR_P1_ID "
                     "FROM units WHERE CONTRIB_FACTR_1_ID LIKE '%SPEED%' OR CONTRIB_FACTR_2_ID LIKE '%SPEED%' "
                     "OR CONTRIB_FACTR_P1_ID LIKE '%SPEED%'",
    "op_join_one_key": "SELECT n.n_nationkey, n.n_name, n.n_regionkey, r.r_name FROM nation n "
                       "JOIN region r ON n.n_regionkey = r.r_regionkey",
    "op_join_two_keys": "@fixture SELECT u.VEH_MAKE_ID, count(*) AS n FROM units u JOIN persons p "
                        "ON u.CRASH_ID = p.CRASH_ID AND u.UNIT_NBR = p.UNIT_NBR GROUP BY u.VEH_MAKE_ID",
    "op_join_broadcast": "SELECT c.c_custkey, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey",
    "op_join_name_clash": "@fixture SELECT u.CRASH_ID, u.UNIT_NBR, u.VEH_MAKE_ID, u.DEATH_CNT AS DEATH_CNT_U, "
                          "p.PRSN_TYPE_ID, p.DEATH_CNT AS DEATH_CNT_P FROM units u JOIN persons p "
                          "ON u.CRASH_ID = p.CRASH_ID AND u.UNIT_NBR = p.UNIT_NBR",
    "op_semi_join": "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)",
    "op_anti_join": "SELECT c_custkey, c_name FROM customer c "
                    "WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)",
    "op_anti_join_urgent": "SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o "
                           "WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')",
    "op_group_count": "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag",
    "op_group_count_two": "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem "
                          "GROUP BY l_returnflag, l_linestatus",
    "op_group_sum": "SELECT l_suppkey, CAST(sum(l_linenumber) AS BIGINT) AS sum_line FROM lineitem GROUP BY l_suppkey",
    "op_count_nonnull": "@fixture SELECT VEH_BODY_STYL_ID, count(VEH_MAKE_ID) AS n FROM units GROUP BY VEH_BODY_STYL_ID",
    "op_count_distinct": "SELECT l_suppkey, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY l_suppkey",
    "op_global_count": "SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'P'",
    "op_distinct": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
    "op_distinct_keys": "SELECT DISTINCT l_orderkey FROM lineitem",
    "op_tagged_aggregates": """
        SELECT 'returned' AS tag, l_suppkey, NULL::VARCHAR AS l_returnflag, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS total
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_suppkey
        UNION ALL SELECT 'by_flag', NULL, l_returnflag, count(*), NULL FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_returnflag
        UNION ALL SELECT 'late', NULL, NULL, count(*), CAST(sum(l_linenumber) AS BIGINT) FROM lineitem WHERE l_linenumber > 5""",
    "op_distinct_projection": "@fixture SELECT VEH_BODY_STYL_ID, count(*) AS n FROM (SELECT DISTINCT * FROM units) u GROUP BY 1",
    "op_dense_rank": "SELECT p_partkey, p_size, CAST(dense_rank() OVER (ORDER BY p_size DESC NULLS LAST) AS INTEGER) "
                     "AS rnk FROM part",
    "op_row_number": "SELECT o_orderpriority, o_orderstatus, n, CAST(row_number() OVER (PARTITION BY o_orderpriority "
                     "ORDER BY n DESC, o_orderstatus ASC NULLS LAST) AS INTEGER) AS rn FROM "
                     "(SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2) g",
    "op_top_per_group": "SELECT o_orderpriority, o_orderstatus, n FROM (SELECT *, row_number() OVER "
                        "(PARTITION BY o_orderpriority ORDER BY n DESC, o_orderstatus ASC NULLS LAST) AS rn FROM "
                        "(SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2) g) r "
                        "WHERE rn = 1",
    "op_rank_band": "SELECT p_partkey, p_size, rnk FROM (SELECT p_partkey, p_size, CAST(dense_rank() OVER "
                    "(ORDER BY p_size DESC NULLS LAST) AS INTEGER) AS rnk FROM part) r WHERE rnk BETWEEN 3 AND 5",
    "op_rank_band_wide": "SELECT p_partkey, p_size, rnk FROM (SELECT p_partkey, p_size, CAST(dense_rank() OVER "
                         "(ORDER BY p_size DESC NULLS LAST) AS INTEGER) AS rnk FROM part) r WHERE rnk BETWEEN 3 AND 40",
    "op_sort_desc": "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC NULLS LAST, s_suppkey",
    "op_top_k": "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand "
                "ORDER BY n DESC, p_brand ASC NULLS LAST LIMIT 5",
    "op_best_k": "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC NULLS LAST, "
                 "s_suppkey ASC NULLS LAST LIMIT 10",
    "op_regexp_number": "SELECT p_partkey, regexp_extract(p_brand, '([0-9]+)', 1) AS brand_digits FROM part",
    "op_try_cast": "SELECT p_partkey, TRY_CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS brand_number, "
                   "TRY_CAST(p_type AS INTEGER) AS type_number FROM part",
    "op_case_when": "@fixture SELECT CRASH_ID, UNIT_NBR, VEH_DMAG_SCL_1_ID, "
                    "(CASE WHEN regexp_extract(VEH_DMAG_SCL_1_ID, '([0-9]+)', 1) = '' THEN 0 "
                    "ELSE TRY_CAST(regexp_extract(VEH_DMAG_SCL_1_ID, '([0-9]+)', 1) AS INTEGER) END) AS dmg_1 "
                    "FROM units",
}
