"""DuckDB oracle SQL, one text per registered query.

The oracle is written the *direct* way (join, then whole-row DISTINCT,
then filter; a rank window over all rows; top-k sets as IN subqueries),
so it checks the rewritten Spark plans rather than repeating them. Crash
queries start with the fixture's WITH clause; the driver's tables
(lineitem, orders, ...) are views in the DuckDB session.
"""

from __future__ import annotations

from crashlens.sources.fixture import fixture_cte_sql

FIX = fixture_cte_sql()


def _crash(body: str) -> str:
    """Fixture CTEs followed by ``body`` (more CTEs starting with ',' or a SELECT)."""
    return f"{FIX} {body}"


LIC = "('COMMERCIAL DRIVER LIC.', 'OCCUPATIONAL', 'DRIVER LICENSE')"
ALC = "('UNDER INFLUENCE - ALCOHOL', 'HAD BEEN DRINKING')"
BAD_SCL = "('INVALID VALUE', 'NA', 'NO DAMAGE')"


def _num(col: str) -> str:
    ext = f"regexp_extract({col}, '([0-9]+)', 1)"
    return f"(CASE WHEN {ext} = '' THEN 0 ELSE TRY_CAST({ext} AS INTEGER) END)"


KILLERS = ("SELECT * FROM persons WHERE PRSN_TYPE_ID = 'DRIVER' AND PRSN_AIRBAG_ID = 'NOT DEPLOYED' "
           "AND (PRSN_INJRY_SEV_ID = 'KILLED' OR DEATH_CNT <> 0)")

# Distinct joined vehicle-person rows; the person DEATH_CNT is kept apart.
JOINED = (", j AS (SELECT DISTINCT u.*, p.* EXCLUDE (CRASH_ID, UNIT_NBR, DEATH_CNT), p.DEATH_CNT AS P_DEATH_CNT "
          "FROM units u JOIN persons p ON u.CRASH_ID = p.CRASH_ID AND u.UNIT_NBR = p.UNIT_NBR)")

ALCOHOL_FILTER = (f"(PRSN_ALC_RSLT_ID IN ('Positive') OR CONTRIB_FACTR_1_ID IN {ALC} OR CONTRIB_FACTR_2_ID IN {ALC} "
                  f"OR CONTRIB_FACTR_P1_ID IN {ALC}) AND DRVR_ZIP IS NOT NULL")

SEVERE = (f"SELECT DISTINCT CRASH_ID FROM units WHERE (VEH_DMAG_SCL_1_ID NOT IN {BAD_SCL} "
          f"OR VEH_DMAG_SCL_2_ID NOT IN {BAD_SCL}) AND FIN_RESP_TYPE_ID LIKE '%INSURANCE%' "
          f"AND ({_num('VEH_DMAG_SCL_1_ID')} > 4 OR {_num('VEH_DMAG_SCL_2_ID')} > 4)")

NONE_DAMAGE = "SELECT DISTINCT * FROM damages WHERE DAMAGED_PROPERTY LIKE '%NONE%'"

SPEEDING = (
    ", colours AS (SELECT VEH_COLOR_ID FROM units WHERE VEH_COLOR_ID NOT IN ('NA', '99', '98') "
    "GROUP BY VEH_COLOR_ID ORDER BY count(*) DESC, VEH_COLOR_ID ASC NULLS LAST LIMIT 10)"
    ", states AS (SELECT VEH_LIC_STATE_ID FROM units WHERE VEH_LIC_STATE_ID NOT IN ('NA', '98') "
    "GROUP BY VEH_LIC_STATE_ID ORDER BY count(*) DESC, VEH_LIC_STATE_ID ASC NULLS LAST LIMIT 25)"
    ", su AS (SELECT * FROM units WHERE (CONTRIB_FACTR_1_ID LIKE '%SPEED%' OR CONTRIB_FACTR_2_ID LIKE '%SPEED%' "
    "OR CONTRIB_FACTR_P1_ID LIKE '%SPEED%') AND VEH_LIC_STATE_ID IN (SELECT VEH_LIC_STATE_ID FROM states) "
    "AND VEH_COLOR_ID IN (SELECT VEH_COLOR_ID FROM colours))"
    f", lp AS (SELECT DISTINCT * FROM persons WHERE DRVR_LIC_TYPE_ID IN {LIC})"
)


def _top(select_key: str, key: str, n_expr: str, source: str, k: int, counts: bool) -> str:
    cols = f"{key}, n" if counts else key
    return (f"SELECT {cols} FROM (SELECT {select_key} AS {key}, {n_expr} AS n FROM {source} GROUP BY 1 "
            f"ORDER BY n DESC, 1 ASC NULLS LAST LIMIT {k})")


def _a03(counts: bool) -> str:
    src = (f"(SELECT DISTINCT u.CRASH_ID, u.VEH_MAKE_ID FROM units u JOIN ({KILLERS}) p ON u.CRASH_ID = p.CRASH_ID "
           "WHERE u.DEATH_CNT <> 0 AND u.VEH_MAKE_ID <> 'NA') g")
    return _crash(_top("VEH_MAKE_ID", "VEH_MAKE_ID", "count(VEH_MAKE_ID)", src, 5, counts))


def _a05(counts: bool) -> str:
    src = ("(SELECT * FROM persons WHERE PRSN_GNDR_ID <> 'FEMALE' "
           "AND DRVR_LIC_STATE_ID NOT IN ('NA', 'Unknown', 'Other')) g")
    return _crash(_top("DRVR_LIC_STATE_ID", "DRVR_LIC_STATE_ID", "count(*)", src, 1, counts))


def _a08(counts: bool) -> str:
    return _crash(JOINED + " " + _top("DRVR_ZIP", "DRVR_ZIP", "count(*)", f"j WHERE {ALCOHOL_FILTER}", 5, counts))


def _a10(counts: bool) -> str:
    src = "lp JOIN su ON lp.CRASH_ID = su.CRASH_ID AND lp.UNIT_NBR = su.UNIT_NBR"
    return _crash(SPEEDING + " " + _top("su.VEH_MAKE_ID", "VEH_MAKE_ID", "count(*)", src, 5, counts))


ANALYSES_SQL: dict[str, str] = {
    "a01_crashes_male_deaths": _crash(
        "SELECT count(*) AS n FROM (SELECT CRASH_ID FROM persons WHERE PRSN_GNDR_ID = 'MALE' "
        "GROUP BY CRASH_ID HAVING sum(DEATH_CNT) > 2) g"),
    "a02_two_wheelers": _crash("SELECT count(*) AS n FROM units WHERE VEH_BODY_STYL_ID = 'MOTORCYCLE'"),
    "a03_top_makes_no_airbag": _a03(False),
    "a03_top_makes_no_airbag_counts": _a03(True),
    "a04_hit_and_run_licensed": _crash(
        "SELECT count(*) AS n FROM units u JOIN persons p ON u.CRASH_ID = p.CRASH_ID AND u.UNIT_NBR = p.UNIT_NBR "
        f"WHERE p.DRVR_LIC_TYPE_ID IN {LIC} AND u.VEH_HNR_FL = 'Y'"),
    "a05_state_non_female": _a05(False),
    "a05_state_non_female_counts": _a05(True),
    "a06_makes_injury_rank_3_5": _crash(
        "SELECT VEH_MAKE_ID FROM (SELECT VEH_MAKE_ID, dense_rank() OVER (ORDER BY t DESC NULLS LAST) AS rnk "
        "FROM (SELECT DISTINCT *, TOT_INJRY_CNT + DEATH_CNT AS t FROM units) d) r WHERE rnk BETWEEN 3 AND 5"),
    "a07_ethnicity_per_body": _crash(
        JOINED + ", c AS (SELECT VEH_BODY_STYL_ID, PRSN_ETHNICITY_ID, count(*) AS cnt FROM j "
        "WHERE PRSN_ETHNICITY_ID NOT IN ('NA', 'UNKNOWN', 'OTHER') AND VEH_BODY_STYL_ID NOT IN ('NA', 'UNKNOWN') "
        "GROUP BY 1, 2) SELECT VEH_BODY_STYL_ID, PRSN_ETHNICITY_ID FROM (SELECT *, row_number() OVER "
        "(PARTITION BY VEH_BODY_STYL_ID ORDER BY cnt DESC, PRSN_ETHNICITY_ID ASC NULLS LAST) AS rn FROM c) r "
        "WHERE rn = 1"),
    "a08_zips_alcohol": _a08(False),
    "a08_zips_alcohol_counts": _a08(True),
    "a09_no_damage_high_severity": _crash(
        f"SELECT count(*) AS n FROM ({SEVERE}) k JOIN ({NONE_DAMAGE}) d ON k.CRASH_ID = d.CRASH_ID"),
    "a10_speeding_makes_top_colour_state": _a10(False),
    "a10_speeding_makes_top_colour_state_counts": _a10(True),
}

VARIANTS_SQL: dict[str, str] = {
    "a02i_two_wheeler_crashes": _crash(
        "SELECT count(DISTINCT CRASH_ID) AS n FROM units "
        "WHERE VEH_BODY_STYL_ID IN ('MOTORCYCLE', 'POLICE MOTORCYCLE')"),
    "a03i_top_makes_driver_died": _crash(_top(
        "VEH_MAKE_ID", "VEH_MAKE_ID", "count(DISTINCT CRASH_ID)",
        f"(SELECT u.* FROM units u JOIN ({KILLERS}) p ON u.CRASH_ID = p.CRASH_ID AND u.UNIT_NBR = p.UNIT_NBR "
        "WHERE u.DEATH_CNT <> 0 AND u.VEH_MAKE_ID <> 'NA') g", 5, True)),
    "a04i_hit_and_run_vehicles": _crash(
        "SELECT count(*) AS n FROM (SELECT DISTINCT u.CRASH_ID, u.UNIT_NBR FROM units u JOIN persons p "
        f"ON u.CRASH_ID = p.CRASH_ID AND u.UNIT_NBR = p.UNIT_NBR WHERE p.DRVR_LIC_TYPE_ID IN {LIC} "
        "AND u.VEH_HNR_FL = 'Y') g"),
    "a05i_state_crashes_without_female": _crash(_top(
        "DRVR_LIC_STATE_ID", "DRVR_LIC_STATE_ID", "count(DISTINCT CRASH_ID)",
        "(SELECT * FROM persons p WHERE DRVR_LIC_STATE_ID NOT IN ('NA', 'Unknown', 'Other') AND NOT EXISTS "
        "(SELECT 1 FROM persons f WHERE f.PRSN_GNDR_ID = 'FEMALE' AND f.CRASH_ID = p.CRASH_ID)) g", 1, True)),
    "a06i_makes_injury_total_rank_3_5": _crash(
        "SELECT VEH_MAKE_ID, total FROM (SELECT VEH_MAKE_ID, total, dense_rank() OVER "
        "(ORDER BY total DESC NULLS LAST) AS rnk FROM (SELECT VEH_MAKE_ID, "
        "CAST(sum(TOT_INJRY_CNT + DEATH_CNT) AS BIGINT) AS total FROM (SELECT DISTINCT * FROM units) d "
        "WHERE VEH_MAKE_ID <> 'NA' GROUP BY VEH_MAKE_ID) s) r WHERE rnk BETWEEN 3 AND 5"),
    "a08i_zips_alcohol_crashes": _crash(
        JOINED + " " + _top("DRVR_ZIP", "DRVR_ZIP", "count(DISTINCT CRASH_ID)", f"j WHERE {ALCOHOL_FILTER}", 5, True)),
    "a09i_no_damage_high_severity_crashes": _crash(
        f"SELECT count(*) AS n FROM ({SEVERE}) k WHERE CRASH_ID IN (SELECT CRASH_ID FROM ({NONE_DAMAGE}) d)"),
    "a10i_speeding_makes_crashes": _crash(
        SPEEDING + " " + _top("su.VEH_MAKE_ID", "VEH_MAKE_ID", "count(DISTINCT su.CRASH_ID)",
                              "lp JOIN su ON lp.CRASH_ID = su.CRASH_ID AND lp.UNIT_NBR = su.UNIT_NBR "
                              "WHERE su.VEH_MAKE_ID <> 'NA'", 5, True)),
}
