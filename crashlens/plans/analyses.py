"""The ten crash analyses, each one lazy Spark plan over ``CrashTables``.

Semantics follow what the original job computes (bags where it counts
duplicates, sets where it deduplicates, case-sensitive code words, SQL
three-valued logic); the plans differ where the original would not scale:

* joins that only feed a count are pre-aggregated per key on both sides
  (``join_count``), so neither fan-out nor a hot crash key reaches one task;
* ``distinct`` over a joined row is done per side (δ(U ⋈ P) = δU ⋈ δP), and
  shuffles fingerprints and the needed columns (``distinct_projection``);
* the whole-table rank window is replaced by ranking the few best distinct
  values (``rank_band``);
* top-k sets are joined in the same plan (broadcast semi join of a bounded
  set) instead of being collected to the driver;
* counts are one-row DataFrames, not driver-side actions.

Ties, which the original leaves to chance, are broken by the group key
ascending (NULLS LAST), which keeps results stable and checkable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlens.functions import any_of, first_int, is_true, not_in
from crashlens.operators import (
    Matched,
    Tag,
    best_k,
    count_groups_having,
    counted_join,
    distinct_projection,
    global_count,
    having_match,
    in_top_k,
    join_count,
    rank_band,
    rows_of_tag,
    top_k,
    top_per_group,
)
from crashlens.sources.catalog import CrashTables

# ---------------------------------------------------------------------------
# Code words and lists the analyses compare against
# (case-sensitive, as stored in the crash data).
# ---------------------------------------------------------------------------
MALE = "MALE"
FEMALE = "FEMALE"
MOTORCYCLE = "MOTORCYCLE"
TWO_WHEELER_STYLES = ["MOTORCYCLE", "POLICE MOTORCYCLE"]
DRIVER = "DRIVER"
AIRBAG_NOT_DEPLOYED = "NOT DEPLOYED"
KILLED = "KILLED"
MAKE_NA = "NA"
HIT_AND_RUN_YES = "Y"
VALID_LICENCES = ["COMMERCIAL DRIVER LIC.", "OCCUPATIONAL", "DRIVER LICENSE"]
BAD_LICENCE_STATES = ["NA", "Unknown", "Other"]
BAD_ETHNICITIES = ["NA", "UNKNOWN", "OTHER"]
BAD_BODY_STYLES = ["NA", "UNKNOWN"]
ALCOHOL_POSITIVE = "Positive"
ALCOHOL_FACTORS = ["UNDER INFLUENCE - ALCOHOL", "HAD BEEN DRINKING"]
BAD_DAMAGE_SCALES = ["INVALID VALUE", "NA", "NO DAMAGE"]
NO_DAMAGE_PATTERN = "%NONE%"
INSURANCE_PATTERN = "%INSURANCE%"
SPEED_PATTERN = "%SPEED%"
BAD_COLOURS = ["NA", "99", "98"]
BAD_VEHICLE_STATES = ["NA", "98"]

FACTOR_COLUMNS = ["CONTRIB_FACTR_1_ID", "CONTRIB_FACTR_2_ID", "CONTRIB_FACTR_P1_ID"]
VEHICLE = ["CRASH_ID", "UNIT_NBR"]
TOTAL = "_harmed"


def _males() -> Column:
    return F.col("PRSN_GNDR_ID") == MALE


def _killed_drivers_no_airbag() -> Column:
    return (
        (F.col("PRSN_TYPE_ID") == DRIVER)
        & (F.col("PRSN_AIRBAG_ID") == AIRBAG_NOT_DEPLOYED)
        & ((F.col("PRSN_INJRY_SEV_ID") == KILLED) | (F.col("DEATH_CNT") != 0))
    )


def _licensed() -> Column:
    return F.col("DRVR_LIC_TYPE_ID").isin(VALID_LICENCES)


def _non_female_with_state() -> Column:
    return (F.col("PRSN_GNDR_ID") != FEMALE) & not_in("DRVR_LIC_STATE_ID", BAD_LICENCE_STATES)


def _two_wheelers() -> Column:
    return F.col("VEH_BODY_STYL_ID") == MOTORCYCLE


def _fatal_with_make() -> Column:
    return (F.col("DEATH_CNT") != 0) & (F.col("VEH_MAKE_ID") != MAKE_NA)


def _hit_and_run() -> Column:
    return F.col("VEH_HNR_FL") == HIT_AND_RUN_YES


def _insured_severe() -> Column:
    return (
        (not_in("VEH_DMAG_SCL_1_ID", BAD_DAMAGE_SCALES) | not_in("VEH_DMAG_SCL_2_ID", BAD_DAMAGE_SCALES))
        & F.col("FIN_RESP_TYPE_ID").like(INSURANCE_PATTERN)
        & ((first_int("VEH_DMAG_SCL_1_ID") > 4) | (first_int("VEH_DMAG_SCL_2_ID") > 4))
    )


def person_tags() -> dict[str, Tag]:
    """The groups of ``person`` that analyses start from."""
    return {tag.name: tag for tag in (
        Tag("a01", _males(), ["CRASH_ID"], "DEATH_CNT"), Tag("a03", _killed_drivers_no_airbag(), ["CRASH_ID"]),
        Tag("a04", _licensed(), VEHICLE), Tag("a05", _non_female_with_state(), ["DRVR_LIC_STATE_ID"]),
    )}


def units_tags() -> dict[str, Tag]:
    """The groups of ``units`` that analyses start from."""
    return {tag.name: tag for tag in (
        Tag("a02", _two_wheelers()), Tag("a03", _fatal_with_make(), ["CRASH_ID", "VEH_MAKE_ID"]),
        Tag("a04", _hit_and_run(), VEHICLE), Tag("a09", _insured_severe(), ["CRASH_ID"]),
    )}


def a01_crashes_male_deaths(t: CrashTables, threshold: int = 2) -> DataFrame:
    """Crashes whose male persons' ``DEATH_CNT`` sums to more than ``threshold``."""
    if t.tagged:
        return global_count(rows_of_tag(t.tagged["person"], person_tags()["a01"]).filter(F.col("total") > threshold))
    return count_groups_having(t.person.filter(_males()), ["CRASH_ID"], F.sum("DEATH_CNT"), lambda s: s > threshold)


def a02_two_wheelers(t: CrashTables) -> DataFrame:
    """Vehicle rows (duplicates included) whose body style is exactly MOTORCYCLE."""
    if t.tagged:
        return rows_of_tag(t.tagged["units"], units_tags()["a02"]).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"))
    return global_count(t.units.filter(_two_wheelers()))


def a03_top_makes_no_airbag(t: CrashTables, k: int = 5, with_counts: bool = False) -> DataFrame:
    """Top makes by crashes in which *some* driver was killed without airbag.

    The original joins on ``CRASH_ID`` only, so every fatal vehicle of such a
    crash counts, once per crash: semi join + distinct (crash, make).
    """
    if t.tagged:
        makes = rows_of_tag(t.tagged["units"], units_tags()["a03"]).select("CRASH_ID", "VEH_MAKE_ID")
        killers = rows_of_tag(t.tagged["person"], person_tags()["a03"])
    else:
        makes = t.units.filter(_fatal_with_make()).select("CRASH_ID", "VEH_MAKE_ID").distinct()
        killers = t.person.filter(_killed_drivers_no_airbag())
    return top_k(having_match(makes, killers, ["CRASH_ID"]), "VEH_MAKE_ID", k, keep_measure=with_counts)


def a04_hit_and_run_licensed(t: CrashTables) -> DataFrame:
    """Rows of (hit-and-run vehicle ⋈ validly licensed person) on the vehicle key."""
    if t.tagged:
        hit_and_run, licensed = rows_of_tag(t.tagged["units"], units_tags()["a04"]), rows_of_tag(t.tagged["person"], person_tags()["a04"])
        return counted_join(hit_and_run, licensed, VEHICLE, "n", "n")
    return join_count(t.units.filter(_hit_and_run()), t.person.filter(_licensed()), VEHICLE)


def a05_state_non_female(t: CrashTables, k: int = 1, with_counts: bool = False) -> DataFrame:
    """Licence state with the most non-female person rows (NULL gender drops)."""
    if t.tagged:
        states = rows_of_tag(t.tagged["person"], person_tags()["a05"]).select("DRVR_LIC_STATE_ID", "n")
        return best_k(states, "n", "DRVR_LIC_STATE_ID", k, keep_measure=with_counts)
    return top_k(t.person.filter(_non_female_with_state()), "DRVR_LIC_STATE_ID", k, keep_measure=with_counts)


def with_total(units: DataFrame) -> DataFrame:
    return units.withColumn(TOTAL, F.col("TOT_INJRY_CNT") + F.col("DEATH_CNT"))


def a06_makes_injury_rank_3_5(t: CrashTables, lo: int = 3, hi: int = 5) -> DataFrame:
    """Makes of the distinct vehicle rows whose injury+death total has dense rank 3..5.

    A bag: one output row per distinct vehicle row in the band. The band
    (at most ``hi`` distinct totals) filters the rows *before* the
    whole-row ``distinct``, so only band rows are shuffled for it.
    """
    if t.units_rows is not None:  # distinct rows staged: band them directly
        return rank_band(with_total(t.units_rows), TOTAL, lo, hi).select("VEH_MAKE_ID")
    banded = rank_band(with_total(t.units), TOTAL, lo, hi)
    return banded.distinct().select("VEH_MAKE_ID")


def _distinct(rows: DataFrame, staged: DataFrame | None, condition: Column, keep: list[str | Column]) -> DataFrame:
    """``keep`` of the distinct whole rows that meet ``condition`` (which depends on the row only)."""
    return staged.filter(condition).select(*keep) if staged is not None else distinct_projection(rows.filter(condition), keep)


def a07_ethnicity_per_body(t: CrashTables) -> DataFrame:
    """Most frequent ethnicity per body style over distinct (vehicle ⋈ person) rows."""
    units = _distinct(t.units, t.units_rows, not_in("VEH_BODY_STYL_ID", BAD_BODY_STYLES), [*VEHICLE, "VEH_BODY_STYL_ID"])
    people = _distinct(t.person, t.person_rows, not_in("PRSN_ETHNICITY_ID", BAD_ETHNICITIES), [*VEHICLE, "PRSN_ETHNICITY_ID"])
    counts = join_count(units, people, VEHICLE, ["VEH_BODY_STYL_ID"], ["PRSN_ETHNICITY_ID"], name="count")
    best = top_per_group(counts, "VEH_BODY_STYL_ID",
                         [F.col("count").desc(), F.col("PRSN_ETHNICITY_ID").asc_nulls_last()])
    return best.select("VEH_BODY_STYL_ID", "PRSN_ETHNICITY_ID")


def _alcohol_flags(t: CrashTables) -> tuple[DataFrame, DataFrame]:
    """Distinct rows of each side with its half of the alcohol predicate as a
    two-valued flag (a function of the row, so flag and distinct commute)."""
    unit_flag = is_true(any_of(FACTOR_COLUMNS, lambda c: c.isin(ALCOHOL_FACTORS)))
    person_flag = is_true(F.col("PRSN_ALC_RSLT_ID") == ALCOHOL_POSITIVE)
    with_zip = t.person.filter(F.col("DRVR_ZIP").isNotNull())
    # Only vehicles with a sign on either side can count: keys from narrow scans,
    # semi-joined to the narrow rows of the distincts (both depend on the row only).
    keys = t.units.filter(unit_flag).select(*VEHICLE).unionByName(with_zip.filter(person_flag).select(*VEHICLE))
    units_kept, people_kept = [*VEHICLE, unit_flag.alias("_u_alc")], [*VEHICLE, "DRVR_ZIP", person_flag.alias("_p_alc")]
    if t.units_rows is not None:
        units = t.units_rows.select(*units_kept)
    else:
        units = distinct_projection(Matched(t.units, keys, VEHICLE), units_kept)
    if t.person_rows is not None:
        people = t.person_rows.filter(F.col("DRVR_ZIP").isNotNull()).select(*people_kept)
    else:
        people = distinct_projection(Matched(with_zip, keys, VEHICLE), people_kept)
    return units, people


def a08_zips_alcohol(t: CrashTables, k: int = 5, with_counts: bool = False) -> DataFrame:
    """Top driver zips by distinct (vehicle ⋈ person) rows with an alcohol sign.

    The predicate ``(person positive OR any unit factor) AND zip not null``
    spans both sides, so each side is reduced to counts per vehicle key:
    units to (all rows, alcohol rows), people to rows per (zip, positive).
    A joined pair passes iff the person is positive or the unit has a
    factor, hence ``n = n_people * (n_units if positive else n_alc_units)``.
    """
    units, people = _alcohol_flags(t)
    unit_counts = (
        units.groupBy(*VEHICLE)
        .agg(F.count(F.lit(1)).alias("_nu"), F.sum(F.col("_u_alc").cast("long")).alias("_nu_alc"))
    )
    person_counts = people.groupBy(*VEHICLE, "DRVR_ZIP", "_p_alc").agg(F.count(F.lit(1)).alias("_np"))
    pairs = person_counts.join(unit_counts, VEHICLE, "inner")
    passed = F.col("_np") * F.when(F.col("_p_alc"), F.col("_nu")).otherwise(F.col("_nu_alc"))
    per_zip = pairs.groupBy("DRVR_ZIP").agg(F.sum(passed).alias("n")).filter(F.col("n") > 0)
    return best_k(per_zip, "n", "DRVR_ZIP", k, keep_measure=with_counts)


def _insured_severe_crashes(t: CrashTables) -> DataFrame:
    """Distinct crash ids with an insured vehicle of damage level above 4."""
    if t.tagged:
        return rows_of_tag(t.tagged["units"], units_tags()["a09"]).select("CRASH_ID")
    return t.units.filter(_insured_severe()).select("CRASH_ID").distinct()


def _no_damage_rows(t: CrashTables) -> DataFrame:
    return t.damages.filter(F.col("DAMAGED_PROPERTY").like(NO_DAMAGE_PATTERN)).distinct()


def a09_no_damage_high_severity(t: CrashTables) -> DataFrame:
    """Rows of (insured severe crash ids ⋈ distinct 'NONE' damage rows)."""
    return join_count(_insured_severe_crashes(t), _no_damage_rows(t), ["CRASH_ID"])


def _speeding_units_in_top_sets(t: CrashTables, colours: int = 10, states: int = 25) -> DataFrame:
    """Speeding vehicles whose colour and state are among the most frequent."""
    top_colours = top_k(t.units.filter(not_in("VEH_COLOR_ID", BAD_COLOURS)), "VEH_COLOR_ID", colours)
    top_states = top_k(t.units.filter(not_in("VEH_LIC_STATE_ID", BAD_VEHICLE_STATES)), "VEH_LIC_STATE_ID", states)
    speeding = t.units.filter(any_of(FACTOR_COLUMNS, lambda c: c.like(SPEED_PATTERN)))
    speeding = in_top_k(speeding, "VEH_LIC_STATE_ID", top_states)
    return in_top_k(speeding, "VEH_COLOR_ID", top_colours)


def a10_speeding_makes_top_colour_state(t: CrashTables, k: int = 5, with_counts: bool = False) -> DataFrame:
    """Top makes by rows of (distinct licensed persons ⋈ speeding top-colour/state vehicles)."""
    speeding = _speeding_units_in_top_sets(t)
    # The semi join depends on the row only, so it may go below the distinct.
    licensed = Matched((t.person if t.person_rows is None else t.person_rows).filter(_licensed()), speeding, VEHICLE)
    licensed = distinct_projection(licensed, VEHICLE) if t.person_rows is None else licensed.joined()
    counts = join_count(licensed, speeding, VEHICLE, by_right=["VEH_MAKE_ID"])
    return best_k(counts, "n", "VEH_MAKE_ID", k, keep_measure=with_counts)
