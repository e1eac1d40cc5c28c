"""Column types of the crash tables.

The real crash files carry many more columns than the analyses use; CSV is
positional, so a full ``StructType`` cannot be written down for them. The
typed reader therefore reads the header and casts the *named* columns below,
leaving every other column a string. Code columns stay strings on purpose:
a zip such as ``01234`` must keep its leading zero, and comparing a numeric
column with ``'NA'`` would fail under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Non-string columns of the three crash tables.
PERSON_TYPES: dict[str, T.DataType] = {
    "CRASH_ID": T.LongType(),
    "UNIT_NBR": T.IntegerType(),
    "PRSN_NBR": T.IntegerType(),
    "DEATH_CNT": T.IntegerType(),
}
UNITS_TYPES: dict[str, T.DataType] = {
    "CRASH_ID": T.LongType(),
    "UNIT_NBR": T.IntegerType(),
    "DEATH_CNT": T.IntegerType(),
    "TOT_INJRY_CNT": T.IntegerType(),
}
DAMAGES_TYPES: dict[str, T.DataType] = {
    "CRASH_ID": T.LongType(),
}

TABLE_TYPES: dict[str, dict[str, T.DataType]] = {
    "person": PERSON_TYPES,
    "units": UNITS_TYPES,
    "damages": DAMAGES_TYPES,
}

# Columns each table must provide for the ten analyses (all others optional).
REQUIRED_COLUMNS: dict[str, tuple[str, ...]] = {
    "person": (
        "CRASH_ID", "UNIT_NBR", "PRSN_TYPE_ID", "PRSN_GNDR_ID", "PRSN_AIRBAG_ID", "PRSN_INJRY_SEV_ID",
        "PRSN_ETHNICITY_ID", "DRVR_LIC_TYPE_ID", "DRVR_LIC_STATE_ID", "DRVR_ZIP", "PRSN_ALC_RSLT_ID", "DEATH_CNT",
    ),
    "units": (
        "CRASH_ID", "UNIT_NBR", "VEH_BODY_STYL_ID", "VEH_MAKE_ID", "VEH_COLOR_ID", "VEH_LIC_STATE_ID", "VEH_HNR_FL",
        "CONTRIB_FACTR_1_ID", "CONTRIB_FACTR_2_ID", "CONTRIB_FACTR_P1_ID", "VEH_DMAG_SCL_1_ID", "VEH_DMAG_SCL_2_ID",
        "FIN_RESP_TYPE_ID", "DEATH_CNT", "TOT_INJRY_CNT",
    ),
    "damages": ("CRASH_ID", "DAMAGED_PROPERTY"),
}
