"""The first aggregates of six analyses from one pass over ``person`` and one over ``units``.

A01, A02, A05 and the first steps of A03, A04 and A09 group rows of one table
that meet a condition. A batch job that runs them one by one scans ``person`` four
times and ``units`` four times for it; :func:`share` scans each once, writes the groups
of all of them as one table, divided by tag, and the analyses go on from there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import SparkSession

from crashlens.operators.tagged import tagged_aggregates
from crashlens.plans import analyses as A
from crashlens.session import remove_path, scratch_path
from crashlens.sources.catalog import CrashTables

#: The analyses that go on from shared groups.
SHARED = {"a01_crashes_male_deaths", "a02_two_wheelers", "a03_top_makes_no_airbag", "a04_hit_and_run_licensed",
          "a05_state_non_female", "a09_no_damage_high_severity"}


def share(spark: SparkSession, t: CrashTables, announce: Callable[[str], None] | None = None) -> CrashTables:
    """``t`` with the groups of all tags written and read back; ``unstage`` deletes them.

    The groups have one row per crash, vehicle, (crash, make) or state and tag at most;
    an analysis reads only the folder of its tag. ``announce`` is told each
    folder before it is written.
    """
    tagged, paths = {}, []
    try:
        for name, tags in (("person", A.person_tags()), ("units", A.units_tags())):
            groups = tagged_aggregates(t.as_dict()[name], list(tags.values()))
            path = scratch_path(spark, f"tagged-{name}")
            paths.append(path)
            if announce:
                announce(path)
            groups.write.partitionBy("tag").parquet(path)
            tagged[name] = spark.read.schema(groups.schema).parquet(path)
    except BaseException:
        for path in paths:
            remove_path(spark, path)
        raise
    return replace(t, tagged=tagged, staged_paths=(*t.staged_paths, *paths))
