"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate: its target share of the output rows
over the rows it has. A document's number of copies is a Poisson variable with
that mean, found by inverting the distribution at a uniform number hashed from
the document's id and a seed (rows that share an id also take their place), so a
rerun or a lost executor gives the same copies. Copies are exploded and dealt
out globally by a hash of (id, copy).

Everything is DataFrame functions. The per-source table (rate and cumulative
distribution) has one row per source and is written first, so Spark knows its
size: it broadcasts a small one by its own threshold, and splits a hot source's
rows if it must shuffle them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlens.llm.tables import written

#: A larger mean is drawn in parts, so that a distribution's steps are few.
SPLIT = 32
STEP = 128  # more copies than a draw of mean ``SPLIT`` or less can give

#: 13 hex digits are 52 bits, which a double holds exactly.
_HEX = 13


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from an md5 of the parts joined by ``:`` (null as an empty part)."""
    text = F.concat_ws(":", *[F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p, F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, _HEX), 16, 10).cast("double") / F.lit(float(1 << 4 * _HEX))


def poisson_steps(rate: Column) -> Column:
    """The cumulative Poisson distribution of ``rate`` at 0, 1, 2, ..., far into its tail.

    Terms are ``exp(k ln rate - rate - ln k!)``, so a large rate does not
    underflow at 0. The last step lies 12 standard deviations above the mean.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")
    start = F.struct(F.lit(0.0).alias("log_k_fact"), F.lit(0.0).alias("cdf"), F.array().cast("array<double>").alias("steps"))

    def step(acc: Column, k: Column) -> Column:
        log_fact = acc["log_k_fact"] + F.when(k > 0, F.ln(k.cast("double"))).otherwise(F.lit(0.0))
        cdf = acc["cdf"] + F.exp(k.cast("double") * F.ln(rate) - rate - log_fact)
        return F.struct(log_fact.alias("log_k_fact"), cdf.alias("cdf"), F.concat(acc["steps"], F.array(cdf)).alias("steps"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(0), last), start, step, lambda acc: acc["steps"])).otherwise(F.array(F.lit(1.0)))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, *, source: str = "source",
                 rows: float = 1.0, temper: float = 0.5) -> DataFrame:
    """One row per source: ``n`` (its rows), ``rate`` (mean copies per document).

    ``weights`` gives target shares by source (relative; sources not named get
    none). Without it the share is ``n ** temper``: 1 keeps the corpus's mix,
    0 makes all sources equal. Null is a source of its own, named by null.
    ``rows`` is the size of the output as a multiple of the input.
    """
    counts = docs.groupBy(F.col(source).alias("_source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        share = F.pow(F.col("n").cast("double"), F.lit(float(temper)))
    else:
        share = F.lit(0.0)
        for name, weight in weights.items():
            share = F.when(F.col("_source").eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(share)
    shares = counts.withColumn("share", share)
    total = shares.agg(F.sum("n").alias("all_n"), F.sum("share").alias("all_share"))
    return shares.join(F.broadcast(total)).select(  # one row by construction
        "_source", "n",
        F.when(F.col("all_share") > 0, F.col("share") / F.col("all_share") * F.col("all_n") * F.lit(float(rows)) / F.col("n"))
        .otherwise(F.lit(0.0)).alias("rate"),
    )


def mix(docs: DataFrame, weights: dict[str, float] | None = None, *, key: str = "doc_id", source: str = "source",
        rows: float = 1.0, temper: float = 0.5, seed: str = "mix") -> DataFrame:
    """Copies of ``docs`` with its columns, plus ``copy`` (1, 2, ...) and ``shuffle_key`` in [0, 1).

    A row of rate r appears 0, 1, 2, ... times, r times on average, independently
    of all others. A row draws by its id; rows that share an id, or have none
    with others, draw by id and place in the input (which needs no more than that the same
    files are read in the same splits). A rate over ``SPLIT`` is split into
    equal draws of at most that rate, which are dealt out by themselves; the
    numbers in ``copy`` then have gaps, each draw counting from a
    multiple of ``STEP`` on. Output rows lie in partitions in the order of
    ``shuffle_key``, ranges of which are dealt to partitions, so reading the
    parts in order is a global shuffle. Existing columns named ``copy`` or
    ``shuffle_key`` are replaced; all others stay, whatever they are called. A
    null source is a source of its own. An empty table gives an empty result.
    """
    rates = source_rates(docs, weights, source=source, rows=rows, temper=temper)
    parts = F.greatest(F.ceil(F.col("rate") / SPLIT), F.lit(1)).cast("int")
    steps = rates.select("_source", parts.alias("parts"), poisson_steps(F.col("rate") / parts).alias("steps"))
    steps = written(steps, "mix-steps")
    several = docs.groupBy(F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    several = written(several.select("id", F.lit(True).alias("several")), "mix-repeated")
    kept = docs.drop("copy", "shuffle_key")
    row = F.struct(*(F.col(f"`{c}`") for c in kept.columns)).alias("row")  # no name of a column can clash with those used here
    placed = kept.select(row, F.col(key).alias("key"), F.col(source).alias("source"), F.monotonically_increasing_id().alias("place"))
    joined = placed.join(several, placed["key"].eqNullSafe(several["id"]), "left").join(steps, F.col("source").eqNullSafe(F.col("_source")), "inner")
    joined = joined.select("row", "key", "parts", "steps", F.when(F.col("several"), F.col("place")).alias("place"))
    who = F.concat_ws(":", F.coalesce(F.col("key").cast("string"), F.lit("")), F.col("place").cast("string"))  # an unset place is left out

    def copies(drawn: DataFrame, u: Column, part: Column) -> DataFrame:
        # Copies: how many steps of the distribution lie at or below the number drawn.
        n = F.size(F.filter("steps", lambda c: c <= u))
        made = drawn.withColumn("n", n).where(F.col("n") > 0).select("row", "key", "place", part.alias("part"), F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"))
        copy = ((F.col("part") - 1) * STEP + F.col("i")).cast("int")
        return made.select("row", "key", copy.alias("copy"), uniform(F.lit(seed + "-order"), who, copy).alias("shuffle_key"))

    out = copies(joined.where("parts = 1").withColumn("u", uniform(F.lit(seed), who)), F.col("u"), F.lit(1))
    if not steps.where("parts > 1").isEmpty():
        split = joined.where("parts > 1").withColumn("part", F.explode(F.sequence(F.lit(1), F.col("parts"))))
        split = split.withColumn("u", uniform(F.lit(seed), who, "part")).repartition("u")
        out = out.unionByName(copies(split, F.col("u"), F.col("part")))
    return out.repartitionByRange("shuffle_key").sortWithinPartitions("shuffle_key", "key").select("row.*", "copy", "shuffle_key")
