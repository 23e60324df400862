"""Exact ranks, running totals and quantiles that never put a whole group into one task.

A value axis is cut into buckets at approximate quantiles. Every bucket holds a bounded share of all
rows, whatever group they belong to, so (group, bucket) is a safe window key. Bucket totals give
each bucket its starting offset. The cuts only decide who computes what; results are exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tissuegrid.runtime import cut_lineage, fanout


SPLIT_SAMPLE = 0.05


def _known(value: str):
    """Neither NULL nor NaN."""
    return F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))


def value_splits(df: DataFrame, value: str, pieces: int | None = None) -> list[float]:
    """Cut points: at most ``pieces`` of them; a value that spans several cuts gets its own bucket.

    A sample is enough, as for a range partitioning: cuts only balance the work.
    """
    pieces = pieces or fanout(df.sparkSession)
    probs = [i / pieces for i in range(1, pieces)]
    cuts = df.where(_known(value)).select(value).sample(SPLIT_SAMPLE, seed=1).approxQuantile(value, probs, 0.5 / pieces)
    points = set(cuts)
    points.update([math.nextafter(c, math.inf) for c in points if cuts.count(c) > 1])
    return [-math.inf, *sorted(points), math.inf]


def put_in_bucket(df: DataFrame, value: str, splits: list[float], name: str) -> DataFrame:
    """``df`` with the number of the bucket; NULL and NaN have a bucket of their own, the last."""
    if len(splits) < 3:
        return df.withColumn(name, F.when(_known(value), 0.0).otherwise(1.0))
    filled = df.withColumn("_filled", F.coalesce(F.col(value).cast("double"), F.lit(float("nan"))))
    return Bucketizer(splits=splits, inputCol="_filled", outputCol=name, handleInvalid="keep").transform(filled).drop("_filled")


def bucket_offsets(df: DataFrame, keys: Sequence[str], bucket: str, n: str, name: str) -> DataFrame:
    """Rows of each group in earlier buckets, and in all of them as ``_total``.

    The table has one row per (group, bucket).
    """
    totals = df.groupBy(*keys, bucket).agg(F.sum(n).alias("_in_bucket"))
    whole = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    earlier = whole.orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    return totals.select(
        *keys,
        bucket,
        F.coalesce(F.sum("_in_bucket").over(earlier), F.lit(0)).alias(name),
        F.sum("_in_bucket").over(whole).alias("_total"),
    )


def ranked_counts(
    df: DataFrame, keys: Sequence[str], value: str, carry: Sequence[str] = (), pieces: int | None = None
) -> DataFrame:
    """Counts per (group, value, carry) with the number of rows before and up to the value.

    Columns: keys, value, carry, ``n``, ``ties`` (rows with this value), ``below`` (rows with a smaller
    one), ``total`` (rows of the group). Average rank is ``below + (ties + 1) / 2``.
    """
    keys, carry = list(keys), list(carry)
    known = df.where(_known(value))
    counts = known.groupBy(*keys, value, *carry).agg(F.count(F.lit(1)).alias("n"))
    counts = put_in_bucket(counts, value, value_splits(known, value, pieces), "_bucket")
    offsets = bucket_offsets(counts, keys, "_bucket", "n", "_before")
    spread = counts.join(offsets, [*keys, "_bucket"])
    w = W.partitionBy(*keys, "_bucket").orderBy(value)
    return (
        spread.withColumn("ties", F.sum("n").over(W.partitionBy(*keys, "_bucket", value)))
        .withColumn(
            "below",
            F.col("_before")
            + F.sum("n").over(w.rangeBetween(W.unboundedPreceding, W.currentRow))
            - F.col("ties"),
        )
        .withColumnRenamed("_total", "total")
        .drop("_bucket", "_before")
    )


def counted_values(df: DataFrame, keys: Sequence[str], value: str, carry: Sequence[str] = (), sums: Sequence[str] = (), pieces: int | None = None) -> DataFrame:
    """Stage table from which ranks, quantiles, counts and means are taken: the source is read once for all of them.

    One row per (keys, value, carry) with ``n`` rows and the sums of other columns, sorted into ranges of (keys, value);
    ``_bucket`` is the range. A range holds a bounded share of the rows, so (keys, _bucket) is a safe window key; NULL
    and NaN values are rows too.
    """
    pieces = pieces or fanout(df.sparkSession)
    totals = [F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in sums]]
    counts = df.groupBy(*keys, value, *carry).agg(*totals)
    return cut_lineage(counts.repartitionByRange(pieces, *keys, value).withColumn("_bucket", F.spark_partition_id()))


def ranks_of(counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``ranked_counts`` of a table made by ``counted_values``."""
    keys = list(keys)
    known = counts.where(_known(value))
    spread = known.join(bucket_offsets(known, keys, "_bucket", "n", "_before"), [*keys, "_bucket"])
    upto = F.sum("n").over(W.partitionBy(*keys, "_bucket").orderBy(value).rangeBetween(W.unboundedPreceding, W.currentRow))
    ties = F.sum("n").over(W.partitionBy(*keys, "_bucket", value))
    return spread.withColumn("ties", ties).withColumn("below", F.col("_before") + upto - F.col("ties")).withColumnRenamed("_total", "total").drop("_bucket", "_before")


def corrected_levels(df: DataFrame, group: str, p: str, name: str = "p_value_corrected", pieces: int | None = None) -> DataFrame:
    """Step-up corrected levels for groups of any size: p · m / rank, lowered to the smallest later one.

    The later minimum is taken inside each bucket and over the few following buckets.
    """
    known = df.where(_known(p))
    counts = known.groupBy(group, p).agg(F.count(F.lit(1)).alias("n"))
    counts = put_in_bucket(counts, p, value_splits(known, p, pieces), "_bucket")
    spread = counts.join(bucket_offsets(counts, [group], "_bucket", "n", "_before"), [group, "_bucket"])
    local = W.partitionBy(group, "_bucket")
    upto = F.col("_before") + F.sum("n").over(local.orderBy(p))
    level = spread.withColumn("_q", F.col(p) * F.col("_total") / upto)
    later = W.partitionBy(group).orderBy(F.col("_bucket").desc()).rowsBetween(W.unboundedPreceding, -1)
    lows = level.groupBy(group, "_bucket").agg(F.min("_q").alias("_low"))
    lows = lows.select(group, "_bucket", F.min("_low").over(later).alias("_later"))
    own = F.min("_q").over(local.orderBy(F.col(p).desc()))
    out = level.join(lows, [group, "_bucket"]).select(group, p, F.least(F.lit(1.0), own, F.col("_later")).alias(name))
    return df.join(out, [group, p], "left")


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    pieces: int | None = None,
) -> DataFrame:
    """Linear-interpolation quantiles per group, one column per named probability."""
    return quantiles_of(ranked_counts(df, list(keys), value, pieces=pieces), keys, value, probs)


def quantiles_of(ranked: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """``quantiles`` of counts that have their ranks."""
    keys, picks = list(keys), []
    for name, p in probs.items():
        at = (F.col("total") - 1) * F.lit(float(p))
        upto = F.col("below") + F.col("ties")
        picks += [
            F.min(F.when(upto > F.floor(at), F.col(value))).alias(f"_lo_{name}"),
            F.min(F.when(upto > F.ceil(at), F.col(value))).alias(f"_hi_{name}"),
            F.max(at - F.floor(at)).alias(f"_w_{name}"),
        ]
    wide = ranked.groupBy(*keys).agg(*picks)
    return wide.select(
        *keys,
        *[
            (
                F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")
            ).alias(n)
            for n in probs
        ],
    )


def positions(df: DataFrame, keys: Sequence[str], order: str, tiebreak: Sequence[str] = (), name: str = "position"):
    """1-based place of each row in its group by a numeric ``order`` column, then ``tiebreak``.

    ``order`` should be close to unique, such as a hash or an id.
    """
    keys = list(keys)
    plain = df.withColumn("_o", F.col(order).cast("double"))
    spread = put_in_bucket(plain, "_o", value_splits(plain, "_o"), "_bucket")
    offsets = bucket_offsets(spread.withColumn("_one", F.lit(1)), keys, "_bucket", "_one", "_before")
    w = W.partitionBy(*keys, "_bucket").orderBy(order, *tiebreak)
    return (
        spread.join(offsets, [*keys, "_bucket"])
        .withColumn(name, (F.col("_before") + F.row_number().over(w)).cast("bigint"))
        .drop("_o", "_bucket", "_before", "_total")
    )


def numbered(df: DataFrame, order: Sequence[str], name: str = "position", pieces: int | None = None) -> DataFrame:
    """1-based place of each row in the order of columns of any type, such as texts; NULL comes first.

    Rows are sorted into ranges, the ranges are written, and each range is numbered from its offset: no task sees more
    than a range. Rows equal in all of ``order`` share a range and are numbered in any order.
    """
    pieces = pieces or fanout(df.sparkSession)
    ranged = cut_lineage(df.repartitionByRange(pieces, *order).withColumn("_bucket", F.spark_partition_id()))
    offsets = bucket_offsets(ranged.withColumn("_one", F.lit(1)), [], "_bucket", "_one", "_before").drop("_total")
    within = F.row_number().over(W.partitionBy("_bucket").orderBy(*order))
    return ranged.join(offsets, "_bucket").withColumn(name, (F.col("_before") + within).cast("bigint")).drop("_bucket", "_before")


#: Ways a rank is split at each level of ``smaller_pairs``.
RADIX = 16


def smaller_pairs(counts: DataFrame, a: str, rank: str, n: str, total: int, pieces: int | None = None) -> DataFrame:
    """One row (pairs): Σ nᵢ · nⱼ over rows with aⱼ < aᵢ and rankⱼ < rankᵢ, without forming pairs of rows.

    ``rank`` is a whole number below ``total`` that orders the second axis. Two ranks differ first at one digit; so the
    pairs are counted digit by digit among rows that agree on the digits before: along ``a``, running sums of every
    digit say how many rows of a smaller digit went before. Running sums are kept per bucket of ``a`` and joined by
    offsets, and rows of one ``a`` are one row of 16 sums, so what a task holds does not depend on the number of rows.
    """
    levels = max(1, math.ceil(math.log(max(2, total), RADIX)))
    while RADIX**levels < total:
        levels += 1
    cut = put_in_bucket(counts, a, value_splits(counts, a, pieces), "_bucket").where(F.col(a).isNotNull())
    step = F.expr(f"shiftright(CAST(`{rank}` AS BIGINT), 4 * ({levels - 1} - _level))")
    dealt = cut.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))).withColumn("_step", step)
    dealt = dealt.withColumn("_prefix", F.shiftright("_step", 4)).withColumn("_digit", F.col("_step") % RADIX)
    keys = ["_level", "_prefix", "_bucket"]
    sums = [F.sum(F.when(F.col("_digit") == i, F.col(n)).otherwise(F.lit(0))).alias(f"_n{i}") for i in range(RADIX)]
    rows = dealt.groupBy(*keys, a).agg(*sums)
    per_bucket = dealt.groupBy(*keys).agg(*sums)
    before = W.partitionBy("_level", "_prefix").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_bucket.select(*keys, *[F.coalesce(F.sum(f"_n{i}").over(before), F.lit(0)).alias(f"_o{i}") for i in range(RADIX - 1)])
    inside = W.partitionBy(*keys).orderBy(a).rowsBetween(W.unboundedPreceding, -1)
    run = rows.join(offsets, keys).select(
        *[f"_n{i}" for i in range(1, RADIX)],
        *[(F.col(f"_o{i}") + F.coalesce(F.sum(f"_n{i}").over(inside), F.lit(0))).alias(f"_r{i}") for i in range(RADIX - 1)],
    )
    exact = "CAST({} AS DECIMAL(19, 0))"
    terms = [f"{exact.format(f'_n{i}')} * {exact.format('(' + ' + '.join(f'_r{j}' for j in range(i)) + ')')}" for i in range(1, RADIX)]
    return run.agg(F.coalesce(F.sum(F.expr(" + ".join(terms))), F.lit(0)).cast("double").alias("pairs"))


def running_before(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str, block: int = 4096) -> DataFrame:
    """Sum of ``value`` over the rows before this one by an integer ``order`` column.

    Done in two levels of ``block`` order values each, so no window sees the whole table.
    """
    keys = list(keys)
    blocked = df.withColumn("_block", F.floor(F.col(order) / F.lit(block)))
    offsets = bucket_offsets(blocked, keys, "_block", value, "_before")
    w = W.partitionBy(*keys, "_block").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return (
        blocked.join(offsets, [*keys, "_block"])
        .withColumn(name, F.col("_before") + F.coalesce(F.sum(value).over(w), F.lit(0)))
        .drop("_block", "_before", "_total")
    )
