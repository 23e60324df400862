"""Mixing sources to target weights by entropy balancing.

Every document gets a rate between 0 and ``most``. Among all rates that meet each source's word target, entropy
balancing takes those closest to the even rate; their dual has one number per source, and the rates are exponential
tilts by document size, folded into the allowed range: most / (1 + exp(-lambda * size / mean size)). Newton steps on the
dual run over a histogram of sizes per source, so that a step costs one aggregate of distinct sizes.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tissuegrid.runtime import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
#: Newton steps before the run is an error, and the words by which a source may miss its target before rounding.
MOST_STEPS, CLOSE = 80, 0.25
#: Documents of one source that are rounded together in a task.
BUCKET_ROWS = 1000


def numbered(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``place``, from 0, by ``column`` in code point order, null last; no task gets all rows."""
    ranged = rows.repartitionByRange(F.col(column).asc_nulls_last()).withColumn("__part", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    counts = ranged.groupBy("__part").count().toPandas().sort_values("__part")  # a row per partition
    offsets = pd.DataFrame({"__part": counts["__part"], "__before": counts["count"].cumsum() - counts["count"]})
    offsets = rows.sparkSession.createDataFrame(offsets, "__part int, __before long")
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(F.col(column).asc_nulls_last())) - 1
    return ranged.join(offsets, "__part").withColumn("place", F.col("__before") + inside).drop("__part", "__before")


def numbered_within(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """``rows`` with ``place``, from 0 within each value of ``key`` (null is one) in the order given; no task gets all of a key.

    ``rows`` must not change when read again, and ``order`` should tell rows apart, so that equal ones can be dealt out.
    """
    order = [F.col(key).asc(), *order]
    ranged = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__line", F.monotonically_increasing_id()))
    part = F.shiftright("__line", 33)  # the id's upper bits number the partition, the lower ones its rows
    runs = ranged.groupBy(F.col(key).alias("__of"), part.alias("__part")).agg(F.min("__line").alias("__begin"), F.count("*").alias("__n"))
    ahead = F.sum("__n").over(Window.partitionBy("__of").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))  # a row per partition
    runs = runs.select("__of", "__part", "__begin", F.coalesce(ahead, F.lit(0)).alias("__ahead"))
    placed = ranged.withColumn("__in", part).join(runs, F.col(key).eqNullSafe(F.col("__of")) & (F.col("__in") == F.col("__part")))
    return placed.withColumn("place", F.col("__line") - F.col("__begin") + F.col("__ahead")).select(*rows.columns, "place")


def with_targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, words) with weight and target: ``share`` of all words by weight, a target at most ``most`` times its source."""
    ranked = numbered(sources, "source")
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = cut_lineage(ranked.withColumn("weight", pick).withColumn("limit", F.col("words") * F.lit(float(most))))
    total = share * (ranked.agg(F.sum("words")).first()[0] or 0)
    level, full = 0.0, -1
    while True:  # every round but the last fills at least one more source
        above = F.col("weight") * F.lit(level) > F.col("limit")
        row = ranked.agg(
            F.coalesce(F.sum(F.when(above, F.col("limit"))), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("open"),
            F.count(F.when(above, 1)).alias("full"),
        ).first()
        if row["full"] == full or not row["open"]:
            break
        level, full = (total - row["held"]) / row["open"], row["full"]
    return ranked.withColumn("target", F.least(F.col("limit"), F.col("weight") * F.lit(level)))


def _balance(sizes: DataFrame, sources: DataFrame, most: float) -> DataFrame:
    """(source_no, tilt) so that the rates' words meet the targets: guarded Newton on the convex dual of all sources."""
    start = sources.where((F.col("words") > 0) & (F.col("target") < F.col("limit") - CLOSE))
    state = cut_lineage(start.select(
        "place", "target", (F.col("words") / F.col("filled")).alias("mean"), F.lit(0.0).alias("tilt"),
        F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"), F.lit(False).alias("done"),
    ))
    for _ in range(MOST_STEPS):
        z = F.col("size") / F.col("mean")
        p = 1 / (1 + F.exp(-F.col("tilt") * z))
        sums = sizes.join(state.where("not done"), "place").groupBy("place").agg(
            F.sum(F.col("n") * F.col("size") * most * p).alias("got"),
            F.sum(F.col("n") * F.col("size") * most * z * p * (1 - p)).alias("slope"),
        )
        gap = F.col("got") - F.col("target")
        done = F.col("done") | (F.abs(gap) <= CLOSE)
        low = F.when(gap < 0, F.greatest("low", "tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.least("high", "tilt")).otherwise(F.col("high"))
        moved = state.join(sums, "place", "left").select("place", "target", "mean", "tilt", F.coalesce(done, F.lit(True)).alias("done"), low.alias("low"), high.alias("high"), "slope", gap.alias("gap"))
        step = F.col("tilt") - F.col("gap") / F.col("slope")
        lower = F.when(F.col("low") == float("-inf"), F.least(F.col("high") * 2, F.col("high") - 1)).otherwise(F.col("low"))
        upper = F.when(F.col("high") == float("inf"), F.greatest(F.col("low") * 2, F.col("low") + 1)).otherwise(F.col("high"))
        guarded = F.when((F.col("slope") > 0) & (step > lower) & (step < upper), step).otherwise((lower + upper) / 2)
        state = cut_lineage(moved.select("place", "target", "mean", F.when(F.col("done"), F.col("tilt")).otherwise(guarded).alias("tilt"), "low", "high", "done"))
        if state.where("not done").isEmpty():
            return state.select("place", "tilt")
    raise RuntimeError(f"rates did not meet the targets in {MOST_STEPS} steps")


def _rounded(rows: pd.DataFrame) -> pd.DataFrame:
    """Copies for the rates of a bucket: large documents first, each to the side that keeps the bucket's words closest."""
    rows = rows.sort_values(["size", "draw"], ascending=[False, True], kind="stable")
    copies, ahead = [], 0.0
    for size, rate in zip(rows["size"].tolist(), rows["rate"].tolist()):
        down = math.floor(rate)
        miss = ahead - rate * size
        up = abs(miss + (down + 1) * size) < abs(miss + down * size) and rate > down
        copies.append(down + up)
        ahead = miss + copies[-1] * size
    return rows.assign(copies=copies)[["id", "row", "size", "place", "rate", "copies"]]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, row_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: id, size, source, source_size, target, rate, copies, taken; row, if ``row_col`` names a long column.

    Size counts the words of a text, 0 if it is null or empty. Sources in code point order, null (a source of its own)
    last, weigh ``weights`` in turn and share ``share`` times all words; a target stops at ``most`` times its source,
    the excess is shared again. Rates are rounded to whole copies, so that taken = copies * size is at most ``most`` times
    the size and each source comes near its target. Draws for ties hang on the id and, where it is repeated or null,
    on the place among its rows by source and size, so reruns agree; repeated rows are rows of their own. A document without words is taken 0 times. Other columns are not looked at; an empty table gives
    an empty result.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
    row = F.lit(None) if row_col is None else F.col(row_col)
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), row.cast("long").alias("row"))
    sized = cut_lineage(sized.withColumn("salt", F.monotonically_increasing_id()))
    repeated = cut_lineage(sized.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("id").alias("again")))
    if repeated.isEmpty():
        sized = sized.withColumn("turn", F.lit(0).cast("long"))
    else:
        joined = cut_lineage(sized.join(repeated, F.col("id").eqNullSafe(F.col("again")), "left").withColumn("once", F.col("again").isNull() & F.col("id").isNotNull()).drop("again"))
        alone = joined.where("once").withColumn("turn", F.lit(0).cast("long"))
        turns = numbered_within(joined.where("not once"), "id", [F.col("source").asc_nulls_last(), F.col("size").asc(), F.col("salt").asc()])
        sized = cut_lineage(alone.unionByName(turns.withColumnRenamed("place", "turn")).drop("once"))
    sources = sized.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("n"), F.count(F.when(F.col("size") > 0, 1)).alias("filled"))
    aims = cut_lineage(with_targets(cut_lineage(sources), weights, share, most))
    same = F.col("source").eqNullSafe(F.col("of"))
    keys = aims.select(F.col("source").alias("of"), "place", "n", "words", "target", "limit", "filled")
    histogram = cut_lineage(sized.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")).join(keys.select("of", "place"), same).select("place", "size", "n"))
    tilts = _balance(histogram, aims, most)
    placed = keys.join(tilts, "place", "left")
    z = F.col("size") / (F.col("words") / F.col("filled"))
    rate = F.when(F.col("size") == 0, 0.0).when(F.col("tilt").isNull(), float(most)).otherwise(most / (1 + F.exp(-F.col("tilt") * z)))
    rows = sized.join(placed, same).select(
        "id", "row", "size", "place", rate.alias("rate"), F.when(F.col("turn") == 0, F.xxhash64("id")).otherwise(F.xxhash64("id", "turn")).alias("draw"),
        F.pmod(F.when(F.col("turn") == 0, F.xxhash64("id", F.lit(5))).otherwise(F.xxhash64("id", "turn", F.lit(5))), F.ceil(F.col("n") / BUCKET_ROWS)).alias("bucket"),
    )
    id_type = sized.schema["id"].dataType.simpleString()
    done = rows.groupBy("place", "bucket").applyInPandas(_rounded, f"id {id_type}, row long, size long, place long, rate double, copies int")
    return done.join(aims.select("place", "source", F.col("words").alias("source_size"), "target"), "place").select(
        *(["row"] if row_col is not None else []), "id", "size", "source", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )
