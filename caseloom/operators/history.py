"""Trailing history of a record, without ever pairing a record with its history.

A plain join emits (records x history rows) of a key, which is quadratic on a
heavy key. Here history is first folded per key and day, so what a window sees
of a key is bounded by the calendar, and each record reads its own day's result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions.parsing import MONEY
from caseloom.functions.skew import none_null, spread_join

Between = Callable[[DataFrame, str], DataFrame]


def as_is(df: DataFrame, name: str) -> DataFrame:
    return df


#: points of a cell of the grid that are paired with the rows asked near it; those of a fuller cell are counted without pairs
FEW = 32
#: cents in one range of amounts, the most rows of a key that a window sorts
RANGE = 1 << 16


def _day(name: str) -> Column:
    return F.unix_date(F.col(name))


def _dated(df: DataFrame, keys: Sequence[str], day: str, *more: Column) -> DataFrame:
    """(keys, _day, more) of the rows that can match: no null key or day."""
    return df.select(*keys, _day(day).alias("_day"), *more).where(none_null([*keys, "_day"]))


def trailing_metrics(
    current: DataFrame,
    history: DataFrame,
    keys: list[str],
    current_day: str,
    history_day: str,
    amount: str,
    names: tuple[str, str, str, str] = ("prior_count", "prior_amount", "last_prior_date", "mean_prior_amount"),
    days: int = fv.HISTORY_DAYS,
) -> DataFrame:
    """Count, sum, latest day and mean amount of the history in [day - days, day).

    Running totals up to yesterday minus running totals up to the day before the
    window: both frames grow only at the end, so the cost is linear in days.
    """
    return metrics_of_days(current, daily_facts(history, keys, history_day, amount), keys, current_day, names, days)


def daily_facts(history: DataFrame, keys: list[str], day: str, amount: str) -> DataFrame:
    """(keys, _day, _n, _sum, _known): rows, whole cents and known amounts of each row, which add up by day.

    Rows with a null key or day are left out.
    """
    # whole cents in a long add up exactly and fast; an overflow is an error, not a wrong sum
    cents = (F.col(amount).cast(MONEY) * 100).cast("long")
    return _dated(history, keys, day, F.lit(1).alias("_n"), cents.alias("_cents")).select(
        *keys, "_day", "_n", F.coalesce("_cents", F.lit(0)).alias("_sum"), F.col("_cents").isNotNull().cast("int").alias("_known")
    )


def metrics_of_days(
    current: DataFrame, facts: DataFrame, keys: list[str], current_day: str, names: tuple[str, str, str, str], days: int
) -> DataFrame:
    """``trailing_metrics`` from ``daily_facts``, whole or already added up by day."""
    facts = facts.withColumn("_asked", F.lit(0))
    asked = _dated(current, keys, current_day).withColumns(
        {"_n": F.lit(0), "_sum": F.lit(0).cast("long"), "_known": F.lit(0), "_asked": F.lit(1)}
    )
    daily = (
        facts.unionByName(asked)
        .groupBy(*keys, "_day")
        .agg(
            F.sum("_n").alias("_n"),
            F.sum("_sum").alias("_sum"),
            F.sum("_known").alias("_known"),
            F.max("_asked").alias("_asked"),
        )
    )
    line = Window.partitionBy(*keys).orderBy("_day")
    before = line.rangeBetween(Window.unboundedPreceding, -1)
    expired = line.rangeBetween(Window.unboundedPreceding, -(days + 1))

    def within(c: str) -> Column:
        return F.coalesce(F.sum(c).over(before), F.lit(0)) - F.coalesce(F.sum(c).over(expired), F.lit(0))

    last = F.max(F.when(F.col("_n") > 0, F.col("_day"))).over(before)
    count, total, last_day, mean = names
    known = F.col("_kn")
    per_day = (
        daily.withColumns({count: within("_n"), "_total": within("_sum"), "_kn": within("_known"), "_last": last})
        .where("_asked = 1")
        .select(
            *keys,
            "_day",
            count,
            (F.col("_total").cast("decimal(20,0)") / 100).cast(MONEY).alias(total),
            F.when(F.col("_last") >= F.col("_day") - days, F.date_from_unix_date("_last")).alias(last_day),
            F.when(known > 0, F.col("_total") / F.lit(100.0) / known).alias(mean),
        )
    )
    joined = spread_join(current.withColumn("_day", _day(current_day)), per_day, [*keys, "_day"]).drop("_day")
    return joined.withColumns(
        {count: F.coalesce(F.col(count), F.lit(0)), total: F.coalesce(F.col(total), F.lit(0).cast(MONEY))}
    )


def recent_evidence(
    current: DataFrame,
    history: DataFrame,
    keys: list[str],
    current_day: str,
    history_day: str,
    id_col: str,
    payload: Sequence[str] = (),
    out: str = "historical_evidence",
    n: int = fv.RECENT_EVIDENCE,
    days: int = fv.HISTORY_DAYS,
) -> DataFrame:
    """Array of the ``n`` latest history rows in [day - days, day), newest first, then by id and payload.

    Only the first ``n`` rows of a (key, day) can matter and only the last ``n``
    of those up to a day, so every array and every frame here holds at most ``n``.
    """
    item = F.struct(id_col, history_day, *payload)
    ranked = Window.partitionBy(*keys, "_day").orderBy("_item")
    per_day = (
        _dated(history, keys, history_day, item.alias("_item"))
        .withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") <= n)
        .groupBy(*keys, "_day")
        .agg(F.sort_array(F.collect_list("_item")).alias("_items"))
    )
    line = Window.partitionBy(*keys).orderBy("_day")
    newest_first = F.flatten(F.reverse(F.collect_list("_items").over(line.rowsBetween(1 - n, 0))))
    latest = per_day.select(*keys, "_day", F.slice(newest_first, 1, n).alias("_latest"))
    asked = _dated(current, keys, current_day).distinct()
    seen = (
        latest.withColumn("_asked", F.lit(False))
        .unionByName(asked.withColumn("_asked", F.lit(True)), allowMissingColumns=True)
        .withColumn(out, F.last("_latest", ignorenulls=True).over(line.rangeBetween(Window.unboundedPreceding, -1)))
        .where("_asked")
        .select(*keys, "_day", out)
    )
    joined = spread_join(current.withColumn("_day", _day(current_day)), seen, [*keys, "_day"])
    oldest = F.date_from_unix_date(F.col("_day") - days)
    kept = F.filter(F.col(out), lambda x: x[history_day].cast("date") >= oldest)
    empty = F.array().cast(joined.schema[out].dataType)
    return joined.withColumn(out, F.coalesce(kept, empty)).drop("_day")


def trailing_distinct(
    current: DataFrame,
    history: DataFrame,
    keys: list[str],
    current_day: str,
    history_day: str,
    id_col: str,
    out: str = "prior_distinct_count",
    days: int = fv.HISTORY_DAYS,
) -> DataFrame:
    """Add the number of distinct history ids in [day - days, day); null ids do not count.

    An occurrence counts on the days of the window after it, so occurrences are
    counted per day and running totals subtracted, as ``trailing_metrics`` has
    it. From the day after its next occurrence an id would count twice until the
    earlier one leaves the window: a step down and one up, for such ids alone.
    """
    seen = _dated(history, keys, history_day, F.col(id_col).alias("_id")).where(F.col("_id").isNotNull()).distinct()
    none = F.lit(0)
    counted = _counted(seen, keys, days).withColumn("_asked", none)
    asked = _dated(current, keys, current_day).withColumns({"_n": none, "_step": none, "_asked": F.lit(1)})
    daily = (
        counted.unionByName(asked)
        .groupBy(*keys, "_day")
        .agg(F.sum("_n").alias("_n"), F.sum("_step").alias("_step"), F.max("_asked").alias("_asked"))
    )
    line = Window.partitionBy(*keys).orderBy("_day")
    before = F.sum("_n").over(line.rangeBetween(Window.unboundedPreceding, -1))
    expired = F.sum("_n").over(line.rangeBetween(Window.unboundedPreceding, -(days + 1)))
    twofold = F.sum("_step").over(line.rowsBetween(Window.unboundedPreceding, 0))
    found = F.coalesce(before, none) - F.coalesce(expired, none) + twofold
    per_day = daily.withColumn(out, found).where("_asked = 1").select(*keys, "_day", out)
    joined = spread_join(current.withColumn("_day", _day(current_day)), per_day, [*keys, "_day"]).drop("_day")
    return joined.withColumn(out, F.coalesce(out, F.lit(0).cast("long")))


def _counted(seen: DataFrame, keys: list[str], days: int) -> DataFrame:
    """(keys, _day, _n, _step): one row per occurrence, and two more for one whose id occurs again before it leaves the window."""

    def row(day: Column, n: int, step: int) -> Column:
        return F.struct(day.alias("_day"), F.lit(n).alias("_n"), F.lit(step).alias("_step"))

    again = F.lead("_day").over(Window.partitionBy(*keys, "_id").orderBy("_day"))
    day, leaves = F.col("_day"), F.col("_day") + days
    twice = F.array(row(day, 1, 0), row(F.col("_again") + 1, 0, -1), row(leaves + 1, 0, 1))
    rows = F.when(F.col("_again") < leaves, twice).otherwise(F.array(row(day, 1, 0)))
    return seen.withColumn("_again", again).select(*keys, F.inline(rows))


def _distinct_steps(seen: DataFrame, by: list[str], days: int) -> DataFrame:
    """(by, _day, _step): up on the day from which an id of ``seen`` (by, _id, _day) counts, down on that from which it does not."""
    again = F.lead("_day").over(Window.partitionBy(*by, "_id").orderBy("_day"))
    stop = F.least(F.coalesce(again, F.col("_day") + days), F.col("_day") + days) + 1
    return seen.withColumn("_stop", stop).select(
        *by,
        F.inline(
            F.array(
                F.struct((F.col("_day") + 1).alias("_day"), F.lit(1).alias("_step")),
                F.struct(F.col("_stop").alias("_day"), F.lit(-1).alias("_step")),
            )
        ),
    )


def distinct_counts(
    lines: DataFrame,
    history: DataFrame,
    keys: list[str],
    mine: tuple[str, str],
    theirs: tuple[str, str],
    out: str,
    days: int = fv.HISTORY_DAYS,
    between: Between = as_is,
) -> DataFrame:
    """(id, count) of the distinct history ids in [day - days, day) under any key of the id's lines.

    ``mine`` and ``theirs`` name (id, day); an id of ``lines`` has one day and
    each key once. ``between`` may write what is used several times, see
    ``sources.lineage.cut``. Then ids whose keys all have at most ``FEW``
    occurrences are counted by pairing their lines with those, so no line is
    paired with more, and only the others by ``_distinct_by_day``, without pairs.
    """
    my_id, my_day = mine
    their_id, their_day = theirs
    past = history.where(none_null([*keys, their_id, their_day])).select(*keys, their_id, their_day).distinct()
    if between is as_is:
        return _distinct_by_day(lines, past, keys, mine, theirs, out, days, between)
    past = between(past, "past_ids")
    many = between(past.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > FEW).select(*keys), "busy_keys")
    busy = between(lines.where(F.col(my_day).isNotNull()).join(many, keys, "left_semi").select(my_id).distinct(), "busy_ids")
    swept = lines.join(busy, my_id, "left_semi")
    of_swept = past.join(swept.select(*keys).distinct(), keys, "left_semi")
    counted = _distinct_by_day(swept, of_swept, keys, mine, theirs, "_hits", days, between)
    asked = _dated(lines.join(busy, my_id, "left_anti"), keys, my_day, F.col(my_id).alias("_id"))
    seen = past.select(*keys, _day(their_day).alias("_when"), F.col(their_id).alias("_other"))
    within = (F.col("_when") < F.col("_day")) & (F.col("_when") >= F.col("_day") - days)
    met = asked.join(seen, keys).where(within).select("_id", "_other").distinct()
    paired = met.groupBy(F.col("_id").alias(my_id)).agg(F.count(F.lit(1)).alias("_hits"))
    none = lines.select(my_id, F.lit(0).cast("long").alias("_hits"))
    return none.unionByName(paired).unionByName(counted).groupBy(my_id).agg(F.sum("_hits").alias(out))


def _distinct_by_day(
    lines: DataFrame,
    past: DataFrame,
    keys: list[str],
    mine: tuple[str, str],
    theirs: tuple[str, str],
    out: str,
    days: int,
    between: Between,
) -> DataFrame:
    """``distinct_counts`` where no line meets a row of history.

    What each line finds is counted per key by ``trailing_distinct`` and added
    up. An id of history that is under several keys of one set of lines was then
    counted once per key: ``_overcounts`` has by how much, per set of keys and day.
    """
    my_id, my_day = mine
    their_id, their_day = theirs
    each = trailing_distinct(lines.select(my_id, *keys, my_day), past, keys, my_day, their_day, their_id, "_hits")
    summed = each.groupBy(F.col(my_id).alias("_id")).agg(F.sum("_hits").alias("_hits"))

    asked = _dated(lines, keys, my_day, F.col(my_id).alias("_id"), F.struct(*keys).alias("_key")).drop(*keys)
    # the same for the same set of keys, in whatever order they come: 128 bits of sums, so no list is gathered
    first, second = (F.sum(F.xxhash64(F.lit(seed), "_key").cast("decimal(38,0)")) for seed in (1, 2))
    own = asked.groupBy("_id", "_day").agg(F.count(F.lit(1)).alias("_size"), first.alias("_h1"), second.alias("_h2"))
    own = between(own.where("_size > 1").select("_id", "_day", F.struct("_size", "_h1", "_h2").alias("_set")), "line_sets")
    sets = asked.join(own, ["_id", "_day"]).select("_set", "_key").distinct()
    seen = _dated(past, keys, their_day, F.col(their_id).alias("_other"), F.struct(*keys).alias("_key")).drop(*keys)
    over = _overcounts(sets, own.select("_set", "_day").distinct(), between(seen, "past_days"), days, between)
    corrected = own.join(over, ["_set", "_day"]).select("_id", (-F.col("_over")).alias("_hits"))
    return summed.unionByName(corrected).groupBy(F.col("_id").alias(my_id)).agg(F.sum("_hits").alias(out))


def _overcounts(sets: DataFrame, asked: DataFrame, seen: DataFrame, days: int, between: Between = as_is) -> DataFrame:
    """(_set, _day, _over): how often ids that count under several keys of a set count too often, for each day asked.

    ``sets`` has (_set, _key), ``seen`` (_key, _other, _day). An id under
    several keys of a set is under one besides the set's most frequent, so only
    the ids of the others are listed, and looked up under that one. For what is
    found, occurrences per key step up and down as ``trailing_distinct`` has
    them, those of the set as a whole the other way, and a running sum over the
    days of a set is the surplus.
    """
    under = seen.select("_key", "_other").distinct()
    sizes = under.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    sized = sets.join(sizes, "_key")
    most = sized.groupBy("_set").agg(F.max(F.struct("_n", "_key"))["_key"].alias("_most"))
    listed = sized.join(most, "_set").where(F.col("_key") != F.col("_most"))
    rare = listed.select("_set", "_key", "_most").join(under, "_key")
    found = rare.select("_set", F.col("_most").alias("_key"), "_other").distinct().join(under, ["_key", "_other"])
    both = rare.select("_set", "_key", "_other").unionByName(found.select("_set", "_key", "_other"))
    several = both.withColumn("_keys", F.count(F.lit(1)).over(Window.partitionBy("_set", "_other"))).where("_keys > 1")
    points = several.select("_set", "_key", "_other").join(seen, ["_key", "_other"])
    points = between(points.select("_set", "_key", F.col("_other").alias("_id"), "_day"), "shared_ids")
    per_key = _distinct_steps(points, ["_set", "_key"], days).select("_set", "_day", "_step")
    whole = _distinct_steps(points.select("_set", "_id", "_day").distinct(), ["_set"], days)
    steps = per_key.unionByName(whole.withColumn("_step", -F.col("_step"))).withColumn("_asked", F.lit(0))
    daily = (
        steps.unionByName(asked.withColumns({"_step": F.lit(0), "_asked": F.lit(1)}))
        .groupBy("_set", "_day")
        .agg(F.sum("_step").alias("_step"), F.max("_asked").alias("_asked"))
    )
    line = Window.partitionBy("_set").orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("_over", F.sum("_step").over(line)).where("_asked = 1 AND _over > 0").select("_set", "_day", "_over")


def near_duplicate_counts(
    current: DataFrame,
    history: DataFrame,
    keys: list[str],
    mine: tuple[str, str, str],
    theirs: tuple[str, str, str],
    out: str = "candidate_duplicate_count",
    days: int = fv.DUPLICATE_DAYS,
    tolerance: str = fv.DUPLICATE_TOLERANCE,
    own_id: str | None = None,
    between: Between = as_is,
) -> DataFrame:
    """(id, count) of the distinct history ids near a current row, for ids with at least one.

    Near: equal keys, days apart by at most ``days``, amounts apart by at most
    ``tolerance`` times the current amount, and an id that is not ``own_id`` (by
    default the current id). ``mine`` and ``theirs`` name (id, day, amount). A
    null history id never counts, a null own id excludes nothing. A current id
    may have several rows with different keys; a history id near several counts once.

    A grid of (key, block of days, band of amounts) first tells which rows have
    any but themselves near: no other can count. Cells of at most ``FEW`` points
    are joined with what is asked near them. In fuller cells, history that has
    an id once is counted by ``_swept``, without pairs.
    An id with several keys, days or amounts must count once for all of them,
    which counting points cannot tell (colours in two dimensions); those points
    are joined within their cell as well and made distinct. ``between`` may write what is used
    several times, see ``sources.lineage.cut``.
    """
    my_id, my_day, my_amount = mine
    their_id, their_day, their_amount = theirs
    probes = _dated(
        current,
        keys,
        my_day,
        F.col(my_id).alias("_id"),
        F.col(own_id or my_id).alias("_own"),
        F.col(my_amount).cast("decimal(18,4)").alias("_amount"),
    ).where(F.col("_amount") >= 0)
    slack = F.col("_amount") * F.lit(Decimal(tolerance))
    # history amounts are whole cents, so the bounds may be
    low = F.ceil((F.col("_amount") - slack) * 100).cast("long")
    high = F.floor((F.col("_amount") + slack) * 100).cast("long")
    probes = probes.withColumns({"_low": low, "_high": high}).drop("_amount")
    cents = (F.col(their_amount).cast(MONEY) * 100).cast("long")
    points = _dated(history, keys, their_day, F.col(their_id).alias("_other"), cents.alias("_cents"))
    points = points.where(none_null(["_other", "_cents"])).withColumnRenamed("_day", "_when")
    probes, points = _near_cells(probes.where("_low <= _high"), points, keys, days, tolerance, between)
    box = ["_block0", "_block1", "_band0", "_band1"]
    times = points.groupBy("_other").agg(
        F.count(F.lit(1)).alias("_times"), F.min(F.struct(*[c for c in points.columns if c != "_other"])).alias("_point")
    )
    single = between(times.where("_times = 1").select("_other", "_point.*"), "near_once")
    several = points.join(times.where("_times > 1").select("_other"), "_other").withColumn("_once", F.lit(False))
    paired = single.where("NOT _full").withColumn("_once", F.lit(True)).unionByName(several)
    once = single.where("_full").drop("_full", "_block", "_band")
    near = (F.abs(F.col("_when") - F.col("_day")) <= days) & F.col("_cents").between(F.col("_low"), F.col("_high"))

    probes_of_full = probes.where("_near_full").drop("_near_full")
    probes = probes.drop("_near_full")
    swept = _swept(probes_of_full.drop(*box), once, keys, days)
    # a probe that is itself in the history was counted with it
    renamed = once.select(F.col("_other").alias("_own"), "_when", "_cents", *[F.col(k).alias(f"_their_{k}") for k in keys])
    same_keys = reduce(and_, [F.col(k) == F.col(f"_their_{k}") for k in keys])
    itself = probes_of_full.join(renamed, "_own").where(same_keys & near).select("_id", F.lit(-1).cast("long").alias("_hits"))
    # an id of one point counts for each row asked, one of several points once
    hits = F.when(F.max("_once"), F.count(F.lit(1))).otherwise(F.lit(1).cast("long"))
    met = (
        _in_cells(probes).join(paired, [*keys, "_block", "_band"])
        .where(near & ~F.col("_own").eqNullSafe(F.col("_other")))
        .groupBy("_id", "_other")
        .agg(hits.alias("_hits"))
        .select("_id", "_hits")
    )
    return (
        swept.unionByName(itself)
        .unionByName(met)
        .groupBy(F.col("_id").alias(my_id))
        .agg(F.sum("_hits").alias(out))
        .where(F.col(out) > 0)
    )


def _near_cells(
    probes: DataFrame,
    points: DataFrame,
    keys: list[str],
    days: int,
    tolerance: str,
    between: Between,
) -> tuple[DataFrame, DataFrame]:
    """The probes and points with another one near in a grid, with the cells of each and whether one is full.

    A block has as many days as a probe reaches over, a band all amounts up to
    the ratio of a probe's bounds, so a probe lies over two blocks and bands, or
    three bands where rounding has it. Both sides are folded to cells before
    they meet; a cell knows the least and greatest id in it, which tells one
    that holds nothing but the probe itself. Ids are told apart by 128 bits
    there, so that cells are folded by hash and not by sorting text. Points may
    repeat; those returned are distinct.
    """
    width, part = 2 * days + 1, Decimal(tolerance)
    ratio = max(float((1 + part) / (1 - part)), 1.05) if part < 1 else None

    def band(cents: Column) -> Column:
        if ratio is None:
            return F.lit(0).cast("long")
        return F.when(cents > 0, F.floor(F.log(cents.cast("double")) / F.lit(math.log(ratio)))).otherwise(F.lit(-1).cast("long"))

    def block(day: Column) -> Column:
        return F.floor(day / width)

    points = points.withColumns({"_block": block(F.col("_when")), "_band": band(F.col("_cents"))})
    probes = probes.withColumns(
        {
            "_block0": block(F.col("_day") - days),
            "_block1": block(F.col("_day") + days),
            "_band0": band(F.col("_low")),
            "_band1": band(F.col("_high")),
        }
    )
    cell, box = [*keys, "_block", "_band"], [*keys, "_block0", "_block1", "_band0", "_band1"]

    def ends(name: str, prefix: str) -> list[Column]:
        digests = [F.xxhash64(F.lit(seed), F.col(name)) for seed in (1, 2)]
        return [fold(F.when(F.col(name).isNotNull(), d)).alias(f"{prefix}{fold.__name__}{i}") for i, d in enumerate(digests) for fold in (F.min, F.max)]

    cells = points.groupBy(*cell).agg(*ends("_other", "_of_"), (F.count(F.lit(1)) > FEW).alias("_full"))
    boxes = probes.groupBy(*box).agg(*ends("_own", "_by_"), F.max(F.col("_own").isNull()).alias("_nobody"))
    one = [F.col(f"_of_min{i}") == F.col(f"_{side}{fold}{i}") for i in (0, 1) for side, fold in (("of_", "max"), ("by_", "min"), ("by_", "max"))]
    alone = reduce(and_, one) & ~F.col("_nobody")
    met = _in_cells(boxes).join(cells, cell).where(~F.coalesce(alone, F.lit(False))).select(*box, "_block", "_band", "_full")
    met = between(met, "near_cells")
    probes = probes.join(met.groupBy(*box).agg(F.max("_full").alias("_near_full")), box)
    points = points.join(met.select(*cell, "_full").distinct(), cell).distinct()
    return between(probes, "near_probes"), between(points, "near_points")


def _in_cells(boxes: DataFrame) -> DataFrame:
    """One row for each cell of the grid that a row reaches over."""
    blocks = boxes.withColumn("_block", F.explode(F.sequence("_block0", "_block1")))
    return blocks.withColumn("_band", F.explode(F.sequence("_band0", "_band1")))


def _swept(probes: DataFrame, points: DataFrame, keys: list[str], days: int) -> DataFrame:
    """(_id, _hits) by counting points in a date x amount box, without pairs.

    Days are cut into blocks of 1, 2, 4 ... days. A point is counted in one
    block per size; a probe's date range is the union of a few whole blocks. In
    each block the count of points up to an amount is that of all lower ranges
    of amounts plus a running count inside its range. A range is ``RANGE``
    cents, so no window sees more than that many rows of a key, and points and
    questions are folded to one row per cent before.
    """
    sizes = range((2 * days + 1).bit_length())
    blocks = F.array(*[F.struct(F.lit(s).alias("_size"), F.shiftright("_when", s).alias("_block")) for s in sizes])
    placed = points.select(*keys, F.inline(blocks), F.col("_cents").alias("_at"), F.lit(1).alias("_n"))
    box = [*keys, "_day", "_low", "_high"]
    bounds = F.array(
        F.struct((F.col("_low") - 1).alias("_at"), F.lit(-1).alias("_sign")),
        F.struct(F.col("_high").alias("_at"), F.lit(1).alias("_sign")),
    )
    asked = (
        probes.where("_low <= _high")
        .select(*box)
        .distinct()
        .select(*box, F.explode(_cover(F.col("_day") - days, F.col("_day") + days + 1, sizes)).alias("_b"))
        .select(*box, "_b.*", F.explode(bounds).alias("_e"))
        .select(*box, "_size", "_block", "_e.*")
    )
    cell = [*keys, "_size", "_block"]
    cells = (
        placed.withColumn("_asked", F.lit(0))
        .unionByName(asked.select(*cell, "_at", F.lit(0).alias("_n"), F.lit(1).alias("_asked")))
        .groupBy(*cell, F.floor(F.col("_at") / RANGE).alias("_range"), "_at")
        .agg(F.sum("_n").alias("_n"), F.max("_asked").alias("_asked"))
    )
    lower = Window.partitionBy(*cell).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = cells.groupBy(*cell, "_range").agg(F.sum("_n").alias("_n"))
    totals = totals.select(*cell, "_range", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_below"))
    inside = Window.partitionBy(*cell, "_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    counts = (
        cells.withColumn("_inside", F.sum("_n").over(inside))
        .where("_asked = 1")
        .join(totals, [*cell, "_range"])
        .select(*cell, "_at", (F.col("_below") + F.col("_inside")).alias("_upto"))
    )
    hits = asked.join(counts, [*cell, "_at"]).groupBy(*box).agg(F.sum(F.col("_sign") * F.col("_upto")).alias("_hits"))
    return probes.join(hits, box).select("_id", "_hits")


def _cover(start: Column, end: Column, sizes: range) -> Column:
    """The fewest power-of-two blocks whose union is the days [start, end)."""
    parts = []
    for s in sizes:
        first, stop = F.shiftright(start + ((1 << s) - 1), s), F.shiftright(end, s)
        odd = lambda c: c.bitwiseAND(F.lit(1)) == 1
        for block, due in ((first, odd(first)), (stop - 1, odd(stop))):
            here = F.struct(F.lit(s).alias("_size"), block.alias("_block"))
            parts.append(F.when((first < stop) & due, here))
    return F.array_compact(F.array(*parts))
