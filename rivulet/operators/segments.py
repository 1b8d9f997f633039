"""Ordered work per key that does not hang on one task when one key is huge.

A window function over ``PARTITION BY key ORDER BY time`` sorts a whole key in
one task. Here a key with more than ``Skew.hot_rows`` rows is cut along its
order into segments; a segment is sorted by one task. What a segment needs from
the others (totals before it, a few rows after it) is made from a small table
per segment and put among its rows as extra rows, so nothing is joined to the
rows. Keys below the limit stay in one piece and cost nothing extra but the
count that finds the hot ones.

Where a row falls depends on the row alone, so a lost executor's work can be
redone at any time and gives the same segments.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.functions.time import micros

PIECES = ("_s0", "_s1", "_s2", "_s3")  # a segment's number, compared piece by piece
HOT, MARK = "_hot", "_segment_row"
GROUP = 1024  # blocks whose totals are put in order by one task
FAN = 16  # parts of a cell that is too dense


@dataclass(frozen=True)
class Skew:
    """Sizes above which a key is cut.

    ``segment_rows`` bounds the rows of a segment along a unique arrival number.
    ``levels`` are the time steps that cut a hot key along event time; a step
    that still holds more than ``hot_rows`` rows is cut by the next finer one,
    at last by the microsecond and then by the arrival number.
    """

    hot_rows: int = 4_000_000
    segment_rows: int = 1_000_000
    levels: tuple[timedelta, ...] = field(default=(timedelta(hours=1), timedelta(seconds=1)))

    @property
    def sample_every(self) -> int:
        """Rows are counted 1 in n, so that a hot key shows up some 4000 times."""
        return max(1, self.hot_rows // 4096)


DEFAULT = Skew()


@dataclass(frozen=True)
class Order:
    """Order of a key's rows: by ``ts`` then ``seq``, or by ``seq`` alone. ``seq`` is unique."""

    seq: str
    ts: str | None = None

    @property
    def columns(self) -> list[str]:
        return [self.ts, self.seq] if self.ts else [self.seq]


def sampled(df: DataFrame, seq: str, skew: Skew) -> DataFrame:
    """A fixed 1-in-n choice of rows. It decides how work is cut, never what is in a result."""
    every = skew.sample_every
    return df if every == 1 else df.where(F.pmod(F.xxhash64(seq), F.lit(every)) == 0)


def heavy(counts: DataFrame, ids: list[str], skew: Skew) -> DataFrame:
    """Ids with more than ``hot_rows`` rows, from counts ``n`` of sampled rows.

    At most rows / hot_rows of them, a few longs each, so they can be broadcast.
    """
    totals = counts.groupBy(*ids).agg(F.sum("n").alias("n"))
    return totals.where(F.col("n") > skew.hot_rows // skew.sample_every).select(*ids)


def integer_steps(value: Column, step: int) -> Column:
    return F.call_function("div", value.cast("bigint"), F.lit(step).cast("bigint"))


def cut(df: DataFrame, keys: list[str], order: Order, skew: Skew | None = DEFAULT) -> DataFrame:
    """Add the segment's ``PIECES``, ascending along the order, and ``_hot``.

    Without keys the whole input is one hot key. A frame that is already cut,
    which must be by the same keys and order, is taken as it is.
    """
    if HOT in df.columns:
        return df
    zero = F.lit(0).cast("bigint")
    if skew is None:
        return df.select("*", *(zero.alias(p) for p in PIECES), F.lit(False).alias(HOT))
    block = integer_steps(F.col(order.seq), skew.segment_rows)
    if keys and not order.ts:
        return _cut_along_own_range(df, keys, order, skew, block)
    steps = skew.levels[:2] if order.ts else ()
    us = F.unix_micros(F.col(order.ts).cast("timestamp")) if order.ts else zero
    ids = {"_id": F.xxhash64(*keys) if keys else zero}
    ids |= {f"_grain{i}": integer_steps(us, micros(step)) for i, step in enumerate(steps)}

    out = df.select("*", *(c.alias(n) for n, c in ids.items()))
    if keys or steps:
        # One pruned pass counts the sample by the finest id; coarser counts are sums of these.
        counts = sampled(df, order.seq, skew).select(*(c.alias(n) for n, c in ids.items()))
        counts = counts.groupBy(*ids).agg(F.count(F.lit(1)).alias("n"))

    def flagged(frame: DataFrame, by: list[str], name: str) -> DataFrame:
        found = F.broadcast(heavy(counts, by, skew).withColumn(name, F.lit(True)))
        return frame.join(found, by, "left").withColumn(name, F.coalesce(name, F.lit(False)))

    out = flagged(out, ["_id"], HOT) if keys else out.withColumn(HOT, F.lit(True))
    dense, parts, names = F.col(HOT), [], list(ids)
    for i in range(len(steps)):
        parts.append(F.when(dense, F.col(f"_grain{i}")).otherwise(zero))
        out = flagged(out, names[: i + 2], f"_dense{i}")
        dense = dense & F.col(f"_dense{i}")
    if steps:
        parts.append(F.when(dense, us).otherwise(zero))
    parts.append(F.when(dense, block).otherwise(zero))
    parts = [*parts, zero, zero, zero][:4]
    return out.select(*df.columns, *(c.alias(p) for c, p in zip(parts, PIECES)), HOT)


def _cut_along_own_range(df: DataFrame, keys: list[str], order: Order, skew: Skew, block: Column) -> DataFrame:
    """Cut hot keys along an arrival number: each into cells of its own width, so that a key whose rows lie far apart among
    others gets segments of about ``segment_rows`` rows of its own, not one per block of all rows.

    A cell that holds more than ``hot_rows`` rows all the same is cut into ``FAN`` parts, such a part again, and what is
    still too dense then into blocks of all rows, which hold ``segment_rows`` at most.
    """
    zero, seq = F.lit(0).cast("bigint"), F.col(order.seq).cast("bigint")
    limit = skew.hot_rows // skew.sample_every
    out = df.withColumn("_id", F.xxhash64(*keys))
    # One pruned pass counts the sample by key and block; all that follows is made from these counts.
    sample = sampled(out, order.seq, skew).select("_id", seq.alias("_seq"), block.alias("_block"))
    blocks = sample.groupBy("_id", "_block").agg(
        F.count(F.lit(1)).alias("n"), F.min("_seq").alias("_first"), F.max("_seq").alias("_last")
    )
    spans = blocks.groupBy("_id").agg(F.sum("n").alias("n"), F.min("_first").alias("_low"), F.max("_last").alias("_high"))
    cells = F.greatest(F.lit(1), integer_steps(F.col("n") * skew.sample_every, skew.segment_rows)).cast("bigint")
    width = F.call_function("div", F.col("_high") - F.col("_low"), cells) + 1
    hot = spans.where(F.col("n") > limit).select("_id", "_low", width.alias("_width"))

    def placed(frame: DataFrame, seq: Column, how: str) -> DataFrame:
        # Rows that the sample did not see may lie before the first or after the last cell; order is kept there too.
        frame = frame.join(F.broadcast(hot), "_id", how).withColumn("_from", seq - F.col("_low"))
        frame = frame.withColumn("_within", F.pmod("_from", "_width"))
        frame = frame.withColumn("_cell", F.call_function("div", F.col("_from") - F.col("_within"), F.col("_width")))
        part = integer_steps(F.col("_width"), FAN) + 1
        frame = frame.withColumn("_part", F.call_function("div", F.col("_within"), part))
        finer = F.call_function("div", F.pmod("_within", part), integer_steps(part, FAN) + 1)
        return frame.withColumn("_finer", F.col("_part") * FAN + finer)

    counts = placed(blocks.drop("_last"), F.col("_first"), "inner")
    counts = counts.withColumnRenamed("n", "_n").groupBy("_id", "_cell", "_part", "_finer").agg(F.sum("_n").alias("n"))
    parts = counts.groupBy("_id", "_cell", "_part").agg(
        F.sum("n").alias("n"), F.collect_list(F.when(F.col("n") > limit, F.col("_finer"))).alias("_finers")
    )
    dense = parts.groupBy("_id", "_cell").agg(
        F.sum("n").alias("n"),
        F.collect_list(F.when(F.col("n") > limit, F.col("_part"))).alias("_parts"),
        F.flatten(F.collect_list("_finers")).alias("_finers"),
    )
    dense = dense.where(F.col("n") > limit).drop("n")
    out = placed(out, seq, "left").join(F.broadcast(dense), ["_id", "_cell"], "left")
    in_cell = F.col("_parts").isNotNull()
    in_part = in_cell & F.array_contains("_parts", F.col("_part"))
    in_finer = in_part & F.array_contains("_finers", F.col("_finer"))
    pieces = [
        F.coalesce("_cell", zero),
        F.when(in_cell, F.col("_part")).otherwise(zero),
        F.when(in_part, F.col("_finer")).otherwise(zero),
        F.when(in_finer, block).otherwise(zero),
    ]
    return out.select(*df.columns, *(c.alias(p) for c, p in zip(pieces, PIECES)), F.col("_low").isNotNull().alias(HOT))


def _before(totals: DataFrame, keys: list[str], order: Order, columns: list[str], merge: list) -> DataFrame:
    """Each segment's totals of all segments before it.

    In two steps, so that no task orders all segments of a key: first over groups of ``GROUP`` blocks, or of one coarsest
    step of time, then within a group, which begins with a row that holds the totals of the groups before it.
    """
    first = F.col(PIECES[0])
    totals = totals.withColumn("_group", first if order.ts else integer_steps(first, GROUP))
    groups = totals.groupBy(*keys, "_group").agg(*(f(n).alias(n) for f, n in zip(merge, columns)))
    along = Window.partitionBy(*keys).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    heads = groups.select(*keys, "_group", F.lit(0).alias(MARK), *(f(n).over(along).alias(n) for f, n in zip(merge, columns)))
    rows = totals.withColumn(MARK, F.lit(1)).unionByName(heads, allowMissingColumns=True)
    within = Window.partitionBy(*keys, "_group").orderBy(MARK, *PIECES).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(*keys, *PIECES, MARK, *(f(n).over(within).alias(n) for f, n in zip(merge, columns)))
    return rows.where(F.col(MARK) == 1).drop(MARK)


@dataclass(frozen=True)
class Running:
    """One running measure: ``kind`` is sum, count, max, min or last (non-null).

    It covers the rows up to and including the current one, or with ``before``
    only the earlier ones.
    """

    name: str
    kind: str
    column: Column | str | None = None
    before: bool = False


_MERGE = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min, "last": F.max}


def _input(measure: Running, order: Order) -> Column:
    """A row's own contribution; contributions and totals merge alike."""
    value = F.col(measure.column) if isinstance(measure.column, str) else measure.column
    if measure.kind == "count":
        return F.lit(1).cast("bigint") if value is None else value.isNotNull().cast("bigint")
    if measure.kind == "last":
        return F.when(value.isNotNull(), F.struct(*order.columns, value.alias("value")))
    return value


def running(
    df: DataFrame, keys: list[str], order: Order, measures: list[Running], skew: Skew | None = DEFAULT
) -> DataFrame:
    """Every row with running measures over its key.

    One shuffle by (key, segment). A hot key's segment starts with a row that
    holds the totals of the segments before it.
    """
    inputs = [f"_in{i}" for i in range(len(measures))]
    merge = [_MERGE[m.kind] for m in measures]
    group = [*keys, *PIECES]
    parts = cut(df, keys, order, skew)
    rows = parts.select("*", *(_input(m, order).alias(n) for m, n in zip(measures, inputs)), F.lit(1).alias(MARK))
    if skew is not None:
        totals = rows.where(HOT).groupBy(*group).agg(*(f(n).alias(n) for f, n in zip(merge, inputs)))
        carried = _before(totals, keys, order, inputs, merge)
        rows = rows.unionByName(carried.withColumn(MARK, F.lit(0)), allowMissingColumns=True)
    local = Window.partitionBy(*group).orderBy(MARK, *order.columns)
    results = []
    for m, f, n in zip(measures, merge, inputs):
        value = f(n).over(local.rowsBetween(Window.unboundedPreceding, -1 if m.before else 0))
        if m.kind == "count":
            value = F.coalesce(value, F.lit(0).cast("bigint"))
        results.append((value["value"] if m.kind == "last" else value).alias(m.name))
    return rows.select(*df.columns, MARK, *results).where(F.col(MARK) == 1).drop(MARK)


def neighbours(
    df: DataFrame,
    keys: list[str],
    order: Order,
    wanted: dict[str, tuple[str, int]],
    skew: Skew | None = DEFAULT,
) -> DataFrame:
    """Every row with columns of the rows ``offset`` places after it (before it, if negative).

    ``wanted`` maps an output name to (column, offset); the offsets have one sign.
    A hot key's segment ends with copies of the first rows that follow it.
    """
    after = next(iter(wanted.values()))[1] > 0
    reach = max(abs(offset) for _, offset in wanted.values())

    def along(columns: list[str]) -> list[Column]:
        return [F.col(c).asc() if after else F.col(c).desc() for c in columns]

    group = [*keys, *PIECES]
    sources = [c for c in dict.fromkeys(column for column, _ in wanted.values()) if c not in keys]
    parts = cut(df, keys, order, skew)
    rows = parts.withColumn(MARK, F.lit(0))
    if skew is not None:
        within = Window.partitionBy(*group).orderBy(*along(order.columns))
        heads = (
            parts.where(HOT)
            .select(*group, F.struct(*sources, F.lit(0)).alias("_row"), F.row_number().over(within).alias("_rank"))
            .where(F.col("_rank") <= reach)
        )
        next_rows = Window.partitionBy(*keys).orderBy(*along(list(PIECES)), "_rank")
        heads = heads.select(
            *group, "_rank", F.array(*(F.lead("_row", k).over(next_rows) for k in range(reach))).alias("_rows")
        ).where(F.col("_rank") == 1)
        next_segment = Window.partitionBy(*keys).orderBy(*along(list(PIECES)))
        copies = heads.select(*group, F.lead("_rows", 1).over(next_segment).alias("_rows"))
        copies = copies.select(*group, F.posexplode("_rows").alias("_at", "_row")).where(F.col("_row").isNotNull())
        copies = copies.select(
            *group, *(F.col("_row")[c].alias(c) for c in sources), (F.col("_at") + 1).alias(MARK)
        )
        rows = rows.unionByName(copies, allowMissingColumns=True)
    local = Window.partitionBy(*group).orderBy(MARK, *along(order.columns))
    found = (F.lead(column, abs(offset)).over(local).alias(name) for name, (column, offset) in wanted.items())
    return rows.select(*df.columns, MARK, *found).where(F.col(MARK) == 0).drop(MARK)
