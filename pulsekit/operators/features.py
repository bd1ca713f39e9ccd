"""Gap-checked lag features, the one-hot label block and the training matrix.

Semantics (row-based, as the source application computes them on a series
sorted by time): ``lag j`` of row i is the value of row i-j **only if** the
gap between the two rows, in units rounded half-to-even, is exactly j, and
row i-j is not the very first row of the series; otherwise null.  Rows with
any null lag are dropped.  So a row survives only after ``n_lags`` unbroken
preceding units.

Scale: a lag window over one long series without a partition key runs in a
single task.  Instead the series is cut into buckets of ``bucket_units`` time
units; each bucket is windowed on its own, after the last ``n_lags + 1``
units of the previous bucket have been copied in front of it (a halo).  Every
source a lag can legally use lies within ``n_lags + 0.5`` units, so the halo
holds all of them, and the copied rows are dropped afterwards.  The only
cross-bucket fact, "which row is the very first of the series", comes from a
one-row-per-series aggregate joined on the same (series, frame) key the
window partitions by, so the big side is shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.functions import SPORTS, clock_text, epoch_micros, one_hot_columns, time_as_int


def _bucket_of(t: Column, span_us: int) -> Column:
    return F.floor(t / F.lit(span_us))


def _frames_of(t: Column, bucket: Column, span_us: int, halo_us: int) -> Column:
    """Frame ids a row belongs to: its bucket, plus the next when in the halo."""
    in_halo = t >= (bucket + 1) * F.lit(span_us) - F.lit(halo_us)
    return F.when(in_halo, F.array(bucket, bucket + 1)).otherwise(F.array(bucket))


def _spans(n_lags: int, unit_seconds: int, bucket_units: int | None) -> tuple[int, int]:
    """Microseconds of a frame's bucket and of the halo before it."""
    unit_us = unit_seconds * 1_000_000
    span = bucket_units or max(1440, 2 * (n_lags + 1))
    if span < n_lags + 1:
        raise ValueError("bucket_units must be at least n_lags + 1")
    return span * unit_us, (n_lags + 1) * unit_us


def _framed(df: DataFrame, order_col: str, series: Sequence[str], tie: str | None,
            n_lags: int, unit_seconds: int, bucket_units: int | None,
            first_row_guard: bool) -> DataFrame:
    span_us, halo_us = _spans(n_lags, unit_seconds, bucket_units)
    base = df.withColumn("_t", epoch_micros(order_col))
    base = base.withColumn("_b", _bucket_of(F.col("_t"), span_us))
    framed = base.withColumn("_frame", F.explode(_frames_of(F.col("_t"), F.col("_b"), span_us, halo_us)))
    ties = [tie] if tie else []
    if first_row_guard:
        # the first row is the least (time, tie); without a tie column a plain
        # min of a long, which aggregates by hash instead of by sort
        if ties:
            first = base.groupBy(*series).agg(F.min(F.struct("_t", *ties)).alias("_first"))
        else:
            first = (base.groupBy(*series).agg(F.min("_t").alias("_first_t"))
                     .select(*series, F.struct(F.col("_first_t").alias("_t")).alias("_first")))
        fb = _bucket_of(F.col("_first._t"), span_us)
        first = first.withColumn("_frame", F.explode(_frames_of(F.col("_first._t"), fb, span_us, halo_us)))
        framed = framed.join(first, on=[*series, "_frame"], how="left")
        is_first = F.col("_t") == F.col("_first._t")
        for c in ties:
            is_first = is_first & (F.col(c) == F.col(f"_first.{c}"))
        framed = framed.withColumn("_is_first", F.coalesce(is_first, F.lit(False))).drop("_first")
    else:
        framed = framed.withColumn("_is_first", F.lit(False))
    return framed


def _long_runs(framed: DataFrame, series: Sequence[str], tie: str | None, n_lags: int, breaks) -> DataFrame:
    """Rows of a frame's runs of more than ``n_lags`` rows, with ``_run``; ``breaks(step)`` says whether the step
    in microseconds from the row before starts a new run.  Needs no shuffle beyond the frames'."""
    frame = Window.partitionBy(*series, "_frame").orderBy("_t", *([tie] if tie else []))
    new = F.coalesce(breaks(F.col("_t") - F.lag("_t").over(frame)), F.lit(True)).cast("int")
    run = Window.partitionBy(*series, "_frame", "_run")
    return (framed.withColumn("_new", new)
            .withColumn("_run", F.sum("_new").over(frame.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_size", F.count(F.lit(1)).over(run)).filter(F.col("_size") > n_lags).drop("_new", "_size"))


def lag_names(n_lags: int, prefix: str = "Min - ") -> list[str]:
    return [f"{prefix}{j}" for j in range(1, n_lags + 1)]


def _complete_batches(batches, keep: Sequence[str], group: Sequence[str], n_lags: int, unit_us: int, whole: bool, schema):
    """The complete rows, with their lags, of Arrow batches sorted by (group, time), each group's mark before its rows.

    The last ``n_lags + 1`` rows of a batch are put before the next one.  Rows of a group at the time of its mark
    are the first of their series: no source.  ``whole``: a lag is a step of one unit after another, else
    the gap test of every lag."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def changes(column):
        a, b = column.slice(1), column.slice(0, len(column) - 1)
        return pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(a.is_null(), b.is_null())).to_numpy(zero_copy_only=False)

    carry, first_time = None, None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if carry is not None:
            table = pa.concat_tables([carry, table])
        table = table.combine_chunks()
        size, carried = table.num_rows, carry.num_rows if carry is not None else 0
        if not size:
            continue
        new = np.ones(size, bool)
        new[1:] = np.logical_or.reduce([changes(table.column(c).combine_chunks()) for c in group])
        t, mark = (table.column(c).to_numpy() for c in ("_t", "_mark"))
        begins = np.flatnonzero(new)
        ends = np.append(begins[1:], size)
        first = np.zeros(size, bool)
        goes_on = begins[np.searchsorted(begins, carried - 1, side="right") - 1] if carried else -1
        if first_time is not None:  # the group that the batch before ended in
            end = ends[np.searchsorted(begins, goes_on)]
            first[goes_on:end] = t[goes_on:end] == first_time
        for m in np.flatnonzero(mark):
            end = ends[np.searchsorted(begins, m, side="right") - 1]
            first[m:end] = t[m:end] == t[m]
        last = begins[-1]
        marked = last + np.flatnonzero(mark[last:])
        if len(marked) or last != goes_on:
            first_time = t[marked[0]] if len(marked) else None
        carry = table.slice(max(0, size - n_lags - 1))

        rows = np.flatnonzero(~mark)
        t, first, group_no = t[rows], first[rows], np.cumsum(new)[rows]
        known = table.column("_v").combine_chunks().is_valid().to_numpy(zero_copy_only=False)[rows]
        v = pc.fill_null(table.column("_v").combine_chunks(), 0.0).to_numpy(zero_copy_only=False)[rows]
        own = table.column("_own").to_numpy()[rows] & (rows >= carried)
        gone = np.concatenate([[0], np.cumsum(~known)])  # rows without a value
        at = np.flatnonzero(own & known)
        at = at[at >= n_lags]
        far = at - n_lags
        at = at[(group_no[at] == group_no[far]) & ~first[far] & ~first[at] & (gone[at] == gone[far])
                & (np.rint((t[at] - t[far]) / unit_us) == n_lags)]
        if whole:
            odd = np.concatenate([[0], np.cumsum(np.diff(t) != unit_us)])
            at = at[odd[at] == odd[at - n_lags]]
        else:
            for j in range(1, n_lags):
                at = at[np.rint((t[at] - t[at - j]) / unit_us) == j]
        if len(at):
            kept = table.select(list(keep)).take(pa.array(rows[at])).combine_chunks()
            columns = [kept.column(c).combine_chunks() for c in keep] + [pa.array(v[at - j]) for j in range(1, n_lags + 1)]
            yield pa.RecordBatch.from_arrays(columns, names=schema)


def _complete_rows(df: DataFrame, order_col: str, value_col: str, n_lags: int, unit_seconds: int, series: Sequence[str],
                   first_row_guard: bool, bucket_units: int | None, prefix: str, whole: bool) -> DataFrame:
    """``df`` and its lags, rows without a null lag only, where no column breaks ties.

    Rows are dealt by (series, frame) once and sorted there; a frame's lags are then positions in Arrow batches.
    The first row of a series is known by a mark that lies before it in each of its frames, so no join moves the
    rows and no task holds more than a batch."""
    span_us, halo_us = _spans(n_lags, unit_seconds, bucket_units)
    base = df.withColumn("_t", epoch_micros(order_col)).filter(F.col("_t").isNotNull())

    def dealt(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("_b", _bucket_of(F.col("_t"), span_us))
        return rows.withColumn("_frame", F.explode(_frames_of(F.col("_t"), F.col("_b"), span_us, halo_us)))

    framed = dealt(base).select(*df.columns, F.col(value_col).cast("double").alias("_v"), "_t", "_frame",
                                (F.col("_frame") == F.col("_b")).alias("_own"), F.lit(False).alias("_mark"))
    if first_row_guard:
        first = base.groupBy(*series).agg(F.min("_t").alias("_t"))
        for c in series:  # a series without a key has no first row
            first = first.filter(F.col(c).isNotNull())
        marks = dealt(first.filter(F.col("_t").isNotNull())).select(
            *series, "_t", "_frame", F.lit(False).alias("_own"), F.lit(True).alias("_mark"))
        framed = framed.unionByName(marks, allowMissingColumns=True)
    group = [*series, "_frame"]
    rows = framed.repartition(*group).sortWithinPartitions(*group, "_t", F.col("_mark").desc())
    names = [*df.columns, *lag_names(n_lags, prefix)]
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in df.schema],
                           *[T.StructField(n, T.DoubleType()) for n in names[len(df.columns):]]])
    return rows.mapInArrow(partial(_complete_batches, keep=df.columns, group=group, n_lags=n_lags,
                                   unit_us=unit_seconds * 1_000_000, whole=whole, schema=names), schema)


def lag_features(df: DataFrame, order_col: str, value_col: str, n_lags: int = 60,
                 unit_seconds: int = 60, series: Sequence[str] = (), tie: str | None = None,
                 first_row_guard: bool = True, dropna: bool = True,
                 bucket_units: int | None = None, prefix: str = "Min - ") -> DataFrame:
    """All columns of ``df`` plus ``prefix1..prefixN`` (double).

    ``series`` partitions independent series (e.g. a user); ``tie`` breaks
    equal timestamps so the row order is total.

    One window expression collects the previous ``n_lags`` rows (time, value,
    first-row flag) of each row; one higher-order ``transform`` applies the
    gap test to all of them.  Sixty separate ``lag`` columns with sixty CASE
    expressions generate code too large to compile well; this form keeps both
    the plan and the generated code small.
    """
    if dropna and tie is None:
        return _complete_rows(df, order_col, value_col, n_lags, unit_seconds, series, first_row_guard, bucket_units,
                              prefix, whole=False)
    unit_us = float(unit_seconds * 1_000_000)
    framed = _framed(df, order_col, series, tie, n_lags, unit_seconds, bucket_units, first_row_guard)
    if dropna:
        # of a complete row, lag j and lag j + 1 lie two units apart at most: a wider step ends a run, and runs
        # too short for a complete row are dropped before lags are collected
        framed = _long_runs(framed, series, tie, n_lags, lambda step: step > 2 * unit_seconds * 1_000_000)
    w = (Window.partitionBy(*series, "_frame").orderBy("_t", *([tie] if tie else []))
         .rowsBetween(-n_lags, -1))
    src = F.struct(F.col("_t").alias("t"), F.col(value_col).alias("v"), F.col("_is_first").alias("f"))
    staged = framed.select(*df.columns, "_t", "_b", "_frame",
                           F.collect_list(src).over(w).alias("_p"))
    if dropna:  # the farthest lag, before all of them
        staged = staged.filter(F.expr(f"size(_p) = {n_lags} AND bround((_t - get(_p, 0).t) / {unit_us}, 0) = {n_lags} AND NOT get(_p, 0).f"))
    lags = F.expr(f"""transform(sequence(1, {n_lags}), j -> CASE
        WHEN size(_p) >= j
         AND bround((_t - _p[size(_p) - j].t) / {unit_us}, 0) = j
         AND NOT _p[size(_p) - j].f
        THEN CAST(_p[size(_p) - j].v AS DOUBLE) END)""")
    out = staged.filter(F.col("_frame") == F.col("_b")).select(*df.columns, lags.alias("_lags"))
    if dropna:
        out = out.filter(F.col(value_col).isNotNull() & F.expr("forall(_lags, x -> x IS NOT NULL)"))
    names = lag_names(n_lags, prefix)
    return out.select(*df.columns, *[F.col("_lags")[j].alias(n) for j, n in enumerate(names)])


def lag_features_frame(df: DataFrame, order_col: str, value_col: str, n_lags: int = 60,
                       unit_seconds: int = 60, series: Sequence[str] = (), tie: str | None = None,
                       first_row_guard: bool = True, bucket_units: int | None = None,
                       prefix: str = "Min - ") -> DataFrame:
    """Single-frame form for series with unique whole-unit timestamps.

    ``collect_list`` over ``RANGE BETWEEN n_lags PRECEDING AND 1 PRECEDING``
    holds at most ``n_lags`` entries per row; a row is complete when all
    ``n_lags`` preceding units are present (the first row of the series is
    left out of every frame, as the row-0 guard demands).  Returns only
    complete rows, equal to ``lag_features`` with ``dropna`` on such series.
    """
    unit_us = unit_seconds * 1_000_000
    framed = _framed(df, order_col, series, tie, n_lags, unit_seconds, bucket_units, first_row_guard)
    framed = framed.withColumn("_u", F.floor(F.col("_t") / F.lit(unit_us)))
    w = (Window.partitionBy(*series, "_frame").orderBy("_u")
         .rangeBetween(-n_lags, -1))
    src = F.when(~F.col("_is_first"), F.col(value_col).cast("double"))  # a frame is collected in its order
    staged = framed.select(*df.columns, "_b", "_frame", F.collect_list(src).over(w).alias("_prev"))
    names = lag_names(n_lags, prefix)
    lags = [F.col("_prev")[n_lags - j].alias(name) for j, name in enumerate(names, 1)]
    out = (staged.filter((F.col("_frame") == F.col("_b")) & (F.size("_prev") == n_lags))
           .select(*df.columns, *lags))
    return out.na.drop(how="any", subset=[value_col, *names])


def lag_features_runs(df: DataFrame, order_col: str, value_col: str, n_lags: int = 60,
                      unit_seconds: int = 60, series: Sequence[str] = (), tie: str | None = None,
                      first_row_guard: bool = True, bucket_units: int | None = None,
                      prefix: str = "Min - ") -> DataFrame:
    """Complete rows only, from unbroken runs: for series whose rows step by whole units.

    Rows are numbered into runs that a step of other than one unit breaks (so does a repeated unit), inside
    each frame.  A frame holds the ``n_lags + 1`` units before its bucket, so a run of ``n_lags`` rows or
    fewer in it holds no complete row and is dropped before any lag is collected; in the others the lags are
    simply the rows before.  The first row of a series is no source and has no lags: it is left out.  Equal
    to ``lag_features`` with ``dropna`` on such series.
    """
    if tie is None:
        return _complete_rows(df, order_col, value_col, n_lags, unit_seconds, series, first_row_guard, bucket_units,
                              prefix, whole=True)
    unit_us = unit_seconds * 1_000_000
    framed = _framed(df, order_col, series, tie, n_lags, unit_seconds, bucket_units, first_row_guard)
    rows = _long_runs(framed.filter(~F.col("_is_first")), series, tie, n_lags, lambda step: step != unit_us)
    run = Window.partitionBy(*series, "_frame", "_run")
    before = run.orderBy("_t").rowsBetween(-n_lags, -1)
    out = (rows.withColumn("_prev", F.collect_list(F.col(value_col).cast("double")).over(before))
           .filter((F.col("_frame") == F.col("_b")) & (F.size("_prev") == n_lags) & F.col(value_col).isNotNull()))
    return out.select(*df.columns, *[F.col("_prev")[n_lags - j].alias(name)
                                     for j, name in enumerate(lag_names(n_lags, prefix), 1)])


def training_matrix(series_df: DataFrame, order_col: str = "TS", value_col: str = "BPM",
                    label_col: str = "sport", n_lags: int = 60, unit_seconds: int = 60,
                    domain: Sequence[str] = SPORTS, series: Sequence[str] = (),
                    tie: str | None = None, bucket_units: int | None = None,
                    whole_units: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """``keep...``, ``time`` (HHMMSS int), ``BPM``, ``Min - 1..n``, then the one-hot block:
    ``Nothing`` and the labels of ``domain`` in byte order.  Built in one
    select that leaves the label column out (``sport`` and ``Sport`` would
    collide, names being case-insensitive).  ``whole_units``: the rows step by
    whole units, so lags come from unbroken runs."""
    lag = lag_features_runs if whole_units else lag_features
    lagged = lag(series_df, order_col, value_col, n_lags=n_lags, unit_seconds=unit_seconds,
                 series=series, tie=tie, bucket_units=bucket_units)
    return lagged.select(*keep, time_as_int(clock_text(order_col)).alias("time"),
                         F.col(value_col).cast("int").alias("BPM"),
                         *[F.col(f"`{n}`") for n in lag_names(n_lags)],
                         *one_hot_columns(label_col, list(domain)))
