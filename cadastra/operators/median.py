"""Exact lower discrete median per group, with bounded memory per task.

The median is the ``ceil(n/2)``-th smallest non-null value (SQL
``percentile_disc(0.5)``). Spark's ``percentile_disc`` merges every distinct
value of a group into one buffer: fine while a group is small, unbounded for
a hot group. So the work is routed by group size:

1. one aggregate gives each group's size (plus the caller's other
   aggregates); it is written once as a small table;
2. groups with at most ``max_exact_group`` values take ``percentile_disc``
   (their buffer is bounded by that size); when all groups are that small and
   one column is asked for, a plain count finds so first, and one sort by
   (group, value) gives the median and the other aggregates (``_sorted_median``);
3. larger (hot) groups take the bracket path, where every step aggregates
   map-side first:

   a. a quantile sketch (``percentile_approx``, a bounded mergeable summary)
      brackets rank ``k = ceil(n/2)``;
   b. rows are tagged against their group's bracket and counted per
      (group, value inside the bracket): rows outside collapse into one
      counter per group, ties into one row per value;
   c. while a bracket holds more than ``max_exact_group`` values, it is
      sketched again inside itself;
   d. a running count over the distinct values inside the bracket picks the
      value where the rank crosses ``k``.

   The bracket is checked exactly (``below < k <= below + inside``); a group
   failing it, which the sketch's error bound rules out, is recomputed with
   ``percentile_disc`` so the answer is exact whatever happens.

Small per-group tables (hot list, brackets) are broadcast only when their
counted size is under ``broadcast_max_groups``. With more hot groups than
that, no row meets a per-group table: all groups are counted by value bucket,
the same for every group, and a running count over the buckets of a group
brackets the rank exactly. Most groups have one value in that bucket; for the
others the bucket's values are cut into buckets again, until one value or few
are left (``_counted_median``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.operators.materialize import known_rows, materialize


_GROUP = "_group"
_STEPS = 100  # percentiles a repeated sketch is asked for
_PER_OCTAVE = 1024  # value buckets between a number and its double
_CUTS = 256  # parts a bucket is cut into


def disc_median(column: str) -> Column:
    """``percentile_disc(0.5)`` of the named column, as an aggregate expression.

    Only for groups whose size is bounded (by construction, or by the size
    routing below), where a single merge buffer is safe.
    """
    name = column.replace("`", "``")
    return F.expr(f"CAST(percentile_disc(0.5) WITHIN GROUP (ORDER BY `{name}`) AS DOUBLE)")


def _maybe_broadcast(df: DataFrame, rows: int, limit: int) -> DataFrame:
    return F.broadcast(df) if rows <= limit else df


def _bracket_median(
    vals: DataFrame, keys: list[str], alias: str, accuracy: int, broadcast_max_groups: int,
    bracket: tuple[float, float] | None, max_inside: int,
) -> DataFrame:
    """Exact lower median of ``_v`` per group for large groups (see module doc)."""
    eps = 3.0 / accuracy
    lo_q, hi_q = bracket or (max(0.0, 0.5 - eps), min(1.0, 0.5 + eps))  # override: tests only
    sk = vals.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", F.array(F.lit(lo_q), F.lit(hi_q)), accuracy).alias("_br"),
    )
    sk = materialize(sk.select(
        *keys,
        F.ceil(F.col("_n") / F.lit(2.0)).alias("_k"),
        F.col("_br")[0].alias("_lo"),
        F.col("_br")[1].alias("_hi"),
    ))
    n_groups = sk.count()
    while bracket is None:
        # bracket again inside the bracket, until what is ordered at the end is bounded
        t = vals.join(_maybe_broadcast(sk, n_groups, broadcast_max_groups), keys).where("_v <= _hi")
        within = F.col("_v") >= F.col("_lo")
        sizes = materialize(t.groupBy(*keys, "_k", "_lo", "_hi").agg(
            F.count(F.when(~within, True)).alias("_nb"), F.count(F.when(within, True)).alias("_ni")))
        wide = (F.col("_ni") > max_inside) & (F.col("_lo") < F.col("_hi"))
        if not sizes.where(wide).limit(1).count():
            break
        # the wanted rank inside the bracket, as percentiles with the sketch's error on both sides
        at = (F.col("_k") - F.col("_nb")) / F.col("_ni")
        steps = F.array(*[F.lit(i / _STEPS) for i in range(_STEPS + 1)])
        cut = vals.join(_maybe_broadcast(sizes, n_groups, broadcast_max_groups), keys).where(
            wide & F.col("_v").between(F.col("_lo"), F.col("_hi")))
        cut = cut.groupBy(*keys).agg(F.percentile_approx("_v", steps, accuracy).alias("_q"))
        low = F.greatest(F.floor((at - eps) * _STEPS), F.lit(0)).cast("int")
        high = F.least(F.ceil((at + eps) * _STEPS), F.lit(_STEPS)).cast("int")
        new = sizes.join(cut, keys, "left")
        before = sk
        sk = materialize(new.select(
            *keys, "_k",
            F.when(wide, F.col("_q")[low]).otherwise(F.col("_lo")).alias("_lo"),
            F.when(wide, F.col("_q")[high]).otherwise(F.col("_hi")).alias("_hi")))
        same = sk.join(before.select(*keys, F.col("_lo").alias("_l"), F.col("_hi").alias("_h")), keys)
        if not same.where("_lo <> _l OR _hi <> _h").limit(1).count():
            break  # the sketch cannot cut further: few distinct values are left
    tagged = vals.join(_maybe_broadcast(sk, n_groups, broadcast_max_groups), keys)
    inside = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    tally = tagged.groupBy(*keys, "_k", F.when(inside, F.col("_v")).alias("_cv")).agg(
        F.count(F.lit(1)).alias("_cnt"),
        F.count(F.when(F.col("_v") < F.col("_lo"), True)).alias("_nbelow"),
    )
    g = Window.partitionBy(*keys)
    run = g.orderBy(F.col("_cv").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    in_cnt = F.when(F.col("_cv").isNotNull(), F.col("_cnt")).otherwise(F.lit(0))
    ranked = tally.select(
        *keys, "_k", "_cv", in_cnt.alias("_c"),
        F.sum("_nbelow").over(g).alias("_below"),
        F.sum(in_cnt).over(g).alias("_inside"),
        F.sum(in_cnt).over(run).alias("_cum"),
    )
    ok = (F.col("_below") < F.col("_k")) & (F.col("_k") <= F.col("_below") + F.col("_inside"))
    reach = F.col("_below") + F.col("_cum")
    picked = ranked.where(
        ok & F.col("_cv").isNotNull() & (reach >= F.col("_k")) & (reach - F.col("_c") < F.col("_k"))
    ).select(*keys, F.col("_cv").alias(alias))
    missed = ranked.where(~ok).select(*keys).distinct()
    fallback = vals.join(missed, keys, "left_semi").groupBy(*keys).agg(disc_median("_v").alias(alias))
    return picked.unionByName(fallback)


def _value_bucket(v: Column) -> Column:
    """A bucket that never falls as the value grows, fine around every size of number; NaN is the greatest."""
    size = F.abs(v)
    log = F.floor(F.log(size) * F.lit(_PER_OCTAVE / math.log(2.0))) + F.lit(1 << 21)  # above 0 for every double
    log = F.when(size == float("inf"), F.lit(1 << 23)).otherwise(log)
    return F.when(F.isnan(v), F.lit(1 << 24)).when(v == 0, F.lit(0)).when(v > 0, log).otherwise(-log).cast("int")


def _reached(rows: DataFrame, keys: list[str], bucket: Column, rank: Column, carry: Sequence[str] = ()) -> DataFrame:
    """Per group the bucket that the rank falls into: its least and greatest value, its count, the rank within it."""
    by = [*keys, *carry]
    counts = rows.groupBy(*by, bucket.alias("_b")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    group = Window.partitionBy(*by)
    run = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("_cum", F.sum("_c").over(run)).withColumn("_all", F.sum("_c").over(group)).withColumn("_k", rank)
    return counts.where((F.col("_cum") >= F.col("_k")) & (F.col("_cum") - F.col("_c") < F.col("_k"))).select(
        *keys, "_c", "_lo", "_hi", (F.col("_k") - F.col("_cum") + F.col("_c")).alias("_rank"))


def _counted_median(vals: DataFrame, keys: list[str], alias: str, broadcast_max_groups: int, max_inside: int) -> DataFrame:
    """Exact lower median of ``_v`` per group, for any number of groups of any size (see module doc)."""
    found = materialize(_reached(vals, keys, _value_bucket(F.col("_v")), F.ceil(F.col("_all") / F.lit(2.0))))
    done = None
    rows = vals
    while True:
        one = found.where("_lo = _hi").select(*keys, (F.col("_lo") + F.lit(0.0)).alias(alias))  # no negative zero
        done = one if done is None else done.unionByName(one)
        left = materialize(found.where("_lo < _hi"))
        n_left = known_rows(left)
        if not n_left:
            return done
        rows = materialize(rows.select(*keys, "_v").join(_maybe_broadcast(left, n_left, broadcast_max_groups), keys)
                           .where(F.col("_v").between(F.col("_lo"), F.col("_hi"))))
        few = rows.where(F.col("_c") <= max_inside).groupBy(*keys, "_rank").agg(F.collect_list("_v").alias("_vs"))
        done = done.unionByName(few.select(
            *keys, (F.element_at(F.array_sort("_vs"), F.col("_rank").cast("int")) + F.lit(0.0)).alias(alias)))
        rows = rows.where(F.col("_c") > max_inside)
        # the least and the greatest value fall into different parts, so every round cuts a bucket
        part = F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.lit(_CUTS)).cast("int")
        found = materialize(_reached(rows, keys, part, F.col("_rank"), ["_rank"]))


def _sorted_median(df: DataFrame, keys: list[str], value: Column, alias: str, extra_aggs: Sequence[Column]) -> DataFrame:
    """Exact lower median per group of bounded size: the rows meet their group once and are sorted by value there."""
    # one window spec for both: the rows are sorted once, and that order serves the aggregate, too
    w = Window.partitionBy(*keys).orderBy(F.col("_v0").asc_nulls_last())
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = df.withColumn("_v0", value).select(
        "*", F.row_number().over(w).alias("_rn"), F.count("_v0").over(whole).alias("_nv"))
    middle = F.max(F.when(F.col("_rn") == F.ceil(F.col("_nv") / F.lit(2.0)), F.col("_v0")))
    return ranked.groupBy(*keys).agg(*extra_aggs, middle.alias(alias))


def agg_with_lower_medians(
    df: DataFrame,
    keys: Sequence[str],
    values: dict[str, Column | str],
    extra_aggs: Sequence[Column] = (),
    accuracy: int = 1000,
    max_exact_group: int = 100_000,
    broadcast_max_groups: int = 200_000,
    bracket: tuple[float, float] | None = None,
    write_sizes: bool = True,
    max_rows: int | None = None,
) -> DataFrame:
    """``groupBy(keys).agg(*extra_aggs, lower_median(v) AS alias for alias, v in values)``.

    Pass 1 (group sizes and the extra aggregates) is written once. When no
    group holds more than ``max_exact_group`` values of any column, every
    median comes from one more aggregate; otherwise only the hot groups take
    the sketch-bracket path, column by column. With ``keys=[]`` the whole
    table is one group. ``write_sizes=False`` skips writing pass 1 when the
    input is cheap to read twice (already a written table).

    ``max_rows`` is an upper bound on the input's row count known to the
    caller (by default the count recorded when the input was written with
    ``materialize``). When it is at most ``max_exact_group``, no group can be
    hot, and the whole result is a single aggregate.
    """
    keys = list(keys)
    if not keys:
        g = df.withColumn("_all", F.lit(0))
        bound = max_rows if max_rows is not None else known_rows(df)
        out = agg_with_lower_medians(g, ["_all"], values, extra_aggs, accuracy, max_exact_group,
                                     broadcast_max_groups, bracket, write_sizes, bound)
        return out.drop("_all")
    if keys != [_GROUP]:
        bound = max_rows if max_rows is not None else known_rows(df)
        if len(values) == 1 and bracket is None and not (bound is not None and bound <= max_exact_group):
            (alias, v), = values.items()
            v = (F.col(v) if isinstance(v, str) else v).cast("double")
            if df.groupBy(*keys).agg(F.count(v).alias("_n0")).where(F.col("_n0") > max_exact_group).isEmpty():
                return _sorted_median(df, keys, v, alias, extra_aggs)
        # one struct key for every route: structs with null fields meet in joins as they do in groupBy
        g = df.withColumn(_GROUP, F.struct(*keys))
        out = agg_with_lower_medians(g, [_GROUP], values, extra_aggs, accuracy, max_exact_group,
                                     broadcast_max_groups, bracket, write_sizes, bound)
        return out.select(*[F.col(_GROUP).getField(k).alias(k) for k in keys],
                          *[c for c in out.columns if c != _GROUP])
    names = list(values)
    cols = {a: (F.col(v) if isinstance(v, str) else v).cast("double") for a, v in values.items()}
    bound = max_rows if max_rows is not None else known_rows(df)
    if bound is not None and bound <= max_exact_group and bracket is None:
        # no group can hold more values than the whole input: one bounded aggregate
        named = df.select("*", *[cols[a].alias(f"_v{i}") for i, a in enumerate(names)])
        return named.groupBy(*keys).agg(
            *extra_aggs, *[disc_median(f"_v{i}").alias(a) for i, a in enumerate(names)])
    vals = df.select(*keys, *[cols[a].alias(f"_v{i}") for i, a in enumerate(names)])

    first = df.groupBy(*keys).agg(
        *extra_aggs, *[F.count(cols[a]).alias(f"_n{i}") for i, a in enumerate(names)])
    if write_sizes:
        first = materialize(first)
    size = F.greatest(*[F.col(f"_n{i}") for i in range(len(names))]) if len(names) > 1 else F.col("_n0")
    hot = first.where(size > max_exact_group).select(*keys)
    n_hot = hot.count()

    def exact(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(*[disc_median(f"_v{i}").alias(a) for i, a in enumerate(names)])

    if n_hot == 0:
        medians = exact(vals)
    elif n_hot > broadcast_max_groups and bracket is None:
        medians = first.select(*keys)
        for i, a in enumerate(names):
            col_rows = vals.select(*keys, F.col(f"_v{i}").alias("_v")).where(F.col("_v").isNotNull())
            medians = medians.join(_counted_median(col_rows, keys, a, broadcast_max_groups, max_exact_group), keys, "left")
    else:
        hot_b = _maybe_broadcast(hot, n_hot, broadcast_max_groups)
        hot_rows = vals.join(hot_b, keys, "left_semi")
        hot_med = hot_b
        for i, a in enumerate(names):
            col_rows = hot_rows.select(*keys, F.col(f"_v{i}").alias("_v")).where(F.col("_v").isNotNull())
            m = _bracket_median(col_rows, keys, a, accuracy, broadcast_max_groups, bracket, max_exact_group)
            hot_med = hot_med.join(m, keys, "left")
        medians = exact(vals.join(hot_b, keys, "left_anti")).unionByName(hot_med)
    out_cols = [c for c in first.columns if not (c.startswith("_n") and c[2:].isdigit())]
    return first.select(*out_cols).join(medians, keys, "left")


def agg_with_lower_median(
    df: DataFrame,
    keys: Sequence[str],
    value: Column | str,
    alias: str,
    extra_aggs: Sequence[Column] = (),
    **kw,
) -> DataFrame:
    """``df.groupBy(keys).agg(*extra_aggs, lower_median(value).alias(alias))``."""
    return agg_with_lower_medians(df, keys, {alias: value}, extra_aggs, **kw)


def lower_median(df: DataFrame, keys: Sequence[str], value: Column | str, alias: str, **kw) -> DataFrame:
    """One row per group of ``keys`` with the exact lower median of ``value``."""
    return agg_with_lower_medians(df, keys, {alias: value}, (), **kw)


def interpolated_medians(df: DataFrame, keys: Sequence[str], values: dict[str, str], extra_aggs=(), **kw):  # noqa: E501
    """Median that averages the two middle values for even counts.

    Built from two lower medians: the lower median of ``x`` and the lower
    median of ``-x`` (which is minus the upper median), so it inherits the
    bounded-memory routing.
    """
    both: dict[str, Column] = {}
    for a, v in values.items():
        both[f"_lo_{a}"] = F.col(v)
        both[f"_hi_{a}"] = -F.col(v)
    m = agg_with_lower_medians(df, keys, both, extra_aggs, **kw)
    out = m
    for a in values:
        out = out.withColumn(a, (F.col(f"_lo_{a}") - F.col(f"_hi_{a}")) / F.lit(2.0))
    return out.drop(*[c for c in out.columns if c.startswith(("_lo_", "_hi_"))])
