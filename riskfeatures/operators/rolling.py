"""Row-based windows: rolling aggregates, previous values, next dates, running totals.

A plain window puts a whole key into one task. That is right where a key has few rows by
construction, such as one per financial year or per day. Where a key is unbounded, windows
run slice by slice (see `slices`), on one path for every key whatever its size; what a frame
needs from beyond its slice is carried.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import columns, growth_rate, ieee_div, nan_to_null
from .slices import GOES_ON, GROUP, GROUP_GOES_ON, GROUP_OPENED, NEXT, OPENED, SLICE, SLICE_ROWS, sliced

_POS, _AHEAD, _TARGET, _EDGE, _GROUP_EDGE, _BACK, _OPEN = "__pos", "__ahead", "__target", "__edge", "__group_edge", "__back", "__open"

_AGGREGATES = {"sum": F.sum, "mean": F.avg}


def _rolling_columns(
    features: Mapping[str, str], windows: Sequence[int], agg: str, spec
) -> dict[str, Column]:
    out = {}
    for prefix, value in features.items():
        for n in windows:
            frame = spec.rowsBetween(-(n - 1), 0)
            # an incomplete frame gives null, as does a frame with a missing value
            complete = F.count(F.col(value)).over(frame) == n
            out[f"{prefix}_{n}yrs"] = F.when(complete, _AGGREGATES[agg](value).over(frame))
    return out


def rolling_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    features: Mapping[str, str],
    agg: str = "mean",
    windows: Sequence[int] = (1, 2, 3, 4),
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add `{prefix}_{n}yrs`: sum or mean of the last n rows of the key, null if fewer.

    `features` maps an output prefix to its value column; `order` must make rows of a key
    distinct. A key may have any number of rows: the last rows of a slice go to the next ones,
    where the first rows are worked out together with them. Where slices are so small that they
    come in groups, this happens among the rows of a group first, then from group to group.
    """
    if agg not in _AGGREGATES:
        raise ValueError(f"aggregate must be one of {sorted(_AGGREGATES)}, not {agg!r}")
    ordering = [F.asc_nulls_last(c) for c in order]
    depth = max(windows) - 1
    found = sliced(df, keys, order, slice_rows)
    in_groups = GROUP in found.columns
    groups = [GROUP, _edge(GROUP_OPENED, GROUP_GOES_ON).alias(_GROUP_EDGE)] if in_groups else []
    # both branches below need the same columns, so they share one exchange
    cut = found.select(*df.columns, SLICE, _edge().alias(_EDGE), *groups)

    def rolled(spec) -> dict[str, Column]:
        return _rolling_columns(features, windows, agg, spec)

    added = list(rolled(Window.orderBy(*ordering)))

    def settled(rows: DataFrame, part: str, edge: str) -> tuple[DataFrame, DataFrame]:
        """Rows whose frame lies in their part, and all rows near a cut: the first ones of a
        part, which are open, and the last ones, which may be in the frame of a later row."""
        spec = Window.partitionBy(*keys, part).orderBy(*ordering)
        placed = rows.withColumn(_POS, F.row_number().over(spec))
        reaches_back = F.col(edge).isin(1, 3) & (F.col(_POS) <= depth)
        alone = placed.withColumns(rolled(spec)).where(~reaches_back & F.col(edge).isNotNull())
        near = placed.withColumn(_AHEAD, F.count(F.lit(1)).over(spec.rowsBetween(1, depth)) if depth else F.lit(0))
        near = near.withColumns({_BACK: reaches_back, _AHEAD: (F.col(edge) >= 2) & (F.col(_AHEAD) < depth)})
        return alone, near.where(F.col(_BACK) | F.col(_AHEAD))

    alone, near = settled(cut, SLICE, _EDGE)
    if in_groups:
        alone = alone.where(F.col(GROUP).isNotNull() & F.col(_GROUP_EDGE).isNotNull())
    out = alone.select(*df.columns, *added)
    if not depth:
        return out
    part = SLICE
    if in_groups:
        # the same once more among the rows near a cut, with groups for slices
        near = near.withColumnRenamed(_BACK, _OPEN).select(*df.columns, GROUP, _GROUP_EDGE, _OPEN)
        alone, near = settled(near, GROUP, _GROUP_EDGE)
        out = out.unionByName(alone.where(_OPEN).select(*df.columns, *added))
        part = GROUP

    # Each slice has a row at least, so as many slices ahead as rows in a frame are enough.
    none = F.array().cast("array<int>")
    stay = F.when(F.col(_BACK), F.array(part)).otherwise(none)
    ahead = F.when(F.col(_AHEAD), F.sequence(F.col(part) + 1, F.col(part) + depth)).otherwise(none)
    sent = near.withColumn(_TARGET, F.explode(F.concat(stay, ahead)))
    in_target = Window.partitionBy(*keys, _TARGET).orderBy(*ordering)
    repaired = sent.withColumns(rolled(in_target))
    return out.unionByName(repaired.where(F.col(_TARGET) == F.col(part)).select(*df.columns, *added))


def _edge(opened: str = OPENED, goes_on: str = GOES_ON) -> Column:
    """1: the key has an earlier slice, 2: a later one, 3: both, 0: none."""
    return F.col(opened).cast("int") + 2 * F.col(goes_on).cast("int")


def history_names(features: Sequence[str], growth: Sequence[str] = (), n: int = 4) -> list[str]:
    """All names that :func:`history_features` can add."""
    kinds = [(f, k) for f in features for k in ("prv", "diff", "diff_perc")]
    kinds += [(f, k) for f in growth for k in ("prv", "diff_perc")]
    return [f"{f}_{kind}_{i}_yrs" for f, kind in kinds for i in range(1, n + 1)]


def history_features(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    features: Sequence[str],
    growth: Sequence[str] = (),
    n: int = 4,
    wanted: Sequence[str] | None = None,
) -> DataFrame:
    """Add values 1..n rows back, differences to them and percentage differences.

    Names are `{feature}_prv_{i}_yrs`, `_diff_{i}_yrs` and `_diff_perc_{i}_yrs`; `wanted`
    limits them. Features named in `growth` get a compound growth rate as `_diff_perc`.
    Rows of a key must be few by construction, such as one per financial year.
    """
    wanted = set(history_names(features, growth, n) if wanted is None else wanted)
    w = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_last(c) for c in order])
    lags, formulas = {}, {}
    for f in [*features, *growth]:
        for i in range(1, n + 1):
            prv, diff, perc = (f"{f}_{kind}_{i}_yrs" for kind in ("prv", "diff", "diff_perc"))
            if not wanted & {prv, diff, perc}:
                continue
            lags[prv] = F.lag(f, i).over(w)
            change = nan_to_null(f"({f} - {prv})")
            if f in growth:
                formulas[perc] = growth_rate(f, prv, i)
            else:
                formulas[diff] = change
                formulas[perc] = nan_to_null(f"100 * {ieee_div(change, prv)}")
    added = df.withColumns(lags).withColumns(columns({k: v for k, v in formulas.items() if k in wanted}))
    return added.drop(*[c for c in lags if c not in wanted])


def next_event_date(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    out: str,
    default: Column,
    ties: Sequence[str] = (),
    slice_rows: int | None = None,
) -> DataFrame:
    """Add the date of the key's next event, or `default` for its last one.

    Events of one date follow each other in the order of the tie columns. Without `slice_rows`
    a key must have few rows by construction, such as one a day. With it a key may have any
    number: the first row of the next slice is known to the last one of a slice. Rows with a
    null key belong to no sequence and get the default; rows without a date come back without
    one.
    """
    order = [date, *ties]
    ordering = [F.asc_nulls_last(c) for c in order]
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    if slice_rows is None:
        following = F.lead(date).over(Window.partitionBy(*keys).orderBy(*ordering))
        return df.withColumn(out, F.coalesce(F.when(keyed, following), default))
    w = Window.partitionBy(*keys, SLICE).orderBy(*ordering)
    # the last row of a slice has no row after it there; what follows may lack a date as well
    last = F.lead(F.lit(1)).over(w).isNull()
    following = F.when(last, F.col(NEXT)["o0"]).otherwise(F.lead(date).over(w))
    return (
        sliced(df, keys, order, slice_rows)
        .withColumn(out, F.coalesce(F.when(keyed, following), default))
        .select(*df.columns, out)
    )


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, str],
    slice_rows: int | None = None,
) -> DataFrame:
    """Add running sums from the first row of the key up to the current one.

    `order` must make rows of a key distinct. Without `slice_rows` a key must have few rows by
    construction, such as one a day. With it a key may have any number: running sums are taken
    slice by slice and raised by the sum of the key's earlier slices.
    """
    if slice_rows is None:
        whole = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_last(c) for c in order])
        upto = whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({out: F.sum(value).over(upto) for out, value in totals.items()})
    cut = sliced(df, keys, order, slice_rows).select(*df.columns, SLICE, _edge().alias(_EDGE))
    w = Window.partitionBy(*keys, SLICE).orderBy(*[F.asc_nulls_last(c) for c in order])
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.withColumns({out: F.sum(value).over(upto) for out, value in totals.items()})

    # the total at the end of each slice of a key that has several: a key has as many as slices
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    ends = local.withColumn(_AHEAD, F.lead(F.lit(1)).over(w)).where(F.col(_AHEAD).isNull() & (F.col(_EDGE) > 0))
    earlier = ends.select(
        *[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)],
        F.col(SLICE).alias("__of_slice"),
        *[F.sum(out).over(before).alias(f"__before_{out}") for out in totals],
    )
    same = F.col(SLICE) == F.col("__of_slice")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__key_{i}"))
    raised = {out: F.coalesce(F.col(out) + F.col(f"__before_{out}"), out, f"__before_{out}") for out in totals}
    return local.join(earlier, same, "left").withColumns(raised).select(*df.columns, *totals)
