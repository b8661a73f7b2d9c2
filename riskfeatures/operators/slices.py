"""Slices of ordered keys, for windows over keys that may hold any number of rows.

All rows are thought of as sorted by key and order and cut into slices of about `slice_rows`
rows, wherever the keys begin and end. The cuts are rows themselves: those whose hash falls
on one in `slice_rows`. So they follow from the data alone and are the same however often,
in whatever partitions and on whichever executor a plan is run. There is one cut for each
`slice_rows` rows; the sorted cuts reach every row as a scalar subquery, not as a join, and a
row finds its slice by binary search.

Only as many cuts are sent to every row as there are groups of GROUP_ROWS rows. Where slices
are to be smaller, a row searches its group of slices, and a window over each group finds the
cuts inside it.

A window is then partitioned by key and slice, so its largest task is bounded by the slice,
not by the key. What a frame needs from a neighbouring slice is carried there by the operator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SLICE_ROWS = 1_000_000
# Enough steps of the binary search for half a million cuts; where there are more, the last
# slice holds what lies beyond.
_STEPS = [1 << k for k in range(18, -1, -1)]
GROUP_ROWS = 1 << 17

SLICE, OPENED, GOES_ON, NEXT = "__slice", "__opened", "__goes_on", "__next"
GROUP, GROUP_OPENED, GROUP_GOES_ON = "__slice_group", "__group_opened", "__group_goes_on"
_CUTS, _FOUND, _ONE = "__cuts", "__found", "__one"
_CHOSEN, _BEGINS, _AT, _GROUP_NEXT = "__chosen", "__begins", "__at", "__group_next"


def _place(keys: Sequence[str], order: Sequence[str]) -> Column:
    """The row's place in the sort order: keys, then order columns with nulls last."""
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    return F.struct(key.alias("key"), _at(order).alias("at"))


def _at(order: Sequence[str]) -> Column:
    return F.struct(*[c for i, o in enumerate(order) for c in (F.isnull(o).alias(f"n{i}"), F.col(o).alias(f"o{i}"))])


def _falls_on_one_in(rows: int, names: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*names), F.lit(rows)) == 0


def cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_rows: int) -> DataFrame:
    """One row with the sorted array of the places at which slices begin, and the steps of a
    search among so many.

    The hash is of whole rows, so that this reads the same columns of df as the windows do and
    Spark runs their common exchanges once.
    """
    hashed = [c for c, dtype in df.dtypes if "map<" not in dtype and dtype != "variant"]
    chosen = df.where(_falls_on_one_in(slice_rows, hashed))
    places = F.slice(F.sort_array(F.collect_set(_place(keys, order))), 1, 2 * _STEPS[0] - 1)
    steps = F.filter(F.array(*[F.lit(s) for s in _STEPS]), lambda step: step <= F.size("cuts"))
    return chosen.agg(places.alias("cuts")).select(F.struct("cuts", steps.alias("steps")).alias("cuts"))


def _searched(df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_rows: int) -> DataFrame:
    """df with `__found`: the number of the row's slice, whether its key may have rows in an
    earlier one, whether the slice begins with it, and where the key's next slice begins."""
    # The cuts are the loop's own variable, since a subquery may not stand in a lambda. They must
    # not become a column of rows that are handed on: the generator keeps the optimizer from
    # working them out together with the columns of df, so it puts them into the loop instead.
    def search(known: Column) -> Column:
        start = F.struct(F.lit(0).alias("found"), known["cuts"].alias("cuts"), _place(keys, order).alias("place"))
        return F.aggregate(known["steps"], start, halve, found)

    def halve(loop: Column, step: Column) -> Column:
        tried = F.get(loop["cuts"], loop["found"] + step - 1) <= loop["place"]
        further = F.when(tried, loop["found"] + step).otherwise(loop["found"])
        return F.struct(further.alias("found"), loop["cuts"].alias("cuts"), loop["place"].alias("place"))

    def found(loop: Column) -> Column:
        last, following = F.get(loop["cuts"], loop["found"] - 1), F.get(loop["cuts"], loop["found"])
        same = lambda cut: F.coalesce(cut["key"] == loop["place"]["key"], F.lit(False))
        return F.struct(
            loop["found"].alias("slice"),
            same(last).alias("opened"),
            F.coalesce(last == loop["place"], F.lit(False)).alias("begins"),
            F.when(same(following), following["at"]).alias("next"),
        )

    return (
        df.select(*df.columns, F.explode(F.array(F.lit(1))).alias(_ONE))
        .withColumn(_CUTS, cuts(df, keys, order, slice_rows).scalar())
        .select(*df.columns, F.get(F.transform(F.array(F.col(_CUTS)), search), F.lit(0)).alias(_FOUND))
    )


def sliced(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_rows: int = SLICE_ROWS, group_rows: int | None = None
) -> DataFrame:
    """df with the number of the row's slice and what is known of its neighbours.

    `__opened`: the key may have rows in an earlier slice. `__goes_on`: it has rows in the
    next one, the first of which is `__next` (its order columns are o0, o1, ...). A key that
    goes on has rows in every slice up to its last. Rows that are equal in keys and order lie
    in one slice. Slices smaller than a group also get the group's number, `__group_opened`
    and `__group_goes_on`; their numbers rise by one within a group, and from group to group.
    """
    group_rows = GROUP_ROWS if group_rows is None else group_rows
    found = F.col(_FOUND)
    if slice_rows >= group_rows:
        return _searched(df, keys, order, slice_rows).select(
            *df.columns,
            found["slice"].alias(SLICE),
            found["opened"].alias(OPENED),
            found["next"].isNotNull().alias(GOES_ON),
            found["next"].alias(NEXT),
        )
    grouped = _searched(df, keys, order, group_rows).select(
        *df.columns,
        found["slice"].alias(GROUP),
        found["opened"].alias(GROUP_OPENED),
        found["next"].alias(_GROUP_NEXT),
        (found["begins"] | _falls_on_one_in(slice_rows, [*keys, *order])).alias(_CHOSEN),
    )
    up = Window.partitionBy(GROUP).orderBy(*[F.asc_nulls_first(k) for k in keys], *[F.asc_nulls_last(o) for o in order])
    in_key = Window.partitionBy(GROUP, *keys)
    upto = in_key.orderBy(*[F.asc_nulls_last(o) for o in order])
    # of rows in the same place one begins the slice; going down it comes last, so that none of
    # them is told its own place as the next one
    down = in_key.orderBy(*[F.desc_nulls_first(o) for o in order], F.asc(_BEGINS))
    after = down.rowsBetween(Window.unboundedPreceding, -1)
    begun = grouped.withColumn(_BEGINS, F.col(_CHOSEN) & (F.row_number().over(up) == F.rank().over(up)))
    return (
        begun.withColumns({
            SLICE: F.shiftleft(F.col(GROUP).cast("bigint"), 32) + F.sum(F.col(_BEGINS).cast("int")).over(up),
            OPENED: F.max(_BEGINS).over(upto),
            _AT: F.when(F.col(_BEGINS), _at(order)),
        })
        .withColumn(NEXT, F.coalesce(F.last(_AT, ignorenulls=True).over(after), _GROUP_NEXT))
        .select(
            *df.columns, SLICE, OPENED, F.col(NEXT).isNotNull().alias(GOES_ON), NEXT,
            GROUP, GROUP_OPENED, F.col(_GROUP_NEXT).isNotNull().alias(GROUP_GOES_ON),
        )
    )
