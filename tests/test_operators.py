import datetime as dt
import itertools
import random

import pytest
from helpers import rows_of
from pyspark.sql import Window, functions as F

from riskfeatures.functions.dates import date_lit
from riskfeatures.operators.answers import answer_scores, answer_scores_by_year
from riskfeatures.operators.cases import dedup_cases, open_as_of, open_daily, open_now
from riskfeatures.operators.intervals import extract_periods, interval_join, merge_periods
from riskfeatures.operators.latest import any_per_key, latest_per_key, prefer_consolidated
from riskfeatures.operators.lists import explode_ids
from riskfeatures.operators.members import (
    Universe, company_years, complete_with, conditional_distinct, membership_flag, side_by_side,
)
from riskfeatures.operators.key_filter import key_bits, may_be_among
from riskfeatures.operators.rolling import history_features, next_event_date, rolling_rows, running_totals
from riskfeatures.operators import slices
from riskfeatures.operators.slices import sliced


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


# --- latest per key -------------------------------------------------------------------------


def test_latest_drops_null_keys_and_null_values(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "z"), ("a", 3, "y"), ("a", None, "n"), (None, 9, "k"), ("b", None, "only")],
        "k string, v int, t string",
    )
    assert rows_of(latest_per_key(df, ["k"], "v", ties=["t"])) == [("a", 3, "y")]
    assert rows_of(latest_per_key(df, ["k"], "v", ties=["t"], nulls="last")) == [("a", 3, "y"), ("b", None, "only")]
    with pytest.raises(ValueError):
        latest_per_key(df, ["k"], "v", nulls="first")


def test_preferred_and_any(spark):
    df = spark.createDataFrame(
        [(1, "standalone", 5), (1, "consolidated", 1), (2, "standalone", 7), (3, "other", 2)],
        "k int, is_consolidated_standalone_stmt string, v int",
    )
    assert [r[1] for r in rows_of(prefer_consolidated(df, ["k"]))] == ["consolidated", "standalone", "other"]
    assert rows_of(any_per_key(df, ["k"], ties=["v"]), "k", "v") == [(1, 1), (2, 7), (3, 2)]


def test_latest_prunes_before_the_exchange(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id").repartition(4)
    plan = latest_per_key(df, ["k"], "id")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert "Partial" in physical[physical.rindex("hashpartitioning(k"):]


# --- windows --------------------------------------------------------------------------------


def _brute_rolling(values, n, agg):
    out = []
    for i in range(len(values)):
        part = values[i - n + 1 : i + 1] if i + 1 >= n else []
        known = part and all(v is not None for v in part)
        out.append((sum(part) / (n if agg == "mean" else 1)) if known else None)
    return out


def _nulls_last(row):
    return [(v is None, v or 0) if not isinstance(v, str) else (False, v) for v in row[:3]]


@pytest.mark.parametrize("agg", ["sum", "mean"])
@pytest.mark.parametrize("slice_rows", [1, 2, 4, 9, 1_000_000])
def test_rolling_rows_against_brute_force(spark, agg, slice_rows):
    rng = random.Random(3)
    data = []
    for k, size in (("hot", 60), ("two", 2), ("five", 5), (None, 7)):
        # slices of all sizes, many of them shorter than the frame
        for i in range(size):
            data.append((k, rng.choice([2001, 2002, 2003, None]), i, rng.choice([0.0, 0.5, 1.0, None])))
    df = spark.createDataFrame(data, "k string, y int, i int, v double")
    got = rolling_rows(df, ["k"], ["y", "i"], {"m": "v"}, agg, slice_rows=slice_rows)
    assert got.columns == ["k", "y", "i", "v"] + [f"m_{n}yrs" for n in (1, 2, 3, 4)]
    want = []
    for k, rows in itertools.groupby(sorted(data, key=_nulls_last), key=lambda r: r[0]):
        rows = list(rows)
        rolled = [_brute_rolling([r[3] for r in rows], n, agg) for n in (1, 2, 3, 4)]
        want += [(*r, *(c[j] for c in rolled)) for j, r in enumerate(rows)]
    assert rows_of(got) == sorted(want, key=lambda r: [(v is None, str(v)) for v in r])


def test_rolling_one_row_is_the_input(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(5)], "k string, i int, v double")
    for slice_rows in (1, 100):
        got = rolling_rows(df, ["k"], ["i"], {"m": "v"}, windows=(1,), slice_rows=slice_rows)
        assert all(r.m_1yrs == r.v for r in got.collect())
    with pytest.raises(ValueError):
        rolling_rows(df, ["k"], ["i"], {"m": "v"}, agg="max")


def test_history_features(spark):
    df = spark.createDataFrame([(1, 2001, 2.0), (1, 2002, 0.0), (1, 2004, 8.0)], "k int, y int, v double")
    got = history_features(df, ["k"], ["y"], ["v"], n=2)
    last = got.where("y = 2004").first()
    # rows count, not years: the missing 2003 shifts the earlier ones
    assert (last.v_prv_1_yrs, last.v_prv_2_yrs, last.v_diff_1_yrs, last.v_diff_2_yrs) == (0.0, 2.0, 8.0, 6.0)
    assert (last.v_diff_perc_1_yrs, last.v_diff_perc_2_yrs) == (float("inf"), 300.0)
    grown = history_features(df, ["k"], ["y"], [], ["v"], n=2, wanted=["v_diff_perc_2_yrs"])
    assert grown.columns == ["k", "y", "v", "v_diff_perc_2_yrs"]
    assert grown.where("y = 2004").first().v_diff_perc_2_yrs == 1.0


def test_next_event_date(spark):
    df = spark.createDataFrame(
        [(1, "a", day(0), "d"), (1, "a", day(5), "c"), (1, "a", day(5), "e"), (1, None, day(1), "d"), (1, None, day(2), "d")],
        "k int, agency string, at date, rating string",
    )
    got = next_event_date(df, ["k", "agency"], "at", "to", date_lit(day(99)), ties=["rating"])
    assert rows_of(got, "agency", "rating", "at", "to") == [
        ("a", "c", day(5), day(5)), ("a", "d", day(0), day(5)), ("a", "e", day(5), day(99)),
        (None, "d", day(1), day(99)), (None, "d", day(2), day(99)),
    ]


@pytest.mark.parametrize("slice_rows", [None, 1, 3, 10, 1_000_000])
def test_sliced_dates_and_totals_against_brute_force(spark, slice_rows):
    rng = random.Random(slice_rows or 0)
    data = [(rng.choice(["hot", "hot", "hot", "b", None]), day(rng.randrange(40)) if rng.random() < 0.9 else None, i, rng.choice([None, 1, 2])) for i in range(150)]
    df = spark.createDataFrame(data, "k string, d date, i int, n int").repartition(5)
    dated, total = [], []
    for k in ("hot", "b", None):
        rows = sorted((r for r in data if r[0] == k), key=lambda r: (r[1] is None, r[1] or day(0), r[2]))
        so_far = None
        for j, r in enumerate(rows):
            after = rows[j + 1][1] if k is not None and j + 1 < len(rows) else None
            dated.append((k, r[2], after or day(99)))
            so_far = so_far if r[3] is None else (so_far or 0) + r[3]
            total.append((k, r[2], so_far))
    order = lambda rows: sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])
    assert rows_of(next_event_date(df, ["k"], "d", "to", date_lit(day(99)), ["i"], slice_rows=slice_rows), "k", "i", "to") == order(dated)
    assert rows_of(running_totals(df, ["k"], ["d", "i"], {"t": "n"}, slice_rows=slice_rows), "k", "i", "t") == order(total)


def test_slices_are_bounded_and_the_same_in_any_partitions(spark):
    """A key with a third of all rows: its slices stay near the size that was asked for."""
    df = spark.range(90_000).selectExpr("if(id % 3 = 0, 0, id) as k", "id as i")
    one, other = (sliced(d, ["k"], ["i"], 1000) for d in (df.repartition(3), df.repartition(11, "i")))
    sizes = {r["__slice"]: r["count"] for r in one.groupBy("__slice").count().collect()}
    assert sizes == {r["__slice"]: r["count"] for r in other.groupBy("__slice").count().collect()}
    assert 60 <= len(sizes) <= 130 and max(sizes.values()) < 10_000
    hot = one.where("k = 0")
    assert hot.where("__opened").select("__slice").distinct().count() > 15
    # neighbours: where a key goes on, the next slice begins with the row that was told
    begins = {r["__slice"]: r["i"] for r in hot.groupBy("__slice").agg(F.min("i").alias("i")).collect()}
    told = hot.where("__goes_on").select("__slice", F.col("__next.o0").alias("i")).distinct().collect()
    assert told and all(begins[r["__slice"] + 1] == r["i"] for r in told)


@pytest.mark.parametrize("slice_rows, group_rows", [(1, 7), (3, 20), (3, 4), (5, 60)])
def test_small_slices_come_in_groups(spark, monkeypatch, slice_rows, group_rows):
    """Only the groups' cuts go to every row, and results are those of whole keys."""
    monkeypatch.setattr(slices, "GROUP_ROWS", group_rows)
    rng = random.Random(slice_rows * group_rows)
    data = [(rng.choice(["hot", "hot", "hot", "b", None]), rng.choice([None, *range(30)]), i, rng.choice([None, 0.5, 1.0])) for i in range(400)]
    df = spark.createDataFrame(data, "k string, d int, i int, v double").repartition(5)
    w = Window.partitionBy("k").orderBy(F.asc_nulls_last("d"), "i")
    rolled = {f"m_{n}yrs": F.when(F.count("v").over(w.rowsBetween(1 - n, 0)) == n, F.sum("v").over(w.rowsBetween(1 - n, 0))) for n in (1, 2, 3, 4)}
    assert rows_of(rolling_rows(df, ["k"], ["d", "i"], {"m": "v"}, "sum", slice_rows=slice_rows)) == rows_of(df.withColumns(rolled))
    total = df.withColumn("t", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert rows_of(running_totals(df, ["k"], ["d", "i"], {"t": "v"}, slice_rows=slice_rows)) == rows_of(total)
    # rows alike in key and order lie in one slice, and every row is told where the next one begins
    found = sliced(df, ["k"], ["d"], slice_rows)
    assert found.select("__slice_group").distinct().count() > 3
    rows = found.groupBy("k", "__slice").agg(F.min("d").alias("lo"), F.max(F.col("__next.o0")).alias("next"), F.max("__goes_on").alias("on")).collect()
    assert sum(r.on for r in rows) > 3
    for k in ("hot", "b", None):
        own = sorted((r for r in rows if r.k == k), key=lambda r: r["__slice"])
        for one, following in zip(own, [*own[1:], None]):
            assert one.on == (following is not None) and (following is None or one.next == following.lo)
    places = found.groupBy("k", "d").agg(F.count_distinct("__slice").alias("n"))
    assert places.where("n > 1").count() == 0


def test_the_cuts_sent_to_every_row_are_few(spark):
    """One for each group of slices, however small the slices are."""
    df = spark.range(300_000).selectExpr("id % 5 as k", "id as i")
    one = sliced(df, ["k"], ["i"], 3)
    assert one.select("__slice").distinct().count() > 70_000
    assert one.select("__slice_group").distinct().count() < 20


def test_running_totals(spark):
    df = spark.createDataFrame([(1, i, i) for i in (1, 2, 3)], "k int, i int, n int")
    assert rows_of(running_totals(df, ["k"], ["i"], {"t": "n"}), "i", "t") == [(1, 1), (2, 3), (3, 6)]


# --- intervals ------------------------------------------------------------------------------


def test_interval_join_against_brute_force(spark):
    rng = random.Random(5)
    # one key holds most points and periods, and periods reach over several years
    key = lambda: "hot" if rng.random() < 0.6 else rng.choice("abc")
    points = [(i, key(), day(rng.randrange(-900, 900))) for i in range(300)] + [(999, "hot", None), (998, None, day(0))]
    periods = [(key(), day(s), day(s + rng.randrange(-30, 800))) for s in (rng.randrange(-900, 900) for _ in range(60))]
    p = spark.createDataFrame(points, "id int, k string, at date")
    q = spark.createDataFrame(periods, "k string, s date, e date")
    pairs = [(i, k, at, s, e) for i, k, at in points for k2, s, e in periods if k == k2 and at and s <= at <= e]
    assert rows_of(interval_join(p, q, ["k"], "at", "s", "e")) == sorted(pairs, key=lambda r: [(v is None, str(v)) for v in r])
    inside = sorted({(str(r[0]),) for r in pairs})
    semi = interval_join(p, q.where("s <= e"), ["k"], "at", "s", "e", how="left_semi")
    assert sorted((str(r.id),) for r in semi.collect()) == inside
    with pytest.raises(ValueError):
        interval_join(p, q, ["k"], "at", "s", "e", how="outer")


def test_merge_periods(spark):
    df = spark.createDataFrame(
        [("a", day(0), day(5)), ("a", day(3), day(4)), ("a", day(5), day(9)), ("a", day(20), day(21)), ("a", day(0), day(2))],
        "k string, s date, e date",
    )
    assert rows_of(merge_periods(df, ["k"], "s", "e"), "s", "e") == [(day(0), day(9)), (day(20), day(21))]


def test_extract_periods(spark):
    texts = [
        "Disqualified from 01/02/2016 to 01/02/2021", " FROM 01/02/16 TO 01/02/21 ", "from 01/02/2021 to 01/02/2016",
        "from 1/2/2016 to 1/2/2021", None, "nothing",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    d = dt.date
    assert rows_of(extract_periods(df, "t"), "i", "from_date", "to_date") == [
        (0, d(2016, 2, 1), d(2021, 2, 1)), (1, d(2016, 2, 1), d(2021, 2, 1)),
    ]
    # only two digits are read: 2016 and 2021 both become 2020, so the first is no period
    assert rows_of(extract_periods(df, "t", strict=True), "i", "from_date") == [(1, d(2016, 2, 1))]


# --- answers and members --------------------------------------------------------------------


def test_answer_scores(spark):
    df = spark.createDataFrame(
        [(1, "Favourable"), (1, "DISCLAIMER"), (2, "favourable"), (2, None), (3, " favourable"), (4, None), (None, "favourable")],
        "k int, a string",
    )
    assert rows_of(answer_scores(df, ["k"], {"s": "a"})) == [(1, 0.0), (2, 1.0), (3, 0.5), (4, 0.5)]


def test_scores_by_year_equal_rolling_over_completed_years(spark):
    rng = random.Random(7)
    years = [f"{y}-{y + 1}" for y in range(2000, 2004)]
    data = [(k, rng.choice(years[: k % 4 + 1]), rng.choice(["favourable", "unfavourable", "x", None])) for k in range(8) for _ in range(3)]
    df = spark.createDataFrame(data, "k int, fy string, a string")
    got = answer_scores_by_year(df, "k", "fy", years, {"s": "a"})
    keys = df.select("k").distinct().withColumnRenamed("k", "company_master_id")
    spine = company_years(keys, years).withColumnsRenamed({"company_master_id": "k", "financial_year": "fy"})
    scored = answer_scores(complete_with(df, spine, ["k", "fy"]), ["k", "fy"], {"s": "a"})
    rolled = rolling_rows(scored, ["k"], ["fy"], {"s": "s"}).where(F.col("fy") == years[-1])
    assert rows_of(got) == rows_of(rolled, *got.columns)


def test_universe(spark):
    df = spark.createDataFrame([(1, 10), (9, 90)], "company_master_id bigint, v int")
    small = Universe.of(spark, [2, 1, 1])
    assert rows_of(small.restrict(df)) == [(1, 10)]
    assert rows_of(small.zero_fill(df, ["v"])) == [(1, 10), (2, 0)]
    assert rows_of(small.flag(df, "f")) == [(1, 1), (2, 0)]
    assert rows_of(Universe.of(spark, range(1, 2000)).restrict(df)) == [(1, 10), (9, 90)]
    framed = Universe.of(spark, spark.createDataFrame([("1",), ("1",), (None,)], "id string"))
    assert rows_of(framed.ids) == [(1,)] and rows_of(framed.restrict(df)) == [(1, 10)]
    ranked = spark.createDataFrame([(99, 9)], "rank int, company_master_id int")
    assert rows_of(Universe.of(spark, ranked).restrict(df)) == [(9, 90)]
    assert Universe.of(spark, []).restrict(df).count() == 0
    with pytest.raises(ValueError):
        Universe.of(spark, ranked.withColumnRenamed("company_master_id", "company"))


def test_membership_is_a_semi_anti_split(spark):
    base = spark.range(50).withColumnRenamed("id", "k")
    members = spark.createDataFrame([(i % 7,) for i in range(30)], "k bigint")
    flagged = membership_flag(base, members, "k", "f")
    assert rows_of(flagged.where("f = 1"), "k") == rows_of(base.join(members, "k", "left_semi"))
    assert rows_of(flagged.where("f = 0"), "k") == rows_of(base.join(members, "k", "left_anti"))
    assert dict(flagged.dtypes)["f"] == "tinyint"


def test_complete_with_and_side_by_side(spark):
    df = spark.createDataFrame([(1, "x", 5), (1, "x", 6)], "k int, y string, v int")
    spine = spark.createDataFrame([(1, "x"), (1, "w"), (2, "x")], "k int, y string")
    assert rows_of(complete_with(df, spine, ["k", "y"])) == [(1, "w", None), (1, "x", 5), (1, "x", 6), (2, "x", None)]
    a = spark.createDataFrame([(1, 5)], "k int, a int")
    b = spark.createDataFrame([(2, 6)], "k int, b int")
    assert rows_of(side_by_side([a, b], ["k"])) == [(1, 5, None), (2, None, 6)]


def test_conditional_distinct_against_brute_force(spark):
    rng = random.Random(1)
    data = [("hot" if rng.random() < 0.5 else rng.choice("ab"), rng.choice([None, *range(20)]), rng.choice("xy")) for _ in range(300)]
    df = spark.createDataFrame(data, "g string, i int, c string")
    got = conditional_distinct(df, ["g"], "i", {"all": F.lit(True), "x": F.col("c") == "x"})
    want = [
        (g, len({i for g2, i, _ in data if g2 == g and i is not None}), len({i for g2, i, c in data if g2 == g and i is not None and c == "x"}))
        for g in ("a", "b", "hot")
    ]
    assert rows_of(got) == want


def test_explode_ids(spark):
    df = spark.createDataFrame([(1, "'AA', \"BB\",,"), (2, None), (3, "")], "k int, ids string")
    assert rows_of(explode_ids(df, "ids", "id")) == [(1, "AA"), (1, "BB")]
    assert rows_of(explode_ids(df, "ids", "id", strict=True)) == [(1, " BB"), (1, "AA")]
    assert rows_of(explode_ids(df, "ids", "ids")) == [(1, "AA"), (1, "BB")]


# --- cases ----------------------------------------------------------------------------------


def _cases(spark):
    rng = random.Random(2)
    rows = []
    for i in range(200):
        filed = rng.randrange(-100, 60)
        rows.append(("hot" if i % 3 else "cold", i % 150, day(filed), day(filed + rng.randrange(0, 50)) if rng.random() < 0.7 else None))
    return dedup_cases(spark.createDataFrame(rows, "k string, c int, filed date, disposed date"), ["k", "c"])


def test_daily_series_agrees_with_single_dates(spark):
    cases = _cases(spark)
    series = open_daily(cases, ["k"], day(0), day(40), "n")
    by_day = {(r.k, r.as_on_date): r.n for r in series.collect()}
    assert all((k, day(i)) in by_day for k in ("hot", "cold") for i in range(41))
    for i in (-50, 0, 1, 17, 40):
        for r in open_as_of(cases, ["k"], day(i), {"n": None}).collect():
            assert by_day.get((r.k, day(i)), r.n) == r.n
    assert max(d for _, d in by_day) == day(40)


def test_daily_series_as_text_and_from_one_pass(spark):
    cases = _cases(spark)
    series = open_daily(cases, ["k"], day(0), day(40), "n")
    as_text = open_daily(cases, ["k"], day(0), day(40), "n", text=True)
    assert rows_of(as_text) == sorted((k, str(d), n) for k, d, n in rows_of(series))
    # the cases are evaluated once for filings, disposals and the first day
    assert series._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_open_now_and_conditions(spark):
    cases = spark.createDataFrame(
        [(1, day(0), None, 1), (1, day(0), day(3), 1), (1, day(0), None, 0), (2, day(0), None, 0)],
        "k int, filed date, disposed date, crime int",
    )
    got = open_now(cases, ["k"], {"n": None, "crimes": F.col("crime") == 1})
    assert rows_of(got) == [(1, 2, 1), (2, 1, None)]


def test_dedup_takes_first_filing_and_last_disposal(spark):
    df = spark.createDataFrame([(1, day(4), day(5), 0), (1, day(2), day(9), 1)], "k int, filed date, disposed date, f int")
    assert rows_of(dedup_cases(df, ["k"], flags=["f"])) == [(1, day(2), day(9), 1)]


def test_key_filter_loses_no_key_and_passes_few_others(spark):
    keys = spark.range(0, 30_000, 3).selectExpr("if(id % 2 = 0, id, null) as k", "'x' as other")
    rows = spark.range(200_000).selectExpr("cast(id as int) as k", "id as row").union(spark.sql("select null, -1L"))
    got = may_be_among(rows, "k", key_bits(keys, "k"))
    assert got.columns == ["k", "row"]
    found = {r.k for r in got.collect()}
    wanted = set(range(0, 30_000, 6))
    assert wanted <= found and None not in found and len(found - wanted) < 200
    assert may_be_among(rows, "k", key_bits(keys.where("k < 0"), "k")).count() == 0
