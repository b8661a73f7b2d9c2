import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from riskfeatures.functions import dates as D
from riskfeatures.functions import numbers as N
from riskfeatures.functions import text as T

D_ = dt.date


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr.alias("y")).first().y


def calc(spark, text, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} double" for k in values))
    return row.select(F.expr(text).alias("y")).first().y


@pytest.mark.parametrize("raw", ["  Ab c\t", "\n Ab c", "Ab c ", "　Ab c\r\n"])
def test_strip_removes_every_white_space(spark, raw):
    assert one(spark, T.strip("x"), raw) == "Ab c" == raw.strip()
    assert one(spark, T.strip_lower("x"), raw) == "ab c"
    assert one(spark, T.strip_upper("x"), raw) == "AB C"


@pytest.mark.parametrize("raw", ["", " ", " \t", "a", " a ", "~!", "\x7fa ", " \x1fa", "a\x85", "é ", " a é\u3000", "a\u00a0 ", None])
def test_strip_equals_trimming_the_whole_set(spark, raw):
    assert one(spark, T.strip("x"), raw) == (None if raw is None else raw.strip())


def test_strip_looks_at_the_ends_of_plain_texts_alone(spark):
    # the set, in which each character of a text would be looked up, is needed for other texts only
    assert T.strip("x")._jc.toString().upper().startswith("CASE WHEN")


def test_contains_is_false_for_null(spark):
    assert one(spark, T.contains("x", "nominee"), None) is False
    assert one(spark, T.contains("x", "nominee"), "nominee director") is True


def test_year_filter_takes_blanks_after_the_label(spark):
    ok = lambda v: one(spark, T.is_one_of_years("x", ["2019-2020"]), v)
    assert ok("2019-2020") and ok("2019-2020 \t")
    assert not ok("2019-20201") and not ok("2018-2019")


@pytest.mark.parametrize(
    "text, day", [("1/2/2020", D_(2020, 2, 1)), ("31/12/1999", D_(1999, 12, 31)), ("2020-01-02", None), ("31/02/2020", None), ("1/2/20", None), ("1/2/2020/3", None), ("3/1/2/2020", None), ("1/2/2020 x", None), ("//2020", None), ("01/02/20/3", None), (None, None)]
)
def test_parse_dmy(spark, text, day):
    assert one(spark, D.parse_dmy("x"), text) == day


@pytest.mark.parametrize("text, day", [("2020-02-03", D_(2020, 2, 3)), ("2020-02-30", None), ("2020", None), ("2020-02", None), ("2020-02-03 10:00:00", None), ("", None)])
def test_parse_iso(spark, text, day):
    assert one(spark, D.parse_iso("x"), text) == day


def test_parse_day_first(spark):
    assert one(spark, D.parse_day_first("x"), "03-02-2020") == D_(2020, 2, 3)
    assert one(spark, D.parse_day_first("x"), "2020-02-03") is None


@pytest.mark.parametrize(
    "text, day",
    [
        ("01/02/68", D_(2068, 2, 1)),
        ("01/02/69", D_(1969, 2, 1)),
        ("01/02/99", D_(1999, 2, 1)),
        ("01/02/00", D_(2000, 2, 1)),
        ("29/02/00", D_(2000, 2, 29)),
        ("15/08/2016", D_(2016, 8, 15)),
        ("", None),
    ],
)
def test_parse_two_or_four_digit_years(spark, text, day):
    assert one(spark, D.parse_dm_any_year("x"), text) == day


@pytest.mark.parametrize("year, day", [("1899", D_(1899, 1, 1)), ("0", None), ("x", None), (None, None), ("99999", None)])
def test_first_of_january(spark, year, day):
    assert one(spark, D.first_of_january("x"), year) == day


@pytest.mark.parametrize("day, label", [(D_(2020, 3, 31), "2019-2020"), (D_(2020, 4, 1), "2020-2021"), (None, None)])
def test_financial_year_edges(spark, day, label):
    assert one(spark, D.financial_year("x"), day, "date") == label


def test_financial_year_bounds(spark):
    start, end = D.fy_bounds("x", 1)
    assert one(spark, F.array(start, end), D_(2020, 3, 31), "date") == [D_(2018, 4, 1), D_(2019, 3, 31)]
    assert D.indian_financial_year(D_(2020, 3, 31), 1) == (D_(2018, 4, 1), D_(2019, 3, 31))
    for call in (lambda: D.fy_bounds("x", -1), lambda: D.indian_financial_year(D_(2020, 1, 1), -1), lambda: D.quarter_bounds("x", -1)):
        with pytest.raises(ValueError):
            call()


def test_quarters(spark):
    day = D_(2020, 6, 30)
    assert one(spark, F.array(*D.quarter_bounds("x")), day, "date") == [D_(2020, 4, 1), D_(2020, 6, 30)]
    assert one(spark, F.array(*D.quarter_bounds("x", 1)), day, "date") == [D_(2020, 1, 1), D_(2020, 3, 31)]
    assert one(spark, D.quarter_bounds("x", 1, strict=True)[1], day, "date") == D_(2020, 3, 30)


def test_report_period(spark):
    for bureau, want in (("cibil", [D_(2020, 4, 1), D_(2020, 6, 30)]), ("other", [D_(2020, 5, 1), D_(2020, 5, 31)])):
        assert one(spark, F.array(*D.report_period("x", F.lit(bureau))), D_(2020, 5, 31), "date") == want


def test_cap(spark):
    as_on = D_(2020, 5, 1)
    for day, want in ((None, as_on), (D_(2021, 1, 1), as_on), (D_(2019, 1, 1), D_(2019, 1, 1))):
        assert one(spark, D.cap_at("x", as_on), day, "date") == want


def test_as_on_calendar():
    late, early = D.AsOn(D_(2020, 8, 1), D_(2021, 1, 1)), D.AsOn(D_(2020, 3, 31), D_(2020, 3, 31))
    assert late.valid_years == ["2016-2017", "2017-2018", "2018-2019", "2019-2020"]
    assert late.financial_year == "2019-2020" and late.is_past
    assert early.valid_years[-1] == "2018-2019" == early.financial_year and not early.is_past


@pytest.mark.parametrize(
    "a, b, want",
    [(1, 2, 0.5), (1, 0, math.inf), (-1, 0, -math.inf), (1, -0.0, -math.inf), (-1, -0.0, math.inf), (0, 0, None), (None, 0, None), (1, None, None)],
)
def test_ieee_div(spark, a, b, want):
    a, b = (v if v is None else float(v) for v in (a, b))
    assert calc(spark, N.ieee_div("a", "b"), a=a, b=b) == want


def test_missing_values(spark):
    nan, inf = math.nan, math.inf
    assert calc(spark, N.nan_to_null("a"), a=nan) is None
    assert calc(spark, N.nan_to_null("a"), a=inf) == inf
    assert [calc(spark, N.inf_to_null("a"), a=v) for v in (nan, inf, -inf, 2.0)] == [None, None, None, 2.0]
    assert calc(spark, N.nan_to_null("a - b"), a=inf, b=inf) is None


def test_changes_and_growth(spark):
    assert calc(spark, N.rel_change("a", "b"), a=3.0, b=2.0) == 0.5
    assert calc(spark, N.rel_change("a", "b"), a=3.0, b=0.0) is None
    assert calc(spark, N.growth_rate("a", "b", 2), a=4.0, b=1.0) == 1.0
    for a, b in ((-4.0, 1.0), (0.0, 1.0), (0.0, 0.0), (None, 1.0)):
        assert calc(spark, N.growth_rate("a", "b", 2), a=a, b=b) is None


def test_sums(spark):
    assert calc(spark, N.sum_cols(["a", "b"]), a=1.0, b=None) is None
    assert calc(spark, N.sum_cols(["a", "b"], nulls="skip"), a=1.0, b=None) == 1.0
    with pytest.raises(ValueError):
        N.sum_cols(["a"], nulls="x")


def test_to_num(spark):
    assert one(spark, F.expr(N.to_num("x", "bigint")), " 12") == 12
    assert one(spark, F.expr(N.to_num("x", "bigint")), "unknown") is None
