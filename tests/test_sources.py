import datetime as dt

import pytest
from helpers import rows_of
from pyspark.sql import Observation

from riskfeatures.operators.members import Universe
from riskfeatures.sources import CONNECTION_OF, TABLES, Sources
from riskfeatures.sources.registry import key_predicates


@pytest.fixture
def ratings(spark):
    return spark.createDataFrame(
        [("1", " X", "D", "2020-01-02"), ("2", None, "A", "bad"), ("x", "Y", "A", "2020-02-03")],
        "company_master_id string, credit_rating_agency string, derived_long_term_rating string, d_date_of_last_rating string",
    )


def test_every_table_has_a_connection_and_keys():
    assert set(CONNECTION_OF) == set(TABLES)
    assert all({"company_master_id", "director_master_id", "din"} & set(columns) for columns in TABLES.values())


def test_unknown_names_are_refused(spark):
    with pytest.raises(ValueError, match="unknown connection"):
        Sources(spark).add_files("somewhere", "/tmp")
    with pytest.raises(ValueError, match="unknown table"):
        Sources(spark).raw("nothing")
    with pytest.raises(ValueError, match="not registered"):
        Sources(spark).raw("director_master")


def test_typed_read(spark, ratings):
    source = Sources(spark, {"credit_rating_data": ratings})
    got = source.read("credit_rating_data", ["company_master_id", "d_date_of_last_rating"])
    assert got.dtypes == [("company_master_id", "bigint"), ("d_date_of_last_rating", "date")]
    assert rows_of(got) == [(1, dt.date(2020, 1, 2)), (2, None), (None, dt.date(2020, 2, 3))]
    for columns, message in ((["zzz"], "unknown column"), (["company_master_id", "d_quarter"], "unknown column")):
        with pytest.raises(ValueError, match=message):
            source.read("credit_rating_data", columns)
    with pytest.raises(ValueError, match="lacks column"):
        Sources(spark, {"credit_rating_data": ratings.drop("credit_rating_agency")}).read(
            "credit_rating_data", ["credit_rating_agency"]
        )


def test_filters_keys_and_limit(spark, ratings):
    source = Sources(spark, {"credit_rating_data": ratings})
    columns = ["company_master_id", "derived_long_term_rating"]
    by_value = source.read("credit_rating_data", columns, filters={"derived_long_term_rating": ["A"], "company_master_id": [2, 3]})
    assert rows_of(by_value) == [(2, "A")]
    keys = spark.createDataFrame([(1,), (7,)], "company_master_id bigint")
    assert rows_of(source.read("credit_rating_data", columns, keys=keys)) == [(1, "D")]
    assert source.read("credit_rating_data", columns, limit=2).count() == 2
    assert source.read("credit_rating_data", columns, filters={"derived_long_term_rating": []}).count() == 0
    with pytest.raises(ValueError, match="unknown column"):
        source.read("credit_rating_data", columns, filters={"nope": [1]})


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_file_sources(spark, ratings, tmp_path, fmt):
    ratings.where("company_master_id != 'x'").write.format(fmt).save(str(tmp_path / "credit_rating_data"))
    source = Sources(spark).add_files("live_crawler_output", str(tmp_path), fmt)
    got = source.read("credit_rating_data", ["company_master_id", "derived_long_term_rating"])
    assert rows_of(got) == [(1, "D"), (2, "A")]


def test_csv_with_header_goes_by_name(spark, ratings, tmp_path):
    swapped = ratings.select(*reversed(ratings.columns))
    swapped.write.csv(str(tmp_path / "credit_rating_data"), header=True)
    source = Sources(spark).add_files("live_crawler_output", str(tmp_path), "csv", header=True)
    assert rows_of(source.read("credit_rating_data", ["company_master_id"])) == [(1,), (2,), (None,)]


def test_filters_and_columns_reach_a_parquet_scan(spark, tmp_path):
    frame = spark.range(10).selectExpr(
        "id as company_master_id", "'2019-2020' as financial_year", "'x' as auditor_pan", "'y' as auditor_firm",
        "'2020-01-01' as auditor_resignation_date",
    )
    frame.write.parquet(str(tmp_path / "adt3_general_resignation_dtls"))
    source = Sources(spark).add_files("etl_etl_data", str(tmp_path))
    got = source.read("adt3_general_resignation_dtls", ["company_master_id"], filters={"company_master_id": [3]})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(company_master_id,3)" in plan
    assert "ReadSchema: struct<company_master_id:bigint>" in plan


def test_jdbc_options():
    slices = {"partitionColumn": "id", "lowerBound": 0, "upperBound": 100, "numPartitions": 8}
    options = Sources.jdbc_options("t", "jdbc:mysql://host/db", user="u", schema="s", partition=slices)
    assert options == {"url": "jdbc:mysql://host/db", "dbtable": "s.t", "fetchsize": 10_000, "user": "u", **slices}
    with pytest.raises(ValueError):
        Sources.jdbc_options("t", "url", partition={"partitionColumn": "id"})


def test_jdbc_needs_a_word_on_every_table(spark):
    def slices(column):
        return {"partitionColumn": column, "lowerBound": 0, "upperBound": 100, "numPartitions": 8}

    with pytest.raises(ValueError, match="says nothing"):
        Sources(spark).add_jdbc("live_crawler_output", "jdbc:mysql://host/db").raw("director_master")
    for table, columns in TABLES.items():
        column = "company_master_id" if "company_master_id" in columns else next(iter(columns))
        assert Sources.jdbc_options(table, "url", partition=slices(column))["partitionColumn"] == column
    with pytest.raises(ValueError, match="no column"):
        Sources.jdbc_options("director_master", "url", partition=slices("company_master_id"))


def test_key_predicates_are_disjoint_and_whole(spark):
    ids = [*range(2500), 7, 7, -3]
    conditions = key_predicates("company_master_id", ids)
    assert len(conditions) == 3
    rows = spark.range(-10, 3000).withColumnRenamed("id", "company_master_id")
    met = [rows.where(c).count() for c in conditions]
    assert met == [1000, 1000, 501]
    assert rows.where(" or ".join(f"({c})" for c in conditions)).count() == 2501
    assert rows.where(" or ".join(key_predicates("company_master_id", []))).count() == 0
    with pytest.raises(ValueError):
        key_predicates("company_master_id", ["1) or (1 = 1"])


def test_ids_reach_the_database(spark):
    class Reader:
        def jdbc(self, url, table, predicates=None, properties=None):
            asked.append((url, table, predicates, properties))
            return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in TABLES[table].items()))

    class Session:
        read = Reader()

    asked = []
    wanted = Universe.of(spark, range(1500)).wanted
    for table, columns in TABLES.items():
        if "company_master_id" not in columns:
            with pytest.raises(ValueError, match="one column"):
                Sources(Session()).add_jdbc(CONNECTION_OF[table], "jdbc:mysql://host/db").read(table, only=wanted)
            continue
        Sources(Session()).add_jdbc(CONNECTION_OF[table], "jdbc:mysql://host/db", user="u").read(table, only=wanted)
        url, name, predicates, properties = asked.pop()
        assert (url, name, properties) == ("jdbc:mysql://host/db", table, {"fetchsize": "10000", "user": "u"})
        assert predicates == key_predicates("company_master_id", range(1500)) and len(predicates) == 2
    assert Universe.of(spark, spark.range(5)).wanted == {}


def test_lost_values_are_counted_in_the_reading_pass(spark, ratings):
    seen = Observation()
    got = Sources(spark, {"credit_rating_data": ratings}).read("credit_rating_data", observation=seen)
    assert got.count() == 3
    assert seen.get == {"company_master_id": 1, "d_date_of_last_rating": 1}
    nothing = Observation()
    exact = ratings.select("credit_rating_agency", "derived_long_term_rating")
    assert Sources(spark, {"credit_rating_data": exact}).read("credit_rating_data", observation=nothing).count() == 3
    assert nothing.get == {"none": 0}


def test_strict_reads_fail_on_a_bad_value_alone(spark, ratings):
    source = Sources(spark, {"credit_rating_data": ratings})
    with pytest.raises(Exception, match="company_master_id: not a bigint: x"):
        source.read("credit_rating_data", ["company_master_id"], strict=True).collect()
    good = Sources(spark, {"credit_rating_data": ratings.where("credit_rating_agency = ' X' or company_master_id is null")})
    assert rows_of(good.read("credit_rating_data", ["company_master_id", "d_date_of_last_rating"], strict=True)) == [(1, dt.date(2020, 1, 2))]
    assert rows_of(source.read("credit_rating_data", ["company_master_id"])) == [(1,), (2,), (None,)]
