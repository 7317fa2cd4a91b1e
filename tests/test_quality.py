import datetime as dt

import pytest
from pyspark.sql import functions as F

from priceloom.quality import (
    QualityGateError,
    accepted,
    compare_builds,
    failing_rows,
    freshness,
    holds,
    not_after,
    not_null,
    raise_on_errors,
    refers_to,
    run_checks,
    unique,
)


@pytest.fixture()
def table(spark):
    t = dt.datetime(2026, 6, 3, 10)
    return spark.createDataFrame(
        [("1", "a", 0.4, t), ("1", "b", 1.5, t), (None, "b", 3.6, t), (None, None, None, t + dt.timedelta(days=1))],
        "id string, kind string, price double, t timestamp_ntz",
    )


def test_every_check_finds_its_defect(spark, table):
    parent = spark.createDataFrame([("a",)], "kind string")
    now = F.lit("2026-06-03 12:00:00").cast("timestamp_ntz")
    checks = [
        not_null("id"), accepted("kind", ["a"]), holds("price", "between 0.5 and 3.5", "warn"), not_after("t", now),
        unique("id"), unique("id", "kind"), refers_to("kind", parent, "kind"), unique("kind", "price"), not_null("t"),
    ]
    got = [(r["check"].split(":")[0], r["failures"], r["status"]) for r in run_checks(table, checks).collect()]
    assert sorted(got) == sorted([
        ("not_null", 2, "error"), ("accepted_values", 2, "error"), ("expression", 2, "warn"),
        ("not_in_future", 1, "error"), ("unique", 1, "error"), ("unique_combination", 0, "pass"),
        ("relationships", 2, "error"), ("unique_combination", 0, "pass"), ("not_null", 0, "pass"),
    ])
    counts = [failing_rows(table, c).count() for c in checks]
    assert counts == [2, 2, 2, 1, 1, 0, 1, 0, 0]


def test_nulls_form_a_repeated_combination(table):
    twice = table.union(table.filter("kind is null"))
    assert run_checks(twice, [unique("id", "kind")]).first()["failures"] == 1


def test_row_checks_share_one_pass(table):
    plan = run_checks(table, [not_null("id"), not_null("kind"), holds("price", "> 0")])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Aggregate") == 1


def test_warnings_pass_and_errors_stop(table):
    assert raise_on_errors(run_checks(table, [holds("price", "< 1", "warn")]))[0]["status"] == "warn"
    with pytest.raises(QualityGateError, match=r"events: not_null\(id\): 2"):
        raise_on_errors(run_checks(table, [not_null("id")]), "events")


@pytest.mark.parametrize(
    ("minutes", "status"), [(60, "pass"), (90, "pass"), (91, "warn"), (120, "warn"), (360, "warn"), (420, "error")]
)
def test_freshness(spark, minutes, status):
    loaded = dt.datetime(2026, 6, 3, 10)
    df = spark.createDataFrame([(loaded,)], "t timestamp_ntz")
    row = freshness(df, "t", loaded + dt.timedelta(minutes=minutes)).first()
    assert (row["age_minutes"], row["status"]) == (minutes, status)


def test_an_empty_source_is_not_fresh(spark):
    empty = spark.createDataFrame([], "t timestamp_ntz")
    assert freshness(empty, "t", dt.datetime(2026, 6, 3)).first()["status"] == "error"


def test_compare_builds(spark, table):
    other = table.filter("price > 1 or price is null")
    same = {r["metric"]: r["same"] for r in compare_builds(table, table, ["price"], ["id", "kind"]).collect()}
    assert all(same.values()) and len(same) == 5
    differs = {r["metric"] for r in compare_builds(table, other, ["price"], ["id", "kind"]).filter("not same").collect()}
    assert differs == {"row_count", "price_min", "distinct_kind"}


def test_one_pass_counts_what_single_checks_find(spark):
    from pyspark.sql import functions as F

    from priceloom.quality import accepted, failing_rows, not_null, refers_to, run_checks, unique

    rows = [(i % 7 or None, f"k{i % 5}", None if i % 4 == 0 else i % 3, i) for i in range(60)] + [(None, None, None, 1)] * 2
    df = spark.createDataFrame(rows, "a long, b string, c int, d long")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,), (2**40,)], "p long")
    texts = spark.createDataFrame([("k1",), ("k2",)], "p string")
    checks = [
        not_null("a"), unique("a"), unique("d"), unique("a", "b"), unique("b", "c"), refers_to("a", parent, "p"), refers_to("c", parent, "p"),
        refers_to("b", texts, "p"), accepted("b", ["k1"]), unique("c", "a", "b", "d"),
    ]
    got = [r["failures"] for r in run_checks(df, checks).collect()]

    def alone(check):
        found = failing_rows(df, check)
        return found.agg(F.sum("row_count")).first()[0] or 0 if check.parent is not None else found.count()

    assert got == [alone(c) for c in checks]
    assert [r["failures"] for r in run_checks(df.limit(0), checks).collect()] == [0] * len(checks)


def test_one_pass_reads_the_table_once(spark, tmp_path):
    from priceloom.quality import not_null, refers_to, run_checks, unique

    for name in ("child", "parent"):
        spark.range(100).selectExpr("id", "id % 10 AS k").write.parquet(str(tmp_path / name))
    child, parent = (spark.read.parquet(str(tmp_path / n)) for n in ("child", "parent"))
    results = run_checks(child, [not_null("id"), unique("id"), unique("k", "id"), refers_to("k", parent, "id")])
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2  # the table once, the parent once
    assert [r["failures"] for r in results.collect()] == [0, 0, 0, 0]


def test_audit_in_one_scan(spark):
    from priceloom.sources.profile import audit

    df = spark.createDataFrame([(1, "a", 1.5), (2, "a", None), (None, "b", -2.0), (2, None, 4.0)], "i int, s string, x double")
    row = audit(df, ["x", "s"], ["i", "s", "x"]).first()
    assert row.asDict() == {
        "row_count": 4, "x_min": -2.0, "x_max": 4.0, "s_min": "a", "s_max": "b", "distinct_i": 2, "distinct_s": 2, "distinct_x": 3
    }
    assert audit(df.limit(0), ["x"], ["i", "s"]).first().asDict() == {"row_count": 0, "x_min": None, "x_max": None, "distinct_i": 0, "distinct_s": 0}


def test_fingerprints_name_the_partition_that_differs(spark):
    import pytest

    from priceloom.contracts import ContractError
    from priceloom.quality import differing_partitions

    rows = [("a", 1, 1.5), ("a", 2, 2.5), ("b", 3, None), ("b", 3, None), (None, 4, 0.0)]
    left = spark.createDataFrame(rows, "part string, k int, v double")
    found = lambda other: sorted(map(tuple, differing_partitions(left, other, ["part"]).collect()), key=str)
    other = lambda *r: spark.createDataFrame(list(r), left.schema)
    assert found(left.orderBy("k", ascending=False)) == []
    assert found(other(*rows[:2], ("b", 3, None), *rows[4:])) == [("b", 2, 1)]  # a repeated row counts
    assert found(other(("a", 2, 1.5), ("a", 1, 2.5), *rows[2:])) == [("a", 2, 2)]  # same values, other rows
    assert found(other(*rows[:4])) == [(None, 1, 0)]
    assert found(other(*rows, ("c", 1, 1.0))) == [("c", 0, 1)]
    with pytest.raises(ContractError):
        differing_partitions(left, left.withColumn("k", left.k.cast("long")), ["part"])
