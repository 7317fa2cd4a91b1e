import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from priceloom.contracts import DIM_CARBURANT, ContractError, check_contract, conform, guard_not_null, require_contract
from priceloom.operators import (
    after,
    calendar,
    cheapest_groups,
    distinct_members,
    duplicate_keys,
    enrich,
    gap_to_group_mean,
    group_stats,
    high_watermark,
    kpis,
    merge_by_key,
    orphans,
    pick_one,
    rank_in_group,
    rank_with_gap,
    top_n,
)
from priceloom.operators.merge import read_table
from priceloom.plans.build import materialize, table_path
from priceloom.sources.reference import departments, read_reference_csv


def day(n):
    return dt.date(2026, 6, n)


def hour(n, d=3):
    return dt.datetime(2026, 6, d, n)


def test_pick_one_keeps_first_and_last(spark):
    df = spark.createDataFrame([("k", hour(11), "b"), ("k", hour(10), "a"), ("j", hour(9), "c")], "k string, t timestamp_ntz, v string")
    assert sorted(r["v"] for r in pick_one(df, ["k"], [F.col("t").asc()]).collect()) == ["a", "c"]
    assert sorted(r["v"] for r in pick_one(df, ["k"], [F.col("t").desc()]).collect()) == ["b", "c"]


def test_pick_one_is_defined_on_ties(spark):
    rows = [("k", 1, v) for v in "dcba"]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k string, t int, v string").repartition(3)
        assert pick_one(df, ["k"], [F.col("t").asc()]).first()["v"] == "a"


def test_pick_one_cuts_down_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = pick_one(df, ["k"], [F.col("id").asc()])._jdf.queryExecution().executedPlan().toString()
    top, bottom = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in top and "WindowGroupLimit" in bottom


def brute_ranks(rows):
    out = []
    for g, p, i in rows:
        same = [q for h, q, _ in rows if h == g]
        out.append((g, p, i, 1 + sum(q < p for q in same), 1 + sum(q > p for q in same)))
    return sorted(out, key=str)


def test_ranks_match_brute_force(spark):
    rng = random.Random(3)
    prices = [Decimal(x) for x in ("-250.001", "0.000", "99.999", "100.000", "100.001", "1.5", "1.6", "9999.999")]
    rows = [(rng.choice(["a", "b", None]), rng.choice(prices).quantize(Decimal("0.001")), i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, p decimal(10,3), i int")
    got = rank_in_group(df, ["g"], "p").select("g", "p", "i", "rank_asc", "rank_desc").collect()
    want = brute_ranks(rows)
    assert sorted(map(tuple, got), key=str) == want
    top = top_n(df, ["g"], "p", 20).select("g", "p", "i", "rank").collect()
    assert sorted(map(tuple, top), key=str) == [r[:4] for r in want if r[3] <= 20]
    flop = top_n(df, ["g"], "p", 20, smallest=False).select("g", "p", "i", "rank").collect()
    assert sorted(map(tuple, flop), key=str) == sorted([(*r[:3], r[4]) for r in want if r[4] <= 20], key=str)


def test_rank_ties_leave_gaps(spark):
    df = spark.createDataFrame([("r", Decimal(x)) for x in ("1.5", "1.5", "1.6")], "g string, p decimal(10,3)")
    assert sorted(r["rank_asc"] for r in rank_in_group(df, ["g"], "p").collect()) == [1, 1, 3]


def test_rank_refuses_floats(spark):
    with pytest.raises(TypeError):
        rank_in_group(spark.createDataFrame([("a", 1.0)], "g string, p double"), ["g"], "p")


def test_rows_are_neither_windowed_nor_shuffled_for_their_rank(spark):
    df = spark.range(100).select(F.lit("g").alias("g"), F.col("id").cast("decimal(10,3)").alias("p"), "id")
    plan = rank_in_group(df, ["g"], "p")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window" not in plan and "Exchange hashpartitioning" not in plan


def test_group_stats(spark):
    rows = [("a", Decimal(x)) for x in ("1.0", "2.0", "3.0", "4.0")] + [("b", Decimal("1.0"))]
    df = spark.createDataFrame(rows, "g string, p decimal(10,3)")
    got = {r["g"]: r.asDict() for r in group_stats(df, ["g"], "p").collect()}
    a, b = got["a"], got["b"]
    assert (a["count"], a["mean"], a["min"], a["max"]) == (4, Decimal("2.5"), 1, 4)
    assert (a["p25"], a["p50"], a["p75"]) == (1, 2, 3)
    assert float(a["stddev"]) == pytest.approx(1.290994449)
    assert b["stddev"] is None
    assert [r["g"] for r in cheapest_groups(group_stats(df, ["g"], "p"), "g").collect()] == ["b", "a"]


def test_gap_and_rank_with_gap_agree(spark):
    rows = [("a", Decimal(x), i) for i, x in enumerate(("1.1", "1.1", "2.3", "5.0"))]
    df = spark.createDataFrame(rows, "g string, p decimal(10,3), i int")
    stats = group_stats(df, ["g"], "p", {})
    plain = {r["i"]: r["gap"] for r in gap_to_group_mean(df, ["g"], "p").collect()}
    ranked = {r["i"]: r["gap"] for r in rank_with_gap(df, stats, ["g"], "p", "mean").collect()}
    assert plain == ranked and plain[0] == Decimal("-1.275")


def test_kpis(spark):
    df = spark.createDataFrame([("a", Decimal("1.5"), hour(1)), ("a", Decimal("2.5"), hour(2)), ("b", Decimal("2.0"), hour(3))], "e string, p decimal(10,3), t timestamp_ntz")
    assert tuple(kpis(df, "e", "p", "t").first()) == (Decimal("2"), Decimal("1"), 2, hour(3))


def test_joins(spark):
    events = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, k string")
    dim = spark.createDataFrame([("x", "X")], "k string, name string")
    assert enrich(events, [(dim, ["k"], "inner")]).count() == 1
    assert enrich(events, [(dim, ["k"], "left")]).filter("name is null").count() == 2
    events = events.unionByName(spark.createDataFrame([(4, "y")], events.schema))
    assert [tuple(r) for r in orphans(events, "k", dim, "k").collect()] == [("y", 2)]


def test_distinct_and_duplicates(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), ("1", "a")], "x string, y string")
    assert distinct_members(df, ["x", "y"]).count() == 2
    assert [tuple(r) for r in duplicate_keys(df, ["x", "y"]).collect()] == [(None, "a", 2)]


def test_calendar(spark):
    days = calendar(spark)
    assert days.count() == 9131
    rows = {r["full_date"]: r for r in days.filter("year >= 2026").collect()}
    a, b = rows[dt.date(2027, 1, 3)], rows[dt.date(2026, 12, 28)]
    assert (a["day_of_week"], a["iso_week"], a["is_weekend"], a["day_name_fr"], a["month_name_fr"]) == (7, 53, True, "Dimanche", "Janvier")
    assert (b["day_of_week"], b["iso_week"], b["is_weekend"], b["day_name_fr"], b["date_sk"]) == (1, 53, False, "Lundi", 20261228)
    assert (rows[dt.date(2031, 8, 1)]["month_name_fr"], rows[dt.date(2031, 8, 1)]["quarter"]) == ("Août", 3)


def test_working_days(spark):
    """Holidays that moved with Easter, and fixed ones, of ten years; all of them on weekdays."""
    moving = [
        "2015-04-06", "2015-05-14", "2015-05-25", "2016-03-28", "2016-05-05", "2016-05-16", "2017-04-17", "2017-05-25", "2017-06-05",
        "2018-04-02", "2018-05-10", "2018-05-21", "2019-04-22", "2019-05-30", "2019-06-10", "2020-04-13", "2020-05-21", "2020-06-01",
        "2021-04-05", "2021-05-13", "2021-05-24", "2022-04-18", "2022-05-26", "2022-06-06", "2023-04-10", "2023-05-18", "2023-05-29",
        "2024-04-01", "2024-05-09", "2024-05-20",
    ]
    fixed = ["01-01", "05-01", "05-08", "07-14", "08-15", "11-01", "11-11", "12-25"]
    days = {r["full_date"]: r for r in calendar(spark, "2015-01-01", "2025-01-01").collect()}
    holidays = {dt.date.fromisoformat(d) for d in moving} | {dt.date.fromisoformat(f"{y}-{d}") for y in range(2015, 2025) for d in fixed}
    assert all(r["is_working_day"] == (d.weekday() < 5 and d not in holidays) for d, r in days.items())
    assert sum(r["is_working_day"] for d, r in days.items() if d.year == 2024) == 252


def test_watermark(spark):
    df = spark.createDataFrame([(hour(9),), (hour(10),)], "t timestamp_ntz")
    assert high_watermark(None, "t") == high_watermark(df.limit(0), "t") == dt.datetime(1900, 1, 1)
    assert high_watermark(df, "t") == hour(10)
    assert after(df, "t", hour(9)).collect() == [(hour(10),)]


MERGE = "k string, t timestamp_ntz, v string, d date"


def stored(spark, path):
    return sorted(map(tuple, read_table(spark, path, spark.createDataFrame([], MERGE).schema).collect()))


def test_merge_inserts_replaces_and_moves(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda *rows: spark.createDataFrame(list(rows), MERGE)
    assert merge_by_key(path, make(("a", hour(1), "1", day(1)), ("b", hour(1), "1", day(1)), ("c", hour(1), "1", day(2))), "k", "d").inserted == 3
    untouched = [p.name for p in (tmp_path / "t" / "d=2026-06-02").iterdir()]
    change = make(("a", hour(2), "2", day(3)), ("n", hour(2), "2", day(3)), ("m", hour(2), "2", day(4)))
    for expected in ((2, 1), (0, 3)):  # a repeated merge leaves the same table
        result = merge_by_key(path, change, "k", "d")
        assert (result.inserted, result.updated) == expected
        assert stored(spark, path) == [
            ("a", hour(2), "2", day(3)), ("b", hour(1), "1", day(1)), ("c", hour(1), "1", day(2)),
            ("m", hour(2), "2", day(4)), ("n", hour(2), "2", day(3)),
        ]
    assert [p.name for p in (tmp_path / "t" / "d=2026-06-02").iterdir()] == untouched


def test_merge_keeping_the_smallest(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda *rows: spark.createDataFrame(list(rows), MERGE)
    merge_by_key(path, make(("a", hour(5), "1", day(1)), ("b", hour(5), "1", day(1))), "k", "d")
    result = merge_by_key(
        path, make(("a", hour(4), "2", day(1)), ("b", hour(6), "2", day(1))), "k", "d",
        keep_smallest="t", key_fixes_partition=True,
    )
    assert (result.inserted, result.updated) == (0, 1)
    assert stored(spark, path) == [("a", hour(4), "2", day(1)), ("b", hour(5), "1", day(1))]


def test_merge_refuses_a_changed_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", hour(5), "1", day(1))], MERGE)
    merge_by_key(path, df, "k", "d")
    for changed in (df.withColumn("new", F.lit(1)), df.withColumn("v", F.lit(1)), df.drop("v")):
        with pytest.raises(ContractError):
            merge_by_key(path, changed, "k", "d")


def test_contract(spark):
    row = spark.createDataFrame([("k", "1", "Gazole", "x")], "carburant_sk string, carburant_id string, carburant_nom string, carburant_libelle_long string")
    assert check_contract(row, DIM_CARBURANT).isEmpty()
    bad = row.withColumn("carburant_id", F.lit(1)).drop("carburant_nom").withColumn("more", F.lit(1))
    assert {r["column"]: r["problem"] for r in check_contract(bad, DIM_CARBURANT).collect()} == {
        "carburant_nom": "missing", "more": "extra", "carburant_id": "expected string, found int",
    }
    with pytest.raises(ContractError):
        require_contract(bad, DIM_CARBURANT)
    fixed = conform(row.withColumn("carburant_id", F.lit(1)).withColumn("more", F.lit(1)), DIM_CARBURANT)
    assert check_contract(fixed, DIM_CARBURANT).isEmpty()


def test_a_forbidden_null_stops_the_write_and_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "gold" / "dim_carburant")
    names = DIM_CARBURANT.fieldNames()
    good = spark.createDataFrame([("k", "1", "Gazole", "x")], ", ".join(f"{n} string" for n in names))
    materialize(good, path, "table", DIM_CARBURANT)
    bad = spark.createDataFrame([("k", None, "Gazole", "x")], good.schema)
    with pytest.raises(Exception, match="NOT NULL violated: carburant_id"):
        materialize(bad, path, "table", DIM_CARBURANT)
    with pytest.raises(Exception, match="NOT NULL violated: carburant_id"):
        guard_not_null(bad, DIM_CARBURANT).collect()
    assert spark.read.parquet(path).collect() == good.collect()
    assert materialize(good.union(good), path, "table", DIM_CARBURANT).count() == 2


def test_table_path_and_kinds(spark):
    assert table_path("/w", "fct_x") == "/w/gold/fct_x"
    assert table_path("/w", "stg_x") == table_path("/w", "other", "silver").replace("other", "stg_x") == "/w/silver/stg_x"
    df = materialize(spark.range(3).toDF("id"), "/nowhere/some_view", "view")
    assert spark.table("some_view").count() == materialize(df, "", "inline").count() == 3
    with pytest.raises(ValueError):
        materialize(df, "", "other")


def test_reference_csv_is_text(spark, tmp_path):
    (tmp_path / "d.csv").write_text("dept_code,dept_nom\n01,Ain\n2A,Corse-du-Sud\n")
    rows = read_reference_csv(spark, str(tmp_path / "d.csv"), ["dept_code", "dept_nom"])
    assert [tuple(r) for r in rows.collect()] == [("01", "Ain"), ("2A", "Corse-du-Sud")]
    known = departments(spark)
    assert (known.count(), known.select("region_nom").distinct().count()) == (101, 18)


def test_a_replacement_that_dies_between_delete_and_rename_is_finished(spark, tmp_path, monkeypatch):
    from priceloom import storage
    from priceloom.operators.merge import merge_by_key

    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(k, f"p{k % 2}", k) for k in range(6)], "id long, part string, v long")
    merge_by_key(path, rows, "id", "part")
    change = spark.createDataFrame([(0, "p0", 100), (1, "p1", 101)], rows.schema)
    real, moves = storage._move, []

    def dying(fs, source, target):
        if "staged" in str(source):
            moves.append(source)
            if len(moves) == 1:
                raise OSError("died after the old partition was deleted")
        real(fs, source, target)

    monkeypatch.setattr(storage, "_move", dying)
    with pytest.raises(OSError):
        merge_by_key(path, change, "id", "part")
    monkeypatch.setattr(storage, "_move", real)
    merge_by_key(path, change, "id", "part")
    stored = {r["id"]: r["v"] for r in spark.read.schema(rows.schema).parquet(path).collect()}
    assert stored == {0: 100, 1: 101, 2: 2, 3: 3, 4: 4, 5: 5}


def test_a_swap_that_dies_half_way_leaves_the_old_table(spark, tmp_path):
    from priceloom import storage

    path = str(tmp_path / "t")
    storage.replace_table(spark.range(3), path)
    (tmp_path / "t").rename(tmp_path / "t.previous")
    assert storage.exists(spark, path) and spark.read.parquet(storage.current_path(spark, path)).count() == 3
    assert not (tmp_path / "t").exists()  # looking changed nothing
    storage.recover(spark, path)
    assert spark.read.parquet(path).count() == 3 and not (tmp_path / "t.previous").exists()
