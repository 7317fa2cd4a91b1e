import datetime as dt
import shutil
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from priceloom.plans import dimensions, marts, progress, questions
from priceloom.plans.build import BuildConfig, build, source_freshness, table_path
from priceloom.plans.fact import committed_watermark, fact_rows, read_fact, update_fact
from priceloom.plans.silver import FoldLedger, fold_new_slots, keyed_events, read_silver, silver_events
from priceloom.quality import QualityGateError
from priceloom.sources import reference
from priceloom.sources.slots import existing_slots, ingest, read_bronze
from priceloom.streaming import build_stream
from tests.conftest import SAMPLE_FEED, feed, land, station, zipped

AS_OF = dt.datetime(2026, 6, 4)
GAZOLE = ("1", "Gazole")


def price(maj, value, fuel=GAZOLE):
    return (*fuel, f"2026-06-{maj}", value)


def slot(tmp_path, dt_, hh, *stations):
    land(tmp_path / "raw", dt_, hh, zipped(feed(*stations)))


def config(tmp_path):
    return BuildConfig(str(tmp_path / "bronze"), str(tmp_path / "wh"), as_of=AS_OF)


def load(spark, tmp_path):
    ingest(spark, str(tmp_path / "raw"), str(tmp_path / "bronze"), F.lit("u"))


def move_on(spark, tmp_path):
    """Silver and the fact brought up to date, without the other tables and their checks."""
    load(spark, tmp_path)
    cfg = config(tmp_path)
    silver_path, path = (table_path(cfg.warehouse, n) for n in ("stg_prix", "fct_prix_carburant"))
    fold_new_slots(spark, cfg.bronze_root, silver_path)
    days = FoldLedger(spark, silver_path).days_after(committed_watermark(spark, path))
    update_fact(spark, read_silver(spark, silver_path), path, days=days)


def fact(spark, tmp_path):
    return read_fact(spark, table_path(config(tmp_path).warehouse, "fct_prix_carburant"))


def same(left, right):
    return left.count() == right.count() and left.exceptAll(right.select(left.columns)).isEmpty()


def whole_silver(spark, tmp_path):
    return silver_events(read_bronze(spark, str(tmp_path / "bronze")))


def test_full_build_of_the_sample(spark, tmp_path):
    land(tmp_path / "raw", "2026-06-03", "10", zipped(SAMPLE_FEED.encode("latin-1")))
    load(spark, tmp_path)
    report = build(spark, config(tmp_path)).collect()
    assert {r["status"] for r in report} == {"pass"}
    # 80 declared checks, future updates, prices that fit gold, the format of update times, three on stations
    assert len(report) == 80 + 6
    rows = {r["prix_euro"]: r for r in fact(spark, tmp_path).collect()}
    assert set(rows) == {Decimal(p) for p in ("1.549", "0.819", "0.990", "1.759", "1.640")}
    late = rows[Decimal("0.990")]  # ten to midnight in Paris
    assert (late["maj_timestamp_utc"], late["date_sk"]) == (dt.datetime(2026, 4, 30, 21, 50), 20260430)
    assert (late["ingestion_ts"], late["ingestion_date"]) == (dt.datetime(2026, 6, 3, 10), dt.date(2026, 6, 3))
    gold = lambda name: spark.read.parquet(table_path(config(tmp_path).warehouse, name))
    latest = gold("agg_dernier_prix_station_carburant")
    assert {(r["station_id"], r["region_nom"]) for r in latest.collect()} == {
        ("42", "Occitanie"), ("7", "Corse"), ("1001", None), ("560", "Bretagne")
    }
    ranking = gold("agg_classement_stations")
    assert ranking.count() == 4
    assert sorted(r["geo"] for r in questions.station_map(latest).select("geo").collect()) == ["43.65, 3.55", "47.875, -3.917"]
    assert questions.cheapest_regions(gold("agg_prix_region_carburant")).count() == 2
    assert questions.dispersion(gold("agg_prix_region_carburant"), None).filter("etendue = 0").count() == 4
    assert questions.top_stations(ranking).count() == questions.flop_stations(ranking).count() == 4
    assert questions.top_latest(latest).count() == 4
    assert questions.headline(latest, None).first()["entity_count"] == 4


@pytest.mark.parametrize(("hours", "status"), [(1, "pass"), (2, "warn"), (7, "error")])
def test_source_freshness(spark, tmp_path, hours, status):
    for hh in ("09", "10"):
        slot(tmp_path, "2026-06-03", hh, station("1", price("03 09:00:00", "1.7")))
    load(spark, tmp_path)
    cfg = replace(config(tmp_path), as_of=dt.datetime(2026, 6, 3, 10 + hours))
    assert source_freshness(spark, cfg).first()["status"] == status


def test_unchanged_prices_are_not_restacked(spark, tmp_path):
    same_price = station("1", price("03 09:00:00", "1.7"))
    for hh in ("10", "11", "12"):
        slot(tmp_path, "2026-06-03", hh, same_price)
    slot(tmp_path, "2026-06-03", "13", station("1", price("03 12:30:00", "1.6")))
    load(spark, tmp_path)
    silver = whole_silver(spark, tmp_path).orderBy("maj_timestamp_utc").collect()
    assert [(float(r["prix_euro"]), r["ingestion_ts"].hour) for r in silver] == [(1.7, 10), (1.6, 13)]


def test_incremental_equals_full_and_reruns_change_nothing(spark, tmp_path):
    cfg = config(tmp_path)
    slots = [
        ("02", "23", [station("1", price("02 22:00:00", "1.7")), station("2", price("02 23:30:00", "1.8"), cp="20100", ville="Sartène")]),
        ("03", "00", [station("1", price("02 22:00:00", "1.7")), station("2", price("03 00:30:00", "1.9"), cp="20100", ville="Sartène")]),
        ("03", "01", [station("1", price("03 01:30:00", "1.5"), cp="34000", ville="Montpellier"), station("3", price("03 01:00:00", "1.4"), cp="97400", ville="Saint-Denis")]),
    ]
    for d, hh, stations in slots:
        slot(tmp_path, f"2026-06-{d}", hh, *stations)
        load(spark, tmp_path)
        build(spark, cfg)
    build(spark, cfg)
    silver = whole_silver(spark, tmp_path)
    full = fact_rows(keyed_events(silver))
    assert full.count() == 5
    assert same(fact(spark, tmp_path), full)
    assert same(read_silver(spark, table_path(cfg.warehouse, "stg_prix")).drop("maj_date"), silver)
    gold = lambda name: spark.read.parquet(table_path(cfg.warehouse, name))
    parents = [
        dimensions.dim_station(silver), dimensions.dim_carburant(reference.fuels(spark)),
        dimensions.dim_localisation(silver, reference.departments(spark)),
    ]
    assert same(gold("dim_station"), parents[0]) and same(gold("dim_localisation"), parents[2])
    latest = marts.latest_prices(full, *parents)
    assert same(gold("agg_dernier_prix_station_carburant"), latest)
    assert same(gold("agg_prix_region_carburant"), marts.region_stats(latest))
    assert same(gold("agg_classement_stations"), marts.station_ranking(latest, marts.region_stats(latest)))
    station_one = spark.read.parquet(table_path(cfg.warehouse, "dim_station")).filter("station_id = '1'").first()
    assert (station_one["cp"], station_one["ville"]) == ("34000", "Montpellier")  # latest attributes win
    days = {r["maj_timestamp_utc"]: r["date_sk"] for r in fact(spark, tmp_path).collect()}
    assert days[dt.datetime(2026, 6, 2, 22, 30)] == 20260603  # 00:30 in Paris


def test_late_slot_updates_silver_but_not_the_fact(spark, tmp_path):
    cfg = config(tmp_path)
    known = station("1", price("03 08:00:00", "1.7"))
    slot(tmp_path, "2026-06-03", "10", known)
    move_on(spark, tmp_path)
    late_only = station("9", price("03 07:00:00", "1.2"))
    slot(tmp_path, "2026-06-03", "09", known, late_only)
    move_on(spark, tmp_path)
    silver = {r["station_id"]: r["ingestion_ts"].hour for r in read_silver(spark, table_path(cfg.warehouse, "stg_prix")).collect()}
    assert silver == {"1": 9, "9": 9}
    assert [r["ingestion_ts"].hour for r in fact(spark, tmp_path).collect()] == [10]
    # Seen again above the watermark: silver keeps the late sighting, so the fact still leaves it out.
    slot(tmp_path, "2026-06-03", "11", known, late_only)
    move_on(spark, tmp_path)
    assert fact(spark, tmp_path).count() == 1


def test_reductions_move_on_and_notice_late_slots(spark, tmp_path):
    cfg = config(tmp_path)
    silver_path, path = table_path(cfg.warehouse, "stg_prix"), str(tmp_path / "stations")
    folds = FoldLedger(spark, silver_path)
    slots = [
        ("10", station("1", price("03 08:00:00", "1.7"), ville="A")),
        ("12", station("1", price("03 10:30:00", "1.6"), ville="B")),
        ("11", station("2", price("03 09:00:00", "1.5"), ville="C")),  # late
        ("13", station("2", price("03 12:00:00", "1.4"), ville="D")),
    ]
    for hh, content in slots:
        slot(tmp_path, "2026-06-03", hh, content)
        load(spark, tmp_path)
        fold_new_slots(spark, cfg.bronze_root, silver_path)
        state = progress.latest_attributes(spark, path, read_silver(spark, silver_path), folds)
        whole = dimensions.dim_station(whole_silver(spark, tmp_path))
        assert same(dimensions.dim_station(state), whole)
    before = sorted(p.name for p in (tmp_path / "stations").iterdir())
    progress.latest_attributes(spark, path, read_silver(spark, silver_path), folds)
    assert sorted(p.name for p in (tmp_path / "stations").iterdir()) == before


def test_a_crashed_fact_update_is_finished_by_the_next(spark, tmp_path):
    cfg = config(tmp_path)
    silver_path, path = (table_path(cfg.warehouse, n) for n in ("stg_prix", "fct_prix_carburant"))
    slot(tmp_path, "2026-06-02", "23", station("1", price("02 20:00:00", "1.7")))
    load(spark, tmp_path)
    fold_new_slots(spark, cfg.bronze_root, silver_path)
    update_fact(spark, read_silver(spark, silver_path), path)
    slot(tmp_path, "2026-06-03", "10", station("1", price("03 08:00:00", "1.6")))
    slot(tmp_path, "2026-06-04", "10", station("1", price("04 08:00:00", "1.5")))
    load(spark, tmp_path)
    fold_new_slots(spark, cfg.bronze_root, silver_path)
    silver = read_silver(spark, silver_path)
    full = fact_rows(keyed_events(silver))
    # Only the newest day reached the table before the run died; the ledger was not written.
    full.filter("ingestion_date = '2026-06-04'").write.mode("append").partitionBy("ingestion_date").parquet(path)
    assert committed_watermark(spark, path) == dt.datetime(2026, 6, 2, 23)
    update_fact(spark, silver, path)
    assert same(read_fact(spark, path), full)
    assert committed_watermark(spark, path) == dt.datetime(2026, 6, 4, 10)


def test_a_crashed_fold_is_repeated_without_harm(spark, tmp_path):
    cfg = config(tmp_path)
    silver_path = table_path(cfg.warehouse, "stg_prix")
    slot(tmp_path, "2026-06-03", "10", station("1", price("03 08:00:00", "1.6")))
    load(spark, tmp_path)
    fold_new_slots(spark, cfg.bronze_root, silver_path)
    shutil.move(silver_path + ".ledger", str(tmp_path / "lost"))
    again = fold_new_slots(spark, cfg.bronze_root, silver_path)
    assert (again.inserted, again.updated, again.partitions) == (0, 0, (dt.date(2026, 6, 3),))
    ledger = FoldLedger(spark, silver_path)
    assert ledger.slots() == {("2026-06-03", "10")}
    assert ledger.days_after(dt.datetime(2026, 6, 3, 9)) == ["2026-06-03"]  # the fact still learns where to look
    assert ledger.days_after(dt.datetime(2026, 6, 3, 11)) == []


def test_a_fold_looks_up_only_changed_days(spark, tmp_path):
    cfg = config(tmp_path)
    silver_path = table_path(cfg.warehouse, "stg_prix")
    dormant = station("1", ("1", "Gazole", "2024-05-24 10:00:00", "1.6"))
    for hh, minute in (("10", "30"), ("11", "45"), ("12", "50")):
        slot(tmp_path, "2026-06-03", hh, dormant, station("2", price(f"03 08:{minute}:00", "1.7")))
        load(spark, tmp_path)
        result = fold_new_slots(spark, cfg.bronze_root, silver_path)
    assert (result.inserted, result.partitions) == (1, (dt.date(2026, 6, 3),))
    assert same(read_silver(spark, silver_path).drop("maj_date"), whole_silver(spark, tmp_path))


def test_deleted_tables_are_built_again(spark, tmp_path):
    cfg = config(tmp_path)
    for d in ("01", "02"):
        slot(tmp_path, f"2026-06-{d}", "10", station("1", price(f"{d} 08:00:00", "1.7")))
        move_on(spark, tmp_path)
    full = fact_rows(keyed_events(whole_silver(spark, tmp_path)))
    for n, name in enumerate(("fct_prix_carburant", "stg_prix")):
        shutil.move(table_path(cfg.warehouse, name), str(tmp_path / f"gone{n}"))
        move_on(spark, tmp_path)
        assert same(fact(spark, tmp_path), full)
        assert same(read_silver(spark, table_path(cfg.warehouse, "stg_prix")).drop("maj_date"), whole_silver(spark, tmp_path))
    shutil.move(str(tmp_path / "bronze" / "dt=2026-06-02"), str(tmp_path / "gone2"))
    assert existing_slots(spark, cfg.bronze_root) == [("2026-06-01", "10")]
    load(spark, tmp_path)
    assert read_bronze(spark, cfg.bronze_root).count() == 2


def test_full_refresh_takes_late_rows_in(spark, tmp_path):
    cfg = config(tmp_path)
    slot(tmp_path, "2026-06-03", "10", station("1", price("03 08:00:00", "1.7")))
    load(spark, tmp_path)
    build(spark, cfg)
    slot(tmp_path, "2026-06-03", "09", station("9", price("03 07:00:00", "1.2")))
    load(spark, tmp_path)
    build(spark, cfg)
    assert fact(spark, tmp_path).count() == 1
    build(spark, replace(cfg, full_refresh=True))
    assert same(fact(spark, tmp_path), fact_rows(keyed_events(whole_silver(spark, tmp_path))))
    latest = spark.read.parquet(table_path(cfg.warehouse, "agg_dernier_prix_station_carburant"))
    assert {r["station_id"] for r in latest.collect()} == {"1", "9"}
    slot(tmp_path, "2026-06-03", "11", station("1", price("03 10:30:00", "1.8")))
    load(spark, tmp_path)
    build(spark, cfg)
    assert fact(spark, tmp_path).count() == 3


def test_an_error_skips_what_depends_on_it(spark, tmp_path):
    slot(tmp_path, "2026-06-03", "10", station("1", price("03 08:00:00", "1.6"), cp="98800", ville="Nouméa"))
    load(spark, tmp_path)
    report = build(spark, config(tmp_path), strict=False)
    status = {(r["node"], r["check"]): r["status"] for r in report.collect()}
    assert status["dim_localisation", "relationships"] == "error"  # 988 has no department
    assert status["dim_date", "unique"] == "pass"
    for node in ("dim_station", "int_prix_keyed", "fct_prix_carburant", "agg_classement_stations"):
        assert status[node, ""] == "skipped"


def test_a_strange_price_only_warns(spark, tmp_path):
    """Also with reference data from CSV files."""
    (tmp_path / "fuels.csv").write_text("carburant_id,carburant_nom,carburant_libelle_long\n1,Gazole,Diesel\n")
    (tmp_path / "departments.csv").write_text("dept_code,dept_nom,region_nom\n34,Hérault,Occitanie\n")
    given = {"fuels_csv": str(tmp_path / "fuels.csv"), "departments_csv": str(tmp_path / "departments.csv")}
    slot(tmp_path, "2026-06-03", "10", station("1", price("03 08:00:00", "0.4")), station("2", price("03 08:00:00", "1.4")))
    load(spark, tmp_path)
    report = build(spark, replace(config(tmp_path), **given))
    assert {r["node"] for r in report.filter("status = 'warn'").collect()} == {
        "stg_prix", "fct_prix_carburant", "agg_dernier_prix_station_carburant"
    }
    assert fact(spark, tmp_path).count() == 2


def test_checking_changed_days_only(spark, tmp_path):
    cfg = replace(config(tmp_path), check_changed=True)
    slot(tmp_path, "2026-06-01", "10", station("1", price("01 08:00:00", "0.4")))
    load(spark, tmp_path)
    build(spark, cfg)
    slot(tmp_path, "2026-06-03", "10", station("1", price("03 08:00:00", "0.3")))
    load(spark, tmp_path)
    build(spark, cfg)
    slot(tmp_path, "2026-06-03", "11", station("1", price("03 10:00:00", "1.3")))
    load(spark, tmp_path)
    report = build(spark, cfg)
    slot(tmp_path, "2026-06-02", "10", station("1", price("02 08:00:00", "0.2")))  # late
    load(spark, tmp_path)
    late = {r["node"]: r["failures"] for r in build(spark, cfg).filter("check like 'expression%between%'").collect()}
    assert (late["stg_prix"], late["fct_prix_carburant"]) == (2, 1)
    # The strange price of the first of June lies outside what could change; that of the third is on a checked day.
    counted = {r["node"]: r["failures"] for r in report.filter("check like 'expression%between%'").collect()}
    assert (counted["stg_prix"], counted["fct_prix_carburant"], counted["agg_dernier_prix_station_carburant"]) == (1, 1, 0)


def test_an_update_from_the_future_is_an_error(spark, tmp_path):
    slot(tmp_path, "2026-06-03", "10", station("1", price("09 08:00:00", "1.4")))
    load(spark, tmp_path)
    with pytest.raises(QualityGateError, match="not_in_future"):
        build(spark, config(tmp_path))


def test_latest_price_follows_the_update_time(spark, tmp_path):
    slot(tmp_path, "2026-06-03", "10", station("1", price("03 09:00:00", "1.6")))
    slot(tmp_path, "2026-06-03", "11", station("1", price("03 08:00:00", "1.9")))
    load(spark, tmp_path)
    silver = whole_silver(spark, tmp_path)
    latest = marts.latest_prices(
        fact_rows(keyed_events(silver)), dimensions.dim_station(silver), dimensions.dim_carburant(reference.fuels(spark)),
        dimensions.dim_localisation(silver, reference.departments(spark)),
    )
    assert [float(r["prix_euro"]) for r in latest.collect()] == [1.6]


def test_change_frequency_and_inactivity(spark, tmp_path):
    slot(tmp_path, "2026-06-03", "10", station("1", price("01 09:00:00", "1.6")), station("2", price("03 09:00:00", "1.6")))
    slot(tmp_path, "2026-06-03", "11", station("1", price("01 12:00:00", "1.7")))
    load(spark, tmp_path)
    f = fact_rows(keyed_events(whole_silver(spark, tmp_path)))
    assert sorted((r["changes"], r["days"]) for r in questions.change_frequency(f).collect()) == [(1, 1), (2, 1)]
    flags = questions.inactive_stations(f, AS_OF, 2).collect()
    assert sorted(r["est_active"] for r in flags) == [False, True]


@pytest.mark.parametrize(("late", "expected"), [("drop", {10, 12}), ("merge", {9, 12})])
def test_stream(spark, tmp_path, late, expected):
    silver_path, path, checkpoint = (str(tmp_path / n) for n in ("s", "f", "c"))

    def run():
        build_stream(spark, str(tmp_path / "bronze"), silver_path, path, checkpoint, late, 1).awaitTermination()

    known = station("1", price("03 08:00:00", "1.7"))
    slot(tmp_path, "2026-06-03", "10", known)
    slot(tmp_path, "2026-06-03", "11", known)
    load(spark, tmp_path)
    run()
    slot(tmp_path, "2026-06-03", "09", known, station("9", price("03 07:00:00", "1.2")))
    load(spark, tmp_path)
    run()
    slot(tmp_path, "2026-06-03", "12", station("1", price("03 11:30:00", "1.5")))
    load(spark, tmp_path)
    run()
    run()
    rows = read_fact(spark, path).collect()
    assert {r["ingestion_ts"].hour for r in rows} == expected
    assert len(rows) == (2 if late == "drop" else 3)
    if late == "drop":
        assert same(read_silver(spark, silver_path).drop("maj_date"), whole_silver(spark, tmp_path))


def test_marts_match_a_plain_recomputation(spark):
    rows = [("A", "Gazole", Decimal(p)) for p in ("1.5", "1.5", "1.6")] + [(None, "Gazole", Decimal("1.0"))]
    df = spark.createDataFrame(rows, "region_nom string, carburant_nom string, prix_euro decimal(10,3)")
    for c in ("station_sk", "station_id", "carburant_id", "dept_nom", "dept_code", "ville", "cp"):
        df = df.withColumn(c, F.lit("x"))
    df = df.withColumn("latitude", F.lit(1.0)).withColumn("longitude", F.lit(1.0)).withColumn("maj_timestamp_utc", F.lit(None).cast("timestamp_ntz"))
    ranking = marts.station_ranking(df, marts.region_stats(df)).orderBy("prix_euro").collect()
    assert [(r["rang_moins_cher_region"], r["rang_plus_cher_region"]) for r in ranking] == [(1, 2), (1, 2), (3, 1)]
    assert float(ranking[2]["ecart_prix_vs_moyenne_region"]) == pytest.approx(0.066666667)


@pytest.mark.parametrize("check_changed", [True, False])
def test_a_shut_gate_stays_shut(spark, tmp_path, check_changed):
    cfg = replace(config(tmp_path), check_changed=check_changed)
    future = ["03 10:00:00", "09 08:00:00"]
    slot(tmp_path, "2026-06-03", "10", *[station(str(i), price(maj, "1.4")) for i, maj in enumerate(future)])
    for hh in ("11", "12", "13"):
        load(spark, tmp_path)
        with pytest.raises(QualityGateError, match="fct_prix_carburant not_in_future"):
            build(spark, cfg)
        slot(tmp_path, "2026-06-03", hh, station("1", price(f"03 {hh}:00:00", "1.5")))
    assert not (tmp_path / "wh" / "gold" / "agg_classement_stations").exists()
    load(spark, tmp_path)
    later = replace(cfg, as_of=dt.datetime(2026, 6, 10))
    assert build(spark, later).filter("status like 'error%'").isEmpty()


def test_an_absurd_price_is_counted_and_left_out_of_gold(spark, tmp_path):
    slot(tmp_path, "2026-06-03", "10", station("1", price("03 08:00:00", "1e8")), station("2", price("03 08:00:00", "1.4")),
         station("3", price("03 08:00:00", "1e400")))
    load(spark, tmp_path)
    report = {(r["node"], r["check"]): (r["status"], r["failures"]) for r in build(spark, config(tmp_path)).collect()}
    assert report["stg_prix", "fits_gold"] == ("warn", 1)
    assert whole_silver(spark, tmp_path).count() == 2  # what is beyond any number was a parse error
    assert [float(r["prix_euro"]) for r in fact(spark, tmp_path).collect()] == [1.4]


def test_a_slot_in_many_files_streamed_file_by_file(spark, tmp_path):
    silver_path, path, checkpoint = (str(tmp_path / n) for n in ("s", "f", "c"))
    for hh in ("10", "11", "12"):
        slot(tmp_path, "2026-06-03", hh, *[station(str(i), price(f"03 {hh}:00:00", "1.5")) for i in range(6)])
    load(spark, tmp_path)
    rows = read_bronze(spark, str(tmp_path / "bronze")).repartition(4)  # several files a slot, in any order
    shutil.move(str(tmp_path / "bronze"), str(tmp_path / "whole"))
    whole = read_bronze(spark, str(tmp_path / "whole"))
    whole.repartition(4).write.partitionBy("dt", "hh").parquet(str(tmp_path / "bronze"))
    del rows
    build_stream(spark, str(tmp_path / "bronze"), silver_path, path, checkpoint, "drop", 1).awaitTermination()
    assert read_fact(spark, path).count() == 18
    assert same(read_silver(spark, silver_path).drop("maj_date"), whole_silver(spark, tmp_path))


def test_full_refresh_equals_the_increments(spark, tmp_path):
    cfg = config(tmp_path)
    for hh, value in (("10", "1.5"), ("11", "1.6")):
        slot(tmp_path, "2026-06-03", hh, station("1", price(f"03 {hh}:00:00", value)))
        load(spark, tmp_path)
        build(spark, cfg)
    before = fact(spark, tmp_path).collect()
    build(spark, replace(cfg, full_refresh=True))
    assert sorted(map(tuple, fact(spark, tmp_path).collect())) == sorted(map(tuple, before))
