"""Feeds of changes, what follows them, and what a crash or a reader in between does to them."""

import datetime as dt
import random
import re
from collections import Counter
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from priceloom import storage
from priceloom.operators import merge
from priceloom.operators.merge import merge_by_key, net_changes, read_feed, read_table
from priceloom.plans import dimensions, fact as fact_plan, histogram, marts, progress
from priceloom.plans.build import BuildConfig, build, table_path
from priceloom.plans.fact import FactLog, committed_watermark, fact_rows, follow_silver, read_fact
from priceloom.plans.silver import FoldLedger, fold_new_slots, keyed_events, read_silver, silver_events, withdraw_events
from priceloom.sources import reference
from priceloom.sources.slots import ingest, read_bronze
from tests.conftest import feed, land, station, zipped

ROWS = "id long, part string, v long"
GAZOLE, E10 = ("1", "Gazole"), ("5", "E10")


def rows(spark, *values):
    return spark.createDataFrame(list(values), ROWS)


def stored(spark, path):
    return sorted(map(tuple, read_table(spark, path, rows(spark).schema).select("id", "part", "v").collect()))


def changes(spark, folder):
    found = read_feed(spark, folder, rows(spark).schema, "id", "part").collect()
    return sorted((r["id"], r["action"], r["old"] and tuple(r["old"]), r["new"] and tuple(r["new"])) for r in found)


# --- tables ------------------------------------------------------------------------------------------


def test_a_reader_between_write_and_switch_destroys_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    merge_by_key(path, rows(spark, *[(k, f"p{k % 2}", k) for k in range(6)]), "id", "part")
    real = merge.switch_partitions

    def looked_at(spark, path, run, touched):
        assert storage.exists(spark, path) and storage.current_path(spark, path) == path
        assert read_table(spark, path, rows(spark).schema).count() == 6
        committed_watermark(spark, path + "-other")
        FoldLedger(spark, path).slots()
        storage.Ledger(spark, path, "a string").exists()
        real(spark, path, run, touched)

    monkeypatch.setattr(merge, "switch_partitions", looked_at)
    result = merge_by_key(path, rows(spark, *[(k, f"p{k % 2}", 100 + k) for k in range(4)]), "id", "part")
    assert result.updated == 4
    assert stored(spark, path) == sorted([(k, f"p{k % 2}", 100 + k if k < 4 else k) for k in range(6)])


def test_a_staged_table_that_somebody_removed_is_not_switched_silently(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    merge_by_key(path, rows(spark, (1, "a", 1)), "id", "part")
    real = merge.switch_partitions

    def robbed(spark, path, run, touched):
        storage.recover(spark, path)  # a second writer
        real(spark, path, run, ())

    monkeypatch.setattr(merge, "switch_partitions", robbed)
    with pytest.raises(OSError, match="somebody else"):
        merge_by_key(path, rows(spark, (1, "a", 2)), "id", "part")
    assert stored(spark, path) == [(1, "a", 1)]


def test_a_partition_that_loses_its_only_row_becomes_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_by_key(path, rows(spark, (1, "a", 1), (2, "b", 2), (3, "c=/ d", 3)), "id", "part")
    gone = spark.createDataFrame([(3,)], "id long")
    result = merge_by_key(path, rows(spark, (1, "b", 10)), "id", "part", removed=gone, feed=str(tmp_path / "f"))
    assert (result.inserted, result.updated, result.removed) == (0, 1, 1)
    assert stored(spark, path) == [(1, "b", 10), (2, "b", 2)]
    assert changes(spark, str(tmp_path / "f")) == [
        (1, "update", (1, "a", 1), (1, "b", 10)), (3, "delete", (3, "c=/ d", 3), None)
    ]


@pytest.mark.parametrize("die_at", ["feed", "first move", "append"])
def test_an_interrupted_merge_is_finished_from_its_feed(spark, tmp_path, monkeypatch, die_at):
    path, folder = str(tmp_path / "t"), str(tmp_path / "f")
    merge_by_key(path, rows(spark, *[(k, f"p{k % 3}", k) for k in range(9)]), "id", "part")
    offered = rows(spark, (0, "p1", 100), (1, "p1", 101), (20, "p9", 20))
    gone = spark.createDataFrame([(5,)], "id long")

    def dies(*_, **__):
        raise OSError("died")

    with monkeypatch.context() as patch:
        if die_at == "feed":
            patch.setattr(merge, "_rewrite", dies)
        elif die_at == "first move":
            patch.setattr(storage, "_move", dies)
        else:
            real = merge.write_partitioned
            patch.setattr(merge, "write_partitioned", lambda df, p, b, mode="overwrite", *a, **k: dies() if mode == "append" else real(df, p, b, mode, *a, **k))
        with pytest.raises(OSError):
            merge_by_key(path, offered, "id", "part", removed=gone, feed=folder)
    # What is offered the second time does not matter: the feed is complete.
    result = merge_by_key(path, rows(spark, (7, "p0", 0)), "id", "part", feed=folder)
    assert (result.inserted, result.updated, result.removed) == (1, 2, 1)
    want = {k: (k, f"p{k % 3}", k) for k in range(9) if k != 5} | {0: (0, "p1", 100), 1: (1, "p1", 101), 20: (20, "p9", 20)}
    assert stored(spark, path) == sorted(want.values())


def test_net_changes_over_several_feeds(spark, tmp_path):
    path, key = str(tmp_path / "t"), ("id", "part")
    merge_by_key(path, rows(spark, (1, "a", 1), (2, "a", 2)), *key)
    steps = [((1, "a", 5), None), ((3, "b", 3), None), ((1, "b", 6), [3]), ((2, "a", 7), None), ((2, "a", 2), None)]
    for n, (row, gone) in enumerate(steps):
        removed = spark.createDataFrame([(g,) for g in gone], "id long") if gone else None
        merge_by_key(path, rows(spark, row), *key, removed=removed, feed=str(tmp_path / f"f{n}"))
    feeds = [read_feed(spark, str(tmp_path / f"f{n}"), rows(spark).schema, *key) for n in range(len(steps))]
    net = [(r["id"], tuple(r["old"]), tuple(r["new"])) for r in net_changes(feeds, "id").collect()]
    assert net == [(1, (1, "a", 1), (1, "b", 6))]  # 3 came and went, 2 is what it was


def test_files_of_a_busy_day_hold_disjoint_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merge, "ROWS_PER_FILE", 100)
    path = str(tmp_path / "t")
    keyed = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, "quiet").otherwise("busy").alias("part"), (F.col("id") * 7919 % 997).alias("v"))
    merge_by_key(path, keyed, "id", "part", sort_by=("v",))
    for _ in range(2):  # as written first, and rewritten by a merge
        files = sorted((tmp_path / "t" / "part=busy").glob("*.parquet"))
        assert len(files) >= 5
        ends = sorted((s.min, s.max) for f in files for s in [pq.read_metadata(f).row_group(0).column(1).statistics])
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
        merge_by_key(path, keyed.filter("id % 50 = 7").withColumn("v", F.col("v") + 0), "id", "part", sort_by=("v",))


# --- silver, fact, reductions ------------------------------------------------------------------------


class Lake:
    """Bronze, silver, the fact and what follows it, from hand-made snapshots."""

    def __init__(self, spark, tmp_path):
        self.spark, self.root = spark, tmp_path
        self.bronze, self.silver, self.fact = (str(tmp_path / n) for n in ("bronze", "silver", "fact"))

    def slot(self, day, hour, *stations):
        land(self.root / "raw", f"2026-06-{day}", hour, zipped(feed(*stations)))

    def move_on(self, late="merge"):
        ingest(self.spark, str(self.root / "raw"), self.bronze, F.lit("u"))
        fold_new_slots(self.spark, self.bronze, self.silver)
        return follow_silver(self.spark, self.silver, self.fact, late=late)

    def events(self):
        return read_silver(self.spark, self.silver)

    def facts(self):
        return sorted(map(tuple, read_fact(self.spark, self.fact).collect()))

    def want(self):
        return sorted(map(tuple, fact_rows(keyed_events(self.events())).collect()))

    def dims(self):
        places = dimensions.dim_localisation(self.events(), reference.departments(self.spark))
        return places, dimensions.dim_carburant(reference.fuels(self.spark))

    def counts(self):
        found = histogram.advance_latest(
            self.spark, str(self.root / "latest"), str(self.root / "counts"), read_fact(self.spark, self.fact),
            FactLog(self.spark, self.fact), *self.dims(),
        )
        return found


@pytest.fixture()
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def price(day, hour, value, fuel=GAZOLE):
    return (*fuel, f"2026-06-{day} {hour}:00:00", value)


def test_the_fact_opens_only_the_dates_the_feed_names(lake, monkeypatch):
    opened = []
    real = fact_plan.merge_by_key
    monkeypatch.setattr(fact_plan, "merge_by_key", lambda *a, **k: opened.append(str(k.get("target_filter"))) or real(*a, **k))
    known = station("1", price("01", "08", "1.7"))
    lake.slot("01", "10", known)
    lake.slot("03", "10", known, station("2", price("03", "08", "1.6")))
    lake.move_on()
    lake.slot("04", "10", known, station("2", price("04", "08", "1.5")))
    lake.move_on()
    assert opened[-1] == "Column<'false'>"  # fresh events lie nowhere yet: no key is read
    lake.slot("02", "10", station("2", price("03", "08", "1.6")))  # late: seen a day earlier
    result = lake.move_on()
    assert "2026-06-03" in opened[-1] and "2026-06-01" not in opened[-1] and "2026-06-04" not in opened[-1]
    assert (result.inserted, result.updated) == (0, 1)
    assert lake.facts() == lake.want()
    assert lake.move_on().partitions == ()


def test_late_events_dropped_before_are_found_when_let_in_later(lake):
    lake.slot("03", "10", station("1", price("01", "08", "1.7")))
    lake.move_on("drop")
    lake.slot("02", "10", station("1", price("01", "08", "1.7")))  # dropped: the fact keeps the third of June
    lake.move_on("drop")
    assert [r[7] for r in lake.facts()] == [dt.datetime(2026, 6, 3, 10)]
    lake.slot("01", "10", station("1", price("01", "08", "1.7")))
    lake.move_on("merge")
    assert [r[7] for r in lake.facts()] == [dt.datetime(2026, 6, 1, 10)]


def test_a_correction_beyond_gold_takes_the_price_out(lake):
    lake.slot("03", "10", station("1", price("01", "08", "1.7")), station("2", price("01", "08", "1.4")))
    lake.move_on()
    lake.slot("02", "10", station("1", price("01", "08", "1e9")))  # the first sighting had another price
    lake.move_on()
    assert lake.facts() == lake.want() and len(lake.facts()) == 1


@pytest.mark.parametrize("table", ["silver", "fact"])
def test_a_crash_half_way_through_a_table_is_mended_by_the_next_run(lake, monkeypatch, table):
    lake.slot("01", "10", station("1", price("01", "08", "1.7")), station("2", price("01", "09", "1.7")))
    lake.move_on()
    lake.slot("01", "09", station("1", price("01", "08", "1.7")), station("3", price("01", "08", "1.2")))
    real = storage._move

    def dies(fs, source, target):
        if f"/{table}.staged-" in str(source):
            raise OSError("died")
        real(fs, source, target)

    with monkeypatch.context() as patch:
        patch.setattr(storage, "_move", dies)
        with pytest.raises(OSError):
            lake.move_on()
    lake.slot("02", "10", station("1", price("02", "08", "1.5")))  # more has come in the meantime
    lake.move_on()
    whole = silver_events(read_bronze(lake.spark, lake.bronze))
    assert sorted(map(tuple, lake.events().drop("maj_date").collect())) == sorted(map(tuple, whole.collect()))
    assert lake.facts() == lake.want()
    lake.slot("03", "10", station("1", price("03", "08", "1.4")))
    lake.move_on()
    assert lake.facts() == lake.want()


def test_reductions_follow_withdrawals_and_corrections(lake, spark):
    silver_log = lambda: FoldLedger(spark, lake.silver)
    plain = lambda df: sorted(map(str, map(tuple, df.collect())))

    def check():
        attributes = progress.latest_attributes(spark, str(lake.root / "a"), lake.events(), silver_log())
        places = progress.seen_places(spark, str(lake.root / "p"), lake.events(), silver_log())
        assert plain(dimensions.dim_station(attributes)) == plain(dimensions.dim_station(lake.events()))
        assert plain(places) == plain(lake.events().select("cp", "ville").distinct())
        whole = fact_rows(keyed_events(lake.events())).select(*progress.PRICES)
        newest = progress.pick_one(whole, progress.PAIR, [F.col("maj_timestamp_utc").desc()])
        latest, counts = lake.counts()
        assert plain(latest.select(*progress.PRICES)) == plain(newest)
        assert plain(counts) == plain(histogram.price_counts(histogram.named_prices(newest, *lake.dims())).select(*counts.columns))

    lake.slot("01", "10", station("1", price("01", "08", "1.7"), ville="A"), station("2", price("01", "08", "1.6"), cp="29900", ville="B"))
    lake.move_on()
    check()
    lake.slot("02", "10", station("1", price("02", "08", "1.5"), ville="C"), station("2", price("02", "08", "1.5", E10), cp="29900", ville="B"))
    lake.move_on()
    check()
    lake.slot("01", "09", station("2", price("02", "08", "1.4", E10), cp="20137", ville="D"), station("9", price("01", "07", "1.1"), ville="E"))  # late
    lake.move_on()
    check()
    newest = lake.events().filter("station_id = '1' AND maj_date = '2026-06-02'")
    assert withdraw_events(spark, lake.silver, newest.select("prix_sk")).removed == 1
    lake.move_on()
    check()  # town C is gone, station 1 is back at its first price
    withdraw_events(spark, lake.silver, lake.events().filter("station_id = '9'").select("prix_sk"))
    lake.move_on()
    check()
    assert lake.facts() == lake.want()


def test_feeds_may_be_forgotten(lake, spark):
    path = str(lake.root / "a")
    for day in ("01", "02", "03"):
        lake.slot(day, "10", station("1", price(day, "08", "1.7"), ville=f"V{day}"))
        lake.move_on()
        if day != "02":
            progress.latest_attributes(spark, path, lake.events(), FoldLedger(spark, lake.silver))
        else:
            FoldLedger(spark, lake.silver).forget_feeds(99)
            FactLog(spark, lake.fact).forget_feeds(99)
    assert [r["ville"] for r in spark.read.parquet(path).collect()] == ["V03"]
    assert lake.facts() == lake.want()


def test_counts_that_a_crash_left_behind_are_counted_anew(lake, spark, monkeypatch):
    lake.slot("01", "10", station("1", price("01", "08", "1.7")), station("2", price("01", "08", "1.7")))
    lake.move_on()
    lake.counts()
    lake.slot("02", "10", station("1", price("02", "08", "1.5")))
    lake.move_on()
    real = histogram.replace_table

    def dies(df, path, note):
        if path.endswith("latest"):
            raise OSError("died after the counts")
        return real(df, path, note)

    with monkeypatch.context() as patch:
        patch.setattr(histogram, "replace_table", dies)
        with pytest.raises(OSError):
            lake.counts()
    _, counts = lake.counts()
    assert {(r["prix_euro"], r["stations"]) for r in counts.collect()} == {(Decimal("1.500"), 1), (Decimal("1.700"), 1)}


def test_statistics_of_counts_equal_those_of_the_prices(spark):
    rng = random.Random(3)
    prices = [(g, "Gazole", Decimal(rng.randint(1200, 1300)).scaleb(-3)) for g in ("A", "B") for _ in range(120)]
    prices += [("C", "Gazole", Decimal("1.111"))]
    latest = spark.createDataFrame(prices, "region_nom string, carburant_nom string, prix_euro decimal(10,3)")
    counts = latest.groupBy(*histogram.COUNTED).agg(F.count(F.lit(1)).alias("stations"))
    ranks = histogram.group_ranks(counts)
    plain = lambda df: sorted(map(tuple, df.select(sorted(df.columns)).collect()))
    assert plain(histogram.stats_of_ranks(ranks)) == plain(marts.region_stats(latest))
    for c in set(marts.RANKING) - set(latest.columns) - {"rang_moins_cher_region", "rang_plus_cher_region", "ecart_prix_vs_moyenne_region"}:
        latest = latest.withColumn(c, F.lit("x"))
    stats = histogram.stats_of_ranks(ranks)
    assert plain(histogram.ranking_of_ranks(latest, ranks, stats)) == plain(marts.station_ranking(latest, stats))


def test_a_count_below_zero_stops_the_job(spark):
    shape = "region_nom string, carburant_nom string, prix_euro decimal(10,3)"
    counts = spark.createDataFrame([("A", "Gazole", Decimal("1.5"), 1)], shape + ", stations long")
    price = spark.createDataFrame([("A", "Gazole", Decimal("1.6"))], shape)
    with pytest.raises(Exception, match="never came"):
        histogram.moved_counts(counts, price, price.limit(0)).collect()


# --- the build ---------------------------------------------------------------------------------------


def job_count(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_a_build_with_nothing_new_does_next_to_nothing(lake, spark):
    cfg = BuildConfig(lake.bronze, str(lake.root / "wh"), as_of=dt.datetime(2026, 6, 10))
    lake.slot("01", "10", station("1", price("01", "08", "1.7")), station("2", price("01", "08", "0.3"), cp="29900", ville="B"))
    ingest(spark, str(lake.root / "raw"), lake.bronze, F.lit("u"))
    first = sorted(map(tuple, build(spark, cfg).collect()))
    files = lambda: sorted(str(p) for p in (lake.root / "wh").rglob("*.parquet") if "gate" not in str(p))
    before, jobs = files(), job_count(spark)
    again = build(spark, cfg)
    assert job_count(spark) - jobs <= 10
    assert sorted(map(tuple, again.collect())) == first and files() == before  # the same report, nothing rewritten
    gone = table_path(cfg.warehouse, "agg_classement_stations")
    storage.remove(spark, gone)
    build(spark, cfg)
    assert spark.read.parquet(gone).count() == 2  # a table that was deleted is made again


def test_only_what_depends_on_a_changed_table_is_made_again(lake, spark):
    csv = lake.root / "fuels.csv"
    csv.write_text("carburant_id,carburant_nom,carburant_libelle_long\n1,Gazole,Diesel\n")
    cfg = BuildConfig(lake.bronze, str(lake.root / "wh"), as_of=dt.datetime(2026, 6, 10), fuels_csv=str(csv))
    lake.slot("01", "10", station("1", price("01", "08", "1.7")))
    ingest(spark, str(lake.root / "raw"), lake.bronze, F.lit("u"))
    build(spark, cfg)
    files = lambda name: sorted(p.name for p in (lake.root / "wh" / "gold" / name).rglob("*.parquet"))
    before = {n: files(n) for n in ("seed_departement", "dim_date", "dim_carburant", "agg_classement_stations")}
    csv.write_text("carburant_id,carburant_nom,carburant_libelle_long\n1,Gazole,Diesel B7 et autres\n")
    build(spark, cfg)
    after = {n: files(n) for n in before}
    assert {n for n in before if before[n] != after[n]} == {"dim_carburant", "agg_classement_stations"}


def test_independent_nodes_run_side_by_side(spark):
    import threading

    from priceloom.plans.build import Graph, Node
    from priceloom.quality import not_null

    met = threading.Barrier(2, timeout=60)

    def make():
        met.wait()  # passes only if the other node is under way, too
        return spark.range(1)

    checks = lambda _: [not_null("id")]
    fails = lambda: 1 / 0
    graph = Graph(spark, set(), {})
    graph.run([
        Node("c", ["a", "b"], lambda: spark.range(2), checks), Node("a", [], make, checks), Node("b", [], make, checks),
        Node("d", [], fails, checks), Node("e", ["d"], make, checks), Node("f", ["e"], make, checks),
    ])
    assert set(graph.tables) == {"a", "b", "c"}
    assert Counter(r[5].split(":")[0] for rows in graph.report.values() for r in rows) == {"pass": 3, "error": 1, "skipped": 2}


def test_a_change_of_format_warns(lake, spark):
    cfg = BuildConfig(lake.bronze, str(lake.root / "wh"), as_of=dt.datetime(2026, 6, 10))
    many = lambda day, odd, maj: [
        station(str(i), ("1", "Gazole", maj if i < odd else f"2026-06-{day} 08:00:00", "1.7")) for i in range(40)
    ]
    found = []
    for day, odd in (("01", 0), ("02", 1), ("03", 5), ("04", 0)):  # one text in forty is nothing, five are
        lake.slot(day, "10", *many(day, odd, f"{day}/06/2026 08:00"))
        ingest(spark, str(lake.root / "raw"), lake.bronze, F.lit("u"))
        report = build(spark, cfg).filter("node = 'source_format'").first()
        found.append((report["status"], report["failures"]))
    assert found == [("pass", 0), ("pass", 0), ("warn", 1), ("warn", 1)]
    assert build(spark, cfg).filter("node = 'source_format'").first()["failures"] == 1  # repeated, not counted again


def test_many_small_ledger_files_become_one_table(spark, tmp_path, monkeypatch):
    ledger = storage.Ledger(spark, str(tmp_path / "t"), "n bigint")
    monkeypatch.setattr(storage.Ledger, "TAIL", 3)
    files = lambda: len([p for p in (tmp_path / "t.ledger").iterdir() if p.suffix == ".json"])
    for n in range(13):
        ledger.add([(n,)])
        with monkeypatch.context() as patch:
            if n == 7:  # dies before the files are removed
                patch.setattr(storage, "remove", lambda *_: (_ for _ in ()).throw(OSError("died")))
                with pytest.raises(OSError):
                    ledger.compact()
            else:
                ledger.compact()
        assert sorted(r["n"] for r in ledger.read().collect()) == list(range(n + 1))
    assert files() <= 3
    ledger.restart([(100,)])
    assert [r["n"] for r in ledger.read().collect()] == [100] and ledger.exists()


def test_inserted_rows_enter_the_feed_beside_replaced_ones(spark, tmp_path):
    path, feed = str(tmp_path / "t"), str(tmp_path / "f")
    merge_by_key(path, rows(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3), (4, "c", 4)), "id", "part")
    offered = rows(spark, (1, "a", 10), (5, "a", 5), (2, "d", 20), (6, "e", 6))
    result = merge_by_key(path, offered, "id", "part", removed=spark.createDataFrame([(3,)], "id long"), feed=feed)
    assert (result.inserted, result.updated, result.removed) == (2, 2, 1)
    assert changes(spark, feed) == [
        (1, "update", (1, "a", 1), (1, "a", 10)), (2, "update", (2, "b", 2), (2, "d", 20)), (3, "delete", (3, "c", 3), None),
        (5, "insert", None, (5, "a", 5)), (6, "insert", None, (6, "e", 6)),
    ]
    assert stored(spark, path) == [(1, "a", 10), (2, "d", 20), (4, "c", 4), (5, "a", 5), (6, "e", 6)]


def test_rows_of_other_partitions_are_not_joined_for_the_feed(spark, tmp_path, monkeypatch):
    path, feed, real, plans = str(tmp_path / "t"), str(tmp_path / "f"), merge._write_feed, []

    def watched(feed, held, fresh, *rest):
        plans.append(fresh._jdf.queryExecution().optimizedPlan().toString())
        real(feed, held, fresh, *rest)

    monkeypatch.setattr(merge, "_write_feed", watched)
    merge_by_key(path, rows(spark, (1, "a", 1), (2, "a", 2)), "id", "part", keep_smallest="v")
    merge_by_key(path, rows(spark, (1, "a", 0), (2, "a", 9), (3, "b", 3)), "id", "part", keep_smallest="v", feed=feed)
    assert [(r[0], r[1]) for r in changes(spark, feed)] == [(1, "update"), (3, "insert")]
    outer, *legs = re.split(r"\n(?=:- |\+- )", plans[0])
    assert outer.startswith("Union") and sum("Join" in leg for leg in legs) == 1, plans[0]


def test_the_first_merge_writes_its_rows_once(spark, tmp_path, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("written twice")

    monkeypatch.setattr(merge, "settle", refuse)
    path = str(tmp_path / "t")
    assert merge_by_key(path, rows(spark, (1, "a", 1), (2, "b", 2)), "id", "part").inserted == 2
    assert stored(spark, path) == [(1, "a", 1), (2, "b", 2)]


def test_a_first_merge_that_fails_leaves_no_table(spark, tmp_path):
    path = str(tmp_path / "t")
    bad = rows(spark, (1, "a", 1)).withColumn("v", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception, match="no"):
        merge_by_key(path, bad, "id", "part")
    assert not storage.exists(spark, path)
    assert merge_by_key(path, rows(spark, (1, "a", 1)), "id", "part").inserted == 1
    assert stored(spark, path) == [(1, "a", 1)]
