import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from priceloom.contracts import BRONZE
from priceloom.sources import archives
from priceloom.sources.archives import FeedDriftError, drift_gate, parse_snapshots, scan_archives, type_stations, unpack
from priceloom.sources.profile import accented_samples, field_presence, id_name_pairs, in_id_order, profile_feed, text_shapes
from priceloom.sources.slots import existing_slots, ingest, read_bronze, write_new_slots
from priceloom.streaming import ingest_stream
from tests.conftest import SAMPLE_FEED, feed, land, station, zipped


@pytest.fixture()
def sample(spark, tmp_path):
    land(tmp_path, "2026-06-03", "10", zipped(SAMPLE_FEED.encode("latin-1"), readme_txt=b"not xml"))
    rows, files = parse_snapshots(scan_archives(spark, str(tmp_path)), F.lit("https://example.test/feed"))
    return rows.collect(), files.collect()


def test_counts(sample):
    rows, files = sample
    assert len(rows) == 5
    assert (files[0]["station_count"], files[0]["price_row_count"], files[0]["parse_errors"]) == (6, 5, 6)


def test_types(spark, tmp_path):
    land(tmp_path, "2026-06-03", "10", zipped(SAMPLE_FEED.encode("latin-1")))
    rows, _ = parse_snapshots(scan_archives(spark, str(tmp_path)))
    have = {f.name: f.dataType for f in rows.schema}
    assert all(have[f.name] == f.dataType for f in BRONZE)


def test_values(sample):
    by_key = {(r["station_id"], r["carburant_id"]): r for r in sample[0]}
    assert sorted(by_key) == [("1001", "4"), ("42", "1"), ("560", "1"), ("560", "2"), ("7", "3")]
    west = by_key["560", "2"]
    assert (west["ville"], west["adresse"], west["cp"], west["pop"]) == ("Île-aux-Grées", None, "29900", "R")
    assert (west["latitude"], west["longitude"]) == (pytest.approx(47.875), pytest.approx(-3.917))
    assert (west["prix_euro"], by_key["560", "1"]["prix_euro"]) == (1.759, 1.64)
    assert west["maj_timestamp"] == dt.datetime(2026, 4, 30, 8, 5, 9)
    assert by_key["560", "1"]["maj_timestamp"] == dt.datetime(2026, 4, 30, 23, 50)
    assert {r["ingestion_ts"] for r in sample[0]} == {dt.datetime(2026, 6, 3, 10)}
    nowhere = by_key["1001", "4"]
    assert (nowhere["latitude"], nowhere["longitude"], nowhere["ville"], nowhere["cp"]) == (None, None, None, None)


@pytest.mark.parametrize(
    ("content", "message"),
    [
        (zipped(b'<?xml version="1.0"?><wrong_root><pdv id="1"/></wrong_root>'), "root element is <wrong_root>"),
        (zipped(b'<?xml version="1.0"?><pdv_liste></pdv_liste>'), "no <pdv> in the document"),
        (zipped(b"<not-xml"), "not well-formed"),
        (zipped(feed(station("1", ("1", "Gazole", "2026-06-03 09:00:00", "1.7")))[:-12]), "not well-formed"),
        (zipped(b"", name="", readme_txt=b"x"), "without an XML member"),
        (b"plain bytes", "not a ZIP"),
    ],
)
def test_drift_raises(spark, tmp_path, content, message):
    land(tmp_path, "2026-06-03", "10", content)
    with pytest.raises(FeedDriftError, match=message):
        parse_snapshots(scan_archives(spark, str(tmp_path)))


def test_first_xml_entry_in_any_case():
    entry, stream = archives.open_feed(zipped(b"<a/>", name="RANDOM_abc.XML", readme_txt=b"x"))
    assert (entry, stream.read()) == ("RANDOM_abc.XML", b"<a/>")


def test_stations_are_streamed():
    many = feed(*[station(str(i), ("1", "Gazole", "2026-06-03 09:00:00", "1.7")) for i in range(5000)])
    assert sum(1 for _ in archives.read_stations(io.BytesIO(many))) == 5000


def test_nested_tags_of_the_same_name_are_not_taken():
    raw = feed('<pdv id="1"><box><ville>no</ville><prix id="9"/></box><ville>yes</ville></pdv>')
    (record,) = archives.read_stations(io.BytesIO(raw))
    assert (record["ville"], record["prices"]) == ("yes", [])


def test_gate_names_the_file_and_keeps_good_ones(spark, tmp_path):
    good = station("1", ("1", "Gazole", "2026-06-03 09:00:00", "1.7"))
    land(tmp_path, "2026-06-03", "09", zipped(feed(good)))
    land(tmp_path, "2026-06-03", "10", zipped(b"<not-xml"))
    stations = type_stations(unpack(scan_archives(spark, str(tmp_path))))
    with pytest.raises(FeedDriftError, match="hh=10"):
        drift_gate(stations)
    assert stations.filter("drift IS NULL").count() == 1


def test_ingest_writes_once_and_replays(spark, tmp_path):
    raw, bronze, again = (str(tmp_path / n) for n in ("raw", "bronze", "again"))
    land(tmp_path / "raw", "2026-06-03", "07", zipped(SAMPLE_FEED.encode("latin-1")))
    first = ingest(spark, raw, bronze)["slots"].collect()
    assert [(r["dt"], r["hh"], r["row_count"], r["skipped"]) for r in first] == [("2026-06-03", "07", 5, False)]
    assert first[0]["bytes_written"] > 0
    assert ingest(spark, raw, bronze) == {}
    land(tmp_path / "raw", "2026-06-03", "08", zipped(SAMPLE_FEED.encode("latin-1")))
    assert [(r["hh"], r["row_count"]) for r in ingest(spark, raw, bronze)["slots"].collect()] == [("08", 5)]
    ingest(spark, raw, again)
    drop = ["source_url"]
    left, right = read_bronze(spark, bronze).drop(*drop), read_bronze(spark, again).drop(*drop)
    assert left.count() == 10 and left.exceptAll(right).isEmpty()


def slot_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "station_id string, prix_euro double, dt string, hh string")


def test_existing_slot_is_skipped(spark, tmp_path):
    root = str(tmp_path / "b")
    write_new_slots(slot_rows(spark, ("1", 1.5, "2026-06-03", "09")), root)
    report = write_new_slots(
        slot_rows(spark, ("1", 9.9, "2026-06-03", "09"), ("2", 1.6, "2026-06-03", "10")), root
    ).collect()
    assert [(r["hh"], r["row_count"], r["bytes_written"] > 0, r["skipped"]) for r in report] == [
        ("09", 0, False, True), ("10", 1, True, False)
    ]
    stored = read_bronze(spark, root).select("station_id", "prix_euro", "dt", "hh").collect()
    assert sorted(map(tuple, stored)) == [("1", 1.5, "2026-06-03", "09"), ("2", 1.6, "2026-06-03", "10")]
    assert sorted(p.name for p in (tmp_path / "b" / "dt=2026-06-03").iterdir()) == ["hh=09", "hh=10"]


def test_half_written_slot_is_replaced(spark, tmp_path):
    root = str(tmp_path / "b")
    write_new_slots(slot_rows(spark, ("1", 1.5, "2026-06-03", "09")), root)
    half = slot_rows(spark, ("2", 1.6, "2026-06-03", "10"))
    half.write.mode("append").partitionBy("dt", "hh").parquet(root)  # no ledger entry: the run died here
    whole = slot_rows(spark, ("2", 1.6, "2026-06-03", "10"), ("3", 1.7, "2026-06-03", "10"))
    write_new_slots(whole, root)
    assert read_bronze(spark, root).filter("hh = '10'").count() == 2


def test_foreign_root_without_ledger(spark, tmp_path):
    root = str(tmp_path / "b")
    slot_rows(spark, ("1", 1.5, "2026-06-03", "09")).write.partitionBy("dt", "hh").parquet(root)
    assert existing_slots(spark, root) == [("2026-06-03", "09")]
    assert write_new_slots(slot_rows(spark, ("1", 9.9, "2026-06-03", "09")), root).first()["skipped"]


def test_unknown_columns_are_ignored_and_days_pruned(spark, tmp_path):
    root = str(tmp_path / "b")
    wide = slot_rows(spark, ("1", 1.5, "2026-06-03", "09"), ("1", 1.6, "2026-06-04", "09")).withColumn("new", F.lit(1))
    wide.write.partitionBy("dt", "hh").parquet(root)
    rows = read_bronze(spark, root, dt_from="2026-06-04")
    assert rows.columns == [*BRONZE.fieldNames(), "dt", "hh"]
    assert rows.select("prix_euro", "hh").collect() == [(1.6, "09")]


def test_profile(spark):
    df = spark.createDataFrame(
        [("10", "E", "Bréhan"), ("2", "B", " "), ("2", "B", None), ("x", None, "Lyon")], "id string, nom string, ville string"
    )
    pairs = in_id_order(id_name_pairs(df, "id", "nom"), "id").collect()
    assert [tuple(r) for r in pairs] == [("2", "B", 2), ("10", "E", 1), ("x", "?", 1)]
    presence = {r["column"]: tuple(r)[1:] for r in field_presence(df, ["nom", "ville"]).collect()}
    assert presence == {"nom": (4, 1, 0), "ville": (4, 2, 1)}
    assert [r[0] for r in accented_samples(df, "ville").collect()] == ["Bréhan"]
    assert sorted(map(tuple, text_shapes(df, "id").collect())) == [("9", 2), ("99", 1), ("x", 1)]


def test_archives_stream_into_slots(spark, tmp_path):
    raw, bronze, checkpoint = (str(tmp_path / n) for n in ("raw", "bronze", "checkpoint"))
    for hh, value in (("07", "1.7"), ("08", "1.6")):
        land(tmp_path / "raw", "2026-06-03", hh, zipped(feed(station("1", ("1", "Gazole", "2026-06-03 06:00:00", value)))))
        for _ in range(2):
            ingest_stream(spark, raw, bronze, checkpoint).awaitTermination()
    rows = read_bronze(spark, bronze).select("hh", "prix_euro").collect()
    assert sorted(map(tuple, rows)) == [("07", 1.7), ("08", 1.6)]


@pytest.mark.parametrize("streamed", [False, True])
def test_a_drifted_file_is_loud_but_does_not_hold_up_the_others(spark, tmp_path, streamed):
    raw, bronze, checkpoint = (str(tmp_path / n) for n in ("raw", "bronze", "checkpoint"))

    def run():
        if streamed:
            ingest_stream(spark, raw, bronze, checkpoint).awaitTermination()
        else:
            ingest(spark, raw, bronze)

    good = zipped(feed(station("1", ("1", "Gazole", "2026-06-03 06:00:00", "1.7"))))
    land(tmp_path / "raw", "2026-06-03", "07", good)
    land(tmp_path / "raw", "2026-06-03", "08", zipped(b"<not-xml"))
    for _ in range(2):
        with pytest.raises(Exception, match="hh=08.*not well-formed"):
            run()
        assert existing_slots(spark, bronze) == [("2026-06-03", "07")]
    land(tmp_path / "raw", "2026-06-03", "08", good)
    run()
    assert existing_slots(spark, bronze) == [("2026-06-03", "07"), ("2026-06-03", "08")]
    assert read_bronze(spark, bronze).count() == 2


def test_feed_profile(spark, tmp_path):
    land(tmp_path, "2026-06-03", "10", zipped(SAMPLE_FEED.encode("latin-1")))
    found = {k: df.collect() for k, df in profile_feed(unpack(scan_archives(spark, str(tmp_path)))).items()}
    assert found["files"][0]["station_count"] == 6
    pairs = [("1", "Gazole", 3), ("2", "", 1), ("2", "SP95", 1), ("3", "E85", 1), ("4", "GPLc", 1), ("5", "E10", 2), ("6", "SP98", 1), ("", "Gazole", 1)]
    assert [tuple(r) for r in found["pairs"]] == pairs  # what is no number comes last
    missing = {r["column"]: r["missing"] for r in found["presence"]}
    assert missing == {"station_id": 1, "cp": 1, "ville": 1, "adresse": 6, "pop": 0, "latitude": 1, "longitude": 1}
    assert [r["ville"].strip() for r in found["accented"]] == ["Île-aux-Grées"]
    degrees = {r["station_id"]: r["longitude_degrees"] for r in found["coordinates"]}
    assert degrees["560"] == pytest.approx(-3.917) and degrees["1001"] is None
    assert ("1001", "0.990", 0.99) in [(r["station_id"], r["valeur"], r["euros"]) for r in found["prices"]]


MANY = [station(str(i), ("1", "Gazole", "2026-06-03 06:00:00", "1.7")) for i in range(500)]


@pytest.mark.parametrize("streamed", [False, True])
def test_a_truncated_file_is_refused_whole(spark, tmp_path, streamed):
    raw, bronze, checkpoint = (str(tmp_path / n) for n in ("raw", "bronze", "checkpoint"))

    def run():
        if streamed:
            ingest_stream(spark, raw, bronze, checkpoint).awaitTermination()
        else:
            ingest(spark, raw, bronze)

    whole = feed(*MANY)
    land(tmp_path / "raw", "2026-06-03", "07", zipped(whole[: len(whole) // 2]), "a.zip")
    land(tmp_path / "raw", "2026-06-03", "07", zipped(feed(MANY[0])), "b.zip")
    for _ in range(2):
        with pytest.raises(Exception, match="a.zip: not well-formed"):
            run()
        assert existing_slots(spark, bronze) == [] and read_bronze(spark, bronze).isEmpty()
    land(tmp_path / "raw", "2026-06-03", "07", zipped(whole), "a.zip")
    run()
    assert read_bronze(spark, bronze).count() == 501


def test_a_refused_file_counts_nothing(spark, tmp_path):
    whole = feed(*MANY)
    land(tmp_path, "2026-06-03", "07", zipped(whole[: len(whole) // 2]))
    (stats,) = parse_snapshots(scan_archives(spark, str(tmp_path)), gate=False)[1].collect()
    assert (stats["station_count"], stats["price_row_count"], stats["parse_errors"]) == (0, 0, 0) and stats["drift"]


def test_a_slot_without_good_rows_is_finished(spark, tmp_path):
    raw, bronze = str(tmp_path / "raw"), str(tmp_path / "bronze")
    land(tmp_path / "raw", "2026-06-03", "07", zipped(feed(station("1", ("1", "Gazole", "soon", "1.7")))))
    report = ingest(spark, raw, bronze)["slots"].collect()
    assert [(r["hh"], r["row_count"], r["skipped"]) for r in report] == [("07", 0, False)]
    assert ingest(spark, raw, bronze) == {}
    assert read_bronze(spark, bronze).isEmpty() and existing_slots(spark, bronze) == [("2026-06-03", "07")]


def test_archives_of_one_slot_in_many_batches(spark, tmp_path):
    raw, bronze, checkpoint = (str(tmp_path / n) for n in ("raw", "bronze", "checkpoint"))
    for i in range(3):
        land(tmp_path / "raw", "2026-06-03", "07", zipped(feed(MANY[i])), f"{i}.zip")
    ingest_stream(spark, raw, bronze, checkpoint, files_per_batch=1).awaitTermination()
    assert read_bronze(spark, bronze).count() == 3


def test_landed_archives_grow_in_number_not_in_size(spark):
    from driver_queries.feed import many_stations

    # All keys fall on one day, hour and part.
    orders = spark.range(2500).selectExpr("id * 84 AS o_orderkey", "1.5D AS o_totalprice", "DATE'2026-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority")
    files = {r["path"]: r["xml"].count("<pdv ") for r in many_stations(orders).collect()}
    assert len(files) == 3 and max(files.values()) <= 1000 and sum(files.values()) == 2500


def test_short_documents_are_read_as_the_walk_reads_them():
    good = b"<pdv_liste><!-- x --><pdv id='1'><prix id='1'/></pdv><other><pdv id='no'/></other><pdv id='2'/></pdv_liste>"
    for text in (good, good[:-12], b"<pdv_liste/>", b"<x><pdv/></x>", b"", good.replace(b"<!-- x -->", b" " * (archives._SHORT + 1))):
        told = []
        for read in (archives.walk_stations, archives.stations_of):
            found = []
            try:
                for element in read(io.BytesIO(text)):
                    found.append((element.get("id"), len(element)))
            except FeedDriftError as problem:
                found.append(str(problem))
            told.append(found)
        assert told[0] == told[1], text[:40]


def test_a_short_document_in_good_order_needs_no_walk(monkeypatch):
    monkeypatch.setattr(archives, "walk_stations", None)
    assert [e.get("id") for e in archives.stations_of(io.BytesIO(b"<pdv_liste><pdv id='1'/></pdv_liste>"))] == ["1"]


def test_round_trip_parses_each_archive_once(spark, tmp_path, monkeypatch):
    """The archives' Python pass has one place in the plans that read its outcome: the one that writes it."""
    from driver_queries import QUERIES

    plan = QUERIES["xml_flatten_roundtrip"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan
