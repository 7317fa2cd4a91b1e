"""Landed ZIP archives of the XML feed to typed price rows."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree
from xml.etree.ElementTree import Element

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from priceloom.contracts import BRONZE, SLOT, conform
from priceloom.fixed_values import FEED_ROOT, PRICE_TAG, STATION_TAG
from priceloom.functions import clean_text, empty_to_null, fixed_point, price, strict_ts, utc_instant
from priceloom.session import settle

_RAW = (
    "path string, entry string, drift string, station_id string, cp string, ville string, adresse string, "
    "pop string, latitude string, longitude string, "
    "prices array<struct<id: string, nom: string, maj: string, valeur: string>>"
)
_ROWS_PER_BATCH = 2_000
#: Bytes of a document that is held whole.
_SHORT = 1 << 16


class FeedDriftError(RuntimeError):
    """The feed no longer has the structure it should have. ``files`` has the statistics of all files, if known."""

    files: DataFrame | None = None


def scan_archives(spark: SparkSession, *paths: str) -> DataFrame:
    """Every ``*.zip`` under ``paths``: path, dt, hh (from the folder names) and content."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", True)
        .load(list(paths))
    )
    return files.select("path", *path_slot(F.col("path")), "content")


def path_slot(path: Column) -> tuple[Column, Column]:
    """``dt`` and ``hh`` from the folders of a path."""
    return (
        F.regexp_extract(path, r"/dt=([0-9-]+)/", 1).alias("dt"),
        F.regexp_extract(path, r"/hh=([0-9]+)/", 1).alias("hh"),
    )


def open_feed(content: bytes) -> tuple[str, io.BufferedIOBase]:
    """The first ``.xml`` entry of an archive, opened as a stream."""
    archive = zipfile.ZipFile(io.BytesIO(content))
    names = archive.namelist()
    entry = next((n for n in names if n.lower().endswith(".xml")), None)
    if entry is None:
        raise FeedDriftError(f"archive without an XML member, only {names}")
    return entry, archive.open(entry)


_STATION_ATTRIBUTES, _STATION_TEXTS = ("cp", "pop", "latitude", "longitude"), ("ville", "adresse")
_PRICE_ATTRIBUTES = ("id", "nom", "maj", "valeur")


def walk_stations(stream: io.BufferedIOBase) -> Iterator[Element]:
    """Each station's element, read as a stream so that memory does not grow with the file; gone after its turn."""
    depth, stations, root = 0, 0, None
    try:
        for event, element in ElementTree.iterparse(stream, events=("start", "end")):
            if event == "start":
                depth += 1
                if root is None:
                    root = element
                    if root.tag != FEED_ROOT:
                        raise FeedDriftError(f"root element is <{root.tag}>, not <{FEED_ROOT}>")
                continue
            depth -= 1
            if depth == 1:
                if element.tag == STATION_TAG:
                    stations += 1
                    yield element
                root.clear()
    except ElementTree.ParseError as problem:
        raise FeedDriftError(f"not well-formed: {problem}") from problem
    if not stations:
        raise FeedDriftError(f"no <{STATION_TAG}> in the document")


def stations_of(stream: io.BufferedIOBase) -> Iterable[Element]:
    """As `walk_stations`, of a stream that can be rewound: a short document in good order is parsed at once.

    That spares the events, most of the time of a document of few stations. Whatever is wrong with one is left to the
    walk, which hands out what comes before the damage.
    """
    try:
        text = stream.read(_SHORT + 1)
        root = ElementTree.fromstring(text) if len(text) <= _SHORT else None
    except (ElementTree.ParseError, zipfile.BadZipFile, zlib.error, EOFError):
        root = None
    if root is not None and root.tag == FEED_ROOT:
        found = [element for element in root if element.tag == STATION_TAG]
        if found:
            return found
    stream.seek(0)
    return walk_stations(stream)


def read_stations(stream: io.BufferedIOBase) -> Iterator[dict]:
    """One raw record per station."""
    for element in walk_stations(stream):
        yield {
            "station_id": element.get("id"),
            **{name: element.get(name) for name in _STATION_ATTRIBUTES},
            **{name: element.findtext(name) for name in _STATION_TEXTS},
            "prices": [{name: p.get(name) for name in _PRICE_ATTRIBUTES} for p in element.findall(PRICE_TAG)],
        }


class _Columns:
    """Stations gathered column by column: no object is made per station or price."""

    _NAMES = [part.split()[0] for part in _RAW.split(", ")[:10]]

    def __init__(self) -> None:
        self.held = {name: [] for name in self._NAMES}
        self.prices = {name: [] for name in _PRICE_ATTRIBUTES}
        self.ends = [0]

    def __len__(self) -> int:
        return len(self.ends) - 1

    def station(self, path: str, entry: str, element: Element) -> None:
        held, get = self.held, element.attrib.get
        held["path"].append(path)
        held["entry"].append(entry)
        held["drift"].append(None)
        held["station_id"].append(get("id"))
        for name in _STATION_ATTRIBUTES:
            held[name].append(get(name))
        for name in _STATION_TEXTS:
            held[name].append(element.findtext(name))
        found = element.findall(PRICE_TAG)
        for name, column in self.prices.items():
            column += [price.attrib.get(name) for price in found]
        self.ends.append(self.ends[-1] + len(found))

    def refused(self, path: str, entry: str | None, problem: str) -> None:
        for column in self.held.values():
            column.append(None)
        self.held["path"][-1], self.held["entry"][-1], self.held["drift"][-1] = path, entry, problem
        self.ends.append(self.ends[-1])

    def batch(self) -> pa.RecordBatch:
        told = pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in self.prices.values()], list(self.prices))
        prices = pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), told)
        columns = [pa.array(c, pa.string()) for c in self.held.values()]
        return pa.RecordBatch.from_arrays([*columns, prices], [*self._NAMES, "prices"])


def unpack(archives: DataFrame) -> DataFrame:
    """Archives[path, content] to raw stations; a file that drifted adds a row with ``drift`` set.

    Spark reads no ZIP, so unzipping and walking the XML happen in one Arrow pass per file; all
    typing, filtering and counting is left to Spark expressions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = _Columns()
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                name, entry = path.as_py(), None
                try:
                    entry, stream = open_feed(content.as_py())
                    for element in stations_of(stream):
                        columns.station(name, entry, element)
                        if len(columns) == _ROWS_PER_BATCH:
                            yield columns.batch()
                            columns = _Columns()
                except zipfile.BadZipFile as problem:
                    columns.refused(name, None, f"not a ZIP archive: {problem}")
                except FeedDriftError as problem:
                    columns.refused(name, entry, str(problem))
                if len(columns) >= _ROWS_PER_BATCH:
                    yield columns.batch()
                    columns = _Columns()
        if len(columns):
            yield columns.batch()

    return archives.select("path", "content").mapInArrow(run, _RAW)


def type_stations(raw: DataFrame) -> DataFrame:
    """Typed stations with ``good_prices`` and the number of records that had to be skipped.

    A station without an id counts as one error and loses its prices; otherwise each price with an
    unreadable time or value, or without fuel id or name, counts as one.
    """
    typed = F.transform(
        F.coalesce("prices", F.array().cast("array<struct<id: string, nom: string, maj: string, valeur: string>>")),
        lambda p: F.struct(
            empty_to_null(p["id"]).alias("carburant_id"),
            empty_to_null(p["nom"]).alias("carburant_nom"),
            strict_ts(p["maj"]).alias("maj_timestamp"),
            price(p["valeur"]).alias("prix_euro"),
        ),
    )
    complete = lambda p: (
        p["carburant_id"].isNotNull()
        & p["carburant_nom"].isNotNull()
        & p["maj_timestamp"].isNotNull()
        & p["prix_euro"].isNotNull()
    )
    known = F.col("station_id").isNotNull()
    return (
        raw.withColumn("station_id", empty_to_null(F.col("station_id")))
        .withColumn("good_prices", F.filter(typed, lambda p: known & complete(p)))
        .withColumn("shapes", F.transform(F.coalesce(F.col("prices.maj"), F.array().cast("array<string>")), text_shape))
        .withColumn("errors", F.when(known, F.size("prices") - F.size("good_prices")).otherwise(1))
        .select(
            "path", "entry", "drift", "station_id",
            empty_to_null(F.col("cp")).alias("cp"),
            clean_text(F.col("ville")).alias("ville"),
            clean_text(F.col("adresse")).alias("adresse"),
            empty_to_null(F.col("pop")).alias("pop"),
            fixed_point(F.col("latitude")).alias("latitude"),
            fixed_point(F.col("longitude")).alias("longitude"),
            "good_prices", "errors", "shapes",
        )
    )


def text_shape(text: Column) -> Column:
    """A text with every digit shown as 9; what is missing has the empty shape."""
    return F.coalesce(F.regexp_replace(text, "[0-9]", "9"), F.lit(""))


def parse_stats(stations: DataFrame) -> DataFrame:
    """Stations, good rows and errors per file, and why a file was refused. Of a refused file nothing counts."""
    whole = F.max("drift").isNull()
    of_whole = lambda value: F.when(whole, F.coalesce(value, F.lit(0))).otherwise(0)
    return stations.groupBy("path").agg(
        of_whole(F.count_if(F.col("drift").isNull())).alias("station_count"),
        of_whole(F.sum(F.size("good_prices"))).alias("price_row_count"),
        of_whole(F.sum("errors")).alias("parse_errors"),
        F.max("drift").alias("drift"),
    )


def drift_gate(files: DataFrame) -> DataFrame:
    """Return ``files`` (stations or statistics); raise when any file drifted.

    The message names the first twenty; the error's ``files`` has them all.
    """
    bad = files.filter("drift IS NOT NULL").select("path", "drift").orderBy("path").limit(20).collect()
    if bad:
        problem = FeedDriftError("; ".join(f"{r['path']}: {r['drift']}" for r in bad))
        problem.files = files
        raise problem
    return files


def whole_files(stations: DataFrame) -> DataFrame:
    """Stations of the files that were read to their end: the readable part of a damaged one is no snapshot.

    The refused files are written first: they are few, and once that is measured the stations need no shuffle.
    """
    refused = settle(stations.filter("drift IS NOT NULL").select("path").distinct(), "refused")
    return stations.join(refused, "path", "left_anti").select(*stations.columns)


def price_rows(stations: DataFrame, ingestion_ts: Column, source_url: Column) -> DataFrame:
    """One bronze row per good price, with the station's columns repeated."""
    flat = whole_files(stations).select("*", F.explode("good_prices").alias("p")).select("*", "p.*")
    extra = [c for c in SLOT.fieldNames() if c in stations.columns]
    rows = flat.withColumn("ingestion_ts", ingestion_ts).withColumn("source_url", source_url)
    return rows.select(*conform(rows, BRONZE).columns, *extra)


def parse_snapshots(
    archives: DataFrame, source_url: Column | None = None, gate: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Slotted archives to (bronze rows with dt and hh, statistics per file).

    The parsed stations are written once and read twice. Raises before any row is handed out when a
    file drifted; without ``gate`` such files only show in the statistics, which are written too.
    """
    stations = parsed_stations(archives)
    if gate:
        drift_gate(stations)
    return snapshots_of(stations, source_url)


def parsed_stations(archives: DataFrame) -> DataFrame:
    """Typed stations of slotted archives, written once."""
    return settle(type_stations(unpack(archives)), "stations")


def format_shapes(stations: DataFrame) -> DataFrame:
    """How often each shape of update time occurs per slot, in files that were read to their end."""
    whole = whole_files(stations).select(*path_slot(F.col("path")), F.explode("shapes").alias("shape"))
    return whole.groupBy("dt", "hh", "shape").agg(F.count(F.lit(1)).alias("row_count"))


def snapshots_of(stations: DataFrame, source_url: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Bronze rows with dt and hh, and statistics per file, of parsed stations."""
    slotted = stations.select("*", *path_slot(F.col("path")))
    url = F.col("path") if source_url is None else source_url
    return price_rows(slotted, slot_instant(F.col("dt"), F.col("hh")), url), settle(parse_stats(stations), "files")


def slot_instant(day: Column, hour: Column) -> Column:
    """The instant (TIMESTAMP) at which a UTC slot begins."""
    return utc_instant(F.concat(day, F.lit(" "), hour, F.lit(":00:00")).cast("timestamp_ntz"))
