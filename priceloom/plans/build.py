"""The whole build: every table is written, then checked, and an error stops what depends on it."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from priceloom.contracts import (
    DIM_CARBURANT,
    DIM_DATE,
    DIM_LOCALISATION,
    DIM_STATION,
    guard_not_null,
    require_contract,
)
from priceloom.fixed_values import CALENDAR_END, CALENDAR_START, DEPARTMENTS, FUELS, SOURCE_TIMEZONE
from priceloom.operators.merge import MergeResult
from priceloom.plans import dimensions, histogram, marts, progress, rules
from priceloom.plans.fact import FactLog, follow_silver, read_fact, rebuild_fact
from priceloom.plans.silver import FoldLedger, fold_new_slots, keyed_events, read_silver, rebuild_silver, waiting_slots
from priceloom.quality.checks import Check, QualityGateError, run_checks
from priceloom.quality.drift import format_drift
from priceloom.quality.freshness import freshness
from priceloom.sources import reference
from priceloom.sources.slots import existing_slots, read_slots, shapes_path, slot_shapes, slot_sizes
from priceloom.storage import Ledger, content_state, current_path, exists, read_text, replace_table, write_text

#: Tables of which a build checks only what it could change.
SCOPED = ["stg_prix", "int_prix_keyed", "fct_prix_carburant"]
#: All nodes, in the order of the report.
NODES = [
    "source_format", "seed_carburant", "seed_departement", "stg_prix", "dim_carburant", "dim_date", "dim_localisation", "dim_station",
    "int_prix_keyed", "fct_prix_carburant", "agg_dernier_prix_station_carburant", "agg_prix_region_carburant",
    "agg_classement_stations",
]
LAYERS = {"stg": "silver", "dim": "gold", "fct": "gold", "agg": "gold", "seed": "gold"}


@dataclass(frozen=True)
class BuildConfig:
    """Where things lie. ``as_of`` is a UTC clock reading; ``None`` takes the current time.

    Without CSV files for fuels and departments the fixed tables are used. ``check_changed`` checks of
    silver and the fact only the days and ingestion dates this build could change: rows never change
    elsewhere, and silver's key fixes its day, so what passed before still passes. A table that failed,
    or that a crashed build left unchecked, is checked whole until it passes.
    """

    bronze_root: str
    warehouse: str
    zone: str = SOURCE_TIMEZONE
    as_of: dt.datetime | None = None
    full_refresh: bool = False
    check_changed: bool = True
    fuels_csv: str | None = None
    departments_csv: str | None = None

    def now(self) -> dt.datetime:
        return self.as_of or dt.datetime.now(dt.UTC).replace(tzinfo=None)


def table_path(root: str, name: str, layer: str | None = None) -> str:
    """``root/layer/name``; the layer follows from the name's prefix and is silver by default."""
    return f"{root.rstrip('/')}/{layer or LAYERS.get(name.split('_')[0], 'silver')}/{name}"


def materialize(df: DataFrame, path: str, kind: str = "table", contract: T.StructType | None = None) -> DataFrame:
    """``table``: write beside the old version, then swap. ``view``: a temporary view. ``inline``: as is.

    With a contract, names and types are compared first and the write fails on a forbidden null; the
    old version stays in place then.
    """
    if contract is not None:
        df = guard_not_null(require_contract(df, contract), contract)
    if kind == "inline":
        return df
    if kind == "view":
        df.createOrReplaceTempView(path.rstrip("/").rsplit("/", 1)[-1])
        return df
    if kind != "table":
        raise ValueError(f"unknown kind {kind!r}")
    return replace_table(df, path)


@dataclass(frozen=True)
class Node:
    """A table of the build: what it needs, how it is made and checked, and which part of it has to be checked.

    ``state`` is what its content depends on besides the tables it needs. A node that is made ``always`` knows its
    state only then. ``stored`` reads what an earlier build left, if anything.
    """

    name: str
    needs: list[str]
    make: Callable[[], DataFrame]
    checks: Callable[[DataFrame], list[Check]]
    scope: Callable[[DataFrame], DataFrame] = lambda table: table
    state: Callable[[], str] = lambda: ""
    stored: Callable[[], DataFrame] | None = None
    always: bool = False


class Tables(dict):
    """Tables by name; one that an earlier build left is opened when somebody asks for it."""

    def __getitem__(self, name: str) -> DataFrame:
        table = super().__getitem__(name)
        if not isinstance(table, DataFrame):
            self[name] = table = table()
        return table


class Graph:
    """Builds nodes side by side, each as soon as those it needs have passed their checks.

    A node whose version, the hash of its state and of the versions it needs, is the one that passed last is
    neither made nor checked again; its report is repeated. Every node's jobs run in a scheduler pool
    of its own, which matters where ``spark.scheduler.mode`` is FAIR.
    """

    def __init__(self, spark: SparkSession, whole: set[str], passed: dict[str, dict], threads: int = 8) -> None:
        self.spark, self.whole, self.passed, self.threads = spark, whole, passed, threads
        self.tables = Tables()
        self.versions: dict[str, str] = {}
        self.report: dict[str, list[tuple]] = {}

    def _version(self, node: Node) -> str:
        told = [node.name, node.state(), *[self.versions[n] for n in node.needs]]
        return hashlib.sha256("\n".join(told).encode()).hexdigest()

    def _build(self, node: Node) -> tuple[DataFrame | Callable[[], DataFrame] | None, str, list[tuple]]:
        """The table if it passed, its version, and its report."""
        self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", node.name)
        known = self.passed.get(node.name)
        reuse = node.stored is not None and node.name not in self.whole
        if reuse and not node.always and known and known["version"] == self._version(node):
            return node.stored, known["version"], [tuple(r) for r in known["report"]]
        try:
            table = node.make()
        except Exception as problem:  # a refused contract or a failed write stops this branch only
            return None, "", [(node.name, "build", "", "error", 1, f"error: {problem}")]
        version = self._version(node)
        if reuse and known and known["version"] == version:
            return table, version, [tuple(r) for r in known["report"]]
        checked = table if node.name in self.whole else node.scope(table)
        results = run_checks(checked, node.checks(table)).collect()
        report = [(node.name, r["check"], r["column"], r["severity"], r["failures"], r["status"]) for r in results]
        return (table if all(r["status"] != "error" for r in results) else None), version, report

    def run(self, nodes: list[Node]) -> None:
        """Build what can be built; what needs a node that failed is skipped."""
        waiting = {n.name: n for n in nodes}
        with ThreadPoolExecutor(self.threads) as pool:
            running: dict[Future, Node] = {}
            while waiting or running:
                for name, node in list(waiting.items()):
                    if any(n in self.report and n not in self.tables for n in node.needs):
                        self.report[name] = [(name, "", "", "", 0, "skipped")]
                        del waiting[name]
                    elif all(n in self.tables for n in node.needs):
                        running[pool.submit(inheritable_thread_target(self.spark)(self._build), node)] = node
                        del waiting[name]
                if not running:
                    continue
                for future in wait(running, return_when=FIRST_COMPLETED).done:
                    node = running.pop(future)
                    table, self.versions[node.name], self.report[node.name] = future.result()
                    if table is not None:
                        self.tables[node.name] = table

    def passing(self) -> dict[str, dict]:
        return {n: {"version": self.versions[n], "report": self.report[n]} for n in self.tables}


def source_freshness(spark: SparkSession, cfg: BuildConfig) -> DataFrame:
    """Age and status of bronze. The newest row lies in the newest slot, so only that one is read."""
    sizes = slot_sizes(spark, cfg.bronze_root)
    newest = [s for s in existing_slots(spark, cfg.bronze_root) if sizes.get(s, 1)][-1:]
    return freshness(read_slots(spark, cfg.bronze_root, newest), "ingestion_ts", cfg.now())


def _seed_state(spark: SparkSession, path: str | None, rows: list[tuple]) -> str:
    """The content of a reference table."""
    return str(rows) if path is None else content_state(spark, path)


def build(spark: SparkSession, cfg: BuildConfig, strict: bool = True) -> DataFrame:
    """Bring all tables up to date and return the check report.

    Silver, the fact and the reductions the other tables rest on are incremental, unless
    ``full_refresh`` asks for all of history: the fact follows silver's feed, the latest prices and the counts
    of prices follow the fact's. Tables that do not depend on each other are built side by side; those whose
    inputs stand still are left alone. With ``strict`` an error raises at the end, after every node that
    could be built was built.
    """
    path = lambda name: table_path(cfg.warehouse, name)
    # Until this build has checked them, the scoped tables count as unchecked.
    gate = Ledger(spark, path("gate"), "build bigint, node string, passed boolean")
    gate.compact()
    notes = gate.read().collect()
    number = 1 + max((r["build"] for r in notes), default=0)
    latest = {}
    for r in sorted(notes, key=lambda r: (r["build"], r["passed"])):
        latest[r["node"]] = r["passed"]
    memory = _read_memory(spark, path("gate") + ".passed", cfg)
    graph = Graph(spark, {name for name, passed in latest.items() if not passed}, {} if cfg.full_refresh else memory)
    t = graph.tables
    now = F.lit(cfg.now().isoformat(sep=" ")).cast("timestamp_ntz")
    folds = FoldLedger(spark, path("stg_prix"))
    facts = FactLog(spark, path("fct_prix_carburant"))
    before = facts.watermark()
    folded: list[MergeResult] = []
    beside: dict[str, DataFrame] = {}
    unchecked: list[str] = []

    def begin(name: str) -> None:
        """From now on a crash leaves this table unchecked."""
        unchecked.append(name)
        gate.add([(number, name, False)])

    def changed_days(table: DataFrame) -> DataFrame:
        new = folds.days_after(before) if cfg.check_changed and not cfg.full_refresh else None
        late = folded[0].partitions if folded else None
        if new is None or late is None:
            return table
        return table.filter(F.col("maj_date").cast("string").isin([*new, *map(str, late)]))

    def changed_dates(table: DataFrame) -> DataFrame:
        whole = cfg.full_refresh or not cfg.check_changed
        return table if whole else table.filter(F.col("ingestion_date") >= F.lit(before.date()))

    def silver() -> DataFrame:
        if cfg.full_refresh or waiting_slots(spark, cfg.bronze_root, path("stg_prix"), folds):
            begin("stg_prix")
        if cfg.full_refresh:
            rebuild_silver(spark, cfg.bronze_root, path("stg_prix"), cfg.zone)
        elif "stg_prix" in unchecked:
            folded.append(fold_new_slots(spark, cfg.bronze_root, path("stg_prix"), cfg.zone))
        if "stg_prix" in unchecked:
            folds.hold()
        return read_silver(spark, path("stg_prix"))

    def keyed() -> DataFrame:
        begin("int_prix_keyed")
        rows = t["stg_prix"] if "int_prix_keyed" in graph.whole else changed_days(t["stg_prix"])
        return keyed_events(rows, cfg.zone)

    def fact() -> DataFrame:
        begin("fct_prix_carburant")
        target = path("fct_prix_carburant")
        if cfg.full_refresh:
            rebuild_fact(spark, t["stg_prix"], target, cfg.zone, folds.reached())
        else:
            follow_silver(spark, path("stg_prix"), target, cfg.zone)
        return read_fact(spark, target)

    def table(name: str, df: DataFrame, contract: T.StructType | None = None) -> DataFrame:
        return materialize(df, path(name), "table", contract)

    def latest_prices() -> DataFrame:
        log = FactLog(spark, path("fct_prix_carburant"))
        prices, beside["counts"] = histogram.advance_latest(
            spark, path("stg_derniers"), path("stg_comptes"), t["fct_prix_carburant"], log,
            t["dim_localisation"], t["dim_carburant"], graph.versions["seed_departement"] + graph.versions["seed_carburant"],
        )
        mart = marts.latest_prices(prices, t["dim_station"], t["dim_carburant"], t["dim_localisation"])
        return table("agg_dernier_prix_station_carburant", mart)

    def ranks() -> DataFrame:
        if "ranks" not in beside:
            counts = beside["counts"] if "counts" in beside else stored("stg_comptes")()
            beside["ranks"] = histogram.group_ranks(counts)
        return beside["ranks"]

    def region_stats() -> DataFrame:
        return table("agg_prix_region_carburant", histogram.stats_of_ranks(ranks()))

    def ranking() -> DataFrame:
        rows = histogram.ranking_of_ranks(
            t["agg_dernier_prix_station_carburant"], ranks(), t["agg_prix_region_carburant"]
        )
        return table("agg_classement_stations", rows)

    def stored(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.parquet(current_path(spark, path(name)))

    dims = ["dim_station", "dim_carburant", "dim_date", "dim_localisation"]
    parents = lambda: [t[d] for d in dims]
    places = lambda: progress.seen_places(spark, path("stg_lieux"), t["stg_prix"], folds)
    attributes = lambda: progress.latest_attributes(spark, path("stg_stations"), t["stg_prix"], folds)

    def node(name: str, needs: list[str], make, checks, **more) -> Node:
        more.setdefault("stored", stored(name) if exists(spark, path(name)) else None)
        return Node(name, needs, make, checks, **more)

    fact_exists = exists(spark, path("fct_prix_carburant"))
    first = (before.strftime("%Y-%m-%d"), before.strftime("%H"))
    slots = lambda: format_drift(slot_shapes(spark, cfg.bronze_root))
    graph.run([
        # Only slots the fact has not seen can have a new format.
        node("source_format", [], slots, lambda _: rules.for_format(), stored=slots,
             scope=lambda found: found.filter(F.struct("dt", "hh") >= F.struct(F.lit(first[0]), F.lit(first[1]))),
             state=lambda: content_state(spark, shapes_path(cfg.bronze_root) + ".ledger")),
        node("seed_carburant", [], lambda: table("seed_carburant", reference.fuels(spark, cfg.fuels_csv)),
             lambda _: rules.for_fuel_seed(), state=lambda: _seed_state(spark, cfg.fuels_csv, FUELS)),
        node("seed_departement", [], lambda: table("seed_departement", reference.departments(spark, cfg.departments_csv)),
             lambda _: rules.for_department_seed(), state=lambda: _seed_state(spark, cfg.departments_csv, DEPARTMENTS)),
        # What silver holds is known once it was folded; its number then says whether anything came.
        node("stg_prix", [], silver, lambda _: rules.for_silver(), scope=changed_days,
             state=lambda: str(folds.reached()), always=True),
        node("dim_carburant", ["seed_carburant"],
             lambda: table("dim_carburant", dimensions.dim_carburant(t["seed_carburant"]), DIM_CARBURANT),
             lambda _: rules.for_dim_carburant()),
        node("dim_date", [], lambda: table("dim_date", dimensions.dim_date(spark), DIM_DATE), lambda _: rules.for_dim_date(),
             state=lambda: f"{CALENDAR_START} {CALENDAR_END} {DIM_DATE.simpleString()}"),
        node("dim_localisation", ["stg_prix", "seed_departement"],
             lambda: table("dim_localisation", dimensions.dim_localisation(places(), t["seed_departement"]), DIM_LOCALISATION),
             lambda _: rules.for_dim_localisation(t["seed_departement"])),
        node("dim_station", ["stg_prix", "dim_localisation"],
             lambda: table("dim_station", dimensions.dim_station(attributes()), DIM_STATION),
             lambda _: rules.for_dim_station(t["dim_localisation"])),
        node("int_prix_keyed", ["stg_prix", *dims], keyed, lambda _: rules.for_keyed(*parents()),
             stored=lambda: keyed_events(t["stg_prix"], cfg.zone)),
        node("fct_prix_carburant", ["int_prix_keyed"], fact, lambda _: rules.for_fact(*parents(), now), scope=changed_dates,
             stored=(lambda: read_fact(spark, path("fct_prix_carburant"))) if fact_exists else None),
        node("agg_dernier_prix_station_carburant", ["fct_prix_carburant"], latest_prices, lambda _: rules.for_latest()),
        node("agg_prix_region_carburant", ["agg_dernier_prix_station_carburant", "seed_departement"], region_stats,
             lambda _: rules.for_region_stats(t["seed_departement"])),
        node("agg_classement_stations", ["agg_dernier_prix_station_carburant", "agg_prix_region_carburant"], ranking,
             lambda _: rules.for_ranking()),
    ])
    gate.add((number, name, True) for name in unchecked if name in t)
    if graph.passing() != memory:
        _write_memory(spark, path("gate") + ".passed", cfg, graph.passing())
    rows = [row for name in NODES for row in graph.report[name]]
    schema = "node string, check string, column string, severity string, failures bigint, status string"
    report = spark.createDataFrame(rows, schema)
    stopped = [r for r in rows if r[5].startswith("error")]
    if strict and stopped:
        found = "; ".join(f"{r[0]} {r[1]}({r[2]}): {r[5] if r[1] == 'build' else r[4]}" for r in stopped)
        raise QualityGateError(found)
    return report


def _read_memory(spark: SparkSession, path: str, cfg: BuildConfig) -> dict[str, dict]:
    """What passed in the last build, if it looked at the same things and no later in time."""
    try:
        held = json.loads(read_text(spark, path) or "{}")
    except json.JSONDecodeError:  # a crash while it was written: then everything is looked at again
        return {}
    same = held.get("settings") == _settings(cfg) and held.get("as_of", "9") <= cfg.now().isoformat()
    return held["nodes"] if same else {}


def _write_memory(spark: SparkSession, path: str, cfg: BuildConfig, nodes: dict[str, dict]) -> None:
    write_text(spark, path, json.dumps({"settings": _settings(cfg), "as_of": cfg.now().isoformat(), "nodes": nodes}))


def _settings(cfg: BuildConfig) -> list:
    return [cfg.bronze_root, cfg.zone, cfg.check_changed]
