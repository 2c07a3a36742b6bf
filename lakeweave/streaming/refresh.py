"""T4: silver after bronze or roster changes, gold after silver, only for the reports concerned.

A lake folder holds bronze, silver and gold tables as Parquet partitioned by report; a refresh
overwrites the partitions of the touched reports (dynamic partition overwrite) and leaves the files of all others
as they are.  A bronze batch touches the reports it carries.  A roster change touches the reports that one of the
changed members' old or new match keys leads to: ``roster_index`` holds, per report, every key
by which its actors and player details look members up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import together
from ..operators.joins import left_keys, right_keys
from ..plans import combat as C
from ..session import materialize
from .incremental import landed_stream, run_available_now

SILVER = {"silver_events": C.silver_events, "silver_actors": C.silver_actors, "silver_player_details": C.silver_player_details}
GOLD = {"gold_fight_player_perf": C.gold_fight_player_perf, "gold_damage_taken": C.gold_damage_taken, "gold_deaths": C.gold_deaths}
BRONZE = ("events", "reports", "fights", "actors", "abilities", "player_details")


class Lake:
    """Tables under one root; all but the roster are partitioned by report."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table)).withColumn("report_code", F.col("report_code").cast("string"))

    def replace(self, table: str, rows: DataFrame) -> None:
        """Replaces the reports that ``rows`` holds, and no others."""
        (rows.hint("rebalance", "report_code").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("report_code").parquet(self.path(table)))

    def roster(self, version: int) -> DataFrame:
        return self.spark.read.parquet(self.path(f"roster/version={version}"))

    def put_roster(self, roster: DataFrame, version: int) -> DataFrame:
        roster.write.mode("overwrite").parquet(self.path(f"roster/version={version}"))
        return self.roster(version)


class Touched:
    """Some reports of the lake: the range of their codes prunes partitions, the join does the rest."""

    def __init__(self, codes: DataFrame):
        self.codes = materialize(codes.select("report_code").distinct(), "touched")
        ends = self.codes.agg(F.min("report_code").alias("lo"), F.max("report_code").alias("hi")).first()
        self.lo, self.hi = ends["lo"], ends["hi"]

    def __bool__(self) -> bool:
        return self.lo is not None

    def of(self, table: DataFrame) -> DataFrame:
        return table.where(F.col("report_code").between(F.lit(self.lo), F.lit(self.hi))).join(self.codes, "report_code", "left_semi")


class _Reports:
    """The lake as jobs see it, cut to the touched reports; with ``stored`` they read its silver tables."""

    def __init__(self, lake: Lake, touched: Touched, roster: DataFrame, stored: bool):
        self.lake, self.touched, self.roster, self.land = lake, touched, roster, stored
        self.sf_dir, self.tables = lake.root, {}

    def _table(self, name: str) -> DataFrame:
        if name not in self.tables:
            self.tables[name] = self.touched.of(self.lake.read(name))
        return self.tables[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name not in BRONZE:
            raise AttributeError(name)
        return self._table(name)

    def keep(self, name: str, build) -> DataFrame:
        return self._table(name) if name in SILVER else build(self)


def index_keys(b) -> DataFrame:
    """(report_code, _prio, _k): the keys by which a report's actors and players look members up."""
    actors = left_keys(C.resolved_actors(b), ["report_code"], C.actor_matches())
    players = left_keys(C.plain_player_details(b), ["report_code"], C.detail_matches())
    return actors.unionByName(players).distinct()


def refresh(lake: Lake, touched: Touched, roster: DataFrame, changed: str = "bronze", gold: dict = GOLD) -> None:
    """Silver, then gold, of the touched reports.  ``changed``: what changed; a roster does not change silver events
    nor the keys by which members are looked up."""
    if not touched:
        return
    b = _Reports(lake, touched, roster, stored=False)
    for name, build in SILVER.items():
        if changed == "bronze" or name != "silver_events":
            lake.replace(name, build(b))
    if changed == "bronze":
        lake.replace("roster_index", index_keys(b))
    b = _Reports(lake, touched, roster, stored=True)
    for name, build in gold.items():
        lake.replace(name, build(b))


def members(roster: DataFrame) -> DataFrame:
    from types import SimpleNamespace

    return C.silver_roster(SimpleNamespace(roster=roster))


def touched_by_roster(lake: Lake, old: DataFrame, new: DataFrame) -> Touched:
    """Reports that a member who came, left or changed leads to, by old or new keys (duplicates count)."""
    old, new = members(old), members(new)
    changed = new.exceptAll(old).unionByName(old.exceptAll(new))
    keys = right_keys(changed, [], C.actor_matches()).distinct()
    return Touched(lake.read("roster_index").join(keys, ["_prio", "_k"]))


def apply_roster(lake: Lake, roster: DataFrame, version: int, gold: dict = GOLD) -> Touched:
    """A new roster snapshot: refreshes the reports concerned and returns them."""
    new = lake.put_roster(roster, version)
    touched = touched_by_roster(lake, lake.roster(version - 1), new)
    refresh(lake, touched, new, "roster", gold)
    return touched


def ingest_and_refresh(lake: Lake, source: str, roster: DataFrame, checkpoint: str, per_trigger: int | None = None, gold: dict = GOLD) -> None:
    """Landed bronze events (whole reports or pieces of them) -> bronze, silver and gold of the reports of each batch.

    An event is known by (report, page, event); of two deliveries the later counts.  A replayed batch gives the same tables."""
    place = ["report_code", "page_index", "event_index"]

    def sink(batch: DataFrame, epoch: int) -> None:
        rest = [c for c in batch.columns if c not in (*place, "_landed")]
        new = materialize(together(batch, place).groupBy(*place).agg(F.max_by(F.struct(*rest), F.col("_landed")).alias("e")).select(*place, "e.*"), "batch")
        touched = Touched(new)
        if _exists(lake, "events"):
            new = materialize(touched.of(lake.read("events")).join(new, place, "left_anti").unionByName(new), "events")
        lake.replace("events", new)
        refresh(lake, touched, roster, gold=gold)

    run_available_now(landed_stream(lake.spark, source, per_trigger), sink, checkpoint)


def _exists(lake: Lake, table: str) -> bool:
    from ..sources.sinks import _read

    return _read(lake.spark, lake.path(table)) is not None
