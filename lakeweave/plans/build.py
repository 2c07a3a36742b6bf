"""Build outputs as tables: one table per job and per table that jobs keep, under ``<root>/<layer>/<name>``.

S31/S35/S36: nothing lists what reads what.  A job that asks for a kept table (bronze, silver, curated,
scores) has it built before it and then reads the stored one; the lineage is what jobs asked for and what
their analysed plans read.  Writes go through versioned tables, so a rebuild is replayable and readers never see a
half-written table.  With ``reuse`` a kept table that exists is read as it is: a changed silver table changes gold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import tables
from ..sources.sinks import VersionedTable
from . import registry

# layer of a table, from its name (silver/gold follow the lake naming, the rest are marts)
LAYERS = {"bronze": "bronze", "reports_raw": "bronze", "silver_": "silver", "combat_silver_": "silver", "gold_": "gold", "climate_": "gold", "rfm_": "gold",
          "climat_data": "silver", "clean_orders": "silver", "dim_": "gold", "fact_": "gold", "sales_silver": "silver", "sales_": "gold",
          "reviews_": "silver", "model_": "gold", "reference_": "silver", "corpus_": "adhoc",
          "ingestion_": "state", "retail_": "silver", "stream_": "bronze", "metric_long": "gold"}


def layer_of(name: str) -> str:
    for prefix, layer in LAYERS.items():
        if name.startswith(prefix):
            return layer
    return "gold"


def chosen(names=None, layer: str | None = None, family: str | None = None) -> list:
    return [n for n in registry.queries() if (names is None or n in names)
            and (layer is None or layer_of(n) == layer)
            and (family is None or n in registry.family_queries(family))]


def paths_read(df: DataFrame) -> set[str]:
    """Root folders of the file relations in the analysed plan."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    out = set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            out |= set(leaf.relation().location().rootPaths().mkString("\n").split("\n"))
    return out


class Build:
    """One run: ``written`` (in order) and ``lineage`` (table -> tables it reads)."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str, reuse: bool = False, skip_empty: bool = False):
        self.spark, self.sf_dir, self.root = spark, sf_dir, root.rstrip("/")
        self.reuse, self.skip_empty = reuse, skip_empty
        self.written: dict[str, str] = {}
        self.lineage: dict[str, set[str]] = {}
        self._asking: list[str] = []

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/{layer_of(name)}/{name}")

    def keep(self, spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
        """Stands in for the session's kept tables while a build runs."""
        if self._asking:
            self.lineage[self._asking[-1]].add(name)
        if name not in self.written:
            current = self.table(name).current_path() if self.reuse else None
            if current:
                self.written[name] = current
            else:
                self.make(name, build)
        return self.table(name).read()

    def make(self, name: str, build) -> None:
        self.lineage[name] = set()
        self._asking.append(name)
        df = build()
        self._asking.pop()
        read = paths_read(df)
        self.lineage[name] |= {t for t, path in self.written.items() if any(path in p for p in read)}
        self.written[name] = self.table(name).overwrite(df, skip_if_empty=self.skip_empty)

    def run(self, names: list) -> Build:
        queries = registry.queries()
        with tables.keeping(self.keep):
            for name in names:
                if name not in self.written:
                    self.make(name, lambda n=name: queries[n](self.spark, self.sf_dir))
        rows = [(t, r) for t, reads in self.lineage.items() for r in sorted(reads)]
        self.table("lineage").overwrite(self.spark.createDataFrame(rows, "name string, reads string"))
        return self


def build(spark: SparkSession, sf_dir: str, root: str, names=None, layer=None, family=None,
          skip_empty: bool = False, reuse: bool = False) -> dict:
    """Paths of the written jobs."""
    wanted = chosen(names, layer, family)
    done = Build(spark, sf_dir, root, reuse, skip_empty).run(wanted).written
    return {n: done[n] for n in wanted}
