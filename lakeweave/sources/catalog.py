"""Catalog tables that grow by appending (S25, S27) and persistent views over them.

A batch goes into its own partition, which a batch that is run again overwrites; files of other batches are neither
read nor written.  Columns that a batch brings along are added to the table (older rows read NULL),
columns that it lacks are NULL.  Views are created in the order in which their statements read each other,
taken from the parsed statements.
"""

from __future__ import annotations

from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "batch"


def _quoted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def append(df: DataFrame, name: str, batch: str, fetched_at, location: str | None = None) -> None:
    """Appends ``df`` to the catalog table as ``batch``, stamped with ``fetched_at``; creates it if absent.

    ``location``: folder of a new table (else the warehouse)."""
    spark, table = df.sparkSession, _quoted(name)
    rows = df.withColumn("fetched_at", F.lit(fetched_at).cast("timestamp"))
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE TABLE {table} ({columns}, `{BATCH}` string) USING parquet PARTITIONED BY (`{BATCH}`){place}")
    known = spark.table(name).schema
    new = [f for f in rows.schema if f.name not in known.names]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
        known = spark.table(name).schema
    cells = [F.lit(batch) if f.name == BATCH else (F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType) for f in known]
    kept = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        rows.select(*(c.alias(f.name) for c, f in zip(cells, known))).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", kept)


def relations(spark: SparkSession, statement: str) -> set[str]:
    """Names that a statement reads: the unresolved relations of its parsed plan, subqueries of WITH left out."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
    inner, found, todo = set(), set(), [plan]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "UnresolvedWith":
            for i in range(node.cteRelations().size()):
                pair = node.cteRelations().apply(i)
                inner.add(pair._1().lower())
                todo.append(pair._2())
        elif kind == "UnresolvedRelation":
            found.add(node.multipartIdentifier().mkString(".").lower())
        todo.extend(node.children().apply(i) for i in range(node.children().size()))
        expressions = [node.expressions().apply(i) for i in range(node.expressions().size())]
        while expressions:      # subqueries inside expressions
            e = expressions.pop()
            if e.getClass().getSimpleName() in ("ScalarSubquery", "Exists", "ListQuery"):
                todo.append(e.plan())
            expressions.extend(e.children().apply(i) for i in range(e.children().size()))
    return found - inner


def create_views(spark: SparkSession, views: dict[str, str]) -> list[str]:
    """Drops and creates the views, each after those it reads; returns the order.  Running it again gives the same views."""
    names = {v.lower(): v for v in views}
    reads = {v: {names[r] for r in relations(spark, statement) if r in names and names[r] != v} for v, statement in views.items()}
    order = list(TopologicalSorter(reads).static_order())
    for v in reversed(order):
        spark.sql(f"DROP VIEW IF EXISTS {_quoted(v)}")
    for v in order:
        spark.sql(f"CREATE VIEW {_quoted(v)} AS {views[v]}")
    return order
