"""File sources/sinks round trips and the table build runner."""

import glob
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakeweave.plans import climate, retail
from lakeweave.plans.build import Build, build
from lakeweave.sources import fixtures as fx
from lakeweave.sources.files import (export_csv_tables, export_json, land_parquet, read_all_string_csv,
                                     read_semicolon_gz)
from lakeweave.sources.sinks import VersionedTable


def test_multi_part_csv_to_clean_orders(spark, scratch):
    raw = fx.retail_lines(spark, SF_SMALL)
    a = raw.filter(F.col("stock_code").cast("int") % 2 == 0)
    b = raw.filter(F.col("stock_code").cast("int") % 2 == 1).drop("country")   # second sheet lacks a column
    a.write.option("header", True).csv(scratch + "/p1")
    b.write.option("header", True).csv(scratch + "/p2")
    back = read_all_string_csv(spark, [scratch + "/p1", scratch + "/p2"])
    assert set(back.columns) == set(raw.columns)
    assert back.count() == raw.count()
    assert back.filter(F.col("country").isNull()).count() == b.count()
    full = read_all_string_csv(spark, [scratch + "/p1"]).unionByName(b.withColumn("country", F.lit(None)))
    assert retail.clean_orders(full.select(*retail.RAW_COLUMNS)).count() > 0


def test_semicolon_gz_files_to_curated_climate(spark, scratch):
    raw = fx.climate_raw(spark, SF_SMALL)
    cols = [c for c in raw.columns if c != "_file"]
    for f in (1, 2):
        (raw.filter(F.col("_file") == f).select(*cols).write.option("sep", ";").option("header", True)
            .option("compression", "gzip").csv(f"{scratch}/file{f}"))
    parts = [read_semicolon_gz(spark, [f"{scratch}/file{f}"]).withColumn("_file", F.lit(f)) for f in (1, 2)]
    back = parts[0].unionByName(parts[1])
    curated = climate.keep_last_rows(climate.curate(back), climate.KEY, ["_file"]).drop("_file")
    expected = climate.climat_data(spark, SF_SMALL)
    assert curated.count() == expected.count()
    assert curated.exceptAll(expected.select(*curated.columns)).count() == 0


def test_exports_and_landing(spark, scratch):
    qc = climate.qc_files(fx.climate_raw(spark, SF_SMALL))
    export_json(qc, scratch + "/qc.json")
    assert spark.read.json(scratch + "/qc.json").count() == 2
    written = export_csv_tables({"a": qc, "empty": qc.limit(0)}, scratch + "/csv")
    assert written == ["a"] and not os.path.exists(scratch + "/csv/empty")
    land_parquet(qc, scratch + "/landed", partitions=1)
    assert spark.read.parquet(scratch + "/landed").count() == 2


def test_build_follows_what_jobs_read_and_replays(spark, scratch):
    names = ["corpus_boss_attempts", "gold_deaths", "combat_silver_fights"]
    first = Build(spark, SF_SMALL, scratch).run(names)
    order = list(first.written)
    assert set(names) <= set(order)
    for name, reads in first.lineage.items():
        assert all(order.index(r) < order.index(name) for r in reads), name
    assert {"silver_events", "silver_actors", "bronze-fights"} <= first.lineage["gold_deaths"] and "bronze-events" in first.lineage["silver_events"]
    again = Build(spark, SF_SMALL, scratch).run(names)
    assert again.lineage == first.lineage and again.written != first.written
    assert VersionedTable(spark, scratch + "/gold/gold_deaths").read().count() > 0
    assert VersionedTable(spark, scratch + "/gold/lineage").read().where("name = 'gold_deaths'").count() == len(first.lineage["gold_deaths"])


def test_a_changed_silver_table_changes_gold_on_rebuild(spark, scratch):
    build(spark, SF_SMALL, scratch, names=["gold_deaths"])
    gold, silver = VersionedTable(spark, scratch + "/gold/gold_deaths"), VersionedTable(spark, scratch + "/silver/silver_events")
    before = gold.read().count()
    few = silver.read().where("timestamp_ms % 2 = 0")
    want = few.where("event_type = 'death'").count()
    silver.overwrite(few)
    build(spark, SF_SMALL, scratch, names=["gold_deaths"], reuse=True)
    assert 0 < gold.read().count() < before and gold.read().count() <= want
    build(spark, SF_SMALL, scratch, names=["gold_deaths"])   # without reuse silver comes from bronze again
    assert gold.read().count() == before


def test_kept_tables_follow_the_input(spark, scratch):
    from lakeweave.sources.tables import kept

    folder = scratch + "/in"
    build_one = lambda: spark.read.parquet(folder + "/t.parquet")
    spark.range(3).write.parquet(folder + "/t.parquet")
    assert kept(spark, folder, "t", build_one).count() == 3
    spark.range(5).write.mode("append").parquet(folder + "/t.parquet")
    assert kept(spark, folder, "t", build_one).count() == 8


def test_catalog_table_grows_without_rewriting(spark, scratch):
    from lakeweave.sources.catalog import append

    name, place = "grown_" + os.path.basename(scratch).replace("-", "_").lower(), scratch + "/grown"
    files = lambda: {f: os.path.getmtime(f) for f in glob.glob(place + "/**/*.parquet", recursive=True)}
    append(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), name, "b1", "2024-01-01 00:00:00", place)
    first = files()
    append(spark.createDataFrame([(3, 7.5)], "k int, score double"), name, "b2", "2024-01-02 00:00:00")       # a new column, and one that is missing
    append(spark.createDataFrame([(4, "d", 1.0)], "k long, v string, score double"), name, "b3", "2024-01-03 00:00:00")
    grown = files()
    assert first.items() <= grown.items() and len(grown) > len(first)
    rows = lambda: sorted((r["k"], r["v"], r["score"], r["batch"], str(r["fetched_at"])[:10]) for r in spark.table(name).collect())
    want = [(1, "a", None, "b1", "2024-01-01"), (2, "b", None, "b1", "2024-01-01"), (3, None, 7.5, "b2", "2024-01-02"), (4, "d", 1.0, "b3", "2024-01-03")]
    assert rows() == want
    append(spark.createDataFrame([(3, 7.5)], "k int, score double"), name, "b2", "2024-01-02 00:00:00")       # the batch again
    assert rows() == want and first.items() <= files().items()
    spark.sql(f"DROP TABLE {name}")


def test_views_are_created_after_what_they_read(spark, scratch):
    from lakeweave.sources.catalog import append, create_views, relations

    tag = os.path.basename(scratch).replace("-", "_").lower()
    append(spark.range(10).withColumnRenamed("id", "k"), f"base_{tag}", "b", "2024-01-01 00:00:00", scratch + "/base")
    views = {f"a_{tag}": f"SELECT count(*) AS n FROM z_{tag}", f"z_{tag}": f"WITH w AS (SELECT k FROM base_{tag}) SELECT k FROM w WHERE k > (SELECT min(k) FROM w)"}
    assert relations(spark, views[f"z_{tag}"]) == {f"base_{tag}"}
    for _ in range(2):
        assert create_views(spark, views) == [f"z_{tag}", f"a_{tag}"]
    assert spark.table(f"a_{tag}").first()["n"] == 9
    append(spark.range(20, 25).withColumnRenamed("id", "k"), f"base_{tag}", "c", "2024-01-02 00:00:00")
    assert spark.table(f"a_{tag}").first()["n"] == 14       # a view, not a copy
    for v in reversed(list(views)):
        spark.sql(f"DROP VIEW {v}")
    spark.sql(f"DROP TABLE base_{tag}")


def test_required_columns_and_renames(spark):
    """Workbook headers renamed, missing expected columns listed in the error."""
    import pytest

    df = spark.createDataFrame([("1", "A", "x", "2", "2024-01-01", "1.5", "7", "FR")],
                               "Invoice string, StockCode string, Description string, Quantity string, "
                               "InvoiceDate string, Price string, `Customer ID` string, Country string")
    out = retail.normalize_raw(df)
    assert out.columns == retail.RAW_COLUMNS
    with pytest.raises(KeyError, match="customer_id"):
        retail.normalize_raw(df.drop("Customer ID"))


def test_reference_refresh_items_only(spark, scratch):
    """Refresh only the item tables of the reference family, in layer order."""
    names = ["reference_items", "reference_gift_themes", "reference_items_by_category"]
    written = build(spark, SF_SMALL, scratch, names=names)
    assert set(written) == set(names)
    assert not os.path.exists(scratch + "/silver/reference_species")
