"""F5 — reference records normalised to 3NF, label matching, sales mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import label_match
from ..operators.quality import ratio_round
from ..sources import fixtures as fx
from ..sources import records
from ..sources.tables import read

REQUIRED_ITEM_COLUMNS = {"favorite_category", "chair_item", "medium_item", "small_item"}
# FIXED VALUES: CSV column -> item type, and item type -> category
ITEM_CSV_COLUMNS = [("chair_item", "chair"), ("medium_item", "medium"), ("small_item", "small")]
ITEM_TYPES = [("chair", "relaxation"), ("medium", "decoration"), ("small", "tot")]


def _pystrip(c):
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def item_tables(rows: DataFrame):
    """Header check, then themes (first seen), items (3 columns unpivoted, blanks skipped)."""
    missing = REQUIRED_ITEM_COLUMNS - set(rows.columns)
    if missing:
        raise ValueError(f"unexpected items header, missing {sorted(missing)}")
    r = rows.withColumn("theme", _pystrip(F.coalesce("favorite_category", F.lit("")))).filter(F.col("theme") != "")
    stack = F.array(*[F.struct(F.lit(t).alias("type_valeur"), F.col(c).alias("name"), F.lit(i).alias("slot"))
                      for i, (c, t) in enumerate(ITEM_CSV_COLUMNS)])
    items = (r.select("row_no", "theme", F.explode(stack).alias("s"))
              .select("row_no", F.col("theme").alias("gift_theme_valeur"),
                      _pystrip(F.coalesce(F.col("s.name"), F.lit(""))).alias("name"), "s.type_valeur", "s.slot")
              .filter(F.col("name") != ""))
    themes = r.groupBy(F.col("theme").alias("valeur")).agg(F.min("row_no").alias("first_row"))
    return themes, items


def item_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ITEM_TYPES, "valeur string, category_valeur string")


def items_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item -> type -> category (the type table is a fixed 3-row dimension)."""
    _, items = item_tables(fx.items_csv_rows(spark, sf_dir))
    j = items.join(F.broadcast(item_types(spark)), items.type_valeur == F.col("valeur"))
    return j.groupBy("category_valeur", "type_valeur").agg(F.count(F.lit(1)).alias("nb_items"),
                                                           F.count_distinct("name").alias("nb_noms"))


def items_by_theme(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, items = item_tables(fx.items_csv_rows(spark, sf_dir))
    return items.groupBy("gift_theme_valeur").agg(
        F.count(F.lit(1)).alias("nb_items"),
        F.array_join(F.array_sort(F.collect_set("type_valeur")), ",").alias("types"))


def species_tables(spark: SparkSession, sf_dir: str) -> dict:
    """Nested records -> species, value tables, and ordered link tables."""
    s = fx.species_records(spark, sf_dir)
    species = s.select("nom", "num", F.nullif(F.col("ideal_habitat"), F.lit("")).alias("ideal_habitat_valeur"))
    spec_links = s.select("nom", F.posexplode("specialties").alias("p", "v")).select(
        F.col("nom").alias("species_nom"), F.col("v").alias("specialty_valeur"), (F.col("p") + 1).alias("ordre"))
    fav_links = s.select("nom", F.posexplode("favorites").alias("p", "v")).select(
        F.col("nom").alias("species_nom"), F.col("v").alias("favorite_valeur"), (F.col("p") + 1).alias("ordre"))
    specialties = spec_links.select(F.col("specialty_valeur").alias("valeur")).distinct()
    habitats = species.select(F.col("ideal_habitat_valeur").alias("valeur")).dropna().distinct()
    favorites = fav_links.select(F.col("favorite_valeur").alias("valeur")).distinct()
    return {"species": species, "specialty": specialties, "ideal_habitat": habitats, "favorite": favorites,
            "species_specialty": spec_links, "species_favorite": fav_links}


def match_favorites_to_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Favorite label -> gift theme by candidate keys in priority order."""
    favs = species_tables(spark, sf_dir)["favorite"].select(F.col("valeur").alias("label"))
    themes, _ = item_tables(fx.items_csv_rows(spark, sf_dir))
    themes = themes.select(F.col("valeur").alias("theme"))
    s = _pystrip(F.col("label"))
    lo = F.lower(s)
    tail = F.regexp_extract(s, r"(?i)^lots\s+of\s+(.+)$", 1)
    collapse = lambda c: F.lower(F.array_join(F.split(_pystrip(c), r"\s+"), " "))
    base = _pystrip(F.substring(lo, F.lit(1), F.length(lo) - 6))
    stuff = F.when(lo.endswith(" stuff"), F.concat(base, F.lit(" stuff")))
    cands = [lo, F.when(tail != "", F.lower(_pystrip(tail))), F.when(tail != "", collapse(tail)),
             collapse(s), stuff]
    return label_match(favs, "label", themes, "theme", cands, ["theme"])


def theme_items(items: DataFrame) -> DataFrame:
    """One row per theme: its item of each category, of the last row that names one."""
    last = lambda kind: F.max_by(F.when(F.col("type_valeur") == kind, F.col("name")), F.when(F.col("type_valeur") == kind, F.struct("row_no", "name")))
    return items.groupBy(F.col("gift_theme_valeur").alias("theme")).agg(*(last(kind).alias(category) for kind, category in ITEM_TYPES))


def favorites_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every species with its favorites in order, the theme each stands for, and that theme's items by category."""
    likes = species_tables(spark, sf_dir)["species_favorite"]
    themes = match_favorites_to_themes(spark, sf_dir).select(F.col("label").alias("favorite_valeur"), "theme")
    items = theme_items(item_tables(fx.items_csv_rows(spark, sf_dir))[1])
    return likes.join(themes, "favorite_valeur", "left").join(items, "theme", "left").select("species_nom", "ordre", "favorite_valeur", "theme", *(c for _, c in ITEM_TYPES))


def _joined(records: DataFrame) -> DataFrame:
    """Arrays as printed: one string each."""
    return records.select(*[F.array_join(f.name, "|").alias(f.name) if f.dataType.simpleString() == "array<string>" else F.col(f.name) for f in records.schema])


def species_specialties(spark, sf):
    return species_tables(spark, sf)["species_specialty"]


# ------------------------------------------------------------------ sales mart
def silver_sales(lines: DataFrame) -> DataFrame:
    return lines.select(F.to_date("event_date").alias("event_date"), "region", "product",
                        F.col("quantity").cast("int").alias("quantity"),
                        F.col("unit_price").cast("double").alias("unit_price"),
                        (F.col("quantity").cast("double") * F.col("unit_price").cast("double")).alias("revenue"))


def sales_daily_kpis(silver: DataFrame) -> DataFrame:
    """Day x region KPIs; money totals rounded exactly on cents (integer arithmetic)."""
    cents = F.round(F.col("unit_price") * 100).cast("bigint")
    return silver.groupBy("event_date", "region").agg(
        F.count(F.lit(1)).alias("nb_lignes"), F.sum("quantity").alias("total_quantity"),
        ratio_round(F.sum(F.col("quantity").cast("bigint") * cents), F.lit(100), 2).alias("total_revenue"),
        ratio_round(F.sum(cents), F.count(F.lit(1)) * 100, 2).alias("avg_unit_price"))


QUERIES = {
    "reference_items": lambda s, d: item_tables(fx.items_csv_rows(s, d))[1],
    "reference_gift_themes": lambda s, d: item_tables(fx.items_csv_rows(s, d))[0],
    "reference_items_by_category": items_by_category,
    "reference_items_by_theme": items_by_theme,
    "reference_species": lambda s, d: species_tables(s, d)["species"],
    "reference_specialties": lambda s, d: species_tables(s, d)["specialty"],
    "reference_ideal_habitats": lambda s, d: species_tables(s, d)["ideal_habitat"],
    "reference_favorites": lambda s, d: species_tables(s, d)["favorite"],
    "reference_species_specialties": species_specialties,
    "reference_species_favorites": lambda s, d: species_tables(s, d)["species_favorite"],
    "reference_favorite_themes": match_favorites_to_themes,
    "reference_theme_items": lambda s, d: theme_items(item_tables(fx.items_csv_rows(s, d))[1]),
    "reference_favorites_matrix": favorites_matrix,
    "reference_detail_records": lambda s, d: _joined(records.detail_records(fx.detail_pages(s, d))),
    "reference_list_slugs": lambda s, d: _joined(records.listed_slugs(fx.list_pages(s, d))),
    "pages_records": lambda s, d: _joined(records.page_records(read(s, d, "pages"))),
    "sales_silver": lambda s, d: silver_sales(fx.sales_lines(s, d)),
    "sales_daily_kpis": lambda s, d: sales_daily_kpis(silver_sales(fx.sales_lines(s, d))),
}
