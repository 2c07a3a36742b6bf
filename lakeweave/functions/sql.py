"""SQL function surface (D1): the shared rules as functions that Spark SQL calls by name.

Scalar rules and the guild flags (a table function over the silver views) are SQL functions, which the
optimizer inlines; ``page_links`` is a Python table function for LATERAL use.  The fixed values come from
``labels``, so both surfaces say the same.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .labels import CONSUMABLE_PATTERNS, DIFFICULTY_LABELS


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _keys(guid: str, character: str, name: str, condition: str) -> str:
    """The keys by which a row is found in the roster, with their priority; one equi-join on them replaces an OR of four."""
    named = f"CASE WHEN {name} <> '' THEN concat(lower(trim({name})), '\\u0001', lower(trim(server))) END"
    return (f"filter(array(named_struct('prio', 1, 'k', concat('guid:', {guid})), named_struct('prio', 2, 'k', concat('canonical:', {guid})), "
            f"named_struct('prio', 3, 'k', CASE WHEN {condition} THEN concat('character:', {character}) END), named_struct('prio', 4, 'k', concat('name:', {named}))), x -> x.k IS NOT NULL)")


KEYS = "ARRAY<STRUCT<prio: INT, k: STRING>>"
# name, parameters, result, body
FUNCTIONS = [
    ("consumable_type", "name STRING", "STRING", "CASE " + " ".join(f"WHEN coalesce(name, '') RLIKE {_text(p)} THEN {_text(label)}" for label, p in CONSUMABLE_PATTERNS) + " ELSE '' END"),
    ("difficulty_label", "difficulty INT, keystone DOUBLE", "STRING",
     "CASE WHEN coalesce(keystone, 0) > 0 THEN 'Mythic+' " + " ".join(f"WHEN difficulty = {d} THEN {_text(label)}" for d, label in DIFFICULTY_LABELS.items()) + " WHEN difficulty IS NOT NULL THEN concat('diff_', difficulty) ELSE 'Unknown' END"),
    ("content_type", "keystone DOUBLE, is_boss INT", "STRING", "CASE WHEN coalesce(keystone, 0) > 0 THEN 'mythic_plus' WHEN is_boss = 1 THEN 'raid' ELSE 'trash' END"),
    ("actor_roster_keys", "guid BIGINT, actor_id INT, actor_type STRING, player_name STRING, server STRING", KEYS, _keys("guid", "actor_id", "player_name", "actor_type = 'Player'")),
    ("player_roster_keys", "guid BIGINT, actor_id INT, player_name STRING, server STRING", KEYS, _keys("guid", "actor_id", "player_name", "true")),
    ("member_keys", "guid BIGINT, canonical BIGINT, character_id BIGINT, name STRING, server STRING", KEYS,
     "filter(array(named_struct('prio', 1, 'k', concat('guid:', guid)), named_struct('prio', 2, 'k', concat('canonical:', canonical)), named_struct('prio', 3, 'k', concat('character:', character_id)), "
     "named_struct('prio', 4, 'k', concat('name:', lower(trim(name)), '\\u0001', lower(trim(server))))), x -> x.k IS NOT NULL)"),
]
GUILD_FLAGS = """
SELECT report_code, player_name, max(g) AS is_guild_member, min(CASE WHEN g = 1 THEN gn END) AS player_guild_name,
    min(CASE WHEN g = 1 THEN rn END) AS roster_character_name, min(nullif(ro, '')) AS role
FROM (SELECT report_code, player_name, is_guild_member AS g, player_guild_name AS gn, roster_character_name AS rn, role AS ro FROM silver_player_details
      UNION ALL SELECT report_code, resolved_player_name, is_guild_member, player_guild_name, roster_character_name, CAST(NULL AS STRING) FROM silver_actors
      WHERE resolved_actor_type = 'Player' AND resolved_player_name <> '')
GROUP BY report_code, player_name"""


@F.udtf(returnType="pos int, href string, label string")
class PageLinks:
    """Links of a page in page order."""

    def eval(self, html: str):
        from ..sources.records import tree

        for pos, a in enumerate(a for a in tree(html or "").all("a") if a.attrs.get("href")):
            yield pos, a.attrs["href"], a.text()


def register_functions(spark: SparkSession) -> list[str]:
    """Registers every function in the session; the table function over guild flags reads the views
    ``silver_player_details`` and ``silver_actors`` when it is called."""
    for name, parameters, result, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    spark.udtf.register("page_links", PageLinks)
    return [f[0] for f in FUNCTIONS] + ["page_links"]


def register_guild_flags(spark: SparkSession) -> None:
    """``guild_flags()``: one row per (report, player); its views have to be there."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION guild_flags() RETURNS TABLE(report_code STRING, player_name STRING, is_guild_member INT, "
              f"player_guild_name STRING, roster_character_name STRING, role STRING) RETURN {GUILD_FLAGS}")
