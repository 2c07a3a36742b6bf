"""DuckDB oracle for the schema tests: each mart's oracle wrapped as a subquery."""

from .oracle_combat import ORACLES as COMBAT
from .oracle_combat import W
from .oracle_reference import ORACLES as REFERENCE
from .quality_jobs import SCHEMA_TESTS

_SQL = {"sales_daily_kpis": REFERENCE["sales_daily_kpis"], **{k: v for k, v in COMBAT.items()
                                                               if k in SCHEMA_TESTS}}


def _checks() -> str:
    parts = []
    for model, tests in SCHEMA_TESTS.items():
        src = f"({_SQL[model]}) t"
        for col in tests["not_null"]:
            parts.append(f"SELECT 'not_null' AS test, '{model}' AS model, '{col}' AS column_name, "
                         f"CAST(count(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS failures FROM {src}")
        if "unique" in tests:
            keys = ", ".join(tests["unique"])
            parts.append(f"SELECT 'unique', '{model}', '{','.join(tests['unique'])}', "
                         f"CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) FROM "
                         f"(SELECT {keys}, count(*) AS n FROM {src} GROUP BY {keys})")
        if "accepted_values" in tests:
            col, values = tests["accepted_values"]
            vals = ", ".join(f"'{v}'" for v in values)
            parts.append(f"SELECT 'accepted_values', '{model}', '{col}', CAST(count(*) FILTER "
                         f"(WHERE {col} IS NOT NULL AND {col} NOT IN ({vals})) AS BIGINT) FROM {src}")
        parts.append(f"SELECT 'not_empty', '{model}', '*', CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) "
                     f"FROM {src}")
    return "\nUNION ALL\n".join(parts)


ORACLES = {"gold_schema_tests": _checks()}


def _orphans(model, child, parent, keys):
    on = " AND ".join(f"p.{k} = c.{k}" for k in keys)
    some = " AND ".join(f"c.{k} IS NOT NULL" for k in keys)
    return (f"SELECT 'relationships' AS test, '{model}' AS model, '{','.join(keys)}' AS column_name, CAST(count(*) AS BIGINT) AS failures FROM ({child}) c "
            f"WHERE {some} AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {on})")


_FIGHT = ["report_code", "fight_id"]
ORACLES["lake_foreign_keys"] = W + " " + " UNION ALL ".join([
    _orphans("fights", "SELECT * FROM s_fights", "s_reports", ["report_code"]),
    _orphans("events", "SELECT * FROM s_events", "s_fights", _FIGHT),
    _orphans("event_sources", "SELECT report_code, source_id AS actor_id FROM s_events", "s_actors", ["report_code", "actor_id"]),
    _orphans("pet_owners", "SELECT report_code, pet_owner_id AS actor_id FROM s_actors", "s_actors", ["report_code", "actor_id"]),
    _orphans("pull_combatants", "SELECT * FROM s_pull_combatants", "s_fights", _FIGHT)])
