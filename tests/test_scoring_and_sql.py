"""The scoring pass with scorers that fail, and the functions that SQL calls by name."""

import pandas as pd
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from lakeweave.functions import labels
from lakeweave.functions.sql import register_functions
from lakeweave.plans import scoring as S
from lakeweave.plans import sql_marts

UNITS = "review_id long, review_text string, model_used string"


def picky_scorer():
    def picky(units, attempt):
        if (units["review_text"] == "never").any():
            raise S.ScoringError(422, "no")
        if (units["review_text"] == "later").any() and attempt < 2:
            raise S.Transient(503, "wait")
        if (units["review_text"] == "down").any():
            raise S.Transient(500, "down")
        if (units["review_text"] == "bug").any():
            raise ZeroDivisionError("bug")
        return pd.DataFrame({"sentiment": units["review_text"].str.upper(), "confidence": 1.0})
    return picky    # defined here, so that it travels to the workers by value


def test_no_unit_is_lost_and_none_ends_the_job(spark):
    texts = ["fine", "later", "never", "down", "bug", None] * 20 + ["fine"]
    units = spark.createDataFrame([(i, t, "m") for i, t in enumerate(texts)], UNITS).repartition(3)
    got = {r["review_id"]: r for r in S.score(units, picky_scorer()).collect()}
    assert sorted(got) == list(range(len(texts)))
    want = {"fine": (True, 1, None), "later": (True, 3, None), "never": (False, 1, 422), "down": (False, 3, 500), "bug": (False, 1, None), None: (True, 1, None)}
    for i, t in enumerate(texts):
        assert (got[i]["ok"], got[i]["attempts"], got[i]["code_error"]) == want[t], t
    assert got[1]["sentiment"] == "LATER" and got[4]["error_text"] == "ZeroDivisionError: bug"
    short = S.score(units, lambda u, a: pd.DataFrame({"sentiment": ["x"], "confidence": [0.5]}))      # one row for many
    assert short.where("ok").count() == len(texts)
    assert S.score(units.limit(0), picky_scorer()).count() == 0


def test_a_pass_goes_on_where_it_was(spark, scratch):
    units = spark.createDataFrame([(i, "down" if i % 5 == 0 else "fine", "m") for i in range(40)], UNITS)
    runs = S.Runs(spark, scratch + "/runs")
    runs.score(units.where("review_id < 15"), picky_scorer(), run=0)
    assert runs.pending(units, 1).count() == 40 - 12
    calls = spark.sparkContext.accumulator(0)

    def counting(u, attempt):
        calls.add(len(u))
        return pd.DataFrame({"sentiment": ["ok"] * len(u), "confidence": 0.5})

    runs.score(units, counting, run=1)
    assert calls.value == 28                      # the twelve that were done are not asked again, the failed ones are
    got = runs.annotations()
    assert got.count() == 40 == got.select(*S.UNIT).distinct().count()
    assert runs.errors().count() == 3 and {r["run"] for r in runs.errors().collect()} == {0}
    runs.score(units, counting, run=1)            # the run again: its own folder anew, nothing twice
    assert runs.annotations().count() == 40


NAMES = ["Flacon de puissance", "Well Fed", "PIERRE DE SOINS", "potion", "Augment Rune", "rune d'augmentation", "Huile", "pierre à aiguiser", "Melee", "", None]


def test_sql_functions_say_what_the_columns_say(spark):
    register_functions(spark)
    df = spark.createDataFrame([(n, d, k, b) for n in NAMES for d in (None, 1, 2, 3, 4, 5) for k, b in ((None, 1), (0.0, 0), (7.0, 1))], "name string, difficulty int, keystone double, boss int")
    got = df.select(F.expr("consumable_type(name)").alias("a"), labels.consumable_type("name").alias("b"), F.expr("difficulty_label(difficulty, keystone)").alias("c"), labels.difficulty_label("difficulty", "keystone").alias("d"),
                    F.expr("content_type(keystone, boss)").alias("e"), labels.content_type("keystone", "boss").alias("f"))
    assert got.where("not (a <=> b and c <=> d and e <=> f)").count() == 0
    assert got.select("a").distinct().count() == 7


def test_functions_are_inlined_and_links_are_lateral(spark):
    sql_marts._over_silver(sql_marts.DEATHS)(spark, SF_SMALL)
    plan = spark.sql(sql_marts.DEATHS)._jdf.queryExecution().optimizedPlan().toString()
    assert "difficulty_label(" not in plan and "Cartesian" not in plan
    spark.createDataFrame([(1, "<a href='/x'>X <b>y</b></a><a>no</a><a href=''>empty</a><a href='/x'>again</a>"), (2, None)], "page_id long, html string").createOrReplaceTempView("some_pages")
    got = [tuple(r) for r in spark.sql("SELECT page_id, l.* FROM some_pages, LATERAL page_links(html) l ORDER BY pos").collect()]
    assert got == [(1, 0, "/x", "Xy"), (1, 1, "/x", "again")]


@pytest.mark.parametrize("name", ["sql_roster_matches"])
def test_the_match_is_one_equi_join(spark, name):
    plan = sql_marts.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_qc_document_is_one_row(spark):
    import json

    doc = sql_marts.qc_report(spark, SF_SMALL).collect()
    assert len(doc) == 1
    d = json.loads(doc[0]["report"])
    assert [f["fichier"] for f in d["fichiers"]] == [1, 2] and d["postgres"]["lignes"] > 0 and d["verdict"] in ("source", "ingestion")
