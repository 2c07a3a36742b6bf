"""Scoring units (review x model) with a user's scorer that may fail.

A batch is scored at once.  A scorer says which of its units failed by a column ``failure`` (an exception, None
for the others): those with a ``Transient`` one are asked again together, up to ``attempts`` times.  Where a
scorer raises, it is not known for which unit, and each of the batch is tried by itself in the same way.  What
still fails becomes an error row, so no unit is lost and none ends the job.  Results are stored per run; a later run scores only units
without an annotation, so a pass that was cut off goes on where it was, and no unit is annotated twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.incremental import scratch_root
from . import reviews as R

ATTEMPTS = 3
UNIT = ["review_id", "model_used"]
RESULT = "review_id long, model_used string, ok boolean, sentiment string, confidence double, attempts int, code_error int, error_text string"

#: (units, attempt from 0) -> sentiment and confidence, and failure if there may be any, a row per unit in order
Scorer = Callable[[pd.DataFrame, int], pd.DataFrame]


class ScoringError(Exception):
    """A failure with the code that the model's service gave."""

    def __init__(self, code: int, text: str = ""):
        super().__init__(text)
        self.code = code


class Transient(ScoringError):
    """A failure that may pass: worth another attempt."""


def _rows(units: pd.DataFrame, scored: pd.DataFrame, attempts: int) -> pd.DataFrame:
    if len(scored) != len(units):
        raise ScoringError(0, "the scorer gave another number of rows")
    out = units[UNIT].reset_index(drop=True)
    failure = scored["failure"].to_numpy() if "failure" in scored else None
    out = out.assign(ok=True, sentiment=scored["sentiment"].to_numpy(), confidence=scored["confidence"].to_numpy(), attempts=attempts, code_error=None, error_text=None)
    if failure is not None and (failed := np.array([isinstance(e, Exception) for e in failure], dtype=bool)).any():
        out["ok"] = ~failed
        out["sentiment"] = out["sentiment"].astype(object).where(~failed, None)
        out["confidence"] = out["confidence"].where(~failed)
        out["code_error"] = pd.array([getattr(e, "code", None) if f else None for e, f in zip(failure, failed)], dtype="Int32")
        out["error_text"] = [_said(e) if f else None for e, f in zip(failure, failed)]
        out["_again"] = [isinstance(e, Transient) for e in failure]
    return out


def _said(error: Exception | None) -> str:
    return f"{type(error).__name__}: {error}"


def _rounds(units: pd.DataFrame, scorer: Scorer, attempts: int, columns: list[str]) -> Iterator[pd.DataFrame]:
    """The units that the scorer answers, or fails for good, round by round; every round asks at once for all that may still pass."""
    for tried in range(1, attempts + 1):
        try:
            rows = _rows(units, scorer(units, tried - 1), tried)
        except Exception:  # noqa: BLE001 - it isn't known which unit it was: each by itself
            rows = [_one(units.iloc[[k]], scorer, attempts, tried - 1) for k in range(len(units))]
            yield pd.DataFrame(rows, columns=columns).astype({"code_error": "Int32", "confidence": "float64"})
            return
        again = rows["_again"].to_numpy(dtype=bool) if "_again" in rows and tried < attempts else np.zeros(len(rows), dtype=bool)
        yield rows[~again][columns]
        units = units[again]
        if not len(units):
            return


def _one(unit: pd.DataFrame, scorer: Scorer, attempts: int, tried: int = 0) -> dict:
    error = None
    while tried < attempts:
        tried += 1
        try:
            row = _rows(unit, scorer(unit, tried - 1), tried).iloc[0].to_dict()
            if not row.pop("_again", False) or tried == attempts:
                return row
        except Transient as e:
            error = e
        except Exception as e:  # noqa: BLE001 - any failure of the user's scorer is a row, not the end of the job
            error = e
            break
    return {**unit[UNIT].iloc[0].to_dict(), "ok": False, "attempts": tried, "code_error": getattr(error, "code", None), "error_text": _said(error)}


def score(units: DataFrame, scorer: Scorer, attempts: int = ATTEMPTS) -> DataFrame:
    """A row per unit: its annotation, or why there is none."""
    columns = [c.split()[0] for c in RESULT.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield from _rounds(batch, scorer, attempts, columns)
    return units.mapInPandas(run, RESULT)


class Runs:
    """Stored results, a folder per run; a run that is repeated overwrites its own."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        spark.createDataFrame([], f"{RESULT}, run int").write.mode("append").partitionBy("run").parquet(self.root)

    def read(self) -> DataFrame:
        return self.spark.read.schema(f"{RESULT}, run int").parquet(self.root)

    def pending(self, units: DataFrame, run: int) -> DataFrame:
        """Units that no earlier run has annotated: those never tried and those that failed."""
        done = self.read().where((F.col("run") < run) & F.col("ok")).select(*UNIT)
        return units.join(done, UNIT, "left_anti")

    def score(self, units: DataFrame, scorer: Scorer, run: int, attempts: int = ATTEMPTS) -> None:
        scored = score(self.pending(units, run), scorer, attempts)
        scored.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(self.root)

    def annotations(self) -> DataFrame:
        return self.read().where("ok")

    def errors(self) -> DataFrame:
        """Every failure of every run."""
        return self.read().where("not ok")


def rule_scorer(units: pd.DataFrame, attempt: int) -> pd.DataFrame:
    """A model in the place of a service: sentiment by the share of long words.  It has no answer for texts
    under five words, some units answer only when asked again, and one model is down for some reviews."""
    place = units["model_used"].map({m: i for i, m in enumerate(R.MODELS)})
    number = units["review_id"] * 3 + place
    # a text's words are counted once, however many models are asked about it
    counts = {t: (sum(len(x) > 5 for x in w), len(w)) for t in units["review_text"].fillna("").unique() for w in [t.split()]}
    long, words = (np.array(c) for c in zip(*units["review_text"].fillna("").map(counts)))
    failure = pd.Series(None, index=units.index, dtype=object)
    short, down, busy = words < 5, (number % 11 == 0) & (place == 0), (attempt < 1) & (number % 7 == 0)
    for where, error in ((busy, Transient(429, "too many requests")), (down, Transient(503, "model is down")), (short, ScoringError(422, "text too short"))):
        failure[where] = error
    share = long / np.maximum(words, 1) + place / 100
    return pd.DataFrame({"sentiment": np.where(share > 0.4, "positif", np.where(share < 0.25, "negatif", "neutre")), "confidence": share.round(6), "failure": failure})


def _scored(spark: SparkSession, sf_dir: str) -> Runs:
    """A pass that was cut off (it saw half of the reviews), then one over everything."""
    runs = Runs(spark, scratch_root(spark, "scoring"))
    units = R.pending_units(R.sentiment_source(spark, sf_dir), None).select("review_id", "review_text", "model_used")
    runs.score(units.where("review_id % 2 = 0"), rule_scorer, run=0)
    runs.score(units, rule_scorer, run=1)
    return runs


def score_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).annotations().select("review_id", "model_used", "sentiment", F.round("confidence", 4).alias("confidence"), "run")


def score_reviews_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).errors().groupBy("model_used", "run", "code_error", "attempts").agg(F.count(F.lit(1)).alias("units"))


QUERIES = {"score_reviews": score_reviews, "score_reviews_errors": score_reviews_errors}
