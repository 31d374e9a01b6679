"""Train, evaluate, record and score the churn model."""

import uuid
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig, RunResult
from ..operators import churn, gold
from ..sinks.tables import append_merge, register_catalog, write_table
from ..sources.tables import read_table
from .runs import audited

RUNS = (
    "run_id string, model_type string, num_trees int, max_depth int, train_rows bigint, test_rows bigint,"
    " features int, label string, auc double, accuracy double, f1_score double, importances map<string,double>,"
    " model_path string, run_dttm timestamp"
)


def track_run(spark: SparkSession, path: str, run: dict) -> None:
    """Append one row on a training run to the table of runs."""
    names = [part.split()[0] for part in RUNS.split(", ")]
    append_merge(spark.createDataFrame([tuple(run[n] for n in names)], RUNS), path)


def train_and_score(
    spark: SparkSession, features: DataFrame, base: str, trees: int = churn.TREES, depth: int = churn.DEPTH
) -> RunResult:
    """Store the features once, then fit, evaluate, record and score from them."""
    write_table(features, f"{base}/work/churn_features")
    stored = read_table(spark, base, "work", "churn_features")
    train, test = churn.split(stored)
    model = churn.fit(train, trees=trees, depth=depth)
    run_id = uuid.uuid4().hex
    model_path = f"{base}/models/{run_id}"
    model.write().overwrite().save(model_path)
    # A fresh model carries its training summary, and with it the session, which
    # cannot be sent to tasks once the session has observed a frame.
    model = load_model(model_path)
    predicted = model.transform(test).select("label", "rawPrediction", "prediction").persist()
    metrics = churn.evaluate(predicted)
    predicted.unpersist()
    sizes = stored.agg(F.count("*").alias("n")).first()["n"], train.count()
    track_run(
        spark,
        f"{base}/gold/model_runs",
        {
            "run_id": run_id,
            "model_type": "RandomForestClassifier",
            "num_trees": trees,
            "max_depth": depth,
            "train_rows": sizes[1],
            "test_rows": sizes[0] - sizes[1],
            "features": len(churn.FEATURES),
            "label": "churn_risk_binary",
            **metrics,
            "importances": churn.importances(model),
            "model_path": model_path,
            "run_dttm": datetime.now(timezone.utc),
        },
    )
    rows = write_table(churn.score(model, stored, run_id=run_id), f"{base}/gold/churn_scores")
    return RunResult(
        rows_written={"churn_scores": rows},
        detail={"run_id": run_id, "model_path": model_path, **metrics},
    )


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def run_churn(spark: SparkSession, cfg: RunConfig) -> RunResult:
    """The job over stored Silver tables and the stored usage rollup, with its audit row and catalog entry."""
    with audited(spark, cfg.path("control", "audit"), "churn", debug=cfg.debug) as run:
        customers = read_table(spark, cfg.base, cfg.sink_folder, "customers")
        recharges = read_table(spark, cfg.base, cfg.sink_folder, "recharges")
        usage = read_table(spark, cfg.base, "work", "usage_daily")
        done = train_and_score(spark, gold.churn_features(customers, usage, recharges), cfg.base)
        run.rows_written |= done.rows_written
        run.detail |= done.detail
        if cfg.database:
            register_catalog(spark, cfg.database, cfg.base, ["churn_scores"])
    return run
