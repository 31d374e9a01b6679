import random

import frames
import pytest
from pyspark.sql import functions as F

from cdrlake.config import RunConfig
from cdrlake.operators import churn, gold, views
from cdrlake.plans.batch import run_batch
from cdrlake.plans.churn_job import load_model, run_churn, train_and_score
from cdrlake.plans.serving import register_serving_views
from cdrlake.sinks import tables as sinks
from cdrlake.sinks.tables import read_merged
from cdrlake.sources.tables import read_table


@pytest.fixture(scope="module")
def features(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        tenure = rng.randint(1, 60)
        rows.append(
            tuple([f"C{i:03d}", int(tenure < 15 or rng.random() < 0.1), tenure] + [float(rng.randint(0, 9)) for _ in churn.FEATURES[1:]])
        )
    kinds = ", ".join(f"{c} double" for c in churn.FEATURES[1:])
    df = spark.createDataFrame(rows, f"customer_id string, label int, tenure_months int, {kinds}")
    return df.withColumn("monthly_fee_qar", F.when(F.col("customer_id") != "C007", F.col("monthly_fee_qar")))


@pytest.fixture(scope="module")
def run(spark, features, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("churn"))
    return base, train_and_score(spark, features, base, trees=10, depth=4)


def test_split_is_stable_and_complete(features, rows):
    train, test = churn.split(features)
    again, _ = churn.split(features.repartition(7))
    assert rows(train, "customer_id") == rows(again, "customer_id")
    assert train.count() + test.count() == 300 and 200 < train.count() < 270


def test_scores(spark, run, features):
    base, result = run
    scores = read_table(spark, base, "gold", "churn_scores")
    assert scores.count() == features.count() == result.rows_written["churn_scores"]
    assert scores.select("customer_id").distinct().count() == 300
    low, high = scores.agg(F.min("churn_probability"), F.max("churn_probability")).first()
    assert 0 <= low < high <= 1
    wrong = scores.where((F.col("churn_probability") >= 0.7) != (F.col("churn_score_band") == "High Risk"))
    assert wrong.count() == 0
    assert sum(r["count"] for r in gold.band_counts(scores).collect()) == 300
    top = [r.churn_probability for r in churn.top_scores(scores, 20).collect()]
    assert top == sorted(top, reverse=True) and top[0] == high
    assert result.detail["auc"] > 0.8


def test_the_run_is_recorded_with_its_model(spark, run, features):
    base, result = run
    recorded = read_merged(spark, f"{base}/gold/model_runs")
    row = recorded.first()
    assert recorded.count() == 1 and row.run_id == result.detail["run_id"]
    assert row.train_rows + row.test_rows == 300 and row.features == 19
    assert sum(row.importances.values()) == pytest.approx(1.0)
    assert churn.top_importances(recorded, 10).first().feature == "tenure_months"
    model = load_model(result.detail["model_path"])
    assert churn.feature_importance(spark, model).count() == 19
    stored = {r.customer_id: r.churn_probability for r in read_table(spark, base, "gold", "churn_scores").collect()}
    fresh = {r.customer_id: r.churn_probability for r in churn.score(model, features).collect()}
    assert stored == fresh


def test_same_seed_same_model(features):
    train, _ = churn.split(features)
    one = churn.fit(train, 4, trees=5, depth=3)
    two = churn.fit(train.repartition(9), 4, trees=5, depth=3)
    assert churn.importances(one) == churn.importances(two)


def test_views_over_scores(spark, run):
    base, _ = run
    scores = read_table(spark, base, "gold", "churn_scores")
    summary = scores.select("customer_id", "monthly_fee_qar", "total_recharges")
    analysis = views.vw_churn_analysis(
        scores.withColumn("monthly_fee_qar", F.lit(0)), summary.withColumn("monthly_fee_qar", F.lit(1).cast("decimal(10,2)"))
    )
    got = analysis.collect()
    assert sum(r.customer_count for r in got) == 300 and {str(r.avg_monthly_fee) for r in got} == {"1.00"}


def test_job_over_a_lake_and_its_views(spark, tmp_path):
    cfg = RunConfig(str(tmp_path))
    people = [f"P{i:02d}" for i in range(60)]
    sinks.write_csv(
        frames.customers(
            spark, *[{"customer_id": p, "churn_risk": "High" if i % 3 else "Low", "tenure_months": i} for i, p in enumerate(people)]
        ),
        cfg.bronze("customers"),
    )
    sinks.write_csv(frames.cdr(spark, *[{"cdr_id": f"{p}-1", "customer_id": p} for p in people[:50]]), cfg.bronze("cdrs"))
    sinks.write_csv(frames.recharges(spark, {"customer_id": people[0]}), cfg.bronze("recharges"))
    run_batch(spark, cfg)
    assert run_churn(spark, cfg).rows_written == {"churn_scores": 60}
    register_serving_views(spark, cfg.base)
    assert spark.sql("SELECT * FROM vw_customer_360 WHERE churn_score_band IS NOT NULL").count() == 60
    assert spark.sql("SELECT sum(customer_count), sum(total_calls) FROM vw_churn_analysis").first() == (60, 50)


def test_large_tables_have_large_partitions():
    """Every partition sends statistics of every node; at 2,000 rows each these grew to gigabytes a level."""
    assert [churn.fit_partitions(n) for n in (0, 1, 2_000, 2_001, 11_400, 48_000)] == [1, 1, 1, 2, 6, 24]
    assert [churn.fit_partitions(n) for n in (684_000, 1_200_001, 4_100_000)] == [24, 25, 82]
