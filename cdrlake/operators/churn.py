"""Churn model: features to a random forest, evaluation and scoring."""

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import is_high_score, score_band

# Model inputs and settings.
FEATURES = [
    "tenure_months", "monthly_fee_qar", "data_allowance_gb", "is_prepaid",
    "segment_encoded", "total_calls", "total_cdr_revenue", "avg_call_duration",
    "total_data_gb", "dropped_calls", "drop_rate_pct", "active_days", "roaming_calls",
    "calls_5g", "peak_hour_ratio", "total_recharges", "total_recharge_amount",
    "avg_recharge_amount", "digital_recharges",
]
TREES, DEPTH, SEED, TRAIN_SHARE = 100, 8, 42, 0.8
SCORE_COLUMNS = [
    "customer_id", "churn_probability", "churn_score_band", "is_high_churn_risk", "label",
    "tenure_months", "monthly_fee_qar", "total_calls", "drop_rate_pct", "total_recharges",
    "active_days",
]


def churn_pipeline(trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> Pipeline:
    imputed = [f"{c}_imp" for c in FEATURES]
    return Pipeline(
        stages=[
            Imputer(inputCols=FEATURES, outputCols=imputed, strategy="median"),
            VectorAssembler(inputCols=imputed, outputCol="features_raw", handleInvalid="skip"),
            StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
            RandomForestClassifier(
                featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed
            ),
        ]
    )


def split(features: DataFrame, share: float = TRAIN_SHARE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test by the first 32 bits of an md5 of seed and customer: the same under any
    partitioning, and in any engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), "customer_id").cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 1000
    cut = round(share * 1000)
    return features.where(bucket < cut), features.where(bucket >= cut)


#: rows of a partition that the forest samples from, in small and in large tables; partitions that count
#: as many, and partitions at most
FIT_ROWS, FIT_ROWS_LARGE, FIT_MANY, FIT_PARTITIONS = 2_000, 50_000, 24, 4_096


def fit_partitions(rows: int) -> int:
    """Partitions of the layout, by the number of rows alone.

    Every partition sends statistics of all open nodes of all trees, however few rows it has,
    so a large table has large partitions.
    """
    return min(FIT_PARTITIONS, max(1, min(FIT_MANY, -(-rows // FIT_ROWS)), -(-rows // FIT_ROWS_LARGE)))


def fit(train: DataFrame, partitions: int | None = None, **settings) -> PipelineModel:
    """Fit on a fixed layout: the forest samples per partition, so the same rows in the
    same partitions and order give the same trees.

    The number of partitions follows from the number of rows alone, not from the cluster.
    The laid-out rows are kept while imputer, scaler and forest pass over them; what a lost
    executor held of them is made again in the same layout.
    """
    n = partitions or fit_partitions(train.count())
    laid_out = train.repartition(n, "customer_id").sortWithinPartitions("customer_id")
    laid_out = laid_out.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return churn_pipeline(**settings).fit(laid_out)
    finally:
        laid_out.unpersist()


def evaluate(predictions: DataFrame) -> dict[str, float]:
    auc = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    accuracy = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    f1 = MulticlassClassificationEvaluator(labelCol="label", metricName="f1")
    return {
        "auc": auc.evaluate(predictions),
        "accuracy": accuracy.evaluate(predictions),
        "f1_score": f1.evaluate(predictions),
    }


# Score bands with their lowest and highest probability.
BAND_LIMITS = {"High Risk": (0.70, 1.0), "Medium Risk": (0.40, 0.70), "Low Risk": (0.0, 0.40)}


def check_scores(scores: DataFrame, features: DataFrame) -> DataFrame:
    """Per band: whether all probabilities lie in it and the flag fits; and whether each customer has one score."""
    p, band = F.col("churn_probability"), F.col("churn_score_band")
    inside = [
        (band == name) & (p >= low) & ((p < high) if high < 1 else (p <= high)) & (F.col("is_high_churn_risk") == int(name == "High Risk"))
        for name, (low, high) in BAND_LIMITS.items()
    ]
    bands = [F.struct(F.lit(name).alias("check"), (F.count_if((band == name) & ~ok) == 0).alias("ok")) for name, ok in zip(BAND_LIMITS, inside)]
    listed = F.struct(F.lit("listed bands").alias("check"), (F.count_if(~F.coalesce(band.isin(list(BAND_LIMITS)), F.lit(False))) == 0).alias("ok"))
    found = scores.agg(F.array(*bands, listed).alias("c"), F.count("*").alias("scored"), F.count_distinct("customer_id").alias("customers"))
    wanted = features.agg(F.count("*").alias("wanted"))
    one = F.struct(F.lit("one score each").alias("check"), ((F.col("scored") == F.col("wanted")) & (F.col("customers") == F.col("wanted"))).alias("ok"))
    # both sides are one row
    rows = found.join(wanted, F.lit(True)).select("scored", F.inline(F.concat("c", F.array(one))))
    return rows.select("check", "ok", "scored")


def with_bands(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "churn_score_band": score_band("churn_probability"),
            "is_high_churn_risk": is_high_score("churn_probability"),
        }
    )


def score(
    model: PipelineModel, features: DataFrame, model_version: str = "rf_v1", run_id: str = ""
) -> DataFrame:
    """Probability of the positive class and its band for every customer."""
    predicted = model.transform(features)
    scored = predicted.withColumn("churn_probability", vector_to_array("probability")[1])
    return with_bands(scored).select(
        *SCORE_COLUMNS,
        F.lit(model_version).alias("model_version"),
        F.current_timestamp().alias("score_dttm"),
        F.lit(run_id).alias("run_id"),
    )


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """One row per feature; 19 numbers of the fitted model."""
    return spark.createDataFrame(list(importances(model).items()), "feature string, importance double")


def importances(model: PipelineModel) -> dict[str, float]:
    weights = model.stages[-1].featureImportances.toArray()
    return {name: float(w) for name, w in zip(FEATURES, weights)}


def top_importances(runs: DataFrame, n: int = 10) -> DataFrame:
    """The strongest features of each recorded run's model."""
    each = runs.select(F.explode("importances").alias("feature", "importance"))
    return each.orderBy(F.desc("importance"), "feature").limit(n)


def top_scores(scores: DataFrame, n: int = 20) -> DataFrame:
    return scores.orderBy(F.desc("churn_probability"), "customer_id").limit(n)
