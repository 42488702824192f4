"""Baselines, correlation screens and Spark ML regressors per split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def baseline_predictions(tagged: DataFrame, y: str = "sales_quantity") -> DataFrame:
    """Per split, platform mean of the training rows (fallback: global
    training mean) as the prediction for the validation rows.  Two small
    aggregates (split x platform, split) joined to the validation rows."""
    train = tagged.where(F.col("role") == "train")
    pm = train.groupBy("split_id", "primary_platform").agg(F.avg(y).alias("_pm"))
    gm = train.groupBy("split_id").agg(F.avg(y).alias("_gm"))
    val = tagged.where(F.col("role") == "val")
    out = val.join(pm, ["split_id", "primary_platform"], "left").join(gm, "split_id", "left")
    return out.select("split_id", "role", "sales_month", "primary_platform", "store_name", "brand_name",
                      "product_code", F.col(y).alias("y_true"), F.col("_gm").alias("y_pred_mean"),
                      F.coalesce(F.col("_pm"), F.col("_gm")).alias("y_pred"))


def expanding_baselines(df: DataFrame, windows, y: str = "sales_quantity") -> DataFrame:
    """M13 from monthly partial moments: the result of ``baseline_predictions`` without
    a copy of the training rows for each split.  A split needs training rows."""
    from .splits import in_windows, train_moments
    pm = train_moments(df, windows, [y], ["primary_platform"]).select("split_id", "primary_platform", F.col(f"{y}__mean").alias("_pm"))
    gm = train_moments(df, windows, [y]).select("split_id", F.col(f"{y}__mean").alias("_gm"))
    out = in_windows(df, windows, "val").join(F.broadcast(gm), "split_id").join(pm, ["split_id", "primary_platform"], "left")
    return out.select("split_id", F.lit("val").alias("role"), "sales_month", "primary_platform", "store_name", "brand_name",
                      "product_code", F.col(y).alias("y_true"), F.col("_gm").alias("y_pred_mean"),
                      F.coalesce(F.col("_pm"), F.col("_gm")).alias("y_pred"))


def target_correlations(df: DataFrame, features, target: str = "sales_quantity_log", shifts=None) -> DataFrame:
    """|Pearson r| of each feature with the target, long form; ``shifts`` near the
    means of the features and the target spare a pass."""
    from .gram import target_correlations as correlated
    return correlated(df, list(features), target, shifts)


def fit_regressor(train: DataFrame, features, kind: str = "rf", label: str = "sales_quantity_log",
                  seed: int = 42, **params):
    """Input assembly (``VectorAssembler``) and a Spark ML regressor on
    the log target, fitted per split by the caller (one ``Pipeline.fit`` per split)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    if kind == "rf":
        est = RandomForestRegressor(labelCol=label, numTrees=params.get("numTrees", 50),
                                    maxDepth=params.get("maxDepth", 5), seed=seed)
    elif kind == "gbt":
        est = GBTRegressor(labelCol=label, maxIter=params.get("maxIter", 200), maxDepth=params.get("maxDepth", 4),
                           stepSize=params.get("stepSize", 0.1), subsamplingRate=params.get("subsamplingRate", 0.8),
                           seed=seed)
    else:
        est = LinearRegression(labelCol=label, regParam=params.get("regParam", 1.0),
                               elasticNetParam=params.get("elasticNetParam", 0.0), standardization=True)
    return Pipeline(stages=[asm, est]).fit(train)


def predict_original_scale(model, df: DataFrame, label: str = "sales_quantity_log") -> DataFrame:
    """Transform, expm1 back to quantities."""
    return model.transform(df).withColumn("y_pred", F.expm1("prediction")).withColumn("y_true", F.expm1(label))


def feature_importances(model, features) -> list:
    """M19."""
    imp = model.stages[-1].featureImportances
    return sorted(zip(features, imp.toArray().tolist()), key=lambda t: -t[1])


def vif(df: DataFrame, features) -> list:
    """Variance inflation factors without intercept, VIF_j = G_jj * inv(G)_jj, from a
    one-pass Gram matrix (k x k sums of products; only k^2 numbers reach the driver)."""
    import numpy as np

    from .gram import gram_matrix
    g = gram_matrix(df, list(features))
    inv = np.linalg.pinv(g)
    return [(f, float(g[i, i] * inv[i, i])) for i, f in enumerate(features)]


def top_correlated(corr: DataFrame, n: int = 10) -> DataFrame:
    """K4: top-n features by |r| with the target (a top-k report, ties by name)."""
    return corr.orderBy(F.desc_nulls_last("abs_corr"), "feature").limit(n)
