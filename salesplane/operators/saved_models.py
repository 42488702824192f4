"""Per-split models that are saved, reloaded and applied to a later year.

A model is one ``PipelineModel``: encoders fitted on the split's training rows
(quantile buckets, robust scaler, year index; M1, M3, M4), input assembly (M8) and
a regressor on the log target.  It is written with everything the fit learned, so a
hold-out year is scored with train-time encoders and nothing is fitted again.
"""

from __future__ import annotations

import json

from pyspark.errors import PySparkException
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats import group_quantiles

#: Inputs that the encoders make.
FEATURES = ["month", "quarter", "year_index", "price_scaled", "price_bucket"]


class _PriceCalendarParams(Params):
    priceCol = Param(Params._dummy(), "priceCol", "numeric column that is scaled and put into buckets", TypeConverters.toString)
    dateCol = Param(Params._dummy(), "dateCol", "date column of the calendar inputs", TypeConverters.toString)
    bins = Param(Params._dummy(), "bins", "number of quantile buckets", TypeConverters.toInt)

    def _defaults(self):
        self._setDefault(priceCol="unit_price", dateCol="sales_month", bins=50)


class PriceCalendarEncoder(Estimator, _PriceCalendarParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns quantile edges of the non-zero prices, their median and interquartile
    range (0 -> 1) and the index of each year.  Raises ValueError without rows."""

    def __init__(self):
        super().__init__()
        self._defaults()

    def _fit(self, dataset: DataFrame) -> "PriceCalendarEncoderModel":
        price, day, bins = (self.getOrDefault(p) for p in (self.priceCol, self.dateCol, self.bins))
        probs = [i / bins for i in range(bins + 1)]
        edges = group_quantiles(dataset.where(F.col(price) != 0), [], [price], probs).first()
        spread = group_quantiles(dataset, [], [price], [0.25, 0.5, 0.75]).first()
        years = sorted(r[0] for r in dataset.select(F.year(day)).where(F.col(day).isNotNull()).distinct().collect())
        if spread is None or not years:
            raise ValueError("no training rows")
        low, median, high = spread["q"]
        state = {"edges": sorted(set(edges["q"])) if edges else [], "median": median, "iqr": (high - low) or 1.0, "years": years}
        model = PriceCalendarEncoderModel()
        model._set(state=json.dumps(state), priceCol=price, dateCol=day, bins=bins)
        return model


class PriceCalendarEncoderModel(Model, _PriceCalendarParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds FEATURES.  A null price is the median in bucket 0; a bucket is the number
    of edges up to the price, bins + 1 at most; unseen years get index 0."""

    state = Param(Params._dummy(), "state", "what the fit learned, as JSON", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._defaults()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = json.loads(self.getOrDefault(self.state))
        day, price = F.col(self.getOrDefault(self.dateCol)), F.col(self.getOrDefault(self.priceCol))
        edges = F.array(*[F.lit(float(e)) for e in s["edges"]]).cast("array<double>")
        bucket = F.least(F.size(F.filter(edges, lambda e: e <= price)), F.lit(self.getOrDefault(self.bins) + 1))
        index = F.lit(0)
        for i, y in enumerate(s["years"]):
            index = F.when(F.year(day) == y, i).otherwise(index)
        return dataset.select("*", F.month(day).alias("month"), F.quarter(day).alias("quarter"), index.alias("year_index"),
                              F.coalesce((price - s["median"]) / s["iqr"], F.lit(0.0)).alias("price_scaled"),
                              F.when(price.isNull(), 0).otherwise(bucket).alias("price_bucket"))


def estimator(kind: str = "ridge", label: str = "sales_quantity_log", seed: int = 42):
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
    kinds = {
        "ridge": lambda: LinearRegression(labelCol=label, regParam=1.0, elasticNetParam=0.0, standardization=True),
        "elastic_net": lambda: LinearRegression(labelCol=label, regParam=1.0, elasticNetParam=0.5, standardization=True),
        "least_squares": lambda: LinearRegression(labelCol=label, solver="normal"),
        "forest": lambda: RandomForestRegressor(labelCol=label, numTrees=50, maxDepth=5, seed=seed),
        "boosted": lambda: GBTRegressor(labelCol=label, maxIter=200, maxDepth=4, stepSize=0.1, subsamplingRate=0.8, seed=seed),
        "boosted_refined": lambda: GBTRegressor(labelCol=label, maxIter=200, maxDepth=5, stepSize=0.01, subsamplingRate=0.8, seed=seed),
    }
    return kinds[kind]()


def pipeline(kind: str = "ridge", label: str = "sales_quantity_log", seed: int = 42) -> Pipeline:
    """Encoders, input assembly and regressor in one estimator."""
    return Pipeline(stages=[PriceCalendarEncoder(), VectorAssembler(inputCols=FEATURES, outputCol="features"), estimator(kind, label, seed)])


def train_splits(df: DataFrame, windows, folder: str, kind: str = "ridge", date_col: str = "sales_month",
                 label: str = "sales_quantity_log", seed: int = 42) -> list[dict]:
    """One saved model for each of ``windows`` (split_id, train from, to, ...).

    Training rows are read by a date predicate, not from an exploded copy.  A split
    whose fit fails (no rows, no usable prices, null labels only) is reported with
    status ``failed`` and its error, and the others go on.  Returns one dict a split:
    split_id, status, path, train_rows, error.
    """
    day, out = F.col(date_col), []
    for split_id, start, end, *_ in windows:
        rows = df.where((day >= F.lit(start)) & (day < F.lit(end)) & F.col(label).isNotNull())
        done = {"split_id": split_id, "status": "saved", "path": f"{folder}/split-{split_id}", "train_rows": rows.count(), "error": None}
        try:
            pipeline(kind, label, seed).fit(rows).write().overwrite().save(done["path"])
        except (ValueError, PySparkException) as e:
            done.update(status="failed", path=None, error=str(e).splitlines()[0])
        out.append(done)
    return out


def score_saved(spark: SparkSession, trained: list[dict], rows: DataFrame, label: str = "sales_quantity_log") -> DataFrame | None:
    """``rows`` scored by every saved model, reloaded from its folder: all
    columns of ``rows``, split_id, y_true and y_pred on the original scale.  Splits
    that failed have no rows; None if all did."""
    out = None
    for t in trained:
        if t["status"] == "saved":
            scored = (PipelineModel.load(t["path"]).transform(rows)
                      .select(*rows.columns, F.lit(t["split_id"]).alias("split_id"), F.expm1(label).alias("y_true"),
                              F.expm1("prediction").alias("y_pred")))
            out = scored if out is None else out.unionByName(scored)
    return out


def holdout_report(spark: SparkSession, trained: list[dict], rows: DataFrame, label: str = "sales_quantity_log") -> DataFrame:
    """One row a split: status, train_rows, error and, where a model was saved, the
    hold-out metrics of ``metrics.metrics_by``."""
    from .metrics import metrics_by
    status = spark.createDataFrame([(t["split_id"], t["status"], t["train_rows"], t["error"]) for t in trained],
                                   "split_id int, status string, train_rows long, error string")
    scored = score_saved(spark, trained, rows, label)
    return status if scored is None else status.join(metrics_by(scored, ["split_id"]), "split_id", "left")
