"""Profit regression (M1-M14) with MLlib.

Same model as the reference: four string indexers (segment, category,
region, ship mode; frequency order, ties alphabetical), a 7-feature assembler
(sales, quantity, discount and the four indices used as plain numbers), and a
ridge linear regression of profit (regParam 0.3, maxIter 10, elastic net 0,
standardisation on -> the normal-equation solver, one distributed pass).

Scale notes: the four indexers are fitted together in ONE aggregation pass
(``inputCols``), the regression aggregates a 7x7 Gram matrix per task
(tree-aggregated, the driver receives only that), and RMSE/R2 come from one
aggregate over the scored rows instead of one evaluator job per metric.
Fitting reads its rows several times (indexer fit, feature statistics, normal
equations), so the narrow model frame is written once to the shared
checkpoint folder when the input would otherwise redo the star joins on every
pass, and deleted when it has been used.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.config import (
    RIDGE_MAX_ITER, RIDGE_REG_PARAM, SPLIT_SEED, SPLIT_WEIGHTS,
)
from ledgerline.plans.fact import is_derived, materialize
from ledgerline.session import delete_path

INDEXED = ("segment", "category", "region", "ship_mode")
FEATURES = ("sales", "quantity", "discount", "segment_idx", "category_idx",
            "region_idx", "ship_mode_idx")
LABEL = "profit"


def ml_frame(fact: DataFrame, keep_key: bool = True) -> DataFrame:
    """The model's input: dimensions as strings, measures as DOUBLE."""
    cols = [F.col(c) for c in INDEXED] + [
        F.col(c).cast("double").alias(c) for c in ("sales", "quantity", "discount", "profit")]
    if keep_key and "order_key" in fact.columns:
        cols.insert(0, F.col("order_key"))
    return fact.select(*cols)


def stored_frame(frame: DataFrame, store: bool | None = None) -> tuple[DataFrame, str | None]:
    """``frame`` ready for several passes, and the folder to delete after them:
    written once as parquet (which also cuts the lineage, so a lost executor
    re-reads files instead of replaying joins) when ``store`` is True, or - by
    default - when its plan still has joins or shuffles. An already stored
    frame is used as it is, and there is nothing to delete."""
    if store is None:
        store = is_derived(frame)
    if not store:
        return frame, None
    kept = materialize(frame.sparkSession, frame)
    return kept, kept.scratch


def indexer(handle_invalid: str = "error") -> StringIndexer:
    """M1-M4 as one multi-column indexer (one fitting pass)."""
    return StringIndexer(inputCols=list(INDEXED), outputCols=[f"{c}_idx" for c in INDEXED],
                         stringOrderType="frequencyDesc", handleInvalid=handle_invalid)


def assembler() -> VectorAssembler:
    """M5."""
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features")


def regression(reg_param: float = RIDGE_REG_PARAM, max_iter: int = RIDGE_MAX_ITER) -> LinearRegression:
    """M6."""
    return LinearRegression(labelCol=LABEL, featuresCol="features",
                            maxIter=max_iter, regParam=reg_param)


def build_pipeline(handle_invalid: str = "error", reg_param: float = RIDGE_REG_PARAM,
                   max_iter: int = RIDGE_MAX_ITER) -> Pipeline:
    """M7: indexers -> assembler -> regression.

    ``handle_invalid`` decides what scoring does with a label never seen in
    training: 'error' (the reference's default), 'skip' (drop the row) or
    'keep' (an extra index).
    """
    return Pipeline(stages=[indexer(handle_invalid), assembler(),
                            regression(reg_param, max_iter)])


def is_test(frame: DataFrame, mode: str = "random", seed: int = SPLIT_SEED,
            weights: tuple[float, float] = SPLIT_WEIGHTS, key: str = "order_key") -> Column:
    """Which rows of ``frame`` the split gives to the test side.

    'random' draws every row with the seed, as the reference's
    ``randomSplit([0.8, 0.2], seed=42)`` does (both depend on the partitioning
    of the input, so store the flag before reading it twice). 'stable' assigns
    whole orders by key - every fifth order key (key mod 5 = 4) is test - so
    the same rows land in the same side on any engine or partitioning.
    """
    if mode == "random":
        return F.rand(seed) >= F.lit(weights[0] / sum(weights))
    if mode == "stable":
        if key not in frame.columns:
            raise ValueError(f"the stable split goes by the column {key!r}, which this fact has not "
                             f"(it has {', '.join(frame.columns)}): name another key, or use mode='random'")
        return F.coalesce(F.pmod(F.col(key), F.lit(5)) == 4, F.lit(False))
    raise ValueError(f"unknown split mode {mode!r}")


def split(frame: DataFrame, mode: str = "random", seed: int = SPLIT_SEED,
          weights: tuple[float, float] = SPLIT_WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """M8: train/test split; every row is in one of the two. 'random' is the
    reference's ``randomSplit``, 'stable' goes by ``is_test``."""
    if mode == "random":
        train, test = frame.randomSplit(list(weights), seed=seed)
        return train, test
    flag = is_test(frame, mode)
    return frame.filter(~flag), frame.filter(flag)


def fit(train: DataFrame, handle_invalid: str = "error") -> PipelineModel:
    """M9."""
    return build_pipeline(handle_invalid).fit(train)


def score(model: PipelineModel, test: DataFrame) -> DataFrame:
    """The reference's prediction columns."""
    return model.transform(test).select("sales", "quantity", "discount", "profit", "prediction")


def metrics(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    """RMSE and R2 in one aggregation over the scored rows.

    R2 = 1 - SSE / SST with SST = n * population variance of the label, as
    ``RegressionEvaluator`` defines it.
    """
    err = F.col(label) - F.col("prediction")
    agg = predictions.agg(F.sum(err * err).alias("_sse"), F.count(F.lit(1)).alias("test_rows"),
                          F.var_pop(label).alias("_var"))
    return agg.select(
        F.sqrt(F.try_divide(F.col("_sse"), F.col("test_rows").cast("double"))).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_var") * F.col("test_rows")))
        .alias("r2"), "test_rows")


def coefficients(model: PipelineModel, spark) -> DataFrame:
    """The fitted weights (7 features + intercept) as rows (feature, value)."""
    lr = model.stages[-1]
    rows = [(name, float(w)) for name, w in zip(FEATURES, lr.coefficients.toArray())]
    rows.append(("intercept", float(lr.intercept)))
    return spark.createDataFrame(rows, "feature string, coefficient double")


def label_index(fact: DataFrame, column: str) -> DataFrame:
    """M1-M4 one column at a time: each distinct label with its index
    (0 = most frequent; ties alphabetical), as the fitted indexer numbers
    them. One aggregation; the rank runs over the grouped rows."""
    counts = fact.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    rank = F.row_number().over(Window.orderBy(F.desc("_n"), column)) - 1
    return counts.select(column, rank.cast("double").alias(f"{column}_idx"))


def feature_matrix(fact: DataFrame) -> DataFrame:
    """M5: every row's 7 assembled features, unpacked into DOUBLE columns:
    one pass counts the labels, a second one applies them."""
    frame = ml_frame(fact)
    indexed = indexer().fit(frame).transform(frame)
    assembled = assembler().transform(indexed)
    arr = vector_to_array(assembled["features"])
    return assembled.select(*[arr[i].alias(name) for i, name in enumerate(FEATURES)])


def train_test_counts(fact: DataFrame, mode: str = "stable") -> DataFrame:
    """Rows on each side of the split, from one aggregation."""
    frame = ml_frame(fact)
    side = F.when(is_test(frame, mode), F.lit("test")).otherwise(F.lit("train"))
    return frame.select(side.alias("split")).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


def random_split_total(fact: DataFrame) -> DataFrame:
    """The reference's own split, by what does not depend on partitioning: its
    sides hold every row once, and the test side about its share."""
    frame = ml_frame(fact)
    sides = frame.select(F.when(is_test(frame, "random"), 1).otherwise(0).alias("_test"))
    share = F.try_divide(F.sum("_test").cast("double"), F.count("_test").cast("double"))
    return sides.agg(F.count("_test").alias("rows"),
                     (F.abs(share - SPLIT_WEIGHTS[1] / sum(SPLIT_WEIGHTS)) < 0.05).alias("share_holds"))


def fit_stable(fact: DataFrame, handle_invalid: str = "error",
               store: bool | None = None) -> tuple[PipelineModel, DataFrame]:
    """The model fitted on the stable split's train side and the (lazy) test
    side. The train side is stored for the passes of the fit and deleted."""
    train, test = split(ml_frame(fact), "stable")
    kept, folder = stored_frame(train, store)
    try:
        model = fit(kept, handle_invalid)
    finally:
        if folder:
            delete_path(fact.sparkSession, folder)
    return model, test


def run_regression(fact: DataFrame, mode: str = "random", handle_invalid: str = "error",
                   store: bool | None = None):
    """The reference's whole ML step: split, fit, score, evaluate.

    Returns (model, predictions, metrics DataFrame). Under the random split
    the frame is stored with each row's side, so the sides are the same on
    every read; predictions and metrics read it, and its folder is in the
    attribute ``scratch`` of the predictions, to be deleted after them.
    """
    if mode == "stable":
        model, test = fit_stable(fact, handle_invalid, store)
        preds = score(model, test)
        preds.scratch = None
        return model, preds, metrics(preds)
    frame = ml_frame(fact)
    kept, folder = stored_frame(frame.withColumn("_test", is_test(frame, mode)), True)
    model = fit(kept.filter(~F.col("_test")), handle_invalid)
    preds = score(model, kept.filter("_test"))
    preds.scratch = folder
    return model, preds, metrics(preds)
