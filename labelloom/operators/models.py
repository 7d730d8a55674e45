"""One binary classifier per part on case features, and out-of-fold predictions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.operators.sampling import kfold
from labelloom.session import save_point


def feature_steps(categorical: Sequence[str], numeric: Sequence[str]) -> list:
    """Index and encode the text columns, then assemble one vector; unseen text gets its own slot."""
    indexed = [f"{c}_index" for c in categorical]
    encoded = [f"{c}_onehot" for c in categorical]
    steps: list = []
    if categorical:
        steps.append(StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"))
        steps.append(OneHotEncoder(inputCols=indexed, outputCols=encoded))
    steps.append(VectorAssembler(inputCols=[*numeric, *encoded], outputCol="features"))
    return steps


def fit_parts(
    train: DataFrame,
    parts: Sequence[str],
    categorical: Sequence[str],
    numeric: Sequence[str],
    seed: int,
    max_iter: int = 10,
    max_depth: int = 3,
) -> tuple[PipelineModel, dict[str, PipelineModel | float | None]]:
    """Shared feature model and one boosted-tree model per part.

    Parts are models, so they are fitted in turn, each as distributed jobs. For a part with only one
    class present in `train` the model is that class as a constant, or None without any label.
    """
    features = Pipeline(stages=feature_steps(categorical, numeric)).fit(train)
    assembled = features.transform(train).select("features", *parts).persist()
    try:
        seen = assembled.agg(*[F.struct(F.min(p).alias("low"), F.max(p).alias("high")).alias(p) for p in parts]).first()
        models = {}
        for p in parts:
            low, high = seen[p]
            if low == high:
                models[p] = None if low is None else float(low)
            else:
                tree = GBTClassifier(
                    featuresCol="features", labelCol=p, maxIter=max_iter, maxDepth=max_depth, seed=seed
                )
                models[p] = Pipeline(stages=[tree]).fit(assembled)
    finally:
        assembled.unpersist()
    return features, models


def predict_parts(
    df: DataFrame, features: PipelineModel, models: dict[str, PipelineModel | float | None], id_col: str
) -> DataFrame:
    """Long predictions (id, part, conf, gt) of every model, for every row."""
    assembled = features.transform(df)
    scored = []
    for part, model in models.items():
        if isinstance(model, PipelineModel):
            rows, conf = model.transform(assembled), vector_to_array("probability")[1]
        else:
            rows, conf = assembled, F.lit(model).cast("double")
        scored.append(rows.select(id_col, F.lit(part).alias("part"), conf.alias("conf"), F.col(part).alias("gt")))
    return reduce(DataFrame.unionByName, scored)


def out_of_fold(
    df: DataFrame,
    parts: Sequence[str],
    categorical: Sequence[str],
    numeric: Sequence[str],
    id_col: str,
    k: int,
    seed: int,
    **fit,
) -> DataFrame:
    """Predictions of every row by models that did not see it.

    The folds are saved once. A part that lacks a class in a training fold is predicted as the other.
    """
    folded = save_point(kfold(df, k, id_col, seed))
    outcomes = []
    for fold in range(k):
        inside = F.col("fold") == fold
        features, models = fit_parts(folded.filter(~inside), parts, categorical, numeric, seed, **fit)
        scored = predict_parts(folded.filter(inside), features, models, id_col)
        outcomes.append(scored.withColumn("fold", F.lit(fold)))
    return reduce(DataFrame.unionByName, outcomes)
