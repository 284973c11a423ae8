"""K-Means and PCA over the vectors, and their predictions in place."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, StandardScalerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaint.operators.filters import id_present, present
from plaint.schemas import COMPONENTS

# Clusters and components of the published table.
CLUSTERS = 8
SEED = 42


def _features(df: DataFrame, vector: str) -> DataFrame:
    """The training input: vectors of rows with an id. Other columns are not read."""
    rows = id_present(df).filter(F.col(vector).isNotNull())
    return rows.select(array_to_vector(vector).alias("features"))


def fit_scaler(df: DataFrame, vector: str = "vector") -> StandardScalerModel:
    """Mean and deviation of every dimension, in one pass, for both models."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    return scaler.fit(_features(df, vector))


def _scaling(fitted: StandardScalerModel, output: str, mean: bool, std: bool) -> StandardScalerModel:
    """The same statistics under another output, used as asked."""
    return fitted.copy({fitted.outputCol: output, fitted.withMean: mean, fitted.withStd: std})


def fit_kmeans(
    df: DataFrame,
    k: int = CLUSTERS,
    standardize: bool = True,
    vector: str = "vector",
    seed: int = SEED,
    max_iter: int = 20,
    scaler: StandardScalerModel | None = None,
) -> PipelineModel:
    """K-Means on standardised vectors. Vectors of unequal width fail the scaler's own pass.

    ``scaler`` is one that ``fit_scaler`` fitted on the same rows."""
    scaler = _scaling(scaler or fit_scaler(df, vector), "scaled", standardize, standardize)
    kmeans = KMeans(
        featuresCol="scaled", predictionCol="prediction", k=k, seed=seed, maxIter=max_iter
    )
    return Pipeline(stages=[scaler, kmeans]).fit(_features(df, vector))


def fit_pca(
    df: DataFrame,
    n: int = len(COMPONENTS),
    scale: bool = False,
    vector: str = "vector",
    scaler: StandardScalerModel | None = None,
) -> PipelineModel:
    """Principal components of centered, unscaled vectors.

    The covariance is summed over the executors; the driver holds width x width doubles, which
    does not grow with the rows. Spark's PCA does not subtract the mean when it projects, so the
    scaler does.
    """
    scaler = _scaling(scaler or fit_scaler(df, vector), "centered", True, scale)
    pca = PCA(inputCol="centered", outputCol="scores", k=n)
    return Pipeline(stages=[scaler, pca]).fit(_features(df, vector))


def _with_features(df: DataFrame, model: PipelineModel, vector: str) -> DataFrame:
    """Add the model's input. A missing vector goes in as zeros, because a model cannot take NULL;
    ``_usable`` blanks what comes out."""
    zeros = F.array_repeat(F.lit(0.0), len(model.stages[0].mean))
    return df.withColumn("features", array_to_vector(F.coalesce(F.col(vector), zeros)))


def _usable(vector: str) -> Column:
    """Only rows with an id and a vector get a prediction."""
    return present("ticket_id") & F.col(vector).isNotNull()


def _clusters(df: DataFrame, model: PipelineModel, vector: str) -> DataFrame:
    cluster = F.when(_usable(vector), (F.col("prediction") + 1).cast("string"))
    return model.transform(df).withColumn("cluster", cluster).drop("scaled", "prediction")


def _scores(df: DataFrame, model: PipelineModel, vector: str) -> DataFrame:
    scores = F.when(_usable(vector), vector_to_array("scores"))
    return model.transform(df).withColumn("scores", scores).drop("centered")


def _named_scores(df: DataFrame) -> DataFrame:
    added = {name: F.get("scores", i) for i, name in enumerate(COMPONENTS)}
    return df.withColumns(added).drop("scores")


def predict_clusters(df: DataFrame, model: PipelineModel, vector: str = "vector") -> DataFrame:
    """Add ``cluster``, the id of the nearest center from 1 as text; NULL for rows without an id."""
    return _clusters(_with_features(df, model, vector), model, vector).drop("features")


def component_scores(df: DataFrame, model: PipelineModel, vector: str = "vector") -> DataFrame:
    """Add ``scores``, the projection on every fitted component; NULL for rows without an id."""
    return _scores(_with_features(df, model, vector), model, vector).drop("features")


def project_components(df: DataFrame, model: PipelineModel, vector: str = "vector") -> DataFrame:
    """Add PC1, PC2, PC3; NULL for rows without an id. Their signs are arbitrary."""
    return _named_scores(component_scores(df, model, vector))


def predict(
    df: DataFrame, kmeans: PipelineModel, pca: PipelineModel, vector: str = "vector"
) -> DataFrame:
    """Cluster and components in place: no self-join, no shuffle, one row per input row."""
    done = _clusters(_with_features(df, kmeans, vector), kmeans, vector)
    return _named_scores(_scores(done, pca, vector).drop("features"))


def centers(model: PipelineModel) -> tuple[list[str], np.ndarray]:
    """Cluster ids and centers of a fitted K-Means, in the space of the standardised vectors."""
    found = np.array(model.stages[1].clusterCenters())
    return [str(i + 1) for i in range(len(found))], found


def save_model(model: PipelineModel, path: str) -> None:
    """Write the model, replacing an older one."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
