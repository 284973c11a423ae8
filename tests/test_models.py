from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from plaint import fixtures
from plaint.operators import models
from plaint.schemas import COMPONENTS

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vectors(spark):
    """The given vectors; two rows have no id and one has no vector."""
    blank = F.when(F.col("doc_id") == 3, "").when(F.col("doc_id") == 4, F.lit(None))
    frame = fixtures.given_vectors(spark, SF_DIR).select(
        F.when(F.col("doc_id").isin(3, 4), blank).otherwise(F.col("doc_id").cast("string")).alias("ticket_id"),
        F.when(F.col("doc_id") != 5, F.col("vector")).alias("vector"),
    )
    return frame.persist()


@pytest.fixture(scope="module")
def kmeans(vectors):
    return models.fit_kmeans(vectors)


@pytest.fixture(scope="module")
def pca(vectors):
    return models.fit_pca(vectors)


def matrix(frame):
    rows = frame.filter("ticket_id != '' and vector is not null").collect()
    return rows, np.array([r.vector for r in rows])


def test_each_vector_gets_its_nearest_center(vectors, kmeans):
    rows, points = matrix(models.predict_clusters(vectors, kmeans))
    scaled = (points - points.mean(axis=0)) / points.std(axis=0, ddof=1)
    names, centers = models.centers(kmeans)
    gaps = ((scaled[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
    assert [names[i] for i in gaps.argmin(axis=1)] == [r.cluster for r in rows]
    assert len(names) == 8 and {r.cluster for r in rows} <= set(map(str, range(1, 9)))


def test_centers_are_the_means_of_their_vectors(vectors, kmeans):
    rows, points = matrix(models.predict_clusters(vectors, kmeans))
    scaled = (points - points.mean(axis=0)) / points.std(axis=0, ddof=1)
    for name, center in zip(*models.centers(kmeans)):
        mine = scaled[[r.cluster == name for r in rows]]
        assert np.linalg.norm(mine.mean(axis=0) - center) < 0.5


def test_the_same_seed_gives_the_same_clusters(vectors, kmeans):
    again = models.fit_kmeans(vectors)
    first, second = (
        {r.ticket_id: r.cluster for r in models.predict_clusters(vectors, m).collect()} for m in (kmeans, again)
    )
    assert first == second


def test_components_match_an_eigendecomposition(vectors, pca):
    rows, points = matrix(models.project_components(vectors, pca))
    axes = pca.stages[1].pc.toArray()
    assert np.allclose(axes.T @ axes, np.eye(3))
    centered = points - points.mean(axis=0)
    values, directions = np.linalg.eigh(np.cov(centered.T))
    top = directions[:, np.argsort(values)[::-1][:3]]
    assert np.allclose(np.abs(np.sum(top * axes, axis=0)), 1)
    scores = np.array([[r[c] for c in COMPONENTS] for r in rows])
    assert np.allclose(scores, centered @ axes)
    assert np.allclose(scores.mean(axis=0), 0)
    assert (np.diff(scores.var(axis=0)) <= 0).all()


def test_predictions_keep_every_row_once(vectors, kmeans, pca):
    found = models.predict(vectors, kmeans, pca)
    assert found.columns == ["ticket_id", "vector", "cluster", *COMPONENTS]
    assert found.count() == vectors.count()
    missing = found.filter("cluster is null").collect()
    assert len(missing) == 3 and all(r.PC1 is None for r in missing)
    assert found.filter("cluster is not null and PC1 is null").count() == 0


def test_predictions_do_not_shuffle(vectors, kmeans, pca):
    plan = models.predict(vectors, kmeans, pca)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Join" not in plan


def test_repeated_ids_are_predicted_in_place(vectors, kmeans, pca):
    twice = vectors.union(vectors)
    assert models.predict(twice, kmeans, pca).count() == twice.count()


def test_saved_models_predict_alike(tmp_path, vectors, kmeans):
    models.save_model(kmeans, str(tmp_path / "m"))
    models.save_model(kmeans, str(tmp_path / "m"))
    loaded = models.load_model(str(tmp_path / "m"))
    first, second = (
        models.predict_clusters(vectors, m).select("ticket_id", "cluster").collect() for m in (kmeans, loaded)
    )
    assert first == second


def test_unequal_widths_fail(spark):
    frame = spark.createDataFrame([("a", [1.0]), ("b", [1.0, 2.0])], "ticket_id string, vector array<double>")
    with pytest.raises(Exception):
        models.fit_kmeans(frame, k=1)


def test_one_scaler_serves_both_models(spark):
    """Fitted once or by each model, the results are the same, and so are the saved models' inputs."""
    draw = np.random.default_rng(8)
    rows = [(f"t{i}", (draw.normal(size=5) * [1, 2, 3, 4, 5] + 7).tolist()) for i in range(300)]
    frame = spark.createDataFrame(rows, "ticket_id string, vector array<double>")
    scaler = models.fit_scaler(frame)
    shared = models.fit_kmeans(frame, 3, scaler=scaler), models.fit_pca(frame, scaler=scaler)
    alone = models.fit_kmeans(frame, 3), models.fit_pca(frame)
    assert np.allclose(models.centers(shared[0])[1], models.centers(alone[0])[1])
    assert np.allclose(shared[1].stages[1].pc.toArray(), alone[1].stages[1].pc.toArray())
    assert [m.stages[0].getWithStd() for m in shared] == [True, False]
    assert np.allclose(shared[1].stages[0].mean.toArray(), np.array([v for _, v in rows]).mean(0))
    done = models.predict(frame, *shared).collect()
    assert len(done) == 300 and all(r.cluster and r.PC1 is not None for r in done)
