"""Model parity with closed forms computed in numpy on the same rows
(scikit-learn is not available; its objectives are restated here)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeolus.operators.ml import classification as mc
from aeolus.operators.ml import clustering as mk
from aeolus.operators.ml import prep as mp
from aeolus.operators.ml import regression as mr
from aeolus.plans.catalog import ML_KEY, ml_dataset, scored_fixture
from conftest import SF001, SF01


@pytest.fixture(scope="module")
def prepared(spark):
    p = mp.prepare(ml_dataset(spark, SF01), mp.ROAD_SPEC, ML_KEY)
    rows = p.data.select("features", "is_test", "current_speed_kmh", "is_congested").collect()
    X = np.array([r.features.toArray() for r in rows])
    test = np.array([r.is_test for r in rows])
    y = np.array([r.current_speed_kmh for r in rows])
    c = np.array([r.is_congested for r in rows], dtype=float)
    yield p, X, test, y, c
    p.release()


def _spark_test_pred(model, p):
    out = model.transform(p.data.filter(F.col("is_test"))).select(ML_KEY, "prediction")
    return np.array([r.prediction for r in out.orderBy(ML_KEY).collect()])


def _test_order(p):
    ids = [r[0] for r in p.data.filter(F.col("is_test")).select(ML_KEY).collect()]
    return np.argsort(ids)


def test_train_stats_standardise(prepared):
    p, X, test, *_ = prepared
    # Numeric features are centred too; indicators are only scaled.
    wide = len(mp.ROAD_SPEC.numeric)
    assert np.allclose(X[~test][:, :wide].mean(axis=0), 0.0, atol=1e-9)
    sd = X[~test].std(axis=0)
    assert np.all((np.abs(sd - 1) < 1e-9) | (sd < 1e-12))


def test_ols_predictions(prepared):
    p, X, test, y, _ = prepared
    A = np.c_[np.ones((~test).sum()), X[~test]]
    w, *_ = np.linalg.lstsq(A, y[~test], rcond=None)
    ref = (np.c_[np.ones(test.sum()), X[test]] @ w)[_test_order(p)]
    got = _spark_test_pred(mr.fit(p, "current_speed_kmh", "linear_regression"), p)
    assert np.allclose(got, ref, rtol=1e-6, atol=1e-6)


def test_ridge_matches_closed_form(prepared):
    p, X, test, y, _ = prepared
    Xt, yt = X[~test], y[~test]
    xm, ym = Xt.mean(axis=0), yt.mean()
    Xc = Xt - xm
    w = np.linalg.solve(Xc.T @ Xc + 1.0 * np.eye(X.shape[1]), Xc.T @ (yt - ym))
    b = ym - xm @ w
    ref = (X[test] @ w + b)[_test_order(p)]
    got = _spark_test_pred(mr.fit(p, "current_speed_kmh", "ridge"), p)
    assert np.allclose(got, ref, rtol=1e-6, atol=1e-5)


def test_lasso_matches_coordinate_descent(prepared):
    p, X, test, y, _ = prepared
    Xt, yt = X[~test], y[~test]
    n, d = Xt.shape
    xm, ym = Xt.mean(axis=0), yt.mean()
    Xc, yc = Xt - xm, yt - ym
    w = np.zeros(d)
    norms = (Xc ** 2).sum(axis=0) / n
    alpha = 0.1
    for _ in range(5000):
        w_old = w.copy()
        for j in range(d):
            if norms[j] == 0:
                continue
            r = yc - Xc @ w + Xc[:, j] * w[j]
            rho = Xc[:, j] @ r / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha, 0) / norms[j]
        if np.max(np.abs(w - w_old)) < 1e-12:
            break
    ref = (X[test] @ w + ym - xm @ w)[_test_order(p)]
    got = _spark_test_pred(mr.fit(p, "current_speed_kmh", "lasso"), p)
    assert np.allclose(got, ref, rtol=1e-4, atol=1e-3)


def test_weighted_logistic_matches_newton(prepared):
    p, X, test, _, c = prepared
    Xt, yt = X[~test], c[~test]
    n = len(yt)
    wts = np.where(yt == 1, n / (2 * yt.sum()), n / (2 * (n - yt.sum())))
    A = np.c_[np.ones(n), Xt]
    beta = np.zeros(A.shape[1])
    pen = np.r_[0.0, np.ones(Xt.shape[1])]  # intercept unpenalised, C = 1
    for _ in range(100):
        z = 1 / (1 + np.exp(-(A @ beta)))
        g = A.T @ (wts * (z - yt)) + pen * beta
        H = (A * (wts * z * (1 - z))[:, None]).T @ A + np.diag(pen)
        step = np.linalg.solve(H, g)
        beta -= step
        if np.max(np.abs(step)) < 1e-12:
            break
    m = mc.fit_logistic(p, "is_congested")
    assert m.intercept == pytest.approx(beta[0], abs=1e-4)
    assert np.allclose(m.coefficients.toArray(), beta[1:], atol=1e-4)


def test_kmeans_centers_are_cluster_means(spark):
    df = mp.check_dataset(ml_dataset(spark, SF01), mp.ROAD_SPEC)
    res = mk.cluster(mk.congested_points(df, mp.ROAD_SPEC), ks=(2, 3, 4), restarts_search=2,
                     restarts_final=3)
    try:
        assert not res["skipped"] and res["best_k"] in (2, 3, 4)
        costs = [e["inertia"] for e in res["evaluations"]]
        assert costs == sorted(costs, reverse=True)
        means = {r.cluster_id: r for r in mk.centers_from_labels(res["labelled"]).collect()}
        st = mk.scale_points(mk.congested_points(df, mp.ROAD_SPEC)).stats
        for i, ctr in enumerate(res["model"].clusterCenters()):
            lat = ctr[0] * st["lat"][1] + st["lat"][0]
            assert lat == pytest.approx(means[i].lat, abs=1e-6)
        assert sum(r.size for r in means.values()) == res["labelled"].count()
    finally:
        res["data"].unpersist()


def test_kmeans_guard(spark):
    few = spark.createDataFrame([(50.0 + i, 30.0, 1.0) for i in range(5)], "lat double, lon double, intensity double")
    assert mk.cluster(few)["reason"] == "insufficient_samples"


def test_auc_rank_sum_and_one_class(spark):
    scored = scored_fixture(spark, SF001)
    rows = scored.select("is_congested_actual", "congestion_proba").collect()
    y = np.array([r[0] for r in rows])
    s = np.array([r[1] for r in rows])
    order = np.argsort(s, kind="mergesort")
    ranks = np.empty(len(s))
    ranks[order] = np.arange(1, len(s) + 1)
    for v in np.unique(s):
        m = s == v
        ranks[m] = ranks[m].mean()
    n1, n0 = y.sum(), len(y) - y.sum()
    ref = (ranks[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)
    assert mc.roc_auc(scored) == pytest.approx(ref, abs=1e-9)
    assert ref == pytest.approx(0.991670, abs=1e-6)
    assert mc.roc_auc(scored.filter(F.col("is_congested_actual") == 1)) is None


def test_classification_scores_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "is_congested_actual int, is_congested_pred int")
    r = mc.classification_scores(df).first()
    assert (r.accuracy, r.precision, r.recall, r.f1) == (1.0, 0.0, 0.0, 0.0)
    cm = {(x.actual, x.predicted): x.rows for x in mc.confusion_matrix(df).collect()}
    assert cm == {(0, 0): 2, (0, 1): 0, (1, 0): 0, (1, 1): 0}


def test_dataset_contract(spark):
    df = spark.createDataFrame([(1.0,)], "lat double")
    with pytest.raises(ValueError, match="missing columns"):
        mp.check_dataset(df, mp.ROAD_SPEC)


def _many_levels(spark, levels, rows):
    """A road dataset of so many levels, with plain arithmetic for its numbers."""
    numeric = {c: ((F.col("id") * (7 + 2 * k)) % (11 + 3 * k)).cast("double")
               for k, c in enumerate(mp.ROAD_SPEC.numeric)}
    y = (F.col("id") * 13 % 47 + F.col("road_id").cast("int") % 5).cast("double")
    return (spark.range(rows).withColumn("road_id", (F.col("id") * 31 % levels).cast("string"))
            .withColumns(numeric)
            .withColumn("current_speed_kmh", y)
            .withColumn("is_congested", (F.col("id") * 17 % 29 < 11).cast("int"))
            .withColumn("event_hour", F.lit("2024-01-01 00:00:00").cast("timestamp")))


@pytest.mark.parametrize(("levels", "rows"), [(20, 2000), (5000, 9000)])
def test_one_sparse_path_at_any_number_of_levels(spark, levels, rows):
    with mp.prepare(_many_levels(spark, levels, rows), mp.ROAD_SPEC, "id") as p:
        wide = len(mp.ROAD_SPEC.numeric)
        assert len(p.feature_names) == wide + levels
        got = p.data.select("id", "features", "is_test", "current_speed_kmh", "is_congested").collect()
        assert all(r.features.numNonzeros() <= wide + 1 for r in got)
        X = np.array([r.features.toArray()[:wide] for r in got])
        level = np.array([int(np.flatnonzero(r.features.toArray()[wide:])[0]) for r in got])
        test = np.array([r.is_test for r in got])
        n = np.bincount(level[~test], minlength=levels)
        share = n / (~test).sum()
        scale = np.where((share > 0) & (share < 1), 1 / np.sqrt(np.maximum(share * (1 - share), 1e-300)), 1.0)
        value = np.array([r.features.toArray()[wide + k] for r, k in zip(got, level)])
        assert np.allclose(value, scale[level])
        y = np.array([r.current_speed_kmh for r in got])
        # Ridge in closed form: standardised indicators, intercept unpenalised.
        # Centred columns share one penalty, so the indicators are solved out
        # by their (diagonal plus rank-one) block only in the small case.
        if levels <= 20:
            hot = np.zeros((len(got), levels))
            hot[np.arange(len(got)), level] = scale[level]
            A = np.c_[X, hot]
            At, yt = A[~test], y[~test]
            m, ym = At.mean(0), yt.mean()
            w = np.linalg.solve((At - m).T @ (At - m) + np.eye(A.shape[1]), (At - m).T @ (yt - ym))
            ref = {r.id: v for r, v, t in zip(got, (A - m) @ w + ym, test) if t}
            out = mr.fit(p, "current_speed_kmh", "ridge").transform(p.data.filter(F.col("is_test")))
            pairs = [(r.prediction, ref[r.id]) for r in out.select("id", "prediction").collect()]
            assert np.allclose(*zip(*pairs), rtol=1e-5, atol=1e-5)


def test_clustering_skips_without_points(spark):
    none = spark.createDataFrame([], "lat double, lon double, intensity double")
    res = mk.cluster(none)
    assert res["skipped"] and res["rows"] == 0
