"""K-means over blocks against plain numpy and ``pyspark.ml`` on the same points."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector

from aeolus.operators.ml import clustering as mk
from aeolus.operators.ml import lloyd
from aeolus.operators.ml import prep as mp
from aeolus.plans.catalog import QUERIES, ml_dataset
from conftest import SF01

COLUMNS = "lat double, lon double, intensity double"


def _clouds(n, seed=0, dims=3):
    rng = np.random.default_rng(seed)
    centers = rng.uniform(-5, 5, (6, dims))
    return centers[rng.integers(6, size=n)] + rng.normal(0, 1, (n, dims))


def _frame(spark, x):
    return spark.createDataFrame([tuple(map(float, r)) for r in x], COLUMNS)


@pytest.fixture(scope="module")
def points(spark):
    frame = _frame(spark, _clouds(4000)).repartition(5).persist()
    yield frame
    frame.unpersist()


@pytest.fixture(scope="module")
def scaled(points):
    return mk.scale_points(points)


@pytest.fixture(scope="module")
def x(scaled):
    return np.array([r.features.toArray() for r in scaled.data.select("features").collect()])


def _plain_sums(x, centers):
    label = ((x[:, None] - centers[None]) ** 2).sum(2).argmin(1)
    return np.array([[(label == k).sum(), (x[label == k] ** 2).sum(), *x[label == k].sum(0)]
                     for k in range(len(centers))])


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 700, 9001])
@pytest.mark.parametrize("dims", [1, 3])
def test_sums_of_a_tree_are_those_of_its_points(n, dims):
    rng = np.random.default_rng(n)
    # Whole numbers: many equal points, and points as far from two centers.
    for points in (_clouds(n, n, dims), np.round(_clouds(n, n, dims))):
        tree = lloyd.Tree.of(points)
        again = lloyd.Tree(tree.rows, tree.nodes())
        assert sorted(map(tuple, again.rows.T)) == sorted(map(tuple, points))
        for k in (1, 2, 5, 9):
            centers = points[rng.integers(n, size=k)]  # may hold a center twice
            got = lloyd.center_sums(again, centers)
            assert np.allclose(got, _plain_sums(points, centers), atol=1e-8)
            cost = ((points[:, None] - centers[None]) ** 2).sum(2).min(1).sum()
            assert lloyd.cost_of(got, centers) == pytest.approx(cost, abs=1e-7)


def test_whole_nodes_spare_the_comparing_of_points(monkeypatch):
    tree, seen = lloyd.Tree.of(_clouds(60_000)), []
    nearest = lloyd._nearest
    monkeypatch.setattr(lloyd, "_nearest", lambda x, c: seen.append(x.shape[1]) or nearest(x, c))
    lloyd.center_sums(tree, _clouds(4, 1))
    assert sum(seen) < 30_000


def test_far_points_come_with_their_own_chance():
    points = np.vstack([_clouds(3000), [[400.0, 0, 0]]])
    centers = points[:3]
    own = ((points[:, None] - centers[None]) ** 2).sum(2).min(1)
    chance = np.minimum(1, own * 20 / own.sum())
    tree = lloyd.Tree.of(points)
    draws = [lloyd.far_points(tree, centers, 20 / own.sum(), np.random.default_rng(i)) for i in range(600)]
    assert np.mean([len(d) for d in draws]) == pytest.approx(chance.sum(), rel=0.1)
    assert all((d == points[-1]).all(1).sum() == 1 for d in draws)  # its chance is 1
    near = own < np.median(own[:-1])
    taken = sum(len(d) - np.isin(d[:, 0], points[~near, 0]).sum() for d in draws)
    assert taken / 600 == pytest.approx(chance[near].sum(), rel=0.3)


def test_a_worker_is_handed_one_block_at_a_time(spark, scaled, monkeypatch):
    monkeypatch.setattr(lloyd, "BLOCK_POINTS", 100)
    blocks = lloyd.write_blocks(scaled.data)

    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows]})
    got = [r["rows"] for r in blocks.table.mapInArrow(rows, "rows long").collect()]
    assert len(got) == len(blocks.sizes) >= 40 and set(got) == {1}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != "1"


def test_fits_are_lloyds_from_their_starts(scaled, x, monkeypatch):
    monkeypatch.setattr(lloyd, "BLOCK_POINTS", 300)
    blocks = lloyd.write_blocks(scaled.data)
    assert blocks.n == len(x) and len(blocks.sizes) > 10 and max(n for _, n in blocks.sizes) == 300
    jobs = [(2, 42), (3, 42), (3, 43), (7, 5)]
    for centers, fit, again in zip(lloyd.start_centers(blocks, jobs), lloyd.fit(blocks, jobs, 300),
                                   lloyd.fit(blocks, jobs, 300)):
        for steps in range(1, 301):
            sums = _plain_sums(x, centers)
            new = sums[:, 2:] / sums[:, :1]
            moved, centers = np.sqrt(((new - centers) ** 2).sum(1)).max(), new
            if moved <= lloyd.TOLERANCE:
                break
        assert fit.summary.numIter == steps
        assert np.allclose(fit.centers, centers, atol=1e-9)
        assert (fit.centers == again.centers).all()
        cost = ((x[:, None] - centers[None]) ** 2).sum(2).min(1).sum()
        assert fit.summary.trainingCost == pytest.approx(cost)


def test_restarts_are_as_good_as_those_of_spark(scaled):
    data = scaled.data.persist()
    for k in (3, 6):
        ours = mk.best_of(data, k, restarts=5, seed=7).summary.trainingCost
        theirs = min(KMeans(k=k, seed=s, maxIter=300, tol=1e-6).fit(data).summary.trainingCost
                     for s in range(7, 12))
        assert ours <= theirs * 1.02
    data.unpersist()


def test_silhouettes_and_labels_are_those_of_spark(scaled):
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="cluster")
    for e in mk.choose_k(scaled, ks=(2, 5, 8), restarts=2):
        labelled = e["model"].transform(scaled.data)
        assert dict(labelled.dtypes)["cluster"] == "int" and "_x" not in labelled.columns
        assert e["silhouette"] == pytest.approx(ev.evaluate(labelled), abs=1e-9)
        sizes = {r["cluster"]: r["count"] for r in labelled.groupBy("cluster").count().collect()}
        assert sizes == dict(enumerate(e["model"].sums[:, 0].astype(int)))


def test_fits_share_their_passes(spark, points):
    """Jobs don't grow with the restarts (18 or more a fit when each ran by itself)."""
    def last_job():
        return max(spark.sparkContext.statusTracker().getJobIdsForGroup() or [0])
    points.count()
    before = last_job()
    res = mk.cluster(points, ks=(2, 3, 4, 5), restarts_search=6, restarts_final=8)
    res["data"].unpersist()
    assert last_job() - before < 26 * 18 / 2


def test_few_different_points(spark):
    two = _frame(spark, [(50.0, 30.0, 1.0)] * 20 + [(50.5, 30.5, 9.0)] * 10)
    evals = mk.choose_k(mk.scale_points(two), ks=(2, 3, 4), restarts=2)
    assert [len(e["model"].centers) for e in evals] == [2, 2, 2]
    assert all(e["inertia"] == pytest.approx(0, abs=1e-9) and e["silhouette"] == pytest.approx(1) for e in evals)
    same = _frame(spark, [(50.0, 30.0, 1.0)] * 20)
    assert mk.cluster(same)["reason"] == "no_valid_k"
    # k >= n is skipped; a point alone has no silhouette.
    three = mk.choose_k(mk.scale_points(_frame(spark, [(0.0, 0.0, 0.0), (0.0, 0.0, 1.0), (9.0, 9.0, 9.0)])),
                        ks=(2, 3, 4), restarts=3)
    assert [e["k"] for e in three] == [2]
    assert three[0]["silhouette"] < 0.7


@pytest.mark.parametrize("odd", [float("nan"), float("inf")])
def test_points_must_be_finite(spark, odd):
    bad = spark.createDataFrame([([1.0, 2.0],), ([odd, 2.0],)], "x array<double>")
    with pytest.raises(Exception, match="neither NaN nor infinite"):
        lloyd.write_blocks(bad.select(array_to_vector("x").alias("features")))


@pytest.mark.parametrize("name", ["kmeans_select", "kmeans_facts", "kmeans_centers"])
def test_queries_share_the_passes_of_their_fits(spark, name):
    """100 fits at most, of 18 jobs or more each when they ran by themselves."""
    def last_job():
        return max(spark.sparkContext.statusTracker().getJobIdsForGroup() or [0])
    spark.range(1).count()
    before = last_job()
    rows = QUERIES[name](spark, SF01).collect()
    assert last_job() - before < 500
    if name == "kmeans_centers":
        points = mk.congested_points(mp.check_dataset(ml_dataset(spark, SF01), mp.ROAD_SPEC), mp.ROAD_SPEC)
        assert sum(r["size"] for r in rows) == points.count()
        assert [r["cluster_id"] for r in sorted(rows)] == list(range(len(rows)))
