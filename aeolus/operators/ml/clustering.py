"""K-means over congested points: k selection, restarts, centers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ...constants import K_CANDIDATES, KMEANS_RESTARTS_FINAL, KMEANS_RESTARTS_SEARCH, SEED
from . import lloyd
from .lloyd import Blocks, Fit
from .prep import DatasetSpec, scaler_stats

POINT_COLS = ("lat", "lon", "intensity")
MIN_POINTS = max(K_CANDIDATES) + 1


def congested_points(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Congested rows as (lat, lon, intensity), nulls dropped."""
    return (df.filter(F.col(spec.classification_target) == 1)
              .select("lat", "lon", F.col(spec.intensity).cast("double").alias("intensity"))
              .dropna())


@dataclass
class Scaled:
    data: DataFrame
    stats: dict[str, tuple[float, float]]


def scale_points(points: DataFrame) -> Scaled:
    """Standardised copies go into the ``features`` vector only; lat, lon and
    intensity keep their original units for the centers."""
    stats = scaler_stats(points, list(POINT_COLS))
    z = {f"_z_{c}": (F.col(c) - F.lit(m)) / F.lit(s if s > 0 else 1.0)
         for c, (m, s) in stats.items()}
    vec = VectorAssembler(inputCols=list(z), outputCol="features").transform(
        points.withColumns(z)).drop(*z)
    return Scaled(vec, stats)


# Independent fits (restarts, candidate k) share their passes over the points:
# a pass serves all that still move, instead of a chain of jobs for each.

def _fit_many(blocks: Blocks, jobs: list[tuple[int, int]], max_iter: int) -> dict[tuple[int, int], Fit]:
    return dict(zip(jobs, lloyd.fit(blocks, jobs, max_iter)))


def _lowest_cost(models: list[Fit]) -> Fit:
    # Stable: the first seed wins ties.
    best = models[0]
    for m in models[1:]:
        if m.summary.trainingCost < best.summary.trainingCost:
            best = m
    return best


def best_of(data: DataFrame, k: int, restarts: int, seed: int = SEED,
            max_iter: int = 300, blocks: Blocks | None = None) -> Fit:
    """``restarts`` seeded fits, keep the lowest cost. ``blocks``: the
    data as written before."""
    fits = _fit_many(blocks or lloyd.write_blocks(data), [(k, seed + r) for r in range(restarts)], max_iter)
    return _lowest_cost([fits[(k, seed + r)] for r in range(restarts)])


def choose_k(scaled: Scaled, ks=K_CANDIDATES, restarts: int = KMEANS_RESTARTS_SEARCH,
             seed: int = SEED, max_iter: int = 300, blocks: Blocks | None = None) -> list[dict]:
    """Silhouette per k (squared Euclidean, Spark's linear-cost form);
    k >= n and single-cluster results are skipped."""
    blocks = blocks or lloyd.write_blocks(scaled.data)
    ks = [k for k in ks if k < blocks.n]
    fits = _fit_many(blocks, [(k, seed + r) for k in ks for r in range(restarts)], max_iter)
    best = [(k, _lowest_cost([fits[(k, seed + r)] for r in range(restarts)])) for k in ks]
    best = [(k, m) for k, m in best if (m.sums[:, 0] > 0).sum() >= 2]
    return [{"k": k, "inertia": m.summary.trainingCost, "silhouette": s, "model": m}
            for (k, m), s in zip(best, lloyd.silhouettes(blocks, [m for _, m in best]))]


def pick_best(evals: list[dict]) -> int | None:
    """Highest silhouette; the first k wins ties."""
    best_k, best_s = None, -1.0
    for e in evals:
        if e["silhouette"] > best_s:
            best_k, best_s = e["k"], e["silhouette"]
    return best_k


def centers_from_labels(points: DataFrame, label: str = "cluster") -> DataFrame:
    """Centers in original units and sizes. For a converged model the
    center is the mean of its points, and the inverse scaling is linear, so
    this equals ``center * std + mean``."""
    return (points.groupBy(F.col(label).cast("int").alias("cluster_id"))
            .agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"),
                 F.avg("intensity").alias("intensity_mean"),
                 F.count(F.lit(1)).alias("size")))


def cluster(points: DataFrame, ks=K_CANDIDATES, restarts_search: int = KMEANS_RESTARTS_SEARCH,
            restarts_final: int = KMEANS_RESTARTS_FINAL, seed: int = SEED) -> dict:
    """M20-M24 composed: guard, selection, final fit, centers, inertia."""
    # The points are kept as they are: what was joined to find them runs once.
    points = points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = points.count()
        if n < MIN_POINTS:
            points.unpersist()
            return {"skipped": True, "reason": "insufficient_samples", "rows": n}
        scaled = scale_points(points)
        blocks = lloyd.write_blocks(scaled.data)
        evals = choose_k(scaled, ks, restarts_search, seed, blocks=blocks)
        k = pick_best(evals)
        if k is None:
            points.unpersist()
            return {"skipped": True, "reason": "no_valid_k", "rows": n}
        # Seeds seed..seed+restarts_search-1 were already fitted for this k
        # during selection (fits are deterministic per seed), so only the
        # remaining seeds run; the lower seeds keep priority on ties.
        searched = next(e["model"] for e in evals if e["k"] == k)
        extra = [(k, seed + r) for r in range(restarts_search, restarts_final)]
        fits = _fit_many(blocks, extra, 300) if extra else {}
        model = _lowest_cost([searched] + [fits[j] for j in extra]) \
            if restarts_final > restarts_search else best_of(scaled.data, k, restarts_final, seed, blocks=blocks)
        labelled = model.transform(scaled.data)
        sil = next(e["silhouette"] for e in evals if e["k"] == k)
        return {"skipped": False, "evaluations": evals, "best_k": k, "silhouette": sil,
                "inertia": float(model.summary.trainingCost),
                "model": model, "labelled": labelled, "data": points}
    except Exception:
        points.unpersist()
        raise
