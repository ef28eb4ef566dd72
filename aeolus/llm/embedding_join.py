"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine c are 2 - 2c apart in squared distance. After a random
rotation the coordinates are split into blocks; if the whole distance is within
the budget, some block's distance is within its share of it, in proportion to
the block's dimensions. Every block is range-joined under its own budget, and
the union of the candidates is verified by the cosine in double precision.

Vectors are dealt into tiles by the signs of their leading rotated coordinates.
A pair of tiles is visited only if the boxes around them come within the budget
in some block. A task holds two tiles and returns sums of links and the edges
of a spanning forest, no more rows than it has vectors. Equal vectors are one.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from aeolus.llm.common import connected_components, materialise

COSINE = 0.9
BLOCKS = 4
#: Vectors in a tile.
TILE = 8_192
#: Room for rounding in single precision; candidates are verified exactly.
SLACK = 1e-4
_STEP = 512


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def block_edges(dim: int) -> list[tuple[int, int]]:
    cuts = np.linspace(0, dim, min(BLOCKS, dim) + 1).astype(int).tolist()
    return list(zip(cuts, cuts[1:]))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, scaled first so that no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def linked(one: np.ndarray, two: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, row) pairs of unit vectors whose cosine is reached."""
    dim = one.shape[1]
    turn = rotation(dim)
    a, b = (one @ turn).astype(np.float32), (two @ turn).astype(np.float32)
    budget = 2 - 2 * cosine
    squares = [((b[:, x:y] ** 2).sum(1), x, y, budget * (y - x) / dim + SLACK) for x, y in block_edges(dim)]
    rows, cols = [], []
    for at in range(0, len(a), _STEP):
        part = a[at : at + _STEP]
        near = np.zeros((len(part), len(b)), bool)
        for square, x, y, most in squares:
            own = part[:, x:y]
            # |u - v|^2 <= most, by one product a block.
            near |= own @ b[:, x:y].T * 2 >= ((own**2).sum(1) - most)[:, None] + square
        i, j = np.nonzero(near)
        exact = np.einsum("ij,ij->i", one[at + i], two[j]) >= cosine
        rows.append(at + i[exact])
        cols.append(j[exact])
    none = [np.zeros(0, int)]
    return np.concatenate(rows or none), np.concatenate(cols or none)


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a forest with the components of the given edges."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _boxes(key, group: pd.DataFrame) -> pd.DataFrame:
    v = unit(np.stack(group["vector"].to_numpy())) @ rotation(int(key[0]))
    return pd.DataFrame({
        "dim": [key[0]], "cell": [key[1]], "sub": [key[2]],
        "low": [v.min(0).tolist()], "high": [v.max(0).tolist()],
    })


def _reach(cosine: float):
    @pandas_udf("boolean")
    def reach(low_a: pd.Series, high_a: pd.Series, low_b: pd.Series, high_b: pd.Series) -> pd.Series:
        out = []
        for la, ha, lb, hb in zip(low_a, high_a, low_b, high_b):
            gap = np.maximum(0, np.maximum(la - hb, lb - ha)) ** 2
            dim = len(gap)
            out.append(any(
                gap[x:y].sum() <= (2 - 2 * cosine) * (y - x) / dim + SLACK for x, y in block_edges(dim)
            ))
        return pd.Series(out, dtype=bool)

    return reach


def _join(cosine: float):
    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        vectors = unit(np.stack(group["vector"].to_numpy()))
        node, copies, home = (group[c].to_numpy() for c in ("node", "copies", "home"))
        same = key[0] == key[1]
        one = np.flatnonzero(home)
        two = one if same else np.flatnonzero(~home)
        i, j = linked(vectors[one], vectors[two], cosine)
        a, b = one[i], two[j]
        if same:  # found in both orders, and with itself
            a, b = a[a < b], b[a < b]
        links = np.bincount(a, copies[b], len(group)) + np.bincount(b, copies[a], len(group))
        with_links = np.flatnonzero(links)
        forest = np.array(spanning(len(group), a, b), int).reshape(-1, 2)
        return pd.DataFrame({
            "src": np.concatenate([node[with_links], node[forest[:, 0]]]),
            "dst": pd.array([None] * len(with_links) + node[forest[:, 1]].tolist(), "Int64"),
            "links": pd.array(links[with_links].astype("int64").tolist() + [None] * len(forest), "Int64"),
        })

    return run


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, tile: int = TILE) -> DataFrame:
    """Links and components of all vectors by cosine.

    A vector that is null, empty, zero, or holds null or non-finite components
    links with nothing; nor do vectors of different length. Repeated rows link
    with each other. Columns: vec_id, n_links, component_id, kept.
    """
    x = F.col("embedding").cast("array<double>")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(
        x, lambda v: v != 0
    )
    rows = materialise(
        embeddings.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.monotonically_increasing_id().alias("row"),
            F.when(F.coalesce(usable, F.lit(False)), x).alias("vector"),
        )
        .withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.xxhash64(F.lit(1), "vector")),
        "rows",
    )
    classes = materialise(
        rows.where("vector IS NOT NULL").groupBy("h1", "h2").agg(
            F.min("row").alias("node"), F.min("vec_id").alias("low"), F.count("*").alias("copies")
        ),
        "classes",
    )
    one_each = rows.select(F.col("row").alias("node"), "vector").join(classes.select("node", "copies"), "node")
    n = classes.count()
    bits = max(0, (n // tile).bit_length() - 1)

    @pandas_udf("long")
    def cell_of(vectors: pd.Series) -> pd.Series:
        out = []
        for v in vectors:
            lead = v / np.abs(v).max() @ rotation(len(v))[:, :bits]
            out.append(int((lead > 0) @ (1 << np.arange(lead.size)))if lead.size else 0)
        return pd.Series(out, dtype="int64")

    celled = materialise(
        one_each.withColumn("dim", F.size("vector")).withColumn("cell", cell_of("vector")), "celled"
    )
    subs = celled.groupBy("dim", "cell").agg(F.ceil(F.count("*") / tile).alias("subs"))
    # No more cells than vectors in a tile allow; a row a cell.
    tiled = materialise(
        celled.join(F.broadcast(subs), ["dim", "cell"])
        .withColumn("sub", F.pmod(F.xxhash64("node"), F.col("subs"))).drop("subs"),
        "tiled",
    )
    name = F.format_string("%d/%d/%d", "dim", "cell", "sub")
    boxes = materialise(
        tiled.groupBy("dim", "cell", "sub")
        .applyInPandas(_boxes, "dim int, cell long, sub long, low array<double>, high array<double>")
        .select("dim", name.alias("tile"), "low", "high"),
        "boxes",
    )
    # Pairs of tiles, not of vectors.
    pairs = (
        boxes.toDF("dim", "one", "low_a", "high_a").join(boxes.toDF("dim", "two", "low_b", "high_b"), "dim")
        .where("one <= two").where(_reach(cosine)("low_a", "high_a", "low_b", "high_b"))
        .select("one", "two")
    )
    visits = pairs.select("one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("tile"))
    found = materialise(
        tiled.withColumn("tile", name).join(visits, "tile")
        .select("one", "two", (F.col("tile") == F.col("one")).alias("home"), "node", "copies", "vector")
        .groupBy("one", "two").applyInPandas(_join(cosine), "src long, dst long, links long"),
        "found",
    )
    components = connected_components(found.where("dst IS NOT NULL").select("src", "dst"))
    links = found.where("links IS NOT NULL").groupBy("src").agg(F.sum("links").alias("links"))
    named = (
        classes.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
        .join(links.withColumnRenamed("src", "node"), "node", "left")
    )
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "component").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    out = rows.select("vec_id", "h1", "h2", F.col("vector").isNotNull().alias("usable")).join(
        named.withColumn("usable", F.lit(True)), ["h1", "h2", "usable"], "left"
    )
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), (F.col("vec_id") == component).alias("kept"),
    )
