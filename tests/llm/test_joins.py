"""Joins against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from aeolus.llm import decontamination, embedding_join, ngram_join, shingles
from aeolus.llm.common import connected_components

SF = "/root/testdata/sf0.001"


def components(nodes, links):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text, n):
    own = words(text)
    return frozenset(tuple(own[i : i + n]) for i in range(max(1, len(own) - n + 1))) if own else frozenset()


def brute_groups(rows, n, num, den):
    sets = [shingle_set(t, n) for _, t in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])
    ]
    of = components(range(len(rows)), links)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[of[i]] = min(low.get(of[i], (1 << 60) if d is not None else -1), -1 if d is None else d)
    return sorted((-1 if d is None else d, len(sets[i]), low[of[i]]) for i, (d, _) in enumerate(rows))


@pytest.fixture(scope="module")
def near(spark, documents):
    """Documents with copies edited to around the similarity, and a hot group."""
    rng = random.Random(4)
    rows = [(r.doc_id, r.text) for r in documents.collect() if not r.text or len(r.text) < 20_000]
    base = [t.split() for _, t in rows if t and 60 < len(t.split()) < 900][:8]
    next_id = 20_000
    for own in base:
        for k in range(12):
            copy = list(own)
            for _ in range(rng.randint(0, 1 + len(own) // 40)):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(50)}"
            rows.append((next_id, " ".join(copy)))
            next_id += 1
    rows += [(next_id + k, "a b c") for k in range(20)] + [(next_id + 20 + k, f"a b c d{k % 3}") for k in range(9)]
    return rows, spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, node int, key int")


@pytest.mark.parametrize(("n", "num", "den", "tile"), [(3, 9, 10, 2048), (5, 4, 5, 2048), (3, 9, 10, 3)])
def test_jaccard_groups(near, monkeypatch, n, num, den, tile):
    monkeypatch.setattr(ngram_join, "TILE", tile)
    rows, frame = near
    got = ngram_join.jaccard_groups(frame, n, num, den).collect()
    assert sorted(
        (-1 if r.id is None else r.id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in got
    ) == brute_groups(rows, n, num, den)
    # One row of each group of documents with words stays.
    kept = [r for r in got if r.kept and r.n_shingles]
    assert len(kept) == len({r.component_id for r in got if r.n_shingles})


def test_no_groups(nothing):
    assert ngram_join.jaccard_groups(nothing).count() == 0


def test_shingles_of_long_and_short_texts(monkeypatch):
    texts = ["", None, "one", "Two words", "a b c d " * 500, "x" * 5000, " lead and trail ", "é Ä a"]
    want = [len(shingle_set(t, 3)) for t in texts]
    for segment in (1 << 20, 64, 7):
        monkeypatch.setattr(shingles, "SEGMENT", segment)
        got = list(shingles.shingle_sets(pa.array(texts, pa.string()), 3))
        assert [len(s) for s in got] == want
        if segment == 1 << 20:
            first = got
        assert all((a == b).all() for a, b in zip(got, first))


def test_rtree_finds_what_the_bound_allows():
    rng = np.random.default_rng(0)
    points = rng.poisson(3, (300, ngram_join.GROUPS))
    points[100:200] = points[:100] + (rng.random((100, ngram_join.GROUPS)) < 0.1)
    sizes, owner = points.sum(1), np.arange(300)
    tree = ngram_join.RTree(points, sizes, owner, 9, 10)
    got = set(zip(*(x.tolist() for x in tree.search(points, sizes, owner))))
    want = {
        (i, j) for i in range(300) for j in range(300) if i != j
        and np.minimum(points[i], points[j]).sum() >= ngram_join.least_overlap(sizes[i], sizes[j], 9, 10)
    }
    assert want <= got and len(got) <= len(want) + 10


@pytest.mark.parametrize("pairs", [50, 1 << 18])
def test_rtree_of_many_keys_against_all_pairs(monkeypatch, pairs):
    monkeypatch.setattr(ngram_join, "PAIRS", pairs)
    rng = np.random.default_rng(1)
    for keys, n in ((1, 0), (1, 500), (6, 500), (200, 700)):
        kinds = rng.integers(0, 4, (30, ngram_join.GROUPS))
        points = (kinds[rng.integers(0, 30, n)] + (rng.random((n, ngram_join.GROUPS)) < 0.03)).astype(np.int32)
        sizes, owner, group = points.sum(1).astype(np.int64), rng.integers(0, 40, n), rng.integers(0, keys, n)
        tree = ngram_join.RTree(points, sizes, owner, 9, 10, group)
        q, p = tree.search(points, sizes, owner, group)
        need = ngram_join.least_overlap(sizes[:, None], sizes, 9, 10)
        meets = np.minimum(points[:, None], points).sum(2) >= need if n else np.zeros((0, 0), bool)
        meets &= (10 * sizes >= 9 * sizes[:, None]) & (9 * sizes <= 10 * sizes[:, None])
        meets &= (group == group[:, None]) & (owner != owner[:, None])
        assert sorted(zip(q.tolist(), p.tolist())) == sorted(zip(*(x.tolist() for x in np.nonzero(meets))))
        # Nodes spare points: fewer are compared than all pairs of a key.
        if keys == 1 and n:
            assert len(tree.levels) == 3 and 0 < tree.visited[1] < n * n and tree.visited[0] > 0


def test_candidates_come_from_the_tree(monkeypatch):
    """Keys wider than a node and over several batches, with one tile and two."""
    trees = []

    class Watched(ngram_join.RTree):
        def __init__(self, *args):
            super().__init__(*args)
            trees.append(self)

    monkeypatch.setattr(ngram_join, "RTree", Watched)
    monkeypatch.setattr(ngram_join, "TREE_ROWS", 64)
    rng = np.random.default_rng(2)
    kinds = rng.integers(0, 5, (4, ngram_join.GROUPS))
    rows = []
    for key, (width, tiles) in enumerate([(3, 1), (90, 1), (40, 2), (200, 1), (2, 1)]):
        for _ in range(width):
            point = kinds[rng.integers(4)] + (rng.random(ngram_join.GROUPS) < 0.02)
            node, tile = len(rows), int(rng.integers(tiles))
            rows.append((key, tile, node, int(rng.integers(3)), int(point.sum()), point, tiles))
    dealt = []
    for key, tile, node, component, n, point, tiles in rows:
        for other in range(tiles):
            one, two = min(tile, other), max(tile, other)
            dealt.append((key, one, two, node, component, n, tile == one, tile == two, ngram_join.pack_counts(point)))
    dealt.sort(key=lambda r: r[:3])
    names = ["key", "one", "two", "node", "component", "n", "held", "asks", "point"]
    table = pa.table({name: [r[k] for r in dealt] for k, name in enumerate(names)})
    found = [b.to_pydict() for b in ngram_join._candidates(9, 10)(iter(table.to_batches(max_chunksize=25)))]
    got = {(a, b) for f in found for a, b in zip(f["src"], f["dst"])}
    want = {
        (a[2], b[2]) for a in rows for b in rows
        if a[0] == b[0] and a[2] < b[2] and a[3] != b[3] and 10 * a[4] >= 9 * b[4] and 10 * b[4] >= 9 * a[4]
        and np.minimum(a[5], b[5]).sum() >= ngram_join.least_overlap(a[4], b[4], 9, 10)
    }
    assert got == want and want
    assert any(len(t.levels) > 1 and t.visited[1] for t in trees)


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 30)] + [(50, 51), (51, 52)]])
def test_connected_components(spark, edges):
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == components({x for e in edges for x in e}, edges)


def brute_vectors(rows):
    usable = [
        (i, np.array(v)) for i, (_, v) in enumerate(rows)
        if v and None not in v and np.isfinite(v).all() and np.any(v)
    ]
    links = []
    for a, (i, x) in enumerate(usable):
        for j, y in usable[:a]:
            if len(x) == len(y):
                x1, y1 = x / np.abs(x).max(), y / np.abs(y).max()
                if x1 @ y1 / np.linalg.norm(x1) / np.linalg.norm(y1) >= 0.9:
                    links.append((i, j))
    n = np.bincount([x for e in links for x in e], minlength=len(rows))
    of = components(range(len(rows)), links)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[of[i]] = min(low.get(of[i], d), d)
    return sorted((d, int(n[i]), low[of[i]], d == low[of[i]]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("tile", [8192, 40])
def test_embedding_join(spark, tile):
    rng = np.random.default_rng(1)
    center = rng.normal(size=(20, 16))
    vectors = [(c + rng.normal(0, s, 16)).tolist() for c in center for s in (0, 0.1, 0.3, 0.4, 0.5, 0.5)]
    rows = [(100 + k, v) for k, v in enumerate(vectors)]
    rows += [(1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, []), (6, [float("inf"), 1.0])]
    rows += [(7, [1e-300, 0.0]), (8, [1e300, 0.0]), (9, [1.0]), (9, [1.0]), (10, vectors[0])]
    rows += [(1000 + k, vectors[6]) for k in range(30)]
    frame = spark.createDataFrame([(*r, 3, "x") for r in rows], "vec_id long, embedding array<double>, node int, cell string")
    got = embedding_join.near_duplicates(frame, tile=tile)
    assert sorted(map(tuple, got.collect())) == brute_vectors(rows)
    assert embedding_join.near_duplicates(frame.limit(0)).count() == 0


def edit(rng, text, n):
    own = list(text)
    for _ in range(n):
        at = rng.randrange(len(own))
        kind = rng.randrange(3)
        if kind == 0:
            own[at] = rng.choice("xyz")
        elif kind == 1:
            del own[at]
        else:
            own.insert(at, rng.choice("xyz"))
    return "".join(own)


def least_edits(item, text):
    """Sellers' algorithm in full."""
    cost = list(range(len(item) + 1))
    best = cost[-1]
    for c in text:
        before, cost = cost, [0]
        for i, p in enumerate(item):
            cost.append(min(before[i] + (p != c), before[i + 1] + 1, cost[i] + 1))
        best = min(best, cost[-1])
    return best


def test_decontamination(spark):
    rng = random.Random(2)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()][:12]
    clean = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(12).collect()]
    # Items of every length; the shortest within no edit.
    items += [(500, "zqx"), (501, "Qzz vqw"), (502, "xqz vqq wqj zz"), (503, "qzx vjq wxz qjj zzv xxq wq")]
    items += [(504, "zvq xjw qqz vvx jzq wwq xzj vqv zxx jq")]
    clean += clean[:5]
    plain = {i: decontamination.normalise(t)[0].strip() for i, t in items}
    rows, want = [], set()
    for k, (i, t) in enumerate(items):
        budget = int(len(plain[i]) * decontamination.EDITS)
        for m, edits in enumerate((0, budget // 2, budget, 2 * budget)):
            doc = 10 * k + m
            text = f"{clean[k][:300]} {edit(rng, t.upper().replace(' ', chr(10) + ' '), edits)} {clean[k][300:600]}"
            rows.append((doc, text))
            if least_edits(plain[i], decontamination.normalise(text)[0]) <= budget:
                want.add((doc, i))
    rows += [(900 + k, t) for k, t in enumerate(clean[:3])] + [(990, None), (991, ""), (0, rows[0][1])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([*items, (77, None), (78, " \n"), items[0]], "item_id long, text string")
    found = decontamination.contaminated(frame, bench).collect()
    held = {(r.id, r.item_id) for r in found}
    extra = {(d, i) for d, i in held - want if least_edits(plain[i], decontamination.normalise(dict(rows)[d])[0]) > len(plain[i]) * decontamination.EDITS}
    assert want <= held and not extra
    assert {i for _, i in held} == set(plain)
    assert sum(r.id == 0 for r in found) == 2 * sum(d == 0 for d, _ in held)
    for r in found:
        if r.edits == 0:
            own = decontamination.normalise(dict(rows)[r.id][r.begin : r.finish])[0]
            assert own == plain[r.item_id]
    assert decontamination.contaminated(frame.limit(0), bench).count() == 0
    assert decontamination.contaminated(frame, bench.limit(0)).count() == 0


def test_alignment():
    rng = random.Random(7)
    for _ in range(60):
        item = "".join(rng.choice("ab") for _ in range(12))
        text = "".join(rng.choice("ab") for _ in range(30))
        got = decontamination.align(item, text, -12, 30, 4)
        least = least_edits(item, text)
        assert (got is None) == (least > 4) and (got is None or got[0] == least)


def test_pairs_of_many_keys_reach_the_anti_join_once(spark):
    many = spark.range(40).selectExpr("id % 4 AS src", "id % 4 + 10 AS dst")
    seen = spark.createDataFrame([(0, 10)], "src long, dst long")
    out = ngram_join._unseen(many.distinct(), seen)
    assert sorted(map(tuple, out.collect())) == [(1, 11), (2, 12), (3, 13)]
    # Nothing is left to be deduplicated after the join, as when it ran below the distinct.
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_sketches_bound_what_sets_share():
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 2**63, 900, dtype=np.uint64))
    sets = [np.sort(base[rng.random(len(base)) < share]) for share in (0, 0.01, 0.1, 0.5, 0.8, 0.9, 0.95, 1) for _ in range(4)]
    pairs = [(a, b) for a in sets for b in sets]
    got = ngram_join.shared_at_most(
        [ngram_join.sketch(a) for a, _ in pairs], [ngram_join.sketch(b) for _, b in pairs],
        np.array([len(a) for a, _ in pairs]), np.array([len(b) for _, b in pairs]),
    )
    want = np.array([len(np.intersect1d(a, b)) for a, b in pairs])
    assert (got >= want).all()
    large = np.array([len(a) > 300 and len(b) > 300 for a, b in pairs])
    assert (got - want)[large].max() < 60


def test_documents_that_resemble_each_other_too_little_are_no_candidates():
    """A key whose documents share three quarters of a passage gives few pairs, not their square."""
    rng = np.random.default_rng(4)
    passage = np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64))
    sets = [
        np.unique(np.concatenate([passage, rng.integers(0, 2**63, 50, dtype=np.uint64)])) for _ in range(120)
    ] + [np.sort(np.append(passage, np.uint64(k))) for k in range(3)]
    described = [ngram_join._Describe(np.zeros(ngram_join.BINS, np.int64), 4, 5)(s) for s in sets]
    n = len(sets)
    table = pa.table({
        "key": [1] * n, "one": [0] * n, "two": [0] * n, "node": list(range(n)), "component": list(range(n)),
        "held": [True] * n, "asks": [True] * n, "n": [d[0] for d in described],
        "point": [d[4] for d in described], "sketch": [d[5] for d in described],
    })

    def pairs(table):
        return {(a, b) for f in ngram_join._candidates(4, 5)(iter(table.to_batches()))
                for a, b in zip(f.column("src").to_pylist(), f.column("dst").to_pylist())}

    links = {
        (i, j) for i in range(n) for j in range(i + 1, n)
        if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))
    }
    got, before = pairs(table), pairs(table.drop_columns(["sketch"]))
    assert links and links <= got <= before
    assert len(got) < len(links) + n < len(before)


def test_rows_of_narrow_keys_have_no_sketches():
    rng = np.random.default_rng(6)
    base = np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64))
    sets = [np.unique(np.append(base[rng.random(len(base)) < 0.9], np.uint64(k))) for k in range(30)]
    described = [ngram_join._Describe(np.zeros(ngram_join.BINS, np.int64), 4, 5)(s) for s in sets]
    keys = [1] * 6 + [2] * 24
    table = pa.table({
        "key": keys, "one": [0] * 30, "two": [0] * 30, "node": list(range(30)), "component": list(range(30)),
        "held": [True] * 30, "asks": [True] * 30, "n": [d[0] for d in described], "point": [d[4] for d in described],
        "sketch": pa.array([d[5] if k == 2 else None for k, d in zip(keys, described)], pa.binary()),
    })
    got = {(a, b) for f in ngram_join._candidates(4, 5)(iter(table.to_batches()))
           for a, b in zip(f.column("src").to_pylist(), f.column("dst").to_pylist())}
    links = {
        (i, j) for i in range(30) for j in range(i + 1, 30) if keys[i] == keys[j]
        and 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))
    }
    assert {keys[i] for i, _ in links} == {1, 2} and links <= got
