"""N-gram Jaccard join over count vectors in an R-tree.

A document is the set of its word shingles. Shingles are hashed into groups,
and the counts by group are the document's point. Two sets share no more than
the sum over the groups of the smaller count; an R-tree over the points prunes
whole nodes by that bound, taken with the node's largest counts. Pairs of points
that survive are bounded again by sketches, a bit for each hash value that the set
has, among several values a shingle: a bit that only one set has is a shingle that
only it has. What is left is verified on the sets.

The work is dealt to tasks by rare shingles: sets that reach the similarity
share one of the first few of their shingles in any common order. Ordering by
how often a hashed bin of shingles is there over all documents keeps frequent
passages out of the keys. Sets that are equal are one class, and keys that have
the same documents count once. The documents of a task's keys make up one tree,
each key a branch below its root; all candidates come out of searches in it. In
a first round only the hub of each key is looked up, which joins groups of
copies by few links; in a second round all documents are, against those that
are not connected to them yet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeolus.llm.common import connected_components, materialise
from aeolus.llm.shingles import mix, shingle_sets

#: Coordinates of a point in the R-tree; and the most bits for each shingle, more
#: than half of them there, of the sketch by which surviving pairs are bounded again.
GROUPS, BITS = 64, 8
#: Bins by which the frequency of shingles is told, for the order of the keys.
BINS = 1 << 16
#: Children of a node of the R-tree; documents of a key in one tile; documents in
#: one tree, but for a last key's; pairs that a search compares at a time.
FANOUT, TILE, TREE_ROWS, PAIRS = 16, 2_048, 20_000, 1 << 15
#: Bytes of points and sketches in one tree, but for a last key's.
TREE_BYTES = 4 << 20
#: Documents of a key above which its rows have their sketches with them.
WIDE = 16
#: Pairs of sketches compared at a time, and their bytes.
SKETCHES, SKETCH_BYTES = 2_048, 2 << 20
#: Keys of wanted documents that may be broadcast to the scan of the texts.
BROADCAST_ROWS = 300_000


def least_overlap(a, b, num: int, den: int):
    """Common shingles that sets of sizes a and b need: num/den of their union."""
    return -(-num * (a + b) // (num + den))


# -- R-tree ---------------------------------------------------------------


class RTree:
    """Bulk-loaded R-tree over count vectors; nodes keep largest counts.

    ``group``: points of different groups (keys) never pair; a group is a branch
    of its own below the root. Within a group points are sorted by size, then
    tiled by the coordinate that varies most.
    """

    def __init__(
        self, points: np.ndarray, sizes: np.ndarray, owner: np.ndarray, num: int, den: int,
        group: np.ndarray | None = None,
    ):
        self.num, self.den = num, den
        #: Nodes and points that searches have compared.
        self.visited = [0, 0]
        group = np.zeros(len(points), np.int64) if group is None else group
        slab = np.lexsort((sizes, group))
        self.groups, first, count = np.unique(group[slab], return_index=True, return_counts=True)
        place = np.arange(len(points)) - np.repeat(first, count)
        step = FANOUT * np.maximum(1, np.sqrt(count / FANOUT).astype(np.int64))
        tile = np.empty(len(points), np.int64)
        tile[slab] = place // np.repeat(step, count)
        wide = points[:, int(points.var(0).argmax())] if len(points) else sizes
        self.order = np.lexsort((wide, tile, group))
        own = sizes[self.order], owner[self.order]
        level = (points[self.order], own[0], own[0], own[1], own[1])
        #: Per level: largest counts, least and largest size, least and largest owner.
        self.levels, self.children = [level], []
        while len(count) and count.max() > FANOUT:
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at = np.flatnonzero(at % FANOUT == 0)
            level = tuple(
                f.reduceat(x, at, axis=0)
                for f, x in zip((np.maximum, np.minimum, np.maximum, np.minimum, np.maximum), level)
            )
            self.children.append(np.append(at, count.sum()))
            self.levels.append(level)
            count = -(-count // FANOUT)
        self.roots = np.concatenate([[0], np.cumsum(count)])

    def _near(self, depth: int, points, sizes, owner, q, node) -> np.ndarray:
        """Which (query, node) pairs the bound doesn't exclude."""
        most, small, large, low, high = self.levels[depth]
        self.visited[depth == 0] += len(q)
        n = sizes[q]
        near = (large[node] * self.den >= n * self.num) & (small[node] * self.num <= n * self.den)
        near &= ~((low[node] == owner[q]) & (high[node] == owner[q]))
        k = np.flatnonzero(near)
        n, j = n[k], node[k]
        shared = np.minimum(points[q[k]], most[j]).sum(1, dtype=np.int64)
        need = least_overlap(n, np.maximum(small[j], -(-n * self.num // self.den)), self.num, self.den)
        return k[shared >= need]

    def search(
        self, points: np.ndarray, sizes: np.ndarray, owner: np.ndarray, group: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) pairs of a group and different owners that the bound doesn't exclude."""
        group = np.zeros(len(points), np.int64) if group is None else group
        at = np.searchsorted(self.groups, group)
        there = np.flatnonzero(np.append(self.groups, -1)[at] == group) if len(self.groups) else np.zeros(0, int)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        # Depth first in parts of bounded size.
        open_ = [(len(self.levels) - 1, there, self.roots[at[there]], self.roots[at[there] + 1])]
        while open_:
            depth, queries, low, high = open_.pop()
            width = high - low
            cuts = np.searchsorted(np.cumsum(width), np.arange(PAIRS, int(width.sum()) + PAIRS, PAIRS))
            a = 0
            for b in np.minimum(cuts + 1, len(queries)):
                if b > a:
                    n = width[a:b]
                    q = np.repeat(queries[a:b], n)
                    node = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - low[a:b], n)
                    k = self._near(depth, points, sizes, owner, q, node)
                    if not depth:
                        found.append((q[k], self.order[node[k]]))
                    elif len(k):
                        child = self.children[depth - 1]
                        open_.append((depth - 1, q[k], child[node[k]], child[node[k] + 1]))
                a = max(a, b)
        return tuple(np.concatenate(x) for x in zip(*found))


# -- documents to points --------------------------------------------------


def _batches(n: int, columns: list[str], make):
    """A mapInArrow function: keeps ``columns`` and adds what ``make`` gives a set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [make(s) for s in shingle_sets(batch.column("text"), n)]
            arrays = [batch.column(c) for c in columns]
            names = list(columns)
            for k, (name, kind) in enumerate(make.fields):
                arrays.append(pa.array([m[k] for m in made], kind))
                names.append(name)
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


class _Describe:
    """Size, fingerprint, keys and point of a set."""

    fields = [
        ("n", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()),
        ("keys", pa.list_(pa.int64())), ("point", pa.binary()), ("sketch", pa.binary()),
    ]

    def __init__(self, frequency: np.ndarray, num: int, den: int):
        self.frequency, self.num, self.den = frequency, num, den

    def __call__(self, s: np.ndarray):
        n = len(s)
        first = n - -(-self.num * n // self.den) + 1
        rare = np.lexsort((s, self.frequency[s & np.uint64(BINS - 1)]))[:first] if n else []
        fp1 = int(np.add.reduce(mix(s + np.uint64(1)), dtype=np.uint64)) if n else 0
        fp2 = int(np.bitwise_xor.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D)))) if n else 0
        group = s >> np.uint64(40)
        point = pack_counts(np.bincount(group & np.uint64(GROUPS - 1), minlength=GROUPS))
        return n, _signed(fp1), _signed(fp2), s[rare].view(np.int64), point, sketch(s)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs; that number comes first."""
    size = 1 if counts.max() < 1 << 8 else 2 if counts.max() < 1 << 16 else 4
    return bytes([size]) + counts.astype(f"<u{size}").tobytes()


def unpack_points(packed: list[bytes]) -> np.ndarray:
    """The points as rows."""
    out = np.empty((len(packed), GROUPS), np.int32)
    size = np.fromiter((p[0] for p in packed), np.uint8, len(packed))
    for k in np.unique(size):
        here = np.flatnonzero(size == k)
        rows = np.frombuffer(b"".join(packed[i] for i in here), np.uint8).reshape(len(here), -1)[:, 1:]
        out[here] = np.ascontiguousarray(rows).view(f"<u{k}")
    return out


def sketch(s: np.ndarray) -> bytes:
    """A bit for each value of a hash that the shingles have."""
    size = 1 << max(GROUPS.bit_length() - 1, (BITS * len(s)).bit_length() - 1)
    bits = np.zeros(size, np.uint8)
    bits[(s >> np.uint64(24)) & np.uint64(size - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """The rows' sketches as those of hashes with fewer values."""
    return np.bitwise_or.reduce(bits.reshape(len(bits), -1, width), axis=1)


def shared_at_most(a: list[bytes], b: list[bytes], n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """For each pair of sketches and sizes, what the sets share at most: each bit
    of one alone is at least a shingle of it alone."""
    out = np.zeros(len(a), np.int64)
    wide = np.array([[len(x), len(y)] for x, y in zip(a, b)], np.int64).reshape(-1, 2)
    for of_a, of_b in np.unique(wide, axis=0):
        width = min(of_a, of_b) // 8
        all_here = np.flatnonzero((wide == (of_a, of_b)).all(1))
        step = max(1, SKETCH_BYTES // int(of_a + of_b))
        for at in range(0, len(all_here), step):
            here = all_here[at : at + step]
            x, y = (
                _folded(np.frombuffer(b"".join(of[i] for i in here), "<u8").reshape(len(here), -1), width)
                for of in (a, b)
            )
            alone = [np.bitwise_count(p & ~q).sum(1, dtype=np.int64) for p, q in ((x, y), (y, x))]
            out[here] = np.minimum(n_a[here] - alone[0], n_b[here] - alone[1])
    return out


class _Set:
    fields = [("shingles", pa.binary())]

    def __call__(self, s: np.ndarray):
        return (s.astype("<u8").tobytes(),)


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _frequencies(texts: DataFrame, n: int) -> np.ndarray:
    """Shingles in each bin over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            for s in shingle_sets(batch.column("text"), n):
                total += np.bincount(s & np.uint64(BINS - 1), minlength=BINS) if len(s) > BINS // 8 else 0
                if len(s) <= BINS // 8:
                    np.add.at(total, s & np.uint64(BINS - 1), 1)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bin", "n"])

    rows = (
        texts.select("text").mapInArrow(count, "bin long, n long")
        .groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    )
    out = np.zeros(BINS, np.int64)
    out[rows["bin"]] = rows["n"]
    return out


# -- pairs ----------------------------------------------------------------


def _candidates(num: int, den: int):
    """Pairs of different components in each group of (key, one, two).

    Rows of the group's tile ``one`` make up the tree; those marked ``asks`` are
    searched for. A block of whole groups is one tree. All rows of a key may have
    a ``sketch``: then the pairs found are those that it doesn't exclude either.
    """

    def groups(table: pa.Table) -> pa.RecordBatch:
        key, one, two, node, owner, sizes = (
            table.column(c).to_numpy() for c in ("key", "one", "two", "node", "component", "n")
        )
        held, asks = (table.column(c).to_numpy(zero_copy_only=False) for c in ("held", "asks"))
        points = unpack_points(table.column("point").to_pylist())
        group = np.concatenate([[0], np.cumsum((np.diff(key) != 0) | (np.diff(one) != 0) | (np.diff(two) != 0))])
        tree = RTree(points[held], sizes[held], owner[held], num, den, group[held])
        q, p = tree.search(points[asks], sizes[asks], owner[asks], group[asks])
        q, p = np.flatnonzero(asks)[q], np.flatnonzero(held)[p]
        # Each pair once, whichever of its documents asks.
        q, p = np.where(node[q] <= node[p], q, p), np.where(node[q] <= node[p], p, q)
        pairs, first = np.unique(np.stack([node[q], node[p]], 1), axis=0, return_index=True)
        differ = pairs[:, 0] != pairs[:, 1]
        pairs, first = pairs[differ], first[differ]
        if "sketch" in table.column_names and len(pairs):
            bits = table.column("sketch").combine_chunks()
            near = np.ones(len(first), bool)
            known = np.flatnonzero(bits.is_valid().to_numpy(zero_copy_only=False)[q[first]])
            for at in range(0, len(known), SKETCHES):
                here = known[at : at + SKETCHES]
                a, b = q[first[here]], p[first[here]]
                shared = shared_at_most(bits.take(a).to_pylist(), bits.take(b).to_pylist(), sizes[a], sizes[b])
                near[here] = shared >= least_overlap(sizes[a], sizes[b], num, den)
            pairs = pairs[near]
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = size = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            size += batch.nbytes
            if rows < TREE_ROWS and size < TREE_BYTES:
                continue
            # The last group may go on in the next batch.
            table = pa.Table.from_batches(held)
            ids = [table.column(c).to_numpy() for c in ("key", "one", "two")]
            other = np.flatnonzero(np.logical_or.reduce([x != x[-1] for x in ids]))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield groups(table.slice(0, cut))
            held, rows = table.slice(cut).to_batches(), table.num_rows - cut
            size = sum(b.nbytes for b in held)
        if rows:
            yield groups(pa.Table.from_batches(held))

    return run


def _search(rows: DataFrame, points: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate pairs of (key, one, two, node, component, held, asks).

    With a column ``wide``, those of wide keys are bounded by the sketch too:
    without, documents that resemble each other less than asked for give the
    square of their number. A narrow key gives a document few pairs at most, and
    its rows are spared the bytes.
    """
    own, given = ["n", "point"], [F.col("n"), F.col("point")]
    if "wide" in rows.columns:
        own, given = [*own, "sketch"], [*given, F.when(F.col("wide"), F.col("sketch")).alias("sketch")]
    return (
        rows.join(points.select("node", *own), "node")
        .select("key", "one", "two", "node", "component", "held", "asks", *given)
        .repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")
        .mapInArrow(_candidates(num, den), "src long, dst long")
        .distinct()
    )


def _unseen(pairs: DataFrame, seen: DataFrame) -> DataFrame:
    """The distinct pairs that aren't among those ``seen``.

    A pair comes out of the tree of each key it shares. The pairs are written
    before the join: Spark would put it below the search's ``distinct``, where
    it carries each of a pair's rows on.
    """
    return materialise(pairs, "pairs").join(seen, ["src", "dst"], "left_anti")


def _bounded(pairs: DataFrame, points: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs of nodes that their sketches don't exclude."""

    def finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            shared = shared_at_most(batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist(), a, b)
            yield batch.select(["src", "dst"]).filter(pa.array(shared >= least_overlap(a, b, num, den)))

    slim = points.select("node", "n", "sketch")
    return (
        pairs.join(slim.toDF("src", "n_a", "sketch_a"), "src").join(slim.toDF("dst", "n_b", "sketch_b"), "dst")
        .mapInArrow(finer, "src long, dst long")
    )


def _verify(near: DataFrame, points: DataFrame, texts: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The written pairs of nodes whose sets reach the similarity."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b")):
                a, b = np.frombuffer(a.as_buffer(), "<u8"), np.frombuffer(b.as_buffer(), "<u8")
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(both >= least_overlap(len(a), len(b), num, den))
            yield batch.select(["src", "dst"]).filter(pa.array(keep, pa.bool_()))

    wanted = (
        near.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
        .join(points.select("node", "id", "mark"), "node")
    )
    wanted = materialise(wanted, "wanted")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    sets = (
        texts.join(wanted, texts["id"].eqNullSafe(wanted["id"]) & (texts["mark"] == wanted["mark"]))
        .select("node", "text").mapInArrow(_batches(n, ["node"], _Set()), "node long, shingles binary")
        .groupBy("node").agg(F.first("shingles").alias("shingles"))  # repeated rows are one
    )
    sets = materialise(sets, "sets")
    return (
        near.join(sets.toDF("src", "set_a"), "src").join(sets.toDF("dst", "set_b"), "dst")
        .mapInArrow(exact, "src long, dst long")
    )


def jaccard_groups(documents: DataFrame, n: int = 3, num: int = 9, den: int = 10) -> DataFrame:
    """Components of the documents whose shingle sets' Jaccard is num/den or more.

    Null text, no words: size 0, linked with nothing. Fewer than n words: the
    whole sequence is the one shingle. Repeated rows and copies are linked.
    Returns one row a document: id (doc_id), mark (64-bit hash of the text),
    n_shingles, component_id (smallest id reachable), kept (one row of each
    component, and of equal rows, has true).
    """
    texts = documents.select(
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    describe = _Describe(_frequencies(texts, n), num, den)
    rows = materialise(
        texts.mapInArrow(
            _batches(n, ["id", "mark"], describe),
            "id long, mark long, n long, fp1 long, fp2 long, keys array<long>, point binary, sketch binary",
        ).withColumn("row", F.monotonically_increasing_id()),
        "rows",
    )
    own = ["n", "fp1", "fp2"]
    classes = rows.where("n > 0").groupBy(*own).agg(
        F.min("row").alias("node"), F.min(F.struct(F.col("id"), F.col("row"))).alias("low")
    )
    classes = materialise(classes, "classes")
    points = materialise(
        rows.join(classes.select(F.col("node").alias("row")), "row")
        .select(F.col("row").alias("node"), "id", "mark", "n", "keys", "point", "sketch"),
        "points",
    )
    # Of keys that have the same documents one is enough.
    keys = points.select(F.explode("keys").alias("key"), "node")
    wide = (
        keys.groupBy("key").agg(
            F.count("*").alias("width"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("same"),
            F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("same2"),
        )
        .where("width > 1").groupBy("width", "same", "same2").agg(F.min("key").alias("key"))
    )
    postings = materialise(keys.join(wide.select("key", "width"), "key"), "postings")
    tiles = F.ceil(F.col("width") / TILE).cast("int")
    own_tile = F.pmod(F.xxhash64("node"), tiles).cast("int")

    # A document of many shared keys is the hub of its keys: looked up in each of
    # their tiles.
    weight = postings.groupBy("node").agg(F.sum("width").alias("weight"))
    hubs = postings.join(weight, "node").groupBy("key").agg(
        F.max(F.struct("weight", "node")).alias("hub")
    ).select("key", F.col("hub.node").alias("hub"))
    around = (
        postings.join(hubs, "key").withColumn("asks", F.col("node") == F.col("hub"))
        .withColumn("one", F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), tiles - 1)).otherwise(F.array(own_tile))))
        .withColumn("two", F.col("one")).withColumn("component", F.col("node")).withColumn("held", ~F.col("asks"))
    )
    # A document asks for one hub a key here: the sketches go with the pairs.
    stars = materialise(_search(around, points, num, den), "stars")
    likely = materialise(_bounded(stars, points, num, den), "bounded")
    links = materialise(_verify(likely, points, texts, n, num, den), "links")
    joined = connected_components(links)

    # What the hubs left apart: every document in the tree of its key, by pairs of tiles.
    labelled = postings.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    apart = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    everyone = (
        labelled.join(apart.select("key"), "key").withColumn("tile", own_tile).withColumn("wide", F.col("width") > WIDE)
        .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
        .withColumn("one", F.least("tile", "other")).withColumn("two", F.greatest("tile", "other"))
        .withColumn("held", F.col("tile") == F.col("one")).withColumn("asks", F.col("tile") == F.col("two"))
    )
    rest = materialise(_unseen(_search(everyone, points, num, den), stars), "rest")
    more = _verify(rest, points, texts, n, num, den)
    found = connected_components(links.unionByName(more))

    grouped = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = grouped.groupBy("component").agg(F.min("low").alias("best"))
    named = grouped.join(lowest, "component").select(*own, "best")
    out = rows.select("id", "mark", "row", *own).join(named, own, "left")
    return out.select(
        "id", "mark", F.col("n").alias("n_shingles"),
        F.when(F.col("best").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("component_id"),
        F.when(F.col("best").isNull(), F.lit(True)).otherwise(F.col("best.row") == F.col("row")).alias("kept"),
    )
