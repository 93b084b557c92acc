"""Embedding near-duplicates: exact threshold pairs by dual traversal of cover trees.

Unit vectors are arranged in levels of nodes with halving radii: a level's
nodes are further apart than its radius, every vector is within it of one of
them, and a node stays a node on all lower levels.  Two trees are traversed
together from their roots; a pair of nodes is dropped as soon as their
distance exceeds both covering radii plus the distance that the threshold
allows, and its children are never looked at.

Spark deals the work out: the top levels, fitted on a bounded sample, cut the
space into cells; cells are cut into units of a few thousand vectors by a
hash, and each unit gets its tree.  Consecutive units form blocks.  A task takes
a pair of blocks that the bounds cannot part and traverses all their pairs of
units, so a vector is sent once for each block, not for each unit, that it is
compared with.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import connected_components, read_table, staged

THRESHOLD = 0.9
#: Vectors of a unit, on average, and of the sample that the cells are fitted on.
UNIT, SAMPLE = 4_096, 2_048
#: Cells at most: the lowest level of the sample's tree with no more nodes is used.
CELLS = 256
#: Blocks at least (where there are as many units), so that there are tasks to
#: deal out, and units of a block at most, which bounds a task's memory: some
#: 140 MB for two blocks of 64 dimensions.
LEAST_BLOCKS, BLOCK_UNITS = 4, 16
#: Radii of the levels: any two unit vectors are within 2.
RADII = tuple(2.0 ** (1 - k) for k in range(6))
_ROWS, _PAIRS = 1_024, 1 << 15
_SLACK = 1e-9


def unit_vectors(vectors) -> np.ndarray:
    """Vectors scaled to length one, in double precision."""
    x = np.asarray(vectors, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (x @ y.T), 0.0))


def nested_nets(x: np.ndarray, radii=RADII) -> np.ndarray:
    """The tree's paths: for each vector (row) and level (column), the row of
    the node that the vector is below."""
    n = len(x)
    paths = np.zeros((n, len(radii)), np.int64)
    if not n:
        return paths
    # single precision will do: covering radii are measured from what comes out
    above, rough = np.zeros(n, np.int64), x.astype(np.float32)
    for level, radius in enumerate(radii):
        least = np.float32(1.0 - radius * radius / 2 - 1e-6)
        here = np.full(n, -1, np.int64)
        alone = np.bincount(above, minlength=n)[above] == 1
        here[alone] = np.flatnonzero(alone)
        by = np.argsort(above, kind="stable")
        by = by[~alone[by]]
        for members in np.split(by, np.flatnonzero(np.diff(above[by])) + 1) if len(by) else ():
            # nested: a node comes first among those below it
            members = np.concatenate(([above[members[0]]], members[members != above[members[0]]]))
            gap = rough[members] @ rough[members].T >= least if len(members) <= 2 * UNIT else None
            free = np.ones(len(members), bool)
            for k, row in enumerate(members.tolist()):
                if free[k]:
                    near = gap[k] if gap is not None else rough[members] @ rough[row] >= least
                    near = near & free
                    near[k] = True
                    here[members[near]] = row
                    free &= ~near
        paths[:, level] = above = here
    return paths


class Tree:
    """Levels of nodes, rebuilt from vectors and their paths."""

    def __init__(self, x: np.ndarray, paths: np.ndarray):
        self.x, self.levels = x, []
        self.rough = x.astype(np.float32)
        #: For each level, the place of each vector's node among the level's nodes.
        self.at: list[np.ndarray] = []
        #: Levels that are not the one above over again.
        self.differs = [k == 0 or bool((paths[:, k] != paths[:, k - 1]).any()) for k in range(paths.shape[1])]
        parent = np.zeros(len(x), np.int64)
        for level in range(paths.shape[1]):
            nodes, at = np.unique(paths[:, level], return_inverse=True)
            far = np.sqrt(np.maximum(((x - x[paths[:, level]]) ** 2).sum(axis=1), 0.0))
            radius = np.zeros(len(nodes))
            np.maximum.at(radius, at, far)
            above = np.zeros(len(nodes), np.int64)
            above[at] = parent
            self.levels.append((nodes, radius, above))
            self.at.append(at)
            parent = at


def linked_pairs(a: Tree, b: Tree, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (row of a, row of b) with a cosine of at least ``threshold``.

    Levels are gone down together while they have fewer pairs of nodes than
    there are pairs of vectors; below, the vectors of the node pairs that are
    left are compared.  Single precision, with room for its rounding, is enough
    to drop pairs; what it leaves is decided in double precision."""
    reach = np.sqrt(2.0 - 2.0 * threshold) + _SLACK
    room = 1e-6 + 5e-7 * a.x.shape[1]
    alive = np.ones((1, 1), bool)
    at_a, at_b = np.zeros(len(a.x), np.int64), np.zeros(len(b.x), np.int64)
    for level, ((na, ra, pa), (nb, rb, pb)) in enumerate(zip(a.levels, b.levels, strict=True)):
        if not (a.differs[level] or b.differs[level]):
            continue  # the same nodes as above, already compared
        if 2 * len(na) * len(nb) > len(a.x) * len(b.x):
            break
        kept = np.zeros((len(na), len(nb)), bool)
        for start in range(0, len(na), _ROWS):
            rows = np.arange(start, min(start + _ROWS, len(na)))
            rows = rows[alive[pa[rows]].any(axis=1)]
            if not len(rows):
                continue
            columns = np.flatnonzero(alive[np.unique(pa[rows])].any(axis=0)[pb])
            cosine = a.rough[na[rows]] @ b.rough[nb[columns]].T
            # the distance is at most t where the cosine is at least 1 - t * t / 2
            near = cosine >= 1.0 - (ra[rows][:, None] + rb[columns] + reach) ** 2 / 2 - room
            kept[np.ix_(rows, columns)] = near & alive[np.ix_(pa[rows], pb[columns])]
        alive, at_a, at_b = kept, a.at[level], b.at[level]
        if not alive.any():
            break
    found = []
    some = np.argsort(at_a, kind="stable")  # neighbours have the same nodes to meet
    some = some[alive.any(axis=1)[at_a[some]]]
    for start in range(0, len(some), _ROWS):
        rows = some[start:start + _ROWS]
        columns = np.flatnonzero(alive[np.unique(at_a[rows])].any(axis=0)[at_b])
        i, j = np.nonzero(a.rough[rows] @ b.rough[columns].T >= np.float32(threshold - room))
        if not len(i):
            continue
        if 20 * len(i) > len(rows) * len(columns):
            i, j = np.nonzero(a.x[rows] @ b.x[columns].T >= threshold)
            i, j = rows[i], columns[j]
        else:
            i, j = rows[i], columns[j]
            exact = np.concatenate([np.einsum("ij,ij->i", a.x[i[k:k + _PAIRS]], b.x[j[k:k + _PAIRS]])
                                    for k in range(0, len(i), _PAIRS)]) >= threshold
            i, j = i[exact], j[exact]
        found.append((i, j))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def smallest_reached(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n rows, the smallest row that links (i, j) join it with."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks().flatten() if hasattr(column, "combine_chunks") else column.flatten()
    return flat.to_numpy().reshape(len(column), -1)


def _assign(pivots):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int32)
            far = np.zeros(batch.num_rows)
            size = np.array([len(v) for v in batch.column("embedding")])
            for dim in np.unique(size):
                rows = np.flatnonzero(size == dim)
                x = unit_vectors(_matrix(batch.column("embedding").take(pa.array(rows))))
                for start in range(0, len(rows), _ROWS):
                    part = rows[start:start + _ROWS]
                    gap = distances(x[start:start + _ROWS], pivots.value[int(dim)])
                    cell[part] = gap.argmin(axis=1)
                    far[part] = gap.min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(size.astype(np.int32)), pa.array(cell), pa.array(far)],
                names=[*batch.schema.names, "dim", "cell", "far"])

    return run


def _plant(table):
    """A unit's vectors with their paths through its tree."""
    import pyarrow as pa

    order = np.argsort(table.column("node").to_numpy())
    table = table.take(pa.array(order))
    paths = nested_nets(unit_vectors(_matrix(table.column("embedding"))))
    return table.append_column("place", pa.array(np.arange(len(paths)), pa.int32())).append_column(
        "path", pa.array(paths.astype(np.int32).tolist(), pa.list_(pa.int32())))


def _traverse(threshold: float):
    """Links of all pairs of units of two blocks (or within one)."""

    def run(table):
        import pyarrow as pa

        nodes, weights = (table.column(c).to_numpy() for c in ("node", "copies"))
        units, place = table.column("unit").to_numpy(), table.column("place").to_numpy()
        side = table.column("side").to_numpy()
        x, paths = unit_vectors(_matrix(table.column("embedding"))), _matrix(table.column("path"))
        trees = []
        for u in np.unique(units).tolist():
            own = np.flatnonzero(units == u)
            own = own[np.argsort(place[own])]
            trees.append((int(side[own[0]]), own, Tree(x[own], paths[own])))
        within = not side.any()
        label, links = np.arange(len(nodes)), np.zeros(len(nodes))
        for k, (side_a, rows_a, a) in enumerate(trees):
            for m, (side_b, rows_b, b) in enumerate(trees[k:], k):
                if side_a == side_b and not within:
                    continue
                i, j = linked_pairs(a, b, threshold)
                i, j = rows_a[i], rows_b[j]
                if m == k:  # a unit with itself: each pair comes both ways
                    i, j = i[i != j], j[i != j]
                    links += np.bincount(i, weights[j], len(nodes))
                elif len(i):
                    links += np.bincount(i, weights[j], len(nodes)) + np.bincount(j, weights[i], len(nodes))
                if len(i):  # what was joined before is summed up in the labels
                    every = np.arange(len(nodes))
                    label = smallest_reached(len(nodes), np.concatenate((i, every)), np.concatenate((j, label)))
        linked = np.flatnonzero(links)
        return pa.table([pa.array(c, pa.int64()) for c in (nodes[linked], nodes[label[linked]], links[linked].astype(np.int64))],
                        names=["a", "b", "links"])

    return run


def _blocks(cells: list, pivots: dict, reach: float) -> tuple[list, list, int]:
    """Where units and blocks go: for each cell (dim, cell, units, far), its
    first unit's number; the pairs of blocks to compare; the number of units.

    Units are numbered by dimension and cell, blocks are runs of them.  Two
    blocks are compared if they have cells that the triangle inequality does not
    part, by the distance of their pivots and the reach of their vectors."""
    first, pairs, units = [], [], 0
    blocks = 0
    for dim in sorted({c[0] for c in cells}):
        own = sorted(c for c in cells if c[0] == dim)
        counts, far = np.array([c[2] for c in own]), np.array([c[3] for c in own])
        centre = np.array([pivots[dim][c[1]] for c in own])
        # distances of nearly equal vectors are only good to some 1e-8
        meets = distances(centre, centre) <= far[:, None] + far + reach + 1e-6
        size = min(BLOCK_UNITS, max(1, -(-int(counts.sum()) // LEAST_BLOCKS)))
        cell_of = np.repeat(np.arange(len(own)), counts)
        block_of = np.arange(len(cell_of)) // size
        holds = np.zeros((int(block_of[-1]) + 1, len(own)), np.float32)
        holds[block_of, cell_of] = 1
        left, right = np.nonzero(np.triu(holds @ meets.astype(np.float32) @ holds.T > 0))
        pairs += [(blocks + a, blocks + b) for a, b in zip(left.tolist(), right.tolist(), strict=True)]
        starts = np.cumsum(counts) - counts
        first += [(dim, c[1], c[2], units + int(start), units, size, blocks) for c, start in zip(own, starts, strict=True)]
        units += len(cell_of)
        blocks += len(holds)
    return first, pairs, units


def _pivots(sample: list, most: int = CELLS) -> dict[int, np.ndarray]:
    """For each dimension, the nodes of the lowest level with at most ``most``."""
    out = {}
    for dim in {len(v) for v in sample}:
        x = unit_vectors([v for v in sample if len(v) == dim])
        paths = nested_nets(x)
        level = max(k for k in range(paths.shape[1]) if k == 0 or len(np.unique(paths[:, k])) <= most)
        out[dim] = x[np.unique(paths[:, level])]
    return out


def usable(vector):
    """Whether a vector can link: not null, without null or non-finite
    components, and not zero."""
    inf = F.lit(float("inf"))
    return F.coalesce(
        F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < inf))
        & F.exists(vector, lambda v: v != 0), F.lit(False))


def _one_a_partition(spark: SparkSession, n: int) -> list[int]:
    """``n`` numbers that a hash partitioning by number into ``n`` partitions
    deals to one partition each."""
    place = F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("place")
    tried = 16 * n
    while True:
        rows = spark.range(tried).groupBy(place).agg(F.min("id").alias("id")).collect()
        if len(rows) == n:
            return [r["id"] for r in rows]
        tried *= 2


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, unit: int = UNIT,
                    sample: int = SAMPLE) -> DataFrame:
    """``vec_id``, ``n_links`` (other vectors with a cosine of at least
    ``threshold``), ``component_id`` (smallest vec_id that links reach) and
    ``kept`` (vec_id = component_id) for every row of ``vectors`` (vec_id, embedding).

    All rows are compared whatever their other columns.  Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing, as do
    vectors of different lengths.  Rows with equal vectors are one node with a
    count, so copies cost nothing; repeated ids are rows like any others and a
    null id is ignored where the smallest is sought.  An empty table gives no
    rows.  The sample only decides how the work is cut, not what is found.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "embedding").withColumn("usable", usable(F.col("embedding")))
    classes = staged(rows.where("usable").groupBy("embedding").agg(
        F.min("vec_id").alias("low_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()), "vectors")
    total = classes.count()

    # cells: the top of the tree
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(2), "embedding"), 11).cast("double") / float(1 << 53)
    some = classes.where(chance < min(1.0, sample / max(total, 1))).select("embedding").union(
        classes.groupBy(F.size("embedding")).agg(F.min("embedding").alias("embedding")).select("embedding"))
    pivots = spark.sparkContext.broadcast(_pivots([r["embedding"] for r in some.collect()]))
    kind = classes.schema["embedding"].dataType.simpleString()
    dealt = classes.select("node", "copies", "embedding").mapInArrow(
        _assign(pivots), f"node long, copies long, embedding {kind}, dim int, cell int, far double")
    bounds = dealt.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()
    cells = [(r["dim"], r["cell"], -(-r["n"] // unit), r["far"]) for r in bounds]
    first, pairs, units = _blocks(cells, pivots.value, float(np.sqrt(2.0 - 2.0 * threshold)))
    # at most CELLS rows a dimension
    places = spark.createDataFrame(first, "dim int, cell int, units int, start int, base int, size int, blocks int")
    part = F.pmod(F.xxhash64(F.lit(3), "node"), F.col("units")).cast("int")
    planted = staged(dealt.join(F.broadcast(places), ["dim", "cell"])
                     .withColumn("unit", F.col("start") + part)
                     .withColumn("block", F.expr("blocks + (unit - base) div size").cast("int"))
                     .select("block", "unit", "node", "copies", "embedding")
                     .repartition(max(1, units), "unit").groupBy("unit").applyInArrow(
                         _plant, f"block int, unit int, node long, copies long, embedding {kind}, "
                                 "place int, path array<int>"), "trees")
    tasks = max(1, len(pairs))
    keys = _one_a_partition(spark, tasks)
    sides = [(a, k, 0) for (a, _), k in zip(pairs, keys)] + [(b, k, 1) for (a, b), k in zip(pairs, keys) if a != b]
    paired = planted.join(spark.createDataFrame(sides, "block int, pair int, side int"), "block")
    # a task for each pair of blocks: work grows with pairs of vectors, not with
    # bytes, which is what adaptive execution would size partitions by
    found = staged(paired.repartition(tasks, "pair").groupBy("pair").applyInArrow(
        _traverse(threshold), "a long, b long, links long"), "links")

    roots = connected_components(found.select("a", "b")).withColumnRenamed("node", "linked")
    linked = found.groupBy(F.col("a").alias("linked_a")).agg(F.sum("links").alias("links"))
    known = (classes.join(roots, F.col("node") == F.col("linked"), "left")
             .join(linked, F.col("node") == F.col("linked_a"), "left")
             .select(F.col("embedding").alias("vector"), "low_id", F.coalesce("root", "node").alias("root"),
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")))
    lowest = staged(known.groupBy("root").agg(F.min("low_id").alias("lowest")), "lowest")
    known = known.join(lowest, "root").select("vector", "lowest", "links")
    return (rows.join(known, F.col("usable") & (F.col("embedding") == F.col("vector")), "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("vector").isNull(), F.col("vec_id")).otherwise(F.col("lowest")).alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


QUERIES = {"op2_embeddings": op2_embeddings}
ORACLES: dict[str, str] = {}
