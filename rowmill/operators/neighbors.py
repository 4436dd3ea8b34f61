"""Exact nearest neighbours of every point, by cells of bounded size.

Points are dealt into balanced cells (median cuts learnt from sampled points; the
sample only places the cuts).  Each cell finds the best neighbours inside itself,
which bounds how far a better one can be.  A point then visits only the other
cells whose box reaches into that distance.  No pair of points is ever a row; a
task holds one cell and one bounded chunk of visitors.

Cells have two levels.  Up to ONE_LEVEL of them are coarse cells, cut by a tree that
the driver knows.  Beyond that there are as many coarse cells as the square root
of all, and every coarse cell is cut again by a tree of its own, grown in a task
from a sample of the cell.  These trees, and the boxes of the fine cells, are
tables: points meet them by a join on the coarse cell, in chunks.  So the driver
holds the square root of the number of cells, and no size is the last.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.ordering import unit_hash
from rowmill.sources.workdir import stage

ONE_LEVEL = 1_024
FINE_SHIFT = 32  # of the coarse number in the number of a cell
PART_ROWS = 2_000
SAMPLES_PER_CELL = 16
VISITORS_PER_TASK = 50_000
BLOCK_PAIRS = 2_000_000


class CellTree:
    """Median cuts: maps points to cell numbers."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.dim, self.cut, self.left, self.right = [], [], [], []
        self.cells = 0
        self.root = self._grow(sample, cells)

    def parts(self) -> tuple:
        """What a table row holds of the tree."""
        return self.root, self.dim, self.cut, self.left, self.right

    @classmethod
    def of_parts(cls, root, dim, cut, left, right) -> CellTree:
        tree = cls.__new__(cls)
        tree.root, tree.dim, tree.cut, tree.left, tree.right = int(root), dim, cut, left, right
        return tree

    def _grow(self, points: np.ndarray, cells: int) -> int:
        """Index of a new node; a leaf is coded as -1 - cell."""
        best = self._best_cut(points) if cells > 1 and len(points) > 1 else None
        if best is None:
            self.cells += 1
            return -self.cells
        dim, cut = best
        node = len(self.dim)
        for held, value in ((self.dim, dim), (self.cut, cut), (self.left, 0), (self.right, 0)):
            held.append(value)
        low = points[:, dim] <= cut
        half = cells // 2
        self.left[node] = self._grow(points[low], half)
        self.right[node] = self._grow(points[~low], cells - half)
        return node

    @staticmethod
    def _best_cut(points: np.ndarray) -> tuple[int, float] | None:
        """The widest dimension, cut so that both sides keep points."""
        spans = points.max(axis=0) - points.min(axis=0)
        dim = int(np.argmax(spans))
        if spans[dim] <= 0:
            return None
        values = np.sort(points[:, dim])
        cut = values[(len(values) - 1) // 2]
        if cut == values[-1]:
            cut = values[values < cut][-1]
        return dim, float(cut)

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        node = np.full(len(points), self.root)
        dim, cut = np.array(self.dim, dtype=int), np.array(self.cut)
        left, right = np.array(self.left, dtype=int), np.array(self.right, dtype=int)
        while (inner := np.flatnonzero(node >= 0)).size:
            at = node[inner]
            goes_left = points[inner, dim[at]] <= cut[at]
            node[inner] = np.where(goes_left, left[at], right[at])
        return -1 - node


def _boxes(points: np.ndarray, cells: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    low = np.stack([points[cells == c].min(axis=0) for c in range(count)])
    high = np.stack([points[cells == c].max(axis=0) for c in range(count)])
    return low, high


def _gap(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every query to every box, added up by dimension."""
    total = np.zeros((len(queries), len(low)))
    for j in range(queries.shape[1]):
        x = queries[:, j, None]
        total += np.maximum(0.0, np.maximum(low[None, :, j] - x, x - high[None, :, j])) ** 2
    return total


def _nearest_in(q: np.ndarray, p: np.ndarray, itself: np.ndarray, k: int):
    """Distances and positions of the k nearest points, equal distances in
    order of position; ``itself`` is a query's own position, or -1."""
    d = np.zeros((len(q), len(p)))
    for j in range(q.shape[1]):
        d += (q[:, j, None] - p[None, :, j]) ** 2
    rows = np.arange(len(q))
    own = itself >= 0
    d[rows[own], itself[own]] = np.inf
    dist, place = np.full((len(q), k), np.inf), np.full((len(q), k), -1)
    for t in range(min(k, len(p))):
        at = d.argmin(axis=1)
        dist[:, t], place[:, t] = d[rows, at], at
        d[rows, at] = np.inf
    return dist, place


def _best(queries: pd.DataFrame, points: pd.DataFrame, k: int, reach=None) -> list[list[tuple]]:
    """Per query the k nearest other points as (distance, id, vector, copies).

    A large cell is cut again inside the task, so that a query is compared with
    the few parts that its best distance reaches.
    """
    if points.empty:
        return [[] for _ in range(len(queries))]
    points = points.sort_values("id", kind="stable")
    ids, copies = points["id"].tolist(), points["copies"].tolist()
    q, p = np.stack(queries["vec"].to_numpy()), np.stack(points["vec"].to_numpy())
    itself = pd.Index(points["id"]).get_indexer(queries["id"])

    parts = max(1, len(p) // PART_ROWS)
    tree = CellTree(p[:: max(1, len(p) // (parts * SAMPLES_PER_CELL))], parts)
    part_of = tree.cell_of(p)
    low, high = _boxes(p, part_of, tree.cells)
    members = [np.flatnonzero(part_of == c) for c in range(tree.cells)]

    dist, place = np.full((len(q), k), np.inf), np.full((len(q), k), -1)
    limit = np.full(len(q), np.inf) if reach is None else reach.astype(float)

    def visit(rows: np.ndarray, held: np.ndarray) -> None:
        step = max(1, BLOCK_PAIRS // len(held))
        for s in range(0, len(rows), step):
            r = rows[s : s + step]
            local = np.searchsorted(held, itself[r])
            found = (local < len(held)) & (held[np.minimum(local, len(held) - 1)] == itself[r])
            d, at = _nearest_in(q[r], p[held], np.where(found, local, -1), k)
            d = np.concatenate([dist[r], d], axis=1)
            at = np.concatenate([place[r], np.where(at >= 0, held[at], -1)], axis=1)
            order = np.lexsort((at, d), axis=1)[:, :k]
            dist[r] = np.take_along_axis(d, order, axis=1)
            place[r] = np.take_along_axis(at, order, axis=1)

    step = max(1, BLOCK_PAIRS // len(members))
    nearest_part = np.concatenate(
        [_gap(q[s : s + step], low, high).argmin(axis=1) for s in range(0, len(q), step)]
    )
    for c, held in enumerate(members):
        visit(np.flatnonzero(nearest_part == c), held)
    for c, held in enumerate(members):
        gap = _gap(q, low[c : c + 1], high[c : c + 1])[:, 0]
        visit(np.flatnonzero((gap <= np.minimum(dist[:, -1], limit)) & (nearest_part != c)), held)

    vectors = p.tolist()
    return [
        [
            (float(x), ids[j], vectors[j], copies[j])
            for x, j in zip(dist[i], place[i])
            if np.isfinite(x) and x <= limit[i]
        ]
        for i in range(len(q))
    ]


def coarse_cells(cells: int) -> int:
    """How many of so many cells the driver knows."""
    return min(cells, max(ONE_LEVEL, math.isqrt(cells - 1) + 1))


def nearest_points(
    points: DataFrame, k: int, cell_rows: int = 4_000, visitors: int = VISITORS_PER_TASK
) -> DataFrame:
    """Adds ``near``, the k nearest other points by (distance, id), to a table
    of distinct points (id, vec, copies, ...)."""
    kind = points.schema["id"].dataType.simpleString()
    near_type = f"array<struct<d:double,id:{kind},vec:array<double>,copies:bigint>>"
    n = points.count()
    cells = math.ceil(n / cell_rows)
    names = points.columns

    tree, coarse = None, coarse_cells(cells) if cells else 0
    if cells > 1:
        points = stage(points, "neighbors-points")
        share = min(1.0, coarse * SAMPLES_PER_CELL / n)
        picked = points.filter(unit_hash(F.col("id"), "cells") < F.lit(share)).select("vec")
        sample = picked.limit(2 * coarse * SAMPLES_PER_CELL).toPandas()["vec"]
        tree = CellTree(np.stack(sample.to_numpy()), coarse) if len(sample) else None
    if tree is None:
        celled = points.withColumn("cell", F.lit(0).cast("bigint"))
    else:

        @F.pandas_udf("bigint")
        def cell_of(vec: pd.Series) -> pd.Series:
            return pd.Series(tree.cell_of(np.stack(vec.to_numpy())).astype(np.int64) << FINE_SHIFT)

        celled = points.withColumn("cell", cell_of("vec"))
        if coarse < cells:
            celled = _cut_again(stage(celled, "neighbors-coarse"), n, cells, cell_rows, visitors)

    def search_own(group: pd.DataFrame) -> pd.DataFrame:
        return group.assign(near=_best(group, group, k))

    own_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in celled.schema)
    local = celled.groupBy("cell").applyInPandas(search_own, f"{own_schema}, near {near_type}")
    if tree is None or (tree.cells <= 1 and coarse == cells):
        return local.drop("cell")

    local = stage(local, "neighbors-own-cell")
    far = _visit_other_cells(local, k, kind, near_type, visitors)
    merged = (
        local.select("id", "near").unionByName(far).groupBy("id")
        .agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))
    )
    return local.select(*names).join(merged, "id").select(*names, "near")


def _chunks(rows: DataFrame, key: str, most: int) -> DataFrame:
    """How many chunks of at most about ``most`` rows each key has."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("held"))
    return counts.select(key, F.ceil(F.col("held") / most).cast("int").alias("chunks"), "held")


def _dealt(rows: DataFrame, chunks: DataFrame, key: str) -> DataFrame:
    """Rows with the chunk of their key that their id falls into."""
    number = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    return rows.join(chunks.select(key, "chunks"), key).withColumn("chunk", number).drop("chunks")


def _in_all(rows: DataFrame, chunks: DataFrame, key: str) -> DataFrame:
    """Rows once for each chunk of their key."""
    each = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    return rows.join(chunks.select(key, "chunks"), key).withColumn("chunk", each).drop("chunks")


def _cut_again(celled: DataFrame, n: int, cells: int, cell_rows: int, visitors: int) -> DataFrame:
    """Points of coarse cells in the fine cells of a tree that each coarse cell grows."""
    chunks = stage(_chunks(celled, "cell", visitors), "neighbors-chunks")
    share = min(1.0, cells * SAMPLES_PER_CELL / n)
    picked = celled.filter(unit_hash(F.col("id"), "fine") < F.lit(share)).select("cell", "vec")
    sized = picked.join(chunks.select("cell", "held"), "cell")

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = CellTree(np.stack(group["vec"].to_numpy()), math.ceil(group["held"].iloc[0] / cell_rows))
        return pd.DataFrame([(group["cell"].iloc[0], *tree.parts())], columns=names)

    names = ["cell", "root", "dim", "cut", "left", "right"]
    shape = "cell bigint, root int, dim array<int>, cut array<double>, left array<int>, right array<int>"
    trees = stage(sized.groupBy("cell").applyInPandas(grow, shape), "neighbors-trees")

    def place(group: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        if len(tree) and len(group):
            row = tree.iloc[0]
            grown = CellTree.of_parts(*[row[c] for c in names[1:]])
            group = group.assign(cell=group["cell"] + grown.cell_of(np.stack(group["vec"].to_numpy())))
        return group[columns]

    columns = celled.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in celled.schema)
    return (
        _dealt(celled, chunks, "cell").groupBy("cell", "chunk")
        .cogroup(_in_all(trees, chunks, "cell").groupBy("cell", "chunk")).applyInPandas(place, schema)
    )


def _reached(numbers: np.ndarray, low: np.ndarray, high: np.ndarray, q, reach, own) -> list[list[int]]:
    """Per query the numbers of the boxes other than its own within its reach."""
    rows, out = max(1, BLOCK_PAIRS // max(1, len(numbers))), []
    for s in range(0, len(q), rows):
        gap = _gap(q[s : s + rows], low, high)
        hit = gap <= reach[s : s + rows, None]
        if own is not None:
            hit &= numbers[None, :] != own[s : s + rows, None]
        out += [numbers[row].tolist() for row in hit]
    return out


def _visit_other_cells(local, k, kind, near_type, visitors) -> DataFrame:
    dims = local.select(F.max(F.size("vec"))).collect()[0][0]
    low, high = ([f(F.get("vec", F.lit(j))) for j in range(dims)] for f in (F.min, F.max))
    boxes = stage(
        local.groupBy("cell").agg(F.array(*low).alias("low"), F.array(*high).alias("high"))
        .withColumn("coarse", F.shiftright("cell", FINE_SHIFT)), "neighbors-boxes",
    )
    ends = [f(F.get(c, F.lit(j))) for c, f in (("low", F.min), ("high", F.max)) for j in range(dims)]
    outer = boxes.groupBy("coarse").agg(F.count(F.lit(1)), *ends).collect()  # one row per coarse cell
    numbers = np.array([r[0] for r in outer])
    outer_low = np.array([r[2 : dims + 2] for r in outer], dtype=float)
    outer_high = np.array([r[dims + 2 :] for r in outer], dtype=float)

    @F.pandas_udf("array<bigint>")
    def coarse_reached(vec: pd.Series, reach: pd.Series) -> pd.Series:
        return pd.Series(_reached(numbers, outer_low, outer_high, np.stack(vec.to_numpy()), reach.to_numpy(), None))

    # with fewer than k neighbours at home nothing bounds the reach yet
    reach = F.when(F.size("near") >= k, F.get("near", F.lit(k - 1))["d"]).otherwise(
        F.lit(float("inf"))
    )
    visits = local.select("id", "vec", reach.alias("reach"), "cell").select(
        "id", "vec", "reach", "cell", F.explode(coarse_reached("vec", "reach")).alias("coarse")
    )
    if any(r[1] > 1 for r in outer):
        visits = _fine_visits(stage(visits, "neighbors-coarse-visits"), boxes, kind, visitors)
    else:
        visits = visits.join(F.broadcast(boxes.select("coarse", F.col("cell").alias("visited"))), "coarse").filter(
            "cell <> visited"
        ).select("id", "vec", "reach", F.col("visited").alias("cell"))
    visits = stage(visits, "neighbors-visits")
    chunks = stage(_chunks(visits, "cell", visitors), "neighbors-visit-chunks")
    visiting = _dealt(visits, chunks, "cell").select("cell", "chunk", "id", "vec", "reach")
    hosts = _in_all(local.select("cell", "id", "vec", "copies"), chunks, "cell").select(
        "cell", "chunk", "id", "vec", "copies"
    )

    def search(guests: pd.DataFrame, host: pd.DataFrame) -> pd.DataFrame:
        if guests.empty:
            return pd.DataFrame({"id": guests["id"], "near": []})
        near = _best(guests, host, k, guests["reach"].to_numpy())
        return pd.DataFrame({"id": guests["id"], "near": near})

    return (
        visiting.groupBy("cell", "chunk")
        .cogroup(hosts.groupBy("cell", "chunk"))
        .applyInPandas(search, f"id {kind}, near {near_type}")
    )


def _fine_visits(visits: DataFrame, boxes: DataFrame, kind: str, visitors: int) -> DataFrame:
    """The fine cells that visitors of coarse cells reach, but for their own."""
    chunks = stage(_chunks(visits, "coarse", visitors), "neighbors-coarse-chunks")

    def reached(guests: pd.DataFrame, box: pd.DataFrame) -> pd.DataFrame:
        if guests.empty or box.empty:
            return guests.iloc[:0][["id", "vec", "reach", "cell"]]
        found = _reached(
            box["cell"].to_numpy(), np.stack(box["low"].to_numpy()), np.stack(box["high"].to_numpy()),
            np.stack(guests["vec"].to_numpy()), guests["reach"].to_numpy(), guests["cell"].to_numpy(),
        )
        each = guests[["id", "vec", "reach"]].assign(cell=found).explode("cell")
        return each[each["cell"].notna()].astype({"cell": "int64"})

    return (
        _dealt(visits, chunks, "coarse").groupBy("coarse", "chunk")
        .cogroup(_in_all(boxes, chunks, "coarse").groupBy("coarse", "chunk"))
        .applyInPandas(reached, f"id {kind}, vec array<double>, reach double, cell bigint")
    )
