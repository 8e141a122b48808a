"""Near-duplicate vectors by counting collisions on one-dimensional projections."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windward.llm.common import LocalComponents, components, mix
from windward.operators.lookup import lookup_join
from windward.session import stage

MIN_COSINE = 0.95
RECALL = 0.998
WIDTH = 2.5
PROJECTIONS = 16
CHUNK = 8_192
STEPS = 10  # steps of the coarse scale in half a window
SHIP, PAIR = 4.0, 0.006  # cost of a shuffled vector and of a compared pair, in microseconds
REACHED = 0.6  # share of all vectors that a cell's windows reach, per projection
SEED = 20240229


class Plan:
    """Projections, tables and the collisions a pair needs, for a recall at the similarity limit.

    The projections of two vectors on a Gaussian direction differ by a normal amount,
    so a pair at the limit collides in a window of ``WIDTH`` deviations with known
    probability. A table sorts the vectors by ``grid`` projections at once; a pair meets
    in it if it collides on all of them. The number of tables and the least count of
    collisions each use half of the misses the recall allows. Finer grids ship every
    vector more often and compare fewer pairs; the cheaper sum for n vectors is taken.
    """

    def __init__(self, n: int, min_cosine: float = MIN_COSINE, recall: float = RECALL) -> None:
        self.min_cosine = min_cosine
        self.reach = WIDTH * math.sqrt(2 - 2 * min_cosine)
        p, half = math.erf(WIDTH / math.sqrt(2)), (1 - recall) / 2

        def tables(grid: int) -> int:
            return max(1, math.ceil(math.log(half) / math.log(1 - p**grid)))

        self.grid = min(range(2, 13), key=lambda g: tables(g) * (SHIP * 2**g + PAIR * n * REACHED**g))
        self.tables = tables(self.grid)
        self.n = max(PROJECTIONS, self.tables * self.grid)
        chances = [math.comb(self.n, c) * p**c * (1 - p) ** (self.n - c) for c in range(self.n + 1)]
        self.least = next(c for c in range(self.n + 1) if sum(chances[:c + 1]) > half)

    def project(self, units: np.ndarray) -> np.ndarray:
        """Fixed Gaussian directions, the same in every task."""
        return units @ np.random.default_rng(SEED).standard_normal((units.shape[1], self.n))

    def on(self, table: int) -> slice:
        return slice(table * self.grid, (table + 1) * self.grid)


def unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that the squares neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def usable(vector: Column) -> Column:
    """The vector has a direction: no null, no non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def cells(classes: DataFrame, plan: Plan) -> DataFrame:
    """(t, cell, cls, base): every vector as base in its own cell of each table, and as query in all
    cells its windows reach. A cell is a stretch of sorted projections, one full window wide."""
    width = 2 * plan.reach

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.list_value_length(batch.column("v")).to_numpy()
            for dim in np.unique(lengths):
                part = batch.filter(pa.array(lengths == dim))
                v = np.asarray(part.column("v").flatten(), np.float64).reshape(-1, dim)
                x, cls = plan.project(unit(v)), part.column("cls").to_numpy()
                for t in range(plan.tables):
                    px = x[:, plan.on(t)]
                    own = np.floor(px / width).astype(np.int64)
                    side = np.where(px - own * width < plan.reach, -1, 1)
                    for corner in range(2**plan.grid):
                        cell = own + side * [(corner >> g) & 1 for g in range(plan.grid)]
                        key = np.full(len(cls), t << 20 | int(dim), np.uint64)
                        for g in range(plan.grid):
                            key = mix(key * np.uint64(3) + cell[:, g].astype(np.uint64))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(cls), t, np.int32)), pa.array(key.view(np.int64)), pa.array(cls), pa.array(np.full(len(cls), corner == 0))],
                            ["t", "cell", "cls", "base"])

    return classes.select("cls", "v").mapInArrow(run, "t int, cell long, cls long, base boolean")


def links(classes: DataFrame, plan: Plan) -> DataFrame:
    """(node, root, n): per task and class, vectors of other classes linked, and the least class connected.

    ``classes``: cls, v, n (vectors of that class). Cells are cut into chunks of bases
    and of queries, so that a cell that holds a third of all vectors is spread over tasks
    of bounded size. Pairs never leave the task: a class gets the count of its links
    and one edge to the smallest class it is connected with. A linked pair is counted in
    the first table in which it meets.
    """
    rows = stage(cells(classes, plan), "cells")
    sizes = rows.groupBy("cell").agg(F.sum(F.col("base").cast("long")).alias("bases"), F.count("*").alias("queries")).filter("bases > 0 and queries > 1")
    sized = lookup_join(rows, sizes, ["cell"], "inner")
    # role 0: base, 1: query; a base is a query in its own cell as well.
    roles = sized.withColumn("role", F.explode(F.when(F.col("base"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))))
    n_base, n_query = F.ceil(F.col("bases") / CHUNK), F.ceil(F.col("queries") / CHUNK)
    is_base = F.col("role") == 0
    dealt = roles.withColumns({
        "mine": F.pmod(F.xxhash64("cls"), F.when(is_base, n_base).otherwise(n_query)),
        "other": F.explode(F.sequence(F.lit(0), F.when(is_base, n_query).otherwise(n_base) - 1))})
    dealt = dealt.select("t", "cell", "cls", "role", F.when(is_base, F.col("mine")).otherwise(F.col("other")).alias("bc"),
                         F.when(is_base, F.col("other")).otherwise(F.col("mine")).alias("qc"))
    full = lookup_join(dealt, classes.select("cls", "v", "n"), ["cls"], "inner")
    schema = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("n", pa.int64())])

    def count(key: tuple, group: pa.Table) -> pa.Table:
        t, role = key[0].as_py(), group.column("role").to_numpy()
        b, q = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        if not len(b) or not len(q):
            return schema.empty_table()
        cls, n = group.column("cls").to_numpy(), group.column("n").to_numpy()
        v = unit(np.asarray(pa.concat_arrays([c.flatten() for c in group.column("v").chunks]), np.float64).reshape(len(role), -1))
        x = plan.project(v)
        step = plan.reach / STEPS
        # A coarse scale of bytes: whatever lies in a window is within STEPS + 1 of it there.
        coarse = np.ascontiguousarray(np.clip(np.floor(x / step), -60, 60).astype(np.int8).T)
        found, counts = LocalComponents(cls), np.zeros(len(role), np.int64)
        rest = np.ascontiguousarray(coarse[:, q])
        for s in range(0, len(b), 512):
            part = b[s:s + 512]
            hits = np.zeros((len(part), len(q)), np.uint8)
            gap = np.empty((len(part), len(q)), np.int8)
            near = np.empty((len(part), len(q)), bool)
            for j in range(plan.n):
                np.subtract(coarse[j, part][:, None], rest[j][None, :], out=gap)
                np.abs(gap, out=gap)
                np.less_equal(gap, STEPS + 1, out=near)
                np.add(hits, near, out=hits, casting="unsafe")
            for i in range(len(part)):
                k = q[np.flatnonzero(hits[i] >= plan.least)]
                a = part[i]
                k = k[v[k] @ v[a] >= plan.min_cosine - 1e-9]
                k = k[cls[k] != cls[a]]
                if not len(k):
                    continue
                k = k[np.einsum("ij,j->i", v[k], v[a]) >= plan.min_cosine]
                close = np.abs(x[k] - x[a]) <= plan.reach
                mine = close[:, plan.on(t)].all(axis=1) & (close.sum(axis=1) >= plan.least)
                for earlier in range(t):
                    mine &= ~close[:, plan.on(earlier)].all(axis=1)
                k = k[mine]
                counts[a] += n[k].sum()
                found.join(np.full(len(k), a), k)
        node, root = found.edges()
        own = np.flatnonzero(counts)
        return pa.Table.from_arrays(
            [pa.array(np.concatenate([node, cls[own]])), pa.array(np.concatenate([root, cls[own]])),
             pa.array(np.concatenate([np.zeros(len(node), np.int64), counts[own]]))], schema=schema)

    return full.groupBy("t", "cell", "bc", "qc").applyInArrow(count, "node long, root long, n long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    min_cosine: float = MIN_COSINE, recall: float = RECALL) -> DataFrame:
    """Per vector: how many others it links to, its component and whether it is the one kept.

    Pairs of cosine >= ``min_cosine`` in double precision link; one at the limit is found
    with probability ``recall`` or more, a closer one more surely; none below it links.
    Equal vectors form a class and are compared once. Null, empty, zero vectors and
    those with null or non-finite components link with nothing, vectors of other
    lengths neither. Rows that repeat id and vector are one vector, with one row each; null ids are
    ids like others. An empty table gives an empty result.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    rows = rows.withColumn("cls", F.when(usable(F.col("v")), F.xxhash64("v")))
    ids = stage(rows.select("vec_id", "cls"), "vector-ids")
    sizes = ids.filter("cls is not null").distinct().groupBy("cls").agg(F.count("*").alias("n"))
    classes = stage(lookup_join(rows.filter("cls is not null").groupBy("cls").agg(F.first("v").alias("v")), sizes, ["cls"], "inner"), "vector-classes")
    plan = Plan(classes.count(), min_cosine, recall)
    found = stage(links(classes, plan), "vector-links")
    counts = lookup_join(sizes, found.groupBy("node").agg(F.sum("n").alias("links")).withColumnRenamed("node", "cls"), ["cls"]).select(
        "cls", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    groups = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")), "vector-components")
    named = lookup_join(counts, groups.withColumnRenamed("node", "cls"), ["cls"]).withColumn("component", F.coalesce("component", "cls"))
    out = lookup_join(ids, named, ["cls"])
    least = out.filter("cls is not null").groupBy("component").agg(F.min("vec_id").alias("least"))
    out = lookup_join(out, least, ["component"])
    own = F.coalesce(F.when(F.col("cls").isNotNull(), F.col("least")), F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
                      F.col("vec_id").eqNullSafe(own).alias("kept"))
