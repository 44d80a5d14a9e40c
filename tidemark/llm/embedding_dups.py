"""Embedding near-duplicates: a forest of random-projection trees with spill.

Trees are fitted on a sample of at most ``sample_rows`` vectors: a node splits its part of the
sample at the median of a random projection; vectors within ``spill`` of the median (a share of the
rows to each side) go to both children. Every vector is then routed through every tree, vectors
are compared within leaves, and links (cosine >= ``threshold`` in double precision) are united.

Equal vectors are one class with a count. A pair that meets in several leaves is counted in the
first common one only, which each row's list of leaves tells, so pairs are never written out: a leaf
gives counts and a spanning star per vector. A leaf of more than ``block`` vectors is split by hash
into blocks and compared block by block, all of them.

Defined results: vectors that are null, empty, zero or hold null or non-finite components have no
links and are their own component. Vectors of different length are never compared. Repeated rows
link with each other. An empty table gives no rows. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, stored


@dataclass
class Node:
    direction: np.ndarray | None = None
    low: float = 0.0  # rows above go right
    high: float = 0.0  # rows below go left
    left: "Node | None" = None
    right: "Node | None" = None
    leaf: int = -1


@dataclass
class Forest:
    trees: list[Node] = field(default_factory=list)
    leaves: int = 0

    def grow(self, sample: np.ndarray, rows: int, trees: int, leaf: int, spill: float, seed: int) -> None:
        """Trees whose leaves should hold about ``leaf`` of ``rows`` vectors."""
        random = np.random.default_rng(seed)
        scale = rows / max(1, len(sample))

        def split(part: np.ndarray) -> Node:
            if len(part) * scale > leaf and len(part) >= 16:
                direction = random.standard_normal(sample.shape[1])
                along = sample[part] @ direction
                low, middle, high = np.quantile(along, [0.5 - spill, 0.5, 0.5 + spill])
                left, right = part[along <= high], part[along >= low]
                if max(len(left), len(right)) < len(part):
                    return Node(direction, low, high, split(left), split(right))
            self.leaves += 1
            return Node(leaf=self.leaves - 1)

        self.trees += [split(np.arange(len(sample))) for _ in range(trees)]

    def route(self, vectors: np.ndarray) -> list[np.ndarray]:
        """The leaves of every vector, in ascending order."""
        rows, leaves = [], []
        for tree in self.trees:
            todo = [(tree, np.arange(len(vectors)))]
            while todo:
                node, part = todo.pop()
                if not len(part):
                    continue
                if node.direction is None:
                    rows.append(part)
                    leaves.append(np.full(len(part), node.leaf))
                    continue
                along = vectors[part] @ node.direction
                todo.append((node.left, part[along <= node.high]))
                todo.append((node.right, part[along >= node.low]))
        row, leaf = np.concatenate(rows), np.concatenate(leaves)
        order = np.lexsort((leaf, row))
        return np.split(leaf[order], np.cumsum(np.bincount(row, minlength=len(vectors)))[:-1])


def units(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as unit rows in double precision.

    Rows are divided by their largest component first: squares of extreme ones are 0 or infinite.
    """
    flat = np.asarray(column.flatten(), dtype=np.float64)
    rows = flat.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, initial=0.0, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def linked(
    unit: np.ndarray, block: np.ndarray, pair: tuple[int, int], leaf: int, leaves: list[np.ndarray],
    counts: np.ndarray, threshold: float, tile: int = 1024,
) -> tuple[np.ndarray, np.ndarray]:
    """Links of each row that are first met in ``leaf``, by class size; the least linked row."""
    n = len(unit)
    width = max(map(len, leaves))
    table = np.full((n, width), -1, np.int32)
    for i, x in enumerate(leaves):
        table[i, : len(x)] = x
    links, root = np.zeros(n, np.int64), np.arange(n)
    first = np.flatnonzero(block == pair[0])
    second = first if pair[0] == pair[1] else np.flatnonzero(block == pair[1])
    pairs_a, pairs_b = [], []
    for i in range(0, len(first), tile):
        a = first[i : i + tile]
        for j in range(i if pair[0] == pair[1] else 0, len(second), tile):
            b = second[j : j + tile]
            x, y = np.nonzero(unit[a] @ unit[b].T >= threshold)
            x, y = a[x], b[y]
            if pair[0] == pair[1]:
                x, y = x[x < y], y[x < y]
            for k in range(0, len(x), 1 << 14):
                u, v = x[k : k + (1 << 14)], y[k : k + (1 << 14)]
                # the first common leaf: nothing in common before this one
                before = np.where(table[u] < leaf, table[u], -1)
                seen = np.zeros(len(u), bool)
                for c in range(width):
                    here = before[:, c]
                    seen |= (here >= 0) & (table[v] == here[:, None]).any(axis=1)
                u, v = u[~seen], v[~seen]
                links += np.bincount(u, counts[v], n).astype(np.int64)
                links += np.bincount(v, counts[u], n).astype(np.int64)
                pairs_a.append(u)
                pairs_b.append(v)
    if pairs_a:
        u, v = np.concatenate(pairs_a), np.concatenate(pairs_b)
        while len(u):
            was = root.copy()
            least = np.minimum(root[u], root[v])
            np.minimum.at(root, u, least)
            np.minimum.at(root, v, least)
            root = root[root]
            if (root == was).all():
                break
    return links, root


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.9,
    trees: int = 8,
    leaf: int = 512,
    spill: float = 0.07,
    sample_rows: int = 20_000,
    block: int = 4096,
    seed: int = 7,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """One row per vector: its id, n_links, component_id, kept."""
    v = F.col(vector_column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(
        F.col(id_column).alias("id"), F.when(sound, v.cast("array<double>")).alias("v")
    ).withColumn("key", F.when(F.col("v").isNotNull(), F.concat_ws("-", F.xxhash64("v"), F.xxhash64(F.lit(1), "v"))))
    classes = stored(
        rows.where("v is not null")
        .groupBy("key")
        .agg(F.min("id").alias("class"), F.count("*").alias("n"), F.first("v").alias("v")),
        "vector-classes",
    )
    sizes = classes.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("rows")).collect()
    forests: dict[int, Forest] = {}
    total = sum(r.rows for r in sizes)
    begin = 0
    for r in sorted(sizes, key=lambda r: r.dim):
        share = min(1.0, sample_rows / max(1, total))
        picked = (
            classes.where(F.size("v") == r.dim)
            .where(F.xxhash64("class") / F.lit(2.0**64) + 0.5 <= share)
            .select("class", "v")
            .toArrow()
            .sort_by("class")
        )
        forest = Forest(leaves=begin)
        sample = units(picked.column("v").combine_chunks()) if len(picked) else np.zeros((0, r.dim))
        forest.grow(sample, r.rows, trees, leaf, spill, seed)
        forests[r.dim] = forest
        begin = forest.leaves

    kind = rows.schema["id"].dataType.simpleString()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("v").value_lengths())
            for dim in np.unique(dims):
                for begin in range(0, len(batch), 1024):
                    part = batch.slice(begin, 1024)
                    part = part.filter(pa.array(dims[begin : begin + 1024] == dim))
                    if not len(part):
                        continue
                    leaves = forests[int(dim)].route(units(part.column("v")))
                    row = np.repeat(np.arange(len(part)), [len(x) for x in leaves])
                    kept = part.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(leaves), pa.int32()),
                            *(kept.column(c) for c in ("class", "n", "v")),
                            pa.array([leaves[i] for i in row], pa.list_(pa.int32())),
                        ],
                        ["leaf", "class", "n", "v", "leaves"],
                    )

    exact = vectors.schema[vector_column].dataType.elementType.simpleString()
    routed = classes.select("class", "n", F.col("v").cast(f"array<{exact}>").alias("v")).mapInArrow(
        route, f"leaf int, class {kind}, n long, v array<{exact}>, leaves array<int>"
    )
    large = routed.groupBy("leaf").agg(F.count("*").alias("held")).where(F.col("held") > block)
    blocks = F.ceil(F.coalesce("held", F.lit(1)) / block).cast("int")
    placed = (
        routed.join(large, "leaf", "left")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "leaf", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
            "block", "class", "n", "v", "leaves",
        )
    )

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        leaf, p, q = (table.column(c)[0].as_py() for c in ("leaf", "p", "q"))
        ids = table.column("class")
        order = pa.compute.sort_indices(ids)
        table, ids = table.take(order), ids.take(order)
        links, root = linked(
            units(table.column("v").combine_chunks()), np.asarray(table.column("block")), (p, q), leaf,
            [np.asarray(x) for x in table.column("leaves").to_numpy(zero_copy_only=False)],
            np.asarray(table.column("n")), threshold,
        )
        out = pa.table({"class": ids, "links": pa.array(links), "root": ids.take(pa.array(root))})
        return out.filter(pa.array(links > 0))

    found = stored(
        placed.groupBy("leaf", "p", "q").applyInArrow(compare, f"class {kind}, links long, root {kind}"),
        "leaf-links",
    )
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    united = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")), "vectors")
    known = (
        classes.select("key", "class", "n")
        .join(counts, "class", "left")
        .join(united.withColumnRenamed("node", "class"), "class", "left")
        .select(
            "key",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
            F.coalesce("component", "class").alias("component"),
        )
    )
    return (
        rows.drop("v")
        .join(known, "key", "left")
        .select(
            F.col("id").alias(id_column),
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
        .withColumn("kept", F.col(id_column) == F.col("component_id"))
    )
