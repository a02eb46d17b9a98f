"""Operator 2, embedding near-dedup: a subspace pigeonhole join with exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import FloatType

from cardmill.llm.common import free, ship
from cardmill.llm.components import connected_components
from cardmill.session import drop_copies, materialize

BLOCKS = 8
# Members of a cell that are compared at once; larger cells are cut into tiles and all pairs of tiles are compared.
TILE_ROWS = 4096
# Rounding slack of squared distances, far above the error of double sums and far below any budget.
SLACK = 1e-9
PAIR_CHUNK = 50_000


@lru_cache(maxsize=8)
def rotation(size: int) -> np.ndarray:
    """A fixed random rotation: it spreads every vector's length evenly over the blocks."""
    q, r = np.linalg.qr(np.random.default_rng(20240229).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def block_bounds(size: int) -> list[tuple[int, int]]:
    """Block edges; the squared-distance budget of a block is its share of the dimensions."""
    edges = np.linspace(0, size, min(BLOCKS, size) + 1).astype(int)
    return [(int(a), int(b)) for a, b in zip(edges, edges[1:], strict=False)]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that no square overflows or vanishes."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def budget(threshold: float) -> float:
    """Squared distance of unit vectors at the cosine."""
    return 2 - 2 * threshold


def cells_of(rotated: np.ndarray, a: int, b: int, total: float, depth: int) -> tuple[np.ndarray, list[list[tuple]]]:
    """For the block ``a:b`` the home cell of each vector and all cells that its range touches, home included.

    Cells are a grid over the first ``depth`` dimensions of the block, four ranges wide.
    """
    reach = math.sqrt(total * (b - a) / rotated.shape[1]) * (1 + SLACK) + 1e-12
    part = rotated[:, a : a + min(depth, b - a)]
    width = 4 * reach
    home = np.floor(part / width).astype(np.int64)
    low, high = np.floor((part - reach) / width).astype(np.int64), np.floor((part + reach) / width).astype(np.int64)
    touched = []
    for lo, hi in zip(low, high, strict=True):
        cells: list[tuple] = [()]
        for x, y in zip(lo, hi, strict=True):
            cells = [(*c, v) for c in cells for v in range(int(x), int(y) + 1)]
        touched.append(cells)
    return home, touched


def _tiled(source: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows for every cell that a vector's range touches, once for each pair of tiles that holds the vector."""
    kept = ["rep", "label", "size", "copies", "vector"]
    for batch in source:
        added = [("block", pa.int32()), ("cell", pa.string()), ("home", pa.bool_())]
        schema = pa.schema([*(batch.schema.field(c) for c in kept), *(pa.field(*x) for x in added)])
        frame = batch.to_pandas()
        for (size, depth), rows in frame.groupby(["size", "depth"]):
            vectors = unit(np.array([np.asarray(v, dtype=np.float64) for v in rows["vector"]]))
            rotated = vectors @ rotation(int(size))
            for number, (a, b) in enumerate(block_bounds(int(size))):
                home, touched = cells_of(rotated, a, b, budget(threshold), int(depth))
                index = [i for i, cells in enumerate(touched) for _ in cells]
                out = rows.iloc[index][kept].reset_index(drop=True)
                out["block"] = number
                cells = [c for each in touched for c in each]
                out["cell"] = [",".join(map(str, c)) for c in cells]
                out["home"] = [c == tuple(home[i]) for i, c in zip(index, cells, strict=True)]
                yield pa.RecordBatch.from_pandas(out, schema=schema, preserve_index=False)


def compare_cell(frame: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links inside one group (label, block, cell, two tiles): per vector its number of links and its local root.

    A pair counts where the vector with the smaller id is at home, in the first block whose budget it meets, and
    in the group of exactly these two tiles: so every link of the whole join counts once.
    """
    frame = frame.sort_values("rep", kind="stable").reset_index(drop=True)
    size, block = int(frame["size"][0]), int(frame["block"][0])
    raw = np.array([np.asarray(v, dtype=np.float64) for v in frame["vector"]])
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    norms = np.sqrt((scaled * scaled).sum(axis=1))
    rotated = (scaled / norms[:, None]) @ rotation(size)
    bounds, total = block_bounds(size), budget(threshold)
    limits = np.array([total * (b - a) / size + SLACK for a, b in bounds])
    a, b = bounds[block]
    part = rotated[:, a:b]
    square = (part * part).sum(axis=1)
    home, tile = frame["home"].to_numpy(), frame["tile"].to_numpy()
    one, two = int(frame["tile_a"][0]), int(frame["tile_b"][0])
    n = len(frame)
    copies = frame["copies"].to_numpy()
    links, root = np.zeros(n, dtype=np.int64), np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    rows_at_once = max(1, 4_000_000 // n)
    for at in range(0, n, rows_at_once):
        mine = np.arange(at, min(n, at + rows_at_once))
        mine = mine[home[mine]]
        if not len(mine):
            continue
        near = square[mine, None] + square[None, :] - 2 * (part[mine] @ part.T) <= limits[block] + SLACK
        near &= np.arange(n)[None, :] > mine[:, None]
        if one != two:
            near &= tile[None, :] != tile[mine, None]
        left, right = np.nonzero(near)
        left = mine[left]
        for c in range(0, len(left), PAIR_CHUNK):
            i, j = left[c : c + PAIR_CHUNK], right[c : c + PAIR_CHUNK]
            cosine = (scaled[i] * scaled[j]).sum(axis=1) / (norms[i] * norms[j])
            linked = cosine >= threshold
            i, j = i[linked], j[linked]
            gap = rotated[i] - rotated[j]
            gap *= gap
            met = np.stack([gap[:, x:y].sum(axis=1) for x, y in bounds], axis=1) <= limits
            first = met.argmax(axis=1) == block
            i, j = i[first & met[:, block]], j[first & met[:, block]]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                rx, ry = find(x), find(y)
                if rx != ry:
                    root[max(rx, ry)] = min(rx, ry)
    roots = np.array([find(i) for i in range(n)])
    hit = links > 0
    ids = frame["rep"].to_numpy()
    return pd.DataFrame({"rep": ids[hit], "links": links[hit], "root": ids[roots[hit]]})


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
) -> DataFrame:
    """``vectors`` with ``n_links``, ``component_id`` and ``kept`` added, for links of cosine >= ``threshold`` in a label.

    * Null, empty and zero vectors, vectors with null or non-finite components, null labels and null ids link with
      nothing; so do vectors of different lengths. They keep their own id as component.
    * Equal vectors of a label are one node that counts its ids, so a vector that a third of the rows repeat costs
      no more than one. Rows with equal ids and vectors are one vector. Added columns replace input ones.

    Vectors within the squared distance D = 2 - 2 * threshold are within D * (share of dimensions) in at least one
    block of a rotation. For each block a grid finds the vectors in range: one is at home in its cell, the other's
    range touches it. The depth of the grid grows with the label; a cell with more rows than a tile is cut by
    hash, and its tiles are compared two by two. Only link counts and a spanning forest leave a group.
    """
    spark = ship(vectors.sparkSession)
    vectors = free(vectors, "n_links", "component_id", "kept")
    ident, vector, label = (F.col(f"`{c}`") for c in (id_col, vector_col, label_col))
    # Floats are shipped as they are, which is half of what doubles take; all sums are double.
    kind = "float" if isinstance(vectors.schema[vector_col].dataType.elementType, FloatType) else "double"
    numbers = F.transform(vector, lambda x: x.cast(kind))
    usable = (
        label.isNotNull()
        & ident.isNotNull()
        & (F.size(vector) > 0)
        & ~F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(numbers, lambda x: x != 0)
    )
    good = vectors.where(F.coalesce(usable, F.lit(False))).select(
        ident.alias("id"), label.alias("label"), F.size(vector).alias("size"), numbers.alias("vector")
    )
    # Minus zero equals zero.
    good = good.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0).cast(kind)))
    groups = good.groupBy("label", "size", "vector").agg(F.min("id").alias("rep"), F.count_distinct("id").alias("copies"))
    reps = materialize(groups, "vector-groups")
    sizes = reps.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    depth = F.greatest(F.lit(0), F.ceil(F.log(3.0, F.col("n") / TILE_ROWS))).cast("int")
    rows = reps.join(sizes.select("label", depth.alias("depth")), "label")
    label_type = reps.schema["label"].dataType.simpleString()
    touched = rows.mapInArrow(
        lambda batches: _tiled(batches, threshold),
        f"rep long, label {label_type}, size int, copies long, vector array<{kind}>, block int, cell string, home boolean",
    )
    # What a cell holds decides into how many tiles it is cut.
    touched = materialize(touched, "vector-cells")
    key = ["label", "size", "block", "cell"]
    counts = touched.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.count_if("home").alias("homes"))
    counts = counts.where((F.col("n") > 1) & (F.col("homes") > 0)).withColumn("tiles", F.ceil(F.col("n") / TILE_ROWS).cast("int"))
    # Written before it is joined, so that AQE can split a cell with very many rows.
    counts = materialize(counts.select(*key, "tiles"), "cell-tiles")
    members = touched.join(counts, key).withColumn(
        "tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    paired = members.withColumn("other", other).withColumns(
        {"tile_a": F.least("tile", "other"), "tile_b": F.greatest("tile", "other")}
    )
    found = paired.drop("other", "tiles").groupBy(*key, "tile_a", "tile_b").applyInPandas(
        lambda frame: compare_cell(frame, threshold), "rep long, links long, root long"
    )
    found = materialize(found, "vector-links")
    drop_copies(touched, counts)
    edges = found.where(F.col("rep") != F.col("root")).select(F.col("rep").alias("a"), F.col("root").alias("b"))
    roots = connected_components(edges)
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    per_rep = (
        reps.join(links, "rep", "left")
        .join(roots, F.col("rep") == F.col("node"), "left")
        .select(
            "label",
            "size",
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "rep").alias("component_id"),
        )
    )
    # Each id gets what its group has.
    per_id = good.join(per_rep, ["label", "size", "vector"]).groupBy("id").agg(
        F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")
    )
    out = vectors.join(per_id, ident == F.col("id"), "left").drop("id")
    component = F.coalesce("component_id", ident)
    return out.withColumns(
        {
            "n_links": F.coalesce("n_links", F.lit(0)).cast("bigint"),
            "component_id": component,
            "kept": F.coalesce(component == ident, F.lit(False)),
        }
    )
