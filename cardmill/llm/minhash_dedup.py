"""Operator 4, MinHash near-dedup: an LSH forest of sorted signature orders, with exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cardmill.llm.common import free, ship
from cardmill.llm.components import connected_components, local_roots
from cardmill.llm.shingles import mix, set_key, shingle_set
from cardmill.session import drop_copies, materialize

TREES, MOST_DEPTH, LEAST_DEPTH = 16, 8, 4
HASHES = TREES * MOST_DEPTH
# Pairs below this similarity share fewer values: they get twice the trees, and regions of at most LOW_DEPTH values.
LOW_PERCENT, LOW_DEPTH = 85, 6
# A region of a signature order with more members is looked at one hash value deeper, down to the last depth.
REGION_ROWS = 2048
# Members that are compared at once; larger groups are cut into tiles, and all pairs of tiles are compared.
TILE_ROWS, TILE_SHINGLES = 1024, 1 << 18
# Candidates need this estimate: 4.5 standard deviations of HASHES values below the threshold.
SIGMAS = 4.5

_rng = np.random.default_rng(20250131)
_FACTORS = _rng.integers(1, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The upper 16 bits of the least value of each of HASHES hash functions over a set that is not empty."""
    least = np.full(HASHES, np.uint32(0xFFFFFFFF))
    for at in range(0, len(shingles), 1024):
        part = (shingles[at : at + 1024] >> np.uint64(16)).astype(np.uint32)
        values = _FACTORS[:, None] * part
        values += _SHIFTS[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return (mix(least.astype(np.uint64)) >> np.uint64(48)).astype(">u2")


def sign(docs: DataFrame, text_col: str, width: int) -> DataFrame:
    """Adds the set size, the set key and the signature of whole texts; key and signature are null without words."""
    ship(docs.sparkSession)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            index = batch.schema.get_field_index(text_col)
            sizes, keys, signatures = [], [], []
            for text in batch.column(index).cast(pa.large_binary()).to_pylist():
                found = shingle_set(text or b"", width)
                sizes.append(len(found))
                keys.append(set_key(found) if len(found) else None)
                signatures.append(signature(found).tobytes() if len(found) else None)
            rest = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != text_col]
            yield pa.RecordBatch.from_arrays(
                [*(c for _, c in rest), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())],
                [*(n for n, _ in rest), "n_shingles", "set_key", "signature"],
            )

    kept = docs.drop(text_col).schema
    return docs.mapInArrow(
        batches, kept.add("n_shingles", "long").add("set_key", "binary").add("signature", "binary")
    )


def equal_values(values: np.ndarray) -> np.ndarray:
    """In how many hash values each pair of signatures agrees."""
    n = len(values)
    if n <= 64:
        return (values[:, None, :] == values[None, :, :]).sum(axis=2, dtype=np.uint8)
    columns = np.ascontiguousarray(values.T)
    total = np.zeros((n, n), dtype=np.uint8)
    for at in range(0, n, 256):
        part = total[at : at + 256]
        same = np.empty(part.shape, dtype=bool)
        for column in columns:
            np.equal(column[at : at + 256, None], column[None, :], out=same)
            part += same.view(np.uint8)
    return total


def forest_edges(linked: np.ndarray, ids: np.ndarray) -> pd.DataFrame:
    """A spanning forest of a link matrix: every member and the first member that it can reach."""
    root = local_roots(linked)
    other = np.flatnonzero(root != np.arange(len(root)))
    return pd.DataFrame({"a": ids[other], "b": ids[root[other]]})


def compare_region(rows: list[tuple[int, int, bytes]], least: float) -> list[tuple[int, int]]:
    """Edges of a spanning forest over the (rep, set size, signature) rows whose signatures agree in ``least``."""
    rows = sorted(rows)
    values = np.frombuffer(b"".join([r[2] for r in rows]), dtype=np.uint16).reshape(len(rows), HASHES)
    sizes = np.array([r[1] for r in rows])
    # Sets of too unequal size cannot be similar enough; the estimate's bound serves for the ratio, too.
    alike = equal_values(values) >= least * HASHES
    alike &= np.minimum(sizes[:, None], sizes) >= least * np.maximum(sizes[:, None], sizes)
    root = local_roots(alike)
    return [(rows[i][0], rows[r][0]) for i, r in enumerate(root.tolist()) if r != i]


def _compare_regions(source: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Compares groups that come one after the other, ordered by region and pair of tiles."""
    group: list[tuple[int, int, bytes]] = []
    edges: list[tuple[int, int]] = []
    before = None

    def batch() -> pa.RecordBatch:
        a, b = ([e[k] for e in edges] for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for rows in source:
        columns = [c.to_pylist() for c in rows.columns]
        for key, rep, size, values in zip(zip(*columns[:4], strict=True), *columns[4:], strict=True):
            if key != before:
                if len(group) > 1:
                    edges += compare_region(group, least)
                group, before = [], key
            group.append((rep, size, values))
        if edges:
            yield batch()
            edges = []
    if len(group) > 1:
        edges += compare_region(group, least)
    yield batch()


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets.

    Elements of many sets are multiplied as columns of zeros and ones, those of few are counted pair by pair.
    """
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, element, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    total = np.zeros((n, n), dtype=np.float32)
    order = np.argsort(element, kind="stable")
    owner, bounds = owner[order], np.concatenate(([0], np.cumsum(count)))
    common = np.flatnonzero(count > max(32, n // 16))
    for at in range(0, len(common), 1024):
        part = common[at : at + 1024]
        column = np.zeros((n, len(part)), dtype=np.float32)
        for k, e in enumerate(part):
            column[owner[bounds[e] : bounds[e + 1]], k] = 1
        total += column @ column.T
    rare = count <= max(32, n // 16)
    for c in np.unique(count[rare & (count > 1)]):
        rows = owner[bounds[:-1][rare & (count == c)][:, None] + np.arange(c)]
        pairs = np.bincount((rows[:, :, None] * n + rows[:, None, :]).ravel(), minlength=0) if len(rows) * c * c < 4_000_000 else None
        if pairs is None:
            for r in np.array_split(rows, len(rows) * c * c // 4_000_000 + 1):
                np.add.at(total.reshape(-1), (r[:, :, None] * n + r[:, None, :]).ravel(), 1)
        else:
            total.reshape(-1)[: len(pairs)] += pairs
    np.fill_diagonal(total, [len(s) for s in sets])
    return total


def confirm_tiles(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Edges of a spanning forest over the pairs whose full sets are similar enough."""
    frame = frame.sort_values("rep", kind="stable")
    sets = [np.frombuffer(s, dtype=np.uint64) for s in frame["shingles"]]
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    both = intersections(sets).astype(np.float64)
    linked = 100 * both >= percent * (sizes[:, None] + sizes - both)
    return forest_edges(linked, frame["rep"].to_numpy())


def _tiles(rows: Column, shingles: Column) -> Column:
    return F.greatest(F.ceil(rows / TILE_ROWS), F.ceil(shingles / TILE_SHINGLES), F.lit(1)).cast("int")


def _tile_pairs(members: DataFrame) -> DataFrame:
    """Each member once for every pair of tiles that its tile is in."""
    tiled = members.withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    return tiled.withColumn("other", other).withColumns(
        {"tile_a": F.least("tile", "other"), "tile_b": F.greatest("tile", "other")}
    ).drop("tile", "other", "tiles")


def forest_shape(percent: int) -> tuple[int, int]:
    """The number of trees and the last depth for a threshold."""
    return (TREES, MOST_DEPTH) if percent >= LOW_PERCENT else (2 * TREES, LOW_DEPTH)


def tree_values(tree: int) -> list[int]:
    """Which hash values order a tree: the first TREES have a block each, the next a diagonal over the blocks.

    So two trees have at most one value in common.
    """
    if tree < TREES:
        return list(range(MOST_DEPTH * tree, MOST_DEPTH * (tree + 1)))
    return [MOST_DEPTH * ((tree + k) % TREES) + k for k in range(MOST_DEPTH)]


def _tree_key(tree: int) -> Column:
    values = tree_values(tree)
    if tree < TREES:
        return F.substring("signature", 1 + 2 * values[0], 2 * MOST_DEPTH)
    return F.concat(*(F.substring("signature", 1 + 2 * v, 2) for v in values))


def _regions(reps: DataFrame, trees: int = TREES, last: int = MOST_DEPTH) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, region, tiles, rep) for the regions with at least two members, and the copies that this reads.

    A tree is the order of all signatures by MOST_DEPTH of their values. Rows that share a prefix stand together in
    it, so the neighbours with a common prefix of d values are the group of that prefix. Groups start at
    LEAST_DEPTH; members of a group with more than REGION_ROWS rows go on with one more value, and from the depth
    ``last`` on a group of any size is compared by pairs of tiles. Prefixes are counted with partial sums, so no task holds a large group to find out that it is large.
    """
    keys = [
        F.struct(F.lit(t).alias("tree"), _tree_key(t).alias("key"))
        for t in range(trees)
    ]
    rows = reps.select("rep", "n_shingles", F.explode(F.array(*keys)).alias("_k")).select("rep", "n_shingles", "_k.*")
    found, copies = None, []
    for depth in range(LEAST_DEPTH, last + 1):
        prefix = F.substring("key", 1, 2 * depth)
        counts = rows.groupBy("tree", prefix.alias("region")).agg(
            F.count(F.lit(1)).alias("n"), F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high")
        )
        # Written before it is joined, so that AQE can split a prefix with very many rows.
        counts = materialize(counts.where(F.col("n") > 1), "region-sizes")
        copies.append(counts)
        here = rows.withColumn("region", prefix).join(counts, ["tree", "region"])
        if depth < last:
            here = materialize(here, f"region-depth-{depth}")
            copies.append(here)
            rows = here.where(F.col("n") > REGION_ROWS).select("rep", "n_shingles", "tree", "key")
            here = here.where(F.col("n") <= REGION_ROWS)
        part = here.select("tree", "region", "rep", F.ceil(F.col("n") / REGION_ROWS).cast("int").alias("tiles"))
        found = part if found is None else found.union(part)
        if depth < last and rows.isEmpty():
            break
    return found, copies


def near_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 85
) -> DataFrame:
    """``docs`` with ``n_shingles``, ``component_id`` and ``kept`` added.

    Documents are linked when their sets of ``width``-word shingles meet 100 * intersection >= percent * union. A
    text of fewer words is one shingle; null texts and texts without words have no set and link with nothing, as
    do rows with a null id (their component is null and they are not kept). Rows with equal ids are one document
    to the graph: a link of any of them counts for all. Added columns replace input ones.

    1. Equal sets are one node, by set key, with partial minima: copies cost one row a task.
    2. LSH forest: see ``_regions``. At a similarity of exactly 0.85 a pair shares a prefix of LEAST_DEPTH values in
       one of the TREES orders with probability 0.99999, of MOST_DEPTH values with 0.994. Below LOW_PERCENT there
       are twice the orders and prefixes end at LOW_DEPTH: at 0.80, 0.999995 and 0.9996 (simulated).
    3. In a region all pairs of signatures are compared, a spanning forest of those alike leaves it.
    4. Candidate groups are the components of these forests. Every pair of full sets in a group is confirmed, by
       pairs of tiles where the group is large, and a spanning forest of the confirmed links leaves a task.
    5. The components of the confirmed links are the result.
    """
    spark = ship(docs.sparkSession)
    docs = free(docs, "n_shingles", "component_id", "kept")
    doc, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    texts = docs.where(doc.isNotNull()).select(doc.alias("id"), text.alias("text"))
    signed = materialize(sign(texts, "text", width), "signatures")
    with_set = signed.where(F.col("n_shingles") > 0)
    reps = with_set.groupBy("set_key").agg(
        F.min("id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
    )
    # One id may stand for two sets where ids repeat; they are one node then.
    reps = materialize(reps, "distinct-sets")
    spread = (percent / 100 * (1 - percent / 100) / HASHES) ** 0.5
    least = percent / 100 - SIGMAS * spread
    found, copies = _regions(reps, *forest_shape(percent))
    regions = materialize(found, "regions")
    drop_copies(*copies)
    key = ["tree", "region", "tile_a", "tile_b"]
    paired = _tile_pairs(regions.join(reps, "rep")).select(*key, "rep", "n_shingles", "signature")
    # Most regions are small, so a task takes many, one after the other.
    partitions = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = paired.repartition(partitions, *key).sortWithinPartitions(*key)
    alike = dealt.mapInArrow(lambda batches: _compare_regions(batches, least), "a long, b long")
    groups = connected_components(alike)
    members = groups.select("node", "root").union(groups.select(F.col("root").alias("node"), "root")).distinct()
    members = materialize(members.join(reps.select(F.col("rep").alias("node"), "n_shingles"), "node"), "candidate-groups")
    sizes = members.groupBy("root").agg(_tiles(F.count(F.lit(1)), F.sum("n_shingles")).alias("tiles"))

    def sets(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = [shingle_set(t, width).tobytes() for t in batch.column(1).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["rep", "shingles"])

    wanted = members.select(F.col("node").alias("id")).distinct()
    full = texts.where(F.col("text").isNotNull()).join(wanted, "id", "left_semi").mapInArrow(sets, "rep long, shingles binary")
    placed = members.join(sizes, "root").select("root", "tiles", F.col("node").alias("rep"))
    confirmed = (
        _tile_pairs(placed.join(full, "rep"))
        .groupBy("root", "tile_a", "tile_b")
        .applyInPandas(lambda frame: confirm_tiles(frame, percent), "a long, b long")
    )
    # Rows with equal sets, or of one id, belong together without a check.
    same = with_set.join(reps.select("set_key", "rep"), "set_key").where(F.col("id") != F.col("rep"))
    edges = confirmed.union(same.select(F.col("id").alias("a"), F.col("rep").alias("b")))
    roots = connected_components(edges)
    drop_copies(reps, regions, members)
    per_id = signed.groupBy("id").agg(F.max("n_shingles").alias("n_shingles"))
    per_id = per_id.join(roots, F.col("id") == F.col("node"), "left").select(
        F.col("id").alias("_llm_id"), "n_shingles", F.coalesce("root", "id").alias("component_id")
    )
    out = docs.join(per_id, doc == F.col("_llm_id"), "left").drop("_llm_id")
    return out.withColumns(
        {
            "n_shingles": F.coalesce("n_shingles", F.lit(0)).cast("bigint"),
            "kept": F.coalesce(F.col("component_id") == doc, F.lit(False)),
        }
    )
