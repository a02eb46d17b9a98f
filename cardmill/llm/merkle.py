"""Operator 11, Merkle manifest of a dataset: cogrouped subtree exchange.

Rows are leaves, sources are trees, and the roots of the trees are the leaves of one more tree. Nodes of a tree
are numbered in order and cut into superblocks of FANOUT ** BLOCK_LEVELS neighbours.

1. Upwards, every superblock is reduced to its one node, which is a node of the next round, until each tree has
   one node left. A round leaves a 4096th of its rows.
2. Downwards, the nodes of a superblock are cogrouped with its one outer row: the siblings on the way from the
   superblock to the root. The group finishes its own levels again, joins the proofs and, in the round of the
   leaves, folds them.

No group holds more than a superblock, so a source with a third of all rows is many groups. What goes down is one
row a superblock, whose size grows with the logarithm of the rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from cardmill.llm.common import ship
from cardmill.operators.rows import with_row_index
from cardmill.operators.sizing import broadcast_within
from cardmill.session import materialize

FANOUT = 16
BLOCK_LEVELS = 3

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# A step of a proof: the place of the own node among its run, and the digests of the others in order.
STEP = "place int, others array<string>"
PROOF = f"array<struct<{STEP}>>"
NODE = "tree long, pos long, n long, digest string"
OUTER = f"tree long, block long, subroot string, root string, proof {PROOF}"


def digest_of(parts: Iterable[str]) -> str:
    """Lowercase hex SHA-256 of the parts, concatenated as text."""
    return sha256("".join(parts).encode()).hexdigest()


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values of a row, each with its length in front, so that no two rows run together."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*[part(v) for v in values]).cast("binary"), 256)


def levels_of(n: int, most: int) -> int:
    """Levels that reduce ``n`` nodes to one, at most ``most``."""
    levels = 0
    while n > 1 and levels < most:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def reduce_levels(digests: list[str], levels: int) -> list[list[str]]:
    """The nodes of a superblock level by level, its leaves first; the last run of a level may be short."""
    out = [digests]
    for _ in range(levels):
        below = out[-1]
        out.append([digest_of(below[i : i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return out


def inner_steps(nodes: list[list[str]], at: int) -> list[tuple[int, list[str]]]:
    """The steps of the proof of node ``at`` inside its superblock."""
    steps = []
    for level in nodes[:-1]:
        first = at - at % FANOUT
        run = level[first : first + FANOUT]
        steps.append((at - first, run[: at - first] + run[at - first + 1 :]))
        at //= FANOUT
    return steps


def fold(leaf: str, steps: Iterable[tuple[int, Sequence[str]]]) -> str:
    """The root that a leaf and the siblings on its way give."""
    for place, others in steps:
        leaf = digest_of([*others[:place], leaf, *others[place:]])
    return leaf


def _outer_steps(outer: pd.DataFrame) -> list[tuple[int, list[str]]]:
    return [(step["place"], list(step["others"])) for step in outer["proof"].iloc[0]]


def _records(steps: list[tuple[int, list[str]]]) -> list[dict]:
    return [{"place": place, "others": others} for place, others in steps]


def _reduce_block(block_levels: int):
    def reduce(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        n = int(rows["n"].iloc[0])
        top = reduce_levels(list(rows["digest"]), levels_of(n, block_levels))[-1][0]
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "n": [-(-n // FANOUT**block_levels)], "digest": [top]})

    return reduce


def _descend_block(block_levels: int):
    """The outer row of every node of a superblock, which is a superblock of the round below."""

    def descend(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        nodes = reduce_levels(list(rows["digest"]), levels_of(int(rows["n"].iloc[0]), block_levels))
        above = _outer_steps(outer)
        out = pd.DataFrame({"tree": rows["tree"], "block": rows["pos"]})
        out["subroot"], out["root"] = outer["subroot"].iloc[0], outer["root"].iloc[0]
        out["proof"] = [_records(inner_steps(nodes, at) + above) for at in range(len(rows))]
        return out

    return descend


def _finish_block(block_levels: int, proofs: bool):
    """The digests, proofs and folded roots of the leaves of a superblock."""

    def finish(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        digests = list(rows["digest"])
        nodes = reduce_levels(digests, levels_of(int(rows["n"].iloc[0]), block_levels))
        above = _outer_steps(outer)
        folded, hashed, kept = [], [], []
        for at, (leaf, claimed) in enumerate(zip(digests, rows["claimed"], strict=True)):
            steps = inner_steps(nodes, at) + above
            hashed.append(digest_of(x for _, others in steps for x in others))
            folded.append(fold(leaf if claimed is None else claimed, steps))
            if proofs:
                kept.append(_records(steps))
        out = pd.DataFrame({"id": list(rows["id"]), "leaf": digests})
        out["subroot"], out["root"] = outer["subroot"].iloc[0], outer["root"].iloc[0]
        out["proof_sha256"], out["folded_root"] = hashed, folded
        if proofs:
            out["proof"] = kept
        return out

    return finish


def _blocks(nodes: DataFrame, block_levels: int):
    return nodes.groupBy("tree", F.expr(f"pos div {FANOUT**block_levels}").alias("block"))


def _rounds(nodes: DataFrame, block_levels: int) -> list[DataFrame]:
    """The nodes of all rounds of some trees, the last round with one node a tree."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > 1:
        up = _blocks(rounds[-1], block_levels).applyInPandas(_reduce_block(block_levels), NODE)
        rounds.append(materialize(up, "merkle-nodes"))
    return rounds


def _descend(rounds: Sequence[DataFrame], outer: DataFrame, block_levels: int) -> DataFrame:
    """Outer rows of the superblocks of the lowest round, from those of the single blocks of the highest."""
    for nodes in reversed(rounds):
        pairs = _blocks(nodes, block_levels).cogroup(outer.groupBy("tree", "block"))
        outer = materialize(pairs.applyInPandas(_descend_block(block_levels), OUTER), "merkle-outer")
    return outer


def merkle_manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    tree_col: str = "source",
    order_col: str = "doc_id",
    claimed: Mapping[str, Column] | None = None,
    claimed_where: Column | None = None,
    proofs: bool = False,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row a document: ``order_col``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    A leaf digests ``fields``. Leaves are ordered by ``order_col`` inside their tree, trees by ``tree_col``. The
    proof of a leaf are the siblings on its way to the root; ``proofs`` adds them as a column ``proof`` (place and
    other digests of each run, bottom first). ``claimed`` gives other values for some fields, which are checked
    against the manifest where ``claimed_where`` holds: the root is folded from the claimed leaf and the original
    siblings, and ``verified`` says whether it is the root.

    * Null fields are digested as ``-``, empty texts as ``0:``, so the two differ. Texts of any length are
      digested whole, by Spark itself.
    * Rows with a null ``tree_col`` are a tree of their own, the first; rows with a null ``order_col`` come first
      in their tree and are leaves like any other. Where ``claimed_where`` is null nothing is claimed.
    * Rows with equal ``order_col`` are ordered by their leaf; equal rows have equal leaves and places of their own.
    * ``order_col`` is an integer, a decimal, a date or a string.
    * An empty table gives an empty manifest. Only the columns named here are read, so others, whatever their
      names, do no harm.
    """
    spark = ship(docs.sparkSession)
    values = {name: F.col(f"`{name}`") for name in fields}
    other = leaf_digest([(claimed or {}).get(name, value) for name, value in values.items()])
    leaves = docs.select(
        F.col(f"`{order_col}`").alias("id"),
        F.col(f"`{tree_col}`").alias("source"),
        leaf_digest(list(values.values())).alias("digest"),
        (F.when(claimed_where, other) if claimed else F.lit(None).cast("string")).alias("claimed"),
    )
    leaves = materialize(leaves, "merkle-leaves")
    placed = with_row_index(leaves, ["source", "id", "digest"], "at")
    # A tree is named by the place of its first leaf among all, which follows the order of trees.
    trees = placed.groupBy("source").agg(F.min("at").alias("tree"), F.count(F.lit(1)).alias("n"))
    trees = materialize(trees, "merkle-trees").withColumnRenamed("source", "name")
    nodes = placed.join(broadcast_within(trees), F.col("source").eqNullSafe(F.col("name")))
    # The id goes through pandas as text, which has a null and keeps large integers.
    nodes = nodes.select(
        "tree", (F.col("at") - F.col("tree")).alias("pos"), "n", "digest", F.col("id").cast("string").alias("id"), "claimed"
    )
    nodes = materialize(nodes, "merkle-nodes")
    rounds = _rounds(nodes.select("tree", "pos", "n", "digest"), block_levels)
    subroots = with_row_index(rounds[-1].select("tree", "digest"), ["tree"], "at")
    subroots = subroots.withColumnsRenamed({"tree": "of", "at": "pos"})
    total = rounds[-1].count()
    tops = subroots.select(F.lit(0).cast("long").alias("tree"), "pos", F.lit(total).cast("long").alias("n"), "digest")
    upper = _rounds(materialize(tops, "merkle-tops"), block_levels)
    # The root has nothing above it; its one node is the only superblock of a round that is not there.
    root = upper[-1].select(
        "tree", F.col("pos").alias("block"), F.lit("").alias("subroot"), F.col("digest").alias("root"),
        F.array().cast(PROOF).alias("proof"),
    )
    outer = _descend(upper[:-1], root, block_levels).select(F.col("block").alias("pos"), "root", "proof")
    outer = subroots.join(outer, "pos").select(
        F.col("of").alias("tree"), F.lit(0).cast("long").alias("block"), F.col("digest").alias("subroot"), "root", "proof"
    )
    outer = _descend(rounds[1:-1], outer, block_levels)
    schema = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    pairs = _blocks(nodes, block_levels).cogroup(outer.groupBy("tree", "block"))
    done = pairs.applyInPandas(_finish_block(block_levels, proofs), schema + (f", proof {PROOF}" if proofs else ""))
    columns = ["leaf", "subroot", "root", "proof_sha256", "folded_root", *(["proof"] if proofs else [])]
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return done.select(F.col("id").cast(docs.schema[order_col].dataType).alias(order_col), *columns, verified)
