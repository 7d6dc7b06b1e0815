"""Merkle dataset manifest: a tree over each source's documents and one over the sources' roots.

A document's leaf is the digest of its fields; the leaves of a source, ordered by id, are grouped
``FANOUT`` at a time into nodes until one is left, and the sources' roots likewise. All digests are
sha256 over the hex digests of a run, written one after another.

Leaves are numbered inside their source by a range sort (no source is sorted in one task) and cut
into aligned blocks of ``FANOUT ** height``. A task builds a block's subtree. The blocks then
run a butterfly exchange: in round r each block swaps its current node with the blocks whose number
differs in base-``FANOUT`` digit r alone, keeps that run as a step of its proof, and hashes the
run to the node above. Every block below a node so computes that node itself, and after
``log_FANOUT(blocks)`` rounds each holds all upper siblings and the root of its source; nothing is
sent back down. Where a source's last subtree has fewer blocks than its siblings, its blocks stand in
for the missing partners, so a round sends at most twice the blocks and no key gets more than
``FANOUT`` rows. The sources' roots go through the same steps as leaves of one upper tree. A leaf's
proof is its steps inside its block, the block's, and its source's.

Defined cases: null fields count as ``-``; null ids come first, equal ids are ordered by leaf; the null
source comes first, then sources by their bytes; a lone leaf is its source's root and a lone source's
root the root; a lone node at a run's end is hashed alone; an empty table gives no rows.
Only doc_id, source, lang, n_chars and text are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ready, stored

FANOUT, BLOCK_LEVELS = 16, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "array<struct<at: int, run: array<string>>>"
STEPS = pa.list_(pa.struct([("at", pa.int32()), ("run", pa.list_(pa.string()))]))


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(docs: DataFrame, text: Column | None = None) -> Column:
    """The leaf digest of each row, with another text where one is given."""
    return F.sha2(F.concat(*[field(docs[c] if c != "text" or text is None else text) for c in FIELDS]), 256)


def source_key(source: Column) -> Column:
    """A key that is never null and sorts as sources do: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with ``rank`` (from 0, inside the group by the order) and ``n`` (the group's rows).

    Rows are range-partitioned by group and order (equal rows by their place, so none pile up), written
    with their partition, counted by (partition, group), and ranked inside those.
    """
    ranged = rows.withColumn("tie", F.monotonically_increasing_id())
    ranged = stored(ranged.repartitionByRange(group, *order, "tie").withColumn("part", F.spark_partition_id()))
    counts = ranged.groupBy(group, "part").agg(F.count(F.lit(1)).alias("rows"))
    all_parts = Window.partitionBy(group)
    before = F.coalesce(F.sum("rows").over(all_parts.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(group, "part", before.alias("before"), F.sum("rows").over(all_parts).alias("n"))
    inside = Window.partitionBy(group, "part").orderBy(*order, "tie")
    return ranged.withColumn("place", F.row_number().over(inside)).join(counts, [group, "part"]).withColumn("rank", F.col("before") + F.col("place") - 1).drop("part", "place", "before", "tie")


def levels_of(nodes: list[str], n: int, height: int) -> list[list[str]]:
    """The levels of a block's subtree from its leaves on: up to one node where the block holds all n
    leaves of its tree, else ``height`` levels up."""
    levels = [nodes]
    while len(levels[-1]) > 1 if n <= FANOUT**height else len(levels) <= height:
        below = levels[-1]
        levels.append([digest(below[i : i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return levels


def exchange(state: DataFrame, blocks: int, height: int) -> DataFrame:
    """grp, block, node (the group's root), steps: every block's upper proof.

    ``state`` has grp, block, n (leaves of the group) and node (the block's subtree root); ``blocks`` is
    the most blocks of a group.
    """
    state = state.withColumn("steps", F.expr(f"cast(array() as {STEP})")).withColumn("blocks", F.ceil(F.col("n") / FANOUT**height).cast("long"))
    width = 1
    while width < blocks:
        own = F.floor(F.col("block") / width).cast("long")
        low = F.col("block") % width
        size = F.least(F.lit(width), F.col("blocks") - own * width)
        # blocks of a short last subtree also answer for the partners that it lacks
        slots = F.when(own % FANOUT == 0, F.array(low)).otherwise(F.sequence(low, F.lit(width - 1).cast("long"), size))
        sent = state.select("*", own.alias("own"), low.alias("low"), F.explode(slots).alias("slot"))
        at = (F.col("own") % FANOUT).cast("int").alias("at")
        partners = Window.partitionBy("grp", F.floor(F.col("own") / FANOUT), "slot")
        met = sent.withColumn("met", F.sort_array(F.collect_list(F.struct(at, F.col("node").alias("h"))).over(partners))).where("slot = low")
        run = F.col("met")["h"]
        done = F.ceil(F.col("blocks") / width) <= 1
        step = F.array(F.struct(at, run.alias("run")))
        state = met.select(
            "grp", "block", "n", "blocks",
            F.when(done, F.col("node")).otherwise(F.sha2(F.array_join(run, ""), 256)).alias("node"),
            F.when(done, F.col("steps")).otherwise(F.concat("steps", step)).alias("steps"),
        )
        width *= FANOUT
    return state.drop("blocks")


def fold(node: str, steps: list[dict]) -> str:
    """The root that a node and its siblings lead to."""
    for s in steps:
        node = digest(s["run"][: s["at"]] + [node] + s["run"][s["at"] + 1 :])
    return node


def siblings(steps: list[dict]) -> list[str]:
    return [h for s in steps for i, h in enumerate(s["run"]) if i != s["at"]]


def block_steps(leaves: list[str], n: int, height: int) -> Iterator[list[dict]]:
    """The steps of each leaf inside its block."""
    levels = levels_of(leaves, n, height)[:-1]
    for i in range(len(leaves)):
        steps = []
        for level in levels:
            at = i % FANOUT
            steps.append({"at": at, "run": level[i - at : i - at + FANOUT]})
            i //= FANOUT
        yield steps


def _in_order(table: pa.Table) -> tuple[pa.Table, list[str], int]:
    """A block's rows by rank, their leaves, and the leaves of the whole tree."""
    table = table.take(pa.array(table.column("rank").to_numpy().argsort(kind="stable")))
    return table, table.column("leaf").to_pylist(), table.column("n")[0].as_py()


@dataclass
class Manifest:
    """``leaves``: doc_id, grp, n, rank, block, leaf and the columns carried along; ``blocks``: grp, block,
    subroot, root, steps (the proof above the block's subtree of ``height`` levels)."""

    leaves: DataFrame
    blocks: DataFrame
    height: int

    def roots(self) -> DataFrame:
        """source (null or text), subroot, root."""
        source = F.when(F.col("grp").startswith("="), F.substring(F.col("grp"), 2, 1 << 30))
        return self.blocks.where("block = 0").select(source.alias("source"), "subroot", "root")

    def proofs(self) -> DataFrame:
        """Every leaf's whole proof: doc_id, leaf, subroot, root, proof (runs of digests and the own place, level by level)."""
        height = self.height

        def rows(leaves: pa.Table, h: list[str], n: int, top: dict) -> dict:
            return {"proof": pa.array([s + top["steps"] for s in block_steps(h, n, height)], STEPS)}

        return self._each_block(rows, f"proof {STEP}")

    def check(self, found: str) -> DataFrame:
        """Whether each row's digest in column ``found``, folded with its original siblings, gives the root."""
        height = self.height

        def rows(leaves: pa.Table, h: list[str], n: int, top: dict) -> dict:
            proofs, folded = [], []
            for x, inner in zip(leaves.column(found).to_pylist(), block_steps(h, n, height), strict=True):
                steps = inner + top["steps"]
                proofs.append(digest(siblings(steps)))
                folded.append(fold(x, steps))
            return {"proof_sha256": pa.array(proofs), "folded_root": pa.array(folded), "verified": pa.array([f == top["root"] for f in folded])}

        return self._each_block(rows, "proof_sha256 string, folded_root string, verified boolean")

    def _each_block(self, rows, schema: str) -> DataFrame:
        def run(table: pa.Table, tops: pa.Table) -> pa.Table:
            leaves, h, n = _in_order(table)
            top = tops.to_pylist()[0]
            fixed = {"doc_id": leaves.column("doc_id"), "leaf": leaves.column("leaf"), "subroot": pa.array([top["subroot"]] * len(h)), "root": pa.array([top["root"]] * len(h))}
            return pa.table(fixed | rows(leaves, h, n, top))

        return self.leaves.groupBy("grp", "block").cogroup(self.blocks.groupBy("grp", "block")).applyInArrow(run, f"doc_id long, leaf string, subroot string, root string, {schema}")


def _tree(leaves: DataFrame, height: int) -> DataFrame:
    """The upper proofs of the blocks of numbered leaves (grp, rank, n, block, leaf): grp, block, node, steps."""

    def root(table: pa.Table) -> pa.Table:
        table, h, n = _in_order(table)
        return table.select(["grp", "block", "n"])[:1].append_column("node", pa.array([levels_of(h, n, height)[-1][0]]))

    state = leaves.select("grp", "block", "rank", "n", "leaf").groupBy("grp", "block").applyInArrow(root, "grp string, block long, n long, node string")
    state = stored(state)
    most = state.agg(F.max("n")).first()[0] or 0
    return exchange(state, -(-most // FANOUT**height), height).drop("n")


def build(docs: DataFrame, height: int = BLOCK_LEVELS, **carried: Column) -> Manifest:
    """The manifest of ``docs``, by blocks of ``FANOUT ** height`` leaves; ``carried`` columns stay with the leaves."""
    ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), source_key(docs["source"]).alias("grp"), leaf(docs).alias("leaf"), *[c.alias(k) for k, c in carried.items()])
    block = F.floor(F.col("rank") / FANOUT**height).cast("long")
    leaves = stored(numbered(rows, "grp", ["doc_id", "leaf"]).withColumn("block", block))
    lower = stored(_tree(leaves, height))
    subroots = lower.where("block = 0").select(F.lit("").alias("grp"), F.col("grp").alias("source"), F.col("node").alias("leaf"))
    upper = stored(numbered(subroots, "grp", ["source"]).withColumn("block", block))

    def source_steps(table: pa.Table, tops: pa.Table) -> pa.Table:
        """The steps from each source's root to the root."""
        table, h, n = _in_order(table)
        top = tops.to_pylist()[0]
        return pa.table({"source": table.column("source"), "root": pa.array([top["node"]] * len(h)), "above": pa.array([s + top["steps"] for s in block_steps(h, n, height)], STEPS)})

    above = upper.groupBy("grp", "block").cogroup(_tree(upper, height).groupBy("grp", "block")).applyInArrow(source_steps, f"source string, root string, above {STEP}")
    blocks = lower.withColumnsRenamed({"grp": "source", "node": "subroot"}).join(above, "source")
    return Manifest(leaves, stored(blocks.select(F.col("source").alias("grp"), "block", "subroot", "root", F.concat("steps", "above").alias("steps"))), height)
