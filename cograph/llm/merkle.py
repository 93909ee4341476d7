"""Merkle manifest of a table: one tree per group of rows, one tree over their roots.

A tree is cut into aligned subtrees of ``HEIGHT`` levels; each is a block that
one task builds, and the roots of a tree's blocks are the leaves of its next
tier of blocks.  Inside a block the digests lie in van Emde Boas order: the tree
is split at half its height, the top part comes first, then the bottom parts
from left to right, each laid out in the same way.  `address` gives a node's
place by arithmetic alone; building a block and fetching the siblings of a proof
both go through it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cograph.functions.ranking import distributed_rank
from cograph.llm.common import scratch_table

HEIGHT = 12
ENTRY = 33  # bytes of a step of a path: what stands beside the node, and its digest
LEFT, RIGHT, ALONE = range(3)

BLOCK_SCHEMA = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("leaves", pa.int32()), ("nodes", pa.binary()), ("root", pa.binary())])
PATH_SCHEMA = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("path", pa.binary())])
PROOF_SCHEMA = pa.schema([("doc_id", pa.int64()), ("leaf", pa.binary()), ("subroot", pa.binary()), ("root", pa.binary()), ("proof", pa.binary()), ("folded", pa.binary())])


def address(depth: int, index: np.ndarray, height: int) -> np.ndarray:
    """Places, in van Emde Boas order, of the nodes ``index`` (0 leftmost) at
    ``depth`` (0: the root) of a complete tree whose leaves are at depth ``height``."""
    levels, place = height + 1, np.zeros(len(index), np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        depth -= top
        place += (1 << top) - 1 + (index >> depth) * ((1 << levels - top) - 1)
        index = index & (1 << depth) - 1
        levels -= top
    return place


def parent(left: bytes, right: bytes = b"") -> bytes:
    """Digest of one or two digests, which enter as hex text."""
    return sha256((left.hex() + right.hex()).encode()).digest()


def block_height(block: int, leaves: int) -> int:
    """Levels above the leaves.  A first block that is not full is its tree's
    only one and ends at its root; all others go to the full height, where
    their roots meet."""
    return (leaves - 1).bit_length() if block == 0 and leaves < 1 << HEIGHT else HEIGHT


class Block:
    """Digests of an aligned subtree, in van Emde Boas order; absent nodes are empty places."""

    def __init__(self, block: int, leaves: int, nodes: np.ndarray | None = None):
        self.height, self.leaves = block_height(block, leaves), leaves
        self.nodes = np.zeros((2 << self.height) - 1, "V32") if nodes is None else nodes

    def count(self, level: int) -> int:
        return -(-self.leaves >> level)

    def at(self, level: int, index: np.ndarray) -> np.ndarray:
        return address(self.height - level, index, self.height)

    @classmethod
    def build(cls, block: int, digests: list[bytes]) -> Block:
        out = cls(block, len(digests))
        for level in range(out.height + 1):
            out.nodes[out.at(level, np.arange(len(digests)))] = np.array(digests, "V32")
            digests = [parent(*digests[i:i + 2]) for i in range(0, len(digests), 2)]
        return out

    @property
    def root(self) -> bytes:
        return self.nodes[0].tobytes()

    def paths(self, index: np.ndarray) -> np.ndarray:
        """Steps from the leaves ``index`` to the block's root: (leaf, level, ENTRY) bytes."""
        out = np.zeros((len(index), self.height, ENTRY), np.uint8)
        for level in range(self.height):
            own = index >> level
            beside = own ^ 1
            there = beside < self.count(level)
            out[:, level, 0] = np.where(there, np.where(own & 1, LEFT, RIGHT), ALONE)
            out[there, level, 1:] = self.nodes[self.at(level, beside[there])].view(np.uint8).reshape(-1, 32)
        return out


def steps(path: bytes) -> list[tuple[int, bytes]]:
    return [(path[i], path[i + 1:i + ENTRY]) for i in range(0, len(path), ENTRY)]


def fold(digest: bytes, path: list[tuple[int, bytes]]) -> bytes:
    """The root that a leaf leads to with the siblings of its path."""
    for side, sibling in path:
        digest = parent(sibling, digest) if side == LEFT else parent(digest, sibling) if side == RIGHT else parent(digest)
    return digest


def field(c: Column) -> Column:
    """A value as text with its length in bytes, null as a dash."""
    c = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))


def digest(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def _read_block(block: int, leaves: int, nodes: pa.Scalar) -> Block:
    return Block(block, leaves, np.frombuffer(nodes.as_buffer(), "V32"))


def _build(key: tuple, rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("offset")
    block = Block.build(key[1].as_py(), rows.column("digest").to_pylist())
    return pa.table([[key[0].as_py()], [key[1].as_py()], [block.leaves], [block.nodes.tobytes()], [block.root]], schema=BLOCK_SCHEMA)


def _tiers(leaves: DataFrame, name: str) -> list[DataFrame]:
    """Tiers of blocks over (tree, position, digest), the lowest first; the last has one block for each tree."""
    tiers = []
    while True:
        placed = leaves.select("tree", F.shiftright("position", HEIGHT).alias("block"), F.col("position").bitwiseAND((1 << HEIGHT) - 1).alias("offset"), "digest")
        tiers.append(scratch_table(placed.groupBy("tree", "block").applyInArrow(_build, "tree string, block long, leaves int, nodes binary, root binary"), f"merkle-{name}"))
        if not tiers[-1].agg(F.max("block")).first()[0]:
            return tiers
        leaves = tiers[-1].select("tree", F.col("block").alias("position"), F.col("root").alias("digest"))


def _below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tree, block, leaves, nodes, path of the block) to the paths of the block's leaves."""
    for batch in batches:
        for tree, block, leaves, nodes, path in zip(*(batch.column(c) for c in ("tree", "block", "leaves", "nodes", "path"))):
            block, above = block.as_py(), path.as_py()
            b = _read_block(block, leaves.as_py(), nodes)
            for begin in range(0, b.leaves, 1024):
                index = np.arange(begin, min(begin + 1024, b.leaves))
                yield pa.RecordBatch.from_arrays([pa.array([tree.as_py()] * len(index)), pa.array((block << HEIGHT) + index),
                                                  pa.array([p.tobytes() + above for p in b.paths(index)], pa.binary())], schema=PATH_SCHEMA)


def _descend(tier: DataFrame, paths: DataFrame) -> DataFrame:
    """Paths of the leaves of a tier's blocks, from the paths of the blocks."""
    return tier.join(paths, ["tree", "block"]).select("tree", "block", "leaves", "nodes", "path") \
        .mapInArrow(_below, "tree string, block long, path binary")


@dataclass
class Manifest:
    """``rows``: (tree, position, and the columns of the leaves); ``tiers``: of
    blocks (tree, block, leaves, nodes, root), lowest first; ``top``: (tree,
    position) of the subroots in the tree over them; ``top_tiers``: its blocks."""

    rows: DataFrame
    tiers: list[DataFrame]
    top: DataFrame
    top_tiers: list[DataFrame]

    def roots(self) -> DataFrame:
        """(tree, subroot, root); no rows for an empty table."""
        root = self.top_tiers[-1].select("root").first()
        return self.tiers[-1].select("tree", F.col("root").alias("subroot"), F.lit(bytes(root[0]) if root else None).alias("root"))

    def paths(self) -> DataFrame:
        """(tree, block, path, subroot, root) of the lowest tier's blocks: the steps from each block's root to the root."""
        paths = self.top_tiers[-1].select("tree", "block", F.lit(b"").alias("path"))
        for tier in reversed(self.top_tiers):
            paths = _descend(tier, paths)
        paths = paths.select(F.col("block").alias("position"), "path").join(self.top, "position") \
            .select("tree", F.lit(0).cast("long").alias("block"), "path")
        for tier in reversed(self.tiers[1:]):
            paths = _descend(tier, paths)
        return paths.join(self.roots(), "tree")


def build_manifest(leaves: DataFrame, order: list[str]) -> Manifest:
    """Trees over ``leaves`` (tree string, digest binary, and more columns): a
    tree's leaves ascend by ``order``, nulls first, then by digest; every two
    consecutive nodes of a level become one, a last one alone too, while there
    are several.  The trees' roots, ordered by ``tree``, make the top tree.

    Leaves are numbered over ranges (`distributed_rank`), so a tree of any size
    is spread over tasks; a block holds 2**HEIGHT leaves.  Rows that are equal
    in order and digest are interchangeable.  No leaves give no blocks.
    """
    rows = distributed_rank(leaves, ["tree"], [*(F.col(c).asc_nulls_first() for c in order), F.col("digest")], "position")
    rows = scratch_table(rows.withColumn("position", F.col("position") - 1), "merkle-rows")
    tiers = _tiers(rows.select("tree", "position", "digest"), "trees")
    top = distributed_rank(tiers[-1].select("tree", F.col("root").alias("digest")), [], [F.col("tree")], "position")
    top = scratch_table(top.withColumn("position", F.col("position") - 1), "merkle-top")
    return Manifest(rows, tiers, top.select("tree", "position"),
                    _tiers(top.select(F.lit("").alias("tree"), "position", "digest"), "top"))


def _prove(key: tuple, rows: pa.Table, block: pa.Table) -> pa.Table:
    if not rows.num_rows or not block.num_rows:
        return PROOF_SCHEMA.empty_table()
    b = _read_block(key[1].as_py(), block.column("leaves")[0].as_py(), block.column("nodes")[0])
    above = steps(block.column("path")[0].as_py())
    above_hex = "".join(d.hex() for side, d in above if side != ALONE).encode()
    index = rows.column("offset").to_numpy()
    proofs, folded = [], []
    for path, shown in zip(b.paths(index), rows.column("shown").to_pylist()):
        own = steps(path.tobytes())
        proofs.append(sha256("".join(d.hex() for side, d in own if side != ALONE).encode() + above_hex).digest())
        folded.append(fold(shown, own + above))
    n = rows.num_rows
    return pa.table([rows.column("doc_id").cast(pa.int64()), rows.column("digest").cast(pa.binary()),
                     pa.array(block.column("subroot").to_pylist() * n, pa.binary()), pa.array(block.column("root").to_pylist() * n, pa.binary()),
                     pa.array(proofs, pa.binary()), pa.array(folded, pa.binary())], schema=PROOF_SCHEMA)


def prove(manifest: Manifest, shown: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded) of every row, digests as bytes.

    ``proof`` is the digest of the leaf's siblings as hex text, from its level
    up to the root, and ``folded`` the root that the digest ``shown`` (default:
    the leaf) leads to with them.
    """
    at = lambda c: [F.shiftright(c, HEIGHT).alias("block"), F.col(c).bitwiseAND((1 << HEIGHT) - 1).alias("offset")]
    rows = manifest.rows.select("tree", *at("position"), "doc_id", "digest", (F.col("digest") if shown is None else shown).alias("shown"))
    blocks = manifest.tiers[0].drop("root").join(manifest.paths(), ["tree", "block"])
    return rows.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(
        _prove, "doc_id long, leaf binary, subroot binary, root binary, proof binary, folded binary")


def document_leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, digest, tampered) of every row of ``docs``: the digest of
    doc_id, source, lang, n_chars and text, each with its length in bytes or a
    dash for null, and the digest with n_chars one higher.  ``tree`` orders like
    lang, null first."""
    c = {x: F.col(f"`{x}`") for x in ("doc_id", "source", "lang", "n_chars", "text")}
    more = c["n_chars"].cast("decimal(20,0)") + 1
    tree = F.coalesce(F.concat(F.lit("1"), c["lang"].cast("string")), F.lit("0"))
    return docs.select(tree.alias("tree"), c["doc_id"].cast("long").alias("doc_id"), digest(list(c.values())).alias("digest"),
                       F.when(tampered(c["doc_id"]), digest([c["doc_id"], c["source"], c["lang"], more, c["text"]])).alias("tampered"))


def tampered(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("long").cast("string")) % 7 == 0


def verify_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), digests
    as lowercase hex: the manifest of ``docs`` with one tree per lang, and each
    row checked against it, with n_chars one higher where 7 divides the crc32 of
    the decimal doc_id.

    Rows ascend by doc_id, nulls first, equal ids by digest; null langs are one
    tree, a null n_chars stays as it is, a null doc_id is never tampered with.
    Repeated rows are leaves of their own.  An empty table has no rows; other
    columns than the five do not matter.
    """
    leaves = scratch_table(document_leaves(docs), "merkle-leaves")
    found = prove(build_manifest(leaves, ["doc_id"]), F.coalesce("tampered", "digest"))
    text = lambda c: F.lower(F.hex(c))
    return found.select("doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
                        text("proof").alias("proof_sha256"), text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))
