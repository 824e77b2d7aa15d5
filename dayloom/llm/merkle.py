"""Merkle manifest of a dataset, by witnesses that grow with an append-only tree.

Rows are leaves, in ascending order of id within their tree (a language here); every ``ARITY``
consecutive nodes become one. ``Tree`` takes digests one after the other: each open run gives the nodes in it
partial witnesses, the digests on their left at once and those on their right as later siblings
are completed; a node's witness belongs to all leaves below it.

Distributed: leaves are numbered within their tree and cut into aligned blocks of ``ARITY ** BLOCK_LEVELS`` leaves,
each a full subtree, appended in a task of its own. The roots of a tree's blocks are further appends to the
same kind of tree, in blocks again, and the roots of all trees are the leaves of the top tree. A second pass
over the blocks extends the witnesses inside a block by those of its root. Only digests are shuffled, never
texts, and no task or group holds more than a block.

``Manifest`` keeps a dataset's digests in a folder and takes batches of new rows: complete blocks
are not read again, the last block of a tree is opened again.

Defined results: a null field is ``-`` in a leaf; null ids come first, rows of one id are ordered by
their leaf; exact copies are leaves each; a null tree comes first and is not the empty one; an empty
table has no rows and no root; a text of any length is hashed whole; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayloom.llm.common import ascii_lower, named, written
from dayloom.sources.tables import table_exists

#: Children of a node; levels of a block, which has 4096 leaves.
ARITY, BLOCK_LEVELS = 8, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WITNESS = "array<struct<left:string,right:string>>"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(n: int) -> int:
    """Levels above n nodes until one remains."""
    out = 0
    while n > 1:
        n, out = -(-n // ARITY), out + 1
    return out


class Node:
    """A node with the digests of its siblings so far, and its parent once its run is closed."""

    __slots__ = ("digest", "left", "right", "parent")

    def __init__(self, value: str, left: str):
        self.digest, self.left, self.right, self.parent = value, left, "", None


class Tree:
    """Appends digests; ``close`` ends the open runs up to a height."""

    def __init__(self):
        self.open: list[list[Node]] = []

    def append(self, value: str, level: int = 0) -> Node:
        if level == len(self.open):
            self.open.append([])
        run = self.open[level]
        node = Node(value, "".join([n.digest for n in run]))
        for earlier in run:
            earlier.right += value
        run.append(node)
        if len(run) == ARITY:
            self._complete(level)
        return node

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        parent = self.append(digest(*(n.digest for n in run)), level + 1)
        for node in run:
            node.parent = parent

    def close(self, height: int) -> str:
        """The root of everything appended, ``height`` levels above the leaves."""
        for level in range(height):
            if level < len(self.open) and self.open[level]:
                self._complete(level)
        return self.open[height][-1].digest


def witness(node: Node, height: int) -> list[tuple[str, str]]:
    """Digests left and right of a node and of its ancestors, ``height`` levels up."""
    out = []
    for _ in range(height):
        out.append((node.left, node.right))
        node = node.parent
    return out


def folded(leaf: str, proof: list[tuple[str, str]]) -> str:
    """The root that a leaf and its witness lead to."""
    for left, right in proof:
        leaf = digest(left, leaf, right)
    return leaf


def field_text(column: str) -> Column:
    """A field as it goes into a leaf."""
    value = named(column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(fields: tuple[str, ...] = FIELDS) -> Column:
    return F.sha2(F.concat(*(field_text(f) for f in fields)), 256)


def tree_key(lang: Column) -> Column:
    """A key that orders and joins: the null tree first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def leaves(docs: DataFrame, tampered: Column | None = None, doc_id: str = "doc_id", tree: str = "lang",
           text: str = "text", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """tree, doc_id, leaf, and ``altered``: the leaf of a row that ``tampered`` (over ``doc_id``) names, its text lower-cased."""
    altered = F.lit(None).cast("string")
    if tampered is not None:
        low = F.sha2(F.concat(*(field_text(f) if f != text else F.coalesce(
            F.concat(F.octet_length(named(text)).cast("string"), F.lit(":"), ascii_lower(named(text))), F.lit("-")) for f in fields)), 256)
        altered = F.when(tampered, low)
    return docs.select(tree_key(named(tree)).alias("tree"), named(doc_id).cast("long").alias("doc_id"),
                       leaf_digest(fields).alias("leaf"), altered.alias("altered"))


def numbered(rows: DataFrame, order: list[str], before: DataFrame | None = None) -> DataFrame:
    """Adds ``idx``, the place of each row in its tree, and ``n``, the tree's rows.

    Rows are dealt to ranges and sorted; counts of (range, tree) give each range its start, so that no tree
    meets in one task. Exact copies are dealt by their place, as they may be very many. ``before``
    (tree, n) holds rows that trees have already.
    """
    spread = rows.withColumn("_place", F.monotonically_increasing_id())
    ranged = spread.repartitionByRange("tree", *order, "_place").sortWithinPartitions("tree", *order, "_place").drop("_place")
    placed = written(ranged.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), "merkle-ranges")
    counts = placed.groupBy("_part", "tree").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    if before is not None:
        counts = counts.unionByName(before.select(F.lit(-1).alias("_part"), "tree", F.lit(0).cast("long").alias("_first"), F.col("n").alias("_rows")))
    over = Window.partitionBy("tree").orderBy("_part")
    starts = counts.select("_part", "tree", "_first", F.sum("_rows").over(Window.partitionBy("tree")).alias("n"), (
        F.coalesce(F.sum("_rows").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("_first")).alias("_shift"))
    return placed.join(starts.drop("_first"), ["_part", "tree"]).withColumn("idx", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def _appended(frame: pd.DataFrame, block_levels: int) -> tuple[list[Node], str, int]:
    """The nodes of a block in order, its root and its height. ``frame`` is sorted by ``idx``."""
    tree, height = Tree(), min(block_levels, levels(int(frame["n"].iloc[0])))
    nodes = [tree.append(d) for d in frame["leaf"]]
    return nodes, tree.close(height), height


def _block(block_levels: int) -> Column:
    return F.floor(F.col("idx") / ARITY**block_levels).cast("long").alias("_block")


def block_roots(nodes: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """tree, n, idx and leaf of the level above: one node for each block of (tree, n, idx, leaf)."""

    def close(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        _, root, _ = _appended(frame.sort_values("idx"), block_levels)
        n = int(frame["n"].iloc[0])
        return pd.DataFrame({"tree": [key[0]], "n": [-(-n // ARITY**block_levels)], "idx": [key[1]], "leaf": [root]})

    return nodes.select("tree", "n", "idx", "leaf", _block(block_levels)).groupBy("tree", "_block").applyInPandas(
        close, "tree string, n long, idx long, leaf string")


def _extended(nodes: DataFrame, upper: DataFrame, emit, schema: str, block_levels: int, more: tuple[str, ...] = ()) -> DataFrame:
    """Blocks of ``nodes`` appended again, each beside the witness of its own root in ``upper``."""
    own = nodes.select("tree", "n", "idx", "leaf", *more, _block(block_levels)).groupBy("tree", "_block")
    above = upper.select("tree", F.col("idx").alias("_block"), "witness", "subroot").groupBy("tree", "_block")

    def extend(frame: pd.DataFrame, one: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("idx")
        rest = [(w["left"], w["right"]) for w in one["witness"].iloc[0]]
        appended, _, height = _appended(frame, block_levels)
        proofs = (witness(node, height) + rest for node in appended)
        return emit(frame, proofs, one["subroot"].iloc[0])

    return own.cogroup(above).applyInPandas(extend, schema)


def witnesses(nodes: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """tree, idx, witness and subroot of every node (tree, n, idx, leaf) up to its tree's root.

    For levels above the leaves, where nodes are few; witnesses of leaves are made block by block.
    """
    closed = written(block_roots(nodes, block_levels), "merkle-blocks")

    def emit(frame: pd.DataFrame, proofs: Iterator, subroot: str) -> pd.DataFrame:
        return pd.DataFrame({"tree": frame["tree"], "idx": frame["idx"], "witness": [[{"left": a, "right": b} for a, b in p] for p in proofs],
                             "subroot": subroot})

    return _extended(nodes, upper_witnesses(closed, block_levels), emit, f"tree string, idx long, witness {WITNESS}, subroot string", block_levels)


def upper_witnesses(closed: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """The same for the roots of blocks: that of a tree of one block is the subroot itself."""
    alone = closed.where("n = 1").select("tree", "idx", F.array().cast(WITNESS).alias("witness"), F.col("leaf").alias("subroot"))
    rest = closed.where("n > 1")
    return alone if rest.isEmpty() else alone.unionByName(written(witnesses(rest, block_levels), "merkle-upper"))


def top(subroots: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """tree, top (its witness in the tree of all subroots) and root, from (tree, subroot)."""
    alone = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("_name"), F.col("subroot").alias("leaf"))
    placed = written(numbered(alone, ["_name"]), "merkle-top")
    found = witnesses(placed, block_levels)
    return placed.select("idx", "_name").join(found, "idx").select(
        F.col("_name").alias("tree"), F.col("witness").alias("top"), F.col("subroot").alias("root"))


def proofs(nodes: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, n_siblings, folded_root and verified of numbered leaves.

    ``nodes`` has tree, n, idx, doc_id, leaf and altered; a row's altered leaf, where it has one,
    is folded with the siblings of the true one.
    """
    closed = written(block_roots(nodes, block_levels), "merkle-blocks")
    upper = written(upper_witnesses(closed, block_levels), "merkle-witnesses")
    tops = written(top(upper.select("tree", "subroot").distinct(), block_levels), "merkle-tops")
    # A block's witness goes on to the root of all trees; ``subroot`` carries both roots.
    whole = upper.join(tops, "tree").select(
        "tree", "idx", F.concat("witness", "top").alias("witness"), F.concat_ws(" ", "subroot", "root").alias("subroot"))

    def emit(frame: pd.DataFrame, found: Iterator, roots: str) -> pd.DataFrame:
        subroot, root = roots.split(" ")
        rows = []
        for leaf, altered, proof in zip(frame["leaf"], frame["altered"], found):
            told = "".join([a + b for a, b in proof])
            rows.append((digest(told), len(told) // 64, folded(leaf if altered is None else altered, proof)))
        told, siblings, ends = zip(*rows)
        return pd.DataFrame({"doc_id": frame["doc_id"], "leaf": frame["leaf"], "subroot": subroot, "root": root, "proof_sha256": told,
                             "n_siblings": siblings, "folded_root": ends, "verified": [e == root for e in ends]})

    # As text, an id passes pandas whole, whether other ids are null or not.
    texts = nodes.withColumn("doc_id", F.col("doc_id").cast("string"))
    told = _extended(texts, whole, emit, "doc_id string, leaf string, subroot string, root string, proof_sha256 string, "
                     "n_siblings long, folded_root string, verified boolean", block_levels, ("doc_id", "altered"))
    return told.withColumn("doc_id", F.col("doc_id").cast("long"))


def manifest(docs: DataFrame, tampered: Column | None = None, doc_id: str = "doc_id", tree: str = "lang", text: str = "text",
             fields: tuple[str, ...] = FIELDS, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Every row's leaf, roots and proof; see ``proofs``."""
    found = leaves(docs, tampered, doc_id, tree, text, fields)
    nodes = written(numbered(found, ["doc_id", "leaf", "altered"]), "merkle-leaves")
    return proofs(nodes, block_levels)


class Manifest:
    """A manifest in a folder that grows by batches.

    Leaves of a batch follow those that their tree has, whatever their ids. A batch writes its leaves, the
    roots of the blocks it touches and the leaves of blocks still open, last its mark; a batch with a mark is not
    applied again, and one that was cut off is written anew. Of earlier leaves only those in open blocks are read.
    """

    def __init__(self, spark: SparkSession, folder: str, block_levels: int = BLOCK_LEVELS):
        self.spark, self.folder, self.block_levels = spark, folder, block_levels

    def _read(self, name: str, batches: list[int] | None = None) -> DataFrame:
        kinds = {"leaves": "tree string, doc_id long, leaf string, altered string, idx long, batch long",
                 "blocks": "tree string, n long, idx long, leaf string, batch long", "open": "tree string, idx long, leaf string, batch long"}
        path = f"{self.folder}/{name}"
        done = self.batches() if batches is None else batches
        if not done:
            return self.spark.createDataFrame([], kinds[name])
        parts = self.spark.read.schema(kinds[name]).option("basePath", path)
        return parts.parquet(*(f"{path}/batch={b}" for b in done))

    def batches(self) -> list[int]:
        """Numbers of the batches that are complete: one mark each."""
        path = f"{self.folder}/marks"
        if not table_exists(self.spark, path):
            return []
        marks = self.spark.read.schema("batch long").option("recursiveFileLookup", True).parquet(path)
        return sorted(r["batch"] for r in marks.distinct().collect())

    def counts(self) -> DataFrame:
        """tree and n of the leaves so far, from the newest block of each tree: one row for each block is read."""
        return self._read("blocks").groupBy("tree").agg(F.max("n").alias("n"))

    def append(self, batch: int, docs: DataFrame, **columns) -> bool:
        """Adds the rows of a batch; False if it was added before. Batches come in ascending order."""
        done = self.batches()
        if batch in done:
            return False
        if done and batch < done[-1]:
            raise ValueError(f"batch {batch} comes after batch {done[-1]}")
        before = written(self.counts(), "merkle-counts")
        found = numbered(leaves(docs, None, **columns), ["doc_id", "leaf", "altered"], before)
        found.select("tree", "doc_id", "leaf", "altered", "idx").write.mode("overwrite").parquet(f"{self.folder}/leaves/batch={batch}")
        new = self._read("leaves", [batch])
        open_now = self._read("open", done[-1:]).select("tree", "idx", "leaf").unionByName(new.select("tree", "idx", "leaf"))
        grown = new.groupBy("tree").agg((F.max("idx") + 1).alias("n"))
        size = ARITY**self.block_levels
        closed = block_roots(open_now.join(grown, "tree"), self.block_levels).drop("n").join(grown, "tree")
        closed.select("tree", F.least("n", (F.col("idx") + 1) * size).alias("n"), "idx", "leaf").write.mode("overwrite").parquet(
            f"{self.folder}/blocks/batch={batch}")
        # A block that is not full stays open, also in trees that did not grow.
        left = open_now.join(grown, "tree", "left").where(f"n is null or idx >= floor(n / {size}) * {size}")
        left.select("tree", "idx", "leaf").write.mode("overwrite").parquet(f"{self.folder}/open/batch={batch}")
        self.spark.range(batch, batch + 1, 1, 1).toDF("batch").write.mode("overwrite").parquet(f"{self.folder}/marks/mark-{batch}")
        return True

    def blocks(self) -> DataFrame:
        """tree, n (blocks of the tree), idx and leaf of every block, as of its newest batch."""
        newest = self._read("blocks").groupBy("tree", "idx").agg(F.max_by("leaf", "batch").alias("leaf"))
        return newest.select("tree", F.count("*").over(Window.partitionBy("tree")).alias("n"), "idx", "leaf")

    def roots(self) -> DataFrame:
        """tree, subroot and root, from the roots of blocks alone."""
        upper = written(upper_witnesses(written(self.blocks(), "merkle-blocks"), self.block_levels), "merkle-witnesses")
        subroots = upper.select("tree", "subroot").distinct()
        return subroots.join(top(subroots, self.block_levels), "tree").select("tree", "subroot", "root")

    def prove(self) -> DataFrame:
        """Proofs of all leaves; see ``proofs``."""
        kept = self._read("leaves")
        counted = kept.join(self.counts(), "tree").select("tree", "n", "idx", "doc_id", "leaf", "altered")
        return proofs(written(counted, "merkle-leaves"), self.block_levels)
