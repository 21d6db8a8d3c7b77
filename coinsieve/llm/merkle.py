"""Merkle manifest of a table: a leaf per row, a subtree per source, one root.

Leaves of a source are numbered by doc_id with a range partitioning, so no task holds
a source. They are dealt out in aligned blocks of ARITY ** BLOCK_LEVELS. A block is a
stream of appends: every leaf opens a subtree with an empty witness, and each time a run
of siblings completes, the witnesses of all leaves below grow by the other nodes of
the run. The roots of the blocks are appended again in the same way, block of blocks by
block of blocks, until one node is left; so are the subroots, in the order of the sources.
A leaf's whole witness is its own block's, then those of the blocks above it.

Cases: a null is written ``-`` in a leaf, an empty text ``0:``. Rows without doc_id come
first in their source, and rows of one doc_id are ordered by their leaves; repeated rows
are leaves of their own, with equal digests in neighbouring places. Rows without source are
one source, the first. A single leaf is its own subroot, and a single subroot the root. An
empty table has no rows and no root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from coinsieve.llm.storage import checkpointed, stored
from coinsieve.operators.skew import attach, with_row_number

ARITY = 3
BLOCK_LEVELS = 6

#: Columns of a leaf, in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
INTEGERS = ("doc_id", "n_chars")


def joined(digests: list[bytes]) -> bytes:
    """Digest of digests, each written in hex."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def levels_above(n: int, arity: int = ARITY) -> int:
    """How often n nodes are joined until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


class Subtrees:
    """Open subtrees of a stream of appended nodes.

    ``witness[i]`` holds the siblings of node i met so far, from its own level upwards.
    """

    def __init__(self, arity: int = ARITY):
        self.arity = arity
        self.witness: list[bytearray] = []
        # Per level, the open run: (digest, first node below, end).
        self.open: list[list[tuple[bytes, int, int]]] = []

    def append(self, digest: bytes) -> None:
        place = len(self.witness)
        self.witness.append(bytearray())
        self._push(0, (digest, place, place + 1))
        level = 0
        while len(self.open[level]) == self.arity:
            self._complete(level)
            level += 1

    def _push(self, level: int, node: tuple[bytes, int, int]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)

    def _complete(self, level: int) -> None:
        """Join the open run of a level and extend the witnesses below it."""
        run, self.open[level] = self.open[level], []
        for i, (_, first, end) in enumerate(run):
            others = b"".join(node[0] for k, node in enumerate(run) if k != i)
            for place in range(first, end):
                self.witness[place] += others
        self._push(level + 1, (joined([node[0] for node in run]), run[0][1], run[-1][2]))

    def close(self, levels: int) -> bytes:
        """Join what is still open, up to the given level; the digest left there."""
        for level in range(levels):
            if level < len(self.open) and self.open[level]:
                self._complete(level)
        return self.open[levels][0][0]


def fold(leaf: bytes, witness: bytes, place: int, n: int, arity: int = ARITY) -> tuple[bytes, bytes]:
    """The root of n nodes that a leaf at ``place`` and its siblings give, and the
    rest of the witness, which belongs to higher trees."""
    at, size = 0, len(leaf)
    while n > 1:
        first = place - place % arity
        others = min(arity, n - first) - 1
        run = [witness[at + size * k : at + size * (k + 1)] for k in range(others)]
        run.insert(place - first, leaf)
        leaf, at = joined(run), at + size * others
        place, n = place // arity, -(-n // arity)
    return leaf, witness[at:]


def leaf_digest(text: Column | None = None) -> Column:
    """sha256 of a row's fields: the byte count, ``:`` and the value of each, ``-`` for nulls."""

    def written(name: str) -> Column:
        value = text if name == "text" and text is not None else F.col(name)
        value = value.cast("bigint").cast("string") if name in INTEGERS else value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[written(name) for name in FIELDS]).cast("binary"), 256))


def _witnessed(nodes: DataFrame, arity: int, block_levels: int) -> DataFrame:
    """Nodes with their block, the witness inside it, and its root; other columns stay."""
    size = arity**block_levels
    blocks = nodes.withColumn("block", F.floor(F.col("place") / size).cast("bigint"))
    schema = T.StructType([*blocks.schema.fields, T.StructField("witness", T.BinaryType()), T.StructField("root", T.BinaryType())])

    def finished(parts: list[pa.RecordBatch], subtrees: Subtrees) -> pa.RecordBatch:
        rows = pa.concat_batches(parts)
        n = rows.column(rows.schema.get_field_index("n"))[0].as_py()
        root = subtrees.close(min(block_levels, levels_above(n, arity)))
        witness = pa.array([bytes(w) for w in subtrees.witness], pa.binary())
        return pa.RecordBatch.from_arrays(
            [*rows.columns, witness, pa.array([root] * rows.num_rows, pa.binary())], names=[*rows.schema.names, "witness", "root"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        key, subtrees = None, Subtrees(arity)
        for batch in batches:
            grp, block, digest = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("grp", "block", "digest"))
            start = 0
            for i in range(batch.num_rows):
                if key is not None and key != (grp[i], block[i]):
                    yield finished([*parts, batch.slice(start, i - start)], subtrees)
                    parts, start, subtrees = [], i, Subtrees(arity)
                key = grp[i], block[i]
                subtrees.append(digest[i])
            parts.append(batch.slice(start))
        if key is not None:
            yield finished(parts, subtrees)

    dealt = blocks.repartition("grp", "block").sortWithinPartitions("grp", "block", "place")
    return dealt.mapInArrow(run, schema)


def trees(nodes: DataFrame, arity: int = ARITY, block_levels: int = BLOCK_LEVELS) -> tuple[DataFrame, DataFrame]:
    """The trees of groups of nodes.

    ``nodes``: grp, place (0, 1, ... in its group), n (nodes of the group), digest, and any
    other columns. Returns the nodes with their block and the witness inside it, and (grp, block, witness, root) for
    the blocks: what continues the witnesses, and the root of the group.
    """
    made = stored(_witnessed(nodes, arity, block_levels), "merkle")
    size = arity**block_levels
    heads = made.filter(F.col("place") % size == 0)
    tops = heads.select("grp", "block", "n", F.col("root").alias("digest"))
    if not made.filter(F.col("n") > size).take(1):
        return made, tops.select("grp", "block", F.lit(b"").alias("witness"), F.col("digest").alias("root"))
    above, higher = trees(
        tops.select("grp", F.col("block").alias("place"), F.ceil(F.col("n") / size).cast("bigint").alias("n"), "digest"),
        arity, block_levels,
    )
    up = higher.select("grp", "block", F.col("witness").alias("more"), F.col("root").alias("group_root"))
    whole = above.join(up, ["grp", "block"]).select(
        "grp", F.col("place").alias("block"), F.concat("witness", "more").alias("witness"), F.col("group_root").alias("root")
    )
    return made, whole


def numbered(leaves: DataFrame) -> DataFrame:
    """Leaves with grp (the rank of their source, from 0), and place and n in it."""
    order = ["source", "doc_id", "digest", "tie"]
    placed = checkpointed(
        leaves.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33))
    )
    # A row per source and partition: where the source begins in it, and what lies before.
    pieces = placed.groupBy("source", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    ranks = with_row_number(pieces.select("source").distinct(), [F.col("source")], "grp").withColumnRenamed("source", "name")
    by_source = Window.partitionBy("source")
    before = by_source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("source_key")
    shifts = (
        pieces.withColumns({"n": F.sum("rows").over(by_source), "before": F.coalesce(F.sum("rows").over(before), F.lit(0))})
        .join(ranks, F.col("source").eqNullSafe(F.col("name")))
        .select("part", key, (F.col("grp") - 1).alias("grp"), "n", (F.col("before") - F.col("first")).alias("shift"))
    )
    # By source and partition no key has more rows than a partition.
    out = attach(placed.select("*", key), shifts, ["part", "source_key"], "tie")
    return out.withColumn("place", F.col("at") + F.col("shift")).drop("part", "source_key", "at", "shift", "tie")


def manifest(docs: DataFrame, arity: int = ARITY, block_levels: int = BLOCK_LEVELS, changed: Column | None = None) -> DataFrame:
    """Every row as a leaf with its witness.

    Columns: doc_id, source, leaf, place and n (in its source), grp and n_groups (of the source
    among all), witness (siblings from the leaf to the root), subroot, root, and changed_leaf: the leaf
    digest with ``changed`` in place of the text (null where that is the same).
    """
    own = leaf_digest()
    other = F.lit(None).cast("binary") if changed is None else F.nullif(leaf_digest(changed), own)
    leaves = stored(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
            own.alias("digest"), other.alias("changed_leaf"), F.monotonically_increasing_id().alias("tie"),
        ),
        "leaves",
    )
    nodes, blocks = trees(numbered(leaves), arity, block_levels)
    blocks = stored(blocks, "blocks")
    subroots = blocks.filter("block = 0").select("grp", F.col("root").alias("digest"))
    top_nodes, top_blocks = trees(
        subroots.select(F.lit(0).cast("bigint").alias("grp"), F.col("grp").alias("place"),
                        F.lit(subroots.count()).cast("bigint").alias("n"), "digest"),
        arity, block_levels,
    )
    top_up = top_blocks.select("block", F.col("witness").alias("more"), F.col("root").alias("top"))
    tops = top_nodes.join(top_up, "block").select(
        F.col("place").alias("grp"), F.col("n").alias("n_groups"), F.concat("witness", "more").alias("above"), "top"
    )
    # One row per block: from its root to the root of all.
    upper = attach(blocks, tops, "grp", "block").select(
        "grp", "block", F.col("root").alias("subroot"), F.concat("witness", "above").alias("above"), "n_groups", F.col("top").alias("all_root"),
    )
    return attach(nodes, upper, ["grp", "block"], "place").select(
        "doc_id", "source", F.col("digest").alias("leaf"), "changed_leaf", "place", "n", "grp", "n_groups",
        F.concat("witness", "above").alias("witness"), "subroot", F.col("all_root").alias("root"),
    )


def verified(leaves: DataFrame, arity: int = ARITY) -> DataFrame:
    """Rows of ``manifest`` with ``folded``: the root from the changed leaf, else the own
    one, and the witness."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            column = {name: batch.column(i).to_pylist() for i, name in enumerate(names)}
            folded = []
            for i in range(batch.num_rows):
                leaf = column["changed_leaf"][i] or column["leaf"][i]
                subroot, rest = fold(leaf, column["witness"][i], column["place"][i], column["n"][i], arity)
                folded.append(fold(subroot, rest, column["grp"][i], column["n_groups"][i], arity)[0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(folded, pa.binary())], names=[*names, "folded"])

    schema = T.StructType([*leaves.schema.fields, T.StructField("folded", T.BinaryType())])
    return leaves.mapInArrow(run, schema)


def document_manifest(docs: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Leaf, subroot, root, digest of the proof, and the check against tampered texts."""
    # Null texts stay null when tampered with, so their leaf is the same.
    tampering = F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary")) % 2 == 0
    text = F.when(tampering, F.translate(F.col("text").cast("string"), "\n", "")).otherwise(F.col("text").cast("string"))
    shown = lambda name: F.lower(F.hex(name))
    return verified(manifest(docs, block_levels=block_levels, changed=text)).select(
        "doc_id", shown("leaf").alias("leaf"), shown("subroot").alias("subroot"), shown("root").alias("root"),
        F.sha2(F.lower(F.hex("witness")).cast("binary"), 256).alias("proof_sha256"),
        shown("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )
