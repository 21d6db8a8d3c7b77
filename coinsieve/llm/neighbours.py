"""Nearest neighbours by inner product: stable projections under a kd-tree.

A few Gaussian (2-stable) projections of the vectors are cut by a kd-tree, fitted on a bounded
sample; every vector goes to its leaf, and the boxes of the leaves and their longest
vectors are taken from all vectors. A vector x of a leaf with a product of w or more with the
query q lies within |q|^2 + |x|^2 - 2 w of it, and the squared projected distance over the squared true
one is chi-square distributed. So a query visits leaves in the order of their projected
distance, less what their longest vector allows, verifies their vectors on the original coordinates,
and stops at the first leaf whose projected distance is above the quantile of ``CERTAINTY`` for
a vector as good as its k-th best. A leaf's box is nearer than its vectors are, so far more than
that share is found. Visits are made in rounds that grow fourfold; between rounds the best are kept.

Sixty-four neighbouring leaves are a page: a query goes to a page once a round, with the leaves it
wants there. Equal vectors are searched as one, with their k + 1 smallest numbers; so are queries
with equal vectors. Pages are cut into blocks of bounded size, past which queries stream.

Cases: vectors that are null, empty, zero, or hold null or non-finite components take no
part, nor do those whose length is not the commonest one (the smaller of equals). Of rows
with one vec_id the smallest vector counts; rows without vec_id take no part. Scores are
sums in order of components, in double precision. With fewer candidates all are returned.
Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coinsieve.llm import flat
from coinsieve.llm.storage import stored

PROJECTIONS = 10
SEED = 20240229
SAMPLE = 20_000  # vectors the tree is fitted on, at most
LEAF = 24  # vectors to a leaf on average, while MOST_LEAVES allows
MOST_LEAVES = 1 << 13
PAGE = 6  # bits of a leaf's number within its page
BLOCK = 4096  # vectors to a block of a page, about
PAIRS = 1 << 15  # pairs scored exactly at once
FIRST_LEAVES = 32
CERTAINTY = 0.9

HITS = "qid bigint, vec_id bigint, score double"
# Vectors of a page (kind 0, ``place`` is their leaf) and queries that visit it (kind 1, bits of leaves).
VISIT = "page int, block int, kind int, qid bigint, ids array<bigint>, v array<double>, place bigint, worst double"
VISIT_NAMES = [part.split(" ")[0] for part in VISIT.split(", ")]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): vectors that take part, as doubles."""
    v = F.col("v")
    rows = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0))
    rows = stored(rows.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    return rows.filter(F.size("v") == (sizes.size if sizes else 0))


def chi_square_quantile(p: float, freedom: int) -> float:
    """By bisection on the regularised lower gamma function (series)."""

    def below(x: float) -> float:
        a, y = freedom / 2, x / 2
        term = total = 1 / a
        n = a
        while term > total * 1e-15:
            n += 1
            term *= y / n
            total += term
        return total * math.exp(-y + a * math.log(y) - math.lgamma(a))

    low, high = 1e-9, 10.0 * freedom + 100
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


class Tree:
    """A complete kd-tree of ``depth`` levels over projected points."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.axis = np.zeros((1 << depth) - 1, np.int64)
        self.cut = np.zeros((1 << depth) - 1)
        groups = [points]
        for level in range(depth):
            following = []
            for i, part in enumerate(groups):
                node = (1 << level) - 1 + i
                if len(part):
                    self.axis[node] = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
                    self.cut[node] = float(np.median(part[:, self.axis[node]]))
                right = part[:, self.axis[node]] > self.cut[node]
                following += [part[~right], part[right]]
            groups = following

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        rows = np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[rows, self.axis[node]] > self.cut[node])
        return node - ((1 << self.depth) - 1)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def search(vectors: DataFrame, is_query, k: int = 20, statistics: dict | None = None) -> DataFrame:
    """query_id, rank, vec_id, score; ``is_query`` is a condition on vec_id.

    ``statistics`` takes the number of leaves, of different queries, and of leaves ``read`` by all of them.
    """
    spark = vectors.sparkSession
    context = spark.sparkContext
    rows = usable(vectors)
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    # Equal vectors: their smallest number names them; k + 1 numbers can come into a result.
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    first = rows.withColumn("place", place).filter(F.col("place") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asked = rows.groupBy("v").agg(F.max(F.when(is_query, 1).otherwise(0)).alias("asked"))
    classes = stored(first.join(asked, "v").withColumn("cid", F.col("ids")[0]), "classes")
    summary = classes.agg(
        F.count(F.lit(1)).alias("n"), F.sum("asked").alias("asked"),
        F.max(F.size("v")).alias("size"),
    ).first()
    if not summary.asked:
        return empty
    directions = np.random.default_rng(SEED).standard_normal((summary.size, PROJECTIONS))
    sample = classes.orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE).select("v").toArrow().column("v").combine_chunks()
    points = matrix(sample) @ directions
    leaves = min(MOST_LEAVES, max(1, summary.n // LEAF), max(1, len(points) // 2))
    tree = Tree(points, max(0, math.ceil(math.log2(leaves))))

    def place_in_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column(2))
            p = v @ directions
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tree.leaf(p)), pa.array(list(p), pa.list_(pa.float64())), pa.array(np.einsum("ij,ij->i", v, v))],
                names=["cid", "ids", "v", "leaf", "p", "length"],
            )

    placed = stored(
        classes.select("cid", "ids", "v").mapInArrow(
            place_in_leaf, "cid bigint, ids array<bigint>, v array<double>, leaf bigint, p array<double>, length double"
        ),
        "leaves",
    )
    box = [f(F.col("p")[i]).alias(f"{n}{i}") for n, f in (("low", F.min), ("high", F.max)) for i in range(PROJECTIONS)]
    boxes = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("length"), *box).orderBy("leaf").collect()  # at most MOST_LEAVES rows
    names = np.array([b.leaf for b in boxes])
    low = np.array([[b[f"low{i}"] for i in range(PROJECTIONS)] for b in boxes])
    high = np.array([[b[f"high{i}"] for i in range(PROJECTIONS)] for b in boxes])
    pages = (names >> PAGE) if len(names) else names
    sizes = np.bincount(pages, weights=[b.n for b in boxes], minlength=1)
    blocks_of = np.maximum(1, np.ceil(sizes / BLOCK)).astype(np.int64)
    layout = context.broadcast((names, low, high, np.array([b.length for b in boxes]), blocks_of))
    if statistics is not None:
        statistics |= {"leaves": len(names), "queries": summary.asked}
    large = {int(page): int(n) for page, n in enumerate(blocks_of) if n > 1}
    in_blocks = F.element_at(F.create_map(*[F.lit(x) for pair in large.items() for x in pair]), F.col("page")) if large else F.lit(1)
    page = F.shiftright("leaf", PAGE).cast("int")
    stock = (
        placed.withColumn("page", page)
        .withColumn("block", F.pmod(F.xxhash64("cid"), F.coalesce(in_blocks, F.lit(1))).cast("int"))
        .select("page", "block", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("qid"), "ids", "v",
                F.col("leaf").bitwiseAND(F.lit((1 << PAGE) - 1)).cast("bigint").alias("place"), F.lit(None).cast("double").alias("worst"))
    )
    queries = stored(classes.filter("asked = 1").select(F.col("cid").alias("qid"), F.col("v").alias("q")), "queries")
    quantile = chi_square_quantile(CERTAINTY, PROJECTIONS)

    def visits(begin: int, end: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            leaf, lows, highs, lengths, blocks = layout.value
            for whole in batches:
                for at in range(0, whole.num_rows, 256):
                    batch = whole.slice(at, 256)
                    q = matrix(batch.column(1))
                    p = q @ directions
                    off = np.zeros((len(p), len(lows)))
                    for i in range(PROJECTIONS):
                        off += np.maximum(np.maximum(lows[None, :, i] - p[:, i, None], p[:, i, None] - highs[None, :, i]), 0) ** 2
                    off -= quantile * lengths
                    order = np.argsort(off, axis=1, kind="stable")[:, begin:end]
                    worst = batch.column(2).to_numpy(zero_copy_only=False).astype(float)  # nan: fewer than k + 1 found
                    allowed = quantile * (np.einsum("ij,ij->i", q, q) - 2 * worst)
                    go = ~(np.take_along_axis(off, order, axis=1) > allowed[:, None])
                    row, column = np.nonzero(go)
                    chosen = leaf[order[row, column]]
                    wanted = np.zeros((len(p), len(blocks)), np.uint64)
                    bit = np.uint64(1) << (chosen & ((1 << PAGE) - 1)).astype(np.uint64)
                    np.bitwise_or.at(wanted, (row, chosen >> PAGE), bit)
                    row, page = np.nonzero(wanted)
                    mask, count = wanted[row, page], blocks[page]
                    row, page, mask = (np.repeat(x, count) for x in (row, page, mask))
                    block = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                    at_rows = pa.array(row)
                    n = len(row)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(page.astype(np.int32)), pa.array(block.astype(np.int32)), pa.array(np.ones(n, np.int32)),
                            batch.column(0).take(at_rows), pa.nulls(n, pa.list_(pa.int64())), batch.column(1).take(at_rows),
                            pa.array(mask.view(np.int64)), batch.column(2).take(at_rows),
                        ],
                        names=VISIT_NAMES,
                    )

        return run

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of vectors, each followed by the queries that visit it."""
        key, there, x, spot, ids = None, [], None, None, None
        for batch in batches:
            page, block, kind = (batch.column(i).to_numpy() for i in range(3))
            code = (page.astype(np.int64) << 32) + block * 2 + kind
            cuts = [0, *(np.flatnonzero(np.diff(code)) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:], strict=False):
                if start == end:
                    continue
                part = batch.slice(start, end - start)
                if kind[start] == 0:
                    if key != (page[start], block[start]):
                        key, there, x = (page[start], block[start]), [], None
                    there.append(part)
                    continue
                if key != (page[start], block[start]) or not there:
                    continue  # a block without vectors
                if x is None:
                    rows = pa.Table.from_batches(there).combine_chunks()
                    x, spot = matrix(rows.column("v").combine_chunks()), rows.column("place").to_numpy()
                    ids = rows.column("ids").combine_chunks()
                for at in range(0, part.num_rows, 512):
                    yield nearest(part.slice(at, 512), x, spot, ids)

    def nearest(asking: pa.RecordBatch, x: np.ndarray, spot: np.ndarray, ids: pa.ListArray) -> pa.RecordBatch:
        """The k + 1 best vectors of a block for each query, ties to smaller numbers."""
        q = matrix(asking.column(5))
        mask = asking.column(6).to_numpy()
        worst = asking.column(7).to_numpy(zero_copy_only=False).astype(float)
        rough = np.where((mask[:, None] >> spot[None]) & 1 == 1, q @ x.T, -np.inf)
        # What is within rounding of the cut may be among the best or tie with them.
        length = np.sqrt(np.einsum("ij,ij->i", q, q)) * np.sqrt(np.einsum("ij,ij->i", x, x).max())
        slack = 8 * x.shape[1] * np.finfo(float).eps * length
        near = min(k + 1, len(x))
        cut = np.partition(rough, len(x) - near, axis=1)[:, len(x) - near]
        cut = np.maximum(cut, np.where(np.isnan(worst), -np.inf, worst)) - slack
        row, column = np.nonzero((rough >= cut[:, None]) & (rough > -np.inf))
        # Sums in order of components, so equal inputs give equal scores anywhere.
        exact = np.empty(len(row))
        for at in range(0, len(row), PAIRS):
            r, c = row[at : at + PAIRS], column[at : at + PAIRS]
            total = np.zeros(len(r))
            for i in range(x.shape[1]):
                total += x[c, i] * q[r, i]
            exact[at : at + PAIRS] = total
        good = ~(exact < worst[row])
        row, column, exact = row[good], column[good], exact[good]
        starts, count = ids.offsets.to_numpy()[column], np.diff(ids.offsets.to_numpy())[column]
        flat_ids = ids.values.to_numpy()
        row, exact, starts = (np.repeat(y, count) for y in (row, exact, starts))
        vec = flat_ids[starts + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)]
        order = np.lexsort((vec, -exact, row))
        row, exact, vec = row[order], exact[order], vec[order]
        first = np.searchsorted(row, np.arange(len(q)))
        keep = np.arange(len(row)) - first[row] <= k
        qid = asking.column(3).take(pa.array(row[keep]))
        return pa.RecordBatch.from_arrays([qid, pa.array(vec[keep]), pa.array(exact[keep])], names=["qid", "vec_id", "score"])

    best = spark.createDataFrame([], HITS)
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    begin, step = 0, FIRST_LEAVES
    while begin < len(names):
        kth = best.groupBy("qid").agg(F.min("score").alias("worst"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > k)
        asking = queries.join(kth.select("qid", "worst"), "qid", "left").select("qid", "q", "worst")
        visit = stored(asking.mapInArrow(visits(begin, begin + step), VISIT), "visits")
        if visit.isEmpty():
            break
        if statistics is not None:
            statistics["read"] = statistics.get("read", 0) + visit.agg(F.sum(F.bit_count("place"))).first()[0]
        both = stock.unionByName(visit).repartition("page", "block").sortWithinPartitions("page", "block", "kind")
        hits = both.mapInArrow(verify, HITS)
        best = stored(
            best.unionByName(hits).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1).drop("place"), "best"
        )
        begin, step = begin + step, 4 * step
    members = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), "v")
    named = members.join(classes.select("v", F.col("cid").alias("qid")), "v").select("query_id", "qid")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        named.join(best, "qid")
        .filter("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(own))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
