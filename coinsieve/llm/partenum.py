"""N-gram Jaccard join with PartEnum signatures.

A document's set holds the hashes of its distinct word n-grams. Sizes fall into
bands such that sets that can link lie in one band or in two neighbouring ones;
each set takes part in its own band and in the next. For a band, the largest
symmetric difference k of a linking pair is known. The hash domain is cut into
groups, each group into parts, and a signature is the content of a group but for
some left-out parts: two sets that differ in at most k elements share one.

* k = 0: one signature, the whole set.
* k < 16: (k + 1) / 2 groups of three parts, each part left out in turn. Some group
  holds at most one difference, so one of its three signatures agrees.
* else k + 1 groups of one part: some group holds no difference.

Signatures are counted first (smallest and largest set key under each). Sets under
a signature that has more than one are compared with its smallest one, by exact
intersection; components follow. Where members of a signature still lie in several
components, they are compared with the centre c of the largest of them. A set x that
does not link with c either can link with a member y only if x and y share enough of
their differences from c, since |x ^ y| = |(x ^ c) ^ (y ^ c)|. How many depends on both, so
members are told apart in buckets by what they ask for. Towards each bucket the rarest
differences, as many as the bound leaves (prefix filter), are joined, and the pairs that share
one are compared. No link is lost, and no group is compared pair by pair.

Where the threshold makes groups small (below 8 elements on average, k >= 16),
groups with no element (with at most one, k >= 32) give no signature. A pair at the
very threshold is then lost only if every group without a difference is that thin:
about a third of k + 1 groups have none, so that is below one in 100,000 for k = 16 and
falls with every element. At a threshold of 0.9 all groups count.

Cases: null and empty texts have an empty set, link with nothing and are their own
component. Texts with fewer words than n form one element of all words. Equal sets
are one key. Rows without doc_id link like others but never name a component.
Repeated rows each come back. Other columns are not read. Keys are 64-bit hashes: sets
with one key count as equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinsieve.llm import flat
from coinsieve.llm.membership import bits_for, build_filter, maybe
from coinsieve.llm.storage import stored

ENUMERATE_BELOW = 16
FULL_GROUPS = 8
# What sets ask for is told apart by this part of the centre's size.
BUCKETS = 32


class Bands:
    """Size bands and their group numbers for a threshold num / den."""

    def __init__(self, num: int, den: int):
        if not 0 < num <= den:
            raise ValueError("the threshold lies in (0, 1]")
        self.num, self.den = num, den
        self.low, self.k = [1], []

    def number(self, size: int) -> int:
        while self.low[-1] <= size:
            self._add()
        return int(np.searchsorted(self.low, size, side="right")) - 1

    def difference(self, band: int) -> int:
        while len(self.k) <= band:
            self._add()
        return self.k[band]

    def _add(self) -> None:
        high = self.low[-1] * self.den // self.num
        # |A ^ B| <= (1 - t) / (1 + t) * (|A| + |B|) for a pair with Jaccard t or more.
        self.k.append((self.den - self.num) * 2 * high // (self.den + self.num))
        self.low.append(high + 1)


def signatures(elements: np.ndarray, bands: Bands) -> np.ndarray:
    """All signatures of one sorted set."""
    size = len(elements)
    sums = np.r_[np.uint64(0), np.cumsum(flat.mix(elements + np.uint64(0x632BE59BD9B4E019)))]
    own = bands.number(size)
    out = []
    for band in (own, own + 1):
        k = bands.difference(band)
        tag = flat.mix(np.array([band], np.uint64) + np.uint64(0x9E6C63D0676A9A99))
        if k == 0:
            out.append(flat.mix(sums[-1:] + tag))
            continue
        groups, parts = ((k + 2) // 2, 3) if k < ENUMERATE_BELOW else (k + 1, 1)
        pieces = groups * parts
        bounds = np.arange(1, pieces, dtype=np.uint64) * np.uint64((1 << 64) // pieces)
        edges = np.r_[0, np.searchsorted(elements, bounds), size]
        content = (sums[edges[1:]] - sums[edges[:-1]]).reshape(groups, parts)
        label = flat.mix(np.arange(pieces, dtype=np.uint64) + tag)
        if parts > 1:
            out.append(flat.mix((content.sum(axis=1, keepdims=True) - content).ravel() + label))
            continue
        made = flat.mix(content.ravel() + label)
        if size < FULL_GROUPS * groups:
            made = made[np.diff(edges) > (1 if k >= 2 * ENUMERATE_BELOW else 0)]
        out.append(made)
    return np.concatenate(out)


def sets(data: np.ndarray, at: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each document of a chunk."""
    data = flat.lower_ascii(data)
    starts, ends, first = flat.find_words(data, at)
    words = flat.hash_words(data, starts, ends)
    grams = flat.gram_hashes(words, n)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        elif b > a:
            yield flat.gram_hashes(words[a:b], b - a) ^ np.uint64(0x5851F42D4C957F2D + b - a)
        else:
            yield np.zeros(0, np.uint64)


def set_key(elements: np.ndarray) -> int:
    """One number for a set; sets that differ have different ones (64 bits)."""
    total = np.array([np.sum(flat.mix(elements)) + np.uint64(len(elements))], np.uint64)
    return int(flat.mix(total).view(np.int64)[0])


def per_set(docs: DataFrame, n: int, emit, schema: str, names: list[str]) -> DataFrame:
    """mapInArrow over (doc_id, text): ``emit(ids, keys, sets)`` gives the columns of a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, at in flat.chunks(batch):
                elements = list(sets(data, at, n))
                keys = np.array([set_key(e) if len(e) else 0 for e in elements], np.int64)
                columns = emit(batch.column(0).slice(a, b - a), keys, elements)
                if columns is not None:
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, schema)


def slim_rows(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, n, key) of every row; the key of an empty set is null."""

    def emit(ids, keys, elements):
        sizes = np.array([len(e) for e in elements], np.int64)
        return [ids, pa.array(sizes), pa.array(keys, mask=sizes == 0)]

    return per_set(docs, n, emit, "doc_id bigint, n bigint, key bigint", ["doc_id", "n", "key"])


def signature_rows(docs: DataFrame, n: int, num: int, den: int, shared=None) -> DataFrame:
    """(sig, key) of every set, once for equal sets of a chunk; with ``shared`` only
    signatures that the filter may hold."""

    def emit(ids, keys, elements):
        bands = Bands(num, den)
        found, owners = [], []
        for key, place in zip(*np.unique(keys, return_index=True), strict=True):
            if not len(elements[place]):
                continue
            made = signatures(elements[place], bands)
            if shared is not None:
                made = made[maybe(shared.value, made)]
            found.append(made)
            owners.append(np.full(len(made), key, np.int64))
        if not found:
            return None
        return [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(owners))]

    return per_set(docs, n, emit, "sig bigint, key bigint", ["sig", "key"])


def wanted_sets(docs: DataFrame, n: int, wanted) -> DataFrame:
    """(key, elements) of the sets whose key the filter may hold, once for each chunk."""

    def emit(ids, keys, elements):
        distinct, place = np.unique(keys, return_index=True)
        take = [i for i, ok in zip(place, maybe(wanted.value, distinct), strict=True) if ok and len(elements[i])]
        ends = np.r_[0, np.cumsum([len(elements[i]) for i in take])].astype(np.int32)
        flat_elements = np.concatenate([elements[i] for i in take]) if take else np.zeros(0, np.uint64)
        return [
            pa.array(keys[take] if take else np.zeros(0, np.int64)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(flat_elements.view(np.int64))),
        ]

    return per_set(docs, n, emit, "key bigint, elements array<bigint>", ["key", "elements"])


def sets_of(docs: DataFrame, n: int, keys: DataFrame) -> DataFrame:
    """(key, elements) for every key of ``keys``, stored."""
    wanted = docs.sparkSession.sparkContext.broadcast(build_filter(keys, F.col("key"), bits_for(keys.count())))
    rows = wanted_sets(docs, n, wanted).join(keys.distinct(), "key", "left_semi")
    out = stored(rows.dropDuplicates(["key"]), "sets")
    wanted.unpersist()
    return out


def compared(docs: DataFrame, n: int, pairs: DataFrame, num: int, den: int) -> DataFrame:
    """``pairs`` (a, b, more columns) with both sets, their common size and whether they link."""
    rows = sets_of(docs, n, pairs.select(F.explode(F.array("a", "b")).alias("key")))
    left = rows.select(F.col("key").alias("a"), F.col("elements").alias("left"))
    right = rows.select(F.col("key").alias("b"), F.col("elements").alias("right"))
    both = F.size(F.array_intersect("left", "right")).cast("long")
    union = F.size("left") + F.size("right") - F.col("both")
    return (
        pairs.join(left, "a").join(right, "b").withColumn("both", both)
        .withColumn("links", F.col("both") * den >= union * num)
    )


def components(edges: DataFrame) -> DataFrame:
    """(key, label): the smallest key of each component of the edges (a, b).

    Alternating large-star and small-star steps; every step is an aggregate and a join,
    so a vertex with many edges is pre-aggregated and its join side can be split.
    """
    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    if edges.isEmpty():
        return edges.select(F.col("b").alias("key"), F.col("a").alias("label"))
    before = None
    while True:
        # Large star: every larger neighbour of a vertex moves to its smallest one.
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()
        # Small star: a vertex and its smaller neighbours move to the smallest one.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b")
        edges = stored(
            small.select(F.col("m").alias("a"), F.col("a").alias("b"))
            .union(least.select(F.col("m").alias("a"), "b"))
            .filter("a <> b")
            .distinct(),
            "edges",
        )
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            return edges.select(F.col("b").alias("key"), F.col("a").alias("label"))
        before = state


def linked(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(key, label) for every set key that links with another one."""
    spark = docs.sparkSession
    shared = stored(
        signature_rows(docs, n, num, den)
        .groupBy("sig")
        .agg(F.min("key").alias("low"), F.max("key").alias("high"))
        .filter("low < high"),
        "signatures",
    )
    bitmap = spark.sparkContext.broadcast(build_filter(shared, F.col("sig"), bits_for(shared.count())))
    rows = signature_rows(docs, n, num, den, bitmap)
    members = stored(rows.join(shared, "sig").select("sig", "key", "low").distinct(), "members")
    bitmap.unpersist()
    star = stored(members.filter("key <> low").select(F.col("low").alias("a"), F.col("key").alias("b")).distinct(), "star")
    apart = F.size("left") + F.size("right") - 2 * F.col("both")
    found = stored(compared(docs, n, star, num, den).select("a", "b", "links", apart.alias("apart")), "found")
    edges = found.filter("links")
    labels = components(edges.select("a", "b"))
    # Signatures whose members lie in several components.
    placed = members.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    spread = placed.groupBy("sig").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l < h")
    open_rows = stored(placed.join(spread.select("sig"), "sig", "left_semi").select("sig", "key", "label"), "open")
    if open_rows.isEmpty():
        return labels
    # Each belongs to the family of its largest component, around that one's centre: the
    # member nearest to the smallest key.
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    main = (
        open_rows.select("sig", "label").distinct().join(sizes, "label", "left").groupBy("sig")
        .agg(F.max_by("label", F.struct(F.coalesce("n", F.lit(0)), -F.col("label"))).alias("family"))
    )
    family = stored(open_rows.join(main, "sig").select("family", "key").distinct(), "family")
    nearest = edges.groupBy(F.col("a").alias("family")).agg(F.min_by("b", F.struct("apart", "b")).alias("near"))
    centre = family.select("family").distinct().join(nearest, "family", "left").select(
        "family", F.coalesce("near", "family").alias("a")
    )
    pairs = stored(family.join(centre, "family").filter("key <> a").select("family", "a", F.col("key").alias("b")), "pairs")
    differences = F.concat(F.array_except("left", "right"), F.array_except("right", "left"))
    around = stored(
        compared(docs, n, pairs, num, den).select(
            "family", "a", "b", "links", F.size("left").alias("size_a"), F.size("right").alias("size_b"), differences.alias("d")
        ),
        "differences",
    )
    known = labels.select(F.col("label").alias("a"), F.col("key").alias("b"))
    labels = components(known.union(around.filter("links").select("a", "b")))
    more = stored(linked_by_differences(around, labels, num, den), "more")
    if more.isEmpty():
        return labels
    known = labels.select(F.col("label").alias("a"), F.col("key").alias("b"))
    return components(known.union(more))


def linked_by_differences(around: DataFrame, labels: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): the pairs of a family, in different components, that link.

    ``around`` holds for each member b its differences d from the centre a. Let x be a
    member outside the centre's component and y another one; with t the threshold and
    r = (1 - t) / (1 + t), they link if |x ^ y| <= r (|x| + |y|), that is if they share
    (asks_x + asks_y) / 2 differences or more, where asks = |d| - r size. As x does not link
    with the centre c, asks_x > r |c| > -asks_y, so that is one at least.
    """
    r = (den - num) / (den + num)
    where = labels.select(F.col("key").alias("b"), F.col("label").alias("label"))
    centre = labels.select(F.col("key").alias("a"), F.col("label").alias("centre_label"))
    rows = (
        around.join(where, "b", "left").join(centre, "a", "left")
        .withColumn("label", F.coalesce("label", "b"))
        .withColumn("outside", F.col("label") != F.coalesce("centre_label", "a"))
    )
    families = rows.groupBy("family").agg(F.max("outside").alias("any"), F.count(F.lit(1)).alias("n"))
    families = families.filter("any AND n > 1").select("family", "any")
    rows = stored(rows.join(families, "family"), "rows")
    elements = rows.select("family", "b", F.explode("d").alias("e"))
    counted = elements.join(elements.groupBy("family", "e").agg(F.count(F.lit(1)).alias("n")), ["family", "e"])
    # The rarest first; one row holds the differences of one set.
    listed = F.array_sort(F.collect_list(F.struct("n", "e")))
    ordered = counted.groupBy("family", "b").agg(
        F.transform(listed, lambda x: x["e"]).alias("d"), F.count_if(F.col("n") > 1).alias("common")
    )
    rows = stored(rows.drop("d").join(ordered, ["family", "b"]), "ordered")
    pairs = sharing(rows, r).distinct()
    # Compared by their differences, which are far fewer than their elements.
    sides = [
        rows.select("family", F.col("b").alias(k), F.col("d").alias(f"d{k}"), F.col("size_b").alias(f"size_{k}")) for k in "xy"
    ]
    far = F.size("dx") + F.size("dy") - 2 * F.size(F.array_intersect("dx", "dy"))
    both = (F.col("size_x") + F.col("size_y") - far) / 2
    return (
        pairs.join(sides[0], ["family", "x"]).join(sides[1], ["family", "y"]).withColumn("both", both)
        .filter(F.col("both") * den >= (F.col("size_x") + F.col("size_y") - F.col("both")) * num)
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    )


def sharing(rows: DataFrame, r: float) -> DataFrame:
    """(family, x, y), once or more: members that may share as many differences as they must.

    ``rows``: a member's differences d, the rarest first, and how many of them are ``common``.
    """
    # A difference that no other member has comes first, and is never shared: only those behind it
    # count. |x ^ y| >= |dx| - room_y follows, and the other way round.
    own, width = F.size("d"), F.greatest(F.col("size_a") / BUCKETS, F.lit(1.0))
    sides = rows.withColumns({
        "asks": own - r * F.col("size_b"), "room": 2 * F.col("common") - own + r * F.col("size_b"), "width": width,
    }).withColumn("bucket", F.floor(F.col("asks") / F.col("width")).cast("int"))

    def prefixes(members: DataFrame, others: DataFrame, side: str) -> DataFrame:
        """For each bucket of ``others`` the rarest differences, one of which is shared with any
        of its sets that links: as many as the least that a set of the bucket asks for leaves."""
        best = others.groupBy("family", "bucket").agg(F.max("room").alias("best"))
        best = best.groupBy("family").agg(F.collect_list(F.struct("bucket", "best")).alias("buckets"))

        def length(other):
            need = F.greatest(F.ceil((F.col("asks") + other["bucket"] * F.col("width")) / 2 - 1e-6), F.lit(1))
            return (F.col("common") - need + 1).cast("int")

        # Most members ask for more than most buckets can give: those get no row.
        able = F.filter("buckets", lambda other: (F.col("asks") <= other["best"] + 1e-6) & (length(other) > 0))
        return (
            members.join(best, "family").withColumn("other", F.explode(able)).withColumn("length", length(F.col("other")))
            .withColumn("towards", F.col("other.bucket"))
            .select(
                *[F.col(c).alias(f"{c}_{side}") for c in ("family", "label", "outside", "asks", "common", "bucket", "towards")],
                F.col("b").alias(side),
                F.posexplode(F.slice("d", (own - F.col("common") + 1).cast("int"), F.col("length"))).alias(f"at_{side}", f"e_{side}"),
            )
        )

    x, y = prefixes(sides.filter("outside"), sides, "x"), prefixes(sides, sides.filter("outside"), "y")
    same = (
        (F.col("family_x") == F.col("family_y")) & (F.col("e_x") == F.col("e_y"))
        & (F.col("bucket_x") == F.col("towards_y")) & (F.col("towards_x") == F.col("bucket_y"))
    )
    # What a pair shares begins at its first shared difference: enough must be left there.
    left = F.least(F.col("common_x") - F.col("at_x"), F.col("common_y") - F.col("at_y"))
    fits = (
        (left >= (F.col("asks_x") + F.col("asks_y")) / 2 - 1e-6) & (F.col("label_x") != F.col("label_y"))
        & (~F.col("outside_y") | (F.col("x") < F.col("y")))
    )
    return x.join(y, same & fits).select(F.col("family_x").alias("family"), "x", "y")


def jaccard_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) for every row."""
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    labels = linked(docs, n, num, den)
    slim = stored(slim_rows(docs, n), "slim")
    grouped = slim.groupBy("key").agg(F.min("doc_id").alias("least")).filter("key IS NOT NULL")
    labelled = stored(
        grouped.join(labels, "key", "left").select("key", "least", F.coalesce("label", "key").alias("label")),
        "labelled",
    )
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = labelled.join(least, "label").select("key", "component_id")
    return slim.join(named, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one document of each component: the one with its smallest doc_id.

    A doc_id names one document: of repeated rows one stays. Rows without doc_id all stay.
    """
    made = stored(jaccard_components(docs, n, num, den), "components").filter("doc_id IS NOT NULL")
    gone = made.filter("component_id < doc_id").select(F.col("doc_id").alias("_pe_id")).distinct()
    kept = docs.join(gone, F.col("doc_id").cast("bigint") == F.col("_pe_id"), "left_anti")
    twice = made.groupBy(F.col("doc_id").alias("_pe_id")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_pe_id")
    twice = stored(twice, "twice")
    if twice.isEmpty():
        return kept
    same = F.col("doc_id").cast("bigint") == F.col("_pe_id")
    once = kept.join(twice, same, "left_semi").dropDuplicates(["doc_id"])
    return kept.join(twice, same, "left_anti").unionByName(once)
