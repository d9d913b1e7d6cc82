"""Jaccard join of documents on word n-grams, and the groups its links form.

Documents of equal shingle sets become one node. The n-grams of a node are hashed into ``GROUPS`` groups; their
counts are its point. The overlap of two sets is at most the sum over groups of the smaller count, and for a set of nodes at
most the sum with the largest counts of the set: the bound of an R-tree over the points.

One tree over a whole corpus would have to be searched whole, since unrelated texts spread over all leaves.
So the points are indexed by bucket, and a small tree stands in each bucket: a node enters the buckets of its ``n - ceil(t n) + 1``
first shingles in an order that all share, and linked nodes share a bucket. Frequent shingles come last in
the order, so a passage of many documents makes no large bucket unless the documents are little else.

A node stands in a bucket with its room: how many of its shingles come at or after the bucket's in the order. Of two linked nodes
the first shingle they share has room in both for the whole overlap, so a bucket only opens pairs whose rooms allow it.

1. In each bucket and size band every node is compared with one hub, the one with the fewest shingles before the bucket's: among
   edited copies the one with the fewest edits of its own. Confirmed links are contracted, so a large
   group of near copies costs one comparison per member, not one per pair.
2. What a bucket still holds in different components is compared in full: its components are the tree's inner nodes
   (sizes and largest counts), pairs of them that the bound admits are opened, then pairs of points that the
   bound admits are verified on their sets.

No link between different sets is lost. Counts of frequent shingles are taken over all documents but may miss
shingles that are rare in every task; they only order the buckets and never change a result.

Defined cases: a text with fewer words than the width has its whole word sequence as one shingle; a null text
or one without words has an empty set and is linked with nothing, also not with other empty ones. Rows are kept one
for one; rows of the same id are separate texts of that id. A null id is never the smallest of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.columns import c
from ..runtime import materialize
from .links import FILTER_BITS, bit_filter, components, id_filter, lists, low_bits, passes, slot
from .tokens import mix, shingles, slices, word_hashes

#: Points of unrelated sets lie further apart than similar ones may, up to some 50 shingles a group.
GROUPS = 128
#: Sets from this size on also have a finer point; it bounds pairs in which both have one.
LONG, FINE_GROUPS = 1500, 1024
#: Finer points, 2 KB each, that may be broadcast.
BROADCAST_POINTS = 24_000
#: At most so many frequent shingles are broadcast (9 bytes each), and from so many sightings on.
FREQUENT, SIGHTINGS = 1 << 20, 32
#: Pairs of numbers, 16 bytes each, that may be broadcast.
BROADCAST_PAIRS = 1_000_000
#: Shingles among which a task looks for repeated ones at a time.
AT_ONCE = 1 << 21


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The distinct shingles of each text; hashes of some hundred texts are held at a time."""
    for part in slices(pa.RecordBatch.from_arrays([texts], names=["text"]), 0):
        hashes, first = word_hashes(part.column(0))
        yield from map(np.unique, shingles(hashes, first, width))


def identity(own: np.ndarray) -> int:
    return int(mix(mix(own * np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64, keepdims=True))[0])


def point(own: np.ndarray, groups: int = GROUPS) -> np.ndarray | None:
    """Group counts; none if one is too large for 16 bits."""
    group = mix(own ^ np.uint64(0x27D4EB2F165667C5)) >> np.uint64(64 - groups.bit_length() + 1)
    counts = np.bincount(group.astype(np.int64), minlength=groups)
    return counts.astype(np.int16) if counts.max() < 1 << 15 else None


def prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1 if size else 0


def frequent(docs: DataFrame, text: str, width: int, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """``(shingles, level)``, sorted: shingles seen in many documents and the logarithm of how many."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def repeated():
            values = np.concatenate(held) if held else np.zeros(0, np.uint64)
            held.clear()
            values.sort()
            # Most are single, so only the others are copied and counted.
            same = np.concatenate(([False], values[1:] == values[:-1], [False]))
            values, counts = np.unique(values[same[1:] | same[:-1]], return_counts=True) if len(values) else (values, values)
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], names=["shingle", "n"])

        for batch in batches:
            for own in shingle_sets(batch.column(0), width):
                held.append(own)
                size += len(own)
                if size >= AT_ONCE:
                    yield repeated()
                    size = 0
        yield repeated()

    seen = docs.select(c(text)).mapInArrow(run, "shingle long, n long")
    seen = seen.groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= SIGHTINGS)
    seen = materialize(seen.select("shingle", F.floor(F.log2("n")).cast("int").alias("level")), "frequent")
    by_level = sorted(((r["level"], r["count"]) for r in seen.groupBy("level").count().collect()), reverse=True)
    total, least = 0, 64
    for level, count in by_level:
        total += count
        if total > most:
            break
        least = level
    found = seen.where(F.col("level") >= least).toArrow()
    values = found.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(values)
    return values[order], found.column("level").to_numpy()[order].astype(np.uint8)


def entries(docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """Per row: ``(id, n, node, prefix, point, fine)``; ``node`` is the set's identity, null for an empty set."""
    often, level = frequent(docs, text, width)
    often_sent = docs.sparkSession.sparkContext.broadcast((often, level))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, level = often_sent.value
        for batch in chain.from_iterable(slices(batch, 1) for batch in batches):
            sizes, nodes, prefixes, points, fine = [], [], [], [], []
            for own in shingle_sets(batch.column(1), width):
                rank = np.zeros(len(own), np.uint8)
                if len(often):
                    at = np.minimum(np.searchsorted(often, own), len(often) - 1)
                    rank = np.where(often[at] == own, level[at], 0)
                first = own[np.argsort(rank, kind="stable")][:prefix_length(len(own), percent)]
                sizes.append(len(own))
                nodes.append(identity(own) if len(own) else None)
                prefixes.append(first)
                points.append(point(own))
                fine.append(point(own, FINE_GROUPS) if len(own) >= LONG else None)
            node = np.array([x or 0 for x in nodes], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()),
                 pa.array(node, mask=np.array([x is None for x in nodes], bool)),
                 lists(prefixes, np.int64), pa.array(points, pa.list_(pa.int16())), pa.array(fine, pa.list_(pa.int16()))],
                names=["id", "n", "node", "prefix", "point", "fine"])

    schema = T.StructType([
        T.StructField("id", docs.schema[key].dataType), T.StructField("n", T.LongType()),
        T.StructField("node", T.LongType()), T.StructField("prefix", T.ArrayType(T.LongType())),
        T.StructField("point", T.ArrayType(T.ShortType())), T.StructField("fine", T.ArrayType(T.ShortType()))])
    return docs.select(c(key).alias("id"), c(text)).mapInArrow(run, schema)


def _sets(docs: DataFrame, key: str, text: str, width: int, wanted: DataFrame) -> DataFrame:
    """``(node, members)`` of the texts whose id passes a filter of fixed size made of the wanted ids. Only those texts are
    hashed again; a few others may pass, and repeated rows come repeatedly."""
    sent = docs.sparkSession.sparkContext.broadcast(id_filter(wanted, "id"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.filter(pa.array(passes(sent.value, batch.column(1).to_numpy(zero_copy_only=False))))
            for own in slices(wanted, 0):
                found = list(shingle_sets(own.column(0), width))
                nodes = np.array([identity(x) for x in found], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(nodes), lists(found, np.int64)], names=["node", "members"])

    return docs.select(c(text), slot(c(key)).alias("slot")).mapInArrow(run, "node long, members array<long>")


def _shared_rows(unique: DataFrame) -> DataFrame:
    """``(shingle, node, n, room)`` of the prefix shingles that more than one row has, and of a few others.

    The shingles are counted with partial sums; which are shared is sent as a filter of fixed size, so the rows of
    the others, which are most, are not shuffled.
    """
    shingle = unique.select(F.explode("prefix").alias("shingle"))
    shared = shingle.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("shingle")
    sent = unique.sparkSession.sparkContext.broadcast(bit_filter(shared.select(low_bits(F.col("shingle")).alias("slot"))))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefixes = batch.column(2)
            flat = prefixes.flatten().to_numpy()
            lengths = prefixes.value_lengths().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(batch)), lengths)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            kept = passes(sent.value, flat & (FILTER_BITS - 1))
            owner, place = owner[kept], place[kept]
            n = batch.column(1).to_numpy()[owner]
            yield pa.RecordBatch.from_arrays([pa.array(flat[kept]), batch.column(0).take(pa.array(owner)), pa.array(n), pa.array(n - place)],
                                             names=["shingle", "node", "n", "room"])

    return unique.select("node", "n", "prefix").mapInArrow(run, "shingle long, node long, n long, room long")


def _sizes_fit(a, b, percent: int):
    return (100 * F.least(a, b)) >= percent * F.greatest(a, b)


def _rooms_fit(a, b, sizes, percent: int):
    """Whether two sets of so many shingles in all can share enough if nothing before the bucket's shingle is shared."""
    return (100 + percent) * F.least(a, b) >= percent * sizes


def _bound_fits(points_a, points_b, sizes, percent: int):
    """Whether the sum of coordinate minima reaches the overlap that sets of so many shingles in all need. A missing point bounds nothing."""
    most = F.aggregate(F.zip_with(points_a, points_b, lambda x, y: F.least(x, y).cast("long")),
                       F.lit(0).cast("long"), lambda total, x: total + x)
    return F.coalesce((100 + percent) * most >= percent * sizes, F.lit(True))


def _verified(docs: DataFrame, key: str, text: str, width: int, pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Of pairs ``(a, b)`` those with ``100 |a and b| >= percent |a or b|``.

    Pairs are two numbers, sets are long: up to ``BROADCAST_PAIRS`` pairs, counted first, go to the sets of their ``b``, and
    only what they need is shuffled to meet the sets of ``a``.
    """
    small = pairs.count() <= BROADCAST_PAIRS

    def sets(side):
        ids = points.select("id", "node").join(pairs.select(F.col(side).alias("node")), "node", "left_semi")
        return _sets(docs, key, text, width, ids).select(F.col("node").alias(side), F.col("members").alias(f"set_{side}"))

    right = sets("b").join(F.broadcast(pairs) if small else pairs, "b")
    both = F.size(F.array_intersect("set_a", "set_b"))
    return right.join(sets("a"), "a").where(
        100 * both >= percent * (F.size("set_a") + F.size("set_b") - both)).select("a", "b").distinct()


def _joined(docs, key, text, width, percent):
    """``(entries, links)`` with links enough to connect every component."""
    rows = materialize(entries(docs, key, text, width, percent), "entries")
    filled = rows.where(F.col("node").isNotNull())
    # Of equal sets one stands for all.
    copies = materialize(filled.groupBy("node").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows")).where(
        "rows > 1").drop("rows"), "copies")
    unique = filled.join(F.broadcast(copies) if copies.count() <= BROADCAST_PAIRS else copies, "node", "left").where(
        F.col("first").isNull() | (F.col("id") == F.col("first"))).drop("first")
    band = F.floor(F.ln("n") / math.log(100 / percent) + 1e-9) if percent < 100 else F.col("n")
    members = materialize(_shared_rows(unique).withColumn("band", band), "members")
    points = materialize(unique.select("id", "node", "point", "fine").join(
        members.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]), "points")
    place = points.select("node", "point")
    fine = materialize(points.where("fine is not null").select("node", "fine"), "fine")

    # 1. Every member of a bucket against the hub of its size band.
    hubs = members.groupBy("shingle", "band").agg(F.min(F.struct(
        (F.col("n") - F.col("room")).alias("before"), "node", "n", "room")).alias("hub"))
    star = (members.join(hubs, ["shingle", "band"]).where((F.col("node") != F.col("hub.node"))
            & _sizes_fit(F.col("n"), F.col("hub.n"), percent)
            & _rooms_fit(F.col("room"), F.col("hub.room"), F.col("n") + F.col("hub.n"), percent))
            .select(F.col("hub.node").alias("a"), F.col("node").alias("b"), (F.col("n") + F.col("hub.n")).alias("sizes"))
            .distinct())
    star = materialize(_within_bound(star, place, fine, percent), "star")
    links = materialize(_verified(docs, key, text, width, star, points, percent), "links")
    labels = components(links)

    # 2. What is still apart in a bucket: components as inner nodes, then their points.
    apart = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")).drop("band")
    mixed = apart.groupBy("shingle").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    apart = materialize(apart.join(mixed.select("shingle"), "shingle"), "apart")
    nodes = apart.groupBy("node", "label").agg(F.first("n").alias("n")).join(place, "node")
    inner = materialize(nodes.groupBy("label").agg(
        F.min("n").alias("least"), F.max("n").alias("most"),
        F.when(F.count("point") == F.count("node"), F.array(*[
            F.max(F.get("point", F.lit(i))) for i in range(GROUPS)])).alias("point")), "inner")
    buckets = apart.groupBy("shingle", "label").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("room").alias("room"))
    x, y = (buckets.select("shingle", *[F.col(n).alias(f"{n}_{side}") for n in ("label", "least", "most", "room")]) for side in "ab")
    met = materialize(x.join(y, (x["shingle"] == y["shingle"]) & (F.col("label_a") < F.col("label_b"))
                             & (100 * F.col("most_b") >= percent * F.col("least_a"))
                             & (100 * F.col("most_a") >= percent * F.col("least_b"))
                             & _rooms_fit(F.col("room_a"), F.col("room_b"), F.col("least_a") + F.col("least_b"), percent)).select(
        x["shingle"], "label_a", "label_b", F.col("least_b").alias("least"), F.col("most_b").alias("most"), F.col("room_b").alias("room")), "met")
    u, v = (inner.select(*[F.col(n).alias(f"{n}_{side}") for n in ("label", "least", "point")]) for side in "ab")
    opened = materialize(met.select("label_a", "label_b").distinct().join(u, "label_a").join(v, "label_b").where(_bound_fits(
        "point_a", "point_b", F.col("least_a") + F.col("least_b"), percent)).select("label_a", "label_b"), "opened")
    # A node is paired with a component only in the buckets where both stand, and only if the component may hold a partner.
    small = opened.count() <= BROADCAST_PAIRS
    places = met.join(F.broadcast(opened) if small else opened, ["label_a", "label_b"], "left_semi")
    own = apart.select("shingle", F.col("label").alias("label_a"), F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("room").alias("room_a"))
    other = apart.select("shingle", F.col("label").alias("label_b"), F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("room").alias("room_b"))
    left = own.join(places, ["shingle", "label_a"]).where(
        (100 * F.col("n_a") >= percent * F.col("least")) & (100 * F.col("most") >= percent * F.col("n_a"))
        & _rooms_fit(F.col("room_a"), F.col("room"), F.col("n_a") + F.col("least"), percent))
    near = left.join(other, (left["shingle"] == other["shingle"]) & (left["label_b"] == other["label_b"])
                     & _sizes_fit(F.col("n_a"), F.col("n_b"), percent)
                     & _rooms_fit(F.col("room_a"), F.col("room_b"), F.col("n_a") + F.col("n_b"), percent)).select(
        "a", "b", (F.col("n_a") + F.col("n_b")).alias("sizes")).distinct()
    pairs = materialize(_within_bound(near, place, fine, percent), "pairs")
    more = _verified(docs, key, text, width, pairs, points, percent)
    return rows, materialize(links.unionByName(more), "links")


def _within_bound(pairs: DataFrame, place: DataFrame, fine: DataFrame, percent: int) -> DataFrame:
    """Pairs that the bound of the points admits, and then that of the finer points where both have one."""
    small = fine.count() <= BROADCAST_POINTS
    sides = [("point", place, False, "inner"), ("fine", fine, small, "left")]
    for name, table, send, kind in sides:
        for side in "ab":
            own = table.select(F.col("node").alias(side), F.col(name).alias(f"{name}_{side}"))
            pairs = pairs.join(F.broadcast(own) if send else own, side, kind)
        pairs = pairs.where(_bound_fits(f"{name}_a", f"{name}_b", F.col("sizes"), percent)).select("a", "b", "sizes")
    return pairs.select("a", "b")


def _labelled(docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """``(id, n_shingles, node, label, component_id)`` per row; ``node`` and ``label``, the group, are null for an empty set."""
    if not 0 < percent <= 100:
        raise ValueError("percent must lie in (0, 100]")
    rows, links = _joined(docs, key, text, width, percent)
    labels = components(links)
    labelled = rows.select("id", F.col("n").alias("n_shingles"), "node").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    smallest = labelled.where(F.col("label").isNotNull()).groupBy("label").agg(F.min("id").alias("smallest"))
    return labelled.join(smallest, "label", "left").select(
        "id", "n_shingles", "node", "label", F.coalesce("smallest", "id").alias("component_id"))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """``(id, n_shingles, component_id)`` per row of ``docs``; ``component_id`` is the smallest id that links reach."""
    return _labelled(docs, key, text, width, percent).select("id", "n_shingles", "component_id")


def _with_node(docs: DataFrame, text: str, width: int) -> DataFrame:
    """``docs`` and ``__node``, the identity of each row's set."""
    schema = T.StructType([*docs.schema.fields, T.StructField("__node", T.LongType())])
    place = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shingle_sets(batch.column(place), width))
            nodes = np.array([identity(x) if len(x) else 0 for x in found], np.uint64).view(np.int64)
            node = pa.array(nodes, mask=np.array([not len(x) for x in found], bool))
            yield pa.RecordBatch.from_arrays([*batch.columns, node], names=[*batch.schema.names, "__node"])

    return docs.mapInArrow(run, schema)


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80,
                broadcast_ids: int = 1_000_000) -> DataFrame:
    """``docs`` without the rows that a row of smaller id is linked with. Of linked rows that share the smallest id one stays, of
    the smallest set identity; rows of one id that are not linked are separate texts, and all rows without words stay, as do null ids.

    The ids that go are few beside the texts and are broadcast up to ``broadcast_ids`` of them, counted first, so the texts are not shuffled.
    """
    found = materialize(_labelled(docs, key, text, width, percent).where("id is not null"), "found")
    kept = F.col("id") == F.col("component_id")
    per_id = materialize(found.groupBy("id").agg(
        F.sum(kept.cast("int")).alias("n_kept"), F.count(F.lit(1)).alias("n"), F.max("n_shingles").alias("filled")).where(
        "n_kept = 0 or (n > 1 and filled > 0)"), "dropped")
    gone = per_id.where("n_kept = 0").select(F.col("id").alias("__gone"))
    out = docs.join(F.broadcast(gone) if gone.count() <= broadcast_ids else gone, c(key) == F.col("__gone"), "left_anti")
    several = per_id.where("n_kept > 0").select(F.col("id").alias("__several"))
    if several.isEmpty():
        return out
    # Repeated ids are rare: only their rows are hashed again and brought together.
    small = F.broadcast(several) if several.count() <= broadcast_ids else several
    stay = found.where(kept & F.col("node").isNotNull()).join(several, F.col("id") == F.col("__several"), "left_semi").groupBy(
        "id", "label").agg(F.min("node").alias("__node")).select(F.col("id").alias("__id"), "__node")
    rows = _with_node(out.join(small, c(key) == F.col("__several"), "left_semi"), text, width)
    filled = rows.join(stay.withColumnRenamed("__node", "__stay"), (c(key) == F.col("__id")) & (F.col("__node") == F.col("__stay")), "left_semi")
    return (out.join(small, c(key) == F.col("__several"), "left_anti")
            .unionByName(filled.dropDuplicates([key, "__node"]).drop("__node"))
            .unionByName(rows.where(F.col("__node").isNull()).drop("__node")))
