"""SimHash near-duplicates of a Jaccard similarity of their shingle sets.

Candidates are pairs whose fingerprints, those of ``simhash``, differ in at most
``PRINT_BITS`` bits; deletion-variant signatures find them. Every candidate pair is verified
on the shingle sets themselves.

A fingerprint of 64 bits does not show all pairs of similarity 0.8: many differ in ten bits
or more, and segments short enough to agree in spite of that agree for unrelated texts too.
What fingerprints leave unsettled is found by minima: per hash function the smallest value
over a text's shingles, which two texts share with the probability of their similarity.
``ROWS`` minima are one band, and texts that agree in any of ``BANDS`` bands, and are not
linked by way of fingerprints, are candidates too.

Texts of one shingle set are one node. In a bucket, the texts of one band value, of up to
``BUCKET`` nodes all pairs are candidates. In a larger one each node and ``LEADERS`` of them
are, which makes one component of a group of copies. That is not all where a bucket's nodes
are alike for another reason, as texts of one template are: so all nodes of larger buckets
that still hold two components or more are joined exactly. A node's shingles are ordered by
rarity among these nodes; two sets of similarity t share one of the first n - ceil(t n) + 1
of their shingles. Shared template text is frequent and stands at the end, so only texts
that share something rare meet, and only if they are in different components. Where very
many share it nevertheless, they are compared in blocks, and a block gives back one edge
per node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.llm import simhash
from goldrow.llm.components import components
from goldrow.llm.words import blocks, texts_of, word_table
from goldrow.session import write_through

#: Words of a shingle.
SHINGLE_WORDS = 5
#: Least similarity of a link, as a fraction.
LEAST = (4, 5)
#: Fingerprints of candidates differ at this many bits or fewer.
PRINT_BITS = 7
#: A pair of similarity 0.8 agrees in some band with probability 1 - (1 - 0.8**5)**20 = 0.9996.
BANDS, ROWS = 20, 5
#: Nodes of a bucket of which all pairs are candidates.
BUCKET = 16
#: Nodes that every node of a larger bucket is compared with; a power of two.
LEADERS = 4
#: Nodes that share a rare shingle, of which all pairs are candidates; more go in blocks.
GROUP = 64
#: Nodes of a block.
BLOCK = 512
#: Shingles whose hash functions are evaluated at a time.
PART = 1 << 12

_MIX = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.default_rng(42)
_SEEDS = _RANDOM.integers(0, 2**64, BANDS * ROWS, np.uint64)
_FACTORS = _RANDOM.integers(0, 2**64, BANDS * ROWS, np.uint64) | np.uint64(1)


def _mixed(h: np.ndarray, value: np.ndarray) -> np.ndarray:
    h = (h ^ value) * _MIX
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: pa.Array, words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Per text, the sorted 64-bit hashes of its distinct shingles. A text of fewer words is
    one shingle; one without words has none."""
    table = word_table(texts)
    dictionary = table.words.to_pylist()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in dictionary], np.uint64)
    hashes = hashes[table.codes] if len(hashes) else np.zeros(0, np.uint64)
    windows = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for k in range(words):
        windows = _mixed(windows, hashes[k : k + len(windows)])
    out = []
    for start, stop in zip(table.starts[:-1], table.starts[1:], strict=True):
        if stop - start >= words:
            out.append(np.unique(windows[start : stop - words + 1]))
            continue
        one = np.zeros(min(stop - start, 1), np.uint64)
        for k in range(start, stop):
            one = _mixed(one, hashes[k : k + 1])
        out.append(one)
    return out


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One key per band; none for a text without shingles."""
    if not len(shingles):
        return np.zeros(0, np.uint64)
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), PART):
        values = (shingles[at : at + PART, None] ^ _SEEDS) * _FACTORS
        least = np.minimum(least, values.min(axis=0))
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        keys = _mixed(keys, column)
    return keys


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.uint64), *arrays]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _sketched(df: DataFrame, words: int) -> DataFrame:
    """Rows (id, copy, node, fp, bands) of rows (id, copy, text)."""

    def task(batches) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            texts = texts_of(block)
            sets = shingle_sets(pc.ascii_lower(texts), words)
            columns = [_nodes(sets), simhash.fingerprint_array(texts)]
            columns.append(_lists([band_keys(s) for s in sets]))
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), block.column("copy"), *columns],
                names=["id", "copy", "node", "fp", "bands"],
            )

    kind = df.schema["id"].dataType.simpleString()
    new = "copy bigint, node bigint, fp bigint, bands array<bigint>"
    return df.mapInArrow(task, f"id {kind}, {new}")


def _nodes(sets: list[np.ndarray]) -> pa.Array:
    nodes = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64)
    return pa.array(nodes.view(np.int64))


def _sets(df: DataFrame, words: int) -> DataFrame:
    """Rows (node, shingles) of rows (text)."""

    def task(batches) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            sets = shingle_sets(pc.ascii_lower(texts_of(block)), words)
            yield pa.RecordBatch.from_arrays(
                [_nodes(sets), _lists(sets)], names=["node", "shingles"]
            )

    return df.mapInArrow(task, "node bigint, shingles array<bigint>")


def _shared_buckets(signed: DataFrame) -> DataFrame:
    """Stored rows (key, node, n, leaders) of buckets with two nodes or more, from stored
    rows (key, node)."""
    slot = F.col("node").bitwiseAND(F.lit(LEADERS - 1))
    slots = signed.groupBy("key", slot.alias("slot")).agg(
        F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")
    )
    buckets = write_through(
        slots.groupBy("key")
        .agg(F.sum("n").alias("n"), F.collect_list("leader").alias("leaders"))
        .where("n > 1"),
        "buckets",
    )
    return write_through(signed.join(buckets, "key"), "shared-buckets")


def _ordered_pairs(pairs: DataFrame) -> DataFrame:
    pairs = pairs.where("a <> b")
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _candidates(shared: DataFrame) -> DataFrame:
    """Distinct pairs (a, b): all of small buckets, those with a leader of large ones."""
    together = (
        shared.where(F.col("n") <= BUCKET).groupBy("key").agg(F.collect_set("node").alias("nodes"))
    )
    small = together.select(F.explode("nodes").alias("a"), "nodes").select(
        "a", F.explode("nodes").alias("b")
    )
    large = shared.where(F.col("n") > BUCKET).select(
        F.col("node").alias("a"), F.explode("leaders").alias("b")
    )
    return _ordered_pairs(small.unionByName(large))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar. A node may have many pairs; adaptive
    execution splits them, as the tables are stored."""
    one = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    other = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    either = F.size("of_a") + F.size("of_b") - both
    least, of = LEAST
    return pairs.join(one, "b").join(other, "a").where(of * both >= least * either).select("a", "b")


def _unlinked(pairs: DataFrame, linked: DataFrame) -> DataFrame:
    """The pairs (a, b) but for those that stored ``linked`` pairs, larger node first, join
    directly or by the smallest neighbour that both ends have."""
    least = linked.groupBy("a").agg(F.min("b").alias("least"))
    of = lambda end: least.select(F.col("a").alias(end), F.col("least").alias(f"of_{end}"))
    return (
        pairs.join(linked, ["a", "b"], "left_anti")
        .join(of("a"), "a", "left")
        .join(of("b"), "b", "left")
        .where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b"))
        .select("a", "b")
    )


def _open_nodes(shared: DataFrame, grouped: DataFrame) -> DataFrame:
    """Nodes (node, label) of large buckets that hold more than one component."""
    labels = grouped.select("node", F.col("component").alias("label"))
    labelled = write_through(
        shared.where(F.col("n") > BUCKET)
        .select("key", "node")
        .join(labels, "node", "left")
        .select("key", "node", F.coalesce("label", "node").alias("label")),
        "labelled-buckets",
    )
    mixed = (
        labelled.groupBy("key")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low <> high")
    )
    return labelled.join(mixed, "key", "left_semi").select("node", "label").distinct()


def _rare_groups(nodes: DataFrame) -> DataFrame:
    """Rows (token, node, label, size, n) of stored rows (node, label, shingles): nodes that
    share one of their rarest shingles with a node of another component."""
    least, of = LEAST
    tokens = write_through(
        nodes.select("node", F.explode("shingles").alias("token")), "open-shingles"
    )
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    size = F.size("ordered")
    first = size - F.floor((least * size + of - 1) / of).cast("int") + 1
    ordered = tokens.join(counts, "token").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("ordered")
    )
    rare = write_through(
        ordered.select("node", size.alias("size"), F.explode(F.slice("ordered", F.lit(1), first)).alias("t"))
        .where("t.df > 1")
        .select("node", "size", F.col("t.token").alias("token"))
        .join(nodes.select("node", "label"), "node"),
        "rare-shingles",
    )
    # Shingles of one passage have the same nodes: 128 bits tell, and one of them is enough.
    held = [F.bit_xor(F.xxhash64(F.lit(seed), "node")).alias(f"s{seed}") for seed in (1, 2)]
    groups = (
        rare.groupBy("token")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            *held,
        )
        .where("low <> high")
        .groupBy("n", "s1", "s2")
        .agg(F.min("token").alias("token"))
        .select("token", "n")
    )
    return write_through(rare.join(groups, "token"), "rare-members")


def _pairs_of_groups(members: DataFrame) -> DataFrame:
    """Pairs of small groups whose components differ and whose sizes allow the similarity."""
    least, of = LEAST
    member = F.struct("label", "node", "size")
    groups = (
        members.where(F.col("n") <= GROUP).groupBy("token").agg(F.collect_list(member).alias("all"))
    )
    pairs = groups.select(F.explode("all").alias("x"), "all").select(
        "x",
        F.explode(
            F.filter(
                "all",
                lambda y: (y["label"] != F.col("x.label"))
                & (y["node"] < F.col("x.node"))
                & (of * F.least(y["size"], F.col("x.size")) >= least * F.greatest(y["size"], F.col("x.size"))),
            )
        ).alias("y"),
    )
    return _ordered_pairs(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))


def _alike(sets: list[np.ndarray]) -> np.ndarray:
    """Which pairs of sets are similar."""
    size = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), size)
    token = np.concatenate(sets)
    order = np.argsort(token, kind="stable")
    token, row = token[order], row[order]
    starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    both = np.zeros((len(sets), len(sets)), np.int32)
    for start, stop in zip(starts, np.append(starts[1:], len(token)), strict=True):
        if stop - start > 1:
            both[np.ix_(row[start:stop], row[start:stop])] += 1
    least, of = LEAST
    near = of * both >= least * (size[:, None] + size[None, :] - both)
    np.fill_diagonal(near, True)
    return near


def _block_edges(table: pa.Table) -> pa.Table:
    """For each node of two blocks, the smallest that it is connected to inside of them."""
    nodes = table["node"].to_numpy()
    near = _alike([np.array(s, np.int64) for s in table["shingles"].to_pylist()])
    label = np.arange(len(nodes))
    while True:
        least = np.where(near, label[None, :], len(nodes)).min(axis=1)
        least = np.minimum(least, least[least])
        if (least == label).all():
            break
        label = least
    moved = label != np.arange(len(nodes))
    return pa.table({"a": nodes[moved], "b": nodes[label[moved]]})


def _edges_of_blocks(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect what is similar in large groups: a group is cut in blocks
    by a hash, and every two blocks are compared in one task."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    last = F.col("blocks") - 1
    # Block i meets j >= i; a node of block k is in (i, k) for i <= k and (k, j) for j > k.
    before = F.transform(F.sequence(F.lit(0), F.col("block")), lambda i: F.struct(i.alias("i"), F.col("block").alias("j")))
    after = F.when(
        F.col("block") < last,
        F.transform(F.sequence(F.col("block") + 1, last), lambda j: F.struct(F.col("block").alias("i"), j.alias("j"))),
    ).otherwise(F.array().cast("array<struct<i:int,j:int>>"))
    placed = (
        members.where(F.col("n") > GROUP)
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64(F.lit(11), "node"), "blocks").cast("int"))
        .withColumn("pair", F.explode(F.concat(before, after)))
        .select("token", "pair.i", "pair.j", "node")
    )
    return (
        placed.join(nodes.select("node", "shingles"), "node")
        .groupBy("token", "i", "j")
        .applyInArrow(_block_edges, "a bigint, b bigint")
        .distinct()
    )


def near_duplicates(
    df: DataFrame, key: str, text: str = "text", words: int = SHINGLE_WORDS
) -> DataFrame:
    """Rows (``key``, component_id), one per row of ``df``.

    Texts are linked if the Jaccard similarity of their sets of shingles of ``words`` words,
    A-Z made small, is ``LEAST`` or more. ``component_id`` is the smallest key that can be
    reached over links, itself included. Rows without a key have a null component, though
    their texts do link others. Null texts and texts without words are copies of each other,
    repeated rows get one component, and an empty table gives an empty result.
    """
    # ``copy`` tells texts apart, so that a class can name one of its texts.
    source = df.select(
        F.col(f"`{key}`").alias("id"),
        F.xxhash64(F.col(f"`{text}`")).alias("copy"),
        F.col(f"`{text}`").alias("text"),
    )
    rows = write_through(_sketched(source, words), "sketches")
    classes = write_through(
        rows.groupBy("node").agg(F.min("copy").alias("copy"), F.min("id").alias("first")),
        "shingle-classes",
    )
    signed = write_through(
        rows.select("node", F.explode("bands").alias("key")).distinct(), "bands"
    )
    shared = _shared_buckets(signed)
    prints = rows.select("fp", "node").distinct()
    close = write_through(
        _ordered_pairs(simhash.near_pairs(prints, PRINT_BITS)), "close-fingerprints"
    )
    ends = close.select(F.explode(F.array("a", "b")).alias("node"))
    wanted = shared.select("node").unionByName(ends).distinct()
    chosen = write_through(classes.join(wanted, "node").select("copy"), "candidate-copies")
    # Only texts of candidates become sets again; copies are one before their sets travel.
    texts = write_through(source.join(chosen, "copy", "left_semi").select("text"), "candidate-texts")
    sets = write_through(
        _sets(texts, words).groupBy("node").agg(F.first("shingles").alias("shingles")),
        "candidate-sets",
    )
    linked = write_through(_verified(close, sets), "similar-fingerprints")
    pairs = write_through(_unlinked(_candidates(shared), linked), "candidates")
    found = write_through(linked.unionByName(_verified(pairs, sets)), "similar")
    grouped = components(found)
    placed = classes.join(grouped, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    unsettled = write_through(sets.join(_open_nodes(shared, grouped), "node"), "open-nodes")
    if not unsettled.isEmpty():
        members = _rare_groups(unsettled)
        edges = _verified(_pairs_of_groups(members), sets)
        edges = edges.unionByName(_edges_of_blocks(members, unsettled))
        # Components are few where nodes are many: their labels are what is connected.
        of = lambda end: unsettled.select(F.col("node").alias(end), F.col("label").alias(f"of_{end}"))
        between = edges.join(of("a"), "a").join(of("b"), "b").select(
            F.col("of_a").alias("a"), F.col("of_b").alias("b")
        )
        joined = components(write_through(between.where("a <> b").distinct(), "rare-similar"))
        further = joined.select(F.col("node").alias("component"), F.col("component").alias("whole"))
        placed = placed.join(further, "component", "left").withColumn(
            "component", F.coalesce("whole", "component")
        )
    named = write_through(placed.select("node", "first", "component"), "similar-classes")
    smallest = write_through(
        named.groupBy("component").agg(F.min("first").alias("component_id")), "similar-least"
    )
    of_class = write_through(
        named.join(smallest, "component").select("node", "component_id"), "similar-named"
    )
    return rows.select("id", "node").join(of_class, "node").select(
        F.col("id").alias(key),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
