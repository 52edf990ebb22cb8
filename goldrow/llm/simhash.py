"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint of 64 bits is cut into two segments. Of up to three differing bits one
segment holds at most one, so two linked fingerprints agree in a segment once the right bit
is left out: its variants with one bit as a wildcard, 32 per segment, are the signatures.
Equal signatures are found by an equality join of keys, and every pair is verified.

Copies have one fingerprint and are one node. Many similar texts can still share a
signature. Then the other segment is cut in two and its variants are added, and after that
the segment of these that is left: a signature of three levels leaves 11 of the 64 bits
open, so no more than 2,048 fingerprints can share it. A group is compared inside one
task, which gives back one link per fingerprint and not the pairs: what it connects.

``near_pairs`` gives pairs instead, for a caller that verifies them on the texts and has
another way for what is missing. More and shorter segments reach further: of up to
``2 k - 1`` differing bits one of k segments holds at most one. Short segments are shared by
chance, so a group is only looked through, in order of its fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrow.llm.components import components
from goldrow.llm.words import as_row, blocks, of_row, schema_with, texts_of, word_table
from goldrow.session import write_through

#: Words of a shingle.
SHINGLE_WORDS = 3
#: Fingerprints link at this many differing bits or fewer; the cutting into two is for 3.
MAX_BITS = 3
#: Seed of the shingles' XXH64.
SEED = 42
#: Shingles whose bits are unpacked at a time.
PART = 1 << 16
#: A larger group of one signature goes on to the next level's signatures.
GROUP_ROWS = 1024
#: Signatures of one bit left out, per level: widths of the two halves that are cut.
LEVEL_BITS = (32, 16, 8)
#: Pairs that ``near_pairs`` takes of one fingerprint and signature, and how many of the
#: following fingerprints it looks at for them.
PAIRS, REACH = 8, 1024


def _fingerprints(texts: pa.Array, words: int, seed: int) -> np.ndarray:
    """Unsigned fingerprints of texts, in which A-Z are small already."""
    table = word_table(texts)
    out = np.zeros(len(texts), np.uint64)
    dictionary = table.words.to_numpy(zero_copy_only=False)
    digest = xxhash.xxh64_intdigest
    for row, (start, stop) in enumerate(zip(table.starts[:-1], table.starts[1:], strict=True)):
        if start == stop:
            continue
        w = dictionary[table.codes[start:stop]].tolist()
        if stop - start <= words:
            hashes = [digest(" ".join(w), seed)]
        else:
            shifted = [w[k : len(w) - words + 1 + k] for k in range(words)]
            hashes = [digest(s, seed) for s in map(" ".join, zip(*shifted, strict=True))]
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), PART):
            part = np.array(hashes[at : at + PART], np.uint64).view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        majority = 2 * ones > len(hashes)
        out[row] = np.packbits(majority, bitorder="little").view(np.uint64)[0]
    return out


def fingerprint_array(
    texts: pa.Array, words: int = SHINGLE_WORDS, seed: int = SEED
) -> pa.Array:
    """The fingerprints of texts without nulls, as bigint."""
    return pa.array(_fingerprints(pc.ascii_lower(texts), words, seed).view(np.int64))


def fingerprint(
    df: DataFrame,
    text: str = "text",
    out: str = "fp",
    words: int = SHINGLE_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Add ``out`` (bigint, the fingerprint's 64 bits) and leave the text out.

    A bit is 1 if set in more than half of the XXH64 values of the text's shingles of
    ``words`` words, repeats included. A text of fewer words is one shingle; a text without
    words, or a null one, has fingerprint 0.
    """
    kept = [c for c in df.columns if c not in (out, text)]
    rows = df.select(as_row(kept), F.col(f"`{text}`").alias("text"))
    schema = schema_with(rows, ["row"], "fp bigint")

    def task(batches) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            values = fingerprint_array(texts_of(block), words, seed)
            yield pa.RecordBatch.from_arrays([block.column("row"), values], names=schema.names)

    return rows.mapInArrow(task, schema).select(*of_row(kept), F.col("fp").alias(out))


@dataclass(frozen=True)
class _Half:
    """``bits`` bits of a fingerprint from bit ``low`` on."""

    low: int
    bits: int

    def variants(self) -> list[tuple[int, int]]:
        """Per bit left out, the mask of this segment and the number of the variant."""
        whole = ((1 << self.bits) - 1) << self.low
        return [(whole & ~(1 << (self.low + i)), self.low + i) for i in range(self.bits)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _with_signatures(rows: DataFrame, level: int) -> DataFrame:
    """Rows (sig, fp): ``sig`` are the bits that agree, the variant, and the segment left.

    A variant is told by its level's wildcard; ``low`` is where the bits not yet cut start,
    that is, which half the next level cuts.
    """
    bits = LEVEL_BITS[level]
    choices = []
    lows = (0,) if level == 0 else tuple(range(0, 64, 2 * bits))
    for low in lows:
        for first, other in ((low, low + bits), (low + bits, low)):
            for mask, wildcard in _Half(first, bits).variants():
                choice = F.struct(
                    F.lit(wildcard).alias("wildcard"),
                    F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("kept"),
                    F.lit(other).alias("low"),
                )
                choices.append((low, choice))
    if level == 0:
        options: Column = F.array(*[c for _, c in choices])
        return rows.select("fp", F.explode(options).alias("s")).select(
            "fp", F.struct("s.wildcard", "s.kept").alias("sig"), "s.low"
        )
    options = F.lit(None)
    for low in lows:
        here = F.array(*[c for at, c in choices if at == low])
        options = F.when(F.col("low") == low, here).otherwise(options)
    return rows.select("fp", "sig", F.explode(options).alias("s")).select(
        "fp", F.struct("sig", "s.wildcard", "s.kept").alias("sig"), "s.low"
    )


def _connected(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Smallest place that each fingerprint of a group is connected to within the group."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= max_bits
    label = np.arange(len(fps))
    while True:
        least = np.where(near, label[None, :], len(fps)).min(axis=1)
        least = np.minimum(least, least[least])
        if (least == label).all():
            return label
        label = least


def _group_links(max_bits: int):
    """Task over rows sorted by ``key``: per group, one link for each fingerprint that is
    connected to a smaller place of its group."""

    def links(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(fps) == 2:
            ok = int(fps[0] ^ fps[1]).bit_count() <= max_bits
            return (fps[1:], fps[:1]) if ok else (fps[:0], fps[:0])
        root = _connected(fps, max_bits)
        moved = root != np.arange(len(fps))
        return fps[moved], fps[root[moved]]

    def task(batches) -> Iterator[pa.RecordBatch]:
        held_key, held = None, []

        def out(pairs) -> pa.RecordBatch:
            a = np.concatenate([np.zeros(0, np.uint64), *[p[0] for p in pairs]])
            b = np.concatenate([np.zeros(0, np.uint64), *[p[1] for p in pairs]])
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").to_numpy()
            fps = batch.column("fp").to_numpy().view(np.uint64)
            starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
            stops = np.append(starts[1:], len(keys))
            pairs = []
            # The batch's first group may go on from the last batch, its last into the next.
            if held and keys[0] != held_key:
                pairs.append(links(np.concatenate(held)))
                held = []
            if len(starts) > 1:
                first = np.concatenate([*held, fps[: stops[0]]])
                pairs.append(links(first))
                held = []
                middle = np.flatnonzero(stops[1:-1] - starts[1:-1] > 1) + 1
                pairs += [links(fps[starts[i] : stops[i]]) for i in middle]
                held = [fps[starts[-1] :]]
            else:
                held.append(fps)
            held_key = keys[-1]
            yield out(pairs)
        if held:
            yield out([links(np.concatenate(held))])

    return task


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect what the full graph of distinct ``fp`` connects.

    Every pair of fingerprints with at most ``max_bits`` differing bits is connected by the
    links; no link joins fingerprints further apart than that.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments with one wildcard find up to 3 differing bits")
    partitions = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = write_through(fingerprints.select("fp").distinct(), "distinct-fingerprints")
    # Dealt out before each becomes 64 rows: few, small files would else be one task's.
    rows = distinct.repartition(partitions, "fp")
    found = None
    for level in range(len(LEVEL_BITS)):
        signed = _with_signatures(rows, level)
        keyed = signed.select("fp", "sig", "low", F.xxhash64("sig").alias("key"))
        last = level == len(LEVEL_BITS) - 1
        if last:
            small = keyed
        else:
            large = write_through(
                keyed.groupBy("key").count().where(F.col("count") > GROUP_ROWS).select("key"),
                f"large-{level}",
            )
            small = keyed.join(large, "key", "left_anti")
        pairs = (
            small.select("key", "fp")
            .repartition("key")
            .sortWithinPartitions("key")
            .mapInArrow(_group_links(max_bits), "a bigint, b bigint")
        )
        found = pairs if found is None else found.unionByName(pairs)
        if last or large.isEmpty():
            break
        rows = write_through(
            keyed.join(large, "key", "left_semi").select("fp", "sig", "low"), f"level-{level + 1}"
        )
    return found.distinct()


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """First bit and end of as many segments as leave one of them with one difference."""
    n = max_bits // 2 + 1
    return [(64 * i // n, 64 * (i + 1) // n) for i in range(n)]


def _signature_keys(max_bits: int) -> list[Column]:
    """Per bit left out, its number above the other bits of its segment."""
    keys = []
    for low, high in _segments(max_bits):
        whole = (1 << (high - low)) - 1
        moved = F.shiftrightunsigned("fp", low)
        for bit in range(low, high):
            kept = moved.bitwiseAND(F.lit(whole & ~(1 << (bit - low))))
            keys.append(kept.bitwiseOR(F.lit(bit << 32)))
    return keys


def _first_shared(differing: np.ndarray, max_bits: int) -> np.ndarray:
    """The bit left out of the first signature that fingerprints share, by their XOR."""
    out = np.full(len(differing), -1)
    for low, high in _segments(max_bits):
        here = differing >> np.uint64(low) & np.uint64((1 << (high - low)) - 1)
        bits = np.bitwise_count(here)
        at = low + np.where(bits == 1, np.bitwise_count(here - (bits == 1)), 0)
        out = np.where((out < 0) & (bits <= 1), at, out)
    return out


def _pairs_in_order(max_bits: int, pairs: int, reach: int):
    """Task over rows (key, fp, node) sorted by key and fp: the near pairs whose first shared
    signature is the key. Every row meets the ``reach`` next ones of its key until it is near
    ``pairs`` of them."""

    def task(batches) -> Iterator[pa.RecordBatch]:
        # Rows that the next batch may go on with, and the pairs that they have.
        held = [np.zeros(0, np.int64) for _ in range(4)]
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(c).to_numpy() for c in ("key", "fp", "node")]
            new.append(np.zeros(batch.num_rows, np.int64))
            old = len(held[0])
            key, fp, node, found = (np.concatenate(both) for both in zip(held, new, strict=True))
            bits = fp.view(np.uint64)
            left = np.flatnonzero(found < pairs)
            a, b = [], []
            for step in range(1, reach + 1):
                left = left[: np.searchsorted(left, len(key) - step)]
                left = left[(key[left] == key[left + step]) & (found[left] < pairs)]
                if not len(left):
                    break
                fresh = left[left + step >= old]
                differing = bits[fresh] ^ bits[fresh + step]
                near = np.bitwise_count(differing) <= max_bits
                differing, near = differing[near], fresh[near]
                found[near] += 1
                # A pair shares up to 64 signatures and is given out once.
                near = near[_first_shared(differing, max_bits) == key[near] >> 32]
                a.append(node[near])
                b.append(node[near + step])
            start = max(int(np.searchsorted(key, key[-1])), len(key) - reach)
            held = [c[start:] for c in (key, fp, node, found)]
            none = np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([none, *a])), pa.array(np.concatenate([none, *b]))],
                names=["a", "b"],
            )

    return task


def near_pairs(fingerprints: DataFrame, max_bits: int) -> DataFrame:
    """Pairs (a, b) of ``node`` whose ``fp`` differ in at most ``max_bits`` bits, from distinct
    rows (fp, node).

    A signature that more than ``REACH`` rows share, and a row near more than ``PAIRS`` others
    of it, do not give all of them: that many are alike has to be found in another way too.
    """
    if not 2 <= max_bits < 64:
        raise ValueError("signatures are of two segments or more")
    partitions = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        fingerprints.select("fp", "node")
        .repartition(partitions, "node")  # before each becomes 64 rows
        .select("fp", "node", F.explode(F.array(*_signature_keys(max_bits))).alias("key"))
        .repartition("key")
        .sortWithinPartitions("key", "fp")
        .select("key", "fp", "node")
        .mapInArrow(_pairs_in_order(max_bits, PAIRS, REACH), "a bigint, b bigint")
    )


def near_duplicates(
    df: DataFrame,
    key: str,
    text: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    seed: int = SEED,
) -> DataFrame:
    """Rows (``key``, fp, component_id), one per row of ``df``.

    ``component_id`` is the smallest key that can be reached over links, itself included.
    Rows without a key are rows of their own with a null component, though their texts do
    link others. An empty table gives an empty result.
    """
    rows = write_through(
        fingerprint(df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("t")), "t", "fp", words, seed),
        "fingerprints",
    )
    classes = rows.groupBy("fp").agg(F.min("id").alias("first"))
    found = write_through(links(rows, max_bits), "fingerprint-links")
    grouped = components(found).withColumnRenamed("node", "fp")
    named = write_through(
        classes.join(grouped, "fp", "left").withColumn("component", F.coalesce("component", "fp")),
        "classes",
    )
    least = write_through(
        named.groupBy("component").agg(F.min("first").alias("component_id")), "least"
    )
    of_class = write_through(named.join(least, "component").select("fp", "component_id"), "named")
    return rows.join(of_class, "fp").select(
        F.col("id").alias(key),
        "fp",
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
