"""Best-fit packing of token sequences by bin completion with branch and bound.

Texts become ids (``tokens``), longer ones are cut into full pieces. Packing depends on
lengths alone, and there are at most ``capacity`` of them: Spark counts the pieces of each
length, one plan is found for the counts, and every piece looks up its place by its rank
among the pieces of its length. The plan's size depends on the capacity, not on the rows.

A plan fills sequences around the largest length left with an undominated completion: one
to which no piece can be added, and in which no pieces can be exchanged for a single one of
their size. The fullest come first. A completion is used as often as the counts allow, and
again from what is left; that descent gives the incumbent. The search then goes back over
the choices, cuts off a branch once its waste rules out fewer sequences than the incumbent
has, and ends when the incumbent meets the lower bound or after ``max_nodes`` more.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.llm.ranks import rank_in_groups
from goldrow.llm.tokens import Encoder
from goldrow.llm.words import as_row, blocks, of_row, schema_with, texts_of, word_table

CAPACITY = 4096
#: Nodes the search visits, after its first descent, before it settles for its incumbent.
MAX_NODES = 2_000
#: Completions that a node tries.
CHOICES = 4
#: Ids in one Arrow batch that goes back to Spark.
BATCH_IDS = 1_000_000


def token_pieces(
    df: DataFrame, tokenizer_file: str, end: int, capacity: int = CAPACITY, text: str = "text"
) -> DataFrame:
    """One row per piece: the input's columns and ``piece`` (from 0), ``start`` (ids of the
    text before it), ``length`` and ``ids`` (binary, little-endian unsigned 32-bit).

    The ids of a whole text end with ``end``. Only texts of more than ``capacity`` ids are
    cut. A null text is an empty one, whose only id is ``end``. The column ``text`` itself
    is left out, and input columns named as the new ones are replaced.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        config = file.read()
    new = ("piece", "start", "length", "ids")
    kept = [c for c in df.columns if c not in new and c != text]
    rows = df.select(as_row(kept), F.col(f"`{text}`").alias("text"))
    schema = schema_with(rows, ["row"], "piece int, start bigint, length bigint, ids binary")

    def task(batches) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(config)
        for block in blocks(batches, "text"):
            ids = encoder.encode(word_table(texts_of(block)), end)
            sizes = np.diff(ids.offsets.to_numpy())
            data = pa.py_buffer(np.ascontiguousarray(ids.values.to_numpy().astype("<u4")))
            pieces = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(sizes)), pieces)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = number * capacity
            length = np.minimum(sizes[owner] - start, capacity)
            ends = np.cumsum(length)
            a = 0
            while a < len(owner):
                base = ends[a] - length[a]
                b = max(a + 1, int(np.searchsorted(ends, base + BATCH_IDS, side="right")))
                row = block.column("row").take(pa.array(owner[a:b]))
                offsets = np.concatenate([[base], ends[a:b]])
                own = data.slice(4 * int(base), 4 * int(ends[b - 1] - base))
                binary = pa.Array.from_buffers(
                    pa.binary(),
                    b - a,
                    [None, pa.py_buffer((4 * (offsets - base)).astype(np.int32)), own],
                )
                columns = [pa.array(number[a:b], pa.int32()), pa.array(start[a:b]), pa.array(length[a:b])]
                yield pa.RecordBatch.from_arrays([row, *columns, binary], names=schema.names)
                a = b

    return rows.mapInArrow(task, schema).select(*of_row(kept), *new)


@dataclass(frozen=True)
class Filling:
    """``times`` sequences that hold the same lengths, given from large to small."""

    lengths: tuple[int, ...]
    times: int


def _pairs(counts: np.ndarray, sizes: np.ndarray, room: int, keep: int) -> list[tuple[int, ...]]:
    """Pairs of lengths that fit into ``room``: the fullest, of these the most uneven."""
    larger = sizes[sizes <= room]
    if not len(larger):
        return []
    best = larger - 1  # index below: the largest length that still fits beside it
    at = np.searchsorted(sizes, np.minimum(room - larger, larger), side="right") - 1
    ok = at >= 0
    # Two of one length need two pieces of it.
    same = ok & (sizes[at] == larger) & (counts[larger] < 2)
    at = np.where(same, at - 1, at)
    ok &= at >= 0
    larger, best = larger[ok], sizes[at[ok]]
    order = np.lexsort((-larger, room - larger - best))[:keep]
    return [(int(larger[i]), int(best[i])) for i in order]


def completions(counts: np.ndarray, room: int, keep: int = CHOICES) -> list[tuple[int, ...]]:
    """Undominated ways to fill ``room`` from the lengths that ``counts`` has, the fullest
    first and among equally full ones those of few, large pieces."""
    sizes = np.flatnonzero(counts[: room + 1])
    if not len(sizes):
        return [()]
    found: list[tuple[int, ...]] = [(int(sizes[-1]),)]
    if sizes[-1] < room:
        found += _pairs(counts, sizes, room, keep)
        if all(sum(f) < room for f in found):
            # One piece more: around each of the large ones, and around one just smaller
            # than leaves a middle piece's room.
            firsts = {*sizes[::-1][:keep].tolist(), *sizes[sizes <= room // 2][::-1][:keep].tolist()}
            for first in firsts:
                left = counts.copy()
                left[first] -= 1
                rest = np.flatnonzero(left[: room - first + 1])
                found += [(first, *p) for p in _pairs(left, rest, room - first, keep)]
    whole = {tuple(sorted(_topped_up(counts, f, room), reverse=True)) for f in found}
    undominated = [f for f in whole if not _dominated(counts, f)]
    return sorted(undominated, key=lambda f: (room - sum(f), len(f), [-s for s in f]))[:keep]


def _topped_up(counts: np.ndarray, lengths: tuple[int, ...], room: int) -> list[int]:
    """Add the largest piece that still fits until none does."""
    out, used = list(lengths), Counter(lengths)
    left = room - sum(lengths)
    sizes = np.flatnonzero(counts[: left + 1]) if left > 0 else ()
    for size in reversed(sizes):
        while size <= left and counts[size] > used[int(size)]:
            out.append(int(size))
            used[int(size)] += 1
            left -= int(size)
    return out


def _dominated(counts: np.ndarray, lengths: tuple[int, ...]) -> bool:
    """Whether a single piece that is left over has the size of two of these."""
    used = Counter(lengths)
    return any(
        counts[a + b] > used[a + b]
        for i, a in enumerate(lengths)
        for b in lengths[i + 1 :]
        if a + b < len(counts)
    )


def pack_counts(
    counts: np.ndarray, capacity: int = CAPACITY, max_nodes: int = MAX_NODES
) -> list[Filling]:
    """Fillings that use ``counts[s]`` pieces of every length s from 1 to ``capacity``."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    total = int((left * np.arange(len(left))).sum())
    bound = max(-(-total // capacity), int(left[capacity // 2 + 1 :].sum()))
    best: list[Filling] | None = None
    best_bins = 0

    # A path is thousands of fillings deep: all its nodes share ``left``, and hold only the
    # fillings that they try.
    def fillings() -> Iterator[Filling]:
        largest = int(np.flatnonzero(left)[-1])
        left[largest] -= 1
        rests = completions(left, capacity - largest)
        left[largest] += 1
        found = []
        for rest in rests:
            need = Counter((largest, *rest))
            times = min(int(left[s]) // n for s, n in need.items())
            found.append(Filling((largest, *rest), times))
        return iter(found)

    path: list[Filling] = []
    bins = waste = nodes = 0

    def use(filling: Filling, times: int) -> None:
        nonlocal bins, waste
        for size in filling.lengths:
            left[size] -= times
        bins += times
        waste += times * (capacity - sum(filling.lengths))

    def undo() -> None:
        undone = path.pop()
        use(undone, -undone.times)

    stack = [fillings()] if left.any() else []
    if not stack:
        return []
    while stack:
        filling = next(stack[-1], None)
        if filling is None:
            stack.pop()
            if path:
                undo()
            continue
        nodes += best is not None
        lost = waste + filling.times * (capacity - sum(filling.lengths))
        # Waste that leaves no room below the incumbent's number of sequences.
        if best is not None and total + lost > (best_bins - 1) * capacity:
            if nodes >= max_nodes:
                break
            continue
        path.append(filling)
        use(filling, filling.times)
        if left.any():
            stack.append(fillings())
        else:
            if best is None or bins < best_bins:
                best, best_bins = list(path), bins
            undo()
        if best is not None and (best_bins == bound or nodes >= max_nodes):
            break
    return best


def _places(plan: list[Filling], capacity: int) -> list[np.ndarray]:
    """Per length, runs of ranks that share a filling: first rank, first sequence, pieces of
    the length in each sequence, offset of the first."""
    used = np.zeros(capacity + 1, np.int64)
    runs: list[list[tuple[int, int, int, int]]] = [[] for _ in range(capacity + 1)]
    sequence = 0
    for filling in plan:
        offset = 0
        for size, each in Counter(filling.lengths).items():
            runs[size].append((int(used[size]), sequence, each, offset))
            used[size] += each * filling.times
            offset += each * size
        sequence += filling.times
    return [np.array(r, np.int64).reshape(-1, 4) for r in runs]


def pack(
    pieces: DataFrame,
    keys: list[str],
    capacity: int = CAPACITY,
    length: str = "length",
    max_nodes: int = MAX_NODES,
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of 1 to ``capacity`` tokens.

    ``keys`` tell pieces apart; pieces equal in all of them are interchangeable. All of a
    sequence's pieces lie side by side from offset 0. An empty table gives an empty result.
    Only the counts per length, at most ``capacity`` rows, come to the driver. The input is
    read twice, so it should be a stored table.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy(F.col(f"`{length}`").alias("s")).count().collect():
        if row["s"] is None or not 1 <= row["s"] <= capacity:
            raise ValueError(f"a piece has {row['s']} tokens")
        counts[row["s"]] = row["count"]
    places = _places(pack_counts(counts, capacity, max_nodes), capacity)

    rows = pieces.select(
        F.struct(*[F.col(f"`{c}`") for c in pieces.columns]).alias("row"),
        F.col(f"`{length}`").cast("bigint").alias("size"),
        F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("key"),
        *[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)],
    )
    ranked = rank_in_groups(rows, ["size"], "key", [f"k{i}" for i in range(len(keys))])
    ranked = ranked.select("row", "size", "rank")
    schema = schema_with(ranked, ["row"], "sequence_id bigint, offset bigint")

    def task(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            ranks = batch.column("rank").to_numpy() - 1
            sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
            order = np.argsort(sizes, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
                if not len(own):
                    continue
                size, runs = int(sizes[own[0]]), places[int(sizes[own[0]])]
                run = runs[np.searchsorted(runs[:, 0], ranks[own], side="right") - 1]
                along = ranks[own] - run[:, 0]
                sequence[own] = run[:, 1] + along // run[:, 2]
                offset[own] = run[:, 3] + along % run[:, 2] * size
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(sequence), pa.array(offset)],
                names=["row", "sequence_id", "offset"],
            )

    new = ("sequence_id", "offset")
    return ranked.mapInArrow(task, schema).select(
        *[F.col("row")[c].alias(c) for c in pieces.columns if c not in new], *new
    )
