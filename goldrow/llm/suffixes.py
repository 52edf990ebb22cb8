"""Removal of long repeated byte strings with suffix arrays around shared anchors.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else as well. All
such windows of a text are dealt out to anchors: a window's anchor is its rightmost gram of
``GRAM`` bytes with the least hash, which depends on the window's bytes alone. So equal
windows have equal anchors at equal offsets, and only anchors whose hash occurs again need
a closer look; for these, the bytes of their windows (the context) go to the hash's task.

There, two suffix arrays are made: of the contexts' bytes from the anchor forwards, and from
the anchor backwards. Both are sorted deep-shallow: multikey quicksort by words of eight
bytes down to ``SHALLOW`` words, then blind tries for groups that still have a common
prefix. The window at offset o is repeated if another context has the same run of common
prefixes of ``LENGTH - o`` bytes in the one array and of o bytes in the other. That compares
all bytes, no hashes. Equal contexts are one entry with a count.

An anchor hash with more than ``GROUP_CONTEXTS`` different contexts would gather in one
task. Its windows are counted one by one instead, by a 128-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.llm.words import blocks, schema_with, texts_of
from goldrow.session import write_through

LENGTH = 200
GRAM = 64
#: Words of eight bytes behind the gram that multikey quicksort compares.
SHALLOW = 2
#: Different contexts of an anchor hash that one task compares.
GROUP_CONTEXTS = 4096
#: Contexts that a task sorts together.
BUCKET_CONTEXTS = 16_384
#: Contexts that a task remembers as sent before it starts anew.
SEEN_CONTEXTS = 500_000
#: Window starts that are hashed at a time.
SEGMENT = 1 << 20

_WINDOW = LENGTH - GRAM + 1
_BASE = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 24) - 1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the gram at each place: polynomials of doubled length."""
    h = _BYTES[data]
    size = 1
    while size < GRAM:
        h = h[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + h[size:]
        size *= 2
    return _mixed(h)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _anchors(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per anchor: its text, its gram's hash, and (place, least and largest offset of its
    windows) packed into 64 bits."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    starts = offsets - offsets[0]
    out: list[tuple[np.ndarray, ...]] = []
    for a in range(0, max(len(data) - LENGTH + 1, 0), SEGMENT):
        part = data[a : a + SEGMENT + LENGTH - 1]
        n = len(part) - LENGTH + 1
        h = _gram_hashes(part)
        place = np.arange(len(h), dtype=np.uint64)
        least = _least((h & ~_PLACE) | (_PLACE - place), _WINDOW)[:n]
        anchor = (_PLACE - (least & _PLACE)).astype(np.int64)
        valid = np.zeros(n, bool)
        first = int(np.searchsorted(starts, a, side="right")) - 1
        last = int(np.searchsorted(starts, a + n, side="left"))
        for s, e in zip(starts[first:last] - a, starts[first + 1 : last + 1] - a, strict=True):
            if e - LENGTH >= 0:
                valid[max(s, 0) : e - LENGTH + 1] = True
        begin = valid.copy()
        begin[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
        begin = np.flatnonzero(begin)
        if not len(begin):
            continue
        end = valid.copy()
        end[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
        end = np.flatnonzero(end)
        p = anchor[begin]
        text = np.searchsorted(starts, a + begin, side="right") - 1
        packed = ((a + p - starts[text]) << 16) | ((p - end) << 8) | (p - begin)
        out.append((text, h[p].view(np.int64), packed))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _count_anchors(batches) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text"):
        _, h, _ = _anchors(texts_of(block))
        h, n = np.unique(h, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], names=["h", "n"])


def _list_anchors(batches) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text"):
        text, h, packed = _anchors(texts_of(block))
        ids = block.column("id").take(pa.array(text))
        yield pa.RecordBatch.from_arrays([pa.array(h), ids, pa.array(packed)], names=["h", "id", "at"])


def _cut_contexts(batches) -> Iterator[pa.RecordBatch]:
    """Rows (h, c, id, at, context); of equal contexts of a task about one has the bytes."""
    seen: set[tuple[int, int]] = set()
    for block in blocks(batches, "text", 4 << 20):
        out: list[list] = [[], [], [], [], []]
        if len(seen) > SEEN_CONTEXTS:
            seen.clear()
        texts, ids = texts_of(block), block.column("id").to_pylist()
        lists = block.column("anchors")
        h_all = lists.values.field("h").to_pylist()
        at_all = lists.values.field("at").to_pylist()
        offsets = lists.offsets.to_pylist()
        for row, own_id in enumerate(ids):
            data = memoryview(texts[row].as_buffer())
            for k in range(offsets[row], offsets[row + 1]):
                h, at = h_all[k], at_all[k]
                p, low, high = at >> 16, at >> 8 & 255, at & 255
                context = data[p - high : p - low + LENGTH]
                c = xxhash.xxh64_intdigest(context, low << 8 | high)
                c -= (c >> 63) << 64
                new = (h, c) not in seen
                seen.add((h, c))
                for column, value in zip(
                    out, (h, c, own_id, at, bytes(context) if new else None), strict=True
                ):
                    column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(out, kinds, strict=True)],
            names=["h", "c", "id", "at", "context"],
        )


# --- deep-shallow sorting ---------------------------------------------------------------


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix of two strings of one length."""
    x = int.from_bytes(a) ^ int.from_bytes(b)
    return len(a) - (x.bit_length() + 7) // 8


def _blind_trie(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Sorted order of strings of one length, and each one's common prefix with the one
    before. An inner node is [depth, {byte: node}]; a leaf is the list of equal strings.
    A string first goes down blindly, by the bytes at the nodes' depths alone; its one
    comparison with the leaf found tells where it branches off."""
    size = len(strings[0])
    root: list | None = None
    for place, s in enumerate(strings):
        if root is None:
            root = [size, [place]]
            continue
        node = root
        while node[0] < size:
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        other = strings[node[1][0]]
        depth = _common(s, other)
        if depth == size:
            node[1].append(place)
            continue
        parent, node = None, root
        while node[0] < depth:
            parent, node = node, node[1][s[node[0]]]
        if node[0] == depth:
            node[1][s[depth]] = [size, [place]]
        else:
            split = [depth, {other[depth]: node, s[depth]: [size, [place]]}]
            if parent is None:
                root = split
            else:
                parent[1][s[parent[0]]] = split
    order, common = [], []
    stack = [(root, 0)]
    while stack:
        node, shared = stack.pop()
        if node[0] == size:
            order += node[1]
            common += [shared] + [size] * (len(node[1]) - 1)
            continue
        # The first child shares with what is before what the node does.
        children = sorted(node[1])
        for k in reversed(range(1, len(children))):
            stack.append((node[1][children[k]], node[0]))
        stack.append((node[1][children[0]], shared))
    return order, common


def suffix_order(rows: np.ndarray, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of byte rows of one width, and each row's common prefix with the one
    before it (0 for the first)."""
    n, width = rows.shape
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    words = padded.view(">u8").astype(np.uint64)
    order = np.arange(n)
    common = np.zeros(n, np.int64)
    # Groups of equal prefixes as [begin, end) in ``order``; those of one row are done.
    group = np.zeros(n, np.int64)
    open_rows = np.arange(n)
    for depth in range(min(shallow, words.shape[1])):
        at = order[open_rows]
        by = np.lexsort((words[at, depth], group[open_rows]))
        order[open_rows] = at[by]
        word = words[order[open_rows], depth]
        owner = group[open_rows]
        fresh = np.ones(len(open_rows), bool)
        fresh[1:] = owner[1:] != owner[:-1]
        differs = np.zeros(len(open_rows), bool)
        differs[1:] = ~fresh[1:] & (word[1:] != word[:-1])
        where = np.flatnonzero(differs)
        x = (word[where] ^ word[where - 1]).astype(">u8").view(np.uint8).reshape(-1, 8)
        common[open_rows[where]] = np.minimum(8 * depth + (x != 0).argmax(axis=1), width)
        number = np.cumsum(fresh | differs)
        sizes = np.bincount(number)
        keep = sizes[number] > 1
        group[open_rows] = number
        open_rows = open_rows[keep]
        if not len(open_rows):
            return order, common
    data = rows.tobytes()
    edges = np.flatnonzero(np.diff(group[open_rows])) + 1
    for own in np.split(open_rows, edges):
        members = order[own].tolist()
        strings = [data[m * width : (m + 1) * width] for m in members]
        sorted_places, shared = _blind_trie(strings)
        order[own] = [members[k] for k in sorted_places]
        common[own[1:]] = shared[1:]
    return order, common


def _repeated_windows(
    contexts: list[bytes], low: np.ndarray, high: np.ndarray, many: np.ndarray
) -> np.ndarray:
    """Whether the window of each context at each offset (0 to LENGTH - GRAM) is repeated."""
    n = len(contexts)
    ahead = np.zeros((n, LENGTH), np.uint8)
    back = np.zeros((n, _WINDOW - 1), np.uint8)
    for i, context in enumerate(contexts):
        data = np.frombuffer(context, np.uint8)
        h = int(high[i])
        right = data[h:]
        ahead[i, : len(right)] = right
        back[i, :h] = data[:h][::-1]
    classes = []
    for rows in (ahead, back):
        order, common = suffix_order(rows, SHALLOW + (GRAM // 8 if rows is ahead else 0))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        classes.append((place, common))
    offsets = np.arange(_WINDOW)
    held = (offsets >= low[:, None]) & (offsets <= high[:, None])
    repeated = held & many[:, None]
    for o in offsets:
        own = np.flatnonzero(held[:, o])
        if len(own) < 2:
            continue
        (place_a, common_a), (place_b, common_b) = classes
        run_a = np.cumsum(common_a < LENGTH - o)[place_a[own]]
        run_b = np.cumsum(common_b < o)[place_b[own]]
        key = run_a * (n + 1) + run_b
        ordered = np.sort(key)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(twice):
            at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
            repeated[own[twice[at] == key], o] = True
    return repeated


def _judge_bucket(table: pa.Table) -> pa.Table:
    """Per context, the runs of offsets whose windows are repeated."""
    contexts = table["context"].to_pylist()
    at = table["at"].to_numpy()
    low, high = at >> 8 & 255, at & 255
    many = table["n"].to_numpy() > 1
    h = table["h"].to_numpy()
    # A context that is alone with its hash was repeated as a whole, or not at all.
    _, group, sizes = np.unique(h, return_inverse=True, return_counts=True)
    alone = sizes[group] == 1
    repeated = np.zeros((len(h), _WINDOW), bool)
    offsets = np.arange(_WINDOW)
    whole = (offsets >= low[:, None]) & (offsets <= high[:, None])
    repeated[alone & many] = whole[alone & many]
    rest = np.flatnonzero(~alone)
    if len(rest):
        repeated[rest] = _repeated_windows([contexts[i] for i in rest], low[rest], high[rest], many[rest])
    edge = np.diff(np.pad(repeated, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    _, last = np.nonzero(edge == -1)
    # Windows at offsets first to last - 1 cover these places around the anchor.
    return pa.table(
        {
            "h": h[row],
            "c": table["c"].to_numpy()[row],
            "a": (1 - last).astype(np.int32),
            "b": (LENGTH - first).astype(np.int32),
        }
    )


def _single_windows(batches) -> Iterator[pa.RecordBatch]:
    """Every window of a context on its own: (h, c, o, w1, w2, n)."""
    for batch in batches:
        h, c, n = (batch.column(k).to_pylist() for k in ("h", "c", "n"))
        out: list[tuple] = []
        for i, context in enumerate(batch.column("context").to_pylist()):
            high = batch.column("at")[i].as_py() & 255
            for k in range(len(context) - LENGTH + 1):
                w = xxhash.xxh3_128_intdigest(context[k : k + LENGTH])
                out.append((h[i], c[i], high - k, w >> 65, w & (1 << 63) - 1, n[i]))
            if len(out) > 50_000 or i + 1 == batch.num_rows:
                columns = list(zip(*out, strict=True)) or [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(columns, kinds, strict=True)],
                    names=["h", "c", "o", "w1", "w2", "n"],
                )
                out = []


def _judge_hot(contexts: DataFrame) -> DataFrame:
    """Spans of the contexts of anchors that have very many different ones."""
    windows = write_through(
        contexts.select("h", "c", "at", "n", "context").mapInArrow(
            _single_windows, "h bigint, c bigint, o int, w1 bigint, w2 bigint, n bigint"
        ),
        "windows",
    )
    window = ["h", "o", "w1", "w2"]
    repeated = write_through(
        windows.groupBy(*window).agg(F.sum("n").alias("times")).where("times > 1").select(*window),
        "repeated-windows",
    )
    hits = windows.join(repeated, window).select("h", "c", "o")
    return hits.select("h", "c", (-F.col("o")).alias("a"), (LENGTH - F.col("o")).alias("b"))


# --- the operator -------------------------------------------------------------------------


def _spans(docs: DataFrame) -> DataFrame:
    """Rows (id, spans): the removed places of texts, in any order, for rows (id, text)."""
    again = write_through(
        docs.mapInArrow(_count_anchors, "h bigint, n bigint")
        .groupBy("h")
        .agg(F.sum("n").alias("n"))
        .where("n > 1")
        .select("h"),
        "anchors",
    )
    shared = docs.mapInArrow(_list_anchors, "h bigint, id binary, at bigint").join(
        again, "h", "left_semi"
    )
    # Equal rows have one id: its anchors are listed once, and each row is cut at them.
    by_text = shared.groupBy("id").agg(F.collect_set(F.struct("h", "at")).alias("anchors"))
    cut = write_through(
        docs.join(by_text, "id").mapInArrow(
            _cut_contexts, "h bigint, c bigint, id binary, at bigint, context binary"
        ),
        "contexts",
    )
    distinct = write_through(
        cut.groupBy("h", "c").agg(
            F.count("*").alias("n"), F.max("at").alias("at"), F.max("context").alias("context")
        ),
        "distinct-contexts",
    )
    hot = write_through(
        distinct.groupBy("h").count().where(F.col("count") > GROUP_CONTEXTS).select("h"), "hot"
    )
    few = distinct.join(hot, "h", "left_anti")
    buckets = max(1, -(-distinct.count() // BUCKET_CONTEXTS))
    judged = (
        few.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInArrow(_judge_bucket, "h bigint, c bigint, a int, b int")
    )
    if not hot.isEmpty():
        judged = judged.unionByName(_judge_hot(distinct.join(hot, "h", "left_semi")))
    judged = write_through(judged, "judged")
    place = F.shiftright("at", 16)
    found = cut.select("h", "c", "id", "at").join(judged, ["h", "c"])
    span = F.struct((place + F.col("a")).alias("start"), (place + F.col("b")).alias("stop"))
    return found.groupBy("id").agg(F.collect_set(span).alias("spans"))


def _merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching spans."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    first = np.ones(len(starts), bool)
    first[1:] = starts[1:] > reach[:-1]
    ends = np.append(np.flatnonzero(first)[1:], len(starts)) - 1
    return starts[first], reach[ends]


def remove_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", as_text: bool = False
) -> DataFrame:
    """All columns but the text, and ``n_bytes``, ``removed`` (maximal removed spans, an array
    of start and stop), and ``kept`` (binary, what is left; as a string if ``as_text``, without
    the characters of which a part was removed).

    Every byte goes that a string of ``LENGTH`` bytes covers which starts elsewhere too, in
    this or any other row; strings do not cross rows, and copies lose all of their bytes. A
    null text is empty. Keys may repeat or be null; a row is told by a 128-bit hash of its key
    and text, and rows equal in both are alike. An empty table gives an empty result.
    """
    halves = [
        F.unhex(F.lpad(F.hex(F.xxhash64(F.lit(seed), F.col(f"`{key}`"), F.col(f"`{text}`"))), 16, "0"))
        for seed in (42, 43)
    ]
    others = [c for c in df.columns if c not in (text, "n_bytes", "removed", "kept")]
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
        F.concat(*halves).alias("id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    spans = _spans(rows.select("id", "text").where(F.octet_length("text") >= LENGTH))
    schema = schema_with(
        rows,
        ["row"],
        "n_bytes bigint, removed array<struct<start: bigint, stop: bigint>>, "
        f"kept {'string' if as_text else 'binary'}",
    )

    span_list = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def task(batches) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", 4 << 20):
            texts, lists = texts_of(block), block.column("spans")
            removed, kept = [], []
            for row in range(block.num_rows):
                data = texts[row].as_buffer().to_pybytes()
                own = lists[row].values
                if own is None or not len(own):
                    removed.append([])
                    kept.append(data)
                    continue
                starts, stops = _merged(own.field("start").to_numpy(), own.field("stop").to_numpy())
                pieces, at = [], 0
                for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
                    pieces.append(data[at:a])
                    at = b
                kept.append(b"".join([*pieces, data[at:]]))
                removed.append(
                    [{"start": a, "stop": b} for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("row"),
                    pc.binary_length(texts).cast(pa.int64()),
                    pa.array(removed, span_list),
                    pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
                    if as_text
                    else pa.array(kept, pa.binary()),
                ],
                names=schema.names,
            )

    return (
        rows.join(spans, "id", "left")
        .select("row", "text", "spans")
        .mapInArrow(task, schema)
        .select(*[F.col("row")[c].alias(c) for c in others], "n_bytes", "removed", "kept")
    )
