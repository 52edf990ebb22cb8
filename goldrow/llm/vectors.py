"""Near-duplicate vectors by an exact metric range join.

Vectors of one label are compared by cosine, which for unit vectors is a range of the
Euclidean distance d: cosine >= c means d <= e with e = sqrt(2 - 2c). Pivots, sampled from
the vectors, partition each label: a vector's home is the cell of its nearest pivot. If x
has home i and a partner y has home j, then d(y, p_j) <= d(y, p_i), so by the triangle
inequality d(x, p_j) <= e + d(y, p_j) <= e + d(y, p_i) <= 2e + d(x, p_i). To all such cells
j > i, and to no others, x is copied as a visitor. Cells then join on their own: home rows
with each other and with visitors, so every pair is met once.

Copies of a vector are one row with a weight. A cell is compared in blocks of bounded size,
one task group per pair of blocks, and a group gives back per vector its summed links and
one connecting edge, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrow.llm.components import components
from goldrow.session import write_through

MIN_COSINE = 0.93
#: Distinct vectors that a pivot's cell should hold.
CELL_ROWS = 2048
#: Pivots of all labels together; they travel with the tasks. Cells grow beyond that.
MAX_PIVOTS = 4096
#: Rows in a block of a cell.
BLOCK_ROWS = 2048


def _usable(vector: Column) -> Column:
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of unit length, in double precision; all vectors have one dimension."""
    values = column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)
    # Scaled first, so that squares neither overflow nor vanish.
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt(np.einsum("ij,ij->i", values, values))[:, None]


def _pivots(classes: DataFrame, cell_rows: int, max_pivots: int) -> dict[tuple, np.ndarray]:
    """Per label and dimension with two cells or more, its pivots.

    A label gets one pivot for ``cell_rows`` vectors, but no more than its share of
    ``max_pivots``. So at most ``max_pivots`` labels, and vectors, come to the driver.
    """
    group = ["label", "dim"]
    sizes = classes.groupBy(*group).count()
    total = sizes.agg(F.sum("count")).first()[0] or 0
    share = F.least(F.ceil(F.col("count") / cell_rows), F.floor(F.col("count") * max_pivots / max(total, 1)))
    wanted = sizes.withColumn("pivots", share).where("pivots >= 2")
    # A hash decides: about half as many again as needed, of which the smallest are taken.
    place = (F.xxhash64(F.lit(7), "id") / F.lit(2.0**64)) + 0.5
    sampled = (
        classes.withColumn("place", place)
        .join(F.broadcast(wanted), group)
        .where("place * count < 1.5 * pivots + 8")
        .select(*group, "pivots", "place", "vector")
        .toArrow()
    )
    found: dict[tuple, np.ndarray] = {}
    rows = sampled.sort_by("place").select([*group, "pivots", "vector"]).to_pylist()
    by_group: dict[tuple, list] = {}
    for row in rows:
        some = by_group.setdefault((row["label"], row["dim"]), [])
        if len(some) < row["pivots"]:
            some.append(row["vector"])
    for key, some in by_group.items():
        found[key] = _unit(pa.array(some, pa.list_(pa.float64())))
    return found


def _placements(pivots: dict[tuple, np.ndarray], reach: float):
    """Task: each vector in its home cell and, as a visitor, in the cells it may reach."""

    def task(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, dims = batch.column("label").to_numpy(), batch.column("dim").to_numpy()
            rows, cells, homes = [], [], []
            keys, codes = np.unique(np.stack([labels, dims]), axis=1, return_inverse=True)
            for g, (label, dim) in enumerate(keys.T.tolist()):
                own = np.flatnonzero(codes.ravel() == g)
                centres = pivots.get((label, dim))
                if centres is None:
                    rows.append(own)
                    cells.append(np.zeros(len(own), np.int32))
                    homes.append(np.ones(len(own), bool))
                    continue
                unit = _unit(batch.column("vector").take(pa.array(own)))
                distance = np.sqrt(np.maximum(0, 2 - 2 * unit @ centres.T))
                home = distance.argmin(axis=1)
                near = distance <= distance.min(axis=1, keepdims=True) + reach
                near &= np.arange(len(centres))[None, :] > home[:, None]
                near[np.arange(len(own)), home] = True
                row, cell = np.nonzero(near)
                rows.append(own[row])
                cells.append(cell.astype(np.int32))
                homes.append(cell == home[row])
            if not rows:
                continue
            for at in range(0, sum(map(len, rows)), 10_000):
                take = np.concatenate(rows)[at : at + 10_000]
                out = batch.take(pa.array(take))
                yield pa.RecordBatch.from_arrays(
                    [
                        *out.columns,
                        pa.array(np.concatenate(cells)[at : at + 10_000]),
                        pa.array(np.concatenate(homes)[at : at + 10_000]),
                    ],
                    names=[*batch.schema.names, "cell", "home"],
                )

    return task


def _in_blocks(placed: DataFrame, block_rows: int) -> DataFrame:
    """Copy each row to the pairs of blocks of its cell that it has to be compared in.

    Blocks 0 to h-1 hold the home rows, blocks h to h+v-1 the visitors. The pairs are (a, b)
    with a <= b and a < h.
    """
    cell = ["label", "dim", "cell"]
    sizes = placed.groupBy(*cell).agg(
        F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("visitors")
    )
    blocks = sizes.select(
        *cell,
        F.ceil(F.col("homes") / block_rows).cast("int").alias("h"),
        F.ceil(F.col("visitors") / block_rows).cast("int").alias("v"),
    )
    number = F.xxhash64(F.lit(11), "id")
    own = F.when(F.col("home"), F.pmod(number, "h")).otherwise(F.col("h") + F.pmod(number, "v"))
    before = F.sequence(F.lit(0), F.least("block", F.col("h") - 1))
    after = F.when(
        F.col("home") & (F.col("block") + 1 < F.col("h") + F.col("v")),
        F.sequence(F.col("block") + 1, F.col("h") + F.col("v") - 1),
    ).otherwise(F.array().cast("array<int>"))
    partners = F.concat(
        F.transform(before, lambda a: F.struct(a.alias("a"), F.col("block").alias("b"))),
        F.transform(after, lambda b: F.struct(F.col("block").alias("a"), b.alias("b"))),
    )
    return (
        placed.join(write_through(blocks, "blocks"), cell)
        .where("h > 0")
        .withColumn("block", own.cast("int"))
        .withColumn("pair", F.explode(partners))
        .select(*cell, "pair.a", "pair.b", "block", "id", "weight", "vector")
    )


def _compare(min_cosine: float):
    def compare(table: pa.Table) -> pa.Table:
        """Links and connections between blocks a and b, or within one block."""
        a, b = table["a"][0].as_py(), table["b"][0].as_py()
        block, ids = table["block"].to_numpy(), table["id"].to_numpy()
        weights = table["weight"].to_numpy()
        unit = _unit(table["vector"].combine_chunks())
        left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
        linked = unit[left] @ unit[right].T >= min_cosine
        if a == b:
            np.fill_diagonal(linked, False)
        links = np.zeros(len(ids), np.int64)
        links[left] += linked @ weights[right]
        if a != b:
            links[right] += weights[left] @ linked
        label = ids.copy()
        while True:
            ahead = label.copy()
            for at in range(len(left)):
                mine = right[linked[at]]
                if len(mine):
                    least = min(ahead[left[at]], ahead[mine].min())
                    ahead[left[at]] = least
                    ahead[mine] = np.minimum(ahead[mine], least)
            if (ahead == label).all():
                break
            label = ahead
        some = links > 0
        return pa.table({"id": ids[some], "links": links[some], "root": label[some]})

    return compare


def range_join(
    classes: DataFrame,
    min_cosine: float = MIN_COSINE,
    cell_rows: int = CELL_ROWS,
    max_pivots: int = MAX_PIVOTS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows (id, links, root) of distinct vectors (id, label, dim, vector, weight).

    Summed over an id's rows, ``links`` is the weight of all others of its label and
    dimension with a cosine of ``min_cosine`` or more. The pairs (id, root) connect exactly
    what those links connect. ``classes`` should be a stored table.
    """
    reach = 2 * float(np.sqrt(2 - 2 * min_cosine)) + 1e-9
    pivots = _pivots(classes, cell_rows, max_pivots)
    placed = write_through(
        classes.mapInArrow(
            _placements(pivots, reach),
            "id bigint, label int, dim int, vector array<double>, weight bigint, cell int, home boolean",
        ),
        "cells",
    )
    return (
        _in_blocks(placed, block_rows)
        .groupBy("label", "dim", "cell", "a", "b")
        .applyInArrow(_compare(min_cosine), "id bigint, links bigint, root bigint")
    )


def near_duplicates(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    min_cosine: float = MIN_COSINE,
    **options: int,
) -> DataFrame:
    """Rows (``key``, n_links, component_id, kept), one per row of ``df``.

    Only rows of equal labels link. Rows without label or key, and vectors that are null,
    empty, zero, or hold a null or non-finite component, link with nothing: they have no
    links and are their own component. Vectors of unlike dimensions do not link. Repeated
    rows are others to each other, and of rows with one key each has the links of its own
    vector. A row without key has no component and is kept. No rows, no result.
    """
    rows = df.select(
        F.col(f"`{key}`").cast("bigint").alias("id"),
        F.col(f"`{label}`").cast("int").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    )
    usable = F.coalesce(_usable(F.col("vector")), F.lit(False))
    usable &= F.col("id").isNotNull() & F.col("label").isNotNull()
    good = rows.where(usable)
    # Classes have numbers of their own, as one key may stand for several vectors.
    classes = write_through(
        good.groupBy("label", "vector")
        .agg(F.min("id").alias("first"), F.count("*").alias("weight"))
        .select(
            F.monotonically_increasing_id().alias("id"),
            "first",
            "label",
            F.size("vector").alias("dim"),
            "vector",
            "weight",
        ),
        "vectors",
    )
    joined = write_through(
        range_join(classes.drop("first"), min_cosine, **options), "links"
    )
    linked = joined.groupBy("id").agg(F.sum("links").alias("links"))
    grouped = components(joined.select(F.col("id").alias("a"), F.col("root").alias("b")))
    found = write_through(
        classes.join(linked, "id", "left")
        .join(grouped.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "label",
            "vector",
            "first",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component"),
        ),
        "classes",
    )
    least = found.groupBy("component").agg(F.min("first").alias("component_id"))
    named = write_through(found.join(least, "component").drop("component", "first"), "named")
    known = good.join(named, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = rows.where(~usable).select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    return known.unionByName(alone).select(
        F.col("id").alias(key),
        "n_links",
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
