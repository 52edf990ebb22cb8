"""Connected components of a graph whose nodes may have a third of all edges.

Each round, every node points to its smallest neighbour and then, a few times over, to what
that one points to. Edges move to where their ends point; edges that became loops or
repeats go. The rounds end when no edge is left, and each node's component is found by
following the rounds' pointers. Pointers are sums per node that combine before the shuffle,
and joins read stored tables, so adaptive execution can split a hot node's edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.session import write_through

#: Doublings of the pointers per round: 2 of them follow a chain for 4 steps.
JUMPS = 2


def _moved(df: DataFrame, pointers: DataFrame, column: str) -> DataFrame:
    """Replace a column of nodes by what they point to; a node without pointer stays."""
    to = pointers.select(F.col("node").alias(column), F.col("parent").alias("_parent"))
    joined = df.join(to, column, "left")
    others = [c for c in df.columns if c != column]
    return joined.select(*others, F.coalesce("_parent", column).alias(column))


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of an edge; ``component`` is the smallest node
    that can be reached. ``edges`` has the columns ``a`` and ``b``, of one orderable type;
    direction, loops and repeats do not matter. No edges, no rows.
    """
    edges = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    nodes = write_through(
        edges.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes"
    )
    rounds: list[DataFrame] = []
    left = write_through(_tidy(edges), "edges")
    while not left.isEmpty():
        parents = left.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
        for i in range(JUMPS):
            parents = write_through(parents, f"parents-{i}")
            parents = _moved(parents, parents, "parent")
        parents = write_through(parents.select("node", "parent"), "parents")
        rounds.append(parents)
        left = write_through(_tidy(_moved(_moved(left, parents, "a"), parents, "b")), "edges")
    found = nodes.withColumn("component", F.col("node"))
    for parents in rounds:
        found = write_through(_moved(found, parents, "component"), "components")
    return found.select("node", "component")


def _tidy(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    return (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct()
    )
