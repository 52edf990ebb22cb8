"""Rows that no earlier batch had, told by digests and without reading the layer.

Every batch leaves the distinct digests of its rows, two 64-bit hashes each, in a versioned
table of its own. A new batch is compared with those of the others: a file that comes again
adds nothing, and the layer itself is not scanned. A batch that is taken again replaces its
digests, so what it no longer has is free for others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.operators import digest
from goldrow.operators.schema import col
from goldrow.session import write_through
from goldrow.sinks import writers

_HASHES = ("_h0", "_h1")
BATCH = "batch_id"


def unseen(df: DataFrame, path: str, batch_id: int, ignore: Sequence[str] = ()) -> DataFrame:
    """SET-03 against history: the distinct rows of a batch that no other batch has left.

    ``path`` is the table of digests, which gets those of this batch. Columns in ``ignore``
    (load times, batch ids) do not tell rows apart; of rows that differ in them only, one is
    kept. Nulls are values like others. No rows leave no digests.
    """
    spark = df.sparkSession
    told_by = df.drop(*ignore)
    hashes = dict(zip(_HASHES, digest.row_hashes(told_by), strict=True))
    # Read for the digests and for the comparison; computed once.
    rows = write_through(df.withColumns(hashes).dropDuplicates(list(_HASHES)), "distinct-rows")
    known = writers.read_layer(spark, path) if writers.table_exists(spark, path) else None
    own = rows.select(*_HASHES, F.lit(batch_id).cast("long").alias(BATCH))
    if known is not None:
        others = known.where(F.col(BATCH) != batch_id).select(*_HASHES)
        rows = rows.join(others, list(_HASHES), "left_anti")
    writers.replace_batches(own, path, (BATCH,), emptied=[(batch_id,)])
    return rows.select(*[col(c) for c in df.columns])
