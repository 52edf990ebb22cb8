"""Which tables of a family have which key, from one pass over all of them.

All tables become narrow rows of their key and meet in one aggregation: one row per key
with a bit for every table that has it and the table's rows of that key, those that pass
its own checks apart. Rows combine before the shuffle, so a key with a third of all rows
is a row per task. Every reference check of the family reads its bit; outcomes of whole
tables are sums over the index, without a join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrow.functions.predicates import non_blank
from goldrow.operators.schema import col
from goldrow.operators.skew import default_pieces, mark_known
from goldrow.session import write_through

KEY, BITS = "_key", "_bits"
#: Tables of an index: a bit each in a bigint.
MAX_TABLES = 62


@dataclass(frozen=True)
class Member:
    """A table of the family, its key column, and the condition its rows have to pass."""

    df: DataFrame
    key: str
    passes: Column


@dataclass(frozen=True)
class Membership:
    """``index`` has a row per key, the null key too: ``_key``, ``_bits``, and per table its
    rows (``_n0``, ...) and those that pass (``_ok0``, ...). A blank key has no bit."""

    tables: tuple[str, ...]
    index: DataFrame

    @classmethod
    def of(cls, members: Mapping[str, Member]) -> Membership:
        if len(members) > MAX_TABLES:
            raise ValueError(f"{len(members)} tables are more than the {MAX_TABLES} of an index")
        narrow = reduce(
            lambda a, b: a.unionByName(b),
            [
                m.df.select(
                    col(m.key).cast("string").alias(KEY),
                    F.lit(i).alias("_table"),
                    F.lit(1 << i).cast("bigint").alias("_bit"),
                    F.coalesce(m.passes, F.lit(False)).alias("_passes"),
                )
                for i, m in enumerate(members.values())
            ],
        )
        bit = F.when(non_blank(F.col(KEY)), F.col("_bit"))
        sums = []
        for i in range(len(members)):
            own = F.col("_table") == i
            sums.append(F.count_if(own).alias(f"_n{i}"))
            sums.append(F.count_if(own & F.col("_passes")).alias(f"_ok{i}"))
        held = F.coalesce(F.bit_or(bit), F.lit(0).cast("bigint")).alias(BITS)
        return cls(tuple(members), narrow.groupBy(KEY).agg(held, *sums))

    def written(self) -> Membership:
        """The same index, read from a table written once to the shared folder."""
        return replace(self, index=write_through(self.index, "membership"))

    def has(self, table: str) -> Column:
        """Whether the key of an index row occurs in a table."""
        bit = 1 << self.tables.index(table)
        return F.col(BITS).bitwiseAND(F.lit(bit)) != 0

    def mark(
        self, df: DataFrame, table: str, key: str, other: str, flag: str, pieces: int | None = None
    ) -> DataFrame:
        """Add ``flag`` to rows of ``table``: whether their key occurs in ``other``.

        Only the index is asked which keys are heavy.
        """
        pieces = default_pieces(df) if pieces is None else pieces
        rows = F.col(f"_n{self.tables.index(table)}")
        with_key = self.index.where(F.col(KEY).isNotNull())
        total = with_key.select(F.sum(rows)).scalar()
        heavy = with_key.where(rows * pieces > total).select(KEY)
        known = self.index.where(self.has(other)).select(KEY)
        probe = df.withColumn(KEY, col(key).cast("string"))
        return mark_known(probe, known, [KEY], flag, pieces=pieces, heavy=heavy).drop(KEY)

    def outcomes(self, references: Mapping[str, Sequence[str]]) -> DataFrame:
        """Rows (table_name, passed_count, rejected_count): rows of a table that pass its own
        checks and whose key occurs in all its references, and the others."""
        sums, rows = [], []
        for table, others in references.items():
            i = self.tables.index(table)
            known = reduce(lambda a, b: a & b, [self.has(o) for o in others], F.lit(True))
            passed = F.sum(F.when(known, F.col(f"_ok{i}")).otherwise(0))
            sums += [
                F.coalesce(passed, F.lit(0)).alias(f"_p{i}"),
                F.coalesce(F.sum(f"_n{i}"), F.lit(0)).alias(f"_t{i}"),
            ]
            rows.append(
                F.struct(
                    F.lit(table).alias("table_name"),
                    F.col(f"_p{i}").alias("passed_count"),
                    (F.col(f"_t{i}") - F.col(f"_p{i}")).alias("rejected_count"),
                )
            )
        return self.index.agg(*sums).select(F.inline(F.array(*rows)))
