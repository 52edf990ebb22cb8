"""Data-quality gate: rules that split a table into passed and rejected rows.

All rules of a table are evaluated in one plan. Each reference lookup adds one hit
flag, the first failing rule is one expression, and both halves, the outcome log and
the reject trail derive from that flagged frame (JON-01..10, AGG-04, AGG-05, LOG-02).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrow.functions.predicates import non_blank
from goldrow.operators.membership import Member, Membership
from goldrow.operators.schema import col, find_column, require_column, union_filled
from goldrow.operators.skew import mark_known
from goldrow.plans.catalog import DQ_COLUMNS, PARENT_KEY_CANDIDATES, REFERENCE_TABLE, rules_for
from goldrow.plans.specs import DQRule
from goldrow.session import write_through

_FAILED = "_dq_failed"


def parent_key(parent: DataFrame) -> str:
    """First existing parent key column."""
    for candidate in PARENT_KEY_CANDIDATES:
        found = find_column(parent, candidate)
        if found:
            return found
    raise ValueError(f"no parent key column; available: {parent.columns}")


@dataclass
class _Lookups:
    """Adds hit flags to a frame, one join per distinct (own column, reference column)."""

    df: DataFrame
    reference: DataFrame | None
    options: dict = field(default_factory=dict)
    #: Membership index, and the names of the own and the reference table in it.
    index: tuple[Membership, str, str] | None = None
    flags: dict[tuple[str, str], str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.source = self.df

    def hit(self, own: str, reference_column: str) -> Column:
        flag = self.flags.get((own, reference_column))
        if flag is None:
            flag = f"_dq_hit_{len(self.flags)}"
            self.flags[own, reference_column] = flag
            if self.index is not None:
                index, table, other = self.index
                self.df = index.mark(self.df, table, own, other, flag, **self.options)
                return F.col(flag)
            key = col(reference_column)
            keys = self.reference.where(non_blank(key)).select(key.alias("_dq_key"))
            probe = self.df.withColumn("_dq_key", col(own))
            # Lookups keep the number of rows, so heavy keys are counted on the input.
            source = self.source.select(col(own).alias("_dq_key"))
            self.df = mark_known(
                probe, keys, ["_dq_key"], flag, left_source=source, **self.options
            ).drop("_dq_key")
        return F.col(flag)


RuleBuilder = Callable[[_Lookups, str], Column]


def _null_check(lookups: _Lookups, column: str) -> Column:
    return non_blank(col(column))


def _completeness(lookups: _Lookups, column: str) -> Column:
    return lookups.hit(column, require_column(lookups.reference, column))


def _parent_check(lookups: _Lookups, column: str) -> Column:
    return non_blank(col(column)) & lookups.hit(column, parent_key(lookups.reference))


#: Rule name -> builder of its "row passes" condition.
RULES: dict[str, RuleBuilder] = {
    "null_check": _null_check,
    "name_address_completeness_check": _completeness,
    "address_mdr_check": _parent_check,
    "mdr_check": _parent_check,
    "affiliation_mdr_check": _parent_check,
    "hierarchy_mdr_check": _parent_check,
}


@dataclass(frozen=True)
class DQResult:
    """Outcome of a rule chain. ``flagged`` holds every input row once.

    Each property and report is lazy and evaluates ``flagged``; where several are used on
    a large table, call ``written`` first so that the rules run once.
    """

    flagged: DataFrame
    rules: tuple[DQRule, ...]
    columns: tuple[str, ...]
    processed_at: Column

    def written(self) -> DQResult:
        """The same outcome read from a table written once to the shared folder."""
        return replace(self, flagged=write_through(self.flagged, "dq"))

    def _stamped(self, rows: DataFrame, status: str, rule: Column) -> DataFrame:
        def lookup(attribute: str) -> Column:
            values = F.array(*[F.lit(getattr(r, attribute)) for r in self.rules])
            return F.element_at(values, rule)

        own = [c for c in self.columns if c not in DQ_COLUMNS]
        return rows.select(
            *[col(c) for c in own],
            lookup("rule").alias("DQ_RULE"),
            F.lit(status).alias("DQ_STATUS"),
            lookup("description").alias("DQ_DESCRIPTION"),
            lookup("column").alias("DQ_APPL_COLUMN"),
            self.processed_at.alias("DQ_PROCESSED_AT"),
        )

    @property
    def passed(self) -> DataFrame:
        """Rows that survive every rule, stamped with the last one."""
        survivors = self.flagged.where(F.col(_FAILED).isNull())
        return self._stamped(survivors, "PASS", F.lit(len(self.rules)))

    @property
    def rejected(self) -> DataFrame:
        """Rows stamped with the first rule they fail."""
        return self._stamped(
            self.flagged.where(F.col(_FAILED).isNotNull()), "REJECT", F.col(_FAILED)
        )

    @property
    def staged(self) -> DataFrame:
        """SNK-13: passed rows without the gate's own columns."""
        return self.passed.drop(*DQ_COLUMNS)

    def rule_counts(self) -> DataFrame:
        """Rejected rows per rule, zero included; one pass over the flagged rows.

        Keyed by the rule's position, so two rules of one kind on a table stay apart.
        """
        counts = (
            self.flagged.where(F.col(_FAILED).isNotNull())
            .groupBy(_FAILED)
            .agg(F.count(F.lit(1)).alias("record_count"))
        )
        spark = self.flagged.sparkSession
        listed = spark.createDataFrame(
            [(i, r.rule, r.column, r.description) for i, r in enumerate(self.rules, 1)],
            f"{_FAILED} int, rule_name string, column_name string, rule_description string",
        )
        return (
            listed.join(counts, _FAILED, "left")
            .withColumn("record_count", F.coalesce("record_count", F.lit(0)))
            .withColumnRenamed(_FAILED, "execution_order")
        )

    def rule_outcomes(self) -> DataFrame:
        """Rows passing and failing each rule among those that reached it.

        One aggregation: a row reached rule k if it failed no earlier one.
        """
        failed = F.col(_FAILED)
        counts = [
            c
            for i in range(1, len(self.rules) + 1)
            for c in (
                F.count(F.when(failed.isNull() | (failed > i), 1)).alias(f"p{i}"),
                F.count(F.when(failed == i, 1)).alias(f"r{i}"),
            )
        ]
        rows = F.array(
            *[
                F.struct(
                    F.lit(i).alias("execution_order"),
                    F.lit(r.rule).alias("rule_name"),
                    F.lit(r.column).alias("column_name"),
                    F.col(f"p{i}").alias("passed_count"),
                    F.col(f"r{i}").alias("rejected_count"),
                )
                for i, r in enumerate(self.rules, 1)
            ]
        )
        return self.flagged.agg(*counts).select(F.inline(rows))

    def totals(self) -> DataFrame:
        """AGG-05: passed and rejected rows."""
        return self.flagged.agg(
            F.count(F.when(F.col(_FAILED).isNull(), 1)).alias("passed_count"),
            F.count(_FAILED).alias("rejected_count"),
        )


def run_chain(
    df: DataFrame,
    rules: Sequence[DQRule],
    reference: DataFrame | None = None,
    *,
    processed_at: Column | None = None,
    pieces: int | None = None,
    index: tuple[Membership, str, str] | None = None,
) -> DQResult:
    """JON-07: rows surviving rule k meet rule k+1; a reject carries its first failure.

    ``index`` is a membership index that has the keys of the table and its reference, and
    their names there; lookups read it instead of the reference.
    """
    if not rules:
        raise ValueError("no active rule for this table")
    lookups = _Lookups(df, reference, {"pieces": pieces}, index)
    failures = []
    for position, rule in enumerate(rules, 1):
        builder = RULES.get(rule.rule.strip().lower())
        if builder is None:
            raise ValueError(f"unsupported rule: {rule.rule}")
        if reference is None and builder is not _null_check:
            raise ValueError(f"{rule.rule} needs a reference table")
        passes = builder(lookups, require_column(df, rule.column))
        failures.append(F.when(~passes, F.lit(position)))
    flagged = lookups.df.withColumn(_FAILED, F.coalesce(*failures)).drop(*lookups.flags.values())
    if processed_at is None:
        processed_at = F.current_timestamp()
    return DQResult(flagged, tuple(rules), tuple(df.columns), processed_at)


def split(
    df: DataFrame, rule: str, column: str, reference: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """JON-01..06: one rule; (passed, rejected), both with the input's columns."""
    result = run_chain(df, [DQRule("", rule, "", column, "")], reference)
    return result.staged, result.rejected.drop(*DQ_COLUMNS)


# Columns the rule table must have.
RULE_COLUMNS = (
    "source_identifier",
    "source_system_name",
    "table_name",
    "column_name",
    "rule_name",
    "rule_type",
    "rule_expression",
    "rule_description",
    "rule_status",
    "active_flag",
    "execution_order",
)


def configured_rules(
    config: DataFrame, source_identifier: str, source_system: str | None = None
) -> list[DQRule]:
    """Active rules of a source from the rule table, by execution order."""
    missing = sorted(c for c in RULE_COLUMNS if find_column(config, c) is None)
    if missing:
        raise ValueError(f"rule table lacks columns: {missing}")
    same = lambda c, v: F.upper(F.trim(F.col(c))) == v.strip().upper()
    wanted = (
        same("source_identifier", source_identifier)
        & same("rule_status", "ACTIVE")
        & F.coalesce(F.col("active_flag"), F.lit(False))
    )
    if source_system is not None:
        wanted = wanted & same("source_system_name", source_system)
    rows = config.where(wanted).orderBy("execution_order", "column_name").collect()
    return [
        DQRule(
            r["table_name"],
            r["rule_type"],
            r["rule_description"]
            or r["rule_expression"]
            or f"DQ rule: {r['rule_name'] or r['rule_type']}",
            r["column_name"],
            r["table_name"],
        )
        for r in rows
    ]


def resolve_rules(
    table: str,
    config: DataFrame | None = None,
    source_identifier: str | None = None,
    source_system: str | None = None,
) -> list[DQRule]:
    """JON-08: configured rules win over the catalogue."""
    if config is not None and source_identifier:
        found = configured_rules(config, source_identifier, source_system)
        if found:
            return found
    return list(rules_for(table))


def outcome_log(
    result: DQResult,
    *,
    run_id: str,
    batch_id: int | Column | None,
    source_identifier: str,
    source_system: str | None,
    table: str,
    started: Column,
    ended: Column,
) -> DataFrame:
    """AGG-04 / LOG-02: one row per rule; PASS iff nothing was rejected by it."""
    clean = F.col("record_count") == 0
    return result.rule_counts().select(
        F.lit(run_id).alias("run_id"),
        F.lit(batch_id).cast("long").alias("batch_id"),
        F.lit(source_identifier).alias("source_identifier"),
        F.lit(source_system).cast("string").alias("source_system_name"),
        F.lit(table).alias("table_name"),
        "rule_name",
        F.when(clean, "PASS").otherwise("FAIL").alias("rule_status"),
        F.when(~clean, F.col("rule_description")).alias("error_description"),
        F.col("record_count").cast("long"),
        started.alias("start_time"),
        ended.alias("end_time"),
    )


def reject_trail(
    result: DQResult,
    *,
    run_id: str,
    batch_id: int | Column | None,
    source_system: str | None,
    table: str,
    rejected_at: Column,
) -> DataFrame:
    """JON-10: one audit row per rejected row."""
    rejected = result.rejected
    key = next((k for k in ("iqvia_id", "individualEid") if k in rejected.columns), None)
    return rejected.select(
        F.lit(run_id).alias("run_id"),
        F.lit(batch_id).cast("long").alias("batch_id"),
        F.lit(source_system).cast("string").alias("source_system_name"),
        F.lit(table).alias("table_name"),
        (F.col(key) if key else F.lit(None)).cast("string").alias("record_key"),
        F.col("DQ_RULE").alias("rule_name"),
        F.col("DQ_DESCRIPTION").alias("error_description"),
        rejected_at.alias("rejected_at"),
    )


#: Rules that look a key up in the reference table.
_LOOKUP_RULES = tuple(name for name, builder in RULES.items() if builder is not _null_check)


def _families(tables: Mapping[str, DataFrame]) -> tuple[list[list[str]], list[str]]:
    """Checked tables that are there with their reference, by connected references; and the
    tables skipped because they or their reference are missing."""
    families: list[list[str]] = []
    skipped = []
    for table, reference in REFERENCE_TABLE.items():
        if table not in tables or reference not in tables:
            skipped.append(table)
            continue
        joined = [f for f in families if table in f or reference in f]
        families = [f for f in families if f not in joined]
        families.append(list(dict.fromkeys([*[t for f in joined for t in f], table, reference])))
    return families, skipped


def _own_key(df: DataFrame, table: str) -> str:
    """The one column by which a table's rules look up and others look it up."""
    own = {require_column(df, r.column) for r in rules_for(table) if r.rule in _LOOKUP_RULES}
    own.add(parent_key(df))
    if len(own) > 1:
        raise ValueError(f"{table} is checked by several keys: {sorted(own)}")
    return own.pop()


def memberships(tables: Mapping[str, DataFrame]) -> tuple[list[Membership], list[str]]:
    """One membership index per family of checked tables, and the skipped tables."""
    families, skipped = _families(tables)
    found = []
    for family in families:
        members = {}
        for table in family:
            df = tables[table]
            checks = [
                non_blank(col(require_column(df, r.column)))
                for r in rules_for(table)
                if r.rule not in _LOOKUP_RULES
            ]
            passes = reduce(lambda a, b: a & b, checks, F.lit(True))
            members[table] = Member(df, _own_key(df, table), passes)
        found.append(Membership.of(members))
    return found, skipped


def sweep(
    tables: Mapping[str, DataFrame], *, processed_at: Column | None = None
) -> tuple[dict[str, DQResult], list[str]]:
    """JON-09: run every checked table against its reference table.

    Returns the results and the tables skipped because they or their reference are
    missing. The families' membership indexes are written once, and every lookup reads
    its bit there; the results are lazy. For counts alone, ``sweep_summary`` is cheaper.
    """
    found, skipped = memberships(tables)
    stored = {t: index for index in [m.written() for m in found] for t in index.tables}
    results = {
        table: run_chain(
            tables[table],
            rules_for(table),
            tables[reference],
            processed_at=processed_at,
            index=(stored[table], table, reference),
        )
        for table, reference in REFERENCE_TABLE.items()
        if table in stored and table not in skipped
    }
    return results, skipped


def sweep_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Passed and rejected rows of every swept table as one frame.

    Each table is read once, each family is shuffled once by its key, and nothing is joined.
    """
    found, skipped = memberships(tables)
    return union_filled(
        [
            m.outcomes(
                {
                    t: [REFERENCE_TABLE[t]] if any(r.rule in _LOOKUP_RULES for r in rules_for(t)) else []
                    for t in m.tables
                    if t in REFERENCE_TABLE and t not in skipped
                }
            )
            for m in found
        ]
    )


def choose_batch(df: DataFrame, batch_id: int | None = None) -> DataFrame:
    """PRJ-21: one batch, the given or the latest; without a batch column all rows.

    The latest id is a scalar subquery: it reaches the scan as a pushed filter and
    prunes partitions, with no trip to the driver. The comparison is null-safe because
    the latest id is null only if every id is, and then all rows are wanted.
    """
    column = find_column(df, "BATCH_ID")
    if column is None:
        return df
    if batch_id is not None:
        return df.where(col(column) == F.lit(batch_id))
    return df.where(col(column).eqNullSafe(df.select(F.max(col(column))).scalar()))
