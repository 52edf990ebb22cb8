"""Reconciliation and profiling reports (AGG-06..21, JON-14, JON-15, JON-17)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrow.operators.schema import col, quoted
from goldrow.operators.skew import mark_known, spread_join


def _tagged(parts: Mapping[str, DataFrame], tag: str = "table_name") -> DataFrame:
    """SET-02: one frame of all parts, each under its name."""
    frames = [df.select(F.lit(name).alias(tag), "*") for name, df in parts.items()]
    return reduce(DataFrame.unionAll, frames)


def reject_rates(log: DataFrame) -> DataFrame:
    """AGG-06: share of rejected rows per rule, highest first."""
    total = F.nullif(F.col("passed_count") + F.col("rejected_count"), F.lit(0))
    rate = F.round(F.lit(100.0) * F.col("rejected_count") / total, 2)
    return log.withColumn("reject_pct", rate).orderBy(F.desc_nulls_last("reject_pct"), "rule_name")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """AGG-07: table_name, row_count; columnar files answer from their footers."""
    return _tagged({t: df.agg(F.count(F.lit(1)).alias("row_count")) for t, df in tables.items()})


def stored_counts(batches: Mapping[str, DataFrame]) -> DataFrame:
    """AGG-07 from the batch counts that versions of tables hold: no table is read."""
    total = F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count")
    return _tagged({t: df.agg(total) for t, df in batches.items()})


def emptiness(tables: Mapping[str, DataFrame]) -> DataFrame:
    """SRT-03: whether each table is empty; at most one row of each is read on."""
    probe = {t: df.select(F.lit(1).alias("_row")).limit(1) for t, df in tables.items()}
    return _tagged(
        {t: df.agg((F.count("_row") == 0).alias("is_empty")) for t, df in probe.items()}
    )


def layer_counts(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """AGG-07 for several layers: layer, table_name, row_count."""
    return _tagged({layer: table_counts(tables) for layer, tables in layers.items()}, "layer")


def entity_rollup(counts: DataFrame) -> DataFrame:
    """AGG-08: rows, tables with data and tables per entity family."""
    entity = F.when(F.upper(F.left("table_name", F.lit(3))) == "HCO", "HCO").otherwise("HCP")
    return counts.groupBy(entity.alias("entity_group")).agg(
        F.sum("row_count").alias("total_rows"),
        F.sum(F.when(F.col("row_count") > 0, 1).otherwise(0)).alias("tables_with_data"),
        F.count(F.lit(1)).alias("total_tables"),
    )


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AGG-09: per column total, non-null and null rows, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"), *[F.count(col(c)).alias(c) for c in columns]
    )
    return counts.unpivot("_total", list(columns), "column_name", "non_null").select(
        "column_name",
        F.col("_total").alias("total_rows"),
        "non_null",
        (F.col("_total") - F.col("non_null")).alias("nulls"),
    )


def extraction_completeness(views: Mapping[str, tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """AGG-10: per view the rows and the non-null values per field (column -> report name)."""

    def one(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
        found = lambda c: F.sum(F.when(col(c).isNotNull(), 1).otherwise(0))
        return df.agg(
            F.count(F.lit(1)).alias("total_rows"), *[found(c).alias(n) for c, n in fields.items()]
        )

    return _tagged({v: one(df, fields) for v, (df, fields) in views.items()}, "view_name")


def json_validity(tables: Mapping[str, DataFrame], column: str = "response_json") -> DataFrame:
    """AGG-11: valid and invalid documents; a null counts as invalid."""
    valid = F.try_parse_json(col(column)).isNotNull()

    def one(df: DataFrame) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count(F.when(valid, 1)).alias("valid_json_count"),
            F.count(F.when(~valid, 1)).alias("invalid_json_count"),
        )

    return _tagged({t: one(df) for t, df in tables.items()})


def distribution(df: DataFrame, *keys: Column | str) -> DataFrame:
    """AGG-12: rows per batch, source, lineage batch or load day."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("record_count"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], top: int | None = 10) -> DataFrame:
    """AGG-13: keys with more than one row, most frequent first; ``top`` None lists all."""
    names = [quoted(k) for k in keys]
    out = (
        df.groupBy(*names)
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
        .where("duplicate_count > 1")
    )
    return out.orderBy(F.desc("duplicate_count"), *names).limit(top) if top else out


def excess_rows(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """AGG-14: rows beyond one per distinct key, exactly.

    Rows are first counted per key, combined on the map side, so neither a frequent key
    nor many distinct ones meet in one task.
    """

    def one(df: DataFrame, key: str) -> DataFrame:
        per_key = df.groupBy(col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
        return per_key.agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"),
            F.count("_key").alias("distinct_keys"),
        ).withColumn("duplicate_count", F.col("total_rows") - F.col("distinct_keys"))

    return _tagged({t: one(df, key) for t, (df, key) in tables.items()})


def batch_sets(tables: Mapping[str, DataFrame], batch: str = "batch_id") -> DataFrame:
    """AGG-15: sorted batch ids per table; as many as the ledger has batches."""

    def one(df: DataFrame) -> DataFrame:
        ids = df.select(col(batch).alias("_id")).distinct()
        return ids.agg(F.sort_array(F.collect_list("_id")).alias("batch_ids"))

    return _tagged({t: one(df) for t, df in tables.items()})


def layer_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """AGG-16: counts of one entity in two layers and their difference."""
    l = left.select(F.col("table_name").alias("entity"), F.col("row_count").alias("source_rows"))
    r = right.select(F.col("table_name").alias("entity"), F.col("row_count").alias("view_rows"))
    return l.join(r, "entity").withColumn(
        "difference", F.col("source_rows") - F.col("view_rows")
    )


def anchor_check(flows: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """AGG-16: a mart may not have more rows than the view it is anchored on.

    A flow is the view and a one-row frame with the mart's ``row_count``.
    """
    staging = table_counts({f: pair[0] for f, pair in flows.items()})
    marts = _tagged({f: pair[1] for f, pair in flows.items()})
    both = staging.withColumnRenamed("row_count", "staging_rows").join(
        marts.withColumnRenamed("row_count", "marts_rows"), "table_name"
    )
    more = F.col("marts_rows") > F.col("staging_rows")
    # Status texts.
    status = F.when(more, "ERROR: marts has MORE rows than staging").otherwise("OK")
    return both.withColumnRenamed("table_name", "flow").withColumn("status", status)


def verify_copy(source: DataFrame, target: DataFrame) -> DataFrame:
    """AGG-17: target against source counts per table: PASS, MISMATCH, SKIP or ERROR."""
    s = source.select("table_name", F.col("row_count").alias("source_rows"))
    t = target.select("table_name", F.col("row_count").alias("target_rows"))
    status = (
        F.when(F.col("target_rows").isNull(), "ERROR")
        .when(F.col("source_rows").isNull(), "SKIP")
        .when(F.col("source_rows") == F.col("target_rows"), "PASS")
        .otherwise("MISMATCH")
    )
    return s.join(t, "table_name", "full").withColumn("status", status)


def copy_totals(verified: DataFrame) -> DataFrame:
    is_status = lambda s: F.count(F.when(F.col("status") == s, 1))
    return verified.agg(
        F.count(F.lit(1)).alias("tables_checked"),
        F.coalesce(F.sum("target_rows"), F.lit(0)).alias("total_rows"),
        is_status("ERROR").alias("errors"),
        is_status("MISMATCH").alias("mismatches"),
    )


def assert_copied(verified: DataFrame) -> None:
    row = copy_totals(verified).first()
    if row["errors"] or row["mismatches"]:
        raise RuntimeError(
            f"copy verification failed: {row['errors']} errors, {row['mismatches']} mismatches"
        )


def not_null_tests(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """AGG-18: rows whose key is null, per table, with PASS or FAIL.

    The condition is a filter, so it reaches the scans, and in a consolidation its anchor.
    """
    parts = {
        t: df.where(col(key).isNull()).agg(F.count(F.lit(1)).alias("failures"))
        for t, (df, key) in tables.items()
    }
    status = F.when(F.col("failures") == 0, "PASS").otherwise("FAIL")
    return _tagged(parts).withColumn("status", status)


def column_catalog(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns of tables as rows: table_name, column_name, data_type, ordinal_position, and
    filled_rows, the rows that have a value there. Each table is read once."""

    def one(df: DataFrame) -> DataFrame:
        filled = df.agg(*[F.count(col(f.name)).alias(f"_{i}") for i, f in enumerate(df.schema)])
        rows = [
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(i + 1).alias("ordinal_position"),
                F.col(f"_{i}").alias("filled_rows"),
            )
            for i, f in enumerate(df.schema)
        ]
        return filled.select(F.inline(F.array(*rows)))

    return _tagged({t: one(df) for t, df in tables.items()})


def tables_with_column(columns: DataFrame, name: str) -> DataFrame:
    """AGG-19: tables having a column like ``name``, in any case."""
    return columns.where(F.contains(F.lower("column_name"), F.lit(name.lower())))


def column_counts(columns: DataFrame, expected: Mapping[str, int] | None = None) -> DataFrame:
    """AGG-19: columns per table, how many of them hold a value in any row, and PASS or
    MISMATCH of the columns against expected numbers."""
    out = columns.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("column_count"),
        F.count_if(F.col("filled_rows") > 0).alias("filled_columns"),
    )
    if expected is None:
        return out
    want = columns.sparkSession.createDataFrame(
        list(expected.items()), "table_name string, expected_count long"
    )
    same = F.coalesce(F.col("column_count"), F.lit(0)) == F.col("expected_count")
    return want.join(out, "table_name", "left").withColumn(
        "status", F.when(same, "PASS").otherwise("MISMATCH")
    )


def count_status(counts: DataFrame) -> DataFrame:
    """AGG-20: unexpected row counts per layer and table."""
    # Layers, the table that may be empty, status texts.
    status = (
        F.when(
            (F.col("layer") == "STAGING")
            & (F.col("row_count") == 0)
            & (F.col("table_name") != "HCP_NAME"),
            "WARNING: 0 rows in STAGING table",
        )
        .when(
            F.col("layer").isin("MASTER", "MDM") & (F.col("row_count") > 0),
            "WARNING: unexpected data in placeholder table",
        )
        .otherwise("OK")
    )
    return counts.withColumn("status", status)


def layer_summary(counts: DataFrame) -> DataFrame:
    """AGG-20: tables and rows per layer."""
    return counts.groupBy("layer").agg(
        F.count(F.lit(1)).alias("table_count"), F.sum("row_count").alias("total_rows")
    )


def stuck_batches(ledger: DataFrame, now: Column, hours: int = 6) -> DataFrame:
    """AGG-21: ingested, not egressed, started more than ``hours`` ago.

    An egress status that is still null counts as not egressed.
    """
    old = F.col("batch_start_time") < now - F.expr(f"INTERVAL {int(hours)} HOURS")
    open_ = F.coalesce("egress_status", F.lit("N")) != "Y"
    return ledger.where((F.col("raw_ingestion_status") == "Y") & open_ & old).orderBy(
        "batch_start_time", "batch_id"
    )


def missing_keys(left: DataFrame, right: DataFrame, key: str, **options) -> DataFrame:
    """JON-14: rows of ``left`` whose key is not in ``right``; a null key is not."""
    marked = mark_known(left, right, [key], "_known", **options)
    return marked.where(~F.col("_known")).select(*left.columns)


def key_overlap(pairs: Mapping[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """JON-15: distinct keys left, right and shared; one shuffle of the keys per pair."""

    def one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
        sides = left.select(col(key).alias("_k"), F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        sides = sides.unionAll(right.select(col(key), F.lit(0), F.lit(1)))
        per_key = (
            sides.where(F.col("_k").isNotNull())
            .groupBy("_k")
            .agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
        )
        return per_key.agg(
            F.count(F.when(F.col("_l") == 1, 1)).alias("left_keys"),
            F.count(F.when(F.col("_r") == 1, 1)).alias("right_keys"),
            F.count(F.when((F.col("_l") == 1) & (F.col("_r") == 1), 1)).alias("shared_keys"),
        )

    return _tagged({name: one(*pair) for name, pair in pairs.items()}, "comparison")


def side_by_side(
    raw: DataFrame,
    view: DataFrame,
    key: str = "iqvia_id",
    view_key: str = "SOURCE_FK",
    preview: int = 500,
    *,
    pieces: int | None = None,
) -> DataFrame:
    """JON-17: each document's beginning next to the values extracted from it."""
    left = raw.select(key, F.left("response_json", F.lit(preview)).alias("raw_json_preview"))
    right = view.select(
        F.col(view_key).alias(key), *[col(c) for c in view.columns if c != view_key]
    )
    return spread_join(
        left, right, [key], "left", pieces=pieces
    )

