"""Layer writes: idempotent batch replace, first loads, publishing, snapshots (SNK-01..14).

A layer table is versioned (``versions``): its schema is kept beside the data, so partition
text keeps its type and a table without rows can be read, and a write is seen as a whole or
not at all. A write may read the table that it replaces.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldrow.operators import digest
from goldrow.operators.schema import (
    align,
    all_strings,
    col,
    json_complex_columns,
    require_column,
)
from goldrow.sinks import versions
from goldrow.sources.files import children, exists, read_text

# Spellings of a set full-load flag, and outcome words of a copy.
TRUE_WORDS = ("TRUE", "Y", "YES", "1")


def is_set(flag: object) -> bool:
    return str(flag).strip().upper() in TRUE_WORDS


def write_mode(target_exists: bool, load_type: str, full_load: object = False) -> str:
    """SNK-06: a missing target, an overwrite load or a full load overwrite; others append."""
    if not target_exists or load_type == "overwrite" or is_set(full_load):
        return "overwrite"
    return "append"


#: File with the schema of a table in the plain layout that versions replaced.
_SCHEMA = "_layer_schema"


def _is_plain(spark: SparkSession, path: str) -> bool:
    """Whether files lie in the folder itself, as others write them."""
    return any(n[0] not in "._" for n in children(spark, path))


def table_exists(spark: SparkSession, path: str) -> bool:
    return bool(versions.numbers(spark, path)) or _is_plain(spark, path)


def read_layer(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    version: int | None = None,
    within: Mapping[str, tuple] | None = None,
) -> DataFrame:
    """A layer table with the columns of all batches (SNK-07), or those of ``schema``.

    The newest version, or the one that is named; it stays the same whatever is written
    later. ``within`` keeps rows whose columns lie in ranges, and reads no batch that was
    written with these columns watched and holds none. A table that was written by others
    is read by its files' merged schemas.
    """
    held = versions.version(spark, path, version)
    if held is not None:
        return versions.read(spark, path, held, schema, within)
    text = read_text(spark, f"{path}/{_SCHEMA}")
    schema = schema or (T.StructType.fromJson(json.loads(text)) if text else None)
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    return reader.parquet(path)


def _write(df: DataFrame, path: str, partitions: Sequence[str], **options) -> int:
    """Make a new version; a table in the plain layout becomes its first version before."""
    spark = df.sparkSession
    if options["mode"] != "all" and not versions.numbers(spark, path) and _is_plain(spark, path):
        versions.write(read_layer(spark, path), path, partitions, mode="all")
    return versions.write(df, path, partitions, **options)


def write_table(
    df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = ("batch_id",)
) -> int:
    """SNK-01: append or overwrite; no rows leave an existing table as it is. Returns rows
    written."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unsupported write mode: {mode}")
    how = "all" if mode == "overwrite" else mode
    return _write(df, path, partition_by, mode=how, skip_empty=True)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ("batch_id",)) -> int:
    """Replace a table by ``df``, also by no rows. Returns rows written."""
    return _write(df, path, partition_by, mode="all")


def replace_batches(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = ("batch_id",),
    emptied: Iterable[Sequence[object]] = (),
    watch: Sequence[str] = (),
) -> int:
    """SNK-02 / SNK-03: replace the batches that occur in ``df``, keep all others.

    One new version of the table; until it is there, readers see the old rows. Running it
    again with the same rows changes nothing. A batch whose rows are all gone does not
    occur in ``df``: those that the write stands for are named in ``emptied``, and go if
    they have no rows. The ranges of ``watch`` are kept with each batch.
    """
    return _write(df, path, keys, mode="batches", emptied=emptied, watch=watch)


def load_raw(
    df: DataFrame,
    path: str,
    *,
    load_type: str,
    partition_by: Sequence[str] = ("Source_Name", "BATCH_ID"),
    emptied: Iterable[Sequence[object]] = (),
) -> int:
    """SNK-03..06: first load all text; later loads shaped like the target.

    Only a ``delta`` load replaces its own earlier batch of the same source, and drops
    the partitions named in ``emptied`` that it has no rows for.
    """
    spark = df.sparkSession
    if not table_exists(spark, path):
        return write_table(all_strings(df), path, "overwrite", partition_by)
    target = read_layer(spark, path).schema
    shaped = align(df, target)
    if load_type == "delta":
        return replace_batches(shaped, path, partition_by, emptied)
    return write_table(shaped, path, write_mode(True, load_type), partition_by)


def load_landing(
    df: DataFrame, path: str, *, full_load: object = False, batches: Iterable[object] = ()
) -> int:
    """LANDING write: full load overwrites, otherwise the input's batches are replaced.

    ``batches`` are the ids that the load stands for; those without rows are dropped.
    """
    spark = df.sparkSession
    if is_set(full_load) or not table_exists(spark, path):
        return write_table(df, path, "overwrite")
    shaped = align(df, read_layer(spark, path).schema)
    return replace_batches(shaped, path, emptied=[(b,) for b in batches])


def append_evolving(
    df: DataFrame, path: str, keys: Sequence[str] = ("batch_id",), batches: Iterable[object] = ()
) -> int:
    """SNK-07: batch replace whose new columns are added; older batches read null there.

    A column that got a wider number type is read in it from older batches too.
    ``batches`` as in ``load_landing``.
    """
    return replace_batches(df, path, keys, emptied=[(b,) for b in batches])


@dataclass(frozen=True)
class Reconciled:
    source_records: int
    written_records: int


def reconcile_write(df: DataFrame, path: str, batch_id: int, batch: str = "BATCH_ID") -> Reconciled:
    """SNK-14: replace the batch, read it again, fail unless it has the rows of ``df``.

    Number and content are compared, by a digest that does not depend on order. The source's
    digest is taken while it is written; tasks that ran again may have inflated it, so a
    difference is confirmed on the source before it counts as a failure. Callers move the
    ledger on only after this returns.
    """
    spark = df.sparkSession
    observed = Observation()
    hashed = df.observe(observed, *digest.sums(digest.row_hashes(df)))
    replace_batches(hashed, path, (batch,), emptied=[(batch_id,)])
    seen = observed.get
    table = read_layer(spark, path)
    own = table.where(col(require_column(table, batch)) == batch_id)
    written = digest.table_digest(digest.shaped_like(own, df)).first().asDict()
    if seen != written:
        seen = digest.table_digest(df).first().asDict()
    if seen != written:
        raise RuntimeError(
            f"reconciliation failed: source={seen['rows']}, written={written['rows']}"
            + (", unlike rows" if seen["rows"] == written["rows"] else "")
        )
    return Reconciled(seen["rows"], written["rows"])


_PUBLISH = "publish_id"


def _complete(spark: SparkSession, path: str) -> list[str]:
    """Publish ids whose write finished, oldest first."""
    names = [n for n in children(spark, path) if n.startswith(f"{_PUBLISH}=")]
    done = [n for n in names if exists(spark, f"{path}/{n}/_SUCCESS")]
    return sorted(n.split("=", 1)[1] for n in done)


def published_rows(spark: SparkSession, path: str) -> int:
    ids = _complete(spark, path)
    return spark.read.parquet(f"{path}/{_PUBLISH}={ids[-1]}").count() if ids else 0


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The latest finished publication."""
    ids = _complete(spark, path)
    if not ids:
        raise ValueError(f"nothing published at {path}")
    return spark.read.parquet(f"{path}/{_PUBLISH}={ids[-1]}")


def publish(df: DataFrame, path: str, publish_id: str) -> dict[str, int]:
    """SNK-08: full refresh. Readers see the old rows until the new ones are complete.

    Each publication is a directory of its own and counts once its success marker is
    there, so a failure leaves the previous one in force, on object stores too. A source
    without rows publishes an empty table; a changed schema needs no special case.
    Ids must sort by time.
    """
    spark = df.sparkSession
    deleted = published_rows(spark, path)
    seen = Observation()
    out = json_complex_columns(df).observe(seen, F.count(F.lit(1)).alias("rows"))
    out.write.mode("overwrite").parquet(f"{path}/{_PUBLISH}={publish_id}")
    rows = published_rows(spark, path)
    return {"source_rows": seen.get["rows"] or 0, "deleted_rows": deleted, "inserted_rows": rows}


def publish_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    """SNK-08 for a warehouse reached by JDBC: truncate and insert from the executors."""
    out = json_complex_columns(df)
    out.write.option("truncate", "true").jdbc(url, table, "overwrite", dict(properties))


PUBLISH_SCHEMA = (
    "table_name string, target_name string, source_rows long, deleted_rows long, "
    "inserted_rows long, error string"
)


def publish_all(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | None],
    names: Mapping[str, str],
    root: str,
    publish_id: str,
) -> DataFrame:
    """SNK-10: publish a table set; one result row per expected table.

    A missing source is an error row and does not stop the others.
    """
    rows = []
    for source, target in names.items():
        df = tables.get(source)
        if df is None:
            error = f"expected table does not exist: {source}"
            rows.append((source, target, None, None, None, error))
            continue
        try:
            done = publish(df, f"{root}/{target}", publish_id)
            rows.append((source, target, *done.values(), None))
        except Exception as error:  # noqa: BLE001 - reported per table
            rows.append((source, target, None, None, None, str(error).splitlines()[0]))
    return spark.createDataFrame(rows, PUBLISH_SCHEMA)


def publish_totals(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.when(F.col("error").isNull(), 1)).alias("tables_synced"),
        F.coalesce(F.sum("source_rows"), F.lit(0)).alias("total_rows"),
        F.count("error").alias("errors"),
    )


def snapshot(df: DataFrame, root: str, entity: str, day: date | datetime) -> str:
    """SNK-11: dated copy of a master; a second run on the day replaces the first."""
    if entity not in ("HCP", "HCO"):
        raise ValueError(f"entity must be HCP or HCO, got {entity!r}")
    path = f"{root}/{entity}_SNAPSHOT_{day:%Y%m%d}"
    replace_table(df, path, ())
    return path

