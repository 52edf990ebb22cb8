"""Sources: files, tables and JSON document feeds (SRC-01..09)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldrow.operators.schema import col, union_filled
from goldrow.sources.files import children, exists

# Timestamp token in a file name template, and recognised suffixes in
# the order they are tried per file.
NAME_TOKEN = "YYYYMMDDHHMMSS"
SUFFIXES = ("csv", "txt", "parquet", "orc", "json")

#: Session setting naming the lakehouse format; without it, such a table is an error.
LAKEHOUSE_SETTING = "goldrow.lakehouse.format"


def read_file(
    spark: SparkSession, path: str, fmt: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Scan files. ``txt`` is delimited text; parquet, orc and table formats take no options."""
    reader = spark.read
    if fmt in ("csv", "txt"):
        return reader.options(**(options or {})).csv(path)
    if fmt == "json":
        return reader.options(**(options or {})).json(path)
    if fmt == "parquet":
        return reader.parquet(path)
    if fmt == "orc":
        return reader.orc(path)
    if fmt == "delta":
        configured = spark.conf.get(LAKEHOUSE_SETTING, None)
        if configured is None:
            # Its files alone also hold removed and replaced rows.
            raise ValueError(f"{path} has a table log; name its format in {LAKEHOUSE_SETTING}")
        return reader.format(configured).load(path)
    raise ValueError(f"unsupported file format: {fmt}")


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.read.table(f"{database}.{table}")


def read_documents(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """SRC-07: landed JSON documents as text rows.

    A document that is a list gives its items, one with a list under ``data`` gives
    those, any other is one row. Every value becomes text, null stays null, and nested
    values become JSON text. A file is one document, or with ``per_line`` one per line.
    """
    multi = "false" if per_line else "true"
    raw = spark.read.options(multiLine=multi, primitivesAsString="true").json(path)
    parts = [raw]
    data = next((f.dataType for f in raw.schema if f.name == "data"), None)
    if isinstance(data, T.ArrayType) and isinstance(data.elementType, T.StructType):
        items = raw.where(F.col("data").isNotNull()).select(F.inline("data"))
        single = raw.where(F.col("data").isNull()).drop("data")
        parts = [items, single] if single.columns else [items]

    def text(df: DataFrame) -> DataFrame:
        nested = (T.StructType, T.ArrayType, T.MapType)
        return df.select(
            *[
                (F.to_json(col(f.name)) if isinstance(f.dataType, nested) else col(f.name))
                .cast("string")
                .alias(f.name)
                for f in df.schema
            ]
        )

    return union_filled([text(p) for p in parts])


def read_records(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """SRC-07 without a look at the files beforehand: rows (file, position, record).

    ``record`` is a variant, so documents of any shape pass in one scan; a file of one
    document per line is split by its bytes. A document that is a list gives its items, one
    with a list of objects under ``data`` gives those, any other is one record, also one
    whose ``data`` is null. What is no JSON is a null record; a list without items is none.
    """
    lines = spark.read.text(path, wholetext=not per_line)
    parsed = lines.select(
        F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("_document")
    )
    whole = F.try_variant_get("_document", "$", "array<variant>")
    data = F.try_variant_get("_document", "$.data", "array<variant>")
    objects = F.exists(data, lambda x: F.schema_of_variant(x).startswith("OBJECT"))
    records = F.coalesce(whole, F.when(objects, data), F.array("_document"))
    # The outer form, because the filter inferred for a plain explode would parse twice.
    out = parsed.select("file", F.posexplode_outer(records).alias("position", "record"))
    return out.where("position IS NOT NULL")


def record_text(records: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keys of records as text columns beside the others: nested values become JSON text,
    a null or absent key is null."""
    others = [c for c in records.columns if c != "record"]
    # A path has no escapes; a name may hold one kind of quote.
    quoted = lambda n: f'["{n}"]' if "'" in n else f"['{n}']"
    values = [F.try_variant_get("record", f"${quoted(n)}", "string").alias(n) for n in names]
    return records.select(*[col(c) for c in others], *values)


def newest_file(spark: SparkSession, folder: str, template: str) -> str | None:
    """SRC-08: path of the file a template stands for.

    With the timestamp token in it the lexicographically greatest match wins; without
    the name must match exactly. Only the directory is listed, no file is opened.
    """
    names = children(spark, folder)
    if NAME_TOKEN in template:
        prefix, suffix = template.split(NAME_TOKEN, 1)
        names = [n for n in names if n.startswith(prefix) and n.endswith(suffix)]
    else:
        names = [n for n in names if n == template]
    return f"{folder.rstrip('/')}/{max(names)}" if names else None


def detect_format(spark: SparkSession, path: str, template: str) -> str:
    """Lakehouse table, else the first recognised child's suffix, else the name's own."""
    if exists(spark, f"{path}/_delta_log"):
        return "delta"
    for name in children(spark, path):
        for suffix in SUFFIXES:
            if name.endswith(f".{suffix}"):
                return suffix
    own = template.rsplit(".", 1)[-1].lower() if "." in template else ""
    if not own:
        raise ValueError(f"cannot tell the file format of {path}")
    return own


@dataclass(frozen=True)
class SourceSpec:
    """One configured source: ``file``, any kind ending in ``table``, or ``documents``."""

    kind: str
    path: str
    template: str = ""
    options: Mapping[str, str] = field(default_factory=dict)


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame | None:
    """SRC-09: read whatever the spec names; None if its template matches no file."""
    if spec.kind.endswith("table"):
        return read_table(spark, spec.path, spec.template)
    if spec.kind == "documents":
        return read_documents(spark, spec.path)
    if spec.kind != "file":
        raise ValueError(f"unsupported source kind: {spec.kind}")
    path = newest_file(spark, spec.path, spec.template) if spec.template else spec.path
    if path is None:
        return None
    return read_file(spark, path, detect_format(spark, path, spec.template), spec.options)
