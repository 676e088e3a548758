"""Catalog registration, partition refresh, listing snapshots, schema merge and the missing-partition check."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplake.functions.tables import constant_table, sql_literal
from shoplake.operators.etl import KEPT, OUTCOME_PARTITIONS
from shoplake.schema import CURATED_COLUMNS, RAW_SCHEMA


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def register_table(spark: SparkSession, name: str, path: str, schema: T.StructType,
                   partition_cols: Sequence[str], fmt: str = "parquet") -> None:
    """Create an external partitioned table over ``path`` (no data is read or moved)."""
    fields = list(schema.fields)
    names = {f.name for f in fields}
    fields += [T.StructField(p, T.StringType()) for p in partition_cols if p not in names]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(T.StructType(fields))}) USING {fmt} "
              f"PARTITIONED BY ({', '.join(partition_cols)}) LOCATION '{path}'")


def refresh_table(spark: SparkSession, name: str, path: str, schema: T.StructType, partition_cols: Sequence[str],
                  fmt: str = "parquet", below: Sequence[str] = ()) -> DataFrame:
    """A10: register the table if needed, add by name the partitions that storage has and the catalog lacks; list
    all partitions. ``below`` names the folders to list (``year=2026/month=09``) where only they can have changed."""
    register_table(spark, name, path, schema, partition_cols, fmt)
    found = storage_partitions(spark, path, partition_cols, below).select("partition")
    add_partitions(spark, name, found.join(catalog_partitions(spark, name), "partition", "left_anti"))
    return catalog_partitions(spark, name)


def _spec(partition: str) -> str:
    pairs = (p.split("=", 1) for p in partition.split("/"))
    return "PARTITION (" + ", ".join(f"`{k}` = {sql_literal(unquote(v))}" for k, v in pairs) + ")"


def add_partitions(spark: SparkSession, name: str, partitions: DataFrame, at_once: int = 200) -> int:
    """Add partitions (column ``partition``, ``k=v/k=v``) by name; how many. Only new names come to the driver, which
    has to write them into the catalog anyway."""
    specs = [_spec(r["partition"]) for r in partitions.select("partition").distinct().toLocalIterator()]
    for at in range(0, len(specs), at_once):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs[at:at + at_once])}")
    return len(specs)


# --- listing snapshots (A10, J8) -----------------------------------------------------------------------

def snapshot_partitions(spark: SparkSession, path: str, partition_cols: Sequence[str], below: Sequence[str] = ()) -> DataFrame:
    """partition, files, bytes, newest (modification time) of every partition on storage, from the listing alone."""
    label = [F.concat(F.lit(f"{p}="), F.regexp_extract("path", f"/{p}=([^/]*)/", 1)) for p in partition_cols]
    files = _listing(spark, path, below).where(F.regexp_extract("path", f"/{partition_cols[0]}=([^/]*)/", 1) != F.lit(""))
    return files.groupBy(F.concat_ws("/", *label).alias("partition")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("newest"))


def partition_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """partition, change (added, vanished or changed) between two snapshots; partitions that stayed are not listed."""
    values = ("files", "bytes", "newest")
    old = before.select("partition", F.struct(*values).alias("old"))
    new = after.select("partition", F.struct(*values).alias("new"))
    change = (F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "vanished")
              .when(F.col("old") != F.col("new"), "changed"))
    return (old.join(new, "partition", "full").select("partition", change.alias("change"))
            .where(F.col("change").isNotNull()))


def refresh_from_snapshots(spark: SparkSession, name: str, path: str, partition_cols: Sequence[str], snapshots: str) -> DataFrame:
    """Compare storage with the last stored snapshot, register what was added, store the new snapshot; the changes.

    Snapshots are written as ``snapshots/version=N``; the first refresh finds everything added. Vanished
    partitions are reported and stay registered, and the catalog is changed before the snapshot is stored, so
    an interrupted refresh finds the same changes again.
    """
    versions = spark.read.schema("partition string, files long, bytes long, newest timestamp, version int")
    try:
        known = versions.parquet(snapshots)
        last = known.agg(F.max("version")).first()[0]
    except AnalysisException as e:  # nothing stored yet
        if "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        known, last = None, None
    current = f"{snapshots}/version={0 if last is None else last + 1}"
    staged = f"{snapshots}/_staged"
    snapshot_partitions(spark, path, partition_cols).write.mode("overwrite").parquet(staged)
    after = versions.parquet(staged)
    before = after.limit(0) if known is None else known.where(F.col("version") == last)
    changes = partition_changes(before, after)
    add_partitions(spark, name, changes.where("change = 'added'"))
    after.drop("version").write.mode("overwrite").parquet(current)
    before = after.limit(0) if last is None else versions.parquet(snapshots).where(F.col("version") == last)
    now = versions.parquet(snapshots).where(F.col("version") == (0 if last is None else last + 1))
    return partition_changes(before, now)


# --- schema merge (A10) ----------------------------------------------------------------------------------

def discover_schema(lines: DataFrame, value: str = "value") -> DataFrame:
    """key, data_type, rows: the keys of the JSON objects in ``lines``, their merged type and the lines that have them.

    Types are merged by Spark's partial aggregate over parsed lines, so one row per task is shuffled; lines
    that are no JSON objects are left out. Decimals become doubles; a key without any value, or
    with values of types that don't go together, is text.
    """
    spark = lines.sparkSession
    parsed = lines.select(F.try_parse_json(value).alias("v"), F.col(value).alias("line"))
    parsed = parsed.where(F.schema_of_variant("v").startswith("OBJECT"))
    merged = parsed.agg(F.schema_of_variant_agg("v")).first()[0] or "OBJECT<>"
    if not merged.startswith("OBJECT<") or merged == "OBJECT<>":
        return constant_table(spark, [], [("key", "string"), ("data_type", "string"), ("rows", "bigint")])
    fields = T._parse_datatype_string(merged.replace("OBJECT<", "STRUCT<")).fields
    types = constant_table(spark, [(f.name, _column_type(f.dataType)) for f in fields], [("key", "string"), ("data_type", "string")])
    rows = parsed.select(F.explode(F.json_object_keys("line")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    return types.join(rows, "key").select("key", "data_type", "rows")


def _column_type(found: T.DataType) -> str:
    if isinstance(found, T.DecimalType):
        return "double"
    if isinstance(found, (T.NullType, T.VariantType)):
        return "string"
    return found.simpleString()


# Types that a wider one can hold.
_WIDER = {("int", "bigint"): "bigint", ("int", "double"): "double", ("bigint", "double"): "double", ("float", "double"): "double"}


def widened(known: str, found: str) -> str:
    """The type that holds the values of both: the same, a wider number, or text. A text column stays one."""
    if known == found or known == "string":
        return known
    return _WIDER.get((known, found)) or _WIDER.get((found, known)) or "string"


def merge_schema(spark: SparkSession, name: str, path: str, partition_cols: Sequence[str], discovered: DataFrame,
                 fmt: str = "json") -> DataFrame:
    """column_name, data_type, change (kept, added, widened), rows: the table's columns brought up to the discovered keys.

    New keys are appended by ALTER TABLE. A column whose type has to grow makes the external table be
    registered anew with its partitions (its files are not touched). Columns that no line has any more stay.
    """
    known = {f.name: f.dataType.simpleString() for f in spark.table(name).schema.fields if f.name not in partition_cols}
    found = {r["key"]: r for r in discovered.collect() if r["key"] not in partition_cols}  # as many as there are keys
    merged = {c: widened(t, found[c]["data_type"]) if c in found else t for c, t in known.items()}
    new = {k: r["data_type"] for k, r in sorted(found.items()) if k not in known}
    if merged != known:
        partitions = catalog_partitions(spark, name).collect()
        spark.sql(f"DROP TABLE {name}")  # external: only the registration
        fields = [T.StructField(c, T._parse_datatype_string(t)) for c, t in {**merged, **new}.items()]
        register_table(spark, name, path, T.StructType(fields), partition_cols, fmt)
        if partitions:
            add_partitions(spark, name, spark.createDataFrame(partitions, "partition string"))
    else:
        add_columns(spark, name, [T.StructField(c, T._parse_datatype_string(t)) for c, t in new.items()])
    rows = [(c, t, "kept" if known[c] == t else "widened", found[c]["rows"] if c in found else 0) for c, t in merged.items()]
    rows += [(c, t, "added", found[c]["rows"]) for c, t in new.items()]
    return constant_table(spark, rows, [("column_name", "string"), ("data_type", "string"), ("change", "string"), ("rows", "bigint")])


def add_columns(spark: SparkSession, name: str, new_fields: Sequence[T.StructField]) -> None:
    """Schema evolution of a registered table: append new nullable columns."""
    existing = set(spark.table(name).columns)
    todo = [f for f in new_fields if f.name not in existing]
    if todo:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_ddl(T.StructType(todo))})")


def catalog_partitions(spark: SparkSession, name: str) -> DataFrame:
    """Partitions the catalog knows, as ``partition`` strings ``k=v/k=v``."""
    return spark.sql(f"SHOW PARTITIONS {name}")


def _listing(spark: SparkSession, path: str, below: Sequence[str] = ()) -> DataFrame:
    """path, length, modificationTime of the files, of the folders ``below`` only if any are given. Built from the
    file listing alone (binary-file source, content column pruned): no file is opened, whatever its format."""
    folders = [f"{path}/{b}" for b in below] or [path]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
    return files.select("path", "length", "modificationTime")


def storage_partitions(spark: SparkSession, path: str, partition_cols: Sequence[str], below: Sequence[str] = ()) -> DataFrame:
    """A3: partition directories present on storage, as ``partition`` strings plus their columns.

    Hidden files (``_SUCCESS``, ``.crc``) are skipped by the listing. Values stay exactly as in the path, so
    ``09`` stays ``"09"``.
    """
    parts = [F.regexp_extract("path", f"/{p}=([^/]*)/", 1).alias(p) for p in partition_cols]
    found = _listing(spark, path, below).select(*parts).where(F.col(partition_cols[0]) != F.lit("")).distinct()
    label = F.concat_ws("/", *[F.concat(F.lit(f"{p}="), F.col(p)) for p in partition_cols])
    return found.select(label.alias("partition"), *partition_cols)


def missing_partitions(spark: SparkSession, table: str, path: str, partition_cols: Sequence[str]) -> DataFrame:
    """Partitions on storage that the catalog does not list (queries silently skip them)."""
    on_storage = storage_partitions(spark, path, partition_cols)
    known = catalog_partitions(spark, table)
    return on_storage.join(known, "partition", "left_anti").select("partition")


def publish_version(spark: SparkSession, view: str, version_path: str, schema: T.StructType,
                    partition_cols: Sequence[str], fmt: str = "parquet") -> str:
    """A5 + A10: make a fully written table version the one readers see, in one catalog step.

    A full rebuild written in place (static overwrite) is not atomic: readers can see a missing or
    half-written table. Instead the rebuild goes to a new ``version_path``; this registers it as
    its own table and repoints the view ``view`` to it. Readers of the view switch from the old
    complete version to the new complete version. Old versions stay on storage until a retention
    job removes them. Returns the name of the version table.
    """
    suffix = version_path.rstrip("/").rsplit("/", 1)[-1].replace("=", "_").replace("-", "_").replace(".", "_")
    table = f"{view}__{suffix}"
    refresh_table(spark, table, version_path, schema, partition_cols, fmt)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table}")
    return table


def publish_outcomes(spark: SparkSession, view: str, version_path: str) -> str:
    """A8 + A10: a folder of ``etl_outcomes`` made the one readers see, curated rows and quarantine together.

    ``view`` holds all rows with their outcome; ``view_curated`` and ``view_quarantine`` select from it and never
    change, so that repointing ``view`` is the one step that switches both.
    """
    schema = T.StructType(RAW_SCHEMA.fields)
    publish_version(spark, view, version_path, schema, OUTCOME_PARTITIONS)
    columns = ", ".join(f"`{c}`" for c in CURATED_COLUMNS)
    spark.sql(f"CREATE OR REPLACE VIEW {view}_curated AS SELECT {columns} FROM {view} WHERE outcome = '{KEPT}'")
    spark.sql(f"CREATE OR REPLACE VIEW {view}_quarantine AS SELECT * EXCEPT (outcome), outcome AS error_type "
              f"FROM {view} WHERE outcome <> '{KEPT}'")
    return view
