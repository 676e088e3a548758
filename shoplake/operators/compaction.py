"""Compaction planner (K2): which partitions have files to pack, how they are packed, and the swap of each one.

Storage is never rewritten in place. A planned partition is written whole below ``<runs>/data``, its rows are
counted against the old ones, and then the catalog's partition is pointed at the new folder, one partition at a
time, so that a reader of the table sees either the old files or the new ones. Partitions without a gain keep
their files. The log of moves is a table: a run that was cut short carries on with the moves it had written.
Replaced folders stay, as readers may hold them; ``replaced_folders`` lists them for a retention job.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplake.functions.tables import constant_table, sql_literal
from shoplake.session import folder_exists

MOVES = "partition string, files_before long, files_after long, rows long, folder string, run long"
FILES_PER_PACKING = 10_000
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _label(partition_cols: Sequence[str], path: F.Column) -> F.Column:
    """``k=v/k=v`` of the innermost folders with these names, escaped as in the path."""
    return F.concat_ws("/", *[F.concat(F.lit(f"{p}="), F.regexp_extract(path, f".*/{p}=([^/]*)/", 1)) for p in partition_cols])


def _label_of_row(partition_cols: Sequence[str]) -> F.Column:
    """The same label for a row of the table: its file's address is the path, percent-encoded once more."""
    return _label(partition_cols, F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))


def _files(spark: SparkSession, path: str, partition_cols: Sequence[str]) -> DataFrame:
    """partition, file, bytes of the data files below ``path``, from the listing alone."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return (listed.where(~F.col("path").rlike(r"/[_.][^/]*$"))
            .select(_label(partition_cols, F.col("path")).alias("partition"), F.col("_metadata.file_path").alias("file"),
                    F.col("length").alias("bytes")))


def read_moves(spark: SparkSession, runs: str) -> DataFrame:
    """All moves of earlier runs; none before the first run."""
    if not folder_exists(spark, f"{runs}/moves"):
        return constant_table(spark, [], [(f, t) for f, t in (c.split() for c in MOVES.split(", "))])
    return spark.read.schema(MOVES).parquet(f"{runs}/moves")


def current_moves(moves: DataFrame) -> DataFrame:
    """The last move of each partition."""
    return moves.groupBy("partition").agg(F.max_by(F.struct("folder", "run"), "run").alias("at")).select("partition", "at.*")


def current_files(spark: SparkSession, path: str, runs: str, partition_cols: Sequence[str]) -> DataFrame:
    """partition, file, bytes of what readers of the table see: a moved partition's files are those of its last run."""
    files = _files(spark, path, partition_cols).withColumn("run", F.lit(None).cast("long"))
    moves = read_moves(spark, runs)
    if not moves.isEmpty():
        rewritten = _files(spark, f"{runs}/data", partition_cols)
        files = files.unionByName(rewritten.withColumn("run", F.regexp_extract("file", r".*/r(\d+)/s\d+/", 1).cast("long")))
    at = current_moves(moves).select("partition", F.col("run").alias("moved"))
    return files.join(at, "partition", "left").where(F.col("run").eqNullSafe(F.col("moved"))).drop("run", "moved")


def pack(files: DataFrame, target_bytes: int, files_per_packing: int = FILES_PER_PACKING) -> DataFrame:
    """``files`` (partition, file, bytes) plus ``bin``: files packed to about ``target_bytes``, smallest first.

    A bin takes the files whose running size, measured at their middle, falls into its stretch of the target, so
    it exceeds the target by less than a file; a file of the target's size or more has a bin of its own. A partition
    with very many files is packed in several independent parts, each of about ``files_per_packing`` files, so none is
    sorted in one task. Ties go by file name; files of no bytes join the first bin.
    """
    counts = files.groupBy("partition").agg(F.count(F.lit(1)).alias("n"))
    parts = F.ceil(F.col("n") / F.lit(files_per_packing)).cast("long")
    placed = files.join(counts, "partition").withColumn("part", F.pmod(F.xxhash64("file"), parts)).drop("n")
    small = F.col("bytes") < F.lit(target_bytes)
    order = Window.partitionBy("partition", "part", small).orderBy("bytes", "file")
    middle = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("bytes") / 2
    shared = F.concat_ws("-", "part", F.floor(middle / F.lit(target_bytes)).cast("string"))
    return placed.withColumn("bin", F.when(small, shared).otherwise(F.col("file"))).drop("part")


def plan(files: DataFrame, target_bytes: int = 256 << 20, least_gain: float = 0.5,
         files_per_packing: int = FILES_PER_PACKING) -> DataFrame:
    """partition, file, bytes, bin of the partitions worth rewriting: at least ``least_gain`` of their files would go."""
    packed = pack(files, target_bytes, files_per_packing)
    bins = packed.groupBy("partition", "bin").agg(F.count(F.lit(1)).alias("n"))
    gains = bins.groupBy("partition").agg(F.sum("n").alias("files"), F.count(F.lit(1)).alias("bins"))
    worth = gains.where((F.col("files") - F.col("bins") >= F.lit(least_gain) * F.col("files")) & (F.col("bins") < F.col("files")))
    return packed.join(worth.select("partition"), "partition", "left_semi")


def compact_table(spark: SparkSession, table: str, path: str, runs: str, partition_cols: Sequence[str],
                  target_bytes: int = 256 << 20, least_gain: float = 0.5, closed: F.Column | None = None,
                  fmt: str = "parquet", at_once: int = 100) -> DataFrame:
    """Pack the files of ``table`` (external, its partitions below ``path``); the moves of this run.

    Columns: partition, files_before, files_after, rows, folder, run. ``closed`` is a condition on ``partition``
    (``k=v/k=v``) that leaves out partitions still being written by path: a moved partition takes new rows through
    the table only. ``at_once`` partitions are read and written by one job, each bin into one file (a file larger
    than ``target_bytes`` into about one per target). Moves are written after the new rows were counted, and
    only then the catalog follows; the next run first repeats the last run's moves, which the catalog may lack. A
    partition whose counts differ, because a writer came between, is not moved. A table without files or without
    gain gives no rows.
    """
    earlier = read_moves(spark, runs)
    last = earlier.agg(F.max("run")).first()[0] or 0
    swap(spark, table, earlier.where(F.col("run") == last))
    run = last + 1
    files = current_files(spark, path, runs, partition_cols)
    chosen = f"{runs}/plans/r{run}"
    plan(files if closed is None else files.where(closed), target_bytes, least_gain).write.mode("overwrite").parquet(chosen)
    planned = spark.read.schema("partition string, file string, bytes long, bin string").parquet(chosen)
    names = sorted(r["partition"] for r in planned.select("partition").distinct().toLocalIterator())
    for at in range(0, len(names), at_once):
        folder = f"{runs}/data/r{run}/s{at // at_once}"
        moved = _rewrite(spark, table, planned, names[at:at + at_once], folder, partition_cols, target_bytes, fmt)
        moved.withColumn("run", F.lit(run).cast("long")).write.mode("append").parquet(f"{runs}/moves")
    done = read_moves(spark, runs).where(F.col("run") == run)
    swap(spark, table, done)
    return done


def _rewrite(spark: SparkSession, table: str, planned: DataFrame, names: list[str], folder: str,
             partition_cols: Sequence[str], target_bytes: int, fmt: str) -> DataFrame:
    """Write the named partitions by bins; partition, files_before, files_after, rows and folder of those whose rows
    are all there."""
    # Literal values of the partition columns prune the scan to the named partitions.
    rows = spark.table(table).where(" OR ".join(f"({_condition(name)})" for name in names))
    bins = planned.where(F.col("partition").isin(names)).groupBy("partition", "bin").agg(F.sum("bytes").alias("bytes"))
    # A bin of one large file is written in pieces, and every piece of every bin has a number: one file each.
    large = F.col("bytes") >= F.lit(target_bytes * 2)
    pieces = F.when(large, F.ceil(F.col("bytes") / F.lit(target_bytes))).otherwise(F.lit(1)).cast("long")
    sizes = bins.withColumn("pieces", pieces)
    before = {}
    for r in sorted(sizes.groupBy("partition").agg(F.sum("pieces").alias("n")).collect()):  # at most one per name
        before[r["partition"]] = sum(n for _, n in before.values()), r["n"]
    starts = spark.createDataFrame([(p, start) for p, (start, _) in before.items()], "partition string, start long")
    inside = F.sum("pieces").over(Window.partitionBy("partition").orderBy("bin")) - F.col("pieces")
    numbered = sizes.join(starts, "partition").select("partition", "bin", "pieces", (F.col("start") + inside).alias("first"))
    placed = planned.select("partition", "file", "bin").join(numbered, ["partition", "bin"]).select("file", "pieces", "first")
    block = F.floor(F.col("_metadata.file_block_start") / F.lit(target_bytes))
    data = rows.select("*", F.col("_metadata.file_path").alias("__file"), block.alias("__block"))
    data = data.join(placed, F.col("__file") == F.col("file"))
    number = F.col("first") + F.least("__block", F.col("pieces") - 1)
    total = max(1, sum(n for _, n in before.values()))
    data = data.repartitionById(total, number.cast("int")).select(*rows.columns)
    data.write.mode("overwrite").format(fmt).partitionBy(*partition_cols).save(folder)
    after = _counted(spark.read.format(fmt).schema(rows.schema).option("basePath", folder).load(folder), partition_cols, "files_after")
    return _counted(rows, partition_cols, "files_before").join(after, ["partition", "rows"]).select(
        "partition", "files_before", "files_after", "rows", F.concat_ws("/", F.lit(folder), "partition").alias("folder"))


def _condition(partition: str) -> str:
    pairs = (kv.split("=", 1) for kv in partition.split("/"))
    return " AND ".join(f"`{k}` IS NULL" if v == NO_VALUE else f"`{k}` = {sql_literal(unquote(v))}" for k, v in pairs)


def _counted(rows: DataFrame, partition_cols: Sequence[str], files: str) -> DataFrame:
    per_file = rows.groupBy(_label_of_row(partition_cols).alias("partition"), F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"))
    return per_file.groupBy("partition").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias(files))


def swap(spark: SparkSession, table: str, moves: DataFrame) -> None:
    """Point the catalog's partitions to their folders, one by one; repeating it changes nothing."""
    for r in moves.select("partition", "folder").toLocalIterator():
        pairs = (kv.split("=", 1) for kv in r["partition"].split("/"))
        spec = ", ".join(f"`{k}` = {'NULL' if v == NO_VALUE else sql_literal(unquote(v))}" for k, v in pairs)
        spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION {sql_literal(r['folder'])}")


def replaced_folders(spark: SparkSession, path: str, runs: str) -> DataFrame:
    """partition, folder of what no reader that starts now will see: the folders of partitions moved since."""
    moves = read_moves(spark, runs)
    latest = current_moves(moves)
    older = moves.join(latest.select("partition", "run"), ["partition", "run"], "left_anti").select("partition", "folder")
    return latest.select("partition", F.concat_ws("/", F.lit(path.rstrip("/")), "partition").alias("folder")).unionByName(older)
