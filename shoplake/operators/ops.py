"""Operations jobs over inventory, query-log, billing and run-log tables (K1-K5).

In the source system these are storage, billing and alerting *settings*; here they are audits a Spark
user runs over tables. Rule and budget tables are tiny, fixed lists and are joined by key (broadcast
where it matters); the large side (object inventory, billing lines) is only scanned and aggregated.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.functions import scan_cost_usd
from shoplake.functions.tables import constant_table

# ---------------------------------------------------------------------------------------------
# Fixed values of the storage lifecycle, budgets and alert rules.
# ---------------------------------------------------------------------------------------------
# (prefix, min_age_days, action); actions: a storage class to move to, or EXPIRE.
LIFECYCLE_RULES = [
    ("raw/", 30, "STANDARD_IA"),
    ("raw/", 90, "GLACIER_IR"),
    ("athena-results/", 7, "EXPIRE"),
    ("test-intelligent-tiering/", 0, "INTELLIGENT_TIERING"),
]
# Storage classes with a minimum billable object size, and that size in bytes.
MIN_BILLABLE_CLASSES = ["STANDARD_IA", "GLACIER_IR"]
MIN_BILLABLE_BYTES = 128 * 1024
# (budget name, monthly limit in USD, alert threshold in % of the limit); alerts fire above it.
BUDGETS = [
    ("soft-limit", 150.0, 80),
    ("soft-limit", 150.0, 100),
    ("hard-stop", 180.0, 100),
]
# (detail type, state that counts as a failure); states are compared case-sensitively.
FAILURE_STATES = [
    ("Glue Crawler State Change", "Failed"),
    ("Glue Job State Change", "FAILED"),
]
# End of fixed values.


def lifecycle_rules(spark: SparkSession, rules=LIFECYCLE_RULES) -> DataFrame:
    return constant_table(spark, list(rules), [("prefix", "string"), ("min_age_days", "int"), ("action", "string")])


def top_prefix(key: str | F.Column) -> F.Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(F.substring_index(k, "/", 1), F.lit("/"))


def object_tiers(inventory: DataFrame, rules: DataFrame, as_of) -> DataFrame:
    """K1: the inventory with the ``prefix`` that governs each object and its storage ``tier`` at ``as_of``.

    ``inventory``: key, size_bytes, last_modified. ``rules``: prefix, min_age_days, action; prefixes may nest.
    The rules of the longest prefix that a key starts with govern it; of these the one with the
    largest age threshold it has reached applies, and EXPIRE wins over transitions. An object without a
    rule stays STANDARD, under its top-level folder.
    """
    age = F.datediff(F.lit(as_of).cast("date"), F.col("last_modified").cast("date"))
    objs = inventory.select("key", "size_bytes", "last_modified", age.alias("age_days"))
    rank = F.when(F.col("action") == F.lit("EXPIRE"), F.lit(1_000_000)).otherwise(F.col("min_age_days"))
    # One row per prefix holding its rules. Prefixes of one length are looked up by equality with the key's first
    # characters, the longest first: as many small joins as there are different lengths, and no pairs.
    rule_sets = rules.groupBy("prefix").agg(
        F.collect_list(F.struct(rank.alias("rank"), F.col("action"), F.col("min_age_days"))).alias("rules"))
    lengths = sorted((r[0] for r in rules.select(F.length("prefix")).distinct().collect()), reverse=True)
    for n in lengths:
        of = rule_sets.where(F.length("prefix") == n).select(F.col("prefix").alias(f"p{n}"), F.col("rules").alias(f"r{n}"))
        objs = objs.withColumn("head", F.left("key", F.lit(n))).join(of, F.col("head") == F.col(f"p{n}"), "left").drop("head")
    with_rules = objs.withColumns({"prefix": F.coalesce(*[F.col(f"p{n}") for n in lengths], top_prefix("key")),
                                   "rules": F.coalesce(*[F.col(f"r{n}") for n in lengths], F.array())})
    reached = F.filter("rules", lambda r: F.col("age_days") >= r["min_age_days"])
    action = F.array_max(reached)["action"]
    tier = F.coalesce(F.when(action == F.lit("EXPIRE"), F.lit("EXPIRED")).otherwise(action), F.lit("STANDARD"))
    return with_rules.select("key", "prefix", tier.alias("tier"), "size_bytes", "last_modified")


def tier_audit(inventory: DataFrame, rules: DataFrame, as_of) -> DataFrame:
    """K1: what each folder's objects (see ``object_tiers``) bill in their tier at ``as_of``.

    Billable bytes apply the minimum object size of the infrequent-access classes. Returns
    ``prefix, tier, objects, bytes, billable_bytes``.
    """
    tiered = object_tiers(inventory, rules, as_of)
    billable = F.when(F.col("tier").isin(*MIN_BILLABLE_CLASSES),
                      F.greatest("size_bytes", F.lit(MIN_BILLABLE_BYTES))).otherwise(F.col("size_bytes"))
    return (tiered.groupBy("prefix", "tier")
            .agg(F.count(F.lit(1)).alias("objects"), F.sum("size_bytes").alias("bytes"),
                 F.sum(billable).alias("billable_bytes")))


def list_objects(spark: SparkSession, root: str, date_from_path: bool = True) -> DataFrame:
    """Inventory of the files below ``root``: ``key`` (relative), ``size_bytes``, ``last_modified``.

    Uses the binary-file source with the content column pruned, so files are listed, never read.
    With ``date_from_path`` the object date is taken from its ``year=/month=/day=`` directories
    (the landing date of event data) and falls back to the file time.
    """
    root = root.rstrip("/")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select("path", "length", "modificationTime"))
    rel = re.escape(_strip_scheme(root).lstrip("/"))
    key = F.regexp_extract("path", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?/*" + rel + r"/(.*)$", 1)
    y = F.regexp_extract("path", r"year=(\d{4})", 1)
    m = F.regexp_extract("path", r"month=(\d{2})", 1)
    d = F.regexp_extract("path", r"day=(\d{2})", 1)
    path_date = F.when(y != "", F.to_timestamp(F.concat_ws("-", y, F.when(m != "", m).otherwise(F.lit("01")),
                                                            F.when(d != "", d).otherwise(F.lit("01")))))
    modified = F.coalesce(path_date, F.col("modificationTime")) if date_from_path else F.col("modificationTime")
    return files.select(key.alias("key"), F.col("length").alias("size_bytes"), modified.alias("last_modified"))


def _strip_scheme(path: str) -> str:
    if ":" in path.split("/")[0]:
        return path.split(":", 1)[1]
    return path


def files_per_partition(spark: SparkSession, path: str, partition_cols: list[str] | None = None) -> DataFrame:
    """Data files per partition directory: ``partition, files, bytes`` (listing only).

    With ``partition_cols`` the label is built from exactly those ``col=value`` folders, so
    ``key=value`` folders above the table (a version folder, say) do not leak into it.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("path", "length").where(~F.col("path").rlike(r"/_[^/]*$|/\.[^/]*$")))
    if partition_cols:
        part = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.regexp_extract("path", f"/{c}=([^/]*)/", 1))
                                  for c in partition_cols])
    else:
        part = F.regexp_extract("path", r"((?:[^/=]+=[^/]*/)*[^/=]+=[^/]*)/[^/]+$", 1)
    return files.groupBy(part.alias("partition")).agg(F.count(F.lit(1)).alias("files"),
                                                      F.sum("length").alias("bytes"))


def _rows_per_partition(spark: SparkSession, path: str, partition_cols: list[str], fmt: str) -> DataFrame:
    label = F.concat_ws("/", *[F.concat(F.lit(f"{p}="), F.col(p)) for p in partition_cols])
    return (spark.read.format(fmt).load(path).groupBy(label.alias("partition"))
            .agg(F.count(F.lit(1)).alias("rows")))


def compact(spark: SparkSession, src: str, dst: str, partition_cols: list[str], fmt: str = "parquet") -> DataFrame:
    """K2: rewrite ``src`` into ``dst`` with few files per partition.

    Returns ``partition, files_before, files_after, rows_before, rows_after``; the row columns
    show that nothing was lost (for Parquet they come from file footers). The rewrite shuffles by
    the partition columns through a rebalance, so each partition becomes about one file per
    advisory partition size, and an oversized partition is split, not funnelled into one task.
    """
    from shoplake.sources.sinks import write_partitioned

    write_partitioned(spark.read.format(fmt).load(src), dst, partition_cols, fmt, "full")
    sides = []
    for side, path in (("before", src), ("after", dst)):
        files = files_per_partition(spark, path, partition_cols).select(
            "partition", F.col("files").alias(f"files_{side}"))
        rows = _rows_per_partition(spark, path, partition_cols, fmt).select(
            "partition", F.col("rows").alias(f"rows_{side}"))
        sides.append(files.join(rows, "partition", "full"))
    joined = sides[0].join(sides[1], "partition", "full")
    return joined.select(
        "partition", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                       for c in ("files_before", "files_after", "rows_before", "rows_after")])


def scan_bytes(spark: SparkSession, path: str, fmt: str, columns: list[str] | None = None,
               ranges: dict[str, tuple] | None = None) -> DataFrame:
    """Bytes a query must read from ``path``: ``files, bytes_scanned, unopened_footers``.

    Row formats (json, csv, text) are read whole. For Parquet only the chunks of the needed
    ``columns`` plus each file's footer are read, and of these only the row groups whose statistics overlap the
    query's ``ranges`` (column -> lowest and highest value its filter lets through). The footers are opened with
    Arrow inside the tasks (one task per slice of the file listing), never on the driver.
    """
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
               .select("path", "length").where(~F.col("path").rlike(r"/_[^/]*$|/\.[^/]*$")))
    if fmt != "parquet":
        return listing.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes_scanned"),
                           F.lit(0).cast("bigint").alias("unopened_footers"))
    wanted, bounds = list(columns or []), dict(ranges or {})

    def footer_bytes(batches):
        import pandas as pd
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs

        for pdf in batches:
            out, unopened = [], []
            for p, length in zip(pdf["path"], pdf["length"]):
                uri = p.replace("file:/", "file:///", 1) if p.startswith("file:/") and not p.startswith("file:///") else p
                uri = uri.replace("s3a://", "s3://", 1)
                try:
                    filesystem, inner = pafs.FileSystem.from_uri(uri)
                    with filesystem.open_input_file(inner) as fh:
                        meta = pq.ParquetFile(fh).metadata
                except (OSError, ValueError):
                    # A store Arrow cannot open here: count the whole file (an upper bound) and say so.
                    out.append(int(length))
                    unopened.append(1)
                    continue
                unopened.append(0)
                total = int(meta.serialized_size) + 8
                for g in range(meta.num_row_groups):
                    rg = meta.row_group(g)
                    if _skipped(rg, bounds):
                        continue
                    for c in range(rg.num_columns):
                        chunk = rg.column(c)
                        if not wanted or chunk.path_in_schema.split(".")[0] in wanted:
                            total += int(chunk.total_compressed_size)
                out.append(min(total, int(length)))
            yield pd.DataFrame({"bytes": out, "unopened": unopened}, dtype="int64")

    chunks = listing.mapInPandas(footer_bytes, "bytes long, unopened long")
    return chunks.agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes_scanned"),
                      F.coalesce(F.sum("unopened"), F.lit(0)).alias("unopened_footers"))


def _skipped(group, bounds: dict[str, tuple]) -> bool:
    """Whether a row group's statistics show that no row passes."""
    for c in range(group.num_columns):
        chunk = group.column(c)
        stats = chunk.statistics
        if chunk.path_in_schema in bounds and stats is not None and stats.has_min_max:
            low, high = bounds[chunk.path_in_schema]
            if stats.max < low or stats.min > high:
                return True
    return False


def scan_cost(query_log: DataFrame) -> DataFrame:
    """K3: per query and source format, bytes scanned, cost at the per-TiB price, and the saving of
    each format against the largest scan of the same query.

    ``query_log``: query_name, source_format, bytes_scanned. Returns
    ``query_name, source_format, bytes_scanned, cost_usd, reduction_pct``.
    """
    per = query_log.groupBy("query_name", "source_format").agg(F.sum("bytes_scanned").alias("bytes_scanned"))
    worst = per.groupBy("query_name").agg(F.max("bytes_scanned").alias("_max"))
    return (per.join(worst, "query_name")
            .select("query_name", "source_format", "bytes_scanned",
                    scan_cost_usd("bytes_scanned").alias("cost_usd"),
                    F.round((F.lit(1.0) - F.col("bytes_scanned") / F.nullif("_max", F.lit(0))) * 100, 2)
                    .alias("reduction_pct")))


def budgets(spark: SparkSession, project_tag: str, rows=BUDGETS) -> DataFrame:
    """The budget table for the spend of one cost-allocation tag."""
    return constant_table(spark, [(n, project_tag, float(lim), int(t)) for n, lim, t in rows],
                          [("name", "string"), ("project_tag", "string"), ("limit_usd", "double"),
                           ("threshold_pct", "int")])


def spend_by_service(billing: DataFrame) -> DataFrame:
    """K4 (spend): per month, service and tag, ``cost_usd`` and its share of the month in %."""
    month = F.date_format("usage_date", "yyyy-MM")
    per = billing.groupBy(month.alias("month"), "service", "project_tag").agg(
        F.sum("cost_usd").cast("decimal(18,6)").alias("cost_usd"))
    total = per.groupBy("month").agg(F.sum("cost_usd").alias("_total"))
    return per.join(total, "month").select(
        "month", "service", "project_tag", "cost_usd",
        F.round(F.col("cost_usd").cast("double") * 100 / F.nullif(F.col("_total").cast("double"), F.lit(0.0)), 2)
        .alias("pct_of_month"))


def budget_status(billing: DataFrame, budget_table: DataFrame) -> DataFrame:
    """K4: per month and budget threshold, spend of the budget's tag and whether it is crossed.

    ``billing``: usage_date, service, project_tag, cost_usd. ``budget_table``: name, project_tag,
    limit_usd, threshold_pct. Alerts fire when spend is *greater than* the threshold share.
    """
    month = F.date_format("usage_date", "yyyy-MM")
    spent = billing.groupBy(month.alias("month"), "project_tag").agg(
        F.sum("cost_usd").cast("double").alias("spent_usd"))
    return (spent.join(budget_table, "project_tag")
            .select("month", F.col("name").alias("budget"), "limit_usd", F.round("spent_usd", 2).alias("spent_usd"),
                    "threshold_pct",
                    (F.col("spent_usd") > F.col("limit_usd") * F.col("threshold_pct") / 100.0).alias("crossed")))


def failed_runs(run_log: DataFrame, failure_states=FAILURE_STATES) -> DataFrame:
    """K5: runs whose state is the failure state of their type (exact, case-sensitive match).

    ``run_log``: detail_type, name, state, at. Returns the same columns for failed runs.
    """
    spark = run_log.sparkSession
    states = constant_table(spark, list(failure_states), [("detail_type", "string"), ("state", "string")])
    return run_log.join(F.broadcast(states), ["detail_type", "state"], "left_semi").select(
        "detail_type", "name", "state", "at")
