"""Decision archive: Parquet by day and hour, its table, and incremental runs.

Every run writes below its own ``run=<start key>`` folder inside each ``dt/hr``
partition. A run that failed half-way or timed out after writing is repeated
with the same start, which replaces its own files and nothing else, so a retry
can neither lose nor duplicate decisions.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citysignal import schemas
from citysignal.functions import keys, text
from citysignal.operators.store import latest_per_key
from citysignal.sources import scans

FIRST_KEY = "00000000_000000"
HOURS_PER_TASK = 24


def archive_rows(decisions: DataFrame, campaign: bool = False) -> DataFrame:
    """Decisions in the archive's nine columns plus its partition columns.

    ``campaign`` adds the campaign, as the stored table has it.
    """
    rendered = decisions
    if "target_locations" not in decisions.columns:
        rendered = decisions.select(
            "decision_id",
            *schemas.SCORES,
            "decision_result",
            text.quoted_list(F.col("targets")).alias("target_locations"),
            F.date_format("decision_time", keys.CLOCK_TIME).alias("decision_time"),
            F.date_format("display_time", keys.CLOCK_TIME).alias("display_time"),
            *(name for name in ("campaign_type",) if name in decisions.columns),
        )
    return with_partitions(scans.with_defaults(rendered, campaign))


def with_partitions(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "dt": keys.key_date(F.col("decision_id")),
            "hr": keys.key_hour_of_day(F.col("decision_id")),
        }
    )


def append(rows: DataFrame, path: str, run: str, hours: int = 1) -> None:
    """Write one run that covers about ``hours`` hours.

    A regular run touches few folders: it is rebalanced by folder, which avoids
    tiny files and splits an hour that is too big for one task. A backfill opens
    so many files that opening them is the work: it is cut into key ranges of
    equal size, a day's worth of folders or less per task, and a crowded hour
    spans several ranges.
    """
    if hours <= HOURS_PER_TASK:
        placed = rows.hint("rebalance", "dt", "hr")
    else:
        session = rows.sparkSession
        configured = int(session.conf.get("spark.sql.shuffle.partitions"))
        tasks = max(configured, -(-hours // HOURS_PER_TASK))
        placed = rows.repartitionByRange(tasks, "decision_id")
    _replace_runs(placed.withColumn("run", F.lit(run)), path)


def _replace_runs(placed: DataFrame, path: str) -> None:
    """Write rows over the runs that they name, hour by hour; others stay."""
    (
        placed.sortWithinPartitions("dt", "hr", "run", "decision_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*schemas.ARCHIVE_PARTITIONS, "run")
        .parquet(path)
    )


def _hours_covered(rows: DataFrame) -> int:
    """Hours from the first to the last key; reads the key column only."""
    ends = rows.agg(F.min("decision_id").alias("first"), F.max("decision_id").alias("last"))
    seconds = F.unix_timestamp(keys.key_timestamp(F.col("last"))) - F.unix_timestamp(
        keys.key_timestamp(F.col("first"))
    )
    return (ends.select(F.coalesce(seconds, F.lit(0))).first()[0] // 3600) + 1


def read(spark: SparkSession, path: str) -> DataFrame:
    """The archive's nine columns, ``dt`` and ``hr``; partition values stay strings."""
    return read_base(spark, path).drop("campaign_type")


def read_base(spark: SparkSession, path: str) -> DataFrame:
    """All stored columns but the run. Files of before campaigns were kept have none there."""
    schema = f"{schemas.ARCHIVE_BASE_COLUMNS}, dt STRING, hr STRING, run STRING"
    return spark.read.schema(schema).parquet(path).drop("run")


def high_water_mark(spark: SparkSession, marks: str) -> str:
    """Stop key of the last finished run."""
    try:
        done = spark.read.parquet(marks)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return FIRST_KEY
        raise
    return done.agg(F.max("stop")).first()[0] or FIRST_KEY


def archive_increment(spark: SparkSession, decisions: DataFrame, path: str, stop: str) -> None:
    """Archive decisions from the last mark up to ``stop``, then move the mark.

    Several writes of one decision are reduced to one row: by the rows' ``seq`` column
    where they have one, else the greatest row, so that a repeated run leaves no copies.
    """
    marks = f"{path}/_marks"
    start = high_water_mark(spark, marks)
    fresh = scans.scan_range(decisions, start, stop, key="decision_id")
    hours = _hours_covered(fresh)
    append(archive_rows(current_rows(fresh), campaign=True), path, start, hours)
    spark.range(1).select(F.lit(start).alias("start"), F.lit(stop).alias("stop")).write.mode(
        "append"
    ).parquet(marks)


def hour_digests(rows: DataFrame) -> DataFrame:
    """Number of rows and an order-free digest of every ``(dt, hr)``."""
    columns = [column.split()[0] for column in schemas.ARCHIVE_BASE_COLUMNS.split(",")]
    # Nulls are hashed as marks of their own: a hash skips plain nulls.
    each = F.xxhash64(*[F.struct(F.col(c), F.col(c).isNull().alias("none")) for c in columns])
    return rows.groupBy(*schemas.ARCHIVE_PARTITIONS).agg(
        F.count("*").alias("n"),
        F.bit_xor(each).alias("mixed"),
        F.sum(each.bitwiseAND(F.lit(0xFFFFFFFF))).alias("summed"),
    )


def current_rows(decisions: DataFrame) -> DataFrame:
    """One row a decision: by the rows' ``seq`` column where they have one, else the greatest."""
    if "seq" in decisions.columns:
        return latest_per_key(decisions, "decision_id", ["seq"])
    whole = F.struct(*(c for c in decisions.columns if c != "decision_id"))
    newest = decisions.groupBy("decision_id").agg(F.max(whole).alias("row"))
    return newest.select("decision_id", "row.*")


def reconcile(spark: SparkSession, decisions: DataFrame, path: str) -> list[tuple[str, str]]:
    """Bring archived hours up to date with late and corrected decisions.

    Decisions that came behind the mark, or changed since their hour was archived, show in the
    hour's count or digest, which both sides work out in parallel; only hours that differ
    are written again. Returns those hours.

    A rewritten hour is one run, in place of one it had; its other runs are emptied after that. A
    reconciliation that fails between the two leaves hours that differ, so the next one repairs them.
    """
    done = high_water_mark(spark, f"{path}/_marks")
    behind = scans.scan_range(decisions, FIRST_KEY, done, key="decision_id")
    wanted = archive_rows(current_rows(behind), campaign=True)
    by = list(schemas.ARCHIVE_PARTITIONS)
    kept = hour_digests(read_base(spark, path)).withColumnsRenamed(
        {name: f"{name}_kept" for name in ("n", "mixed", "summed")}
    )
    same = F.lit(True)
    for name in ("n", "mixed", "summed"):
        same = same & F.col(name).eqNullSafe(F.col(f"{name}_kept"))
    differing = hour_digests(wanted).join(kept, by, "full").filter(~same).select(*by)
    hours = sorted((row.dt, row.hr) for row in differing.collect())
    if not hours:
        return []
    slot = F.concat_ws("_", *by)
    days = sorted({dt for dt, _ in hours})
    chosen = F.col("dt").isin(days) & slot.isin([f"{dt}_{hr}" for dt, hr in hours])
    schema = f"{schemas.ARCHIVE_BASE_COLUMNS}, dt STRING, hr STRING, run STRING"
    runs = spark.read.schema(schema).parquet(path).filter(chosen).select(*by, "run").distinct()
    held: dict[tuple[str, str], list[str]] = {hour: [] for hour in hours}
    for row in runs.collect():
        held[row.dt, row.hr].append(row.run)
    # An hour keeps one run, which the rows replace; hours that are new to the archive get one.
    kept_runs = [(dt, hr, max(found, default=done)) for (dt, hr), found in held.items()]
    named = F.broadcast(spark.createDataFrame(kept_runs, "dt STRING, hr STRING, run STRING"))
    fresh = wanted.filter(chosen)
    filled = {(row.dt, row.hr) for row in fresh.select(*by).distinct().collect()}
    _replace_runs(fresh.join(named, by).hint("rebalance", *by), path)
    # What is left over: second runs of an hour, and hours without decisions.
    nothing = spark.createDataFrame([], schemas.ARCHIVE_BASE_COLUMNS)
    for (dt, hr), found in held.items():
        for run in found:
            if run != max(found) or (dt, hr) not in filled:
                nothing.write.mode("overwrite").parquet(f"{path}/dt={dt}/hr={hr}/run={run}")
    return hours


def create_table(spark: SparkSession, name: str, path: str) -> None:
    """External table over the archive folder."""
    spark.sql(
        f"""
        CREATE TABLE IF NOT EXISTS {name} (
            {schemas.ARCHIVE_BASE_COLUMNS}, dt STRING, hr STRING, run STRING)
        USING PARQUET
        PARTITIONED BY (dt, hr, run)
        LOCATION '{path}'
        """
    )


def create_view(spark: SparkSession, name: str, table: str) -> None:
    """The nine columns and partitions of the table; partition filters reach the files."""
    columns = [column.split()[0] for column in schemas.ARCHIVE_COLUMNS.split(",")]
    listed = ", ".join([*columns, *schemas.ARCHIVE_PARTITIONS])
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {listed} FROM {table}")


def refresh_partitions(spark: SparkSession, name: str) -> None:
    """Make folders that were added since visible to the table."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def describe(spark: SparkSession, name: str) -> DataFrame:
    """Columns of the table with their type and role."""
    partitions = spark.catalog.listColumns(name)
    rows = [(c.name, c.dataType, c.isPartition) for c in partitions]
    return spark.createDataFrame(rows, "col_name STRING, data_type STRING, is_partition BOOLEAN")


def partitions(spark: SparkSession, name: str) -> DataFrame:
    """``(dt, hr)`` of every partition of the table."""
    parts = F.split("partition", "[=/]")
    return (
        spark.sql(f"SHOW PARTITIONS {name}")
        .select(parts[1].alias("dt"), parts[3].alias("hr"))
        .distinct()
    )


def by_day(archive: DataFrame, dt: str) -> DataFrame:
    return archive.filter(F.col("dt") == dt)


def by_hour(archive: DataFrame, dt: str, hr: str) -> DataFrame:
    """Decisions of one hour, newest first."""
    return archive.filter((F.col("dt") == dt) & (F.col("hr") == hr)).orderBy(
        F.desc("decision_id")
    )
