"""Insert-only lake tables: idempotent batches, a commit log and as-of reads.

A batch writes its new rows into a folder of its own and then one row into the log folder of its
commit number. Readers join the log, so files without a log row are invisible, and a retried
batch overwrites its own folder. Rows carry the number of their commit: reading as of a commit is
a filter on it. A commit number is taken once: a writer that finds its number taken compares its
batch with what is published by then and writes anew, so two writers insert no key twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tidemark import schemas
from tidemark.schemas import LakeTable

COMMIT = "commit_seq"
#: Groups of leading key values that a batch's key bounds are told apart by; beyond, bounds are common.
MOST_BOUNDS = 200
#: Times that a batch is written anew because its commit number was taken.
MOST_TRIES = 20

LOG = T.StructType([
    T.StructField("commit_seq", T.LongType()),
    T.StructField("commit_ts", T.TimestampType()),
    T.StructField("operation", T.StringType()),  # append or error
    T.StructField("table_name", T.StringType()),
    T.StructField("writer", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("part", T.StringType()),
    T.StructField("received", T.LongType()),
    T.StructField("inserted", T.LongType()),
    T.StructField("skipped", T.LongType()),
    T.StructField("offsets", T.MapType(T.StringType(), T.LongType())),
    T.StructField("topics", T.ArrayType(T.StringType())),
    T.StructField("seconds", T.DoubleType()),
])


@dataclass(frozen=True)
class WriteResult:
    received: int
    inserted: int
    skipped: int


def _path(root: str, table: LakeTable, leaf: str) -> str:
    return f"{root.rstrip('/')}/{table.name.replace('.', '/')}/{leaf}"


def data_path(root: str, table: LakeTable) -> str:
    return _path(root, table, "data")


def _data_schema(table: LakeTable) -> T.StructType:
    fields = [T.StructField(f.name, f.dataType, True) for f in table.schema.fields]
    return T.StructType([
        *fields,
        T.StructField(COMMIT, T.LongType()),
        T.StructField("part", T.StringType()),
        T.StructField(table.day_column, T.DateType()),
    ])


def ensure_table(spark: SparkSession, root: str, table: LakeTable) -> None:
    """Create the table's log and data folder unless they exist."""
    spark.createDataFrame([], LOG).write.mode("ignore").parquet(_log_folder(root, table, 0))
    spark.createDataFrame([], _data_schema(table)).write.mode("ignore").partitionBy(
        "part", table.day_column, table.partition_column
    ).parquet(_path(root, table, "data"))


def _log_folder(root: str, table: LakeTable, seq: int) -> str:
    return f"{_path(root, table, 'log')}/commit={seq:012d}"


def table_exists(spark: SparkSession, root: str, table: LakeTable) -> bool:
    try:
        commit_log(spark, root, table).schema
        return True
    except AnalysisException:
        return False


def commit_log(spark: SparkSession, root: str, table: LakeTable) -> DataFrame:
    return spark.read.schema(LOG).parquet(_path(root, table, "log")).select(*LOG.fieldNames())


def run_records(log: DataFrame) -> DataFrame:
    """One record per committed batch: job, inputs, output, rows written and state."""
    return log.filter(F.col("operation") == "append").select(
        F.concat(F.lit("sink-"), F.element_at(F.split("table_name", r"\."), -1)).alias("job_name"),
        F.coalesce(F.nullif(F.array_join("topics", ", "), F.lit("")), F.col("table_name")).alias("inputs"),
        F.col("table_name").alias("output"),
        F.col("inserted").alias("rows_written"),
        F.lit("COMPLETE").alias("state"),
        "commit_seq",
    )


def _published(spark: SparkSession, root: str, table: LakeTable, through: int | None = None) -> DataFrame:
    """Rows of parts the log names, up to a commit if one is given; the join prunes other parts' folders."""
    data = spark.read.schema(_data_schema(table)).parquet(data_path(root, table))
    log = commit_log(spark, root, table).filter(F.col("operation") == "append")
    parts = log.filter(F.lit(True) if through is None else F.col("commit_seq") <= through).select("part")
    return data.join(parts, "part", "left_semi")


def _rows(table: LakeTable) -> list[str]:
    return [*table.schema.fieldNames(), table.day_column]


def read_table(spark: SparkSession, root: str, table: LakeTable) -> DataFrame:
    """The current rows, with the day column for pruning."""
    return _published(spark, root, table).select(*_rows(table))


def keep_last(batch: DataFrame, keys: Sequence[str], order: Column | str) -> DataFrame:
    """The last arrival per key. Spark cuts each map task to one row per key before the shuffle."""
    newest = Window.partitionBy(*keys).orderBy(F.desc(order) if isinstance(order, str) else order.desc())
    return batch.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank")


@dataclass(frozen=True)
class _Profile:
    received: int
    offsets: dict[str, int]
    topics: list[str]
    bounds: list[dict[str, tuple]]


def _profile(batch: DataFrame, keys: Sequence[str]) -> _Profile:
    """Row count, next offsets and key bounds of a batch, in one pass.

    Bounds are of the last key within each combination of the others, such as ids within exchange and
    symbol. Where there are more than MOST_BOUNDS of these, one range for each key stands for all.
    """
    has_log = {"topic", "partition", "kafka_offset"} <= set(batch.columns)
    group = ["topic", "partition"] if has_log else []
    measures = [
        F.count(F.lit(1)).alias("n"),
        (F.max("kafka_offset") + 1 if has_log else F.lit(None)).alias("next_offset"),
        *[F.min(k).alias(f"min_{k}") for k in keys],
        *[F.max(k).alias(f"max_{k}") for k in keys],
    ]
    leading = [F.col(k).alias(f"by_{k}") for k in keys[:-1]]
    rows = [r for r in batch.groupBy(*group, *leading).agg(*measures).limit(MOST_BOUNDS + 1).collect() if r["n"]]
    if len(rows) > MOST_BOUNDS:
        rows = [r for r in batch.groupBy(*group).agg(*measures).collect() if r["n"]]
        wide = {k: (min(r[f"min_{k}"] for r in rows), max(r[f"max_{k}"] for r in rows)) for k in keys}
        bounds = [wide]
    else:
        bounds = [{k: (r[f"min_{k}"], r[f"max_{k}"]) for k in keys} for r in rows]
    offsets: dict[str, int] = {}
    for r in rows if has_log else []:
        name = f"{r['topic']}.{r['partition']}"
        offsets[name] = max(offsets.get(name, 0), r["next_offset"])
    topics = sorted({r["topic"] for r in rows}) if has_log else []
    return _Profile(sum(r["n"] for r in rows), offsets, topics, bounds)


def _possible_matches(published: DataFrame, table: LakeTable, bounds: list[dict[str, tuple]]) -> DataFrame:
    """Keys of published rows within the batch's key bounds.

    A match has equal keys, so the bounds lose none; they are literals, and so prune the partitions
    that follow from the key and the row groups of the rest.
    """
    def within(own: dict[str, tuple]) -> Column:
        ranges = []
        for key, (low, high) in own.items():
            same = low == high
            ranges.append(F.col(key) == F.lit(low) if same else F.col(key).between(F.lit(low), F.lit(high)))
            if table.time_in_key and key == table.time_column:
                ranges.append(F.col(table.day_column).between(F.to_date(F.lit(low)), F.to_date(F.lit(high))))
        return reduce(Column.__and__, ranges)

    return published.filter(reduce(Column.__or__, [within(own) for own in bounds])).select(*table.keys)


def write_batch(
    batch: DataFrame,
    root: str,
    table: LakeTable,
    batch_id: int,
    writer: str = "sink",
    order: Column | str = "kafka_offset",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> WriteResult:
    """Insert the rows whose key the table does not have; rows it has are left as they are.

    Repeats within the batch keep the last arrival by ``order``. An empty batch commits nothing,
    and a batch that is already in the log returns its recorded result. If another writer takes the
    commit number first, the batch is compared with the table again and written anew. ``prepare`` sees
    the rows that are new before they are written, each time that they are.
    """
    spark = batch.sparkSession
    this_batch = (F.col("writer") == writer) & (F.col("batch_id") == batch_id)
    appended = F.col("operation") == "append"
    began, profile = time.monotonic(), None
    for _ in range(MOST_TRIES):
        state = commit_log(spark, root, table).agg(
            F.coalesce(F.max("commit_seq"), F.lit(0)).alias("last_seq"),
            F.max_by("offsets", F.when(appended, F.col("commit_seq"))).alias("offsets"),
            F.max_by(
                F.struct("received", "inserted", "skipped"), F.when(appended & this_batch, F.col("commit_seq"))
            ).alias("done"),
        ).first()
        if state["done"] is not None:
            return WriteResult(*state["done"])
        seq = state["last_seq"] + 1
        try:
            profile = profile or _profile(batch, table.keys)
            if profile.received == 0:
                return WriteResult(0, 0, 0)
            part = f"{writer}-{batch_id:012d}"
            rows = _unknown_rows(batch, root, table, profile, order, seq)
            _write_part(prepare(rows) if prepare else rows, root, table, part)
            inserted = _part_rows(spark, root, table, part)
        except Exception:
            _note_error(spark, root, table, seq, writer=writer, batch_id=batch_id, seconds=time.monotonic() - began)
            raise
        skipped = max(profile.received - inserted, 0)
        if _commit(
            spark, root, table, seq, writer=writer, batch_id=batch_id, part=part,
            received=profile.received, inserted=inserted, skipped=skipped,
            offsets={**(state["offsets"] or {}), **profile.offsets}, topics=profile.topics,
            seconds=time.monotonic() - began,
        ):
            return WriteResult(profile.received, inserted, skipped)
    raise RuntimeError(f"{table.name}: commit numbers were taken {MOST_TRIES} times")


def _unknown_rows(
    batch: DataFrame, root: str, table: LakeTable, profile: _Profile, order: Column | str, seq: int
) -> DataFrame:
    """The last arrival of every key the published rows do not have, marked with its commit."""
    existing = _possible_matches(_published(batch.sparkSession, root, table), table, profile.bounds)
    fresh = keep_last(batch, table.keys, order).join(existing, list(table.keys), "left_anti")
    if "kafka_offset" in table.schema.fieldNames() and "kafka_offset" not in batch.columns:
        fresh = fresh.withColumn("kafka_offset", F.lit(None).cast("bigint"))
    return fresh.withColumn(COMMIT, F.lit(seq).cast("bigint"))


def _write_part(rows: DataFrame, root: str, table: LakeTable, part: str) -> None:
    """Write under ``part=``; the rebalance merges small outputs and splits a hot partition.

    A missing value in a required column fails the batch.
    """
    def value(field: T.StructField) -> Column:
        cast = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            missing = F.raise_error(F.lit(f"{table.name}: {field.name} is missing"))
            cast = F.coalesce(cast, missing.cast(field.dataType))
        return cast.alias(field.name)

    day = F.to_date(table.time_column).alias(table.day_column)
    laid_out = rows.select(*[value(f) for f in table.schema.fields], COMMIT, day)
    columns = [table.day_column, table.partition_column]
    (
        laid_out.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .partitionBy(*columns)
        .parquet(f"{_path(root, table, 'data')}/part={part}")
    )


def _part_rows(spark: SparkSession, root: str, table: LakeTable, part: str) -> int:
    """Rows of a written part, counted from the files' footers."""
    return spark.read.schema(_data_schema(table)).parquet(f"{_path(root, table, 'data')}/part={part}").count()


def _log_row(spark: SparkSession, table: LakeTable, seq: int, operation: str, values: dict) -> DataFrame:
    row = dict.fromkeys(LOG.fieldNames())
    row.update(values, commit_seq=seq, operation=operation, table_name=table.name, commit_ts=datetime.now(timezone.utc))
    return spark.createDataFrame([tuple(row[n] for n in LOG.fieldNames())], LOG).coalesce(1)


def _commit(spark: SparkSession, root: str, table: LakeTable, seq: int, **values) -> bool:
    """Publishes a part under commit number ``seq``; False if the number is taken."""
    try:
        _log_row(spark, table, seq, "append", values).write.mode("errorifexists").parquet(_log_folder(root, table, seq))
        return True
    except AnalysisException as taken:
        if taken.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        return False


def _note_error(spark: SparkSession, root: str, table: LakeTable, seq: int, **values) -> None:
    """Errors stand beside the commits and take no number from them."""
    _log_row(spark, table, seq - 1, "error", values).write.mode("append").parquet(_log_folder(root, table, 0))


def committed_offsets(spark: SparkSession, root: str, table: LakeTable) -> dict[str, int]:
    """Next offset per ``topic.partition`` as of the last commit; empty for a new table.

    Offsets of partitions a batch did not touch are carried along.
    """
    row = (
        commit_log(spark, root, table)
        .filter(F.col("operation") == "append")
        .agg(F.max_by("offsets", "commit_seq").alias("offsets"))
        .first()
    )
    return dict(row["offsets"] or {})


# --- versions ---------------------------------------------------------------------------------

def list_snapshots(spark: SparkSession, root: str, table: LakeTable) -> DataFrame:
    """(snapshot_id, timestamp, operation) of the versions kept, oldest first."""
    return (
        commit_log(spark, root, table).filter(F.col("operation") == "append")
        .select(F.col("commit_seq").alias("snapshot_id"), F.col("commit_ts").alias("timestamp"), "operation")
        .orderBy("snapshot_id")
    )


def resolve_snapshot(
    spark: SparkSession, root: str, table: LakeTable, snapshot_id: int | None, as_of: datetime | None
) -> int:
    """The version asked for: exactly one of an id, or an instant it must not be newer than."""
    if (snapshot_id is None) == (as_of is None):
        raise ValueError("give exactly one of snapshot_id and as_of")
    snapshots = list_snapshots(spark, root, table)
    if as_of is not None:
        found = snapshots.filter(F.col("timestamp") <= F.lit(as_of)).agg(F.max("snapshot_id")).first()[0]
        if found is None:
            raise ValueError(f"{table.name} has no snapshot up to {as_of.isoformat()}")
        return found
    if snapshots.filter(F.col("snapshot_id") == snapshot_id).isEmpty():
        raise ValueError(f"{table.name} has no snapshot {snapshot_id}")
    return snapshot_id


def scan_as_of(
    spark: SparkSession,
    root: str,
    table: LakeTable,
    *,
    snapshot_id: int | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """The table as it was at a version: rows are only ever added, so older parts are all there was."""
    seq = resolve_snapshot(spark, root, table, snapshot_id, as_of)
    return _published(spark, root, table, seq).filter(F.col(COMMIT) <= seq).select(*_rows(table))


def refresh_copy(
    spark: SparkSession, root: str, target: str, tables: Sequence[LakeTable] = schemas.LAKE_TABLES
) -> dict[str, int]:
    """Full copy of every table that exists into ``target``; rows copied per table."""
    counts = {}
    for table in tables:
        if not table_exists(spark, root, table):
            continue
        path = f"{target.rstrip('/')}/{table.name.replace('.', '/')}"
        rows = read_table(spark, root, table).drop(table.day_column)
        rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
        counts[table.name] = spark.read.parquet(path).count()
    return counts


# --- copies of touched days -----------------------------------------------------------------------

_COPIED = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("commit_seq", T.LongType())])


@dataclass(frozen=True)
class Copied:
    """What a refresh of one table brought: commits after ``since`` up to ``through``."""

    since: int
    through: int
    rows: int


def touched_days(spark: SparkSession, root: str, table: LakeTable, since: int, through: int) -> DataFrame:
    """The days that commits after ``since`` up to ``through`` added rows to: folder names alone tell."""
    parts = commit_log(spark, root, table).filter(
        (F.col("operation") == "append") & (F.col("commit_seq") > since) & (F.col("commit_seq") <= through)
    ).select("part")
    data = spark.read.schema(_data_schema(table)).parquet(data_path(root, table))
    return data.join(parts, "part", "left_semi").select(table.day_column).distinct()


def copy_path(target: str, table: LakeTable) -> str:
    return f"{target.rstrip('/')}/{table.name.replace('.', '/')}"


def read_copy(spark: SparkSession, target: str, table: LakeTable) -> DataFrame:
    schema = T.StructType([*table.schema.fields, T.StructField(table.day_column, T.DateType())])
    return spark.read.schema(schema).parquet(copy_path(target, table))


def overwrite_days(rows: DataFrame, path: str, day: str) -> None:
    """Write whole days, in a folder for each; days that ``rows`` does not have stay as they are."""
    (
        rows.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd").partitionBy(day).parquet(path)
    )


def noted(spark: SparkSession, target: str, table: LakeTable) -> int:
    """The last commit of ``table`` that what stands under ``target`` has; 0 at the start."""
    notes = f"{target.rstrip('/')}/noted"
    spark.createDataFrame([], _COPIED).write.mode("ignore").parquet(notes)
    rows = spark.read.schema(_COPIED).parquet(notes).filter(F.col("table_name") == table.name)
    return rows.agg(F.coalesce(F.max("commit_seq"), F.lit(0))).first()[0]


def note(spark: SparkSession, target: str, through: dict[str, int]) -> None:
    rows = spark.createDataFrame(sorted(through.items()), _COPIED).coalesce(1)
    rows.write.mode("append").parquet(f"{target.rstrip('/')}/noted")


def refresh_days(
    spark: SparkSession, root: str, target: str, tables: Sequence[LakeTable] = schemas.LAKE_TABLES
) -> dict[str, Copied]:
    """Bring the copies under ``target`` up to date, rewriting the days only that commits since the last refresh touched.

    How far a copy has come is noted after its days are written, so a refresh that was cut off is done again. Tables that do
    not exist are left out.
    """
    done = {}
    for table in tables:
        if not table_exists(spark, root, table):
            continue
        since = noted(spark, target, table)
        through = commit_log(spark, root, table).filter("operation = 'append'").agg(F.coalesce(F.max("commit_seq"), F.lit(0))).first()[0]
        rows = 0
        if through > since:
            days = touched_days(spark, root, table, since, through)
            now = _published(spark, root, table, through).select(*_rows(table)).join(days, table.day_column, "left_semi")
            overwrite_days(now, copy_path(target, table), table.day_column)
            rows = read_copy(spark, target, table).join(days, table.day_column, "left_semi").count()
            note(spark, target, {table.name: through})
        done[table.name] = Copied(since, through, rows)
    return done
