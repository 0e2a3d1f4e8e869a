"""Incremental ingest by high-water mark, its preview, and freshness of the copied tables."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftlens.config import EMPTY_MARKS
from shiftlens.functions.columns import HOUR, floor_to, to_ts, to_us
from shiftlens.sources.site import Site, union_all


def high_water(target: DataFrame, ts: str, cutoff: str | None = None) -> DataFrame:
    """One row per line: newest copied time (before the cutoff where one is given)."""
    if cutoff is not None:
        target = target.filter(F.col(ts) < F.lit(cutoff).cast("timestamp_ntz"))
    return target.groupBy("line_id").agg(F.max(ts).alias("mark"))


def pending(
    source: DataFrame, target: DataFrame, ts: str, cutoff: str, bound_mark: bool = False,
    empty_mark: str | None = None,
) -> DataFrame:
    """Source rows with mark < ts < cutoff.  Strict on both sides, so a re-run adds nothing.

    A line without any copied row gets nothing, unless ``empty_mark`` gives a start.
    The cutoff and the oldest mark of all lines are literals and reach the scan, so only the new
    part of the source is read; the mark itself is one row per line.
    """
    limit = F.lit(cutoff).cast("timestamp_ntz")
    marks = high_water(target, ts, cutoff if bound_mark else None)
    source = source.filter(F.col(ts) < limit)
    mark = F.col("mark")
    if empty_mark is None:
        oldest = marks.agg(F.min("mark")).first()[0]  # none, if nothing was copied: then nothing is pending
        source = source.filter(F.col(ts) > F.lit(oldest).cast("timestamp_ntz"))
    rows = source.join(F.broadcast(marks), "line_id", "left")
    if empty_mark is not None:
        mark = F.coalesce(mark, F.lit(empty_mark).cast("timestamp_ntz"))
    return rows.filter(F.col(ts) > mark).drop("mark")


def append(source: DataFrame, target_path: str, target: DataFrame, ts: str, cutoff: str, **options) -> None:
    """Append the pending rows; the target stays partitioned by line."""
    pending(source, target, ts, cutoff, **options).write.mode("append").partitionBy("line_id").parquet(target_path)


def plan_tables(plan: Mapping[str, Sequence[tuple[str, str, str]]]) -> dict[str, tuple[str, str, list[str]]]:
    """Table -> (group, time column, lines that copy it), in the order of the plan."""
    out: dict[str, tuple[str, str, list[str]]] = {}
    for line, entries in plan.items():
        for group, table, ts in entries:
            out.setdefault(table, (group, ts.lower(), []))[2].append(line)
    return out


LOG, ENTRY = "_runs", "line_id string, sub_system string, table_name string, mark timestamp_ntz, added long"
Marks = Mapping[str, datetime | None]


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def run_log(spark: SparkSession, root: str) -> DataFrame:
    """run and ENTRY of every committed run: one row per table and line of the plan."""
    folder = f"{root}/{LOG}"
    if not _exists(spark, folder):
        return spark.createDataFrame([], "run string, " + ENTRY)
    return spark.read.schema(ENTRY + ", run string").parquet(folder).select("run", *[c.split()[0] for c in ENTRY.split(", ")])


def copied(spark: SparkSession, root: str, table: str, source: DataFrame) -> DataFrame:
    """What committed runs have copied of a table.  Folders of a run that died are not read."""
    if not _exists(spark, f"{root}/{table}"):
        return source.limit(0)
    runs = [r[0] for r in run_log(spark, root).select("run").distinct().collect()]  # one per run
    names = source.columns
    schema = T.StructType([*source.schema.fields, T.StructField("run", T.StringType())])
    whole = spark.read.schema(schema).parquet(f"{root}/{table}")
    return whole.filter(F.col("run").isin(runs)).select(*names)


def table_marks(log: DataFrame) -> dict[str, dict[str, datetime]]:
    """Table -> line -> newest copied time by the log: one value per planned table and line."""
    out: dict[str, dict[str, datetime]] = {}
    for r in log.filter("mark IS NOT NULL").groupBy("table_name", "line_id").agg(F.max("mark").alias("mark")).collect():
        out.setdefault(r["table_name"], {})[r["line_id"]] = r["mark"]
    return out


def starts(lines: Sequence[str], marks: Marks, empty_mark: str | None) -> dict[str, Column]:
    """Line -> the time after which its rows are pending; a line without a mark has one only by ``empty_mark``."""
    known = {x: str(marks[x]) if marks.get(x) else empty_mark for x in lines}
    return {x: F.lit(m).cast("timestamp_ntz") for x, m in known.items() if m is not None}


def after_marks(source: DataFrame, ts: str, cutoff: str, since: Mapping[str, Column]) -> DataFrame:
    """Rows of each line with mark < ts < cutoff.  All bounds are literals, so they reach the scan."""
    wanted = F.lit(False)
    for line, mark in since.items():
        wanted = wanted | ((F.col("line_id") == line) & (F.col(ts) > mark))
    return source.filter((F.col(ts) < F.lit(cutoff).cast("timestamp_ntz")) & wanted)


def commit_run(spark: SparkSession, root: str, run: str, entries: DataFrame) -> None:
    """Write the log entry of a run.  It comes last: without it the run's folders do not count."""
    entries.coalesce(1).write.mode("overwrite").parquet(f"{root}/{LOG}/run={run}")


def run_plan(
    spark: SparkSession, plan: Mapping[str, Sequence[tuple[str, str, str]]], source: Callable[[str], DataFrame], root: str,
    cutoff: str, run: str, tables: Collection[str] | None = None, empty_marks: Mapping[str, str] = EMPTY_MARKS,
) -> DataFrame:
    """Copy every planned table: all lines at once, each from its own mark; counts of what was added.

    ``tables`` restricts the run.  Marks come from the log of committed runs, not from the target.
    Added rows are files of their own under ``run=<run>``, so their counts and new marks read footers;
    the log entry is written last.  A run that dies leaves folders that no one reads; the next run
    copies the same rows again.  Returns line_id, sub_system, table_name, added, with a row "total" per line.
    """
    if not run_log(spark, root).filter(F.col("run") == run).isEmpty():
        raise ValueError(f"run {run} is committed")
    marks, entries = table_marks(run_log(spark, root)), []
    for table, (group, ts, lines) in plan_tables(plan).items():
        if tables is not None and table not in tables:
            continue
        rows = source(table)
        new = after_marks(rows, ts, cutoff, starts(lines, marks.get(table, {}), empty_marks.get(table)))
        folder = f"{root}/{table}/run={run}"
        new.write.mode("overwrite").partitionBy("line_id").parquet(folder)
        entries.append(_entry(spark, spark.read.schema(rows.schema).parquet(folder), lines, group, table, ts))
    commit_run(spark, root, run, union_all(entries))
    return with_totals(spark.read.schema(ENTRY).parquet(f"{root}/{LOG}/run={run}").drop("mark"), "added")


def _entry(spark: SparkSession, rows: DataFrame, lines: Sequence[str], group: str, table: str, ts: str) -> DataFrame:
    added = rows.groupBy("line_id").agg(F.count(F.lit(1)).alias("n"), F.max(ts).cast("timestamp_ntz").alias("mark"))
    known = spark.createDataFrame([(x,) for x in lines], "line_id string")
    return known.join(added, "line_id", "left").select(
        "line_id", F.lit(group).alias("sub_system"), F.lit(table).alias("table_name"), "mark", F.coalesce("n", F.lit(0)).alias("added")
    )


def adopt(spark: SparkSession, plan: Mapping[str, Sequence[tuple[str, str, str]]], rows: Callable[[str, str], DataFrame], root: str, run: str, tables: Collection[str]) -> None:
    """Take over tables that were copied before there was a log; ``rows(table, time column)`` reads them."""
    entries = []
    for table, (group, ts, lines) in plan_tables(plan).items():
        if table in tables:
            old = rows(table, ts).filter(F.col("line_id").isin(lines))
            old.write.mode("overwrite").partitionBy("line_id").parquet(f"{root}/{table}/run={run}")
            entries.append(_entry(spark, spark.read.schema(old.schema).parquet(f"{root}/{table}/run={run}"), lines, group, table, ts))
    commit_run(spark, root, run, union_all(entries))


def preview_plan(
    spark: SparkSession, plan: Mapping[str, Sequence[tuple[str, str, str]]], source: Callable[[str], DataFrame], log: DataFrame,
    cutoff: str, tables: Collection[str] | None = None, empty_marks: Mapping[str, str] = EMPTY_MARKS,
) -> DataFrame:
    """What a run would copy, by the same plan and log: mark, pending rows and status of every planned table and line.

    Each table is scanned once, for its pending rows only; a line without a mark is EMPTY.
    """
    marks, shown = table_marks(log), []
    for table, (group, ts, lines) in plan_tables(plan).items():
        if tables is not None and table not in tables:
            continue
        own = marks.get(table, {})
        found = after_marks(source(table), ts, cutoff, starts(lines, own, empty_marks.get(table))).groupBy("line_id").agg(F.count(F.lit(1)).alias("pending"))
        known = spark.createDataFrame([(x, own.get(x)) for x in lines], "line_id string, local_max timestamp_ntz")
        shown.append(known.join(F.broadcast(found), "line_id", "left").select(
            "line_id", F.lit(group).alias("sub_system"), F.lit(table).alias("table_name"), "local_max", F.coalesce("pending", F.lit(0)).alias("rows_to_insert")
        ))
    status = F.when(F.col("local_max").isNull(), "EMPTY").when(F.col("rows_to_insert") == 0, "up-to-date").otherwise("ready")
    return with_totals(union_all(shown).withColumn("status", status), "rows_to_insert")


def with_totals(report: DataFrame, count: str) -> DataFrame:
    """The report and one more row per line with the sum of its tables."""
    total = report.groupBy("line_id").agg(F.sum(count).alias(count))
    rest = [F.lit("total" if c in ("sub_system", "table_name") else None).cast(report.schema[c].dataType).alias(c) for c in report.columns if c not in ("line_id", count)]
    return report.unionByName(total.select("line_id", count, *rest))


def write_hourly(rows: DataFrame, folder: str, ts: str, start: str | None = None) -> None:
    """Wide rows as one folder per line and hour, from ``start`` on where it is given; a re-run replaces the hours it writes."""
    if start is not None:
        rows = rows.filter(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    hour = F.date_format("batch_hour", "yyyyMMdd_HH")
    batches = hourly_batches(rows, ts).withColumn("batch_hour", hour)
    batches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("line_id", "batch_hour").parquet(folder)


def hourly_batches(rows: DataFrame, ts: str) -> DataFrame:
    """Hour of each row, the unit in which wide rows are copied.

    A row exactly on an hour boundary belongs to the hour it opens (none is lost).
    """
    return rows.withColumn("batch_hour", to_ts(floor_to(to_us(F.col(ts)), HOUR)))


def freshness(site: Site, now: Column) -> DataFrame:
    """Newest data per table: last closed block and open blocks, last real overlay, last samples."""
    blocks = site.table("status_blocks").groupBy("line_id").agg(
        F.max(F.when(F.col("end_ts").isNotNull(), F.col("end_ts"))).alias("latest"),
        F.count_if(F.col("end_ts").isNull()).alias("extra"),
    ).withColumn("table_name", F.lit("status_blocks"))
    overlays = site.table("downtime_overlays").groupBy("line_id").agg(
        F.max(F.when(F.col("start_ts") <= now, F.col("start_ts"))).alias("latest"), F.count(F.lit(1)).alias("extra")
    ).withColumn("table_name", F.lit("downtime_overlays"))
    samples = [
        site.table(t).groupBy("line_id").agg(F.max("t_stamp").alias("latest"), F.lit(0).cast("long").alias("extra"))
        .withColumn("table_name", F.lit(t))
        for t in ("output_stats", "ppm", "fof_changes")
    ]
    return union_all([blocks, overlays, *samples])


def to_recompute(targets: DataFrame, published: DataFrame, true_end: Column) -> DataFrame:
    """Target shifts without a result newer than the end of the latest complete shift."""
    current = published.filter(F.col("generated_at") >= true_end).select("line_id", "ord")
    return targets.join(current, ["line_id", "ord"], "left_anti")
