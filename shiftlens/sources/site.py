"""A site: line profiles plus a lazy table per logical name, all lines in one DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlens.config import DEFAULT_LINES, SPC_LOOKBACK_DAYS, LineProfile
from shiftlens.functions.ordered import Chunking
from shiftlens.sources import historian
from shiftlens.sources.staging import Stage


class Site:
    """``tables(logical)`` returns canonical columns with a ``line_id``; see historian.CANONICAL."""

    def __init__(
        self,
        spark: SparkSession,
        tables: Callable[[str], DataFrame],
        lines: Sequence[LineProfile] = DEFAULT_LINES,
        chunking: Chunking | None = None,
        stored_schedule: DataFrame | None = None,
        stage_sources: bool = False,
        spc_lookback_days: int = SPC_LOOKBACK_DAYS,
    ):
        # Historian times carry no zone; they are read as UTC so that arithmetic is exact.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.lines = tuple(lines)
        self.chunking = chunking or Chunking()
        self.stored_schedule = stored_schedule
        self._tables = tables
        self._stage_sources = stage_sources
        #: History that SPC reads, in days before the newest sample of a counter table; 0 is all of it.
        self.spc_lookback_days = spc_lookback_days
        self._stage, self._variant = Stage(spark), ""
        bounds = {p.bounds for p in self.lines}
        if len(bounds) != 1:
            raise ValueError("lines of one site share their shift boundaries; use one Site per pattern")
        self.bounds = bounds.pop()

    @classmethod
    def from_reader(
        cls,
        spark: SparkSession,
        read: Callable[[LineProfile, str], DataFrame],
        lines: Sequence[LineProfile] = DEFAULT_LINES,
        **options,
    ) -> Site:
        """Scan one physical table per line and logical name, aliased and united."""
        return cls(spark, lambda logical: historian.scan(lines, logical, read), lines, **options)

    @classmethod
    def from_events(cls, spark: SparkSession, data_dir: str, lines=DEFAULT_LINES, **options) -> Site:
        """Historian tables derived by Spark from the ``events`` table of ``data_dir``."""
        from shiftlens.sources import event_lines

        events = spark.read.parquet(f"{data_dir}/events.parquet")
        chunking = options.pop("chunking", None) or Chunking()
        return cls(
            spark, event_lines.tables(events, lines, chunking), lines, chunking=chunking,
            stage_sources=True, **options,
        )

    def table(self, logical: str) -> DataFrame:
        if self._stage_sources:
            return self.stage(f"source.{logical}", lambda: self._tables(logical))
        return self._tables(logical)

    def stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A shared intermediate result, computed once per site (see staging)."""
        return self._stage.get(self._variant + name, make)

    def prepare(self, logical: Sequence[str], at_once: int = 4) -> None:
        """Make the staged sources that many queries share, a few at the same time: each alone leaves executors idle."""
        if self._stage_sources:
            with ThreadPoolExecutor(at_once) as pool:
                list(pool.map(self.table, logical))

    def _derived(self, variant: str, tables: Callable[[str], DataFrame] | None = None, lines: Sequence[LineProfile] | None = None, **options) -> Site:
        """A site that keeps its results beside those of this one, so that one ``close`` deletes both."""
        settings = {"spc_lookback_days": self.spc_lookback_days} | options
        site = Site(self.spark, tables or self.table, lines or self.lines, self.chunking, self.stored_schedule, **settings)
        site._stage, site._variant = self._stage, f"{self._variant}{variant}/"
        return site

    def with_lookback(self, days: int) -> Site:
        """The same site with another ``spc_lookback_days``."""
        return self._derived(f"lookback={days}", spc_lookback_days=days)

    def with_schedule(self, stored: DataFrame) -> Site:
        """The same site with a stored schedule, whose non-production days are left out like declared ones."""
        site = self._derived("schedule")
        site.stored_schedule = stored
        return site

    def since(self, start: str) -> Site:
        """The same site reading only data from the shift of ``start`` on; the bound is pushed to every scan.

        The bound is the start of that shift, so no shift is cut; open blocks, which have no end, stay.

        A refresh of the current week needs 14 shifts, its 13 baseline shifts, five weeks for the
        weekly outliers and the SPC lookback, not the whole history.  Reasons are found by key and
        stay whole.
        """
        edge = shift_edge(start, self.bounds)

        def table(logical: str) -> DataFrame:
            df = self.table(logical)
            if logical == "fof_changes":
                return df
            if logical == "status_blocks":
                return df.filter(F.col("end_ts").isNull() | (F.col("end_ts") >= F.lit(edge).cast("timestamp_ntz")))
            return historian.window_filter(df, "start_ts" if logical == "downtime_overlays" else "t_stamp", edge, None)

        return self._derived(f"since={edge.replace(' ', 'T').replace(':', '')}", table)

    def close(self) -> None:
        """Delete the staged tables of this site."""
        self._stage.drop()

    def only(self, line_ids: Sequence[str]) -> Site:
        """The same site restricted to some lines; the filter reaches every scan."""
        keep = [p for p in self.lines if p.line_id in set(line_ids)]
        return self._derived(
            "only=" + "+".join(p.line_id for p in keep),
            lambda logical: self.table(logical).filter(F.col("line_id").isin(list(line_ids))), keep,
        )

    # -- small dimensions, sized by the configuration --------------------------------

    @cached_property
    def excluded(self) -> DataFrame:
        """(line_id, day) to leave out: declared days and the stored schedule's non-production days."""
        rows = [(p.line_id, d) for p in self.lines for d in p.excluded_days]
        declared = self.spark.createDataFrame(rows, "line_id string, day_text string").select(
            "line_id", F.to_date("day_text").alias("day")
        )
        if self.stored_schedule is None:
            return declared.distinct()
        stored = self.stored_schedule.filter(F.col("classification") == "non_production")
        return declared.union(stored.select("line_id", F.to_date("day").alias("day"))).distinct()

    @cached_property
    def lines_dim(self) -> DataFrame:
        return self.spark.createDataFrame(
            [(p.line_id, p.label) for p in self.lines], "line_id string, line string"
        )

    @cached_property
    def segments_dim(self) -> DataFrame:
        rows = [
            (p.line_id, i, s.key, s.label, s.color)
            for p in self.lines
            for i, s in enumerate(p.segments)
        ]
        return self.spark.createDataFrame(
            rows, "line_id string, seg_order int, segment string, segment_label string, segment_color string"
        )

    @cached_property
    def clusters_dim(self) -> DataFrame:
        rows = [
            (p.line_id, s.key, i, name)
            for p in self.lines
            for s in p.segments
            for i, (name, _) in enumerate(s.clusters)
        ]
        return self.spark.createDataFrame(
            rows, "line_id string, segment string, cluster_order int, cluster string"
        )

    @cached_property
    def categories_dim(self) -> DataFrame:
        from shiftlens.config import CATEGORIES

        return self.spark.createDataFrame(
            [(i, k, lab, col) for i, (k, lab, col) in enumerate(CATEGORIES)],
            "cat_order int, category string, category_label string, category_color string",
        )

    @cached_property
    def panels_dim(self) -> DataFrame:
        rows = [
            (p.line_id, i, x.key, x.short, x.table, x.n_lanes, x.divisor, x.min_resets,
             x.min_subgroups, x.lane_mode, x.representative, x.dual, x.active_only)
            for p in self.lines
            for i, x in enumerate(p.panels)
            if p.has_table(x.table)
        ]
        return self.spark.createDataFrame(
            rows,
            "line_id string, panel_order int, panel string, panel_short string, counter_table string, "
            "n_lanes int, divisor int, min_resets int, min_subgroups int, lane_mode string, "
            "representative string, dual boolean, active_only boolean",
        )


def shift_edge(moment: str, bounds: tuple[int, int]) -> str:
    """The start of the shift that holds ``moment``, as text."""
    at = datetime.fromisoformat(moment)
    day = at.replace(hour=0, minute=0, second=0, microsecond=0)
    edges = [day + timedelta(days=d, hours=h) for d in (-1, 0) for h in bounds]
    return max(e for e in edges if e <= at).strftime("%Y-%m-%d %H:%M:%S")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
