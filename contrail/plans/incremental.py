"""Refreshes that read what was added since the last one.

A kept view is the current view of a result table, stored in the shared scratch folder by date, with the list of
folders that it was made from. A refresh compares that list with the table's newest version, date by date:

* nothing changed: the date is left alone;
* batches were added, or a fold of batches that were known already replaced them: only the added batches are read, and
  reduced together with the kept rows;
* anything else (a replayed batch, a fold that also holds unknown batches of a table whose rows add up): the date is
  read again as a whole.

All dates that changed are brought up to date by one job, since a table may have many. So the rows read follow the change,
and a view equals the table's own at every step. The panels of a dashboard are derived again only where a view that they read
has changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators.rank import latest_by_key
from contrail.plans.dashboard import panel_frames
from contrail.session import scratch_dir
from contrail.streaming.panes import windows_of_view
from contrail.streaming.pipeline import ResultTables
from contrail.plans.tables import with_agg_key
from contrail.streaming.sinks import BATCH_COLUMN, DATE_COLUMN, KeyedTable, file_system, together, with_date_partition

#: The views that each panel reads; all others read the live view.
READS = {"kpi_summary": ("live", "alerts"), **dict.fromkeys(("alert_log", "worst_descent", "descent_histogram", "alerts_by_country"), ("alerts",)),
         **dict.fromkeys(("latest_country_window", "top_countries", "heatmap_countries", "trend_top_countries"), ("agg",))}
_NEWEST = "newest_batch"


class KeptView:
    """The current view of ``table``, kept from one ``refresh`` to the next; one user at a time."""

    def __init__(self, table: KeyedTable):
        self.table = table
        self._seen: dict[str | None, set[tuple]] = {}
        self._parts: dict[str | None, str] = {}
        self._replaced: list[str] = []
        self.read_folders: list[str] = []  # what the last refresh read of the table

    def refresh(self, spark: SparkSession) -> bool:
        """Bring the view up to the table's newest version; whether it changed."""
        now: dict[str | None, set[tuple]] = {}
        for e in self.table.entries(spark):
            now.setdefault(e[2], set()).add(tuple(e))
        newest = max((e[1] for part in self._seen.values() for e in part), default=-1)  # every batch up to it was seen
        self.read_folders, changed, old = [], False, []
        todo: dict[str | None, tuple[list[tuple], str | None]] = {}
        for date in {*now, *self._seen}:
            had, has = self._seen.get(date, set()), now.get(date, set())
            if had == has:
                continue
            added, gone = has - had, had - has
            folds = [e for e in added if e[0] == "fold"]
            known = [e for e in folds if e[1] <= newest]  # its rows are in the view
            reach = max((e[1] for e in folds), default=-1)
            whole = (any(e[1] > reach for e in gone) or any(e[0] == "batch" and e[1] <= newest for e in added)
                     or self.table.merge is not None and len(folds) > len(known))
            fresh = sorted(has if whole or date not in self._parts else added - set(known))
            if not whole and not fresh:
                continue
            old += [self._parts.pop(date)] if date in self._parts and not has else []
            if not has:
                changed = True
                continue
            todo[date] = fresh, None if whole else self._parts.get(date)
        if todo:
            self.read_folders = [e[3] for fresh, _ in todo.values() for e in fresh]
            old += [self._parts.pop(date) for date in todo if date in self._parts]
            self._parts |= self._store(spark, self._rows(spark, [e for fresh, _ in todo.values() for e in fresh],
                                                         [kept for _, kept in todo.values() if kept is not None]))
            changed = True
        self._seen = now
        if changed:  # what the view before this one was made of stays until the next change
            for path in self._replaced:
                fs, jpath = file_system(spark, path)
                fs.delete(jpath, True)
            self._replaced = old
        return changed

    def _store(self, spark: SparkSession, rows: DataFrame) -> dict[str | None, str]:
        """Write rows to a new folder; the path of each date in it (of an undated table: one)."""
        path = scratch_dir(spark, "kept-view")
        if not self.table.date_from:
            rows.write.parquet(path)
            return {None: path}
        dated = with_date_partition(rows, self.table.date_from)
        together(dated, [DATE_COLUMN, *self.table.keys]).write.partitionBy(DATE_COLUMN).parquet(path)
        fs, root = file_system(spark, path)
        names = [st.getPath().getName() for st in fs.listStatus(root)]
        return {n.split("=", 1)[1]: f"{path}/{n}" for n in names if n.startswith(f"{DATE_COLUMN}=")}

    def _rows(self, spark: SparkSession, entries: Sequence[tuple], kept: Sequence[str]) -> DataFrame:
        """The reduced rows of some folders and of the rows kept so far; each with the batch that it came from."""
        t = self.table
        rows = t.read(spark, entries).drop(DATE_COLUMN).withColumn(_NEWEST, F.col(BATCH_COLUMN).cast("bigint")).drop(BATCH_COLUMN)
        if kept:
            rows = rows.unionByName(spark.read.parquet(*kept))
        if t.merge is not None:
            return rows.groupBy(*t.keys).agg(*t.merge(), F.max(_NEWEST).alias(_NEWEST))
        return latest_by_key(rows, list(t.keys), [_NEWEST, *t.order], [c for c in rows.columns if c not in t.keys])

    def view(self, spark: SparkSession) -> DataFrame:
        """The current rows as of the last refresh, with the columns of the table's own view."""
        if not self._parts:
            return self.table.current(spark).where(F.lit(False))
        return spark.read.parquet(*self._parts.values()).drop(_NEWEST)


class LiveDashboard:
    """A dashboard that is refreshed again and again: ``refresh`` returns all panels and tells which it derived anew."""

    def __init__(self, spark: SparkSession, tables: ResultTables, countries: list[str] | None = None):
        self.spark, self.tables, self.countries = spark, tables, countries
        self.views = {"live": KeptView(tables.live), "alerts": KeptView(tables.alerts),
                      "agg": KeptView(tables.panes if tables.panes.versions(spark) else tables.agg)}
        self.panels: dict[str, DataFrame] = {}
        self.derived: set[str] = set()

    def _agg(self) -> DataFrame:
        kept = self.views["agg"]
        view = kept.view(self.spark)
        return with_agg_key(windows_of_view(view)).select(*self.tables.agg.columns) if kept.table is self.tables.panes else view

    def refresh(self) -> dict[str, DataFrame]:
        if not self.panels and self.tables.panes.versions(self.spark) and self.views["agg"].table is self.tables.agg:
            self.views["agg"] = KeptView(self.tables.panes)
        touched = {name for name, v in self.views.items() if v.refresh(self.spark)}
        live, alerts = (self.views[n].view(self.spark) for n in ("live", "alerts"))
        frames = panel_frames(live, self._agg(), alerts, countries=self.countries)
        self.derived = {p for p in frames if not self.panels or touched & set(READS.get(p, ("live",)))}
        self.panels = {p: frames[p] if p in self.derived else self.panels[p] for p in frames}
        return self.panels
