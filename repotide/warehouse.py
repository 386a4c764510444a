"""The stored tables of many repositories, and the steps that fill them.

Each step reads stored tables, computes one or two and writes them under their
names, so the steps can run one after the other on their own schedule. Loads
keep what is stored and add what is new: ids stay, items landed again replace
their earlier state, and releases are replaced for the repositories given.
Metrics replace what was there. A table is replaced by writing its successor
beside it and then changing names, so a step that breaks off loses nothing.
Every table carries the ``by`` columns beside its declared ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from repotide.functions.time import AsOf, day_or_today, utc_day
from repotide.operators.keys import (
    constraint_report,
    lookup,
    new_members,
    numbered_after,
    one_per_key,
    orphans,
    without_known,
)
from repotide.operators.quality import require
from repotide.plans import contribution, log, open_items, productivity, refresh, size, tracker
from repotide.schemas import FOREIGN_KEYS, TABLES
from repotide.session import pinned
from repotide.sources.clustered import open_bucketed, reopen_bucketed, write_bucketed
from repotide.sources.tables import (
    MONTH,
    collisions,
    folder_by_folder,
    month_of,
    read_if_any,
    replace_days,
    scan_table,
    union_sources,
    unseen_rows,
)

COMMIT = "commit_hash_id"
# The daily tables and their day.
DAILY = {
    "project_size_per_day": "date",
    "project_productivity_per_day": "date",
    "bus_factor_per_day": "date",
    "issue_spoilage_per_day": "start",
    "pull_request_spoilage_per_day": "start",
    "issue_density_per_day": "start",
}
# Tables with one row per commit, which ``buckets`` lays out for their joins.
PER_COMMIT = ["commit_logs", "project_size_per_commit", "project_productivity_per_commit"]


class Warehouse:
    """Stored tables under one folder. One process at a time may write to it."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        by: Mapping[str, T.DataType] | None = None,
        as_of: AsOf = None,
        partition_by: Sequence[str] = (),
        monthly: bool = False,
        buckets: int = 0,
    ) -> None:
        """``by`` gives the columns that tell repositories apart; none for one.

        ``partition_by`` names those of them that become folders; choose one
        with few values, such as a hash bucket of the repository. ``monthly``
        lays daily tables out by month, which the ``refresh_`` steps need.
        ``buckets`` lays the tables per commit out in that many buckets of the
        commit, so that joining them moves no rows; it is settled by the first
        use of the folder, and these tables then have no folders of their own.
        """
        self.spark = spark
        self.root = root.rstrip("/")
        self.by_types = dict(by or {})
        self.by = list(self.by_types)
        self.as_of = as_of
        self.partition_by = list(partition_by)
        self.monthly = monthly
        self.buckets = buckets
        self.commit_key = [*self.by, COMMIT]
        self._settle_buckets()

    def _schema(self, name: str) -> T.StructType:
        own = [T.StructField(column, kind, False) for column, kind in self.by_types.items()]
        return T.StructType([*own, *TABLES[name].fields])

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _settle_buckets(self) -> None:
        """Note the number of buckets in the folder, or hold it against the one noted there."""
        place, files = self._files(f"{self.root}/_buckets")
        if files.exists(place):
            (noted,) = [int(f.getPath().getName()) for f in files.listStatus(place)]
        else:
            stored = any(files.exists(self._files(self._path(name))[0]) for name in PER_COMMIT)
            noted = 0 if stored or not self.buckets else self.buckets
            if noted:
                files.create(self._files(f"{self.root}/_buckets/{noted}")[0]).close()
        if noted != self.buckets:
            raise ValueError(f"{self.root} is laid out in {noted} buckets, not {self.buckets}")

    def _in_buckets(self, name: str) -> bool:
        return bool(self.buckets) and name in PER_COMMIT

    def _row_order(self, name: str) -> list[str]:
        """What rows are sorted by inside a file, so that filters skip row groups."""
        columns = self._schema(name).names
        return [*self.by, DAILY[name] if name in DAILY else columns[len(self.by)]]

    def read(self, name: str, checked: bool = False) -> DataFrame:
        """A stored table.

        Rows were checked when they were written, so the scan is bare and
        filters prune folders and files. ``checked`` tests every row again.
        """
        self._finish(name)
        model = self._schema(name)
        if self._in_buckets(name):
            table = open_bucketed(self.spark, self._path(name), model, self.commit_key, self.buckets)
            return require(table, model) if checked else table
        return self._bare(name, scan_table(self.spark, self._path(name), model, checked))

    def _bare(self, name: str, table: DataFrame) -> DataFrame:
        """Without the folder column of monthly tables."""
        return table.select(*self._schema(name).names) if self.monthly and name in DAILY else table

    def sql(self, text: str) -> DataFrame:
        """Run an SQL text over the stored tables, without leaving views behind."""
        session = self.spark.newSession()
        for name in TABLES:
            table = self._stored_if_any(name)
            if table is not None:
                session.read.schema(table.schema).parquet(self._path(name)).createOrReplaceTempView(name)
        return session.sql(text)

    def _stored(self, name: str) -> DataFrame:
        return self.read(name)

    def _stored_if_any(self, name: str) -> DataFrame | None:
        self._finish(name)
        table = read_if_any(self.spark, self._path(name), self._schema(name))
        if table is not None and self._in_buckets(name):
            return self.read(name)
        return None if table is None else self._bare(name, table)

    def _files(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _finish(self, name: str) -> None:
        """Complete a replacement that broke off after the old table went."""
        place, files = self._files(self._path(name))
        following, _ = self._files(f"{self._path(name)}.next")
        done, _ = self._files(f"{self._path(name)}.next/_SUCCESS")
        if not files.exists(place) and files.exists(done):
            files.rename(following, place)

    def _append(self, name: str, df: DataFrame) -> None:
        self._finish(name)
        if self._in_buckets(name):
            rows = require(df, self._schema(name))
            write_bucketed(rows, self._path(name), self.commit_key, self.buckets)
            return
        if self.partition_by:
            rows = require(df, self._schema(name))
            rows = rows.sortWithinPartitions(*dict.fromkeys([*self.partition_by, *self._row_order(name)]))
        else:
            # sorted before the check, past which Spark no longer knows of an order that is there
            rows = require(df.sortWithinPartitions(*self._row_order(name)), self._schema(name))
        rows.write.mode("append").partitionBy(*self.partition_by).parquet(self._path(name))

    def _replace(self, name: str, df: DataFrame) -> None:
        """Write the successor beside the table, then put it in its place."""
        following, folders = f"{self._path(name)}.next", list(self.partition_by)
        rows = require(df, self._schema(name))
        by_month = self.monthly and name in DAILY
        if by_month:
            rows = rows.withColumn(MONTH, month_of(DAILY[name]))
            folders.append(MONTH)
        place, files = self._files(self._path(name))
        if self._in_buckets(name):
            files.delete(self._files(following)[0], True)
            write_bucketed(rows, following, self.commit_key, self.buckets)
        else:
            if by_month:
                rows = folder_by_folder(rows, folders, self._row_order(name))
            else:
                rows = rows.sortWithinPartitions(*dict.fromkeys([*folders, *self._row_order(name)]))
            rows.write.mode("overwrite").partitionBy(*folders).parquet(following)
        files.delete(place, True)
        self._finish(name)
        if self._in_buckets(name):
            for path in (following, self._path(name)):
                reopen_bucketed(self.spark, path, self.commit_key, self.buckets)
        self.spark.catalog.refreshByPath(self._path(name))

    def orphans(self) -> DataFrame:
        """References that point nowhere: table, column, repository and value.

        Tables not stored yet are passed over, as is the committer that stands
        for a day without commits.
        """
        reports = []
        for table, column, target in FOREIGN_KEYS:
            child, parent = self._stored_if_any(table), self._stored_if_any(target)
            if child is None or parent is None:
                continue
            lost = orphans(child, column, parent, "id", self.by).withColumnRenamed(column, "value")
            reports.append(
                lost.filter(F.col("value") != contribution.NOBODY).select(
                    F.lit(table).alias("table"), F.lit(column).alias("column"), *self.by, "value"
                )
            )
        return union_sources(reports)

    def constraints(self) -> DataFrame:
        """Ids that are there twice and references that point nowhere, in one shuffle."""
        tables = {}
        for name in TABLES:
            table = self._stored_if_any(name)
            if table is not None:
                tables[name] = table
        if "bus_factor_per_day" in tables:
            tables["bus_factor_per_day"] = tables["bus_factor_per_day"].filter(
                F.col("committer_id") != contribution.NOBODY
            )
        ids = {name: "id" for name in TABLES if "id" in TABLES[name].names and name in tables}
        return constraint_report(tables, ids, FOREIGN_KEYS, self.by)

    # --- loads ----------------------------------------------------------------

    def load_log(self, revisions: DataFrame, tags: DataFrame, order: Sequence[str]) -> None:
        """Normalise and append the revisions that have no log row yet.

        A revision that landed more than once counts once, in its first place.
        ``tags`` are all tags of the repositories they belong to; releases of
        other repositories stay.
        The log itself is written last. A load that breaks off is thus done
        again, with the ids of the hashes and people it had already stored.
        """
        # dimensions, lookups and the log itself all read it
        revisions = pinned(one_per_key(revisions, [*self.by, "commit_hash"], order))
        hashes, logs = self._stored_if_any("commit_hashes"), self._stored_if_any("commit_logs")
        loaded = None
        if hashes is not None and logs is not None:
            loaded = log.loaded_hashes(hashes, logs, self.by)
        fresh = log.fresh_revisions(revisions, loaded, order, self.by)
        people = [
            ("commit_hashes", "commit_hash", [], True),
            ("authors", "author_email", ["author"], False),
            ("committers", "committer_email", ["committer"], False),
        ]
        for name, key, attributes, distinct in people:
            stored = self._stored_if_any(name)
            members = new_members(fresh, key, attributes, order, self.by, stored, distinct)
            self._append(name, members)
        dims = [self._stored(name) for name, *_ in people]
        found, earlier = log.releases(tags, dims[0], self.by), self._stored_if_any("releases")
        if earlier is not None and self.by:
            others = without_known(earlier, tags.select(*self.by).distinct(), self.by)
            found = found.unionByName(others.select(*found.columns))
        self._replace("releases", found)
        self._append("commit_logs", log.commit_logs(fresh, *dims, self.by, wide=revisions, distinct=True))

    def load_log_stream(
        self, revisions: DataFrame, tags: DataFrame, order: Sequence[str], checkpoint: str
    ) -> StreamingQuery:
        """``load_log`` for each batch of a stream, until what has landed is loaded.

        ``order`` must run on from batch to batch, as the place in the log does.
        A batch replayed after a failure finds its rows stored.
        """

        def load(batch: DataFrame, _batch_id: int) -> None:
            # the load reads its input several times, the stream's files once
            batch.persist()
            try:
                self.load_log(batch, tags, order)
            finally:
                batch.unpersist()

        return (
            revisions.writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def rejected(self, kind: str) -> DataFrame:
        """Stored items (``issue`` or ``pull_request``) that the daily counts leave out."""
        return open_items.rejected_items(self._stored(f"{kind}s"), "created_at", "closed_at")

    def load_file_sizes(self, files: DataFrame) -> None:
        """Append measured files, with a ``commit_hash`` to resolve or a commit id.

        A file of a commit that landed more than once counts once. One that was measured
        otherwise before, in this load or an earlier one, fails the load;
        ``remeasured`` lists the latter.
        """
        stored = self._stored_if_any("file_size_per_commit")
        keys = [*self.by, COMMIT, "provider"]
        if stored is None and self._lands_as_stored(files):
            fresh = unseen_rows(self._with_ids(files), None, [*keys, "commit_hash"], "provider", keys)
        else:
            fresh = unseen_rows(self._resolved(files), stored, keys, "provider")
        self._append("file_size_per_commit", fresh)

    def _lands_as_stored(self, files: DataFrame) -> bool:
        """Whether files name their commit by hash and hold the types of the stored table."""
        kinds = {field.name: field.dataType for field in files.schema.fields}
        wanted = {f.name: f.dataType for f in self._schema("file_size_per_commit").fields if f.name != COMMIT}
        wanted["commit_hash"] = T.StringType()
        return COMMIT not in kinds and all(kinds.get(name) == kind for name, kind in wanted.items())

    def _with_ids(self, files: DataFrame) -> DataFrame:
        """Files with their commit's id beside its hash.

        Not null-safe, as no stored hash is null: the rows stay where this join moved them,
        and comparing those of a commit moves them no more.
        """
        key = [*self.by, "commit_hash"]
        ids = self._stored("commit_hashes").select(*key, F.col("id").alias(COMMIT))
        columns = self._schema("file_size_per_commit").names
        return files.join(ids, key, "left").select(*columns, "commit_hash")

    def remeasured(self, files: DataFrame) -> DataFrame:
        """The files that are stored with other measures."""
        stored = self._stored("file_size_per_commit")
        return collisions(self._resolved(files), stored, [*self.by, COMMIT, "provider"])

    def _resolved(self, files: DataFrame) -> DataFrame:
        if COMMIT not in files.columns:
            hashes = self._stored("commit_hashes")
            files = lookup(files, "commit_hash", hashes, "commit_hash", COMMIT, self.by, unique=True)
        model = self._schema("file_size_per_commit")
        return require(files, model)

    def load_issues(self, items: DataFrame) -> None:
        self._load_items("issue", items)

    def load_pull_requests(self, items: DataFrame) -> None:
        self._load_items("pull_request", items)

    def _load_items(self, kind: str, items: DataFrame) -> None:
        """Add new items and replace the facts of those landed again.

        Stored ids stay and new ones continue after them. Ids are appended
        first: a load that breaks off is done again with the same ids.
        """
        id_column, facts = f"{kind}_id", f"{kind}s"
        known = self._stored_if_any(f"{kind}_ids")
        latest = pinned(tracker.latest_items(items, id_column, self.by, known))
        unknown = F.col("id").isNull()
        for column in self.by:  # rows of no repository get no id, which the check of the facts finds
            unknown = unknown & F.col(column).isNotNull()
        places = [f"_order_{i}" for i in range(len(tracker.ITEM_ORDER))]
        members = numbered_after(latest.filter(unknown).drop("id"), places, self.by, known)
        self._append(f"{kind}_ids", members.select("id", *self.by, id_column))
        landed = latest.filter(~unknown).unionByName(members).select(
            *self.by, F.col("id").alias(f"{id_column}_key"), "created_at", "closed_at"
        )
        earlier = self._stored_if_any(facts)
        if earlier is not None:
            keys = [*self.by, f"{id_column}_key"]
            rest = without_known(earlier, landed.select(*keys), keys)
            landed = landed.unionByName(rest.select(*landed.columns))
        self._replace(facts, landed)

    # --- metrics ---------------------------------------------------------------

    def _log_days(self) -> DataFrame:
        logs = self._stored("commit_logs")
        day = utc_day(logs, "committed_datetime").alias("day")
        return logs.select(*self.by, COMMIT, "committer_id", day)

    def _with_log(self, name: str) -> DataFrame:
        return size.join_log(self._stored(name), self._log_days(), [*self.by, COMMIT])

    def _size_per_commit(self) -> None:
        files = self._stored("file_size_per_commit")
        per_commit = size.size_per_commit(files, COMMIT, self.by)
        self._replace("project_size_per_commit", per_commit)

    def project_size(self) -> None:
        self._size_per_commit()
        sizes = self._with_log("project_size_per_commit")
        daily = size.size_per_day(sizes, [COMMIT], self.by, self.as_of)
        self._replace("project_size_per_day", daily.withColumnRenamed("day", "date"))

    def _productivity_per_commit(self) -> None:
        sizes = self._stored("project_size_per_commit")
        changes = productivity.productivity_per_commit(sizes, [COMMIT], self.by, dense=True)
        self._replace("project_productivity_per_commit", changes)

    def project_productivity(self) -> None:
        self._productivity_per_commit()
        changes = self._with_log("project_productivity_per_commit")
        daily = productivity.productivity_per_day(changes, [COMMIT], self.by, self.as_of)
        self._replace("project_productivity_per_day", daily.withColumnRenamed("day", "date"))

    def bus_factor(self) -> None:
        changes = self._with_log("project_productivity_per_commit")
        daily = contribution.contribution_per_day(changes, self.by)
        self._replace("bus_factor_per_day", daily.withColumnRenamed("day", "date"))

    def issue_spoilage(self) -> None:
        self._spoilage("issue")

    def pull_request_spoilage(self) -> None:
        self._spoilage("pull_request")

    def _spans(self, kind: str) -> DataFrame:
        items = self._stored(f"{kind}s")
        return items.select(
            *self.by,
            utc_day(items, "created_at").alias("created"),
            utc_day(items, "closed_at").alias("closed"),
        )

    def _spoilage(self, kind: str) -> None:
        spans = self._spans(kind)
        daily = open_items.open_items_per_day(spans, self._log_days(), self.by, self.as_of)
        self._replace(f"{kind}_spoilage_per_day", daily)

    def issue_density(self) -> None:
        sizes = self._stored("project_size_per_day").withColumnRenamed("date", "day")
        counts = self._stored("issue_spoilage_per_day")
        density = open_items.issue_density_per_day(sizes, counts, self.by)
        self._replace("issue_density_per_day", density)

    # --- metrics brought up to date -------------------------------------------------

    # ``changed`` has one row per repository that a load touched: its first day (``since``),
    # see ``plans.refresh.touched``. Tables that were never built are built whole.

    def _refresh(self, name: str, changed: DataFrame, whole, work, days_back: int = 0, again: int = 0) -> None:
        """Work out the rows of a daily table from each repository's first touched day on."""
        if not self.monthly:
            raise ValueError("refresh needs tables laid out by month")
        stored, day = self._stored_if_any(name), DAILY[name]
        if stored is None:
            whole()
            return
        until = F.date_sub(day_or_today(self.as_of), days_back)
        dated = stored.select(*self.by, F.to_date(day).alias("day"))
        wanted = pinned(refresh.due(dated, changed, self.by, until, again=again))
        fresh = require(work(stored, wanted), self._schema(name))
        replace_days(fresh, stored, self._path(name), wanted, self.by, day, self.partition_by)
        self.spark.catalog.refreshByPath(self._path(name))

    def refresh_size(self, changed: DataFrame) -> None:
        def work(stored, wanted):
            sizes = self._with_log("project_size_per_commit")
            held = stored.withColumnRenamed("date", "day")
            daily = refresh.size_from(held, sizes, wanted, [COMMIT], self.by, self.as_of)
            return daily.withColumnRenamed("day", "date")

        self._size_per_commit()
        self._refresh("project_size_per_day", changed, self.project_size, work)

    def refresh_productivity(self, changed: DataFrame) -> None:
        def work(_stored, wanted):
            changes = self._with_log("project_productivity_per_commit")
            daily = refresh.productivity_from(changes, wanted, [COMMIT], self.by, self.as_of)
            return daily.withColumnRenamed("day", "date")

        self._productivity_per_commit()
        self._refresh("project_productivity_per_day", changed, self.project_productivity, work)

    def refresh_bus_factor(self, changed: DataFrame) -> None:
        def work(stored, wanted):
            changes = self._with_log("project_productivity_per_commit")
            held = stored.withColumnRenamed("date", "day")
            daily = refresh.contribution_from(held, changes, wanted, self.by)
            return daily.withColumnRenamed("day", "date")

        self._refresh("bus_factor_per_day", changed, self.bus_factor, work)

    def refresh_spoilage(self, kind: str, changed: DataFrame) -> None:
        def work(stored, wanted):
            return refresh.open_items_from(
                stored, self._spans(kind), self._log_days(), wanted, self.by, self.as_of
            )

        self._refresh(f"{kind}_spoilage_per_day", changed, lambda: self._spoilage(kind), work, 1)

    def refresh_density(self, changed: DataFrame) -> None:
        """After size and issue spoilage. The last day had no count of its own, so it is done again."""
        def work(_stored, wanted):
            sizes = self._stored("project_size_per_day").withColumnRenamed("date", "day")
            return refresh.density_from(sizes, self._stored("issue_spoilage_per_day"), wanted, self.by)

        self._refresh("issue_density_per_day", changed, self.issue_density, work, 0, 1)
