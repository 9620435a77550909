"""Building the tables: staging once, then the models that read it."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from learnsilver.functions.columns import GROUP
from learnsilver.operators.lineage import assert_schema, with_comments
from learnsilver.operators.rawstore import RawStore
from learnsilver.operators.states import Folder, States
from learnsilver.plans import REGISTRY, build_model
from learnsilver.plans.staging import observed_rejects
from learnsilver.schemas import MODELS, RAW, SILVER, STAGING, STATEMENTS_TABLE
from learnsilver.sources.catalog import layer_name

# Fixed value: how many models are built at the same time.
CONCURRENT_MODELS = 8
# Models whose rows each hang on the events of one value of a staging column: the column.
GROUPED = {
    "fact_learning_event": "event_id",
    "fact_ai_interaction": "event_id",
    "fact_launch": "event_id",
    "dim_session": "sessionId",
    "fact_session_summary": "sessionId",
}
# Partition expressions of the tables of those models.
GROUPED_PARTS = {
    "fact_learning_event": "to_date(event_timestamp_utc)",
    "fact_ai_interaction": "to_date(interaction_timestamp)",
    "fact_launch": "to_date(launch_timestamp_utc)",
    "dim_session": "to_date(session_start)",
}
# Partition expression of staging that is kept up to date.
EVENT_DAY = "to_date(event_timestamp)"


class Warehouse:
    """Silver tables under a folder, built from raw tables given by a reader.

    Fourteen models read the staging view. It is written once, as parquet,
    and the models read the columns they need, instead of parsing the
    statements each. Every table is fully rebuilt, in a folder of its own that
    is made current when it is whole: a build that fails changes nothing, and
    readers of the table before keep their files until ``vacuum``.

    With ``statements``, the raw store they are in, staging is not rebuilt:
    only statements that came since the last build are parsed and merged by
    id, into a table by day. Nor are the models of ``GROUPED``: what hangs on
    events that came or changed since is made anew and put in place of what
    hung on them before.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        read_raw: Callable[[str], DataFrame | None],
        prefix: str = "",
        run_ts: str = "current_timestamp()",
        statements: RawStore | None = None,
        **staging_options,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.read_raw = read_raw
        self.prefix = prefix
        self.run_ts = run_ts
        self.staging_options = staging_options
        self.built: set[str] = set()
        self._rejects: list[tuple[str, int, int]] = []
        self._states = States(spark, self.root)
        self.statements = statements
        self.staging = RawStore(
            spark, f"{self.root}/{layer_name('staging', prefix)}_loads", parts=dict.fromkeys(STAGING, EVENT_DAY)
        )
        self.patched = RawStore(spark, f"{self.root}/{layer_name('silver', prefix)}_loads", parts=GROUPED_PARTS)

    def _name(self, name: str) -> str:
        return f"{layer_name(REGISTRY[name].layer, self.prefix)}/{name}"

    def path(self, name: str) -> str:
        """The folder of the current build."""
        state = self._states.latest(self._name(name))
        if not state["version"]:
            raise LookupError(f"{name} is not built yet")
        return f"{self.root}/{self._name(name)}/{state['folder']}"

    def vacuum(self, name: str) -> int:
        """Delete the builds that are long replaced; how many."""
        kept = {state["folder"] for state in self._states.kept(self._name(name))}
        folder = Folder(self.spark, f"{self.root}/{self._name(name)}")
        gone = [build for build in folder.names() if build not in kept]
        for build in gone:
            folder.remove(build)
        return len(gone)

    def table(self, name: str) -> DataFrame:
        """A built model, or a raw table; a raw table not loaded yet is empty."""
        if name in STAGING and self.statements:
            return self.staging.read(name).select(*MODELS[name].names)
        if name in GROUPED and self.statements:
            return self.patched.read(name).select(*MODELS[name].names)
        if name in MODELS:
            return self.spark.read.schema(MODELS[name].ddl).parquet(self.path(name))
        raw = self.read_raw(name)
        return self.spark.createDataFrame([], RAW[name].ddl) if raw is None else raw

    def register_views(self, names: Iterable[str] = tuple(MODELS)) -> None:
        """Make built tables known to SQL as temporary views."""
        for name in names:
            self.table(name).createOrReplaceTempView(name)

    def plan(self, name: str, observation: Observation | None = None) -> DataFrame:
        """A model as a lazy DataFrame over the tables it reads."""
        options = {**self.staging_options, "observation": observation} if name in STAGING else {}
        return build_model(name, self.table, run_ts=self.run_ts, **options)

    def rejects(self) -> DataFrame:
        """(column, given, rejected): values that the last build of staging met, and those that did not fit.

        Counted as staging was written. With ``statements``, of what came since the build before.
        """
        return self.spark.createDataFrame(self._rejects, "column string, given bigint, rejected bigint")

    def build(self, name: str) -> None:
        """Write a model anew. Staging must be there where the model reads it."""
        if name in STAGING and self.statements:
            self._refresh(name)
            return
        if name in GROUPED and self.statements:
            self._patch(name)
            return
        counts = Observation() if name in STAGING else None
        df = self.plan(name, counts)
        assert_schema(df, MODELS[name])
        folder = f"build-{uuid.uuid4().hex}"
        with_comments(df, MODELS[name]).write.parquet(f"{self.root}/{self._name(name)}/{folder}")
        version = self._states.latest(self._name(name))["version"] + 1
        self._states.publish(self._name(name), {"version": version, "folder": folder})
        if counts:
            self._rejects = observed_rejects(counts.get)
        self.built.add(name)

    def _refresh(self, name: str) -> None:
        """Merge the statements that came since the last build into staging."""
        version = self.statements.version(STATEMENTS_TABLE)
        after = self.staging.last_batch(name, STATEMENTS_TABLE)
        # What staging has not seen is kept for it, also where the store folds it in.
        self.statements.mark(STATEMENTS_TABLE, self._consumer(name), after)
        new = self.statements.changes(STATEMENTS_TABLE, after)
        if new is None:
            new = self.spark.createDataFrame([], RAW[STATEMENTS_TABLE].ddl) if not after else None
        if new is not None:
            counts = Observation()
            staged = build_model(name, lambda _: new, **{**self.staging_options, "observation": counts})
            assert_schema(staged, MODELS[name])
            self.staging.merge(
                name, staged, MODELS[name].key, batch=f"{STATEMENTS_TABLE}#{version}", changed_only=False,
                # A row of staging has the key of its statement.
                one_each=self.statements.has_one_each(STATEMENTS_TABLE),
            )
            self._rejects = observed_rejects(counts.get)
        self.built.add(name)

    def _consumer(self, name: str) -> str:
        return f"{name}-{hashlib.sha256(self.root.encode()).hexdigest()[:16]}"

    def _patch(self, name: str) -> None:
        """Make the rows anew that hang on events that came or changed since the last build."""
        (staged,) = REGISTRY[name].inputs
        column, members = GROUPED[name], f"{name}_members"
        version, after = self.staging.version(staged), self.patched.last_batch(name, staged)
        self.staging.mark(staged, self._consumer(name), after)
        by_event = column == MODELS[staged].key
        if not by_event and self.patched.last_batch(members, staged) != after:
            after = 0  # a build broke off between the two tables
        changes = self.staging.changes(staged, after)
        if changes is None and after:
            self.built.add(name)
            return
        whole = self.staging.read(staged)
        changes = whole if changes is None else changes
        if by_event or not after:
            events = changes
            groups = changes.select(column).filter(f"{column} is not null")
        else:
            # The groups that the events are in now, and those they were in before.
            ids = changes.select("event_id")
            before = self.patched.read(members).join(ids, "event_id", "left_semi").select(column)
            groups = changes.select(column).union(before).filter(f"{column} is not null").distinct()
            events = whole.join(groups, column, "left_semi")
        rows = build_model(
            name, lambda _: events.withColumn(GROUP, F.col(column)) if by_event else events, run_ts=self.run_ts
        )
        if not by_event:
            rows = rows.withColumn(GROUP, F.col("session_id"))
        assert_schema(rows.drop(GROUP), MODELS[name])
        if not after and self.patched.version(name):
            # Everything anew: what is there goes, whatever it hung on.
            groups = groups.union(self.patched.read(name).select(GROUP)).filter(f"{column} is not null")
        batch = f"{staged}#{version}"
        # A table that is made anew has the batch already where a build broke off after it.
        done = self.patched.last_batch(name, staged) >= version
        self.patched.replace(name, rows, GROUP, groups, batch=None if done else batch)
        if not by_event:
            self.patched.merge(
                members, changes.select("event_id", column), "event_id", batch=batch, changed_only=False,
                one_each=self.staging.has_one_each(staged),
            )
        self.built.add(name)

    def build_all(self, names: Iterable[str] = tuple(SILVER)) -> None:
        """Write the named models anew, and staging first where one of them reads it."""
        names = list(names)
        for staged in self._staging_of(names):
            self.build(staged)
        with ThreadPoolExecutor(CONCURRENT_MODELS) as pool:
            list(pool.map(self.build, names))

    def build_missing(self, names: Iterable[str]) -> None:
        """Write those of the named models, and of the staging they read, not yet written."""
        for staged in self._staging_of(names):
            if staged not in self.built:
                self.build(staged)
        with ThreadPoolExecutor(CONCURRENT_MODELS) as pool:
            list(pool.map(self.build, [n for n in names if n not in self.built]))

    def _staging_of(self, names: Iterable[str]) -> list[str]:
        return sorted({i for n in names for i in REGISTRY[n].inputs if i in MODELS})
