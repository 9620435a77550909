"""Raw tables on shared storage: a base in parts, recent loads beside it, and a state.

A load writes its rows to a fresh folder and only then publishes a state that
names the folder, together with the cursor it reached. A load that fails
leaves a folder no state names: it is never read. So a load costs what it
holds, whatever the size of the table and wherever its keys lie.

Reading puts the loads over the base: of every key, the rows of its last merge
count, over the whole table and whatever part they are in. Few folders are
left by loads, however many there were: appended loads are written together in
levels (``levels``), merged loads are folded into the parts of the base that
hold one of their keys (``compact``), which an index of the base's files tells
(``keyindex``). ``vacuum`` deletes folders that no kept state names.

A consumer of the table (``mark``) sees each load once: loads stay by
themselves, for ``changes``, until all consumers are past them, whether they
are folded in meanwhile or not.

Every load keeps the types it came with. The table has the common type of each
column (``drift``), and what was written under another is brought to it as it
is read.

A table has one writer at a time; two would find each other's state. Marks are
files of their own, so consumers and the writer do not meet.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnsilver.operators import keyindex, levels
from learnsilver.operators.drift import conformed, merged, storable
from learnsilver.operators.incremental import (
    as_cursor,
    changed_since,
    cursor_column,
    cursor_of,
    latest_per_key,
)
from learnsilver.operators.states import Folder, States

PART = "_part"
# Rows without a key stand apart under this column: they cannot be merged.
ASIDE = "_aside"
VERSION = "_version"
# Merged loads that stay beside the base before they are folded in.
MOST_LOADS = 16
# Loads kept for consumers that are behind; one that is further behind reads the whole table.
MOST_KEPT = 1_000
# Files whose keys a fold looks through by name; beyond them it looks through the base.
MOST_OPENED = 10_000
# Folders that hold keys of the latest cursor before they are written as one.
MOST_TIES = 8
# Partition expression of statements: the day they were stored.
STORED_DAY = "to_date(stored)"


def hashed_parts(key: str, count: int) -> str:
    """A partition expression: a hash of the key, spread over a number of parts."""
    return f"pmod(xxhash64(`{key}`), {count})"


class RawStore:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        parts: dict[str, str] | None = None,
        most_loads: int = MOST_LOADS,
    ):
        """``parts`` gives the partition expression of a table's base; others are one part.

        It may change between versions of a row: a row that comes again with
        another part replaces the old one all the same.
        """
        self.spark = spark
        self.root = root.rstrip("/")
        self.parts = parts or {}
        self.most_loads = most_loads
        self._states = States(spark, self.root)
        self._folder = Folder(spark, self.root)

    # -- state -------------------------------------------------------------------

    def cursor(self, table: str) -> str | None:
        """The cursor of the last load."""
        return self._states.latest(table).get("cursor")

    def state(self) -> DataFrame:
        """One row per table: version, cursor of the last load, and rows set aside so far."""
        rows = []
        for table in self._states.tables():
            state = self._states.latest(table)
            rows.append((table, state["version"], state.get("cursor"), state.get("rows_aside", 0)))
        return self.spark.createDataFrame(
            rows, "table string, version bigint, last_cursor string, rows_aside bigint"
        )

    def tables(self) -> list[str]:
        """The tables that something was loaded into."""
        return self._states.tables()

    # -- consumers ---------------------------------------------------------------

    def marks(self, table: str) -> dict[str, int]:
        """How far each consumer of a table has come, as versions."""
        found: dict[str, int] = {}
        for name in self._folder.names(f"{_MARKS}/{table}"):
            consumer, _, version = name.rpartition("@")
            if consumer and version.isdigit():
                found[consumer] = max(found.get(consumer, 0), int(version))
        return found

    def mark(self, table: str, consumer: str, version: int) -> None:
        """Say that a consumer has all up to a version; with 0, that there is such a consumer."""
        folder = f"{_MARKS}/{table}"
        if self.marks(table).get(consumer, -1) >= version:
            return
        self._folder.write(f"{folder}/{consumer}@{version:012d}", "")
        for name in self._folder.names(folder):
            if name.rpartition("@")[0] == consumer and int(name.rpartition("@")[2]) < version:
                self._folder.remove(f"{folder}/{name}")

    def forget(self, table: str, consumer: str) -> None:
        """Keep nothing for a consumer any more."""
        for name in self._folder.names(f"{_MARKS}/{table}"):
            if name.rpartition("@")[0] == consumer:
                self._folder.remove(f"{_MARKS}/{table}/{name}")

    # -- reading -----------------------------------------------------------------

    def read(self, table: str) -> DataFrame | None:
        """The table as its loads left it; None when nothing is there yet."""
        state = self._states.latest(table)
        return self._rows(table, state) if state["version"] else None

    def version(self, table: str) -> int:
        """The number of the table's present version; 0 before the first load."""
        return self._states.latest(table)["version"]

    def has_one_each(self, table: str) -> bool:
        """Whether all rows, and all ``changes``, surely have a key of their own each, as text.

        So it is where all was merged by one key, that was text each time: of
        other types, keys may be told apart before they widen, and not after.
        """
        state = {**_EMPTY, **self._states.latest(table)}
        types = [f.dataType for schema in state["schemas"] for f in T.StructType.fromJson(schema) if f.name == state["key"]]
        return state["one_each"] and all(dtype == T.StringType() for dtype in types)

    def last_batch(self, table: str, stream: str) -> int:
        """The number of the last batch of a stream that the table has; 0 before the first."""
        return self._states.latest(table).get("batches", {}).get(stream, 0)

    def changes(self, table: str, after: int) -> DataFrame | None:
        """The rows of the loads after a version, of each key the last ones; None when there are none.

        All current rows where loads after it are not kept any more: those of
        consumers that never set a mark, or lag by more than ``MOST_KEPT``.
        """
        state = self._states.latest(table)
        if not state["version"] or (after and state["version"] <= after):
            return None
        if not after or after < state["released"]:
            return self._rows(table, state)
        loads = [load for load in _originals(state) if load["version"] > after]
        return self._rows(table, {**state, "base": {}, "loads": loads}) if loads else None

    def set_aside(self, table: str) -> DataFrame | None:
        """The rows that came without a key; None when there are none."""
        state = self._states.latest(table)
        if not state.get("aside"):
            return None
        return self._loaded(table, state, state["aside"], aside="true")

    def _at(self, table: str, folder: str, part: str) -> str:
        return f"{self.root}/{table}/{folder}/{part}"

    def _open(self, state: dict, schema: int, paths: list[str]) -> DataFrame:
        """Files written under one schema, with the table's columns and types."""
        own = T.StructType.fromJson(state["schemas"][schema])
        return conformed(self.spark.read.schema(own).parquet(*paths), _schema(state))

    def _loaded(self, table: str, state: dict, loads: list[dict], aside: str = "false") -> DataFrame:
        """All rows of some loads, as they came."""
        by_schema: dict[int, list[str]] = {}
        for load in loads:
            if load.get("rows", 1):
                by_schema.setdefault(load["schema"], []).append(self._at(table, load["folder"], f"{ASIDE}={aside}"))
        if not by_schema:
            return self.spark.createDataFrame([], _schema(state))
        return reduce(DataFrame.union, [self._open(state, schema, paths) for schema, paths in by_schema.items()])

    def _base(self, table: str, state: dict, parts: list[str] | None = None) -> list[DataFrame]:
        """The rows of the base, or of these parts of it; a table for each schema they were written under."""
        by_schema: dict[int, list[str]] = {}
        for part, folder in state["base"].items():
            if parts is None or part in parts:
                by_schema.setdefault(state["written"][folder], []).append(self._at(table, folder, f"{PART}={part}"))
        return [self._open(state, schema, paths) for schema, paths in by_schema.items()]

    def _rows(self, table: str, state: dict, parts: list[str] | None = None) -> DataFrame:
        """The current rows; with ``parts``, of these parts of the base, and of all loads."""
        frames = [rows.withColumn(VERSION, F.lit(0)) for rows in self._base(table, state, parts)]
        loads = [(load, self._loaded(table, state, [load])) for load in state["loads"]]
        frames += [rows.withColumn(VERSION, F.lit(load["version"])) for load, rows in loads]
        if not frames:
            return self.spark.createDataFrame([], _schema(state))
        whole = reduce(DataFrame.union, frames)
        merges = [load for load in state["loads"] if load["mode"] == "merge"]
        if merges and len(frames) > 1:
            # Keys and numbers only: Spark broadcasts them by their measured size, or joins by key. The
            # partitions of that join stay apart: rows of JSON text are ten times as large in memory as on the way.
            tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            keys = self._merged_keys(table, state, merges).repartition(tasks, "_key")
            last = keys.groupBy("_key").agg(F.max("_merged").alias("_merged"))
            whole = whole.join(last, F.col(state["key"]) == F.col("_key"), "left").filter(
                f"_merged IS NULL OR _merged <= {VERSION}"
            )
        return whole.select(*_schema(state).names)

    def _merged_keys(self, table: str, state: dict, merges: list[dict]) -> DataFrame:
        """(_key, _merged) of the keys that merges replaced, and the merge's version."""
        key = next(f for f in _schema(state) if f.name == state["key"])
        found = []
        for load in merges:
            if "keys" in load:
                rows = self.spark.read.parquet(f"{self.root}/{table}/{load['keys']}").select(F.col("_key").cast(key.dataType))
            else:
                rows = self._loaded(table, state, [load]).select(F.col(f"`{key.name}`").alias("_key"))
            found.append(rows.withColumn("_merged", F.lit(load["version"])))
        return reduce(DataFrame.union, found)

    # -- writing -----------------------------------------------------------------

    def _fresh(self, kind: str = "load") -> str:
        return f"{kind}-{uuid.uuid4().hex}"

    def _land(
        self, table: str, df: DataFrame, key: str | None, told: bool = False
    ) -> tuple[str, int, int, str | None]:
        """Write a batch; its folder, the rows with and without key, and the latest cursor.

        With ``told``, the rows say themselves in ``ASIDE`` whether they have no
        key. The counts are taken as the rows are written: nothing is read again.
        """
        folder, facts = self._fresh(), Observation()
        rows = conformed(df, storable(df.schema))
        if key and not told:
            rows = rows.withColumn(ASIDE, F.col(key).isNull())
        aside = F.col(ASIDE) if key else F.lit(False)
        written = rows.observe(
            facts,
            F.count_if(~aside).alias("rows"),
            F.count_if(aside).alias("aside"),
            F.expr(f"cast(max({cursor_of(df)}) as string)").alias("cursor"),
        ).write
        if key:
            written.partitionBy(ASIDE).parquet(f"{self.root}/{table}/{folder}")
        else:
            # All go to one folder: a write partitioned by it would sort the rows.
            written.parquet(self._at(table, folder, f"{ASIDE}=false"))
        return folder, facts.get["rows"], facts.get["aside"], facts.get["cursor"]

    def _load(
        self, table: str, state: dict, df: DataFrame, mode: str, key: str | None, batch: str | None,
        replaced: DataFrame | None = None, one_each: bool = False,
    ) -> int:
        """``one_each``: the rows have a key of their own each; other merged rows say in ``ASIDE`` if they have none."""
        state = {**_EMPTY, **state}
        told = mode == "merge" and not replaced and not one_each
        # A column of nothing but nulls says nothing of its type.
        known = {f.name: f.dataType for f in _schema(state)} if state["schema"] is not None else {}
        nulls = {f.name: known[f.name] for f in df.schema if isinstance(f.dataType, T.NullType) and f.name in known}
        df = df.withColumns({name: F.lit(None).cast(dtype) for name, dtype in nulls.items()})
        folder, rows, aside, cursor = self._land(table, df, key if told else None, told)
        if not rows and not aside and not replaced:
            return 0
        own = storable(df.drop(ASIDE).schema if told else df.schema)
        state, schema = _with_schema(state, own)
        state, _ = _with_schema(state, merged(_schema(state), own) if state["schema"] is not None else own, table=True)
        stream, _, number = (batch or "").rpartition("#")
        version = state["version"] + 1
        load = {"folder": folder, "version": version, "mode": mode, "rows": rows, "schema": schema}
        if replaced:
            load["keys"] = self._fresh("keys")
            replaced.toDF("_key").distinct().write.parquet(f"{self.root}/{table}/{load['keys']}")
        last = max((c for c in (state["cursor"], cursor) if c), default=None)
        ties = (state["ties"] if last == state["cursor"] else []) + ([load] if cursor and cursor == last and rows else [])
        state |= {
            "version": version,
            "key": key or state["key"],
            "one_each": mode == "merge" and not replaced
            and (not state["version"] or (state["one_each"] and state["key"] == key)),
            "cursor": last,
            "ties": [{"folder": t["folder"], "schema": t["schema"]} for t in ties],
            "batches": {**state["batches"], **({stream: int(number)} if batch else {})},
            "loads": [*state["loads"], *([load] if rows or replaced else [])],
            "aside": [*state["aside"], *([{**load, "mode": "append", "rows": aside}] if aside else [])],
            "rows_aside": state["rows_aside"] + aside,
        }
        self._states.publish(table, state)
        self._settle(table, state)
        return rows

    def append(self, table: str, df: DataFrame, batch: str | None = None) -> int:
        """Add rows as they are; the number of rows. A known batch is not added again.

        ``batch`` is ``<stream>#<number>``; a stream's numbers go up.
        """
        state = self._states.latest(table)
        if _is_known(state, batch):
            return 0
        return self._load(table, state, df, "append", None, batch)

    def merge(
        self,
        table: str,
        df: DataFrame,
        key: str,
        since: str | None = None,
        overlap: str | None = None,
        batch: str | None = None,
        changed_only: bool = True,
        one_each: bool = False,
    ) -> int:
        """Load the rows changed since the last load by key; the number of rows.

        Those are the rows after the stored cursor, and those at it whose keys
        the loads at that cursor did not have. ``since`` overrides the stored
        cursor, strictly, and ``overlap`` reads that much again;
        ``changed_only=False`` takes all rows, for a source that knows itself
        what is new. A batch that is known already is not loaded again. Rows
        without a key are set aside and counted (``set_aside``, ``state``), not
        loaded. ``one_each`` says that every row has a key of its own, such as
        the rows of a table that ``has_one_each``: they are neither shuffled nor
        sorted then.
        """
        state = self._states.latest(table)
        if _is_known(state, batch):
            return 0
        if changed_only:
            found = changed_since(df, since or state.get("cursor"), overlap=overlap)
            late = None if since or overlap else self._late(table, state, df, key)
            df = found if late is None else found.unionByName(late)
        latest = df if one_each else latest_per_key(df, key, keyless=ASIDE)
        return self._load(table, state, latest, "merge", key, batch, one_each=one_each)

    def replace(
        self, table: str, df: DataFrame, key: str, keys: DataFrame, batch: str | None = None
    ) -> int:
        """Put the rows of ``df`` in place of all rows whose key is one of ``keys`` (one column).

        A key may have several rows, or none any more. The keys of ``df`` must
        be among ``keys``. A known batch is not loaded again.
        """
        state = self._states.latest(table)
        if _is_known(state, batch):
            return 0
        return self._load(table, state, df, "merge", key, batch, replaced=keys)

    def _late(self, table: str, state: dict, df: DataFrame, key: str) -> DataFrame | None:
        """The rows at the stored cursor whose keys were not loaded with it; rows without key are not known apart."""
        column = cursor_column(df)
        if not state.get("ties") or not column or state["cursor"] is None:
            return None
        at = F.col(f"`{column}`") == F.expr(as_cursor(state["cursor"]))
        if column not in _schema(state).names:
            return None
        seen = self._loaded(table, state, state["ties"]).filter(at).select(F.col(f"`{key}`").alias("_seen"))
        late = df.filter(at & F.col(f"`{key}`").isNotNull())
        return late.join(seen, late[f"`{key}`"] == seen["_seen"], "left_anti")

    # -- folding -----------------------------------------------------------------

    def _settle(self, table: str, state: dict) -> None:
        """After a load: write together what levels and numbers ask for."""
        for part in ("loads", "aside"):
            while run := levels.due(state[part]):
                state = self._join(table, state, part, run)
        if len(state["ties"]) > MOST_TIES:
            state = self._join_ties(table, state)
        if sum(load["mode"] == "merge" for load in state["loads"]) >= self.most_loads:
            self.compact(table)

    def _join(self, table: str, state: dict, part: str, run: list[dict]) -> dict:
        """Appended loads in a row, written as one."""
        aside = "true" if part == "aside" else "false"
        folder = self._fresh()
        rows = self._loaded(table, state, run, aside).hint("rebalance")
        rows.write.parquet(self._at(table, folder, f"{ASIDE}={aside}"))
        one = levels.joined(run, folder=folder, schema=state["schema"])
        at = state[part].index(run[0])
        left = [*state[part][:at], one, *state[part][at + len(run) :]]
        state = {**state, "version": state["version"] + 1, part: left}
        if part == "loads":
            state = self._released(table, state, run)
        self._states.publish(table, state)
        return state

    def _join_ties(self, table: str, state: dict) -> dict:
        """The folders of the latest cursor as one, with the rows at that cursor alone."""
        folder, column = self._fresh("ties"), cursor_column(self.spark.createDataFrame([], _schema(state)))
        rows = self._loaded(table, state, state["ties"])
        if column:
            rows = rows.filter(F.col(f"`{column}`") == F.expr(as_cursor(state["cursor"])))
        rows.hint("rebalance").write.parquet(self._at(table, folder, f"{ASIDE}=false"))
        ties = [{"folder": folder, "schema": state["schema"]}]
        state = {**state, "version": state["version"] + 1, "ties": ties}
        self._states.publish(table, state)
        return state

    def _released(self, table: str, state: dict, folded: list[dict]) -> dict:
        """The state with those of the folded loads kept that a consumer has yet to see."""
        folded = [load for load in folded if not load.get("level")]
        marks = self.marks(table).values()
        least = min(marks, default=None)
        kept = [
            load for load in [*state["feed"], *folded] if least is not None and load["version"] > least
        ]
        kept = sorted(kept, key=lambda load: load["version"])[-MOST_KEPT:]
        names = {load["folder"] for load in kept}
        gone = [load["version"] for load in [*state["feed"], *folded] if load["folder"] not in names]
        return {**state, "feed": kept, "released": max([state["released"], *gone])}

    def compact(self, table: str) -> None:
        """Fold the loads into the base: the parts that hold one of their keys, before or now."""
        state = {**_EMPTY, **self._states.latest(table)}
        if not state["loads"]:
            return
        part = self._part_of(table)
        touched = self._part_names(self._loaded(table, state, state["loads"]).selectExpr(f"{part} as {PART}"))
        if state["base"] and any(load["mode"] == "merge" for load in state["loads"]):
            if self._same_types(state):
                touched |= self._parts_with_keys(table, state)
            else:  # a type widened: the part of a row may be named anew
                touched = set(state["base"]) | touched
        folder, index = self._fresh("base"), self._fresh("index")
        rows = self._rows(table, state, sorted(touched)).selectExpr("*", f"{part} as {PART}")
        if table in self.parts:
            # Gather by part, else every task writes a file per part; Spark splits a large part.
            rows = rows.hint("rebalance", PART)
        if state["key"]:
            rows = rows.sortWithinPartitions(PART, state["key"])
        rows.write.partitionBy(PART).parquet(f"{self.root}/{table}/{folder}")
        written = {
            name.removeprefix(f"{PART}=")
            for name in self._folder.names(f"{table}/{folder}")
            if name.startswith(f"{PART}=")
        }
        base = {p: f for p, f in state["base"].items() if p not in touched}
        base |= dict.fromkeys(written, folder)
        if state["key"] and written:
            paths = [self._at(table, folder, f"{PART}={p}") for p in sorted(written)]
            keys = self.spark.read.schema(_schema(state)).parquet(*paths).select(
                F.regexp_extract("_metadata.file_path", f"/{PART}=([^/]*)/[^/]*$", 1).alias(PART),
                F.col("_metadata.file_path").alias(keyindex.FILE),
                state["key"],
            )
            keyindex.built(keys, state["key"]).write.parquet(f"{self.root}/{table}/{index}")
        used = set(base.values())
        indexes = {**state["indexes"], **({folder: index} if state["key"] and written else {})}
        new = {
            **state, "version": state["version"] + 1, "base": base, "loads": [],
            "written": {f: s for f, s in {**state["written"], folder: state["schema"]}.items() if f in used},
            "indexes": {f: i for f, i in indexes.items() if f in used},
        }
        self._states.publish(table, self._released(table, new, state["loads"]))

    def _same_types(self, state: dict) -> bool:
        """Whether the base was written with the types that the table has now."""
        now = {f.name: f.dataType for f in _schema(state)}
        return all(
            now[f.name] == f.dataType
            for schema in set(state["written"].values())
            for f in T.StructType.fromJson(state["schemas"][schema])
        )

    def _parts_with_keys(self, table: str, state: dict) -> set[str]:
        """The parts of the base that hold a key of the loads; only files that may hold one are opened."""
        key, live = state["key"], [(p, f) for p, f in state["base"].items()]
        loads = [load for load in state["loads"] if load["mode"] == "merge"]
        keys = self._merged_keys(table, state, loads).select(F.col("_key").alias(key)).distinct()
        files = self.files_that_may_hold(table, keys)
        if files is None:
            paths = [self._at(table, f, f"{PART}={p}") for p, f in live]
        else:
            paths = files
        if not paths:
            return set()
        own = T.StructType([f for f in _schema(state) if f.name == key])
        base = self.spark.read.schema(own).parquet(*paths).select(
            key, F.regexp_extract("_metadata.file_path", f"/{PART}=([^/]*)/[^/]*$", 1).alias(PART)
        )
        return self._part_names(base.join(keys, key, "left_semi"))

    def files_that_may_hold(self, table: str, keys: DataFrame) -> list[str] | None:
        """The files of the base that may hold one of ``keys`` (one column), by their index.

        None where the index does not tell: a part of the base has none, or the
        files are more than ``MOST_OPENED``.
        """
        state = {**_EMPTY, **self._states.latest(table)}
        if set(state["base"].values()) - set(state["indexes"]):
            return None
        by_index: dict[str, list[str]] = {}
        for part, folder in state["base"].items():
            by_index.setdefault(state["indexes"][folder], []).append(part)
        if not by_index:
            return []
        # Parts that a later fold has rewritten stand in older indexes still.
        rows = [
            self.spark.read.schema(_INDEX).parquet(f"{self.root}/{table}/{index}").filter(F.col(PART).isin(parts))
            for index, parts in by_index.items()
        ]
        found = keyindex.candidates(reduce(DataFrame.union, rows), keys).select(keyindex.FILE)
        files = [row[0] for row in found.limit(MOST_OPENED + 1).collect()]
        return files if len(files) <= MOST_OPENED else None

    def _part_of(self, table: str) -> str:
        """The part of a row, as a folder name: other signs as underscores."""
        part = self.parts.get(table)
        if not part:
            return "'all'"
        return f"coalesce(regexp_replace(cast({part} as string), '[^A-Za-z0-9.-]', '_'), 'none')"

    def _part_names(self, rows: DataFrame) -> set[str]:
        """The parts that rows fall into: as many as the partition expression has values."""
        return {row[PART] for row in rows.select(PART).distinct().collect()}

    def vacuum(self, table: str) -> int:
        """Delete the folders that no kept state names; how many. For the table's writer alone."""
        named = set()
        for state in self._states.kept(table):
            state = {**_EMPTY, **state}
            named |= {*state["base"].values(), *state["indexes"].values()}
            listed = [load for part in ("loads", "feed", "aside", "ties") for load in state[part]]
            named |= {load["folder"] for load in listed} | {load["keys"] for load in listed if "keys" in load}
        gone = [name for name in self._folder.names(table) if name not in named]
        for name in gone:
            self._folder.remove(f"{table}/{name}")
        return len(gone)


_MARKS = "_marks"
_INDEX = f"{keyindex.PART} string, {keyindex.FILE} string, least string, most string, blocks bigint, block bigint, " + (
    ", ".join(f"w{k} bigint" for k in range(keyindex.WORDS))
)
# What a state holds besides its version. ``schema`` is the place of the table's in ``schemas``.
_EMPTY: dict = {
    "key": None, "one_each": False, "cursor": None, "ties": [], "schemas": [], "schema": None, "batches": {},
    "base": {}, "written": {}, "indexes": {}, "loads": [], "feed": [], "released": 0,
    "aside": [], "rows_aside": 0,
}


def _schema(state: dict) -> T.StructType:
    """The columns of all loads so far; no file is opened to find them out."""
    return T.StructType.fromJson(state["schemas"][state["schema"]])


def _with_schema(state: dict, schema: T.StructType, table: bool = False) -> tuple[dict, int]:
    """The state that knows a schema, and the schema's place; with ``table`` it is the table's."""
    text = schema.jsonValue()
    schemas = state["schemas"] if text in state["schemas"] else [*state["schemas"], text]
    place = schemas.index(text)
    return {**state, "schemas": schemas, **({"schema": place} if table else {})}, place


def _originals(state: dict) -> list[dict]:
    """The loads as they came, those kept for consumers and those not yet folded, in order."""
    own = [load for load in state["loads"] if not load.get("level")]
    return sorted([*state["feed"], *own], key=lambda load: load["version"])


def _is_known(state: dict, batch: str | None) -> bool:
    if batch is None:
        return False
    stream, _, number = batch.rpartition("#")
    return int(number) <= state.get("batches", {}).get(stream, -1)
