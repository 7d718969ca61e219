"""Stored tables and marts: parts and a snapshot log for loaded tables, day versions for marts.

Layout under one root (a shared folder the cluster sees):

    tables/<table>/v=<version>/part=<p>/  the segments that a run wrote of a loaded table
    tables/<table>/_keys/v=<version>/     which keys those segments hold, as bitmaps
    tables/<table>/_log/                  the table's commits (``snapshots.SnapshotLog``): segments and control row
    marts/<model>/v=<run_id>/             the days of a mart that a run wrote
    marts/<model>/_manifest/<run>/        the version of each of these days
    builds/<run_id>/                      the table versions that a finished build of all marts has used
    slices/<table>/v=<run_id>/            the extracted slice, written once so the source is read once

A loaded table is cut into parts of ``part_keys`` consecutive keys. A merge reads and writes the parts that its slice
touches and commits them in the place of the old ones; other parts stay as they are. An insert-only load adds segments
and reads no rows at all: the key bitmaps tell which keys are new. A stream may add *delta* segments, merged with their
part on reading (``read_state``) until ``compact`` rewrites the parts in which they have grown.

Nothing that can be read is overwritten: a run that dies before its commit leaves the table as it was, a replay
converges (the merge is idempotent), and ``collect_garbage`` removes folders that no kept commit names.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from levyline.operators.lookup import measured_bytes
from levyline.operators.merge import dedupe, fold, update_dealt
from levyline.operators.schema_ops import conform
from levyline.schemas import TableSpec, declared_bytes
from levyline.sources.files import Files
from levyline.sources.snapshots import Segment, SnapshotLog, State

TIME_FORMAT = "%Y-%m-%d %H:%M:%S.%f"
#: Keys of a part of a new table.
PART_KEYS = 1 << 20
#: Codec of stored rows: wide rows of like strings take far fewer bytes than by Spark's default.
CODEC = "zstd"
#: Rows are written where they lie, not dealt by part or day, if that gives at most so many files a part or day ...
FILES = 4
#: ... or files of so many rows.
FILE_ROWS = 1 << 13
#: Bytes (by declared types) of the rows that one task should sort as it writes them where they lie.
SORT_BYTES = 512 * 1024 * 1024
#: Rows of a file of a slice, so that a reader can have as many tasks as it needs.
SLICE_FILE_ROWS = 1 << 17
#: Bits of one of Spark's bitmaps.
BITMAP_BITS = 1 << 15
#: Consecutive keys that one task updates together.
BLOCK_KEYS = 1 << 16
TASKS = "spark.sql.files.minPartitionNum"
#: Shuffle files go when the write that made them has ended, not when the driver next collects its garbage.
RELEASE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
BUILD_SCHEMA = "table_name string, version string, run_id string, committed_at timestamp_ntz"
MANIFEST_SCHEMA = "day date, version string, run_id string, committed_at timestamp_ntz"

CONTROL_SCHEMA = (
    "table_name string, last_loaded_at timestamp_ntz, last_run_at timestamp_ntz, rows_loaded bigint,"
    " run_id string, version string, committed_at timestamp_ntz"
)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, part_keys: int = PART_KEYS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.part_keys = part_keys
        self.files = Files(spark)
        self._logs: dict[str, SnapshotLog] = {}

    # paths
    def table_path(self, table: str, version: str) -> str:
        return f"{self.root}/tables/{table}/v={version}"

    def keys_path(self, table: str, version: str) -> str:
        return f"{self.root}/tables/{table}/_keys/v={version}"

    def mart_path(self, model: str, version: str) -> str:
        return f"{self.root}/marts/{model}/v={version}"

    def slice_path(self, table: str, run_id: str) -> str:
        return f"{self.root}/slices/{table}/v={run_id}"

    def exists(self, path: str) -> bool:
        return self.files.exists(path)

    def _read_entries(self, folder: str, schema: str) -> DataFrame:
        """All entries (one sub-folder per commit) under a manifest folder."""
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder)

    # control rows and versions of the loaded tables: kept in each table's log
    def log(self, table: str) -> SnapshotLog:
        if table not in self._logs:
            self._logs[table] = SnapshotLog(self.files, f"{self.root}/tables/{table}/_log")
        return self._logs[table]

    def _control_frame(self, entries: Iterable[dict]) -> DataFrame:
        at = lambda text: dt.datetime.strptime(text, TIME_FORMAT)
        rows = [
            (e["table_name"], at(e["last_loaded_at"]), at(e["last_run_at"]), e["rows_loaded"], e["run_id"], e["version"], at(e["committed_at"]))
            for e in entries
        ]
        return self.spark.createDataFrame(rows, CONTROL_SCHEMA)

    def control(self) -> DataFrame:
        """The newest control row per table (a handful of rows)."""
        states = [self.log(t).at() for t in self.files.names(f"{self.root}/tables")]
        return self._control_frame(s.control for s in states if s.control)

    def control_history(self) -> DataFrame:
        """The control rows of the commits that are kept."""
        return self._control_frame(e["control"] for t in self.files.names(f"{self.root}/tables") for _, e in self.log(t).history())

    def current_version(self, table: str) -> str | None:
        return self.log(table).at().version

    def commit(self, spec: TableSpec, base: State, run_id: str, mark: dt.datetime, run_start: dt.datetime, rows: int,
               add: Iterable[Segment] = (), replace: Iterable[int] | str = (), version: str | None = None) -> int:
        """Commit segments and the control row of a load that has read ``base``. ``rows`` counts the slice;
        a commit that changes nothing keeps the version."""
        control = {
            "table_name": spec.name, "last_loaded_at": mark.strftime(TIME_FORMAT), "last_run_at": run_start.strftime(TIME_FORMAT),
            "rows_loaded": rows, "run_id": run_id, "version": version, "committed_at": dt.datetime.now().strftime(TIME_FORMAT),
        }
        return self.log(spec.name).commit(base, control, add, replace, self._width(base))

    # parts
    def _width(self, state: State) -> int:
        return state.width or self.part_keys

    def part_of(self, spec: TableSpec, state: State) -> Column:
        """The part of a row: its key divided by the width, rounded down."""
        key, width = key_sql(spec), f"{self._width(state)}L"
        return F.expr(f"({key} - pmod({key}, {width})) DIV {width}")

    def _place(self, spec: TableSpec, state: State) -> Column:
        """The place of a key in its part, from 1."""
        return F.expr(f"pmod({key_sql(spec)}, {self._width(state)}L) + 1")

    def parts_of(self, spec: TableSpec, state: State, rows: DataFrame) -> list[int]:
        """The parts that the keys of ``rows`` lie in (at most one entry a part of the table)."""
        return sorted(r[0] for r in rows.select(self.part_of(spec, state).alias("part")).distinct().collect())

    # rows into folders
    @contextmanager
    def _set(self, settings: Mapping[str, str]) -> Iterator[None]:
        """The session's settings for one action."""
        held = {name: self.spark.conf.get(name, None) for name in settings}
        try:
            for name, value in settings.items():
                self.spark.conf.set(name, value)
            yield
        finally:
            for name, value in held.items():
                if value is None:
                    self.spark.conf.unset(name)
                else:
                    self.spark.conf.set(name, value)

    def _split(self, rows: DataFrame, column: str) -> dict[str, str] | None:
        """The settings to read ``rows`` with if they can be written by ``column`` where they lie; None if they must be dealt.

        Counted from the column alone: rows stored in the order of their keys or days, or many for each task and day, give few files. Tasks
        that would sort more rows than fit in memory are made smaller: they read smaller pieces of the files."""
        width = declared_bytes(rows.dtypes)

        def tally():
            pairs = rows.select(F.col(column).alias("at"), F.spark_partition_id().alias("task")).groupBy("task", "at").agg(F.count(F.lit(1)).alias("n"))
            got = pairs.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.count_distinct("at"), F.count_distinct("task")).first()
            return got[0], got[1], got[2], got[3], width * got[1] / max(got[3], 1)

        settings: dict[str, str] = {}
        files, n, values, tasks, share = tally()
        if share > SORT_BYTES:
            settings = {TASKS: str(int(tasks * share / SORT_BYTES) + 1)}
            with self._set(settings):
                files, n, values, tasks, share = tally()
            if share > 4 * SORT_BYTES:
                return None
        return settings if files <= FILES * values + tasks or n >= FILE_ROWS * files else None

    def _write_by(self, rows: DataFrame, column: str, path: str, lie: bool, gathered: DataFrame | None = None) -> None:
        """Write rows in folders by a column, so that a folder has few files.

        They are dealt by it first: small values share a task, and adaptive execution splits one that holds a third of all rows, whatever the
        other columns. Rows that ``lie`` (a scan, with broadcasts at most) are only if that is needed; ``gathered`` ones have been dealt already."""
        settings = self._split(rows, column) if lie else None
        rows = rows.hint("rebalance", F.col(column)) if settings is None else rows
        rows = rows if gathered is None else rows.unionByName(gathered)
        with self._set({**RELEASE, **(settings or {})}):
            rows.write.mode("overwrite").option("compression", CODEC).partitionBy(column).parquet(path)

    def write_parts(self, df: DataFrame, spec: TableSpec, version: str, state: State, kind: str = "base", lie: bool = False, gathered: DataFrame | None = None) -> list[Segment]:
        """Write rows as segments of this version and list their keys; nothing is visible before the commit.

        ``lie``: see ``_write_by``; ``gathered``: more rows, already dealt by part."""
        path = self.table_path(spec.name, version)
        by_part = lambda rows: None if rows is None else rows.withColumn("part", self.part_of(spec, state))
        self._write_by(by_part(df), "part", path, lie, by_part(gathered))
        stored = self.spark.read.schema(f"`{spec.key}` {df.schema[spec.key].dataType.simpleString()}, part long").parquet(path)
        place = self._place(spec, state)
        keys = stored.groupBy("part", F.bitmap_bucket_number(place).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"), F.count(F.lit(1)).alias("rows")
        )
        keys_path = self.keys_path(spec.name, version)
        with self._set(RELEASE):
            keys.write.mode("overwrite").parquet(keys_path)
        counts = self.spark.read.parquet(keys_path).groupBy("part").agg(F.sum("rows").alias("rows")).collect()  # one row a part
        layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        return [Segment(r["part"], version, r["rows"], kind, layout) for r in sorted(counts, key=lambda r: (r["part"] is not None, r["part"] or 0))]

    def _segments(self, spec: TableSpec, segments: list[Segment]) -> DataFrame:
        """Rows of segments in the table's layout, with the folder ``v`` and the ``part`` they come from. Segments of an older layout
        are read in it and conformed."""
        base = f"{self.root}/tables/{spec.name}"
        out = None
        for layout in dict.fromkeys(s.layout for s in segments):
            paths = [f"{base}/v={s.version}/part={s.part}" for s in segments if s.layout == layout]
            df = self.spark.read.schema(f"{layout}, v string, part long").option("basePath", base).parquet(*paths)
            df = conform(df, spec, extra=("v", "part"))
            out = df if out is None else out.unionByName(df)
        return out if out is not None else self.spark.createDataFrame([], spec.schema).withColumns({"v": F.lit(""), "part": F.lit(0).cast("long")})

    def read_state(self, spec: TableSpec, state: State, parts: Iterable[int] | None = None) -> DataFrame:
        """The table's rows in a state, only of ``parts`` when given.

        Parts with deltas are merged as they are read: a key's first segment gives the row, its last the update columns."""
        wanted = None if parts is None else set(parts)
        segments = [s for s in state.segments if wanted is None or s.part in wanted]
        mixed = {s.part for s in segments if s.kind == "delta"}
        plain = self._segments(spec, [s for s in segments if s.part not in mixed]).select(*spec.column_names)
        if not mixed:
            return plain
        changed = [s for s in segments if s.part in mixed]
        seq = F.create_map(*[x for v, n in {s.version: s.seq for s in changed}.items() for x in (F.lit(v), F.lit(n))])
        rows = self._segments(spec, changed).withColumn("__seq", seq[F.col("v")]).drop("v", "part")
        if spec.refresh == "insert_only":
            folded = dedupe(rows, spec.key, ["__seq"], keep="earliest")
        else:
            folded = fold(rows, spec.key, F.col("__seq"), spec.update_columns)
        return plain.unionByName(folded.select(*spec.column_names))

    def read_table(self, spec: TableSpec) -> DataFrame:
        """Current rows of a loaded table (none, in its layout, before the first load)."""
        return self.read_state(spec, self.log(spec.name).at())

    def read_version(self, spec: TableSpec, version: str | None, parts: Iterable[int] | None = None) -> DataFrame:
        """The table as of the commit that made ``version`` (None: before the first load)."""
        return self.read_state(spec, self.state_of(spec, version), parts)

    def state_of(self, spec: TableSpec, version: str | None) -> State:
        if version is None:
            return State()
        n = self.log(spec.name).find(version)
        if n is None:
            raise LookupError(f"{spec.name}: version {version} is no longer kept")
        return self.log(spec.name).at(n)

    def stored_keys(self, spec: TableSpec, state: State, rows: DataFrame) -> DataFrame:
        """The distinct keys of ``rows`` that the table holds, from the key bitmaps alone: no stored row is read.

        Exact, as a bitmap has one bit for each key of its part."""
        key = spec.key
        asked = rows.select(F.col(key), self.part_of(spec, state).alias("part"), self._place(spec, state).alias("place")).distinct()
        asked = asked.select(key, "part", F.bitmap_bucket_number("place").alias("bucket"), F.bitmap_bit_position("place").alias("at"))
        if not state.segments:
            return asked.select(key).limit(0)
        held = self._held_bits(spec, state).join(asked.select("part", "bucket").distinct(), ["part", "bucket"], "left_semi")
        held = held.groupBy("part", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        return asked.join(held, ["part", "bucket"]).where(_bit_set()).select(key)

    def without_stored(self, spec: TableSpec, state: State, rows: DataFrame) -> DataFrame:
        """The rows whose key the table does not hold, from the key bitmaps alone.

        Bitmaps measured small are broadcast, so that the rows stay where they are; else the rows are joined to the stored keys among theirs."""
        if not state.segments:
            return rows
        held = self._trimmed(state, self._held_bits(spec, state))
        if measured_bytes(held) is None:
            return rows.join(self.stored_keys(spec, state, rows), spec.key, "left_anti").select(*spec.column_names)
        return self._by_bits(spec, state, rows, held, "left_anti")

    def _by_bits(self, spec: TableSpec, state: State, rows: DataFrame, bits: DataFrame, how: str) -> DataFrame:
        """The rows whose key is (``left_semi``) or is not (``left_anti``) among those of the bitmaps, which are broadcast."""
        bits = self._trimmed(state, bits.groupBy("part", "bucket").agg(F.bitmap_or_agg("bits").alias("bits")))
        bits = bits.withColumnsRenamed({"part": "__part", "bucket": "__bucket"})
        place = self._place(spec, state)
        asked = rows.withColumns({"__at_part": self.part_of(spec, state), "__at_bucket": F.bitmap_bucket_number(place), "at": F.bitmap_bit_position(place)})
        same = (F.col("__at_part") == F.col("__part")) & (F.col("__at_bucket") == F.col("__bucket")) & _bit_set()
        return asked.join(F.broadcast(bits), same, how).select(*rows.columns)

    def _trimmed(self, state: State, bits: DataFrame) -> DataFrame:
        """The bitmaps without the bytes that no key of a part narrower than a bitmap can reach."""
        return bits.withColumn("bits", F.substring("bits", 1, -(-min(self._width(state), BITMAP_BITS) // 8)))

    def _key_bits(self, spec: TableSpec, state: State, rows: DataFrame) -> DataFrame:
        """The keys of ``rows`` as bitmaps."""
        place = self._place(spec, state)
        return rows.groupBy(self.part_of(spec, state).alias("part"), F.bitmap_bucket_number(place).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
        )

    def upserted(self, spec: TableSpec, state: State, target: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame] | None:
        """``rows`` (one a key, no NULL key) upserted into the ``target`` rows of a state: the rows that change nothing in one another, which lie where
        they did, and the updated ones, dealt by part. None if the keys' bitmaps are not measured small.

        The bitmaps of both sides tell the rows without a counterpart, which need no join. Of the others, the target's rows and only the update
        columns of the new ones are dealt, once and by part, so that the result needs no dealing for its files."""
        held, asked = self._trimmed(state, self._held_bits(spec, state)), self._trimmed(state, self._key_bits(spec, state, rows.select(spec.key)))
        if measured_bytes(held) is None or measured_bytes(asked) is None:
            return None
        alone = self._by_bits(spec, state, target, asked, "left_anti").unionByName(self._by_bits(spec, state, rows, held, "left_anti"))
        block = F.expr(f"CAST(`{spec.key}` AS BIGINT) DIV {min(self._width(state), BLOCK_KEYS)}")
        updated = update_dealt(
            self._by_bits(spec, state, target, asked, "left_semi"), self._by_bits(spec, state, rows, held, "left_semi"), spec.key, spec.update_columns, block
        )
        return alone, updated

    def _held_bits(self, spec: TableSpec, state: State) -> DataFrame:
        """The key bitmaps of the state's segments."""
        base = f"{self.root}/tables/{spec.name}/_keys"
        versions = sorted({s.version for s in state.segments})
        held = self.spark.read.schema("part long, bucket long, bits binary, v string").option("basePath", base).parquet(
            *(self.keys_path(spec.name, v) for v in versions)
        )
        named = self.spark.createDataFrame([(s.version, s.part) for s in state.segments], "v string, part long")
        return held.join(named, ["v", "part"], "left_semi").drop("v")

    def compact(self, spec: TableSpec, run_id: str, ratio: float = 0.25) -> list[int]:
        """Rewrite the parts whose deltas hold over ``ratio`` of the rows of their base; returns them."""
        state = self.log(spec.name).at()
        rows: dict[int, list[int]] = {}
        for s in state.segments:
            rows.setdefault(s.part, [0, 0])[s.kind == "delta"] += s.rows
        grown = sorted(p for p, (base, delta) in rows.items() if delta and delta > ratio * base)
        if grown:
            version = f"c{run_id}"
            added = self.write_parts(self.read_state(spec, state, grown), spec, version, state)
            held = state.control
            at = lambda c: dt.datetime.strptime(held[c], TIME_FORMAT)
            self.commit(spec, state, held["run_id"], at("last_loaded_at"), at("last_run_at"), held["rows_loaded"], added, grown, version)
        return grown

    def collect_garbage(self, spec: TableSpec, older_than: float = 86400.0) -> list[str]:
        """Remove folders of a table that no kept commit can reach; returns their paths.

        ``older_than`` (seconds) spares what a running load has written and not yet committed."""
        log, kept = self.log(spec.name), set()
        for n, _ in log.history():
            kept |= {s.version for s in log.at(n).segments}
        kept |= {s.version for s in log.at().segments}
        runs = {e["control"]["run_id"] for _, e in log.history()}
        base, gone, now = f"{self.root}/tables/{spec.name}", [], time.time()
        for folder, needed in ((base, kept), (f"{base}/_keys", kept), (f"{self.root}/slices/{spec.name}", runs)):
            for name in self.files.names(folder):
                version = name.removeprefix("v=")
                if name.startswith("v=") and version not in needed and self.files.age(f"{folder}/{name}", now) >= older_than:
                    self.files.remove(f"{folder}/{name}")
                    gone.append(f"{folder}/{name}")
        return gone

    def write_slice(self, df: DataFrame, table: str, run_id: str) -> DataFrame:
        """Materialise a slice (cutting its lineage to the source) and return the stored copy."""
        path = self.slice_path(table, run_id)
        with self._set(RELEASE):
            df.write.mode("overwrite").option("compression", CODEC).option("maxRecordsPerFile", SLICE_FILE_ROWS).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # marts and builds
    def _next_commit(self, history: DataFrame) -> str:
        last = history.agg(F.max("committed_at")).collect()[0][0]
        now = dt.datetime.now()
        now = max(now, last + dt.timedelta(microseconds=1)) if last is not None else now
        return now.strftime(TIME_FORMAT)

    # day-partitioned marts: each run writes the days it recomputed; a manifest names each day's version
    def manifest_path(self, model: str) -> str:
        return f"{self.root}/marts/{model}/_manifest"

    def mart_days(self, model: str) -> DataFrame:
        """Current version of each day of a day-partitioned mart: (day, version); deleted days are absent."""
        base = self.manifest_path(model)
        if not self.exists(base):
            return self.spark.createDataFrame([], "day date, version string")
        hist = self._read_entries(base, MANIFEST_SCHEMA)
        newest = hist.groupBy("day").agg(F.max_by("version", F.struct("committed_at", "run_id")).alias("version"))
        return newest.filter(F.col("version").isNotNull())

    # builds: which table versions a finished build of all marts has used
    def write_build(self, versions: dict[str, str | None], run_id: str) -> None:
        """Record a finished build; a build that died leaves no record."""
        builds = self.builds()
        committed = self._next_commit(builds)
        rows = [(t, v, run_id) for t, v in sorted(versions.items())]
        df = self.spark.createDataFrame(rows, "table_name string, version string, run_id string")
        df = df.withColumn("committed_at", F.lit(committed).cast("timestamp_ntz"))
        df.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/builds/{run_id}")

    def builds(self) -> DataFrame:
        if not self.exists(f"{self.root}/builds"):
            return self.spark.createDataFrame([], BUILD_SCHEMA)
        return self._read_entries(f"{self.root}/builds", BUILD_SCHEMA)

    def last_build(self) -> dict[str, str | None] | None:
        """Table versions of the newest finished build, or None before the first."""
        newest = self.builds().orderBy(F.desc("committed_at"), F.desc("run_id")).limit(1).collect()
        if not newest:
            return None
        rows = self.builds().filter(F.col("run_id") == newest[0]["run_id"]).collect()  # one row a table
        return {r["table_name"]: r["version"] for r in rows}

    def _day_dirs(self, path: str, day_col: str) -> set:
        """Day values present under a partitioned write (directory names ``day_col=<value>``)."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(conf)
        if not fs.exists(root):
            return set()
        prefix = f"{day_col}="
        return {
            dt.date.fromisoformat(st.getPath().getName()[len(prefix):])
            for st in fs.listStatus(root)
            if st.isDirectory() and st.getPath().getName().startswith(prefix)
        }

    def write_days(self, df: DataFrame, model: str, day_col: str, run_id: str, days, lie: bool = False) -> None:
        """Write ``df`` (rows of ``days`` only) as this run's version of those days, then commit the manifest:
        each of ``days`` now points to this version, or is marked deleted when it has no rows any more.

        The rows are dealt by day first, unless they ``lie`` well (``_write_by``)."""
        path = self.mart_path(model, run_id)
        self._write_by(df, day_col, path, lie)
        present = self._day_dirs(path, day_col)
        base = self.manifest_path(model)
        known = self._read_entries(base, MANIFEST_SCHEMA) if self.exists(base) else self.spark.createDataFrame([], MANIFEST_SCHEMA)
        committed = self._next_commit(known)
        rows = [(d, run_id if d in present else None, run_id) for d in sorted(set(days) | present)]
        (
            self.spark.createDataFrame(rows, "day date, version string, run_id string")
            .withColumn("committed_at", F.lit(committed).cast("timestamp_ntz"))
            .coalesce(1)
            .write.mode("overwrite")
            .parquet(f"{self.manifest_path(model)}/{run_id}")
        )

    def read_days(self, model: str, day_col: str, schema: T.StructType, days=None) -> DataFrame:
        """The current rows of a day-partitioned mart (only ``days`` when given: the other days are not read)."""
        current = self.mart_days(model)
        if days is not None:
            current = current.filter(F.col("day").isin(list(days)))
        versions = current.collect()  # one row per day: bounded by the calendar, not by the data
        if not versions:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.mart_path(model, r['version'])}/{day_col}={r['day'].isoformat()}" for r in versions]
        df = self.spark.read.option("basePath", f"{self.root}/marts/{model}").parquet(*paths)
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])

    def read_mart(self, model: str, version: str, schema=None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        df = reader.parquet(self.mart_path(model, version))
        return df if schema is None else df.select(*schema.fieldNames())


def _bit_set() -> Column:
    """Whether the bit ``at`` of the bitmap ``bits`` is set."""
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.shiftright("at", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod("at", F.lit(8)).cast("int")) == 1


def key_sql(spec: TableSpec) -> str:
    return f"CAST(`{spec.key}` AS BIGINT)"
