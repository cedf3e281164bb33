"""Bucketed Spark tables with a version pointer: the keyed silver/gold sink (O5) and named sources.

Rows are written by Spark's own ``bucketBy`` and read as a catalog table that is bucketed by
its key and partitioned by bucket, each partition with a location of its own. So a join on
the key reads the stored side without an exchange, and a version can name a new folder for
the buckets that a merge touched and the old ones for the rest.

The pointer to a version is one line of JSON (bucket -> folder), claimed by creating its file
exclusively: of two writers that started from the same version, the second one fails
(``replace``) or merges again on top of the first (``merge``). All that belongs to a run
(closed history, progress of its sources) is part of the same line.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import registry as R
from strata.operators import checks
from strata.session import materialize
from strata.sources import files

COMMITS = "_commits"
BUCKET = "__bucket"
#: True for rows that the merge which wrote them inserted or changed.
CHANGED = "__changed"
#: About how large a bucket should be (:meth:`VersionedTable.rebucket`).
BUCKET_BYTES = 256 << 20
#: Batches of at most so many rows look their keys up by value: row groups whose Bloom filter
#: holds none of them are not read (``session.SQL_SETTINGS`` pushes as many values down).
LOOKUP_KEYS = 200


class WriteConflict(RuntimeError):
    """Another writer committed the version that this one was about to commit."""


@dataclass
class Commit:
    """What one version of a table consists of."""

    version: int
    schema: str
    paths: dict[str, str] = field(default_factory=dict)  # bucket -> data folder
    closed: list[str] = field(default_factory=list)  # folders of closed history versions
    streams: dict[str, int] = field(default_factory=dict)  # source identity -> last batch or version applied
    buckets: int = 16


@dataclass
class VersionedTable:
    """``buckets``: hash buckets of ``bucket_by`` (default: the key), one task and file each; ``rebucket``
    sizes them anew. ``evolve``: columns beyond the registry are stored too, appended when a
    state brings them."""

    spark: SparkSession
    root: str
    registry: tuple
    name: str = "table"
    buckets: int = 16
    bucket_by: tuple = ()
    evolve: bool = False

    def __post_init__(self):
        self.root = self.root.rstrip("/")
        self._seen: Commit | None = None
        self._loaded = False

    # ------------------------------------------------------------- commits

    def _marker(self, version: int) -> str:
        return f"{self.root}/{COMMITS}/{version:08d}.json"

    def refresh(self) -> int | None:
        """Re-read the newest complete commit. A marker without content is a claim whose
        writer has not finished (or died); it never becomes current."""
        self._seen, self._loaded = None, True
        for name in reversed(files.names(self.spark, f"{self.root}/{COMMITS}")):
            if name.endswith(".json"):
                text = files.read(self.spark, f"{self.root}/{COMMITS}/{name}")
                if text.endswith("\n"):
                    self._seen = Commit(**json.loads(text))
                    self.buckets = self._seen.buckets
                    break
        return None if self._seen is None else self._seen.version

    def _base(self) -> Commit | None:
        if not self._loaded:
            self.refresh()
        return self._seen

    def _commit(self, base: Commit | None, commit: Commit) -> None:
        """Claim the version after ``base``. Versions claimed by dead writers are passed over;
        one with content means that somebody else was first."""
        version = -1 if base is None else base.version
        while True:
            version += 1
            commit.version = version
            try:
                files.create(self.spark, self._marker(version), json.dumps(vars(commit)) + "\n")
                break
            except files.AlreadyThere:
                if files.read(self.spark, self._marker(version)).endswith("\n"):
                    self._loaded = False
                    raise WriteConflict(f"{self.name}: version {version} was committed by another writer") from None
        self._seen, self._loaded = commit, True

    def current_version(self) -> int | None:
        """Newest committed version; read once, then kept up to date by this object's own
        commits (call :meth:`refresh` to see commits made elsewhere)."""
        base = self._base()
        return None if base is None else base.version

    def exists(self) -> bool:
        return self._base() is not None

    def verify(self) -> None:
        """O5 verify mode: the table must already exist."""
        if not self.exists():
            raise RuntimeError(f"table {self.name} does not exist at {self.root}; create it first")

    def create(self) -> None:
        """O5 auto-create: an empty version 0 with the registry schema; a table that another
        writer creates meanwhile is used."""
        if not self.exists():
            try:
                self._commit(None, Commit(0, R.spark_schema(self.registry).json(), buckets=self.buckets))
            except WriteConflict:
                self.refresh()

    # ------------------------------------------------------------- reading

    def schema(self) -> T.StructType:
        base = self._base()
        return R.spark_schema(self.registry) if base is None else T.StructType.fromJson(json.loads(base.schema))

    def _bucketed(self, commit: Commit) -> DataFrame:
        """A version as a catalog table: bucketed by key, a partition a bucket. Versions never
        change, so the name of one is registered once and dropped when it expires."""
        name = self._table_name(commit.version)
        if not self.spark.catalog.tableExists(name):
            schema = T.StructType.fromJson(json.loads(commit.schema))
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            keys = ", ".join(f"`{k}`" for k in self.keys())
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {CHANGED} BOOLEAN, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {commit.buckets} BUCKETS LOCATION '{_quoted(self.root)}/data'"
            )
            parts = [f"PARTITION ({BUCKET}={b}) LOCATION '{_quoted(p)}'" for b, p in sorted(commit.paths.items())]
            for i in range(0, len(parts), 500):
                self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(parts[i : i + 500])}")
        return self.spark.table(name)

    def _table_name(self, version: int) -> str:
        return f"strata_{hashlib.md5(self.root.encode()).hexdigest()[:16]}_{version}"

    def read(self, buckets: list[str] | None = None, *, changed: bool = False) -> DataFrame:
        """Current rows, or those of some buckets, or of those only the ones that their merge
        inserted or changed (an empty frame with the registry schema before the first write)."""
        base = self._base()
        wanted = [] if base is None else sorted(base.paths) if buckets is None else [b for b in buckets if b in base.paths]
        if not wanted:
            return self.spark.createDataFrame([], self.schema())
        rows = self._bucketed(base)
        if buckets is not None:
            rows = rows.where(F.col(BUCKET).isin([int(b) for b in wanted]))
        return (rows.where(CHANGED) if changed else rows).select(*self.schema().names)

    def read_closed(self) -> DataFrame:
        base = self._base()
        if not base or not base.closed:
            return self.spark.createDataFrame([], self.schema())
        return self.spark.read.schema(self.schema()).parquet(*base.closed)

    def changes_since(self, version: int | None) -> DataFrame | None:
        """Current rows that may differ from those of an older version; None if there are none.

        Only rewritten buckets are read: of one that a single merge rewrote, the rows this merge
        marked; of others (or if the older version has expired) all rows.
        """
        base = self._base()
        if base is None or base.version == version:
            return None
        told = {}
        for v in range((version if version is not None else -1), base.version + 1) if version is not None else ():
            text = files.read(self.spark, self._marker(v)) if files.exists(self.spark, self._marker(v)) else ""
            if text.endswith("\n"):
                told[v] = Commit(**json.loads(text))
        if version not in told or told[version].buckets != base.buckets:
            return self.read()
        old = told[version].paths
        rewritten = [b for b, p in base.paths.items() if old.get(b) != p]
        if not rewritten:
            return None
        once = [b for b in rewritten if len({c.paths.get(b) for c in told.values()} - {old.get(b)}) == 1]
        often = [b for b in rewritten if b not in set(once)]
        marked = self.read(once, changed=True)
        return marked.unionByName(self.read(often)) if often else marked

    def progress(self, source: str) -> int | None:
        """The last batch or version of a source that this table holds."""
        base = self._base()
        return base.streams.get(source) if base else None

    def data_folders(self) -> dict[str, str]:
        base = self._base()
        return dict(base.paths) if base else {}

    def lookup(self, buckets: list[str], batch: DataFrame, n: int) -> DataFrame:
        """Stored rows of some buckets that a batch of ``n`` rows may meet: those of its keys if it is small, else all."""
        rows, keys = self.read(buckets), R.key_columns(self.registry)
        if n > LOOKUP_KEYS or len(keys) != 1:
            return rows
        return rows.where(F.col(keys[0]).isin([r[0] for r in batch.select(keys[0]).distinct().collect()]))

    # ------------------------------------------------------------- writing

    def keys(self) -> list[str]:
        return list(self.bucket_by or R.key_columns(self.registry))

    def bucket(self):
        """The bucket of a row, as ``bucketBy`` deals them."""
        return F.pmod(F.hash(*self.keys()), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[str]:
        """The buckets that the keys of some rows fall in (at most ``buckets``)."""
        return [str(r[0]) for r in rows.select(self.bucket()).distinct().collect()]

    def _columns(self, state: DataFrame) -> list[str]:
        """Registry columns, then (with ``evolve``) stored and new columns beyond it."""
        cols = R.names(self.registry, managed=True)
        if self.evolve:
            cols = list(dict.fromkeys([*cols, *self.schema().names, *[c for c in state.columns if c != CHANGED]]))
        return cols

    def _store(self, state: DataFrame, laid: bool) -> tuple[dict[str, str], str]:
        """Write bucketed files. A state that comes out of a join with bucketed rows is ``laid``
        by bucket already; any other is dealt out, one task a bucket."""
        cols = self._columns(state)
        name = f"strata_{uuid.uuid4().hex}"
        folder = f"{self.root}/data/{name}"
        rows = state if laid else state.repartition(self.buckets, *self.keys())
        mark = F.coalesce(CHANGED, F.lit(False)) if CHANGED in state.columns else F.lit(True)
        rows = rows.select(*[c for c in cols if c in state.columns], mark.alias(CHANGED), self.bucket().alias(BUCKET))
        blooms = {f"parquet.bloom.filter.enabled#{k}": "true" for k in R.key_columns(self.registry)} | {"parquet.bloom.filter.adaptive.enabled": "true"}
        rows.write.partitionBy(BUCKET).bucketBy(self.buckets, *self.keys()).sortBy(*self.keys()).options(**blooms).option("path", folder).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay; versions have tables of their own
        made = {n.split("=", 1)[1]: f"{folder}/{n}" for n in files.names(self.spark, folder) if n.startswith(f"{BUCKET}=")}
        fields = {f.name: f for f in [*state.schema.fields, *self.schema().fields, *R.spark_schema(self.registry).fields]}
        return made, T.StructType([fields[c] for c in cols]).json()

    def replace(
        self, state: DataFrame | None, touched: list[str] | None = None, *, closed: list[str] = (), stream: tuple[str, int] | None = None, laid: bool = False,
    ) -> int:
        """Commit ``state`` as the rows of the touched buckets (None: of the whole table) on
        top of the version this object last saw; without a state, only the progress. Raises :class:`WriteConflict` if another
        writer was faster; nothing of this run is visible then."""
        base = self._base()
        made, schema = self._store(state, laid) if state is not None else ({}, self.schema().json())
        kept = {} if touched is None or base is None else {b: p for b, p in base.paths.items() if b not in touched}
        self._commit(base, Commit(
            0, schema, kept | made, [*(base.closed if base else []), *closed],
            (base.streams if base else {}) | ({stream[0]: stream[1]} if stream else {}), self.buckets,
        ))
        return self._seen.version

    def _sent(self, batch: DataFrame) -> DataFrame:
        cols = self._columns(batch)
        return batch.select(*[c for c in cols if c in batch.columns])

    def gate(self, sent: DataFrame) -> None:
        checks.gate(checks.constraint_violations(sent, self.registry, self.name))

    def merge(
        self, batch: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame], *,
        gate_rows: DataFrame | None = None, gate: bool = True, stream: tuple[str, int] | None = None, attempts: int = 5,
        effect: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    ) -> int:
        """Merge a stored ``batch``: ``how(stored rows of the touched buckets, batch)`` is their
        new state; the other buckets keep their files. The batch (``gate_rows`` if it gets
        its managed columns in the merge) must pass the gate: stored rows passed it when
        they were written, and a merge of unique keys keeps keys unique. If another writer
        commits meanwhile, the batch is merged again on top of its version. A batch of a
        ``stream`` that the table already holds is skipped, in the same commit protocol.
        ``effect(stored rows, batch)`` tells the batch rows that change anything; only their
        buckets are read whole and written, and a batch without any writes no data.
        Returns the number of rows sent; an empty batch changes no rows."""
        sent = self._sent(gate_rows if gate_rows is not None else batch)
        n = sent.count()
        if gate and n:
            self.gate(sent)
        touched = self.touched(batch) if n else []
        for attempt in range(attempts):
            self.refresh()
            base = self._base()
            if stream and base and base.streams.get(stream[0], -1) >= stream[1]:
                return 0
            if not n and not stream:
                return 0
            held, rows, written = [b for b in touched if base and b in base.paths], batch, touched
            if effect and held:
                rows = materialize(effect(self.lookup(held, batch, n), batch), f"{self.name}-effect")
                written = self.touched(rows)
                held = [b for b in held if b in written]
                if not written and not stream:
                    return n
            state = how(self.read(held), rows) if written else None
            try:
                self.replace(state, written, stream=stream, laid=bool(held))
                return n
            except WriteConflict:
                if attempt == attempts - 1:
                    raise
        return n

    def write(self, new_state: DataFrame, *, batch: DataFrame | None = None, gate: bool = True) -> int:
        """Replace the whole table with ``new_state`` as a new version on top of the one last
        read; :class:`WriteConflict` if somebody else committed since. ``batch`` is what the
        gate checks; an empty batch writes nothing. Returns the number of rows sent."""
        n = 0
        if batch is not None:
            sent = self._sent(batch)
            n = sent.count()
            if n == 0:
                return 0
            if gate:
                self.gate(sent)
        self.replace(new_state)
        return n

    def rebucket(self, buckets: int | None = None) -> int:
        """Write the table anew in ``buckets`` buckets (default: by its size, ``BUCKET_BYTES`` each) and
        return their number. A merge task holds one bucket, so run this when a table has grown."""
        if buckets is None:
            base = self._base()
            folders = {p.rsplit("/", 1)[0] for p in base.paths.values()} if base else set()
            buckets = max(16, -(-sum(files.size(self.spark, p) for p in folders) // BUCKET_BYTES))
        rows = self.read()
        self.buckets = buckets
        self.replace(rows)
        return buckets

    def expire(self, keep: int = 2) -> int:
        """Delete commits before the last ``keep`` and the data folders that only they name.
        Run it when no reader is on an older version; returns the number of folders deleted."""
        folder = f"{self.root}/{COMMITS}"
        markers = [n for n in files.names(self.spark, folder) if n.endswith(".json")]
        texts = {n: files.read(self.spark, f"{folder}/{n}") for n in markers}
        complete = [n for n in markers if texts[n].endswith("\n")]
        live = {p.rsplit("/data/", 1)[1].split("/")[0] for n in complete[-keep:] for c in [Commit(**json.loads(texts[n]))] for p in [*c.paths.values(), *c.closed]}
        past = [Commit(**json.loads(texts[n])) for n in complete[:-keep]]
        # Only what an old commit names goes: a folder without commit may be a write under way.
        gone = {p.rsplit("/data/", 1)[1].split("/")[0] for c in past for p in [*c.paths.values(), *c.closed]} - live
        for c in past:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table_name(c.version)}")
        for n in complete[:-keep]:
            files.delete(self.spark, f"{folder}/{n}")
        for name in gone:
            files.delete(self.spark, f"{self.root}/data/{name}")
        return len(gone)


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


class Sources:
    """Named tables (``source('silver', 'rental_listings')``) as lazy DataFrames."""

    def __init__(self, tables: dict[tuple[str, str], DataFrame | VersionedTable] | None = None):
        self._tables = dict(tables or {})

    def register(self, schema: str, name: str, table) -> None:
        self._tables[(schema, name)] = table

    def source(self, schema: str, name: str) -> DataFrame:
        if (schema, name) not in self._tables:
            raise KeyError(f"no source {schema}.{name}; known: {sorted('.'.join(k) for k in self._tables)}")
        t = self._tables[(schema, name)]
        return t.read() if isinstance(t, VersionedTable) else t

    def changes_since(self, schema: str, name: str, version: int | None) -> tuple[DataFrame | None, int | None]:
        """What may have changed since a version of a stored source (None: nothing), and its version now.
        A frame has no versions: all of it may have changed."""
        table = self._tables.get((schema, name))
        if not isinstance(table, VersionedTable):
            return self.source(schema, name), None
        return table.changes_since(version), table.current_version()

    def as_views(self, spark: SparkSession) -> None:
        for (schema, name), _ in self._tables.items():
            self.source(schema, name).createOrReplaceTempView(f"{schema}_{name}")


def batch_time(value=None) -> dt.datetime:
    """A batch timestamp argument (UTC, microseconds), defaulting to now."""
    return value or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
