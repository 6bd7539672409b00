"""A keyed table on Parquet: one row per key, upserted by appends that are folded when read.

Open-source Spark has no keyed table and no streaming upsert sink, so this is
the target of the streaming upsert (``INSERT ... ON CONFLICT (key) DO UPDATE``
semantics) and of table sync.  A batch is appended as its own Parquet folder,
so it costs what the batch holds, not what the table holds; reads fold the
newest values per key over the last compacted base.

Layout below ``path``::

    _log/<seq:020d>.json    one entry per commit, created without overwriting
    data/<time>-<id>/       Parquet of one commit: a batch's rows, or a base in ``_bucket=<b>`` folders

Entries are ``create``, ``delta`` (a batch: its columns, order and writer) and
``base`` (all rows as of entry ``folds``).  A commit takes the next free
number; if another writer took it, the next is tried, so concurrent writers
all land without writing their data again.  A crash before the entry exists
leaves an unreferenced folder only, which ``vacuum`` removes by age.  A batch
id at or below the writer's last one is skipped, so replays change nothing.

Merge rules: an absent key is inserted (unsupplied columns take their declared
default, evaluated when the batch is written, or null); a present key gets
every supplied non-key column overwritten, nulls included, and keeps the
others; a null key is an error; with ``order_by`` the row with the larger
order values wins, and of equal ones the later.  Batches between two bases
share ``order_by`` (and, if ordered, their columns); a batch that differs
makes a base first.

A base is made by an ordinary batch job after ``COMPACT_BATCHES`` batches or
when their rows reach ``COMPACT_SHARE`` of the base.  Its rows lie in ``B``
buckets by ``pmod(xxhash64(key...), B)``, one task and one folder each, so
point lookups read one bucket and the batches since.
"""

from __future__ import annotations

import json
import posixpath
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import change_history
from tidemark.sources.files import FileSystem

DEFAULT_BUCKETS = 16
BUCKET = "_bucket"
KEY_TYPES = (T.StringType, T.NumericType)
COMPACT_BATCHES = 50
COMPACT_SHARE = 0.5
COMMIT_TRIES = 1000


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets))


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.fs = FileSystem(spark, self.path)
        self._ldir = posixpath.join(self.path, "_log")
        self._entries: dict[int, dict] = {}

    # ---- the log --------------------------------------------------------------

    @classmethod
    def exists(cls, spark: SparkSession, path: str) -> bool:
        return bool(cls(spark, path)._numbers())

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str] | str,
               defaults: Mapping[str, str] | None = None, buckets: int | None = None,
               if_not_exists: bool = True) -> "KeyedTable":
        """Create the table; with ``if_not_exists`` an existing table with the same key is reused.

        ``defaults`` maps a column to a SQL expression used when an insert does
        not supply it (e.g. ``{"updated_ts": "current_timestamp()"}``).
        ``buckets`` defaults to the session's ``spark.sql.shuffle.partitions``,
        the parallelism the session is already sized for; size it so a bucket
        holds roughly 128 MB to 1 GB.
        """
        keys = [keys] if isinstance(keys, str) else list(keys)
        if buckets is None:
            buckets = int(spark.conf.get("spark.sql.shuffle.partitions", str(DEFAULT_BUCKETS)))
        t = cls(spark, path)
        names = [f.name for f in schema.fields]
        for k in keys:
            if k not in names:
                raise ValueError(f"key column {k!r} not in schema")
            if not isinstance(schema[k].dataType, KEY_TYPES):
                raise TypeError(f"key column {k!r} must be numeric or string, not {schema[k].dataType.simpleString()}")
        for c in (defaults or {}):
            if c not in names:
                raise ValueError(f"default for unknown column {c!r}")
        # Key columns are NOT NULL, as a primary key.
        fields = [T.StructField(f.name, f.dataType, f.nullable and f.name not in keys) for f in schema.fields]
        entry = {"seq": 0, "kind": "create", "keys": keys, "defaults": dict(defaults or {}),
                 "schema": T.StructType(fields).json(), "buckets": int(buckets), "time": time.time()}
        t.fs.mkdirs(t._ldir)
        if t._numbers() or not t._put(entry):
            if not if_not_exists:
                raise FileExistsError(path)
            if sorted(t.keys) != sorted(keys):
                raise ValueError(f"table at {path} is keyed by {t.keys}, not {keys}")
        return t

    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.fs.list_names(self._ldir) if n.endswith(".json") and n[:-5].isdigit())

    def _entry(self, seq: int) -> dict:
        if seq not in self._entries:   # an entry never changes
            self._entries[seq] = json.loads(self.fs.read_text(posixpath.join(self._ldir, f"{seq:020d}.json")))
        return self._entries[seq]

    def _put(self, entry: dict) -> bool:
        return self.fs.create_new(posixpath.join(self._ldir, f"{entry['seq']:020d}.json"), json.dumps(entry, sort_keys=True))

    def state(self, version: int | None = None) -> dict:
        """What a read at ``version`` (default: now) uses: the base entry, the deltas behind it, writers."""
        numbers = self._numbers()
        if version is not None:
            numbers = [n for n in numbers if n <= version]
        if not numbers:
            raise FileNotFoundError(f"no keyed table at {self.path}" + (f" as of version {version}" if version is not None else ""))
        root, deltas = None, []
        for n in reversed(numbers):
            if root is not None and n <= root["folds"]:
                break
            e = self._entry(n)
            if e["kind"] == "delta":
                deltas.append(e)
            elif root is None or e.get("folds", 0) > root["folds"]:
                root = dict(e, folds=e.get("folds", 0))
        if root is None:
            raise FileNotFoundError(f"version {version} of {self.path} is no longer kept")
        deltas = [e for e in reversed(deltas) if e["seq"] > root["folds"]]
        writers = dict(root.get("writers", {}))
        for e in deltas:
            if e.get("writer") is not None:
                writers[e["writer"]] = max(e["batch"], writers.get(e["writer"], -1))
        return {"version": numbers[-1], "root": root, "deltas": deltas, "writers": writers, "keys": list(root["keys"]),
                "schema": T.StructType.fromJson(json.loads(root["schema"])), "buckets": int(root["buckets"]),
                "defaults": root.get("defaults", {})}

    def _commit(self, entry: dict) -> bool:
        """Append ``entry`` under the next free number; False if its batch was committed meanwhile."""
        for _ in range(COMMIT_TRIES):
            s = self.state()
            if entry.get("writer") is not None and s["writers"].get(entry["writer"], -1) >= entry["batch"]:
                return False
            e = dict(entry, seq=s["version"] + 1, time=time.time())
            if e["kind"] == "base":
                e = {"folds": e["seq"], "writers": s["writers"]} | e   # a replacement stands for all before it
            if self._put(e):
                return True
        raise RuntimeError(f"no commit to {self.path} after {COMMIT_TRIES} tries")

    @property
    def keys(self) -> list[str]:
        return self.state()["keys"]

    @property
    def schema(self) -> T.StructType:
        return self.state()["schema"]

    @property
    def version(self) -> int:
        return self.state()["version"]

    def last_batch(self, writer: str) -> int:
        return int(self.state()["writers"].get(writer, -1))

    # ---- reads ---------------------------------------------------------------

    def _base(self, s: dict) -> DataFrame | None:
        if not s["root"].get("path"):
            return None
        return self.spark.read.schema(T.StructType([*s["schema"].fields, T.StructField(BUCKET, T.IntegerType())])).parquet(s["root"]["path"])

    def _folded(self, s: dict, where: Column | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """Current rows; ``where`` (on keys) and ``buckets`` narrow what is read."""
        schema, keys = s["schema"], s["keys"]

        def narrowed(df: DataFrame) -> DataFrame:
            if buckets is not None:
                b = F.col(BUCKET) if BUCKET in df.columns else bucket_of(keys, s["buckets"])
                df = df.where(b.isin([int(x) for x in buckets]))
            return df if where is None else df.where(where)

        base = self._base(s)
        base = None if base is None else narrowed(base).select(*schema.names)
        deltas = [e for e in s["deltas"] if e.get("path")]
        if not deltas:
            return base if base is not None else self.spark.createDataFrame([], schema)
        # One read per set of columns, however many batches.
        sets: dict[tuple, list[dict]] = {}
        for e in deltas:
            sets.setdefault((tuple(e["columns"]), tuple(e["defaults"])), []).append(e)
        parts = []
        for (cols, defaulted), entries in sets.items():
            fields = [schema[c] for c in cols] + [T.StructField(f"_d_{c}", schema[c].dataType) for c in defaulted]
            read = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [T.StructField("_seq", T.StringType())])
            df = self.spark.read.schema(read).parquet(*[e["path"] for e in entries])
            seq = F.create_map(*[x for e in entries for x in (F.lit(e["mark"]), F.lit(e["seq"]))])
            df = narrowed(df).withColumn("_seq", seq[F.col("_seq")].cast("long"))
            parts.append(df.withColumn("_has", F.array(*[F.lit(c) for c in cols])))
        news = parts[0]
        for p in parts[1:]:
            news = news.unionByName(p, allowMissingColumns=True)
        if base is None:
            return self._fold(s, news)
        # Base rows without news stay as they are, unshuffled when the batches' keys are few.
        touched = news.select(*keys).distinct()
        old = base.join(touched, keys, "left_semi").withColumn("_seq", F.lit(-1).cast("long")) \
                  .withColumn("_has", F.array(*[F.lit(c) for c in schema.names]))
        return base.join(touched, keys, "left_anti").unionByName(self._fold(s, news.unionByName(old, allowMissingColumns=True)))

    @staticmethod
    def _fold(s: dict, rows: DataFrame) -> DataFrame:
        """One row per key from rows with ``_seq`` (-1: base) and ``_has`` (the supplied columns)."""
        order = next((e["order_by"] for e in s["deltas"] if e.get("path")), [])
        rank = F.struct(*[F.col(c) for c in order], F.col("_seq"))
        members = {c: tuple(i for i, e in enumerate(s["deltas"]) if e.get("path") and c in e["columns"]) for c in s["schema"].names}
        groups: dict[tuple, list[str]] = {}
        for c in s["schema"].names:
            if c not in s["keys"]:
                groups.setdefault(members[c], []).append(c)
        aggs, out = [], {k: F.col(k) for k in s["keys"]}
        for g, cols in enumerate(groups.values()):
            values = F.struct(*[F.col(c) if c in rows.columns else F.lit(None).cast(s["schema"][c].dataType).alias(c) for c in cols])
            aggs.append(F.max_by(values, F.when(F.array_contains("_has", cols[0]), rank)).alias(f"_g{g}"))
            for c in cols:
                out[c] = F.col(f"_g{g}")[c]
                if f"_d_{c}" in rows.columns:   # the default that the first batch of a new key gave
                    aggs.append(F.min_by(f"_d_{c}", F.when(~F.array_contains("_has", c), F.col("_seq"))).alias(f"_d_{c}"))
                    out[c] = F.when(F.col(f"_g{g}").isNull(), F.col(f"_d_{c}")).otherwise(out[c])
        folded = rows.groupBy(*s["keys"]).agg(*aggs) if aggs else rows.select(*s["keys"]).distinct()
        return folded.select(*[out[f.name].cast(f.dataType).alias(f.name) for f in s["schema"].fields])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows as of ``version`` (default: the current ones)."""
        return self._folded(self.state(version))

    def read_buckets(self, buckets: Sequence[int]) -> DataFrame:
        """The current rows of the given buckets only."""
        return self._folded(self.state(), buckets=buckets)

    def buckets_of(self, df: DataFrame) -> list[int]:
        """Bucket ids that the keys of ``df`` fall in (at most ``B`` values, one small job)."""
        s = self.state()
        got = (df.select(bucket_of(s["keys"], s["buckets"]).alias("_b")).distinct()
                 .agg(F.collect_list("_b")).first()[0])
        return sorted(int(b) for b in (got or []))

    def lookup(self, *key_values) -> DataFrame:
        """Rows for one key; only the key's bucket and the batches since the base are read."""
        s = self.state()
        keys = s["keys"]
        if len(key_values) != len(keys):
            raise ValueError(f"expected {len(keys)} key values for {keys}")
        literals = [F.lit(v).cast(s["schema"][k].dataType).alias(k) for k, v in zip(keys, key_values)]
        bucket = self.spark.range(1).select(*literals).select(bucket_of(keys, s["buckets"])).first()[0]
        cond = F.lit(True)
        for k, v in zip(keys, key_values):
            cond = cond & (F.col(k) == F.lit(v))
        return self._folded(s, cond, [bucket])

    def changes(self, before: int, after: int | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """M2: inserts, updates and deletes between two versions.

        Between two versions with one base only the keys of the batches in
        between are compared; otherwise all rows are.
        """
        a, b = self.state(before), self.state(after)
        old, new = self._folded(a), self._folded(b)
        if a["root"].get("path") == b["root"].get("path") and a["root"]["seq"] == b["root"]["seq"]:
            between = [e for e in b["deltas"] if e["seq"] > before and e.get("path")]
            if not between:
                old, new = old.limit(0), new.limit(0)
            else:
                touched = self.spark.read.schema(T.StructType([b["schema"][k] for k in b["keys"]])) \
                              .parquet(*[e["path"] for e in between]).distinct()
                old, new = old.join(touched, b["keys"], "left_semi"), new.join(touched, b["keys"], "left_semi")
        return change_history(old, new, b["keys"], b["version"], columns)

    # ---- writes --------------------------------------------------------------

    def _folder(self) -> str:
        return posixpath.join(self.path, "data", f"{int(time.time()):012d}-{uuid.uuid4().hex}")

    def merge(self, batch: DataFrame, writer: str | None = None, batch_id: int | None = None,
              order_by: Sequence[str] | str | None = None, unique: bool = False) -> int:
        """Upsert ``batch``; returns the number of keys written (0 if skipped).

        ``writer``/``batch_id`` make a replay of the same batch a no-op.
        ``unique=True`` promises at most one row per key (skips the reduction).
        """
        s = self.state()
        known = writer is not None and batch_id is not None
        if known and s["writers"].get(writer, -1) >= batch_id:
            return 0
        keys, schema = s["keys"], s["schema"]
        missing = [k for k in keys if k not in batch.columns]
        if missing:
            raise ValueError(f"batch lacks key column(s) {missing}")
        unknown = [c for c in batch.columns if c not in schema.names]
        if unknown:
            raise ValueError(f"batch has columns not in the table: {unknown}")
        supplied = [c for c in schema.names if c in batch.columns]
        order = [order_by] if isinstance(order_by, str) else list(order_by or [])
        absent = [c for c in order if c not in supplied]
        if absent:
            raise ValueError(f"order_by column(s) {absent} not supplied by the batch")
        defaults = [c for c in s["defaults"] if c not in supplied]

        mark, path = uuid.uuid4().hex, self._folder()
        written = Observation()
        rows = self._typed(batch, schema, supplied)
        if not unique:
            rows = self._reduce(rows, keys, supplied, order)
        rows = rows.select(*supplied, *[F.expr(s["defaults"][c]).cast(schema[c].dataType).alias(f"_d_{c}") for c in defaults],
                           F.lit(mark).alias("_seq")).observe(written, F.count(F.lit(1)).alias("n"), self._null_keys(keys))
        rows.write.mode("errorifexists").parquet(path)
        n, nulls = int(written.get["n"]), int(written.get["nulls"])
        if nulls or not n:
            self.fs.delete(path)
        if nulls:
            raise ValueError(f"{nulls} batch key(s) are a null key {keys}")
        if n and self._differs(s, order, supplied):
            self.compact()
        entry = {"kind": "delta", "path": path if n else None, "mark": mark, "columns": supplied, "defaults": defaults,
                 "order_by": order, "rows": n, "writer": writer if known else None, "batch": int(batch_id) if known else None}
        if not self._commit(entry):
            self.fs.delete(path)
            return 0
        s = self.state()
        live = [e for e in s["deltas"] if e.get("path")]
        if len(s["deltas"]) >= COMPACT_BATCHES or (len(live) > 1 and sum(e["rows"] for e in live) >= COMPACT_SHARE * s["root"].get("rows", 0)
                                                   and s["root"].get("path") is not None):
            self.compact()
        return n

    @staticmethod
    def _differs(s: dict, order: list[str], supplied: list[str]) -> bool:
        """Whether a batch cannot be folded together with the batches since the base."""
        return any(e["order_by"] != order or (order and e["columns"] != supplied) for e in s["deltas"] if e.get("path"))

    @staticmethod
    def _null_keys(keys: Sequence[str]) -> Column:
        bad = F.lit(False)
        for k in keys:
            bad = bad | F.col(k).isNull()
        return F.count_if(bad).alias("nulls")

    @staticmethod
    def _typed(df: DataFrame, schema: T.StructType, columns: Sequence[str]) -> DataFrame:
        # + 0.0 makes a key of -0.0 equal to 0.0 for its bucket, too.
        zero = (T.DoubleType, T.FloatType)
        return df.select(*[(F.col(c).cast(schema[c].dataType) + F.lit(0.0) if isinstance(schema[c].dataType, zero) else F.col(c))
                           .cast(schema[c].dataType).alias(c) for c in columns])

    @staticmethod
    def _reduce(rows: DataFrame, keys: list[str], supplied: list[str], order: list[str]) -> DataFrame:
        payload = [c for c in supplied if c not in keys]
        if not payload:
            return rows.distinct()
        # Without order the winner among a key's rows is unspecified; max keeps it deterministic.
        pick = F.max_by(F.struct(*payload), F.struct(*order, *payload)) if order else F.max(F.struct(*payload))
        return rows.groupBy(*keys).agg(pick.alias("_w")).select(*keys, "_w.*")

    def _write_base(self, df: DataFrame, s: dict) -> tuple[str, int]:
        path, n = self._folder(), Observation()
        (df.withColumn(BUCKET, bucket_of(s["keys"], s["buckets"]).cast("int"))
           .repartitionById(s["buckets"], F.col(BUCKET))   # one task for each bucket
           .observe(n, F.count(F.lit(1)).alias("n"), self._null_keys(s["keys"]))
           .write.mode("errorifexists").partitionBy(BUCKET).parquet(path))
        if n.get["nulls"]:
            self.fs.delete(path)
            raise ValueError(f"{n.get['nulls']} row(s) have a null key {s['keys']}")
        return path, int(n.get["n"])

    @staticmethod
    def _root_of(s: dict) -> dict:
        return {k: s["root"][k] for k in ("keys", "defaults", "schema", "buckets")}

    def compact(self) -> None:
        """Write all rows as a new base; batches committed meanwhile stay behind it."""
        s = self.state()
        path, n = self._write_base(self._folded(s), s)
        self._commit({"kind": "base", "path": path if n else None, "rows": n, "folds": s["version"], "writers": s["writers"]} | self._root_of(s))

    def overwrite(self, df: DataFrame, writer: str | None = None, batch_id: int | None = None,
                  unique: bool = False, order_by: Sequence[str] | str | None = None) -> int:
        """Replace all rows (a snapshot sync).

        Several rows for one key are reduced to one (the newest by
        ``order_by``) unless ``unique=True`` promises one row per key.
        """
        s = self.state()
        known = writer is not None and batch_id is not None
        if known and s["writers"].get(writer, -1) >= batch_id:
            return 0
        schema = s["schema"]
        unknown = [c for c in df.columns if c not in schema.names]
        if unknown:
            raise ValueError(f"columns not in the table: {unknown}")
        rows = self._typed(df, schema, [c for c in schema.names if c in df.columns])
        if not unique:
            order = [order_by] if isinstance(order_by, str) else list(order_by or [])
            rows = self._reduce(rows, s["keys"], [c for c in schema.names if c in df.columns], order)
        given = {c: F.expr(e) for c, e in s["defaults"].items()}
        rows = rows.select(*[F.col(f.name) if f.name in df.columns else given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                             for f in schema.fields])
        path, n = self._write_base(rows, s)
        writers = dict(s["writers"], **({writer: int(batch_id)} if known else {}))
        entry = {"kind": "base", "path": path if n else None, "rows": n, "writers": writers} | self._root_of(s)
        return n if self._commit(entry) else 0

    def vacuum(self, retain_seconds: float = 3600.0) -> int:
        """Drop entries and folders that no read begun in the last ``retain_seconds`` can use."""
        cutoff = time.time() - retain_seconds
        numbers = self._numbers()
        bases = [e for e in map(self._entry, numbers) if e["kind"] == "base" and e["time"] <= cutoff]
        oldest = max((e.get("folds", 0) for e in bases), default=-1)
        root = max((e for e in bases if e.get("folds", 0) == oldest), key=lambda e: e["seq"], default=None)
        gone = [n for n in numbers if root is not None and n != root["seq"] and (
            n <= oldest or (self._entry(n)["kind"] == "base" and n < root["seq"]))]
        live = {posixpath.basename(self._entry(n)["path"]) for n in numbers if n not in gone and self._entry(n).get("path")}
        for n in gone:
            self.fs.delete(posixpath.join(self._ldir, f"{n:020d}.json"))
        removed, data = 0, posixpath.join(self.path, "data")
        for name in self.fs.list_names(data):
            stamp = name.split("-")[0]
            # A folder without an entry may belong to a commit under way: only old ones go.
            if name not in live and stamp.isdigit() and int(stamp) <= cutoff:
                removed += self.fs.delete(posixpath.join(data, name))
        return removed
