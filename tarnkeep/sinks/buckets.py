"""A history kept in buckets of its keys, of which a load rewrites only those that change.

Layout below ``path``::

    run=<n>/history_part=current/history_bucket=<b>/   current versions of bucket b after load n
    run=<n>/history_part=past/history_bucket=<b>/      what load n added to its past: closed versions,
                                                       statements seen again, absences
    manifest/<n>.json    per bucket: the runs that hold its parts, counts, the latest date

A load writes a new folder and then a manifest; the manifest's appearance commits it. Files are never
changed, so readers of an earlier manifest are not disturbed, and what a failed load leaves
behind does not count and is overwritten by the next.

One load first finds which buckets the staged rows fall into, and from what date on. Then it is one
pass: the current versions of these buckets (and past ones too where a row is dated before the
bucket's latest) are united with the staged rows, dealt by key, and spliced
(:mod:`tarnkeep.operators.splice`) by windows, without a join. A bucket is spread over as many tasks as
the session deals out, so none has to hold one. What was written tells which buckets hold a change;
those that hold none are deleted again before the commit. If none does, nothing is committed.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from contextlib import ExitStack
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkeep.operators.contracts import date_literal
from tarnkeep.operators.scd2 import CURRENT, END, HASH, START
from tarnkeep.operators.splice import CLOSED, KEPT, LOADED, SEEN, STATE, splice, with_absences
from tarnkeep.session import temporary
from tarnkeep.sinks.manifests import Manifests
from tarnkeep.sources.files import _file_system, child_files

BUCKET, PART = "history_bucket", "history_part"
#: Past folders of one bucket from which on the next load that touches it merges them into one.
MERGE_AT = 32
#: Versions that make a shuffle partition worth a task of its own. From there on new rows that lie by their
#: keys stay where they are; before, one shuffle deals them and the versions, whose partitions Spark can merge.
FULL = 20_000


@dataclass
class Bucket:
    """Where a bucket's rows are: the run of its current part and those of its past parts."""

    current: int | None = None
    past: list[int] = field(default_factory=list)
    latest: str | None = None
    current_rows: int = 0
    closed_rows: int = 0


@dataclass
class Manifest:
    run: int
    schema: T.StructType | None
    buckets: dict[int, Bucket]
    #: The buckets this run wrote.
    written: list[int] = field(default_factory=list)


@dataclass(frozen=True)
class KeyBuckets:
    """A history below ``path`` of rows identified by ``keys``.

    ``buckets`` stays as the history grows; a load rewrites whole buckets.
    """

    path: str
    keys: Sequence[str]
    buckets: int = 64

    # ---- manifests ----

    def _manifests(self) -> Manifests:
        return Manifests(f"{self.path}/manifest")

    def last_run(self, spark: SparkSession) -> int:
        return max(self._manifests().runs(spark), default=0)

    def manifest(self, spark: SparkSession, run: int | None = None) -> Manifest:
        """The manifest of ``run`` (the latest if not given)."""
        run = self.last_run(spark) if run is None else run
        if not run:
            return Manifest(0, None, {})
        told = self._manifests().read(spark, run)
        if told["keys"] != list(self.keys) or told["count"] != self.buckets:
            raise ValueError(f"{self.path} has keys {told['keys']} in {told['count']} buckets")
        return Manifest(
            run, T.StructType.fromJson(told["schema"]),
            {int(b): Bucket(**v) for b, v in told["buckets"].items()}, told["written"],
        )

    def _commit(self, spark: SparkSession, manifest: Manifest) -> None:
        self._manifests().commit(spark, manifest.run, {
            "keys": list(self.keys), "count": self.buckets, "schema": manifest.schema.jsonValue(),
            "buckets": {b: vars(v) for b, v in manifest.buckets.items()}, "written": manifest.written,
        })

    # ---- reading ----

    def _folder(self, run: int, part: str, bucket: int) -> str:
        return f"{self.path}/run={run}/{PART}={part}/{BUCKET}={bucket}"

    def _read(
        self, spark: SparkSession, manifest: Manifest, past: Sequence[int], current: Sequence[int]
    ) -> DataFrame | None:
        """The rows of the given buckets' parts, or None if there are none."""
        paths = [
            self._folder(manifest.buckets[b].current, "current", b)
            for b in current if manifest.buckets[b].current_rows
        ] + [self._folder(run, "past", b) for b in past for run in manifest.buckets[b].past]
        if not paths:
            return None
        rows = spark.read.schema(manifest.schema).option("basePath", self.path).parquet(*paths)
        return rows.select(*manifest.schema.names, self._bucket().alias(BUCKET))

    def _visible(self, spark: SparkSession, run: int | None, with_past: bool) -> DataFrame:
        manifest = self.manifest(spark, run)
        if manifest.schema is None:
            raise ValueError(f"{self.path} holds no committed load")
        known = list(manifest.buckets)
        rows = self._read(spark, manifest, known if with_past else [], known)
        if rows is None:
            rows = spark.createDataFrame([], manifest.schema)
        return rows.filter(F.col(STATE).isin(KEPT, CLOSED)).drop(LOADED, STATE, BUCKET)

    def current(self, spark: SparkSession, run: int | None = None) -> DataFrame:
        """The current versions after ``run`` (the latest if not given)."""
        return self._visible(spark, run, False)

    def history(self, spark: SparkSession, run: int | None = None) -> DataFrame:
        """All versions as they were after ``run`` (the latest if not given)."""
        return self._visible(spark, run, True)

    def counts(self, spark: SparkSession, run: int | None = None) -> tuple[int, int]:
        """Current and all versions, from the manifest alone."""
        buckets = self.manifest(spark, run).buckets.values()
        current = sum(b.current_rows for b in buckets)
        return current, current + sum(b.closed_rows for b in buckets)

    # ---- loading ----

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def load(
        self,
        staged: DataFrame,
        as_of: date | str | None = None,
        close_missing: bool = False,
        confirm: bool = False,
        met: DataFrame | None = None,
        hashed: Column | None = None,
        dealt: bool = False,
    ) -> int:
        """Load staged rows, of any dates and several per key; returns the number of the latest run.

        An unchanged row leaves no trace unless ``confirm``: then it is kept as seen on its date, so that loads give one history in
        whatever order they come, also where a late row falls between two equal ones.
        ``close_missing`` closes, at ``as_of``, the versions of keys that the load does not hold.

        ``met`` has the keys and dates of the incoming rows, repeated ones too, where that is cheaper to read than
        ``staged`` (:func:`tarnkeep.operators.scd2.scd2_met`). ``hashed`` is what the hashes are, as a function of the other
        columns: those that equal it are worked out again and not shuffled. ``dealt``: the staged rows lie by their keys already.
        """
        spark = staged.sparkSession
        manifest = self.manifest(spark)
        run = manifest.run + 1
        columns = staged.columns
        schema = T.StructType([
            *(T.StructField(f.name, f.dataType) for f in staged.schema),
            T.StructField(LOADED, T.IntegerType()), T.StructField(STATE, T.StringType()),
        ])
        if manifest.schema is not None and schema != manifest.schema:
            raise ValueError(f"{self.path} holds {manifest.schema.simpleString()}")
        new = staged.select(
            *columns, F.lit(run).alias(LOADED), F.lit(None).cast("string").alias(STATE),
            self._bucket().alias(BUCKET),
        )
        known = sum(b.current_rows for b in manifest.buckets.values())
        many = known >= FULL * int(spark.conf.get("spark.sql.shuffle.partitions"))
        with ExitStack() as stack:
            late: set[int] = set()
            if not manifest.buckets:
                both = new if dealt else self._dealt(self._packed(new, hashed), hashed)
            else:
                aligned = many and dealt and met is not None
                if not aligned:
                    new = stack.enter_context(temporary(self._packed(new, hashed)))
                # one row per bucket
                rows = met.withColumn(BUCKET, self._bucket()) if aligned else new
                dates = dict(rows.groupBy(BUCKET).agg(F.min(START).cast("string")).collect())
                if aligned:
                    new = self._as_met(new, dates)
                if close_missing:
                    day = spark.range(1).select(date_literal(as_of).cast("string")).first()[0]
                    dates = {b: min(dates.get(b, day), day) for b in {*dates, *manifest.buckets}}
                touched = sorted(b for b in dates if b in manifest.buckets)
                # buckets whose past takes part: a row is dated before what is known, or there are many parts
                late = {
                    b for b in touched
                    if dates[b] < (manifest.buckets[b].latest or "") or len(manifest.buckets[b].past) >= MERGE_AT
                }
                old = self._read(spark, manifest, sorted(late), touched)
                old = old if old is None else self._packed(old, hashed)
                if aligned:
                    both = new if old is None else self._dealt(old, hashed).unionByName(new)
                else:
                    both = self._dealt(new if old is None else old.unionByName(new), hashed)
            written = self._write(both, run, late, as_of, close_missing, confirm)
        if not written:
            self._forget(spark, run)
            return manifest.run
        self._commit(spark, self._advanced(manifest, schema, run, late, written))
        return run

    def _as_met(self, new: DataFrame, dates: dict[int, str]) -> DataFrame:
        """New rows; one in another bucket, or of an earlier date, than the first look found ends the load."""
        known = F.split(F.lit(",".join(dates.get(b) or "" for b in range(self.buckets))), ",")
        first = F.get(known, F.col(BUCKET)).try_cast("date")
        changed = F.raise_error(F.lit("the rows changed while they were loaded")).cast("date")
        return new.withColumn(START, F.when(F.col(START) >= first, F.col(START)).otherwise(changed))

    def _packed(self, rows: DataFrame, hashed: Column | None) -> DataFrame:
        """Rows without the hashes that can be worked out again."""
        if hashed is None:
            return rows
        return rows.withColumn(HASH, F.when(~F.col(HASH).eqNullSafe(hashed), F.col(HASH)))

    def _dealt(self, packed: DataFrame, hashed: Column | None) -> DataFrame:
        """Whole rows, dealt by their keys, so that a window over a key needs no other shuffle."""
        dealt = packed.repartition(*self.keys)
        return dealt if hashed is None else dealt.withColumn(HASH, F.coalesce(HASH, hashed))

    def _write(self, both: DataFrame, run: int, late, as_of, close_missing: bool, confirm: bool):
        """Write the buckets that change; (bucket, part, state) rows with counts of what was written."""
        spark = both.sparkSession
        is_new = F.col(LOADED) == run
        rows = both
        if close_missing:
            rows = with_absences(rows, self.keys, is_new, as_of, F.lit(run), [BUCKET])
        spliced = splice(rows, self.keys, [BUCKET])
        if not confirm:
            spliced = spliced.filter(~(is_new & (F.col(STATE) == SEEN)))
        part = F.when(F.col(STATE) == KEPT, "current").otherwise("past")
        place = f"{self.path}/run={run}"
        spliced.withColumn(PART, part).write.mode("overwrite").partitionBy(PART, BUCKET).parquet(place)
        if not child_files(spark, place, folders=True):
            return []
        fields = [PART, BUCKET, STATE]
        found = (
            spark.read.schema(f"{START} date, {LOADED} int, {STATE} string, {PART} string, {BUCKET} int").parquet(place)
            .groupBy(*fields).agg(
                F.count("*").alias("n"), F.max(START).cast("string").alias("latest"), F.max(is_new).alias("new"),
            ).collect()
        )
        # a chain changes only by a new statement; what is only seen again changes no version
        changed, shown = {r[BUCKET] for r in found if r["new"]}, {
            r[BUCKET] for r in found
            if r["new"] and r[STATE] != SEEN or r[PART] == "past" and r[STATE] != SEEN
        }
        wanted = [
            r for r in found
            if r[BUCKET] in (changed if r[BUCKET] in late else shown) or r[PART] == "past" and r[BUCKET] not in late
        ]
        held = {(r[PART], r[BUCKET]) for r in wanted}
        for p, b in {(r[PART], r[BUCKET]) for r in found} - held:
            file_system, folder = _file_system(spark, f"{place}/{PART}={p}/{BUCKET}={b}")
            file_system.delete(folder, True)
        return wanted

    def _advanced(self, manifest: Manifest, schema, run: int, late, written) -> Manifest:
        buckets = {b: Bucket(**vars(v)) for b, v in manifest.buckets.items()}
        found = defaultdict(dict)
        for row in written:
            found[row[BUCKET]][row[STATE]] = row
        for b, states in found.items():
            bucket = buckets.setdefault(b, Bucket())
            count = lambda state: states[state]["n"] if state in states else 0
            if b in late:
                bucket.past, bucket.closed_rows, bucket.current_rows = [], 0, 0
            if b in late or set(states) - {SEEN}:
                bucket.current, bucket.current_rows = run, count(KEPT)
            if set(states) - {KEPT}:
                bucket.past = [*bucket.past, run]
            bucket.closed_rows += count(CLOSED)
            bucket.latest = max([bucket.latest or "", *(r["latest"] for r in states.values())])
        return Manifest(run, schema, buckets, sorted(found))

    def _forget(self, spark: SparkSession, run: int) -> None:
        file_system, place = _file_system(spark, f"{self.path}/run={run}")
        file_system.delete(place, True)

    def vacuum(self, spark: SparkSession, keep: int = 1) -> int:
        """Delete folders that none of the last ``keep`` runs reads, and older manifests.

        Returns how many folders went.
        """
        runs = self._manifests().runs(spark)
        kept = runs[-keep:]
        used = set()
        for run in kept:
            for b, bucket in self.manifest(spark, run).buckets.items():
                used |= {(bucket.current, "current", b), *((r, "past", b) for r in bucket.past)}
        gone = 0
        for run in runs:
            manifest = self.manifest(spark, run)
            for b in manifest.written:
                for part in ("current", "past"):
                    if (run, part, b) not in used:
                        file_system, place = _file_system(spark, self._folder(run, part, b))
                        if file_system.exists(place):
                            file_system.delete(place, True)
                            gone += 1
        for run in runs[:-keep]:
            # a later vacuum no longer knows what this run wrote: it must have nothing left
            written = self.manifest(spark, run).written
            if all((run, part, b) not in used for part in ("current", "past") for b in written):
                self._manifests().delete(spark, run)
        return gone
