"""Where the mart's tables are kept: parquet, partitioned by a hash of the host and by month.

A domain lives on few hosts, so a purge or a refresh reads and rewrites a few partitions and leaves the rest alone. Files are
never changed in place. A change writes new folders, and one manifest, a small file with a number, says which folders make
up the partitions of all tables from then on. It is put in place by one rename that fails if the number is taken, so readers
see a change of several tables as a whole or not at all, and of two changes at once the later one is refused. A run that
stops in between leaves folders that no manifest names; ``clean`` removes them.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pageglean.functions import urls as U

SCHEMAS = {
    "site": "site_id bigint, page_url string, last_scrapped_date date, current_dates date, bucket int",
    "contains": "fact_id bigint, site_id bigint, keyword_id bigint, points int, current_dates date, bucket int",
    "site_category": "s_c_id bigint, site_id bigint, domain string, custom_segment_name string, current_dates date, bucket int",
    "keyword_store": "page_url string, keywords map<string,bigint>, bucket int",
}
DAY = "current_dates"
# Year and month of the day, as a number; 0 where there is none.
MONTH = "month"


def month_of(day: Column) -> Column:
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(0))


class ChangedMeanwhile(RuntimeError):
    """Another run has changed the store since this change was begun."""


@dataclass(frozen=True)
class Snapshot:
    """State ``number`` of a store: for each table the folders of each bucket."""

    number: int
    folders: Mapping[str, Mapping[str, Sequence[str]]]


@dataclass(frozen=True)
class Change:
    """What a run does to one table: ``rows`` come in, and ``buckets``, if given, hold nothing else afterwards."""

    rows: DataFrame
    buckets: Sequence[int] | None = None


@dataclass(frozen=True)
class Store:
    """A set of tables below one folder."""

    spark: SparkSession
    root: str
    buckets: int = 256

    def bucket_of(self, host: Column) -> Column:
        return F.pmod(F.xxhash64(host), F.lit(self.buckets)).cast("int")

    def bucket_of_url(self, url: Column) -> Column:
        return self.bucket_of(U.authority(U.default_scheme(url)))

    # ---- files ------------------------------------------------------------------------------------------------------

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, name: str) -> list[str]:
        files, path = self._files(), self._path(name)
        return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []

    def _write_text(self, name: str, text: str) -> None:
        out = self._files().create(self._path(name), True)
        out.write(bytearray(text.encode()))
        out.close()

    def _read_text(self, name: str) -> str:
        return self.spark.read.text(str(self._path(name).toString()), wholetext=True).first()[0]

    # ---- snapshots --------------------------------------------------------------------------------------------------

    def snapshot(self) -> Snapshot:
        """The newest state."""
        numbers = [int(n.removesuffix(".json")) for n in self._names("_manifests") if n.endswith(".json")]
        if not numbers:
            return Snapshot(0, {})
        return Snapshot(max(numbers), json.loads(self._read_text(f"_manifests/{max(numbers):020d}.json")))

    def _publish(self, run: str, then: Snapshot) -> None:
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        staged = f"_manifests/{then.number:020d}.{run}.tmp"
        self._write_text(staged, json.dumps(then.folders, sort_keys=True))
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._files().getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            context.rename(self._path(staged), self._path(f"_manifests/{then.number:020d}.json"), options)
        except Exception as error:
            if f"{then.number:020d}.json" in self._names("_manifests"):
                raise ChangedMeanwhile(f"state {then.number} of {self.root} is of another run") from error
            raise

    def read(self, table: str, buckets: Sequence[int] | None = None, day: str | None = None, at: Snapshot | None = None) -> DataFrame:
        """The table, or only some buckets of it; with ``day`` only the folders of its month. A table never written is empty."""
        known = (at or self.snapshot()).folders.get(table, {})
        wanted = known if buckets is None else {str(b) for b in buckets} & known.keys()
        folders = sorted(f"{self.root}/{f}" for b in wanted for f in known[b])
        if not folders:
            return self.spark.createDataFrame([], SCHEMAS[table])
        rows = self.spark.read.schema(f"{SCHEMAS[table]}, {MONTH} int, run string").option("basePath", f"{self.root}/{table}").parquet(*folders)
        if day is not None:
            rows = rows.filter(F.col(MONTH) == int(day[:4] + day[5:7]))
        return rows.drop(MONTH, "run")

    def change(self, run: str, changes: Mapping[str, Change], before: Snapshot | None = None) -> dict[str, int]:
        """Writes all these changes and makes them visible at once; gives the rows written to each table.

        The numbers are taken by the writes themselves. ``before`` is the state that the changes were made of: if it is not
        the newest any more, the change is refused.
        """
        before = before or self.snapshot()
        folders = {table: {b: list(f) for b, f in of.items()} for table, of in before.folders.items()}
        written = {}
        for table, wanted in changes.items():
            place, counted = f"{table}/run={run}-{before.number + 1:06d}", Observation()
            rows = self._fitted(table, wanted.rows).observe(counted, F.count(F.lit(1)).alias("rows"))
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket", MONTH).parquet(f"{self.root}/{place}"))
            written[table] = counted.get["rows"]
            of = folders.setdefault(table, {})
            for bucket in wanted.buckets or ():
                of.pop(str(bucket), None)
            for name in self._names(place):
                if name.startswith("bucket="):
                    of.setdefault(name.removeprefix("bucket="), []).append(f"{place}/{name}")
        self._publish(run, Snapshot(before.number + 1, folders))
        return written

    def append(self, run: str, table: str, rows: DataFrame) -> int:
        return self.change(run, {table: Change(rows)})[table]

    def replace(self, run: str, content: Mapping[str, DataFrame], buckets: Sequence[int], before: Snapshot | None = None) -> dict[str, int]:
        """These buckets of these tables hold exactly this content afterwards, all from the same moment on."""
        if not buckets:
            return {table: 0 for table in content}
        return self.change(run, {table: Change(rows, buckets) for table, rows in content.items()}, before)

    def _fitted(self, table: str, rows: DataFrame) -> DataFrame:
        fields = self.spark.createDataFrame([], SCHEMAS[table]).schema.fields
        month = month_of(F.col(DAY)) if DAY in rows.columns else F.lit(0)
        # Rebalancing splits a partition that one host fills and joins those that are nearly empty.
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields], month.alias(MONTH)).hint("rebalance", "bucket", MONTH)

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets these rows are in, at most as many as there are."""
        return sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())

    def clean(self, keep: int = 2) -> list[str]:
        """Removes what none of the last ``keep`` states names, manifests included; gives the folders removed.

        Not to be run beside a change, whose new folders are not named yet.
        """
        manifests = [n for n in self._names("_manifests") if n.endswith(".json")]
        named: set[str] = set()
        for name in manifests[-keep:]:
            named |= {"/".join(f.split("/")[:2]) for of in json.loads(self._read_text(f"_manifests/{name}")).values() for fs in of.values() for f in fs}
        gone = [f"{table}/{run}" for table in SCHEMAS for run in self._names(table) if f"{table}/{run}" not in named]
        for name in [*gone, *(f"_manifests/{n}" for n in self._names("_manifests") if n not in manifests[-keep:])]:
            self._files().delete(self._path(name), True)
        return gone

