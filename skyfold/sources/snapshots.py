"""Versioned table snapshots and the CSV text format.

A run writes its tables under ``<root>/v=<N>`` first and its commit marker
``<root>/_commits/<N>.json`` last, as one file that appears complete or not
at all. The marker says which version holds each table, or each part of
it (a pull day, or a share of the places), so a run rewrites only the parts it
touches, nothing that is read is ever overwritten, and all five tables change
together. Readers take the
highest marker; a run that dies half-way is never seen, and the next one
replaces what it left. One writer per store.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from . import files

# Text formats of saved CSV files.
NTZ_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
UTC_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+0000'"
DATE_TEXT = "yyyy-MM-dd"
UTC_COLUMN = "created_date_utc"
ZONE_SUFFIX = r"(\+0000|\+00:00|Z)$"

# Quotes are doubled, blanks around values are part of them.
CSV_OPTIONS = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}
CSV_WRITE = {**CSV_OPTIONS, "timestampNTZFormat": NTZ_TEXT, "dateFormat": DATE_TEXT}


def _schema(table: str) -> T.StructType:
    return S.TABLES[table][0]


# ---------------------------------------------------------------------------
# CSV
# ---------------------------------------------------------------------------

def to_csv_text(df: DataFrame) -> DataFrame:
    """Print the UTC column with its "+0000" offset; other types by option."""
    if UTC_COLUMN in df.columns:
        df = df.withColumn(UTC_COLUMN, F.date_format(UTC_COLUMN, UTC_TEXT))
    return df


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    to_csv_text(df).write.mode(mode).options(**CSV_WRITE).csv(path)


def text_schema(table: str) -> T.StructType:
    """The table's schema with every date and time column read as text."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(
            f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)) else f.dataType)
        for f in _schema(table).fields
    ])


def parse_dates(df: DataFrame, table: str) -> DataFrame:
    """Text date/time columns -> the table's types (after a text read).

    Accepts "T" or " " between date and time and an optional UTC offset
    suffix. Text that is not a date or time fails the job (ANSI cast).
    """
    out = {}
    for f in _schema(table).fields:
        if f.name not in df.columns:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            out[f.name] = F.to_date(F.substring(c, 1, 10))
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            out[f.name] = F.regexp_replace(c, ZONE_SUFFIX, "").cast("timestamp_ntz")
    return df.withColumns(out) if out else df


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read a saved CSV table into its fixed schema (never inferred).

    Columns are matched by each file's own header, not by position, so files
    with other column orders (as a first run of the reference job writes them)
    read correctly, also beside each other; every value is read as text and
    cast to its type. Values may hold quotes and line breaks, so a file is
    one task: CSV is for exchange, parquet for scale.
    """
    by_header: dict[str, list[str]] = {}
    for f in files.data_files(spark, path):
        by_header.setdefault(files.first_line(spark, f), []).append(f)
    wanted = S.columns(_schema(table))
    raw = None
    for paths in by_header.values():
        part = spark.read.options(**CSV_OPTIONS, inferSchema="false", multiLine="true").csv(paths)
        part = part.select(*[F.col(f"`{c}`") for c in wanted])
        raw = part if raw is None else raw.unionByName(part)
    if raw is None:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in _schema(table)])
    dated = parse_dates(raw, table)
    return dated.select(*[
        F.col(f.name) if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
        else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in _schema(table).fields
    ])


# ---------------------------------------------------------------------------
# Snapshot store
# ---------------------------------------------------------------------------

DAY_COLUMN = "pull_day"

# Tables keyed by pull time, which a store may keep by the pull's date, and
# tables of one row a place, which it may keep by a hash of the place.
DAY_TABLES = ("current_temp", "forecast_temp", "merged")
PLACE_COLUMN, PLACE_TABLES = "place_part", ("location", "stats")
# Parts that places fall in, the same for all versions of a store,
# and the part of a table that is kept whole.
PLACE_PARTS, WHOLE = 32, ""


def _series(tag: str) -> tuple[str, int | None]:
    """A tag ``name#number`` as its name and number; other tags have no number."""
    name, _, number = tag.rpartition("#")
    return (name, int(number)) if name and number.isdecimal() else (tag, None)


def pull_day(table: str):
    """The date of the pull (merged already has it)."""
    c = F.col("created_date_local")
    return c if table == "merged" else F.to_date(c)


def place_part(name="name", region="region", country="country"):
    """The part of the place tables that holds a place."""
    return F.pmod(F.xxhash64(name, region, country), F.lit(PLACE_PARTS)).cast("int")


class SnapshotStore:
    """Committed versions of the five tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        if fmt not in ("parquet", "csv"):
            raise ValueError(f"fmt must be 'parquet' or 'csv', not {fmt!r}")
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def _versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in files.names(self.spark, f"{self.root}/_commits")
                      if n.endswith(".json") and n[:-5].isdigit())

    def latest_version(self) -> int | None:
        """Highest committed version."""
        return max(self._versions(), default=None)

    def commit(self, version: int) -> dict:
        """A version's marker: ``tag`` and, per table, the version of each of its parts."""
        return json.loads(files.read_text(self.spark, f"{self.root}/_commits/{version}.json"))

    def _part_path(self, table: str, part: str, version: int) -> str:
        whole = f"{self.root}/v={version}/{table}"
        return whole if part == WHOLE else f"{whole}/{PLACE_COLUMN if table in PLACE_TABLES else DAY_COLUMN}={part}"

    def read(self, table: str, version: int | None = None, days: list | None = None,
             places: list | None = None) -> DataFrame | None:
        """A table at ``version`` (default: latest committed), or None.

        ``days`` reads only those pull days of a table that is kept by day, ``places``
        only those parts (see ``place_part``) of one that is kept by place.
        """
        v = self.latest_version() if version is None else version
        if v is None:
            return None
        parts = self.commit(v)["tables"].get(table)
        if parts is None:
            return None
        only = places if table in PLACE_TABLES else days
        asked = None if only is None or WHOLE in parts else {str(p) for p in only}
        paths = [self._part_path(table, p, at) for p, at in parts.items() if asked is None or p in asked]
        if self.fmt == "csv":
            return read_csv(self.spark, paths[0], table)
        if not paths:
            return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in _schema(table)])
        return self.spark.read.schema(_schema(table)).parquet(*paths)

    def read_numbered(self, table: str, version: int | None = None, number: str = "n") -> DataFrame | None:
        """``read`` with every row's place in saved order, from 1.

        A row's place is its place in its file plus the rows of the files before it, which
        are counted first: what reaches the driver is a row for each file. Parquet knows a
        row's place in its file; a CSV file, which one task reads whole, is counted there.
        """
        df = self.read(table, version)
        if df is None:
            return None
        if self.fmt == "csv":
            rows = df.select("*", F.input_file_name().alias("_file"), F.monotonically_increasing_id().alias("_at"))
            rows = rows.withColumn("_at", F.row_number().over(Window.partitionBy("_file").orderBy("_at")) - 1)
        else:
            rows = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
        held = sorted((r._file, r.n) for r in rows.groupBy("_file").agg(F.count("*").alias("n")).collect())
        before = [0, *accumulate(n for _, n in held)]
        starts = pa.table({"_file": pa.array([f for f, _ in held], pa.string()), "_before": pa.array(before[:-1], pa.int64())})
        return (rows.join(self.spark.createDataFrame(starts), "_file")
                .select(*df.columns, (F.col("_before") + F.col("_at") + 1).alias(number)))

    def has_tag(self, tag: str) -> bool:
        """Whether ``tag``, or a later number of its series, was written before.

        A tag ``name#number`` is one of a series, whose numbers rise, as a stream's
        batches do: a marker keeps the highest. Of other tags it keeps all.
        """
        v = self.latest_version()
        if v is None:
            return False
        marker, (series, number) = self.commit(v), _series(tag)
        if tag in marker["tags"]:
            return True
        return number is not None and number <= marker.get("series", {}).get(series, -1)

    def clean(self, keep: int = 1) -> list[str]:
        """Forget all but the newest ``keep`` versions, and delete what only older ones held.

        Old markers go first, so nobody begins to read what is deleted next; then the
        version folders, or the tables and pull days in them, that no marker left
        names. Readers of a kept version find every part of it, and what a writer
        is writing lies beyond the newest marker and stays. Returns the paths deleted.
        """
        if keep < 1:
            raise ValueError("at least one version is kept")
        versions = self._versions()
        for v in versions[:-keep]:
            files.remove(self.spark, f"{self.root}/_commits/{v}.json")
        used = {self._part_path(t, p, at) for v in versions[-keep:]
                for t, parts in self.commit(v)["tables"].items() for p, at in parts.items()}
        gone = []

        def unused(path: str) -> bool:
            """Whether nothing at or below ``path`` is used; if something is, the rest below goes."""
            if path in used:
                return False
            below = [f"{path}/{n}" for n in files.names(self.spark, path) if "=" in n or n in S.TABLES]
            free = [p for p in below if unused(p)]
            if len(free) < len(below):
                gone.extend(free)
                return False
            return not any(u.startswith(path + "/") for u in used)

        for n in files.names(self.spark, self.root):
            if n.startswith("v=") and n[2:].isdigit() and versions and int(n[2:]) <= versions[-1]:
                if unused(f"{self.root}/{n}"):
                    gone.append(f"{self.root}/{n}")
        for path in gone:
            files.remove(self.spark, path)
        return gone

    def next_version(self) -> int:
        prev = self.latest_version()
        return 0 if prev is None else prev + 1

    def write(self, tables: dict[str, DataFrame], sort: bool | None = None,
              tag: str | None = None, days: list | None = None, places: list | None = None) -> int:
        """Write ``tables`` as the next version, then commit it; other tables stay.

        With ``days``, the tables of ``DAY_TABLES`` hold just these pull days and
        replace them; all other days stay where they are. ``places`` does the same
        for the parts of ``PLACE_TABLES``. A table that was kept whole until now must
        come whole, and is split from then on. ``sort=True`` orders
        each table globally on its keys (a range shuffle; files read in order
        give the saved-table order). The default does so for CSV, whose row
        order is part of the format; for parquet it sorts within partitions
        only, which the upsert's hash partitioning on the keys makes cheap.
        ``tag`` names the input of the version (e.g. a stream's micro-batch)
        so a replay can be recognised.
        """
        if sort is None:
            sort = self.fmt == "csv"
        prev = self.latest_version()
        v = self.next_version()
        before = self.commit(prev) if prev is not None else {"tables": {}, "tags": []}
        series = dict(before.get("series", {}))
        tags = list(before["tags"])
        if tag is not None:
            name, number = _series(tag)
            if number is None:
                tags.append(tag)
            else:
                series[name] = max(number, series.get(name, -1))

        def write_one(table: str, df: DataFrame) -> dict[str, int]:
            schema, keys = S.TABLES[table]
            ordering = [F.col(k).asc_nulls_first() for k in keys]
            out = df.select(*S.columns(schema))
            path = self._part_path(table, WHOLE, v)
            # version v is not committed, so no reader uses it: a run that
            # died half-way left at most debris here, which is replaced
            column = None
            if days is not None and table in DAY_TABLES:
                column, out = DAY_COLUMN, out.withColumn(DAY_COLUMN, pull_day(table))
            elif places is not None and table in PLACE_TABLES:  # a part is small: one file
                column, out = PLACE_COLUMN, out.withColumn(PLACE_COLUMN, place_part()).repartition(PLACE_COLUMN)
            if column is not None:
                out.sortWithinPartitions(column, *ordering).write.mode("overwrite").partitionBy(column).parquet(path)
                written = {n[len(column) + 1:]: v for n in files.names(self.spark, path) if n.startswith(f"{column}=")}
                kept = {p: at for p, at in before["tables"].get(table, {}).items() if p != WHOLE}
                return {**kept, **written}
            out = out.orderBy(*ordering) if sort else out.sortWithinPartitions(*ordering)
            if self.fmt == "csv":
                write_csv(out, path, mode="overwrite")
            else:
                out.write.mode("overwrite").parquet(path)
            return {WHOLE: v}

        # the tables are independent jobs: submitted together, the small
        # ones and the large ones' last tasks overlap instead of queueing
        with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
            parts = {t: pool.submit(write_one, t, df) for t, df in tables.items()}
            done = {t: f.result() for t, f in parts.items()}
        marker = {"tables": {**before["tables"], **done}, "tags": tags, "series": series}
        files.write_whole(self.spark, f"{self.root}/_commits/{v}.json", json.dumps(marker))
        return v
