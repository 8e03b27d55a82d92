"""One run of the whole job: documents -> validated tables -> upserted snapshot.

Per run: decode and validate the documents, stage the typed records once in
the store (cuts the lineage, so a lost executor recomputes from the staged
copy, not from the raw text), build the three flat tables, merge forecasts
with observations, compute per-place stats from this batch, upsert all five
into the previous snapshot and commit a new version.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.flatten import current_table, forecast_table, location_table, with_pull_keys
from ..operators.merge import merge_forecast
from ..operators.stats import place_stats
from ..operators.upsert import checked_batch, collapse_batch, upsert_table
from ..operators.validate import fail_on_violation, typed_record, validate_records
from ..session import scratch_path
from ..sources.documents import decode_documents, read_documents
from ..sources.snapshots import SnapshotStore, place_part

# What a batch does with rows of one key: the last one wins, the run fails,
# or every one is kept and the joins multiply them.
ON_DUPLICATE = ("last", "error", "multiply")
LAYOUTS = ("by_day", "versioned")


@dataclass
class RunResult:
    version: int
    records: int
    rejected: int


def stage_records(spark: SparkSession, docs: DataFrame, mode: str = "fail",
                  path: str | None = None) -> DataFrame:
    """Decode + validate + type once, written to ``path`` (default: a new
    folder under the shared folder).

    ``fail``: the write itself fails at the first invalid record.
    ``quarantine``: invalid records are kept with their violations and text.
    """
    if mode not in ("fail", "quarantine"):
        raise ValueError(f"mode must be 'fail' or 'quarantine', not {mode!r}")
    checked = validate_records(decode_documents(docs), keep_parts=True)
    if mode == "fail":
        checked = fail_on_violation(checked)
    bad = F.size("violations") > 0
    staged = checked.select(
        "source", "doc", "pos", "label", "violations",
        F.when(~bad, typed_record()).alias("rec"),
        F.when(bad, F.coalesce("text", F.to_json("record"))).alias("record_json"),
    )
    path = path or scratch_path(spark, "staged-records")
    staged.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def batch_tables(staged: DataFrame, on_duplicate: str = "last",
                 merged_path: str | None = None, pulls: int | None = None) -> dict[str, DataFrame]:
    """The five tables of this batch alone; stats are over all its merged rows.

    ``on_duplicate`` decides about rows of one key (several pulls of a place):
    see ``ON_DUPLICATE``. With ``merged_path`` the batch's merged rows are
    written there once, so the merged table and the stats do not each run the
    merge join. ``pulls`` is how many records there are, where known.
    """
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"on_duplicate must be one of {ON_DUPLICATE}, not {on_duplicate!r}")
    keyed = with_pull_keys(staged.where(F.size("violations") == 0))
    current, forecast = current_table(keyed), forecast_table(keyed)
    merged = merge_forecast(forecast, current, pulls)
    if merged_path is not None:
        merged.write.mode("overwrite").parquet(merged_path)
        merged = staged.sparkSession.read.schema(merged.schema).parquet(merged_path)
    tables = {"location": location_table(keyed), "current_temp": current,
              "forecast_temp": forecast, "merged": merged}
    rule = {"last": collapse_batch, "error": checked_batch,
            "multiply": lambda t, df: df.select(*S.columns(S.TABLES[t][0]))}[on_duplicate]
    tables = {t: rule(t, df) for t, df in tables.items()}
    tables["stats"] = place_stats(merged)
    return tables


def run_documents(spark: SparkSession, docs: DataFrame, store_root: str, mode: str = "fail",
                  on_duplicate: str = "last", fmt: str = "parquet", layout: str = "by_day",
                  tag: str | None = None) -> RunResult | None:
    """Apply one batch of documents (source, text) to a store.

    Invalid records go to ``<root>/v=<N>/_rejected`` of the version that the
    batch makes, so a batch that is run again replaces them. With a ``tag``
    already committed (a replayed stream batch) nothing is done and None is
    returned.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    store = SnapshotStore(spark, store_root, fmt)
    if tag is not None and store.has_tag(tag):
        return None
    # one staging folder per store, replaced by the next run: bounded space
    staged = stage_records(spark, docs, mode, path=f"{store.root}/_staging")
    bad = F.size("violations") > 0
    counts = staged.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(bad, 1)).alias("bad")).first()
    if counts["bad"]:
        staged.where(bad).select("source", "label", "violations", "record_json") \
            .write.mode("overwrite").parquet(f"{store.root}/v={store.next_version()}/_rejected")
    days = places = None
    if layout == "by_day" and fmt == "parquet":
        # the pull days and parts of the places of one batch, read from the staged records once
        place = place_part(*[f"rec.location.{c}" for c in S.PLACE_KEYS])
        days, places = staged.where(~bad).agg(F.collect_set(F.to_date("rec.location.localtime")), F.collect_set(place)).first()
    prev = store.latest_version()
    rule = "error" if on_duplicate == "error" else "multiply"
    out = {}
    for t, df in batch_tables(staged, on_duplicate, f"{store.root}/_staging_merged", int(counts["n"])).items():
        old = store.read(t, prev, days, places) if prev is not None else None
        out[t] = upsert_table(t, old, df, rule)
    return RunResult(store.write(out, tag=tag, days=days, places=places), int(counts["n"]), int(counts["bad"]))


def run(spark: SparkSession, input_path: str, store_root: str, mode: str = "fail",
        multiline: bool | None = None, on_duplicate: str = "last", fmt: str = "parquet",
        layout: str = "by_day") -> RunResult:
    """Read documents at ``input_path`` and apply them to the store.

    ``layout="by_day"`` (default): of the tables kept by pull day only the
    batch's days, and of those of one row a place only the batch's share of the
    places, are read and written. ``layout="versioned"``, and CSV: every run
    writes all tables whole.
    """
    return run_documents(spark, read_documents(spark, input_path, multiline), store_root, mode,
                         on_duplicate, fmt, layout)
