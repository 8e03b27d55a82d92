"""Key-based upsert of a new batch into an existing table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from .merge import with_forecast_error

NEW_SUFFIX = "_new"


def _one_row_a_key(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """``keys, _row``: the whole row of each key; raises at run time where a key has several.

    Rows are counted by a partial aggregation before the shuffle, so a key that is
    repeated a million times is one row a task when it fails, and the shuffle is the one
    that the full join on the keys needs next. Rows with a null among their keys match
    nothing and may repeat: their text key is replaced by a number of their own.
    """
    text = next((k for k in keys if isinstance(df.schema[k].dataType, T.StringType)), None)
    if text is None:
        raise ValueError(f"one of the keys {keys} must be text")
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    own = F.concat(F.lit("\0"), F.monotonically_increasing_id().cast("string"))
    rows = df.select(*[F.when(whole, F.col(k)).otherwise(own).alias(k) if k == text else F.col(k) for k in keys],
                     F.struct(*df.columns).alias("_row"))
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first("_row").alias("_row"))
    msg = F.lit(f"duplicate upsert key {keys} in {what}")
    return counted.where(F.when(F.col("_n") > 1, F.raise_error(msg)).otherwise(F.lit(True))).select(*keys, "_row")


def upsert(old: DataFrame | None, new: DataFrame, keys: list[str], columns: list[str],
           on_duplicate: str = "error") -> DataFrame:
    """Full outer join on ``keys``; each column takes the new value if not null.

    A null in the new batch never erases an old value. Keys are coalesced
    too, so a place only in the new batch keeps its keys. Rows whose keys
    contain a null never match. With ``on_duplicate="error"`` a repeated
    key in the new batch fails the job (one of the keys must be text);
    ``"multiply"`` lets the join repeat rows instead, as a plain join would.

    Shuffles both sides once on the keys (sort-merge full join).
    """
    if on_duplicate not in ("error", "multiply"):
        raise ValueError(f"on_duplicate must be 'error' or 'multiply', not {on_duplicate!r}")
    if old is None:
        return new.select(*columns)
    if on_duplicate == "error":
        joined = old.select(*columns).join(_one_row_a_key(new.select(*columns), keys, "new batch"), keys, "full")
        row = F.col("_row")
        return joined.select(*[
            (F.when(row.isNotNull(), row[c]).otherwise(F.col(c)) if c in keys else F.coalesce(row[c], F.col(c))).alias(c)
            for c in columns])
    others = [c for c in columns if c not in keys]
    n = new.select(*keys, *[F.col(c).alias(c + NEW_SUFFIX) for c in others])
    joined = old.select(*columns).join(n, keys, "full")
    out = {k: F.col(k) for k in keys}
    out.update({c: F.coalesce(F.col(c + NEW_SUFFIX), F.col(c)).alias(c) for c in others})
    return joined.select(*[out[c].alias(c) for c in columns])


def upsert_table(table: str, old: DataFrame | None, new: DataFrame,
                 on_duplicate: str = "error") -> DataFrame:
    """Upsert with the keys and columns of one of the five tables."""
    schema, keys = S.TABLES[table]
    out = upsert(old, new, keys, S.columns(schema), on_duplicate)
    if table == "merged" and old is not None:
        # an old observation may now meet a new forecast: recompute
        out = with_forecast_error(out)
    return out


# The columns of merged that come from the observation.
OBSERVED = ("current_temp_last_updated", "current_temp_c")

# The column giving pull order within each table, used when
# one batch carries several pulls of the same key.
PULL_ORDER = {
    "location": "localtime",
    "current_temp": "created_date_utc",
    "forecast_temp": "created_date_utc",
    "merged": "created_date_utc",
}


def collapse_batch(table: str, df: DataFrame) -> DataFrame:
    """One row per key: the last one in input order, whole.

    ``merged`` takes its last forecast and, apart from it, the last observation
    there was, as upserting the batch's pulls one by one would. Order is the
    rows' own where they carry it, else the pull time. The group-by is on the
    upsert keys, so the following full join reuses its hash partitioning;
    partial aggregation keeps a hot key cheap.
    """
    schema, keys = S.TABLES[table]
    order = "_order" if "_order" in df.columns else PULL_ORDER[table]
    cols = [c for c in S.columns(schema) if c not in keys]
    seen = [c for c in cols if table == "merged" and c in OBSERVED]
    parts = {"rest": ([c for c in cols if c not in seen], F.lit(True))}
    if seen:
        parts["seen"] = (seen, F.col("current_temp_last_updated").isNotNull())
    out = df.groupBy(*keys).agg(*[
        F.max_by(F.struct(*names), F.when(keep, F.col(order))).alias(p) for p, (names, keep) in parts.items()])
    out = out.select(*keys, *[f"{p}.*" for p in parts]).select(*S.columns(schema))
    return with_forecast_error(out) if table == "merged" else out


def checked_batch(table: str, df: DataFrame) -> DataFrame:
    """The rows as they are; a repeated key fails the job."""
    schema, keys = S.TABLES[table]
    return _one_row_a_key(df.select(*S.columns(schema)), keys, table).select("_row.*")


def upsert_location(old, new, on_duplicate="error"):
    return upsert_table("location", old, new, on_duplicate)


def upsert_current(old, new, on_duplicate="error"):
    return upsert_table("current_temp", old, new, on_duplicate)


def upsert_forecast(old, new, on_duplicate="error"):
    return upsert_table("forecast_temp", old, new, on_duplicate)


def upsert_merged(old, new, on_duplicate="error"):
    return upsert_table("merged", old, new, on_duplicate)


def upsert_stats(old, new, on_duplicate="error"):
    return upsert_table("stats", old, new, on_duplicate)
