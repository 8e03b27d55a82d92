"""Line dedup over overlapping three-line windows.

Every three consecutive lines of a document form a window. A window that stands
anywhere else in the corpus keeps its first occurrence, in order of document id
and position; every later one covers its three lines, and covered lines go.
Overlapping later windows merge as they cover the same positions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ddl, lean, stage, workers_import_us

#: lines in a window
WINDOW = 3


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a fingerprint of the text: with the id, it tells documents apart."""
    return docs.withColumns({"_print": F.xxhash64(F.lit(1), "text"), "_length": F.length("text")})


def windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``doc_id, _print, _length, at, a, b``: a 128-bit hash of every window, and which it is."""
    lines = _keyed(docs.select("doc_id", "text")).where("text is not null").withColumn("l", F.split("text", "\n"))
    solid = lines.withColumn("l", F.filter(F.transform("l", lambda x: F.trim(x)), lambda x: x != ""))
    hashed = solid.select("doc_id", "_print", "_length",
                          F.transform("l", lambda x: F.xxhash64(F.lit(2), x)).alias("ha"),
                          F.transform("l", lambda x: F.xxhash64(F.lit(3), x)).alias("hb"))
    each = F.transform(
        F.when(F.size("ha") >= size, F.sequence(F.lit(0), F.size("ha") - size)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(i.alias("at"), *[F.xxhash64(*[F.get(h, i + k) for k in range(size)]).alias(c)
                                            for h, c in (("ha", "a"), ("hb", "b"))]))
    return hashed.select("doc_id", "_print", "_length", F.inline(each))


def dedup_lines(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with later repeats taken out of ``text``, and ``n_lines, n_removed``.

    Lines are compared without the blanks around them; blank lines are no part
    of windows and stay. The shared windows' first places are found by a partial
    aggregation before the shuffle, so a window of very many documents is one
    row a task.

    Defined cases: a null text stays null with 0 lines; texts with fewer lines
    than a window have none and stay whole, as does an empty text; rows with the
    same id and text count as one document and get the same result; a null id
    comes last; an empty table gives an empty result; columns of ``docs`` that
    carry one of the added names are replaced.
    """
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_print", "_length", "at")
    every = stage(windows(docs, size), "windows")
    first = stage(every.distinct().groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n"))
                  .where("n > 1").select("a", "b", "first"), "repeated")
    later = (every.join(first, ["a", "b"]).where(place != F.col("first"))
             .groupBy("doc_id", "_print", "_length").agg(F.collect_set("at").alias("_at")))

    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    keys = ["doc_id", "_print", "_length"]
    right = later.select(*[F.col(k).alias(f"r{k}") for k in keys], "_at")
    same = [F.col(k).eqNullSafe(F.col(f"r{k}")) for k in keys]
    solid = F.size(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""))
    joined = _keyed(docs.select(*own)).join(right, same, "left").select(
        *own, F.coalesce(solid, F.lit(0)).cast("long").alias("n_lines"), "_at")
    text_at = own.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns
            at = columns.pop()
            gone = np.zeros(len(batch), np.int64)
            if at.null_count < len(at):
                rows = pc.indices_nonzero(pc.is_valid(at)).to_pylist()
                texts = []
                for row, text, places in zip(rows, columns[text_at].take(pa.array(rows)).to_pylist(), at.take(pa.array(rows)).to_pylist()):
                    text, gone[row] = _without(text, places, size)
                    texts.append(text)
                columns[text_at] = pc.replace_with_mask(columns[text_at], pc.is_valid(at), pa.array(texts, columns[text_at].type))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(gone)], names=[*own, "n_lines", "n_removed"])

    workers_import_us(docs.sparkSession)
    return joined.mapInArrow(lean(work), f"{ddl(docs.select(*own).schema)}, n_lines long, n_removed long")


def _without(text: str, places: list[int], size: int) -> tuple[str, int]:
    """A text without the windows that begin at ``places`` (of its lines that are
    not blank), and how many lines they cover together."""
    parts = text.split("\n")
    solid = [i for i, x in enumerate(parts) if x.strip(" ")]
    covered = {solid[p + k] for p in places for k in range(size)}
    return "\n".join(x for i, x in enumerate(parts) if i not in covered), len(covered)


ORACLE = f"""
with numbered as (
  select doc_id, text, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) as pos from documents where text is not null),
solid as (
  select doc_id, trim(line) as line, pos, row_number() over (partition by doc_id order by pos) as k
  from numbered where trim(line) <> ''),
win as (
  select doc_id, pos as p1, lead(pos) over w as p2, lead(pos, 2) over w as p3, line as l1,
         lead(line) over w as l2, lead(line, 2) over w as l3 from solid window w as (partition by doc_id order by k)),
ranked as (
  select doc_id, p1, p2, p3, row_number() over (partition by l1, l2, l3 order by doc_id, p1) as rn
  from win where p{WINDOW} is not null),
covered as (
  select distinct doc_id, unnest([p1, p2, p3]) as pos from ranked where rn > 1),
rest as (
  select n.doc_id, string_agg(n.line, chr(10) order by n.pos) filter (c.pos is null) as text, count(c.pos) as n_removed
  from numbered n left join covered c on n.doc_id = c.doc_id and n.pos = c.pos group by n.doc_id)
select d.doc_id, coalesce((select count(*) from solid s where s.doc_id = d.doc_id), 0) as n_lines,
       coalesce(r.n_removed, 0) as n_removed,
       case when d.text is not null then md5(coalesce(r.text, '')) end as text_md5
from documents d left join rest r on d.doc_id = r.doc_id
"""
