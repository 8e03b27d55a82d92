"""JSON document source: place label -> record, decoded to one row per record.

Two layouts are read:

* ``multiline=False``: newline-delimited documents, one JSON object per
  line. Files split, so many documents read in parallel.
* ``multiline=True``: one (pretty-printed) document per file, read whole;
  parallelism then comes from the number of files.
* ``multiline=None`` (default): a file none of whose lines is a JSON object
  is one document, any other is newline-delimited. Costs one pass over the
  lines; say which it is where that matters.

A document that is not one JSON object decodes to a null map and is reported
as malformed with its text; ``{}`` decodes to no records. A line that is
itself a record (it has a location and a forecast) is one record without label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# What JSON itself does not allow.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
# Fixed value: a key repeated in a record then keeps its last value.
REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


# The parts by which an object is told to be a record itself.
RECORD_PARTS = ("location", "forecast")

# Lines of each task that are parsed first to tell a file's layout, and the
# bits of a row number that count the rows of one task.
FIRST_LINES, LINE_BITS = 16, (1 << 33) - 1


def read_documents(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """Raw documents: (source, text)."""
    def read(whole: bool, files: DataFrame | None = None) -> DataFrame:
        df = spark.read.text(path, wholetext=whole).select(F.input_file_name().alias("source"), F.col("value").alias("text"))
        df = df if whole else df.where(F.trim("text") != "")
        return df if files is None else df.join(files, "source", "left_semi")

    if multiline is not None:
        return read(multiline)
    lines = read(False)
    # the first lines that each task reads tell of most files; only where they don't, all lines are parsed
    line = F.monotonically_increasing_id().bitwiseAND(LINE_BITS)
    first = lines.select("source", F.when(line < FIRST_LINES, _an_object("text")).otherwise(False).alias("found"))
    if not first.groupBy("source").agg(F.max("found").alias("by_line")).where("not by_line").take(1):
        return lines
    files = lines.groupBy("source").agg(F.max(_an_object("text")).alias("by_line"))
    if not files.where("not by_line").take(1):
        return lines
    return read(False, files.where("by_line")).unionByName(read(True, files.where("not by_line")))


def _entries_with_position() -> Column:
    """(pos, key, value) entries of map ``m``, as a Python dict would keep them.

    ``from_json`` keeps every entry of a repeated label; a dict keeps one,
    at the position of the first occurrence, with the last value. Labels
    are sorted once by (label, -index): in each run of equal labels the
    first element is the last occurrence and the final element the first
    one. O(n log n) per document, no shuffle, and only for documents that
    repeat a label. Uses the helper columns ``_ranked``, ``_keys``, ``_vals``.
    """
    ranked = F.col("_ranked")
    n = F.size(ranked)
    last = F.filter(ranked, lambda e, j: (j == 0) | (ranked[j - 1]["k"] != e["k"]))
    first = F.filter(ranked, lambda e, j: (j == n - 1) | (ranked[j + 1]["k"] != e["k"]))
    pairs = F.array_sort(F.transform(
        F.arrays_zip(first.alias("f"), last.alias("l")),
        lambda p: F.struct((-p["f"]["ni"]).alias("pos"), (-p["l"]["ni"]).alias("src"))))
    deduped = F.transform(pairs, lambda p: F.struct(
        p["pos"].alias("pos"), F.col("_keys")[p["src"]].alias("key"),
        F.col("_vals")[p["src"]].alias("value")))
    plain = F.transform(F.col("_keys"), lambda k, i: F.struct(
        i.alias("pos"), k.alias("key"), F.col("_vals")[i].alias("value")))
    return F.when(ranked.isNull(), plain).otherwise(deduped)


def _parsed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``m``: the map of a text that is one JSON object and nothing else, or null.

    A parser reads one value and forgets the rest of the text. So the text is
    read as the first field of an object whose second one, named by a hash of the
    text, follows it: whatever stands after the object in the text adds a field,
    breaks the outer object or ends it before that second field. One parse: the
    outer object is a column of its own, as it is used three times.
    """
    end = F.hex(F.xxhash64("text"))
    outer = F.from_json(F.concat(F.lit('{"d":'), F.col("text"), F.lit(',"'), end, F.lit('":{}}')),
                        "map<string,map<string,variant>>", STRICT)
    alone = (F.size("_outer") == 2) & (F.map_keys("_outer")[1] == end)
    return docs.withColumn("_outer", outer).withColumn("m", F.when(alone, F.map_values("_outer")[0])).drop("_outer")


def _an_object(text: str) -> Column:
    """Whether a line is a JSON object; only lines in braces are parsed to tell."""
    bare = F.trim(F.col(text), F.lit(" \t\r\n"))
    return F.when(bare.startswith("{") & bare.endswith("}"), F.json_object_keys(text).isNotNull()).otherwise(False)


def decode_documents(docs: DataFrame) -> DataFrame:
    """One row per record: (source, doc, doc_ok, text, pos, label, record variant).

    ``doc`` rises with the documents of a source and ``pos`` is the record's
    position in its document: together, input order. ``doc_ok`` is false
    for text that is not one JSON object; such a document yields one row
    with its text and a null label and record, so it can be reported. A
    record that repeats a key keeps the key's last value, as a dict does.
    """
    docs.sparkSession.conf.set(REPEATED_KEYS, "true")
    m = F.col("m")
    keys = F.map_keys(m)
    ranked = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), (-i).alias("ni"))))
    parsed = (
        _parsed(docs.select("source", "text", F.monotonically_increasing_id().alias("doc")))
        .withColumn("_ranked", F.when(F.size(F.array_distinct(keys)) < F.size(m), ranked))
        .withColumn("_keys", keys)
        .withColumn("_vals", F.map_values(m))
    )
    record = F.lit(True)
    for part in RECORD_PARTS:
        record = record & F.array_contains(keys, part)
    alone = F.array(F.struct(F.lit(0).alias("pos"), F.lit(None).cast("string").alias("key"),
                             F.try_parse_json("text").alias("value")))
    out = parsed.select(
        "source", "doc",
        m.isNotNull().alias("doc_ok"),
        F.when(m.isNull(), F.col("text")).alias("text"),
        F.explode_outer(F.when(record, alone).when(m.isNotNull(), _entries_with_position())).alias("e"),
    )
    return out.where(F.col("e").isNotNull() | ~F.col("doc_ok")).select(
        "source", "doc", "doc_ok", "text", F.col("e.pos").alias("pos"), F.col("e.key").alias("label"),
        F.col("e.value").alias("record"))
