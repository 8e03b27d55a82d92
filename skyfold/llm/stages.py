"""The operators as stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

All but the last return the columns of ``docs``; ``n_chars``, where there is
one, follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lines, minhash, mixing, packing, ppm, tokens
from .common import WHITE

#: a text that no language codes in fewer bits than plain bytes has none of them
PLAIN_BITS = 8.0
#: bytes that a worker's table of units may take while packing: other stages ran before
PACK_KEPT = 20 << 20


def _with_lengths(df: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``df``, ``n_chars`` counted anew."""
    if "n_chars" in columns:
        df = df.withColumn("n_chars", F.length("text").cast(df.schema["n_chars"].dataType))
    return df.select(*columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters or text, and texts that no language's model compresses;
    a missing label becomes the prediction.

    Defined cases: null and empty texts go; repeated rows and rows without an id are judged
    by their text alone; a text of any length is judged whole; with no labelled text to learn
    from, all rows go; an empty table gives an empty one; other columns are carried.
    """
    known = ppm.identify(docs).where((F.col("lang_pred") != ppm.UNKNOWN) & (F.col("bits_per_byte") < PLAIN_BITS))
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later repeats of three-line windows; a document that loses all its lines goes.

    Defined cases: null and empty texts, and those of fewer than three lines, stay as they
    are; rows that repeat id and text count as one document and stay alike; rows without an
    id come last; a text of any length is cut whole, by lines; an empty table gives an empty
    one; other columns are carried.
    """
    cut = lines.dedup_lines(docs).where("n_lines = 0 or n_removed < n_lines")
    return _with_lengths(cut, docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: of the rows with its smallest id,
    that with the smallest hash of its text.

    Decided row by row, by id and text: an id that stands on several texts loses only those
    that have a copy elsewhere.

    Defined cases: rows without an id, and texts without words, link with nothing and all
    stay; of other rows that repeat id and text one stays; a text of any length is compared
    whole; an empty table gives an empty one; other columns are carried (of repeated rows,
    those of one of them).
    """
    found = minhash.near_duplicates(docs, by_row=True).where("root is not null").select("doc_id", "component_id", "print", "root")
    own = found.where("doc_id = component_id")
    several = (own.groupBy("root").agg(F.min("print").alias("first"), F.max("print").alias("last"))
               .where("first < last").select("root", "first"))
    gone = (found.where("doc_id <> component_id").select("doc_id", "print")
            .unionAll(own.join(several, "root").where("print > first").select("doc_id", "print")).distinct()
            .select(F.col("doc_id").alias("_gone"), F.col("print").alias("_gone_print")))
    keyed = docs.select(*docs.columns, F.xxhash64("text").alias("_print"))
    kept = keyed.join(gone, (F.col("doc_id") == F.col("_gone")) & (F.col("_print") == F.col("_gone_print")), "left_anti")
    linked = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").rlike(f"[^{WHITE}]"), F.lit(False))
    if keyed.where(linked).groupBy("doc_id", "_print").count().where("count > 1").take(1):
        # without such rows the next step would change nothing, but move all texts
        kept = kept.where(linked).dropDuplicates(["doc_id", "_print"]).unionAll(kept.where(~linked))
    return kept.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; where it takes a part, its first words.

    Defined cases: null and empty texts have no words and go; repeated rows and rows without
    an id are taken each for itself; a null source is one of the sources; a text of any length
    is taken whole, or cut between words; an empty table gives an empty one; other columns
    are carried.
    """
    taken = mixing.mix(docs).where("taken > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(taken - 1) div size"))))
    words = F.least(F.col("size"), F.col("taken") - F.col("_copy") * F.col("size"))
    pieces = F.regexp_extract_all("text", F.lit(f"[{WHITE}]*[^{WHITE}]+"), F.lit(0))
    part = F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")
    return _with_lengths(taken.withColumn("text", F.when(words < F.col("size"), part).otherwise(F.col("text"))), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens.

    Defined cases: a null or empty text is its end id alone; repeated rows and rows without
    an id are packed each for itself; a text of any length is encoded whole and cut into
    pieces; an empty table gives an empty result; other columns are ignored.
    """
    return packing.pack(docs, tokens.vocabulary_path(), kept=PACK_KEPT)
