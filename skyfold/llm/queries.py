"""The operators' registered queries: each takes (spark, sf_dir), each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import bitslices, bpe, centroids, graph, licenses, lines, minhash, mixing, packing, ppm, rabitq, secrets, tokens
from .common import read_table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences and licences of all documents."""
    found = licenses.scan_licenses(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"),
                        *[F.array_join(c, ",").alias(c) for c in ("sentence_ids", "licenses", "unmatched")])


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents."""
    return ppm.identify(read_table(spark, sf_dir, "documents"), keep=["doc_id"])


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(read_table(spark, sf_dir, "documents"), tokens.vocabulary_path())


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources takes of every document."""
    return mixing.mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of all documents."""
    return tokens.token_counts(read_table(spark, sf_dir, "documents"), tokens.vocabulary_path())


def op7_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every 20th embedding, by inner product."""
    return graph.nearest(read_table(spark, sf_dir, "embeddings"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, through a ledger that starts empty."""
    found = secrets.scan(read_table(spark, sf_dir, "documents"), scratch_path(spark, "ledger"))
    return secrets.report(found)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents, later repeats of three-line windows removed."""
    return lines.dedup_lines(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return rabitq.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest-scoring of all documents for every benchmark item."""
    return bitslices.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all embeddings of 64 components."""
    return centroids.cluster(read_table(spark, sf_dir, "embeddings"))[0]


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, and the texts decoded from them, as digests."""
    coded = bpe.encode(read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text"),
                       bpe.vocabulary_path(), decoded="back")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("back").cast("binary"), 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": licenses.oracle(), "op5_minhash": minhash.ORACLE, "op8_secret_scan": secrets.oracle(),
            "op9_line_dedup": lines.ORACLE, "op10_embedding_dedup": rabitq.ORACLE,
            "op11_ranked_search": bitslices.ORACLE, "op12_centroid_clusters": centroids.oracle()}
