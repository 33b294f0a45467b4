"""A corpus pipeline over documents: quality rules, near duplicates, benchmark passages, secrets, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import bpe, decontam, jaccard, rules, secrets
from siltstone.llm.shared import held, release, stored
from siltstone.tables import table

#: Keys of dropped rows up to this number are broadcast (some 80 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 500_000


def _keyed(docs: DataFrame) -> DataFrame:
    """With _row, a digest of id, text and all other columns: rows have the same key only if they are equal."""
    return docs.withColumn("_row", F.unhex(F.md5(F.to_json(F.struct(*docs.columns)))))


def _without(keyed: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows whose _row is not in `dropped`; the texts stay where they are if that is small."""
    gone = stored(dropped.select(F.col("_row").alias("_gone")).distinct(), "dropped")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return keyed.join(gone, F.col("_row") == F.col("_gone"), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, each row by its own verdict.

    Null, empty and wordless texts go, as they fail the base; very long ones are measured whole. A null id has no label,
    which matters to nothing else. Repeated rows stay or go together. Without labels, or from an empty table, only what
    the base says. Columns beside doc_id, text and lang are passed on as they are, whatever their names.
    """
    keyed = _keyed(docs)
    verdicts = rules.quality_rules(keyed, table(spark, sf_dir, "labels"), row_col="_row")
    return _without(keyed, verdicts.where("not kept")).drop("_row")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id (null last); equal rows are one."""
    keyed = _keyed(docs)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    groups = stored(jaccard.near_duplicates(keyed.select(place.alias("place"), "text"), "place"), "groups")
    row = F.col("place._row").alias("_row")
    left = _without(keyed, groups.where(F.col("component_id._row") != F.col("place._row")).select(row))
    again = stored(groups.groupBy(row).count().where("count > 1").select(F.col("_row").alias("_again")), "again")
    if again.isEmpty():
        return left.drop("_row")
    repeated = F.col("_row") == F.col("_again")
    return left.join(again, repeated, "left_anti").unionByName(left.join(again, repeated, "left_semi").dropDuplicates(["_row"])).drop("_row")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage.

    Null and empty texts hold none and stay; very long ones are searched whole. Each row stands on its own text, so a null
    or repeated id is judged for itself; equal rows go together. An empty benchmark takes nothing, an empty table gives none.
    """
    keyed = _keyed(docs)
    return _without(keyed, decontam.find_contamination(keyed, table(spark, sf_dir, "benchmark"), id_col="_row")).drop("_row")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark, n_chars that of the new text.

    Null and empty texts and those without secrets stay as they are; very long ones are scanned whole; repeated rows and
    null ids are redacted each; an empty table stays empty. Other columns are passed on.
    """
    return secrets.redact_secrets(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digest of what they decode to.

    Null and empty texts have no ids and the digest of no bytes; very long ones, long runs of white space among them, are
    encoded in parts with the same ids. A row for each row, null and repeated ids included; an empty table gives none.
    """
    ids = bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality), ("near_duplicates", near_duplicates), ("decontamination", decontaminate), ("secret_scans", redact), ("bpe", encode)]
#: SQL does not express the risk-controlled cutoffs, the latent retrieval or the encoding; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before = held()
        docs = stored(stage(spark, docs, sf_dir), name)
        release(before)  # what the stage stored on its way
    return STAGES[-1][1](spark, docs, sf_dir)
