"""From raw documents to packed token sequences: stages that each call one text operator.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and, but for the last, returns the columns of
``documents``. Between stages the documents are written as Parquet to the shared folder and read again.

Rows with a null id can't be told apart: the near-copy stage keeps them all. Null texts stay null until they are packed, as empty texts.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import near_copies, packing, quality_rules, secret_linking, simhash
from tickloom.llm.common import discard, stored, table, text_of

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a learned rule go. The rules are learned from the labels of ``docs``."""
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_of("text").alias("text"))
    return quality_rules.judge(row, rules).where("kept").select("row.*")


def _kept_ids(docs: DataFrame) -> DataFrame:
    """(kept_id, n_rows): the smallest id of each class, and the rows that make it so.

    Ids may repeat, so a row is known by the hash of its id and text. Classes of both kinds are named after a row of theirs, and every
    row joins its two classes: only these names go through the components, so copies meet there as one link.
    """
    row = F.xxhash64("doc_id", "text").alias("row")
    rows = docs.select(row, "text")
    by_bits = simhash.near_duplicates(rows, id_col="row").groupBy(F.col("id").alias("row")).agg(F.min("component").alias("a"))
    by_words = near_copies.near_copies(rows, words=5, least=0.8, id_col="row").groupBy(F.col("id").alias("row")).agg(F.min("component").alias("b"))
    named = docs.select(row, "doc_id").groupBy("row").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    both, both_path = stored(named.join(by_bits.hint("merge"), "row").join(by_words.hint("merge"), "row"), "both")
    roots, roots_path = stored(simhash.components(both.select("a", "b")).withColumnRenamed("node", "a"), "roots")
    first = F.min(F.struct("doc_id", "n")).alias("first")
    least = both.groupBy("a", "doc_id").agg(F.sum("n").alias("n")).groupBy("a").agg(first)
    joined = least.join(roots.hint("merge"), "a", "left").select(F.coalesce("root", "a").alias("root"), "first.*")
    classes = joined.groupBy("root", "doc_id").agg(F.sum("n").alias("n")).groupBy("root").agg(first)
    keep, _ = stored(classes.groupBy(F.col("first.doc_id").alias("kept_id")).agg(F.sum("first.n").alias("n_rows")), "kept")
    discard(docs.sparkSession, both_path, roots_path)
    return keep


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, that with the smallest id; of equal rows under that id, one.

    Documents are linked by the SimHash of ``op5`` (four-word shingles, four bits at most), and if their sets of five-word shingles have a
    similarity of 0.8 at least: four bits alone miss many such pairs. A class is what either link reaches.
    """
    keep = _kept_ids(docs.where("doc_id IS NOT NULL"))
    many = keep.where("n_rows > 1")
    # a merge join at every size: the ids grow with the documents and compress well, so their file size is no bound
    staying = docs.join(keep.hint("merge"), F.col("doc_id") == F.col("kept_id"), "left_semi")
    if not many.isEmpty():
        again = staying.join(many, F.col("doc_id") == F.col("kept_id"), "left_semi").distinct()
        staying = staying.join(many, F.col("doc_id") == F.col("kept_id"), "left_anti").unionByName(again)
    return staying.unionByName(docs.where("doc_id IS NULL"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; ``n_chars`` follows where there is such a column."""
    clean = secret_linking.redact_texts(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))
    return clean.select(*[f"`{c}`" for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in token sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, window=4096)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", drop_low_quality),
    ("near_copies", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

#: The packed ids come from a tokenizer library, which SQL cannot express; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = stored(stage(spark, docs, sf_dir), name)
    return docs
