"""The corpus pipeline: good documents, one of each group of near copies, without
secrets, packed into sequences.

Each stage takes the documents that the one before kept. All but the last return
the columns of documents; the last returns the sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import blobs, neardup, packing, quality
from freshet.llm.chunks import unused
from freshet.llm.graph import written
from freshet.llm.queries import table
from freshet.operators.ranking import positions

LEAST_SCORE = 0.3
ORACLE_SQL = None  # a fitted classifier and a tokenizer are not SQL; the tests hold a plain version against run()


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier, fitted on those of them with a label, rejects."""
    space = quality.fit(docs, table(spark, sf_dir, "labels"))
    score = unused(docs.columns, "score")
    return quality.score(docs, space, score).filter(F.col(score) >= LEAST_SCORE).drop(score)


def keyed(docs: DataFrame, key: str) -> DataFrame:
    """Gives each distinct pair of id and text a whole number of its own: the id itself, but for
    null ids and for all texts but one of an id, which get numbers above all ids.

    Only narrow rows of id and hash are grouped; the documents are joined with
    the numbers only if there are any. Ids are below 2 ** 62.
    """
    h, at = (unused([*docs.columns, key], n) for n in ("h", "at"))
    hashed = docs.withColumn(h, F.xxhash64("text"))
    pairs = hashed.groupBy("doc_id", h).agg(F.count("*").alias("_rows"))
    first = pairs.groupBy("doc_id").agg(F.min(h).alias("_h"), F.count("*").alias("_texts"))
    several = first.filter("doc_id IS NULL OR _texts > 1").select(F.col("doc_id").alias("_id"), "_h")
    same = pairs["doc_id"].eqNullSafe(several["_id"])
    others = written(pairs.join(several, same).filter((F.col(h) != F.col("_h")) | F.col("doc_id").isNull()).select("doc_id", h), "other-texts")
    if others.isEmpty():
        return hashed.withColumn(key, F.col("doc_id")).drop(h)
    most = pairs.agg(F.max("doc_id")).first()[0] or 0
    numbers = positions(others, [F.col("doc_id"), F.col(h)], at).select(F.col("doc_id").alias("_id"), F.col(h).alias("_h"), at)
    joined = hashed.join(numbers, hashed["doc_id"].eqNullSafe(numbers["_id"]) & (hashed[h] == numbers["_h"]), "left")
    return joined.withColumn(key, F.coalesce(F.col(at) + F.lit(most + 1), "doc_id")).drop(h, at, "_id", "_h")


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies on runs of five words: that of the least id.

    Two texts of one id are two documents, of which the one with the lesser hash stands for the
    id; rows without an id are documents too and give way to those with one. Of rows
    that repeat id and text one stays. Documents without words are in no group: each id keeps one
    row for each such text.
    """
    key = unused(docs.columns, "row_key")
    rows = keyed(docs, key)
    groups = neardup.linked(rows, percent=80, width=5, doc_id=key)
    copies = groups.filter("NOT kept").select(key).distinct()
    left = rows.join(copies.hint("merge"), key, "left_anti")
    again = groups.filter("kept").groupBy(key).count().filter("count > 1").select(key)
    again = written(again, "repeated-rows")
    if again.isEmpty():
        return left.select(*docs.columns)
    one = left.join(again, key, "left_semi").groupBy(key).agg(F.first(F.struct(*docs.columns)).alias("_row"))
    alone = left.join(again, key, "left_anti").select(*docs.columns)
    return alone.unionByName(one.select("_row.*"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark; ``n_chars`` follows. Documents without any stay as they are."""
    blob, hits = unused(docs.columns, "blob"), unused(docs.columns, "hits")
    found = blobs.redacted(blobs.scan(docs, blob=blob, hits=hits).drop(blob), hits=hits)
    if "n_chars" not in docs.columns:
        return found.select(*docs.columns)
    kept = found.drop("n_chars").withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of powers of two."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", good), ("near_duplicates", distinct), ("secrets", clean), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over all documents, each written to the
    shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
