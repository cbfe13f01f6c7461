"""Corpus pipeline: quality rules, line dedup, near-dedup, decontamination, tokenising.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; every
stage but the last returns the columns it got. Between stages the documents are written
to the shared folder as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordsmith.llm.bpe import bpe_decode, bpe_encode
from recordsmith.llm.common import read_table, settled, stash, words_of
from recordsmith.llm.decontaminate import drop_leaks
from recordsmith.llm.lines import line_dedup
from recordsmith.llm.minhash import near_duplicates
from recordsmith.llm.quality import quality

LOST = 0.8                   # share of its words that a document loses as one of repeated lines


def _carried(docs: DataFrame) -> DataFrame:
    """All columns in one, beside the two that operators read: no name can clash."""
    return docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("__row"), "doc_id", "text")


def _back(df: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The columns of ``docs`` with a new text, and its length where there is a column for it."""
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return df.select(*[(new[c] if c in new else F.col(f"__row.`{c}`")).alias(c) for c in docs.columns])


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go (null, empty and short texts among them); the others lose
    their failing lines."""
    judged = quality(_carried(docs)).where("kept")
    return _back(judged, docs, F.col("clean_text"))


def line_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go. A document that loses LOST of its words or more
    that way repeats earlier documents as a whole and goes too."""
    done = line_dedup(_carried(docs))
    before, after = (F.size(words_of(F.col(c))) for c in ("text", "clean_text"))
    repeats = (F.col("n_equal") + F.col("n_near") > 0) & (before - after >= LOST * before) & (before > 0)
    done = done.withColumn("__keep", settled(~F.coalesce(repeats, F.lit(False)))).where("__keep")
    return _back(done, docs, F.col("clean_text"))


def near_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, the one of the smallest id (rows without an
    id come last), of these the one of the smallest text digest. Rows that share an id but
    not their text are judged apart, and rows without words stay."""
    keyed = stash(docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("__row"),
                              F.monotonically_increasing_id().alias("__key")), "keyed")      # one number a row, for good
    rows = keyed.select("__key", F.col("__row.doc_id").alias("doc_id"), F.col("__row.text").alias("text"))
    found = near_duplicates(rows, doc_id="__key").select(F.col("doc_id").alias("__key"), "component_id")
    rank = rows.select("__key", F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", F.md5("text").alias("t"), "__key").alias("rank"))
    first = (found.join(rank, "__key").groupBy("component_id").agg(F.min("rank").alias("rank"), F.count("*").alias("c"))
             .where("c > 1").select("component_id", F.col("rank.__key").alias("first")))
    gone = found.join(first, "component_id").where(F.col("__key") != F.col("first")).select("__key")
    return keyed.join(gone, "__key", "left_anti").select(*[F.col(f"__row.`{c}`").alias(c) for c in docs.columns])


def decontamination_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def tokens_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip): packed token ids, and whether decoding them
    gives back the text."""
    source = docs.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    coded = bpe_decode(bpe_encode(source, keep_text=False))
    return coded.select("doc_id", "n_tokens", "ids", (F.sha2("decoded", 256) == F.col("sha")).alias("round_trip"))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("minhash_dedup", near_stage),
    ("decontamination", decontamination_stage),
    ("bpe_tokens", tokens_stage),
]

# Hashed near-dedup and tokenising have no SQL form; tests hold the stages against
# brute-force versions.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
