"""The corpus pipeline: stages over documents, each written as Parquet and reread as the next one's docs.

All stages but the last return the columns of documents, whatever these are, with their own values: what
an operator adds under the same name is dropped. Columns other than doc_id, text and source
may be absent or null. What a stage does with null ids, null and empty texts, ties and repeated rows is
in its docstring; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import mixing, packing, simhash, substrings, toxicity
from sluice.llm.common import discard, saved
from sluice.llm.queries import TOKENIZER, table

TOXIC = 0.7
USED = ("doc_id", "text", "source")


def aside(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What work makes of docs, with docs' columns only; those that no operator needs bear other names meanwhile."""
    hidden = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c not in USED}
    return work(docs.withColumnsRenamed(hidden)).select([F.col(hidden.get(c, c)).alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below TOXIC; the labels that aren't held out teach the model.

    Each row is judged by its text alone, so repeated rows fare alike. Null and empty texts
    score as texts without any match, and stay; so do rows with a null id.
    """
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(~toxicity.held_out()))
    return aside(docs, lambda rows: toxicity.score(rows, model, score_col="__toxicity").where(F.col("__toxicity") < TOXIC))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts with 0.8 of their five-word shingles or more in common.

    Fingerprints that BK-trees link nominate, and MinHash bands what three bits don't reach; the full sets of shingles decide.
    Of a group the row with the least id stays; ties and repeated rows as simhash.one_of_each says.
    Null and empty texts are one group. Rows with a null id all stay.
    """
    return aside(docs, simhash.one_of_each)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that smaller doc_ids have too, their other words joined by one space; those that had nothing else are left out.

    A text from which nothing goes stays as it is, null and empty ones among them. n_chars, where there is
    such a column, is counted anew where words went. Rows that share an id don't cut one another; rows with a null id come last.
    """

    def cut(rows: DataFrame) -> DataFrame:
        out = substrings.repeated_passages(rows)
        out = out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words"))).withColumn("__cut", F.col("n_removed") > 0)
        if "n_chars" in docs.columns:
            chars = f"__own_{docs.columns.index('n_chars')}"
            out = out.withColumn(chars, F.when(F.col("__cut"), F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(chars)))
        return out.withColumn("text", F.when(F.col("__cut"), F.col("kept_text")).otherwise(F.col("text")))

    return aside(docs, cut)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says.

    A null source is one of its own. Rows that share an id, null or not, share a coin. Texts without
    words have no size: they come as often as whole copies of their source do.
    """
    return aside(docs, lambda rows: mixing.emitted(mixing.mix(rows)))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 2048 ids; the executors' heaps are full by now, so that the encoder keeps fewer words.

    Null texts are empty documents, which have the end id alone. Repeated rows and rows with a null id are documents of their own.
    """
    return packing.pack(docs, TOKENIZER, keep=200_000)


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("repeated_passages", cut_repeats), ("mixing", mix_sources), ("packing", pack_windows)]
#: SQL can't express the toxicity model, the sketches and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents through all stages; a stage's table goes once the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = saved(docs, name)
            if before is not None:
                discard(before)
            before = docs
    return docs
