"""A training corpus from ``documents`` in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs.  A stage deletes
the staged tables of the stages before it, so their results must be written
by then.  All but the last return the columns of docs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from islet.llm import decontaminate, exact_substrings, langid, mixing, setsketch
from islet.llm.common import drop_staged, stage, table
from islet.session import shared_path

#: A document stays if one language holds at least this share of its letters.
MIN_SHARE = 0.5
#: A run of bytes goes if all of it is in strings of so many bytes that stand
#: anywhere else, and it holds so many words.
REPEAT_BYTES, REPEAT_WORDS = 200, 51


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters and texts in which no language holds
    ``MIN_SHARE`` of the letters.  Without any labelled row to learn from, only
    the former go."""
    drop_staged(spark)
    model = langid.fit(docs.filter(~langid.held_out()).select("text", "lang"))
    if not model.langs:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = langid.label(docs, model)
    return found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SHARE)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    drop_staged(spark)
    return setsketch.deduplicated(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that stand anywhere else are cut from the texts."""
    drop_staged(spark)
    return exact_substrings.deduplicated(docs, REPEAT_BYTES, REPEAT_WORDS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words of a benchmark item go."""
    drop_staged(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with ``taken``: how many of their words (all,
    repeatedly or in part) it takes.  Columns of docs that have the name of one
    of the plan's (in any case) get ``doc_`` before it, as often as needed."""
    drop_staged(spark)
    rows = stage(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at")), "rows")
    # whole texts meet only the finished plan, by the row's number
    plan = mixing.mix(rows.select("at", "row.doc_id", "row.source", "row.text"), ["at"])
    plan = plan.filter("taken > 0").select(F.col("row.at").alias("at"), "size", "source_size", "target", "taken")
    own = ["size", "source_size", "target", "taken"]
    used = {c.lower() for c in docs.columns} | set(own)
    names = []
    for c in docs.columns:
        if c.lower() in own:
            while c.lower() in used:
                c = f"doc_{c}"
            used.add(c.lower())
        names.append(c)
    row = [F.col(f"row.`{c}`").alias(new) for c, new in zip(docs.columns, names)]
    return rows.join(plan, "at").select(*row, *own)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("benchmark", benchmark),
    ("mixture", mixture),
]

#: Near duplicates and language models are beyond SQL; tests hold each stage
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
