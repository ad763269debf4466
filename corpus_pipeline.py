"""From raw documents to token ids: the stages of a training corpus, each over all rows.

1. language_id: documents whose text the language classifier rejects go; a missing language is
   filled with the prediction.
2. line_dedup: lines in repeated three-line windows are taken out, ``n_chars`` follows.
3. near_dedup: of each class of near duplicates the document of the smallest id stays.
4. mixing: every document is repeated or left out so that the sources meet their targets.
5. bpe: the ids of each text by the tokenization automaton, and the text decoded from them.

Each stage's result is written as Parquet below the shared checkpoint folder and read again,
so a lost executor never costs more than one stage.  All but the last return the columns of
``documents`` as they came.  Nulls, empty tables and repeated rows go as the operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.llm import bpe, language_id, line_dedup, mixing, near_dups
from playlens.llm.common import fresh, written


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    names = fresh([*docs.columns, *language_id.PREDICTED], *docs.columns)  # no stage column can clash
    roles = {"doc_id", "text", "lang"}
    plain = [c if c in roles else n for c, n in zip(docs.columns, names)]
    rows = language_id.predict(docs.toDF(*plain), language_id.learn(docs)).filter(~F.col("rejected"))
    lang = {"lang": F.coalesce(F.col("lang"), F.col("lang_pred")).alias("lang")}
    return rows.select(*[lang.get(p, F.col(p).alias(c)) for c, p in zip(docs.columns, plain)])


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that stood elsewhere before."""
    rows = line_dedup.dedup_lines(docs)
    kinds = dict(docs.dtypes)
    length = {"n_chars": F.length("text").cast(kinds.get("n_chars", "long")).alias("n_chars")}
    return rows.select(*[length.get(c, F.col(c)) for c in docs.columns])


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dups.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, ``n_tokens``, ``ids`` and ``decoded``."""
    rows = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id", "lang", "source"])
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language_id", identified),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", one_of_near_copies),
    ("mixing", mixed),
    ("bpe", encoded),
]

#: No SQL can express the classifier, the sketches or the encoding; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
