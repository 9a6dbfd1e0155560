"""Corpus pipeline: quality rules, near-duplicates, personal data, mixture and packing over documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each one's result as Parquet in the
shared folder and reads it again as the next one's input. All but the last return the columns of documents. A stage's own
tables are deleted when the next stage starts, as its result has been written by then.

Defined results, of every stage: an empty table gives an empty one, and repeated rows count one by one unless a stage says
otherwise. Null and empty texts fail the quality rules; the later stages, which take any table of documents, treat them as
copies of each other, leave them as they are, take them once and pack the end token alone. Very long texts are read whole.
Of copies the least id stays, one row if it is repeated; rows of a null id stay unless they are copies of one with an id.
Extra columns come back as they are, whatever their names; the mixture makes ``epoch`` and ``place`` and drops them again,
so columns of these two names are not taken.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from pairloom.llm.common import distinct_names, drop_stored, recorded, shared_folder
from pairloom.llm.mixing import mix
from pairloom.llm.near_copies import near_copies
from pairloom.llm.packing import pack, token_pieces
from pairloom.llm.pii import redact
from pairloom.llm.quality import keep_good
from pairloom.llm.simhash import keep_one

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Folders of the last stage's tables, by application.
_stored: dict[str, list[str]] = {}


def _finish(spark: SparkSession) -> None:
    drop_stored(spark, _stored.pop(spark.sparkContext.applicationId, []))


def _stage(made: Stage) -> Stage:
    @wraps(made)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _finish(spark)
        with recorded() as folders:
            found = made(spark, docs, sf_dir)
        _stored[spark.sparkContext.applicationId] = folders
        return found

    return stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the weakly supervised rules keep."""
    return keep_good(docs)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies: equal ones and those of 0.8 or more in five-word shingles, by SimHash."""
    return keep_one(docs, near_copies(docs))


@_stage
def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return redact(docs)


@_stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and those of small sources as often as the tempered weights ask."""
    return distinct_names(mix(docs), *docs.columns)


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    import public_tokenizers

    return pack(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_dedup),
    ("personal data", private),
    ("mixture", mixture),
    ("packing", packing),
]

#: Fingerprints, templates of context and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        _finish(spark)
        if k:
            drop_stored(spark, [f"{folder}/{k - 1}"])
    return docs
