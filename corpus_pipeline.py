"""From raw documents to training sequences, in five stages, each an operator of `ledgerlens.llm`.

A stage takes the Parquet output of the one before. All but the last return the columns of `documents`. Stages that run Python
bound the session's Arrow batches, unless it has a setting of its own (`spark.sql.execution.arrow.maxRecordsPerBatch`).

1. Toxicity: documents that the classifier rejects go. It learns from all labelled documents of the stage's input.
2. Exact dedup: of equal texts the smallest doc_id stays.
3. SimHash near-dedup: of each group of near copies the smallest doc_id stays.
4. Mixing: documents are taken to the target weights of their sources, whole, several times, or in part.
5. Packing: power-of-two pieces of token ids, written by length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import exact_dedup, mixing, packing, simhash, toxicity
from ledgerlens.llm.common import Workspace, small_batches
from ledgerlens.llm.tokens import vocabulary_path

#: Session setting that names the folder of the packed ids; what it holds is replaced.
PACKED_PATH = "ledgerlens.packed.path"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5. A text that is NULL counts as empty; rows without an id, and repeated rows, are judged by
    their text. Without labelled documents of both kinds there is no evidence, and all stay. An empty table stays empty."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, Workspace(spark, "toxicity"), held_out=None)
    return toxicity.clean_documents(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of those with equal texts, runs of blanks being one space: the smallest doc_id, NULL being larger than any.
    NULL and empty texts are one group. Of repeated rows one stays. An empty table stays empty."""
    small_batches(spark)
    return exact_dedup.drop_copies(docs, Workspace(spark, "exact-dedup"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints: the smallest doc_id, NULL being larger than any, then the smallest
    hash of the text. Texts without words share fingerprint zero. An empty table stays empty."""
    small_batches(spark)
    return simhash.keep_one(docs, Workspace(spark, "simhash"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, or as much of them, as the mix takes, each time a row. A NULL source is one of its own; documents
    without words, and sources whose target is below half a block of words, give nothing. An empty table stays empty."""
    return mixing.mixed_documents(docs, Workspace(spark, "mixing"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the pieces by length to a folder, where they stay, and reads their digests from there: doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset. The folder is that of the session's setting
    `ledgerlens.packed.path`, or packed-*/buckets of `spark.checkpoint.dir`. A text that is NULL or empty gives the end id alone."""
    small_batches(spark)
    pieces = packing.binary_pieces(docs, vocabulary_path("word_bpe_49k.json"))
    return packing.bucketed_digest(pieces, packed_path(spark))


def packed_path(spark: SparkSession) -> str:
    """Where the packed ids go: the folder that the setting `PACKED_PATH` names, or a new one in the shared folder."""
    return spark.conf.get(PACKED_PATH, None) or f"{Workspace(spark, 'packed', keep=True).root}/buckets"


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: A classifier that is trained, near copies and tokenizers are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each result is written to the shared folder and read again."""
    space = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = ""
    for name, stage in STAGES:
        docs = space.table(name, stage(spark, docs, sf_dir))
        if before:
            space.drop(before)
        before = name
    return docs
