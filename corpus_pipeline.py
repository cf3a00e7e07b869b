"""From raw documents to token files, in five stages; each is written and read again before the next."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession

from chroniq.llm import common, decontaminate, mixture, simhash, tokens, toxicity
from chroniq.llm.queries import tokenizer_path

#: Candidates: a SimHash of distinct words within 7 of 64 bits, or a common MinHash band; and a SimHash of distinct five-word
#: shingles within 80 of 256 bits, where a Jaccard similarity of 0.8 is expected at 39 (the angle of the cosine 2 * 0.8 / 1.8,
#: by 256 / pi), and at 48 for 4 of 5 shingles. Each link is then decided by the exact Jaccard similarity of the shingles.
NEAR = {"shingle_words": 1, "max_distance": 7, "distinct_shingles": True, "blocks": 4, "sketch_words": 5, "sketch_distance": 80, "similarity": 0.8}


def stage(f):
    """A stage sends the package to the executors first. What it keeps in the shared folder is its own and no other call's."""

    @functools.wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.ship(spark)
        return f(spark, docs, sf_dir)

    return run_stage


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more for toxicity go, by a model of the ``labels`` whose documents are still there.

    Null and empty texts score as texts without features and stay; repeated rows are judged alike. Without a positive's
    text there is nothing to learn and all stay. An empty table stays empty.
    """
    return toxicity.drop_toxic(docs, toxicity.train(docs, common.table(spark, sf_dir, "labels")))


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: that of the smallest doc_id.

    Texts link by a Jaccard similarity of 0.8 or more of their distinct five-word shingles. Null and empty texts are copies of each
    other. A doc_id that repeats with different texts is as many documents, of which only those go whose own text another stands
    for; rows that repeat both doc_id and text share their fate. A null doc_id stays only where its component has no other. An empty table stays empty.
    """
    return simhash.drop_copies(docs, **NEAR)


@stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold 0.8 or more of the five-token shingles of an item of ``benchmark``.

    Null and empty texts hold none; repeated rows are judged alike. Without documents or items nothing changes.
    """
    return decontaminate.clean_documents(docs, common.table(spark, sf_dir, "benchmark"))


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it: 0 to 3.

    A null source is a source of its own; documents without words come as often as their source's all do for certain. Rows of
    one doc_id in one source share their fate. An empty table stays empty.
    """
    return mixture.mix_documents(docs)


@stage
def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files of its tokens.

    A null or empty text is the end id alone; rows that repeat a doc_id follow each other. No rows: no rows.
    """
    return tokens.token_output(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("simhash near-dedup", drop_near_copies), ("benchmark decontamination", drop_contaminated), ("mixing sources to target weights", mix_sources), ("token-ID output", write_tokens)]

#: SQL can express neither the classifier nor the fingerprints nor the tokenizer; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for ``documents``; of the stored stages only the last one's input stays."""
    docs, path = common.table(spark, sf_dir, "documents"), None
    for k, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            before, path = path, f"{common.scratch_root(spark)}/chroniq-stage-{k}-{uuid.uuid4().hex}"
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
            if before:
                common.delete(spark, [before])
    return docs
