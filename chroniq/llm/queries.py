"""The queries op1 to op13 and pipeline over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from chroniq.llm import audit, decontaminate, langid, mixture, packing, quality, search, simhash, substring, tokens, topk, toxicity, warc
from chroniq.llm.common import ship, table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer's file; operators take the path as a parameter."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_decontaminate(spark, d):
    """Pairs of a document and a benchmark item that it holds, see ``contaminated``."""
    return decontaminate.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op2_mix(spark, d):
    """How many words of each document the mix takes, see ``mix_table``."""
    return mixture.mix_table(table(spark, d, "documents"))


def op3_substring_dedup(spark, d):
    """What is removed of each document, see ``dedup_substrings``; the kept text as its digest."""
    return substring.dedup_substrings(table(spark, d, "documents")).drop("kept_text")


def op4_topk(spark, d):
    """The 5 best vectors for each whose vec_id is divisible by 50, see ``top_k``."""
    return topk.top_k(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_toxicity(spark, d):
    """Toxicity of each document, see ``score_toxicity``."""
    docs = table(spark, d, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, d, "labels")))


def op6_tokens(spark, d):
    """Where each document's ids lie in the token files, and their checksum, see ``token_output``."""
    return tokens.token_output(table(spark, d, "documents"), tokenizer_path())


def op7_warc(spark, d):
    """The record of each page, read back from the archives, see ``warc_round_trip``."""
    return warc.warc_round_trip(table(spark, d, "pages"))


def op8_quality(spark, d):
    """Quality of each document, see ``score_quality``."""
    return quality.score_quality(table(spark, d, "documents"), table(spark, d, "labels"))


def op9_language(spark, d):
    """The language of each document, see ``identify``."""
    return langid.identify(table(spark, d, "documents"))


def op10_simhash(spark, d):
    """Fingerprint and component of each document, see ``simhash_components``; the fingerprint as hexadecimal digits."""
    out = simhash.simhash_components(table(spark, d, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_packing(spark, d):
    """Where each piece of each document lies in the packed sequences, see ``pack``; its ids as their checksum."""
    out = packing.pack(table(spark, d, "documents"), tokenizer_path())
    return out.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op12_filter_audit(spark, d):
    """What each filter removes in each order of the filters, see ``audit_filters``."""
    return audit.audit_filters(table(spark, d, "documents"), table(spark, d, "labels"))


def op13_search(spark, d):
    """The 10 best documents for each benchmark item, see ``ranked``."""
    return search.ranked(table(spark, d, "documents"), table(spark, d, "benchmark"))


def pipeline(spark, d):
    """The rows of the last stage of ``corpus_pipeline``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)


def _shipped(f):
    @functools.wraps(f)
    def query(spark, d):
        ship(spark)
        return f(spark, d)

    return query


QUERIES = {f.__name__: _shipped(f) for f in (op1_decontaminate, op2_mix, op3_substring_dedup, op4_topk, op5_toxicity, op6_tokens, op7_warc, op8_quality, op9_language, op10_simhash, op11_packing, op12_filter_audit, op13_search, pipeline)}
ORACLES = {"op1_decontaminate": decontaminate.SQL, "op2_mix": mixture.SQL, "op3_substring_dedup": substring.SQL, "op4_topk": topk.SQL, "op7_warc": warc.SQL, "op12_filter_audit": audit.SQL, "op13_search": search.SQL}
