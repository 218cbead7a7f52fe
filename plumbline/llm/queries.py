"""The registered queries of this package: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import bpe, collocations, langid, preference, repeats, sentencepiece_bpe, spelling, toxicity
from plumbline.llm.decontamination import contamination
from plumbline.llm.html_text import extract_main_text
from plumbline.llm.multi_index import near_duplicates
from plumbline.llm.ngram_join import similar_documents
from plumbline.llm.passages import repeated_passages

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of the benchmark in all documents, with their edits."""
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What goes from each document as it stands 400 bytes long elsewhere, and a digest of the rest."""
    return repeats.digest(_table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_main_text(_table(spark, sf_dir, "pages"), ["page_id", "url"])


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of fifty words or more of documents that near-repeat in another one."""
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt outside every fourth."""
    return langid.digest(_table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document, and of what its ids decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    documents = _table(spark, sf_dir, "documents")
    return bpe.digests(bpe.encode(documents, ["doc_id"], "text", path, public_tokenizers.PATTERN, True), ["doc_id"])


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learnt outside every fifth."""
    return toxicity.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by similar shingle sets."""
    return similar_documents(_table(spark, sf_dir, "documents"))


def op9_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and masked completions of every conversation against its neighbour."""
    return preference.digest(_table(spark, sf_dir, "conversations"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors linked by their cosine."""
    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language the 2000 phrases of documents whose words keep together best."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document, and of what its ids decode to."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    ids = sentencepiece_bpe.encode(_table(spark, sf_dir, "documents"), ["doc_id"], "text", path, decoded=True)
    return sentencepiece_bpe.digests(ids, ["doc_id"])


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents and the frequent word each may be a variant of."""
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From all documents to token counts, in five stages."""
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    registered = (
        op1_benchmark_decontamination,
        op2_suffix_array_dedup,
        op3_html_extraction,
        op4_substring_dedup,
        op5_language_id,
        op6_bpe,
        op7_toxicity,
        op8_ngram_jaccard_join,
        op9_preference_formatting,
        op10_embedding_near_dedup,
        op11_phrase_collocations,
        op12_sentencepiece,
        op13_spelling_variants,
        pipeline,
    )
    return {f.__name__: f for f in registered}


def oracle_sql() -> dict[str, str]:
    return {
        "op9_preference_formatting": preference.ORACLE_SQL,
        "op11_phrase_collocations": collocations.ORACLE_SQL,
        "op13_spelling_variants": spelling.ORACLE_SQL,
    }
