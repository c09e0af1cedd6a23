"""The registered queries ``opN_<name>`` and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm.chat_template import format_conversations, read_back
from tollgate.llm.common import read
from tollgate.llm.duckdb_bpe import encode_digests
from tollgate.llm.fill_middle import fill_in_middle, restore
from tollgate.llm.huffman_ids import read_documents, store_ids
from tollgate.llm.oracles import ORACLE_SQL  # noqa: F401 - read by the entry module
from tollgate.llm.quality_forest import fit_quality, judge_quality
from tollgate.llm.secret_grammar import find_secrets, learn_formats
from tollgate.llm.similarity_sketch import near_duplicates
from tollgate.llm.string_kernel import fit_toxicity, score_toxicity
from tollgate.llm.subspace_join import near_vectors
from tollgate.llm.tokens import library_encoder, word_end_encoder
from tollgate.llm.trie_counts import count_tokens
from tollgate.llm.vector_packing import pack_documents
from tollgate.llm.warc_chunks import read_chunks, records, write_archives
from tollgate.llm.whitening import whiten


def op1_secret_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return find_secrets(docs, learn_formats(docs))


def op2_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"), cosine=0.93)


def op3_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, read(spark, sf_dir, "labels")))


def op4_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(read(spark, sf_dir, "pages"), min_bytes=0)
    return records(read_chunks(archives))


def op5_duckdb_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_digests(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def packing_ids(path: str | None = None):
    """Makes, in a worker, the encoder whose ids are packed."""
    return lambda: word_end_encoder(path or public_tokenizers.path("word_bpe_49k.json")).ids


def op6_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), packing_ids(), end_id=0)


def op7_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make_encode():
        path = public_tokenizers.path("byte_bpe_50k.json")
        return library_encoder(path, public_tokenizers.PATTERN, cache_bytes=(80 << 20, 16 << 20)).ids

    manifest = store_ids(read(spark, sf_dir, "documents"), make_encode, size=50_257, end_id=0)
    return read_documents(spark, manifest)


def op8_trie_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return judge_quality(docs, fit_quality(docs, read(spark, sf_dir, "labels")))


def op10_similarity_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), width=2, percent=80)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Beyond 64 bits the contract's column has no value for the exact deviation.
    return whiten(read(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = restore(fill_in_middle(read(spark, sf_dir, "documents")))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


#: A conversation whose texts look like the format itself.
MARKED_TEXT = "</s>[INST] ok [/INST]"


def op13_chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-7, 0, "user", MARKED_TEXT), (-7, 1, "assistant", MARKED_TEXT)], rows.schema)
    return read_back(format_conversations(rows.unionByName(marked)), in_order=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_grammar": op1_secret_grammar,
    "op2_subspace_join": op2_subspace_join,
    "op3_string_kernel": op3_string_kernel,
    "op4_warc_chunks": op4_warc_chunks,
    "op5_duckdb_bpe": op5_duckdb_bpe,
    "op6_vector_packing": op6_vector_packing,
    "op7_huffman_ids": op7_huffman_ids,
    "op8_trie_counts": op8_trie_counts,
    "op9_quality_forest": op9_quality_forest,
    "op10_similarity_sketch": op10_similarity_sketch,
    "op11_whitening": op11_whitening,
    "op12_fill_middle": op12_fill_middle,
    "op13_chat_template": op13_chat_template,
}
