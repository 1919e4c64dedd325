"""Queries that encode, count and pack tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from cohorta.llm import packing, token_counts, transducer, word_shuffle
from cohorta.llm.common import table
from cohorta.llm.queries.registry import query

# The contract's end id, sequence length and token limit.
END_ID, LONGEST, TOKEN_LIMIT = 2, 4096, 2048


@query("op1_binary_packing")
def binary_packing(spark, folder):
    pieces = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), END_ID,
                          LONGEST, with_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op3_lexicon_transducer")
def lexicon_transducer(spark, folder):
    coded = transducer.encode_decode(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op9_prefix_counts")
def prefix_counts(spark, folder):
    counted = token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                                        budget=TOKEN_LIMIT)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "n_fit")


@query("op11_word_shuffle")
def distinct_words(spark, folder):
    coded = word_shuffle.encode_decode(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
