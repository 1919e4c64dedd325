"""Packing by powers of two: a document is cut into pieces of binary lengths, each its own sequence."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.llm.bpe import Bpe
from cohorta.llm.common import text_of, travels
from cohorta.llm.pieces import WORDS, Pieces, Rows, ids_of, special_pattern

travels(__name__)

PIECES = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, ids array<int>"


def binary_lengths(tokens: int, longest: int) -> list[int]:
    """Whole pieces of ``longest`` (a power of two), then the binary digits of the rest, large first."""
    rest = tokens % longest
    return [longest] * (tokens // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def document_ids(bpe: Bpe, pieces: Pieces, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts in one array, each text with its end id, and where each text ends."""
    rows = ids_of(pieces.entries, bpe, bpe.encode)
    rows = Rows(np.append(rows.flat, np.int32(end_id)), np.append(rows.lengths, 1))
    ends = np.cumsum(pieces.counts)
    numbers = np.insert(pieces.numbers, ends, len(rows.lengths) - 1)
    upto = np.cumsum(rows.lengths[numbers])
    return rows.take(numbers), upto[ends + np.arange(len(ends))]


def pack(docs: DataFrame, tokenizer: str, end_id: int, longest: int = 4096, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: where it starts in its document, its length, checksum, ids and sequence.

    A document is its tokens without special ones, then ``end_id``. Every piece's length is a
    power of two up to ``longest``; a sequence is one piece, so nothing is padded and no sequence
    crosses documents. Null and empty texts are the end id alone. Repeated rows are packed each,
    and an empty table gives no rows. ``length`` is the bucket: equal lengths batch together (see
    ``write_buckets``). Nothing is shuffled; ``sequence_id`` numbers rows by partition, which a
    repeated task repeats as long as its input is the same files or a checkpoint.
    """
    if longest & (longest - 1) or longest < 1:
        raise ValueError("longest must be a power of two")
    with open(tokenizer, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary: a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(shared.value)
        special = special_pattern(bpe)
        for batch in batches:
            doc_ids = batch.column(0)
            for pieces in WORDS.batch(batch.column(1), special):
                ids, ends = document_ids(bpe, pieces, end_id)
                raw = memoryview(ids.astype("<u4").tobytes())
                tokens = np.diff(ends, prepend=0)
                lengths = [binary_lengths(n, longest) for n in tokens.tolist()]
                owner = np.repeat(np.arange(len(tokens)), [len(x) for x in lengths])
                length = np.array([n for x in lengths for n in x], np.int64)
                stop = np.cumsum(length)
                crc = [zlib.crc32(raw[4 * (b - n):4 * b]) for b, n in zip(stop.tolist(), length.tolist())]
                out = (pa.ListArray.from_arrays(pa.array(np.append(0, stop), pa.int32()), pa.array(ids, pa.int32()))
                       if with_ids else pa.nulls(len(length), pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.take(pa.array(pieces.rows[owner])),
                     pa.array(stop - length - (ends - tokens)[owner]), pa.array(length), pa.array(crc, pa.int64()),
                     pa.array(tokens[owner]), out],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    picked = docs.select(docs[id_col].alias("doc_id"), text_of(text_col).alias("text"))
    pieces = picked.mapInArrow(run, PIECES.format(id=dict(docs.dtypes)[id_col]))
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder per length: a reader takes batches of equal sequences from one folder."""
    pieces.write.partitionBy("length").parquet(path)
