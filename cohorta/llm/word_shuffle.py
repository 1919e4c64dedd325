"""Byte-level BPE by a global shuffle of distinct words, and decoding by the token-byte table.

Texts are cut into chunks of words in order. A chunk keeps the position of every word and sends each
of its distinct words to the word's owner, which encodes every word once, whichever chunks it comes
from, and sends the ids back. Chunks then put the ids together by position.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.llm.bpe import Bpe, PairTable, ragged
from cohorta.llm.common import text_of, travels
from cohorta.llm.pieces import BYTES, Pieces, utf8_of
from cohorta.session import materialise

travels(__name__)

OWNER_BYTES = 32_000_000  # text behind the words of one owner
CHUNK_BYTES = 16_000_000  # text whose distinct words travel together
PRESS_LEVEL = 9


def token_ranks(ranks: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}


class RankBpe(Bpe):
    """Byte pairs merged by ranks: of all neighbours whose joined bytes are a token the one of least
    rank, leftmost first. ``ranks`` is the text of a file with a base64 token and its rank per line."""

    def __init__(self, ranks: bytes):
        tokens = token_ranks(ranks)
        self.suffix = ""
        self.byte_ids = np.array([tokens[bytes([b])] for b in range(256)], np.int32)
        pairs = [(tokens[t[:k]], tokens[t[k:]], n) for t, n in tokens.items() for k in range(1, len(t))
                 if t[:k] in tokens and t[k:] in tokens]
        self.left, self.right, made = np.array(pairs, np.int32).reshape(-1, 3).T
        # The number of a pair is the rank of what it makes, so pairs that make the same are alike.
        self.made = np.arange(max(tokens.values()) + 1, dtype=np.int32)
        self.ranks = PairTable(self.left, self.right, made)
        self._rank_of = {(a, b): n for a, b, n in pairs}


def token_table(spark: SparkSession, ranks: bytes) -> DataFrame:
    """id and bytes of every token, as many rows as the vocabulary has."""
    rows = [(n, t) for t, n in token_ranks(ranks).items()]
    return spark.createDataFrame(rows, "id int, bytes binary")


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2 ** 32, small ones often. Below 192 one byte says it all; below 192 + 62 * 256
    it has the high part, and a second one follows in a stream of its own; all others have four more."""
    numbers = numbers.astype(np.int64)
    rest = numbers - 192
    two, more = (rest >= 0) & (rest < 62 * 256), rest >= 62 * 256
    first = np.where(more, 254, np.where(two, 192 + (rest >> 8), numbers)).astype(np.uint8)
    low = (rest[two] & 255).astype(np.uint8)
    high = (rest[more] - 62 * 256).astype("<u4").view(np.uint8).reshape(-1, 4).T
    data = first.tobytes() + low.tobytes() + np.ascontiguousarray(high).tobytes()
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=PRESS_LEVEL).compress(data, asbytes=True)


def _numbers(packed: bytes, n: int) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    data = np.frombuffer(pa.Codec("zstd").decompress(packed[8:], size, asbytes=True) if size else b"", np.uint8)
    out = data[:n].astype(np.int64)
    two, more = np.flatnonzero((out >= 192) & (out < 254)), np.flatnonzero(out == 254)
    out[two] = 192 + (out[two] - 192 << 8) + data[n:n + len(two)]
    high = np.ascontiguousarray(data[n + len(two):].reshape(4, len(more)).T)
    out[more] = 192 + 62 * 256 + high.view("<u4").reshape(-1)
    return out


def _owners(words: pa.StringArray, owners: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) for w in words.cast(pa.binary()).to_pylist()), np.int64, len(words)) % owners


class _Chunk:
    """Texts of about ``CHUNK_BYTES`` while they are read."""

    def __init__(self):
        self.entries: list[pa.StringArray] = []
        self.numbers: list[np.ndarray] = []
        self.ids: list[pa.Array] = []
        self.counts: list[np.ndarray] = []
        self.size = self.held = 0

    def add(self, pieces: Pieces, ids: pa.Array, size: int) -> None:
        self.entries.append(pieces.entries)
        self.numbers.append(pieces.numbers + self.held)
        self.held += len(pieces.entries)
        self.ids.append(ids)
        self.counts.append(pieces.counts)
        self.size += size

    def rows(self, name: int, owners: int) -> pa.RecordBatch:
        """Words are numbered from the most frequent on; those of an owner travel in that order."""
        coded = pa.concat_arrays(self.entries).dictionary_encode()
        number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[np.concatenate(self.numbers)]
        often = np.argsort(-np.bincount(number, minlength=len(coded.dictionary)), kind="stable")
        rank = np.empty(len(often), np.int64)
        rank[often] = np.arange(len(often))
        words = coded.dictionary.take(pa.array(often))
        owner = _owners(words, owners)
        flat, lengths = utf8_of(words)
        starts = np.cumsum(lengths) - lengths
        out: list[tuple] = [(-1, name, len(number), _packed(owner), _packed(rank[number]), len(owner))]
        for k in np.unique(owner).tolist():
            some = np.flatnonzero(owner == k)
            data = ragged(flat, starts[some], lengths[some])
            out.append((k, name, len(some), _packed(lengths[some]), bz2.compress(data.tobytes()), len(data)))
        ids, counts = pa.concat_arrays(self.ids), pa.array(np.concatenate(self.counts))
        ends = pa.array([0] + [len(ids)] * len(out), pa.int32())  # only the first row has them
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [*[pa.array(c, k) for c, k in zip(zip(*out), kinds)], pa.ListArray.from_arrays(ends, ids),
             pa.ListArray.from_arrays(ends, counts)],
            names=["owner", "chunk", "n", "sizes", "data", "size", "ids", "counts"])


_CUT = "owner long, chunk long, n long, sizes binary, data binary, size long, ids {id}, counts array<long>"


def chunk_words(docs: DataFrame, owners: int, id_col: str, text_col: str) -> DataFrame:
    """Rows of chunks, written once: one (owner -1) with the documents' ids and numbers of words, the
    number of the word at every position and the owners of the words, and one per owner with the
    chunk's distinct words that it has.
    """
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, chunk = TaskContext.get().partitionId(), 0, _Chunk()
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
            for pieces in BYTES.batch(batch.column(1), None):
                chunk.add(pieces, batch.column(0).take(pa.array(pieces.rows)), int(sizes[pieces.rows].sum()))
                if chunk.size >= CHUNK_BYTES:
                    yield chunk.rows(part << 32 | made, owners)
                    made, chunk = made + 1, _Chunk()
        if chunk.ids:
            yield chunk.rows(part << 32 | made, owners)

    picked = docs.select(docs[id_col].alias("doc_id"), text_of(text_col).alias("text"))
    return materialise(picked.mapInArrow(run, _CUT.format(id=f"array<{id_type}>")))


_CODED = "owner long, chunk long, n long, counts binary, codes binary, size long"


def encode_words(chunks: DataFrame, ranks: bytes) -> DataFrame:
    """The ids of every chunk's words, in the order of the chunk's words at one owner.

    An owner encodes each distinct word once. It holds the words that all chunks sent it.
    """
    shared = chunks.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary: a few MB
    kept: dict = {}  # made once per task

    def run(table: pa.Table) -> pa.Table:
        if not kept:
            kept["bpe"] = RankBpe(shared.value)
        flat, lengths = [], []
        for n, sizes, data in zip(*[table.column(c).to_pylist() for c in ("n", "sizes", "data")]):
            lengths.append(_numbers(sizes, n))
            flat.append(bz2.decompress(data))
        counts = [len(x) for x in lengths]
        offsets = np.concatenate(([0], np.cumsum(np.concatenate(lengths)))).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [
            None, pa.py_buffer(offsets), pa.py_buffer(b"".join(flat))]).dictionary_encode()
        entries = words.dictionary
        ends = np.frombuffer(entries.buffers()[1], np.int64)[entries.offset:entries.offset + len(entries) + 1]
        every = np.frombuffer(entries.buffers()[2], np.uint8)[ends[0]:ends[-1]]
        ids, n_ids = kept["bpe"].encode(every, np.diff(ends))
        first = np.cumsum(n_ids) - n_ids
        rows, at = [], 0
        number = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        for n in counts:
            mine = number[at:at + n]
            codes = ragged(ids, first[mine], n_ids[mine])
            rows.append((_packed(n_ids[mine]), _packed(codes), len(codes)))
            at += n
        pressed, codes, size = zip(*rows)
        return pa.table({"owner": table.column("owner"), "chunk": table.column("chunk"), "n": table.column("n"),
                         "counts": pa.array(pressed, pa.binary()), "codes": pa.array(codes, pa.binary()),
                         "size": pa.array(size, pa.int64())})

    sent = chunks.filter("owner >= 0").select("owner", "chunk", "n", "sizes", "data")
    return sent.groupBy("owner").applyInArrow(run, _CODED)


CODES = "doc_id {id}, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>, decoded binary"


def encode_decode(docs: DataFrame, ranks_file: str, id_col: str = "doc_id", text_col: str = "text",
                  owner_bytes: int = OWNER_BYTES, with_codes: bool = False) -> DataFrame:
    """One row per input row: its tokens, checksums of the ids (decimal, joined by one space) and of the
    bytes they decode to, and on request both themselves.

    Special strings in a text are ordinary text. Null and empty texts have no ids. Repeated rows are
    encoded each; an empty table gives no rows. A chunk is about 16 MB of text, or one longer text.
    """
    with open(ranks_file, "rb") as file:
        ranks = file.read()
    id_type = dict(docs.dtypes)[id_col]
    total = docs.agg(F.sum(F.octet_length(text_of(text_col)))).first()[0] or 0
    chunks = chunk_words(docs, max(total // owner_bytes, 16), id_col, text_col)
    coded = encode_words(chunks, ranks)
    # What each id decodes to is joined in the tasks: the table has the size of the vocabulary.
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    tables: dict = {}  # made once per task

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not tables:
            tokens = {n: t for t, n in token_ranks(shared.value).items()}
            tables["letters"] = [tokens.get(n, b"") for n in range(max(tokens) + 1)]
            tables["decimal"] = [str(n) for n in range(max(tokens) + 1)]
        letters, decimal = tables["letters"], tables["decimal"]
        rows = sorted(zip(*[right.column(c).to_pylist() for c in ("owner", "n", "counts", "codes", "size")]))
        by_owner = np.concatenate([np.zeros(0, np.int64), *[_numbers(c, n) for _, n, c, _, _ in rows]])
        codes = np.concatenate([np.zeros(0, np.int64), *[_numbers(c, size) for _, _, _, c, size in rows]])
        out: list[tuple] = []
        kept = []
        for head in left.to_pylist()[:1]:  # a chunk has one row of positions
            order = np.argsort(_numbers(head["sizes"], head["size"]), kind="stable")  # words by owner
            counts, first = np.empty_like(by_owner), np.empty_like(by_owner)
            counts[order], first[order] = by_owner, np.cumsum(by_owner) - by_owner
            number = _numbers(head["data"], head["n"])
            at = 0
            for m in head["counts"]:
                mine = number[at:at + m]
                found = ragged(codes, first[mine], counts[mine]).tolist()
                decoded = b"".join([letters[c] for c in found])
                out.append((len(found), hashlib.sha256(" ".join([decimal[c] for c in found]).encode()).hexdigest(),
                            hashlib.sha256(decoded).hexdigest(), found if with_codes else None,
                            decoded if with_codes else None))
                at += m
            kept.append(left.column("ids").combine_chunks().flatten())
        kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.binary()]
        names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
        columns = {name: pa.array(c, k) for name, c, k in zip(names, zip(*out), kinds)} if out else {
            name: pa.array([], k) for name, k in zip(names, kinds)}
        return pa.table({"doc_id": pa.concat_arrays(kept) if kept else pa.array([], left.schema.field("ids").type.value_type)} | columns)

    positions = chunks.filter("owner < 0").select("chunk", "n", "sizes", "data", "size", "ids", "counts")
    back = coded.select(F.col("chunk").alias("c"), "owner", "n", "counts", "codes", "size")
    return positions.groupBy("chunk").cogroup(back.groupBy("c")).applyInArrow(run, CODES.format(id=id_type))


def decode(coded: DataFrame, table: DataFrame, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and decoded (bytes) of rows with arrays of ids: every position is joined with the token-byte
    table (``token_table``) and the bytes are put together by position. Null arrays decode to nothing;
    an id that is not in the table is an error. Every row must have an id of its own.
    """
    placed = coded.select(F.col(id_col).alias("doc_id"), F.posexplode_outer(ids_col).alias("at", "id"))
    joined = placed.join(F.broadcast(table), "id", "left")  # as large as the vocabulary
    known = F.when(F.col("id").isNull() | F.col("bytes").isNotNull(), F.coalesce("bytes", F.lit(b""))).otherwise(
        F.raise_error(F.lit("an id is not in the token table")))
    parts = joined.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("at", known.alias("b")))).alias("parts"))
    return parts.select("doc_id", F.aggregate("parts", F.lit(b""), lambda s, p: F.concat(s, p["b"])).alias("decoded"))
