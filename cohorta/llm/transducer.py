"""BPE encoding by a minimal acyclic transducer of frequent words, and decoding.

The transducer shares prefixes and suffixes; the outputs on a word's path add up to the word's
number, which leads to its ids. It is one file of flat arrays that every task maps into memory.
Words that it does not hold are merged exactly.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.llm.bpe import NONE, Bpe, PairTable, ragged
from cohorta.llm.common import text_of, travels
from cohorta.llm.pieces import BYTES, ids_of, special_pattern
from cohorta.session import materialise, scratch_path, shared_dir

travels(__name__)

MOST_WORDS = 250_000  # a lexicon word has at least this share (1 / MOST_WORDS) of all pieces


def minimal_automaton(words: list[bytes]) -> tuple[list[dict[int, int]], list[bool]]:
    """States (byte -> state) and whether they accept, from sorted different words; the root is last.

    Words are added in order; what a new word no longer shares with the one before is finished from
    its end on, and a finished state that equals an earlier one (same acceptance, same targets) is
    replaced by it.
    """
    states: list[dict[int, int]] = []
    accepts: list[bool] = []
    known: dict[tuple, int] = {}

    def finish(node: list) -> int:
        key = (node[0], tuple(node[1].items()))
        if key not in known:
            known[key] = len(states)
            states.append(node[1])
            accepts.append(node[0])
        return known[key]

    path: list[list] = [[False, {}]]  # nodes of the word added last: accepts, finished targets
    previous = b""
    for word in words:
        same = 0
        while same < min(len(word), len(previous)) and word[same] == previous[same]:
            same += 1
        for depth in range(len(previous), same, -1):
            path[depth - 1][1][previous[depth - 1]] = finish(path.pop())
        path += [[False, {}] for _ in range(len(word) - same)]
        path[-1][0] = True
        previous = word
    for depth in range(len(previous), 0, -1):
        path[depth - 1][1][previous[depth - 1]] = finish(path.pop())
    states.append(path[0][1])
    accepts.append(path[0][0])
    return states, accepts


class Lexicon:
    """The arrays of a transducer file."""

    FIELDS = ("keys", "edges", "targets", "outputs", "accepts", "starts", "ids", "root")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)
        self.table = PairTable.__new__(PairTable)
        self.table.keys, self.table.values = arrays["keys"], arrays["edges"]
        self.table.bits = len(arrays["keys"]).bit_length() - 1

    @classmethod
    def build(cls, words: list[bytes], bpe: Bpe) -> dict[str, np.ndarray]:
        words = sorted(set(words))
        states, accepts = minimal_automaton(words)
        below = [0] * len(states)  # words that end at or after a state
        source, letter, target, output = [], [], [], []
        for s, (edges, ends) in enumerate(zip(states, accepts)):  # targets come before their sources
            below[s] = int(ends)
            for b, t in sorted(edges.items()):
                source.append(s)
                letter.append(b)
                target.append(t)
                output.append(below[s])
                below[s] += below[t]
        table = PairTable(np.array(source, np.int64), np.array(letter, np.int64), np.arange(len(source), dtype=np.int32),
                          room=2)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ids, counts = bpe.encode(np.frombuffer(b"".join(words), np.uint8), lengths)
        return {"keys": table.keys, "edges": table.values, "targets": np.array(target, np.int32),
                "outputs": np.array(output, np.int32), "accepts": np.array(accepts, np.uint8),
                "starts": np.concatenate(([0], np.cumsum(counts), [len(ids)])).astype(np.int64), "ids": ids.astype(np.int32),
                "root": np.array([len(states) - 1], np.int64)}

    @staticmethod
    def to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
        head, at, parts = {}, 0, []
        for name in Lexicon.FIELDS:
            data = arrays[name].tobytes()
            head[name] = (str(arrays[name].dtype), at, len(arrays[name]))
            parts.append(data + b"\0" * (-len(data) % 8))
            at += len(parts[-1])
        first = json.dumps(head).encode()
        first += b" " * (-(len(first) + 8) % 8)
        return len(first).to_bytes(8, "little") + first + b"".join(parts)

    @classmethod
    def open(cls, path: str) -> Lexicon:
        """Map the file: tasks on one machine share its pages."""
        data = np.memmap(path, np.uint8, "r")
        size = int.from_bytes(data[:8].tobytes(), "little")
        head, start = json.loads(data[8:8 + size].tobytes()), 8 + size
        return cls({name: data[start + at:start + at + n * np.dtype(kind).itemsize].view(kind)
                    for name, (kind, at, n) in head.items()})

    def numbers(self, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for unknown ones. All words walk side by side."""
        found = np.zeros(len(lengths), np.int64)
        state = np.full(len(lengths), self.root[0], np.int64)
        starts = np.cumsum(lengths) - lengths
        walking, depth = np.arange(len(lengths)), 0
        while len(walking):
            edge = self.table.get(state[walking], flat[starts[walking] + depth])
            missing = edge == NONE
            found[walking[missing]] = -1
            walking, edge = walking[~missing], edge[~missing]
            state[walking] = self.targets[edge]
            found[walking] += self.outputs[edge]
            depth += 1
            walking = walking[lengths[walking] > depth]
        found[(found >= 0) & (self.accepts[state] == 0)] = -1
        return found

    def encode(self, bpe: Bpe, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words and their numbers: known ones from the file, the others merged."""
        found = self.numbers(flat, lengths)
        unseen = np.flatnonzero(found < 0)
        starts = np.cumsum(lengths) - lengths
        merged, merged_counts = bpe.encode(ragged(flat, starts[unseen], lengths[unseen]), lengths[unseen])
        known = np.maximum(found, 0)
        from_, counts = self.starts[known], self.starts[known + 1] - self.starts[known]
        both = np.concatenate((self.ids, merged))
        from_[unseen] = len(self.ids) + np.cumsum(merged_counts) - merged_counts
        counts[unseen] = merged_counts
        return ragged(both, from_, counts), counts


def piece_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All pieces of all texts with their counts; special strings are none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pieces in BYTES.batch(batch.column(0), None):
                n = np.bincount(pieces.numbers, minlength=len(pieces.entries))
                yield pa.RecordBatch.from_arrays([pieces.entries, pa.array(n)], names=["piece", "n"])

    parts = docs.select(text_of(text_col).alias("text")).mapInArrow(run, "piece string, n long")
    return parts.groupBy("piece").agg(F.sum("n").alias("n"))


def frequent_pieces(docs: DataFrame, text_col: str = "text", most: int = MOST_WORDS) -> list[str]:
    """Pieces with at least 1 / ``most`` of all occurrences; so there are at most ``most``."""
    counted = materialise(piece_counts(docs, text_col))
    total = counted.agg(F.sum("n")).first()[0] or 0
    return [r["piece"] for r in counted.filter(F.col("n") * F.lit(most) >= F.lit(total)).select("piece").collect()]


def ship_lexicon(spark: SparkSession, data: bytes) -> str:
    """Put the file in the shared folder and let Spark give every executor a copy. The file's name."""
    name = f"lexicon-{hashlib.sha256(data).hexdigest()[:16]}-{scratch_path(spark, 'x')[-8:]}.bin"
    path = f"{shared_dir(spark)}/{name}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(target)
    out.write(bytearray(data))
    out.close()
    spark.sparkContext.addFile(files.makeQualified(target).toString())
    return name


CODES = "doc_id {id}, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>, decoded string"


def token_bytes(bpe: Bpe) -> tuple[np.ndarray, np.ndarray]:
    """What each id decodes to, as one array of bytes, and where each id's bytes start (one more at the end)."""
    byte_of = {c: b for b, c in enumerate(bpe.letter_of)}
    size = max([*bpe.vocab.values(), *bpe.special.values()]) + 1
    parts = [b""] * size
    for token, number in bpe.vocab.items():
        parts[number] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    for token, number in bpe.special.items():
        parts[number] = token.encode()
    return np.frombuffer(b"".join(parts), np.uint8), np.append(0, np.cumsum([len(p) for p in parts]))


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                  most_words: int = MOST_WORDS, with_codes: bool = False) -> DataFrame:
    """One row per input row: tokens, checksums of the ids and of the decoded text, and both on request.

    The first pass counts all pieces of all texts; those frequent enough are compiled on the
    driver (their number is bounded) and mapped by every task. Which words the lexicon holds
    changes no result. Null and empty texts have no ids. Special strings in a text are their ids.
    Repeated rows are encoded each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    with open(tokenizer, "rb") as file:
        config = file.read()
    words = frequent_pieces(docs, text_col, most_words)
    name = ship_lexicon(spark, Lexicon.to_bytes(Lexicon.build(
        [w.encode("utf-8", "replace") for w in words if w], Bpe(config))))
    shared = spark.sparkContext.broadcast(config)  # a vocabulary: a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, lexicon = Bpe(shared.value), Lexicon.open(SparkFiles.get(name))
        special = special_pattern(bpe)
        letters, letter_starts = token_bytes(bpe)
        for batch in batches:
            for pieces in BYTES.batch(batch.column(1), special):
                rows = ids_of(pieces.entries, bpe, lambda flat, lengths: lexicon.encode(bpe, flat, lengths))
                ids = rows.take(pieces.numbers)
                upto = np.concatenate(([0], np.cumsum(rows.lengths[pieces.numbers])))
                stops = upto[np.cumsum(pieces.counts)]
                text = ragged(letters, letter_starts[ids], letter_starts[ids + 1] - letter_starts[ids]).tobytes()
                byte_stops = np.concatenate(([0], np.cumsum(letter_starts[ids + 1] - letter_starts[ids])))[stops]
                raw = memoryview(ids.astype("<u4").tobytes())
                tokens = np.diff(stops, prepend=0)
                shas, decoded = [], []
                for n, end, a, b in zip(tokens.tolist(), stops.tolist(), [0, *byte_stops.tolist()], byte_stops.tolist()):
                    shas.append(hashlib.sha256(raw[4 * (end - n):4 * end]).hexdigest())
                    decoded.append(text[a:b].decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(pieces.rows)), pa.array(tokens), pa.array(shas),
                     pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded]),
                     pa.ListArray.from_arrays(pa.array(np.append(0, stops), pa.int32()), pa.array(ids, pa.int32()))
                     if with_codes else pa.nulls(len(tokens), pa.list_(pa.int32())),
                     pa.array(decoded if with_codes else [None] * len(tokens), pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"])

    picked = docs.select(docs[id_col].alias("doc_id"), text_of(text_col).alias("text"))
    return picked.mapInArrow(run, CODES.format(id=dict(docs.dtypes)[id_col]))
