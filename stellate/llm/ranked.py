"""Token-id files: frequency-ranked ids in byte-aligned codes with separate control bytes.

Method. Texts are encoded, and the ids counted over all documents. The most frequent id
gets rank 0, the next rank 1, and so on; a rank is written in one to four bytes. Two bits
for each rank, four ranks to a control byte, say how many; control and data bytes are kept
apart, so a block is decoded in numpy: a table gives the lengths of a control byte's four
codes, their running sum the places of all data bytes.

File format. A Parquet table of blocks in ascending order of ``doc_id``: ``part`` and
``block`` (their place), ``first`` (ids before the block in its part), ``doc_ids``,
``lengths`` (ids of each document), ``control``, ``data``; beside it a table ``rank, id``.

Scale. Ids, not texts, are sorted: one range shuffle of two bytes an id, by ``doc_id``, then
a hash of the ids and the row's place, so that a third of all rows under one ``doc_id``, or
equal in id and text, still spread over many parts. The driver holds
the rank table (the vocabulary's size) and one number for each part.

Edge cases: a null or empty text is its end id alone; null ``doc_id`` first; rows that
repeat a ``doc_id`` follow each other in the order of a hash of their ids; a very long text is
a block of its own; an empty table gives empty files; other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.llm.bpe import byte_alphabet
from stellate.llm.common import discard, lists, slices, staged, text_input
from stellate.session import scratch_path

BLOCK_IDS = 1 << 16
#: Distinct pieces kept by a Python worker between batches.
CACHED = 800_000
#: Lengths of the four codes of each control byte.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes."""
    ranks = ranks.astype("<u4")
    length = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = length - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    widest = int(length.max(initial=1))
    data = ranks.view(np.uint8).reshape(-1, 4)[:, :widest][np.arange(widest) < length[:, None]]
    return control.tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    length = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n].astype(np.int64)
    source = np.frombuffer(data, np.uint8)
    start = np.cumsum(length) - length
    out = source[start].astype(np.uint32)
    for k in range(1, int(length.max(initial=1))):
        has = np.flatnonzero(length > k)
        out[has] |= source[start[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


class PieceIds(dict):
    """The ids of pieces between white space, as bytes, kept once computed."""

    #: Fixed value: the pattern that cuts a piece of this vocabulary into words.
    WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, tokenize, code: str):
        self.tokenize, self.code, self.chars = tokenize, code, byte_alphabet()

    def __missing__(self, piece: str) -> bytes:
        if piece.isalpha():
            ids = self.merged(piece)
        elif piece[:-1].isalpha() and not piece[-1].isalnum():  # a word and one sign after it
            ids = self[piece[:-1]] + self[piece[-1]]
        else:
            ids = b"".join(map(self.merged, self.WORDS.findall(piece)))
        self[piece] = ids
        return ids

    def merged(self, word: str) -> bytes:
        return array(self.code, [t.id for t in self.tokenize(word.encode().decode("latin-1").translate(self.chars))]).tobytes()


class WordEncoder:
    """Ids of whole texts, as the library gives them, with a cache of distinct pieces.

    In this vocabulary no token spans white space, so the ids of a text are those of its
    pieces between white space, and the library's merge model is asked for new pieces only.
    That holds for texts whose characters Python and the library lower and class alike; any
    other text (``OTHER``, special tokens) goes to the library whole.
    """

    OTHER = regex.compile("[^\x00-\x1b\x20-\u024f]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.code = "H" if self.library.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.code == "H" else "<u4")
        self.model = self.library.model
        self.forget()

    def forget(self) -> None:
        self.pieces = PieceIds(self.model.tokenize, self.code)

    def plain(self, text: str) -> bool:
        try:  # most texts, at the speed of a copy
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return self.OTHER.search(text) is None
        return len(raw.translate(None, b"\x1c\x1d\x1e\x1f")) == len(raw)

    def encode(self, text: str) -> bytes:
        if self.plain(text) and not any(s in text for s in self.special):
            return b"".join(map(self.pieces.__getitem__, text.lower().split()))
        return array(self.code, self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        if len(self.pieces) > CACHED:
            self.forget()
        return [self.encode(t) for t in texts]


@lru_cache(maxsize=4)
def load(path: str) -> WordEncoder:
    return WordEncoder(path)


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path)
        end = array(encoder.code, [end_id]).tobytes()
        for batch in slices(batches):
            ids = [x + end for x in encoder.encode_batch([t or "" for t in batch.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return run


def _count(dtype: np.dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in slices(batches, 0):
            seen = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype))
            total = np.pad(total, (0, max(0, len(seen) - len(total))))
            total[: len(seen)] += seen
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array(total[used])], names=["id", "n"])

    return run


def _write(dtype: np.dtype, rank: np.ndarray):
    """Blocks of one part, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, first = TaskContext.get().partitionId(), 0, 0
        for batch in slices(batches, 1, BLOCK_IDS * dtype.itemsize):
            ids = [np.frombuffer(x, dtype) for x in batch.column(1).to_pylist()]
            lengths = [len(x) for x in ids]
            control, data = encode_ranks(rank[np.concatenate(ids)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([block], pa.int64()), pa.array([first], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), batch.column(0)), lists(np.array(lengths, np.int32), [len(ids)]),
                    pa.array([control], pa.binary()), pa.array([data], pa.binary()),
                ],
                names=["part", "block", "first", "doc_ids", "lengths", "control", "data"],
            )
            block, first = block + 1, first + sum(lengths)

    return run


def write_ids(docs: DataFrame, vocabulary: str, path: str, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Write the ids of all documents, in ascending ``doc_id`` order, to ``path``."""
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    source = text_input(docs, F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    dtype = load(vocabulary).dtype
    encoded = source.mapInArrow(_encode(vocabulary, end_id), f"doc_id {kind}, ids binary")
    encoded = staged(encoded.select("*", F.xxhash64("ids").alias("mark"), F.monotonically_increasing_id().alias("place")), "ids-encoded")
    counts = encoded.select("ids").mapInArrow(_count(dtype), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()  # the vocabulary's size
    order = sorted(counts, key=lambda r: (-r["n"], r["id"]))
    size = max([r["id"] for r in order], default=0) + 1
    rank = np.zeros(size, np.uint32)
    rank[[r["id"] for r in order]] = np.arange(len(order), dtype=np.uint32)
    spark.createDataFrame([(i, r["id"]) for i, r in enumerate(order)], "rank int, id bigint").write.parquet(f"{path}/ranks")
    in_order = encoded.repartitionByRange("doc_id", "mark", "place").sortWithinPartitions("doc_id", "mark", "place").select("doc_id", "ids")
    schema = f"part int, block bigint, first bigint, doc_ids array<{kind}>, lengths array<int>, control binary, data binary"
    in_order.mapInArrow(_write(dtype, rank), schema).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    discard(encoded)


def _read(ids_by_rank: np.ndarray, before: dict[int, int], with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, firsts, controls, datas = (batch.column(i).to_pylist() for i in (0, 1, 4, 5))
            for i in range(batch.num_rows):
                length = np.asarray(batch.column(3)[i].values, np.int64)
                ids = ids_by_rank[decode_ranks(controls[i], datas[i], int(length.sum()))]
                ends = np.cumsum(length)
                starts = ends - length
                columns = [
                    batch.column(2)[i].values, pa.array(starts + firsts[i] + before[parts[i]]), pa.array(length),
                    pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)], pa.int64()),
                ]
                if with_ids:
                    columns.append(lists(ids.astype(np.int32), length))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    return run


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document, from the files: ``doc_id, start, n_tokens, ids_crc32`` (and ``ids``)."""
    blocks = spark.read.parquet(f"{path}/blocks")
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    ids_by_rank = np.array([r["id"] for r in ranks], "<u4")
    sizes = blocks.select("part", F.expr("aggregate(lengths, 0L, (s, x) -> s + x)").alias("n")).groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    before, total = {}, 0
    for r in sizes:  # one number for each part
        before[r["part"]], total = total, total + r["n"]
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return text_input(blocks, "part", "first", "doc_ids", "lengths", "control", "data").mapInArrow(_read(ids_by_rank, before, with_ids), schema)


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 1) -> DataFrame:
    """Write to a fresh folder of the shared checkpoint folder, and read back."""
    path = scratch_path(docs.sparkSession, "token-ids")
    write_ids(docs, vocabulary, path, end_id)
    return read_ids(docs.sparkSession, path)
