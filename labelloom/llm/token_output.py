"""Token ids in binary blocks: tokenise, order, encode, write; read back and decode.

File format. A written table is a Parquet folder of rows (part, block, n_tokens, frame). Parts ascend with
the documents' order, blocks count from 0 in each part. A frame is

    4 bytes  "LTK1"
    5 x uint32  tokens in the block, payload bytes, documents that start in the block,
                CRC-32 of the block's ids (little-endian uint32), CRC-32 of everything behind the header
    per document  int64 id, int64 tokens (with the end id; negative for a null id, which is stored as 0)
    payload  (see ``token_codec``)

so each block can be checked and decoded alone, whatever container it lies in. Spark's own writer commits
the files, which makes a retried task harmless.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from labelloom.llm import token_codec
from labelloom.llm.common import give_back, tidied
from labelloom.scratch import new_path

MAGIC = b"LTK1"
_HEAD = "<5I"
_HEAD_BYTES = struct.calcsize(_HEAD)
#: Blocks that are coded in lockstep; bounds a worker's memory.
LANES = 512
#: Distinct pieces that a worker remembers with their ids; later ones are encoded whenever they come.
WORDS = 150_000
#: Pieces that the library encodes at once.
PIECES = 8192


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    new: list[str]

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.new.append(word)
        return at


class WordTokenizer:
    """Byte-level BPE by the tokenizers library, which is asked once per distinct piece of text.

    The library cuts a text into words before it merges bytes, and a space belongs to the word behind it. So a
    text may be cut in front of each space, except inside runs of white space; such texts are cut by the
    library's own pattern. The ids of a text are those of its pieces in a row. A text that holds the string of a
    special token is given to the library as a whole.
    """

    def __init__(self, path: str) -> None:
        self._library = Tokenizer.from_file(path)
        if self._library.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("ids are kept in 16 bits: the vocabulary may have 65,536 tokens at most")
        special = [t.content for t in self._library.get_added_tokens_decoder().values()]
        self._special = regex.compile("|".join(map(regex.escape, special))).search if special else lambda _: None
        self._pattern = regex.compile(public_tokenizers.PATTERN).findall
        self._runs = regex.compile(r"\s \s| $|  ").search
        self._number = _Numbers()
        self._first = np.zeros(1, np.int64)
        self._ids = np.zeros(0, np.uint16)

    def _pieces(self, text: str) -> list[str]:
        """Keys of the pieces; a key stands for itself behind a space, or behind a NUL for what follows the NUL."""
        if not text:
            return []
        if self._special(text):
            return ["\0" + text]
        if self._runs(text):
            return ["\0" + piece for piece in self._pattern(text)]
        pieces = text.split(" ")
        if pieces[0]:
            pieces[0] = "\0" + pieces[0]
            return pieces
        return pieces[1:]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and the number of ids of each."""
        numbers = self._number
        numbers.new = new = []
        number = numbers.__getitem__
        at, counts = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            pieces = self._pieces(text)
            counts[i] = len(pieces)
            at.append(np.fromiter(map(number, pieces), np.int32, len(pieces)))
        if new:
            plain = [w[1:] if w[:1] == "\0" else " " + w for w in new]
            found = []
            for k in range(0, len(plain), PIECES):
                found += [e.ids for e in self._library.encode_batch_fast(plain[k : k + PIECES], add_special_tokens=False)]
            ends = np.cumsum(np.array([len(f) for f in found], np.int64)) + self._ids.size
            self._first = np.r_[self._first, ends]
            self._ids = np.r_[self._ids, np.array([i for f in found for i in f], np.uint16)]
        flat = np.concatenate([*at, np.zeros(0, np.int32)])
        first = self._first[flat]
        sizes = self._first[flat + 1] - first
        run = np.cumsum(sizes)
        ids = self._ids[np.repeat(first - (run - sizes), sizes) + np.arange(run[-1] if run.size else 0)]
        if len(numbers) > WORDS:  # the memory is full: forget what these texts have added
            for word in new:
                del numbers[word]
            self._first, self._ids = self._first[: len(numbers) + 1], self._ids[: self._first[len(numbers)]]
        return ids, np.diff(np.r_[0, run][np.r_[0, np.cumsum(counts)]])


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this worker process; tasks that run in it one after another share its pieces."""
    if path not in _tokenizers:
        # Spark's tasks fill the cores; threads of the library would only hold memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def _slices(texts: list[str], size: int = 1 << 20) -> Iterator[list[str]]:
    """Consecutive texts of about ``size`` characters together."""
    held, n = [], 0
    for t in texts:
        held.append(t)
        n += len(t)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def _frame(ids: np.ndarray, payload: bytes, doc_ids: np.ndarray, doc_sizes: np.ndarray) -> bytes:
    body = np.stack([doc_ids, doc_sizes], axis=1).astype("<i8").tobytes() + payload
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    return MAGIC + struct.pack(_HEAD, ids.size, len(payload), doc_ids.size, crc, zlib.crc32(body)) + body


def _parse(frame: bytes) -> tuple[int, bytes, np.ndarray, int]:
    """Tokens, payload, (id, size) of the documents that start here, checksum of the ids."""
    if frame[:4] != MAGIC:
        raise ValueError("not a token block")
    n, size, docs, crc, body_crc = struct.unpack_from(_HEAD, frame, 4)
    body = frame[4 + _HEAD_BYTES :]
    if len(body) != 16 * docs + size or zlib.crc32(body) != body_crc:
        raise ValueError("damaged token block")
    return n, body[16 * docs :], np.frombuffer(body, "<i8", 2 * docs).reshape(-1, 2), crc


def write_tokens(
    ordered: DataFrame, path: str, vocabulary: str, text: str = "text", key: str = "doc_id", end_id: int = 0,
) -> None:
    """Write the token ids of ``ordered``, whose partitions and rows within them are in output order.

    Each text is followed by ``end_id``; null and empty texts give that id alone. Keys may repeat and be null. An
    empty table is written as a folder without rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        tokenize = tokenizer(vocabulary)
        block_no = 0
        ids, keys, sizes = [np.zeros(0, np.uint16)], [], []  # of documents that start in ids
        signs = []  # -1 for a null key
        waiting = 0

        def blocks(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids, keys, sizes, signs, waiting, block_no
            stream = np.concatenate(ids)
            ids = []
            doc_ids, doc_sizes = np.concatenate([*keys, np.zeros(0, np.int64)]), np.concatenate([*sizes, np.zeros(0, np.int64)])
            doc_signs = np.concatenate([*signs, np.zeros(0, np.int64)])
            starts = carried + np.cumsum(doc_sizes) - doc_sizes
            whole = stream.size if last else stream.size // token_codec.BLOCK * token_codec.BLOCK
            cut = token_codec.cut_blocks(stream[:whole])
            at = 0
            for k in range(0, len(cut), LANES):
                group = cut[k : k + LANES]
                frames = []
                for block, payload in zip(group, token_codec.encode(group), strict=True):
                    here = slice(*np.searchsorted(starts, [at, at + block.size]))
                    frames.append(_frame(block, payload, doc_ids[here], doc_sizes[here] * doc_signs[here]))
                    at += block.size
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(group), pa.int32()), pa.array(range(block_no, block_no + len(group)), pa.int64()),
                        pa.array([b.size for b in group], pa.int64()), pa.array(frames, pa.binary()),
                    ],
                    names=["part", "block", "n_tokens", "frame"],
                )
                block_no += len(group)
            later = np.searchsorted(starts, whole)
            ids, keys, sizes, signs = [stream[whole:]], [doc_ids[later:]], [doc_sizes[later:]], [doc_signs[later:]]
            waiting = stream.size - whole

        carried = 0  # waiting ids that belong to a document which started in a written block
        for batch in batches:
            keys.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False))
            signs.append(np.where(batch.column(0).is_valid().to_numpy(zero_copy_only=False), 1, -1))
            for texts in _slices([t or "" for t in batch.column(1).to_pylist()]):
                got, n = tokenize(texts)
                ids.append(np.insert(got, np.cumsum(n), np.uint16(end_id)))
                sizes.append(n + 1)
                waiting += got.size + n.size
            if waiting >= LANES * token_codec.BLOCK:
                yield from blocks(False)
                give_back()
                carried = waiting - int(sum(s.sum() for s in sizes))
        if waiting:
            yield from blocks(True)

    rows = ordered.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    rows.mapInArrow(tidied(run), "part int, block long, n_tokens long, frame binary").write.parquet(path)


def read_tokens(spark: SparkSession, path: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32[, ids]) of every document in a written folder, decoded and checked.

    ``start`` counts the ids of all documents before it.
    """
    frames = spark.read.schema("part int, block long, n_tokens long, frame binary").parquet(path)
    totals = frames.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    starts = totals.select(
        "part", (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before")
    )
    parts = totals.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[tuple[int | None, int]] = []  # begun, not ended
        open_crc = done = 0
        offset, current = 0, None

        def decoded(rows: list[tuple[int, bytes]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            parsed = [_parse(f) for _, f in rows]
            for (part, _), (_, _, starting, crc), ids in zip(
                rows, parsed, token_codec.decode([p[1] for p in parsed], [p[0] for p in parsed]), strict=True
            ):
                if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
                    raise ValueError("a token block does not match its checksum")
                yield part, starting, ids

        held_ids: list[np.ndarray] = []
        for rows in _grouped(batches):
            out: list[tuple] = []
            for part, starting, ids in decoded(rows):
                if part != current:
                    if docs:
                        raise ValueError("a document has no end")
                    current, offset = part, 0
                docs += [(doc, size) if size > 0 else (None, -size) for doc, size in starting.tolist()]
                at = 0
                while docs and at < ids.size:
                    doc, size = docs[0]
                    piece = ids[at : at + size - done]
                    open_crc = zlib.crc32(piece.astype("<u4").tobytes(), open_crc)
                    if with_ids:
                        held_ids.append(piece)
                    at, done = at + piece.size, done + piece.size
                    if done == size:
                        out.append((part, doc, offset, size, open_crc, np.concatenate(held_ids).tolist() if with_ids else None))
                        offset, open_crc, done = offset + size, 0, 0
                        held_ids = []
                        docs.pop(0)
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["part", "key", "at", "n_tokens", "crc", "ids"]
            )

    rows = (
        frames.select("part", "block", "frame").repartitionByRange(max(1, parts), "part").sortWithinPartitions("part", "block")
        .mapInArrow(tidied(run), "part int, key long, at long, n_tokens long, crc long, ids array<int>")
    )
    return rows.join(starts, "part").select(
        F.col("key").alias(key), (F.col("before") + F.col("at")).alias("start"), "n_tokens", F.col("crc").alias("ids_crc32"),
        *(["ids"] if with_ids else []),
    )


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, bytes]]]:
    held: list[tuple[int, bytes]] = []
    for batch in batches:
        for part, frame in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            held.append((part, frame))
            if len(held) == LANES:
                yield held
                held = []
    if held:
        yield held


def by_key(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Partitions and rows in ascending order of the key; equal keys in the order of their texts' hash."""
    return docs.select(key, text).repartitionByRange(key).sortWithinPartitions(key, F.xxhash64(text), text)


def token_table(
    ordered: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", end_id: int = 0, with_ids: bool = False,
) -> DataFrame:
    """Write ``ordered`` to a new folder of the shared directory and read every document back."""
    path = new_path(ordered.sparkSession, "tokens")
    write_tokens(ordered, path, vocabulary, text, key, end_id)
    return read_tokens(ordered.sparkSession, path, key, with_ids)
