"""Repeated passages by MinHash banding of content-defined paragraphs.

1. A text's words are cut into paragraphs at words whose hash is the least within ``REACH`` words on either side.
   The cut depends on nearby words only, so a passage that stands in two documents is cut alike inside, wherever
   it begins and whatever its line breaks.
2. Each paragraph is a set of five-word shingles with a MinHash signature. Bands are tuned to the set's size for
   similarity 0.8: below four shingles only equal sets reach it (one band of the whole signature), up to ten there
   are two bands of one value, from eight on four bands of two. At 0.8 these find 96 and 98 of 100 pairs.
3. Band values that occur in one document only are dropped: each batch of texts sends its distinct values once, in
   compact slices per bucket of values, and gets back a bit for each.
4. Paragraphs that share a band value are joined; their exact Jaccard similarity decides. A group gives back a
   forest, and connected components are the clusters. Equal paragraphs are one class throughout.
5. In each cluster the first document keeps its occurrences, all others are removals.
6. Paragraphs lose a passage's ends and its edited words, so passages are also matched by windows of ``LEAST_WORDS``
   words. A window is looked at if its least ``GRAM`` words, a choice that depends on the window alone, stand in two
   documents. Equal windows are matched with the first document that has them, and a verification join of the two
   texts extends the match word by word to both sides, over edits as long as the Jaccard similarity suffices. Two
   passages of similarity 0.8 that begin and end alike share such a window: an edit costs each side four shingles,
   so below 32 common shingles there is none, and from there on some run has 20 words.
7. Pieces of both kinds are merged into spans, and spans of fewer than ``LEAST_WORDS`` words are not reported.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import cut, tidied, word_table
from labelloom.operators.graph import components
from labelloom.llm.verify import TILE, jaccard_forest
from labelloom.scratch import drop, parallelism

REACH = 4
SHINGLE = 5
SIMILARITY = 0.8
LEAST_WORDS = 15
VALUES = 8
GRAM = 8
#: Most words of an edit on either side that an extension steps over; ``SHINGLE`` equal words must follow.
GAP = 8
#: Bytes of text that are worked on at once, and that a bucket of hashes comes from on average.
BATCH = 4 << 20
BUCKET = 16 << 20
#: Grams in more batches are met by a join instead of inside a bucket.
HOT = 256
#: Numbers that are hashed at once.
STRETCH = 1 << 14
_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.array([0x9E3779B97F4A7C15 + 0x51ED270B35AD4E12 * i | 1 for i in range(VALUES)], dtype=object)
_ODD = np.array([int(x) & 0xFFFFFFFFFFFFFFFF for x in _ODD], np.uint64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_XXH = tuple(np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _mix(x: np.ndarray, factor: np.uint64 | None = None) -> np.ndarray:
    """A hash of each number (times ``factor``), in stretches that stay in a core's cache."""
    out = np.empty(x.size, np.uint64)
    room = np.empty(min(x.size, STRETCH), np.uint64)
    for at in range(0, x.size, STRETCH):
        y = out[at : at + STRETCH]
        high = room[: y.size]
        if factor is None:
            y[:] = x[at : at + STRETCH]
        else:
            np.multiply(x[at : at + STRETCH], factor, out=y)
        for _ in range(2):
            np.right_shift(y, np.uint64(32), out=high)
            np.bitwise_xor(y, high, out=y)
            np.multiply(y, _STEP, out=y)
        np.right_shift(y, np.uint64(32), out=high)
        np.bitwise_xor(y, high, out=y)
    return out


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def xxh64(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of many stretches of a byte buffer that goes on for eight bytes behind the last; one length at a time."""
    p1, p2, p3, p4, p5 = _XXH
    eight, four = (np.ndarray(data.size - n + 1, f"<u{n}", data, strides=(1,)) for n in (8, 4))
    out = np.empty(start.size, np.uint64)
    length = np.minimum(size, 32).astype(np.uint8)
    order = np.argsort(length, kind="stable")
    ends = np.cumsum(np.bincount(length, minlength=33))
    for n in range(32):
        who = order[ends[n - 1] if n else 0 : ends[n]]
        if not who.size:
            continue
        at, k = start[who], 0
        h = np.full(who.size, p5 + np.uint64(n))
        while k + 8 <= n:
            h = _turn(h ^ _turn(eight[at + k] * p2, 31) * p1, 27) * p1 + p4
            k += 8
        if k + 4 <= n:
            h = _turn(h ^ four[at + k].astype(np.uint64) * p1, 23) * p2 + p3
            k += 4
        while k < n:
            h = _turn(h ^ data[at + k].astype(np.uint64) * p5, 11) * p1
            k += 1
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        out[who] = h ^ (h >> np.uint64(32))
    for i in order[ends[31] :].tolist():
        out[i] = xxhash.xxh64_intdigest(data[start[i] : start[i] + size[i]].tobytes())
    return out


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (see ``common.word_bytes``) of all texts in a row, and how many each text has."""
    whole = b" ".join([b"", *[t or b"" for t in texts], b" " * 8]).translate(word_table())
    data = np.frombuffer(whole, np.uint8)
    inside = data != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edges[::2], edges[1::2]
    behind = np.cumsum([1, *[len(t or b"") + 1 for t in texts]])
    return xxh64(data, start, end - start), np.diff(np.searchsorted(start, behind))


def _expand(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Paragraphs:
    """The paragraphs of several texts: ``doc``, ``start`` and ``words`` per paragraph, its class and shingles."""

    def __init__(self, texts: list[bytes | None], reach: int = REACH) -> None:
        h, sizes = word_hashes(texts)
        doc = np.repeat(np.arange(sizes.size), sizes)
        begin = np.cumsum(sizes) - sizes
        place = np.arange(h.size) - begin[doc]
        # A gap of maxima between texts keeps one text's words out of another's cuts.
        wide = np.full(h.size + reach * (sizes.size + 1), _MAX)
        at = np.arange(h.size) + reach * (doc + 1)
        if h.size:
            pair = _mix(h * _ODD[0] + np.r_[h[1:], 0].astype(np.uint64))
            pair[place == sizes[doc] - 1] = _MAX
            wide[at] = pair
        least = place == 0
        inner = np.ones(h.size, bool)
        for k in range(1, reach + 1):
            inner &= wide[at] < wide[at - k]
            inner &= wide[at] <= wide[np.minimum(at + k, wide.size - 1)]
        first = np.flatnonzero(least | inner)
        self.words = np.diff(np.r_[first, h.size])
        self.doc, self.start = doc[first], place[first]
        self.sizes = np.where(self.words >= SHINGLE, self.words - SHINGLE + 1, 1)
        if not first.size:
            self.cls, self.shingles = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
            return
        power = np.cumprod(np.full(int(self.words.max()), _ODD[1]))
        inside = np.arange(h.size) - np.repeat(first, self.words)
        self.cls = _mix(np.add.reduceat(_mix(h) * power[inside], first) + self.words.astype(np.uint64))
        five = np.zeros(h.size, np.uint64)
        for k in range(SHINGLE):
            five[: h.size - k] += h[k:] * _ODD[2 + k]
        self.shingles = _mix(five)[_expand(first, self.sizes)]
        short = self.words < SHINGLE
        self.shingles[(np.cumsum(self.sizes) - self.sizes)[short]] = self.cls[short]

    def bands(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(paragraphs, band value) of each band."""
        if not self.cls.size:
            return
        at = np.cumsum(self.sizes) - self.sizes
        signature = [np.minimum.reduceat(_mix(self.shingles, odd), at) for odd in _ODD]
        tiny, some, many = self.sizes < 4, (self.sizes >= 4) & (self.sizes <= 10), self.sizes >= 8
        whole = sum(v[tiny] * odd for v, odd in zip(signature, _ODD, strict=True))
        yield np.flatnonzero(tiny), _mix(whole)
        for k in range(2):
            yield np.flatnonzero(some), _mix(signature[k][some] + np.uint64(1 + k))
        for k in range(0, VALUES, 2):
            yield np.flatnonzero(many), _mix(signature[k][many] * _ODD[0] + signature[k + 1][many] + np.uint64(101 + k))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _batches(rows: DataFrame, most: int = BATCH) -> DataFrame:
    """(batch, size, keys, ends, data): about ``most`` bytes of text, compressed, with the keys and ends of its texts.

    Written once. Later passes meet a batch by its number, so texts are not dealt by key again.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        n, number = 0, TaskContext.get().partitionId() << 32

        def packed() -> pa.RecordBatch:
            whole = b"".join(t for _, t in held)
            columns = [
                [number], [n], [np.array([k for k, _ in held], np.int64).tobytes()], [np.cumsum([len(t) for _, t in held]).astype(np.int64).tobytes()],
                [pa.compress(whole, "zstd", asbytes=True)],
            ]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["batch", "size", "keys", "ends", "data"])

        for batch in batches:
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.append((key, data.as_py() or b""))
                n += len(held[-1][1])
                if n >= most:
                    yield packed()
                    held, n, number = [], 0, number + 1
        if held:
            yield packed()

    return cut(rows.mapInArrow(tidied(pack), "batch long, size long, keys binary, ends binary, data binary"), "texts")


def _texts(row: dict) -> tuple[np.ndarray, list[bytes]]:
    """Keys and texts of a row of ``_batches``."""
    ends = np.frombuffer(row["ends"], np.int64).tolist()
    whole = pa.decompress(row["data"], row["size"], "zstd", asbytes=True)
    return np.frombuffer(row["keys"], np.int64), [whole[a:b] for a, b in zip([0, *ends], ends)]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _buckets(batches: DataFrame) -> int:
    return max(parallelism(batches.sparkSession), math.ceil((batches.agg(F.sum("size")).first()[0] or 0) / BUCKET))


def _bucket(values: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash; it does not fall as hashes rise."""
    return ((values >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _offsets(x: np.ndarray) -> tuple[int, int, bytes]:
    """(least, bytes a number, numbers above the least) in as few bytes as hold them."""
    least = int(x.min())
    above = (x - least).astype(np.min_scalar_type(int(x.max()) - least))
    return least, above.itemsize, above.tobytes()


def _numbers(least: int, width: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{width}").astype(np.int64) + least


def _marks(batches: DataFrame, values_of: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], buckets: int, kind: str, hot: int = HOT) -> DataFrame:
    """(batch, marks): which distinct values of each batch, in ascending order, stand in documents of two keys.

    ``values_of`` gives (text number, value) of a batch's texts. Tasks send each distinct value of a batch once, as
    sorted slices of a bucket of values, with one key and whether there are others; the answer is a bit a value.
    Values of which ``kind`` keeps fewer bytes may be marked without need. A mark is (bucket, n, shared, hot), hot
    for values in more than ``hot`` batches.
    """

    def slices(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(incoming):
            keys, texts = _texts(row)
            at, values = values_of(texts)
            if not values.size:
                continue
            order = np.argsort(values)
            values, keys = values[order], keys[at[order]]
            first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
            low, high = np.minimum.reduceat(keys, first), np.maximum.reduceat(keys, first)
            values = values[first]
            bucket = _bucket(values, buckets)
            begin = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            out = []
            for a, b in zip(begin.tolist(), [*begin[1:].tolist(), values.size], strict=True):
                out.append((int(bucket[a]), row["batch"], b - a, values[a:b].astype(kind).tobytes(), *_offsets(low[a:b]), np.packbits(low[a:b] != high[a:b]).tobytes()))
            names = ["bucket", "batch", "n", "value", "least", "width", "key", "several"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)

    def shared(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        value = np.concatenate([np.frombuffer(r["value"], kind) for r in rows])
        key = np.concatenate([_numbers(r["least"], r["width"], r["key"]) for r in rows])
        several = np.concatenate([np.unpackbits(np.frombuffer(r["several"], np.uint8), count=r["n"]) for r in rows])
        order = np.argsort(value)
        first = np.flatnonzero(np.r_[True, value[order][1:] != value[order][:-1]])
        count = np.diff(np.r_[first, value.size])
        found = (np.minimum.reduceat(key[order], first) != np.maximum.reduceat(key[order], first)) | np.maximum.reduceat(several[order], first).astype(bool)
        mark, many = np.empty(value.size, bool), np.empty(value.size, bool)
        mark[order], many[order] = np.repeat(found, count), np.repeat(count > hot, count)
        ends = np.cumsum([r["n"] for r in rows])
        out = [
            (r["batch"], r["bucket"], r["n"], np.packbits(mark[e - r["n"] : e]).tobytes(), np.packbits(many[e - r["n"] : e]).tobytes() if many[e - r["n"] : e].any() else None)
            for r, e in zip(rows, ends.tolist(), strict=True)
        ]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["batch", "bucket", "n", "shared", "hot"])

    sent = batches.mapInArrow(tidied(slices), "bucket long, batch long, n long, value binary, least long, width long, key binary, several binary")
    marks = sent.groupBy("bucket").applyInArrow(shared, "batch long, bucket long, n long, shared binary, hot binary")
    return cut(marks.groupBy("batch").agg(F.collect_list(F.struct("bucket", "n", "shared", "hot")).alias("marks")), "marks")


def _marked(row: dict, values: np.ndarray, of: str = "shared") -> np.ndarray:
    """Of each value of a batch whether it is marked."""
    distinct, at = np.unique(values, return_inverse=True)
    bits = [
        np.unpackbits(np.frombuffer(m[of], np.uint8), count=m["n"]) if m[of] is not None else np.zeros(m["n"], np.uint8)
        for m in sorted(row["marks"], key=lambda m: m["bucket"])
    ]
    return np.concatenate([*bits, np.zeros(0, np.uint8)]).astype(bool)[at] if distinct.size else np.zeros(0, bool)


def _bands(found: Paragraphs) -> tuple[np.ndarray, np.ndarray]:
    """(paragraph, band value) of all bands."""
    bands = [(np.zeros(0, np.int64), np.zeros(0, np.uint64)), *found.bands()]
    return np.concatenate([who for who, _ in bands]), np.concatenate([value for _, value in bands])


def _band_values(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    found = Paragraphs(texts)
    who, value = _bands(found)
    return found.doc[who], value


def _band_rows(marked: DataFrame) -> DataFrame:
    """(value, cls, doc, at, batch, lead): the marked bands; at is start * 2^32 + words, lead is the first band of each paragraph."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            keys, texts = _texts(row)
            found = Paragraphs(texts)
            who, value = _bands(found)
            held = _marked(row, value)
            who, value = who[held], value[held]
            order = np.argsort(who, kind="stable")
            who, value = who[order], value[order]
            lead = np.r_[True, who[1:] != who[:-1]][: who.size]
            at = (found.start[who] << 32) + found.words[who]
            columns = [_signed(value), _signed(found.cls[who]), pa.array(keys[found.doc[who]]), pa.array(at), pa.array(np.full(who.size, row["batch"])), pa.array(lead)]
            yield pa.RecordBatch.from_arrays(columns, names=["value", "cls", "doc", "at", "batch", "lead"])

    return marked.mapInArrow(tidied(run), "value long, cls long, doc long, at long, batch long, lead boolean")


def _shingle_sets(batches: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, shingles): the distinct shingles of each wanted class (cls, batch), taken from a text of its batch."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(incoming):
            found = Paragraphs(_texts(row)[1])
            begin = np.cumsum(found.sizes) - found.sizes
            asked = np.sort(np.array(row["asked"], np.int64))
            cls, first = np.unique(found.cls.view(np.int64), return_index=True)
            first = first[np.isin(cls, asked, assume_unique=True)]
            owner, shingles = np.repeat(np.arange(first.size), found.sizes[first]), found.shingles[_expand(begin[first], found.sizes[first])]
            order = np.lexsort((shingles, owner))
            owner, shingles = owner[order], shingles[order]
            new = np.r_[True, (owner[1:] != owner[:-1]) | (shingles[1:] != shingles[:-1])][: owner.size]
            ends = np.searchsorted(owner[new], np.arange(first.size + 1)).astype(np.int32)
            sets = pa.ListArray.from_arrays(pa.array(ends), _signed(shingles[new]))
            yield pa.RecordBatch.from_arrays([_signed(found.cls[first]), sets], names=["cls", "shingles"])

    asked = wanted.groupBy("batch").agg(F.collect_list("cls").alias("asked"))
    return batches.join(asked, "batch").mapInArrow(tidied(run), "cls long, shingles array<long>")


def _texts_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").cast("binary").alias("data"))


def occurrences(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, tile: int = TILE) -> DataFrame:
    """(doc, start, words, cluster, first_doc): paragraphs of clusters that stand in at least two documents.

    Null keys are passed over; null, empty and wordless texts have no paragraphs. Documents with equal keys count
    as one document. Other columns are not read.
    """
    return _occurrences(_batches(_texts_of(docs, key, text)), similarity, tile)


def _occurrences(batches: DataFrame, similarity: float, tile: int) -> DataFrame:
    marks = _marks(batches, _band_values, _buckets(batches), "u8")
    held = cut(_band_rows(batches.join(marks, "batch")), "bands")
    drop(marks)
    several = held.groupBy("value").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).where("low <> high").select("value")
    pairs = cut(held.select("value", "cls").join(several, "value", "left_semi").distinct(), "candidates")
    standing = held.where("lead").groupBy("cls").agg(F.min("batch").alias("batch"))
    sets = cut(_shingle_sets(batches, standing.join(pairs.select("cls").distinct(), "cls", "left_semi")), "shingles")
    met = cut(pairs.join(sets, "cls"), "sets")
    drop(sets)
    drop(pairs)
    linked = components(jaccard_forest(met, similarity, tile))
    drop(met)
    one = held.where("lead").select("cls", "doc", "at").distinct().join(linked, held.cls == linked.node, "left").select(
        "doc", "at", F.coalesce("component", "cls").alias("cluster")
    )
    named = cut(one, "occurrences")
    drop(held)
    clusters = named.groupBy("cluster").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last")).where("first_doc <> last")
    return named.join(clusters.drop("last"), "cluster").select(
        "doc", F.shiftright("at", 32).alias("start"), F.col("at").bitwiseAND(F.lit((1 << 32) - 1)).alias("words"), "cluster", "first_doc",
    )


def _stretches(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each stretch of n words."""
    out, power = np.zeros(max(h.size - n + 1, 0), np.uint64), np.cumprod(np.full(n, _ODD[1]))
    mixed, room = _mix(h), np.empty(min(out.size, STRETCH), np.uint64)
    for at in range(0, out.size, STRETCH):
        part = out[at : at + STRETCH]
        for k in range(n):
            part += np.multiply(mixed[at + k : at + k + part.size], power[k], out=room[: part.size])
    return _mix(out)


def _least_grams(h: np.ndarray, size: int) -> np.ndarray:
    """For each window of ``size`` words its least gram."""
    least, over, reach = _stretches(h, min(GRAM, size)), size - min(GRAM, size) + 1, 1
    if least.size < over:
        return least[:0]
    while reach < over:
        step = min(reach, over - reach)
        least, reach = np.minimum(least[:-step], least[step:]), reach + step
    return least


def _windows(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place in the text, least gram, hash) of every window of ``size`` words."""
    h, sizes = word_hashes(texts)
    n = np.maximum(sizes - size + 1, 0)
    at, begin = _expand(np.cumsum(sizes) - sizes, n), np.repeat(np.cumsum(sizes) - sizes, n)
    return np.repeat(np.arange(sizes.size), n), at - begin, _least_grams(h, size)[at], _stretches(h, size)[at]


def _gram_values(size: int) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
    def values(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        text, _, gram, _ = _windows(texts, size)
        new = np.r_[True, (text[1:] != text[:-1]) | (gram[1:] != gram[:-1])][: gram.size]
        return text[new], gram[new]

    return values


def _meetings(batches: DataFrame, size: int, hot: int = HOT) -> DataFrame:
    """(doc, other, off, stretch, low, high): windows of ``size`` words of a document that stand in an earlier one too.

    ``other`` is the first document that has the window, ``off`` the way from its place to the one there; low and high are the
    first and last such window of a stretch of ``size`` places. Only windows whose least gram stands in two documents are
    sent, in buckets of grams; those of a gram that stands in very many batches as rows that Spark joins.
    """
    buckets = _buckets(batches)
    marks = _marks(batches, _gram_values(size), buckets, "u4", hot)
    marked = batches.join(marks, "batch")

    def slices(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(incoming):
            keys, texts = _texts(row)
            text, at, gram, value = _windows(texts, size)
            held = np.flatnonzero(_marked(row, gram) & ~_marked(row, gram, "hot"))
            if not held.size:
                continue
            bucket = _bucket(gram[held], buckets)
            order = np.argsort(bucket, kind="stable")
            held, bucket = held[order], bucket[order]
            begin = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            out = []
            for a, b in zip(begin.tolist(), [*begin[1:].tolist(), held.size], strict=True):
                who = held[a:b]
                out.append((int(bucket[a]), value[who].tobytes(), *_offsets(keys[text[who]]), *_offsets(at[who])))
            names = ["bucket", "value", "least", "width", "key", "least_at", "width_at", "at"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)

    def meet(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        value = np.concatenate([np.frombuffer(r["value"], np.uint64) for r in rows])
        doc = np.concatenate([_numbers(r["least"], r["width"], r["key"]) for r in rows])
        at = np.concatenate([_numbers(r["least_at"], r["width_at"], r["at"]) for r in rows])
        del rows, table
        order = np.argsort(value)
        value, doc, at = value[order], doc[order], at[order]
        first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
        count = np.diff(np.r_[first, value.size])
        other = np.repeat(np.minimum.reduceat(doc, first), count)
        place = np.repeat(np.minimum.reduceat(np.where(doc == other, at, np.iinfo(np.int64).max), first), count)
        later = doc != other
        doc, other, at, off = doc[later], other[later], at[later], (place - at)[later]
        order = np.lexsort((at, doc))
        doc, other, at, off = doc[order], other[order], at[order], off[order]
        stretch = at // size
        new = np.ones(doc.size, bool)
        new[1:] = (doc[1:] != doc[:-1]) | (other[1:] != other[:-1]) | (off[1:] != off[:-1]) | (stretch[1:] != stretch[:-1])
        begin = np.flatnonzero(new)
        end = np.r_[begin[1:], doc.size][: begin.size] - 1
        return pa.table([doc[begin], other[begin], off[begin], stretch[begin], at[begin], at[end]], names=["doc", "other", "off", "stretch", "low", "high"])

    sent = marked.mapInArrow(tidied(slices), "bucket long, value binary, least long, width long, key binary, least_at long, width_at long, at binary")
    found = sent.groupBy("bucket").applyInArrow(meet, "doc long, other long, off long, stretch long, low long, high long")
    if not marks.where(F.exists("marks", lambda m: m["hot"].isNotNull())).isEmpty():

        def rest(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(incoming):
                keys, texts = _texts(row)
                text, at, gram, value = _windows(texts, size)
                held = np.flatnonzero(_marked(row, gram) & _marked(row, gram, "hot"))
                yield pa.RecordBatch.from_arrays([_signed(value[held]), pa.array(keys[text[held]]), pa.array(at[held])], names=["value", "doc", "at"])

        often = cut(marked.mapInArrow(tidied(rest), "value long, doc long, at long"), "windows")
        first = often.groupBy("value").agg(F.min(F.struct("doc", "at")).alias("first"), F.max("doc").alias("last")).where("first.doc <> last")
        found = found.unionByName(often.join(first.drop("last"), "value").where("doc <> first.doc").select(
            "doc", F.col("first.doc").alias("other"), (F.col("first.at") - F.col("at")).alias("off"), F.floor(F.col("at") / size).alias("stretch"),
            F.col("at").alias("low"), F.col("at").alias("high"),
        ))
    # An edit breaks ``size`` windows in a row, so that many hold at most two runs of one offset: their ends name both.
    return found.groupBy("doc", "other", "off", "stretch").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def _ends(a: np.ndarray, b: np.ndarray, fives: np.ndarray, others: np.ndarray) -> list[tuple[int, int]]:
    """Ends of the equal runs of a and b from their beginnings on, each behind an edit of at most GAP words.

    ``fives`` and ``others`` hold a hash of the SHINGLE words from each place of a and of b on.
    """
    x = y = 0
    ends = []
    while True:
        n = min(a.size - x, b.size - y)
        apart = a[x : x + n] != b[y : y + n]
        run = int(apart.argmax()) if n else 0
        run = run if n and apart[run] else n
        x, y = x + run, y + run
        ends.append((x, y))
        left, right = fives[x : x + GAP + 1].tolist(), others[y : y + GAP + 1].tolist()
        both = set(left).intersection(right)
        if not both:
            return ends
        gap, p = min((p + right.index(five), p) for p, five in enumerate(left) if five in both)
        x, y = x + p, y + gap - p
        if a[x : x + SHINGLE].tolist() != b[y : y + SHINGLE].tolist():  # only their hashes are equal
            return ends


class _Shared:
    """Distinct shingles of two growing stretches, and how many they share; both begin with the same ones."""

    def __init__(self, equal: set[int]) -> None:
        self.mine, self.theirs, self.common = equal.copy(), equal.copy(), len(equal)

    def add(self, mine: list[int], theirs: list[int]) -> None:
        for own, other, new in ((self.mine, self.theirs, mine), (self.theirs, self.mine, theirs)):
            fresh = set(new) - own
            self.common += len(fresh & other)
            own |= fresh

    def alike(self, similarity: float) -> bool:
        return self.common >= similarity * (len(self.mine) + len(self.theirs) - self.common) - 1e-9


def extended(
    a: np.ndarray, b: np.ndarray, seeds: list[tuple[int, int]], size: int, similarity: float, shingles: tuple[np.ndarray, np.ndarray] | None = None
) -> list[tuple[int, int, int, int]]:
    """(first, end, first in b, end in b) of the passages around seeds (place in a, place in b) of ``size`` equal words.

    Seeds whose words differ are passed over. ``shingles`` are those of a and of b, where they are known.
    """
    found: list[tuple[int, int, int, int]] = []
    mine, theirs = shingles or (_stretches(x, SHINGLE) for x in (a, b))
    less = SHINGLE - 1
    for i, j in sorted(seeds):
        if any(p <= i and i + size <= q and r <= j and j + size <= s for p, q, r, s in found[-8:]):
            continue
        if a[i : i + size].tolist() != b[j : j + size].tolist():
            continue
        # The run of the seed itself, then the farthest end on the right and on the left that is still similar.
        left = _ends(a[:i][::-1], b[:j][::-1], mine[: max(i - less, 0)][::-1], theirs[: max(j - less, 0)][::-1])
        right = _ends(a[i:], b[j:], mine[i:], theirs[j:])
        p, r, q, s = i - left[0][0], j - left[0][1], i + right[0][0], j + right[0][1]
        equal = set(mine[p : q - less].tolist()) if len(left) > 1 or len(right) > 1 else set()
        low, high, begin, end = p, q, r, s
        if len(right) > 1:
            shared, x, y = _Shared(equal), q, s
            for far, away in right[1:]:
                shared.add(mine[x - less : i + far - less].tolist(), theirs[y - less : j + away - less].tolist())
                x, y = i + far, j + away
                if shared.alike(similarity):
                    high, end = x, y
        if len(left) > 1:
            # What the right side has added counts here as well.
            shared, x, y = _Shared(equal), p, r
            if high > q or end > s:
                shared.add(mine[q - less : high - less].tolist(), theirs[s - less : end - less].tolist())
            for far, away in left[1:]:
                shared.add(mine[i - far : x].tolist(), theirs[j - away : y].tolist())
                x, y = i - far, j - away
                if shared.alike(similarity):
                    low, begin = x, y
        found.append((low, high, begin, end))
    return found


def _verified(batches: Iterator[pa.RecordBatch], size: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """(doc, start, words, cluster, first_doc) of the passages of (doc, other, seeds, mine, theirs)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        # A text that stands in several rows is hashed once.
        number: dict[bytes, int] = {}
        one, two = ([number.setdefault(t or b"", len(number)) for t in batch.column(c).to_pylist()] for c in ("mine", "theirs"))
        h, sizes = word_hashes(list(number))
        begin = np.cumsum(sizes) - sizes
        fives, windows = _stretches(h, SHINGLE), _stretches(h, size)
        asked = batch.column("seeds")
        row = np.repeat(np.arange(batch.num_rows), asked.value_lengths().to_numpy(zero_copy_only=False))
        low, high, off = (x.to_numpy(zero_copy_only=False) for x in asked.flatten().flatten())
        row, off, i = np.r_[row, row], np.r_[off, off], np.r_[low, high]
        j = i + off
        mine, theirs = np.array(one)[row], np.array(two)[row]
        inside = (i + size <= sizes[mine]) & (j + size <= sizes[theirs])
        row, i, j, mine, theirs = row[inside], i[inside], j[inside], mine[inside], theirs[inside]
        alike = windows[begin[mine] + i] == windows[begin[theirs] + j]
        row, i, j = row[alike], i[alike], j[alike]
        order = np.lexsort((j, i, row))
        row, i, j = row[order], i[order], j[order]
        new = np.r_[True, (row[1:] != row[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])][: row.size]
        row, i, j = row[new], i[new], j[new]
        first = np.searchsorted(row, np.arange(batch.num_rows + 1)).tolist()
        seeds = list(zip(i.tolist(), j.tolist(), strict=True))
        out: list[tuple[int, int, int, int, int]] = []
        for k, (doc, other) in enumerate(zip(batch.column("doc").to_pylist(), batch.column("other").to_pylist(), strict=True)):
            if first[k] == first[k + 1]:
                continue
            (a, a_fives, _), (b, b_fives, b_windows) = (
                (h[begin[t] : begin[t] + sizes[t]], fives[begin[t] : begin[t] + sizes[t] - SHINGLE + 1], windows[begin[t] : begin[t] + sizes[t] - size + 1])
                for t in (one[k], two[k])
            )
            for p, q, r, s in extended(a, b, seeds[first[k] : first[k + 1]], size, similarity, (a_fives, b_fives)):
                name = int(b_windows[r : s - size + 1].view(np.int64).min())
                out += [(doc, p, q - p, name, other), (other, r, s - r, name, other)]
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc", "start", "words", "cluster", "first_doc"])


def passages(rows: DataFrame, similarity: float = SIMILARITY, size: int = LEAST_WORDS) -> DataFrame:
    """(doc, start, words, cluster, first_doc): passages of at least ``size`` words that stand in an earlier document too."""
    return _passages(_batches(rows), rows, similarity, size)


def _passages(batches: DataFrame, rows: DataFrame, similarity: float, size: int) -> DataFrame:
    near = _meetings(batches, size)
    seeds = cut(near.groupBy("doc", "other").agg(F.collect_list(F.struct("low", "high", "off")).alias("seeds")), "seeds")
    drop(batches)

    def verify(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _verified(incoming, size, similarity)

    mine, theirs = (rows.select(F.col("key").alias(k), F.col("data").alias(d)) for k, d in (("doc", "mine"), ("other", "theirs")))
    both = seeds.join(mine, "doc").join(theirs, "other").select("doc", "other", "seeds", "mine", "theirs")
    return both.mapInArrow(tidied(verify), "doc long, start long, words long, cluster long, first_doc long")


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document the runs of words that are removed and of those that are repeated but stay."""
    for batch in batches:
        if not batch.num_rows:
            continue
        asked = batch.column(1)
        start, words, removed, count, cluster, first_doc = (x.to_numpy(zero_copy_only=False) for x in asked.flatten().flatten())
        sizes = asked.value_lengths().to_numpy(zero_copy_only=False)
        # All documents on one axis, with a gap between them.
        shift = np.cumsum(np.maximum.reduceat(start + words, np.cumsum(sizes) - sizes) + 2)
        shift = np.r_[0, shift[:-1]]
        first = start + np.repeat(shift, sizes)
        last = first + words
        places, at = np.unique(np.r_[first, last], return_inverse=True)
        change = np.zeros((2, places.size), np.int64)
        np.add.at(change, (np.r_[removed, removed].astype(np.int64), at), np.repeat([1, -1], first.size))
        kept, taken = change.cumsum(axis=1) > 0
        state = np.where(taken, 2, kept)
        edges = np.flatnonzero(np.r_[True, state[1:] != state[:-1]])
        runs = np.flatnonzero(state[edges])
        begin, stop, kind = places[edges[runs]], places[edges[runs + 1]], state[edges[runs]] == 2
        # A piece covers the runs from the last that begins at or before it to the last that begins before its end.
        low, high = np.searchsorted(begin, first, "right") - 1, np.searchsorted(begin, last, "left")
        piece, at = np.repeat(np.arange(low.size), high - low), _expand(low, high - low)
        inside = kind[at] == removed[piece]
        piece, at = piece[inside], at[inside]
        pieces = np.zeros(begin.size, np.int64)
        clusters, firsts = (np.full(begin.size, np.iinfo(np.int64).max) for _ in range(2))
        np.add.at(pieces, at, count[piece])
        np.minimum.at(clusters, at, cluster[piece])
        np.minimum.at(firsts, at, first_doc[piece])
        doc = np.searchsorted(shift, begin, "right") - 1
        columns = [batch.column(0).take(pa.array(doc)), *(pa.array(x) for x in (begin - shift[doc], stop - begin, pieces, clusters, firsts, kind))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc", "start", "n_words", "n_paragraphs", "cluster", "first_doc", "removed"])


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                   least_words: int = LEAST_WORDS, tile: int = TILE) -> DataFrame:
    """(key, start, n_words, n_paragraphs, cluster, first_doc, removed): runs of repeated words, in word positions.

    ``n_paragraphs`` counts the paragraphs and passages of a run, ``cluster`` and ``first_doc`` are the least of them.
    ``removed`` is false in the document that is first; a word that is removed for one piece is not kept for another.
    """
    rows = _texts_of(docs, key, text)
    batches = _batches(rows)
    found = _occurrences(batches, similarity, tile).unionByName(_passages(batches, rows, similarity, least_words))
    pieces = found.groupBy("doc", "start", (F.col("doc") != F.col("first_doc")).alias("removed")).agg(
        F.max("words").alias("words"), F.count(F.lit(1)).alias("pieces"), F.min("cluster").alias("cluster"), F.min("first_doc").alias("first_doc"),
    )
    spans = pieces.groupBy("doc").agg(F.collect_list(F.struct("start", "words", "removed", "pieces", "cluster", "first_doc")).alias("pieces")).mapInArrow(
        _spans, "doc long, start long, n_words long, n_paragraphs long, cluster long, first_doc long, removed boolean"
    )
    return spans.where(F.col("n_words") >= least_words).withColumnRenamed("doc", key)
