"""Benchmark decontamination by an FM-index per shard of training text.

A shard is a batch of documents inside one task. Words are numbered by the benchmark's vocabulary; a run of
known words that is shorter than the shortest window cannot hold one, so only longer runs enter the shard's
text, with separators between them. Over that text the task builds a suffix array, keeps its Burrows-Wheeler
transform as a wavelet matrix and every eighth suffix position, and drops the rest. All windows are searched
backwards at once by rank queries; occurrences are located by walking to a sampled position; their spans are
merged per document. Documents never move between tasks.

The benchmark is sent to the tasks in pages of at most ``PAGE_BYTES``. With more than one page the text is read
once per page and the spans are merged by document afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import cut, tidied, word_bytes

WINDOW = 10
PAGE_BYTES = 16 * 1024 * 1024
SHARD_WORDS = 1_000_000
SHARD_DOCS = 20_000
SAMPLE = 8
_SCHEMA = "key long, n_words long, items array<long>, spans array<struct<start:long,end:long>>"
_WORDS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


class BitVector:
    """Bits with constant-time counts of ones."""

    def __init__(self, bits: np.ndarray) -> None:
        n = bits.size
        packed = np.zeros((n // 64 + 1) * 8, np.uint8)
        got = np.packbits(bits, bitorder="little")
        packed[: got.size] = got
        self.words = packed.view(np.uint64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)][:-1]

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones in front of position i."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)


class WaveletMatrix:
    """Rank and access over a sequence of small integers."""

    def __init__(self, symbols: np.ndarray, size: int) -> None:
        self.bits = max(1, int(size - 1).bit_length())
        self.levels: list[tuple[BitVector, int]] = []
        for k in range(self.bits - 1, -1, -1):
            bit = (symbols >> k) & 1
            self.levels.append((BitVector(bit.astype(np.uint8)), int(bit.size - bit.sum())))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` in front of i."""
        start = np.zeros_like(i)
        for k, (ones, zeros) in zip(range(self.bits - 1, -1, -1), self.levels, strict=True):
            bit = ((symbol >> k) & 1).astype(bool)
            a, b = ones.ones(start), ones.ones(i)
            start = np.where(bit, zeros + a, start - a)
            i = np.where(bit, zeros + b, i - b)
        return i - start

    def access_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol at i and how often it occurs in front of i."""
        symbol = np.zeros_like(i)
        start = np.zeros_like(i)
        for ones, zeros in self.levels:
            bit = ones.get(i)
            symbol = symbol * 2 + bit
            a, b = ones.ones(start), ones.ones(i)
            start = np.where(bit == 1, zeros + a, start - a)
            i = np.where(bit == 1, zeros + b, i - b)
        return symbol, i - start


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling; suffixes whose place is settled are not sorted again."""
    n = text.size
    order = np.argsort(text, kind="stable")
    new = np.r_[True, text[order][1:] != text[order][:-1]]
    # The rank of a suffix is the first place of its group.
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    step = 1
    while True:
        end = np.r_[new[1:], True]
        open_places = np.flatnonzero(~(new & end))
        if not open_places.size:
            return order
        at = order[open_places]
        behind = at + step
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)], -1)
        key = rank[at] * (n + 1) + second + 1
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[open_places] = at
        differs = np.r_[True, key[1:] != key[:-1]]
        new[open_places] = differs
        rank[at] = np.maximum.accumulate(np.where(differs, open_places, 0))
        step *= 2


class FMIndex:
    """Search in a text of symbols 1.. (0 is added as its end)."""

    def __init__(self, text: np.ndarray, size: int) -> None:
        whole = np.r_[text, 0].astype(np.int64)
        order = suffix_array(whole)
        self.bwt = WaveletMatrix(whole[order - 1], size)
        self.less = np.r_[0, np.cumsum(np.bincount(whole, minlength=size))]
        sampled = order % SAMPLE == 0
        self.marked, self.positions = BitVector(sampled.astype(np.uint8)), order[sampled]
        self.n = whole.size

    def ranges(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that start with each pattern (one per line, padded behind)."""
        low, high = np.zeros(lengths.size, np.int64), np.full(lengths.size, self.n, np.int64)
        for k in range(1, patterns.shape[1] + 1):
            live = np.flatnonzero((lengths >= k) & (high > low))
            if not live.size:
                break
            c = patterns[live, lengths[live] - k]
            low[live] = self.less[c] + self.bwt.rank(c, low[live])
            high[live] = self.less[c] + self.bwt.rank(c, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(rows.size, np.int64)
        todo, walked = np.arange(rows.size), 0
        while todo.size:
            done = self.marked.get(rows) == 1
            out[todo[done]] = self.positions[self.marked.ones(rows[done])] + walked
            todo, rows = todo[~done], rows[~done]
            c, before = self.bwt.access_rank(rows)
            rows = self.less[c] + before
            walked += 1
        return out


def _expand(first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, value): for each run its values first .. first + size - 1."""
    owner = np.repeat(np.arange(sizes.size), sizes)
    return owner, np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(owner.size)


@dataclass
class Page:
    """Windows of a page of test items; symbols 0 and 1 are the end and the separator."""

    words: dict[bytes, int]
    patterns: np.ndarray
    lengths: np.ndarray
    #: Items of window w are items[first[w] : first[w + 1]].
    first: np.ndarray
    items: np.ndarray

    @staticmethod
    def of(items: list[tuple[int, bytes]], window: int) -> Page:
        words: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = {}
        for item, data in items:
            ids = [words.setdefault(w, len(words) + 2) for w in word_bytes(data)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(tuple(ids[at : at + window]), set()).add(item)
        patterns = np.zeros((len(owners), window), np.int64)
        lengths = np.array([len(w) for w in owners], np.int64)
        for i, w in enumerate(owners):
            patterns[i, : len(w)] = w
        first = np.r_[0, np.cumsum([len(o) for o in owners.values()])].astype(np.int64)
        flat = np.array([i for o in owners.values() for i in sorted(o)], np.int64)
        return Page(words, patterns, lengths, first, flat)


def _shard(page: Page, docs: list[tuple[int, np.ndarray]]) -> list[tuple[int, int, list[int], list[dict]]]:
    """Result rows of a shard. docs: (id, word numbers with 0 for unknown words)."""
    sizes = np.array([ids.size for _, ids in docs], np.int64)
    symbols = np.concatenate([ids for _, ids in docs]) if docs else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(sizes.size), sizes)
    place = np.arange(symbols.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    known = symbols > 0
    starts = np.flatnonzero(known & np.r_[True, ~known[:-1] | (doc[1:] != doc[:-1])]) if symbols.size else np.zeros(0, np.int64)
    stops = np.flatnonzero(known & np.r_[~known[1:] | (doc[1:] != doc[:-1]), True]) + 1 if symbols.size else starts
    shortest = int(page.lengths.min(initial=WINDOW + 1))
    long = stops - starts >= shortest
    starts, lengths = starts[long], (stops - starts)[long]
    empty = [(key, int(n), [], []) for (key, _), n in zip(docs, sizes, strict=True)]
    if not starts.size or not page.lengths.size:
        return empty
    run, at = _expand(starts, lengths)
    text = np.ones(at.size + starts.size, np.int64)  # a separator behind each run
    into = np.arange(at.size) + run
    text[into] = symbols[at]
    source = np.zeros(text.size, np.int64)
    source[into] = at
    index = FMIndex(text, len(page.words) + 2)
    low, high = index.ranges(page.patterns, page.lengths)
    which, rows = _expand(low, high - low)
    if not rows.size:
        return empty
    begin = source[index.locate(rows)]
    step = np.zeros(symbols.size + 1, np.int64)
    np.add.at(step, begin, 1)
    np.add.at(step, begin + page.lengths[which], -1)
    hit = np.flatnonzero(np.cumsum(step)[:-1] > 0)
    apart = np.r_[True, (hit[1:] != hit[:-1] + 1) | (doc[hit[1:]] != doc[hit[:-1]])]
    heads = np.flatnonzero(apart)
    tails = np.r_[heads[1:], hit.size] - 1
    spans: dict[int, list[dict]] = {}
    for d, s, e in zip(doc[hit[heads]].tolist(), place[hit[heads]].tolist(), place[hit[tails]].tolist(), strict=True):
        spans.setdefault(d, []).append({"start": s, "end": e + 1})
    pairs = np.unique(doc[begin] * page.lengths.size + which)
    owner, item_at = _expand(page.first[pairs % page.lengths.size], np.diff(page.first)[pairs % page.lengths.size])
    items: dict[int, set[int]] = {}
    for d, i in zip((pairs // page.lengths.size)[owner].tolist(), page.items[item_at].tolist(), strict=True):
        items.setdefault(d, set()).add(i)
    return [
        (key, int(n), sorted(items.get(i, ())), spans.get(i, []))
        for i, ((key, _), n) in enumerate(zip(docs, sizes, strict=True))
    ]


def _search(docs: DataFrame, page: Page) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(page)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        number = known.words.get
        held: list[tuple[int, np.ndarray]] = []
        count = 0

        def flush() -> pa.RecordBatch:
            rows = _shard(known, held)
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", "n_words", "items", "spans"]
            )

        for batch in batches:
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = word_bytes(data.as_py() or b"")
                ids = np.fromiter((number(w, 0) for w in words), np.int32, len(words))
                held.append((key, ids))
                count += ids.size
                if count >= SHARD_WORDS or len(held) >= SHARD_DOCS:
                    yield flush()
                    count = 0
        if held:
            yield flush()

    return docs.mapInArrow(run, _SCHEMA)


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
         item_text: str = "text", window: int = WINDOW, page_bytes: int = PAGE_BYTES) -> DataFrame:
    """(key, n_words, items, spans): windows of test items found in each document.

    ``spans`` are merged word ranges [start, end) and ``items`` the ids of items with a window there. Items of
    fewer than ``window`` words are one window; null or wordless items have none. Null texts have no words.
    Every row of ``docs`` gives one row; with several pages, keys must be unique. Other columns are not read.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").cast("binary").alias("data"))
    tests, pages = _pages(benchmark, item, item_text, page_bytes)
    found = None
    for k in range(pages):
        part = tests if pages == 1 else tests.where(F.pmod(F.xxhash64("item", "data"), F.lit(pages)) == k)
        page = Page.of([(r["item"], bytes(r["data"])) for r in part.collect()], window)
        one = _search(rows, page)
        found = one if found is None else found.unionAll(one)
    if pages > 1:
        found = found.groupBy("key").agg(
            F.max("n_words").alias("n_words"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        ).withColumn("spans", F.expr(
            "aggregate(spans, cast(array() as array<struct<start:long,end:long>>), (done, s) -> if("
            " size(done) > 0 and element_at(done, -1).end >= s.start,"
            " concat(slice(done, 1, size(done) - 1), array(named_struct('start', element_at(done, -1).start,"
            " 'end', greatest(element_at(done, -1).end, s.end)))), concat(done, array(s))))"
        ))
    return found.withColumnRenamed("key", key)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts per document of the result of ``find``, and a hash of its items' ids sorted as strings."""
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        key, "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def cut_spans(data: bytes, spans: list) -> bytes:
    """``data`` without the words of the spans; a line break stays where something was cut."""
    words = [m.span() for m in _WORDS.finditer(data)]
    out, at = [], 0
    for s in spans:
        out.append(data[at : words[s["start"]][0]])
        at = words[s["end"] - 1][1]
    out.append(data[at:])
    return b"\n".join(out)


def _pages(benchmark: DataFrame, item: str, item_text: str, page_bytes: int) -> tuple[DataFrame, int]:
    """(item, data) of the usable items, and the number of pages that they fill."""
    tests = benchmark.where(F.col(item_text).isNotNull() & F.col(item).isNotNull()).select(
        F.col(item).cast("long").alias("item"), F.col(item_text).cast("string").cast("binary").alias("data")
    )
    total = tests.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    return tests, max(1, -(-total // page_bytes))


def _cleaned(texts: list[str | None], found: list[tuple]) -> tuple[list[str | None], list[int]]:
    """Texts without their spans, and the positions of those that keep a word or had no hit."""
    out, keep = [], []
    for i, (text, (_, n, _, spans)) in enumerate(zip(texts, found, strict=True)):
        out.append(cut_spans(text.encode(), spans).decode() if spans else text)
        if not spans or sum(s["end"] - s["start"] for s in spans) < n:
            keep.append(i)
    return out, keep


def remove(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text", window: int = WINDOW, page_bytes: int = PAGE_BYTES) -> DataFrame:
    """``docs`` with the found spans cut out of their texts; documents that lose all their words are dropped.

    All columns are kept, in order and whatever their names; texts without a hit stay as they are. Every row stands for
    itself: keys may repeat or be null. A benchmark of one page is searched and cut in one pass over the rows; with
    several pages the rows are numbered and written first.
    """
    tests, pages = _pages(benchmark, item, item_text, page_bytes)
    if pages == 1:
        return _removed_in_place(docs, Page.of([(r["item"], bytes(r["data"])) for r in tests.collect()], window), text)
    numbered = cut(docs.select(F.monotonically_increasing_id().alias("uid"), F.struct(*docs.columns).alias("row")), "numbered")
    plain = numbered.select("uid", F.col("row")[text].alias("text"))
    found = find(plain, benchmark, "uid", "text", item, item_text, window, page_bytes).where(F.size("spans") > 0).select("uid", "n_words", "spans")
    found = cut(found, "spans")
    hit = numbered.join(found, "uid").select("uid", F.col("row")[text].alias("text"), "n_words", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(None, n, None, s) for n, s in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            texts, keep = _cleaned(batch.column(1).to_pylist(), rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["uid", "clean"]).take(pa.array(keep, pa.int64()))

    clean = hit.mapInArrow(run, "uid long, clean string")
    rest = numbered.join(found.select("uid"), "uid", "left_anti").select("row.*")
    changed = numbered.join(clean, "uid").select("row.*", F.col("clean").alias("_clean"))
    # The cut text takes its place by position, as any name may occur among the columns.
    names = docs.columns
    columns = [f"c{i}" for i in range(len(names))] + ["clean"]
    changed = changed.toDF(*columns).select(*[F.col("clean" if n == text else f"c{i}").alias(n) for i, n in enumerate(names)])
    return rest.unionAll(changed)


def _removed_in_place(docs: DataFrame, page: Page, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(page)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        number = known.words.get
        held: list[pa.RecordBatch] = []
        ids: list[tuple[int, np.ndarray]] = []
        count = 0

        def flush() -> Iterator[pa.RecordBatch]:
            found = iter(_shard(known, ids))
            for batch in held:
                at = batch.schema.get_field_index(text)
                texts, keep = _cleaned(batch.column(at).to_pylist(), [next(found) for _ in range(batch.num_rows)])
                columns = [pa.array(texts, batch.schema.field(at).type) if i == at else c for i, c in enumerate(batch.columns)]
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema).take(pa.array(keep, pa.int64()))
            held.clear()
            ids.clear()

        for batch in batches:
            held.append(batch)
            for data in batch.column(batch.schema.get_field_index(text)):
                words = word_bytes((data.as_py() or "").encode())
                ids.append((len(ids), np.fromiter((number(w, 0) for w in words), np.int32, len(words))))
                count += len(words)
            if count >= SHARD_WORDS or len(ids) >= SHARD_DOCS:
                yield from flush()
                count = 0
        if held:
            yield from flush()

    return docs.mapInArrow(tidied(run), docs.schema)
