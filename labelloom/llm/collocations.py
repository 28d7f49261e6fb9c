"""Phrase collocations of each language by marginalising counts of the longest windows.

Only windows of ``LONGEST`` consecutive words are counted, padded with nulls at the end of a piece. Spark's ROLLUP
sums these counts over successively shorter prefixes, which gives the frequency of every shorter phrase without an
explosion per length: each occurrence of a phrase starts exactly one window that has the phrase as its prefix.

A phrase can only be frequent if its words are. Windows therefore end before a word of fewer than ``least``
occurrences, and a count that is complete and too small is added to its shorter prefix before the rollup.

The frequent words travel as a dictionary while they take at most ``DICTIONARY_BYTES``. Windows are then sorted and
summed as pairs of integers inside the tasks and shuffled in compressed slices, one per bucket. A bucket is chosen by
the words up to the first one that is not hot (at most ``BUCKET`` occurrences, two words at least), so that no bucket
grows with a hot word. Beyond that size windows are counted as rows of strings by Spark's own aggregation.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm.common import cut
from labelloom.scratch import drop

LONGEST = 4
#: Largest dictionary of frequent words that is sent to the tasks, counting 16 bytes a word beside its letters.
DICTIONARY_BYTES = 32 * 1024 * 1024
#: Windows that a bucket holds on average, and occurrences above which a word is hot.
BUCKET = 1_000_000
#: Distinct words, or tokens, that a task holds before it passes on what it has counted.
HELD = 500_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = b"\xff"  # a byte that UTF-8 never uses
_PLAIN = bytes(
    255 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)
_LOW = np.int64(0xFFFFFFFF)


def tokens(data: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words of UTF-8 text, with a break between pieces."""
    return data.translate(_PLAIN).replace(_BREAK, b" \xff ").split()


def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n) of (lang, data)."""

    def flush(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, found in counts.items():
            found.pop(_BREAK, None)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
                names=["lang", "word", "n"],
            )
        counts.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts.setdefault(lang, Counter()).update(tokens(data.as_py()))
            if sum(map(len, counts.values())) > HELD:
                yield from flush(counts)
        yield from flush(counts)

    found = rows.mapInArrow(run, "lang string, word binary, n long")
    return found.groupBy("lang", F.col("word").cast("string").alias("word")).agg(F.sum("n").alias("n"))


def _summed(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows in order of (a, b), equal ones added up."""
    order = np.lexsort((b, a))
    a, b, c = a[order], b[order], c[order]
    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if a.size else np.zeros(0, np.int64)
    return a[new], b[new], np.add.reduceat(c, new) if a.size else c


def windows(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Padded windows of at least two words, as (first and second, third and fourth word) in the halves of an integer.

    ``ids`` are word numbers from 1; 0 ends a window.
    """
    ids = np.r_[ids, np.zeros(LONGEST - 1, np.int64)]
    second = ids[1:-2]
    third = np.where(second > 0, ids[2:-1], 0)
    fourth = np.where(third > 0, ids[3:], 0)
    at = (ids[:-3] > 0) & (second > 0)
    return (ids[:-3] << 32 | second)[at], (third << 32 | fourth)[at]


def bucket_of(a: np.ndarray, b: np.ndarray, hot: int, buckets: int) -> np.ndarray:
    """Bucket by the words up to the first one that is not among the ``hot`` smallest numbers, but two at least."""
    more = (a >> 32 <= hot) & ((a & _LOW) <= hot)
    third = b >> 32
    key = np.where(more, np.where(third <= hot, b, third << 32), 0)
    mixed = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + key.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _packed(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> bytes:
    steps = np.diff(a, prepend=np.int64(0))
    return pa.compress(steps.tobytes() + b.tobytes() + c.tobytes(), codec="zstd", asbytes=True)


def _unpacked(blob: bytes, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat = np.frombuffer(pa.decompress(blob, decompressed_size=24 * rows, codec="zstd"), np.int64)
    return np.cumsum(flat[:rows]), flat[rows : 2 * rows], flat[2 * rows :]


def _sums(new: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Sum of each run, repeated for its rows; ``new`` marks the first row of a run."""
    starts = np.flatnonzero(new)
    return np.repeat(np.add.reduceat(c, starts), np.diff(np.r_[starts, c.size]))


def settled(a: np.ndarray, b: np.ndarray, c: np.ndarray, hot: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of one bucket without what is known to be rarer than ``least``: such words are padded, such pairs go."""
    if not a.size:
        return a, b, c
    second, third = a & _LOW, b >> 32
    new = np.r_[True, a[1:] != a[:-1]]
    pair = _sums(new, c)
    triple = _sums(new | np.r_[True, third[1:] != third[:-1]], c)
    short = np.where(c < least, third << 32, b)
    # The windows of a pair, or triple, lie together in this bucket unless all its words are hot.
    whole = (a >> 32 > hot) | (second > hot)
    short = np.where((triple < least) & (whole | (third > hot)), 0, short)
    keep = ~whole | (pair >= least)
    return _summed(a[keep], short[keep], c[keep])


def _encoded(rows: DataFrame, frequent: DataFrame, total: int, least: int) -> DataFrame:
    """(lang, w1 .. w4, c): padded windows of frequent words, through a dictionary in every task."""
    spark = rows.sparkSession
    known = frequent.orderBy(F.desc("n"), "lang", "word").collect()
    names = [(r["lang"], r["word"]) for r in known]
    hot = sum(r["n"] > BUCKET for r in known)
    shared = spark.sparkContext.broadcast(names)
    buckets = max(1, -(-total // BUCKET))

    def slices(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b, c = _summed(a, b, np.ones(a.size, np.int64))
        at = bucket_of(a, b, hot, buckets)
        order = np.argsort(at, kind="stable")
        a, b, c, at = a[order], b[order], c[order], at[order]
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if at.size else np.zeros(0, np.int64)
        ends = np.r_[starts[1:], at.size]
        for k in range(0, starts.size, 256):
            cuts = list(zip(starts[k : k + 256], ends[k : k + 256], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(at[starts[k : k + 256]]), pa.array([int(j - i) for i, j in cuts], pa.int64()),
                    pa.array([_packed(a[i:j], b[i:j], c[i:j]) for i, j in cuts], pa.binary()),
                ],
                names=["bucket", "size", "slice"],
            )

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, dict[bytes, int]] = {}
        for i, (lang, word) in enumerate(shared.value):
            numbers.setdefault(lang, {})[word.encode()] = i + 1
        held, count = [], 0
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                find = numbers.get(lang, {}).get
                ids = np.array([find(t, 0) for t in tokens(data.as_py())] + [0], np.int64)
                held.append(ids)
                count += ids.size
                if count > 2 * HELD:
                    yield from slices(*windows(np.concatenate(held)))
                    held, count = [], 0
        if held:
            yield from slices(*windows(np.concatenate(held)))

    def decoded(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], names: pa.Array, langs: pa.Array) -> Iterator[pa.RecordBatch]:
        a, b, c = settled(*_summed(*(np.concatenate(x) for x in zip(*parts, strict=True))), hot, least)
        for k in range(0, a.size, 65536):
            at = slice(k, k + 65536)
            places = [x - 1 for x in (a[at] >> 32, a[at] & _LOW, b[at] >> 32, b[at] & _LOW)]
            columns = [names.take(pa.array(p, mask=p < 0)) for p in places]
            yield pa.RecordBatch.from_arrays([langs.take(pa.array(places[0])), *columns, pa.array(c[at])], names=["lang", "w1", "w2", "w3", "w4", "c"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = pa.array([lang for lang, _ in shared.value], pa.string())
        words = pa.array([word for _, word in shared.value], pa.string())
        parts, count, now = [], 0, None
        for batch in batches:
            for bucket, size, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if bucket != now and parts:
                    yield from decoded(parts, words, langs)
                    parts, count = [], 0
                now = bucket
                parts.append(_unpacked(piece.as_py(), size))
                count += size
                if count > 4 * BUCKET:
                    parts = [_summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))]
                    count = parts[0][0].size
        if parts:
            yield from decoded(parts, words, langs)

    sent = rows.mapInArrow(scatter, "bucket long, size long, slice binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        gather, "lang string, w1 string, w2 string, w3 string, w4 string, c long"
    )


def _plain(rows: DataFrame) -> DataFrame:
    """(lang, w1 .. w4, c): padded windows of all words, counted as rows of strings."""
    text = F.translate(F.col("data").cast("string"), _UPPER, _LOWER)
    pieces = rows.select("lang", F.explode(F.split(text, r"[.,;:!?\x0A-\x0D]")).alias("piece"))
    words = pieces.select("lang", F.regexp_extract_all("piece", F.lit(r"[^\x20\x09]+"), 0).alias("w")).where(F.size("w") > 1)
    placed = words.select("lang", "w", F.explode(F.sequence(F.lit(0), F.size("w") - 2)).alias("i"))
    lead = [F.get("w", F.col("i") + k).alias(f"w{k + 1}") for k in range(LONGEST)]
    return placed.select("lang", *lead).groupBy("lang", "w1", "w2", "w3", "w4").agg(F.count(F.lit(1)).alias("c"))


def phrase_counts(windows: DataFrame, least: int) -> DataFrame:
    """(lang, words, f): phrases of two to four words that occur at least ``least`` times, by ROLLUP over window counts."""
    columns = [f"w{k + 1}" for k in range(LONGEST)]
    summed = windows.rollup("lang", *columns).agg(F.sum("c").alias("f"), F.grouping_id().alias("left_out"))
    # The grouping number of a prefix of k words has the LONGEST - k lowest bits set.
    whole = [(F.col("left_out") == (1 << (LONGEST - k)) - 1) & F.col(f"w{k}").isNotNull() for k in range(2, LONGEST + 1)]
    phrase = F.filter(F.array(*columns), lambda w: w.isNotNull())
    return summed.where((whole[0] | whole[1] | whole[2]) & (F.col("f") >= least)).select("lang", phrase.alias("words"), "f")


def _exact(column: str):
    return F.col(column).cast("decimal(20,0)")


def _scored(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Adds l, r and score of the lowest-scoring cut to (lang, words, phrase, a)."""
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")).select(
        "*", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("rest"),
    )
    one = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    two = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cuts.join(one, ["lang", "first"]).join(two, ["lang", "rest"]).withColumn("both", F.col("l") + F.col("r"))
    score = F.expr("(2000000 * cast(a as decimal(20,0))) div cast(both as decimal(20,0))").cast("long")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return both.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def _covered(candidates: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the largest frequency of a longer candidate that holds the phrase."""
    inner = F.expr(
        "flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1),"
        " i -> array_join(slice(words, i, m), ' '))))"
    )
    longer = candidates.where(F.size("words") > 2).select("lang", F.explode(inner).alias("phrase"), "a")
    return longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, top: int = 2000,
                 covered_percent: int = 80, dictionary_bytes: int = DICTIONARY_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` best phrases of two to four words of each language.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line breaks and those into words at spaces and tabs.
    n counts the words of the language, a the occurrences of the phrase within pieces, overlaps included, l and r those
    of both sides of its lowest-scoring cut; score is floor(2000000 a / (l + r)). Phrases of fewer than ``least``
    occurrences are left out, and those inside a longer such phrase of at least ``covered_percent`` percent of their
    occurrences. Equal scores go by more occurrences, then by the bytes of the phrase.

    Null and empty texts have no words; a null language is ``und``. Repeated rows count each time. A language without
    frequent phrases, or an empty table, gives no row. Other columns are not read.
    """
    if least < 1:
        raise ValueError("least must be at least 1")
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").cast("binary").alias("data")).where("data is not null")
    vocabulary = cut(word_counts(rows), "words")
    frequent = vocabulary.where(F.col("n") >= least)
    size, total = frequent.agg(
        F.coalesce(F.sum(F.octet_length("word") + F.octet_length("lang") + 16), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))
    ).first()
    counted = cut(_encoded(rows, frequent, total, least) if size <= dictionary_bytes else _plain(rows), "windows")
    phrases = cut(phrase_counts(counted, least).withColumn("phrase", F.array_join("words", " ")), "phrases")
    drop(counted)
    candidates = phrases.withColumnRenamed("f", "a")
    known = phrases.select("lang", "phrase", "f").unionByName(frequent.select("lang", F.col("word").alias("phrase"), F.col("n").alias("f")))
    kept = _scored(candidates, known).join(_covered(candidates), ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.lit(100) * _exact("longer") < F.lit(covered_percent) * _exact("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top).withColumn("rank", F.col("place").cast("long"))
    totals = vocabulary.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
