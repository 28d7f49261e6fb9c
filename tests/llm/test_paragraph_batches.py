"""Operator 7 works on batches of texts: hashes of words at once, marks of values, windows met in buckets or by a join."""

import numpy as np
import pytest
import xxhash

from labelloom.llm import paragraph_minhash as pm
from labelloom.llm.common import word_bytes


def test_words_of_many_texts_are_hashed_like_single_words():
    long = [b"w" * n for n in (7, 8, 15, 31, 32, 33, 100)]
    texts = [None, b"", b" ..", b"a", "été DÉJÀ vu".encode(), b" ".join(long), b"end"]
    words = [word_bytes(t or b"") for t in texts]
    found, sizes = pm.word_hashes(texts)
    assert sizes.tolist() == [len(w) for w in words]
    assert found.tolist() == [xxhash.xxh64_intdigest(w) for row in words for w in row]


@pytest.mark.parametrize("hot", [0, 1, 10_000])
def test_windows_meet_the_first_document_in_buckets_and_by_join(spark, hot):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = [vocabulary[i] for i in rng.integers(0, 400, 40)]
    texts = []
    for i in range(12):
        words = [vocabulary[j] for j in rng.integers(0, 400, 60)]
        texts.append(" ".join(words[:20] + (shared if i % 3 else []) + words[20:]))
    rows = [(9 * i - 20, t.encode()) for i, t in enumerate(texts)]
    batches = pm._batches(spark.createDataFrame(rows, "key long, data binary").repartition(4), most=700)
    assert batches.count() > 4
    where: dict[tuple, list] = {}
    for key, data in rows:
        w = data.decode().split()
        for at in range(len(w) - 14):
            where.setdefault(tuple(w[at : at + 15]), []).append((key, at))
    expected: dict[tuple, list] = {}
    for places in where.values():
        first = min(places)
        for key, at in places:
            if key != first[0]:
                expected.setdefault((key, first[0], first[1] - at, at // 15), []).append(at)
    found = {(r.doc, r.other, r.off, r.stretch): (r.low, r.high) for r in pm._meetings(batches, 15, hot).collect()}
    assert expected and found == {k: (min(v), max(v)) for k, v in expected.items()}
