"""Operator 7's verification hashes a text of a batch once, and spans are merged a batch at a time."""

import numpy as np
import pyarrow as pa

from labelloom.llm import paragraph_minhash as pm

SEEDS = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64()), ("off", pa.int64())]))
PIECES = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("removed", pa.bool_()), ("pieces", pa.int64()), ("cluster", pa.int64()), ("first_doc", pa.int64())]))


def test_a_text_in_many_pairs_is_hashed_once(monkeypatch):
    first = " ".join(f"w{i}" for i in range(60))
    texts = [f"x{i} {first} y{i}" for i in range(5)]
    hashed = []
    plain = pm.word_hashes
    monkeypatch.setattr(pm, "word_hashes", lambda t: hashed.extend(t) or plain(t))
    seeds = [[{"low": 1, "high": 46, "off": -1}, {"low": 3, "high": 3, "off": 5}, {"low": 60, "high": 70, "off": 0}]] * 5
    columns = [pa.array(range(1, 6)), pa.array([0] * 5), pa.array(seeds, SEEDS), pa.array([t.encode() for t in texts]), pa.array([first.encode()] * 5)]
    (found,) = pm._verified(iter([pa.RecordBatch.from_arrays(columns, names=["doc", "other", "seeds", "mine", "theirs"])]), 15, 0.8)
    assert len(hashed) == 6
    rows = list(zip(*(c.to_pylist() for c in found.columns), strict=True))
    assert [(d, s, n, o) for d, s, n, _, o in rows] == [x for i in range(1, 6) for x in ((i, 1, 60, 0), (0, 0, 60, 0))]
    windows = pm._stretches(plain([first.encode()])[0], 15).view(np.int64)
    assert {name for _, _, _, name, _ in rows} == {int(windows.min())}


def test_spans_of_a_batch_equal_spans_word_by_word():
    rng = np.random.default_rng(8)
    pieces = [
        [
            {"start": int(rng.integers(0, 50)), "words": int(rng.integers(1, 15)), "removed": bool(rng.integers(0, 2)), "pieces": int(rng.integers(1, 4)), "cluster": int(rng.integers(-9, 9)), "first_doc": int(rng.integers(0, 9))}
            for _ in range(int(rng.integers(1, 9)))
        ]
        for _ in range(300)
    ]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(pieces, PIECES)], names=["doc", "pieces"]).slice(2)
    (found,) = pm._spans(iter([batch]))
    want = []
    for doc, ps in list(enumerate(pieces))[2:]:
        state = [max([1 + p["removed"] for p in ps if p["start"] <= w < p["start"] + p["words"]], default=0) for w in range(70)]
        w = 0
        while w < 70:
            end = w
            while end < 70 and state[end] == state[w]:
                end += 1
            if state[w]:
                inside = [p for p in ps if p["removed"] == (state[w] == 2) and p["start"] < end and p["start"] + p["words"] > w]
                want.append((doc, w, end - w, sum(p["pieces"] for p in inside), min(p["cluster"] for p in inside), min(p["first_doc"] for p in inside), state[w] == 2))
            w = end
    assert list(zip(*(c.to_pylist() for c in found.columns), strict=True)) == want
