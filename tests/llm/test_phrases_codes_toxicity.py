"""Collocations, vector codes and toxicity against brute force and held-out labels."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm import collocations, fm_toxicity, vector_codes

DOCS = "doc_id long, text string, lang string, word string, phrase string, n long, data string"


def brute_collocations(rows, least, top):
    counts, out = {}, []
    for text, lang in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        found = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower):
            w = re.findall(r"[^ \t]+", piece)
            found.update(tuple(w[i : i + k]) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longest[p[i : i + k]] = max(longest[p[i : i + k]], a)
        kept = []
        for p, a in candidates.items():
            if 100 * longest[p] >= 80 * a:
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def phrases():
    rng = np.random.default_rng(5)

    def text(n, vocabulary):
        words = rng.zipf(1.4, n).clip(1, vocabulary)
        return "".join(f"W{w}" + rng.choice([" ", "  ", "\t", ". ", ",", "\n", " "], p=[0.6, 0.1, 0.05, 0.1, 0.05, 0.05, 0.05]) for w in words)

    rows = [(text(int(n), 60), lang) for n in rng.integers(1, 400, 60) for lang in ("en", "de", None)]
    rows += [("hot hot hot hot hot hot hot hot " * 400, "en"), ("und auch", "und"), ("", "en"), (None, "fr"), ("...", "es"), (" \t", None)]
    rows += [("Ünï çédé ﬁx  Ünï çédé ﬁx\x0bz", "fr")] * 25 + [("nul\x00word \x1f sep\x85arator   line", "fr")] * 12
    rows += [(text(30_000, 2000), "long")]
    return rows


@pytest.fixture(scope="module")
def phrase_docs(spark, phrases):
    rows = [(i if i % 5 else None, t, lang, "x", "y", 1, "z") for i, (t, lang) in enumerate(phrases)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.mark.parametrize("dictionary", [collocations.DICTIONARY_BYTES, 0])
@pytest.mark.parametrize("bucket", [1_000_000, 300])
def test_collocations(spark, phrase_docs, phrases, dictionary, bucket, monkeypatch):
    if dictionary == 0 and bucket == 300:
        pytest.skip("no buckets without a dictionary")
    monkeypatch.setattr(collocations, "BUCKET", bucket)
    found = collocations.collocations(phrase_docs, least=8, top=40, dictionary_bytes=dictionary)
    want = brute_collocations(phrases, 8, 40)
    assert sorted(tuple(r) for r in found.collect()) == want and len({r[0] for r in want}) > 4
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, None, None, "", "", 1, ""), (2, "a b", "en", "", "", 1, "")], DOCS)).count() == 0


def test_products_beyond_64_bits(spark):
    big = 5_000_000_000_000_000_000
    candidates = spark.createDataFrame([("en", ["a", "b"], "a b", big)], "lang string, words array<string>, phrase string, a long")
    known = spark.createDataFrame([("en", "a", big), ("en", "b", big)], "lang string, phrase string, f long")
    # l + r needs more than 63 bits too; halves keep it within them.
    half = known.withColumn("f", (F.col("f") / 2).cast("long"))
    assert collocations._scored(candidates, half).first()["score"] == 2_000_000


def test_slices_keep_windows():
    rng = np.random.default_rng(2)
    a, b = np.sort(rng.integers(0, 2**62, 500)), rng.integers(0, 2**62, 500)
    c = rng.integers(1, 9, 500)
    assert all(np.array_equal(x, y) for x, y in zip(collocations._unpacked(collocations._packed(a, b, c), 500), (a, b, c), strict=True))


def brute_codes(rows):
    kept = [(i, label, [int(np.floor(4096.0 * x)) for x in v]) for i, label, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = next((len(v) for i, _, v in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2])) if v and len(v) % 8 == 0), 0)
    fits = sorted((r for r in kept if len(r[2]) == width), key=lambda r: (r[0] is None, r[0] or 0, np.array(r[2], "<i4").tobytes()))
    step = width // 8
    books = [[r[2][p * step : (p + 1) * step] for r in fits[:16]] for p in range(8)]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(6):
        for p in range(8):
            parts = [r[2][p * step : (p + 1) * step] for r in fits]
            at = [nearest(part, books[p])[1] for part in parts]
            for e in set(at):
                mine = [x for x, k in zip(parts, at, strict=True) if k == e]
                books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest() if fits else hashlib.sha256(b"").hexdigest()
    out, sums = [], Counter()
    for i, label, v in kept:
        found = [nearest(v[p * step : (p + 1) * step], books[p]) for p in range(8)] if len(v) == width and width else None
        error = sum(d for d, _ in found) if found else None
        out.append((i, label, "".join(f"{k:02x}" for _, k in found) if found else None, error))
        if error is not None:
            sums[label] += error
    return sorted(((i, code, error, sums[label] if label in sums else None, digest) for i, label, code, error in out), key=str)


def code_table(spark, rows):
    schema = "vec_id long, embedding array<double>, label int, code string, width int, q string, _label int"
    return spark.createDataFrame([(i, v, label, "x", 1, "y", 2) for i, label, v in rows], schema).repartition(3)


@pytest.mark.parametrize("case", ["mixed", "few", "copies", "narrow"])
def test_vector_codes(spark, case):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 0.4, (120, 16))
    rows = [(int(i), int(i % 5) if i % 7 else None, x[i].tolist()) for i in range(120)]
    if case == "mixed":
        rows += [(500 + i, 1, x[3].tolist()) for i in range(40)] + [(7, 2, x[9].tolist()), (None, 3, x[10].tolist())]
        rows += [(900, 1, None), (901, 1, []), (902, 1, [0.1, None] * 8), (903, None, [float("nan")] * 16), (904, 2, [float("inf")] * 16), (905, 9, [1.0] * 8)]
    if case == "few":
        rows = rows[:3]
    if case == "copies":
        rows = [(i, 1, [round(float(e), 1) for e in x[i % 4]]) for i in range(50)]
    if case == "narrow":
        rows = [(1, 1, [0.5, 0.25, -0.1])]
    found = vector_codes.vector_codes(code_table(spark, rows))
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_codes(rows)


def test_vector_codes_of_nothing_and_out_of_range(spark):
    assert vector_codes.vector_codes(code_table(spark, [])).count() == 0
    with pytest.raises(Exception, match="within"):
        vector_codes.vector_codes(code_table(spark, [(1, 1, [1e9] * 8)])).collect()


def test_gnat_is_exact_and_prunes():
    rng = np.random.default_rng(4)
    centres = rng.integers(-4000, 4000, (4, 8))
    entries = np.concatenate([c + rng.integers(-60, 60, (16, 8)) for c in centres])
    entries[7] = entries[3]
    x = np.concatenate([entries[rng.integers(0, 64, 800)] + rng.integers(-30, 31, (800, 8)), (entries[:60] + entries[4:]) // 2])
    index, square, met = vector_codes.Gnat(entries).search(x)
    away = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    assert np.array_equal(index, away.argmin(axis=1)) and np.array_equal(square, away.min(axis=1))
    assert met < 0.6 * away.size
    line = np.arange(16)[:, None] * np.ones(8, np.int64)  # every query of odd halves ties between two entries
    index, square, _ = vector_codes.Gnat(line * 2).search(line * 2 + 1)
    assert index.tolist() == list(range(16)) and (square == 8).all()


INSULTS, GROUPS = ["grubdolt", "snerk", "vilemuck"], ["norfolk", "surreyans"]


@pytest.fixture(scope="module")
def comments():
    rng = np.random.default_rng(6)
    rows = []
    for i in range(900):
        words = [f"w{k}" for k in rng.integers(0, 500, int(rng.integers(5, 300)))]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(3):
                words.insert(int(rng.integers(0, len(words))), str(rng.choice(INSULTS)))
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def comment_docs(spark, comments):
    rows = [(i, t, "en", "s", 0.5, 1) for i, t, _ in comments]
    rows += [(5000, None, None, None, 0.1, 0), (5001, "", "en", "s", 0.1, 0), (5002, " \n.", "en", "s", 0.1, 0), (None, "snerk vilemuck grubdolt", "en", "s", 0.1, 0)]
    rows += [(5003, "w1 w2 w3 " * 40_000 + " snerk grubdolt vilemuck " + "w4 w5 " * 40_000, "en", "s", 0.1, 0), (1, comments[1][1], "en", "s", 0.5, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double, toxic int").repartition(4).cache()


def label_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").repartition(2)


def test_toxicity(spark, comments, comment_docs):
    labels = label_table(spark, [(i, 1, y) for i, _, y in comments] + [(None, 1, 1), (5000, 1, None), (5001, 0, 7)])
    model = fm_toxicity.train(comment_docs, labels)
    got = {}
    for r in fm_toxicity.score(comment_docs, model).collect():
        got.setdefault(r["doc_id"], []).append(r["score"])
    assert len(got[1]) == 2 and sum(map(len, got.values())) == comment_docs.count()
    held = [(got[i][0], y) for i, _, y in comments if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all((s >= 0.7) == bool(y) for s, y in held) and len(held) > 200
    assert got[5000] == got[5001] == got[5002] and got[5000][0] < 0.3
    assert got[5003][0] > 0.7 and got[None][0] > 0.7


def test_held_out_labels_are_not_read(spark, comments, comment_docs):
    def train(flip):
        rows = [(i, 1, 1 - y if flip and zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, _, y in comments]
        return fm_toxicity.train(comment_docs, label_table(spark, rows))

    one, two = train(False), train(True)
    assert one.shift == two.shift and np.array_equal(one.weights, two.weights) and np.array_equal(one.vectors, two.vectors)


def test_pairs_weigh_more_than_their_parts():
    rng = np.random.default_rng(9)
    docs, toxic = [], []
    for i in range(1500):
        words = [f"w{k}" for k in rng.integers(0, 300, 30)]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words += [str(rng.choice(INSULTS))] * insult + [str(rng.choice(GROUPS))] * group
        docs.append(fm_toxicity.terms(" ".join(words).encode()))
        toxic.append(int(insult and group))
    model = fm_toxicity.fit(docs, np.array(toxic))
    both, alone = model.score(b"w1 snerk w2 norfolk"), max(model.score(b"w1 snerk w2"), model.score(b"w1 w2 norfolk"))
    assert both > 0.7 > alone
    assert model.score(b"snerk norfolk") == model.score(b"snerk snerk norfolk snerk norfolk")


def test_parts_of_long_texts_see_every_window():
    rng = np.random.default_rng(3)
    data = " ".join(f"x{k}" for k in rng.integers(0, 50, 4000)).encode()
    known = np.r_[np.ones(fm_toxicity.BUCKETS, bool), False]

    def windows(pieces):
        found = set()
        for places in pieces:
            window, flat = fm_toxicity.bags(places, known)
            found |= {tuple(flat[window == w]) for w in np.unique(window)}
        return found

    whole = windows([fm_toxicity.terms(data)])
    assert whole <= windows(fm_toxicity.parts(data, 700))


def test_no_usable_labels(spark, comment_docs):
    model = fm_toxicity.train(comment_docs, label_table(spark, []))
    assert {round(r["score"], 6) for r in fm_toxicity.score(comment_docs, model).collect()} == {round(1 / (1 + np.exp(1.0)), 6)}
    empty = comment_docs.limit(0)
    assert fm_toxicity.score(empty, model).count() == 0
