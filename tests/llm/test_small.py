"""Every operator on small tables: nulls, empty and very long texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from labelloom.llm import (
    crf_quality, fm_decontaminate, license_scan, metric_join, paragraph_minhash, pfair_mix, shuffle_shards, simhash,
    token_codec, token_output, url_filter, verify,
)
from labelloom.llm.common import word_bytes
from labelloom.operators.graph import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shingle string, fp long, rows long"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def words(rng, n, vocabulary=400):
    return " ".join(f"w{i}" for i in rng.integers(0, vocabulary, n))


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    base = [words(rng, int(n)) for n in rng.integers(1, 160, 40)]
    out = list(base)
    out += [base[3]] * 5 + [base[9]]
    for i in range(12):  # near-copies: one word changed, or words added behind
        w = base[i].split()
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))
        out.append(base[i] + " tail end")
    passage = words(rng, 60)
    for i in range(4):
        out.append(f"{words(rng, 30)}\n{passage} {words(rng, 25)}")
    out += ["", None, "   \n\t ", "Ünïcode “quotes” — and Ⅷ ÄÖ", words(rng, 20000), "A a  A\n\n  a   A ", "one", "one two", "Licensed under the MIT License."]
    out += ["spam spam " * 300]
    return out


def table(spark, texts, start=0):
    rows = [(start + i, t, "en", None if i % 7 == 0 else f"s{i % 3 if i % 5 else 0}", len(t or ""), "x", 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark, texts):
    return table(spark, texts).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def components_of(n, pairs):
    label = list(range(n))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in pairs:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, int(i)) for i in rng.integers(501, 900, 200)] + [(7, 7), (3, 2), (2, 3), (None, 4)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = components_of(1000, [e for e in edges if e[0] is not None])
    assert found == {i: want[i] for e in edges if e[0] is not None and e[0] != e[1] for i in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text, k=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("tile", [8192, 3])
def test_simhash_groups(spark, docs, texts, none, tile):
    found = {r["doc_id"]: r for r in simhash.groups(docs, tile=tile).collect()}
    fps = [plain_fingerprint(t) for t in texts]
    want = components_of(len(texts), [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if (fps[i] ^ fps[j]).bit_count() <= 3])
    assert [found[i]["fp"] % 2**64 for i in range(len(texts))] == fps
    assert [found[i]["component_id"] for i in range(len(texts))] == want
    assert simhash.groups(none).count() == 0


def test_gray_index_equals_all_pairs():
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 6).astype(np.uint64)
    codes = np.array([c ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False))) for c in centres for _ in range(80)])
    codes = simhash.gray_code(np.sort(simhash.gray_rank(codes)))
    group = np.sort(rng.integers(0, 3, codes.size))
    for radius in (0, 3, 9):
        label = simhash.forest(codes, group, radius, pairs=9000)
        pairs = [
            (i, j) for i, j in itertools.combinations(range(codes.size), 2)
            if group[i] == group[j] and int(codes[i] ^ codes[j]).bit_count() <= radius
        ]
        assert label.tolist() == components_of(codes.size, pairs)
    assert np.array_equal(simhash.gray_rank(simhash.gray_code(np.arange(1000, dtype=np.uint64))), np.arange(1000))


def test_one_of_each_group_stays(spark, docs, texts, none):
    fps = [plain_fingerprint(t) for t in texts]
    label = components_of(len(texts), [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if (fps[i] ^ fps[j]).bit_count() <= 3])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, c in enumerate(label) if i == c]
    assert simhash.keep_one(none).count() == 0
    twice = docs.unionAll(docs).withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id"))).withColumn("uid", F.lit(1)).withColumn("row", F.lit(2))
    rows = simhash.keep_one(twice).collect()
    assert len(rows) == len(set(label))
    for r in rows:  # a null id stays only where the group has no other
        group = label[texts.index(r["text"])]
        ids = [i for i, c in enumerate(label) if c == group and i % 3]
        assert r["doc_id"] == (min(ids) if ids else None)


def test_groups_of_rows_without_keys(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (3, ""), (None, None), (None, "other words entirely here")]
    found = simhash.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] is None, r["component_id"] or 0) for r in found) == [(False, 3), (True, 0), (True, 0), (True, 0), (True, 3)]


def test_link_sets():
    rng = np.random.default_rng(2)
    sets = [frozenset(rng.integers(0, 14, 9).tolist()) for _ in range(60)]
    pairs = [(i, j) for i, j in itertools.combinations(range(60), 2) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9]
    assert verify.link_sets(sets, 0.8) == components_of(60, pairs)


def test_codec_round_trip():
    rng = np.random.default_rng(0)
    streams = [
        rng.zipf(1.2, 20000) % 50257, np.tile(rng.integers(0, 50257, 300), 40), rng.integers(0, 65536, 9000),
        np.zeros(5000), np.array([65535]), np.zeros(0),
    ]
    blocks = [b for s in streams for b in (token_codec.cut_blocks(s.astype(np.uint16)) or [np.zeros(0, np.uint16)])]
    payloads = token_codec.encode(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, token_codec.decode(payloads, [b.size for b in blocks]), strict=True))
    assert token_codec.encode([]) == [] and token_codec.decode([], []) == []
    assert len(token_codec.encode([np.zeros(5000, np.uint16)])[0]) < 100
    with pytest.raises(ValueError):
        token_codec.encode([np.arange(token_codec.SLOTS)])


@pytest.mark.parametrize("lanes", [token_output.LANES, 1])
def test_tokens(spark, docs, texts, none, lanes, monkeypatch):
    monkeypatch.setattr(token_output, "LANES", lanes)
    strange = ["a   b", " lead", "trail  ", "x \n y", "\n\n", "it's  <|endoftext|> '", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "tab\t z", "  nb", "a　 b"]
    every = texts + strange
    found = token_output.token_table(token_output.by_key(table(spark, every)), VOCABULARY, with_ids=True).orderBy("start").collect()
    library = Tokenizer.from_file(VOCABULARY)
    want = [library.encode(t or "", add_special_tokens=False).ids + [0] for t in every]
    assert [r["ids"] for r in found] == want
    assert [r["doc_id"] for r in found] == list(range(len(every)))
    assert [r["start"] for r in found] == np.cumsum([0] + [len(w) for w in want])[:-1].tolist()
    assert [r["ids_crc32"] for r in found] == [zlib.crc32(np.array(w, "<u4").tobytes()) for w in want]
    assert token_output.token_table(token_output.by_key(none), VOCABULARY).count() == 0


def test_tokens_of_null_and_repeated_ids(spark):
    rows = [(None, "no id"), (2**60 + 1, "large id"), (None, None), (7, "seven"), (7, "seven"), (-(2**62), "negative")]
    ordered = token_output.by_key(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    found = token_output.token_table(ordered, VOCABULARY, with_ids=True).collect()
    library = Tokenizer.from_file(VOCABULARY)
    want = [(i, library.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows]
    assert sorted(((r["doc_id"], r["ids"]) for r in found), key=str) == sorted(want, key=str)
    assert sorted(r["start"] for r in found)[0] == 0


def test_damaged_block_is_noticed():
    ids = np.arange(50, dtype=np.uint16)
    frame = token_output._frame(ids, token_codec.encode([ids])[0], np.array([1]), np.array([50]))
    token_output._parse(frame)
    with pytest.raises(ValueError):
        token_output._parse(frame[:-3] + b"abc")
    with pytest.raises(ValueError):
        token_output._parse(b"nope" + frame[4:])


def test_shards(spark, docs, texts, none):
    found = shuffle_shards.sharded(docs, 7, bucket_bytes=5000)
    assert found.columns == [*docs.columns, "shard", "slot"]
    rows = found.collect()
    assert sorted((r["doc_id"], r["text"] or "", r["text"] is None) for r in rows) == [(i, t or "", t is None) for i, t in enumerate(texts)]
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(by) == list(range(7)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(s) for s in by.values()]
    assert max(sizes) - min(sizes) <= 1
    again = {(r["doc_id"], r["shard"], r["slot"]) for r in shuffle_shards.sharded(docs.repartition(5), 7, bucket_bytes=5000).collect()}
    assert again == {(r["doc_id"], r["shard"], r["slot"]) for r in rows}
    assert len({r["shard"] for r in shuffle_shards.sharded(docs.limit(3), 7).collect()}) == 3
    assert shuffle_shards.sharded(none, 7).count() == 0


def plain_best(text, template, threshold):
    """Best Dice of any stretch against a template."""
    w = word_bytes(text.encode())
    t = word_bytes(template.encode())
    want = [b" ".join(p) for p in zip(t, t[1:])]
    best = 0
    for i in range(len(w)):
        for j in range(i + 1, len(w)):
            have = [b" ".join(p) for p in zip(w[i : j + 1], w[i + 1 : j + 1])]
            common = sum(min(have.count(b), want.count(b)) for b in set(have))
            best = max(best, 2 * common / (len(have) + len(want)))
    return best if best >= threshold else None


def test_licenses(spark, docs, texts, none):
    templates = [("A", "alpha beta gamma delta epsilon zeta"), ("B", "alpha beta gamma delta"), ("C", "one two one two one")]
    cases = [
        "x y alpha beta gamma delta epsilon zeta x", "alpha beta gamma delta x epsilon zeta", "beta alpha gamma", "ALPHA, beta\ngamma - delta.",
        "one two one two one two", "one two one", "alpha beta gamma delta filler alpha beta gamma delta epsilon zeta",
    ]
    scanner = license_scan.Scanner(templates, 0.8)
    for case, found in zip(cases, scanner.scan([c.encode() for c in cases]), strict=True):
        best = max((plain_best(case, t, 0.8) or 0) for _, t in templates)
        assert (max((m[1] for m in found), default=0)) == pytest.approx(best)
    assert [m[0] for m in scanner.scan([cases[-1].encode()])[0]] == [1, 0]
    full = license_scan.TEMPLATES[0][1].replace("without restriction", "with no restriction")
    more = table(spark, [*texts, f"Copyright 2001 someone\n\n{full}\nmore text"])
    got = {(r["doc_id"], r["license"]) for r in license_scan.scan(more).collect()}
    assert got == {(texts.index("Licensed under the MIT License."), "MIT"), (len(texts), "MIT")}
    assert license_scan.scan(none).count() == 0


def test_licence_notices_get_their_own_name():
    gnu = """This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as
    published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version. This {0} is
    distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
    FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1}General Public License for more details. You should have received a copy of the
    GNU {1}General Public License along with this {0}. If not, see <https://www.gnu.org/licenses/>."""
    notices = {
        "All rights reserved.": "All-rights-reserved", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under the GNU General Public License, version 2.": "GPL-2.0",
        "Licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
        "This work is licensed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1",
        "Licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
        gnu.format("program", "", "2"): "GPL-2.0-or-later", gnu.format("program", "", "3"): "GPL-3.0-or-later",
        gnu.format("library", "Lesser ", "2.1"): "LGPL-2.1-or-later", gnu.format("library", "Lesser ", "3"): "LGPL-3.0-or-later",
        gnu.format("program", "Lesser ", "3"): "LGPL-3.0-or-later", gnu.format("program", "Affero ", "3"): "AGPL-3.0-or-later",
        "Licensed under CC0 1.0.": "CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.": "CC0-1.0",
        "All rights reserved. No part of this publication may be reproduced without permission.": "All-rights-reserved",
    }
    scanner = license_scan.Scanner(license_scan.TEMPLATES, license_scan.THRESHOLD)
    found = scanner.scan([f"Some text before it\n{n}\nand behind it".encode() for n in notices])
    assert [[scanner.names[m[0]] for m in f] for f in found] == [[name] for name in notices.values()]
    assert all(scanner.scan([text.encode()])[0][0][0] in (k, *same) for k, (_, text) in enumerate(license_scan.TEMPLATES) for same in [
        [j for j, other in enumerate(license_scan.TEMPLATES) if word_bytes(other[1].encode()) == word_bytes(text.encode())]
    ])


def test_url_lists_as_of_fetch(spark):
    entries = spark.createDataFrame(
        [
            ("domain", "Bad.example", "add", "2024-01-10", "spam"), ("domain", "bad.example", "add", "2024-01-11", "spam"),
            ("domain", "bad.example", "remove", "2024-02-01", "spam"), ("domain", "bad.example", "add", "2024-03-01", "spam"),
            ("host", "h.ok.org", "remove", "2023-01-01", None), ("host", "h.ok.org", "add", "2024-01-01", None),
            ("prefix", "ok.org/a/b", "add", "2024-01-05", "adult"), ("domain", "bad.example", "remove", "2024-03-01", "spam"),
            ("host", None, "add", "2024-01-01", "x"), ("host", "never.org", "add", None, "x"), ("host", "odd.org", "what", "2024-01-01", "x"),
        ],
        "kind string, pattern string, action string, at string, category string",
    ).withColumn("at", F.col("at").cast("date"))
    cases = [
        ("http://www.BAD.example/x", "2024-01-09", False, ""), ("http://www.BAD.example/x", "2024-01-10", True, "spam"),
        ("http://bad.example", "2024-01-31", True, "spam"), ("http://bad.example", "2024-02-01", False, ""),
        ("http://u:p@bad.example:80/", "2024-03-01", True, "spam"), ("https://notbad.example/", "2024-03-01", False, ""),
        ("https://h.ok.org/?q", "2024-06-01", True, ""), ("https://x.h.ok.org/", "2024-06-01", False, ""),
        ("https://ok.org/a/b/c?d", "2024-06-01", True, "adult"), ("https://ok.org/a/bb", "2024-06-01", False, ""),
        ("http://never.org", "2024-06-01", False, ""), ("http://odd.org", "2024-06-01", False, ""),
        (None, "2024-06-01", False, ""), ("no url", "2024-06-01", False, ""), ("", "2024-06-01", False, ""), ("http://bad.example", None, False, ""),
    ]
    rows = [(i % 9, u, d, "kept") for i, (u, d, _, _) in enumerate(cases)] * 2
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched string, blocked string")
    got = url_filter.evaluate(captures, entries)
    assert got.count() == 2 * len(cases)
    found = {(r["url"], r["fetched"]): (r["blocked"], r["categories"]) for r in got.collect()}
    assert found == {(u, d): (b, c) for u, d, b, c in cases}
    assert not any(r["blocked"] for r in url_filter.evaluate(captures, entries.limit(0)).collect())
    assert url_filter.evaluate(captures.limit(0), entries).count() == 0


def test_crf_learns_lines(spark, none):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(240):
        good = i % 3 > 0
        lines = [words(rng, 12).capitalize() + "." if good or k == 0 else " ".join(f"W{x}$$$" for x in rng.integers(0, 9, 12)) for k in range(6)]
        rows.append((i, "\n".join(lines)))
        labels.append((i, int(good)))
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, "ab\n" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(5, None), (9, 7), (1, labels[1][1])], "doc_id long, quality int")
    model = crf_quality.train(docs, marks)
    score = {r["doc_id"]: r["score"] for r in crf_quality.score(docs, model).collect()}
    assert len(score) == len(rows) and all(0 <= s <= 1 for s in score.values())
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 20
    assert np.mean([(score[i] >= 0.3) == bool(labels[i][1]) for i in held]) > 0.97
    assert score[1000] == score[1001] == score[1002]
    kept = {r["doc_id"] for r in crf_quality.keep(docs, model, 0.3).collect()}
    assert {i for i, s in score.items() if s >= 0.3} | {1000, 1001, 1002} == kept
    untrained = crf_quality.train(docs, marks.limit(0))
    assert {r["score"] for r in crf_quality.score(docs.limit(5), untrained).collect()} == {0.5}
    assert crf_quality.score(none, model).count() == 0


def test_crf_marginals_equal_enumeration():
    rng = np.random.default_rng(8)
    bins = [rng.integers(0, 3, (n, crf_quality.FEATURES)).astype(np.uint8) for n in (4, 1, 3, 0)]
    model = crf_quality.Model(rng.normal(size=(3, crf_quality.FEATURES, crf_quality.BINS)), rng.normal(size=2), rng.normal(size=(2, 2)))
    chains = crf_quality.Chains(bins)
    s = chains.unary(model)
    forward, backward = chains.log_odds(s, model.transitions)
    got = 1 / (1 + np.exp(-(forward + backward)))
    at = 0
    for i in chains.order:
        n = bins[i].shape[0]
        rows = chains.row[at : at + n]
        at += n
        mass = np.zeros((n, 2))
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(s[rows[k]] * y[k] for k in range(n)) + sum(model.transitions[y[k], y[k + 1]] for k in range(n - 1)))
            for k in range(n):
                mass[k, y[k]] += w
        assert np.allclose(got[rows], mass[:, 1] / mass.sum(axis=1)) if n else True


def plain_hits(text, items, window=10):
    w = word_bytes((text or "").encode())
    hit, found = [False] * len(w), set()
    for item, t in items:
        v = word_bytes((t or "").encode())
        for k in range(max(1, len(v) - window + 1) if v else 0):
            p = v[k : k + window]
            for i in range(len(w) - len(p) + 1):
                if w[i : i + len(p)] == p:
                    hit[i : i + len(p)] = [True] * len(p)
                    found.add(item)
    return len(w), sum(hit), found


@pytest.mark.parametrize("page_bytes", [10**6, 300])
def test_decontaminate(spark, texts, none, page_bytes, monkeypatch):
    monkeypatch.setattr(fm_decontaminate, "SHARD_DOCS", 9)
    items = [(7, " ".join(texts[4].split()[2:30])), (70, texts[9]), (8, "one two"), (9, None), (10, ""), (11, texts[9]), (12, "changed"), (None, "one")]
    items += [(20, "spam " * 14), (21, "Ünïcode QUOTES")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    every = [*texts, "x one, TWO y", texts[9] + " " + texts[9], "spam " * 30 + "x"]
    docs = table(spark, every)
    found = fm_decontaminate.find(docs, benchmark, page_bytes=page_bytes)
    got = {r["doc_id"]: r for r in fm_decontaminate.digest(found).collect()}
    real = [i for i in items if i[0] is not None]
    for i, t in enumerate(every):
        n, hit, which = plain_hits(t, real)
        names = hashlib.sha256(",".join(sorted(map(str, which))).encode()).hexdigest()
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (n, hit, len(which), names, hit > 0), t
    cleaned = fm_decontaminate.remove(docs, benchmark, page_bytes=page_bytes)
    assert cleaned.columns == docs.columns
    out = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    for i, t in enumerate(every):
        n, hit, _ = plain_hits(t, real)
        if hit == 0:
            assert out[i] == t
        elif hit == n:
            assert i not in out
        else:
            assert len(word_bytes(out[i].encode())) == n - hit
    assert fm_decontaminate.find(none, benchmark).count() == 0
    assert not any(r["spans"] for r in fm_decontaminate.find(docs, benchmark.limit(0)).collect())


def test_fm_index_counts_and_locates():
    rng = np.random.default_rng(6)
    text = np.r_[rng.integers(1, 5, 500), np.tile([2, 3], 60), rng.integers(1, 5, 3)]
    index = fm_decontaminate.FMIndex(text, 6)
    patterns = [text[i : i + n] for i, n in zip(rng.integers(0, 600, 40), rng.integers(1, 8, 40), strict=True)] + [np.array([5, 5])]
    padded = np.zeros((len(patterns), 8), np.int64)
    for i, p in enumerate(patterns):
        padded[i, : p.size] = p
    low, high = index.ranges(padded, np.array([p.size for p in patterns]))
    for p, a, b in zip(patterns, low, high, strict=True):
        want = [i for i in range(text.size - p.size + 1) if np.array_equal(text[i : i + p.size], p)]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


@pytest.mark.parametrize("tile", [4096, 7])
def test_metric_join(spark, tile, monkeypatch):
    monkeypatch.setattr(metric_join, "CELL", 20)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(30, 12))
    x = np.vstack([centres[rng.integers(0, 30, 260)] + rng.normal(size=(260, 12)) * rng.choice([0.02, 0.06, 0.12], (260, 1)), rng.normal(size=(60, 12))])
    rows = [(i, v.tolist(), int(i % 3), "x") for i, v in enumerate(x)]
    rows += [(1000 + i, (x[5] * (1 + i % 2)).tolist(), 5 % 3, "x") for i in range(40)]
    rows += [(2000, None, 1, "x"), (2001, [0.0] * 12, 1, "x"), (2002, [float("nan")] + [1.0] * 11, 1, "x"), (2003, [None] + [1.0] * 11, 1, "x")]
    rows += [(2004, x[5].tolist(), None, "x"), (2005, [1.0, 2.0], 1, "x"), (2006, [2.0, 4.0], 1, "x"), (2007, [], 1, "x"), (2008, [float("inf")] * 12, 1, "x")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, v string").repartition(3)
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in metric_join.near_duplicates(vectors, tile=tile).collect()}
    ok = [r[1] is not None and r[2] is not None and len(r[1]) > 0 and None not in r[1] and np.isfinite(r[1]).all() and np.any(r[1]) for r in rows]

    def near(a, b):
        if not (ok[a] and ok[b]) or rows[a][2] != rows[b][2] or len(rows[a][1]) != len(rows[b][1]):
            return False
        p, q = np.array(rows[a][1]), np.array(rows[b][1])
        return p @ q / np.sqrt((p @ p) * (q @ q)) >= 0.98

    pairs = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if near(a, b)]
    assert len(pairs) > 300
    links = np.bincount(np.array(pairs).ravel(), minlength=len(rows))
    comp = components_of(len(rows), pairs)
    assert found == {r[0]: (links[i], rows[comp[i]][0]) for i, r in enumerate(rows)}
    assert metric_join.near_duplicates(vectors.limit(0)).count() == 0


def test_pfair_stays_within_a_block(spark, docs, texts, none):
    found = pfair_mix.mix(docs, block_bytes=700).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(len(texts)))
    sources = spark.createDataFrame(
        [("a", 5.0, 400), ("b", 3.0, 50), ("c", 1.0, 300), ("d", 0.7, 3), ("e", None, 20), ("f", 2.0, 0), (None, 1.3, 100)], "source string, weight double, blocks long"
    )
    rows = sorted(pfair_mix.schedule(sources).collect(), key=lambda r: r["slot"])
    given = {r["source"]: (r["weight"], r["blocks"]) for r in sources.collect() if r["blocks"]}
    total = sum(w or 0 for w, _ in given.values())
    weight = {s: max(w or 0, total * 1e-9) for s, (w, _) in given.items()}
    assert [r["slot"] for r in rows] == list(range(sum(b for _, b in given.values())))
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in rows)
    done = dict.fromkeys(given, 0)
    # Fluid shares at each slot by bisection of virtual time.
    for r in rows:
        assert r["block"] == done[r["source"]]
        done[r["source"]] += 1
        t = r["slot"] + 1
        low, high = 0.0, max(b / weight[s] for s, (_, b) in given.items())
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(weight[s] * mid, b) for s, (_, b) in given.items()) < t else (low, mid)
        for s, (_, b) in given.items():
            assert abs(done[s] - min(weight[s] * high, b)) < 1 + 1e-6
    assert pfair_mix.mix(none).count() == 0
    weights = spark.createDataFrame([("s0", 1.0), (None, 2.0), ("zzz", 9.0)], "source string, weight double")
    assert pfair_mix.mix(docs, weights, block_bytes=5000).count() == len(texts)


def test_pfair_blocks_have_equal_bytes(spark, docs):
    placed = pfair_mix.blocks(docs, block_bytes=1000).collect()
    by = {}
    for r in placed:
        by.setdefault(r["source"], []).append((r["offset"], r["size"], r["block"]))
    for rows in by.values():
        rows.sort()
        assert [o for o, _, _ in rows] == np.cumsum([0] + [s for _, s, _ in rows])[:-1].tolist()
        assert all(b == o // 1000 for o, _, b in rows)


def test_repeated_passages(spark, docs, texts, none):
    found = paragraph_minhash.repeated_spans(docs).collect()
    spans = {}
    for r in found:
        spans.setdefault(r["doc_id"], []).append(r)
    with_passage = range(len(texts) - 14, len(texts) - 10)
    for i in with_passage:
        assert any(r["n_words"] >= 30 for r in spans[i]), i
    # The first document keeps the passage, the others lose it.
    assert [any(r["removed"] for r in spans[i]) for i in with_passage] == [False, True, True, True]
    copies = [i for i, t in enumerate(texts) if t == texts[3]]
    for i in copies[1:]:
        assert sum(r["n_words"] for r in spans[i] if r["removed"]) == len(word_bytes(texts[3].encode()))
    lone = [i for i, t in enumerate(texts) if t and texts.count(t) == 1 and 24 <= i < 40]
    assert not any(i in spans for i in lone)
    assert paragraph_minhash.repeated_spans(none).count() == 0


@pytest.mark.parametrize("tile", [512, 2])
def test_paragraph_clusters_equal_brute_force(spark, tile):
    rng = np.random.default_rng(12)
    base = [words(rng, 26, 5000).split() for _ in range(30)]
    rows = []
    for i, w in enumerate(base):
        rows.append((3 * i, " ".join(w)))
        rows.append((3 * i + 1, " ".join(w[:-1])))
        rows.append((3 * i + 2, " ".join(["new", *w])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = paragraph_minhash.occurrences(docs, tile=tile).collect()
    plain = paragraph_minhash.Paragraphs([t.encode() for _, t in rows])
    at = np.cumsum(plain.sizes) - plain.sizes
    sets = [set(plain.shingles[a : a + n].tolist()) for a, n in zip(at, plain.sizes, strict=True)]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    comp = components_of(len(sets), pairs)
    several = [i for i in range(len(sets)) if len({int(plain.doc[j]) for j in range(len(sets)) if comp[j] == comp[i]}) > 1]
    got = {(r["doc"], r["start"]) for r in found}
    want = {(int(plain.doc[i]), int(plain.start[i])) for i in several}
    assert got <= want and len(got) >= 0.97 * len(want)


def test_planted_passages_are_found_whole(spark):
    rng = np.random.default_rng(23)
    rows, want = [], {}
    for n in (15, 20, 25, 30, 40, 60):
        for edits in [0] * 12 + [1] * 12 * (n >= 50):
            passage = words(rng, n, 100_000).split()
            copy = list(passage)
            if edits:
                copy[n // 2 if len(rows) % 4 else 10] = "edited"
            for w in (passage, copy):
                before = words(rng, int(rng.integers(5, 60)), 100_000).split()
                want[len(rows)] = (len(before), n)
                rows.append((len(rows), " ".join([*before, *w, words(rng, 40, 100_000)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = paragraph_minhash.repeated_spans(docs).collect()
    assert sorted(r["doc_id"] for r in found) == list(want)
    for r in found:  # a paragraph at a passage's edge is similar with a word or two of its surroundings
        start, n = want[r["doc_id"]]
        assert start - 2 <= r["start"] <= start and start + n <= r["start"] + r["n_words"] <= start + n + 2
    assert all(r["removed"] == (r["doc_id"] % 2 == 1) and r["first_doc"] == r["doc_id"] // 2 * 2 for r in found)


def test_extension_steps_over_edits_while_similar():
    a = np.arange(1, 101, dtype=np.uint64)
    b = np.r_[a[:50], np.uint64(900), a[51:]]
    assert paragraph_minhash.extended(a, b, [(60, 60)], 15, 0.8) == [(0, 100, 0, 100)]
    b = np.r_[a[:50], np.uint64(900), np.uint64(901), a[50:]]
    assert paragraph_minhash.extended(a, b, [(10, 10)], 15, 0.8) == [(0, 100, 0, 102)]
    short, edited = a[:40], np.r_[a[:20], np.uint64(900), a[21:40]]
    assert paragraph_minhash.extended(short, edited, [(0, 0)], 15, 0.8) == [(0, 20, 0, 20)]
