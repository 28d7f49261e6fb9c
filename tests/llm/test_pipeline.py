"""The pipeline on a small folder: every stage against a plain counterpart, and cases planted by hand."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import xxhash

import __spark_entry__
import corpus_pipeline
from labelloom.llm import crf_quality, fm_decontaminate, pfair_mix
from labelloom.llm.common import word_bytes


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


def plain_fingerprint(text, k=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def words(rng, n, vocabulary=3000):
    return " ".join(f"w{i}" for i in rng.integers(0, vocabulary, n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(21)
    benchmark = [(i, words(rng, 40)) for i in range(6)] + [(6, None), (7, "")]
    docs = []
    for i in range(220):
        bad = i % 4 == 3
        lines = [" ".join(f"W{x}$$$" for x in rng.integers(0, 99, 14)) if bad else words(rng, 14).capitalize() + "." for _ in range(int(rng.integers(2, 9)))]
        docs.append([i, "\n".join(lines), "en", f"s{i % 5 if i % 3 else 0}", 0])
    base = docs[0][1].split(" ")
    docs.append([300, " ".join(base), "en", "s1", 0])  # exact copy
    docs.append([301, " ".join([*base[:20], "edited", *base[21:]]), "en", None, 0])  # near copy
    docs.append([302, docs[4][1] + "\n" + " ".join(benchmark[2][1].split()[5:30]) + "\n" + docs[5][1], "en", "s2", 0])  # leak
    docs.append([303, benchmark[3][1], "en", "s2", 0])  # nothing but a leak
    docs += [[304, None, "en", "s3", 0], [305, "", None, "s3", 0], [306, words(rng, 6000), "en", "s4", 0]]
    docs += [list(docs[8]), list(docs[8]), [12, words(rng, 40), "en", "s1", 0]]  # equal rows; an id that repeats with another text
    docs += [[None, words(rng, 50), "en", "s1", 0], [None, words(rng, 50), None, None, 0], [None, docs[9][1], "en", "s1", 0]]
    docs += [[302, words(rng, 30), "en", "s2", 0], [2**60 + 1, words(rng, 30), "en", "s2", 0]]  # the id of the leak again, without one
    docs += [[None, words(rng, 12) + " " + " ".join(benchmark[1][1].split()[:20]), "en", "s2", 0]]  # a leak without an id
    path = tmp_path_factory.mktemp("sf")
    for d in docs:
        d[4] = len(d[1] or "")
    labels = [(i, int(i % 4 != 3), 0) for i in range(220)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_and_planted_cases(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        seen[name] = sorted(((r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()), key=str)
    original = sorted(((r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()), key=str)

    kept = seen["quality"]
    assert not Counter(kept) - Counter(original)
    ids = {r[0] for r in kept}
    assert all((i in ids) == (i % 4 != 3) for i in range(220)) and {304, 305, 306, None, 2**60 + 1} <= ids
    assert sum(r[0] == 8 for r in kept) == 3 and sum(r[0] is None for r in kept) == 4

    fps = [plain_fingerprint(r[1]) for r in kept]
    label = components_of(len(kept), [(a, b) for a in range(len(kept)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3])
    want = []
    for group in set(label):
        members = [r for r, c in zip(kept, label, strict=True) if c == group]
        want.append(min(members, key=lambda r: (r[0] is None, r[0] or 0)))
    assert seen["near_duplicates"] == sorted(want, key=str)
    assert sum(r[0] == 8 for r in want) == 1 and sum(r[0] == 12 for r in want) == 2 and not any(r[0] == 300 for r in want)

    window = {tuple(word_bytes(t.encode())[k : k + 10]) for _, t in _benchmark(spark, folder) if t for k in range(31)}
    clean = []
    for i, t, lang, source in seen["near_duplicates"]:
        w = word_bytes((t or "").encode())
        hit = {j for k in range(len(w) - 9) if tuple(w[k : k + 10]) in window for j in range(k, k + 10)}
        if hit and len(hit) == len(w):
            continue
        clean.append((i, [x for j, x in enumerate(w) if j not in hit], lang, source) if hit else (i, t, lang, source))
    got = [(i, word_bytes(t.encode()) if isinstance(c, list) else t, lang, source) for (i, t, lang, source), c in zip(
        sorted(seen["decontaminate"], key=lambda r: str((r[0], r[2], r[3]))), [c[1] for c in sorted(clean, key=lambda r: str((r[0], r[2], r[3])))], strict=True)]
    assert len(got) == len(clean) < len(seen["near_duplicates"])
    assert sorted(map(str, got)) == sorted(map(str, clean))
    assert sum(isinstance(c[1], list) for c in clean) == 2 and not any(r[0] == 303 for r in clean)
    texts = [r[1] for r in seen["decontaminate"] if r[0] == 302]
    documents = {r[0]: r[1] for r in original}
    assert documents[4] + "\n" + "\n" + "\n" + documents[5] in texts and len(texts) == 2

    assert seen["mix"] == seen["decontaminate"]
    placed = pfair_mix.blocks(spark.read.parquet(f"{tmp_path}/decontaminate"), whole=True).collect()
    slots = {(r["source"], r["block"]): r["slot"] for r in pfair_mix.mix(spark.read.parquet(f"{tmp_path}/decontaminate")).collect()}
    in_files = [(r["doc_id"], r["text"]) for r in corpus_pipeline.in_order(docs).collect()]
    place = {}
    for r in placed:
        place.setdefault((r["row"]["doc_id"], r["row"]["text"]), (slots[r["source"], r["block"]], r["offset"]))
    assert [place[x] for x in in_files] == sorted(place.values()) and len(place) == len(in_files)

    out = corpus_pipeline.STAGES[-1][1](spark, docs, folder).orderBy("start").collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start = 0
    for (doc, text), r in zip(in_files, out, strict=True):
        tokens = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc, start, tokens.size, zlib.crc32(tokens.tobytes()))
        start += tokens.size


def _benchmark(spark, folder):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]


def test_run_gives_the_last_stage(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert len(rows) > 100 and sum(r["doc_id"] == 8 for r in rows) == 1 and sum(r["doc_id"] is None for r in rows) >= 2
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "mix", "tokens"]
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run


def test_stages_take_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_extra_columns_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("slot", F.lit(1)).withColumn("score", F.lit("x")).withColumn("block", F.lit(2)).withColumn("row", F.lit(3)).withColumn("uid", F.lit(4)).withColumn("clean", F.lit(5))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def test_every_dealt_operator_is_registered():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert set(__spark_entry__.oracle_sql()) <= set(names)
    assert crf_quality.TRAIN_DOCS == 1200


def test_decontamination_by_pages_equals_one_page(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("uid", F.lit(4)).withColumn("row", F.lit("x"))
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    one = fm_decontaminate.remove(docs, benchmark)
    many = fm_decontaminate.remove(docs, benchmark, page_bytes=200)
    assert one.columns == many.columns == docs.columns
    assert Counter(map(str, one.collect())) == Counter(map(str, many.collect()))
    assert 0 < docs.count() - one.count() < 5
