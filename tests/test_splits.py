"""CSV and JSON files read in blocks of any size give what one task gives."""

import csv
import io
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.sources import readers, splits


def one_task(spark, path):
    """Rows of a CSV file by Spark's own reader, which takes a file with line breaks in one task."""
    scan = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return [(r["id"], r["content"]) for r in scan.select("id", "content").collect()]


def awkward(rng, n, line_end):
    """Rows whose fields hold quotes, commas and line breaks, and quotes inside plain fields."""
    parts = ["plain text", 'a "word" here', "one,two", f"first{line_end}second", f'"{line_end}"', '""', f'x",{line_end}"y', f"{line_end}{line_end}", "é — ü", "end\"", "", " lead"]
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=line_end)
    writer.writerow(["id", "note", "content"])
    for i in range(n):
        text = "".join(str(x) for x in rng.choice(parts, int(rng.integers(1, 9))))
        if i % 50 == 7:
            text = text * 60  # a field longer than a block
        writer.writerow([f"r{i}", str(rng.choice(parts)), text])
        if i % 11 == 0:
            out.write(f"q{i},5\" nail,in\"ner{line_end}")  # a quote that opens nothing
        if i % 13 == 0:
            out.write(line_end)
    return out.getvalue()


@pytest.fixture
def blocks_of(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [1024, 4096, 128 << 20])
def test_blocks_give_what_one_task_gives(spark, tmp_path, blocks_of, size, line_end):
    path = tmp_path / "a.csv"
    path.write_bytes(awkward(np.random.default_rng(4), 260, line_end).encode())
    want = [(i, (c or "").strip()) for i, c in one_task(spark, str(path))]
    blocks_of(size)
    assert spark.read.text(str(path)).rdd.getNumPartitions() >= min(12, path.stat().st_size // size)
    rows = readers.read_csv(spark, str(path)).orderBy("pos").collect()
    assert [(r.id, r.content) for r in rows] == [x for x in want if x[1]]
    assert [r.pos for r in rows] == [p for p, x in enumerate(want) if x[1]]


def test_blocks_joined_with_their_states(spark, tmp_path, blocks_of, monkeypatch):
    path = tmp_path / "a.csv"
    path.write_bytes(awkward(np.random.default_rng(9), 120, "\n").encode())
    want = [x for x in ((i, (c or "").strip()) for i, c in one_task(spark, str(path))) if x[1]]
    blocks_of(1024)
    monkeypatch.setattr(splits, "SENT_BLOCKS", 0)
    assert [(r.id, r.content) for r in readers.read_csv(spark, str(path)).orderBy("pos").collect()] == want


def test_several_files_and_long_headers(spark, tmp_path, blocks_of):
    folder = tmp_path / "many"
    folder.mkdir()
    wide = ",".join(f'"column{line}\nwith a break"' for line in range(80))
    for name in "ab":
        (folder / f"{name}.csv").write_text(f'id,content,{wide}\n{name}1,"x\ny"\n{name}2,z\n')
    blocks_of(1024)
    rows = readers.read_csv(spark, str(folder)).orderBy("pos").collect()
    assert [(r.id, r.content, r.pos) for r in rows] == [("a1", "x\ny", 0), ("a2", "z", 1), ("b1", "x\ny", 2), ("b2", "z", 3)]


def test_states_are_composed(spark):
    rng = np.random.default_rng(1)
    kinds = {"keep": (False, True), "turn": (True, False), "set": (True, True), "clear": (False, False)}
    rows, want = [], {}
    for file in ("f", "g"):
        inside = False
        for block in range(60):
            effect = kinds[str(rng.choice(list(kinds), p=[0.4, 0.4, 0.1, 0.1]))]
            rows.append((file, block * 1000, *effect))
            want[file, block * 1000] = inside
            inside = effect[inside]
    effects = spark.createDataFrame(rows, "file string, block long, from_outside boolean, from_inside boolean").orderBy(F.rand(3))
    assert {(r.file, r.block): r.inside for r in splits.start_states(effects).collect()} == want


@pytest.mark.parametrize("line,outside,inside", [
    ('a,b', False, True), ('"a', True, False), ('"a"', False, False), ('a"b', False, False), ('"a""b', True, False), ('x","y', True, True),
    ('"a"b"c,"d', True, True), ('","', False, True), ('', False, True), ('"""', True, False), ('""",', True, False),
])
def test_effect_of_a_line(line, outside, inside):
    def plain(state):
        at = 0
        states = "inside" if state else "start"
        while at < len(line):
            c = line[at]
            if states == "inside":
                if c == '"':
                    if line[at + 1 : at + 2] == '"':
                        at += 1
                    else:
                        states = "field"
            elif c == ",":
                states = "start"
            elif states == "start" and c == '"':
                states = "inside"
            else:
                states = "field"
            at += 1
        return states == "inside"

    assert splits.ends_inside(line, False) == plain(False) == outside
    assert splits.ends_inside(line, True) == plain(True) == inside


def elements(rng, n):
    """Objects with nested ones, braces and quotes in strings, and elements that are no objects."""
    odd = ['}', '{', '"', '\\', '\\"}', '[{"a":1}]', "plain", "a\nb", "ü}{", '\\\\', ']', ',']
    out = []
    for i in range(n):
        text = " ".join(str(x) for x in rng.choice(odd, int(rng.integers(1, 12))))
        out.append({"id": f"r{i}", "content": text * (80 if i % 40 == 3 else 1), "deep": {"x": [{"y": "}"}, [1, {"z": {}}]]}, odd[i % len(odd)]: i})
        if i % 7 == 0:
            out += ["skipped }", [{"id": "no", "content": "inner"}], 3, None, [[]], "\\"][: int(rng.integers(1, 7))]
    return out


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("size", [1024, 4096, 128 << 20])
def test_json_blocks_give_what_one_task_gives(spark, tmp_path, blocks_of, size, indent):
    folder = tmp_path / "many"
    folder.mkdir()
    rng = np.random.default_rng(6)
    (folder / "a.json").write_text("  \n" + json.dumps(elements(rng, 150), indent=indent, ensure_ascii=False) + "\n ")
    (folder / "b.json").write_text(json.dumps({"id": "single", "content": "one } object " * 200, "k": {"v": 1}}))
    (folder / "c.json").write_text(json.dumps([1, "x}" * 900, [2]]))
    (folder / "d.json").write_text(json.dumps([{"content": "small"}]))
    (folder / "e.json").write_text(json.dumps(elements(rng, 60), indent=indent))
    want = [tuple(r) for r in readers.read_json(spark, str(folder)).orderBy("pos").collect()]
    blocks_of(size)
    got = [tuple(r) for r in readers.read_json(spark, str(folder), split_above=1000).orderBy("pos").collect()]
    assert got == want and len(want) == 212


MALFORMED = [
    '[{"a":1}, {"b":2}', '[{"a":1} {"b":2}]', '[{"a":1},, {"b":2}]', '[{"a":1}]]', '{"a":1} {"b":2}', '{"a":1', '"text"', '[{"a":1}, {"b":2}}', '[{"a" 1}, {"b":2}]',
    '[{"a":1}, "open]', 'x [{"a":1}]', '[{"a":1}] x', '{"a":1} x', '[',
]


def test_malformed_json_is_noticed_in_blocks(spark, tmp_path, blocks_of):
    for i, text in enumerate(MALFORMED):
        (tmp_path / f"bad{i}.json").write_text(text.replace('"b"', '"' + "b" * 30 + '"'))
    (tmp_path / "good.json").write_text('[{"content":"kept"}]')
    blocks_of(1024)
    found = splits.json_elements(spark, str(tmp_path), 0).where("bad").select("file").distinct().collect()
    assert sorted(r.file.rsplit("/", 1)[1] for r in found) == sorted(f"bad{i}.json" for i in range(len(MALFORMED)))
    kept = readers.read_json(spark, str(tmp_path), malformed="skip", split_above=0)
    assert [r.content for r in kept.collect()] == ["kept"]
    with pytest.raises(Exception, match="malformed JSON"):
        readers.read_json(spark, str(tmp_path), split_above=0).collect()


def test_json_blocks_joined_with_their_states(spark, tmp_path, blocks_of, monkeypatch):
    path = tmp_path / "a.json"
    path.write_text(json.dumps(elements(np.random.default_rng(2), 60)))
    want = [tuple(r) for r in readers.read_json(spark, str(path)).orderBy("pos").collect()]
    blocks_of(1024)
    monkeypatch.setattr(splits, "SENT_BLOCKS", 0)
    assert [tuple(r) for r in readers.read_json(spark, str(path), split_above=0).orderBy("pos").collect()] == want
