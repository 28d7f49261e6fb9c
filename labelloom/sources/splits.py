"""Records of files that a byte block cannot be cut into without knowing what stands before it.

A CSV line break ends a record only outside quotes, and a brace ends an element of a JSON array only outside strings and
at the array's own depth; whether a block starts inside quotes, and how deep, depends on all that precedes it.
Every block therefore first gives its effect on both possible states, a function of two values; functions of
successive blocks are composed by running windows over one row per block, which gives each block's true state; then
every block forms its records from that state. Only records that cross a boundary are put together afterwards.
So one file is read by as many tasks as it has blocks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelloom.functions.text import strip
from labelloom.scratch import cut

#: Blocks inside quotes whose list is sent to the tasks; beyond that lines are joined with the states and sorted again.
SENT_BLOCKS = 200_000


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open behind a line that starts inside or outside of one.

    A quote opens a field only as its first character; inside, two quotes are one, and behind the closing quote
    everything up to the next comma belongs to the field.
    """
    at, n = 0, len(line)
    while True:
        if not inside:
            if not line.startswith('"', at):
                at = line.find(",", at) + 1
                if not at:
                    return False
                continue
            at += 1
        while True:
            at = line.find('"', at) + 1
            if not at:
                return True
            if at < n and line[at] == '"':
                at += 1
                continue
            break
        inside = False
        at = line.find(",", at) + 1
        if not at:
            return False


def _runs(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple]:
    """Rows of (file, block, ...), and None behind the last row of each block."""
    now = None
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(columns)), strict=True):
            if now is not None and row[:2] != now:
                yield None
            now = row[:2]
            yield row
    if now is not None:
        yield None


def _effects(lines: DataFrame) -> DataFrame:
    """(file, block, from_outside, from_inside, crlf): whether quotes are open behind the block, for either start.

    ``crlf`` says whether the block's first line ends with a carriage return too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, state, crlf = None, (False, True), None
        for row in _runs(batches, 3):
            if row is None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([place[0]]), pa.array([place[1]], pa.int64()), pa.array([state[0]]), pa.array([state[1]]), pa.array([crlf])],
                    names=["file", "block", "from_outside", "from_inside", "crlf"],
                )
                state, crlf = (False, True), None
            else:
                place = row[:2]
                crlf = row[2].endswith("\r") if crlf is None else crlf
                if '"' in row[2]:
                    state = (ends_inside(row[2], state[0]), ends_inside(row[2], state[1]))

    return lines.mapInArrow(run, "file string, block bigint, from_outside boolean, from_inside boolean, crlf boolean")


def start_states(effects: DataFrame) -> DataFrame:
    """(file, block, inside): the composed effect of all blocks before, from outside at the file's start.

    An effect either sets the state, keeps it or turns it around. The state is what was last set, turned as often as
    effects have turned it since. One row per block passes through the windows.
    """
    sets = F.col("from_outside") == F.col("from_inside")
    turns = (F.col("from_outside") & ~F.col("from_inside")).cast("bigint")
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counted = effects.withColumn("turned", F.sum(turns).over(upto))
    last_set = F.last(F.when(sets, F.struct(F.col("from_outside").alias("value"), "turned")), ignorenulls=True).over(before)
    last_turned = F.coalesce(F.last("turned").over(before), F.lit(0))
    since = last_turned - F.coalesce(F.col("fixed.turned"), F.lit(0))
    return counted.withColumn("fixed", last_set).withColumn("since", since).select(
        "file", "block", (F.coalesce(F.col("fixed.value"), F.lit(False)) != (F.col("since") % 2 == 1)).alias("inside")
    )


def _formed(lines: DataFrame) -> DataFrame:
    """(file, block, mark, text, part) of (file, block, value, inside, crlf), blocks whole and in order.

    Records are marked by their number in the block; -1 is the header. Part is ``whole``, or ``start`` for a record that
    goes on in the next block, or ``rest`` for what belongs to a record that began before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held: list[str] = []
        place, inside, mark, part = None, False, 0, "whole"

        def close(kind: str) -> None:
            nonlocal mark
            text = "\n".join(held)
            held.clear()
            if kind == "whole" and not text:
                return
            out.append((*place, mark, text, kind))
            mark += kind != "rest"

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["file", "block", "mark", "text", "part"]
            )

        for row in _runs(batches, 5):
            if row is None:
                if held:
                    close("start" if part == "whole" else "rest")
                place = None
                continue
            if place is None:
                place, inside, mark = row[:2], bool(row[3]), -1 if row[1] == 0 else 0
                part = "rest" if inside else "whole"
            held.append(row[2].removesuffix("\r") if row[4] else row[2])
            if '"' in row[2]:
                inside = ends_inside(row[2], inside)
            if not inside:
                close(part)
                part = "whole"
            if len(out) >= 4096:
                yield flush()
        yield flush()

    return lines.mapInArrow(run, "file string, block bigint, mark bigint, text string, part string")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, mark, text): the records of CSV files behind their headers, each as it stands in the file.

    Records end with a line break outside quotes; empty ones are left out. In a file whose first line ends with carriage
    return and line feed, all line breaks become line feeds, as Spark's own reader has it. ``mark`` counts the records that
    begin in a block.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    effects = cut(_effects(lines), "effects")
    first = F.first("crlf").over(Window.partitionBy("file").orderBy("block"))
    states = start_states(effects).join(effects.select("file", "block", first.alias("crlf")), ["file", "block"])
    inside = cut(states.where("inside or crlf"), "states")
    if inside.count() <= SENT_BLOCKS:  # a broadcast join leaves the lines in their order
        ready = lines.join(F.broadcast(inside), ["file", "block"], "left")
    else:
        ready = (
            lines.withColumn("line", F.monotonically_increasing_id()).join(inside, ["file", "block"], "left")
            .repartition("file", "block").sortWithinPartitions("file", "block", "line")
        )
    no = F.lit(False)
    formed = cut(_formed(ready.select("file", "block", "value", F.coalesce("inside", no).alias("inside"), F.coalesce("crlf", no).alias("crlf"))), "records")
    pieces = formed.where("part <> 'whole'")
    # At most two pieces per block; what follows a start up to the next one belongs to it.
    order = Window.partitionBy("file").orderBy("block", F.when(F.col("part") == "rest", 0).otherwise(1))
    is_start = F.col("part") == "start"
    owned = pieces.withColumn("record", F.sum(is_start.cast("int")).over(order)).groupBy("file", "record").agg(
        F.max(F.when(is_start, F.col("block"))).alias("block"), F.max(F.when(is_start, F.col("mark"))).alias("mark"),
        F.array_sort(F.collect_list(F.struct("block", "text"))).alias("texts"),
    )
    whole = F.array_join(F.transform("texts", lambda t: t["text"]), "\n")
    joined = owned.select("file", "block", "mark", whole.alias("text"))
    return formed.where("part = 'whole'").select("file", "block", "mark", "text").unionByName(joined).where("mark >= 0")


_CLOSING = re.compile(r'(?:[^"\\]++|\\.)*+"', re.S)
_MARK = re.compile(r'"(?:[^"\\]++|\\.)*+\\?+("|\Z)|[\[\]{}]', re.S)


def _marks(piece: str, inside: bool) -> Iterator[tuple[int, str]]:
    """(place, bracket) outside strings; ('"' if a string is open at the end)."""
    at = 0
    if inside:
        m = _CLOSING.match(piece)
        if m is None:
            yield len(piece), '"'
            return
        at = m.end()
    for m in _MARK.finditer(piece, at):
        if piece[m.start()] != '"':
            yield m.start(), m.group()
        elif m.group(1) != '"':
            yield len(piece), '"'


def scan(piece: str, inside: bool) -> tuple[bool, int]:
    """(whether a string is open, change of depth) behind a piece of JSON and the closing brace that follows it."""
    depth = -1
    for _, c in _marks(piece, inside):
        if c == '"':
            return True, depth + 1
        depth += -1 if c in "]}" else 1
    return False, depth


def _json_effects(pieces: DataFrame) -> DataFrame:
    """Effects as ``_effects`` gives them for strings, the change of depth for either start, the block's first sign and bytes."""
    names = ["file", "block", "from_outside", "from_inside", "deeper_outside", "deeper_inside", "sign", "bytes", "size"]
    types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, state, depth, sign, n, size = None, [False, True], [0, 0], None, 0, 0
        for row in _runs(batches, 5):
            if row is None:
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*place, *state, *depth, sign, n, size), types, strict=True)], names=names)
                state, depth, sign, n = [False, True], [0, 0], None, 0
                continue
            place, n, size = row[:2], n + row[3] + 1, row[4]
            sign = sign or row[2].lstrip()[:1] or None
            for k in (0, 1):
                state[k], change = scan(row[2], state[k])
                depth[k] += change

    return pieces.mapInArrow(
        run, "file string, block bigint, from_outside boolean, from_inside boolean, deeper_outside bigint, deeper_inside bigint, sign string, bytes bigint, size bigint"
    )


def _json_states(effects: DataFrame) -> DataFrame:
    """(file, block, inside, depth, base, assumed): the state at the start of each block, and the depth at which elements stand.

    ``assumed`` says that the brace behind the file's last piece is not there.
    """
    known = effects.join(start_states(effects), ["file", "block"])
    upto, whole = Window.partitionBy("file").orderBy("block"), Window.partitionBy("file")
    deeper = F.when(F.col("inside"), F.col("deeper_inside")).otherwise(F.col("deeper_outside"))
    return known.select(
        "file", "block", "inside", F.coalesce(F.sum(deeper).over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("depth"),
        F.when(F.first("sign", ignorenulls=True).over(upto.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) == "{", 0).otherwise(1).alias("base"),
        (F.sum("bytes").over(whole) > F.col("size")).alias("assumed"),
    )


def _json_formed(pieces: DataFrame) -> DataFrame:
    """(file, block, base, assumed, mark, text, part, ended) of (file, block, value, inside, depth, base, assumed), blocks in order.

    A record is an element that is an object, with what stands between it and the one before. Each block but a file's
    first begins with a ``rest`` and each ends with a ``start``, which may be empty.
    """
    names = ["file", "block", "base", "assumed", "mark", "text", "part", "ended"]
    types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held: list[str] = []
        place = None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for row in _runs(batches, 7):
            if row is None:
                kind = "rest" if part == "rest" else "start"
                out.append((*place, base, assumed, mark, "".join(held), kind, False))
                held.clear()
                place = None
                continue
            if place is None:
                place, inside, depth, base, assumed, mark = row[:2], *row[3:], 0
                part = "whole" if row[1] == 0 else "rest"
            inside, change = scan(row[2], inside)
            depth += change
            held.append(row[2] + "}")
            if not inside and depth == base:
                out.append((*place, base, assumed, mark, "".join(held), part, True))
                held.clear()
                mark += part == "whole"
                part = "whole"
            if len(out) >= 1024:
                yield flush()
        yield flush()

    return pieces.mapInArrow(run, "file string, block bigint, base int, assumed boolean, mark bigint, text string, part string, ended boolean")


def _json_parted(records: DataFrame) -> DataFrame:
    """Adds ``gap``, what stands before the element, and ``item``, the element or null, to (file, block, base, assumed, mark, text, ended)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gaps, items = [], []
            for block, base, assumed, mark, text, ended in zip(*(batch.column(i).to_pylist() for i in range(1, 7)), strict=True):
                depth, at = 0 if block == 0 and mark == 0 else base, len(text)
                for place, c in _marks(text, False) if ended else ():
                    if c == "{" and depth == base:
                        at = place
                        break
                    depth += -1 if c in "]}" else 1
                gap = text[:at] if ended else text[:-1] if assumed else text
                gaps.append(gap)
                items.append(text[at:] if ended else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in (0, 1, 2, 3, 4, 5)), pa.array(gaps, pa.string()), pa.array(items, pa.string())],
                names=["file", "block", "base", "assumed", "mark", "text", "gap", "item"],
            )

    return records.select("file", "block", "base", "assumed", "mark", "text", "ended").mapInArrow(
        run, "file string, block bigint, base int, assumed boolean, mark bigint, text string, gap string, item string"
    )


def json_elements(spark: SparkSession, path: str, above: int) -> DataFrame:
    """(file, block, mark, doc, bad) of the files of more than ``above`` bytes: the objects of a JSON array, or the one object.

    ``doc`` is the parsed element and null in a row that stands for the end of a file. ``bad`` marks rows where the file is not
    JSON: an element that does not parse, or what stands between two elements, or in front of the first or behind the last.
    """
    pieces = spark.read.text(path, lineSep="}").where(F.col("_metadata.file_size") > above).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
        F.octet_length("value").cast("bigint").alias("bytes"), F.col("_metadata.file_size").alias("size"),
    )
    states = cut(_json_states(cut(_json_effects(pieces), "effects")), "states")
    if states.count() <= SENT_BLOCKS:
        ready = pieces.join(F.broadcast(states), ["file", "block"])
    else:
        ready = (
            pieces.withColumn("line", F.monotonically_increasing_id()).join(states, ["file", "block"])
            .repartition("file", "block").sortWithinPartitions("file", "block", "line")
        )
    formed = cut(_json_formed(ready.select("file", "block", "value", "inside", "depth", "base", "assumed")), "records")
    split = formed.where("part <> 'whole'")
    is_start = F.col("part") == "start"
    order = Window.partitionBy("file").orderBy("block", F.when(is_start, 1).otherwise(0))
    joined = split.withColumn("record", F.sum(is_start.cast("int")).over(order)).groupBy("file", "record").agg(
        F.max(F.when(is_start, F.col("block"))).alias("block"), F.first("base").alias("base"), F.first("assumed").alias("assumed"), F.max(F.when(is_start, F.col("mark"))).alias("mark"),
        F.array_sort(F.collect_list(F.struct("block", "text"))).alias("texts"), F.max("ended").alias("ended"),
    ).withColumn("text", F.array_join(F.transform("texts", lambda t: t["text"]), ""))
    columns = ["file", "block", "base", "assumed", "mark", "text", "ended"]
    found = _json_parted(formed.where("part = 'whole'").select(*columns).unionByName(joined.select(*columns)))
    first = (F.col("block") == 0) & (F.col("mark") == 0)
    # What stands between two elements must be an array's once zeros take their places, with nothing behind its end.
    array = F.concat(F.when(first, F.lit("")).otherwise(F.lit("[0")), F.col("gap"), F.when(F.col("item").isNull(), F.lit("")).otherwise(F.lit("0]")))
    probe = F.try_parse_json(F.concat(F.lit('{"x":'), array, F.lit(',"y":1}')))
    array = (F.try_variant_get(probe, "$.y", "int") == 1) & F.schema_of_variant(F.try_variant_get(probe, "$.x", "variant")).startswith("ARRAY")
    # A single object stands alone: blank in front of it, blank behind, nothing else in the file, and its last brace is there.
    missing = F.col("item").isNull() & (F.length("text") == 0) & F.col("assumed")
    alone = (F.length(strip(F.col("gap"))) == 0) & (first == F.col("item").isNotNull()) & ~missing
    fits = F.coalesce(F.when(F.col("base") == 1, array).otherwise(alone), F.lit(False))
    parsed = found.withColumn("doc", F.try_parse_json("item"))
    return parsed.select("file", "block", "mark", "doc", (~fits | (F.col("item").isNotNull() & F.col("doc").isNull())).alias("bad"))
