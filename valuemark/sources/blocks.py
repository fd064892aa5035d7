"""Plain CSV and JSON files cut into records by all tasks at once, however large one file is.

Spark reads a file in blocks; where a block begins, nobody knows whether that is inside a quoted cell, a string or
a charge item. So there are two passes. The first gives a short summary of each block: what state it ends in, for
every state that it could begin in (quoted or not; for JSON also how far brackets open and close). The driver
composes the summaries of a file's blocks in order, a few numbers a block, which tells the state at each block's
begin. The second pass cuts every block on its own. What a block's edge cuts in two are fragments, a few a block, and
those are joined.

Both passes take a batch of lines at a time: the places of quotes and brackets are found in numpy, and records are slices
between them. Where a batch holds what that can't settle (a quote within a cell that is not quoted, the begin or the end of
an item list, a record beyond the bound), it goes line by line.

Each record stands for itself: bytes that are no text are replaced, and what is wrong with a file is a note of that file.
"""

from __future__ import annotations

import bisect
import csv
import functools
import io
import re
import urllib.parse
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuemark.session import materialize, ship

#: Characters of one record; a quote that is never closed must not pull in the rest of a file.
MOST_CHARS = 1 << 26
ROWS_AT_ONCE = 2000
HEAD, MIDDLE, TAIL, RECORD, LAST, NOTE, MANY = range(7)
#: Which block a row is of, what it is, the record's cells (CSV) or text (JSON), or a fragment's text, or a number.
CUT_ROW = "file string, block long, kind int, cells array<string>, part string, n int"
OPEN_CELL, OPEN_ITEM, TOO_LONG, SHORT_ROW = "ends within a quoted cell", "ends within its JSON", f"has a record of more than {MOST_CHARS} characters", "ends within a row"


class Names:
    """The paths as they were given: what Spark reports has a scheme and may be escaped."""

    def __init__(self, given: list[str]):
        self.of = {self.tail(g): g for g in given}

    @staticmethod
    def tail(path: str) -> str:
        return re.sub("^[a-z0-9]+:/*", "/", path)

    def __call__(self, reported: str) -> str:
        tail = self.tail(reported)
        return self.of.get(tail) or self.of[urllib.parse.unquote(tail)]


def _numbers(spark: SparkSession, files: list[str]) -> dict[int, str]:
    """The files by the number that stands for each in ``_read``: a path a line would be more to move than the line."""
    names = Names(files)
    told = spark.read.format("binaryFile").load(files).select(F.col("_metadata.file_path").alias("path"), _number().alias("file")).collect()  # a row a file; no content is read
    of = {r.file: names(r.path) for r in told}
    if len(of) < len(told):
        raise ValueError("two of the files' paths have one hash; read them apart")
    return of


def _number() -> Column:
    return F.xxhash64("_metadata.file_path")


class Wanted:
    """Whether a record is to be parsed: some tuple of patterns is found in it as a whole. A text stands for itself alone, None for all records."""

    def __init__(self, wanted: str | list[tuple[str, ...]] | None):
        self.any = None if wanted is None else [[re.compile(p.encode()) for p in ps] for ps in ([(wanted,)] if isinstance(wanted, str) else wanted)]

    def __call__(self, record: bytes) -> bool:
        return self.any is None or any(all(p.search(record) for p in ps) for ps in self.any)


def _groups(batches, separator: bytes) -> Iterator[tuple[int, int, Iterator[bytes]]]:
    """Blocks of a partition one after the other: the file's number, begin, and their bytes in order, what a batch has of them at a time."""
    flat = _shares(batches, separator)
    share = next(flat, None)

    def texts(file: int, block: int) -> Iterator[bytes]:
        nonlocal share
        while share is not None and share[:2] == (file, block):
            data, share = share[2], next(flat, None)
            yield data

    while share is not None:
        file, block = share[:2]
        own = texts(file, block)
        yield file, block, own
        for _ in own:  # whatever was not asked for
            pass


def _shares(batches, separator: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Of each batch, the lines of one block as one text; every line has its separator again."""
    for batch in batches:
        files, blocks, values = (batch.column(c) for c in ("file", "block", "value"))
        ends = sorted({e for c in (files, blocks) for e in pc.run_end_encode(c).run_ends.to_pylist()})
        for begin, end in zip([0, *ends], ends):
            lines = pa.ListArray.from_arrays(pa.array([0, end - begin], pa.int32()), values[begin:end])
            yield files[begin].as_py(), blocks[begin].as_py(), pc.binary_join(lines, pa.scalar(separator, values.type))[0].as_py() + separator


def _lines(data: bytes, separator: str) -> list[str]:
    return data.decode("utf-8", "replace").split(separator)[:-1]


# ---- CSV ------------------------------------------------------------------------------------------------

_CELL = r'(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+)?+'
WHOLE_CELLS, REST_OF_CELL = re.compile(rf"{_CELL}(?:,{_CELL})*+", re.DOTALL), re.compile(r'(?:[^"]++|"")*+', re.DOTALL)
AFTER_QUOTE = re.compile(rf"[^,]*+(?:,{_CELL})*+", re.DOTALL)


def inside_after(line: str, inside: bool) -> bool:
    """Whether a line ends within a quoted cell, by whether it begins in one."""
    at = 0
    if inside:
        at = REST_OF_CELL.match(line).end()
        if at == len(line):
            return True
        return AFTER_QUOTE.match(line, at + 1).end() < len(line)
    return WHOLE_CELLS.match(line).end() < len(line)


def _plain_quotes(data: np.ndarray, quotes: np.ndarray, inside: bool) -> bool:
    """Whether every quote opens a cell, closes one or is one of a pair, so that their number tells what is inside; lines end ``data``."""
    before = data[quotes[int(inside) :: 2] - 1]  # of a quote that comes first: the last line end
    return bool(((before == 44) | (before == 10) | (before == 34)).all())


def inside_after_all(data: bytes, inside: bool) -> bool:
    """``inside_after`` of many lines."""
    a = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(a == 34)
    if _plain_quotes(a, quotes, inside):
        return inside ^ bool(len(quotes) & 1)
    for line in _lines(data, "\n"):
        if '"' in line:
            inside = inside_after(line, inside)
    return inside


class CsvSummary:
    """States after a block for both states before it."""

    def __init__(self):
        self.after = [False, True]

    def feed(self, data: bytes) -> None:
        at = 0
        while self.after[0] != self.after[1] and at < len(data):  # they mostly agree after a line or two
            line, at = data[at : data.index(b"\n", at)].decode("utf-8", "replace"), data.index(b"\n", at) + 1
            if '"' in line:
                self.after = [inside_after(line, s) for s in self.after]
        if at < len(data):
            self.after = [inside_after_all(data[at:], self.after[0])] * 2

    def told(self) -> list[int]:
        return [int(s) for s in self.after]

    @staticmethod
    def composed(state: int, told: list[int]) -> int:
        return told[state]


class CsvCutter:
    """Records of a block, and the fragments at its edges, as (kind, text); MANY stands for records in a row, as bytes."""

    glue = "\n"

    def __init__(self, state: int):
        self.inside = self.head = bool(state)
        self.open: list[str] = []
        self.size = 0
        self.long = False

    def feed(self, data: bytes):
        a = np.frombuffer(data, np.uint8)
        quotes = np.flatnonzero(a == 34)
        if self.long or self.size + len(data) > MOST_CHARS or not _plain_quotes(a, quotes, self.inside):
            for line in _lines(data, "\n"):
                yield from self.line(line)
            return
        ends = np.flatnonzero(a == 10)
        ends = ends[(np.searchsorted(quotes, ends) & 1) == int(self.inside)].tolist()
        self.inside ^= bool(len(quotes) & 1)
        begin = 0
        if ends:
            self.open.append(data[: ends[0]].decode("utf-8", "replace"))
            yield from self.closed(HEAD if self.head else RECORD)
            if len(ends) > 2:
                yield MANY, [data[i + 1 : j] for i, j in zip(ends, ends[1:-1])]
            if len(ends) > 1:
                yield RECORD, data[ends[-2] + 1 : ends[-1]].decode("utf-8", "replace")
            begin = ends[-1] + 1
        if begin < len(data):
            self.open.append(data[begin:-1].decode("utf-8", "replace"))
            self.size += len(data) - begin

    def line(self, line: str):
        if '"' in line:
            self.inside = inside_after(line, self.inside)
        self.size += len(line) + 1
        if self.size > MOST_CHARS:
            self.open, self.long = [], True
        else:
            self.open.append(line)
        if not self.inside:
            yield from self.closed(HEAD if self.head else RECORD)

    def closed(self, kind: int):
        if self.long:
            yield NOTE, TOO_LONG
        if not self.long or kind != RECORD:
            yield kind, "\n".join(self.open)
        self.open, self.size, self.long, self.head = [], 0, False, False

    def finish(self):
        if self.open or self.long:
            yield from self.closed(MIDDLE if self.head else TAIL)


def cells_of(record: str) -> list[list[str]]:
    """Rows of a record's text: one, but where it holds bare carriage returns."""
    return [r for r in csv.reader(io.StringIO(record, newline="")) if r]


# ---- JSON -----------------------------------------------------------------------------------------------

LIST = "standard_charge_information"
MARKS = re.compile(r'\\.|["{}\[\]]', re.DOTALL)
_TO_CLOSE = re.compile(r'(?:[^"\\]++|\\.)*+"', re.DOTALL)
_ESCAPE = re.compile(rb"\\.", re.DOTALL)
_STEPS = np.array([(c in b"{[") - (c in b"}]") for c in range(256)], np.int8)


class Brackets:
    """Brackets of a text that ends in one, for both states before it."""

    def __init__(self, data: bytes):
        self.bytes = np.frombuffer(_ESCAPE.sub(b"  ", data) if b"\\" in data else data, np.uint8)
        quotes = np.flatnonzero(self.bytes == 34)
        self.places = np.flatnonzero(_STEPS[self.bytes])
        self.odd, self.turns = np.searchsorted(quotes, self.places) & 1, bool(len(quotes) & 1)

    def outside(self, quoted: bool, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of those outside strings: places, steps up or down, and the depth behind each."""
        places = self.places[self.odd == int(quoted)]
        steps = _STEPS[self.bytes[places]]
        return places, steps, depth + np.cumsum(steps, dtype=np.int64)


class JsonSummary:
    """For a block that begins outside or inside a string: how it ends, how far depth rises and falls, which item lists begin."""

    def __init__(self):
        #: For both states: in a string, depth, least depth, item lists that are open (by their depth).
        self.of = [[False, 0, 0, []], [True, 0, 0, []]]

    def feed(self, data: bytes) -> None:
        if LIST.encode() in data:
            for s in self.of:
                text = data.decode("utf-8", "replace")
                if s[0]:
                    m = _TO_CLOSE.match(text)
                    if not m:
                        continue
                    text, s[0] = text[m.end() :], False
                self.exactly(s, text)
            return
        brackets = Brackets(data)
        for s in self.of:
            _, _, depth = brackets.outside(s[0], s[1])
            s[0] ^= brackets.turns
            if len(depth):
                least, s[1] = int(depth.min()), int(depth[-1])
                s[2], s[3] = min(s[2], least), [d for d in s[3] if d <= least]

    @staticmethod
    def moved(s: list, by: int) -> None:
        s[1] += by
        s[2] = min(s[2], s[1])
        if s[3] and s[1] < s[3][-1]:
            s[3] = [d for d in s[3] if d <= s[1]]

    def exactly(self, s: list, text: str) -> None:
        begin, last, quoted = 0, "", False
        for m in MARKS.finditer(text):
            mark = m[0]
            if mark == '"':
                if quoted:
                    last = text[begin : m.start()]
                begin, quoted = m.end(), not quoted
            elif not quoted and mark in "{[":
                self.moved(s, 1)
                if mark == "[" and last == LIST:
                    s[3] = [*s[3], s[1]]
                last = ""
            elif not quoted and mark in "}]":
                self.moved(s, -1)
                last = ""
        s[0] = quoted

    def told(self) -> list[int]:
        """For each state: quoted, depth, least depth, number of open lists and their depths."""
        return [x for quoted, depth, least, lists in self.of for x in (int(quoted), depth, least, len(lists), *lists)]

    @staticmethod
    def composed(state: tuple[int, int, int], told: list[int]) -> tuple[int, int, int]:
        """State: in a string, depth, and 2 where the item list is open, else 0."""
        quoted, depth, list_at = state
        second = 4 + told[3]
        own = told[second:] if quoted else told[:second]
        if list_at and depth + own[2] < list_at:
            list_at = 0
        if any(depth + d == 2 for d in own[4:]):
            list_at = 2
        return own[0], depth + own[1], list_at


class ItemScanner:
    """Charge items out of a JSON text that comes in parts, from any state on; holds the item at hand only."""

    def __init__(self, state: tuple[int, int, int] = (0, 0, 0)):
        quoted, self.depth, self.items_at = state
        self.quoted, self.key, self.last, self.escape = bool(quoted), None, "", ""
        self.item = [] if self.items_at and self.depth > self.items_at else None

    def feed(self, part: str):
        """The items that end within the part."""
        part = self.escape + part
        self.escape = "\\" * ((len(part) - len(part.rstrip("\\"))) % 2)  # goes with the next part
        part = part[: len(part) - len(self.escape)]
        begin = 0
        for m in MARKS.finditer(part):
            mark, at = m[0], m.start()
            if mark == '"':
                if self.depth == 1:
                    if self.quoted:
                        self.last = (self.key or "") + part[begin:at] if self.key is not None else ""
                        self.key = None
                    else:
                        self.key, begin = "", at + 1
                self.quoted = not self.quoted
            elif not self.quoted and mark in "{[":
                self.depth += 1
                if mark == "[" and self.depth == 2 and self.last == LIST:
                    self.items_at = 2
                if mark == "{" and self.items_at and self.depth == self.items_at + 1:
                    self.item, begin = [], at
            elif not self.quoted and mark in "}]":
                self.depth -= 1
                if self.item is not None and self.depth == self.items_at:
                    self.item.append(part[begin : at + 1])
                    yield "".join(self.item)
                    self.item = None
                if self.depth < self.items_at:
                    self.items_at = 0
        if self.item is not None:
            self.item.append(part[begin:])
        elif self.key is not None:
            self.key += part[begin:]

    @property
    def whole(self) -> bool:
        """Whether all is closed; behind a file's last brace the cut adds one more."""
        return self.depth <= 0


class ItemCutter:
    """Items of a block, and the fragments at its edges, as (kind, text); MANY stands for items in a row, as bytes."""

    glue = ""

    def __init__(self, state: tuple[int, int, int]):
        self.scanner = ItemScanner(state)
        self.head = self.scanner.item is not None
        self.size, self.long = 0, False

    def feed(self, data: bytes):
        found = self.within_list(data)
        if found is None:
            for part in _lines(data, "}"):
                yield from self.part(part)
            return
        begins, ends = found
        item, begin = self.scanner.item, 0
        if item is not None:
            item.append(data[: ends[0] + 1 if ends else len(data)].decode("utf-8", "replace"))
            self.size += len(data)
            if not ends:
                return
            yield from self.closed(HEAD if self.head else RECORD, "".join(item))
            ends = ends[1:]
        whole = [data[i : j + 1] for i, j in zip(begins, ends)]
        if len(whole) > 1:
            yield MANY, whole[:-1]
        if whole:
            yield RECORD, whole[-1].decode("utf-8", "replace")
        self.scanner.item = None
        if len(begins) > len(ends):
            self.scanner.item, self.size = [data[begins[-1] :].decode("utf-8", "replace")], len(data) - begins[-1]

    def within_list(self, data: bytes) -> tuple[list[int], list[int]] | None:
        """Where items begin and end in a text that lies within the item list as a whole; else None, and nothing is moved."""
        s = self.scanner
        if s.items_at != 2 or s.depth < 2 or (s.item is None) != (s.depth == 2) or s.escape or self.long or self.size + len(data) > MOST_CHARS:
            return None
        brackets = Brackets(data)
        places, steps, depth = brackets.outside(s.quoted, s.depth)
        first = (depth == 3) & (steps > 0)
        if len(depth) and (depth.min() < 2 or (brackets.bytes[places[first]] != 123).any()):
            return None
        s.quoted ^= brackets.turns
        if len(depth):
            s.depth = int(depth[-1])
        return places[first].tolist(), places[(depth == 2) & (steps < 0)].tolist()

    def part(self, part: str):
        for item in self.scanner.feed(part + "}"):
            yield from self.closed(HEAD if self.head else RECORD, item)
        if self.scanner.item is not None:
            self.size = self.size + len(part) + 1
            if self.size > MOST_CHARS:
                self.scanner.item, self.long = [], True

    def closed(self, kind: int, item: str):
        if self.long:
            yield NOTE, TOO_LONG
        if not self.long or kind != RECORD:
            yield kind, "" if self.long else item
        self.size, self.long, self.head = 0, False, False

    def finish(self):
        if self.scanner.item is not None:
            yield from self.closed(MIDDLE if self.head else TAIL, "".join(self.scanner.item))


# ---- the two passes -------------------------------------------------------------------------------------


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.string(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 6, kinds)], [c.split()[0] for c in CUT_ROW.split(", ")])


def _summed(batches, summary: type, names: dict[int, str], separator: str):
    rows = []
    for file, block, texts in _groups(batches, separator.encode()):
        s = summary()
        for t in texts:
            s.feed(t)
        rows.append((names[file], block, s.told()))
    files, blocks, told = zip(*rows) if rows else ((), (), ())
    yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(blocks, pa.int64()), pa.array(told, pa.list_(pa.int32()))], ["file", "block", "told"])


class States:
    """The state before any block of any file, out of the summaries."""

    def __init__(self, rows: list, summary: type, first):
        self.first, self.blocks, self.after = first, {}, {}
        for r in sorted(rows, key=lambda r: (r.file, r.block)):
            after = self.after.setdefault(r.file, [])
            after.append(summary.composed(after[-1] if after else first, list(r.told)))
            self.blocks.setdefault(r.file, []).append(r.block)

    def before(self, file: str, block: int):
        k = bisect.bisect_left(self.blocks.get(file, []), block)
        return self.after[file][k - 1] if k else self.first

    def at_end(self, file: str):
        return self.after[file][-1] if file in self.after else self.first


def _many(file: str, block: int, found: list[tuple]) -> pa.RecordBatch:
    """``_batch`` of records of one block: their cells and texts."""
    n = len(found)
    cells, texts = zip(*found)
    columns = [pa.repeat(file, n), pa.repeat(pa.scalar(block, pa.int64()), n), pa.repeat(pa.scalar(RECORD, pa.int32()), n), pa.array(cells, pa.list_(pa.string())), pa.array(texts, pa.string()), pa.nulls(n, pa.int32())]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in CUT_ROW.split(", ")])


def _cut(batches, cutter: type, states: States, names: dict[int, str], separator: str, parsed: Callable[[list], list], able: Wanted):
    rows = []
    for reported, block, texts in _groups(batches, separator.encode()):
        file = names[reported]
        last = None  # is held back, as a file may break off in it
        for kind, text in _chained(cutter(states.before(file, block)), texts):
            if last is not None and able(last.encode()):
                rows += [(file, block, RECORD, *row, None) for row in parsed([last])]
            last = text if kind == RECORD else None
            if kind == MANY:
                found = parsed([t.decode("utf-8", "replace") for t in text if able(t)])
                if found:
                    yield _many(file, block, found)
            elif kind != RECORD:
                rows.append((file, block, kind, None, text, None))
            if len(rows) >= ROWS_AT_ONCE:
                yield _batch(rows)
                rows = []
        if last is not None:
            kept = able(last.encode())
            rows += [(file, block, LAST, *(row if kept else (None, None)), len(row[0] or ())) for row in parsed([last])]
    yield _batch(rows)


def _chained(c, texts: Iterator[bytes]):
    for t in texts:
        yield from c.feed(t)
    yield from c.finish()


def _csv_rows(texts: list[str]) -> list[tuple]:
    """Cells of records; all are read in one go, unless one has a bare carriage return, which would end a row within it."""
    whole = "\n".join(texts)
    if whole.count("\r") > whole.count("\r\n"):
        return [(r, None) for t in texts for r in cells_of(t)]
    return [(r, None) for r in cells_of(whole)]


def _json_rows(texts: list[str]) -> list[tuple]:
    return [(None, t) for t in texts]


def _parsed_again(batches, parsed: Callable[[list], list], able: Wanted):
    for b in batches:
        found = [(file, block, RECORD, *row, None) for file, block, text in zip(*(b.column(c).to_pylist() for c in ("file", "block", "text"))) if able(text.encode()) for row in parsed([text])]
        yield _batch(found)


def _joined(cut: DataFrame, glue: str) -> tuple[DataFrame, DataFrame]:
    """Records that blocks' edges had cut (file, block, text), and files with one that is too long (file, note).

    Fragments are a few a block; each belongs to the record that began last.
    """
    pieces = cut.filter(F.col("kind").isin(HEAD, MIDDLE, TAIL)).select("file", "block", "kind", "part")
    before = Window.partitionBy("file").orderBy("block", "kind")
    owned = pieces.withColumn("owner", F.max(F.when(F.col("kind") == TAIL, F.col("block"))).over(before.rowsBetween(Window.unboundedPreceding, 0))).filter("owner IS NOT NULL")
    sizes = owned.groupBy("file", "owner").agg(F.sum(F.length("part") + 1).alias("size"), F.max(F.when(F.col("kind") == HEAD, 1).otherwise(0)).alias("closed"))
    fit = F.col("size") <= MOST_CHARS
    whole = owned.join(sizes.filter(fit & (F.col("closed") == 1)), ["file", "owner"]).groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("block", "kind", "part"))).alias("p"))
    return whole.select("file", F.col("owner").alias("block"), F.array_join(F.col("p.part"), glue).alias("text")), sizes.filter(~fit).select("file", F.lit(TOO_LONG).alias("note"))


def _read(spark: SparkSession, files: list[str], separator: str) -> DataFrame:
    return spark.read.option("lineSep", separator).text(files).select(_number().alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value"))


def _passes(spark: SparkSession, files: list[str], separator: str, summary: type, cutter: type, first, parsed, wanted: str | list[tuple[str, ...]] | None, telling) -> tuple[DataFrame, States, tuple[DataFrame, DataFrame]]:
    """What was cut, the states, and whole records beside notes."""
    ship(spark)
    names, able = _numbers(spark, files), Wanted(wanted)
    lines = _read(spark, files, separator)
    binary = lines.withColumn("value", F.col("value").cast("binary"))
    told = (binary.filter(telling(lines["value"])) if telling is not None else binary).mapInArrow(functools.partial(_summed, summary=summary, names=names, separator=separator), "file string, block long, told array<int>").collect()  # a row a block
    states = States(told, summary, first)
    cut = materialize(binary.mapInArrow(functools.partial(_cut, cutter=cutter, states=states, names=names, separator=separator, parsed=parsed, able=able), CUT_ROW), "cut")
    joined, long = _joined(cut, cutter.glue)
    again = joined.mapInArrow(functools.partial(_parsed_again, parsed=parsed, able=able), CUT_ROW)
    noted = cut.filter(F.col("kind") == NOTE).select("file", F.col("part").alias("note")).unionByName(long)
    whole = cut.filter((F.col("kind") == RECORD) | ((F.col("kind") == LAST) & F.coalesce(F.col("part").isNotNull() | F.col("cells").isNotNull(), F.lit(False))))
    return cut, states, (whole.unionByName(again), noted)


def csv_records(spark: SparkSession, files: dict[str, int | None], wanted: str | list[tuple[str, ...]] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """file and cells of every record, and a note for each file that breaks off.

    ``files`` gives the columns of a file that does not end in a line end (else None): if its last record has fewer,
    the file was cut, and that record is left out. Records that are not ``wanted`` (as in ``Wanted``) are not parsed at all.
    """
    cut, states, (rows, noted) = _passes(spark, list(files), "\n", CsvSummary, CsvCutter, 0, _csv_rows, wanted, lambda value: value.contains('"'))
    notes = {f: OPEN_CELL for f in files if states.at_end(f)}
    short = []
    for r in cut.filter(F.col("kind") == LAST).groupBy("file").agg(F.max(F.struct("block", "n")).alias("last")).collect():  # a row a file
        if files.get(r.file) and r.last.n < files[r.file] and r.file not in notes:
            notes[r.file] = SHORT_ROW
            short.append((r.file, r.last.block, LAST))
    if short:
        rows = rows.join(F.broadcast(spark.createDataFrame(short, "file string, block long, kind int")), ["file", "block", "kind"], "left_anti")
    notes |= {r.file: r.note for r in noted.groupBy("file").agg(F.min("note").alias("note")).collect()}
    return rows.select("file", "cells"), notes


def json_records(spark: SparkSession, files: list[str], wanted: str | list[tuple[str, ...]] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """file and text of every charge item, and a note for each file that breaks off."""
    _, states, (rows, noted) = _passes(spark, files, "}", JsonSummary, ItemCutter, (0, 0, 0), _json_rows, wanted, None)
    notes = {f: OPEN_ITEM for f in files if states.at_end(f)[1] > 0 or states.at_end(f)[0]}
    notes |= {r.file: r.note for r in noted.groupBy("file").agg(F.min("note").alias("note")).collect()}
    return rows.select("file", F.col("part").alias("item")), notes
