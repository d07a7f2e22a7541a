"""The pieces in which Spark reads files, in file order: numbering without a copy, and CSV records across pieces.

A piece is a stretch of a file which one task reads. A first scan makes one row per piece; a second scan reads the same
pieces with what comes before each. The tables of pieces have a row per ``spark.sql.files.maxPartitionBytes`` of input,
so at 128 MB a petabyte has some eight million small rows; they are what is broadcast.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PIECE = ["__file", "__start"]

# A field that ends on its line: quoted, with what follows the closing quote, or without a quote at its start.
_FIELD = r'(?:"(?:[^"]++|"")*+"(?!")[^,]*+|(?!")[^,]*+)'
# Lines on which every quoted field is closed, when the line begins outside, or inside, a quoted field.
_FROM_OUTSIDE = re.compile(rf"{_FIELD}(?:,{_FIELD})*+", re.DOTALL)
_FROM_INSIDE = re.compile(rf'(?:[^"]++|"")*+"(?!")[^,]*+(?:,{_FIELD})*+', re.DOTALL)


def with_piece(df: DataFrame) -> DataFrame:
    """The rows of a plain file scan with their piece and a number that counts up within each piece."""
    return df.select(
        *df.columns,
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__place"),
    )


def before(column: str) -> Column:
    """The sum of ``column`` over the pieces before, in file order. Pieces are few; one task orders them."""
    return F.coalesce(F.sum(column).over(Window.orderBy(*PIECE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def number_rows(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Add ``name`` as the first column: 0, 1, ... in the order of files and rows, whatever the number of partitions.

    Nothing of the input's size is written. The frame must be a plain file scan. The first scan counts the rows of each
    piece and notes their first number, the second adds the rows before. A piece whose rows are not numbered as in the
    first scan, because files or the split into pieces changed in between, raises.
    """
    rows = with_piece(df)
    counts = rows.groupBy(*PIECE).agg(F.count(F.lit(1)).alias("__n"), F.min("__place").alias("__first"))
    offsets = counts.select(*PIECE, "__n", "__first", before("__n").alias("__before"))
    found = rows.join(F.broadcast(offsets), PIECE, "left")
    at = F.col("__place") - F.col("__first")
    changed = F.raise_error(F.concat(F.lit("the input changed while it was read: "), F.col("__file"))).cast("bigint")
    number = F.when((at >= 0) & (at < F.col("__n")), F.col("__before") + at).otherwise(changed)
    return found.select(number.alias(name), *df.columns)


# --- CSV records whose quoted values may hold newlines ---


def _ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open behind the line."""
    if '"' not in line:
        return inside
    return not (_FROM_INSIDE if inside else _FROM_OUTSIDE).fullmatch(line)


def _lines(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], list[str], list[int]]]:
    """Runs of lines of one piece, and the places in each run at which a line has quotes."""
    texts, files, starts = (batch.column(c) for c in ("value", "__file", "__start"))
    quoted = pc.match_substring(texts, '"')
    keys = list(zip(files.to_pylist(), starts.to_pylist(), strict=True))
    at = 0
    while at < len(keys):
        to = at
        while to < len(keys) and keys[to] == keys[at]:
            to += 1
        marks = pc.indices_nonzero(quoted.slice(at, to - at)).to_pylist()
        yield keys[at], texts.slice(at, to - at).to_pylist(), marks
        at = to


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per piece: its lines, and for a start outside and inside a quoted field, the records that start and where it ends."""
    pieces: dict[tuple[str, int], list] = {}
    for batch in batches:
        for key, lines, marks in _lines(batch):
            found = pieces.setdefault(key, [0, [0, 0], [False, True]])
            blank = [i for i, line in enumerate(lines) if line in ("", "\r")]
            for state in (0, 1):
                inside, at, starts = found[2][state], 0, 0
                for mark in [*marks, len(lines)]:
                    # Lines without quotes leave the state; outside, each that is not blank is a record.
                    if not inside:
                        starts += mark - at - (bisect_left(blank, mark) - bisect_left(blank, at))
                    if mark < len(lines):
                        starts += not inside
                        inside = _ends_inside(lines[mark], inside)
                    at = mark + 1
                found[1][state] += starts
                found[2][state] = inside
            found[0] += len(lines)
    rows = [(*k, n, *starts, *ends) for k, (n, starts, ends) in pieces.items()]
    names = [*PIECE, "lines", "from_outside", "from_inside", "ends_outside", "ends_inside"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order, each with the state it is entered in and the number of its first record.

    A file starts outside, and its first record, the header, takes no number of its own.
    """
    file, inside, records, header = None, False, 0, False
    for batch in batches:
        entered, numbers, leaves, awaits = [], [], [], []
        for at, outside, within, ends0, ends1 in zip(*(batch.column(c).to_pylist() for c in ("__file", "from_outside", "from_inside", "ends_outside", "ends_inside")), strict=True):
            if at != file:
                file, inside, header = at, False, True
            entered.append(inside)
            numbers.append(records - header)
            awaits.append(header)
            starts = within if inside else outside
            records += starts - (header and starts > 0)
            header = header and not starts
            inside = ends1 if inside else ends0
            leaves.append(inside)
        yield pa.RecordBatch.from_arrays(
            [batch.column("__file"), batch.column("__start"), batch.column("lines"), pa.array(entered, pa.bool_()), pa.array(numbers, pa.int64()), pa.array(leaves, pa.bool_()), pa.array(awaits, pa.bool_())],
            [*PIECE, "lines", "entered", "records", "leaves", "awaits"],
        )


def _join_lines(whole: bool):
    """Lines of pieces to records: those that lie in one piece, or only the first and last parts of those that do not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, expected, seen = None, 0, 0
        open_: list[str] = []
        inside = head = awaits = False
        number = base = 0

        def row(last: bool, out: list) -> None:
            # A record is whole when it begins and ends here.
            if whole == (last and not head):
                text = "\n".join(open_)
                out.append((number - 1, piece[0], piece[1], text, awaits and number - 1 == base and not head))

        def close(out: list) -> None:
            if piece is not None:
                if seen != expected:
                    raise RuntimeError(f"the input changed while it was read: {piece[0]}")
                if open_:
                    row(False, out)

        for batch in batches:
            out: list[tuple] = []
            at = 0
            columns = [batch.column(c) for c in ("lines", "entered", "records", "awaits")]
            for key, lines, marks in _lines(batch):
                if key != piece:
                    close(out)
                    piece, open_ = key, []
                    expected, inside, number, awaits = (c[at].as_py() for c in columns)
                    base, seen, head = number, 0, inside
                quoted = set(marks)
                for i, line in enumerate(lines):
                    if not inside and line in ("", "\r"):
                        continue
                    if not inside:
                        number += 1
                        open_ = []
                    open_.append(line)
                    inside = _ends_inside(line, inside) if i in quoted else inside
                    if not inside:
                        row(True, out)
                        open_, head = [], False
                seen += len(lines)
                at += len(lines)
            yield _records(out)
        out = []
        close(out)
        yield _records(out)

    return run


def _records(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["record", *PIECE, "text", "header"])


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, text, header): the records of CSV files in file order, each with the newlines of its quoted values.

    Files are read in pieces by many tasks, one large file as well. Whether a line begins inside a quoted field follows
    from all lines before it: the first scan finds for each piece how it is left when entered outside or inside one, a
    walk over the pieces settles the entries, and the second scan joins lines to records. Records that cross pieces are
    put together from their parts. A quote opens a field only at its start and is closed by one that is not doubled.
    ``header`` marks each file's first record; the others are numbered from 0 through all files. Blank lines outside
    quotes are no records. Lines end with a line feed, or with a carriage return before it.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    pieces = lines.select("value", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"))
    described = pieces.mapInArrow(_describe, "__file string, __start long, lines long, from_outside long, from_inside long, ends_outside boolean, ends_inside boolean")
    # One row per piece, walked in order by one task.
    entered = described.repartition(1).sortWithinPartitions(*PIECE).mapInArrow(_enter, "__file string, __start long, lines long, entered boolean, records long, leaves boolean, awaits boolean")
    schema = "record long, __file string, __start long, text string, header boolean"
    at = F.broadcast(entered)
    read = pieces.join(at, PIECE)
    whole = read.mapInArrow(_join_lines(True), schema).select("record", "text", "header")
    crossing = read.filter("entered OR leaves").mapInArrow(_join_lines(False), schema)
    # A piece has at most the end of one record and the beginning of another.
    joined = crossing.groupBy("__file", "record").agg(F.sort_array(F.collect_list(F.struct("__start", "text"))).alias("parts"), F.max("header").alias("header"))
    both = whole.unionByName(joined.select("record", F.array_join("parts.text", "\n").alias("text"), "header"))
    return both.withColumn("text", F.regexp_replace("text", r"\r\z", ""))
