"""CSV records read by many tasks, also where quoted cells hold line breaks.

Spark splits a text file at line ends, and a task cannot see from its split alone
whether that begins inside a quoted cell.  But a line is a function from "begins
inside" to "ends inside", such functions compose, and so do those of whole splits:

1. a first scan composes the lines of each split to one function (one small row
   per split);
2. a window over the splits of a file, in file order, gives the state in which each
   split begins: the last split that ends alike from both states decides, and then the
   number of splits since that turn the state round;
3. a second scan joins the lines of each split to records, starting from that
   state, in the order of the file and without a shuffle;
4. a third scan, of the splits that begin or end inside a cell, finds the pieces of
   records that their ends cut, two per split at most; a shuffle puts them together.

Lines whose cells are each quoted as a whole or hold no quote are recognised a batch at a
time; only others are looked at one by one.

The table of splits that is broadcast has two numbers and a flag per split (of
``spark.sql.files.maxPartitionBytes``): 24 bytes for 128 MB of text.  Files that Spark
never splits need the second scan only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORD, HEAD, MIDDLE, TAIL, HEADER_TAIL = range(5)
_KINDS = "split_file long, split_start long, kind int, source string, value string, cells int"

# From a cell's begin: closed cells up to a comma, then a quoted cell that the line does not close.
_LEFT_OPEN = re.compile(r'(?:(?:"(?:[^"]+|"")*+"[^,]*+|[^",][^,]*+|),)*+"(?:[^"]+|"")*+\Z')
# From inside a quoted cell: its end, what stands before the next comma, and the comma.
_CLOSES = re.compile(r'(?:[^"]+|"")*+"[^,]*+(,?)')
_CELL = re.compile(r'(?:"(?:[^"]+|"")*+"?)?[^,]*+,?')
# For whole batches (RE2): a line of which each cell is quoted as a whole or holds no quote; it is a record by itself.
_REGULAR = r'^(?:[^",]*|"(?:[^"]|"")*")(?:,(?:[^",]*|"(?:[^"]|"")*"))*\r?$'
_QUOTED_CELL = r'"(?:[^"]|"")*"'


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open at the end of a line that begins inside one or not.

    A quote within an unquoted cell is a character like any other; what follows a closing quote belongs to the cell.
    A byte-order mark is passed over."""
    start = int(line.startswith("\ufeff"))
    if inside:
        closing = _CLOSES.match(line)
        if not closing:
            return True
        if not closing[1]:
            return False
        start = closing.end()
    return _LEFT_OPEN.match(line, start) is not None


def cells_of(record: str) -> int:
    """The number of cells of a record."""
    if '"' not in record:
        return record.count(",") + 1
    n, at = 0, 0
    while True:
        cell = _CELL.match(record, at)
        n, at = n + 1, cell.end()
        if not cell[0].endswith(",") or ends_inside(cell[0], False):
            return n


def _lines(spark: SparkSession, paths: Sequence[str], source: Column) -> DataFrame:
    """Lines with the split they are in.  A line ends at a line feed only, so a cell keeps its carriage returns."""
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.xxhash64("_metadata.file_path").alias("split_file"), F.col("_metadata.file_block_start").alias("split_start"),
        source.alias("source"), "value")


def _by_split(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Slices of a batch that are of one split."""
    files, starts = batch.column("split_file"), batch.column("split_start")
    start = 0
    while start < len(batch):
        key = files[start].as_py(), starts[start].as_py()
        end = len(batch)
        if (files[end - 1].as_py(), starts[end - 1].as_py()) != key:
            same = pc.and_(pc.equal(files, key[0]), pc.equal(starts, key[1])).to_pylist()
            end = same.index(False, start)
        yield key, batch.slice(start, end - start)
        start = end


def _quoted(values: pa.Array) -> list[int]:
    """Which lines hold a quote; the others leave the state as it is."""
    return pc.indices_nonzero(pc.match_substring(values, '"')).to_pylist()


def _irregular(values: pa.Array) -> list[int]:
    """Which lines do not leave the state outside of quoted cells as it is for certain."""
    bare = pc.invert(pc.match_substring(values, '"'))
    regular = pc.match_substring_regex(values, _REGULAR)
    return pc.indices_nonzero(pc.invert(pc.or_(bare, regular))).to_pylist()


def _cell_counts(values: pa.Array) -> pa.Array:
    """The numbers of cells of regular lines: their commas that are not quoted, and one."""
    bare = pc.replace_substring_regex(values, _QUOTED_CELL, "")
    return pc.add(pc.count_substring(bare, ","), 1)


def split_states(lines: DataFrame) -> DataFrame:
    """``split_file, split_start, inside, cut``: whether each split begins inside a quoted cell, and whether it
    begins or ends inside one, so that its ends cut a record."""
    schema = pa.schema([("split_file", pa.int64()), ("split_start", pa.int64()), ("outside_to", pa.bool_()), ("inside_to", pa.bool_())])

    def task(batches):
        split, ends = None, [False, True]

        def row():
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip([*split, *ends], schema.types)], schema=schema)

        for batch in batches:
            for key, part in _by_split(batch):
                if key != split:
                    if split:
                        yield row()
                    split, ends = key, [False, True]
                values = part.column("value")
                irregular = set(_irregular(values))
                for i in _quoted(values):
                    if i in irregular or any(ends):
                        line = values[i].as_py()
                        ends = [ends_inside(line, inside) for inside in ends]
        if split:
            yield row()

    found = lines.select("split_file", "split_start", "value").mapInArrow(
        task, "split_file long, split_start long, outside_to boolean, inside_to boolean")
    before = Window.partitionBy("split_file").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    turns = F.coalesce(F.sum(F.when(F.col("outside_to") & ~F.col("inside_to"), 1).otherwise(0)).over(before), F.lit(0))
    found = found.withColumn("turns", turns)
    decided = F.last(F.when(F.col("outside_to") == F.col("inside_to"), F.struct("outside_to", "turns")), ignorenulls=True).over(before)
    found = found.withColumn("decided", decided)
    odd = (F.col("turns") - F.coalesce(F.col("decided.turns"), F.lit(0))) % 2 == 1
    found = found.withColumn("inside", F.coalesce(F.col("decided.outside_to"), F.lit(False)) != odd)
    ends = F.when(F.col("inside"), F.col("inside_to")).otherwise(F.col("outside_to"))
    return found.select("split_file", "split_start", "inside", (F.col("inside") | ends).alias("cut"))


def _pieces(lines: DataFrame, *, cut: bool = False, whole_files: bool = False, quoted_breaks: bool = True) -> DataFrame:
    """The records of each split, or (``cut``) the pieces of records that its ends cut, by ``kind``; for lines with
    ``inside``: how their split begins (null: a split that the first scan has not seen).  ``cells`` is the number of a
    record's cells.  ``whole_files``: a split is a file, so what is open at its end is a record."""
    schema = pa.schema([("split_file", pa.int64()), ("split_start", pa.int64()), ("kind", pa.int32()),
                        ("source", pa.string()), ("value", pa.string()), ("cells", pa.int32())])

    def task(batches):
        split = source = None
        open_: list[str] = []          # the lines of the record that is not closed yet
        inside = from_before = header_due = False

        def rows(kinds, sources, values, cells):
            columns = [[split[0]] * len(values), [split[1]] * len(values), kinds, sources, values, cells]
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types)],
                                              schema=schema)

        def rest():
            """What is open at the end of a split."""
            kind = MIDDLE if from_before else HEADER_TAIL if header_due else TAIL
            text = "\n".join(open_)
            if cut and open_:
                yield rows([kind], [source], [text], [0])
            if whole_files and open_ and kind == TAIL:
                yield rows([RECORD], [source], [text], [cells_of(text)])

        for batch in batches:
            for key, part in _by_split(batch):
                if key != split:
                    yield from rest()
                    split, open_ = key, []
                    source, inside = part.column("source")[0].as_py(), part.column("inside")[0].as_py()
                    if inside is None:
                        raise RuntimeError("the files were split in another way than a moment before (the number of cores has "
                                           "changed): read again, or set spark.sql.files.openCostInBytes to maxPartitionBytes")
                    from_before, header_due = inside, key[1] == 0
                values = part.column("value")
                has_quote = _quoted(values)
                quoted = has_quote if quoted_breaks else []
                if not inside and not header_due and not (has_quote and _irregular(values)):      # every line is a record
                    if not cut:
                        cells = _cell_counts(values) if has_quote else pc.add(pc.count_substring(values, ","), 1)
                        yield rows([RECORD] * len(part), part.column("source"), values, cells)
                    continue
                quoted, kinds, out = set(quoted), [], []
                for i, line in enumerate(values.to_pylist()):
                    was_inside = inside
                    if i in quoted:
                        inside = ends_inside(line, inside)
                    if was_inside or inside:
                        open_.append(line)
                        if inside:
                            continue
                        line, open_ = "\n".join(open_), []
                    if header_due:
                        header_due = not line.strip("\r")      # Spark's CSV reader passes over empty lines too
                    elif from_before == cut:
                        kinds.append(HEAD if cut else RECORD)
                        out.append(line)
                    from_before = False
                if out:
                    yield rows(kinds, [source] * len(out), out, list(map(cells_of, out)))
        yield from rest()

    return lines.mapInArrow(task, _KINDS)


def _counted(records: DataFrame) -> DataFrame:
    """The ``cells`` of records put together from pieces."""
    def task(batches):
        for batch in batches:
            at = batch.schema.get_field_index("cells")
            cells = pa.array([cells_of(v) for v in batch.column("value").to_pylist()], pa.int32())
            yield batch.set_column(at, "cells", cells)

    return records.mapInArrow(task, _KINDS)


def csv_records(spark: SparkSession, paths: Sequence[str], source: Column, *, split: bool = True, quoted_breaks: bool = True) -> DataFrame:
    """``source, value, cells``: the records of CSV files without their first one (the header) and without empty lines,
    and the number of cells of each.

    ``source`` is an expression over ``_metadata``.  ``split=False``: the caller knows that Spark reads each file in one
    task.  ``quoted_breaks=False``: every line is a record."""
    lines = _lines(spark, paths, source)
    if not quoted_breaks:
        return _clean(_pieces(lines.withColumn("inside", F.lit(False)), quoted_breaks=False))
    if not split:
        return _clean(_pieces(lines.withColumn("inside", F.lit(False)), whole_files=True))
    lines = lines.join(F.broadcast(split_states(lines)), ["split_file", "split_start"], "left")
    cut = _pieces(lines.where("cut").drop("cut"), cut=True)
    order = Window.partitionBy("split_file").orderBy("split_start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumn("record", F.count_if(F.col("kind") >= TAIL).over(order))
    joined = cut.groupBy("split_file", "record").agg(
        F.sort_array(F.collect_list(F.struct("split_start", "kind", "value"))).alias("parts"), F.max("kind").alias("last"),
        F.first("source").alias("source")).where(F.col("last") != HEADER_TAIL)
    joined = joined.select("split_file", F.lit(0).cast("long").alias("split_start"), F.lit(RECORD).alias("kind"), "source",
                           F.concat_ws("\n", F.transform("parts", lambda p: p["value"])).alias("value"), F.lit(0).alias("cells"))
    return _clean(_pieces(lines.drop("cut")).unionByName(_counted(joined)))


def _clean(pieces: DataFrame) -> DataFrame:
    """Without the carriage return before a line feed that ends a record, and without empty lines."""
    value = F.when(F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    return pieces.select("source", value.alias("value"), "cells").where("value <> ''")
