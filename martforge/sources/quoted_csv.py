"""CSV with newlines inside quotes, read by many tasks a file (IO2).

A line break inside a quoted field does not end its record, and a task that
starts in the middle of a file can't know whether it starts inside quotes.
Both answers are worked out at once, and a prefix scan picks the right one:

1. each byte range (a split of the text scan) is a function of the state it is
   entered in, "between records" or "inside quotes", to the state it is left in;
2. the functions of a file's ranges are composed in order, which gives the
   state each range is entered in: one small row a range, in a window;
3. each range cuts its lines into records, knowing its state.  What belongs to
   a record that began in an earlier range, or ends in a later one, is put
   together by file and position.

The text is read twice and never shuffled, but for the pieces of records that
cross a range.  Records are parsed by Spark's own CSV parser.

How a line moves between the states follows that parser: a quote opens a field
only at the field's start, two quotes inside one are a quote, and whatever
follows a closing quote up to the delimiter is taken as it is.  A quote that is
never closed holds the rest of its file, without the last line end.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OUT, IN = 0, 1
WHOLE, HEAD, TAIL = 0, 1, 2  # a record; the end of one that began in an earlier range; the start of one that goes on


def quoted_after(line: bytes, state: int) -> int:
    """The state after a line that was entered in ``state``."""
    at = 0
    while True:
        if state == OUT:
            if at == 0 and line.startswith(b'"'):
                at = 1
            else:
                # the next field that starts with a quote (``at`` is a field's start or inside an unquoted one)
                if at and line.startswith(b'"', at):
                    at += 1
                else:
                    found = line.find(b',"', at)
                    if found < 0:
                        return OUT
                    at = found + 2
            state = IN
        close = line.find(b'"', at)
        if close < 0:
            return IN
        if line.startswith(b'"', close + 1):
            at = close + 2
            continue
        delimiter = line.find(b",", close + 1)
        if delimiter < 0:
            return OUT
        at, state = delimiter + 1, OUT


def _lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(file, block, line): the lines of the files, with the range they were read in; a carriage return stays."""
    text = spark.read.schema("value string").option("lineSep", "\n").text(list(files))
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.col("value").cast("binary").alias("line"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(file, block, rows) for the runs of one range in a batch."""
    file, block = batch.column("file").to_numpy(), batch.column("block").to_numpy()
    lo = 0
    for at in [*((file[1:] != file[:-1]) | (block[1:] != block[:-1])).nonzero()[0].tolist(), len(file) - 1]:
        if at + 1 > lo:
            yield int(file[lo]), int(block[lo]), batch.slice(lo, at + 1 - lo)
            lo = at + 1


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, from_out, from_in, cr): what each range does to the state; cr: its first line ends with a carriage return."""
    now: list | None = None
    done: list[list] = []
    for batch in batches:
        for file, block, rows in _runs(batch):
            lines = rows.column("line")
            if now is None or (now[0], now[1]) != (file, block):
                if now:
                    done.append(now)
                now = [file, block, OUT, IN, bool(len(lines)) and lines[0].as_py().endswith(b"\r")]
            for line in lines.filter(pc.greater(pc.find_substring(lines, b'"'), -1)):  # a line without quotes changes nothing
                text = line.as_py()
                both = (quoted_after(text, OUT), quoted_after(text, IN))
                now[2], now[3] = both[now[2]], both[now[3]]
    if now:
        done.append(now)
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()))],
                                         names=["file", "block", "from_out", "from_in", "cr"])


def _entered(functions: DataFrame) -> DataFrame:
    """(file, block, state, cr): the state each range is entered in; cr: the file's lines end with carriage returns.

    Composed without a loop: a range that leaves in one state whatever it was
    entered in fixes the state; after the last such range only ranges that keep
    or swap it follow, so the number of swaps decides."""
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixes = F.col("from_out") == F.col("from_in")
    swaps = (F.col("from_out") == IN) & (F.col("from_in") == OUT)
    marked = functions.withColumn("swaps", F.count_if(swaps).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = F.last(F.when(fixes, F.struct(F.col("from_out").alias("state"), "swaps")), ignorenulls=True).over(before)
    done = F.coalesce(F.lag("swaps").over(order), F.lit(0))
    marked = marked.select("file", "block", last.alias("fixed"), done.alias("done"), F.first("cr").over(order).alias("cr"))
    base, since = F.coalesce("fixed.state", F.lit(OUT)), F.col("done") - F.coalesce("fixed.swaps", F.lit(0))
    return marked.select("file", "block", F.pmod(base + since, F.lit(2)).cast("int").alias("state"), "cr")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, file, block, cr, text): the records of each range, and the pieces at its ends.  The first line of a file is its header and left out."""
    here: tuple[int, int, bool] | None = None
    state, inside, held = OUT, False, []  # inside: the held lines belong to a record of an earlier range
    out: list[tuple] = []

    def close() -> None:
        """A range ends: what is held goes on in a later one."""
        if here and held:
            out.append((HEAD if inside else TAIL, *here, (b"\r\n" if here[2] else b"\n").join(held)))

    for batch in batches:
        for file, block, rows in _runs(batch):
            cr, entered = rows.column("cr")[0].as_py(), rows.column("state")[0].as_py()
            skip = 0
            if here != (file, block, cr):
                close()
                here, state, inside, held = (file, block, cr), entered, entered == IN, []
                skip = int(block == 0)
            lines = rows.column("line")
            quoted = pc.greater(pc.find_substring(lines, b'"'), -1).to_pylist()
            for k, (line, q) in enumerate(zip(lines.to_pylist(), quoted)):
                if k < skip:
                    continue
                if cr and line.endswith(b"\r"):
                    line = line[:-1]
                if state == OUT and not q:
                    if line:  # empty lines between records are no records
                        out.append((WHOLE, *here, line))
                    continue
                held.append(line)
                state = quoted_after(line, state) if q else state
                if state == OUT:
                    out.append((HEAD if inside else WHOLE, *here, (b"\r\n" if cr else b"\n").join(held)))
                    held, inside = [], False
            if out:
                yield _batch(out)
                out = []
    close()
    if out:
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()))],
                                      names=["kind", "file", "block", "cr", "text"])


def records(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """``(record string, cr boolean)``: the records of the files, without their header lines.  Lazy.
    cr: lines end with carriage returns too; those at a record's end are gone, those inside stay.

    Both reads must cut the files into the same ranges; if they don't (the
    cluster grew in between), the query fails and says so."""
    lines = _lines(spark, files)
    entered = _entered(lines.mapInArrow(_functions, "file long, block long, from_out int, from_in int, cr boolean"))
    known = lines.join(F.broadcast(entered), ["file", "block"], "left")  # one row a range
    sure = F.coalesce("state", F.raise_error(F.lit("the byte ranges of the two reads differ: set spark.sql.files.minPartitionNum")).cast("int"))
    cut = known.select("file", "block", "line", sure.alias("state"), "cr").mapInArrow(_records, "kind int, file long, block long, cr boolean, text binary")
    whole = cut.filter(F.col("kind") == WHOLE).select(F.col("text").cast("string").alias("record"), "cr")
    pieces = cut.filter(F.col("kind") != WHOLE)
    place = Window.partitionBy("file").orderBy("block", "kind")
    group = F.count_if(F.col("kind") == TAIL).over(place.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = (pieces.withColumn("group", group).groupBy("file", "group", "cr")
              .agg(F.array_sort(F.collect_list(F.struct("block", "kind", F.col("text").cast("string").alias("text")))).alias("parts"))
              .select(F.when(F.col("cr"), F.array_join("parts.text", "\r\n")).otherwise(F.array_join("parts.text", "\n")).alias("record"), "cr"))
    return whole.unionByName(joined)


def parse(rows: DataFrame, columns: Sequence[str], bad: str) -> DataFrame:
    """Records as text columns and ``bad`` (the record as it stands, if it has too few or too many fields), by Spark's parser.

    Line ends inside quotes come out as newlines, as that parser has them for a file."""
    schema = ", ".join([*[f"c{i} string" for i in range(len(columns))], f"`{bad}` string"])
    options = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    text = F.when(F.col("cr"), F.replace("record", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
    out = rows.select("record", F.from_csv(text, F.lit(schema), options).alias("r"))
    return out.select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(columns)],
                      F.when(F.col("r").getField(bad).isNotNull(), F.col("record")).alias(bad))


def read(spark: SparkSession, files: Sequence[str], columns: Sequence[str], bad: str) -> DataFrame:
    """The rows of CSV files whose header is ``columns``."""
    return parse(records(spark, files), columns, bad)
