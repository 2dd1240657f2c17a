"""CSV files whose quoted fields hold line breaks, read in byte ranges like any other text.

Spark's CSV reader splits a file only when every line is a record; with ``multiLine`` it reads
a whole file in one task. Here a file stays splittable:

1. *Look.* A line that begins outside quotes either closes all of its quoted fields or leaves
   one open (``opens``, a column expression). If no line of a table opens one, then by
   induction every line is a record, and Spark's own reader does the rest.
2. *States.* Otherwise each range tells where it would end, inside quotes or outside, for
   both ways of beginning. Such a function is a constant, the identity or a swap, so the way
   each range really begins follows from the ranges before it in the file, by windows over one
   narrow row a range.
3. *Cut.* Knowing how it begins, a task cuts its range into records. Only records that cross
   a range's end are put together afterwards, from pieces: one row a crossing.

Quotes count as the reader that this replaces counts them: a field is quoted if it begins with
a quote, ``""`` inside is a quote, and a quote inside an unquoted field is an ordinary
character. Records end at a line feed; a carriage return before it belongs to the line end.

Lines keep their order within a range because nothing is shuffled before the cut. The ranges
of step 2 and 3 are the same as long as the session splits files alike; a range that step 2
has not seen is an error, not a guess.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

#: Rows of the table of ranges that are broadcast (a path, an offset and a flag each). With more
#: ranges, only those that begin inside quotes are; with more of these, files are read whole.
MAX_RANGES = 200_000
CLOSED_FIELD = '(^|,)"[^"]*"'  # after doubled quotes are gone
OPEN_FIELD = '(^|,)"'
RECORD, HEAD, TAIL, MIDDLE = 0, 1, 2, 3


def opens(line: Column) -> Column:
    """Whether a line that begins outside quotes leaves a quoted field open at its end."""
    left = F.regexp_replace(F.regexp_replace(line, '""', ""), CLOSED_FIELD, "$1")
    return F.when(line.contains('"'), left.rlike(OPEN_FIELD)).otherwise(False)


def _opens(lines: pa.Array) -> list[bool]:
    """``opens`` on an Arrow array."""
    left = pc.replace_substring_regex(pc.replace_substring(lines, '""', ""), CLOSED_FIELD, r"\1")
    return pc.match_substring_regex(left, OPEN_FIELD).to_pylist()


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file, start: each line with the byte range that it was read in."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def has_broken_lines(spark: SparkSession, path: str) -> bool:
    """Whether some record of the files at ``path`` goes over more than one line."""
    return not spark.read.option("lineSep", "\n").text(path).where(opens(F.col("value"))).isEmpty()


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(file, start, from, to) of the consecutive rows of each range in a batch."""
    files, starts = batch.column("file"), batch.column("start").to_numpy()
    encoded = files.dictionary_encode()
    codes, at = encoded.indices.to_numpy(), 0
    for i in range(1, batch.num_rows + 1):
        if i == batch.num_rows or starts[i] != starts[at] or codes[i] != codes[at]:
            yield encoded.dictionary[int(codes[at])].as_py(), int(starts[at]), at, i
            at = i


def _quoted(lines: pa.Array) -> tuple[list[int], list[bool], list[bool]]:
    """Of the lines that hold quotes: their places, and whether they end inside quotes if they
    begin outside, and if they begin inside. Other lines end as they begin."""
    places = pc.indices_nonzero(pc.match_substring(lines, '"'))
    some = lines.take(places)
    inside = pc.binary_join_element_wise(pa.scalar('"', some.type), some, pa.scalar("", some.type))
    return places.to_pylist(), _opens(some), _opens(inside)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a range: whether it ends inside quotes, beginning outside and beginning inside."""
    key, state = None, (False, True)

    def row():
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, *state)], ["file", "start", "from_outside", "from_inside"])

    for batch in batches:
        if not batch.num_rows:
            continue
        places, outside, inside = _quoted(batch.column("value"))
        at = 0
        for file, start, _, to in _runs(batch):
            if key != (file, start):
                if key:
                    yield row()
                key, state = (file, start), (False, True)
            while at < len(places) and places[at] < to:
                state = tuple(inside[at] if s else outside[at] for s in state)
                at += 1
    if key:
        yield row()


def range_states(lines: DataFrame) -> DataFrame:
    """file, start, begins and ends: whether each range begins and ends inside quotes. Narrow
    windows over one row a range; written once."""
    ensure_checkpoint_dir(lines.sparkSession)
    ends = lines.mapInArrow(_ends, "file string, start long, from_outside boolean, from_inside boolean").checkpoint(eager=True)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    swap = (F.col("from_outside") & ~F.col("from_inside")).cast("int")
    swapped = ends.withColumn("swaps", F.coalesce(F.sum(swap).over(before), F.lit(0)))
    settled = F.when(F.col("from_outside") == F.col("from_inside"), F.struct(F.col("from_outside").cast("int").alias("to"), "swaps"))
    last = F.last(settled, ignorenulls=True).over(before)
    # a constant makes no swap, so swaps after it are the difference of the two counts
    begins = swapped.withColumn("last", last).withColumn(
        "begins", F.pmod(F.coalesce("last.to", F.lit(0)) + F.col("swaps") - F.coalesce("last.swaps", F.lit(0)), F.lit(2)) == 1)
    return begins.select("file", "start", "begins",
                         F.when(F.col("begins"), F.col("from_inside")).otherwise(F.col("from_outside")).alias("ends"))


def _cutter(header: str, whole_records: bool):
    """Cuts (value, file, start, begins) into records, or into the pieces of crossing records."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, held, head, first = None, False, [], False, False
        out: list[tuple[str, int, int, str]] = []

        def close() -> None:
            """The end of a range: what is held is a piece."""
            if held:
                out.append((*key, MIDDLE if head else TAIL, "\n".join(held)))

        def record(text: str) -> None:
            nonlocal first
            text = text.removesuffix("\r")
            if first:
                first = False
                if text.removeprefix("\ufeff") != header:
                    raise ValueError(f"the header of {key[0]} differs from that of other files of its table")
            elif text:
                out.append((*key, RECORD, text))

        for batch in batches:
            if not batch.num_rows:
                continue
            lines = batch.column("value")
            places, from_outside, from_inside = _quoted(lines)
            quoted = dict(zip(places, zip(from_outside, from_inside, strict=True), strict=True))
            texts, begins = lines.to_pylist(), batch.column("begins").to_pylist()
            for file, start, at, to in _runs(batch):
                if key != (file, start):
                    close()
                    key, inside, held, head, first = (file, start), begins[at], [], begins[at], start == 0
                for i in range(at, to):
                    if i in quoted:
                        inside = quoted[i][inside]
                    held.append(texts[i])
                    if not inside:
                        if head:
                            out.append((*key, HEAD, "\n".join(held)))
                            head = False
                        else:
                            record("\n".join(held))
                        held = []
            kept = [r for r in out if (r[2] == RECORD) == whole_records]
            out.clear()
            yield _rows(kept)
        close()
        yield _rows([r for r in out if (r[2] == RECORD) == whole_records])

    return cut


def _rows(rows: list[tuple[str, int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "start", "kind", "text"])


CUT = "file string, start long, kind int, text string"


def records(spark: SparkSession, path: str, header: str) -> DataFrame | None:
    """text: every record after the headers, cut exactly. ``header`` is the first record of each
    file. None if so many ranges begin inside quotes that their list is too long to broadcast."""
    lines = text_lines(spark, path)
    states = range_states(lines).checkpoint(eager=True)
    inside, total = states.where("begins").count(), states.count()
    last = states.groupBy("file").agg(F.max_by("ends", "start").alias("open")).where("open").select("file").first()
    if last:
        raise ValueError(f"a quoted field of {last.file} has no end")
    if inside > MAX_RANGES:
        return None
    known = states if total <= MAX_RANGES else states.where("begins")
    keyed = lines.join(F.broadcast(known.select("file", "start", "begins")), ["file", "start"], "left")
    unseen = F.raise_error(F.concat(F.lit("files are split in another way than when their ranges were looked at: "), "file"))
    begins = F.coalesce("begins", unseen.cast("boolean") if known is states else F.lit(False))
    keyed = keyed.select("value", "file", "start", begins.alias("begins"))
    whole = keyed.mapInArrow(_cutter(header, True), CUT).select("text")
    if not inside:
        return whole
    # ranges that a record crosses: the pieces of a crossing share the number of tails up to them
    touched = states.where(F.col("begins") | F.col("ends")).select("file", "start")
    few = F.broadcast(touched) if inside * 2 <= MAX_RANGES else None
    near = keyed.join(few, ["file", "start"], "left_semi") if few is not None else keyed
    pieces = near.mapInArrow(_cutter(header, False), CUT)
    # within a range a head comes before a tail
    order = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    chain = pieces.withColumn("chain", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    joined = chain.groupBy("file", "chain").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "text"))).alias("p"))
    crossing = joined.select(F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"))
    return whole.unionByName(crossing.select(F.regexp_replace("text", "\r$", "").alias("text")))
