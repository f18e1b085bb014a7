"""CSV files whose quoted fields hold line breaks, read by many tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recensio.session import materialize, ship

#: A record may end this many bytes behind the split in which it begins; beyond that a quote was left open.
LONGEST = 1 << 28


def _runs(batch: pa.RecordBatch, quote: str) -> Iterator[tuple[str, int, pa.RecordBatch, np.ndarray]]:
    """Rows of one split that follow each other, and whether each line has an odd number of quotes."""
    if not batch.num_rows:
        return
    lines = batch.column("line")
    odd = pc.count_substring(lines, quote).to_numpy(zero_copy_only=False) % 2 if quote else np.zeros(len(lines), np.int64)
    files, starts = batch.column("file").dictionary_encode().indices.to_numpy(), batch.column("start").to_numpy()
    cuts = np.flatnonzero((np.diff(files) != 0) | (np.diff(starts) != 0)) + 1
    for begin, end in zip([0, *cuts], [*cuts, len(lines)], strict=True):
        part = batch.slice(begin, end - begin)
        yield part.column("file")[0].as_py(), int(starts[begin]), part, odd[begin:end]


def _summaries(quote: str):
    """``(file, start, turns, even, odd)`` per split: lines with an odd number of quotes, and whether any line has an even or odd number of them before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            for file, start, _, odd in _runs(batch, quote):
                split = found.setdefault((file, start), [0, 0, 0])
                before = (split[0] + np.cumsum(odd) - odd) % 2
                split[0] += int(odd.sum())
                split[1] |= int((before == 0).any())
                split[2] |= int((before == 1).any())
        rows = [{"file": f, "start": s, "turns": t, "even": bool(e), "odd": bool(o)} for (f, s), (t, e, o) in found.items()]
        kinds = [("file", pa.string()), ("start", pa.int64()), ("turns", pa.int64()), ("even", pa.bool_()), ("odd", pa.bool_())]
        yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    return run


PIECE = pa.schema(
    [("file", pa.string()), ("start", pa.int64()), ("home", pa.int64()), ("head", pa.bool_()), ("whole", pa.bool_()), ("top", pa.bool_()), ("text", pa.string())]
)


def _pieces(quote: str):
    """Records that begin and end in a split, the beginning of its last one, and what stands before its first one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = start = home = None
        turns, held, head, top = 0, [], True, False

        def piece(whole: bool) -> pa.RecordBatch:
            text = "\n".join(line for lines in held for line in lines.to_pylist())
            row = {"file": file, "start": start, "home": home, "head": head, "whole": whole and not head, "top": top, "text": text}
            return pa.RecordBatch.from_pylist([row], PIECE)

        for batch in batches:
            for name, at, part, odd in _runs(batch, quote):
                if (name, at) != (file, start):
                    if held:
                        yield piece(False)
                    file, start, home = name, at, part.column("home")[0].as_py()
                    turns, held, head, top = 0, [], True, at == 0
                inside = part.column("inside")[0].as_py()
                first = np.flatnonzero((inside + turns + np.cumsum(odd) - odd) % 2 == 0)
                turns += int(odd.sum())
                lines = part.column("line")
                if not len(first):
                    held.append(lines)
                    continue
                if first[0]:
                    held.append(lines.slice(0, first[0]))
                if held:
                    yield piece(True)
                    top = False
                if len(first) > 1:
                    inner = lines.slice(first[0], first[-1] - first[0])
                    lists = pa.ListArray.from_arrays(pa.array(first - first[0], pa.int32()), pa.concat_arrays([inner]))
                    texts, n = pc.binary_join(lists, "\n"), len(lists)
                    tops = np.zeros(n, bool)
                    tops[0], top = top, False
                    same = [pa.array([file] * n, pa.string()), pa.array(np.full(n, start)), pa.array([home] * n, pa.int64())]
                    flags = [pa.array(np.zeros(n, bool)), pa.array(np.ones(n, bool)), pa.array(tops)]
                    yield pa.RecordBatch.from_arrays([*same, *flags, texts], schema=PIECE)
                held, head = [lines.slice(first[-1])], False
        if held:
            yield piece(False)

    return run


def quoted_records(spark: SparkSession, path: str, quote: str = '"', header: bool = True, longest: int = LONGEST) -> DataFrame:
    """``(file, record)``: the records of CSV files, line breaks inside quotes kept.

    Files are split as text. A line begins a record if the quotes before it are
    even in number, so fields that hold quotes must be quoted and double them.
    Only one row a split says how many there were in the splits before; lines
    are read in order and stay in their task, and what stands before a split's first
    record joins the last one of an earlier split. Blank records are left out,
    and the first of every file if ``header``. A quote that is never closed ends the job
    with an error once it reaches ``longest`` bytes behind its split.
    """
    ship(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line")
    )
    splits = lines.mapInArrow(_summaries(quote), "file string, start long, turns long, even boolean, odd boolean")
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("inside", F.coalesce(F.sum("turns").over(earlier), F.lit(0)) % 2)
    begins = F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("odd"))
    home = F.last(F.when(begins, F.col("start")), ignorenulls=True).over(earlier)
    splits = splits.select("file", "start", "inside", home.alias("home"))

    # one row a split; the lines keep their order beside it
    pieces = lines.join(F.broadcast(materialize(splits)), ["file", "start"]).mapInArrow(
        _pieces(quote), "file string, start long, home long, head boolean, whole boolean, top boolean, text string"
    )
    pieces = materialize(pieces)  # read twice
    open_quote = F.raise_error(F.concat(F.lit("a quote is not closed before byte "), F.col("start").cast("string"), F.lit(" of "), "file"))
    owner = F.when(F.col("start") - F.col("home") > longest, open_quote.cast("long")).otherwise(F.col("home"))
    parted = pieces.filter(~F.col("whole")).groupBy("file", F.when(F.col("head"), owner).otherwise(F.col("start")).alias("owner"))
    joined = parted.agg(F.sort_array(F.collect_list(F.struct("start", "text"))).alias("parts"), F.max("top").alias("top")).select(
        "file", F.array_join(F.transform("parts", lambda x: x["text"]), "\n").alias("text"), "top"
    )
    records = pieces.filter("whole").select("file", "text", "top").unionByName(joined)
    if header:
        records = records.filter(~F.col("top"))
    whole = F.regexp_replace("text", r"\r\z", "")
    return records.select("file", whole.alias("record")).filter(F.trim("record") != "")
