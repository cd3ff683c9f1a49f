"""Which lines of a raw CSV file make a record.

Spark's reader takes each line for a record (``multiLine`` off), or a whole
file in one task, and either way believes a quote that is never closed: the
field then ends with the line, or swallows all lines up to the next quote, and
comes through as good. Here every line is followed through its quotes instead,
in parallel over the splits of a file. A quote at the start of a field opens it,
one in a bare field is text, two inside a quoted field are text, and one at its
end closes it; anything else after a closing quote does not fit. So a line that
begins outside a quoted field ends outside, or inside, or does not fit, and so
does one that begins inside.

* A line that leads from outside to inside opens a record, if the next line
  that does not lead from inside to inside leads outside; these lines are one
  record. A quote that no such line closes opens nothing: its
  line is a bad record, and the lines after it stand for themselves.
* All other lines are records if they lead from outside to outside, else bad.

So every line is in a good record, in a bad one, a header or blank, and
``audit`` says how many of each there are. Only lines with quotes are followed;
if none opens anything, nothing is shuffled. Otherwise the lines of the file
splits that hold records of several lines are dealt by split, and only the lines
that open or close something are put in order file by file.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: More headers than this below one path are an error, not a layout.
MAX_HEADERS = 1000


def scan_lines(spark: SparkSession, path: str | list[str], folder_keys: Sequence[str] = ()) -> DataFrame:
    """(file, block, at, value, folder keys): every line with the split it
    lies in and a number that grows within the split. A carriage return before
    the line feed stays."""
    schema = T.StructType([T.StructField("value", T.StringType()), *[T.StructField(k, T.StringType()) for k in folder_keys]])
    rows = spark.read.schema(schema).option("lineSep", "\n").text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("at"), F.coalesce("value", F.lit("")).alias("value"), *folder_keys)


OUTSIDE, INSIDE, CLOSED, BARE, MISFIT = range(5)


def has_quotes(value="value"):
    return F.instr(F.col(value), '"') > 0


def leads_to(start: int, value="value", sep: str = ","):
    """Where a line that begins ``OUTSIDE`` or ``INSIDE`` a quoted field ends:
    ``OUTSIDE``, ``INSIDE`` or ``MISFIT``. The line is cut at its quotes; each
    part says what the quote behind it does."""
    text = bare(value)
    parts = F.split(text, '"', -1)
    state = lambda s: F.lit(s)

    def after(s, x):
        """The state behind the quote that follows the part ``x``."""
        opens = F.when(F.endswith(x, F.lit(sep)) | ((s == OUTSIDE) & (x == "")), state(INSIDE)).otherwise(state(BARE))
        return F.when(s == INSIDE, state(CLOSED)).when((s == MISFIT) | (F.instr(x, "\r") > 0), state(MISFIT)) \
            .when((s == CLOSED) & (x == ""), state(INSIDE)).when((s == CLOSED) & ~F.startswith(x, F.lit(sep)), state(MISFIT)).otherwise(opens)

    s = F.aggregate(F.slice(parts, F.lit(1), F.size(parts) - 1), state(start), after)
    x = F.element_at(parts, -1)
    end = F.when(s == INSIDE, state(INSIDE)) \
        .when((s == MISFIT) | (F.instr(x, "\r") > 0) | ((s == CLOSED) & (x != "") & ~F.startswith(x, F.lit(sep))), state(MISFIT)).otherwise(state(OUTSIDE))
    plain = state(INSIDE) if start == INSIDE else F.when(F.instr(text, "\r") > 0, state(MISFIT)).otherwise(state(OUTSIDE))
    return F.when(has_quotes(value), end).otherwise(plain)


def turns(value="value"):
    """Whether a line may open or close a record."""
    return has_quotes(value) & ((leads_to(OUTSIDE, value) == INSIDE) | (leads_to(INSIDE, value) == OUTSIDE))


def is_blank(value="value"):
    return F.trim(F.translate(F.col(value), "\r\t", "  ")) == ""


@dataclass(frozen=True)
class Audit:
    files: int
    lines: int
    open_lines: int  # that end inside a quoted field
    misfits: int  # that are no record by themselves, these included
    header_lines: int  # equal to the given header
    uniform: bool  # whether every file has that header once
    headers: tuple[str, ...]  # the headers that files begin with, if not uniform

    @property
    def clean(self) -> bool:
        """Whether a reader that takes each line for a record, and skips one
        header per file, is exact."""
        return self.uniform and not self.misfits


def bare(value="value"):
    """A line without the carriage return of its end."""
    return F.rtrim(F.col(value), F.lit("\r"))


def file_headers(lines: DataFrame) -> DataFrame:
    """(file, header): the first line of each file."""
    return lines.filter(F.col("block") == 0).groupBy("file").agg(F.min_by(bare(), "at").alias("header"))


def audit(spark: SparkSession, path: str | list[str], header: str) -> Audit:
    """One scan, and one row per file and task shuffled. ``header`` is that of
    any file; only if another file does not have it, or has it twice, a second
    scan collects the different headers."""
    lines = scan_lines(spark, path)
    followed = lines.select("file", bare().alias("text"), leads_to(OUTSIDE).alias("end"))
    end = F.col("end")
    files = followed.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.count_if(end == INSIDE).alias("open"), F.count_if(end != OUTSIDE).alias("odd"),
                                         F.count_if(F.col("text") == F.lit(header)).alias("heads"))
    found = files.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "open", "odd", "heads")], F.coalesce(F.bool_and(F.col("heads") == 1), F.lit(True))).first()
    if found[-1]:
        return Audit(*found, (header,))
    firsts = [r.header for r in file_headers(lines).select("header").distinct().limit(MAX_HEADERS + 1).collect()]
    if len(firsts) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers below {path}")
    return Audit(*found, tuple(sorted(firsts)))


def _marks(lines: DataFrame) -> DataFrame:
    """(file, block, k, own, after, rec_block, rec_k) for the ``k``-th turning
    line of each split: whether the line itself, and the lines after it, are
    part of a record of several lines, which ``rec_*`` name by where it opens.
    k = 0 stands for what lies before the first such line of a split, and is
    there only if a record runs on from an earlier split."""
    quoted = lines.filter(has_quotes()).select("file", "block", "at", leads_to(OUTSIDE).alias("out"), leads_to(INSIDE).alias("in"))
    quoted = quoted.withColumn("turn", ((F.col("out") == INSIDE) | (F.col("in") == OUTSIDE)).cast("long"))
    run = Window.partitionBy("file", "block").orderBy("at")
    # other lines so far that cannot lie inside a record: within the split, and in the splits before
    barrier = ((F.col("turn") == 0) & (F.col("in") != INSIDE)).cast("long")
    quoted = quoted.withColumn("bars", F.sum(barrier).over(run)).withColumn("k", F.sum("turn").over(run))
    splits = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = quoted.groupBy("file", "block").agg(F.max("bars").alias("total")).withColumn("base", F.coalesce(F.sum("total").over(splits), F.lit(0)))
    turning = quoted.filter(F.col("turn") == 1).join(base.select("file", "block", "base"), ["file", "block"]).withColumn("bars", F.col("bars") + F.col("base"))
    # what opens must be closed by the next line that cannot lie inside a record
    forth = Window.partitionBy("file").orderBy("block", "k")
    back = Window.partitionBy("file").orderBy(F.desc("block"), F.desc("k")).rowsBetween(Window.unboundedPreceding, -1)
    until = F.last(F.when(F.col("in") != INSIDE, F.struct("in", "bars")), True).over(back)
    turning = turning.withColumn("until", until) \
        .withColumn("able", F.coalesce((F.col("out") == INSIDE) & (F.col("until.in") == OUTSIDE) & (F.col("until.bars") == F.col("bars")), F.lit(False)))
    # a line that can open and close turns the state round; any other one sets it
    turning = turning.withColumn("sets", F.when(~(F.col("able") & (F.col("in") == OUTSIDE)), F.col("able")))
    turning = turning.withColumn("run", F.count("sets").over(forth)) \
        .withColumn("since", F.row_number().over(Window.partitionBy("file", "run").orderBy("block", "k"))) \
        .withColumn("value", F.first("sets").over(Window.partitionBy("file", "run").orderBy("block", "k")))
    turned = F.when(F.col("run") == 0, F.col("since") % 2 == 1).otherwise(F.col("value") != ((F.col("since") - 1) % 2 == 1))
    turning = turning.withColumn("after", turned).withColumn("before", F.lag("after", 1, False).over(forth))
    opener = F.last(F.when(F.col("after") & ~F.col("before"), F.struct("block", "k")), True).over(forth)
    turning = turning.withColumn("opener", opener).withColumn("own", F.col("before") | F.col("after"))
    marks = turning.select("file", "block", "k", "own", "after", "before", F.when(F.col("own"), F.col("opener.block")).alias("rec_block"), F.when(F.col("own"), F.col("opener.k")).alias("rec_k"))
    # a record that runs over the end of its split goes on in those up to its last line's
    over = marks.filter(F.col("before") & ~F.col("after") & (F.col("rec_block") < F.col("block"))) \
        .select(F.col("file").alias("f"), "rec_block", "rec_k", F.col("block").alias("until"))
    later = lines.select("file", F.col("block").alias("b")).distinct()
    carried = over.join(later, (F.col("f") == F.col("file")) & (F.col("b") > F.col("rec_block")) & (F.col("b") <= F.col("until"))) \
        .select("file", F.col("b").alias("block"), F.lit(0).cast("long").alias("k"), F.lit(True).alias("own"), F.lit(True).alias("after"), "rec_block", "rec_k")
    return marks.drop("before").unionByName(carried)


def framed_records(spark: SparkSession, path: str | list[str], folder_keys: Sequence[str] = (), any_open: bool = True) -> DataFrame:
    """(file, record, fits, folder keys): the text of every record below
    ``path``, good and bad, headers included, blank lines left out.
    ``any_open=False`` says that an audit found no line that opens a record."""
    lines = scan_lines(spark, path, folder_keys)
    alone = [bare().alias("record"), (leads_to(OUTSIDE) == OUTSIDE).alias("fits"), *folder_keys]
    if not any_open:
        return lines.filter(~is_blank()).select("file", *alone)
    marks = _marks(lines)
    touched = marks.filter("own").select("file", "block").distinct()
    plain = lines.join(touched, ["file", "block"], "left_anti")
    run = Window.partitionBy("file", "block").orderBy("at")
    placed = lines.join(touched, ["file", "block"], "left_semi").withColumn("turn", turns().cast("long")) \
        .withColumn("k", F.sum("turn").over(run)).join(marks, ["file", "block", "k"], "left")
    placed = placed.withColumn("inside", F.coalesce(F.when(F.col("turn") == 1, F.col("own")).otherwise(F.col("after")), F.lit(False)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "value"))), lambda x: x["value"]), "\n")
    whole = placed.filter("inside").groupBy("file", "rec_block", "rec_k", *folder_keys).agg(text.alias("value")) \
        .select("file", bare().alias("record"), F.lit(True).alias("fits"), *folder_keys)
    rest = plain.select("file", "value", *folder_keys).unionByName(placed.filter(~F.col("inside")).select("file", "value", *folder_keys))
    return rest.filter(~is_blank()).select("file", *alone).unionByName(whole)
