"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartwise.session import scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A batch of results is handed on when it holds so many rows or bytes.
OUT_ROWS, OUT_BYTES = 4000, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(name: str, taken) -> str:
    """``name``, with underscores in front until no column has it."""
    while name.lower() in {t.lower() for t in taken}:
        name = "_" + name
    return name


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared folder and read it
    back: lineage ends there, so a lost executor costs no earlier stage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def freed(df: DataFrame, name: str) -> DataFrame:
    """``materialise``, after which Spark removes the shuffle files behind the
    rows at once, not when the driver happens to collect its garbage. The
    setting is the session's own again afterwards."""
    conf, setting = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(setting, None)
    conf.set(setting, "true")
    try:
        return materialise(df, name)
    finally:
        conf.unset(setting) if before is None else conf.set(setting, before)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names, so further
    columns of the input can have any name."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def batch_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches, one at a time: only one row's Python
    objects live at once, however long the texts are."""
    for b in batches:
        cols = b.columns
        for i in range(b.num_rows):
            yield tuple(c[i].as_py() for c in cols)


def to_batches(rows: Iterable[tuple], schema: pa.Schema, weigh: Callable[[tuple], int] | None = None) -> Iterator[pa.RecordBatch]:
    """Pack row tuples into record batches of bounded rows and bytes."""
    buf: list[tuple] = []
    size = 0
    for r in rows:
        buf.append(r)
        size += weigh(r) if weigh else 0
        if len(buf) >= OUT_ROWS or size >= OUT_BYTES:
            yield _pack(buf, schema)
            buf, size = [], 0
    if buf:
        yield _pack(buf, schema)


def _pack(buf: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*buf, strict=True), schema.types, strict=True)], schema=schema)


#: Unicode white space, as regular expressions of the tokenizers see it (str.isspace() also takes \x1c-\x1f).
WHITE = "\t-\r \x85\xa0  -     　"


class Recent(dict):
    """A cache of two generations: when the young one is full it becomes the
    old one, so memory is bounded and frequent keys stay."""

    def __init__(self, make: Callable, most: int = 150_000):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 stands for itself, the other bytes for the
    characters from U+0100 on, in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return {b: chr(b if b in own else next(rest)) for b in range(256)}


def held_out(id_col: str, folds: int, fold: int):
    """Whether crc32 of the id, as text, falls into the given fold (a null
    id: crc32 of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == F.lit(fold)


def bounded_rows(ids: DataFrame, class_col: str, id_col: str, most: int) -> DataFrame:
    """At most ``most`` rows in all, as many of each class as there are or as
    fit, chosen by a hash of the id: the same rows on every run. Adds
    ``of_class``, the number of rows of the class before choosing. ``ids``
    should hold little more than its id and class."""
    counts = {r[0]: r[1] for r in ids.groupBy(class_col).count().collect()}
    if not counts:
        return ids.withColumn("of_class", F.lit(0).cast("long"))
    each = max(1, most // len(counts))
    rank = F.pmod(F.xxhash64(id_col, F.lit("choose")), F.lit(1 << 40))
    n = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])[F.col(class_col)]
    # a hash threshold first, so that little is sorted
    near = ids.withColumn("rank", rank).withColumn("of_class", n.cast("long")) \
        .filter(F.col("rank") <= (F.lit(1.3 * each + 50) / F.col("of_class") * F.lit(float(1 << 40))))
    best = Window.partitionBy(class_col).orderBy("rank", id_col)
    return near.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= each).drop("k", "rank")
