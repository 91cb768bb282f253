"""Helpers that the corpus operators share."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: A-Z to a-z, the only case folding that the word contracts ask for.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: what spark.checkpoint.dir names.

    Only a local session without that setting gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(found := tempfile.mkdtemp(prefix="tramlake-"))
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared checkpoint folder, so that later stages neither recompute it nor depend on one executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions_for(rows: DataFrame, bytes_each: int = 256 << 20) -> int:
    """As many partitions as a shuffle of the rows has, or more if the optimizer's estimate of their bytes asks for them."""
    estimate = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    asked = estimate // bytes_each if estimate < 1 << 60 else 0  # beyond that it is no estimate
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), asked)


def whole_row(docs: DataFrame, keep: list[str] | None = None) -> Column:
    """The columns `keep` (all by default) as one struct named row, whatever they are called."""
    return F.struct(*(F.col(f"`{c}`") for c in keep or docs.columns)).alias("row")


def with_text(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns row and text, or row alone if it has the text: a batch for Python holds each text once."""
    kept = keep or docs.columns
    return docs.select(whole_row(docs, kept), *(["text"] if "text" not in kept else []))


def texts_of(batch) -> list[bytes]:
    """The texts of such a batch as UTF-8; null is empty."""
    column = batch.column("text") if "text" in batch.schema.names else batch.column("row").field("text")
    return [t or b"" for t in column.cast("binary").to_pylist()]


def row_schema(rows: DataFrame, more: str) -> T.StructType:
    """The type of the column row, followed by the columns of a DDL string."""
    return T.StructType([rows.schema["row"], *T.StructType.fromDDL(more).fields])


def as_bytes(name: str) -> Column:
    """A text column's UTF-8; null becomes empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


def crc32_of_id(name: str) -> Column:
    """crc32 of the id written as decimal text (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


#: Bytes of a text that are split into words at once.
BLOCK = 1 << 20


def text_blocks(spaced: bytes, limit: int = BLOCK):
    """A text whose separators are all spaces, cut at spaces into pieces of about `limit` bytes, so that a very long text is
    never split into words as a whole."""
    at, end = 0, len(spaced)
    while end - at > limit:
        stop = spaced.find(b" ", at + limit)
        if stop < 0:
            break
        yield spaced[at:stop]
        at = stop
    yield spaced[at:] if at else spaced


def word_blocks(spaced: bytes, limit: int = BLOCK):
    """The words of text_blocks(), a list for each piece."""
    return map(bytes.split, text_blocks(spaced, limit))


def spacing(separators) -> bytes:
    """A bytes.translate table that lower-cases A-Z and turns the separator bytes into spaces."""
    out = bytearray(range(256))
    out[65:91] = LOWER.encode()
    for b in separators:
        out[b] = 32
    return bytes(out)
