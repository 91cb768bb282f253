"""Payloads as files: one a node and date, on any store that the session's file systems reach."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F


class Blobs:
    """Files under a folder. Single blobs go through the driver; read() gives many as rows."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _at(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def path(self, node: str, date: datetime) -> str:
        return f"{self.folder}/{node}/{date:%Y-%m-%d_%H-%M-%S}"

    def put(self, node: str, date: datetime, data: bytes | str | None) -> str:
        """Writes a blob (an empty one for None), over any that is there, and returns its path."""
        store, place = self._at(path := self.path(node, date))
        stream = store.create(place, True)
        try:
            stream.write(bytearray(data.encode() if isinstance(data, str) else data or b""))
        finally:
            stream.close()
        return path

    def get(self, path: str) -> bytes:
        """A blob's bytes; a blob that is not there raises."""
        row = self.read([path]).first()
        return bytes(row.content) if row else b""  # the reader gives no row for an empty file

    def read(self, paths: list[str] | str) -> DataFrame:
        """path and content of the files; empty ones give no row."""
        return self.spark.read.format("binaryFile").load(paths).select("path", "content")

    def snapshots(self, node: str) -> DataFrame:
        """date and data (text) of a node's blobs, as compaction reads them; a task opens the files it is dealt."""
        rows = self.spark.read.format("binaryFile").load(f"{self.folder}/{node}")
        return rows.select(F.to_timestamp_ntz(F.substring_index("path", "/", -1), F.lit("yyyy-MM-dd_HH-mm-ss")).alias("date"), F.col("content").cast("string").alias("data"))

    def delete(self, path: str) -> bool:
        """Removes a blob or a folder; False if there is none."""
        store, place = self._at(path)
        return store.delete(place, True)
