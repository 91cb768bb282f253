"""Files that executors write and read outside Spark's own sources, on any store that driver and executors share."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """The full URI of a path, by the file system that Spark itself takes for it. Executors open only such URIs."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toString()


def delete(spark: SparkSession, uri: str) -> None:
    """Deletes a file or folder, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _local(uri: str) -> str | None:
    return "/" + uri[5:].lstrip("/") if uri.startswith("file:") else None


def open_write(uri: str):
    """A binary file to write; folders are made as needed."""
    if path := _local(uri):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    return store.open_output_stream(path)


def open_read(uri: str):
    """A binary file to read, with seek()."""
    if path := _local(uri):
        return open(path, "rb")
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)
