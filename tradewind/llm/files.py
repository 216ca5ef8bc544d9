"""Files that tasks write and read themselves, in the shared folder or any store pyarrow knows."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from tradewind.session import shared_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """URI of a new folder under the cluster's shared folder. Files in it have unique names, so a task
    that runs again, or twice at once, never touches what another attempt wrote; only the files that
    the index of a finished task names are read."""
    base = shared_folder(spark)
    return f"{base if '://' in base else 'file://' + base}/{name}-{uuid.uuid4()}"


def create(folder: str, suffix: str):
    """A new file to write to, and its URI."""
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    name = f"{uuid.uuid4()}{suffix}"
    return store.open_output_stream(f"{path}/{name}", compression=None), f"{folder}/{name}"


def open_file(uri: str):
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)
