"""What a stage's result depends on, as one short text.

A stage is unchanged if its parameters, its upstream stages and the files behind
its sources are. A file counts by path, length and modification time (one listing
a folder). A source without files has no fingerprint, so whatever depends on it
always runs. ``LAYOUT`` is raised when the meaning of a stage changes.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid

from pyspark.sql import DataFrame

LAYOUT = 1


def _digest(value) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()


def source_fingerprint(df: DataFrame) -> str:
    """Columns and files of a source; unlike any other if there are no files."""
    files = sorted(df.inputFiles())
    if not files:
        return uuid.uuid4().hex
    spark = df.sparkSession
    conf, status = spark._jsc.hadoopConfiguration(), {}
    for folder in sorted({os.path.dirname(f) for f in files}):
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        for s in path.getFileSystem(conf).listStatus(path):
            status[s.getPath().getName(), folder] = (s.getLen(), s.getModificationTime())
    named = [(f, *status.get((spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f)).getName(), os.path.dirname(f)), (None,)))
             for f in files]
    return _digest([df.schema.simpleString(), named])


def stage_fingerprint(name: str, parameters: dict, upstream: list[str]) -> str:
    return _digest([LAYOUT, name, parameters, upstream])
