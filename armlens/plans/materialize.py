"""Cut lineage in the shared checkpoint folder.

``cut_lineage(df, name)`` checkpoints ``df`` (reliable, eager) into the folder
the session names in ``spark.checkpoint.dir`` and returns the checkpointed
frame, annotated with the rows and value bytes observed while it was computed
(no extra job). Downstream plans then start at the checkpoint: they are short to
analyse, a lost executor recomputes nothing upstream of it, and the size is a
proven bound when the frame is broadcast.

``write_counted`` writes parquet and returns the observed size; table names are
switched by ``plans.tables``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from armlens.plans.sizing import Size, row_bytes, with_size
from armlens.session import ensure_checkpoint_dir


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    obs = Observation(f"size_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")), obs


def _size(obs: Observation) -> Size:
    return Size(int(obs.get["rows"]), int(obs.get["bytes"]))


def write_counted(df: DataFrame, path: str, mode: str = "errorifexists") -> Size:
    """Write parquet and return the rows and value bytes written (observed metrics)."""
    watched, obs = _observed(df)
    watched.write.mode(mode).parquet(path)
    return _size(obs)


def cut_lineage(df: DataFrame, name: str, as_table: bool = False) -> DataFrame:
    """``as_table=False``: reliable eager checkpoint (cheapest for the small
    experiment dimensions). ``as_table=True``: a parquet table in a sub-folder of
    the checkpoint directory (columnar and compressed: the right cut for a fact
    table that is read again several times)."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    if as_table:
        path = f"{root}/armlens-tables/{name}-{uuid.uuid4().hex}"
        size = write_counted(df, path)
        return with_size(spark.read.schema(df.schema).parquet(path), size)
    watched, obs = _observed(df)
    out = watched.checkpoint(eager=True)
    return with_size(out, _size(obs))
