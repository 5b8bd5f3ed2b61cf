"""Size checks that decide between a broadcast and a shuffled join.

A side is broadcast only after its row count was proven to be small by a count,
of which every task sends one number. Beyond the bound the join stays
a shuffled equi-join, which adaptive execution splits where keys are hot.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_ROWS = 200_000
# A zone cell is two ints, a key and a weight: about 64 bytes in a hashed relation.
BROADCAST_CELLS = 2_000_000


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast when it is proven to hold at most ``max_rows`` rows,
    and for a sort-merge join otherwise: the planner's own estimate does not see
    how far an ``explode`` multiplies rows and might broadcast them."""
    if df.count() <= max_rows:
        return F.broadcast(df)
    return df.hint("merge")


def sized_cells(cells: DataFrame, max_cells: int, limit: int = BROADCAST_CELLS) -> DataFrame:
    """The same choice for zone cells whose number is bounded by ``max_cells``."""
    return F.broadcast(cells) if max_cells <= limit else cells.hint("merge")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the one the session names in ``spark.checkpoint.dir``.

    Only a local session without the setting falls back to a temporary folder;
    elsewhere executors could not see it, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back; ``options`` are the writer's.

    For frames that several later stages read: their sources are scanned once, the
    lineage is cut, and a lost executor costs a re-read of shared storage.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
