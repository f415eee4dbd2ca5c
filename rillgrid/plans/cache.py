"""Results that several later steps read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def _shared(df: DataFrame) -> str:
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        given = df.sparkSession.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not given and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="rillgrid-ckpt-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """df computed once and kept in the folder of spark.checkpoint.dir (one of our own where it is unset), which all executors share."""
    _shared(df)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """As cut(), as Parquet, for rounds that join their own results: a checkpoint keeps the planner's guess of its size, which such
    rounds multiply without end; of files the true size is known."""
    at = f"{_shared(df)}/rillgrid-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
