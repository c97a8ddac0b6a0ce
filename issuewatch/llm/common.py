"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: A word is a run of anything but the ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write `df` to the shared scratch folder and read it back.

    The files live in the folder that `spark.checkpoint.dir` names, so a lost executor
    costs a re-read and not a re-run of everything before it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(df: DataFrame) -> None:
    """Delete the scratch files behind a frame that `materialise` returned."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def id_remainder(id_col: Column, modulus: int) -> Column:
    """crc32 of the id's text modulo `modulus`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % modulus


def words(text: Column) -> Column:
    """The words of a text (null: none) as an array."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), 0)


T = TypeVar("T")


def per_worker(key: str, make: Callable[[], T]) -> T:
    """A value that a Python worker makes once and keeps for its later tasks.

    The package travels to the workers by value, so its own module globals start anew
    with each task; a module registered in the worker does not.
    """
    name = "_issuewatch_worker_state"
    state = sys.modules.setdefault(name, ModuleType(name)).__dict__
    if key not in state:
        state[key] = make()
    return state[key]
