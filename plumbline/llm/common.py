"""Helpers that the operators share: words, the shared folder, and tables written between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words between ASCII white space, and words of letters and digits (everything beyond ASCII counts as a letter).
SPACED = r"[^\x20\x09-\x0D]+"
LETTERED = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text):
    """A-Z to lower case, nothing else. ``lower`` does that only where every character is ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, as in tests, a new temporary one of this session."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir()
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage, and any executor can read it again."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(ident, text):
    """64 bits that name a row by its id, null or not, and its text: rows that share them are repetitions of each other."""
    return F.xxhash64(ident.isNull(), ident, text)


def fresh(name: str, df: DataFrame) -> str:
    """A column name that the frame does not have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name
