"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltwatch.session import ensure_checkpoint_dir

#: Stands for a null doc_id inside join keys.
NO_ID = -(2**63)
#: The characters that end a word in the contracts' `[^\x20\x09-\x0D]+`.
SPACES = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df below the shared checkpoint folder and read it back.

    Cuts lineage with a file that survives executor loss; smaller than
    ``checkpoint()`` because Parquet compresses.  The file system deletes the
    folder when the driver ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def doc_key() -> list[Column]:
    """(kd, kt): identifies a document row even if doc_id is null or repeated.

    Rows that agree in both are copies of one row; every operator gives such
    rows the same result.
    """
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("kd"),
        F.xxhash64(text_of()).alias("kt"),
    ]


def with_text(out: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The columns of docs out of ``row``, with a new text and its length."""
    own = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return out.select(*(own[c].alias(c) if c in own else F.col("row")[c].alias(c) for c in docs.columns))
