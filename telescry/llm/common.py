"""Helpers shared by the operators: whole-table reads, words, Arrow maps and the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from telescry.session import shared_dir

#: A word, as every operator of this package counts it.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text"):
    """The text with null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def map_rows(df: DataFrame, schema: str, rows: Callable[[dict[str, list]], Iterator[dict[str, list]]]) -> DataFrame:
    """Run ``rows`` over the Arrow batches of each partition.

    ``rows`` gets the columns of one batch as lists and yields columns of the result, so that a task never
    holds more than one batch and what it makes of it.
    """
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            for out in rows(batch.to_pydict()):
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def free_name(name: str, df: DataFrame) -> str:
    """The name, longer by underscores where a column of the input has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared checkpoint folder, which every executor sees."""
    return f"{shared_dir(spark, name)}-{uuid.uuid4().hex[:8]}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it again, so that lost executors cost no recomputation."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
