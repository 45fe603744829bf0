"""Id codes that survive new rows: a stored dictionary that each load extends.

``dense_codes`` ranks the keys of one table, so codes change when rows are added. Here a key keeps the code it was first
given: a load counts its keys, looks them up in the stored codes, and numbers the new ones without gaps behind the largest
code of their kind, in ascending order. Only the new keys are written, to a folder of their own.

A load becomes visible by the ``_SUCCESS`` file that Spark's committer writes last (its default). A load that was lost
half way leaves a folder without one, which is not read and which the next load replaces, so a repeated load gives the
same codes. One load at a time: two that run side by side would number the same codes.

Edge cases: NULL keys get no code; equal texts in two columns are two keys; a load without new keys writes nothing, an
empty first load neither; further columns are left alone.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewscope.operators.encode import Codes, distinct_keys, number_keys
from reviewscope.session import materialize

SCHEMA = "kind string, key string, code bigint"


def complete_loads(spark: SparkSession, folder: str) -> dict[int, str]:
    """Number and path of the loads that were written to their end."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/load=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    paths = [str(status.getPath().getParent().toString()) for status in found]
    return {int(re.search(r"load=(\d+)$", path)[1]): path for path in paths}


def read_codes(spark: SparkSession, folder: str) -> DataFrame:
    """All stored (kind, key, code)."""
    paths = complete_loads(spark, folder).values()
    return spark.read.schema(SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], SCHEMA)


def extend(df: DataFrame, columns: list[str], folder: str) -> Codes:
    """Give the new keys of ``columns`` codes and store them; returns the codes of the keys that occur in ``df``.

    Keys are joined after they were made distinct, so a hot key is one row. ``sizes`` counts the keys and rows of ``df``,
    which is what ``apply_codes`` sizes its joins by.
    """
    spark = df.sparkSession
    loads, stored = complete_loads(spark, folder), read_codes(spark, folder)
    looked_up = materialize(distinct_keys(df, columns).join(stored, ["kind", "key"], "left"), "keys")
    taken = {c: (0, 0) for c in columns}
    taken |= {r["kind"]: (r["top"] + 1, 0) for r in stored.where(F.col("kind").isin(columns)).groupBy("kind").agg(F.max("code").alias("top")).collect()}
    new = number_keys(looked_up.where("code is null").drop("code"), taken)
    appended = spark.createDataFrame([], f"{SCHEMA}, n bigint")
    if any(new.sizes[c] != taken[c] for c in columns):
        path = f"{folder}/load={max(loads, default=0) + 1}"
        new.table.select("kind", "key", "code").write.mode("overwrite").parquet(path)
        appended = new.table
    sizes = {c: (0, 0) for c in columns}
    sizes |= {r["kind"]: (r["keys"], r["rows"]) for r in looked_up.groupBy("kind").agg(F.count("*").alias("keys"), F.sum("n").alias("rows")).collect()}
    return Codes(looked_up.where("code is not null").unionByName(appended), sizes)
