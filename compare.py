"""Time the cleaning steps in Spark and in single-threaded pandas; prints one JSON line.

COMPARE_COPIES copies of the tables, keys shifted and a third of the rows with one key, are
written to a folder under COMPARE_DIR first (0: the tables themselves). BENCH_SF_DIR and
BENCH_CPUS are those of bench.py. Each step runs twice, the second time counts.
"""

from __future__ import annotations

import json
import os
import time
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession, functions as F

from bench import CPUS, FOLDER
from millrace.operators import cleaning, quality, regression
from millrace.queries import dirty
from millrace.session import build_session

COPIES = int(os.environ.get("COMPARE_COPIES", "0"))
COMPARE_DIR = os.environ.get("COMPARE_DIR", "/tmp")
FEATURES = {"l_quantity": "x_1", "l_discount": "x_2", "l_tax": "x_3", "l_extendedprice": "y"}


def enlarged(spark: SparkSession) -> str:
    """A folder with ``lineitem`` in COPIES copies, 16 files; a third of it is one order."""
    folder = f"{COMPARE_DIR}/compare-{uuid.uuid4().hex}"
    rows = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    copy = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
    shifted = rows.withColumn("copy", copy).withColumn(
        "l_orderkey", F.when(F.col("copy") % 3 == 0, F.lit(0).cast("bigint")).otherwise(
            F.col("l_orderkey") + F.col("copy") * 10_000_000))
    shifted.drop("copy").repartition(16).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def spoiled(folder: str) -> pd.DataFrame:
    rows = pd.read_parquet(f"{folder}/lineitem.parquet", columns=list(FEATURES)).rename(columns=FEATURES)
    rows = rows[["x_1", "x_2", "x_3", "y"]]
    rows["x_1"] = rows["x_1"].where(rows["x_1"] != 13)
    rows["x_2"] = rows["x_2"].where(rows["x_2"] != 0.1)
    return pd.concat([rows, rows[rows["x_3"] == 0.08]])


def fit(rows: pd.DataFrame) -> np.ndarray:
    x = np.column_stack([np.ones(len(rows)), rows[["x_1", "x_2", "x_3"]]])
    return np.linalg.lstsq(x, rows["y"], rcond=None)[0]


def main() -> None:
    spark = build_session("compare", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    folder = enlarged(spark) if COPIES else FOLDER

    def written(df):
        df.write.format("noop").mode("overwrite").save()

    steps = {
        "count nulls": (lambda: spoiled(folder).isna().sum(),
                        lambda: quality.null_counts(dirty(spark, folder)).collect()),
        "clean": (lambda: spoiled(folder).drop_duplicates().dropna(),
                  lambda: written(cleaning.clean(dirty(spark, folder)))),
        "clean and fit": (lambda: fit(spoiled(folder).drop_duplicates().dropna()),
                          lambda: regression.fit_linear(cleaning.clean(dirty(spark, folder)))),
    }
    seconds = {}
    for name, pair in steps.items():
        for engine, step in zip(("pandas", "spark"), pair):
            for _ in range(2):
                start = time.perf_counter()
                step()
                seconds[f"{name}, {engine}"] = round(time.perf_counter() - start, 3)
    print(json.dumps({"copies": COPIES, "cpus": int(CPUS), "seconds": seconds}))
    spark.stop()


if __name__ == "__main__":
    main()
