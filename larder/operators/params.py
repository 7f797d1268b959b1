"""Model parameters: initial values, Adam, sums over tasks, and their Parquet form."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Params = dict[str, np.ndarray]
CHUNK = 8192
SUM_SCHEMA = "name string, at bigint, values array<double>"


def known_settings(defaults: dict, config: dict | None) -> dict:
    """The defaults under the given settings; a setting that has no default is an error."""
    unknown = sorted(set(config or {}) - set(defaults))
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    return defaults | (config or {})


def linear_init(rng: np.random.Generator, n_in: int, n_out: int) -> tuple[np.ndarray, np.ndarray]:
    """Weight and bias, uniform within 1 / sqrt(n_in)."""
    bound = 1.0 / np.sqrt(n_in)
    return rng.uniform(-bound, bound, (n_in, n_out)), rng.uniform(-bound, bound, n_out)


class Adam:
    """Adam with the usual constants; the state can be averaged across tasks."""

    def __init__(self, lr: float, m: Params | None = None, v: Params | None = None, t: float = 0.0):
        self.lr, self.m, self.v, self.t = lr, m or {}, v or {}, t

    def step(self, params: Params, grads: Params) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] = 0.9 * self.m.get(k, 0.0) + 0.1 * g
            self.v[k] = 0.999 * self.v.get(k, 0.0) + 0.001 * g * g
            m, v = self.m[k] / (1 - 0.9**self.t), self.v[k] / (1 - 0.999**self.t)
            params[k] = params[k] - self.lr * m / (np.sqrt(v) + 1e-8)


def as_chunks(named: Params) -> pd.DataFrame:
    """Arrays as rows (name, at, values) of at most CHUNK numbers."""
    rows = [
        (name, at, flat[at : at + CHUNK])
        for name, flat in ((n, np.asarray(a, dtype=np.float64).ravel()) for n, a in named.items())
        for at in range(0, len(flat), CHUNK)
    ]
    return pd.DataFrame(rows, columns=["name", "at", "values"])


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.sum(np.stack(pdf["values"].to_numpy()), axis=0)
    return pd.DataFrame({"name": pdf["name"].iloc[:1], "at": pdf["at"].iloc[:1], "values": [total]})


def sum_over_tasks(chunks: DataFrame, two_levels: bool = True) -> Params:
    """Sum equal chunks on the executors and return flat arrays by name.

    What reaches the driver is one copy of the model, whatever the number of tasks.
    Two levels keep the rows that meet in one task few when there are many tasks.
    """
    if two_levels:
        salted = chunks.withColumn("salt", F.spark_partition_id() % 16)
        chunks = salted.groupBy("name", "at", "salt").applyInPandas(_add, SUM_SCHEMA)
    total = chunks.groupBy("name", "at").applyInPandas(_add, SUM_SCHEMA).toPandas()
    return {
        name: np.concatenate(list(part.sort_values("at")["values"])) for name, part in total.groupby("name")
    }


def shaped(flat: Params, like: Params) -> Params:
    return {k: flat[k].reshape(np.shape(a)) for k, a in like.items()}


def params_frame(spark: SparkSession, params: Params) -> DataFrame:
    """(name, shape, at, values): the model as a table."""
    rows = as_chunks(params)
    rows["shape"] = [list(np.shape(params[n])) for n in rows["name"]]
    rows["values"] = [v.tolist() for v in rows["values"]]
    return spark.createDataFrame(
        rows[["name", "shape", "at", "values"]], "name string, shape array<int>, at bigint, values array<double>"
    )


def write_params(spark: SparkSession, params: Params, path: str) -> None:
    params_frame(spark, params).write.mode("overwrite").parquet(path)


def read_params(spark: SparkSession, path: str) -> Params:
    rows = spark.read.parquet(path).toPandas().sort_values(["name", "at"])
    return {
        name: np.concatenate(list(part["values"])).reshape(tuple(part["shape"].iloc[0]))
        for name, part in rows.groupby("name")
    }
