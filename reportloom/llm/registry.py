"""Named queries of this folder and their SQL."""

from __future__ import annotations

from functools import wraps
from pathlib import Path

from pyspark.sql import SparkSession

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def importable(spark: SparkSession) -> None:
    """Let Python workers that see this checkout import it; elsewhere the package comes with --py-files."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [root, env.get("PYTHONPATH", "")]))


def query(name: str, sql: str | None = None):
    def add(f):
        @wraps(f)
        def run(spark, sf_dir):
            importable(spark)
            return f(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return add
