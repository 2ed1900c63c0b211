"""Settings of a build: paths, files and column maps, from JSON, or from YAML where its reader is installed."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def read_config(spark: SparkSession, path: str) -> dict:
    """The whole document; no settings if it is empty. Reads any store that Spark does."""
    text = spark.read.text(path, wholetext=True).first()
    text = text[0] if text else ""
    if path.lower().endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("YAML settings need the yaml package; JSON is read without it") from error
        return yaml.safe_load(text) or {}
    return json.loads(text) if text.strip() else {}


def of(config: dict, *keys: str, default=None):
    """A nested setting, the default where a part of the way is missing or empty."""
    for k in keys:
        config = (config or {}).get(k)
    return default if config in (None, "") else config
