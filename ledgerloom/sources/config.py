"""Typed configuration from YAML with ``${VAR:-default}``, and the session made from it."""

from __future__ import annotations

import logging
import os
import re
from logging.handlers import RotatingFileHandler
from pathlib import Path

import yaml
from pyspark.sql import SparkSession

_VAR = re.compile(r"\$\{(\w+)(?::-([^}]*))?\}")


def coerce(text: str):
    """An interpolated text as what it spells: bool, int, float, None or itself."""
    try:
        value = yaml.safe_load(text)
    except yaml.YAMLError:
        return text
    return value if isinstance(value, bool | int | float) or value is None and text.strip().lower() in ("null", "~") else text


def interpolate(node, env=None):
    """``${VAR:-default}`` replaced everywhere; an unset variable without default is the empty text."""
    env = os.environ if env is None else env
    if isinstance(node, dict):
        return {k: interpolate(v, env) for k, v in node.items()}
    if isinstance(node, list):
        return [interpolate(v, env) for v in node]
    if isinstance(node, str) and _VAR.search(node):
        return coerce(_VAR.sub(lambda m: env.get(m[1]) or m[2] or "", node))
    return node


def load_config(path: str, env=None) -> dict:
    return interpolate(yaml.safe_load(Path(path).read_text()) or {}, env)


def flatten(config: dict, depth: int = 2, limit: int = 250) -> dict[str, str]:
    """``section.key`` to text, cut to ``limit`` characters, for run parameters."""
    out: dict[str, str] = {}

    def walk(node, name, level):
        if isinstance(node, dict) and level < depth:
            for k, v in node.items():
                walk(v, f"{name}.{k}" if name else str(k), level + 1)
        else:
            out[name] = str(node)[:limit]

    walk(config, "", 0)
    return out


def session_conf(config: dict) -> dict[str, str]:
    """Submit arguments: master, application name and every entry of ``spark.configs``."""
    spark = config.get("spark", {})
    own = {str(k): str(v).lower() if isinstance(v, bool) else str(v) for k, v in (spark.get("configs") or {}).items()}
    return own | {f"spark.{k}": str(spark[n]) for k, n in (("app.name", "app_name"), ("master", "master")) if spark.get(n)}


def create_spark_session(config: dict) -> SparkSession:
    conf = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC"} | session_conf(config)
    spark = SparkSession.builder.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel(str(config.get("spark", {}).get("log_level", "WARN")))
    return spark


def setup_logging(config: dict) -> logging.Logger:
    own = config.get("logging", {})
    log = logging.getLogger("ledgerloom")
    log.setLevel(own.get("level", "INFO"))
    if not log.handlers:
        log.addHandler(logging.StreamHandler())
        if own.get("file"):
            Path(own["file"]).parent.mkdir(parents=True, exist_ok=True)
            log.addHandler(RotatingFileHandler(own["file"], maxBytes=int(own.get("max_bytes", 10_000_000)), backupCount=int(own.get("backups", 5))))
    return log
