"""Reading the two company sources to fixed schemas."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import parse_string_array
from ledgerloom.plans.scratch import settle

_S, _A = T.StringType(), T.ArrayType(T.StringType())
SUPPLY_CHAIN = T.StructType([T.StructField("corporate_name_S1", _S), T.StructField("address", _S), T.StructField("activity_places", _A), T.StructField("top_suppliers", _A), T.StructField("country", _S), T.StructField("postal_code", _S), T.StructField("industry_sector", _S)])
FINANCIALS = T.StructType([T.StructField("corporate_name_S2", _S), T.StructField("main_customers", _A), T.StructField("revenue", T.DoubleType()), T.StructField("profit", T.DoubleType()), T.StructField("country", _S), T.StructField("postal_code", _S), T.StructField("industry_sector", _S), T.StructField("fiscal_year", T.IntegerType())])


@dataclass(frozen=True)
class SourceConfig:
    path: str
    format: str = "csv"
    header: bool = True
    name: str = ""
    reconcile: bool = True
    min_records: int = 0
    options: tuple[tuple[str, str], ...] = ()
    quarantine: str | None = None  # a folder that gets the rejects, as Parquet


def with_retry(action: Callable, attempts: int = 3, first_wait: float = 2.0, longest: float = 10.0, sleep: Callable[[float], None] = time.sleep):
    """Run ``action``; after a failure wait exponentially longer, and at last raise."""
    for k in range(attempts):
        try:
            return action()
        except Exception:
            if k == attempts - 1:
                raise
            sleep(min(longest, first_wait * 2**k))
    raise AssertionError


def read_raw(spark: SparkSession, cfg: SourceConfig) -> DataFrame:
    """Any Spark format. CSV columns stay text, so that leading zeros survive.

    With ``quarantine``, CSV lines with too few or too many fields are kept whole in ``_corrupt_record``, as JSON lines are by Spark itself.
    """
    reader = spark.read.format(cfg.format)
    if cfg.format == "csv":
        reader = reader.option("header", str(cfg.header).lower()).option("inferSchema", "false").option("escape", '"')
    raw = reader.options(**dict(cfg.options)).load(cfg.path)
    if cfg.quarantine and cfg.format == "csv":
        raw = reader.options(**dict(cfg.options)).schema(raw.schema.add(CORRUPT, T.StringType())).option("columnNameOfCorruptRecord", CORRUPT).load(cfg.path)
    return raw


def schema_diff(have: T.StructType, want: T.StructType) -> tuple[set[str], set[str]]:
    """Names missing from and extra to ``have``."""
    return set(want.names) - set(have.names), set(have.names) - set(want.names)


def _cast(field: T.StructField, have: T.StructType) -> Column:
    if field.name not in have.names:
        return F.lit(None).cast(field.dataType).alias(field.name)
    kind, c = have[field.name].dataType, F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.ArrayType) and not isinstance(kind, T.ArrayType):
        return parse_string_array(c.cast("string")).cast(field.dataType).alias(field.name)
    if isinstance(kind, T.StringType) and isinstance(field.dataType, T.StructType):
        return F.from_json(c, field.dataType).alias(field.name)
    if isinstance(kind, T.StringType) and not isinstance(field.dataType, T.StringType):
        return c.try_cast(field.dataType).alias(field.name)
    return c.cast(field.dataType).alias(field.name)


def reconcile(df: DataFrame, want: T.StructType) -> DataFrame:
    """Exactly the wanted columns in order: cast, missing ones as typed nulls, extra ones dropped."""
    return df.select(*[_cast(f, df.schema) for f in want])


#: Where Spark's readers put a line that they can't parse.
CORRUPT = "_corrupt_record"
#: One value that its column's type refused, or a line that its format refused (column null).
REJECT = "struct<column: string, reason: string, value: string>"


def _refused(field: T.StructField, have: T.StructType) -> Column | None:
    """A reject where a text is there and its wanted value isn't; null where all is well, None where nothing can be refused."""
    if field.name not in have.names or not isinstance(have[field.name].dataType, T.StringType) or isinstance(field.dataType, T.StringType | T.ArrayType):
        return None
    raw = F.col(f"`{field.name}`")
    reject = F.struct(F.lit(field.name).alias("column"), F.lit(f"not a {field.dataType.simpleString()}").alias("reason"), raw.alias("value"))
    if isinstance(field.dataType, T.StructType):
        parsed = F.from_json(raw, T.StructType([*field.dataType.fields, T.StructField(CORRUPT, T.StringType())]), {"columnNameOfCorruptRecord": CORRUPT})
        return F.when((F.trim(raw) != "") & (parsed.isNull() | parsed[CORRUPT].isNotNull()), reject)
    return F.when((F.trim(raw) != "") & raw.try_cast(field.dataType).isNull(), reject)


def checked(df: DataFrame, want: T.StructType) -> DataFrame:
    """``reconcile`` with ``_rejects``: an array (``REJECT``) of what would otherwise turn into null in silence.

    Blank texts are missing values, no rejects. A line that the reader could not parse (``_corrupt_record``) is one reject with the whole line.
    """
    found = [r for f in want if (r := _refused(f, df.schema)) is not None]
    if CORRUPT in df.columns:
        line = F.col(CORRUPT)
        found.append(F.when(line.isNotNull(), F.struct(F.lit(None).cast("string").alias("column"), F.lit("corrupt record").alias("reason"), line.alias("value"))))
    rejects = F.filter(F.array(*found), lambda r: r.isNotNull()) if found else F.array().cast(f"array<{REJECT}>")
    return df.select(*[_cast(f, df.schema) for f in want], rejects.alias("_rejects"))


def split_rejects(df: DataFrame, want: T.StructType, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows without a reject, rejects as (key, column, reason, value)), from one pass that is written once."""
    both = settle(checked(df, want))
    named = [F.col(f"`{key}`")] if key else []
    rejects = both.where(F.size("_rejects") > 0).select(*named, F.explode("_rejects").alias("r")).select(*([F.col(f"`{key}`")] if key else []), "r.*")
    return both.where(F.size("_rejects") == 0).drop("_rejects"), rejects


def add_metadata(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns({"_source_system": F.lit(source), "_load_timestamp": F.current_timestamp()})


def enough_of(df: DataFrame, least: int) -> int:
    """The number of rows up to one beyond ``least``; reads no more."""
    return df.limit(least + 1).count() if least > 0 else 0


def check_min_records(df: DataFrame, least: int) -> None:
    """Raises when there are fewer rows."""
    if enough_of(df, least) < least:
        raise ValueError(f"fewer than {least} records")


def load_source(spark: SparkSession, cfg: SourceConfig, want: T.StructType) -> DataFrame:
    """The source under ``want`` with metadata. Opening it, and the read that counts its first rows, are tried again after a failure."""

    def opened() -> tuple[DataFrame, int]:
        raw = read_raw(spark, cfg)
        return raw, enough_of(raw, cfg.min_records)

    df, met = with_retry(opened)
    if met < cfg.min_records:
        raise ValueError(f"fewer than {cfg.min_records} records")
    name = cfg.name or cfg.path
    if cfg.quarantine:
        df, rejects = split_rejects(df, want)
        add_metadata(rejects, name).write.mode("append").parquet(cfg.quarantine)
        return add_metadata(df, name)
    return add_metadata(reconcile(df, want) if cfg.reconcile else df, name)
