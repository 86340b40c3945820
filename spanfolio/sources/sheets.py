"""Wide sheets: one date column, then one column per asset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfolio.sources.tables import ONE_UNIVERSE


def _csv(spark: SparkSession, files: str | list[str]) -> DataFrame:
    return spark.read.option("header", True).option("inferSchema", False).csv(files)


def by_header(spark: SparkSession, path: str) -> list[DataFrame]:
    """Sheets as text, one DataFrame for all files with the same header, in the order of the first file of each.

    A file's header is the first line of its first block. Names and files come to the
    driver, as they do when Spark lists a folder; a single file is only opened once.
    """
    lines = spark.read.text(path)
    if len(lines.inputFiles()) == 1:
        return [_csv(spark, path)]
    first = lines.select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
    first = first.where("file_block_start = 0").groupBy("file_path").agg(F.min_by("value", "at").alias("names"))
    plain = F.regexp_replace("names", "^\\uFEFF|\\r$", "").alias("names")
    same = first.groupBy(plain).agg(F.sort_array(F.collect_list("file_path")).alias("files"))
    groups = same.agg(F.sort_array(F.collect_list("files")).alias("groups")).first()["groups"]
    return [_csv(spark, files) for files in groups] or [_csv(spark, path)]


def header(spark: SparkSession, path: str) -> list[str]:
    """Names of the columns of the sheets after the date, from their headers, each once."""
    return list(dict.fromkeys(name for sheet in by_header(spark, path) for name in sheet.columns[1:]))


def read_wide_csv(
    spark: SparkSession, path: str, assets: Sequence[str] | None = None, date_format: str = "yyyy-MM-dd"
) -> DataFrame:
    """``(dt DATE, <asset> DOUBLE ...)`` from CSV with a header and the date first.

    Columns go by the names in each file's own header, whatever their order; one that
    a file lacks is null in its rows. ``assets`` chooses some of them and their order,
    and one that no file has is an error. Values are read as text, and text that is
    not a number becomes null.
    """
    sheets = by_header(spark, path)
    names = list(dict.fromkeys(name for sheet in sheets for name in sheet.columns[1:]))
    missing = [a for a in assets or () if a not in names]
    if missing:
        raise ValueError(f"{path} has no column {missing}")
    asked = list(names if assets is None else assets)
    parts = []
    for sheet in sheets:
        values = [F.col(f"`{a}`") if a in sheet.columns[1:] else F.lit(None).cast("string").alias(a) for a in asked]
        parts.append(sheet.select(F.col(f"`{sheet.columns[0]}`").alias("dt"), *values))
    raw = parts[0]
    for part in parts[1:]:
        raw = raw.unionByName(part)
    return coerce_numeric(raw, asked).withColumn("dt", F.to_date("dt", date_format))


def write_wide_csv(wide: DataFrame, path: str) -> None:
    wide.write.option("header", True).csv(path)


def coerce_numeric(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast the columns to double; text that cannot be read becomes null, as does NaN."""
    cast = {c: F.col(f"`{c}`").try_cast("double") for c in columns}
    return wide.withColumns({c: F.when(~F.isnan(v), v) for c, v in cast.items()})


def drop_leading(wide: DataFrame, n: int = 1) -> DataFrame:
    """Drop the first ``n`` columns by position."""
    return wide.select(*[f"`{c}`" for c in wide.columns[n:]])


def name_by_position(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give the columns the first names of the list, in order."""
    return wide.toDF(*list(names)[: len(wide.columns)])


def drop_incomplete(wide: DataFrame) -> DataFrame:
    """Keep the rows in which no value is null or NaN."""
    return wide.na.drop("any")


def to_long(wide: DataFrame, value: str = "price", universe: str = ONE_UNIVERSE) -> DataFrame:
    """``(universe, dt, asset, value)`` from a wide sheet; cells that are null are left out."""
    assets = [c for c in wide.columns if c != "dt"]
    long = wide.unpivot("dt", [f"`{c}`" for c in assets], "asset", value)
    return long.where(F.col(value).isNotNull()).select(
        F.lit(universe).alias("universe"), "dt", "asset", value
    )


def to_wide(panel: DataFrame, value: str, assets: Sequence[str] | None = None) -> DataFrame:
    """One column per asset of a single universe.

    Without ``assets`` Spark runs one more job for the distinct names and stops
    beyond ``spark.sql.pivotMaxValues`` columns.
    """
    grouped = panel.groupBy("dt")
    pivoted = grouped.pivot("asset", list(assets)) if assets else grouped.pivot("asset")
    return pivoted.agg(F.first(value, ignorenulls=True))


def stack_series(series: dict[str, DataFrame], value: str = "r") -> DataFrame:
    """Stack separate ``(dt, value)`` series under their names into one long panel."""
    parts = [
        df.select(F.lit(ONE_UNIVERSE).alias("universe"), "dt", F.lit(name).alias("asset"), value)
        for name, df in series.items()
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked
