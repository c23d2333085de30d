"""Container metadata: names and labels of the folders that hold container logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.functions.text import short_container_id

CONFIG = "Name string, Config struct<Labels map<string,string>>"


def metadata(spark: SparkSession, pattern: str) -> DataFrame:
    """path, folder, name and labels of every ``config.v2.json`` that the glob finds."""
    rows = spark.read.schema(CONFIG).option("wholetext", True).option("multiLine", True).json(pattern).select("*", F.input_file_name().alias("path"))
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return rows.select("path", folder.alias("folder"), F.ltrim(F.col("Name"), F.lit("/")).alias("name"), F.col("Config.Labels").alias("labels"))


def selected(labels: Column, selector: str) -> Column:
    """Whether labels fit ``key=value``; an empty selector lets all pass, one without a value asks for an empty or absent label."""
    if not selector:
        return F.lit(True)
    key, _, value = selector.partition("=")
    return F.coalesce(F.try_element_at(labels, F.lit(key)), F.lit("")) == value


def named(lines: DataFrame, containers: DataFrame, selector: str = "") -> DataFrame:
    """Lines (column source) of the selected containers with host: the container's name, or its short id."""
    own = containers.where(selected(F.col("labels"), selector)).select("folder", "name")
    folder = F.regexp_replace("source", "/[^/]*$", "")
    kind = "inner" if selector else "left"
    joined = lines.withColumn("folder", folder).join(own, "folder", kind)
    return joined.withColumn("host", F.coalesce(F.nullif("name", F.lit("")), short_container_id(F.col("source")))).drop("folder", "name")
