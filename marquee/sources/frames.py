"""Reading and writing frames by path, format and zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

FORMATS = ("parquet", "csv")
ZONES = ("raw", "processed", "artifacts", "db")


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def _format_of(path: str, format: str | None) -> str:
    suffix = path.rstrip("/").rsplit("/", 1)[-1].rpartition(".")[2]
    chosen = format or suffix
    if chosen not in FORMATS:
        raise ValueError(f"unsupported format: {chosen}")
    return chosen


def read_frame(spark: SparkSession, path: str, format: str | None = None, schema: T.StructType | str | None = None,
               multi_line: bool = False) -> DataFrame:
    """Load parquet or csv; the format comes from the suffix unless given.

    A csv read without ``schema`` costs an inference pass over the file. ``multi_line`` allows line breaks in quoted
    cells, and keeps a file in one task.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    chosen = _format_of(path, format)
    reader = spark.read.format(chosen)
    if chosen == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", multi_line)
        reader = reader if schema else reader.option("inferSchema", True)
    return (reader.schema(schema) if schema else reader).load(path)


def write_frame(df: DataFrame, name: str, directory: str, format: str = "parquet") -> str:
    """Overwrite ``directory/name`` and return the path; adds the suffix if missing."""
    if format not in FORMATS:
        raise ValueError(f"unsupported format: {format}")
    filename = name if "." in name else f"{name}.{format}"
    path = f"{directory.rstrip('/')}/{filename}"
    writer = df.write.mode("overwrite").format(format)
    if format == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)
    return path


def zone_path(root: str, zone: str) -> str:
    if zone not in ZONES:
        raise ValueError(f"unknown zone: {zone}")
    return f"{root.rstrip('/')}/{zone}"


def save_to_zone(df: DataFrame, name: str, root: str, zone: str = "processed", format: str = "parquet") -> str:
    return write_frame(df, name, zone_path(root, zone), format)


def load_from_zone(spark: SparkSession, name: str, root: str, zone: str = "processed", format: str | None = None) -> DataFrame:
    """Load from a zone; a name without suffix means parquet unless ``format`` says otherwise."""
    filename = name if "." in name else f"{name}.{format or 'parquet'}"
    return read_frame(spark, f"{zone_path(root, zone)}/{filename}", format)
