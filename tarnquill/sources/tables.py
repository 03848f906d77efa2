"""Readers and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """One Parquet table of the folder, only the columns asked for."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def corpus_parts(spark: SparkSession, path: str) -> DataFrame:
    """All parts of a corpus whose schemas may have drifted apart; columns are united by name."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_csv_strings(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV of quoted, possibly multi-line fields as strings, missing columns as null, with the file it came from."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)
    picked = [(F.col(f"`{c}`") if c in raw.columns else F.lit(None)).cast("string").alias(c) for c in columns]
    return raw.select(*picked, F.col("_metadata.file_path").alias("source_file"))


def write_parts(df: DataFrame, path: str, key: str, parts: int) -> None:
    """Parquet files that follow each other by key, so that a key range reads few files and row groups."""
    (
        df.repartitionByRange(parts, key).sortWithinPartitions(key)
        .write.mode("overwrite").option("compression", "zstd").parquet(path)
    )


def typed_csv(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, so that the frame can be written as CSV without losing them."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *(F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema)
    )


def cell_safe(text: Column, limit: int = 32_000) -> Column:
    """Text that a spreadsheet shows instead of evaluating: control characters removed, formula starts quoted."""
    clean = F.left(F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", ""), F.lit(limit))
    return F.when(clean.rlike(r"^[=+\-@]"), F.concat(F.lit("'"), clean)).otherwise(clean)


def register_views(spark: SparkSession, folder: str, names: list[str]) -> None:
    """The tables as views, for SQL at will."""
    for name in names:
        table(spark, folder, name).createOrReplaceTempView(name)


def docx_paragraphs(spark: SparkSession, path: str) -> DataFrame:
    """(path, pos, paragraph) of the DOCX files below a path; damaged files give no row."""
    import io
    import re
    import zipfile
    from xml.etree import ElementTree

    import pandas as pd

    word = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"

    def run(parts):
        for part in parts:
            for name, content in zip(part["path"], part["content"]):
                try:
                    root = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml"))
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
                    continue
                texts = ["".join(t.text or "" for t in p.iter(f"{word}t")) for p in root.iter(f"{word}p")]
                texts = [re.sub(r"\s+", " ", t).strip() for t in texts]
                kept = [t for t in texts if t]
                yield pd.DataFrame({"path": [name] * len(kept), "pos": range(1, len(kept) + 1), "paragraph": kept})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(path).select("path", "content")
    return files.mapInPandas(run, "path string, pos int, paragraph string")
