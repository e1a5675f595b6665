"""Choosing a reader, the Parquet copy of a dataset, and file checksums."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialbook.operators.datasets import Feature
from trialbook.sources import arff


def _read_arff(spark: SparkSession, path: str) -> DataFrame:
    """Typed columns of a dense file; (rowid, features) of a sparse one."""
    return arff.read_sparse_dataset(spark, path) if arff.is_sparse(spark, path) else arff.read_dense(spark, path)[0]


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Pick the reader by suffix."""
    if path.endswith((".pq", ".parquet")):
        return spark.read.parquet(path)
    if path.endswith((".arff", ".arff.gz")):
        return _read_arff(spark, path)
    raise ValueError(f"no reader for {path}")


def read_preferred(spark: SparkSession, parquet_path: str | None, arff_path: str) -> DataFrame:
    """The Parquet file where there is one, else the ARFF file."""
    if parquet_path is not None:
        try:
            return spark.read.parquet(parquet_path)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    return _read_arff(spark, arff_path)


def write_cache(df: DataFrame, features: Sequence[Feature], path: str) -> None:
    """A typed, compressed copy with its ``rowid``, and the column metadata beside it."""
    df.write.option("compression", "zstd").parquet(f"{path}/data")
    rows = [(f.index, f.name, f.data_type, list(f.nominal_values) if f.nominal_values is not None else None,
             f.is_target, f.is_ignore, f.is_row_identifier) for f in features]
    schema = ("index int, name string, data_type string, nominal_values array<string>, "
              "is_target boolean, is_ignore boolean, is_row_identifier boolean")
    df.sparkSession.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/features")


def read_cache(spark: SparkSession, path: str) -> tuple[DataFrame, list[Feature]]:
    """Data and metadata written by ``write_cache``; the metadata has one row per column."""
    rows = spark.read.parquet(f"{path}/features").orderBy("index").collect()
    features = [Feature(r["index"], r["name"], r["data_type"],
                        tuple(r["nominal_values"]) if r["nominal_values"] is not None else None,
                        r["is_target"], r["is_ignore"], r["is_row_identifier"]) for r in rows]
    return spark.read.parquet(f"{path}/data"), features


def checksum_mismatches(files: DataFrame, catalog: DataFrame, limit: int = 1 << 30) -> DataFrame:
    """(path, md5_checksum, found) of the files that differ from the catalog.

    ``files`` is a ``binaryFile`` frame, ``catalog`` (path, md5_checksum); an absent checksum
    passes. Files up to ``limit`` bytes are hashed by Spark; larger ones, whose content does not
    fit a cell, are read piecewise by path.
    """
    known = catalog.filter(F.nullif(F.trim("md5_checksum"), F.lit("")).isNotNull())
    small = files.filter(F.col("length") <= limit).select("path", F.md5("content").alias("found"))
    large = files.filter(F.col("length") > limit).select("path").mapInPandas(_hash_paths, "path string, found string")
    return small.unionByName(large).join(known, "path").filter(F.lower("md5_checksum") != F.col("found")).select("path", "md5_checksum", "found")


def _hash_paths(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for frame in frames:
        found = []
        for path in frame["path"]:
            scheme, _, rest = path.partition(":")
            if scheme == "file":
                source, name = fs.LocalFileSystem(), "/" + rest.lstrip("/")
            else:
                # Only the authority is a URI; the path is literal and may hold percent signs.
                host, _, below = rest.lstrip("/").partition("/")
                source, base = fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{host}/")
                name = f"{base.rstrip('/')}/{below}"
            digest = hashlib.md5()
            with source.open_input_stream(name, compression=None) as stream:
                while piece := stream.read(1 << 20):
                    digest.update(piece)
            found.append(digest.hexdigest())
        yield pd.DataFrame({"path": frame["path"], "found": found})
