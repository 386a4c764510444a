"""Landed CSV files with the size of each file of a commit."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.schemas import LONG, MEASURES, TEXT
from repotide.sources.tables import union_sources

# Columns that name the commit: its stored id, or its hash still to be resolved.
COMMITS = {"commit_hash_id": LONG, "commit_hash": TEXT}
_FILE = "_metadata.file_path"


def _files_by_header(spark: SparkSession, path: str, names: list[str]) -> dict[str, list[str]]:
    """The files under each header, which is the line that holds all ``names``.

    No other line can be one, since it has words where numbers belong. This
    reads the files once more and brings one row per file to the driver, as
    Spark's own listing of the folder does.
    """
    cells = F.transform(F.split(F.lower("value"), ","), lambda cell: F.trim(cell, F.lit('" \r')))
    is_header = F.size(F.array_intersect(cells, F.array(*map(F.lit, names)))) == len(names)
    # few other lines hold the names at all, so only few are taken apart
    has_names = F.lit(True)
    for name in names:
        has_names = has_names & F.lower("value").contains(name)
    found = (
        spark.read.text(path)
        .select(F.col(_FILE).alias("file"), F.when(has_names & is_header, F.col("value")).alias("header"))
        .groupBy("file")
        .agg(F.collect_set("header").alias("headers"))
        .collect()
    )
    groups = defaultdict(list)
    for row in found:
        if len(row["headers"]) != 1:
            raise ValueError(f"{row['file']}: no header with the columns {', '.join(names)}")
        groups[row["headers"][0]].append(row["file"])
    return dict(groups)


def read_file_sizes(
    spark: SparkSession,
    path: str,
    root: str | None = None,
    commit_pattern: str | None = None,
    commit: str = "commit_hash_id",
    by: Mapping[str, T.DataType] | None = None,
) -> DataFrame:
    """Per-file sizes, columns found by name whatever their order and case.

    ``commit`` says whether a commit is named by ``commit_hash_id`` or by
    ``commit_hash``; it is a column, or group 1 of ``commit_pattern`` in the
    file's path. ``root`` is cut off the paths in ``provider``. A file without
    the wanted columns, and a row with too few fields or with text for a
    number, fails the job. Files without any line hold nothing.
    """
    kinds = {**(by or {}), "language": TEXT, "provider": TEXT, **dict.fromkeys(MEASURES, LONG)}
    if commit_pattern is None:
        kinds[commit] = COMMITS[commit]
    columns = [*(by or {}), commit, "language", "provider", *MEASURES]
    groups = _files_by_header(spark, path, list(kinds))
    if not groups:
        model = {**kinds, commit: COMMITS[commit]}
        return spark.createDataFrame([], T.StructType([T.StructField(c, model[c]) for c in columns]))
    parts = []
    for header, files in sorted(groups.items()):
        names = [cell.strip('" \r') for cell in header.split(",")]
        schema = T.StructType([T.StructField(n, kinds.get(n.lower(), TEXT)) for n in names])
        raw = (
            spark.read.schema(schema)
            .options(header=True, enforceSchema=False, mode="FAILFAST", columnPruning=False)
            .csv(path)
        )
        if len(groups) > 1:
            raw = raw.filter(F.col(_FILE).isin(files))
        if commit_pattern is not None:
            named = F.regexp_extract(F.col(_FILE), commit_pattern, 1)
            raw = raw.withColumn(commit, named.cast(COMMITS[commit]))
        parts.append(raw.select(*[F.col(c).alias(c) for c in columns]))
    sizes = union_sources(parts)
    if root is not None:
        cut = F.substring("provider", F.lit(len(root.rstrip("/")) + 2), F.length("provider"))
        sizes = sizes.withColumn("provider", cut)
    return sizes
