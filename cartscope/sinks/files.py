"""File sinks: raw landing (W1) and flat staging outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def land_raw(spark: SparkSession, source: str, dest: str, whole_files: bool = False) -> str:
    """Copy payload documents into the bronze folder, never re-serialised.

    JSON Lines are moved line by line (line ends become ``\\n``). With
    ``whole_files=True`` each file is one Parquet row of ``path`` and
    ``content``, byte for byte; ``read_documents(landed=True)`` reads them.
    """
    if whole_files:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
        files.select("path", "content").write.mode("errorifexists").parquet(dest)
    else:
        spark.read.text(source).write.mode("errorifexists").text(dest)
    return dest


def write_flat_staging(orders: DataFrame, items: DataFrame, dest: str,
                       fmt: str = "json") -> dict[str, str]:
    """Write both flat outputs (NDJSON by default, or Parquet).

    NDJSON rows keep explicit nulls out (Spark omits null fields); the reader
    (``sources.payload.read_flat_staging``) restores them from the schema. NDJSON is
    compressed, as every row repeats the keys: one file for each task that wrote.
    """
    paths = {"orders": f"{dest}/orders", "order_items": f"{dest}/order_items"}
    for table, df in (("orders", orders), ("order_items", items)):
        w = df.write.mode("overwrite")
        (w.json(paths[table], compression="gzip") if fmt == "json" else w.parquet(paths[table]))
    return paths
