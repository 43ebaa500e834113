"""The order in which rows arrived, as one fixed-width number that does not depend on how files are dealt to tasks.

Files count in the order of their names, rows in the order in which they stand in their file.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARRIVAL = "_arrival"
# --- bits of a row's place, below those of its file ---
_ROW_BITS = 40


def _plain(path: Column) -> Column:
    """A path without the slashes after its scheme, of which a listing and a row's metadata have different numbers."""
    return F.regexp_replace(path, r"^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def _numbered(scan: DataFrame, **places: str) -> DataFrame:
    """The rows with ``_file``, the number of their file, and the metadata fields that ``places`` names.

    The files' names are a listing that the driver holds already. A row of a file that it lacks is an error."""
    files = sorted(scan.inputFiles())
    fields = [F.col(f"_metadata.{field}").alias(name) for name, field in places.items()]
    if len(files) < 2:
        return scan.select("*", F.lit(0).cast("bigint").alias("_file"), *fields)
    listed = scan.sparkSession.createDataFrame(list(zip(files, range(len(files)))), "_path string, _known bigint")
    listed = F.broadcast(listed.select(_plain(F.col("_path")).alias("_path"), "_known"))
    placed = scan.select("*", _plain(F.col("_metadata.file_path")).alias("_path"), *fields).join(listed, "_path", "left")
    return placed.withColumn("_file", F.coalesce("_known", F.raise_error(F.concat(F.lit("no number for "), "_path")))).drop("_known", "_path")


def with_arrival(scan: DataFrame, out: str = ARRIVAL) -> DataFrame:
    """Rows of a plain Parquet scan with a unique BIGINT in arrival order: 2^23 files of 2^40 rows each."""
    return _numbered(scan, _row="row_index").withColumn(out, F.shiftleft("_file", _ROW_BITS) + F.col("_row")).drop("_file", "_row")


def with_text_arrival(scan: DataFrame, out: str = ARRIVAL) -> DataFrame:
    """The same for lines of JSON or CSV files, as a DECIMAL: a line's place is that of its block and its number in the task."""
    # Numbered next to the scan, before anything else sees the rows.
    placed = _numbered(scan.withColumn("_row", F.expr("monotonically_increasing_id() & 8589934591")), _block="file_block_start")
    ordinal = (
        "CAST(CAST(_file AS decimal(8,0)) * 9444732965739290427392 "
        "+ CAST(_block AS decimal(15,0)) * 8589934592 + _row AS decimal(38,0))"
    )
    return placed.withColumn(out, F.expr(ordinal)).drop("_file", "_block", "_row")
