"""Cold storage: closed months as zstd Parquet by year and month, a catalogue with checksums, and typed seeds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def offload(rows: DataFrame, date: str, root: str) -> None:
    """Writes rows under ``root/year=/month=``; months written before are replaced, others left. Rows are dealt by month so that a month's files stay few; a month too large for one task is split by its size."""
    parts = rows.withColumns({"year": F.year(date), "month": F.month(date)})
    parts = parts.hint("rebalance", "year", "month")
    parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("year", "month").parquet(root)


def read_month(spark: SparkSession, root: str, year: int, month: int, columns: Sequence[str] | None = None) -> DataFrame:
    """One month, by partition pruning, with the columns asked for."""
    rows = spark.read.option("mergeSchema", "true").parquet(root).where((F.col("year") == year) & (F.col("month") == month))
    return rows.select(*columns) if columns else rows.drop("year", "month")


def offloadable(rows: DataFrame, date: str, done: DataFrame, today: str, months: int = 3) -> DataFrame:
    """``year, month, n, first_day, last_day`` of months that ended ``months`` ago or more and are not in ``done``."""
    cutoff = F.add_months(F.trunc(F.lit(today).cast("date"), "month"), -months)
    old = rows.where(F.trunc(date, "month") < cutoff)
    counts = old.groupBy(F.year(date).alias("year"), F.month(date).alias("month")).agg(F.count("*").alias("n"), F.min(date).alias("first_day"), F.max(date).alias("last_day"))
    return counts.join(done.select("year", "month"), ["year", "month"], "left_anti")


#: Schemes that tasks can open for themselves; files elsewhere come through Spark, whole.
STREAMED = ("file", "s3", "gs", "gcs", "hdfs", "abfs", "abfss")
PIECE = 4 << 20


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path in batch.column(0).to_pylist():
            system, name = FileSystem.from_uri(quote(path, safe=":/"))
            digest = hashlib.sha256()
            with system.open_input_stream(name, buffer_size=PIECE) as stream:
                while piece := stream.read(PIECE):
                    digest.update(piece)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], ["path", "length", "modified", "sha256"])


def catalog_of(spark: SparkSession, root: str) -> DataFrame:
    """``path, length, modified, sha256`` of all Parquet files below a folder.

    Tasks read files piece by piece, so that a file can be of any size, where they can open the file system by themselves; files of
    other systems are read as one value, which holds 2 GB at most.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root).withColumnRenamed("modificationTime", "modified")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getScheme() not in STREAMED:
        return files.select("path", "length", "modified", F.sha2("content", 256).alias("sha256"))
    return files.select("path", "length", "modified").repartition("path").mapInArrow(_digests, "path string, length long, modified timestamp, sha256 string")


def verified(spark: SparkSession, root: str, catalog: DataFrame) -> DataFrame:
    """The catalogue with what is there now: ``ok`` where the checksum still holds; files that are gone are not, and files that the catalogue lacks don't count."""
    now = catalog_of(spark, root).select("path", F.col("sha256").alias("now"))
    return catalog.join(now, "path", "left").withColumn("ok", F.coalesce(F.col("sha256") == F.col("now"), F.lit(False))).drop("now")


def month_sums(rows: DataFrame, date: str, columns: Sequence[str]) -> DataFrame:
    """``year, month, n, checksum``: the rows of each month and the sum of their hashes, which does not depend on their order or on files."""
    hashed = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
    return rows.groupBy(F.year(date).alias("year"), F.month(date).alias("month")).agg(F.count("*").alias("n"), hashed.alias("checksum"))


def exported(rows: DataFrame, date: str, root: str) -> DataFrame:
    """``offload``, and what came of it: ``year, month, n, stored, ok`` for each month written, ``ok`` where as many rows with the same checksum are read back. Only where it is true may the originals go."""
    offload(rows, date, root)
    columns = rows.columns
    before = month_sums(rows, date, columns)
    stored = rows.sparkSession.read.schema(rows.schema).parquet(root)
    after = month_sums(stored, date, columns).withColumnsRenamed({"n": "stored", "checksum": "__now"})
    same = (F.col("n") == F.col("stored")) & (F.col("checksum") == F.col("__now"))
    return before.join(after, ["year", "month"], "left").select("year", "month", "n", F.coalesce("stored", F.lit(0)).alias("stored"), F.coalesce(same, F.lit(False)).alias("ok"))


def seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A typed CSV; rows that don't fit the schema fail the read instead of turning null."""
    return spark.read.schema(schema).option("header", "true").option("mode", "FAILFAST").csv(path)


def landing(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Good and broken records of JSON landing files."""
    rows = spark.read.schema(f"{schema}, _broken string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").json(path)
    return rows.where("_broken IS NULL").drop("_broken"), rows.where("_broken IS NOT NULL").select("_broken")


def long_benchmark(wide: DataFrame, divisions: Sequence[str]) -> DataFrame:
    """An official table with a column for each division as ``month, division, index``; the headline is division 00."""
    pairs = ", ".join(f"'{d}', `{d}`" for d in divisions)
    return wide.selectExpr("month", f"stack({len(divisions)}, {pairs}) AS (division, index)").where("index IS NOT NULL")


#: English month names as they begin.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def official_sheets(cells: DataFrame, top: int = 10) -> DataFrame:
    """``sheet, month, headline, mom, yoy, divisions`` from the cells of official sheets (``sheet, row, col, value``; texts, from 0).

    The month is in the last cell of the first ``top`` rows that holds a date (``2024-06-01``) or a month (``Jun 2024``); its column holds the indices, the next two the
    changes of the headline. The first column says what a row is: ``00`` is the headline, ``01`` to ``12`` are divisions, which come as a map with two-digit codes. Values are rounded to four digits;
    what is no number is null. Sheets without a month or a headline are left out; of several rows of one code the last number counts.
    """
    text = F.trim("value")
    named = F.regexp_extract(text, r"(?i)(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\s+(\d{4})", 1)
    number = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(named))
    year = F.regexp_extract(text, r"(?i)(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\s+(\d{4})", 1)
    month = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.trunc(F.substring(text, 1, 10).try_cast("date"), "month")).when(named != "", F.make_date(year.cast("int"), number.cast("int"), F.lit(1)))
    dated = cells.where(F.col("row") < top).withColumn("month", month).where("month IS NOT NULL")
    where = dated.groupBy("sheet").agg(F.max_by(F.struct("month", F.col("col").alias("at")), F.struct("row", "col")).alias("w")).select("sheet", "w.*")
    codes = cells.where("col = 0").select("sheet", "row", F.regexp_replace(text, r"\.0$", "").alias("code")).where(F.col("code").rlike("^[0-9]{1,2}$"))
    codes = codes.select("sheet", "row", F.lpad("code", 2, "0").alias("code")).where("code <= '12'")
    found = cells.join(where, "sheet").withColumn("offset", F.col("col") - F.col("at")).where("offset BETWEEN 0 AND 2").join(codes, ["sheet", "row"])
    found = found.withColumn("number", F.round(F.regexp_replace(text, ",", "").try_cast("double"), 4)).where("number IS NOT NULL")
    pick = lambda code, offset: F.max_by(F.when((F.col("code") == code) & (F.col("offset") == offset), F.col("number")), F.when((F.col("code") == code) & (F.col("offset") == offset), F.col("row")))
    last = found.where("offset = 0 AND code <> '00'").groupBy("sheet", "code").agg(F.max_by("number", "row").alias("number"))
    divisions = last.groupBy("sheet").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("code", "number")))).alias("divisions"))  # twelve at most
    heads = found.groupBy("sheet", "month").agg(pick("00", 0).alias("headline"), pick("00", 1).alias("mom"), pick("00", 2).alias("yoy")).where("headline IS NOT NULL")
    return heads.join(divisions, "sheet", "left")
