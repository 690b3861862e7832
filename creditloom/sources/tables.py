"""Reading and writing loan tables, result tables and models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom import policy
from creditloom.session import materialise

# Raw columns that hold text; every other raw column is a number.
TEXT_COLUMNS = frozenset((
    "id", "term", "int_rate", "grade", "sub_grade", "emp_title", "emp_length", "home_ownership",
    "verification_status", "issue_d", "loan_status", "pymnt_plan", "url", "desc", "purpose",
    "title", "zip_code", "addr_state", "earliest_cr_line", "revol_util", "initial_list_status",
    "last_pymnt_d", "next_pymnt_d", "last_credit_pull_d", "application_type",
    "verification_status_joint", "sec_app_earliest_cr_line", "hardship_flag", "hardship_type",
    "hardship_reason", "hardship_status", "hardship_start_date", "hardship_end_date",
    "payment_plan_start_date", "hardship_loan_status", "disbursement_method",
    "debt_settlement_flag", "debt_settlement_flag_date", "settlement_status", "settlement_date"))


def raw_schema(names: Sequence[str]) -> T.StructType:
    """Types of raw columns by name; nothing is inferred from data."""
    def kind(name: str) -> T.DataType:
        if name == policy.KEY:
            return T.LongType()
        return T.StringType() if name in TEXT_COLUMNS else T.DoubleType()
    return T.StructType([T.StructField(n, kind(n)) for n in names])


def _header(spark: SparkSession, path: str) -> list[str]:
    first = spark.read.option("header", True).csv(path).schema
    return first.names


@dataclass(frozen=True)
class Read:
    """What a file held: rows as they should be, and (file, record, reason) of each record that is not."""

    rows: DataFrame
    rejects: DataFrame


_BAD = "_malformed"


def _csv_options(multi_line: bool) -> dict:
    return {"header": True, "enforceSchema": False, "escape": '"', "multiLine": multi_line, "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": _BAD}


def _has_gzip(spark: SparkSession, path: str) -> bool:
    return any(name.endswith(".gz") for name in spark.read.text(path).inputFiles())


def _reason(schema: T.StructType) -> Column:
    """Why a record is no row: its number of cells, or the numbers that cannot be read."""
    text = T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema], T.StructField(_BAD, T.StringType())])
    cells = F.from_csv(F.col(_BAD), text.simpleString()[7:-1].replace(":", " "),
                       {"escape": '"', "columnNameOfCorruptRecord": _BAD, "multiLine": "true"})
    odd = F.filter(F.array(*[F.when(cells[f.name].try_cast(f.dataType).isNull() & cells[f.name].isNotNull(), F.lit(f.name))
                             for f in schema if not isinstance(f.dataType, T.StringType)]), lambda c: c.isNotNull())
    return (F.when(cells[_BAD].isNotNull(), F.lit(f"not {len(schema)} cells"))
            .when(F.size(odd) > 0, F.concat(F.lit("not a number: "), F.array_join(odd, ", ")))
            .otherwise(F.lit("unreadable")))


def read_checked_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool | None = None) -> Read:
    """Rows and rejects of CSV with a header.

    A record with another number of cells, or with text where a number belongs, is no row: it is kept as it stood, with
    its file and the reason. Both tables come from one written copy, as a text file is worth reading only once.
    ``multi_line`` lets quoted text hold line breaks, which makes each file one task's work. That costs nothing for gzip,
    where it is the default; plain text is read in pieces unless asked for.
    """
    if multi_line is None:
        multi_line = _has_gzip(spark, path)
    marked = T.StructType([*schema, T.StructField(_BAD, T.StringType())])
    raw = spark.read.schema(marked).options(**_csv_options(multi_line)).csv(path)
    stored = materialise(raw.withColumn("_file", F.col("_metadata.file_path")), "csv")
    rejects = stored.where(F.col(_BAD).isNotNull()).select(
        F.col("_file").alias("file"), F.col(_BAD).alias("record"), _reason(schema).alias("reason"))
    return Read(stored.where(F.col(_BAD).isNull()).drop(_BAD, "_file").transform(nan_to_null), rejects)


def read_raw(spark: SparkSession, path: str, multi_line: bool | None = None) -> Read:
    """Raw loans from (gzipped) CSV with a header, and what is not one (A1)."""
    read = read_checked_csv(spark, path, raw_schema(_header(spark, path)), multi_line)
    return Read(read.rows.transform(with_key), read.rejects)


def read_raw_csv(spark: SparkSession, path: str, partitions: int | None = None, multi_line: bool | None = None,
                 rejects_path: str | None = None) -> DataFrame:
    """The loans of ``read_raw``, dealt out over ``partitions`` at least; its rejects are appended to ``rejects_path``.

    A stored copy that is already read in as many pieces stays as it is: its pieces are bounded in size, shares aren't.
    """
    read = read_raw(spark, path, multi_line)
    if rejects_path:
        read.rejects.write.mode("append").parquet(rejects_path)
    few = partitions and read.rows.rdd.getNumPartitions() < partitions
    return read.rows.repartition(partitions) if few else read.rows


def spread(scan: DataFrame) -> DataFrame:
    """Deal out the rows of a source that arrives in fewer pieces than half the cores.

    A single small or unsplittable file would otherwise keep everything after it
    in one task. A source of ordinary size is returned as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() * 2 <= cores else scan


def nan_to_null(df: DataFrame) -> DataFrame:
    """One kind of missing value from here on: NULL."""
    return df.withColumns({f.name: F.when(~F.isnan(F.col(f.name)), F.col(f.name))
                           for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def with_key(df: DataFrame) -> DataFrame:
    """Loans carry ``loan_id``; raw files call it ``id``."""
    if policy.KEY in df.columns or "id" not in df.columns:
        return df
    return df.withColumn(policy.KEY, F.col("id").try_cast("bigint"))


def read_first_existing(spark: SparkSession, labelled_paths: Sequence[tuple[str, str]],
                        ) -> tuple[DataFrame, str]:
    """First parquet table that exists, with its label (A2)."""
    for label, path in labelled_paths:
        try:
            return spark.read.parquet(path), label
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":  # a broken table is no reason to read another
                raise
    raise FileNotFoundError(f"No table found at {[p for _, p in labelled_paths]}")


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Only the named columns leave the disk (A3)."""
    return spark.read.parquet(path).select(*columns)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Snappy parquet, optionally laid out by window (A4)."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


REPORT_ROWS = 100_000


def write_small_csv(df: DataFrame, path: str, most: int = REPORT_ROWS) -> None:
    """A report of a few rows as one CSV part with header (A6); a table that is no report is refused."""
    df = materialise(df, "report")
    rows = df.count()
    if rows > most:
        raise ValueError(f"{rows:,} rows are no report of at most {most:,}; write_csv takes tables of any size")
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """A full-size CSV export, one file per task; text keeps its outer blanks."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("compression", compression).csv(path))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A metadata or result table as JSON lines (A7); a runs table is appended to."""
    df.write.mode(mode).json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def read_application_file(spark: SparkSession, path: str, multi_line: bool | None = True) -> Read:
    """A batch of applications from CSV and the records that are none (A9). Term is a number of months here.

    Titles come from people and hold line breaks, so these are expected; None asks for them in gzip files only.
    """
    numeric_here = {"term", "int_rate", "emp_length", "revol_util"}
    fields = [T.StructField(f.name, T.DoubleType() if f.name in numeric_here else f.dataType)
              for f in raw_schema(_header(spark, path))]
    return read_checked_csv(spark, path, T.StructType(fields), multi_line)


def read_applications(spark: SparkSession, path: str, limit: int | None = None,
                      rejects_path: str | None = None) -> DataFrame:
    """The applications of ``read_application_file``; its rejects are appended to ``rejects_path``."""
    read = read_application_file(spark, path)
    if rejects_path:
        read.rejects.write.mode("append").parquet(rejects_path)
    return read.rows.limit(limit) if limit else read.rows
