"""Raw and cleaned transaction files, and report tables."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerwatch.schemas import RAW_SCHEMA


def _csv_schema(spark: SparkSession, path: str) -> T.StructType:
    """Types by name for the columns of the header; only the header line is read."""
    known = {f.name: f for f in RAW_SCHEMA.fields}
    header = spark.read.option("header", True).csv(path).columns
    return T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header])


def load_raw(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Raw transactions with explicit types.

    Raises FileNotFoundError for a missing path and ValueError for a file that is empty or
    cannot be read as transactions.
    """
    try:
        if fmt == "csv":
            schema = _csv_schema(spark, path)
            if not schema.fields:
                raise ValueError(f"raw data set is empty: {path}")
            df = spark.read.csv(
                path, schema=schema, header=True, mode="FAILFAST", enforceSchema=False,
                nanValue="nan", positiveInf="inf", negativeInf="-inf",
            )
        else:
            df = spark.read.format(fmt).load(path)
        empty = df.isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"raw data set not found: {path}") from error
        raise ValueError(f"raw data set cannot be read: {path}: {error}") from error
    except ValueError:
        raise
    except Exception as error:
        raise ValueError(f"raw data set cannot be read: {path}: {error}") from error
    if empty:
        raise ValueError(f"raw data set is empty: {path}")
    return df


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def is_folder(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(jpath).isDirectory()


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this package has written."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def write_cleaned(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """A small report table as CSV with a header."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)
