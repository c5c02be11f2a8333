"""Reading and writing tables of listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Source names of the raw columns and ours.
SOURCE_NAMES = {
    "area": "area",
    "quartos": "bedrooms",
    "banheiros": "bathrooms",
    "idade": "age_years",
    "garagem": "has_garage",
    "bairro": "district",
    "preco": "price",
}

LISTING_SCHEMA = T.StructType(
    [
        T.StructField("area", T.DoubleType()),
        T.StructField("bedrooms", T.IntegerType()),
        T.StructField("bathrooms", T.IntegerType()),
        T.StructField("age_years", T.DoubleType()),
        T.StructField("has_garage", T.IntegerType()),
        T.StructField("district", T.StringType()),
        T.StructField("price", T.DoubleType()),
    ]
)


def source_schema() -> T.StructType:
    """The listing schema under the column names of the source files."""
    ours = {f.name: f.dataType for f in LISTING_SCHEMA.fields}
    return T.StructType([T.StructField(src, ours[name]) for src, name in SOURCE_NAMES.items()])


def normalise(df: DataFrame) -> DataFrame:
    """Our column names, and NULL for NaN in floating-point columns."""
    for src, name in SOURCE_NAMES.items():
        if src != name and src in df.columns:
            df = df.withColumnRenamed(src, name)
    floats = [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header and a given schema, so no pass for inference.

    A missing path raises ``AnalysisException`` when the frame is made.
    """
    read = spark.read.option("header", True).option("enforceSchema", False)
    return normalise(read.schema(schema or LISTING_SCHEMA).csv(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return normalise(spark.read.parquet(path))


def read_labelled(spark: SparkSession, path: str, features: Sequence[str], target: str) -> DataFrame:
    """Features and target of a stored data set; only these columns are read."""
    return spark.read.parquet(path).select(*features, target)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_splits(df: DataFrame, path: str, split: str = "split", mode: str = "overwrite") -> None:
    """All data sets in one write, a folder per split that readers can prune."""
    df.write.mode(mode).partitionBy(split).parquet(path)


def read_split(spark: SparkSession, path: str, name: str, split: str = "split") -> DataFrame:
    return spark.read.parquet(path).where(F.col(split) == name)


def keep_newest(df: DataFrame, order: str, row_id: str, versions: int = 10) -> DataFrame:
    """The newest versions of a table of artefacts."""
    return df.orderBy(F.col(order).desc(), row_id).limit(versions)


def keep_recent(df: DataFrame, when: str, as_of, days: int = 30) -> DataFrame:
    """Rows not older than ``days`` before ``as_of`` (a literal, so it reaches the scan)."""
    edge = as_of if hasattr(as_of, "alias") else F.to_date(F.lit(as_of))
    return df.where(F.col(when) >= F.date_sub(edge, days))
