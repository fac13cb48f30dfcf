"""Reading tables: column mapping, CSV/parquet loaders, schema checks."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.schema import OPTIONAL_SALES, SALES_SCHEMA, SOURCE_HEADERS, STORE_SCHEMA, column_type


def column_mapping(path: str | None = None) -> dict[str, str]:
    """Canonical name -> source header, from a YAML file: its ``columns`` block, or the whole of it.

    Unknown keys are ignored; a missing or unreadable file gives the defaults.
    """
    if path is None:
        return dict(SOURCE_HEADERS)
    try:
        import yaml

        with open(path, encoding="utf-8") as handle:
            loaded = yaml.safe_load(handle) or {}
        given = loaded.get("columns") or loaded
        return {name: given.get(name, header) for name, header in SOURCE_HEADERS.items()}
    except Exception:
        return dict(SOURCE_HEADERS)


def _parsed(df: DataFrame, field: T.StructField, header: str) -> tuple[Column, Column, Column]:
    """The source as text, the canonical value of a field, and whether text was there that gave no value.

    Empty and blank text and NaN, number or text, mean that nothing is there.
    """
    source = df[f"`{header}`"]
    text = F.trim(source.cast("string"))
    if isinstance(df.schema[header].dataType, (T.DoubleType, T.FloatType)):
        source = F.when(~F.isnan(source), source)  # a NaN would pass for a whole number
    if isinstance(field.dataType, (T.IntegerType, T.LongType)):
        # "9.0" is how a whole number with gaps is written, "9.5" is none
        number = source.try_cast("double")
        value = F.when(number == F.floor(number), number).try_cast(field.dataType)
    elif isinstance(field.dataType, T.DateType):
        value = source.try_cast("timestamp").cast("date")
    else:
        value = source.try_cast(field.dataType)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)  # text "NaN" too
    missing = text.isNull() | (F.lower(text).isin("", "nan"))
    return text, value, value.isNull() & ~missing


def _present(df: DataFrame, schema: T.StructType, mapping: dict[str, str], optional) -> list[T.StructField]:
    """Fields whose header is there; a missing header that is not optional fails before any job runs."""
    missing = [mapping[f.name] for f in schema if mapping[f.name] not in df.columns and f.name not in optional]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return [f for f in schema if mapping[f.name] in df.columns]


def canonical(df: DataFrame, schema: T.StructType, mapping: dict[str, str], optional=()) -> DataFrame:
    """Check the headers, then rename and cast to the canonical schema.

    Rows with text that does not parse are left out: ``quarantined`` has them, with the reason.
    """
    fields = [(f, *_parsed(df, f, mapping[f.name])) for f in _present(df, schema, mapping, optional)]
    failed = reduce(lambda a, b: a | b, [bad for *_, bad in fields], F.lit(False))
    return df.where(~failed).select(*[value.alias(f.name) for f, _, value, _ in fields])


def quarantined(df: DataFrame, schema: T.StructType, mapping: dict[str, str], optional=()) -> DataFrame:
    """A row for each value that does not parse: ``column``, ``value``, ``reason``, and the whole row as JSON.

    Together with ``canonical`` it holds every row of the source: no value turns into NULL unseen.
    """
    cells = []
    for f in _present(df, schema, mapping, optional):
        text, _, bad = _parsed(df, f, mapping[f.name])
        reason = F.lit(f"not a {f.dataType.simpleString()}")
        cells.append(F.when(bad, F.struct(F.lit(f.name).alias("column"), text.alias("value"), reason.alias("reason"))))
    rows = df.select(F.to_json(F.struct(*[f"`{c}`" for c in df.columns])).alias("row"), F.explode(F.array(*cells)).alias("c"))
    return rows.where("c is not null").select("c.*", "row")


def failure_counts(rejects: DataFrame) -> DataFrame:
    """How many values of each column did not parse, and in how many rows."""
    return rejects.groupBy("column", "reason").agg(F.count("*").alias("n"))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header as text: no pass to infer types, and only selected columns are parsed."""
    return spark.read.option("header", True).csv(path)


def read_sales(spark: SparkSession, path: str, mapping: dict[str, str] | None = None) -> DataFrame:
    return canonical(read_raw(spark, path), SALES_SCHEMA, mapping or column_mapping(), OPTIONAL_SALES)


def read_stores(spark: SparkSession, path: str, mapping: dict[str, str] | None = None) -> DataFrame:
    return canonical(read_raw(spark, path), STORE_SCHEMA, mapping or column_mapping())


def read_by_suffix(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet when the name says so, else CSV with a header, typed by ``schema`` or by what the columns are called.

    Types come from the names, so no pass over the data is needed to infer them.
    """
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    raw = read_raw(spark, path)
    types = {f.name: f.dataType for f in schema} if schema else {c: column_type(c) for c in raw.columns}
    return raw.select(*[raw[f"`{c}`"].cast(types.get(c, T.StringType())).alias(c) for c in raw.columns])


def exists(spark: SparkSession, path: str) -> bool:
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(location)


def renamed(spark: SparkSession, draft: str, path: str) -> bool:
    """Give a finished draft its final name in one step; False where another writer was first."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if exists(spark, path):
        return False
    if not files.rename(hadoop(draft), hadoop(path)):
        if exists(spark, path):
            return False
        raise OSError(f"could not commit {path}")
    return True


def load_table(spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None) -> DataFrame | None:
    """``<name>.parquet`` if there, else ``<name>.csv`` with its date column parsed, else None."""
    base = f"{folder.rstrip('/')}/{name}"
    if exists(spark, base + ".parquet"):
        return spark.read.parquet(base + ".parquet")
    if exists(spark, base + ".csv"):
        table = read_by_suffix(spark, base + ".csv", schema)
        dates = [c for c in table.columns if c.lower() == "date"]
        return table.withColumns({c: F.to_date(table[c]) for c in dates})
    return None


def with_stores(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Left join of the store attributes; a store listed twice is an error, not extra rows.

    No broadcast hint: the optimizer broadcasts the store side while it is under the threshold and
    otherwise shuffles, where adaptive execution splits the partitions of oversized stores.
    """
    attributes = [c for c in stores.columns if c != "store_id"]
    listed = stores.groupBy("store_id").agg(
        F.count("*").alias("listed"), *[F.first(c).alias(c) for c in attributes]
    )
    key = F.when(F.col("listed") == 1, F.col("store_id")).otherwise(
        F.raise_error(F.concat(F.lit("store listed more than once: "), F.col("store_id").cast("string")))
    )
    unique = listed.select(key.alias("store_id"), *attributes)
    return sales.join(unique, "store_id", "left")


def read_panel(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """A written panel between two days. It lies by year, so other years are not read."""
    panel = spark.read.parquet(path)
    for day, after in ((first, True), (last, False)):
        if day is None:
            continue
        panel = panel.where(F.col("date") >= F.lit(day) if after else F.col("date") <= F.lit(day))
        if "year" in panel.columns:
            panel = panel.where(F.col("year") >= day.year if after else F.col("year") <= day.year)
    return panel
