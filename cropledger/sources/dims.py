"""Dimension tables: fixed defaults, or the user's own CSV files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropledger.sources import fixed
from cropledger.sources.literal import literal_table


def check_dimension(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """One job over a dimension table: its key must be set and unique. Returns the table."""
    bad = df.groupBy(*keys).count().where((F.col("count") > 1) | F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)))
    found = [tuple(r[k] for k in keys) for r in bad.limit(5).collect()]
    if found:
        raise ValueError(f"{what}: blank or repeated key {found}")
    return df


def read_dimension(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, str],
    key: Sequence[str],
    *,
    types: Mapping[str, str] | None = None,
    comment: str | None = None,
) -> DataFrame:
    """Read a mapping CSV with a header; ``columns`` maps our names to the file's. Blanks are NULL."""
    reader = spark.read.option("header", "true")
    if comment:
        reader = reader.option("comment", comment)
    raw = reader.csv(path)
    types = types or {}
    df = raw.select(
        *[
            F.when(F.trim(F.col(f"`{theirs}`")) != "", F.trim(F.col(f"`{theirs}`"))).cast(types.get(ours, "string")).alias(ours)
            for ours, theirs in columns.items()
        ]
    )
    return check_dimension(df, list(key), path)


def read_auxiliary(
    spark: SparkSession, path: str, schema: T.StructType | str, columns: Mapping[str, str] | None = None
) -> DataFrame:
    """An input table from Parquet or CSV under our column names and types.

    ``columns`` maps our names to the file's where they differ.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    raw = spark.read.option("header", "true").csv(path) if path.rstrip("/").endswith(".csv") else spark.read.parquet(path)
    columns = columns or {}
    return raw.select(*[F.col(f"`{columns.get(f.name, f.name)}`").cast(f.dataType).alias(f.name) for f in schema])


@dataclass(frozen=True)
class Dimensions:
    """Checked mapping tables.

    regions (region, code), leaves (LandLeaf, cover, item), commodities (sector, commodity, kind, item),
    gases (GHG, family, ar4, ar5, ar6), region_ids (region_id, region).
    """

    regions: DataFrame
    leaves: DataFrame
    commodities: DataFrame
    gases: DataFrame
    region_ids: DataFrame

    def with_tables(self, **tables: DataFrame) -> "Dimensions":
        """Replace tables by the user's own."""
        keys = {"regions": ["region"], "leaves": ["LandLeaf"], "commodities": ["commodity"], "gases": ["GHG"], "region_ids": ["region_id"]}
        for name, df in tables.items():
            check_dimension(df, keys[name], name)
        return replace(self, **tables)

    def items_of_commodities(self) -> DataFrame:
        return self.commodities.where(F.col("item").isNotNull()).select("commodity", "item").distinct()

    def crops(self) -> DataFrame:
        return self.commodities.where(F.col("kind") == "Crop").select("commodity", "item")


def default_dimensions(spark: SparkSession) -> Dimensions:
    text = "string"
    return Dimensions(
        regions=literal_table(spark, {"region": text, "code": text}, fixed.region_rows()),
        leaves=literal_table(spark, {"LandLeaf": text, "cover": text, "item": text}, fixed.leaf_rows()),
        commodities=literal_table(
            spark, {"sector": text, "commodity": text, "kind": text, "item": text}, fixed.COMMODITIES
        ),
        gases=literal_table(
            spark, {"GHG": text, "family": text, "ar4": "double", "ar5": "double", "ar6": "double"}, fixed.gas_rows()
        ),
        region_ids=literal_table(
            spark, {"region_id": "int", "region": text}, list(enumerate(fixed.NATIVE_REGIONS, start=1))
        ),
    )
