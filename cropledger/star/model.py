"""Query tables of the indicators, derived from the star schema.

Everything starts from one fact, ``lines``: line items with the scenario, region and year of their
order as small integers. A query table sums that fact over integer keys first and writes labels on
the sums. For the whole report the fact is summed once to a cube over its bounded keys and written,
so that the large table is read and shuffled a single time, whatever the number of indicators.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.operators.lookup import strict_lookup
from cropledger.plans.inputs import ModelInputs
from cropledger.session import file_listing, fresh_folder, write_and_read_back
from cropledger.sources.dims import Dimensions, default_dimensions
from cropledger.star import labels as lb

CUBE_KEYS = ["sc", "region_id", "year", "p", "s", "irrigated", "flag"]
CUBE_SCHEMA = "sc int, region_id int, year int, p int, s int, irrigated boolean, flag string, qty double, ln double"


# Declared schemas spare a job per table that would only read file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}

ORDER_SCHEMA = "sc int, region_id int, year int, n double, price double"

# Written cubes of this process by (application, tables, their files): loaded once, read by every indicator that follows.
_CUBES: dict[tuple[str, str, tuple], str] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(members: Sequence, index: Column) -> Column:
    """Entry of a constant list; NULL outside it."""
    shown = ["NULL" if x is None else repr(x) for x in members]
    return F.get(F.expr(f"array({', '.join(shown)})"), index)


def model_year(date: Column) -> Column:
    """Model year of an order; a year outside the mapped ones fails, as two of them would be added up."""
    year = F.year(date)
    spaced = F.lit(2015) + (year - lb.FIRST_ORDER_YEAR) * 5
    unknown = F.raise_error(F.concat(F.lit("no model year for order date "), F.coalesce(date.cast("string"), F.lit("NULL"))))
    return (
        F.when(year == lb.LAST_ORDER_YEAR, F.lit(2050))
        .when(year.between(lb.FIRST_ORDER_YEAR, lb.LAST_ORDER_YEAR), spaced)
        .otherwise(unknown)
        .cast("int")
    )


def scenario_code(priority: Column) -> Column:
    """0, 1, ... in the order of the scenario list; an unknown label fails."""
    place = F.array_position(F.array(*[F.lit(p) for p in lb.SCENARIO_OF]), priority).cast("int")
    unknown = F.raise_error(F.concat(F.lit("no scenario for order priority "), F.coalesce(priority, F.lit("NULL"))))
    return F.when(place > 0, place - 1).otherwise(unknown).cast("int")


class StarModel:
    """Query tables by name.

    ``staged`` works from a cube of the line items that is written once per application;
    ``keep_stages`` also writes the intermediates that several indicators share.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, *, staged: bool = False, keep_stages: bool = False):
        self.spark, self.sf_dir, self.staged, self.keep_stages = spark, sf_dir, staged, keep_stages
        self.dims: Dimensions = default_dimensions(spark)
        self._frames: dict[str, DataFrame] = {}

    # -- facts ---------------------------------------------------------------------------------

    def orders(self) -> DataFrame:
        """Orders with scenario code, region id and model year."""
        customers = read(self.spark, self.sf_dir, "customer").select(
            F.col("c_custkey").alias("o_custkey"), (F.col("c_nationkey") + 1).alias("region_id")
        )
        orders = read(self.spark, self.sf_dir, "orders").select(
            "o_orderkey", "o_custkey", "o_totalprice",
            scenario_code(F.col("o_orderpriority")).alias("sc"), model_year(F.col("o_orderdate")).alias("year"),
        )
        return orders.join(customers, "o_custkey", "inner").drop("o_custkey")

    def _lines(self) -> DataFrame:
        lines = read(self.spark, self.sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("o_orderkey"),
            (F.col("l_partkey") % lb.N_LEAVES).cast("int").alias("p"),
            (F.col("l_suppkey") % lb.N_SOURCES).cast("int").alias("s"),
            (F.col("l_linestatus") == "F").alias("irrigated"),
            F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("qty"),
            F.col("l_linenumber").cast("double").alias("ln"),
        )
        # Both sides grow with the data: merge join, so that neither is ever broadcast and a hot order splits.
        return lines.join(self.orders().drop("o_totalprice").hint("merge"), "o_orderkey", "inner").drop("o_orderkey")

    def lines(self) -> DataFrame:
        """Line facts: integer label keys, quantity ``qty`` and line number ``ln``."""
        return self._once("lines", self._cube if self.staged else self._lines)

    def by_source(self) -> DataFrame:
        """Lines without irrigation and flag; where stages are kept, summed and written, as many query tables need no more.

        Only for sums of the quantity alone or the line number alone: a sum of both skips a cell that lacks one of them.
        """
        return self._coarser("by_source", self.lines, "p", "s")

    def by_leaf(self) -> DataFrame:
        """``by_source`` without the source."""
        return self._coarser("by_leaf", self.by_source, "p")

    def _coarser(self, name: str, finer: Callable[[], DataFrame], *keys: str) -> DataFrame:
        if not self.keep_stages:
            return self.lines()

        def build():
            cells = finer().groupBy("sc", "region_id", "year", *keys).agg(F.sum("qty").alias("qty"), F.sum("ln").alias("ln"))
            return write_and_read_back(cells, fresh_folder(self.spark))

        return self._once(name, build)

    def _kept(self, names: Sequence[str], cells: Callable[[], DataFrame], schema: str) -> DataFrame:
        """Sums over bounded keys, written once per application for the tables they are made of."""
        tables = [f"{self.sf_dir.rstrip('/')}/{t}.parquet" for t in names]
        key = (self.spark.sparkContext.applicationId, self.sf_dir, tuple((t, file_listing(self.spark, t)) for t in tables))
        if key not in _CUBES:
            folder = fresh_folder(self.spark)
            cells().write.parquet(folder)
            _CUBES[key] = folder
        return self.spark.read.schema(schema).parquet(_CUBES[key])

    def _cube(self) -> DataFrame:
        def cells():
            return self._lines().groupBy(*CUBE_KEYS).agg(F.sum("qty").alias("qty"), F.sum("ln").alias("ln"))

        return self._kept(("lineitem", "orders", "customer"), cells, CUBE_SCHEMA)

    def _placed_orders(self) -> DataFrame:
        return self.orders().groupBy("sc", "region_id", "year").agg(
            F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.floor("o_totalprice")).cast("double").alias("price")
        )

    def _order_cube(self) -> DataFrame:
        return self._kept(("orders", "customer"), self._placed_orders, ORDER_SCHEMA)

    def placed_orders(self) -> DataFrame:
        """Orders summed by scenario, region and year: count ``n`` and whole-currency price ``price``."""
        return self._once("orders", self._order_cube if self.staged else self._placed_orders)

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = build()
        return self._frames[name]

    def _stage(self, name: str, df: DataFrame) -> DataFrame:
        return self._once(f"stage {name}", lambda: write_and_read_back(df, fresh_folder(self.spark)))

    # -- query tables --------------------------------------------------------------------------

    def _label(self, df: DataFrame) -> DataFrame:
        """Scenario and region labels for their codes."""
        named = strict_lookup(df, self.dims.region_ids, "region_id", ["region"], unique=True, what="region ids")
        return named.withColumn("scenario", pick(lb.SCENARIOS, F.col("sc"))).drop("sc", "region_id")

    def _sum(
        self, value: str | Column = "qty", where: Column | None = None, lines: DataFrame | None = None, **keys: Column
    ) -> DataFrame:
        """Sum of lines by scenario, region, year and integer keys, with scenario and region labelled."""
        lines = self.lines() if lines is None else lines
        lines = lines if where is None else lines.where(where)
        summed = lines.groupBy("sc", "region_id", "year", *[k.alias(n) for n, k in keys.items()])
        return self._label(summed.agg(F.sum(value).alias("value")))

    def table(self, name: str) -> DataFrame:
        return getattr(self, f"_t_{name}")().withColumn("ss", F.lit("star"))

    def _by_code(self, where: Column | None = None) -> DataFrame:
        """Quantity by leaf code, the leaf's index kept as ``p``."""
        rows = self._sum(
            where=where, p=F.col("p"), basin=F.col("s") % 5, irrigated=F.col("irrigated"), high=F.col("flag") == "N"
        )
        return rows.withColumn("code", leaf_code("basin", "high"))

    def _t_GDPNS(self):
        return self._label(self.placed_orders().select("sc", "region_id", "year", F.col("price").alias("value")))

    def _t_POP(self):
        return self._label(self.placed_orders().select("sc", "region_id", "year", (F.col("n") * 1000).alias("value")))

    def _t_Detailedland(self):
        return self._by_code().select("scenario", "region", F.col("code").alias("LandLeaf"), "year", "value")

    def _t_Aggland(self):
        return self._sum(lines=self.by_leaf(), p=F.col("p")).withColumn("LandLeaf", pick(lb.LEAVES, F.col("p"))).drop("p")

    def _t_Agprod(self):
        crop = pick(lb.CROP_OF_LEAF, F.col("p"))
        sector = pick(lb.CROPS, crop)
        units = F.when(sector == "biomass", F.lit("EJ")).otherwise(F.lit("Mt"))
        return self._by_code(where=crop.isNotNull()).select(
            "scenario", "region", sector.alias("sector"), F.col("code").alias("technology"), "year", units.alias("Units"), "value"
        )

    def _t_AgBal(self):
        rows = self._sum(lines=self.by_source(), use=F.col("s") % 6, c=F.col("p") % lb.N_COMMODITIES, energy=F.col("s") == 11)
        return rows.select(
            "scenario", "region", pick(lb.USES, F.col("use")).alias("sector"), pick(lb.SECTORS, F.col("c")).alias("input"),
            "year", F.when(F.col("energy"), F.lit("EJ")).otherwise(F.lit("Mt")).alias("Units"), "value",
        )

    def _stock(self, flag: str):
        return self._by_name(lb.SECTORS, "sector", lines=self.lines().where(F.col("flag") == flag))

    def _by_name(self, names: Sequence[str], column: str, value: str | Column = "qty", lines: DataFrame | None = None):
        """Sum by a label dealt out over part keys."""
        rows = self._sum(value, lines=self.by_leaf() if lines is None else lines, c=F.col("p") % len(names))
        return rows.withColumn(column, pick(names, F.col("c"))).drop("c")

    def _t_AgStorageClose(self):
        return self._stock("A")

    def _t_AgStorageOpen(self):
        return self._stock("N")

    def _t_AgStorageCloseLoss(self):
        return self._stock("R")

    def _t_RegAgsource(self):
        name = pick(lb.SHORT_NAMES, F.col("c"))
        origin = F.when(F.col("irrigated"), F.lit("imported ")).otherwise(F.lit("domestic "))
        return self._sum(c=F.col("p") % lb.N_COMMODITIES, irrigated=F.col("irrigated")).select(
            "scenario", "region", F.concat(F.lit("total "), name).alias("sector"), F.concat(origin, name).alias("subsector"),
            "year", "value",
        )

    def _t_TradedAgsource(self):
        c = F.col("p") % lb.N_COMMODITIES
        rows = self._sum(where=(c < lb.N_TRADED) & (F.col("flag") != "A"), c=F.when(F.col("s") != 10, c))
        name = F.coalesce(pick(lb.SHORT_NAMES, F.col("c")), F.lit("iron"))
        return rows.select(
            "scenario", F.lit("USA").alias("region"), "year", F.lit("Mt").alias("Units"), "value",
            F.concat(F.lit("traded "), name).alias("sector"), F.concat("region", F.lit(" traded "), name).alias("subsector"),
        )

    def _t_MeatProd(self):
        rows = self._sum(lines=self.by_source(), c=F.col("p") % len(lb.MEATS), live=F.col("s") == 11)
        units = F.when(F.col("live"), F.lit("head")).otherwise(F.lit("Mt"))
        return rows.select("scenario", "region", pick(lb.MEATS, F.col("c")).alias("sector"), "year", units.alias("Units"), "value")

    def _t_Agprices(self):
        crop = pick(lb.CROP_OF_LEAF, F.col("p"))
        rows = self._sum(F.col("ln") / 8, crop.isNotNull(), self.by_leaf(), c=crop)
        return rows.withColumn("sector", pick(lb.CROPS, F.col("c"))).drop("c")

    def _t_Meatprices(self):
        return self._by_name(lb.MEATS, "sector", F.col("ln") / 8)

    def _t_Fooddemand(self):
        return self._by_name(lb.FOODS, "technology")

    def _t_FooddemandExo(self):
        return self._by_name(lb.FOODS, "technology", "ln")

    def _t_LaborWage(self):
        return self._sum(F.col("ln") / 16, lines=self.by_leaf()).withColumn("market", F.concat("region", F.lit("Labor_Ag"))).drop("region")

    def _t_LaborInputSector(self):
        return self._by_name(lb.COMMODITIES, "sector", F.col("qty") / 64)

    def _t_CO2Price(self):
        priced = F.col("sc").isin([lb.SCENARIOS.index(x) for x in ("ELM", "EL2")])
        return self._sum(F.col("ln") / 16, priced, self.by_leaf()).withColumn("market", F.concat("region", F.lit("CO2"))).drop("region")

    def _t_NCEM(self):
        rows = self._sum(F.col("qty") + F.col("ln"), s=F.col("s"))
        return rows.select("scenario", "region", pick(lb.GASES, F.col("s")).alias("GHG"), F.lit("MTC").alias("Units"), "year", "value")

    def _t_NCEM_sector(self):
        farm = F.col("s").isin([lb.GASES.index(g) for g in lb.FARM_GASES])
        c = F.when(farm, F.col("p") % len(lb.FOODS)).otherwise(F.col("p") % len(lb.OTHER_SECTORS))
        rows = self._sum(lines=self.by_source(), s=F.col("s"), c=c)
        sector = F.when(farm, pick(lb.FOODS, F.col("c"))).otherwise(pick(lb.OTHER_SECTORS, F.col("c")))
        return rows.select(
            "scenario", "region", pick(lb.GASES, F.col("s")).alias("GHG"), sector.alias("sector"), F.lit("MTC").alias("Units"),
            "year", "value",
        )

    def _t_CLUC(self):
        return self._sum("ln", lines=self.by_leaf()).withColumn("Units", F.lit("MTC"))

    def _t_Water_Wsector(self):
        rows = self._sum(lines=self.by_source(), c=F.when(F.col("s") != 0, F.col("p") % lb.N_COMMODITIES))
        return rows.withColumn("sector", F.coalesce(pick(lb.COMMODITIES, F.col("c")), F.lit("industry"))).drop("c")

    def _t_FertizerUse(self):
        return self._by_name(lb.COMMODITIES, "sector", "ln")

    def _by_scenario(self, value: Column) -> DataFrame:
        rows = self.placed_orders().groupBy("sc", "year").agg(F.sum(value).alias("value"))
        return rows.withColumn("scenario", pick(lb.SCENARIOS, F.col("sc"))).drop("sc")

    def _t_MeanTemp(self):
        return self._by_scenario(F.col("n") / 1024)

    def _t_ForcingTotal(self):
        return self._by_scenario(F.col("price") / 1048576)

    # -- auxiliary tables ----------------------------------------------------------------------

    def _named(self, df: DataFrame) -> DataFrame:
        return strict_lookup(df, self.dims.region_ids, "region_id", ["region"], unique=True, what="region ids")

    def _t_harvests(self):
        grown = (F.col("year") == 2015) & (F.col("p") % 3 == 0)
        seen = self.lines().where(grown).select(
            "region_id", "p", (F.col("s") % 5).alias("basin"), "irrigated", (F.col("flag") == "N").alias("high")
        ).distinct()
        per_year = F.lit(1.0) + F.col("p") % 2
        return self._named(seen).select("region", leaf_code("basin", "high").alias("technology"), per_year.alias("harvests_per_year"))

    def _t_exogenous_yield(self):
        sums = self._named(
            self.lines().groupBy("region_id", "irrigated", "p", "year").agg(
                F.sum("qty").alias("nocc"), F.sum(F.col("qty") + F.col("ln")).alias("rcp7p0")
            )
        ).select("region", irrigation_label().alias("irr"), pick(lb.LEAVES, F.col("p")).alias("crop"), "year", "nocc", "rcp7p0")
        return sums.unpivot(["region", "irr", "crop", "year"], ["nocc", "rcp7p0"], "scenario", "value")

    def _t_waste_share(self):
        seen = self.by_leaf().select("region_id", (F.col("p") % len(lb.FOODS)).alias("c"), "year").distinct()
        share = (1 + F.col("c") % 4) / F.lit(16.0)
        return self._named(seen).select(
            "region", pick(lb.FOODS, F.col("c")).alias("commodity"), "year", share.alias("waste_share"), (share / 2).alias("half_waste")
        )

    def _t_fish_share(self):
        fish = F.when(F.col("irrigated"), F.col("qty")).otherwise(F.lit(0.0))
        return self.lines().groupBy("region_id").agg(F.sum(fish).alias("fish"), F.sum(F.col("qty") - fish).alias("other_meat"))

    def _t_uncovered_calories(self):
        return self.lines().groupBy("region_id").agg(
            F.sum("ln").alias("uncovered"), F.sum(F.col("qty") + F.col("ln")).alias("total")
        )

    def _t_labour_force(self):
        sums = self.by_leaf().groupBy("region_id", "year").agg(F.sum("qty").alias("ssp2"), F.sum(F.col("qty") * 2).alias("ssp1"))
        return sums.unpivot(["region_id", "year"], ["ssp2", "ssp1"], "scenario", "value")

    # -- inputs --------------------------------------------------------------------------------

    def inputs(self) -> ModelInputs:
        extra = {"stage": self._stage, "shares": True} if self.keep_stages else {}
        return ModelInputs(
            table=self.table, dims=self.dims, scenarios=lb.SCENARIOS, price_levels=lb.PRICE_LEVELS, **extra
        )


def irrigation_label() -> Column:
    return F.when(F.col("irrigated"), F.lit("IRR")).otherwise(F.lit("RFD"))


def leaf_code(basin: str, high: str) -> Column:
    """Four-part code: leaf, basin, irrigation, management."""
    management = F.when(F.col(high), F.lit("hi")).otherwise(F.lit("lo"))
    return F.concat_ws(
        "_", pick(lb.LEAVES, F.col("p")), F.concat(F.lit("B"), F.col(basin).cast("string")), irrigation_label(), management
    )
