"""What the indicators read."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropledger.functions.units import deflate
from cropledger.operators.access import FIRST_YEAR, LAST_YEAR, in_years, pluck, to_report_region
from cropledger.operators.lookup import strict_lookup
from cropledger.session import WorkFolder
from cropledger.sources.dims import Dimensions, default_dimensions
from cropledger.sources.store import Store

REPORT_COLUMNS = ["Scenario", "Region", "Item", "Variable", "Year", "Unit", "Value"]


@dataclass(frozen=True)
class ModelInputs:
    """Query tables and auxiliary tables by name, dimensions, scenario list and price levels.

    ``stage`` may write an intermediate that several indicators share and read it back; by default
    it stays a lazy plan. ``shares`` says that it does, so that a shared intermediate is worth computing in full.
    """

    table: Callable[[str], DataFrame]
    dims: Dimensions
    scenarios: Sequence[str]
    price_levels: Mapping[int, float]
    years: tuple[int, int] = (FIRST_YEAR, LAST_YEAR)
    stage: Callable[[str, DataFrame], DataFrame] = field(default=lambda name, df: df)
    shares: bool = False
    _plucked: dict = field(default_factory=dict, repr=False, compare=False)

    def _once(self, key: tuple, build: Callable[[], DataFrame]) -> DataFrame:
        if key not in self._plucked:
            self._plucked[key] = build()
        return self._plucked[key]

    def report_level(self, name: str) -> DataFrame:
        """Query table with native region as ``region0`` and report code as ``region``."""
        return self._once(
            ("code", name), lambda: pluck(self.table(name), self.scenarios, self.years, regions=self.dims.regions)
        )

    def native_level(self, name: str, branch: str | None = None) -> DataFrame:
        return self._once(("native", branch, name), lambda: pluck(self.table(name), self.scenarios, self.years, branch=branch))

    def in_years(self, name: str) -> DataFrame:
        return in_years(self.table(name).drop("ss", "version", "scen"), self.years)

    def money(self, value: Column, to_year: int, base_year: int) -> Column:
        return deflate(value, self.price_levels, to_year, base_year)

    def code_of(self, df: DataFrame) -> DataFrame:
        """Attach the report code of a native ``region`` as ``Region``; the native one stays as ``region0``."""
        return to_report_region(df, self.dims.regions).withColumnRenamed("region", "Region")

    def code_of_id(self, df: DataFrame, region_id: str = "region_id") -> DataFrame:
        named = strict_lookup(df, self.dims.region_ids, {region_id: "region_id"}, {"region": "region"}, unique=True, what="region ids")
        return self.code_of(named)


# Auxiliary tables and their columns; they are stored beside the query tables under these names.
AUXILIARY = {
    "harvests": "region string, technology string, harvests_per_year double",
    "exogenous_yield": "region string, irr string, crop string, year int, scenario string, value double",
    "waste_share": "region string, commodity string, year int, waste_share double, half_waste double",
    "fish_share": "region_id int, fish double, other_meat double",
    "uncovered_calories": "region_id int, uncovered double, total double",
    "labour_force": "region_id int, scenario string, year int, value double",
}


def stored_inputs(
    store: Store,
    version: str,
    scenarios: Sequence[str],
    price_levels: Mapping[int, float],
    dims: Dimensions | None = None,
    *,
    keep_stages: bool = True,
    work: WorkFolder | None = None,
) -> ModelInputs:
    """Inputs from a store: query tables pruned to one version, auxiliary tables as they are.

    ``keep_stages`` writes the intermediates that several indicators share to ``work``, or to a folder of their own
    below the shared one; the caller drops it.
    """
    work = work or WorkFolder(store.spark)

    def table(name: str) -> DataFrame:
        return store.load(name) if name in AUXILIARY else store.load(name, versions=[version])

    kept: dict[str, DataFrame] = {}

    def stage(name: str, df: DataFrame) -> DataFrame:
        if name not in kept:
            kept[name] = work.keep(f"stage-{name}", df)
        return kept[name]

    extra = {"stage": stage, "shares": True} if keep_stages else {}
    return ModelInputs(table, dims or default_dimensions(store.spark), scenarios, price_levels, **extra)


def report_rows(df: DataFrame, *extra: str, **columns: Column | str) -> DataFrame:
    """Report columns from expressions or constants; ``extra`` columns (a weight) follow."""
    exprs = {c: columns.get(c, F.col(c) if c in df.columns else None) for c in REPORT_COLUMNS}
    missing = [c for c, e in exprs.items() if e is None]
    if missing:
        raise ValueError(f"no expression for {missing}")
    return df.select(
        *[(F.lit(e) if isinstance(e, str) else e).alias(c) for c, e in exprs.items()], *extra
    )
