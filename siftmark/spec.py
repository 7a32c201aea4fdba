"""Column roles, fixed values and size limits shared by all operators."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Exact-string overrides from source entity name to ISO3 code.
NAME_OVERRIDES: dict[str, str] = {
    "Korea, South": "KOR",
    "Korea, North": "PRK",
    "Burma": "MMR",
    "Congo (Kinshasa)": "COD",
    "Congo (Brazzaville)": "COG",
    "Cote d'Ivoire": "CIV",
    "C??te d'Ivoire": "CIV",
    "Russia": "RUS",
    "Vietnam": "VNM",
    "Venezuela": "VEN",
    "Yemen (Sanaa)": "YEM",
    "Iran": "IRN",
    "Tanzania": "TZA",
    "Macedonia": "MKD",
    "Cape Verde": "CPV",
    "Slovak Republic": "SVK",
    "Laos": "LAO",
    "Brunei": "BRN",
    "Bolivia": "BOL",
    "Czech Republic": "CZE",
    "Egypt": "EGY",
    "Hong Kong": "HKG",
    "Macau": "MAC",
    "Moldova": "MDA",
    "Syria": "SYR",
    "Taiwan": "TWN",
    "United Kingdom": "GBR",
    "United States": "USA",
    "Gambia, The": "GMB",
    "Bahamas, The": "BHS",
}

# Source names that denote groups of entities, never one entity.
EXCLUDED_NAMES: tuple[str, ...] = (
    "European Union",
    "European Union-27",
    "European Union-28",
    "Former Czechoslovakia",
    "Former Yugoslavia",
    "Former USSR",
    "Other",
    "Unknown",
)

# Header names under which the reference codes may arrive.
NAME_HEADERS = ("LABEL EN", "Label en", "English Name", "english_name", "name")
ISO3_HEADERS = ("ISO3 CODE", "ISO3", "iso3_code")
ISO2_HEADERS = ("ISO2 CODE", "ISO2", "iso2_code")

# Attribute label -> measure column of the wide fact.
BALANCE_MEASURES: dict[str, str] = {
    "Domestic Consumption": "domestic_consumption",
    "Production": "production",
    "Bean Imports": "bean_imports",
    "Bean Exports": "bean_exports",
    "Ending Stocks": "ending_stocks",
    "Beginning Stocks": "beginning_stocks",
    "Roast & Ground Imports": "roast_ground_imports",
    "Roast & Ground Exports": "roast_ground_exports",
    "Soluble Imports": "soluble_imports",
    "Soluble Exports": "soluble_exports",
}

# Preference order when an attribute is chosen per category.
ATTRIBUTE_PREFERENCES: dict[str, tuple[str, ...]] = {
    "consumption": ("Domestic Consumption",),
    "production": ("Production",),
    "imports": ("Bean Imports", "Imports"),
    "exports": ("Bean Exports", "Exports"),
}

# Tokens that mark a source name as a likely aggregate.
SUSPICIOUS_TOKENS = (
    "union", "world", "other", "former", "ussr", "yugoslavia", "eu", "area",
    "total", "states", "islands", "arab", "africa", "america", "asia", "europe",
)

# Component weights (size, growth, population, import openness).
DEFAULT_WEIGHTS = (0.35, 0.30, 0.20, 0.15)
WEIGHT_SCENARIOS: dict[str, tuple[float, float, float, float]] = {
    "Default": DEFAULT_WEIGHTS,
    "Size-heavy": (0.70, 0.10, 0.10, 0.10),
    "Growth-heavy": (0.10, 0.70, 0.10, 0.10),
    "Pop-heavy": (0.10, 0.10, 0.70, 0.10),
    "Import-heavy": (0.10, 0.10, 0.10, 0.70),
}


@dataclass(frozen=True)
class MarketSpec:
    """Names the columns that play each role; defaults fit a balance-sheet feed."""

    entity: str = "iso3_code"
    name: str = "country_name"
    period: str = "market_year"
    attribute: str = "attribute_description"
    attribute_id: str = "attribute_id"
    value: str = "value"
    unit: str = "unit_description"
    population: str = "population"
    population_period: str = "year"
    region: str = "region"
    sub_region: str = "sub_region"
    continent: str = "continent"

    consumption: str = "domestic_consumption"
    production: str = "production"
    imports: str = "bean_imports"
    exports: str = "bean_exports"
    opening: str = "beginning_stocks"
    closing: str = "ending_stocks"
    other_imports: tuple[str, ...] = ("roast_ground_imports", "soluble_imports")
    other_exports: tuple[str, ...] = ("roast_ground_exports", "soluble_exports")

    # Names of derived columns
    net_imports: str = "net_bean_imports"
    total_imports: str = "total_bean_imports"
    total_exports: str = "total_bean_exports"
    reporting: str = "reporting_countries"
    region_members: str = "countries"

    measures: Mapping[str, str] = field(default_factory=lambda: dict(BALANCE_MEASURES))
    kg_per_unit: float = 60_000.0
    bags_per_unit_1000: float = 1_000_000.0
    lags: tuple[int, ...] = (5, 10)
    weights: tuple[float, float, float, float] = DEFAULT_WEIGHTS
    top_k: int = 20

    @property
    def keys(self) -> list[str]:
        return [self.entity, self.period]

    @property
    def core_measures(self) -> list[str]:
        return [self.consumption, self.production, self.imports, self.exports]

    @property
    def measure_columns(self) -> list[str]:
        return list(dict.fromkeys(self.measures.values()))
