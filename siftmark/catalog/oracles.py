"""SQL counterparts of the registered queries, written for DuckDB."""

from __future__ import annotations

from siftmark.catalog.inputs import BALANCE_MEASURES, FLAG_MEASURES, PRIORITY_MEASURES

_NATION_ROWS = """
{p}_rows AS (
  SELECT CAST(c.c_nationkey AS BIGINT) AS entity_key, o.o_custkey,
         CAST(year(o.o_orderdate) AS BIGINT) AS period, {attribute} AS attribute, o.o_totalprice AS price
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
{p}_long AS (
  SELECT entity_key, period, attribute, round(sum(price), 2) AS value, 'price' AS unit
  FROM {p}_rows GROUP BY entity_key, period, attribute),
{p}_pop AS (
  SELECT entity_key, period AS census_period, CAST(count(DISTINCT o_custkey) AS DOUBLE) AS population
  FROM {p}_rows GROUP BY entity_key, period),
{p}_dim AS (
  SELECT CAST(n_nationkey AS BIGINT) AS entity_key, n_name AS entity_name, r_name AS region,
         CAST(NULL AS VARCHAR) AS sub_region, r_name AS continent
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

_SUPPLIER_ROWS = """
{p}_long AS (
  SELECT l_suppkey AS entity_key, CAST(year(l_shipdate) * 12 + month(l_shipdate) AS BIGINT) AS period,
         l_returnflag || '/' || l_linestatus AS attribute, l_extendedprice AS value, 'price' AS unit
  FROM lineitem),
{p}_pop AS (
  SELECT entity_key, period AS census_period, CAST(count(*) AS DOUBLE) AS population
  FROM {p}_long GROUP BY entity_key, period),
{p}_dim AS (
  SELECT s_suppkey AS entity_key, s_name AS entity_name, r_name AS region, n_name AS sub_region,
         r_name AS continent
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_CUSTOMER_ROWS = """
{p}_long AS (
  SELECT o_custkey AS entity_key, CAST(year(o_orderdate) AS BIGINT) AS period,
         o_orderpriority AS attribute, o_totalprice AS value, 'price' AS unit
  FROM orders),
{p}_pop AS (
  SELECT entity_key, period AS census_period, CAST(count(*) AS DOUBLE) AS population
  FROM {p}_long GROUP BY entity_key, period),
{p}_dim AS (
  SELECT c_custkey AS entity_key, c_name AS entity_name,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN r_name END AS region, n_name AS sub_region,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN r_name END AS continent
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def _pivot(p: str, measures: dict[str, str]) -> str:
    cells = ",\n         ".join(
        f"max(CASE WHEN attribute = '{a}' THEN value END) AS {c}" for a, c in measures.items()
    )
    return f"""
{p}_fact AS (
  SELECT entity_key, period,
         {cells}
  FROM {p}_long WHERE entity_key IS NOT NULL GROUP BY entity_key, period HAVING count(value) > 0)"""


def _views(p: str, lags: tuple[int, int]) -> str:
    a, b = lags
    return f"""
{p}_metrics AS (
  SELECT f.entity_key, d.entity_name, d.region, d.sub_region, d.continent, f.period,
         f.consumption, f.production, f.imports, f.exports, p.population,
         CASE WHEN p.population > 0 AND f.consumption IS NOT NULL
              THEN f.consumption * 60000.0 / p.population END AS per_capita_kg_per_person,
         CASE WHEN p.population > 0 AND f.consumption IS NOT NULL
              THEN f.consumption * 1000000.0 / p.population END AS per_capita_bags_per_1000,
         f.imports - f.exports AS net_imports,
         CASE WHEN f.consumption > 0 AND f.imports IS NOT NULL
              THEN f.imports / f.consumption END AS import_dependency_ratio
  FROM {p}_fact f JOIN {p}_dim d ON f.entity_key = d.entity_key
  LEFT JOIN {p}_pop p ON f.entity_key = p.entity_key AND f.period = p.census_period),
{p}_history AS (
  SELECT entity_key, period, consumption,
         lag(consumption, {a}) OVER w AS consumption_{a}y_ago,
         lag(consumption, {b}) OVER w AS consumption_{b}y_ago
  FROM {p}_fact WHERE consumption > 0 WINDOW w AS (PARTITION BY entity_key ORDER BY period)),
{p}_growth AS (
  SELECT *,
         CASE WHEN consumption_{a}y_ago > 0
              THEN round(pow(consumption / consumption_{a}y_ago, 1.0::DOUBLE / {a}) - 1, 9) END AS consumption_cagr_{a}y,
         CASE WHEN consumption_{b}y_ago > 0
              THEN round(pow(consumption / consumption_{b}y_ago, 1.0::DOUBLE / {b}) - 1, 9) END AS consumption_cagr_{b}y
  FROM {p}_history),
{p}_latest AS (
  SELECT entity_key, max(period) AS period FROM {p}_metrics
  WHERE consumption IS NOT NULL AND population IS NOT NULL GROUP BY entity_key),
{p}_snapshot AS (
  SELECT m.entity_key, m.entity_name, m.region, m.continent, m.period, m.consumption, m.production,
         m.imports, m.exports, m.population, m.per_capita_kg_per_person, m.per_capita_bags_per_1000,
         m.net_imports, m.import_dependency_ratio, g.consumption_cagr_{a}y, g.consumption_cagr_{b}y
  FROM {p}_metrics m JOIN {p}_latest l ON m.entity_key = l.entity_key AND m.period = l.period
  LEFT JOIN {p}_growth g ON m.entity_key = g.entity_key AND m.period = g.period),
{p}_trends AS (
  SELECT period, round(sum(consumption), 2) AS total_consumption, round(sum(production), 2) AS total_production,
         round(sum(imports), 2) AS total_imports, round(sum(exports), 2) AS total_exports,
         count(DISTINCT entity_key) AS reporting_entities
  FROM {p}_fact GROUP BY period)"""


def _ranked(p: str, growth: str, where: str = "", name: str = "ranked", weights=(0.35, 0.30, 0.20, 0.15)) -> str:
    w = [f"{float(x)!r}::DOUBLE" for x in weights]
    return f"""
{name}_scores AS (
  SELECT entity_key, entity_name, region, continent, period, consumption, per_capita_kg_per_person,
         {growth}, population, import_dependency_ratio,
         percent_rank() OVER (ORDER BY consumption) AS size_score,
         percent_rank() OVER (ORDER BY coalesce({growth}, -1)) AS growth_score,
         percent_rank() OVER (ORDER BY population) AS population_score,
         percent_rank() OVER (ORDER BY coalesce(import_dependency_ratio, 0)) AS import_openness_score
  FROM {p}_snapshot
  WHERE consumption IS NOT NULL AND population IS NOT NULL AND consumption > 0 {where}),
{name} AS (
  SELECT *, round({w[0]} * size_score + {w[1]} * growth_score + {w[2]} * population_score
                  + {w[3]} * import_openness_score, 9) AS composite_score
  FROM {name}_scores)"""


_BINDINGS = {
    "nat": _NATION_ROWS.format(p="nat", attribute="o.o_orderpriority") + "," + _pivot("nat", PRIORITY_MEASURES),
    "bal": _NATION_ROWS.format(p="bal", attribute="o.o_orderpriority || '/' || o.o_orderstatus")
    + "," + _pivot("bal", BALANCE_MEASURES),
    "sup": _SUPPLIER_ROWS.format(p="sup") + "," + _pivot("sup", FLAG_MEASURES),
    "cus": _CUSTOMER_ROWS.format(p="cus") + "," + _pivot("cus", PRIORITY_MEASURES),
}
_LAGS = {"nat": (5, 10), "bal": (5, 10), "sup": (5, 10), "cus": (1, 3)}


def _sql(p: str, select: str, *more: str, views: bool = True) -> str:
    parts = [_BINDINGS[p]]
    if views:
        parts.append(_views(p, _LAGS[p]))
    parts += [m.strip().rstrip(",") for m in more]
    return "WITH " + ",\n".join(x.strip() for x in parts) + "\n" + select.strip()



# Text labels round half up on the decimal value.
def _number(x: str, d: int = 0) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'N/A' ELSE format('{{:,.{d}f}}', round({x}, {d})) END"


def _pct_text(x: str, d: int) -> str:
    return f"format('{{:.{d}f}}%', round({x} * 100.0, {d}))"


def _pct(x: str, d: int = 1) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'N/A' ELSE {_pct_text(x, d)} END"


def _millions(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'N/A' ELSE format('{{:.0f}}M', round({x} / 1e6)) END"


_SCENARIOS = """
weights(scenario, w1, w2, w3, w4) AS (VALUES
  ('Default', 0.35::DOUBLE, 0.30::DOUBLE, 0.20::DOUBLE, 0.15::DOUBLE),
  ('Size-heavy', 0.70::DOUBLE, 0.10::DOUBLE, 0.10::DOUBLE, 0.10::DOUBLE),
  ('Growth-heavy', 0.10::DOUBLE, 0.70::DOUBLE, 0.10::DOUBLE, 0.10::DOUBLE),
  ('Pop-heavy', 0.10::DOUBLE, 0.10::DOUBLE, 0.70::DOUBLE, 0.10::DOUBLE),
  ('Import-heavy', 0.10::DOUBLE, 0.10::DOUBLE, 0.10::DOUBLE, 0.70::DOUBLE)),
scenario_scores AS (
  SELECT scenario, entity_key, entity_name,
         w1 * size_score + w2 * growth_score + w3 * population_score + w4 * import_openness_score AS composite_score
  FROM ranked_scores CROSS JOIN weights),
scenario_tops AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY composite_score DESC, entity_key) AS position
    FROM scenario_scores) WHERE position <= 3)"""

_SCENARIO_LISTS = """
scenario_lists AS (
  SELECT scenario, string_agg(CAST(entity_key AS VARCHAR), ',' ORDER BY position) AS ranked
  FROM scenario_tops GROUP BY scenario)"""


def _region_tops() -> list[str]:
    parts = []
    for name, where in {"all": "", "asia": "AND region = 'ASIA'", "africa": "AND region = 'AFRICA'"}.items():
        parts.append(_ranked("cus", "consumption_cagr_1y", where, f"r_{name}"))
        parts.append(f"""
t_{name} AS (
  SELECT '{name}' AS scenario, row_number() OVER (ORDER BY composite_score DESC, entity_key) AS position,
         entity_key, entity_name, region, composite_score
  FROM r_{name} ORDER BY composite_score DESC, entity_key LIMIT 3)""")
    parts.append("region_tops AS (SELECT * FROM t_all UNION ALL SELECT * FROM t_asia UNION ALL SELECT * FROM t_africa)")
    return parts


def _leaders(direction: str) -> str:
    components = {
        "size_score": "consumption", "growth_score": "coalesce(consumption_cagr_1y, -1)",
        "population_score": "population", "import_openness_score": "coalesce(import_dependency_ratio, 0)",
    }
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS component, (SELECT entity_key FROM base ORDER BY {m} {direction}, entity_key LIMIT 1) AS entity_key"
        for c, m in components.items()
    )


_CUS_BASE = "base AS (SELECT * FROM cus_snapshot WHERE consumption > 0 AND population IS NOT NULL)"
_HEADLINE = """
{p}_headline AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY (population IS NOT NULL) DESC, period DESC) AS rn
    FROM {p}_metrics) WHERE rn = 1)"""

_RAW = """
raw_long AS (
  SELECT CASE WHEN c_nationkey IN (3, 8) THEN 'World' WHEN c_nationkey = 4 THEN 'Nowhere'
              WHEN c_nationkey IN (2, 7, 12, 17, 22) THEN 'Alias NATION_' || c_nationkey
              WHEN c_nationkey IN (0, 5, 10, 15, 20) THEN '  nation_' || c_nationkey || ' '
              ELSE 'NATION_' || c_nationkey END AS source_name,
         CASE WHEN c_nationkey IN (3, 8) THEN 'excluded' WHEN c_nationkey = 4 THEN 'unmapped'
              WHEN c_nationkey IN (2, 7, 12, 17, 22) THEN 'manual_override' ELSE 'exact_match' END AS match_method,
         CASE WHEN c_nationkey NOT IN (3, 4, 8) THEN printf('N%02d', c_nationkey) END AS iso3_code,
         CAST(year(o_orderdate) AS BIGINT) AS market_year,
         CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS attribute_id, o_orderpriority AS attribute_description,
         CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW') THEN o_totalprice END AS value,
         '(1000 UNITS)' AS unit_description
  FROM orders JOIN customer ON o_custkey = c_custkey),
clean_long AS (
  SELECT iso3_code, source_name AS country_name, market_year, attribute_id, attribute_description, value,
         unit_description
  FROM raw_long WHERE iso3_code IS NOT NULL AND value IS NOT NULL)"""

_CLEAN_POP = """
clean_pop AS (
  SELECT 'Customer ' || o_custkey AS country_name, CAST(o_custkey AS VARCHAR) AS iso3_code,
         CAST(year(o_orderdate) AS BIGINT) AS year, CAST(count(*) AS DOUBLE) AS population
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE c_mktsegment = 'AUTOMOBILE' AND o_orderdate IS NOT NULL GROUP BY ALL)"""

_BALANCE = """
sides AS (
  SELECT entity_key, period,
         0.0::DOUBLE + coalesce(opening_stocks, 0) + coalesce(production, 0) + coalesce(imports, 0)
           + coalesce(roast_imports, 0) + coalesce(soluble_imports, 0) AS supply,
         0.0::DOUBLE + coalesce(exports, 0) + coalesce(roast_exports, 0) + coalesce(soluble_exports, 0)
           + coalesce(consumption, 0) + coalesce(closing_stocks, 0) AS use
  FROM bal_fact),
bal_gaps AS (
  SELECT entity_key, period, round(supply, 2) AS supply, round(use, 2) AS use,
         round(abs(supply - use) / greatest(supply, 1.0) * 100.0, 6) AS gap_pct
  FROM sides QUALIFY row_number() OVER (PARTITION BY entity_key ORDER BY period DESC) = 1),
bal_trade AS (
  SELECT period, sum(coalesce(imports, 0) + coalesce(roast_imports, 0) + coalesce(soluble_imports, 0)) AS ti,
         sum(coalesce(exports, 0) + coalesce(roast_exports, 0) + coalesce(soluble_exports, 0)) AS te
  FROM bal_fact WHERE period >= (SELECT max(period) - 2 FROM bal_fact) GROUP BY period),
bal_trade_gaps AS (
  SELECT period, round(ti, 2) AS total_imports, round(te, 2) AS total_exports,
         abs(ti - te) / greatest(ti, 1.0) * 100.0 AS gap_pct FROM bal_trade)"""


def _check(check_id: str, measured: str, threshold: float, passed: str, details: str, source: str,
           otherwise: str = "FAIL") -> str:
    return (
        f"SELECT '{check_id}' AS check_id, CASE WHEN {passed} THEN 'PASS' ELSE '{otherwise}' END AS status, "
        f"CAST({measured} AS DOUBLE) AS measured, {float(threshold)!r}::DOUBLE AS threshold, '{details}' AS details "
        f"FROM {source}"
    )


def _coverage(p: str, since: int, starts_by: int, reaches: int) -> str:
    return f"""
{p}_cov AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE f.entity_key IS NULL OR f.period IS NULL) AS key_nulls,
         count(*) FILTER (WHERE f.consumption IS NULL) * 100.0::DOUBLE / count(*) AS null_pct,
         min(f.period) AS lo, max(f.period) AS hi,
         coalesce(count(*) FILTER (WHERE f.period >= {since} AND p.population IS NOT NULL) * 100.0::DOUBLE
           / nullif(count(*) FILTER (WHERE f.period >= {since}), 0), 0.0) AS match_pct
  FROM {p}_fact f LEFT JOIN {p}_pop p ON f.entity_key = p.entity_key AND f.period = p.census_period),
{p}_cov_pop AS (SELECT min(census_period) AS lo, max(census_period) AS hi FROM {p}_pop),
{p}_cov_checks AS (
  {_check("A4", "null_pct", 50, "key_nulls = 0 AND null_pct <= 50", "null density of the fact", p + "_cov")}
  UNION ALL {_check("A5-fact", "hi", reaches, f"lo <= {starts_by} AND hi >= {reaches}", "period coverage of the fact", p + "_cov")}
  UNION ALL {_check("A6", "match_pct", 90, "match_pct >= 90", "population coverage of recent rows", p + "_cov")}
  UNION ALL {_check("A5-population", "hi", reaches, f"lo <= {starts_by} AND hi >= {reaches}", "period coverage of the population", p + "_cov_pop")})"""


_RANKING_CHECKS = f"""
rank_top10 AS (SELECT * FROM ranked ORDER BY composite_score DESC, entity_key LIMIT 10),
rank_top3 AS (SELECT * FROM ranked ORDER BY composite_score DESC, entity_key LIMIT 3),
rank_a AS (SELECT count(*) FILTER (WHERE period < 2000) AS stale FROM rank_top10),
rank_b AS (SELECT coalesce(max(composite_score) - min(composite_score), 0.0) AS spread,
                  count(*) FILTER (WHERE composite_score IS NULL) AS missing FROM ranked),
rank_c AS (SELECT count(DISTINCT composite_score) AS scores FROM rank_top3),
rank_checks AS (
  {_check("C4", "stale", 0, "stale = 0", "first ten use recent data", "rank_a", "WARN")}
  UNION ALL {_check("C5", "spread", 0.05, "spread > 0.05", "scores are spread out", "rank_b", "WARN")}
  UNION ALL {_check("G6-scores", "missing", 0, "missing = 0", "no market without a score", "rank_b")}
  UNION ALL {_check("F6", "scores", 3, "scores >= 3", "first three scores differ", "rank_c", "WARN")})"""


_PIVOT_DIFF = """
{p}_cells AS (
  SELECT entity_key, period, attribute, min(value) AS source_min, max(value) AS source_max
  FROM {p}_long WHERE attribute IN ({attributes}) GROUP BY entity_key, period, attribute),
{p}_unpivoted AS ({unpivoted}),
{p}_diff AS (
  SELECT coalesce(c.entity_key, u.entity_key) AS entity_key, coalesce(c.period, u.period) AS period,
         coalesce(c.attribute, u.attribute) AS attribute, source_min, source_max, pivoted
  FROM {p}_cells c FULL JOIN {p}_unpivoted u
    ON c.entity_key = u.entity_key AND c.period = u.period AND c.attribute = u.attribute
  WHERE source_min IS DISTINCT FROM pivoted OR source_max IS DISTINCT FROM pivoted)"""


def _pivot_diff(p: str, measures: dict[str, str]) -> str:
    return _PIVOT_DIFF.format(
        p=p, attributes=", ".join(f"'{a}'" for a in measures),
        unpivoted=" UNION ALL ".join(
            f"SELECT entity_key, period, '{a}' AS attribute, {c} AS pivoted FROM {p}_fact WHERE {c} IS NOT NULL"
            for a, c in measures.items()
        ),
    )


def _audit_ctes() -> list[str]:
    back = """
nat_back AS (
  SELECT latest - earlier AS change FROM (
    SELECT period, total_consumption AS latest, lag(total_consumption, 5) OVER (ORDER BY period) AS earlier,
           lag(period, 5) OVER (ORDER BY period) AS earlier_period FROM nat_trends)
  WHERE earlier_period IS NOT NULL ORDER BY period DESC LIMIT 1)"""
    return [
        _BINDINGS["bal"], _BINDINGS["cus"], _views("nat", (5, 10)), _views("cus", (1, 3)),
        _ranked("cus", "consumption_cagr_1y"), _RANKING_CHECKS, _CUS_BASE, _BALANCE,
        _coverage("nat", 1996, 1996, 2001), _pivot_diff("nat", PRIORITY_MEASURES), back,
        _HEADLINE.format(p="nat"), _RAW,
        f"leaders AS ({_leaders('DESC')})",
        "leader_mode AS (SELECT entity_key, count(*) AS n FROM leaders GROUP BY 1 ORDER BY n DESC, entity_key LIMIT 1)",
        """layer AS (SELECT CASE WHEN (SELECT count(*) FROM cus_long) <> (SELECT count(*) FROM orders) THEN 1 ELSE 0 END AS n)""",
        """dups AS (SELECT count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))""",
        """nat_orphans AS (SELECT count(*) AS n FROM (
             SELECT entity_key FROM nat_fact UNION SELECT entity_key FROM nat_pop) k
           WHERE entity_key NOT IN (SELECT entity_key FROM nat_dim))""",
        "nat_diffs AS (SELECT count(*) AS n FROM nat_diff)",
        "worst_gap AS (SELECT max(gap_pct) AS worst FROM bal_gaps)",
        """top_prod AS (SELECT count(*) FILTER (WHERE entity_key = 7) AS n FROM (
             SELECT entity_key FROM nat_fact WHERE period = (SELECT max(period) FROM nat_fact)
             ORDER BY production DESC NULLS LAST, entity_key LIMIT 20))""",
        """stability AS (SELECT max(round(gap_pct, 6)) - min(round(gap_pct, 6)) AS spread,
             bool_and(total_exports > total_imports) AS lead FROM bal_trade_gaps)""",
        """names AS (SELECT DISTINCT source_name, match_method FROM raw_long)""",
        """mapping AS (SELECT count(*) FILTER (WHERE match_method IN ('manual_override', 'exact_match')) AS mapped,
             count(*) FILTER (WHERE match_method = 'unmapped') AS unmapped FROM names)""",
        """nat_table AS (SELECT count(*) AS n, count(DISTINCT entity_key) AS keys,
             count(*) FILTER (WHERE entity_key IS NULL) AS null_keys,
             count(*) FILTER (WHERE consumption IS NULL) AS null_values,
             min(period) AS lo, max(period) AS hi FROM nat_fact)""",
        """members AS (SELECT count(DISTINCT region) AS found FROM nat_dim WHERE region IN ('ASIA', 'EUROPE'))""",
        """recent AS (SELECT count(consumption) AS n FROM (
             SELECT consumption FROM nat_fact WHERE entity_key = 3 ORDER BY period DESC LIMIT 5))""",
        """ranges AS (SELECT count(*) FILTER (WHERE period BETWEEN 1995 AND 2001) AS w,
             count(*) FILTER (WHERE period BETWEEN 1998 AND 2001) AS s,
             min(period) FILTER (WHERE period BETWEEN 1995 AND 2001) AS wp,
             min(period) FILTER (WHERE period BETWEEN 1998 AND 2001) AS sp FROM nat_trends)""",
        """by_region AS (SELECT region, sum(consumption) FILTER (WHERE period = 1996) AS early,
             sum(consumption) FILTER (WHERE period = 2000) AS late
           FROM nat_metrics WHERE period IN (1996, 2000) GROUP BY region)""",
        """region_sums AS (SELECT sum(early) AS early, sum(late) AS late,
             count(*) FILTER (WHERE early IS DISTINCT FROM late) AS changed FROM by_region)""",
        """head3 AS (SELECT max(period) AS period, count(population) AS n FROM nat_headline WHERE entity_key = 3)""",
        """series3 AS (SELECT count(*) AS n, min(period) AS lo, max(period) AS hi,
             avg(CASE WHEN consumption IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100.0 AS known
           FROM nat_metrics WHERE entity_key = 3)""",
        "checks AS (" + "\nUNION ALL ".join([
            _check("A1", "n", 0, "n = 0", "row counts match between layers", "layer"),
            _check("A1-content", "0", 0, "true", "content matches between layers", "(SELECT 1)"),
            _check("A2", "n", 0, "n = 0", "no duplicate grain", "dups"),
            _check("A3", "n", 0, "n = 0", "no orphans", "nat_orphans"),
            "SELECT * FROM nat_cov_checks",
            _check("A7", "n", 0, "n = 0", "pivot equals source cells", "nat_diffs"),
            _check("B1", "worst", 15, "worst IS NULL OR worst < 15", "balance identity on the latest rows", "worst_gap"),
            _check("B3", "n", 1, "n >= 1", "7 is in the top 20 by production", "top_prod"),
            _check("B5", "coalesce(spread, 999.0)", 10, "lead AND spread <= 10", "trade gap is one-sided and stable", "stability"),
            _check("B7", "n", 3, "n < 3", "no entity leads most components", "leader_mode"),
            "SELECT * FROM rank_checks",
            _check("M1-mapped", "mapped", 15, "mapped >= 15", "mapped names", "mapping"),
            _check("M1-unmapped", "unmapped", 5, "unmapped <= 5", "unmapped names", "mapping"),
            _check("N1-rows", "n", 100, "n >= 100", "row count", "nat_table"),
            _check("N1-keys", "keys", 25, "keys >= 25", "distinct keys", "nat_table"),
            _check("N1-null-keys", "null_keys", 0, "null_keys = 0", "no missing key", "nat_table"),
            _check("N1-null-values", "null_values", 0, "null_values = 0", "no missing value", "nat_table"),
            _check("N1-periods", "hi", 2001, "lo >= 1995 AND hi >= 2001", "period range", "nat_table"),
            _check("G2", "found", 1, "found = 2", "expected members present (all)", "members"),
            _check("G3", "n", 1, "n >= 1", "3 has recent consumption", "recent"),
            _check("G5", "max(change)", 0, "max(change) > 0", "total rose over the lag", "nat_back"),
            _check("T1-rows", "w - s", 0, "w > s", "a wider range has more rows", "ranges"),
            _check("T1-start", "sp - wp", 0, "wp < sp", "a wider range starts earlier", "ranges"),
            _check("T1-total", "late - early", 0, "late > early", "regional total grows", "region_sums"),
            _check("T1-regions", "changed", 1, "changed >= 1", "regional totals change", "region_sums"),
            _check("T0-headline", "period", 2001, "n >= 1 AND period <= 2001", "headline row has a population", "head3"),
            _check("T5-rows", "n", 7, "n >= 7", "series length", "series3"),
            _check("T5-start", "lo", 1995, "lo <= 1995", "series start", "series3"),
            _check("T5-end", "hi", 2001, "hi >= 2001", "series end", "series3"),
            _check("T5-known", "known", 90, "known >= 90", "known values", "series3"),
        ]) + ")",
    ]


def _audit(select: str) -> str:
    return _sql("nat", select, *_audit_ctes(), views=False)


_TOKENS = ("union", "world", "other", "former", "ussr", "yugoslavia", "eu", "area", "total", "states",
           "islands", "arab", "africa", "america", "asia", "europe")
_KEYS = {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"], "customer": ["c_custkey"],
         "labels": ["doc_id"], "conversations": ["conv_id", "turn"]}


def _key_report(table: str, keys: list[str]) -> str:
    null = " OR ".join(f"{k} IS NULL" for k in keys)
    return f"""
SELECT *, null_keys = 0 AND duplicate_keys = 0 AS valid FROM (
  SELECT '{table}' AS table_name, CAST(sum(n) AS BIGINT) AS rows,
         CAST(coalesce(sum(CASE WHEN bad THEN n END), 0) AS BIGINT) AS null_keys,
         count(*) FILTER (WHERE NOT bad AND n > 1) AS duplicate_keys
  FROM (SELECT count(*) AS n, ({null}) AS bad FROM {table} GROUP BY {', '.join(keys)}))"""


_CUS_RANKED = _ranked("cus", "consumption_cagr_1y")

ORACLES: dict[str, str] = {
    # Ranking
    "top_candidates": _sql("nat", "SELECT * FROM ranked ORDER BY composite_score DESC, entity_key LIMIT 20",
                           _ranked("nat", "consumption_cagr_5y")),
    "market_attractiveness": _sql("cus", "SELECT * FROM ranked", _CUS_RANKED),
    "market_attractiveness_distributed": _sql("cus", "SELECT * FROM ranked", _CUS_RANKED),
    "percent_rank_scores": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount,
       round(percent_rank() OVER (ORDER BY l_extendedprice), 9) AS price_rank,
       round(percent_rank() OVER (ORDER BY l_quantity), 9) AS quantity_rank,
       round(percent_rank() OVER (ORDER BY l_discount), 9) AS discount_rank
FROM lineitem""",
    "recommend_by_region": _sql(
        "cus", "SELECT * FROM ranked ORDER BY composite_score DESC, entity_key LIMIT 20",
        _ranked("cus", "consumption_cagr_1y", "AND region IN ('ASIA', 'EUROPE')", weights=(0.5, 0.25, 0.25, 0.0))),
    "weight_scenarios": _sql(
        "cus", "SELECT scenario, entity_key, entity_name, round(composite_score, 9) AS composite_score, position FROM scenario_tops",
        _CUS_RANKED, _SCENARIOS),
    "scenario_lists": _sql("cus", "SELECT * FROM scenario_lists", _CUS_RANKED, _SCENARIOS, _SCENARIO_LISTS),
    "scenario_distinct_lists": _sql(
        "cus", "SELECT count(*) AS scenarios, count(DISTINCT ranked) AS distinct_lists FROM scenario_lists",
        _CUS_RANKED, _SCENARIOS, _SCENARIO_LISTS),
    "region_scenarios": _sql("cus", "SELECT * FROM region_tops", *_region_tops()),
    "component_leaders": _sql("cus", _leaders("DESC"), _CUS_BASE),
    "component_leaders_lowest": _sql("cus", _leaders("ASC"), _CUS_BASE),
    "recommend_labels": _sql("nat", f"""
SELECT position, entity_key, entity_name, coalesce(region, 'N/A') AS region_label,
       {_number('composite_score', 2)} AS score_label, {_millions('population')} AS population_label,
       {_number('consumption')} AS consumption_label, {_pct('consumption_cagr_5y')} AS growth_label,
       {_pct('import_dependency_ratio', 0)} AS import_label,
       concat_ws(' ', CASE position WHEN 1 THEN 'Scale leader with a strong blend of size and trajectory.'
                      WHEN 2 THEN 'High-upside market with strong forward demand signal.'
                      ELSE 'Attractive demand story with clear strategic trade-offs to manage.' END,
         CASE WHEN consumption_cagr_5y IS NOT NULL THEN '5Y CAGR at ' || {_pct_text('consumption_cagr_5y', 1)} || '.' END,
         CASE WHEN import_dependency_ratio IS NOT NULL
              THEN 'Import dependency near ' || {_pct_text('import_dependency_ratio', 0)} || '.' END) AS narrative,
       CASE WHEN entity_name = 'NATION_7' THEN 'A note of its own.'
            ELSE 'Strong analytical candidate; strategic overlay should focus on fit, competition, and operating model.'
            END AS note,
       entity_name || ': size=' || format('{{:,.0f}}', round(consumption)) || ', growth='
         || {_pct_text('coalesce(consumption_cagr_5y, 0)', 1)} || ', pop=' || format('{{:.0f}}M', round(population / 1e6))
         || ', import_dep=' || {_pct_text('coalesce(import_dependency_ratio, 0)', 0)} AS reason
FROM (SELECT *, row_number() OVER (ORDER BY composite_score DESC, entity_key) AS position FROM ranked)
WHERE position <= 3""", _ranked("nat", "consumption_cagr_5y")),
    "display_table": _sql("cus", f"""
SELECT position, entity_name, region, {_number('consumption')} AS consumption_label,
       {_pct('consumption_cagr_1y')} AS growth_label, {_millions('population')} AS population_label,
       {_pct('import_dependency_ratio', 0)} AS import_label, {_number('composite_score', 3)} AS score_label
FROM (SELECT *, row_number() OVER (ORDER BY composite_score DESC, entity_key) AS position FROM ranked)
WHERE position <= 20""", _CUS_RANKED),
    # Facts and views
    "pivot_fact": _sql("sup", "SELECT * FROM sup_fact", views=False),
    "pivot_generated": _sql("bal", """
SELECT entity_key, period, max(CASE WHEN attribute = '1-URGENT/F' THEN value END) AS consumption,
       max(CASE WHEN attribute = '1-URGENT/O' THEN value END) AS production,
       max(CASE WHEN attribute = '1-URGENT/P' THEN value END) AS pending
FROM bal_long GROUP BY entity_key, period HAVING count(value) > 0""", views=False),
    "entity_period_metrics": _sql("sup", "SELECT * FROM sup_metrics"),
    "growth_metrics_yearly": _sql("nat", "SELECT * FROM nat_growth"),
    "growth_metrics_monthly": _sql("sup", "SELECT * FROM sup_growth"),
    "growth_exact_period": _sql("sup", """
SELECT entity_key, period, consumption, consumption_5y_ago, consumption_10y_ago,
       CASE WHEN consumption_5y_ago > 0
            THEN round(pow(consumption / consumption_5y_ago, 1.0::DOUBLE / 5) - 1, 9) END AS consumption_cagr_5y,
       CASE WHEN consumption_10y_ago > 0
            THEN round(pow(consumption / consumption_10y_ago, 1.0::DOUBLE / 10) - 1, 9) END AS consumption_cagr_10y
FROM (SELECT a.entity_key, a.period, a.consumption, b.consumption AS consumption_5y_ago,
             c.consumption AS consumption_10y_ago
      FROM sup_history a
      LEFT JOIN sup_history b ON a.entity_key = b.entity_key AND b.period = a.period - 5
      LEFT JOIN sup_history c ON a.entity_key = c.entity_key AND c.period = a.period - 10)"""),
    "snapshot_latest": _sql("sup", "SELECT * FROM sup_snapshot"),
    "snapshot_from_metrics": _sql("sup", "SELECT * FROM sup_snapshot"),
    "global_trends": _sql("sup", "SELECT * FROM sup_trends ORDER BY period"),
    "trend_range": _sql("nat", """
SELECT *, round(total_consumption / 1000.0, 5) AS consumption_thousands,
       round(total_production / 1000.0, 5) AS production_thousands
FROM nat_trends WHERE period BETWEEN 1997 AND 2001"""),
    "unordered_sample": "SELECT count(*) AS n FROM (SELECT * FROM orders LIMIT 10)",
    "label_file_order": """
SELECT lower(n_name) AS label, format('N{:02d}', n_nationkey) AS code FROM nation
UNION ALL SELECT lower(s_name), 'S' || s_suppkey FROM supplier""",
    "overview_kpi": _sql("nat", """
SELECT min(period) AS first_period, max(period) AS last_period,
       round(max_by(total_consumption, period) / 1000.0, 5) AS latest_thousands,
       round((pow(max_by(total_consumption, period) / min_by(total_consumption, period),
                  1.0::DOUBLE / (max(period) - min(period))) - 1) * 100.0, 7) AS growth_pct,
       max_by(reporting_entities, period) AS reporting_entities
FROM nat_trends WHERE period BETWEEN 1995 AND 2000"""),
    "overview_cards": _sql("nat", """
SELECT format('{:.1f}M', round(max_by(total_consumption, period) / 1000.0, 1)) AS latest_label,
       format('{:.2f}%', round((pow(max_by(total_consumption, period) / min_by(total_consumption, period),
                  1.0::DOUBLE / (max(period) - min(period))) - 1) * 100.0, 2)) AS growth_label,
       'CAGR (' || min(period) || ' to ' || max(period) || ')' AS growth_title,
       CAST(max_by(reporting_entities, period) AS VARCHAR) AS reporting_label
FROM nat_trends WHERE period BETWEEN 1995 AND 2000"""),
    "trend_vs_five_back": _sql("nat", """
SELECT period, latest, earlier, earlier_period, latest > earlier AS rose FROM (
  SELECT period, total_consumption AS latest, lag(total_consumption, 5) OVER (ORDER BY period) AS earlier,
         lag(period, 5) OVER (ORDER BY period) AS earlier_period
  FROM nat_trends ORDER BY period DESC LIMIT 1) WHERE earlier_period IS NOT NULL"""),
    "region_totals": _sql("cus", """
SELECT region, round(sum(consumption), 2) AS total_consumption, count(DISTINCT entity_key) AS entities
FROM cus_metrics WHERE region IS NOT NULL AND period = 2000 AND consumption IS NOT NULL
GROUP BY region ORDER BY total_consumption DESC"""),
    "region_totals_with_unknown": _sql("cus", """
SELECT region, round(sum(consumption), 2) AS total_consumption, count(DISTINCT entity_key) AS entities
FROM cus_metrics WHERE period = 2000 GROUP BY region"""),
    "comparison_feed": _sql("cus", """
SELECT entity_key, entity_name, region, consumption, consumption_cagr_1y, population, per_capita_kg_per_person
FROM cus_snapshot WHERE consumption IS NOT NULL AND population IS NOT NULL AND consumption_cagr_1y IS NOT NULL
  AND region IN ('ASIA', 'AMERICA', 'AFRICA')"""),
    "headline_rows": _sql("cus", "SELECT * FROM cus_headline", _HEADLINE.format(p="cus")),
    "deep_dive_headlines": _sql("sup", f"""
SELECT entity_key, entity_name, period, {_number('consumption')} AS consumption_label,
       {_number('production')} AS production_label, {_millions('population')} AS population_label,
       {_number('per_capita_kg_per_person', 2)} AS per_capita_label FROM sup_headline""", _HEADLINE.format(p="sup")),
    "entity_series": _sql("sup", """
SELECT entity_key, period, consumption, production, imports FROM sup_metrics WHERE entity_key = 7 ORDER BY period"""),
    "opportunity_lines": _sql("sup", f"""
SELECT entity_key, entity_name || ' sits in ' || coalesce(region, 'N/A') || ' with current consumption of '
       || {_number('consumption')} || ' and import dependency of ' || {_pct('import_dependency_ratio')} || '.' AS opportunity
FROM sup_snapshot"""),
    "selector_choices": _sql("cus", """
SELECT DISTINCT 'region' AS control, region AS choice FROM cus_dim WHERE region IS NOT NULL
UNION ALL SELECT 'entity', entity_name FROM (SELECT DISTINCT entity_key, entity_name FROM cus_snapshot)
UNION ALL SELECT 'period', min(period) || '-' || max(period) FROM cus_fact"""),
    "latest_n_rows": _sql("sup", """
SELECT * FROM sup_fact QUALIFY row_number() OVER (PARTITION BY entity_key ORDER BY period DESC) <= 3"""),
    "top_n_nulls_last": _sql("sup", """
SELECT entity_key, production FROM sup_fact WHERE period = (SELECT max(period) FROM sup_fact)
ORDER BY production DESC NULLS LAST, entity_key LIMIT 5"""),
    "sparsest_entity": _sql("cus", """
SELECT entity_key, count(*) AS n FROM cus_fact GROUP BY entity_key ORDER BY n, entity_key LIMIT 1"""),
    "abs_outliers": _sql("sup", """
SELECT entity_key, entity_name, population, consumption_cagr_5y FROM sup_snapshot
WHERE consumption_cagr_5y > 0.05 OR consumption_cagr_5y < -0.05"""),
    "sampled_keys": """
SELECT o_custkey FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL)
ORDER BY md5('42:' || o_custkey), o_custkey LIMIT 3""",
    # Cleaning and reconciliation
    "clean_long_fact": "WITH " + _RAW + " SELECT * FROM clean_long",
    "name_reconciliation": "WITH " + _RAW + """
SELECT DISTINCT source_name AS "Country_Name", iso3_code, match_method FROM raw_long""",
    "mapping_method_counts": "WITH " + _RAW + """
SELECT match_method, count(DISTINCT source_name) AS names FROM raw_long GROUP BY match_method""",
    "attribute_choice": """
SELECT category, attribute,
       attribute = CASE category WHEN 'urgent' THEN '1-URGENT O' ELSE '5-LOW P' END AS chosen
FROM (SELECT DISTINCT o_orderpriority || ' ' || o_orderstatus AS attribute FROM orders)
JOIN (VALUES ('urgent'), ('low')) AS c(category) ON contains(lower(attribute), category)""",
    "dim_region_backfill": """
WITH codes AS (
  SELECT CAST(c_custkey AS VARCHAR) AS iso3_code, c_name AS country_name, substr(c_mktsegment, 1, 2) AS iso2_code,
         CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS region, CAST(NULL AS VARCHAR) AS sub_region,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN 'X' END AS continent,
         CASE WHEN c_mktsegment <> 'MACHINERY' AND r_name <> 'EUROPE' THEN r_name END AS found
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT iso3_code, country_name, iso2_code,
       CASE WHEN (region IS NULL OR continent IS NULL) AND found IS NOT NULL THEN found ELSE region END AS region,
       sub_region,
       CASE WHEN (region IS NULL OR continent IS NULL) AND found IS NOT NULL THEN found ELSE continent END AS continent
FROM codes""",
    "unpivot_population": "WITH " + _CLEAN_POP + " SELECT * FROM clean_pop",
    "csv_roundtrip_sources": "WITH " + _RAW + "," + _CLEAN_POP + """
SELECT printf('N%02d', n_nationkey) AS iso3_code, 1::BIGINT AS rows, 0.0::DOUBLE AS total, 'codes' AS source FROM nation
UNION ALL SELECT iso3_code, count(*), round(sum(value), 2), 'long' FROM clean_long GROUP BY iso3_code
UNION ALL SELECT iso3_code, count(*), sum(population), 'population' FROM clean_pop GROUP BY iso3_code""",
    "csv_quoted_breaks": """
SELECT lang, count(*) AS rows, CAST(sum(length(text) + 18) AS BIGINT) AS characters, 0::BIGINT AS differing, true AS several_blocks
FROM documents GROUP BY lang""",
    "layer_tables": "WITH " + _BINDINGS["nat"].strip() + "," + _RAW + """,
known AS (SELECT DISTINCT iso3_code, market_year, attribute_id FROM raw_long WHERE match_method = 'exact_match' AND value IS NOT NULL),
sizes AS (SELECT (SELECT count(*) FROM nation) AS codes, (SELECT count(*) FROM raw_long WHERE match_method = 'exact_match' AND value IS NOT NULL) AS long,
    (SELECT count(*) FROM nat_pop) AS population, (SELECT count(DISTINCT (iso3_code, market_year)) FROM known) AS fact,
    (SELECT count(*) FROM known WHERE attribute_id = 1) AS growth, (SELECT count(DISTINCT iso3_code) FROM known WHERE attribute_id = 1) AS snapshot,
    (SELECT count(DISTINCT market_year) FROM known) AS periods)
SELECT 'raw_codes' AS table_name, codes AS rows FROM sizes UNION ALL SELECT 'raw_long', long FROM sizes
UNION ALL SELECT 'raw_population', population FROM sizes UNION ALL SELECT 'dim', codes FROM sizes
UNION ALL SELECT 'fact', fact FROM sizes UNION ALL SELECT 'population', population FROM sizes
UNION ALL SELECT 'attractiveness', snapshot FROM sizes UNION ALL SELECT 'v_country_year_metrics', fact FROM sizes
UNION ALL SELECT 'v_country_growth_metrics', growth FROM sizes UNION ALL SELECT 'v_latest_year_snapshot', snapshot FROM sizes
UNION ALL SELECT 'v_global_trends', periods FROM sizes UNION ALL SELECT 'v_market_attractiveness', snapshot FROM sizes
UNION ALL SELECT 'v_top_market_candidates', least(20, snapshot) FROM sizes""",
    "population_fact": "WITH " + _CLEAN_POP + " SELECT iso3_code, year, population FROM clean_pop",
    # Profiles
    "attribute_counts": _sql("sup", "SELECT attribute, count(*) AS rows FROM sup_long GROUP BY attribute", views=False),
    "attribute_entities": _sql(
        "sup", "SELECT attribute, count(DISTINCT entity_key) AS entities FROM sup_long GROUP BY attribute", views=False),
    "period_range": _sql("sup", """
SELECT min(period) AS min_period, max(period) AS max_period, count(DISTINCT period) AS periods FROM sup_long""", views=False),
    "top_entities": _sql("sup", """
SELECT entity_key, count(*) AS rows FROM sup_long GROUP BY entity_key ORDER BY rows DESC, entity_key LIMIT 10""", views=False),
    "attribute_units": _sql("sup", "SELECT DISTINCT attribute, unit FROM sup_long", views=False),
    "dataset_profile": "\nUNION ALL\n".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{kind}' AS type, count(*) AS rows, count({c}) AS non_null, "
        f"count(DISTINCT {c}) AS distinct_values FROM orders"
        for i, (c, kind) in enumerate((
            ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
            ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")))),
    "distinct_values": "SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL",
    "suspicious_names": """
SELECT DISTINCT p_name FROM part
WHERE contains(lower(p_name), 'ring') OR contains(lower(p_name), 'bolt') OR contains(lower(p_name), 'union')""",
    "token_matches": "SELECT lang, count(*) AS documents, count(*) FILTER (WHERE "
    + " OR ".join(f"contains(lower(text), '{t}')" for t in _TOKENS) + ") AS matching FROM documents GROUP BY lang",
    # Data quality
    "duplicate_grain": """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "orphans": """
SELECT DISTINCT entity_key FROM (SELECT c_custkey AS entity_key FROM customer UNION SELECT o_custkey FROM orders)
WHERE entity_key NOT IN (SELECT user_id FROM events)""",
    "key_sets": """
SELECT side, count(*) AS keys FROM (
  SELECT CASE WHEN l.k IS NULL THEN 'left' WHEN o.k IS NULL THEN 'right' ELSE 'both' END AS side
  FROM (SELECT DISTINCT o_orderkey AS k FROM orders) o
  FULL JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) l ON o.k = l.k) GROUP BY side""",
    "null_density": _sql("sup", """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE f.entity_key IS NULL) AS entity_key_nulls,
       count(*) FILTER (WHERE f.period IS NULL) AS period_nulls,
       count(*) FILTER (WHERE consumption IS NULL) AS consumption_nulls,
       count(*) FILTER (WHERE production IS NULL) AS production_nulls,
       count(*) FILTER (WHERE imports IS NULL) AS imports_nulls,
       count(*) FILTER (WHERE exports IS NULL) AS exports_nulls,
       count(*) FILTER (WHERE population IS NULL) AS population_nulls,
       min(f.period) AS min_period, max(f.period) AS max_period,
       count(*) FILTER (WHERE f.period >= 23977) AS recent_rows,
       count(*) FILTER (WHERE f.period >= 23977 AND population IS NOT NULL) AS recent_matched
FROM sup_fact f LEFT JOIN sup_pop p ON f.entity_key = p.entity_key AND f.period = p.census_period""", views=False),
    "join_coverage": _sql("cus", "SELECT * REPLACE (round(measured, 4) AS measured) FROM cus_cov_checks", _coverage("cus", 1999, 1996, 2001), views=False),
    "key_checks": "\nUNION ALL\n".join(_key_report(t, k) for t, k in _KEYS.items()),
    "invalid_codes": "SELECT DISTINCT p_brand FROM part WHERE NOT regexp_matches(p_brand, '^Brand#[0-9]$')",
    "expected_members": _sql("cus", """
SELECT region, region IN (SELECT region FROM cus_snapshot WHERE region IS NOT NULL) AS present
FROM (VALUES ('ASIA'), ('EUROPE'), ('ATLANTIS')) AS wanted(region)"""),
    "freshness_and_spread": _sql("cus", "SELECT * FROM rank_checks", _CUS_RANKED, _RANKING_CHECKS),
    "missing_production": _sql("sup", """
SELECT entity_key, period, production FROM sup_fact
WHERE period >= (SELECT max(period) - 23 FROM sup_fact) AND entity_key IN (1, 2, 3, 5, 8)
  AND (production IS NULL OR production = 0)""", views=False),
    "balance_gap": _sql("bal", "SELECT * FROM bal_gaps", _BALANCE, views=False),
    "trade_gaps": _sql("bal", """
SELECT period, total_imports, total_exports, round(gap_pct, 6) AS gap_pct FROM bal_trade_gaps""", _BALANCE, views=False),
    "trade_gap_stability": _sql("bal", """
SELECT count(*) AS periods, round(max(gap_pct) - min(gap_pct), 6) AS gap_spread,
       bool_and(total_exports > total_imports) AS exports_lead FROM bal_trade_gaps""", _BALANCE, views=False),
    "formula_agreement": _sql("sup", """
SELECT entity_key, round(consumption * 60000.0 / population, 3) AS kg_direct,
       round(per_capita_bags_per_1000 / 1000.0 * 60.0, 3) AS kg_from_bags,
       coalesce(abs(per_capita_bags_per_1000 / 1000.0 * 60.0 - consumption * 60000.0 / population)
         / greatest(consumption * 60000.0 / population, 0.001) <= 0.2, true) AS agrees
FROM sup_snapshot WHERE population > 0"""),
    "per_capita_outside": _sql("sup", """
SELECT entity_key, s_acctbal < 2000 AS upper_only, true AS agrees
FROM (SELECT entity_key, consumption * 60000.0 / population AS kg FROM sup_snapshot WHERE population > 0)
JOIN supplier ON entity_key = s_suppkey
WHERE CASE WHEN s_acctbal < 2000 THEN kg >= s_acctbal * 1e5 ELSE kg < 5e8 / 2 OR kg > s_acctbal * 1e5 * 2 END"""),
    "headline_outside": _sql("sup", """
SELECT entity_key, period, population FROM sup_headline JOIN supplier ON entity_key = s_suppkey
WHERE NOT coalesce(population > 5 AND per_capita_kg_per_person BETWEEN 3e8 AND s_acctbal * 1e5, false)""",
                             _HEADLINE.format(p="sup")),
    "pivot_reconcile": _sql("sup", "SELECT * FROM sup_diff", _pivot_diff("sup", FLAG_MEASURES), views=False),
    "layer_reconcile": """
SELECT coalesce(o.k, l.k) AS k, coalesce(o.n, 0) AS left_rows, coalesce(l.n, 0) AS right_rows,
       coalesce(o.n, 0) = coalesce(l.n, 0) AS equal
FROM (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY 1) o
FULL JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1) l ON o.k = l.k""",
    "layer_content": """
SELECT max(o_orderkey) AS o_orderkey, 1::BIGINT AS left_rows, 1::BIGINT AS right_rows, 'changed' AS change FROM orders
UNION ALL SELECT min(o_orderkey), 1, 0, 'left only' FROM orders UNION ALL SELECT max(o_orderkey) + 1, 0, 1, 'right only' FROM orders""",
    "series_completeness": _sql("sup", """
SELECT entity_key, count(*) AS rows, min(period) AS min_period, max(period) AS max_period,
       round(count(consumption) / count(*) * 100.0::DOUBLE, 6) AS known_pct
FROM sup_metrics GROUP BY entity_key"""),
    "export_reconcile": _sql("cus", """
SELECT name AS table_name, n AS live_rows, n AS exported_rows, true AS equal, true AS equal_values FROM (
  SELECT 'dim' AS name, count(*) AS n FROM cus_dim UNION ALL SELECT 'fact', count(*) FROM cus_fact
  UNION ALL SELECT 'population', count(*) FROM cus_pop)""", views=False),
    "export_normalised": """
SELECT event_id, event_type, CASE WHEN event_type NOT IN ('error', 'signup') THEN value END AS value FROM events""",
    "profile_report": _sql("sup", """
SELECT 'attribute_counts' AS part, count(DISTINCT attribute) AS rows FROM sup_long
UNION ALL SELECT 'period_range', 1
UNION ALL SELECT 'attribute_entities', count(DISTINCT attribute) FROM sup_long
UNION ALL SELECT 'top_entities', least(10, count(DISTINCT entity_key)) FROM sup_long
UNION ALL SELECT 'attribute_units', count(DISTINCT (attribute, unit)) FROM sup_long""", views=False),
    "audit_checks": _audit("SELECT check_id, status, round(measured, 4) AS measured, threshold, details FROM checks"),
    "snapshot_checks": _sql("sup", "\nUNION ALL\n".join([
        _check("C1", "outliers", 0, "outliers = 0", "no extreme growth", "s", "WARN"),
        _check("C1-large", "large", 0, "large = 0", "no extreme growth among large entities", "s", "WARN"),
        _check("T0-population", "pop", 95, "pop > 95", "snapshot population coverage", "s"),
        _check("T0-per-capita", "kg", 95, "kg > 95", "snapshot per-capita coverage", "s"),
    ]), """
s AS (SELECT count(*) FILTER (WHERE abs(consumption_cagr_5y) > 0.5) AS outliers,
             count(*) FILTER (WHERE abs(consumption_cagr_5y) > 0.5 AND population > 50000000) AS large,
             count(population) * 100.0::DOUBLE / count(*) AS pop,
             count(per_capita_kg_per_person) * 100.0::DOUBLE / count(*) AS kg FROM sup_snapshot)"""),
    "scenario_checks": _sql("cus", "\nUNION ALL\n".join([
        _check("B6", "lists", 2, "lists > 1", "ranking reacts to the weights", "l"),
        _check("T3-lists", "lists", 2, "lists = scenarios", "every scenario has its own list", "l"),
        _check("T3-lifted", "lifted", 1, "lifted >= 1", "growth weights lift another entity", "g"),
        _check("T2-region", "wrong", 0, "wrong = 0", "the region filter holds", "r"),
        _check("T2-open", "other", 1, "other >= 1", "without a filter other regions appear", "r"),
        _check("T2-lists", "lists", 3, "lists = scenarios", "the lists differ by region", "rl"),
    ]), _CUS_RANKED, _SCENARIOS, _SCENARIO_LISTS, *_region_tops(), """
l AS (SELECT count(*) AS scenarios, count(DISTINCT ranked) AS lists FROM scenario_lists),
g AS (SELECT count(DISTINCT entity_key) AS lifted FROM scenario_tops WHERE scenario = 'Growth-heavy'
      AND entity_key NOT IN (SELECT entity_key FROM scenario_tops WHERE scenario = 'Size-heavy')),
r AS (SELECT count(*) FILTER (WHERE (scenario = 'asia' AND region IS DISTINCT FROM 'ASIA')
                              OR (scenario = 'africa' AND region IS DISTINCT FROM 'AFRICA')) AS wrong,
             count(*) FILTER (WHERE scenario = 'all' AND region IS DISTINCT FROM 'ASIA') AS other FROM region_tops),
rl AS (SELECT count(*) AS scenarios, count(DISTINCT ranked) AS lists FROM (
         SELECT scenario, string_agg(CAST(entity_key AS VARCHAR), ',' ORDER BY position) AS ranked
         FROM region_tops GROUP BY scenario))"""),
    "edge_filters": _sql("cus", "\nUNION ALL\n".join([
        _check("E1-ranking", "n", 1, "n >= 1", "no filter gives rows", "a", "WARN"),
        _check("E1-region", "n", 0, "n = 0", "an unknown region gives no rows", "b"),
        _check("E1-period", "n", 1, "n = 1", "one period gives one row", "c", "WARN"),
        _check("E1-entity", "n", 0, "n = 0", "an unknown entity gives no rows", "d"),
    ]), """
a AS (SELECT least(count(*), 20) AS n FROM cus_snapshot WHERE consumption > 0 AND population IS NOT NULL),
b AS (SELECT count(*) AS n FROM cus_snapshot WHERE region = 'ATLANTIS'),
c AS (SELECT count(*) AS n FROM cus_trends WHERE period = 2001),
d AS (SELECT count(*) AS n FROM cus_metrics WHERE entity_key = -1)"""),
}


def _findings(check_id: str, details: str, name: str, sql: str, otherwise: str = "FAIL") -> str:
    return (
        f"SELECT '{check_id}' AS check_id, CASE WHEN n = 0 THEN 'PASS' ELSE '{otherwise}' END AS status, CAST(n AS DOUBLE) AS measured, "
        f"0.0::DOUBLE AS threshold, '{details}' || CASE WHEN n > 0 THEN ': ' || names ELSE '' END AS details FROM ("
        f"SELECT count(*) AS n, array_to_string(list(CAST({name} AS VARCHAR) ORDER BY {name})[1:5], ', ') AS names FROM ({sql}))"
    )


def _minimums(prefix: str, sql: str, rows: int, keys: int, value: str | None = None) -> list[str]:
    found = (f"(SELECT count(*) AS n, count(DISTINCT entity_key) AS keys, count(*) FILTER (WHERE entity_key IS NULL) AS nulls, "
             f"count(*) FILTER (WHERE {value or 'entity_key'} IS NULL) AS empty FROM ({sql}))")
    out = [_check(f"{prefix}-rows", "n", rows, f"n >= {rows}", "row count", found),
           _check(f"{prefix}-keys", "keys", keys, f"keys >= {keys}", "distinct keys", found),
           _check(f"{prefix}-null-keys", "nulls", 0, "nulls = 0", "no missing key", found)]
    return out + ([_check(f"{prefix}-null-values", "empty", 0, "empty = 0", "no missing value", found)] if value else [])


ORACLES["detail_checks"] = "\nUNION ALL ".join([
    _findings("B2", "per capita within bounds", "entity_key", ORACLES["per_capita_outside"]),
    _check("B4", "n", 1, "n >= 1", "7 is in the top 20 by imports", "(SELECT count(*) FILTER (WHERE entity_key = 7) AS n FROM ("
           + _sql("sup", """
SELECT entity_key FROM sup_fact WHERE period = (SELECT max(period) FROM sup_fact)
ORDER BY imports DESC NULLS LAST, entity_key LIMIT 20""", views=False) + "))"),
    _findings("C1-names", "no extreme growth", "entity_key", _sql("sup", "SELECT entity_key FROM sup_snapshot WHERE abs(consumption_cagr_5y) > 0.5"), "WARN"),
    _findings("C2", "core producers report production", "entity_key", ORACLES["missing_production"], "WARN"),
    _findings("E5", "codes have the right form", "p_brand", ORACLES["invalid_codes"]),
    _findings("T4", "headlines within bounds", "entity_key", ORACLES["headline_outside"]),
    _findings("M1-names", "every name is mapped", '"Country_Name"',
              f"SELECT * FROM ({ORACLES['name_reconciliation']}) WHERE match_method = 'unmapped'", "WARN"),
    *_minimums("G2", _sql("sup", "SELECT entity_key FROM sup_dim"), 5, 5),
    *_minimums("G4", _sql("sup", "SELECT entity_key, population FROM sup_pop"), 100, 0, "population"),
    *_minimums("G5", _sql("sup", "SELECT entity_key, consumption FROM sup_snapshot"), 5, 0, "consumption"),
])


def _table_counts(sql: str, key: str, value: str = "1", period: str = "0") -> str:
    return f"""(SELECT count(*) AS n, count(DISTINCT {key}) AS keys, count(*) FILTER (WHERE {key} IS NULL) AS null_keys,
  count(*) FILTER (WHERE {value} IS NULL) AS null_values, min({period}) AS lo, max({period}) AS hi FROM ({sql}))"""


def _build_checks() -> list[str]:
    pop = _table_counts("SELECT * FROM nat_pop", "entity_key", "population", "census_period")
    codes = _table_counts("SELECT * FROM nation", "n_nationkey")
    latest = "(SELECT (SELECT max_by(population, census_period) FROM nat_pop WHERE entity_key = {e}) AS v)"
    sizes = {"metrics": ("nat_metrics", 100), "growth": ("nat_growth", 100), "snapshot": ("nat_snapshot", 20), "trends": ("nat_trends", 6),
             "attractiveness": ("ranked", 20)}
    return [
        _check("N1-population-rows", "n", 100, "n >= 100", "row count", pop),
        _check("N1-population-keys", "keys", 25, "keys >= 25", "distinct keys", pop),
        _check("N1-population-null-keys", "null_keys", 0, "null_keys = 0", "no missing key", pop),
        _check("N1-population-null-values", "null_values", 0, "null_values = 0", "no missing value", pop),
        _check("N1-population-periods", "hi", 2001, "lo >= 1995 AND hi >= 2001", "period range", pop),
        _check("N1-codes-rows", "n", 25, "n >= 25", "row count", codes),
        _check("N1-codes-keys", "keys", 25, "keys >= 25", "distinct keys", codes),
        _check("N1-codes-null-keys", "null_keys", 0, "null_keys = 0", "no missing key", codes),
        _findings("N1-facts", "codes of facts are in the reference", "k",
                  "SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"),
        _findings("N1-population", "codes of population are in the reference", "k",
                  "SELECT DISTINCT user_id AS k FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)"),
        *[_check(f"G4-{e}", "v", 1, "coalesce(v > 1, false)", f"latest population of {e}", latest.format(e=e)) for e in (3, 7, 99)],
        *[_check(f"G5-{name}", "n", least, f"n >= {least}", f"rows of {name}", f"(SELECT count(*) AS n FROM {t})")
          for name, (t, least) in sizes.items()],
        _check("G5-band", "v", 1e6, "coalesce(v BETWEEN 1e6 AND 1e12, false)", "per_capita_kg_per_person of 3 up to 1e+12",
               "(SELECT max(per_capita_kg_per_person) AS v FROM nat_snapshot WHERE entity_key = 3)"),
        _check("G6-members", "n", 1, "n >= 1", "an expected entity is among the first",
               "(SELECT count(*) FILTER (WHERE entity_key IN (3, 7, 12, 18, 21, 24)) AS n FROM "
               "(SELECT entity_key FROM ranked ORDER BY composite_score DESC, entity_key LIMIT 20))"),
    ]


ORACLES["build_checks"] = _sql("nat", "\nUNION ALL ".join(_build_checks()), _ranked("nat", "consumption_cagr_5y"))
ORACLES["scorecard"] = """
SELECT *, CASE WHEN failed >= 4 THEN 'LOW' WHEN failed > 0 OR warned >= 6 THEN 'MEDIUM' ELSE 'HIGH' END AS confidence,
       CASE WHEN passed = total THEN 'HIGH' WHEN passed >= total - 2 THEN 'MEDIUM' ELSE 'LOW' END AS pass_confidence
FROM (SELECT count(*) FILTER (WHERE status = 'PASS') AS passed, count(*) FILTER (WHERE status = 'WARN') AS warned,
             count(*) FILTER (WHERE status = 'FAIL') AS failed, count(*) AS total FROM (
""" + "\nUNION ALL\n".join(
    f"SELECT status FROM ({ORACLES[k]})"
    for k in ("audit_checks", "detail_checks", "build_checks", "snapshot_checks", "scenario_checks", "edge_filters")) + "))"
