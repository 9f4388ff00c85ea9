"""The same results as ANSI SQL over the given tables."""

from __future__ import annotations

from verification.inputs import LEDGER_BEFORE, MERGED_BEFORE, OBS, PAGE_PARTS, RATES
from verification.queries import ONE_RUN

# CTEs, each with the ones it reads.
CTES: dict[str, tuple[list[str], str]] = {
    "obs": ([], OBS.format(lineitem="lineitem", part="part")),
    "rates": ([], RATES.format(orders="orders")),
    "parts": (["obs"], PAGE_PARTS.format()),
    "upper_rates": (
        ["rates"],
        """
        SELECT effective_date, upper(base_currency) AS price_currency, upper(quote_currency) AS quote_currency,
               rate_to_pln, provider, source_table, fetched_at
        FROM rates""",
    ),
    "stg_rates": (
        ["upper_rates"],
        """
        SELECT effective_date, price_currency, quote_currency, rate_to_pln, provider, source_table, fetched_at
        FROM (SELECT *, row_number() OVER (PARTITION BY effective_date, price_currency, quote_currency
                                           ORDER BY fetched_at DESC) AS n FROM upper_rates) r
        WHERE n = 1""",
    ),
    "latest": (
        ["stg_rates"],
        """
        SELECT price_currency, rate_to_pln
        FROM (SELECT *, row_number() OVER (PARTITION BY price_currency
                                           ORDER BY effective_date DESC, fetched_at DESC) AS n
              FROM stg_rates WHERE quote_currency = 'PLN') r
        WHERE n = 1""",
    ),
    "norm": (
        ["obs", "latest"],
        """
        SELECT source_offer_id, url, title, brand, model, year, mileage_km, fuel_type, transmission,
               CASE WHEN o.price_currency = 'PLN' THEN price_amount
                    WHEN rate_to_pln IS NOT NULL THEN price_amount * CAST(rate_to_pln AS DOUBLE) END AS price_amount,
               CASE WHEN o.price_currency = 'PLN' OR rate_to_pln IS NOT NULL THEN 'PLN'
                    ELSE o.price_currency END AS price_currency,
               observed_at, scrape_run_id
        FROM obs o LEFT JOIN latest l ON o.price_currency = l.price_currency""",
    ),
    "newest": (
        ["norm"],
        """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_offer_id
                                                    ORDER BY observed_at DESC, scrape_run_id DESC) AS n FROM norm) r
        WHERE n = 1""",
    ),
    "history": (
        ["obs"],
        """
        SELECT source_offer_id, min(observed_at) AS first_observed_at, max(observed_at) AS last_observed_at,
               count(*) AS observation_count
        FROM obs GROUP BY source_offer_id""",
    ),
    "fct": (
        ["obs"],
        """
        SELECT source_offer_id AS offer_key, observed_at, price_amount, price_currency, mileage_km, scrape_run_id
        FROM obs""",
    ),
    "dim": (
        ["newest", "history"],
        """
        SELECT n.source_offer_id AS offer_key, url, title, brand, model, year, mileage_km, fuel_type, transmission,
               price_amount, price_currency, first_observed_at, last_observed_at, observation_count
        FROM newest n JOIN history h ON n.source_offer_id = h.source_offer_id""",
    ),
    "daily": (
        ["fct"],
        """
        SELECT CAST(observed_at AS DATE) AS observation_date, count(*) AS observation_count,
               count(DISTINCT offer_key) AS distinct_offer_count,
               CAST(sum(CAST(price_amount AS DECIMAL(18,2))) AS DOUBLE) / count(price_amount) AS average_price_amount
        FROM fct GROUP BY CAST(observed_at AS DATE)""",
    ),
    "by_brand": (
        ["dim"],
        "SELECT coalesce(brand, 'unknown') AS brand, count(*) AS offer_count FROM dim GROUP BY coalesce(brand, 'unknown')",
    ),
    "by_fuel": (
        ["dim"],
        """
        SELECT coalesce(fuel_type, 'unknown') AS fuel_type, count(*) AS offer_count
        FROM dim GROUP BY coalesce(fuel_type, 'unknown')""",
    ),
    "inventory": (
        ["by_brand"],
        """
        SELECT brand, offer_count AS total_offers,
               offer_count / nullif((SELECT CAST(sum(offer_count) AS BIGINT) FROM by_brand), 0) AS inventory_share
        FROM by_brand""",
    ),
    "fuel": (
        ["by_fuel"],
        """
        SELECT fuel_type, offer_count AS total_offers,
               offer_count / nullif((SELECT CAST(sum(offer_count) AS BIGINT) FROM by_fuel), 0) AS fuel_share
        FROM by_fuel""",
    ),
    "new_by_day": (
        ["dim"],
        """
        SELECT CAST(first_observed_at AS DATE) AS observation_date, count(*) AS new_offer_count
        FROM dim GROUP BY CAST(first_observed_at AS DATE)""",
    ),
    "overview": (
        ["daily", "new_by_day"],
        """
        SELECT d.observation_date, (SELECT count(*) FROM dim) AS current_offer_count,
               coalesce(new_offer_count, 0) AS new_offer_count,
               CAST(sum(coalesce(new_offer_count, 0)) OVER (ORDER BY d.observation_date
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_offer_count,
               observation_count, distinct_offer_count, average_price_amount
        FROM daily d LEFT JOIN new_by_day n ON d.observation_date = n.observation_date""",
    ),
    "mileage": (
        ["dim"],
        """
        SELECT offer_key, url, title, coalesce(brand, 'unknown') AS brand, coalesce(model, 'unknown') AS vehicle_model,
               coalesce(year, 0) AS model_year, fuel_type, transmission, mileage_km, price_amount, price_currency,
               last_observed_at
        FROM dim WHERE mileage_km IS NOT NULL AND price_amount IS NOT NULL""",
    ),
    "priced": (
        ["dim"],
        """
        SELECT coalesce(brand, 'unknown') AS brand, coalesce(model, 'unknown') AS vehicle_model,
               coalesce(year, 0) AS model_year, price_currency, price_amount
        FROM dim WHERE price_amount IS NOT NULL AND price_currency IS NOT NULL""",
    ),
    "distribution": (
        ["priced"],
        """
        SELECT brand, vehicle_model, model_year, price_currency, count(*) AS offer_count,
               min(price_amount) AS minimum_price_amount, median(price_amount) AS median_price_amount,
               max(price_amount) AS maximum_price_amount
        FROM priced GROUP BY brand, vehicle_model, model_year, price_currency""",
    ),
    "latest_offers": (
        ["mileage"],
        """
        SELECT * FROM mileage WHERE mileage_km >= 0 AND price_amount > 0
        ORDER BY last_observed_at DESC, offer_key LIMIT 1000""",
    ),
    "pending": (["obs"], f"SELECT * FROM obs WHERE scrape_run_id >= '{LEDGER_BEFORE}'"),
    # Listings: one row per offer of a block, as the payload lists them.
    "listed": (
        ["obs"],
        """
        SELECT target, page, offer, url, row_number() OVER (PARTITION BY target, page ORDER BY offer) - 1 AS pos,
               page % 19 <> 0 AND page % 17 <> 0 AS found
        FROM (SELECT DISTINCT scrape_run_id AS target, CAST(source_offer_id AS BIGINT) // 9 + 1 AS page,
                     CAST(source_offer_id AS BIGINT) AS offer, url FROM obs) s""",
    ),
    "urls": (
        ["listed"],
        """
        SELECT target, page, CAST(pos AS INT) AS edge_pos, url
        FROM listed WHERE found AND offer % 25 <> 0 AND page % 29 <> 0""",
    ),
    "sized": (
        ["listed"],
        """
        SELECT target, page AS listing_page,
               CASE WHEN found AND page % 13 <> 0 THEN page * 7 % 100 END AS total,
               CASE WHEN page % 11 = 0 THEN 0 ELSE 9 END AS size, found
        FROM (SELECT DISTINCT target, page, found FROM listed) l""",
    ),
    "payloads": (
        ["rates"],
        """
        SELECT *, CAST(split_part(source_table, '/', 1) AS INT) % 10 AS shape,
               CAST(split_part(source_table, '/', 1) AS INT) % 15 AS tail FROM rates""",
    ),
    "ranked_in_run": (
        ["obs"],
        """
        SELECT *, row_number() OVER (PARTITION BY scrape_run_id
                                     ORDER BY observed_at DESC, source_offer_id, scrape_run_id, url) AS rank
        FROM obs""",
    ),
    "ranked": (
        ["obs"],
        """
        SELECT *, row_number() OVER (ORDER BY observed_at DESC, source_offer_id, scrape_run_id, url) AS rank
        FROM obs""",
    ),
}

PAGE_REASON = """
CASE WHEN shape = 0 THEN 'no_page_json' WHEN shape = 1 THEN 'bad_json' WHEN shape = 2 THEN 'missing_key'
     WHEN shape = 4 THEN 'bad_parameters' WHEN shape IN (3, 10) OR year IS NULL THEN 'bad_year'
     WHEN mileage_km IS NULL THEN 'bad_mileage' WHEN shape = 5 OR price_amount IS NULL THEN 'bad_price' END
"""
RATE_REASON = """
CASE WHEN shape IN (5, 7) OR tail IN (12, 13) THEN 'bad_payload' WHEN shape = 6 THEN 'wrong_currency'
     WHEN shape IN (3, 4) THEN 'non_positive_rate' WHEN tail = 11 THEN 'bad_payload' END
"""
PAGES_REASON = """
CASE WHEN NOT found THEN 'no_search_node' WHEN total IS NULL THEN 'missing_key'
     WHEN size = 0 THEN 'zero_page_size' END
"""
LATEST_LINE = """
concat(CAST(rank AS VARCHAR), '. ', title, ' — ', concat_ws(' ', brand, model, CAST(year AS VARCHAR)),
       CASE WHEN mileage_km IS NOT NULL THEN concat(' | ', CAST(mileage_km AS VARCHAR), ' km') ELSE '' END, ' | ',
       concat_ws(' ', CAST(price_amount AS VARCHAR), price_currency), chr(10), url)
"""
RUN_LINE = """
concat(CAST(rank AS VARCHAR), '. ', substr(title, 1, 55), ' — ',
       concat_ws(' | ', nullif(concat_ws(' ', brand, model, CAST(year AS VARCHAR)), ''),
                 coalesce(nullif(concat_ws(' ', CAST(price_amount AS VARCHAR), price_currency), ''), 'price unavailable'),
                 CASE WHEN mileage_km IS NOT NULL THEN concat(CAST(mileage_km AS VARCHAR), ' km')
                      ELSE 'mileage unavailable' END),
       chr(10), substr(url, 1, 80))
"""


def _not_null(model: str, source: str, column: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS column_name, 'not_null' AS check_kind, "
        f"count(*) AS failures FROM {source} WHERE {column} IS NULL"
    )


def _unique(model: str, source: str, column: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS column_name, 'unique' AS check_kind, count(*) AS failures "
        f"FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1) d"
    )


def _accepted(model: str, source: str, column: str, values: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS column_name, 'accepted_values' AS check_kind, "
        f"count(DISTINCT {column}) AS failures FROM {source} WHERE {column} NOT IN ({values})"
    )


def _orphans(parent: str) -> str:
    return (
        "SELECT 'fct__offer_observations' AS model, 'offer_key' AS column_name, 'relationships' AS check_kind, "
        f"count(*) AS failures FROM fct f WHERE offer_key IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.offer_key = f.offer_key)"
    )


SOURCES = {
    "offers_observations": "obs",
    "currency_rates": "rates",
    "stg__currency_rates": "stg_rates",
    "dim__offers": "dim",
    "fct__offer_observations": "fct",
    "agg__offers_by_brand": "by_brand",
    "agg__offers_by_fuel_type": "by_fuel",
    "agg__daily_offer_observations": "daily",
    "rpt__marketplace_overview": "overview",
    "rpt__mileage_vs_price": "mileage",
    "rpt__price_distribution_by_vehicle": "distribution",
}
NOT_NULL_CHECKS = [
    ("offers_observations", "source_offer_id observed_at brand model year mileage_km transmission price_amount price_currency"),
    ("currency_rates", "effective_date base_currency quote_currency rate_to_pln"),
    (
        "stg__currency_rates",
        "effective_date price_currency quote_currency rate_to_pln provider source_table fetched_at",
    ),
    ("dim__offers", "offer_key first_observed_at last_observed_at observation_count"),
    ("fct__offer_observations", "offer_key observed_at"),
    ("agg__offers_by_brand", "offer_count"),
    ("agg__offers_by_fuel_type", "offer_count"),
    ("agg__daily_offer_observations", "observation_date observation_count distinct_offer_count"),
    (
        "rpt__marketplace_overview",
        "observation_date current_offer_count new_offer_count cumulative_offer_count observation_count "
        "distinct_offer_count",
    ),
    ("rpt__mileage_vs_price", "offer_key mileage_km price_amount price_currency"),
    (
        "rpt__price_distribution_by_vehicle",
        "brand vehicle_model model_year price_currency offer_count minimum_price_amount median_price_amount "
        "maximum_price_amount",
    ),
]
UNIQUE_CHECKS = [
    ("dim__offers", "offer_key"),
    ("agg__daily_offer_observations", "observation_date"),
    ("rpt__marketplace_overview", "observation_date"),
    ("rpt__mileage_vs_price", "offer_key"),
    ("fct__offer_observations", "offer_key"),
]

OBS_LIST = (
    "source_offer_id, url, title, brand, model, year, mileage_km, fuel_type, transmission, price_amount, "
    "price_currency, observed_at, scrape_run_id"
)
UNION = "\nUNION ALL\n"

# Per query: the CTEs it reads and its select.
SELECTS: dict[str, tuple[list[str], str]] = {
    "s3_page_json": (
        ["parts"],
        """
        SELECT source_offer_id AS page_id, observed_at, scrape_run_id,
               CASE WHEN shape <> 0 THEN page_json END AS page_json FROM parts
        UNION ALL SELECT concat('page-', CAST(page_id AS VARCHAR)), NULL, 'run-pages', NULL FROM pages""",
    ),
    "s4_s5_offers": (["parts"], f"SELECT {OBS_LIST} FROM parts WHERE {PAGE_REASON} IS NULL"),
    "s6_rejects": (
        ["parts"],
        f"""
        SELECT source_offer_id AS page_id, observed_at, scrape_run_id, {PAGE_REASON} AS reject_reason
        FROM parts WHERE {PAGE_REASON} IS NOT NULL
        UNION ALL SELECT concat('page-', CAST(page_id AS VARCHAR)), NULL, 'run-pages', 'no_page_json' FROM pages""",
    ),
    "s7_typed_node": (
        ["listed"],
        """
        SELECT target, page, found,
               CASE WHEN found AND page % 13 <> 0 THEN page * 7 % 100 END AS total_count,
               CAST(CASE WHEN found AND page % 29 <> 0 THEN count(*) + CASE WHEN page % 7 = 0 THEN 5 ELSE 0 END END AS INT) AS edge_count
        FROM listed GROUP BY target, page, found""",
    ),
    "s8_urls": (["urls"], "SELECT * FROM urls"),
    "s8_edge_rejects": (
        ["listed"],
        """
        SELECT target, page, CAST(last + step AS INT) AS edge_pos, 'bad_edge' AS reject_reason
        FROM (SELECT target, page, max(pos) AS last FROM listed
              WHERE found AND page % 29 <> 0 AND page % 7 = 0 GROUP BY target, page) l, (VALUES (1), (2), (3), (4)) s(step)
        UNION ALL
        SELECT DISTINCT target, page, CAST(NULL AS INT), 'bad_edges' FROM listed WHERE found AND page % 29 = 0""",
    ),
    "s9_pages": (
        ["sized"],
        f"""
        SELECT target, listing_page, page_count, unnest(generate_series(1, greatest(page_count, 1))) AS page
        FROM (SELECT *, (total + size - 1) // size AS page_count FROM sized WHERE {PAGES_REASON} IS NULL) s""",
    ),
    "s9_page_rejects": (
        ["sized"],
        f"SELECT target, listing_page, {PAGES_REASON} AS reject_reason FROM sized WHERE {PAGES_REASON} IS NOT NULL",
    ),
    "s10_first_seen": (
        ["urls"],
        """
        SELECT url, target, page, edge_pos
        FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY target, page, edge_pos) AS n FROM urls) u
        WHERE n = 1""",
    ),
    "s11_rates": (
        ["payloads"],
        f"""
        SELECT effective_date, upper(base_currency) AS base_currency, 'PLN' AS quote_currency, rate_to_pln,
               'NBP' AS provider, source_table, fetched_at
        FROM payloads WHERE {RATE_REASON} IS NULL""",
    ),
    "s12_rate_rejects": (
        ["payloads"],
        f"""
        SELECT CASE WHEN shape = 6 THEN 'CHF' ELSE lower(base_currency) END AS requested_currency, fetched_at,
               {RATE_REASON} AS reject_reason
        FROM payloads WHERE {RATE_REASON} IS NOT NULL""",
    ),
    "s13_run": (["obs"], f"SELECT * FROM obs WHERE scrape_run_id = '{ONE_RUN}'"),
    "k3_compact": (
        ["rates"],
        """
        SELECT effective_date, base_currency, quote_currency, rate_to_pln, provider, source_table, fetched_at
        FROM (SELECT *, row_number() OVER (PARTITION BY effective_date, base_currency, quote_currency, provider
                                           ORDER BY fetched_at DESC) AS n FROM rates) r
        WHERE n = 1""",
    ),
    "l1_runs": (["obs"], "SELECT DISTINCT scrape_run_id FROM obs ORDER BY scrape_run_id"),
    "l2_pending": (["pending"], "SELECT DISTINCT scrape_run_id FROM pending"),
    "l3_pending_rows": (["pending"], f"SELECT {OBS_LIST} FROM pending"),
    "l3_manifest": (
        ["pending"],
        "SELECT scrape_run_id, CAST(CAST(source_offer_id AS BIGINT) % 10 AS VARCHAR) AS batch, count(*) AS rows FROM pending GROUP BY ALL",
    ),
    "s1_k2_live_months": (
        ["obs"],
        "SELECT strftime(observed_at, '%Y%m') AS observed_month, scrape_run_id, count(*) AS stored_rows FROM obs"
        f" WHERE strftime(observed_at, '%Y%m') >= '{MERGED_BEFORE}' OR month(observed_at) = 6 GROUP BY ALL",
    ),
    "l4_ledger": (["pending"], "SELECT scrape_run_id, count(*) AS rows_loaded FROM pending GROUP BY scrape_run_id"),
    "l5_total": (["pending"], "SELECT count(*) AS rows_loaded FROM pending"),
    "t1_stg_obs": (["obs"], f"SELECT {OBS_LIST} FROM obs"),
    "t3_stg_rates": (["stg_rates"], "SELECT * FROM stg_rates"),
    "t4_latest": (["latest"], "SELECT * FROM latest"),
    "t5_t7_normalized": (["norm"], "SELECT * FROM norm"),
    "m1_fct": (["fct"], "SELECT * FROM fct"),
    "m2_latest": (["newest"], f"SELECT {OBS_LIST} FROM newest"),
    "m3_history": (["history"], "SELECT * FROM history"),
    "m4_dim": (["dim"], "SELECT * FROM dim"),
    "m5_daily": (["daily"], "SELECT * FROM daily"),
    "m6_brand": (["by_brand"], "SELECT * FROM by_brand"),
    "m7_fuel": (["by_fuel"], "SELECT * FROM by_fuel"),
    "r1_brand_share": (["inventory"], "SELECT * FROM inventory ORDER BY total_offers DESC, brand"),
    "r2_fuel_share": (["fuel"], "SELECT * FROM fuel"),
    "r4_new_by_day": (["new_by_day"], "SELECT * FROM new_by_day"),
    "r8_overview": (["overview"], "SELECT * FROM overview"),
    "r9_mileage": (["mileage"], "SELECT * FROM mileage"),
    "r10_distribution": (["distribution"], "SELECT * FROM distribution"),
    "k6_fct": (["fct"], "SELECT * FROM fct"),
    "k6_brand": (["inventory"], "SELECT * FROM inventory ORDER BY total_offers DESC, brand"),
    "k6_fuel": (["fuel"], "SELECT * FROM fuel ORDER BY total_offers DESC, fuel_type"),
    "k6_overview": (["overview"], "SELECT * FROM overview ORDER BY observation_date"),
    "k6_mileage": (["mileage"], "SELECT * FROM mileage"),
    "k6_distribution": (["distribution"], "SELECT * FROM distribution"),
    "q1_overview": (["overview"], "SELECT * FROM overview ORDER BY observation_date"),
    "q2_metrics": (
        ["overview"],
        """
        SELECT current_offer_count, average_price_amount, observation_count, distinct_offer_count, new_offer_count,
               observation_date
        FROM overview ORDER BY observation_date DESC LIMIT 1""",
    ),
    "q3_brands": (["inventory"], "SELECT * FROM inventory ORDER BY total_offers DESC, brand"),
    "q4_top_brands": (["inventory"], "SELECT * FROM inventory ORDER BY total_offers DESC, brand LIMIT 10"),
    "q5_fuels": (["fuel"], "SELECT * FROM fuel ORDER BY total_offers DESC, fuel_type"),
    "q6_latest_offers": (["latest_offers"], "SELECT * FROM latest_offers"),
    "q7_bands": (
        ["latest_offers"],
        """
        SELECT brand, CAST(floor(mileage_km / 25000.0) * 25000 + 12500 AS INTEGER) AS mileage_band_midpoint,
               median(price_amount) AS median_price_amount, count(*) AS offer_count
        FROM latest_offers
        GROUP BY brand, CAST(floor(mileage_km / 25000.0) * 25000 + 12500 AS INTEGER)""",
    ),
    "q8_vehicles": (
        ["distribution"],
        """
        SELECT * FROM distribution
        ORDER BY offer_count DESC, median_price_amount DESC, brand, vehicle_model, model_year, price_currency
        LIMIT 15""",
    ),
    "d1_latest": (
        ["ranked"],
        """
        SELECT CAST(rank AS INT) AS rank, title, brand, model, year, mileage_km, price_amount, price_currency, url,
               observed_at
        FROM ranked WHERE rank <= 10""",
    ),
    "d2_latest_in_run": (
        ["ranked_in_run"],
        """
        SELECT scrape_run_id, CAST(rank AS INT) AS rank, title, brand, model, year, mileage_km, price_amount,
               price_currency, url
        FROM ranked_in_run WHERE rank <= 10""",
    ),
    "d3_digest": (
        ["ranked"],
        f"""
        SELECT concat('Top 10 latest offers', chr(10), string_agg(line, chr(10) ORDER BY rank)) AS message
        FROM (SELECT rank, line, 20 + sum(length(line) + 1) OVER (ORDER BY rank) AS total
              FROM (SELECT rank, {LATEST_LINE} AS line FROM ranked WHERE rank <= 10) l) t
        WHERE total <= 2000""",
    ),
    "d4_digest": (
        ["ranked_in_run"],
        f"""
        SELECT r.scrape_run_id,
               concat('✅ Scraper completed', chr(10), 'Scrape run: `', r.scrape_run_id, '`', chr(10),
                      'Rows loaded into the warehouse: ', CAST(n AS VARCHAR), chr(10),
                      'Duration: ', printf('%.1f', n * CAST(0.5 AS DOUBLE)), 's', chr(10), chr(10), 'Latest offers:', chr(10), lines) AS message
        FROM (SELECT scrape_run_id, count(*) AS n FROM obs GROUP BY scrape_run_id) r
        JOIN (SELECT scrape_run_id, string_agg(line, chr(10) ORDER BY rank) AS lines
              FROM (SELECT scrape_run_id, rank, {RUN_LINE} AS line FROM ranked_in_run WHERE rank <= 10) l
              GROUP BY scrape_run_id) d ON r.scrape_run_id = d.scrape_run_id""",
    ),
    "c1_not_null": (
        list(SOURCES.values()),
        UNION.join(
            _not_null(model, SOURCES[model], column) for model, columns in NOT_NULL_CHECKS for column in columns.split()
        ),
    ),
    "c2_unique": (
        ["dim", "daily", "overview", "mileage", "fct"],
        UNION.join(_unique(model, SOURCES[model], column) for model, column in UNIQUE_CHECKS),
    ),
    "c3_accepted": (
        ["obs", "stg_rates"],
        UNION.join(
            [
                _accepted("stg__currency_rates", "stg_rates", "price_currency", "'EUR', 'USD'"),
                _accepted("stg__currency_rates", "stg_rates", "quote_currency", "'PLN'"),
                _accepted("offers_observations", "obs", "price_currency", "'EUR', 'PLN'"),
            ]
        ),
    ),
    "c4_relationships": (["fct", "dim", "mileage"], UNION.join([_orphans("dim"), _orphans("mileage")])),
}


def _with(names: list[str]) -> str:
    needed: list[str] = []

    def add(name: str) -> None:
        for parent in CTES[name][0]:
            add(parent)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name][1]})" for name in needed)


def oracle_sql() -> dict[str, str]:
    return {name: f"{_with(ctes)}\n{select.strip()}" for name, (ctes, select) in SELECTS.items()}
