"""DuckDB SQL for the keys of registry.QUERIES, over the same tables."""

from __future__ import annotations

from adlake.plans.registry import AS_OF, SOLD_AT

ADS = """ads AS (
SELECT CAST(o_orderkey AS VARCHAR) AS id_ad, p_brand AS make_name, p_name AS model_name, p_type AS version,
  CASE WHEN p_size % 4 <> 0 THEN 'Mk ' || CAST(p_size % 4 AS VARCHAR) END AS generation, CAST(900 + p_size * 40 AS INTEGER) AS engine_capacity, CAST(60 + p_size * 3 AS INTEGER) AS engine_power,
  CASE WHEN o_orderkey % 7 <> 0 THEN 'shade ' || CAST(o_custkey % 9 AS VARCHAR) END AS color, CASE WHEN o_custkey % 5 = 0 THEN 'all-wheels' ELSE 'front-wheels' END AS transmission,
  'https://ad.invalid/' || CAST(o_orderkey AS VARCHAR) AS url_ad,
  CASE WHEN o_orderkey % 13 <> 0 THEN CAST(1985 + o_orderkey % 40 AS INTEGER) END AS year,
  CASE WHEN p_brand IS NOT NULL THEN concat_ws(' ', p_brand, p_name, p_type) END AS title,
  n_name AS city, CASE WHEN o_orderkey % 23 <> 0 THEN r_name END AS region,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 0 ELSE CAST(floor(o_totalprice / 4) AS INTEGER) END AS price,
  'PLN' AS currency_code, c_mktsegment AS fuel_type, o_orderpriority AS gearbox, CAST(o_custkey * 137 % 250000 AS INTEGER) AS mileage,
  CAST(o_orderdate AS TIMESTAMP) AS created_at, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 30 DAY END AS sold_at,
  'src' || CAST(o_custkey % 3 AS VARCHAR) AS source_name
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS pk FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
  LEFT JOIN part ON pk = p_partkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

MSG = """msg AS (
SELECT event_id AS "offset", CAST(ts AS TIMESTAMP) AS scraped_at, CAST(user_id AS VARCHAR) AS id_ad, 'src' || CAST(user_id % 3 AS VARCHAR) AS source_name, event_type AS make_str,
  CASE WHEN event_id % 29 <> 0 THEN CAST(floor(value / 10) AS INTEGER) END AS price, props FROM events)"""

HIST = """hist AS (
SELECT id_ad AS auto_ad_id, created_at AS timestamp, price, currency_code, 'active' AS status FROM ads
UNION ALL SELECT id_ad, sold_at, price, currency_code, 'sold' FROM ads WHERE sold_at IS NOT NULL)"""

LOG = """log AS (
SELECT id_ad, "offset", price, CASE WHEN n = 1 THEN 'active' WHEN price IS DISTINCT FROM before THEN 'price_changed' END AS status
FROM (SELECT *, row_number() OVER w AS n, lag(price) OVER w AS before FROM msg WINDOW w AS (PARTITION BY id_ad ORDER BY "offset")))"""

STATE = """state AS (
SELECT l.id_ad, f.source_name, l.make_str AS make_name, l.price, 'PLN' AS currency_code, l.scraped_at AS created_at
FROM (SELECT * FROM msg QUALIFY row_number() OVER (PARTITION BY id_ad ORDER BY "offset" DESC) = 1) l
JOIN (SELECT * FROM msg QUALIFY row_number() OVER (PARTITION BY id_ad ORDER BY "offset") = 1) f USING (id_ad))"""

SNAP = """snap AS (SELECT DISTINCT source_name, id_ad FROM msg WHERE scraped_at > (SELECT max(scraped_at) FROM msg) - INTERVAL 12 HOUR),
gone AS (SELECT source_name, id_ad FROM state WHERE source_name IN (SELECT source_name FROM snap) AND (source_name, id_ad) NOT IN (SELECT source_name, id_ad FROM snap))"""

CARD = """id_ad, title, make_name, model_name, version, generation, year, price, currency_code AS "currencyCode", fuel_type, gearbox, mileage, engine_capacity, color, transmission, engine_power,
city, region, url_ad, created_at AS "createdAt", source_name, sold_at"""
SOME = "make_name ILIKE '%brand#1%' AND price >= 5000 AND price <= 100000 AND sold_at IS NULL"
SHORT = "id_ad, make_name, year, price, mileage, source_name"
RAW = """raw AS (SELECT "offset", CASE WHEN "offset" % 13 <> 0 THEN id_ad END AS source_ad_id, CASE WHEN "offset" % 11 <> 0 THEN 'https://ad.invalid/' || CAST("offset" AS VARCHAR) END AS url,
source_name, make_str, CASE WHEN "offset" % 7 = 0 THEN 'n/a' ELSE CAST(price AS VARCHAR) END AS price FROM msg)"""


def _of(*parts: str) -> str:
    return "WITH " + ", ".join(parts[:-1]) + " " + parts[-1]


def _rounded(x: str) -> str:
    return f"coalesce(round_even({x}, 2), 0.0)"


def _trend(part: str, days: int) -> str:
    return _of(ADS, f"SELECT CAST(date_trunc('{part}', created_at) AS TIMESTAMP) AS period, count(*) AS count, {_rounded('avg(price)')} AS avg_price FROM ads WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL {days} DAY AND price > 0 GROUP BY 1 ORDER BY 1")


def _priced(keys: str, where: str) -> str:
    return _of(ADS, f"SELECT {keys}, count(*) AS count, {_rounded('avg(price)')} AS avg_price, min(price) AS min_price, max(price) AS max_price FROM ads WHERE {where} AND price > 0 GROUP BY {keys} ORDER BY count DESC, {keys} LIMIT 10")


_SLUG = "replace(lower(make_name), ' ', '-')"
_MODEL = f"{_SLUG} || '-' || replace(lower(model_name), ' ', '-')"
_MAKES = f"SELECT {_SLUG} AS slug, min_by(make_name, id_ad) AS name FROM ads WHERE make_name <> '' GROUP BY 1"
_MODELS = f"SELECT {_MODEL} AS slug, min_by(model_name, id_ad) AS name, min_by({_SLUG}, id_ad) AS make_slug FROM ads WHERE make_name <> '' AND model_name <> '' GROUP BY 1"

#: Response bodies as the engine derives them: bad ones stand beside every tenth and seventh page.
_PAGES = "pages AS (SELECT DISTINCT CAST(floor(CAST(id_ad AS BIGINT) / 50) AS BIGINT) AS page FROM ads)"
_CELL = "SELECT '{section}' AS section, CAST({pos} AS BIGINT) AS pos, '{field}' AS field, {number} AS number, {text} AS text FROM {table}"


def _cells(section: str, table: str, pos: str, numbers: str, texts: str = "") -> str:
    rows = [_CELL.format(section=section, pos=pos, field=c, number=f"CAST({c} AS DOUBLE)", text="CAST(NULL AS VARCHAR)", table=table) for c in numbers.split()]
    rows += [_CELL.format(section=section, pos=pos, field=c, number="CAST(NULL AS DOUBLE)", text=f"CAST({c} AS VARCHAR)", table=table) for c in texts.split()]
    return " UNION ALL ".join(rows)


def _encoded(x: str) -> str:
    """Percent-encoding as Java writes it, blanks as %20: like RFC 3986, but '*' stays and '~' goes."""
    return f"replace(replace(url_encode({x}), '%2A', '*'), '~', '%7E')"


_SOLD = _of(MSG, STATE, SNAP, f"SELECT id_ad, source_name, price, CASE WHEN (source_name, id_ad) IN (SELECT source_name, id_ad FROM gone) THEN TIMESTAMP '{SOLD_AT}' END AS sold_at FROM state")

ORACLES = {
    "active_ids_snapshot": _of(MSG, "SELECT DISTINCT source_name, make_str, id_ad FROM msg"),
    "ad_clustered": _of(ADS, f"SELECT {CARD} FROM ads WHERE id_ad = '1'"),
    "ads_search_indexed": _of(ADS, f"SELECT {CARD} FROM ads WHERE title ILIKE '%ring%' ORDER BY created_at DESC NULLS FIRST, id_ad LIMIT 20"),
    "flt_range_clustered": _of(ADS, f"SELECT {SHORT} FROM ads WHERE year >= 1995 AND year <= 2010 AND mileage <= 100000"),
    "ad_detail": _of(ADS, HIST, f"""SELECT c.*, h.timestamp AS history_timestamp, h.price AS history_price, h.currency_code AS "history_currencyCode", h.status AS history_status FROM (SELECT {CARD} FROM ads) c LEFT JOIN hist h ON auto_ad_id = id_ad WHERE id_ad = '1'"""),
    "ad_history": _of(ADS, HIST, "SELECT * FROM hist WHERE auto_ad_id = '1' ORDER BY timestamp DESC, status"),
    "ads_list_filtered": _of(ADS, f"SELECT {CARD} FROM ads WHERE {SOME} ORDER BY price ASC NULLS LAST, id_ad LIMIT 20"),
    "ads_page_2": _of(ADS, f"SELECT {CARD} FROM ads ORDER BY created_at DESC NULLS FIRST, id_ad LIMIT 20 OFFSET 20"),
    "ads_page_deep": _of(ADS, f"SELECT {CARD} FROM ads ORDER BY created_at DESC NULLS FIRST, id_ad LIMIT 20 OFFSET 10380"),
    "ads_page_meta": _of(ADS, f"SELECT count(*) AS total, CAST(1 AS BIGINT) AS page, CAST(20 AS BIGINT) AS page_size, CAST(ceil(count(*) / 20) AS BIGINT) AS total_pages FROM ads WHERE {SOME}"),
    "ads_search": _of(ADS, f"SELECT {CARD} FROM ads WHERE title ILIKE '%ring%' ORDER BY created_at DESC NULLS FIRST, id_ad LIMIT 20"),
    "ads_with_dims": _of(ADS, f"mk AS ({_MAKES})", f"md AS ({_MODELS})", f"SELECT id_ad, {_SLUG} AS make_slug, mk.name AS make_dim, {_MODEL} AS model_slug, md.name AS model_dim FROM ads LEFT JOIN mk ON mk.slug = {_SLUG} LEFT JOIN md ON md.slug = {_MODEL}"),
    "crawl_page_plan": _of(ADS, "SELECT make, CAST(unnest(range(1, CAST(ceil(total / 50) AS BIGINT) + 1)) AS INTEGER) AS page FROM (SELECT lower(make_name) AS make, count(*) AS total FROM ads WHERE make_name IS NOT NULL GROUP BY 1)"),
    "crawl_urls": _of(
        ADS,
        "plan AS (SELECT make, CAST(unnest(range(1, CAST(ceil(total / 50) AS BIGINT) + 1)) AS INTEGER) AS page FROM (SELECT lower(make_name) AS make, count(*) AS total FROM ads WHERE make_name IS NOT NULL GROUP BY 1))",
        "vars AS (SELECT *, '{\"filters\":[{\"name\":\"category\",\"value\":\"29\"},{\"name\":\"filter_enum_make\",\"value\":' || CAST(to_json(make) AS VARCHAR) || '}],\"page\":' || CAST(page AS VARCHAR) || ',\"itemsPerPage\":50}' AS v FROM plan)",
        f"SELECT make, page, 'https://source.invalid/graphql?operationName=listingScreen&variables=' || {_encoded('v')} || '&extensions=' || {_encoded(chr(39) + '{' + chr(34) + 'persistedQuery' + chr(34) + ':{' + chr(34) + 'version' + chr(34) + ':1,' + chr(34) + 'sha256Hash' + chr(34) + ':' + chr(34) + '0' * 64 + chr(34) + '}}' + chr(39))} AS url FROM vars",
    ),
    "dashboard_body": _of(
        ADS,
        f"g AS (SELECT count(*) AS total_ads, count(*) FILTER (sold_at IS NULL) AS active_ads, count(sold_at) AS sold_ads, {_rounded('avg(price) FILTER (price > 0)')} AS avg_price, coalesce(median(price) FILTER (price > 0), 0.0) AS median_price, {_rounded('avg(mileage) FILTER (mileage > 0)')} AS avg_mileage, coalesce((SELECT make_name FROM ads WHERE make_name IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, make_name LIMIT 1), 'N/A') AS most_popular_make, coalesce((SELECT make_name || ' ' || model_name FROM ads WHERE make_name IS NOT NULL AND model_name IS NOT NULL GROUP BY make_name, model_name ORDER BY count(*) DESC, make_name, model_name LIMIT 1), 'N/A') AS most_popular_model FROM ads)",
        f"m AS (SELECT make_name, count(*) AS count, {_rounded('avg(price)')} AS avg_price, min(price) AS min_price, max(price) AS max_price, row_number() OVER (ORDER BY count(*) DESC, make_name) - 1 AS pos FROM ads WHERE make_name IS NOT NULL AND price > 0 GROUP BY 1 ORDER BY pos LIMIT 5)",
        f"r AS (SELECT region, count(*) AS count, {_rounded('avg(price)')} AS avg_price, row_number() OVER (ORDER BY count(*) DESC, region) - 1 AS pos FROM ads WHERE region IS NOT NULL AND price > 0 GROUP BY 1 ORDER BY pos LIMIT 5)",
        f"t AS (SELECT CAST(date_trunc('day', created_at) AS TIMESTAMP) AS period, count(*) AS count, {_rounded('avg(price)')} AS avg_price, row_number() OVER (ORDER BY CAST(date_trunc('day', created_at) AS TIMESTAMP)) - 1 AS pos FROM ads WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AND price > 0 GROUP BY 1)",
        "s AS (SELECT total_ads, active_ads, avg_price, most_popular_make, (SELECT count(DISTINCT make_name) FROM m) AS data_sources FROM g)",
        " UNION ALL ".join(
            [
                _cells("general", "g", "0", "total_ads active_ads sold_ads avg_price median_price avg_mileage", "most_popular_make most_popular_model"),
                _cells("top_makes", "m", "pos", "count avg_price min_price max_price", "make_name"), _cells("top_regions", "r", "pos", "count avg_price", "region"),
                _cells("recent_trends", "t", "pos", "count avg_price", "period"), _cells("summary", "s", "0", "total_ads active_ads avg_price data_sources", "most_popular_make"),
            ]
        ),
    ),
    "dashboard_summary": _of(
        ADS,
        "top AS (SELECT make_name FROM ads WHERE make_name IS NOT NULL AND price > 0 GROUP BY 1 ORDER BY count(*) DESC, make_name LIMIT 5)",
        f"SELECT count(*) AS total_ads, count(*) FILTER (sold_at IS NULL) AS active_ads, {_rounded('avg(price) FILTER (price > 0)')} AS avg_price, (SELECT make_name FROM ads WHERE make_name IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, make_name LIMIT 1) AS most_popular_make, (SELECT count(DISTINCT make_name) FROM top) AS data_sources FROM ads",
    ),
    "digit_guard": _of(MSG, "SELECT \"offset\" AS event_id, CASE WHEN regexp_full_match(x, '[0-9]+') THEN TRY_CAST(x AS INTEGER) END AS plain, CAST(NULL AS INTEGER) AS with_newline, CAST(NULL AS INTEGER) AS with_space FROM (SELECT *, json_extract_string(props, '$.k') AS x FROM msg)"),
    "dim_make": _of(ADS, _MAKES),
    "dim_model": _of(ADS, _MODELS),
    "filter_options": _of(
        ADS,
        "SELECT DISTINCT 'fuel_types' AS facet, fuel_type AS value FROM ads WHERE fuel_type <> '' UNION ALL SELECT DISTINCT 'gearboxes', gearbox FROM ads WHERE gearbox <> '' UNION ALL SELECT DISTINCT 'regions', region FROM ads WHERE region <> '' UNION ALL SELECT DISTINCT 'sources', source_name FROM ads WHERE source_name <> '' UNION ALL (SELECT DISTINCT 'cities', city FROM ads WHERE city <> '' ORDER BY city LIMIT 50)",
    ),
    "filter_ranges": _of(ADS, "SELECT coalesce(min(price) FILTER (price > 0), 0) AS min_price, coalesce(max(price) FILTER (price > 0), 0) AS max_price, coalesce(min(year), 1990) AS min_year, coalesce(max(year), 2024) AS max_year FROM ads"),
    "flt_ilike": _of(ADS, f"SELECT {SHORT} FROM ads WHERE make_name ILIKE '%brand#1%' AND city ILIKE '%nation_1%'"),
    "flt_range": _of(ADS, f"SELECT {SHORT} FROM ads WHERE year >= 1995 AND year <= 2010 AND mileage <= 100000"),
    "flt_sold": _of(ADS, f"SELECT {SHORT} FROM ads WHERE sold_at IS NOT NULL"),
    "flt_source": _of(ADS, f"SELECT {SHORT} FROM ads WHERE source_name = 'src1'"),
    "graphql_flatten": _of(
        ADS,
        """SELECT id_ad AS source_ad_id, url_ad AS url, 'otomoto.pl' AS source_name, 'PL' AS country_code, title, CAST(NULL AS VARCHAR) AS description, strftime(created_at, '%Y-%m-%dT%H:%M:%S') AS posted_on_source_at,
        CAST(price AS VARCHAR) AS price, 'PLN' AS currency, make_name AS make_str, model_name AS model_str, version AS version_str, CAST(NULL AS VARCHAR) AS generation_str, year, mileage, fuel_type AS fuel_type_str,
        CAST(NULL AS INTEGER) AS engine_capacity_cm3, CAST(NULL AS INTEGER) AS engine_power_hp, gearbox AS gearbox_str, CAST(NULL AS VARCHAR) AS transmission_str, CAST(NULL AS VARCHAR) AS color_str,
        city AS city_str, region AS region_str, CAST(NULL AS VARCHAR) AS seller_link, CASE WHEN CAST(id_ad AS BIGINT) % 4 = 1 THEN '["https://photo.invalid/' || id_ad || '"]' ELSE '[]' END AS image_urls FROM ads""",
    ),
    "ingest_by_make": _of(ADS, "SELECT make_name AS make_str, count(*) AS items, count(price) AS priced, count(price) / count(*) AS share FROM ads GROUP BY 1"),
    "ingest_metrics": _of(ADS, _PAGES, "SELECT CAST(count(*) + count(*) FILTER (page % 10 = 9) + count(*) FILTER (page % 7 = 3) AS BIGINT) AS pages, count(*) FILTER (page % 10 = 9) AS errors, count(*) FILTER (page % 7 = 3) AS retries, (SELECT count(*) FROM ads) AS items FROM pages"),
    "kafka_envelope": _of(
        MSG,
        """SELECT id_ad AS key, '{"offset":' || CAST("offset" AS VARCHAR) || ',"scraped_at":"' || strftime(scraped_at, '%Y-%m-%dT%H:%M:%S.%g') || '","source_ad_id":' || CAST(to_json(id_ad) AS VARCHAR) || ',"source_name":' || CAST(to_json(source_name) AS VARCHAR)
        || ',"make_str":' || CAST(to_json(make_str) AS VARCHAR) || coalesce(',"price":' || CAST(price AS VARCHAR), '') || ',"props":' || CAST(to_json(props) AS VARCHAR) || '}' AS value FROM msg""",
    ),
    "make_catalogue": _of(
        ADS,
        "names AS (SELECT DISTINCT lower(make_name) AS name FROM ads WHERE make_name IS NOT NULL UNION SELECT DISTINCT lower(city) FROM ads WHERE city IS NOT NULL)",
        f"known AS (SELECT DISTINCT regexp_replace({_SLUG}, '[^\\w-]', '', 'g') AS slug FROM ads WHERE make_name <> '')",
        "entries AS (SELECT regexp_replace(regexp_replace(lower(trim(name)), '[\\s-]+', '-', 'g'), '[^\\w-]', '', 'g') AS slug, min(name) AS name FROM names GROUP BY 1)",
        "SELECT slug, name, CASE WHEN slug IN (SELECT slug FROM known) THEN 'skipped' ELSE 'added' END AS action FROM entries",
    ),
    "make_loader": _of(ADS, "SELECT DISTINCT lower(trim(make_name)) AS make FROM (SELECT DISTINCT make_name FROM ads WHERE length(trim(make_name)) > 0 ORDER BY make_name LIMIT 1000)"),
    "make_stats": _priced("make_name", "make_name IS NOT NULL"),
    "makes_list": _of(ADS, "SELECT DISTINCT make_name FROM ads WHERE make_name <> ''"),
    "message_project": _of(MSG, RAW, "SELECT \"offset\", source_ad_id AS id_ad, url AS url_ad, source_name, CAST(TRY_CAST(price AS DOUBLE) AS INTEGER) AS price, make_str AS make_name FROM raw WHERE source_ad_id IS NOT NULL AND url IS NOT NULL"),
    "message_route": _of(MSG, "SELECT CASE make_str WHEN 'signup' THEN 'active_car_ids' ELSE 'parsed_car_ads' END AS topic, count(*) AS n FROM msg WHERE make_str <> 'error' GROUP BY 1"),
    "message_validation": _of(MSG, RAW, "SELECT \"offset\", source_ad_id IS NOT NULL AND url IS NOT NULL AS valid, concat_ws(',', CASE WHEN source_ad_id IS NULL THEN 'source_ad_id' END, CASE WHEN url IS NULL THEN 'url' END) AS reason, TRY_CAST(price AS DOUBLE) AS price FROM raw"),
    "model_stats": _priced("make_name, model_name", "make_name IS NOT NULL AND model_name IS NOT NULL"),
    "models_by_make": _of(ADS, "SELECT DISTINCT model_name FROM ads WHERE make_name ILIKE '%Brand#1%' AND model_name <> ''"),
    "params_map": _of(MSG, """SELECT "offset", '{' || concat_ws(',', '"price":"' || CAST(price AS VARCHAR) || '"', '"make":' || CAST(to_json(upper(make_str)) AS VARCHAR)) || '}' AS params FROM msg"""),
    "popular_make": _of(ADS, "SELECT make_name, count(*) AS count FROM ads WHERE make_name IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"),
    "popular_model": _of(ADS, "SELECT make_name || ' ' || model_name AS model, count(*) AS count FROM ads WHERE make_name IS NOT NULL AND model_name IS NOT NULL GROUP BY make_name, model_name ORDER BY count DESC, make_name, model_name LIMIT 1"),
    "price_distribution": _of(ADS, "SELECT CASE WHEN price < 5000 THEN '0-5K' WHEN price < 10000 THEN '5K-10K' WHEN price < 20000 THEN '10K-20K' WHEN price < 30000 THEN '20K-30K' WHEN price < 50000 THEN '30K-50K' WHEN price < 100000 THEN '50K-100K' ELSE '100K+' END AS price_range, count(*) AS count FROM ads WHERE price > 0 GROUP BY 1"),
    "price_history": _of(MSG, LOG, 'SELECT id_ad, "offset", price, status FROM log WHERE status IS NOT NULL'),
    "region_stats": _of(ADS, f"SELECT region, count(*) AS count, {_rounded('avg(price)')} AS avg_price FROM ads WHERE region IS NOT NULL AND price > 0 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    "result_counts": _of(
        ADS,
        "SELECT 'search' AS endpoint, 'ring' AS argument, least(count(*), 20) AS count FROM ads WHERE title ILIKE '%ring%' UNION ALL SELECT 'makes', '', count(DISTINCT make_name) FROM ads WHERE make_name <> '' UNION ALL SELECT 'models', 'Brand#1', count(DISTINCT model_name) FROM ads WHERE make_name ILIKE '%Brand#1%' AND model_name <> ''",
    ),
    "sold_history": _of(MSG, STATE, SNAP, f"SELECT id_ad AS auto_ad_id, TIMESTAMP '{SOLD_AT}' AS timestamp, price, currency_code, 'sold' AS status FROM state JOIN gone USING (source_name, id_ad)"),
    "sold_ids": _of(MSG, STATE, SNAP, "SELECT source_name, id_ad FROM gone"),
    "sold_probe": _of(MSG, STATE, SNAP, f"SELECT id_ad, TIMESTAMP '{SOLD_AT}' AS sold_at, source_name, make_name FROM state WHERE id_ad IN (SELECT id_ad FROM gone ORDER BY id_ad LIMIT 10)"),
    "sold_reconcile": _of(
        MSG, STATE, SNAP,
        "a AS (SELECT source_name, count(*) AS active FROM snap GROUP BY 1)", "b AS (SELECT source_name, count(*) AS in_db FROM state GROUP BY 1)", "c AS (SELECT source_name, count(*) AS n FROM gone GROUP BY 1)",
        "SELECT source_name, active, coalesce(in_db, 0) AS in_db, coalesce(n, 0) AS deactivated, active - (coalesce(in_db, 0) - coalesce(n, 0)) AS new FROM a LEFT JOIN b USING (source_name) LEFT JOIN c USING (source_name)",
    ),
    "sold_state": _SOLD,
    "stats_general": _of(ADS, f"SELECT count(*) AS total_ads, count(*) FILTER (sold_at IS NULL) AS active_ads, count(sold_at) AS sold_ads, {_rounded('avg(price) FILTER (price > 0)')} AS avg_price, coalesce(median(price) FILTER (price > 0), 0.0) AS median_price, {_rounded('avg(mileage) FILTER (mileage > 0)')} AS avg_mileage FROM ads"),
    "table_counts": _of(ADS, MSG, LOG, f"SELECT 'auto_ad' AS table_name, count(*) AS rows FROM ads UNION ALL SELECT 'auto_ad_history', count(status) FROM log UNION ALL SELECT 'car_make', count(*) FROM ({_MAKES}) UNION ALL SELECT 'car_model', count(*) FROM ({_MODELS})"),
    "trends_daily": _trend("day", 30),
    "trends_iso": f"SELECT strftime(period, '%Y-%m-%dT%H:%M:%S') AS date, count, avg_price FROM ({_trend('day', 30)})",
    "trends_monthly": _trend("month", 365),
    "trends_weekly": _trend("week", 180),
    "stream_completion": _of(MSG, "SELECT DISTINCT source_name, make_str, id_ad FROM msg"),
    "stream_history": _of(MSG, LOG, 'SELECT id_ad, "offset", price, status FROM log WHERE status IS NOT NULL'),
    "stream_make_stats": _of(MSG, STATE, f"SELECT make_name, count(*) AS count, {_rounded('avg(price)')} AS avg_price, min(price) AS min_price, max(price) AS max_price FROM state WHERE make_name IS NOT NULL AND price > 0 GROUP BY 1 ORDER BY count DESC, make_name LIMIT 10"),
    "stream_price_distribution": _of(MSG, STATE, "SELECT CASE WHEN price < 5000 THEN '0-5K' WHEN price < 10000 THEN '5K-10K' WHEN price < 20000 THEN '10K-20K' WHEN price < 30000 THEN '20K-30K' WHEN price < 50000 THEN '30K-50K' WHEN price < 100000 THEN '50K-100K' ELSE '100K+' END AS price_range, count(*) AS count FROM state WHERE price > 0 GROUP BY 1"),
    "stream_rejects": _of(MSG, RAW, "SELECT \"offset\", source_ad_id, url, concat_ws(',', CASE WHEN source_ad_id IS NULL THEN 'source_ad_id' END, CASE WHEN url IS NULL THEN 'url' END) AS reason, TRY_CAST(price AS DOUBLE) AS price FROM raw WHERE source_ad_id IS NULL OR url IS NULL"),
    "stream_sold": _SOLD,
    "stream_upsert": _of(MSG, STATE, "SELECT * FROM state"),
    "upsert_state": _of(MSG, STATE, "SELECT * FROM state"),
    "year_distribution": _of(ADS, "SELECT year, count(*) AS count FROM ads WHERE year > 1990 GROUP BY 1 ORDER BY 1 DESC LIMIT 20"),
}
