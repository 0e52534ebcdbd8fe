"""Independent DuckDB SQL for every registered query (the correctness oracle).

It states the world of ``plans.world`` relationally — no JSON, no envelopes —
so agreement with the Spark side checks the whole chain: envelope build,
VARIANT parse, flatten, typed extraction, dedup, rollups, joins and merges.
NULL order is spelled out (DESC NULLS FIRST / ASC NULLS LAST) as the warehouse
does, and every numeric output is cast to the Spark type.
"""

from __future__ import annotations

# Game lines: lineitem ⋈ part ⋈ supplier, with the snapshot (year of ship date).
GL = """gl AS (
  SELECT CAST(date_trunc('year', l.l_shipdate) AS TIMESTAMP) AS snap,
         l.l_orderkey, l.l_linenumber, l.l_returnflag, l.l_linestatus, l.l_shipdate,
         p.p_partkey, p.p_name, p.p_size, s.s_suppkey, s.s_name
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

GAME_NAME = ("CASE WHEN p_size = 50 THEN NULL WHEN p_partkey % 3 = 0 THEN upper(p_name) "
             "WHEN p_partkey % 3 = 1 THEN ' ' || p_name || ' ' ELSE p_name END")

GAMES_ALL = """games_all AS (
  SELECT DISTINCT
    CAST(p_partkey AS BIGINT) AS rawg_game_id,
    'g-' || CAST(p_partkey AS VARCHAR) AS slug,
    {name} AS game_name,
    CASE WHEN p_size > 45 THEN NULL ELSE make_date(1990 + p_size % 20, 1 + p_size % 12, 1 + p_size % 28) END
      AS released_date,
    p_size > 45 AS is_tba,
    CASE WHEN p_size % 10 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) / 10 END AS rating,
    CAST(5 AS BIGINT) AS rating_top,
    CAST(CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE (p_partkey * 37) % 1000 END AS BIGINT) AS ratings_count,
    CAST((p_partkey * 13) % 97 AS BIGINT) AS reviews_count,
    CAST(p_partkey % 5 AS BIGINT) AS reviews_text_count,
    CAST(p_size * 3 AS BIGINT) AS added_count,
    CAST(p_size % 24 AS BIGINT) AS playtime_hours,
    CAST(p_partkey % 11 AS BIGINT) AS suggestions_count,
    CAST(CASE WHEN p_size % 4 = 0 THEN NULL ELSE 40 + p_size END AS BIGINT) AS metacritic_score,
    'img/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS background_image_url,
    snap AS source_updated_at,
    snap AS extracted_at_utc
  FROM gl
)""".format(name=GAME_NAME)

GENRES_ALL = """genres_all AS (
  SELECT DISTINCT CAST(p_partkey AS BIGINT) AS rawg_game_id, {name} AS game_name,
         CAST(genre_id AS BIGINT) AS genre_id, genre_name, genre_slug, snap AS extracted_at_utc
  FROM (
    SELECT snap, p_partkey, p_name, p_size,
           CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 WHEN 'N' THEN 3 END AS genre_id,
           CASE l_returnflag WHEN 'A' THEN 'Adventure' WHEN 'R' THEN 'RPG' WHEN 'N' THEN 'Indie' END AS genre_name,
           CASE l_returnflag WHEN 'A' THEN 'adventure' WHEN 'R' THEN 'rpg' WHEN 'N' THEN 'indie' END AS genre_slug
    FROM gl
    UNION ALL
    SELECT snap, p_partkey, p_name, p_size,
           CASE l_linestatus WHEN 'F' THEN 4 WHEN 'O' THEN 5 END,
           CASE l_linestatus WHEN 'F' THEN 'Action' WHEN 'O' THEN 'Strategy' END,
           CASE l_linestatus WHEN 'F' THEN 'action' WHEN 'O' THEN 'strategy' END
    FROM gl
  ) x
)""".format(name=GAME_NAME)

PLATFORMS_ALL = """platforms_all AS (
  SELECT DISTINCT CAST(p_partkey AS BIGINT) AS rawg_game_id, {name} AS game_name,
         CAST(s_suppkey AS BIGINT) AS platform_id, s_name AS platform_name, lower(s_name) AS platform_slug,
         CASE WHEN (p_partkey + s_suppkey) % 4 = 0 THEN NULL
              ELSE CAST(snap AS DATE) + CAST((p_partkey + s_suppkey) % 28 AS INTEGER) END AS released_at,
         snap AS extracted_at_utc
  FROM gl
)""".format(name=GAME_NAME)

OFFERS_ALL = """offers_all AS (
  SELECT DISTINCT
    CAST(100000 + p_partkey AS BIGINT) AS steam_app_id,
    CASE WHEN p_size = 49 THEN NULL WHEN p_partkey % 4 = 0 THEN lower(p_name) WHEN p_partkey % 4 = 1 THEN upper(p_name)
         WHEN p_partkey % 4 = 2 THEN p_name || '  ' ELSE p_name END AS game_name,
    CAST(0 AS BIGINT) AS item_type,
    CASE l_returnflag WHEN 'A' THEN 'specials' WHEN 'R' THEN 'top_sellers' WHEN 'N' THEN 'new_releases' END AS category_key,
    CASE l_returnflag WHEN 'A' THEN 'Specials' WHEN 'R' THEN 'Top Sellers' WHEN 'N' THEN 'New Releases' END AS category_name,
    l_returnflag = 'A' AS is_discounted,
    CAST(CASE WHEN l_returnflag = 'A' THEN 10 * (1 + p_size % 5) ELSE 0 END AS BIGINT) AS discount_percent,
    CAST(CAST(p_size * 100 + 99 AS DECIMAL(38,0)) / 100.0 AS DECIMAL(38,6)) AS original_price_usd,
    CAST(CAST(p_size * 100 + 99 - (CASE WHEN l_returnflag = 'A' THEN 10 * (1 + p_size % 5) ELSE 0 END) * p_size
              AS DECIMAL(38,0)) / 100.0 AS DECIMAL(38,6)) AS final_price_usd,
    'USD' AS currency,
    TRUE AS windows_available,
    p_size % 2 = 0 AS mac_available,
    CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size % 3 = 1 END AS linux_available,
    CASE WHEN p_size % 5 = 0 THEN 'full' END AS controller_support,
    'hdr/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS header_image_url,
    'app/' || CAST(100000 + p_partkey AS VARCHAR) AS steam_url,
    CAST(snap + to_seconds(CAST(p_size AS BIGINT) * 86400) AS TIMESTAMP) AS discount_expires_at,
    snap AS extracted_at_utc
  FROM gl
)"""

LATEST = "(SELECT max(snap) FROM gl)"

# The mart from its definition.  Per game: the last time it was seen; the store time that the last run
# before the next game snapshot could read; each list and store value by a grouped query over the base rows.
def mart_ctes(games: str = "games_all", genres: str = "genres_all", platforms: str = "platforms_all",
              offers: str = "offers_all") -> str:
    store_values = [("steam_app_id", "steam_app_id"), ("steam_category_name", "category_name"),
                    ("is_discounted_on_steam", "is_discounted"), ("steam_discount_percent", "discount_percent"),
                    ("steam_final_price_usd", "final_price_usd"), ("steam_windows_available", "windows_available"),
                    ("steam_mac_available", "mac_available"), ("steam_linux_available", "linux_available")]
    best = ", ".join(f"max({src}) AS {out}" for out, src in store_values)
    return f"""game_times AS (
  SELECT extracted_at_utc AS seen, lead(extracted_at_utc) OVER (ORDER BY extracted_at_utc) AS next_seen
  FROM (SELECT DISTINCT extracted_at_utc FROM {games})
), reads AS (
  SELECT seen, (SELECT max(o.extracted_at_utc) FROM {offers} o
                WHERE next_seen IS NULL OR o.extracted_at_utc < next_seen) AS store_seen
  FROM game_times
), last_rows AS (
  SELECT * FROM {games} WHERE (rawg_game_id, extracted_at_utc) IN
    (SELECT rawg_game_id, max(extracted_at_utc) FROM {games} GROUP BY rawg_game_id)
), by_name AS (
  SELECT extracted_at_utc AS store_seen, lower(trim(game_name)) AS name_key, {best}
  FROM {offers} WHERE game_name IS NOT NULL GROUP BY ALL
), mart AS (
  SELECT l.rawg_game_id, slug, game_name, released_date, is_tba, rating, ratings_count, reviews_count, metacritic_score,
         added_count, playtime_hours,
         coalesce((SELECT coalesce(string_agg(DISTINCT x.genre_name, ', ' ORDER BY x.genre_name), '') FROM {genres} x
                   WHERE x.rawg_game_id = l.rawg_game_id AND x.extracted_at_utc = l.extracted_at_utc
                   HAVING count(*) > 0), 'Unknown') AS genres,
         CAST((SELECT count(DISTINCT x.platform_name) FROM {platforms} x
               WHERE x.rawg_game_id = l.rawg_game_id AND x.extracted_at_utc = l.extracted_at_utc) AS BIGINT) AS platform_count,
         (SELECT coalesce(string_agg(DISTINCT x.platform_name, ', ' ORDER BY x.platform_name), '') FROM {platforms} x
          WHERE x.rawg_game_id = l.rawg_game_id AND x.extracted_at_utc = l.extracted_at_utc HAVING count(*) > 0) AS platforms,
         {", ".join("b." + out for out, _ in store_values)}, l.extracted_at_utc
  FROM last_rows l JOIN reads r ON r.seen = l.extracted_at_utc
  LEFT JOIN by_name b ON b.store_seen = r.store_seen AND b.name_key = lower(trim(l.game_name))
)"""


BASE_CTES = ",\n".join([GL, GAMES_ALL, GENRES_ALL, PLATFORMS_ALL, OFFERS_ALL])
MART_CTES = BASE_CTES + ",\n" + mart_ctes()

# Of the latest store snapshot, per name (for the queries on the rollup alone).
LATEST_STORE = f"""latest_store AS (
  SELECT lower(trim(game_name)) AS game_name_key, max(steam_app_id) AS steam_app_id, max(category_name) AS steam_category_name,
         max(is_discounted) AS is_discounted_on_steam, max(discount_percent) AS steam_discount_percent,
         max(final_price_usd) AS steam_final_price_usd, max(windows_available) AS steam_windows_available,
         max(mac_available) AS steam_mac_available, max(linux_available) AS steam_linux_available
  FROM offers_all WHERE game_name IS NOT NULL AND extracted_at_utc = {LATEST} GROUP BY ALL
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SQL: dict[str, str] = {}

SQL["mart_games"] = "WITH " + MART_CTES + "\nSELECT * FROM mart"

# Gaps: the store misses every year divisible by three, the games one year.
GAMES_MISS_YEAR = 1997
SQL["mart_games_gaps"] = "WITH " + BASE_CTES + ",\n" + ",\n".join(
    f"some_{t} AS (SELECT * FROM {t}_all WHERE year(extracted_at_utc) <> {GAMES_MISS_YEAR})" for t in ("games", "genres", "platforms")
) + ",\nsome_offers AS (SELECT * FROM offers_all WHERE year(extracted_at_utc) % 3 <> 0),\n" + mart_ctes(
    "some_games", "some_genres", "some_platforms", "some_offers") + "\nSELECT * FROM mart"

SQL["mart_top_n"] = "WITH " + MART_CTES + """
SELECT rawg_game_id, game_name, released_date, rating, ratings_count, reviews_count, metacritic_score, genres,
       platform_count, platforms, steam_app_id, is_discounted_on_steam, steam_discount_percent, steam_final_price_usd
FROM mart WHERE rating IS NOT NULL
ORDER BY rating DESC NULLS FIRST, ratings_count DESC NULLS FIRST, reviews_count DESC NULLS FIRST,
         game_name ASC NULLS LAST, rawg_game_id ASC NULLS LAST
LIMIT 25"""

LATEST_RUN = "(SELECT max(snap) FROM gl)"


def _latest(cte_sql: str, name: str, cols: str = "*") -> str:
    return "WITH " + cte_sql + f"\nSELECT {cols} FROM {name} WHERE extracted_at_utc = {LATEST_RUN}"


ISO_UTC = "'%Y-%m-%dT%H:%M:%SZ'"
ISO_DATE = "'%Y-%m-%d'"
STAMP = "'%Y%m%dT%H%M%SZ'"


def _key(src: str, ts: str) -> str:
    return ("'raw/source=' || {s} || '/extract_date=' || strftime({t}, {d}) || '/' || "
            "CASE {s} WHEN 'rawg' THEN 'rawg_games' WHEN 'steam' THEN 'steam_apps' END || '_' || "
            "strftime({t}, {st}) || '.json'").format(s=src, t=ts, d=ISO_DATE, st=STAMP)


AUDIT = """audit AS (
  SELECT src AS source, {key} AS s3_key,
         CASE src WHEN 'rawg' THEN 'RAWG_GAMES_RAW' ELSE 'STEAM_GAMES_RAW' END AS target_table,
         CAST(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE floor(o_totalprice / 1000) END AS BIGINT) AS rows_loaded,
         CASE o_orderstatus WHEN 'F' THEN 'loaded' WHEN 'P' THEN 'skipped_existing' WHEN 'O' THEN 'reloaded' END
           AS status,
         CAST(o_orderdate + to_seconds(o_orderkey % 86400) AS TIMESTAMP) AS loaded_at
  FROM (SELECT *, CASE WHEN o_orderpriority < '3' THEN 'steam' ELSE 'rawg' END AS src FROM orders) o
)""".format(key=_key("src", "o_orderdate"))

CANDIDATES = """cand AS (
  SELECT src AS source, {key} AS s3_key, CAST(count(*) AS BIGINT) AS rows_loaded, day,
         CASE src WHEN 'rawg' THEN 'RAWG_GAMES_RAW' ELSE 'STEAM_GAMES_RAW' END AS target_table
  FROM (SELECT CASE WHEN l_returnflag = 'R' THEN 'steam' ELSE 'rawg' END AS src,
               CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS day FROM lineitem) x
  GROUP BY src, day
)""".format(key=_key("src", "day"))

LOADED_AT = "TIMESTAMP '2026-01-01 09:00:00'"

SQL["env_build"] = f"""
SELECT 'rawg' AS source, strftime(date_trunc('month', o_orderdate), {ISO_UTC}) AS extracted_at_utc,
       o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, strftime(o_orderdate, {ISO_DATE}) AS order_date
FROM orders"""

SQL["landing_key"] = f"""
SELECT o_orderkey, src AS source, strftime(o_orderdate, {ISO_UTC}) AS extracted_at_utc,
       strftime(o_orderdate, {ISO_DATE}) AS extract_date, strftime(o_orderdate, {STAMP}) AS file_stamp,
       {_key('src', 'o_orderdate')} AS s3_key,
       substr({_key('src', 'o_orderdate')}, 5) AS relative_key
FROM (SELECT *, CASE WHEN o_orderpriority < '3' THEN 'steam' ELSE 'rawg' END AS src FROM orders) o"""

SQL["landing_roundtrip"] = f"""
SELECT 'rawg' AS source, strftime(date_trunc('month', o_orderdate), {ISO_DATE}) AS extract_date,
       o_orderkey, o_totalprice
FROM orders"""

SQL["landing_gate"] = "WITH " + AUDIT + ",\n" + CANDIDATES + """
SELECT DISTINCT a.s3_key,
       CASE WHEN EXISTS (SELECT 1 FROM cand c WHERE c.s3_key = a.s3_key) THEN 'skipped_existing' ELSE 'uploaded' END
         AS upload_status
FROM audit a"""

SQL["raw_copy"] = "WITH " + GL + f"""
SELECT source, snap AS extracted_at, {LOADED_AT} AS loaded_at, CAST(count(*) AS BIGINT) AS entries
FROM gl, (VALUES ('rawg'), ('steam')) AS s(source) GROUP BY ALL"""

ONE_DAY = "1998-03-05"
SQL["single_key_copy"] = f"""
SELECT 'rawg' AS source,
       'raw/source=rawg/extract_date={ONE_DAY}/rawg_games_{ONE_DAY.replace("-", "")}T000000Z-00000.json' AS s3_key,
       TIMESTAMP '{ONE_DAY}' AS extracted_at, CAST(1 AS BIGINT) AS documents, CAST(count(*) AS BIGINT) AS entries
FROM orders WHERE date_trunc('day', o_orderdate) = DATE '{ONE_DAY}' HAVING count(*) > 0"""

SQL["land_twice"] = f"""
SELECT strftime(date_trunc('month', o_orderdate), {ISO_DATE}) AS extract_date, CAST(count(*) AS BIGINT) AS entries,
       CAST(1 AS BIGINT) AS most_copies, 'uploaded' AS land, 'skipped_existing' AS land_again, 'loaded' AS load,
       'skipped_existing' AS load_again
FROM orders GROUP BY 1"""

SQL["load_crash_replay"] = f"""
SELECT strftime(date_trunc('month', o_orderdate), {ISO_DATE}) AS extract_date, CAST(count(*) AS BIGINT) AS entries,
       CAST(0 AS BIGINT) AS visible_after_crash, CAST(1 AS BIGINT) AS most_copies, 'loaded,skipped_existing' AS statuses
FROM orders GROUP BY 1"""

SQL["bad_file_abort"] = """
SELECT 'before' AS step, false AS aborted, CAST(count(*) AS BIGINT) AS entries FROM orders
UNION ALL SELECT 'with a malformed file', true, CAST(count(*) AS BIGINT) FROM orders"""

SQL["load_time_default"] = """
SELECT date_trunc('month', o_orderdate) AS extracted_at, CAST(count(*) AS BIGINT) AS entries, true AS loaded_now
FROM orders GROUP BY 1"""

_ITEM_NAME = ("CASE WHEN p_size = 49 THEN NULL WHEN p_partkey % 4 = 0 THEN lower(p_name) "
              "WHEN p_partkey % 4 = 1 THEN upper(p_name) WHEN p_partkey % 4 = 2 THEN p_name || '  ' ELSE p_name END")
_CATEGORY = """CASE l_returnflag WHEN 'A' THEN 'specials' WHEN 'R' THEN 'top_sellers' WHEN 'N' THEN 'new_releases' END
         AS category_key,
       CASE l_returnflag WHEN 'A' THEN 'Specials' WHEN 'R' THEN 'Top Sellers' WHEN 'N' THEN 'New Releases' END
         AS category_name"""

SQL["category_flatten"] = "WITH " + GL + f"""
SELECT snap AS extracted_at, {_CATEGORY}, CAST(100000 + p_partkey AS BIGINT) AS steam_app_id,
       {_ITEM_NAME} AS game_name, CAST(l_orderkey * 100 + l_linenumber AS BIGINT) AS seq
FROM gl"""

CURSOR = 101000
SQL["category_cursor"] = SQL["category_flatten"] + f"\nWHERE 100000 + p_partkey > {CURSOR}"

SQL["category_head_n"] = "WITH " + GL + f""",
items AS (
  SELECT snap AS extracted_at,
         CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 WHEN 'N' THEN 2 END AS cat_pos,
         {_CATEGORY}, CAST(100000 + p_partkey AS BIGINT) AS steam_app_id,
         CAST(l_orderkey * 100 + l_linenumber AS BIGINT) AS seq
  FROM gl
)
SELECT extracted_at, category_key, steam_app_id, seq,
       CAST(row_number() OVER (PARTITION BY extracted_at ORDER BY cat_pos, seq, steam_app_id) AS INTEGER) AS item_rank,
       CAST(count(*) OVER (PARTITION BY extracted_at) AS BIGINT) AS total_available
FROM items
QUALIFY row_number() OVER (PARTITION BY extracted_at ORDER BY cat_pos, seq, steam_app_id) <= 200"""

# Documents hold the items of so many order keys; each is cut to its first items after the cursor.
ORDERS_PER_DOCUMENT, STORE_HEAD = 400, 60
SQL["store_pipeline"] = "WITH " + GL + ",\n" + OFFERS_ALL.replace("offers_all AS", "kept_offers AS").replace(
    "SELECT DISTINCT", "SELECT DISTINCT", 1).replace("FROM gl", f"""FROM (
    SELECT *, row_number() OVER (
             PARTITION BY snap, l_orderkey // {ORDERS_PER_DOCUMENT}
             ORDER BY CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 WHEN 'N' THEN 2 END,
                      l_orderkey * 100 + l_linenumber, p_partkey) AS place
    FROM gl WHERE 100000 + p_partkey > {CURSOR}) gl
  WHERE place <= {STORE_HEAD}""") + f"""
SELECT * FROM kept_offers WHERE extracted_at_utc = (SELECT max(extracted_at_utc) FROM kept_offers)"""

SQL["json_extract"] = """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text,
       CAST(json_extract(props, '$.k') AS DOUBLE) AS k_double, CAST(NULL AS VARCHAR) AS missing
FROM events"""

SQL["latest_snapshot"] = "WITH " + GL + f"""
SELECT snap AS extracted_at, CAST(p_partkey AS BIGINT) AS rawg_game_id, CAST(count(*) AS BIGINT) AS n_entries
FROM gl WHERE snap = {LATEST_RUN} GROUP BY 1, 2"""

SQL["flatten_one"] = "WITH " + GL + f"""
SELECT snap AS extracted_at, CAST(p_partkey AS BIGINT) AS rawg_game_id, {GAME_NAME} AS game_name,
       CASE WHEN p_size % 10 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) / 10 END AS rating
FROM gl"""

SQL["flatten_nested"] = _latest(GL + ",\n" + GENRES_ALL, "genres_all")
SQL["stg_games"] = _latest(GL + ",\n" + GAMES_ALL, "games_all")
SQL["stg_children"] = _latest(GL + ",\n" + PLATFORMS_ALL, "platforms_all")
SQL["stg_offers"] = _latest(GL + ",\n" + OFFERS_ALL, "offers_all")
SQL["stg_audit"] = "WITH " + AUDIT + "\nSELECT * FROM audit"

SQL["dedup_latest"] = """
SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""

SQL["epoch_to_ts"] = """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_seconds,
       make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS ts_seconds
FROM events"""

SQL["cents_to_money"] = """
SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice * 100) AS BIGINT) AS cents,
       CAST(CAST(floor(l_extendedprice * 100) AS DECIMAL(38,0)) / 100.0 AS DECIMAL(38,6)) AS usd
FROM lineitem"""

SQL["name_rollup"] = "WITH " + ",\n".join([GL, OFFERS_ALL, LATEST_STORE]) + "\nSELECT * FROM latest_store"

SQL["child_listagg"] = """
SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities
FROM orders GROUP BY o_custkey"""

SQL["child_rollup"] = """
SELECT l_partkey, CAST(count(DISTINCT s_name) AS BIGINT) AS supplier_count,
       string_agg(DISTINCT s_name, ', ' ORDER BY s_name) AS suppliers
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_partkey"""

SQL["name_join"] = "WITH " + ",\n".join([GL, OFFERS_ALL, LATEST_STORE]) + """
SELECT p.p_partkey, p.p_name, r.steam_app_id, r.steam_category_name, r.steam_final_price_usd
FROM part p LEFT JOIN latest_store r ON lower(trim(p.p_name)) = r.game_name_key"""

# Shares and counts per platform, from the numbers of dated and of all its rows.
SQL["mart_coverage"] = "WITH " + GL + ",\n" + PLATFORMS_ALL + f"""
SELECT platform_name, CAST(len(list_distinct(list(rawg_game_id))) AS BIGINT) AS game_count,
       count(released_at) / count(*) AS pct_with_platform_release_date, {LATEST_RUN} AS latest_extract_at_utc
FROM platforms_all WHERE extracted_at_utc = {LATEST_RUN}
GROUP BY platform_name
ORDER BY game_count DESC NULLS FIRST, platform_name ASC NULLS LAST"""

SQL["mart_roundtrip"] = SQL["mart_coverage"]

SQL["mart_load_summary"] = "WITH " + AUDIT + """
SELECT CAST(CAST(loaded_at AS DATE) AS TIMESTAMP) AS load_date, source, target_table, CAST(count(*) AS BIGINT) AS load_attempts,
       CAST(count(*) FILTER (WHERE status = 'loaded') AS BIGINT) AS successful_loads,
       CAST(count(*) FILTER (WHERE status = 'skipped_existing') AS BIGINT) AS skipped_existing_loads,
       CAST(sum(rows_loaded) AS BIGINT) AS total_rows_loaded, max(loaded_at) AS latest_loaded_at
FROM audit GROUP BY ALL
ORDER BY load_date DESC NULLS FIRST, source ASC NULLS LAST, target_table ASC NULLS LAST"""

MERGE_SPLIT_TARGET = "1999-01-01"
MERGE_SPLIT_UPDATES = "1998-01-01"
SQL["merge_upsert"] = f"""
WITH t AS (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '{MERGE_SPLIT_TARGET}'
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
), u AS (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '{MERGE_SPLIT_UPDATES}'
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
)
SELECT * FROM u
UNION ALL
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.o_custkey = t.o_custkey)"""

SQL["merge_fold"] = """
WITH snaps AS (
  SELECT o_custkey, CAST(date_trunc('year', o_orderdate) AS TIMESTAMP) AS snapshot_at,
         CAST(count(*) AS BIGINT) AS n_orders, max(o_totalprice) AS max_totalprice, max(o_orderdate) AS last_orderdate
  FROM orders GROUP BY 1, 2
)
SELECT * FROM snaps QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY snapshot_at DESC) = 1"""

SQL["already_loaded"] = "WITH " + AUDIT + ",\n" + CANDIDATES + """
SELECT source, s3_key, target_table, rows_loaded FROM cand c
WHERE NOT EXISTS (SELECT 1 FROM audit a WHERE a.status = 'loaded' AND a.source = c.source
                  AND a.s3_key = c.s3_key AND a.target_table = c.target_table)"""

_PLAN = """
SELECT c.source, c.s3_key, c.target_table,
       CAST({rows} AS BIGINT) AS rows_loaded, {status} AS status, {ts} AS loaded_at
FROM cand c
LEFT JOIN (SELECT DISTINCT source, s3_key, target_table, TRUE AS was FROM audit WHERE status = 'loaded') d
  ON c.source = d.source AND c.s3_key = d.s3_key AND c.target_table = d.target_table"""

SQL["load_plan"] = "WITH " + AUDIT + ",\n" + CANDIDATES + _PLAN.format(
    rows="CASE WHEN d.was THEN 0 ELSE c.rows_loaded END",
    status="CASE WHEN d.was THEN 'skipped_existing' ELSE 'loaded' END", ts=LOADED_AT)

BACKFILL_MONTH = "1998-03"
BACKFILL_DAYS = ("1998-03-01", "1998-04-01")
SQL["backfill_replay"] = "WITH " + AUDIT + ",\n" + CANDIDATES + _PLAN.format(
    rows="c.rows_loaded", status="'reloaded'", ts=LOADED_AT) + f"\nWHERE strftime(c.day, '%Y-%m') = '{BACKFILL_MONTH}'"

SQL["kpi_release_trend"] = "WITH " + MART_CTES + """
SELECT CAST(date_trunc('month', released_date) AS DATE) AS release_month, CAST(count(*) AS BIGINT) AS game_count
FROM mart GROUP BY 1"""

SQL["kpi_rating_by_genre"] = "WITH " + MART_CTES + """
SELECT genre, round(avg(rating), 6) AS avg_rating, CAST(count(*) AS BIGINT) AS game_count,
       CAST(count(rating) AS BIGINT) AS rated_games
FROM (SELECT DISTINCT m.rawg_game_id, m.rating, coalesce(x.genre_name, 'Unknown') AS genre
      FROM mart m LEFT JOIN genres_all x ON x.rawg_game_id = m.rawg_game_id AND x.extracted_at_utc = m.extracted_at_utc) y
GROUP BY genre"""

SQL["kpi_catalog_growth"] = "WITH " + GL + """,
per AS (SELECT snap AS extracted_at, CAST(count(DISTINCT p_partkey) AS BIGINT) AS game_count FROM gl GROUP BY snap)
SELECT extracted_at, game_count, lag(game_count) OVER (ORDER BY extracted_at) AS prev_game_count,
       game_count - coalesce(lag(game_count) OVER (ORDER BY extracted_at), 0) AS delta_games
FROM per"""

# ------------------------------------------------------------------ checks
MODEL_CTES = ",\n".join([MART_CTES, AUDIT, f"""
stg_rawg_games AS (SELECT * FROM games_all WHERE extracted_at_utc = {LATEST_RUN}),
stg_rawg_game_platforms AS (SELECT * FROM platforms_all WHERE extracted_at_utc = {LATEST_RUN}),
stg_rawg_game_genres AS (SELECT * FROM genres_all WHERE extracted_at_utc = {LATEST_RUN}),
stg_steam_featured_games AS (SELECT * FROM offers_all WHERE extracted_at_utc = {LATEST_RUN}),
stg_raw_load_audit AS (SELECT * FROM audit),
mart_games AS (SELECT * FROM mart),
mart_platform_coverage AS (SELECT platform_name FROM stg_rawg_game_platforms GROUP BY platform_name),
mart_top_rated_games AS (
  SELECT rawg_game_id FROM mart WHERE rating IS NOT NULL
  ORDER BY rating DESC NULLS FIRST, ratings_count DESC NULLS FIRST, reviews_count DESC NULLS FIRST,
           game_name ASC NULLS LAST, rawg_game_id ASC NULLS LAST LIMIT 25),
mart_pipeline_load_summary AS (
  SELECT CAST(date_trunc('day', loaded_at) AS TIMESTAMP) AS load_date, source FROM audit GROUP BY 1, 2,
         target_table)"""])


# The column tests, stated here on their own.
NOT_NULL = [
    ("stg_rawg_games", "rawg_game_id"), ("stg_rawg_games", "game_name"), ("stg_rawg_game_platforms", "rawg_game_id"),
    ("stg_rawg_game_platforms", "platform_name"), ("stg_rawg_game_genres", "rawg_game_id"), ("stg_rawg_game_genres", "genre_name"),
    ("stg_steam_featured_games", "category_name"), ("stg_raw_load_audit", "source"), ("stg_raw_load_audit", "s3_key"),
    ("stg_raw_load_audit", "status"), ("mart_games", "rawg_game_id"), ("mart_games", "game_name"),
    ("mart_platform_coverage", "platform_name"), ("mart_top_rated_games", "rawg_game_id"),
    ("mart_pipeline_load_summary", "load_date"), ("mart_pipeline_load_summary", "source"),
]
UNIQUE = [("mart_games", "rawg_game_id"), ("mart_platform_coverage", "platform_name"), ("mart_top_rated_games", "rawg_game_id")]


def _check_rows(kind: str) -> str:
    parts = []
    if kind in ("not_null", "all"):
        for m, c in NOT_NULL:
            parts.append(f"SELECT '{m}' AS model, '{c}' AS column_name, 'not_null' AS test, "
                         f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {m}")
    if kind in ("unique", "all"):
        for m, c in UNIQUE:
            parts.append(f"SELECT '{m}' AS model, '{c}' AS column_name, 'unique' AS test, "
                         f"CAST((SELECT count(*) FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL "
                         f"GROUP BY {c} HAVING count(*) > 1)) AS BIGINT) AS failures")
    body = "\nUNION ALL\n".join(parts)
    return ("WITH " + MODEL_CTES + f"\nSELECT model, column_name, test, failures, "
            f"CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM (\n{body}\n) r")


SQL["dq_not_null"] = _check_rows("not_null")
SQL["dq_unique"] = _check_rows("unique")
SQL["dq_report"] = _check_rows("all")

FRESHNESS_NOW = "2002-01-05 00:00:00"
SQL["dq_freshness"] = "WITH " + GL + f""",
m AS (SELECT max(snap) AS max_loaded_at FROM gl)
SELECT src AS source, max_loaded_at,
       CAST(epoch(TIMESTAMP '{FRESHNESS_NOW}') - epoch(max_loaded_at) AS DOUBLE) AS age_seconds,
       CASE WHEN max_loaded_at IS NULL THEN 'error'
            WHEN epoch(TIMESTAMP '{FRESHNESS_NOW}') - epoch(max_loaded_at) > 7 * 86400 THEN 'error'
            WHEN epoch(TIMESTAMP '{FRESHNESS_NOW}') - epoch(max_loaded_at) > 2 * 86400 THEN 'warn'
            ELSE 'pass' END AS status
FROM m, (VALUES ('rawg'), ('steam')) AS s(src)"""

SQL["stream_load"] = "WITH " + GL + """
SELECT source, snap AS extracted_at, CAST(count(*) AS BIGINT) AS entries
FROM gl, (VALUES ('rawg'), ('steam')) AS s(source) GROUP BY ALL"""

SQL["daily_runs"] = SQL["mart_games"]
