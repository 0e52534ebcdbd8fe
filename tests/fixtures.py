"""Hand-made envelopes (the golden cases of FIXTURES.md §2)."""

import json

SNAP_A = "2026-03-31T09:00:00Z"
SNAP_B = "2026-04-01T09:00:00Z"

ALPHA = {"id": 1, "name": " Alpha ", "rating": 4.5, "ratings_count": None, "reviews_count": 5,
         "genres": [{"id": 1, "name": "RPG", "slug": "rpg"}, {"id": 2, "name": "Action", "slug": "action"},
                    {"id": 2, "name": "Action", "slug": "action"}],
         "platforms": [{"platform": {"id": 4, "name": "PC", "slug": "pc"}, "released_at": "2020-01-02"},
                       {"platform": {"id": 7, "name": "Switch", "slug": "switch"}, "released_at": None}]}

GAMES_A = [dict(ALPHA, rating=1.0),
           {"id": 3, "name": "Gone", "rating": 4.9, "ratings_count": 7, "genres": [], "platforms": []}]
GAMES_B = [ALPHA, dict(ALPHA),
           {"id": 2, "name": "Beta", "rating": None, "genres": [{"id": 1, "name": "RPG", "slug": "rpg"}],
            "platforms": [{"platform": {"id": 4, "name": "PC", "slug": "pc"}, "released_at": None}]},
           {"id": 4, "name": "alpha", "rating": 4.5, "ratings_count": 10, "genres": [],
            "platforms": [{"platform": {"id": 4, "name": "PC", "slug": "pc"}, "released_at": "2021-05-05"}]},
           {"id": 5, "name": "Echo", "rating": 3.0, "ratings_count": 1}]

STORE_DOC = {
    "specials": {"name": "Specials", "items": [
        {"id": 100, "name": "ALPHA", "discounted": True, "discount_percent": 50, "original_price": 3999,
         "final_price": 1999, "windows_available": True, "mac_available": False, "discount_expiration": 1774688400},
        {"id": None, "name": "Mystery"}, {"id": None, "name": "Mystery"}]},
    "top_sellers": {"name": "Top Sellers", "items": [
        {"id": 101, "name": "alpha", "discounted": False, "discount_percent": 0, "original_price": 5999,
         "final_price": 5999, "windows_available": True, "mac_available": True},
        {"id": 102, "name": None}]},
    "coming_soon": {"name": "Coming Soon"},
    "status": 1,
}


def featured_items(doc=STORE_DOC):
    """The extractor's flatten, in plain Python (reference behaviour, for fixtures)."""
    out = []
    for key, val in doc.items():
        if not isinstance(val, dict):
            continue
        for item in val.get("items", []):
            out.append(dict(item, category_key=key, category_name=val.get("name")))
    return out


def envelope(source, ts, payload):
    return json.dumps({"source": source, "extracted_at_utc": ts, "payload": payload}, indent=2)


def raw_table(spark, rows):
    """rows: (source, s3_key, envelope_json, loaded_at) → raw table DataFrame."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "source string, s3_key string, body string, loaded_at string")
    payload = F.parse_json("body")
    return df.select("source", "s3_key",
                     F.to_timestamp_ntz(F.variant_get(payload, "$.extracted_at_utc", "string")).alias("extracted_at"),
                     payload.alias("payload"), F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at"))


def rawg_raw(spark, snapshots=("A", "B")):
    rows = []
    if "A" in snapshots:
        rows.append(("rawg", "raw/source=rawg/extract_date=2026-03-31/rawg_games_20260331T090000Z.json",
                     envelope("rawg", SNAP_A, {"results": GAMES_A}), "2026-03-31 10:00:00"))
    if "B" in snapshots:
        rows.append(("rawg", "raw/source=rawg/extract_date=2026-04-01/rawg_games_20260401T090000Z.json",
                     envelope("rawg", SNAP_B, {"results": GAMES_B}), "2026-04-01 10:00:00"))
    return raw_table(spark, rows)


def steam_raw(spark):
    items = featured_items()
    return raw_table(spark, [("steam", "raw/source=steam/extract_date=2026-04-01/steam_apps_20260401T090000Z.json",
                              envelope("steam", SNAP_B, {"featured_categories": items,
                                                         "total_available": len(items)}),
                              "2026-04-01 10:00:00")])


def audit(spark):
    return spark.createDataFrame([], "source string, s3_key string, target_table string, rows_loaded bigint, "
                                     "status string, loaded_at timestamp_ntz")
