"""Reference SQL of the registered queries, in the dialect of DuckDB, over the same given tables.

The derived tables are written out again here, so a mistake in the Spark derivation shows up as a difference.
"""

from __future__ import annotations

import math

RAW = """
st(r, fips, x0, y0, x1, y1) AS (
  SELECT r, fips, x0::DOUBLE, y0::DOUBLE, x1::DOUBLE, y1::DOUBLE FROM (VALUES
    (0, '13', -85.61, 30.36, -80.84, 35.00), (1, '37', -84.32, 33.84, -75.46, 36.59),
    (2, '06', -124.48, 32.53, -114.13, 42.01), (3, '12', -87.63, 24.52, -80.03, 31.00),
    (4, '48', -106.65, 25.84, -93.51, 36.50)) v(r, fips, x0, y0, x1, y1)),
nat AS (
  SELECT n_nationkey, n_name, fips AS statefp, lpad(CAST(n_nationkey * 2 + 1 AS VARCHAR), 3, '0') AS countyfp,
         x0, y0, x1, y1
  FROM nation JOIN st ON r = n_regionkey),
base AS (
  SELECT o_orderkey AS k, *, x0 + (x1 - x0) * (CAST((o_orderkey * 7919) % 10000 AS DOUBLE) / 10000) AS cx,
         y0 + (y1 - y0) * (CAST((o_orderkey * 104729) % 10000 AS DOUBLE) / 10000) AS cy,
         CAST(0.0005 AS DOUBLE) * (1 + o_orderkey % 5) AS half
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nat ON n_nationkey = c_nationkey),
raw AS (
  SELECT k AS lrid,
    CASE WHEN k % 11 <> 0 THEN 'P' || CAST(k // 3 AS VARCHAR) END AS parcelid,
    CASE WHEN k % 13 <> 0 THEN 'A' || CAST(k // 3 AS VARCHAR) END AS parcelid2,
    statefp, countyfp,
    CASE WHEN k % 97 <> 0 THEN statefp || countyfp END AS geoid,
    CAST(year(o_orderdate) AS INTEGER) AS taxyear,
    'U' || CAST(k % 12 AS VARCHAR) AS usecode,
    lower(c_mktsegment) AS usedesc,
    CASE WHEN k % 4 <> 1 THEN 'Z' || CAST(k % 6 AS VARCHAR) END AS zoningcode,
    CAST(k % 3 AS INTEGER) AS numbldgs,
    CASE WHEN k % 3 <> 0 THEN CAST(year(o_orderdate) - k % 60 AS INTEGER) END AS yearbuilt,
    CASE WHEN k % 5 <> 0 THEN CAST(500 + k % 4000 AS INTEGER) END AS bldgsqft,
    CASE WHEN k % 7 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS totalvalue,
    CAST(k % 400 AS DOUBLE) / 100 AS assdacres,
    CASE WHEN k % 4 <> 0 THEN CAST(floor(o_totalprice / 2) AS BIGINT) END AS saleamt,
    o_orderdate AS saledate,
    CASE WHEN k % 17 <> 0 THEN c_name END AS ownername,
    CASE WHEN k % 19 <> 0 THEN CAST(100 + k % 900 AS VARCHAR) || ' Peachtree St ' || CAST(k % 40 AS VARCHAR) END
      AS parceladdr,
    'Springfield' AS parcelcity,
    CASE WHEN k % 10 >= 7 THEN 'LOT ' || CAST(k % 50 AS VARCHAR) END AS legaldesc,
    o_orderdate AS updated, '2026.1' AS lrversion,
    cx AS centroidx, cy AS centroidy, CASE WHEN k % 23 <> 0 THEN cx END AS surfpointx, cy AS surfpointy,
    cx - half AS xmin, cy - half AS ymin, cx + half AS xmax, cy + half AS ymax
  FROM base)"""

PARCEL = RAW + """,
parcel AS (
  SELECT *, parceladdr AS parcel_address, ownername AS owner_name, totalvalue AS total_value, yearbuilt AS year_built,
         usedesc AS use_description, saleamt AS sale_amount, bldgsqft AS building_sqft, zoningcode AS zoning_code,
         legaldesc AS legal_description, usecode AS use_code
  FROM (
    SELECT *, coalesce(parcelid, parcelid2, CAST(lrid AS VARCHAR)) AS parcel_id,
      row_number() OVER (
        PARTITION BY geoid, coalesce(parcelid, parcelid2, CAST(lrid AS VARCHAR))
        ORDER BY (totalvalue IS NOT NULL)::INT + (yearbuilt IS NOT NULL)::INT + (parceladdr IS NOT NULL)::INT
          + (ownername IS NOT NULL)::INT DESC, lrid DESC) AS rn
    FROM raw WHERE geoid IS NOT NULL)
  WHERE rn = 1)"""

COUNTIES = """
counties AS (
  SELECT statefp || countyfp AS geoid, statefp, countyfp, n_name AS county_name FROM nat WHERE n_nationkey <> 7)"""

STATES = """
states(statefp, state_name, state_abbr) AS (VALUES ('06', 'California', 'CA'), ('12', 'Florida', 'FL'),
  ('13', 'Georgia', 'GA'), ('37', 'North Carolina', 'NC'), ('48', 'Texas', 'TX'))"""

ZONES = """
zone AS (
  SELECT min(s_suppkey) AS zone_id, x0 + c * CAST(0.25 AS DOUBLE) AS zx0, y0 + r * CAST(0.25 AS DOUBLE) AS zy0,
         x0 + (c + 1) * CAST(0.25 AS DOUBLE) AS zx1, y0 + (r + 1) * CAST(0.25 AS DOUBLE) AS zy1
  FROM (SELECT s_suppkey, statefp, x0, y0, s_suppkey % 17 AS c, (s_suppkey * 7) % 13 AS r
        FROM supplier JOIN nat ON n_nationkey = s_nationkey)
  GROUP BY statefp, c, r, x0, y0)"""

LOTS = """
lot AS (
  SELECT p_partkey AS lot_id, p_brand, p_partkey % 61 + 61 * (p_partkey // 3050000) AS c, (p_partkey // 61) % 50000 AS r FROM part),
lotbox AS (
  SELECT *, CAST(-84.5 AS DOUBLE) + c * CAST(0.0005 AS DOUBLE) AS lx0, CAST(31.0 AS DOUBLE) + r * CAST(0.0005 AS DOUBLE) AS ly0,
    CAST(-84.5 AS DOUBLE) + (c + 1) * CAST(0.0005 AS DOUBLE) AS lx1,
    CAST(31.0 AS DOUBLE) + (r + 1) * CAST(0.0005 AS DOUBLE) AS ly1
  FROM lot)"""

BOX = "round(xmin, 6) AS xmin, round(ymin, 6) AS ymin, round(xmax, 6) AS xmax, round(ymax, 6) AS ymax"
EXTENT = (
    "round(min(xmin), 6) AS xmin, round(min(ymin), 6) AS ymin, round(max(xmax), 6) AS xmax, round(max(ymax), 6) AS ymax"
)
METRO = "xmin <= -84.2 AND xmax >= -84.5 AND ymin <= 33.9 AND ymax >= 33.6"
SEARCH = "xmin <= -82.9 AND xmax >= -84.9 AND ymin <= 33.9 AND ymax >= 31.5"
L_SHAPE = (
    "((xmin <= -83.0 AND xmax >= -84.5 AND ymin <= 34.0 AND ymax >= 31.0)"
    " OR (xmin <= -81.0 AND xmax >= -83.0 AND ymin <= 32.0 AND ymax >= 31.0))"
)
ZONE_MEETS = "xmin <= zx1 AND xmax >= zx0 AND ymin <= zy1 AND ymax >= zy0"
DRAW = "(((lrid % 1000003) * 7919) % 1000003) / 1000003.0::DOUBLE"
CATEGORY = """CASE WHEN {0} ~ '.*(mixed).*' THEN 'mixed_use'
  WHEN {0} ~ '.*(vacant|undeveloped|unimproved).*' THEN 'vacant'
  WHEN {0} ~ '.*(exempt|government|church|school|public).*' THEN 'exempt'
  WHEN {0} ~ '.*(agric|farm|ranch|timber|crop|machinery).*' THEN 'agricultural'
  WHEN {0} ~ '.*(industr|warehouse|manufact|automobile).*' THEN 'industrial'
  WHEN {0} ~ '.*(commerc|retail|office|store|furniture).*' THEN 'commercial'
  WHEN {0} ~ '.*(resid|dwelling|family|condo|apartment|household|building).*' THEN 'residential' ELSE 'other' END"""


# Longest values of the other text columns, and what they come from in the raw layer (nothing: always null there).
LENGTH_RULES = "\n".join(
    f"UNION ALL SELECT '{name} longer than {length}', " + (f"count(*) FILTER (WHERE length({source[0]}) > {length}) FROM parcel" if source else "0")
    for name, length, *source in (
        ("parcel_id_alt", 100, "parcelid2"), ("tax_account_num", 50), ("use_code", 20, "usecode"), ("use_description", 255, "usedesc"),
        ("zoning_code", 50, "zoningcode"), ("zoning_description", 255), ("owner_name", 255, "ownername"), ("owner_address", 500),
        ("owner_city", 100), ("owner_state", 50), ("owner_zip", 20), ("parcel_address", 500, "parceladdr"), ("parcel_city", 100, "parcelcity"),
        ("parcel_state", 50), ("parcel_zip", 20), ("plss_township", 20), ("plss_section", 20), ("plss_quarter_section", 20), ("plss_range", 20),
        ("plss_description", 255), ("plat_book", 50), ("plat_page", 50), ("plat_block", 50), ("plat_lot", 50), ("source_version", 20, "lrversion"),
    )
)


def _pct(column: str) -> str:
    """100 * count / rows to one decimal in integer arithmetic."""
    return f"CAST((2000 * count({column}) + count(*)) // (2 * count(*)) AS DOUBLE) / 10"


def _trigrams(text: str) -> str:
    words = f"list_filter(regexp_split_to_array(lower({text}), '[^a-z0-9]+'), lambda w: w <> '')"
    grams = (
        f"list_transform({words}, lambda w: list_transform(generate_series(1, length(w) + 1),"
        " lambda i: substr('  ' || w || ' ', i, 3)))"
    )
    return f"list_distinct(flatten({grams}))"


def _search(column: str, pattern: str, term: str) -> str:
    return f"""
WITH {PARCEL},
hit AS (SELECT parcel_id, geoid, {column}, {_trigrams(column)} AS a, {_trigrams("'" + term + "'")} AS b
        FROM parcel WHERE {column} ILIKE '{pattern}'),
scored AS (SELECT *, len(list_intersect(a, b)) AS shared FROM hit),
near AS (SELECT *, CAST(shared AS DOUBLE) / (len(a) + len(b) - shared) AS s FROM scored)
SELECT parcel_id, geoid, {column}, round(s, 6) AS similarity FROM near
ORDER BY s DESC, parcel_id, geoid LIMIT 100"""


def _tile_x(lon: str, z: str = "z") -> str:
    return f"least(greatest(floor(({lon} + 180.0) / 360.0 * pow(2.0, {z})), 0), pow(2.0, {z}) - 1)::INTEGER"


def _tile_y(lat: str, z: str = "z") -> str:
    phi = f"radians({lat})"
    north = f"(1.0 - ln(tan({phi}) + 1.0 / cos({phi})) / pi()) / 2.0"
    return f"least(greatest(floor({north} * pow(2.0, {z})), 0), pow(2.0, {z}) - 1)::INTEGER"


def _tiles(source: str, columns: str, low: int, high: int, keep: str = "true", box: tuple[str, ...] = ()) -> str:
    """Tile rows of square features: a square meets every tile its box meets."""
    x0, y0, x1, y1 = box or ("xmin", "ymin", "xmax", "ymax")
    return f"""
spread AS (
  SELECT {columns}, z, {_tile_x(x0)} AS tx0, {_tile_x(x1)} AS tx1, {_tile_y(y1)} AS ty0, {_tile_y(y0)} AS ty1
  FROM {source}, (SELECT CAST(unnest(generate_series({low}, {high})) AS INTEGER) AS z) WHERE {keep}),
tile AS (
  SELECT {columns}, z, CAST(x AS INTEGER) AS x, CAST(unnest(generate_series(ty0, ty1)) AS INTEGER) AS y
  FROM (SELECT *, unnest(generate_series(tx0, tx1)) AS x FROM spread))"""


def _tile_bounds(z: int, x: int, y: int) -> tuple[float, float, float, float]:
    def lat(row: int) -> float:
        return math.degrees(math.atan(math.sinh(math.pi * (1 - 2 * row / 2**z))))

    return x / 2**z * 360 - 180, lat(y + 1), (x + 1) / 2**z * 360 - 180, lat(y)


def _hilbert() -> str:
    """The usual bit-by-bit walk along the curve, one subquery per bit."""
    sql = """
  SELECT lrid, CAST(floor(((xmin + xmax) / 2 + 180.0) / 360.0 * 65535.0) AS BIGINT) AS x,
         CAST(floor(((ymin + ymax) / 2 + 90.0) / 180.0 * 65535.0) AS BIGINT) AS y, CAST(0 AS BIGINT) AS d FROM raw"""
    for bit in range(15, -1, -1):
        s = 1 << bit
        sql = f"""
  SELECT lrid, CASE WHEN ry = 0 THEN CASE WHEN rx = 1 THEN 65535 - y ELSE y END ELSE x END AS x,
         CASE WHEN ry = 0 THEN CASE WHEN rx = 1 THEN 65535 - x ELSE x END ELSE y END AS y,
         d + {s}::BIGINT * {s}::BIGINT * xor(3 * rx, ry) AS d
  FROM (SELECT *, (x // {s}) % 2 AS rx, (y // {s}) % 2 AS ry FROM ({sql}))"""
    return sql


def _color() -> str:
    stops = [(0, "#3b82f6"), (100000, "#6366f1"), (500000, "#8b5cf6"), (2000000, "#f59e0b"), (10000000, "#ef4444")]
    channels = []
    for at in (1, 3, 5):
        levels = [int(c[at : at + 2], 16) for _, c in stops]
        cases = [f"WHEN totalvalue <= {stops[0][0]} THEN {levels[0]}.0"]
        for (a, la), (b, lb) in zip(zip([s for s, _ in stops], levels), zip([s for s, _ in stops[1:]], levels[1:])):
            cases.append(
                f"WHEN totalvalue < {b} THEN {la}::DOUBLE + (totalvalue - {a})::DOUBLE * {lb - la} / {b - a}::DOUBLE"
            )
        channels.append(
            f"format('{{:02x}}', CAST(floor((CASE {' '.join(cases)} ELSE {levels[-1]} END)::DOUBLE + 0.5) AS BIGINT))"
        )
    return f"CASE WHEN totalvalue IS NULL THEN '#6366f1' ELSE '#' || {' || '.join(channels)} END"


def _share(zoom: int) -> str:
    return repr(2.5 ** -(16 - zoom))


def _tile_lat(row: str) -> str:
    return f"degrees(atan(sinh(pi() * (1 - 2 * ({row}) / pow(2, z)))))"


THIN_KEEP = f"{DRAW} < CASE z " + " ".join(f"WHEN {z} THEN {_share(z)}::DOUBLE" for z in range(10, 17)) + " END"
THINNED = _tiles("raw", "lrid", 10, 16, THIN_KEEP)
TX0, TY0, TX1, TY1 = _tile_bounds(8, 68, 103)

ORACLES: dict[str, str] = {
    "normalize_dedup": f"""
WITH {PARCEL}
SELECT parcel_id, parcelid2 AS parcel_id_alt, geoid, taxyear::SMALLINT AS tax_year, use_code, use_description,
  zoning_code, numbldgs::SMALLINT AS num_buildings, year_built::SMALLINT AS year_built, building_sqft, total_value,
  CAST(CAST(assdacres AS DECIMAL(10, 4)) AS DOUBLE) AS assessed_acres, sale_amount,
  CAST(CAST(saledate AS DATE) AS VARCHAR) AS sale_date, owner_name, parcel_address, parcelcity AS parcel_city,
  legal_description, CAST(CAST(updated AS DATE) AS VARCHAR) AS source_updated, lrversion AS source_version,
  round(centroidx, 6) AS lon, round(centroidy, 6) AS lat,
  CASE WHEN surfpointx IS NOT NULL THEN round(surfpointx, 6) END AS surface_lon,
  CASE WHEN surfpointx IS NOT NULL THEN round(surfpointy, 6) END AS surface_lat
FROM parcel""",
    "parcel_full": f"""
WITH {PARCEL}, {COUNTIES}, {STATES}
SELECT parcel_id, p.geoid, total_value, state_name, state_abbr, county_name
FROM parcel p JOIN states s ON substring(p.geoid, 1, 2) = s.statefp LEFT JOIN counties c ON p.geoid = c.geoid""",
    "parcel_coverage": f"""
WITH {PARCEL}, {COUNTIES}, {STATES}
SELECT substring(p.geoid, 1, 2) AS statefp, substring(p.geoid, 3, 3) AS countyfp, p.geoid, state_abbr, county_name,
  count(*) AS total_parcels, {_pct("parcel_address")} AS pct_address, {_pct("owner_name")} AS pct_owner,
  {_pct("total_value")} AS pct_value, {_pct("year_built")} AS pct_yearbuilt, {_pct("use_description")} AS pct_usedesc,
  {_pct("sale_amount")} AS pct_saleamt, {_pct("building_sqft")} AS pct_bldgsqft, {_pct("zoning_code")} AS pct_zoning,
  {_pct("legal_description")} AS pct_legal
FROM parcel p JOIN states s ON substring(p.geoid, 1, 2) = s.statefp LEFT JOIN counties c ON p.geoid = c.geoid
GROUP BY p.geoid, state_abbr, county_name""",
    "cast_failures": f"""
WITH {RAW}
SELECT lrid, 'numunits' AS "column", CAST((lrid * 7) % 100000 AS VARCHAR) AS value
FROM raw WHERE (lrid * 7) % 100000 > 32767
UNION ALL SELECT lrid, 'saledate', 'day ' || CAST(lrid AS VARCHAR) FROM raw WHERE lrid % 10 = 3""",
    "fips_summary": f"""
WITH {RAW}
SELECT statefp || countyfp AS fips, count(*) AS parcels, count(parceladdr) AS has_address,
  count(totalvalue) AS has_value, count(ownername) AS has_owner FROM raw GROUP BY statefp || countyfp""",
    "ad_hoc_sql": f"""
WITH {RAW} SELECT usedesc, count(*) AS parcels, max(totalvalue) AS max_value FROM raw GROUP BY usedesc""",
    "state_counts": f"WITH {RAW} SELECT statefp AS state, count(*) AS parcels FROM raw GROUP BY statefp",
    "county_counts": f"WITH {RAW} SELECT countyfp AS county, count(*) AS n FROM raw GROUP BY countyfp",
    "county_value_top10": f"""
WITH {RAW} SELECT countyfp, count(*) AS n, CAST(sum(totalvalue) AS BIGINT) AS total_assessed FROM raw
GROUP BY countyfp ORDER BY n DESC, countyfp LIMIT 10""",
    "state_value_totals": f"""
WITH {RAW} SELECT statefp, count(*) AS n, CAST(sum(totalvalue) AS BIGINT) AS total_assessed FROM raw GROUP BY statefp""",
    "county_medians": f"""
WITH {RAW} SELECT countyfp, count(*) AS n, round(median(totalvalue), 4) AS median_totalvalue,
  round(median(assdacres), 4) AS median_assdacres FROM raw GROUP BY countyfp""",
    "county_extents": f"WITH {RAW} SELECT statefp, countyfp, {EXTENT}, count(*) AS n FROM raw GROUP BY statefp, countyfp",
    "table_extent": f"""
WITH {RAW}, e AS (SELECT {EXTENT}, count(*) AS n FROM raw)
SELECT *, format('{{:.2f}}, {{:.2f}} .. {{:.2f}}, {{:.2f}}', xmin, ymin, xmax, ymax) AS extent FROM e""",
    "bbox_count": f"WITH {RAW} SELECT count(*) AS parcels FROM raw WHERE statefp = '13' AND {METRO}",
    "bbox_search": f"""
WITH {PARCEL}, hit AS (SELECT * FROM parcel WHERE {SEARCH} ORDER BY parcel_id, geoid LIMIT 1000)
SELECT parcel_id, geoid, total_value, {BOX} FROM hit""",
    "bbox_filter_query": f"""
WITH {PARCEL} SELECT parcel_id, geoid, use_description, total_value FROM parcel
WHERE {SEARCH} AND use_description IN ('building', 'household') AND total_value BETWEEN 100000 AND 300000
  AND parcelcity = 'Springfield' ORDER BY parcel_id, geoid LIMIT 500""",
    "polygon_filter": f"WITH {PARCEL} SELECT parcel_id, geoid FROM parcel WHERE {L_SHAPE}",
    "parcel_detail": f"""
WITH {PARCEL}, {COUNTIES}, {STATES}
SELECT parcel_id, p.geoid, owner_name, state_abbr, county_name
FROM parcel p JOIN states s ON substring(p.geoid, 1, 2) = s.statefp LEFT JOIN counties c ON p.geoid = c.geoid
WHERE parcel_id = 'P42'""",
    "search_address": _search("parcel_address", "%peachtree st 1%", "peachtree st 1"),
    "search_owner": _search("owner_name", "%customer#%001%", "customer#%001"),
    "cross_border_filter": f"""
WITH {RAW} SELECT lrid, statefp, countyfp FROM raw
WHERE statefp = '37' AND xmin <= -75.46 AND xmax >= -84.32 AND ymin <= 36.59 AND ymax >= 33.84""",
    "all_states_extract": f"""
WITH {RAW}, far AS (SELECT *, CASE WHEN lrid % 9 = 4 THEN '02' ELSE statefp END AS s FROM raw)
SELECT s AS statefp, countyfp, count(*) AS n FROM far LEFT JOIN st ON fips = s
WHERE fips IS NULL OR (xmin <= x1 AND xmax >= x0 AND ymin <= y1 AND ymax >= y0) GROUP BY s, countyfp""",
    "box_extract": f"WITH {RAW} SELECT lrid, statefp FROM raw WHERE {SEARCH}",
    "county_selection": f"""
WITH {RAW} SELECT lrid, parcelid, totalvalue FROM raw WHERE statefp = '13' AND countyfp = '001'""",
    "high_value_metro": f"""
WITH {RAW} SELECT lrid, parcelid, parceladdr, totalvalue, yearbuilt, usedesc,
  round((xmin + xmax) / 2, 6) AS lon, round((ymin + ymax) / 2, 6) AS lat
FROM raw WHERE countyfp IN ('001', '011', '021', '031', '041') AND totalvalue > 300000
ORDER BY totalvalue DESC, lrid LIMIT 1000""",
    "large_parcels": f"""
WITH {RAW} SELECT lrid, parcelid, statefp, countyfp, usedesc, assdacres AS acres, totalvalue FROM raw
WHERE assdacres IS NOT NULL AND assdacres > 1.0""",
    "sale_range": f"""
WITH {PARCEL} SELECT parcel_id, geoid, year_built::SMALLINT AS year_built,
  CAST(CAST(saledate AS DATE) AS VARCHAR) AS sale_date FROM parcel
WHERE CAST(saledate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' AND year_built < 1960""",
    "edge_profile": """
SELECT count(*) AS total_edges, count(DISTINCT event_type) AS mtfcc_types,
  count(*) FILTER (WHERE value > 10) AS road_edges, '13121' AS fips FROM events""",
    "encoding_profile": f"""
WITH {RAW} SELECT count(*) AS n, round(min(xmin), 6) AS xmin, round(max(xmax), 6) AS xmax FROM raw""",
    "hilbert_order": f"WITH {RAW}, h AS ({_hilbert()}) SELECT lrid, CAST(d AS BIGINT) AS hilbert FROM h",
    "union_by_name": f"""
WITH {RAW} SELECT lrid, statefp, totalvalue, NULL::INTEGER AS yearbuilt FROM raw WHERE statefp IN ('12', '13', '48')
UNION ALL BY NAME SELECT statefp, lrid, yearbuilt FROM raw WHERE statefp = '37'
UNION ALL BY NAME SELECT lrid, statefp, yearbuilt, totalvalue FROM raw WHERE statefp = '06'""",
    "pip_enrich": f"""
WITH {RAW}, {ZONES} SELECT lrid, zone_id FROM raw JOIN zone
ON centroidx >= zx0 AND centroidx < zx1 AND centroidy >= zy0 AND centroidy < zy1""",
    "sheared_pip": f"""
WITH {RAW}, {ZONES}, spot AS (SELECT lrid, centroidx + 0.0000137 AS px, centroidy + 0.0000191 AS py FROM raw)
SELECT lrid, zone_id FROM spot JOIN zone ON px >= zx0 AND px < zx1 AND py >= zy0 AND py < zy1""",
    "overlap_share": f"""
WITH {RAW}, {ZONES}, o AS (
  SELECT lrid, zone_id, (least(xmax, zx1) - greatest(xmin, zx0)) * (least(ymax, zy1) - greatest(ymin, zy0)) AS a,
    (xmax - xmin) * (ymax - ymin) AS whole
  FROM raw JOIN zone ON xmin < zx1 AND xmax > zx0 AND ymin < zy1 AND ymax > zy0)
SELECT lrid, zone_id, round(a / whole, 5) AS share FROM o""",
    "zone_members": f"WITH {RAW}, {ZONES} SELECT DISTINCT lrid, statefp FROM raw JOIN zone ON {ZONE_MEETS}",
    "adjacent_parcels": f"""
WITH {LOTS}, target AS (SELECT DISTINCT c, r FROM lot WHERE p_brand = 'Brand#13'),
near AS (SELECT c + dc AS c, r + dr AS r FROM target, (VALUES (-1, -1), (-1, 0), (-1, 1), (0, -1), (0, 1), (1, -1),
  (1, 0), (1, 1)) d(dc, dr))
SELECT lot_id, p_brand FROM lot WHERE (c, r) IN (SELECT c, r FROM near)""",
    "footprint_containment": f"""
WITH {LOTS}, b AS (
  SELECT lot_id AS building_id, c, r, CAST((lot_id * 13) % 100 AS DOUBLE) / 100 AS dx,
    CAST((lot_id * 29) % 100 AS DOUBLE) / 100 AS dy FROM lot)
SELECT building_id, lot_id FROM b JOIN lot USING (c, r) WHERE dx + 0.305 <= 1 AND dy + 0.305 <= 1""",
    "dissolved_boundary": f"""
WITH {LOTS}, cell AS (SELECT DISTINCT p_brand, c, r FROM lot),
side AS (
  SELECT p_brand, c AS c1, r AS r1, c + 1 AS c2, r AS r2 FROM cell
  UNION ALL SELECT p_brand, c, r + 1, c + 1, r + 1 FROM cell
  UNION ALL SELECT p_brand, c, r, c, r + 1 FROM cell
  UNION ALL SELECT p_brand, c + 1, r, c + 1, r + 1 FROM cell),
outer_side AS (SELECT p_brand, c1, r1, c2, r2 FROM side GROUP BY ALL HAVING count(*) % 2 = 1)
SELECT p_brand, round(-84.5::DOUBLE + c1 * 0.0005::DOUBLE, 5) AS x1, round(31.0::DOUBLE + r1 * 0.0005::DOUBLE, 5) AS y1,
  round(-84.5::DOUBLE + c2 * 0.0005::DOUBLE, 5) AS x2, round(31.0::DOUBLE + r2 * 0.0005::DOUBLE, 5) AS y2
FROM outer_side""",
    "dissolved_polygons": """
WITH RECURSIVE cell AS (SELECT p_size % 2 AS odd, p_partkey % 61 + 61 * (p_partkey // 3050000) AS c, (p_partkey // 61) % 50000 AS r FROM part),
reach AS (
  SELECT odd, c, r, c AS c2, r AS r2 FROM cell
  UNION SELECT reach.odd, reach.c, reach.r, n.c, n.r FROM reach JOIN cell n ON n.odd = reach.odd AND abs(n.c - c2) + abs(n.r - r2) = 1),
member AS (SELECT odd, c, r, min(r2 * 1000000 + c2) AS shape FROM reach GROUP BY odd, c, r),
around AS (SELECT odd, shape, c + dc AS x, r + dr AS y, c, r FROM member, (VALUES (0, 0), (1, 0), (0, 1), (1, 1)) d(dc, dr)),
point AS (SELECT odd, shape, x, y, count(*) AS n, max(c) > min(c) AND max(r) > min(r) AS across FROM around GROUP BY odd, shape, x, y),
v AS (SELECT odd, shape, count(*) AS v, sum(CASE WHEN n IN (1, 3) THEN 1 WHEN n = 2 AND across THEN 2 ELSE 0 END) AS corners FROM point GROUP BY odd, shape),
side AS (
  SELECT odd, shape, c, r, 'h' AS way FROM member UNION SELECT odd, shape, c, r + 1, 'h' FROM member
  UNION SELECT odd, shape, c, r, 'v' FROM member UNION SELECT odd, shape, c + 1, r, 'v' FROM member),
e AS (SELECT odd, shape, count(*) AS e FROM side GROUP BY odd, shape),
f AS (SELECT odd, shape, count(*) AS f, min(c) AS c, min(r) AS r FROM member GROUP BY odd, shape)
SELECT odd, round(-84.5::DOUBLE + c * 0.0005::DOUBLE, 5) AS xmin, round(31.0::DOUBLE + r * 0.0005::DOUBLE, 5) AS ymin, CAST(f AS DOUBLE) AS lots,
  CAST(2 - (v - e + f) AS INTEGER) AS rings, CAST(corners AS INTEGER) AS corners
FROM f JOIN e USING (odd, shape) JOIN v USING (odd, shape)""",
    "raster_sample": f"""
WITH {RAW}, px AS (
  SELECT event_id // 40 AS row, event_id % 40 AS col, avg(value) AS value FROM events GROUP BY 1, 2),
spot AS (SELECT lrid, CAST(floor((50.0 - centroidy) / 1.0) AS BIGINT) AS row,
  CAST(floor((centroidx + 125.0) / 1.5) AS BIGINT) AS col FROM raw)
SELECT lrid, s.row, s.col, round(round(value, 4), 3) AS value FROM spot s LEFT JOIN px ON px.row = s.row AND px.col = s.col""",
    "property_match": f"""
WITH {RAW}, prop AS (
  SELECT c_custkey AS pid, CASE WHEN c_custkey % 3 = 0 THEN 'P' || CAST(c_custkey * 2 AS VARCHAR) END AS ref,
    CAST(100 + c_custkey % 900 AS VARCHAR) || ' peachtree st ' || CAST(c_custkey % 40 AS VARCHAR) AS addr FROM customer),
by_ref AS (SELECT ref, min(pid) AS p, count(*) AS n FROM prop WHERE ref IS NOT NULL GROUP BY ref),
by_addr AS (SELECT addr, min(pid) AS p, count(*) AS n FROM prop GROUP BY addr)
SELECT lrid, parcelid, parceladdr, coalesce(i.p, a.p) AS property_id,
  CASE WHEN i.p IS NOT NULL THEN 'id' WHEN a.p IS NOT NULL THEN 'address' END AS match_kind,
  CASE WHEN i.p IS NOT NULL THEN i.n WHEN a.p IS NOT NULL THEN a.n END AS candidates
FROM raw LEFT JOIN by_ref i ON ref = parcelid LEFT JOIN by_addr a ON addr = lower(parceladdr)""",
    "property_match_fuzzy": f"""
WITH {RAW}, prop AS (
  SELECT c_custkey AS pid, CASE WHEN c_custkey % 5 = 0 THEN 'P' || CAST(c_custkey * 2 AS VARCHAR) END AS ref, countyfp,
    CAST(100 + c_custkey % 900 AS VARCHAR) || CASE c_custkey % 4 WHEN 1 THEN ' peechtree st ' WHEN 2 THEN ' peachtree street ' WHEN 3 THEN ' peach tree st'
      ELSE ' peachtree st ' END || CASE WHEN c_custkey % 4 = 3 THEN '' ELSE CAST(c_custkey % 40 AS VARCHAR) END AS addr
  FROM customer JOIN nat ON n_nationkey = c_nationkey),
by_ref AS (SELECT ref, min(pid) AS p, count(*) AS n FROM prop WHERE ref IS NOT NULL GROUP BY ref),
by_addr AS (SELECT addr, min(pid) AS p, count(*) AS n FROM prop GROUP BY addr),
first AS (SELECT lrid, countyfp, parcelid, parceladdr, coalesce(i.p, a.p) AS p, CASE WHEN i.p IS NOT NULL THEN 'id' WHEN a.p IS NOT NULL THEN 'address' END AS kind,
    CASE WHEN i.p IS NOT NULL THEN i.n WHEN a.p IS NOT NULL THEN a.n END AS n
  FROM raw LEFT JOIN by_ref i ON ref = parcelid LEFT JOIN by_addr a ON addr = lower(parceladdr)),
asked AS (SELECT *, {_trigrams('addr')} AS g FROM (SELECT DISTINCT countyfp, lower(parceladdr) AS addr FROM first WHERE kind IS NULL AND parceladdr IS NOT NULL)),
known AS (SELECT *, {_trigrams('addr')} AS g FROM (SELECT countyfp, addr, min(pid) AS p, count(*) AS n FROM prop GROUP BY countyfp, addr)),
pair AS (SELECT a.countyfp, a.addr, k.p, k.n, len(list_intersect(a.g, k.g)) AS common, len(a.g) + len(k.g) AS total
  FROM asked a JOIN known k USING (countyfp)),
near AS (SELECT *, CAST(common AS DOUBLE) / (total - common) AS s FROM pair WHERE common * 100 >= (total - common) * 55),
best AS (SELECT countyfp, addr, s, min(p) AS p, CAST(sum(n) AS BIGINT) AS n FROM near GROUP BY countyfp, addr, s
  QUALIFY row_number() OVER (PARTITION BY countyfp, addr ORDER BY s DESC) = 1)
SELECT lrid, f.countyfp, parcelid, parceladdr, coalesce(f.p, b.p) AS property_id, coalesce(kind, CASE WHEN b.p IS NOT NULL THEN 'similar' END) AS match_kind,
  coalesce(f.n, b.n) AS candidates, CASE WHEN kind IS NULL THEN round(s, 6) END AS similarity
FROM first f LEFT JOIN best b ON kind IS NULL AND b.countyfp = f.countyfp AND b.addr = lower(parceladdr)""",
    "use_code_lookup": f"""
WITH {PARCEL}, n AS (SELECT use_code, use_description, count(*) AS n_rows FROM parcel GROUP BY 1, 2),
best AS (SELECT *, row_number() OVER (PARTITION BY use_code ORDER BY n_rows DESC, use_description) AS rk FROM n)
SELECT use_code, use_description, n_rows, {CATEGORY.format("use_description")} AS use_category FROM best WHERE rk = 1""",
    "land_use_summary": f"""
WITH {PARCEL}, n AS (SELECT use_code, use_description, count(*) AS n_rows FROM parcel GROUP BY 1, 2),
best AS (SELECT *, row_number() OVER (PARTITION BY use_code ORDER BY n_rows DESC, use_description) AS rk FROM n),
code AS (SELECT use_code, {CATEGORY.format("use_description")} AS category_name FROM best WHERE rk = 1),
cat(category_id, category_name) AS (VALUES (1, 'residential'), (2, 'commercial'), (3, 'industrial'),
  (4, 'agricultural'), (5, 'vacant'), (6, 'exempt'), (7, 'mixed_use'), (8, 'other'))
SELECT category_name, count(*) AS n, CAST(sum(total_value) AS BIGINT) AS total_value, category_id
FROM parcel JOIN code USING (use_code) JOIN cat USING (category_name) GROUP BY category_name, category_id""",
    "tile_assign": f"""
WITH {RAW} SELECT lrid, 16 AS z, {_tile_x("centroidx", "16")} AS x, {_tile_y("centroidy", "16")} AS y FROM raw""",
    "tile_counts": f"WITH {RAW}, {_tiles('raw', 'lrid', 12, 16)} SELECT z, x, y, count(*) AS features FROM tile GROUP BY z, x, y",
    "tile_thinned": f"WITH {RAW}, {THINNED} SELECT lrid, z, x, y FROM tile",
    "tile_stats": f"""
WITH {RAW}, {THINNED}, n AS (SELECT z, x, y, count(*) AS features FROM tile GROUP BY z, x, y)
SELECT z, count(*) AS tiles, CAST(sum(features) AS BIGINT) AS features,
  round(sum(features)::DOUBLE / count(*), 6) AS avg_features, max(features) AS max_features,
  round(quantile_cont(features::DOUBLE, 0.5), 6) AS median_features, round(quantile_cont(features::DOUBLE, 0.95), 6) AS p95_features
FROM n GROUP BY z""",
    "tile_clipped": f"""
WITH {RAW} SELECT lrid, CAST(z AS INTEGER) AS z, round((xmax - xmin) * (ymax - ymin) * 1e6::DOUBLE, 4) AS area_e6
FROM raw, range(12, 17) t(z)""",
    "national_tiles": f"""
WITH {RAW}, {_tiles('raw', 'lrid, statefp, xmin, ymin, xmax, ymax', 10, 16, THIN_KEEP)},
part AS (SELECT z, x, y, statefp, (least(xmax, (x + 1) / pow(2, z) * 360 - 180) - greatest(xmin, x / pow(2, z) * 360 - 180))
  * (least(ymax, {_tile_lat('y')}) - greatest(ymin, {_tile_lat('y + 1')})) AS area FROM tile)
SELECT z, x, y, count(*) AS features, count(DISTINCT statefp) AS states, round(sum(area) * 1e6::DOUBLE, 3) AS area_e6 FROM part GROUP BY z, x, y""",
    "tile_files": f"""
WITH {RAW}, {ZONES}, {_tiles('zone', 'zone_id, zx0, zy0, zx1, zy1', 0, 12, box=('zx0', 'zy0', 'zx1', 'zy1'))}
SELECT z, x, y, zone_id, round((least(zx1, (x + 1) / pow(2, z) * 360 - 180) - greatest(zx0, x / pow(2, z) * 360 - 180))
  * (least(zy1, {_tile_lat('y')}) - greatest(zy0, {_tile_lat('y + 1')})), 7) AS area FROM tile""",
    "tile_generalized": f"""
WITH {LOTS}, z AS (SELECT CAST(unnest(generate_series(9, 16)) AS INTEGER) AS z),
side AS (
  SELECT lot_id, c, r, 'h' AS way FROM lot UNION ALL SELECT lot_id, c, r + 1, 'h' FROM lot
  UNION ALL SELECT lot_id, c, r, 'v' FROM lot UNION ALL SELECT lot_id, c + 1, r, 'v' FROM lot),
bend AS (SELECT *, 0.0005::DOUBLE * 0.0005 / pow(2.0, 3 + (c * 7 + r * 3 + CASE WHEN way = 'v' THEN 5 ELSE 0 END) % 16) AS weight FROM side),
shown AS (SELECT z, lot_id, c, r, way, CAST(weight >= pow(360.0 / pow(2.0, z) / 4096, 2) AS INTEGER) AS bent FROM bend, z),
rim AS (SELECT z, c, r, way, any_value(bent) AS bent FROM shown GROUP BY z, c, r, way HAVING count(*) = 1),
outer_sides AS (SELECT z, CAST(sum(1 + bent) AS BIGINT) AS rim_sides FROM rim GROUP BY z)
SELECT z, count(DISTINCT lot_id) AS lots, CAST(count(*) + sum(bent) AS BIGINT) AS vertices, any_value(rim_sides) AS rim_sides
FROM shown JOIN outer_sides USING (z) GROUP BY z""",
    "tile_largest": f"""
WITH {RAW}, {_tiles('raw', 'lrid, assdacres', 7, 9)},
ranked AS (SELECT *, row_number() OVER (PARTITION BY z, x, y ORDER BY assdacres DESC, lrid) AS rk FROM tile)
SELECT z, x, y, lrid, assdacres FROM ranked WHERE rk <= 3""",
    "large_parcel_tiles": f"""
WITH {RAW}, big AS (SELECT * FROM raw WHERE assdacres > 1.0), {_tiles('big', 'lrid', 8, 14)}
SELECT z, x, y, count(*) AS features FROM tile GROUP BY z, x, y""",
    "boundary_tiles": f"""
WITH {RAW}, {ZONES}, {_tiles('zone', 'zone_id', 0, 12, box=('zx0', 'zy0', 'zx1', 'zy1'))}
SELECT z, x, y, count(*) AS features FROM tile GROUP BY z, x, y""",
    "tile_layers": f"""
WITH {RAW}, {ZONES},
shape AS (
  SELECT 'county-boundaries' AS layer, 10 AS z0, 11 AS z1, zx0 AS xmin, zy0 AS ymin, zx1 AS xmax, zy1 AS ymax FROM zone
  UNION ALL SELECT 'centroids', 10, 11, centroidx, centroidy, centroidx, centroidy FROM raw
  UNION ALL SELECT 'polygons', 12, 13, xmin, ymin, xmax, ymax FROM raw),
{_tiles('shape', 'layer', 10, 13, 'z BETWEEN z0 AND z1')}
SELECT layer, z, count(*) AS n, count(DISTINCT (x, y)) AS tiles FROM tile GROUP BY layer, z""",
    "tile_request": f"""
WITH {PARCEL} SELECT parcel_id, geoid, total_value, year_built::SMALLINT AS year_built FROM parcel
WHERE xmin <= {TX1!r} AND xmax >= {TX0!r} AND ymin <= {TY1!r} AND ymax >= {TY0!r}""",
    "centroid_request": f"""
WITH {PARCEL} SELECT parcel_id, geoid, total_value, round(centroidx, 6) AS lon, round(centroidy, 6) AS lat FROM parcel
WHERE centroidx BETWEEN {TX0!r} AND {TX1!r} AND centroidy BETWEEN {TY0!r} AND {TY1!r}""",
    "packed_tiles": f"""
WITH {RAW}, {_tiles('raw', 'lrid, totalvalue', 8, 10)} SELECT z, x, y, lrid, totalvalue FROM tile""",
    "cell_summary": f"""
WITH {RAW} SELECT CAST(floor(centroidx / 0.5) AS BIGINT) AS cell_x, CAST(floor(centroidy / 0.5) AS BIGINT) AS cell_y,
  count(*) AS n, CAST(sum(totalvalue) AS BIGINT) AS sum_totalvalue, round(median(totalvalue), 4) AS median
FROM raw GROUP BY 1, 2""",
    "cell_partitions": f"""
WITH {RAW} SELECT CAST({_tile_x("(xmin + xmax) / 2", "6")} AS VARCHAR) || '-' || CAST({_tile_y("(ymin + ymax) / 2", "6")} AS VARCHAR)
  AS cell, count(*) AS n FROM raw GROUP BY 1""",
    "value_classes": f"""
WITH {RAW} SELECT CAST(CASE WHEN totalvalue >= 10000000 THEN 10000000 WHEN totalvalue >= 2000000 THEN 2000000
  WHEN totalvalue >= 500000 THEN 500000 WHEN totalvalue >= 100000 THEN 100000 WHEN totalvalue IS NOT NULL THEN 0 END
  AS BIGINT) AS class_from, count(*) AS n FROM raw GROUP BY 1""",
    "value_colors": f"WITH {RAW} SELECT lrid, {_color()} AS color FROM raw",
    "popup_fields": f"""
WITH {RAW} SELECT lrid, coalesce(nullif(parceladdr, ''), 'No address') AS address,
  coalesce(nullif(ownername, ''), 'Unknown') AS owner, coalesce('$' || format('{{:,}}', nullif(totalvalue, 0)), 'N/A') AS value,
  coalesce(nullif(usedesc, ''), 'N/A') AS use, coalesce(parceladdr, '') AS label FROM raw""",
    "geometry_measures": f"""
WITH {RAW} SELECT lrid, round((xmax - xmin) * (ymax - ymin) * 1e6::DOUBLE, 4) AS area_e6, round((xmin + xmax) / 2, 6) AS lon,
  round((ymin + ymax) / 2, 6) AS lat, 5 AS vertices,
  format('MULTIPOLYGON ((({{0:.7f}} {{1:.7f}}, {{2:.7f}} {{1:.7f}}, {{2:.7f}} {{3:.7f}}, {{0:.7f}} {{3:.7f}}, {{0:.7f}} {{1:.7f}})))',
    xmin, ymin, xmax, ymax) AS wkt FROM raw""",
    "vertex_profile": f"""
WITH {RAW} SELECT statefp, count(*) AS n, 5 AS min_vertices, 5.0::DOUBLE AS avg_vertices, 5 AS max_vertices FROM raw GROUP BY statefp""",
    "reprojected": f"""
WITH {RAW}, v AS (
  SELECT lrid, vertex, CASE WHEN vertex IN (1, 2) THEN xmax ELSE xmin END AS x, CASE WHEN vertex IN (2, 3) THEN ymax ELSE ymin END AS y
  FROM raw, (VALUES (0::INTEGER), (1), (2), (3), (4)) n(vertex))
SELECT lrid, vertex, round(radians(x) * 6378137.0::DOUBLE, 2) AS mx,
  round(ln(tan(pi() / 4 + radians(y) / 2)) * 6378137.0::DOUBLE, 2) AS my, round(x, 6) AS lon, round(y, 6) AS lat FROM v""",
    "simplified": f"""
WITH {RAW} SELECT lrid, 5 + CAST(lrid % 2 = 0 AS INTEGER) AS vertices,
  round(((xmax - xmin) * (ymax - ymin)
    + CASE WHEN lrid % 2 = 0 THEN 0.5 * (xmax - xmin) * (xmax - xmin) * 0.1 ELSE 0 END) * 1e6::DOUBLE, 4) AS area_e6 FROM raw""",
    "wkb_roundtrip": f"WITH {RAW} SELECT lrid, 5 AS vertices, {BOX} FROM raw",
    "geojson_features": f"WITH {RAW} SELECT lrid, parceladdr, totalvalue, {BOX} FROM raw",
    "layout_roundtrip": f"WITH {RAW} SELECT statefp AS state, countyfp AS county, lrid, totalvalue, {BOX} FROM raw",
    "incremental_counties": f"""
WITH {RAW} SELECT statefp AS state, countyfp AS county, count(*) AS n FROM raw GROUP BY statefp, countyfp""",
    "recovered_states": f"""
WITH {RAW} SELECT statefp AS state, countyfp AS county, count(*) AS n, CAST(sum(totalvalue) AS BIGINT) AS total, CAST(sum(lrid) AS BIGINT) AS keys
FROM raw GROUP BY statefp, countyfp""",
    "county_order": f"""
WITH {RAW} SELECT statefp AS state, countyfp AS county, count(*) AS n, count(*) AS in_order FROM raw GROUP BY statefp, countyfp""",
    "incremental_rebuild": f"""
WITH {RAW}, part AS (SELECT raw.* FROM raw JOIN st ON fips = statefp
  WHERE statefp = '37' AND raw.xmin <= x1 AND raw.xmax >= x0 AND raw.ymin <= y1 AND raw.ymax >= y0),
stay AS (SELECT * FROM part WHERE countyfp <> '023'), {_tiles('stay', 'lrid, countyfp', 12, 16)},
a AS (SELECT countyfp, count(*) AS n, CAST(sum(CASE WHEN countyfp = '013' THEN 1 ELSE totalvalue END) AS BIGINT) AS total FROM stay GROUP BY countyfp),
t AS (SELECT countyfp, count(*) AS tile_rows FROM tile GROUP BY countyfp),
b AS (SELECT DISTINCT countyfp, 'counties,tiles' AS rebuilt FROM part WHERE countyfp IN ('013', '023'))
SELECT countyfp AS county, n, total, tile_rows, rebuilt FROM a FULL JOIN t USING (countyfp) FULL JOIN b USING (countyfp)""",
    "raw_key_layout": f"WITH {RAW} SELECT statefp, countyfp, lrid, totalvalue FROM raw",
    "cell_layout": f"WITH {RAW} SELECT lrid, {BOX} FROM raw",
    "box_extract_files": f"WITH {RAW} SELECT lrid, statefp FROM raw WHERE {SEARCH}",
    "county_parallel_state": f"WITH {RAW} SELECT lrid, countyfp FROM raw WHERE statefp = '48'",
    "published_states": f"""
WITH {RAW} SELECT statefp AS state, lrid FROM raw JOIN st ON fips = statefp
WHERE xmin <= x1 AND xmax >= x0 AND ymin <= y1 AND ymax >= y0""",
    "incremental_state": f"""
WITH {RAW} SELECT countyfp AS county, count(*) AS n FROM raw JOIN st ON fips = statefp
WHERE statefp = '37' AND xmin <= x1 AND xmax >= x0 AND ymin <= y1 AND ymax >= y0 GROUP BY countyfp""",
    "owners_cleaned": f"WITH {PARCEL} SELECT parcel_id, geoid, upper(trim(owner_name)) AS owner_name FROM parcel",
    "created_rows": f"WITH {PARCEL} SELECT geoid, count(*) AS n, count(*) AS with_time FROM parcel GROUP BY geoid",
    "attribute_rows": f"WITH {RAW} SELECT lrid, statefp, usedesc, assdacres FROM raw",
    "manifest_extent": f"WITH {RAW} SELECT {EXTENT}, count(*) AS n FROM raw",
    "layout_overlap": f"""
WITH {RAW} SELECT count(*) AS n, true AS sorted_is_tight, true AS unsorted_is_wide FROM raw""",
    "partition_manifest": f"WITH {RAW} SELECT statefp AS state, count(*) AS n, {EXTENT} FROM raw GROUP BY statefp",
    "refreshed_version": f"""
WITH {PARCEL} SELECT geoid, count(*) AS n, CAST(sum(total_value) AS BIGINT) AS total_value FROM parcel GROUP BY geoid""",
    "dataset_inventory": "\nUNION ALL ".join(
        f"SELECT '{t}.parquet' AS name, 'parquet' AS format, count(*) AS n FROM {t}"
        for t in (
            "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
        ).split()
    ),
    "column_profile": f"WITH {RAW}\n" + "\nUNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{kind}' AS column_type, count({source}) AS non_null, "
        + (f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value" if kind not in ("double", "struct", "array") else "NULL AS min_value, NULL AS max_value")
        + " FROM raw"
        for i, (c, kind, source) in enumerate(((*x.split(":"), x.split(":")[0]) if x.count(":") == 1 else x.split(":") for x in (
            "lrid:bigint parcelid:string parcelid2:string statefp:string countyfp:string geoid:string taxyear:int usecode:string"
            " usedesc:string zoningcode:string numbldgs:int yearbuilt:int bldgsqft:int totalvalue:bigint assdacres:double"
            " saleamt:bigint saledate:timestamp_ntz ownername:string parceladdr:string parcelcity:string legaldesc:string updated:timestamp_ntz"
            " lrversion:string centroidx:double centroidy:double surfpointx:double surfpointy:double bbox:struct:xmin geom:array:xmin"
        ).split()), 1)
    ),
    "status_report": f"""
WITH {PARCEL}, {COUNTIES}, {LOTS}
SELECT 'parcel_raw' AS table_name, count(*) AS n, {EXTENT} FROM raw
UNION ALL SELECT 'parcel', count(*), {EXTENT} FROM parcel
UNION ALL SELECT 'counties', count(*), NULL, NULL, NULL, NULL FROM counties
UNION ALL SELECT 'lots', count(*), round(min(lx0), 6), round(min(ly0), 6), round(max(lx1), 6), round(max(ly1), 6) FROM lotbox""",
    "quality_report": f"""
WITH {PARCEL}, {COUNTIES}, {STATES}
SELECT 'parcel_id is null' AS rule, count(*) FILTER (WHERE parcel_id IS NULL) AS violations FROM parcel
UNION ALL SELECT 'parcel_id longer than 100', count(*) FILTER (WHERE length(parcel_id) > 100) FROM parcel
UNION ALL SELECT 'geoid is null', count(*) FILTER (WHERE geoid IS NULL) FROM parcel
UNION ALL SELECT 'geoid longer than 5', count(*) FILTER (WHERE length(geoid) > 5) FROM parcel
{LENGTH_RULES}
UNION ALL SELECT 'duplicate (geoid, parcel_id)', count(*) - count(DISTINCT (geoid, parcel_id)) FROM parcel
UNION ALL SELECT 'geoid not in counties', count(*) FROM parcel WHERE geoid NOT IN (SELECT geoid FROM counties)
UNION ALL SELECT 'county state not in states', count(*) FROM counties WHERE statefp NOT IN (SELECT statefp FROM states)""",
    "duplicate_keys": f"""
WITH {RAW} SELECT geoid, parcelid, count(*) AS n FROM raw GROUP BY geoid, parcelid HAVING count(*) > 1""",
    "unknown_counties": f"""
WITH {PARCEL}, {COUNTIES} SELECT geoid, count(*) AS n FROM parcel WHERE geoid NOT IN (SELECT geoid FROM counties) GROUP BY geoid""",
    "random_sample": f"WITH {RAW} SELECT lrid, statefp FROM raw ORDER BY {DRAW}, lrid LIMIT 500",
    "page_of_rows": f"WITH {RAW} SELECT lrid, geoid FROM raw ORDER BY lrid LIMIT 200 OFFSET 400",
    "page_after_key": f"WITH {RAW} SELECT lrid, geoid FROM raw WHERE lrid > 1000 ORDER BY lrid LIMIT 200",
    "number_matched": f"WITH {PARCEL} SELECT count(*) AS number_matched FROM parcel",
}

# Slanted shapes are linear images of the others: the same rows.
ORACLES |= {"sheared_overlap": ORACLES["overlap_share"], "sheared_adjacency": ORACLES["adjacent_parcels"]}
