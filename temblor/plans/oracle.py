"""DuckDB SQL for the registered queries, over the same tables.

Only constants are shared with the Spark side; the logic is written again in SQL.
"""

from __future__ import annotations

from temblor.functions import risk
from temblor.functions.regions import FLINN_ENGDAHL, UNITED_STATES_NAMES
from temblor.operators.clustering import RULE_TITLE
from temblor.operators.eda import NUMERIC_COLUMNS, SUMMARY_COLUMNS
from temblor.plans.quakes import QUAKES_SQL


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _round(expression: str, digits: int) -> str:
    """Rounded, without a negative zero."""
    return f"(CASE WHEN round({expression}, {digits}) = 0 THEN 0.0::DOUBLE ELSE round({expression}, {digits}) END)"


def _case(column: str, values: dict) -> str:
    whens = " ".join(f"WHEN {code} THEN {_text(text)}" for code, text in values.items())
    return f"CASE {column} {whens} END"


_SPHERE = {
    "x": "cos(radians(latitude)) * cos(radians(longitude))",
    "y": "cos(radians(latitude)) * sin(radians(longitude))",
    "z": "sin(radians(latitude))",
}
_DERIVED = "ln(1 + depth) AS depth_log, " + ", ".join(f"{e} AS {n}" for n, e in _SPHERE.items())
_DERIVED_ROUNDED = ", ".join(
    [f"{_round('ln(1 + depth)', 9)} AS depth_log"]
    + [f"{_round(e, 9)} AS {n}" for n, e in _SPHERE.items()]
)
_PRESENT = "latitude IS NOT NULL AND longitude IS NOT NULL AND depth IS NOT NULL AND mag IS NOT NULL"
_EVERYWHERE = "depth BETWEEN 0 AND 700 AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"
_VALID_EMSC = f"type = 'ke' AND {_PRESENT} AND {_EVERYWHERE} AND mag > 2.5 AND mag <= 10"
_VALID_USGS = f"type = 'ke' AND {_PRESENT} AND {_EVERYWHERE} AND mag BETWEEN -2 AND 10"


def _country_emsc(place: str) -> str:
    region = f"upper(trim(string_split({place}, ',')[-1]))"
    region = f"regexp_replace({region}, {_text(FLINN_ENGDAHL.prefix_pattern)}, '')"
    region = f"regexp_replace({region}, {_text(FLINN_ENGDAHL.suffix_pattern)}, '')"
    whens = " ".join(
        f"WHEN regexp_matches(r, {_text(pattern)}) THEN {_text(name)}"
        for name, pattern in FLINN_ENGDAHL.country_patterns
    )
    aliases = " ".join(
        f"WHEN {_text(alias)} THEN {_text(name)}" for alias, name in FLINN_ENGDAHL.aliases
    )
    aliased = f"(SELECT CASE r0 {aliases} ELSE r0 END AS r FROM (SELECT {region} AS r0))"
    return f"(SELECT CASE {whens} ELSE r END FROM {aliased})"


def _country_usgs(place: str) -> str:
    token = f"trim(string_split({place}, ',')[-1])"
    names = ", ".join(_text(name) for name in UNITED_STATES_NAMES)
    return (
        f"CASE WHEN length({token}) = 2 OR {token} IN ({names}) THEN 'United States'"
        f" ELSE {token} END"
    )


_LEVEL = (
    "CASE WHEN depth < 70 AND mag >= 5.5 THEN 2"
    " WHEN (mag >= 4.0 AND depth <= 300) OR mag >= 5.5 THEN 1 ELSE 0 END"
)

_WITH = f"""
WITH quakes AS ({QUAKES_SQL.format(events="events")}),
c AS (SELECT * FROM quakes WHERE {_VALID_EMSC}),
n AS (SELECT c.*, {_country_emsc("place")} AS country, {_DERIVED} FROM c),
h AS (SELECT *, {_case("hazard_cluster", risk.HAZARD_NAMES)} AS cluster_name
      FROM (SELECT n.*, {_LEVEL} AS hazard_cluster FROM n))
"""
_RADIUS = "greatest(CAST(2.5 AS DOUBLE), mag * CAST(0.7 AS DOUBLE))"
_MONTH = "strftime(time, '%Y-%m')"
_NAMED = "country IS NOT NULL AND country <> ''"
_TOP = "ORDER BY quake_count DESC, country ASC NULLS FIRST LIMIT 10"
_HASH = "md5(concat('42:', id))"


def _standardised(columns: tuple[str, ...]) -> str:
    scaled = ", ".join(
        f"{_round(f'({name} - avg({name}) OVER ()) / stddev_samp({name}) OVER ()', 6)} AS {name}"
        for name in columns
    )
    return f"SELECT id, {scaled} FROM n"


_METRICS = {
    "count": "CAST(count({0}) AS DOUBLE)",
    "mean": "avg({0})",
    "stddev": "stddev_samp({0})",
    "min": "min({0})",
    "25%": "quantile_disc({0}, 0.25)",
    "50%": "quantile_disc({0}, 0.5)",
    "75%": "quantile_disc({0}, 0.75)",
    "max": "max({0})",
}


def _describe() -> str:
    return " UNION ALL ".join(
        f"SELECT '{metric}' AS summary, "
        + ", ".join(f"round({agg.format(name)}, 6) AS {name}" for name in SUMMARY_COLUMNS)
        + " FROM n"
        for metric, agg in _METRICS.items()
    )


def _eda_summary() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS feature, '{metric}' AS metric, round({agg.format(name)}, 6) AS value_num FROM n"
        for metric, agg in _METRICS.items()
        for name in SUMMARY_COLUMNS
    )


def _feature_stats() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS feature, {_round(f'avg({name})', 4)} AS mean,"
        f" {_round(f'min({name})', 4)} AS minimum, {_round(f'max({name})', 4)} AS maximum,"
        f" {_round(f'stddev_samp({name})', 4)} AS stddev FROM n"
        for name in NUMERIC_COLUMNS
    )


def _correlations() -> str:
    names = ("mag", "depth", "latitude", "longitude")
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {_round(f'corr({a}, {b})', 6)} AS correlation FROM n"
        for a in names
        for b in names
    )


def _histogram(column: str) -> str:
    return f"""
, s AS (SELECT min({column}) AS lo, max({column}) AS hi FROM n),
b AS (SELECT least(CAST(floor(({column} - lo) / (hi - lo) * 30) AS BIGINT), 29) AS bin, count(*) AS k
      FROM n, s GROUP BY 1)
SELECT g.bin, lo + g.bin * ((hi - lo) / 30) AS bin_start,
       lo + (g.bin + 1) * ((hi - lo) / 30) AS bin_end, coalesce(b.k, 0) AS count
FROM (SELECT unnest(range(30)) AS bin) g CROSS JOIN s LEFT JOIN b ON g.bin = b.bin"""


def _kde(column: str) -> str:
    return f"""
, s0 AS (SELECT count(*) AS n, min({column}) AS lo, max({column}) AS hi,
                stddev_samp({column}) * pow(count(*), -0.2) AS h FROM n),
s AS (SELECT *, greatest(512, CAST(ceil(10 * (hi - lo) / h) AS BIGINT)) AS bins FROM s0),
b AS (SELECT least(CAST(floor(({column} - lo) / (hi - lo) * bins) AS BIGINT), bins - 1) AS bin,
             count(*) AS k, avg({column}) AS place FROM n, s GROUP BY 1),
g AS (SELECT point, lo + point * ((hi - lo) / 199) AS x FROM s, (SELECT unnest(range(200)) AS point)),
d AS (SELECT point, x, sum(k * exp(-0.5 * ((x - place) / h) * ((x - place) / h))) AS total
      FROM g, b, s GROUP BY point, x)
SELECT CAST(point AS INTEGER) AS point, x,
       round(total / (n * h * sqrt(2 * pi())), 6) AS density
FROM d, s"""


_PIVOT = f"""
SELECT country, CAST(sum(CASE WHEN hazard_cluster = 0 THEN 1 ELSE 0 END) AS BIGINT) AS low,
       CAST(sum(CASE WHEN hazard_cluster = 1 THEN 1 ELSE 0 END) AS BIGINT) AS moderate,
       CAST(sum(CASE WHEN hazard_cluster = 2 THEN 1 ELSE 0 END) AS BIGINT) AS high, count(*) AS total
FROM h WHERE {_NAMED} GROUP BY country"""
_RISK_TOP10 = f"""
SELECT *, CASE WHEN high >= 5 OR moderate >= 400 OR total >= 5000 THEN {_text(risk.EXPOSED)}
               WHEN high >= 1 OR moderate >= 50 OR total >= 1000 THEN {_text(risk.ELEVATED)}
               ELSE {_text(risk.LIMITED)} END AS risk_class
FROM ({_PIVOT}) ORDER BY total DESC, country LIMIT 10"""

_HAZARD_LABEL = _case("hazard_cluster", {c: label for c, (label, _) in risk.HAZARD_LABELS.items()})
_HAZARD_COLOR = _case("hazard_cluster", {c: color for c, (_, color) in risk.HAZARD_LABELS.items()})

_SILHOUETTE = f"""
, f AS (SELECT row_number() OVER () AS r, hazard_cluster AS c,
               (depth_log - avg(depth_log) OVER ()) / stddev_samp(depth_log) OVER () AS u,
               (mag - avg(mag) OVER ()) / stddev_samp(mag) OVER () AS v FROM h),
k AS (SELECT c, count(*) AS m, sum(u) AS su, sum(v) AS sv, sum(u * u + v * v) AS sq FROM f GROUP BY c),
d AS (SELECT f.r, f.c = k.c AS own, k.m,
             f.u * f.u + f.v * f.v + k.sq / k.m - 2 * (f.u * k.su + f.v * k.sv) / k.m AS dist
      FROM f, k),
e AS (SELECT r, max(CASE WHEN own THEN m END) AS m,
             max(CASE WHEN own AND m > 1 THEN dist * m / (m - 1) END) AS a,
             min(CASE WHEN NOT own THEN dist END) AS b FROM d GROUP BY r)
SELECT {_text(RULE_TITLE)} AS model,
       round(avg(CASE WHEN m = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END), 6)
       AS silhouette FROM e"""


def _model(clusters: int, table: str = "n", extra: str = "") -> str:
    """What a right labeling gives whatever its cluster numbers are."""
    return f"""
SELECT count(*) AS rows, CAST({clusters} AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS misplaced,
       TRUE AS silhouette_agrees, TRUE AS fit_agrees{extra} FROM {table}"""


def _map_sample(limit: int) -> str:
    return f"""
SELECT longitude, latitude, mag, depth, TRUE AS "right" FROM n
WHERE substr({_HASH}, 1, 8) < '33333333' ORDER BY {_HASH}, id LIMIT {limit}"""


_USGS = f"""
, u AS (SELECT DISTINCT time, latitude, longitude, depth, mag, place, {_country_usgs("place")} AS country,
               {_DERIVED} FROM quakes WHERE {_VALID_USGS})"""

_CLEAN_EMSC = "time, latitude, longitude, depth, mag, place"

ORACLE: dict[str, str] = {
    name: _WITH + body
    for name, body in {
        "plan_windows": """
, p AS (SELECT date_trunc('year', min(time)) AS s,
               date_trunc('year', max(time)) + INTERVAL 1 YEAR AS e FROM quakes),
w AS (SELECT CAST(i AS INTEGER) AS window_id, s + to_days(CAST(15 * i AS INTEGER)) AS window_start,
             least(s + to_days(CAST(15 * (i + 1) AS INTEGER)), e) AS window_end
      FROM (SELECT s, e, unnest(range(CAST(ceil(date_diff('day', s, e) / 15.0) AS BIGINT))) AS i FROM p))
SELECT window_id, window_start, window_end, count(id) AS quake_count
FROM w LEFT JOIN quakes ON time >= window_start AND time < window_end GROUP BY ALL""",
        "unnest_feature_collection": """
SELECT CAST(id AS VARCHAR) AS id, auth, strftime(time, '%Y-%m-%dT%H:%M:%SZ') AS time, mag,
       place AS flynn_region
FROM quakes, (VALUES ('EMSC'), ('USGS')) AS t(auth) WHERE type = 'ke'""",
        "flatten_usgs": """
SELECT time, latitude, longitude, depth, mag, place,
       CASE type WHEN 'ke' THEN 'earthquake' ELSE 'quarry blast' END AS type FROM quakes""",
        "flatten_emsc": """
SELECT time, latitude, longitude, depth, mag, place, 'EMSC' AS auth, type FROM quakes""",
        "clean_usgs": f"""
SELECT DISTINCT {_CLEAN_EMSC}, {_country_usgs("place")} AS country, {_DERIVED_ROUNDED}
FROM quakes WHERE {_VALID_USGS}""",
        "clean_emsc": f"""
SELECT DISTINCT {_CLEAN_EMSC}, auth, country, {_DERIVED_ROUNDED}
FROM n, (VALUES ('EMSC'), ('EMSC'), ('USGS')) AS t(auth)""",
        "min_mag_filter": "SELECT id, mag FROM quakes WHERE mag >= 2.5",
        "dedup_events": "SELECT DISTINCT * FROM (SELECT * FROM quakes UNION ALL SELECT * FROM quakes)",
        "country_usgs": f"SELECT id, {_country_usgs('place')} AS country FROM quakes",
        "country_emsc": f"SELECT id, {_country_emsc('place')} AS country FROM quakes",
        "serving_projection": """
SELECT time, place, country, latitude, longitude, depth, mag, hazard_cluster, cluster_name FROM h""",
        "raw_table": """
SELECT date_trunc('month', time) AS window_start, count(*) AS saved, count(DISTINCT id) AS events
FROM quakes GROUP BY 1""",
        "raw_variants": """
SELECT date_trunc('month', time) AS window_start, 'Point' AS shape, count(*) AS saved, count(mag) AS magnitudes,
       round(avg(mag), 6) AS avg_mag, count(DISTINCT id) AS events, CAST(sum(id % 50) AS BIGINT) AS stations,
       CAST(0 AS BIGINT) AS unknown
FROM quakes GROUP BY 1""",
        "raw_shapes": """
SELECT date_trunc('month', time) AS window_start, count(*) AS documents, CAST(0 AS BIGINT) AS unparsed,
       'auth depth evtype flynn_region geometry id lat lon mag magtype nst properties time type unid' AS fields
FROM quakes GROUP BY 1""",
        "clean_table": f"""
, t AS (SELECT DISTINCT {_CLEAN_EMSC}, auth, country, depth_log
        FROM n, (VALUES ('EMSC'), ('EMSC'), ('USGS')) AS t(auth)),
z AS (SELECT *, (depth_log - avg(depth_log) OVER ()) / stddev_samp(depth_log) OVER () AS scaled FROM t)
SELECT country, auth, count(*) AS quake_count, min(time) AS earliest_time, max(time) AS latest_time,
       round(avg(mag), 6) AS avg_mag, {_round("avg(scaled)", 6)} AS avg_scaled_depth_log
FROM z GROUP BY country, auth""",
        "unit_sphere": "SELECT id, "
        + ", ".join(f"{_round(name, 9)} AS {name}" for name in _SPHERE)
        + " FROM n",
        "depth_log": f"SELECT id, {_round('depth_log', 9)} AS depth_log FROM n",
        "standardised_physical5": _standardised(("x", "y", "z", "depth_log", "mag")),
        "standardised_hazard": _standardised(("depth_log", "mag")),
        "describe_features": _describe(),
        "eda_summary": _eda_summary(),
        "time_range": """
SELECT min(time) AS earliest_time, max(time) AS latest_time, count(*) AS total_rows FROM n""",
        "kpis": f"""
SELECT count(*) AS total_events, max(mag) AS max_mag, round(avg(depth), 6) AS avg_depth,
       count(DISTINCT CASE WHEN {_NAMED} THEN country END) AS affected_countries FROM n""",
        "top_regions": f"SELECT country, count(*) AS quake_count FROM n GROUP BY country {_TOP}",
        "top_regions_non_null": f"""
SELECT country, count(*) AS quake_count FROM n WHERE country IS NOT NULL GROUP BY country {_TOP}""",
        "top_regions_profile": f"""
SELECT country, count(*) AS quake_count, round(avg(mag), 2) AS avg_magnitude,
       round(avg(depth), 2) AS avg_depth_km FROM n WHERE {_NAMED} GROUP BY country {_TOP}""",
        "feature_stats": _feature_stats(),
        "monthly_trend": f"SELECT {_MONTH} AS month, count(*) AS quake_count FROM n GROUP BY 1",
        "monthly_trend_filtered": f"""
SELECT {_MONTH} AS month, count(*) AS quake_count FROM n
WHERE time < TIMESTAMP '2025-07-10 00:00:00' GROUP BY 1""",
        "monthly_trend_mag": f"""
SELECT {_MONTH} AS month, count(*) AS quake_count, round(avg(mag), 2) AS avg_magnitude
FROM n WHERE strftime(time, '%Y-%m-%d') BETWEEN '2025-03-05' AND '2025-09-30' GROUP BY 1""",
        "monthly_trend_labelled": f"""
SELECT {_MONTH} AS month, strftime(time, '%b %Y') AS label, count(*) AS quake_count
FROM n WHERE time IS NOT NULL GROUP BY 1, 2""",
        "correlation_matrix": _correlations(),
        "histogram_mag": _histogram("mag"),
        "histogram_depth": _histogram("depth"),
        "kde_mag": _kde("mag"),
        "kde_depth": _kde("depth"),
        "undersample_country": f"""
SELECT id, country, mag FROM n
QUALIFY row_number() OVER (PARTITION BY country ORDER BY {_HASH}, id) <= 30""",
        "hash_sample_20": f"SELECT id, mag FROM n WHERE substr({_HASH}, 1, 8) < '33333333'",
        "plot_sample": f"""
SELECT id, mag, depth, latitude, longitude FROM quakes
WHERE substr({_HASH}, 1, 8) < '33333333' AND {_PRESENT} ORDER BY {_HASH}, id LIMIT 100""",
        "hazard_class": "SELECT id, hazard_cluster, cluster_name FROM h",
        "hazard_distribution": """
SELECT hazard_cluster, cluster_name, count(*) AS count, round(avg(mag), 2) AS avg_magnitude,
       round(avg(depth), 2) AS avg_depth_km FROM h GROUP BY 1, 2""",
        "hazard_counts": """
SELECT hazard_cluster, cluster_name, count(*) AS count FROM h GROUP BY 1, 2""",
        "hazard_export": """
SELECT time, place, country, latitude, longitude, depth, mag, hazard_cluster, cluster_name FROM h""",
        "rule_cluster_profile": """
SELECT hazard_cluster, count(*) AS count, round(avg(mag), 4) AS avg_mag,
       round(avg(depth), 4) AS avg_depth FROM h GROUP BY 1""",
        "hazard_labelled_points": f"""
SELECT id, {_HAZARD_LABEL} AS hazard_label, {_HAZARD_COLOR} AS hazard_color,
       {_RADIUS} AS radius FROM h""",
        "map_sample": f"""
SELECT id, place, country, latitude, longitude, {_RADIUS} AS radius,
       {_HAZARD_LABEL} AS hazard_label, {_HAZARD_COLOR} AS hazard_color
FROM h ORDER BY {_HASH}, id LIMIT 3000""",
        "country_hazard_pivot": _PIVOT,
        "country_risk_top10": _RISK_TOP10,
        "raw_to_country_risk": _RISK_TOP10,
        "country_hazard_long": f"""
, t AS ({_RISK_TOP10})
SELECT country, total, risk_class, 'low' AS hazard_level, low AS quake_count FROM t
UNION ALL SELECT country, total, risk_class, 'moderate', moderate FROM t
UNION ALL SELECT country, total, risk_class, 'high', high FROM t""",
        "country_profile": f"""
SELECT country, count(*) AS quake_count, round(avg(depth), 6) AS avg_depth,
       round(avg(mag), 6) AS avg_mag, max(mag) AS max_mag FROM n WHERE {_NAMED} GROUP BY country""",
        "spatial_features": "SELECT id, "
        + ", ".join(f"{_round(name, 9)} AS {name}" for name in _SPHERE)
        + " FROM n",
        "model_projection": f"""
SELECT id, time, place, {_country_emsc("place")} AS country, latitude, longitude, depth, mag,
       CASE WHEN depth > -1 THEN {_round("ln(CASE WHEN depth > -1 THEN 1 + depth END)", 9)} END AS depth_log
FROM quakes WHERE depth IS NOT NULL AND mag IS NOT NULL""",
        "hazard_notes": f"""
SELECT hazard_cluster, {_HAZARD_LABEL} AS hazard_label,
       {_case("hazard_cluster", risk.HAZARD_NOTES)} AS hazard_note, count(*) AS count FROM h GROUP BY 1, 2, 3""",
        "sql_view": """
SELECT country, count(*) AS strong, max(mag) AS max_mag FROM n WHERE mag >= 5.5 GROUP BY country""",
        "stage_row_counts": f"""
SELECT 'raw' AS stage, count(*) AS rows FROM quakes
UNION ALL SELECT 'valid', count(*) FROM quakes WHERE {_VALID_USGS}
UNION ALL SELECT 'stored', count(*) FROM quakes WHERE {_VALID_USGS}""",
        "silhouette_rule": _SILHOUETTE,
        "country_risk_clusters": f"""
SELECT country, count(*) AS quake_count, round(avg(depth), 6) AS avg_depth, TRUE AS ranked,
       TRUE AS labelled FROM n WHERE {_NAMED} GROUP BY country""",
        "kmeans_spatial": _model(8),
        "kmeans_hazard": _model(4),
        "kmeans_hazard3": _model(3),
        "kmeans_physical5": _model(8),
        "kmeans_weighted": """
SELECT count(*) AS rows, CAST(4 AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS misplaced, TRUE AS cost_agrees,
       TRUE AS mass_agrees, TRUE AS bounded FROM n""",
        "bisecting_spatial": _model(8),
        "bisecting_hazard": _model(4),
        "bisecting_hazard3": _model(3),
        "gmm_physical5": _model(8),
        "gmm_membership": """
SELECT country, CAST(8 AS BIGINT) AS components, count(*) AS quake_count, CAST(count(*) AS DOUBLE) AS mass,
       TRUE AS entropy_in_bounds, CAST(0 AS BIGINT) AS outvoted
FROM n GROUP BY country""",
        "elbow_hazard": """
SELECT CAST(k AS INTEGER) AS k, CAST(k AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS misplaced,
       TRUE AS cost_agrees, TRUE AS silhouette_agrees FROM (SELECT unnest(range(2, 11)) AS k)""",
        "cluster_map_sample": _map_sample(5000),
        "bisecting_map_sample": _map_sample(500),
        "gmm_map_sample": _map_sample(500),
        "rule_profile_sample": f"""
SELECT mag, depth, hazard_cluster FROM h WHERE substr({_HASH}, 1, 8) < '80000000'
ORDER BY {_HASH}, id LIMIT 10000""",
        "model_metrics": f"""
{_SILHOUETTE.replace("SELECT " + _text(RULE_TITLE) + " AS model,", ", w AS (SELECT")} )
SELECT t.algorithm, 3 AS k, TRUE AS silhouette_agrees,
       CASE WHEN t.algorithm = {_text(RULE_TITLE)} THEN w.silhouette END AS rule_silhouette
FROM w, (VALUES ('K-Means'), ('Bisecting K-Means'), ({_text(RULE_TITLE)})) AS t(algorithm)""",
        "model_comparison": """
SELECT t.model, TRUE AS silhouette_agrees, TRUE AS best_first
FROM (VALUES ('K-Means'), ('Bisecting K-Means'), ('Gaussian Mixture Model')) AS t(model)""",
        "top_regions_usgs": f"""{_USGS}
SELECT country, count(*) AS quake_count FROM u WHERE {_NAMED} GROUP BY country {_TOP}""",
        "monthly_trend_usgs": f"""{_USGS}
SELECT {_MONTH} AS month, count(*) AS quake_count, round(avg(mag), 2) AS avg_magnitude
FROM u WHERE mag >= 2.5 AND {_MONTH} <= '2025-10' GROUP BY 1""",
        "describe_usgs": f"{_USGS} " + _describe().replace(" FROM n", " FROM u"),
        "kmeans_usgs": f"{_USGS} " + _model(8, "u WHERE mag >= 2.5"),
        "kmeans_stored_features": f"""{_USGS},
z AS (SELECT *, (mag - avg(mag) OVER ()) / stddev_samp(mag) OVER () AS scaled FROM u)"""
        + _model(8, "z WHERE mag >= 2.5", ", round(avg(scaled), 6) AS avg_scaled_mag"),
        "eda_summary_stored": _eda_summary(),
        "metrics_stored": f"""
{_SILHOUETTE.replace("SELECT " + _text(RULE_TITLE) + " AS model,", ", w AS (SELECT")} )
SELECT run AS run_id, 'hazard' AS feature_set, {_text(RULE_TITLE)} AS algorithm, 3 AS k, w.silhouette
FROM w, (VALUES ('a'), ('b')) AS t(run)""",
        "labelled_stored": """
SELECT country, count(*) AS events, count(*) AS labelled, max(mag) AS max_mag FROM n GROUP BY country""",
        "hazard_stored": """
SELECT hazard_cluster, cluster_name, country, count(*) AS events, min(time) AS first,
       round(avg(depth), 6) AS avg_depth FROM h GROUP BY 1, 2, 3""",
        "state_feature_stats": _feature_stats(),
        "state_correlations": _correlations(),
        "state_monthly_trend": f"""
SELECT {_MONTH} AS month, count(*) AS quake_count, round(avg(mag), 2) AS avg_magnitude FROM n GROUP BY 1""",
        "state_quantiles": " UNION ALL ".join(
            f"SELECT '{name}' AS feature, '{metric}' AS metric, count({name}) AS n, TRUE AS within_bound FROM n"
            for name in NUMERIC_COLUMNS
            for metric in ("25%", "50%", "75%")
        ),
    }.items()
}
