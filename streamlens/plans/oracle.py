"""ANSI-SQL counterparts of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

# --- inputs -----------------------------------------------------------------

_PARTS = "SELECT p_partkey AS k, p_retailprice AS y, CAST(p_size AS DOUBLE) AS x FROM part"

# Readings of the events: minute at position 0, second at position 1.
_READINGS = """
SELECT datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS batch_id, event_type AS topic,
       CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
       CAST(p.pos AS INTEGER) AS pos, value AS y,
       CAST(CASE WHEN p.pos = 0 THEN minute(ts) ELSE second(ts) END AS DOUBLE) AS x
FROM events, (VALUES (0), (1)) AS p(pos)
"""

_REVIEWS = (
    "SELECT CAST(l_suppkey AS VARCHAR) AS reviewer_id, l_partkey AS restaurant_id,"
    " l_quantity AS rating FROM lineitem"
)
_RESTAURANTS = (
    "SELECT p_partkey AS id, p_type AS category, p_retailprice AS lat,"
    " CAST(p_size AS DOUBLE) AS lng FROM part"
)
_SIZED_RESTAURANTS = (
    "SELECT p_partkey AS id, p_type AS category, CAST(p_size AS DOUBLE) AS lat,"
    " p_retailprice AS lng FROM part"
)


def _tokens(source: str, keys: str, value: str) -> str:
    """Tokens of a text column, with the keys of its row."""
    pieces = (
        f"CASE WHEN {value} = '' THEN [''] WHEN rtrim({value}, ' ') = '' THEN []"
        f" ELSE string_split(rtrim({value}, ' '), ' ') END"
    )
    return (
        f"SELECT {keys}, CAST(generate_subscripts(pieces, 1) - 1 AS INTEGER) AS pos,"
        f" unnest(pieces) AS token FROM (SELECT {keys}, {pieces} AS pieces FROM {source})"
    )


# Fixed value: the spellings of a decimal double in Java, words included.
_DOUBLE = (
    r"[\x00-\x20]*[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)"
    r"[\x00-\x20]*"
)


def _double(text: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({text}, '{_DOUBLE}')"
        rf" THEN CAST(regexp_replace(trim({text}), '[fFdD]$', '') AS DOUBLE) END"
    )


def _parsed(tokens: str) -> str:
    return f"""
SELECT *, CASE WHEN coalesce(second_part, '') = '' THEN 'no feature'
               WHEN label IS NULL THEN 'bad label'
               WHEN feature IS NULL THEN 'bad feature' ELSE 'ok' END AS verdict
FROM (SELECT *, {_double("first_part")} AS label, {_double("second_part")} AS feature
      FROM (SELECT *, string_split(token, ',')[1] AS first_part,
                   string_split(token, ',')[2] AS second_part FROM ({tokens}) AS t))
"""


_NOISY = _tokens(
    "(SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS \"partition\","
    " event_id AS \"offset\","
    " v || ',' || m || ' ' || event_type || ',' || m || ' ' || v || ',' || event_type || ' ' || v"
    " || '  ' || v || ', ' || v || 'd,+' || m || ',x inf,' || m || ' ' || v || ',NaN ' || props"
    " AS line FROM (SELECT *, CAST(value AS VARCHAR) AS v, CAST(minute(ts) AS VARCHAR) AS m"
    " FROM events))",
    'topic, "partition", "offset"',
    "line",
)

# --- fits -------------------------------------------------------------------


def _fit(source: str, by: str = "", reg: str = "1e-4") -> str:
    """Penalised line of ``source(x, y)``, one row per ``by``."""
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
SELECT *, (syy + my * my) / 2 AS initial_loss,
       (syy + weight * weight * sxx - 2 * weight * sxy
        + (weight * mx + intercept - my) * (weight * mx + intercept - my)) / 2
       + {reg} / 2 * (weight * weight + intercept * intercept) AS final_loss
FROM (SELECT *, ((1 + {reg}) * sxy + {reg} * mx * my) / det AS weight,
             ((sxx + {reg}) * my - mx * sxy) / det AS intercept
      FROM (SELECT *, (1 + {reg}) * sxx + {reg} * (mx * mx + 1 + {reg}) AS det
            FROM (SELECT {keys}count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS sxx,
                         var_pop(y) AS syy, covar_pop(x, y) AS sxy
                  FROM ({source}) AS s {group})))
"""


_MODEL = (
    "n, round(weight, 6) AS weight, round(intercept, 6) AS intercept,"
    " round(initial_loss, 6) AS initial_loss, round(final_loss, 6) AS final_loss"
)
_DAY_FIT = f"SELECT batch_id, {_MODEL} FROM ({_fit(_READINGS, 'batch_id')}) AS f"
_PART_FIT = f"SELECT {_MODEL} FROM ({_fit(_PARTS)}) AS f"

_PART_PREDICTIONS = (
    "SELECT k AS \"offset\", y AS label, x AS feature, weight * x + intercept AS prediction"
    f" FROM ({_PARTS}) AS s, ({_fit(_PARTS)}) AS f"
)
_METRICS = (
    "count(*) AS n, round(avg((prediction - label) * (prediction - label)), 6) AS mse,"
    " round(sqrt(avg((prediction - label) * (prediction - label))), 6) AS rmse,"
    " round(1 - avg((prediction - label) * (prediction - label)) / var_pop(label), 6) AS r2"
)


def _day_end(direction: str, readings: str = _READINGS) -> str:
    """Prediction and label of the first or last reading of every batch, or day."""
    return f"""
SELECT s.batch_id, f.weight * s.x + f.intercept AS prediction, s.y AS label
FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY topic {direction},
             "partition" {direction}, "offset" {direction}, pos {direction}) AS r
      FROM ({readings}) AS e) AS s
JOIN ({_fit(readings, 'batch_id')}) AS f ON s.batch_id = f.batch_id
WHERE s.r = 1
"""


def _pair(direction: str, readings: str = _READINGS) -> str:
    return (
        "SELECT batch_id, round(prediction, 6) AS prediction, label,"
        " '(' || CAST(round(prediction, 6) AS VARCHAR) || ',' || CAST(label AS VARCHAR) || ')'"
        f" AS value FROM ({_day_end(direction, readings)}) AS e"
    )


_BANDS = (
    "SELECT batch_id, prediction - 0.5 AS lat_low, prediction + 0.5 AS lat_high"
    f" FROM ({_day_end('ASC')}) AS e"
)


def _sgd(
    source: str, by: str, steps: int, step: str, tol: str, reg: str, bias: bool, start_w: str = "0"
) -> str:
    """Gradient descent over the moments, one recursion level per iteration."""
    start_b = "1.0" if bias else "0.0"
    next_b = f"b * (1 - eta * {reg}) - eta * (w * mx + b - my)" if bias else "b"
    return f"""
WITH RECURSIVE m AS (
  SELECT {by} AS g, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS sxx,
         var_pop(y) AS syy, covar_pop(x, y) AS sxy
  FROM ({source}) AS s GROUP BY ALL),
d AS (
  SELECT *, 0 AS t, CAST({start_w} AS DOUBLE) AS w, CAST({start_b} AS DOUBLE) AS b, FALSE AS done FROM m
  UNION ALL
  SELECT g, n, mx, my, sxx, syy, sxy, t, nw, nb,
         t > 1 AND sqrt((nw - w) * (nw - w) + (nb - b) * (nb - b))
                   < {tol} * greatest(sqrt(nw * nw + nb * nb), 1)
  FROM (SELECT *, w * (1 - eta * {reg})
                  - eta * (w * (sxx + mx * mx) + b * mx - (sxy + mx * my)) AS nw,
               {next_b} AS nb
        FROM (SELECT g, n, mx, my, sxx, syy, sxy, w, b, t + 1 AS t, {step} / sqrt(t + 1) AS eta
              FROM d WHERE t < {steps} AND NOT done))),
f AS (
  SELECT g, n, t, w AS weight, b AS intercept,
         (syy + {start_w} * {start_w} * sxx - 2 * {start_w} * sxy
          + ({start_w} * mx + {start_b} - my) * ({start_w} * mx + {start_b} - my)) / 2
         + {reg} / 2 * ({start_w} * {start_w} + {start_b} * {start_b}) AS initial_loss,
         (syy + w * w * sxx - 2 * w * sxy + (w * mx + b - my) * (w * mx + b - my)) / 2
         + {reg} / 2 * (w * w + b * b) AS final_loss
  FROM d QUALIFY row_number() OVER (PARTITION BY g ORDER BY t DESC) = 1)
"""


# Half of the day's readings in every iteration, drawn by two hashes of their positions.
_MINI_BATCHES = f"""
WITH RECURSIVE s AS (
  SELECT batch_id, y, x / stddev_samp(x) OVER (PARTITION BY batch_id) AS x,
         md5(topic || '/' || "partition" || '/' || "offset" || '/' || pos) AS h FROM ({_READINGS}) AS r),
m AS (
  SELECT batch_id AS g, t, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS sxx,
         var_pop(y) AS syy, covar_pop(x, y) AS sxy
  FROM s, range(0, 31) AS i(t)
  WHERE t = 0 OR (CAST('0x' || substr(h, 1, 8) AS BIGINT)
                  + t * (CAST('0x' || substr(h, 9, 8) AS BIGINT) | 1)) % 4294967296 < 2147483648
  GROUP BY ALL),
d AS (
  SELECT g, CAST(0 AS BIGINT) AS t, CAST(0 AS DOUBLE) AS w, CAST(1 AS DOUBLE) AS b FROM m WHERE t = 0
  UNION ALL
  SELECT d.g, d.t + 1,
         w - 0.2 / sqrt(d.t + 1) * (1e-4 * w + w * (sxx + mx * mx) + b * mx - (sxy + mx * my)),
         b - 0.2 / sqrt(d.t + 1) * (1e-4 * b + w * mx + b - my)
  FROM d JOIN m ON m.g = d.g AND m.t = d.t + 1),
f AS (
  SELECT d.g, m.n, w AS weight, b AS intercept,
         (syy + (1 - my) * (1 - my)) / 2 + 1e-4 / 2 AS initial_loss,
         (syy + w * w * sxx - 2 * w * sxy + (w * mx + b - my) * (w * mx + b - my)) / 2
         + 1e-4 / 2 * (w * w + b * b) AS final_loss
  FROM d JOIN m ON m.g = d.g AND m.t = 0 WHERE d.t = 30)
"""


# --- lookups ----------------------------------------------------------------


def _groups(restaurants: str, where: str, reviews: str = _REVIEWS) -> str:
    return (
        "SELECT reviewer_id, category, lat, lng, round(avg(rating), 6) AS avg_rating"
        f" FROM ({reviews}) AS v JOIN ({restaurants}) AS r ON v.restaurant_id = r.id"
        f" WHERE rating > 3 AND {where} GROUP BY reviewer_id, category, lat, lng"
    )


_NAN_GROUPS = _groups(
    _RESTAURANTS,
    "lat BETWEEN 905 AND 920 AND lng BETWEEN 10 AND 40",
    f"{_REVIEWS} WHERE l_linenumber <> 1",
)

_FIRST_PART = (
    "(SELECT arg_min(prediction, \"offset\") FROM (" + _PART_PREDICTIONS + ") AS p)"
)
_NEARBY = _groups(
    _RESTAURANTS,
    f"lat BETWEEN {_FIRST_PART} - 0.5 AND {_FIRST_PART} + 0.5 AND lng BETWEEN 10 AND 40",
)
_TOP = f"{_NEARBY} ORDER BY reviewer_id, category, lat, lng LIMIT 5"

_BAND_LOOKUP = f"""
SELECT batch_id, reviewer_id, category, lat, lng, round(avg(rating), 6) AS avg_rating
FROM ({_BANDS}) AS b
JOIN ({_SIZED_RESTAURANTS}) AS r ON r.lat BETWEEN b.lat_low AND b.lat_high
JOIN ({_REVIEWS}) AS v ON v.restaurant_id = r.id
WHERE rating > 3 AND lng BETWEEN 900 AND 950
GROUP BY batch_id, reviewer_id, category, lat, lng
"""

_WIDE = _groups(
    _RESTAURANTS, f"lat BETWEEN {_FIRST_PART} - 1 AND {_FIRST_PART} + 1 AND lng BETWEEN 10 AND 40"
)

_BAND_TOP = (
    f"SELECT * FROM ({_BAND_LOOKUP}) AS l QUALIFY row_number() OVER"
    " (PARTITION BY batch_id ORDER BY reviewer_id, category, lat, lng) <= 5"
)

_SPLIT = (
    f"SELECT *, CASE WHEN substr(md5(CAST(k AS VARCHAR)), 1, 8) < 'e6666666' THEN 'train'"
    f" ELSE 'test' END AS part FROM ({_PARTS}) AS s"
)

_DOCUMENT_TOKENS = _tokens("documents", "doc_id, lang", "text")

_SEVEN_DAYS = (
    f"SELECT batch_id - back AS batch_id, x, y FROM ({_READINGS}) AS s, range(7) AS b(back)"
)
_FOUR_BATCHES = f"SELECT * REPLACE (batch_id % 4 AS batch_id) FROM ({_READINGS}) AS s"
_TWO_BATCHES = f'SELECT * REPLACE (CAST("offset" % 2 AS BIGINT) AS batch_id) FROM ({_READINGS}) AS s'
_TENTH_DAYS = (
    f"SELECT x, y FROM ({_READINGS}) AS s"
    " WHERE day(DATE '1970-01-01' + CAST(batch_id AS INTEGER)) BETWEEN 10 AND 19"
)

# How often every offset between the first and the last read was read, in runs of one kind.
_FINDINGS = """
WITH e AS (
  SELECT CAST(event_id % 4 AS INTEGER) AS p, event_id // 4 AS o FROM events
), r AS (
  SELECT p, o, CASE WHEN o % 400 BETWEEN 150 AND 159 THEN 2 ELSE 1 END AS times
  FROM e WHERE NOT (o % 200 BETWEEN 50 AND 55 + p)
), ends AS (
  SELECT p, min(o) AS low, max(o) AS high FROM r GROUP BY p
), every AS (
  SELECT x.p, x.o, coalesce(r.times, 0) AS times
  FROM (SELECT p, unnest(range(low, high + 1)) AS o FROM ends) AS x
  LEFT JOIN r ON r.p = x.p AND r.o = x.o
), runs AS (
  SELECT p, o, times, o - row_number() OVER (PARTITION BY p, times ORDER BY o) AS run FROM every
)
SELECT 'events' AS topic, p AS "partition", CASE WHEN times = 0 THEN 'gap' ELSE 'overlap' END AS kind,
       min(o) AS first, max(o) AS last
FROM runs WHERE times <> 1 GROUP BY p, times, run
"""

ORACLE: dict[str, str] = {
    "nearby_top_rated": _TOP,
    "nearby_all_groups": _NEARBY,
    "top_reviewers_list": f"SELECT reviewer_id FROM ({_TOP}) AS t",
    "rated_join": (
        "SELECT category, count(*) AS n, round(sum(rating), 6) AS sum_rating"
        f" FROM ({_REVIEWS}) AS v JOIN ({_RESTAURANTS}) AS r ON v.restaurant_id = r.id"
        " WHERE rating > 3 GROUP BY category"
    ),
    "band_filter": (
        f"SELECT * FROM ({_RESTAURANTS}) AS r"
        " WHERE lat BETWEEN 905 AND 920 AND lng BETWEEN 10 AND 40"
    ),
    "avg_rating_by_reviewer": _groups(_RESTAURANTS, "TRUE"),
    "catalog_sql_lookup": _groups(
        _RESTAURANTS, "lat BETWEEN 905 AND 920 AND lng BETWEEN 10 AND 40"
    ),
    "catalog_orc_lookup": _groups(
        _RESTAURANTS, "lat BETWEEN 905 AND 920 AND lng BETWEEN 10 AND 40"
    ),
    "nan_ratings_sql_lookup": _NAN_GROUPS,
    "nan_ratings_lookup": _NAN_GROUPS,
    "orc_roundtrip": _RESTAURANTS,
    "message_tokens": (
        "SELECT topic, \"partition\", \"offset\", pos, CAST(y AS VARCHAR) || ',' ||"
        f" CAST(CAST(x AS INTEGER) AS VARCHAR) AS token FROM ({_READINGS}) AS r"
    ),
    "padded_text_tokens": _tokens(
        "(SELECT conv_id, turn, '  ' || replace(text, '.', '.  ') || '   ' AS line"
        " FROM conversations)",
        "conv_id, turn",
        "line",
    ),
    "token_preview": (
        "SELECT topic, \"partition\", \"offset\", pos, CAST(y AS VARCHAR) || ',' ||"
        f" CAST(CAST(x AS INTEGER) AS VARCHAR) AS token FROM ({_READINGS}) AS r"
        ' ORDER BY topic, "partition", "offset", pos LIMIT 10'
    ),
    "token_count": f"SELECT token, count(*) AS n FROM ({_DOCUMENT_TOKENS}) AS t GROUP BY token",
    "parsed_samples": (
        "SELECT batch_id, topic, \"partition\", \"offset\", pos, y AS label, x AS feature"
        f" FROM ({_READINGS}) AS r"
    ),
    "malformed_tokens": (
        "SELECT topic, \"partition\", \"offset\", pos, token, verdict"
        f" FROM ({_parsed(_NOISY)}) AS p WHERE verdict <> 'ok'"
    ),
    "tolerant_samples": (
        "SELECT topic, \"partition\", \"offset\", pos, label, feature"
        f" FROM ({_parsed(_NOISY)}) AS p"
        " WHERE verdict = 'ok' AND isfinite(label) AND isfinite(feature)"
    ),
    "document_token_verdicts": (
        f"SELECT lang, verdict, count(*) AS n FROM ({_parsed(_DOCUMENT_TOKENS)}) AS p"
        " GROUP BY lang, verdict"
    ),
    "ridge_fit": _PART_FIT,
    "ridge_fit_per_batch": _DAY_FIT,
    "ridge_predictions": (
        'SELECT "offset", round(prediction, 6) AS prediction, label'
        f" FROM ({_PART_PREDICTIONS}) AS p"
    ),
    "ridge_predictions_per_batch": (
        'SELECT s.batch_id, s."offset", s.pos, round(weight * x + intercept, 6) AS prediction,'
        f" y AS label FROM ({_READINGS}) AS s JOIN ({_fit(_READINGS, 'batch_id')}) AS f"
        " ON s.batch_id = f.batch_id"
    ),
    "prediction_triples": (
        "SELECT round(prediction, 6) AS prediction, label, feature"
        f" FROM ({_PART_PREDICTIONS}) AS p"
    ),
    "first_pair_per_batch": _pair("ASC"),
    "last_pair_per_batch": _pair("DESC"),
    "search_band_per_batch": (
        "SELECT batch_id, round(lat_low, 6) AS lat_low, round(lat_high, 6) AS lat_high"
        f" FROM ({_BANDS}) AS b"
    ),
    "band_lookup_per_batch": _BAND_LOOKUP,
    "band_top_per_batch": _BAND_TOP,
    "sgd_fit": _sgd(
        f"SELECT y, x / (SELECT stddev_samp(x) FROM ({_PARTS}) AS a) AS x FROM ({_PARTS}) AS s",
        "0",
        100,
        "0.1",
        "1e-5",
        "1e-6",
        True,
        "2.5",
    )
    + f"SELECT {_MODEL} FROM f",
    "sgd_default_fit": _sgd(
        f"SELECT batch_id, y, x / stddev_samp(x) OVER (PARTITION BY batch_id) AS x"
        f" FROM ({_READINGS}) AS s",
        "batch_id",
        50,
        "0.2",
        "1e-3",
        "0",
        False,
    )
    + f"SELECT g AS batch_id, CAST(t AS INTEGER) AS iterations, {_MODEL} FROM f",
    "sgd_mini_batch_fit": _MINI_BATCHES
    + f"SELECT g AS batch_id, CAST(30 AS INTEGER) AS iterations, {_MODEL} FROM f",
    "scaled_features": (
        'SELECT "offset", pos, y AS label,'
        f" round(x / (SELECT stddev_samp(x) FROM ({_READINGS}) AS a), 6) AS scaled"
        f" FROM ({_READINGS}) AS s"
    ),
    "scaled_features_per_batch": (
        'SELECT batch_id, "offset", pos, y AS label,'
        f" round(x / stddev_samp(x) OVER (PARTITION BY batch_id), 6) AS scaled"
        f" FROM ({_READINGS}) AS s"
    ),
    "correlation_per_batch": (
        "SELECT batch_id, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j,"
        " CASE WHEN i = j THEN 1.0 ELSE c END AS corr FROM (SELECT batch_id,"
        f" round(corr(y, x), 6) AS c FROM ({_READINGS}) AS s GROUP BY batch_id),"
        " (VALUES (0), (1)) AS a(i), (VALUES (0), (1)) AS b(j)"
    ),
    "random_split_rows": (
        "SELECT count(*) AS n, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS doubled FROM part"
    ),
    "column_means": (
        "SELECT batch_id, round(avg(y), 6) AS mean_label, round(avg(x), 6) AS mean_feature"
        f" FROM ({_READINGS}) AS s GROUP BY batch_id"
    ),
    "correlation_matrix": (
        "SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j,"
        " CASE WHEN i = j THEN 1.0 ELSE c END AS corr"
        f" FROM (SELECT round(corr(y, x), 6) AS c FROM ({_READINGS}) AS s),"
        " (VALUES (0), (1)) AS a(i), (VALUES (0), (1)) AS b(j)"
    ),
    "in_sample_metrics": f"SELECT {_METRICS} FROM ({_PART_PREDICTIONS}) AS p",
    "holdout_split": f"SELECT k AS \"offset\", part FROM ({_SPLIT}) AS s",
    "holdout_metrics": (
        f"SELECT part, {_METRICS} FROM (SELECT part, y AS label, weight * x + intercept AS"
        f" prediction FROM ({_SPLIT}) AS s,"
        f" ({_fit('SELECT * FROM (' + _SPLIT + ') AS q WHERE part = ' + chr(39) + 'train' + chr(39))})"
        " AS f) AS p GROUP BY part"
    ),
    "windowed_fit": _DAY_FIT,
    "stream_windowed_fit": _DAY_FIT,
    "stream_nearby_top_rated": _TOP,
    "stream_model_report": (
        f"SELECT {_MODEL}, n AS tokens, CAST(0 AS BIGINT) AS malformed FROM ({_fit(_PARTS)}) AS f"
    ),
    "stream_predictions": (
        'SELECT "offset", round(prediction, 6) AS prediction, label'
        f" FROM ({_PART_PREDICTIONS}) AS p"
    ),
    "two_runs_one_table": f"SELECT * FROM ({_NEARBY}) AS a UNION ALL SELECT * FROM ({_WIDE}) AS b",
    "stream_many_batches": (
        f"SELECT {_MODEL}, round(c, 6) AS correlation, round(e, 6) AS mse, round(1 - e / syy, 6) AS r2,"
        " reviewer_id, category, lat, lng, avg_rating FROM (SELECT f.*, m.c, m.e FROM"
        f" ({_fit(_READINGS, 'batch_id')}) AS f JOIN (SELECT s.batch_id, corr(s.y, s.x) AS c,"
        " avg((g.weight * s.x + g.intercept - s.y) * (g.weight * s.x + g.intercept - s.y)) AS e"
        f" FROM ({_READINGS}) AS s JOIN ({_fit(_READINGS, 'batch_id')}) AS g"
        " ON s.batch_id = g.batch_id GROUP BY s.batch_id) AS m ON f.batch_id = m.batch_id) AS f"
        f" LEFT JOIN ({_BAND_TOP}) AS t ON f.batch_id = t.batch_id"
    ),
    "stream_published_pair": (
        'SELECT round(arg_min(prediction, "offset"), 6) AS prediction,'
        f' arg_min(label, "offset") AS label FROM ({_PART_PREDICTIONS}) AS p'
    ),
    "stream_logged_batches": (
        'SELECT batch_id AS day, "offset", pos, y AS label, x AS feature'
        f" FROM ({_READINGS}) AS s"
    ),
    "sliding_fit_from_store": (
        f"SELECT batch_id, {_MODEL} FROM ({_fit(_SEVEN_DAYS, 'batch_id')}) AS f"
    ),
    "fit_of_batch_from_store": (
        f"SELECT batch_id, {_MODEL} FROM ({_fit(_TWO_BATCHES, 'batch_id')}) AS f"
    ),
    "fit_of_days_from_store": f"SELECT {_MODEL} FROM ({_fit(_TENTH_DAYS)}) AS f WHERE n > 0",
    "stream_late_rows": (
        'SELECT topic, "partition", "offset", pos, y AS label, x AS feature'
        f' FROM ({_READINGS}) AS s JOIN events ON event_id = "offset" WHERE "offset" % 7 = 0'
        " AND ts < (SELECT max(ts) - INTERVAL 1 DAY FROM events WHERE event_id % 7 <> 0)"
    ),
    "stream_late_rows_merged": _DAY_FIT,
    "stream_published_once": f"SELECT value FROM ({_pair('ASC', _FOUR_BATCHES)}) AS p",
    "colocated_lookup": _groups(
        _RESTAURANTS, "lat BETWEEN 905 AND 920 AND lng BETWEEN 10 AND 40"
    ),
    "colocated_all_groups": _groups(_RESTAURANTS, "TRUE"),
    "band_by_place": (
        f"SELECT * FROM ({_RESTAURANTS}) AS r"
        " WHERE lat BETWEEN 905 AND 920 AND lng BETWEEN 10 AND 20"
    ),
    "exact_split_rows": (
        'SELECT "offset", pos, CASE WHEN row_number() OVER (ORDER BY md5("offset" || \'/\' || pos))'
        " <= round(0.9 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS part"
        f" FROM ({_READINGS}) AS s"
    ),
    "offset_findings": _FINDINGS,
}
