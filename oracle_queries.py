"""SQL that computes each registered query independently, over the same tables.

A floating number becomes a decimal by way of its text: that rounds the shortest decimal form
half away from zero, which is what the load does.
"""

from __future__ import annotations

_BASE = """
base AS (
  SELECT CAST(o_orderkey AS INTEGER) AS id,
         o_orderdate AS date_time,
         CASE WHEN o_orderkey % 97 <> 0 THEN n_name END AS city,
         CASE WHEN o_orderkey % 89 <> 0 THEN o_totalprice END AS temperature,
         c_acctbal AS humidity,
         CAST(o_custkey AS DOUBLE) AS pressure,
         (o_orderkey % 1000) / 8.0::DOUBLE AS wind_speed,
         o_orderpriority AS wind_direction,
         CASE WHEN o_orderkey % 83 <> 0 THEN c_mktsegment END AS precipitation,
         CAST(o_orderkey % 101 AS DOUBLE) AS cloud_cover
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
)"""

_OBS = (
    _BASE
    + """,
obs AS (
  SELECT * FROM base
  UNION ALL
  SELECT * FROM base WHERE id % 50 = 0
  UNION ALL
  SELECT * REPLACE (temperature + 0.001::DOUBLE AS temperature) FROM base WHERE id % 50 = 1
)"""
)

_COMPLETE = (
    _OBS
    + """,
complete AS (
  SELECT * FROM obs
  WHERE id IS NOT NULL AND date_time IS NOT NULL AND city IS NOT NULL
    AND temperature IS NOT NULL AND humidity IS NOT NULL AND pressure IS NOT NULL
    AND wind_speed IS NOT NULL AND wind_direction IS NOT NULL
    AND precipitation IS NOT NULL AND cloud_cover IS NOT NULL
),
cleaned AS (SELECT DISTINCT * FROM complete)"""
)


def _amount(name: str) -> str:
    return f"CAST(CAST({name} AS VARCHAR) AS DECIMAL(10,2)) AS {name}"


_AMOUNTS = ("temperature", "humidity", "pressure", "wind_speed", "cloud_cover")
_DOUBLES = ", ".join(f"CAST({a} AS DOUBLE) AS {a}" for a in _AMOUNTS)

_TYPED = (
    _COMPLETE
    + f""",
typed AS (
  SELECT id, CAST(date_time AS TIMESTAMP) AS date_time, city, wind_direction, precipitation,
         {", ".join(_amount(a) for a in _AMOUNTS)}
  FROM cleaned
)"""
)

_DIMENSIONS = (
    ("dim_city", "city", "city_id"),
    ("dim_wind_direction", "wind_direction", "wind_dir_id"),
    ("dim_precipitation", "precipitation", "precipitation_id"),
)


def _dimension(table: str, attribute: str, key: str) -> str:
    return f"""{table} AS (
  SELECT CAST(row_number() OVER (ORDER BY {attribute} NULLS LAST) AS INTEGER) AS {key}, {attribute}
  FROM (SELECT DISTINCT {attribute} FROM typed)
)"""


_STAR = (
    _TYPED
    + ",\n"
    + ",\n".join(_dimension(*d) for d in _DIMENSIONS)
    + """,
looked_up AS (
  SELECT typed.*, city_id, wind_dir_id, precipitation_id
  FROM typed
  JOIN dim_city USING (city)
  JOIN dim_wind_direction USING (wind_direction)
  JOIN dim_precipitation USING (precipitation)
),
fact AS (
  SELECT DISTINCT id, date_time, city_id, wind_dir_id, precipitation_id,
         temperature, humidity, pressure, wind_speed, cloud_cover
  FROM looked_up
)"""
)

_FACT = f"""WITH {_STAR}
SELECT id, date_time, city_id, wind_dir_id, precipitation_id, {_DOUBLES} FROM fact"""

_PROPS = """
cut AS (
  SELECT event_id,
         CASE WHEN event_id % 10 = 0 THEN left(props, length(props) - 1) ELSE props END AS payload
  FROM events
)"""

_COLUMNS = (
    "id",
    "date_time",
    "city",
    "temperature",
    "humidity",
    "pressure",
    "wind_speed",
    "wind_direction",
    "precipitation",
    "cloud_cover",
)

_BROKEN = """broken AS (
  SELECT * REPLACE (CASE WHEN id % 7 = 0 THEN city_id + 1000 ELSE city_id END AS city_id) FROM fact
)"""


def _audits() -> str:
    parts = []
    for table, _, key in _DIMENSIONS:
        parts.append(
            f"SELECT 'pk {table}' AS audit, {key} AS key, count(*) AS n_rows FROM {table} "
            f"GROUP BY {key} HAVING count(*) > 1"
        )
        parts.append(
            f"SELECT 'fk {table}' AS audit, {key} AS key, count(*) AS n_rows FROM broken "
            f"WHERE NOT EXISTS (SELECT 1 FROM {table} d WHERE d.{key} = broken.{key}) "
            f"GROUP BY {key}"
        )
    return "\nUNION ALL\n".join(parts)


ORACLES: dict[str, str] = {
    "scan_wide": f"WITH {_BASE} SELECT * FROM base",
    "json_parse_sensor": """
SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y/%m/%d') AS date,
       value AS temperature, CAST(user_id AS DOUBLE) AS humidity
FROM events""",
    "json_parse_weather": f"WITH {_BASE} SELECT * FROM base",
    "json_bad_records": f"""WITH {_PROPS}
SELECT event_id,
       CASE WHEN right(payload, 1) = '}}'
            THEN CAST(json_extract(payload, '$.k') AS INTEGER) END AS k
FROM cut""",
    "json_quarantine": f"""WITH {_PROPS}
SELECT event_id,
       CASE WHEN right(payload, 1) = '}}'
            THEN CAST(json_extract(payload, '$.k') AS INTEGER) END AS k,
       CASE WHEN right(payload, 1) <> '}}' THEN payload END AS payload
FROM cut""",
    "clean_dropna": f"WITH {_COMPLETE} SELECT * FROM complete",
    "clean_dedup": f"WITH {_OBS} SELECT DISTINCT * FROM obs",
    "clean_dup_columns": f"""WITH {_COMPLETE}
SELECT *, CAST(id AS VARCHAR) AS id_text FROM cleaned""",
    "clean_constant_columns": f"WITH {_COMPLETE} SELECT * FROM cleaned",
    "clean_all": f"WITH {_COMPLETE} SELECT * FROM cleaned",
    "typed_load": f"""WITH {_TYPED}
SELECT id, date_time, city, wind_direction, precipitation,
       CAST(temperature AS VARCHAR) AS temperature, CAST(humidity AS VARCHAR) AS humidity,
       CAST(pressure AS VARCHAR) AS pressure, CAST(wind_speed AS VARCHAR) AS wind_speed,
       CAST(CAST(NULL AS DECIMAL(10,2)) AS VARCHAR) AS cloud_cover
FROM typed""",
    "surrogate_key_large": """
SELECT slot, member, row_number() OVER (PARTITION BY slot ORDER BY member NULLS LAST) AS key
FROM (SELECT DISTINCT 'part' AS slot, p_name AS member FROM part
      UNION ALL
      SELECT DISTINCT 'customer' AS slot, c_name AS member FROM customer)""",
    "fact_lookup_join": f"""WITH {_STAR}
SELECT id, date_time, city, wind_direction, precipitation,
       city_id, wind_dir_id, precipitation_id, {_DOUBLES} FROM looked_up""",
    "fact_lookup_shuffled": _FACT,
    "star_fact": _FACT,
    "star_load": _FACT,
    "star_fact_exact": _FACT.replace("temperature + 0.001::DOUBLE", "temperature").replace(
        "(o_orderkey % 1000) / 8.0::DOUBLE", "CAST(o_orderkey % 1000 AS DOUBLE)"
    ),
    "star_join_back": f"""WITH {_TYPED}
SELECT DISTINCT id, date_time, city, wind_direction, precipitation, {_DOUBLES} FROM typed""",
    "star_empty_on_constant_key": _FACT.replace(
        "n_name END AS city", "'osto' END AS city"
    ).replace(
        "SELECT id, CAST(date_time AS TIMESTAMP) AS date_time, city,",
        "SELECT id, CAST(date_time AS TIMESTAMP) AS date_time, CAST(NULL AS VARCHAR) AS city,",
    ),
    "star_protected_key": _FACT.replace("n_name END AS city", "'osto' END AS city"),
    "audit_pk": f"""WITH {_OBS}
SELECT id, count(*) AS n_rows FROM obs GROUP BY id HAVING count(*) > 1""",
    "audit_fk": """
SELECT doc_id, count(*) AS n_rows FROM documents
WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)
GROUP BY doc_id""",
    "audit_star": f"WITH {_STAR},\n{_BROKEN}\n{_audits()}",
    "preview_topk": f"""WITH {_OBS}
SELECT * FROM obs ORDER BY {", ".join(f"{c} NULLS LAST" for c in _COLUMNS)} LIMIT 5""",
    "load_metrics": f"WITH {_OBS}\n"
    + "\nUNION ALL\n".join(
        f"SELECT count(*) AS n_rows, '{c}' AS column_name, count(*) - count({c}) AS n_nulls "
        "FROM obs"
        for c in _COLUMNS
    ),
    "stream_ingest_events": "SELECT * FROM events",
    "stream_idempotent": "SELECT * FROM events",
    "stream_console": "SELECT count(*) AS n_rows FROM events",
    "stream_compacted": "SELECT * FROM events",
    "stream_quarantine": f"""WITH {_PROPS}
SELECT CASE WHEN right(payload, 1) = '}}'
            THEN CAST(json_extract(payload, '$.k') AS INTEGER) END AS k,
       CASE WHEN right(payload, 1) <> '}}' THEN payload END AS payload
FROM cut""",
    "stream_batch_metrics": f"""WITH {_PROPS}
SELECT event_id % 4 AS batch_id, count(*) AS n_rows,
       count(*) FILTER (WHERE right(payload, 1) <> '}}') AS n_rejected
FROM cut GROUP BY 1""",
    "stream_to_star": _FACT,
}
ORACLES["stream_sensor_to_table"] = ORACLES["json_parse_sensor"]
ORACLES.update(
    {
        table: f"WITH {_TYPED},\n{_dimension(table, attribute, key)}\nSELECT * FROM {table}"
        for table, attribute, key in _DIMENSIONS
    }
)
