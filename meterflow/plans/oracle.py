"""The queries of the catalog as SQL for DuckDB, written from their meaning.

The event table lies in January 2024, when Europe/Sarajevo is one hour ahead of UTC.
"""

from __future__ import annotations

_R = """r AS (
  SELECT e.event_id AS "readingID", e.user_id AS "meterID", CAST(c.c_nationkey AS BIGINT) AS "cityID",
         e.ts, CAST(epoch_us(e.ts) // 1000000 AS BIGINT) AS sec, e.value AS delta
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
)"""

_C = """c AS (
  SELECT CAST(n_nationkey AS BIGINT) AS "cityID", n_name AS "cityName",
         42 + n_nationkey * CAST(0.1 AS DOUBLE) AS latitude, 16 + n_nationkey * CAST(0.1 AS DOUBLE) AS longitude
  FROM nation
)"""

_H = """h AS (
  SELECT "meterID", "date", CAST(year("date") AS INTEGER) AS "year", CAST(month("date") AS INTEGER) AS "month",
         CAST(hour("date") AS INTEGER) AS "hour", total
  FROM (SELECT o_custkey AS "meterID", o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS "date",
               o_totalprice AS total FROM orders)
)"""

_HOURLY = """hourly AS (
  SELECT "meterID", "cityID", sec // 3600 * 3600 AS window_start, sec // 3600 * 3600 + 3600 AS window_end,
         round(sum(delta), 5) AS "aggregatedActiveDelta"
  FROM r GROUP BY ALL
)"""

_CITY_TOTALS = """city_totals AS (
  SELECT "cityID", sec // 3 * 3 AS window_start, sec // 3 * 3 + 3 AS window_end,
         round(sum(delta), 5) AS "aggregatedActiveDelta"
  FROM r GROUP BY ALL
)"""

_COUNTRY_TOTALS = """country_totals AS (
  SELECT sec // 3 * 3 AS window_start, sec // 3 * 3 + 3 AS window_end,
         round(sum(delta), 5) AS "aggregatedActiveDelta"
  FROM (SELECT epoch_us(ts) // 1000000 AS sec, value AS delta FROM events) GROUP BY ALL
)"""

_CITY_POINTS = """points AS (
  SELECT 'city-aggregation' AS measurement, CAST("cityID" AS VARCHAR) AS "cityID", "cityName",
         window_end AS "time", unnest(['aggregatedActiveDelta', 'latitude', 'longitude']) AS field,
         round(unnest(["aggregatedActiveDelta", latitude, longitude]), 5) AS value
  FROM city_totals JOIN c USING ("cityID")
)"""

_COUNTRY_POINTS = """points AS (
  SELECT 'country-aggregation' AS measurement, window_end AS "time", 'aggregatedActiveDelta' AS field,
         "aggregatedActiveDelta" AS value
  FROM country_totals
)"""

# Local midnight and the time the dashboard is looked at, in epoch seconds.
_DAY = """day AS (
  SELECT CAST(epoch(TIMESTAMP '2024-01-14 23:00:00') AS BIGINT) AS midnight,
         CAST(epoch(TIMESTAMP '2024-01-15 18:30:00') AS BIGINT) AS as_of
)"""

_PARTS = """parts AS (
  SELECT *, CASE WHEN "month" <= 3 THEN 'Winter' WHEN "month" <= 6 THEN 'Spring'
                 WHEN "month" <= 9 THEN 'Summer' ELSE 'Fall' END AS season,
         CASE WHEN "hour" < 7 THEN 'night' WHEN "hour" < 9 THEN 'morning'
              WHEN "hour" < 17 THEN 'working' ELSE 'evening' END AS daypart
  FROM h
)"""


def _half_up(average: str) -> str:
    """Five digits, rounded as a decimal: averages often lie exactly between two roundings."""
    return f"CAST(round(CAST({average} AS DECIMAL(38, 8)), 5) AS DOUBLE)"


def _with(*ctes: str, select: str) -> str:
    return f"WITH {', '.join(ctes)} {select}"


_hourly_by_meter = _with(_R, _HOURLY, select="SELECT * FROM hourly")
_total_by_city = _with(
    _R, _C, _CITY_TOTALS,
    select="""SELECT "cityID", "cityName", latitude, longitude, window_start, window_end, "aggregatedActiveDelta"
              FROM city_totals JOIN c USING ("cityID")""",
)
_total_consumption = _with(_COUNTRY_TOTALS, select="SELECT * FROM country_totals")
_yearly = """SELECT "year", "meterID", sum(total) AS total FROM h GROUP BY ALL"""
_reconciled = _with(
    _R, _HOURLY,
    select="""SELECT *, CAST(year(make_timestamp(window_start * 1000000)) AS INTEGER) AS "year",
                     CAST(month(make_timestamp(window_start * 1000000)) AS INTEGER) AS "month",
                     CAST(hour(make_timestamp(window_start * 1000000)) AS INTEGER) AS "hour"
              FROM hourly""",
)
_city_points = _with(_R, _C, _CITY_TOTALS, _CITY_POINTS, select="SELECT * FROM points")

_above_average = _with(
    _H,
    f"""totals AS (SELECT "meterID", total FROM ({_yearly}) WHERE "year" = 1997)""",
    select=f"""SELECT "meterID", round(total, 5) AS "totalConsumptionInYear",
                      (SELECT {_half_up('avg(total)')} FROM totals) AS "averageYearlyConsumption"
               FROM totals WHERE total >= (SELECT avg(total) FROM totals)""",
)
_city_hourly_bars = _with(
    _R, _C, _CITY_TOTALS, _CITY_POINTS, _DAY,
    """today AS (
      SELECT "cityID", "cityName", "time", value FROM points, day
      WHERE field = 'aggregatedActiveDelta' AND "time" >= midnight AND "time" < as_of
    )""",
    """hours AS (
      SELECT "cityID", "cityName", unnest(range(midnight, as_of, 3600)) AS "time"
      FROM (SELECT DISTINCT "cityID", "cityName" FROM today), day
    )""",
    select="""SELECT h."cityID", h."cityName", h."time", round(sum(value), 5) AS value
              FROM hours h LEFT JOIN today t
                ON h."cityID" = t."cityID" AND t."time" >= h."time" AND t."time" < h."time" + 3600
              GROUP BY ALL""",
)


_rollback = """
        SELECT * FROM (
          SELECT event_id AS "readingID", user_id AS "meterID", value AS "activeDelta",
                 lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous
          FROM events
        ) WHERE "activeDelta" < previous"""

_city_map = _with(
        _R, _C, _CITY_TOTALS, _DAY,
        """windowed AS (
          SELECT t.*, row_number() OVER (PARTITION BY "cityID" ORDER BY window_end DESC) AS age
          FROM city_totals t, day WHERE window_end >= as_of - 43200 AND window_end < as_of
        )""",
        select="""SELECT CAST("cityID" AS VARCHAR) AS "cityID", "cityName", window_end AS "time",
                         "aggregatedActiveDelta", round(latitude, 5) AS latitude, round(longitude, 5) AS longitude
                  FROM windowed JOIN c USING ("cityID") WHERE age = 1""",
    )

_diff = _with(
        _R,
        """utc AS (
          SELECT "meterID", "cityID", strftime(ts, '%Y-%m-%d') AS "date", round(sum(delta), 5) AS actual
          FROM r GROUP BY ALL
        )""",
        """here AS (
          SELECT "meterID", "cityID", strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%d') AS "date",
                 round(sum(delta), 5) AS expected
          FROM r GROUP BY ALL
        )""",
        select="""SELECT *, CASE WHEN expected IS NULL THEN 'unexpected' WHEN actual IS NULL THEN 'missing'
                                 ELSE 'different' END AS status
                  FROM utc FULL JOIN here USING ("meterID", "cityID", "date")
                  WHERE actual IS DISTINCT FROM expected""",
    )


ORACLE = {
    "hourly_untimed": _with(
        _R,
        select="""SELECT "meterID", "cityID", sec // 3600 * 3600 AS window_start, sec // 3600 * 3600 + 3600 AS window_end,
                         round(sum(delta), 5) AS "aggregatedActiveDelta"
                  FROM r WHERE "readingID" % 7 <> 0 GROUP BY ALL""",
    ),
    "hourly_by_meter": _hourly_by_meter,
    "total_by_city": _total_by_city,
    "total_by_city_all": _with(
        _R, _C, _CITY_TOTALS,
        select="""SELECT t."cityID", c."cityName", c.latitude, c.longitude, window_start, window_end,
                         "aggregatedActiveDelta"
                  FROM city_totals t LEFT JOIN c ON t."cityID" = c."cityID" AND c.latitude < 43.45""",
    ),
    "total_consumption": _total_consumption,
    "meter_window_sum": """
        SELECT user_id AS "meterID", (s - 300) // 900 * 900 + 300 AS window_start,
               (s - 300) // 900 * 900 + 1200 AS window_end, round(sum(value), 5) AS "aggregatedActiveDelta"
        FROM (SELECT *, epoch_us(ts) // 1000000 AS s FROM events) GROUP BY ALL""",
    "unix_window_sql_text": """
        SELECT user_id AS "meterID", CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS window_start,
               CAST(epoch(date_trunc('hour', ts)) AS BIGINT) + 3600 AS window_end,
               round(sum(value), 5) AS "aggregatedActiveDelta"
        FROM events GROUP BY ALL""",
    "parse_props": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
    "parse_readings": """
        SELECT event_id, CASE WHEN ok THEN user_id END AS "meterID",
               CASE WHEN ok THEN CAST(1 AS BIGINT) END AS "cityID",
               CASE WHEN ok THEN CAST(epoch_us(ts) // 1000000 AS BIGINT) END AS "timestamp",
               CASE WHEN ok THEN value END AS "activeDelta"
        FROM (SELECT *, event_type <> 'error' AS ok FROM events)""",
    "parse_quarantine": """
        SELECT event_type, CASE WHEN event_type = 'error' THEN 'bad' ELSE 'good' END AS status, count(*) AS n
        FROM events GROUP BY ALL""",
    "hourly_messages": _with(
        _R, _HOURLY,
        select="""SELECT '{' || "meterID" || ', {' || window_start || ', ' || window_end || '}}' AS key,
                         '{"meterID":' || "meterID" || ',"cityID":' || "cityID"
                         || ',"unix_window":{"start":' || window_start || ',"end":' || window_end || '}'
                         || ',"aggregatedActiveDelta":' || "aggregatedActiveDelta" || '}' AS value
                  FROM hourly""",
    ),
    "city_messages": _with(
        _R, _C, _CITY_TOTALS,
        select="""SELECT CAST("cityID" AS VARCHAR) AS key, "cityID", "cityName", latitude, longitude,
                         window_start, window_end, "aggregatedActiveDelta"
                  FROM city_totals JOIN c USING ("cityID")""",
    ),
    "reconcile_hourly": _reconciled,
    "reconcile_latest": _with(
        _R, _HOURLY,
        select="""SELECT * REPLACE (0 - "aggregatedActiveDelta" AS "aggregatedActiveDelta") FROM hourly""",
    ),
    "store_rows_from_messages": _reconciled,
    "compact_latest": """
        SELECT CAST(user_id AS VARCHAR) AS key, arg_max(value, event_id) AS value FROM events GROUP BY ALL""",
    "hourly_store_merge": _reconciled,
    "hourly_store_compacted": _reconciled,
    "hourly_store_settled": _reconciled,
    "hourly_store_append": f"""SELECT * FROM ({_reconciled}) WHERE "year" = 2024""",
    "json_snapshot": _hourly_by_meter,
    "parquet_snapshot": _total_consumption,
    "city_table": _with(
        _C, select="""SELECT "cityID", "cityName", round(latitude, 5) AS latitude, round(longitude, 5) AS longitude
                      FROM c"""
    ),
    "yearly_by_meter": _with(
        _H, select="""SELECT "year", "meterID", round(sum(total), 5) AS "totalYearlyConsumption" FROM h GROUP BY ALL"""
    ),
    "yearly_from_totals": _with(
        _H, select="""SELECT "year", "meterID", round(sum(total), 5) AS "totalYearlyConsumption" FROM h GROUP BY ALL"""
    ),
    "yearly_average": _with(
        _H,
        select=f"""SELECT "year", {_half_up('avg(total)')} AS "averageYearlyConsumption"
                   FROM ({_yearly}) GROUP BY ALL""",
    ),
    "above_average": _above_average,
    "above_average_sql": _above_average,
    "above_average_by_year": _with(
        _H,
        select=f"""SELECT "year", "meterID", round(total, 5) AS "totalConsumptionInYear",
                          {_half_up('average')} AS "averageYearlyConsumption"
                   FROM (SELECT *, avg(total) OVER (PARTITION BY "year") AS average FROM ({_yearly}))
                   WHERE total >= average""",
    ),
    "top_consumers": _with(
        _H,
        select=f"""SELECT "year", "meterID", round(total, 5) AS "totalYearlyConsumption" FROM ({_yearly})
                   ORDER BY total DESC, "year", "meterID" LIMIT 10""",
    ),
    "top_consumers_per_year": _with(
        _H,
        select=f"""SELECT "year", "meterID", round(total, 5) AS "totalYearlyConsumption", CAST(rank AS INTEGER) AS rank
                   FROM (SELECT *, row_number() OVER (PARTITION BY "year" ORDER BY total DESC, "meterID") AS rank
                         FROM ({_yearly}))
                   WHERE rank <= 10""",
    ),
    "season_hour_profile": _with(
        _H,
        select=f"""SELECT "hour", {_half_up('avg(total) FILTER (WHERE "month" BETWEEN 1 AND 3)')} AS "Winter",
                         {_half_up('avg(total) FILTER (WHERE "month" BETWEEN 4 AND 6)')} AS "Spring",
                         {_half_up('avg(total) FILTER (WHERE "month" BETWEEN 7 AND 8)')} AS "Summer",
                         {_half_up('avg(total) FILTER (WHERE "month" BETWEEN 9 AND 12)')} AS "Fall"
                  FROM h GROUP BY "hour" ORDER BY "hour" """,
    ),
    "daily_average": _with(
        _H,
        select=f"""SELECT CAST(day("date") AS INTEGER) AS "day", {_half_up('avg(total)')} AS "averageActiveDelta"
                  FROM h GROUP BY ALL""",
    ),
    "daily_by_meter": _with(
        _R,
        select="""SELECT "meterID", "cityID", strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%d') AS "date",
                         round(sum(delta), 5) AS "aggregatedActiveDelta"
                  FROM r GROUP BY ALL""",
    ),
    "daypart_profile": _with(
        _H, _PARTS,
        select=f"""SELECT season, daypart, round(sum(total), 5) AS total, {_half_up('avg(total)')} AS average,
                         count(total) AS n
                  FROM parts GROUP BY ALL""",
    ),
    "city_points": _city_points,
    "country_points": _with(_COUNTRY_TOTALS, _COUNTRY_POINTS, select="SELECT * FROM points"),
    "points_from_messages": _city_points,
    "city_hourly_bars": _city_hourly_bars,
    "country_hourly_bars": _with(
        _COUNTRY_TOTALS, _COUNTRY_POINTS, _DAY,
        """today AS (SELECT "time", value FROM points, day WHERE "time" >= midnight AND "time" < as_of)""",
        """hours AS (
          SELECT unnest(range(midnight, as_of, 3600)) AS "time" FROM day WHERE EXISTS (SELECT 1 FROM today)
        )""",
        select="""SELECT h."time", round(sum(value), 5) AS value
                  FROM hours h LEFT JOIN today t ON t."time" >= h."time" AND t."time" < h."time" + 3600
                  GROUP BY ALL""",
    ),
    "country_hourly_bars_unfilled": _with(
        _COUNTRY_TOTALS, _COUNTRY_POINTS, _DAY,
        select="""SELECT "time" // 3600 * 3600 AS "time", round(sum(value), 5) AS value FROM points, day
                  WHERE "time" >= midnight AND "time" < as_of GROUP BY ALL""",
    ),
    "last_per_series": _with(
        _R, _C, _CITY_TOTALS, _CITY_POINTS,
        select="""SELECT measurement, "cityID", "cityName", field, max("time") AS "time",
                         arg_max(value, "time") AS value
                  FROM points GROUP BY ALL""",
    ),
    "city_map_latest": _city_map,
    "city_series_today": _with(
        _R, _C, _CITY_TOTALS, _CITY_POINTS, _DAY,
        select="""SELECT "time", value AS "aggregatedActiveDelta" FROM points, day
                  WHERE "cityName" = 'NATION_7' AND field = 'aggregatedActiveDelta'
                    AND "time" >= midnight AND "time" < as_of
                  ORDER BY "time" """,
    ),
    "country_series_today": _with(
        _COUNTRY_TOTALS, _COUNTRY_POINTS, _DAY,
        select="""SELECT "time", value FROM points, day WHERE "time" >= midnight AND "time" < as_of
                  ORDER BY "time" """,
    ),
    "out_of_profile": """
        SELECT "readingID", "meterID", "timestamp", "activeDelta", lower, upper
        FROM (
          SELECT event_id AS "readingID", user_id AS "meterID",
                 CAST(epoch_us(ts) // 1000000 AS BIGINT) AS "timestamp", value AS "activeDelta",
                 round(CASE WHEN hour(ts) < 7 THEN 1.0 WHEN hour(ts) < 9 THEN 2.0
                            WHEN hour(ts) < 17 THEN 1.5 ELSE 2.0 END::DOUBLE * f, 5) AS lower,
                 round(CASE WHEN hour(ts) < 7 THEN 20.0 WHEN hour(ts) < 9 THEN 30.0
                            WHEN hour(ts) < 17 THEN 25.0 ELSE 40.0 END::DOUBLE * f, 5) AS upper
          FROM (SELECT *, CASE WHEN month(ts) IN (1, 2, 3, 7, 8, 9) THEN 1.4 ELSE 1.0 END::DOUBLE AS f FROM events)
        )
        WHERE "activeDelta" < lower OR "activeDelta" > upper""",
    "out_of_learnt_profile": """
        WITH e AS (SELECT event_id AS "readingID", user_id AS "meterID", CAST(epoch_us(ts) // 1000000 AS BIGINT) AS "timestamp",
                          value AS "activeDelta", (month(ts) - 1) // 3 AS quarter,
                          CASE WHEN hour(ts) < 7 THEN 0 WHEN hour(ts) < 9 THEN 1 WHEN hour(ts) < 17 THEN 2 ELSE 3 END AS part
                   FROM events),
             ordered AS (SELECT quarter, part, list_sort(list("activeDelta")) AS v, count(*) AS n FROM e GROUP BY ALL),
             bounds AS (SELECT quarter, part, v[ceil(0.02::DOUBLE * n)::INT] AS lower, v[ceil(0.98::DOUBLE * n)::INT] AS upper FROM ordered)
        SELECT "readingID", "meterID", "timestamp", "activeDelta", lower, upper
        FROM e JOIN bounds USING (quarter, part) WHERE "activeDelta" < lower OR "activeDelta" > upper""",
    "rollback": _rollback,
    "negative_delta": """
        SELECT event_id AS "readingID", user_id AS "meterID", round(value - 20, 5) AS "activeDelta"
        FROM events WHERE value < 20""",
    "diff_aggregates": _diff,
    "stream_hourly": _hourly_by_meter,
    "stream_city": _total_by_city,
    "stream_country": _total_consumption,
    "stream_signed": """
        SELECT sec // 518400 * 518400 AS window_start, sec // 518400 * 518400 + 518400 AS window_end,
               round(sum(value - 20), 5) AS "aggregatedActiveDelta"
        FROM (SELECT epoch_us(ts) // 1000000 AS sec, value FROM events) GROUP BY ALL""",
    "stream_late_rows": """
        WITH e AS (SELECT epoch_us(ts) AS us, value, day(ts) AS d, event_id % 10 = 0 AND day(ts) <= 24 AS late FROM events),
             seen AS (SELECT max(us) // 1000 - 5000 AS mark FROM e WHERE NOT late AND d <= 24)
        SELECT us // 3000000 * 3 AS window_start, us // 3000000 * 3 + 3 AS window_end,
               round(sum(value), 5) AS "aggregatedActiveDelta"
        FROM e, seen WHERE NOT late OR (us // 3000000 * 3 + 3) * 1000 > mark GROUP BY ALL""",
    "stream_late_counts": """
        WITH e AS (SELECT epoch_us(ts) AS us, day(ts) AS d, event_id % 10 = 0 AND day(ts) <= 24 AS late FROM events),
             seen AS (SELECT max(us) // 1000 - 5000 AS mark FROM e WHERE NOT late AND d <= 24)
        SELECT CAST(4 AS BIGINT) AS batch, (SELECT count(*) FROM e WHERE late) AS input_rows,
               count(DISTINCT us // 3000000) AS late_windows
        FROM e, seen WHERE late AND (us // 3000000 * 3 + 3) * 1000 <= mark""",
    "stream_repeated": _hourly_by_meter,
    "stream_rollback": _rollback,
    "stream_city_map": _city_map,
    "stream_hourly_bars": _city_hourly_bars,
    "stream_diff": _diff,
    "stream_job_hourly": _hourly_by_meter,
    "stream_job_city": _total_by_city,
    "stream_job_country": _total_consumption,
    "stream_country_points": _with(_COUNTRY_TOTALS, _COUNTRY_POINTS, select="SELECT * FROM points"),
    "points_compacted": _city_points,
    "stream_points": _city_points,
    "stream_points_committed": _city_points,
    "stream_city_bars": _city_hourly_bars,
}
