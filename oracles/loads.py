"""Oracle bodies of the ingest and load queries."""

from __future__ import annotations

from oracles.sql import AS_OF, CUT, OPEN_END

_DIFFERS = " OR ".join(
    f"o.{c} IS DISTINCT FROM b.{c}"
    for c in ("forecast_intensity", "actual_intensity", "index_forecast", "index_actual")
)
_OPEN = f"(SELECT * FROM raw_old WHERE valid_to_dttm = {OPEN_END})"
_VALUES = "forecast_intensity, actual_intensity, index_forecast, index_actual"
_LAST = (
    "row_number() OVER (PARTITION BY data_from_dttm, data_to_dttm "
    "ORDER BY created_at DESC, id DESC) = 1"
)
_DOC = """id, data_from_dttm AS from_dttm, data_to_dttm AS to_dttm,
          forecast_intensity AS forecast, actual_intensity AS actual, index_forecast AS index"""
_LOOKBACK = "(SELECT max(data_date) - 7 FROM daily_old)"

BODIES: dict[str, tuple[str, str]] = {
    "feed_parse": (
        "obs",
        f"SELECT id // 48 AS response_id, {_DOC} FROM obs",
    ),
    "feed_flatten": ("obs", "SELECT *, created_at AS src_processed_dttm FROM obs"),
    "feed_upsert": (
        "obs_old obs_new",
        f"""SELECT m.*, inserted, modified, inserted + modified AS saved
            FROM (SELECT {_DOC}, created_at FROM
                    (SELECT * FROM (SELECT * FROM obs_old QUALIFY {_LAST})
                     UNION ALL
                     SELECT * REPLACE ({AS_OF} AS created_at)
                     FROM (SELECT * FROM obs_new QUALIFY {_LAST}))
                  QUALIFY {_LAST}) m,
                 (SELECT count(*) FILTER (k.data_from_dttm IS NULL) AS inserted,
                         count(k.data_from_dttm) AS modified
                  FROM (SELECT DISTINCT data_from_dttm, data_to_dttm FROM obs_new) n
                  LEFT JOIN (SELECT DISTINCT data_from_dttm, data_to_dttm FROM obs_old) k
                       ON n.data_from_dttm = k.data_from_dttm
                      AND n.data_to_dttm = k.data_to_dttm)""",
    ),
    "incremental_extract": (
        "obs raw_old",
        """SELECT id, created_at FROM obs
           WHERE created_at > (SELECT max(src_processed_dttm) FROM raw_old)""",
    ),
    "table_statistics": (
        "obs",
        "SELECT count(*) AS total_records, max(created_at) AS latest_record_time FROM obs",
    ),
    "recent_counts": (
        "obs",
        """SELECT count(*) AS total_records,
                  count(*) FILTER (created_at >= TIMESTAMP '2024-01-28 23:00:00')
                    AS recent_records FROM obs""",
    ),
    "latest_records": (
        "obs",
        f"SELECT {_DOC}, created_at FROM obs ORDER BY created_at DESC, id DESC LIMIT 10",
    ),
    "scd2_merge": (
        "raw_old batch",
        f"""SELECT data_from_dttm, data_to_dttm, {_VALUES}, valid_from_dttm, valid_to_dttm,
                   src_processed_dttm, processed_dttm
            FROM raw_old WHERE valid_to_dttm <> {OPEN_END}
            UNION ALL
            SELECT o.data_from_dttm, o.data_to_dttm, o.forecast_intensity, o.actual_intensity,
                   o.index_forecast, o.index_actual, o.valid_from_dttm,
                   if(b.id IS NOT NULL AND ({_DIFFERS}), {AS_OF} - INTERVAL 1 SECOND,
                      o.valid_to_dttm), o.src_processed_dttm, o.processed_dttm
            FROM {_OPEN} o LEFT JOIN batch b
                 ON o.data_from_dttm = b.data_from_dttm AND o.data_to_dttm = b.data_to_dttm
            UNION ALL
            SELECT b.data_from_dttm, b.data_to_dttm, b.forecast_intensity, b.actual_intensity,
                   b.index_forecast, b.index_actual, {AS_OF}, {OPEN_END}, b.created_at, {AS_OF}
            FROM batch b LEFT JOIN {_OPEN} o
                 ON o.data_from_dttm = b.data_from_dttm AND o.data_to_dttm = b.data_to_dttm
            WHERE o.id IS NULL OR {_DIFFERS}""",
    ),
    "load_stats": (
        "raw_old batch",
        f"""SELECT *, extracted = 0 OR loaded >= 0.9 * extracted AS transfer_ok
            FROM (SELECT count(*) AS extracted, count(*) FILTER (o.id IS NULL) AS inserted,
                         count(*) FILTER (o.id IS NOT NULL AND ({_DIFFERS})) AS reversioned,
                         inserted + reversioned AS loaded
                  FROM batch b LEFT JOIN {_OPEN} o
                       ON o.data_from_dttm = b.data_from_dttm
                      AND o.data_to_dttm = b.data_to_dttm)""",
    ),
    "ods_watermark": (
        "stg ods_old",
        f"""SELECT id, processed_dttm FROM stg
            WHERE processed_dttm > (SELECT max({CUT}) FROM ods_old)""",
    ),
    "ods_delete_insert": (
        "ods ods_old",
        f"""SELECT * FROM ods_old WHERE period_key NOT IN
              (SELECT period_key FROM ods WHERE source_processed_dttm > {CUT})
            UNION ALL SELECT * FROM ods WHERE source_processed_dttm > {CUT}""",
    ),
    "daily_lookback": (
        "ods daily_old",
        f"SELECT source_id, data_date FROM ods WHERE data_date >= {_LOOKBACK}",
    ),
    "daily_merge": (
        "daily daily_old",
        f"""SELECT * FROM daily WHERE data_date >= {_LOOKBACK}
            UNION ALL SELECT * FROM daily_old WHERE data_date < {_LOOKBACK}""",
    ),
    "fact_watermark": (
        "hist hist_old",
        """SELECT id, processed_dttm FROM hist
           WHERE processed_dttm > (SELECT max(processed_dttm) FROM hist_old)""",
    ),
    "fact_append": (
        "fact_old fact_new",
        "SELECT * FROM fact_old UNION ALL SELECT * FROM fact_new",
    ),
    "accuracy_watermark": (
        "fact fact_old",
        """SELECT fact_key, data_from_dttm FROM fact
           WHERE actual_intensity IS NOT NULL AND data_from_dttm >
             (SELECT max(data_from_dttm) FROM fact_old WHERE actual_intensity IS NOT NULL)""",
    ),
}
_AT_LEAD = f"""
    SELECT v.*, o.actual_intensity AS actual_intensity, v.forecast_intensity - o.actual_intensity AS error,
           abs(v.forecast_intensity - o.actual_intensity) AS absolute_error
    FROM (SELECT data_from_dttm, data_to_dttm, lead_hours, forecast_intensity,
                 valid_from_dttm AS forecast_made_at
          FROM raw, (VALUES (1), (6), (24)) leads(lead_hours)
          WHERE valid_from_dttm <= data_from_dttm - to_hours(lead_hours)
            AND valid_to_dttm + INTERVAL 1 SECOND > data_from_dttm - to_hours(lead_hours)
          QUALIFY row_number() OVER (PARTITION BY data_from_dttm, data_to_dttm, lead_hours
                                     ORDER BY valid_from_dttm DESC, id DESC) = 1) v
    JOIN raw o ON o.data_from_dttm = v.data_from_dttm AND o.data_to_dttm = v.data_to_dttm
              AND o.valid_to_dttm = {OPEN_END}"""
BODIES["forecast_at_lead"] = ("raw", _AT_LEAD)
BODIES["lead_accuracy"] = (
    "raw",
    f"""SELECT lead_hours, count(*) AS periods, count(error) AS with_actual, avg(error) AS mean_error,
               avg(absolute_error) AS mean_absolute_error FROM ({_AT_LEAD}) GROUP BY lead_hours""",
)
# an overtaken delivery changes nothing
BODIES["scd2_late"] = BODIES["scd2_merge"]
