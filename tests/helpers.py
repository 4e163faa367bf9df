import datetime as dt

EPOCH = dt.date(1970, 1, 1)
LOG_DDL = (
    "event_id bigint, schema_name string, table_name string, action string, action_tstamp_tx bigint, "
    "row_data bigint, changed_fields bigint, client_query string, statement_only boolean"
)
SRC_DDL = "id bigint, amount double, updated_at bigint, year bigint, month bigint, day bigint"


def ep(d: dt.date, seconds: int = 0) -> int:
    return (d - EPOCH).days * 86400 + seconds


def log_df(spark, rows):
    """rows: (event_id, table, action, tstamp, row_data, changed_fields)."""
    full = [(e, "public", t, a, ts, k, cf, None, k is None) for e, t, a, ts, k, cf in rows]
    return spark.createDataFrame(full, LOG_DDL)


def src_df(spark, rows):
    """rows: (id, amount, date)."""
    return spark.createDataFrame(
        [(i, float(a), ep(d, 3600), d.year, d.month, d.day) for i, a, d in rows], SRC_DDL
    )
