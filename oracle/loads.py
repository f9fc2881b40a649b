"""Checks of loads in batches."""

from oracle import relational

_SENT = "SELECT req_id, created_at, status_code, (dayofyear(created_at) % 3)::INT AS load FROM replayed_logs"

SQL = {
    "archived_point_lookup": relational.SQL["point_lookup"],
    "keyed_upserts": f"""SELECT req_id, created_at, status_code FROM (SELECT *, row_number() OVER
        (PARTITION BY req_id ORDER BY load DESC, created_at DESC) AS rn FROM ({_SENT})) WHERE rn = 1""",
    "insert_ignored": f"""SELECT req_id, created_at, load FROM (SELECT *, row_number() OVER
        (PARTITION BY req_id ORDER BY load, created_at) AS rn FROM ({_SENT})) WHERE rn = 1""",
}
