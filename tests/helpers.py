import datetime as dt
from decimal import Decimal


def ts(day: int, time: str) -> dt.datetime:
    h, m = map(int, time.split(":"))
    return dt.datetime(2024, 3, day, h, m)


def clean(spark, rows):
    """(user, timestamp, action, item[, widget]) as clean events."""
    full = [(u, t.date(), t, a, i, None, w[0] if w else "unknown") for u, t, a, i, *w in rows]
    return spark.createDataFrame(full, "user_id long, event_date date, timestamp timestamp_ntz, action_type string, item_id long, search_query string, widget_name string")


def comparable(value):
    if isinstance(value, Decimal | float):
        return None if value != value else round(float(value), 9)
    return tuple(map(comparable, value)) if isinstance(value, list) else value


def same_rows(rows, columns, other, other_columns):
    order = sorted(columns)
    assert order == sorted(other_columns)
    a, b = (sorted((tuple(comparable(r[list(c).index(k)]) for k in order) for r in rs), key=repr) for rs, c in ((rows, columns), (other, other_columns)))
    assert a == b
