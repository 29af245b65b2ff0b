"""Scalar Column functions (JSON access, lenient casts, dates, buckets).

Every helper returns a native Catalyst expression, so it stays inside
whole-stage code generation; none of them is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Number shapes accepted by the lenient casts.  Spark's own cast also
# accepts padded text (' 7 ') and suffixed literals ('1.0d'); the
# patterns reject both, so only plain numbers convert.
_DOUBLE_TEXT = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
_INT_TEXT = r"^[+-]?\d+$"
_UINT_TEXT = r"^\d+$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_timestamp(as_of) -> Column:
    """Normalise an ``as_of`` argument (None = now) to a timestamp Column."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    if isinstance(as_of, (_dt.datetime, _dt.date)):
        return F.lit(as_of).cast("timestamp")
    return F.lit(str(as_of)).cast("timestamp")


def stamp(df, name: str, as_of=None):
    """Add one clock column (audit time, D-11): one value per query, pinned by ``as_of``."""
    return df.withColumn(name, as_timestamp(as_of))


# --- JSON access (F1-F7) -------------------------------------------------

def json_path(*steps: str) -> str:
    """JSON path from separate steps: ('payload', 'after', '$oid') -> $.payload.after['$oid']."""
    out = "$"
    for s in steps:
        out += f"['{s}']" if not s.replace("_", "a").isalnum() else f".{s}"
    return out


def json_raw(doc: ColumnOrName, *steps: str) -> Column:
    """Raw JSON text of a sub-tree (compact), NULL when absent."""
    return F.get_json_object(_col(doc), json_path(*steps))


def json_text(doc: ColumnOrName, *steps: str) -> Column:
    """Text at a path, '' when absent; numbers come back as their text (F1)."""
    return F.coalesce(json_raw(doc, *steps), F.lit(""))


def json_has(doc: ColumnOrName, *steps: str) -> Column:
    """Key present."""
    return json_raw(doc, *steps).isNotNull()


def json_long(doc: ColumnOrName, *steps: str) -> Column:
    """Unsigned integer at a path, 0 when absent, negative or not a number (F2)."""
    return uint_or_zero(json_raw(doc, *steps))


def json_array(text: ColumnOrName) -> Column:
    """JSON array -> array of element texts; non-arrays give NULL."""
    return F.from_json(_col(text), "array<string>")


def json_length(text: ColumnOrName) -> Column:
    """Number of array elements; NULL for non-arrays and malformed text."""
    return F.json_array_length(_col(text))


_STRICT_JSON = {"allowSingleQuotes": "false"}


def json_valid(text: ColumnOrName) -> Column:
    """Text is one JSON value and nothing else.

    Repeated keys (the last one counts) and NaN or Infinity are
    accepted; text after the value, single quotes and unquoted names are
    not.  The parser stops after the first value it reads, so the text
    is read inside two different wrappers: what closes one early does
    not fit the other.
    """
    t = _col(text)
    listed = F.from_json(F.concat(F.lit("[["), t, F.lit("]]")), "array<array<string>>", _STRICT_JSON)
    named = F.from_json(F.concat(F.lit('{"v":['), t, F.lit("]}")), "v array<string>", _STRICT_JSON)
    return F.coalesce((F.size(listed) == 1) & (F.size(listed[0]) == 1) & (F.size(named["v"]) == 1), F.lit(False))


def json_is_object(text: ColumnOrName) -> Column:
    """Text is a JSON object (not an array or a scalar); see ``json_valid``."""
    return F.coalesce(_col(text).rlike(r"^[ \t\r\n]*\{"), F.lit(False)) & json_valid(text)


def json_flag(text: ColumnOrName, key: str, lenient: bool = False) -> Column:
    """A top-level key of JSON text equals boolean truth.

    Follows an equality test against ``True``: JSON ``true`` and numbers
    equal to 1 count; other numbers, strings and anything else do not.
    Of a repeated key the last value counts.  ``lenient=True`` also
    accepts the string ``"true"`` (any case).  Only text that names the
    key is parsed.
    """
    t = _col(text)

    def read(kind: str) -> Column:
        return F.from_json(t, f"`{key}` {kind}", _STRICT_JSON)[key]

    truth = F.coalesce(read("boolean"), read("double") == 1.0, F.lit(False))
    if lenient:
        truth = truth | F.coalesce(F.lower(read("string")) == "true", F.lit(False))
    return F.when(t.contains(f'"{key}"'), truth).otherwise(F.lit(False))


# --- text (F9, F10) --------------------------------------------------------

def full_name(first: ColumnOrName, last: ColumnOrName) -> Column:
    """first + ' ' + last; NULL if either is NULL."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def is_blank(x: ColumnOrName) -> Column:
    """NULL, empty or only white space of any kind."""
    return F.coalesce(_col(x).rlike(r"(?U)^[\s\x1c-\x1f]*$"), F.lit(True))


def text_or_empty(x: ColumnOrName) -> Column:
    """Missing text is '' rather than NULL."""
    return F.coalesce(_col(x), F.lit(""))


# --- lenient numbers (F11, F12, F2) ----------------------------------------

def double_or_zero(x: ColumnOrName) -> Column:
    """Plain number text -> double, anything else -> 0.0."""
    x = _col(x)
    return F.coalesce(F.when(x.rlike(_DOUBLE_TEXT), x.try_cast("double")), F.lit(0.0))


def int_or_zero(x: ColumnOrName) -> Column:
    """Integer text -> int; fractions, overflow and junk -> 0."""
    x = _col(x)
    return F.coalesce(F.when(x.rlike(_INT_TEXT), x.try_cast("int")), F.lit(0))


def uint_or_zero(x: ColumnOrName) -> Column:
    """Unsigned integer text -> bigint; negative and junk -> 0."""
    x = _col(x)
    return F.coalesce(F.when(x.rlike(_UINT_TEXT), x.try_cast("bigint")), F.lit(0).cast("bigint"))


# --- dates (F13-F17) -------------------------------------------------------

# Further text forms read after the ISO forms fail
# (compact digits, day-first with slashes or dots, day-month-name).
EXTRA_TIME_FORMATS = ("yyyyMMdd", "yyyyMMddHHmmss", "dd/MM/yyyy", "dd/MM/yyyy HH:mm:ss",
                      "dd.MM.yyyy", "dd.MM.yyyy HH:mm:ss", "d MMM yyyy", "d MMM yyyy HH:mm:ss")


def _epoch_or_text(s: Column) -> Column:
    # the cast alone would read a bare time as today and any five digits as a year
    text = F.coalesce(F.when(s.rlike(r"^\d{4}-\d{1,2}"), s.try_cast("timestamp")),
                      *[F.try_to_timestamp(s, F.lit(fmt)) for fmt in EXTRA_TIME_FORMATS])
    return (F.when(s.rlike(r"^\d{13}$"), F.timestamp_millis(s.cast("bigint")))
            .when(s.rlike(r"^\d{10}$"), F.timestamp_seconds(s.cast("bigint")))
            .otherwise(text))


def parse_ts(x: ColumnOrName, strict: bool = False) -> Column:
    """Best-effort timestamp from text.

    Accepted, in order: 13-digit epoch millis, 10-digit epoch seconds,
    what Spark casts to a timestamp and starts with a four-digit year
    and a month (ISO with or without zone and 'T', space form, date
    only), the ``EXTRA_TIME_FORMATS`` and the
    extended-JSON wrapper ``{"$date": <millis or ISO text>}``.  Empty text gives NULL.  Other
    text gives NULL, or fails the query when ``strict``.
    """
    s = F.trim(_col(x))
    wrapped = F.get_json_object(s, "$['$date']")
    inner = F.coalesce(F.get_json_object(wrapped, "$['$numberLong']"), wrapped)
    parsed = (F.when(s.startswith("{"), _epoch_or_text(F.trim(inner)))
              .otherwise(_epoch_or_text(s)))
    out = F.when(F.coalesce(s, F.lit("")) != "", parsed)
    if strict:
        out = F.when(out.isNull() & (F.coalesce(s, F.lit("")) != ""),
                     F.raise_error(F.concat(F.lit("unparseable timestamp: "), s)).cast("timestamp")
                     ).otherwise(out)
    return out


def ts_unparseable(x: ColumnOrName) -> Column:
    """Non-empty text that ``parse_ts`` cannot read (goes to the reject table)."""
    s = F.coalesce(F.trim(_col(x)), F.lit(""))
    return (s != "") & parse_ts(x).isNull()


def to_day(ts: ColumnOrName) -> Column:
    """Calendar date of a timestamp in the session zone (UTC)."""
    return F.to_date(_col(ts))


def minus_days(t: ColumnOrName, n: int) -> Column:
    """Timestamp minus n whole days (F16)."""
    return _col(t) - F.make_dt_interval(days=F.lit(n))


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Day boundaries crossed from start to end."""
    return F.datediff(_col(end), _col(start))


def round_money(x: ColumnOrName) -> Column:
    """Round to cents, half to even."""
    return F.bround(_col(x), 2)


# --- buckets (D-8) ----------------------------------------------------------

# Segment windows in days, price and stock thresholds,
# the bucket labels and the price-variance tolerance.
NEW_DAYS, RECENT_DAYS = 30, 365
PRICE_LOW, PRICE_MEDIUM = 50, 200
STOCK_LOW, STOCK_MEDIUM = 10, 50
VARIANCE_TOLERANCE = 0.01
SEGMENTS = ("New", "Recent", "Established")
PRICE_CATEGORIES = ("Low", "Medium", "High")
INVENTORY_STATUSES = ("Out of Stock", "Low Stock", "Medium Stock", "High Stock")


def customer_segment(registered_at: ColumnOrName, as_of=None) -> Column:
    """New within 30 days, Recent within 365, else (and NULL) Established."""
    r, now = _col(registered_at), as_timestamp(as_of)
    return (F.when(r >= minus_days(now, NEW_DAYS), F.lit(SEGMENTS[0]))
            .when(r >= minus_days(now, RECENT_DAYS), F.lit(SEGMENTS[1]))
            .otherwise(F.lit(SEGMENTS[2])))


def price_category(price: ColumnOrName) -> Column:
    p = _col(price)
    return (F.when(p < PRICE_LOW, F.lit(PRICE_CATEGORIES[0]))
            .when(p < PRICE_MEDIUM, F.lit(PRICE_CATEGORIES[1]))
            .otherwise(F.lit(PRICE_CATEGORIES[2])))


def inventory_status(stock: ColumnOrName) -> Column:
    q = _col(stock)
    return (F.when(q == 0, F.lit(INVENTORY_STATUSES[0]))
            .when(q < STOCK_LOW, F.lit(INVENTORY_STATUSES[1]))
            .when(q < STOCK_MEDIUM, F.lit(INVENTORY_STATUSES[2]))
            .otherwise(F.lit(INVENTORY_STATUSES[3])))


def is_out_of_stock(stock: ColumnOrName) -> Column:
    return F.when(_col(stock) == 0, F.lit(True)).otherwise(F.lit(False))


def price_gap(a: ColumnOrName, b: ColumnOrName) -> Column:
    """abs(a - b)."""
    return F.abs(_col(a) - _col(b))


def has_variance(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Prices differ by more than a cent; NULL comparison counts as no variance."""
    return F.when(price_gap(a, b) > VARIANCE_TOLERANCE, F.lit(True)).otherwise(F.lit(False))
