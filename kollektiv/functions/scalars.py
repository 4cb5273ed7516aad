"""Scalar functions as Spark ``Column`` expressions.

Everything here stays inside whole-stage codegen: no Python runs per row.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "PAYLOAD_CAP", "TRUNCATION_MARKER", "json_extract_string", "json_extract_string_strict",
    "pack_json_payload", "cap_payload", "location_text", "service_date", "parse_timestamp",
    "parse_service_date", "fill_empty_strings", "parse_double", "first_non_empty",
    "truncate_millis", "epoch_millis", "run_clock", "partition_id",
]

# Fixed values that must equal the reference's for equal results.
PAYLOAD_CAP = 900_000            # characters kept before the marker
TRUNCATION_MARKER = "...[truncated]"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def json_extract_string(payload: Column | str, key: str) -> Column:
    """SCL-1: string value of a top-level key, ``''`` when missing, null or invalid JSON."""
    return F.coalesce(F.get_json_object(_c(payload), f"$.{key}"), F.lit(""))


def json_extract_string_strict(payload: Column | str, key: str) -> Column:
    """SCL-1, strict form (D4): ``''`` also when the value is a number, bool or object."""
    v = F.try_variant_get(F.try_parse_json(_c(payload)), f"$.{key}", "variant")
    return F.when(F.schema_of_variant(v) == "STRING",
                  F.try_variant_get(v, "$", "string")).otherwise(F.lit(""))


def pack_json_payload(columns: Iterable[Column | str]) -> Column:
    """SCL-2: row -> JSON text, null keys kept, non-ASCII kept as is."""
    return F.to_json(F.struct(*[_c(c) for c in columns]), {"ignoreNullFields": "false"})


def cap_payload(payload: Column | str, cap: int = PAYLOAD_CAP) -> Column:
    """SCL-3: texts longer than ``cap`` characters keep ``cap`` characters plus the marker."""
    p = _c(payload)
    return F.when(F.length(p) > cap,
                  F.concat(F.substring(p, 1, cap), F.lit(TRUNCATION_MARKER))).otherwise(p)


def location_text(lat: Column | str, lon: Column | str) -> Column:
    """SCL-4: ``lat,lon`` with missing parts as empty text."""
    return F.concat(F.coalesce(_c(lat), F.lit("")), F.lit(","), F.coalesce(_c(lon), F.lit("")))


def service_date(ts: Column | str, zone: str | None = None) -> Column:
    """SCL-5: timestamp (UTC wall clock) -> calendar day, in UTC or in ``zone`` (D3, Q9)."""
    t = _c(ts)
    if zone and zone.upper() not in ("UTC", "Z", "ETC/UTC"):
        t = F.convert_timezone(F.lit("UTC"), F.lit(zone), t)
    return F.to_date(t)


# A time of day followed by a zone designator: ``Z``, ``+01``, ``+0100`` or ``+01:00``.
_HAS_ZONE = r"\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*([zZ]|[+-]\d{2}(:?\d{2})?)$"


_BASIC = r"^\s*(\d{4})(\d{2})(\d{2})[Tt ](\d{2})(\d{2})(\d{2})(.*)$"
# Days written other than yyyy-MM-dd, tried in this order.
_DAY_PATTERNS = (r"^\s*(\d{4})(\d{2})(\d{2})\s*$", r"^\s*(\d{4})[/.](\d{1,2})[/.](\d{1,2})\s*$")
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()


def parse_timestamp(text: Column | str) -> Column:
    """SCL-6: ISO-8601 text (offset, ``Z`` or none; any fraction) -> UTC ``TIMESTAMP_NTZ``.

    Unparseable text gives null (D14: every value is parsed on its own).  Text
    with a zone is converted to UTC; text without one is taken as UTC wall
    clock, so the result never depends on the session time zone.
    """
    t = _c(text)
    # basic form: 20251027T060000[.fff][zone]
    t = F.regexp_replace(t, _BASIC, "$1-$2-$3T$4:$5:$6$7")
    # an instant is a number of microseconds: no wall clock, so no hour is met twice
    instant = F.timestamp_add("MICROSECOND", F.unix_micros(F.try_to_timestamp(t)), F.lit("1970-01-01").cast("timestamp_ntz"))
    return F.when(t.rlike(_HAS_ZONE), instant).otherwise(t.try_cast("timestamp_ntz"))


def parse_service_date(text: Column | str) -> Column:
    """SCL-7: ``yyyy-MM-dd`` text, else the calendar day written in any
    timestamp text (its own offset, not UTC), else a day such as ``20251027``,
    ``2025/10/27``, ``27 Oct 2025`` or ``Oct 27, 2025``, else null."""
    t = _c(text)

    def day(y, m, d):
        return F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    numbers = [day(*[F.regexp_extract(t, p, i) for i in (1, 2, 3)]) for p in _DAY_PATTERNS]
    by_name = F.create_map(*[F.lit(x) for i, m in enumerate(_MONTHS) for x in (m, str(i + 1))])
    named = [(r"^\s*(\d{1,2})[ -]([A-Za-z]{3})[A-Za-z]*\.?,?[ -](\d{4})\s*$", 3, 2, 1),
             (r"^\s*([A-Za-z]{3})[A-Za-z]*\.? (\d{1,2}),? (\d{4})\s*$", 3, 1, 2)]
    words = [day(F.regexp_extract(t, p, y), by_name[F.lower(F.regexp_extract(t, p, m))], F.regexp_extract(t, p, d)) for p, y, m, d in named]
    stamp = F.regexp_replace(t, _BASIC, "$1-$2-$3T$4:$5:$6$7").try_cast("timestamp_ntz")
    return F.coalesce(F.try_to_date(t, "yyyy-MM-dd"), F.to_date(stamp), *numbers, *words)


def fill_empty_strings(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """SCL-8: null -> ``''`` over the given string columns (D1: done once, at load)."""
    cols = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols})


def parse_double(text: Column | str) -> Column:
    """SCL-9: text -> DOUBLE, unparseable or empty -> null."""
    return _c(text).try_cast("double")


def first_non_empty(text: Column | str, attr: Column | str) -> Column:
    """SCL-10: the element's text unless empty, else its attribute."""
    return F.coalesce(F.nullif(_c(text), F.lit("")), _c(attr))


def truncate_millis(ts: Column | str) -> Column:
    """Bronze timestamps keep milliseconds (the reference stores DateTime64(3)).

    Pure arithmetic on ``TIMESTAMP_NTZ``, so no time-zone round trip is involved.
    """
    t = _c(ts)
    micros_in_milli = F.pmod((F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint"), F.lit(1000))
    return F.timestamp_add("MICROSECOND", -micros_in_milli, t)


def epoch_millis(ts: Column | str) -> Column:
    """Milliseconds since 1970-01-01 of a UTC wall-clock ``TIMESTAMP_NTZ``,
    from its calendar parts (no session time zone involved)."""
    t = _c(ts)
    days = F.datediff(F.to_date(t), F.lit(_dt.date(1970, 1, 1))).cast("bigint")
    millis_of_day = (F.hour(t) * 3_600_000 + F.minute(t) * 60_000
                     + F.floor(F.extract(F.lit("SECOND"), t) * 1000)).cast("bigint")
    return days * 86_400_000 + millis_of_day


def run_clock(ingestion_ts: _dt.datetime, ingestion_date: _dt.date | str) -> dict[str, Column]:
    """SCL-12: the run's clock as literals (never ``current_timestamp()`` in a query)."""
    if isinstance(ingestion_date, str):
        ingestion_date = _dt.date.fromisoformat(ingestion_date)
    if ingestion_ts.tzinfo is not None:
        ingestion_ts = ingestion_ts.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    ingestion_ts = ingestion_ts.replace(microsecond=ingestion_ts.microsecond // 1000 * 1000)
    return {
        # from text: a datetime literal would pass through the session time zone
        "Ingestion_Timestamp": F.lit(ingestion_ts.isoformat(sep=" ")).cast("timestamp_ntz"),
        "Ingestion_Date": F.lit(ingestion_date).cast("date"),
    }


def partition_id(day: Column | str) -> Column:
    """SCL-13: day -> ``YYYY-MM-DD`` partition id."""
    return F.date_format(_c(day), "yyyy-MM-dd")
