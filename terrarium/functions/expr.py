"""Column expressions.

Every function returns a ``Column`` built only from Spark's own functions, so
all of them stay inside whole-stage codegen: no Python runs per row.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# Time (F3-F9, F24)
# ---------------------------------------------------------------------------

# Leading "yyyy-MM-dd HH:mm:ss" with optional fraction; a zone suffix after it
# ("-0000", "+0000", "-0800") is ignored, as the stream job reads it.
_TS_PREFIX = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,9})?"


def parse_ts(c: ColumnOrName, ntz: bool = False) -> Column:
    """reading time text -> timestamp; malformed or missing -> null.

    Only the leading date-time is read and any zone suffix ignored (N1): the
    devices write host-local time with a ``-0000`` label (N2), and the
    session runs in UTC.  Fractional seconds are kept when present.
    """
    prefix = F.regexp_extract(_c(c), _TS_PREFIX, 0)
    target = "timestamp_ntz" if ntz else "timestamp"
    return F.when(prefix != "", prefix.try_cast(target))


def parse_ts_any(c: ColumnOrName) -> Column:
    """tolerant time parse, honouring an explicit zone offset.

    Accepts ``yyyy-MM-dd HH:mm:ss[.f] +hhmm``, ISO-8601 text and RFC-822
    (``Mon, 27 Feb 2017 10:00:00 -0800``: the weekday is stripped first,
    since pattern letter E cannot be parsed, N3).  Result is TIMESTAMP.
    """
    s = F.trim(_c(c))
    no_weekday = F.regexp_replace(s, r"^[A-Za-z]{3}, ", "")
    with_zone = F.regexp_extract(
        s, r"^(\d{4}-\d{2}-\d{2})[ T](\d{2}:\d{2}:\d{2}(\.\d{1,6})?) ?([+-]\d{4})$", 0)
    iso_zone = F.concat(
        F.regexp_extract(with_zone, r"^(\d{4}-\d{2}-\d{2})", 1), F.lit("T"),
        F.regexp_extract(with_zone, r"[ T](\d{2}:\d{2}:\d{2}(\.\d{1,6})?)", 1),
        F.regexp_replace(F.regexp_extract(with_zone, r"([+-]\d{2})(\d{2})$", 0),
                         r"([+-]\d{2})(\d{2})", "$1:$2"))
    return F.coalesce(
        F.when(with_zone != "", iso_zone.try_cast("timestamp")),
        F.try_to_timestamp(no_weekday, F.lit("d MMM yyyy HH:mm:ss Z")),
        s.try_cast("timestamp"),
    )


def format_ts(c: ColumnOrName) -> Column:
    """timestamp -> ``yyyy-MM-dd HH:mm:ss Z`` (``+0000`` under UTC)."""
    return F.date_format(_c(c), "yyyy-MM-dd HH:mm:ss Z")


def reading_time_text(c: ColumnOrName) -> Column:
    """Reading time as devices and ingest write it: whole seconds, ``-0000``."""
    return F.concat(F.date_format(_c(c), "yyyy-MM-dd HH:mm:ss"), F.lit(" -0000"))


def epoch_ts(sec: ColumnOrName) -> Column:
    """epoch seconds -> timestamp.  The microsecond part is dropped by
    the whole-second text form either way, so only ``sec`` is used."""
    return F.timestamp_seconds(_c(sec))


def now_text(now: _dt.datetime | None = None) -> Column:
    """current time as reading text; ``now`` is injectable for tests."""
    ts = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return reading_time_text(ts)


def to_millis(c: ColumnOrName) -> Column:
    """F8: timestamp -> epoch milliseconds (NTZ read as UTC wall time)."""
    return F.unix_millis(_c(c).cast("timestamp"))


_AGE = re.compile(r"^\s*(\d+)\s+(second|minute|hour|day|week)s?\s*$", re.I)
_AGE_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def age_delta(text: str) -> _dt.timedelta:
    """relative age text ("2 hours", "10 days") -> timedelta."""
    m = _AGE.match(text or "")
    if not m:
        raise ValueError(f"unsupported age {text!r}; use '<n> <unit>' with "
                         "unit second/minute/hour/day/week")
    return _dt.timedelta(seconds=int(m.group(1)) * _AGE_SECONDS[m.group(2).lower()])


def age_interval(text: str) -> Column:
    """F9 as a day-time interval literal."""
    return F.lit(age_delta(text))


# ---------------------------------------------------------------------------
# Units, ids, tags
# ---------------------------------------------------------------------------

def c_to_f(c: ColumnOrName) -> Column:
    """Celsius -> Fahrenheit, always in double."""
    return _c(c).cast("double") * 9.0 / 5.0 + 32.0


def sensor_id(c: ColumnOrName) -> Column:
    """device id with the ``:`` separators removed."""
    return F.replace(_c(c), F.lit(":"), F.lit(""))


def mac(c: ColumnOrName) -> Column:
    """the first 12 characters of the normalised id are the MAC."""
    return F.substring(_c(c), 1, 12)


def with_channel(mac_col: ColumnOrName, channel_name: str) -> Column:
    """MAC plus a channel suffix (``weight``, ``dht``, ``rbg``)."""
    return F.concat(_c(mac_col), F.lit("-" + channel_name))


def channel(c: ColumnOrName) -> Column:
    """F13 inverse: the channel after the first ``-`` ('' when none)."""
    return F.split_part(_c(c), F.lit("-"), F.lit(2))


def colon_mac(hex12: ColumnOrName) -> Column:
    """12 hex digits -> ``aa:bb:cc:dd:ee:ff``."""
    h = _c(hex12)
    return F.concat_ws(":", *[F.substring(h, i, 2) for i in range(1, 13, 2)])


def tag(name: str, tags: ColumnOrName = "tags") -> Column:
    """One tag value; missing map or key -> null (never an error)."""
    return F.try_element_at(_c(tags), F.lit(name))


# Fixed values of the direct scale line: offset terms and final shift
# (1.27, -39.75, 0.25, 1.6), combined as (x + (1.27 - -39.75 - 0.25)) * 1000 + 1.6.
def scale_fixed(x: ColumnOrName) -> Column:
    """F16: fixed transform of a raw scale number into grams."""
    offset = F.lit(1.27) - F.lit(-39.75) - F.lit(0.25)
    return (_c(x) + offset) * 1000.0 + 1.6


def calibrate(raw: ColumnOrName, zero: ColumnOrName, one_kg: ColumnOrName) -> Column:
    """two-point calibration ``(raw-zero)*1000/(one_kg-zero)``;
    equal points (both defaulted) give null instead of an error (N8)."""
    z = _c(zero)
    return F.try_divide((_c(raw) - z) * 1000.0, _c(one_kg) - z)


# ---------------------------------------------------------------------------
# Signing (F14)
# ---------------------------------------------------------------------------

_BLOCK = 64  # SHA-1 block size in bytes


def _hmac_pads(key: bytes) -> tuple[str, str]:
    if len(key) > _BLOCK:
        key = hashlib.sha1(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    inner = bytes(b ^ 0x36 for b in key).hex()
    outer = bytes(b ^ 0x5C for b in key).hex()
    return inner, outer


def hmac_sha1_hex(body: ColumnOrName, key: str | bytes) -> Column:
    """HMAC-SHA1 of the UTF-8 body as lower-case hex (RFC 2104).

    The key is folded into two constant pads on the driver; per row Spark
    only runs two ``sha1`` calls over binary concatenations.
    """
    kb = key.encode("utf-8") if isinstance(key, str) else key
    inner, outer = _hmac_pads(kb)
    msg = F.encode(_c(body), "UTF-8")
    inner_digest = F.unhex(F.sha1(F.concat(F.unhex(F.lit(inner)), msg)))
    return F.sha1(F.concat(F.unhex(F.lit(outer)), inner_digest))
