from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tieout import fixed_values as V


def paise(amount: Column | str) -> Column:
    """Rupees with at most two decimals as integer paise."""
    return F.round(_col(amount) * 100).cast("bigint")


def position(prefix: str = "") -> Column:
    """The place of a change in its source: incarnation first, then log position."""
    return F.struct(
        F.col(f"{prefix}source_incarnation").alias("source_incarnation"),
        F.col(f"{prefix}source_lsn").alias("source_lsn"),
    )


def newer(left: Column, right: Column) -> Column:
    """Strictly newer. Struct comparison goes field by field, so incarnation decides first."""
    return left > right


def row_fingerprint(keys: Sequence[str], amount: str, extra: Sequence[str] = ()) -> Column:
    """First 32 bits of md5 over 'key|…|amount', the text every source hashes on its side.

    `extra` columns follow the amount where both sides have agreed on them; NULL is written
    there as \\N, so that it differs from an empty text and from a column left out.
    """
    more = (F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in extra)
    text = F.concat_ws("|", *(F.col(c).cast("string") for c in (*keys, amount)), *more)
    return F.conv(F.left(F.md5(text), F.lit(8)), 16, 10).cast("bigint")


def is_safe_identifier(name: Column | str) -> Column:
    return F.coalesce(_col(name).rlike(V.SAFE_IDENTIFIER), F.lit(False))


def strict_bigint(text: Column | str) -> Column:
    """A whole number written plainly; '12.50', ' 12' and '12\\n' all give NULL."""
    text = _col(text)
    return F.when(text.rlike(r"\A-?[0-9]+\z"), text.try_cast("bigint"))


def strict_date(text: Column | str) -> Column:
    text = _col(text)
    return F.when(text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), text.try_cast("date"))


def instant_text(instant: Column | str) -> Column:
    """ISO text of an instant, with microseconds only when it has any."""
    instant = _col(instant)
    whole = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")
    has_micros = F.date_format(instant, "SSSSSS") != "000000"
    return F.when(has_micros, F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).otherwise(
        whole
    )


def business_day_end(day: Column | str, zone: Column | str = V.BUSINESS_ZONE) -> Column:
    """The UTC instant at which a business day ends in its zone."""
    midnight = F.date_add(_col(day), 1).cast("timestamp")
    return F.to_utc_timestamp(midnight, zone)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
