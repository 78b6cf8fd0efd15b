"""Column expressions on dotted symbol names and event time."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY = 86_400_000_000


def module_prefix(target: Column) -> Column:
    """The part before the last dot, or the whole target when it has none."""
    last = F.substring_index(target, ".", -1)
    prefix = F.left(target, F.length(target) - F.length(last) - 1)
    return F.when(target.contains("."), prefix).otherwise(target)


def full_symbol(target: Column, name: Column, attr_chain: Column) -> Column:
    """Dotted symbol of a call: its import target, else its own name, then the attributes."""
    return F.concat_ws(".", F.coalesce(target, name), attr_chain)


def library_of(symbol: Column) -> Column:
    """First dotted component."""
    return F.substring_index(symbol, ".", 1)


def month_bucket(time: Column) -> Column:
    """First instant of the UTC month, whatever the session's time zone."""
    days = F.date_diff(F.trunc(_utc_date(time), "month"), _epoch())
    return F.timestamp_micros(days.cast("long") * _DAY)


def month_label(time: Column) -> Column:
    """The UTC month as ``yyyy-MM``."""
    return F.left(_utc_date(time).cast("string"), F.lit(7))


def _epoch() -> Column:
    return F.to_date(F.lit("1970-01-01"))


def _utc_date(time: Column) -> Column:
    # Counted from the epoch, as truncation and formatting use the session's time zone.
    micros = F.unix_micros(time.cast("timestamp"))
    days = F.call_function("div", micros - F.pmod(micros, F.lit(_DAY)), F.lit(_DAY))
    return F.date_add(_epoch(), days.cast("int"))
