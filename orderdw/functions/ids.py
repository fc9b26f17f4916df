"""16-byte identifiers as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Start and length of each hex group in the text form, the places of its dashes, and its
# pattern.
TEXT_GROUPS = [(1, 8), (10, 4), (15, 4), (20, 4), (25, 12)]
DASHES = [9, 14, 19, 24]
UUID_PATTERN = "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sixteen(digits: Column) -> Column:
    """Spark has no fixed-width binary type, so anything but 32 hex digits becomes NULL."""
    return F.when(F.length(digits) == 32, F.unhex(digits))


def uuid_to_bin(c: Column | str) -> Column:
    """UUID text to 16 bytes, reading the hex groups at their positions."""
    c = _col(c)
    digits = F.concat(*[F.substring(c, at, n) for at, n in TEXT_GROUPS])
    return F.when(F.length(c) >= 36, F.unhex(digits))  # 32 digits only then; read once


def uuid_to_bin_dashless(c: Column | str) -> Column:
    """UUID text to 16 bytes, dropping every dash wherever it stands."""
    return _sixteen(F.replace(_col(c), F.lit("-"), F.lit("")))


def bin_to_uuid(c: Column | str) -> Column:
    """16 bytes to lower-case 8-4-4-4-12 text; NULL stays NULL."""
    text = F.substring(F.hex(_col(c)), 1, 32)
    for at in DASHES:
        text = F.overlay(text, F.lit("-"), at, 0)
    return F.lower(text)


def is_uuid(c: Column | str) -> Column:
    return _col(c).rlike(UUID_PATTERN)


def stable_key(*cols: Column | str) -> Column:
    """A 16-byte key made from the values themselves.

    The same row gets the same key in every run and on every retry of a task, which a random
    identifier does not give. Pass binary columns as hex text. NULL is kept apart from ''.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit("~")) for c in cols]
    return F.unhex(F.md5(F.concat_ws("|", *parts)))


def hex_text(c: Column | str) -> Column:
    return F.lower(F.hex(_col(c)))
