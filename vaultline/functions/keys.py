"""Business-key hashing and change hashing as plain Column expressions.

Every helper returns a ``Column`` built from Spark built-ins (``sha2``,
``upper``, ``trim``, ``concat``, ``concat_ws``, ``coalesce``), so key
derivation stays inside whole-stage codegen and never leaves the JVM.

NULL behaviour is deliberate and part of the contract:

* ``concat`` with a NULL input is NULL, so a prefixed key of a NULL id is
  NULL (an optional reference yields no key rather than a bogus one).
* ``concat_ws`` skips NULLs, so link keys and raw link keys are computed
  from whatever parts are present.
* ``hashdiff`` wraps every attribute in ``coalesce(..., '')`` so positions
  are kept; NULL and '' therefore hash the same.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators used by the key formulas.
LINK_SEPARATOR = "-"
HASHDIFF_SEPARATOR = "||"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text(c: str | Column) -> Column:
    return _col(c).cast("string")


def hash_key(bk: str | Column) -> Column:
    """sha256 hex of the upper-cased, trimmed business key."""
    return F.sha2(F.upper(F.trim(_text(bk))), 256)


def digits_key(bk: str | Column) -> Column:
    """Key of a business key normalised to its digits only.

    '123.456.789-01' and '12345678901' give the same key.
    """
    return F.sha2(F.upper(F.trim(F.regexp_replace(_text(bk), "[^0-9]", ""))), 256)


def prefixed_key(prefix: str, bk: str | Column) -> Column:
    """Key of ``<prefix>-<id>`` so id spaces of different entities don't collide.

    NULL id gives a NULL key (``concat`` propagates NULL).
    """
    return F.sha2(
        F.upper(F.trim(F.concat(F.lit(prefix + LINK_SEPARATOR), _text(bk)))), 256
    )


def typed_reference_key(ref_type: str | Column, ref_id: str | Column) -> Column:
    """Polymorphic reference key: same value as ``prefixed_key(type, id)``."""
    return F.sha2(
        F.upper(F.trim(F.concat(_col(ref_type), F.lit(LINK_SEPARATOR), _text(ref_id)))),
        256,
    )


def link_key(*hub_keys: str | Column) -> Column:
    """Link key over hub hash keys in declared order."""
    return F.sha2(F.concat_ws(LINK_SEPARATOR, *[_col(k) for k in hub_keys]), 256)


def optional_link_key(optional: str | Column, *hub_keys: str | Column) -> Column:
    """Link key that is NULL when the optional hub key is NULL."""
    return F.when(_col(optional).isNull(), F.lit(None).cast("string")).otherwise(
        link_key(*hub_keys)
    )


def raw_link_key(*parts: str | Column) -> Column:
    """Link key over raw values (not hash keys), upper-cased and trimmed."""
    return F.sha2(
        F.upper(F.trim(F.concat_ws(LINK_SEPARATOR, *[_text(p) for p in parts]))), 256
    )


def hashdiff(attributes: Iterable[str | Column | None]) -> Column:
    """Change hash over attributes; ``None`` marks an attribute the feed lacks.

    Case- and space-sensitive on purpose: any change of the text is a change.
    """
    parts = [
        F.lit("") if a is None else F.coalesce(_text(a), F.lit(""))
        for a in attributes
    ]
    return F.sha2(F.concat_ws(HASHDIFF_SEPARATOR, *parts), 256)


def pack_key(c: str | Column) -> Column:
    """A hex hash key as its 32 bytes, half of what its text takes in a shuffle.

    One to one on all strings: any other text keeps its UTF-8 bytes behind 33
    zero bytes, which no packed hash has (NULL stays NULL).
    """
    raw = F.unhex(_col(c))
    is_hash = (F.length(_col(c)) == 64) & (F.lower(F.hex(raw)) == _col(c))
    return F.when(F.coalesce(is_hash, F.lit(False)), raw).otherwise(
        F.concat(F.lit(bytearray(33)), F.encode(_col(c), "UTF-8")))


def unpack_key(c: str | Column) -> Column:
    """The text of a packed key."""
    return F.when(F.length(_col(c)) == 32, F.lower(F.hex(_col(c)))).otherwise(
        F.decode(F.substring(_col(c), 34, 2147483647), "UTF-8"))
