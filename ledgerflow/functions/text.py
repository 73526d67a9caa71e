"""Text helpers: deterministic record ids and case-insensitive LIKE lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def record_id(*cols: Column | str, sep: str = "", money_cols: Iterable[str] = ("amount",)) -> Column:
    """Hex md5 over the coalesced text of ``cols``.

    Money columns are rendered through DECIMAL(18,2) so the text does not
    depend on an engine's DOUBLE-to-string format.  The default ``sep=''``
    keeps the source behaviour where ('a','bc') and ('ab','c') collide.
    """
    money_cols = set(money_cols)
    parts = []
    for c in cols:
        col = _c(c)
        if isinstance(c, str) and c in money_cols:
            col = col.cast("decimal(18,2)")
        parts.append(F.coalesce(col.cast("string"), F.lit("")))
    joined = F.concat_ws(sep, *parts) if sep else F.concat(*parts)
    return F.md5(joined)


def upper_like_any(c: Column | str, patterns: Iterable[str]) -> Column:
    """upper(c) LIKE p1 OR upper(c) LIKE p2 ...  (patterns are given in upper case)."""
    up = F.upper(_c(c))
    cond = None
    for p in patterns:
        term = up.like(p)
        cond = term if cond is None else (cond | term)
    return cond if cond is not None else F.lit(False)


def object_path(subject: Column | str, marker: str = "/objects/") -> Column:
    """Text after the first ``marker``; the whole string when the marker is absent."""
    s = _c(subject)
    pos = F.instr(s, marker)
    return F.when(pos > 0, F.substr(s, pos + F.lit(len(marker)))).otherwise(s)


def base_name(path: Column | str) -> Column:
    """Last path component."""
    return F.substring_index(_c(path), "/", -1)
