"""Scalar column helpers used by the cleaning and fact plans."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = Column | str


def _c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_date(c: ColLike, fmt: str | None = None) -> Column:
    """Text to DATE; malformed text becomes NULL instead of failing the job."""
    c = _c(c)
    return F.try_to_date(c, F.lit(fmt)) if fmt else F.try_to_date(c)


def parse_iso_ts(c: ColLike) -> Column:
    """ISO-8601 instant text such as ``2023-08-19T22:26:11Z`` to TIMESTAMP (NULL if malformed). Text of exactly that form is
    cast, which gives the same instant at a fraction of the cost; all other goes through the pattern."""
    c = _c(c)
    plain = F.when(c.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z\z"), c.try_cast("timestamp"))
    return F.coalesce(plain, F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")))


def parse_ts(c: ColLike) -> Column:
    """Default-format timestamp text (``yyyy-MM-dd HH:mm:ss``) to TIMESTAMP (NULL if malformed)."""
    return F.try_to_timestamp(_c(c))


def to_decimal(c: ColLike, precision: int, scale: int) -> Column:
    """Cast to DECIMAL(p, s); values that do not fit become NULL (ANSI-safe)."""
    return _c(c).try_cast(f"decimal({precision},{scale})")


def days_to_date(c: ColLike) -> Column:
    """Integer day number since 1970-01-01 to DATE."""
    return F.date_from_unix_date(_c(c).cast("int"))


def json_field(c: ColLike, path: str, cast: str | None = None) -> Column:
    """One field of a JSON text column; optional ANSI-safe cast of the text."""
    v = F.get_json_object(_c(c), path)
    return v.try_cast(cast) if cast else v


def null_safe_equal(a: ColLike, b: ColLike) -> Column:
    return _c(a).eqNullSafe(_c(b))


def any_changed(pairs: Iterable[tuple[ColLike, ColLike]]) -> Column:
    """True when any pair differs, counting NULL -> value and value -> NULL as changes."""
    out = None
    for a, b in pairs:
        d = ~null_safe_equal(a, b)
        out = d if out is None else (out | d)
    return out if out is not None else F.lit(False)


def row_hash(cols: Sequence[ColLike]) -> Column:
    """MD5 over the columns' texts, each with its length before it (``-`` for NULL), so
    that no two different rows give the same text: ("a|b", "c") differs from ("a", "b|c")."""
    texts = [_c(c).cast("string") for c in cols]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def surrogate_key(cols: Sequence[ColLike]) -> Column:
    """SHA-256 surrogate key of ``c1|c2|...`` (NULLs skipped, as the key parts are never NULL)."""
    return F.sha2(F.concat_ws("|", *[_c(c).cast("string") for c in cols]), 256)


def tier(value: ColLike, bands: Sequence[tuple[float, str]], default: str) -> Column:
    """First band whose lower bound the value reaches, in the given order; else ``default``."""
    v = _c(value)
    expr = None
    for bound, label in bands:
        expr = F.when(v >= bound, label) if expr is None else expr.when(v >= bound, label)
    return expr.otherwise(default) if expr is not None else F.lit(default)
