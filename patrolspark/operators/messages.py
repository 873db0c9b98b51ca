"""Routing and decoding of keyed drone messages.

``route`` splits by key; ``checked(df, kind)`` decodes one message kind and
attaches a reason (null when the message is good); ``good(...)`` and
``rejects(...)`` take the two sides.  ``decode_all`` does routing and
decoding of every kind in one pass, for micro-batches.

Strictness: a field must have its JSON type (a quoted number is not a
double, a number is not a string, an epoch-millisecond date must be whole).
Required fields must be present and not null; optional ones may be missing
or null.  A value that is not a JSON object is rejected for every kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import IMAGE_KEY, STANDARD_KEY, VIOLATION_KEY
from ..functions import codec
from ..schemas import IMAGE, STANDARD, VIOLATION

KEYS = (STANDARD_KEY, VIOLATION_KEY, IMAGE_KEY)

ROUTES = ("standard", "violation", "image", "unhandled")
UNHANDLED_REASON = "unhandled key"

# Per kind: (field, JSON kind, required).
_FIELDS = {
    "standard": [("lat", "double", True), ("lng", "double", True),
                 ("sending_date", "long", True), ("drone_id", "string", True)],
    "violation": [("lat", "double", False), ("lng", "double", False),
                  ("sending_date", "long", False), ("drone_id", "string", False),
                  ("violation_code", "string", False), ("image_id", "string", False)],
    "image": [("image_id", "string", True), ("content", "string", True)],
}
_SCHEMAS = {"standard": STANDARD, "violation": VIOLATION, "image": IMAGE}


def route_of(key="key") -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return (F.when(k == STANDARD_KEY, "standard")
            .when(k == VIOLATION_KEY, "violation")
            .when(k == IMAGE_KEY, "image")
            .otherwise("unhandled"))


def route(df: DataFrame, key: str = "key") -> dict[str, DataFrame]:
    """Split a keyed frame into the four routes.  A null key is unhandled."""
    k = F.col(key)
    return {
        "standard": df.where(k == STANDARD_KEY),
        "violation": df.where(k == VIOLATION_KEY),
        "image": df.where(k == IMAGE_KEY),
        "unhandled": df.where(~F.coalesce(k.isin(*KEYS), F.lit(False))),
    }


def _reason(s: Column, types: dict[str, Column], kind: str) -> Column:
    """First failed check for a message of ``kind``; null when it is good.
    ``s`` is the parsed field struct, ``types`` the JSON type per field."""
    checks = [(s.isNull(), F.lit("not a JSON object"))]
    for name, jkind, required in _FIELDS[kind]:
        t = types[name]
        present = t.isNotNull() & (t != "VOID")
        if required:
            checks.append((~present, F.lit(f"missing {name}")))
        checks.append((present & ~codec.type_ok(s[name], jkind, t),
                       F.lit(f"bad type {name}")))
        if name == "sending_date":  # a whole number, but past what a timestamp holds
            ms = codec.value_of(s[name], "long")
            checks.append((present & ~F.coalesce(codec.millis_in_range(ms), F.lit(False)),
                           F.lit(f"bad value {name}")))
    out = None
    for cond, why in checks:
        out = F.when(cond, why) if out is None else out.when(cond, why)
    return out


def _value(s: Column, name: str, jkind: str) -> Column:
    if name == "sending_date":
        return codec.millis_ts(s[name])
    return codec.value_of(s[name], jkind)


def _parsed(df: DataFrame, names, value: str, *lead) -> DataFrame:
    """``df`` plus ``__s`` (parsed field struct) and ``__t_<name>`` types.

    The text is parsed once per row inside a one-element ``inline``:
    Catalyst never pushes a filter below a generator, so later filters on
    the decode result read the parsed struct instead of re-parsing the text
    once per check.
    """
    gen = F.inline(F.array(F.struct(codec.parse_fields(value, names).alias("__s"))))
    parsed = df.select(*(lead or ("*",)), gen)
    s = F.col("__s")
    return parsed.select("*", *[codec.json_type(s[n]).alias(f"__t_{n}") for n in names])


def checked(df: DataFrame, kind: str, value: str = "value") -> DataFrame:
    """Decode every row of ``df`` as ``kind``; adds ``__reason`` and the fields.

    Extra JSON fields are ignored; a missing optional field is null.
    """
    names = [n for n, _, _ in _FIELDS[kind]]
    typed = _parsed(df, names, value)
    s = F.col("__s")
    types = {n: F.col(f"__t_{n}") for n in names}
    out = typed.select("*", _reason(s, types, kind).alias("__reason"),
                       *[_value(s, n, j).cast(_SCHEMAS[kind][n].dataType).alias(n)
                         for n, j, _ in _FIELDS[kind]])
    return out.drop("__s", *[f"__t_{n}" for n in names])


def good(checked_df: DataFrame, kind: str, keep: tuple[str, ...] = ()) -> DataFrame:
    names = [f.name for f in _SCHEMAS[kind].fields]
    return checked_df.where(F.col("__reason").isNull()).select(*keep, *names)


def rejects(checked_df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return checked_df.where(F.col("__reason").isNotNull()).select(
        F.col("__reason").alias("reason"), "key", "value", *keep)


def decode_standard(df: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)`` for standard messages; ``keep`` columns ride along."""
    c = checked(df, "standard")
    return good(c, "standard", keep), rejects(c, keep)


def decode_violation(df: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)`` for violation messages; ``keep`` columns ride along."""
    c = checked(df, "violation")
    return good(c, "violation", keep), rejects(c, keep)


def decode_image(df: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)`` for image messages; ``keep`` columns ride along."""
    c = checked(df, "image")
    return good(c, "image", keep), rejects(c, keep)


# Columns of ``decode_all``: route, reason, then every field of every kind.
DECODED_FIELDS = ("lat", "lng", "sending_date", "drone_id", "violation_code", "image_id",
                  "content")
_FIELD_TYPES = {**{f.name: f.dataType for f in VIOLATION.fields},
                "content": IMAGE["content"].dataType}
_JSON_KIND = {name: jkind for fields in _FIELDS.values() for name, jkind, _ in fields}


def decode_all(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Route and decode every message of ``df`` in one pass.

    Columns: ``route``, ``reason`` (null when good), ``key``, ``value``
    (kept for rejected rows only: an accepted image would otherwise be held
    twice), the ``keep`` columns and the union of all message fields (null
    where the message's kind has no such field).  The input is read once and
    each value parsed once, whatever its kind; a micro-batch persists the
    result and splits it by ``route`` / ``reason`` without decoding again.
    """
    typed = _parsed(df, DECODED_FIELDS, "value", "key", "value", *keep,
                    route_of("key").alias("route"))
    s = F.col("__s")
    types = {n: F.col(f"__t_{n}") for n in DECODED_FIELDS}
    rt = F.col("route")
    reason = (F.when(rt == "standard", _reason(s, types, "standard"))
              .when(rt == "violation", _reason(s, types, "violation"))
              .when(rt == "image", _reason(s, types, "image"))
              .otherwise(F.lit(UNHANDLED_REASON)))
    fields = []
    for n in DECODED_FIELDS:
        kinds = [k for k, fs in _FIELDS.items() if any(f[0] == n for f in fs)]
        val = _value(s, n, _JSON_KIND[n]).cast(_FIELD_TYPES[n])
        fields.append(F.when(rt.isin(*kinds), val).alias(n))
    out = typed.select("route", reason.alias("reason"), "key", "value", *keep, *fields)
    return out.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))


def all_rejects(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every record that cannot be stored: failed decodes and unknown keys."""
    return decode_all(df, keep).where(F.col("reason").isNotNull()) \
        .select("reason", "key", "value", *keep)
