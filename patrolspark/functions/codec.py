"""JSON message codec: strict field types, epoch-millisecond dates.

Decoding parses each value once (``try_parse_json``) and casts it, still
once, to a struct of the wanted top-level fields kept as VARIANT values
(``parse_fields``).  Field names match case-sensitively; the struct is null
when the text is not JSON or not a JSON object.  Each sub-variant keeps its
JSON type, which strict typing needs: a quoted number is not a double, a
number is not a string, a fraction is not an epoch-millisecond long.  A key
given twice keeps its last value when ``spark.sql.variant.allowDuplicateKeys``
is on (``session.get_session`` / ``session.pin`` turn it on); it is read
when the plan is built.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..util import as_col

_INTEGRAL = ("TINYINT", "SMALLINT", "INT", "BIGINT")
_FLOATING = ("FLOAT", "DOUBLE")
_TARGET = {"string": "string", "double": "double", "long": "bigint"}


def parse_fields(value, names) -> Column:
    """JSON text → struct<name: variant, …> of the top-level fields ``names``.

    Null when the text is not a JSON object; a field is null when absent and
    a variant null when the JSON says ``null``.
    """
    st = "struct<" + ",".join(f"`{n}`: variant" for n in names) + ">"
    return F.try_variant_get(F.try_parse_json(as_col(value)), "$", st)


def json_type(f: Column) -> Column:
    """JSON type of one field variant: null when absent, ``VOID`` for null."""
    return F.schema_of_variant(f)


def _numeric(t: Column) -> Column:
    return t.isin(*_INTEGRAL, *_FLOATING) | t.startswith("DECIMAL")


def type_ok(f: Column, kind: str, t: Column | None = None) -> Column:
    """Does a *present, non-null* field have the right JSON type?  ``t`` is
    the field's ``json_type`` when already computed."""
    t = json_type(f) if t is None else t
    if kind == "string":
        return t == "STRING"
    if kind == "double":
        return _numeric(t)
    if kind == "long":
        whole = F.try_variant_get(f, "$", "bigint") == F.try_variant_get(f, "$", "double")
        return t.isin(*_INTEGRAL) | (_numeric(t) & F.coalesce(whole, F.lit(False)))
    raise ValueError(kind)


def value_of(f: Column, kind: str) -> Column:
    """Typed value of one field variant (``long`` as bigint)."""
    return F.try_variant_get(f, "$", _TARGET[kind])


# The largest epoch-millisecond value a Spark timestamp (microseconds in a
# long) can hold; beyond it the conversion would overflow and fail the task.
MAX_MILLIS = (2**63 - 1) // 1000


def millis_in_range(ms: Column) -> Column:
    return (ms >= -MAX_MILLIS) & (ms <= MAX_MILLIS)


def millis_ts(f: Column) -> Column:
    """Epoch-millisecond field variant → timestamp; null (never an error)
    when the value is out of the timestamp range."""
    ms = value_of(f, "long")
    return F.when(millis_in_range(ms), F.timestamp_millis(ms))


# -- encoding ----------------------------------------------------------------

def encode(*cols: Column) -> Column:
    """JSON object of the given (aliased) columns; null fields are left out."""
    return F.to_json(F.struct(*cols))


def encode_standard(lat="lat", lng="lng", sending_date="sending_date",
                    drone_id="drone_id") -> Column:
    return encode(as_col(lat).alias("lat"), as_col(lng).alias("lng"),
                  F.unix_millis(as_col(sending_date)).alias("sending_date"),
                  as_col(drone_id).alias("drone_id"))


def encode_violation(lat="lat", lng="lng", sending_date="sending_date", drone_id="drone_id",
                     violation_code="violation_code", image_id="image_id") -> Column:
    return encode(as_col(lat).alias("lat"), as_col(lng).alias("lng"),
                  F.unix_millis(as_col(sending_date)).alias("sending_date"),
                  as_col(drone_id).alias("drone_id"),
                  as_col(violation_code).alias("violation_code"),
                  as_col(image_id).alias("image_id"))


def encode_image(image_id="image_id", content="content") -> Column:
    return encode(as_col(image_id).alias("image_id"), as_col(content).alias("content"))
