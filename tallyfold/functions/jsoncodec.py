"""JSON encoding and decoding of update records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.schema import METRIC

# Decoder options: non-numeric tokens (NaN, Infinity) are not JSON numbers.
DECODE_OPTIONS = {"allowNonNumericNumbers": "false", "mode": "PERMISSIVE"}


# JSON types accepted per field of an update record, as VARIANT type names
# (a trailing "(" matches any precision/scale).
FIELD_TYPES = {
    "id": ("STRING", "VOID"),
    "type": ("STRING", "VOID"),
    "hash": ("STRING", "VOID"),
    "delta": ("BIGINT", "VOID"),
    "value": ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL(", "VOID"),
}


# A JSON object as it was sent: every key in order, repeated ones too, with its value.
ENTRIES = "map<string,variant>"


def parse_object(text: Column) -> Column:
    """The entries of a JSON object; NULL if the text does not begin with one.
    Text after the object is ignored."""
    return F.map_entries(F.from_json(text, ENTRIES, DECODE_OPTIONS))


def parse_batch(text: Column) -> Column:
    """The elements of a JSON array, each as its entries (NULL for a null element);
    NULL if the text does not begin with an array of objects and nulls."""
    objects = F.from_json(text, f"array<{ENTRIES}>", DECODE_OPTIONS)
    # An element of another kind is as missing among the objects as a null is; its text tells.
    texts = F.from_json(text, "array<string>", DECODE_OPTIONS)
    whole = F.forall(F.arrays_zip(objects.alias("o"), texts.alias("t")), lambda e: e["o"].isNotNull() | e["t"].isNull())
    return F.when(whole, F.transform(objects, F.map_entries))


def occurrences(entries: Column, name: str) -> Column:
    """The values under a key, in order; keys are the same in any case."""
    return F.transform(F.filter(entries, lambda e: F.lower(e["key"]) == name), lambda e: e["value"])


def _kind_ok(value: Column, allowed: tuple[str, ...]) -> Column:
    kind = F.schema_of_variant(value)
    ok = value.isNull()
    for a in allowed:
        ok = ok | (kind.startswith(a) if a.endswith("(") else kind == a)
    if "DOUBLE" in allowed:  # a number too large for a double is refused, not infinite
        size = F.abs(F.try_variant_get(value, "$", "double"))
        ok = ok & F.coalesce(size != F.lit(float("inf")), F.lit(True))
    return ok


def _accepts(allowed: tuple[str, ...]):
    return lambda value: _kind_ok(value, allowed)


def empty_if_absent(name: str, value: Column) -> Column:
    """Text fields that a record does not carry are empty, not missing."""
    return F.coalesce(value, F.lit("")) if name in ("id", "type") else value


def entries_ok(entries: Column, fields=FIELD_TYPES) -> Column:
    """Every value of a known field, of repeated keys too, has an accepted JSON
    type; other fields are ignored.  A typed decoder would null a wrong field instead."""
    ok = F.lit(True)
    for name, allowed in fields.items():
        ok = ok & F.forall(occurrences(entries, name), _accepts(allowed))
    return F.coalesce(ok, F.lit(True))


def decoded_field(entries: Column, name: str) -> Column:
    """A field of a record: the last value under its key.  A null leaves a text as
    it was (an earlier one stays) and makes a number missing."""
    values = occurrences(entries, name)
    if name in ("delta", "value"):
        return F.try_variant_get(F.try_element_at(values, F.lit(-1)), "$", "bigint" if name == "delta" else "double")
    texts = F.filter(values, lambda v: v.isNotNull() & (F.schema_of_variant(v) != "VOID"))
    return empty_if_absent(name, F.try_variant_get(F.try_element_at(texts, F.lit(-1)), "$", "string"))


def decode_json(df: DataFrame, col: str = "body", schema=METRIC, keep: bool = True) -> DataFrame:
    """Decode a JSON text column into typed update columns.

    ``decoded`` is false, and the row answers 400 later, when the body is
    not JSON, is neither an object nor null, or has a field of the wrong JSON type
    (a float ``delta``, a string ``value``, a number beyond a double).  Text
    after the first JSON value is ignored.  Keys count in any case; of a repeated
    key the last value counts.  An absent ``id`` or ``type`` is empty.  The body is
    parsed once."""
    entries = F.col("_entries")
    fields = {n: t for n, t in FIELD_TYPES.items() if n in set(schema.fieldNames())}
    nothing = F.col(col).rlike(r"^\s*null\s*$")
    ok = F.coalesce(nothing, F.lit(False)) | (entries.isNotNull() & entries_ok(entries, fields))
    out = df.withColumn("_entries", parse_object(F.col(col))).withColumn("decoded", ok)
    made = [decoded_field(entries, f.name).alias(f.name) for f in schema.fields]
    others = [c for c in df.columns if c not in {f.name for f in schema.fields}] if keep else []
    return out.select(*others, *made, "decoded")


def encode_json(cols=("id", "type", "delta", "value")) -> Column:
    """JSON text of the named columns; NULL fields are left out, as the
    reference's ``omitempty`` does."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]))
