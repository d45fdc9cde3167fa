"""Document codecs by name, as Column expressions.

A codec parses a value once; what follows looks only at the parsed column. A value that is no
document is a ``decode_error``, a document that does not fit what was declared a ``reject_error``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

DECODE_ERROR = "decode_error"
REJECT_ERROR = "reject_error"

_CORRUPT = "_corrupt"
_JSON_SPACE = " \t\r\n"
_STRICT = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "columnNameOfCorruptRecord": _CORRUPT,
}


def as_struct(schema: T.StructType | str | None) -> T.StructType | None:
    if isinstance(schema, str):
        return T.StructType.fromDDL(schema)
    return schema


def not_an_object(value: Column) -> Column:
    """True when the text is not one JSON object."""
    parsed = F.from_json(value, T.StructType([T.StructField(_CORRUPT, T.StringType())]), _STRICT)
    return value.isNull() | parsed.isNull() | parsed[_CORRUPT].isNotNull()


@dataclass(frozen=True)
class Codec:
    """How one format is read.

    ``parse`` turns the value into the parsed column; ``fits`` and ``document`` judge and shape it.
    """

    parse: Callable[[Column], Column]
    fits: Callable[[Column, Column], Column]
    document: Callable[[Column], Column]
    reject_detail: str

    def error_class(self, fits: Column, value: Column) -> Column:
        # The second look at the text is taken only where the first one failed.
        return F.when(fits, F.lit(None)).when(not_an_object(value), F.lit(DECODE_ERROR)).otherwise(
            F.lit(REJECT_ERROR)
        )

    def error_detail(self, error_class: Column, value: Column) -> Column:
        return (
            F.when(error_class == REJECT_ERROR, F.lit(self.reject_detail))
            .when(value.isNull(), F.lit("tombstone"))
            .when(error_class == DECODE_ERROR, F.lit("not a JSON object"))
        )


def _json(schema: T.StructType | None) -> Codec:
    if schema is None:
        return _variant(None)
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    return Codec(
        parse=lambda value: F.from_json(value, wide, _STRICT),
        fits=lambda parsed, value: parsed.isNotNull() & parsed[_CORRUPT].isNull(),
        document=lambda parsed: F.struct(*[parsed[n].alias(n) for n in schema.fieldNames()]),
        reject_detail="field does not fit the schema",
    )


def _variant(schema: T.StructType | None) -> Codec:
    return Codec(
        parse=F.try_parse_json,
        # Other roots than objects parse as well; the first sign tells them apart.
        fits=lambda parsed, value: parsed.isNotNull()
        & F.ltrim(value, F.lit(_JSON_SPACE)).startswith("{"),
        document=lambda parsed: parsed,
        reject_detail="repeated field",
    )


def _raw(schema: T.StructType | None) -> Codec:
    return Codec(
        parse=lambda value: value,
        fits=lambda parsed, value: value.isNotNull(),
        document=lambda parsed: F.struct(parsed.alias("text")),
        reject_detail="",
    )


def _encode_json(doc: Column) -> Column:
    return F.to_json(doc)


def _encode_raw(doc: Column) -> Column:
    return doc["text"]


CODECS = {"json": _json, "variant": _variant, "raw": _raw}
ENCODERS = {"json": _encode_json, "variant": _encode_json, "raw": _encode_raw}


def check_format(name: str) -> str:
    key = name.lower()
    if key not in CODECS:
        raise ValueError(f"Unknown format: {name}")
    return key


def codec(name: str, schema: T.StructType | str | None = None) -> Codec:
    """Codec of a format by its case-insensitive name."""
    return CODECS[check_format(name)](as_struct(schema))


def encoder(name: str) -> Callable[[Column], Column]:
    """Encoder of a format by its case-insensitive name; the result is text."""
    return ENCODERS[check_format(name)]


def encode_bytes(name: str, doc: Column) -> Column:
    """Encoded document as UTF-8 bytes, the wire form of a record value."""
    return F.encode(encoder(name)(doc), "UTF-8")
