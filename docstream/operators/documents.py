"""Decoding, normalising and profiling documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docstream.functions.codecs import as_struct, check_format, codec, encoder


def _parsed_once(log: DataFrame, parsed: Column) -> DataFrame:
    """Add ``_parsed``, evaluated once per row.

    It comes out of a generator. Catalyst copies a projected expression into every filter on it,
    and would parse the text again for each; a generator's output it leaves alone.
    """
    return log.select("*", F.explode(F.array(parsed)).alias("_parsed"))


def classify(
    log: DataFrame, fmt: str = "json", schema: T.StructType | str | None = None
) -> DataFrame:
    """Add ``doc``, ``error_class`` and ``error_detail`` to every record.

    ``doc`` is null exactly where ``error_class`` is set.
    """
    how, value, parsed = codec(fmt, schema), F.col("value"), F.col("_parsed")
    fits = how.fits(parsed, value)
    error_class = how.error_class(fits, value)
    return _parsed_once(log, how.parse(value)).select(
        *log.columns,
        F.when(fits, how.document(parsed)).alias("doc"),
        error_class.alias("error_class"),
        how.error_detail(error_class, value).alias("error_detail"),
    )


def is_accepted() -> Column:
    """Accepted records of a classified log; asking for the document leaves the errors uncomputed."""
    return F.col("doc").isNotNull()


def accepted(classified: DataFrame) -> DataFrame:
    return classified.filter(is_accepted()).drop("error_class", "error_detail")


def document_id(doc: Column, kind: T.DataType, field: str) -> Column:
    """Text of a document's id field; null where the document has none."""
    if isinstance(kind, T.VariantType):
        return F.try_variant_get(doc, f"$.{field}", "string")
    if not isinstance(kind, T.StructType) or field not in kind.fieldNames():
        raise ValueError(f"Documents have no field {field}")
    return doc[field].cast("string")


def identify(classified: DataFrame, id_field: str | None = None) -> DataFrame:
    """Accepted records under their document's id.

    ``key`` becomes the id field of the document where one is named and filled, else it stays the
    record key. Accepted records with neither are set aside as ``reject_error``: they are no
    version of each other. Records set aside keep their key.
    """
    ok = is_accepted()
    own = F.col("key")
    if id_field is not None:
        own = F.coalesce(document_id(F.col("doc"), classified.schema["doc"].dataType, id_field), own)
    nameless = ok & own.isNull()
    return classified.withColumns(
        {
            "key": F.when(ok, own).otherwise(F.col("key")),
            "doc": F.when(~nameless, F.col("doc")),
            "error_class": F.when(nameless, "reject_error").otherwise(F.col("error_class")),
            "error_detail": F.when(nameless, "neither a document id nor a key").otherwise(F.col("error_detail")),
        }
    )


def rejected(classified: DataFrame) -> DataFrame:
    """Records set aside, with the untouched value."""
    return classified.filter(~is_accepted()).drop("doc")


def decode(log: DataFrame, fmt: str = "json", schema: T.StructType | str | None = None) -> DataFrame:
    """Accepted records with their document, without the encoded value."""
    return accepted(classify(log, fmt, schema)).drop("value")


def normalise(decoded: DataFrame, schema: T.StructType | str | None = None) -> DataFrame:
    """Every declared document field as a column of its own name; no renames, drops or casts.

    A field that shares its name with a record column is prefixed with ``doc_``. Documents of
    undeclared schema stay one VARIANT column.
    """
    declared = as_struct(schema)
    if declared is None:
        return decoded
    taken = set(decoded.columns) - {"doc"}
    return decoded.select(
        *[c for c in decoded.columns if c != "doc"],
        *[
            F.col("doc")[name].alias(f"doc_{name}" if name in taken else name)
            for name in declared.fieldNames()
        ],
    )


def encode_documents(
    docs: DataFrame, topic: str, key: str, fields: list[str], fmt: str = "json"
) -> DataFrame:
    """Keyed records from document columns."""
    check_format(fmt)
    return docs.select(
        F.lit(topic).alias("topic"),
        F.col(key).cast("string").alias("key"),
        encoder(fmt)(F.struct(*fields)).alias("value"),
    )


def failure_counts(classified: DataFrame) -> DataFrame:
    """Records per outcome."""
    return classified.groupBy(F.coalesce("error_class", F.lit("ok")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n_records")
    )


def flatten_fields(log: DataFrame, *keep: str) -> DataFrame:
    """One row per (record, field, value), values as text; a repeated field keeps its last (P5)."""
    as_map = F.try_variant_get("_parsed", "$", "map<string,string>")
    # Values the variant parser refuses for a repeated field take the long way.
    repeated = F.when(
        F.col("_parsed").isNull(), F.map_entries(F.from_json("value", "map<string,string>"))
    )
    last = F.transform(
        F.array_distinct(F.transform(repeated, lambda e: e["key"])),
        lambda k: F.struct(
            k.alias("key"),
            F.element_at(F.filter(repeated, lambda e: e["key"] == k), -1)["value"].alias("value"),
        ),
    )
    entries = F.coalesce(F.map_entries(as_map), last)
    return _parsed_once(log, F.try_parse_json("value")).select(
        *keep, F.inline(entries).alias("field", "field_value")
    )


_JSON_TYPES = (
    ("OBJECT", "object"),
    ("ARRAY", "array"),
    ("STRING", "string"),
    ("BOOLEAN", "boolean"),
    ("VOID", "null"),
    ("BIGINT", "integer"),
)


def field_profile(log: DataFrame) -> DataFrame:
    """Documents per (field, JSON type): the schema the documents themselves suggest."""
    fields = log.select(F.try_parse_json("value").alias("v")).lateralJoin(
        log.sparkSession.tvf.variant_explode(F.col("v").outer())
    )
    kind = F.schema_of_variant("value")
    named = F.lit("number")
    for prefix, name in reversed(_JSON_TYPES):
        named = F.when(kind.startswith(prefix), name).otherwise(named)
    return (
        fields.filter(F.col("key").isNotNull())
        .groupBy(F.col("key").alias("field"), named.alias("json_type"))
        .agg(F.count(F.lit(1)).alias("n_docs"))
    )


def infer_schema(log: DataFrame) -> DataFrame:
    """One row: the merged schema of all documents as text."""
    return log.agg(F.schema_of_variant_agg(F.try_parse_json("value")).alias("doc_schema"))


def inferred_fields(log: DataFrame) -> DataFrame:
    """One merged type per field of all documents: JSON types that were seen, widened where they differ.

    ``integer`` and ``number`` make ``number``; any other difference makes ``mixed``; ``null`` fits all.
    ``n_docs`` counts the documents that have the field.
    """
    kinds = field_profile(log).groupBy("field").agg(
        F.array_sort(F.collect_set(F.when(F.col("json_type") != "null", F.col("json_type")))).alias("kinds"),
        F.sum("n_docs").alias("n_docs"),
    )
    numbers = F.array(F.lit("integer"), F.lit("number"))
    return kinds.select(
        "field",
        F.when(F.size("kinds") == 0, "null")
        .when(F.size("kinds") == 1, F.col("kinds")[0])
        .when(F.size(F.array_except("kinds", numbers)) == 0, "number")
        .otherwise("mixed")
        .alias("json_type"),
        "n_docs",
    )


def key_mismatches(decoded: DataFrame, id_field: str = "id") -> DataFrame:
    """Records whose key is not the id of their document."""
    doc_id = F.col("doc")[id_field].cast("string")
    return decoded.filter(~F.col("key").eqNullSafe(doc_id)).withColumn("doc_id", doc_id)
