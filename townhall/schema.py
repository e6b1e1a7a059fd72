"""Table shapes shared by the readers, extractors and writers."""

from __future__ import annotations

from pyspark.sql import types as T

_string, _long, _bool = T.StringType(), T.LongType(), T.BooleanType()

# The single-community table: 16 columns, in output order.
POST = T.StructType(
    [
        T.StructField("id", _long),
        T.StructField("title", _string),
        T.StructField("body", _string),
        T.StructField("author", _string),
        T.StructField("type", _string),
        T.StructField("channel", _string),
        T.StructField("created_date", _string),
        T.StructField("last_response", _string),
        T.StructField("last_responder", _string),
        T.StructField("view_count", _long),
        T.StructField("response_count", _long),
        T.StructField("reply_count", _long),
        T.StructField("reaction_count", _long),
        T.StructField("has_answer", _bool),
        T.StructField("is_anonymous", _bool),
        T.StructField("is_archived", _bool),
    ]
)

# The multi-channel table: 15 columns, channel second, no is_archived.
CHANNEL_POST_COLUMNS = [
    "id", "channel", "title", "body", "author", "type", "created_date", "last_response",
    "last_responder", "view_count", "response_count", "reply_count", "reaction_count",
    "has_answer", "is_anonymous",
]
CHANNEL_POST = T.StructType([POST[name] for name in CHANNEL_POST_COLUMNS])

CAPTURE = T.StructType([T.StructField("url", _string), T.StructField("data", T.VariantType())])


def all_strings(schema: T.StructType) -> T.StructType:
    """The same columns read as text, for files whose values still need coercion."""
    return T.StructType([T.StructField(f.name, _string) for f in schema.fields])
