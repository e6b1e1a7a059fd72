"""From intercepted responses (url, payload) to flat rows.

A capture table has a ``url`` and a VARIANT ``data`` column plus whatever
ordering columns the caller keeps (``capture_ord`` by convention). Payload
shapes vary, so lists are found by key preference rather than by schema.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from townhall.functions import labels, payloads, text as tx
from townhall.operators.identity import keep_first
from townhall.schema import CHANNEL_POST_COLUMNS, POST

# Key preference when the whole payload may be any list.
ANY_LIST_KEYS = (
    "data", "results", "items", "conversations", "posts", "threads", "content", "records", "collection",
)
# Key preference for conversation payloads, outer and nested level.
CONVERSATION_KEYS = (
    "enrichedContentResources", "allContent", "conversations", "results", "items", "posts", "content", "data",
)
NESTED_KEYS = ("enrichedContentResources", "allContent", "conversations", "results", "items")
# A JSON value that counts as "nothing".
_FALSY = r'^(null|false|""|\[\]|\{\}|-?0(\.0+)?)$'

# The fields of a nested post that are read.
_RESOURCE = """struct<
    id: bigint, title: string, bodyHTML: string, body: string, authorName: string, conversationType: string,
    channel: struct<name: string>, createdDate: string, latestResponseDate: string,
    latestResponseAuthorName: string, viewCount: bigint, responseCount: bigint, replyCount: bigint,
    reactionSummary: struct<reactionCount: bigint>, hasModeratorOrEndorsedResponse: boolean,
    isAnonymous: boolean, isArchived: boolean>"""

# Post column, field it is read from, default.
_PATHS = {
    "author": ("authorName", ""),
    "type": ("conversationType", ""),
    "channel": ("channel.name", ""),
    "created_date": ("createdDate", ""),
    "last_response": ("latestResponseDate", ""),
    "last_responder": ("latestResponseAuthorName", ""),
    "view_count": ("viewCount", 0),
    "response_count": ("responseCount", 0),
    "reply_count": ("replyCount", 0),
    "reaction_count": ("reactionSummary.reactionCount", 0),
    "has_answer": ("hasModeratorOrEndorsedResponse", False),
    "is_anonymous": ("isAnonymous", False),
    "is_archived": ("isArchived", False),
}


# -- which captures ----------------------------------------------------------


def url_contains(df: DataFrame, part: str) -> DataFrame:
    return df.where(F.col("url").contains(part))


def content_type_has(df: DataFrame, *parts: str, column: str = "ct") -> DataFrame:
    """Rows whose content type mentions any of ``parts``."""
    wanted = F.lit(False)
    for part in parts:
        wanted = wanted | F.coalesce(F.col(column).contains(part), F.lit(False))
    return df.where(wanted)


# What the address of a channel's content has in it.
_CONTENT_PATH, _FIRST_BATCH, _CHANNEL_PARTS = "mainLayout/data", "batchNumber=1", ("channelSlugName", "channel=")


def is_content_page(url: Column) -> Column:
    """The address of any content batch of a channel."""
    return url.contains(_CONTENT_PATH) & (url.contains(_CHANNEL_PARTS[0]) | url.contains(_CHANNEL_PARTS[1]))


def is_first_page(url: Column) -> Column:
    """The address of a channel's first content batch."""
    return is_content_page(url) & url.contains(_FIRST_BATCH)


def last_batches(df: DataFrame, by: list[str]) -> DataFrame:
    """The highest batch number seen in any content address of a group."""
    pages = df.where(is_content_page(F.col("url")))
    return pages.groupBy(*by).agg(F.max(tx.batch_number(F.col("url"))).alias("last_batch"))


def page_templates(df: DataFrame, order: str, by: list[str] | None = None) -> DataFrame:
    """First matching first-page address (per group), without its batch number."""
    url = F.col("url")
    first = F.min_by(url, F.col(order))
    hits = df.where(is_first_page(url))
    out = hits.groupBy(*(by or [])).agg(first.alias("url"))
    return out.withColumn("url", tx.without_batch_number(F.col("url")))


# -- finding the list in a payload -------------------------------------------


def first_list(payload: Column, keys=ANY_LIST_KEYS) -> Column:
    """The root if it is a list, else the first key holding a list, even an empty one."""
    return F.coalesce(
        payloads.children(payload), *[payloads.children(payload, k) for k in keys], payloads.no_items()
    )


def _first_filled(payload: Column, keys) -> Column:
    def filled(items: Column) -> Column:
        return F.when(F.size(items) > 0, items)

    return F.coalesce(*[filled(payloads.children(payload, k)) for k in keys])


def conversation_list(payload: Column) -> Column:
    """As ``first_list`` but only non-empty lists count, and one level down is searched too.

    When several nested objects match, the last one in key-name order wins:
    a VARIANT keeps its keys sorted, so the order of arrival is not known.
    """
    nested = F.transform(
        F.map_values(payloads.members(payload)), lambda child: _first_filled(child, NESTED_KEYS)
    )
    nested = F.filter(nested, lambda items: items.isNotNull())
    return F.coalesce(
        payloads.children(payload),
        _first_filled(payload, CONVERSATION_KEYS),
        F.try_element_at(nested, F.lit(-1)),
        payloads.no_items(),
    )


def only_if_objects(items: Column) -> Column:
    """The list when its first element is an object, else an empty list."""
    head = F.try_element_at(items, F.lit(1))
    return F.when(payloads.is_object(head), items).otherwise(payloads.no_items())


def has_usable_id(item: Column) -> Column:
    """Objects whose id is present and neither null, false, 0 nor empty. The text "0" counts."""
    ident = payloads.json_text(F.try_variant_get(item, "$.id", "variant"))
    return F.coalesce(~ident.rlike(_FALSY), F.lit(False))


def explode_items(df: DataFrame, items: Column, keep: list[str] | None = None) -> DataFrame:
    """One row per list element with its position; ``keep`` carries provenance along."""
    carried = keep if keep is not None else df.columns
    return df.select(*carried, F.posexplode(items).alias("pos", "item"))


def records(df: DataFrame, keep: list[str] | None = None, unique_by: list[str] | None = None) -> DataFrame:
    """Generic extraction: any list of objects, each element tagged with its source.

    Records are not deduplicated unless ``unique_by`` names the kept columns that
    order the copies of an id. Records without an id are no copies of each other.
    """
    kept = keep if keep is not None else [c for c in df.columns if c != "data"]
    rows = explode_items(df, only_if_objects(first_list(F.col("data"))), kept)
    if not unique_by:
        return rows
    alone = F.when(item_id().isNull(), F.struct(*unique_by, "pos"))
    return keep_first(rows, [item_id(), alone], [*unique_by, "pos"])


def conversations(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Conversation extraction: elements with a usable id, provenance columns carried."""
    kept = keep if keep is not None else [c for c in df.columns if c != "data"]
    rows = explode_items(df, conversation_list(F.col("data")), kept)
    return rows.where(has_usable_id(F.col("item")))


def resources(df: DataFrame, key: str = "enrichedContentResources", keep: list[str] | None = None) -> DataFrame:
    """Elements of one known list; captures without it give no rows."""
    kept = keep if keep is not None else [c for c in df.columns if c != "data"]
    return explode_items(df, payloads.list_or_empty(F.col("data"), key), kept)


# -- fixed projection --------------------------------------------------------


def read_known(df: DataFrame, keep=()) -> DataFrame:
    """The known fields of every item, read in one go, and the id as text; the item itself goes.

    A field of another type is null. Do this before rows are shuffled.
    """
    return df.select(*keep, item_id().alias("_id"), F.try_variant_get("item", "$", _RESOURCE).alias("_r"))


def _known(df: DataFrame, keep) -> DataFrame:
    return df.select(*keep, "_r") if "_r" in df.columns else read_known(df, keep)


def _columns(names, special: dict[str, Column]) -> list[Column]:
    out = []
    for name in names:
        if name in special:
            out.append(special[name].alias(name))
        else:
            path, default = _PATHS[name]
            out.append(labels.filled(F.col(f"_r.{path}"), default).alias(name))
    return out


def project_posts(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Nested resources -> the 16-column table; tags are dropped from the body."""
    keep = keep or []
    special = {
        "id": F.col("_r.id"),
        "title": F.col("_r.title"),
        "body": tx.strip_tags(F.coalesce("_r.bodyHTML", F.lit(""))),
    }
    return _known(df, keep).select(*keep, *_columns(POST.fieldNames(), special))


def project_channel_posts(df: DataFrame, keep: list[str] | None = None, channel: str = "channel_name") -> DataFrame:
    """Conversations -> the 15-column table; the channel comes from provenance, texts are cleaned."""
    keep = keep or []
    special = {
        "id": F.col("_r.id"),
        "channel": F.coalesce(F.col("_channel"), F.lit("")),
        "title": tx.clean(F.col("_r.title")),
        "body": tx.clean(tx.or_else(F.col("_r.bodyHTML"), F.col("_r.body"))),
    }
    rows = _known(df, [*keep, F.col(channel).alias("_channel")])
    return rows.select(*keep, *_columns(CHANNEL_POST_COLUMNS, special))


def item_id(item: str = "item") -> Column:
    """The id of an untyped record, as a key."""
    return payloads.field(F.col(item), "id")


_WHOLE = r"^-?[0-9]+$"


def problems(required=("id", "title"), item: str = "item") -> Column:
    """Names of the required fields a record lacks, and ``id type`` for an id that is no whole number."""
    found = [F.when(payloads.field(F.col(item), name).isNull(), F.lit(name)) for name in required]
    if "id" in required:
        ident = payloads.field(F.col(item), "id")
        found.append(F.when(ident.isNotNull() & ~(ident.rlike(_WHOLE) & ident.try_cast("bigint").isNotNull()), F.lit("id type")))
    return F.array_compact(F.array(*found))


def split_rejects(df: DataFrame, required=("id", "title"), item: str = "item") -> tuple[DataFrame, DataFrame]:
    """(complete records, the others with their ``problems``)."""
    checked = df.withColumn("problems", problems(required, item))
    return checked.where(F.size("problems") == 0).drop("problems"), checked.where(F.size("problems") > 0)


# -- open-ended projection ---------------------------------------------------


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()):
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here, field.dataType


def _reach(path: tuple[str, ...]) -> Column:
    column = F.col(f"`{path[0]}`")
    for name in path[1:]:
        column = column.getField(name)
    return column


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs -> ``parent_child`` columns, lists -> JSON text, name-sorted.

    Two paths that flatten to the same name: the later one in the schema wins.
    """
    out: dict[str, Column] = {}
    for path, kind in _leaves(df.schema):
        value = _reach(path)
        if isinstance(kind, (T.ArrayType, T.MapType)):
            value = F.to_json(value)
        elif isinstance(kind, T.VariantType):
            value = F.to_json(value)
        out["_".join(path)] = value
    return df.select(*[out[name].alias(name) for name in sorted(out)])


def top_level_keys(df: DataFrame, payload: str = "item") -> DataFrame:
    """Every key of any payload with how many payloads have it: rows, however many keys there are."""
    keys = df.select(F.explode(F.map_keys(payloads.members(F.col(payload)))).alias("key"))
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def payload_schema(df: DataFrame, payload: str = "item", most: int = 10_000) -> T.StructType:
    """Union of all keys over all payloads, as the schema of a wide table.

    One row of schema text reaches the driver, so it is for records with known kinds of keys.
    More than ``most`` columns (ids used as keys, say) raise an error; nothing is left out.
    """
    row = df.agg(F.schema_of_variant_agg(F.col(payload)).alias("s")).first()
    ddl = row.s or "OBJECT<>"
    # a key seen only as null, or with clashing types, is carried as text
    ddl = re.sub(r"\b(VOID|VARIANT)\b(?=[,>]|$)", "STRING", ddl)
    schema = T.DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", ddl))
    columns = sum(1 for _ in _leaves(schema))
    if columns > most:
        raise ValueError(f"{columns} columns; give a schema, or look at top_level_keys")
    return schema


def flatten_payloads(
    df: DataFrame, payload: str = "item", tag: str | None = "url", schema: T.StructType | None = None
) -> DataFrame:
    """Untyped records -> one flat table over the union of their keys, or over a given schema.

    ``tag`` names the provenance column; it is written as ``_source``.
    """
    schema = schema or payload_schema(df, payload)
    typed = F.try_variant_get(F.col(payload), "$", schema.simpleString()).alias("_r")
    carried = [F.col(tag).alias("_source")] if tag else []
    return flatten(df.select(*carried, typed).select(*[c for c in (["_source"] if tag else [])], "_r.*"))


# -- looking at captures -----------------------------------------------------


def payload_profile(df: DataFrame) -> DataFrame:
    """Per capture: all top-level keys, or the name of the payload's type."""
    kind = F.regexp_extract(F.schema_of_variant(F.col("data")), "^[A-Z]+", 0)
    keys = F.array_sort(F.map_keys(payloads.members(F.col("data"))))
    carried = [c for c in df.columns if c != "data"]
    # Type names as the capture log spells them.
    names = F.create_map(*[F.lit(x) for x in (
        "ARRAY", "list", "STRING", "str", "BIGINT", "int", "DOUBLE", "float", "DECIMAL", "float",
        "BOOLEAN", "bool", "VOID", "NoneType",
    )])
    return df.select(
        *carried,
        F.coalesce(
            F.array_join(keys, ","), F.when(kind != "OBJECT", F.try_element_at(names, kind)), F.lit("")
        ).alias("keys"),
    )


def stage_counts(df: DataFrame, *by: str, name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


STAGES = ("captured", "with_list", "exploded", "guarded", "rejected", "projected")


def load_counted(captures: DataFrame, path: str, order: list[str], channel: str = "channel_name") -> DataFrame:
    """Captures to channel posts in Parquet at ``path``, and one row with the counts of all stages.

    The counts are taken in passing by the one job that writes: captures, those with a list, their elements,
    elements with a usable id, incomplete ones among these, and posts after copies are gone. A task that Spark runs
    again counts once; after a lost stage output the counts before the shuffle may hold its tasks twice.
    """
    seen, items, posts = (Observation(f"{name}-{path}") for name in ("captures", "items", "posts"))
    usable, wrong = has_usable_id(F.col("item")), F.size(problems()) > 0
    carried = list(dict.fromkeys([*order, channel]))
    found = captures.select(*carried, conversation_list(F.col("data")).alias("_items")).observe(
        seen, F.count(F.lit(1)).alias("captured"), F.count_if(F.size("_items") > 0).alias("with_list"))
    each = found.select(*carried, F.posexplode("_items").alias("pos", "item")).observe(
        items, F.count(F.lit(1)).alias("exploded"), F.count_if(usable).alias("guarded"),
        F.count_if(usable & wrong).alias("rejected"))
    known = read_known(each.where(usable & ~wrong), [*carried, "pos"])
    first = keep_first(known, ["_id"], [*order, "pos"])
    project_channel_posts(first, channel=channel).observe(posts, F.count(F.lit(1)).alias("projected")).write.parquet(path)
    counts = {**seen.get, **items.get, **posts.get}
    return captures.sparkSession.createDataFrame(
        [tuple(counts.get(stage, 0) for stage in STAGES)], ", ".join(f"{stage} long" for stage in STAGES))


def preview(df: DataFrame, order: list[str], rows: int = 5, width: int = 60) -> DataFrame:
    return (
        df.orderBy(*order)
        .limit(rows)
        .select(
            *order, "type", tx.prefix(F.col("title"), width).alias("title"),
            "view_count", "response_count",
        )
    )
