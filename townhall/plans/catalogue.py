"""Every registered query: (spark, folder) -> DataFrame over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from townhall.functions import dates, labels, numbers, payloads, text as tx
from townhall.functions.labels import QUESTION
from townhall.operators import capture, cube, distributions, filters, identity, idsets, metrics, ranking, sketches, terms
from townhall.operators.filters import PostFilter, having
from townhall.operators.typed import multi_channel_posts, single_community_posts
from townhall.plans import dashboard, report
from townhall.plans import tables as tb
from townhall.schema import CAPTURE, CHANNEL_POST_COLUMNS
from townhall.session import scratch_path, settings, settle
from townhall.sources import files
from townhall.sources.store import PostStore
from townhall.streaming import corrections, jobs, late

Query = Callable[[SparkSession, str], DataFrame]
CATALOGUE: dict[str, Query] = {}

CHOSEN = PostFilter("1-URGENT", QUESTION, ("1996-01", "1996-02", "1997-05", "1998-11"))


def query(fn: Query) -> Query:
    """Register a query under its function name; sessions run in UTC."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    CATALOGUE[fn.__name__] = run
    return run


def naive(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


# -- headline figures --------------------------------------------------------


@query
def kpi_overview(spark, sf):
    return metrics.overview(tb.posts(spark, sf))


@query
def kpi_text(spark, sf):
    return metrics.overview_text(metrics.overview(tb.posts(spark, sf)))


@query
def kpi_support(spark, sf):
    return metrics.support_figures(tb.posts(spark, sf))


@query
def response_lines(spark, sf):
    return metrics.response_lines(tb.posts(spark, sf))


@query
def response_lines_positive(spark, sf):
    return metrics.response_lines(tb.posts(spark, sf), positive_only=True)


@query
def anonymous_posts(spark, sf):
    return metrics.anonymous_posts(tb.posts(spark, sf))


# -- top lists ---------------------------------------------------------------

_LISTED = ["id", "short_title", "channel", "view_count"]


@query
def top_posts(spark, sf):
    return ranking.top_posts(tb.posts(spark, sf)).select("id", "title", "view_count", "response_count")


@query
def top_posts_listing(spark, sf):
    return report.listing(tb.posts(spark, sf))


@query
def top_unanswered(spark, sf):
    return ranking.ascending(ranking.top_unanswered(tb.posts(spark, sf)), "view_count").select(*_LISTED)


@query
def top_questions(spark, sf):
    return ranking.ascending(ranking.top_questions(tb.posts(spark, sf)), "view_count").select(*_LISTED)


@query
def top_shares(spark, sf):
    return ranking.top_shares(tb.posts(spark, sf)).select("id", "short_title", "reaction_count", "view_count")


@query
def hardest_question(spark, sf):
    return ranking.hardest_question(tb.posts(spark, sf))


@query
def top_authors(spark, sf):
    return ranking.top_authors(tb.posts(spark, sf))


@query
def author_views_nested_topk(spark, sf):
    return ranking.top_authors_by_views(tb.posts(spark, sf))


# -- rollups -----------------------------------------------------------------


@query
def answered_by_channel(spark, sf):
    return metrics.answered_by_channel(tb.posts(spark, sf))


@query
def median_response_by_channel(spark, sf):
    return metrics.median_response_by(tb.posts(spark, sf))


@query
def bracketed_median_by_channel(spark, sf):
    return metrics.bracketed_median_response_by(tb.posts(spark, sf))


@query
def channel_summary(spark, sf):
    return metrics.channel_summary(tb.posts(spark, sf))


@query
def channel_sizes(spark, sf):
    return metrics.group_sizes(tb.posts(spark, sf), "channel")


@query
def type_share(spark, sf):
    return metrics.type_share(tb.posts(spark, sf))


@query
def monthly_posts(spark, sf):
    return metrics.monthly_posts(tb.posts(spark, sf))


@query
def monthly_by_type(spark, sf):
    return metrics.monthly_by_type(tb.posts(spark, sf))


@query
def monthly_pivot(spark, sf):
    names = dict(zip(labels.TYPE_LABELS.values(), ("questions", "shares", "live_sessions")))
    return metrics.monthly_pivot(tb.posts(spark, sf), names)


@query
def author_activity(spark, sf):
    return metrics.author_activity(tb.posts(spark, sf)).orderBy(F.desc("total_views"), F.asc("author"))


@query
def poster_frequency(spark, sf):
    return metrics.poster_frequency(tb.posts(spark, sf))


# -- distributions -----------------------------------------------------------


@query
def response_histogram(spark, sf):
    return distributions.histogram(tb.posts(spark, sf), "latest_response_hours")


@query
def response_histogram_rounded(spark, sf):
    return distributions.rounded_histogram(tb.posts(spark, sf), "latest_response_hours")


@query
def views_vs_responses(spark, sf):
    return distributions.views_vs_responses(tb.posts(spark, sf))


@query
def views_by_response_count(spark, sf):
    return distributions.views_by_response_count(tb.posts(spark, sf))


@query
def views_response_correlation(spark, sf):
    out = distributions.views_response_correlation(tb.posts(spark, sf))
    return out.select(F.round("correlation", 6).alias("correlation"))


# -- filters and the full table ----------------------------------------------


@query
def filtered_dashboard(spark, sf):
    shown = CHOSEN.apply(tb.posts(spark, sf))
    return shown.select("id", "title", "month", "view_count", "response_count")


def _section(name: str):
    """One view of the dashboard under the chosen filters."""

    def view(spark, sf):
        out = dashboard.sections(tb.posts(spark, sf), CHOSEN)[name]()
        return out.select(*_LISTED) if name == "top_questions" else out

    view.__name__ = f"chosen_{name}"
    return query(view)


for _name in ("support_figures", "support_text", "channel_summary", "top_questions", "answered_by_channel", "median_response", "terms"):
    _section(_name)


@query
def report_overview(spark, sf):
    return report.sections(tb.posts(spark, sf))["overview"]()


@query
def empty_histogram(spark, sf):
    """A choice that no post meets gives a histogram without bins."""
    nothing = PostFilter("no such channel").apply(tb.posts(spark, sf))
    return distributions.histogram(nothing, "latest_response_hours").agg(F.count(F.lit(1)).alias("bins"))


@query
def kept_report(spark, sf):
    """Two figures over one kept frame."""
    # a frame of its own, so that other queries do not read it in place of the tables
    posts = files.kept(tb.posts(spark, sf).select("channel", "id", "type_label", "has_responses", F.lit(1).alias("one")))
    sizes = metrics.group_sizes(posts, "channel")
    return sizes.join(metrics.answered_by_channel(posts), "channel")


@query
def filter_options(spark, sf):
    return filters.filter_options(tb.posts(spark, sf))


@query
def month_options(spark, sf):
    return filters.options(tb.posts(spark, sf), "month")


@query
def full_table(spark, sf):
    out = report.full_table(tb.posts(spark, sf))
    return out.withColumn("created_date", naive("created_date"))


# -- typing ------------------------------------------------------------------


@query
def type_labels(spark, sf):
    kinds = F.when(F.pmod("o_orderkey", F.lit(11)) == 0, F.lit("pollPost")).otherwise(tb._post_type())
    return tb.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), labels.mapped(kinds, labels.TYPE_LABELS).alias("type_label"))


@query
def flags(spark, sf):
    """Flags spelled in many ways, and dates before 2000 dropped as sentinels."""
    key = F.col("o_orderkey")
    spelled = F.element_at(
        F.array(*[F.lit(x) for x in ("True", "true", "1", "yes", "YES", "0", "no", "", "False")]),
        (F.pmod(key, F.lit(9)) + 1).cast("int"))
    spelled = F.when(F.pmod(key, F.lit(10)) != 9, spelled)
    return tb.table(spark, sf, "orders").select(
        key.alias("id"),
        labels.truthy_text(spelled).alias("flag"),
        tx.one_of(spelled, ["TRUE", "Yes"]).alias("spelled_out"),
        dates.not_before(F.col("o_orderdate")).alias("real_date"),
    )


@query
def coerce_numbers(spark, sf):
    key, price = F.col("o_orderkey"), F.format_string("%.2f", F.col("o_totalprice"))
    case = F.pmod(key, F.lit(12))
    spelled = (
        F.when(case == 0, price)
        .when(case == 1, F.concat(F.lit("  "), price, F.lit(" ")))
        .when(case == 2, F.concat(F.lit("-"), price))
        .when(case == 3, F.concat(key.cast("string"), F.lit("e2")))
        .when(case == 4, F.concat(F.lit("+"), key.cast("string")))
        .when(case == 5, F.concat(price, F.lit("d")))
        .when(case == 6, F.concat(F.lit("1,"), price))
        .when(case == 7, "abc").when(case == 8, "").when(case == 9, "NaN").when(case == 10, "inf")
    )
    return tb.table(spark, sf, "orders").select(key.alias("id"), numbers.to_count(spelled).alias("n"))


@query
def parse_dates(spark, sf):
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    stamp = F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss")
    case = F.pmod(key, F.lit(9))
    spelled = (
        F.when(case == 0, F.concat(stamp, F.lit("Z")))
        .when(case == 1, F.concat(stamp, F.lit(".123Z")))
        .when(case == 2, F.concat(stamp, F.lit("+02:00")))
        .when(case == 3, F.date_format(day, "yyyy-MM-dd"))
        .when(case == 4, "0001-01-01T00:00:00Z").when(case == 5, "").when(case == 6, "bad")
        .when(case == 7, "1999-12-31T23:59:59Z")
    )
    parsed = dates.parse_timestamp(spelled)
    return tb.table(spark, sf, "orders").select(
        key.alias("id"),
        parsed.cast("timestamp_ntz").alias("parsed"),
        dates.not_before(parsed).cast("timestamp_ntz").alias("real"),
        dates.month_key(parsed).alias("month"),
    )


@query
def typed_report(spark, sf):
    """Raw text columns through the whole typing step."""
    raw = tb.raw_posts(spark, sf)
    as_text = raw.withColumns(
        {
            "created_date": F.date_format("created_date", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            "last_response": F.date_format("last_response", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            "view_count": F.col("view_count").cast("string"),
            "response_count": F.col("response_count").cast("string"),
            "is_anonymous": F.initcap(F.col("is_anonymous").cast("string")),
        }
    )
    return single_community_posts(as_text).select(
        "id", "view_count", "response_count", "latest_response_hours", "month", "type_label",
        "short_title", "has_responses", "is_anonymous")


# -- texts -------------------------------------------------------------------


@query
def short_text(spark, sf):
    text = F.col("text")
    return tb.table(spark, sf, "documents").select(
        "doc_id", tx.ellipsize(text, 50).alias("short"), tx.prefix(text, 25).alias("label"),
        tx.pad_right(tx.prefix(text, 40), 44).alias("padded"), tx.not_blank(text).alias("filled"),
        F.length(tx.joined(text, F.col("lang"), F.lit(None).cast("string"))).alias("joined_length"))


@query
def clean_html(spark, sf):
    pages = tb.table(spark, sf, "pages")
    return pages.select("page_id", tx.tidy(F.col("html")).alias("text"))


@query
def clean_html_full(spark, sf):
    pages = tb.table(spark, sf, "pages")
    return pages.select("page_id", tx.clean(F.col("html")).alias("text"))


@query
def strip_tags(spark, sf):
    pages = tb.table(spark, sf, "pages")
    return pages.select("page_id", tx.strip_tags(F.col("html")).alias("text"))


# -- links and channels ------------------------------------------------------


@query
def page_links(spark, sf):
    return tb.links(spark, sf)


@query
def url_slugs(spark, sf):
    rows = tb.channel_links(spark, sf).select("ord.page_id", "ord.pos", tx.url_slug(F.col("href")).alias("slug"))
    return rows.where(F.col("slug").isNotNull())


@query
def link_dimension(spark, sf):
    found = identity.channels_from_links(tb.channel_links(spark, sf))
    return identity.keep_first(found, ["slug"], ["ord"]).drop("ord")


@query
def channel_dimension(spark, sf):
    return identity.channel_dimension(
        identity.channels_from_links(tb.channel_links(spark, sf)),
        identity.channels_from_payloads(tb.channel_payloads(spark, sf)),
    )


@query
def channel_urls(spark, sf):
    href = F.when(F.pmod("page_id", F.lit(2)) == 0, F.col("url")).otherwise("")
    slug = F.concat(F.lit("p "), F.col("page_id"))
    return tb.table(spark, sf, "pages").select(
        "page_id", tx.channel_url(href, "https://community.example.org", slug).alias("channel_url"))


@query
def short_link_texts(spark, sf):
    return tb.links(spark, sf).where(tx.label_length_ok(F.col("text"))).select("page_id", "pos", "text")


@query
def page_templates(spark, sf):
    return capture.page_templates(tb.captures(spark, sf), "capture_ord", ["channel_name"])


@query
def next_pages(spark, sf):
    """The addresses of all further batches of a channel, up to the last one its pages name."""
    seen = tb.captures(spark, sf)
    firsts = capture.page_templates(seen, "capture_ord", ["channel_name"])
    last = capture.last_batches(seen, ["channel_name"]).where("last_batch >= 2")
    batches = F.explode(F.sequence(F.lit(2), F.col("last_batch")))
    return firsts.join(last, "channel_name").select("channel_name", "url", batches.alias("batch")).select(
        "channel_name", "batch", tx.with_batch_number(F.col("url"), F.col("batch")).alias("url"))


@query
def batch_addresses(spark, sf):
    """The address of a page's batch, built from its parts."""
    slug = F.concat(F.lit("c%20"), F.col("page_id"))
    address = tx.with_query(
        "https://community.example.org/views/mainLayout/data", org="org", comm="comm", channelSlugName=slug,
        contentId=0, batchNumber=F.pmod("page_id", F.lit(5)) + 1, preferredTimezone="America%2FDenver")
    return tb.table(spark, sf, "pages").select("page_id", address.alias("address"), tx.batch_number(address).alias("batch"))


# -- payloads ----------------------------------------------------------------


@query
def json_path(spark, sf):
    rows = tb.event_keys(tb.props(spark, sf))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"))


@query
def payload_keys(spark, sf):
    profile = capture.payload_profile(tb.captures(spark, sf))
    return capture.stage_counts(profile, "keys")


@query
def content_types(spark, sf):
    rows = capture.content_type_has(tb.captures(spark, sf), "json", "javascript")
    return capture.stage_counts(capture.url_contains(rows, "example.org"), "ct")


@query
def list_discovery(spark, sf):
    rows = capture.records(tb.captures(spark, sf), ["capture_ord", "url"])
    return rows.select(
        "capture_ord", "url", "pos", payloads.field(F.col("item"), "id", "bigint").alias("id"))


@query
def nested_list_discovery(spark, sf):
    rows = capture.conversations(tb.captures(spark, sf), ["capture_ord", "channel_name"])
    return rows.select(
        "capture_ord", "channel_name", "pos", payloads.field(F.col("item"), "id", "bigint").alias("id"))


@query
def usable_ids(spark, sf):
    rows = tb.id_cases(spark, sf).where(capture.has_usable_id(F.col("item")))
    return rows.select("ord", payloads.field(F.col("item"), "id").alias("id"))


@query
def capture_counts(spark, sf):
    rows = capture.records(tb.captures(spark, sf), ["url"])
    return capture.stage_counts(rows, "url")


@query
def load_counts(spark, sf):
    """The counts of all stages of a load, taken by the job that writes the posts."""
    path = scratch_path(spark, "loaded")
    return capture.load_counted(tb.captures(spark, sf), path, ["channel_name", "capture_ord"])


def _extracted(spark, sf):
    wanted = capture.url_contains(tb.captures(spark, sf), "mainLayout")
    rows = capture.resources(wanted, keep=["capture_ord"])
    complete, _ = capture.split_rejects(rows)
    known = capture.read_known(complete, ["capture_ord", "pos"])
    return capture.project_posts(identity.keep_first(known, ["_id"], ["capture_ord", "pos"]), keep=["capture_ord", "pos"])


@query
def capture_rejects(spark, sf):
    """Records that are no posts, with what is wrong with them."""
    items = tb.id_cases(spark, sf)
    _, rejects = capture.split_rejects(items, required=("id",))
    return rejects.select("ord", F.array_join("problems", ",").alias("problems"))


@query
def capture_posts(spark, sf):
    """Captures to the deduplicated 16-column post table."""
    return _extracted(spark, sf).drop("capture_ord", "pos")


@query
def capture_preview(spark, sf):
    return capture.preview(_extracted(spark, sf), ["capture_ord", "pos"])


def _channel_extracted(spark, sf):
    rows = capture.conversations(tb.captures(spark, sf), ["channel_name", "capture_ord"])
    known = capture.read_known(rows, ["channel_name", "capture_ord", "pos"])
    first = identity.keep_first(known, ["_id"], ["channel_name", "capture_ord", "pos"])
    return capture.project_channel_posts(first, keep=["capture_ord", "pos"])


@query
def channel_posts(spark, sf):
    """Captures of all channels to the 15-column table; a post belongs to its first channel."""
    return _channel_extracted(spark, sf).select(*CHANNEL_POST_COLUMNS)


@query
def channel_post_counts(spark, sf):
    return capture.stage_counts(_channel_extracted(spark, sf), "channel")


@query
def channel_top_posts(spark, sf):
    head = ranking.top(_channel_extracted(spark, sf), 5, "view_count")
    return head.select("id", "channel", tx.prefix(F.col("title"), 55).alias("title"), "view_count")


def _nested_orders(spark, sf):
    return tb.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.struct(
            F.struct(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("tier")).alias("owner"),
            F.col("o_orderstatus").alias("status"),
        ).alias("order"),
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
    )


@query
def flatten_nested(spark, sf):
    return capture.flatten(_nested_orders(spark, sf))


@query
def flatten_union(spark, sf):
    """Untyped records of differing shape to one table over the union of their keys."""
    key = F.col("o_orderkey")
    text = (
        F.when(F.pmod(key, F.lit(3)) == 0, F.to_json(F.struct(key.alias("id"), F.struct(F.col("o_custkey").alias("n")).alias("by"))))
        .when(F.pmod(key, F.lit(3)) == 1, F.to_json(F.struct(key.alias("id"), F.col("o_orderstatus").alias("status"))))
        .otherwise(F.to_json(F.struct(key.alias("id"), F.array("o_orderstatus", "o_orderpriority").alias("tags"))))
    )
    rows = tb.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("url"), F.parse_json(text).alias("item"))
    return capture.flatten_payloads(rows)


@query
def flatten_union_csv(spark, sf):
    """The union of all keys written as CSV and read back."""
    path = scratch_path(spark, "union")
    flat = flatten_union(spark, sf)
    files.write_csv(flat, path)
    return spark.read.schema(flat.schema).options(**files.CSV_OPTIONS).csv(path)


@query
def key_union(spark, sf):
    """All keys that occur in any extracted record, with how many records have them."""
    return capture.top_level_keys(capture.records(tb.captures(spark, sf), ["capture_ord"]))


# -- identity ----------------------------------------------------------------


@query
def dedupe_first(spark, sf):
    docs = tb.table(spark, sf, "documents")
    return identity.keep_first(docs, [identity.text_digest(F.col("text"))], ["doc_id"]).select("doc_id", "lang")


@query
def dedupe_across_channels(spark, sf):
    """Documents as posts shown in several channels (sources): the first source keeps a text."""
    docs = tb.table(spark, sf, "documents")
    kept = identity.keep_first(docs, [identity.text_digest(F.col("text"))], ["source", "doc_id"])
    return capture.stage_counts(kept, "source")


@query
def incremental_new(spark, sf):
    """Documents whose text the first source had not brought already."""
    docs = tb.table(spark, sf, "documents").select(
        "doc_id", "source", identity.text_digest(F.col("text")).alias("digest"))
    return identity.new_rows(docs, docs.where(F.col("source") == "src0"), "digest").drop("digest")


@query
def accumulate(spark, sf):
    """First click per user, then every other user's first event of any kind."""
    events = tb.table(spark, sf, "events").select("event_id", "user_id", "event_type")
    seen = identity.keep_first(events.where(F.col("event_type") == "click"), ["user_id"], ["event_id"])
    return identity.append_new(seen, events, ["event_id"], "user_id")


@query
def conversation_posts(spark, sf):
    """Conversations as posts: the first user turn is the title, assistant turns the responses."""
    rows = tb.table(spark, sf, "conversations").groupBy("conv_id").agg(
        F.min_by(F.when(F.col("role") == "user", F.col("text")),
                 F.when(F.col("role") == "user", F.col("turn"))).alias("title"),
        F.count_if(F.col("role") == "assistant").alias("response_count"),
        F.count(F.lit(1)).alias("turns"),
    )
    return rows.withColumn("has_responses", F.col("response_count") > 0).withColumn(
        "short_title", tx.ellipsize(F.col("title"), 55))


@query
def bitmap_new_posts(spark, sf):
    """Lines of orders that are not loaded, told by the set of loaded ids alone."""
    orders, lines = tb.table(spark, sf, "orders"), tb.table(spark, sf, "lineitem")
    loaded = orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    seen = settle(idsets.id_set(loaded, "o_orderkey"), "seen")
    return idsets.unseen(lines.select("l_orderkey", "l_linenumber", "l_returnflag"), seen, "l_orderkey")


@query
def bitmap_load(spark, sf):
    """Three loads of lines as posts, one after the other: each adds the first copies of ids not seen before."""
    lines = tb.table(spark, sf, "lineitem").where(F.col("l_returnflag") != "R").select(
        F.col("l_orderkey").alias("id"), (F.col("l_linenumber") % 3).cast("int").alias("part"), "l_linenumber")
    seen, loaded = idsets.id_set(lines.where("false"), "id"), []
    for part in range(3):
        fresh, added = idsets.load(lines.where(F.col("part") == part), seen, "id", ["l_linenumber"])
        loaded.append(fresh.select("id", "part"))
        seen = settle(seen.unionByName(added), "seen")
    return loaded[0].unionByName(loaded[1]).unionByName(loaded[2])


@query
def stored_loads(spark, sf):
    """Documents in three loads, into a store in buckets of their text's digest that is compacted before the third."""
    docs = tb.table(spark, sf, "documents").select(
        identity.text_digest(F.col("text")).alias("digest"), "doc_id", (F.col("doc_id") % 3).cast("int").alias("part"))
    store = PostStore.open(spark, scratch_path(spark, "store"), docs.schema, "digest", buckets=16)
    for part in range(3):
        store.load(docs.where(F.col("part") == part), ["doc_id"])
        if part == 1:
            store.compact()
    return store.posts().select("doc_id", "part")


@query
def stored_lookup(spark, sf):
    """Orders as stored posts, each with its lines; orders and lines lie in stores of equal buckets."""
    orders = tb.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    lines = tb.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.count(F.lit(1)).alias("responses"), F.max("l_shipdate").alias("latest"))
    posts = PostStore.open(spark, scratch_path(spark, "posts"), orders.schema, "id", buckets=16)
    answers = PostStore.open(spark, scratch_path(spark, "answers"), lines.schema, "id", buckets=16)
    posts.load(orders, ["status"])
    answers.load(lines, ["latest"])
    return posts.posts().join(answers.posts(), "id", "left").groupBy("id").agg(
        F.max("status").alias("status"), F.sum(F.coalesce("responses", F.lit(0))).alias("responses"),
        F.max("latest").alias("latest"))


@query
def bitmap_members(spark, sf):
    """Different authors by month, and by year and in all from the stored sets of the months."""
    orders = tb.table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_custkey")
    months = settle(idsets.id_set(orders, "o_custkey", ["month"]), "months")
    parts = months.select("range", "bits", F.explode(
        F.array("month", F.substring("month", 1, 4), F.lit("all"))).alias("period"))
    return idsets.size(parts, ["period"], "members")


@query
def sketched_members(spark, sf):
    """Authors of each channel and of all channels from stored sketches of (channel, month), against exact counts."""
    posts = tb.posts(spark, sf).select("channel", "month", "author")
    stored = settle(sketches.member_sketches(posts), "sketches")
    about = sketches.members_about(stored, ["channel"], "about").unionByName(
        sketches.members_about(stored, [], "about").withColumn("channel", F.lit("All")))
    people = posts.select("author", F.explode(F.array("channel", F.lit("All"))).alias("channel"))
    exact = people.groupBy("channel").agg(F.count_distinct("author").alias("authors"))
    return exact.join(about, "channel").select(
        "channel", "authors", sketches.agrees(F.col("about"), F.col("authors")).alias("agrees"))


# -- the cube of filter choices ----------------------------------------------


def _cube(spark, sf) -> cube.Cube:
    """Built once and written, as a report keeps it."""
    path = scratch_path(spark, "cube")
    cube.build(tb.posts(spark, sf)).write(path)
    return cube.Cube.read(spark, path)


@query
def cube_choices(spark, sf):
    return cube.choices(_cube(spark, sf))


@query
def cube_support_figures(spark, sf):
    return cube.support_figures(_cube(spark, sf), CHOSEN)


@query
def cube_channel_summary(spark, sf):
    """Per channel for several months of every type: authors are counted from the members, not summed."""
    return cube.channel_summary(_cube(spark, sf), PostFilter(months=CHOSEN.months))


@query
def cube_answered_by_channel(spark, sf):
    return cube.answered_by_channel(_cube(spark, sf), PostFilter(type_label=QUESTION))


@query
def cube_poster_frequency(spark, sf):
    return cube.poster_frequency(_cube(spark, sf), CHOSEN)


# -- terms -------------------------------------------------------------------


def _documents(spark, sf):
    return tb.table(spark, sf, "documents").select("text")


@query
def term_counts(spark, sf):
    return terms.term_counts(_documents(spark, sf), "text", terms.ENGLISH_STOPWORDS)


@query
def bigram_counts(spark, sf):
    return terms.bigram_counts(_documents(spark, sf), "text", terms.REPORT_STOPWORDS)


@query
def collocations(spark, sf):
    out = terms.collocations(_documents(spark, sf), "text", terms.REPORT_STOPWORDS)
    return out.select("bigram", "n_bigram", "n_1", "n_2", F.round("score", 4).alias("score"))


@query
def pruned_collocations(spark, sf):
    out = terms.pruned_collocations(_documents(spark, sf), "text", terms.REPORT_STOPWORDS)
    return out.select("bigram", "n_bigram", "n_1", "n_2", F.round("score", 4).alias("score"))


@query
def top_terms(spark, sf):
    counts = terms.cloud_counts(_documents(spark, sf), "text", terms.REPORT_STOPWORDS)
    return terms.most_frequent(counts, terms.REPORT_TERMS)


@query
def top_terms_overview(spark, sf):
    counts = terms.cloud_counts(_documents(spark, sf), "text", terms.ENGLISH_STOPWORDS)
    return terms.most_frequent(counts, terms.OVERVIEW_TERMS)


@query
def question_terms(spark, sf):
    """Words of titles and bodies of questions, as the dashboard counts them."""
    asked = filters.questions(tb.posts(spark, sf)).select(report.post_text().alias("text"))
    return terms.term_counts(asked, "text", terms.REPORT_STOPWORDS)


# -- sinks -------------------------------------------------------------------


@query
def json_array_round_trip(spark, sf):
    """Posts written as JSON arrays and read back."""
    path = scratch_path(spark, "arrays")
    files.write_json_arrays(_extracted(spark, sf).drop("capture_ord", "pos"), path)
    back = single_community_posts(files.read_posts_json(spark, path, array=True))
    return back.select("id", "title", "channel", "view_count", "reaction_count", "month", "has_answer")


@query
def capture_array_files(spark, sf):
    """Captures written as JSON arrays, read back and listed by address."""
    path = scratch_path(spark, "capture-arrays")
    files.write_json_arrays(tb.captures(spark, sf).select("url", "data"), path)
    back = files.read_captures(spark, path, array=True)
    return capture.stage_counts(capture.conversations(back, ["url"]), "url")


@query
def lines_csv(spark, sf):
    """Texts that span lines, written as CSV and read back as posts."""
    path = scratch_path(spark, "lines")
    rows = tb.table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("channel"), F.col("text").alias("title"))
    for name in CHANNEL_POST_COLUMNS[3:]:
        rows = rows.withColumn(name, F.lit(None).cast("string"))
    files.write_csv(rows, path, CHANNEL_POST_COLUMNS)
    return files.read_posts_csv(spark, path, multiline=True).select("id", "channel", "title")


@query
def csv_round_trip(spark, sf):
    path = scratch_path(spark, "csv")
    files.write_csv(tb.table(spark, sf, "documents"), path, ["doc_id", "lang", "source", "text"])
    schema = "doc_id bigint, lang string, source string, text string"
    return spark.read.schema(schema).options(**files.CSV_OPTIONS).option("multiLine", True).csv(path)


@query
def json_round_trip(spark, sf):
    path = scratch_path(spark, "json")
    files.write_json(_extracted(spark, sf).drop("capture_ord", "pos"), path)
    back = single_community_posts(files.read_posts_json(spark, path))
    return back.select("id", "title", "channel", "view_count", "reaction_count", "month", "has_answer")


@query
def channel_csv(spark, sf):
    """The 15-column table written as CSV, read back and typed for the multi-channel report."""
    path = scratch_path(spark, "channel-csv")
    files.write_csv(_channel_extracted(spark, sf), path, CHANNEL_POST_COLUMNS)
    back = multi_channel_posts(files.read_posts_csv(spark, path))
    return back.select(
        "id", "channel", "title", "author", "type_label", "month", "view_count", "response_count",
        "has_responses", "last_responder", "short_title", "is_anonymous")


@query
def capture_files(spark, sf):
    """Captures written as files, read back and listed by address."""
    path = scratch_path(spark, "captures")
    files.write_json(tb.captures(spark, sf).select("url", "data"), path)
    back = files.read_captures(spark, path)
    return capture.stage_counts(capture.conversations(back, ["url"]), "url")


@query
def flat_csv_round_trip(spark, sf):
    path = scratch_path(spark, "flat")
    nested = _nested_orders(spark, sf)
    files.write_flat_csv(nested, path)
    schema = capture.flatten(nested).schema
    return spark.read.schema(schema).options(**files.CSV_OPTIONS).csv(path)


@query
def raw_round_trip(spark, sf):
    path = scratch_path(spark, "raw")
    rows = capture.conversations(tb.captures(spark, sf), ["channel_name", "capture_ord"])
    files.write_raw(rows, path)
    back = files.read_raw(spark, path)
    return back.select(
        "channel_name", "capture_ord", "pos",
        payloads.field(F.col("item"), "id", "bigint").alias("id"),
        payloads.field(F.col("item"), "channel.name").alias("channel"))


@query
def variant_round_trip(spark, sf):
    """The same with payloads kept as VARIANT, the fields of most records in columns of their own."""
    path = scratch_path(spark, "variants")
    files.write_variants(capture.conversations(tb.captures(spark, sf), ["channel_name", "capture_ord"]), path)
    return spark.read.parquet(path).select(
        "channel_name", "capture_ord", "pos",
        F.try_variant_get("item", "$.id", "bigint").alias("id"),
        F.try_variant_get("item", "$.channel.name", "string").alias("channel"))


@query
def damaged_captures(spark, sf):
    """Captures of which every fifth line is cut off: what is read of the others, and the damaged lines by name."""
    path = scratch_path(spark, "damaged")
    rows = tb.captures(spark, sf).where("capture_ord % 6 <> 4")
    line = F.to_json(F.struct("url", "data"))
    cut = F.when(F.col("capture_ord") % 5 == 0, F.substring(line, F.lit(1), F.floor(F.length(line) / 2).cast("int")))
    rows.select(F.coalesce(cut, line).alias("value")).write.text(path)
    good, bad = files.read_checked(spark, path, CAPTURE)
    items = capture.conversations(good, ["url"])
    counts = [
        items.agg(F.lit("items").alias("what"), F.count(F.lit(1)).alias("n")),
        good.select("url", F.schema_of_variant("data").alias("data")).agg(F.lit("captures").alias("what"), F.count("data").alias("n")),
        bad.agg(F.lit("damaged").alias("what"), F.count("record").alias("n")),
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def month_partitions(spark, sf):
    """Typed posts written by month, then read for the chosen months only."""
    path = scratch_path(spark, "posts")
    files.write_posts(having(tb.posts(spark, sf).select("id", "view_count", "month"), "month"), path)
    stored = spark.read.schema("id bigint, view_count bigint, month string").parquet(path)
    return PostFilter(months=CHOSEN.months).apply(stored)


# -- streams -----------------------------------------------------------------


def _events(spark, sf):
    path = f"{sf}/events.parquet"
    stream = jobs.table_stream(spark, path, spark.read.parquet(path).schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_ingest(spark, sf):
    """Captures written as files, read as a stream, extracted and typed on the way."""
    path = scratch_path(spark, "landing")
    tb.captures(spark, sf).select("url", "data").write.json(path)
    stream = jobs.capture_stream(spark, path)
    rows = capture.resources(capture.url_contains(stream, "mainLayout"), keep=["file"])
    posts = capture.project_posts(rows).select("id", "title", "channel", "view_count", "reaction_count")
    return jobs.run_append(posts, jobs.Place.new(spark, "ingested"))


@query
def stream_dedupe(spark, sf):
    """Every third event is delivered again an hour later; one copy of each stays."""
    columns = ("event_id", "user_id", "event_type", "value", "ts", "delivery")
    once = _events(spark, sf).withColumn("delivery", F.lit(1)).select(*columns)
    again = _events(spark, sf).where("event_id % 3 = 0").withColumn("delivery", F.lit(2)).withColumn(
        "ts", F.col("ts") + F.expr("INTERVAL 1 HOUR")).select(*columns)
    rows = jobs.dedupe(once.unionByName(again), "event_id", "ts", F.col("delivery"), "1 day")
    return jobs.run_append(rows, jobs.Place.new(spark, "deduped")).drop("ts", "delivery")


@query
def stream_first_copies(spark, sf):
    rows = jobs.first_copies(_events(spark, sf), "user_id", "event_id", ["event_type", "value"])
    return jobs.run_update(rows, ["user_id"], jobs.Place.new(spark, "first"))


@query
def stream_corrections(spark, sf):
    """Events that arrive in three loads, the earlier ones later: first event of each user, and how often it was corrected."""
    path, at = scratch_path(spark, "arriving"), jobs.Place.new(spark, "corrected")
    events = tb.table(spark, sf, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    for part in (2, 1, 0):
        events.where(F.col("event_id") % 3 == part).write.mode("append").parquet(path)
        arriving = spark.readStream.schema(events.schema).parquet(path)
        rows = corrections.first_with_corrections(
            arriving, "user_id", "event_id", "ts", F.col("event_id"), delay_ms=10**11, late="1000 days")
        with settings(spark, corrections.STORE):
            passed = jobs.run_append(rows, at)
    return passed.groupBy("user_id").agg(
        F.min("event_id").alias("event_id"), F.min_by("event_type", "event_id").alias("event_type"),
        F.count_if("correction").alias("corrections"))


@query
def stream_new_posts(spark, sf):
    rows = _events(spark, sf).select("user_id", "event_id", "event_type")
    return jobs.run_new_posts(rows, "user_id", ["event_id"], jobs.Place.new(spark, "new"), buckets=16)


@query
def stream_stored_posts(spark, sf):
    """First event of every user, loaded into a store in buckets."""
    rows = _events(spark, sf).select("user_id", "event_id", "event_type")
    store = PostStore.open(spark, scratch_path(spark, "store"), rows.schema, "user_id", buckets=16)
    return jobs.run_stored(rows, store, ["event_id"], jobs.Place.new(spark, "stored"))


@query
def stream_windows(spark, sf):
    """All windows, those still open at the end included."""
    rows = jobs.window_counts(_events(spark, sf), "ts", "event_type")
    out = jobs.run_update(rows, ["window_start", "event_type"], jobs.Place.new(spark, "windows"))
    return out.withColumn("window_start", naive("window_start"))


@query
def stream_late_rows(spark, sf):
    """Events in two loads: what the second brings behind the first one's time, and what was counted."""
    path, at = scratch_path(spark, "arriving"), jobs.Place.new(spark, "late")
    events = tb.table(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    for part in (0, 1):
        events.where(F.col("event_id") % 2 == part).write.mode("append").parquet(path)
        arriving = spark.readStream.schema(events.schema).parquet(path)
        split = late.run_windows(arriving, "ts", "event_type", at, delay="10 days")
    behind = split.late.groupBy("event_type").agg(F.count(F.lit(1)).alias("late"))
    return split.counts.groupBy("event_type").agg(F.sum("n").alias("kept")).join(behind, "event_type", "full").select(
        "event_type", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("late", F.lit(0)).alias("late"))


@query
def stream_months(spark, sf):
    rows = jobs.run_complete(
        jobs.month_counts(_events(spark, sf), "ts", "event_type"), jobs.Place.new(spark, "months"))
    return rows.withColumn("month_start", naive("month_start"))


@query
def stream_kpis(spark, sf):
    """Running figures; the sketched ones are shown as whether they are near the exact ones."""
    cents = _events(spark, sf).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    figures = jobs.running_figures(cents, "cents", "user_id", F.col("value") > 50, "event_type")
    running = jobs.run_complete(figures, jobs.Place.new(spark, "figures"))
    exact = tb.table(spark, sf, "events").groupBy("event_type").agg(
        F.count_distinct("user_id").alias("members"), F.median(F.round(F.col("value") * 100)).alias("median"))
    near = lambda about, true: F.abs(F.col(about) - F.col(true)) <= 0.1 * F.abs(F.col(true)) + 1
    return running.join(exact, "event_type").select(
        "event_type", "n", "total", F.round("mean", 6).alias("mean"), "answered",
        near("members_about", "members").alias("members_near"), near("median_about", "median").alias("median_near"))


@query
def stream_top_posts(spark, sf):
    rows = _events(spark, sf).select("event_id", "user_id", "value")
    return jobs.run_top(rows, 10, "value", "event_id", jobs.Place.new(spark, "top"))
