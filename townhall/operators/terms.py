"""Term statistics: the counts behind a word cloud, as one distributed job.

Texts are never joined into one: words and word pairs are counted per row and
the counts are added up, so a pair never spans two rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# The stop words of the multi-channel report.
REPORT_STOPWORDS = (
    "the a an and or in of to is it for i this that "
    "my me we be with are on have has was but from as "
    "so if by at not they their them its our you your "
    "http https www com just can do all any also would "
    "could should will been than then when where how what "
    "which who there here one get got use using used "
    "am im hi hey thanks thank anyone ll ve re"
).split()

# The usual English stop words of word clouds.
ENGLISH_STOPWORDS = (
    "a about above after again against all also am an and any are aren't as at be because been before "
    "being below between both but by can can't cannot com could couldn't did didn't do does doesn't doing "
    "don't down during each else ever few for from further get had hadn't has hasn't have haven't having "
    "he he'd he'll he's hence her here here's hers herself him himself his how how's however http i i'd "
    "i'll i'm i've if in into is isn't it it's its itself just k let's like me more most mustn't my myself "
    "no nor not of off on once only or other otherwise ought our ours ourselves out over own r same shall "
    "shan't she she'd she'll she's should shouldn't since so some such than that that's the their theirs "
    "them themselves then there there's therefore these they they'd they'll they're they've this those "
    "through to too under until up very was wasn't we we'd we'll we're we've were weren't what what's when "
    "when's where where's which while who who's whom why why's with won't would wouldn't www you you'd "
    "you'll you're you've your yours yourself yourselves"
).split()

# List lengths and the score a pair must pass.
REPORT_TERMS, OVERVIEW_TERMS = 80, 60
COLLOCATION_SCORE = 30

# Words whose counts are sent to the pairs; with at most so many characters each, that is some MB.
FREQUENT, FREQUENT_LENGTH = 1 << 15, 64

_W = r"\p{L}\p{N}_"
# A word starts with a word character and runs on over apostrophes; a closing 's is
# left out, and words of digits only are passed over.
_DIGITS = r"\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨⑴-⑼⒈-⒐"
_WORD = (
    rf"(?<![{_W}])(?<![{_W}]')(?![{_DIGITS}]+(?:'[sS])?(?![{_W}']))"
    rf"([{_W}][{_W}']*?)(?:'[sS])?(?![{_W}'])"
)


def words(text: Column) -> Column:
    """Words of a text in order, as an array."""
    return F.regexp_extract_all(text, F.lit(_WORD), F.lit(1))


def _is_stopword(word: Column, stopwords) -> Column:
    return F.lower(word).isin([w.lower() for w in stopwords]) if stopwords else F.lit(False)


def _forms(df: DataFrame, text: str, stopwords=(), singles: bool = True, pairs: bool = True) -> DataFrame:
    """Words and neighbouring pairs (with a space) without stop words, one row for each time they occur."""
    w, v = F.col("p.w"), F.col("p.v")
    forms = []
    if singles:
        forms.append(F.when(~_is_stopword(w, stopwords), w))
    if pairs:
        usable = v.isNotNull() & ~_is_stopword(w, stopwords) & ~_is_stopword(v, stopwords)
        forms.append(F.when(usable, F.concat_ws(" ", w, v)))
    shifted = F.slice("w", F.lit(2), F.size("w")).alias("v")
    return (
        df.select(words(F.col(text)).alias("w"))
        .select(F.explode(F.arrays_zip("w", shifted)).alias("p"))
        .select(F.explode(F.array(*forms)).alias("form"))
        .where(F.col("form").isNotNull())
    )


def form_counts(df: DataFrame, text: str, stopwords=(), singles: bool = True, pairs: bool = True) -> DataFrame:
    """Words (and neighbouring pairs, with a space) without stop words -> form, n.

    One pass over the texts serves both. Counts are pre-added in every map task,
    so a frequent word is one row per task.
    """
    return _forms(df, text, stopwords, singles, pairs).groupBy("form").agg(F.count(F.lit(1)).alias("n"))


def unigrams(df: DataFrame, text: str, stopwords=()) -> DataFrame:
    return form_counts(df, text, stopwords, pairs=False)


def bigrams(df: DataFrame, text: str, stopwords=()) -> DataFrame:
    return form_counts(df, text, stopwords, singles=False)


def fold(counts: DataFrame, merge_plurals: bool = True) -> DataFrame:
    """Spellings -> one row per term: its most frequent spelling and total count.

    A plural (s, not ss) is added to its singular when that occurs too. ``keys``
    lists the lower-case forms a term stands for (one or two). A word and its
    plural meet in one small group, so no self-join is needed.
    """
    counts = counts.select(F.lower("form").alias("key"), "form", "n")
    key = F.col("key")
    if merge_plurals:
        plural = key.endswith("s") & ~key.endswith("ss") & (F.length(key) > 1)
        stem = F.when(plural, F.substr(key, F.lit(1), F.length(key) - 1)).otherwise(key)
        grouped = counts.withColumn("_stem", stem)
        has_singular = F.max(key == F.col("_stem")).over(Window.partitionBy("_stem"))
        grouped = grouped.withColumn("_merged", has_singular & (key != F.col("_stem")))
        form = F.when(F.col("_merged"), F.substr("form", F.lit(1), F.length("form") - 1)).otherwise(F.col("form"))
        term = F.when(F.col("_merged"), F.col("_stem")).otherwise(key)
        grouped = grouped.select("_stem", term.alias("term_key"), form.alias("form"), "_merged", "n")
    else:
        grouped = counts.select(
            key.alias("_stem"), key.alias("term_key"), "form", F.lit(False).alias("_merged"), "n")
    # the same spelling can now come from the singular and the plural
    spelled = grouped.groupBy("_stem", "term_key", "form").agg(
        F.sum("n").alias("n"), F.max("_merged").alias("_merged"))
    term_key = F.col("term_key")
    return (
        spelled.groupBy("_stem", "term_key")
        .agg(
            F.min_by("form", F.struct(-F.col("n"), "form")).alias("term"),
            F.sum("n").alias("n"),
            F.max("_merged").alias("_merged"),
        )
        .select(
            "term_key", "term", "n",
            F.when(F.col("_merged"), F.array(term_key, F.concat(term_key, F.lit("s"))))
            .otherwise(F.array(term_key)).alias("keys"),
        )
    )


def term_counts(df: DataFrame, text: str, stopwords=(), merge_plurals: bool = True) -> DataFrame:
    return fold(unigrams(df, text, stopwords), merge_plurals).select("term", "n")


def bigram_counts(df: DataFrame, text: str, stopwords=(), merge_plurals: bool = True) -> DataFrame:
    return fold(bigrams(df, text, stopwords), merge_plurals).select("term", "n")


# -- collocations ------------------------------------------------------------


def _log_likelihood(k: Column, n: Column, x: Column) -> Column:
    tiny = F.lit(1e-10)
    return F.log(F.greatest(x, tiny)) * k + F.log(F.greatest(1 - x, tiny)) * (n - k)


def collocation_score(both: Column, first: Column, second: Column, total: Column) -> Column:
    """Dunning's likelihood ratio of a pair against its words; 0 when one word is all there is."""
    p, p1 = second / total, both / first
    p2 = (second - both) / (total - first)
    score = -2 * (
        _log_likelihood(both, first, p)
        + _log_likelihood(second - both, total - first, p)
        - _log_likelihood(both, first, p1)
        - _log_likelihood(second - both, total - first, p2)
    )
    return F.when((total <= first) | (total <= second), F.lit(0.0)).otherwise(score)


def _with_word(pairs: DataFrame, lookup: DataFrame, key: str, name: str) -> DataFrame:
    """Add a word's term and count to the pairs it occurs in.

    Both sides are shuffled for this join alone, so the pairs of a frequent word are split
    over several tasks by their size when the job runs.
    """
    found = lookup.select(F.col("form").alias(key), F.col("term").alias(f"term_{name}"), F.col("n").alias(f"n_{name}"))
    return pairs.join(found, key, "left")


def _vocabulary(df: DataFrame, text: str, stopwords) -> tuple[DataFrame, DataFrame]:
    """(words, pairs), folded. Both come from one shuffled table of counts: the texts are read once."""
    # words and pairs are folded apart, as the words have several uses. What tells them apart is an aggregate: a
    # filter on the form itself would move below the counting and read the texts for each of the two
    counts = _forms(df, text, stopwords).groupBy("form").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("form").contains(" ")).alias("pair"))
    first, second = (F.split_part("term_key", F.lit(" "), F.lit(i)) for i in (1, 2))
    pairs = fold(counts.where("pair")).select(
        F.col("term").alias("bigram"), F.col("n").alias("n_bigram"), first.alias("key_1"), second.alias("key_2"))
    return fold(counts.where("not pair")), pairs


def _score(singles: DataFrame, pairs: DataFrame) -> DataFrame:
    lookup = singles.select(F.explode("keys").alias("form"), "term", "n")
    # the total is a column from below the joins: named in the score itself, its query would be planned once for each time
    pairs = pairs.withColumn("total", singles.agg(F.sum("n").alias("t")).scalar())
    pairs = _with_word(pairs, lookup, "key_1", "1")
    pairs = _with_word(pairs, lookup, "key_2", "2")
    return pairs.select(
        "bigram", "n_bigram", "term_1", "n_1", "term_2", "n_2",
        collocation_score(F.col("n_bigram"), F.col("n_1"), F.col("n_2"), F.col("total")).alias("score"),
    )


def score_bound(both: Column, first: tuple[Column, Column], second: tuple[Column, Column], total: Column) -> Column:
    """No less than the score of a pair whose words occur as often as these ranges say.

    The score falls as long as a word's count is below what would make the pair a matter of chance, and rises
    from there on, for each word whatever the other's count is: within two ranges it is largest in a corner. A sum of
    logarithms of this size is exact but for a share of the total, which is added.
    """
    return F.greatest(*[_at_most(both, a, b, total) for a in first for b in second])


def _at_most(both: Column, first: Column, second: Column, total: Column) -> Column:
    return collocation_score(both, first, second, total) + 1e-6 + total * 1e-12


def _known(lookup: DataFrame, frequent: int = FREQUENT) -> tuple[DataFrame, Column]:
    """The most frequent forms that are not very long, with their terms and counts, and the least of these counts."""
    short = lookup.where(F.length("form") <= FREQUENT_LENGTH)
    head = short.orderBy(F.desc("n"), F.asc("form")).limit(frequent)
    return head, head.agg(F.coalesce(F.min("n"), F.lit(0)).alias("n")).scalar()


def _with_known(pairs: DataFrame, head: DataFrame, key: str, name: str) -> DataFrame:
    found = head.select(F.col("form").alias(key), F.col("term").alias(f"term_{name}"), F.col("n").alias(f"n_{name}"))
    return pairs.join(F.broadcast(found), key, "left")


def worth_scoring(singles: DataFrame, pairs: DataFrame, threshold: float, frequent: int = FREQUENT) -> DataFrame:
    """The pairs that may pass the threshold; none that passes goes.

    Of two frequent words the score is known at once. A word that is not among the ``frequent`` ones occurs at most as
    often as the last of these, and at least as often as the pair: that bounds the score, so most pairs go
    before any join moves them.
    """
    head, most = _known(singles.select(F.explode("keys").alias("form"), "term", "n"), frequent)
    given = pairs.withColumns({"most": most, "total": singles.agg(F.sum("n").alias("t")).scalar()})
    known = _with_known(_with_known(given, head, "key_1", "1"), head, "key_2", "2")
    both = F.col("n_bigram")

    def within(n: str) -> tuple[Column, Column]:
        return F.coalesce(F.col(n), both), F.coalesce(F.col(n), F.greatest("most", both))

    columns = ("bigram", "n_bigram", "key_1", "key_2")
    unbounded = (F.length("key_1") > FREQUENT_LENGTH) | (F.length("key_2") > FREQUENT_LENGTH)
    # ``score_bound`` with a row for each corner, of which known words have one: four scores in one condition are more
    # code than the JVM compiles, and take four times as long
    corners = F.array_distinct(F.array(*[
        F.struct(a.alias("first"), b.alias("second")) for a in within("n_1") for b in within("n_2")]))
    each = known.select(*columns, "total", unbounded.alias("unbounded"), F.explode(corners).alias("at"))
    bound = _at_most(both, F.col("at.first"), F.col("at.second"), F.col("total"))
    return each.where(F.col("unbounded") | (bound > threshold)).select(*columns).distinct()


def scored_bigrams(df: DataFrame, text: str, stopwords=()) -> DataFrame:
    """Every pair with the counts of its words and its collocation score."""
    return _score(*_vocabulary(df, text, stopwords))


def collocations(df: DataFrame, text: str, stopwords=(), threshold: float = COLLOCATION_SCORE) -> DataFrame:
    return scored_bigrams(df, text, stopwords).where(F.col("score") > threshold)


def pruned_collocations(df: DataFrame, text: str, stopwords=(), threshold: float = COLLOCATION_SCORE) -> DataFrame:
    """The same as ``collocations``, for vocabularies whose pairs are too many to be moved for each of their words.

    It counts and folds the words once more, to know the frequent ones before the joins; ``collocations`` does without
    that and moves every pair twice.
    """
    singles, pairs = _vocabulary(df, text, stopwords)
    return _score(singles, worth_scoring(singles, pairs, threshold)).where(F.col("score") > threshold)


def cloud_counts(df: DataFrame, text: str, stopwords=(), threshold: float = COLLOCATION_SCORE) -> DataFrame:
    """Words and collocations together; a pair's count is taken off both of its words."""
    singles, pairs = _vocabulary(df, text, stopwords)
    kept = _score(singles, pairs).where(F.col("score") > threshold)
    changes = kept.select(
        F.explode(
            F.array(
                F.struct(F.col("term_1").alias("term"), (-F.col("n_bigram")).alias("n")),
                F.struct(F.col("term_2").alias("term"), (-F.col("n_bigram")).alias("n")),
                F.struct(F.col("bigram").alias("term"), F.col("n_bigram").alias("n")),
            )
        ).alias("t")
    ).select("t.*")
    return (
        singles.select("term", "n")
        .unionByName(changes)
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > 0)
    )


def most_frequent(counts: DataFrame, k: int) -> DataFrame:
    """The k most frequent terms with their frequency relative to the first."""
    head = counts.orderBy(F.desc("n"), F.asc("term")).limit(k)
    return head.withColumn("frequency", F.col("n") / F.max("n").over(Window.partitionBy()))
