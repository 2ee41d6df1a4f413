"""Match free text, labels and names to accounts.

A dictionary is an ordered sequence of ``(account, keywords)``, or a table of
``(ord, account, keyword)``; the first entry with a keyword contained in the
text wins, ignoring case.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Dictionary = Sequence[tuple[str, Sequence[str]]]
Labels = Mapping[str, str] | DataFrame  # label to account, or a table (ord, label, account)


def match_keywords(text: Column, dictionary: Dictionary, word_boundary: bool = False) -> Column:
    """Account of the first dictionary entry that hits, else NULL.

    A row-level expression: no join, no shuffle. Substrings inside words count
    unless ``word_boundary`` is set.
    """
    lowered = F.lower(text)
    expr = F.lit(None).cast("string")
    for account, words in reversed(list(dictionary)):
        hit = F.lit(False)
        for word in words:
            if word_boundary:
                hit = hit | lowered.rlike(rf"(?<!\w){re.escape(word.lower())}(?!\w)")
            else:
                hit = hit | lowered.contains(word.lower())
        expr = F.when(hit, F.lit(account)).otherwise(expr)
    return expr


def match_alias(name: Column, dictionary: Dictionary) -> Column:
    """Like :func:`match_keywords`, but an unmatched name keeps itself."""
    return F.coalesce(match_keywords(name, dictionary), name)


def match_attendee_domain(addresses: Column, dictionary: Dictionary) -> Column:
    """Account of the first address whose domain hits, else NULL."""
    from pulseboard.functions.meetings import domain_of

    matched = F.transform(addresses, lambda a: match_keywords(domain_of(a), dictionary))
    return F.get(F.filter(matched, lambda m: m.isNotNull()), F.lit(0))


def label_hits(labels: Column, accounts: Mapping[str, str]) -> Column:
    """array<struct<ord,account>> of the labels the mapping knows."""
    known = F.create_map(*[
        F.lit(v) if i % 2 == 0 else v
        for ord_, (label, account) in enumerate(accounts.items())
        for i, v in enumerate((label, F.struct(F.lit(ord_).alias("ord"),
                                               F.lit(account).alias("account"))))])
    return F.filter(F.transform(labels, lambda label: F.try_element_at(known, label)),
                    lambda hit: hit.isNotNull())


def match_labels(labels: Column, accounts: Mapping[str, str]) -> Column:
    """Account of the label that comes first in the mapping, else NULL.

    The smallest ``ord`` of a row's own label array: no explode, no join.
    """
    return F.array_min(label_hits(labels, accounts))["account"]


STEP = 4  # characters to the first level of the trie; each further one is twice as deep


def _levels(longest: int) -> list[int]:
    """Depths of the trie: 4, 8, 16 and so on, as long as a keyword reaches them."""
    depths = [STEP]
    while depths[-1] <= longest:
        depths.append(depths[-1] * 2)
    return depths[:-1]


def _windows(texts: DataFrame, key: str, text: str, reach: int) -> DataFrame:
    """(key, window, lead, own): texts cut into windows, so that finding the characters at a
    position never scans a long text. A window has ``own`` positions of its own, behind the
    ``lead`` characters before them, and goes on ``reach`` characters further."""
    size = max(64, reach)
    parts = F.regexp_extract_all(F.lower(F.col(text)), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))

    def window(i: Column) -> Column:
        def part(k: int) -> Column:
            return F.coalesce(F.get("_parts", i + k), F.lit(""))
        return F.struct(
            F.concat(F.right(part(-1), F.lit(1)), part(0), F.left(part(1), F.lit(reach))).alias(
                "window"),
            F.when(i > 0, 1).otherwise(0).alias("lead"), F.length(part(0)).alias("own"))

    cut = texts.select(key, parts.alias("_parts")).where(F.size("_parts") > 0)
    return cut.select(key, F.explode(F.transform(
        F.sequence(F.lit(0), F.size("_parts") - 1), window)).alias("_w")).select(
        key, "_w.window", "_w.lead", "_w.own")


def _first_hits(texts: DataFrame, key: str, text: str, dictionary: DataFrame,
                word_boundary: bool = False) -> DataFrame:
    """(key, account) of the texts that hold a keyword; ``key`` is unique in ``texts``."""
    words = dictionary.select(
        "ord", "account", F.lower("keyword").alias("_word")).where(F.length("_word") > 0)
    # at most as many numbers as the longest keyword has characters
    lengths = sorted(r[0] for r in words.select(F.length("_word")).distinct().collect())
    if not lengths:
        return texts.select(key, F.lit(None).cast("string").alias("account")).where("false")
    levels = _levels(lengths[-1])
    rows = _windows(texts, key, text, lengths[-1] + 1).select(
        key, "window", F.explode(F.sequence(F.col("lead") + 1, F.col("lead") + F.col("own"))).alias(
            "at"))

    def letters(n: int | Column) -> Column:
        return F.substr("window", F.col("at"), F.lit(n) if isinstance(n, int) else n)

    short = [n for n in lengths if n < STEP]
    tried = [F.array(*[F.lit(n) for n in short]).cast("array<int>")]
    for depth, deeper in zip(levels, [*levels[1:], lengths[-1] + 1]):
        node = f"_node{depth}"
        nodes = words.where(F.length("_word") >= depth).select(
            F.left("_word", F.lit(depth)).alias(node)).distinct()
        # without shorter keywords, a position that leaves the trie at once is gone
        gone = depth == STEP and not short
        rows = rows.join(nodes, letters(depth) == F.col(node), "inner" if gone else "left")
        tried.append(F.when(F.col(node).isNotNull(), F.array(*[
            F.lit(n) for n in lengths if depth <= n < deeper]).cast("array<int>")))
    none = F.array().cast("array<int>")
    rows = rows.select(key, "window", "at", F.explode(F.flatten(F.array(
        *[F.coalesce(t, none) for t in tried]))).alias("n"))
    if word_boundary:
        before = F.when(F.col("at") > 1, F.substr("window", F.col("at") - 1, F.lit(1)))
        after = F.substr("window", F.col("at") + F.col("n"), F.lit(1))
        rows = rows.where(~F.coalesce(before, F.lit("")).rlike(r"\w") & ~after.rlike(r"\w"))
    return (rows.select(key, letters(F.col("n")).alias("_word")).join(words, "_word")
            .groupBy(key).agg(F.min(F.struct("ord", "account")).alias("_best"))
            .select(key, F.col("_best.account").alias("account")))


def match_keywords_join(texts: DataFrame, key: str, text: str, dictionary: DataFrame,
                        word_boundary: bool = False) -> DataFrame:
    """First-match lookup against a dictionary *table* ``(ord, account, keyword)``.

    A plain "contains" join has no equality, so it would compare every text with every
    keyword. Here the keywords are a trie whose nodes are prefixes of 4, 8, 16 and so on
    characters: every position of a text walks down it, one equality join a level, and as far
    as it comes, it meets the keywords of these lengths by equality. So keywords that share a
    beginning cost a position no more than one, and nothing has to be verified.

    Whether a level is broadcast is Spark's own size check; where it is, positions never
    leave their task. Substrings inside words count unless ``word_boundary`` is set. The best
    match of a text is found by partial aggregation.

    Returns ``texts`` plus ``account`` (NULL when nothing matches); ``key``
    must be unique in ``texts``.
    """
    return texts.join(_first_hits(texts, key, text, dictionary, word_boundary), key, "left")


def with_account(df: DataFrame, text: Column, dictionary: Dictionary | DataFrame,
                 account: str = "account_name", word_boundary: bool = False) -> DataFrame:
    """Adds the account that ``text`` names, NULL if none does.

    An inline dictionary is a row-level expression. With a table, each distinct
    text is matched once, under its digest, and rows fetch the result by it, so
    rows need no key of their own.
    """
    if not isinstance(dictionary, DataFrame):
        return df.withColumn(account, match_keywords(text, dictionary, word_boundary))
    keyed = df.withColumn("_digest", F.sha2(text, 256))
    texts = (df.select(F.sha2(text, 256).alias("_digest"), text.alias("_named"))
             .where(F.col("_named") != "").dropDuplicates(["_digest"]))
    hits = _first_hits(texts, "_digest", "_named", dictionary, word_boundary).select(
        "_digest", F.col("account").alias(account))
    return keyed.join(hits, "_digest", "left").drop("_digest")


def with_attendee_account(df: DataFrame, addresses: Column, dictionary: Dictionary | DataFrame,
                          account: str = "account_name") -> DataFrame:
    """Adds the account of the first address whose domain hits, NULL if none does."""
    from pulseboard.functions.meetings import domain_of

    if not isinstance(dictionary, DataFrame):
        return df.withColumn(account, match_attendee_domain(addresses, dictionary))
    domains = F.transform(addresses, domain_of)
    digest = F.sha2(F.to_json(domains), 256)
    lists = (df.select(digest.alias("_guests"), domains.alias("_domains"))
             .where(F.size("_domains") > 0).dropDuplicates(["_guests"])
             .select("_guests", F.posexplode("_domains").alias("_place", "_domain")))
    hits = (with_account(lists, F.col("_domain"), dictionary, account)
            .where(F.col(account).isNotNull())
            .groupBy("_guests").agg(F.min_by(account, "_place").alias(account)))
    return df.withColumn("_guests", digest).join(hits, "_guests", "left").drop("_guests")


def explode_labels(df: DataFrame, labels: str, accounts: Labels, *columns: str) -> DataFrame:
    """``columns`` of each row once per label that is known, with ``_hit``: struct<ord,account>.

    A table of labels meets the rows' labels in an equality join.
    """
    if not isinstance(accounts, DataFrame):
        return df.select(*columns, F.explode(label_hits(F.col(labels), accounts)).alias("_hit"))
    known = accounts.select(F.col("label").alias("_label"),
                            F.struct("ord", "account").alias("_hit"))
    return (df.select(*columns, F.explode(labels).alias("_label"))
            .join(known, "_label").drop("_label"))
