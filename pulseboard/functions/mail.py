"""Mail headers, addresses and MIME bodies as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulseboard.functions.text import b64url_to_text

# Senders that never expect an answer (case-insensitive pattern).
NO_REPLY_SENDER = (
    r"(?i)noreply|no-reply|notifications@|alerts@|jira@|confluence@|"
    r"drive-shares|gemini-notes|calendar-notification|sfdc\.user"
)
# Subject phrases that never expect an answer (lower case).
NO_REPLY_SUBJECTS = (
    "invitation:", "updated invitation:", "canceled event",
    "icymi", "all hands", "outage", "survey", "shared with you",
)
# Fixed value: subject of a message without one.
NO_SUBJECT = "(no subject)"


def header(headers: Column, name: str) -> Column:
    """Value of the last header of that name, or NULL."""
    hits = F.filter(headers, lambda h: F.lower(h["name"]) == name)
    return F.try_element_at(hits, F.lit(-1))["value"]


def headers_to_map(headers: Column) -> Column:
    """Lower-cased header map where the last duplicate wins.

    Earlier duplicates are removed before the map is built, so the result does
    not depend on the session's map key policy.
    """
    entries = F.transform(
        headers, lambda h: F.struct(F.lower(h["name"]).alias("key"), h["value"].alias("value")))
    last_only = F.filter(entries, lambda e, i: ~F.exists(
        F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(last_only)


def _odd_quotes(text: Column) -> Column:
    return F.length(F.regexp_replace(text, '[^"]', "")) % 2 == 1


def address_of(text: Column) -> Column:
    """Address part of ``Name <addr>`` or of a bare address.

    A fragment with an unclosed quote (a quoted name cut at its comma) yields
    its first word, as a lenient address parser does.
    """
    torn = F.when(text.startswith('"'), F.regexp_extract(text, '^"([^"]*)', 1)).otherwise(
        F.regexp_extract(text, r'^([^\s"]*)', 1))
    bare = F.regexp_replace(text, r"\([^)]*\)", "")
    return (F.when(_odd_quotes(text), torn)
            .when(text.contains("<"), F.trim(F.regexp_extract(text, "<([^<>]*)>", 1)))
            .otherwise(F.trim(F.regexp_replace(bare, '"', ""))))


def display_name_of(text: Column) -> Column:
    """Display name of an address, or its comment, or the empty string."""
    before = F.regexp_extract(text, r"^\s*([^<]*?)\s*<", 1)
    comment = F.regexp_extract(text, r"\(([^)]*)\)\s*$", 1)
    return (F.when(_odd_quotes(text), F.lit(""))
            .when(text.contains("<"), F.regexp_replace(before, '^"|"$', ""))
            .otherwise(comment))


def sender_name(text: Column) -> Column:
    """Display name, falling back to the address."""
    return F.coalesce(F.nullif(display_name_of(text), F.lit("")), address_of(text))


def recipients(text: Column) -> Column:
    """Addresses of a comma-separated recipient header; blanks are dropped.

    The split is deliberately naive: a comma inside a quoted name splits too.
    """
    pieces = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda p: F.trim(p))
    return F.transform(F.filter(pieces, lambda p: p != ""), address_of)


def needs_response(sender: Column, subject: Column, own_address: str) -> Column:
    """True unless own mail, an automatic sender or an automatic subject."""
    address = F.coalesce(address_of(sender), F.lit(""))
    lowered = F.lower(F.coalesce(subject, F.lit("")))
    automatic = F.lower(address).contains(own_address.lower()) | address.rlike(NO_REPLY_SENDER)
    for phrase in NO_REPLY_SUBJECTS:
        automatic = automatic | lowered.contains(phrase)
    return ~automatic


# Levels of nested parts that the quick body search unfolds.
QUICK_DEPTH = 6


def _children(part: Column) -> Column:
    return F.try_variant_get(part, "$.parts", "array<variant>")


def _is_text(part: Column) -> Column:
    """A ``text/plain`` part with data."""
    return ((F.try_variant_get(part, "$.mimeType", "string") == "text/plain")
            & (F.try_variant_get(part, "$.body.data", "string") != ""))


def _text(part: Column) -> Column:
    return b64url_to_text(F.try_variant_get(part, "$.body.data", "string"))


def _has_children(part: Column) -> Column:
    return _children(part).isNotNull() & ~F.coalesce(_is_text(part), F.lit(False))


def _unfold(parts: Column, _level: Column) -> Column:
    """Replace every part that is no text but has parts of its own by those."""
    return F.when(F.exists(parts, _has_children), F.flatten(F.transform(
        parts, lambda p: F.when(_has_children(p), _children(p)).otherwise(F.array(p))))
    ).otherwise(parts)


def _search(payload: Column) -> Column:
    """First text of a tree of any depth: a work list and a place in it, one step per object.

    A leaf moves the place on; only a part with parts of its own makes a new list, of those
    and of what is behind it. So the cost is that of the parts, and not their square.
    """
    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.regexp_count(
        F.to_json(payload), F.lit(r"\{"))))
    start = F.struct(F.lit(None).cast("string").alias("found"), F.array(payload).alias("todo"),
                     F.lit(0).alias("at"))

    def visit(state: Column, _step: Column) -> Column:
        todo, at = state["todo"], state["at"]
        part = F.get(todo, at)
        inside = F.concat(_children(part), F.slice(todo, at + 2, F.size(todo)))
        return F.when(state["found"].isNotNull() | (at >= F.size(todo)), state).when(
            _has_children(part), F.struct(
                F.lit(None).cast("string").alias("found"), inside.alias("todo"),
                F.lit(0).alias("at"))).otherwise(F.struct(
                    F.when(_is_text(part), F.nullif(_text(part), F.lit(""))).alias("found"),
                    todo.alias("todo"), (at + 1).alias("at")))

    return F.aggregate(steps, start, visit, lambda s: s["found"])


def first_plain_text(payload: Column) -> Column:
    """Body text of the first ``text/plain`` part with data, depth first.

    ``payload`` is the MIME tree as a VARIANT. A text at the root is taken at
    once; otherwise the tree is unfolded in place, level by level, which keeps
    the depth-first order. Trees deeper than ``QUICK_DEPTH`` go to the slower
    search that has no depth limit. Without such a part the result is empty.
    """
    levels = F.sequence(F.lit(1), F.lit(QUICK_DEPTH))

    def finish(parts: Column) -> Column:
        texts = F.transform(F.filter(parts, _is_text), _text)
        return F.when(F.exists(parts, _has_children), _search(payload)).otherwise(
            F.get(F.filter(texts, lambda t: t != ""), F.lit(0)))

    return F.when(_is_text(payload), _text(payload)).otherwise(F.coalesce(
        F.aggregate(levels, F.array(payload), _unfold, finish), F.lit("")))


def has_attachment(payload: Column) -> Column:
    """Any top-level part that carries a file name."""
    parts = F.try_variant_get(payload, "$.parts", "array<variant>")
    named = F.exists(parts, lambda p: F.coalesce(
        F.try_variant_get(p, "$.filename", "string"), F.lit("")) != "")
    return F.coalesce(named, F.lit(False))
