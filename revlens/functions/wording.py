"""Texts shown to people: explanations, prompts, alerts, links. Sentences are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from revlens.functions.numbers import percent, signed
from revlens.functions.text import is_blank, missing

WIKI_BASE = "https://en.wikipedia.org/wiki/"

EXPLAINED_BY = "rule-based-fallback"

# substrings, so "rv" also matches inside "service"
EXPLAIN_WORDS = ("revert", "undo", "vandal", "spam", "rv", "copyvio")

REASON_KEYWORDS = "the edit comment contains keywords associated with reverts or vandalism"
REASON_REMOVED = "a large amount of content was removed ({} bytes deleted)"
REASON_ANON_REMOVED = "an anonymous user removed content without explanation"
REASON_ANON_LARGE = "an anonymous user made a large content change"
REASON_ANON_BLANK = "the anonymous editor provided no edit summary"
REASON_HIGH_SCORE = (
    "multiple statistical features (edit size, user type, comment) "
    "combined to produce a high risk score"
)
REASON_GENERIC = "the combination of edit characteristics slightly elevated the risk score"
EXPLANATION = (
    "This edit was flagged as **{}** risk because {}. "
    "The automated classifier assigned a risk score of {} based on "
    "TF-IDF analysis of the edit comment and numerical features including "
    "content size change and user anonymity."
)
PROMPT = """Wikipedia edit details:
- Article: "{}"
- Risk label: {} (score: {})
- Edit size: {}
- Made by: {}
- Edit comment: "{}"

Explain why this edit was flagged as {} risk in 2-3 sentences."""
ALERT_SUBJECT = "{} {} alert: {}"
ALERT_BODY = """{} flagged an edit on {} as {} risk (score {}).

Size change: {} bytes
Edit summary: {}
Diff/page: {}"""


def _fill(template: str, *values: Column) -> Column:
    pieces = template.split("{}")
    parts = [F.lit(pieces[0])]
    for value, piece in zip(values, pieces[1:], strict=True):
        parts += [value, F.lit(piece)]
    return F.concat(*parts)


def _whole(delta: Column) -> Column:
    return F.coalesce(delta, F.lit(0.0)).cast("bigint")


def _flag(anon: Column) -> Column:
    return F.coalesce(anon.cast("boolean"), F.lit(False))


def explanation(
    comment: Column,
    delta: Column,
    anon: Column,
    score: Column,
    label: Column,
    null_label: str = "None",
) -> Column:
    """Up to two reasons, in rule order, in one sentence with band and score."""
    anon = _flag(anon)
    lower = F.lower(F.coalesce(comment, F.lit("")))
    size = F.coalesce(delta.cast("double"), F.lit(0.0))
    score = F.coalesce(score.cast("double"), F.lit(0.0))

    keyword = F.lit(False)
    for word in EXPLAIN_WORDS:
        keyword = keyword | lower.contains(word)
    reasons = F.filter(
        F.array(
            F.when(keyword, REASON_KEYWORDS),
            F.when(size < -500, _fill(REASON_REMOVED, F.abs(_whole(size)).cast("string"))).when(
                (size < 0) & anon, REASON_ANON_REMOVED
            ),
            F.when(anon & (F.abs(size) > 1000), REASON_ANON_LARGE),
            F.when(anon & is_blank(lower), REASON_ANON_BLANK),
        ),
        lambda reason: reason.isNotNull(),
    )
    fallback = F.when(score >= 0.7, REASON_HIGH_SCORE).otherwise(REASON_GENERIC)
    because = F.when(F.size(reasons) == 0, fallback).otherwise(
        F.array_join(F.slice(reasons, 1, 2), "; ")
    )
    return _fill(EXPLANATION, F.coalesce(label, F.lit(null_label)), because, percent(score))


def explain_prompt(
    title: Column,
    comment: Column,
    delta: Column,
    anon: Column,
    score: Column,
    label: Column,
    null_label: str = "None",
) -> Column:
    """Text handed to a language model; the call itself is outside this library."""
    size = _whole(delta)
    label = F.coalesce(label, F.lit(null_label))
    size_text = F.when(size >= 0, _fill("added {} bytes", signed(size))).otherwise(
        _fill("removed {} bytes", F.abs(size).cast("string"))
    )
    comment = F.when(missing(comment), "(no comment)").otherwise(comment)
    return _fill(
        PROMPT,
        F.coalesce(title, F.lit("Unknown Article")),
        label,
        F.coalesce(percent(score), F.lit("unknown")),
        size_text,
        F.when(_flag(anon), "an anonymous (IP) user").otherwise("a registered user"),
        F.substring(comment, 1, 200),
        label,
    )


def page_url(title: Column, base: str = WIKI_BASE) -> Column:
    return F.concat(F.lit(base), F.translate(title, " ", "_"))


def diff_url(rev_id: Column, title: Column, base: str = WIKI_BASE, no_title: str = "Wikipedia") -> Column:
    """Link to the difference view, or to the page where the revision is unknown."""
    rev_id = F.trim(F.coalesce(rev_id, F.lit("")))
    title = F.when(missing(title), no_title).otherwise(title)
    return F.when(rev_id != "", F.concat(F.lit(f"{base}Special:Diff/"), rev_id)).otherwise(
        page_url(title, base)
    )


def alert_subject(title: Column, label: Column, sender: str = "Edit risk") -> Column:
    return _fill(
        ALERT_SUBJECT,
        F.lit(sender),
        F.when(missing(label), "UNKNOWN").otherwise(label),
        F.when(missing(title), "Unknown page").otherwise(title),
    )


def alert_body(
    rev_id: Column,
    title: Column,
    comment: Column,
    delta: Column,
    score: Column,
    label: Column,
    sender: str = "Edit risk",
    base: str = WIKI_BASE,
) -> Column:
    title = F.when(missing(title), "Unknown page").otherwise(title)
    comment = F.when(missing(comment), "(no edit summary)").otherwise(comment)
    return _fill(
        ALERT_BODY,
        F.lit(sender),
        title,
        F.when(missing(label), "UNKNOWN").otherwise(label),
        F.coalesce(percent(score), F.lit("not scored")),
        signed(_whole(delta)),
        F.substring(comment, 1, 500),
        diff_url(rev_id, title, base),
    )
