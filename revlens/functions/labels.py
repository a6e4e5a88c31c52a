"""Weak-supervision rules and the observed-revert label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Comment patterns that mark an edit as suspicious. fixed values
RISKY_PATTERNS = (
    r"(?i)\brevert",
    r"(?i)\brvv\b",
    r"(?i)\brv\b",
    r"(?i)\bvandaliz",
    r"(?i)\bvandalism\b",
    r"(?i)\bvandal\b",
    r"(?i)\bspam\b",
    r"(?i)\bundo\b",
    r"(?i)\bundid\b",
    r"(?i)\btest edit",
    r"(?i)bot: reverting",
    r"(?i)\bcv\b",
    r"(?i)copyvio",
    r"(?i)off-?topic",
    r"(?i)not notable",
)


def _one_pass(patterns: tuple[str, ...]) -> str:
    """The alternation of all patterns, regrouped.

    Tested one by one, every pattern is tried at every character. Grouped by their common word
    boundary behind a test of the first letter, most characters fail on that test alone.
    """
    bare = [p.removeprefix("(?i)") for p in patterns]
    words = [p.removeprefix(r"\b") for p in bare if p.startswith(r"\b")]
    inner = [p for p in bare if not p.startswith(r"\b")]
    first = "".join(sorted({p[0] for p in words + inner}))
    return rf"(?i)(?=[{first}])(?:\b(?:{'|'.join(words)})|{'|'.join(inner)})"


RISKY_REGEX = _one_pass(RISKY_PATTERNS)

LARGE_REMOVAL = -500.0
LARGE_CHANGE = 1000.0


def risky_comment(comment: Column) -> Column:
    return comment.rlike(RISKY_REGEX)


def blank_comment(comment: Column) -> Column:
    """Blank in the labeller's sense: NULL, or nothing but spaces."""
    return comment.isNull() | (F.trim(comment) == "")


def label_from_signals(
    risky: Column, blank: Column, anon: Column, delta: Column, null_as_zero: bool = True
) -> Column:
    """Weak label from row-local comment signals.

    Taking the signals instead of the comment lets callers drop long texts before a shuffle that
    computes ``delta``. ``null_as_zero=False`` keeps the three-valued result.
    """
    label = (
        risky
        | (delta < LARGE_REMOVAL)
        | (anon & (F.abs(delta) > LARGE_CHANGE))
        | (anon & blank)
    ).cast("int")
    return F.coalesce(label, F.lit(0)) if null_as_zero else label


def weak_label(comment: Column, anon: Column, delta: Column, null_as_zero: bool = True) -> Column:
    return label_from_signals(
        risky_comment(comment), blank_comment(comment), anon.cast("boolean"), delta, null_as_zero
    )


def reverted_label(flag: Column) -> Column:
    """'true' -> 1, other text -> 0, NULL -> NULL."""
    return (flag == "true").cast("int")
