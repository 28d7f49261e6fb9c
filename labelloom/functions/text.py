"""Text expressions: stripping, response cleaning, label checks, token similarity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases after which a response holds its label, first listed wins.
RESPONSE_SEPARATORS = [
    "common category for these samples is:",
    "the common category for these samples is:",
    "common category:",
    "category:",
    "label:",
    "answer:",
    "response:",
]

# Words that never stand alone as a label.
FILLER_WORDS = [
    "the", "and", "or", "is", "are", "for", "of", "in", "on", "at", "by", "to", "from",
]

SPACE = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]"


def strip(c: Column) -> Column:
    """Remove all Unicode white space at both ends."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space become one space, ends are stripped."""
    return F.regexp_replace(strip(c), rf"{SPACE}+", " ")


def words(c: Column) -> Column:
    """White-space separated words without empty entries."""
    return F.filter(F.split(c, rf"{SPACE}+"), lambda w: w != "")


def clean_response(text: Column) -> Column:
    """Label part of a free-form response: at most three words, '' if nothing is left."""
    lowered = F.lower(text)
    after = F.coalesce(
        *[
            F.when(
                F.instr(lowered, s) > 0,
                F.substring(text, F.instr(lowered, s) + F.lit(len(s)), F.length(text)),
            )
            for s in RESPONSE_SEPARATORS
        ],
        text,
        F.lit(""),
    )
    first_line = strip(F.substring_index(F.regexp_replace(after, r"[*_`~]", ""), "\n", 1))
    unlisted = F.regexp_replace(first_line, rf"^\p{{Nd}}+[.)]{SPACE}*", "")
    unlisted = F.regexp_replace(unlisted, rf"^[-•]{SPACE}*", "")
    kept = F.regexp_replace(unlisted, r"[^\p{L}\p{N}_\s\p{Z}\x{1c}-\x{1f}\x{85}/-]", "")
    return F.array_join(F.slice(words(kept), 1, 3), " ")


def normalize_label(cleaned: Column) -> Column:
    """Lower-case label of at most 50 characters cut at a word border; NULL if empty."""
    low = squeeze(F.lower(cleaned))
    head = F.substring(low, 1, 50)
    short = F.when(F.length(low) > 50, F.regexp_replace(head, r" [^ ]*$", "")).otherwise(low)
    return F.when(F.length(short) > 0, short)


def validate_label(label: Column) -> Column:
    """Label of at most three words; a longer one gives its first telling word."""
    parts = words(label)
    telling = F.filter(
        parts, lambda w: (~F.lower(w).isin(FILLER_WORDS)) & (F.length(w) > 2)
    )
    picked = F.when(
        F.size(parts) > 3, F.coalesce(F.get(telling, F.lit(0)), F.get(parts, F.lit(0)))
    ).otherwise(label)
    return F.when(F.coalesce(F.length(label), F.lit(0)) == 0, F.lit("unlabeled")).otherwise(
        strip(picked)
    )


def label_similarity(a: Column, b: Column) -> Column:
    """1 for equal labels, otherwise the Jaccard similarity of their word sets."""
    la, lb = strip(F.lower(a)), strip(F.lower(b))
    wa, wb = F.array_distinct(words(la)), F.array_distinct(words(lb))
    union = F.size(F.array_union(wa, wb))
    return F.when((la == lb) | (union == 0), F.lit(1.0)).otherwise(
        F.size(F.array_intersect(wa, wb)) / union
    )


def count_substrings(text: Column, words_: list[str]) -> Column:
    """Sum of the non-overlapping occurrences of each word inside the text."""
    return reduce(
        lambda total, w: total
        + (F.length(text) - F.length(F.replace(text, F.lit(w), F.lit("")))) / F.lit(len(w)),
        words_,
        F.lit(0.0),
    ).cast("bigint")
