"""Review text: assembly, the keyword lexicon and its labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels a tag may hold, and the keyword patterns in the order they apply.
SENTIMENTS = ["positive", "neutral", "negative"]
COMPLAINT_TYPES = [
    "packaging", "scent", "skin_reaction", "texture", "ineffective", "price_value", "other", "none",
]
LEXICON = [
    ("skin_reaction", r"break ?out|broke (me )?out|irritat|red(ness)?\b|rash|burn|itch|allerg|bumps|sting"),
    ("packaging", r"pump|packag|bottle|tube|\bcap\b|leak|lid|dispenser|container|jar broke"),
    ("scent", r"smell|scent|fragrance|odor|perfume"),
    ("texture", r"greasy|sticky|pill|oily|thick|tacky|texture"),
    ("price_value", r"overpriced|expensive|price|not worth|tiny"),
    ("ineffective", r"did nothing|no difference|didn'?t (work|do)|no results|waste"),
]

# What an outside labeler takes per request item, and what its tag table used to hold.
REQUEST_CHARS = 1500
EVIDENCE_CHARS = 200


def shortened(text: Column, max_chars: int | None) -> Column:
    """The first ``max_chars`` characters, or all without a limit."""
    return text if max_chars is None else F.left(text, F.lit(max_chars))


def assemble_text(title: str, text: str, max_chars: int | None = None) -> Column:
    """``title. text``, whole unless a limit is asked for."""
    lead = F.coalesce(F.concat(F.col(title), F.lit(". ")), F.lit(""))
    return shortened(F.concat(lead, F.col(text)), max_chars)


def sentiment(rating: Column) -> Column:
    return F.when(rating >= 4, "positive").when(rating <= 2, "negative").otherwise("neutral")


def keyword_label(text: Column, rating: Column, lexicon: Sequence[tuple[str, str]] = LEXICON) -> Column:
    """``struct(complaint_type, evidence)`` from the first pattern that matches.

    High ratings are never complaints and skip the patterns. The flag makes word
    boundaries follow letters of any language, whatever the Java version.
    """
    lowered = F.lower(text)

    def label(kind: str, evidence: Column) -> Column:
        return F.struct(F.lit(kind).alias("complaint_type"), evidence.alias("evidence"))

    patterns = [(kind, f"(?U){pattern}") for kind, pattern in lexicon]
    hits = [F.when(lowered.rlike(p), label(kind, F.regexp_extract(lowered, p, 0))) for kind, p in patterns]
    empty = F.lit("")
    return F.when(rating >= 4, label("none", empty)).otherwise(
        F.coalesce(*hits, F.when(rating <= 2, label("other", empty)), label("none", empty))
    )
