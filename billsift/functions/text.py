"""Text helpers: stripping, lines and first matches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billsift.functions import labels

HIGH, LOW, MISSING = "HIGH", "LOW", "MISSING"

# Every character that counts as white space, not just the blank that trim() removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def has_text(text: Column) -> Column:
    """True if anything but white space is there; stops at the first such character."""
    return F.coalesce(text.rlike(f"(?U)[^{labels.BLANK[1:-1]}]"), F.lit(False))


def bind(value: Column, build) -> Column:
    """``build(value)`` with ``value`` worked out once, however often it is used.

    A NULL value gives NULL.
    """
    return F.element_at(F.transform(F.array(value), lambda v: F.when(v.isNotNull(), build(v))), 1)


def fold(text: Column) -> Column:
    """Lower-case text in which a part of a label can be looked for.

    A case-insensitive regex takes four letters beyond ASCII for i, s or k;
    here they are those letters, so a label missing here cannot match there. ASCII
    texts have none of them and are not searched for them.
    """
    lower = folded = F.lower(text)
    for letter, plain in (("i\u0307", "i"), ("\u0131", "i"), ("\u017f", "s"), ("\u212a", "k")):
        folded = F.replace(folded, F.lit(letter), F.lit(plain))
    return F.when(F.octet_length(text) == F.char_length(text), lower).otherwise(folded)


def regex_hit(text: Column, pattern: labels.Labelled, build, folded: Column | None = None) -> Column:
    """``build(group 1)`` if the pattern is found in the text, else NULL.

    With ``folded`` given, the regex runs only on texts that contain its
    anchor, and from the first place on where its head stands; a byte search costs a
    small part of a regex search. No place in ``folded`` is later than in the text,
    since folding lengthens none.
    """
    started = folded is not None and pattern.head
    searched = F.substr(text, F.locate(pattern.head, folded)) if started else text
    hit = bind(F.regexp_extract(searched, pattern.regex, 1), lambda m: F.when(m != "", build(m)))
    if folded is None or not pattern.anchor:
        return hit
    possible = F.contains(folded, F.lit(pattern.anchor))
    if started and pattern.head not in pattern.anchor:
        possible = possible & F.contains(folded, F.lit(pattern.head))
    return F.when(possible, hit)


def first_match(text: Column, bank: list[labels.Labelled], folded: Column | None = None) -> Column:
    """``struct(value, confidence)`` of the first pattern that matches, else NULL.

    ``coalesce`` stops at the first hit, so later patterns do not run.
    """

    def attempt(rank: int, pattern: labels.Labelled) -> Column:
        confidence = HIGH if rank == 0 else LOW
        return regex_hit(
            text, pattern, lambda m: F.struct(m.alias("value"), F.lit(confidence).alias("confidence")), folded
        )

    return F.coalesce(*(attempt(rank, pattern) for rank, pattern in enumerate(bank)))


def confidence_of(hit: Column) -> Column:
    return F.coalesce(hit["confidence"], F.lit(MISSING))
