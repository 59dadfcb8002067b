"""Rating flags as a bit mask and as tags."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rating bits and the tags that state a rating rather than content.
FLAG_BITS = {"SFW": 1, "NSFW": 2, "NSFL": 4, "NSFP": 8}
RATING_TAGS = ("nsfw", "nsfl", "nsfp", "sfw")


def matches_mask(flags: Column, mask: int) -> Column:
    return flags.bitwiseAND(F.lit(mask)) != 0


def flag_names(flags: Column) -> Column:
    """``3`` -> ``SFW+NSFW``."""
    names = [F.when(matches_mask(flags, bit), F.lit(name)) for name, bit in FLAG_BITS.items()]
    return F.array_join(F.array_compact(F.array(*names)), "+")


def encode_flags(names: Iterable[str]) -> int:
    return sum(FLAG_BITS[n.upper()] for n in set(names))


def is_rating_tag(tag: Column) -> Column:
    return tag.isin(*RATING_TAGS)
