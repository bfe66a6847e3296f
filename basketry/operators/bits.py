"""Sets over a small numbered domain as bits of whole numbers.

A set that is collected value by value is an object of any length in the aggregate's buffer. As bits it
is a few numbers of fixed size, joined by `bit_or` in a plain hash aggregate, on the map side, too. A
domain of more than 63 numbers takes several words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The bits of a bigint but for its sign.
WORD = 63


def _sizes(size: int) -> list[int]:
    """How many numbers of the domain each word holds; at least one word."""
    return [min(WORD, size - at) for at in range(0, size, WORD)] or [1]


def word_names(prefix: str, size: int) -> list[str]:
    return [f"{prefix}{word}" for word in range(len(_sizes(size)))]


def bit_words(number: Column, size: int) -> list[Column]:
    """The words in which a number of the domain is the only bit; all zero for null."""
    words = []
    for word, held in enumerate(_sizes(size)):
        place = (number - word * WORD).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
        inside = (place >= 0) & (place < held)
        words.append(F.when(inside, bit).otherwise(F.lit(0).cast("bigint")))
    return words


def members(words: Sequence[Column], size: int) -> Column:
    """The numbers in a set, ascending."""

    def of(at: int, word: Column, held: int) -> Column:
        numbers = F.sequence(F.lit(0), F.lit(held - 1))
        inside = F.filter(numbers, lambda place: F.getbit(word, place) == 1)
        return F.transform(inside, lambda place: place + at * WORD)

    sizes = _sizes(size)
    return F.concat(*[of(at, word, sizes[at]) for at, word in enumerate(words)])
