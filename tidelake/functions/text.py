"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelake.contracts import STATE_CODES

#: What may stand between a city and its state.
SEPARATORS = "- \t\n\r\f\x0b"


def normalise_city(city: Column) -> Column:
    """Lower-case name of a city: what stands before a slash, without a state code at its end, words one blank apart.

    The last two letters are a state code only if a blank or a dash sets them apart: ``porto to`` loses its last
    word, ``sp`` alone and ``mato`` do not. Spelling mistakes stay as they are.
    """
    name = F.trim(F.split_part(F.lower(city), F.lit("/"), F.lit(1)))
    stem = F.left(name, F.greatest(F.char_length(name) - 2, F.lit(0)))
    apart = F.rtrim(stem, F.lit(SEPARATORS))
    has_state = F.right(name, F.lit(2)).isin(*STATE_CODES) & (F.char_length(apart) < F.char_length(stem))
    words = F.split(F.when(has_state, apart).otherwise(name), r"\s+")
    return F.array_join(F.filter(words, lambda word: word != ""), " ")
