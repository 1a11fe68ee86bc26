"""Review tokenizers. English is native; other analyzers plug in as an Arrow function."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that are no tokens of an English review.
ENGLISH_STOPWORDS = (
    "a an the and or but in on at to for of with is it this that i you he she we they be are was were been have has had "
    "do does did will would could should may might not no so if as by from up about into than then just also very more can get got "
    "its my your our their me him her us them game games play played playing player"
).split()
ENGLISH_MIN, NOUN_MIN, TOKEN_MAX = 3, 2, 100


def english_tokens(text: Column) -> Column:
    """Lower-case ASCII words of 3 to 100 letters without stop words, in text order; null gives an empty array."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-zA-Z]+"), F.lit(0))
    stop = F.array(*[F.lit(w) for w in ENGLISH_STOPWORDS])
    kept = F.filter(words, lambda w: (F.length(w) >= ENGLISH_MIN) & (F.length(w) <= TOKEN_MAX))
    return F.filter(kept, lambda w: ~F.array_contains(stop, w))


def noun_tokens(make_analyzer: Callable[[], Callable[[str], Iterable[tuple[str, str]]] | None]):
    """Column function for an analyzer that yields (form, tag): nouns (NNG, NNP) of 2 to 100 characters.

    The analyzer is made once per Python worker; where none is installed (``None``) texts have no tokens.
    """

    @F.pandas_udf("array<string>")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        analyze = make_analyzer()
        for texts in batches:
            yield texts.map(lambda t: [] if analyze is None or not t else [form for form, tag in analyze(t) if tag in ("NNG", "NNP") and NOUN_MIN <= len(form) <= TOKEN_MAX])

    return tokens
