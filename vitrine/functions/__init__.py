from .lattice import Lexicon, lattice_analyzer
from .scalars import day_of, epoch_to_timestamp, first_or_null, iso_timestamp, joined_names, normalize_language, release_date, safe_int
from .text import ENGLISH_STOPWORDS, english_tokens, noun_tokens

__all__ = [
    "ENGLISH_STOPWORDS", "Lexicon", "day_of", "english_tokens", "epoch_to_timestamp", "first_or_null", "iso_timestamp", "joined_names",
    "lattice_analyzer", "normalize_language", "noun_tokens", "release_date", "safe_int",
]
