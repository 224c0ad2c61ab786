"""Text expressions: sentences, tokens, words, names and titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTENCE_MARK = "\u0001"

# Words that do not count when a question is matched.
STOP_WORDS = [
    "what", "when", "where", "which", "who", "whom", "whose", "why", "how", "a", "an", "the", "is", "are",
    "was", "were", "be", "been", "being", "in", "on", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above", "below", "to", "from", "up", "down",
    "of", "off", "over", "under", "again", "further", "then", "once", "here", "there", "all", "any", "both",
    "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so",
    "than", "too", "very", "can", "will", "just", "should", "now",
]

WORD_TOKEN = r"[\p{L}\p{N}]+"
VECTOR_TOKEN = r"[\p{L}\p{N}_]{2,}"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column used inside a lambda is put into it by the optimizer and would be
    computed again for every element; a lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]


def sentences(text: Column) -> Column:
    """Sentences: cut after ``.``, ``!`` or ``?`` followed by white space.
    Trailing white space belongs to no sentence."""
    clean = F.regexp_replace(text, r"\s+$", "")
    marked = F.regexp_replace(clean, r"([.!?])\s+", "$1" + SENTENCE_MARK)
    return F.filter(F.split(marked, SENTENCE_MARK), lambda s: s != "")


def tokens(text: Column, pattern: str = WORD_TOKEN) -> Column:
    """Lower-cased tokens in order, repeats kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def squashed(text: Column) -> Column:
    """Lower case with every run of white space as one blank."""
    return F.regexp_replace(F.lower(text), r"(?U)\s+", " ")


def words(text: Column) -> Column:
    """Blank-separated words of squashed text, punctuation kept."""
    return F.filter(F.split(squashed(text), " "), lambda w: w != "")


def important_words(question: Column) -> Column:
    """Distinct words of a question that are no stop words."""
    return F.array_except(F.array_distinct(words(question)), F.lit(STOP_WORDS))


def answer_sentences(context: Column) -> Column:
    """Trimmed, non-empty pieces between ``.``, ``!`` and ``?``."""
    pieces = F.transform(F.split(squashed(context), "[.!?]"), lambda s: F.trim(s))
    return F.filter(pieces, lambda s: s != "")


def basename(path: Column) -> Column:
    """Part after the last slash."""
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Lower-cased last extension with its dot; '' without one. A leading dot
    of the name starts no extension."""
    return F.lower(F.regexp_extract(basename(path), r"^.+(\.[^.]*)$", 1))


def is_blank(text: Column) -> Column:
    """NULL, empty or white space only."""
    return F.coalesce(F.regexp_replace(text, r"(?U)\s+", "") == "", F.lit(True))


def default_title(title: Column, source: Column) -> Column:
    """The title, or the file name of the source where it is missing or empty."""
    return F.coalesce(F.nullif(title, F.lit("")), basename(source))


def document_date(metadata: Column) -> Column:
    """``creation_date`` if the key exists, else ``created``, else NULL."""
    return F.when(F.map_contains_key(metadata, "creation_date"), metadata["creation_date"]) \
        .otherwise(F.try_element_at(metadata, F.lit("created")))
