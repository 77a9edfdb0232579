"""M1 readability (Flesch-Kincaid grade, Flesch reading ease) as native
column expressions.

Counting rules (ours; the reference's library uses a pronunciation
dictionary that is not available here, so values differ from it):

* words: whitespace tokens after removing ASCII punctuation;
* sentences: pieces ``[^.!?]+[.!?]*`` with more than two words, at least 1;
* syllables of a word: groups of ``[aeiouy]`` in the lower-cased word, minus
  one when it ends in consonant + ``e``, at least 1;
* no words: both ratio terms are 0; NULL text: (0, 0).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from babelframe import constants as C
from babelframe.functions.text import ASCII_PUNCT_CLASS, spaces

SENTENCE_PIECE = r"[^.!?]+[.!?]*"
VOWEL_GROUP = "[aeiouy]+"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Whole-text forms of the per-word syllable rule. For a word with g vowel
# groups and s = 1 if it ends in consonant + e, max(1, g - s) equals
# g - s, plus 1 when the word has no vowel (g = 0) or its only vowel group
# is the final silent e (g = s = 1). Summed over words:
#   Y = #vowel groups - #silent-e words + #vowel-less words + #lone-e words
# which four regex counts over the whole text give without a per-word loop.
# Whitespace is first mapped to plain spaces (a character map), so every
# pattern below uses small classes; the text is padded with one space on
# each side so word boundaries are literal spaces.
WORD_START = " [^ ]"
SILENT_E_WORD_END = "[^aeiouy ]e(?= )"
NO_VOWEL_WORD = " [^aeiouy ]+(?= )"
LONE_E_WORD = " [^aeiouy ]+e(?= )"


def syllables(padded_lower: Column) -> Column:
    """Y for a punctuation-stripped, lower-cased, space-padded text."""
    def n(p: str) -> Column:
        return F.regexp_count(padded_lower, F.lit(p))

    return n(VOWEL_GROUP) - n(SILENT_E_WORD_END) + n(NO_VOWEL_WORD) + n(LONE_E_WORD)


def _strip_punct(c: Column) -> Column:
    return F.regexp_replace(c, F.lit(ASCII_PUNCT_CLASS), "")


def counts(col: Column | str) -> tuple[Column, Column, Column]:
    """(W words, S sentences, Y syllables) as bigint columns."""
    sp = spaces(_c(col))
    padded = F.concat(F.lit(" "), _strip_punct(sp), F.lit(" "))
    n_words = F.regexp_count(padded, F.lit(WORD_START)).cast("bigint")
    pieces = F.regexp_extract_all(sp, F.lit(SENTENCE_PIECE), 0)
    n_sent = F.greatest(
        F.lit(1),
        F.size(F.filter(pieces, lambda p: F.regexp_count(F.concat(F.lit(" "), _strip_punct(p)), F.lit(WORD_START)) > 2)),
    ).cast("bigint")
    n_syll = syllables(F.lower(padded)).cast("bigint")
    return n_words, n_sent, n_syll


def grade_and_ease(col: Column | str) -> tuple[Column, Column]:
    """M1: (fk_grade, f_ease) doubles from W/S/Y; NULL text -> (0, 0)."""
    w, s, y = counts(col)
    return formulas(_c(col), w, s, y)


def formulas(text: Column, w: Column, s: Column, y: Column) -> tuple[Column, Column]:
    wps = F.when(w > 0, w / s).otherwise(F.lit(0.0))
    spw = F.when(w > 0, y / w).otherwise(F.lit(0.0))
    grade = F.lit(C.FK_WORDS_PER_SENTENCE) * wps + F.lit(C.FK_SYLLABLES_PER_WORD) * spw - F.lit(C.FK_CONSTANT)
    ease = F.lit(C.FRE_CONSTANT) - F.lit(C.FRE_WORDS_PER_SENTENCE) * wps - F.lit(C.FRE_SYLLABLES_PER_WORD) * spw
    isnull = text.isNull()
    return (
        F.when(isnull, F.lit(0.0)).otherwise(grade),
        F.when(isnull, F.lit(0.0)).otherwise(ease),
    )
