"""Fixed values that results depend on.

Everything here is a plain constant; operators take them as default
parameters so callers can override.
"""

from __future__ import annotations

# --- fixed values: ISO 639-1 code -> language name (12 entries) -------------
LANGUAGE_NAMES = {
    "en": "English",
    "es": "Spanish",
    "fr": "French",
    "de": "German",
    "it": "Italian",
    "nl": "Dutch",
    "pt": "Portuguese",
    "hi": "Hindi",
    "ru": "Russian",
    "ar": "Arabic",
    "zh": "Chinese",
    "ja": "Japanese",
}
# Japanese is also written "jp" in the block labels; both map to "ja".
LANGUAGE_ALIASES = {"jp": "ja"}

# --- fixed values: order of the stacked language blocks of a split ----------
BLOCK_LANGUAGES = ["ar", "zh", "en", "fr", "hi", "jp", "ru", "es"]

# --- fixed values: languages back-translated by default (English excluded) --
BACK_TRANSLATE_LANGUAGES = ["ar", "zh", "fr", "hi", "jp", "ru", "es"]

# --- fixed values: wide parallel-sentence file header ------------------------
PARALLEL_ENGLISH_COLUMN = "English Sentence"
PARALLEL_LANGUAGES = [
    "Chinese",
    "Hindi",
    "Spanish",
    "French",
    "Arabic",
    "Russian",
    "Japanese",
]
PARALLEL_SUFFIX = " Translation"

# --- fixed values: audit log / report / sample headers -----------------------
AUDIT_HEADER = ["ID", "GPT Value Original", "GPT Value Modified"]
SAMPLE_COLUMNS = ["complexity", "length", "fk_grade", "f_ease"]

# --- fixed values: conversation roles ----------------------------------------
HUMAN = "human"
GPT = "gpt"
IMAGE_TAG = "<image>"

# --- fixed values: call pacing and batch sizes -------------------------------
CALLS_PER_MINUTE = 10_000
CALL_PERIOD_SECONDS = 60
TRANSLATE_BATCH_SIZE = 10
BACK_TRANSLATE_CHUNK = 100

# --- fixed values: degenerate-repeat threshold -------------------------------
REPEAT_MIN_THRESHOLD = 0.3
REPEAT_MAX_THRESHOLD = 0.8
REPEAT_DECAY = 0.05

# --- fixed values: readability formulas (Flesch 1948, Kincaid 1975) ---------
FK_WORDS_PER_SENTENCE = 0.39
FK_SYLLABLES_PER_WORD = 11.8
FK_CONSTANT = 15.59
FRE_CONSTANT = 206.835
FRE_WORDS_PER_SENTENCE = 1.015
FRE_SYLLABLES_PER_WORD = 84.6

# --- fixed values: metric parameters -----------------------------------------
CHRF_CHAR_ORDER = 6
CHRF_WORD_ORDER = 2
CHRF_BETA = 2
BLEU_MAX_ORDER = 4
# the smallest normal double, used for a zero n-gram precision
SMALLEST_NORMAL_DOUBLE = 2.2250738585072014e-308
CHRF_FLAG_THRESHOLD = 0.5
SAMPLE_SEED = 42
# ASCII punctuation split off word tokens for chrF word n-grams
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
