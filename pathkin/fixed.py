"""Fixed values.

Results only agree between runs, files and earlier systems if these stay as
they are, so they are stated here once, as plain text.
"""

# Text forms.
FIELD = "\t"
PATH_LINK = " -> "
PATH_SUM_TAG = "PS:"
WORD_SUM_TAG = "SW:"
TOTAL_TAG = "TOTAL"
SUBJECT_SLOT = "X"
OTHER_SLOT = "Y"
TOKEN_LINK = "/"

# Word classes of the parse.
ROOT_LABEL = "ROOT"
MAIN_LABELS = ("ROOT", "ccomp")
VERB_PREFIX = "VB"
NOUN_PREFIX = "NN"
AUXILIARY_WORDS = ("is", "are", "was", "were", "be", "been", "am")
FILLER_PREFIXES = ("NN", "DT", "PRP")
FILLER_TAGS = ("WP", "WP$")
PREPOSITION_TAGS = ("IN", "TO")
SUBJECT_PREFIX = "nsubj"
SUBJECT_LABELS = ("csubj", "csubjpass")

# A tab-separated segment that only holds counts.
COUNT_SEGMENT = r"^[0-9,]+\.?[0-9]*\z"

# Word endings, tried in this order; the first that fits is applied.
WORD_ENDINGS = (
    (r"(?s)^(.+)([^aeiou])\2(?:ing|ed)\z", "$1$2"),
    (r"(?s)^(.+y)ing\z", "$1y"),
    (r"(?s)^(..+)ing\z", "$1"),
    (r"(?s)^(.+)ied\z", "$1y"),
    (r"(?s)^(..+)ed\z", "$1"),
    (r"(?s)^(.*)ies\z", "$1y"),
    (r"(?s)^(.+[sxzho])es\z", "$1"),
    (r"(?s)^(.+[^siu])s\z", "$1"),
)

# Numbers as text.
WHOLE_NUMBER = r"^[+-]?[0-9]+\z"
REAL_NUMBER = r"^(?:[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[fFdD]?|Infinity)|[+-]?NaN)\z"
SCORE_NUMBER = r"(?i)^[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf(?:inity)?|nan)\z"

# Evaluation.
SCORE_THRESHOLDS = (0.0001, 0.001, 0.01, 0.05, 0.1)
HIGH_CUTOFF_DEFAULT = 0.01
LOW_CUTOFF_DEFAULT = 0.001
HIGH_CUTOFF_FLOOR = 0.01
LOW_CUTOFF_CEILING = 0.01
MEAN_MARGIN = 1e-6
F1_EPSILON = 1e-10
CURVE_POINTS = 20
ERROR_EXAMPLES = 5
SAMPLE_CHARS = 200
