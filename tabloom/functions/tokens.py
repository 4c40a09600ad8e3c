"""The vocabularies of missing values, truth words and character classes.

Each stage has its own list of missing values; they are not interchangeable.
"""

from __future__ import annotations

# What the CSV and Excel readers turn into null.
READER_NULLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# What content masks and densities count as blank, besides white space.
MASK_NULLS = ("None", "none", "null", "NULL", "NaN", "NAN", "<NA>", "na", "N/A", "n/a")
# What a candidate header's score leaves out; a missing cell counts there, as the word nan.
HEADER_NULLS = (*MASK_NULLS, "")
# What header promotion leaves out.
PROMOTE_NULLS = ("None", "nan", "NaN", "NA", "<NA>")
# What cleaning turns into null, in any case.
CLEAN_NULLS = ("", "none", "null", "nan", "<na>", "nat")
# What text columns lose on alignment.
STRING_NULLS = ("<NA>", "nan")
# What row trimming leaves out.
TRIM_NULLS = ("None", "nan", "NaN", "<NA>", "")

TRUE_WORDS = ("true", "t", "yes", "y", "1", "1.0")
FALSE_WORDS = ("false", "f", "no", "n", "0", "0.0")

# White space and what isn't part of a name, for Java's regular expressions.
SPACE = r"[\s\x0B\x1c-\x1f\x85\p{Z}]"
NOT_WORD = r"[^\p{L}\p{N}_]"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INFINITE = r"^[+-]?(?i:inf|infinity)$"

LOGICAL_TYPES = (
    "STRING", "BYTES", "INTEGER", "INT64", "FLOAT", "FLOAT64", "NUMERIC", "BIGNUMERIC", "BOOLEAN",
    "BOOL", "TIMESTAMP", "DATE", "TIME", "DATETIME", "GEOGRAPHY", "JSON", "INTERVAL",
)
MODES = ("NULLABLE", "REQUIRED", "REPEATED")
