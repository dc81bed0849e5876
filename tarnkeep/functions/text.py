"""Text clean-up as native expressions, so that code generation is kept."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space in Unicode-aware text handling.
# The regex engine's own \s covers only the ASCII part, so they are listed.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The regex engine tests listed Latin characters with one table lookup, ranges and others one by
# one. So the kept characters are listed, and text without a space from beyond Latin is spared
# the test for those.
_KEPT = string.ascii_letters + string.digits + ",.\\-" + "".join(c for c in WHITESPACE if c <= "\xff")
_WIDE = "".join(c for c in WHITESPACE if c > "\xff")
_DROPPED = f"[^{_KEPT}]+"
_DROPPED_AMONG_WIDE = f"[^{_KEPT}{_WIDE}]+"
_MAYBE_WIDE = f"[{min(_WIDE)}-{max(_WIDE)}]"
# anchored and without backtracking, so it gives up at the first other character
_NOTHING = f"\\A[{WHITESPACE}]*+(?i:null)?+[{WHITESPACE}]*+\\z"


def clean_text(column: Column) -> Column:
    """Keep letters, digits, white space, comma, dot and hyphen, then trim.

    Null, blank text and the word NULL (in any case) become the empty string.
    """
    text = column.cast("string")
    kept = F.when(
        text.rlike(_MAYBE_WIDE), F.regexp_replace(text, _DROPPED_AMONG_WIDE, "")
    ).otherwise(F.regexp_replace(text, _DROPPED, ""))
    kept = F.btrim(kept, F.lit(WHITESPACE))
    return F.when(text.isNull() | text.rlike(_NOTHING), F.lit("")).otherwise(kept)


def clean_identifier(column: Column) -> Column:
    """Every character outside letters, digits and underscore becomes an underscore."""
    return F.regexp_replace(column, "[^a-zA-Z0-9_]", "_")
