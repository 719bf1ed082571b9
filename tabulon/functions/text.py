"""Text expressions: ASCII folding and category cleaning, all inside the JVM."""
from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F

# The characters Python's str.strip removes.
_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
          "\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


@lru_cache(maxsize=1)
def _fold_pairs() -> tuple[str, str]:
    """Characters whose canonical decomposition keeps one ASCII character, and that character."""
    src, dst = [], []
    for cp in range(0x80, 0x30000):
        ch = chr(cp)
        if 0xD800 <= cp <= 0xDFFF:
            continue
        kept = [p for p in unicodedata.normalize("NFD", ch) if ord(p) < 128]
        if len(kept) == 1:
            src.append(ch)
            dst.append(kept[0])
    return "".join(src), "".join(dst)


def strip(col: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.btrim(col, F.lit(_SPACE))


def empty_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def ascii_fold(col: Column) -> Column:
    """Strip, drop accents, drop what is still not ASCII; nothing left becomes NULL."""
    src, dst = _fold_pairs()
    text = strip(col.cast("string"))
    plain = F.regexp_replace(F.translate(text, src, dst), r"[^\x00-\x7F]", "")
    return empty_to_null(F.when(text.rlike(r"[^\x00-\x7F]"), plain).otherwise(text))


def clean_category(col: Column) -> Column:
    """ASCII fold, lower case, strip; empty becomes NULL."""
    return empty_to_null(strip(F.lower(ascii_fold(col))))
