"""Column expressions that bring keys and texts to one form."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Python's str.split has it; Java's \s is ASCII only.
SPACE = r"[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Hyphen forms read as "-".
HYPHENS = "‐‑‒–−﹣－"
SOFT = "­"


def section_key(c: Column) -> Column:
    """Key form of a section or chapter number.

    Without §, square brackets, white space, soft hyphens and leading zeros; any hyphen form
    becomes "-"; letters in upper case. Null and what leaves nothing give null.
    """
    k = F.translate(c, HYPHENS + "[]§" + SOFT, "-" * len(HYPHENS))
    k = F.regexp_replace(k, SPACE + "+", "")
    k = F.upper(F.regexp_replace(k, r"^0+(?=\d)", ""))
    return F.when(k != "", k)


#: Texts that are their own equal-text form: single blanks between runs of signs below U+0300, none at the ends. Most are; one fast scan tells.
_SIGN = r"[^\x00- \x7f-\xa0\xad\x{300}-\x{10ffff}]"
PLAIN = rf"^(?:{_SIGN}++(?: {_SIGN}++)*+)?\z"
#: Signs that NFC may change or move: all from U+0300 on but punctuation.
COMPOSED = r"[\x{300}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{10ffff}]"


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def same_text(c: Column) -> Column:
    """Text form under which two values count as equal, but for NFC, which ``with_same_text`` adds.

    Soft hyphens go, U+2011 becomes "-", white space runs become one space, ends are trimmed. Null stays null and differs from the empty text.
    """
    folded = F.trim(F.regexp_replace(F.translate(c, "‑" + SOFT, "-"), SPACE + "+", " "))
    return F.when(c.rlike(PLAIN), c).otherwise(folded)


def with_same_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns in their equal-text form, brought to NFC.

    Only rows with a sign that NFC may change go through Python; they are told apart before, so that the rest never leaves the JVM.
    """
    odd = reduce(lambda a, b: a | b, (F.coalesce(F.col(c).rlike(COMPOSED), F.lit(False)) for c in columns))
    plain = df.where(~odd).withColumns({c: same_text(F.col(c)) for c in columns})
    rest = df.where(odd).withColumns({c: _nfc(same_text(F.col(c))) for c in columns})
    return plain.unionByName(rest)
