"""Bytes of unknown charset to text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Charsets that are tried in this order.
CHARSETS = ("utf-8", "shift_jis", "euc-jp", "euc-kr", "gb18030", "tis-620", "cp1258")


def decoded(raw: bytes) -> str:
    """UTF-8, else the first of some usual charsets that fits, else UTF-8 without what is broken."""
    for charset in CHARSETS:
        try:
            return bytes(raw).decode(charset)
        except UnicodeDecodeError:
            pass
    return bytes(raw).decode("utf-8", "ignore")


@F.pandas_udf(T.StringType())
def _decoded(content: pd.Series) -> pd.Series:
    return content.map(decoded, na_action="ignore")


def decode_text(content) -> F.Column:
    """Text of binary content; only what isn't UTF-8 is tried in other charsets, by a Python worker."""
    c = F.col(content) if isinstance(content, str) else content
    return F.coalesce(F.try_validate_utf8(c.cast("string")), _decoded(F.when(~F.is_valid_utf8(c.cast("string")), c)))
