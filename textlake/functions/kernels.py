"""The few kernels that Spark has no expression for, as Arrow-batched UDFs."""

from __future__ import annotations

import html
import unicodedata
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def _text_udf(function):
    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(function, na_action="ignore")

    return run


_nfc = _text_udf(lambda t: unicodedata.normalize("NFC", t))
_nfkc = _text_udf(lambda t: unicodedata.normalize("NFKC", t))
_unescape = _text_udf(html.unescape)


def _where(udf, text: Column, needed: Column) -> Column:
    """``udf`` of the texts that need it; the others are sent as nulls and stay as they are."""
    return F.when(needed, udf(F.when(needed, text))).otherwise(text)


def _not_ascii(text: Column) -> Column:
    return F.octet_length(text) != F.length(text)


def nfc(text: Column) -> Column:
    return _where(_nfc, text, _not_ascii(text))


def nfkc(text: Column) -> Column:
    return _where(_nfkc, text, _not_ascii(text))


def html_unescape(text: Column) -> Column:
    return _where(_unescape, text, text.contains("&"))


@F.pandas_udf(T.StructType([T.StructField("dominant", T.DoubleType()), T.StructField("savings", T.DoubleType())]))
def _repetition(texts: pd.Series) -> pd.DataFrame:
    def of(t):
        if t is None or not t:
            return 0.0, 0.0
        data = t.encode("utf-8", "surrogatepass")
        if len(data) == len(t):
            most = np.bincount(np.frombuffer(data, np.uint8)).max()
        else:
            most = np.unique(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32), return_counts=True)[1].max()
        return most / len(t), 1 - len(zlib.compress(data)) / len(data)

    return pd.DataFrame([of(t) for t in texts], columns=["dominant", "savings"])


_repetition = _repetition.asNondeterministic()


def repetition(compact: Column) -> Column:
    """struct(dominant: share of the commonest character, savings: what zlib saves) of a text without blanks.

    Spark is told that it isn't deterministic, so that it runs in one place: a filter on what follows
    from it would else be pushed below it, with all expressions that lead to it written out again for
    each use, and Python would run twice.
    """
    return _repetition(compact)
