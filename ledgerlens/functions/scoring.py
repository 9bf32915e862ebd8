"""Answer label -> numeric score, applied to any list of survey columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import CITIZEN_IMPACT, CITIZEN_IMPACT_ACCOUNTS, OVERHEAD, SCORE_LABELS
from .text import col_of


def score(c: str | Column, labels=SCORE_LABELS) -> Column:
    """Integer score of an answer label; null for any other answer."""
    x = col_of(c)
    out = None
    for label, value in labels:
        out = F.when(x == label, F.lit(value)) if out is None else out.when(x == label, F.lit(value))
    return out


def float_score(c: str | Column, labels=SCORE_LABELS) -> Column:
    return score(c, labels).cast("double")


def impact_category(account: str | Column) -> Column:
    """'Citizen Impact' for the listed two-digit accounts, else 'Overhead'.

    A null account and one with surrounding blanks both fall to 'Overhead'.
    """
    a = col_of(account).cast("string")
    return F.when(a.isin(*CITIZEN_IMPACT_ACCOUNTS), F.lit(CITIZEN_IMPACT)).otherwise(F.lit(OVERHEAD))
