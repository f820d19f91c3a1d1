"""Expressions over the text fields of an event."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitfold.fixed import BOT_MARKERS


def is_bot(user_agent: str = "user_agent") -> Column:
    """True when the agent names an automated client; a missing agent is a person.

    Substring tests run in generated code and take two thirds of the time of one
    pattern with alternatives.
    """
    text = F.lower(F.col(user_agent))
    return F.coalesce(reduce(or_, [text.contains(marker) for marker in BOT_MARKERS]), F.lit(False))


def lower_code(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def upper_code(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))
