"""Plates that stand nearest to the selected kind of vehicle.

This needs the positions of every match, which no built-in function returns, so it is a
small Arrow UDF. Rows whose text names one kind only keep all plates natively and are
passed in as NULL.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import patterns as P
from .text import matches

REACH = 100
# One spelling for comparison; lengths stay, so positions do too.
_PLAIN = {**{code: code - 32 for code in range(ord("a"), ord("z") + 1)}, ord("－"): "-"}


class _Wording:
    """Spans of one kind's wording in a text, in order and without overlap."""

    def __init__(self, pattern: str, text: str):
        spans = [m.span() for m in re.finditer(pattern, text)]
        self.starts, self.ends = [a for a, _ in spans], [b for _, b in spans]

    def distance(self, start: int, end: int) -> int:
        """Characters between a span and the nearest wording: the one before it or the one behind it."""
        at = bisect_right(self.starts, start)
        before = max(start - self.ends[at - 1], 0) if at else REACH + 1
        behind = max(self.starts[at] - end, 0) if at < len(self.starts) else REACH + 1
        return min(before, behind)


def _places(text: str, plate: str) -> Iterator[int]:
    at = text.find(plate)
    while at >= 0:
        yield at
        at = text.find(plate, at + len(plate))


def _of_kind(text: str, plates: list[str], kind: str) -> list[str]:
    motorcycles, cars = _Wording(P.MOTORCYCLE_WORDING, text), _Wording(P.CAR_WORDING, text)
    plain, kept = text.translate(_PLAIN), []
    for plate in plates:
        spelled = plate.translate(_PLAIN)
        for at in _places(plain, spelled) if spelled else ():
            reach = (at, at + len(spelled))
            by_kind = {"MOTORCYCLE": motorcycles.distance(*reach), "CAR": cars.distance(*reach)}
            # equally near wording counts for the motorcycle
            nearest = min(by_kind, key=by_kind.__getitem__)
            if nearest == kind and by_kind[nearest] <= REACH:
                kept.append(plate)
                break
    return kept


def _select(texts: pd.Series, plates: pd.Series, kinds: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else _of_kind(t, list(p), k) for t, p, k in zip(texts, plates, kinds, strict=True)])


def plates_for_type(text: Column, plates: Column, vehicle_type: Column) -> Column:
    """Plates of the selected vehicle type in a text that mentions both types.

    Pass computed columns, not the expressions behind them: they become UDF inputs.
    """
    both = matches(text, P.MOTORCYCLE_WORDING) & matches(text, P.CAR_WORDING)
    contested = vehicle_type.isin("MOTORCYCLE", "CAR") & both & (F.size(plates) > 0)
    select = F.pandas_udf(_select, T.ArrayType(T.StringType()))
    chosen = select(F.when(contested, text), F.when(contested, plates), F.when(contested, vehicle_type))
    return F.when(contested, chosen).otherwise(plates)
