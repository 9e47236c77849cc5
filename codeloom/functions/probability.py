"""Scores to probabilities over arrays of class scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it inside ``body``, also within higher-order functions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def array_total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def sigmoid(score: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def softmax(scores: Column) -> Column:
    """Softmax of an array of scores, shifted by the maximum."""
    weights = bind(F.array_max(scores), lambda top: F.transform(scores, lambda s: F.exp(s - top)))
    return bind(weights, lambda w: bind(array_total(w), lambda total: F.transform(w, lambda e: e / total)))
