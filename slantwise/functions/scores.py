"""Expressions over class probabilities."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from slantwise import constants as K


def prob_columns(classes: Sequence[str] = K.CLASSES) -> list[str]:
    """Names of the probability columns, in class order."""
    return [f"prob_{name}" for name in classes]


def probabilities(classes: Sequence[str] = K.CLASSES) -> list[Column]:
    return [F.col(name) for name in prob_columns(classes)]


def total(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def argmax_index(probs: Sequence[Column]) -> Column:
    """Index of the highest probability; the first one wins a tie."""
    top = F.greatest(*probs)
    out = F.lit(len(probs) - 1)
    for index in range(len(probs) - 2, -1, -1):
        out = F.when(probs[index] == top, F.lit(index)).otherwise(out)
    return out.cast("int")


def label_of(index: Column, classes: Sequence[str] = K.CLASSES) -> Column:
    """Class name of a class index; null outside the list."""
    return F.get(F.array(*[F.lit(name) for name in classes]), index)


def index_of(label: Column, classes: Sequence[str] = K.CLASSES) -> Column:
    """Class index of a class name; null for an unknown name."""
    out = F.lit(None).cast("int")
    for index, name in reversed(list(enumerate(classes))):
        out = F.when(label == name, F.lit(index)).otherwise(out)
    return out


def argmax_label(probs: Sequence[Column], classes: Sequence[str] = K.CLASSES) -> Column:
    return label_of(argmax_index(probs), classes)


def signed_score(probs: Sequence[Column]) -> Column:
    """Probability of the last class minus that of the first, in [-1, 1]."""
    return probs[-1] - probs[0]


def entropy_eps(probs: Sequence[Column], epsilon: float = K.ENTROPY_EPSILON) -> Column:
    """Entropy with a guard inside the logarithm (document scoring)."""
    return -total([p * F.ln(p + F.lit(epsilon)) for p in probs])


def entropy_exact(probs: Sequence[Column]) -> Column:
    """Entropy of the renormalised probabilities, with 0 ln 0 = 0 (reports)."""
    mass = total(probs)
    shares = [F.try_divide(p, mass) for p in probs]
    return -total([F.when(s > 0, s * F.ln(s)).otherwise(F.lit(0.0)) for s in shares])


def confidence_note(entropy: Column, n_classes: int = len(K.CLASSES)) -> Column:
    """Verbal grade of an entropy relative to its maximum."""
    limit = math.log(n_classes)
    return (
        F.when(entropy < 0.5 * limit, "Relatively confident")
        .when(entropy < 0.8 * limit, "Moderate uncertainty")
        .otherwise("High uncertainty")
    )


def softmax(logits: Sequence[Column]) -> list[Column]:
    """Softmax, shifted by the largest logit."""
    top = F.greatest(*logits)
    exps = [F.exp(z - top) for z in logits]
    return [e / total(exps) for e in exps]
