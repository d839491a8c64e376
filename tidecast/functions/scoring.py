"""Expressions over counts, probabilities and class scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
ASPECTS = ["ECONOMY", "TECHNOLOGY", "GENERAL", "COMMUNITY", "SECURITY"]
POLARITIES = ["POSITIVE", "NEGATIVE", "NONE"]
RATIO_OFFSET = 0.5


def polarity_score(positive: Column, negative: Column, none: Column) -> Column:
    """Share of positive minus negative; 0 for a day without documents."""
    total = positive + negative + none
    return F.coalesce(F.try_divide((positive - negative).cast("double"), total), F.lit(0.0))


def pos_neg_ratio(positive: Column, negative: Column) -> Column:
    """Log of positive over negative, offset so that no count divides by zero."""
    return F.log((positive + RATIO_OFFSET) / (negative + RATIO_OFFSET))


def up_or_down(probability: Column, threshold: float = 0.5) -> Column:
    """Strictly above the threshold is ``Up``."""
    return F.when(probability > threshold, F.lit("Up")).otherwise(F.lit("Down"))


def argmax_label(probabilities: Column, labels: list[str]) -> Column:
    """Label of the highest probability; the first one wins a tie."""
    names = F.array(*[F.lit(x) for x in labels])
    best = F.array_position(probabilities, F.array_max(probabilities))
    return F.try_element_at(names, best.cast("int"))


def outcome(change: Column, prediction: Column) -> Column:
    """``Correct`` or ``Wrong``; no change is ``Wrong``, no prediction is blank."""
    correct = ((change > 0) & (prediction == "Up")) | ((change < 0) & (prediction == "Down"))
    return (
        F.when(prediction.isNull() | change.isNull(), F.lit(""))
        .when(correct, F.lit("Correct"))
        .otherwise(F.lit("Wrong"))
    )
