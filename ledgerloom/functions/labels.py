"""Customer segment and movement labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SEGMENTS = (
    "Champion",
    "Loyal Customer",
    "New Customer",
    "At Risk",
    "Lost",
    "Potential Loyalist",
)
MOVEMENTS = ("New", "Stable", "Upgraded", "Downgraded", "Lateral")


def customer_segment(recency: Column, frequency: Column, monetary: Column) -> Column:
    """Segment from three 1-5 scores; the first rule that holds wins."""
    champion, loyal, new, at_risk, lost, potential = SEGMENTS
    return (
        F.when((recency >= 4) & (frequency >= 4) & (monetary >= 4), champion)
        .when((recency >= 3) & (frequency >= 3), loyal)
        .when((recency >= 4) & (frequency <= 2), new)
        .when((recency <= 2) & (frequency >= 3), at_risk)
        .when((recency <= 2) & (frequency <= 2), lost)
        .otherwise(potential)
    )


def segment_movement(
    segment: Column, previous: Column, total: Column, previous_total: Column
) -> Column:
    new, stable, upgraded, downgraded, lateral = MOVEMENTS
    return (
        F.when(previous.isNull(), new)
        .when(segment == previous, stable)
        .when(total > previous_total, upgraded)
        .when(total < previous_total, downgraded)
        .otherwise(lateral)
    )


def segment_transition(segment: Column, previous: Column) -> Column:
    return F.concat(F.coalesce(previous, F.lit("New")), F.lit(" → "), segment)
