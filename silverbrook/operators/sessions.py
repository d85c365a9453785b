"""How far sessions get and why they end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverbrook import settings
from silverbrook.functions import values as V
from silverbrook.operators import cleaning as C
from silverbrook.operators import reports


def session_outcomes(raw: DataFrame, steps: list[str] | None = None) -> DataFrame:
    """Deepest step and end reason per session, from raw events.

    Only maxima are kept, so a session with very many events is reduced in every task.
    """
    steps = settings.SESSION_STEPS if steps is None else steps
    step = reports.journey_position("event_type", steps)
    ended = F.col("event_type") == "session_end"
    events = raw.filter(C.valid_event()).select(
        "session_id",
        step.alias("step"),
        F.when(ended, V.parse_ts("timestamp")).alias("end_ts"),
        F.when(ended, C.event_properties()["reason"]).alias("reason"),
    )
    last_end = F.when(F.col("reason").isNotNull(), F.struct("end_ts", "reason"))
    grouped = events.groupBy("session_id").agg(
        F.max("step").alias("depth"),
        F.max(last_end)["reason"].alias("end_reason"),
        F.count("*").alias("events"),
    )
    names = F.lit(steps)
    deepest = F.when(F.col("depth").isNotNull(), F.element_at(names, F.col("depth") + 1))
    return grouped.select(
        "session_id", "depth", deepest.alias("deepest_step"), "end_reason", "events"
    )


def step_conversion(outcomes: DataFrame, steps: list[str] | None = None) -> DataFrame:
    """Sessions that reach each step or a deeper one, and the share of the step before."""
    steps = settings.SESSION_STEPS if steps is None else steps
    counts = outcomes.agg(
        *(F.count(F.when(F.col("depth") >= at, 1)).alias(s) for at, s in enumerate(steps))
    )
    rows = [
        F.struct(
            F.lit(at).alias("step_order"),
            F.lit(name).alias("step"),
            F.col(name).alias("sessions"),
            V.ratio(F.col(name), F.col(steps[at - 1]) if at else F.col(name)).alias("rate"),
        )
        for at, name in enumerate(steps)
    ]
    return counts.select(F.inline(F.array(*rows)))


def end_reasons(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("end_reason").agg(F.count("*").alias("sessions"))
