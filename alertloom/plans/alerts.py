"""Every critical scenario: briefing, cost, plan, and the metrics that follow."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom.operators import generate, impact, scenario
from alertloom.session import settle


def analyze(
    records: DataFrame, keys: Sequence[str], named_only: bool = True
) -> DataFrame:
    """Default answers for all critical scenarios, one row each.

    A filter and projections only: nothing is shuffled, whatever the size.
    """
    scenarios = scenario.critical(records, keys, named_only)
    answered = generate.with_defaults(scenarios).withColumn(
        impact.HOURS, impact.hours_of_plan(F.col("plan"))
    )
    return impact.impact_metrics(answered)


def analyze_with_backend(
    records: DataFrame,
    keys: Sequence[str],
    make_backend: Callable[[], generate.Backend],
    named_only: bool = True,
    **settings,
) -> DataFrame:
    """The same with generated answers; each falls back row by row on its own.

    A backend that raises costs the rows concerned their answers, not the job:
    ``failed_calls`` counts those of the three that raised. The plan's prompt holds
    the two earlier answers, which are stored with their scenarios before it is
    made. Scenarios with the same prompt share one call.
    """
    scenarios = scenario.critical(records, keys, named_only)
    briefed = generate.generate_text(
        scenarios,
        generate.briefing_prompt(),
        make_backend,
        generate.default_briefing(),
        error="_briefing_error",
        **settings,
    )
    priced = generate.generate_double(
        briefed,
        generate.cost_prompt(),
        make_backend,
        generate.default_cost(),
        error="_cost_error",
        **settings,
    )
    planned = generate.generate_table(
        settle(priced, "priced"),
        generate.plan_prompt(F.col("briefing"), F.col("financial_impact")),
        make_backend,
        fallback=generate.default_plan(),
        error="_plan_error",
        **settings,
    ).withColumn(impact.HOURS, impact.hours_of_plan(F.col("plan")))
    errors = ["_briefing_error", "_cost_error", "_plan_error"]
    failed = sum((F.col(e).isNotNull().cast("int") for e in errors), F.lit(0))
    return impact.impact_metrics(planned.withColumn("failed_calls", failed).drop(*errors))
