"""Prompts, batch generation through a pluggable backend, and default answers.

The default answers are plain column expressions. Only a real backend crosses
to Python: in Arrow batches, one backend per task, each distinct prompt once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertloom import schemas
from alertloom.fixed import analysis as fixed
from alertloom.functions import text
from alertloom.session import settle

PROMPT = "prompt"
RESPONSE = "response"
ERROR = "error"
BATCH = 64
PROMPTS_PER_TASK = 1024


class Backend(Protocol):
    """Answers a batch of prompts; one answer per prompt, in the same order."""

    def complete(self, prompts: Sequence[str], **options) -> Sequence[str | None]: ...


# --- prompts -----------------------------------------------------------------


def _shown(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(fixed.NULL_TEXT))


def briefing_prompt() -> Column:
    return text.fill(
        fixed.BRIEFING_PROMPT,
        {
            "entity": _shown(F.col("clinical_entity")),
            "risk": _shown(F.col("risk_level")),
            "old_warning": _shown(F.col("old_warning")),
            "new_warning": _shown(F.col("new_warning")),
            "significance": _shown(F.col("clinical_significance")),
        },
    )


def cost_prompt() -> Column:
    return text.fill(
        fixed.COST_PROMPT,
        {
            "entity": _shown(F.col("clinical_entity")),
            "risk": _shown(F.col("risk_level")),
            "impact": _shown(F.col("patient_safety_impact")),
            "significance": _shown(F.col("clinical_significance")),
        },
    )


def plan_prompt(briefing: Column, cost: Column) -> Column:
    return text.fill(
        fixed.PLAN_PROMPT,
        {"briefing": _shown(briefing), "cost": _shown(text.dollars(cost))},
    )


# --- default answers ---------------------------------------------------------


def default_briefing() -> Column:
    return text.fill(fixed.BRIEFING, {"entity": _shown(F.col("clinical_entity"))})


def default_cost() -> Column:
    """Cost by risk, as BIGINT."""
    amount = F.lit(None).cast("bigint")
    for risk, dollars in fixed.COST_BY_RISK.items():
        amount = F.when(F.col("risk_level") == risk, F.lit(dollars)).otherwise(amount)
    return F.coalesce(amount, F.lit(fixed.COST_OTHERWISE)).cast("bigint")


def default_plan() -> Column:
    """The fixed plan as an array of structs, so no join is needed to attach it."""
    return F.array(
        *[
            F.struct(
                F.lit(department).alias("department"),
                F.lit(priority).alias("priority"),
                F.lit(action).alias("key_action"),
                F.lit(hours).cast("bigint").alias("estimated_hours"),
            )
            for department, priority, action, hours in fixed.ACTION_PLAN
        ]
    )


def cost_breakdown(
    df: DataFrame, keep: Sequence[str], cost: str = "financial_impact"
) -> DataFrame:
    """Four rows per scenario, one per cost factor."""
    rows = [
        F.struct(
            F.lit(label).alias("cost_factor"),
            F.lit(share).alias("share_percent"),
            (F.col(cost).cast("double") * share / 100).alias("amount"),
        )
        for label, share in fixed.COST_SHARES
    ]
    return df.select(*keep, F.inline(F.array(*rows)))


def plan_rows(df: DataFrame, keep: Sequence[str], plan: str = "plan") -> DataFrame:
    """One row per plan step; a scenario without a plan has none."""
    return df.select(*keep, F.inline(plan))


# --- generation --------------------------------------------------------------


def _answers(
    make_backend: Callable[[], Backend], options: dict, batch: int
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def ask(backend: Backend, prompts: list[str]) -> list[tuple[str | None, str | None]]:
        """(answer, error) of each prompt; a batch that fails is asked again in halves."""
        try:
            answers = list(backend.complete(prompts, **options))
            if len(answers) != len(prompts):
                raise ValueError(f"{len(answers)} answers to {len(prompts)} prompts")
            return [(answer, None) for answer in answers]
        except Exception as error:  # whatever a backend raises, its rows fall back
            if len(prompts) == 1:
                return [(None, f"{type(error).__name__}: {error}")]
            half = len(prompts) // 2
            return ask(backend, prompts[:half]) + ask(backend, prompts[half:])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend = make_backend()
        for frame in frames:
            prompts = frame[PROMPT].tolist()
            found: list[tuple[str | None, str | None]] = []
            for start in range(0, len(prompts), batch):
                found += ask(backend, prompts[start : start + batch])
            answers, errors = zip(*found, strict=True) if found else ((), ())
            columns = {PROMPT: prompts, RESPONSE: answers, ERROR: errors}
            yield pd.DataFrame(columns, dtype=object)

    return run


def responses(
    prompts: DataFrame,
    make_backend: Callable[[], Backend],
    batch: int = BATCH,
    tasks: int | None = None,
    once: bool = True,
    **options,
) -> DataFrame:
    """One row per distinct prompt: the backend's raw answer, or the error it raised.

    A call that fails is tried again in halves down to single prompts, so one prompt
    the backend cannot take costs no other its answer; it has a null answer.

    Distinct prompts are few bytes but slow to answer. They are stored, counted, and
    dealt out in pieces of a bounded number of prompts, and at least one per core, so
    a lost task asks no more than its piece again. ``tasks`` sets the pieces instead.

    With ``once`` the answers are stored before use, so that neither a retry
    downstream nor a second use of the result asks the backend again.
    """
    asked = prompts.select(PROMPT).filter(F.col(PROMPT).isNotNull()).distinct()
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (PROMPT, RESPONSE, ERROR)])
    chosen = {
        "temperature": fixed.TEMPERATURE,
        "max_output_tokens": fixed.MAX_OUTPUT_TOKENS,
        **options,
    }
    if tasks is None:
        asked = settle(asked, "prompts")
        cores = asked.sparkSession.sparkContext.defaultParallelism
        tasks = max(cores, -(-asked.count() // PROMPTS_PER_TASK))
    answered = asked.repartition(tasks).mapInPandas(_answers(make_backend, chosen, batch), schema)
    return settle(answered, "answers") if once else answered


def _ask(
    df: DataFrame,
    prompt: Column,
    make_backend: Callable[[], Backend],
    read: Callable[[Column], dict[str, Column]],
    error: str | None = None,
    **settings,
) -> DataFrame:
    """Attach what ``read`` takes from the parsed answers.

    Answers are read before they meet the rows, so each is parsed once however
    many rows share its prompt. They meet on the prompt's 256-bit hash. With
    ``error`` a column of that name holds what the backend raised for the row.
    """
    prompted = df.withColumn(PROMPT, prompt)
    parsed = responses(prompted, make_backend, **settings).select(
        F.sha2(PROMPT, 256).alias("_key"),
        F.from_json(RESPONSE, schemas.RESPONSE).alias("_parsed"),
        ERROR,
    )
    fields = [c.alias(n) for n, c in read(F.col("_parsed")).items()]
    if error:
        fields.append(F.col(ERROR).alias(error))
    keyed = prompted.withColumn("_key", F.sha2(PROMPT, 256)).drop(PROMPT)
    return keyed.join(parsed.select("_key", *fields), "_key", "left").drop("_key")


def _answer_fields(parsed: Column) -> dict[str, Column]:
    candidate = F.get(parsed["candidates"], F.lit(0))
    answer = F.get(candidate["content"]["parts"], F.lit(0))["text"]
    reason = F.when(
        answer.isNotNull(), F.coalesce(candidate["finish_reason"], F.lit(fixed.FINISHED))
    )
    return {
        "generated_text": answer,
        "finish_reason": reason,
        "is_truncated": F.coalesce(reason == fixed.TRUNCATED, F.lit(False)),
    }


def unpack_response(response: Column) -> dict[str, Column]:
    """Text, finish reason and truncation flag of a raw answer; bad JSON gives null."""
    return _answer_fields(F.from_json(response, schemas.RESPONSE))


def generate_text(
    df: DataFrame,
    prompt: Column,
    make_backend: Callable[[], Backend],
    fallback: Column,
    output: str = "briefing",
    **settings,
) -> DataFrame:
    """Generated text per row; the fallback where the answer cannot be read."""
    asked = _ask(df, prompt, make_backend, _answer_fields, **settings)
    return asked.withColumns(
        {
            output: F.coalesce("generated_text", fallback),
            "is_truncated": F.coalesce("is_truncated", F.lit(False)),
        }
    ).drop("generated_text")


def number_or(value: Column, fallback: Column) -> Column:
    """A generated number; the fallback for null, zero and anything else."""
    number = value.try_cast("double")
    usable = number.isNotNull() & ~F.isnan(number) & (number != 0)
    return F.when(usable, number).otherwise(fallback.cast("double"))


def generate_double(
    df: DataFrame,
    prompt: Column,
    make_backend: Callable[[], Backend],
    fallback: Column,
    output: str = "financial_impact",
    **settings,
) -> DataFrame:
    """One generated number per row."""

    def read(parsed: Column) -> dict[str, Column]:
        return {"_number": F.trim(_answer_fields(parsed)["generated_text"])}

    asked = _ask(df, prompt, make_backend, read, **settings)
    return asked.withColumn(output, number_or(F.col("_number"), fallback)).drop("_number")


def spark_schema(output_schema: str) -> str:
    """An output schema with warehouse type names, in Spark's names."""
    names = {"INT64": "BIGINT", "FLOAT64": "DOUBLE", "BOOL": "BOOLEAN"}
    fields = []
    for field in output_schema.split(","):
        name, kind = field.split()
        fields.append(f"{name} {names.get(kind.upper(), kind)}")
    return ", ".join(fields)


def generate_table(
    df: DataFrame,
    prompt: Column,
    make_backend: Callable[[], Backend],
    output_schema: str = fixed.PLAN_SCHEMA,
    fallback: Column | None = None,
    output: str = "plan",
    **settings,
) -> DataFrame:
    """A generated table per row, as an array of structs of the wanted schema."""
    rows = T.ArrayType(T.StructType.fromDDL(spark_schema(output_schema)))

    def read(parsed: Column) -> dict[str, Column]:
        return {"_table": F.from_json(_answer_fields(parsed)["generated_text"], rows)}

    asked = _ask(df, prompt, make_backend, read, **settings)
    table = F.col("_table")
    if fallback is not None:
        table = F.when(F.size(table) > 0, table).otherwise(fallback.cast(rows))
    return asked.withColumn(output, table).drop("_table")


# --- the analysis of every scenario ------------------------------------------


def with_defaults(scenarios: DataFrame) -> DataFrame:
    """Briefing, cost and plan from the default answers: a projection, no shuffle."""
    return scenarios.withColumns(
        {
            "briefing": default_briefing(),
            "financial_impact": default_cost(),
            "plan": default_plan(),
        }
    )
