"""Aged documents from canonical records: routing, texts, names, statistics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertloom.fixed import documents as fixed
from alertloom.functions import dates, seeded, text
from alertloom.operators import sample

TEMPLATE = "template"
COPIES_PER_ROW = 10_000


def route(keys: Sequence[Column], seed: int | str = 42) -> Column:
    """Template by what the record is about; a recalled device comes first."""
    drug, device, condition, reason = (
        text.is_filled(F.col(c))
        for c in ("drug_name", "device_name", "condition", "recall_reason")
    )

    def one_of(options: Sequence[str]) -> Column:
        return seeded.choice(options, *keys, seed=f"{seed}-template")

    return (
        F.when(device & reason, fixed.DEVICE_TEMPLATE)
        .when(drug, one_of(fixed.DRUG_TEMPLATES))
        .when(condition, one_of(fixed.CONDITION_TEMPLATES))
        .otherwise(one_of(fixed.OTHER_TEMPLATES))
    )


def _defaults(defaults: Mapping[str, str]) -> dict[str, Column]:
    return {n: F.coalesce(F.col(n), F.lit(d)) for n, d in defaults.items()}


def _frame(
    template: str,
    subject: Column,
    keys: Sequence[Column],
    as_of: dt.date | str,
    age_days: tuple[int, int],
    seed: int | str,
) -> dict[str, Column]:
    """What all documents share: title, underline, dates and number."""
    title = text.fill(fixed.TEMPLATES[template][0], {"subject": subject})
    today = dates.day(as_of)
    age = seeded.integer_between(*age_days, *keys, seed=f"{seed}-{template}-age")
    return {
        "title": title,
        "underline": F.repeat(F.lit("="), F.length(title)),
        "subject": subject,
        "today": F.date_format(today, dates.LONG_FORMAT),
        "revised": F.date_format(
            F.date_sub(today, age.cast("int")), dates.MONTH_FORMAT
        ),
        "number": seeded.integer_between(
            *fixed.DOCUMENT_NUMBER, *keys, seed=f"{seed}-{template}-number"
        ),
    }


def training_memo(
    keys: Sequence[Column], as_of: dt.date | str, seed: int | str = 42
) -> Column:
    subject = text.first_filled(
        [F.col("drug_name"), F.col("device_name")],
        F.col("condition"),
        fixed.MEMO_SUBJECT_DEFAULT,
    )
    values = _frame("training_memo", subject, keys, as_of, fixed.MEMO_AGE_DAYS, seed)
    values |= _defaults(fixed.MEMO_DEFAULTS)
    for name, line in (
        ("old_dosage", fixed.MEMO_DOSAGE_LINE),
        ("old_warning", fixed.MEMO_WARNING_LINE),
        ("old_indication", fixed.MEMO_INDICATION_LINE),
    ):
        slot = name.removeprefix("old_") + "_line"
        values[slot] = text.line_if_filled(line, name, F.col(name))
    return text.fill(fixed.MEMO, values)


def safety_alert(
    keys: Sequence[Column], as_of: dt.date | str, seed: int | str = 42
) -> Column:
    subject = text.first_filled(
        [F.col("drug_name")], F.col("device_name"), fixed.ALERT_SUBJECT_DEFAULT
    )
    values = _frame("safety_alert", subject, keys, as_of, fixed.ALERT_AGE_DAYS, seed)
    values |= _defaults(fixed.ALERT_DEFAULTS)
    reason = F.col("recall_reason")
    values["issue"] = (
        F.when(
            text.is_filled(reason),
            text.fill(fixed.ALERT_RECALL_ISSUE, {"recall_reason": reason}),
        )
        .when(text.is_filled(F.col("new_warning")), fixed.ALERT_WARNING_ISSUE)
        .otherwise(fixed.ALERT_OTHER_ISSUE)
    )
    return text.fill(fixed.ALERT, values)


def research_summary(
    keys: Sequence[Column], as_of: dt.date | str, seed: int | str = 42
) -> Column:
    subject = text.first_filled(
        [F.col("condition")], F.col("drug_name"), fixed.SUMMARY_SUBJECT_DEFAULT
    )
    values = _frame(
        "research_summary", subject, keys, as_of, fixed.SUMMARY_AGE_DAYS, seed
    )
    values |= _defaults(fixed.SUMMARY_DEFAULTS)
    values["trial_line"] = text.line_if_filled(
        fixed.SUMMARY_TRIAL_LINE, "clinical_trial_id", F.col("clinical_trial_id")
    )
    values["next_review"] = F.date_format(
        F.date_add(dates.day(as_of), fixed.SUMMARY_REVIEW_DAYS), dates.MONTH_FORMAT
    )
    return text.fill(fixed.SUMMARY, values)


def _page_values(
    template: str,
    subject: Column,
    fields: Mapping[str, tuple[str, str]],
    choices: Mapping[str, Sequence[str]],
    keys: Sequence[Column],
    as_of: dt.date | str,
    seed: int | str,
) -> dict[str, Column]:
    """The slots of a document laid out on pages: fields with defaults, and choices by the row's key."""
    values = _frame(template, subject, keys, as_of, fixed.PAGE_AGE_DAYS[template], seed)
    values |= {slot: F.coalesce(F.col(name), F.lit(default)) for slot, (name, default) in fields.items()}
    return values | {
        slot: seeded.choice(options, *keys, seed=f"{seed}-{template}-{slot}") for slot, options in choices.items()
    }


def medication_protocol(
    keys: Sequence[Column],
    as_of: dt.date | str,
    seed: int | str = 42,
    template: str = "medication_protocol",
) -> Column:
    """Also the form of a formulary entry, which differs by its title."""
    subject = F.coalesce(F.col("drug_name"), F.lit(fixed.PROTOCOL_SUBJECT_DEFAULT))
    values = _page_values(template, subject, fixed.PROTOCOL_FIELDS, fixed.PROTOCOL_CHOICES, keys, as_of, seed)
    today = F.date_format(dates.day(as_of), dates.ISO_FORMAT)
    values["approved"] = F.coalesce(F.col("fda_approval_date"), today)
    return text.fill(fixed.PROTOCOL, values)


def device_manual(keys: Sequence[Column], as_of: dt.date | str, seed: int | str = 42) -> Column:
    """A recalled device has a notice before the part on maintenance."""
    subject = F.coalesce(F.col("device_name"), F.lit(fixed.MANUAL_SUBJECT_DEFAULT))
    values = _page_values(
        "device_manual", subject, fixed.MANUAL_FIELDS, fixed.MANUAL_CHOICES, keys, as_of, seed
    )
    reason = F.col("recall_reason")
    notice = text.fill(fixed.MANUAL_RECALL, values | {"recall_reason": reason})
    values["recall"] = F.when(text.is_filled(reason), notice).otherwise("")
    return text.fill(fixed.MANUAL, values)


def clinical_guideline(keys: Sequence[Column], as_of: dt.date | str, seed: int | str = 42) -> Column:
    """Recommends a therapy where the record names a drug."""
    subject = F.coalesce(F.col("condition"), F.lit(fixed.GUIDELINE_SUBJECT_DEFAULT))
    values = _page_values(
        "clinical_guideline", subject, fixed.GUIDELINE_FIELDS, fixed.GUIDELINE_CHOICES, keys, as_of, seed
    )
    drug = F.col("drug_name")
    therapy = text.fill(fixed.GUIDELINE_DRUG, values | {"drug_name": drug})
    values["therapy"] = F.when(text.is_filled(drug), therapy).otherwise("")
    return text.fill(fixed.GUIDELINE, values)


def nursing_protocol(keys: Sequence[Column], as_of: dt.date | str, seed: int | str = 42) -> Column:
    """How to give the drug, or how to care for the condition where no drug is named."""
    drug = F.col("drug_name")
    subject = text.first_filled([drug], F.col("condition"), fixed.NURSING_SUBJECT_DEFAULT)
    values = _page_values(
        "nursing_protocol", subject, fixed.NURSING_FIELDS, fixed.NURSING_CHOICES, keys, as_of, seed
    )
    today = F.date_format(dates.day(as_of), dates.ISO_FORMAT)
    values["updated"] = F.coalesce(F.col("update_date").cast("string"), today)
    given = text.fill(fixed.NURSING_DRUG, values | {"drug_name": drug})
    values["care"] = F.when(text.is_filled(drug), given).otherwise(text.fill(fixed.NURSING_CARE, values))
    return text.fill(fixed.NURSING, values)


def document_text(
    keys: Sequence[Column], as_of: dt.date | str, seed: int | str = 42
) -> Column:
    """Text of the routed template. Those laid out on pages have their text, without the layout."""
    texts = {
        "training_memo": training_memo(keys, as_of, seed),
        "safety_alert": safety_alert(keys, as_of, seed),
        "research_summary": research_summary(keys, as_of, seed),
        "medication_protocol": medication_protocol(keys, as_of, seed),
        "formulary_entry": medication_protocol(keys, as_of, seed, "formulary_entry"),
        "device_manual": device_manual(keys, as_of, seed),
        "clinical_guideline": clinical_guideline(keys, as_of, seed),
        "nursing_protocol": nursing_protocol(keys, as_of, seed),
    }
    return F.coalesce(*[F.when(F.col(TEMPLATE) == name, body) for name, body in texts.items()])


def age_days(keys: Sequence[Column], years: int, seed: int | str = 42) -> Column:
    return seeded.integer_between(
        fixed.MIN_AGE_DAYS, fixed.DAYS_PER_YEAR * years, *keys, seed=f"{seed}-age"
    )


def file_name(
    template: Column,
    file_format: Column,
    sequence: Column,
    keys: Sequence[Column],
    as_of: dt.date | str,
    years: int,
    seed: int | str = 42,
) -> Column:
    """``date_template_sequence_name.format``; the date is a seeded past day."""
    subject = text.first_filled(
        [F.col("drug_name"), F.col("device_name")],
        F.col("condition"),
        fixed.FILE_NAME_DEFAULT,
    )
    written = F.date_sub(dates.day(as_of), age_days(keys, years, seed).cast("int"))
    stem = F.concat_ws(
        "_",
        dates.iso(written),
        template,
        sequence.cast("string"),
        text.alphanumeric_head(subject, fixed.FILE_NAME_CHARS),
    )
    return F.concat(stem, F.lit("."), file_format)


def file_format(template: Column) -> Column:
    formats = {name: spec[1] for name, spec in fixed.TEMPLATES.items()}
    result = None
    for name, kind in formats.items():
        condition = template == name
        result = (
            F.when(condition, kind) if result is None else result.when(condition, kind)
        )
    return result


def has_image(keys: Sequence[Column], seed: int | str = 42) -> Column:
    return seeded.happens(fixed.IMAGE_SHARE, *keys, seed=f"{seed}-image")


def documents(
    records: DataFrame,
    keys: Sequence[str],
    as_of: dt.date | str,
    years: int = 5,
    seed: int | str = 42,
    sequence: str | None = None,
) -> DataFrame:
    """One document per record: template, format, file name, text, image flag."""
    key_columns = [F.col(k) for k in keys]
    number = F.col(sequence) if sequence else key_columns[0]
    routed = records.withColumn(TEMPLATE, route(key_columns, seed)).withColumn(
        "format", file_format(F.col(TEMPLATE))
    )
    return routed.select(
        *keys,
        TEMPLATE,
        "format",
        file_name(
            F.col(TEMPLATE), F.col("format"), number, key_columns, as_of, years, seed
        ).alias("file_name"),
        document_text(key_columns, as_of, seed).alias("text"),
        has_image(key_columns, seed).alias("has_image"),
        file_name(
            F.lit(fixed.IMAGE_TEMPLATE),
            F.lit(fixed.IMAGE_FORMAT),
            number,
            key_columns,
            as_of,
            years,
            seed,
        ).alias("image_name"),
    )


def spread(
    records: DataFrame,
    total: int,
    available: int,
    keys: Sequence[str],
    seed: int | str = 42,
) -> DataFrame:
    """Records repeated or sampled to give exactly ``total`` rows.

    Every record is used equally often; the remainder is an exact seeded sample.
    ``available`` is the number of records. Column ``copy`` tells repeats apart.
    """
    if available == 0 or total == 0:
        return records.limit(0).withColumn("copy", F.lit(0))
    whole, rest = divmod(total, available)
    parts = []
    if whole:
        parts.append(_copies(records, whole))
    if rest:
        extra = sample.sample_exact(records, rest, keys, seed)
        parts.append(extra.withColumn("copy", F.lit(whole)))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _copies(records: DataFrame, times: int) -> DataFrame:
    """Every record ``times`` over. Many copies are split among tasks first."""
    if times <= COPIES_PER_ROW:
        return records.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    chunks = -(-times // COPIES_PER_ROW)
    split = records.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    ).repartition("_chunk")
    start = F.col("_chunk") * COPIES_PER_ROW
    end = F.least(start + COPIES_PER_ROW, F.lit(times)) - 1
    return split.withColumn("copy", F.explode(F.sequence(start, end))).drop("_chunk")


def corpus_stats(docs: DataFrame) -> DataFrame:
    """Documents per template, images, and the grand total; zero counts stay listed.

    One pass with one count per kind: the kinds are a fixed list, so nothing is
    shuffled by template and a large template is no hot group.
    """
    kinds = {
        name: F.count_if(F.col(TEMPLATE) == name) for name in fixed.TEMPLATES
    }
    kinds[fixed.IMAGES] = F.count_if("has_image")
    counts = docs.agg(*[column.alias(name) for name, column in kinds.items()])
    total = sum((F.col(name) for name in kinds), F.lit(0))
    rows = [
        F.struct(F.lit(name).alias("kind"), F.col(name).alias("documents"))
        for name in kinds
    ]
    rows.append(F.struct(F.lit("total").alias("kind"), total.alias("documents")))
    return counts.select(F.inline(F.array(*rows)))
