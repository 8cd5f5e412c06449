"""Declared schemas. Nothing is inferred: inference costs a pass and drifts."""

from __future__ import annotations

from pyspark.sql import types as T

from alertloom.fixed import codes


TEXT = T.StringType()
WHOLE = T.LongType()


def record(**fields: T.DataType) -> T.StructType:
    """A struct of nullable fields, usable before any session exists."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def texts(names: str) -> dict[str, T.DataType]:
    return dict.fromkeys(names.split(), TEXT)


def many(kind: T.DataType) -> T.ArrayType:
    return T.ArrayType(kind)


DRUG = record(
    **texts(
        "medicinalproduct drugindication drugdosagetext actiondrug drugcharacterization"
    ),
    openfda=record(brand_name=many(TEXT), manufacturer_name=many(TEXT)),
)
REACTION = record(**texts("reactionmeddrapt reactionoutcome"))
EVENT_REPORT = record(
    **texts(
        "safetyreportid receivedate serious seriousnessother "
        "seriousnesshospitalization seriousnesslifethreatening reporttype "
        "fulfillexpeditecriteria occurcountry companynumb"
    ),
    primarysource=record(qualification=TEXT),
    patient=record(
        patientonsetage=TEXT,
        patientsex=TEXT,
        drug=many(DRUG),
        reaction=many(REACTION),
    ),
)

DEVICE_RECALL = record(
    **texts(
        "recall_number product_description reason_for_recall classification "
        "recalling_firm recall_initiation_date root_cause_description"
    )
)


def _trial(listed: T.DataType) -> T.StructType:
    return record(
        protocolSection=record(
            identificationModule=record(**texts("nctId briefTitle")),
            statusModule=record(overallStatus=TEXT),
            conditionsModule=record(conditions=listed),
            armsInterventionsModule=record(interventions=many(record(name=TEXT))),
            designModule=record(phases=listed, enrollmentInfo=record(count=WHOLE)),
            sponsorCollaboratorsModule=record(leadSponsor=record(name=TEXT)),
        )
    )


CLINICAL_TRIAL = _trial(many(TEXT))
# As it may land: conditions and phases as a list or as plain text.
LANDED_TRIAL = _trial(TEXT)

DRUG_LABEL = record(**texts("setid drug_name"))


def envelope(member: str, item: T.StructType) -> T.StructType:
    """Schema of a landed response: one array of records under ``member``."""
    return record(**{member: many(item)})


# Flat adverse-event file: coded severity and age are numbers, the rest is text.
EVENT_FLAT = T.StructType(
    [
        T.StructField(
            name,
            {"serious": T.LongType(), "patientonsetage": T.DoubleType()}.get(
                name, T.StringType()
            ),
        )
        for name in codes.EVENT_FIELDS
    ]
)

RECALL_FLAT = record(
    **texts("WEB_ADDRESS RECALL_NUMBER PRODUCT_DESCRIPTION TRADE_NAME"),
    RECALL_CLASS=WHOLE,
    **texts(
        "CENTER CENTER_CLASSIFICATION_DT POSTED_INTERNET_DT TERMINATION_DT FIRM_NAME "
        "MANUFACTURER_RECALL_REASON"
    ),
)

# A notice file has two columns and three blank headers; the blank ones are dropped.
NOTICE = record(**texts("Date Title _blank1 _blank2 _blank3"))
SAFETY_NOTICE = record(**{"Date": TEXT, "Safety Alert": TEXT, "Product Type": TEXT})

# Canonical record as written: text throughout except the count.
RECORD = T.StructType(
    [
        T.StructField(
            name, T.LongType() if name == "adverse_event_count" else T.StringType()
        )
        for name in codes.RECORD_FIELDS
    ]
)
RECORD_TEXT = T.StructType(
    [T.StructField(name, T.StringType()) for name in codes.RECORD_FIELDS]
)

RESPONSE = record(
    candidates=many(
        record(content=record(parts=many(record(text=TEXT))), finish_reason=TEXT)
    )
)
