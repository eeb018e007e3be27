"""Data tests that each model must pass, and a run of them over built models."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from lendloom.operators import assertions
from lendloom.operators.gold import APPLICATION_STATUSES, PAYMENT_STATUSES

CUSTOMER_STATUSES = ("ACTIVE", "INACTIVE")
FLAG = (True, False)


@dataclass(frozen=True)
class Tests:
    """Columns that must have no nulls or no repeats, accepted values, (column: model.column) references, and expressions,
    each of the last with an optional condition on the rows it holds for."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: dict[str, tuple] = field(default_factory=dict)
    related: dict[str, str] = field(default_factory=dict)
    true: dict[str, str | None] = field(default_factory=dict)


_LOADED = ("ingestion_record_id", "record_hash", "load_timestamp")
_STAGED = (*_LOADED, "batch_id")
_APPLICATION = ("application_id", "customer_id", "application_status", "application_date", "requested_amount")
_PAYMENT = ("payment_id", "application_id", "payment_amount", "payment_status", "payment_date")

MODEL_TESTS = {
    "stg_customers": Tests(("customer_id", "customer_name", "email", "customer_status", "created_at", *_STAGED), ("ingestion_record_id",), {"customer_status": CUSTOMER_STATUSES}),
    "stg_applications": Tests((*_APPLICATION, *_STAGED), ("application_id", "ingestion_record_id"), {"application_status": APPLICATION_STATUSES}, {"customer_id": "stg_customers.customer_id"}, {"requested_amount > 0": None}),
    "stg_payments": Tests((*_PAYMENT, *_STAGED), ("payment_id", "ingestion_record_id"), {"payment_status": PAYMENT_STATUSES}, {"application_id": "stg_applications.application_id"}, {"payment_amount > 0": None}),
    "silver_customers": Tests(("customer_id", "customer_name", "email", "customer_status", *_LOADED), ("customer_id",), {"customer_status": CUSTOMER_STATUSES}),
    "silver_applications": Tests((*_APPLICATION, *_LOADED), ("application_id",), {"application_status": APPLICATION_STATUSES}, {"customer_id": "silver_customers.customer_id"}, {"requested_amount > 0": None}),
    "silver_payments": Tests((*_PAYMENT, *_LOADED), ("payment_id",), {"payment_status": PAYMENT_STATUSES}, {"application_id": "silver_applications.application_id"}, {"payment_amount > 0": None}),
    "dim_customers": Tests(("customer_key", "customer_id", "customer_name", "customer_status", "is_unknown_customer"), ("customer_key", "customer_id"), {"customer_status": (*CUSTOMER_STATUSES, "UNKNOWN"), "is_unknown_customer": FLAG}),
    "dim_applications": Tests(("application_key", "customer_key", "application_id", "application_status", "requested_amount", "is_orphan_customer", "is_unknown_application"), ("application_key", "application_id"), {"application_status": (*APPLICATION_STATUSES, "UNKNOWN"), "is_orphan_customer": FLAG, "is_unknown_application": FLAG}, {"customer_key": "dim_customers.customer_key"}),
    "dim_date": Tests(("date_key", "calendar_date", "calendar_year", "is_weekend"), ("date_key", "calendar_date"), {"is_weekend": FLAG}),
    "fct_applications": Tests(("application_key", "customer_key", "application_date_key", "application_id", "application_count", "is_orphan_customer"), ("application_key", "application_id"), {"application_count": (1,)}, {"application_key": "dim_applications.application_key", "customer_key": "dim_customers.customer_key", "application_date_key": "dim_date.date_key", "decision_date_key": "dim_date.date_key"}, {"requested_amount > 0": None, "decision_turnaround_days >= 0": "decision_turnaround_days is not null"}),
    "fct_payments": Tests(("payment_key", "application_key", "customer_key", "payment_date_key", "payment_id", "payment_status", "payment_count", "payment_amount", "is_orphan_application"), ("payment_key", "payment_id"), {"payment_status": PAYMENT_STATUSES, "payment_count": (1,), "is_orphan_application": FLAG}, {"application_key": "dim_applications.application_key", "customer_key": "dim_customers.customer_key", "payment_date_key": "dim_date.date_key"}, {"payment_amount > 0": None}),
    "mart_application_performance": Tests(("application_date_key", "application_count", "total_requested_amount", "orphan_application_count"), ("application_date_key",), related={"application_date_key": "dim_date.date_key"}),
    "mart_customer_summary": Tests(("customer_key", "customer_id", "application_count", "payment_count", "has_no_applications", "has_no_completed_payment"), ("customer_key", "customer_id")),
    "mart_payment_summary": Tests(("payment_summary_key", "payment_date_key", "payment_method", "payment_count", "total_payment_amount", "orphan_payment_count"), ("payment_summary_key",), related={"payment_date_key": "dim_date.date_key"}),
}


def failing_rows(models: dict[str, DataFrame], name: str, tests: Tests | None = None) -> dict[str, DataFrame]:
    """The failing rows of each of a model's tests, by the test's name."""
    df, tests, out = models[name], tests or MODEL_TESTS[name], {}
    for c in tests.not_null:
        out[f"{name}.{c}: not null"] = assertions.not_null(df, c)
    for c in tests.unique:
        out[f"{name}.{c}: unique"] = assertions.unique(df, c)
    for c, values in tests.accepted.items():
        out[f"{name}.{c}: accepted values"] = assertions.accepted_values(df, c, list(values))
    for c, to in tests.related.items():
        model, column = to.split(".")
        out[f"{name}.{c}: in {to}"] = assertions.relationships(df, c, models[model], column)
    for expression, where in tests.true.items():
        out[f"{name}: {expression}"] = assertions.expression_is_true(df, expression, where)
    return out


def run_tests(models: dict[str, DataFrame]) -> dict[str, int]:
    """Number of failing rows of every test of the models given, two jobs a model.

    The tests that look at rows alone are one scan of the model; those for repeats and references need a shuffle each.
    """
    out: dict[str, int] = {}
    for name, df in models.items():
        if name not in MODEL_TESTS:
            continue
        tests = MODEL_TESTS[name]
        of_rows = assertions.failing_counts(tests.not_null, tests.accepted, tests.true)
        names = {("not_null", c): f"{name}.{c}: not null" for c in tests.not_null} | {("accepted", c): f"{name}.{c}: accepted values" for c in tests.accepted} | {("true", e): f"{name}: {e}" for e in tests.true}
        if of_rows:
            counted = df.agg(*(count.alias(str(k)) for k, count in enumerate(of_rows.values()))).first()
            out |= {names[test]: counted[str(k)] for k, test in enumerate(of_rows)}
        shuffled = failing_rows(models, name, Tests(unique=tests.unique, related=tests.related))
        out |= assertions.failures(shuffled) if shuffled else {}
    return out
