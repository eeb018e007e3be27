"""Quality checks of a raw batch: conditions from one scan, each repeated key from a scan of its own column, a row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendloom.functions.expressions import blank_to_null, has_field, variant_text
from lendloom.operators.validation import Reader

#: Lineage that no raw record may lack, and the statuses that the checks know.
AUDIT = ("ingestion_record_id", "entity_name", "raw_record", "source_system", "file_type", "file_name", "load_timestamp", "batch_id", "run_mode")
CUSTOMER_STATUSES = ("ACTIVE", "INACTIVE", "SUSPENDED")
APPLICATION_STATUSES = ("SUBMITTED", "UNDER_REVIEW", "APPROVED", "REJECTED")
DECIDED = ("APPROVED", "REJECTED")
PAYMENT_FIELDS = ("payment_id", "application_id", "payment_date", "payment_amount", "payment_status", "payment_method", "updated_at")


def _any(conditions: list[Column]) -> Column:
    """Whether one holds; unknown counts as no."""
    out = F.lit(False)
    for c in conditions:
        out = out | F.coalesce(c, F.lit(False))
    return out


def _field(name: str) -> Column:
    return variant_text("raw_record", name)


def _blank(*fields: str) -> list[Column]:
    return [blank_to_null(_field(f)).isNull() for f in fields]


def _not_a_date(field: str) -> Column:
    return F.try_to_date(_field(field)).isNull()


def _not_a_time(field: str) -> Column:
    return _field(field).try_cast("timestamp_ntz").isNull()


def _no_amount(field: str) -> Column:
    return _field(field).try_cast("decimal(18,2)").isNull()


def _other_status(field: str, known: tuple[str, ...]) -> Column:
    """Another value; a JSON null is no value."""
    return ~F.upper(_field(field)).isin(*known)


def _undecided() -> Column:
    """Approved or rejected without a date of decision."""
    return F.upper(_field("application_status")).isin(*DECIDED) & _not_a_date("decision_date")


def raw_checks(raw: DataFrame, expected_rows: int, key: str, missing: Column, invalid: dict[str, Column], value: Reader = _field) -> DataFrame:
    """(check_name, expected_value, actual_value, variance, check_status) for one batch of raw records.

    missing: whether a record lacks a business field. invalid: further checks, by name, as conditions that no record may
    meet. value reads a field of the record. The checks for repeated values count the values that occur more than once; a
    missing id or key is a value like others, a missing hash isn't.
    """
    tested = raw.select("ingestion_record_id", "record_hash", value(key).alias("_key"), F.coalesce(missing, F.lit(False)).alias("_missing"), _any([F.col(c).isNull() for c in AUDIT]).alias("_empty"), *(F.coalesce(c, F.lit(False)).alias(f"_{n}") for n, c in invalid.items()))
    flat = tested.agg(F.count("*").alias("ROW_COUNT"), F.count_if("_empty").alias("NULL_MANDATORY_AUDIT_COLUMNS"), F.count_if(F.col("record_hash").isNull()).alias("NULL_RECORD_HASH"), F.count_if("_missing").alias("MISSING_BUSINESS_FIELDS"), *(F.count_if(f"_{n}").alias(n) for n in invalid))
    repeated = {"DUPLICATE_INGESTION_RECORD_ID": "ingestion_record_id", "DUPLICATE_RECORD_HASH": "record_hash", f"DUPLICATE_{key.upper()}": "_key"}
    counted = None
    for name, column in repeated.items():  # each by itself, so that only counts by value are shuffled
        held = tested.where(F.col(column).isNotNull()) if column == "record_hash" else tested
        own = held.groupBy(column).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("actual_value")).select(F.lit(name).alias("check_name"), "actual_value")
        counted = own if counted is None else counted.unionByName(own)
    rows = flat.select(F.explode(F.array(*(F.struct(F.lit(n).alias("check_name"), F.col(n).alias("actual_value")) for n in flat.columns))).alias("x")).select("x.*").unionByName(counted)
    expected = F.when(F.col("check_name") == "ROW_COUNT", F.lit(expected_rows)).otherwise(0).cast("long")
    rows = rows.select("check_name", expected.alias("expected_value"), "actual_value")
    return rows.withColumn("variance", F.col("actual_value") - F.col("expected_value")).withColumn("check_status", F.when(F.col("variance") == 0, "PASS").otherwise("FAIL"))


def customers_checks(raw: DataFrame, expected_rows: int) -> DataFrame:
    """The nine checks of a batch of customers. A missing status is invalid, a JSON null isn't counted."""
    invalid = {"INVALID_CUSTOMER_STATUS": _other_status("customer_status", CUSTOMER_STATUSES) | ~has_field("raw_record", "customer_status"), "INVALID_TIMESTAMP_VALUES": _not_a_time("created_at") | _not_a_time("updated_at")}
    return raw_checks(raw, expected_rows, "customer_id", _any(_blank("customer_id", "customer_name", "email")), invalid)


def applications_checks(raw: DataFrame, expected_rows: int) -> DataFrame:
    """The nine checks of a batch of applications; a date or amount that can't be read counts as missing."""
    missing = _any([*_blank("application_id", "customer_id", "application_status"), _not_a_date("application_date"), _no_amount("requested_amount")])
    invalid = {"INVALID_APPLICATION_STATUS": _other_status("application_status", APPLICATION_STATUSES) | ~has_field("raw_record", "application_status"), "INVALID_DECISION_DATE": _undecided()}
    return raw_checks(raw, expected_rows, "application_id", missing, invalid)


def _listed(raw: DataFrame, wrong: list[Column]) -> DataFrame:
    return raw.where(_any(wrong)).select("ingestion_record_id", "file_name", "file_row_number", "raw_record")


def invalid_customers(raw: DataFrame) -> DataFrame:
    """Customer records that lack a business field or hold a status or time that can't be."""
    return _listed(raw, [*_blank("customer_id", "customer_name", "email"), _other_status("customer_status", CUSTOMER_STATUSES), _not_a_time("created_at"), _not_a_time("updated_at")])


def invalid_applications(raw: DataFrame) -> DataFrame:
    """Application records that lack a field, hold a value that can't be, or are decided without a date."""
    return _listed(raw, [*_blank("application_id", "customer_id"), _other_status("application_status", APPLICATION_STATUSES), _not_a_date("application_date"), _no_amount("requested_amount"), _undecided()])


def payments_without_required_fields(raw: DataFrame) -> DataFrame:
    """How many payment records lack a field altogether; a JSON null or an empty text is there."""
    return raw.agg(F.count_if(_any([~has_field("raw_record", f) for f in PAYMENT_FIELDS])).alias("invalid_required_fields"))


def status_distribution(rows: DataFrame, status: str) -> DataFrame:
    return rows.groupBy(F.col(status).alias("status")).agg(F.count("*").alias("n_records"))


def summary(rows: DataFrame, id: str, key: str) -> DataFrame:
    """Rows, distinct ids and keys, and how many lack a hash or key."""
    return rows.agg(F.count("*").alias("total_rows"), F.count_distinct("ingestion_record_id").alias("distinct_ids"), F.count_distinct(id).alias("distinct_keys"), F.count_if(F.col("record_hash").isNull()).alias("missing_hashes"), F.count_if(F.col(key).isNull()).alias("missing_keys"))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows without a parent, those without a value included."""
    return child.join(parent.select(F.col(parent_column).alias("_parent")), F.col(column) == F.col("_parent"), "left_anti")


def with_other_status(payments: DataFrame, applications: DataFrame, status: str = "APPROVED") -> DataFrame:
    """Payments of applications in another status."""
    other = applications.where(F.col("application_status") != status).select(F.col("application_id").alias("_id"), "application_status")
    return payments.join(other, F.col("application_id") == F.col("_id")).drop("_id")
