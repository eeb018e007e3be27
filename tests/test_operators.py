import datetime as dt

import pytest
from pyspark.sql import functions as F

from lendloom.functions.expressions import UNKNOWN, checked_name, full_match, initcap_words, safe_pct, surrogate_key, unknown_key
from lendloom.operators import assertions, current_state, gold, staging, validation
from lendloom.plans import contracts

T = dt.datetime


def test_expressions(spark):
    df = spark.createDataFrame([("new-york CITY o'neil/lee", "a.csv.gz", None)], "city string, file string, none string")
    row = df.select(initcap_words("city").alias("c"), initcap_words("none").alias("n"), full_match("file", r".*[.]csv").alias("m"), surrogate_key("file", "none").alias("k"), unknown_key().alias("u"), safe_pct(F.lit(1), F.lit(3)).alias("p"), safe_pct(F.lit(1), F.lit(0)).alias("z")).first()
    assert row.c == "New-York City O'neil/Lee"
    assert row.n is None
    assert row.m is False
    assert row.u == "6fe5883c0f28ec87ce1b3e3a834c840a"
    assert len(row.k) == 32
    assert float(row.p) == 33.33
    assert row.z is None
    with pytest.raises(ValueError):
        checked_name("RAW.X; drop table Y")


SILVER = "customer_id string, updated_at timestamp, created_at timestamp, load_timestamp timestamp, file_last_modified timestamp, ingestion_record_id string, record_hash string"


def record(key, updated, loaded, hash, modified=None, id="r"):
    return (key, updated, None, loaded, modified, id, hash)


TARGET = [record("C1", T(2026, 9, 3, 12), T(2026, 8, 30, 12), "old"), record("C2", T(2026, 9, 4), T(2026, 9, 4, 12), "x")]


@pytest.mark.parametrize(
    ("incoming", "expected"),
    [
        (record("C1", T(2026, 9, 2, 12), T(2026, 9, 4, 13), "late"), []),
        (record("C1", T(2026, 9, 5, 12), T(2026, 9, 4, 13), "new"), ["new"]),
        (record("C1", T(2026, 9, 3, 12), T(2026, 8, 30, 12), "tie"), []),
        (record("C9", T(2026, 9, 1), T(2026, 9, 4), "unseen"), ["unseen"]),
        (record("C9", T(2026, 9, 1), T(2026, 8, 1), "before the look-back"), []),
        (record(None, T(2026, 9, 5), T(2026, 9, 5), "no key"), []),
        (record("C1", T(2026, 9, 5), T(2026, 9, 5), None), [None]),
    ],
)
def test_delta(spark, incoming, expected):
    got = current_state.delta(spark.createDataFrame([incoming], SILVER), spark.createDataFrame(TARGET, SILVER), current_state.CUSTOMERS)
    assert [r.record_hash for r in got.collect()] == expected


def test_first_run_takes_the_latest_of_all_and_merge_replaces(spark):
    staged = spark.createDataFrame([record("C1", T(2026, 1, 1), T(2026, 1, 1), "a"), record("C1", T(2026, 1, 2), T(2026, 1, 1), "b")], SILVER)
    first = current_state.delta(staged, None, current_state.CUSTOMERS)
    assert [r.record_hash for r in first.collect()] == ["b"]
    wider = spark.createDataFrame([("C1", "c", 1)], "customer_id string, record_hash string, extra int")
    merged = current_state.merge(first, wider, "customer_id").collect()
    assert [(r.record_hash, r.extra, r.updated_at) for r in merged] == [("c", 1, None)]


def errors_of(spark, contract, payload):
    df = spark.createDataFrame([(payload,)], "j string").select(F.parse_json("j").alias("raw_record"))
    return [(e.field, e.code) for e in validation.validate(df, contract).first().validation_errors]


GOOD = '{"customer_id": "1", "customer_name": "n", "email": "a@b.c", "customer_status": %s, "created_at": "2026-01-01"}'


@pytest.mark.parametrize(
    ("status", "expected"),
    [
        ('" active "', []),
        ('"SUSPENDED"', ["INVALID_ACCEPTED_VALUE"]),
        ("null", ["INVALID_ACCEPTED_VALUE", "REQUIRED_FIELD_MISSING"]),
        ('""', ["INVALID_ACCEPTED_VALUE", "REQUIRED_FIELD_MISSING"]),
        ('"  "', ["INVALID_ACCEPTED_VALUE", "REQUIRED_FIELD_MISSING"]),
    ],
)
def test_status_rule(spark, status, expected):
    assert [code for _, code in errors_of(spark, contracts.CUSTOMERS, GOOD % status)] == expected


@pytest.mark.parametrize(("amount", "bad"), [('"10.5"', False), ("3", False), ('"0"', True), ("-5", True), ('"abc"', True)])
def test_amount_rule(spark, amount, bad):
    payload = '{"application_id": "1", "customer_id": "1", "application_status": "APPROVED", "application_date": "2026-01-01", "requested_amount": %s}' % amount
    assert (("requested_amount", "VALUE_NOT_GREATER_THAN") in errors_of(spark, contracts.APPLICATIONS, payload)) is bad


def test_pattern_rule_and_missing_fields(spark):
    assert ("email", "PATTERN_MISMATCH") in errors_of(spark, contracts.CUSTOMERS, '{"email": "not-an-email"}')
    assert errors_of(spark, contracts.CUSTOMERS, "{}") == [(f, "REQUIRED_FIELD_MISSING") for f in sorted(contracts.CUSTOMERS.required_fields)]


def test_contract_rules_fail_closed():
    with pytest.raises(ValueError):
        contracts.Contract("X", "1", "CSV", "", "", "R.X", ("a",), (), ("a",), (contracts.Rule("a", "NO_SUCH_RULE"),))
    with pytest.raises(ValueError):
        contracts.Contract("X", "1", "CSV", "", "", "R.X", ("a",), (), ("a",), (contracts.Rule("a", "ACCEPTED_VALUES"),))


def test_staging_types(spark):
    raw = spark.createDataFrame([('{"application_id": " 7 ", "application_status": "approved", "application_date": "2026-01-05", "requested_amount": "12.345", "decision_date": null}',)], "j string").select(F.parse_json("j").alias("raw_record"), F.lit("h").alias("record_hash"))
    row = staging.stg_applications(raw).first()
    assert (row.application_id, row.application_status, row.application_date, str(row.requested_amount), row.decision_date) == ("7", "APPROVED", dt.date(2026, 1, 5), "12.35", None)


def gold_tables(spark):
    line = "source_system string, source_date date, load_timestamp timestamp"
    customers = spark.createDataFrame([("C1", "Ann", "a@b", "X", "ACTIVE", None, None, "S3", None, None), ("C2", "Bo", "b@b", "Y", "ACTIVE", None, None, "S3", None, None)], f"customer_id string, customer_name string, email string, city string, customer_status string, created_at timestamp_ntz, updated_at timestamp_ntz, {line}")
    applications = spark.createDataFrame([("A1", "C1", "APPROVED", dt.date(2026, 1, 1), 100, dt.date(2026, 1, 3), "S3", None, None), ("A2", "nobody", "SUBMITTED", dt.date(2026, 1, 1), 50, None, "S3", None, None)], f"application_id string, customer_id string, application_status string, application_date date, requested_amount long, decision_date date, {line}")
    payments = spark.createDataFrame([("P1", "A1", "COMPLETED", T(2026, 1, 2, 23), None, 40, "S3", None, None), ("P2", "gone", "FAILED", T(2026, 1, 2), "CARD", 5, "S3", None, None)], f"payment_id string, application_id string, payment_status string, payment_date timestamp_ntz, payment_method string, payment_amount long, {line}")
    return customers, applications, payments.withColumn("payment_amount", F.col("payment_amount").cast("decimal(18,2)"))


def test_gold_orphans_and_unknown_members(spark):
    customers, applications, payments = gold_tables(spark)
    dim_c = gold.dim_customers(customers)
    dim_a = gold.dim_applications(applications, dim_c)
    unknown = dim_c.where("is_unknown_customer").first()
    assert unknown.customer_id == UNKNOWN
    by_id = {r.application_id: r for r in dim_a.collect()}
    assert by_id["A2"].is_orphan_customer and by_id["A2"].customer_key == unknown.customer_key
    facts = {r.payment_id: r for r in gold.fct_payments(payments, dim_a).collect()}
    assert facts["P2"].is_orphan_application and facts["P2"].days_from_decision_to_payment is None
    assert facts["P1"].days_from_decision_to_payment == -1
    fa, fp = gold.fct_applications(dim_a), gold.fct_payments(payments, dim_a)
    assert {r.payment_method for r in gold.mart_payment_summary(fp).collect()} == {"UNKNOWN", "CARD"}
    mart = {r.customer_id: r for r in gold.mart_customer_summary(dim_c, fa, fp).collect()}
    assert mart["C2"].has_no_applications and not mart["C2"].has_no_completed_payment and mart["C2"].average_decision_days is None
    assert mart["C1"].completed_payment_count == 1 and mart["C1"].average_decision_days == 2
    assert gold.dim_date(spark).count() == 4018


def test_assertions(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, None), (2, "z")], "k int, v string")
    found = assertions.failures({"not_null": assertions.not_null(df, "k"), "unique": assertions.unique(df, "k"), "accepted": assertions.accepted_values(df, "v", ["a", "b"]), "related": assertions.relationships(df, "k", df.where("k = 1"), "k"), "true": assertions.expression_is_true(df, "k > 1"), "true_where": assertions.expression_is_true(df, "k >= 1", "k is not null")})
    assert found == {"not_null": 1, "unique": 1, "accepted": 1, "related": 1, "true": 3, "true_where": 0}
    folded = assertions.failing_counts(("k",), {"v": ("a", "b")}, {"k > 1": None, "k >= 1": "k is not null"})
    counts = df.agg(*(c.alias(" ".join(t)) for t, c in folded.items())).first().asDict()
    assert counts == {"not_null k": 1, "accepted v": 1, "true k > 1": 3, "true k >= 1": 0}


def test_rules_as_data_are_the_compiled_rules(spark):
    strict = type(contracts.CUSTOMERS)(**{**contracts.CUSTOMERS.__dict__, "contract_version": "2.0", "required_fields": ("city",), "rules": (contracts.Rule("customer_id", "GREATER_THAN", bound="2"), contracts.Rule("city", "REGEX", pattern="a|bc"))})
    texts = ['{"customer_id": "1", "customer_name": "n", "email": "a@b.c", "customer_status": " active ", "created_at": "x", "city": "xbc"}', '{"customer_id": null, "email": "bad", "customer_status": null, "city": "bc"}', '{"customer_id": 3, "city": " ", "customer_status": "SUSPENDED"}', "{}"]
    work = spark.createDataFrame([(i, t, v) for i, t in enumerate(texts) for v in ("1.0", "2.0")], "i int, t string, contract_version string").select("i", F.parse_json("t").alias("raw_record"), F.lit(contracts.CUSTOMERS.contract_id).cast("long").alias("contract_id"), "contract_version")
    rules = validation.rule_table(spark, (contracts.CUSTOMERS, strict))
    got = {(r.i, r.contract_version): (r.validation_errors, r.validation_status) for r in validation.validate_by_rules(work, rules).collect()}
    want = {(r.i, c.contract_version): (r.validation_errors, r.validation_status) for c in (contracts.CUSTOMERS, strict) for r in validation.validate(work.where(F.col("contract_version") == c.contract_version), c).collect()}
    assert got == want and len(got) == 8
    with pytest.raises(Exception, match="no contract"):
        validation.validate_by_rules(work, rules.where("contract_version = '1.0'")).collect()
