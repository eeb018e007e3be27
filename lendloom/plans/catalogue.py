"""Registered queries of the lending pipeline and the same queries as DuckDB SQL.

The tables stand in for the entities: customer for customers, orders for applications, lineitem for payments, and events for
raw records with a JSON payload. Results have money as double and dates as text, so that both engines print them alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendloom.functions.expressions import base_name, blank_to_null, full_match, initcap_words, variant_text
from lendloom.operators import assertions, current_state, gold, raw_checks, validation
from lendloom.plans.contracts import Contract, Rule

#: Dates that cover the tables' orders and shipments.
FIRST_DAY, END_DAY = "1995-01-01", "2005-01-01"
#: Shipments loaded before this day are the current-state table, those from three days before it on the increment.
CUT_DAY = "1998-06-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, dates and timestamps as text."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    out = []
    for name, kind in kinds.items():
        c = F.col(name)
        if kind.startswith("decimal"):
            c = c.cast("double")
        elif kind == "date" or kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd" if kind == "date" else "yyyy-MM-dd HH:mm:ss")
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("long")
        out.append(c.alias(name))
    return df.select(*out)


# the entities ---------------------------------------------------------------------------------------------------------


def _lineage(df: DataFrame, *columns: Column | str, loaded: Column) -> DataFrame:
    return df.select(*columns, F.lit("S3").alias("source_system"), F.to_date(loaded).alias("source_date"), loaded.alias("load_timestamp"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    status = F.when(F.col("c_acctbal") < 0, "INACTIVE").otherwise("ACTIVE")
    return _lineage(c, F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("customer_name"), F.concat(F.lower("c_name"), F.lit("@example.org")).alias("email"), F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")).alias("city"), status.alias("customer_status"), F.lit(None).cast("timestamp_ntz").alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("updated_at"), loaded=F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "APPROVED").when(F.col("o_orderstatus") == "O", "SUBMITTED").when(F.col("o_orderpriority").startswith("5"), "REJECTED").otherwise("UNDER_REVIEW")
    o = o.withColumn("application_status", status).withColumn("application_date", F.to_date("o_orderdate"))
    decision = F.when(F.col("application_status").isin("APPROVED", "REJECTED"), F.date_add("application_date", (F.col("o_orderkey") % 30).cast("int")))
    return _lineage(o, F.col("o_orderkey").cast("string").alias("application_id"), F.col("o_custkey").cast("string").alias("customer_id"), "application_status", "application_date", F.col("o_totalprice").cast("decimal(18,2)").alias("requested_amount"), decision.alias("decision_date"), loaded=F.col("o_orderdate"))


def _named_payments(p: DataFrame) -> DataFrame:
    """Shipments with what their versions are told apart and ordered by."""
    record = F.concat_ws("|", *(F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")), *(F.format_string("%.2f", c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")), "l_returnflag", "l_linestatus", F.date_format("l_shipdate", "yyyy-MM-dd"))
    return p.select("*", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("payment_id"), record.alias("ingestion_record_id"), F.col("l_shipdate").alias("payment_date"), F.col("l_shipdate").alias("load_timestamp"), F.lit(None).cast("timestamp_ntz").alias("file_last_modified"))


def _described_payments(p: DataFrame) -> DataFrame:
    """Payment records of named shipments. What follows from them, the hash above all, is better added after a shuffle."""
    returned, line = F.col("l_returnflag"), F.col("l_linestatus")
    status = F.when(returned == "R", "REFUNDED").when(returned == "A", "FAILED").when(line == "F", "PENDING").otherwise("COMPLETED")
    return p.select("payment_id", F.col("l_orderkey").cast("string").alias("application_id"), F.col("l_extendedprice").cast("decimal(18,2)").alias("payment_amount"), status.alias("payment_status"), "payment_date", F.when(F.col("l_tax") > 0.04, "CARD").when(F.col("l_tax") > 0.01, "BANK").alias("payment_method"), "ingestion_record_id", F.md5(F.col("ingestion_record_id").cast("binary")).alias("record_hash"), F.lit("S3").alias("source_system"), F.to_date("payment_date").alias("source_date"), "load_timestamp", "file_last_modified")


def payment_records(shipments: DataFrame) -> DataFrame:
    """Shipments as payment records, several versions of some, with a record id that orders what nothing else does."""
    return _described_payments(_named_payments(shipments))


def payment_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payment_records(table(spark, sf_dir, "lineitem"))


def _latest_payments(named: DataFrame) -> DataFrame:
    return _described_payments(current_state.latest(named, current_state.PAYMENTS))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest_payments(_named_payments(table(spark, sf_dir, "lineitem")))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw records: the payload as VARIANT, their hash, and the lineage that the checks look at."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").cast("string").alias("ingestion_record_id"), F.try_parse_json("props").alias("raw_record"), F.sha2("props", 256).alias("payload_hash"), F.sha2(F.concat_ws("|", F.col("user_id").cast("string"), "event_type", "props"), 256).alias("record_hash"), F.col("user_id").cast("string").alias("user_id"), "event_type", F.col("value").cast("decimal(18,2)").cast("string").alias("value"), F.lit("S3").alias("source_system"), F.lit("EVENTS").alias("entity_name"), F.lit("JSON").alias("file_type"), F.lit("MANUAL").alias("run_mode"), F.concat_ws("/", F.lit("events"), "event_type", F.concat(F.col("user_id").cast("string"), F.lit(".json"))).alias("file_name"), F.col("ts").alias("load_timestamp"), F.date_format("ts", "yyyyMMdd").alias("batch_id"))


EVENT_CONTRACT = Contract("EVENTS", "1.0", "JSON", r".*[.]json", "events/", "RAW.RAW_EVENTS", ("ingestion_record_id", "user_id", "event_type", "value"), ("user_id", "event_type", "value"), ("ingestion_record_id",), (Rule("event_type", "ACCEPTED_VALUES", ("click", "View ")), Rule("value", "GREATER_THAN", bound="50"), Rule("user_id", "REGEX", pattern="[1-9][0-9]?")))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    errors = validation.contract_errors(EVENT_CONTRACT, value=F.col, present=lambda f: F.col(f).isNotNull())
    return e.withColumn("validation_errors", errors).withColumn("validation_status", F.when(F.size("validation_errors") > 0, "INVALID").otherwise("VALID"))


def _errors_of(code: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return validation.error_rows(_checked(spark, sf_dir)).where(F.col("code") == code)

    return query


# the queries ----------------------------------------------------------------------------------------------------------


def stg_typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    k = variant_text("raw_record", "k")
    return plain(e.select("ingestion_record_id", F.upper(F.trim("event_type")).alias("event_type"), initcap_words(F.concat("event_type", F.lit("-OF/the day"))).alias("event_title"), k.alias("k_text"), k.try_cast("decimal(18,2)").alias("k_amount"), k.try_cast("timestamp_ntz").alias("k_time"), F.try_to_date(F.date_format("load_timestamp", "yyyy-MM-dd")).alias("event_day"), variant_text("raw_record", "absent").alias("absent"), base_name("file_name").alias("file"), "record_hash"))


def silver_latest_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(payments(spark, sf_dir).drop("file_last_modified"))


def _before_cut(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Named shipments, and the current state of those loaded before the cut."""
    named = _named_payments(table(spark, sf_dir, "lineitem"))
    return named, _latest_payments(named.where(F.col("load_timestamp") < F.lit(CUT_DAY).cast("timestamp_ntz")))


def _increment(named: DataFrame, target: DataFrame) -> DataFrame:
    """The latest versions of the look-back."""
    return _latest_payments(current_state.look_back(named, target))


def silver_incremental_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    named, target = _before_cut(spark, sf_dir)
    return plain(current_state.newer(_increment(named, target), target, current_state.PAYMENTS).drop("file_last_modified"))


def silver_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    named, target = _before_cut(spark, sf_dir)
    return plain(current_state.superseded(target, _increment(named, target), current_state.PAYMENTS).drop("file_last_modified"))


def _dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_customers(customers(spark, sf_dir))


def _dim_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_applications(applications(spark, sf_dir), _dim_customers(spark, sf_dir))


def _fct_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fct_applications(_dim_applications(spark, sf_dir))


def _fct_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fct_payments(payments(spark, sf_dir), _dim_applications(spark, sf_dir))


def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_dim_customers(spark, sf_dir))


def dim_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_dim_applications(spark, sf_dir))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days from the first order to the last."""
    return plain(gold.dim_date_of(table(spark, sf_dir, "orders"), "o_orderdate"))


def fct_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_fct_applications(spark, sf_dir))


def fct_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_fct_payments(spark, sf_dir))


def mart_application_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(gold.mart_application_performance(_fct_applications(spark, sf_dir)))


def mart_customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(gold.mart_customer_summary(_dim_customers(spark, sf_dir), _fct_applications(spark, sf_dir), _fct_payments(spark, sf_dir)))


def mart_payment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(gold.mart_payment_summary(_fct_payments(spark, sf_dir)))


def validation_error_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = F.array_join(F.transform("validation_errors", lambda e: F.concat_ws(":", e["field"], e["code"], e["message"])), "|")
    fields = F.array_join(F.array_sort(F.array_distinct(F.transform("validation_errors", lambda e: e["field"]))), ",")
    return _checked(spark, sf_dir).select("ingestion_record_id", "validation_status", errors.alias("errors"), fields.alias("failed_fields"))


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.reject_rows(_checked(spark, sf_dir))


def reject_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects that a quarantine of all purchases' rejects doesn't hold yet."""
    rejects = _rejects(spark, sf_dir)
    purchases = events(spark, sf_dir).where("event_type = 'purchase'").select("ingestion_record_id")
    return validation.new_rejects(rejects, rejects.join(purchases, "ingestion_record_id", "left_semi")).select("batch_id", "ingestion_record_id", "rejection_category", "rejection_code", "resolution_status")


def _split_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Valid and other records of later days, and the raw table of earlier ones."""
    rows, middle = _checked(spark, sf_dir), "20240116"
    return rows.where(F.col("batch_id") >= middle), rows.where(F.col("batch_id") < middle)


def raw_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, raw = _split_events(spark, sf_dir)
    return new.join(raw.select("record_hash").distinct(), "record_hash", "left_anti").select("ingestion_record_id", "record_hash")


def duplicate_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, raw = _split_events(spark, sf_dir)
    return validation.mark_duplicates(new, raw).select("ingestion_record_id", "record_hash", "processed_status")


def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, raw = _split_events(spark, sf_dir)
    marked = validation.mark_duplicates(new.where("validation_status = 'VALID'"), raw)
    invalid = new.where("validation_status = 'INVALID'").withColumn("processed_status", F.lit("PENDING"))
    return validation.reconciled(validation.batch_counts(marked.unionByName(invalid)))


def file_skip_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later event files against the history of earlier ones, by path and by checksum (here of the payload)."""
    from lendloom.plans.ingest import decide_files

    e = events(spark, sf_dir).select(F.concat("file_name", F.lit("/"), "batch_id").alias("full_file_path"), F.col("payload_hash").alias("file_checksum"), "batch_id", "event_type", F.col("load_timestamp"))
    files = e.groupBy("full_file_path", "batch_id").agg(F.min("file_checksum").alias("file_checksum"))
    history = files.where("batch_id < '20240103'").select("full_file_path", "file_checksum", F.lit("LOADED").alias("file_status"), F.lit(1).cast("long").alias("source_row_count"), F.lit(0).cast("long").alias("duplicate_row_count"))
    later = files.where("batch_id >= '20240102'").drop("batch_id")
    return decide_files(later, history, force=False).select("full_file_path", "file_checksum", "load_attempt_number", "file_status", "skip_reason")


def raw_check_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    invalid = {"INVALID_EVENT_TYPE": ~F.upper("event_type").isin("CLICK", "VIEW", "PURCHASE"), "INVALID_VALUE": F.col("value").try_cast("decimal(18,2)") <= 0}
    missing = blank_to_null("user_id").isNull() | blank_to_null("event_type").isNull() | blank_to_null("value").isNull()
    return raw_checks.raw_checks(e, 10_000, "ingestion_record_id", missing, invalid, value=F.col)


def raw_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_checks.summary(payment_versions(spark, sf_dir), "payment_id", "payment_method")


def orphan_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applications whose customer isn't among the active ones."""
    active = customers(spark, sf_dir).where("customer_status = 'ACTIVE'")
    return raw_checks.orphans(applications(spark, sf_dir), "customer_id", active, "customer_id").select("application_id", "customer_id")


def nonapproved_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_checks.with_other_status(payments(spark, sf_dir), applications(spark, sf_dir)).select("payment_id", "application_id", "payment_status", "application_status")


def status_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_checks.status_distribution(applications(spark, sf_dir), "application_status")


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assertions.unique(payment_versions(spark, sf_dir), "payment_id")


def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payment_versions(spark, sf_dir).agg(F.count("*").alias("n_rows"), F.count_distinct("payment_id").alias("n_payments"), F.count_distinct("application_id").alias("n_applications"))


def topk_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(applications(spark, sf_dir).orderBy(F.desc("application_date"), F.desc("requested_amount"), "application_id").limit(10).select("application_id", "application_date", "requested_amount"))


def flatten_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).select("ingestion_record_id", "raw_record")
    return e.lateralJoin(spark.tvf.variant_explode(F.col("raw_record").outer())).select("ingestion_record_id", "key", F.to_json("value").alias("value"))


def not_null_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assertions.not_null(payment_versions(spark, sf_dir), "payment_method").agg(F.count("*").alias("n_failures"))


def unique_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assertions.unique(payment_versions(spark, sf_dir), "payment_id").agg(F.count("*").alias("n_failures"))


def accepted_values_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assertions.accepted_values(applications(spark, sf_dir), "application_status", ["APPROVED", "REJECTED"])


def relationships_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    approved = applications(spark, sf_dir).where("application_status = 'APPROVED'")
    return assertions.relationships(payments(spark, sf_dir), "application_id", approved, "application_id").agg(F.count("*").alias("n_failures"))


def expression_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assertions.expression_is_true(_fct_payments(spark, sf_dir), "days_from_decision_to_payment >= 0", "days_from_decision_to_payment is not null").agg(F.count("*").alias("n_failures"))


def pattern_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose whole base name matches a pattern."""
    e = events(spark, sf_dir)
    return e.where(full_match(base_name("file_name"), "[0-9]{2}[.]json")).groupBy("file_name").agg(F.count("*").alias("n_records"))


QUERIES = {f.__name__: f for f in (
    stg_typed_projection, silver_latest_payment, silver_incremental_delta, silver_merge, dim_customers, dim_applications, dim_date, fct_applications, fct_payments,
    mart_application_performance, mart_customer_summary, mart_payment_summary, validation_error_arrays, reject_antijoin, raw_antijoin, duplicate_mark, reconciliation,
    file_skip_decision, raw_check_rows, raw_summary, orphan_applications, nonapproved_payments, status_distribution, duplicate_keys, distinct_counts, topk_recent,
    flatten_object, not_null_test, unique_test, accepted_values_test, relationships_test, expression_test, pattern_filter,
)} | {
    "required_field_errors": _errors_of("REQUIRED_FIELD_MISSING"),
    "accepted_value_errors": _errors_of("INVALID_ACCEPTED_VALUE"),
    "greater_than_errors": _errors_of("VALUE_NOT_GREATER_THAN"),
    "pattern_errors": _errors_of("PATTERN_MISMATCH"),
}

# the same in DuckDB SQL -----------------------------------------------------------------------------------------------

_KEY = "md5({})"
_UNKNOWN = "md5('__UNKNOWN__')"
_CUST = """cust as (select c_custkey::varchar as customer_id, c_name as customer_name, lower(c_name) || '@example.org' as email, 'Nation ' || c_nationkey::varchar as city,
    case when c_acctbal < 0 then 'INACTIVE' else 'ACTIVE' end as customer_status from customer)"""
_APP = """app0 as (select *, case when o_orderstatus = 'F' then 'APPROVED' when o_orderstatus = 'O' then 'SUBMITTED' when o_orderpriority like '5%' then 'REJECTED' else 'UNDER_REVIEW' end as application_status from orders),
app as (select o_orderkey::varchar as application_id, o_custkey::varchar as customer_id, application_status, o_orderdate::date as application_date, o_totalprice::decimal(18,2) as requested_amount,
    case when application_status in ('APPROVED', 'REJECTED') then o_orderdate::date + (o_orderkey % 30)::int end as decision_date, o_orderdate as load_timestamp from app0)"""
_VERSIONS = """ver as (select l_orderkey::varchar || '-' || l_linenumber::varchar as payment_id, l_orderkey::varchar as application_id, l_extendedprice::decimal(18,2) as payment_amount,
    case when l_returnflag = 'R' then 'REFUNDED' when l_returnflag = 'A' then 'FAILED' when l_linestatus = 'F' then 'PENDING' else 'COMPLETED' end as payment_status, l_shipdate as payment_date,
    case when l_tax > 0.04 then 'CARD' when l_tax > 0.01 then 'BANK' end as payment_method,
    concat_ws('|', l_orderkey::varchar, l_linenumber::varchar, l_partkey::varchar, l_suppkey::varchar, printf('%.2f', l_quantity), printf('%.2f', l_extendedprice), printf('%.2f', l_discount), printf('%.2f', l_tax), l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d')) as ingestion_record_id,
    md5(ingestion_record_id) as record_hash from lineitem)"""
_RANK = "row_number() over (partition by payment_id order by payment_date desc nulls last, ingestion_record_id desc) as version_rank"
_PAY = f"{_VERSIONS}, pay as (select * from (select *, {_RANK} from ver) where version_rank = 1)"
_DIMC = f"""dimc as (select md5(customer_id) as customer_key, customer_id, customer_name, email, city, customer_status, null::varchar as created_at, null::varchar as updated_at, 'S3' as source_system, '2024-01-01' as source_date, '2024-01-01 00:00:00' as silver_load_timestamp, false as is_unknown_customer from cust
    union all select {_UNKNOWN}, '__UNKNOWN__', 'Unknown Customer', null, 'Unknown', 'UNKNOWN', null, null, 'SYSTEM', null, null, true)"""
_DIMA = f"""dima as (select md5(application_id) as application_key, coalesce(c.customer_key, {_UNKNOWN}) as customer_key, application_id, a.customer_id, application_status, application_date::timestamp as application_date, requested_amount, decision_date::timestamp as decision_date, 'S3' as source_system, strftime(a.load_timestamp, '%Y-%m-%d') as source_date, strftime(a.load_timestamp, '%Y-%m-%d %H:%M:%S') as silver_load_timestamp, c.customer_key is null as is_orphan_customer, false as is_unknown_application
    from app a left join dimc c on a.customer_id = c.customer_id and not c.is_unknown_customer
    union all select {_UNKNOWN}, {_UNKNOWN}, '__UNKNOWN__', '__UNKNOWN__', 'UNKNOWN', null, 0, null, 'SYSTEM', null, null, false, true)"""
_FCTA = """fcta as (select application_key, customer_key, strftime(application_date, '%Y%m%d')::bigint as application_date_key, strftime(decision_date, '%Y%m%d')::bigint as decision_date_key, application_id, customer_id, application_status, application_date, decision_date, 1::bigint as application_count, requested_amount,
    (application_status = 'SUBMITTED')::bigint as submitted_count, (application_status = 'UNDER_REVIEW')::bigint as under_review_count, (application_status = 'APPROVED')::bigint as approved_count, (application_status = 'REJECTED')::bigint as rejected_count,
    case when application_status = 'APPROVED' then requested_amount else 0::decimal(18,2) end as approved_requested_amount, date_diff('day', application_date, decision_date)::bigint as decision_turnaround_days, is_orphan_customer, source_system, source_date, silver_load_timestamp from dima where not is_unknown_application)"""
_FCTP = f"""fctp as (select md5(payment_id) as payment_key, coalesce(a.application_key, {_UNKNOWN}) as application_key, coalesce(a.customer_key, {_UNKNOWN}) as customer_key, strftime(payment_date, '%Y%m%d')::bigint as payment_date_key, payment_id, p.application_id, payment_status, payment_date, payment_method, 1::bigint as payment_count, payment_amount,
    (payment_status = 'PENDING')::bigint as pending_count, (payment_status = 'COMPLETED')::bigint as completed_count, (payment_status = 'FAILED')::bigint as failed_count, (payment_status = 'REFUNDED')::bigint as refunded_count,
    case when payment_status = 'COMPLETED' then payment_amount else 0::decimal(18,2) end as completed_payment_amount, case when payment_status = 'REFUNDED' then payment_amount else 0::decimal(18,2) end as refunded_payment_amount,
    date_diff('day', a.decision_date::date, payment_date::date)::bigint as days_from_decision_to_payment, a.application_key is null as is_orphan_application, 'S3' as source_system, strftime(payment_date, '%Y-%m-%d') as source_date, strftime(payment_date, '%Y-%m-%d %H:%M:%S') as silver_load_timestamp
    from pay p left join dima a on p.application_id = a.application_id and not a.is_unknown_application)"""
_GOLD = f"with {_CUST}, {_APP}, {_PAY}, {_DIMC}, {_DIMA}, {_FCTA}, {_FCTP} "
_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S') as {0}"
_PAID = f"payment_id, application_id, payment_amount::double as payment_amount, payment_status, {_TIME.format('payment_date')}, payment_method, ingestion_record_id, record_hash, 'S3' as source_system, strftime(payment_date, '%Y-%m-%d') as source_date, strftime(payment_date, '%Y-%m-%d %H:%M:%S') as load_timestamp"
_INC = f"""with {_VERSIONS}, target as (select * exclude version_rank from (select *, {_RANK} from ver where payment_date < timestamp '{CUT_DAY}') where version_rank = 1),
inc as (select *, 0 as prio from ver where payment_date >= (select max(payment_date) from target) - interval 3 days),
cand as (select * from inc union all select *, 1 from target where payment_id in (select payment_id from inc)),
best as (select * exclude version_rank from (select *, row_number() over (partition by payment_id order by payment_date desc nulls last, ingestion_record_id desc, prio desc) as version_rank from cand) where version_rank = 1),
delta as (select b.* exclude prio from best b left join target t on b.payment_id = t.payment_id where t.payment_id is null or coalesce(b.record_hash, '') <> coalesce(t.record_hash, '')) """
_EV = """ev as (select event_id::varchar as id, props, sha256(props) as payload_hash, sha256(concat_ws('|', user_id::varchar, event_type, props)) as record_hash, user_id::varchar as user_id, event_type, value::decimal(18,2)::varchar as value, ts, strftime(ts, '%Y%m%d') as batch_id, 'events/' || event_type || '/' || user_id::varchar || '.json' as file_name from events)"""
_ERR = f"""{_EV}, err as (
    select id, f as field, 'REQUIRED_FIELD_MISSING' as code, 'Required field ' || f || ' is null, missing or empty' as message from (select id, unnest(['user_id', 'event_type', 'value']) as f, unnest([user_id, event_type, value]) as v from ev) where nullif(trim(v), '') is null
    union all select id, 'event_type', 'INVALID_ACCEPTED_VALUE', 'Field event_type contains unsupported value: ' || event_type from ev where event_type is not null and upper(trim(event_type)) not in ('CLICK', 'VIEW')
    union all select id, 'value', 'VALUE_NOT_GREATER_THAN', 'Field value must be greater than 50' from ev where value is not null and not coalesce(try_cast(value as decimal(38,10)) > 50, false)
    union all select id, 'user_id', 'PATTERN_MISMATCH', 'Field user_id does not match the configured pattern' from ev where user_id is not null and not regexp_full_match(user_id, '[1-9][0-9]?'))"""
_SPLIT = f"""{_ERR}, chk as (select ev.*, case when id in (select id from err) then 'INVALID' else 'VALID' end as validation_status from ev), new as (select * from chk where batch_id >= '20240116'), raw as (select * from chk where batch_id < '20240116')"""


def _code(code: str) -> str:
    return f"with {_ERR} select id as ingestion_record_id, field, code, message from err where code = '{code}'"


ORACLE_SQL = {
    "stg_typed_projection": f"""with {_EV}, k as (select *, json_extract_string(props, '$.k') as k from ev) select id as ingestion_record_id, upper(trim(event_type)) as event_type, upper(event_type[1:1]) || lower(event_type[2:]) || '-Of/The Day' as event_title, k as k_text, try_cast(k as decimal(18,2))::double as k_amount,
        null::varchar as k_time, strftime(ts, '%Y-%m-%d') as event_day, null::varchar as absent, regexp_extract(file_name, '[^/]+$') as file, record_hash from k""",
    "silver_latest_payment": f"with {_PAY} select {_PAID} from pay",
    "silver_incremental_delta": f"{_INC} select {_PAID} from delta",
    "silver_merge": f"{_INC} select {_PAID} from (select * from target where payment_id not in (select payment_id from delta) union all select * from delta)",
    "dim_customers": f"with {_CUST}, {_DIMC} select * from dimc",
    "dim_applications": f"with {_CUST}, {_APP}, {_DIMC}, {_DIMA} select * replace (requested_amount::double as requested_amount, strftime(application_date, '%Y-%m-%d %H:%M:%S') as application_date, strftime(decision_date, '%Y-%m-%d %H:%M:%S') as decision_date) from dima",
    "dim_date": """select strftime(d, '%Y%m%d')::bigint as date_key, strftime(d, '%Y-%m-%d') as calendar_date, year(d) as calendar_year, quarter(d) as calendar_quarter, month(d) as month_number, strftime(d, '%b') as month_name, week(d) as iso_week_number, day(d) as day_of_month, isodow(d) as iso_day_of_week, strftime(d, '%a') as day_name, isodow(d) in (6, 7) as is_weekend,
        strftime(date_trunc('month', d), '%Y-%m-%d') as month_start_date, strftime(last_day(d), '%Y-%m-%d') as month_end_date from (select unnest(generate_series((select date_trunc('day', min(o_orderdate)) from orders), (select date_trunc('day', max(o_orderdate)) from orders), interval 1 day))::date as d)""",
    "fct_applications": f"{_GOLD} select * replace (requested_amount::double as requested_amount, approved_requested_amount::double as approved_requested_amount, {_TIME.format('application_date')}, {_TIME.format('decision_date')}) from fcta",
    "fct_payments": f"{_GOLD} select * replace (payment_amount::double as payment_amount, completed_payment_amount::double as completed_payment_amount, refunded_payment_amount::double as refunded_payment_amount, {_TIME.format('payment_date')}) from fctp",
    "mart_application_performance": f"""{_GOLD} select application_date_key, strftime(application_date, '%Y-%m-%d') as application_date, sum(application_count)::bigint as application_count, sum(submitted_count)::bigint as submitted_count, sum(under_review_count)::bigint as under_review_count, sum(approved_count)::bigint as approved_count, sum(rejected_count)::bigint as rejected_count,
        sum(requested_amount)::double as total_requested_amount, sum(approved_requested_amount)::double as approved_requested_amount, round(sum(requested_amount) * 1000000 / count(requested_amount))::bigint / 1000000::double as average_requested_amount, avg(decision_turnaround_days) as average_decision_days,
        round(sum(approved_count) * 100 / sum(application_count), 2) as approval_rate_pct, round(sum(rejected_count) * 100 / sum(application_count), 2) as rejection_rate_pct, sum(is_orphan_customer::int)::bigint as orphan_application_count from fcta group by all""",
    "mart_customer_summary": f"""{_GOLD}, a as (select customer_key, sum(application_count) as n, sum(approved_count) as ok, sum(rejected_count) as no, sum(requested_amount) as total, sum(approved_requested_amount) as approved, avg(decision_turnaround_days) as days from fcta group by 1),
        p as (select customer_key, sum(payment_count) as n, sum(completed_count) as completed, sum(failed_count) as failed, sum(refunded_count) as refunded, sum(payment_amount) as total, sum(completed_payment_amount) as paid, sum(refunded_payment_amount) as back from fctp group by 1)
        select customer_key, customer_id, customer_name, city, customer_status, coalesce(a.n, 0)::bigint as application_count, coalesce(ok, 0)::bigint as approved_application_count, coalesce(no, 0)::bigint as rejected_application_count, coalesce(a.total, 0)::double as total_requested_amount, coalesce(approved, 0)::double as approved_requested_amount, days as average_decision_days,
        coalesce(p.n, 0)::bigint as payment_count, coalesce(completed, 0)::bigint as completed_payment_count, coalesce(failed, 0)::bigint as failed_payment_count, coalesce(refunded, 0)::bigint as refunded_payment_count, coalesce(p.total, 0)::double as total_payment_amount, coalesce(paid, 0)::double as completed_payment_amount, coalesce(back, 0)::double as refunded_payment_amount,
        coalesce(a.n, 0) = 0 as has_no_applications, coalesce(a.n, 0) > 0 and coalesce(completed, 0) = 0 as has_no_completed_payment from dimc left join a using (customer_key) left join p using (customer_key) where not is_unknown_customer""",
    "mart_payment_summary": f"""{_GOLD}, g as (select payment_date_key, strftime(payment_date, '%Y-%m-%d') as payment_date, coalesce(payment_method, 'UNKNOWN') as payment_method, sum(payment_count)::bigint as payment_count, sum(pending_count)::bigint as pending_count, sum(completed_count)::bigint as completed_count, sum(failed_count)::bigint as failed_count, sum(refunded_count)::bigint as refunded_count,
        sum(payment_amount)::double as total_payment_amount, sum(completed_payment_amount)::double as completed_payment_amount, sum(refunded_payment_amount)::double as refunded_payment_amount, round(sum(payment_amount) * 1000000 / count(payment_amount))::bigint / 1000000::double as average_payment_amount, avg(days_from_decision_to_payment) as average_days_from_decision_to_payment,
        round(sum(completed_count) * 100 / sum(payment_count), 2) as payment_success_rate_pct, round(sum(failed_count) * 100 / sum(payment_count), 2) as payment_failure_rate_pct, sum(is_orphan_application::int)::bigint as orphan_payment_count from fctp group by 1, 2, 3)
        select md5(payment_date_key::varchar || '-' || payment_method) as payment_summary_key, * from g""",
    "validation_error_arrays": f"""with {_ERR}, g as (select id, string_agg(field || ':' || code || ':' || message, '|' order by field, code, message) as errors, string_agg(distinct field, ',' order by field) as fields from err group by id)
        select ev.id as ingestion_record_id, case when g.id is null then 'VALID' else 'INVALID' end as validation_status, coalesce(errors, '') as errors, coalesce(fields, '') as failed_fields from ev left join g on ev.id = g.id""",
    "reject_antijoin": f"with {_ERR} select batch_id, id as ingestion_record_id, 'CONTRACT_VALIDATION' as rejection_category, 'CONTRACT_VALIDATION_FAILED' as rejection_code, 'OPEN' as resolution_status from ev where id in (select id from err) and event_type is distinct from 'purchase'",
    "raw_antijoin": f"with {_SPLIT} select id as ingestion_record_id, record_hash from new where record_hash not in (select record_hash from raw)",
    "duplicate_mark": f"with {_SPLIT} select id as ingestion_record_id, record_hash, case when record_hash in (select record_hash from raw) then 'DUPLICATE' else 'PENDING' end as processed_status from new",
    "reconciliation": f"""with {_SPLIT}, m as (select validation_status, validation_status = 'VALID' and record_hash in (select record_hash from raw) as dup from new),
        c as (select count(*) as source_rows, count(*) filter (where validation_status = 'VALID') as valid_rows, count(*) filter (where validation_status = 'INVALID') as rejected_rows, count(*) filter (where dup) as duplicate_rows, count(*) filter (where validation_status = 'VALID' and not dup) as loaded_rows from m)
        select *, loaded_rows + rejected_rows + duplicate_rows as accounted_rows, source_rows - (loaded_rows + rejected_rows + duplicate_rows) as variance_rows, case when source_rows = loaded_rows + rejected_rows + duplicate_rows then 'PASSED' else 'FAILED' end as reconciliation_status from c""",
    "file_skip_decision": f"""with {_EV}, f as (select file_name || '/' || batch_id as full_file_path, batch_id, min(payload_hash) as file_checksum from ev group by 1, 2), h as (select * from f where batch_id < '20240103'), n as (select * from f where batch_id >= '20240102')
        select full_file_path, file_checksum, 1 + (select count(*) from h where h.full_file_path = n.full_file_path) as load_attempt_number,
        case when full_file_path in (select full_file_path from h) or file_checksum in (select file_checksum from h) then 'SKIPPED' else 'SELECTED' end as file_status,
        case when full_file_path in (select full_file_path from h) then 'FILE_ALREADY_LOADED' when file_checksum in (select file_checksum from h) then 'DUPLICATE_FILE_CONTENT' end as skip_reason from n""",
    "raw_check_rows": f"""with {_EV}, c as (
        select 'ROW_COUNT' as check_name, 10000::bigint as expected_value, count(*) as actual_value from ev union all select 'NULL_MANDATORY_AUDIT_COLUMNS', 0, count(*) filter (where id is null or file_name is null or ts is null or batch_id is null) from ev
        union all select 'NULL_RECORD_HASH', 0, count(*) filter (where record_hash is null) from ev union all select 'MISSING_BUSINESS_FIELDS', 0, count(*) filter (where nullif(trim(user_id), '') is null or nullif(trim(event_type), '') is null or nullif(trim(value), '') is null) from ev
        union all select 'INVALID_EVENT_TYPE', 0, count(*) filter (where upper(event_type) not in ('CLICK', 'VIEW', 'PURCHASE')) from ev union all select 'INVALID_VALUE', 0, count(*) filter (where try_cast(value as decimal(18,2)) <= 0) from ev
        union all select 'DUPLICATE_INGESTION_RECORD_ID', 0, (select count(*) from (select id from ev group by id having count(*) > 1)) union all select 'DUPLICATE_RECORD_HASH', 0, (select count(*) from (select record_hash from ev group by 1 having count(*) > 1))
        union all select 'DUPLICATE_INGESTION_RECORD_ID_KEY', 0, 0) select *, actual_value - expected_value as variance, case when actual_value = expected_value then 'PASS' else 'FAIL' end as check_status from c where check_name <> 'DUPLICATE_INGESTION_RECORD_ID_KEY'""",
    "raw_summary": f"with {_VERSIONS} select count(*) as total_rows, count(distinct ingestion_record_id) as distinct_ids, count(distinct payment_id) as distinct_keys, count(*) filter (where record_hash is null) as missing_hashes, count(*) filter (where payment_method is null) as missing_keys from ver",
    "orphan_applications": f"with {_CUST}, {_APP} select application_id, customer_id from app where customer_id not in (select customer_id from cust where customer_status = 'ACTIVE')",
    "nonapproved_payments": f"with {_APP}, {_PAY} select payment_id, p.application_id, payment_status, application_status from pay p join app a on p.application_id = a.application_id where application_status <> 'APPROVED'",
    "status_distribution": f"with {_APP} select application_status as status, count(*) as n_records from app group by 1",
    "duplicate_keys": f"with {_VERSIONS} select payment_id, count(*) as n_records from ver group by 1 having count(*) > 1",
    "distinct_counts": f"with {_VERSIONS} select count(*) as n_rows, count(distinct payment_id) as n_payments, count(distinct application_id) as n_applications from ver",
    "topk_recent": f"with {_APP} select application_id, strftime(application_date, '%Y-%m-%d') as application_date, requested_amount::double as requested_amount from (select * from app order by app.application_date desc, app.requested_amount desc, application_id limit 10)",
    "flatten_object": "select event_id::varchar as ingestion_record_id, unnest(json_keys(props)) as key, json_extract(props, '$.' || unnest(json_keys(props)))::varchar as value from events",
    "not_null_test": f"with {_VERSIONS} select count(*) as n_failures from ver where payment_method is null",
    "unique_test": f"with {_VERSIONS} select count(*) as n_failures from (select payment_id from ver group by 1 having count(*) > 1)",
    "accepted_values_test": f"with {_APP} select application_status, count(*) as n_records from app where application_status not in ('APPROVED', 'REJECTED') group by 1",
    "relationships_test": f"with {_APP}, {_PAY} select count(*) as n_failures from pay where application_id not in (select application_id from app where application_status = 'APPROVED')",
    "expression_test": f"{_GOLD} select count(*) as n_failures from fctp where days_from_decision_to_payment < 0",
    "pattern_filter": f"with {_EV} select file_name, count(*) as n_records from ev where regexp_full_match(regexp_extract(file_name, '[^/]+$'), '[0-9]{{2}}[.]json') group by 1",
    "required_field_errors": _code("REQUIRED_FIELD_MISSING"),
    "accepted_value_errors": _code("INVALID_ACCEPTED_VALUE"),
    "greater_than_errors": _code("VALUE_NOT_GREATER_THAN"),
    "pattern_errors": _code("PATTERN_MISMATCH"),
}
