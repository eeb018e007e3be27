"""Registered queries over raw VARIANT records of the three entities, made from the driver's tables, and their DuckDB SQL.

The records have what landed files have: blank and missing fields, JSON nulls, values that can't be read, several versions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendloom.functions.expressions import full_match, object_construct, record_hash, variant_text
from lendloom.operators import current_state, raw_checks, staging, validation
from lendloom.plans import contracts
from lendloom.plans.catalogue import plain, table
from lendloom.plans.ingest import Ingestion
from lendloom.session import scratch_folder
from lendloom.sources.files import list_files, number_rows, read_records
from lendloom.sources.store import TableStore

LOADED = "2024-03-01"


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _record(fields: dict[str, Column], absent: dict[str, Column]) -> Column:
    """A VARIANT of the fields, nulls as JSON nulls; a field for which `absent` holds isn't there at all."""
    text = F.to_json(F.struct(*(v.alias(k) for k, v in fields.items())), {"ignoreNullFields": "false"})
    for field, condition in absent.items():
        rest = F.to_json(F.struct(*(v.alias(k) for k, v in fields.items() if k != field)), {"ignoreNullFields": "false"})
        text = F.when(condition, rest).otherwise(text)
    return F.parse_json(text)


def _raw(rows: DataFrame, entity: str, number: Column, record: Column, hashed: Column, version: int = 1) -> DataFrame:
    """Raw rows with their lineage; some lack an id, a hash or a file type."""
    n = number
    loaded = F.date_add(F.lit(LOADED).cast("date"), (n % 10).cast("int") + version - 1).cast("timestamp_ntz")
    return rows.select(
        F.when(n % 100 != 0, F.concat(F.lit("r"), n.cast("string"), F.lit(f"-{version}"))).alias("ingestion_record_id"), F.lit(entity).alias("entity_name"), record.alias("raw_record"), F.when(n % 60 != 0, F.sha2(hashed, 256)).alias("record_hash"), F.lit("S3").alias("source_system"),
        F.lit("landing").alias("source_object"), F.when(n % 70 != 0, F.lit("CSV")).alias("file_type"), F.concat(F.lit("landing/"), (n % 7).cast("string"), F.lit(".csv")).alias("file_name"), n.alias("file_row_number"), F.lit(None).cast("string").alias("file_content_key"),
        F.lit(f"{LOADED} 00:00:00").cast("timestamp_ntz").alias("file_last_modified"), loaded.alias("scan_start_time"), loaded.alias("load_timestamp"), F.lit("B1").alias("batch_id"), F.lit("MANUAL").alias("run_mode"), F.lit("1.0").alias("contract_version"), F.to_date(loaded).alias("source_date"),
        F.lit(None).cast("date").alias("backfill_from_date"), F.lit(None).cast("date").alias("backfill_to_date"),
    )


def _day(first: str, days: Column) -> Column:
    return F.concat(F.date_format(F.date_add(F.lit(first).cast("date"), days.cast("int")), "yyyy-MM-dd"), F.lit(" 00:00:00"))


def raw_customers(spark: SparkSession, sf_dir: str, version: int = 1) -> DataFrame:
    """The second version has every third customer again, changed a day later."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    c = c if version == 1 else c.where(k % 3 == 0)
    status = F.when(F.col("c_acctbal") < 0, "inactive").when(F.col("c_acctbal") > 9000, "Closed").when(F.col("c_acctbal") > 8000, F.lit(None)).otherwise("Active")
    fields = {"customer_id": F.when(k % 50 == 7, F.lit("  ")).otherwise(_text("c_custkey")), "customer_name": F.concat(F.lit(" "), "c_name", F.lit(" ")), "email": F.when(k % 40 != 0, F.concat(F.upper("c_name"), F.when(k % 11 == 0, F.lit(" at home")).when(k % 13 == 0, F.lit("@Example.org ")).otherwise(F.lit("@Example.org")))), "city": F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(f"-BY/the sea {version}")), "customer_status": status, "created_at": F.when(k % 30 == 0, "n/a").otherwise(_day("2024-01-01", k % 300)), "updated_at": F.when(k % 9 != 0, _day("2024-01-01", k % 300 + version))}
    return _raw(c, "CUSTOMERS", k, _record(fields, {"customer_status": k % 25 == 0}), F.concat_ws("|", _text("c_nationkey"), "c_mktsegment", F.lit(version).cast("string")), version)


def raw_applications(spark: SparkSession, sf_dir: str, version: int = 1) -> DataFrame:
    """The second version has every fourth application again; some of it are decided earlier than what is held."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    o = o if version == 1 else o.where(k % 4 == 0)
    status = F.when(F.col("o_orderstatus") == "F", "approved").when(F.col("o_orderstatus") == "O", "SUBMITTED").when(F.col("o_orderpriority").startswith("5"), "Rejected").otherwise("under review")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    decided = F.date_format(F.date_add(F.to_date("o_orderdate"), (k % 30).cast("int") + (version - 1) * 10 - F.when((k % 8 == 0) & F.lit(version == 2), 25).otherwise(0)), "yyyy-MM-dd")
    fields = {"application_id": _text("o_orderkey"), "customer_id": F.when(k % 90 == 1, F.lit("")).otherwise(_text("o_custkey")), "application_status": status, "application_date": F.when(k % 45 == 3, "31/12/1999").otherwise(day), "requested_amount": F.when(k % 33 == 0, "abc").otherwise(F.format_string("%.2f", "o_totalprice")), "decision_date": F.when((F.col("o_orderstatus") == "F") & (k % 16 != 0), decided)}
    return _raw(o, "APPLICATIONS", k, _record(fields, {"application_status": k % 35 == 0}), F.concat_ws("|", _text("o_orderkey"), F.lit(version).cast("string")), version)


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = table(spark, sf_dir, "lineitem"), F.col("l_orderkey")
    fields = {"payment_id": F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber"), _text("l_partkey"), _text("l_suppkey")), "application_id": _text("l_orderkey"), "payment_amount": F.format_string("%.2f", "l_extendedprice"), "payment_status": F.when(F.col("l_returnflag") == "R", " refunded ").otherwise("completed"), "payment_date": F.when(k % 20 != 0, F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).otherwise("soon"), "payment_method": F.when(F.col("l_tax") > 0.02, " Card "), "updated_at": F.when(F.col("l_tax") > 0.01, F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))}
    return _raw(p, "PAYMENTS", k, _record(fields, {"updated_at": F.col("l_tax") > 0.06}), _text("l_orderkey"))


def raw_checks_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_checks.customers_checks(raw_customers(spark, sf_dir), 1000)


def raw_checks_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_checks.applications_checks(raw_applications(spark, sf_dir), 1650)


def raw_payments_required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_checks.payments_without_required_fields(raw_payments(spark, sf_dir))


def invalid_customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_checks.invalid_customers(raw_customers(spark, sf_dir)).select("file_name", "file_row_number")


def invalid_application_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_checks.invalid_applications(raw_applications(spark, sf_dir)).select("file_name", "file_row_number")


def _errors(raw: DataFrame, contract: contracts.Contract) -> DataFrame:
    return validation.error_rows(validation.validate(raw, contract), "file_row_number")


def variant_customer_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _errors(raw_customers(spark, sf_dir), contracts.CUSTOMERS)


def variant_application_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _errors(raw_applications(spark, sf_dir), contracts.APPLICATIONS)


SHOWN = ("ingestion_record_id", "record_hash", "file_name", "load_timestamp", "source_date")


def _shown(staged: DataFrame) -> DataFrame:
    return plain(staged.drop(*(c for c in staging.LINEAGE if c not in SHOWN)))


def stg_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(staging.stg_customers(raw_customers(spark, sf_dir)))


def stg_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(staging.stg_applications(raw_applications(spark, sf_dir)))


def stg_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(staging.stg_payments(raw_payments(spark, sf_dir)))


def _silver(first: DataFrame, second: DataFrame, keyed: current_state.Keyed) -> DataFrame:
    """The current state after a first run over the first versions and an incremental one over all."""
    held = current_state.delta(first, None, keyed)
    return _shown(current_state.merge(held, current_state.delta(first.unionByName(second), held, keyed), keyed.key))


def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = (staging.stg_customers(raw_customers(spark, sf_dir, v)) for v in (1, 2))
    return _silver(first, second, current_state.CUSTOMERS)


def silver_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = (staging.stg_applications(raw_applications(spark, sf_dir, v)) for v in (1, 2))
    return _silver(first, second, current_state.APPLICATIONS)


def ingestion_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole runs over generated files: customers as CSV, applications as JSON, customers again, and again by force.

    The files and the tables lie in a new folder of spark.checkpoint.dir.
    """
    root = scratch_folder(spark, "ingestion")
    for raw, contract, write in ((raw_customers, contracts.CUSTOMERS, lambda w: w.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv), (raw_applications, contracts.APPLICATIONS, lambda w: w.option("ignoreNullFields", False).json)):
        fields = [variant_text("raw_record", f).alias(f) for f in contract.fields]
        write(raw(spark, sf_dir).select(*fields).write)(f"{root}/landing/{contract.stage_path.rstrip('/')}")
    job, rows = Ingestion(spark, TableStore(spark, f"{root}/lake"), f"{root}/landing"), []
    for step, (entity, mode, force) in enumerate((("CUSTOMERS", "INCREMENTAL", False), ("APPLICATIONS", "INCREMENTAL", False), ("CUSTOMERS", "INCREMENTAL", False), ("CUSTOMERS", "REPROCESS", True)), 1):
        out = job.run(entity, mode, force)
        done = out.get("load_and_reconciliation", {})
        rows.append((step, entity, out["status"], *(done.get(c) for c in ("source_rows", "loaded_rows", "rejected_rows", "duplicate_rows", "variance_rows", "reconciliation_status"))))
    return spark.createDataFrame(rows, "step long, entity_name string, status string, source_rows long, loaded_rows long, rejected_rows long, duplicate_rows long, variance_rows long, reconciliation_status string")


def landed_parquet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of payments as a listing and a read see them: rows are numbered from 1 in each file, without gaps."""
    root = scratch_folder(spark, "landing")
    raw_payments(spark, sf_dir).select(*(variant_text("raw_record", f).alias(f) for f in contracts.PAYMENTS.fields)).write.parquet(f"{root}/payments")
    files = list_files(spark, root, "payments/").where(full_match("relative_path", contracts.PAYMENTS.file_pattern)).select("file_uri", "file_name", "file_size_bytes", "file_checksum")
    landed = read_records(spark, contracts.PAYMENTS, [r.file_uri for r in files.select("file_uri").collect()])
    landed.write.parquet(f"{root}/records")
    of_file = number_rows(spark.read.parquet(f"{root}/records")).groupBy("file_uri").agg(F.count("*").alias("n"), F.count_distinct("file_row_number").alias("numbers"), F.min("file_row_number").alias("first"), F.max("file_row_number").alias("last"))
    seen = files.join(of_file, "file_uri", "full").fillna(0, ["n", "numbers", "last"])  # a listed file may hold no rows: Spark's first task writes one
    good = (F.col("n") == F.col("numbers")) & ((F.col("first") == 1) | (F.col("n") == 0)) & (F.col("last") == F.col("n")) & (F.col("file_size_bytes") > 0) & (F.length("file_checksum") == 32)
    return seen.agg(F.sum("n").alias("n_rows"), F.count_if(~F.coalesce(good, F.lit(False))).alias("n_bad_files"))


def constructed_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects with and without their null fields, and the hash of the former."""
    e = table(spark, sf_dir, "events")
    fields = {"event_type": "event_type", "big": F.when(F.col("value") > 50, "yes"), "user_id": _text("user_id")}
    return e.select("event_id", object_construct(**fields).alias("o"), object_construct(keep_null=True, **fields).alias("k")).select("event_id", F.to_json("o").alias("without_nulls"), F.to_json("k").alias("with_nulls"), record_hash("k").alias("record_hash"))


QUERIES = {f.__name__: f for f in (ingestion_runs, landed_parquet_files, constructed_objects, raw_checks_customers, raw_checks_applications, raw_payments_required_fields, invalid_customer_records, invalid_application_records, variant_customer_errors, variant_application_errors, stg_customers, stg_applications, stg_payments, silver_customers, silver_applications)}

# the same in DuckDB SQL -----------------------------------------------------------------------------------------------


def _lineage_sql(n: str, version: int, hashed: str) -> str:
    return f"""case when {n} % 100 <> 0 then 'r' || {n} || '-{version}' end as ingestion_record_id, case when {n} % 60 <> 0 then sha256({hashed}) end as record_hash, case when {n} % 70 <> 0 then 'CSV' end as file_type,
    'landing/' || ({n} % 7) || '.csv' as file_name, {n} as n, date '{LOADED}' + ({n} % 10 + {version - 1})::int as loaded"""


def _customers_sql(name: str, version: int = 1) -> str:
    k = "c_custkey"
    return f"""{name} as (select case when {k} % 50 = 7 then '  ' else {k}::varchar end as customer_id, ' ' || c_name || ' ' as customer_name, case when {k} % 40 <> 0 then upper(c_name) || case when {k} % 11 = 0 then ' at home' when {k} % 13 = 0 then '@Example.org ' else '@Example.org' end end as email, '  ' || lower(c_mktsegment) || '-BY/the sea {version}' as city,
    upper(c_mktsegment[1:1]) || lower(c_mktsegment[2:]) || '-By/The Sea {version}' as city_title,
    {k} % 25 <> 0 as has_status, case when {k} % 25 <> 0 then case when c_acctbal < 0 then 'inactive' when c_acctbal > 9000 then 'Closed' when c_acctbal > 8000 then null else 'Active' end end as customer_status,
    case when {k} % 30 = 0 then 'n/a' else strftime(date '2024-01-01' + ({k} % 300)::int, '%Y-%m-%d') || ' 00:00:00' end as created_at, case when {k} % 9 <> 0 then strftime(date '2024-01-01' + ({k} % 300 + {version})::int, '%Y-%m-%d') || ' 00:00:00' end as updated_at,
    {_lineage_sql(k, version, f"concat_ws('|', c_nationkey::varchar, c_mktsegment, '{version}')")} from customer{" where c_custkey % 3 = 0" if version == 2 else ""})"""


def _applications_sql(name: str, version: int = 1) -> str:
    k = "o_orderkey"
    shift = f"{(version - 1) * 10}" + (f" - case when {k} % 8 = 0 then 25 else 0 end" if version == 2 else "")
    return f"""{name} as (select {k}::varchar as application_id, case when {k} % 90 = 1 then '' else o_custkey::varchar end as customer_id, {k} % 35 <> 0 as has_status,
    case when {k} % 35 <> 0 then case when o_orderstatus = 'F' then 'approved' when o_orderstatus = 'O' then 'SUBMITTED' when o_orderpriority like '5%' then 'Rejected' else 'under review' end end as application_status,
    case when {k} % 45 = 3 then '31/12/1999' else strftime(o_orderdate, '%Y-%m-%d') end as application_date, case when {k} % 33 = 0 then 'abc' else printf('%.2f', o_totalprice) end as requested_amount,
    case when o_orderstatus = 'F' and {k} % 16 <> 0 then strftime(o_orderdate::date + ({k} % 30 + {shift})::int, '%Y-%m-%d') end as decision_date,
    {_lineage_sql(k, version, f"concat_ws('|', {k}::varchar, '{version}')")} from orders{f" where {k} % 4 = 0" if version == 2 else ""})"""


_PAYMENTS = f"""pay as (select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as payment_id, l_orderkey::varchar as application_id, printf('%.2f', l_extendedprice) as payment_amount, case when l_returnflag = 'R' then ' refunded ' else 'completed' end as payment_status,
    case when l_orderkey % 20 <> 0 then strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') else 'soon' end as payment_date, case when l_tax > 0.02 then ' Card ' end as payment_method, l_tax > 0.06 as no_update, {_lineage_sql("l_orderkey", 1, "l_orderkey::varchar")} from lineitem)"""


def _checks_sql(rows: str, expected: int, key: str, missing: str, invalid: dict[str, str]) -> str:
    parts = [f"select 'ROW_COUNT' as check_name, {expected}::bigint as expected_value, count(*) as actual_value from {rows}", f"select 'NULL_MANDATORY_AUDIT_COLUMNS', 0, count(*) filter (where ingestion_record_id is null or file_type is null) from {rows}", f"select 'NULL_RECORD_HASH', 0, count(*) filter (where record_hash is null) from {rows}", f"select 'MISSING_BUSINESS_FIELDS', 0, count(*) filter (where {missing}) from {rows}"]
    parts += [f"select 'DUPLICATE_{name}', 0, count(*) from (select {column} from {rows} where {where} group by {column} having count(*) > 1)" for name, column, where in (("INGESTION_RECORD_ID", "ingestion_record_id", "true"), ("RECORD_HASH", "record_hash", "record_hash is not null"), (key.upper(), key, "true"))]
    parts += [f"select '{name}', 0, count(*) filter (where {condition}) from {rows}" for name, condition in invalid.items()]
    return "select *, actual_value - expected_value as variance, case when actual_value = expected_value then 'PASS' else 'FAIL' end as check_status from (" + " union all ".join(parts) + ")"


_NO_TIMES = "try_cast(created_at as timestamp) is null or try_cast(updated_at as timestamp) is null"
_OTHER_CUSTOMER = "upper(customer_status) not in ('ACTIVE', 'INACTIVE', 'SUSPENDED')"
_BLANK_CUSTOMER = "trim(customer_id) = '' or trim(customer_name) = '' or email is null"
_OTHER_APPLICATION = "upper(application_status) not in ('SUBMITTED', 'UNDER_REVIEW', 'APPROVED', 'REJECTED')"
_BAD_APPLICATION = "trim(customer_id) = '' or try_cast(application_date as date) is null or try_cast(requested_amount as decimal(18,2)) is null"
_UNDECIDED = "upper(application_status) in ('APPROVED', 'REJECTED') and decision_date is null"


def _errors_sql(rows: str, required: tuple[str, ...], status: str, known: str, more: str) -> str:
    parts = [f"select n as file_row_number, '{f}' as field, 'REQUIRED_FIELD_MISSING' as code, 'Required field {f} is null, missing or empty' as message from {rows} where nullif(trim({f}), '') is null" for f in required]
    parts.append(f"select n, '{status}', 'INVALID_ACCEPTED_VALUE', 'Field {status} contains unsupported value: ' || coalesce({status}, '<NULL>') from {rows} where has_status and coalesce(upper(trim({status})) not in ({known}), true)")
    return " union all ".join([*parts, more])


_SHOWN = "ingestion_record_id, record_hash, file_name, strftime(loaded, '%Y-%m-%d %H:%M:%S') as load_timestamp, strftime(loaded, '%Y-%m-%d') as source_date"
_TIMES = ", ".join(f"strftime(try_cast({c} as timestamp), '%Y-%m-%d %H:%M:%S') as {c}" for c in ("created_at", "updated_at"))
_CUSTOMER = f"trim(customer_id) as customer_id, trim(customer_name) as customer_name, lower(trim(email)) as email, city_title as city, upper(trim(customer_status)) as customer_status, {_TIMES}, {_SHOWN}"
_APPLICATION = f"application_id, customer_id, upper(application_status) as application_status, strftime(try_cast(application_date as date), '%Y-%m-%d') as application_date, try_cast(requested_amount as decimal(18,2))::double as requested_amount, decision_date, {_SHOWN}"


def _silver_sql(first: str, second: str, key: str, event: str) -> str:
    """With the staged rows a (first versions) and b (second ones)."""
    rank = f"row_number() over (partition by {key} order by {event} desc nulls last, load_timestamp desc, ingestion_record_id desc nulls last, prio desc) as version_rank"
    return f"""with {first}, {second}, held as (select * exclude (version_rank, prio) from (select *, {rank} from (select *, 0 as prio from a)) where version_rank = 1),
    incoming as (select *, 0 as prio from (select * from a union all select * from b) where load_timestamp >= (select strftime(max(load_timestamp::timestamp) - interval 3 days, '%Y-%m-%d %H:%M:%S') from held)),
    best as (select * exclude (version_rank, prio) from (select *, {rank} from (select * from incoming union all select *, 1 from held where {key} in (select {key} from incoming))) where version_rank = 1),
    delta as (select best.* from best left join held using ({key}) where held.{key} is null or coalesce(best.record_hash, '') <> coalesce(held.record_hash, ''))
    select * from held where {key} not in (select {key} from delta) union all select * from delta"""


ORACLE_SQL = {
    "landed_parquet_files": "select count(*) as n_rows, 0::bigint as n_bad_files from lineitem",
    "constructed_objects": """with o as (select event_id, case when value > 50 then '"big":"yes",' else '' end as big, case when value > 50 then '"big":"yes",' else '"big":null,' end as kept, '"event_type":"' || event_type || '","user_id":"' || user_id || '"}' as rest from events)
        select event_id, '{' || big || rest as without_nulls, '{' || kept || rest as with_nulls, sha256('{' || kept || rest) as record_hash from o""",
    "raw_checks_customers": f"with {_customers_sql('cust')} " + _checks_sql("cust", 1000, "customer_id", _BLANK_CUSTOMER, {"INVALID_CUSTOMER_STATUS": f"{_OTHER_CUSTOMER} or not has_status", "INVALID_TIMESTAMP_VALUES": _NO_TIMES}),
    "raw_checks_applications": f"with {_applications_sql('app')} " + _checks_sql("app", 1650, "application_id", f"{_BAD_APPLICATION} or application_status is null", {"INVALID_APPLICATION_STATUS": f"{_OTHER_APPLICATION} or not has_status", "INVALID_DECISION_DATE": _UNDECIDED}),
    "raw_payments_required_fields": f"with {_PAYMENTS} select count(*) filter (where no_update) as invalid_required_fields from pay",
    "invalid_customer_records": f"with {_customers_sql('cust')} select file_name, n as file_row_number from cust where {_BLANK_CUSTOMER} or {_OTHER_CUSTOMER} or {_NO_TIMES}",
    "invalid_application_records": f"with {_applications_sql('app')} select file_name, n as file_row_number from app where {_BAD_APPLICATION} or {_OTHER_APPLICATION} or ({_UNDECIDED})",
    "variant_customer_errors": f"with {_customers_sql('cust')} " + _errors_sql("cust", ("customer_id", "customer_name", "email", "customer_status", "created_at"), "customer_status", "'ACTIVE', 'INACTIVE'", "select n, 'email', 'PATTERN_MISMATCH', 'Field email does not match the configured pattern' from cust where not regexp_full_match(email, '[^@ ]+@[^@ ]+[.][^@ ]+')"),
    "variant_application_errors": f"with {_applications_sql('app')} " + _errors_sql("app", ("application_id", "customer_id", "application_status", "application_date", "requested_amount"), "application_status", "'SUBMITTED', 'UNDER_REVIEW', 'APPROVED', 'REJECTED'", "select n, 'requested_amount', 'VALUE_NOT_GREATER_THAN', 'Field requested_amount must be greater than 0' from app where coalesce(try_cast(requested_amount as decimal(38,10)) <= 0, true)"),
    "stg_customers": f"with {_customers_sql('cust')} select {_CUSTOMER} from cust",
    "stg_applications": f"with {_applications_sql('app')} select {_APPLICATION} from app",
    "stg_payments": f"with {_PAYMENTS} select payment_id, application_id, payment_amount::decimal(18,2)::double as payment_amount, upper(trim(payment_status)) as payment_status, strftime(try_cast(payment_date as timestamp), '%Y-%m-%d %H:%M:%S') as payment_date, trim(payment_method) as payment_method, {_SHOWN} from pay",
    "silver_customers": _silver_sql(f"{_customers_sql('raw1')}, a as (select {_CUSTOMER} from raw1)", f"{_customers_sql('raw2', 2)}, b as (select {_CUSTOMER} from raw2)", "customer_id", "coalesce(updated_at, created_at, load_timestamp)"),
    "silver_applications": _silver_sql(f"{_applications_sql('raw1')}, a as (select {_APPLICATION} from raw1)", f"{_applications_sql('raw2', 2)}, b as (select {_APPLICATION} from raw2)", "application_id", "coalesce(decision_date || ' 00:00:00', application_date || ' 00:00:00', load_timestamp)"),
}

_RUN = "select {step}::bigint as step, '{entity}' as entity_name, 'COMPLETED' as status, n as source_rows, {loaded} as loaded_rows, bad as rejected_rows, {duplicate} as duplicate_rows, 0::bigint as variance_rows, 'PASSED' as reconciliation_status from {counts}"
ORACLE_SQL["ingestion_runs"] = f"""with c as ({ORACLE_SQL["variant_customer_errors"]}), a as ({ORACLE_SQL["variant_application_errors"]}),
    cc as (select (select count(*) from customer) as n, (select count(distinct file_row_number) from c) as bad), ac as (select (select count(*) from orders) as n, (select count(distinct file_row_number) from a) as bad)
    {_RUN.format(step=1, entity="CUSTOMERS", loaded="n - bad", duplicate="0::bigint", counts="cc")} union all {_RUN.format(step=2, entity="APPLICATIONS", loaded="n - bad", duplicate="0::bigint", counts="ac")}
    union all select 3, 'CUSTOMERS', 'SKIPPED', null, null, null, null, null, null union all {_RUN.format(step=4, entity="CUSTOMERS", loaded="0::bigint", duplicate="n - bad", counts="cc")}"""
