"""Registered queries that go through stored tables and streams, made from the driver's tables, and their DuckDB SQL.

Each works in a new folder of spark.checkpoint.dir: it lands files, runs the step over them, and returns what is held then.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendloom.functions.expressions import variant_text
from lendloom.operators import current_state, validation
from lendloom.plans import catalogue, contracts, graph, raw_catalogue
from lendloom.plans.catalogue import plain
from lendloom.plans.ingest import RECONCILIATIONS, Ingestion, bulk_load
from lendloom.session import scratch_folder
from lendloom.sources.hashes import HashIndex
from lendloom.sources.store import TableStore
from lendloom.streaming import arrivals

#: Payments of every so many-th order arrive after all others; most of them are late then.
HELD_BACK = 10
#: Days that divide the events into three arrivals.
SECOND, THIRD = "20240111", "20240121"


def _store(spark: SparkSession, name: str) -> TableStore:
    return TableStore(spark, scratch_folder(spark, name))


# the current state, merged into a stored table ------------------------------------------------------------------------


def stored_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """silver_merge with a table of the store: the target laid out by key, and the increment merged into it."""
    store, keyed = _store(spark, "merge"), current_state.PAYMENTS
    named, target = catalogue._before_cut(spark, sf_dir)
    held = store.merge("SILVER.PAYMENTS", target, keyed.key)
    merged = store.merge("SILVER.PAYMENTS", current_state.newer(catalogue._increment(named, held), held, keyed), keyed.key)
    return plain(merged.drop("file_last_modified"))


def stored_new_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, and then some of them again with a column more and new keys, merged into one table."""
    store, c = _store(spark, "columns"), catalogue.customers(spark, sf_dir).select("customer_id", "customer_status")
    store.merge("SILVER.CUSTOMERS", c, "customer_id")
    key = F.col("customer_id").cast("long")
    again = c.where(key % 7 == 0).select(F.when(key % 2 == 0, F.concat("customer_id", F.lit("-new"))).otherwise(F.col("customer_id")).alias("customer_id"), F.lit("MERGED").alias("customer_status"), (key * 3).alias("score"))
    return store.merge("SILVER.CUSTOMERS", again, "customer_id").select("customer_id", "customer_status", "score")


def stored_hash_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """duplicate_mark with the raw table's hashes kept apart: filters first, then the divisions that may hold a hash."""
    store = _store(spark, "hashes")
    new, raw = catalogue._split_events(spark, sf_dir)
    for batch, rows in (("early", raw.where(F.col("batch_id") < "20240108")), ("late", raw.where(F.col("batch_id") >= "20240108"))):
        store.write_batch("RAW.EVENTS", rows.select("ingestion_record_id", "record_hash"), batch)
    index = HashIndex(store, "RAW.EVENTS")
    index.catch_up()
    return validation.mark_known(new, index.known(new)).select("ingestion_record_id", "record_hash", "processed_status")


# streams --------------------------------------------------------------------------------------------------------------


def _late_stream(spark: SparkSession, sf_dir: str) -> TableStore:
    """Payments as a stream in three arrivals: those before the cut, those from it on, and those held back.

    What lands are the shipments; their records are made as they are read.
    """
    root = scratch_folder(spark, "late")
    store, shipments = TableStore(spark, f"{root}/lake"), catalogue.table(spark, sf_dir, "lineitem")
    held_back, early = F.col("l_orderkey") % HELD_BACK == 0, F.col("l_shipdate") < F.lit(catalogue.CUT_DAY).cast("timestamp_ntz")
    for part in (~held_back & early, ~held_back & ~early, held_back):
        shipments.where(part).write.mode("append").parquet(f"{root}/in")
        stream = catalogue.payment_records(spark.readStream.schema(shipments.schema).parquet(f"{root}/in"))
        arrivals.merge_stream(stream, store, "SILVER.PAYMENTS", current_state.PAYMENTS, f"{root}/check").awaitTermination()
    return store


def stream_latest_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """silver_latest_payment, kept up to date by a stream whose last arrivals are late."""
    return plain(_late_stream(spark, sf_dir).read("SILVER.PAYMENTS").drop("file_last_modified"))


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of each micro-batch of that stream came later than the look-back."""
    return arrivals.late_rows(_late_stream(spark, sf_dir), "SILVER.PAYMENTS")


def stream_record_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream in three arrivals: each hash is loaded once, with the first arrival that has it."""
    root = scratch_folder(spark, "dedup")
    store, e = TableStore(spark, f"{root}/lake"), catalogue.events(spark, sf_dir).select("ingestion_record_id", "record_hash", F.col("batch_id").alias("day"))
    for part in (F.col("day") < SECOND, F.col("day").between(SECOND, THIRD) & (F.col("day") < THIRD), F.col("day") >= THIRD):
        e.where(part).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(e.schema).parquet(f"{root}/in")
        arrivals.load_stream(stream, store, "RAW.EVENTS", f"{root}/check").awaitTermination()
    arrival = F.when(F.col("day") < SECOND, 1).when(F.col("day") < THIRD, 2).otherwise(3).cast("long")
    return store.read("RAW.EVENTS").select("record_hash", arrival.alias("arrival"))


def _land(spark: SparkSession, raw: DataFrame, contract: contracts.Contract, root: str) -> None:
    fields = [variant_text("raw_record", f).alias(f) for f in contract.fields]
    into = f"{root}/landing/{contract.stage_path.rstrip('/')}"
    out = raw.select(*fields).write.mode("append")
    if contract.file_type == "CSV":
        out.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(into)
    elif contract.file_type == "JSON":
        out.option("ignoreNullFields", False).json(into)
    else:
        out.parquet(into)


def _job(spark: SparkSession, root: str) -> Ingestion:
    return Ingestion(spark, TableStore(spark, f"{root}/lake"), f"{root}/landing")


def _done(run: dict) -> None:
    if run["status"] == "FAILED":
        raise RuntimeError(str(run))


COUNTS = ("source_row_count", "loaded_row_count", "rejected_row_count", "duplicate_row_count", "variance_count", "reconciliation_status")


def stream_ingestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of customers as a stream: their first versions, then all of these again beside the second versions."""
    root = scratch_folder(spark, "arrivals")
    job, first, second = _job(spark, root), *(raw_catalogue.raw_customers(spark, sf_dir, v) for v in (1, 2))
    for rows in (first, first.select("raw_record").unionByName(second.select("raw_record"))):
        _land(spark, rows.coalesce(1), contracts.CUSTOMERS, root)
        arrivals.ingest_stream(job, "CUSTOMERS", f"{root}/check").awaitTermination()
    return job.store.read(RECONCILIATIONS).select("entity_name", *COUNTS)


# whole runs over files ------------------------------------------------------------------------------------------------


def _raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments' records; those of every 25th order have a status that isn't known."""
    p = raw_catalogue.raw_payments(spark, sf_dir)
    fields = {f: variant_text("raw_record", f) for f in contracts.PAYMENTS.fields}
    fields["payment_status"] = F.when(fields["application_id"].cast("long") % 25 == 0, "LOST").otherwise(fields["payment_status"])
    return p.withColumn("raw_record", F.to_variant_object(F.struct(*(v.alias(k) for k, v in fields.items()))))


def payments_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovery to reconciliation of payments as Parquet files, and all of it again by force."""
    root = scratch_folder(spark, "payments")
    job = _job(spark, root)
    _land(spark, _raw_payments(spark, sf_dir), contracts.PAYMENTS, root)
    _done(job.run("PAYMENTS"))
    _done(job.run("PAYMENTS", "REPROCESS", force_reload=True))
    return job.store.read(RECONCILIATIONS).select("entity_name", *COUNTS)


def bulk_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of customers appended without validation, as two batches, the second of them twice."""
    root = scratch_folder(spark, "bulk")
    store = TableStore(spark, f"{root}/lake")
    _land(spark, raw_catalogue.raw_customers(spark, sf_dir), contracts.CUSTOMERS, root)
    uris = [r.path for r in spark.read.format("binaryFile").load(f"{root}/landing/customers/*.csv").select("path").collect()]
    for batch in ("M1", "M2", "M2"):
        bulk_load(spark, store, contracts.CUSTOMERS, uris, batch, datetime(2026, 1, 1))
    raw = store.read(contracts.CUSTOMERS.raw_target_table)
    return raw.groupBy("batch_id", "run_mode").agg(F.count("*").alias("n_rows"), F.count_distinct("ingestion_record_id").alias("n_ids"), F.count_distinct(F.to_json("raw_record")).alias("n_records"))


def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of all three entities through ingestion and the graph of models: how many rows the models have."""
    root = scratch_folder(spark, "models")
    job = _job(spark, root)
    for raw, contract in ((raw_catalogue.raw_customers(spark, sf_dir), contracts.CUSTOMERS), (raw_catalogue.raw_applications(spark, sf_dir), contracts.APPLICATIONS), (_raw_payments(spark, sf_dir), contracts.PAYMENTS)):
        _land(spark, raw, contract, root)
        _done(job.run(contract.entity_name))
    built = graph.run(spark, job.store)
    names = [n for n in built if n.startswith(("stg_", "silver_", "dim_", "fct_")) and n != "dim_date"]
    out = None
    for name in names:
        n = built[name].agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("model"), "n_rows")
        out = n if out is None else out.unionByName(n)
    return out


# several versions of a contract in a batch ----------------------------------------------------------------------------

STRICT = replace(contracts.CUSTOMERS, contract_version="2.0", required_fields=("customer_id", "city"), rules=(contracts.Rule("customer_status", "ACCEPTED_VALUES", ("active", "Closed")), contracts.Rule("customer_id", "GREATER_THAN", bound="50"), contracts.Rule("customer_name", "REGEX", pattern=" Customer#0000[0-9]+ ")))


def contract_versions_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of which every third record follows version 2.0 of the contract, checked in one pass by rules as data."""
    raw = raw_catalogue.raw_customers(spark, sf_dir)
    version = F.when(F.col("file_row_number") % 3 == 0, STRICT.contract_version).otherwise(contracts.CUSTOMERS.contract_version)
    work = raw.withColumns({"contract_id": F.lit(contracts.CUSTOMERS.contract_id).cast("long"), "contract_version": version})
    checked = validation.validate_by_rules(work, validation.rule_table(spark, (contracts.CUSTOMERS, STRICT)))
    return checked.select("file_row_number", "contract_version", F.inline("validation_errors"))


QUERIES = {f.__name__: f for f in (stored_merge, stored_new_columns, stored_hash_marks, stream_latest_payment, stream_late_rows, stream_record_dedup, stream_ingestion, payments_run, bulk_loads, model_rows, contract_versions_errors)}

# the same in DuckDB SQL -----------------------------------------------------------------------------------------------

_NONE = "0::bigint as variance_count, 'PASSED' as reconciliation_status"
_BAD = f"select count(distinct file_row_number) from ({raw_catalogue.ORACLE_SQL['variant_customer_errors']})"
_BAD_2 = "select count(distinct file_row_number) from (" + raw_catalogue.ORACLE_SQL["variant_customer_errors"].replace(raw_catalogue._customers_sql("cust"), raw_catalogue._customers_sql("cust", 2)) + ")"
_BAD_APPLICATIONS = f"select count(distinct file_row_number) from ({raw_catalogue.ORACLE_SQL['variant_application_errors']})"
_STRICT_WRONG = " union all ".join(
    f"select n, '{field}', '{code}', {message} from two where {condition}"
    for field, code, message, condition in (
        ("customer_id", "REQUIRED_FIELD_MISSING", "'Required field customer_id is null, missing or empty'", "trim(customer_id) = ''"),
        ("customer_status", "INVALID_ACCEPTED_VALUE", "'Field customer_status contains unsupported value: ' || coalesce(customer_status, '<NULL>')", "has_status and coalesce(upper(customer_status) not in ('ACTIVE', 'CLOSED'), true)"),
        ("customer_id", "VALUE_NOT_GREATER_THAN", "'Field customer_id must be greater than 50'", "coalesce(try_cast(customer_id as bigint) <= 50, true)"),
        ("customer_name", "PATTERN_MISMATCH", "'Field customer_name does not match the configured pattern'", "not regexp_full_match(customer_name, ' Customer#0000[0-9]+ ')"),
    )
)

ORACLE_SQL = {
    "stored_merge": catalogue.ORACLE_SQL["silver_merge"],
    "stored_new_columns": f"""with {catalogue._CUST}, b as (select case when customer_id::bigint % 2 = 0 then customer_id || '-new' else customer_id end as customer_id, customer_id::bigint * 3 as score from cust where customer_id::bigint % 7 = 0)
        select customer_id, customer_status, null::bigint as score from cust where customer_id not in (select customer_id from b) union all select customer_id, 'MERGED', score from b""",
    "stored_hash_marks": catalogue.ORACLE_SQL["duplicate_mark"],
    "stream_latest_payment": catalogue.ORACLE_SQL["silver_latest_payment"],
    "stream_late_rows": f"""select '2' as epoch, count(*) as n_late from lineitem where l_orderkey % {HELD_BACK} = 0 and l_shipdate < (select max(l_shipdate) - interval 3 days from lineitem where l_orderkey % {HELD_BACK} <> 0) having count(*) > 0
        union all select '1', count(*) from lineitem where l_orderkey % {HELD_BACK} <> 0 and l_shipdate >= timestamp '{catalogue.CUT_DAY}' and l_shipdate < (select max(l_shipdate) - interval 3 days from lineitem where l_orderkey % {HELD_BACK} <> 0 and l_shipdate < timestamp '{catalogue.CUT_DAY}') having count(*) > 0""",
    "stream_record_dedup": f"select sha256(user_id || '|' || event_type || '|' || props) as record_hash, min(case when strftime(ts, '%Y%m%d') < '{SECOND}' then 1 when strftime(ts, '%Y%m%d') < '{THIRD}' then 2 else 3 end)::bigint as arrival from events group by 1",
    "stream_ingestion": f"""with c as (select (select count(*) from customer) as n, (select count(*) from customer where c_custkey % 3 = 0) as n2, ({_BAD}) as bad, ({_BAD_2}) as bad2)
        select 'CUSTOMERS' as entity_name, n as source_row_count, n - bad as loaded_row_count, bad as rejected_row_count, 0::bigint as duplicate_row_count, {_NONE} from c
        union all select 'CUSTOMERS', n + n2, n2 - bad2, bad + bad2, n - bad, {_NONE} from c""",
    "payments_run": f"""with c as (select count(*) as n, count(*) filter (where l_orderkey % 25 = 0) as bad from lineitem)
        select 'PAYMENTS' as entity_name, n as source_row_count, n - bad as loaded_row_count, bad as rejected_row_count, 0::bigint as duplicate_row_count, {_NONE} from c union all select 'PAYMENTS', n, 0, bad, n - bad, {_NONE} from c""",
    "bulk_loads": "select unnest(['M1', 'M2']) as batch_id, 'MANUAL' as run_mode, n as n_rows, n as n_ids, n as n_records from (select count(*) as n from customer)",
    "model_rows": f"""with c as (select count(*) - ({_BAD}) as n from customer), a as (select count(*) - ({_BAD_APPLICATIONS}) as n from orders), p as (select count(*) as n, count(distinct concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)) as u from lineitem where l_orderkey % 25 <> 0)
        select unnest(['stg_customers', 'silver_customers', 'stg_applications', 'silver_applications', 'fct_applications']) as model, unnest([c.n, c.n, a.n, a.n, a.n]) as n_rows from c, a
        union all select unnest(['dim_customers', 'dim_applications', 'stg_payments', 'silver_payments', 'fct_payments']), unnest([c.n + 1, a.n + 1, p.n, p.u, p.u]) from c, a, p""",
    "contract_versions_errors": f"""with {raw_catalogue._customers_sql("two")} select n as file_row_number, '2.0' as contract_version, field, code, message from ({_STRICT_WRONG}) x(n, field, code, message) where n % 3 = 0
        union all select file_row_number, '1.0', field, code, message from ({raw_catalogue.ORACLE_SQL["variant_customer_errors"]}) where file_row_number % 3 <> 0""",
}
