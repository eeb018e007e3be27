"""Contract validation: rules compiled to column expressions, so a batch is checked in one pass without joins."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendloom.functions.expressions import blank_to_null, full_match, has_field, variant_text
from lendloom.plans.contracts import Contract, Rule

ERROR = "struct<field: string, code: string, message: string>"
#: How a field of a record is read, and whether it is there.
Reader = Callable[[str], Column]


def _error(field: str, code: str, message: Column | str) -> Column:
    return F.struct(F.lit(field).alias("field"), F.lit(code).alias("code"), (F.lit(message) if isinstance(message, str) else message).alias("message"))


def required_error(field: str, value: Column) -> Column:
    return F.when(blank_to_null(value).isNull(), _error(field, "REQUIRED_FIELD_MISSING", f"Required field {field} is null, missing or empty"))


def accepted_error(rule: Rule, value: Column, present: Column) -> Column:
    """A value that is there, JSON null included, and matches none but for case and outer spaces."""
    known = F.upper(F.trim(value)).isin([v.strip().upper() for v in rule.values])
    message = F.concat(F.lit(f"Field {rule.field} contains unsupported value: "), F.coalesce(value, F.lit("<NULL>")))
    return F.when(present & ~F.coalesce(known, F.lit(False)), _error(rule.field, "INVALID_ACCEPTED_VALUE", message))


def greater_error(rule: Rule, value: Column, present: Column) -> Column:
    number = value.try_cast("decimal(38,10)")
    over = F.coalesce(number > F.lit(rule.bound).cast("decimal(38,10)"), F.lit(False))
    return F.when(present & ~over, _error(rule.field, "VALUE_NOT_GREATER_THAN", f"Field {rule.field} must be greater than {rule.bound}"))


def pattern_error(rule: Rule, value: Column, present: Column) -> Column:
    return F.when(present & value.isNotNull() & ~full_match(value, rule.pattern), _error(rule.field, "PATTERN_MISMATCH", f"Field {rule.field} does not match the configured pattern"))


def rule_errors(rule: Rule, value: Column, present: Column) -> list[Column]:
    out = []
    if rule.rule_type == "ACCEPTED_VALUES":
        out.append(accepted_error(rule, value, present))
    if rule.rule_type == "GREATER_THAN":
        out.append(greater_error(rule, value, present))
    if rule.pattern:
        out.append(pattern_error(rule, value, present))
    return out


def contract_errors(contract: Contract, value: Reader | None = None, present: Reader | None = None) -> Column:
    """Sorted array of a record's errors; empty for a valid one. By default fields are read from VARIANT raw_record."""
    value = value or (lambda f: variant_text("raw_record", f))
    present = present or (lambda f: has_field("raw_record", f))
    errors = [required_error(f, value(f)) for f in contract.required_fields]
    errors += [e for rule in contract.rules for e in rule_errors(rule, value(rule.field), present(rule.field))]
    return F.array_sort(F.filter(F.array(*errors), lambda e: e.isNotNull())) if errors else F.array().cast(f"array<{ERROR}>")


RULE = "struct<field: string, required: boolean, accepted: array<string>, bound: string, pattern: string>"


def rule_table(spark: SparkSession, contracts: Iterable[Contract]) -> DataFrame:
    """(contract_id, contract_version, rules): what each version asks of its records, as data; a row a version."""
    rows = []
    for c in contracts:
        rules = [(f, True, None, None, None) for f in c.required_fields]
        for r in c.rules:
            accepted = [v.strip().upper() for v in r.values] if r.rule_type == "ACCEPTED_VALUES" else None
            rules.append((r.field, False, accepted, r.bound if r.rule_type == "GREATER_THAN" else None, r.pattern))
        rows.append((c.contract_id, c.contract_version, rules))
    return spark.createDataFrame(rows, f"contract_id long, contract_version string, rules array<{RULE}>")


def errors_by_rules(rules: str, fields: str) -> Column:
    """contract_errors of a record, whose fields are a map of texts, by rules that stand beside it as data.

    A rule may check several things, so each gives a list of errors.
    """
    fields = F.col(fields)

    def of_rule(rule: Column) -> Column:
        name = rule["field"]
        value, present = F.try_element_at(fields, name), F.coalesce(F.map_contains_key(fields, name), F.lit(False))

        def error(condition: Column, code: str, *message: Column) -> Column:
            return F.when(condition, F.struct(name.alias("field"), F.lit(code).alias("code"), F.concat(*message).alias("message")))

        known = F.coalesce(F.array_contains(rule["accepted"], F.upper(F.trim(value))), F.lit(False))
        over = F.coalesce(value.try_cast("decimal(38,10)") > rule["bound"].cast("decimal(38,10)"), F.lit(False))
        matches = F.rlike(value, F.concat(F.lit(r"\A(?:"), rule["pattern"], F.lit(r")\z")))
        return F.array(
            error(rule["required"] & blank_to_null(value).isNull(), "REQUIRED_FIELD_MISSING", F.lit("Required field "), name, F.lit(" is null, missing or empty")),
            error(rule["accepted"].isNotNull() & present & ~known, "INVALID_ACCEPTED_VALUE", F.lit("Field "), name, F.lit(" contains unsupported value: "), F.coalesce(value, F.lit("<NULL>"))),
            error(rule["bound"].isNotNull() & present & ~over, "VALUE_NOT_GREATER_THAN", F.lit("Field "), name, F.lit(" must be greater than "), rule["bound"]),
            error(rule["pattern"].isNotNull() & value.isNotNull() & ~matches, "PATTERN_MISMATCH", F.lit("Field "), name, F.lit(" does not match the configured pattern")),
        )

    return F.array_sort(F.filter(F.flatten(F.transform(rules, of_rule)), lambda e: e.isNotNull()))


def validate_by_rules(work: DataFrame, rules: DataFrame) -> DataFrame:
    """work, whose records name their contract's id and version, with validation_errors and validation_status.

    The rules are joined to the records, so one batch may hold several contracts and versions of them; a record whose
    contract has no row fails the join, and the batch with it.
    """
    found = work.join(rules.withColumn("_found", F.lit(True)), ["contract_id", "contract_version"], "left")
    found = found.withColumn("_fields", F.from_json(F.to_json("raw_record"), "map<string,string>"))  # read once a record
    none = F.raise_error(F.concat(F.lit("no contract "), F.coalesce(F.col("contract_id").cast("string"), F.lit("<NULL>")), F.lit(" "), F.coalesce("contract_version", F.lit("<NULL>"))))
    checked = found.withColumn("validation_errors", F.when(F.col("_found"), errors_by_rules("rules", "_fields")).otherwise(none.cast(f"array<{ERROR}>")))
    return checked.withColumn("validation_status", F.when(F.size("validation_errors") > 0, "INVALID").otherwise("VALID")).select(*work.columns, "validation_errors", "validation_status")


def validate(work: DataFrame, contract: Contract) -> DataFrame:
    """work with validation_errors and validation_status."""
    checked = work.withColumn("validation_errors", contract_errors(contract))
    return checked.withColumn("validation_status", F.when(F.size("validation_errors") > 0, "INVALID").otherwise("VALID"))


def error_rows(validated: DataFrame, id: str = "ingestion_record_id") -> DataFrame:
    """One row per error."""
    return validated.select(id, F.inline("validation_errors"))


def reject_rows(validated: DataFrame) -> DataFrame:
    """One quarantine row per invalid record."""
    invalid = validated.where("validation_status = 'INVALID'")
    return invalid.select(
        *(c for c in ("batch_id", "file_load_id", "entity_name", "contract_id", "contract_version", "full_file_path", "file_name", "file_row_number", "ingestion_record_id", "record_hash", "raw_record") if c in validated.columns),
        F.lit("CONTRACT_VALIDATION").alias("rejection_category"),
        F.lit("CONTRACT_VALIDATION_FAILED").alias("rejection_code"),
        F.array_join(F.transform("validation_errors", lambda e: e["message"]), "; ").alias("rejection_reason"),
        F.array_sort(F.array_distinct(F.transform("validation_errors", lambda e: e["field"]))).alias("failed_fields"),
        F.to_json(F.struct("validation_errors")).alias("validation_details"),
        F.lit("OPEN").alias("resolution_status"),
    )


def new_rejects(rejects: DataFrame, held: DataFrame) -> DataFrame:
    """Rejects that the quarantine doesn't hold yet, so that a rerun adds none."""
    return rejects.join(held, ["batch_id", "ingestion_record_id", "rejection_category"], "left_anti")


def mark_duplicates(valid: DataFrame, raw: DataFrame, within: bool = False) -> DataFrame:
    """valid rows with processed_status DUPLICATE where raw holds the hash, else PENDING.

    within: of rows that share a hash in the batch itself, all but the first count as duplicates too. raw's hashes are first
    cut down to those of the batch: where these are small enough to be broadcast, raw is only scanned.
    """
    wanted = valid.where(F.col("record_hash").isNotNull()).select(F.col("record_hash").alias("_hash")).distinct()
    return mark_known(valid, raw.select("record_hash").join(wanted.withColumnRenamed("_hash", "record_hash"), "record_hash", "left_semi"), within)


def mark_known(valid: DataFrame, known_hashes: DataFrame, within: bool = False) -> DataFrame:
    """mark_duplicates for hashes (record_hash) of which it is known that raw holds them."""
    held = known_hashes.select(F.col("record_hash").alias("_hash")).distinct()
    out = valid.join(held, F.col("record_hash") == F.col("_hash"), "left")
    known = F.col("_hash").isNotNull()
    if within:
        first = valid.groupBy("record_hash").agg(F.min("ingestion_record_id").alias("_first"))
        out = out.join(first, "record_hash", "left")
        known = known | (F.col("_first").isNotNull() & (F.col("ingestion_record_id") != F.col("_first")))
    return out.withColumn("processed_status", F.when(known, "DUPLICATE").otherwise("PENDING")).select(*valid.columns, "processed_status")


def counts() -> list[Column]:
    """Source, valid, rejected, duplicate and loadable rows, as aggregates."""
    status, done = F.col("validation_status"), F.col("processed_status")
    return [F.count(F.lit(1)).alias("source_rows"), F.count_if(status == "VALID").alias("valid_rows"), F.count_if(status == "INVALID").alias("rejected_rows"), F.count_if(done == "DUPLICATE").alias("duplicate_rows"), F.count_if((status == "VALID") & (done != "DUPLICATE")).alias("loaded_rows")]


def batch_counts(rows: DataFrame, *by: str) -> DataFrame:
    """Those counts in one aggregation."""
    return rows.groupBy(*by).agg(*counts())


def reconciled(counts: DataFrame) -> DataFrame:
    """counts with accounted_rows, variance_rows and reconciliation_status."""
    accounted = F.col("loaded_rows") + F.col("rejected_rows") + F.col("duplicate_rows")
    return counts.withColumn("accounted_rows", accounted).withColumn("variance_rows", F.col("source_rows") - F.col("accounted_rows")).withColumn("reconciliation_status", F.when(F.col("variance_rows") == 0, "PASSED").otherwise("FAILED"))
