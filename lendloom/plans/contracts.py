"""Data contracts: what each entity's files look like and which rules their records must meet."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

KNOWN_RULES = ("ACCEPTED_VALUES", "GREATER_THAN", "PATTERN", "REGEX", "REGEX_MATCH")


@dataclass(frozen=True)
class Rule:
    """A rule for one field. Any rule with a pattern also checks it."""

    field: str
    rule_type: str
    values: tuple[str, ...] = ()
    bound: str | None = None
    pattern: str | None = None


@dataclass(frozen=True)
class Contract:
    entity_name: str
    contract_version: str
    file_type: str
    file_pattern: str
    stage_path: str
    raw_target_table: str
    fields: tuple[str, ...]
    required_fields: tuple[str, ...]
    primary_key_fields: tuple[str, ...]
    rules: tuple[Rule, ...]
    contract_id: int = 0
    source_system: str = "S3"
    stage_name: str = "landing"
    read_options: dict = field(default_factory=dict)
    load_order: int = 1
    is_active: bool = True
    effective_from: datetime = datetime(2020, 1, 1)
    effective_to: datetime | None = None

    def __post_init__(self):
        for rule in self.rules:
            if rule.rule_type not in KNOWN_RULES and not rule.pattern:
                raise ValueError(f"{self.entity_name}: unknown rule {rule.rule_type}")
            if rule.rule_type == "ACCEPTED_VALUES" and not rule.values:
                raise ValueError(f"{self.entity_name}: no accepted values for {rule.field}")

    def in_effect(self, now: datetime) -> bool:
        return self.is_active and self.effective_from <= now and (self.effective_to is None or now < self.effective_to)


#: The three entities' contracts.
CUSTOMERS = Contract("CUSTOMERS", "1.0", "CSV", r".*[.]csv", "customers/", "RAW.RAW_CUSTOMERS", ("customer_id", "customer_name", "email", "city", "customer_status", "created_at", "updated_at"), ("customer_id", "customer_name", "email", "customer_status", "created_at"), ("customer_id",), (Rule("customer_status", "ACCEPTED_VALUES", ("ACTIVE", "INACTIVE")), Rule("email", "REGEX", pattern=r"^[^@ ]+@[^@ ]+[.][^@ ]+$")), 1, load_order=1)
APPLICATIONS = Contract("APPLICATIONS", "1.0", "JSON", r".*[.]json", "applications/", "RAW.RAW_APPLICATIONS", ("application_id", "customer_id", "application_status", "application_date", "requested_amount", "decision_date"), ("application_id", "customer_id", "application_status", "application_date", "requested_amount"), ("application_id",), (Rule("application_status", "ACCEPTED_VALUES", ("SUBMITTED", "UNDER_REVIEW", "APPROVED", "REJECTED")), Rule("requested_amount", "GREATER_THAN", bound="0")), 2, load_order=2)
PAYMENTS = Contract("PAYMENTS", "1.0", "PARQUET", r".*[.]parquet", "payments/", "RAW.RAW_PAYMENTS", ("payment_id", "application_id", "payment_amount", "payment_status", "payment_date", "payment_method"), ("payment_id", "application_id", "payment_amount", "payment_status", "payment_date"), ("payment_id",), (Rule("payment_status", "ACCEPTED_VALUES", ("PENDING", "COMPLETED", "FAILED", "REFUNDED")), Rule("payment_amount", "GREATER_THAN", bound="0")), 3, load_order=3)
SEED = (CUSTOMERS, APPLICATIONS, PAYMENTS)


def active_contracts(contracts: tuple[Contract, ...], entity: str, now: datetime) -> list[Contract]:
    return [c for c in contracts if c.entity_name == entity and c.in_effect(now)]


def upsert(contracts: tuple[Contract, ...], new: Contract) -> tuple[Contract, ...]:
    """Contracts with `new` in place of the one of the same entity and version, whose id it keeps, or added under a new id."""
    same = [c for c in contracts if (c.entity_name, c.contract_version) == (new.entity_name, new.contract_version)]
    number = same[0].contract_id if same else max((c.contract_id for c in contracts), default=0) + 1
    return (*(c for c in contracts if c not in same), replace(new, contract_id=number))


def as_frame(spark: SparkSession, contracts: tuple[Contract, ...]) -> DataFrame:
    """The contract table: a row per contract, its rules as JSON text."""
    rows = [(c.contract_id, c.entity_name, c.contract_version, c.source_system, c.stage_name, c.stage_path, c.file_type, c.file_pattern, c.raw_target_table, list(c.fields), list(c.required_fields), list(c.primary_key_fields), json.dumps([asdict(r) for r in c.rules]), c.load_order, c.is_active, c.effective_from, c.effective_to) for c in contracts]
    return spark.createDataFrame(rows, "contract_id long, entity_name string, contract_version string, source_system string, stage_name string, stage_path string, file_type string, file_pattern string, raw_target_table string, field_mapping array<string>, required_fields array<string>, primary_key_fields array<string>, validation_rules string, load_order int, is_active boolean, effective_from timestamp_ntz, effective_to timestamp_ntz")
