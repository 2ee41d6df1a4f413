"""CRM accounts and use cases: nested payloads to typed bronze rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.functions.clock import now, parse_iso


def _nonzero(c: Column) -> Column:
    """Zero means "not filled in" for the CRM's numeric fields."""
    return F.nullif(c, F.lit(0).cast("int"))


def engaged_accounts(raw: DataFrame, owner_email: str) -> DataFrame:
    """Payloads whose engaged person has that e-mail address."""
    return raw.where(F.col("Engaged.Email") == owner_email)


def flatten_accounts(raw: DataFrame, owner_email: str, as_of: datetime) -> DataFrame:
    """Typed accounts of one engaged person, largest revenue first.

    A missing relation gives NULL, and so do zero numbers.
    """
    return (engaged_accounts(raw, owner_email)
            .orderBy(F.col("Revenue").desc_nulls_last(), "Id")
            .select(
                F.col("Id").alias("account_id"), F.col("Name").alias("account_name"),
                F.col("Type").alias("type"), F.col("Industry").alias("industry"),
                F.col("Vertical").alias("vertical"),
                _nonzero(F.col("Revenue")).alias("arr"),
                _nonzero(F.col("RevenueQuarter")).alias("t3m_arr"),
                _nonzero(F.col("NumberOfEmployees")).alias("number_of_employees"),
                F.col("BillingCity").alias("billing_city"),
                F.col("BillingState").alias("billing_state"),
                F.col("BillingCountry").alias("billing_country"),
                F.col("Owner.Name").alias("owner_name"),
                F.col("EngagedId").alias("last_sa_engaged_id"),
                F.col("Engaged.Name").alias("last_sa_engaged_name"),
                now(as_of).alias("_extracted_at")))


def flatten_use_cases(raw: DataFrame, accounts: DataFrame, owner_email: str,
                      as_of: datetime) -> DataFrame:
    """Typed use cases of the accounts of one engaged person, newest change first.

    The account restriction is a left semi join: each use case at most once,
    no account columns shuffled but the id.
    """
    wanted = engaged_accounts(accounts, owner_email).select(F.col("Id").alias("AccountId"))
    return (raw.join(wanted, "AccountId", "left_semi")
            .select(
                F.col("Id").alias("uco_id"), F.col("AccountId").alias("account_id"),
                F.col("Account.Name").alias("account_name"), F.col("Name").alias("uco_name"),
                F.col("Stage").alias("stage"), F.col("Description").alias("description"),
                F.col("Type").alias("use_case_type"),
                F.col("Status").alias("implementation_status"),
                parse_iso(F.col("GoLiveDate")).alias("go_live_date"),
                parse_iso(F.col("EstimatedGoLive")).alias("estimated_project_go_live"),
                parse_iso(F.col("LastModifiedDate")).alias("last_modified_date"),
                parse_iso(F.col("CreatedDate")).alias("created_date"),
                F.col("AssignedId").alias("assigned_sa_id"),
                F.col("Assigned.Name").alias("assigned_sa_name"),
                now(as_of).alias("_extracted_at"))
            .orderBy(F.col("last_modified_date").desc_nulls_last(), "uco_id"))
