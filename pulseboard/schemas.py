"""Declared schemas. Bronze fields are nullable; timestamps are UTC wall clock."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (ArrayType, BooleanType, DataType, DoubleType, IntegerType,
                               LongType, StringType, StructField, StructType, TimestampNTZType,
                               VariantType)

TEXT, INT, LONG, REAL = StringType(), IntegerType(), LongType(), DoubleType()
FLAG, TIME, TREE = BooleanType(), TimestampNTZType(), VariantType()


def struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def texts(names: str) -> dict[str, DataType]:
    return dict.fromkeys(names.split(), TEXT)


def with_key(key: str, schema: StructType) -> StructType:
    """The same schema with ``key`` declared NOT NULL."""
    return StructType([StructField(f.name, f.dataType, f.name != key) for f in schema])


TEXTS = ArrayType(TEXT)

# ---- typed bronze tables --------------------------------------------------
ACCOUNTS = struct(
    **texts("account_id account_name type industry vertical"),
    arr=REAL, t3m_arr=REAL, number_of_employees=INT,
    **texts("billing_city billing_state billing_country owner_name last_sa_engaged_id "
            "last_sa_engaged_name"),
    _extracted_at=TIME)

USE_CASES = struct(
    **texts("uco_id account_id account_name uco_name stage description use_case_type "
            "implementation_status"),
    go_live_date=TIME, estimated_project_go_live=TIME, last_modified_date=TIME, created_date=TIME,
    **texts("assigned_sa_id assigned_sa_name"), _extracted_at=TIME)

_MAIL = dict(
    **texts("message_id thread_id account_name customer_label from_email from_name"),
    to_emails=TEXTS, cc_emails=TEXTS, **texts("subject body_snippet body_text"),
    received_date=TIME, labels=TEXTS, is_unread=FLAG, needs_response=FLAG, has_attachment=FLAG)
EMAILS = struct(**_MAIL, _extracted_at=TIME)

MEETINGS = struct(
    **texts("event_id account_name event_title description location"),
    start_time=TIME, end_time=TIME, attendees=TEXTS,
    **texts("video_link status organizer_email html_link"), _extracted_at=TIME)

CHAT = struct(
    **texts("message_ts channel_id channel_name account_name user_id message_text"),
    sent_at=TIME, thread_ts=TEXT, is_reply=FLAG, reply_count=INT, reactions=TEXTS,
    _extracted_at=TIME)

TASKS = struct(
    **texts("task_id parent_task_id tasklist_id tasklist_name title notes status due_date "
            "account_name updated"), _extracted_at=TIME)

DOCUMENTS = struct(
    **texts("file_id file_name account_name modified_time content"), _extracted_at=TIME)

RUN_LOG = struct(
    **texts("run_id source status"), rows_ingested=LONG, run_at=TIME, duration_sec=REAL,
    error_detail=TEXT, rows_rejected=LONG, rows_late=LONG)

# Records that could not be read, beside the tables they were landed for.
QUARANTINE = struct(source=TEXT, record=TEXT, landed_at=TIME)

# ---- raw payloads as landed (JSON) ----------------------------------------
CRM_ACCOUNT = struct(
    **texts("Id Name Type Industry Vertical"), Revenue=REAL, RevenueQuarter=REAL,
    NumberOfEmployees=INT, **texts("BillingCity BillingState BillingCountry"),
    Owner=struct(Name=TEXT), EngagedId=TEXT, Engaged=struct(Name=TEXT, Email=TEXT))

CRM_USE_CASE = struct(
    **texts("Id Name AccountId"), Account=struct(Name=TEXT),
    **texts("Stage Description Type Status GoLiveDate EstimatedGoLive LastModifiedDate "
            "CreatedDate AssignedId"), Assigned=struct(Name=TEXT))

# The MIME tree stays a VARIANT: parts nest to any depth.
MAIL_MESSAGE = struct(
    id=TEXT, threadId=TEXT, labelIds=TEXTS, snippet=TEXT,
    headers=ArrayType(struct(name=TEXT, value=TEXT)), payload=TREE)

_MOMENT = struct(dateTime=TEXT, date=TEXT)
CALENDAR_EVENT = struct(
    **texts("id summary description location hangoutLink"), start=_MOMENT, end=_MOMENT,
    attendees=ArrayType(struct(email=TEXT, responseStatus=TEXT, displayName=TEXT)),
    status=TEXT, organizer=struct(email=TEXT), htmlLink=TEXT)

CHAT_CHANNEL = struct(ord=INT, id=TEXT, name=TEXT, purpose=struct(value=TEXT))

CHAT_MESSAGE = struct(
    **texts("channel ts thread_ts user bot_id text"), reply_count=INT,
    reactions=ArrayType(struct(name=TEXT)))

TASK_PAGE = struct(
    id=TEXT, title=TEXT,
    items=ArrayType(struct(**texts("id parent title notes status due updated"))))

DRIVE_FILE = struct(**texts("id name mimeType modifiedTime parent text"))

# ---- older tables with declared NOT NULL ids ------------------------------
_ORIGIN = dict(ingested_at=TIME, source_system=TEXT)

LEGACY_ACCOUNTS = with_key("account_id", struct(
    **{f.name: f.dataType for f in ACCOUNTS if f.name != "_extracted_at"}, **_ORIGIN))

LEGACY_USE_CASES = with_key("uco_id", struct(
    **texts("uco_id account_id account_name uco_name stage description use_case_type "
            "implementation_status"),
    go_live_date=TIME, full_production_date=TIME, last_modified_date=TIME, created_date=TIME,
    **texts("assigned_sa_id assigned_sa_name"), **_ORIGIN))

LEGACY_EMAILS = with_key("message_id", struct(**_MAIL, **_ORIGIN))

LEGACY_MEETINGS = with_key("event_id", struct(
    **texts("event_id account_name event_title agenda"), start_datetime=TIME, end_datetime=TIME,
    duration_minutes=INT, attendees=ArrayType(struct(**texts("email name response_status"))),
    **texts("organizer_email organizer_name meeting_link location event_status "
            "sa_response_status"),
    is_recurring=FLAG, calendar_id=TEXT, **_ORIGIN))

LEGACY_CHAT = with_key("message_ts", struct(
    **texts("message_ts channel_id channel_name account_name sender_id sender_name message_text "
            "thread_ts"),
    is_thread_reply=FLAG, reply_count=INT, reactions=TEXTS, has_files=FLAG, message_date=TIME,
    **_ORIGIN))

# Names of the older tables.
LEGACY = {
    "sf_accounts": LEGACY_ACCOUNTS,
    "sf_use_cases": LEGACY_USE_CASES,
    "gmail_customer_emails": LEGACY_EMAILS,
    "calendar_events": LEGACY_MEETINGS,
    "slack_messages": LEGACY_CHAT,
}


def empty_like(spark: SparkSession, schema: StructType) -> DataFrame:
    """What a source that is missing or unreachable yields: no rows, right schema."""
    return spark.createDataFrame([], schema)
