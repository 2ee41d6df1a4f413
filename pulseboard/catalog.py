"""Every query by name, as ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from pulseboard.hosts import AS_OF, bronze
from pulseboard.plans import gold, reports, silver

Query = Callable[[SparkSession, str], DataFrame]


def joined_arrays(df: DataFrame) -> DataFrame:
    """Arrays of strings as ``a;b;c``, to compare results across engines."""
    return df.select(*[
        F.concat_ws(";", f.name).alias(f.name) if isinstance(f.dataType, ArrayType)
        else F.col(f.name) for f in df.schema])


class Inputs:
    """Silver and gold frames over the stand-in bronze tables, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def bronze(self, name: str) -> DataFrame:
        return getattr(bronze, name)(self.spark, self.sf_dir)

    @property
    def accounts(self) -> DataFrame:
        return silver.accounts(self.bronze("accounts"))

    @property
    def use_cases(self) -> DataFrame:
        return silver.use_cases(self.bronze("use_cases"), AS_OF)

    @property
    def emails_core(self) -> DataFrame:
        return silver.emails_core(self.bronze("emails"), AS_OF)

    @property
    def emails(self) -> DataFrame:
        return silver.emails(self.bronze("emails"), self.accounts, AS_OF)

    @property
    def calendar_core(self) -> DataFrame:
        return silver.calendar_core(self.bronze("meetings"), AS_OF)

    @property
    def calendar(self) -> DataFrame:
        return silver.calendar(self.bronze("meetings"), self.accounts, AS_OF)

    @property
    def chat_core(self) -> DataFrame:
        return silver.chat_core(self.bronze("chat"), AS_OF)

    @property
    def chat(self) -> DataFrame:
        return silver.chat(self.bronze("chat"), self.accounts, AS_OF)

    @property
    def tasks(self) -> DataFrame:
        return silver.tasks(self.bronze("tasks"), AS_OF)

    @property
    def documents(self) -> DataFrame:
        return silver.documents(self.bronze("documents"))

    @property
    def activity(self) -> DataFrame:
        return gold.tiered_activity(self.activity_core, self.accounts)

    @property
    def activity_core(self) -> DataFrame:
        return gold.activity(self.emails_core, self.calendar_core, self.chat_core, AS_OF)

    @property
    def health(self) -> DataFrame:
        return gold.health(self.accounts, self.use_cases, self.emails_core, self.calendar_core,
                           self.chat_core)


def _over(build: Callable[[Inputs], DataFrame]) -> Query:
    return lambda spark, sf_dir: joined_arrays(build(Inputs(spark, sf_dir)))


DATASETS: dict[str, Query] = {
    "silver_accounts": _over(lambda i: i.accounts),
    "silver_use_cases": _over(lambda i: i.use_cases),
    "silver_emails": _over(lambda i: i.emails),
    "silver_calendar": _over(lambda i: i.calendar),
    "silver_chat": _over(lambda i: i.chat),
    "silver_tasks": _over(lambda i: i.tasks),
    "silver_documents": _over(lambda i: i.documents),
    "gold_activity": _over(lambda i: i.activity),
    "gold_health": _over(lambda i: i.health),
}

REPORTS: dict[str, Query] = {
    "rpt_account_overview": _over(lambda i: reports.account_overview(i.accounts)),
    "rpt_stage_distribution": _over(lambda i: reports.stage_distribution(i.use_cases)),
    "rpt_stale_ucos": _over(lambda i: reports.stale_use_cases(i.use_cases, AS_OF)),
    "rpt_go_live_soon": _over(lambda i: reports.go_live_soon(i.use_cases, AS_OF)),
    "rpt_health_scorecard": _over(lambda i: reports.health_scorecard(i.health)),
    "rpt_emails_to_answer": _over(lambda i: reports.emails_to_answer(i.emails)),
    "rpt_urgent_emails": _over(lambda i: reports.urgent_emails(i.emails)),
    "rpt_email_volume": _over(lambda i: reports.email_volume(
        i.emails_core, AS_OF, accounts=i.accounts)),
    "rpt_thread_summary": _over(lambda i: reports.thread_summary(i.emails_core, i.accounts)),
    "rpt_week_meetings": _over(lambda i: reports.week_meetings(i.calendar)),
    "rpt_upcoming_meetings": _over(lambda i: reports.upcoming_meetings(i.calendar)),
    "rpt_meeting_frequency": _over(lambda i: reports.meeting_frequency(
        i.calendar_core, AS_OF, accounts=i.accounts)),
    "rpt_meeting_prep": _over(lambda i: reports.meeting_prep(
        i.calendar_core, i.accounts, i.use_cases, i.emails_core)),
    "rpt_chat_engaged": _over(lambda i: reports.engaged_chat(i.chat)),
    "rpt_chat_activity": _over(lambda i: reports.chat_activity(
        i.chat_core, accounts=i.accounts)),
    "rpt_channels_summary": _over(lambda i: reports.channels_summary(i.chat_core, i.accounts)),
    "rpt_top_threads": _over(lambda i: reports.top_threads(i.chat)),
    "rpt_today_actions": _over(lambda i: reports.today_actions(i.activity, AS_OF)),
    "rpt_week_timeline": _over(lambda i: reports.week_timeline(i.activity, AS_OF)),
    "rpt_health_exec": _over(lambda i: reports.health_exec(i.health)),
    "rpt_attention": _over(lambda i: reports.attention(i.health)),
    "rpt_cross_source": _over(lambda i: reports.cross_source(i.health, i.activity_core, AS_OF)),
    "rpt_uco_by_stage": _over(lambda i: reports.use_cases_by_stage(i.use_cases)),
    "rpt_uco_list": _over(lambda i: reports.use_case_list(i.use_cases, AS_OF)),
    "rpt_stage_progression": _over(lambda i: reports.stage_progression(i.use_cases, i.health)),
    "rpt_impl_status": _over(lambda i: reports.implementation_status(i.use_cases)),
    "rpt_go_live_forecast": _over(lambda i: reports.go_live_forecast(i.use_cases, AS_OF)),
}
