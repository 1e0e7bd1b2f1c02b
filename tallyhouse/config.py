"""Table configurations and deploy-time defaults."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Loader parameters.
LOOKBACK_HOURS = 26
FETCH_SIZE = 50_000
SOURCE_SYSTEM = "rms"

# Ids that classify groups, requests and people; every operator
# that uses one takes it as an argument with this default.
DOOR_HOLDER_GROUP_TYPE = 34
CONNECT_GROUP_TYPE = 38
DOOR_HOLDER_OPPORTUNITY = 60
CONNECT_GROUP_OPPORTUNITIES = (68, 69)
ACTIVE_RECORD_STATUS = 3


@dataclass(frozen=True)
class TableConfig:
    """What to extract from one source table and how to merge it.

    `columns` empty means every column the source offers. A large table names the
    creation time of its rows in `partition_column`, by whose month it may be kept.
    """

    source_table: str
    target: str
    primary_key: str = "Id"
    modified_column: str | None = "ModifiedDateTime"
    columns: tuple[str, ...] = ()
    decimal_columns: tuple[str, ...] = ()
    partition_column: str | None = None

    def column_list(self, available: list[str]) -> list[str]:
        """Configured columns, first mention wins, in the configured order."""
        return list(dict.fromkeys(self.columns)) or list(available)


CREATED = "CreatedDateTime"

# Source tables, bronze names, change columns and money columns.
TABLES: dict[str, TableConfig] = {
    "person": TableConfig("dbo.Person", "people"),
    "group": TableConfig("dbo.[Group]", "groups"),
    "person_historical": TableConfig(
        "dbo.AnalyticsDimPersonHistorical", "analytics_dim_person_historical",
        modified_column="EffectiveDate"),
    "transaction": TableConfig("dbo.FinancialTransaction", "financial_transactions",
                               partition_column=CREATED),
    "transaction_detail": TableConfig(
        "dbo.FinancialTransactionDetail", "financial_transaction_details",
        decimal_columns=("Amount", "FeeAmount", "FeeCoverageAmount", "ForeignCurrencyAmount"),
        partition_column=CREATED),
    "group_member": TableConfig("dbo.GroupMember", "group_members"),
    "attendance": TableConfig("dbo.Attendance", "attendance", partition_column=CREATED),
    "attendance_occurrence": TableConfig("dbo.AttendanceOccurrence", "attendance_occurrences"),
    "connection_request": TableConfig("dbo.ConnectionRequest", "connection_requests",
                                      partition_column=CREATED),
    "financial_account": TableConfig("dbo.FinancialAccount", "financial_accounts"),
    # Aliases carry no change time: full loads only.
    "person_alias": TableConfig("dbo.PersonAlias", "person_aliases", modified_column=None),
    "defined_value": TableConfig("dbo.DefinedValue", "defined_values"),
    "group_type": TableConfig(
        "dbo.GroupType", "group_types",
        decimal_columns=("LeaderToLeaderRelationshipMultiplier",
                         "LeaderToNonLeaderRelationshipMultiplier",
                         "NonLeaderToLeaderRelationshipMultiplier",
                         "NonLeaderToNonLeaderRelationshipMultiplier")),
    "campus": TableConfig("dbo.Campus", "campuses", decimal_columns=("TitheMetric",)),
    "connection_opportunity": TableConfig(
        "dbo.ConnectionOpportunity", "connection_opportunities"),
}


def list_tables(configs: dict[str, TableConfig] = TABLES) -> list[tuple[str, str, str]]:
    """(key, source table, bronze table) of every configured table."""
    return [(k, c.source_table, c.target) for k, c in configs.items()]


def session(app: str = "tallyhouse", cores: int | str = "*", **conf) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (SparkSession.builder.appName(app).master(f"local[{cores}]")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", "8g"))
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's spark.checkpoint.dir. Only a local session may
    leave that unset; it gets a folder in its warehouse."""
    base = (spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared"
    return f"{base.rstrip('/')}/{purpose}-{os.urandom(6).hex()}"
