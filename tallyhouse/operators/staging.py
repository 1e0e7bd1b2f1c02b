"""Silver staging: one row per bronze row, renamed, cast and decoded.

A model is an allow-list. Bronze names follow one rule (`snake`), so a model only
states which columns it keeps, which are bits, dates or decimals, and the few
names the rule does not give. Columns left out (search values, comments, bank
fields, internal messages) never leave bronze.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ACTIVE_RECORD_STATUS
from ..functions.columns import as_col, decode
from ..functions.dates import as_date, whole_days_between

# Code labels; any other code (or none) is 'Unknown'.
GENDER = {1: "Male", 2: "Female"}
EMAIL_PREFERENCE = {0: "Email Allowed", 1: "No Mass Emails", 2: "Do Not Email"}
MEMBER_STATUS = {0: "Inactive", 1: "Active", 2: "Pending"}
RSVP = {1: "Yes", 2: "No", 3: "Maybe"}
CONNECTION_STATE = {0: "Active", 1: "Inactive", 2: "Future Follow-up", 3: "Connected"}
CONNECTED = 3


def snake(name: str) -> str:
    """CamelCase to snake_case, with ...DateTime columns named as instants."""
    base = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name).lower()
    return re.sub(r"_?date_time$", "_at", base)


# Names the rule does not give.
COMMON = {"CreatedDateTime": "created_at", "ModifiedDateTime": "updated_at",
          "Order": "sort_order", "_loaded_at": "_bronze_loaded_at"}


@dataclass(frozen=True)
class Model:
    entity: str
    keep: tuple[str, ...]
    flags: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    decimals: tuple[str, ...] = ()
    names: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        """Bronze columns the model reads."""
        return [*self.keep, *self.flags, *self.dates, *self.decimals]

    def name_of(self, bronze: str) -> str:
        special = {"Id": f"{self.entity}_id", "Guid": f"{self.entity}_guid"} | COMMON | self.names
        if bronze in special:
            return special[bronze]
        name = snake(bronze)
        verb = name.startswith(("is_", "takes_", "show_", "allow_", "uses_", "was_", "did_"))
        return name if verb or bronze not in self.flags else f"is_{name}"

    def rename(self, bronze: DataFrame) -> DataFrame:
        kinds = {c: kind for kind, listed in (("BOOLEAN", self.flags), ("DATE", self.dates),
                                              ("DECIMAL(38,9)", self.decimals))
                 for c in listed}
        return bronze.selectExpr(*[
            f"CAST(`{c}` AS {kinds[c]}) AS {self.name_of(c)}" if c in kinds
            else f"`{c}` AS {self.name_of(c)}" for c in self.columns])


AUDIT = ("CreatedDateTime", "ModifiedDateTime", "_loaded_at")

# The columns each model exposes.
PEOPLE = Model(
    "person",
    ("Id", "Guid", "PrimaryFamilyId", "PrimaryCampusId", "GivingId", "FirstName", "NickName",
     "MiddleName", "LastName", "BirthDay", "BirthMonth", "BirthYear", "Gender",
     "MaritalStatusValueId", "Email", "EmailPreference", "RecordTypeValueId",
     "RecordStatusValueId", "ConnectionStatusValueId", *AUDIT),
    flags=("IsEmailActive", "IsDeceased"),
    names={"Gender": "gender_code", "EmailPreference": "email_preference_code"})
PERSON_ALIASES = Model(
    "person_alias",
    ("Id", "Guid", "PersonId", "AliasPersonId", "AliasPersonGuid", "Name", "AliasedDateTime",
     "LastVisitDateTime", "_loaded_at"))
PERSON_HISTORICAL = Model(
    "person_historical",
    ("Id", "PersonId", "CurrentRowIndicator", "EffectiveDate", "ExpireDate", "PrimaryFamilyId",
     "CampusId", "CampusName", "FirstName", "NickName", "LastName", "GenderText", "MaritalStatus",
     "ConnectionStatus", "RecordStatus", "RecordType", "Email", "EmailPreferenceText",
     "CurrentJourneyGivingStage", "PreviousJourneyGivingStage", "JourneyGivingStageChangeDate",
     "GivingBin", "GivingPercentile", "NextExpectedGiftDate", "MailingAddressStreet1",
     "MailingAddressCity", "MailingAddressState", "MailingAddressPostalCode",
     "MailingAddressFull", "_loaded_at"),
    flags=("IsDeceased",),
    names={"CurrentRowIndicator": "is_current_row", "GenderText": "gender",
           "EmailPreferenceText": "email_preference"})
GROUPS = Model(
    "group",
    ("Id", "Guid", "ParentGroupId", "GroupTypeId", "CampusId", "GroupAdministratorPersonAliasId",
     "Name", "Description", "StatusValueId", "InactiveDateTime", "ArchivedDateTime", *AUDIT),
    flags=("IsSecurityRole", "IsActive", "IsArchived", "IsPublic", "AllowGuests"))
GROUP_MEMBERS = Model(
    "group_member",
    ("Id", "Guid", "GroupId", "PersonId", "GroupRoleId", "GroupTypeId", "ScheduleTemplateId",
     "GroupMemberStatus", "GuestCount", "GroupOrder", "CommunicationPreference",
     "ScheduleStartDate", "ScheduleReminderEmailOffsetDays", "DateTimeAdded", "InactiveDateTime",
     "ArchivedDateTime", *AUDIT),
    flags=("IsSystem", "IsNotified", "IsArchived", "IsChatMuted", "IsChatBanned"),
    names={"GroupMemberStatus": "group_member_status_code", "DateTimeAdded": "added_at",
           "CommunicationPreference": "communication_preference_code"})
GROUP_TYPES = Model(
    "group_type",
    ("Id", "Guid", "InheritedGroupTypeId", "DefaultGroupRoleId", "GroupTypePurposeValueId",
     "GroupStatusDefinedTypeId", "Name", "Description", "GroupTerm", "GroupMemberTerm", "Order",
     *AUDIT),
    flags=("IsSystem", "TakesAttendance", "ShowInGroupList", "IsSchedulingEnabled",
           "AttendanceCountsAsWeekendService", "EnableGroupHistory"),
    names={"EnableGroupHistory": "is_group_history_enabled",
           "AttendanceCountsAsWeekendService": "attendance_counts_as_weekend_service"})
ATTENDANCE = Model(
    "attendance",
    ("Id", "Guid", "OccurrenceId", "PersonAliasId", "CampusId", "DeviceId", "AttendanceCodeId",
     "AttendanceCheckInSessionId", "SearchResultGroupId", "SearchTypeValueId", "QualifierValueId",
     "SourceValueId", "DeclineReasonValueId", "CheckedInByPersonAliasId",
     "CheckedOutByPersonAliasId", "PresentByPersonAliasId", "ScheduledByPersonAliasId",
     "StartDateTime", "EndDateTime", "PresentDateTime", "RSVPDateTime", "RSVP", "CheckInStatus",
     "Note", *AUDIT),
    flags=("DidAttend", "IsFirstTime", "Processed", "ScheduledToAttend", "RequestedToAttend",
           "ScheduleConfirmationSent", "ScheduleReminderSent"),
    names={"StartDateTime": "started_at", "EndDateTime": "ended_at", "RSVP": "rsvp_code",
           "CheckInStatus": "check_in_status_code"})
OCCURRENCES = Model(
    "occurrence",
    ("Id", "Guid", "GroupId", "LocationId", "ScheduleId", "StepTypeId", "AttendanceTypeValueId",
     "RootGroupTypeId", "OccurrenceDateKey", "Name", "Notes", "AnonymousAttendanceCount", *AUDIT),
    flags=("DidNotOccur",),
    dates=("OccurrenceDate", "SundayDate"))
CAMPUSES = Model(
    "campus",
    ("Id", "Guid", "LocationId", "LeaderPersonAliasId", "TeamGroupId", "CampusStatusValueId",
     "CampusTypeValueId", "Name", "ShortCode", "Description", "Url", "ServiceTimes", "TimeZoneId",
     "Order", "AverageWeekendAttendance", *AUDIT),
    flags=("IsActive", "IsSystem"),
    dates=("OpenedDate", "ClosedDate"),
    decimals=("TitheMetric",))
FINANCIAL_ACCOUNTS = Model(
    "financial_account",
    ("Id", "Guid", "ParentAccountId", "CampusId", "AccountTypeValueId", "ImageBinaryFileId",
     "Name", "PublicName", "Description", "PublicDescription", "GlCode", "Url", "Order", *AUDIT),
    flags=("IsActive", "IsPublic", "IsTaxDeductible", "UsesCampusChildAccounts"),
    dates=("StartDate", "EndDate"))
FINANCIAL_TRANSACTIONS = Model(
    "financial_transaction",
    ("Id", "Guid", "BatchId", "ScheduledTransactionId", "FinancialGatewayId",
     "FinancialPaymentDetailId", "SettledGroupId", "AuthorizedPersonAliasId",
     "ProcessedByPersonAliasId", "TransactionTypeValueId", "SourceTypeValueId",
     "NonCashAssetTypeValueId", "ForeignCurrencyCodeValueId", "TransactionCode", "Status",
     "StatusMessage", "TransactionDateTime", "TransactionDateKey", "ProcessedDateTime",
     "SettledDate", "SettledDateKey", "FutureProcessingDateTime", *AUDIT),
    flags=("IsSettled", "IsReconciled", "ShowAsAnonymous"),
    dates=("SundayDate",),
    names={"SettledDate": "settled_at"})
TRANSACTION_DETAILS = Model(
    "financial_transaction_detail",
    ("Id", "Guid", "TransactionId", "AccountId", "EntityTypeId", "EntityId", *AUDIT),
    decimals=("Amount", "FeeAmount", "FeeCoverageAmount", "ForeignCurrencyAmount"),
    names={"TransactionId": "financial_transaction_id", "AccountId": "financial_account_id"})
CONNECTION_REQUESTS = Model(
    "connection_request",
    ("Id", "Guid", "ConnectionOpportunityId", "ConnectionTypeId", "ConnectionTypeSourceId",
     "ConnectionStatusId", "PersonAliasId", "ConnectorPersonAliasId", "CampusId",
     "AssignedGroupId", "AssignedGroupMemberRoleId", "AssignedGroupMemberStatus",
     "ConnectionState", "Order", "FollowupDate", "ConnectedDateTime", "CreatedDateKey", *AUDIT),
    flags=("WasCompletedOnTime",),
    dates=("DueDate", "DueSoonDate"),
    names={"AssignedGroupMemberStatus": "assigned_group_member_status_code",
           "ConnectionState": "connection_state_code", "FollowupDate": "followup_at"})
CONNECTION_OPPORTUNITIES = Model(
    "connection_opportunity",
    ("Id", "Guid", "ConnectionTypeId", "Name", "PublicName", "Description", "Summary", "Order",
     "RequestDueDateOffsetInDays", "RequestDueSoonOffsetInDays", *AUDIT),
    flags=("IsActive",),
    names={"RequestDueDateOffsetInDays": "request_due_date_offset_days",
           "RequestDueSoonOffsetInDays": "request_due_soon_offset_days"})
DEFINED_VALUES = Model(
    "defined_value",
    ("Id", "Guid", "DefinedTypeId", "CategoryId", "Value", "Description", "Order", *AUDIT),
    flags=("IsActive", "IsSystem"))


def open_during(active: Column, start: Column, end: Column, as_of,
                end_included: bool) -> Column:
    """Active and inside a validity period whose missing ends are unbounded; false
    (not null) when the active flag is missing."""
    on = as_date(as_of)
    before_end = (end >= on) if end_included else (end > on)
    return F.coalesce(active & (start.isNull() | (start <= on)) & (end.isNull() | before_end),
                      F.lit(False))


def people(bronze: DataFrame, active_status: int = ACTIVE_RECORD_STATUS) -> DataFrame:
    """`full_name` is null without a last name, `birth_date` null unless complete,
    and someone whose deceased flag is missing does not count as active."""
    display = F.coalesce("nick_name", "first_name")
    parts = [F.col(f"birth_{p}").cast("int") for p in ("year", "month", "day")]
    complete = parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull()
    active = (F.col("record_status_value_id") == active_status) & ~F.col("is_deceased")
    return (PEOPLE.rename(bronze)
            .withColumns({
                "display_name": display,
                "full_name": F.concat(display, F.lit(" "), F.col("last_name")),
                "birth_date": F.when(complete, F.make_date(*parts)),
                "gender": decode("gender_code", GENDER),
                "email_preference": decode("email_preference_code", EMAIL_PREFERENCE),
                "is_active": F.coalesce(active, F.lit(False))})
            .drop("nick_name", "gender_code", "email_preference_code"))


def person_aliases(bronze: DataFrame) -> DataFrame:
    return PERSON_ALIASES.rename(bronze).withColumn(
        "is_merged_alias", F.coalesce(F.col("alias_person_id") != F.col("person_id"),
                                      F.lit(False)))


def person_historical(bronze: DataFrame) -> DataFrame:
    return PERSON_HISTORICAL.rename(bronze)


def person_current(historical: DataFrame) -> DataFrame:
    return historical.where("is_current_row")


def groups(bronze: DataFrame) -> DataFrame:
    """`is_currently_active` stays null when an active group's archived flag is missing."""
    return GROUPS.rename(bronze).withColumn(
        "is_currently_active", F.col("is_active") & ~F.col("is_archived"))


def group_members(bronze: DataFrame) -> DataFrame:
    code = F.col("group_member_status_code")
    archived = F.coalesce("is_archived", F.lit(False))
    return GROUP_MEMBERS.rename(bronze).withColumns({
        "group_member_status": decode(code, MEMBER_STATUS),
        "is_currently_active_member": F.coalesce((code == 1) & ~archived, F.lit(False))})


def group_types(bronze: DataFrame) -> DataFrame:
    return GROUP_TYPES.rename(bronze)


def attendance(bronze: DataFrame) -> DataFrame:
    return ATTENDANCE.rename(bronze).withColumns({
        "did_attend": F.coalesce("did_attend", F.lit(False)),
        "rsvp": decode("rsvp_code", RSVP)})


def occurrences(bronze: DataFrame) -> DataFrame:
    return OCCURRENCES.rename(bronze).withColumn(
        "did_occur", ~F.coalesce("did_not_occur", F.lit(False)))


def campuses(bronze: DataFrame, as_of) -> DataFrame:
    """A campus is open until the day before its closing date."""
    return CAMPUSES.rename(bronze).withColumn("is_currently_open", open_during(
        F.col("is_active"), F.col("opened_date"), F.col("closed_date"), as_of, False))


def financial_accounts(bronze: DataFrame, as_of) -> DataFrame:
    """An account is active through its end date."""
    return FINANCIAL_ACCOUNTS.rename(bronze).withColumn("is_currently_active", open_during(
        F.col("is_active"), F.col("start_date"), F.col("end_date"), as_of, True))


def financial_transactions(bronze: DataFrame) -> DataFrame:
    """Stored times are local, so the plain date is the local calendar date."""
    return FINANCIAL_TRANSACTIONS.rename(bronze).withColumn(
        "transaction_date", F.to_date("transaction_at"))


def financial_transaction_details(bronze: DataFrame) -> DataFrame:
    return TRANSACTION_DETAILS.rename(bronze).withColumn(
        "is_refund", F.coalesce(F.col("amount") < 0, F.lit(False)))


def connection_requests(bronze: DataFrame) -> DataFrame:
    state = F.col("connection_state_code")
    return CONNECTION_REQUESTS.rename(bronze).withColumns({
        "connection_state": decode(state, CONNECTION_STATE),
        "is_connected": F.coalesce(state == CONNECTED, F.lit(False)),
        "days_to_connect": F.when(as_col("connected_at").isNotNull(),
                                  whole_days_between("created_at", "connected_at"))})


def connection_opportunities(bronze: DataFrame) -> DataFrame:
    return CONNECTION_OPPORTUNITIES.rename(bronze)


def defined_values(bronze: DataFrame) -> DataFrame:
    return DEFINED_VALUES.rename(bronze)
