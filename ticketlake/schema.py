"""Ticket, table and event schemas.

All schemas are explicit: inferring them would read the data twice and would
give different types for different days of the same feed.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: ticket fields (column name, record field name) ------------
TICKET_FIELDS = [
    ("Ticket_ID", "ticket_id"),
    ("Customer_Name", "customer_name"),
    ("Customer_Email", "customer_email"),
    ("Ticket_Subject", "ticket_subject"),
    ("Ticket_Description", "ticket_description"),
    ("Issue_Category", "issue_category"),
    ("Priority_Level", "priority_level"),
    ("Ticket_Channel", "ticket_channel"),
    ("Submission_Date", "submission_date"),
    ("Resolution_Time_Hours", "resolution_time_hours"),
    ("Assigned_Agent", "assigned_agent"),
    ("Satisfaction_Score", "satisfaction_score"),
]

# --- fixed values: ticket vocabularies ---------------------------------------
CATEGORIES = ["Technical", "Account", "Billing", "General Inquiry", "Product Feedback"]
PRIORITIES = ["Low", "Medium", "High", "Critical"]
CHANNELS = ["Web Form", "Chat", "Email", "Phone"]
AGENTS = ["David Kim", "Elena Rodriguez", "Anya Sharma", "Marcus Vance", "Sarah Jenkins"]
SUBJECTS = [
    "Hours of operation inquiry",
    "Data not syncing across devices",
    "2FA login authentication failure",
    "Subscription billing charge question",
    "Export CSV function throwing error",
]

# --- fixed values: row markers -----------------------------------------------
DATA_SOURCE = "kaggle_crm_customer_tickets"
QUARANTINED = "QUARANTINED"

COLUMNS = [column for column, _ in TICKET_FIELDS]
REQUIRED = ["Ticket_ID", "Customer_Name"]
NUMERIC = ["Resolution_Time_Hours", "Satisfaction_Score"]
OPTIONAL_TEXT = [c for c in COLUMNS if c not in REQUIRED + NUMERIC + ["Priority_Level"]]

RAW_TICKET = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])

TICKET = T.StructType(
    [
        T.StructField(c, T.DoubleType() if c in NUMERIC else T.StringType(), c not in REQUIRED)
        for c in COLUMNS
    ]
)

QUARANTINE = T.StructType(
    [
        T.StructField("raw_record", T.StringType()),
        T.StructField("rejection_reason", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)

DATASET = T.StructType(
    [T.StructField("namespace", T.StringType()), T.StructField("name", T.StringType())]
)

LINEAGE_EVENT = T.StructType(
    [
        T.StructField("eventType", T.StringType()),
        T.StructField("eventTime", T.StringType()),
        T.StructField("run", T.StructType([T.StructField("runId", T.StringType())])),
        T.StructField("job", DATASET),
        T.StructField("inputs", T.ArrayType(DATASET)),
        T.StructField("outputs", T.ArrayType(DATASET)),
        T.StructField("producer", T.StringType()),
    ]
)
