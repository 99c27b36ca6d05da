"""Fixed schemas, column lists and constants of the complaints data model."""
from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: case feed fields, in source order -----------------------
API_FIELDS = [
    "complaint_id", "date_received", "date_sent_to_company", "product",
    "sub_product", "issue", "sub_issue", "company", "state", "zip_code",
    "tags", "submitted_via", "company_response", "company_public_response",
    "timely", "complaint_what_happened",
]

# --- fixed values: bulk CSV header -> column name --------------------------
BULK_COLUMN_MAP = {
    "Date received": "date_received",
    "Product": "product",
    "Sub-product": "sub_product",
    "Issue": "issue",
    "Sub-issue": "sub_issue",
    "Consumer complaint narrative": "complaint_what_happened",
    "Company public response": "company_public_response",
    "Company": "company",
    "State": "state",
    "ZIP code": "zip_code",
    "Tags": "tags",
    "Submitted via": "submitted_via",
    "Date sent to company": "date_sent_to_company",
    "Company response to consumer": "company_response",
    "Timely response?": "timely",
    "Consumer disputed?": "consumer_disputed",
    "Complaint ID": "complaint_id",
}

# --- fixed values: responses that count as relief ---------------------------
RELIEF_RESPONSES = ["Closed with monetary relief", "Closed with non-monetary relief"]

# --- fixed values: categorical columns tidied by clean() -------------------
TIDY_CATEGORICALS = ["product", "sub_product", "issue", "sub_issue", "state",
                     "submitted_via", "company_response"]

# --- fixed values: thresholds ----------------------------------------------
NEGATIVE_THRESHOLD = -0.20      # is_negative: compound <= this
CHURN_HIGH_RISK_CUTOFF = 0.50   # churn_high_risk: score >= this
ESCALATION_CUTOFF = 0.5         # escalation_flag: score >= this

# --- fixed values: columns of the scored fact table ------------------------
SCORED_COLUMNS = [
    "complaint_id", "date_received", "year", "month", "year_month", "quarter",
    "product", "sub_product", "issue", "sub_issue", "state", "submitted_via",
    "company_response", "timely", "handling_days", "narrative", "narrative_length",
    "has_narrative", "sent_neg", "sent_neu", "sent_pos", "sent_compound",
    "sentiment_label", "sentiment_band", "is_negative", "is_escalated",
    "escalation_score", "escalation_flag", "churn_risk_label",
    "churn_risk_score", "churn_high_risk", "relief_flag", "timely_flag",
]

# --- fixed values: model feature lists ---------------------------------------
ESCALATION_CATEGORICAL = ["product", "sub_product", "issue", "state", "submitted_via"]
ESCALATION_NUMERIC = ["handling_days", "narrative_length", "has_narrative",
                      "sent_neg", "sent_neu", "sent_pos", "sent_compound"]
CHURN_CATEGORICAL = ["product", "sub_product", "issue", "sub_issue", "state", "submitted_via"]
CHURN_NUMERIC = ["handling_days", "narrative_length", "has_narrative"]
# columns that define the churn label and may never be churn features
CHURN_LEAKY = {"sent_compound", "sent_neg", "sent_pos", "sent_neu", "is_negative",
               "timely_flag", "relief_flag", "company_response", "timely", "is_escalated"}

_STRING_FIELDS = [f for f in API_FIELDS if f not in
                  ("complaint_id", "date_received", "date_sent_to_company")]

# Raw API record as it arrives (everything textual; coerce_types() types it).
RAW_CASE_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType(), True) for f in API_FIELDS]
)

# One API payload file: a JSON array (or JSON lines) of hits with a _source object.
HIT_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType(), True),
    T.StructField("_source", RAW_CASE_SCHEMA, True),
])

# Typed case record after coerce_types().
CASE_SCHEMA = T.StructType(
    [T.StructField("complaint_id", T.LongType(), True),
     T.StructField("date_received", T.TimestampType(), True),
     T.StructField("date_sent_to_company", T.TimestampType(), True)]
    + [T.StructField(f, T.StringType(), True) for f in _STRING_FIELDS]
)

# Bulk CSV: every column read as text under its header name.
BULK_CSV_SCHEMA = T.StructType(
    [T.StructField(h, T.StringType(), True) for h in BULK_COLUMN_MAP]
)
