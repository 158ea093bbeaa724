"""Service agreements for a table of clients: request payloads and merged text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions import dates as D
from postmill.functions import text as X

# ---- fixed values: defaults, settings and the agreement text ----
DEFAULTS = {
    "company_name": "Your Company Name",
    "service_plan": "Standard Plan",
    "pricing": "$999/month",
    "client_name": "Valued Client",
}
EXPIRATION_HOURS = 168
SETTINGS = {
    "allow_download": True,
    "attach_pdf_on_finish": True,
    "allow_editing_before_sending": False,
    "send_signing_email": True,
    "send_finish_email": True,
    "send_expiration_email": True,
    "send_cancellation_email": True,
}
FIELDS = [
    "client_name",
    "client_address",
    "sign_date",
    "client_signature",
    "agreement_id",
    "company_name",
    "service_plan",
    "pricing",
    "start_date",
    "end_date",
]
AGREEMENT_TEXT = """CLIENT SERVICE AGREEMENT
This agreement is made between:
Company: {{company_name}}
Client: {{client_name}}
Client Information:
Name: {{client_name}}
Address: {{client_address}}
Date: {{sign_date}}
Service Details:
Agreement ID: {{agreement_id}}
Service Plan: {{service_plan}}
Pricing: {{pricing}}
Service Period: {{start_date}} to {{end_date}}
Client Signature: {{client_signature}}
By signing below, the Client agrees to the terms
outlined in this agreement."""


def with_agreement_fields(clients: DataFrame, run_at: Column) -> DataFrame:
    """Fill defaults, agreement id and end date; rows without a usable e-mail are dropped.

    ``requested_at`` (per row) takes the place of the run time where it exists.
    """
    have = set(clients.columns)

    def given(name: str) -> Column:
        return X.blank_to_null(F.trim(F.col(name))) if name in have else F.lit(None).cast("string")

    at = F.coalesce("requested_at", run_at) if "requested_at" in have else run_at
    today = F.date_format(at, "yyyy-MM-dd")
    rows = clients.withColumns({n: F.coalesce(given(n), F.lit(v)) for n, v in DEFAULTS.items()})
    rows = rows.withColumns(
        {
            "start_date": F.coalesce(given("start_date"), today),
            "agreement_id": F.coalesce(
                given("agreement_id"), F.concat(F.lit("AGR-"), F.date_format(at, "yyyyMMddHHmmss"))
            ),
        }
    )
    start = F.to_date(F.try_to_timestamp(F.col("start_date"), F.lit("yyyy-MM-dd")))
    end = D.one_year_later(F.coalesce(start, F.to_date(at)))
    rows = rows.withColumn("end_date", F.coalesce(given("end_date"), F.date_format(end, "yyyy-MM-dd")))
    return rows.filter(F.col("client_email").contains("@"))


def signing_requests(rows: DataFrame, template_id: str) -> DataFrame:
    """Rows with the ``request`` struct and its JSON text."""
    recipient = F.struct(
        F.lit("temp_1").alias("id"),
        X.first_name("client_name").alias("first_name"),
        X.last_name("client_name").alias("last_name"),
        F.col("client_email").alias("email"),
        F.lit("signer").alias("role"),
    )
    request = F.struct(
        F.concat(F.lit("Service Agreement - "), "client_name").alias("name"),
        F.concat(
            F.lit("Service agreement for "), "client_name", F.lit(" with agreement ID: "), "agreement_id"
        ).alias("description"),
        F.lit(template_id).alias("template_id"),
        F.lit(EXPIRATION_HOURS).alias("expiration_hours"),
        F.array(recipient).alias("recipients"),
        F.struct(*[F.lit(v).alias(k) for k, v in SETTINGS.items()]).alias("settings"),
    )
    out = rows.withColumn("request", request)
    return out.withColumn("request_json", F.to_json("request"))


def merge_text(rows: DataFrame, template: str = AGREEMENT_TEXT) -> DataFrame:
    """Fill the ``{{field}}`` marks; a field without a value keeps its mark."""
    text = F.lit(template)
    for name in FIELDS:
        if name in rows.columns:
            mark = F.lit("{{" + name + "}}")
            text = F.replace(text, mark, F.coalesce(F.col(name), mark))
    return rows.withColumn("agreement_text", text)
