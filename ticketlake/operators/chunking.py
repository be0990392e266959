"""Ticket text and overlapping character chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values: chunk sizes and the ticket text template ------------------
CHUNK_SIZE, CHUNK_OVERLAP = 400, 80
CHUNK_SOURCE = "Delta_Gold_Layer"
TEXT_LABELS = {
    "ticket_id": "Ticket ID",
    "customer_name": "Customer",
    "issue_category": "Category",
    "ticket_subject": "Subject",
    "assigned_agent": "Agent",
    "satisfaction_score": "Satisfaction",
    "ticket_description": "Description",
}
FALLBACKS = {
    "customer_name": "Unknown",
    "issue_category": "General Inquiry",
    "ticket_subject": "General Support",
    "ticket_description": "No description provided.",
    "assigned_agent": "Unassigned",
    "satisfaction_score": "5",
}
SPELLINGS = {
    "ticket_id": ["Ticket_ID", "Ticket ID"],
    "customer_name": ["Customer_Name", "Customer Name"],
    "issue_category": ["Issue_Category", "Issue Category"],
    "ticket_subject": ["Ticket_Subject", "Ticket Subject"],
    "ticket_description": ["Ticket_Description", "Ticket Description", "description"],
    "assigned_agent": ["Assigned_Agent", "Assigned Agent"],
    "satisfaction_score": ["Satisfaction_Score", "Satisfaction score"],
}

METADATA = ["ticket_id", "customer_name", "issue_category", "assigned_agent", "satisfaction_score"]


def _first_filled(df: DataFrame, field: str) -> Column:
    """The first spelling that holds a value; null, empty text and zero do not count."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    found = []
    for name in SPELLINGS[field]:
        if name in kinds:
            value = F.col(f"`{name}`")
            empty = F.lit("") if kinds[name] == "string" else F.lit(0).cast(kinds[name])
            found.append(F.nullif(value, empty).cast("string"))
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def ticket_text(tickets: DataFrame, order: str = "Ticket_ID", row_number: str | None = None) -> DataFrame:
    """One row per ticket: ``doc_order``, the metadata fields and ``full_text``.

    ``order`` gives the document order that breaks ties. ``row_number`` names a
    column for the id of tickets without one.
    """
    number = F.col(row_number).cast("string") if row_number else F.lit("0")
    fields = {field: _first_filled(tickets, field) for field in SPELLINGS}
    fields["ticket_id"] = F.coalesce(fields["ticket_id"], F.concat(F.lit("TKT-"), number))
    for field, fallback in FALLBACKS.items():
        fields[field] = F.coalesce(fields[field], F.lit(fallback))
    position = fields["ticket_id"] if order in SPELLINGS["ticket_id"] else F.col(order)
    filled = tickets.select(
        position.alias("doc_order"), *[c.alias(name) for name, c in fields.items()]
    )
    labelled = [F.concat(F.lit(f"{label}: "), F.col(f)) for f, label in TEXT_LABELS.items()]
    return filled.select("doc_order", *METADATA, F.concat_ws(" | ", *labelled).alias("full_text"))


def chunk(
    documents: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> DataFrame:
    """Chunks of ``size`` characters that start every ``size - overlap`` characters.

    The text is cut into step-long pieces in one pass and each chunk joins its
    neighbouring pieces, so the work grows with the length of a text, where
    a ``substring`` per chunk would rescan the text from its start each time.
    Other columns of ``documents`` are copied to every chunk.
    """
    step = max(1, size - overlap)
    span = -(-size // step)
    pieces = F.regexp_extract_all("full_text", F.lit("(?s).{1,%d}" % step), F.lit(0))
    kept = [c for c in documents.columns if c != "full_text"]
    numbered = documents.select(*kept, pieces.alias("_pieces"))
    starts = numbered.select(*kept, "_pieces", F.posexplode("_pieces").alias("_n", "_piece"))
    text = F.left(F.array_join(F.slice("_pieces", F.col("_n") + 1, F.lit(span)), ""), F.lit(size))
    offset = F.col("_n") * step
    return starts.select(
        F.concat(F.lit("doc_"), F.col("ticket_id"), F.lit("_chunk_"), offset).alias("id"),
        *kept,
        offset.alias("chunk_offset"),
        text.alias("text"),
        F.lit(CHUNK_SOURCE).alias("source"),
    )
