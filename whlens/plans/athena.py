"""Athena export: execution records flattened to one row each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from whlens.functions.normalize import iso_text_columns
from whlens.operators.nested import flatten_struct
from whlens.operators.windows import range_or_skip, take_until
from whlens.sources.json_pages import utc_times

SUBMISSION = "Status.SubmissionDateTime"


def query_logs(executions: DataFrame, start=None, end=None, listing_pos: str | None = None) -> DataFrame:
    """Export ``athena_query_logs``.

    Times are UTC first (text with offsets too). Records with a submission time in
    the closed window, if one is given (F14; records without a time are skipped). With ``listing_pos`` the source's listing-order
    early stop is applied as well (F15). Then flattened with ``.`` names (P6)
    and timestamps written as ISO text, null as '' (N5)."""
    flat = flatten_struct(utc_times(executions))
    if start is None:
        kept = flat.where(F.col(f"`{SUBMISSION}`").isNotNull())
    elif listing_pos is not None:
        kept = take_until(flat, listing_pos, f"`{SUBMISSION}`", start, end)
    else:
        kept = range_or_skip(flat, f"`{SUBMISSION}`", start, end)
    return iso_text_columns(kept)
