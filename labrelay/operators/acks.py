"""Order acknowledgement (ACK) projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fields import value
from ..functions.header import first_error, header_fields, hv, kind_error
from ..functions.segments import first_segment, well_formed
from ..functions.times import parsed_time
from .shred import NOT_PIPE_ENCODED, TEXT, passthrough

STRUCTURE = "ACK"


def project_acks(df: DataFrame) -> DataFrame:
    """Envelope'd messages -> ack records + ``_error``.

    Facility is MSH-4.1 with no fallback; the target is the receiving
    *application* MSH-5.1; the key is MSA-2 (the acknowledged message id).
    """
    keep = passthrough(df)
    staged = df.select(
        "*",
        header_fields().alias("_s_msh"),
        first_segment("MSA").alias("_s_msa"),
        F.when(well_formed(F.col(TEXT)), F.lit(None).cast("string"))
        .otherwise(F.lit(NOT_PIPE_ENCODED))
        .alias("_s_bad"),
    )
    msh, msa = F.col("_s_msh"), F.col("_s_msa")
    vals = staged.select(
        *keep,
        "_s_bad",
        hv(msh, 4, 1).alias("sending_facility_id"),
        hv(msh, 5, 1).alias("targeted_disa_code"),
        hv(msh, 7, 1).alias("_v_sent"),
        hv(msh, 10, 1).alias("message_id"),
        value(msa, 2, 1).alias("ack_message_id"),
        value(msa, 1, 1).alias("acknowledgment_status"),
        value(msa, 3, 1).alias("acknowledgment_description"),
        kind_error(msh, STRUCTURE).alias("_v_kind_err"),
    )
    vals = vals.select("*", parsed_time(F.col("_v_sent"), lenient=False).alias("_v_time"))
    sent, sent_err = F.col("_v_time.value"), F.col("_v_time.error")
    return vals.select(
        *keep,
        "sending_facility_id",
        "targeted_disa_code",
        sent.alias("sending_date_time"),
        "message_id",
        "ack_message_id",
        "acknowledgment_status",
        "acknowledgment_description",
        first_error(F.col("_s_bad"), F.col("_v_kind_err"), sent_err).alias("_error"),
    )
