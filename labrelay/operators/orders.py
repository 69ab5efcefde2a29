"""Lab order (OML^O21) projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fields import value
from ..functions.header import first_error, hv, kind_error
from ..functions.times import parsed_time
from .shred import passthrough, seg, with_positions, with_segments

STRUCTURE = "OML_O21"

# Fixed value: every ordered test is typed "Regular" (OBR-5 is not read).
TEST_TYPE = "Regular"


def facility_with_fallback(msh):
    """MSH-4.2 (universal id), falling back to MSH-4.1 when that is empty."""
    return F.coalesce(hv(msh, 4, 2), hv(msh, 4, 1))


def project_orders(df: DataFrame) -> DataFrame:
    """Envelope'd messages -> order records + ``_error`` (NULL when the message is fine)."""
    keep = passthrough(df)
    staged = with_segments(with_positions(df))
    msh, pid, orc, obr = seg("msh"), seg("pid"), seg("orc"), seg("obr")
    # raw values first, so the typed step below reads each one as a column
    vals = staged.select(
        *keep,
        seg("bad"),
        value(orc, 2, 1).alias("lab_order_id"),
        facility_with_fallback(msh).alias("sending_facility_id"),
        hv(msh, 6, 1).alias("receiving_lab_code"),
        hv(msh, 7, 1).alias("_v_sent"),
        value(obr, 4, 1).alias("_v_code"),
        value(obr, 4, 2).alias("_v_name"),
        hv(msh, 10, 1).alias("message_id"),
        value(pid, 3, 1).alias("_v_nupn"),
        value(pid, 8, 1).alias("_v_sex"),
        kind_error(msh, STRUCTURE).alias("_v_kind_err"),
    )
    vals = vals.select("*", parsed_time(F.col("_v_sent"), lenient=False).alias("_v_time"))
    sent, sent_err = F.col("_v_time.value"), F.col("_v_time.error")
    test = F.struct(F.col("_v_code").alias("code"), F.col("_v_name").alias("name"), F.lit(TEST_TYPE).alias("type"))
    patient = F.struct(F.col("_v_nupn").alias("nupn"), F.col("_v_sex").alias("sex"))
    return vals.select(
        *keep,
        "lab_order_id",
        "sending_facility_id",
        "receiving_lab_code",
        sent.alias("sending_date_time"),
        F.array(test).alias("lab_tests_ordered"),
        "message_id",
        patient.alias("patient"),
        first_error(seg("bad"), F.col("_v_kind_err"), sent_err).alias("_error"),
    )
