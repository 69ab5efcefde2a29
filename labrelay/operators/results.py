"""Lab result (ORU^R01) projection.

Only the first order/observation group is read: its ORC gives the order id,
its OBR the test code and name, and every OBX of that group (and only of that
group) gives one result, in message order. The group ends at the next
segment that opens another group or a part the observations cannot follow.

The observations of a message are read by one regular expression a field and cast
in one step, without a lambda; only messages with an escape in those fields or a time
that is not plain go through ``observation_values`` one observation at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import encoded_value, field_value, split_fields, value
from ..functions.header import first_error, hv, kind_error
from ..functions.plan import unfused
from ..functions.segments import CR, ENV, ENV_COLS, all_segments, cut_at_boundary, quote_re, slice_from
from ..functions.times import parsed_time, time_error, time_parts, time_value
from .orders import facility_with_fallback
from .shred import group_flags, passthrough, seg, with_positions, with_segments

STRUCTURE = "ORU_R01"

# Segments after which an OBX no longer belongs to the first
# group's observation list (new order group, new patient, specimen, trailer).
GROUP_END = ("ORC", "OBR", "PID", "PD1", "NK1", "PV1", "PV2", "FT1", "CTI", "SPM", "DSC")


def observation_group() -> Column:
    """Canonical text of the first order/observation group, from its OBR (or ORC)."""
    orc_ok, obr_ok, _ = group_flags()
    start = F.when(obr_ok, F.col("_p_obr")).when(orc_ok, F.col("_p_orc")).otherwise(F.lit(0))
    return F.when(start > 0, cut_at_boundary(slice_from(start), GROUP_END))


def _all_of_field(group: Column, n: int, part: Column) -> Column:
    """What the pattern ``part`` matches at the start of field ``n`` of every OBX whose OBX-5
    is not empty, in order ('' if the field is absent): one regular expression, no lambda."""
    fs, rest = quote_re(ENV.fs), F.concat(F.lit("[^"), quote_re(ENV.fs), F.lit(CR + "]*+"))
    skipped = lambda k: F.concat(F.lit("(?:"), fs, rest, F.lit(f"){{{k}}}"))
    start = F.concat(F.lit(CR + "OBX"), skipped(4), fs, F.lit("(?=[^"), fs, F.lit(CR + "])"))
    if n == 5:
        pattern = F.concat(start, F.lit("("), part, F.lit(")"))
    else:
        pattern = F.concat(start, rest, F.lit("(?:"), skipped(n - 6), fs, F.lit("("), part, F.lit("))?"))
    return F.regexp_extract_all(F.concat(F.lit(CR), group), pattern, F.lit(1))


def observation_arrays(group: Column) -> list[Column]:
    """The texts of OBX-5 (first repetition, re-encoded as by ``encoded_value``) and of
    OBX-6, 7 and 14 (first repetition, component and subcomponent, escapes kept, '' if empty
    or absent) of the first observation group, as parallel arrays."""
    until = lambda *seps: F.concat(F.lit("[^"), *(quote_re(s) for s in (ENV.fs, *seps)), F.lit(CR + "]"))
    trailing = F.when(ENV.cs != "", F.concat(F.lit("[\\Q"), ENV.cs, ENV.ss, F.lit("\\E]*+"))).otherwise(F.lit(""))
    ended = F.concat(F.lit("(?=["), quote_re(ENV.fs), quote_re(ENV.rs), F.lit(CR + "]|$)"))
    encoded = F.concat(until(ENV.rs), F.lit("*?(?="), trailing, ended, F.lit(")"))
    scalar = F.concat(until(ENV.rs, ENV.cs, ENV.ss), F.lit("*+"))
    return [_all_of_field(group, 5, encoded), *(_all_of_field(group, n, scalar) for n in (6, 7, 14))]


def plain_times(texts: Column) -> Column:
    """Array of date-time texts -> array<timestamp_ntz> by one cast: padded to 14 digits and
    written as ISO text first, all at once. NULL for what needs ``time_value``: malformed
    times, days past a month's end, 24:00; and for ''."""
    one = lambda digits: F.lit(rf"(?<![^\r]){digits}(?![^\r])")
    joined = F.array_join(texts, CR)
    for n in (8, 10, 12):
        joined = F.regexp_replace(joined, one(rf"([0-9]{{{n}}})"), F.lit("$1" + "0" * (14 - n)))
    iso = F.regexp_replace(joined, one("([0-9]{4})" + "([0-9]{2})" * 5), F.lit("$1-$2-$3 $4:$5:$6"))
    # a text that was no such digits must not become a time by some other rule of the cast
    only = F.regexp_replace(iso, F.lit(r"(?<![^\r])(?![0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(?![^\r]))[^\r]++"), F.lit("-"))
    return F.split(only, CR).try_cast("array<timestamp_ntz>")


def observation_values(obx: Column) -> Column:
    """OBX segments with a value -> array<struct(value, unit, referenceRange, time text)>.

    Each OBX is split into its fields once; an OBX counts when OBX-5 holds at
    least one repetition (any raw text).
    """
    fields = F.transform(obx, lambda x: split_fields(x))

    def one(f: Column) -> Column:
        return F.struct(
            encoded_value(F.get(f, 5)).alias("value"),
            field_value(F.get(f, 6)).alias("unit"),
            field_value(F.get(f, 7)).alias("referenceRange"),
            field_value(F.get(f, 14)).alias("time"),
        )

    return F.transform(F.filter(fields, lambda f: F.length(F.get(f, 5)) > 0), one)


def observations(vals: Column) -> Column:
    """Add the parsed observation time and its error to each observation.

    Two passes: the time's parts are computed once per observation, then the
    value and the error read only those parts.
    """
    with_parts = F.transform(
        vals,
        lambda o: F.struct(
            o["value"].alias("value"),
            o["unit"].alias("unit"),
            o["referenceRange"].alias("referenceRange"),
            o["time"].alias("time"),
            time_parts(o["time"], lenient=True).alias("tp"),
        ),
    )
    return F.transform(
        with_parts,
        lambda o: F.struct(
            o["value"].alias("value"),
            o["unit"].alias("unit"),
            o["referenceRange"].alias("referenceRange"),
            time_value(o["tp"]).alias("observationDateTime"),
            time_error(o["tp"], o["time"]).alias("err"),
        ),
    )


#: The texts of ``observation_arrays`` by name, and the envelope's columns that they need.
_ARRAYS = ("_v_value", "_v_unit", "_v_reference", "_v_at")
_DELIMITERS = [c for c in ENV_COLS if c != "_body"]


def with_observation_group(df: DataFrame) -> DataFrame:
    """Envelope'd messages + segment columns + ``_s_obx``: the OBX segments of group 1."""
    return with_segments(with_positions(df), {"_s_obx": all_segments(observation_group(), "OBX")})


def project_results(df: DataFrame) -> DataFrame:
    """Envelope'd messages -> result records + ``_error``."""
    keep = passthrough(df)
    staged = with_segments(with_positions(df))
    msh, pid, orc, obr = seg("msh"), seg("pid"), seg("orc"), seg("obr")
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
        value(pid, 3, 1).alias("patient_nupn"),
        kind_error(msh, STRUCTURE).alias("_v_kind_err"),
        *_DELIMITERS,
        observation_group().alias("_v_group"),
    )
    texts = vals.select("*", *(unfused(a).alias(n) for a, n in zip(observation_arrays(F.col("_v_group")), _ARRAYS)))
    value_, unit, reference, time = (F.col(n) for n in _ARRAYS)
    timed = texts.select("*", plain_times(time).alias("_v_times"), parsed_time(F.col("_v_sent"), lenient=True).alias("_v_time"))
    # Escapes in these fields, and times that a cast doesn't give, need a look at each observation.
    escaped = ENV.esc & F.contains(F.array_join(F.concat(unit, reference, time), CR), ENV.es)
    odd = escaped | (F.size(F.array_compact("_v_times")) != F.size(F.array_remove(time, "")))
    looked = timed.select(
        "*", F.when(odd, observations(observation_values(all_segments(F.col("_v_group"), "OBX")))).alias("_s_obs"))
    obs = seg("obs")
    sent, sent_err = F.col("_v_time.value"), F.col("_v_time.error")

    def result(value, unit, reference, at):
        return F.struct(
            F.col("_v_code").alias("code"),
            F.col("_v_name").alias("name"),
            value.alias("value"),
            unit.alias("unit"),
            reference.alias("referenceRange"),
            at.alias("observationDateTime"),
        )

    plain = F.transform(
        F.arrays_zip(*_ARRAYS[:3], "_v_times"),
        lambda o: result(o[_ARRAYS[0]], F.nullif(o[_ARRAYS[1]], F.lit("")), F.nullif(o[_ARRAYS[2]], F.lit("")), o["_v_times"]),
    )
    one_by_one = F.transform(obs, lambda o: result(o["value"], o["unit"], o["referenceRange"], o["observationDateTime"]))
    results = F.when(obs.isNotNull(), one_by_one).when(F.col("_v_group").isNotNull(), F.slice(plain, F.lit(1), F.size(value_)))
    obs_err = F.get(F.filter(obs, lambda o: o["err"].isNotNull()), 0)["err"]
    return looked.select(
        *keep,
        "lab_order_id",
        "sending_facility_id",
        "receiving_lab_code",
        sent.alias("sending_date_time"),
        results.alias("lab_test_results"),
        "message_id",
        "patient_nupn",
        first_error(seg("bad"), F.col("_v_kind_err"), sent_err, obs_err).alias("_error"),
    )
