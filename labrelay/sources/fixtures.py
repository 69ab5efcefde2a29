"""Table -> message renderers: stand-in input for tests and the bench.

The reference's only inputs are three constant messages. To test the parser
at scale, messages are rendered from the driver's relational tables; each
renderer only *writes* message text in the raw-message schema (``topic,
partition, offset, value``) and does none of the parsing work. Expected
values are computed independently from the relational columns (DuckDB
oracles in ``__spark_entry__.py``), never from the text.

Mapping (k = key of the source row). Encoding characters ``^~\\&`` unless
stated; segments end with CR unless stated.

orders x customer -> order messages, topic ``lab-orders``, offset = o_orderkey
  MSH-4   ``NS{nation}`` (k%5=0), ``NS{nation}^^URI`` (k%5=1), else ``NS{nation}^F{nation}^URI``
  MSH-6   ``LAB{custkey%10}^L^ISO``;  MSH-7 order date (14 chars), empty if k%17=0
  MSH-9   ``OML^O21`` (k%3=0) else ``OML^O21^OML_O21``;  MSH-10 ``M{k}``;  MSH-12 version
  PID     absent if k%23=0; PID-3 ``N-{custkey}^^^^MR`` (+ 2nd repetition if k%7=0);
          PID-8 empty if custkey%9=0, else M/F by custkey%2
  ORC-2   ``O{k div 4}`` (four orders share an id), empty if k%11=0
  OBR-4   absent if k%19=0; ``{status}^{priority}[0xFF if k%29=0][\\F\\{status} if k%3=0]^L``
  then a decoy OBX, a second OBR and an SPM; segments end with CRLF (k%4=0)
  or CR plus two blanks (k%8=1); an extra CR at the end if k%6=0

lineitem grouped by l_orderkey -> result messages, topic ``lab-results``
  MSH-4   ``Lab{k%3}`` (k%6=0) else ``Lab{k%3}^L{k%3}^URI``;  MSH-6 ``{1000 + k%50}``
  MSH-7   first ship date + k%24 h + k%60 min + k%59 s, cut to 14/12/10/8 chars by k%4; empty if k%13=0
  MSH-9   ``ORU^R01`` (k%5=0) else ``ORU^R01^ORU_R01``;  MSH-10 ``R{k}``;  PID-3 ``P-{k}^^^^MR``
  ORC-2   ``O{k div 3}^SYS`` (three results share an order id); the ORC follows the OBR if k%11=0
  OBR-4   ``T{k%7}^Test {k%7}^LN``
  OBX     one per line, ordered by (linenumber, partkey, suppkey, extendedprice):
          OBX-5 empty if returnflag='N', ``~{qty}`` if ln%7=0, ``{qty}^u^^`` if ln%5=0,
          ``{qty}\\S\\x`` if ln%3=0, else ``{qty}``; OBX-6 ``copies/mL^x`` (empty if ln%4=0);
          OBX-7 ``0-{ln}``; OBX-14 ship date + ln h + qty min + partkey%60 s cut to
          8/10/12/14 chars by ln%4 (empty if partkey%10=0); an NTE after even lines
  then an SPM and an OBX that belongs to the specimen

events -> ack messages, topic ``lab-orders-ack``, offset = event_id
  value NULL (e%31=0), empty (e%37=0) or blank (e%41=0)
  MSH-4   ``LAB{user%5}^U`` (``^U`` if e%9=0);  MSH-5 ``APP{e%4}^X``;  MSH-7 ts (14 chars)
  MSH-9   ``ACK^O21`` (e%7=0), ``ACK`` (e%7=1), else ``ACK^O21^ACK``;  MSH-10 ``A{e}``
  MSA-1   AA (purchase, signup), AE (click), AR (others);  MSA-2 ``M{user}``, empty for errors
  MSA-3   empty if e%3=0, ``{type}\\S\\{e%10}`` if e%8=0, else the event type
  field/component separators ``#`` / ``$`` instead of ``|`` / ``^`` if e%10=0;
  CRLF between the segments if e%4=0; a trailing field separator if e%2=0
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.plan import spread, unfused

ORDER_TOPIC = "lab-orders"
ACK_TOPIC = "lab-orders-ack"
RESULT_TOPIC = "lab-results"

def hl7_ts(ts) -> Column:
    """TIMESTAMP_NTZ -> ``yyyyMMddHHmmss`` without any time-zone round trip
    (``date_format`` would pass through the session zone and move wall-clock
    times that fall into a daylight-saving gap)."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.translate(F.substr(col.cast("string"), F.lit(1), F.lit(19)), "- :", "")


def _s(c) -> Column:
    """Column or literal -> string column (NULL -> '')."""
    col = c if isinstance(c, Column) else F.lit(c)
    return F.coalesce(col.cast("string"), F.lit(""))


def _cat(*parts) -> Column:
    return F.concat(*(_s(p) for p in parts))


def _join(sep: Column, segments: list[Column]) -> Column:
    out = segments[0]
    for s in segments[1:]:
        out = F.concat(out, sep, s)
    return out


def _raw(topic: str, offset: Column, value: Column) -> list[Column]:
    """Kafka-shaped columns; the value is fenced so that filters of the parser
    read the rendered message instead of re-rendering it, and not fused with the parse."""
    return [
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        offset.cast("long").alias("offset"),
        unfused(value).alias("value"),
    ]


def render_orders(orders: DataFrame, customer: DataFrame, version: Column | None = None) -> DataFrame:
    """One order message per order (J1)."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    c = customer.select(F.col("c_custkey"), F.col("c_nationkey"))
    # spread by the order behind the join: its tasks may be few, or uneven by customer
    j = spread(o.join(c, o.o_custkey == c.c_custkey), "o_orderkey", "o_custkey")
    k, ck, n = F.col("o_orderkey"), F.col("c_custkey"), F.col("c_nationkey")
    ver = version if version is not None else F.lit("2.5")
    fac = (
        F.when(k % 5 == 0, _cat("NS", n))
        .when(k % 5 == 1, _cat("NS", n, "^^URI"))
        .otherwise(_cat("NS", n, "^F", n, "^URI"))
    )
    ts = F.when(k % 17 == 0, F.lit("")).otherwise(hl7_ts("o_orderdate"))
    kind = F.when(k % 3 == 0, F.lit("OML^O21")).otherwise(F.lit("OML^O21^OML_O21"))
    msh = _cat("MSH|^~\\&|ClinicApp|", fac, "|LabApp|LAB", ck % 10, "^L^ISO|", ts, "||", kind, "|M", k, "|P|", ver)
    rep2 = F.when(k % 7 == 0, _cat("~X-", k, "^^^^AN")).otherwise(F.lit(""))
    sex = F.when(ck % 9 == 0, F.lit("")).when(ck % 2 == 0, F.lit("M")).otherwise(F.lit("F"))
    pid = _cat("PID|1||N-", ck, "^^^^MR", rep2, "||Doe^Sam||19700101|", sex)
    oid = F.expr("o_orderkey div 4")
    orc = _cat("ORC|NW|", F.when(k % 11 == 0, F.lit("")).otherwise(_cat("O", oid)))
    sep = F.when(k % 4 == 0, F.lit("\r\n")).when(k % 8 == 1, F.lit("\r  ")).otherwise(F.lit("\r"))
    # an absent PID (NULL) vanishes together with its separator
    head = _join_present(sep, [msh, F.when(k % 23 != 0, pid), orc])
    name_pre = _cat(F.col("o_orderpriority"))
    name_post = F.when(k % 3 == 0, _cat("\\F\\", F.col("o_orderstatus"))).otherwise(F.lit(""))
    obr_pre = _cat("OBR|1|O", oid, "||", F.col("o_orderstatus"), "^", name_pre)
    obr_post = _cat(name_post, "^L|Urgent")
    tail = _join(
        sep,
        [
            F.lit(""),
            F.lit("OBX|1|ST|VISIT^Visit||3M||||||F"),
            _cat("OBR|2|O", oid, "||DECOY^Decoy^L|Urgent"),
            F.lit("SPM|1|||B^Blood"),
        ],
    )
    tail = F.concat(tail, F.when(k % 6 == 0, F.lit("\r")).otherwise(F.lit("")))
    bad = F.when(k % 29 == 0, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    enc = lambda s: F.encode(s, "UTF-8")
    with_obr = F.concat(enc(F.concat(head, sep, obr_pre)), bad, enc(F.concat(obr_post, tail)))
    without_obr = enc(F.concat(head, tail))
    value = F.when(k % 19 == 0, without_obr).otherwise(with_obr)
    return j.select(*_raw(ORDER_TOPIC, k, value))


def _join_present(sep: Column, segments: list[Column]) -> Column:
    """Join segments with ``sep``, skipping NULL ones (absent segments)."""
    out = segments[0]
    for s in segments[1:]:
        out = F.concat(out, F.coalesce(F.concat(sep, s), F.lit("")))
    return out


def render_acks(
    events: DataFrame, version: Column | None = None, sent_length: Column | None = None, text: Column | None = None
) -> DataFrame:
    """One acknowledgement per event (J2), including null, empty and blank values.
    ``text`` replaces MSA-3 (raw, with escapes)."""
    e, u, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    ver = version if version is not None else F.lit("2.5")
    fac = F.when(e % 9 == 0, F.lit("^U")).otherwise(_cat("LAB", u % 5, "^U"))
    ts = hl7_ts("ts")
    if sent_length is not None:
        ts = F.substr(ts, F.lit(1), sent_length)
    kind = (
        F.when(e % 7 == 0, F.lit("ACK^O21")).when(e % 7 == 1, F.lit("ACK")).otherwise(F.lit("ACK^O21^ACK"))
    )
    msh = _cat("MSH|^~\\&|LabApp|", fac, "|APP", e % 4, "^X|10010001|", ts, "||", kind, "|A", e, "|P|", ver)
    code = F.when(et.isin("purchase", "signup"), F.lit("AA")).when(et == "click", F.lit("AE")).otherwise(F.lit("AR"))
    ctl = F.when(et == "error", F.lit("")).otherwise(_cat("M", u))
    if text is None:
        text = F.when(e % 3 == 0, F.lit("")).when(e % 8 == 0, _cat(et, "\\S\\", e % 10)).otherwise(_cat(et))
    msa = _cat("MSA|", code, "|", ctl, "|", text, F.when(e % 2 == 0, F.lit("|")).otherwise(F.lit("")))
    sep = F.when(e % 4 == 0, F.lit("\r\n")).otherwise(F.lit("\r"))
    msg = F.concat(msh, sep, msa)
    msg = F.when(e % 10 == 0, F.translate(msg, "|^", "#$")).otherwise(msg)
    value = (
        F.when(e % 31 == 0, F.lit(None).cast("binary"))
        .when(e % 37 == 0, F.unhex(F.lit("")))
        .when(e % 41 == 0, F.encode(F.lit("\r\n \t"), "UTF-8"))
        .otherwise(F.encode(msg, "UTF-8"))
    )
    return events.select(*_raw(ACK_TOPIC, e, value))


def _cut_time(ts: Column, length: Column) -> Column:
    return F.substr(hl7_ts(ts), F.lit(1), length)


def render_results(
    lineitem: DataFrame,
    version: Column | None = None,
    sent_text: Callable[[Column], Column] | None = None,
    obs_text: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One result message per order of ``lineitem`` (J3), one OBX per line.
    ``sent_text`` and ``obs_text`` make the text of MSH-7 and of every OBX-14 from
    the 14-character time (columns ``k`` and those of ``lineitem`` may be used).

    The per-order aggregation holds one order's lines (the message is one
    row by definition); lines are pre-rendered map-side so the shuffle moves
    segment text, and the order of observations is fixed by sorting the
    collected (linenumber, partkey, suppkey, extendedprice) keys.
    """
    ln, q, pk = F.col("l_linenumber"), F.col("l_quantity").cast("long"), F.col("l_partkey")
    val = (
        F.when(F.col("l_returnflag") == "N", F.lit(""))
        .when(ln % 7 == 0, _cat("~", q))
        .when(ln % 5 == 0, _cat(q, "^u^^"))
        .when(ln % 3 == 0, _cat(q, "\\S\\x"))
        .otherwise(_cat(q))
    )
    unit = F.when(ln % 4 == 0, F.lit("")).otherwise(F.lit("copies/mL^x"))
    obs_ts = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), ln, q.cast("int"), (pk % 60).cast("int"))
    obs_len = F.when(ln % 4 == 0, 8).when(ln % 4 == 1, 10).when(ln % 4 == 2, 12).otherwise(14)
    t = F.when(pk % 10 == 0, F.lit("")).otherwise(_cut_time(obs_ts, obs_len))
    if obs_text is not None:
        t = obs_text(hl7_ts(obs_ts))
    obx = _cat("OBX|", ln, "|NM|c^decoy||", val, "|", unit, "|0-", ln, "||||F|||", t)
    seg = F.when(ln % 2 == 0, F.concat(obx, F.lit("\rNTE|1|L|note "), _s(ln))).otherwise(obx)
    lines = lineitem.select(
        F.col("l_orderkey").alias("k"),
        F.col("l_shipdate"),
        F.struct(ln.alias("ln"), pk.alias("pk"), F.col("l_suppkey").alias("sk"),
                 F.col("l_extendedprice").alias("price"), seg.alias("seg")).alias("line"),
    )
    per_order = lines.groupBy("k").agg(
        F.min("l_shipdate").alias("first_ship"),
        F.sort_array(F.collect_list("line")).alias("lines"),
    )
    k = F.col("k")
    ver = version if version is not None else F.lit("2.5")
    fac = F.when(k % 6 == 0, _cat("Lab", k % 3)).otherwise(_cat("Lab", k % 3, "^L", k % 3, "^URI"))
    sent_ts = F.col("first_ship") + F.make_dt_interval(F.lit(0), (k % 24).cast("int"), (k % 60).cast("int"), (k % 59).cast("int"))
    sent_len = F.when(k % 4 == 0, 14).when(k % 4 == 1, 12).when(k % 4 == 2, 10).otherwise(8)
    ts = F.when(k % 13 == 0, F.lit("")).otherwise(_cut_time(sent_ts, sent_len))
    if sent_text is not None:
        ts = sent_text(hl7_ts(sent_ts))
    kind = F.when(k % 5 == 0, F.lit("ORU^R01")).otherwise(F.lit("ORU^R01^ORU_R01"))
    msh = _cat("MSH|^~\\&|LabApp|", fac, "|ClinicApp|", k % 50 + 1000, "|", ts, "||", kind, "|R", k, "|P|", ver)
    pid = _cat("PID|1||P-", k, "^^^^MR")
    oid = F.expr("k div 3")
    orc = _cat("ORC|SC|O", oid, "^SYS")
    obr = _cat("OBR|1|O", oid, "||T", k % 7, "^Test ", k % 7, "^LN")
    group = F.when(k % 11 == 0, F.concat(obr, F.lit("\r"), orc)).otherwise(F.concat(orc, F.lit("\r"), obr))
    obxs = F.array_join(F.transform("lines", lambda x: x["seg"]), "\r")
    msg = F.concat_ws("\r", msh, pid, group, obxs, F.lit("SPM|1"), F.lit("OBX|99|ST|x^y||after-spm||||||F"))
    return per_order.select(*_raw(RESULT_TOPIC, k, F.encode(msg, "UTF-8")))


def mixed_messages(orders: DataFrame, customer: DataFrame, lineitem: DataFrame, events: DataFrame) -> DataFrame:
    """All three kinds in one table; messages with k%10=9 claim version 2.3."""
    legacy = lambda key: F.when(F.col(key) % 10 == 9, F.lit("2.3")).otherwise(F.lit("2.5"))
    return (
        render_orders(orders, customer, legacy("o_orderkey"))
        .unionByName(render_acks(events, legacy("event_id")))
        .unionByName(render_results(lineitem, legacy("k")))
    )
