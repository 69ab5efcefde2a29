"""DuckDB oracles for the registered queries (same keys as ``plans.catalog``).

Every expected value is computed from the relational columns of the driver's
tables with the mapping documented in ``sources.fixtures`` - never from
message text - so a renderer bug and a parser bug cannot hide each other.
Tables are the driver's pre-registered views.
"""

from __future__ import annotations

ISO = "'%Y-%m-%dT%H:%M:%S'"

# expected order records, one row per order
EX_O = f"""
ex_o AS (
  SELECT o.o_orderkey AS k,
    CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE 'O' || CAST(o.o_orderkey // 4 AS VARCHAR) END AS lab_order_id,
    CASE WHEN o.o_orderkey % 5 IN (0, 1) THEN 'NS' || CAST(c.c_nationkey AS VARCHAR)
         ELSE 'F' || CAST(c.c_nationkey AS VARCHAR) END AS sending_facility_id,
    'NS' || CAST(c.c_nationkey AS VARCHAR) AS msh_4_1,
    CASE WHEN o.o_orderkey % 5 IN (0, 1) THEN NULL ELSE 'F' || CAST(c.c_nationkey AS VARCHAR) END AS msh_4_2,
    'LAB' || CAST(c.c_custkey % 10 AS VARCHAR) AS receiving_lab_code,
    CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE strftime(o.o_orderdate, {ISO}) END AS sending_date_time,
    CASE WHEN o.o_orderkey % 19 = 0 THEN NULL ELSE o.o_orderstatus END AS test_code,
    CASE WHEN o.o_orderkey % 19 = 0 THEN NULL
         ELSE o.o_orderpriority
              || CASE WHEN o.o_orderkey % 29 = 0 THEN chr(65533) ELSE '' END
              || CASE WHEN o.o_orderkey % 3 = 0 THEN '|' || o.o_orderstatus ELSE '' END END AS test_name,
    'M' || CAST(o.o_orderkey AS VARCHAR) AS message_id,
    CASE WHEN o.o_orderkey % 23 = 0 THEN NULL ELSE 'N-' || CAST(o.o_custkey AS VARCHAR) END AS patient_nupn,
    CASE WHEN o.o_orderkey % 23 = 0 OR c.c_custkey % 9 = 0 THEN NULL
         WHEN c.c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS patient_sex,
    CASE WHEN o.o_orderkey % 23 = 0 THEN NULL ELSE 'MR' END AS pid_3_5,
    CASE WHEN o.o_orderkey % 29 = 0 AND o.o_orderkey % 19 <> 0 THEN 1 ELSE 0 END AS replacement_chars,
    7 - CASE WHEN o.o_orderkey % 23 = 0 THEN 1 ELSE 0 END
      - CASE WHEN o.o_orderkey % 19 = 0 THEN 1 ELSE 0 END AS n_segments
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""

# expected ack records, one row per event (present = value neither null, empty nor blank)
EX_A = f"""
ex_a AS (
  SELECT event_id AS e,
    (event_id % 31 <> 0) AS not_null,
    (event_id % 31 <> 0 AND event_id % 37 <> 0) AS not_empty,
    (event_id % 31 <> 0 AND event_id % 37 <> 0 AND event_id % 41 <> 0) AS present,
    CASE WHEN event_id % 10 = 0 THEN '#' ELSE '|' END AS field_separator,
    CASE WHEN event_id % 10 = 0 THEN '$' ELSE '^' END AS component_separator,
    CASE WHEN event_id % 9 = 0 THEN NULL ELSE 'LAB' || CAST(user_id % 5 AS VARCHAR) END AS sending_facility_id,
    'APP' || CAST(event_id % 4 AS VARCHAR) AS targeted_disa_code,
    strftime(ts, {ISO}) AS sending_date_time,
    strftime(ts, '%Y%m%d%H%M') AS sent_12,
    'A' || CAST(event_id AS VARCHAR) AS message_id,
    CASE WHEN event_type = 'error' THEN NULL ELSE 'M' || CAST(user_id AS VARCHAR) END AS ack_message_id,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'AA' WHEN event_type = 'click' THEN 'AE'
         ELSE 'AR' END AS acknowledgment_status,
    CASE WHEN event_id % 3 = 0 THEN NULL
         WHEN event_id % 8 = 0 THEN event_type || CASE WHEN event_id % 10 = 0 THEN '$' ELSE '^' END
                                   || CAST(event_id % 10 AS VARCHAR)
         ELSE event_type END AS acknowledgment_description
  FROM events
)"""

# expected observations, one row per line item
EX_L = f"""
ex_l AS (
  SELECT l_orderkey AS k, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk, l_extendedprice AS price,
    l_returnflag <> 'N' AS has_value,
    CASE WHEN l_linenumber % 7 = 0 THEN ''
         WHEN l_linenumber % 5 = 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '^u'
         WHEN l_linenumber % 3 = 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '\\S\\x'
         ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS value,
    CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE 'copies/mL' END AS unit,
    '0-' || CAST(l_linenumber AS VARCHAR) AS reference_range,
    CASE WHEN l_partkey % 10 = 0 THEN NULL
         ELSE strftime(CASE l_linenumber % 4
                         WHEN 0 THEN date_trunc('day', obs)
                         WHEN 1 THEN date_trunc('hour', obs)
                         WHEN 2 THEN date_trunc('minute', obs)
                         ELSE obs END, {ISO}) END AS observation_time
  FROM (SELECT *, l_shipdate + to_hours(l_linenumber) + to_minutes(CAST(l_quantity AS BIGINT))
                  + to_seconds(l_partkey % 60) AS obs FROM lineitem)
)"""

# expected result records, one row per order of lineitem
EX_R = f"""
ex_r AS (
  SELECT k,
    CASE WHEN k % 11 = 0 THEN NULL ELSE 'O' || CAST(k // 3 AS VARCHAR) END AS lab_order_id,
    CASE WHEN k % 6 = 0 THEN 'Lab' || CAST(k % 3 AS VARCHAR) ELSE 'L' || CAST(k % 3 AS VARCHAR) END
      AS sending_facility_id,
    CAST(1000 + k % 50 AS VARCHAR) AS receiving_lab_code,
    CASE WHEN k % 13 = 0 THEN NULL
         ELSE strftime(CASE k % 4
                         WHEN 0 THEN sent
                         WHEN 1 THEN date_trunc('minute', sent)
                         WHEN 2 THEN date_trunc('hour', sent)
                         ELSE date_trunc('day', sent) END, {ISO}) END AS sending_date_time,
    'T' || CAST(k % 7 AS VARCHAR) AS test_code,
    'Test ' || CAST(k % 7 AS VARCHAR) AS test_name,
    'R' || CAST(k AS VARCHAR) AS message_id,
    'P-' || CAST(k AS VARCHAR) AS patient_nupn,
    n_lines, n_even
  FROM (SELECT l_orderkey AS k,
               min(l_shipdate) + to_hours(l_orderkey % 24) + to_minutes(l_orderkey % 60)
                 + to_seconds(l_orderkey % 59) AS sent,
               count(*) AS n_lines,
               count(*) FILTER (WHERE l_linenumber % 2 = 0) AS n_even
        FROM lineitem GROUP BY l_orderkey)
)"""

# expected observation list per order (orders whose ORC is in group 1 only)
EX_OBS = """
ex_obs AS (
  SELECT r.k,
    list(struct_pack(code := r.test_code, name := r.test_name, value := l.value, unit := l.unit,
                     referenceRange := l.reference_range, observationDateTime := l.observation_time)
         ORDER BY l.ln, l.pk, l.sk, l.price) FILTER (WHERE l.has_value) AS arr
  FROM ex_r r JOIN ex_l l ON l.k = r.k
  WHERE r.k % 11 <> 0
  GROUP BY r.k
)"""

# observations numbered in message order (0-based like posexplode)
EX_POS = """
ex_pos AS (
  SELECT l.*, r.test_code, r.test_name,
    CAST(row_number() OVER (PARTITION BY l.k ORDER BY l.ln, l.pk, l.sk, l.price) - 1 AS INTEGER) AS pos
  FROM ex_l l JOIN ex_r r ON l.k = r.k
  WHERE l.has_value AND r.k % 11 <> 0
)"""


# the text of every message, from the columns alone
TXT_O = r"""
txt_o AS (
  SELECT o_orderkey AS k, encode(pre) || bad || encode(post) AS bytes FROM (
    SELECT o_orderkey,
      CASE WHEN o_orderkey % 29 = 0 AND o_orderkey % 19 <> 0 THEN '\xFF'::BLOB ELSE ''::BLOB END AS bad,
      msh || pid || sep || orc || CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE sep || 'OBR|1|O' || oid || '||' || o_orderstatus || '^'
        || o_orderpriority END AS pre,
      CASE WHEN o_orderkey % 19 = 0 THEN ''
           ELSE CASE WHEN o_orderkey % 3 = 0 THEN '\F\' || o_orderstatus ELSE '' END || '^L|Urgent' END
        || sep || 'OBX|1|ST|VISIT^Visit||3M||||||F' || sep || 'OBR|2|O' || oid || '||DECOY^Decoy^L|Urgent' || sep || 'SPM|1|||B^Blood'
        || CASE WHEN o_orderkey % 6 = 0 THEN chr(13) ELSE '' END AS post
    FROM (
      SELECT o.*, CAST(o_orderkey // 4 AS VARCHAR) AS oid,
        CASE WHEN o_orderkey % 4 = 0 THEN chr(13) || chr(10) WHEN o_orderkey % 8 = 1 THEN chr(13) || '  ' ELSE chr(13) END AS sep,
        'MSH|^~\&|ClinicApp|' || 'NS' || c_nationkey || CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN '^^URI'
            ELSE '^F' || c_nationkey || '^URI' END || '|LabApp|LAB' || (c_custkey % 10) || '^L^ISO|'
          || CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE strftime(o_orderdate, '%Y%m%d%H%M%S') END || '||'
          || CASE WHEN o_orderkey % 3 = 0 THEN 'OML^O21' ELSE 'OML^O21^OML_O21' END || '|M' || o_orderkey || '|P|2.5' AS msh,
        CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE
          CASE WHEN o_orderkey % 4 = 0 THEN chr(13) || chr(10) WHEN o_orderkey % 8 = 1 THEN chr(13) || '  ' ELSE chr(13) END
          || 'PID|1||N-' || c_custkey || '^^^^MR' || CASE WHEN o_orderkey % 7 = 0 THEN '~X-' || o_orderkey || '^^^^AN' ELSE '' END
          || '||Doe^Sam||19700101|' || CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END END AS pid,
        'ORC|NW|' || CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'O' || CAST(o_orderkey // 4 AS VARCHAR) END AS orc
      FROM orders o JOIN customer c ON o_custkey = c_custkey))
)"""
TXT_A = r"""
txt_a AS (
  SELECT e, CASE WHEN e % 31 = 0 THEN NULL WHEN e % 37 = 0 THEN '' WHEN e % 41 = 0 THEN chr(13) || chr(10) || ' ' || chr(9)
                 WHEN e % 10 = 0 THEN translate(msg, '|^', '#$') ELSE msg END AS text
  FROM (
    SELECT event_id AS e,
      'MSH|^~\&|LabApp|' || CASE WHEN event_id % 9 = 0 THEN '^U' ELSE 'LAB' || (user_id % 5) || '^U' END || '|APP' || (event_id % 4)
        || '^X|10010001|' || strftime(ts, '%Y%m%d%H%M%S') || '||'
        || CASE event_id % 7 WHEN 0 THEN 'ACK^O21' WHEN 1 THEN 'ACK' ELSE 'ACK^O21^ACK' END || '|A' || event_id || '|P|2.5'
        || CASE WHEN event_id % 4 = 0 THEN chr(13) || chr(10) ELSE chr(13) END || 'MSA|'
        || CASE WHEN event_type IN ('purchase', 'signup') THEN 'AA' WHEN event_type = 'click' THEN 'AE' ELSE 'AR' END || '|'
        || CASE WHEN event_type = 'error' THEN '' ELSE 'M' || user_id END || '|'
        || CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 8 = 0 THEN event_type || '\S\' || (event_id % 10) ELSE event_type END
        || CASE WHEN event_id % 2 = 0 THEN '|' ELSE '' END AS msg
    FROM events)
)"""
TXT_R = r"""
txt_l AS (
  SELECT l_orderkey AS k, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk, l_extendedprice AS price, l_shipdate,
    'OBX|' || l_linenumber || '|NM|c^decoy||' || CASE WHEN l_returnflag = 'N' THEN '' WHEN l_linenumber % 7 = 0 THEN '~' || q
        WHEN l_linenumber % 5 = 0 THEN q || '^u^^' WHEN l_linenumber % 3 = 0 THEN q || '\S\x' ELSE q END
      || '|' || CASE WHEN l_linenumber % 4 = 0 THEN '' ELSE 'copies/mL^x' END || '|0-' || l_linenumber || '||||F|||'
      || CASE WHEN l_partkey % 10 = 0 THEN '' ELSE left(strftime(obs, '%Y%m%d%H%M%S'), CASE l_linenumber % 4 WHEN 0 THEN 8 WHEN 1 THEN 10
           WHEN 2 THEN 12 ELSE 14 END) END
      || CASE WHEN l_linenumber % 2 = 0 THEN chr(13) || 'NTE|1|L|note ' || l_linenumber ELSE '' END AS seg
  FROM (SELECT *, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q, l_shipdate + to_hours(l_linenumber)
          + to_minutes(CAST(l_quantity AS BIGINT)) + to_seconds(l_partkey % 60) AS obs FROM lineitem)
),
txt_r AS (
  SELECT k, concat_ws(chr(13),
    'MSH|^~\&|LabApp|Lab' || (k % 3) || CASE WHEN k % 6 = 0 THEN '' ELSE '^L' || (k % 3) || '^URI' END || '|ClinicApp|' || (k % 50 + 1000)
      || '|' || CASE WHEN k % 13 = 0 THEN '' ELSE left(strftime(first_ship + to_hours(k % 24) + to_minutes(k % 60) + to_seconds(k % 59),
           '%Y%m%d%H%M%S'), CASE k % 4 WHEN 0 THEN 14 WHEN 1 THEN 12 WHEN 2 THEN 10 ELSE 8 END) END
      || '||' || CASE WHEN k % 5 = 0 THEN 'ORU^R01' ELSE 'ORU^R01^ORU_R01' END || '|R' || k || '|P|2.5',
    'PID|1||P-' || k || '^^^^MR',
    CASE WHEN k % 11 = 0 THEN obr || chr(13) || orc ELSE orc || chr(13) || obr END, lines, 'SPM|1',
    'OBX|99|ST|x^y||after-spm||||||F') AS text
  FROM (SELECT k, min(l_shipdate) AS first_ship, string_agg(seg, chr(13) ORDER BY ln, pk, sk, price, seg) AS lines,
          'ORC|SC|O' || CAST(k // 3 AS VARCHAR) || '^SYS' AS orc,
          'OBR|1|O' || CAST(k // 3 AS VARCHAR) || '||T' || (k % 7) || '^Test ' || (k % 7) || '^LN' AS obr
        FROM txt_l GROUP BY k)
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _json_as_text(sql: str) -> str:
    """Wrap every ``to_json(...)`` in ``CAST(... AS VARCHAR)``: DuckDB types it
    JSON, Spark's ``to_json`` gives a plain string."""
    out, i, token = [], 0, "to_json("
    while True:
        j = sql.find(token, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(token) - 1
        while True:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            if depth == 0:
                break
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k + 1] + " AS VARCHAR)")
        i = k + 1


RESULT_JSON = """to_json(struct_pack(
      lab_order_id := r.lab_order_id, sending_facility_id := r.sending_facility_id,
      receiving_lab_code := r.receiving_lab_code, sending_date_time := r.sending_date_time,
      lab_test_results := COALESCE(x.arr, []), message_id := r.message_id, patient_nupn := r.patient_nupn))"""

ORDER_TESTS = "to_json([struct_pack(code := test_code, name := test_name, type := 'Regular')])"

ORACLE: dict[str, str] = {
    # -------------------------------------------------------------- sources
    "scan_order_messages": _with(TXT_O)
    + "SELECT 'lab-orders' AS topic, 0 AS partition, k AS \"offset\", CAST(octet_length(bytes) AS INTEGER) AS n_bytes, "
    "md5(bytes) AS digest FROM txt_o",
    "scan_ack_messages": _with(TXT_A)
    + "SELECT 'lab-orders-ack' AS topic, 0 AS partition, e AS \"offset\", CAST(strlen(text) AS INTEGER) AS n_bytes, "
    "md5(text) AS digest FROM txt_a",
    "scan_result_messages": _with(TXT_R)
    + "SELECT 'lab-results' AS topic, 0 AS partition, k AS \"offset\", CAST(strlen(text) AS INTEGER) AS n_bytes, "
    "md5(text) AS digest FROM txt_r",
    "decode_messages": _with(EX_O) + 'SELECT k AS "offset", replacement_chars FROM ex_o',
    "drop_empty_messages": _with(EX_A) + 'SELECT e AS "offset" FROM ex_a WHERE not_empty',
    "drop_blank_messages": _with(EX_A) + 'SELECT e AS "offset" FROM ex_a WHERE present',
    # ------------------------------------------------------------ shredding
    "segment_counts": _with(EX_O, EX_R)
    + "SELECT 'lab-orders' AS topic, k AS \"offset\", n_segments FROM ex_o "
    "UNION ALL SELECT 'lab-results', k, CAST(6 + n_lines + n_even AS INTEGER) FROM ex_r",
    "custom_delimiters": _with(EX_A)
    + 'SELECT e AS "offset", field_separator, component_separator, \'~\' AS repetition_separator, '
    "'\\' AS escape_character, '&' AS subcomponent_separator FROM ex_a WHERE present",
    "field_access": _with(EX_O)
    + 'SELECT k AS "offset", msh_4_1, msh_4_2, receiving_lab_code AS msh_6_1, patient_nupn AS pid_3_1, '
    "pid_3_5, 'NW' AS orc_1 FROM ex_o",
    "unescape_text": _with(EX_A)
    + "SELECT 'lab-orders-ack' AS topic, e AS \"offset\", acknowledgment_description AS msa_3 FROM ex_a WHERE present "
    "UNION ALL SELECT 'odd', e, 'a' || field_separator || 'b' || chr(0) || 'F' || chr(0) || component_separator || chr(64976) "
    "|| '&' || '~' || chr(92) || 'F' || chr(92) || chr(92) || 'X' || chr(92) || CAST(e % 100 AS VARCHAR) FROM ex_a WHERE present",
    "route_orders": "SELECT 'lab-orders' AS topic, o_orderkey AS \"offset\" FROM orders WHERE o_orderkey % 10 <> 9",
    "route_acks": _with(EX_A) + "SELECT 'lab-orders-ack' AS topic, e AS \"offset\" FROM ex_a "
    "WHERE present AND e % 10 <> 9",
    "route_results": "SELECT DISTINCT 'lab-results' AS topic, l_orderkey AS \"offset\" FROM lineitem "
    "WHERE l_orderkey % 10 <> 9",
    "first_order_group": _with(EX_O)
    + 'SELECT k AS "offset", lab_order_id AS orc_2, test_code AS obr_4_1, test_name AS obr_4_2 FROM ex_o',
    "first_observation_group": _with(EX_R)
    + 'SELECT k AS "offset", CAST(CASE WHEN k % 11 = 0 THEN 0 ELSE n_lines END AS INTEGER) AS n_obx FROM ex_r',
    # ---------------------------------------------------------- projections
    "message_ids": _with(EX_O, EX_A, EX_R)
    + "SELECT 'lab-orders' AS topic, k AS \"offset\", message_id FROM ex_o "
    "UNION ALL SELECT 'lab-orders-ack', e, message_id FROM ex_a WHERE present "
    "UNION ALL SELECT 'lab-results', k, message_id FROM ex_r",
    "facility_fallback": _with(EX_O, EX_R)
    + "SELECT 'lab-orders' AS topic, k AS \"offset\", sending_facility_id FROM ex_o "
    "UNION ALL SELECT 'lab-results', k, sending_facility_id FROM ex_r",
    "ack_facility": _with(EX_A) + 'SELECT e AS "offset", sending_facility_id FROM ex_a WHERE present',
    "receiving_lab": _with(EX_O, EX_R)
    + "SELECT 'lab-orders' AS topic, k AS \"offset\", receiving_lab_code FROM ex_o "
    "UNION ALL SELECT 'lab-results', k, receiving_lab_code FROM ex_r",
    "ack_target": _with(EX_A) + 'SELECT e AS "offset", targeted_disa_code FROM ex_a WHERE present',
    "patient_struct": _with(EX_O)
    + 'SELECT k AS "offset", to_json(struct_pack(nupn := patient_nupn, sex := patient_sex)) AS patient FROM ex_o',
    "patient_nupn": _with(EX_R) + 'SELECT k AS "offset", patient_nupn FROM ex_r',
    "order_ids": _with(EX_O, EX_R)
    + "SELECT 'lab-orders' AS topic, k AS \"offset\", lab_order_id FROM ex_o "
    "UNION ALL SELECT 'lab-results', k, lab_order_id FROM ex_r",
    "tests_ordered": _with(EX_O)
    + "SELECT k AS \"offset\", 1 AS n_tests, test_code AS code, test_name AS name, 'Regular' AS type FROM ex_o",
    "test_results": _with(EX_L, EX_R, EX_POS)
    + 'SELECT k AS "offset", pos, test_code AS code, test_name AS name, value, unit, reference_range, '
    "observation_time FROM ex_pos",
    "observation_values": _with(EX_L, EX_R, EX_POS) + 'SELECT k AS "offset", pos, value FROM ex_pos',
    "observation_units": _with(EX_L, EX_R, EX_POS) + 'SELECT k AS "offset", pos, unit, reference_range FROM ex_pos',
    "observation_times": _with(EX_L, EX_R, EX_POS) + 'SELECT k AS "offset", pos, observation_time FROM ex_pos',
    "ack_fields": _with(EX_A)
    + 'SELECT e AS "offset", acknowledgment_status, ack_message_id, acknowledgment_description '
    "FROM ex_a WHERE present",
    "strict_timestamps": _with(EX_O, EX_A)
    + "SELECT 'lab-orders' AS topic, k AS \"offset\", sending_date_time FROM ex_o "
    "UNION ALL SELECT 'lab-orders-ack', e, sending_date_time FROM ex_a WHERE present",
    "lenient_timestamps": _with(EX_R) + 'SELECT k AS "offset", sending_date_time FROM ex_r',
    "order_records": _with(EX_O)
    + 'SELECT k AS "offset", lab_order_id, sending_facility_id, receiving_lab_code, sending_date_time, '
    "1 AS n_tests, test_code, test_name, 'Regular' AS test_type, message_id, patient_nupn, patient_sex "
    "FROM ex_o WHERE lab_order_id IS NOT NULL",
    "ack_records": _with(EX_A)
    + 'SELECT e AS "offset", sending_facility_id, targeted_disa_code, sending_date_time, message_id, '
    "ack_message_id, acknowledgment_status, acknowledgment_description "
    "FROM ex_a WHERE present AND ack_message_id IS NOT NULL",
    "result_records": _with(EX_L, EX_R)
    + 'SELECT r.k AS "offset", r.lab_order_id, r.sending_facility_id, r.receiving_lab_code, '
    "r.sending_date_time, CAST((SELECT count(*) FROM ex_l l WHERE l.k = r.k AND l.has_value) AS INTEGER) AS n_results, "
    "r.message_id, r.patient_nupn FROM ex_r r WHERE r.lab_order_id IS NOT NULL",
    "order_table_rows": _with(EX_O)
    + f'SELECT k AS "offset", lab_order_id, sending_facility_id, receiving_lab_code, sending_date_time, '
    f"{ORDER_TESTS} AS lab_tests_ordered FROM ex_o WHERE lab_order_id IS NOT NULL",
    # -------------------------------------------------------------- filters
    "filter_orders": _with(EX_O) + 'SELECT k AS "offset" FROM ex_o WHERE lab_order_id IS NOT NULL',
    "filter_acks": _with(EX_A) + 'SELECT e AS "offset" FROM ex_a WHERE present AND ack_message_id IS NOT NULL',
    "filter_results": _with(EX_R) + 'SELECT k AS "offset" FROM ex_r WHERE lab_order_id IS NOT NULL',
    # ----------------------------------------------------------------- JSON
    "order_json": _with(EX_O)
    + 'SELECT k AS "offset", to_json(struct_pack(lab_order_id := lab_order_id, '
    "sending_facility_id := sending_facility_id, receiving_lab_code := receiving_lab_code, "
    "sending_date_time := sending_date_time, "
    "lab_tests_ordered := [struct_pack(code := test_code, name := test_name, type := 'Regular')], "
    "message_id := message_id, patient := struct_pack(nupn := patient_nupn, sex := patient_sex))) AS value "
    "FROM ex_o WHERE lab_order_id IS NOT NULL",
    "ack_json": _with(EX_A)
    + 'SELECT e AS "offset", to_json(struct_pack(sending_facility_id := sending_facility_id, '
    "targeted_disa_code := targeted_disa_code, sending_date_time := sending_date_time, "
    "message_id := message_id, ack_message_id := ack_message_id, "
    "acknowledgment_status := acknowledgment_status, "
    "acknowledgment_description := acknowledgment_description)) AS value "
    "FROM ex_a WHERE present AND ack_message_id IS NOT NULL",
    "result_json": _with(EX_L, EX_R, EX_OBS)
    + f'SELECT r.k AS "offset", {RESULT_JSON} AS value '
    "FROM ex_r r LEFT JOIN ex_obs x ON x.k = r.k WHERE r.lab_order_id IS NOT NULL",
    "tests_json": _with(EX_O)
    + f'SELECT k AS "offset", {ORDER_TESTS} AS lab_tests_ordered FROM ex_o WHERE lab_order_id IS NOT NULL',
    "results_json": _with(EX_L, EX_R, EX_OBS)
    + 'SELECT r.k AS "offset", to_json(COALESCE(x.arr, [])) AS lab_test_results '
    "FROM ex_r r LEFT JOIN ex_obs x ON x.k = r.k WHERE r.lab_order_id IS NOT NULL",
    # -------------------------------------------------------------- upserts
    "upsert_orders": _with(EX_O)
    + "SELECT lab_order_id, sending_facility_id, receiving_lab_code, sending_date_time, "
    f"{ORDER_TESTS} AS lab_tests_ordered FROM ex_o WHERE lab_order_id IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY lab_order_id ORDER BY k DESC) = 1",
    "upsert_acks": _with(EX_A)
    + "SELECT sending_facility_id, targeted_disa_code, sending_date_time, message_id, ack_message_id, "
    "acknowledgment_status, acknowledgment_description FROM ex_a "
    "WHERE present AND ack_message_id IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY ack_message_id ORDER BY e DESC) = 1",
    "upsert_results": _with(EX_L, EX_R, EX_OBS)
    + "SELECT r.lab_order_id, r.sending_facility_id, r.receiving_lab_code, r.sending_date_time, "
    "to_json(COALESCE(x.arr, [])) AS lab_test_results, r.message_id, r.patient_nupn "
    "FROM ex_r r LEFT JOIN ex_obs x ON x.k = r.k WHERE r.lab_order_id IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY r.lab_order_id ORDER BY r.k DESC) = 1",
    "upsert_two_batches": _with(EX_A)
    + "SELECT sending_facility_id, targeted_disa_code, sending_date_time, message_id, ack_message_id, "
    "acknowledgment_status, acknowledgment_description FROM ex_a "
    "WHERE present AND ack_message_id IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY ack_message_id ORDER BY e % 2 DESC, e DESC) = 1",
    "upsert_broker_time": _with(EX_A)
    + "SELECT sending_facility_id, targeted_disa_code, sending_date_time, message_id, ack_message_id, "
    "acknowledgment_status, acknowledgment_description FROM ex_a "
    "WHERE present AND ack_message_id IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY ack_message_id ORDER BY e DESC) = 1",
    # --------------------------------------------------------------- errors
    "permissive_acks": _with(EX_O, EX_A)
    + "SELECT 'lab-orders' AS topic, k AS \"offset\", CAST(NULL AS VARCHAR) AS ack_message_id, "
    "'Message is not an ACK message' AS error FROM ex_o "
    "UNION ALL SELECT * FROM (SELECT 'lab-orders-ack', e, ack_message_id, "
    "CASE WHEN e % 10 = 9 THEN 'Message is not an ACK message' "
    "WHEN e % 13 = 0 THEN 'Text ''' || sent_12 || ''' could not be parsed as a date-time' END AS error "
    "FROM ex_a WHERE present) x WHERE error IS NOT NULL OR ack_message_id IS NOT NULL",
    "malformed_results": """
WITH msgs AS (
  SELECT k, left(sent || '.1234', [2, 4, 6, 8, 9, 10, 11, 12, 13, 14, 15, 19][1 + CAST(k % 12 AS INTEGER)]) AS sent,
    k % 12 IN (3, 5, 7, 9) AS sent_ok
  FROM (SELECT l_orderkey AS k, strftime(min(l_shipdate) + to_hours(l_orderkey % 24) + to_minutes(l_orderkey % 60)
          + to_seconds(l_orderkey % 59), '%Y%m%d%H%M%S') AS sent FROM lineitem GROUP BY l_orderkey)),
obs AS (
  SELECT l_orderkey AS k, left(strftime(l_shipdate + to_hours(l_linenumber) + to_minutes(CAST(l_quantity AS BIGINT))
      + to_seconds(l_partkey % 60), '%Y%m%d%H%M%S'), 13) AS bad
  FROM lineitem WHERE l_returnflag <> 'N' AND l_partkey % 6 = 0 AND l_orderkey % 11 <> 0
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1)
SELECT m.k AS "offset", 'R' || CAST(m.k AS VARCHAR) AS message_id,
  'Text ''' || CASE WHEN sent_ok THEN bad ELSE sent END || ''' could not be parsed as a date-time' AS error
FROM msgs m LEFT JOIN obs o ON o.k = m.k WHERE NOT sent_ok OR bad IS NOT NULL
""",
    "clamped_timestamps": f"""
WITH msgs AS (
  SELECT l_orderkey AS k, min(l_shipdate) + to_hours(l_orderkey % 24) + to_minutes(l_orderkey % 60)
    + to_seconds(l_orderkey % 59) AS sent FROM lineitem GROUP BY l_orderkey)
SELECT k AS "offset", strftime(CASE k % 5
    WHEN 0 THEN CAST(last_day(make_date(year(sent), 2, 1)) AS TIMESTAMP) + to_hours(10) + to_minutes(15) + to_seconds(30)
    WHEN 1 THEN CAST(last_day(make_date(year(sent), 2, 1)) AS TIMESTAMP)
    WHEN 2 THEN CAST(make_date(year(sent), 4, 30) AS TIMESTAMP) + to_hours(23) + to_minutes(59)
    WHEN 3 THEN date_trunc('day', sent) + INTERVAL 1 DAY
    ELSE CAST(make_date(year(sent) + 1, 1, 1) AS TIMESTAMP) END, {ISO}) AS sending_date_time
FROM msgs
""",
    "dropmalformed_acks": _with(EX_A)
    + "SELECT 'lab-orders-ack' AS topic, e AS \"offset\", ack_message_id FROM ex_a "
    "WHERE present AND e % 10 <> 9 AND e % 13 <> 0 AND ack_message_id IS NOT NULL",
    "malformed_report": _with(EX_O, EX_A)
    + "SELECT 'lab-orders' AS topic, k AS \"offset\", message_id, 'Message is not an ACK message' AS error "
    "FROM ex_o "
    "UNION ALL SELECT 'lab-orders-ack', e, message_id, "
    "CASE WHEN e % 10 = 9 THEN 'Message is not an ACK message' "
    "ELSE 'Text ''' || sent_12 || ''' could not be parsed as a date-time' END "
    "FROM ex_a WHERE present AND (e % 10 = 9 OR e % 13 = 0)",
}

ORACLE["quarantine_replay"] = (
    _with(EX_O, EX_A)
    + "SELECT 'lab-orders' AS topic, k AS \"offset\", CAST(NULL AS VARCHAR) AS ack_message_id, "
    "CAST(NULL AS VARCHAR) AS sending_date_time, 'Message is not an ACK message' AS error FROM ex_o "
    "UNION ALL SELECT 'lab-orders-ack', e, ack_message_id, "
    f"CASE WHEN e % 13 = 0 THEN strftime(strptime(sent_12, '%Y%m%d%H%M'), {ISO}) ELSE sending_date_time END, NULL "
    "FROM ex_a WHERE present AND (e % 10 = 9 OR e % 13 = 0) AND ack_message_id IS NOT NULL"
)
ORACLE["upsert_bucketed_state"] = ORACLE["upsert_two_batches"].replace("e % 2", "e % 3")
ORACLE["described_acks"], ORACLE["described_orders"] = ORACLE["ack_records"], ORACLE["order_records"]
ORACLE["upsert_merged_state"] = ORACLE["upsert_two_batches"]
ORACLE = {name: _json_as_text(sql) for name, sql in ORACLE.items()}
