"""Messages used by the tests, all our own.

ORDER, ACK and RESULT are plain (FIXTURES.md §2). FULL_* go through more of the
format: software and note segments, timing segments, Z segments, a second order
group, trailing separators, unused components and repetitions, escapes, and
times of the other accepted lengths.
"""

CR = "\r"

ORDER_LINES = [
    "MSH|^~\\&|ClinicApp|North Clinic^10010001^URI|LabApp|LAB7|20240305101530||OML^O21^OML_O21|ord-0001|P|2.5",
    "PID|1||NP-000-1^^^^MR||Doe^Sam||19900101|F",
    "ORC|NW|ORD0001",
    "OBR|1|ORD0001||1111-1^Test One^LN|Urgent",
    "OBX|1|ST|VISIT^Visit||x||||||F",
    "OBR|2|ORD0001||2222-2^Test Two^LN|Urgent",
    "SPM|1",
]
ORDER = CR.join(ORDER_LINES)
ORDER_JSON = '{"lab_order_id":"ORD0001","sending_facility_id":"10010001","receiving_lab_code":"LAB7","sending_date_time":"2024-03-05T10:15:30","lab_tests_ordered":[{"code":"1111-1","name":"Test One","type":"Regular"}],"message_id":"ord-0001","patient":{"nupn":"NP-000-1","sex":"F"}}'

ACK_LINES = [
    "MSH|^~\\&|LabApp|LAB7^L7^URI|ClinicApp|10010001|20240305101600||ACK^O21^ACK|ack-0001|P|2.5",
    "MSA|AA|ord-0001|Accepted",
]
ACK = CR.join(ACK_LINES)
ACK_JSON = '{"sending_facility_id":"LAB7","targeted_disa_code":"ClinicApp","sending_date_time":"2024-03-05T10:16:00","message_id":"ack-0001","ack_message_id":"ord-0001","acknowledgment_status":"AA","acknowledgment_description":"Accepted"}'

RESULT_LINES = [
    "MSH|^~\\&|LabApp|Lab Seven^L7^URI|ClinicApp|10010001|20240306080000||ORU^R01^ORU_R01|res-0001|P|2.5",
    "PID|1||NP-000-1^^^^MR",
    "ORC|SC|ORD0001",
    "OBR|1|ORD0001||1111-1^Test One^LN",
    "OBX|1|ST|c^n||free text||||||F",
    "OBX|2|NM|c^n||42|mg/L|0-50||||F|||202403051015",
    "OBX|3|NM|c^n|||mg/L|0-50||||F",
    "SPM|1",
    "OBX|4|ST|c^n||after specimen||||||F",
]
RESULT = CR.join(RESULT_LINES)
RESULT_JSON = '{"lab_order_id":"ORD0001","sending_facility_id":"L7","receiving_lab_code":"10010001","sending_date_time":"2024-03-06T08:00:00","lab_test_results":[{"code":"1111-1","name":"Test One","value":"free text","unit":null,"referenceRange":null,"observationDateTime":null},{"code":"1111-1","name":"Test One","value":"42","unit":"mg/L","referenceRange":"0-50","observationDateTime":"2024-03-05T10:15:00"}],"message_id":"res-0001","patient_nupn":"NP-000-1"}'

FULL_ORDER = CR.join([
    "MSH|^~\\&|WardSystem^v3|Lakeside^LK-77^L~Other^X|Hub|CENTRAL^C^ISO|20230917064502||OML^O21|q-5581|T|2.5^^|||",
    "SFT|Acme Ward|9.1|Ward|b12|",
    "NTE|1||order note with \\T\\ sign|",
    "PID|1|EXT-9|LK/0042^^^LK^PI~ALT-3^^^Z^AN||Okoro^Ada^^^Ms^||19880229|F|||1 Shore Rd^^Lakeside^^^^|",
    "PV1|1|I|W4^2^B^LK||",
    "ZPX|local|segment|",
    "ORC|NW|LK-2023-0917^WARD|||||1^once^^^^R|",
    "TQ1|1||||||20230917|",
    "OBR|1|LK-2023-0917^WARD||GLU\\S\\F^Glucose \\F\\ fasting^99L|||202309170600|||||",
    "NTE|1||fasting|",
    "OBX|1|CE|FAST^Fasting||Y^Yes^99L||||||F|",
    "ORC|NW|LK-2023-0918|",
    "OBR|2|LK-2023-0918||HBA1C^Glycated^99L|",
    "SPM|1|||BLD^Blood^99L|",
])
FULL_ORDER_JSON = '{"lab_order_id":"LK-2023-0917","sending_facility_id":"LK-77","receiving_lab_code":"CENTRAL","sending_date_time":"2023-09-17T06:45:02","lab_tests_ordered":[{"code":"GLU^F","name":"Glucose | fasting","type":"Regular"}],"message_id":"q-5581","patient":{"nupn":"LK/0042","sex":"F"}}'

FULL_ACK = CR.join([
    "MSH|^~\\&|Hub|CENTRAL^C^ISO|WardSystem^v3|Lakeside|20230917064510||ACK|r-77|T|2.5||||AL|",
    "SFT|Acme Hub|2|Hub|x|",
    "MSA|AR|q-5581^x|Quota \\R\\ limit \\E\\F\\~second|7|",
    "ERR|||207^Application error^HL70357|E|",
])
FULL_ACK_JSON = '{"sending_facility_id":"CENTRAL","targeted_disa_code":"WardSystem","sending_date_time":"2023-09-17T06:45:10","message_id":"r-77","ack_message_id":"q-5581","acknowledgment_status":"AR","acknowledgment_description":"Quota ~ limit \\\\F\\\\"}'

FULL_RESULT = CR.join([
    "MSH|^~\\&|Hub|Central Laboratory|WardSystem|LK-77^a&b^c|2023091806||ORU^R01^ORU_R01|z-9|T|2.5|",
    "SFT|Acme Hub|2|Hub|x|",
    "PID|1||LK/0042^^^LK^PI~ALT-3||Okoro^Ada|",
    "NTE|1|L|patient note|",
    "PV1|1|I|W4|",
    "ORC|RE|LK-2023-0917^WARD|C-1||CM|",
    "OBR|1|LK-2023-0917|C-1|GLU^Glucose^99L^G2^Glu^L|||20230917|",
    "NTE|1||comment|",
    "OBX|1|NM|GLU^Glucose^99L||5.4^^~5.5|mmol/L^x|3.9-5.5^y||||F|||202309170630|",
    "OBX|2|ST|CMT^Comment^99L||see \\T\\ note&&||||||F|||2023091707|^tech|",
    "NTE|1||after|",
    "OBX|3|ST|EMPTY^Empty||||||||F|||20230917|",
    "ORC|RE|LK-2023-0918|",
    "OBR|2|LK-2023-0918||HBA1C^Glycated^99L|",
    "OBX|1|NM|HBA1C^Glycated||6.1|%|",
])
FULL_RESULT_JSON = '{"lab_order_id":"LK-2023-0917","sending_facility_id":"Central Laboratory","receiving_lab_code":"LK-77","sending_date_time":"2023-09-18T06:00:00","lab_test_results":[{"code":"GLU","name":"Glucose","value":"5.4","unit":"mmol/L","referenceRange":"3.9-5.5","observationDateTime":"2023-09-17T06:30:00"},{"code":"GLU","name":"Glucose","value":"see \\\\T\\\\ note","unit":null,"referenceRange":null,"observationDateTime":"2023-09-17T07:00:00"}],"message_id":"z-9","patient_nupn":"LK/0042"}'
