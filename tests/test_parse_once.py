"""Messages are parsed once a row, whatever reads their fields."""

import json

from smartmaint.streaming import ingest as T


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_text_and_time_of_a_message_are_parsed_once(spark):
    raw = spark.createDataFrame([("plant/ESP32_M1/sensors/data", "{}")], "topic string, value string")
    for df in (T.stream_readings(raw), T.dead_letters(raw)):
        assert _plan(df).count("from_json(") == 1
        assert _plan(df).count("timestamp_millis(") == 1


def test_odd_messages_keep_their_rows_and_reasons(spark):
    body = {"device_id": "ESP32_M_1", "timestamp": "2024-01-02T03:04:05.000006Z", "sensors": {"temperature": 20.5, "humidity": None}}
    texts = [json.dumps(body), json.dumps({**body, "timestamp": "1704164645006"}), json.dumps({**body, "timestamp": 1704164645006}),
             json.dumps({**body, "timestamp": "soon"}), json.dumps({**body, "timestamp": None}), json.dumps({**body, "sensors": None}),
             json.dumps({**body, "sensors": {}}), json.dumps({**body, "device_id": None}), json.dumps(body)[:40], "", "[]", "null", None,
             json.dumps({**body, "location": "x" * 60, "fault_detected": True})]
    raw = spark.createDataFrame([("plant/ESP32_M_1/sensors/data", t) for t in texts] + [("plant/ESP32_M_1/heartbeat", texts[0])],
                                "topic string, value string")
    bad = {r.value: r.reason for r in T.dead_letters(raw).collect()}
    assert bad == {texts[3]: "bad_timestamp", texts[4]: "missing_timestamp", texts[5]: "missing_sensors", texts[7]: "missing_device_id",
                   texts[8]: "invalid_json", "": "invalid_json", "[]": "invalid_json", "null": "invalid_json", None: "invalid_json"}
    good = T.stream_readings(raw).collect()
    assert sorted(str(r.dataHora_medicao) for r in good) == ["2024-01-02 03:04:05.000006"] * 3 + ["2024-01-02 03:04:05.006000"] * 2
    assert [r.vl_temperatura for r in good].count(20.5) == 4 and {r.id_maquina for r in good} == {"M1_EQ"}
    assert [(len(r.localizacao), r.tipo_maquina) for r in good if r.flag_falha == "S"] == [(50, "Unknown")]
