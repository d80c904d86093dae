from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from smartmaint import schemas  # noqa: E402
from smartmaint.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[*]", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tests-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s


T0 = dt.datetime(2024, 1, 1, 0, 0, 0)

# Seed rows of the reference's setup script (FIXTURES.md §A); row n at T0 + n minutes.
SEED_MACHINES = [("PUMP_001", "Pump", "Factory_A"), ("TURB_001", "Turbine", "Factory_A"),
                 ("COMP_001", "Compressor", "Factory_B"), ("PUMP_002", "Pump", "Factory_B"),
                 ("MOTOR_001", "Motor", "Factory_A")]
SEED_SENSORS = [("MPU_001", "MPU6050", "Multiple", -50.0, 200.0, 0.1), ("DHT_001", "DHT22", "C/%", -40.0, 80.0, 0.5),
                ("PRES_001", "Pressure", "hPa", 900.0, 1100.0, 1.0), ("VIBR_001", "Vibration", "m/s2", -50.0, 50.0, 0.01),
                ("TEMP_001", "DS18B20", "C", -55.0, 125.0, 0.5)]
SEED_READINGS = [
    (1, "MPU_001", "PUMP_001", 75.5, 1013.25, 2.1, 45.2, 1.5, -0.8, 9.8, "N", "ESP32"),
    (2, "DHT_001", "PUMP_001", 76.2, 1012.8, 2.3, 46.1, 1.2, -0.5, 9.7, "N", "ESP32"),
    (3, "MPU_001", "TURB_001", 82.1, 1015.2, 3.2, 52.4, 2.1, -1.2, 9.9, "N", "ESP32"),
    (4, "PRES_001", "COMP_001", 78.9, 1010.5, 1.8, 48.7, 0.9, -0.3, 9.6, "N", "ESP32"),
    (5, "MPU_001", "PUMP_002", 85.3, 1014.1, 2.8, 55.1, 1.8, -0.9, 9.8, "N", "ESP32"),
    (6, "MPU_001", "PUMP_001", 98.5, 1050.0, 8.5, 85.2, 5.5, -3.8, 12.1, "S", "SIMULACAO"),
    (7, "DHT_001", "TURB_001", 96.8, 950.0, 9.2, 88.1, 6.2, -4.2, 11.8, "S", "SIMULACAO"),
]


def reading(n, sensor, machine, t, p, v, h, x, y, z, flag, src, ts=None, gyro=(None, None, None)):
    return (n, sensor, machine, ts or T0 + dt.timedelta(minutes=n), t, p, v, h, x, y, z, *gyro, flag, src)


@pytest.fixture(scope="session")
def machines(spark):
    return spark.createDataFrame([(a, b, c, None, "A") for a, b, c in SEED_MACHINES], schemas.MACHINES)


@pytest.fixture(scope="session")
def sensors(spark):
    return spark.createDataFrame(SEED_SENSORS, schemas.SENSORS)


@pytest.fixture(scope="session")
def readings(spark):
    return spark.createDataFrame([reading(*r) for r in SEED_READINGS], schemas.READINGS)


def make_readings(spark, rows):
    return spark.createDataFrame([reading(*r) if len(r) == 12 else r for r in rows], schemas.READINGS)
