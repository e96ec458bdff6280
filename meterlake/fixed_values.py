"""Tariff book, meter registry, names and limits that results depend on.

All of them are plain data. Functions take them as arguments, so another utility's book or
registry can be passed instead.
"""

from __future__ import annotations

from typing import NamedTuple


class Block(NamedTuple):
    """One consumption block: its width in kWh (None = open ended) and its price per kWh."""

    limite_kwh: float | None
    precio: float


class Tariff(NamedTuple):
    clave: str
    ciudades: tuple[str, ...]
    bloques: tuple[Block, ...]
    dac_kwh_mes: float
    dac_precio: float


class Meter(NamedTuple):
    id_medidor: str
    id_hogar: str
    ciudad: str
    tarifa: str
    factor: float


# --- Fixed values: household tariffs, in book order -------------------------------------------
TARIFFS: tuple[Tariff, ...] = (
    Tariff("1", ("Ciudad de México",),
           (Block(75, 0.954), Block(140, 1.013), Block(250, 1.313), Block(None, 3.397)), 500, 6.18),
    Tariff("1B", ("Guadalajara",),
           (Block(100, 0.906), Block(200, 1.013), Block(300, 1.313), Block(None, 3.241)), 600, 6.18),
    Tariff("1E", ("Monterrey",),
           (Block(300, 0.785), Block(500, 0.944), Block(700, 1.313), Block(None, 2.942)), 850, 6.18),
    Tariff("1F", ("Mérida",),
           (Block(300, 0.741), Block(500, 0.900), Block(700, 1.313), Block(None, 2.849)), 1000, 6.18),
    Tariff("1C", ("Veracruz",),
           (Block(150, 0.859), Block(300, 1.013), Block(450, 1.313), Block(None, 3.102)), 700, 6.18),
)
DEFAULT_TARIFF = "1"

# --- Fixed values: meter registry -------------------------------------------------------------
METERS: tuple[Meter, ...] = (
    Meter("MED-001", "HOG-001", "Ciudad de México", "1", 0.8),
    Meter("MED-002", "HOG-002", "Ciudad de México", "1", 1.3),
    Meter("MED-003", "HOG-003", "Guadalajara", "1B", 1.1),
    Meter("MED-004", "HOG-004", "Guadalajara", "1B", 0.7),
    Meter("MED-005", "HOG-005", "Monterrey", "1E", 1.5),
    Meter("MED-006", "HOG-006", "Monterrey", "1E", 1.8),
    Meter("MED-007", "HOG-007", "Mérida", "1F", 1.4),
    Meter("MED-008", "HOG-008", "Veracruz", "1C", 1.0),
)

# --- Fixed values: names ----------------------------------------------------------------------
DAYS_EN = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
DAYS_SHORT_ES = ("Lun", "Mar", "Mié", "Jue", "Vie", "Sáb", "Dom")
DAY_SPELLINGS = (
    ("monday", "lunes"),
    ("tuesday", "martes"),
    ("wednesday", "miércoles", "miercoles"),
    ("thursday", "jueves"),
    ("friday", "viernes"),
    ("saturday", "sábado", "sabado"),
    ("sunday", "domingo"),
)
MONTHS_ES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
FAILURE_CAUSES = (
    "timeout_comunicacion", "señal_debil", "bateria_baja", "reinicio_medidor", "corte_temporal",
)

# --- Fixed values: limits ---------------------------------------------------------------------
KWH_RANGE = (0.0, 5.0)
VOLTAGE_RANGE = (100.0, 140.0)
STATUS_OK = "ok"
PEAK_SIGMAS = 3
READING_SECONDS = 3
TOP_HOMES = 8
TOP_PEAKS = 10
SCATTER_PEAKS = 500
LATEST_HOURS = 72
LATEST_DAYS = 90

# --- Fixed values: expected load, (first hour, mean W, standard deviation W) ------------------
LOAD_PROFILE = (
    (0, 80, 30),
    (6, 600, 200),
    (9, 300, 100),
    (13, 700, 250),
    (15, 250, 80),
    (18, 900, 350),
    (22, 200, 60),
)
