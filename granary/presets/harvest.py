"""Settings for provincial harvests: daily weather files, yearly harvest facts, integrated history."""

from __future__ import annotations

from granary.functions.scoring import midpoint
from granary.operators.synth import RangeRule
from granary.plans.silver import FactSpec, MeasurementSpec

# Province codes of the weather files and their standard names.
PROVINCES = {
    "aceh": "ACEH",
    "babel": "KEPULAUAN BANGKA BELITUNG",
    "bengkulu": "BENGKULU",
    "jambi": "JAMBI",
    "kepri": "KEPULAUAN RIAU",
    "lampung": "LAMPUNG",
    "riau": "RIAU",
    "sumbar": "SUMATERA BARAT",
    "sumsel": "SUMATERA SELATAN",
    "sumut": "SUMATERA UTARA",
}
# Spellings of the facts that differ from the standard names.
ALIASES = {
    "KEP. RIAU": "KEPULAUAN RIAU",
    "KEP. BANGKA BELITUNG": "KEPULAUAN BANGKA BELITUNG",
}

# Raw column names and their names in the silver tables.
WEATHER_NAMES = {
    "STASIUN": "stasiun",
    "TANGGAL": "tanggal",
    "TN": "temp_min",
    "TX": "temp_max",
    "TAVG": "temp_avg",
    "RH_AVG": "humidity_avg",
    "RR": "rainfall",
    "SS": "sunshine_duration",
    "FF_X": "wind_speed_max",
    "DDD_X": "wind_dir_max",
    "FF_AVG": "wind_speed_avg",
    "DDD_CAR": "wind_dir_avg",
}
WEATHER_NUMBERS = (
    "temp_min", "temp_max", "temp_avg", "humidity_avg", "rainfall", "sunshine_duration",
    "wind_speed_max", "wind_dir_max", "wind_speed_avg",
)
WEATHER_KEYS = ("temp_min", "temp_max", "temp_avg", "humidity_avg", "rainfall")

WEATHER = MeasurementSpec(
    names=WEATHER_NAMES,
    code="province_code",
    category="province",
    code_names=PROVINCES,
    date="tanggal",
    numeric=WEATHER_NUMBERS,
    score_on=("rainfall", "temp_avg"),
    keep_if_any=WEATHER_KEYS,
)

# Raw column names of the facts.
FACTS = FactSpec(
    names={
        "Provinsi": "provinsi",
        "Luas Panen (ha)": "luas_panen_ha",
        "Produktivitas (ku/ha)": "produktivitas_ku_ha",
        "Produksi (ton)": "produksi_ton",
    },
    key="provinsi",
    numeric=("luas_panen_ha", "produktivitas_ku_ha", "produksi_ton"),
    positive="luas_panen_ha",
    aliases=ALIASES,
    leave_out=("INDONESIA",),  # the total of all provinces
)

# Gold: output, and for each the first choice of source columns that a table has.
CATEGORY, YEAR, TARGET, AREA = "Provinsi", "Tahun", "Produksi", "Luas_Panen"
RAIN, HUMIDITY, TEMPERATURE = "Curah_hujan", "Kelembapan", "Suhu_rata_rata"
WEATHER_FEATURES = (RAIN, HUMIDITY, TEMPERATURE)
WEATHER_MEASURES = (
    (RAIN, ((("rainfall",), "rainfall"),)),
    (HUMIDITY, ((("humidity_avg",), "humidity_avg"),)),
    (
        TEMPERATURE,
        (
            (("temp_avg",), "temp_avg"),
            (("temp_min", "temp_max"), lambda: midpoint("temp_min", "temp_max")),
        ),
    ),
)
# Names of the history and the facts, and those of gold.
HISTORY_NAMES = {
    "Provinsi": "province",
    "Luas Panen": AREA,
    "Curah hujan": RAIN,
    "Suhu rata-rata": TEMPERATURE,
}
HISTORY_NUMBERS = (TARGET, AREA, RAIN, HUMIDITY, TEMPERATURE)
FACT_NAMES = {
    "provinsi": "province",
    "produksi_ton": TARGET,
    "luas_panen_ha": AREA,
    "produktivitas_ku_ha": "Produktivitas",
}
REQUIRED = ("province", YEAR, TARGET, AREA, RAIN, HUMIDITY, TEMPERATURE)
DEFAULT_YEAR = 2023

# Ranges and factors of the synthetic rows.
YEARS = (1990, 2025)
RULES = (
    RangeRule(AREA, 0.5, 1.5, floor=10000.0, whole=True),
    RangeRule(RAIN, 0.8, 1.2, floor=800.0, ceiling=3000.0),
    RangeRule(HUMIDITY, 0.95, 1.05, floor=70.0, ceiling=95.0),
    RangeRule(TEMPERATURE, 0.95, 1.05, floor=24.0, ceiling=32.0),
)
# Looked up by the standard name.
FACTORS = {
    "ACEH": 1.0,
    "SUMATERA UTARA": 1.2,
    "SUMATERA BARAT": 0.9,
    "RIAU": 0.8,
    "JAMBI": 0.85,
    "SUMATERA SELATAN": 1.1,
    "BENGKULU": 0.7,
    "LAMPUNG": 1.3,
}
SYNTHETIC_ROWS = 1_000_000

# Modelling and reports.
FEATURES = (AREA, RAIN, HUMIDITY, TEMPERATURE)
# Names of the prediction table.
PREDICTION_NAMES = {
    "actual": "Actual_Produksi",
    "predicted": "Predicted_Produksi",
    "model": "Model",
    "dated": "Prediction_Date",
    "error": "Error",
    "error_pct": "Error_Percentage",
}
