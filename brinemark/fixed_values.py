"""Values that results depend on literally.

Everything in this module is a fixed value of the data model: names, labels,
messages, bounds and constants. They are data, not logic.
"""

# --- fixed values: coast keys (stem of the landing file) and display names ---
COASTS = {
    "salinacruz": "Salina Cruz",
    "matamoros": "Matamoros",
    "vallarta": "Puerto Vallarta",
    "colonet": "Punta Colonet",
    "tuxpan": "Tuxpan",
    "carmen": "Playa del Carmen",
    "sabancuy": "Sabancuy",
}

# --- fixed values: coast dimension (name, id, region, state, number) ---------
COAST_DIMENSION = [
    ("Matamoros", "matamoros", "Golfo de México", "Tamaulipas", "01"),
    ("Tuxpan", "tuxpan", "Golfo de México", "Veracruz", "02"),
    ("Sabancuy", "sabancuy", "Golfo de México", "Campeche", "03"),
    ("Playa del Carmen", "carmen", "Mar Caribe", "Quintana Roo", "04"),
    ("Salina Cruz", "salinacruz", "Pacífico Sur", "Oaxaca", "05"),
    ("Puerto Vallarta", "vallarta", "Pacífico Central", "Jalisco", "06"),
    ("Punta Colonet", "colonet", "Pacífico Norte", "Baja California", "07"),
]

# --- fixed values: sea states from calm to extreme, model labels 1..7 --------
SEA_STATES = [
    "Mar calmado",
    "Mar suave",
    "Mar dinámico",
    "Mar agitado",
    "Mar fuerte",
    "Mar peligroso",
    "Mar extremo",
]
UNKNOWN_SEA_STATE = "Categoría desconocida"

# --- fixed values: wind label of the payload, by wind mode -------------------
WIND_LABELS = {"max": "Viento (oleaje máx.)", "mid": "Viento (punto medio)"}

# --- fixed values: raw line layout (token index -> meaning) ------------------
TOKEN_MONTH, TOKEN_DAY, TOKEN_HOUR = 0, 1, 2
TOKEN_WIND_SPEED, TOKEN_WIND_DIR = 3, 4
TOKEN_HEIGHT, TOKEN_WAVE_DIR, TOKEN_PERIOD = 5, 6, 7
LINE_WIDTHS = (12, 13)

# --- fixed values: quarantine messages ---------------------------------------
MSG_STRUCTURE = "Error Estructura: La fila no tiene el número correcto de columnas"
MSG_COAST = "Nombre costa no identificado; "
MSG_DATE = "Fecha invalida; "
MSG_WIND_SPEED = "Viento fuera de rango; "
MSG_WIND_DIR = "Dir. Viento fuera de rango; "
MSG_HEIGHT = "Altura ola fuera de rango; "
MSG_WAVE_DIR = "Dir. Ola fuera de rango; "
MSG_PERIOD = "Periodo ola fuera de rango; "

# --- fixed values: inclusive measure bounds, default and strict presets ------
BOUNDS = {
    "wind_speed_ms": (0, 100),
    "wind_direction_deg": (0, 360),
    "wave_height_m": (0, 50),
    "wave_direction_deg": (0, 360),
    "wave_period_s": (0, 50),
}
STRICT_BOUNDS = {
    "wind_speed_ms": (0, 25),
    "wind_direction_deg": (0, 360),
    "wave_height_m": (0, 7),
    "wave_direction_deg": (0, 360),
    "wave_period_s": (0, 15),
}
STRICT_PERIOD = ("1979-01-01", "2019-01-01")  # from inclusive, to exclusive

# --- fixed values: physics ----------------------------------------------------
GRAVITY = 9.81
SEA_WATER_DENSITY = 1026
POWER_COEFFICIENT_W = 490      # W/m per m^2 s
POWER_COEFFICIENT_KW = 0.49    # kW/m per m^2 s
DAYS_PER_YEAR = 365.2425

# --- fixed values: bands ------------------------------------------------------
POWER_EDGES = [0, 50, 100, 200, 500, None]  # None: unbounded above
POWER_LABELS = ["bajo", "medio", "alto", "muy_alto", "extremo"]
WIND_EDGES = [0, 2.5, 5, 7.5, 10, 12.5, 15, 17.5, 20, 22.5, 25, 27.5, 30]
WAVE_EDGES = [0, 0.4, 0.6, 0.8, 1, 1.2, 1.4, 1.6, 2, 2.4, 5, 10]

# --- fixed values: extreme-value settings ------------------------------------
THRESHOLD_QUANTILE = 0.95
STORM_GAP_HOURS = 72
RETURN_PERIODS = (50, 100)
BOOTSTRAP_RESAMPLES = 1000
CONFIDENCE = 0.95

# --- fixed values: classifier settings ---------------------------------------
MODEL_FEATURES = [
    "wind_speed_ms",
    "wave_height_m",
    "wave_period_s",
    "wave_energy",
    "wave_power_kW_m",
]
EXTREME_FEATURES = ["wave_energy", "wave_power_kW_m"]
TRAIN_EVERY_N_YEARS = 3
TRAIN_SEED = 0
TEST_SHARE = 0.2
GMM_COMPONENTS = 6
GMM_GATE = {0.05: 0.7, 0.10: 0.8, 0.15: 0.9}
FOREST_TREES = 500
FOREST_MIN_LEAF = 10
FOREST_GATE = 0.85

# --- fixed values: month names accepted by the month normaliser --------------
MONTH_NAMES = {
    1: ["enero", "january", "jan", "ene"],
    2: ["febrero", "february", "feb"],
    3: ["marzo", "march", "mar"],
    4: ["abril", "april", "apr", "abr"],
    5: ["mayo", "may"],
    6: ["junio", "june", "jun"],
    7: ["julio", "july", "jul"],
    8: ["agosto", "august", "aug", "ago"],
    9: ["septiembre", "setiembre", "september", "sep"],
    10: ["octubre", "october", "oct"],
    11: ["noviembre", "november", "nov"],
    12: ["diciembre", "december", "dec", "dic"],
}
