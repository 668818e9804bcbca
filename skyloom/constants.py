"""Fixed values that decide results: units, thresholds, colour stops, labels.

They are stated once, in natural order, and every operator reads them from here.
"""

# --- Fixed values: units and physics -------------------------------------------------
KELVIN_OFFSET = 273.15
PASCAL_PER_HPA = 100.0
MAGNUS_A = 17.625
MAGNUS_B = 243.04
MM_PER_METRE = 1000.0
TEMPERATURE_BIAS = 2.5

# --- Fixed values: column names of the gridded source --------------------------------
GRID_NAMES = {
    "t2m": "temp_k",
    "sp": "pressure_pa",
    "u10": "wind_u",
    "v10": "wind_v",
    "d2m": "dewpoint_k",
    "tp": "precip_m",
    "tcc": "cloud_cover",
}

# --- Fixed values: event thresholds --------------------------------------------------
HEAT_MIN_C = 38.0
COLD_MAX_C = 10.0
WIND_MIN_MS = 8.0
RAIN_MIN_MM = 1.0
EVENT_FLAGS = ("event_heat", "event_cold", "event_wind", "event_rain", "event_extreme")
RULE_HEAT_C = 38.0
RULE_COLD_C = 8.0
RULE_WIND_READING_MS = 10.0
RULE_WIND_HISTORY_MS = 8.0
RULE_CLOUD_PCT = 70.0
RULE_HUMIDITY_PCT = 80.0

# --- Fixed values: feature engineering -----------------------------------------------
ROLLED = ("temp_c_max", "pressure_hpa_mean", "wind_speed_max", "humidity_mean")
ROLL_SIZES = (3, 7)
LAGGED = ("temp_c_max", "precip_mm_sum", "wind_speed_max")
LAG_STEPS = (1, 2, 3)
YEAR_DAYS_FOREST = 365.0
YEAR_DAYS_SEQUENCE = 365.25
PRESSURE_NORM_MEAN = 1013.0
PRESSURE_NORM_STD = 5.0
DAILY_MEASURES = (
    "temp_c_max", "temp_c_min", "temp_c_mean", "pressure_hpa_mean", "pressure_hpa_min",
    "wind_speed_max", "wind_speed_mean", "humidity_max", "humidity_mean",
    "precip_mm_sum", "cloud_cover_mean",
)
FOREST_FEATURES = DAILY_MEASURES + (
    "temp_c_max_ma3", "temp_c_max_ma7", "pressure_hpa_mean_ma3", "pressure_hpa_mean_ma7",
    "wind_speed_max_ma3", "wind_speed_max_ma7", "humidity_mean_ma3", "humidity_mean_ma7",
    "temp_c_max_lag1", "precip_mm_sum_lag1", "wind_speed_max_lag1",
    "temp_c_max_lag2", "precip_mm_sum_lag2", "wind_speed_max_lag2",
    "temp_c_max_lag3", "precip_mm_sum_lag3", "wind_speed_max_lag3",
    "temp_grad", "pressure_grad", "sin_doy", "cos_doy",
    "temp_range", "heat_intensity", "pressure_deficit", "humidity_range",
    "wind_spike", "dry_index", "pressure_norm",
)
SEQUENCE_FEATURES = (
    "temp_c", "dewpoint_c", "pressure_hpa", "wind_u", "wind_v", "precip_mm", "cloud_cover",
    "season_sin", "season_cos",
    "temp_ma3", "temp_ma7", "pressure_ma3", "pressure_grad", "wind_speed", "wind_ma3",
    "precip_ma3", "dry_index",
)

# --- Fixed values: history and readiness ---------------------------------------------
READINGS_PER_DAY = 3
MIN_DAYS_ROLLING = 7
MIN_DAYS_FULL = 14
LOCAL_ZONE = "Europe/Madrid"

# --- Fixed values: model configuration -----------------------------------------------
FOREST_TREES = 400
FOREST_DEPTH = 10
FOREST_MIN_LEAF = 4
SEED = 42
FOLDS = 5
SEQUENCE_LENGTH = 14
TRAIN_FRACTION = 0.70
VALIDATION_FRACTION = 0.10
SPLIT_GAP = 14
FOCAL_ALPHA = 0.80
FOCAL_GAMMA = 1.5
PATIENCE = 25
EPOCHS = 150
WEIGHT_DECAY = 1e-4
HIDDEN_UNITS = (128, 64)
ATTRIBUTION_ROWS = 200
TOP_FEATURES = 10
# thresholds 0.05, 0.06, ..., 0.89
THRESHOLDS = tuple((5 + i) / 100.0 for i in range(85))
DEFAULT_THRESHOLD = 0.5

# --- Fixed values: normalisation ranges (low, high) ----------------------------------
RANGES = {
    "temperature": (0.0, 46.0),
    "pressure": (990.0, 1030.0),
    "pm2_5": (0.0, 75.0),
    "humidity": (10.0, 95.0),
    "wind_speed": (0.0, 20.0),
    "clouds": (0.0, 100.0),
    "rain_1h": (0.0, 10.0),
}

# --- Fixed values: colour ramp, five stops at 0, 1/4, 1/2, 3/4, 1 --------------------
RAMP = ((28, 58, 110), (45, 85, 140), (90, 70, 50), (160, 90, 30), (190, 110, 20))

# --- Fixed values: encoding formulas, (base, slope) of a normalised value ------------
DENSITY = (0.3, 0.7)
LAYERS = (6.0, 14.0)
FRAGMENTS = (2.0, 40.0)
OPACITY = (160.0, 80.0)
VEIL = 80.0
STROKE_LENGTH = (20.0, 180.0)
STROKE_WIDTH = 8.0
DARKNESS = (15.0, 35.0)
CODOMINANT_BOOST = 1.4
# share of the dominant tint in hue, saturation and lightness
TINT_MIX = 0.35
TINT_SATURATION = 0.3
TINT_LIGHTNESS = 0.2
# wind strokes: hue, then (base, slope, bound) of lightness and (base, slope) of saturation
WIND_HUE = 220
WIND_GROUND_LIGHT = 65.0
WIND_ON_LIGHT = ((42.0, 28.0, 18.0), (70.0, 25.0))
WIND_ON_DARK = ((62.0, 28.0, 78.0), (45.0, 40.0))
# global modifiers by dominant variable
WIND_ANGLE = 0.7
TEMPERATURE_SCALE = (0.85, 0.35)
WIND_SCALE = (0.9, 0.2)
HUMIDITY_BLUR = 4.0
CLOUD_SQUISH = 0.3
WIND_LIGHT_REACH = 0.4
RISK_EDGES = 22.0
RISK_FRACTURES = 14.0
RISK_DEPTH = 90.0

# --- Fixed values: bounds of the behaviour bands -------------------------------------
HUMIDITY_BANDS = (0.35, 0.65)
HUMIDITY_HALO = (0.5, 0.55)
WIND_BANDS = (0.2, 0.5)
WIND_BANDS_DOMINANT = (0.3, 0.6)
PRESSURE_BANDS = (0.4, 0.65)
PRESSURE_DOMINANT = 0.5
CLOUD_BANDS = (0.2, 0.55)
PM_BANDS = (0.15, 0.4)

# --- Fixed values: guesses of a day from one reading ---------------------------------
POINT_TEMP_ABOVE = 3.0
POINT_TEMP_BELOW = 5.0
POINT_WIND_GUST = 1.5
POINT_HUMIDITY_ABOVE = 10.0
POINT_PRESSURE_BELOW = 2.0
POINT_RAIN_MM = 5.0

# --- Fixed values: status texts ------------------------------------------------------
STATUS_EMPTY = "sin días aún ({today}/{expected} lecturas hoy)"
STATUS_ROLLING = "{days} días ({today}/{expected} lecturas hoy) — faltan {missing} para rolling real"
STATUS_LAGS = "{days} días ({today}/{expected} lecturas hoy) — faltan {missing} para lags completos"
STATUS_COMPLETE = "{days} días ({today}/{expected} lecturas hoy) — predicción completa ✓"

# --- Fixed values: labels ------------------------------------------------------------
COMPASS = ("N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
           "S", "SSO", "SO", "OSO", "O", "ONO", "NO", "NNO")
WEATHER_GROUPS = (
    (200, 300, "storm"), (300, 400, "drizzle"), (500, 600, "rain"),
    (600, 700, "snow"), (700, 800, "atmosphere"),
)
VARIABLES = ("temperatura", "viento", "humedad", "presion", "nubes", "pm25")
DRAW_ORDER = ("presion", "nubes", "viento", "humedad", "pm25", "temperatura")
DOMINANT_LABELS = {
    "temperatura": "TEMPERATURA DOMINA", "viento": "VIENTO DOMINA",
    "humedad": "HUMEDAD DOMINA", "presion": "PRESIÓN DOMINA",
    "nubes": "NUBES DOMINAN", "pm25": "CONTAMINACIÓN DOMINA",
}
DOMINANT_COLOURS = {
    "temperatura": "#e06020", "viento": "#3a80c0", "humedad": "#3a9060",
    "presion": "#c09040", "nubes": "#7090a0", "pm25": "#9060a0",
}
EVENT_NAMES = {"heat": "CALOR EXTREMO", "cold": "FRÍO INTENSO",
               "rain": "LLUVIA INTENSA", "wind": "VIENTO FUERTE"}
EVENT_NAME_DEFAULT = "EVENTO GENÉRICO"
EVENT_COLOURS = {"heat": "#d05020", "cold": "#3060b0", "rain": "#3070a0", "wind": "#309060"}
EVENT_COLOUR_DEFAULT = "#a08030"
WEATHER_NAMES = {
    "storm": "tormenta eléctrica", "drizzle": "llovizna", "rain": "lluvia",
    "snow": "nieve", "atmosphere": "niebla / calima", "clear": "despejado", "clouds": "nublado",
}
FRACTURE_SHAPES = {
    "temperatura": "arcos incompletos", "viento": "trazos curvos fragmentados",
    "humedad": "óvalos con contorno discontinuo", "presion": "rectángulos muy delgados",
    "nubes": "rombos pequeños descentrados",
}
FRACTURE_SHAPE_DEFAULT = "puntos-fractura dispersos"
DECISION_LABELS = ("Normal ✓", "EXTREMO ⚠")

# --- Fixed values: colour bands, (upper bound, hue, saturation, lightness) -----------
TEMPERATURE_BANDS = ((5, 225, 70, 35), (12, 200, 65, 38), (18, 145, 60, 42),
                     (24, 55, 75, 52), (30, 28, 80, 52))
TEMPERATURE_BAND_LAST = (5, 78, 48)
HOUR_BANDS = ((5, 220, 18, 12), (8, 28, 30, 72), (12, 42, 18, 88),
              (16, 200, 14, 90), (20, 25, 28, 78))
HOUR_BAND_LAST = (230, 20, 18)
# light position as fractions of width and height, (upper hour bound, x, y)
LIGHT_BANDS = ((6, 0.5, 1.1), (10, 0.1, 0.8), (13, 0.55, -0.1), (17, 0.9, 0.15), (20, 0.85, 0.6))
LIGHT_BAND_LAST = (0.4, 1.15)
DOMINANT_TINTS = {
    "temperatura": (28, 70, 52), "viento": (215, 60, 48), "humedad": (148, 55, 44),
    "presion": (40, 50, 48), "nubes": (210, 22, 60), "pm25": (285, 45, 40),
}
EVENT_HSL = {"heat": (8, 85, 50), "cold": (215, 78, 42), "rain": (200, 72, 40), "wind": (155, 62, 38)}
EVENT_HSL_DEFAULT = (45, 70, 46)
# per-variable colour: hue, saturation base and slope, lightness base and slope
VARIABLE_COLOURS = {
    "humidity": (150, 35, 50, 55, 25), "pressure": (38, 38, 38, 58, 22),
    "cloud": (210, 18, 22, 65, 30), "pm": (285, 30, 50, 52, 28), "rain": (210, 55, 30, 45, 15),
}

# --- Fixed values: rain and risk bands -----------------------------------------------
RAIN_BANDS = ((0.5, "drizzle", "·"), (2.5, "light", "⁚"), (7.5, "moderate", "⁘"))
RAIN_BAND_LAST = ("heavy", "⁙")
RAIN_BAND_NONE = ("none", "○")
RISK_ALARM = 0.06
RISK_LEVELS = ((0.06, "SIN PRESENCIA"), (0.20, "LATENTE"), (0.25, "TENSIÓN INICIAL"),
               (0.50, "INTRUSIÓN LEVE"), (0.75, "INTRUSIÓN ALTA"), (0.85, "ALERTA"))
RISK_LEVEL_LAST = "CRÍTICO"
RISK_LAYERS = (("tint", 0.20), ("fracture", 0.25), ("inner_edge", 0.60),
               ("border", 0.75), ("focal", 0.85))

# --- Fixed values: reading defaults --------------------------------------------------
POINT_DEFAULTS = {"temperature": 20.0, "pressure": 1013.0, "wind_speed": 2.0,
                  "humidity": 50.0, "clouds": 30.0}
DEFAULT_VISIBILITY = 10000
DEFAULT_WEATHER_ID = 800
DEFAULT_CLOUDS = 15
DEFAULT_SEED = 99991
DEFAULT_CITY = "Seville"
SAMPLE_READING = {
    "temperature": 28.4, "temp_min": 22.0, "temp_max": 36.0, "humidity": 38, "pressure": 1012,
    "wind_speed": 4.5, "wind_deg": 210, "clouds": 15, "visibility": 10000, "weather_id": 800,
    "city": "Sevilla", "pm2_5": 12.3, "no2": 22.1, "o3": 88.4,
}
