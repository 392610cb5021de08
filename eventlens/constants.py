"""Values that must equal the reference behaviour for equal results.

Fixed values (kept as plain text, in natural order):
"""

# --- fixed values -----------------------------------------------------------
# Raw events CSV header, in file order, and the normalised column each becomes.
RAW_EVENT_COLUMNS = [
    ("Дата и время события", "event_ts"),
    ("Экран", "screen"),
    ("Функционал", "feature"),
    ("Действие", "action"),
    ("Идентификатор устройства", "device_id"),
    ("Номер сессии в рамках устройства", "device_session_id"),
    ("Производитель устройства", "device_vendor"),
    ("Модель устройства", "device_model"),
    ("Тип устройства", "device_type"),
    ("ОС", "os"),
]

# Raw socio-demographic CSV header and the normalised column each becomes.
RAW_SOCDEM_COLUMNS = [
    ("number", "device_id"),
    ("age_back", "age"),
    ("gender", "gender"),
]

# Feature keywords (lower-case substrings of the feature name).
DEFAULT_KEYWORDS = {"pay": "оплат", "ticket": "заявк", "meter": "показан"}

# Default socdem file name and the events file name patterns.
DEFAULT_SOCDEM_FILE = "словарь_соцдема.csv"
EVENT_FILE_GLOB = "*.{csv,scv}"
EVENTS_ENV = "EVENTS_CSV_PATH"
SOCDEM_ENV = "SOCDEM_CSV_PATH"

# Label written for merged rare classes.
OTHER_CLASS = "__OTHER__"

# Unicode word of two or more characters (the token rule of the text model).
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Unicode whitespace as Python's str.isspace() defines it (a regex class that
# Java and RE2 both read the same way).
WHITESPACE_CLASS = r"[\t\n\x0b\x0c\r\x1c-\x1f \x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

# Cluster description phrases.
PHRASE_HIGH_ACTIVITY = "высокая активность"
PHRASE_LOW_ACTIVITY = "низкая активность"
PHRASE_PAY = "оплата"
PHRASE_TICKET = "заявки"
PHRASE_METER = "показания"
PHRASE_WIDE = "широкое использование функций"
PHRASE_NARROW = "узкий сценарий"

# Model defaults.
FEATURE_DAYS = 28
LABEL_DAYS = 14
TEST_SIZE = 0.2
SEED = 42
K_MIN = 3
K_MAX = 8
N_INIT = 10
SILHOUETTE_SAMPLE = 5000
MAX_ITER = 2000
TOL = 1e-4  # optimiser stopping tolerance of the reference's logistic fits
MAX_FEATURES = 200_000
MIN_DF = 2
NGRAM_MAX = 2
MIN_CLASS_COUNT = 2
# ---------------------------------------------------------------------------

DEVICE_FEATURE_COLUMNS = [
    "events_cnt",
    "active_days",
    "sessions_cnt",
    "screens_cnt",
    "features_cnt",
    "pay_events",
    "ticket_events",
    "meter_events",
]
