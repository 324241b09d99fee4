"""Fixed values.

These numbers and tokens must equal the source workloads' for the results
to mean the same thing; they are stated here once, in plain form, and the
plans import them.  (Operator defaults elsewhere repeat some of them as
default arguments, e.g. ``k=3.0`` for the IQR fences.)
"""

# sensor telemetry: closed valid ranges, and the status rule T >= 28.0 or P >= 1.4
SENSOR_LIMITS = {"temperature": (0.0, 100.0), "pressure": (0.0, 5.0)}
STATUS_MIN_TEMPERATURE = 28.0
STATUS_MIN_PRESSURE = 1.4
ROUND_DIGITS = 2

# injection cycles: passed-part token, the "no reason" token, barrel limits
PASS_TOKEN = "Y"
NO_REASON_TOKEN = "None"
BARREL_LIMITS = (50.0, 400.0)

# wide sensor table: sparse share (strict >), fence width, valid labels, grades
SPARSE_SHARE = 0.5
IQR_K = 3.0
LABEL_DOMAIN = (-1, 1)
GRADES = [(99.0, "S"), (95.0, "A"), (80.0, "B")]  # else "C"

# features and evaluation
TEST_PERCENT = 20
SEED = 42
DECISION_THRESHOLD = 0.5
F1_EPSILON = 1e-8
SMOTE_K = 5
WINDOW_LENGTH, WINDOW_GAP, WINDOW_HORIZON = 20, 20, 20
GAUSSIAN_TAPS = 15

# telemetry history
HISTORY_VALUES = 5
LOCAL_TIME_ZONE = "Asia/Seoul"
