"""Fixed values of the original application.

These must equal the original's for the same results; everywhere in the
library they are defaults only and can be overridden by parameters.
"""

# Input log layout.
ID_COLUMN = "ID"
DATE_COLUMN = "DATE"
STATUS_COLUMN = "Status"
LABEL_COLUMNS = ("Assigned Group",)
MIXED_COLUMNS = ("Urgency", "Impact", "Priority")
NUMERIC_COLUMNS = ("Priority Weight",)
NOT_RELEVANT_COLUMNS = ("Urgency", "Impact", "Priority")

# Closed statuses (two spaces before the parenthesis) and the missing-value token.
CLOSED_STATUSES = ("Resolved  (4)", "Cancelled  (6)")
NULL_TOKENS = ("t9jZkpJT4Nc=",)

# Column selection thresholds.
MIN_CONSTANCY = 0.8
MAX_NULLS = 0.5

# First run of digits in a mixed text/number field.
DIGITS_PATTERN = "[0-9]+"

# Models.
TRAIN_FRACTION = 0.7
FOREST_TREES = 5
HIDDEN_UNITS = 50

# Report columns (groups per entity; attempts needed).
GROUPS_COLUMN = "n_cambios"
ATTEMPTS_COLUMN = "Groups_assigned"

# Output folders.
MODEL_TABLE = "dataML"
GROUPS_REPORT = "n_groups"
MODEL_REPORT_PREFIX = "n_groups_"
MODEL_SHORT_NAMES = {"logistic_regression": "LR", "decision_tree": "DT", "random_forest": "RF",
                     "naive_bayes": "NB", "multilayer_perceptron": "MP"}
