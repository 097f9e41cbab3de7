"""Every constant that decides what a result is.

These are conventions of the data (patterns, formats, codes, limits), stated
plainly in one place. Changing one changes results.
"""

# Default text for a missing name, list or year.
UNKNOWN = "Unknown"

# Leading price symbol -> ISO 4217 code.
CURRENCY_CODES = {
    "R$": "BRL",
    "$": "USD",
    "€": "EUR",
    "£": "GBP",
    "₹": "INR",
    "₣": "CHF",
    "A$": "AUD",
}

# Price text.
SYMBOL_PATTERN = r"^([^\d\s]+)"
AMOUNT_PATTERN = r"[\d.]+"
PLAIN_PRICE_PATTERN = r"^\d+(\.\d{1,2})?$"

# Release date text, with the formats tried for each shape.
SLASH_DATE_PATTERN = r"^\d{1,2}/\d{1,2}/\d{4}$"
SLASH_DATE_FORMATS = ("M/d/yyyy", "d/M/yyyy")
MONTH_FIRST_PATTERN = r"^\w{3} \d{1,2}, \d{4}$"
MONTH_FIRST_FORMAT = "MMM d, yyyy"
DAY_FIRST_PATTERN = r"^\d{1,2} \w{3}, \d{4}$"
DAY_FIRST_FORMAT = "d MMM, yyyy"
QUARTER_PATTERN = r"Q[1-4] \d{4}"
BARE_YEAR_PATTERN = r"^\d{4}$"
YEAR_DIGITS_PATTERN = r"(\d{4})"

# Price categories.
FREE = "Free"
PAID = "Paid"

# Quartile fractions and the width of the outlier fence.
QUARTILE_FRACTIONS = (0.25, 0.75)
FENCE_WIDTH = 1.5

# Ingest limits.
DAILY_CALL_LIMIT = 100_000
BATCH_SIZE = 100

# Share of rows a model learns from.
TRAIN_SHARE = 0.8
