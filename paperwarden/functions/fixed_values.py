"""Fixed values.

Everything in this file is data, not logic: label patterns, thresholds, word
lists and message texts that must have exactly these values for results to be
comparable. Code elsewhere only refers to them.
"""

# --- label patterns, tried in order, first match wins, group 1 is the value ---
FIELD_PATTERNS = {
    "invoice_number": [
        r"invoice\s*(?:number|no\.?|#)[ \t]*[:\-]?[ \t]*([A-Za-z0-9\-\/]+)",
    ],
    "po_number": [
        r"(?:po|p\.o\.)\s*(?:number|no\.?|#)?[ \t]*[:\-]?[ \t]*([A-Za-z0-9\-\/]+)",
    ],
    "invoice_date": [
        r"invoice\s*date\s*[:\-]?\s*([A-Za-z0-9,\/\-\s]+?)(?:\n|$)",
    ],
    "due_date": [
        r"due\s*date\s*[:\-]?\s*([A-Za-z0-9,\/\-\s]+?)(?:\n|$)",
    ],
    "payment_terms": [
        r"payment\s*terms\s*[:\-]?\s*([A-Za-z0-9\s]+?)(?:\n|$)",
    ],
    "subtotal": [
        r"sub\s*-?\s*total\s*[:\-]?\s*\$?\s*([\d,]+\.\d{2})",
    ],
    "tax": [
        r"tax(?:\s*\(\d+%\))?\s*[:\-]?\s*\$?\s*([\d,]+\.\d{2})",
    ],
    "total_amount": [
        r"total\s*amount\s*due\s*[:\-]?\s*\$?\s*([\d,]+\.\d{2})",
        r"(?<!sub)(?<!sub-)\btotal\b(?!\s*\(\d)\s*(?:amount)?\s*(?:due)?\s*[:\-]?\s*\$?\s*([\d,]+\.\d{2})",
    ],
}
PAID_IN_FULL = "paid in full"
BALANCE_DUE_PATTERN = r"balance\s*due"
DRAFT = "draft"
FINAL = "final"

# --- numeric features, in vector order ---
FEATURE_NAMES = [
    "subtotal",
    "tax_ratio",
    "amount_zscore_vs_vendor",
    "days_invoice_to_due",
    "days_terms_deviation",
    "is_weekend_invoice_date",
    "vendor_seen_before",
    "text_length",
    "digit_density",
    "days_since_latest_history",
]
STD_FLOOR = 1e-6

# --- rule thresholds ---
REQUIRED_FIELDS = ["invoice_number", "invoice_date", "total_amount", "vendor_name"]
AMOUNT_TOLERANCE = 0.02
ROUND_SUBTOTAL_MINIMUM = 1000
ZSCORE_THRESHOLD = 3.0
ZSCORE_HIGH = 5
VENDOR_SIMILARITY_LOW = 0.80
VENDOR_SIMILARITY_HIGH = 0.98
NEAR_DUPLICATE_THRESHOLD = 0.92

# --- isolation forest settings ---
FOREST_TREES = 300
FOREST_SEED = 42
FOREST_SUBSAMPLE = 256
EULER_GAMMA = 0.5772156649015329
TOP_FEATURES = 3

# --- risk and reasons ---
SEVERITY_WEIGHT = {"low": 1, "medium": 2, "high": 3}
ML_PERCENTILE_WEIGHTS = [(95, 2), (85, 1)]
NEAR_DUPLICATE_WEIGHT = 2
RISK_LIMITS = [(2, "Low"), (5, "Medium")]
RISK_ABOVE = "High"
ML_CONTRIBUTION_THRESHOLD = 0.05
ML_CONTRIBUTION_HIGH = 0.3

FEATURE_EXPLANATIONS = {
    "subtotal": "The subtotal amount is unusual compared to typical documents.",
    "tax_ratio": "The ratio of tax to subtotal is unusual.",
    "amount_zscore_vs_vendor": "The total amount deviates sharply from this vendor's historical pattern.",
    "days_invoice_to_due": "The gap between invoice date and due date is unusual.",
    "days_terms_deviation": "The payment window doesn't match this vendor's usual payment terms.",
    "is_weekend_invoice_date": "The invoice is dated on a weekend, which is unusual for this document type.",
    "vendor_seen_before": "This vendor has little or no prior transaction history.",
    "text_length": "The overall length/structure of the document is atypical.",
    "digit_density": "The proportion of numeric content in the document is atypical.",
    "days_since_latest_history": "The invoice date falls far outside the range of historical records on file.",
}

# Message texts; {names} are filled from columns of the same name.
MESSAGES = {
    "missing_fields": "Missing required field(s): {missing}.",
    "invoice_date_format": "Invoice date field ('{invoice_date_raw}') could not be parsed as a valid date "
                           "— likely an OCR error or malformed input.",
    "due_date_format": "Due date field ('{due_date_raw}') could not be parsed as a valid date.",
    "due_before_invoice": "Due date ({due}) is earlier than the invoice date ({invoiced}) "
                          "— dates are logically inconsistent.",
    "future_date": "Invoice is dated {invoiced}, which is in the future relative to today ({today}).",
    "arithmetic": "Printed total (${total}) does not equal subtotal + tax (${subtotal} + ${tax} = ${expected}); "
                  "difference of ${difference}.",
    "round_numbers": "Subtotal (${subtotal}) and total are suspiciously round numbers; "
                     "genuine itemized invoices rarely land on exact round figures.",
    "amount_outlier": "Total amount is {z} standard deviations {direction} than this vendor's historical average "
                      "— a significant deviation from past invoices.",
    "duplicate": "Invoice number '{invoice_number}' already exists in historical records "
                 "— possible duplicate submission or resubmitted invoice.",
    "vendor_lookalike": "Vendor name '{vendor_name}' is {percent}% similar to known vendor '{closest_vendor}' "
                        "but does not match exactly — possible vendor impersonation or a typo introduced "
                        "during data entry/OCR.",
    "paid_and_due": "Document states the invoice is 'PAID IN FULL' but also lists a nonzero balance due (${total}) "
                    "— these statements directly contradict each other.",
    "draft_and_final": "Document contains both 'draft' and 'final' language, which is contradictory "
                       "for a single document version.",
    "pattern_deviation": "{explanation} (observed value: {value}, contribution to anomaly score: {contribution})",
    "near_duplicate": "Content is {percent}% similar to another document in this batch ('{other}') "
                      "— possible duplicate submission.",
    "near_duplicate_count": "It is the closest of {count} such documents.",
    "clean": "No inconsistencies detected; document is consistent with historical patterns.",
}

# English stop words (the plain words of Spark ML's default English list).
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself
it its itself they them their theirs themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or because as until while of at by for with
about against between into through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some such no nor not only
own same so than too very s t can will just don should now cannot could ought would
""".split()

# Word characters and minimum length of a similarity token.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Month names as they may be spelled in a date, with their number.
MONTHS = {
    "jan": 1, "january": 1, "feb": 2, "february": 2, "mar": 3, "march": 3, "apr": 4, "april": 4, "may": 5,
    "jun": 6, "june": 6, "jul": 7, "july": 7, "aug": 8, "august": 8, "sep": 9, "sept": 9, "september": 9,
    "oct": 10, "october": 10, "nov": 11, "november": 11, "dec": 12, "december": 12,
}
