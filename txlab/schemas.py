"""Table schemas (Spark DDL) and the fixed values of the transaction model."""

FRAUD_DESCRIPTIONS = "fraud_type string, Description string, Category string"
WRAPPED_TRANSACTION = "description string, amount double, category string"

# The ledger every analytic reads.  `tx_id` is the business key of a row.
LEDGER = (
    "tx_id string, customer_id bigint, tx_date date, category string, "
    "subcategory string, description string, amount double, tx_type string, "
    "fraud_type string, bank_from string, bank_to string"
)


def with_decimal_amounts(schema: str, kind: str = "decimal(18,2)") -> str:
    """A schema whose amounts are decimals; all operators take either type."""
    return schema.replace("double", kind)


# ---------------------------------------------------------------------------
# These must be exactly as they are for right results.
# ---------------------------------------------------------------------------

NO_FRAUD = "none"
EXCLUDED_FRAUD_TYPE = "CEO"
HIGH_INCOME_FRAUD_TYPE = "Romance"

INCOME = "Income"
INTEREST = "Interest"
UTILITIES = "Utilities"
HOUSING = "Housing"
INVESTMENT = "Investment"
CASH_WITHDRAWAL = "Cash Withdrawal"

INCOME_CATEGORIES = ("Income", "Interest")
BILL_CATEGORIES = ("Income", "Utilities", "Housing")
MONTH_START_CATEGORIES = ("Utilities", "Housing")
INCOMING_TEXT = "to Current"
OWN_BANK_DESCRIPTIONS = ("Deposit", "Interest", "from Savings")
REWRITE_CATEGORIES = ("Entertainment", "Healthcare", "Personal care", "Dining Out")

BANKS = ("bank_A", "bank_B", "bank_C", "bank_D", "bank_E")

MONTHLY_CAPS = {
    "Bank Fees": 4,
    "Cash Withdrawal": 3,
    "Charity": 4,
    "Credit Card Payment": 4,
    "Dining Out": 2,
    "Electronics": 2,
    "Entertainment": 6,
    "Groceries": 6,
    "Healthcare": 3,
    "Holiday": 2,
    "Home Improvement": 2,
    "Interest": 3,
    "Investment": 3,
    "Loan Payment": 2,
    "Online Shopping": 5,
    "Personal care": 5,
    "Shopping": 5,
    "Transfers": 8,
    "Transportation": 10,
    "Housing": 1,
    "Income": 1,
    "Utilities": 5,
}

FRAUD_CATEGORIES = {
    "Investment": ["Investment"],
    "Romance": [
        "Personal care",
        "Dining Out",
        "Entertainment",
        "Home Improvement",
        "Holiday",
    ],
    "Purchase": [
        "Online Shopping",
        "Credit Card Payment",
        "Electronics",
        "Healthcare",
    ],
    "Impersonation": ["Loan Payment", "Utilities", "Charity"],
    "InvoiceMandate": ["Transfers"],
    "AdvanceFee": ["Bank Fees"],
}

CATEGORY_SYNONYMS = {
    "Dining out": "Dining Out",
    "Travel": "Holiday",
    "Online shopping": "Online Shopping",
}
