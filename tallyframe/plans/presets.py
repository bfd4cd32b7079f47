"""Rule sets: the customer demo view, and the credit-score table."""

from __future__ import annotations

from tallyframe.operators.cleaning import CleanRules
from tallyframe.operators.features import FeatureSpec, ratio_sql
from tallyframe.operators.quality import Contract
from tallyframe.plans.views import DIRTY_COLUMNS, LABEL_CODES

DEMO_CONTRACT = Contract(
    columns=DIRTY_COLUMNS, may_be_absent=("id", "name"), label="label",
    label_domain=tuple(LABEL_CODES),
    ranges={"age_txt": (18, 100), "cards": (0, 20), "loans_txt": (0, 10), "salary": (0, 50000)},
    categories=("occupation", "mix"),
)

DEMO_RULES = CleanRules(
    drop=("id", "name"),
    digits=("age_txt",),
    strip={"income_txt": "_", "loans_txt": "_"},
    number_sentinels={"limit_txt": "_", "balance_txt": "__-333333333333333333333333333__"},
    durations=("history_txt",),
    text_sentinels={"occupation": "_______", "mix": "_"},
    valid_ranges={"age_txt": (18, 100)},
    bounds={"loans_txt": (0, 10), "cards": (0, 20)},
    quantile_caps={"income_txt": 0.99},
    label="label", label_codes=LABEL_CODES,
)

# Fixed values of the credit-score contract.
CREDIT_COLUMNS = (
    "ID", "Customer_ID", "Month", "Name", "Age", "SSN", "Occupation", "Annual_Income",
    "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate",
    "Num_of_Loan", "Type_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment",
    "Changed_Credit_Limit", "Num_Credit_Inquiries", "Credit_Mix", "Outstanding_Debt",
    "Credit_Utilization_Ratio", "Credit_History_Age", "Payment_of_Min_Amount",
    "Total_EMI_per_month", "Amount_invested_monthly", "Payment_Behaviour", "Monthly_Balance",
    "Credit_Score",
)
CREDIT_IDENTIFIERS = ("ID", "Customer_ID", "Name", "SSN", "Month")
CREDIT_DOUBLES = ("Monthly_Inhand_Salary", "Num_Credit_Inquiries", "Credit_Utilization_Ratio",
                  "Total_EMI_per_month")
CREDIT_LONGS = ("Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Delay_from_due_date")

# Fixed values of the credit-score contract.
CREDIT_CONTRACT = Contract(
    columns=CREDIT_COLUMNS, may_be_absent=CREDIT_IDENTIFIERS, label="Credit_Score",
    label_domain=("Poor", "Standard", "Good"),
    ranges={"Age": (18, 100), "Interest_Rate": (1, 100), "Num_Bank_Accounts": (0, 20),
            "Num_Credit_Card": (0, 20), "Num_Credit_Inquiries": (0, 20), "Num_of_Loan": (0, 10),
            "Delay_from_due_date": (0, 999)},
    categories=("Occupation", "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour"),
)

# Fixed values of the credit-score contract.
CREDIT_RULES = CleanRules(
    drop=CREDIT_IDENTIFIERS,
    digits=("Age",),
    strip={"Annual_Income": "_", "Num_of_Loan": "_", "Num_of_Delayed_Payment": "_",
           "Outstanding_Debt": "_"},
    number_sentinels={"Changed_Credit_Limit": "_", "Amount_invested_monthly": "__10000__",
                      "Monthly_Balance": "__-333333333333333333333333333__"},
    durations=("Credit_History_Age",),
    text_sentinels={"Occupation": "_______", "Credit_Mix": "_", "Payment_Behaviour": "!@9#%8",
                    "Payment_of_Min_Amount": "NM"},
    valid_ranges={"Age": (18, 100)},
    bounds={"Num_Bank_Accounts": (0, 20), "Num_Credit_Card": (0, 20), "Interest_Rate": (1, 100),
            "Num_Credit_Inquiries": (0, 20), "Num_of_Loan": (0, 10),
            "Delay_from_due_date": (0, None), "Num_of_Delayed_Payment": (0, None)},
    quantile_caps={"Annual_Income": 0.99},
    label="Credit_Score", label_codes={"Poor": 0, "Standard": 1, "Good": 2},
)

DEMO_SPEC = FeatureSpec(
    rules=DEMO_RULES,
    numeric=("age_txt", "income_txt", "loans_txt", "limit_txt", "balance_txt", "history_txt",
             "salary", "cards"),
    categorical=("occupation", "mix"),
    ordinal={"mix": {"Bad": 0, "Standard": 1, "Good": 2}},
    one_hot=("occupation",),
    derived={
        "debt_to_income": ratio_sql("balance_txt", "income_txt / 12"),
        "loan_to_income": ratio_sql("loans_txt", "income_txt / 10000"),
        "limit_to_salary": ratio_sql("limit_txt", "salary"),
        "balance_to_salary": ratio_sql("balance_txt", "salary"),
        "limit_per_card": ratio_sql("limit_txt", "cards"),
        "history_per_loan": ratio_sql("history_txt", "loans_txt"),
        "cards_per_loan_year": ratio_sql("cards", "loans_txt * 12"),
        "loans_per_card": ratio_sql("loans_txt", "cards"),
        "history_years": "bround(history_txt / 12, 1)",
    },
    label="label",
)

# Fixed values of the credit-score contract.
CREDIT_SPEC = FeatureSpec(
    rules=CREDIT_RULES,
    numeric=("Age", "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts",
             "Num_Credit_Card", "Interest_Rate", "Num_of_Loan", "Delay_from_due_date",
             "Num_of_Delayed_Payment", "Changed_Credit_Limit", "Num_Credit_Inquiries",
             "Outstanding_Debt", "Credit_Utilization_Ratio", "Credit_History_Age",
             "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance"),
    categorical=("Occupation", "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour"),
    ordinal={"Credit_Mix": {"Bad": 0, "Standard": 1, "Good": 2},
             "Payment_of_Min_Amount": {"No": 0, "Yes": 1}},
    one_hot=("Occupation", "Payment_Behaviour"),
    drop=("Type_of_Loan",),
    derived={
        "debt_to_income": ratio_sql("Outstanding_Debt", "Annual_Income / 12"),
        "loan_to_income": ratio_sql("Num_of_Loan", "Annual_Income / 10000"),
        "emi_to_income": ratio_sql("Total_EMI_per_month", "Monthly_Inhand_Salary"),
        "savings_rate": ratio_sql("Amount_invested_monthly", "Monthly_Inhand_Salary"),
        "balance_to_income": ratio_sql("Monthly_Balance", "Monthly_Inhand_Salary"),
        "credit_card_util_proxy": ratio_sql("Outstanding_Debt", "Num_Credit_Card"),
        "delay_per_loan": ratio_sql("Delay_from_due_date", "Num_of_Loan"),
        "delinquency_rate": ratio_sql("Num_of_Delayed_Payment", "Num_of_Loan * 12"),
        "inquiry_per_account": ratio_sql("Num_Credit_Inquiries", "Num_Bank_Accounts"),
        "credit_age_years": "bround(Credit_History_Age / 12, 1)",
    },
    label="Credit_Score",
)
