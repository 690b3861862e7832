"""Business wording of features and contributions (L5, L7), as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Readable feature names.
LABELS = {
    "int_rate": "Interest rate",
    "fico_range_low": "FICO score",
    "dti": "Debt-to-income ratio",
    "term_60": "60-month loan term",
    "annual_inc": "Annual income",
    "annual_inc_log": "Annual income",
    "cr_history_months": "Credit history length",
    "loan_to_income": "Loan amount compared with income",
    "installment_to_income": "Monthly payment burden",
    "revol_util": "Revolving credit utilization",
    "bc_util": "Bankcard utilization",
    "bc_util_ratio": "Bankcard utilization",
    "grade_enc": "Loan grade",
    "sub_grade_enc": "Loan sub-grade",
    "purpose_rate_enc": "Loan purpose risk pattern",
    "state_default_rate": "State risk pattern",
    "inq_last_6mths": "Recent credit inquiries",
    "inq_per_acc": "Inquiries per open account",
    "open_acc": "Open credit accounts",
    "mort_acc": "Mortgage account count",
    "verification_status_enc": "Income verification status",
    "home_ownership_enc": "Home ownership",
    "int_rate_x_term": "Interest rate and term combination",
    "fico_dti_score": "Credit score compared with debt burden",
    "acc_open_past_24mths": "Recently opened accounts",
    "total_bc_limit": "Total bankcard credit limit",
    "total_il_high_credit_limit": "Total installment credit limit",
    "emp_title_log_freq": "Employment-title stability signal",
    "mo_sin_rcnt_rev_tl_op": "Months since recent revolving account opened",
}

# How a value is called when it raises or lowers risk.
HINTS = {
    "int_rate": ("high", "low"),
    "dti": ("high", "low"),
    "loan_to_income": ("high", "low"),
    "installment_to_income": ("high", "low"),
    "revol_util": ("high", "low"),
    "bc_util": ("high", "low"),
    "bc_util_ratio": ("high", "low"),
    "inq_last_6mths": ("high", "low"),
    "inq_per_acc": ("high", "low"),
    "fico_range_low": ("relatively low", "strong"),
    "annual_inc": ("lower", "high"),
    "annual_inc_log": ("lower", "high"),
    "cr_history_months": ("shorter", "longer"),
    "term_60": ("60 months", "not 60 months"),
    "fico_dti_score": ("weaker compared with debt burden", "strong compared with debt burden"),
    "acc_open_past_24mths": ("high", "low"),
    "total_bc_limit": ("lower", "higher"),
    "total_il_high_credit_limit": ("lower", "higher"),
    "mo_sin_rcnt_rev_tl_op": ("recent", "less recent"),
}
DEFAULT_HINTS = ("notable", "favorable")

# What a feature means for the business.
MEANINGS = {
    "int_rate": "Higher interest rates usually indicate riskier borrowers and increase predicted default risk.",
    "fico_range_low": "Higher FICO scores indicate stronger credit quality and usually lower predicted default risk.",
    "dti": "Higher debt-to-income ratios indicate more debt burden and usually raise default risk.",
    "term_60": "Longer 60-month loans have a longer repayment horizon and usually increase uncertainty.",
    "annual_inc": "Higher income can improve repayment capacity and reduce default risk.",
    "annual_inc_log": "Higher income can improve repayment capacity and reduce default risk.",
    "cr_history_months": "Longer credit history can indicate more established borrower behavior.",
    "loan_to_income": "A larger loan relative to income can make repayment harder.",
    "installment_to_income": "A higher monthly payment burden can increase default risk.",
    "revol_util": "Higher revolving utilization can indicate credit stress.",
    "grade_enc": "Weaker loan grades indicate higher borrower risk.",
    "sub_grade_enc": "Weaker loan sub-grades indicate higher borrower risk.",
    "purpose_rate_enc": "Some loan purposes historically default at higher rates than others.",
    "state_default_rate": "Borrower geography can capture regional economic or portfolio risk patterns.",
    "int_rate_x_term": "High interest rates combined with longer terms can indicate repayment uncertainty.",
    "acc_open_past_24mths": "Many recently opened accounts can indicate fast credit growth and higher risk.",
    "fico_dti_score": "A stronger credit score relative to debt burden usually lowers default risk.",
    "home_ownership_enc": "Home ownership status can proxy borrower stability and housing obligations.",
    "total_bc_limit": "Higher bankcard limits can indicate available liquidity and established credit access.",
    "total_il_high_credit_limit": "Higher installment credit limits can reflect broader credit access and capacity.",
    "emp_title_log_freq": "Employment-title patterns can capture occupation stability in the historical portfolio.",
    "mo_sin_rcnt_rev_tl_op": "More time since a recent revolving account was opened can indicate less recent credit expansion.",
}


def _text_map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for item in table.items() for x in item])


def feature_label(feature: Column) -> Column:
    return F.coalesce(F.try_element_at(_text_map(LABELS), feature), F.replace(feature, F.lit("_"), F.lit(" ")))


def feature_meaning(feature: Column) -> Column:
    """Business meaning of a feature, a general sentence when none is known."""
    general = F.concat(feature_label(feature), F.lit(" is an important model signal; review its "
                                                     "contribution direction and distribution."))
    return F.coalesce(F.try_element_at(_text_map(MEANINGS), feature), general)


def _fixed(value: Column, digits: int) -> Column:
    return F.replace(F.format_number(value, digits), F.lit(","), F.lit(""))


def _trim_zeros(text: Column) -> Column:
    return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def value_text(value: Column) -> Column:
    """1,839 from 1000 on, 24.5 from 10 on, three significant digits below."""
    v = value.cast("double")
    size = F.abs(v)
    small = F.when(size >= 1, _fixed(v, 2))
    for digits, bound in ((3, 1e-1), (4, 1e-2), (5, 1e-3), (6, 1e-4)):
        small = small.when(size >= bound, _fixed(v, digits))
    scientific = F.regexp_replace(F.format_string("%.2e", v), r"\.?0+e", "e")
    return (F.when(size >= 1000, F.format_number(v, 0)).when(size >= 10, _fixed(v, 1))
            .when(v == 0, F.lit("0")).when(size < 1e-4, scientific).otherwise(_trim_zeros(small)))


def driver_sentence(feature: Column, value: Column, contribution: Column) -> Column:
    """One sentence per contribution."""
    raises = contribution > 0
    high = F.coalesce(F.try_element_at(_text_map({f: h for f, (h, _) in HINTS.items()}), feature),
                      F.lit(DEFAULT_HINTS[0]))
    low = F.coalesce(F.try_element_at(_text_map({f: h for f, (_, h) in HINTS.items()}), feature),
                     F.lit(DEFAULT_HINTS[1]))
    return F.concat(feature_label(feature), F.lit(" is "), F.when(raises, high).otherwise(low), F.lit(" ("),
                    value_text(value), F.lit("), which "),
                    F.when(raises, F.lit("increases")).otherwise(F.lit("reduces")),
                    F.lit(" predicted default risk."))
