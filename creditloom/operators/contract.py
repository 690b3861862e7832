"""The application contract: required fields, ranges, closed sets, defaults (F1, F2)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.session import materialise


@dataclass(frozen=True)
class Field:
    name: str
    text: bool = False
    default: float | str | None = None       # None means required
    above: float | None = None
    least: float | None = None
    most: float | None = None
    among: tuple = ()
    pattern: str | None = None

    @property
    def required(self) -> bool:
        return self.default is None

    def value(self) -> Column:
        """The field's column, NaN taken as missing."""
        column = F.col(self.name)
        return column if self.text else F.when(~F.isnan(column), column)

    def rules(self) -> list[tuple[Column, str]]:
        """(is broken, message) pairs; a missing optional field breaks nothing, and NaN is missing."""
        value = self.value()
        out = []
        if self.required:
            out.append((value.isNull(), "required"))
        if self.above is not None:
            out.append((value <= self.above, f"must be > {self.above:g}"))
        if self.least is not None:
            out.append((value < self.least, f"must be >= {self.least:g}"))
        if self.most is not None:
            out.append((value > self.most, f"must be <= {self.most:g}"))
        if self.among:
            out.append((~value.isin(*self.among), f"must be one of {', '.join(map(str, self.among))}"))
        if self.pattern:
            out.append((~value.rlike(self.pattern), f"must match {self.pattern}"))
        return out


# Optional bureau amounts and counts, not negative, 0 when absent.
BUREAU_FIELDS = (
    "collections_12_mths_ex_med", "acc_now_delinq", "tot_coll_amt", "tot_cur_bal", "open_acc_6m",
    "open_act_il", "open_il_12m", "open_il_24m", "mths_since_rcnt_il", "total_bal_il", "il_util",
    "open_rv_12m", "open_rv_24m", "max_bal_bc", "all_util", "total_rev_hi_lim", "inq_fi",
    "total_cu_tl", "inq_last_12m", "acc_open_past_24mths", "avg_cur_bal", "bc_open_to_buy",
    "bc_util", "chargeoff_within_12_mths", "delinq_amnt", "mo_sin_old_il_acct",
    "mo_sin_old_rev_tl_op", "mo_sin_rcnt_rev_tl_op", "mo_sin_rcnt_tl", "mort_acc",
    "mths_since_recent_bc", "mths_since_recent_inq", "num_accts_ever_120_pd", "num_actv_bc_tl",
    "num_actv_rev_tl", "num_bc_sats", "num_bc_tl", "num_il_tl", "num_op_rev_tl", "num_rev_accts",
    "num_rev_tl_bal_gt_0", "num_sats", "num_tl_120dpd_2m", "num_tl_30dpd", "num_tl_90g_dpd_24m",
    "num_tl_op_past_12m", "pub_rec_bankruptcies", "tax_liens", "tot_hi_cred_lim",
    "total_bal_ex_mort", "total_bc_limit", "total_il_high_credit_limit")

# The contract's fields with their rules and defaults.
CONTRACT = (
    Field("loan_amnt", above=0), Field("term", among=(36, 60)), Field("int_rate", above=0),
    Field("installment", above=0), Field("grade", text=True, among=tuple("ABCDEFG")),
    Field("sub_grade", text=True, pattern="^[A-G][1-5]$"),
    Field("emp_length", default=0.0, least=0, most=10), Field("home_ownership", text=True),
    Field("annual_inc", above=0), Field("verification_status", text=True),
    Field("purpose", text=True), Field("addr_state", text=True), Field("emp_title", text=True, default=""),
    Field("dti", least=0), Field("fico_range_low"),
    *[Field(n, default=0.0, least=0) for n in ("delinq_2yrs", "inq_last_6mths", "open_acc", "pub_rec", "revol_bal")],
    Field("revol_util", default=0.0, least=0, most=100), Field("total_acc", default=0.0, least=0),
    Field("initial_list_status", text=True, default="w"),
    Field("application_type", text=True, default="Individual"),
    Field("disbursement_method", text=True, default="Cash"), Field("cr_history_months", default=0.0, least=0),
    *[Field(n, default=0.0, least=0) for n in BUREAU_FIELDS],
    Field("pct_tl_nvr_dlq", default=100.0, least=0, most=100),
    Field("percent_bc_gt_75", default=0.0, least=0, most=100))


def application_schema(key: str = "loan_id") -> T.StructType:
    return T.StructType([T.StructField(key, T.LongType()), *[
        T.StructField(f.name, T.StringType() if f.text else T.DoubleType()) for f in CONTRACT]])


def add_violations(df: DataFrame) -> DataFrame:
    """Add ``violations``: every broken rule as 'field: message' (F1)."""
    have = set(df.columns)
    broken = []
    for field in CONTRACT:
        if field.name in have:
            broken += [F.when(bad, F.lit(f"{field.name}: {text}")) for bad, text in field.rules()]
        elif field.required:
            broken.append(F.lit(f"{field.name}: required"))
    return df.withColumn("violations", F.array_compact(F.array(*broken)))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid applications, and rejected ones with their reasons (F1).

    Judged rows are written once, so that the source is read, and every rule applied, once for both tables.
    """
    judged = materialise(add_violations(df), "judged")
    fine = F.size("violations") == 0
    return judged.filter(fine).drop("violations"), judged.filter(~fine)


def fill_defaults(df: DataFrame) -> DataFrame:
    """Optional fields that are absent or empty get the contract default (F2)."""
    have = set(df.columns)
    new = {}
    for field in CONTRACT:
        if not field.required:
            default = F.lit(field.default)
            new[field.name] = F.coalesce(field.value(), default) if field.name in have else default
    return df.withColumns(new)
