"""A raw loan table derived from order, line-item, customer and nation tables.

One order is one loan, its line items are the credit lines, its customer is the
borrower. Only the tables behind the requested columns are joined. No join is
hinted: the parquet sizes let the planner broadcast customer and nation while
they are small and shuffle them, with adaptive skew splitting, when they are not.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.sources.tables import spread

TRAIN_END = "1999-01-01"
VALIDATION_END = "2000-01-01"
REFERENCE_DATE = "2002-01-01"


def _pick(index: Column, *labels: str) -> Column:
    out = None
    for i, label in enumerate(labels[:-1]):
        out = (F if out is None else out).when(index == i, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def _order_columns() -> dict[str, Column]:
    k, cust, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    day = F.col("o_orderdate").cast("date")
    bad = (k * 7919) % 1000 < 50 + price * 400 / 500000
    grade = F.substring(F.lit("ABCDEFG"), 1 + F.least(F.lit(6), F.floor(price / 72000)).cast("int"), F.lit(1))
    fico = (600 + 5 * ((k * 29) % 50)).cast("double")
    policy = "Does not meet the credit policy. Status:"
    status = (F.when(k % 70 == 0, F.lit(None).cast("string"))
              .when(k % 30 == 0, F.lit("In Grace Period"))
              .when(k % 10 == 0, F.lit("Current"))
              .when(bad & (k % 7 == 0), F.lit("Default"))
              .when(bad & (k % 7 == 1), F.lit("Late (31-120 days)"))
              .when(bad & (k % 7 == 2), F.lit(policy + "Charged Off"))
              .when(bad, F.lit("Charged Off"))
              .when(k % 7 == 3, F.lit(policy + "Fully Paid"))
              .otherwise(F.lit("Fully Paid")))
    pd = (50 + price * 400 / 500000) / 1000 + ((k * 104729) % 200) / 1000 - 0.1
    years = k % 12
    return {
        "id": F.concat(F.lit("L"), k.cast("string")),
        "loan_status": status,
        "issue_d": F.date_format(day, "MMM-yyyy"),
        "loan_amnt": F.floor(price / 10).cast("double"),
        "funded_amnt": F.floor(price / 10).cast("double"),
        "term": F.when(k % 97 == 0, F.lit(None).cast("string"))
                 .when(k % 3 == 0, F.lit(" 60 months")).otherwise(F.lit(" 36 months")),
        "int_rate": F.concat((5 + (k * 13) % 25).cast("string"), F.lit("."),
                             F.lpad(((k * 31) % 100).cast("string"), 2, "0"), F.lit("%")),
        "installment": F.floor(price / 3.6) / 100,
        "grade": grade,
        "sub_grade": F.concat(grade, (1 + k % 5).cast("string")),
        "emp_length": F.when(years == 0, F.lit("< 1 year")).when(years == 1, F.lit("1 year"))
                       .when(years == 10, F.lit("10+ years")).when(years == 11, F.lit("n/a"))
                       .otherwise(F.concat(years.cast("string"), F.lit(" years"))),
        "emp_title": F.when(k % 41 == 0, F.lit(None).cast("string"))
                      .otherwise(F.concat(F.lit("title"), (cust % 400).cast("string"))),
        "home_ownership": _pick(cust % 5, "MORTGAGE", "OWN", "RENT", "OTHER", "ANY"),
        "verification_status": _pick(k % 3, "Not Verified", "Source Verified", "Verified"),
        "dti": F.when(k % 53 != 0, ((k * 37) % 1300) / 10.0),
        "revol_util": F.concat(((k * 11) % 120).cast("string"), F.lit("%")),
        "fico_range_low": fico,
        "fico_range_high": fico + 4,
        "inq_last_6mths": (k % 7).cast("double"),
        "delinq_2yrs": (k % 4).cast("double"),
        "pub_rec": F.when(k % 11 == 0, F.lit(1.0)).otherwise(F.lit(0.0)),
        "delinq_amnt": F.when(k % 17 == 0, F.lit(100.0)).otherwise(F.lit(0.0)),
        "mort_acc": F.when(k % 59 != 0, (k % 5).cast("double")),
        "initial_list_status": F.when(k % 2 == 0, F.lit("w")).otherwise(F.lit("f")),
        "application_type": F.when(k % 19 == 0, F.lit("Joint App")).otherwise(F.lit("Individual")),
        "disbursement_method": F.when(k % 23 == 0, F.lit("DirectPay")).otherwise(F.lit("Cash")),
        "earliest_cr_line": F.date_format(
            F.add_months(day, (-(60 + cust % 240)).cast("int")), "MMM-yyyy"),
        "policy_code": F.lit(1.0),
        "zip_code": F.concat(F.lpad((cust % 1000).cast("string"), 3, "0"), F.lit("xx")),
        "desc": F.when(k % 20 == 0, F.lit("other")),
        "recoveries": F.when(bad, F.floor(price / 100).cast("double")).otherwise(F.lit(0.0)),
        "last_pymnt_amnt": F.floor(price / 50).cast("double"),
        "last_fico_range_low": fico - 10,
        "hardship_flag": F.lit("N"),
        "pd": F.round(F.least(F.lit(0.99), F.greatest(F.lit(0.01), pd)), 4),
    }


_CUSTOMER = {"annual_inc": lambda: 20000 + 10 * (F.col("c_acctbal") + 1000),
             "purpose": lambda: F.col("c_mktsegment")}
_NATION = {"addr_state": lambda: F.col("n_name")}


def _line_columns() -> dict[str, Column]:
    price, disc = F.col("l_extendedprice"), F.col("l_discount")
    returned = F.col("l_returnflag") == "R"

    def total(value: Column, digits: int) -> Column:
        return F.round(F.sum(value), digits)

    return {
        "open_acc": F.count(F.lit(1)).cast("double"),
        "revol_bal": total(price * (1 - disc), 4),
        "tot_hi_cred_lim": total(2 * price, 2),
        "total_bal_ex_mort": total(price * disc, 4),
        "total_rev_hi_lim": total(price, 2),
        "total_bc_limit": total(F.when(F.col("l_returnflag") == "A", price).otherwise(0.0), 2),
        "bc_open_to_buy": total(F.when(returned, price).otherwise(0.0), 2),
        "total_il_high_credit_limit": total(F.when(F.col("l_linestatus") == "F", price).otherwise(0.0), 2),
        "tot_coll_amt": total(F.when(returned, price * F.col("l_tax")).otherwise(0.0), 4),
        "collections_12_mths_ex_med": F.sum(F.when(F.col("l_quantity") > 48, 1.0).otherwise(0.0)),
    }


COLUMNS = ("loan_id", "id", "loan_status", "issue_d", "loan_amnt", "funded_amnt", "term", "int_rate",
           "installment", "grade", "sub_grade", "emp_length", "emp_title", "home_ownership",
           "annual_inc", "verification_status", "purpose", "addr_state", "dti", "delinq_2yrs",
           "fico_range_low", "fico_range_high", "inq_last_6mths", "open_acc", "pub_rec",
           "revol_bal", "revol_util", "total_acc", "initial_list_status", "application_type",
           "disbursement_method", "earliest_cr_line", "tot_coll_amt", "delinq_amnt",
           "total_rev_hi_lim", "tot_hi_cred_lim", "total_bal_ex_mort", "total_bc_limit",
           "total_il_high_credit_limit", "bc_open_to_buy", "collections_12_mths_ex_med",
           "mort_acc", "policy_code", "zip_code", "desc", "recoveries", "last_pymnt_amnt",
           "last_fico_range_low", "hardship_flag")


def loan_view(spark: SparkSession, folder: str, columns: Iterable[str] | None = None,
              orders: DataFrame | None = None) -> DataFrame:
    """Raw loans with ``loan_id`` and the given columns (``pd`` only on request)."""
    wanted = [c for c in (columns or COLUMNS) if c != "loan_id"]
    own, lines = _order_columns(), _line_columns()
    line_needs = {"open_acc" if c == "total_acc" else c for c in wanted} & {*lines}

    out = orders if orders is not None else spread(spark.read.parquet(f"{folder}/orders.parquet"))
    if any(c in _CUSTOMER or c in _NATION for c in wanted):
        customer = spark.read.parquet(f"{folder}/customer.parquet")
        out = out.join(customer, out.o_custkey == customer.c_custkey, "left")
    if any(c in _NATION for c in wanted):
        nation = spark.read.parquet(f"{folder}/nation.parquet")
        out = out.join(nation, F.col("c_nationkey") == nation.n_nationkey, "left")
    if line_needs:
        item = spark.read.parquet(f"{folder}/lineitem.parquet")
        per_loan = item.groupBy("l_orderkey").agg(
            *[lines[c].alias(c) for c in lines if c in line_needs])
        out = out.join(per_loan, out.o_orderkey == per_loan.l_orderkey, "left")

    def column(name: str) -> Column:
        if name in own:
            return own[name]
        if name in _CUSTOMER:
            return _CUSTOMER[name]()
        if name in _NATION:
            return _NATION[name]()
        if name == "total_acc":
            return F.col("open_acc") + F.col("o_orderkey") % 10
        return F.col(name)

    return out.select(F.col("o_orderkey").alias("loan_id"),
                      *[column(c).alias(c) for c in wanted])
