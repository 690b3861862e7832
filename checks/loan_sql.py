"""The loan view again, as SQL for the oracle engine."""

RAW = """
lines AS (
  SELECT l_orderkey,
    CAST(count(*) AS DOUBLE) AS open_acc,
    round(sum(l_extendedprice * (1 - l_discount)), 4) AS revol_bal,
    round(sum(2 * l_extendedprice), 2) AS tot_hi_cred_lim,
    round(sum(l_extendedprice * l_discount), 4) AS total_bal_ex_mort,
    round(sum(l_extendedprice), 2) AS total_rev_hi_lim,
    round(sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE 0 END), 2) AS total_bc_limit,
    round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END), 2) AS bc_open_to_buy,
    round(sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice ELSE 0 END), 2) AS total_il_high_credit_limit,
    round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_tax ELSE 0 END), 4) AS tot_coll_amt,
    CAST(sum(CASE WHEN l_quantity > 48 THEN 1 ELSE 0 END) AS DOUBLE) AS collections_12_mths_ex_med
  FROM lineitem GROUP BY l_orderkey),
base AS (
  SELECT *, o_orderkey AS k, CAST(o_orderdate AS DATE) AS day,
    (o_orderkey * 7919) % 1000 < 50 + o_totalprice * 400 / 500000 AS bad,
    substr('ABCDEFG', CAST(1 + least(6, floor(o_totalprice / 72000)) AS INT), 1) AS g,
    CAST(600 + 5 * ((o_orderkey * 29) % 50) AS DOUBLE) AS fico
  FROM orders),
raw AS (
  SELECT k AS loan_id, concat('L', k) AS id,
    CASE WHEN k % 70 = 0 THEN NULL WHEN k % 30 = 0 THEN 'In Grace Period'
         WHEN k % 10 = 0 THEN 'Current' WHEN bad AND k % 7 = 0 THEN 'Default'
         WHEN bad AND k % 7 = 1 THEN 'Late (31-120 days)'
         WHEN bad AND k % 7 = 2 THEN 'Does not meet the credit policy. Status:Charged Off'
         WHEN bad THEN 'Charged Off'
         WHEN k % 7 = 3 THEN 'Does not meet the credit policy. Status:Fully Paid'
         ELSE 'Fully Paid' END AS loan_status,
    strftime(day, '%b-%Y') AS issue_d,
    floor(o_totalprice / 10) AS loan_amnt, floor(o_totalprice / 10) AS funded_amnt,
    CASE WHEN k % 97 = 0 THEN NULL WHEN k % 3 = 0 THEN ' 60 months' ELSE ' 36 months' END AS term,
    concat(5 + (k * 13) % 25, '.', lpad(CAST((k * 31) % 100 AS VARCHAR), 2, '0'), '%') AS int_rate,
    floor(o_totalprice / 3.6::DOUBLE) / 100 AS installment,
    g AS grade, concat(g, 1 + k % 5) AS sub_grade,
    CASE k % 12 WHEN 0 THEN '< 1 year' WHEN 1 THEN '1 year' WHEN 10 THEN '10+ years'
         WHEN 11 THEN 'n/a' ELSE concat(k % 12, ' years') END AS emp_length,
    CASE WHEN k % 41 = 0 THEN NULL ELSE concat('title', o_custkey % 400) END AS emp_title,
    CASE o_custkey % 5 WHEN 0 THEN 'MORTGAGE' WHEN 1 THEN 'OWN' WHEN 2 THEN 'RENT'
         WHEN 3 THEN 'OTHER' ELSE 'ANY' END AS home_ownership,
    20000 + 10 * (c_acctbal + 1000) AS annual_inc,
    CASE k % 3 WHEN 0 THEN 'Not Verified' WHEN 1 THEN 'Source Verified' ELSE 'Verified' END AS verification_status,
    c_mktsegment AS purpose, n_name AS addr_state,
    CASE WHEN k % 53 <> 0 THEN ((k * 37) % 1300) / 10.0::DOUBLE END AS dti,
    CAST(k % 4 AS DOUBLE) AS delinq_2yrs, fico AS fico_range_low, fico + 4 AS fico_range_high,
    CAST(k % 7 AS DOUBLE) AS inq_last_6mths, open_acc,
    CASE WHEN k % 11 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS pub_rec, revol_bal,
    concat((k * 11) % 120, '%') AS revol_util, open_acc + k % 10 AS total_acc,
    CASE WHEN k % 2 = 0 THEN 'w' ELSE 'f' END AS initial_list_status,
    CASE WHEN k % 19 = 0 THEN 'Joint App' ELSE 'Individual' END AS application_type,
    CASE WHEN k % 23 = 0 THEN 'DirectPay' ELSE 'Cash' END AS disbursement_method,
    strftime(day - to_months(CAST(60 + o_custkey % 240 AS INT)), '%b-%Y') AS earliest_cr_line,
    tot_coll_amt, CASE WHEN k % 17 = 0 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS delinq_amnt,
    total_rev_hi_lim, tot_hi_cred_lim, total_bal_ex_mort, total_bc_limit,
    total_il_high_credit_limit, bc_open_to_buy, collections_12_mths_ex_med,
    CASE WHEN k % 59 <> 0 THEN CAST(k % 5 AS DOUBLE) END AS mort_acc, 1.0::DOUBLE AS policy_code,
    concat(lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0'), 'xx') AS zip_code,
    CASE WHEN k % 20 = 0 THEN 'other' END AS "desc",
    CASE WHEN bad THEN floor(o_totalprice / 100) ELSE 0.0::DOUBLE END AS recoveries,
    floor(o_totalprice / 50) AS last_pymnt_amnt, fico - 10 AS last_fico_range_low,
    'N' AS hardship_flag,
    round(least(0.99::DOUBLE, greatest(0.01::DOUBLE,
      (50 + o_totalprice * 400 / 500000) / 1000 + ((k * 104729) % 200) / 1000.0::DOUBLE - 0.1::DOUBLE)), 4) AS pd
  FROM base LEFT JOIN customer ON o_custkey = c_custkey
            LEFT JOIN nation ON c_nationkey = n_nationkey
            LEFT JOIN lines ON k = l_orderkey)
"""
