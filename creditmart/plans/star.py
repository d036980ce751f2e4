"""Credit-mart inputs derived from the star-schema tables.

Each input is one SELECT over the given tables in SQL that Spark and other ANSI engines read
alike, so the same raw rows can be built on both sides of a comparison. The raw text columns are
deliberately dirty: currency marks, mixed rate scales, null words, odd dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("customer", "orders", "lineitem", "events", "labels", "documents")


def _month(column: str) -> str:
    return f"make_date(year({column}), month({column}), 1)"


def _text(number: str) -> str:
    return f"cast({number} as string)"


def _cents(number: str) -> str:
    return _text(f"cast({number} as decimal(14,2))")


def _amount(number: str) -> str:
    """Whole part of a number with cents taken from the customer, so that no rounding is left."""
    return f"concat({_text(f'cast(floor({number}) as bigint)')}, '.', lpad({_text('o_custkey % 100')}, 2, '0'))"


LOAN_DAILY = f"""
select cast(l_orderkey as string) as loan_id,
       concat('cus_', {_text('o_custkey')}) as Customer_ID,
       cast(o_orderdate as date) as loan_start_date,
       10 as tenure,
       l_linenumber - 1 as installment_num,
       cast(o_totalprice as float) as loan_amt,
       cast(case when l_partkey % 50 = 0 then 0e0 else l_extendedprice / l_quantity end as float) as due_amt,
       cast(l_extendedprice * (1 - l_discount) as float) as paid_amt,
       cast(case when l_returnflag = 'R' then l_extendedprice * l_discount else 0e0 end as float) as overdue_amt,
       cast(case when l_partkey % 13 = 0 then null else l_extendedprice * l_tax end as float) as balance,
       {_month('l_shipdate')} as snapshot_date
from lineitem join orders on l_orderkey = o_orderkey
"""

ATTRIBUTES = f"""
select concat('cus_', {_text('c_custkey')}) as Customer_ID,
       case c_custkey % 20
            when 0 then 'Accountant' when 1 then 'Architect' when 2 then 'Developer' when 3 then 'Doctor'
            when 4 then 'Engineer' when 5 then 'Entrepreneur' when 6 then 'Journalist' when 7 then 'Lawyer'
            when 8 then 'Manager' when 9 then ' media_manager ' when 10 then 'Mechanic' when 11 then 'Musician'
            when 12 then 'Scientist' when 13 then 'Teacher' when 14 then 'Writer' when 15 then '_______'
            when 16 then 'NULL' when 17 then '' when 18 then null else 'Astronaut' end as Occupation,
       make_date(1996 + cast(c_custkey % 4 as int), 1 + cast(c_custkey % 12 as int), 1) as snapshot_date,
       make_date(1999, 1, 1) as ingest_dt,
       concat({_text('1996 + c_custkey % 4')}, '-', lpad({_text('1 + c_custkey % 12')}, 2, '0')) as snap_ym,
       'features_attributes.csv' as source_file
from customer
"""

FINANCIALS = f"""
select o_orderkey as row_id,
       case when o_orderkey % 5 = 0 then concat(' CUS_', {_text('o_custkey')}, ' ')
            else concat('cus_', {_text('o_custkey')}) end as Customer_ID,
       case when o_orderkey % 10 = 9
            then concat({_text('month(o_orderdate)')}, '/1/', {_text('year(o_orderdate)')})
            else {_text(_month('o_orderdate'))} end as snapshot_date,
       {_text('cast(o_orderdate as date)')} as ingest_dt,
       substr({_text('cast(o_orderdate as date)')}, 1, 7) as snap_ym,
       'features_financials.csv' as source_file,
       case o_orderkey % 7 when 0 then null when 1 then '_' when 2 then concat('$', {_cents('o_totalprice')})
            when 3 then concat({_cents('o_totalprice')}, '_')
            when 4 then concat('1,20,', {_text('100 + o_custkey % 900')}, '.50')
            else {_cents('o_totalprice')} end as Annual_Income,
       case when o_orderkey % 11 = 0 then '__10000__'
            else concat({_amount('o_totalprice / 12')}, {_text('1 + o_orderkey % 4')}) end as Monthly_Inhand_Salary,
       case o_orderkey % 8 when 0 then concat({_text('1 + o_custkey % 30')}, '%')
            when 1 then concat('0.', {_text('10 + o_custkey % 90')}, '_')
            when 2 then concat('1,0', {_text('10 + o_custkey % 90')})
            when 3 then {_text('5000 + o_custkey % 100')}
            when 4 then '1' when 5 then '20000' when 6 then 'n/a' else '100' end as Interst_Rate,
       case o_orderkey % 9 when 0 then null when 1 then '' when 2 then 'NULL' when 3 then 'Auto Loan'
            when 4 then 'Auto Loan, and Home Loan' when 5 then 'Not Specified, Auto Loan'
            when 6 then 'Personal Loan, Student Loan, and Credit-Builder Loan'
            when 7 then 'Mortgage Loan, Mortgage Loan, Credit Card, and Not Specified'
            else 'Home Equity Loan,Payday Loan, and Student Loan' end as Type_of_Loan,
       case when o_orderkey % 9 = 0 then concat({_text('o_custkey % 40')}, '.0')
            when o_orderkey % 9 = 1 then 'late' else {_text('o_custkey % 40 - 5')} end as Delay_from_due_date,
       case o_orderkey % 6 when 0 then concat({_text('o_custkey % 25')}, '_') when 1 then '-1' when 2 then '14.5'
            when 3 then null when 4 then '' else {_text('o_custkey % 25')} end as Num_of_Delayed_Payment,
       case when o_orderkey % 12 = 0 then '_' else {_amount('o_totalprice / 10000 - 20')} end as Changed_Credit_Limit,
       case when o_orderkey % 10 = 0 then null else {_text('o_orderkey % 9 - 1')} end as Num_Credit_Inquiries,
       case o_orderkey % 7 when 0 then 'good' when 1 then 'Standard' when 2 then '_' when 3 then 'bad'
            when 4 then 'NA' when 5 then null else 'GOOD' end as Credit_Mix,
       case when o_orderkey % 14 = 0 then null else concat({_amount('o_totalprice / 100')}, '_') end as Outstanding_Debt,
       case when o_orderkey % 15 = 0 then null else {_cents('o_custkey % 400 * 0.45')} end as Credit_Utilization_Ratio,
       case o_orderkey % 5 when 0 then concat({_text('o_custkey % 30')}, ' Years and ', {_text('o_custkey % 12')}, ' Months')
            when 1 then concat({_text('o_custkey % 12')}, ' Months') when 2 then 'junk' when 3 then null
            else concat({_text('1 + o_custkey % 9')}, ' Year') end as Credit_History_Age,
       case o_orderkey % 4 when 0 then 'Yes' when 1 then 'No' when 2 then 'NM' else null end as Payment_of_Min_Amount,
       case when o_orderkey % 16 = 0 then null else {_amount('o_totalprice / 500')} end as Total_EMI_per_month,
       case when o_orderkey % 13 = 0 then '__10000__'
            else concat({_amount('o_totalprice / 700')}, {_text('1 + o_orderkey % 4')}) end as Amount_invested_monthly,
       case o_orderkey % 8 when 0 then '!@9#%8' when 1 then 'NA' when 2 then null
            when 3 then 'Late payments' when 4 then 'Irregular' when 5 then 'Regular on time'
            when 6 then 'Low_spent_Small_value_payments' else 'Partial, delayed' end as Payment_Behaviour,
       case when o_orderkey % 17 = 0 then '0' else {_amount('o_totalprice / 300 - 400')} end as Monthly_Balance
from orders
"""

CLICKSTREAM = f"""
select event_id as row_id,
       concat('cus_', {_text('user_id')}) as Customer_ID,
       {_text('cast(ts as date)')} as snapshot_date,
       case when event_id % 19 = 0 then null else {_text('cast(ts as date)')} end as ingest_dt,
       substr({_text('cast(ts as date)')}, 1, 7) as snap_ym,
       'feature_clickstream.csv' as source_file,
       value as fe_1,
       case when event_type = 'error' then null else value end as fe_2,
       cast(event_id % 97 as double) as fe_3
from events
"""

# The scores are integers over a fixed divisor: few of them (ties) for one model, nearly one
# per row for the other.
SCORED = f"""
select {_month('l_shipdate')} as batch_ts,
       {_month('l_shipdate')} as snapshot_date,
       cast(l_orderkey as string) as loan_id,
       l_linenumber as line_no,
       case when l_returnflag = 'R' then 1 else 0 end as label,
       l_discount * 10 as proba_lr,
       case when l_discount * 10 >= 0.5e0 then 1 else 0 end as pred_lr,
       cast((l_partkey * 7919 + l_suppkey * 104729 + l_orderkey * 31 + l_linenumber) % 1000003 as double) / 1000003e0
           as proba_xgb,
       case when (l_partkey * 7919 + l_suppkey * 104729 + l_orderkey * 31 + l_linenumber) % 1000003 >= 700000
            then 1 else 0 end as pred_xgb
from lineitem
"""

# Dates of this century, so that two-digit years read the same everywhere.
_DAY = "make_date(year(o_orderdate) + 25, month(o_orderdate), 1 + cast(o_orderkey % 28 as int))"
DATE_TEXTS = f"""
select row_id, day_value,
       case row_id % 6
            when 0 then concat({_text('day(day_value)')}, '/', {_text('month(day_value)')}, '/',
                               substr({_text('year(day_value)')}, 3, 2))
            when 1 then concat(lpad({_text('day(day_value)')}, 2, '0'), '/', lpad({_text('month(day_value)')}, 2, '0'),
                               '/', {_text('year(day_value)')})
            when 2 then concat({_text('month(day_value)')}, '/', {_text('day(day_value)')}, '/',
                               {_text('year(day_value)')})
            when 3 then {_text('day_value')}
            when 4 then concat({_text('day_value')}, ' 00:00:00')
            else case when row_id % 12 = 5 then 'junk' else null end end as snapshot_date
from (select o_orderkey as row_id, {_DAY} as day_value from orders) dated
"""

INPUTS = {
    "loan_daily": LOAN_DAILY,
    "attributes": ATTRIBUTES,
    "financials": FINANCIALS,
    "clickstream": CLICKSTREAM,
    "scored": SCORED,
    "date_texts": DATE_TEXTS,
}
_SOURCES = {
    "loan_daily": ("lineitem", "orders"), "attributes": ("customer",), "financials": ("orders",),
    "clickstream": ("events",), "scored": ("lineitem",), "date_texts": ("orders",),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def star_input(spark: SparkSession, folder: str, name: str, spread: bool = False) -> DataFrame:
    """One derived input over the tables of a folder.

    ``spread`` deals the rows of a single table to tasks of even size before the input is derived from them,
    however few row groups its file has; a join deals them anyway.
    """
    sources = {source: table(spark, folder, source) for source in _SOURCES[name]}
    if spread and len(sources) == 1:
        sources = {source: rows.hint("rebalance") for source, rows in sources.items()}
    text = INPUTS[name].replace("{", "{{").replace("}", "}}")
    for source in sources:
        for word in ("from", "join"):
            text = text.replace(f"{word} {source}", f"{word} {{{source}}}")
    return spark.sql(text, **sources)
