"""SQL counterparts of the registered queries, over the same tables.

Each text is built from named common table expressions. They say what a query computes in plain
SQL, without regard to how it scales.
"""

from __future__ import annotations

from creditmart import constants as K
from creditmart.plans.catalog import ATT_PICK, FIN_PICK, NUMBERS, STAR_SPLITS
from creditmart.plans.star import INPUTS


def _list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _r(expression: str, places: int = 6) -> str:
    return f"round({expression}, {places}) + 0e0"


def _case_bucket(value: str, edges, names) -> str:
    tests = " ".join(f"when {value} < {e} then {n}" for e, n in zip(edges, names))
    return f"case {tests} else {names[-1]} end"


def _quoted(names):
    return [f"'{n}'" for n in names]


_PLACES = [str(i) for i in range(5)]
_INQ = "case when num_credit_inquiries is null then {0} when num_credit_inquiries = 0 then {1} " \
       "when num_credit_inquiries <= 2 then {2} when num_credit_inquiries <= 5 then {3} else {4} end"


def _history(unit: str) -> str:
    return f"coalesce(try_cast(nullif(regexp_extract(credit_history_age, '(\\d+)\\s*{unit}s?', 1), '') as integer), 0)"


def _money(c: str) -> str:
    return f"round(try_cast(regexp_replace({c}, '[^0-9.\\-]', '', 'g') as double), 2)"


def _int(c: str) -> str:
    return f"cast(trunc(try_cast({c} as double)) as integer)"


_NO_LOAN = "(type_of_loan is null or type_of_loan = '' or upper(trim(type_of_loan)) = 'NULL')"
_COMMAS = f"cast(case when {_NO_LOAN} then 0 else length(type_of_loan) - length(replace(type_of_loan, ',', '')) + 1 end as integer)"
_RATE = "try_cast(regexp_replace(interst_rate, '[_,\\s%]', '', 'g') as double)"
_PERCENT = f"round(case when {_RATE} <= 1 then {_RATE} * 100 when {_RATE} > 100 and {_RATE} <= 10000 then {_RATE} / 100 else {_RATE} end, 2)"
_MIX = f"case when upper(credit_mix) in ({_list(K.NULL_TOKENS)}) then null else concat(upper(credit_mix[1]), lower(credit_mix[2:])) end"
_MIX = f"case when credit_mix is not null then {_MIX} end"
_BEHAVIOUR = f"case when payment_behaviour = '{K.JUNK_BEHAVIOUR}' or upper(payment_behaviour) in ({_list(K.NULL_TOKENS)}) then null else payment_behaviour end"
_MONTHS = f"case when credit_history_age is not null then {_history('Year')} * 12 + {_history('Month')} end"
_LIST = ("regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper(coalesce(type_of_loan, '')), "
         "'\\bAND\\b', ',', 'g'), 'NOT SPECIFIED', '', 'g'), '\\s+', ' ', 'g'), ',\\s*,', ',', 'g'), "
         "'(^\\s*,)|(,\\s*$)', '', 'g')")
_PARSED = f"case when length(trim({_LIST})) = 0 then 0 else len(string_split_regex({_LIST}, '\\s*,\\s*')) end"
_TYPES = f"list_distinct([x for x in string_split_regex({_LIST}, '\\s*,\\s*') if x <> ''])"

_LOAN_COLUMNS = "loan_id, Customer_ID, loan_start_date, tenure, installment_num"
_AMOUNTS = ("loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance")

CTES: dict[str, tuple[tuple[str, ...], str]] = {name: ((), sql) for name, sql in INPUTS.items()}
CTES["silver_loans"] = (("loan_daily",), f"""
select *, case when missed_date is null and overdue_amt > 0 then null
               when overdue_amt > 0 then cast(date_diff('day', missed_date, snapshot_date) as integer) else 0 end as dpd
from (select *, case when installments_missed > 0 then cast(snapshot_date - to_months(installments_missed) as date) end as missed_date
      from (select {_LOAN_COLUMNS}, {', '.join(f'cast(coalesce({c}, 0) as double) as {c}' for c in _AMOUNTS)},
                   snapshot_date, installment_num as mob,
                   cast(coalesce(case when due_amt <> 0 then ceil(cast(overdue_amt as double) / cast(due_amt as double)) end, 0) as integer)
                       as installments_missed
            from loan_daily) a) b""")
CTES["label_rows"] = (("silver_loans",), """
select loan_id, Customer_ID, case when dpd >= 30 then 1 else 0 end as label, '30dpd_6mob' as label_def, snapshot_date
from silver_loans where mob = 6""")
CTES["silver_attr"] = (("attributes",), """
select Customer_ID as customer_id, case when Occupation = '_______' then null else upper(trim(Occupation)) end as occupation,
       snapshot_date, ingest_dt, snap_ym, source_file from attributes""")
CTES["raw_fin"] = (("financials",), """
select * replace (trim(Customer_ID) as Customer_ID, trim(snapshot_date) as snapshot_date) from financials""")
CTES["clean_fin"] = (("raw_fin",), f"""
select row_id, Customer_ID as customer_id, try_cast(snapshot_date as date) as snapshot_date,
       cast(ingest_dt as timestamp) as ingest_dt, snap_ym, source_file,
       {_money('annual_income')} as annual_income, round(try_cast(monthly_inhand_salary as double), 2) as monthly_inhand_salary,
       {_PERCENT} as interest_rate, {_COMMAS} as num_of_loan, {_int('delay_from_due_date')} as delay_from_due_date,
       try_cast(regexp_replace(num_of_delayed_payment, '[^0-9]', '', 'g') as integer) as num_of_delayed_payment,
       try_cast(changed_credit_limit as double) as changed_credit_limit, {_int('num_credit_inquiries')} as num_credit_inquiries,
       {_MIX} as credit_mix, {_money('outstanding_debt')} as outstanding_debt,
       try_cast(credit_utilization_ratio as double) as credit_utilization_ratio, {_MONTHS} as credit_history_age,
       payment_of_min_amount as payment_of_min_amount, try_cast(total_emi_per_month as double) as total_emi_per_month,
       round(try_cast(amount_invested_monthly as double), 2) as amount_invested_monthly,
       {_BEHAVIOUR} as payment_behaviour, round(try_cast(monthly_balance as double), 2) as monthly_balance, type_of_loan as type_of_loan
from raw_fin""")
CTES["silver_fin"] = (("clean_fin",), """
select * from clean_fin
qualify row_number() over (partition by customer_id, snapshot_date, snap_ym order by ingest_dt desc nulls last, row_id desc) = 1""")
_INCOME0 = "annual_income is not null and annual_income <> 0"
_RATIOS = f"""
       case when {_INCOME0} then outstanding_debt / annual_income end as dti,
       case when {_INCOME0} then total_emi_per_month * 12e0 / annual_income end as emi_to_income,
       case when monthly_balance <> 0 then total_emi_per_month / abs(monthly_balance) end as emi_to_balance,
       case when {_INCOME0} then amount_invested_monthly * 12e0 / annual_income end as invest_to_income"""
_UTIL = f"""
       case when credit_utilization_ratio > 150 then 150e0 else credit_utilization_ratio end as util_capped,
       {_r('pow(case when credit_utilization_ratio > 150 then 150e0 else credit_utilization_ratio end, 2)')} as util_sq,
       {_case_bucket('credit_utilization_ratio', K.UTIL_EDGES, _quoted(K.UTIL_LABELS))} as util_bucket,
       {_case_bucket('credit_utilization_ratio', K.UTIL_EDGES, _PLACES)} as util_bucket_idx"""
_CROSS = f"""
       total_emi_per_month * credit_utilization_ratio as emi_x_util, interest_rate * num_of_loan as interest_x_loans,
       case when {_INCOME0} then outstanding_debt / annual_income end * num_credit_inquiries as dti_x_inq"""
_HIST = f"""
       {_case_bucket('credit_history_age', K.HISTORY_EDGES, _quoted(K.HISTORY_LABELS))} as hist_bucket,
       {_case_bucket('credit_history_age', K.HISTORY_EDGES, _PLACES)} as hist_bucket_idx,
       {_INQ.format(*_quoted(K.INQUIRY_LABELS))} as inq_bucket, {_INQ.format(*_PLACES)} as inq_bucket_idx"""
_PAY = """
       case upper(payment_of_min_amount) when 'YES' then 1 when 'NO' then 0 end as minpay_flag,
       case when upper(payment_behaviour) like '%LATE%' or upper(payment_behaviour) like '%DELAY%' then 'late'
            when upper(payment_behaviour) like '%MIN%' or upper(payment_behaviour) like '%PART%'
              or upper(payment_behaviour) like '%IRREG%' then 'irregular'
            when upper(payment_behaviour) like '%REG%' or upper(payment_behaviour) like '%ON TIME%' then 'regular'
            else 'unknown' end as pay_behav_coarse"""
_LOANS = f"""
       cast(len({_TYPES}) as integer) as loan_types_count_unique,
       """ + ", ".join(f"list_contains({_TYPES}, '{loan}') as {flag}" for flag, loan in K.LOAN_FLAGS.items())
_MISSING = ", ".join(
    f"case when {test} then 1 else 0 end as {name}" for name, test in {
        "is_income_null": "annual_income is null", "is_outstanding_debt_null": "outstanding_debt is null",
        "is_util_null": "credit_utilization_ratio is null", "is_hist_null": "credit_history_age is null",
        "is_inquiry_null": "num_credit_inquiries is null",
        "is_minpay_null": "payment_of_min_amount is null or upper(payment_of_min_amount) in ('NM', 'NULL', '')",
        "is_behav_null": "payment_behaviour is null", "is_type_of_loan_null": "type_of_loan is null"}.items())
_ENGINEERED = ", ".join([_RATIOS, _UTIL, _CROSS, _HIST, _PAY, _LOANS, _MISSING])
CTES["wide_fin"] = (("silver_fin",), f"""
select * exclude (delay_from_due_date, num_of_delayed_payment), {_ENGINEERED} from silver_fin""")
CTES["gold_attr"] = (("silver_attr",), f"""
select *, case when occ is null then 1 else 0 end as is_occupation_null,
       {', '.join(f"case when occ = '{w}' then 1 else 0 end as occ_{w}" for w in K.OCCUPATIONS)}
from (select *, case when upper(trim(occupation)) in ('NULL', '') then null else upper(trim(occupation)) end as occ from silver_attr) a""")
CTES["base"] = (("label_rows",), """
select upper(trim(Customer_ID)) as customer_id, snapshot_date, loan_id, label, label_def from label_rows""")
CTES["fin_features"] = (("wide_fin",), f"""
select upper(trim(customer_id)) as customer_id,
       coalesce(snapshot_date, make_date(cast(substr(snap_ym, 1, 4) as int), cast(substr(snap_ym, 6, 2) as int), 1)) as feat_date,
       {', '.join(FIN_PICK)} from wide_fin""")
CTES["att_features"] = (("gold_attr",), f"""
select upper(trim(customer_id)) as customer_id, snapshot_date as feat_date, {', '.join(ATT_PICK)} from gold_attr""")


def _as_of(features: str, order: str) -> tuple[tuple[str, ...], str]:
    return ("base", features), f"""
select k.customer_id, k.snapshot_date, f.* exclude (customer_id, feat_date)
from (select distinct customer_id, snapshot_date from base) k
join {features} f on f.customer_id = k.customer_id and f.feat_date <= k.snapshot_date
qualify row_number() over (partition by k.customer_id, k.snapshot_date order by f.feat_date desc, {order}) = 1"""


CTES["fin_pick"] = _as_of("fin_features", "f.row_id desc")
CTES["att_pick"] = _as_of("att_features", "f.is_occupation_null")
CTES["asof_fin"] = (("base", "fin_pick"), "select * from base left join fin_pick using (customer_id, snapshot_date)")
_KEY = "regexp_replace(upper(trim({0})), '[^A-Z0-9_]', '', 'g')"
CTES["label_keys"] = (("label_rows",), f"select {_KEY.format('Customer_ID')} as cid_key, strftime(snapshot_date, '%Y-%m') as ym_key from label_rows")
CTES["fin_keys"] = (("clean_fin",), f"select {_KEY.format('customer_id')} as cid_key, coalesce(strftime(snapshot_date, '%Y-%m'), snap_ym) as ym_key from clean_fin")
CTES["att_keys"] = (("silver_attr",), f"select {_KEY.format('customer_id')} as cid_key, strftime(snapshot_date, '%Y-%m') as ym_key from silver_attr")
CTES["lines"] = ((), """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity as quantity, l_extendedprice as price, l_discount as discount,
       l_tax as tax, l_linestatus, cast(l_shipdate as date) as snapshot_date, case when l_returnflag = 'R' then 1 else 0 end as label
from lineitem""")


def _split_case(dates=STAR_SPLITS) -> str:
    tests = " ".join(f"when snapshot_date between date '{a}' and date '{b}' then '{n}'" for n, (a, b) in dates.items())
    return f"case {tests} end"


CTES["split_lines"] = (("lines",), f"select * from (select *, {_split_case()} as split from lines) a where split is not null")
CTES["scored_long"] = (("scored",), f"""
select split, label, 'lr' as model, proba_lr as score from (select *, {_split_case()} as split from scored) a where split is not null
union all
select split, label, 'xgb' as model, proba_xgb as score from (select *, {_split_case()} as split from scored) a where split is not null""")
CTES["counts"] = (("scored_long",), """
select model, split, score, count(*) filter (label = 1) as pos, count(*) filter (label = 0) as neg from scored_long group by all""")
CTES["curve"] = (("counts",), """
select *, cast(sum(pos) over w as bigint) as tp, cast(sum(neg) over w as bigint) as fp,
       cast(sum(pos) over (partition by model, split) as bigint) as all_pos
from counts window w as (partition by model, split order by score desc)""")
_AUC = "1 - cast(sum(pos * (2 * fp - neg)) as double) / cast(2 * sum(pos) * sum(neg) as double)"
_AP = "sum(pos * (cast(tp as double) / (tp + fp))) / sum(pos)"
_PREC, _REC = "cast(tp as double) / (tp + fp)", "cast(tp as double) / all_pos"
_F1 = f"2 * (({_PREC}) * ({_REC})) / (({_PREC}) + ({_REC}) + 1e-9)"
CTES["best"] = (("curve",), f"""
select model, split, score as threshold, {_PREC} as precision, {_REC} as recall, {_F1} as f1 from curve
qualify row_number() over (partition by model, split order by {_F1} desc, score) = 1""")
CTES["cells"] = (("curve", "best"), """
select c.model, c.split, t.name, t.threshold,
       cast(coalesce(sum(neg) filter (score < t.threshold), 0) as bigint) as tn,
       cast(coalesce(sum(neg) filter (score >= t.threshold), 0) as bigint) as fp,
       cast(coalesce(sum(pos) filter (score < t.threshold), 0) as bigint) as fn,
       cast(coalesce(sum(pos) filter (score >= t.threshold), 0) as bigint) as tp
from (select model, split, score, pos, neg from curve) c
join (select model, '' as name, 0.5e0 as threshold from best where split = 'Valid'
      union all select model, '_tuned', threshold from best where split = 'Valid') t on t.model = c.model
group by all""")
_RATES = f"""{_r('coalesce(cast(tp as double) / nullif(tp + fp, 0), 0)')} as precision_1,
       {_r('coalesce(cast(tp as double) / nullif(tp + fn, 0), 0)')} as recall_1,
       {_r('coalesce(cast(2 * tp as double) / nullif(2 * tp + fp + fn, 0), 0)')} as f1_1"""
CTES["grid"] = (("cells", "curve"), f"""
select g.model, concat(g.split, name) as split, threshold, roc_auc, pr_auc, tn, g.fp, fn, g.tp, {_RATES}
from (select model, split, name, threshold, tn, fp, fn, tp from cells) g
join (select model, split, {_r(_AUC)} as roc_auc, {_r(_AP)} as pr_auc from curve group by model, split) m
  on m.model = g.model and m.split = g.split""")


def _batch_auc(source: str) -> str:
    parts = " union all ".join(
        f"select batch_ts, '{m}' as model, label, proba_{m} as score from {source} where label in (0, 1)" for m in ("lr", "xgb"))
    return f"""
select batch_ts, max(case when model = 'lr' then auc end) as auc_lr, max(case when model = 'xgb' then auc end) as auc_xgb
from (select batch_ts, model, case when sum(pos + neg) >= 10 and sum(pos) > 0 and sum(neg) > 0 then {_r(_AUC)} end as auc
      from (select *, sum(neg) over (partition by batch_ts, model order by score desc) as fp
            from (select batch_ts, model, score, count(*) filter (label = 1) as pos, count(*) filter (label = 0) as neg
                  from ({parts}) p group by all) q) r group by batch_ts, model) s group by batch_ts"""


CTES["aucs"] = (("scored",), _batch_auc("scored"))
CTES["rates"] = (("scored",), f"""
select batch_ts, {_r('avg(pred_lr)')} as pos_rate_lr, {_r('avg(pred_xgb)')} as pos_rate_xgb,
       {_r('avg(proba_lr)')} as mean_proba_lr, {_r('avg(proba_xgb)')} as mean_proba_xgb from scored group by batch_ts""")
CTES["joined"] = (("scored", "label_rows"), """
select s.* exclude (label), r.label from scored s
left join (select distinct snapshot_date, loan_id, label from label_rows) r using (snapshot_date, loan_id)""")
CTES["joined_aucs"] = (("joined",), _batch_auc("joined"))
CTES["trend_rows"] = (("rates", "aucs"), """
select rates.*, auc_lr, auc_xgb, strftime(batch_ts, '%Y-%m') as batch_month from rates left join aucs using (batch_ts)""")


def sql(body: str, *needs: str) -> str:
    """A query with the common table expressions it needs, in order of dependence."""
    order: list[str] = []

    def add(name: str) -> None:
        for inner in CTES[name][0]:
            add(inner)
        if name not in order:
            order.append(name)
    for name in needs:
        add(name)
    parts = ",\n".join(f"{name} as ({CTES[name][1]})" for name in order)
    return f"with {parts}\n{body}" if parts else body


ORACLES: dict[str, str] = {}


def _add(name: str, body: str, *needs: str) -> None:
    ORACLES[name] = sql(body, *needs)


_SILVER_LOANS = "select * exclude (missed_date), missed_date as first_missed_date from silver_loans"
_add("loan_ageing", _SILVER_LOANS, "silver_loans")
_add("label_store", "select * from label_rows", "label_rows")
_add("bad_rate_by_mob", f"""select mob, {_r('avg(case when dpd >= 30 then 1 else 0 end)')} as bad_rate from silver_loans
where loan_start_date < date '2000-01-01' and installment_num <= 10 group by mob""", "silver_loans")
_add("snapshot_filter", _SILVER_LOANS + " where snapshot_date = date '1998-03-01'", "silver_loans")
_add("date_range", """select snapshot_date, count(*) as n_rows from silver_loans
where snapshot_date between date '1997-01-01' and date '1997-06-01' group by snapshot_date""", "silver_loans")

for _name, _columns in {
    "money_parse": "annual_income, outstanding_debt, monthly_inhand_salary",
    "digits_parse": "num_of_delayed_payment",
    "plain_casts": "delay_from_due_date, changed_credit_limit, num_credit_inquiries",
    "interest_percent": "interest_rate",
    "history_months": "credit_history_age",
    "null_tokens": "credit_mix, payment_behaviour",
    "ratios": _RATIOS, "hist_inq_buckets": _HIST, "missing_flags": _MISSING, "behaviour_class": _PAY, "loan_mix": _LOANS,
}.items():
    _add(_name, f"select row_id, {_columns} from clean_fin", "clean_fin")
_add("util_features", f"""select row_id, {_r('util_capped')} as util_capped, util_sq, util_bucket, util_bucket_idx,
{_r('emi_x_util')} as emi_x_util, {_r('interest_x_loans')} as interest_x_loans, {_r('dti_x_inq')} as dti_x_inq
from (select row_id, {_UTIL}, {_CROSS} from clean_fin) a""", "clean_fin")
_add("loan_count", f"select row_id, {_COMMAS} as num_of_loan, cast({_PARSED} as integer) as parsed_count from financials", "financials")
_add("id_keys", f"""select row_id, upper(trim(Customer_ID)) as customer_id,
{_KEY.format("concat('#', Customer_ID, ' .x')")} as cid_key from financials""", "financials")
_DATES = ["%d/%m/%y", "%d/%m/%Y", "%m/%d/%Y", "%Y-%m-%d"]
_ANY = "coalesce(" + ", ".join(f"cast(try_strptime(snapshot_date, '{f}') as date)" for f in _DATES) + \
       ", cast(try_cast(snapshot_date as timestamp) as date))"
_add("multi_date", f"select row_id, {_ANY} as snapshot_date from date_texts", "date_texts")
_add("month_filter", f"select row_id, snapshot_date from date_texts where strftime({_ANY}, '%Y-%m') = '2022-03'", "date_texts")
_add("bronze_months", f"""select strftime({_ANY}, '%Y-%m') as snap_ym, date '2024-01-01' as ingest_dt, 'date_texts' as source_file,
count(*) as n_rows from date_texts where {_ANY} is not null group by all""", "date_texts")
_add("month_and_feature_date", """select row_id, coalesce(strftime(snapshot_date, '%Y-%m'), snap_ym) as month_key,
coalesce(snapshot_date, make_date(cast(substr(snap_ym, 1, 4) as int), cast(substr(snap_ym, 6, 2) as int), 1)) as feat_date
from clean_fin""", "clean_fin")
_add("silver_financials", "select * exclude (row_id) from silver_fin", "silver_fin")
_add("silver_attributes", "select * from silver_attr", "silver_attr")
CTES["silver_click"] = (("clickstream",), """
select Customer_ID as customer_id, try_cast(snapshot_date as date) as snapshot_date, ingest_dt, snap_ym, source_file, fe_1, fe_2, fe_3
from clickstream qualify row_number() over (partition by Customer_ID, snapshot_date
order by ingest_dt desc nulls last, fe_1 desc nulls last, fe_3 desc nulls last) = 1""")
_add("silver_clickstream", "select * from silver_click", "silver_click")
_add("dedupe_latest", "select customer_id, snapshot_date, row_id from silver_fin", "silver_fin")
_add("expected_columns", """select row_id, interest_rate, cast(null as varchar) as region_code, num_of_loan,
cast(null as double) as risk_score from clean_fin""", "clean_fin")
_add("prefix_columns", "select row_id, fe_1, fe_2, fe_3 from clickstream", "clickstream")

_GOLD = [*K.FEATURE_KEYS, *K.FINANCIAL_PASS_THROUGH, *K.FINANCIAL_ENGINEERED]
_ROUND = {"dti", "emi_to_income", "emi_to_balance", "invest_to_income", "util_capped", "emi_x_util", "interest_x_loans",
          "dti_x_inq", "interest_rate", "credit_utilization_ratio"}
_add("gold_financials", "select " + ", ".join(f"{_r(c)} as {c}" if c in _ROUND else c for c in _GOLD) + " from wide_fin", "wide_fin")
_BASE_AMOUNTS = {"annual_income", "monthly_inhand_salary", "changed_credit_limit", "outstanding_debt", "total_emi_per_month",
                 "amount_invested_monthly", "monthly_balance"}
_WIDE = [c for c in K.FINANCIAL_COLUMNS if c not in K.DELINQUENCY_COLUMNS] + list(K.FINANCIAL_ENGINEERED)
_add("gold_financials_wide", "select " + ", ".join(
    f"{_r(c)} as {c}" if c in _ROUND | _BASE_AMOUNTS else c for c in _WIDE) + " from wide_fin", "wide_fin")
_OHE = ", ".join(f"occ_{w}" for w in K.OCCUPATIONS)
_add("occupation_ohe", f"select customer_id, snapshot_date, snap_ym, is_occupation_null, {_OHE} from gold_attr", "gold_attr")
_add("gold_attributes_wide", "select * exclude (occ) from gold_attr", "gold_attr")

_add("asof_dataset", "select * from asof_fin", "asof_fin")
_add("asof_multi", "select * from asof_fin left join att_pick using (customer_id, snapshot_date)", "asof_fin", "att_pick")
_PICKS = ", ".join(FIN_PICK)
_ATTS = ", ".join(ATT_PICK)
_add("exact_dataset", f"""select b.customer_id, b.snapshot_date, loan_id, label, label_def, snap_ym, {_PICKS}, {_ATTS}
from (select Customer_ID as customer_id, snapshot_date, loan_id, label, label_def from label_rows) b
left join (select customer_id, snapshot_date, snap_ym, {_PICKS} from wide_fin) f using (customer_id, snapshot_date)
left join (select customer_id, snapshot_date, {_ATTS} from gold_attr) a using (customer_id, snapshot_date)""",
     "label_rows", "wide_fin", "gold_attr")
_add("month_key_join", f"""select b.customer_id, b.snapshot_date, loan_id, label, label_def, snap_ym, {_PICKS}, {_ATTS}
from (select *, strftime(snapshot_date, '%Y-%m') as ym from base) b
left join (select upper(trim(customer_id)) as customer_id, coalesce(strftime(snapshot_date, '%Y-%m'), snap_ym) as ym, snap_ym, {_PICKS}
           from wide_fin) f using (customer_id, ym)
left join (select upper(trim(customer_id)) as customer_id, strftime(snapshot_date, '%Y-%m') as ym, {_ATTS} from gold_attr) a
  using (customer_id, ym)""", "base", "wide_fin", "gold_attr")
_add("wide_base_join", """select d.customer_id, d.snapshot_date, fe_1, fe_2, fe_3
from (select distinct Customer_ID as customer_id, cast(snapshot_date as date) as snapshot_date from clickstream) d
left join silver_click using (customer_id, snapshot_date)""", "clickstream", "silver_click")

_add("labels_with_clicks", """select loan_id, l.Customer_ID, l.snapshot_date, label, fe_1, fe_2, fe_3 from label_rows l
left join (select *, cast(date '1995-01-01' + to_months(cast(row_id % 82 as int)) as date) as month from clickstream
           qualify row_number() over (partition by Customer_ID, month order by ingest_dt desc nulls last, fe_1 desc, fe_3 desc) = 1) c
  on c.Customer_ID = l.Customer_ID and c.month = l.snapshot_date""", "label_rows", "clickstream")


def _overlap(keys: str) -> str:
    sides = {"label": "label_keys", "fin": "fin_keys", "att": "att_keys"}
    names = list(sides)
    full = " and ".join(f"{k} is not null" for k in keys.split(", "))
    pairs = [(n, n) for n in names] + [("label", "fin"), ("label", "att"), ("fin", "att")]
    return " union all ".join(
        f"select '{a}' as left_side, '{b}' as right_side, count(*) as n_keys from "
        f"(select {keys} from {sides[a]} where {full} intersect select {keys} from {sides[b]})" for a, b in pairs)


_ALL_KEYS = ("label_keys", "fin_keys", "att_keys")
_add("key_overlap", _overlap("cid_key, ym_key"), *_ALL_KEYS)
_add("key_overlap_sketch", _overlap("cid_key, ym_key"), *_ALL_KEYS)
_add("id_overlap", _overlap("cid_key"), *_ALL_KEYS)
_add("overlap_pairs", "select count(*) as n_pairs from label_keys join fin_keys using (cid_key, ym_key)", *_ALL_KEYS)
_add("missing_keys", """select distinct cid_key, ym_key from label_keys l where not exists
(select 1 from fin_keys f where f.cid_key = l.cid_key and f.ym_key = l.ym_key)""", *_ALL_KEYS)
_add("coverage", f"""select count(*) as n_keys, count(*) filter (found) as n_covered,
{_r('cast(count(*) filter (found) as double) / count(*)')} as coverage
from (select distinct cid_key, cid_key in (select cid_key from att_keys) as found from label_keys) a""", *_ALL_KEYS)
CTES["first_keys"] = (("silver_loans",), """
select distinct Customer_ID as customer_id, cast(snapshot_date - to_months(12) as date) as snapshot_date from silver_loans where mob = 0""")
_add("covered_categories", """select occupation, count(*) as n_rows from first_keys
left join silver_attr using (customer_id, snapshot_date) group by occupation""", "first_keys", "silver_attr")
_add("attribute_coverage", f"""select count(*) as n_keys, count(a.customer_id) as n_covered,
{_r('cast(count(a.customer_id) as double) / count(*)')} as coverage from first_keys k
left join (select distinct customer_id, snapshot_date from silver_attr) a
on a.customer_id = k.customer_id and a.snapshot_date = k.snapshot_date""", "first_keys", "silver_attr")
_add("month_key_nulls", """select count(*) filter (snapshot_date is null) as from_date_nulls,
count(*) filter (snap_ym is null) as from_month_nulls,
count(*) filter (snapshot_date is null and snap_ym is null) as month_key_nulls from clean_fin""", "clean_fin")

_STATS = ", ".join(
    f"""{_r(f'avg({c})')} as {c}_mean, {_r(f'quantile_disc({c}, 0.5)')} as {c}_median, {_r(f'stddev_samp({c})')} as {c}_std,
{_r(f'min({c})')} as {c}_min, {_r(f'max({c})')} as {c}_max, {_r(f'sum({c})')} as {c}_sum,
{_r(f'avg(case when {c} is null then 1e0 else 0e0 end)')} as {c}_missing_rate""" for c in ("fe_1", "fe_2", "fe_3"))
_add("entity_stats", f"""select Customer_ID, count(*) as n_rows, min(cast(snapshot_date as timestamp)) as first_snapshot,
max(cast(snapshot_date as timestamp)) as last_snapshot,
cast(date_diff('day', min(cast(snapshot_date as date)), max(cast(snapshot_date as date))) as double) as days_active, {_STATS}
from clickstream group by Customer_ID""", "clickstream")
ORACLES["entity_stats_state"] = ORACLES["entity_stats"]
_add("top_entities", f"""select Customer_ID, count(*) as n_rows, {_r('max(fe_1)')} as fe_1_max from clickstream group by Customer_ID
order by n_rows desc, Customer_ID limit 200""", "clickstream")

_add("class_share", f"""select label, count(*) as n_rows, {_r('cast(count(*) as double) / sum(count(*)) over () * 100')} as percent
from label_rows group by label""", "label_rows")


def _share(test: str) -> str:
    return _r(f"avg(case when {test} then 1e0 else 0e0 end) * 100")


_add("null_rates", " union all ".join(
    f"""select '{c}' as "column", count(*) - count({c}) as nulls, {_r(f'cast(count(*) - count({c}) as double) / count(*) * 100')} as null_rate
from silver_fin""" for c in K.NULL_RATE_COLUMNS), "silver_fin")
_add("null_rates_by_month", "select snap_ym, " + ", ".join(
    f"{_share(f'{c} is null')} as {c}" for c in K.NULL_RATE_COLUMNS) + " from silver_fin group by snap_ym", "silver_fin")
_add("filled_rates", "select " + ", ".join(
    f"{_r(f'1 - avg(case when {c} is null then 1e0 else 0e0 end)')} as {c}_non_null_rate"
    for c in ("annual_income", "interest_rate", "credit_mix")) + " from clean_fin", "clean_fin")
_add("value_ranges", " union all ".join(
    f"""select '{c}' as "column", {_r(f'cast(min({c}) as double)')} as min, {_r(f'cast(max({c}) as double)')} as max, {_r(f'avg({c})')} as mean
from clean_fin""" for c in K.VALUE_RANGES), "clean_fin")
_add("out_of_range", "select row_id, interest_rate from clean_fin where interest_rate < 0 or interest_rate > 100", "clean_fin")
_add("neg_share", " union all ".join(
    f"""select '{c}' as "column", {_share(f'{c} < 0')} as percent from clean_fin"""
    for c in (*K.NON_NEGATIVE_COLUMNS, K.EARLY_PAYMENT_COLUMN)), "clean_fin")
_add("two_dp", " union all ".join(
    f"""select '{n}' as "column", {_share(f'abs({e} - round({e}, 2)) > 1e-9')} as percent from lines"""
    for n, e in (("price", "price"), ("unit_price", "(price / quantity)"))), "lines")
_add("duplicates", """select customer_id, snapshot_date, count(*) as n_rows from clean_fin group by all having count(*) > 1""", "clean_fin")
_add("distinct_keys", "select count(*) as n_keys from (select distinct customer_id, snapshot_date from clean_fin) a", "clean_fin")
_add("value_counts", "select credit_mix, count(*) as n_rows from clean_fin group by credit_mix", "clean_fin")
_add("rows_per_snapshot", "select snapshot_date, count(*) as n_rows from silver_loans group by snapshot_date", "silver_loans")
_add("label_rate_by_month", f"""select strftime(snapshot_date, '%Y-%m') as month, count(*) as n_rows, {_r('avg(label)')} as label_rate
from label_rows group by all""", "label_rows")
_add("label_rate", f"select count(*) as n_rows, {_r('avg(label)')} as label_rate from label_rows", "label_rows")
_add("months_present", "select distinct snapshot_date as month from silver_loans", "silver_loans")
_add("length_profile", """select cast(max(length(occupation)) as integer) as max_len,
cast(quantile_disc(length(occupation), 0.99) as integer) as p99_len from silver_attr""", "silver_attr")


def _per_number(make, places: int = 6) -> str:
    return " union all ".join(make(c) for c in NUMBERS)


def _describe(c: str) -> str:
    stats = {"mean": f"avg({c})", "std": f"stddev_samp({c})", "min": f"min({c})", "max": f"max({c})"}
    stats.update({f"p{s * 100:g}": f"quantile_cont({c}, {s})" for s in K.SUMMARY_PERCENTILES})
    return f"""select '{c}' as "column", count({c}) as "count", """ + ", ".join(
        f'{_r(e, 5)} as "{n}"' for n, e in stats.items()) + " from lines"


_add("profile", _per_number(_describe), "lines")
_add("medians", _per_number(lambda c: f"""select '{c}' as "column", {_r(f'quantile_cont({c}, 0.5)', 5)} as value from lines"""), "lines")
_add("histogram", _per_number(lambda c: f"""
select '{c}' as "column", cast(bin as integer) as bin, count(*) as n_rows, {_r('max(lo + bin * width)')} as bin_start
from (select least(coalesce(floor(({c} - lo) / nullif(width, 0)), 0), 29) as bin, lo, width
      from lines, (select min({c}) as lo, (max({c}) - min({c})) / 30 as width from lines) w) b group by bin"""), "lines")
_add("var_rank", _per_number(lambda c: f"""select '{c}' as "column", {_r(f'var_samp({c})', 3)} as variance from lines"""), "lines")
_add("corr_matrix", " union all ".join(
    f"select '{a}' as column_a, '{b}' as column_b, {_r(f'corr({a}, {b})')} as corr from lines" for a in NUMBERS for b in NUMBERS), "lines")
_add("label_corr", _per_number(lambda c: f"""select '{c}' as "column", {_r(f'corr({c}, label)')} as corr from lines"""), "lines")


# ---- quality suites ---------------------------------------------------------------------

def _check(check: str, value: str, column: str | None = None, month: str = "null", tail: str = "from silver_fin", places: int = 4) -> str:
    name = "null" if column is None else f"'{column}'"
    return (f"select '{check}' as \"check\", cast({month} as varchar) as month, cast({name} as varchar) as column_name, "
            f"{_r(f'cast({value} as double)', places)} as value {tail}")


def _suite(rule: str) -> str:
    by_month = "from silver_fin group by snap_ym"
    parts = [_check("rows", "count(*)", month="snap_ym", tail=by_month), _check("total_rows", "count(*)")]
    parts += [_check("null_percent", f"avg(case when {c} is null then 1e0 else 0e0 end) * 100", c, "snap_ym", by_month)
              for c in K.NULL_RATE_COLUMNS]
    for c, (low, high) in K.VALUE_RANGES.items():
        parts += [_check("min", f"min({c})", c), _check("max", f"max({c})", c), _check("mean", f"avg({c})", c),
                  _check("out_of_range_rows", f"count(*) filter ({c} < {low} or {c} > {high})", c)]
    parts += [_check("not_two_decimals_share", f"avg(case when abs({c} - round({c}, 2)) > 1e-9 then 1e0 else 0e0 end)", c)
              for c in K.TWO_DP_COLUMNS]
    negative = [*K.NON_NEGATIVE_COLUMNS] + ([K.EARLY_PAYMENT_COLUMN] if rule == "parsed" else [])
    parts += [_check("negative_percent", f"avg(case when {c} < 0 then 1e0 else 0e0 end) * 100", c) for c in negative]
    if rule == "commas":
        parts.append(_check("early_payment_percent", "avg(case when delay_from_due_date < 0 then 1e0 else 0e0 end) * 100",
                            K.EARLY_PAYMENT_COLUMN))
    recount = _COMMAS if rule == "commas" else _PARSED
    parts += [_check("junk_token_rows", "count(*) filter (payment_behaviour = '!@9#%8')", "payment_behaviour"),
              _check("loan_count_mismatch_rows", f"count(*) filter ({recount} <> num_of_loan)", "num_of_loan"),
              _check("duplicate_groups", "count(*)", tail="""from (select customer_id from silver_fin
                     group by customer_id, snapshot_date, snap_ym having count(*) > 1) d""")]
    parts.append("""select 'credit_mix_rows' as "check", cast(null as varchar) as month, credit_mix as column_name,
                 cast(count(*) as double) as value from silver_fin group by credit_mix""")
    return " union all ".join(parts)


_add("financials_quality", _suite("commas"), "silver_fin")
_add("financials_quality_parsed", _suite("parsed"), "silver_fin")
_add("loan_count_mismatch", f"""select row_id, type_of_loan, num_of_loan, cast({_PARSED} as integer) as recount from clean_fin
where {_PARSED} <> num_of_loan""", "clean_fin")
_BY_DATE = "from label_rows group by snapshot_date"
_add("label_store_quality", " union all ".join([
    _check("rows", "count(*)", month="snapshot_date", tail=_BY_DATE, places=6),
    _check("positive_percent", "round(avg(label) * 100, 2)", month="snapshot_date", tail=_BY_DATE, places=6),
    _check("duplicate_labels", "count(*)", tail="""from (select loan_id from label_rows
           group by loan_id, snapshot_date, label_def having count(*) > 1) d"""),
    _check("non_binary_rows", "count(*) filter (label not in (0, 1))", tail="from label_rows"),
    *[_check("class_percent", f"round(cast(count(*) filter (label = {v}) as double) / count(*) * 100, 2)", v, tail="from label_rows")
      for v in ("0", "1")],
    _check("definition_rows", "count(*)", "30dpd_6mob", tail="from label_rows")]), "label_rows")
_add("labels_of_mob", """select loan_id, Customer_ID, case when dpd >= 30 then 1 else 0 end as label, '30dpd_0mob' as label_def,
snapshot_date from silver_loans where mob = 0""", "silver_loans")
_ATT_CHECKS = {"n_rows": "count(*)", "distinct_keys": "count(distinct (customer_id, snapshot_date))",
               "nulls": "count(*) - count(occupation)", "max_len": "max(length(occupation))",
               "p99_len": "quantile_disc(length(occupation), 0.99)"}
_add("attributes_quality", " union all ".join([
    *[f"select '{n}' as \"check\", cast({e} as double) as value from silver_attr" for n, e in _ATT_CHECKS.items()],
    "select 'occupations', cast(count(*) as double) from (select distinct occupation from silver_attr) a",
    """select 'duplicate_keys', cast(count(*) as double) from (select customer_id from silver_attr
       group by customer_id, snapshot_date having count(*) > 1) a"""]), "silver_attr")
_add("top_occupations", """select occupation, count(*) as n_rows from silver_attr group by occupation
order by n_rows desc, occupation nulls first limit 20""", "silver_attr")
_add("layer_counts", """select 'loan_daily' as "table", count(*) as n_rows, 15 as n_columns from silver_loans
union all select 'label_store', count(*), 5 from label_rows union all select 'attributes', count(*), 6 from silver_attr
union all select 'financials', count(*), 23 from silver_fin""", "silver_loans", "label_rows", "silver_attr", "silver_fin")
_add("model_dataset_check", f"""select snapshot_date, count(*) as n_rows,
{_r('1 - avg(case when dti is null then 1e0 else 0e0 end)')} as dti_non_null_rate,
{_r('1 - avg(case when util_bucket is null then 1e0 else 0e0 end)')} as util_bucket_non_null_rate
from asof_fin group by snapshot_date""", "asof_fin")
_add("union_months", """select row_id, snap_ym, case when snap_ym < '1998-01' then interest_rate end as interest_rate,
case when snap_ym >= '1998-01' then num_of_loan end as num_of_loan from clean_fin""", "clean_fin")

# ---- splits, preprocessing ----------------------------------------------------------------
_add("time_split", """select split, count(*) as n_rows, cast(sum(label) as bigint) as n_pos, min(snapshot_date) as first_day
from split_lines group by split""", "split_lines")
_add("split_summary", "select split, count(*) as n_rows, round(avg(label), 2) as label_rate from split_lines group by split", "split_lines")


def _rolling(mode: str) -> str:
    def back(k: int) -> str:
        day = f"run_month - to_months({k})" if mode == "month" else f"run_month - to_days({30 * k})"
        return f"cast(date_trunc('month', {day}) as date)"
    spans = " union all ".join(
        f"select run_month, '{n}' as split, {back(a)} as a, {back(b)} as b from runs" for n, (a, b) in K.ROLLING_WINDOWS.items())
    return f"""select run_month, split, count(*) as n_rows, cast(sum(label) as bigint) as n_pos
from (select * from ({spans}) s) w join label_rows on snapshot_date between a and b group by run_month, split"""


CTES["runs"] = ((), """select cast(unnest(generate_series(timestamp '1995-06-01', timestamp '2001-12-01', interval 1 month)) as date) as run_month""")
_add("rolling_windows", _rolling("month"), "runs", "label_rows")
_add("rolling_windows_days", _rolling("days"), "runs", "label_rows")
_add("training_split", """select split, count(*) as n_rows from (select case
when snapshot_date between date '1999-07-01' and date '1999-08-31' then 'oot'
when snapshot_date between date '1998-07-01' and date '1999-06-30' then 'train_test' end as split from lines) a
where split is not null group by split""", "lines")
_add("strat_sizes", """select label, part, case part when 'train' then take else n - take end as n_rows
from (select label, count(*) as n, cast(floor(count(*) * 0.8e0 + 1e-9) as bigint) as take from lines group by label) a,
     (select 'train' as part union all select 'test') p""", "lines")
_MODES = ("credit_mix", "payment_behaviour", "payment_of_min_amount")
_add("modes", " union all ".join(f"""select * from (select '{c}' as "column", {c} as value from clean_fin where {c} is not null
group by {c} order by count(*) desc, {c} limit 1) m""" for c in _MODES), "clean_fin")
_add("impute", "select row_id, " + ", ".join(
    f"{_r(f'coalesce(cast({c} as double), (select quantile_cont(cast({c} as double), 0.5) from clean_fin))', 4)} as {c}"
    for c in ("annual_income", "interest_rate", "num_credit_inquiries")) + ", " + ", ".join(
    f"coalesce({c}, (select {c} from clean_fin where {c} is not null group by {c} order by count(*) desc, {c} limit 1)) as {c}"
    for c in ("credit_mix", "payment_behaviour")) + " from clean_fin", "clean_fin")
_add("scale", "select l_orderkey, l_partkey, " + ", ".join(
    f"{_r(f'({c} - m_{c}) / s_{c}')} as {c}" for c in ("quantity", "price", "tax")) + ", snapshot_date from lines, (select " + ", ".join(
    f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in ("quantity", "price", "tax"))
    + " from lines where snapshot_date < date '1998-01-01') f", "lines")

# ---- metrics, monitoring --------------------------------------------------------------------
_add("roc_auc", f"""select model, split, cast(sum(pos) as bigint) as n_pos, cast(sum(neg) as bigint) as n_neg, {_r(_AUC)} as roc_auc
from curve group by model, split""", "curve")
_add("avg_precision", f"select model, split, {_r(_AP)} as pr_auc from curve group by model, split", "curve")
_add("gini", f"select model, split, {_r(f'2 * ({_AUC}) - 1')} as gini from curve group by model, split", "curve")
_add("score_curve", "select model, split, score, pos, neg, tp, fp from curve", "curve")
_add("confusion", f"""select model, split, tn, fp, fn, tp, {_RATES} from (select model, split,
count(*) filter (score < 0.5 and label = 0) as tn, count(*) filter (score >= 0.5 and label = 0) as fp,
count(*) filter (score < 0.5 and label = 1) as fn, count(*) filter (score >= 0.5 and label = 1) as tp
from scored_long group by model, split) c""", "scored_long")
_add("best_f1", f"""select model, split, threshold, {_r('precision', 9)} as precision, {_r('recall', 9)} as recall, {_r('f1', 9)} as f1
from best""", "best")
_add("metric_grid", "select * from grid", "grid")
_add("compare_models", """select model, max(case when split = 'Valid' then roc_auc end) as roc_auc_valid,
max(case when split = 'Valid' then pr_auc end) as pr_auc_valid, max(case when split = 'Valid_tuned' then threshold end) as tuned_threshold
from grid group by model""", "grid")
_add("apply_thresholds", """select model, split, threshold, case when score >= threshold then 1 else 0 end as pred, count(*) as n_rows
from (select s.*, coalesce(nullif(b.threshold, 0), 0.5e0) as threshold from scored_long s
      left join (select model, threshold from best where split = 'Valid') b using (model)) a group by all""", "best", "scored_long")
_add("trend", "select * from trend_rows", "trend_rows")
_add("labels_join", "select snapshot_date, loan_id, line_no, proba_lr, label from joined", "joined")
_add("trend_state", f"""select batch_ts, {", ".join(
    f"{_r(f'sum({kind}_{m}::decimal(18,12))::double / count({kind}_{m})')} as {name}_{m}"
    for kind, name in (("pred", "pos_rate"), ("proba", "mean_proba")) for m in ("lr", "xgb"))},
max(auc_lr) as auc_lr, max(auc_xgb) as auc_xgb, max(batch_month) as batch_month
from scored left join (select batch_ts, auc_lr, auc_xgb, batch_month from trend_rows) t using (batch_ts) group by batch_ts""", "scored", "trend_rows")
_add("trend_joined", """select rates.*, auc_lr, auc_xgb, strftime(batch_ts, '%Y-%m') as batch_month
from rates left join joined_aucs using (batch_ts)""", "rates", "joined_aucs")
_add("primary_metrics", """select batch_ts, 'xgb' as primary_model, coalesce(auc_xgb, auc_lr) as auc,
coalesce(pos_rate_xgb, pos_rate_lr) as rate from trend_rows""", "trend_rows")
_add("positive_sample", """select * from label_rows where label = 1
order by md5(concat_ws('|', 42, loan_id, snapshot_date, label_def)), loan_id, snapshot_date, label_def limit 10""", "label_rows")
_STRAT_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_add("strat_split", f"""select {_STRAT_KEYS}, label,
  case when row_number() over (partition by label order by h) <= floor(count(*) over (partition by label) * 0.8e0 + 1e-9)
       then 'train' else 'test' end as part
from (select *, substr(md5(concat_ws('|', 88, {_STRAT_KEYS})), 1, 15) as h from lines) a""", "lines")
# Raw files through all layers: odd dates read day first there, so month and day change places.
CTES["raw_fin_keys"] = (("financials",), """
select distinct trim(Customer_ID) as c, case when snapshot_date like '%/%' then null else snapshot_date end as d,
       case when snapshot_date like '%/%' then concat(split_part(snapshot_date, '/', 3), '-', lpad(split_part(snapshot_date, '/', 2), 2, '0'))
            else substr(snapshot_date, 1, 7) end as ym from financials""")
_add("ingest_available_now", """
select 'bronze/loan_daily' as "table", count(*) as n_rows, 15 as n_columns from loan_daily
union all select 'silver/financials', count(*), 23 from raw_fin_keys
union all select 'silver/clickstream', count(distinct (Customer_ID, snapshot_date)), 8 from clickstream
union all select 'gold/label_store', count(*), 6 from label_rows
union all select 'gold/model_dataset', count(*), 60 from label_rows""", "loan_daily", "raw_fin_keys", "clickstream", "label_rows")
