"""Data-quality suites with one long result: (check, month, column_name, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart import constants as K
from creditmart.functions.cleaning import loan_count
from creditmart.functions.features import loan_list_text
from creditmart.operators.keys import coverage, covered_categories
from creditmart.operators.profile import count_by, length_profile, not_two_decimals
from creditmart.operators.projection import outside, seeded_sample, top_rows


def missing_columns(df: DataFrame, expected: Sequence[str] = K.FINANCIAL_COLUMNS) -> list[str]:
    return [name for name in expected if name not in df.columns]


def parsed_loan_count(c: str = "type_of_loan") -> Column:
    """Number of names in the normalised loan list (the older counting rule)."""
    text = loan_list_text(c)
    return F.when(F.length(F.trim(text)) == 0, 0).otherwise(F.size(F.split(text, r"\s*,\s*")))


def loan_count_mismatches(df: DataFrame, rule: str = "commas") -> DataFrame:
    """Rows whose ``num_of_loan`` differs from the recount; rows without a count are skipped."""
    recount = loan_count("type_of_loan") if rule == "commas" else parsed_loan_count()
    return df.withColumn("recount", recount.cast("int")).where(F.col("recount") != F.col("num_of_loan"))


# How the parts of a figure are put together: a total, a ratio of two totals, or an extreme.
_TOTAL, _RATIO, _MIN, _MAX = "total", "ratio", "min", "max"
_PART = "struct<check:string,month:string,column_name:string,kind:string,a:double,b:double>"


def _part(check: str, kind: str, a: Column, b: Column | None = None, column: Column | str | None = None,
          month: Column | None = None) -> Column:
    name = column if isinstance(column, Column) else F.lit(column)
    return F.struct(
        F.lit(check).alias("check"), (F.lit(None) if month is None else month).cast("string").alias("month"),
        name.cast("string").alias("column_name"), F.lit(kind).alias("kind"), a.cast("double").alias("a"),
        (F.lit(None) if b is None else b).cast("double").alias("b"))


def _combined(groups: DataFrame, parts: Sequence[Column], always: Sequence[Column], places: int | None = None,
              more: DataFrame | None = None) -> DataFrame:
    """Figures (check, month, column_name, value) from the few group rows of one aggregation.

    Each group row contributes its parts, and ``more`` holds parts already; those of one figure are
    added up. ``always`` are parts without data, so that overall figures exist for an empty table too.
    """
    seed = groups.sparkSession.range(1).select(F.inline(F.array(*always).cast(f"array<{_PART}>")))
    rows = groups.select(F.inline(F.array(*parts).cast(f"array<{_PART}>"))).unionByName(seed)
    if more is not None:
        rows = rows.unionByName(more)
    totals = rows.groupBy("check", "month", "column_name", "kind").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"), F.min("a").alias("least"), F.max("a").alias("most"))
    ratio = F.try_divide(F.col("a"), F.col("b"))
    value = (F.when(F.col("kind") == _TOTAL, F.col("a")).when(F.col("kind") == _MIN, F.col("least"))
             .when(F.col("kind") == _MAX, F.col("most")).otherwise(ratio if places is None else F.round(ratio, places)))
    return totals.select("check", "month", "column_name", value.alias("value"))


def _repeated_keys(df: DataFrame, keys: Sequence[str], check: str) -> DataFrame:
    """The part of ``check`` with the number of keys that occur more than once.

    Only the keys are read and shuffled, as one partial count each per task, so neither wide rows nor
    a hot key go through one task.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).agg(F.count(F.lit(1)).alias("_repeated"))
    return repeated.select(F.inline(F.array(_part(check, _TOTAL, F.col("_repeated"))).cast(f"array<{_PART}>")))


def _no_data(parts: Sequence[tuple]) -> list[Column]:
    """The overall parts with nothing in them."""
    return [_part(check, kind, F.lit(0 if kind == _TOTAL else None), None, column) for check, kind, column in parts]


def financials_suite(df: DataFrame, month: str = "ds_token", rule: str = "commas") -> DataFrame:
    """The full check list over silver financials.

    ``rule='commas'`` is the current suite, ``rule='parsed'`` the older one, which recounts the
    loan list by names and also expects no early payments. One aggregation by month and credit mix
    reads the data; monthly, overall and category figures are put together from its few rows. Repeated keys
    are counted apart.
    """
    have = set(df.columns)
    missing = [c for c in K.FINANCIAL_COLUMNS if c not in have]
    figures: dict[str, Column] = {"rows": F.count(F.lit(1))}
    overall: list[tuple[str, str, str | None, str, str | None]] = [("total_rows", _TOTAL, None, "rows", None)]  # check, kind, column, a, b

    def add(check: str, kind: str, column: str | None, a: Column, b: Column | None = None) -> None:
        name = f"f{len(figures)}"
        figures[name] = a
        if b is not None:
            figures[f"{name}b"] = b
        overall.append((check, kind, column, name, None if b is None else f"{name}b"))

    def share(check: str, column: str, test: Column, times: int = 1) -> None:
        add(check, _RATIO, column, F.count_if(test) * times, F.count(F.lit(1)))

    nulls = {c: f"null_{c}" for c in K.NULL_RATE_COLUMNS if c in have}
    figures.update({name: F.count_if(F.col(c).isNull()) for c, name in nulls.items()})
    for c, (low, high) in K.VALUE_RANGES.items():
        if c in have:
            add("min", _MIN, c, F.min(c))
            add("max", _MAX, c, F.max(c))
            add("mean", _RATIO, c, F.sum(F.col(c).cast("double")), F.count(c))
            add("out_of_range_rows", _TOTAL, c, F.count_if((F.col(c) < low) | (F.col(c) > high)))
    for c in K.TWO_DP_COLUMNS:
        if c in have:
            share("not_two_decimals_share", c, not_two_decimals(c))
    signed = K.NON_NEGATIVE_COLUMNS + (() if rule == "commas" else (K.EARLY_PAYMENT_COLUMN,))
    for c in signed:
        if c in have:
            share("negative_percent", c, F.col(c) < 0, 100)
    if rule == "commas" and K.EARLY_PAYMENT_COLUMN in have:
        share("early_payment_percent", K.EARLY_PAYMENT_COLUMN, F.col(K.EARLY_PAYMENT_COLUMN) < 0, 100)
    if "payment_behaviour" in have:
        add("junk_token_rows", _TOTAL, "payment_behaviour", F.count_if(F.col("payment_behaviour") == K.JUNK_BEHAVIOUR))
    if {"type_of_loan", "num_of_loan"} <= have:
        recount = loan_count("type_of_loan") if rule == "commas" else parsed_loan_count()
        add("loan_count_mismatch_rows", _TOTAL, "num_of_loan", F.count_if(recount != F.col("num_of_loan")))

    mix = ["credit_mix"] if "credit_mix" in have else []
    groups = df.groupBy(F.col(month).alias("_month"), *mix).agg(
        *[value.alias(name) for name, value in figures.items()])
    at = F.coalesce(F.col("_month").cast("string"), F.lit("null"))
    parts = [_part("rows", _TOTAL, F.col("rows"), month=at)]
    parts += [_part("null_percent", _RATIO, F.col(name) * 100, F.col("rows"), c, at) for c, name in nulls.items()]
    parts += [_part(check, kind, F.col(a), None if b is None else F.col(b), column) for check, kind, column, a, b in overall]
    parts += [_part("credit_mix_rows", _TOTAL, F.col("rows"), column=F.col("credit_mix")) for _ in mix]
    always = _no_data([(check, kind, column) for check, kind, column, _, _ in overall])
    always += _no_data([("duplicate_groups", _TOTAL, None)])
    always += [_part("missing_column", _TOTAL, F.lit(1), column=c) for c in missing]
    result = _combined(groups, parts, always, more=_repeated_keys(df, ["customer_id", "snapshot_date", month], "duplicate_groups"))
    return result.withColumn("month", F.nullif(F.col("month"), F.lit("null"))).select("check", "month", "column_name", "value")


def out_of_range_rows(df: DataFrame, column: str = "interest_rate") -> DataFrame:
    low, high = K.VALUE_RANGES[column]
    return outside(df, column, low, high)


# ---- label store ------------------------------------------------------------------------

def label_store_suite(labels: DataFrame) -> DataFrame:
    """Duplicate and non-binary labels, class balance, rows and rate per month, definitions.

    Two levels of one aggregation, by key and then by month and definition; all figures are put
    together from the few rows of the second.
    """
    label = F.col("label")
    counts = {"n": F.count(F.lit(1)), "sum": F.sum(label), "known": F.count(label), "zero": F.count_if(label == 0), "one": F.count_if(label == 1),
              "bad": F.count_if(~F.coalesce(label.isin(0, 1), F.lit(False)))}
    keys = labels.groupBy("loan_id", "snapshot_date", "label_def").agg(*[c.alias(name) for name, c in counts.items()])
    groups = keys.groupBy("snapshot_date", "label_def").agg(
        F.count_if(F.col("n") > 1).alias("repeated"), *[F.sum(name).alias(name) for name in counts])
    n, month = F.col("n"), F.coalesce(F.col("snapshot_date").cast("string"), F.lit("null"))
    parts = [
        _part("rows", _TOTAL, n, month=month), _part("positive_percent", _RATIO, F.col("sum") * 100, F.col("known"), month=month),
        _part("duplicate_labels", _TOTAL, F.col("repeated")), _part("non_binary_rows", _TOTAL, F.col("bad")),
        _part("class_percent", _RATIO, F.col("zero") * 100, n, "0"), _part("class_percent", _RATIO, F.col("one") * 100, n, "1"),
        _part("definition_rows", _TOTAL, n, column=F.col("label_def"))]
    always = _no_data([("duplicate_labels", _TOTAL, None), ("non_binary_rows", _TOTAL, None),
                       ("class_percent", _RATIO, "0"), ("class_percent", _RATIO, "1")])
    result = _combined(groups, parts, always, places=2)
    return result.withColumn("month", F.nullif(F.col("month"), F.lit("null"))).select("check", "month", "column_name", "value")


def labels_of_mob(labels: DataFrame, mob: int = 0) -> DataFrame:
    return labels.where(F.col("label_def").endswith(f"_{mob}mob"))


def positive_sample(labels: DataFrame, rows: int = K.SAMPLE_POSITIVES, seed: int = 42) -> DataFrame:
    """Up to ``rows`` positive labels, the same ones on every run."""
    return seeded_sample(labels.where("label = 1"), ["loan_id", "snapshot_date", "label_def"], rows, seed)


# ---- attributes -------------------------------------------------------------------------

def attributes_suite(attributes: DataFrame) -> DataFrame:
    """Rows, distinct keys, duplicate keys, nulls, cardinality and text length of occupation."""
    keys = ["customer_id", "snapshot_date"]
    per_key = count_by(attributes, keys).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n_rows") > 1).alias("duplicate_keys"))
    values = count_by(attributes, ["occupation"]).agg(
        F.count(F.lit(1)).alias("occupations"),
        F.coalesce(F.sum(F.when(F.col("occupation").isNull(), F.col("n_rows"))), F.lit(0)).alias("nulls"))
    lengths = length_profile(attributes, "occupation")

    def lines(frame: DataFrame) -> DataFrame:
        return frame.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("check"), F.col(name).cast("double").alias("value"))
            for name in frame.columns])))
    return lines(per_key).unionByName(lines(values)).unionByName(lines(lengths))


def top_occupations(attributes: DataFrame, rows: int = 20) -> DataFrame:
    return top_rows(count_by(attributes, ["occupation"]), [F.desc("n_rows"), F.asc("occupation")], rows)


def first_month_keys(loans: DataFrame) -> DataFrame:
    """Distinct (customer, snapshot) of loans in their first month."""
    return loans.where("mob = 0").select(
        F.col("Customer_ID").alias("customer_id"), "snapshot_date").distinct()


def attribute_coverage(loans: DataFrame, attributes: DataFrame) -> DataFrame:
    return coverage(first_month_keys(loans), attributes, ["customer_id", "snapshot_date"])


def attribute_mix(loans: DataFrame, attributes: DataFrame) -> DataFrame:
    return covered_categories(first_month_keys(loans), attributes, ["customer_id", "snapshot_date"], "occupation")


# ---- layers -----------------------------------------------------------------------------

def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of every table as (table, n_rows, n_columns)."""
    result = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        result = row if result is None else result.unionByName(row)
    return result


def schema_rows(df: DataFrame, table: str) -> DataFrame:
    """Schema of a table as rows (table, position, column_name, type)."""
    fields = F.array(*[
        F.struct(F.lit(table).alias("table"), F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("type"))
        for i, f in enumerate(df.schema.fields)
    ])
    return df.sparkSession.range(1).select(F.inline(fields))


def files_per_layer(tables: dict[str, DataFrame]) -> DataFrame:
    """Data files behind each table."""
    result = None
    for name, df in tables.items():
        row = df.select(F.col("_metadata.file_path").alias("f")).distinct().agg(
            F.count(F.lit(1)).alias("n_files")).select(F.lit(name).alias("table"), "n_files")
        result = row if result is None else result.unionByName(row)
    return result


def snapshots_per_file(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    return df.groupBy(F.col("_metadata.file_path").alias("file"), column).agg(F.count(F.lit(1)).alias("n_rows"))


def model_dataset_check(df: DataFrame, features: Sequence[str] = ()) -> DataFrame:
    """Rows per snapshot with the filled share of key features."""
    return df.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[(1 - F.avg(F.col(c).isNull().cast("double"))).alias(f"{c}_non_null_rate")
          for c in features if c in df.columns])
