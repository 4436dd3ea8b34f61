"""Outliers, binning, encoding, scaling and feature vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowmill.catalog.base import (
    CHURN, FILLED, KEPT, churn, close_quantiles, filled, kept, query, rounded, table,
)
from rowmill.operators import binning, encode, outliers, scale, vectors
from rowmill.operators.binning import CREDIT_SCORE_BINS, CREDIT_SCORE_CODES, CREDIT_SCORE_TOP
from rowmill.operators.split import random_split, split_parts
from rowmill.catalog.storage import SPLIT_SQL
from rowmill.plans import state
from rowmill.sources import workdir

# ---- outliers ------------------------------------------------------------

OUTLIER_COLUMNS = ["CreditScore", "Age", "NumOfProducts"]
IQR = FILLED + """, q AS (SELECT
  quantile_cont(CreditScore::DOUBLE, 0.25) AS c1, quantile_cont(CreditScore::DOUBLE, 0.75) AS c3,
  quantile_cont(Age, 0.25) AS a1, quantile_cont(Age, 0.75) AS a3,
  quantile_cont(NumOfProducts::DOUBLE, 0.25) AS n1, quantile_cont(NumOfProducts::DOUBLE, 0.75) AS n3
  FROM filled),
b AS (SELECT c1 - 1.5 * (c3 - c1) AS cl, c3 + 1.5 * (c3 - c1) AS ch,
  a1 - 1.5 * (a3 - a1) AS al, a3 + 1.5 * (a3 - a1) AS ah,
  n1 - 1.5 * (n3 - n1) AS nl, n3 + 1.5 * (n3 - n1) AS nh FROM q),
flagged AS (SELECT filled.*, CreditScore < cl OR CreditScore > ch AS co, Age < al OR Age > ah AS ao,
  NumOfProducts < nl OR NumOfProducts > nh AS no FROM filled, b),
fine AS (SELECT * EXCLUDE (co, ao, no) FROM flagged WHERE co::INT + ao::INT + no::INT < 2)
"""


@query(
    "out_1_three_sigma",
    """WITH b AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s,
      avg(l_quantity) AS qm, stddev_samp(l_quantity) AS qs FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_extendedprice < m - 3 * s OR l_extendedprice > m + 3 * s AS l_extendedprice_outlier,
      l_quantity < qm - 1.5 * qs OR l_quantity > qm + 1.5 * qs AS l_quantity_outlier FROM lineitem, b""",
)
def _(spark, d):
    lineitem = table(spark, d, "lineitem")
    bounds = {
        **outliers.fit_sigma(lineitem, ["l_extendedprice"]),
        **outliers.fit_sigma(lineitem, ["l_quantity"], 1.5),
    }
    return outliers.flag_outliers(lineitem, bounds).select(
        "l_orderkey", "l_linenumber", "l_extendedprice_outlier", "l_quantity_outlier"
    )


@query(
    "out_2_iqr_bounds",
    IQR
    + """SELECT 'CreditScore' AS column, round(cl, 6) AS low, round(ch, 6) AS high FROM b
    UNION ALL SELECT 'Age', round(al, 6), round(ah, 6) FROM b
    UNION ALL SELECT 'NumOfProducts', round(nl, 6), round(nh, 6) FROM b""",
)
def _(spark, d):
    rows = filled(spark, d)
    return rounded(outliers.bounds_table(rows, outliers.fit_iqr(rows, OUTLIER_COLUMNS)))


@query(
    "out_3_iqr_bounds_approx",
    FILLED
    + """SELECT c AS column, p AS probability, count(*) > 0 AS close FROM filled,
    (VALUES ('CreditScore'), ('Age'), ('NumOfProducts')) t(c), (VALUES (0.25::DOUBLE), (0.75::DOUBLE)) u(p)
    GROUP BY ALL""",
)
def _(spark, d):
    """The quartiles that the approximate bounds came from: with threshold t
    they are (low * (1 + t) + high * t) / (1 + 2 t), and its mirror."""
    rows, t = filled(spark, d), 2.0
    found = {}
    for c, (low, high) in outliers.fit_iqr(rows, OUTLIER_COLUMNS, t, relative_error=0.01).items():
        found[c, 0.25] = round((low * (1 + t) + high * t) / (1 + 2 * t), 6)
        found[c, 0.75] = round((high * (1 + t) + low * t) / (1 + 2 * t), 6)
    return close_quantiles(rows, found, 0.011)


@query(
    "out_4_flags",
    IQR
    + """SELECT CustomerId, co AS "CreditScore_outlier", ao AS "Age_outlier", no AS "NumOfProducts_outlier"
    FROM flagged""",
)
def _(spark, d):
    rows = filled(spark, d)
    flagged = outliers.flag_outliers(rows, outliers.fit_iqr(rows, OUTLIER_COLUMNS))
    return flagged.select("CustomerId", *[f"{c}_outlier" for c in OUTLIER_COLUMNS])


@query("out_5_remove", IQR + "SELECT CustomerId, CreditScore, NumOfProducts FROM fine")
def _(spark, d):
    fine = outliers.handle_outliers(filled(spark, d), OUTLIER_COLUMNS, "remove", 2)
    return fine.select("CustomerId", "CreditScore", "NumOfProducts")


@query(
    "out_5_remove_keeps_missing",
    KEPT
    + """, q AS (SELECT quantile_cont(Age, 0.25) AS a1, quantile_cont(Age, 0.75) AS a3 FROM kept)
    SELECT CustomerId, Age FROM kept, q
    WHERE Age IS NULL OR NOT (Age < a1 - 1.5 * (a3 - a1) OR Age > a3 + 1.5 * (a3 - a1))""",
)
def _(spark, d):
    return outliers.handle_outliers(kept(spark, d), ["Age"], "remove", 1).select("CustomerId", "Age")


@query(
    "out_6_cap",
    """WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders),
    b AS (SELECT q1 - 0.3 * (q3 - q1) AS lo, q3 + 0.3 * (q3 - q1) AS hi FROM q)
    SELECT o_orderkey, round(CASE WHEN o_totalprice < lo THEN lo WHEN o_totalprice > hi THEN hi
      ELSE o_totalprice END, 6) AS o_totalprice FROM orders, b""",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    bounds = outliers.fit_iqr(orders, ["o_totalprice"], 0.3)
    return rounded(outliers.handle_outliers(orders, ["o_totalprice"], "cap", bounds=bounds), 6)


@query(
    "out_7_report",
    IQR
    + "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column, count(*) FILTER ({f}) AS outliers,
      round(count(*) FILTER ({f}) / count(*), 3) AS fraction,
      round(100.0::DOUBLE * (count(*) FILTER ({f}) / count(*)), 3) AS percent FROM flagged"""
        for c, f in (("CreditScore", "co"), ("Age", "ao"), ("NumOfProducts", "no"))
    ),
)
def _(spark, d):
    rows = filled(spark, d)
    return outliers.outlier_report(rows, outliers.fit_iqr(rows, OUTLIER_COLUMNS))


# ---- binning -------------------------------------------------------------

CLOSED = """CASE WHEN CreditScore = 850 THEN 'Excellent'
  WHEN CreditScore BETWEEN 300 AND 580 THEN 'Poor' WHEN CreditScore BETWEEN 580 AND 670 THEN 'Fair'
  WHEN CreditScore BETWEEN 670 AND 740 THEN 'Good' WHEN CreditScore BETWEEN 740 AND 800 THEN 'Very Good'
  WHEN CreditScore BETWEEN 800 AND 850 THEN 'Excellent' {rest} END"""


def _binned(spark, d, bins=CREDIT_SCORE_BINS, **options):
    rows = churn(spark, d).select("CustomerId", "CreditScore")
    return binning.bin_column(rows, "CreditScore", bins, **options)


@query(
    "bin_1_closed_ranges",
    CHURN + f"SELECT CustomerId, {CLOSED.format(rest='')} AS \"CreditScoreBins\" FROM churn",
)
def _(spark, d):
    return _binned(spark, d, exact=CREDIT_SCORE_TOP)


@query(
    "bin_1_open_top",
    CHURN
    + """SELECT CustomerId, CASE WHEN CreditScore BETWEEN 300 AND 580 THEN 'Low'
      WHEN CreditScore >= 580 THEN 'High' END AS "CreditScoreBins" FROM churn""",
)
def _(spark, d):
    return _binned(spark, d, {"Low": [300, 580], "High": [580]})


@query(
    "bin_2_invalid_above",
    CHURN
    + f"""SELECT CustomerId, {CLOSED.format(rest="WHEN CreditScore > 850 THEN 'Invalid'")}
    AS "CreditScoreBins" FROM churn""",
)
def _(spark, d):
    return _binned(spark, d, exact=CREDIT_SCORE_TOP, above="Invalid")


@query(
    "bin_3_invalid_otherwise",
    CHURN
    + f"""SELECT CustomerId, {CLOSED.format(rest="ELSE 'Invalid'")} AS "CreditScoreBins" FROM churn""",
)
def _(spark, d):
    return _binned(spark, d, exact=CREDIT_SCORE_TOP, otherwise="Invalid")


@query(
    "bin_4_poor_otherwise",
    CHURN + f"""SELECT CustomerId, {CLOSED.format(rest="ELSE 'Poor'")} AS "CreditScoreBins" FROM churn""",
)
def _(spark, d):
    return _binned(spark, d, exact=CREDIT_SCORE_TOP, otherwise="Poor")


@query(
    "bin_5_half_open",
    CHURN
    + """SELECT CustomerId, CASE WHEN CreditScore < 580 THEN 'Poor' WHEN CreditScore < 670 THEN 'Fair'
      WHEN CreditScore < 740 THEN 'Good' WHEN CreditScore < 800 THEN 'Very Good'
      WHEN CreditScore <= 850 THEN 'Excellent' END AS "CreditScoreBins" FROM churn""",
)
def _(spark, d):
    return _binned(spark, d, closed="left")


@query(
    "bin_5_many_buckets",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice > 100000 THEN NULL
      WHEN l_extendedprice = 100000 THEN 99 ELSE floor(l_extendedprice / 1000)::INT END AS bucket FROM lineitem""",
)
def _(spark, d):
    lineitem = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    splits = [1000.0 * i for i in range(101)]
    return binning.bucket_index(lineitem, "l_extendedprice", splits, "bucket").drop("l_extendedprice")


# ---- encoding ------------------------------------------------------------

PRIORITY = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "4-NOT SPECIFIED": 3}


@query(
    "enc_1_ordinal",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1
      WHEN '3-MEDIUM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 3 END AS o_orderpriority FROM orders""",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return encode.apply_ordinal(orders, {"o_orderpriority": PRIORITY})


@query(
    "enc_2_first_seen_index",
    """WITH f AS (SELECT p_type, min(p_partkey) AS k FROM part GROUP BY p_type),
    c AS (SELECT p_type, row_number() OVER (ORDER BY k) - 1 AS code FROM f)
    SELECT p_partkey, code AS p_type FROM part JOIN c USING (p_type)""",
)
def _(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_type")
    index = encode.fit_label_index(part, "p_type", "first_seen", "p_partkey")
    return encode.apply_label_index(part, index)


@query(
    "enc_3_frequency_index",
    """WITH f AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand),
    c AS (SELECT p_brand, row_number() OVER (ORDER BY n DESC, p_brand) - 1 AS code FROM f)
    SELECT p_partkey, p_brand, code AS p_brand_index FROM part JOIN c USING (p_brand)""",
)
def _(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    return encode.apply_label_index(part, encode.fit_label_index(part, "p_brand"), "p_brand_index")


@query(
    "enc_3_index_inverse",
    "SELECT p_partkey, p_name AS name FROM part",
)
def _(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_name")
    index = encode.fit_label_index(part, "p_name")
    coded = encode.apply_label_index(part, index)
    return encode.invert_label_index(coded, index, "p_name", "name").select("p_partkey", "name")


@query(
    "enc_4_sorted_code",
    """SELECT p_partkey, dense_rank() OVER (ORDER BY p_type) - 1 AS p_type FROM part""",
)
def _(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_type")
    return encode.apply_label_index(part, encode.fit_label_index(part, "p_type", "alphabet"))


ONE_HOT_SQL = """CAST(coalesce(Geography = 'AFRICA', false) AS INT) AS "Geography_AFRICA",
  CAST(coalesce(Geography = 'AMERICA', false) AS INT) AS "Geography_AMERICA",
  CAST(coalesce(Geography = 'ASIA', false) AS INT) AS "Geography_ASIA",
  CAST(coalesce(Geography = 'EUROPE', false) AS INT) AS "Geography_EUROPE",
  CAST(coalesce(Geography = 'MIDDLE EAST', false) AS INT) AS "Geography_MIDDLE_EAST",
  CAST(coalesce(Gender = 'Female', false) AS INT) AS "Gender_Female",
  CAST(coalesce(Gender = 'Male', false) AS INT) AS "Gender_Male\""""


@query("enc_5_one_hot", CHURN + f"SELECT CustomerId, {ONE_HOT_SQL} FROM churn")
def _(spark, d):
    rows = churn(spark, d).select("CustomerId", "Geography", "Gender")
    return encode.apply_one_hot(rows, encode.fit_one_hot(rows, ["Geography", "Gender"]))


@query(
    "enc_5_one_hot_boolean",
    """SELECT o_orderkey, o_orderstatus = 'F' AS "o_orderstatus_F", o_orderstatus = 'O' AS "o_orderstatus_O",
      o_orderstatus = 'P' AS "o_orderstatus_P" FROM orders""",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    labels = encode.fit_one_hot(orders, ["o_orderstatus"])
    return encode.apply_one_hot(orders, labels, as_boolean=True)


@query(
    "enc_6_one_hot_vector",
    CHURN
    + """, f AS (SELECT Gender, count(*) AS n FROM churn WHERE Gender IS NOT NULL GROUP BY Gender),
    c AS (SELECT Gender, row_number() OVER (ORDER BY n DESC, Gender) - 1 AS code FROM f)
    SELECT CustomerId, coalesce(code = 0, false)::INT::DOUBLE AS slot_0, coalesce(code = 1, false)::INT::DOUBLE AS slot_1,
      (code IS NULL)::INT::DOUBLE AS slot_unseen FROM churn LEFT JOIN c ON churn.Gender = c.Gender""",
)
def _(spark, d):
    from rowmill.functions.scalar import vector_element

    rows = churn(spark, d).select("CustomerId", "Gender")
    model = encode.fit_one_hot_vector(rows, "Gender", "vector")
    coded = encode.apply_one_hot_vector(rows, model, "Gender")
    return coded.select(
        "CustomerId",
        *[
            vector_element(F.col("vector"), i).alias(n)
            for i, n in enumerate(("slot_0", "slot_1", "slot_unseen"))
        ],
    )


@query(
    "enc_7_stored_labels",
    """WITH f AS (SELECT p_brand, min(p_partkey) AS k FROM part GROUP BY p_brand)
    SELECT 'p_brand' AS column, p_brand AS value, row_number() OVER (ORDER BY k) - 1 AS code FROM f""",
)
def _(spark, d):
    part = table(spark, d, "part")
    path = workdir.new_path(spark, "enc7")
    state.save_label_index(encode.fit_label_index(part, "p_brand", "first_seen", "p_partkey"), path)
    return state.label_table(state.load_label_index(spark, path, "p_brand"))


@query("enc_8_fixed_vocabulary", CHURN + f"SELECT CustomerId, {ONE_HOT_SQL} FROM churn WHERE Exited = 1")
def _(spark, d):
    rows = churn(spark, d)
    labels = encode.fit_one_hot(rows, ["Geography", "Gender"])
    leaving = rows.filter(F.col("Exited") == 1).select("CustomerId", "Geography", "Gender")
    return encode.apply_one_hot(leaving, labels)


# ---- scaling -------------------------------------------------------------


@query(
    "sca_1_min_max",
    """SELECT l_orderkey, l_linenumber, round((l_quantity - ql) / (qh - ql), 9) AS l_quantity,
      round((l_extendedprice - el) / (eh - el), 9) AS l_extendedprice
    FROM lineitem, (SELECT min(l_quantity) AS ql, max(l_quantity) AS qh, min(l_extendedprice) AS el,
      max(l_extendedprice) AS eh FROM lineitem)""",
)
def _(spark, d):
    columns = ["l_quantity", "l_extendedprice"]
    lineitem = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *columns)
    return rounded(scale.apply_scaling(lineitem, scale.fit_min_max(lineitem, columns)), 9)


@query(
    "sca_1_constant_column",
    "SELECT c_custkey, 0.0::DOUBLE AS same FROM customer",
)
def _(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", F.lit(7).alias("same"))
    return scale.apply_scaling(rows, scale.fit_min_max(rows, ["same"]))


@query(
    "sca_2_standard",
    """SELECT l_orderkey, l_linenumber, round((l_quantity - m) / s, 6) AS l_quantity
    FROM lineitem, (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s FROM lineitem)""",
)
def _(spark, d):
    lineitem = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return rounded(scale.apply_scaling(lineitem, scale.fit_standard(lineitem, ["l_quantity"])))


@query(
    "sca_3_standard_no_centre",
    """SELECT o_orderkey, round(o_totalprice / s, 6) AS o_totalprice
    FROM orders, (SELECT stddev_samp(o_totalprice) AS s FROM orders)""",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    fitted = scale.fit_standard(orders, ["o_totalprice"], with_mean=False, ddof=1)
    return rounded(scale.apply_scaling(orders, fitted))


@query(
    "sca_4_stored_scaling",
    f"""WITH parts AS (SELECT o_orderkey, o_totalprice, {SPLIT_SQL.format(key='o_orderkey', share=0.2)} AS split
      FROM orders),
    r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM parts WHERE split = 'train')
    SELECT o_orderkey, round((o_totalprice - lo) / (hi - lo), 9) AS o_totalprice FROM parts, r
    WHERE split = 'test'""",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    train, test = split_parts(random_split(orders, "o_orderkey", 0.2))
    path = workdir.new_path(spark, "sca4")
    state.save_state(spark, {"scale": scale.fit_min_max(train, ["o_totalprice"])}, path)
    fitted = state.load_state(spark, path)["scale"]
    return rounded(scale.apply_scaling(test, fitted), 9)


# ---- vectors -------------------------------------------------------------


@query(
    "vec_1_assemble",
    CHURN
    + """SELECT CustomerId, Exited, Age AS f0, Balance AS f1, Tenure::DOUBLE AS f2 FROM churn
    WHERE Age IS NOT NULL""",
)
def _(spark, d):
    from rowmill.functions.scalar import vector_element

    made = vectors.assemble(churn(spark, d), ["Age", "Balance", "Tenure"], ["CustomerId", "Exited"])
    return made.select(
        "CustomerId", "Exited", *[vector_element(F.col("features"), i).alias(f"f{i}") for i in range(3)]
    )


@query(
    "vec_2_composite",
    CHURN
    + """, binned AS (SELECT *, CASE WHEN CreditScore < 580 THEN 'Poor' WHEN CreditScore < 670 THEN 'Fair'
      WHEN CreditScore < 740 THEN 'Good' WHEN CreditScore < 800 THEN 'Very Good'
      WHEN CreditScore <= 850 THEN 'Excellent' END AS bins FROM churn),
    f AS (SELECT * REPLACE (coalesce(Age, (SELECT quantile_cont(Age, 0.5) FROM churn)) AS Age,
      coalesce(Gender, 'missing') AS Gender, coalesce(bins, 'missing') AS bins) FROM binned),
    s AS (SELECT avg(Age) AS am, stddev_pop(Age) AS asd, avg(Balance) AS bm, stddev_pop(Balance) AS bsd FROM f),
    o AS (SELECT bins, row_number() OVER (ORDER BY bins) - 1 AS code FROM (SELECT DISTINCT bins FROM f))
    SELECT round((Age - am) / asd, 6) AS "Age", round((Balance - bm) / bsd, 6) AS "Balance",
      (Gender = 'Female')::INT AS "Gender_Female", (Gender = 'Male')::INT AS "Gender_Male",
      (Gender = 'missing')::INT AS "Gender_missing", code AS "CreditScoreBins", Exited
    FROM f JOIN o USING (bins), s""",
)
def _(spark, d):
    rows = binning.bin_column(churn(spark, d), "CreditScore", CREDIT_SCORE_BINS, closed="left")
    fitted = vectors.fit_composite(rows, ["Age", "Balance"], ["Gender"], ["CreditScoreBins"], ["Exited"])
    return rounded(vectors.apply_composite(rows, fitted))


@query(
    "cmp_0_churn_by_bin",
    FILLED
    + f""", coded AS (SELECT Geography, Exited, Age, {CLOSED.format(rest='')} AS bin FROM filled)
    SELECT Geography, CASE bin WHEN 'Poor' THEN 0 WHEN 'Fair' THEN 1 WHEN 'Good' THEN 2
      WHEN 'Very Good' THEN 3 WHEN 'Excellent' THEN 4 END AS "CreditScoreBins", count(*) AS customers,
      round(avg(Exited), 6) AS churn_share, round(avg(Age), 6) AS mean_age FROM coded GROUP BY 1, 2""",
)
def churn_by_bin(spark, d):
    binned = binning.bin_column(
        filled(spark, d), "CreditScore", CREDIT_SCORE_BINS, exact=CREDIT_SCORE_TOP
    )
    coded = encode.apply_ordinal(binned, {"CreditScoreBins": CREDIT_SCORE_CODES})
    return coded.groupBy("Geography", "CreditScoreBins").agg(
        F.count(F.lit(1)).alias("customers"),
        F.round(F.avg("Exited"), 6).alias("churn_share"),
        F.round(F.avg("Age"), 6).alias("mean_age"),
    )
