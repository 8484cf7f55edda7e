"""SCD2 history and product content."""

from __future__ import annotations

from pyspark.sql import functions as F

from aislekit.operators import history as D
from aislekit.plans.derived import lifecycles
from aislekit.plans.registry import query
from aislekit.plans.sql_common import LIFECYCLES

LC = ("lifecycle_changes",)


@query("d01_scd2_lifecycle", LC, LIFECYCLES)
def d01(t):
    """SCD2 product lifecycle versions from status changes."""
    return lifecycles(t)


@query("d02_current_version", LC, f"""
SELECT product_id, arg_max(status, (is_current, valid_from)) AS status, arg_max(valid_from, (is_current, valid_from)) AS valid_from,
  bool_or(is_current) AS is_current FROM ({LIFECYCLES}) GROUP BY 1""")
def d02(t):
    """Current (else latest) lifecycle version of each product."""
    return D.current_version(lifecycles(t)).select("product_id", "status", "valid_from", "is_current")


@query("d03_status_transitions", LC, f"""
SELECT status AS from_status, nx AS to_status, count(*) AS n,
  coalesce(list_contains(CASE status WHEN 'New' THEN ['Active', 'Discontinued'] WHEN 'Active' THEN ['Seasonal', 'Phasing Out']
    WHEN 'Seasonal' THEN ['Active', 'Phasing Out'] WHEN 'Phasing Out' THEN ['Discontinued'] WHEN 'Discontinued' THEN CAST([] AS VARCHAR[]) END, nx), false) AS allowed
FROM (SELECT status, lead(status) OVER (PARTITION BY product_id ORDER BY valid_from, status) AS nx FROM ({LIFECYCLES})) WHERE nx IS NOT NULL GROUP BY 1, 2""")
def d03(t):
    """Observed status transitions, counted, against the allowed chain."""
    return D.status_transitions(lifecycles(t))


@query("d04_dwell_days", LC, f"""
SELECT product_id, status, valid_from, datediff('day', valid_from, valid_to) AS dwell_days,
  datediff('day', valid_from, valid_to) BETWEEN CASE status WHEN 'New' THEN 14 WHEN 'Active' THEN 120 WHEN 'Seasonal' THEN 60 WHEN 'Phasing Out' THEN 30 WHEN 'Discontinued' THEN 365 END
   AND CASE status WHEN 'New' THEN 120 WHEN 'Active' THEN 1095 WHEN 'Seasonal' THEN 180 WHEN 'Phasing Out' THEN 180 WHEN 'Discontinued' THEN 3650 END AS within_bounds
FROM ({LIFECYCLES}) WHERE valid_to IS NOT NULL""")
def d04(t):
    """Days spent in each closed status version, against its dwell range."""
    return D.dwell_days(lifecycles(t))


@query("d05_discontinuation", LC, f"SELECT product_id, valid_from, discontinuation_date FROM ({LIFECYCLES}) WHERE discontinuation_date IS NOT NULL")
def d05(t):
    """Versions carrying a discontinuation date (Discontinued rows only)."""
    return lifecycles(t).where(F.col("discontinuation_date").isNotNull()).select("product_id", "valid_from", "discontinuation_date")


@query("d06_tier_steps", ("product_content_quality",), """
SELECT product_id, content_version_id, valid_from, tier_index, prev_tier_index, datediff('day', prev_valid_from, valid_from) AS gap_days,
  abs(tier_index - prev_tier_index) <= 1 AS one_step FROM (
 SELECT *, lag(tier_index) OVER w AS prev_tier_index, lag(valid_from) OVER w AS prev_valid_from FROM (
   SELECT product_id, content_version_id, valid_from, CAST(list_position(['Poor', 'Average', 'Good', 'Excellent'], quality_tier) AS INTEGER) AS tier_index
   FROM product_content_quality) WINDOW w AS (PARTITION BY product_id ORDER BY valid_from, content_version_id))
WHERE prev_tier_index IS NOT NULL""")
def d06(t):
    """Content versions and whether each tier change is a single step."""
    return D.tier_steps(t.view("product_content_quality"))


@query("d07_content_tier", ("product_content_quality",), """
SELECT content_version_id, CASE WHEN image_count >= 5 AND image_quality_score >= 0.9 AND description_length >= 250 THEN 'Excellent'
  WHEN image_count >= 3 AND image_quality_score >= 0.7 AND description_length >= 120 THEN 'Good'
  WHEN image_count >= 1 AND image_quality_score >= 0.4 AND description_length >= 50 THEN 'Average' ELSE 'Poor' END AS derived_tier
FROM product_content_quality""")
def d07(t):
    """Content tier derived from images, image score and description length."""
    c = t.view("product_content_quality")
    return c.select("content_version_id", D.content_tier(F.col("image_count"), F.col("image_quality_score"),
                                                         F.col("description_length"), F.lit(0)).alias("derived_tier"))


@query("d09_review_delay", ("product_reviews", "transactions"), """
SELECT r.review_id, datediff('day', CAST(t.transaction_time AS DATE), r.review_date) AS delay_days,
  datediff('day', CAST(t.transaction_time AS DATE), r.review_date) BETWEEN 0 AND 14 AS within_window
FROM product_reviews r JOIN transactions t USING (transaction_id)""")
def d09(t):
    """Days from purchase to review and whether within 0-14."""
    j = t.view("product_reviews").join(t.view("transactions").select("transaction_id", "transaction_time"), "transaction_id")
    d = D.review_delay(F.col("transaction_time"), F.col("review_date"))
    return j.select("review_id", d["delay_days"].alias("delay_days"), d["within_window"].alias("within_window"))


@query("d10_customer_type_profile", ("customers",), """
SELECT customer_type, count(*) AS customers, count(*) FILTER (WHERE email IS NULL) AS without_email,
  count(*) FILTER (WHERE signup_date IS NULL) AS without_signup,
  count(*) FILTER (WHERE customer_type = 'Retail Walk-In' AND signup_date IS NOT NULL) +
  count(*) FILTER (WHERE customer_type IN ('Online Only', 'Omnichannel') AND email IS NULL) AS rule_breaks
FROM customers GROUP BY 1""")
def d10(t):
    """Field presence per customer type against its profile rules."""
    c = t.view("customers")
    return c.groupBy("customer_type").agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(F.col("email").isNull()).alias("without_email"),
        F.count_if(F.col("signup_date").isNull()).alias("without_signup"),
        (F.count_if((F.col("customer_type") == "Retail Walk-In") & F.col("signup_date").isNotNull())
         + F.count_if(F.col("customer_type").isin("Online Only", "Omnichannel") & F.col("email").isNull())).alias("rule_breaks"))


@query("d11_age_at_signup", ("customers",), """
SELECT customer_id, age, age BETWEEN 18 AND 85 AS in_range FROM (
 SELECT customer_id, CAST(year(signup_date) - year(dob) - CASE WHEN month(signup_date) < month(dob)
   OR (month(signup_date) = month(dob) AND day(signup_date) < day(dob)) THEN 1 ELSE 0 END AS INTEGER) AS age
 FROM customers WHERE signup_date IS NOT NULL)""")
def d11(t):
    """Age at signup in whole years and whether it lies in 18-85."""
    c = t.view("customers").where(F.col("signup_date").isNotNull())
    a = D.age_at(F.col("dob"), F.col("signup_date"))
    return c.select("customer_id", a.alias("age"), a.between(18, 85).alias("in_range"))
