"""Categories bought together, and how focused baskets are."""

from __future__ import annotations

from aislekit.operators import affinity as A
from aislekit.plans.derived import _memo
from aislekit.plans.registry import query

_PAIRS = """SELECT a.category, b.category AS neighbour, count(*) AS baskets FROM (SELECT DISTINCT transaction_id, category FROM basket_items) a
JOIN (SELECT DISTINCT transaction_id, category FROM basket_items) b ON a.transaction_id = b.transaction_id AND a.category <> b.category GROUP BY 1, 2"""
_TOP = """SELECT category, neighbour, baskets, round(baskets / own, 6) AS share, rank FROM (
  SELECT p.*, o.own, CAST(row_number() OVER (PARTITION BY p.category ORDER BY baskets DESC, neighbour) AS INTEGER) AS rank FROM pairs p
  JOIN (SELECT category, count(DISTINCT transaction_id) AS own FROM basket_items GROUP BY 1) o ON o.category = p.category) WHERE rank <= 2"""


def neighbours(t):
    return _memo(t, "__neighbours", lambda: A.co_affinity(t.view("basket_items"), top=2))


@query("b21_co_affinity", ("basket_items",), "SELECT * FROM top", {"pairs": _PAIRS, "top": _TOP})
def b21(t):
    """Each category's two nearest categories by common baskets."""
    return neighbours(t)


@query("b21_basket_focus", ("basket_items",), """
SELECT transaction_id, seed, count(*) AS lines, count(*) FILTER (near) AS inside, round(count(*) FILTER (near) / count(*), 6) AS share FROM (
  SELECT b.transaction_id, s.seed, b.category = s.seed OR EXISTS (SELECT 1 FROM top WHERE top.category = s.seed AND top.neighbour = b.category) AS near
  FROM basket_items b JOIN (SELECT transaction_id, arg_min(category, product_id) AS seed FROM basket_items GROUP BY 1) s ON s.transaction_id = b.transaction_id)
GROUP BY 1, 2""", {"pairs": _PAIRS, "top": _TOP})
def b21_focus(t):
    """Share of each basket's lines inside its first category and that one's neighbours."""
    return A.basket_focus(t.view("basket_items"), neighbours(t))
