"""Oracle-side SQL for derived tables shared by several plans."""

LIFECYCLES = """
SELECT product_id, status, launch AS launch_date, CASE WHEN status = 'Discontinued' THEN changed_on END AS discontinuation_date,
  changed_on AS valid_from, nx AS valid_to, nx IS NULL AS is_current
FROM (SELECT *, lead(changed_on) OVER (PARTITION BY product_id ORDER BY changed_on, status) AS nx,
        min(changed_on) OVER (PARTITION BY product_id) AS launch
      FROM (SELECT product_id, changed_on, status FROM (
              SELECT product_id, changed_on, status, lag(status) OVER (PARTITION BY product_id ORDER BY changed_on, status) AS ps
              FROM lifecycle_changes) WHERE ps IS DISTINCT FROM status))
"""

LEDGER = """
SELECT store_id, product_id, event_timestamp, delta,
  sum(delta) OVER (PARTITION BY store_id, product_id ORDER BY event_timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stock_after
FROM inventory_change_events WHERE delta <> 0
"""

BAND = """CASE WHEN {c} BETWEEN 0 AND 0 THEN '0' WHEN {c} BETWEEN 1 AND 5 THEN '1-5' WHEN {c} BETWEEN 6 AND 20 THEN '6-20'
  WHEN {c} BETWEEN 21 AND 100 THEN '21-100' WHEN {c} BETWEEN 101 AND 10000000 THEN '101+' ELSE 'Overstocked' END"""

STATUS = """coalesce(CASE {b} WHEN '0' THEN 'Out of Stock' WHEN '1-5' THEN 'Limited Stock' WHEN '6-20' THEN 'Low Stock'
  WHEN '21-100' THEN 'In Stock' WHEN '101+' THEN 'Overstocked' END, '')"""

SNAPSHOTS = f"""
SELECT store_id, product_id, event_timestamp, delta, stock_after, stock_band, stock_status FROM (
  SELECT *, lag(stock_band) OVER w AS pb, lag(stock_status) OVER w AS ps FROM (
    SELECT *, {BAND.format(c='stock_after')} AS stock_band, {STATUS.format(b=BAND.format(c='stock_after'))} AS stock_status FROM ledger)
  WINDOW w AS (PARTITION BY store_id, product_id ORDER BY event_timestamp))
WHERE NOT (stock_band IS NOT DISTINCT FROM pb AND stock_status IS NOT DISTINCT FROM ps)
"""
