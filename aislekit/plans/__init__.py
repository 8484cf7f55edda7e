"""Query registry: every inventory operator wired to the driver tables.

``queries()`` maps a name to ``(spark, sf_dir) -> DataFrame`` and
``oracle_sql()`` maps the same name to DuckDB SQL over the same parquet
tables.  Names are the inventory ID in lower case plus a short name.
"""

from aislekit.plans.registry import QUERIES, oracle_sql, queries  # noqa: F401
