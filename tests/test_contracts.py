"""Contracts on hand-made frames."""

import pytest

from aislekit.operators import contracts as V


def test_a_foreign_key_without_its_parent_is_an_error(spark):
    child = spark.createDataFrame([(1, 7), (2, 8), (3, None)], "id long, parent_id long")
    parent = spark.createDataFrame([(7,)], "parent_id long")
    contract = {"fk": {"parent_id": ("parents", "parent_id")}}
    with pytest.raises(ValueError, match="parents"):
        V.run_contract("children", child, contract)
    got = V.run_contract("children", child, contract, {"parents": parent}).collect()
    assert [tuple(r) for r in got] == [("children", "fk", "parent_id", 3, 1)]
