import pytest

from ledgerweave.operators.components import connected_components


def test_unsettled_components_are_an_error(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a int, b int")
    with pytest.raises(RuntimeError, match="not settled"):
        connected_components(chain, rounds=2)
