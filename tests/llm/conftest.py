import pytest

from tempolith.llm.registry import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    """Tasks find the package wherever the tests are started."""
    ship(spark)
