import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from verify.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def pytest_configure(config):
    for name, meaning in {
        "literal": "one operator on rows written in the test",
        "tables": "whole runs and comparisons on the test tables",
    }.items():
        config.addinivalue_line("markers", f"{name}: {meaning}")


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are not available")
    return SMALL


@pytest.fixture(scope="session")
def movies(spark):
    """Six literal records with multi-value genres, one of them empty and one missing."""
    rows = [
        (11, "Kelp", 40.0, 130.0, "1987-11-30", 7.25, 512, 31.5, "Western|Noir", "pt"),
        (12, "Lantern", 12.5, 9.75, "1994-02-28", 5.5, 77, 4.25, "Noir|Western", "pt"),
        (13, "Marrow", 0.25, None, "", 2.75, 0, 0.5, None, "is"),
        (14, "Nettle", None, 3.5, "31/12/2001", None, None, None, "", "is"),
        (15, "Ochre", 8.0, 8.0, "2003-07-04", 9.0, 123, 6.0, "Opera", "fi"),
        (16, "Pumice", 95.0, 60.0, "1987-01-15", 6.5, 200, 12.0, "Silent Film|Western", "fi"),
    ]
    return spark.createDataFrame(
        rows,
        "id int, title string, budget_musd double, revenue_musd double, release_date string, vote_average double, "
        "vote_count int, popularity double, genres string, original_language string",
    )
