import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roadloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "roadloom-tests", spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def golden(spark):
    """A few hand-made routes with all the awkward rows; answers are worked out in the tests."""
    from roadloom.sources import route_files as rf

    def trip(start, end, **load):
        return (start, end, load)

    actual = [
        (0, "A", "s0", [trip("Rome", "Milan", milk=4, pens=4), trip("Milan", "Bergamo", milk=5)]),
        (1, "A", "s0", [trip("Rome", "Milan", milk=4, pens=4), trip("Milan", "Bergamo", milk=5)]),
        (2, "A", "s10", [trip("Rome", "Milan", milk=9), trip("Milan", "Turin", pens=4)]),
        (3, "B", "s10", [trip("Turin", "Milan", tea=2)]),
        (4, "B", "s10", []),
        (5, "C", "s1", [trip("Rome", "Milan"), trip("Milan", "Rome"), trip("Rome", "Milan")]),
    ]
    standard = [
        (0, "s0", [trip("Rome", "Milan", milk=4, pens=4), trip("Milan", "Bergamo", milk=5)]),
        (1, "s1", [trip("Milan", "Rome", tea=1)]),
        (10, "s10", [trip("Turin", "Milan", tea=2), trip("Milan", "Turin", pens=1)]),
    ]
    route = rf.TRIP.simpleString()
    return (
        spark.createDataFrame(actual, f"rid bigint, driver string, sroute string, route array<{route}>"),
        spark.createDataFrame(standard, f"std_no bigint, sroute string, route array<{route}>"),
    )
