import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scorewright.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("driver tables are not here")
    return SF


COLUMNS = (
    "PassengerId long, Pclass int, Name string, Sex string, Age double, SibSp int, Parch int, "
    "Ticket string, Fare double, Embarked string, Survived int"
)


@pytest.fixture(scope="session")
def five(spark):
    """Five passengers without a title in their names."""
    rows = [
        (1, 3, "Passenger 1", "male", 22.0, 1, 0, "A/5 21171", 7.25, "S", 0),
        (2, 1, "Passenger 2", "female", 38.0, 1, 0, "PC 17599", 71.2833, "C", 1),
        (3, 3, "Passenger 3", "female", 26.0, 0, 0, "STON/O2", 7.925, "S", 1),
        (4, 1, "Passenger 4", "female", 35.0, 1, 0, "113803", 53.1, "S", 1),
        (5, 3, "Passenger 5", "male", 35.0, 0, 0, "373450", 8.05, "S", 1),
    ]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def many(spark):
    """550 passengers whose outcome depends on sex, class and age."""
    import numpy as np

    rng = np.random.default_rng(42)
    rows = []
    for i in range(1, 551):
        pclass, sex = int(rng.integers(1, 4)), str(rng.choice(["male", "female"]))
        age, fare = float(max(0.0, rng.normal(30, 15))), float(max(0.0, rng.normal(50, 30)))
        z = 1.5 * (sex == "female") - 0.6 * (pclass - 2) - 0.01 * (age - 30)
        rows.append(
            (
                i, pclass, f"Doe, {rng.choice(['Mr', 'Mrs', 'Dr', 'Mlle'])}. P{i}", sex, age, int(rng.integers(0, 4)),
                int(rng.integers(0, 3)), f"T{i}", fare, str(rng.choice(["S", "C", "Q"])), int(rng.random() < 1 / (1 + np.exp(-z))),
            )
        )
    return spark.createDataFrame(rows, COLUMNS).cache()
