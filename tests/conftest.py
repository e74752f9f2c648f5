import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from ledgerwatch.schemas import RAW_COLUMNS, V_COLUMNS  # noqa: E402
from ledgerwatch.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return SF


def raw_pandas(n: int, fraud: int, seed: int = 7) -> pd.DataFrame:
    """Made-up transactions: arrivals with random gaps, log-normal amounts, fraud shifted in three features."""
    rng = np.random.default_rng(seed)
    label = np.zeros(n, "int32")
    label[rng.permutation(n)[:fraud]] = 1
    data = {v: rng.standard_t(6, size=n) for v in V_COLUMNS}
    for v, shift in (("V4", 1.5), ("V12", -2.0), ("V14", -2.5)):
        data[v] = data[v] + shift * label
    arrivals = np.cumsum(rng.gamma(2.0, 86400 / (2.0 * n), n))
    data["Time"] = np.floor(arrivals - arrivals[0])  # counted from the first transaction
    data["Amount"] = np.exp(rng.normal(3.2, 1.1, n)).round(2)
    data["Class"] = label
    return pd.DataFrame(data)[RAW_COLUMNS]


@pytest.fixture(scope="session")
def raw_pdf():
    return raw_pandas(200, 20)


@pytest.fixture(scope="session")
def raw_df(spark, raw_pdf):
    return spark.createDataFrame(raw_pdf)
