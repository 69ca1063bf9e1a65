from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
# Python workers are started by the session and import the library too
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, (ROOT, os.environ.get("PYTHONPATH", ""))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tideline.session import session

    top = tmp_path_factory.mktemp("spark")
    out = session("tests", **{"spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.enabled": "false", "spark.checkpoint.dir": str(top / "shared"), "spark.sql.warehouse.dir": str(top / "warehouse")})
    out.sparkContext.setLogLevel("ERROR")
    return out
