import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from seasonline.session import CHECKPOINT_DIR, build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get(CHECKPOINT_DIR, None) is None:
        session.conf.set(CHECKPOINT_DIR, str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    if not pathlib.Path(SF_DIR).exists():
        pytest.skip("benchmark tables are not here")
    return SF_DIR


def rows(df, *order):
    """Collected rows as tuples, in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))
