import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))  # for Python workers


@pytest.fixture(scope="session")
def spark():
    from berthline.session import get_session
    conf = {}
    # tests set their own shared folder only where the environment names none
    from pyspark import SparkConf
    if not SparkConf().get("spark.checkpoint.dir", None):
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="berthline-test-ckpt-")
    s = get_session(app="berthline-tests", master="local[4]", shuffle_partitions=4, conf=conf)
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
