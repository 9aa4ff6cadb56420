"""Run every query beside its SQL twin and print what differs: python tests/check_all.py [folder] [names...]"""

import os
import sys
import tempfile
import time

sys.path[:0] = [os.path.dirname(os.path.abspath(__file__)), os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

import oracle  # noqa: E402

from tidyloom.queries import ORACLES, QUERIES  # noqa: E402
from tidyloom.settings import build_session  # noqa: E402

if __name__ == "__main__":
    arguments = [a for a in sys.argv[1:] if not a.startswith("--")]
    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(QUERIES)
    settings = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    settings["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="tidyloom-check-")
    if "--split" in sys.argv:  # very many borders
        settings |= {"spark.tidyloom.bordersPerPartition": "400"}
    if "--zone" in sys.argv:  # results must not depend on the session's time zone
        settings["spark.sql.session.timeZone"] = "America/New_York"
    spark = build_session(master="local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle.connect(folder)
    bad = 0
    for name in names:
        started = time.time()
        try:
            frame = QUERIES[name](spark, folder)
            problems = oracle.differences(frame, ORACLES[name], connection) if name in ORACLES else [f"no SQL; {frame.count()} rows"]
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - started:.1f}s {' | '.join(problems)}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
