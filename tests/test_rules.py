"""Static checks of the library source against the execution rules."""

import os
import re

ROOT = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "prepframe")

FORBIDDEN = {
    r"\.crossJoin\(": "no cross joins",
    r"\.localCheckpoint\(": "lineage is cut with reliable checkpoints only",
    r"\bF\.udf\(|@udf\b|functions\.udf\(": "no row-at-a-time Python UDFs",
    r"\.toPandas\(": "nothing whole through the driver",
    r"\.rdd\b": "DataFrame API only",
}


def _sources():
    for root, _dirs, files in os.walk(ROOT):
        for f in files:
            if f.endswith(".py"):
                path = os.path.join(root, f)
                with open(path) as fh:
                    yield path, fh.read()


def test_forbidden_constructs_absent():
    hits = []
    for path, text in _sources():
        for pat, why in FORBIDDEN.items():
            if re.search(pat, text):
                hits.append(f"{os.path.relpath(path, ROOT)}: {why}")
    assert not hits, hits


def test_collects_are_bounded_or_documented():
    # every .collect() in the library sits next to a bound (limit / k rows / one row) comment or code
    unbounded = []
    for path, text in _sources():
        lines = text.splitlines()
        for i, line in enumerate(lines):
            if ".collect()" in line and "gc.collect()" not in line:
                ctx = " ".join(lines[max(0, i - 3): i + 2]).lower()
                if not re.search(r"limit|bounded|one row|k rows|rows\b|\[0\]|first|chunk|per column|classes|params|collect\(\)\[0\]|small", ctx):
                    unbounded.append(f"{os.path.relpath(path, ROOT)}:{i + 1}")
    assert not unbounded, unbounded
