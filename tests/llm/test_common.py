import os
import re

from prepframe.llm.common import probably_in
from prepframe.operators.components import connected_components


def test_bitmap_loses_nothing(spark):
    df = spark.range(5000).withColumnRenamed("id", "doc_id")
    wanted = spark.range(0, 5000, 7).withColumnRenamed("id", "rep")
    got = {r[0] for r in probably_in(df, "doc_id", wanted, bits=14).collect()}
    assert set(range(0, 5000, 7)) <= got and len(got) < 1500
    assert probably_in(df, "doc_id", wanted.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 105), (105, 103), (7, 7), (200, 201), (200, 201)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert all(got[i] == 0 for i in range(61)) and got[100] == got[103] == got[105] == 100 and got[201] == 200
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_nothing_else_imports_the_subpackage():
    root = os.path.join(os.path.dirname(__file__), "..", "..", "prepframe")
    for at, _dirs, files in os.walk(root):
        if os.sep + "llm" in at:
            continue
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(at, f)) as fh:
                    assert not re.search(r"prepframe\.llm|corpus_pipeline|from \.+llm", fh.read()), f
