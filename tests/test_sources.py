"""Readers and writers: CSV trap, catalog stage-and-swap overwrite, file -> table, models."""

import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from prepframe.sources import io as IO


@pytest.fixture(scope="module")
def db(spark):
    name = "pf_" + uuid.uuid4().hex[:6]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tempfile.mkdtemp(prefix='pf-db-')}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_csv_malformed_rows_agree_across_actions(spark):
    d = tempfile.mkdtemp(prefix="pf-csv-")
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("id,x\n1,1.5\n2,oops\n3,2.5\n4\n")
    df = IO.read_csv(spark, d, schema="id int, x double")
    assert df.count() == 2 and len(df.collect()) == 2 and df.select("id").count() == 2


def test_write_table_overwrites_itself(spark, db):
    t = f"{db}.nums"
    IO.write_table(spark.range(5).withColumn("v", F.col("id") * 2), t)
    cur = IO.read_table(spark, t)
    IO.write_table(cur.where("id < 3"), t)  # reads and overwrites the same table
    assert IO.read_table(spark, t).count() == 3


def test_file_to_table_and_unknown_kind(spark, db):
    src = os.path.join(tempfile.mkdtemp(prefix="pf-pq-"), "p")
    spark.range(4).write.parquet(src)
    assert IO.file_to_table(spark, "parquet", src, f"{db}.fromfile").count() == 4
    with pytest.raises(ValueError):
        IO.file_to_table(spark, "xlsx", src, f"{db}.bad")


def test_model_save_load(spark):
    from prepframe.operators import models as MO

    df = spark.createDataFrame([(float(i), float(i % 2)) for i in range(20)], "x double, y double")
    m = MO.fit(df, ["x"], "y", MO.make_estimator("regression", "linear_regression"), "regression")
    path = os.path.join(tempfile.mkdtemp(prefix="pf-model-"), "m")
    IO.save_model(m.pipeline, path)
    back = IO.load_model(path)
    a = m.pipeline.transform(df).select("_pred").collect()
    b = back.transform(df).select("_pred").collect()
    assert a == b


def test_reload_of_estimator_and_fitted_model(spark, tmp_path):
    from prepframe.operators import models as M
    from prepframe.sources.io import load_model, save_model

    est = M.make_estimator("binary", "decision_tree", maxDepth=3)
    save_model(est, str(tmp_path / "est"))
    back = load_model(str(tmp_path / "est"))
    assert type(back) is type(est) and back.getMaxDepth() == 3
    rows = [(float(i % 7), float(i % 3), "a b" if i % 7 > 3 else "a-b") for i in range(60)] + [(None, 1.0, "a b")]
    df = spark.createDataFrame(rows, "x double, y double, lab string")
    m = M.fit(df, ["x", "y"], "lab", back, "binary")
    m.save(str(tmp_path / "m"))
    again = M.FittedModel.load(spark, str(tmp_path / "m"))
    a, b = (M.score(z, df) for z in (m, again))
    # no row is lost, labels that clean to one name keep both probabilities
    assert b.count() == 61 and b.where("prediction IS NULL").count() == 1 and {"p_a_b", "p_a_b_2"} <= set(b.columns)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_csv_without_schema_is_consistent(spark, tmp_path):
    from prepframe.sources.io import read_csv

    path = tmp_path / "d.csv"
    path.write_text("a,b\n1,2\n3,4,5\n6\n7,8\n")
    df = read_csv(spark, str(path))
    assert df.count() == len(df.collect()) == df.select("a").count()


def test_a_stop_between_the_renames_leaves_a_whole_table(spark, db):
    t = f"{db}.swap"
    IO.write_table(spark.range(5), t)
    # what a writer leaves that stops after the first rename
    spark.range(9).write.saveAsTable(f"{t}__stage")
    spark.sql(f"ALTER TABLE {t} RENAME TO {t}__old")
    assert IO.read_table(spark, t).count() == 5
    IO.write_table(IO.read_table(spark, t).where("id > 0"), t)  # reads the old version and replaces it
    assert IO.read_table(spark, t).count() == 4
    assert not spark.catalog.tableExists(f"{t}__old") and not spark.catalog.tableExists(f"{t}__stage")
    spark.sql(f"ALTER TABLE {t} RENAME TO {t}__old")
    IO.write_table(spark.range(3), t, mode="append")
    assert IO.read_table(spark, t).count() == 7
