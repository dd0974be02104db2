"""File bytes are read by the task that needs them and never shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from lodestone.sources import contents, readers


@pytest.fixture
def folder(tmp_path):
    for place, body in [("images_002/images/a.png", b"2i"), ("images_001/a.png", b"1"), ("b é+%20.png", b"top"), ("images_003/images/d.png", b"d"), ("c.png", b"x" * 3000)]:
        (tmp_path / place).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / place).write_bytes(body)
    return str(tmp_path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bytes_of_chosen_files(spark, folder, monkeypatch):
    want = {"a.png": b"2i", "b é+%20.png": b"top", "d.png": b"d", "c.png": b"x" * 3000}
    for at_once in (1, contents.BYTES_AT_ONCE):
        monkeypatch.setattr(contents, "BYTES_AT_ONCE", at_once)
        assert {r.image: bytes(r.content) for r in readers.read_images(spark, folder).collect()} == want
    monkeypatch.setattr(readers, "known_scheme", lambda *_: False)  # through Spark's own scan
    assert {r.image: bytes(r.content) for r in readers.read_images(spark, folder).collect()} == want


def test_no_exchange_and_no_scan_carries_content(spark, folder):
    listed = readers.list_images(spark, folder)
    labels = spark.createDataFrame([("a.png", 1), ("gone.png", 0), ("a.png", 2)], "image string, n int")
    got = contents.with_content(readers.with_images(labels, listed))
    assert sorted((r.image, r.n, r.is_missing, r.content and bytes(r.content)) for r in got.collect()) == [
        ("a.png", 1, False, b"2i"), ("a.png", 2, False, b"2i"), ("gone.png", 0, True, None)]
    for df in (got, readers.read_images(spark, folder)):
        lines = plan(df).splitlines()
        scans = [x for x in lines if "ReadSchema" in x]
        assert scans and all(re.search(r"ReadSchema: struct<path:string,length:bigint>", x) for x in scans)
        made = [x for x in lines if re.search(r"\bcontent#", x)]
        assert made and all(re.search(r"MapInArrow|Project", x) for x in made) and any("Exchange" in x for x in lines)


def test_class_folders_and_empty_listings(spark, tmp_path):
    for place in ("train/b/1.png", "train/a/2.png", "val/b/3.png"):
        (tmp_path / place).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / place).write_bytes(place.encode())
    got = readers.read_class_folders(spark, str(tmp_path))
    assert {(r.split, r.class_name, r.class_index, bytes(r.content)) for r in got.collect()} == {
        ("train", "b", 1, b"train/b/1.png"), ("train", "a", 0, b"train/a/2.png"), ("val", "b", 1, b"val/b/3.png")}
    assert contents.with_content(readers.list_images(spark, str(tmp_path)).limit(0)).count() == 0
    gone = spark.createDataFrame([("file:/nowhere/x.png", 1)], "path string, length long")
    with pytest.raises(Exception, match="nowhere"):
        contents.with_content(gone).collect()
    assert contents.with_content(gone.withColumns({"path": F.lit(None).cast("string"), "content": F.lit(3)})).first().content is None
