"""JSON sources: arrays, lines, malformed, blank and empty files."""

import pytest
from pyspark.sql.types import StructType

from postlens.sources import files as FS

SCHEMA = "id long, title string, tags array<string>"
FILES = {
    "array.json": '[{"id": 1, "title": "a", "tags": ["x", "y"]},\n {"id": 2}, 5, null, {"id": "no number", "title": 7}]',
    "spaced.json": '\n\n  [ {"title": "b", "id": 3} ]',
    "empty array.json": "[]",
    "lines.json": '\n{"id": 4, "title": "c"}\n   \n{broken\n{"id": 5, "title": null, "more": 1}\n7\n',
    "malformed.json": '[{"id": 6}, {"id": ',
    "blank.json": "  \n\n \n",
    "empty.json": "",
    "other.json": "hello\n",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_items_of_every_kind_of_file(spark, folder):
    got = sorted((r["id"] or 0, r["title"], r["tags"]) for r in FS.read_items(spark, folder, StructType.fromDDL(SCHEMA)).collect())
    assert got == [(0, "7", None), (1, "a", ["x", "y"]), (2, None, None), (3, "b", None), (4, "c", None), (5, None, None)]


def test_profile_of_every_kind_of_file(spark, folder):
    got = {r["file"].rsplit("/", 1)[1].replace("%20", " "): (r["format"], r["item_count"], r["malformed"], r["first_item_keys"])
           for r in FS.profile_source(spark, folder).collect()}
    assert got == {
        "array.json": ("array", 3, 2, ["id", "tags", "title"]),
        "spaced.json": ("array", 1, 0, ["id", "title"]),
        "empty array.json": ("array", 0, 0, None),
        "lines.json": ("jsonl", 2, 2, ["id", "title"]),
        "malformed.json": ("array", 0, 1, None),
        "other.json": ("unknown", 0, 1, None),
    }


def test_other_readers(spark, folder, tmp_path):
    assert FS.read_table_or_empty(spark, str(tmp_path / "missing"), SCHEMA).count() == 0
    assert [r["id"] for r in FS.read_table_or_empty(spark, folder + "/spaced.json", SCHEMA).collect()] == [3]
    out = str(tmp_path / "stored")
    spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "x")], "_id string, subreddit string").write.parquet(out)
    assert [r[0] for r in FS.scan(spark, out, ["_id"], limit=2, order="_id").collect()] == ["a", "b"]
    assert {r[0] for r in FS.existing_ids(spark.read.parquet(out), group_val="x").collect()} == {"a", "c"}
