import json
import random

import pytest
from pyspark.sql import functions as F

from ludolens.sources import read_catalogue, read_json_list

PARTS = ["a", "}", "{", '"', "\\", "]", "[", ",", "é", "\n", '"apps": [{', '\\"', "}}", " "]


@pytest.fixture
def small_blocks(spark):
    """Blocks of 900 bytes, so that a file of some kilobytes is read by many tasks."""
    sizes = {"spark.sql.files.maxPartitionBytes": "900", "spark.sql.files.openCostInBytes": "0"}
    for name, size in sizes.items():
        spark.conf.set(name, size)
    yield spark
    for name in sizes:
        spark.conf.unset(name)


def apps(seed, n):
    rng = random.Random(seed)
    listed = []
    for i in range(n):
        app = {"appid": i, "name": "".join(rng.choice(PARTS) for _ in range(rng.randrange(8)))}
        if rng.random() < 0.2:
            app["more"] = {"of": [{"x": app["name"]}, {}], "tags": ["}", "]"]}
        listed.append(app)
    return listed


def write(path, document, **how):
    path.write_text(json.dumps(document, **how), encoding="utf-8")
    return str(path)


def in_order(df):
    return [json.loads(r["element"]) for r in df.orderBy("position").collect()]


@pytest.mark.parametrize("how", [{"indent": 2}, {"separators": (",", ":"), "ensure_ascii": False}])
def test_lists_equal_the_whole_document(small_blocks, tmp_path, how):
    listed = apps(len(how), 80)
    found = read_json_list(small_blocks, write(tmp_path / "array.json", listed, **how))
    assert in_order(found) == listed
    around = {"note": 'a}"{', "applist": {"first": [{"appid": 7}], "apps": listed, "last": [{"appid": 8}]}, "x": [{}]}
    path = write(tmp_path / "envelope.json", around, **how)
    assert in_order(read_json_list(small_blocks, path, ["applist", "apps"])) == listed


def test_one_file_is_read_by_many_tasks(small_blocks, tmp_path):
    path = write(tmp_path / "array.json", apps(1, 200))
    blocks = read_json_list(small_blocks, path).select(F.countDistinct("position.block")).first()[0]
    assert blocks > 10


def test_catalogue_of_several_files(small_blocks, tmp_path):
    for i in range(3):
        write(tmp_path / f"{i}.json", {"applist": {"apps": apps(i, 30 * i)}})
    found = read_catalogue(small_blocks, str(tmp_path)).orderBy("position").collect()
    assert [(r["appid"], r["name"]) for r in found] == [
        (a["appid"], a["name"]) for i in range(3) for a in apps(i, 30 * i)
    ]


@pytest.mark.parametrize(
    "document, names",
    [
        ([], None),
        ({"applist": {"apps": []}}, ["applist", "apps"]),
        ({"applist": {"apps": [], "other": [{"appid": 1}]}}, ["applist", "apps"]),
        ({"applist": {"other": [{"appid": 1}]}}, ["applist", "apps"]),
        ([None, 1, "{"], None),
    ],
)
def test_lists_without_objects(spark, tmp_path, document, names):
    assert read_json_list(spark, write(tmp_path / "x.json", document), names).count() == 0


def test_elements_that_are_no_objects_and_cut_files(spark, tmp_path, rows):
    path = write(tmp_path / "mixed.json", [None, {"appid": 1, "name": "a"}, 5, {"appid": None}, {}])
    assert rows(read_catalogue(spark, path, "array"), "appid", "name") == [(1, "a"), (None, None), (None, None)]
    (tmp_path / "cut.json").write_text('[{"appid": 1, "name": "a"}, {"appid": 2, "na')
    assert rows(read_catalogue(spark, str(tmp_path / "cut.json"), "array"), "appid")[0] == (1,)
    (tmp_path / "empty.json").write_text("")
    assert read_catalogue(spark, str(tmp_path / "empty.json"), "array").count() == 0
