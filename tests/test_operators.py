import datetime
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludolens import schemas
from ludolens.operators import dedup, details, ids, limits, ordering, outliers, regression, trends

TODAY = datetime.date(2025, 3, 2)
YESTERDAY = datetime.date(2025, 3, 1)


# --- one row per key


@pytest.fixture
def keyed(spark):
    data = [(1, "b", 2), (1, "a", 9), (2, None, 1), (2, "z", 0), (None, "q", 1), (None, "r", 1)]
    return spark.createDataFrame(data, "id int, t string, n int")


def test_dedup_and_keep_last(keyed, rows):
    assert rows(dedup.dedup(keyed, "id", ["n"])) == rows(
        keyed.where("(id = 1 and n = 2) or (id = 2 and n = 0) or t = 'q'")
    )
    assert rows(dedup.keep_last(keyed, "id", ["n"])) == rows(
        keyed.where("(id = 1 and n = 9) or (id = 2 and n = 1) or t = 'r'")
    )


def test_null_keys(keyed):
    assert dedup.null_key_count(keyed, "id").first()[0] == 2
    assert dedup.require_key(keyed, "id").count() == 4


def test_merge_is_idempotent_and_new_wins(spark, rows):
    old = spark.createDataFrame([(1, "x"), (2, "y"), (2, "w")], "id int, t string")
    new = spark.createDataFrame([(2, "a"), (3, "c"), (3, "b")], "id int, t string")
    once = dedup.merge_tables(old, new, "id")
    assert rows(once) == [(1, "x"), (2, "a"), (3, "c")]
    assert rows(dedup.merge_tables(once, new, "id")) == rows(once)
    assert rows(dedup.upsert(dedup.keep_last(old, "id"), new, "id")) == rows(once)
    assert rows(dedup.merge_tables(old.limit(0), new, "id")) == [(2, "a"), (3, "c")]


def test_upsert_without_broadcast(spark, rows, monkeypatch):
    old = spark.range(1000).select("id", F.lit("old").alias("t"))
    new = spark.range(500, 1500).select("id", F.lit("new").alias("t"))
    expected = rows(dedup.upsert(old, new, "id"))
    monkeypatch.setattr(dedup, "broadcast_small", lambda df: df)
    assert rows(dedup.upsert(old, new, "id")) == expected
    assert len(expected) == 1500 and sum(t == "old" for _, t in expected) == 500


# --- order across tasks


def test_numbers_are_a_permutation_in_order(spark):
    data = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"), F.lit("x").alias("t"))
    got = ordering.number_rows(data, [F.desc("v")]).collect()
    assert {r["v"]: r["row_index"] for r in got} == {v: 5000 - v for v in range(5000)}


def test_numbers_within_groups_one_of_them_hot(spark):
    data = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("g")
    )
    got = ordering.number_rows(data, ["id"], "place", within=["g"]).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["g"], []).append((r["id"], r["place"]))
    assert len(groups[None]) == 1000
    for members in groups.values():
        assert [p for _, p in sorted(members)] == list(range(1, len(members) + 1))


def test_numbers_within_groups_without_broadcast(spark, rows, monkeypatch):
    data = spark.range(500).select("id", (F.col("id") % 7).alias("g"))
    expected = rows(ordering.number_rows(data, ["id"], within=["g"]))
    monkeypatch.setattr(ordering, "broadcast_small", lambda df: df)
    assert rows(ordering.number_rows(data, ["id"], within=["g"])) == expected


def test_equal_order_spreads_over_parts(spark):
    data = spark.range(20000).select("id", F.lit(1).alias("same"))
    table = ordering._sorted_table(data, ["same"])
    sizes = [r["count"] for r in table.groupBy(ordering._part()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.7 * 20000


def test_running_total(spark):
    random.seed(3)
    values = [(i, random.randint(-5, 50)) for i in range(2000)]
    got = ordering.running_total(spark.createDataFrame(values, "k int, v int"), ["k"], "v")
    before, expected = 0, {}
    for k, v in values:
        expected[k], before = before, before + v
    assert {r["k"]: r["before"] for r in got.collect()} == expected


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "k int, v int")
    assert ordering.number_rows(none, ["k"]).count() == 0
    assert ordering.running_total(none, ["k"], "v").count() == 0
    assert ordering.assign_batches(none, ["k"], 10).count() == 0
    assert outliers.quartiles(none, "v").first().asDict() == {"q1": None, "q3": None}
    assert outliers.flag_outliers(none, "v").count() == 0
    assert limits.json_size(none).first()["bytes"] == 2
    assert limits.cap_by_bytes(none, "k", 10, ["v"]).count() == 0
    assert trends.rank_genres(spark.createDataFrame([], "appid int, genres array<string>, release_year int")).count() == 0


@pytest.mark.parametrize("size,batches", [(100, 3), (250, 1), (7, 36)])
def test_batches_are_full_and_dense(spark, size, batches):
    got = ordering.assign_batches(spark.range(250), ["id"], size).collect()
    assert all(r["batch_no"] == r["id"] // size for r in got)
    assert {r["batch_no"] for r in got} == set(range(batches))


def test_top_k_both_ways(spark, rows, monkeypatch):
    data = spark.range(400).select("id", (F.col("id") % 4).alias("g"))
    few = rows(ordering.top_k(data, 5, [F.desc("id")]))
    few_within = rows(ordering.top_k(data, 5, [F.desc("id")], within=["g"]))
    monkeypatch.setattr(ordering, "FIRST_ROWS", 1)
    assert rows(ordering.top_k(data, 5, [F.desc("id")])) == few
    assert rows(ordering.top_k(data, 5, [F.desc("id")], within=["g"])) == few_within
    assert len(few) == 5 and len(few_within) == 20


def test_ties_break_alike_on_both_paths(spark, monkeypatch):
    data = spark.range(3000).select("id", F.lit(1).alias("same")).repartition(7)
    few = {r["id"] for r in ordering.first_rows(data, ["same"], 1000).collect()}
    many = {r["id"] for r in ordering.first_rows(data.repartition(3), ["same"], 1001).collect()}
    assert len(few) == 1000 and len(many) == 1001 and few < many


def test_equal_rows_spread_over_parts(spark):
    data = spark.range(4000).select(F.lit(1).alias("v"))
    numbered = ordering.number_rows(data, ["v"])
    assert numbered.select("row_index").distinct().count() == 4000


def test_dedup_prefers_the_fuller_copy(spark):
    data = [(1, None, "$5"), (1, "Real", "$5"), (1, "Real", None), (2, None, None)]
    kept = dedup.dedup(spark.createDataFrame(data, "id int, name string, price string"), "id")
    assert {tuple(r) for r in kept.collect()} == {(1, "Real", "$5"), (2, None, None)}


def test_rows_without_a_batch_are_kept(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (2, "c")], "batch_no bigint, v string")
    assert limits.cap_by_bytes(df, "batch_no", 10**9, ["v"]).count() == 3
    assert [r["v"] for r in limits.cap_by_bytes(df, "batch_no", 1, ["v"]).collect()] == ["a"]


# --- quartiles


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 10, 101, 1000])
def test_quartiles_equal_numpy(spark, n):
    random.seed(n)
    values = [round(random.choice([1.0, random.uniform(0, 9)]), 2) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    linear = outliers.quartiles(df, "v").first()
    assert linear["q1"] == pytest.approx(np.percentile(values, 25))
    assert linear["q3"] == pytest.approx(np.percentile(values, 75))
    ordered = sorted(values)
    nearest = outliers.quartiles(df, "v", "nearest").first()
    assert nearest["q1"] == ordered[int(0.25 * (n - 1) + 0.5)]
    assert nearest["q3"] == ordered[int(0.75 * (n - 1) + 0.5)]


def test_flags(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100, -90]] + [(None,)], "v double")
    flagged = outliers.flag_outliers(df, "v")
    assert {r["v"] for r in outliers.outliers_only(flagged).collect()} == {100.0, -90.0}
    preview = outliers.outlier_preview(flagged, 1, [F.desc("v")]).collect()
    assert [r["v"] for r in preview] == [100.0]
    with pytest.raises(ValueError):
        outliers.quartiles(df, "v", "other")


# --- trends


@pytest.fixture
def games(spark):
    data = [
        (1, ["a", "b"], ["d1"], 2020, 1.0),
        (2, ["b", "a"], ["d1"], 2020, 2.0),
        (3, ["a"], ["d2"], 2021, 4.0),
        (4, [], ["d1", "d2"], None, None),
        (None, ["a"], ["d2"], 2021, 7.0),
    ]
    schema = "appid int, genres array<string>, developers array<string>, release_year int, price_usd double"
    return spark.createDataFrame(data, schema)


def test_average_prices(games, rows):
    sets = trends.avg_price_trends(games).collect()
    assert {(r[0], tuple(r[1])): r[2] for r in sets} == {
        (2020, ("a", "b")): 1.0,
        (2020, ("b", "a")): 2.0,
        (2021, ("a",)): 5.5,
        (None, ()): None,
    }
    assert rows(trends.avg_price_trends(games, explode=True)) == [
        (2020, "a", 1.5),
        (2020, "b", 1.5),
        (2021, "a", 5.5),
        # The game without genres is not lost.
        (None, "Unknown", None),
    ]


def test_absurd_prices_are_left_out(spark, rows):
    prices = [(2020, ["a"], 1e20), (2020, ["a"], 3.0), (2021, ["a"], 1e30), (2021, ["a"], 4.125), (2022, ["a"], 1e30)]
    df = spark.createDataFrame(prices, "release_year int, genres array<string>, price_usd double")
    assert rows(trends.avg_price_trends(df, explode=True)) == [
        (2020, "a", (1e20 + 3) / 2),
        (2021, "a", 4.125),
        (2022, "a", None),
    ]


def test_ranks(games, rows):
    genres = trends.rank_genres(games, explode=True)
    assert rows(genres) == [
        (2020, "a", 2, 1), (2020, "b", 2, 2), (2021, "a", 1, 1), (None, "Unknown", 1, 1),
    ]
    developers = trends.rank_developers(games, explode=True)
    assert rows(developers, "rank", "release_year", "developers", "num_games_published") == [
        (1, 2020, "d1", 2),
        (2, None, "d1", 1),
        (3, None, "d2", 1),
        (4, 2021, "d2", 1),
    ]
    per_year = trends.rank_developers(games, per_year=True)
    assert per_year.where("release_year = 2020").first()["rank"] == 1


# --- ids, cache, quota, caps


def test_id_sets(spark, rows):
    every = spark.createDataFrame([(1,), (2,), (2,), (3,)], "appid bigint")
    done = spark.createDataFrame([(2,), (2,), (9,)], "appid bigint")
    none = done.limit(0)
    assert rows(ids.only_new(every, done)) == [(1,), (3,)]
    assert rows(ids.reset_if_complete(every, done)) == [(2,), (9,)]
    assert rows(ids.reset_if_complete(every, every.union(done))) == []
    assert rows(ids.reset_if_complete(none, done)) == [(2,), (9,)]


def test_cache(spark, rows):
    cache = spark.createDataFrame(
        [(1, "old", YESTERDAY), (1, "new", TODAY), (2, "x", YESTERDAY), (5, "y", TODAY)],
        "appid bigint, details string, fetched_date date",
    )
    wanted = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "appid bigint, batch_no int")
    served, missing = ids.split_cached(wanted, ids.fresh(cache, TODAY))
    assert rows(served, "appid", "details", "batch_no") == [(1, "new", 0)]
    assert rows(missing, "appid", "batch_no") == [(2, 0), (3, 1)]
    assert ids.fresh(cache, TODAY, ttl_days=1).count() == 4


@pytest.mark.parametrize("limit,left", [(100, 65), (35, 0), (10, 0)])
def test_quota(spark, limit, left):
    calls = spark.createDataFrame(
        [(TODAY, 30), (TODAY, 5), (YESTERDAY, 99)], "date date, calls bigint"
    )
    row = limits.remaining_quota(calls, TODAY, limit).first()
    assert (row["used"], row["remaining"]) == (35, left)
    assert limits.remaining_quota(calls.limit(0), TODAY, limit).first()["remaining"] == limit


@pytest.mark.parametrize("n", [0, 1, 40, 99])
def test_admit_both_ways(spark, rows, monkeypatch, n):
    misses = spark.range(50).select(F.col("id").alias("appid"))
    few = rows(limits.admit(misses, ["appid"], n))
    assert few == sorted([(i,) for i in range(min(n, 50))], key=repr)
    monkeypatch.setattr(ordering, "FIRST_ROWS", -1)
    assert rows(limits.admit(misses, ["appid"], n)) == few


def test_json_size_and_cap_follow_a_json_writer(spark):
    games = [{"appid": i, "name": "n" * i, "genres": ["é"] * (i % 3)} for i in range(40)]
    df = spark.createDataFrame(
        [(g["appid"], g["name"], g["genres"], g["appid"] // 10) for g in games],
        "appid bigint, name string, genres array<string>, batch_no int",
    )
    columns = ["appid", "name", "genres"]
    sizes = [len(json.dumps(games[: 10 * (b + 1)])) for b in range(4)]
    row = limits.json_size(df.select(*columns)).first()
    assert (row["bytes"], row["kb"], row["mb"]) == (sizes[3], sizes[3] / 1024, sizes[3] / 1024**2)

    def kept(cap):
        return limits.cap_by_bytes(df, "batch_no", cap, columns).count() // 10

    assert [kept(1), kept(sizes[0]), kept(sizes[0] + 1), kept(sizes[2]), kept(10**6)] == [1, 1, 2, 3, 4]


@pytest.mark.parametrize("first_round", [1, 7, 1000])
def test_rounds_stop_behind_the_cap(spark, tmp_path, first_round):
    path = str(tmp_path / "answers")
    spark.range(2000).select(
        "id", F.when(F.col("id") >= 10, F.floor(F.col("id") / 10)).alias("batch_no"), F.repeat(F.lit("é"), 5).alias("name")
    ).write.parquet(path)
    df, seen = spark.read.parquet(path), []

    def make(some):
        seen.append(some.count())
        return some.where("id % 3 > 0")

    whole = make(df)
    for cap in (0, 1, 3000, 9000, 10**7):
        del seen[:]
        expected = limits.cap_by_bytes(whole, "batch_no", cap, ["id", "name"])
        got = limits.make_until_bytes(df, "batch_no", cap, make, ["id", "name"], first_round=first_round)
        kept = sorted(r["id"] for r in got.collect())
        assert kept == sorted(r["id"] for r in expected.collect())
        # About as much is made as kept, and no row twice.
        assert sum(seen) <= max(1.5 * 1.5 * len(kept) + 30, first_round + 10) and sum(seen) <= 2000
        assert len(seen) <= 24


def test_each_round_is_measured_once(spark, monkeypatch):
    df = spark.range(2000).select("id", F.floor(F.col("id") / 10).cast("int").alias("batch_no"))
    calls, measure = [], limits.json_bytes
    monkeypatch.setattr(limits, "json_bytes", lambda part: calls.append(1) or measure(part))
    expected = sorted(r["id"] for r in limits.cap_by_bytes(df, "batch_no", 9000, ["id"]).collect())
    calls.clear()
    seen = []
    got = limits.make_until_bytes(df, "batch_no", 9000, lambda d: seen.append(1) or d, ["id"], first_round=50)
    assert sorted(r["id"] for r in got.collect()) == expected
    assert len(calls) == len(seen) > 1


def test_rounds_without_rows_or_without_results(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 6)], "id bigint, batch_no int")
    for some, make in ((df.limit(0), lambda d: d), (df, lambda d: d.where("id > 9"))):
        assert limits.make_until_bytes(some, "batch_no", 100, make, ["id"], first_round=1).collect() == []
    nothing = df.where("batch_no is null")
    assert limits.make_until_bytes(nothing, "batch_no", 100, lambda d: d, ["id"]).count() == 1


# --- details


def test_flatten_details(spark, rows):
    full = {
        "name": "A",
        "release_date": {"date": "1 Jan, 2020"},
        "price_overview": {"final_formatted": "$1"},
        "genres": [{"id": "1", "description": "Action"}, {"description": "RPG"}],
        "developers": ["d"],
        "publishers": ["p"],
    }
    bodies = [
        json.dumps({"10": {"success": True, "data": full}, "11": {"success": True, "data": {"name": "B"}}}),
        json.dumps({"12": {"success": False, "data": full}}),
        json.dumps({"13": {"success": True}}),
        json.dumps({"14": {"success": True, "data": {}}}),
        json.dumps({"15": {"success": True, "data": []}}),
        json.dumps({"16": {"success": True, "data": {"type": "dlc"}}}),
        "null",
        "not json",
        None,
    ]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "batch_no bigint, body string")
    got = {r["appid"]: r.asDict() for r in details.flatten_details(df, carry=["batch_no"]).collect()}
    assert set(got) == {10, 11, 16}
    assert got[10] == {
        "batch_no": 0,
        "appid": 10,
        "name": "A",
        "release_date": "1 Jan, 2020",
        "price": "$1",
        "genres": ["Action", "RPG"],
        "developers": ["d"],
        "publishers": ["p"],
    }
    assert got[11]["price"] is None and got[11]["genres"] == [] and got[11]["developers"] == []
    cached = details.cache_entries(details.successes(df), TODAY)
    assert {r["appid"] for r in cached.collect()} == {10, 11, 13, 14, 15, 16}
    served = details.flatten_data(cached)
    assert {r["appid"] for r in served.collect()} == {10, 11, 16}


def test_answers_are_read_without_their_ids_as_names(spark, rows):
    one = '{"success":true,"data":{"name":"\\u00e9 \\"7\\": x"}}'
    bodies = [
        *[f'{{"{i}":{one}}}' for i in ("5", "007", "99999999999999999999", "x5", "5x", "", "5\\n", "5\\u0030", "-5", "٣")],
        f'{{"5":{one},"6":{one},"5":{one},"0":{one}}}',
        f' {{ "5" : {one} }}',
        f'{{"5" : {one}}}',
        f"{{'5':{one}}}",
        '{"5":null,"6":{"success":true}}',
        '{"5":{"success":"yes"},"6":{"success":true,"data":[1.10]}}',
        '{"5":[1]}',
        f'{{"5":{one}',
        f'{{"5":{one},}}',
        f'{{"5":{one}}}}} {{"6":{one}}}',
        f'[{{"5":{one}}}]',
        '{"5',
        '{"5"',
        '{"5"}',
        '{"',
        "{}",
        "",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "n bigint, body string")
    read = F.from_json("body", schemas.DETAILS_ENVELOPE)
    plain = df.select("n", F.explode_outer(read).alias("_id", "_answer")).select(
        "n",
        F.expr("try_cast(_id as bigint)").alias("appid"),
        F.coalesce("_answer.success", F.lit(False)).alias("success"),
        F.when(F.col("_answer.success"), F.col("_answer.data")).alias("details"),
    )
    assert rows(details.answers(df, carry=["n"])) == rows(plain)
    wanted = rows(plain.where("success").drop("success"))
    assert rows(details.successes(df, carry=["n"])) == wanted and len(wanted) > 15
    text = F.col("body")
    read_as = {b: t for b, t in df.select(text, details._with_one_name(text)).collect()}
    assert read_as[bodies[0]] == read_as[bodies[1]] == f'{{"0":{one}}}' and read_as[bodies[3]] == bodies[3]


# --- model


def test_split_is_complete_disjoint_and_stable(spark, rows):
    df = spark.range(2000).select(F.col("id").alias("appid"))
    train, test = regression.split(df, "appid")
    other, _ = regression.split(df.repartition(7), "appid")
    assert train.count() + test.count() == 2000
    assert train.join(test, "appid").count() == 0
    assert rows(train) == rows(other)
    assert 1500 < train.count() < 1700


def test_model_equals_least_squares(spark):
    data = [(i, 2000 + i % 20, 3.0 * (i % 20) + (i % 7)) for i in range(500)]
    df = spark.createDataFrame(
        data + [(900, None, 1.0), (901, 2001, None)], "appid int, release_year int, price_usd double"
    )
    model = regression.fit_price_model(df)
    line = regression.ols(df.where("appid < 500"), "release_year", "price_usd").first()
    for r in regression.predict(model, df).collect():
        expected = line["intercept"] + line["slope"] * r["release_year"]
        assert r["predicted_price"] == pytest.approx(expected, abs=1e-4)
    assert regression.predict(model, df).count() == 500
