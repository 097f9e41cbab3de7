import datetime
import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ludolens import checks, schemas, scratch
from ludolens.operators import ids, ordering, trends
from ludolens.plans import (
    DailyPaths,
    clean_games,
    finish_day,
    ingest_details,
    plan_fetch,
    predict_prices,
    prepare_day,
    run_daily,
    update_catalogue,
)
from ludolens.plans import daily
from ludolens.plans.daily import take_in
from ludolens.sources import (
    load_cache,
    load_calls,
    load_processed,
    rate_table,
    read_catalogue,
    read_json_or_empty,
    read_or_empty,
    read_table,
    save_cache,
    save_processed,
    upsert_table,
    write_json,
    write_partitioned,
    write_table,
)

DAY = datetime.date(2025, 3, 1)
RATES = {"USD": 1.0, "EUR": 1.1}


@pytest.fixture
def rates(spark):
    return rate_table(spark, RATES)


@pytest.fixture
def raw(spark):
    data = [
        (1, None, "Dec 1, 2023", "$0.00", None, [" d "], ["p"]),
        (1, "later", "Dec 1, 2023", "$1.00", None, ["d"], ["p"]),
        (None, "no id", "2020", "$1.00", [], [], []),
        (None, "no id either", "2020", "$1.00", [], [], []),
        (2, "b", "soon", "9,99€", [" x", "y "], [], None),
        (3, "c", "13/1/2020", "€2,50", [], ["d"], ["p"]),
    ]
    return spark.createDataFrame(data, schemas.RAW_GAMES)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clean_games(raw, rates):
    seen = Observation("seen")
    got = {r["appid"]: r.asDict() for r in clean_games(raw, rates, seen=seen).collect()}
    assert seen.get == {"rows": 6, "null_keys": 2}
    assert set(got) == {1, 2, 3}
    # The copy with a name wins over the one without.
    assert got[1]["name"] == "later" and got[1]["price_category"] == "Paid"
    assert got[1]["genres"] == ["Unknown"] and got[1]["developers"] == ["d"]
    assert got[2]["genres"] == ["x", "y"] and got[2]["developers"] == []
    assert got[2]["publishers"] == ["Unknown"]
    assert (got[2]["price_usd"], got[2]["price_category"], got[2]["release_year"]) == (None, "Paid", None)
    assert (got[3]["price_usd"], got[3]["release_year"]) == (2.75, 2020)


def test_clean_schema(raw, rates):
    assert [(f.name, f.dataType) for f in clean_games(raw, rates).schema] == [
        (f.name, f.dataType) for f in schemas.CLEANED_GAMES
    ]


def test_clean_plan_broadcasts_lookups_shuffles_once_and_has_no_python(raw, rates):
    text = plan_text(clean_games(raw, rates))
    assert text.count("BroadcastHashJoin") == 2
    assert text.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in text and "Python" not in text and "Arrow" not in text


def test_clean_of_unique_ids_does_not_shuffle(raw, rates, rows):
    once = raw.where("name is null or name <> 'later'")
    unshuffled = clean_games(once, rates, unique=True)
    assert "Exchange hashpartitioning" not in plan_text(unshuffled)
    assert rows(unshuffled) == rows(clean_games(once, rates))


def test_broadcast_is_measured(spark):
    numbers = spark.range(1000)
    texts = numbers.select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert scratch.table_bytes(numbers) < 50_000 < scratch.table_bytes(texts)
    joined = lambda small: plan_text(spark.range(10).join(small, "id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in joined(scratch.broadcast_small(numbers))
        assert "BroadcastHashJoin" not in joined(scratch.broadcast_small(numbers, max_bytes=100))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_many_ids_in_small_files_are_not_broadcast(spark, tmp_path):
    spark.range(20_000).coalesce(1).write.parquet(str(tmp_path / "ids"))
    ids_read = spark.read.parquet(str(tmp_path / "ids"))
    small = scratch.broadcast_small(ids_read, max_bytes=1000)
    texts = spark.range(10).withColumn("t", F.lit("t"))
    assert "BroadcastHashJoin" in plan_text(texts.join(ids_read, "id"))
    assert "SortMergeJoin" in plan_text(texts.join(small, "id"))


def test_asked_ids_are_measured(spark, tmp_path, rates, monkeypatch):
    paths = DailyPaths.under(str(tmp_path))
    _list_apps(tmp_path, 5)
    prepare_day(spark, paths, DAY)
    _answer(spark, paths, [_good(1), _good(99), (0, json.dumps({"2": {"success": False}}), DAY)])
    measured = []
    monkeypatch.setattr(daily, "broadcast_small", lambda df: measured.append(df.columns) or df.hint("merge"))
    counted = take_in(spark, paths, DAY)
    assert ["_asked"] in measured
    assert counted == {"answers": 3, "unreadable": 0, "unasked": 1, "failed": 1}
    assert _left(spark, paths)["store"] == [1] and _left(spark, paths)["cache"] == [1]


def test_trend_aggregates_before_the_shuffle(spark):
    df = read_or_empty(spark, "/nowhere/at/all", schemas.CLEANED_GAMES)
    assert "partial_try_sum" in plan_text(trends.avg_price_trends(df, explode=True))


def test_scan_is_pruned_and_filtered(spark, tmp_path):
    path = str(tmp_path / "t")
    games = spark.createDataFrame([], schemas.CLEANED_GAMES)
    write_table(games, path)
    table = read_table(spark, path, schemas.CLEANED_GAMES)
    text = plan_text(trends.avg_price_trends(table.where("price_usd > 3")))
    assert "GreaterThan(price_usd,3.0)" in text
    assert "ReadSchema: struct<genres:array<string>,price_usd:double,release_year:int>" in text


def test_bloom_filters_are_written_and_skip_files(spark, tmp_path, rows):
    import pyarrow.parquet as pq

    # Even ids in any order: least and greatest value of each group say nothing.
    ids = spark.range(40_000).select((F.col("id") * 2).alias("appid")).repartition(4)
    sizes, scanned = {}, {}
    for name, bloom in (("plain", None), ("bloom", {"appid": 10_000})):
        path = str(tmp_path / name)
        write_table(ids, path, bloom=bloom)
        sizes[name] = sum(f.stat().st_size for f in (tmp_path / name).glob("part-*"))
        found = read_table(spark, path).where("appid in (501, 4000)")
        assert rows(found) == [(4000,)]
        plan = found._jdf.queryExecution().executedPlan()
        leaves = plan.collectLeaves()
        scanned[name] = sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
        assert sum(pq.read_metadata(f).num_rows for f in (tmp_path / name).glob("part-*")) == 40_000
    assert sizes["bloom"] > sizes["plain"]
    # One file of four holds the id.
    assert scanned["plain"] == 40_000 and scanned["bloom"] < 20_000


def test_ranking_moves_only_counts_to_one_task(spark):
    games = checks.clean_games(checks.raw_games(spark, "/root/testdata/sf0.001"), rate_table(spark, RATES))
    text = plan_text(trends.rank_developers(games))
    # The only single-partition exchange carries one row per sort partition.
    assert text.count("SinglePartition") == 1
    assert "BroadcastHashJoin" in text


def test_top_k_cuts_before_the_shuffle(spark):
    counts = spark.range(100).select("id", (F.col("id") % 3).alias("g"))
    within = plan_text(ordering.top_k(counts, 2, ["id"], within=["g"]))
    assert within.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan_text(ordering.first_rows(counts, ["id"], 2))


def test_fresh_cache_prunes_day_folders(spark, tmp_path):
    entries = [(i, "{}", DAY - datetime.timedelta(days=i)) for i in range(4)]
    save_cache(spark.createDataFrame(entries, schemas.DETAILS_CACHE), str(tmp_path / "cache"))
    fresh = ids.fresh(load_cache(spark, str(tmp_path / "cache")), DAY, ttl_days=1)
    assert fresh.count() == 2 and len(fresh.inputFiles()) >= 2
    assert "PartitionFilters: [isnotnull(fetched_date" in plan_text(fresh)


def test_new_ids_are_reduced_before_the_shuffle(spark):
    listed = spark.range(100).select((F.col("id") % 3).alias("appid"))
    text = plan_text(ids.only_new(listed, listed.limit(2)))
    assert "partial_max" in text or "partial_bool_or" in text
    assert "Join" not in text


def test_read_or_empty_and_round_trips(spark, tmp_path, raw, rows):
    path = str(tmp_path / "raw")
    assert read_or_empty(spark, path, schemas.RAW_GAMES).count() == 0
    write_table(raw, path, row_group_bytes=1 << 20)
    assert rows(read_or_empty(spark, path, schemas.RAW_GAMES)) == rows(raw)
    by_year = raw.withColumn("release_year", F.when(F.col("appid") > 1, F.col("appid").cast("int")))
    write_partitioned(by_year, path, "release_year")
    assert rows(read_table(spark, path, by_year.schema)) == rows(by_year)
    assert read_json_or_empty(spark, str(tmp_path / "none"), schemas.APP).count() == 0


def test_unreadable_table_is_an_error(spark, tmp_path):
    (tmp_path / "bad").write_text("not parquet")
    with pytest.raises(Exception):
        read_or_empty(spark, str(tmp_path / "bad"), schemas.APP).count()


def test_catalogue_layouts(spark, tmp_path, rows):
    apps = [{"appid": 1, "name": "a"}, {"appid": 2, "name": "b"}]
    (tmp_path / "envelope.json").write_text(json.dumps({"applist": {"apps": apps}}, indent=4))
    (tmp_path / "array.json").write_text(json.dumps(apps, indent=4))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(a) for a in apps))
    for layout in ("envelope", "array", "lines"):
        apps = read_catalogue(spark, str(tmp_path / f"{layout}.json"), layout)
        assert rows(apps, "appid", "name") == [(1, "a"), (2, "b")]
        assert [r["appid"] for r in apps.orderBy("position").collect()] == [1, 2]
    with pytest.raises(ValueError):
        read_catalogue(spark, str(tmp_path), "other")


@pytest.mark.parametrize("layout", ["envelope", "array", "lines"])
def test_last_in_the_list_wins(spark, tmp_path, rows, layout):
    apps = [{"appid": 1, "name": "Zulu old"}, {"appid": 2, "name": "b"}, {"appid": 1, "name": "Alpha new"}]
    body = {"envelope": json.dumps({"applist": {"apps": apps}}), "array": json.dumps(apps)}
    (tmp_path / "list.json").write_text(body.get(layout, "\n".join(map(json.dumps, apps))))
    old = spark.createDataFrame([(1, "known"), (3, "c")], schemas.APP)
    new = read_catalogue(spark, str(tmp_path / "list.json"), layout)
    assert rows(update_catalogue(old, new)) == [(1, "Alpha new"), (2, "b"), (3, "c")]


def test_empty_json_is_refused(spark, tmp_path):
    path = str(tmp_path / "apps")
    apps = spark.createDataFrame([(1, "a")], schemas.APP)
    assert write_json(apps, path)
    assert not write_json(apps.limit(0), path)
    assert read_json_or_empty(spark, path, schemas.APP).count() == 1


def test_processed_ids_overwrite_their_own_source(spark, tmp_path, rows):
    path = str(tmp_path / "done")
    save_processed(spark.createDataFrame([(1,), (1,), (2,)], "appid bigint"), path)
    more = load_processed(spark, path).union(spark.createDataFrame([(3,)], "appid bigint"))
    save_processed(more, path)
    assert rows(load_processed(spark, path)) == [(1,), (2,), (3,)]


def test_upsert_table_rewrites_only_touched_folders(spark, tmp_path, rows):
    path = str(tmp_path / "store")
    table = lambda: read_table(spark, path, schemas.APP).select("appid", "name")
    first = spark.range(200).select(F.col("id").alias("appid"), F.lit("old").alias("name"))
    upsert_table(spark, path, first, "appid", buckets=8)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    second = spark.createDataFrame([(5, "new"), (1000, "new")], schemas.APP)
    upsert_table(spark, path, second, "appid", buckets=8)
    kept = [p for p, t in before.items() if p.exists() and p.stat().st_mtime_ns == t]
    assert 6 <= len(kept) < len(before)
    upsert_table(spark, path, second, "appid", buckets=8)
    upsert_table(spark, path, second.limit(0), "appid", buckets=8)
    names = dict(table().collect())
    assert len(names) == 201 and [i for i, n in names.items() if n == "new"] == [5, 1000]


def test_scratch_is_the_folder_the_cluster_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert scratch.scratch_path(spark).startswith(named)


def test_plan_fetch(spark, rows):
    listed = spark.range(10).select(F.col("id").alias("appid"))
    done = spark.createDataFrame([(0,), (0,)], "appid bigint")
    cache = spark.createDataFrame(
        [(1, "{}", DAY), (2, "{}", DAY - datetime.timedelta(days=1))], schemas.DETAILS_CACHE
    )
    calls = spark.createDataFrame([(DAY, 3)], schemas.CALLS)
    plan = plan_fetch(listed, done, cache, calls, DAY, limit=8, batch_size=4)
    assert rows(plan.served, "appid", "batch_no") == [(1, 0)]
    assert rows(plan.to_fetch, "appid", "batch_no") == [(2, 0), (3, 0), (4, 0), (5, 1), (6, 1)]
    full = plan_fetch(listed, done, cache, calls, DAY, limit=3, batch_size=4)
    assert full.to_fetch.count() == 0 and full.served.count() == 1


def _body(appid, **data):
    return json.dumps({str(appid): {"success": True, "data": data}})


def test_ingest_keeps_the_latest_and_stops_at_the_cap(spark):
    responses = spark.createDataFrame(
        [
            (0, _body(1, name="a" * 300), DAY),
            (1, _body(1, name="b"), DAY),
            (1, _body(2, name="c" * 900), DAY),
            (2, _body(3, name="d"), DAY),
        ],
        schemas.RESPONSES,
    )
    store = spark.createDataFrame([(1, "old", None, None, [], [], []), (9, "kept", None, None, [], [], [])], schemas.RAW_GAMES)
    done = spark.createDataFrame([(9,)], "appid bigint")
    taken = ingest_details(responses, store, done, max_bytes=1000)
    assert {r["appid"]: r["name"][:4] for r in taken.store.collect()} == {1: "b", 2: "cccc", 9: "kept"}
    assert {r["appid"] for r in taken.processed.collect()} == {1, 2, 9}
    assert taken.rows.count() == 3
    everything = ingest_details(responses, store, done)
    assert {r["appid"] for r in everything.store.collect()} == {1, 2, 3, 9}


NEXT_DAY = DAY + datetime.timedelta(days=1)


def _list_apps(tmp_path, count):
    listed = {"applist": {"apps": [{"appid": i, "name": f"g{i}"} for i in range(1, count + 1)]}}
    (tmp_path / "downloaded_list").write_text(json.dumps(listed))


def _answer(spark, paths, answers, mode="overwrite"):
    write_table(spark.createDataFrame(answers, schemas.RESPONSES), paths.responses, mode=mode)


def _left(spark, paths):
    """What the next run starts from."""
    return {
        "calls": sorted((r["date"], r["calls"]) for r in load_calls(spark, paths.calls).collect()),
        "cache": sorted(r["appid"] for r in load_cache(spark, paths.cache).collect()),
        "processed": sorted(r["appid"] for r in load_processed(spark, paths.processed).collect()),
        "store": sorted(r["appid"] for r in read_table(spark, paths.store).collect()),
        "to_fetch": sorted(r["appid"] for r in read_table(spark, paths.to_fetch).collect()),
    }


def _good(i, day=DAY):
    data = dict(
        name=f"g{i}", price_overview={"final_formatted": f"${i}.50"}, genres=[{"description": "x"}],
        release_date={"date": f"{2000 + i % 5}"}, developers=["d"],
    )
    return (0, _body(i, **data), day)


def test_run_daily(spark, tmp_path, rates):
    paths = DailyPaths.under(str(tmp_path))
    _list_apps(tmp_path, 40)
    failed = (0, json.dumps({"31": {"success": False}}), DAY)
    answers = [*map(_good, range(1, 31)), failed, (0, "broken", DAY), _good(99), _good(32, NEXT_DAY)]
    seen = []

    def download():
        seen.append(read_table(spark, paths.to_fetch).count())
        _answer(spark, paths, answers)

    summary = run_daily(spark, paths, rates, DAY, download=download)
    assert seen == [40]
    assert (summary.rows, summary.null_keys) == (30, 0)
    assert (summary.answers, summary.unreadable, summary.unasked, summary.failed) == (33, 1, 1, 1)
    cleaned = read_table(spark, paths.cleaned, schemas.CLEANED_GAMES)
    assert cleaned.count() == 30 and cleaned.select("release_year").distinct().count() == 5
    assert read_table(spark, paths.trends).count() == 5
    assert read_table(spark, paths.outliers).count() == 30
    assert read_table(spark, paths.genre_ranks).count() == 5
    assert read_table(spark, paths.developer_ranks).count() == 5
    assert read_table(spark, paths.predictions).count() > 0
    left = _left(spark, paths)
    assert left["calls"] == [(DAY, 30)] and left["cache"] == left["store"] == list(range(1, 31))
    # An id that failed is done for this round, so that it does not block others.
    assert left["processed"] == list(range(1, 32))

    # Again on the same day: nothing is counted or stored twice.
    prepare_day(spark, paths, DAY)
    finish_day(spark, paths, rates, DAY)
    assert _left(spark, paths) == left

    # The next day only what was not tried is asked for, and old answers do not count.
    summary = run_daily(spark, paths, rates, NEXT_DAY)
    after = _left(spark, paths)
    assert after["to_fetch"] == list(range(32, 41))
    assert after["calls"] == [(DAY, 30), (NEXT_DAY, 1)]
    assert summary.answers == 1 and after["store"] == [*range(1, 31), 32]
    # Yesterday's cache is gone.
    assert after["cache"] == [32]

    # When every listed id is done the set starts anew.
    last = NEXT_DAY + datetime.timedelta(days=1)
    _answer(spark, paths, [_good(i, last) for i in range(33, 41)])
    run_daily(spark, paths, rates, last)
    assert load_processed(spark, paths.processed).count() == 0


def test_run_daily_leaves_no_intermediates(spark, tmp_path, rates):
    paths = DailyPaths.under(str(tmp_path))
    _list_apps(tmp_path, 12)
    _answer(spark, paths, [_good(i) for i in range(1, 13)])
    from pathlib import Path

    folder = Path(scratch.scratch_path(spark).removeprefix("file:")).parent
    before = set(folder.iterdir()) if folder.exists() else set()
    run_daily(spark, paths, rates, DAY)
    assert (set(folder.iterdir()) if folder.exists() else set()) == before


@pytest.mark.parametrize("ids", [[], [1], [2], [3], [4], [5]])
def test_price_model_on_small_days(spark, ids):
    from ludolens.operators.regression import split

    data = [(i, 2000 + i, float(i)) for i in ids]
    games = spark.createDataFrame(data, "appid bigint, release_year int, price_usd double")
    learn, held_out = (side.count() for side in split(games, "appid"))
    predicted = predict_prices(games)
    assert (predicted.model is None) == (learn == 0)
    assert predicted.rows.count() == (held_out if learn else 0)
    assert predicted.rows.columns == ["release_year", "actual_price", "predicted_price"]


def test_cached_details_are_taken_in(spark, tmp_path):
    paths = DailyPaths.under(str(tmp_path))
    write_json(spark.createDataFrame([(1, "a"), (2, "b")], schemas.APP), paths.catalogue)
    served = spark.createDataFrame([(1, '{"name":"cached"}', DAY, 0)], "appid bigint, details string, fetched_date date, batch_no bigint")
    write_table(served, paths.served)
    seen = take_in(spark, paths, DAY, buckets=2)
    assert set(seen.values()) == {0}
    assert [r["name"] for r in read_table(spark, paths.store).collect()] == ["cached"]
    assert load_calls(spark, paths.calls).first()["calls"] == 0
    assert [r[0] for r in load_processed(spark, paths.processed).collect()] == [1]
