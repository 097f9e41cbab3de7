"""Every operator as a query on the test tables, with the same in plain SQL.

A query is ``(spark, folder) -> DataFrame``; its SQL runs in any engine with
the tables as views. Both give the same column names and values. Lists are
joined to text and years are labelled, so results compare as plain values.
"""

import datetime
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolens import fixed_values as fixed
from ludolens import schemas
from ludolens.functions.dates import release_year, year_label, year_prefix
from ludolens.functions.prices import valid_price
from ludolens.operators import currency, dedup, details, id_sets, ids, limits, ordering
from ludolens.operators import outliers, regression, trends
from ludolens.plans.clean import clean_games
from ludolens.plans.daily import DailyPaths, clean_store, finish_day, prepare_day, run_daily, write_reports
from ludolens.plans.fetch import capped_details, ingest_details, latest_details, plan_fetch, update_catalogue
from ludolens.plans.reports import detect_outliers, predict_prices
from ludolens.samples import RAW_GAMES_SQL, SAMPLE_RATES, raw_games, table
from ludolens.scratch import dropped_shuffles, scratch_path, write_scratch
from ludolens.sources.documents import (
    read_catalogue,
    read_json_or_empty,
    unwrap_apps,
    write_json,
)
from ludolens.sources.lookups import rate_table
from ludolens.sources.models import load_model, save_model
from ludolens.sources.state import (
    add_processed,
    load_cache,
    load_calls,
    load_processed,
    record_calls,
    save_cache,
    save_calls,
    save_processed,
)
from ludolens.sources.tables import (
    read_or_empty,
    read_table,
    upsert_table,
    write_partitioned,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]

TODAY = datetime.date(2024, 1, 30)

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _check(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query with its SQL, under ``name`` or its function's name."""

    def register(query: Query) -> Query:
        _QUERIES[name or query.__name__] = query
        _SQL[name or query.__name__] = sql
        return query

    return register


def queries() -> dict[str, Query]:
    """All queries by name."""
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """The SQL of each query."""
    return dict(_SQL)


# --- shared parts of the queries -------------------------------------------


def _rates(spark: SparkSession) -> DataFrame:
    return rate_table(spark, SAMPLE_RATES)


def _text(name: str) -> Column:
    return F.array_join(name, "|").alias(name)


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return clean_games(raw_games(spark, folder), _rates(spark))


def _labelled(df: DataFrame) -> DataFrame:
    """Years as labels and lists as text."""
    columns = [
        year_label(F.col(f.name)).alias(f.name)
        if f.name == "release_year"
        else _text(f.name)
        if f.dataType.typeName() == "array"
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*columns)


def _answers(spark: SparkSession, folder: str) -> DataFrame:
    """Details answers of today, one per raw game that has an id; one in eleven ids fails."""
    data = F.struct(
        "name",
        F.when(F.col("release_date") != "Coming Soon", F.struct(F.col("release_date").alias("date")))
        .alias("release_date"),
        F.when(F.col("price").isNotNull(), F.struct(F.col("price").alias("final_formatted")))
        .alias("price_overview"),
        F.transform("genres", lambda g: F.struct(g.alias("description"))).alias("genres"),
        "developers",
        "publishers",
    )
    answer = F.struct((F.col("appid") % 11 != 0).alias("success"), data.alias("data"))
    return raw_games(spark, folder).where(F.col("appid").isNotNull()).select(
        F.floor(F.col("appid") / 800).cast("bigint").alias("batch_no"),
        F.to_json(F.create_map(F.col("appid").cast("string"), answer)).alias("body"),
        F.lit(TODAY).alias("answered_date"),
    )


def _comparable(averages: DataFrame) -> DataFrame:
    """Averages rounded off the halves, where sums in another sequence could tip them."""
    return averages.withColumn("avg_price", F.round(F.col("avg_price") + 1e-8, 5))


def _call_log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("ts").cast("date").alias("date"), F.lit(1).cast("bigint").alias("calls")
    )


def _limit_for(log: DataFrame, more: int) -> int:
    """A daily limit that leaves ``more`` calls today, whatever the log holds."""
    return log.where(F.col("date") == F.lit(TODAY)).count() + more


def _cache(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").alias("appid"),
        F.col("props").alias("details"),
        F.col("ts").cast("date").alias("fetched_date"),
    )


def _apps(spark: SparkSession, folder: str, name: str) -> DataFrame:
    key = {"customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey"}[name]
    return table(spark, folder, name).select(
        F.col(key).alias("appid"), F.col(f"{key[0]}_name").alias("name")
    )


def _values(pairs: dict[str, str]) -> str:
    return ", ".join(f"('{k}', {v})" for k, v in pairs.items())


_SYMBOL_ROWS = _values({k: f"'{v}'" for k, v in fixed.CURRENCY_CODES.items()})
_RATE_ROWS = _values({k: f"cast({v} as decimal(18,12))" for k, v in SAMPLE_RATES.items()})

_PRICED_SQL = f"""
symbols(sign, iso) as (values {_SYMBOL_ROWS}),
rates(code, usd_per_unit) as (values {_RATE_ROWS}),
parsed as (
  select *,
    regexp_extract(price, '^([^\\d\\s]+)', 1) as symbol,
    try_cast(regexp_extract(replace(price, ',', '.'), '[\\d.]+', 0) as double) as amount
  from raw_games
),
priced as (
  select parsed.*, iso as currency_code,
    cast(round(cast(amount as decimal(18,6)) * usd_per_unit, 2) as double) as price_usd
  from parsed left join symbols on symbol = sign left join rates on iso = code
)
"""

_YEAR_SQL = """
case
  when regexp_matches(release_date, '^\\d{1,2}/\\d{1,2}/\\d{4}$') then coalesce(
    year(try_strptime(release_date, '%m/%d/%Y')), year(try_strptime(release_date, '%d/%m/%Y')))
  when regexp_matches(release_date, '^\\w{3} \\d{1,2}, \\d{4}$')
    then year(try_strptime(release_date, '%b %d, %Y'))
  when regexp_matches(release_date, '^\\d{1,2} \\w{3}, \\d{4}$')
    then year(try_strptime(release_date, '%d %b, %Y'))
  when regexp_matches(release_date, 'Q[1-4] \\d{4}')
    then try_cast(regexp_extract(release_date, '(\\d{4})', 1) as bigint)
  when regexp_matches(release_date, '^\\d{4}$') then try_cast(release_date as bigint)
end
"""

_RAW_ORDER = ", ".join(
    f"{c} nulls last"
    for c in ("name", "release_date", "price", "genres", "developers", "publishers")
)


def _cleaned_sql(source: str = "raw_games") -> str:
    return f"""
{_PRICED_SQL.replace("from raw_games", f"from {source}")},
cleaned as (
  select cast(appid as bigint) as appid, coalesce(name, 'Unknown') as name, release_date, price,
    list_transform(coalesce(genres, ['Unknown']), lambda g: trim(g)) as genres,
    list_transform(coalesce(developers, ['Unknown']), lambda g: trim(g)) as developers,
    list_transform(coalesce(publishers, ['Unknown']), lambda g: trim(g)) as publishers,
    price_usd, case when price_usd = 0 then 'Free' else 'Paid' end as price_category,
    {_YEAR_SQL} as release_year
  from (
    select *, row_number() over (partition by appid order by {_RAW_ORDER}) as copy
    from priced where appid is not null
  ) where copy = 1
)
"""


_CLEANED_SQL = f"with {RAW_GAMES_SQL}, {_cleaned_sql()}"
_LABEL = "coalesce(cast(release_year as varchar), 'Unknown')"
_CLEANED_COLUMNS = f"""
appid, name, release_date, price, array_to_string(genres, '|') as genres,
array_to_string(developers, '|') as developers, array_to_string(publishers, '|') as publishers,
price_usd, price_category, {_LABEL} as release_year
"""


# --- price and date text ----------------------------------------------------


@_check(f"""
with {RAW_GAMES_SQL}, {_PRICED_SQL}
select price, symbol, amount,
  case when regexp_matches(price, '^\\d+(\\.\\d{{1,2}})?$') then try_cast(price as double) end
    as listed_price
from parsed
""")
def parse_price(spark: SparkSession, folder: str) -> DataFrame:
    """Symbol and amount of every price text, and the validated plain price."""
    return currency.parse_price(raw_games(spark, folder)).select(
        "price", "symbol", "amount", valid_price(F.col("price")).alias("listed_price")
    )


@_check(f"""
with {RAW_GAMES_SQL}
select price, regexp_extract(price, '^([^\\d\\s]+)', 1) as symbol,
  try_cast(regexp_extract(regexp_replace(price, ',', '.'), '[\\d.]+', 0) as double) as amount
from raw_games
""")
def parse_price_first_comma(spark: SparkSession, folder: str) -> DataFrame:
    """The same with only the first comma taken as a decimal point."""
    parsed = currency.parse_price(raw_games(spark, folder), first_comma_only=True)
    return parsed.select("price", "symbol", "amount")


_USD_SQL = f"""
with {RAW_GAMES_SQL}, {_PRICED_SQL}
select appid, price, currency_code, price_usd from priced
"""


@_check(_USD_SQL)
def price_to_usd(spark: SparkSession, folder: str) -> DataFrame:
    """Every price in dollars."""
    coded = currency.with_currency(currency.parse_price(raw_games(spark, folder)))
    return currency.to_usd(coded, _rates(spark)).select(
        "appid", "price", "currency_code", "price_usd"
    )


@_check(f"""
with {RAW_GAMES_SQL}, {_PRICED_SQL}, coded as (
  select parsed.*, coalesce(iso, symbol) as currency_code
  from parsed left join symbols on symbol = sign
)
select appid, price, currency_code,
  cast(round(cast(amount as decimal(18,6)) * usd_per_unit, 2) as double) as price_usd
from coded left join rates on currency_code = code
""")
def price_to_usd_passthrough(spark: SparkSession, folder: str) -> DataFrame:
    """The same with unknown symbols taken as codes."""
    parsed = currency.parse_price(raw_games(spark, folder))
    coded = currency.with_currency(parsed, passthrough=True)
    return currency.to_usd(coded, _rates(spark)).select(
        "appid", "price", "currency_code", "price_usd"
    )


@_check(_USD_SQL)
def price_to_usd_udf(spark: SparkSession, folder: str) -> DataFrame:
    """The same through the vectorised function."""
    convert = currency.to_usd_udf(_rates(spark))
    coded = currency.with_currency(currency.parse_price(raw_games(spark, folder)))
    return coded.select(
        "appid", "price", "currency_code", convert("amount", "currency_code").alias("price_usd")
    )


@_check(f"""
with {RAW_GAMES_SQL}, dated as (select release_date, {_YEAR_SQL} as release_year from raw_games)
select release_date, {_LABEL} as release_year from dated
""", name="release_year")
def release_years(spark: SparkSession, folder: str) -> DataFrame:
    """The year of every release date text."""
    return raw_games(spark, folder).select(
        "release_date", year_label(release_year(F.col("release_date"))).alias("release_year")
    )


@_check("""
select substr(strftime(o_orderdate, '%Y-%m-%d'), 1, 4) as year, o_orderpriority,
  round(avg(o_totalprice) + 1e-8, 5) as avg_price
from orders group by 1, 2
""")
def year_prefix_avg(spark: SparkSession, folder: str) -> DataFrame:
    """Average price by the first four characters of an ISO date."""
    dated = table(spark, folder, "orders").select(
        year_prefix(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("year"),
        "o_orderpriority",
        "o_totalprice",
    )
    return _comparable(
        trends.avg_price_trends(dated, year="year", group="o_orderpriority", price="o_totalprice")
    )


# --- cleaning and keys ------------------------------------------------------


@_check(f"{_CLEANED_SQL} select {_CLEANED_COLUMNS} from cleaned", name="clean_games")
def cleaned_games(spark: SparkSession, folder: str) -> DataFrame:
    """The whole cleaning job."""
    return _labelled(_cleaned(spark, folder))


@_check(f"""
with {RAW_GAMES_SQL} select count(*) filter (appid is null) as null_keys from raw_games
""")
def null_key_count(spark: SparkSession, folder: str) -> DataFrame:
    """How many raw games have no id."""
    return dedup.null_key_count(raw_games(spark, folder), "appid")


_LINE_ORDER = [
    "l_shipdate",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
]


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select("l_orderkey", *_LINE_ORDER)


def _one_line_sql(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in _LINE_ORDER)
    return f"""
select l_orderkey, strftime(l_shipdate, '%Y-%m-%d') as shipped, l_linenumber, l_partkey,
  l_suppkey, l_extendedprice, l_quantity
from (
  select *, row_number() over (partition by l_orderkey order by {order}) as place from lineitem
) where place = 1
"""


def _with_text_date(df: DataFrame) -> DataFrame:
    return df.withColumn("shipped", F.date_format("l_shipdate", "yyyy-MM-dd")).drop("l_shipdate")


@_check(_one_line_sql("asc"))
def dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    """The first line of each order."""
    return _with_text_date(dedup.dedup(_lines(spark, folder), "l_orderkey", _LINE_ORDER))


@_check(_one_line_sql("desc"))
def keep_last(spark: SparkSession, folder: str) -> DataFrame:
    """The last line of each order."""
    return _with_text_date(dedup.keep_last(_lines(spark, folder), "l_orderkey", _LINE_ORDER))


@_check("""
select id, price, dated from (
  select *, row_number() over (partition by id order by batch desc, dated desc, price desc) as place
  from (
    select o_orderkey as id, o_totalprice as price, strftime(o_orderdate, '%Y-%m-%d') as dated,
      0 as batch from orders
    union all
    select l_orderkey, l_extendedprice, strftime(l_shipdate, '%Y-%m-%d'), 1 from lineitem
  )
) where place = 1
""")
def upsert_keep_last(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines merged over orders by order id."""
    old = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dated"),
    )
    new = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_extendedprice").alias("price"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("dated"),
    )
    return dedup.merge_tables(old, new, "id", ["dated", "price"])


_CATALOGUE_SQL = """
select coalesce(p_partkey, c_custkey) as appid,
  case when p_partkey is null then c_name else p_name end as name
from customer full join part on c_custkey = p_partkey
"""


@_check(_CATALOGUE_SQL)
def catalogue_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """A new catalogue over an old one."""
    return update_catalogue(
        _apps(spark, folder, "customer"), _apps(spark, folder, "part")
    )


@_check(_CATALOGUE_SQL)
def upsert_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same by rewriting the touched folders of a stored table."""
    path = scratch_path(spark)
    upsert_table(spark, path, _apps(spark, folder, "customer"), "appid", buckets=16)
    upsert_table(spark, path, _apps(spark, folder, "part"), "appid", buckets=16)
    return read_table(spark, path, schemas.APP).select("appid", "name")


# --- ids, cache, quota ------------------------------------------------------


@_check("select distinct user_id as appid from events")
def distinct_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Each user once."""
    return ids.distinct_ids(_cache(spark, folder))


@_check("""
select c_custkey as appid from customer
where not exists (select 1 from events where user_id = c_custkey)
""")
def only_new_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Customers without an event."""
    return ids.only_new(_apps(spark, folder, "customer"), _cache(spark, folder))


@_check("""
select c_custkey as appid from customer
where not exists (select 1 from events where user_id = c_custkey)
""")
def only_new_in_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Customers without an event, by words of ids."""
    seen = write_scratch(id_sets.from_ids(_cache(spark, folder)))
    return id_sets.to_ids(id_sets.without(id_sets.from_ids(_apps(spark, folder, "customer")), seen))


@_check("""
select 'union' as listed, count(distinct id) as ids, 0 as unprocessed, true as complete
from (select c_custkey as id from customer union all select l_orderkey from lineitem)
union all
select 'parts', (select count(*) from part),
  (select count(*) from part where p_partkey not in (select c_custkey from customer)),
  not exists (select 1 from part where p_partkey not in (select c_custkey from customer))
union all
select 'orders', (select count(distinct l_orderkey) from lineitem),
  (select count(distinct l_orderkey) from lineitem where l_orderkey not in (select o_orderkey from orders)),
  not exists (select 1 from lineitem where l_orderkey not in (select o_orderkey from orders))
""")
def set_completeness(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and superset tests on words of ids."""

    def of(name: str, key: str) -> DataFrame:
        return write_scratch(id_sets.from_ids(table(spark, folder, name), key))

    customers, lines = of("customer", "c_custkey"), of("lineitem", "l_orderkey")
    both = write_scratch(id_sets.union(customers, lines))
    told = {
        "union": (both, both),
        "parts": (of("part", "p_partkey"), customers),
        "orders": (lines, of("orders", "o_orderkey")),
    }
    found = [id_sets.completeness(*sets).select(F.lit(name).alias("listed"), "*") for name, sets in told.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


@_check("""
with latest as (
  select user_id, props, row_number() over (
    partition by user_id order by cast(ts as date) desc, props desc) as place
  from events
)
select c_custkey as appid, case when user_id is null then 'fetch' else 'cache' end as source,
  coalesce(props, '') as details
from customer left join latest on user_id = c_custkey and place = 1
""")
def cache_split(spark: SparkSession, folder: str) -> DataFrame:
    """Customers split into cached and missing."""
    wanted = ids.distinct_ids(_apps(spark, folder, "customer"))
    served, missing = ids.split_cached(wanted, _cache(spark, folder))
    return served.select("appid", F.lit("cache").alias("source"), "details").unionByName(
        missing.select("appid", F.lit("fetch").alias("source"), F.lit("").alias("details"))
    )


@_check("""
select user_id as appid, props as details, strftime(ts, '%Y-%m-%d') as fetched
from events where cast(ts as date) >= date '2024-01-29'
""")
def fresh_cache(spark: SparkSession, folder: str) -> DataFrame:
    """Cache entries at most one day old."""
    return ids.fresh(_cache(spark, folder), TODAY, ttl_days=1).select(
        "appid", "details", F.date_format("fetched_date", "yyyy-MM-dd").alias("fetched")
    )


@_check("""
select 'open' as listed, c_custkey as appid from customer
where exists (select 1 from part where p_partkey not in (select c_custkey from customer))
union all
select 'complete', p_partkey from part
where exists (select 1 from supplier where s_suppkey not in (select p_partkey from part))
""")
def reset_if_complete(spark: SparkSession, folder: str) -> DataFrame:
    """Processed ids kept while some listed id is missing, else none."""
    customers = _apps(spark, folder, "customer")
    parts = _apps(spark, folder, "part")
    suppliers = _apps(spark, folder, "supplier")
    open_list = ids.reset_if_complete(parts, customers)
    complete_list = ids.reset_if_complete(suppliers, parts)
    return open_list.select(F.lit("open").alias("listed"), "appid").unionByName(
        complete_list.select(F.lit("complete").alias("listed"), "appid")
    )


@_check("""
select cast(count(*) as bigint) as used, (select count(*) from events) - count(*) as remaining
from events where cast(ts as date) = date '2024-01-30'
""")
def remaining_quota(spark: SparkSession, folder: str) -> DataFrame:
    """Calls left today, of as many as all days made together."""
    log = _call_log(spark, folder)
    return limits.remaining_quota(log, TODAY, limit=log.count())


@_check("""
select o_orderkey as appid from (
  select o_orderkey, row_number() over (order by o_totalprice, o_orderkey) as place from orders
) where place <= (
  select count(*) // 2 from orders
)
""")
def admit_by_quota(spark: SparkSession, folder: str) -> DataFrame:
    """The cheapest orders, as many as calls are left: enough for half of them."""
    asked = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("appid"), "o_totalprice"
    )
    log = _call_log(spark, folder)
    left = limits.remaining_quota(log, TODAY, _limit_for(log, asked.count() // 2)).first()["remaining"]
    return limits.admit(asked, ["o_totalprice", "appid"], left).select("appid")


# --- numbering, batches, sizes ----------------------------------------------


@_check(f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  row_number() over (order by l_extendedprice desc, l_orderkey, {", ".join(_LINE_ORDER)})
    as row_index
from lineitem
""")
def row_index(spark: SparkSession, folder: str) -> DataFrame:
    """Every order line numbered, dearest first."""
    order = [F.desc("l_extendedprice"), "l_orderkey", *_LINE_ORDER]
    return ordering.number_rows(_lines(spark, folder), order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "row_index"
    )


@_check("""
select p_partkey, p_name,
  cast(floor((row_number() over (order by p_name, p_partkey) - 1) / 100) as bigint) as batch_no
from part
""")
def assign_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Parts in batches of 100 by name."""
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    return ordering.assign_batches(parts, ["p_name", "p_partkey"], fixed.BATCH_SIZE)


_EVENT_BYTES = """
(octet_length(encode(to_json({'event_id': event_id, 'event_type': event_type, 'props': props})))
  + 5 + 2)
"""


@_check(f"""
with batched as (
  select *, cast(floor((row_number() over (order by ts, event_id) - 1) / 100) as bigint) as batch_no
  from events
), sized as (
  select batch_no, sum({_EVENT_BYTES}) as size from batched group by 1
), summed as (
  select batch_no, coalesce(sum(size) over (
    order by batch_no rows between unbounded preceding and 1 preceding), 0) as before from sized
)
select event_id, batch_no from batched
where batch_no in (
  select batch_no from summed where before < (select sum(size) // 2 from sized) or before = 0)
""")
def cap_by_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Event batches up to half the size of all events."""
    events = table(spark, folder, "events").select("event_id", "ts", "event_type", "props")
    batched = ordering.assign_batches(events, ["ts", "event_id"], fixed.BATCH_SIZE)
    return _capped_at_half(batched).select("event_id", "batch_no")


def _capped_at_half(batched: DataFrame) -> DataFrame:
    counted = ["event_id", "event_type", "props"]
    half = limits.json_size(batched.select(*counted)).first()["bytes"] // 2
    return limits.cap_by_bytes(batched, "batch_no", half, counted)


@_check(f"""
with batched as (
  select *, cast(floor((row_number() over (order by ts, event_id) - 1) / 100) as bigint) as batch_no
  from events
), made as (
  select * from batched where event_type <> 'click'
), sized as (
  select batch_no, sum({_EVENT_BYTES}) as size from made group by 1
), summed as (
  select batch_no, coalesce(sum(size) over (
    order by batch_no rows between unbounded preceding and 1 preceding), 0) as before from sized
)
select event_id, batch_no from made
where batch_no in (
  select batch_no from summed where before < (select sum(size) // 3 from sized) or before = 0)
""")
def made_until_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Event batches without clicks, up to a third of their size; most of the rest is not looked at."""
    events = table(spark, folder, "events").select("event_id", "ts", "event_type", "props")
    batched = write_scratch(ordering.assign_batches(events, ["ts", "event_id"], fixed.BATCH_SIZE))
    counted = ["event_id", "event_type", "props"]
    unclicked = F.col("event_type") != "click"
    third = limits.json_size(batched.where(unclicked).select(*counted)).first()["bytes"] // 3
    first = batched.count() // 50
    made = limits.make_until_bytes(
        batched, "batch_no", third, lambda some: some.where(unclicked), counted, first_round=first
    )
    return made.select("event_id", "batch_no")


@_check(f"""
with batched as (
  select *, case when event_type <> 'click' then user_id % 97 end as batch_no from events
), sized as (
  select batch_no, sum({_EVENT_BYTES}) as size from batched group by 1
), summed as (
  select batch_no, coalesce(sum(size) over (order by batch_no nulls first
    rows between unbounded preceding and 1 preceding), 0) as before from sized
)
select event_id, batch_no from batched join summed using (batch_no)
where before < (select sum(size) // 2 from sized) or before = 0
union all
select event_id, batch_no from batched where batch_no is null
""")
def cap_null_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The same where events without a batch come first."""
    batched = table(spark, folder, "events").withColumn(
        "batch_no", F.when(F.col("event_type") != "click", F.col("user_id") % 97)
    )
    return _capped_at_half(batched).select("event_id", "batch_no")


@_check("""
select least(count(*), 1000) as few, least(count(*), 1001) as many, 0 as only_in_few from events
""")
def first_rows_ties(spark: SparkSession, folder: str) -> DataFrame:
    """First rows by an order of many ties: one row more only adds a row."""
    events = table(spark, folder, "events")
    few, many = (ordering.first_rows(events, ["event_type"], n).select("event_id") for n in (1000, 1001))
    told = few.withColumn("_few", F.lit(True)).join(many.withColumn("_many", F.lit(True)), "event_id", "full")
    return told.agg(
        F.count("_few").alias("few"),
        F.count("_many").alias("many"),
        F.count_if(F.col("_many").isNull()).alias("only_in_few"),
    )


@_check(f"""
with totals as (
  select 'events' as source, cast(sum({_EVENT_BYTES}) as bigint) as bytes from events
  union all
  select 'part', cast(sum(octet_length(encode(to_json({{'p_partkey': p_partkey, 'p_name': p_name,
    'p_size': p_size, 'p_retailprice': p_retailprice}}))) + 7 + 2) as bigint) from part
)
select source, bytes, bytes / 1024 as kb, bytes / (1024 * 1024) as mb from totals
""")
def json_size(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes of two tables as JSON."""
    events = table(spark, folder, "events").select("event_id", "event_type", "props")
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    return (
        limits.json_size(events)
        .withColumn("source", F.lit("events"))
        .unionByName(limits.json_size(parts).withColumn("source", F.lit("part")))
    )


# --- documents ---------------------------------------------------------------


@_check("""
select p_partkey as appid, p_name as name from part
union all select p_partkey, p_type from part
""")
def catalogue_from_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """Apps out of nested documents, here two apps in each."""
    app = "named_struct('appid', p_partkey, 'name', {})"
    texts = table(spark, folder, "part").selectExpr(
        f"to_json(named_struct('applist', named_struct('apps',"
        f" array({app.format('p_name')}, {app.format('p_type')})))) as body"
    )
    parsed = texts.select(F.from_json("body", schemas.APP_LIST).alias("d")).select("d.*")
    return unwrap_apps(parsed).select("appid", "name")


def _catalogue_files(spark: SparkSession, folder: str, wrap: str) -> str:
    """Parts as documents of at most 500 apps, each in a file of its own; returns their folder."""
    app = F.struct(F.col("p_partkey").alias("appid"), F.col("p_name").alias("name"))
    grouped = (
        table(spark, folder, "part")
        .groupBy(F.floor(F.col("p_partkey") / 500).alias("document"))
        .agg(F.array_sort(F.collect_list(app)).alias("apps"))
    )
    path = scratch_path(spark)
    texts = grouped.select(F.expr(f"to_json({wrap})").alias("value"), "document")
    texts.repartition("document").write.partitionBy("document").text(path)
    return path


@_check("select p_partkey as appid, p_name as name from part")
def read_catalogue_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """Apps read from files of one nested document each."""
    path = _catalogue_files(spark, folder, "named_struct('applist', named_struct('apps', apps))")
    return read_catalogue(spark, path, layout="envelope").select("appid", "name")


@_check("select p_partkey as appid, p_name as name from part")
def read_catalogue_array(spark: SparkSession, folder: str) -> DataFrame:
    """Apps read from files of one array each."""
    path = _catalogue_files(spark, folder, "apps")
    return read_catalogue(spark, path, layout="array").select("appid", "name")


@_check("""
with listed as (
  select p_size as appid, p_name as name, p_partkey // 500 as document, p_partkey as spot from part
), latest as (
  select appid, name from (
    select *, row_number() over (partition by appid order by cast(document as varchar) desc, spot desc)
      as place from listed
  ) where place = 1
)
select coalesce(l.appid, c_custkey) as appid, case when l.appid is null then c_name else l.name end as name
from customer full join latest l on c_custkey = l.appid
""")
def catalogue_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    """A new catalogue whose files list ids again and again, over an old one."""
    path = scratch_path(spark)
    app = F.struct("p_partkey", F.struct(F.col("p_size").alias("appid"), F.col("p_name").alias("name")).alias("app"))
    (
        table(spark, folder, "part")
        .groupBy(F.floor(F.col("p_partkey") / 500).cast("string").alias("document"))
        .agg(F.array_sort(F.collect_list(app)).alias("listed"))
        .select(F.to_json(F.struct(F.struct(F.col("listed.app").alias("apps")).alias("applist"))).alias("value"), "document")
        .repartition("document")
        .write.partitionBy("document")
        .text(path)
    )
    return update_catalogue(_apps(spark, folder, "customer"), read_catalogue(spark, path))


_FLAT_SQL = f"""
with {RAW_GAMES_SQL}, flat as (
  select cast(floor(appid / 800) as bigint) as batch_no, appid, name,
    case when release_date <> 'Coming Soon' then release_date end as release_date, price,
    coalesce(genres, []) as genres, coalesce(developers, []) as developers,
    coalesce(publishers, []) as publishers
  from raw_games where appid is not null and appid % 11 <> 0
)
"""
_FLAT_COLUMNS = """
appid, name, release_date, price, array_to_string(genres, '|') as genres,
array_to_string(developers, '|') as developers, array_to_string(publishers, '|') as publishers
"""


@_check(f"{_FLAT_SQL} select {_FLAT_COLUMNS} from flat")
def flatten_details(spark: SparkSession, folder: str) -> DataFrame:
    """Game rows out of details answers."""
    return _labelled(details.flatten_details(_answers(spark, folder)))


# --- trends and rankings ------------------------------------------------------

_AVG = "round(avg(price_usd) + 1e-8, 5)"


def _items_sql(column: str) -> str:
    return f"unnest(case when len({column}) > 0 then {column} else ['Unknown'] end)"


@_check(f"""
{_CLEANED_SQL}
select {_LABEL} as release_year, array_to_string(genres, '|') as genres, {_AVG} as avg_price
from cleaned group by release_year, cleaned.genres
""")
def avg_price_by_genre_set(spark: SparkSession, folder: str) -> DataFrame:
    """Average price by year and list of genres."""
    return _labelled(_comparable(trends.avg_price_trends(_cleaned(spark, folder))))


@_check(f"""
{_CLEANED_SQL}, single as (select release_year, {_items_sql("genres")} as genre, price_usd from cleaned)
select {_LABEL} as release_year, genre as genres, {_AVG} as avg_price
from single group by release_year, genre
""")
def avg_price_by_genre(spark: SparkSession, folder: str) -> DataFrame:
    """Average price by year and single genre."""
    return _labelled(_comparable(trends.avg_price_trends(_cleaned(spark, folder), explode=True)))


def _ranked_sql(column: str, count: str, within: str, per_item: bool, keep: str = "") -> str:
    source = f"select release_year, {_items_sql(column)} as item" if per_item else (
        f"select release_year, {column} as item"
    )
    item = "item" if per_item else "array_to_string(item, '|')"
    last = "" if within else ", release_year nulls first"
    return f"""
{_CLEANED_SQL}, items as ({source} from cleaned),
counted as (select release_year, item, count(*) as n from items group by all),
ranked as (
  select *, row_number() over ({within} order by n desc, item{last}) as rank from counted
)
select {_LABEL} as release_year, {item} as {column}, n as {count}, rank from ranked {keep}
"""


_GENRES = ("genres", "num_games_by_genre_per_year")
_DEVELOPERS = ("developers", "num_games_published")
_BY_YEAR = "partition by release_year"


@_check(_ranked_sql(*_GENRES, _BY_YEAR, per_item=False))
def rank_genres(spark: SparkSession, folder: str) -> DataFrame:
    """Lists of genres ranked within years."""
    return _labelled(trends.rank_genres(_cleaned(spark, folder)))


@_check(_ranked_sql(*_GENRES, _BY_YEAR, per_item=True))
def rank_single_genres(spark: SparkSession, folder: str) -> DataFrame:
    """Single genres ranked within years."""
    return _labelled(trends.rank_genres(_cleaned(spark, folder), explode=True))


@_check(_ranked_sql(*_DEVELOPERS, "", per_item=False))
def rank_developers_global(spark: SparkSession, folder: str) -> DataFrame:
    """Developers ranked over all years together."""
    return _labelled(trends.rank_developers(_cleaned(spark, folder)))


@_check(_ranked_sql(*_DEVELOPERS, _BY_YEAR, per_item=True))
def rank_developers_by_year(spark: SparkSession, folder: str) -> DataFrame:
    """Single developers ranked within years."""
    return _labelled(trends.rank_developers(_cleaned(spark, folder), per_year=True, explode=True))


@_check(_ranked_sql(*_DEVELOPERS, "", per_item=False, keep="where rank <= 10"))
def top_developers(spark: SparkSession, folder: str) -> DataFrame:
    """The ten first developers."""
    counts = trends.developer_counts(_cleaned(spark, folder))
    order = [F.desc("num_games_published"), "developers", "release_year"]
    return _labelled(ordering.top_k(counts, 10, order))


@_check(_ranked_sql(*_GENRES, _BY_YEAR, per_item=True, keep="where rank <= 3"))
def top_genres_by_year(spark: SparkSession, folder: str) -> DataFrame:
    """The three first genres of each year."""
    counts = trends.genre_counts(_cleaned(spark, folder), explode=True)
    order = [F.desc("num_games_by_genre_per_year"), "genres"]
    return _labelled(ordering.top_k(counts, 3, order, within=["release_year"]))


# --- outliers -----------------------------------------------------------------


def _bounds_sql(quartiles: str) -> str:
    return f"""
select round(q1, 6) as q1, round(q3, 6) as q3, round(q3 - q1, 6) as iqr,
  round(q1 - 1.5 * (q3 - q1), 6) as lower_bound, round(q3 + 1.5 * (q3 - q1), 6) as upper_bound
from ({quartiles})
"""


def _nearest_sql(column: str, source: str) -> str:
    return f"""
select max(case when place = round(0.25 * (n - 1)) then value end) as q1,
  max(case when place = round(0.75 * (n - 1)) then value end) as q3
from (
  select {column} as value, row_number() over (order by {column}) - 1 as place,
    count(*) over () as n from {source} where {column} is not null
)
"""


def _rounded(bounds: DataFrame) -> DataFrame:
    return bounds.select(*[F.round(c, 6).alias(c) for c in bounds.columns])


@_check(_bounds_sql("""
select quantile_cont(l_extendedprice, 0.25) as q1, quantile_cont(l_extendedprice, 0.75) as q3
from lineitem
"""))
def outlier_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """Interpolated quartiles and bounds of line prices."""
    return _rounded(outliers.iqr_bounds(_lines(spark, folder), "l_extendedprice"))


@_check(_bounds_sql(_nearest_sql("l_extendedprice", "lineitem")))
def outlier_bounds_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """Nearest-value quartiles and bounds of line prices."""
    return _rounded(outliers.iqr_bounds(_lines(spark, folder), "l_extendedprice", method="nearest"))


@_check("""
with bounds as (
  select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from events
)
select event_id, value, case when value < q1 - 1.5 * (q3 - q1) or value > q3 + 1.5 * (q3 - q1)
  then 1 else 0 end as price_outlier
from events, bounds
""")
def event_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Events with their outlier flag."""
    events = table(spark, folder, "events").select("event_id", "value")
    return outliers.flag_outliers(events, "value")


_FLAGGED_SQL = f"""
{_CLEANED_SQL}, bounds as (
  select quantile_cont(price_usd, 0.25) as q1, quantile_cont(price_usd, 0.75) as q3 from cleaned
), flagged as (
  select cleaned.*, case when price_usd < q1 - 1.5 * (q3 - q1)
    or price_usd > q3 + 1.5 * (q3 - q1) then 1 else 0 end as price_outlier
  from cleaned, bounds
)
"""


@_check(f"{_FLAGGED_SQL} select {_CLEANED_COLUMNS}, price_outlier from flagged")
def flag_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned games with their outlier flag."""
    return _labelled(detect_outliers(write_scratch(_cleaned(spark, folder))))


@_check(f"""
{_FLAGGED_SQL}
select appid, price_usd, price_outlier from flagged where price_outlier = 1
order by price_usd desc, appid limit 20
""")
def outlier_preview(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty dearest outliers."""
    flagged = detect_outliers(write_scratch(_cleaned(spark, folder)))
    return outliers.outlier_preview(flagged).select("appid", "price_usd", "price_outlier")


# --- price model ----------------------------------------------------------------


def _share_sql(key: str) -> str:
    return f"cast('0x' || substr(md5(cast({key} as varchar)), 1, 8) as bigint) % 100"


@_check(f"""
select o_orderkey, case when {_share_sql("o_orderkey")} < 80 then 'train' else 'test' end as side
from orders
""")
def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    """Orders split by a hash of their key."""
    train, test = regression.split(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    )


@_check("""
select round(regr_slope(l_extendedprice, year(l_shipdate) - 2000), 4) as slope,
  round(regr_intercept(l_extendedprice, year(l_shipdate) - 2000), 4) as intercept
from lineitem
""")
def ols_price(spark: SparkSession, folder: str) -> DataFrame:
    """Least-squares line of line price on year."""
    points = table(spark, folder, "lineitem").select(
        (F.year("l_shipdate") - 2000).alias("year"), "l_extendedprice"
    )
    line = regression.ols(points, "year", "l_extendedprice")
    return line.select(*[F.round(c, 4).alias(c) for c in line.columns])


_PREDICTED_SQL = f"""
{_CLEANED_SQL}, usable as (
  select release_year, price_usd, {_share_sql("appid")} < 80 as learn
  from cleaned where release_year is not null and price_usd is not null
), line as (
  select regr_slope(price_usd, release_year - 2000) as slope,
    regr_intercept(price_usd, release_year - 2000) as intercept
  from usable where learn
)
select cast(release_year as integer) as release_year, price_usd as actual_price,
  round(intercept + slope * (release_year - 2000), 2) as predicted_price
from usable, line where not learn
"""


def _to_cents(predicted: DataFrame) -> DataFrame:
    return predicted.withColumn("predicted_price", F.round("predicted_price", 2))


@_check(_PREDICTED_SQL, name="predict_prices")
def predicted_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out prices beside their predictions."""
    return _to_cents(predict_prices(write_scratch(_cleaned(spark, folder))).rows)


@_check(_PREDICTED_SQL)
def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The same by a model that was written and read back."""
    path = scratch_path(spark)
    train, test = regression.split(write_scratch(_cleaned(spark, folder)), "appid")
    save_model(regression.fit_price_model(train), path)
    return _to_cents(regression.predict(load_model(path), test))


# --- sources and sinks ------------------------------------------------------------

_ORDER_SQL = """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders
"""


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").drop("o_orderdate")


@_check(_ORDER_SQL)
def roundtrip_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written by priority and read back."""
    path = scratch_path(spark)
    orders = _orders(spark, folder)
    write_partitioned(orders, path, "o_orderpriority")
    return read_table(spark, path, orders.schema)


@_check(_ORDER_SQL)
def roundtrip_zstd(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written with zstd and small row groups and read back."""
    path = scratch_path(spark)
    write_table(_orders(spark, folder), path, row_group_bytes=1 << 20)
    return read_table(spark, path)


@_check("""
select o_orderkey, o_custkey from orders where o_custkey in (select s_suppkey from supplier where s_suppkey <= 5)
""")
def lookup_with_bloom(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of a few customers out of a table with a Bloom filter on them."""
    path = scratch_path(spark)
    write_table(table(spark, folder, "orders"), path, row_group_bytes=1 << 16, bloom={"o_custkey": 10_000})
    few = [r[0] for r in table(spark, folder, "supplier").where("s_suppkey <= 5").select("s_suppkey").collect()]
    return read_table(spark, path).where(F.col("o_custkey").isin(few)).select("o_orderkey", "o_custkey")


@_check(_ORDER_SQL, name="json_roundtrip")
def roundtrip_json(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as JSON lines and read back."""
    path = scratch_path(spark)
    orders = _orders(spark, folder)
    write_json(orders, path)
    return read_json_or_empty(spark, path, orders.schema)


@_check("select p_partkey as appid, p_name as name from part")
def roundtrip_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """A catalogue written as JSON lines and read back."""
    path = scratch_path(spark)
    write_json(_apps(spark, folder, "part"), path)
    return read_catalogue(spark, path, layout="lines").select("appid", "name")


@_check(_ORDER_SQL, name="read_or_empty")
def read_or_empty_table(spark: SparkSession, folder: str) -> DataFrame:
    """A stored table stacked on one that does not exist yet."""
    stored = _orders(spark, folder)
    missing = read_or_empty(spark, scratch_path(spark), stored.schema)
    return missing.unionByName(stored)


@_check("select distinct o_custkey as appid from orders")
def processed_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The processed-id set written and read back."""
    path = scratch_path(spark)
    save_processed(table(spark, folder, "orders").select(F.col("o_custkey").alias("appid")), path)
    return load_processed(spark, path)


@_check("select o_custkey as appid from orders union select c_custkey from customer union select l_orderkey from lineitem")
def processed_added(spark: SparkSession, folder: str) -> DataFrame:
    """Ids added twice to a stored set; what overlaps is stored once."""
    path = scratch_path(spark)
    save_processed(table(spark, folder, "orders").select(F.col("o_custkey").alias("appid")), path)
    for name, key in (("customer", "c_custkey"), ("lineitem", "l_orderkey")):
        add_processed(table(spark, folder, name).select(F.col(key).alias("appid")), path)
    return load_processed(spark, path)


@_check("""
select user_id as appid, props as details, strftime(ts, '%Y-%m-%d') as fetched
from events where cast(ts as date) >= date '2024-01-29'
""")
def cache_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """A cache written in folders by day; only fresh folders are read back."""
    path = scratch_path(spark)
    save_cache(_cache(spark, folder), path)
    return ids.fresh(load_cache(spark, path), TODAY, ttl_days=1).select(
        "appid", "details", F.date_format("fetched_date", "yyyy-MM-dd").alias("fetched")
    )


@_check("""
select cast(ts as date) as day, case when cast(ts as date) = date '2024-01-30' then 7
  else cast(count(*) as bigint) end as calls
from events group by 1
""")
def calls_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """A stored call log in which one day's count was set again, twice."""
    path = scratch_path(spark)
    save_calls(_call_log(spark, folder), path)
    record_calls(spark, path, TODAY, 6)
    record_calls(spark, path, TODAY, 7)
    calls = load_calls(spark, path)
    return calls.groupBy(F.col("date").alias("day")).agg(F.sum("calls").alias("calls"))


# --- whole jobs ---------------------------------------------------------------------


@_check("""
with wanted as (
  select p_partkey as appid, cast(floor((row_number() over (order by p_partkey) - 1) / 100)
    as bigint) as batch_no
  from part where not exists (select 1 from supplier where s_suppkey = p_partkey)
), cached as (
  select user_id, props, row_number() over (partition by user_id order by props desc) as place
  from events where cast(ts as date) = date '2024-01-30'
), missing as (
  select *, row_number() over (order by appid) as place from wanted
  where appid not in (select user_id from cached)
), quota as (
  select (select count(*) from missing) // 2 as remaining
)
select appid, batch_no, 'fetch' as source, '' as details from missing, quota
where place <= remaining
union all
select appid, batch_no, 'cache', props from wanted join cached on user_id = appid and place = 1
""", name="plan_fetch")
def planned_fetch(spark: SparkSession, folder: str) -> DataFrame:
    """Parts not yet supplied: served from the cache, or fetched in batches, half of those without an entry."""
    parts, suppliers = _apps(spark, folder, "part"), _apps(spark, folder, "supplier")
    cache, log = _cache(spark, folder), _call_log(spark, folder)
    today = ids.fresh(cache, TODAY).select("appid")
    missing = parts.join(suppliers.select("appid").union(today), "appid", "left_anti").count()
    plan = plan_fetch(parts, suppliers, cache, log, TODAY, limit=_limit_for(log, missing // 2))
    return plan.to_fetch.select(
        "appid", "batch_no", F.lit("fetch").alias("source"), F.lit("").alias("details")
    ).unionByName(
        plan.served.select("appid", "batch_no", F.lit("cache").alias("source"), "details")
    )


_LATEST_ORDER = ", ".join(
    f"{c} desc nulls last"
    for c in ("name", "release_date", "price", "genres", "developers", "publishers")
)

_GAME_BYTES = """
(octet_length(encode(to_json({'appid': appid, 'name': name, 'release_date': release_date,
    'price': price, 'genres': genres, 'developers': developers, 'publishers': publishers})))
  + 13 + 2 + greatest(len(genres) - 1, 0) + greatest(len(developers) - 1, 0)
  + greatest(len(publishers) - 1, 0)
  + case when price like '%£%' then 4 when price like '%€%' or price like '%₹%' then 3 else 0 end)
"""


@_check(f"""
{_FLAT_SQL}, sized as (
  select batch_no, sum({_GAME_BYTES}) as size from flat group by 1
), summed as (
  select batch_no, coalesce(sum(size) over (
    order by batch_no rows between unbounded preceding and 1 preceding), 0) as before from sized
), stacked as (
  select flat.* from flat join summed using (batch_no)
  where before < (select sum(size) // 2 from sized) or before = 0
  union all
  select -1, o_orderkey * 8 + 1, o_orderpriority, strftime(o_orderdate, '%Y'), o_orderstatus,
    [o_orderpriority], [], [] from orders
)
select {_FLAT_COLUMNS} from (
  select *, row_number() over (partition by appid order by batch_no desc, {_LATEST_ORDER}) as place
  from stacked
) where place = 1
""", name="ingest_details")
def ingested_details(spark: SparkSession, folder: str) -> DataFrame:
    """Answers flattened, capped at half their size, and put into a store."""
    answers = write_scratch(_answers(spark, folder))
    half = limits.json_size(details.flatten_details(answers)).first()["bytes"] // 2
    return _labelled(_ingested(spark, folder, answers, half))


@_check(f"""
{_FLAT_SQL}, stacked as (
  select flat.* from flat
  union all
  select -1, o_orderkey * 8 + 1, o_orderpriority, strftime(o_orderdate, '%Y'), o_orderstatus,
    [o_orderpriority], [], [] from orders
)
select {_FLAT_COLUMNS} from (
  select *, row_number() over (partition by appid order by batch_no desc, {_LATEST_ORDER}) as place
  from stacked
) where place = 1
""")
def ingest_uncapped(spark: SparkSession, folder: str) -> DataFrame:
    """The same with every answer."""
    return _labelled(_ingested(spark, folder, _answers(spark, folder)))


def _ingested(spark: SparkSession, folder: str, answers: DataFrame, max_bytes: int | None = None) -> DataFrame:
    none = F.array().cast("array<string>")
    store = table(spark, folder, "orders").select(
        (F.col("o_orderkey") * 8 + 1).alias("appid"),
        F.col("o_orderpriority").alias("name"),
        F.date_format("o_orderdate", "yyyy").alias("release_date"),
        F.col("o_orderstatus").alias("price"),
        F.array("o_orderpriority").alias("genres"),
        none.alias("developers"),
        none.alias("publishers"),
    )
    done = store.select("appid")
    return ingest_details(answers, store, done, max_bytes=max_bytes).store


@_check(f"""
{_FLAT_SQL}, latest as (
  select * from (
    select *, row_number() over (partition by appid order by batch_no desc, {_LATEST_ORDER})
      as place from flat
  ) where place = 1
), {_cleaned_sql("latest")}
select {_CLEANED_COLUMNS} from cleaned
""", name="run_daily")
def daily_run(spark: SparkSession, folder: str) -> DataFrame:
    """A whole day from downloaded files; the cleaned table it leaves."""
    paths = _downloaded(spark, folder)
    run_daily(spark, paths, _rates(spark), TODAY, **_WHOLE_DAY)
    return _labelled(read_table(spark, paths.cleaned, schemas.CLEANED_GAMES))


@_check(f"""
{_FLAT_SQL}, latest as (
  select * from (
    select *, row_number() over (partition by appid order by batch_no desc, {_LATEST_ORDER})
      as place from flat
  ) where place = 1
), {_cleaned_sql("latest")}, totals as (
  select release_year, genres, {_AVG} as avg_price, count(*) as games from cleaned group by release_year, genres
)
select {_LABEL} as release_year, array_to_string(genres, '|') as genres, avg_price, games,
  row_number() over (partition by release_year order by games desc, genres) as rank
from totals
""")
def totals_after_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Trends and genre ranks of a second day, made from its changes: a quarter of the games
    was different on the first day, and another quarter was not there."""
    paths, rates = DailyPaths.under(scratch_path(spark)), _rates(spark)
    entries = details.successes(_answers(spark, folder), carry=["batch_no"])
    rows = write_scratch(latest_details(capped_details(entries)))
    quarter, schema = F.col("appid") % 4, rows.columns
    other = {"price": "$1.00", "release_date": "1999"}
    first = rows.where(quarter != 1).select(
        *[F.when(quarter == 0, F.lit(other[c])).otherwise(F.col(c)).alias(c) if c in other else c for c in schema]
    )
    for day in (first, rows.where(quarter < 2)):
        upsert_table(spark, paths.store, day, "appid")
        write_reports(spark, paths, clean_store(spark, paths, rates))
    averages = _comparable(read_table(spark, paths.trends)).toDF("_year", "_genres", "avg_price")
    ranks = read_table(spark, paths.genre_ranks)
    same = F.col("release_year").eqNullSafe(F.col("_year")) & F.col("genres").eqNullSafe(F.col("_genres"))
    both = ranks.join(averages, same).withColumnRenamed("num_games_by_genre_per_year", "games")
    return _labelled(both.select("release_year", "genres", "avg_price", "games", "rank"))


_WHOLE_DAY = {"layout": "lines", "limit": 1 << 40}


def _downloaded(spark: SparkSession, folder: str) -> DailyPaths:
    """Paths with a catalogue of all raw games that have an id, and today's answers for them."""
    paths = DailyPaths.under(scratch_path(spark))
    with dropped_shuffles(spark):
        listed = raw_games(spark, folder).where(F.col("appid").isNotNull()).select("appid", "name")
        write_json(listed, paths.downloaded_list, compression="gzip")
        write_table(_answers(spark, folder), paths.responses)
    return paths


def _state(spark: SparkSession, paths: DailyPaths) -> DataFrame:
    """Sizes of the tables that a run leaves for the next."""
    counted = {
        "calls": load_calls(spark, paths.calls).agg(F.sum("calls").alias("n")),
        "cache": load_cache(spark, paths.cache).agg(F.count("*").alias("n")),
        "cached_ids": load_cache(spark, paths.cache).agg(F.count_distinct("appid").alias("n")),
        "processed": load_processed(spark, paths.processed).agg(F.count("*").alias("n")),
        "store": read_or_empty(spark, paths.store, schemas.RAW_GAMES).agg(F.count("*").alias("n")),
        "to_fetch": read_or_empty(spark, paths.to_fetch, schemas.TO_FETCH).agg(F.count("*").alias("n")),
    }
    rows = [df.select(F.lit(name).alias("state"), "n") for name, df in counted.items()]
    return functools.reduce(DataFrame.unionByName, rows)


_STATE_SQL = f"""
with {RAW_GAMES_SQL}, asked as (
  select appid from raw_games where appid is not null
), good as (
  select appid from asked where appid % 11 <> 0
), few as (
  select distinct appid from asked order by appid limit 500
)
"""


@_check(f"""
{_STATE_SQL}
select 'calls' as state, count(*) as n from good
union all select 'cache', count(*) from good
union all select 'cached_ids', count(distinct appid) from good
union all select 'processed', 0
union all select 'store', count(distinct appid) from good
union all select 'to_fetch', count(distinct appid) from asked
""")
def run_daily_retry(spark: SparkSession, folder: str) -> DataFrame:
    """What two runs on one day leave: the same as one. All ids are done, so that set starts anew."""
    paths = _downloaded(spark, folder)
    finish = [spark, paths, _rates(spark), TODAY]
    run_daily(*finish, **_WHOLE_DAY)
    prepare_day(spark, paths, TODAY, **_WHOLE_DAY)
    finish_day(*finish)
    return _state(spark, paths)


@_check(f"""
{_STATE_SQL}
select 'calls' as state, count(*) as n from good join few using (appid)
union all select 'cache', 0
union all select 'cached_ids', 0
union all select 'processed', count(*) from few
union all select 'store', count(distinct appid) from good join few using (appid)
union all select 'to_fetch', least(500, (select count(distinct appid) - 500 from asked))
""")
def run_daily_two_days(spark: SparkSession, folder: str) -> DataFrame:
    """A day with a quota of 500 calls, and a next day without new answers, which counts none."""
    paths = _downloaded(spark, folder)
    limited = {**_WHOLE_DAY, "limit": 500}
    run_daily(spark, paths, _rates(spark), TODAY, **limited)
    run_daily(spark, paths, _rates(spark), TODAY + datetime.timedelta(days=1), **limited)
    return _state(spark, paths)
