"""Game-shaped views over the order tables that tests and benchmarks use.

Line items become raw game rows: every shape of price and date text occurs,
some names, lists and ids are missing, and ids repeat.
"""

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Made-up rates, the Australian dollar left out on purpose.
SAMPLE_RATES = {
    "USD": 1.0,
    "BRL": 0.1835,
    "EUR": 1.0842,
    "GBP": 1.2671,
    "INR": 0.011963,
    "CHF": 1.1305,
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the test tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Rows that one task takes, and parts up to which a table of them is broadcast.
ROWS_PER_TASK = 250_000
_FEW_PARTS = 200_000


def tasks_for(df: DataFrame) -> int:
    """Tasks that a stored table needs: all cores, and more where each would take too many rows.

    Counting reads footers alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(cores, math.ceil(df.count() / ROWS_PER_TASK))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows over the tasks that they need if they come from fewer files.

    A small table is one row group, which one task would read and process
    alone; of a large one a task would read, and sort, as many rows as fit a split of a file.
    A table of many files stays as its scan splits it.
    """
    tasks = tasks_for(df)
    return df.repartition(tasks, *keys) if len(df.inputFiles()) < tasks else df


def _with_parts(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """Lines joined with their parts in tasks of bounded size; many parts are not broadcast."""
    if parts.count() <= _FEW_PARTS:
        dealt = spread(lines, "l_orderkey", "l_linenumber")
        return dealt.join(F.broadcast(parts), dealt.l_partkey == parts.p_partkey)
    tasks = tasks_for(lines)
    by_part = parts.repartition(tasks, "p_partkey").hint("merge")
    return lines.repartition(tasks, "l_partkey").join(by_part, F.col("l_partkey") == F.col("p_partkey"))


_RELEASE_DATE = """
    case l_linenumber
      when 1 then date_format(l_shipdate, 'M/d/yyyy')
      when 2 then date_format(l_shipdate, 'MMM d, yyyy')
      when 3 then date_format(l_shipdate, 'd MMM, yyyy')
      when 4 then concat('Q', quarter(l_shipdate), ' ', year(l_shipdate))
      when 5 then date_format(l_shipdate, 'yyyy')
      when 6 then 'Coming Soon'
      else date_format(l_shipdate, 'd/M/yyyy')
    end
"""

# Most prices are those of one part, some those of a whole line.
_AMOUNT = """
    cast(cast(case when l_discount = 0.1D then l_extendedprice else p_retailprice end
      as decimal(12,2)) as string)
"""

_PRICE = """
    case l_suppkey % 9
      when 0 then case when l_tax = 0 then '$0.00' else concat('$', amount) end
      when 1 then concat('R$ ', replace(amount, '.', ','))
      when 2 then concat('A$ ', amount)
      when 3 then concat('€', amount)
      when 4 then concat('£', substring_index(amount, '.', 1))
      when 5 then concat('₹ ', amount)
      when 6 then concat(replace(amount, '.', ','), '€')
      when 7 then case l_returnflag
        when 'A' then concat('CDN$ ', amount)
        when 'N' then concat('CHF ', amount)
        else concat('$1,', amount) end
      else case l_returnflag when 'A' then amount when 'N' then 'Free' end
    end
"""


def raw_games(spark: SparkSession, folder: str) -> DataFrame:
    """Raw game rows, one per line item."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_shipdate",
        "l_extendedprice",
    )
    parts = table(spark, folder, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"
    )
    return _with_parts(lines, parts).selectExpr("*", f"{_AMOUNT} as amount").selectExpr(
        # Some ids need more than 32 bits.
        "case when l_quantity < 50 then l_orderkey * 8 + l_linenumber"
        " + if(l_linenumber = 7, 3000000000, 0) end as appid",
        "case when p_size > 1 then p_name end as name",
        f"{_RELEASE_DATE} as release_date",
        f"{_PRICE} as price",
        "case when p_size = 3 then array()"
        " when p_size <> 2 then transform(split(p_name, ' '), g -> concat(' ', g, ' ')) end"
        " as genres",
        "case when p_size > 40 then array(p_brand, p_type)"
        " when p_size <> 4 then array(p_brand) end as developers",
        "case when p_size <> 5 then array(p_type) end as publishers",
    )


# The same view in standard SQL, for comparison in another engine.
RAW_GAMES_SQL = """
raw_lines as (
  select *, cast(cast(case when l_discount = 0.1 then l_extendedprice else p_retailprice end
    as decimal(12,2)) as varchar) as amount
  from lineitem join part on l_partkey = p_partkey
),
raw_games as (
  select
    case when l_quantity < 50 then l_orderkey * 8 + l_linenumber
      + if(l_linenumber = 7, 3000000000, 0) end as appid,
    case when p_size > 1 then p_name end as name,
    case l_linenumber
      when 1 then strftime(l_shipdate, '%-m/%-d/%Y')
      when 2 then strftime(l_shipdate, '%b %-d, %Y')
      when 3 then strftime(l_shipdate, '%-d %b, %Y')
      when 4 then 'Q' || quarter(l_shipdate) || ' ' || year(l_shipdate)
      when 5 then strftime(l_shipdate, '%Y')
      when 6 then 'Coming Soon'
      else strftime(l_shipdate, '%-d/%-m/%Y')
    end as release_date,
    case l_suppkey % 9
      when 0 then case when l_tax = 0 then '$0.00' else '$' || amount end
      when 1 then 'R$ ' || replace(amount, '.', ',')
      when 2 then 'A$ ' || amount
      when 3 then '€' || amount
      when 4 then '£' || split_part(amount, '.', 1)
      when 5 then '₹ ' || amount
      when 6 then replace(amount, '.', ',') || '€'
      when 7 then case l_returnflag
        when 'A' then 'CDN$ ' || amount
        when 'N' then 'CHF ' || amount
        else '$1,' || amount end
      else case l_returnflag when 'A' then amount when 'N' then 'Free' end
    end as price,
    case when p_size = 3 then cast([] as varchar[])
      when p_size <> 2 then list_transform(string_split(p_name, ' '), lambda g: ' ' || g || ' ')
    end as genres,
    case when p_size > 40 then [p_brand, p_type] when p_size <> 4 then [p_brand] end
      as developers,
    case when p_size <> 5 then [p_type] end as publishers
  from raw_lines
)
"""
