"""Campaign planning: init calendars, what is done and pending, how work is split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Days of each month that are init dates (31 where it exists).
DAYS = (1, 7, 9, 13, 17, 19, 25, 31)


def calendar(spark: SparkSession, first: int, last: int) -> DataFrame:
    """init dates of the years; 29 February never is one."""
    months = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"), F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    days = months.select("year", "month", F.explode(F.array(*map(F.lit, DAYS))).alias("day"))
    end = F.dayofmonth(F.last_day(F.make_date("year", "month", F.lit(1))))
    return days.where(F.col("day") <= end).select(F.make_date("year", "month", "day").alias("init"))


def filter_months(inits: DataFrame, months: list[int]) -> DataFrame:
    """Inits of other months than these."""
    return inits.where(~F.month("init").isin(months)) if months else inits


def pending(inits: DataFrame, published: DataFrame) -> DataFrame:
    """Inits and whether they are published."""
    return inits.join(published.select("init").distinct().withColumn("published", F.lit(True)), "init", "left").withColumn("published", F.coalesce("published", F.lit(False)))


def split(inits: DataFrame, jobs: int) -> DataFrame:
    """The job of each init: in even blocks (the first ones larger) and in turn. One row a date of a campaign."""
    order = W.orderBy("init")
    return inits.withColumn("block", F.ntile(jobs).over(order)).withColumn("turn", ((F.row_number().over(order) - 1) % jobs).cast("int"))


def states(inits: DataFrame, lists: dict[str, DataFrame]) -> DataFrame:
    """The state of each init: the first list, in order, that has it, else pending."""
    out, state = inits, F.lit("pending")
    for name, rows in lists.items():
        out = out.join(rows.select("init").distinct().withColumn(f"_{name}", F.lit(True)), "init", "left")
    for name in reversed(lists):
        state = F.when(F.col(f"_{name}"), name).otherwise(state)
    return out.select("init", state.alias("state"))


def store_path(init: Column, ending: str) -> Column:
    return F.concat(F.date_format(init, "yyyy-MM-dd'T'HH"), F.lit(ending))


def limit_seconds(text: Column) -> Column:
    """Seconds of a time limit: minutes, m:s, h:m:s, d-h, d-h:m or d-h:m:s. Null if it has another form."""
    form = r"^(?:(\d+)-)?(\d+)(?::(\d+))?(?::(\d+))?$"
    part = lambda k: F.coalesce(F.regexp_extract(text, form, k).try_cast("long"), F.lit(0))
    days, a, b, c = (part(k) for k in (1, 2, 3, 4))
    colons = F.size(F.split(text, ":")) - 1
    seconds = F.when(F.contains(text, F.lit("-")), days * 86400 + a * 3600 + b * 60 + c).when(colons == 0, a * 60).when(colons == 1, a * 60 + b).otherwise(a * 3600 + b * 60 + c)
    return F.when(F.regexp_like(text, F.lit(form)), seconds)


def summaries(rows: DataFrame, key: str, day: str, most: int) -> DataFrame:
    """The distinct days of each key: all up to `most`, else the first, the last and their number."""
    days = rows.select(key, F.date_format(day, "yyyy-MM-dd").alias("d")).distinct()
    ends = days.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("a"), F.max("d").alias("b"))
    few = days.join(ends.where(F.col("n") <= most).select(key), key, "left_semi").groupBy(key).agg(F.array_join(F.sort_array(F.collect_list("d")), ", ").alias("l"))  # `most` days a key
    text = F.coalesce("l", F.concat(F.col("a"), F.lit(" ... "), F.col("b"), F.lit(" ("), F.col("n").cast("string"), F.lit(")")))
    return ends.join(few, key, "left").select(key, text.alias("dates"))


def file_parts(name: Column) -> Column:
    """`a-1_b-2` as a map; a part is split at its first dash."""
    return F.map_from_entries(F.transform(F.split(name, "_"), lambda p: F.struct(F.substring_index(p, "-", 1), F.regexp_replace(p, "^[^-]*-", ""))))


def free_names(taken: DataFrame, key: str, number: str, name: str) -> DataFrame:
    """The first name of name, name_2, name_3 ... whose number is not taken, by key: the first gap in the sorted numbers."""
    own = taken.select(key, number).distinct()
    order = F.row_number().over(W.partitionBy(key).orderBy(number))
    gap = own.withColumn("_r", order).groupBy(key).agg(F.min(F.when(F.col(number) > F.col("_r"), F.col("_r"))).alias("gap"), (F.max("_r") + 1).alias("after"))
    free = F.coalesce("gap", "after")
    return gap.select(key, F.when(free == 1, name).otherwise(F.concat(F.lit(f"{name}_"), free.cast("string"))).alias("name"))
