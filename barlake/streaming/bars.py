"""Daily bars from tick events (code, ts, seq, price, amount in cents), in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barlake.catalog import TableSpec
from barlake.functions import from_cents, ratio, ymd
from barlake.session import remove_folder, shared_folder
from barlake.sources.store import Store


def _bar_columns() -> list:
    """``seq`` numbers the ticks, so it orders those of equal time too. The amount is summed in
    cents: exact, whatever the order in which partial sums meet."""
    return [
        F.min_by("price", "seq").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "seq").alias("close"),
        F.count("*").cast("double").alias("vol"),
        from_cents(F.sum("cents")).alias("amount"),
    ]


def bars(ticks: DataFrame) -> DataFrame:
    """One bar per code and day. All aggregates combine before the shuffle, so a code that has
    a third of all ticks costs one row per day and task."""
    return ticks.groupBy("code", F.to_date("ts").alias("day")).agg(*_bar_columns())


def with_changes(day_bars: DataFrame) -> DataFrame:
    """Adds previous close and change; a code has at most one row per day in the window."""
    by_day = Window.partitionBy("code").orderBy("day")
    rows = day_bars.withColumn("pre_close", F.lag("close").over(by_day))
    change = F.col("close") - F.col("pre_close")
    return rows.select(
        F.col("code").cast("string").alias("ts_code"), ymd(F.col("day")).alias("trade_date"),
        "open", "high", "low", "close", "pre_close", change.alias("change"),
        (ratio(change, F.col("pre_close")) * 100).alias("pct_chg"), "vol", "amount",
    )


def _in_utc(instant: Column) -> Column:
    """Wall-clock time in UTC of an instant."""
    return F.convert_timezone(None, F.lit("UTC"), instant.cast("timestamp_ntz"))


def utc_instant(wall_clock: Column) -> Column:
    """A zone-free time, read as UTC, as the TIMESTAMP that a watermark needs."""
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), wall_clock)
    return local.cast("timestamp")


# What is known of a day's ticks so far; two of these rows of the same day add up to one.
STATE = TableSpec(
    "bar_state",
    T.StructType([
        T.StructField("ts_code", T.StringType()), T.StructField("trade_date", T.StringType()),
        T.StructField("first_seq", T.LongType()), T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()), T.StructField("low", T.DoubleType()),
        T.StructField("last_seq", T.LongType()), T.StructField("close", T.DoubleType()),
        T.StructField("ticks", T.LongType()), T.StructField("cents", T.LongType()),
    ]),
    ("ts_code", "trade_date"), "ts_code", "trade_date", ("ym",), ("ym",), (),
    ("ts_code", "trade_date"),
)


def _partial(ticks: DataFrame) -> DataFrame:
    day = ymd(_in_utc(F.col("ts")))
    return ticks.groupBy(F.col("code").cast("string").alias("ts_code"), day.alias("trade_date")).agg(
        F.min("seq").alias("first_seq"), F.min_by("price", "seq").alias("open"),
        F.max("price").alias("high"), F.min("price").alias("low"),
        F.max("seq").alias("last_seq"), F.max_by("price", "seq").alias("close"),
        F.count("*").alias("ticks"), F.sum("cents").alias("cents"))


def _added(parts: DataFrame) -> DataFrame:
    return parts.groupBy("ts_code", "trade_date").agg(
        F.min("first_seq").alias("first_seq"), F.min_by("open", "first_seq").alias("open"),
        F.max("high").alias("high"), F.min("low").alias("low"),
        F.max("last_seq").alias("last_seq"), F.max_by("close", "last_seq").alias("close"),
        F.sum("ticks").alias("ticks"), F.sum("cents").alias("cents"))


# What is known of each code's bars in ``daily``, whoever wrote them: the first and the last day,
# and the last close. Its token is the number of the commit of ``daily`` that it is drawn from.
CODES = TableSpec(
    "bar_codes",
    T.StructType([
        T.StructField("ts_code", T.StringType()), T.StructField("first_day", T.StringType()),
        T.StructField("last_day", T.StringType()), T.StructField("last_close", T.DoubleType()),
    ]),
    ("ts_code",), "ts_code", None, (), (), (), ("ts_code",),
)


def _in_months(store: Store, table, months) -> DataFrame:
    return store.scan(table, dates=tuple(f"{m}01" for m in sorted(months)))


def _learn_codes(store: Store, rows: DataFrame, number: int) -> None:
    """Add rows of ``daily``, as of a commit, to what is known of their codes."""
    found = rows.where("ts_code IS NOT NULL AND trade_date IS NOT NULL").groupBy("ts_code").agg(
        F.min("trade_date").alias("first_day"), F.max("trade_date").alias("last_day"),
        F.max_by("close", "trade_date").alias("last_close")).withColumn("fresh", F.lit(1))
    known = store.scan(CODES).join(found.select("ts_code"), "ts_code", "left_semi")
    both = found.unionByName(known.withColumn("fresh", F.lit(0)))
    store.upsert(both.groupBy("ts_code").agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"),
        F.max_by("last_close", F.struct("last_day", "fresh")).alias("last_close")),
        CODES, staged=True, token=str(number))


def known_codes(store: Store) -> DataFrame:
    """What is known of each code, brought up to date: only the months of ``daily`` that changed
    since it was are read. Rows never leave ``daily``, so adding to it is exact."""
    number, changed = store.changes("daily", int(store.token(CODES) or 0))
    months = [values[0] for values in changed if values[0] is not None]
    if months:
        _learn_codes(store, _in_months(store, "daily", months), number)
    return store.scan(CODES)


def _neighbourhood(store: Store, touched: DataFrame, codes: DataFrame) -> list[str]:
    """The months to read so that every touched row has the bars before and after it: those of
    the touched rows, and those on either side up to the bar in question.

    Nothing is looked for before the first or after the last day of a code, nor before a row that
    comes after the last day, whose close is known. So only late rows lead to other months, and
    from each touched month on, twice as many each time, until none of its bars is missing.
    """
    groups = touched.where("ts_code IS NOT NULL AND trade_date IS NOT NULL").groupBy(
        "ts_code", F.substring("trade_date", 1, 6).alias("ym")).agg(
        F.min("trade_date").alias("low"), F.max("trade_date").alias("high"))
    groups = groups.join(codes, "ts_code", "left").select(
        "ts_code", "ym", "low", "high",
        F.coalesce((F.col("first_day") < F.col("low")) & (F.col("last_day") >= F.col("low")),
                   F.lit(False)).alias("back"),
        F.coalesce(F.col("last_day") > F.col("high"), F.lit(False)).alias("ahead"))
    # One row per touched month.
    asked = groups.groupBy("ym").agg(F.max("back").alias("back"), F.max("ahead").alias("ahead"))
    wanted = {r["ym"]: (int(r["back"]), int(r["ahead"])) for r in asked.collect()}
    stored = {m for t in ("daily", STATE) for m in store.partition_values(t, "ym")}
    months = sorted(stored | set(wanted))
    at = {m: k for k, m in enumerate(months)}

    def around(ym: str) -> tuple[int, int]:
        """First and last place of the months to read for a touched month."""
        back, ahead = wanted[ym]
        return max(0, at[ym] - back), min(len(months) - 1, at[ym] + ahead)

    late = {m for m, (back, ahead) in wanted.items() if back or ahead}
    while late:
        spans = store.spark.createDataFrame(
            [(m, months[around(m)[0]], months[around(m)[1]]) for m in sorted(late)],
            "ym string, start string, end string")
        read = {m for ym in late for m in months[around(ym)[0]:around(ym)[1] + 1]}
        days = _in_months(store, "daily", read).select("ts_code", "trade_date").union(
            _in_months(store, STATE, read).select("ts_code", "trade_date"))
        open_rows = groups.where("back OR ahead").join(F.broadcast(spans), "ym")
        found = open_rows.join(days, "ts_code", "left").groupBy(
            "ts_code", "ym", "back", "ahead").agg(
            F.max((F.col("trade_date") < F.col("low"))
                  & (F.substring("trade_date", 1, 6) >= F.col("start"))).alias("earlier"),
            F.max((F.col("trade_date") > F.col("high"))
                  & (F.substring("trade_date", 1, 6) <= F.col("end"))).alias("later"))
        missing = found.groupBy("ym").agg(
            F.max(F.col("back") & ~F.coalesce("earlier", F.lit(False))).alias("back"),
            F.max(F.col("ahead") & ~F.coalesce("later", F.lit(False))).alias("ahead"))
        late = set()
        for r in missing.collect():
            (back, ahead), (low, high) = wanted[r["ym"]], around(r["ym"])
            more = r["back"] and low > 0, r["ahead"] and high < len(months) - 1
            wanted[r["ym"]] = (2 * back if more[0] else back, 2 * ahead if more[1] else ahead)
            late |= {r["ym"]} if any(more) else set()
    return sorted({m for ym in wanted for m in months[around(ym)[0]:around(ym)[1] + 1]})


def _changed_bars(
    state: DataFrame, stored: DataFrame, touched: DataFrame, of_codes: DataFrame
) -> DataFrame:
    """Whole bars of the touched days, and of the day after each, whose change depends on it.

    The days around are those of the ``stored`` daily table and of the state, and the last day of
    each code; of an untouched day the stored bar counts. Where there is no earlier close, a stored
    previous close stays.
    """
    key, codes = ["ts_code", "trade_date"], touched.select("ts_code").distinct()
    values = ["open", "high", "low", "close", "vol", "amount"]
    streamed = state.select(
        *key, F.struct("open", "high", "low", "close", F.col("ticks").cast("double").alias("vol"),
                       from_cents(F.col("cents")).alias("amount")).alias("streamed"))
    known = stored.select(*key, "pre_close", F.struct(*values).alias("known"))
    rows = streamed.join(codes, "ts_code", "left_semi").join(
        known.join(codes, "ts_code", "left_semi"), key, "full")
    # The last bar of a code is known even where its month is not read.
    last = of_codes.join(codes, "ts_code", "left_semi").select(
        "ts_code", F.col("last_day").alias("trade_date"), F.struct(
            *[(F.col("last_close") if v == "close" else F.lit(None).cast("double")).alias(v)
              for v in values]).alias("last"))
    rows = rows.join(last, key, "full").withColumn("known", F.coalesce("known", "last"))
    rows = rows.join(touched.select(*key, F.lit(True).alias("touched")), key, "left")
    bar = F.when(F.col("touched") | F.col("known").isNull(), F.col("streamed")).otherwise(
        F.col("known"))
    by_day = Window.partitionBy("ts_code").orderBy("trade_date")
    rows = rows.withColumn("bar", bar).withColumn("before", F.lag("touched").over(by_day))
    rows = rows.withColumn("pre_close", F.coalesce(
        F.lag("bar.close").over(by_day), F.col("pre_close"))).select(
        *key, "bar.*", "pre_close", "touched", "before")
    change = F.col("close") - F.col("pre_close")
    return rows.where("touched OR before").select(
        "ts_code", "trade_date", "open", "high", "low", "close", "pre_close",
        change.alias("change"), (ratio(change, F.col("pre_close")) * 100).alias("pct_chg"),
        "vol", "amount")


def start_bar_stream(ticks: DataFrame, store: Store, checkpoint: str) -> StreamingQuery:
    """Keep the ``daily`` table current from a stream of ticks with a TIMESTAMP ``ts``.

    A day is a UTC day, whatever the session's time zone. Ticks may come in any order and however
    late: what is known of each day is kept in a table of its own (``bar_state``) beside the
    others, to which every micro-batch adds. That commit carries the stream's name and batch number,
    so a batch that is run again after a failure adds nothing twice. The bars of the touched days,
    and of the days after them, are written with all their columns. The previous bar may also be one
    that was saved in ``daily``, and so may the next, which then gets its new change.

    A second table (``bar_codes``) has the first and last day and the last close of every code,
    drawn from the commits of ``daily``. With it, ticks of a new day read no other month, and neither
    do those of a new code. Only one row per code and day of a micro-batch is kept beside it.
    """
    def take(batch: DataFrame, number: int) -> None:
        mark = f"{checkpoint}#{number}"
        folder = shared_folder(store.spark, "ticks")
        part = _partial(batch)
        part.write.parquet(folder)
        new = store.spark.read.schema(part.schema).parquet(folder)
        months = [r[0] for r in new.where("trade_date IS NOT NULL").select(
            F.substring("trade_date", 1, 6)).distinct().collect()]
        if store.token(STATE) != mark:
            known = _in_months(store, STATE, months).join(
                new.select("ts_code", "trade_date"), ["ts_code", "trade_date"], "left_semi")
            store.upsert(_added(known.unionByName(new)), STATE, token=mark)
        if months:
            codes = known_codes(store)
            months = _neighbourhood(store, new, codes)
            before, _ = store.changes("daily")
            changed = _changed_bars(_in_months(store, STATE, months),
                                    _in_months(store, "daily", months), new, codes)
            rows = f"{folder}-bars"
            changed.write.parquet(rows)
            changed = store.spark.read.schema(changed.schema).parquet(rows)
            store.upsert(changed, "daily")
            now, _ = store.changes("daily")
            # Bars of other writers are looked up with the next micro-batch.
            if now == before + 1 and store.token(CODES) == str(before):
                _learn_codes(store, changed, now)
            remove_folder(store.spark, rows)
        remove_folder(store.spark, folder)

    return (
        ticks.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
