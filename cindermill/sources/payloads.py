"""Landed payloads (JSON or CSV text in a column) to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Reporting areas and their banks; days from a period to its release.
AREA_BANKS = {"XM": "ECB", "GB": "BOE", "JP": "BOJ", "CA": "BOC", "AU": "RBA", "NZ": "RBNZ", "CH": "SNB", "KR": "BOK", "NO": "NORGES", "SE": "RIKSBANK", "CN": "PBOC", "ID": "BI"}
RELEASE_LAGS = {"monthly": 33, "quarterly": 35, "accounts": 120, "default": 7}


def bars(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Aggregate bars {results: [{t, o, h, l, c, v, vw}]}: t in milliseconds; what is missing stays null."""
    parsed = F.from_json(payload, "results array<struct<t: bigint, o: double, h: double, l: double, c: double, v: double, vw: double>>")
    rows = df.select("symbol", F.explode(parsed["results"]).alias("r"))
    return rows.select("symbol", F.timestamp_millis("r.t").alias("timestamp"), *[F.col(f"r.{k}").alias(n) for k, n in (("o", "open"), ("h", "high"), ("l", "low"), ("c", "close"), ("v", "volume"), ("vw", "vwap"))])


def price_frame(df: DataFrame) -> DataFrame:
    """Columns in lower case with underscores, `date` as timestamp, the six bar columns only."""
    named = df.withColumnsRenamed({c: c.strip().lower().replace(" ", "_") for c in df.columns})
    stamped = named if "timestamp" in named.columns else named.withColumnRenamed("date" if "date" in named.columns else "datetime", "timestamp")
    return stamped.select(F.col("timestamp").cast("timestamp"), "open", "high", "low", "close", "volume")


def currency_pair(symbol: Column) -> Column:
    """struct(base, quote) of EUR/USD, EUR_USD or EURUSD=X; null for others."""
    bare = F.regexp_replace(F.upper(symbol), "(=X$)|[/_]", "")
    return F.when(bare.rlike("^[A-Z]{6}$"), F.struct(F.substring(bare, 1, 3).alias("base"), F.substring(bare, 4, 3).alias("quote")))


def dated_rates(df: DataFrame, start: Column, end: Column, payload: str = "payload") -> DataFrame:
    """A map date -> {open, high, low, close} to rows within the dates; volume is null."""
    parsed = F.from_json(payload, "map<string, struct<open: string, high: string, low: string, close: string>>")
    rows = df.select("symbol", F.explode(parsed).alias("d", "v")).withColumn("date", F.expr("try_to_date(d, 'yyyy-MM-dd')"))
    return rows.where(F.col("date").between(start, end)).select("symbol", "date", *[F.expr(f"try_cast(v.{c} AS DOUBLE)").alias(c) for c in ("open", "high", "low", "close")], F.lit(None).cast("long").alias("volume"))


def with_release(observations: DataFrame, lags: DataFrame, run_date: Column) -> DataFrame:
    """release_date = the observation plus its series' lag (7 days where none is known), not after run_date."""
    lag = F.coalesce("lag_days", F.lit(RELEASE_LAGS["default"]))
    return observations.join(F.broadcast(lags.select("series_id", "lag_days")), "series_id", "left").withColumn("release_date", F.least(F.date_add("observation_date", lag), run_date)).drop("lag_days")


def period_date(year: Column, period: Column) -> Column:
    """M01 to M12, Q01 to Q04 and A01 as the first day; M13 and others null."""
    number = F.try_to_number(F.substring(period, 2, 2), F.lit("99")).cast("int")
    month = F.when(period.startswith("M") & (number <= 12), number).when(period.startswith("Q") & (number <= 4), number * 3 - 2).when(period.startswith("A"), 1)
    return F.when(month.isNotNull(), F.make_date(year.cast("int"), month, F.lit(1)))


def labour(df: DataFrame, run_date: Column, payload: str = "payload") -> DataFrame:
    """{Results: {series: [{seriesID, data: [{year, period, value}]}]}} to observations with release dates."""
    parsed = F.from_json(payload, "Results struct<series: array<struct<seriesID: string, data: array<struct<year: string, period: string, value: string>>>>>")
    rows = df.select(F.explode(parsed["Results"]["series"]).alias("s")).select(F.col("s.seriesID").alias("series_id"), F.explode("s.data").alias("d"))
    dated = rows.withColumns({"observation_date": period_date(F.col("d.year"), F.col("d.period")), "value": F.expr("try_cast(d.value AS DOUBLE)")}).where("observation_date IS NOT NULL")
    lag = F.when(F.col("d.period").startswith("Q"), RELEASE_LAGS["quarterly"]).otherwise(RELEASE_LAGS["monthly"])
    return dated.select("series_id", "observation_date", "value", F.least(F.date_add("observation_date", lag), run_date).alias("release_date"))


def accounts(df: DataFrame, lines: DataFrame, run_date: Column, payload: str = "payload") -> DataFrame:
    """National accounts rows kept by line number, or by description where no number is listed; numbers have commas."""
    parsed = F.from_json(payload, "Data array<struct<TableName: string, LineNumber: string, LineDescription: string, TimePeriod: string, DataValue: string>>")
    rows = df.select(F.explode(parsed["Data"]).alias("r")).select("r.*")
    wanted = rows.join(F.broadcast(lines.select("series_id", F.col("table_name"), F.col("line_number"), F.col("line_description"))), (F.col("TableName") == F.col("table_name")) & F.when(F.col("line_number").isNotNull(), F.col("LineNumber") == F.col("line_number")).otherwise(F.col("LineDescription") == F.col("line_description")))
    year, quarter = F.regexp_extract("TimePeriod", r"^(\d{4})", 1).cast("int"), F.regexp_extract("TimePeriod", r"Q([1-4])$", 1)
    date = F.make_date(year, F.when(quarter != "", F.concat(F.lit("0"), quarter).cast("int") * 3 - 2).otherwise(1), F.lit(1))
    value = F.expr("try_cast(replace(DataValue, ',', '') AS DOUBLE)")
    return wanted.select("series_id", date.alias("observation_date"), value.alias("value"), F.least(F.date_add(date, RELEASE_LAGS["accounts"]), run_date).alias("release_date"))


def energy(df: DataFrame, series: DataFrame, run_date: Column, payload: str = "payload") -> DataFrame:
    """{series_id, data: [[YYYYMMDD, value]]}: nulls go, release is run_date, name and unit from the dimension."""
    parsed = F.from_json(payload, "series_id string, data array<array<string>>")
    rows = df.select(parsed["series_id"].alias("series_id"), F.explode(parsed["data"]).alias("d"))
    typed = rows.select("series_id", F.expr("try_to_date(d[0], 'yyyyMMdd')").alias("observation_date"), F.expr("try_cast(d[1] AS DOUBLE)").alias("value")).where("value IS NOT NULL")
    return typed.withColumn("release_date", run_date).join(F.broadcast(series.select("series_id", "name", "unit")), "series_id", "left")


def outlook(df: DataFrame, countries: list[str], run_date: Column, payload: str = "payload") -> DataFrame:
    """{values: {indicator: {country: {year: value}}}}: release is the first outlook not after run_date, else run_date."""
    parsed = F.from_json(payload, "values map<string, map<string, map<string, double>>>")
    rows = df.select(F.explode(parsed["values"]).alias("indicator", "c")).select("indicator", F.explode("c").alias("country", "y")).where(F.col("country").isin(*countries)).select("indicator", "country", F.explode("y").alias("year", "value"))
    year = F.col("year").cast("int")
    dates = F.array(F.make_date(year, F.lit(10), F.lit(1)), F.make_date(year + 1, F.lit(4), F.lit(1)), F.make_date(year + 1, F.lit(10), F.lit(1)))
    return rows.select("indicator", "country", F.make_date(year, F.lit(1), F.lit(1)).alias("observation_date"), "value", F.coalesce(F.array_min(F.filter(dates, lambda d: d <= run_date)), run_date).alias("release_date"))


def policy_rates(lines: DataFrame, line: str = "line", order: str = "line_number", banks: dict[str, str] = AREA_BANKS) -> DataFrame:
    """CSV lines (area, date, rate) of one file per `file`, after a preamble that ends with the TIME_PERIOD header.

    Areas without an entry in `banks` are not rates of a known bank and go.
    """
    header = lines.where(F.lower(line).contains("time_period")).groupBy("file").agg(F.min(order).alias("h_"), F.min_by(F.split(F.lower(line), ","), order).alias("names"))
    rows = lines.join(header, "file").where(F.col(order) > F.col("h_")).withColumn("c_", F.split(line, ","))
    field = lambda name: F.try_element_at(F.col("c_"), F.array_position("names", name).cast("int"))
    bank_of = F.create_map(*[F.lit(x) for pair in banks.items() for x in pair])
    typed = rows.select(field("ref_area").alias("ref_area"), field("time_period").alias("d_"), field("obs_value").alias("v_"))
    return typed.select("ref_area", bank_of[F.col("ref_area")].alias("central_bank"), F.expr("try_to_date(d_, 'yyyy-MM-dd')").alias("obs_date"), F.expr("try_cast(v_ AS DOUBLE)").alias("rate_pct")).where("obs_date IS NOT NULL AND central_bank IS NOT NULL")


def earnings(df: DataFrame, payload: str = "payload") -> DataFrame:
    parsed = F.from_json(payload, "earningsCalendar array<struct<symbol: string, date: string, epsEstimate: string, epsActual: string, quarter: string, year: string>>")
    rows = df.select(F.explode(parsed["earningsCalendar"]).alias("r"))
    return rows.selectExpr("r.symbol AS symbol", "try_to_date(r.date, 'yyyy-MM-dd') AS earnings_date", "try_cast(r.epsEstimate AS DOUBLE) AS eps_estimate", "try_cast(r.epsActual AS DOUBLE) AS eps_actual", "try_cast(r.quarter AS INT) AS quarter", "try_cast(r.year AS INT) AS year")


def sentiment(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Score, buzz and news count of each symbol's payload; what is missing counts 0."""
    parsed = F.from_json(payload, "companyNewsScore double, buzz struct<buzz: double, articlesInLastWeek: bigint>")
    return df.select("symbol", F.coalesce(parsed["companyNewsScore"], F.lit(0.0)).alias("sentiment_score"), F.coalesce(parsed["buzz"]["buzz"], F.lit(0.0)).alias("buzz_score"), F.coalesce(parsed["buzz"]["articlesInLastWeek"], F.lit(0)).alias("news_volume_7d"))


def matrix_row(cells: DataFrame, area: str, codes: list[str]) -> DataFrame:
    """From cells (sheet, row, col, value): code, weight of the area's row under the first header row with two known codes."""
    headers = cells.where(F.col("value").isin(*codes))
    first = headers.groupBy("sheet", "row").count().where("count >= 2").groupBy("sheet").agg(F.min("row").alias("row"))
    named = headers.join(first, ["sheet", "row"]).select("sheet", "col", F.col("value").alias("code"))
    mine = cells.where((F.col("col") == 2) & (F.col("value") == area)).select("sheet", "row")
    weights = cells.join(mine, ["sheet", "row"], "left_semi").select("sheet", "col", F.expr("try_cast(value AS DOUBLE)").alias("weight"))
    return named.join(weights, ["sheet", "col"], "left").select("sheet", "code", "weight")


def quotes(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Quotes {c, h, l, o, pc, t} of each symbol; t is in seconds."""
    parsed = F.from_json(payload, "c double, h double, l double, o double, pc double, t bigint")
    return df.select("symbol", F.timestamp_seconds(parsed["t"]).alias("timestamp"), *[parsed[k].alias(n) for k, n in (("c", "close"), ("h", "high"), ("l", "low"), ("o", "open"), ("pc", "previous_close"))])
