"""Ambient weather.

The reference scrapes a monthly HTML table per month and keeps a CSV cache.
Here pages are rows of an already stored DataFrame; table rows and cells are
found by a fold over each page's tags with higher-order functions, and every
later step (daily -> hourly, monthly means, gap fill, coverage) is a plain
DataFrame plan.
"""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.functions import expr as X
from forgeline.operators.dedup import keep_one_per_key
from forgeline.session import materialize
from forgeline.sources.files import read_weather_store

WEATHER_COLUMNS = ["observed_at", "temp_celsius", "humidity_pct", "pressure_hpa", "wind_speed_ms", "is_imputed"]

# Fixed values that must equal the reference for right results:
# cell positions in the daily table (0 date, 1 t min, 2 t max, 3 t mean,
# 4 wind mean, 5 wind max, 6 sunshine, 7 rain, 8 pressure min, 9 pressure max).
IDX_TEMP_MEAN = 3
IDX_WIND_MEAN = 4
IDX_PRESSURE_MIN = 8
IDX_PRESSURE_MAX = 9
MIN_CELLS = 10

# S11 ---------------------------------------------------------------------
_TOKEN = r"""(?is)<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)\s*>|</?[a-z](?:"[^"]*"|'[^']*'|[^'">])*>|[^<]+|<"""
_CLASS = r"""(?is)\sclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_ENTITY = r"&#[0-9]+;|&#[xX][0-9A-Fa-f]+;|&[A-Za-z][A-Za-z0-9]*;|[^&]+|&"


def decoded(text: Column) -> Column:
    """Character references resolved: decimal, hexadecimal and named ones (HTML 4); others stay as they are."""
    names = F.from_json(F.lit(json.dumps({f"&{n};": chr(c) for n, c in name2codepoint.items()} | {"&apos;": "'"})), "map<string,string>")

    def one(piece: Column) -> Column:
        hexadecimal = F.when(piece.rlike("^&#[0-9]"), F.hex(F.regexp_extract(piece, "[0-9]+", 0).try_cast("long"))).otherwise(
            F.upper(F.regexp_extract(piece, "^&#[xX]0*([0-9A-Fa-f]{1,8});", 1)))
        point = F.when((F.length(hexadecimal) <= 6) & (hexadecimal != "") & (hexadecimal != "0"), F.lpad(hexadecimal, 8, "0"))
        known = F.when((point <= "0010FFFF") & ~point.between("0000D800", "0000DFFF"), F.decode(F.unhex(point), "UTF-32"))
        return F.when(piece.startswith("&#"), F.coalesce(known, F.lit("\ufffd"))).when(piece.startswith("&"), F.coalesce(F.try_element_at(names, piece), piece)).otherwise(piece)

    whole = F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0)), one), "")
    return F.when(text.contains("&"), whole).otherwise(text)


def _tokens(html: Column) -> Column:
    """Tags and texts of a page in order: (kind, tag, marked, text); comments, scripts and styles are neither."""

    def token(t: Column) -> Column:
        tag = F.lower(F.regexp_extract(t, r"^</?([A-Za-z][^\s/>]*)", 1))
        hidden = t.startswith("<!--") | tag.isin("script", "style")
        kind = F.when(hidden, "none").when(tag == "", "text").when(t.startswith("</"), "close").otherwise("open")
        named = F.concat(*[F.regexp_extract(t, _CLASS, g) for g in (1, 2, 3)])
        return F.struct(kind.alias("kind"), tag.alias("tag"), ((tag == "div") & (F.trim(named) == "toprint")).alias("marked"), t.alias("text"))

    return F.transform(F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0)), token)


def _followed(s: Column, t: Column) -> Column:
    """State after a token: what a parser that walks through the page would know."""
    opens, closes = (lambda tag: (t["kind"] == "open") & (t["tag"] == tag)), (lambda tag: (t["kind"] == "close") & (t["tag"] == tag))
    none, strings = F.array().cast("array<string>"), "array<string>"
    marked = s["marked"] | ((t["kind"] == "open") & t["marked"])
    in_table = s["in_table"] | (opens("table") & marked)
    row_starts = opens("tr") & in_table
    cell_starts = opens("td") & (s["in_row"] | row_starts)
    table_ends = closes("table") & s["in_table"]
    row_ends = closes("tr") & s["in_table"] & s["in_row"]
    cell_ends = closes("td") & s["in_row"]
    words = F.trim(F.regexp_replace(decoded(t["text"]), "[\\s\u00a0]+", " "))
    says = (t["kind"] == "text") & s["in_cell"]
    cell = F.when(cell_starts, none).when(says, F.filter(F.concat(s["cell"], F.array(words)), lambda x: x != "")).otherwise(s["cell"])
    row = F.when(row_starts, none).when(cell_ends, F.concat(s["row"], F.array(F.array_join(s["cell"], " ")))).otherwise(s["row"])
    full = F.struct((s["begun"] - 1).alias("row_index"), s["row"].alias("cells"))
    return F.struct(
        (marked & ~table_ends).alias("marked"), (in_table & ~table_ends).alias("in_table"), ((s["in_row"] | row_starts) & ~row_ends).alias("in_row"),
        ((s["in_cell"] | cell_starts) & ~cell_ends).alias("in_cell"), (s["begun"] + row_starts.cast("int")).alias("begun"),
        cell.cast(strings).alias("cell"), row.cast(strings).alias("row"),
        F.when(row_ends & (F.size(s["row"]) > 0), F.concat(s["rows"], F.array(full))).otherwise(s["rows"]).alias("rows"))


def page_table_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """Rows of ``td`` cell texts of every table after a ``div class="toprint"``.

    A fold over the page's tags and texts keeps where it is: a marked div makes
    the next table count, until that table's end tag (whatever it nests, so a
    table inside a cell ends it); a row counts when it is closed and has cells,
    numbered by its ``tr`` among all of them; a cell when it is closed.  A new
    ``tr`` or ``td`` drops an unclosed one.  Tag and attribute names match in
    either case, attributes may be quoted or not; comments, scripts and styles
    are skipped; character references are decoded; a cell's texts are joined by
    a space, runs of white space are one.  A page that is null, or has no
    marked table, has no rows.
    """
    start = F.struct(*[F.lit(False).alias(c) for c in ("marked", "in_table", "in_row", "in_cell")], F.lit(0).alias("begun"),
                     *[F.array().cast("array<string>").alias(c) for c in ("cell", "row")],
                     F.array().cast("array<struct<row_index:int,cells:array<string>>>").alias("rows"))
    rows = F.aggregate(_tokens(F.col(html)), start, _followed, lambda s: s["rows"])
    return pages.select(*[c for c in pages.columns if c != html], F.explode(rows).alias("_row")).select(
        *[c for c in pages.columns if c != html], "_row.row_index", "_row.cells")


# S12 ---------------------------------------------------------------------
def daily_record_from_cells(rows: DataFrame, year: Column, month: Column, cells: str = "cells") -> DataFrame:
    """Daily weather record from table cells; short rows and invalid days dropped."""
    c = F.col(cells)
    day_num = F.regexp_extract(F.get(c, 0), r"([0-9]+)", 1)
    day = F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day_num, 2, "0"))
    out = rows.where(F.size(c) >= MIN_CELLS).withColumn("day", day.try_cast("date"))
    wind = X.locale_number(F.get(c, IDX_WIND_MEAN))
    return out.where(F.col("day").isNotNull() & (day_num != "")).select(
        "day",
        X.locale_number(F.get(c, IDX_TEMP_MEAN)).alias("temp_celsius"),
        F.lit(None).cast("double").alias("humidity_pct"),
        X.pressure_mid(X.locale_number(F.get(c, IDX_PRESSURE_MIN)), X.locale_number(F.get(c, IDX_PRESSURE_MAX))).alias("pressure_hpa"),
        X.kmh_to_ms(wind).alias("wind_speed_ms"),
    )


# G01 ---------------------------------------------------------------------
def expand_daily_to_hourly(daily: DataFrame, day: str = "day") -> DataFrame:
    """Each day repeated for its 24 UTC hours, ``is_imputed`` false."""
    start = F.col(day).cast("timestamp_ntz")
    hours = F.sequence(start, X.plus_hours(start, 23), F.make_dt_interval(F.lit(0), F.lit(1)))
    metrics = [c for c in ("temp_celsius", "humidity_pct", "pressure_hpa", "wind_speed_ms") if c in daily.columns]
    out = daily.select(F.explode(hours).alias("observed_at"), *metrics)
    for c in ("temp_celsius", "humidity_pct", "pressure_hpa", "wind_speed_ms"):
        if c not in metrics:
            out = out.withColumn(c, F.lit(None).cast("double"))
    return out.withColumn("is_imputed", F.lit(False)).select(*WEATHER_COLUMNS)


# G02 ---------------------------------------------------------------------
def hours_of(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """G02 over a bounds frame (one row per range), distributed by ``explode``."""
    s = F.col(start).cast("timestamp_ntz")
    e = X.plus_hours(F.col(end).cast("timestamp_ntz"), 23)
    return bounds.select("*", F.explode(F.sequence(s, e, F.make_dt_interval(F.lit(0), F.lit(1)))).alias("observed_at"))


# G03 ---------------------------------------------------------------------
def months_of(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """(year, month) pairs from ``start`` to ``end`` inclusive."""
    months = F.sequence(F.trunc(F.col(start), "MM"), F.trunc(F.col(end), "MM"), F.expr("interval 1 month"))
    return bounds.select(F.explode(months).alias("_m")).select(
        F.year("_m").alias("year"), F.month("_m").alias("month")
    )


# A12 ---------------------------------------------------------------------
def monthly_means(weather: DataFrame) -> DataFrame:
    """Calendar-month means of the non-imputed rows; humidity always NULL."""
    hist = weather.where(~F.coalesce(F.col("is_imputed"), F.lit(False)))
    return hist.groupBy(F.month("observed_at").alias("month")).agg(
        F.avg("temp_celsius").alias("temp_celsius"),
        F.lit(None).cast("double").alias("humidity_pct"),
        F.avg("pressure_hpa").alias("pressure_hpa"),
        F.avg("wind_speed_ms").alias("wind_speed_ms"),
    )


# M07 ---------------------------------------------------------------------
def fill_future_hours(future_hours: DataFrame, means: DataFrame) -> DataFrame:
    """Hourly rows filled with the mean of their calendar month, ``is_imputed`` true.

    ``means`` has at most twelve rows, so it is broadcast.
    """
    f = future_hours.withColumn("month", F.month("observed_at"))
    return f.join(F.broadcast(means), "month", "left").select(
        "observed_at", "temp_celsius", F.lit(None).cast("double").alias("humidity_pct"), "pressure_hpa",
        "wind_speed_ms", F.lit(True).alias("is_imputed"),
    )


# J09 ---------------------------------------------------------------------
def missing_hours(wanted_hours: DataFrame, stored: DataFrame) -> DataFrame:
    """Hours in range that the store lacks (hour-granular, quirk Q12)."""
    return wanted_hours.join(stored.select("observed_at"), "observed_at", "left_anti")


def missing_months(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Month coverage check: (year, month) in range minus months stored."""
    have = stored.select(F.year("observed_at").alias("year"), F.month("observed_at").alias("month")).distinct()
    return wanted.join(have, ["year", "month"], "left_anti")


# K11 / B02 / U04 ---------------------------------------------------------
def merge_store(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Union stored and new hourly rows, keep the first row per hour (stored wins)."""
    ranked = stored.select(*WEATHER_COLUMNS).withColumn("_src", F.lit(0)).unionByName(
        new.select(*WEATHER_COLUMNS).withColumn("_src", F.lit(1))
    )
    order = [F.col("_src"), *[F.col(c) for c in WEATHER_COLUMNS if c != "observed_at"]]
    return keep_one_per_key(ranked, ["observed_at"], order, keep="first").drop("_src")


def silver_weather(bronze_like: DataFrame, arrival: str | None = None) -> DataFrame:
    """Silver: floor to hour, keep the *last* row per hour.

    Last by ``arrival`` (a stored row number), then by the exact time and the
    measured values, so equal inputs give equal rows in any partitioning.
    """
    values = [F.col(c) for c in WEATHER_COLUMNS if c in bronze_like.columns]
    order = ([F.col(arrival).alias("_o_arrival")] if arrival else []) + [c.alias(f"_o{i}") for i, c in enumerate(values)]
    w = bronze_like.withColumn("_order", F.struct(*order)).withColumn("observed_at", X.hour_floor("observed_at"))
    out = keep_one_per_key(w, ["observed_at"], [F.col("_order")], keep="last").drop("_order")
    return out.drop(arrival) if arrival else out


# P27 ---------------------------------------------------------------------
def in_time_range(df: DataFrame, start: Column, end: Column, ts: str = "observed_at") -> DataFrame:
    """``start <= ts <= end + 23h``."""
    s = start.cast("timestamp_ntz")
    e = X.plus_hours(end.cast("timestamp_ntz"), 23)
    return df.where((F.col(ts) >= s) & (F.col(ts) <= e))


# K11 write -----------------------------------------------------------------
def write_store(merged: DataFrame, changed: DataFrame, path: str) -> None:
    """Replace the months of ``changed`` hours in the store by their merged rows; other months' files stay."""
    months = changed.select(F.date_format("observed_at", "yyyy-MM").alias("month")).distinct()
    rows = merged.withColumn("month", F.date_format("observed_at", "yyyy-MM")).join(months, "month", "left_semi")
    rows = materialize(rows, "weather-months")  # the store is read above and written below
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def refresh_store(bounds: DataFrame, pages: DataFrame | None, path: str) -> DataFrame:
    """Hourly weather of a date range (one row: start_date, end_date), completing the store at ``path``.

    Hours the store lacks are taken from the pages (year, month, html) of
    their months; what then is missing gets calendar-month means.  Returns
    the hours of the range; the store keeps all parsed hours.
    """
    spark = bounds.sparkSession
    wanted = hours_of(bounds, "start_date", "end_date").select("observed_at")
    stored = read_weather_store(spark, path)
    missing = materialize(missing_hours(wanted, stored), "missing-hours")
    new = None
    if pages is not None:
        months = missing.select(F.year("observed_at").alias("year"), F.month("observed_at").alias("month")).distinct()
        rows = page_table_rows(pages.join(months, ["year", "month"], "left_semi"))
        parsed = expand_daily_to_hourly(keep_one_per_key(
            daily_record_from_cells(rows, F.col("year"), F.col("month")), ["day"],
            [F.col(c) for c in ("temp_celsius", "pressure_hpa", "wind_speed_ms")], keep="first"))
        new = materialize(missing_hours(parsed, stored), "parsed-hours")
    known = stored if new is None else merge_store(stored, new)
    filled = fill_future_hours(missing_hours(missing, known), monthly_means(known))
    added = filled if new is None else new.select(*WEATHER_COLUMNS).unionByName(filled.select(*WEATHER_COLUMNS))
    added = materialize(added.select(*WEATHER_COLUMNS), "added-hours")
    merged = merge_store(stored, added)
    write_store(merged, added, path)
    start, end = bounds.select("start_date").scalar(), bounds.select("end_date").scalar()
    return in_time_range(read_weather_store(spark, path), start, end)
