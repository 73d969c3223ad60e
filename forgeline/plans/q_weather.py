"""Queries: ambient weather."""

from __future__ import annotations

from pyspark.sql import functions as F

from forgeline.functions import expr as X
from forgeline.operators import weather as WX
from forgeline.plans import layers as L
from forgeline.plans.oracle import oracle
from forgeline.plans.registry import big, r6, register
from forgeline.sources import fixtures as fx

# Historic store ends here; later order days are the "future" to fill.
STORE_END = "2000-07-31"

_W_CTES = [
    ("w_hourly", """select unnest(generate_series(cast(day as timestamp), cast(day as timestamp) + interval 23 hour, interval 1 hour)) as observed_at,
        temp_celsius, cast(null as double) as humidity_pct, cast(pressure_hpa as double) as pressure_hpa,
        round(wind_kmh / 3.6, 3) as wind_speed_ms, false as is_imputed from w_daily"""),
    ("w_means", """select month(observed_at) as month, avg(temp_celsius) as temp_celsius, avg(pressure_hpa) as pressure_hpa,
        avg(wind_speed_ms) as wind_speed_ms from w_hourly where not is_imputed group by 1"""),
    ("w_store", f"select * from w_hourly where observed_at < timestamp '{STORE_END}' + interval 1 day"),
    ("w_store_means", """select month(observed_at) as month, avg(temp_celsius) as temp_celsius, avg(pressure_hpa) as pressure_hpa,
        avg(wind_speed_ms) as wind_speed_ms from w_store where not is_imputed group by 1"""),
    ("w_future_hours", f"""select unnest(generate_series(timestamp '{STORE_END}' + interval 1 day,
        (select cast(cast(max(o_orderdate) as date) as timestamp) from orders) + interval 23 hour, interval 1 hour)) as observed_at"""),
    ("w_filled", """select f.observed_at, m.temp_celsius, cast(null as double) as humidity_pct, m.pressure_hpa, m.wind_speed_ms, true as is_imputed
        from w_future_hours f left join w_store_means m on month(f.observed_at) = m.month"""),
    ("w_cells_rec", """select day, try_cast(nullif(regexp_extract(replace(trim(t_mean_text), ',', '.'), '^-?[0-9]+(\\.[0-9]+)?', 0), '') as double) as temp_celsius,
        try_cast(nullif(regexp_extract(replace(trim(wind_text), ',', '.'), '^-?[0-9]+(\\.[0-9]+)?', 0), '') as double) as wind_kmh,
        try_cast(nullif(regexp_extract(replace(trim(p_min_text), ',', '.'), '^-?[0-9]+(\\.[0-9]+)?', 0), '') as double) as p_min,
        try_cast(nullif(regexp_extract(replace(trim(p_max_text), ',', '.'), '^-?[0-9]+(\\.[0-9]+)?', 0), '') as double) as p_max
      from w_cells"""),
]


def _store(spark, sf):
    daily = fx.weather_daily(spark, sf).withColumn("wind_speed_ms", X.kmh_to_ms("wind_kmh")).withColumn(
        "pressure_hpa", F.col("pressure_hpa").cast("double"))
    return WX.expand_daily_to_hourly(daily.select("day", "temp_celsius", "pressure_hpa", "wind_speed_ms"))


def _historic(spark, sf):
    """The store of the gap-fill queries: it ends where their gap begins."""
    return _store(spark, sf).where(F.col("observed_at") < F.date_add(F.lit(STORE_END).cast("date"), 1).cast("timestamp_ntz"))


def _future(spark, sf):
    orders = fx.read_table(spark, sf, "orders")
    bounds = orders.agg(F.max(F.col("o_orderdate").cast("date")).alias("end")).select(
        F.date_add(F.lit(STORE_END).cast("date"), 1).alias("start"), "end")
    return WX.hours_of(bounds, "start", "end").select("observed_at")


def _cells(spark, sf):
    c = fx.weather_cells(spark, sf)
    empty = F.lit("")
    return c.select("day", F.array("day_label", empty, empty, "t_mean_text", "wind_text", empty, empty, empty,
                                   "p_min_text", "p_max_text").alias("cells"))


# Pages are dated a leap cycle later, where the sensor events lie.
PAGE_SHIFT_YEARS = 28

PAGE_CTES = [
    ("w_page_days", f"""select day, cast(year(day) + {PAGE_SHIFT_YEARS} as bigint) as year, cast(month(day) as bigint) as month,
        row_number() over (partition by year(day), month(day) order by day) as row_index,
        day(day) % 9 = 0 as short, day_label, t_mean_text, wind_text, p_min_text, p_max_text from w_cells"""),
    ("w_page_rows", """select year, month, row_index, case when short then [trim(day_label), 'short'] else
        [trim(day_label), '', '', trim(t_mean_text), trim(wind_text), '', '', '', trim(p_min_text), trim(p_max_text)] end as cells from w_page_days"""),
]


def weather_pages(spark, sf):
    """(year, month, html): one page per month of order days."""
    td = lambda *cells: F.concat(F.lit("<TR>"), *[x for c in cells for x in (F.lit('<td class="n">'), c, F.lit("</td>"))], F.lit("</TR>\n"))
    none, space = F.lit(""), lambda c: F.replace(F.replace(F.col(c), F.lit(" "), F.lit("&nbsp;")), F.lit("°"), F.lit("&deg;"))
    full = td(F.col("day_label"), none, none, F.concat(F.lit("<b>"), space("t_mean_text"), F.lit("</b>")), F.concat(F.lit(" \n"), space("wind_text")),
              none, none, none, F.col("p_min_text"), F.col("p_max_text"))
    row = F.when(F.day("day") % 9 == 0, td(F.col("day_label"), F.lit("short"))).otherwise(full)
    days = fx.weather_cells(spark, sf).select((F.year("day") + PAGE_SHIFT_YEARS).alias("year"), F.month("day").alias("month"), "day", row.alias("row"))
    # at most 31 rows per page
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("day", "row"))), lambda r: r["row"]), "")
    html = F.concat(F.lit('<html><table><tr><td>before</td></tr></table><DIV id="x" CLASS="toprint"><TABLE><caption><div>m<div>y</div></div></caption>'
                          "<tr><th>Date</th></tr>"), F.first("rows"), F.lit("</TABLE></DIV><table><tr><td>after</td></tr></table></html>"))
    return days.groupBy("year", "month").agg(rows.alias("rows")).groupBy("year", "month").agg(html.alias("html"))


def _wcols(df, digits: int = 6):
    r = lambda c: F.round(c, digits).alias(c)
    return df.select("observed_at", r("temp_celsius"), r("pressure_hpa"), r("wind_speed_ms"), "is_imputed")


_WSQL = "observed_at, round(temp_celsius, 6) as temp_celsius, round(pressure_hpa, 6) as pressure_hpa, round(wind_speed_ms, 6) as wind_speed_ms, is_imputed"
# means over many hourly rows are compared at 4 decimals: engines sum in different orders
_WSQL4 = _WSQL.replace(", 6)", ", 4)")


@register("g01_daily_to_hourly", oracle(f"select {_WSQL} from w_hourly", _W_CTES))
def q_g01(spark, sf):
    return _wcols(_store(spark, sf))


@register("s12_daily_weather_record", oracle(
    "select cast(day as timestamp) as day, round(temp_celsius, 6) as temp_celsius, round(coalesce(round((p_min + p_max) / 2, 2), p_min, p_max), 6) as pressure_hpa, "
    "round(round(wind_kmh / 3.6, 3), 6) as wind_speed_ms from w_cells_rec", _W_CTES))
def q_s12(spark, sf):
    rows = _cells(spark, sf)
    rec = WX.daily_record_from_cells(rows, F.year("day"), F.month("day"))
    return rec.select(F.col("day").cast("timestamp_ntz").alias("day"), r6("temp_celsius").alias("temp_celsius"), r6("pressure_hpa").alias("pressure_hpa"),
                      r6("wind_speed_ms").alias("wind_speed_ms"))


@register("p19_locale_number", oracle("select cast(day as timestamp) as day, t_mean_text, round(temp_celsius, 6) as value from w_cells_rec join w_cells using (day)", _W_CTES))
def q_p19(spark, sf):
    c = fx.weather_cells(spark, sf)
    return c.select(F.col("day").cast("timestamp_ntz").alias("day"), "t_mean_text", r6(X.locale_number("t_mean_text")).alias("value"))


@register("p20_wind_kmh_to_ms", oracle("select cast(day as timestamp) as day, round(round(wind_kmh / 3.6, 3), 6) as wind_speed_ms from w_cells_rec", _W_CTES))
def q_p20(spark, sf):
    c = fx.weather_cells(spark, sf)
    return c.select(F.col("day").cast("timestamp_ntz").alias("day"), r6(X.kmh_to_ms(X.locale_number("wind_text"))).alias("wind_speed_ms"))


@register("p21_pressure_mid_range", oracle(
    "select cast(day as timestamp) as day, round(coalesce(round((p_min + p_max) / 2, 2), p_min, p_max), 6) as pressure_hpa from w_cells_rec", _W_CTES))
def q_p21(spark, sf):
    c = fx.weather_cells(spark, sf)
    return c.select(F.col("day").cast("timestamp_ntz").alias("day"), r6(X.pressure_mid(X.locale_number("p_min_text"), X.locale_number("p_max_text"))).alias("pressure_hpa"))


@register("a12_monthly_means", oracle(
    "select cast(month as bigint) as month, round(temp_celsius, 2) as temp_celsius, round(pressure_hpa, 2) as pressure_hpa, "
    "round(wind_speed_ms, 2) as wind_speed_ms from w_means", _W_CTES))
def q_a12(spark, sf):
    m = WX.monthly_means(_store(spark, sf))
    return m.select(big("month"), *[F.round(c, 2).alias(c) for c in ("temp_celsius", "pressure_hpa", "wind_speed_ms")])


@register("g02_hour_spine", oracle("select observed_at from w_future_hours", _W_CTES))
def q_g02(spark, sf):
    return _future(spark, sf)


@register("m07_weather_gap_fill", oracle(f"select {_WSQL4} from w_filled", _W_CTES))
def q_m07(spark, sf):
    return _wcols(WX.fill_future_hours(_future(spark, sf), WX.monthly_means(_historic(spark, sf))), 4)


@register("g03_month_spine", oracle(
    "select cast(year(m) as bigint) as year, cast(month(m) as bigint) as month from (select unnest(generate_series("
    "date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), interval 1 month)) as m from orders)"))
def q_g03(spark, sf):
    o = fx.read_table(spark, sf, "orders").agg(F.min(F.col("o_orderdate").cast("date")).alias("s"),
                                               F.max(F.col("o_orderdate").cast("date")).alias("e"))
    return WX.months_of(o, "s", "e").select(big("year"), big("month"))


@register("j09_month_coverage", oracle(
    "select cast(year(m) as bigint) as year, cast(month(m) as bigint) as month from (select unnest(generate_series("
    "date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), interval 1 month)) as m from orders) "
    "where (year(m), month(m)) not in (select (year(observed_at), month(observed_at)) from w_store)", _W_CTES))
def q_j09(spark, sf):
    o = fx.read_table(spark, sf, "orders").agg(F.min(F.col("o_orderdate").cast("date")).alias("s"),
                                               F.max(F.col("o_orderdate").cast("date")).alias("e"))
    return WX.missing_months(WX.months_of(o, "s", "e"), _historic(spark, sf)).select(big("year"), big("month"))


@register("k11_weather_store_merge", oracle(
    f"select {_WSQL4} from (select * from w_store union all select * from w_filled where observed_at not in (select observed_at from w_store))",
    _W_CTES))
def q_k11(spark, sf):
    store = _historic(spark, sf)
    new = WX.fill_future_hours(_future(spark, sf), WX.monthly_means(store))
    return _wcols(WX.merge_store(store, new), 4)


@register("u04_weather_hour_dedup", oracle(
    f"select {_WSQL} from (select observed_at, temp_celsius + 1 as temp_celsius, humidity_pct, pressure_hpa, wind_speed_ms, is_imputed from w_hourly)",
    _W_CTES))
def q_u04(spark, sf):
    store = _store(spark, sf).withColumn("arrival", F.lit(0))
    resent = _store(spark, sf).withColumn("observed_at", F.col("observed_at") + F.expr("interval 30 minutes")).withColumn(
        "temp_celsius", F.col("temp_celsius") + 1).withColumn("arrival", F.lit(1))
    return _wcols(WX.silver_weather(store.unionByName(resent), "arrival"))


@register("p27_time_range_filter", oracle(
    f"select {_WSQL} from w_hourly where observed_at >= timestamp '1998-03-01' and observed_at <= timestamp '1998-06-30' + interval 23 hour",
    _W_CTES))
def q_p27(spark, sf):
    return _wcols(WX.in_time_range(_store(spark, sf), F.lit("1998-03-01").cast("date"), F.lit("1998-06-30").cast("date")))


@register("s11_page_table_rows", oracle(
    "select year, month, row_index, array_to_string(cells, '|') as cells from w_page_rows", _W_CTES + PAGE_CTES))
def q_s11(spark, sf):
    """Monthly pages written as HTML (upper-case tags, entities, nested caption, decoy tables), parsed back."""
    return WX.page_table_rows(weather_pages(spark, sf)).select(big("year"), big("month"), big("row_index"), F.array_join("cells", "|").alias("cells"))


def _gold_weather_cols(g):
    return g.select("machine_id_std", "window_start", r6("ambient_temp_c").alias("ambient_temp_c"),
                    r6("ambient_pressure_hpa").alias("ambient_pressure_hpa"), "ambient_humidity_pct")


@register("j04_ambient_weather_join", oracle(
    """select g.machine_id_std, g.window_start, round(w.temp_celsius, 6) as ambient_temp_c, round(w.pressure_hpa, 6) as ambient_pressure_hpa,
      cast(null as double) as ambient_humidity_pct
    from g_roll g left join (
      select unnest(generate_series(cast(day + interval 29 year as timestamp), cast(day + interval 29 year as timestamp) + interval 23 hour, interval 1 hour)) as window_start,
        temp_celsius, cast(pressure_hpa as double) as pressure_hpa from w_daily) w using (window_start)"""))
def q_j04(spark, sf):
    return _gold_weather_cols(L.chain(spark, sf).gold(weather=True))
