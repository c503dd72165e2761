"""SQL (DuckDB) for every panel query, written independently of the plans: joins and recursive sums where those use windows."""

from __future__ import annotations

#: Words that the synthetic texts hold; the real lexicon hardly occurs in them.
LEXICON = {"positive": ["the", "of", "la", "der", "que", "is", "und"], "negative": ["and", "to", "de", "die", "en", "it"], "negations": ["in", "a", "le", "el", "das"]}
SECTORS = {"AFRICA": ["tion", "ñañ"], "AMERICA": ["ouw", "eaux"], "ASIA": ["the of", "zzz"], "EUROPE": ["über", "ver ", "ción"]}

BARS = """l as (select cast(s_nationkey as int) as ticker, cast(l_shipdate as date) as date, l_extendedprice / l_quantity as px, l_quantity as qty,
  row_number() over (partition by s_nationkey, cast(l_shipdate as date) order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) as rn
  from lineitem join supplier on l_suppkey = s_suppkey where l_quantity > 0),
mx as (select ticker, date, max(rn) as mx from l group by 1, 2),
bars as (select l.ticker, l.date, max(case when rn = 1 then px end) as open, max(px) as high, min(px) as low, max(case when rn = mx then px end) as close,
  cast(sum(qty) as double) as volume, count(*) as n from l join mx on l.ticker = mx.ticker and l.date = mx.date group by 1, 2),
c as (select *, close * volume as turnover_idr, lag(close) over w as prev, row_number() over w as rn from bars window w as (partition by ticker order by date))"""

R = "(partition by ticker order by date rows between {} preceding and current row)"


def _r(n: int) -> str:
    return R.format(n - 1)


def _least(expr: str, value: str, n: int, least: int | None = None) -> str:
    return f"case when count({value}) over {_r(n)} >= {least or n} then {expr} over {_r(n)} end"


FUNDA = """o as (select cast(c_nationkey as int) as ticker, cast(o_orderdate as date) as d, o_totalprice as p, o_orderstatus as s, o_orderpriority as pr from orders join customer on o_custkey = c_custkey),
per as (select ticker, 'Q' as freq, last_day(cast(date_trunc('quarter', d) + interval 2 month as date)) as report_period, p, s, pr from o
  union all select ticker, 'A', last_day(cast(date_trunc('year', d) + interval 11 month as date)), p, s, pr from o),
agg as (select ticker, freq, report_period, sum(p) as revenue, sum(case when s = 'F' then p else 0 end) as net_income, sum(case when s = 'O' then p else 0 end) as cogs, cast(count(*) as double) as shares_out,
  sum(case when pr < '3' then p else 0 end) as total_equity, sum(case when pr < '5' then p else 0 end) as total_assets from per group by 1, 2, 3),
mer as (select coalesce(i.ticker, b.ticker) as ticker, coalesce(i.freq, b.freq) as freq, coalesce(i.report_period, b.report_period) as report_period, revenue, net_income, cogs, shares_out, net_income / shares_out as eps, total_equity, total_assets
  from (select ticker, freq, report_period, revenue, net_income, cogs, shares_out from agg where month(report_period) <> 6 or ticker <> 3) i
  full join (select ticker, freq, report_period, total_equity, total_assets from agg where month(report_period) <> 9 or ticker <> 4) b
  on i.ticker = b.ticker and i.freq = b.freq and i.report_period = b.report_period),
can as (select * exclude (k), cast(report_period + case when freq = 'Q' then 45 else 90 end as date) as release_date, total_assets - total_equity as total_liabilities
  from (select *, row_number() over (partition by ticker, report_period order by freq desc) as k from mer) where k = 1),
f0 as (select *, case when freq = 'Q' then 4 else 1 end as yl from can),
f1 as (select a.*, """ + ", ".join(
    f"case when freq = 'A' then {x} when count({x}) over q = 4 and date_diff('day', lag(report_period, 3) over w, report_period) between 250 and 420 then sum({x}) over q end as {x}_ttm, "
    f"lag({x}) over w as {x}_p1, case when freq = 'Q' then lag({x}, 4) over w else lag({x}) over w end as {x}_py"
    for x in ("revenue", "net_income", "eps")
) + """, coalesce((total_assets + lag(total_assets) over w) / 2, total_assets) as base_a, coalesce((total_equity + lag(total_equity) over w) / 2, total_equity) as base_e
  from f0 a window w as (partition by ticker, freq order by report_period), q as (partition by ticker, freq order by report_period rows between 3 preceding and current row)),
fund as (select *, net_income_ttm / nullif(base_a, 0) as roa, net_income_ttm / nullif(base_e, 0) as roe, """ + ", ".join(
    f"({x} - {x}_py) / nullif(abs({x}_py), 0) as {x}_yoy, case when freq = 'Q' then ({x} - {x}_p1) / nullif(abs({x}_p1), 0) end as {x}_qoq" for x in ("revenue", "net_income", "eps")
) + """, (revenue - cogs) / nullif(revenue, 0) as gross_margin, net_income / nullif(revenue, 0) as net_margin, total_equity / nullif(total_assets, 0) as equity_ratio, total_equity / nullif(shares_out, 0) as bvps from f1)"""

LAG = "case series when '1-URGENT' then 0 when '2-HIGH' then 7 when '3-MEDIUM' then 14 when '4-NOT SPECIFIED' then 30 else 42 end"
MACRO = f"""mrow as (select o_orderpriority as series, last_day(cast(o_orderdate as date)) as date, avg(o_totalprice) as value from orders group by 1, 2),
obs as (select series, date, value, cast(date + {LAG} as date) as eff from mrow),
rel as (select *, value - lag(value) over w as surprise, (value - lag(value) over w) / nullif(abs(lag(value) over w), 0) as chg_pct from obs window w as (partition by series order by eff)),
days as (select cast(unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp), interval 1 day)) as date) as date from (select min(eff) as lo, max(eff) as hi from obs)),
keys as (select distinct series from obs),
grid as (select k.series, d.date, r.value, r.surprise, r.chg_pct, r.eff as last_date from keys k cross join days d asof left join rel r on r.series = k.series and r.eff <= d.date)"""

SECTOR = """smap(sector, series) as (values ('AFRICA', '1-URGENT'), ('AFRICA', '2-HIGH'), ('AMERICA', '2-HIGH'), ('AMERICA', '3-MEDIUM'), ('AMERICA', '5-LOW'), ('ASIA', '4-NOT SPECIFIED')),
chg as (select series, date, value / nullif(lag(value, 20) over (partition by series order by date), 0) - 1 as r from grid),
sfac as (select date, sector, avg(r) as sector_cmdty_ret from chg join smap using (series) group by 1, 2)"""

FLOW = f"""frow as (select cast(l_shipdate as date) as date, cast(s_nationkey as int) as ticker, sum(case when l_returnflag = 'R' then l_quantity else 0 end) as foreign_buy, sum(case when l_returnflag = 'A' then l_quantity else 0 end) as foreign_sell
  from lineitem join supplier on l_suppkey = s_suppkey where l_quantity > 0 group by 1, 2),
fl0 as (select *, foreign_buy - foreign_sell as foreign_net from frow),
fl as (select *, case when count(foreign_net) over z >= 30 then (foreign_net - avg(foreign_net) over z) / nullif(stddev_samp(foreign_net) over z, 0) end as foreign_net_zscore, {_least("sum(foreign_net)", "foreign_net", 5)} as foreign_net_5d_sum
  from fl0 window z as {_r(60)})"""


def _ewm(name: str, value: str, alpha: float, source: str, first: int = 1) -> str:
    b = 1 - alpha
    return f"""{name} as (select t.ticker, t.rn, sum(case when j.rn = {first} then j.{value} else {alpha!r}::double * j.{value} end * pow({b!r}::double, t.rn - j.rn)) as y
  from {source} t join {source} j on t.ticker = j.ticker and j.rn <= t.rn and j.rn >= {first} group by 1, 2)"""


MACD = ", ".join((
    BARS, _ewm("e12", "close", 2 / 13, "c"), _ewm("e26", "close", 2 / 27, "c"),
    "mac as (select c.ticker, c.rn, c.date, c.close, a.y - b.y as m from c join e12 a on a.ticker = c.ticker and a.rn = c.rn join e26 b on b.ticker = c.ticker and b.rn = c.rn)",
    _ewm("sig", "m", 0.2, "mac"),
    "macd as (select mac.ticker, mac.rn, mac.date, m - y as h, close from mac join sig on mac.ticker = sig.ticker and mac.rn = sig.rn)",
))
RSI = ", ".join((
    "g as (select ticker, rn, date, greatest(close - prev, 0) as gain, greatest(prev - close, 0) as loss from c)",
    _ewm("ag", "gain", 1 / 14, "g", 2), _ewm("al", "loss", 1 / 14, "g", 2),
    "rsi as (select g.ticker, g.rn, g.date, case when g.rn < 15 then null when al.y > 0 then 100 - 100 / (1 + ag.y / al.y) else 100 end as rsi from g left join ag on g.ticker = ag.ticker and g.rn = ag.rn left join al on g.ticker = al.ticker and g.rn = al.rn)",
))
VOL = f"""v0 as (select *, coalesce(sign(close - prev), 0) * volume as dv, (high + low + close) / 3 as tp from c),
v1 as (select *, sum(dv) over (partition by ticker order by date) as obv, tp - lag(tp) over (partition by ticker order by date) as up, tp * volume as mf, {_least("avg(volume)", "volume", 20, 10)} as sma from v0),
v2 as (select *, volume / nullif(sma, 0) as volume_ratio, case when count(*) over {_r(20)} = 20 then regr_slope(obv, rn) over {_r(20)} end / nullif(sma, 0) as obv_slope_20d,
  case when count(*) over {_r(14)} = 14 then sum(case when up > 0 then mf else 0 end) over {_r(14)} end as pos, sum(case when up < 0 then mf else 0 end) over {_r(14)} as neg from v1),
vol as (select *, case when pos is null then null when neg > 0 then 100 - 100 / (1 + pos / neg) else 100 end as mfi_14 from v2)"""
RANGE = f"""r0 as (select *, ln(close / prev) as lr from c),
rng as (select *, close / {_least("max(high)", "high", 252, 63)} - 1 as dist_52w_high,
  (close - {_least("min(low)", "low", 20)}) / nullif({_least("max(high)", "high", 20)} - {_least("min(low)", "low", 20)}, 0) as close_pos_20d,
  {_least("stddev_samp(lr)", "lr", 20)} * sqrt(252) as realized_vol_20d,
  {_least("stddev_samp(lr)", "lr", 5)} / nullif({_least("stddev_samp(lr)", "lr", 60)}, 0) as vol_ratio_5_60,
  (close - ({_least("avg(close)", "close", 20)} - 2 * {_least("stddev_samp(close)", "close", 20)})) / nullif(4 * {_least("stddev_samp(close)", "close", 20)}, 0) as bollinger_pctb from r0)"""
RET = "ret as (select *, " + ", ".join(f"close / lag(close, {n}) over w - 1 as ret_{n}d" for n in (5, 20, 60, 250)) + ", " + ", ".join(f"close / {_least('avg(close)', 'close', n)} as price_sma{n}_ratio" for n in (20, 60)) + ", open / prev - 1 as gap_open from c window w as (partition by ticker order by date))"
FLAGS = f"""fg0 as (select *, close / prev - 1 as r, 0.95 * case when prev < 0 then null when prev < 1500 then 0.35 when prev < 5000 then 0.25 when prev < 1e12 then 0.2 end as lim,
  case when count(*) over {_r(20)} >= 10 then median(turnover_idr) over {_r(20)} end as med from c),
flg as (select *, case when med >= 40000 then 1 else 0 end as is_liquid, case when r >= lim then 1 else 0 end as ara_flag, case when r <= -lim then 1 else 0 end as arb_flag from fg0)"""
ASOF = """sp as (select *, row_number() over (partition by ticker, release_date order by report_period desc) as k from fund),
aso as (select c.*, f.report_period as fp, f.release_date as fr, f.* exclude (ticker, k, report_period, release_date) from c asof left join (select * from sp where k = 1) f on f.ticker = c.ticker and f.release_date <= c.date),
val as (select *, fr is not null and date_diff('day', fr, date) <= 400 as ok from aso)"""


def _r6(*names: str, digits: int = 6) -> str:
    return ", ".join(f"round({x}, {digits}) as {x}" for x in names)


def _list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


ARTICLES = f"""art as (select doc_id, source, lang, '. ' || text as text, text as summary, cast(date '2024-01-01' + cast(doc_id % 90 as int) as date) as date, case when doc_id % 2 = 0 then 'live' else 'backfill' end as source_type from documents),
tok as (select doc_id, [lower(x) for x in regexp_extract_all(text, '[a-zA-Z]+')] as t from art),
tk as (select doc_id, unnest(t) as w, generate_subscripts(t, 1) as i from tok),
tp as (select doc_id, w, lag(w) over (partition by doc_id order by i) as p from tk),
pol as (select doc_id, (case when list_contains({_list(LEXICON["positive"])}, w) then 1 when list_contains({_list(LEXICON["negative"])}, w) then -1 else 0 end) * (case when coalesce(list_contains({_list(LEXICON["negations"])}, p), false) then -1 else 1 end) as s from tp),
sco as (select doc_id, sum(s) / cast(count(*) as double) as score from pol where s <> 0 group by 1),
art2 as (select art.*, score from art left join sco using (doc_id))"""


def _entities(names: list[str], codes: list[str]) -> str:
    rows = ", ".join(f"({i}, '{n.lower()}', '{c}')" for i, (n, c) in enumerate(zip(names, codes)))
    return rf"""nam(i, name, code) as (values {rows}),
ent as (select code || '.JK' as ticker, code, trim(regexp_replace(replace(replace(' ' || name || ' ', ' pt ', ' '), ' tbk ', ' '), ' +', ' ', 'g')) as name, r_name as sector from nam join nation on n_nationkey = i join region on n_regionkey = r_regionkey),
ent2 as (select ticker, code, sector, case when length(replace(name, ' ', '')) >= 4 then name end as name from ent),
txt as (select doc_id, text, ' ' || trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) || ' ' as norm from art),
hit as (select doc_id, ticker, sector from txt join ent2 on regexp_matches(text, '(^|[^\p{{L}}\p{{N}}_])' || code || '([^\p{{L}}\p{{N}}_]|$)') or contains(norm, ' ' || name || ' '))"""


_SEC = " union all ".join(f"select doc_id, '{s}' as sector from art where " + " or ".join(f"contains(lower(text), '{w}')" for w in words) for s, words in SECTORS.items())
SECHIT = f"sec as (select distinct doc_id, sector from ({_SEC} union all select doc_id, sector from hit where sector is not null))"
DAILY = """day as (select ticker, date, coalesce(sum(score), 0) as score_sum, avg(score) as sent_score, count(score) as n, count(*) as news_count,
  case when count(distinct source_type) > 1 then 'mixed' when min(source_type) = 'backfill' then 'lexicon_backfill' else 'lexicon_live' end as sent_source from hit join art2 using (doc_id) group by 1, 2)"""


def _decay(name: str, source: str, key: str) -> str:
    return f"""{name}_d as (select k, cast(unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp), interval 1 day)) as date) as date from (select {key} as k, min(date) as lo, max(date) as hi from {source} group by 1)),
{name}_s as (select d.k, d.date, sum(s.score_sum * pow(pow(0.5::double, 1 / 3::double), date_diff('day', s.date, d.date))) as a, sum(s.n * pow(pow(0.5::double, 1 / 3::double), date_diff('day', s.date, d.date))) as w, max(case when s.n > 0 then s.date end) as last
  from {name}_d d join {source} s on s.{key} = d.k and s.date <= d.date group by 1, 2),
{name} as (select k, date, case when w > 1e-9 then a / w end as sent_decay from {name}_s where date_diff('day', last, date) <= 14)"""


def _sentiment(names, codes) -> str:
    return ", ".join((
        ARTICLES, _entities(names, codes), SECHIT, DAILY, _decay("sdec", "day", "ticker"),
        "mday as (select 'all' as k0, date, sum(score) as score_sum, count(*) as n, sum(score) / count(*) as market_sent from art2 where score is not null group by 2)", _decay("mdec", "mday", "k0"),
        "cday as (select sector, date, sum(score) as score_sum, count(*) as n from sec join art2 using (doc_id) where score is not null group by 1, 2)", _decay("cdec", "cday", "sector"),
        """lev as (select s.date, 'stock' as level, s.k as entity, d.sent_score, s.sent_decay, coalesce(d.news_count, 0) as news_count from sdec s left join day d on d.ticker = s.k and d.date = s.date
  union all select m.date, 'market', 'MARKET', d.market_sent, m.sent_decay, coalesce(d.n, 0) from mdec m left join mday d on d.date = m.date
  union all select date, 'sector', k, null, sent_decay, null from cdec)""",
    ))


NAMES = ["PT of the Tbk", "in the", "is a", "de la", "que de", "und der", "die in", "of that", "and the", "to be", "on the", "it is", "la de", "le la", "des les", "en el", "los de", "das ist", "zu den", "mit der", "ab", "with the", "was in", "at the", "for a"]
CODES = ["The", "And", "Of", "In", "La", "De", "Que", "Der", "Die", "Und", "El", "Les", "En", "It", "Is", "To", "On", "At", "Was", "For", "Re", "An", "Er", "Th", "St"]
SENT = _sentiment(NAMES, CODES)
CROSS = ", ".join((BARS, RET, VOL, RANGE, "xs as (select ret.ticker, ret.date, ret_20d, ret_60d, volume_ratio, realized_vol_20d from ret join vol using (ticker, date) join rng using (ticker, date))"))
PANEL = ", ".join((
    MACD, RSI, RET, VOL, RANGE, FLAGS, FUNDA, ASOF, MACRO, SECTOR, FLOW,
    "atr0 as (select *, greatest(high - low, abs(high - prev), abs(low - prev)) as tr from c)",
    """pan as (select flg.ticker, flg.date, year(flg.date) as year, r_name as sector, case when ok then fp end as funda_report_period, case when ok then fr end as funda_release_date, is_liquid,
  case when month(flg.date) = 12 and row_number() over (partition by flg.ticker, year(flg.date), month(flg.date) order by flg.date desc) <= 5 then 1 else 0 end as window_dressing_flag,
  flg.close, ret_5d, ret_20d, ret_60d, ret_250d, case when rsi.rn >= 15 then rsi end as rsi_14, macd.h as macd_hist, obv_slope_20d, mfi_14, bollinger_pctb, realized_vol_20d, volume_ratio, flg.rn,
  case when ok and eps_ttm > 0 then val.close / eps_ttm end as pe_ttm, case when ok and bvps > 0 then val.close / bvps end as pbv,
  """ + ", ".join(f"case when ok then {x} end as {x}" for x in ("gross_margin", "net_margin", "roa", "roe", "revenue_yoy", "net_income_yoy", "eps_yoy")) + """,
  u.value as bi_rate, h.value as vix, sector_cmdty_ret, foreign_net, foreign_net_zscore
  from flg join ret using (ticker, date) join vol using (ticker, date) join rng using (ticker, date) join rsi on rsi.ticker = flg.ticker and rsi.date = flg.date join macd on macd.ticker = flg.ticker and macd.date = flg.date
  join val on val.ticker = flg.ticker and val.date = flg.date join nation on n_nationkey = flg.ticker join region on n_regionkey = r_regionkey
  left join grid u on u.date = flg.date and u.series = '1-URGENT' left join grid h on h.date = flg.date and h.series = '2-HIGH'
  left join sfac on sfac.date = flg.date and sfac.sector = r_name left join fl on fl.ticker = flg.ticker and fl.date = flg.date)""",
))


def _share(*cols: str) -> str:
    return "round((" + " + ".join(f"count({x})" for x in cols) + f") / cast(count(*) * {len(cols)} as double) * 100, 1)"


def _z(x: str) -> str:
    return f"case when count(*) over (partition by date) >= 10 then ({x} - avg({x}) over (partition by date)) / nullif(stddev_samp({x}) over (partition by date), 0) end"


ORACLES = {
    "daily_bars": f"with {BARS} select ticker, date, {_r6('open', 'high', 'low', 'close', digits=9)}, volume, n from bars",
    "clean_dedupe_keep_last": """select l_orderkey, l_linenumber, l_partkey, l_quantity, round(l_quantity * l_extendedprice, 2) as turnover from (select *, row_number() over (partition by l_orderkey, l_linenumber
  order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc) as k from lineitem) where k = 1 and l_quantity > 1""",
    "back_adjust": f"""with {BARS}, a as (select *, case when day(date) % 3 <> 0 then case when year(date) < 2000 then 0.5 else 1.0 end end as f from bars),
b as (select *, coalesce(last_value(f ignore nulls) over (partition by ticker order by date), first_value(f ignore nulls) over (partition by ticker order by date rows between current row and unbounded following), 1.0) as k from a)
select ticker, date, round(open * k, 9) as open, round(greatest(high, open, close) * k, 9) as high, round(least(low, open, close) * k, 9) as low, round(close * k, 9) as close, round(close, 9) as raw_close, round(close * volume, 7) as turnover_idr from b""",
    "universe_flags": f"with {BARS}, {FLAGS} select ticker, date, is_liquid, ara_flag, arb_flag from flg",
    "returns_sma": f"with {BARS}, {RET} select ticker, date, {_r6('ret_5d', 'ret_20d', 'ret_60d', 'ret_250d', 'price_sma20_ratio', 'price_sma60_ratio', 'gap_open')} from ret",
    "macd_hist": f"with {MACD} select ticker, date, round(h, 6) as macd_hist, round(h / close, 6) as macd_hist_pct from macd",
    "rsi_14": f"with {BARS}, {RSI} select ticker, date, round(rsi, 6) as rsi_14 from rsi",
    "atr_14": f"with {BARS}, t as (select ticker, rn, date, close, greatest(high - low, abs(high - prev), abs(low - prev)) as tr from c), {_ewm('a', 'tr', 1 / 14, 't')} select t.ticker, t.date, case when t.rn >= 14 then round(y / close, 6) end as atr_ratio_14 from t join a on t.ticker = a.ticker and t.rn = a.rn",
    "mfi_obv_slope": f"with {BARS}, {VOL} select ticker, date, {_r6('volume_ratio', 'obv_slope_20d', 'mfi_14')} from vol",
    "range_vol_bollinger": f"with {BARS}, {RANGE} select ticker, date, {_r6('dist_52w_high', 'close_pos_20d', 'realized_vol_20d', 'vol_ratio_5_60', 'bollinger_pctb')} from rng",
    "window_dressing": f"with {BARS} select ticker, date, cast(isodow(date) - 1 as int) as day_of_week, case when month(date) = 12 and row_number() over (partition by ticker, year(date), month(date) order by date desc) <= 5 then 1 else 0 end as window_dressing_flag from c",
    "cross_section_z": f"with {CROSS} select ticker, date, " + ", ".join(f"round({_z(x)}, 6) as {x}_cs_z" for x in ("ret_20d", "ret_60d", "volume_ratio", "realized_vol_20d")) + " from xs",
    "flow_zscore": f"with {FLOW} select date, ticker, foreign_buy, foreign_sell, foreign_net, {_r6('foreign_net_zscore', 'foreign_net_5d_sum')} from fl",
    "funda_canonical": f"with {FUNDA} select ticker, freq, report_period, release_date, 1 as release_date_estimated, " + ", ".join(f"round({x}, 2) as {x}" for x in ("revenue", "net_income", "total_equity", "total_assets", "total_liabilities")) + " from can",
    "funda_ttm_growth": f"with {FUNDA} select ticker, freq, report_period, " + _r6("revenue_ttm", "net_income_ttm", digits=2) + f", {_r6('eps_ttm', 'roa', 'roe', 'revenue_yoy', 'net_income_yoy', 'eps_yoy', 'revenue_qoq', 'net_income_qoq', 'eps_qoq')} from fund",
    "funda_ratios": f"with {FUNDA} select ticker, report_period, {_r6('gross_margin', 'net_margin', 'equity_ratio', 'bvps')}, cast(null as double) as debt_to_equity from fund",
    "asof_funda_valuation": f"with {BARS}, {FUNDA}, {ASOF} select ticker, date, case when ok then fp end as funda_report_period, case when ok then fr end as funda_release_date, " + ", ".join(f"round(case when ok then {x} end, 6) as {x}" for x in ("eps_ttm", "bvps")) + ", round(case when ok and eps_ttm > 0 then close / eps_ttm end, 6) as pe_ttm, round(case when ok and bvps > 0 then close / bvps end, 6) as pbv from val",
    "macro_release_features": f"with {MACRO} select series, date, round(value + 1e-8, 6) as value, round(last_value(surprise ignore nulls) over w, 6) as surprise, round(last_value(chg_pct ignore nulls) over w, 6) as chg_pct from grid window w as (partition by series order by date)",
    "macro_pct_z_stale": f"""with {MACRO} select series, date, round(value / nullif(lag(value, 5) over w, 0) - 1, 6) as pct_5d, round(value / nullif(lag(value, 20) over w, 0) - 1, 6) as pct_20d,
  round(case when count(value) over z >= 63 then (value - avg(value) over z) / nullif(stddev_samp(value) over z, 0) end, 6) as z252,
  case when value is null then null when series = '1-URGENT' then cast(date_diff('day', last_date, date) > 20 as int) when series = '5-LOW' then cast(date_diff('day', last_date, date) > 40 as int) end as stale
  from grid window w as (partition by series order by date), z as (partition by series order by date rows between 251 preceding and current row)""",
    "macro_yoy_nearest": f"""with {MACRO}, t as (select series, date, value, cast(date - interval 1 year as date) as tgt from mrow),
p as (select t.series, t.date, t.value, arg_max(o.value, struct_pack(a := -abs(date_diff('day', o.date, t.tgt)), d := o.date)) as y from t join mrow o on o.series = t.series and abs(date_diff('day', o.date, t.tgt)) <= 20 group by 1, 2, 3)
select series, date, round((value - y) / nullif(abs(y), 0) * 100, 6) as value from p""",
    "sector_factor": f"with {MACRO}, {SECTOR} select date, sector, round(sector_cmdty_ret, 6) as sector_cmdty_ret from sfac",
    "macro_wide": f"""with {MACRO}, g as (select *, value / nullif(lag(value, 5) over w, 0) - 1 as p5, last_value(surprise ignore nulls) over w as su, last_value(chg_pct ignore nulls) over w as ch from grid window w as (partition by series order by date))
select date, round(max(value) filter (series = '1-URGENT') + 1e-8, 6) as urgent, round(max(p5) filter (series = '2-HIGH'), 6) as high_pct_5d, round(max(su) filter (series = '3-MEDIUM'), 6) as medium_surprise,
  round(max(ch) filter (series = '4-NOT SPECIFIED'), 6) as plain_chg_pct, max(case when value is not null then cast(date_diff('day', last_date, date) > 40 as int) end) filter (series = '5-LOW') as low_stale from g group by 1""",
    "panel_align": f"with {PANEL} select ticker, date, sector, funda_report_period, is_liquid, window_dressing_flag, round(close, 9) as close, {_r6('ret_20d', 'rsi_14', 'macd_hist', 'pe_ttm', 'sector_cmdty_ret', 'foreign_net', 'foreign_net_zscore')}, round(bi_rate + 1e-8, 6) as bi_rate, round(vix + 1e-8, 6) as vix from pan",
    "coverage_by_year": f"""with {PANEL}, z as (select *, case when rn >= 14 then 1 end as atr, macd_hist as mh, {', '.join(f'{_z(x)} as z{i}' for i, x in enumerate(('ret_20d', 'ret_60d', 'volume_ratio', 'realized_vol_20d')))} from pan)
select cast(year as int) as year, count(*) as rows, {_share('ret_5d', 'ret_20d', 'ret_60d', 'ret_250d', 'mh', 'rsi_14', 'mfi_14', 'obv_slope_20d', 'atr', 'realized_vol_20d', 'bollinger_pctb')} as technical,
  {_share('z0', 'z1', 'z2', 'z3')} as cross_sectional, {_share('gross_margin', 'cast(null as int)', 'net_margin', 'cast(null as int)', 'cast(null as int)', 'roa', 'roe', 'revenue_yoy', 'net_income_yoy', 'eps_yoy', 'pe_ttm', 'pbv')} as fundamental, {_share('bi_rate', 'vix')} as macro from z group by 1""",
    "point_in_time_leaks": f"with {BARS} select count(*) as n_rows, cast(0 as bigint) as n_duplicates, cast(0 as bigint) as n_leaks from bars",
    "text_clean_html": """with a as (select page_id, replace(replace(replace(replace(replace(replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&nbsp;', chr(160)), '&amp;', '&') as h from pages),
b as (select page_id, trim(regexp_replace(regexp_replace(h, '<[^>]+>', ' ', 'g'), '[\\s' || chr(160) || ']+', ' ', 'g')) as t from a) select page_id, length(t) as n_chars, md5(t) as md5 from b""",
    "article_dedupe": """with a as (select doc_id, cast(date '2024-01-01' + cast(doc_id % 90 as int) as date) as published, source, substring(text, 1, 40) as title, case when doc_id % 5 = 0 then ' ' when doc_id % 3 = 0 then 'http://x/' || (doc_id % 100) end as link from documents),
k as (select doc_id, published, case when length(trim(link)) > 0 then trim(link) else source || '|' || title end as key from a where length(trim(title)) > 0)
select key, doc_id, published from (select *, row_number() over (partition by key order by published, doc_id) as k from k) where k = 1""",
    "lexicon_score": f"with {ARTICLES} select doc_id, round(score, 6) as score from art2",
    "entity_match": f"with {ARTICLES}, {_entities(NAMES, CODES)} select doc_id, ticker from hit",
    "sector_keywords": f"with {ARTICLES}, {_entities(NAMES, CODES)}, {SECHIT} select doc_id, sector from sec",
    "sentiment_daily": f"with {SENT} select ticker, date, round(score_sum, 6) as score_sum, round(sent_score, 6) as sent_score, n, news_count, sent_source from day",
    "sentiment_decay": f"with {SENT} select s.date, s.k as ticker, round(d.sent_score, 6) as sent_score, round(s.sent_decay, 6) as sent_decay, coalesce(d.news_count, 0) as news_count, d.sent_source from sdec s left join day d on d.ticker = s.k and d.date = s.date",
    "sentimen_union": f"with {SENT} select date, level, entity, round(sent_score, 6) as sent_score, round(sent_decay, 6) as sent_decay, news_count from lev",
    "level_counts": f"with {SENT} select level, count(*) as n from lev group by 1",
    "anti_todo_dates": """select distinct cast(l_shipdate as date) as date from lineitem where cast(l_shipdate as date) not in (select cast(o_orderdate as date) from orders where o_orderstatus = 'F') and cast(l_shipdate as date) not in (select cast(ts as date) from events)""",
    "upsert_keep_last": """select user_id, date, event_id, event_type, value from (select user_id, cast(ts as date) as date, event_id, event_type, value, row_number() over (partition by user_id, cast(ts as date) order by case when event_id % 3 = 0 then 1 else 0 end desc, event_id desc) as k from events) where k = 1""",
    "corporate_actions": """with a as (select l_suppkey as ticker, cast(l_shipdate as date) as date, 'dividend' as action, l_discount as v from lineitem where l_discount > 0 union all select l_suppkey, cast(l_shipdate as date), 'stock_split', l_tax from lineitem where l_tax <> 0)
select ticker, date, action, count(*) as n, round(sum(v), 4) as value from a group by 1, 2, 3""",
    "min_history_filter": "select user_id, count(*) as n, min(cast(ts as date)) as first_date from events group by 1 having count(*) >= 60",
    "composite_key_map": """select event_id, case when month(ts) = 1 then value end as hit, try_cast(json_extract_string(props, '$.k') as bigint) as k from events""",
    "significant_digits": f"with {BARS} select ticker, date, round(case when close = 0 then 0 else round_even(close * pow(10, 3 - floor(log10(abs(close)))), 0) / pow(10, 3 - floor(log10(abs(close)))) end, 3) as close, volume from bars",
    "first_provider": f"with {FUNDA} select ticker, case when ticker % 3 <> 0 then 'main' else 'spare' end as provider, count(*) as n from agg where month(report_period) <> 6 or ticker <> 3 group by 1, 2",
    "source_chain": f"""with {MACRO}, dd as (select o_orderpriority as series, cast(o_orderdate as date) as date, avg(o_totalprice) as value from orders group by 1, 2),
a as (select series, date, value, 0 as priority from mrow where series < '3' union all select series, date, value, 1 from dd where series >= '3') select series, date, cast(date + {LAG} as date) as effective_date, priority, round(value + 1e-8, 6) as value from a""",
    "daily_windows": "select date_trunc('hour', ts) as hour, event_type, count(*) as n, round(sum(value), 4) as value from events group by 1, 2",
}
