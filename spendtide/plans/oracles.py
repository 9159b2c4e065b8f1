"""Independent ANSI SQL for the named queries, written for plain tables.

Nothing here shares a formula with the operators where there is a choice: weighted
means are explicit weighted sums over all earlier rows, suppression is NOT EXISTS,
enrichment is nine left joins.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

from spendtide.config import JobConfig
from spendtide.plans import catalog as c

FACTS = {
    "": """SELECT o_orderpriority AS SERVICE, o_orderstatus AS TAG,
        CAST(o_orderdate AS DATE) AS STARTDATE, o_totalprice AS USD FROM orders""",
    "_events": """SELECT event_type AS SERVICE, CAST(user_id AS VARCHAR) AS TAG,
        CAST(ts AS DATE) AS STARTDATE, "value" AS USD FROM events""",
    "_lineitem": """SELECT l_returnflag AS SERVICE, l_linestatus AS TAG,
        CAST(l_shipdate AS DATE) AS STARTDATE, l_extendedprice AS USD FROM lineitem""",
}
FACTS["_strict"] = FACTS[""]
# A load drops repeated rows.
FACTS["_loaded_events"] = f"SELECT DISTINCT * FROM ({FACTS['_events']})"

PARTS = """CAST(year(STARTDATE) AS INTEGER) AS YEAR, CAST(month(STARTDATE) AS INTEGER) AS MONTH,
    CAST(day(STARTDATE) AS INTEGER) AS DAY"""
WEEK_KEY = "CAST(year(STARTDATE) * 100 + week(STARTDATE) AS INTEGER)"


def _r(expression: str, places: int = 3) -> str:
    return f"round({expression}, {places}) + CAST(0 AS DOUBLE)"


def _r2(expression: str) -> str:
    return f"round_even(({expression}) * 100, 0) / 100"


def _day(value: date) -> str:
    return f"DATE '{value:%Y-%m-%d}'"


def _fact(suffix: str, cfg: JobConfig | None = None) -> str:
    """The cost rows, all of them or those of the trailing window."""
    where = ""
    if cfg is not None:
        last = _day(cfg.as_of)
        where = f"""WHERE STARTDATE >= CAST({last} - INTERVAL {cfg.lookback_months} MONTH AS DATE)
            AND STARTDATE <= {last}"""
    return f"""fact AS (SELECT * FROM ({FACTS[suffix]}) {where}),
    svc_day AS (SELECT SERVICE, STARTDATE, sum(USD) AS USD FROM fact GROUP BY ALL)"""


CALENDAR = """cal AS (SELECT CAST(unnest(generate_series(
        (SELECT min(STARTDATE) FROM svc_day), (SELECT max(STARTDATE) FROM svc_day),
        INTERVAL 1 DAY)) AS DATE) AS STARTDATE)"""

FILLED = {
    "global": f"""{CALENDAR}, filled AS (
        SELECT SERVICE, STARTDATE, USD FROM svc_day
        UNION ALL
        SELECT (SELECT max(s.SERVICE) FROM svc_day s WHERE s.STARTDATE =
                (SELECT max(b.STARTDATE) FROM svc_day b WHERE b.STARTDATE < cal.STARTDATE)),
            STARTDATE, CAST(0 AS DOUBLE)
        FROM cal WHERE STARTDATE NOT IN (SELECT STARTDATE FROM svc_day))""",
    "per_service": f"""{CALENDAR}, filled AS (
        SELECT n.SERVICE, cal.STARTDATE, coalesce(d.USD, CAST(0 AS DOUBLE)) AS USD
        FROM (SELECT DISTINCT SERVICE FROM svc_day) n CROSS JOIN cal
        LEFT JOIN svc_day d ON d.SERVICE = n.SERVICE AND d.STARTDATE = cal.STARTDATE)""",
}


def _weighted(value: str, span: int, now: str = "a", then: str = "b", at: str = "t") -> str:
    """The mean as the sum of all earlier values with their weights."""
    decay = f"(1 - 2.0 / ({span} + 1.0))::DOUBLE"
    age = f"({now}.{at} - {then}.{at})"
    return f"""sum({then}.{value} * pow({decay}, {age})
        * CASE WHEN {then}.{at} = 0 THEN 1.0::DOUBLE ELSE (2.0 / ({span} + 1.0))::DOUBLE END)"""


def _lines(scope: str = "global", sign: str = "slow_minus_fast") -> str:
    """EWMs, MACD and signal of ``filled``."""
    difference = "e26 - e12" if sign == "slow_minus_fast" else "e12 - e26"
    partition = "PARTITION BY SERVICE ORDER BY STARTDATE"
    place = partition if scope == "service" else "ORDER BY STARTDATE, SERVICE"
    same = "a.SERVICE = b.SERVICE AND b.g <= a.g" if scope == "service" else "b.g <= a.g"
    return f"""placed AS (SELECT *, row_number() OVER ({partition}) - 1 AS t,
            row_number() OVER ({place}) - 1 AS g FROM filled),
    means AS (SELECT a.SERVICE, a.STARTDATE, a.USD, a.g,
            {_weighted("USD", 12)} AS e12, {_weighted("USD", 26)} AS e26
        FROM placed a JOIN placed b ON a.SERVICE = b.SERVICE AND b.t <= a.t GROUP BY ALL),
    macds AS (SELECT *, {difference} AS macd FROM means),
    lines AS (SELECT a.SERVICE, a.STARTDATE, a.USD, a.e12, a.e26, a.macd,
            {_weighted("macd", 9, at="g")} AS e9
        FROM macds a JOIN macds b ON {same} GROUP BY ALL)"""


FLAGS = """before AS (SELECT *, lag(macd) OVER w AS pm, lag(e9) OVER w AS ps FROM lines
        WINDOW w AS (PARTITION BY SERVICE ORDER BY STARTDATE)),
    flags AS (SELECT *, CAST(CASE WHEN pm >= ps AND macd < e9 THEN -1
        WHEN pm <= ps AND macd > e9 THEN 1 ELSE 0 END AS INTEGER) AS crossFlag FROM before)"""


def _z(keys: str, value: str = "USD") -> str:
    return f"""CASE WHEN max({value}) OVER (PARTITION BY {keys}) > min({value}) OVER (PARTITION BY {keys})
        THEN ({value} - avg({value}) OVER (PARTITION BY {keys}))
            / nullif(stddev_samp({value}) OVER (PARTITION BY {keys}), 0) END"""


def _trend(suffix: str, cfg: JobConfig | None = None) -> str:
    fill, scope, sign = "global", "global", "slow_minus_fast"
    if cfg is not None:
        fill, scope, sign = cfg.gap_fill, cfg.signal_scope, cfg.macd_sign
    return f"WITH {_fact(suffix, cfg)}, {FILLED[fill]}, {_lines(scope, sign)}, {FLAGS}"


TREND_COLUMNS = f"""SERVICE, {PARTS}, {_r("e12")} AS svc_day_usd_12ewm,
    {_r("e26")} AS svc_day_usd_26ewm, {_r("macd")} AS svc_day_usd_macd,
    {_r("e9")} AS svc_day_usd_9ewm, STARTDATE AS "date", crossFlag"""


def _low(cfg: JobConfig, keys: str) -> str:
    if cfg.suppress_on == "row":
        return f"SELECT {keys} FROM fact WHERE STARTDATE = {_day(cfg.as_of)} AND USD < {cfg.low_value_floor}"
    return f"""SELECT {keys} FROM fact WHERE STARTDATE = {_day(cfg.as_of)}
        GROUP BY {keys} HAVING sum(USD) < {cfg.low_value_floor}"""


def _hit(score: str, cfg: JobConfig) -> str:
    down = f" OR {score} <= {-cfg.z_in}" if cfg.two_sided else ""
    return f"({score} >= {cfg.z_in}{down})"


def _found(cfg: JobConfig) -> str:
    """The three alert sets, for a statement that has ``fact``, ``filled`` and ``flags``."""
    drop_empty = "AND TAG <> ''" if cfg.drop_empty_tag else ""
    day = _day(cfg.as_of)
    return f"""trend_alerts AS (SELECT * FROM flags f WHERE STARTDATE = {day} AND crossFlag <> 0
        AND NOT EXISTS (SELECT 1 FROM ({_low(cfg, "SERVICE")}) l WHERE l.SERVICE = f.SERVICE)),
    svc_scores AS (SELECT SERVICE, STARTDATE, {_z("SERVICE")} AS z FROM filled),
    svc_spikes AS (SELECT * FROM svc_scores s WHERE STARTDATE = {day} AND {_hit("z", cfg)}
        AND NOT EXISTS (SELECT 1 FROM ({_low(cfg, "SERVICE")}) l WHERE l.SERVICE = s.SERVICE)),
    tag_scores AS (SELECT SERVICE, TAG, STARTDATE, {_z("SERVICE, TAG")} AS z FROM
        (SELECT SERVICE, TAG, STARTDATE, sum(USD) AS USD FROM fact WHERE TAG IS NOT NULL GROUP BY ALL)),
    tag_spikes AS (SELECT * FROM tag_scores s WHERE STARTDATE = {day} AND {_hit("z", cfg)} {drop_empty}
        AND NOT EXISTS (SELECT 1 FROM ({_low(cfg, "SERVICE, TAG")}) l
            WHERE l.SERVICE = s.SERVICE AND l.TAG IS NOT DISTINCT FROM s.TAG))"""


def _alerts(suffix: str, cfg: JobConfig) -> str:
    return f"{_trend(suffix, cfg)}, {_found(cfg)}"


def _spikes_only(suffix: str, cfg: JobConfig) -> str:
    """As ``_alerts`` without the trend."""
    found = _found(cfg)
    return f"WITH {_fact(suffix, cfg)}, {FILLED[cfg.gap_fill]}, {found[found.index('svc_scores'):]}"


def _rank(label: str, order: str) -> str:
    return f"CAST(row_number() OVER (PARTITION BY {label} ORDER BY {order}) AS INTEGER)"


def _message_rows(suffix: str, cfg: JobConfig) -> str:
    stamp = f"{cfg.as_of:%Y%m%d}"
    order = "z DESC, text, link"
    tags = f"""
        UNION ALL SELECT 4, 'awsTagSpikes', CASE WHEN z >= {cfg.z_in} THEN 1 ELSE 2 END, text, link, z
        FROM (SELECT z, SERVICE || ' / ' || TAG AS text,
            'amz_tag_' || replace(SERVICE || ' / ' || TAG, ' ', '') || '_{stamp}' AS link
            FROM tag_spikes)""" if cfg.message_tag_spikes else ""
    return f"""{_alerts(suffix, cfg)},
    alert_lines AS (
        SELECT 2 AS section_no, 'awsTrends' AS section,
            CASE WHEN crossFlag >= 1 THEN 1 ELSE 2 END AS label_no, SERVICE AS text,
            'amz_' || replace(SERVICE, ' ', '') || '_{stamp}' AS link, CAST(crossFlag AS DOUBLE) AS z
        FROM trend_alerts
        UNION ALL
        SELECT 3, 'awsSvcSpikes', CASE WHEN z >= {cfg.z_in} THEN 1 ELSE 2 END, SERVICE,
            'amz_tot_' || replace(SERVICE, ' ', '') || '_{stamp}', z FROM svc_spikes{tags}),
    message AS (
        SELECT 1 AS section_no, 'awsSummary' AS section, 1 AS label_no,
            'AWS Services Summary' AS label, 1 AS "rank", 'Daily Spend x Service' AS text,
            'amz_dailySpendxService_{stamp}' AS link
        UNION ALL
        SELECT 1, 'awsSummary', 1, 'AWS Services Summary', 2, 'Month to Date Spend x Service',
            'amz_mtdSpendxService_{stamp}'
        UNION ALL
        SELECT section_no, section, label_no,
            CASE WHEN section_no = 2 AND label_no = 1 THEN 'Upward Trending AWS Services'
                WHEN section_no = 2 THEN 'Downward Trending AWS Services'
                WHEN section_no = 3 AND label_no = 1 THEN 'Spike up in AWS Services'
                WHEN section_no = 3 THEN 'Spike down in AWS Services'
                WHEN label_no = 1 THEN 'Spike up in AWS Service Tags' ELSE 'Spike down in AWS Service Tags' END,
            {_rank("section_no, label_no", order)}, text, link FROM alert_lines)"""


MESSAGE = """CAST(section_no AS INTEGER) AS section_no, section, CAST(label_no AS INTEGER) AS label_no,
    label, CAST("rank" AS INTEGER) AS "rank", text, link"""

BLOCKS = """blocks AS (
        SELECT DISTINCT section_no, label_no, 0 AS "rank",
            '{"type":"rich_text","elements":[{"type":"rich_text_section","elements":[{"type":"text","text":"'
            || label || ':","style":{"bold":true,"italic":true}}]}]}' AS block FROM message
        UNION ALL
        SELECT section_no, label_no, "rank",
            '{"type":"section","text":{"type":"mrkdwn","text":"' || text
            || '"},"accessory":{"type":"button","text":{"type":"plain_text","text":"Plot","emoji":true},'
            || '"value":"Plot","url":"https://charts.example/' || link
            || '.html","action_id":"button-action"}}' FROM message)"""


def _rolled(suffix: str, level: str, grain: str) -> tuple[str, str, str]:
    """(keys, period, SQL) of a rollup."""
    keys = "SERVICE" if level == "svc" else "SERVICE, TAG"
    period = "STARTDATE" if grain == "day" else f"{WEEK_KEY} AS yearWK"
    sql = f"""SELECT {keys}, {period}, sum(USD) AS USD FROM ({FACTS[suffix]})
        {"" if level == "svc" else "WHERE TAG IS NOT NULL"} GROUP BY ALL"""
    return keys, "STARTDATE" if grain == "day" else "yearWK", sql


def _daily(suffix: str, cfg: JobConfig | None = None) -> str:
    return f"""WITH {_fact(suffix, cfg)}, daily AS (SELECT SERVICE, STARTDATE,
        {_r2("sum(USD)")} AS TOTAL_SPEND, strftime(STARTDATE, '%Y%m%d') AS DATE_STR
        FROM fact GROUP BY SERVICE, STARTDATE)"""


def _month(suffix: str, cfg: JobConfig) -> str:
    first = cfg.summary_month.replace(day=1)
    return f"""{_daily(suffix, cfg)}, month AS (SELECT * FROM daily
        WHERE STARTDATE >= {_day(first)} AND STARTDATE < CAST({_day(first)} + INTERVAL 1 MONTH AS DATE))"""


def _moments(keys: str, prefix: str) -> str:
    return f"""min(USD) OVER (PARTITION BY {keys}) AS {prefix}_usd_min,
        max(USD) OVER (PARTITION BY {keys}) AS {prefix}_usd_max,
        avg(USD) OVER (PARTITION BY {keys}) AS {prefix}_usd_mean"""


def _enriched(suffix: str) -> str:
    sides = {
        ("svc", "day"): "SERVICE", ("svc", "wk"): "SERVICE",
        ("svc_tag", "day"): "SERVICE, TAG", ("svc_tag", "wk"): "SERVICE, TAG",
    }
    ctes, moment_columns = [], []
    for (level, grain), keys in sides.items():
        name = f"{level}_{grain}"
        period = "STARTDATE" if grain == "day" else f"{WEEK_KEY} AS yearWK"
        base = "filled" if name == "svc_day" else "fact"
        where = "WHERE TAG IS NOT NULL" if level == "svc_tag" else ""
        ctes.append(f"""s_{name} AS (SELECT {keys}, {period}, sum(USD) AS USD
            FROM {base} {where} GROUP BY ALL)""")
        ctes.append(f"z_{name} AS (SELECT *, {_z(keys)} AS z FROM s_{name})")
        ctes.append(f"""m_{name} AS (SELECT {keys}, min(USD) AS lo, max(USD) AS hi, avg(USD) AS mean
            FROM s_{name} GROUP BY {keys})""")
        moment_columns += [
            f"{_r(f'z_{name}.z', 6)} AS {name}_zscore",
            f"{_r(f'm_{name}.lo')} AS {name}_usd_min",
            f"{_r(f'm_{name}.hi')} AS {name}_usd_max",
            f"{_r(f'm_{name}.mean', 6)} AS {name}_usd_mean",
        ]
    weeks = f"{WEEK_KEY}".replace("STARTDATE", "f.STARTDATE")
    parts = PARTS.replace("STARTDATE", "f.STARTDATE")
    return f"""WITH {_fact(suffix)}, {FILLED["global"]}, {_lines()}, {", ".join(ctes)}
    SELECT f.SERVICE, f.TAG, f.STARTDATE, {parts}, CAST(week(f.STARTDATE) AS INTEGER) AS WEEK,
        {_r("f.USD")} AS USD, {weeks} AS yearWK, {", ".join(moment_columns)},
        {_r("lines.e12")} AS svc_day_usd_12ewm, {_r("lines.e26")} AS svc_day_usd_26ewm,
        {_r("lines.macd")} AS svc_day_usd_macd, {_r("lines.e9")} AS svc_day_usd_9ewm
    FROM fact f
    LEFT JOIN z_svc_wk ON z_svc_wk.SERVICE = f.SERVICE AND z_svc_wk.yearWK = {weeks}
    LEFT JOIN m_svc_wk ON m_svc_wk.SERVICE = f.SERVICE
    LEFT JOIN z_svc_tag_wk ON z_svc_tag_wk.SERVICE = f.SERVICE AND z_svc_tag_wk.TAG = f.TAG
        AND z_svc_tag_wk.yearWK = {weeks}
    LEFT JOIN m_svc_tag_wk ON m_svc_tag_wk.SERVICE = f.SERVICE AND m_svc_tag_wk.TAG = f.TAG
    LEFT JOIN z_svc_day ON z_svc_day.SERVICE = f.SERVICE AND z_svc_day.STARTDATE = f.STARTDATE
    LEFT JOIN m_svc_day ON m_svc_day.SERVICE = f.SERVICE
    LEFT JOIN lines ON lines.SERVICE = f.SERVICE AND lines.STARTDATE = f.STARTDATE
    LEFT JOIN z_svc_tag_day ON z_svc_tag_day.SERVICE = f.SERVICE AND z_svc_tag_day.TAG = f.TAG
        AND z_svc_tag_day.STARTDATE = f.STARTDATE
    LEFT JOIN m_svc_tag_day ON m_svc_tag_day.SERVICE = f.SERVICE AND m_svc_tag_day.TAG = f.TAG"""


def _series_spike(suffix: str, cfg: JobConfig) -> str:
    return f"""{_spikes_only(suffix, cfg)},
    bars AS (SELECT SERVICE, STARTDATE, {_r2("USD")} AS USD,
            greatest(0, count(*) OVER (PARTITION BY SERVICE) - {cfg.chart_rows or 10**9}) AS left_out
        FROM filled WHERE SERVICE IN (SELECT SERVICE FROM svc_spikes)
        QUALIFY row_number() OVER (PARTITION BY SERVICE ORDER BY STARTDATE DESC) <= {cfg.chart_rows or 10**9}),
    stats AS (SELECT SERVICE, avg(USD) AS mean, avg(USD) + {cfg.z_in} * stddev_samp(USD) AS cut
        FROM bars GROUP BY SERVICE)
    SELECT 'amz_tot_' || replace(SERVICE, ' ', '') || '_{cfg.as_of:%Y%m%d}' AS chart_id,
        SERVICE AS chart_title, strftime(STARTDATE, '%Y%m%d') AS "DATE", {_r("USD")} AS USD,
        {_r("mean")} AS mean_line, {_r("cut")} AS threshold_line,
        CASE WHEN USD > cut THEN 'red' ELSE 'blue' END AS colour,
        CAST(left_out AS INTEGER) AS left_out
    FROM bars JOIN stats USING (SERVICE)"""


COST_COLUMNS = f"""SERVICE, TAG, 'UnblendedCost' AS METRIC, 'DAILY' AS GRANULARITY, STARTDATE,
    CAST(STARTDATE + INTERVAL 1 DAY AS DATE) AS ENDDATE, USD, 'USD' AS UNIT,
    {PARTS}, CAST(week(STARTDATE) AS INTEGER) AS WEEK"""


def _tables() -> dict[str, str]:
    run = c.ORDERS_RUN
    split, back = _day(c.ORDERS_SPLIT), _day(c.ORDERS_SPLIT - timedelta(days=7))
    month = run.summary_month.replace(day=1)
    costs = f"SELECT {COST_COLUMNS} FROM ({FACTS['']})"
    events = f"SELECT {COST_COLUMNS} FROM ({FACTS['_events']})"
    merged_days = f"STARTDATE BETWEEN {_day(c.EVENTS_SPLIT)} AND {_day(c.EVENTS_RUN.as_of)}"
    events_low = f"""FROM ({FACTS['_events']}) WHERE STARTDATE = {_day(c.EVENTS_RUN.as_of)}"""
    net = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"
    return {
        "cost_fact": costs,
        "date_parts": f"""SELECT id, STARTDATE, {PARTS}, CAST(week(STARTDATE) AS INTEGER) AS WEEK,
            make_date(year(STARTDATE), month(STARTDATE), day(STARTDATE)) AS rebuilt
            FROM (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS STARTDATE FROM orders)""",
        "year_week": f"""SELECT id, {WEEK_KEY} AS yearWK,
            CAST(isoyear(STARTDATE) * 100 + week(STARTDATE) AS INTEGER) AS isoYearWK
            FROM (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS STARTDATE FROM orders)""",
        "date_key": """SELECT o_orderkey AS id, strftime(o_orderdate, '%Y%m%d') AS DATE_STR,
            CAST(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS parsed FROM orders""",
        "tag_clean": f"""SELECT o_orderkey AS id, o_orderpriority AS TAG,
            substr(o_orderpriority, 6) AS cut_tag,
            'amz_tot_' || replace(o_orderpriority, ' ', '') || '_{run.as_of:%Y%m%d}' AS link,
            o_orderpriority || ' (' || o_orderstatus || ')' AS title FROM orders""",
        "amount_round2": f"""SELECT l_orderkey, l_linenumber, {_r2(net)} AS net,
            TRY_CAST(l_returnflag AS DOUBLE) AS unreadable, CAST(l_linenumber AS DOUBLE) AS readable
            FROM lineitem""",
        "lookback_window": f"""SELECT * FROM ({FACTS['']}) WHERE STARTDATE BETWEEN
            CAST({_day(run.as_of)} - INTERVAL 1 YEAR AS DATE) AND {_day(run.as_of)}""",
        "month_to_date": f"""SELECT * FROM ({FACTS['']}) WHERE STARTDATE >= {_day(month)}
            AND STARTDATE < CAST({_day(month)} + INTERVAL 1 MONTH AS DATE)""",
        "low_value_keys": f"""SELECT DISTINCT SERVICE, TAG {events_low}
            AND USD < {c.EVENTS_RUN.low_value_floor}""",
        "low_value_totals": f"SELECT SERVICE, TAG {events_low} GROUP BY ALL HAVING sum(USD) < 5.0",
        "flatten_cost_pages": costs,
        "overlap_load": f"""{costs} WHERE STARTDATE BETWEEN
            {_day(run.as_of - timedelta(days=run.overlap_days))} AND {_day(run.as_of)}""",
        "pages_mixed_forms": costs,
        "rejected_pages": """SELECT CASE o_orderstatus WHEN 'P' THEN 'malformed page'
            ELSE 'no results in page' END AS reason, count(*) AS records
            FROM orders WHERE o_orderstatus IN ('P', 'F') GROUP BY 1""",
        "rejected_amounts": """SELECT CASE WHEN o_orderstatus = 'P' AND o_totalprice >= 1000
                THEN 'unreadable amount' ELSE 'loaded' END AS reason, count(*) AS records
            FROM orders GROUP BY 1""",
        "missing_days": f"""SELECT CAST(d AS DATE) AS STARTDATE FROM (SELECT unnest(generate_series(
                {_day(c.GAP_RUN.as_of - timedelta(days=30))}, {_day(c.GAP_RUN.as_of)}, INTERVAL 1 DAY)) AS d)
            WHERE CAST(d AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
        "export_headers": costs,
        "calendar_days": f"WITH {_fact('')}, {CALENDAR} SELECT STARTDATE FROM cal",
        "compact_distinct": f"""SELECT DISTINCT * FROM (
            SELECT * FROM ({costs}) WHERE STARTDATE <= {split}
            UNION ALL SELECT * FROM ({costs}) WHERE STARTDATE >= {back})""",
        "compact_latest": f"""SELECT DISTINCT * FROM (
            SELECT * FROM ({costs}) WHERE STARTDATE < {back}
            UNION ALL SELECT * REPLACE (USD + 1.0 AS USD) FROM ({costs}) WHERE STARTDATE >= {back})""",
        "stored_merge": f"SELECT DISTINCT {COST_COLUMNS} FROM ({FACTS['_events']})",
        "overwrite_existing": f"""SELECT * REPLACE (USD + 1.0 AS USD)
            FROM (SELECT {COST_COLUMNS} FROM ({FACTS['_events']}))""",
        "append_after_merge": f"""SELECT * FROM ({events}) WHERE NOT {merged_days}
            UNION ALL SELECT DISTINCT * FROM ({events}) WHERE {merged_days}
            UNION ALL SELECT * REPLACE (USD + 1.0 AS USD) FROM ({events})
                WHERE STARTDATE >= {_day(c.EVENTS_SPLIT)}""",
        "interleaved_writers": f"""SELECT * FROM ({events}) WHERE NOT {merged_days}
            UNION ALL SELECT DISTINCT * FROM (
                SELECT * FROM ({events}) WHERE {merged_days}
                UNION ALL SELECT * REPLACE (USD + 1.0 AS USD) FROM ({events}) WHERE {merged_days}
                UNION ALL SELECT * REPLACE (USD + 2.0 AS USD) FROM ({events}) WHERE {merged_days})""",
        "daily_cube": f"""SELECT SERVICE, TAG, STARTDATE, {_r("sum(USD)")} AS USD,
            {_r("min(USD)", 6)} AS USD_MIN FROM ({FACTS['_events']}) GROUP BY ALL""",
        "rollup_svc_week_iso": f"""SELECT SERVICE,
            CAST(isoyear(STARTDATE) * 100 + week(STARTDATE) AS INTEGER) AS yearWK,
            {_r("sum(USD)")} AS USD FROM ({FACTS['']}) GROUP BY 1, 2""",
        "total_by_service": f"""{_daily('_lineitem')}
            SELECT SERVICE, {_r("sum(TOTAL_SPEND)")} AS TOTAL_SPEND FROM daily GROUP BY ALL""",
        "daily_by_service_all": f"""{_daily('_lineitem')}
            SELECT DATE_STR, SERVICE, {_r("sum(TOTAL_SPEND)")} AS TOTAL_SPEND FROM daily GROUP BY ALL""",
        "top_alerts": f"""SELECT * FROM (SELECT SERVICE, TAG, STARTDATE,
                round({_z("SERVICE, TAG")}, 6) AS svc_tag_day_zscore
            FROM (SELECT SERVICE, TAG, STARTDATE, sum(USD) AS USD FROM ({FACTS['_events']}) GROUP BY ALL))
            ORDER BY svc_tag_day_zscore DESC NULLS LAST,
                SERVICE || '|' || TAG || '|' || CAST(STARTDATE AS VARCHAR) LIMIT 999""",
    }


def _series_and_trend() -> dict[str, str]:
    filled = f"WITH {_fact('')}, {FILLED['global']}"
    key = "SERVICE, STARTDATE"
    z_filled = f"round({_z('SERVICE')}, 6) + CAST(0 AS DOUBLE)"
    lines = f"{filled}, {_lines()}"
    by_service = f"{filled}, {_lines('service')}"
    return {
        "gap_fill_global": f"{filled} SELECT {key}, {_r('USD')} AS USD FROM filled",
        "gap_fill_per_service": f"""WITH {_fact('')}, {FILLED['per_service']}
            SELECT {key}, {_r("USD")} AS USD FROM filled""",
        "zscore_svc_day_filled": f"""{filled}
            SELECT {key}, {_r("USD")} AS USD, {z_filled} AS svc_day_zscore FROM filled""",
        "ewm12": f"{lines} SELECT {key}, {_r('e12')} AS svc_day_usd_12ewm FROM means",
        "ewm26": f"{lines} SELECT {key}, {_r('e26')} AS svc_day_usd_26ewm FROM means",
        "macd": f"{lines} SELECT {key}, {_r('macd')} AS svc_day_usd_macd FROM macds",
        "macd_standard": f"{lines} SELECT {key}, {_r('e12 - e26')} AS svc_day_usd_macd FROM means",
        "signal_global": f"{lines} SELECT {key}, {_r('e9')} AS svc_day_usd_9ewm FROM lines",
        "signal_service": f"{by_service} SELECT {key}, {_r('e9')} AS svc_day_usd_9ewm FROM lines",
        "cross_flag": f"{_trend('')} SELECT {key}, crossFlag FROM flags",
        "cross_flag_service": f"{by_service}, {FLAGS} SELECT {key}, crossFlag FROM flags",
        "cross_flag_lineitem": f"{_trend('_lineitem')} SELECT {key}, crossFlag FROM flags",
        "trend_testing": f"{_trend('')} SELECT STARTDATE, {TREND_COLUMNS} FROM flags",
        "enriched_fact": _enriched(""),
        "enriched_fact_events": _enriched("_events"),
        "spike_alerts_svc_gaps": _spike_rows("", c.GAP_RUN),
        "stored_charts": _series_spike("_lineitem", c.LINEITEM_RUN),
        "daily_run_events": f"""{_message_rows("_loaded_events", c.EVENTS_RUN)}
            SELECT {MESSAGE} FROM message""",
        "message_text": f"""{_message_rows("", c.ORDERS_RUN)}, {BLOCKS},
            numbered AS (SELECT block, row_number() OVER (ORDER BY section_no, label_no, "rank") - 1 AS n
                FROM blocks)
            SELECT CAST(n // 50 + 1 AS INTEGER) AS message_no,
                '[' || string_agg(block, ',' ORDER BY n) || ']' AS blocks FROM numbered GROUP BY 1""",
        "stored_messages": f"""{_message_rows("_loaded_events", c.EVENTS_RUN)}, {BLOCKS},
            numbered AS (SELECT block, row_number() OVER (ORDER BY section_no, label_no, "rank") - 1 AS n
                FROM blocks)
            SELECT CAST(n // 50 + 1 AS INTEGER) AS message_no,
                '[' || string_agg(block, ',' ORDER BY n) || ']' AS blocks, 'public' AS channel
            FROM numbered GROUP BY 1""",
        "stored_enriched": _enriched("_loaded_events"),
        "stored_enriched_order": f"""WITH {_fact("_loaded_events")},
            n AS (SELECT SERVICE, TAG, STARTDATE, count(*) AS n FROM fact GROUP BY ALL),
            s AS (SELECT *, sum(n) OVER (ORDER BY SERVICE, TAG NULLS FIRST, STARTDATE) AS behind FROM n)
            SELECT SERVICE, TAG, STARTDATE, CAST(behind - n AS BIGINT) AS first_place,
                CAST(behind - 1 AS BIGINT) AS last_place FROM s""",
        "stored_alert_order": _alert_order(),
        "two_runs_events": " UNION ALL ".join(_outputs(back) for back in (0, 1)),
        "message_pages": f"""{_message_rows("_strict", c.STRICT_RUN)}, {BLOCKS},
            numbered AS (SELECT block, row_number() OVER (ORDER BY section_no, label_no, "rank") - 1 AS n
                FROM blocks)
            SELECT CAST(n // 7 + 1 AS INTEGER) AS message_no,
                '[' || string_agg(block, ',' ORDER BY n) || ']' AS blocks FROM numbered GROUP BY 1""",
        "date_labels": f"""{_spikes_only("", c.ORDERS_RUN)}
            SELECT 3::INTEGER AS section_no, 'spikes' AS section, 1::INTEGER AS label_no, 'up' AS label,
                {_rank("1", "z DESC")} AS "rank", '{c.ORDERS_RUN.as_of:%Y-%m-%d}' AS text,
                'amz_tot_{c.ORDERS_RUN.as_of:%Y%m%d}' AS link FROM svc_spikes""",
        "series_spike_365": _series_spike("_lineitem", replace(c.LINEITEM_RUN, chart_rows=365)),
        "message_payload": f"""{_message_rows("_strict", c.STRICT_RUN)},
            parted AS (SELECT *, CAST((row_number() OVER (PARTITION BY section_no
                ORDER BY label_no, "rank") - 1) // 3 + 1 AS INTEGER) AS part_no FROM message)
            SELECT section, part_no, label, string_agg(text || '|' || link, ';' ORDER BY "rank") AS links
            FROM parted GROUP BY section, part_no, label""",
        "zscore_svc_day_exact": f"""WITH day AS (SELECT SERVICE, STARTDATE,
                CAST(sum(CAST(USD AS DECIMAL(28, 12))) AS DOUBLE) AS USD FROM ({FACTS['']}) GROUP BY ALL)
            SELECT SERVICE, STARTDATE, {_r(_r2("USD"))} AS USD, {_r(_z("SERVICE"), 6)} AS svc_day_zscore
            FROM day""",
    }


def _earlier(days: int) -> JobConfig:
    return replace(c.EVENTS_RUN, run_date=c.EVENTS_RUN.run_date - timedelta(days=days))


def _outputs(back: int) -> str:
    """Rows of every output table of the run ``back`` days before the last."""
    cfg = _earlier(back)
    events = "_loaded_events"
    alerts = f"{_alerts(events, cfg)} SELECT count(*) AS n FROM"
    charted = f"{_alerts(events, cfg)} SELECT count(*) AS n FROM filled WHERE SERVICE IN"
    month = _month(events, cfg)
    counts = {
        "total_by_service": f"{month} SELECT count(DISTINCT SERVICE) AS n FROM month",
        "daily_by_service": f"{month} SELECT count(*) AS n FROM month",
        "trend_alerts": f"{alerts} trend_alerts",
        "svc_spike_alerts": f"{alerts} svc_spikes",
        "tag_spike_alerts": f"{alerts} tag_spikes",
        "charts/trend": f"{charted} (SELECT SERVICE FROM trend_alerts)",
        "charts/spike": f"{charted} (SELECT SERVICE FROM svc_spikes)",
        "charts/summary": f"{month} SELECT count(*) + count(DISTINCT SERVICE) AS n FROM month",
        "message_rows": f"{_message_rows(events, cfg)} SELECT count(*) AS n FROM message",
        "links with a chart": f"{_message_rows(events, cfg)} SELECT count(*) AS n FROM message",
    }
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS name, {_day(cfg.as_of)} AS as_of, n AS records FROM ({sql}) WHERE n > 0"""
        for name, sql in counts.items()
    )


def _alert_order() -> str:
    events, cfg = "_loaded_events", c.EVENTS_RUN
    month = _month(events, cfg)
    tables = {
        "svc_spike_alerts": (_alerts(events, cfg), "svc_spikes", "SERVICE"),
        "tag_spike_alerts": (_alerts(events, cfg), "tag_spikes", "SERVICE, TAG"),
        "total_by_service": (month, "(SELECT DISTINCT SERVICE FROM month)", "SERVICE"),
        "daily_by_service": (month, "month", "DATE_STR, SERVICE"),
    }
    return " UNION ALL ".join(
        f"""SELECT * FROM ({sql} SELECT '{name}' AS name, concat_ws('|', {keys}) AS "key",
            row_number() OVER (ORDER BY {keys}) - 1 AS place FROM {table})"""
        for name, (sql, table, keys) in tables.items()
    )


def _spike_rows(suffix: str, cfg: JobConfig) -> str:
    return f"""{_spikes_only(suffix, cfg)} SELECT SERVICE, {PARTS}, {_r("z", 6)} AS svc_day_zscore,
        STARTDATE AS "date" FROM svc_spikes"""


def _runs() -> dict[str, str]:
    named = {}
    for suffix, (_, cfg) in c.RUNS.items():
        stamp = f"{cfg.as_of:%Y%m%d}"
        named[f"trend_alerts{suffix}"] = f"""{_alerts(suffix, cfg)}
            SELECT {TREND_COLUMNS} FROM trend_alerts"""
        named[f"spike_alerts_svc{suffix}"] = _spike_rows(suffix, cfg)
        named[f"spike_alerts_tag{suffix}"] = f"""{_spikes_only(suffix, cfg)}
            SELECT SERVICE, TAG, {PARTS}, {_r("z", 6)} AS svc_tag_day_zscore, STARTDATE AS "date"
            FROM tag_spikes"""
        named[f"series_macd{suffix}"] = f"""{_alerts(suffix, cfg)}
            SELECT 'amz_' || replace(SERVICE, ' ', '') || '_{stamp}' AS chart_id,
                SERVICE AS chart_title, strftime(STARTDATE, '%Y%m%d') AS "DATE",
                {_r(_r2("macd"))} AS "MACD", {_r(_r2("e9"))} AS "9EWM"
            FROM flags WHERE SERVICE IN (SELECT SERVICE FROM trend_alerts)"""
        named[f"series_spike{suffix}"] = _series_spike(suffix, cfg)
        named[f"message_rows{suffix}"] = f"{_message_rows(suffix, cfg)} SELECT {MESSAGE} FROM message"
        named[f"message_blocks{suffix}"] = f"""{_message_rows(suffix, cfg)}, {BLOCKS}
            SELECT CAST(section_no AS INTEGER) AS section_no, CAST(label_no AS INTEGER) AS label_no,
                CAST("rank" AS INTEGER) AS "rank", block FROM blocks"""
    for suffix, (_, cfg) in c.SUMMARY_RUNS.items():
        stamp = f"{cfg.as_of:%Y%m%d}"
        named[f"daily_spend{suffix}"] = f"""{_daily(suffix)}
            SELECT SERVICE, STARTDATE, {PARTS}, {_r("TOTAL_SPEND")} AS TOTAL_SPEND, DATE_STR FROM daily"""
        named[f"mtd_by_service{suffix}"] = f"""{_month(suffix, cfg)}
            SELECT SERVICE, {_r("sum(TOTAL_SPEND)")} AS TOTAL_SPEND FROM month GROUP BY ALL"""
        named[f"daily_by_service{suffix}"] = f"""{_month(suffix, cfg)}
            SELECT DATE_STR, SERVICE, {_r("sum(TOTAL_SPEND)")} AS TOTAL_SPEND FROM month GROUP BY ALL"""
        named[f"series_summary{suffix}"] = f"""{_month(suffix, cfg)}
            SELECT 'amz_mtdSpendxService_{stamp}' AS chart_id,
                'Month to Date Spend by Service' AS chart_title, CAST(NULL AS DATE) AS "DATE", SERVICE,
                {_r(_r2("sum(TOTAL_SPEND)"))} AS TOTAL_SPEND FROM month GROUP BY SERVICE
            UNION ALL
            SELECT 'amz_dailySpendxService_{stamp}', 'Daily Spend x Service', STARTDATE, SERVICE,
                {_r(_r2("TOTAL_SPEND"))} FROM month"""
    return named


def _kept() -> dict[str, str]:
    cfg = replace(c.EVENTS_RUN, message_tag_spikes=True)
    named = {
        "spike_alerts_tag_kept": f"""{_spikes_only("", c.ORDERS_RUN)}
            SELECT SERVICE, TAG, {PARTS}, {_r("z", 6)} AS svc_tag_day_zscore, STARTDATE AS "date"
            FROM tag_spikes""",
        "daily_runs_kept": f"{_message_rows('_loaded_events', cfg)} SELECT {MESSAGE} FROM message",
    }
    for level in ("svc", "svc_tag"):
        keys = "SERVICE" if level == "svc" else "SERVICE, TAG"
        where = "" if level == "svc" else "WHERE TAG IS NOT NULL"
        for suffix, (_, _, cfg) in c.KEPT.items():
            named[f"moments_kept_{level}{suffix}"] = f"""WITH {_fact(suffix, cfg)},
                rolled AS (SELECT {keys}, STARTDATE, sum(USD) AS USD FROM fact {where} GROUP BY ALL)
                SELECT {keys}, {_r("min(USD)")} AS {level}_day_usd_min,
                    {_r("max(USD)")} AS {level}_day_usd_max, {_r("avg(USD)", 6)} AS {level}_day_usd_mean
                FROM rolled GROUP BY {keys}"""
    return named


def oracle_sql() -> dict[str, str]:
    named = _tables() | _series_and_trend() | _runs() | _kept()
    for level, grain in c.LEVEL_GRAINS:
        for suffix in c.SOURCES:
            keys, period, rolled = _rolled(suffix, level, grain)
            name = f"{level}_{c.SHORT[grain]}"
            named[f"rollup_{level}_{grain}{suffix}"] = f"""WITH rolled AS ({rolled})
                SELECT {keys}, {period}, {_r("USD")} AS USD FROM rolled"""
            named[f"moments_{level}_{grain}{suffix}"] = f"""WITH rolled AS ({rolled})
                SELECT {keys}, {_r("min(USD)")} AS {name}_usd_min, {_r("max(USD)")} AS {name}_usd_max,
                    {_r("avg(USD)", 6)} AS {name}_usd_mean FROM rolled GROUP BY {keys}"""
            named[f"zscore_{level}_{grain}{suffix}"] = f"""WITH rolled AS ({rolled})
                SELECT {keys}, {period}, {_r(_z(keys), 6)} AS {name}_zscore FROM rolled"""
    return named
