"""DuckDB oracle SQL, one statement per registered query.

The statements are written independently of the Spark plans, in plain SQL
over the test tables (views ``lineitem``, ``orders``, ``customer``, ``nation``,
``part``, ``events``).  Densified tables are written the textbook way (keys
CROSS JOIN locations LEFT JOIN cells), which is fine for a single-node check.
"""

from __future__ import annotations

from vintagelake.plans import tpch_shapes as S
from vintagelake.sources.dims import SOURCE_NAMES

NATIONS = [f"NATION_{i}" for i in range(25)]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return ", ".join(_q(v) for v in values)


NULLED = (f"CASE WHEN n_name IN ({_in(S.NULL_LOCATIONS)}) OR l_quantity < {S.NULL_BELOW} "
          f"THEN NULL ELSE l_quantity END")
STAMP = (f"CASE WHEN o_orderpriority = {_q(S.FEED_PRIORITY)} THEN strftime(o_orderdate, '%Y-%m-%d') "
         f"ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END")
SHIP_MONTH = "CAST(date_trunc('month', l_shipdate) AS DATE)"
FEED = f"o_orderpriority = {_q(S.FEED_PRIORITY)} AND o_orderstatus = {_q(S.FEED_STATUS)}"

OL = """ol AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_quantity, l.l_shipdate, l.l_linestatus,
         o.o_orderdate, o.o_orderpriority, o.o_orderstatus, c.c_nationkey, c.c_mktsegment, n.n_name
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""
V = f"""v AS (SELECT CAST(o_orderdate AS DATE) AS report_date, {SHIP_MONTH} AS month,
  n_name AS location, l_quantity AS value FROM ol)"""
VN = f"""vn AS (SELECT CAST(o_orderdate AS DATE) AS report_date, {SHIP_MONTH} AS month,
  n_name AS location, {NULLED} AS value FROM ol)"""

# edition side
EDITION = f"""e AS (SELECT 'S' || CAST(c_nationkey AS VARCHAR) AS series_id, {SHIP_MONTH} AS Date,
  {NULLED} AS data, CAST(o_orderdate AS DATE) AS Edition,
  CASE WHEN l_linestatus = 'O' THEN 'Forecast' ELSE 'History' END AS is_forecast FROM ol),
sd AS (SELECT 'S' || CAST(n_nationkey AS VARCHAR) AS series_id, n_name AS location FROM nation),
ss AS (SELECT series_id, Date AS month, data AS value, Edition AS report_date FROM e
  WHERE is_forecast = 'Forecast' AND series_id IN (SELECT series_id FROM sd)),
sums AS (SELECT report_date, month, series_id, coalesce(sum(value * 1000.0), 0.0) AS value FROM ss
  WHERE report_date IS NOT NULL AND month IS NOT NULL AND series_id IS NOT NULL
  GROUP BY report_date, month, series_id)"""
EDITION_LONG = EDITION + """,
ec AS (SELECT s.report_date, s.month, s.value, d.location FROM sums s LEFT JOIN sd d USING (series_id)),
ek AS (SELECT DISTINCT report_date, month FROM sums),
ep AS (SELECT k.report_date, c.report_date AS issue_date, k.month, l.location, c.value
  FROM ek k CROSS JOIN sd l
  LEFT JOIN ec c ON c.report_date = k.report_date AND c.month = k.month AND c.location = l.location)"""

# release side
RELEASES = f"""ri AS (SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS dataset_id, {STAMP} AS release_raw,
  CAST(o_orderdate AS DATE) AS release_date
  FROM orders JOIN customer ON o_custkey = c_custkey),
ri1 AS (SELECT * FROM ri WHERE release_date >= DATE '{S.RELEASE_START}'),
lr AS (SELECT dataset_id, CAST(date_trunc('month', release_date) AS DATE) AS release_month,
  max(release_raw) AS release_raw, count(*) AS n_available FROM ri1 GROUP BY ALL),
lr2 AS (SELECT *, CAST(split_part(release_raw, 'T', 1) AS DATE) AS release_date FROM lr),
rs AS (SELECT CAST(c_nationkey AS VARCHAR) AS dataset_id, {STAMP} AS release_raw,
  strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS target_raw,
  sum(CASE WHEN l_quantity < {S.NULL_BELOW} THEN NULL ELSE l_quantity END) AS value
  FROM ol GROUP BY ALL),
pts AS (SELECT rs.dataset_id, rs.release_raw, lr2.release_date, lr2.release_month, rs.target_raw,
  CAST(rs.target_raw AS DATE) AS target_date, rs.value
  FROM rs JOIN lr2 USING (dataset_id, release_raw)
  WHERE CAST(rs.target_raw AS DATE) >= lr2.release_date)"""
RELEASE_LONG = RELEASES + """,
dd AS (SELECT CAST(n_nationkey AS VARCHAR) AS dataset_id, n_name AS location, n_nationkey AS ord FROM nation),
ac AS (SELECT p.release_month AS report_date, p.target_date AS month, d.location, p.value,
  p.release_date AS issue_date FROM pts p JOIN dd d USING (dataset_id)),
ao AS (SELECT DISTINCT location FROM ac),
ak AS (SELECT DISTINCT report_date, month FROM ac),
rp AS (SELECT k.report_date, c.issue_date, k.month, o.location, c.value
  FROM ak k CROSS JOIN ao o
  LEFT JOIN ac c ON c.report_date = k.report_date AND c.month = k.month AND c.location = o.location)"""


def _calendar(start: str, as_of: str, name: str = "cal") -> str:
    return f"""{name}_b AS (SELECT {start} AS s, {as_of} AS a),
{name}_m AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', s) AS TIMESTAMP),
  CAST(date_trunc('month', a) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS m, a FROM {name}_b),
{name} AS (SELECT DISTINCT CASE WHEN m < CAST(date_trunc('month', a) AS DATE)
  THEN CAST(last_day(m) - CAST(isodow(last_day(m)) - 1 AS INTEGER) AS DATE)
  ELSE CAST(date_trunc('week', a) AS DATE) END AS report_date FROM {name}_m)"""


AVAILABLE = f"av AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE {FEED})"


def _snap(cal: str = "cal", name: str = "snap") -> str:
    return f"""{name} AS (SELECT c.report_date AS candidate,
  CASE WHEN a0.d IS NOT NULL THEN a0.d ELSE a1.d END AS report_date
  FROM {cal} c LEFT JOIN av a0 ON a0.d = c.report_date
  LEFT JOIN av a1 ON a1.d = CAST(c.report_date - 7 AS DATE)
  WHERE a0.d IS NOT NULL OR a1.d IS NOT NULL)"""


def _hierarchy(rollups, name: str = "h") -> str:
    rows = ", ".join(f"({_q(t)}, {_q(c)}, {_q(p)}, {i})"
                     for i, (t, p, comps) in enumerate(rollups) for c in comps)
    return f"{name}(target, component, null_policy, rule) AS (VALUES {rows})"


def _rollup(dense: str, observed: str, keys: list[str], rollups, prefix: str = "r") -> str:
    """CTEs {prefix}_ch (chosen rules) and {prefix}_v (rollup rows)."""
    k = ", ".join(f"d.{c}" for c in keys)
    return f"""{_hierarchy(rollups, prefix + '_h')},
{prefix}_cov AS (SELECT h.target, h.rule, h.null_policy, count(*) AS n_components, count(o.location) AS n_seen
  FROM {prefix}_h h LEFT JOIN {observed} o ON o.location = h.component GROUP BY ALL),
{prefix}_pass AS (SELECT * FROM {prefix}_cov WHERE n_components = n_seen),
{prefix}_ch AS (SELECT p.* FROM {prefix}_pass p
  WHERE p.rule = (SELECT max(q.rule) FROM {prefix}_pass q WHERE q.target = p.target)),
{prefix}_v AS (SELECT {k}, ch.target AS location,
  CASE WHEN ch.null_policy = 'propagate'
       THEN CASE WHEN count(d.value) = ch.n_components THEN sum(d.value) END
       ELSE coalesce(sum(d.value), 0.0) END AS value
  FROM {dense} d JOIN {prefix}_h h ON d.location = h.component
  JOIN {prefix}_ch ch ON ch.target = h.target AND ch.rule = h.rule
  GROUP BY {k}, ch.target, ch.null_policy, ch.n_components)"""


MONTHLY_DENSE = """mn AS (SELECT CAST(date_trunc('month', report_date) AS DATE) AS report_month, month, location, value
  FROM vn WHERE month >= report_date),
mc AS (SELECT report_month, month, location, avg(value) AS value FROM mn
  WHERE value IS NOT NULL GROUP BY ALL),
mo AS (SELECT DISTINCT location FROM mc),
mk AS (SELECT DISTINCT report_month, month FROM mc),
md AS (SELECT k.report_month, k.month, o.location, c.value FROM mk k CROSS JOIN mo o
  LEFT JOIN mc c ON c.report_month = k.report_month AND c.month = k.month AND c.location = o.location)"""

MONTHLY_SUMS = """ms AS (SELECT CAST(date_trunc('month', report_date) AS DATE) AS report_month, month, location,
  coalesce(sum(value), 0.0) AS value FROM v WHERE month >= report_date GROUP BY ALL)"""


def _report_long(available: str = AVAILABLE, rows: str = "") -> str:
    """``rows``: a condition on the lines that become records."""
    return f"""{_calendar(f"DATE '{S.CALENDAR_START}'", f"DATE '{S.CALENDAR_AS_OF}'", 'pcal')},
{available},
{_snap('pcal', 'psnap')},
pdates AS (SELECT DISTINCT report_date FROM psnap),
rr AS (SELECT CAST(o_orderdate AS DATE) AS report_date, CAST(o_orderdate AS DATE) AS reportDate,
  {SHIP_MONTH} AS month, n_name AS subRegion, {NULLED} AS value FROM ol {rows}),
rr2 AS (SELECT rr.* FROM rr JOIN pdates p ON rr.report_date = p.report_date
  WHERE rr.month >= rr.report_date AND rr.month <= CAST(rr.report_date + INTERVAL 1 YEAR AS DATE)
    AND rr.month >= rr.reportDate),
rc AS (SELECT reportDate AS report_date, month, subRegion AS location, avg(value) AS value FROM rr2
  WHERE value IS NOT NULL AND reportDate IS NOT NULL AND month IS NOT NULL AND subRegion IS NOT NULL
  GROUP BY ALL),
ro AS (SELECT DISTINCT location FROM rc),
rk AS (SELECT DISTINCT report_date, month FROM rc),
rd AS (SELECT k.report_date, k.month, o.location, c.value, c.report_date AS issue_date
  FROM rk k CROSS JOIN ro o
  LEFT JOIN rc c ON c.report_date = k.report_date AND c.month = k.month AND c.location = o.location),
{_rollup('rd', 'ro', ['report_date', 'month'], S.TEST_ROLLUPS, 'pr')},
pall AS (SELECT report_date, issue_date, month, location, value FROM rd
    WHERE location NOT IN (SELECT target FROM pr_ch)
  UNION ALL SELECT report_date, report_date AS issue_date, month, location, value FROM pr_v),
gp AS (SELECT report_date, issue_date, month,
  CASE {' '.join(f"WHEN location = {_q(a)} THEN {_q(b)}" for a, b in S.TEST_RENAMES)} ELSE location END
  AS location, round(value, 6) AS value FROM pall)"""


def _wide(src: str, keys: list[str], names: list[str], agg: str = "max", rnd: bool = False,
          where: str = "") -> str:
    cols = []
    for n in names:
        e = f"{agg}(value) FILTER (WHERE location = {_q(n)})"
        cols.append(f"{'round(' + e + ', 6)' if rnd else e} AS \"{n}\"")
    k = ", ".join(keys)
    return f"SELECT {k}, {', '.join(cols)} FROM {src} {where} GROUP BY {k}"


def _three_sources() -> str:
    keys = f"CAST(o_orderdate AS DATE) AS report_date, {SHIP_MONTH} AS month"
    return f"""cs AS (
  SELECT 'by_segment' AS source, {keys}, c_mktsegment AS location, sum(l_quantity) AS value FROM ol GROUP BY ALL
  UNION ALL
  SELECT 'by_type' AS source, {keys}, p_type AS location, sum(l_quantity) AS value
    FROM ol JOIN part ON l_partkey = p_partkey GROUP BY ALL
  UNION ALL
  SELECT 'by_nation' AS source, {keys}, n_name AS location, sum(l_quantity) AS value FROM ol GROUP BY ALL)"""


def _combined() -> str:
    return f"""WITH {OL}, {EDITION_LONG}, {RELEASE_LONG}, {_report_long()},
cv AS (
  SELECT {_q(SOURCE_NAMES['release'])} AS source, report_date, issue_date, month, location, value FROM rp
  UNION ALL SELECT {_q(SOURCE_NAMES['report'])}, report_date, issue_date, month, location, value FROM gp
  UNION ALL SELECT {_q(SOURCE_NAMES['edition'])}, report_date, issue_date, month, location, value FROM ep)"""


def oracle_sql() -> dict[str, str]:
    observed = [n for n in NATIONS if n not in S.NULL_LOCATIONS]
    sql: dict[str, str] = {}
    w = f"WITH {OL}, {EDITION}"
    sql["series_scan"] = f"{w} SELECT * FROM ss"
    sql["scale_units"] = (f"{w} SELECT series_id, month, report_date, value * 1000.0 AS value, "
                          f"'KBD' AS units FROM ss")
    sql["series_sum"] = f"{w} SELECT * FROM sums"
    sql["location_lookup"] = (f"{w} SELECT s.series_id, s.report_date, s.month, s.value, d.location "
                              f"FROM sums s LEFT JOIN (SELECT 'S' || CAST(n_nationkey AS VARCHAR) AS series_id, "
                              f"n_name AS location FROM nation WHERE n_regionkey <> 4) d USING (series_id)")
    renames = " ".join(f"WHEN location = {_q(a)} THEN {_q(b)}" for a, b in S.TEST_RENAMES)
    sql["location_rename"] = (f"WITH {OL}, {V} SELECT report_date, month, "
                              f"CASE {renames} ELSE location END AS location, value FROM v")
    sql["edition_provider"] = f"WITH {OL}, {EDITION_LONG} SELECT * FROM ep"
    wide = _wide("ep", ["report_date", "month"], NATIONS)
    sql["csv_snapshot"] = (f"WITH {OL}, {EDITION_LONG}, ew AS ({wide}) "
                           f"SELECT strftime(report_date, '%b-%y') AS reportDate, "
                           f"strftime(month, '%b-%y') AS month, "
                           + ", ".join(f'"{n}"' for n in NATIONS) + " FROM ew")

    r = f"WITH {OL}, {RELEASES}"
    sql["release_index"] = f"{r} SELECT dataset_id, release_raw, release_date FROM ri1"
    sql["release_index_status"] = f"{r} SELECT dataset_id AS payload_id, 'ok' AS outcome, count(*) AS n_rows FROM ri GROUP BY ALL"
    sql["latest_release_per_month"] = (f"{r} SELECT dataset_id, release_month, release_raw, n_available, "
                                       f"release_date FROM lr2")
    sql["horizon_from_release"] = f"{r} SELECT * FROM pts"
    sql["map_explode"] = f"{r} SELECT dataset_id, release_raw, target_raw, value FROM rs"
    sql["payload_quality"] = f"""WITH {OL},
pq AS (SELECT l_orderkey, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS day,
  count(DISTINCT date_trunc('month', l_shipdate)) AS n FROM ol GROUP BY ALL)
SELECT CAST(l_orderkey AS VARCHAR) || '|' || day AS payload_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'empty' WHEN '2-HIGH' THEN 'no_data'
    WHEN '3-MEDIUM' THEN 'unparseable' WHEN '4-NOT SPECIFIED' THEN 'bad_date' ELSE 'ok' END AS outcome,
  CAST(CASE WHEN o_orderpriority <> '5-LOW' THEN 0 WHEN l_orderkey % 4 >= 2 THEN n + 1 ELSE n END AS BIGINT) AS n_rows,
  CAST(o_orderpriority = '5-LOW' AND l_orderkey % 4 = 2 AS BIGINT) AS n_bad_values,
  CAST(o_orderpriority = '5-LOW' AND l_orderkey % 4 = 3 AS BIGINT) AS n_merged FROM pq"""
    sql["dimension_limit"] = (f"WITH {OL}, {V} SELECT report_date, month, location, value FROM v "
                              f"WHERE location IN (SELECT n_name FROM nation ORDER BY n_nationkey "
                              f"LIMIT {S.DEBUG_DATASETS})")
    sql["release_provider"] = f"WITH {OL}, {RELEASE_LONG} SELECT * FROM rp"
    sql["release_from_payloads"] = sql["release_provider"]
    sql["vintage_wide"] = f"WITH {OL}, {RELEASE_LONG} " + _wide("rp", ["report_date", "month"], NATIONS)

    sql["report_payload"] = (f"WITH {OL} SELECT CAST(o_orderdate AS DATE) AS report_date, "
                             f"CAST(o_orderdate AS DATE) AS reportDate, {SHIP_MONTH} AS month, "
                             f"n_name AS subRegion, {NULLED} AS value FROM ol")
    sql["report_payload_status"] = f"""WITH {OL},
rp AS (SELECT l_orderkey, {SHIP_MONTH} AS month, CAST(o_orderdate AS DATE) AS rd FROM ol)
SELECT CAST(l_orderkey AS VARCHAR) AS payload_id, 'ok' AS outcome, count(*) AS n_records,
  count(*) FILTER (WHERE month >= rd) AS n_rows, count(*) FILTER (WHERE NOT (month >= rd)) AS n_removed,
  CAST(0 AS BIGINT) AS n_bad_values, min(rd) AS min_report_date, max(rd) AS max_report_date,
  min(month) AS min_month, max(month) AS max_month
FROM rp GROUP BY l_orderkey"""
    cal = _calendar("(SELECT CAST(min(o_orderdate) AS DATE) FROM orders)",
                    "(SELECT CAST(max(o_orderdate) AS DATE) FROM orders)")
    sql["report_calendar"] = f"WITH {cal} SELECT report_date FROM cal"
    sql["report_date_snap"] = f"WITH {cal}, {AVAILABLE}, {_snap()} SELECT candidate, report_date FROM snap"
    sql["horizon_one_year"] = (f"WITH {OL}, {V} SELECT * FROM v WHERE month >= report_date "
                               f"AND month <= CAST(report_date + INTERVAL 1 YEAR AS DATE)")
    sql["rows_per_report_cap"] = (f"WITH {OL}, {V} SELECT report_date, month, location, value FROM v "
                                  f"QUALIFY row_number() OVER (PARTITION BY report_date "
                                  f"ORDER BY month, location, value) <= {S.ROWS_PER_REPORT}")
    sql["cell_mean"] = (f"WITH {OL}, {VN} SELECT report_date, month, location, round(avg(value), 6) AS value "
                        f"FROM vn WHERE value IS NOT NULL GROUP BY ALL")
    sql["pivot_mean"] = f"WITH {OL}, {VN} " + _wide("vn", ["report_date", "month"], observed, "avg", True,
                                                     "WHERE value IS NOT NULL")
    sql["pivot_strict"] = f"WITH {OL}, {V}, {MONTHLY_SUMS} " + _wide("ms", ["report_month", "month"], NATIONS)
    sql["melt_keep_nulls"] = f"""WITH {OL}, {V}, {MONTHLY_SUMS},
mk AS (SELECT DISTINCT report_month, month FROM ms)
SELECT k.report_month, k.month, n.n_name AS location, m.value FROM mk k CROSS JOIN nation n
LEFT JOIN ms m ON m.report_month = k.report_month AND m.month = k.month AND m.location = n.n_name"""
    md = f"WITH {OL}, {VN}, {MONTHLY_DENSE}"
    sql["densify"] = f"{md} SELECT report_month, month, location, round(value, 6) AS value FROM md"
    keys = ["report_month", "month"]
    sql["rollup_skipna"] = (f"{md}, {_rollup('md', 'mo', keys, S.SKIP_ROLLUPS)} "
                            f"SELECT report_month, month, location, round(value, 6) AS value FROM r_v")
    sql["rollup_strict"] = (f"{md}, {_rollup('md', 'mo', keys, S.PROPAGATE_ROLLUPS)} "
                            f"SELECT report_month, month, location, round(value, 6) AS value FROM r_v")
    sql["rollup_guard"] = (f"{md}, {_rollup('md', 'mo', keys, S.TEST_ROLLUPS)} "
                           f"SELECT report_month, month, location, round(value, 6) AS value FROM md "
                           f"WHERE location NOT IN (SELECT target FROM r_ch) "
                           f"UNION ALL SELECT report_month, month, location, round(value, 6) FROM r_v")
    sql["report_provider"] = f"WITH {OL}, {_report_long()} SELECT * FROM gp"
    any_item = "av AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM ol)"
    main = f"WHERE NOT (day(o_orderdate) % 3 = 0 OR l_quantity < {S.OTHER_BELOW})"
    sql["report_from_payloads"] = f"WITH {OL}, {_report_long(any_item, main)} SELECT * FROM gp"

    sql["iso_date_part"] = ("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts_text, "
                            "strftime(ts, '%Y-%m-%d') AS day_text, CAST(ts AS DATE) AS day FROM events")
    sql["month_labels"] = ("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS report_date, "
                           "strftime(o_orderdate, '%Y-%m') AS label_ym, "
                           "strftime(o_orderdate, '%b-%y') AS label_mon FROM orders")

    sql["combine_sources"] = (f"WITH {OL}, {_three_sources()} SELECT *, row_number() OVER (ORDER BY source NULLS LAST, "
                              f"report_date NULLS LAST, month NULLS LAST, location NULLS LAST) AS place FROM cs")
    sql["rows_per_source"] = (f"WITH {OL}, {_three_sources()} SELECT source, count(*) AS n_rows FROM cs "
                              f"GROUP BY ROLLUP (source)")
    sql["combined_vintage"] = f"{_combined()} SELECT * FROM cv"
    sql["run_summary"] = f"{_combined()} SELECT source, count(*) AS n_rows FROM cv GROUP BY ROLLUP (source)"
    sql["full_refresh_sink"] = (f"{_combined()} SELECT strftime(report_date, '%Y-%m') AS reportDate, "
                                f"strftime(month, '%Y-%m') AS month, location, value, source FROM cv")
    # landed by the stream, the last payload of each key holds: the same rows as from the payloads
    sql["report_from_landed"] = sql["report_from_payloads"]
    sql["release_from_landed"] = sql["release_from_payloads"]
    return sql
