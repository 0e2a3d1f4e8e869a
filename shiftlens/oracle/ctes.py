"""Reusable SQL steps for the DuckDB checks.

Written as plain relational SQL (whole-line windows, range joins, recursive steps): deliberately the
direct reading of each rule, not the chunked plan the Spark operators use.
"""

from __future__ import annotations

import re

from shiftlens.oracle import rules

DAY, HOUR, MINUTE, SECOND = 86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000


# -- expression helpers ------------------------------------------------------


def ordinal(us: str) -> str:
    x = f"(({us}) - {7 * HOUR})"
    return f"(2 * ({x} // {DAY}) + CASE WHEN {x} % {DAY} >= {12 * HOUR} THEN 1 ELSE 0 END)"


def starts(o: str) -> str:
    return f"((({o}) // 2) * {DAY} + CASE WHEN ({o}) % 2 = 1 THEN {19 * HOUR} ELSE {7 * HOUR} END)"


def ends(o: str) -> str:
    return starts(f"({o}) + 1")


def date_of(us: str) -> str:
    return f"CAST(make_timestamp(CAST({us} AS BIGINT)) AS DATE)"


def odate(o: str) -> str:
    return f"CAST(make_timestamp(CAST((({o}) // 2) * {DAY} AS BIGINT)) AS DATE)"


def otext(o: str) -> str:
    return f"strftime({odate(o)}, '%Y-%m-%d')"


def otype(o: str) -> str:
    return f"CASE WHEN ({o}) % 2 = 1 THEN 'night' ELSE 'day' END"


def olabel(o: str) -> str:
    return f"(CASE WHEN ({o}) % 2 = 1 THEN 'Night ' ELSE 'Day ' END || strftime({odate(o)}, '%m-%d'))"


def okey(o: str, line: str = "line_id") -> str:
    return f"({line} || '|' || {otext(o)} || '|' || {otype(o)})"


def ts(us: str) -> str:
    return f"make_timestamp(CAST({us} AS BIGINT))"


def tstext(us: str) -> str:
    return f"strftime({ts(us)}, '%Y-%m-%d %H:%M:%S')"


def rnd(x: str, n: int) -> str:
    """Decimal rounding of the exact binary value (printf), without a negative zero."""
    return f"(CAST(printf('%.{n}f', CAST({x} AS DOUBLE)) AS DOUBLE) + 0.0)"


def r6(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 6)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def isoweek(d: str) -> str:
    return f"strftime({d}, '%G-W%V')"


def weeklabel(d: str) -> str:
    return f"strftime(date_trunc('week', {d}), 'Week of %b %d')"


def t1(x: str) -> str:
    return f"printf('%.1f', {x})"


def _pick(values, index: str) -> str:
    return "CASE " + " ".join(f"WHEN {index} = {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


_PHRASES = (
    "Gripper no part", "Catheter rejected at funnel", "Hot printer foil fault",
    "Frame b waiting downstream", "Web torn at splice", "Air valve on web", "Unknown condition",
)
_ALARMS = (
    "", "No Alarm Text", "2150 Pouch misfeed", "4 Closing area open", "Temperature too high",
    "150 Limit switch", "Fork blocked", "Dosing nozzle",
)
_FC = r"FC=@?((?:Fault|Alarm|Warning)_(?:PLC1_)?\d+)@?\s*(?:\(([^)]*)\))?"


def describe(rc: str) -> str:
    """Description of a code among ids/texts of the current row."""
    spelled = []
    for p in ("Fault", "Alarm", "Warning"):
        spelled += [f"printf('{p}_%04d', {rc})", f"'{p}_' || {rc}", f"'{p}_PLC1_' || {rc}"]
    return (
        f"list_filter(flatten(list_transform([{', '.join(spelled)}], lambda v: "
        "list_transform(list_filter(range(1, len(ids) + 1), lambda i: ids[i] = v AND texts[i] <> ''), "
        "lambda j: texts[j]))), lambda q: true)[1]"
    )


def segment(label: str) -> str:
    """Segment of a label, by line: codes first, then words."""
    lines = []
    for line, _ in rules.LINES:
        number = f"TRY_CAST(regexp_extract({label}, '^(\\d+)', 1) AS BIGINT)"
        number = f"(CASE WHEN {number} < 10 THEN {number} * 1000 ELSE {number} END)"
        arms = [f"WHEN {label} IS NULL OR {label} IN ('', 'Unattributed') THEN 'unattributed'"]
        own = [s for s in rules.SEGMENTS if s[0] == line]
        arms += [f"WHEN {number} >= {low} AND {number} < {high} THEN '{key}'" for _, key, _, _, low, high, _ in own if high]
        arms += [f"WHEN regexp_matches({label}, '(?i){text}') THEN '{key}'" for _, key, _, _, _, _, text in own if text]
        lines.append(f"WHEN line_id = '{line}' THEN CASE {' '.join(arms)} ELSE 'unattributed' END")
    return f"CASE {' '.join(lines)} END"


def cluster(label: str, seg: str) -> str:
    lines = []
    for line, _ in rules.LINES:
        arms = [
            f"WHEN {seg} IN ('manual', 'unattributed', 'running') THEN NULL",
            f"WHEN {label} IN ('', 'Unattributed') THEN 'Other'",
        ]
        arms += [f"WHEN {seg} = '{key}' AND regexp_matches({label}, '(?i){pattern}') THEN '{name}'" for of, key, name, pattern in rules.CLUSTERS if of == line]
        lines.append(f"WHEN line_id = '{line}' THEN CASE {' '.join(arms)} ELSE 'Other' END")
    return f"CASE {' '.join(lines)} END"


def _values(rows) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).upper()
        return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"

    return "(VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows) + ")"


_LANES = " UNION ALL ".join(
    f"SELECT {row} AS row, '{prefix}{i}' AS name, {i} AS i, {kind} AS kind"
    for prefix, n, kind, base in (
        ("Stn080_Foam dosing_1_12_", 10, 0, 0), ("Stn012_Camera align cap rear_1_7_", 10, 1, 10),
        ("Stn031_Camera align cap front_1_9_", 10, 2, 20),
    )
    for i, row in ((i, base + i - 1) for i in range(1, n + 1))
)
_LANES_F = " UNION ALL ".join(
    f"SELECT {i - 1} AS row, 'Foil St_041 Vision system printing_{i}' AS name, {i} AS i, 3 AS kind" for i in range(1, 6)
)


def _digit(d: str) -> str:
    return "CASE " + " ".join(f"WHEN {d} = {j} THEN r{j}" for j in range(5)) + " END"


_COUNT = f"""CASE WHEN kind = 0 THEN {_digit('i % 5')}
 WHEN kind = 1 THEN CASE WHEN k = 50 AND i = 3 THEN NULL ELSE {_digit('(i + 1) % 5')} END
 WHEN kind = 2 THEN CASE WHEN i % 2 = 0 THEN {_digit('(i + 2) % 5')} ELSE 0 END
 ELSE CASE WHEN k = 50 AND i = 3 THEN NULL ELSE {_digit('i % 5')} + {_digit('(i + 3) % 5')} END END"""

# -- common table expressions ------------------------------------------------

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


def _ranked(rows) -> list[tuple]:
    """Rows with their position among those of the same line (and segment) after the first column(s)."""
    return [(r[0], sum(x[0] == r[0] for x in rows[:i]), *r[1:]) for i, r in enumerate(rows)]


cte("c_lines", f"SELECT * FROM {_values(rules.LINES)} t(line_id, line)")
cte("c_excl", f"SELECT line_id, CAST(d AS DATE) AS day FROM {_values(rules.EXCLUDED_DAYS)} t(line_id, d)")
cte("c_segments", f"SELECT * FROM {_values([r[:5] for r in _ranked(rules.SEGMENTS)])} t(line_id, seg_order, segment, segment_label, segment_color)")
cte("c_clusters", "SELECT * FROM " + _values(
    [(line, seg, sum(x[:2] == (line, seg) for x in rules.CLUSTERS[:i]), name) for i, (line, seg, name, _) in enumerate(rules.CLUSTERS)]
) + " t(line_id, segment, cluster_order, cluster)")
cte("c_categories", f"SELECT * FROM {_values([(i, *c) for i, c in enumerate(rules.CATEGORIES)])} t(cat_order, category, category_label, category_color)")
cte("c_panels", f"SELECT * FROM {_values([r[:-1] for r in _ranked(rules.PANELS)])}" + """ t(line_id, panel_order, panel, panel_short, counter_table, n_lanes, divisor,
 min_resets, min_subgroups, lane_mode, representative, dual, active_only)""")

cte("c_ev", """SELECT CASE WHEN user_id % 2 = 0 THEN 'line_a' ELSE 'line_b' END AS line_id, event_id, ts,
 epoch_us(ts) AS us, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
cte("c_sb", f"""SELECT line_id, ts AS start_ts, lead(ts) OVER (PARTITION BY line_id ORDER BY ts, event_id) AS end_ts,
 event_type NOT IN ('error', 'signup') AS running,
 CASE WHEN k % 4 = 0 THEN 'x' WHEN k % 4 = 1 THEN 'RC=' || (k + 1)
  WHEN k % 8 = 6 THEN 'RC=' || k || ' RC=' || (k + 1) || ' FC=@Alarm_PLC1_' || (k + 1) || '@(' || phrase || ')'
  WHEN k % 4 = 2 THEN 'FC=@Fault_' || lpad(CAST(k AS VARCHAR), 4, '0') || '@(' || phrase || ') RC=' || k
  WHEN k % 16 = 7 THEN 'FC=@Warning_' || k || '@'
  ELSE 'FC=@Alarm_PLC1_' || k || '@(' || phrase || ')' END AS faults,
 CASE WHEN event_type = 'signup' THEN 'Manual' ELSE 'Auto' END AS stop_type, event_id AS start_id
 FROM (SELECT *, {_pick(_PHRASES, 'k % 7')} AS phrase FROM c_ev)""")
cte("c_fof", f"""SELECT line_id, event_id AS ndx, {_pick(_ALARMS, 'k % 8')} AS alarm_text, ts AS t_stamp
 FROM c_ev WHERE event_type IN ('error', 'signup') AND event_id % 2 = 0""")
cte("c_ppm", "SELECT line_id, ts + INTERVAL 37 SECOND AS t_stamp, us + 37000000 AS us, value AS output_ppm FROM c_ev")
cte("c_buy", f"SELECT *, us // {8 * HOUR} AS epoch FROM c_ev WHERE event_type = 'purchase'")
_RUN = "OVER (PARTITION BY line_id, epoch ORDER BY us, event_id ROWS UNBOUNDED PRECEDING)"
cte("c_os", f"""SELECT line_id, event_id AS row_id, ts AS t_stamp, us, total AS counter_total,
 CASE WHEN k = 99 THEN total + 5 WHEN k = 77 THEN NULL ELSE total - bad END AS counter_good
 FROM (SELECT *, CAST(sum(parts) {_RUN} AS BIGINT) AS total,
  CAST(sum(CASE WHEN k < 10 THEN parts ELSE 0 END) {_RUN} AS BIGINT) AS bad
  FROM (SELECT *, CAST(floor(value) AS BIGINT) * 25 AS parts FROM c_buy))""")
cte("c_ms", """SELECT line_id, CASE WHEN event_type = 'error' AND k < 50 THEN us + 5000000 ELSE us END AS us,
 CASE WHEN event_type = 'error' AND k < 50 THEN 'Halted' ELSE 'Execute' END AS state_text FROM c_ev""")
cte("c_run5", f"""SELECT line_id, us, k, row_number() OVER (PARTITION BY line_id ORDER BY us, event_id) AS block_id,
 {', '.join(f"CAST(sum(CASE WHEN k % 5 = {d} THEN 1 ELSE 0 END) {_RUN} AS BIGINT) AS r{d}" for d in range(5))} FROM c_buy""")
cte("c_hc", f"SELECT line_id, block_id * 100 + row AS row_id, block_id, us, name, {_COUNT} AS cnt FROM c_run5, ({_LANES}) l")
cte("c_fc", f"SELECT line_id, block_id * 100 + row AS row_id, block_id, us, name, {_COUNT} AS cnt FROM c_run5, ({_LANES_F}) l")
cte("c_ov", """SELECT line_id, CASE WHEN k >= 90 THEN ts + INTERVAL 36500 DAY ELSE ts END AS start_ts
 FROM c_ev WHERE event_type = 'signup'""")

cte("c_bl", "SELECT *, epoch_us(start_ts) AS s_us, epoch_us(end_ts) AS e_us FROM c_sb WHERE end_ts IS NOT NULL")
cte("c_bs", f"""SELECT b.*, o.ord, greatest(s_us, {starts('o.ord')}) AS c0, least(e_us, {ends('o.ord')}) AS c1,
 least(e_us, {ends('o.ord')}) - greatest(s_us, {starts('o.ord')}) AS dur_us
 FROM c_bl b, (SELECT unnest(range((SELECT min({ordinal('s_us')}) FROM c_bl), (SELECT max({ordinal('e_us')}) + 1 FROM c_bl))) AS ord) o
 WHERE s_us < {ends('o.ord')} AND e_us > {starts('o.ord')}""")

cte("c_latest", f"""SELECT line_id, reached_us, CASE WHEN reached_us < {ends(ordinal('reached_us'))}
 THEN {ordinal('reached_us')} - 1 ELSE {ordinal('reached_us')} END AS latest_ord
 FROM (SELECT line_id, min(m) AS reached_us FROM (
  SELECT line_id, max(epoch_us(end_ts)) AS m FROM c_sb GROUP BY 1 UNION ALL
  SELECT line_id, max(us) FROM c_ppm GROUP BY 1 UNION ALL
  SELECT line_id, max(us) FROM c_os GROUP BY 1) GROUP BY 1)""")
cte("c_spine", f"""SELECT s.line_id, s.ord, (latest_ord - s.ord) // 14 AS week, latest_ord, x.day IS NOT NULL AS skipped
 FROM (SELECT l.line_id, latest_ord, unnest(range(f.first_ord, latest_ord + 1)) AS ord FROM c_latest l
  JOIN (SELECT line_id, min({ordinal('epoch_us(start_ts)')}) AS first_ord FROM c_sb GROUP BY 1) f USING (line_id)) s
 LEFT JOIN c_excl x ON x.line_id = s.line_id AND x.day = {odate('s.ord')}""")
cte("c_prod", "SELECT * FROM c_spine WHERE NOT skipped")
cte("c_weeks", """SELECT DISTINCT line_id, week, latest_ord - week * 14 AS newest_ord, latest_ord - week * 14 - 13 AS oldest_ord
 FROM c_spine""")

# OEE
cte("c_avail", f"""SELECT line_id, ord, CAST(sum(CASE WHEN running THEN dur_us ELSE 0 END) AS BIGINT) AS run_us,
 CAST(sum(CASE WHEN running THEN 0 ELSE dur_us END) AS BIGINT) AS stop_us FROM c_bs GROUP BY 1, 2""")
cte("c_speed", f"SELECT line_id, us, output_ppm AS ppm, {ordinal('us')} AS ord FROM c_ppm WHERE output_ppm > 0")
cte("c_ideal", f"""SELECT w.line_id, w.week, coalesce(quantile_cont(s.ppm, 0.95), 100.0) AS ideal_ppm
 FROM (SELECT line_id, week, min(ord) AS lo, max(ord) AS hi FROM c_prod GROUP BY 1, 2) w
 LEFT JOIN c_speed s ON s.line_id = w.line_id AND s.ord BETWEEN w.lo AND w.hi GROUP BY 1, 2""")
cte("c_pideal", f"""SELECT w.line_id, w.week, coalesce(quantile_cont(s.ppm, 0.95), 100.0) AS ideal_ppm
 FROM (SELECT line_id, week, hi, min(o) AS lo FROM (
  SELECT line_id, week, lo, hi, unnest(range(lo - 13, lo + 1)) AS o FROM (SELECT line_id, week, min(ord) AS lo, max(ord) AS hi FROM c_prod GROUP BY 1, 2)
 ) c WHERE o = lo OR NOT EXISTS (SELECT 1 FROM c_excl x WHERE x.line_id = c.line_id AND x.day = {odate('c.o')}) GROUP BY 1, 2, 3) w
 LEFT JOIN c_speed s ON s.line_id = w.line_id AND s.ord BETWEEN w.lo AND w.hi GROUP BY 1, 2""")
cte("c_sideal", """SELECT w.line_id, 0 AS week, coalesce(quantile_cont(s.ppm, 0.95), 100.0) AS ideal_ppm FROM (SELECT DISTINCT line_id, latest_ord FROM c_prod) w
 LEFT JOIN c_speed s ON s.line_id = w.line_id AND s.ord BETWEEN w.latest_ord - 13 AND w.latest_ord GROUP BY 1""")
cte("c_matched", """SELECT s.line_id, s.us, s.ord, s.ppm FROM c_speed s ASOF JOIN
 (SELECT line_id, ord, c0, c1 FROM c_bs WHERE running) b
 ON s.line_id = b.line_id AND s.ord = b.ord AND s.us >= b.c0 WHERE s.us <= b.c1""")
cte("c_avgppm", "SELECT line_id, ord, avg(ppm) AS avg_ppm, count(*) AS samples FROM c_matched GROUP BY 1, 2")
cte("c_quality", f"""SELECT line_id, ord, CASE WHEN n >= 2 AND dt > 0 THEN CAST(dg AS DOUBLE) / dt * 100 ELSE 100.0 END AS quality,
 CASE WHEN n >= 2 AND dt > 0 THEN dg ELSE 0 END AS good_count, CASE WHEN n >= 2 AND dt > 0 THEN dt ELSE 0 END AS total_count
 FROM (SELECT line_id, ord, count(*) AS n,
  CAST(coalesce(sum(CASE WHEN counter_total >= pt THEN counter_total - pt END), 0) AS BIGINT) AS dt,
  CAST(coalesce(sum(CASE WHEN counter_total >= pt THEN counter_good - pg END), 0) AS BIGINT) AS dg
  FROM (SELECT *, lag(counter_total) OVER w AS pt, lag(counter_good) OVER w AS pg FROM
   (SELECT *, {ordinal('us')} AS ord FROM c_os WHERE counter_total IS NOT NULL AND counter_good IS NOT NULL
    AND counter_good <= counter_total) WINDOW w AS (PARTITION BY line_id, ord ORDER BY us, row_id)) GROUP BY 1, 2)""")
cte("c_parts", f"""SELECT p.line_id, p.ord, p.week, p.latest_ord,
 coalesce(a.run_us / {12 * HOUR} * 100, 0.0) AS availability, coalesce(a.run_us / {HOUR}, 0.0) AS running_hours,
 coalesce(m.avg_ppm, 0.0) AS avg_ppm, coalesce(q.quality, 100.0) AS quality, coalesce(q.good_count, 0) AS good_count,
 coalesce(q.total_count, 0) AS total_count FROM c_prod p LEFT JOIN c_avail a USING (line_id, ord)
 LEFT JOIN c_avgppm m USING (line_id, ord) LEFT JOIN c_quality q USING (line_id, ord)""")
cte("c_oee", """SELECT *, availability / 100 * performance / 100 * quality / 100 * 100 AS oee FROM (
 SELECT p.*, CASE WHEN ideal_ppm > 0 THEN avg_ppm / ideal_ppm * 100 ELSE 0.0 END AS performance
 FROM c_parts p LEFT JOIN c_ideal i USING (line_id, week))""")
cte("c_poee", CTES["c_oee"].replace("c_ideal", "c_pideal"))
cte("c_stopsum", f"""SELECT line_id, ord, count(*) AS total_stops, CAST(sum(dur_us) AS BIGINT) / {HOUR} AS downtime_hours,
 max(dur_us) / {MINUTE} AS longest_min FROM c_bs WHERE NOT running GROUP BY 1, 2""")
cte("c_entries", f"""SELECT o.line_id, o.ord, o.week, o.latest_ord, {okey('o.ord', 'o.line_id')} AS shift_key,
 {otext('o.ord')} AS shift_date, {otype('o.ord')} AS shift_type, {olabel('o.ord')} AS label, {rnd('oee', 1)} AS oee,
 {rnd('availability', 1)} AS availability, {rnd('performance', 1)} AS performance, {rnd('quality', 1)} AS quality,
 {rnd('running_hours', 2)} AS running_hours, coalesce(total_stops, 0) AS total_stops,
 coalesce({rnd('downtime_hours', 2)}, 0.0) AS total_downtime_hours, coalesce({rnd('longest_min', 1)}, 0.0) AS longest_stop_min,
 good_count, total_count FROM c_oee o LEFT JOIN c_stopsum s USING (line_id, ord)""")
cte("c_pentries", CTES["c_entries"].replace("c_oee", "c_poee"))
_CENT = lambda c: f"sum(CAST(round({c} * 100) AS BIGINT))"
cte("c_week", f"""SELECT line_id, week, {otext('oldest_ord')} AS week_from, {otext('newest_ord')} AS week_to,
 {rnd('a / 100 * p / 100 * q / 100 * 100', 1)} AS oee, {rnd('a', 1)} AS availability, {rnd('p', 1)} AS performance,
 {rnd('q', 1)} AS quality, good_count, total_count, total_stops, production_shifts, excluded_shifts,
 total_downtime_hours, longest_stop_min FROM (
 SELECT w.line_id, w.week, w.oldest_ord, w.newest_ord, x.excluded_shifts,
  coalesce(run_c / 100.0 / (n * 12) * 100, 0.0) AS a,
  coalesce(CASE WHEN run_c > 0 THEN CAST(weighted AS DOUBLE) / run_c / 10 ELSE 0.0 END, 0.0) AS p,
  coalesce(CASE WHEN tc > 0 THEN CAST(gc AS DOUBLE) / tc * 100 ELSE 0.0 END, 0.0) AS q,
  {big('coalesce(gc, 0)')} AS good_count, {big('coalesce(tc, 0)')} AS total_count, {big('coalesce(st, 0)')} AS total_stops,
  coalesce(n, 0) AS production_shifts, coalesce(CAST(dt AS DOUBLE) / 100, 0.0) AS total_downtime_hours,
  coalesce(ls, 0.0) AS longest_stop_min
  FROM c_weeks w JOIN (SELECT line_id, week, {big('sum(CASE WHEN skipped THEN 1 ELSE 0 END)')} AS excluded_shifts FROM c_spine GROUP BY 1, 2) x USING (line_id, week)
  LEFT JOIN (SELECT line_id, week, count(*) AS n, {big(_CENT('running_hours'))} AS run_c,
   {big('sum(CAST(round(running_hours * 100) AS BIGINT) * CAST(round(performance * 10) AS BIGINT))')} AS weighted,
   sum(good_count) AS gc, sum(total_count) AS tc, sum(total_stops) AS st, {big(_CENT('total_downtime_hours'))} AS dt,
   max(longest_stop_min) AS ls FROM c_entries GROUP BY 1, 2) e USING (line_id, week))""")
cte("c_prior", f"""SELECT line_id, week, {otext('oldest_ord - 14')} AS prior_from, {otext('oldest_ord - 1')} AS prior_to,
 {rnd('a / 100 * p / 100 * q / 100 * 100', 1)} AS prior_oee, {rnd('a', 1)} AS prior_availability,
 {rnd('p', 1)} AS prior_performance, {rnd('q', 1)} AS prior_quality, prior_good, prior_total FROM (
 SELECT w.line_id, w.week, w.oldest_ord, coalesce(h / (n * 12) * 100, 0.0) AS a,
  coalesce(CASE WHEN h > 0 THEN wp / h ELSE 0.0 END, 0.0) AS p,
  coalesce(CASE WHEN tc > 0 THEN CAST(gc AS DOUBLE) / tc * 100 ELSE 0.0 END, 0.0) AS q,
  {big('coalesce(gc, 0)')} AS prior_good, {big('coalesce(tc, 0)')} AS prior_total
  FROM c_weeks w LEFT JOIN (SELECT p.line_id, p.week - 1 AS week, count(*) AS n, sum(running_hours) AS h,
   sum(CASE WHEN ideal_ppm > 0 THEN avg_ppm / ideal_ppm * 100 ELSE 0.0 END * running_hours) AS wp,
   sum(good_count) AS gc, sum(total_count) AS tc
   FROM c_parts p JOIN c_ideal i ON i.line_id = p.line_id AND i.week = p.week - 1 GROUP BY 1, 2) e USING (line_id, week))""")

# causes and downtime
cte("c_reason", """SELECT b.*, nullif(f.alarm_text, '') AS alarm_text FROM c_bl b
 LEFT JOIN c_fof f ON f.line_id = b.line_id AND f.ndx = b.start_id WHERE NOT running""")
cte("c_parsed", f"""SELECT *, CASE WHEN faults IS NULL OR faults IN ('', 'x') THEN [] ELSE
  list_transform(regexp_extract_all(faults, 'RC=(\\d+)', 1), lambda c: CAST(c AS BIGINT)) END AS codes,
 CASE WHEN faults IS NULL OR faults IN ('', 'x') THEN [] ELSE regexp_extract_all(faults, '{_FC}', 1) END AS ids,
 CASE WHEN faults IS NULL OR faults IN ('', 'x') THEN [] ELSE regexp_extract_all(faults, '{_FC}', 2) END AS texts FROM c_reason""")
cte("c_labelled", f"""SELECT *, CASE WHEN len(codes) > 0 THEN coalesce({describe('codes[1]')}, 'RC=' || codes[1])
 WHEN len(ids) > 0 THEN CASE WHEN texts[1] <> '' THEN texts[1] ELSE ids[1] END
 WHEN alarm_text IS NOT NULL AND alarm_text NOT IN ('', 'No Alarm Text') THEN alarm_text ELSE 'Unattributed' END AS label,
 list_transform(codes[2:], lambda c: {describe('c')}) AS other_texts FROM c_parsed""")
cte("c_second", f"""SELECT line_id, start_id, min_by(seg, i) AS seg FROM (
 SELECT line_id, start_id, i, {segment('t')} AS seg FROM (
 SELECT line_id, start_id, unnest(other_texts) AS t, unnest(range(1, len(other_texts) + 1)) AS i FROM c_labelled))
 WHERE seg <> 'unattributed' GROUP BY 1, 2""")
cte("c_decoded", f"""SELECT *, {cluster('label', 'segment')} AS cluster FROM (
 SELECT l.*, CASE WHEN lower(stop_type) = 'manual' THEN 'manual' WHEN prim <> 'unattributed' THEN prim
 ELSE coalesce(s.seg, 'unattributed') END AS segment FROM (SELECT *, {segment('label')} AS prim FROM c_labelled) l
 LEFT JOIN c_second s USING (line_id, start_id))""")
cte("c_dstops", """SELECT b.line_id, b.ord, b.start_id, b.s_us, b.c0, b.c1, b.dur_us, d.stop_type, d.label, d.segment, d.cluster
 FROM c_bs b JOIN c_decoded d USING (line_id, start_id) WHERE NOT b.running""")
cte("c_halts", """SELECT DISTINCT s.line_id, s.ord, s.start_id FROM c_dstops s JOIN c_ms m ON m.line_id = s.line_id
 AND m.us >= s.c0 AND m.us < s.c1 WHERE m.state_text IN ('Halted', 'HaltConditionReached')""")
cte("c_stops", """SELECT s.*, h.start_id IS NOT NULL AS halted, lower(s.stop_type) = 'manual' AS is_manual
 FROM c_dstops s LEFT JOIN c_halts h USING (line_id, ord, start_id)""")
cte("c_cats", f"""SELECT p.line_id, p.ord, p.week, c.category, c.category_label, c.category_color, c.cat_order,
 count(s.start_id) AS count, coalesce(CAST(sum(s.dur_us) AS BIGINT), 0) / {HOUR} AS hours
 FROM c_prod p CROSS JOIN c_categories c LEFT JOIN c_stops s ON s.line_id = p.line_id AND s.ord = p.ord AND CASE c.category
  WHEN 'micro_stops' THEN s.dur_us < {2 * MINUTE} AND NOT s.is_manual AND NOT s.halted WHEN 'halted' THEN s.halted
  WHEN 'auto_long' THEN s.dur_us >= {2 * MINUTE} AND NOT s.is_manual AND NOT s.halted ELSE s.is_manual END
 GROUP BY ALL""")
_SUMS = f"""count(s.start_id) AS count, {rnd(f'coalesce(CAST(sum(s.dur_us) AS BIGINT), 0) / {HOUR}', 2)} AS hours,
 {rnd(f'coalesce(CAST(sum(CASE WHEN s.halted THEN s.dur_us ELSE 0 END) AS BIGINT), 0) / {HOUR}', 2)} AS halted_hours,
 {rnd(f'coalesce(CAST(sum(CASE WHEN s.halted THEN 0 ELSE s.dur_us END) AS BIGINT), 0) / {HOUR}', 2)} AS stopped_hours"""
cte("c_seg", f"""SELECT p.line_id, p.ord, p.week, g.segment, g.seg_order, g.segment_label, g.segment_color, {_SUMS}
 FROM c_prod p JOIN c_segments g USING (line_id) LEFT JOIN c_stops s ON s.line_id = p.line_id AND s.ord = p.ord
 AND s.segment = g.segment GROUP BY ALL""")
cte("c_clu", f"""SELECT p.line_id, p.ord, p.week, s.segment, s.cluster, {_SUMS} FROM c_prod p JOIN c_stops s
 ON s.line_id = p.line_id AND s.ord = p.ord WHERE s.cluster IS NOT NULL GROUP BY ALL""")
cte("c_hours", f"""SELECT line_id, ord, hour_idx, printf('%02d:00', hour % 24) AS hour_label, segment, cluster,
 CAST(sum(us) AS BIGINT) AS us FROM (
 SELECT b.line_id, b.ord, h.i AS hour_idx, {starts('b.ord')} // {HOUR} + h.i AS hour,
  CASE WHEN b.running THEN 'running' ELSE d.segment END AS segment, CASE WHEN b.running THEN NULL ELSE d.cluster END AS cluster,
  least(b.c1, {starts('b.ord')} + (h.i + 1) * {HOUR}) - greatest(b.c0, {starts('b.ord')} + h.i * {HOUR}) AS us
  FROM c_bs b CROSS JOIN (SELECT unnest(range(0, 12)) AS i) h LEFT JOIN c_decoded d ON d.line_id = b.line_id AND d.start_id = b.start_id
  WHERE least(b.c1, {starts('b.ord')} + (h.i + 1) * {HOUR}) > greatest(b.c0, {starts('b.ord')} + h.i * {HOUR})
 UNION ALL SELECT line_id, ord, h.i, {starts('ord')} // {HOUR} + h.i, 'running', NULL, 0
  FROM (SELECT DISTINCT line_id, ord FROM c_bs) CROSS JOIN (SELECT unnest(range(0, 12)) AS i) h)
 GROUP BY ALL""")
H4 = f"CAST(sum(CAST(round({rnd(f'dur_us / {HOUR}', 4)} * 10000) AS BIGINT)) AS BIGINT)"
cte("c_top", f"""SELECT line_id, ord, segment, cluster, rank, label, count, {rnd('h4 / 10000.0::DOUBLE', 2)} AS hours FROM (
 SELECT *, row_number() OVER (PARTITION BY line_id, ord, segment, cluster ORDER BY h4 DESC, label) AS rank FROM (
 SELECT line_id, ord, segment, cluster, label, count(*) AS count, {H4} AS h4
 FROM c_stops WHERE cluster IS NOT NULL GROUP BY ALL)) WHERE rank <= 5""")
cte("c_trend", f"""SELECT {okey('a.ord', 'a.line_id')} AS anchor_shift_key, a.line_id, CAST(r.r AS INTEGER) AS trend_rank,
 {okey('s.ord', 'a.line_id')} AS trend_shift_key, {olabel('s.ord')} AS trend_shift_label, {otext('s.ord')} AS trend_shift_date,
 c.category, c.category_label, {rnd('c.hours', 2)} AS hours, c.category_color
 FROM c_seq a CROSS JOIN (SELECT unnest(range(0, 4)) AS r) r JOIN c_seq s ON s.line_id = a.line_id AND s.no = a.no - r.r
 JOIN c_cats c ON c.line_id = s.line_id AND c.ord = s.ord""")
cte("c_seq", "SELECT line_id, ord, row_number() OVER (PARTITION BY line_id ORDER BY ord) AS no FROM c_prod")

# anomalies
cte("c_prof", f"""SELECT line_id, ord, segment, cluster, {big(f"round({rnd('us / total', 4)} * 10000)")} AS share4 FROM (
 SELECT *, CAST(sum(us) OVER (PARTITION BY line_id, ord) AS BIGINT) AS total FROM (
 SELECT line_id, ord, segment, coalesce(cluster, segment) AS cluster, CAST(sum(dur_us) AS BIGINT) AS us FROM c_stops GROUP BY ALL))
 WHERE total > 0""")


def outliers(cells: str, period: str) -> str:
    """Outliers of (period, segment, cluster, share4, s1, s2, n)."""
    return f"""SELECT {period}, segment, cluster, {rnd('share * 100', 1)} AS current_share, {rnd('mean * 100', 1)} AS baseline_mean,
 z_score, CASE WHEN z > 0 THEN 'above' ELSE 'below' END AS direction,
 row_number() OVER (PARTITION BY {period} ORDER BY abs(z_score) DESC, segment || ':' || cluster) - 1 AS rank, {big('n')} AS baseline_members
 FROM (SELECT *, {rnd('z', 1)} AS z_score FROM (SELECT *, (share - mean) / std AS z FROM (
 SELECT *, share4 / 10000.0::DOUBLE AS share, s1 / (n::DOUBLE * 10000) AS mean,
  greatest(CASE WHEN n > 1 THEN sqrt((n * s2 - s1 * s1)::DOUBLE / (n::DOUBLE * (n - 1))) / 10000 ELSE 0.01 END, 0.01) AS std
 FROM ({cells}) WHERE n > 0)) WHERE abs(z) >= 1.8 AND (share > 0.05 OR mean > 0.05))"""


cte("c_members", f"""SELECT w.line_id, w.week, m.ord FROM (SELECT line_id, week, unnest(range(oldest_ord - 13, oldest_ord)) AS ord FROM c_weeks) m
 JOIN c_weeks w USING (line_id, week) ANTI JOIN c_excl x ON x.line_id = w.line_id AND x.day = {odate('m.ord')}""")
cte("c_keys", "SELECT DISTINCT line_id, segment, cluster FROM c_prof")
cte("c_shout", outliers("""SELECT t.line_id, t.week, t.ord, k.segment, k.cluster, coalesce(max(c.share4), 0) AS share4,
 CAST(coalesce(sum(b.share4), 0) AS BIGINT) AS s1, CAST(coalesce(sum(b.share4 * b.share4), 0) AS BIGINT) AS s2, count(*) AS n
 FROM c_prod t JOIN c_keys k USING (line_id) JOIN c_members m ON m.line_id = t.line_id AND m.week = t.week
 LEFT JOIN c_prof b ON b.line_id = m.line_id AND b.ord = m.ord AND b.segment = k.segment AND b.cluster = k.cluster
 LEFT JOIN c_prof c ON c.line_id = t.line_id AND c.ord = t.ord AND c.segment = k.segment AND c.cluster = k.cluster GROUP BY ALL""",
    "line_id, week, ord"))
cte("c_rollout", outliers(f"""SELECT t.line_id, t.ord, k.segment, k.cluster, coalesce(max(c.share4), 0) AS share4,
 CAST(coalesce(sum(b.share4), 0) AS BIGINT) AS s1, CAST(coalesce(sum(b.share4 * b.share4), 0) AS BIGINT) AS s2, count(*) AS n
 FROM (SELECT p.line_id, p.ord, p.ord - d.d AS member FROM c_prod p CROSS JOIN (SELECT unnest(range(1, 14)) AS d) d
  ANTI JOIN c_excl x ON x.line_id = p.line_id AND x.day = {odate('p.ord - d.d')}) t JOIN c_keys k USING (line_id)
 LEFT JOIN c_prof b ON b.line_id = t.line_id AND b.ord = t.member AND b.segment = k.segment AND b.cluster = k.cluster
 LEFT JOIN c_prof c ON c.line_id = t.line_id AND c.ord = t.ord AND c.segment = k.segment AND c.cluster = k.cluster GROUP BY ALL""",
    "line_id, ord"))
cte("c_wseg", f"SELECT line_id, week, segment, {big('sum(count)')} AS count, {', '.join(f'{big(_CENT(c))} AS {c}_c' for c in ('hours', 'halted_hours', 'stopped_hours'))} FROM c_seg GROUP BY ALL")
cte("c_wclu", f"SELECT line_id, week, segment, cluster, {big('sum(count)')} AS count, {', '.join(f'{big(_CENT(c))} AS {c}_c' for c in ('hours', 'halted_hours', 'stopped_hours'))} FROM c_clu GROUP BY ALL")
cte("c_wprof", f"""SELECT line_id, week, segment, cluster, {big(f"round({rnd('h / total', 4)} * 10000)")} AS share4 FROM (
 SELECT *, CAST(sum(h) OVER (PARTITION BY line_id, week) AS BIGINT) AS total FROM (
 SELECT line_id, week, segment, cluster, CAST(sum(h) AS BIGINT) AS h FROM (
 SELECT line_id, week, segment, cluster, hours_c AS h FROM c_wclu WHERE hours_c > 0 UNION ALL
 SELECT s.line_id, s.week, s.segment, s.segment, s.hours_c - coalesce(c.h, 0) FROM c_wseg s LEFT JOIN
  (SELECT line_id, week, segment, sum(hours_c) AS h FROM c_wclu GROUP BY ALL) c USING (line_id, week, segment)
  WHERE s.hours_c - coalesce(c.h, 0) > 0) GROUP BY ALL))""")
cte("c_pprof", f"""SELECT line_id, week, segment, cluster, {big(f"round({rnd('h / total', 4)} * 10000)")} AS share4 FROM (
 SELECT *, CAST(sum(h) OVER (PARTITION BY line_id, week) AS BIGINT) AS total FROM (
 SELECT line_id, week, segment, cluster, CAST(sum(share4) AS BIGINT) AS h FROM c_prof JOIN c_prod USING (line_id, ord) GROUP BY ALL)) WHERE total > 0""")
cte("c_wkout", outliers("""SELECT t.line_id, t.week, k.segment, k.cluster, coalesce(max(c.share4), 0) AS share4,
 CAST(coalesce(sum(b.share4), 0) AS BIGINT) AS s1, CAST(coalesce(sum(b.share4 * b.share4), 0) AS BIGINT) AS s2, count(*) AS n
 FROM c_weeks t JOIN (SELECT DISTINCT line_id, segment, cluster FROM (SELECT line_id, segment, cluster FROM c_keys UNION ALL SELECT line_id, segment, cluster FROM c_wprof)) k USING (line_id)
 JOIN (SELECT DISTINCT line_id, week FROM c_pprof) m ON m.line_id = t.line_id AND m.week BETWEEN t.week + 1 AND t.week + 4
 LEFT JOIN c_pprof b ON b.line_id = m.line_id AND b.week = m.week AND b.segment = k.segment AND b.cluster = k.cluster
 LEFT JOIN c_wprof c ON c.line_id = t.line_id AND c.week = t.week AND c.segment = k.segment AND c.cluster = k.cluster GROUP BY ALL""",
    "line_id, week"))
_RATIO = "(CASE WHEN baseline_mean > 0 THEN current_share / baseline_mean ELSE 0.0 END)"
_TIMES = f"CAST(CAST(round_even({_RATIO}, 0) AS BIGINT) AS VARCHAR)"


def headlines(source: str, period: str) -> str:
    tail = "cluster || ' stops than usual (' || segment_label || ')'"
    return f"""SELECT o.*, g.segment_label, g.segment_color, CASE WHEN direction = 'above' THEN
 (CASE WHEN {_RATIO} >= 2 THEN {_TIMES} || '× ' ELSE '' END) || 'more ' || {tail} ELSE 'Fewer ' || {tail} END AS headline,
 {t1('current_share')} || '% of this {period}''s downtime, normally ' || {t1('baseline_mean')} || '%' AS detail
 FROM {source} o JOIN c_segments g USING (line_id, segment)"""


cte("c_shrows", headlines("c_shout", "shift"))
cte("c_wkrows", headlines("c_wkout", "week"))
cte("c_findings", f"""SELECT line_id, week, row_number() OVER (PARTITION BY line_id, week ORDER BY item) - 1 AS rank, text FROM (
 SELECT line_id, week, 1 AS item, cluster || ' stops in ' || upper(segment[1]) || segment[2:] || CASE
  WHEN direction = 'above' AND {_RATIO} >= 2 THEN ' accounted for ' || {t1('current_share')} || '% of downtime — ' || {_TIMES}
   || '× the normal level (' || {t1('baseline_mean')} || '%)'
  WHEN direction = 'above' THEN ' ran above normal: ' || {t1('current_share')} || '% vs typical ' || {t1('baseline_mean')} || '%'
  ELSE ' below normal: ' || {t1('current_share')} || '% vs typical ' || {t1('baseline_mean')} || '%' END AS text
  FROM c_wkout WHERE rank = 0
 UNION ALL SELECT line_id, week, 2, 'Weekly OEE ' || CASE WHEN d > 0 THEN 'improved' ELSE 'declined' END || ' by ' || {t1('abs(d)')}
  || 'pp vs prior week (' || substr(prior_from, 6, 5) || ' – ' || substr(prior_to, 6, 5) || '): ' || {t1('oee')} || '% vs ' || {t1('prior_oee')} || '%'
  FROM (SELECT *, {rnd('oee - prior_oee', 1)} AS d FROM c_week JOIN c_prior USING (line_id, week)) WHERE abs(d) >= 1.0
 UNION ALL SELECT line_id, week, 3, 'Quality alert: ' || string_agg(part, ' · ' ORDER BY panel_order) || ' exceeded Laney p′ control limits this week'
  FROM (SELECT line_id, week, panel_order, panel_short || ' lanes ' || string_agg(CAST(lane_no AS VARCHAR), ', ' ORDER BY lane_no) AS part
   FROM (SELECT DISTINCT line_id, week, panel, lane_no FROM c_series WHERE ooc) JOIN c_panels USING (line_id, panel) GROUP BY line_id, week, panel_order, panel_short) GROUP BY 1, 2
 UNION ALL SELECT line_id, week, 4, 'Weakest shift: ' || label || ' at ' || {t1('oee')} || '% OEE (A=' || {t1('availability')} || '% · P=' || {t1('performance')}
  || '% · Q=' || {t1('quality')} || '%)' FROM (SELECT *, row_number() OVER (PARTITION BY line_id, week ORDER BY oee, ord DESC) AS no FROM c_entries) WHERE no = 1)""")

# SPC
_MATCH = " OR ".join(
    f"(line_id = '{r[0]}' AND p.panel = '{r[1]}' AND src = '{r[3]}' AND (" + " OR ".join(f"name LIKE '{station}'" for station in r[-1]) + "))" for r in rules.PANELS
)
cte("c_lanes", f"""SELECT r.line_id, p.panel, src AS counter_table, row_id, block_id, us, name, cnt,
 CASE WHEN p.dual THEN 'lane' || string_split(name, '_')[-1] ELSE name END AS lane FROM (
 SELECT 'hydration_counters' AS src, * FROM c_hc UNION ALL SELECT 'foil_counters', * FROM c_fc) r JOIN c_panels p USING (line_id) WHERE {_MATCH}""")
cte("c_rep", "SELECT line_id, panel, coalesce(max(p.representative), min_by(name, row_id)) AS name FROM c_lanes JOIN c_panels p USING (line_id, panel) GROUP BY 1, 2")
cte("c_reprows", f"""SELECT l.line_id, l.panel, l.block_id, l.row_id, l.us, l.cnt, {ordinal('l.us')} AS ord FROM c_lanes l JOIN c_rep USING (line_id, panel, name)
 JOIN (SELECT line_id, 'hydration_counters' AS counter_table, max(us) AS m FROM c_hc GROUP BY 1 UNION ALL SELECT line_id, 'foil_counters', max(us) FROM c_fc GROUP BY 1) f
 USING (line_id, counter_table) WHERE l.us >= (m - {75 * DAY}) // {SECOND} * {SECOND}""")
cte("c_fell", """SELECT line_id, panel, block_id, us FROM (SELECT *, lag(cnt) OVER (PARTITION BY line_id, panel ORDER BY block_id, row_id) AS p FROM c_reprows) WHERE cnt < p""")
cte("c_resets", """SELECT * FROM (SELECT f.*, lag(block_id) OVER w AS prev_block, lag(us) OVER w AS prev_us,
 count(*) OVER (PARTITION BY line_id, panel) AS n FROM c_fell f WINDOW w AS (PARTITION BY line_id, panel ORDER BY block_id))
 JOIN (SELECT line_id, panel, min_resets FROM c_panels) USING (line_id, panel) WHERE n >= min_resets""")
cte("c_marks", f"""SELECT line_id, panel, block_id, prev_block, straddle, CASE WHEN straddle THEN
  [prev_us // {SECOND} * {SECOND}] || bounds || [us // {SECOND} * {SECOND}]
  ELSE [CASE WHEN prev_us IS NULL THEN us // {SECOND} * {SECOND} ELSE greatest(prev_us // {SECOND} * {SECOND}, {starts(ordinal('us - 1'))}) END, us // {SECOND} * {SECOND}] END AS marks
 FROM (SELECT *, len(bounds) > 0 AS straddle FROM (SELECT r.*, CASE WHEN prev_us IS NULL THEN CAST([] AS BIGINT[]) ELSE
  list_filter(list_transform(range({ordinal('prev_us')}, {ordinal('us')} + 1), lambda o: {starts('o')}), lambda b: b > prev_us AND b < us) END AS bounds
  FROM c_resets r ANTI JOIN c_excl x ON x.line_id = r.line_id AND x.day = {date_of('r.us')}))""")
cte("c_segs", f"""SELECT line_id, panel, block_id, seg, straddle, closed, lo, hi,
 CASE WHEN straddle THEN CASE WHEN seg = 0 THEN prev_block ELSE (SELECT max(r.block_id) FROM c_reprows r WHERE r.line_id = t.line_id AND r.panel = t.panel AND r.us < t.lo) END END AS lo_block,
 CASE WHEN closed THEN block_id - 1 ELSE (SELECT max(r.block_id) FROM c_reprows r WHERE r.line_id = t.line_id AND r.panel = t.panel AND r.us < t.hi) END AS hi_block,
 CASE WHEN closed THEN hi ELSE hi - {SECOND} END AS stamp_us
 FROM (SELECT line_id, panel, block_id, prev_block, straddle, i AS seg, marks[i + 1] AS lo, marks[i + 2] AS hi, i = len(marks) - 2 AS closed
  FROM (SELECT *, unnest(range(0, len(marks) - 1)) AS i FROM c_marks)) t""")
cte("c_peaks", """SELECT s.line_id, s.panel, s.block_id, s.seg, max(o.counter_total) AS peak FROM c_segs s JOIN c_os o ON o.line_id = s.line_id
 AND o.us >= s.lo AND (o.us < s.hi OR (s.closed AND o.us = s.hi)) AND o.counter_total > 0 GROUP BY ALL""")
cte("c_blanes", """SELECT line_id, panel, block_id, lane, CAST(v AS BIGINT) AS value FROM (
 SELECT *, sum(n) OVER w AS rows, sum(nn) OVER w AS nulls, count(v) OVER w AS lanes FROM (
 SELECT line_id, panel, block_id, lane, sum(cnt) AS v, count(*) AS n, sum(CASE WHEN cnt IS NULL THEN 1 ELSE 0 END) AS nn FROM c_lanes GROUP BY ALL)
 WINDOW w AS (PARTITION BY line_id, panel, block_id)) JOIN (SELECT line_id, panel, n_lanes, dual FROM c_panels) USING (line_id, panel)
 WHERE v IS NOT NULL AND CASE WHEN dual THEN rows >= n_lanes AND lanes >= n_lanes ELSE rows = n_lanes AND nulls = 0 END""")
cte("c_subs", f"""SELECT * EXCLUDE (lane_mode, min_subgroups), CASE WHEN lane_mode = 'discovered_sorted' THEN dense_rank() OVER (PARTITION BY line_id, panel ORDER BY lane)
  ELSE CAST(regexp_extract(lane, '(\\d+)$', 1) AS INTEGER) END AS lane_no, peak / divisor AS n_inspected FROM (
 SELECT *, max(no) OVER (PARTITION BY line_id, panel) AS total_subgroups FROM (
 SELECT c.line_id, c.panel, c.block_id, c.seg, c.stamp_us, {ordinal('c.stamp_us')} AS ord, c.peak, p.divisor, e.lane, p.lane_mode, p.min_subgroups,
  CASE WHEN c.straddle THEN greatest(0, e.value - coalesce(s.value, 0)) ELSE e.value END AS rejects,
  dense_rank() OVER (PARTITION BY c.line_id, c.panel ORDER BY c.stamp_us, c.block_id, c.seg) AS no
 FROM (SELECT * FROM c_segs JOIN c_peaks USING (line_id, panel, block_id, seg)) c JOIN c_panels p USING (line_id, panel)
 JOIN c_blanes e ON e.line_id = c.line_id AND e.panel = c.panel AND e.block_id = c.hi_block
 LEFT JOIN c_blanes s ON s.line_id = c.line_id AND s.panel = c.panel AND s.block_id = c.lo_block AND s.lane = e.lane
 WHERE c.peak >= p.divisor * 100 AND (NOT c.straddle OR EXISTS (SELECT 1 FROM c_blanes v WHERE v.line_id = c.line_id AND v.panel = c.panel AND v.block_id = c.lo_block))))
 WHERE total_subgroups >= min_subgroups""")


def active(scope: str) -> str:
    return f"""SELECT line_id, panel, lane, lane_no FROM c_subs JOIN (SELECT line_id, panel, active_only FROM c_panels) USING (line_id, panel)
 WHERE {scope} GROUP BY ALL HAVING NOT any_value(active_only) OR max(rejects) > 0"""


cte("c_active", active("true"))
cte("c_active_shift", active("no < total_subgroups"))
cte("c_buckets", """SELECT line_id, panel, ord, lane, lane_no, CAST(sum(peak) AS BIGINT) / any_value(divisor) AS n, CAST(sum(rejects) AS BIGINT) AS d,
 min(stamp_us) AS first_us FROM c_subs GROUP BY ALL HAVING sum(peak) / any_value(divisor) >= 100""")
cte("c_bbuckets", f"""SELECT s.line_id, panel, ord, lane, lane_no, CAST(sum(peak) AS BIGINT) / any_value(divisor) AS n, CAST(sum(rejects) AS BIGINT) AS d,
 min(stamp_us) AS first_us FROM c_subs s ANTI JOIN c_excl x ON x.line_id = s.line_id AND x.day = {date_of('s.stamp_us')} GROUP BY ALL HAVING sum(peak) / any_value(divisor) >= 100""")
cte("c_prebase", """SELECT line_id, panel, week, lane, lane_no, first_us AS pos, n, d FROM (
 SELECT b.*, w.week, row_number() OVER (PARTITION BY b.line_id, panel, w.week, lane ORDER BY first_us DESC) AS back
 FROM c_bbuckets b JOIN c_weeks w ON w.line_id = b.line_id AND b.ord < w.oldest_ord) WHERE back <= 100""")


def laney(source: str, keys: str) -> str:
    return f"""SELECT {keys}, any_value(p) AS p_bar, greatest(coalesce(avg(step), 1.0) / 1.128, 0.01) AS sigma_z, count(*) AS baseline_n FROM (
 SELECT *, abs(z - lag(z) OVER (PARTITION BY {keys} ORDER BY pos)) AS step FROM (
 SELECT *, CASE WHEN p > 0 AND sqrt(p * (1 - p) / n) > 0 THEN (d / n - p) / sqrt(p * (1 - p) / n) ELSE 0.0 END AS z FROM (
 SELECT *, sum(d) OVER (PARTITION BY {keys}) / sum(n) OVER (PARTITION BY {keys}) AS p FROM {source}))) GROUP BY {keys}"""


def limited(source: str) -> str:
    return f"""SELECT *, coalesce(rate > ucl, false) AS ooc FROM (SELECT *, CASE WHEN n > 0 THEN d / n END AS rate,
 CASE WHEN n > 0 THEN p_bar + 3 * sigma_z * sqrt(p_bar * (1 - p_bar) / n) END AS ucl,
 CASE WHEN n > 0 THEN greatest(0.0, p_bar - 3 * sigma_z * sqrt(p_bar * (1 - p_bar) / n)) END AS lcl FROM ({source}))"""


cte("c_grid", """SELECT a.line_id, panel, lane, lane_no, week, a.ord, b.n, b.d, b.first_us FROM c_prod a JOIN c_active USING (line_id)
 LEFT JOIN (SELECT line_id, panel, lane, ord, n, d, first_us FROM c_buckets) b USING (line_id, panel, lane, ord)""")
cte("c_enough", "SELECT line_id, panel, week, count(DISTINCT ord) AS shift_subgroups FROM c_grid WHERE n IS NOT NULL GROUP BY ALL HAVING count(DISTINCT ord) >= 3")
cte("c_usable", "SELECT line_id, panel, week FROM c_prebase SEMI JOIN c_active USING (line_id, panel, lane) GROUP BY ALL HAVING count(DISTINCT pos) >= 2")
cte("c_wbase", """SELECT line_id, panel, week, lane, pos, n, d FROM c_prebase SEMI JOIN c_usable USING (line_id, panel, week) SEMI JOIN c_active USING (line_id, panel, lane)
 UNION ALL SELECT line_id, panel, week, lane, first_us, n, d FROM c_grid ANTI JOIN c_usable USING (line_id, panel, week) WHERE n IS NOT NULL""")
cte("c_series", limited(f"""SELECT g.line_id, panel, week, lane, g.lane_no, g.ord, coalesce(g.n, 0.0) AS n, g.d, p_bar, sigma_z, baseline_n, shift_subgroups
 FROM c_grid g JOIN c_enough USING (line_id, panel, week) JOIN ({laney('c_wbase', 'line_id, panel, week, lane')}) USING (line_id, panel, week, lane)"""))
cte("c_inshift", f"SELECT * FROM c_subs UNION ALL SELECT * REPLACE (ord - 1 AS ord) FROM c_subs WHERE stamp_us = {starts('ord')}")
cte("c_shpan", limited(f"""SELECT line_id, panel, week, ord, lane, lane_no, n, d, last_us, p_bar, sigma_z, baseline_n FROM (
 SELECT line_id, panel, week, ord, lane, lane_no, CAST(sum(peak) AS BIGINT) / any_value(divisor) AS n, CAST(sum(rejects) AS BIGINT) AS d, max(stamp_us) AS last_us
 FROM c_inshift JOIN (SELECT line_id, ord, week FROM c_prod) USING (line_id, ord) SEMI JOIN c_active_shift USING (line_id, panel, lane, lane_no) GROUP BY ALL)
 JOIN (SELECT * FROM ({laney('c_prebase', 'line_id, panel, week, lane')}) WHERE baseline_n >= 2) USING (line_id, panel, week, lane)"""))
cte("c_subno", "SELECT DISTINCT line_id, panel, no, stamp_us FROM c_subs")


def ewma(anchors: str, keys: str, lanes: str) -> str:
    """EWMA rows for anchors (line, panel, keys, end_us, base_us)."""
    group = f"line_id, panel, {keys}, lane, lane_no"
    pick = """SELECT * FROM (SELECT a.*, s.* EXCLUDE (line_id, panel), row_number() OVER (PARTITION BY a.line_id, a.panel, a.{k}, s.lane ORDER BY s.no DESC) AS back
 FROM a JOIN (SELECT line_id, panel, lane, lane_no, no, stamp_us, rejects / n_inspected * 100 AS rate FROM c_subs SEMI JOIN {l} USING (line_id, panel, lane)) s
 ON s.line_id = a.line_id AND s.panel = a.panel AND {c}) WHERE back <= 30"""
    shown = pick.format(k=keys, l=lanes, c="s.stamp_us <= a.end_us")
    base = pick.format(k=keys, l=lanes, c="s.stamp_us < a.base_us")
    return f"""WITH a AS ({anchors}), shown AS ({shown}), base AS ({base}),
 enough AS (SELECT line_id, panel, {keys} FROM base GROUP BY ALL HAVING count(DISTINCT no) >= 3),
 limits AS (SELECT {group}, {rnd('avg(rate) + 2.7 * greatest(coalesce(stddev_samp(rate), 0.01), 0.01) * sqrt(0.2 / 1.8)', 2)} AS ucl,
  {rnd('greatest(0.0, avg(rate) - 2.7 * greatest(coalesce(stddev_samp(rate), 0.01), 0.01) * sqrt(0.2 / 1.8))', 2)} AS lcl FROM (
  SELECT * FROM base SEMI JOIN enough USING (line_id, panel, {keys}) UNION ALL SELECT * FROM shown ANTI JOIN enough USING (line_id, panel, {keys})) GROUP BY ALL),
 lists AS (SELECT {group}, list(rate ORDER BY no) AS rates, list(stamp_us ORDER BY no) AS stamps FROM shown GROUP BY ALL HAVING count(*) >= 3),
 steps AS (SELECT *, unnest(range(1, len(rates) + 1)) AS i FROM lists)
 SELECT {group}, CAST(i - 1 AS INTEGER) AS batch_idx, stamps[i] AS stamp_us, rates[i] AS rate,
  list_reduce(rates[1:i], lambda x, y: {rnd('0.2 * y + 0.8 * x', 3)}) AS ewma, ucl, lcl FROM steps JOIN limits USING ({group})"""


cte("c_wewma", ewma(f"""SELECT line_id, panel, week, {ends('newest_ord')} AS end_us, {starts('oldest_ord')} AS base_us FROM c_weeks
 SEMI JOIN c_series USING (line_id, week) JOIN (SELECT DISTINCT line_id, panel, week FROM c_series) USING (line_id, week)""", "week", "c_active"))
cte("c_sewma", ewma(f"""SELECT DISTINCT line_id, panel, ord, {ends('ord')} AS end_us, {starts('oldest_ord')} AS base_us FROM c_shpan
 JOIN c_weeks USING (line_id, week)""", "ord", "c_active_shift"))

# schedule
cte("c_days", f"""SELECT line_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM (
 SELECT line_id, CAST(min(start_ts) AS DATE)::TIMESTAMP AS lo, CAST(max(start_ts) AS DATE)::TIMESTAMP AS hi FROM c_sb GROUP BY 1)""")
cte("c_dayrun", f"""SELECT line_id, CAST(start_ts AS DATE) AS day,
 {big(f'sum(CASE WHEN running THEN e_us // {SECOND} - s_us // {SECOND} ELSE 0 END)')} / 3600.0::DOUBLE AS run_hours FROM c_bl GROUP BY 1, 2""")
cte("c_dayout", f"""SELECT line_id, CAST(t_stamp AS DATE) AS day, max(counter_total) - min(counter_total) AS parts_produced, min(us) AS first_us,
 max(us) AS last_us, count(*) AS n_samples, (max(us) - min(us)) / {HOUR} AS coverage_hours FROM c_os GROUP BY 1, 2""")
cte("c_sched", f"""SELECT *, CASE classification WHEN 'non_production' THEN 0.0 WHEN 'partial' THEN {rnd('coverage_hours', 2)} ELSE 24.0 END AS effective_hours FROM (
 SELECT *, CASE WHEN run_hours < 2.0 AND parts_produced < 5000 THEN 'non_production' WHEN coverage_hours < 22.0 THEN 'partial' ELSE 'full' END AS classification FROM (
 SELECT d.line_id, d.day, coalesce(run_hours, 0.0) AS run_hours, coalesce(parts_produced, 0) AS parts_produced, coalesce(coverage_hours, 0.0) AS coverage_hours
 FROM c_days d LEFT JOIN c_dayrun USING (line_id, day) LEFT JOIN c_dayout USING (line_id, day)))""")

_NAME = re.compile(r"\bc_\w+\b")


def statement(body: str) -> str:
    """Prefix a SELECT with the steps it needs, each materialised once, in dependency order."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in dict.fromkeys(_NAME.findall(sql)):
            if name in CTES and name not in order:
                visit(CTES[name])
                if name not in order:
                    order.append(name)

    visit(body)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in order) + "\n" + body
