"""The SQL equivalent of every registered query (same column names), run by DuckDB."""

from __future__ import annotations

import re

from shiftlens.oracle import ctes as q
from shiftlens.oracle.ctes import (
    DAY, HOUR, MINUTE, SECOND, big, date_of, describe, ends, isoweek, limited, laney, odate, okey, olabel, ordinal,
    otext, otype, r6, rnd, starts, statement, t1, ts, tstext, weeklabel,
)

K = f"{okey('ord')} AS shift_key"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


COPIED, CUTOFF = "TIMESTAMP '2024-01-20 07:07:00'", "TIMESTAMP '2024-01-27 07:07:00'"
DTEXT = "strftime(day, '%Y-%m-%d') AS day"

_BODY: dict[str, str] = {}

_BODY["src1_line_scan"] = " UNION ALL ".join(
    f"SELECT line_id, count(*) AS n_rows, '{t}' AS table_name FROM {c} GROUP BY 1"
    for t, c in (("status_blocks", "c_sb"), ("fof_changes", "c_fof"), ("ppm", "c_ppm"), ("output_stats", "c_os"),
                 ("machine_state", "c_ms"), ("hydration_counters", "c_hc"), ("foil_counters", "c_fc"), ("downtime_overlays", "c_ov"))
)
_BODY["src2_column_aliases"] = """SELECT line_id, strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS start_ts, running, faults, stop_type, start_id FROM c_sb"""
_BODY["src3_availability_window"] = f"""SELECT line_id, count(*) AS n_rows, {tstext('min(us)')} AS first_ts, {tstext('max(us)')} AS last_ts
 FROM c_hc WHERE line_id <> 'line_a' OR us >= epoch_us(TIMESTAMP '2024-01-05') GROUP BY 1"""
_BODY["src4_document_scan"] = "SELECT shift_key, label, oee, total_stops, total_downtime_hours FROM c_pentries"
_SNAPKEY = f"strftime({ts(f'reached_us // {15 * MINUTE} * {15 * MINUTE}')}, '%Y%m%d_%H%M')"
_BODY["src5_snapshot_scan"] = f"""SELECT p.line_id, {_SNAPKEY} AS snapshot_key, {olabel('ord')} AS label, ord = p.latest_ord AS is_latest
 FROM c_prod p JOIN c_latest l USING (line_id) WHERE week = 0"""
_BODY["snk1_json_sink"] = f"""SELECT line_id, count(*) AS documents, {big('sum(n)')} AS shift_rows FROM (
 SELECT p.line_id, p.ord, count(*) AS n FROM c_prod p JOIN c_spine s ON s.line_id = p.line_id AND s.ord BETWEEN p.ord - 4 AND p.ord GROUP BY 1, 2) GROUP BY 1"""
_BODY["snk2_csv_sink"] = """SELECT shift_key AS "ShiftKey", label AS "Label", oee AS "OEE", running_hours AS "RunningHours", total_stops AS "TotalStops" FROM c_pentries"""
_BODY["snk3_snapshot_retention"] = f"""SELECT line_id, strftime({ts('b')}, '%Y%m%d_%H%M') AS snapshot_key, count(*) AS runs FROM (
 SELECT *, us // {15 * MINUTE} * {15 * MINUTE} AS b, max(us) OVER (PARTITION BY line_id) AS m FROM c_ppm) WHERE b >= m - {3 * DAY} GROUP BY 1, 2"""
_BODY["ing1_incremental_append"] = f"""SELECT line_id, strftime(t_stamp, '%Y-%m-%d %H:%M:%S') AS t_stamp, output_ppm FROM c_ppm p
 WHERE t_stamp < {CUTOFF} AND t_stamp > (SELECT max(t_stamp) FROM c_ppm o WHERE o.line_id = p.line_id AND t_stamp < {COPIED})"""
_BODY["ing2_hourly_batches"] = f"""SELECT line_id, strftime(date_trunc('hour', t_stamp), '%Y-%m-%d %H:%M:%S') AS batch_hour, count(*) AS n_rows FROM c_os p
 WHERE t_stamp < {CUTOFF} AND t_stamp > (SELECT max(t_stamp) FROM c_os o WHERE o.line_id = p.line_id AND t_stamp < {COPIED}) GROUP BY 1, 2"""


_C, _L = "epoch_us(" + COPIED + ")", "epoch_us(" + CUTOFF + ")"
_START = lambda c: f"(SELECT line_id, epoch_us(start_ts) AS us FROM {c})"
_BOTH, _ONE = ("line_a", "line_b"), ("line_a",)
_PLAN = (
    ("core", "status_blocks", _START("c_sb"), _BOTH), ("core", "downtime_overlays", _START("c_ov"), _BOTH), ("core", "fof_changes", "(SELECT line_id, epoch_us(t_stamp) AS us FROM c_fof)", _BOTH),
    ("core", "machine_state", "c_ms", _BOTH), ("core", "output_stats", "c_os", _BOTH), ("core", "ppm", "c_ppm", _BOTH), ("hydration", "hydration_counters", "c_hc", _ONE), ("foil", "foil_counters", "c_fc", _ONE),
)


def _planned(select: str, copied: str = f"us < {_C}", **other: str) -> str:
    """``select`` for each planned table and line; {source}, {line} and {copied} (what run 0 has) are filled in."""
    return " UNION ALL ".join(
        f"SELECT '{line}' AS line_id, '{group}' AS sub_system, '{table}' AS table_name, " + select.replace("{copied}", other.get(table, copied)).replace("{source}", f"(SELECT * FROM {source} WHERE line_id = '{line}')").replace("{table}", table)
        for group, table, source, lines in _PLAN for line in lines)


q.cte("c_added", _planned(f"(SELECT count(*) FROM {{source}} s WHERE us < {_L} AND us > (SELECT max(us) FROM {{source}} o WHERE {{copied}})) AS added"))
q.cte("c_run", f"SELECT * FROM c_added UNION ALL SELECT line_id, 'total', 'total', {big('sum(added)')} FROM c_added GROUP BY 1")
_BODY["ing1_plan_run"] = "SELECT *, 1 AS run FROM c_run UNION ALL SELECT line_id, sub_system, table_name, 0, 2 FROM c_run"
q.cte("c_target", _planned(f"(SELECT count(*) FROM {{source}} s WHERE us < {_L}) AS n, (SELECT max(us) FROM {{source}} s WHERE us < {_L}) AS m"))
_BODY["ing1_broken_run"] = f"SELECT line_id, table_name, n AS target_rows, n AS distinct_rows, n AS logged, {tstext('m')} AS mark, '0,2' AS runs FROM c_target WHERE n > 0"
_ONLY_B = f"us < {_C} AND line_id = 'line_b'"
q.cte("c_marks0", _planned("(SELECT max(us) FROM {source} s WHERE {copied}) AS local_max", fof_changes="true", machine_state=_ONLY_B, output_stats=_ONLY_B))
q.cte("c_rows0", _planned("us FROM {source} s"))
q.cte("c_preview", f"""SELECT m.*, (SELECT count(*) FROM c_rows0 r WHERE r.line_id = m.line_id AND r.table_name = m.table_name AND r.us < {_L}
 AND r.us > coalesce(m.local_max, CASE WHEN m.table_name = 'machine_state' THEN epoch_us(TIMESTAMP '1900-01-01') END)) AS rows_to_insert FROM c_marks0 m""")
_BODY["ing3_sync_preview"] = f"""SELECT line_id, sub_system, table_name, {tstext('local_max')} AS local_max, rows_to_insert,
 CASE WHEN local_max IS NULL THEN 'EMPTY' WHEN rows_to_insert = 0 THEN 'up-to-date' ELSE 'ready' END AS status FROM c_preview
 UNION ALL SELECT line_id, 'total', 'total', NULL, {big('sum(rows_to_insert)')}, NULL FROM c_preview GROUP BY 1"""
_BODY["ing2_hourly_files"] = f"""SELECT line_id, strftime(date_trunc('hour', t_stamp), '%Y%m%d_%H') AS batch_hour, count(*) AS n_rows FROM c_os p
 WHERE t_stamp < {CUTOFF} AND t_stamp >= TIMESTAMP '2024-01-22' AND t_stamp > (SELECT max(t_stamp) FROM c_os o WHERE o.line_id = p.line_id AND t_stamp < {COPIED}) GROUP BY 1, 2"""
_F = "'%Y-%m-%d %H:%M:%S'"
_BODY["ing4_freshness"] = f"""SELECT line_id, 'status_blocks' AS table_name, strftime(max(end_ts), {_F}) AS latest, count(*) FILTER (end_ts IS NULL) AS extra FROM c_sb GROUP BY 1
 UNION ALL SELECT line_id, 'downtime_overlays', strftime(max(start_ts) FILTER (start_ts <= TIMESTAMP '2024-02-15'), {_F}), count(*) FROM c_ov GROUP BY 1
 UNION ALL SELECT line_id, 'output_stats', strftime(max(t_stamp), {_F}), 0 FROM c_os GROUP BY 1
 UNION ALL SELECT line_id, 'ppm', strftime(max(t_stamp), {_F}), 0 FROM c_ppm GROUP BY 1
 UNION ALL SELECT line_id, 'fof_changes', strftime(max(t_stamp), {_F}), 0 FROM c_fof GROUP BY 1"""
_BODY["ing5_incremental_recompute"] = f"SELECT {K}, 1 AS run FROM c_prod UNION ALL SELECT {K}, 3 FROM c_prod WHERE ord % 2 = 1 AND {ends('ord')} < {ends('latest_ord')}"

_BODY["shf1_assign_shift"] = f"SELECT line_id, {otext('o')} AS shift_date, {otype('o')} AS shift_type, count(*) AS samples FROM (SELECT line_id, {ordinal('us')} AS o FROM c_ppm) GROUP BY 1, 2, 3"
_BODY["shf2_shift_window"] = f"SELECT {K}, {tstext(starts('ord'))} AS starts, {tstext(ends('ord'))} AS ends FROM c_spine"
_BODY["shf3_previous_shifts"] = f"SELECT {K}, CAST(r AS INTEGER) AS rank, {otext('ord - r')} AS prev_date, {otype('ord - r')} AS prev_type FROM c_spine, (SELECT unnest(range(1, 5)) AS r)"
_BODY["shf4_spc_cutoff"] = f"SELECT {K}, {tstext(starts('ord - 13'))} AS cutoff FROM c_spine"
_BODY["shf5_near_transition"] = f"""SELECT line_id, count(*) AS samples, count(*) FILTER (abs(m - 420) <= 30 OR abs(m - 1140) <= 30) AS near_samples
 FROM (SELECT line_id, us % {DAY} // {MINUTE} AS m FROM c_ppm) GROUP BY 1"""
_BODY["shf6_shift_labels"] = f"""SELECT {K}, {olabel('ord')} AS label, CASE WHEN ord % 2 = 1 THEN 'Night' ELSE 'Day' END || ' Shift — ' || {otext('ord')} ||
 CASE WHEN ord % 2 = 1 THEN ' (19:00 – 07:00)' ELSE ' (07:00 – 19:00)' END AS full_label FROM c_spine"""
_BATCH = """CASE WHEN hour({t}) < 13 THEN 'Night ' || strftime({t} - INTERVAL 1 DAY, '%m-%d') ELSE 'Day ' || strftime({t}, '%m-%d') END"""
_BODY["shf7_batch_end_label"] = f"SELECT line_id, {_BATCH.format(t='t_stamp')} AS batch_label, count(*) AS n FROM c_os GROUP BY 1, 2"
_BODY["shf8_boundaries_between"] = f"""SELECT line_id, start_id, string_agg({tstext('b')}, ', ' ORDER BY b) AS boundaries FROM (
 SELECT line_id, start_id, s_us, e_us, {starts('o')} AS b FROM c_bl, (SELECT unnest(range((SELECT min({ordinal('s_us')}) FROM c_bl), (SELECT max({ordinal('e_us')}) + 1 FROM c_bl))) AS o))
 WHERE b > s_us AND b < e_us GROUP BY 1, 2"""
_BODY["shf9_latest_shift"] = f"SELECT line_id, {tstext('reached_us')} AS reached, {okey('latest_ord')} AS shift_key FROM c_latest"
_BODY["shf10_iso_week"] = f"SELECT DISTINCT {otext('ord')} AS shift_date, {isoweek(odate('ord'))} AS iso_week, {weeklabel(odate('ord'))} AS week_label FROM c_spine"
_BODY["shf11_date_dimension"] = f"""SELECT strftime(d, '%Y-%m-%d') AS "Date", CAST(year(d) AS INTEGER) AS "Year", CAST(month(d) AS INTEGER) AS "MonthNum", strftime(d, '%b') AS "Month",
 CAST(day(d) AS INTEGER) AS "Day", strftime(d, '%a') AS "Weekday", {isoweek('d')} AS "IsoWeek" FROM (SELECT DISTINCT {odate('ord')} AS d FROM c_entries)"""
_BODY["shf12_shift_spine"] = f"""SELECT line_id, CAST(week AS INTEGER) AS week, skipped, {otext('ord')} AS shift_date, {otype('ord')} AS shift_type, {olabel('ord')} AS label,
 line_id || '|' || {olabel('ord')} AS line_shift_label, {isoweek(odate('ord'))} AS iso_week, {weeklabel(odate('ord'))} AS week_label, ord = latest_ord AS is_latest FROM c_spine"""

_BODY["flt1_interval_overlap"] = f"SELECT {K}, count(*) AS blocks FROM c_bs GROUP BY line_id, ord"
_BODY["flt2_clip_to_window"] = f"SELECT {K}, start_id, {dbl(f'dur_us / {MINUTE}')} AS dur_min FROM c_bs"
_BODY["flt3_half_open_window"] = f"""SELECT line_id, count(*) AS samples, {tstext('min(us)')} AS first_ts, {tstext('max(us)')} AS last_ts FROM c_ppm
 WHERE t_stamp >= TIMESTAMP '2024-01-10 07:00:00' AND t_stamp < TIMESTAMP '2024-01-17 07:00:00' GROUP BY 1"""
_BODY["flt4_excluded_days"] = "SELECT p.line_id, strftime(t_stamp, '%Y-%m-%d') AS day, count(*) AS samples FROM c_ppm p ANTI JOIN c_excl x ON x.line_id = p.line_id AND x.day = CAST(t_stamp AS DATE) GROUP BY 1, 2"
_BODY["flt5_excluded_set"] = f"SELECT line_id, {DTEXT} FROM (SELECT line_id, day FROM c_excl UNION SELECT line_id, day FROM c_sched WHERE classification = 'non_production')"
_BODY["flt5_stored_schedule"] = f"""SELECT {K}, skipped, count(*) FILTER (NOT skipped) OVER (PARTITION BY line_id, week) AS production_shifts FROM (
 SELECT line_id, week, ord, skipped OR EXISTS (SELECT 1 FROM c_sched d WHERE d.line_id = s.line_id AND d.day = {odate('s.ord')} AND run_hours < 14.0) AS skipped FROM c_spine s)"""
_BODY["flt6_stale_schedule"] = """SELECT line_id, 'no window' AS asked, count(*) AS days, '' AS warning FROM c_sched GROUP BY 1 UNION ALL
 SELECT line_id, 'other window', 0, 'schedule range ' || strftime(min(day), '%Y-%m-%d') || '..' || strftime(max(day), '%Y-%m-%d') ||
 ' does not match the window 2024-02-01..2024-02-08; schedule ignored' FROM c_sched GROUP BY 1"""
_BODY["flt7_name_pattern"] = "SELECT line_id, panel, name, count(*) AS n_rows FROM c_lanes GROUP BY ALL"
_BODY["flt8_running_flag"] = "SELECT line_id, running, count(*) AS blocks FROM c_sb GROUP BY ALL"
_BODY["flt9_counter_glitches"] = """SELECT line_id, count(*) FILTER (counter_good IS NOT NULL AND counter_total IS NOT NULL AND counter_good <= counter_total) AS kept,
 count(*) FILTER (counter_good IS NULL OR counter_total IS NULL) AS null_rows, count(*) FILTER (counter_good > counter_total) AS glitches FROM c_os GROUP BY 1"""

_BODY["joi1_stop_reason"] = "SELECT line_id, start_id, alarm_text FROM c_reason"
_BODY["joi2_interval_by_shift"] = f"SELECT {K}, count(*) AS stops, {dbl(f'sum(dur_us) / {MINUTE}')} AS minutes FROM c_bs WHERE NOT running GROUP BY line_id, ord"
_BODY["joi3_interval_by_hour"] = f"""SELECT line_id, {tstext(f'h * {HOUR}')} AS hour, running, {dbl(f'sum(least(e_us, (h + 1) * {HOUR}) - greatest(s_us, h * {HOUR})) / {MINUTE}')} AS minutes
 FROM (SELECT *, unnest(range(s_us // {HOUR}, e_us // {HOUR} + 1)) AS h FROM c_bl) WHERE least(e_us, (h + 1) * {HOUR}) > greatest(s_us, h * {HOUR}) GROUP BY line_id, h, running"""
_BODY["joi4_point_in_interval"] = """SELECT s.line_id, s.us AS sample_us, s.ppm, max(b.c0) AS block_start_us FROM c_speed s JOIN c_bs b ON b.line_id = s.line_id AND b.ord = s.ord
 AND b.running AND s.us >= b.c0 AND s.us <= b.c1 GROUP BY ALL"""
_BODY["joi5_halted_stops"] = f"SELECT {K}, start_id FROM c_halts"
_BODY["joi6_lanes_at_blocks"] = "SELECT b.* FROM c_blanes b SEMI JOIN c_resets r ON r.line_id = b.line_id AND r.panel = b.panel AND b.block_id = r.block_id - 1"
_BODY["joi7_lanes_at_first_reset"] = "SELECT b.* FROM c_blanes b SEMI JOIN (SELECT line_id, panel, min(block_id) AS block_id FROM c_resets GROUP BY 1, 2) r USING (line_id, panel, block_id)"
_BODY["joi8_block_before_boundary"] = f"""SELECT line_id, panel, {tstext(starts('o'))} AS boundary, max(block_id) AS last_block FROM (
 SELECT r.*, o FROM c_reprows r, (SELECT unnest(range((SELECT min(ord) + 1 FROM c_reprows), (SELECT max(ord) + 2 FROM c_reprows))) AS o) WHERE r.us < {starts('o')})
 GROUP BY line_id, panel, o"""
_BODY["joi9_peak_in_range"] = "SELECT * REPLACE (CAST(seg AS INTEGER) AS seg) FROM c_peaks"
_BODY["joi10_calendar_joins"] = f"SELECT line_id, {DTEXT}, {dbl('run_hours')} AS run_hours, parts_produced, {dbl('coverage_hours')} AS coverage_hours FROM c_sched"
_BODY["joi11_zero_filled_keys"] = f"""SELECT {K}, segment, cluster, share4, s1, s2, members FROM (
 SELECT t.line_id, t.ord, k.segment, k.cluster, coalesce(max(c.share4), 0) AS share4, CAST(coalesce(sum(b.share4), 0) AS BIGINT) AS s1,
 CAST(coalesce(sum(b.share4 * b.share4), 0) AS BIGINT) AS s2, count(*) AS members, bool_or(b.share4 IS NOT NULL OR c.share4 IS NOT NULL) AS seen
 FROM c_prod t JOIN c_keys k USING (line_id) JOIN c_members m ON m.line_id = t.line_id AND m.week = t.week
 LEFT JOIN c_prof b ON b.line_id = m.line_id AND b.ord = m.ord AND b.segment = k.segment AND b.cluster = k.cluster
 LEFT JOIN c_prof c ON c.line_id = t.line_id AND c.ord = t.ord AND c.segment = k.segment AND c.cluster = k.cluster GROUP BY t.line_id, t.ord, k.segment, k.cluster) WHERE seen"""
_BODY["joi12_star_join"] = f"""SELECT line AS "Line", {isoweek(odate('s.ord'))} AS "IsoWeek", strftime({odate('s.ord')}, '%b') AS "Month", segment_label AS "SegmentLabel",
 CAST(sum(CAST(round(hours * 100) AS BIGINT)) AS DOUBLE) / 100 AS hours, count(DISTINCT s.ord) AS shifts FROM c_seg s JOIN c_lines USING (line_id) GROUP BY ALL"""
_DETAIL = f"""SELECT line_id, panel, week, ord, lane_no, d AS rejects, {rnd('rate * 100', 2)} AS rate_pct, {rnd('ucl * 100', 3)} AS ucl_pct, CAST(ooc AS INTEGER) AS ooc,
 CAST(round_even(n, 0) AS BIGINT) AS n_inspected, dense_rank() OVER (PARTITION BY line_id, panel, week ORDER BY ord) - 1 AS shift_idx, {rnd('p_bar * 100', 3)} AS p_bar_pct FROM c_series WHERE n > 0"""
q.cte("c_detail", _DETAIL)
_BODY["joi13_spc_with_limits"] = "SELECT line_id, panel, CAST(week AS INTEGER) AS week, CAST(lane_no AS INTEGER) AS lane_no, rejects, rate_pct, ucl_pct, ooc, n_inspected, p_bar_pct FROM c_detail"

_BODY["oee1_availability"] = f"SELECT {K}, {dbl(f'run_us / {12 * HOUR} * 100')} AS availability, {dbl(f'run_us / {HOUR}')} AS running_hours, {dbl(f'stop_us / {HOUR}')} AS stopped_hours FROM c_avail"
_BODY["oee2_ideal_speed"] = f"SELECT line_id, CAST(week AS INTEGER) AS week, {r6('ideal_ppm')} AS ideal_ppm FROM c_ideal"
_BODY["oee2_published"] = f"SELECT line_id, CAST(week AS INTEGER) AS week, {r6('ideal_ppm')} AS ideal_ppm FROM c_pideal"
_BODY["oee2_single_shift"] = f"SELECT line_id, CAST(week AS INTEGER) AS week, {r6('ideal_ppm')} AS ideal_ppm FROM c_sideal"
_BODY["oee3_performance"] = f"SELECT {K}, {r6('performance')} AS performance, {r6('avg_ppm')} AS avg_ppm FROM c_oee"
_BODY["oee4_quality"] = f"SELECT {K}, {dbl('quality')} AS quality, good_count, total_count FROM c_quality"
_BODY["oee5_shift_oee"] = """SELECT CAST(week AS INTEGER) AS week, shift_key, shift_date, shift_type, label, oee, availability, performance, quality, running_hours, total_stops,
 total_downtime_hours, longest_stop_min, good_count, total_count FROM c_entries"""
_BODY["oee5_published"] = _BODY["oee5_shift_oee"].replace("c_entries", "c_pentries")
_BODY["oee6_week_rollup"] = "SELECT * REPLACE (CAST(week AS INTEGER) AS week) FROM c_week"
_BODY["oee7_prior_week"] = "SELECT * REPLACE (CAST(week AS INTEGER) AS week) FROM c_prior"
_BODY["oee8_iso_week_rollup"] = f"""SELECT line_id, {isoweek(odate('ord'))} AS iso_week, min(shift_date) AS week_start, max(shift_date) AS week_end, count(*) AS n_shifts,
 string_agg(label, ', ' ORDER BY ord) AS shifts FROM c_entries GROUP BY 1, 2"""
_KPI = " UNION ALL ".join(
    f"SELECT shift_key, prev_label, '{k}' AS kpi, {k} AS value, lag({k}) OVER (PARTITION BY line_id ORDER BY ord) AS prev FROM x" for k in ("oee", "availability", "performance", "quality")
)
_BODY["oee9_kpi_bands"] = f"""SELECT shift_key, kpi, value, prev_label, CASE WHEN value >= 80 THEN 'good' WHEN value >= 60 THEN 'fair' ELSE 'poor' END AS band, {rnd('value - prev', 1)} AS delta_pp,
 CASE WHEN prev IS NULL THEN NULL WHEN abs(value - prev) < 0.05 THEN 'flat' WHEN value - prev > 0 THEN 'up' ELSE 'down' END AS trend FROM (
 WITH x AS (SELECT *, lag(label) OVER (PARTITION BY line_id ORDER BY ord) AS prev_label FROM c_pentries) {_KPI})"""
_BODY["oee9_week_deltas"] = "SELECT line_id, CAST(week AS INTEGER) AS week, " + ", ".join(
    f"{rnd(f'{c} - prior_{c}', 1)} AS {c}_dpp" for c in ("oee", "availability", "performance", "quality")) + " FROM c_week JOIN c_prior USING (line_id, week)"
_BODY["oee12_oee_trend"] = """SELECT line_id, CAST(week AS INTEGER) AS week, CAST(row_number() OVER (PARTITION BY line_id, week ORDER BY ord) AS INTEGER) AS position, label, shift_type, oee, availability, performance, quality FROM c_entries"""

_BODY["cau1_parse_faults"] = """SELECT line_id, start_id, coalesce(array_to_string(codes, ';'), '') AS codes,
 coalesce(array_to_string(list_transform(range(1, len(ids) + 1), lambda i: ids[i] || '=' || coalesce(texts[i], '')), ';'), '') AS entries FROM c_parsed"""
_VAR = " || ',' || ".join(f"printf('{p}_%04d', code) || ',{p}_' || code || ',{p}_PLC1_' || code" for p in ("Fault", "Alarm", "Warning"))
_BODY["cau2_code_variants"] = f"SELECT code, {_VAR} AS variants FROM (SELECT DISTINCT unnest(codes) AS code FROM c_parsed)"
q.cte("c_codes", f"""SELECT line_id, start_id, s_us, pos, code, {describe('code')} AS description FROM (
 SELECT line_id, start_id, s_us, ids, texts, unnest(codes) AS code, unnest(range(0, len(codes))) AS pos FROM c_parsed)""")
_BODY["cau3_code_description"] = "SELECT line_id, start_id, CAST(pos AS INTEGER) AS pos, code, description FROM c_codes"
_BODY["cau4_display_label"] = "SELECT line_id, start_id, label FROM c_labelled"
q.cte("c_dict", "SELECT line_id, code, description FROM (SELECT *, row_number() OVER (PARTITION BY line_id, code ORDER BY s_us, start_id, pos) AS no FROM c_codes WHERE description IS NOT NULL) WHERE no = 1")
_BODY["cau5_code_dictionary"] = "SELECT * FROM c_dict"
q.cte("c_attr", """SELECT p.*, p.codes[1] AS rc_code, len(p.codes) AS rc_codes_count,
 CASE WHEN p.label = 'RC=' || p.codes[1] THEN coalesce(d.description, p.label) ELSE p.label END AS rc_label,
 CASE WHEN len(codes) > 0 THEN 'RC' WHEN len(ids) > 0 THEN 'FC-fallback' WHEN alarm_text IS NOT NULL AND alarm_text NOT IN ('', 'No Alarm Text') THEN 'FOF-fallback' ELSE 'Unattributed' END AS attribution_method
 FROM c_labelled p LEFT JOIN c_dict d ON d.line_id = p.line_id AND d.code = p.codes[1]""")
_BODY["cau6_attribution"] = "SELECT line_id, start_id, rc_code, rc_label, CAST(rc_codes_count AS INTEGER) AS rc_codes_count, attribution_method FROM c_attr"
_BODY["cau7_explode_codes"] = f"""SELECT a.line_id, a.start_id, c.code, CASE WHEN c.code IS NULL THEN a.rc_label ELSE coalesce(d.description, 'RC=' || c.code) END AS rc_label,
 {dbl(f'(e_us - a.s_us) / {MINUTE} / greatest(len(codes), 1)')} AS minutes, {dbl(f'CASE WHEN coalesce(c.pos, 0) = 0 THEN (e_us - a.s_us) / {MINUTE} ELSE 0.0 END')} AS primary_minutes
 FROM c_attr a LEFT JOIN c_codes c ON c.line_id = a.line_id AND c.start_id = a.start_id LEFT JOIN c_dict d ON d.line_id = a.line_id AND d.code = c.code"""
_BODY["cau8_segment_of_label"] = f"SELECT DISTINCT line_id, label, {q.segment('label')} AS segment FROM c_labelled"
_BODY["cau9_segment_of_stop"] = "SELECT line_id, start_id, segment FROM c_decoded"
_BODY["cau10_cause_cluster"] = "SELECT DISTINCT line_id, segment, label, cluster FROM c_decoded"
_BODY["cau11_decoded_stops"] = "SELECT line_id, start_id, segment, cluster, label FROM c_decoded"

_BODY["dt1_categories"] = f"SELECT {K}, category, count, {dbl('hours')} AS hours FROM c_cats"
_BODY["dt2_segments"] = f"SELECT {K}, segment, count, hours, halted_hours, stopped_hours FROM c_seg"
_BODY["dt2_clusters"] = f"SELECT {K}, segment, cluster, count, hours, halted_hours, stopped_hours FROM c_clu"
_BODY["dt3_stop_summary"] = f"SELECT {K}, total_stops, {dbl('downtime_hours')} AS downtime_hours, {dbl('longest_min')} AS longest_min FROM c_stopsum"
_BODY["dt4_hourly"] = f"SELECT {K}, CAST(hour_idx AS INTEGER) AS hour_idx, hour_label, segment, cluster, {dbl(f'us / {MINUTE}')} AS minutes FROM c_hours"
_BODY["dt5_top_stops"] = f"SELECT {K}, segment, cluster, CAST(rank AS INTEGER) AS rank, label, count, hours FROM c_top"
_BODY["dt6_week_top_stops"] = f"""SELECT line_id, CAST(week AS INTEGER) AS week, segment, cluster, CAST(rank AS INTEGER) AS rank, label, count, {rnd('h4 / 10000.0::DOUBLE', 2)} AS hours FROM (
 SELECT *, row_number() OVER (PARTITION BY line_id, week, segment, cluster ORDER BY h4 DESC, label) AS rank FROM (
 SELECT line_id, week, segment, cluster, label, count(*) AS count, {q.H4} AS h4 FROM c_stops JOIN (SELECT line_id, ord, week FROM c_prod) USING (line_id, ord) WHERE cluster IS NOT NULL GROUP BY ALL)) WHERE rank <= 5"""
_WK = ", ".join(f"CAST({c}_c AS DOUBLE) / 100 AS {c}" for c in ("hours", "halted_hours", "stopped_hours"))
_BODY["dt7_week_segments"] = f"SELECT line_id, CAST(week AS INTEGER) AS week, segment, count, {_WK} FROM c_wseg"
_BODY["dt7_week_clusters"] = f"SELECT line_id, CAST(week AS INTEGER) AS week, segment, cluster, count, {_WK} FROM c_wclu"
_BODY["dt8_week_categories"] = f"SELECT line_id, CAST(week AS INTEGER) AS week, category, {big('sum(count)')} AS count, CAST(sum(CAST(round({rnd('hours', 2)} * 100) AS BIGINT)) AS DOUBLE) / 100 AS hours FROM c_cats GROUP BY ALL"
_BODY["dt9_cluster_reference"] = f"""SELECT {K}, segment, CAST(row_number() OVER (PARTITION BY line_id, ord, segment ORDER BY cluster = 'Other', hours DESC, cluster_order) AS INTEGER) AS position, cluster, count, hours,
 {dbl('coalesce(CASE WHEN seg_hours > 0 THEN hours / seg_hours * 100 END, 0.0)')} AS segment_pct, coalesce(top_labels, '') AS top_labels FROM (
 SELECT s.line_id, s.ord, s.segment, k.cluster, k.cluster_order, s.hours AS seg_hours, coalesce(c.count, 0) AS count, coalesce(c.hours, 0.0) AS hours
  FROM c_seg s JOIN c_clusters k USING (line_id, segment) LEFT JOIN c_clu c USING (line_id, ord, segment, cluster)
 UNION ALL SELECT c.line_id, c.ord, c.segment, c.cluster, 9999, s.hours, c.count, c.hours FROM c_clu c JOIN c_seg s USING (line_id, ord, segment) WHERE c.cluster = 'Other')
 LEFT JOIN (SELECT line_id, ord, segment, cluster, string_agg(label, '; ' ORDER BY rank) AS top_labels FROM c_top GROUP BY ALL) USING (line_id, ord, segment, cluster)"""
_BODY["dt10_daily_breakdown"] = f"""SELECT {K}, {r6('dh')} AS downtime_hours, {r6('greatest(0.0, 12.0 - dh)')} AS running_hours FROM (
 SELECT line_id, ord, CAST(sum(CAST(round(hours * 100) AS BIGINT)) AS DOUBLE) / 100 AS dh FROM c_seg GROUP BY 1, 2)"""
_BODY["dt11_shift_trend"] = "SELECT * FROM c_trend"
_BODY["dt12_best_anchor"] = """SELECT line_id, anchor_shift_key, ranks, current_date FROM (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY ranks DESC, current_date DESC, anchor_shift_key DESC) AS no FROM (
 SELECT line_id, anchor_shift_key, count(DISTINCT trend_rank) AS ranks, max(trend_shift_date) FILTER (trend_rank = 0) AS current_date FROM c_trend GROUP BY 1, 2)) WHERE no = 1"""
_BODY["dt12_best_anchor"] = _BODY["dt12_best_anchor"].replace("current_date", '"current_date"')
_BODY["dt13_latest_flag"] = "SELECT shift_key, CAST(shift_key = max(shift_key) OVER (PARTITION BY line_id) AS INTEGER) AS is_latest FROM c_entries"
_BODY["dt14_last_four_shifts"] = f"""SELECT line_id, {olabel('ord')} AS label, position, category, hours, shift_hours, max(shift_hours) OVER (PARTITION BY line_id) AS max_hours FROM (
 SELECT line_id, ord, CAST(ord - latest_ord + 4 AS INTEGER) AS position, category, {rnd('hours', 2)} AS hours,
 CAST(sum(CAST(round({rnd('hours', 2)} * 100) AS BIGINT)) OVER (PARTITION BY line_id, ord) AS DOUBLE) / 100 AS shift_hours
 FROM c_cats JOIN (SELECT line_id, ord, latest_ord FROM c_prod) USING (line_id, ord) WHERE ord > latest_ord - 4)"""

_OUT = "segment, cluster, current_share, baseline_mean, z_score, direction, CAST(rank AS INTEGER) AS rank"
_BODY["ano1_cluster_profile"] = f"SELECT {K}, segment, cluster, share4 FROM c_prof"
_BODY["ano2_shift_outliers"] = f"SELECT {K}, {_OUT} FROM c_shout"
_BODY["ano3_fixed_baseline"] = f"SELECT line_id, CAST(week AS INTEGER) AS week, {okey('ord')} AS shift_key FROM c_members"
_BODY["ano4_rolling_outliers"] = f"SELECT {K}, {_OUT}, baseline_members FROM c_rollout"
_BODY["ano5_week_profile"] = "SELECT line_id, CAST(week AS INTEGER) AS week, segment, cluster, share4 FROM c_wprof"
_BODY["ano6_prior_week_profiles"] = "SELECT line_id, CAST(week AS INTEGER) AS week, segment, cluster, share4 FROM c_pprof"
_BODY["ano6_week_outliers"] = f"SELECT line_id, CAST(week AS INTEGER) AS week, {_OUT}, baseline_members FROM c_wkout"
_BODY["ano7_headlines"] = f"SELECT {K}, CAST(rank AS INTEGER) AS rank, headline, detail, segment_color AS seg_color FROM c_shrows"
_BODY["ano8_top_outlier"] = f"""SELECT {K}, {olabel('ord')} AS label, segment, cluster, direction, z_score, others FROM (SELECT *, count(*) OVER (PARTITION BY line_id, ord) - 1 AS others,
 row_number() OVER (PARTITION BY line_id, ord ORDER BY direction = 'above' DESC, CASE WHEN direction = 'above' THEN z_score ELSE abs(z_score) END DESC, rank) AS no FROM c_shout) WHERE no = 1"""
_BODY["ano9_newest_anomalous"] = f"""SELECT line_id, shift_key, CAST(position AS INTEGER) AS position, segment, cluster, z_score, CASE WHEN n > 1 THEN '+' || (n - 1) || ' more' ELSE '' END AS more FROM (
 SELECT *, dense_rank() OVER (PARTITION BY line_id ORDER BY shift_key DESC) AS position, count(*) OVER (PARTITION BY line_id, shift_key) AS n FROM (SELECT *, {okey('ord')} AS shift_key FROM c_shout)) WHERE position <= 14 AND rank = 0"""
_BODY["ano10_key_findings"] = "SELECT line_id, CAST(week AS INTEGER) AS week, CAST(rank AS INTEGER) AS rank, text FROM c_findings"
_BODY["ano11_masked_spikes"] = """SELECT line_id, CAST(week AS INTEGER) AS week, coalesce(n, 0) AS anomalous_shifts, o.week IS NULL AND coalesce(n, 0) > 0 AS masked FROM c_weeks w
 LEFT JOIN (SELECT line_id, week, count(DISTINCT ord) AS n FROM c_shout GROUP BY 1, 2) USING (line_id, week) LEFT JOIN (SELECT DISTINCT line_id, week FROM c_wkout) o USING (line_id, week)"""
_BODY["ano12_first_outliers"] = f"SELECT line_id, CAST(week AS INTEGER) AS week, CAST(rank AS INTEGER) AS rank, segment, cluster, direction, {rnd(q._RATIO, 1)} AS ratio FROM c_wkout WHERE rank < 5"

_BODY["spc1_counter_resets"] = "SELECT line_id, panel, block_id, us AS reset_us, prev_block FROM c_resets"
_BODY["spc2_representative_lane"] = "SELECT * FROM c_rep"
_BODY["spc3_lane_vector"] = "SELECT b.* FROM c_blanes b SEMI JOIN (SELECT line_id, panel FROM c_panels WHERE NOT dual) USING (line_id, panel) SEMI JOIN c_reprows USING (line_id, panel, block_id)"
_BODY["spc4_dual_station_lanes"] = "SELECT b.* FROM c_blanes b SEMI JOIN (SELECT line_id, panel FROM c_panels WHERE dual) USING (line_id, panel) SEMI JOIN c_reprows USING (line_id, panel, block_id)"
_BODY["spc5_subgroups"] = f"SELECT line_id, panel, CAST(no AS INTEGER) AS no, {tstext('stamp_us')} AS stamp, lane, CAST(lane_no AS INTEGER) AS lane_no, {r6('n_inspected')} AS n_inspected, rejects FROM c_subs"
_BODY["spc6_epoch_start"] = f"SELECT line_id, panel, block_id, {tstext('lo')} AS epoch_start, {tstext('hi')} AS reset FROM c_segs WHERE NOT straddle"
_BODY["spc7_straddling_batches"] = f"SELECT line_id, panel, block_id, CAST(seg AS INTEGER) AS seg, {tstext('lo')} AS starts, {tstext('hi')} AS ends, closed, lo_block, hi_block, {tstext('stamp_us')} AS stamp FROM c_segs WHERE straddle"
_BODY["spc8_panels"] = f"SELECT line_id, panel, CAST(max(total_subgroups) AS INTEGER) AS subgroups, count(DISTINCT lane) AS lanes, {big('sum(rejects)')} AS rejects FROM c_subs GROUP BY 1, 2"
_BODY["spc9_lanes"] = "SELECT line_id, panel, lane, CAST(lane_no AS INTEGER) AS lane_no FROM c_active"
_BODY["spc10_shift_baseline"] = f"SELECT line_id, panel, CAST(week AS INTEGER) AS week, lane, {tstext('pos')} AS first_stamp, {r6('n')} AS n, d FROM c_prebase"
_BODY["spc11_laney_parameters"] = f"SELECT line_id, panel, CAST(week AS INTEGER) AS week, lane, {r6('p_bar')} AS p_bar, {r6('sigma_z')} AS sigma_z, baseline_n FROM ({laney('c_prebase', 'line_id, panel, week, lane')})"
_BODY["spc12_laney_current"] = f"SELECT {K}, panel, CAST(lane_no AS INTEGER) AS lane_no, {r6('n')} AS n, d, {r6('rate')} AS rate, {r6('ucl')} AS ucl, {r6('lcl')} AS lcl, ooc FROM c_shpan"
_BODY["spc13_laney_series"] = f"""SELECT {K}, panel, CAST(lane_no AS INTEGER) AS lane_no, {r6('rate')} AS rate, {r6('ucl')} AS ucl, {r6('lcl')} AS lcl, ooc, {r6('p_bar')} AS p_bar,
 bool_or(ooc) OVER (PARTITION BY line_id, panel, week, lane) AS any_out_of_control FROM c_series"""
_BODY["spc14_shift_axis"] = f"SELECT {K}, panel, CAST(lane_no AS INTEGER) AS lane_no, {r6('n')} AS n, d FROM c_series"
_BODY["spc15_ewma"] = f"SELECT line_id, panel, CAST(week AS INTEGER) AS week, CAST(lane_no AS INTEGER) AS lane_no, batch_idx, {tstext('stamp_us')} AS stamp, {r6('rate')} AS rate, {r6('ewma')} AS ewma, ucl, lcl FROM c_wewma"
q.cte("c_idle", f"""SELECT *, {rnd(f'({ends("ord")} - last_us) / {HOUR}', 1)} AS gap_hours FROM (
 SELECT p.line_id, x.panel, p.ord, (SELECT max(stamp_us) FROM c_subno s WHERE s.line_id = p.line_id AND s.panel = x.panel AND s.stamp_us <= {ends('p.ord')}) AS last_us
 FROM c_prod p JOIN c_panels x USING (line_id) ANTI JOIN (SELECT DISTINCT line_id, panel, ord FROM c_inshift) b ON b.line_id = p.line_id AND b.panel = x.panel AND b.ord = p.ord) WHERE last_us IS NOT NULL""")
_BODY["spc16_shift_panel"] = f"SELECT panel, {K}, 'no_shift_data' AS status, {tstext('last_us')} AS last_reset, gap_hours FROM c_idle"
_BODY["spc16_shift_ewma"] = f"SELECT {K}, panel, CAST(lane_no AS INTEGER) AS lane_no, batch_idx, {r6('ewma')} AS ewma, ucl, lcl FROM c_sewma"
q.cte("c_rawbase", f"""SELECT line_id, panel, ord, lane, no AS pos, n, d FROM (
 SELECT p.line_id, s.panel, p.ord, s.lane, s.no, s.n_inspected AS n, s.rejects AS d, row_number() OVER (PARTITION BY p.line_id, s.panel, p.ord, s.lane ORDER BY s.no DESC) AS back,
 count(*) OVER (PARTITION BY p.line_id, s.panel, p.ord, s.lane) AS k, (SELECT count(*) FROM c_subno z WHERE z.line_id = p.line_id AND z.panel = s.panel AND z.stamp_us <= {ends('p.ord')}) AS seen
 FROM c_prod p JOIN c_subs s ON s.line_id = p.line_id AND s.stamp_us < {starts('p.ord')}) WHERE back <= 100 AND k >= 2 AND seen >= 10""")
q.cte("c_raw", limited(f"""SELECT line_id, panel, ord, lane, lane_no, n, d, p_bar, sigma_z FROM (
 SELECT line_id, panel, ord, lane, lane_no, CAST(sum(peak) AS BIGINT) / any_value(divisor) AS n, CAST(sum(rejects) AS BIGINT) AS d FROM c_inshift SEMI JOIN c_active_shift USING (line_id, panel, lane, lane_no) GROUP BY ALL)
 JOIN ({laney('c_rawbase', 'line_id, panel, ord, lane')}) USING (line_id, panel, ord, lane)"""))
q.cte("c_ownbase", """SELECT line_id, panel, ord, lane, pos, n, d FROM (
 SELECT b.line_id, b.panel, p.ord, b.lane, b.first_us AS pos, b.n, b.d, row_number() OVER (PARTITION BY b.line_id, b.panel, p.ord, b.lane ORDER BY b.first_us DESC) AS back
 FROM c_bbuckets b JOIN c_prod p ON p.line_id = b.line_id AND b.ord < p.ord) WHERE back <= 100""")
q.cte("c_own", limited(f"""SELECT line_id, panel, ord, lane, lane_no, n, d, p_bar, sigma_z FROM (
 SELECT line_id, panel, ord, lane, lane_no, CAST(sum(peak) AS BIGINT) / any_value(divisor) AS n, CAST(sum(rejects) AS BIGINT) AS d FROM c_inshift SEMI JOIN c_active_shift USING (line_id, panel, lane, lane_no) GROUP BY ALL)
 JOIN (SELECT * FROM ({laney('c_ownbase', 'line_id, panel, ord, lane')}) WHERE baseline_n >= 2) USING (line_id, panel, ord, lane)"""))
_BODY["spc16_own_cutoff"] = f"SELECT {K}, panel, CAST(lane_no AS INTEGER) AS lane_no, {r6('n')} AS n, d, {r6('p_bar')} AS p_bar, {r6('sigma_z')} AS sigma_z, {r6('ucl')} AS ucl, ooc FROM c_own"
_BODY["spc17_raw_subgroup_panel"] = f"SELECT {K}, panel, CAST(lane_no AS INTEGER) AS lane_no, {r6('n')} AS n, d, {r6('p_bar')} AS p_bar, {r6('sigma_z')} AS sigma_z, {r6('ucl')} AS ucl, ooc FROM c_raw"
q.cte("c_cuts", f"SELECT line_id, {ends('ord')} AS cut FROM c_spine UNION ALL SELECT line_id, reached_us + {2 * DAY} FROM c_latest")
q.cte("c_last", f"""SELECT *, {rnd(f'(cut - last_us) / {HOUR}', 1)} AS gap_hours, CASE WHEN (cut - last_us) / {HOUR} > 12 THEN 'no_shift_data' END AS status FROM (
 SELECT c.line_id, s.panel, c.cut, max(s.no) AS last_no, max(s.stamp_us) AS last_us FROM c_cuts c JOIN c_subno s ON s.line_id = c.line_id AND s.stamp_us <= c.cut GROUP BY ALL HAVING count(*) >= 10)""")
q.cte("c_lastbase", """SELECT l.line_id, l.panel, l.cut, s.lane, s.no AS pos, s.n_inspected AS n, s.rejects AS d FROM c_last l JOIN c_subs s ON s.line_id = l.line_id AND s.panel = l.panel
 AND s.no BETWEEN l.last_no - 100 AND l.last_no - 1 WHERE status IS NULL""")
q.cte("c_lastpan", limited(f"""SELECT * FROM (SELECT l.line_id, l.panel, l.cut, s.lane, s.lane_no, s.n_inspected AS n, s.rejects AS d FROM c_last l JOIN c_subs s ON s.line_id = l.line_id AND s.panel = l.panel AND s.no = l.last_no
 SEMI JOIN c_active_shift a ON a.line_id = s.line_id AND a.panel = s.panel AND a.lane = s.lane WHERE status IS NULL) JOIN ({laney('c_lastbase', 'line_id, panel, cut, lane')}) USING (line_id, panel, cut, lane)"""))
q.cte("c_lastewma", q.ewma("SELECT line_id, panel, cut, cut AS end_us, CAST(-1 AS BIGINT) AS base_us FROM c_last WHERE status IS NULL", "cut", "c_active_shift"))
_CUT = f"{tstext('cut')} AS cutoff"
_BODY["spc17_last_batch"] = f"SELECT line_id, panel, {_CUT}, {tstext('last_us')} AS last_reset, gap_hours, status FROM c_last"
_BODY["spc17_last_batch_panel"] = f"""SELECT line_id, panel, {_CUT}, CAST(lane_no AS INTEGER) AS lane_no, {r6('n')} AS n, d, {r6('rate')} AS rate, {r6('ucl')} AS ucl, {r6('lcl')} AS lcl, ooc, {r6('p_bar')} AS p_bar, {r6('sigma_z')} AS sigma_z, baseline_n FROM c_lastpan"""
_BODY["spc17_last_batch_ewma"] = f"SELECT line_id, panel, {_CUT}, CAST(lane_no AS INTEGER) AS lane_no, batch_idx, {r6('ewma')} AS ewma, ucl, lcl FROM c_lastewma"
_BODY["spc18_weekly_panel"] = "SELECT line_id, panel, CAST(week AS INTEGER) AS week, any_value(shift_subgroups) AS shift_subgroups, count(DISTINCT ord) AS total_shifts, count(DISTINCT lane) AS lanes, count(*) FILTER (ooc) AS ooc_points FROM c_series GROUP BY 1, 2, 3"
_BODY["spc19_chart_lines"] = f"""SELECT line_id, panel, week, lane_no, {r6('mean_ucl_pct')} AS mean_ucl_pct, {r6('p_bar_pct')} AS p_bar_pct, {r6('avg(p_bar_pct) OVER (PARTITION BY line_id, panel, week)')} AS panel_p_bar FROM (
 SELECT line_id, panel, CAST(week AS INTEGER) AS week, CAST(lane_no AS INTEGER) AS lane_no, avg({rnd('ucl * 100', 3)}) AS mean_ucl_pct, any_value({rnd('p_bar * 100', 3)}) AS p_bar_pct FROM c_series GROUP BY 1, 2, 3, 4)"""
_BODY["spc19_ewma_breaches"] = f"""SELECT line_id, panel, CAST(week AS INTEGER) AS week, CAST(lane_no AS INTEGER) AS lane_no, batch_idx, batch_label, ewma, ucl FROM (SELECT *, {_BATCH.format(t=ts('stamp_us'))} AS batch_label FROM c_wewma)
 SEMI JOIN (SELECT line_id, week, {olabel('ord')} AS batch_label FROM c_prod) USING (line_id, week, batch_label) WHERE ewma > ucl"""
_BODY["spc21_attached_panels"] = "SELECT shift_key, coalesce((SELECT string_agg(panel, ',' ORDER BY panel) FROM (SELECT DISTINCT panel FROM c_shpan p WHERE p.line_id = e.line_id AND p.ord = e.ord)), '') AS panels FROM c_entries e"
_BODY["spc22_flagged_lanes"] = f"""SELECT {K}, panel, coalesce(string_agg(CAST(lane_no AS VARCHAR), ', ' ORDER BY lane_no) FILTER (ooc), '') AS flagged, {r6(f"avg({rnd('p_bar * 100', 2)})")} AS avg_p_bar,
 any_value(baseline_n) AS baseline_subgroups FROM c_shpan GROUP BY line_id, ord, panel"""
_BODY["spc22_reset_age"] = f"""SELECT panel, {K}, gap_hours, CASE WHEN floor(gap_hours / 24) > 0 THEN CAST(CAST(floor(gap_hours / 24) AS BIGINT) AS VARCHAR) || 'd ' ELSE '' END ||
 CAST(CAST(floor(gap_hours % 24) AS BIGINT) AS VARCHAR) || 'h' AS age FROM c_idle"""

_BODY["sch1_daily_run_hours"] = f"SELECT line_id, {DTEXT}, {dbl('run_hours')} AS run_hours FROM c_dayrun"
_BODY["sch2_daily_output"] = f"SELECT line_id, {DTEXT}, parts_produced, first_us, last_us, n_samples, {dbl('coverage_hours')} AS coverage_hours FROM c_dayout"
_BODY["sch3_day_classes"] = f"SELECT line_id, {DTEXT}, classification, effective_hours FROM c_sched"
_BODY["sch4_schedule_summary"] = f"""SELECT line_id, total_days, full_days, partial_days, non_production_days, effective_hours, total_days * 24.0::DOUBLE AS calendar_hours,
 {rnd('total_days * 24.0::DOUBLE - effective_hours', 2)} AS excluded_hours, {rnd('(1 - effective_hours / (total_days * 24.0::DOUBLE)) * 100', 1)} AS exclusion_pct FROM (
 SELECT line_id, count(*) AS total_days, count(*) FILTER (classification = 'full') AS full_days, count(*) FILTER (classification = 'partial') AS partial_days,
 count(*) FILTER (classification = 'non_production') AS non_production_days, CAST(sum(CAST(round(effective_hours * 100) AS BIGINT)) AS DOUBLE) / 100 AS effective_hours FROM c_sched GROUP BY 1)"""

# -- star tables (also the base of the measures) --------------------------------

q.cte("c_t_shifts", f"""SELECT shift_key AS "ShiftKey", line_id AS "LineId", line AS "Line", shift_date AS "ShiftDate", shift_type AS "ShiftType", label AS "Label", line_id || '|' || label AS "LineShiftLabel",
 {isoweek(odate('ord'))} AS "IsoWeek", {weeklabel(odate('ord'))} AS "WeekLabel", oee AS "OEE", availability AS "Availability", performance AS "Performance", quality AS "Quality", running_hours AS "RunningHours",
 12 AS "ScheduledHours", total_stops AS "TotalStops", total_downtime_hours AS "TotalDowntimeHours", longest_stop_min AS "LongestStopMin", good_count AS "GoodCount", total_count AS "TotalCount",
 CAST(shift_key = max(shift_key) OVER (PARTITION BY line_id) AS INTEGER) AS "IsLatest" FROM c_pentries JOIN c_lines USING (line_id)""")
_SK = f"""{okey('ord')} AS "ShiftKey", line_id AS "LineId" """
q.cte("c_t_cats", f"""SELECT {_SK}, category AS "Category", category_label AS "CategoryLabel", count AS "Count", {rnd('hours', 2)} AS "Hours" FROM c_cats""")
q.cte("c_t_segs", f"""SELECT {_SK}, segment AS "Segment", segment_label AS "SegmentLabel", count AS "Count", hours AS "Hours", halted_hours AS "HaltedHours", stopped_hours AS "StoppedHours", segment_color AS "SegmentColor" FROM c_seg""")
q.cte("c_t_clus", f"""SELECT {_SK}, segment AS "Segment", cluster AS "Cluster", count AS "Count", hours AS "Hours", halted_hours AS "HaltedHours", stopped_hours AS "StoppedHours" FROM (
 SELECT line_id, ord, segment, cluster, count, hours, halted_hours, stopped_hours FROM c_clu UNION ALL
 SELECT line_id, ord, segment, segment_label, count, hours, halted_hours, stopped_hours FROM c_seg ANTI JOIN c_clu USING (line_id, ord, segment) WHERE hours > 0)""")
q.cte("c_t_top", f"""SELECT {_SK}, segment AS "Segment", cluster AS "Cluster", label AS "Label", count AS "Count", hours AS "Hours" FROM c_top SEMI JOIN c_prod USING (line_id, ord)""")
q.cte("c_t_hour", f"""SELECT {_SK}, hour_label AS "HourLabel", segment AS "Segment", coalesce(segment_label, 'Running') AS "SegmentLabel", {rnd(f'us / {MINUTE}', 1)} AS "Minutes", coalesce(segment_color, '#c7c0e8') AS "SegmentColor" FROM (
 SELECT line_id, ord, hour_idx, hour_label, segment, CAST(sum(us) AS BIGINT) AS us FROM c_hours SEMI JOIN c_prod USING (line_id, ord) GROUP BY ALL) LEFT JOIN c_segments USING (line_id, segment)""")
q.cte("c_t_hclu", f"""SELECT {_SK}, hour_label AS "HourLabel", CAST(hour_idx AS INTEGER) AS "HourIdx", segment AS "Segment", cluster AS "Cluster", {rnd(f'us / {MINUTE}', 1)} AS "Minutes" FROM (
 SELECT line_id, ord, hour_idx, hour_label, segment, coalesce(cluster, segment_label) AS cluster, CAST(sum(us) AS BIGINT) AS us
 FROM (SELECT *, CAST(sum(us) OVER (PARTITION BY line_id, ord, hour_idx, segment) AS BIGINT) AS whole FROM c_hours) SEMI JOIN c_prod USING (line_id, ord)
 JOIN c_segments USING (line_id, segment) WHERE {rnd(f'whole / {MINUTE}', 1)} > 0 GROUP BY ALL)""")
q.cte("c_t_trend", """SELECT anchor_shift_key AS "AnchorShiftKey", line_id AS "LineId", line AS "Line", trend_rank AS "TrendRank", trend_shift_key AS "TrendShiftKey", trend_shift_label AS "TrendShiftLabel", trend_shift_date AS "TrendShiftDate",
 category AS "Category", category_label AS "CategoryLabel", hours AS "Hours", category_color AS "CategoryColor" FROM c_trend JOIN c_lines USING (line_id)""")
q.cte("c_t_anom", f"""SELECT {_SK}, {olabel('ord')} AS "ShiftLabel", segment AS "Segment", cluster AS "Cluster", current_share AS "CurrentShare", baseline_mean AS "BaselineMean", z_score AS "ZScore", direction AS "Direction",
 headline AS "Headline", detail AS "Detail", headline || chr(10) || detail AS "HeadlineML", segment_color AS "SegColor", CAST(rank AS INTEGER) AS "Rank" FROM c_shrows""")
q.cte("c_t_week", """SELECT line_id AS "LineId", line AS "Line", CAST(week AS INTEGER) AS "Week", week_from AS "WeekFrom", week_to AS "WeekTo", oee AS "OEE", availability AS "Availability", performance AS "Performance", quality AS "Quality", good_count AS "GoodCount",
 total_count AS "TotalCount", total_stops AS "TotalStops", total_downtime_hours AS "TotalDowntimeHours", longest_stop_min AS "LongestStopMin", production_shifts AS "ProductionShifts", prior_oee AS "PriorOEE",
 prior_availability AS "PriorAvailability", prior_performance AS "PriorPerformance", prior_quality AS "PriorQuality" FROM c_week JOIN c_prior USING (line_id, week) JOIN c_lines USING (line_id)""")
q.cte("c_t_wanom", f"""SELECT line_id AS "LineId", line AS "Line", CAST(week AS INTEGER) AS "Week", segment AS "Segment", cluster AS "Cluster", current_share AS "CurrentShare", baseline_mean AS "BaselineMean", z_score AS "ZScore", direction AS "Direction",
 {rnd('current_share / CASE WHEN baseline_mean > 0 THEN baseline_mean ELSE 0.0001::DOUBLE END', 1)} AS "Ratio", headline AS "Headline", detail AS "Detail", headline || chr(10) || detail AS "HeadlineML", segment_color AS "SegColor",
 CAST(rank AS INTEGER) AS "Rank" FROM c_wkrows JOIN c_lines USING (line_id)""")
q.cte("c_t_spc", f"""SELECT line_id AS "LineId", line AS "Line", CAST(week AS INTEGER) AS "Week", panel_short AS "Panel", {okey('ord')} AS "ShiftKey", {olabel('ord')} AS "ShiftLabel", line_id || '|' || {olabel('ord')} AS "LineShiftLabel", CAST(lane_no AS INTEGER) AS "Lane", rejects AS "Rejects",
 rate_pct AS "RatePct", ucl_pct AS "UclPct", ooc AS "OOC", n_inspected AS "NInspected", CASE WHEN ooc = 1 THEN '#e17055' ELSE '#ffffff' END AS "OOCColor", CAST(shift_idx AS INTEGER) AS "ShiftIdx", p_bar_pct AS "PBar"
 FROM c_detail JOIN c_panels USING (line_id, panel) JOIN c_lines USING (line_id)""")
q.cte("c_t_ewma", f"""SELECT line_id AS "LineId", line AS "Line", CAST(week AS INTEGER) AS "Week", panel_short AS "Panel", batch_idx AS "BatchIdx", CAST(dense_rank() OVER (PARTITION BY line_id, panel, week ORDER BY lane_no) AS INTEGER) AS "Lane",
 {rnd(rnd('rate', 2), 3)} AS "Rate", {rnd('ewma', 3)} AS "Ewma", ucl AS "Ucl", lcl AS "Lcl" FROM c_wewma JOIN c_panels USING (line_id, panel) JOIN c_lines USING (line_id)""")
q.cte("c_t_find", """SELECT line_id AS "LineId", line AS "Line", CAST(week AS INTEGER) AS "Week", CAST(rank AS INTEGER) AS "Rank", text AS "Text" FROM c_findings JOIN c_lines USING (line_id)""")
q.cte("c_t_lines", f"""SELECT line_id AS "LineId", line AS "Line", {tstext('reached_us')} AS "GeneratedAt" FROM c_latest JOIN c_lines USING (line_id)""")
for _n, _c in (
    ("exp1_shifts", "c_t_shifts"), ("exp1_downtime_categories", "c_t_cats"), ("exp1_segment_downtime", "c_t_segs"), ("exp1_segment_clusters", "c_t_clus"), ("exp1_top_stops", "c_t_top"),
    ("exp1_hourly_breakdown", "c_t_hour"), ("exp1_hourly_clusters", "c_t_hclu"), ("exp1_anomalies", "c_t_anom"), ("exp2_weekly_summary", "c_t_week"), ("exp2_weekly_anomalies", "c_t_wanom"),
    ("exp2_spc", "c_t_spc"), ("exp2_ewma", "c_t_ewma"), ("exp2_key_findings", "c_t_find"), ("exp2_shift_trend", "c_t_trend"), ("exp4_lines", "c_t_lines"),
):
    _BODY[_n] = f"SELECT * FROM {_c}"
for _n, _c, _cols in (
    ("shifts", "c_t_shifts", ("ShiftKey", "LineId", "ShiftDate", "ShiftType", "Label", "OEE", "Availability", "Performance", "Quality", "RunningHours", "TotalStops", "TotalDowntimeHours", "LongestStopMin", "GoodCount", "TotalCount")),
    ("downtime_categories", "c_t_cats", ("ShiftKey", "Category", "Count", "Hours")),
    ("segment_downtime", "c_t_segs", ("ShiftKey", "Segment", "Count", "Hours", "HaltedHours", "StoppedHours")),
    ("segment_clusters", "c_t_clus", ("ShiftKey", "Segment", "Cluster", "Count", "Hours", "HaltedHours", "StoppedHours")),
    ("top_stops", "c_t_top", ("ShiftKey", "Segment", "Cluster", "Label", "Count", "Hours")),
    ("hourly_breakdown", "c_t_hour", ("ShiftKey", "HourLabel", "Segment", "SegmentLabel", "Minutes")),
    ("hourly_clusters", "c_t_hclu", ("ShiftKey", "HourLabel", "HourIdx", "Segment", "Cluster", "Minutes")),
    ("anomalies", "c_t_anom", ("ShiftKey", "Rank", "Segment", "Cluster", "CurrentShare", "BaselineMean", "ZScore", "Direction")),
):
    _BODY[f"exp1_flattened_{_n}"] = "SELECT " + ", ".join(f'"{c}"' for c in _cols) + f" FROM {_c}"
q.cte("c_snaps", f"SELECT line_id, {_SNAPKEY} AS snapshot_key, {ts(f'reached_us // {15 * MINUTE} * {15 * MINUTE}')} AS snapshot_time FROM c_latest")
_BODY["exp3_snapshots"] = """SELECT snapshot_key AS "SnapshotKey", strftime(snapshot_time, '%Y-%m-%d %H:%M:%S') AS "SnapshotTime", strftime(snapshot_time, '%b %-d, %-I:%M %p') AS "SnapshotLabel",
 CAST(snapshot_key = (SELECT max(snapshot_key) FROM c_snaps) AS INTEGER) AS "IsLatestSnapshot" FROM (SELECT DISTINCT snapshot_key, snapshot_time FROM c_snaps)"""
_BODY["exp3_snapshot_shifts"] = f"""SELECT snapshot_key || '|' || {okey('ord')} AS "ShiftKey", snapshot_key AS "SnapshotKey", line_id AS "LineId", line AS "Line", {otext('ord')} AS "ShiftDate", {otype('ord')} AS "ShiftType", {olabel('ord')} AS "Label",
 line_id || '|' || {olabel('ord')} AS "LineShiftLabel", {isoweek(odate('ord'))} AS "IsoWeek", {weeklabel(odate('ord'))} AS "WeekLabel", CAST(ord = latest_ord AS INTEGER) AS "IsLatest"
 FROM c_prod JOIN c_snaps USING (line_id) JOIN c_lines USING (line_id) WHERE week = 0"""
_BODY["exp3_snapshot_spc"] = f"""SELECT snapshot_key AS "SnapshotKey", line_id AS "LineId", line AS "Line", panel_short AS "Panel", {olabel('ord')} AS "ShiftLabel", line_id || '|' || {olabel('ord')} AS "LineShiftLabel", CAST(lane_no AS INTEGER) AS "Lane",
 rejects AS "Rejects", rate_pct AS "RatePct", ucl_pct AS "UclPct", ooc AS "OOC", n_inspected AS "NInspected", CAST(shift_idx AS INTEGER) AS "ShiftIdx", p_bar_pct AS "PBar", CAST(ord = latest_ord AS INTEGER) AS "IsLatest"
 FROM c_detail JOIN c_snaps USING (line_id) JOIN c_panels USING (line_id, panel) JOIN c_lines USING (line_id) JOIN c_latest USING (line_id) WHERE week = 0"""
_BODY["exp5_slice"] = """SELECT "ShiftKey", "LineId", "OEE", "IsLatest" FROM c_t_shifts WHERE "LineId" = 'line_b'"""

# -- measures ---------------------------------------------------------------------


def _sum(col: str, scale: int) -> str:
    return f'CAST(sum(CAST(round("{col}" * {scale}) AS BIGINT)) AS DOUBLE) / {scale}'


_AV = f'({_sum("RunningHours", 100)} / nullif(sum("ScheduledHours"), 0) * 100)'
_QU = '(CAST(sum("GoodCount") AS DOUBLE) / nullif(sum("TotalCount"), 0) * 100)'
_PE = '(CAST(sum(CAST(round("Performance" * 10) AS BIGINT) * CAST(round("RunningHours" * 100) AS BIGINT)) AS DOUBLE) / nullif(sum(CAST(round("RunningHours" * 100) AS BIGINT)), 0) / 10)'


def _mea(table: str, by: list[str], **cols: str) -> str:
    keys = ", ".join(f'"{b}"' for b in by)
    return f"SELECT {keys}, " + ", ".join(f"{v} AS {k}" for k, v in cols.items()) + f" FROM {table} GROUP BY {keys}"


def _m6(*names: tuple[str, str, int]) -> dict[str, str]:
    return {alias: r6(_sum(col, scale)) for alias, col, scale in names}


_BODY["mea1_ratio_measures"] = _mea("c_t_shifts", ["LineId", "IsoWeek"], availability_pct=r6(_AV), quality_pct=r6(_QU))
_BODY["mea2_weighted_performance"] = _mea("c_t_shifts", ["LineId", "IsoWeek"], performance_pct=r6(_PE))
_BODY["mea3_oee"] = _mea("c_t_shifts", ["LineId", "ShiftType"], oee_pct=r6(f"{_AV} * {_PE} * {_QU} / 10000"))
_BODY["mea4_shift_sums"] = _mea("c_t_shifts", ["LineId", "ShiftDate"], total_downtime_h=r6(_sum("TotalDowntimeHours", 100)), total_stops=big('sum("TotalStops")'), good_count=big('sum("GoodCount")'),
                                total_count=big('sum("TotalCount")'), longest_stop_min='max("LongestStopMin")')
_BODY["mea5_shift_count"] = _mea("c_t_shifts", ["LineId", "IsoWeek"], shift_count='count(DISTINCT "ShiftKey")')
_BODY["mea6_categories"] = _mea("c_t_cats", ["LineId", "CategoryLabel"], **_m6(("category_downtime_h", "Hours", 100)))
_BODY["mea6_segments"] = _mea("c_t_segs", ["LineId", "SegmentLabel"], **_m6(("segment_downtime_h", "Hours", 100)))
_BODY["mea6_clusters"] = _mea("c_t_clus", ["LineId", "Segment", "Cluster"], **_m6(("cluster_downtime_h", "Hours", 100), ("cluster_halted_h", "HaltedHours", 100), ("cluster_stopped_h", "StoppedHours", 100)))
_BODY["mea6_hourly"] = _mea("c_t_hour", ["LineId", "HourLabel", "SegmentLabel"], **_m6(("total_minutes", "Minutes", 10)))
_BODY["mea6_hourly_clusters"] = _mea("c_t_hclu", ["LineId", "HourLabel", "Segment", "Cluster"], **_m6(("hourly_cluster_minutes", "Minutes", 10)))
_BODY["mea6_trend"] = _mea("c_t_trend", ["AnchorShiftKey", "TrendRank"], **_m6(("trend_hours", "Hours", 100)))
_BODY["mea6_top_stops"] = _mea("c_t_top", ["LineId", "Label"], stop_hours=r6(_sum("Hours", 100)), stop_count=big('sum("Count")'))
_BODY["mea7_anomalies"] = _mea("c_t_anom", ["LineId", "Segment"], anomaly_count="count(*)", max_z_score='max("ZScore")', current_share_pct='max("CurrentShare")', baseline_share_pct='max("BaselineMean")')
_BODY["mea7_weekly_anomalies"] = _mea("c_t_wanom", ["LineId", "Segment"], wk_current_pct='max("CurrentShare")', wk_baseline_pct='max("BaselineMean")', wk_z='max("ZScore")', wk_ratio='max("Ratio")')
_BODY["mea8_spc"] = _mea("c_t_spc", ["LineId", "Panel", "Lane"], reject_rate_pct=r6(_sum("RatePct", 1000)), max_reject_rate_pct='max("RatePct")', ucl_pct='max("UclPct")', total_rejects=big('sum("Rejects")'), out_of_control='max("OOC")')
_BODY["mea8_ewma"] = _mea("c_t_ewma", ["LineId", "Panel", "Lane"], ewma_value=r6('avg("Ewma")'), ewma_rate_pct=r6('avg("Rate")'), ewma_ucl='max("Ucl")', ewma_lcl='min("Lcl")')
_W = {f"weekly_{n.lower()}_pct": r6(f'avg("{n}")') for n in ("OEE", "Availability", "Performance", "Quality")}
_W |= {f"{n.lower()}_dpp": r6(f'avg("{n}") - avg("Prior{n}")') for n in ("OEE", "Availability", "Performance", "Quality")}
_BODY["mea9_weekly"] = _mea("c_t_week", ["LineId"], **_W, wk_total_stops=big('sum("TotalStops")'), wk_downtime_h=r6(_sum("TotalDowntimeHours", 100)), wk_longest_stop_min='max("LongestStopMin")')
_BODY["mea10_last_refreshed"] = _mea("c_t_lines", ["LineId"], last_refreshed="'Last refreshed ' || max(\"GeneratedAt\")")
_BODY["mea11_lane_matrix"] = """SELECT "LineId", "ShiftLabel", """ + ", ".join(
    f'{big(f"""sum("Rejects") FILTER ("Lane" = {i})""")} AS "{i}_rejects", {r6(f"""CAST(sum(CAST(round("RatePct" * 1000) AS BIGINT)) FILTER ("Lane" = {i}) AS DOUBLE) / 1000""")} AS "{i}_rate_pct"' for i in range(1, 6)
) + """ FROM c_t_spc WHERE "Panel" = 'Vision' GROUP BY 1, 2"""
_BODY["mea12_segment_regroup"] = """SELECT "LineId", t."Segment", CAST(seg_order AS INTEGER) AS seg_order, "Cluster", hours, CAST(row_number() OVER (PARTITION BY "LineId", t."Segment" ORDER BY hours DESC, "Cluster") AS INTEGER) AS position,
 max(hours) OVER (PARTITION BY "LineId", t."Segment") AS max_hours FROM (SELECT "LineId", "Segment", "Cluster", CAST(sum(CAST(round("Hours" * 100) AS BIGINT)) AS DOUBLE) / 100 AS hours FROM c_t_clus WHERE "Hours" > 0 GROUP BY 1, 2, 3)
 t JOIN c_segments g ON g.line_id = t."LineId" AND g.segment = t."Segment" """
_BODY["s1_stream_append"] = "SELECT line_id, strftime(t_stamp, '%Y-%m-%d') AS day, count(*) AS samples FROM c_ppm GROUP BY 1, 2"

# -- documents: a subject is computed even on an excluded day, so the steps run over the whole spine ----

q.cte("c_all", "SELECT line_id, ord, week, latest_ord FROM c_spine")


def _over_all(**steps: str) -> None:
    """Copies of steps over every shift; ``new="old"``, in the order of their dependence."""
    renamed = {"c_prod": "c_all"}
    for new, old in steps.items():
        sql = q.CTES[old]
        for a, b in renamed.items():
            sql = re.sub(rf"\b{a}\b", b, sql)
        q.cte(new, sql)
        renamed[old] = new


_over_all(c_xcats="c_cats", c_xseg="c_seg", c_xclu="c_clu", c_xparts="c_parts", c_xoee="c_poee", c_xentries="c_pentries", c_xshout="c_shout", c_xshpan="c_shpan", c_xidle="c_idle", c_xsewma="c_sewma",
          c_xt_top="c_t_top", c_xt_hour="c_t_hour", c_xt_hclu="c_t_hclu", c_xt_clus="c_t_clus")
_FULL = f"""CASE WHEN ord % 2 = 1 THEN 'Night' ELSE 'Day' END || ' Shift — ' || {otext('ord')} || CASE WHEN ord % 2 = 1 THEN ' (19:00 – 07:00)' ELSE ' (07:00 – 19:00)' END"""
_BODY["oee10_shift_document"] = f"""SELECT {K}, {_FULL} AS label, {tstext(starts('ord'))} AS starts, {tstext(ends('ord'))} AS ends, {tstext(ends('ord'))} AS generated_at, skipped AS day_excluded,
 {rnd('ideal_ppm', 1)} AS p95_ideal_ppm, CAST((SELECT count(*) FROM c_spine s WHERE s.line_id = e.line_id AND s.ord BETWEEN e.ord - 4 AND e.ord) AS INTEGER) AS n_shifts,
 CAST((SELECT count(*) FROM c_spine s WHERE s.line_id = e.line_id AND s.ord BETWEEN e.ord - 4 AND e.ord - 1 AND s.skipped) AS INTEGER) AS n_skipped,
 (SELECT count(*) FROM c_members m WHERE m.line_id = e.line_id AND m.week = e.week) AS baseline_shifts,
 CAST((SELECT count(*) FROM c_xseg g WHERE g.line_id = e.line_id AND g.ord = e.ord) AS INTEGER) AS n_segments,
 CAST((SELECT count(DISTINCT hour_idx) FROM c_hours h WHERE h.line_id = e.line_id AND h.ord = e.ord) AS INTEGER) AS n_hours,
 CAST((SELECT count(*) FROM c_xshout o WHERE o.line_id = e.line_id AND o.ord = e.ord) AS INTEGER) AS n_outliers FROM c_spine e LEFT JOIN c_pideal USING (line_id, week)"""
_ENTRY = ("oee", "availability", "performance", "quality", "running_hours", "total_stops", "total_downtime_hours", "longest_stop_min", "good_count", "total_count")
_BODY["oee10_document_rows"] = f"""SELECT {okey('a.ord', 'a.line_id')} AS shift_key, CAST(a.ord - s.ord AS INTEGER) AS position, {olabel('s.ord')} AS label, s.skipped AND s.ord < a.ord AS skipped,
 {', '.join(f"CASE WHEN NOT (s.skipped AND s.ord < a.ord) THEN x.{c} END AS {c}" for c in _ENTRY)} FROM c_spine a JOIN c_spine s ON s.line_id = a.line_id AND s.ord BETWEEN a.ord - 4 AND a.ord
 JOIN c_xentries x ON x.line_id = s.line_id AND x.ord = s.ord"""
_BODY["oee10_excluded_subject"] = f"""SELECT x.* FROM (
 SELECT {okey('ord')} AS "ShiftKey", 'oee' AS part, NULL AS a, NULL AS b, NULL AS c, {dbl('oee')} AS value FROM c_xentries UNION ALL
 SELECT {okey('ord')}, 'category', category, NULL, CAST(count AS VARCHAR), {rnd('hours', 2)} FROM c_xcats UNION ALL SELECT {okey('ord')}, 'segment', segment, NULL, CAST(count AS VARCHAR), hours FROM c_xseg UNION ALL
 SELECT "ShiftKey", 'cluster', "Segment", "Cluster", CAST("Count" AS VARCHAR), "Hours" FROM c_xt_clus UNION ALL SELECT "ShiftKey", 'stop', "Segment", "Cluster", "Label", "Hours" FROM c_xt_top UNION ALL
 SELECT "ShiftKey", 'hour', "HourLabel", "Segment", NULL, "Minutes" FROM c_xt_hour UNION ALL SELECT "ShiftKey", 'hour_cluster', "HourLabel", "Segment", "Cluster", "Minutes" FROM c_xt_hclu UNION ALL
 SELECT {okey('ord')}, 'outlier', segment, cluster, direction, z_score FROM c_xshout) x JOIN (SELECT {okey('ord')} AS k FROM c_spine WHERE skipped) ON k = "ShiftKey" """
_BODY["oee10_panels"] = f"""SELECT {K}, panel, NULL AS status, CAST(count(*) AS INTEGER) AS n_lanes, any_value(baseline_n) AS baseline_subgroups, 100 AS baseline_subgroups_requested, {tstext('max(last_us)')} AS last_reset_timestamp,
 CAST(NULL AS DOUBLE) AS gap_hours FROM c_xshpan GROUP BY line_id, ord, panel UNION ALL SELECT {K}, panel, 'no_shift_data', 0, 0, 100, {tstext('last_us')}, gap_hours FROM c_xidle"""
_BODY["oee10_panel_lanes"] = f"""SELECT {K}, panel, CAST(lane_no AS INTEGER) AS lane_no, d AS rejects, CAST(round_even(n, 0) AS BIGINT) AS inspected, {rnd('rate * 100', 2)} AS rate_pct, {rnd('p_bar * 100', 2)} AS p_bar_pct,
 {rnd('ucl * 100', 2)} AS ucl_pct, {rnd('lcl * 100', 2)} AS lcl_pct, ooc AS out_of_control FROM c_xshpan"""
_BODY["oee10_panel_ewma"] = f"SELECT {K}, panel, batch_idx, {tstext('stamp_us')} AS t_stamp, CAST(lane_no AS INTEGER) AS lane_no, {rnd('rate', 2)} AS rate, ewma, ucl, lcl FROM c_xsewma"
_PRIOR = ", ".join(f"prior_{c}" for c in ("from", "to", "oee", "availability", "performance", "quality"))
_BODY["oee11_week_document"] = f"""SELECT line_id, CAST(week AS INTEGER) AS week, week_from, week_to, oee, availability, performance, quality, good_count, total_count, total_stops, total_downtime_hours, longest_stop_min,
 production_shifts, excluded_shifts, {_PRIOR}, (SELECT count(DISTINCT p.week) FROM c_pprof p WHERE p.line_id = w.line_id AND p.week BETWEEN w.week + 1 AND w.week + 4) AS baseline_weeks FROM c_week w JOIN c_prior USING (line_id, week)"""
q.cte("c_wpos", "SELECT *, CAST(row_number() OVER (PARTITION BY line_id, week ORDER BY ord DESC) - 1 AS INTEGER) AS position FROM c_spine")
_BODY["oee11_week_shifts"] = f"""SELECT s.line_id, CAST(s.week AS INTEGER) AS week, position, {olabel('s.ord')} AS label, skipped, {', '.join(f'e.{c}' for c in _ENTRY)},
 CASE WHEN NOT skipped THEN (SELECT count(*) FROM c_members m WHERE m.line_id = s.line_id AND m.week = s.week) END AS baseline_shifts FROM c_wpos s LEFT JOIN c_entries e USING (line_id, ord)"""
for _n, _of in (("categories", "dt8_week_categories"), ("segments", "dt7_week_segments"), ("clusters", "dt7_week_clusters"), ("top_stops", "dt6_week_top_stops")):
    _BODY[f"oee11_week_{_n}"] = _BODY[_of]
_AT = "SELECT p.line_id, CAST(p.week AS INTEGER) AS week, position"
_BODY["oee11_shift_categories"] = f"{_AT}, category, count, {rnd('hours', 2)} AS hours FROM c_cats c JOIN c_wpos p USING (line_id, ord)"
_BODY["oee11_shift_segments"] = f"{_AT}, segment, count, hours, halted_hours, stopped_hours FROM c_seg c JOIN c_wpos p USING (line_id, ord)"
_BODY["oee11_shift_clusters"] = f"{_AT}, segment, cluster, count, hours, halted_hours, stopped_hours FROM c_clu c JOIN c_wpos p USING (line_id, ord)"
_BODY["oee11_week_outliers"] = f"SELECT line_id, CAST(week AS INTEGER) AS week, {_OUT} FROM c_wkout"
_BODY["oee11_shift_outliers"] = f"{_AT}, {_OUT} FROM c_shout o JOIN c_wpos p USING (line_id, ord)"
_PTS = f"""panel, CAST(lane_no AS INTEGER) AS lane_no, {rnd('p_bar * 100', 3)} AS p_bar_pct, bool_or(ooc) OVER (PARTITION BY line_id, panel, week, lane) AS any_out_of_control,
 CAST(dense_rank() OVER (PARTITION BY line_id, panel, week ORDER BY ord) - 1 AS INTEGER) AS position, {olabel('ord')} AS label, {rnd('rate * 100', 3)} AS rate_pct, {rnd('ucl * 100', 3)} AS ucl_pct, {rnd('lcl * 100', 3)} AS lcl_pct, ooc AS out_of_control"""
_BODY["oee11_spc_points"] = f"SELECT line_id, CAST(week AS INTEGER) AS week, {_PTS} FROM c_series"
_BAT = f"panel, batch_idx, {tstext('stamp_us')} AS t_stamp, {_BATCH.format(t=ts('stamp_us'))} AS batch_label, CAST(lane_no AS INTEGER) AS lane_no, {rnd('rate', 2)} AS rate, ewma, ucl, lcl"
_BODY["oee11_spc_ewma"] = f"SELECT line_id, CAST(week AS INTEGER) AS week, {_BAT} FROM c_wewma"
_BODY["oee11_spc_table"] = f"SELECT line_id, CAST(week AS INTEGER) AS week, panel, {olabel('ord')} AS label, CAST(lane_no AS INTEGER) AS lane_no, rejects, rate_pct, ucl_pct, ooc, n_inspected, CAST(shift_idx AS INTEGER) AS shift_idx, p_bar_pct FROM c_detail"
_BODY["spc20_spc_only"] = f"""SELECT line_id, snapshot_key, 'weekly-dashboard-spc' AS analysis_id, {tstext('reached_us')} AS generated_at, {otext('ord')} AS shift_date, {otype('ord')} AS shift_type, {olabel('ord')} AS label,
 line_id || '|' || {olabel('ord')} AS line_shift_label, {isoweek(odate('ord'))} AS iso_week, {weeklabel(odate('ord'))} AS week_label, ord = s.latest_ord AS is_latest, skipped,
 CAST((SELECT count(*) FROM c_prod p WHERE p.line_id = s.line_id AND p.week = 0) AS INTEGER) AS n_shifts,
 CAST((SELECT count(*) FROM c_detail d WHERE d.line_id = s.line_id AND d.week = 0) AS INTEGER) AS n_rows
 FROM c_spine s JOIN c_latest l USING (line_id) JOIN c_snaps USING (line_id) WHERE week = 0"""
_BODY["spc20_points"] = f"SELECT line_id, snapshot_key, {_PTS} FROM c_series JOIN c_snaps USING (line_id) WHERE week = 0"
_BODY["spc20_ewma"] = f"SELECT line_id, snapshot_key, {_BAT} FROM c_wewma JOIN c_snaps USING (line_id) WHERE week = 0"

q.cte("c_t_date", """SELECT DISTINCT shift_date AS "Date" FROM c_pentries""")
_STAR = {
    "Shifts": "c_t_shifts", "DowntimeCategories": "c_t_cats", "SegmentDowntime": "c_t_segs", "SegmentClusters": "c_t_clus", "TopStops": "c_t_top", "HourlyBreakdown": "c_t_hour",
    "HourlyClusters": "c_t_hclu", "ShiftTrend": "c_t_trend", "Anomalies": "c_t_anom", "WeeklySummary": "c_t_week", "WeeklyAnomalies": "c_t_wanom", "SPC": "c_t_spc", "EWMA": "c_t_ewma",
    "KeyFindings": "c_t_find", "Lines": "c_t_lines", "DimDate": "c_t_date",
}
_RELATIONS = (
    "Shifts.LineId > Lines.LineId", "WeeklySummary.LineId > Lines.LineId", "Shifts.ShiftDate > DimDate.Date", "SegmentDowntime.ShiftKey > Shifts.ShiftKey", "SegmentClusters.ShiftKey > Shifts.ShiftKey",
    "DowntimeCategories.ShiftKey > Shifts.ShiftKey", "TopStops.ShiftKey > Shifts.ShiftKey", "HourlyBreakdown.ShiftKey > Shifts.ShiftKey", "HourlyClusters.ShiftKey > Shifts.ShiftKey",
    "Anomalies.ShiftKey > Shifts.ShiftKey", "WeeklyAnomalies.LineId > Lines.LineId", "KeyFindings.LineId > Lines.LineId", "EWMA.LineId > Lines.LineId", "SPC.ShiftKey > Shifts.ShiftKey",
    "ShiftTrend.AnchorShiftKey > Shifts.ShiftKey", "SPC.LineId > Lines.LineId",
)


def _relation(no: int, text: str) -> str:
    (a, x), (b, y) = (side.split(".") for side in text.split(" > "))
    return f"""SELECT '{text}' AS relation, {str(no < 15).lower()} AS active, (SELECT count(*) FROM {_STAR[a]}) AS table_rows, count(*) AS joined_rows, count(r."{y}") AS with_partner
 FROM {_STAR[a]} l LEFT JOIN {_STAR[b]} r ON l."{x}" = r."{y}" """


_BODY["joi12_relations"] = " UNION ALL ".join(_relation(i, t) for i, t in enumerate(_RELATIONS))

_BODY["snk3_sink_retention"] = f"""SELECT line_id, strftime({ts('moment')}, '%Y%m%d_%H%M') AS snapshot_key,
 CAST((SELECT count(*) FROM c_prod p WHERE p.line_id = r.line_id AND week = 0) AS INTEGER) AS n_shifts
 FROM (SELECT line_id, (reached_us - back * {DAY}) // {15 * MINUTE} * {15 * MINUTE} AS moment FROM c_latest, (SELECT unnest(range(0, 6)) AS back)) r
 WHERE moment >= (SELECT max(reached_us) FROM c_latest) - {3 * DAY}"""

# the same resets with another lookback: 3 days, and all history
_FLOOR = f"(m - {75 * DAY})"
_BODY["spc1_three_days"] = _BODY["spc1_all_history"] = _BODY["spc1_counter_resets"]

STATEMENTS: dict[str, str] = {name: statement(body) for name, body in _BODY.items()}
assert _FLOOR in STATEMENTS["spc1_three_days"]
STATEMENTS["spc1_three_days"] = STATEMENTS["spc1_three_days"].replace(_FLOOR, f"(m - {3 * DAY})")
STATEMENTS["spc1_all_history"] = STATEMENTS["spc1_all_history"].replace(_FLOOR, "0")
