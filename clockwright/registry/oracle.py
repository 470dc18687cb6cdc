"""The SQL that each query has to agree with, over the same driver tables."""

from __future__ import annotations

import re

from clockwright import settings
from clockwright.registry.queries import FLAG_TEXTS, RATE_TEXTS, TOKEN_TEXTS
from clockwright.functions.parsing import NA_TOKENS


def _texts(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def _hours(start: str, end: str) -> str:
    return f"((epoch_us({end}) - epoch_us({start})) / 1000000.0 / 3600.0)"


def _minutes(start: str, end: str) -> str:
    return f"((epoch_us({end}) - epoch_us({start})) / 1000000.0 / 60.0)"


def _money(x: str) -> str:
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,18)), 2) as double)"


_ISO = "'%Y-%m-%dT%H:%M:%S'"
_STAMP = "'[0-9]{4}-[0-9]{2}-[0-9]{2}T([01][0-9]|2[0-3]):[0-9]{2}:[0-9]{2}'"


def _parse(text: str) -> str:
    return f"case when regexp_full_match({text}, {_STAMP}) then try_cast({text} as timestamp) end"


def _draw(key: str, purpose: str) -> str:
    return f"('0x' || substr(md5({key} || ':{settings.SEED}:{purpose}'), 1, 13))::bigint"


def _uniform(key: str, purpose: str) -> str:
    return f"({_draw(key, purpose)}::double / 4503599627370496.0)"


def _moved(moment: str, hours: str) -> str:
    minutes = f"round_even((epoch_us({moment}) / 1000000.0 + ({hours}) * 3600.0) / 60.0, 0)::bigint"
    return f"strftime(timestamp '1970-01-01' + to_minutes({minutes}), {_ISO})"


def _rounded(x: str, digits: int) -> str:
    """Rounded, with negative zero as zero."""
    return f"case when round({x}, {digits}) = 0 then 0.0::double else round({x}, {digits}) end"


def _round3(x: str) -> str:
    """Three decimals, nearest by the exact binary value, ties to even."""
    steps = f"round_even(({x}) * 2000.0::double, 0)"
    high = f"(({x}) * 134217729.0::double - (({x}) * 134217729.0::double - ({x})))"
    beyond = f"(({high} * 2000.0::double - {steps}) + (({x}) - {high}) * 2000.0::double)"
    return (f"case when {steps}::bigint % 2 = 0 then {steps} / 2.0::double when {beyond} > 0 then ({steps} + 1) / 2.0::double "
            f"when {beyond} < 0 or (({steps}::bigint - 1) // 2) % 2 = 0 then ({steps} - 1) / 2.0::double "
            f"else ({steps} + 1) / 2.0::double end / 1000.0::double")


def _mean(x: str) -> str:
    """Mean of hours, summed as whole microseconds."""
    return f"(sum(round_even({x} * 3.6e9::double, 0)::bigint)::double / (count(*) * 3.6e9::double))"


_FEATURES = ", ".join(settings.FEATURE_COLUMNS)
_ROUNDED = ", ".join(f"{_rounded(c, 6)} as {c}" for c in settings.FEATURE_COLUMNS)
_HINT = "case " + " ".join(
    f"when {c} = greatest({_FEATURES}) then '{c}'" for c in settings.FEATURE_COLUMNS) + " end"
_KEYS = "shift_id, employee_id, department_id, clock_in, clock_out"

_CONFUSION = """select count(*) filter (where actual_anomaly and predicted_anomaly) as true_positives,
               count(*) filter (where not actual_anomaly and predicted_anomaly) as false_positives,
               count(*) filter (where actual_anomaly and not predicted_anomaly) as false_negatives,
               count(*) filter (where not actual_anomaly and not predicted_anomaly) as true_negatives"""
_METRICS = """select coalesce(true_positives / nullif(true_positives + false_positives, 0), 0.0) as precision,
               coalesce(true_positives / nullif(true_positives + false_negatives, 0), 0.0) as recall,
               coalesce(2 * true_positives / nullif(2 * true_positives + false_positives + false_negatives, 0), 0.0)
                   as f1,
               true_positives, false_positives, false_negatives, true_negatives"""

# Common tables, each after the ones it uses.
_TABLES = {
    "w_departments": """
        select 'D' || format('{:03d}', n_nationkey + 1) as department_id, n_name as department_name,
               case when n_nationkey % 3 = 0 then '24/7' else 'Weekdays' end as operating_schedule
        from nation""",
    "w_employees_raw": """
        select format('EMP{:05d}', c_custkey + 1) as employee_id, c_name as first_name, c_name as last_name,
               'D' || format('{:03d}', c_nationkey + 1) as department_id, c_mktsegment as job_title,
               cast(date '2015-01-01' + cast(c_custkey % 3650 as integer) as varchar) as hire_date,
               cast(22 + ((c_custkey * 37) % 3800) / 100 as varchar) as hourly_rate,
               case when c_custkey % 100 < 92 then 'active' when c_custkey % 100 < 97 then 'on_leave'
                    else 'terminated' end as employment_status
        from customer""",
    "w_employees": """
        select employee_id, first_name, last_name, department_id, job_title, cast(hire_date as date) as hire_date,
               cast(hourly_rate as double) as hourly_rate, employment_status
        from w_employees_raw""",
    "w_planned": """
        select o_orderkey as k, format('SFT{:07d}', o_orderkey + 1) as shift_id,
               format('EMP{:05d}', o_custkey + 1) as employee_id,
               'D' || format('{:03d}', c_nationkey + 1) as department_id,
               o_orderdate + to_hours(cast((o_orderkey % 3) * 8 as integer)) as s,
               o_orderdate + to_hours(cast((o_orderkey % 3) * 8 + 8 as integer)) as e,
               case when c_nationkey % 3 = 0 then '24/7' else 'Weekdays' end as shift_type
        from orders join customer on c_custkey = o_custkey""",
    "w_shifts_raw": f"""
        select shift_id, employee_id, department_id, strftime(s, {_ISO}) as scheduled_start,
               strftime(e, {_ISO}) as scheduled_end, shift_type
        from w_planned""",
    "w_shifts": f"""
        select shift_id, employee_id, department_id, s as scheduled_start, e as scheduled_end, shift_type,
               {_hours('s', 'e')} as scheduled_hours
        from w_planned""",
    "w_punches_raw": f"""
        select format('PCH{{:07d}}', k * 2 + c + 1) as punch_id,
               case when k % 991 = 2 then 'SFT9999999' else shift_id end as shift_id,
               case when k % 983 = 3 then 'EMP99999' else employee_id end as employee_id,
               department_id,
               case when k % 997 = 1 then 'not-a-time'
                    else strftime(s + to_minutes(cast((k * 7919) % 91 - 30 as bigint)), {_ISO}) end as clock_in,
               case when k % 50 = 3 then null
                    when k % 977 = 4 then strftime(s - to_minutes(60), {_ISO})
                    else strftime(e + to_minutes(cast((k * 104729) % 241 - 60
                         + case when k % 33 = 5 then 300 + k % 300 else 0 end as bigint)), {_ISO}) end as clock_out,
               case when k % 50 = 3 then 'missing_clock_out' when c = 1 then 'duplicate'
                    else 'complete' end as punch_status
        from (select *, unnest(case when k % 100 = 7 then [0, 1] else [0] end) as c from w_planned)""",
    "w_labels_raw": f"""
        select format('ANM{{:06d}}', k + 1) as anomaly_id, format('PCH{{:07d}}', k * 2 + 1) as punch_id,
               shift_id, employee_id,
               case when k % 4 = 3 then 'insufficient_rest' else 'extreme_overtime' end as anomaly_type,
               strftime(s + to_minutes(cast((k * 7919) % 91 - 30 as bigint)), {_ISO}) as original_clock_in,
               strftime(e + to_minutes(cast((k * 104729) % 241 - 60 as bigint)), {_ISO}) as original_clock_out,
               strftime(s + to_minutes(cast((k * 7919) % 91 - 30 as bigint)), {_ISO}) as injected_clock_in,
               strftime(e + to_minutes(cast((k * 104729) % 241 - 60 + 300 + k % 300 as bigint)), {_ISO})
                   as injected_clock_out,
               'Clock-out was extended several hours beyond ordinary behavior.' as anomaly_reason,
               case when k % 2 = 0 then 'True' else 'false' end as is_anomaly
        from w_planned where k % 33 = 5 and k % 50 <> 3""",
    "w_before_raw": f"""
        select punch_id, clock_in,
               case when punch_status = 'missing_clock_out' then null
                    when k % 977 = 4 then clock_out
                    else strftime(e + to_minutes(cast((k * 104729) % 241 - 60 as bigint)), {_ISO}) end as clock_out
        from w_punches_raw join w_planned on k = (substr(punch_id, 4)::bigint - 1) // 2""",
    "w_changed": """
        select a.punch_id from w_before_raw b join w_punches_raw a on a.punch_id = b.punch_id
        where a.clock_in is distinct from b.clock_in or a.clock_out is distinct from b.clock_out""",
    "w_parsed": f"""
        select punch_id, shift_id, employee_id, department_id, {_parse('clock_in')} as clock_in,
               {_parse('clock_out')} as clock_out, punch_status
        from w_punches_raw""",
    "w_matched": """
        select p.*, t.scheduled_start, t.scheduled_end, t.scheduled_hours, m.hourly_rate,
               t.shift_id as known_shift, m.employee_id as known_employee
        from w_parsed p left join w_shifts t on t.shift_id = p.shift_id
             left join w_employees m on m.employee_id = p.employee_id""",
    "w_classified": f"""
        select *, case when clock_in is null then 'invalid_clock_in'
                       when clock_out is null then 'missing_or_invalid_clock_out'
                       when known_shift is null then 'unknown_shift'
                       when known_employee is null then 'unknown_employee'
                       when clock_out <= clock_in then 'nonpositive_duration'
                       when row_number() over (partition by {_KEYS} order by punch_id) > 1
                            then 'duplicate_business_event' end as quarantine_reason
        from w_matched""",
    "w_quarantine": """
        select punch_id, shift_id, employee_id, department_id, clock_in, clock_out, punch_status, quarantine_reason
        from w_classified where quarantine_reason is not null""",
    "w_hours": f"""
        select punch_id, shift_id, employee_id, department_id, clock_in, clock_out, punch_status,
               scheduled_start, scheduled_end, scheduled_hours, hourly_rate,
               {_hours('clock_in', 'clock_out')} as worked_hours,
               {_minutes('scheduled_start', 'clock_in')} as arrival_minutes,
               {_minutes('scheduled_end', 'clock_out')} as departure_minutes
        from w_classified where quarantine_reason is null""",
    "w_split": """
        select *, least(worked_hours, 8.0) as regular_hours, greatest(worked_hours - 8.0, 0.0) as daily_overtime_hours
        from w_hours""",
    "w_paid": f"""
        select *, {_money('regular_hours * hourly_rate')} as regular_pay,
               {_money('daily_overtime_hours * hourly_rate * 1.5::double')} as overtime_pay
        from w_split""",
    "w_clean": f"""
        select *, {_money('regular_pay + overtime_pay')} as gross_pay_estimate, cast(clock_in as date) as work_date,
               cast(date_trunc('week', clock_in) as date) as week_start
        from w_paid""",
    "w_labels": """
        select anomaly_id, punch_id, shift_id, employee_id, anomaly_type, original_clock_in, original_clock_out,
               injected_clock_in, injected_clock_out, anomaly_reason, lower(is_anomaly) = 'true' as is_anomaly,
               punch_id in (select punch_id from w_clean) as is_evaluable
        from w_labels_raw""",
    "w_stats": f"""
        select *, lag(clock_out) over (partition by employee_id order by clock_in, punch_id) as previous_out,
               avg(worked_hours) over (partition by employee_id) as employee_mean_worked_hours,
               coalesce(stddev_samp(worked_hours) over (partition by employee_id), 0.0) as employee_std_worked_hours
        from w_clean""",
    "w_features": f"""
        select punch_id, shift_id, employee_id, department_id, clock_in, worked_hours, daily_overtime_hours,
               arrival_minutes, departure_minutes, scheduled_hours,
               coalesce({_hours('previous_out', 'clock_in')}, 24.0) as rest_hours_before_shift,
               employee_mean_worked_hours, employee_std_worked_hours,
               case when employee_std_worked_hours <> 0 then
                    (worked_hours - employee_mean_worked_hours) / employee_std_worked_hours
                    else 0.0 end as worked_hours_zscore
        from w_stats""",
    "w_scored": f"""
        select *, round(abs(worked_hours_zscore), 6) as anomaly_score, {_HINT} as reason_hint from w_features""",
    "w_scores": """
        select punch_id, shift_id, employee_id, department_id, clock_in, anomaly_score,
               anomaly_score > (select quantile_cont(anomaly_score, 0.97) from w_scored) as predicted_anomaly,
               reason_hint
        from w_scored""",
    "w_pairs": """
        select p.punch_id, s.predicted_anomaly,
               p.punch_id in (select punch_id from w_labels where is_anomaly) as actual_anomaly
        from w_clean p join w_scores s on s.punch_id = p.punch_id""",
    "w_confusion": f"""
        {_CONFUSION}
        from w_pairs""",
    "w_metrics": f"""
        {_METRICS}
        from w_confusion""",
    "w_updates": """
        select format('PCH{:07d}', (event_id - event_id % 4) * 2 + 1) as punch_id,
               case event_type when 'view' then 'pending' when 'click' then 'legitimate' when 'signup' then 'resolved'
                    when 'error' then 'confirmed_issue' else 'archived' end as review_status,
               case when event_id % 7 <> 0 then repeat(props, cast(1 + event_id % 250 as integer)) end
                   as reviewer_notes,
               ts as updated_at, event_id as seq
        from events""",
    "w_checked": """
        select *, case when review_status not in ('pending', 'confirmed_issue', 'legitimate', 'resolved')
                            then 'unknown_review_status'
                       when length(reviewer_notes) > 2000 then 'notes_too_long' end as problem
        from w_updates""",
    "w_last": """
        select * from w_checked where problem is null
        qualify row_number() over (partition by punch_id order by updated_at desc, seq desc) = 1""",
    "w_review": """
        select s.*, coalesce(u.review_status, 'pending') as review_status, u.reviewer_notes
        from w_scores s left join w_last u on u.punch_id = s.punch_id""",
    "w_history": f"""
        select employee_id, count(*) as record_count, {_round3(_mean('worked_hours'))} as mean_worked_hours,
               {_round3('max(worked_hours)')} as max_worked_hours,
               {_round3(_mean('daily_overtime_hours'))} as mean_overtime_hours,
               count(*) filter (where daily_overtime_hours > 0) as overtime_shift_count
        from (select *, max(clock_in) over (partition by employee_id) as latest from w_clean)
        where clock_in >= latest - interval 90 day group by employee_id""",
    "w_baseline": f"""
        select department_id, count(*) as record_count, {_round3(_mean('worked_hours'))} as mean_worked_hours,
               {_round3('quantile_cont(worked_hours, 0.95)')} as p95_worked_hours,
               {_round3(_mean('daily_overtime_hours'))} as mean_overtime_hours,
               {_round3('quantile_cont(daily_overtime_hours, 0.95)')} as p95_overtime_hours
        from (select *, max(clock_in) over (partition by department_id) as latest from w_clean)
        where clock_in >= latest - interval 90 day group by department_id""",
    "w_recent": """
        select employee_id, punch_id, clock_in, worked_hours, recency
        from (select *, max(clock_in) over (partition by employee_id) as latest,
                     row_number() over (partition by employee_id order by clock_in desc, punch_id desc) as recency
              from w_clean)
        where recency <= 12 and clock_in >= latest - interval 90 day""",
    "w_flagged": """
        select p.*, s.anomaly_score, s.predicted_anomaly, s.reason_hint
        from w_clean p join w_scores s on s.punch_id = p.punch_id where s.predicted_anomaly""",
    "w_slots": """
        select employee_id, department_id, operating_schedule, day
        from (select m.employee_id, m.department_id, d.operating_schedule,
                     unnest(generate_series((select min(s) from w_day_bounds), (select max(s) from w_day_bounds),
                                            interval 1 day))::date as day
              from w_employees m join w_departments d on d.department_id = m.department_id
              where m.employment_status = 'active')
        where operating_schedule = '24/7' or isodow(day) <= 5""",
    "w_day_bounds": "select date_trunc('day', o_orderdate)::timestamp as s from orders",
    "w_drawn": f"""
        select *, {_draw('punch_id', 'sample')} as draw from w_punches_raw
        where punch_status = 'complete' and ({_parse('clock_in')}) is not null and ({_parse('clock_out')}) is not null""",
    "w_sampled": f"""
        select punch_id, shift_id, row_number() over (order by {_draw('punch_id', 'sample')}, punch_id) as place,
               count(*) over () as eligible
        from w_punches_raw where punch_status = 'complete'""",
    "w_picked": f"""
        select *, row_number() over (order by draw, punch_id) as number,
               case when {_uniform('punch_id', 'type')} < 0.4 then 'extreme_overtime'
                    when {_uniform('punch_id', 'type')} < 0.75 then 'extremely_early_clock_in'
                    else 'insufficient_rest' end as anomaly_type
        from w_drawn
        qualify row_number() over (order by draw, punch_id)
                <= (select greatest(1, round_even(count(*) * 0.03::double, 0)::bigint) from w_drawn)""",
    "w_injected": f"""
        select *, case when anomaly_type = 'extremely_early_clock_in'
                       then {_moved(_parse('clock_in'), f"-(2.0 + 4.0 * {_uniform('punch_id', 'hours')})")}
                       else clock_in end as injected_clock_in,
               case when anomaly_type <> 'extremely_early_clock_in'
                       then {_moved(_parse('clock_out'), f"4.0 + 6.0 * {_uniform('punch_id', 'hours')}")}
                       else clock_out end as injected_clock_out
        from w_picked""",
}


_DRAWS = 2 ** 52
_DEPTH = (settings.SAMPLE_SIZE - 1).bit_length()
_N = len(settings.FEATURE_COLUMNS)
_BRANCH = "2 * node + 1 + (f[feature + 1] > threshold)::int"


def _forest_tables() -> dict[str, str]:
    """The forest grown and walked level by level, with one common table per level."""
    letters = "abcdefghijklmnop"[:_DEPTH + 1]
    values = ", ".join(f"round({c}, 6)" for c in settings.FEATURE_COLUMNS)
    name = "tree || ':' || node"
    found = {
        "w_forest_rows": f"""
        select punch_id, [{values}] as f, {_draw('punch_id', 'forest')} as a, {_draw('punch_id', 'forest-step')} as b
        from w_features""",
        "w_forest_drawn": f"""
        select tree, punch_id from (
            select tree, punch_id, row_number() over (partition by tree order by (a + tree * b) % {_DRAWS}, punch_id) as place
            from w_forest_rows, range({settings.TREES}) r(tree))
        where place <= {settings.SAMPLE_SIZE}""",
        "w_forest_level_a": "select tree, 0 as node, f from w_forest_drawn join w_forest_rows using (punch_id)",
    }
    low, high = (", ".join(f"{side}(f[{i}])" for i in range(1, _N + 1)) for side in ("min", "max"))
    for depth, at in enumerate(letters):
        found[f"w_forest_split_{at}"] = f"""
        select tree, node, feature, rows, {depth} as depth,
               case when feature < 0 then 0.0::double
                    when low[feature + 1] + {_uniform(name, 'threshold')} * (high[feature + 1] - low[feature + 1]) < high[feature + 1]
                    then low[feature + 1] + {_uniform(name, 'threshold')} * (high[feature + 1] - low[feature + 1])
                    else low[feature + 1] end as threshold
        from (select *, case when {depth} = {_DEPTH} or rows <= 1 or len(varying) = 0 then -1
                             else varying[floor({_uniform(name, 'feature')} * len(varying))::int + 1] - 1 end as feature
              from (select *, list_filter(generate_series(1, {_N}), lambda i: low[i] < high[i]) as varying
                    from (select tree, node, count(*) as rows, [{low}] as low, [{high}] as high
                          from w_forest_level_{at} group by tree, node)))"""
        if depth < _DEPTH:
            found[f"w_forest_level_{letters[depth + 1]}"] = f"""
        select tree, {_BRANCH} as node, f from w_forest_level_{at} join w_forest_split_{at} using (tree, node)
        where feature >= 0"""
    rest = "(2.0::double * (ln(rows - 1.0::double) + 0.5772156649015329::double) - 2.0::double * (rows - 1.0::double) / rows)"
    found["w_forest_nodes"] = f"""
        select tree::int as tree, node::int as node, feature::int as feature, threshold,
               (case when feature < 0 then node else 2 * node + 1 end)::int as left_node,
               (case when feature < 0 then node else 2 * node + 2 end)::int as right_node,
               rows::int as rows, depth::int as depth,
               case when feature >= 0 then 0.0::double when rows <= 1 then depth::double when rows = 2 then depth + 1.0::double
                    else depth + round_even({rest} * 1073741824.0::double, 0) / 1073741824.0::double end as path_length
        from ({" union all ".join(f"select * from w_forest_split_{at}" for at in letters)})"""
    found["w_forest_walk_a"] = f"select punch_id, tree, 0 as node from w_forest_rows, range({settings.TREES}) r(tree)"
    for at, then in zip(letters, letters[1:]):
        found[f"w_forest_walk_{then}"] = f"""
        select punch_id, tree, case when feature < 0 then node else {_BRANCH} end as node
        from w_forest_walk_{at} join w_forest_nodes using (tree, node) join w_forest_rows using (punch_id)"""
    size = f"{float(settings.SAMPLE_SIZE)}::double"
    found["w_isolation"] = f"""
        select punch_id, pow(2.0::double, -sum(path_length) / ({settings.TREES} * (2.0::double * (ln({size} - 1)
               + 0.5772156649015329::double) - 2.0::double * ({size} - 1) / {size}))) as isolation
        from w_forest_walk_{letters[-1]} join w_forest_nodes using (tree, node) group by punch_id"""
    found["w_cut"] = f"select quantile_cont(isolation, {1 - settings.CONTAMINATION}) as cut from w_isolation"
    found["w_forest_scores"] = f"""
        select punch_id, shift_id, employee_id, department_id, clock_in, isolation - cut as anomaly_score,
               isolation > cut as predicted_anomaly, {_HINT} as reason_hint
        from w_features join w_isolation using (punch_id), w_cut"""
    found["w_forest_pairs"] = """
        select predicted_anomaly, punch_id in (select punch_id from w_labels where is_anomaly) as actual_anomaly
        from w_forest_scores"""
    return found


_TABLES |= _forest_tables()


def _names_in(sql: str) -> set[str]:
    return set(re.findall(r"\bw_[a-z_]+\b", sql)) & set(_TABLES)


def _with_tables(select: str) -> str:
    """Put the common tables a statement needs in front of it."""
    needed, queue = set(), [select]
    while queue:
        for name in _names_in(queue.pop()) - needed:
            needed.add(name)
            queue.append(_TABLES[name])
    ordered: list[str] = []

    def place(name: str) -> None:
        if name not in ordered:
            for before in sorted(_names_in(_TABLES[name])):
                place(before)
            ordered.append(name)

    for name in sorted(needed):
        place(name)
    if not ordered:
        return select
    kind = {n: "as materialized" if n.startswith("w_forest") else "as" for n in ordered}
    return "with " + ",\n".join(f"{n} {kind[n]} ({_TABLES[n]})" for n in ordered) + "\n" + select


def _rule(table: str, rule: str, violations: str) -> str:
    return f"select '{table}' as table_name, '{rule}' as rule, cast(({violations}) as bigint) as violations"


def _broken(table: str, condition: str) -> str:
    return f"select count(*) from {table} where {condition}"


def _key_rule(table: str, source: str, key: str) -> str:
    return _rule(table, f"{key} must be non-null and unique",
                 f"select count(*) from (select {key} from {source} group by {key} "
                 f"having count(*) > 1 or {key} is null)")


def _reference_rule(table: str, source: str, key: str, parent: str, parent_source: str) -> str:
    return _rule(table, f"{key} must exist in {parent}",
                 f"select count(*) from {source} c "
                 f"where not exists (select 1 from {parent_source} p where p.{key} = c.{key})")


def _agreement_rule(table: str, source: str, key: str, attribute: str, parent: str, parent_source: str) -> str:
    return _rule(table, f"{attribute} must agree with {parent}",
                 f"select count(*) from {source} c join {parent_source} p on p.{key} = c.{key} "
                 f"where c.{attribute} is distinct from p.{attribute}")


def _domain_rule(table: str, source: str, column: str, allowed: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{a}'" for a in allowed)
    return _rule(table, f"{column} must be known", _broken(source, f"{column} is null or {column} not in ({listed})"))


_STANDARD_LABEL_RULE = _rule("labels", "is_anomaly must contain true or false",
                             _broken("w_labels_raw", "lower(is_anomaly) not in ('true', 'false') or is_anomaly is null"))
_EMPTY = "select case when count(*) = 0 then 1 else 0 end from "

_DQ_SUMMARY = "\nunion all\n".join([
    _rule("departments", "department_name must not be null", _broken("w_departments", "department_name is null")),
    _rule("departments", "table must not be empty", _EMPTY + "w_departments"),
    _key_rule("departments", "w_departments", "department_id"),
    _rule("employees", "hourly_rate must be positive", _broken("w_employees", "not (hourly_rate > 0)")),
    _rule("employees", "row count must be as expected",
          "select abs((select count(*) from w_employees) - (select count(*) from customer))"),
    _key_rule("employees", "w_employees", "employee_id"),
    _reference_rule("employees", "w_employees", "department_id", "departments", "w_departments"),
    _domain_rule("employees", "w_employees", "employment_status", settings.EMPLOYMENT_STATUSES),
    _rule("shifts", "scheduled_start must be a valid timestamp", _broken("w_shifts", "scheduled_start is null")),
    _rule("shifts", "scheduled_end must be a valid timestamp", _broken("w_shifts", "scheduled_end is null")),
    _rule("shifts", "scheduled_end must be after scheduled_start",
          _broken("w_shifts", "scheduled_end <= scheduled_start")),
    _rule("shifts", "every shift must have the standard duration", _broken("w_shifts", "scheduled_hours <> 8.0")),
    _rule("shifts", "table must not be empty", _EMPTY + "w_shifts"),
    _key_rule("shifts", "w_shifts", "shift_id"),
    _reference_rule("shifts", "w_shifts", "employee_id", "employees", "w_employees"),
    _agreement_rule("shifts", "w_shifts", "employee_id", "department_id", "employees", "w_employees"),
    _rule("punches", "clock_in must be a valid timestamp", _broken("w_parsed", "clock_in is null")),
    _rule("punches", "a given clock_out must be a valid timestamp",
          f"select count(*) from w_punches_raw where clock_out is not null and ({_parse('clock_out')}) is null"),
    _rule("punches", "clock_out must be after clock_in", _broken("w_parsed", "clock_out <= clock_in")),
    _rule("punches", "table must not be empty", _EMPTY + "w_punches_raw"),
    _key_rule("punches", "w_punches_raw", "punch_id"),
    _reference_rule("punches", "w_punches_raw", "shift_id", "shifts", "w_shifts"),
    _agreement_rule("punches", "w_punches_raw", "shift_id", "employee_id", "shifts", "w_shifts"),
    _agreement_rule("punches", "w_punches_raw", "shift_id", "department_id", "shifts", "w_shifts"),
    _domain_rule("punches", "w_punches_raw", "punch_status", settings.PUNCH_STATUSES),
    _STANDARD_LABEL_RULE,
])

_DQ_TRANSFORM = "\nunion all\n".join([
    _key_rule("departments", "w_departments", "department_id"),
    _rule("employees", "hire_date must be a valid timestamp", _broken("w_employees", "hire_date is null")),
    _rule("employees", "hourly_rate must be a number above zero", _broken("w_employees", "not (hourly_rate > 0)")),
    _key_rule("employees", "w_employees", "employee_id"),
    _reference_rule("employees", "w_employees", "department_id", "departments", "w_departments"),
    _rule("shifts", "scheduled_start must be a valid timestamp", _broken("w_shifts", "scheduled_start is null")),
    _rule("shifts", "scheduled_end must be a valid timestamp", _broken("w_shifts", "scheduled_end is null")),
    _rule("shifts", "scheduled_end must be after scheduled_start",
          _broken("w_shifts", "scheduled_end <= scheduled_start")),
    _key_rule("shifts", "w_shifts", "shift_id"),
    _reference_rule("shifts", "w_shifts", "employee_id", "employees", "w_employees"),
    _STANDARD_LABEL_RULE,
])

_LABEL_CHANGE = "\nunion all\n".join([
    _rule("labels", "every label must be marked true",
          _broken("w_labels_raw", "is_anomaly is null or lower(is_anomaly) <> 'true'")),
    _rule("labels", "table must not be empty", _EMPTY + "w_labels_raw"),
    _key_rule("labels", "w_labels_raw", "anomaly_id"),
    _key_rule("labels", "w_labels_raw", "punch_id"),
    _reference_rule("labels", "w_labels_raw", "punch_id", "punches", "w_punches_raw"),
    _rule("labels", "every label must change a timestamp",
          "select count(*) from w_labels_raw where punch_id not in (select punch_id from w_changed)"),
])

_RAW_TABLES = {"departments": "w_departments", "employees": "w_employees_raw", "shifts": "w_shifts_raw",
               "punches": "w_punches_raw", "labels": "w_labels_raw"}
_STORED_TABLES = {"departments": "w_departments", "employees": "w_employees", "shifts": "w_shifts",
                  "punches": "w_clean", "quarantine": "w_quarantine", "labels": "w_labels"}


def _counts(tables: dict[str, str]) -> str:
    return " union all ".join(f"select '{name}' as table_name, count(*) as row_count from {source}"
                              for name, source in tables.items())


def _bad_times(table: str, column: str) -> str:
    return (f"select '{column}' as column_name, count(*) as total_rows, "
            f"count(*) filter (where ({_parse(column)}) is null) as bad_rows from {table}")


def _unknown(name: str, source: str, key: str, parent: str) -> str:
    return (f"select '{name}' as reference, {key} as unknown_key, count(*) as key_rows from {source} c "
            f"where not exists (select 1 from {parent} p where p.{key} = c.{key}) group by {key}")


def _outside(column: str, source: str, allowed: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{a}'" for a in allowed)
    return (f"select '{column}' as column_name, {column} as unknown_value, count(*) as value_rows from {source} "
            f"where {column} is null or {column} not in ({listed}) group by {column}")


_TIME_FORMS = f"""list_extract([strftime(o_orderdate, {_ISO}), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'),
    strftime(o_orderdate, {_ISO}) || '.5', strftime(o_orderdate, {_ISO}) || 'Z', strftime(o_orderdate, '%Y-%m-%d'),
    '2026-02-30T08:00:00', '2026-01-01T24:00:00', ' ' || strftime(o_orderdate, {_ISO}), '2026'],
    o_orderkey % 9 + 1)"""
_NUMBER = r"'\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*'"

_SCALING = " union all ".join(
    f"select '{c}' as feature, {_rounded(f'avg({c})', 6)} as mean, "
    f"round(case when stddev_pop({c}) = 0 then 1.0 else stddev_pop({c}) end, 6) as scale from w_features"
    for c in settings.FEATURE_COLUMNS)
_SCALED = ", ".join(
    _rounded(f"({c} - avg({c}) over ()) / case when stddev_pop({c}) over () = 0 then 1.0 "
             f"else stddev_pop({c}) over () end", 5) + f" as {c}" for c in settings.FEATURE_COLUMNS)

_FOREST_SCORES = f"""
        select punch_id, shift_id, employee_id, department_id, clock_in, {_rounded('anomaly_score', 9)} as anomaly_score,
               predicted_anomaly, reason_hint
        from w_forest_scores"""
_CONTEXT = " || chr(10) || ".join(
    [f"'{settings.CONTEXT_HEADING}'"]
    + [f"'{c}: ' || " + {
        "clock_in": f"strftime(clock_in, {_ISO})",
        "punch_id": "punch_id", "employee_id": "employee_id", "department_id": "department_id",
        "anomaly_score": "cast(anomaly_score as varchar)", "reason_hint": "reason_hint",
    }.get(c, f"cast(round({c}, 3) as varchar)") for c in settings.CONTEXT_FIELDS])

_STATEMENTS = {
    "scan_na_normalise": f"""
        select o_orderkey, case when t in ({", ".join("'" + x + "'" for x in NA_TOKENS)}) then null else t end
               as token_text, o_orderpriority
        from (select *, list_extract({_texts(TOKEN_TEXTS)}, o_orderkey % {len(TOKEN_TEXTS)} + 1) as t from orders)""",
    "csv_dialect": f"""
        select doc_id::varchar as doc_id, source, case when text not in ({", ".join(f"'{t}'" for t in NA_TOKENS)}) then text end as text
        from documents""",
    "raw_csv_scan": "select * from w_punches_raw",
    "roundtrip_load": "select * from w_shifts",
    "table_counts": _counts(_RAW_TABLES),
    "etl_table_counts": _counts(_STORED_TABLES),
    "stored_punches": "select * from w_clean",
    "stored_quarantine": "select * from w_quarantine",
    "stored_labels": "select * from w_labels",
    "transformed_tables": _counts(_STORED_TABLES),
    "parse_ts_bad_count": " union all ".join([
        _bad_times("w_punches_raw", "clock_in"), _bad_times("w_punches_raw", "clock_out"),
        _bad_times("w_shifts_raw", "scheduled_start"), _bad_times("w_shifts_raw", "scheduled_end")]),
    "parse_ts_lenient": f"""
        select o_orderkey, time_text, {_parse('time_text')} as parsed
        from (select o_orderkey, {_TIME_FORMS} as time_text from orders)""",
    "parse_rate_positive": f"""
        select *, rate is null or isnan(rate) or rate <= 0 as is_bad
        from (select c_custkey, t as rate_text,
                     case when regexp_full_match(t, {_NUMBER}) then try_cast(trim(t) as double)
                          when lower(trim(t)) = 'inf' then 'infinity'::double end as rate
              from (select c_custkey, list_extract({_texts(RATE_TEXTS)}, c_custkey % {len(RATE_TEXTS)} + 1) as t
                    from customer))""",
    "parse_bool_token": f"""
        select o_orderkey, t as flag_text, case lower(t) when 'true' then true when 'false' then false end as flag
        from (select o_orderkey, list_extract({_texts(FLAG_TEXTS)}, o_orderkey % {len(FLAG_TEXTS)} + 1) as t
              from orders)""",
    "shift_durations": f"""
        select shift_id, scheduled_hours, {_minutes('scheduled_start', 'scheduled_end')} as scheduled_minutes
        from w_shifts""",
    "calendar_columns": "select punch_id, work_date, week_start from w_clean",
    "overtime_split": "select punch_id, worked_hours, regular_hours, daily_overtime_hours from w_clean",
    "pay_estimate": "select punch_id, hourly_rate, regular_pay, overtime_pay, gross_pay_estimate from w_clean",
    "clip_offsets": """
        select punch_id, greatest(-30.0, least(arrival_minutes, 60.0)) as arrival_clipped,
               greatest(-60.0, least(departure_minutes, 180.0)) as departure_clipped
        from w_clean""",
    "format_ids": """
        select o_orderkey, format('EMP{:05d}', o_custkey + 1) as employee_id,
               format('SFT{:07d}', o_orderkey + 1) as shift_id, format('PCH{:07d}', o_orderkey + 1) as punch_id,
               format('ANM{:06d}', o_orderkey + 1) as anomaly_id
        from orders""",
    "record_json": f"""
        select punch_id, strftime(clock_in, {_ISO}) as clock_in, cast(work_date as varchar) as work_date,
               worked_hours, gross_pay_estimate
        from w_clean""",
    "triage_context_text": f"select punch_id, {_CONTEXT} as context_text from w_flagged",
    "dq_summary": _DQ_SUMMARY,
    "dq_transform_rules": _DQ_TRANSFORM,
    "dq_duplicate_keys": """
        select shift_id, count(*) as key_rows from w_punches_raw group by shift_id
        having count(*) > 1 or shift_id is null""",
    "fk_violations": " union all ".join([
        _unknown("employees.department_id", "w_employees_raw", "department_id", "w_departments"),
        _unknown("shifts.employee_id", "w_shifts_raw", "employee_id", "w_employees_raw"),
        _unknown("punches.shift_id", "w_punches_raw", "shift_id", "w_shifts_raw"),
        _unknown("punches.employee_id", "w_punches_raw", "employee_id", "w_employees_raw"),
        _unknown("labels.punch_id", "w_labels_raw", "punch_id", "w_punches_raw")]),
    "dq_shift_duration": """
        select scheduled_hours, scheduled_hours = 8.0 as is_standard, count(*) as shift_rows
        from w_shifts group by all""",
    "dq_domain": " union all ".join([
        _outside("employment_status", "w_employees_raw", settings.EMPLOYMENT_STATUSES),
        _outside("punch_status", "w_punches_raw", settings.PUNCH_STATUSES),
        _outside("review_status", "w_updates", settings.REVIEW_STATUSES)]),
    "dq_consistency": """
        select p.shift_id, p.employee_id, p.department_id, count(*) as key_rows,
               s.employee_id as expected_employee_id, s.department_id as expected_department_id
        from w_punches_raw p join w_shifts_raw s on s.shift_id = p.shift_id
        where p.employee_id is distinct from s.employee_id or p.department_id is distinct from s.department_id
        group by all""",
    "shift_coverage": """
        select shift_id from w_shifts_raw where shift_id not in (select shift_id from w_punches_raw)""",
    "offset_bounds": f"""
        select p.punch_status, count(*) as punch_rows,
               count(*) filter (where not {_minutes('s.scheduled_start', 'p.clock_in')} between -30 and 60)
                   as arrival_outside,
               count(*) filter (where not {_minutes('s.scheduled_end', 'p.clock_out')} between -60 and 180)
                   as departure_outside
        from w_parsed p join w_shifts s on s.shift_id = p.shift_id group by p.punch_status""",
    "clean_departments": "select * from w_departments",
    "clean_employees": "select * from w_employees",
    "clean_shifts": "select * from w_shifts",
    "enrich_punches": """
        select punch_id, clock_in, clock_out, scheduled_start, scheduled_end, scheduled_hours, hourly_rate
        from w_matched""",
    "punch_dedup": f"""
        select punch_id, row_number() over (partition by {_KEYS} order by punch_id) > 1 as is_later_copy
        from w_parsed""",
    "quarantine_reasons": "select * from w_quarantine",
    "quarantine_counts": """
        select quarantine_reason, count(*) as punch_rows from w_quarantine group by quarantine_reason""",
    "clean_punches": "select * from w_clean",
    "label_evaluable": "select * from w_labels",
    "rest_hours": "select punch_id, rest_hours_before_shift from w_features",
    "employee_stats": """
        select punch_id, employee_id, round(employee_mean_worked_hours, 6) as employee_mean_worked_hours,
               round(employee_std_worked_hours, 6) as employee_std_worked_hours
        from w_features""",
    "worked_zscore": f"""
        select punch_id, {_rounded('worked_hours_zscore', 6)} as worked_hours_zscore from w_features""",
    "feature_matrix": f"""
        select punch_id, shift_id, employee_id, department_id, clock_in, {_ROUNDED} from w_features""",
    "reason_hint": "select punch_id, reason_hint from w_scored",
    "feature_scaling": _SCALING,
    "scaled_features": f"select punch_id, {_SCALED} from w_features",
    "iforest_fit": "select * from w_forest_nodes",
    "iforest_score": f"select punch_id, {_rounded('isolation', 9)} as isolation from w_isolation",
    "anomaly_scores": _FOREST_SCORES,
    "stored_model_scores": _FOREST_SCORES,
    "forest_metrics": f"select * from ({_METRICS} from ({_CONFUSION} from w_forest_pairs))",
    "contamination_flag": "select punch_id, employee_id, anomaly_score from w_scores where predicted_anomaly",
    "eval_confusion": "select * from w_confusion",
    "eval_metrics": "select * from w_metrics",
    "metrics_document": "select * from w_metrics",
    "anomaly_type_counts": "select anomaly_type, count(*) as label_rows from w_labels_raw group by anomaly_type",
    "punch_status_counts": "select punch_status, count(*) as punch_rows from w_punches_raw group by punch_status",
    "review_seed": """
        select punch_id, shift_id, employee_id, department_id, clock_in,
               case when predicted_anomaly then 0.0 else anomaly_score end as anomaly_score, predicted_anomaly,
               reason_hint, case when predicted_anomaly then 'resolved' else 'pending' end as review_status
        from w_scores""",
    "review_event_valid": "select seq, punch_id, review_status, problem from w_checked",
    "review_apply": "select punch_id, review_status, reviewer_notes from w_review",
    "review_store": "select punch_id, employee_id, predicted_anomaly, review_status, reviewer_notes from w_review",
    "review_unknown_updates": """
        select seq, punch_id from w_updates where punch_id not in (select punch_id from w_scores)""",
    "review_filter": """
        select punch_id, department_id, review_status, anomaly_score from w_review
        where review_status = 'resolved' and department_id = 'D004'""",
    "review_total": """
        select count(*) as total from w_review where predicted_anomaly and review_status = 'pending'""",
    "review_page": """
        select punch_id, anomaly_score, review_status from w_review where predicted_anomaly
        order by anomaly_score desc, punch_id limit 50 offset 50""",
    "review_page_deep": """
        select punch_id, anomaly_score, review_status from w_review
        order by anomaly_score desc, punch_id limit 50 offset (select count(*) // 2 from w_review)""",
    "review_get": """
        select u.punch_id, r.punch_id is not null as found, r.review_status, r.anomaly_score
        from (select distinct punch_id from w_updates) u left join w_review r on r.punch_id = u.punch_id""",
    "review_summary": """
        select count(*) as total_records, count(*) filter (where predicted_anomaly) as flagged_records,
               count(*) filter (where review_status = 'pending') as pending_reviews,
               count(*) filter (where review_status = 'confirmed_issue') as confirmed_issues
        from w_review""",
    "flagged_record": "select * from w_flagged",
    "employee_history": """
        select r.employee_id, coalesce(h.record_count, 0) as record_count, h.mean_worked_hours, h.max_worked_hours,
               h.mean_overtime_hours, h.overtime_shift_count
        from (select distinct employee_id from w_punches_raw) r left join w_history h on h.employee_id = r.employee_id
        """,
    "department_baseline": "select * from w_baseline",
    "recent_punches": "select * from w_recent",
    "recent_record_lists": """
        select employee_id, count(*) as records, arg_max(punch_id, recency) as oldest_punch,
               arg_min(punch_id, recency) as newest_punch
        from w_recent group by employee_id""",
    "shift_context": """
        select punch_id, shift_id, scheduled_start, scheduled_end, clock_in, clock_out, arrival_minutes,
               departure_minutes
        from w_clean where punch_id in (select punch_id from w_updates)""",
    "triage_context": """
        select f.punch_id, f.employee_id, f.department_id, f.anomaly_score, f.reason_hint,
               h.record_count as employee_record_count, h.mean_worked_hours as employee_mean_worked_hours,
               h.max_worked_hours as employee_max_worked_hours,
               h.overtime_shift_count as employee_overtime_shift_count, b.record_count as department_record_count,
               b.p95_worked_hours as department_p95_worked_hours,
               b.p95_overtime_hours as department_p95_overtime_hours
        from w_flagged f left join w_history h on h.employee_id = f.employee_id
             left join w_baseline b on b.department_id = f.department_id""",
    "decision_valid": """
        select event_id as decision_id,
               case event_type when 'view' then 'dismiss' when 'click' then 'escalate'
                    when 'signup' then 'needs_more_data' when 'error' then 'dismiss' else 'unsure' end
                    as classification,
               'v1' as prompt_version,
               case when event_type not in ('view', 'click', 'signup', 'error') then 'classification'
                    when value / 50 < 0 or value / 50 > 1 then 'confidence'
                    when length(props) * (event_id % 140) not between 1 and 1200 then 'summary'
                    when length(props) * (event_id % 60) not between 1 and 500 then 'evidence'
                    when length(event_type) * (1 + event_id % 90) not between 1 and 500 then 'recommended_action'
                    end as problem
        from events""",
    "calendar_spine": """
        select unnest(generate_series((select min(s) from w_day_bounds), (select max(s) from w_day_bounds),
                                      interval 1 day))::date as day""",
    "roster_slots": "select department_id, day, count(*) as slots from w_slots group by department_id, day",
    "roster_gaps": """
        select employee_id, count(*) as days_without_shift from w_slots l
        where not exists (select 1 from w_shifts s
                          where s.employee_id = l.employee_id and cast(s.scheduled_start as date) = l.day)
        group by employee_id""",
    "shift_interval": """
        select o_orderkey, cast(o_orderdate as date) as day,
               date_trunc('day', o_orderdate) + to_hours(cast((o_orderkey % 3) * 8 as integer)) as scheduled_start,
               date_trunc('day', o_orderdate) + to_hours(cast((o_orderkey % 3) * 8 + 8 as integer)) as scheduled_end
        from orders""",
    "seeded_sample": """
        select punch_id, shift_id from w_sampled
        where place <= greatest(1, round_even(eligible * 0.03::double, 0)::bigint)""",
    "seeded_sample_ties": """
        select punch_id, department_id, clock_out from w_punches_raw
        order by substr(md5(coalesce(department_id, '') || ':3:sample'), 1, 13),
                 substr(md5(concat_ws(chr(31), punch_id, shift_id, employee_id, department_id, coalesce(clock_in, '\\N'),
                                      coalesce(clock_out, '\\N'), punch_status)), 1, 13)
        limit (select greatest(1, round_even(count(*) * 0.3::double, 0)::bigint) from w_punches_raw)""",
    "number_rows": """
        select shift_id, employee_id, scheduled_start,
               row_number() over (order by employee_id, scheduled_start, shift_id) as shift_number
        from w_shifts""",
    "perturb_punches": """
        select p.punch_id, p.shift_id, p.employee_id, p.department_id,
               coalesce(i.injected_clock_in, p.clock_in) as clock_in,
               coalesce(i.injected_clock_out, p.clock_out) as clock_out, p.punch_status
        from w_punches_raw p left join w_injected i on i.punch_id = p.punch_id""",
    "perturb_labels": """
        select format('ANM{:06d}', number) as anomaly_id, punch_id, shift_id, employee_id, anomaly_type,
               clock_in as original_clock_in, clock_out as original_clock_out, injected_clock_in, injected_clock_out,
               case anomaly_type
                    when 'extremely_early_clock_in'
                        then 'Clock-in was moved several hours before expected behavior.'
                    when 'insufficient_rest'
                        then 'Clock-out was extended to create an unusually short future rest period.'
                    else 'Clock-out was extended several hours beyond ordinary behavior.' end as anomaly_reason,
               true as is_anomaly
        from w_injected""",
    "label_change_diff": _LABEL_CHANGE,
    "snapshot_changes": """
        select punch_id, 'changed' as change, punch_id in (select punch_id from w_labels_raw) as labelled from w_changed""",
}


def all_sql() -> dict[str, str]:
    return {name: _with_tables(statement) for name, statement in _STATEMENTS.items()}
