"""The same views in DuckDB SQL, prepended to an oracle as common tables."""

KEY_HASH = "md5('{seed}:' || cast({key} as varchar))"

SPACE = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"

SCORED = """scored as (
  select event_id as udi, user_id as machine_id, event_type as type,
    least(value / 200.0::double, 1.0::double) as prob_failure,
    cast(case when least(value / 200.0::double, 1.0::double) >= 0.45::double then 1 else 0 end as double) as prediction,
    cast(case when (value > 100 and event_type in ('error', 'purchase', 'signup'))
      or cast(('0x' || substr(md5(cast(event_id as varchar)), 1, 8)) as bigint) % 100 < 2
      then 1 else 0 end as integer) as machine_failure
  from events)"""

SENSORS = """sensors as (
  select event_id as udi, event_type || '-' || cast(user_id as varchar) as product_id, event_type as type,
    295.0::double + hour(ts) / 2.0::double as air_temperature_k,
    303.0::double + hour(ts) / 2.0::double + cast(user_id % 5 as double) as process_temperature_k,
    cast(1200 + floor(value * 3) as integer) as rotational_speed_rpm,
    cast(json_extract_string(props, '$.k') as double) / 2.0::double as torque_nm,
    cast(event_id % 254 as integer) as tool_wear_min
  from events)"""

LABELLED = f"""{SCORED},
{SENSORS},
labelled as (
  select n.*, s.machine_failure, s.prob_failure as p_failure,
    cast(s.machine_failure = 1 and s.udi % 5 = 0 as integer) as twf,
    cast(s.machine_failure = 1 and s.udi % 5 = 1 as integer) as hdf,
    cast(s.machine_failure = 1 and s.udi % 5 = 2 as integer) as pwf,
    cast(s.machine_failure = 1 and s.udi % 5 = 3 as integer) as osf,
    cast(s.machine_failure = 1 and s.udi % 5 = 4 as integer) as rnf
  from sensors n join scored s on n.udi = s.udi)"""

RAW_TEXT = f"""{LABELLED},
raw_text as (
  select cast(udi as varchar) as udi, product_id, type,
    cast(air_temperature_k as varchar) as air_temperature_k,
    cast(process_temperature_k as varchar) as process_temperature_k,
    cast(rotational_speed_rpm as varchar) as rotational_speed_rpm,
    case when udi % 97 = 0 then 'n/a' when udi % 101 = 0 then 'NaN'
      else cast(torque_nm as varchar) end as torque_nm,
    cast(tool_wear_min as varchar) as tool_wear_min,
    cast(machine_failure as varchar) as machine_failure,
    cast(twf as varchar) as twf, cast(hdf as varchar) as hdf, cast(pwf as varchar) as pwf,
    cast(osf as varchar) as osf, cast(rnf as varchar) as rnf
  from labelled)"""

FIELD_LOG = """field_log as (
  select conv_id, turn,
    strftime(make_timestamp((1704067200 + conv_id * 60 + turn) * 1000000), '%Y-%m-%d %H:%M:%S') as timestamp,
    'M-' || cast(conv_id % 50 as varchar) as machine_id, role as technician,
    case conv_id % 4 when 0 then 'High' when 1 then 'Medium' when 2 then 'Low' else 'Unknown' end as urgency,
    text as transcript
  from conversations)"""

REPORTS = f"""reports as (
  select conv_id, turn,
    trim(case when conv_id % 11 = 0 then '   ' when conv_id % 13 = 0 then ' LINE ' || cast(conv_id as varchar)
      else 'M-' || cast(conv_id * 7 % 500 as varchar) end, {SPACE}) as machine_id,
    case when turn % 2 = 0 then 'Line ' || cast(turn as varchar) else '' end as location,
    case when role = 'system' then 'Unknown' else role end as technician,
    '2024-01-' || lpad(cast(conv_id % 28 + 1 as varchar), 2, '0') as report_date,
    case when turn % 4 = 3 then '' else text end as fault_description,
    case when turn % 3 = 0 then 'wear' else '' end as root_cause,
    '  ' as work_performed,
    case when conv_id % 2 = 0 then 'seal kit' else '' end as parts_used,
    cast(turn as varchar) as downtime_hours,
    case when turn % 4 = 3 then '' else 'inspect' end as recommendations,
    case when conv_id % 3 = 0 then '2024-03-01' else '' end as next_maintenance_date,
    text as shift_report
  from conversations)"""

TIER = """case when {p} >= 0.0 and {p} < 0.30::double then 'Low'
    when {p} >= 0.30::double and {p} < 0.55::double then 'Medium'
    when {p} >= 0.55::double and {p} < 1.01::double then 'High' end"""

PERCENT = "printf('%.1f%%', {p} * 100.0::double)"
