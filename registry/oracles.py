"""DuckDB SQL that computes each registered query on the same tables."""

from __future__ import annotations

from faultline.schemas import URGENCY_LEVELS
from registry.oracle_views import (
    FIELD_LOG,
    KEY_HASH,
    LABELLED,
    PERCENT,
    RAW_TEXT,
    REPORTS,
    SCORED,
    SENSORS,
    SPACE,
    TIER,
)

TIER_P = TIER.format(p="prob_failure")
PCT_P = PERCENT.format(p="prob_failure")
D = "::double"

ORACLES: dict[str, str] = {}


def add(name: str, sql: str, *ctes: str) -> None:
    prefix = "with " + ",\n".join(ctes) + "\n" if ctes else ""
    ORACLES[name] = prefix + sql.strip()


def safe(numerator: str, denominator: str) -> str:
    return (
        f"coalesce(({numerator})::double / nullif(({denominator})::double, 0.0::double), 0.0::double)"
    )


RANKED = """ranked as (
  select *, row_number() over (order by prob_failure desc nulls last, udi) as rk from scored)"""

CELLS = """cells as (
  select count(*) filter (where prediction = 1 and machine_failure = 1) as tp,
    count(*) filter (where prediction = 1 and machine_failure = 0) as fp,
    count(*) filter (where prediction = 0 and machine_failure = 1) as fn,
    count(*) filter (where prediction = 0 and machine_failure = 0) as tn,
    count(*) as n,
    count(*) filter (where cast(prediction as integer) = machine_failure) as correct,
    count(*) filter (where prob_failure >= 0.45::double) as n_at_risk
  from scored)"""

RATES = f"""rates as (
  select *, {safe('correct', 'n')} as accuracy, {safe('tp', 'tp + fp')} as p, {safe('tp', 'tp + fn')} as r
  from cells)"""

F1 = "coalesce(2.0::double * p * r / nullif(p + r, 0.0::double), 0.0::double)"

# ---- risk view ----

add(
    "topk_alerts",
    f"""select rk as display_rank, printf('%02d', rk) as rank_text, udi, 'M-' || cast(udi as varchar) as machine,
      {TIER_P} as risk_tier, prob_failure, {PCT_P} as probability_text,
      case when machine_failure = 1 then 'FAILED' else '—' end as actual
    from ranked where rk <= 10""",
    SCORED,
    RANKED,
)

add(
    "machine_options",
    "select rk as position, 'M-' || cast(udi as varchar) as machine from ranked where rk <= 20",
    SCORED,
    RANKED,
)

add(
    "risk_flags",
    f"""select udi, prob_failure, prob_failure >= 0.45::double as at_risk,
      cast(prediction as integer) = machine_failure as correct, {TIER_P} as risk_tier,
      case when prob_failure >= 0.75::double then 'red' when prob_failure >= 0.45::double then 'amber'
        else 'green' end as score_band
    from scored""",
    SCORED,
)

_BAND = "case when {v} >= {a}::double then 'green' when {v} >= {b}::double then 'amber' else 'red' end"
_METRICS = " union all ".join(
    f"select 'metric_{name}', {expr}, {_BAND.format(v=expr, a='0.80', b='0.60')} from rates"
    for name, expr in (("accuracy", "accuracy"), ("precision", "p"), ("recall", "r"), ("f1", F1))
)
add(
    "kpi_status",
    f"""select 'machines_scored' as kpi, n::double as value, 'green' as status from rates
    union all select 'flagged_for_alert', n_at_risk::double,
      case when n_at_risk > 20 then 'red' when n_at_risk > 5 then 'amber' else 'green' end from rates
    union all select 'missed_failures', fn::double, case when fn = 0 then 'green' else 'red' end from rates
    union all select 'model_recall', r, {_BAND.format(v='r', a='0.80', b='0.60')} from rates
    union all select 'model_accuracy', accuracy, {_BAND.format(v='accuracy', a='0.90', b='0.75')} from rates
    union all {_METRICS}""",
    SCORED,
    CELLS,
    RATES,
)

add(
    "tier_counts",
    f"""select t.tier_order, t.risk_tier, count(s.risk_tier) as count
    from (values (1, 'Low'), (2, 'Medium'), (3, 'High')) t(tier_order, risk_tier)
    left join (select {TIER_P} as risk_tier from scored) s on s.risk_tier = t.risk_tier
    group by 1, 2""",
    SCORED,
)

add(
    "tier_failure_rate",
    f"""select risk_tier, count(*) as count, cast(sum(machine_failure) as bigint) as failures,
      sum(machine_failure)::double / count(*)::double as rate
    from (select {TIER_P} as risk_tier, machine_failure from scored)
    where risk_tier is not null group by 1""",
    SCORED,
)

add(
    "threshold_counts",
    """select t.threshold, (select count(*) from scored where prob_failure >= t.threshold) as count
    from (values (0.30::double), (0.50::double), (0.80::double), (0.90::double), (0.95::double)) t(threshold)""",
    SCORED,
)

FLEET = f"""fleet as (
  select 0.45::double as threshold, s.*, {safe('c.correct', 'c.n')} as accuracy, c.p as precision,
    c.r as recall, {F1} as f1
  from (select count(*) as machines,
      count(*) filter (where prob_failure >= 0.45::double) as n_at_risk,
      cast(sum(machine_failure) as bigint) as failures,
      round(avg(prob_failure), 10) as mean_probability, max(prob_failure) as max_probability,
      count(*) filter (where ({TIER_P}) = 'Low') as tier_low,
      count(*) filter (where ({TIER_P}) = 'Medium') as tier_medium,
      count(*) filter (where ({TIER_P}) = 'High') as tier_high,
      count(*) filter (where prediction = 1 and machine_failure = 1) as tp,
      count(*) filter (where prediction = 1 and machine_failure = 0) as fp,
      count(*) filter (where prediction = 0 and machine_failure = 1) as fn,
      count(*) filter (where prediction = 0 and machine_failure = 0) as tn,
      count(*) filter (where prob_failure >= 0.30::double) as above_30,
      count(*) filter (where prob_failure >= 0.50::double) as above_50,
      count(*) filter (where prob_failure >= 0.80::double) as above_80,
      count(*) filter (where prob_failure >= 0.90::double) as above_90,
      count(*) filter (where prob_failure >= 0.95::double) as above_95
    from scored) s, rates c)"""
add(
    "fleet_summary",
    "select *, format('{:,}', machines) as machines_text from fleet",
    SCORED,
    CELLS,
    RATES,
    FLEET,
)


def histogram(bins: int, lo: str, hi: str) -> str:
    return f"""select cast(b.bin as integer) as bin,
      r.lo + b.bin * ((r.hi - r.lo) / {bins}::double) as lower,
      r.lo + (b.bin + 1) * ((r.hi - r.lo) / {bins}::double) as upper,
      count(x.p) as count
    from range({bins}) b(bin)
    cross join (select {lo} as lo, {hi} as hi from scored) r
    left join (select prob_failure as p, least(floor((prob_failure - q.lo) / (q.hi - q.lo) * {bins}::double), {bins - 1}) as bin
      from scored cross join (select {lo} as lo, {hi} as hi from scored) q
      where prob_failure >= q.lo and prob_failure <= q.hi) x on x.bin = b.bin
    group by 1, 2, 3"""


add("score_histogram_30", histogram(30, "min(prob_failure)", "max(prob_failure)"), SCORED)
add("score_histogram_40", histogram(40, "max(0.0::double)", "max(1.0::double)"), SCORED)
add("point_lookup", "select * from scored where udi = 17", SCORED)

# ---- evaluation ----

add(
    "confusion_grouped",
    "select machine_failure, prediction, count(*) as count from scored group by 1, 2",
    SCORED,
)
add("confusion_cells", "select tp, fp, fn, tn from cells", SCORED, CELLS)
add(
    "binary_metrics",
    f"select tp, fp, fn, tn, n as rows, accuracy, p as precision, r as recall, {F1} as f1 from rates",
    SCORED,
    CELLS,
    RATES,
)


def class_report(source: str, y: str, p: str, extra: str = "") -> str:
    return f"""with_pred as (select cast({y} as varchar) as y, cast({p} as varchar) as q from {source}),
  classes as (select y as c from with_pred union select q from with_pred),
  per as (select c, (select count(*) from with_pred where y = c) as support,
      (select count(*) from with_pred where q = c) as predicted,
      (select count(*) from with_pred where y = c and q = c) as hits from classes),
  rated as (select c, support, hits, {safe('hits', 'predicted')} as p, {safe('hits', 'support')} as r from per),
  full_ as (select *, {F1} as f from rated)
  select c as label, round(p, 10) as precision, round(r, 10) as recall, round(f, 10) as f1_score, support{extra} from full_
  union all select 'accuracy', null, null, round(sum(hits)::double / sum(support)::double, 10), cast(sum(support) as bigint){extra} from full_
  union all select 'macro avg', round(avg(p), 10), round(avg(r), 10), round(avg(f), 10), cast(sum(support) as bigint){extra} from full_
  union all select 'weighted avg', round(sum(p * support) / sum(support), 10), round(sum(r * support) / sum(support), 10),
    round(sum(f * support) / sum(support), 10), cast(sum(support) as bigint){extra} from full_"""


ORACLES["classification_report"] = (
    f"with {SCORED},\n" + class_report("scored", "machine_failure", "cast(prediction as integer)")
)
ORACLES["classification_report_labels"] = "with " + class_report("labels", "quality", "toxic")
ORACLES["report_at_threshold"] = f"with {SCORED},\n" + class_report(
    "scored",
    "machine_failure",
    "cast(prob_failure >= 0.6::double as integer)",
    ", 0.6::double as threshold",
)
add(
    "confusion_at_threshold",
    """select count(*) filter (where prob_failure >= 0.6::double and machine_failure = 1) as tp,
      count(*) filter (where prob_failure >= 0.6::double and machine_failure = 0) as fp,
      count(*) filter (where not prob_failure >= 0.6::double and machine_failure = 1) as fn,
      count(*) filter (where not prob_failure >= 0.6::double and machine_failure = 0) as tn,
      0.6::double as threshold from scored""",
    SCORED,
)

CURVE = """curve as (
  select score, pos, n, sum(pos) over w as tp, sum(n) over w as np, sum(pos) over () as tot_pos, sum(n) over () as tot
  from (select prob_failure as score, sum(machine_failure) as pos, count(*) as n from scored group by 1)
  window w as (order by score desc rows unbounded preceding))"""

add(
    "roc_auc",
    """select round(sum((n - pos)::double * (tp::double - pos::double / 2.0::double))
      / max(tot_pos::double * (tot - tot_pos)::double), 10) as roc_auc from curve""",
    SCORED,
    CURVE,
)
add(
    "average_precision",
    """select round(sum((pos::double / tot_pos::double) * (tp::double / np::double)), 10) as average_precision
    from curve""",
    SCORED,
    CURVE,
)
PR = """pr as (
  select score as threshold, tp::double / np::double as precision, tp::double / tot_pos::double as recall,
    cast(tp as bigint) as tp, cast(np as bigint) as selected from curve),
pr_f1 as (select *, 2.0::double * (precision * recall) / (precision + recall + 1e-12::double) as f1 from pr)"""
add("pr_curve", "select * from pr", SCORED, CURVE, PR)
add(
    "best_f1_threshold",
    "select * from pr_f1 order by f1 desc, threshold limit 1",
    SCORED,
    CURVE,
    PR,
)
add(
    "best_f1_threshold_offset",
    """select * from pr_f1 where threshold < (
      select threshold from pr_f1 where threshold > (select min(threshold) from pr_f1)
      order by f1 desc, threshold limit 1)
    order by threshold desc limit 1""",
    SCORED,
    CURVE,
    PR,
)

add(
    "isotonic_curve",
    """select min(x) as first, max(x) as last, value, cast(sum(w) as double) as weight
    from (select b as i, max(low) as value
      from (select a.i as a, b.i as b,
          min((b.ty - a.ty + a.y)::double / (b.tw - a.tw + a.w)::double)
            over (partition by a.i order by b.i desc) as low
        from points a join points b on a.i <= b.i)
      group by b) steps join points using (i)
    group by value""",
    SCORED,
    """points as (
  select *, row_number() over (order by x) as i, sum(y) over (order by x) as ty, sum(w) over (order by x) as tw
  from (select prob_failure as x, sum(machine_failure) as y, count(*) as w from scored group by 1))""",
)

# ---- capacity policies ----


def sweep(ks) -> str:
    values = ", ".join(f"({k})" for k in ks)
    return f"""sweep as (
  select k, count(*) as selected, count(*) filter (where machine_failure = 1) as tp, min(prob_failure) as cutoff_score
  from (values {values}) t(k) join ranked on rk <= k group by k),
totals as (select count(*) as n, cast(sum(machine_failure) as bigint) as pos from scored),
swept as (select k, {safe('tp', 'selected')} as precision, {safe('tp', 'greatest(pos, 1)')} as recall, tp,
    selected - tp as fp, pos - tp as fn, n - pos - selected + tp as tn, cutoff_score,
    (select count(*) from scored where prob_failure >= cutoff_score) as num_ge_cutoff, selected
  from sweep, totals)"""


add("k_sweep", "select * from swept", SCORED, RANKED, sweep([10, 20, 30, 40, 50, 75, 100]))
add(
    "precision_recall_at_k",
    "select k, precision, recall, selected from swept",
    SCORED,
    RANKED,
    sweep([10, 20, 50, 100]),
)
add(
    "capacity_threshold",
    "select k, cutoff_score, selected from swept",
    SCORED,
    RANKED,
    sweep([20]),
)
add(
    "decision_report",
    f"""select k, cutoff_score, selected, num_ge_cutoff, tn, fp, fn, tp,
      precision_0, recall_0, f1_0, support_0, precision_1, recall_1, f1_1, support_1, accuracy,
      (precision_0 + precision_1) / 2.0::double as precision_macro,
      (precision_0 * support_0::double + precision_1 * support_1::double) / n::double as precision_weighted,
      (recall_0 + recall_1) / 2.0::double as recall_macro,
      (recall_0 * support_0::double + recall_1 * support_1::double) / n::double as recall_weighted,
      (f1_0 + f1_1) / 2.0::double as f1_macro,
      (f1_0 * support_0::double + f1_1 * support_1::double) / n::double as f1_weighted
    from (select *, coalesce(2.0::double * precision_0 * recall_0 / nullif(precision_0 + recall_0, 0.0::double), 0.0::double) as f1_0,
        coalesce(2.0::double * precision_1 * recall_1 / nullif(precision_1 + recall_1, 0.0::double), 0.0::double) as f1_1
      from (select *, {safe('tn', 'tn + fn')} as precision_0, {safe('tn', 'tn + fp')} as recall_0,
          {safe('tp', 'tp + fp')} as precision_1, {safe('tp', 'tp + fn')} as recall_1,
          tn + fp as support_0, tp + fn as support_1, tp + fp + fn + tn as n,
          {safe('tp + tn', 'tp + fp + fn + tn')} as accuracy
        from (select * exclude (precision, recall) from swept)))""",
    SCORED,
    RANKED,
    sweep([50]),
)

# ---- ranked alert table ----

ENGINEERED = """engineered as (
  select *, process_temperature_k - air_temperature_k as TempDiff,
    torque_nm * rotational_speed_rpm::double as Torque_x_RPM from labelled)"""
ALERTS = """alerts as (
  select *, "rank" <= 50 as alert_topk
  from (select *, row_number() over (order by p_failure desc nulls last, udi) as "rank" from engineered))"""

add("score_rank_alerts", "select * from alerts", LABELLED, ENGINEERED, ALERTS)
add(
    "alerts_preview",
    'select udi, product_id, p_failure, "rank" from alerts where "rank" <= 10',
    LABELLED,
    ENGINEERED,
    ALERTS,
)
add(
    "scoring_summary",
    """select count(*) as rows, count(*) filter (where alert_topk) as alerts,
      min(p_failure) filter (where alert_topk) as cutoff_score,
      count(*) filter (where p_failure = 1.0::double) as sure_failures,
      count(distinct p_failure) as distinct_scores,
      count(*) filter (where p_failure is null) as missing_scores from alerts""",
    LABELLED,
    ENGINEERED,
    ALERTS,
)
add(
    "filter_scored",
    """select udi, type, p_failure, tool_wear_min, torque_nm, TempDiff from engineered
    where p_failure >= 0.2::double and type in ('error', 'view') and tool_wear_min between 20 and 200
      and torque_nm between 5 and 45 and rotational_speed_rpm between 1200 and 1700 and TempDiff between 8 and 11""",
    LABELLED,
    ENGINEERED,
)
add(
    "filter_alerts_only",
    """select udi, type, p_failure, "rank", alert_topk from alerts where alert_topk and p_failure >= 0.9::double""",
    LABELLED,
    ENGINEERED,
    ALERTS,
)
add("filter_domain_categories", "select distinct type as value from labelled", LABELLED)
add(
    "filter_domain_ranges",
    " union all ".join(
        f"""select '{c}' as "column", min({c})::double as low, max({c})::double as high from engineered"""
        for c in ("tool_wear_min", "torque_nm", "rotational_speed_rpm", "TempDiff")
    ),
    LABELLED,
    ENGINEERED,
)

# ---- cleaning, profile, quality ----

add("sanitize_columns", "select * from raw_text", RAW_TEXT)


def number(column: str) -> str:
    return (
        f"case when not isnan(try_cast({column} as double)) then try_cast({column} as double) end"
    )


INTS = (
    "udi rotational_speed_rpm tool_wear_min machine_failure twf hdf pwf osf rnf".split()
)
CLEAN = f"""clean as (
  select product_id, type, {', '.join(f'try_cast({c} as integer) as {c}' for c in INTS)},
    {', '.join(f'{number(c)} as {c}' for c in ('air_temperature_k', 'process_temperature_k', 'torque_nm'))}
  from raw_text)"""
add("enforce_types", "select * from clean", RAW_TEXT, CLEAN)

CLEAN_ORDER = [
    ("udi", "integer"),
    ("product_id", "varchar"),
    ("type", "varchar"),
    ("air_temperature_k", "double"),
    ("process_temperature_k", "double"),
    ("rotational_speed_rpm", "integer"),
    ("torque_nm", "double"),
    ("tool_wear_min", "integer"),
    *[(c, "integer") for c in ("machine_failure", "twf", "hdf", "pwf", "osf", "rnf")],
]


def lost(name: str, kind: str) -> str:
    # lost: present, and no number of the type once "NaN" counts as missing
    unread = f"try_cast({name} as {kind}) is null"
    if kind == "double":
        unread = f"({unread} or isnan(try_cast({name} as double)))"
    return f"count(*) filter (where {name} is not null and {unread})"


add(
    "cast_losses",
    " union all ".join(
        f"""select '{n}' as "column", {lost(n, k)} as lost from raw_text""" for n, k in CLEAN_ORDER
    ),
    RAW_TEXT,
)
RAW_NAMES = {
    "UDI": "udi",
    "Product ID": "product_id",
    "Type": "type",
    "Air temperature [K]": "air_temperature_k",
    "Process temperature [K]": "process_temperature_k",
    "Rotational speed [rpm]": "rotational_speed_rpm",
    "Torque [Nm]": "torque_nm",
    "Tool wear [min]": "tool_wear_min",
    "Machine failure": "machine_failure",
    "TWF": "twf",
    "HDF": "hdf",
    "PWF": "pwf",
    "OSF": "osf",
}
add(
    "column_check",
    " union all ".join(
        f"""select '{shown}' as "column", 'present' as status, count(*) filter (where {name} is null) as nulls from raw_text"""
        for shown, name in RAW_NAMES.items()
    )
    + """ union all select 'RNF', 'missing', null
    union all select 'Line', 'extra', count(*) filter (where cast(udi as bigint) % 10 = 0) from raw_text""",
    RAW_TEXT,
)
add(
    "null_profile",
    " union all ".join(
        f"""select '{c}' as "column", count(*) filter (where {c} is null) as nulls from joined"""
        for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
    ),
    "joined as (select d.*, l.quality, l.toxic from documents d left join labels l on d.doc_id = l.doc_id)",
)
add(
    "label_distribution",
    """select machine_failure, count(*) as count,
      count(*)::double / (select count(*) from scored)::double as share from scored group by 1""",
    SCORED,
)
add(
    "sensor_range",
    " union all ".join(
        f"""select '{c}' as "column", min({c})::double as low, max({c})::double as high from sensors"""
        for c in (
            "air_temperature_k",
            "process_temperature_k",
            "rotational_speed_rpm",
            "torque_nm",
            "tool_wear_min",
        )
    ),
    SENSORS,
)
add(
    "duplicate_keys",
    """select l_orderkey, l_linenumber, count(*) as count from lineitem group by 1, 2 having count(*) > 1""",
)


def rule(check: str, column: str, value: str, test: str, severity: str, source: str = "clean") -> str:
    return f"""select '{check}' as "check", '{column}' as "column", v::double as value,
      coalesce({test}, false) as passed, '{severity}' as severity from (select {value} as v from {source})"""


def nulls(c: str) -> str:
    return f"count(*) filter (where {c} is null)"


add(
    "quality_report",
    " union all ".join(
        [
            rule("row_count", "*", "count(*)", "v = 10000", "error"),
            *[
                rule("not_null", c, nulls(c), "v = 0", "error")
                for c in ("udi", "type", "machine_failure", "torque_nm")
            ],
            rule(
                "unique",
                "udi",
                "count(*)",
                "v = 0",
                "error",
                "(select udi from clean group by 1 having count(*) > 1)",
            ),
            *[
                rule(
                    "class_present",
                    f"machine_failure={c}",
                    f"count(*) filter (where machine_failure = {c})",
                    "v > 0",
                    "error",
                )
                for c in (0, 1)
            ],
            rule("range_low", "air_temperature_k", "min(air_temperature_k)", "v >= 200", "warn"),
            rule("range_high", "air_temperature_k", "max(air_temperature_k)", "v <= 400", "warn"),
            rule("range_low", "torque_nm", "min(torque_nm)", "v >= 1", "warn"),
            rule("range_high", "torque_nm", "max(torque_nm)", "v <= 40", "warn"),
            *[
                rule("lost_by_cast", n, lost(n, k), "v = 0", "warn", "raw_text")
                for n, k in CLEAN_ORDER
            ],
        ]
    ),
    RAW_TEXT,
    CLEAN,
)
add(
    "quality_duplicates",
    " union all ".join(
        [
            rule("not_empty", "*", "count(*)", "v > 0", "error", "lineitem"),
            rule(
                "unique",
                "l_orderkey,l_linenumber",
                "count(*)",
                "v = 0",
                "error",
                "(select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)",
            ),
        ]
    ),
)

# ---- features and splits ----

add(
    "engineered_features",
    """select udi, machine_failure, type, air_temperature_k, process_temperature_k,
      rotational_speed_rpm::double as rotational_speed_rpm, torque_nm, tool_wear_min::double as tool_wear_min,
      TempDiff, Torque_x_RPM from engineered""",
    LABELLED,
    ENGINEERED,
)
add(
    "class_weights",
    """select machine_failure, count(*) as rows,
      (select count(*) from scored)::double / (2.0::double * count(*)::double) as class_weight
    from scored group by 1""",
    SCORED,
)
_H = KEY_HASH.format(seed=42, key="udi")
add(
    "hash_split",
    f"select udi, {_H} < '33333333333334000000000000000000' as is_test from scored",
    SCORED,
)
ORDERED = f"""ordered as (
  select udi, machine_failure, row_number() over (partition by machine_failure order by {_H}, udi) as rn,
    count(*) over (partition by machine_failure) as n from scored)"""
add(
    "stratified_split",
    "select udi, machine_failure, rn <= floor(n * 0.2::double + 0.5::double) as is_test from ordered",
    SCORED,
    ORDERED,
)
add(
    "stratified_folds",
    """select udi, machine_failure, cast(case when rn <= floor(n * (1.0::double / 3.0::double) + 0.5::double) then 0
      when rn <= floor(n * (1.0::double / 3.0::double + 1.0::double / 3.0::double) + 0.5::double) then 1 else 2 end as integer) as fold
    from ordered""",
    SCORED,
    ORDERED,
)
add("parse_probability", "select udi, prob_failure from scored", SCORED)

# ---- field log and reports ----

add(
    "log_kpis",
    """select count(*) as reports, count(distinct machine_id) as machines,
      count(distinct technician) as technicians from field_log""",
    FIELD_LOG,
)
add(
    "urgency_breakdown",
    """select urgency, count(*) as reports, case when urgency like '%High%' then 'red'
      when urgency like '%Medium%' then 'amber' when urgency like '%Low%' then 'green' else 'neutral' end as status
    from field_log group by 1""",
    FIELD_LOG,
)
add(
    "latest_log",
    """select timestamp, machine_id, technician, urgency, transcript, conv_id, turn from field_log
    order by timestamp desc, conv_id desc, turn desc limit 20""",
    FIELD_LOG,
)
add(
    "log_tail",
    "select * from field_log order by conv_id desc, turn desc limit 10",
    FIELD_LOG,
)
add(
    "log_defaults",
    f"""select report_date as timestamp,
      trim(machine_id, {SPACE}) as machine_id,
      case when technician = 'user' or technician = 'Unknown' then 'Unknown' else technician end as technician,
      '' as urgency, '' as transcript, '' as ai_response, '' as detected_language, '' as source, '' as audio_filename
    from reports where machine_id <> ''""",
    REPORTS,
)


def top_text(k: int) -> str:
    return f"""(select string_agg('M-' || cast(udi as varchar) || ' | ' || {PCT_P} || ' | ' || ({TIER_P}) || ' | '
        || cast(machine_failure as varchar), chr(10) order by rk) from ranked where rk <= {k}) as top_machines"""


def recent_text(n: int) -> str:
    return f"""(select string_agg(timestamp || ' | ' || machine_id || ' | ' || urgency || ' | ' || transcript, chr(10)
        order by conv_id, turn) from (select * from field_log order by conv_id desc, turn desc limit {n})) as recent_reports"""


add(
    "shift_summary",
    f"""select (select count(*) from scored) as machines, 0.45::double as threshold,
      (select count(*) from scored where ({TIER_P}) = 'High') as high_risk,
      (select cast(sum(machine_failure) as bigint) from scored) as failures, tp, fn as missed,
      {top_text(10)}, {recent_text(10)}
    from cells""",
    SCORED,
    RANKED,
    CELLS,
    FIELD_LOG,
)
add(
    "fleet_brief",
    f"select *, {top_text(5)}, {recent_text(5)} from fleet",
    SCORED,
    RANKED,
    CELLS,
    RATES,
    FLEET,
    FIELD_LOG,
)
MACHINES = "machines as (select udi, prob_failure, machine_failure from scored)"
add(
    "machine_reports_exact",
    """select m.udi, m.prob_failure, m.machine_failure, f.conv_id, f.turn, f.urgency
    from machines m left join field_log f on f.machine_id = 'M-' || cast(m.udi as varchar)""",
    SCORED,
    MACHINES,
    FIELD_LOG,
)
add(
    "machine_reports_contains",
    """select m.udi, m.prob_failure, m.machine_failure, f.conv_id, f.turn, f.urgency
    from machines m left join field_log f on contains(f.machine_id, cast(m.udi as varchar))""",
    SCORED,
    MACHINES,
    FIELD_LOG,
)
add(
    "machine_facts",
    f"""select r.udi, 'M-' || cast(r.udi as varchar) as machine, prob_failure, {PCT_P} as probability_text,
      {TIER_P} as risk_tier, case when machine_failure = 1 then 'YES' else 'No' end as failure_recorded,
      (select round(avg(prob_failure), 10) from scored) as fleet_mean, f.conv_id, f.turn, f.urgency
    from ranked r left join field_log f on contains(f.machine_id, cast(r.udi as varchar)) where rk <= 20""",
    SCORED,
    RANKED,
    FIELD_LOG,
)
UNIT = "case when machine_id like 'M-%' then try_cast(substr(machine_id, 3) as bigint) end"
add("machine_label_parse", f"select conv_id, turn, {UNIT} as unit from reports", REPORTS)

VALID = """valid as (
  select * from reports where machine_id <> '' and not (fault_description = '' and root_cause = '' and recommendations = ''))"""
BLANK = f"nullif(case when trim({{c}}, {SPACE}) = '' then '' else {{c}} end, '')"
ROWS = f"""report_lines as (
  select v.conv_id, v.turn, v.machine_id, coalesce({BLANK.format(c='location')}, '—') as location, technician, report_date,
    coalesce({TIER_P}, 'N/A') as risk_tier, coalesce({PCT_P}, 'N/A') as probability_text,
    {BLANK.format(c='fault_description')} as fault_description, {BLANK.format(c='root_cause')} as root_cause,
    {BLANK.format(c='work_performed')} as work_performed, {BLANK.format(c='parts_used')} as parts_used,
    case when downtime_hours <> '0' then downtime_hours || ' hours' end as downtime_hours,
    {BLANK.format(c='recommendations')} as recommendations,
    {BLANK.format(c='next_maintenance_date')} as next_maintenance_date,
    case when length(shift_report) > 300 then substr(shift_report, 1, 300) || '…' else shift_report end as linked_shift_report,
    'maint_report_' || replace(v.machine_id, ' ', '_') || '_' || report_date || '.pdf' as document_name
  from valid v left join scored s on s.udi = ({UNIT.replace('machine_id', 'v.machine_id')}))"""
add("report_rows", "select * from report_lines", SCORED, REPORTS, VALID, ROWS)
add(
    "report_sections",
    " union all ".join(
        f"select conv_id, turn, {i} as position, '{heading}' as heading, {name} as body from report_lines where {name} is not null"
        for i, (heading, name) in enumerate(
            [
                ("Fault Description", "fault_description"),
                ("Root Cause Analysis", "root_cause"),
                ("Work Performed", "work_performed"),
                ("Parts Used", "parts_used"),
                ("Downtime", "downtime_hours"),
                ("Recommendations", "recommendations"),
                ("Next Maintenance Date", "next_maintenance_date"),
                ("LINKED SHIFT REPORT", "linked_shift_report"),
            ],
            start=1,
        )
    ),
    SCORED,
    REPORTS,
    VALID,
    ROWS,
)
add(
    "report_rejects",
    """select conv_id, turn, machine_id, case when machine_id = '' then 'machine id missing'
      else 'no fault, cause or recommendation' end as reason
    from reports where machine_id = '' or (fault_description = '' and root_cause = '' and recommendations = '')""",
    REPORTS,
)


def spoken(column: str) -> str:
    return f"trim(replace(replace(replace(lower({column}), '-', ''), 'udi', ''), 'm', ''), {SPACE})"


_OPTIONS = ", ".join(
    f"({i}, '{o}')" for i, o in enumerate([*URGENCY_LEVELS, *[f"M-{i}" for i in range(20)]])
)
add(
    "option_match",
    f"""select h.conv_id, h.turn, arg_min(o.opt, o.pos) as choice
    from (select conv_id, turn, {spoken("case turn % 3 when 0 then '  the UDI ' || machine_id when 1 then urgency else transcript end")} as heard
      from field_log) h
    left join (select pos, opt, {spoken('opt')} as form from (values {_OPTIONS}) t(pos, opt)) o
      on h.heard <> '' and (contains(h.heard, o.form) or contains(o.form, h.heard))
    group by 1, 2""",
    FIELD_LOG,
)
add(
    "spoken_forms",
    f"select conv_id, turn, {spoken('transcript')} as spoken from field_log",
    FIELD_LOG,
)
add(
    "markup_scrub",
    """select doc_id, replace(replace(replace('## **Note** ' || text || '```', '**', ''), '##', ''), '```', '') as shown
    from documents""",
)
add(
    "extract_report_fields",
    f"""select conv_id, turn,
      case when ok then coalesce(json_extract_string(j, '$.fault_description'), '') else transcript end as fault_description,
      case when ok then coalesce(json_extract_string(j, '$.root_cause'), '') else '' end as root_cause,
      '' as work_performed, '' as parts_used,
      case when ok then coalesce(try_cast(json_extract_string(j, '$.downtime_hours') as double), 0.0::double) else 0.0::double end as downtime_hours,
      '' as recommendations,
      case when ok then coalesce(json_extract_string(j, '$.next_maintenance_date'), '') else '' end as next_maintenance_date,
      case when ok then try_cast(json_extract_string(j, '$.next_maintenance_date') as date) end as next_date,
      ok as json_readable
    from (select *, json_valid(clean) as ok, case when json_valid(clean) then clean::json end as j
      from (select *, trim(replace(replace(extracted, '```json', ''), '```', ''), {SPACE}) as clean
        from (select *, case turn % 4 when 0 then record when 1 then '```json' || chr(10) || record || chr(10) || '```'
            when 2 then transcript else substr(record, 1, 40) end as extracted
          from (select *, cast(json_object('fault_description', transcript, 'root_cause', 'worn seal', 'downtime_hours', turn,
              'next_maintenance_date', case when conv_id % 2 = 0 then '2024-02-11' else 'next week' end) as varchar) as record
            from field_log))))""",
    FIELD_LOG,
)

# ---- sources and sinks ----

add(
    "csv_round_trip",
    "select cast(udi as integer) as udi, machine_failure, prediction, prob_failure from scored",
    SCORED,
)
# a blank CSV field reads back as missing
add(
    "log_round_trip",
    """select timestamp, machine_id, technician, urgency, transcript, null::varchar as ai_response,
      null::varchar as detected_language, cast(conv_id as varchar) || '/' || cast(turn as varchar) as source,
      null::varchar as audio_filename from field_log""",
    FIELD_LOG,
)
add("table_round_trip", "select * from sensors", SENSORS)

add(
    "table_legs",
    """select leg, cast(builds as integer) as builds, cast(count(udi) * times as bigint) as rows, cast(sum(udi) * times as bigint) as udi_sum
    from (values ('build', 1, 1, 1), ('skip', 1, 1, 1), ('rebuild', 2, 2, 1),
      ('overwrite_itself', 2, 6, 1), ('append', 2, 6, 2), ('drop', 2, 0, 1)) t(leg, builds, every, times)
    left join sensors on every > 0 and udi % every = 0
    group by leg, builds, times""",
    SCORED,
    SENSORS,
)

# ---- exact parts of the model stage ----

_SENSORS = ["air_temperature_k", "process_temperature_k", "rotational_speed_rpm", "torque_nm", "tool_wear_min"]
_SLOTS = [*_SENSORS, *(f.lower() for f in ("TWF", "HDF", "PWF", "OSF", "RNF"))]
add(
    "feature_slots",
    " union all ".join(
        f"select udi, machine_failure, {i} as slot, {name}::double as value, '{name}' as name from labelled"
        for i, name in enumerate(_SLOTS)
    )
    + f""" union all select udi, machine_failure, cast({len(_SLOTS)} + t.i as integer) as slot,
      case when l.type = t.type then 1.0::double else 0.0::double end as value, 'features_type_onehot_' || t.type as name
    from labelled l, (select type, row_number() over (order by type) - 1 as i
      from (select distinct type from labelled where type is not null)) t""",
    LABELLED,
)
add(
    "split_inputs",
    """select e.udi, e.machine_failure, e.type, air_temperature_k, process_temperature_k,
      rotational_speed_rpm::double as rotational_speed_rpm, torque_nm, tool_wear_min::double as tool_wear_min,
      TempDiff, Torque_x_RPM, rn <= floor(n * 0.2::double + 0.5::double) as is_test
    from engineered e join ordered o on e.udi = o.udi""",
    LABELLED,
    ENGINEERED,
    ORDERED,
)
