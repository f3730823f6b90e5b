"""DuckDB SQL giving the same rows as the query of the same name."""

from __future__ import annotations


def u(seed: str, key: str) -> str:
    """The hash-uniform number of ``seed`` and the text ``key``."""
    return (
        f"(cast('0x' || substr(md5('{seed}:' || {key}), 1, 8) as ubigint)::double"
        " / 4294967296.0::double)"
    )


def text(key: str) -> str:
    return f"cast({key} as varchar)"


INTERACTIONS = f"""
line_flags as (
  select l_orderkey,
         max(case when l_discount >= 0.09::double then 1 else 0 end) as any_discount,
         max(case when l_quantity >= 48 then 1 else 0 end) as any_bogo
  from lineitem group by l_orderkey),
interactions as (
  select o_orderkey as interaction_id, c_name as name,
         cast(null as varchar) as street_address, n_name as city,
         cast(null as integer) as postcode, cast(null as integer) as phone_number,
         cast(null as varchar) as job,
         cast(datediff('day', cast(o_orderdate as date), date '2002-01-01') // 30 as integer)
           as recency,
         cast(floor(o_totalprice / 1000) as integer) as history,
         coalesce(any_discount, 0) as used_discount, coalesce(any_bogo, 0) as used_bogo,
         r_name as zip_code, cast(c_custkey % 2 as integer) as is_referral,
         c_mktsegment as channel, o_orderpriority as offer,
         case when o_orderstatus <> 'P' then cast({u("y", text("o_orderkey"))} <
           0.05::double + 0.25::double * coalesce(any_discount, 0)
           + 0.15::double * (case when floor(o_totalprice / 1000) >= 250 then 1 else 0 end)
           as integer) end as conversion,
         round({u("s", text("o_orderkey"))}, 6) as score,
         md5(strftime(o_orderdate, '%Y%m')) as batch_id,
         o_orderdate as batch_tms
  from orders
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey
  left join line_flags on l_orderkey = o_orderkey),
scored as (
  select interaction_id, conversion as label, score,
         case when score >= 0.5 then 1 else 0 end as prediction
  from interactions where conversion is not null)
"""

PROBABILITY = "round(value / (value + 25.0::double), 6)"

EVENTS = f"""
predictions as (
  select {text("event_id")} as uuid, 'model-' || {text("user_id % 3")} as model_id,
         ts as predicted_at, {PROBABILITY} as conversion_probability,
         case when {PROBABILITY} >= 0.5 then 1 else 0 end as response_label, event_type
  from events),
truth as (
  select {text("event_id")} as uuid, ts + interval 5 minutes as labelled_at,
         case when event_type = 'purchase' then 1 else 0 end as final_label
  from events where event_type <> 'error'),
flat as (
  select {text("event_id")} as uuid, epoch_us(ts) // 1000 as "startTimeStampMs",
         (epoch_us(ts) + cast(round(value * 1000) as bigint)) // 1000 as "endTimeStampMs",
         case when event_type <> 'error'
              then (case when {PROBABILITY} >= 0.5 then 1 else 0 end) end as metrics_prediction,
         case when event_type <> 'error' then {PROBABILITY} end as metrics_conversion_probability,
         case when event_type in ('purchase', 'click')
              then (case when event_type = 'purchase' then 1 else 0 end) end
           as metrics_final_label,
         case when event_id % 100 = 99 then round(value / 1000, 6) end as metrics_accuracy
  from events)
"""

REGISTRY = f"""
kinds as (
  select *, case event_type when 'purchase' then 'spark_model'
                            when 'signup' then 'spark_pipeline'
                            else 'sklearn_model' end as object_kind
  from events),
named as (
  select *, case when object_kind = 'spark_pipeline' then 'Pipeline'
                 else 'PipelineModel' end as name,
         case when event_id % 3 = 0 then strftime(ts, '%Y-%m-%d %H:%M:%S')
              else strftime(ts, '%Y-%m-%d %H:%M:%S.%f') end as iso
  from kinds),
registry as (
  select object_kind, name,
         'uid=' || name || '_' || substr(md5({text("event_id")}), 1, 12) as object_id,
         date_trunc('hour', ts) as training_time,
         'store/campaign/' || object_kind || '/' || iso as location,
         'run-' || {text("event_id")} as run_id, ts
  from named),
artifacts as (
  select (case when event_type = 'signup' then 'pipeline' else 'bestModel' end) || '_'
         || strftime(date_trunc('day', ts), '%d%m%Y%H%M%S') as artifact
  from events)
"""

FEATURES = (
    "recency, history, used_discount, used_bogo, zip_code, is_referral, channel, offer, score"
)


def over_interactions(sql: str) -> str:
    return f"with {INTERACTIONS} {sql}"


def over_events(sql: str) -> str:
    return f"with {EVENTS} {sql}"


def over_registry(sql: str) -> str:
    return f"with {REGISTRY} {sql}"


def index_of(column: str) -> str:
    return f"""(select {column} as value, cast(row_number() over (
      order by count(*) desc, {column}) - 1 as double) as idx
      from interactions group by {column})"""


INDEXED = (
    f"join {index_of('zip_code')} z on z.value = zip_code"
    f" join {index_of('channel')} c on c.value = channel"
    f" join {index_of('offer')} o on o.value = offer"
)
REQUEST_ERROR = "case when interaction_id % 97 = 0 then 'no JSON object' end"
HELD_OUT = f"conversion is not null and {u('1', text('interaction_id'))} >= 0.8"
JUDGED = over_interactions(
    "select conversion as label, count(*) as rows, count(*) as valid_predictions,"
    " count(*) as valid_scores, true as tells_apart"
    f" from interactions where {HELD_OUT} group by 1"
)


def grid(first: str, firsts: list[int], second: str, seconds: list[int]) -> str:
    points = [(a, b) for a in firsts for b in seconds]
    values = ", ".join(f"({i}, {a}, {b}, true)" for i, (a, b) in enumerate(points))
    return f"select * from (values {values}) t(point, {first}, {second}, valid_metric)"


REPORT = """
classes as (select 0 as class union all select 1),
per_class as (
  select class,
         count(*) filter (where label = class) as support,
         count(*) filter (where prediction = class) as predicted,
         count(*) filter (where label = class and prediction = class) as hits
  from scored, classes group by class),
report as (
  select class, support, hits,
         case when predicted > 0 then hits / predicted::double else 0 end as precision,
         case when support > 0 then hits / support::double else 0 end as recall,
         case when support + predicted > 0
              then 2 * hits / (support + predicted)::double else 0 end as f1
  from per_class)
"""

ROC = """
points as (
  select score as threshold, count(*) filter (where label = 1) as pos,
         count(*) filter (where label = 0) as neg
  from scored group by score),
running as (
  select threshold, pos, neg,
         cast(sum(pos) over w as bigint) as true_positives,
         cast(sum(neg) over w as bigint) as false_positives,
         cast(sum(pos) over () as bigint) as p, cast(sum(neg) over () as bigint) as n
  from points
  window w as (order by threshold desc rows unbounded preceding))
"""

PROFIT = f"""
thresholds as (select i / 10.0::double as threshold from range(10) as r(i)),
curve as (
  select threshold,
         sum(100.0::double * label - 10.0::double) as blast_profit,
         coalesce(sum(100.0::double * label - 10.0::double)
                  filter (where score >= threshold), 0) as targeted_profit
  from scored, thresholds group by threshold)
"""

MINORITY = "minority as (select * from interactions where conversion = 1)"


def neighbours(k: int, block: str) -> str:
    return f"""
{MINORITY},
pairs as (
  select a.interaction_id, b.interaction_id as neighbour_id,
         cast((a.recency - b.recency) ** 2 + (a.history - b.history) ** 2 as double) as dist2
  from minority a join minority b on a.interaction_id <> b.interaction_id {block}),
ranked as (
  select *, cast(row_number() over (
    partition by interaction_id order by dist2, neighbour_id) as integer) as rank
  from pairs qualify rank <= {k})
"""


IN_BLOCK = "and a.zip_code = b.zip_code and a.channel = b.channel and a.offer = b.offer"

_copy = text("interaction_id") + " || ':' || " + text("copy")


def _between(column: str) -> str:
    return f"round(m.{column} + d.gap * (b.{column}::double - m.{column}), 6) as {column}"


SYNTHETIC = f"""
{neighbours(5, IN_BLOCK)},
sizes as (select interaction_id, count(*) as size from ranked group by interaction_id),
draws as (
  select interaction_id, cast(copy as integer) as copy,
         floor({u("smote-pick", _copy)} * size) + 1 as pick, {u("smote-gap", _copy)} as gap
  from sizes, range(1, 3) as r(copy)),
synthetic as (
  select d.interaction_id, d.copy, r.neighbour_id, m.zip_code, m.channel, m.offer,
         {_between("recency")}, {_between("history")}, {_between("score")}, 1 as label
  from draws d
  join ranked r on r.interaction_id = d.interaction_id and r.rank = d.pick
  join minority m on m.interaction_id = d.interaction_id
  join minority b on b.interaction_id = r.neighbour_id)
"""


_NUMBERS = ("recency", "history", "used_discount", "used_bogo", "is_referral")
_CATEGORIES = ("zip_code", "channel", "offer")


def _slot(column: str) -> str:
    """What a row adds to a squared distance by its category, one over the slot's variance."""
    return f"""(select {column}, n * (n - 1.0::double) / (m * (n - m)) as w_{column} from (
      select {column}, count(*) as m, sum(count(*)) over () as n from interactions group by 1))"""


_vector_distance = " + ".join(
    [f"case when a.{c} = b.{c} then 0 else a.w_{c} + b.w_{c} end" for c in _CATEGORIES]
    + [f"(a.s_{c} - b.s_{c}) ** 2" for c in _NUMBERS]
)
SYNTHETIC_VECTORS = f"""
scaled as (
  select *, {", ".join(
      f"({c} - avg({c}) over ()) / stddev_samp({c}) over () as s_{c}" for c in _NUMBERS)}
  from interactions {" ".join(f"join {_slot(c)} using ({c})" for c in _CATEGORIES)}),
minority as (select * from scaled where conversion = 1),
pairs as (
  select a.interaction_id, b.interaction_id as neighbour_id,
         round({_vector_distance}, 9) as dist2
  from minority a join minority b on a.interaction_id <> b.interaction_id),
ranked as (
  select *, row_number() over (partition by interaction_id order by dist2, neighbour_id) as rank
  from pairs qualify rank <= 5),
sizes as (select interaction_id, count(*) as size from ranked group by interaction_id),
draws as (
  select interaction_id, cast(copy as integer) as copy,
         floor({u("smote-pick", _copy)} * size) + 1 as pick, {u("smote-gap", _copy)} as gap
  from sizes, range(1, 3) as r(copy))
select d.interaction_id, d.copy, r.neighbour_id, 1 as conversion, {", ".join(
    f"round(m.s_{c} + gap * (b.s_{c} - m.s_{c}), 6) as {c}_scaled" for c in _NUMBERS)}
from draws d
join ranked r on r.interaction_id = d.interaction_id and r.rank = d.pick
join minority m on m.interaction_id = d.interaction_id
join minority b on b.interaction_id = r.neighbour_id
"""


def blocks(rows: str, group: str = "") -> str:
    partition = f"partition by {group}" if group else ""
    keys = f"{group}, " if group else ""
    return f"""
ordered as (
  select *, (row_number() over ({partition} order by predicted_at, uuid) - 1) // 100 as block
  from ({rows})),
blocks as (
  select {keys}block, min(predicted_at) as started_at, max(predicted_at) as ended_at,
         round(avg(case when final_label = response_label then 1.0::double else 0 end), 6)
           as accuracy
  from ordered group by {keys}block having count(*) = 100)
"""


JOINED = "select p.*, final_label from predictions p join truth using (uuid)"
OUTCOME = """select *, case when event_type = 'purchase' then 1 else 0 end as final_label
  from predictions"""

COLUMN_ROLES = "\nunion all ".join(
    f"select {i} as position, '{c}' as column_name, '{t}' as data_type, '{r}' as role,"
    f" count({c}) as non_null_rows from interactions"
    for i, (c, t, r) in enumerate(
        [
            ("recency", "int", "numeric"),
            ("history", "int", "numeric"),
            ("used_discount", "int", "numeric"),
            ("used_bogo", "int", "numeric"),
            ("zip_code", "string", "categorical"),
            ("is_referral", "int", "numeric"),
            ("channel", "string", "categorical"),
            ("offer", "string", "categorical"),
            ("score", "double", "other"),
            ("conversion", "int", "target"),
        ]
    )
)


def _scaled(column: str) -> str:
    return (
        f"round(({column} - avg({column}) over ()) / stddev_samp({column}) over (), 6)"
        f" as {column}_scaled"
    )


ORACLES = {
    "scan_csv": over_interactions(
        "select "
        + ", ".join(
            f"{text(c)} as {c}"
            for c in ("interaction_id", "name", "recency", "history", "channel", "conversion")
        )
        + " from interactions"
    ),
    "scan_csv_infer": over_interactions(
        "select interaction_id, name, recency, history, channel, score, conversion"
        " from interactions"
    ),
    "scan_interactions": over_interactions("select * from interactions"),
    "scan_projected": over_interactions(f"select {FEATURES}, conversion from interactions"),
    "peek": over_interactions(
        f"select interaction_id, {FEATURES} from interactions order by interaction_id limit 10"
    ),
    "column_roles": over_interactions(COLUMN_ROLES),
    "ensure_table": over_interactions(
        "select batch_id, count(*) as rows, count(conversion) as labelled"
        " from interactions group by batch_id"
    ),
    "append_interactions": over_interactions(
        "select * replace (round(cast(cast(score as float) as double), 4) as score),"
        " strftime(batch_tms, '%Y-%m-01') as batch_month from interactions"
    ),
    "stamp_batch": over_interactions(
        f"select interaction_id, {FEATURES}, conversion, 'historical' as batch_id,"
        " timestamp '2024-02-01' as batch_tms from interactions"
    ),
    "ingest_batch": over_interactions(
        f"select interaction_id, {FEATURES}, cast(null as integer) as conversion,"
        " 'batch-1' as batch_id, timestamp '2024-02-01' as batch_tms from interactions"
        " order by md5('0:' || cast(interaction_id as varchar)), interaction_id limit 1000"
    ),
    "registry_append": over_registry("select * exclude (ts) from registry"),
    "registry_list": over_registry("select * exclude (ts) from registry"),
    "registry_latest": over_registry(
        "select * exclude (ts) from registry qualify row_number() over ("
        "partition by object_kind order by training_time desc, length(run_id) desc, run_id desc) = 1"
    ),
    "artifact_list": over_registry("select distinct artifact from artifacts"),
    "artifact_latest": over_registry(
        "select distinct artifact, strptime(right(artifact, 14), '%d%m%Y%H%M%S') as created_at"
        " from artifacts where contains(artifact, 'pipeline')"
        " qualify rank() over (order by created_at desc) = 1"
    ),
    "metrics_flatten": over_events("select * from flat"),
    "metrics_long": over_events(
        "select uuid, replace(name, 'metrics_', '') as metric, round(number, 6) as number from ("
        "select uuid, cast(metrics_prediction as double) as metrics_prediction,"
        " cast(metrics_conversion_probability as double) as metrics_conversion_probability,"
        " cast(metrics_final_label as double) as metrics_final_label,"
        " cast(metrics_accuracy as double) as metrics_accuracy from flat"
        ") unpivot (number for name in (metrics_prediction, metrics_conversion_probability,"
        " metrics_final_label, metrics_accuracy))"
    ),
    "metrics_snapshot": over_events("select * from flat"),
    "lineage_edges": """
      select 'classifier ' || strftime(ts, '%d%m%Y%H%M%S') as model_name,
             unnest(case when event_type in ('purchase', 'signup')
               then ['default.customer_interactions', 'default.labels']
               else ['default.customer_interactions'] end) as table_name,
             event_type as trigger
      from events""",
    "label_rename": over_interactions(
        f"select interaction_id, {FEATURES}, conversion as label from interactions"
    ),
    "cast_int": f"""
      select o_orderkey, cast(trunc(o_totalprice) as integer) as history_text,
             cast(trunc(o_totalprice / 1000) as integer) as history,
             cast(trunc({u("s", text("o_orderkey"))} * 10) as integer) as score,
             try_cast(o_orderpriority as integer) as not_a_number
      from orders""",
    "vectorize": over_interactions(
        "select interaction_id, recency::double as f0, history::double as f1,"
        " used_discount::double as f2, used_bogo::double as f3, is_referral::double as f4,"
        " conversion as label from interactions where conversion is not null"
    ),
    "class_filter": over_interactions(
        "select interaction_id, recency, history, used_discount, used_bogo, is_referral,"
        " conversion as label from interactions where conversion = 1"
    ),
    "location_normalize": over_registry(
        "select run_id, location, 'store/campaign/' || object_kind || '/'"
        " || strftime(ts, '%d%m%Y%H%M%S') as normalized from registry"
    ),
    "labelled_only": over_interactions(
        f"select interaction_id, {FEATURES}, conversion as label from interactions"
        " where conversion is not null"
    ),
    "parse_requests": over_interactions(
        "select cast(interaction_id as varchar) as request_id, "
        + ", ".join(
            f"case when interaction_id % 97 <> 0 then {c}::double end as {c}"
            for c in "recency history used_discount used_bogo is_referral score".split()
        )
        + f", {REQUEST_ERROR} as error from interactions"
    ),
    "delayed_labels": over_events(
        "select p.* exclude (event_type), labelled_at, final_label"
        " from predictions p join truth using (uuid)"
    ),
    "awaiting_labels": over_events(
        "select * exclude (event_type) from predictions"
        " where uuid not in (select uuid from truth)"
    ),
    "knn_minority": over_interactions(
        f", {neighbours(5, IN_BLOCK)} select interaction_id, rank, neighbour_id, dist2 from ranked"
    ),
    "knn_minority_unblocked": over_interactions(
        f", {neighbours(3, '')} select interaction_id, rank, neighbour_id, dist2 from ranked"
    ),
    "knn_vectors": """
      with pairs as (
        select a.vec_id, b.vec_id as neighbour_id, round(list_sum(list_transform(
          list_zip(a.embedding, b.embedding), lambda p: (p[1]::double - p[2]::double) ** 2)), 9)
            as dist2
        from embeddings a join embeddings b on a.vec_id <> b.vec_id)
      select vec_id, neighbour_id, round(dist2, 6) as dist2, cast(row_number() over (
        partition by vec_id order by dist2, neighbour_id) as integer) as rank
      from pairs qualify rank <= 5""",
    "class_balance": over_interactions(
        'select conversion, count(*) as "count" from interactions group by conversion'
    ),
    "binary_guard": over_interactions("select count(distinct label) as classes from scored"),
    "confusion_matrix": over_interactions(
        "select label, count(*) filter (where prediction = 0) as pred_neg,"
        " count(*) filter (where prediction = 1) as pred_pos from scored group by label"
    ),
    "confusion_matrix_t": over_interactions(
        "select prediction, count(*) filter (where label = 0) as neg,"
        " count(*) filter (where label = 1) as pos from scored group by prediction"
    ),
    "class_report": over_interactions(
        f", {REPORT} select class, round(precision, 6) as precision, round(recall, 6) as recall,"
        " round(f1, 6) as f1, support from report"
    ),
    "class_report_summary": over_interactions(
        f""", {REPORT}, totals as (
          select cast(sum(support) as bigint) as support, sum(hits) / sum(support) as accuracy,
                 avg(precision) as mp, avg(recall) as mr, avg(f1) as mf,
                 sum(precision * support) / sum(support) as wp,
                 sum(recall * support) / sum(support) as wr,
                 sum(f1 * support) / sum(support) as wf
          from report)
        select 'accuracy' as row, round(accuracy, 6) as precision, round(accuracy, 6) as recall,
               round(accuracy, 6) as f1, support from totals
        union all select 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), support from totals
        union all select 'weighted avg', round(wp, 6), round(wr, 6), round(wf, 6), support
        from totals"""
    ),
    "eval_metrics": over_interactions(
        f""", {REPORT} select round(sum(hits) / sum(support), 6) as accuracy,
          round(sum(f1 * support) / sum(support), 6) as f1,
          round(sum(precision * support) / sum(support), 6) as weighted_precision,
          round(sum(recall * support) / sum(support), 6) as weighted_recall
        from report"""
    ),
    "auc_hard": over_interactions(
        "select round((1 + avg(prediction) filter (where label = 1)"
        " - avg(prediction) filter (where label = 0)) / 2, 6) as auc_hard from scored"
    ),
    "auc_score": over_interactions(
        f", {ROC} select round(sum(neg::double * (true_positives - pos / 2.0::double))"
        " / (max(p)::double * max(n)::double), 6) as auc_score from running"
    ),
    "roc_points": over_interactions(
        f", {ROC} select threshold, true_positives, false_positives,"
        " round(true_positives / p::double, 6) as tpr,"
        " round(false_positives / n::double, 6) as fpr from running"
    ),
    "profit_curve": over_interactions(f", {PROFIT} select * from curve"),
    "profit_best": over_interactions(
        f", {PROFIT} select *, targeted_profit - blast_profit as uplift from curve"
        " order by uplift desc, threshold limit 1"
    ),
    "block_accuracy": over_events(f", {blocks(JOINED)} select * from blocks"),
    "accuracy_drift": over_events(
        f", {blocks(JOINED)}, lagged as (select block, accuracy,"
        " lag(accuracy) over (order by block) as previous_accuracy from blocks)"
        " select *, round(accuracy - previous_accuracy, 6) as drift from lagged"
    ),
    "string_index": over_interactions(
        'select interaction_id, zip_code, channel, offer, z.idx as "zip_code_StringIndex",'
        ' c.idx as "channel_StringIndex", o.idx as "offer_StringIndex"'
        f" from interactions join {index_of('zip_code')} z on z.value = zip_code"
        f" join {index_of('channel')} c on c.value = channel"
        f" join {index_of('offer')} o on o.value = offer"
    ),
    "latest_n": over_interactions(
        f"select interaction_id, {FEATURES}, conversion, batch_tms from interactions"
        " order by batch_tms desc, interaction_id limit 1000"
    ),
    "latest_n_train": over_interactions(
        f"select interaction_id, {FEATURES}, conversion as label, batch_tms from interactions"
        " where conversion is not null order by batch_tms desc, interaction_id limit 5000"
    ),
    "hash_split": over_interactions(
        "select interaction_id, recency, history, conversion,"
        f" case when {u('1', text('interaction_id'))} < 0.8 then 1 else 0 end as is_train"
        " from interactions"
    ),
    "sample_n": over_interactions(
        f"select interaction_id, {FEATURES} from interactions"
        " order by md5('0:' || cast(interaction_id as varchar)), interaction_id limit 1000"
    ),
    "undersample": over_interactions(
        "select interaction_id, recency, history, conversion as label from interactions"
        f" where conversion = 1 or (conversion = 0 and {u('under', text('interaction_id'))} < 0.5)"
    ),
    "fold_assign": over_interactions(
        "select interaction_id, conversion,"
        f" cast(floor({u('fold', text('interaction_id'))} * 5) as integer) as fold"
        " from interactions"
    ),
    "smote": over_interactions(f", {SYNTHETIC} select * from synthetic"),
    "smote_vector": over_interactions(f", {SYNTHETIC_VECTORS}"),
    "smote_union": over_interactions(
        f""", {SYNTHETIC}
        select interaction_id, 0 as copy, zip_code, channel, offer, recency::double as recency,
               history::double as history, score, conversion as label
        from interactions where conversion = 1
           or (conversion = 0 and {u("smote-under", text("interaction_id"))} < 0.5)
        union all select * exclude (neighbour_id) from synthetic"""
    ),
    "ts_suffix": "select event_id, strftime(ts, '%d%m%Y%H%M%S') as suffix from events",
    "ts_parse": over_registry(
        "select run_id, case when position('.' in location) > 0 then ts"
        " else date_trunc('second', ts) end as from_iso,"
        " date_trunc('second', ts) as from_suffix,"
        " cast(null as timestamp) as from_other_text from registry"
    ),
    "metric_times": over_events(
        """select uuid, "startTimeStampMs", "endTimeStampMs",
          make_timestamp("startTimeStampMs" * 1000) as started_at,
          make_timestamp("endTimeStampMs" * 1000) as ended_at,
          ("endTimeStampMs" - "startTimeStampMs") * 1000 as processing_micros,
          (("endTimeStampMs" - "startTimeStampMs") * 1000) % 1000000 * 1000 as processing_time
        from flat"""
    ),
    "epoch_ms": "select event_id, epoch_us(ts) // 1000 as ts_ms from events",
    "path_parts": over_registry(
        """select run_id, split_part(location, '/', 1) as root,
          split_part(location, '/', 3) as folder, split_part(location, '/', -1) as leaf,
          cast(null as varchar) as missing, name as uid_name,
          split_part(object_id, '_', 2) as uid_code,
          'store/models/' || strftime(training_time, '%d%m%Y%H%M%S') as artifact_path
        from registry"""
    ),
    "uid_strip": over_registry("select run_id, substr(object_id, 5) as uid from registry"),
    "hash_uniform": f"""
      select o_orderkey,
             round({u("demo", text("o_orderkey") + " || ':' || " + text("o_custkey"))}, 9) as u
      from orders""",
    "threshold_label": over_events(
        "select uuid, model_id, predicted_at, conversion_probability, response_label"
        " from predictions"
    ),
    "json_field": """
      select event_id, regexp_extract(props, '"k": *([0-9]+)', 1) as k_text,
             cast(regexp_extract(props, '"k": *([0-9]+)', 1) as bigint) as k
      from events""",
    "one_hot": over_interactions(
        "select interaction_id, channel, "
        + ", ".join(f"case when idx = {i} then 1.0::double else 0 end as c{i}" for i in range(5))
        + f" from interactions join {index_of('channel')} on value = channel"
    ),
    "standard_scale": over_interactions(
        "select interaction_id, recency, history, score, "
        + ", ".join(_scaled(c) for c in ("recency", "history", "score"))
        + " from interactions"
    ),
    "feature_pipeline": over_interactions(
        "select interaction_id, 20 as width, "
        + " || ".join(
            f"list_aggregate([case when {t}.idx = i then '1' else '0' end for i in range(5)],"
            " 'string_agg', '')"
            for t in "zco"
        )
        + " as one_hot, "
        + ", ".join(
            _scaled(c)
            for c in ("recency", "history", "used_discount", "used_bogo", "is_referral")
        )
        + f" from interactions {INDEXED}"
    ),
    "metric_series": over_events(
        'select uuid, "startTimeStampMs", metrics_conversion_probability,'
        ' row_number() over (order by "startTimeStampMs", uuid) as position'
        " from flat where metrics_conversion_probability is not null"
    ),
    "metric_series_accuracy": over_events(
        'select uuid, "startTimeStampMs", metrics_accuracy,'
        ' row_number() over (order by "startTimeStampMs", uuid) as position'
        " from flat where metrics_accuracy is not null"
    ),
    "metric_series_processing_time": over_events(
        'select uuid, "startTimeStampMs",'
        ' ("endTimeStampMs" - "startTimeStampMs") * 1000 as processing_micros,'
        ' row_number() over (order by "startTimeStampMs", uuid) as position from flat'
    ),
    "metrics_tail_unpivot": over_events(
        """, tail as (
          select * from flat order by "startTimeStampMs" desc, uuid desc limit 5),
        numbered as (
          select *, cast(row_number() over (order by "startTimeStampMs", uuid) as integer)
            as position from tail)
        """
        + " union all ".join(
            f"select position, uuid, '{c}' as metric, cast(\"{c}\" as double) as value from numbered"
            for c in (
                "startTimeStampMs",
                "endTimeStampMs",
                "metrics_prediction",
                "metrics_conversion_probability",
                "metrics_final_label",
                "metrics_accuracy",
            )
        )
    ),
    "stream_ingest": over_interactions(
        f"select interaction_id, {FEATURES}, cast(null as integer) as conversion,"
        " 'stream-0' as batch_id, timestamp '2024-02-01' as batch_tms from interactions"
    ),
    "stream_delayed_labels": over_events(
        "select p.* exclude (event_type), labelled_at, final_label"
        " from predictions p join truth using (uuid)"
    ),
    "stream_accuracy": over_events(
        f""", days as (
          select date_trunc('day', predicted_at) as started_at, count(*) as responses,
                 round(avg(case when final_label = response_label then 1.0::double else 0 end), 6)
                   as accuracy
          from ({OUTCOME}) group by 1)
        select cast(started_at as timestamp) as started_at,
               cast(started_at as timestamp) + interval 1 day as ended_at, responses, accuracy
        from days
        where started_at + interval 1 day <= (select max(ts) from events) - interval 1 hour"""
    ),
    "stream_block_accuracy": over_events(
        f", {blocks(OUTCOME, 'model_id')} select * from blocks"
    ),
    **{k: JUDGED for k in ("train_rf", "train_gbt", "train_gbt_oversampled", "train_rf_serving")},
    "holdout_predictions": JUDGED,
    "cv_grid": grid('"numTrees"', [10, 20, 30], '"maxDepth"', [5, 10]),
    "cv_grid_boosted": grid('"maxIter"', [3, 6], '"maxDepth"', [2, 10]),
    "score_batch": over_interactions(
        ", known as (select * from interactions where conversion is not null), newest as ("
        "select * from interactions order by batch_tms desc, interaction_id limit 1000) select "
        + ", ".join(f"{c}::float as {c}" for c in ("recency", "history"))
        + ", used_discount::float as used_discount, used_bogo::float as used_bogo, zip_code,"
        " is_referral::float as is_referral, channel, offer,"
        " round(score::float::double, 4) as score, conversion::float as label,"
        ' z.idx::float as "zip_code_StringIndex", c.idx::float as "channel_StringIndex",'
        ' o.idx::float as "offer_StringIndex", true as valid_prediction from newest '
        + INDEXED.replace("from interactions", "from known")
    ),
    "score_requests": over_interactions(
        f"select cast(interaction_id as varchar) as request_id, {REQUEST_ERROR} as error,"
        " case when interaction_id % 97 <> 0 then true end as valid_prediction,"
        " case when interaction_id % 97 <> 0 then true end as valid_probability"
        " from interactions"
    ),
    "ml_save_load": over_interactions(
        f"select count(*) as rows, 0 as disagreements from interactions where {HELD_OUT}"
    ),
    "stream_score": over_interactions(
        "select count(*) as rows, 0 as disagreements from interactions"
    ),
    "retrain": over_interactions(
        "select *, (select least(1000, count(*)) from interactions) as scored from (values"
        " ('spark_pipeline', 'run-1', timestamp '2024-02-01 00:00:00'),"
        " ('spark_model', 'run-2', timestamp '2024-02-01 01:00:00'))"
        " t(object_kind, run_id, training_time)"
    ),
}
