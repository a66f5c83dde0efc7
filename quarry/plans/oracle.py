"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark operators (plain windows, self joins,
``row_number``) over the same tables; literals come from the same constants.
Derived doubles are rounded with ``round(x + 1e-9, 6)`` as in ``queries.r6``.
"""

from __future__ import annotations

from quarry.functions.digest import feature_set_digest
from quarry.plans import queries as Q
from quarry.sources import tables as tb

_TRAIN_F = 1.0 - Q.VAL_FRACTION - Q.TEST_FRACTION
_TRAINVAL_F = 1.0 - Q.TEST_FRACTION
_STABLE_VAL_F = _TRAIN_F + Q.VAL_FRACTION


def R(x: str) -> str:
    return f"round(({x}) + 1e-9, 6)"


W_ROWS = "(partition by user_id order by ts, event_id rows between unbounded preceding and current row)"
W_ORD = "(partition by user_id order by ts, event_id)"
SCORE = "round(1 / (1 + exp(-(value - 40) / 30)), 3)"
SCORE_CH = "round(1 / (1 + exp(-(value - 45) / 25)), 3)"
TRUTH = "(event_type in ('error', 'purchase'))::INTEGER"
HASH60 = "('0x' || substr(md5({x}), 1, 15))"
LAB = ("select d.doc_id, d.n_chars, d.lang, d.source, l.quality::INTEGER as label "
       "from documents d join labels l using (doc_id) where l.quality is not null")
MODEL = "'model_' || (user_id % 4)::VARCHAR"


def _s(col: str) -> str:
    return f"coalesce('s' || length({col})::VARCHAR || ':' || {col}, '\\N')"


def _n(col: str) -> str:
    return f"coalesce('n' || ({col})::VARCHAR, '\\N')"


EVENT_ENC = ("concat_ws('|', " + ", ".join([_n("event_id"), _n("user_id"), _s("event_type"),
                                            _n("value::DECIMAL(18,2)"), _n("1 + event_id % 12")]) + ")")
DOC_ENC = ("concat_ws('|', " + ", ".join([_n("doc_id"), _n("n_chars"), _s("lang"), _s("source"),
                                          _n("label")]) + ")")
DOC_FEAT_ENC = "concat_ws('|', " + ", ".join([_n("n_chars"), _s("lang"), _s("source")]) + ")"

EXPANDING = f"""
select event_id, user_id, count(*) over w as exp_count,
  {R('avg(value) over w')} as exp_mean, {R('stddev_pop(value) over w')} as exp_std,
  {R('max(value) over w')} as exp_max
from events window w as {W_ROWS}
"""

RATIO = f"""
select event_id, {R('case when avg(value) over w <> 0 then value / avg(value) over w else 1.0 end')} as value_ratio
from events window w as {W_ROWS}
"""

OUTLIER = f"""
select event_id, value > 2.0 * avg(value) over w as above_2x_mean from events window w as {W_ROWS}
"""

LAST_K = f"""
with e as (select event_id, user_id, value, (1 + event_id % 12)::INTEGER as k,
                  row_number() over {W_ORD} as rn from events)
select a.event_id, a.k, {R('sum(b.value)')} as last_k_sum
from e a join e b on a.user_id = b.user_id and b.rn between a.rn - a.k + 1 and a.rn
group by a.event_id, a.k
"""

RECENCY = f"""
select event_id, {R('(epoch_us(ts) - epoch_us(lag(ts) over w)) / 6e7')} as minutes_since_prev
from events window w as {W_ORD}
"""

POS = ("-33 + (event_id * 7919 % 3200) / 1e2 as lat, -73 + (event_id * 104729 % 3900) / 1e2 as lon")

DISTANCE = f"""
with e as (select *, {POS} from events)
select event_id, {R('sqrt(power(lat - lag(lat) over w, 2) + power(lon - lag(lon) over w, 2)) * 111.0')} as dist_prev_km
from e window w as {W_ORD}
"""

PRIOR_COUNT = f"select event_id, row_number() over {W_ORD} - 1 as prior_count from events"

ALL = f"""
with e as (select *, {POS}, (1 + event_id % 12)::INTEGER as k, row_number() over {W_ORD} as rn from events),
lk as (select a.event_id, sum(b.value) as s from e a join e b on a.user_id = b.user_id
       and b.rn between a.rn - a.k + 1 and a.rn group by a.event_id),
f as (select e.event_id, e.user_id, e.value, e.rn,
        avg(value) over w as m, stddev_pop(value) over w as sd, max(value) over w as mx,
        (epoch_us(ts) - epoch_us(lag(ts) over w2)) / 6e7 as mins,
        sqrt(power(lat - lag(lat) over w2, 2) + power(lon - lag(lon) over w2, 2)) * 111.0 as dist
      from e window w as {W_ROWS}, w2 as {W_ORD})
select f.event_id, f.user_id, f.rn as exp_count, f.rn - 1 as prior_count,
  {R('m')} as exp_mean, {R('sd')} as exp_std, {R('mx')} as exp_max,
  {R('case when m <> 0 then f.value / m else 1.0 end')} as value_ratio,
  {R('mins')} as minutes_since_prev, {R('dist')} as dist_prev_km, {R('lk.s')} as last_k_sum,
  f.value > 2.0 * m as above_2x_mean
from f join lk using (event_id)
"""

WINDOW_COUNTS = """
select event_id,
  count(*) over (partition by user_id order by ts range between interval '1 hour' preceding and current row) as cnt_1h,
  count(*) over (partition by user_id order by ts range between interval '24 hours' preceding and current row) as cnt_24h,
  count(*) over (partition by user_id order by ts range between interval '7 days' preceding and current row) as cnt_7d
from events
"""

_W24 = "(partition by user_id order by ts range between interval '24 hours' preceding and current row)"
_W30 = "(partition by user_id order by ts range between interval '30 days' preceding and current row)"
WINDOW_VALUES = f"""
select event_id, {R(f'sum(value) over {_W24}')} as sum_24h, {R(f'avg(value) over {_W30}')} as mean_30d,
  {R(f'stddev_pop(value) over {_W30}')} as std_30d, {R(f'max(value) over {_W30}')} as max_30d
from events
"""

def R2(x: str) -> str:
    return f"round(({x}) + 1e-5, 2)"


_O90 = "(partition by o_custkey order by o_orderdate range between interval '90 days' preceding and current row)"
_O365 = "(partition by o_custkey order by o_orderdate range between interval '365 days' preceding and current row)"
ORDER_WINDOW_VALUES = f"""
with o as (select o_orderkey, o_custkey, o_orderdate, case when o_orderkey % 97 = 0 then {tb.ABSURD} else
             o_totalprice + case when o_orderdate >= timestamp '{tb.LIFTED_FROM}' then {tb.LEVEL} else 0.0 end end::double as amount from orders),
f as (select o_orderkey, count(amount) over {_O90} as n_90d, max(amount) over {_O90} < {tb.ABSURD} as sane_90d,
        max(amount) over {_O365} < {tb.ABSURD} as sane_365d, sum(amount) over {_O90} as s, avg(amount) over {_O365} as m, stddev_pop(amount) over {_O365} as d from o)
select o_orderkey, n_90d, sane_90d, sane_365d, case when sane_90d then {R2('s')} end as sum_90d,
  case when sane_365d then {R2('m')} end as mean_365d, case when sane_365d then {R2('d')} end as std_365d from f
"""

LAST_K_ORDERS = f"""
with o as (select o_orderkey, o_custkey, o_totalprice, case when o_orderkey % 50 = 0 then 1000000 else 1 + o_orderkey % 40 end::INTEGER as k,
             row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn from orders)
select a.o_orderkey, a.k, {R2('sum(b.o_totalprice)')} as last_k_sum
from o a join o b on a.o_custkey = b.o_custkey and b.rn between a.rn - a.k + 1 and a.rn group by a.o_orderkey, a.k
"""

LEARNER_QUALITY = """
with d as (select *, case when doc_id % 11 = 0 then null else n_chars > 1500 end as long_text
           from documents join (select doc_id, quality from labels where quality is not null) using (doc_id))
select count(*)::bigint as n_rows, true as beats_prior, true as probabilities, 300::bigint as n_trees,
  (1 + count(distinct lang) + count(distinct source) + count(distinct coalesce(long_text::varchar, '?')))::bigint as n_features,
  1.0::double as importance_total from d
"""

ROW_SAMPLE = f"""
with d as (select doc_id, source, n_chars, quality is not null as labelled from documents left join labels using (doc_id)),
r as (select *, row_number() over (partition by source, labelled order by md5('{Q.SEED}:' || doc_id::varchar), doc_id) as rn from d)
select doc_id, source, labelled, n_chars from r where rn <= 5
"""

P95 = f"""
with q as (select event_id, value, quantile_cont(value, 0.95) over
  (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding) as p from events)
select event_id, {R('p')} as prior_p95, coalesce(value > p, false) as above_prior_p95 from q
"""

CALENDAR = "select event_id, hour(ts)::INTEGER as hour, dayname(ts) as weekday from events"

_LATEST = """
with f as (select event_id, user_id, ts, count(*) over w as exp_count, avg(value) over w as m
           from events {where} window w as {w})
select user_id, event_id, ts, exp_count, {r} as exp_mean from
  (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from f) where rn = 1
"""
ONLINE_LATEST = _LATEST.format(where="", w=W_ROWS, r=R("m"))
SNAPSHOT_ASOF = _LATEST.format(where=f"where ts <= TIMESTAMP '{Q.CUTOFF}'", w=W_ROWS, r=R("m"))

FEATURE_LOOKUP = f"""
with f as (select o_custkey, o_orderkey, o_orderdate, count(*) over w as exp_count, avg(o_totalprice) over w as m,
             row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
           from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey
                                    rows between unbounded preceding and current row))
select c.c_custkey as o_custkey, f.o_orderkey, f.o_orderdate, f.exp_count, {R('f.m')} as exp_mean
from customer c left join (select * from f where rn = 1) f on f.o_custkey = c.c_custkey
"""

_ORDER_LABELS = ("select o_orderkey, o_custkey, o_orderdate as event_ts, "
                 "o_orderdate + to_days((2 + o_orderkey % 5)::INTEGER) as label_ts, "
                 "o_orderstatus = 'F' as label from orders")
DELAYED = _ORDER_LABELS

ASOF = f"""
with lab as ({_ORDER_LABELS}),
m as (select o.o_orderkey, o.o_custkey, o.o_orderdate, l.o_orderkey as label_order, l.label_ts, l.label,
        row_number() over (partition by o.o_orderkey order by l.label_ts desc nulls last,
                           l.o_orderkey desc nulls last) as rn
      from orders o left join lab l on l.o_custkey = o.o_custkey and l.label_ts <= o.o_orderdate)
select o_orderkey, o_custkey, o_orderdate, label_order as l_label_order, label_ts as l_label_ts, label as l_label
from m where rn = 1
"""

ASOF_AVAILABLE = """
with lab as (select o_orderkey as label_order, o_custkey, case when o_orderkey % 17 <> 0 then o_orderdate end as event_ts,
        case when o_orderkey % 19 <> 0 then o_orderdate + to_days((o_orderkey * 7 % 700)::INTEGER) end as available_ts,
        o_orderstatus = 'F' as label from orders),
lft as (select o_orderkey, o_custkey, case when o_orderkey % 13 <> 0 then o_orderdate end as as_of,
        case when o_orderkey % 11 <> 0 then o_orderdate + to_days((o_orderkey * 13 % 600 - 100)::INTEGER) end as cutoff from orders),
m as (select f.*, l.label_order as l_label_order, l.available_ts as l_available_ts, l.label as l_label,
        row_number() over (partition by f.o_orderkey order by l.event_ts desc nulls last, l.label_order desc nulls last) as rn
      from lft f left join lab l on l.o_custkey = f.o_custkey and l.event_ts <= f.as_of and l.available_ts <= f.cutoff)
select o_orderkey, o_custkey, as_of, cutoff, l_label_order, l_available_ts, l_label from m where rn = 1
"""

_PRED = (f"select event_id, user_id, ts as prediction_timestamp, (1 + event_id % 3)::VARCHAR as model_version, "
         f"{SCORE} as score, value from events")
_TRUTH_T = (f"select event_id, {TRUTH} as truth from events "
            f"where ts + to_days((2 + event_id % 5)::INTEGER) <= TIMESTAMP '{Q.TRUTH_CUTOFF}'")
PRED_TRUTH = f"""
with p as ({_PRED}), t as ({_TRUTH_T})
select p.event_id, p.model_version, p.score, p.value, t.truth from p left join t using (event_id)
"""

LABELED = LAB
UNLABELED = ("select d.doc_id, d.n_chars, d.lang, d.source from documents d left join labels l using (doc_id) "
             "where l.quality is null")
CLASS_BALANCE = f"select label, count(*) as n_rows from ({LAB}) group by label"

LABEL_ASSIGN = f"""
select event_id, case when u < 0.45 then true when u < 0.9 then false else null end as label
from (select event_id, {HASH60.format(x="'42:' || event_id::VARCHAR")}::UBIGINT::DOUBLE / pow(2.0, 60) as u
      from events)
"""

NEW_LABELS = f"""
with lab as (select *, doc_id % 3 as v from ({LAB}))
select doc_id, label from lab where v <= 2 and doc_id not in (select doc_id from lab where v <= 1)
"""

_SPLIT = f"""
with h as (select *, {HASH60.format(x="'42:' || doc_id::VARCHAR")}::UBIGINT as hv from ({LAB})),
r as (select *, row_number() over (partition by label order by hv, doc_id) as rk,
             count(*) over (partition by label) as n from h)
select *, case when rk <= floor(n * {_TRAIN_F!r}::DOUBLE + 0.5) then 'train'
               when rk <= floor(n * {_TRAINVAL_F!r}::DOUBLE + 0.5) then 'validation'
               else 'test' end as split
from r
"""
STRATIFIED = f"select doc_id, label, split from ({_SPLIT})"
STABLE = f"""
select doc_id, case when u < {_TRAIN_F!r}::DOUBLE then 'train' when u < {_STABLE_VAL_F!r}::DOUBLE then 'validation'
                    else 'test' end as split
from (select doc_id, {HASH60.format(x="'42:' || doc_id::VARCHAR")}::UBIGINT::DOUBLE / pow(2.0, 60) as u from ({LAB}))
"""
SPLIT_COUNTS = f"select split, label, count(*) as n_rows from ({_SPLIT}) group by split, label"
SPLIT_MANIFEST = f"""
select split, count(*) as n_rows, sum({HASH60.format(x=DOC_ENC)}::HUGEINT)::VARCHAR as digest_sum
from ({_SPLIT}) group by split
"""

_SCORED = f"select event_id, user_id, {SCORE} as score, {TRUTH} as truth from events"
_CONF = """select sum(case when score >= 0.5 and truth = 1 then 1 else 0 end)::BIGINT as tp,
  sum(case when score >= 0.5 and truth = 0 then 1 else 0 end)::BIGINT as fp,
  sum(case when score < 0.5 and truth = 1 then 1 else 0 end)::BIGINT as fn,
  sum(case when score < 0.5 and truth = 0 then 1 else 0 end)::BIGINT as tn"""
_PRF = (f"{R('coalesce(tp / nullif(tp + fp, 0), 0)')} as precision, "
        f"{R('coalesce(tp / nullif(tp + fn, 0), 0)')} as recall, "
        f"{R('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)')} as f1")
THRESHOLD = f"with s as ({_SCORED}), c as ({_CONF} from s) select tp, fp, fn, tn, {_PRF} from c"


def _rank_cte(src: str, group: str = "") -> str:
    g = f"{group}, " if group else ""
    part = f"partition by {group} " if group else ""
    return f"""g as (select {g}score, sum(truth) as pos, count(*) - sum(truth) as neg from ({src}) group by {g}score),
r as (select *, sum(pos) over (w) as cum_pos, sum(pos + neg) over (w) as cum_n
      from g window w as ({part}order by score desc)),
k as (select {g}sum(pos * cum_pos / cum_n) / nullif(sum(pos), 0) as ap,
             case when sum(pos) > 0 and sum(neg) > 0
                  then sum(neg * (cum_pos - pos + pos / 2.0)) / (sum(pos) * sum(neg)) end as auc
      from r {'group by ' + group if group else ''})"""


AVG_PRECISION = f"with {_rank_cte(_SCORED)} select {R('coalesce(ap, 0)')} as average_precision from k"
ROC_AUC = f"with {_rank_cte(_SCORED)} select {R('auc')} as roc_auc from k"

_LL = ("avg(case when (score >= 0.5)::INTEGER = truth then 1.0 else 0.0 end) as accuracy, "
       "avg(-(truth * ln(least(greatest(score, 1e-15), 1 - 1e-15)) + "
       "(1 - truth) * ln(1 - least(greatest(score, 1e-15), 1 - 1e-15)))) as log_loss")
LOGLOSS = f"with s as ({_SCORED}), a as (select {_LL} from s) select {R('accuracy')} as accuracy, {R('log_loss')} as log_loss from a"

EVALUATE = f"""
with s as ({_SCORED}), c as ({_CONF} from s), m as (select {_PRF} from c), {_rank_cte(_SCORED)}
select {R('coalesce(ap, 0)')} as average_precision, f1, precision, recall, {R('auc')} as roc_auc from m, k
"""

_AP_OF = lambda score: f"with {_rank_cte(f'select {score} as score, {TRUTH} as truth from events')} select coalesce(ap, 0) as ap from k"
CHAMP_CHALL = f"""
with ch as ({_AP_OF(SCORE_CH)}), cp as ({_AP_OF(SCORE)})
select 'average_precision' as metric_name, {R('ch.ap')} as challenger_score, {R('cp.ap')} as champion_score,
       ch.ap > cp.ap as promoted from ch, cp
"""

_LL_OF = lambda score: f"select {_LL} from (select {score} as score, {TRUTH} as truth from events)"
GATE = f"""
with ch as ({_LL_OF(SCORE_CH)}), cp as ({_LL_OF(SCORE)})
select {R('ch.accuracy - cp.accuracy')} as accuracy_gain, {R('ch.log_loss - cp.log_loss')} as log_loss_increase,
  ch.accuracy - cp.accuracy >= 0.002 as accuracy_ok, ch.log_loss - cp.log_loss <= 0.2 as log_loss_ok,
  (ch.accuracy - cp.accuracy >= 0.002) and (ch.log_loss - cp.log_loss <= 0.2) as promote
from ch, cp
"""

_ALIAS_EV = (f"select {MODEL} as model_name, case when event_type in ('purchase', 'click') then 'champion' "
             "else 'challenger' end as alias, (1 + event_id % 9)::VARCHAR as version, ts as event_ts, "
             "event_id as seq from events")
_ALIAS_CUR = (f"select model_name, alias, version from (select *, row_number() over (partition by model_name, alias "
              f"order by event_ts desc, seq desc) as rn from ({_ALIAS_EV})) where rn = 1")
ALIAS_CURRENT = _ALIAS_CUR
TAGS_CURRENT = f"""
select model_name, version, key, value from (
  select *, row_number() over (partition by model_name, version, key order by event_ts desc, seq desc) as rn
  from (select {MODEL} as model_name, (1 + event_id % 9)::VARCHAR as version, event_type as key, props as value,
               ts as event_ts, event_id as seq from events)) where rn = 1
"""
VERSION_FOR_RUN = f"""
select {MODEL} as model_name, 'run_' || (event_id % 50)::VARCHAR as run_id, max(event_id::VARCHAR::BIGINT) as version
from events group by all
"""

_AP_BY_MODEL = lambda score: (
    f"with {_rank_cte(f'select {MODEL} as model_name, {score} as score, {TRUTH} as truth from events', 'model_name')} "
    "select model_name, coalesce(ap, 0) as ap from k")
PROMOTION = f"""
with ch as ({_AP_BY_MODEL(SCORE_CH)}), cp as ({_AP_BY_MODEL(SCORE)}), al as ({_ALIAS_CUR}),
champ as (select model_name, version as champion_version from al where alias = 'champion'),
chall as (select model_name, version as challenger_version from al where alias = 'challenger')
select ch.model_name, champ.champion_version, chall.challenger_version, {R('ch.ap')} as challenger_score,
  {R('cp.ap')} as champion_score, coalesce(ch.ap > cp.ap, true) as promoted,
  case when coalesce(ch.ap > cp.ap, true) then chall.challenger_version else champ.champion_version end
    as new_champion_version
from ch left join cp using (model_name) left join champ using (model_name) left join chall using (model_name)
"""

AUDIT = f"""
with p as (select {MODEL} as model_name, (1 + event_id % 3)::VARCHAR as model_version, ts from events),
per as (select model_name, model_version, count(*) as n_predictions, max(ts) as last_prediction_ts
        from p group by all),
mv as (select {MODEL} as model_name, (1 + event_id % 3)::VARCHAR as model_version, 'run_' || max(event_id)::VARCHAR as run_id,
              max(event_id) % 4 as snapshot_version from events where event_id % 3 < 2 group by 1, 2),
h as (select event_id % 3 as snapshot_version, count(*) as n from events group by 1),
hist as (select snapshot_version, sum(n) over (order by snapshot_version)::BIGINT as snapshot_rows from h),
pl as (select {MODEL} as model_name, (1 + event_id % 3)::VARCHAR as model_version, max(ts) as promoted_ts
       from events where event_type = 'purchase' and value > 40 group by 1, 2),
al as ({_ALIAS_CUR}),
a as (select model_name, version as model_version, array_to_string(list_sort(list(distinct alias)), ',') as aliases
      from al group by all)
select per.model_name, per.model_version, 'models:/' || per.model_name || '/' || per.model_version as model_uri,
       run_id, snapshot_version, snapshot_rows, promoted_ts, n_predictions, last_prediction_ts,
       coalesce(a.aliases, '') as aliases
from per left join mv using (model_name, model_version) left join hist using (snapshot_version)
     left join pl using (model_name, model_version) left join a using (model_name, model_version)
"""

IMPUTE_MEDIAN = f"""
with e as (select event_id, case when event_id % 7 = 0 then null else value end as v from events)
select event_id, {R('coalesce(v, (select median(v) from e))')} as value_imputed from e
"""

_DOCS_NULL = """select doc_id, n_chars, lang, source,
  case when doc_id % 7 = 0 then null else lang end as lang_null,
  case when doc_id % 11 = 0 then null else source end as source_null,
  case when doc_id % 5 = 0 then null else n_chars > 5000 end as long_doc from documents"""


def _mode(col: str, src: str) -> str:
    return (f"select {col} as m from ({src}) where {col} is not null group by {col} "
            f"order by count(*) desc, {col} limit 1")


IMPUTE_MODE = f"""
with d as ({_DOCS_NULL})
select doc_id, coalesce(lang_null, ({_mode('lang_null', _DOCS_NULL)})) as lang_imputed,
       coalesce(source_null, ({_mode('source_null', _DOCS_NULL)})) as source_imputed from d
"""

VOCAB = """
select column_name, value, (row_number() over (partition by column_name order by value) - 1)::INTEGER as slot
from (select distinct 'lang' as column_name, lang as value from documents
      union all select distinct 'source', source from documents)
"""

ORDER_CODES = """
with o as (select o_orderkey, 'merchant_' || o_orderkey::VARCHAR as merchant,
        'merchant_' || case when o_orderkey % 13 <> 0 then o_custkey end::VARCHAR as customer, o_orderstatus from orders),
cells as (select o_orderkey, 'merchant' as column_name, merchant as value from o union all select o_orderkey, 'customer', customer from o
          union all select o_orderkey, 'o_orderstatus', o_orderstatus from o),
v as (select column_name, value, row_number() over (partition by column_name order by value) - 1 as slot
      from (select distinct column_name, value from cells where o_orderkey % 5 <> 0 and value is not null))
select c.o_orderkey, c.column_name, v.slot::INTEGER as slot from cells c join v using (column_name, value)
"""

_FIT = f"select * from ({_DOCS_NULL}) where lang <> 'fr'"
_ENC = (f"coalesce(lang_null, ({_mode('lang_null', _FIT)})) as lang_c, "
        f"coalesce(source_null, ({_mode('source_null', _FIT)})) as source_c, "
        "coalesce(lower(long_doc::VARCHAR), '__null__') as long_c")
ONE_HOT = f"""
with fi as (select {_ENC} from ({_FIT})),
vocab as (
  select 'lang_null' as column_name, value, row_number() over (order by value) - 1 as slot
    from (select distinct lang_c as value from fi)
  union all select 'source_null', value, row_number() over (order by value) - 1 from (select distinct source_c as value from fi)
  union all select 'long_doc', value, row_number() over (order by value) - 1 from (select distinct long_c as value from fi)),
ti as (select doc_id, {_ENC} from ({_DOCS_NULL})),
t as (select doc_id, 'lang_null' as column_name, lang_c as value from ti
      union all select doc_id, 'source_null', source_c from ti
      union all select doc_id, 'long_doc', long_c from ti)
select t.doc_id, t.column_name, v.slot::INTEGER as slot from t join vocab v using (column_name, value)
"""

FEATURE_MATRIX = """
with v_lang as (select lang, row_number() over (order by lang) - 1 as r from (select distinct lang from documents)),
v_src as (select source, row_number() over (order by source) - 1 as r from (select distinct source from documents)),
n_lang as (select count(*) as n from v_lang)
select doc_id, 0::INTEGER as slot, n_chars::DOUBLE as value from documents where n_chars <> 0
union all
select d.doc_id, (1 + l.r)::INTEGER, 1.0::DOUBLE from documents d join v_lang l using (lang)
union all
select d.doc_id, (1 + (select n from n_lang) + s.r)::INTEGER, 1.0::DOUBLE from documents d join v_src s using (source)
"""

_P = Q.BATCH_PROVENANCE
BATCH_SCORE = f"""
with u as ({UNLABELED}),
s as (select *, round(1 / (1 + exp(-(ln(n_chars::DOUBLE) - 7.3))), 3) as score from u)
select TIMESTAMP '{_P.prediction_timestamp}' as prediction_timestamp, '{_P.model_name}' as model_name,
  '{_P.model_alias}' as model_alias, '{_P.model_version}' as model_version,
  '{_P.model_source_run_id}' as model_source_run_id, '{_P.feature_table}' as feature_table,
  '{_P.feature_table_version}' as feature_table_version, '{_P.feature_table_timestamp}' as feature_table_timestamp,
  '{feature_set_digest(Q.DOC_SPEC.features)}' as feature_set_digest, doc_id, score as fraud_probability,
  score >= 0.5 as predicted_label, case when score >= 0.5 then 'fraud' else 'not_fraud' end as predicted_class,
  md5({DOC_FEAT_ENC}) as feature_vector_digest
from s
"""

VERIFY_SCORED = f"""
with u as ({UNLABELED})
select doc_id, case when doc_id % 10 < 2 then '0' when doc_id % 10 < 8 then '1' when doc_id % 10 = 8 then '5' end as feature_table_version,
  case when doc_id % 10 >= 8 then 'no_version' when doc_id % 10 = 1 then 'feature_set' when doc_id % 10 = 7 then 'no_row'
       when doc_id % 10 = 3 then 'changed' else 'ok' end as verdict
from u
"""

SCORING_JOB = f"""
with u as ({UNLABELED})
select doc_id, 'doc_quality' as model_name, 'champion' as model_alias, '1' as model_version, 'run_1' as model_source_run_id,
  'documents' as feature_table, '0' as feature_table_version, '{feature_set_digest(Q.DOC_SPEC.features)}' as feature_set_digest,
  md5({DOC_FEAT_ENC}) as feature_vector_digest, true as is_probability, true as label_follows, true as class_follows,
  (select count(*) from u) as rows_written
from u
"""

ROW_DIGEST = f"select event_id, md5({EVENT_ENC}) as row_digest from events"
DATASET_DIGEST = f"""
select event_type, count(*) as n_rows, sum({HASH60.format(x=EVENT_ENC)}::HUGEINT)::VARCHAR as digest_sum,
  '{feature_set_digest(Q.ROW_DIGEST_COLS)}' as columns_digest
from events group by event_type
"""
FEATURE_SET_DIGEST = f"""
select count(*) as n_rows, (select sha256('["' || string_agg(column_name, '","' order by column_index) || '"]')
  from duckdb_columns() where table_name = 'events') as feature_set_digest from events
"""

SNAPSHOT_RESOLVE = """
select v as version, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as committed_ts
from (select event_id % 3 as v, max(ts) as ts from events group by 1) order by v desc limit 1
"""
SNAPSHOT_READ = "select event_id, user_id, value from events where event_id % 3 <= 1"

_RAW = """select event_id, user_id, event_type, value,
  try_cast(regexp_extract(props, '"k":\\s*(-?\\d+)', 1) as INTEGER) as k from events"""
CLEAN = f"select * from ({_RAW}) where k is not null and value > 0 and k between 0 and 89"
QUARANTINE = f"""
select reason, count(*) as n_rows from (
  select case when k is null then 'cast' when not (value > 0 and k between 0 and 89) then 'rule' end as reason
  from ({_RAW})) where reason is not null group by reason
"""

PRED_MONITOR = f"""
select model_version, count(*) as n_predictions, {R('avg(score)')} as mean_score,
  max(prediction_timestamp) as last_prediction_ts from ({_PRED}) group by model_version
"""

_JOINED = f"select p.model_version, p.score, t.truth from ({_PRED}) p join ({_TRUTH_T}) t using (event_id)"
MONITOR_PERF = f"""
with s as ({_JOINED}),
c as (select model_version, {_CONF.replace('select ', '')} from s group by model_version),
m as (select model_version, {_PRF} from c),
{_rank_cte(_JOINED, 'model_version')}
select model_version, {R('coalesce(ap, 0)')} as average_precision, f1, precision, recall, {R('auc')} as roc_auc
from m join k using (model_version)
"""

_PROF = """select '{c}' as column_name, count(*) as n_rows, {nr} as null_rate, {mn} as min_value, {mx} as max_value,
  {me} as mean_value, count(distinct x) as n_distinct from (select {expr}::DOUBLE as x from events)"""


def _prof(c: str, expr: str) -> str:
    return _PROF.format(c=c, expr=expr, nr=R("(count(*) - count(x)) / count(*)"), mn=R("min(x)"),
                        mx=R("max(x)"), me=R("avg(x)"))


PROFILE = " union all ".join([_prof("value", "value"),
                              _prof("value_null", "case when event_id % 7 = 0 then null else value end"),
                              _prof("user_id", "user_id")])

_BIN = " + ".join(f"(value >= {e!r})::INTEGER" for e in Q.PSI_EDGES[1:-1])
_PSI = f"""
with e as (select value, case when ts < TIMESTAMP '{Q.DRIFT_SPLIT}' then 'baseline' else 'current' end as period
           from events),
c as (select case when value is null then -1 else {_BIN} end as bin,
             sum((period = 'baseline')::INTEGER) as nb, sum((period = 'current')::INTEGER) as nc from e group by 1),
t as (select sum(nb) as tb, sum(nc) as tc from c),
s as (select greatest(nb / tb, 1e-6) as p, greatest(nc / tc, 1e-6) as q from c, t)
select sum((q - p) * ln(q / p)) as psi from s
"""
PSI = f"select 'value' as column_name, {R('psi')} as psi, psi > 0.2 as drift from ({_PSI})"
_EDGES = "list_sort(list_distinct(quantile_cont({c}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])))"
DRIFT_BY_COLUMN = f"""
with e as (select ts < TIMESTAMP '{Q.DRIFT_SPLIT}' as early, value, case when event_id % 7 <> 0 then value end as value_null, event_type,
        user_id::VARCHAR as "user" from events),
x as (select early, case when early then value else value * 1.5 end as value, value_null,
        case when early or event_type <> 'error' then event_type end as event_type, "user" from e),
k as (select {_EDGES.format(c='value')} as ev, {_EDGES.format(c='value_null')} as en from x where early),
cells as (
  select early, 'value' as column_name, len(list_filter(ev, lambda b: b <= value))::VARCHAR as bin from x, k
  union all select early, 'value_null', case when value_null is null then 'none' else len(list_filter(en, lambda b: b <= value_null))::VARCHAR end from x, k
  union all select early, 'event_type', coalesce('v' || event_type, 'none') from x
  union all select early, 'user', coalesce('v' || "user", 'none') from x),
c as (select column_name, bin, count(*) filter (where early) as n, count(*) filter (where not early) as m from cells group by 1, 2),
t as (select column_name, sum(n)::BIGINT as n_base, sum(m)::BIGINT as n_cur from c group by 1),
s as (select column_name, n_base, n_cur, greatest(n / n_base, 1e-6) as p, greatest(m / n_cur, 1e-6) as q from c join t using (column_name))
select column_name, n_base, n_cur, {R('sum((q - p) * ln(q / p))')} as psi, sum((q - p) * ln(q / p)) > 0.2 as drift
from s group by 1, 2, 3
"""
RETRAIN = f"""
with n as (select count(*) as n_new_labels from ({NEW_LABELS})), d as ({_PSI})
select n_new_labels, n_new_labels >= 30 as enough_new_labels, coalesce(psi > 0.2, false) as drift_detected,
  n_new_labels >= 30 or coalesce(psi > 0.2, false) as retrain from n, d
"""

RETRAIN_LABELS = f"""
select count(*) as n_new_labels, count(*) >= 30 as enough_new_labels, count(*) >= 30 as retrain from ({NEW_LABELS})
"""

ORACLE = {
    "feat_expanding": EXPANDING,
    "feat_ratio": RATIO,
    "feat_outlier_flag": OUTLIER,
    "feat_last_k_sum": LAST_K,
    "feat_recency": RECENCY,
    "feat_distance": DISTANCE,
    "feat_prior_count": PRIOR_COUNT,
    "feat_all": ALL,
    "feat_window_counts": WINDOW_COUNTS,
    "feat_window_values": WINDOW_VALUES,
    "row_sample": ROW_SAMPLE,
    "learner_quality": LEARNER_QUALITY,
    "feat_order_window_values": ORDER_WINDOW_VALUES,
    "feat_last_k_orders": LAST_K_ORDERS,
    "feat_p95_flag": P95,
    "calendar_features": CALENDAR,
    "online_latest": ONLINE_LATEST,
    "feature_snapshot_asof": SNAPSHOT_ASOF,
    "feature_lookup": FEATURE_LOOKUP,
    "delayed_labels": DELAYED,
    "asof_label_join": ASOF,
    "asof_available_labels": ASOF_AVAILABLE,
    "prediction_truth_join": PRED_TRUTH,
    "labeled_rows": LABELED,
    "unlabeled_rows": UNLABELED,
    "class_balance": CLASS_BALANCE,
    "label_assign": LABEL_ASSIGN,
    "new_labels": NEW_LABELS,
    "stratified_split": STRATIFIED,
    "stable_split": STABLE,
    "split_counts": SPLIT_COUNTS,
    "split_manifest": SPLIT_MANIFEST,
    "threshold_metrics": THRESHOLD,
    "average_precision": AVG_PRECISION,
    "roc_auc": ROC_AUC,
    "logloss_accuracy": LOGLOSS,
    "evaluate_model": EVALUATE,
    "champion_challenger_eval": CHAMP_CHALL,
    "promotion_gate": GATE,
    "alias_current": ALIAS_CURRENT,
    "tags_current": TAGS_CURRENT,
    "registry_version_for_run": VERSION_FOR_RUN,
    "promotion_decision": PROMOTION,
    "audit_trail": AUDIT,
    "impute_median": IMPUTE_MEDIAN,
    "impute_mode": IMPUTE_MODE,
    "category_vocab": VOCAB,
    "order_codes": ORDER_CODES,
    "one_hot": ONE_HOT,
    "feature_matrix": FEATURE_MATRIX,
    "batch_score": BATCH_SCORE,
    "verify_scored": VERIFY_SCORED,
    "scoring_job": SCORING_JOB,
    "row_digest": ROW_DIGEST,
    "dataset_digest": DATASET_DIGEST,
    "feature_set_digest": FEATURE_SET_DIGEST,
    "snapshot_resolve": SNAPSHOT_RESOLVE,
    "snapshot_read": SNAPSHOT_READ,
    "clean_ingest": CLEAN,
    "clean_quarantine": QUARANTINE,
    "prediction_monitor": PRED_MONITOR,
    "monitor_performance": MONITOR_PERF,
    "feature_profile": PROFILE,
    "feature_drift_psi": PSI,
    "drift_by_column": DRIFT_BY_COLUMN,
    "retrain_trigger": RETRAIN,
    "retrain_by_labels": RETRAIN_LABELS,
}
