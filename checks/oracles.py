"""SQL counterparts of the registered queries, over the same whole tables.

They work on plain columns and ``event_id`` arithmetic and do not parse JSON, so they do
not repeat the logic they check. Epoch millis are ``epoch_us // 1000``: rounding down.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# ---------------------------------------------------------------- inputs

CL = """
cl as (select user_id, event_type, value, props,
              case event_type when 'signup' then 'I' when 'error' then 'D' else 'U' end as op,
              ts, event_id as seq
       from events)"""

SLOTS = CL + """,
sl as (select user_id, seq % 16 as slot, user_id || '/' || (seq % 16) as k, event_type, value, props, op, ts, seq from cl)"""

MERGE = SLOTS + """,
tgt as (select user_id, slot, k, event_type, value, props from
        (select *, row_number() over (partition by k order by ts desc, seq desc) rn
         from sl where ts < timestamp '2024-01-15 00:00:00') x where rn = 1 and op <> 'D'),
batch as (select * from sl where ts >= timestamp '2024-01-15 00:00:00'),
net as (select * from (select *, row_number() over
        (partition by k order by ts desc, seq desc) rn from batch) x where rn = 1),
lk as (select * from (select *, row_number() over
       (partition by k, op order by ts desc, seq desc) rn from batch) x where rn = 1)"""

ROW = "user_id, slot, event_type, value, props"

# Faults of the feed lines by event number, first match wins.
LINES = """
src as (select event_id, ts, user_id, value, epoch_us(ts) as us, epoch_us(ts) // 1000 as ms,
               user_id::varchar as uid,
               case event_type when 'signup' then 'I' when 'error' then 'D' else 'U' end as op
        from events),
txt as (select *, '{"key":'
   || case when event_id % 29 = 0 then 'null'
           when event_id % 31 = 0 then '{"uid":"' || uid || '"}' else '{"id":"' || uid || '"}' end
   || ',"' || case when event_id % 23 = 0 then 'payload' else 'value' end || '":{"op":"'
   || case when event_id % 37 = 0 then 'x' else lower(op) end || '",'
   || case when event_id % 61 = 0 then ''
           else '"ts_ms":' || ms || ',"ts_us":' || us || ',"ts_ns":' || us * 1000 || ',' end
   || '"' || case when (op = 'D') <> (event_id % 41 = 0) then 'before' else 'after' end || '":{"id":'
   || case when event_id % 43 = 0 then uid else '"' || uid || '"' end
   || case when event_id % 47 = 0 then '' when event_id % 53 = 0 then ',"v":null'
           when event_id % 59 = 0 then ',"v":"text"' else ',"v":' || value::varchar end
   || case when event_id % 71 = 0 then ',"extra":1' else '' end || '}}}' as full_line
   from src),
lines as (select *,
   case when event_id % 17 = 0 then left(full_line, 20) when event_id % 19 = 0 then '' else full_line end as line,
   case when event_id % 17 = 0 then 'malformed_json'
        when event_id % 19 = 0 then 'blank'
        when event_id % 23 = 0 then 'missing_envelope' else 'ok' end as outer_reason
   from txt),
judged as (select *,
   case when outer_reason <> 'ok' then outer_reason
        when event_id % 29 = 0 then 'null_key'
        when event_id % 31 = 0 then 'key_mismatch'
        when event_id % 37 = 0 then 'unknown_op'
        when event_id % 41 = 0 then 'null_image'
        when event_id % 61 = 0 then 'null_order'
        when event_id % 43 = 0 or event_id % 47 = 0 or event_id % 53 = 0 or event_id % 59 = 0
        then 'schema_violation' else 'ok' end as reason,
   case when event_id % 17 = 0 or event_id % 19 = 0 or event_id % 29 = 0 then null
        when event_id % 31 = 0 then '{"uid":"' || uid || '"}' else '{"id":"' || uid || '"}' end as key_text,
   -- an unknown operation is no delete, so it looks for the image under "after"
   outer_reason = 'ok' and ((event_id % 37 = 0 and (op = 'D') = (event_id % 41 = 0))
                            or (event_id % 37 <> 0 and event_id % 41 <> 0)) as has_image
   from lines)"""

LETTERS = LINES + """,
puts as (select coalesce(key_text, sha256(line)) as dlq_key, line, reason, ts from judged
         where reason not in ('ok', 'blank')
         union all
         select key_text, line, 'undelivered', ts from judged
         where reason = 'ok' and ts >= timestamp '2024-01-20 00:00:00'),
letters as (select dlq_key, arg_max(reason, ts) as reason, count(*) as puts, min(ts) as first_seen
            from puts group by dlq_key),
sided as (select *, case when reason = 'undelivered' then 'retry' else 'stale' end as side from letters)"""

STORED = LINES + """,
stored as (select line, count(*) as puts, max(event_id) as event_id,
                  arg_max(case when outer_reason = 'ok' then 'undelivered' else outer_reason end, ts) as stored_reason,
                  arg_max(reason, ts) as checked_reason
           from judged where outer_reason <> 'blank' group by line),
kept as (select *, stored_reason = 'undelivered' as retriable from stored)"""

DOCS = """
docs as (select lpad(doc_id::varchar, 8, '0') as id, lang, source, n_chars, text,
                string_split(text, ' ') as words, string_split(text, chr(10)) as lines
         from documents)"""

HISTORY = """
history as (select 'part' || p_partkey || '-value' as subject, v::bigint as version, '{"v":' || v || '}' as schema_json,
                   v = 1 and p_size % 2 = 0 and p_size % 3 > 0 as retired
            from (select p_partkey, p_size, unnest(range(1, p_size % 3 + 2)) as v from part) x),
fresh as (select 'part' || p_partkey || '-value' as subject,
                 '{"v":' || (p_size % 3 + 1 + case when p_partkey % 2 = 0 then 0 else 10 end) || '}' as schema_json
          from part
          union all select s_name || '-value', '{"v":1}' from supplier),
top as (select subject, max(version) as last from history group by subject),
force as (select subject, arg_max(schema_json, version) as schema_json from history where not retired group by subject)"""


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


# ---------------------------------------------------------------- merge

oracle("merge_net", f"""
with {MERGE}
select {ROW} from tgt where k not in (select k from net)
union all select {ROW} from net where op <> 'D'""")

oracle("merge_phased", f"""
with {MERGE},
t1 as (select {ROW}, k from tgt union all
       select {ROW}, k from lk where op = 'I' and k not in (select k from tgt)),
t2 as (select {ROW}, k from t1 where k not in (select k from lk where op = 'U') union all
       select {ROW}, k from lk where op = 'U' and k in (select k from t1))
select {ROW} from t2 where k not in (select k from lk where op = 'D')""")

oracle("merge_composite_key", """
with c as (select *, case l_returnflag when 'N' then 'I' when 'R' then 'D' else 'U' end as op from lineitem),
ranked as (select *, row_number() over (partition by l_orderkey, l_linenumber, l_shipdate < timestamp '1999-01-01'
             order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc,
                      l_discount desc, l_tax desc, op desc, l_linestatus desc) as rn from c),
tgt as (select * from ranked where rn = 1 and l_shipdate < timestamp '1999-01-01' and op <> 'D'),
net as (select * from ranked where rn = 1 and l_shipdate >= timestamp '1999-01-01')
select l_orderkey, l_linenumber, l_quantity, l_extendedprice from tgt t
where not exists (select 1 from net n where n.l_orderkey = t.l_orderkey and n.l_linenumber = t.l_linenumber)
union all
select l_orderkey, l_linenumber, l_quantity, l_extendedprice from net where op <> 'D'""")

oracle("merge_insert", f"""
with {MERGE}
select {ROW} from tgt union all
select {ROW} from lk where op = 'I' and k not in (select k from tgt)""")

oracle("merge_update", f"""
with {MERGE}
select {ROW} from tgt where k not in (select k from lk where op = 'U') union all
select {ROW} from lk where op = 'U' and k in (select k from tgt)""")

oracle("merge_delete", f"""
with {MERGE}
select {ROW} from tgt where k not in (select k from lk where op = 'D')""")

_SLOTS_LIVE = f"""
with {SLOTS}
select {ROW} from (select *, row_number() over (partition by k order by ts desc, seq desc) as rn from sl) x
where rn = 1 and op <> 'D'"""
oracle("merge_day", _SLOTS_LIVE)
oracle("stream_merge", _SLOTS_LIVE)

oracle("merge_folders", _SLOTS_LIVE)
oracle("merge_restart", _SLOTS_LIVE)

oracle("merge_folders_touched", f"""
with {SLOTS},
held as (select slot, user_id from sl where ts < timestamp '2024-01-15 00:00:00' or slot % 4 = 1 or slot = 5 group by slot, user_id)
select slot::varchar as folder, case when slot = 5 then '2024-01-31' when slot % 4 = 1 then '2024-01-20' else '2024-01-15' end as day,
       count(*) as n from held group by slot""")

oracle("merge_ties", f"""
with {SLOTS},
last as (select *, row_number() over (partition by k order by date_trunc('hour', ts) desc, event_type desc, value desc,
                                      props desc, op desc, seq desc) as rn from sl)
select {ROW}, seq, how from last, (select unnest(['once', 'batches']) as how) where rn = 1 and op <> 'D'""")

oracle("merge_counts", f"""
with {MERGE},
j as (select op, k in (select k from tgt) as present from net),
c as (select count(*) filter (op <> 'D' and not present) as inserted,
             count(*) filter (op <> 'D' and present) as updated,
             count(*) filter (op = 'D' and present) as deleted,
             count(*) filter (op = 'D' and not present) as ignored from j)
select 'inserted' as metric, inserted as n from c union all select 'updated', updated from c
union all select 'deleted', deleted from c union all select 'ignored', ignored from c""")

# ---------------------------------------------------------------- change sets

oracle("net_changes", f"""
with {CL}
select user_id, op, seq as event_id from
(select *, row_number() over (partition by user_id order by ts desc, seq desc) as rn from cl) x where rn = 1""")

oracle("ambiguous_matches", f"""
with {CL}
select user_id, op, count(*) as n from cl group by user_id, op having count(*) > 1""")

oracle("op_split", f"with {CL} select op, count(*) as n from cl group by op")

oracle("dedupe_events", "select distinct event_id from events")

_LIVE = f"""
with {CL}
select user_id, event_type, value, props from
(select *, row_number() over (partition by user_id order by ts desc, seq desc) as rn from cl) x
where rn = 1 and op <> 'D'"""
oracle("replay_guard", _LIVE)

# ---------------------------------------------------------------- envelope and contract

oracle("envelope_classify", """
select case when event_id % 17 = 0 then 'malformed_json' when event_id % 19 = 0 then 'blank'
            when event_id % 23 = 0 then 'missing_envelope' else 'ok' end as reason, count(*) as n
from events group by 1""")

oracle("envelope_valid", """
select event_id, user_id::varchar as id,
       case event_type when 'signup' then 'I' when 'error' then 'D' else 'U' end as op,
       epoch_us(ts) // 1000 as ts_ms, value as v
from events where event_id % 17 <> 0 and event_id % 19 <> 0 and event_id % 23 <> 0""")

oracle("quarantine_rows", f"""
with {LINES}
select event_id, case when event_id % 67 = 0 then 'bad_utf8' else reason end as reason
from judged where (event_id % 67 = 0) or reason not in ('ok', 'blank')""")

oracle("schema_validate", f"""
with {LINES}
select event_id, concat_ws(',', case when event_id % 43 = 0 then 'id:type' end,
       case when event_id % 47 = 0 then 'v:missing' when event_id % 53 = 0 then 'v:null'
            when event_id % 59 = 0 then 'v:type' end) as violations
from judged where has_image""")

oracle("schema_versions", f"""
with {LINES},
named as (select *, case when event_id % 83 = 0 then 9 when event_id % 7 = 0 then null
                         when ts >= timestamp '2024-01-15 00:00:00' then 2 else 1 end as version from judged),
found as (select *, concat_ws(',', case when event_id % 43 = 0 then 'id:type' end,
            case when event_id % 47 = 0 then 'v:missing' when event_id % 53 = 0 then 'v:null' when event_id % 59 = 0 then 'v:type' end,
            case when version = 2 and event_id % 71 <> 0 then 'extra:missing' end) as faults from named)
select event_id,
       case when reason not in ('ok', 'schema_violation') then reason when version = 9 then 'unknown_schema'
            when faults <> '' then 'schema_violation' else 'ok' end as reason,
       case when has_image and version is distinct from 9 then faults end as violations
from found""")

oracle("pk_discovery", f"""
with {LINES}
select case when event_id % 31 = 0 then 'uid' else 'id' end as key_cols, count(*) as n
from judged where key_text is not null group by 1""")

oracle("message_error_filter", """
select user_id % 4 as partition,
       count(*) filter (event_id % 50 <> 0 and event_id % 97 <> 0) as good,
       count(*) filter (event_id % 50 = 0) as eof,
       count(*) filter (event_id % 50 <> 0 and event_id % 97 = 0) as error
from events group by 1""")

oracle("image_select", f"""
with {LINES} select event_id, uid as id, value as v, op from judged where reason = 'ok'""")

oracle("schema_drift", f"""
with {LINES},
img as (select * from judged where has_image),
seen as (select 'id' as field, case when event_id % 43 = 0 then 'BIGINT' else 'STRING' end as observed_type,
                case when event_id % 43 = 0 then 'type_changed' else 'ok' end as status from img
         union all
         select 'v', case when event_id % 53 = 0 then 'VOID' when event_id % 59 = 0 then 'STRING' else 'DECIMAL' end,
                case when event_id % 53 = 0 or event_id % 59 = 0 then 'type_changed' else 'ok' end
         from img where event_id % 47 <> 0
         union all
         select 'extra', 'BIGINT', 'new_field' from img where event_id % 71 = 0)
select field, observed_type, count(*) as n, status from seen group by field, observed_type, status
union all select 'note', 'none', 0, 'missing_field'""")

oracle("schema_drift_nested", f"""
with {DOCS},
c as (select count(*) as n, sum(len(words)) as w, sum(len(lines)) as l from docs)
select u.field, u.observed_type, cast(u.n as bigint) as n, u.status from c, lateral (values
  ('id', 'STRING', n, 'ok'), ('type', 'STRING', n, 'ok'), ('name', 'STRING', n, 'ok'), ('batters', 'OBJECT', n, 'ok'),
  ('topping', 'ARRAY', n, 'ok'), ('batters.batter', 'ARRAY', n, 'ok'),
  ('batters.batter.id', 'STRING', w, 'ok'), ('batters.batter.type', 'STRING', w, 'ok'),
  ('topping.id', 'STRING', l, 'ok'), ('topping.type', 'STRING', l, 'type_changed'), ('topping.size', 'none', 0, 'missing_field')
) as u(field, observed_type, n, status)
union all
select 'ppu', 'DECIMAL', count(*), 'ok' from docs""")

oracle("audit_counts", f"""
with {LINES},
c as (select count(*) as total, count(*) filter (reason = 'ok') as published,
             count(*) filter (reason not in ('ok', 'blank')) as quarantined,
             count(*) filter (reason = 'blank') as blank from judged)
select 'read' as metric, total as n from c union all select 'published', published from c
union all select 'quarantined', quarantined from c union all select 'blank', blank from c""")

# ---------------------------------------------------------------- flatten

oracle("flatten_arrays", f"""
with {DOCS}
select id, lang as type, source as name, n_chars / 4.0::double as ppu,
       array_to_string(range(0, len(words)), ',') as batters_ids, array_to_string(words, ',') as batters_types,
       array_to_string(range(0, len(lines)), ',') as topping_ids, array_to_string(lines, ',') as topping_types
from docs""")

oracle("flatten_generic", f"""
with {DOCS}
select id, lang as meta_lang, source as meta_origin_source, n_chars as meta_origin_n_chars,
       array_to_string(range(0, len(lines)), ',') as lines_ids, array_to_string(lines, ',') as words
from docs""")

oracle("json_document_scan", f"""
with {DOCS}
select id, lang as type, source as name, text, len(words)::bigint as n_words from docs""")

oracle("raw_csv_roundtrip", f"""
with {DOCS}
select id, lang as type, n_chars / 4.0::double as ppu, text as words,
       array_to_string(range(0, len(lines)), ',') as topping_ids
from docs""")

# ---------------------------------------------------------------- topic, time, raw zone

oracle("topic_encode", """
select event_id, '{"id":"' || user_id || '"}' as key_text,
       strlen('{"event_type":"' || event_type || '","value":' || value::varchar || ',"ts_us":' || epoch_us(ts) || '}')
         as value_len
from events""")

oracle("event_time", """
select event_id, epoch_us(ts) as ts_us, epoch_us(ts) // 1000 as ts_ms, 1::bigint as round_trip,
       strftime(ts, '%Y-%m-%d') as day
from events""")

oracle("raw_partition_counts", """
select strftime(ts, '%Y-%m-%d') as ingest_date, count(*) as n from events group by 1""")

oracle("raw_day_scan", f"""
with {CL}
select seq as event_id, user_id, op from cl
where ts >= timestamp '2024-01-15 00:00:00' and ts < timestamp '2024-01-16 00:00:00'""")

oracle("raw_csv_quarantine", """
select event_id, case when good then user_id end as user_id, case when good then value end as value,
       case when good then event_type end as tags, case when good then 'ok' else 'malformed_row' end as fate,
       case when good then 0 else 1 end::bigint as puts
from (select *, event_id % 11 > 0 and event_id % 13 > 0 and event_id % 17 > 0 and event_id % 19 > 0 as good from events) x""")

oracle("raw_compaction", """
select strftime(ts, '%Y-%m-%d') as ingest_date, count(*) as n, sum(event_id)::bigint as seqs,
       case strftime(ts, '%Y-%m-%d') when '2024-01-15' then 1 else 2 end::bigint as files
from events group by 1""")

oracle("incremental_scan", """
select event_id, epoch_us(ts) as ts_us from events where ts >= timestamp '2024-01-15 00:00:00'""")

oracle("watermark_lookup", """
select event_type as feed_name, max(epoch_us(ts)) as last_upd from events group by 1""")

oracle("watermark_advance", """
select event_type as feed_name,
       max(epoch_us(ts)) filter (event_type not in ('error', 'view') or ts < timestamp '2024-01-15 00:00:00') as last_upd
from events group by 1""")

# ---------------------------------------------------------------- dead letters

oracle("dlq_put", f"""
with {LINES},
puts as (select coalesce(key_text, sha256(line)) as dlq_key, * from judged where reason not in ('ok', 'blank'))
select dlq_key, arg_max(line, ts) as raw, arg_max(reason, ts) as reason, count(*) as puts
from puts group by dlq_key""")

oracle("dlq_retry_split", f"""
with {LETTERS}
select side, reason, count(*) as n, sum(puts)::bigint as puts from sided group by side, reason""")

oracle("dlq_alerts", f"""
with {LETTERS}
select reason, count(*) as n, min(epoch_us(first_seen)) as oldest_us from sided where side = 'stale' group by reason""")

oracle("dlq_purge", f"""
with {STORED}
select stored_reason as reason, count(*) as n, 0::bigint as attempts, sum(puts)::bigint as puts
from kept where retriable group by 1""")

oracle("dlq_replay", f"""
with {STORED},
after as (select case when not retriable then stored_reason when checked_reason = 'ok' then 'delivered'
                      else checked_reason end as reason,
                 case when retriable then 1 else 0 end as attempts,
                 case when retriable and checked_reason = 'ok' then 1 else puts end as puts
          from kept)
select reason, count(*) as n, sum(attempts)::bigint as attempts, sum(puts)::bigint as puts from after group by reason""")

oracle("dlq_failover", f"""
with {LINES},
put as (select line, count(*) as puts,
               arg_max(case when reason = 'ok' then 'undelivered' else reason end, event_id) as reason
        from judged where reason <> 'blank' group by line)
select reason, case when reason = 'undelivered' then 'true' else 'false' end as retriable,
       count(*) as n, sum(puts)::bigint as puts
from put group by 1, 2""")

oracle("dlq_outage", f"""
with {LINES} select uid as id, us as ts_us, 1::bigint as n from judged where reason = 'ok'""")

oracle("intake_run", f"""
with {LINES},
good as (select case event_id % 2 when 0 then 'even' else 'odd' end as feed_name, uid, us, ms from judged where reason = 'ok')
select feed_name, uid as id, us as ts_us, 1::bigint as n, max(ms) over (partition by feed_name) as last_upd, letters, letters as puts
from good join (select case event_id % 2 when 0 then 'even' else 'odd' end as feed_name, count(distinct line) as letters
                from judged where reason not in ('ok', 'blank') group by 1) using (feed_name)""")

oracle("intake_fetch", f"""
with {LINES},
c as (select count(*) filter (reason = 'ok') as good, count(distinct line) filter (reason not in ('ok', 'blank')) as bad from judged)
select unnest(['files_1', 'files_2', 'files_3', 'read_2', 'read_3', 'published', 'letters', 'letters_after', 'puts']) as metric,
       unnest([6, 0, 1, 0, (select count(distinct line) from judged where event_id % 3 = 0 and reason = 'blank'), good, bad, 0, bad])::bigint as n
from c""")

# ---------------------------------------------------------------- schema history

oracle("registry_latest", f"""
with {HISTORY}
select subject, max(version) as version, arg_max(schema_json, version) as schema_json
from history where not retired group by subject""")

oracle("registry_register", f"""
with {HISTORY}
select subject, version, schema_json, retired::varchar as retired from history
union all
select f.subject, coalesce(t.last, 0) + 1, f.schema_json, 'false'
from fresh f left join top t using (subject) left join force o using (subject)
where o.schema_json is null or o.schema_json <> f.schema_json""")

oracle("registry_update", f"""
with {HISTORY}
select subject, version, schema_json,
       (retired or subject in (select subject from fresh))::varchar as retired from history
union all
select f.subject, coalesce(t.last, 0) + 1, f.schema_json, 'false' from fresh f left join top t using (subject)""")

# ---------------------------------------------------------------- delivery and streams

oracle("delivery_report", """
select 'events' as topic, user_id % 4 as partition,
       case when event_id % 50 = 0 or event_id % 97 = 0 then 'failed' else 'delivered' end as status,
       count(*) as n, max(event_id) as max_offset
from events group by 2, 3""")

oracle("commit_progress", """
select user_id % 4 as partition, count(*) as n, max(event_id) as max_offset from events group by 1""")

oracle("stream_raw_ingest", f"""
with {LINES}
select uid as id, value as v, op, us as ts_us, event_id as msg_offset from judged
where reason = 'ok' and event_id % 67 <> 0 and event_id % 73 <> 0""")

oracle("registry_stored", f"""
with {HISTORY},
first as (select subject, 1::bigint as version, schema_json, subject like 'part%' as retired from fresh)
select subject, version, schema_json, retired::varchar as retired, case when retired then 'retired' end as what from first
union all select subject, 2, '{{"v":99}}', 'false', 'added' from first where retired""")

oracle("landing_restart", f"""
with {LINES},
sides as (select *, event_id % 73 = 0 or event_id % 19 = 0 or event_id % 29 = 0 as no_key,
                 case when event_id % 17 = 0 then event_id % 23 = 0 else event_id % 19 = 0 or event_id % 23 = 0 end as no_value
          from judged),
found as (select case when event_id % 67 <> 0 and no_key and no_value then 'blank' when event_id % 67 = 0 then 'bad_utf8'
                      when event_id % 17 = 0 and not no_value then 'malformed_json' when no_key or no_value then 'missing_envelope'
                      else reason end as reason from sides)
select reason, count(*) as n from found where reason <> 'blank' group by reason""")

oracle("stream_dedupe", f"""
with {LINES}
select uid as id, us as ts_us, 1::bigint as n from judged
where reason = 'ok' and event_id % 67 <> 0 and event_id % 73 <> 0""")

FATES = LINES + """,
sides as (select *, event_id % 73 = 0 or event_id % 19 = 0 or event_id % 29 = 0 as no_key,
                 case when event_id % 17 = 0 then event_id % 23 = 0 else event_id % 19 = 0 or event_id % 23 = 0 end as no_value
          from judged),
fates as (select event_id, event_id % 4 as partition,
                 case when event_id % 50 = 0 then 'eof' when event_id % 97 = 0 then 'failed'
                      when event_id % 67 <> 0 and no_key and no_value then 'blank' when event_id % 67 = 0 then 'refused'
                      when event_id % 17 = 0 and not no_value then 'refused' when no_key or no_value then 'refused'
                      when reason = 'ok' then 'landed' else 'refused' end as fate from sides)"""

oracle("landing_accounts", f"""
with {FATES}
select partition, count(*) as read, count(*) filter (fate = 'landed') as landed, count(*) filter (fate = 'refused') as refused,
       count(*) filter (fate = 'blank') as blank, count(*) filter (fate = 'eof') as eof, count(*) filter (fate = 'failed') as failed,
       max(event_id) filter (fate <> 'eof') as max_offset,
       count(*) filter (fate = 'landed') as raw_rows, count(*) filter (fate = 'failed') as error_letters
from fates group by partition""")

oracle("delivery_log", f"""
with {LINES},
good as (select case when ts < timestamp '2024-01-15 00:00:00' then 'intake-0' when ts < timestamp '2024-01-20 00:00:00' then 'intake-1' else 'intake-2' end as part
         from judged where reason = 'ok'),
made as (select part as delivery, case when part = 'intake-2' then 'failed' else 'delivered' end as status from good
         union all select 'replay', s from good, (values ('failed'), ('delivered')) as t(s) where part = 'intake-2')
select delivery, status, count(*) as n, case when status = 'failed' then 'ConnectionError: topic is not available' end as error,
       4::bigint as partitions, 0::bigint as differ
from made group by 1, 2""")
