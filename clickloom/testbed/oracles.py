"""The named queries once more, as SQL over the given tables.

The SQL starts from the typed values of the recipe and goes other ways than the library (NOT IN, sessions
by the absence of active minutes, metrics by kind of event), so a match also proves the way through JSON
text and variants.
"""

from __future__ import annotations

_SRC = """
src as (
    select event_id as n, ts, user_id as u, cast(json_extract_string(props, '$.k') as int) as k,
        case event_type when 'signup' then 'page_view' when 'view' then 'product_view'
            when 'click' then 'add_to_cart' when 'error' then 'remove_from_cart'
            when 'purchase' then 'checkout' end as clean_type
    from events
),
sent as (
    select n, ts,
        cast(case when n % 20 = 7 then n - 1 else n end as varchar) as event_id,
        case when n % 13 = 0 then upper(clean_type) else clean_type end as event_type,
        case when n % 10 = 0 then null when n % 41 = 0 then 'user-x9999'
            when u % 5 = 4 then 'user-x' || u else 'user-' || u end as user_id,
        case when clean_type = 'page_view' then null when n % 23 = 0 then 'prod-x9999'
            when n % 29 = 0 then null when k >= 80 then 'prod-x' || k else 'prod-' || k end as product_id,
        case when n % 2 = 0 then 'web' else 'mobile' end as platform,
        '198.51.100.' || (n % 5) as ip_address, 'agent-' || (n % 4) as user_agent,
        'source-' || (n % 5) as utm_source, 'medium-' || (n % 3) as utm_medium,
        case when n % 4 = 3 then null else 'campaign-' || (n % 4) end as utm_campaign,
        case when clean_type = 'checkout' then 'order-' || n end as order_id,
        cast(case when clean_type = 'checkout' then 1 + n % 10
            when clean_type in ('add_to_cart', 'remove_from_cart') then 1 end as int) as quantity,
        case when n % 10 < 7 then replace(cast(ts as varchar), ' ', 'T') || '+00:00'
            else cast(cast(epoch(date_trunc('second', ts)) as bigint) as varchar) end as event_timestamp
    from src
),
parsed as (
    select event_id, coalesce(user_id, 'guest') as user_id, product_id, order_id,
        lower(event_type) as event_type,
        case when n % 10 < 7 then ts else date_trunc('second', ts) end as event_at_ts,
        quantity, platform, ip_address, user_agent, utm_source, utm_medium, utm_campaign,
        n as metadata_file_row_number, timestamp '2024-02-01 00:00:00' + to_seconds(n) as loaded_at
    from sent
)"""

_DIMS = """
products as (
    select 'prod-' || p_partkey as product_id, p_name as product_name, p_type as category,
        cast(p_retailprice as decimal(10,2)) as price
    from part
),
versions as (
    select product_id, price, timestamp '2024-01-01 00:00:00' as valid_from,
        timestamp '2024-01-16 00:00:00' as valid_to
    from products
    union all
    select product_id, cast(price * 1.1 as decimal(10,2)), timestamp '2024-01-16 00:00:00', null
    from products
),
users as (
    select 'user-' || c_custkey as user_id, date '2023-01-01' + cast(c_custkey % 365 as int) as registration_date,
        n_name as country
    from customer left join nation on c_nationkey = n_nationkey
    union all select 'guest', null, null
)"""

_VALIDATED = """
validated as (
    select *, case
        when event_type not in ('page_view') and product_id is null then 'missing_product'
        when event_type not in ('page_view') and product_id not in (select product_id from products)
            then 'unknown_product'
        when user_id <> 'guest' and user_id not in (select user_id from users) then 'unknown_user'
        end as reject_reason
    from parsed
),
ranked as (
    select *, row_number() over (partition by event_id order by loaded_at desc nulls first) as copy
    from validated where reject_reason is null
),
valid as (select * exclude (copy, reject_reason) from ranked where copy = 1)"""


def _sessions(closed: bool = False, gap: int = 30) -> str:
    """Sessions from what a minute knows: whether the user was active in the minutes before it.

    A minute begins a session if none of the ``gap`` minutes before it was active; its session's number
    is how many such minutes the user has up to it.
    """
    end = "<=" if closed else "<"
    return f"""
priced as (
    select e.*, cast(e.quantity * p.price as decimal(21,2)) as value, date_trunc('minute', event_at_ts) as minute
    from valid e left join versions p
        on e.product_id = p.product_id and e.event_at_ts >= p.valid_from
        and e.event_at_ts {end} coalesce(p.valid_to, timestamp '9999-12-31 00:00:00')
),
active as (select distinct user_id, minute from priced),
beginnings as (
    select user_id, minute from active a where not exists (
        select 1 from active b
        where b.user_id = a.user_id and b.minute < a.minute and b.minute >= a.minute - interval {gap} minute)
),
placed as (
    select a.user_id, a.minute, count(*) as session_index
    from active a join beginnings b on b.user_id = a.user_id and b.minute <= a.minute
    group by all
),
sessionized as (
    select p.*, session_index, format('{{}}-{{}}', p.user_id, session_index) as session_id
    from priced p join placed using (user_id, minute)
),
earlier as (
    select e.event_id, e.user_id, e.event_at_ts,
        case when exists (select 1 from priced s
            where s.user_id = e.user_id and s.event_at_ts = e.event_at_ts and s.event_id < e.event_id)
        then e.event_at_ts else (select max(s.event_at_ts) from priced s
            where s.user_id = e.user_id and s.event_at_ts < e.event_at_ts) end as previous_event_ts
    from priced e
),
bought as (
    select session_id, sum(value) as paid, count(*) as checkouts, count(value) as valued
    from sessionized where event_type = 'checkout' group by session_id
),
looked as (
    select session_id, count(*) as products
    from (select distinct session_id, product_id from sessionized
        where event_type = 'product_view' and product_id is not null)
    group by session_id
),
carted as (select session_id, count(*) as items from sessionized where event_type = 'add_to_cart' group by session_id),
spans as (
    select session_id, any_value(user_id) as user_id, any_value(session_index) as session_index,
        min(event_at_ts) as began, max(event_at_ts) as ended, count(*) as n, count(distinct event_id) as ids,
        max(utm_source) as source
    from sessionized group by session_id
),
facts as (
    select session_id, s.user_id,
        (select any_value(country) from users u where u.user_id = s.user_id) as user_country,
        began as session_started_at_ts, ended as session_ended_at_ts,
        cast(floor(epoch(ended)) - floor(epoch(began)) as bigint) as session_duration_seconds,
        ids as total_events_in_session,
        cast(case when valued > 0 then paid when checkouts = n then null else 0 end as decimal(38,2))
            as total_session_revenue,
        coalesce(items, 0) as total_items_added_to_cart, coalesce(products, 0) as distinct_products_viewed,
        source as session_utm_source, session_index
    from spans s left join bought using (session_id) left join looked using (session_id)
        left join carted using (session_id)
)"""


_HISTORY = """
first_load as (
    select * from products
    union all select 'old-' || s_suppkey, s_name, 'EXTRA', cast(s_suppkey as decimal(10,2)) from supplier
),
second_load as (
    select product_id, product_name,
        case when cast(split_part(product_id, '-', 2) as bigint) % 7 <> 0 then category end as category,
        case when cast(split_part(product_id, '-', 2) as bigint) % 3 = 0
            then cast(price * 1.1 as decimal(10,2)) else price end as price
    from products
    union all select 'new-' || n_nationkey, n_name, 'EXTRA', cast(n_nationkey as decimal(10,2)) from nation
),
history as (
    select f.product_id, f.product_name, f.category, f.price,
        md5(f.product_id || '|2024-01-01 00:00:00') as version_id,
        timestamp '2024-01-01 00:00:00' as updated_at, timestamp '2024-01-01 00:00:00' as valid_from,
        case when s.product_id is not null and (f.category is distinct from s.category
            or f.product_name is distinct from s.product_name or f.price is distinct from s.price)
            then timestamp '2024-01-16 00:00:00' end as valid_to
    from first_load f left join second_load s on f.product_id = s.product_id
    union all
    select s.product_id, s.product_name, s.category, s.price,
        md5(s.product_id || '|2024-01-16 00:00:00'),
        timestamp '2024-01-16 00:00:00', timestamp '2024-01-16 00:00:00', null
    from second_load s left join first_load f on f.product_id = s.product_id
    where f.product_id is null or f.category is distinct from s.category
        or f.product_name is distinct from s.product_name or f.price is distinct from s.price
)"""


def _with(*parts: str) -> str:
    return "with " + ",".join(parts)


_PARSED = _with(_SRC)
_VALID = _with(_SRC, _DIMS, _VALIDATED)
_FULL = _with(_SRC, _DIMS, _VALIDATED, _sessions())
_VISITED = """
visited as (
    select * replace (case when user_id = 'guest' then 'guest:' || md5(ip_address || '|' || user_agent)[:16] else user_id end as user_id)
    from valid
)"""
_BY_VISITOR = _with(_SRC, _DIMS, _VALIDATED, _VISITED, _sessions().replace("from valid e", "from visited e"))
_CLOSED = _with(_SRC, _DIMS, _VALIDATED, _sessions(closed=True))
_WIDE_GAP = _with(_SRC, _DIMS, _VALIDATED, _sessions(gap=360))
_VERSIONED = _with(_DIMS, _HISTORY)


def _check(name: str, failures: str, severity: str = "error") -> str:
    return (
        f"select '{name}' as \"check\", '{severity}' as severity, n as failures, n = 0 as passed "
        f"from (select count(*) as n from ({failures}))"
    )


def _null_rows(table: str, column: str, where: str = "true") -> str:
    return f"select 1 from {table} where {column} is null and {where}"


def _repeated(table: str, column: str) -> str:
    return f"select {column} from {table} where {column} is not null group by {column} having count(*) > 1"


_TYPES = "('page_view', 'add_to_cart', 'checkout', 'product_view', 'remove_from_cart')"


def _orphans(table: str) -> str:
    return f"""select c.user_id, count(*) as n_records from {table} c left join users u on c.user_id = u.user_id
        where c.user_id is not null and u.user_id is null group by c.user_id"""


_SUITE = " union all ".join(
    [
        _check("events.event_id.not_null", _null_rows("priced", "event_id")),
        _check("events.event_at_ts.not_null", _null_rows("priced", "event_at_ts")),
        _check("events.user_id.not_null", _null_rows("priced", "user_id")),
        _check(
            "events.product_id.not_null",
            _null_rows("priced", "product_id", "event_type not in ('page_view')"),
        ),
        _check("sessionized.event_id.not_null", _null_rows("sessionized", "event_id")),
        _check("sessionized.session_id.not_null", _null_rows("sessionized", "session_id")),
        _check("sessions.session_id.not_null", _null_rows("facts", "session_id")),
        _check("sessions.user_id.not_null", _null_rows("facts", "user_id")),
        _check(
            "sessions.session_duration_seconds.not_negative",
            "select 1 from facts where session_duration_seconds < 0",
        ),
        _check("events.event_id.unique", _repeated("priced", "event_id")),
        _check(
            "events.event_type.accepted_values",
            f"select distinct event_type from priced where event_type not in {_TYPES}",
        ),
        _check("sessionized.event_id.unique", _repeated("sessionized", "event_id")),
        _check("sessions.session_id.unique", _repeated("facts", "session_id")),
        _check("sessions.user_id.relationships", _orphans("facts")),
    ]
)

_SUITE_DIRTY = " union all ".join(
    [
        _check("event_id.not_null", _null_rows("parsed", "event_id")),
        _check(
            "product_id.not_null",
            _null_rows("parsed", "product_id", "event_type not in ('page_view')"),
            "warn",
        ),
        _check("event_id.unique", _repeated("parsed", "event_id")),
        _check(
            "event_type.accepted_values",
            f"select distinct event_type from parsed where event_type not in {_TYPES}",
        ),
        _check("user_id.relationships", _orphans("parsed"), "warn"),
    ]
)

# Of each event the valid copy that arrives first: repeated copies (n % 20 = 7) come a step later.
_FIRST = """,
arrived as (
    select *, metadata_file_row_number as n, datediff('day', date '2024-01-01', cast(event_at_ts as date)) // 5 as step
    from {relation}
),
firsts as (
    select * from arrived a where not exists (
        select 1 from arrived b where b.event_id = a.event_id
            and (least(b.step, 5) + (b.n % 20 = 7)::int, b.n) < (least(a.step, 5) + (a.n % 20 = 7)::int, a.n))
)"""

# Sessions a stream has emitted: their gap has passed before the watermark, eleven days behind.
_LIVE = """,
seen as (select *, date_trunc('minute', event_at_ts) as minute from firsts),
active as (select distinct user_id, minute from seen),
beginnings as (
    select user_id, minute from active a where not exists (
        select 1 from active b
        where b.user_id = a.user_id and b.minute < a.minute and b.minute >= a.minute - interval 30 minute)
),
homes as (
    select a.user_id, a.minute, max(b.minute) as first_minute
    from active a join beginnings b on b.user_id = a.user_id and b.minute <= a.minute
    group by all
),
live as (
    select user_id, first_minute, max(minute) as last_minute, count(*) as total_events_in_session,
        min(event_at_ts) as session_started_at_ts, max(event_at_ts) as session_ended_at_ts,
        count(*) filter (event_type = 'add_to_cart') as total_items_added_to_cart,
        max(utm_source) as session_utm_source
    from seen join homes using (user_id, minute) group by user_id, first_minute
)
select * exclude (last_minute) from live
where last_minute + interval 30 minute <=
    (select max(date_trunc('minute', event_at_ts)) from {relation}) - interval 11 day"""

ORACLES: dict[str, str] = {
    "parse_events": f"{_PARSED} select * from parsed",
    "parse_timestamps": f"{_PARSED} select metadata_file_row_number, event_at_ts from parsed",
    "normalize_event_type": f"{_PARSED} select event_type, count(*) as events from parsed group by event_type",
    "filter_cutoff": f"""{_PARSED} select event_id, event_at_ts, loaded_at from parsed
        where event_at_ts >= timestamp '2024-01-16 00:00:00'""",
    "orphan_events": f"""{_with(_SRC, _DIMS)} select metadata_file_row_number, event_id, event_type, product_id
        from parsed where product_id not in (select product_id from products)""",
    "validate_events": f"""{_VALID} select metadata_file_row_number, event_id,
        reject_reason is null as is_valid_record, reject_reason from validated""",
    "quarantine": f"""{_VALID} select *, false as is_valid_record from validated
        where reject_reason is not null""",
    "dedup_events": f"{_VALID} select * from valid",
    "price_asof": f"{_FULL} select event_id, product_id, quantity, event_at_ts, value from priced",
    "price_asof_closed": f"{_CLOSED} select event_id, product_id, quantity, event_at_ts, value from priced",
    "price_sweep": f"""{_VALID}, daily as (
            select product_id, cast(price + k as decimal(10,2)) as price,
                timestamp '2024-01-01 00:00:00' + to_hours(24 * k + cast(substr(product_id, 6) as bigint) % 24) as valid_from, k
            from products, range(30) days(k)
        )
        select event_id, e.product_id, quantity, event_at_ts, cast(quantity * price as decimal(21,2)) as value
        from valid e left join daily d on e.product_id = d.product_id and event_at_ts >= valid_from
            and (k = 29 or event_at_ts < valid_from + interval 1 day)""",
    "scd2_snapshot": f"{_VERSIONED} select * from history",
    "scd2_current": f"{_VERSIONED} select * from history where valid_to is null",
    "scd2_point_in_time": f"""{_VERSIONED} select product_id, price, valid_from from history
        where valid_from <= timestamp '2024-01-15 12:00:00'
            and (valid_to is null or valid_to > timestamp '2024-01-15 12:00:00')""",
    "event_gaps": f"""{_FULL} select *,
        date_diff('minute', previous_event_ts, event_at_ts) as minutes_since_last_event,
        (exists (select 1 from beginnings b where b.user_id = e.user_id
            and b.minute = date_trunc('minute', e.event_at_ts))
            and (previous_event_ts is null or previous_event_ts < date_trunc('minute', e.event_at_ts)))::int
            as is_new_session
        from earlier e""",
    "session_index": f"{_FULL} select event_id, user_id, event_at_ts, session_index from sessionized",
    "sessionize": f"""{_FULL} select event_id, event_type, user_id, product_id, order_id, value, quantity,
        platform, ip_address, user_agent, utm_source, utm_medium, utm_campaign, event_at_ts, session_id
        from sessionized""",
    "sessionize_wide_gap": f"{_WIDE_GAP} select event_id, session_id from sessionized",
    "fact_sessions": f"{_FULL} select * exclude (session_index) from facts",
    "visitor_sessions": f"{_BY_VISITOR} select * exclude (session_index) from facts",
    "increment_sessions": f"{_FULL} select * exclude (session_index) from facts",
    "increment_events": f"{_VALID} select * from valid",
    "session_bounds": f"{_FULL} select session_id, session_started_at_ts, session_ended_at_ts from facts",
    "session_duration": f"{_FULL} select session_id, session_duration_seconds from facts",
    "session_event_counts": f"{_CLOSED} select session_id, total_events_in_session from facts",
    "session_revenue": f"""{_FULL} select session_id, total_session_revenue, total_items_added_to_cart
        from facts""",
    "session_utm": f"{_FULL} select session_id, session_utm_source from facts",
    "approx_products_viewed": f"""{_FULL}, viewed as (
            select session_id, s.user_id, country, cast(cast(event_at_ts as date) as varchar) as day, product_id
            from sessionized s left join users u on u.user_id = s.user_id
            where event_type = 'product_view' and product_id is not null
        )
        select 'session' as level, session_id as name, count(distinct product_id) as distinct_products, true as near from viewed group by 2
        union all select 'country', country, count(distinct product_id), true from viewed group by 2
        union all select 'day', day, count(distinct product_id), true from viewed group by 2""",
    "session_products_viewed": f"""{_FULL} select session_id, distinct_products_viewed from facts
        where distinct_products_viewed > 0""",
    "enrich_sessions": f"{_FULL} select session_id, user_id, user_country from facts",
    "dim_products": f"{_with(_DIMS)} select * from products",
    "dim_users": f"{_with(_DIMS)} select * from users",
    "union_all": f"""{_PARSED} select event_id, user_id from parsed
        union all select event_id, null from parsed where user_id = 'guest'""",
    "union_all_equal": f"""{_PARSED} select event_id, user_id from (
        select event_id, user_id from parsed
        union all select event_id, null from parsed where user_id = 'guest') where user_id = 'guest'""",
    "dq_unique": f"""{_PARSED} select event_id, count(*) as n_records from parsed
        group by event_id having count(*) > 1""",
    "dq_not_null": f"""{_PARSED} select metadata_file_row_number, event_id, event_type from parsed
        where product_id is null""",
    "dq_not_null_where": f"""{_PARSED} select metadata_file_row_number, event_id, event_type from parsed
        where product_id is null and event_type not in ('page_view')""",
    "dq_accepted_values": f"""{_PARSED} select event_type, count(*) as n_records from sent
        where event_type not in {_TYPES} group by event_type""",
    "dq_relationships": f"{_with(_SRC, _DIMS)} {_orphans('parsed')}",
    # Every seventh session of a user has its ends swapped: those over some second's end come out.
    "dq_positive_duration": f"""{_FULL} select session_id, -session_duration_seconds as session_duration_seconds
        from facts where session_index % 7 = 0 and session_duration_seconds > 0""",
    "dq_suite": f"{_FULL} {_SUITE}",
    "increment_checks": f"{_FULL} {_SUITE}",
    "dq_suite_dirty": f"{_with(_SRC, _DIMS)} {_SUITE_DIRTY}",
    "ingest_files": f"""{_PARSED} select event_id, product_id, order_id, platform, ip_address, user_agent,
        utm_source, utm_medium, utm_campaign, event_type, user_id, event_timestamp from sent""",
    "ingest_json": f"""{_PARSED} select event_id, product_id, order_id, platform, ip_address, user_agent,
        utm_source, utm_medium, utm_campaign, event_type, user_id, event_timestamp from sent""",
    "ingest_malformed": """select '{"event_id":"' || event_id as raw_text from events
        where event_id % 50 = 3""",
    "ingest_ragged": f"{_PARSED} select event_id, order_id, utm_campaign, quantity from sent",
    "ingest_roundtrip": f"""{_PARSED} select event_type, platform, count(*) as events,
        count(distinct event_id) as event_ids, cast(sum(quantity) as bigint) as quantity,
        min(event_at_ts) as first_at, max(event_at_ts) as last_at
        from parsed group by event_type, platform""",
    # Paris is two hours ahead of UTC from the last Sunday of March to that of October, 01:00 UTC, else one.
    "ingest_partitions": """with sent as (
            select case when event_id % 20 = 7 then event_id - 1 else event_id end as id from events
        ),
        loaded as (
            select case when id % 2 = 0 then timestamp '2024-03-30 00:00:00' else timestamp '2024-10-26 00:00:00' end
                + (id % 192) * interval 15 minute as loaded_at from sent
        )
        select cast(loaded_at + case
            when loaded_at >= timestamp '2024-03-31 01:00:00' and loaded_at < timestamp '2024-10-27 01:00:00'
            then interval 2 hour else interval 1 hour end as date) as ingest_date, count(*) as events
        from loaded group by 1""",
    "ingest_metrics": """select 8::bigint as batches, count(*) + count(*) filter (event_id % 50 = 3) as received,
        count(*) as written, count(*) filter (event_id % 50 = 3) as malformed from events""",
    "ingest_continuous": """select 'event' as kind, count(*) as messages from events
        union all select 'dead_letter', count(*) from events where event_id % 50 = 3""",
    "raw_autoload": f"{_PARSED} select event_id, event_timestamp from sent",
    "raw_metadata": """select count(*) as n_rows, count(*) as distinct_positions,
        count(*) as with_load_time, count(*) as with_path, 8::bigint as batches from events""",
    "stream_dedup": f"{_PARSED} {_FIRST.format(relation='parsed')} select event_id, event_at_ts from firsts",
    "stream_sessions": f"""{_VALID}, passed as (select * from validated where reject_reason is null)
        {_FIRST.format(relation='passed')} {_LIVE.format(relation='passed')}""",
    "stream_quarantine": f"""{_VALID} select reject_reason is null as is_valid_record, reject_reason,
        count(*) as events, min(event_id) as first_event_id from validated group by 1, 2""",
    "stream_quarantine_published": f"""{_VALID} select reject_reason is null as is_valid_record, reject_reason,
        count(*) as events, min(event_id) as first_event_id from validated group by 1, 2""",
    "refresh_facts": f"{_FULL} select * exclude (session_index) from facts",
    "refresh_quarantine": f"""{_VALID} select metadata_file_row_number, event_id, reject_reason
        from validated where reject_reason is not null""",
}
