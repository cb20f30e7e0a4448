"""The equivalent SQL of every query, for DuckDB over the same tables.

Shared inputs are written as `WITH` clauses; `_sql` puts in the ones a query names, and theirs.
"""

from __future__ import annotations

import re

VIEWS = {
    "user_profile": """
        select cast(c_custkey as varchar) user_id, c_mktsegment segment, c_acctbal acctbal,
               cast(c_nationkey as varchar) nation, '202401' month_id
        from customer""",
    "user_activity": """
        select cast(user_id as varchar) user_id, strftime(ts, '%Y%m') month_id, count(*) n_events,
               count(case when event_type = 'purchase' then 1 end) n_purchase, max(value) max_value
        from events group by all""",
    "user_spend": """
        select cast(o_custkey as varchar) user_id, count(*) n_orders, max(o_totalprice) max_price,
               max(o_orderpriority) top_priority, '202401' month_id
        from orders group by o_custkey""",
    "user_visit": """
        select cast(user_id as varchar) user_id, regexp_extract(props, '([0-9]+)', 1) lac_ci,
               event_type, value, strftime(ts, '%Y%m') month_id
        from events""",
    "station_live": """
        select distinct regexp_extract(props, '([0-9]+)', 1) lac_ci, cast(user_id as varchar) user_id,
               case when hour(ts) between 8 and 19 then 'D' else 'N' end dn_flag,
               strftime(ts, '%Y%m') month_id
        from events""",
    "station_heat": """
        select lac_ci, cast(lac_ci as double) / 10 longitude, cast(lac_ci as double) / 4 latitude,
               count(distinct user_id) per_num, month_id
        from station_live group by lac_ci, month_id""",
    "campaign_actions": """
        select distinct 'A' || strftime(o_orderdate, '%Y%m%d') atid,
               case when o_orderstatus = 'F' and o_orderpriority in ('1-URGENT', '2-HIGH')
                    then 'NOTERESSUC' else 'FAILED' end bstatus,
               cast(o_orderdate as date) send_time
        from orders""",
    "campaign_batch": """
        select 'A' || strftime(o_orderdate, '%Y%m%d') atid, o_orderkey // 5000 batch_id,
               string_agg(cast(o_custkey as varchar), ',' order by cast(o_custkey as varchar)) userids
        from orders group by 1, 2""",
    "reached_actions": """
        select * from campaign_actions where bstatus = 'NOTERESSUC' and send_time >= date '1999-01-01'""",
    "orders_monthly": "select *, strftime(o_orderdate, '%Y%m') month_id from orders",
    "part_catalog": """
        select cast(p_size as varchar) id,
               case when p_type = 'PROMO' then '' else
                 '{"price":{"value":"[' || cast(cast(floor(p_retailprice / 100) * 100 as bigint) as varchar) || ','
                 || cast(cast(floor(p_retailprice / 100) * 100 + 100 as bigint) as varchar)
                 || ')","type":"range"},"kind":{"value":"' || p_type || '","type":"Single"}}' end "value",
               case when p_brand = 'Brand#11' then '  '
                    when p_brand <> 'Brand#12' then lower(replace(p_brand, '#', '_')) end source_name,
               p_name source_label,
               case when p_type = 'ECONOMY' then 'dt' else 'month_id' end partition_field
        from part""",
    "part_tasks": """
        select source_name, partition_field, string_agg(distinct id, '#' order by id) pids,
               string_agg(distinct source_label, '#' order by source_label) labels
        from part_catalog where length(trim(source_name)) > 0 group by source_name, partition_field""",
    "profile_matrix": """
        select user_id id,
               case when segment = 'BUILDING' then '101' end label_101,
               case when segment in ('MACHINERY', 'FURNITURE') then '102' end label_102,
               case when acctbal >= 0 and acctbal < 1000 then '103' end label_103,
               case when acctbal > 5000 and acctbal <= 10000 and segment = 'AUTOMOBILE' then '104' end label_104,
               case when nation in ('1', '2', '3') and acctbal >= 0 and acctbal <= 9000 then '105' end label_105
        from user_profile""",
    "profile_tags": """
        select id, concat_ws(',', label_101, label_102, label_103, label_104, label_105) labels
        from profile_matrix""",
    "activity_tags": """
        select user_id id, concat_ws(',',
               case when n_events > 60 and n_events < 70 then '201' end,
               case when n_purchase >= 10 and n_purchase <= 20 then '202' end,
               case when max_value >= 200 and max_value < 1000 then '203' end) labels
        from user_activity where month_id = '202401'""",
    "spend_tags": """
        select user_id id, concat_ws(',',
               case when n_orders >= 1 and n_orders <= 5 then '301' end,
               case when top_priority = '5-LOW' or (max_price > 450000 and max_price <= 1000000) then '302' end) labels
        from user_spend""",
    "visit_tags": """
        select user_id id, concat_ws(',', case when event_type in ('purchase', 'click') then '401' end,
               case when value >= 100 and value <= 1000 then '402' end) labels
        from user_visit where month_id = '202401'""",
    "visit_attributes": """
        select user_id id, concat_ws('_', lac_ci, case when value >= 100 and value <= 1000 then '402' end,
               case when event_type in ('purchase', 'click') then '401' end) labels
        from user_visit""",
    "user_labels": """
        select p.id, concat_ws(',', nullif(p.labels, ''), nullif(a.labels, ''), nullif(s.labels, '')) labels,
               '202401' month_id
        from profile_tags p left join activity_tags a on p.id = a.id left join spend_tags s on p.id = s.id""",
    "user_flags": """
        select id, """ + ", ".join(
            f"case when list_contains(string_split(labels, ','), '{i}') then 1 else 0 end label_{i}"
            for i in ("101", "102", "103", "201", "202", "203", "302")
        ) + " from user_labels",
    "station_counts": """
        select lac_ci, dn_flag, """ + ", ".join(
            f"cast(sum(label_{i}) as double) label_{i}" for i in ("101", "102", "103", "201", "202", "203", "302")
        ) + " from station_live s join user_flags u on s.user_id = u.id where s.month_id = '202401' group by lac_ci, dn_flag",
    "docs": "select id, nullif(labels, '') labels from activity_tags",
    "order_profile": """
        select distinct cast(o_custkey as varchar) user_id, c_mktsegment segment, c_acctbal acctbal,
               strftime(o_orderdate, '%Y%m') month_id
        from orders join customer on o_custkey = c_custkey""",
    "order_profile_tags": """
        select user_id id, month_id, concat_ws(',', case when segment = 'BUILDING' then '101' end,
               case when segment in ('MACHINERY', 'FURNITURE') then '102' end,
               case when acctbal >= 0 and acctbal < 1000 then '103' end) labels
        from order_profile""",
    "order_spend": """
        select cast(o_custkey as varchar) user_id, count(*) n_orders, max(o_totalprice) max_price,
               min(o_orderpriority) top_priority, strftime(date_trunc('month', o_orderdate), '%Y%m') month_id,
               strftime(date_trunc('month', o_orderdate) + interval 1 month, '%Y%m') dt
        from orders group by o_custkey, date_trunc('month', o_orderdate)""",
    "order_visit_tags": """
        select cast(o_custkey as varchar) id, cast(o_orderkey % 50 as varchar) lac_ci, strftime(o_orderdate, '%Y%m') month_id,
               case when o_orderstatus in ('F', 'P') then '411' end label_411,
               case when o_totalprice >= 100000 and o_totalprice <= 300000 then '412' end label_412
        from orders""",
    "order_station": """
        select distinct cast(o_orderkey % 50 as varchar) lac_ci, cast(o_custkey as varchar) user_id,
               case when o_orderpriority < '3' then 'D' else 'N' end dn_flag, strftime(o_orderdate, '%Y%m') month_id
        from orders""",
    "order_station_counts": """
        select s.lac_ci, s.dn_flag, """ + ", ".join(
            f"cast(count(case when list_contains(string_split(t.labels, ','), '{i}') then 1 end) as double) label_{i}"
            for i in ("101", "102", "103")
        ) + """ from order_station s join order_profile_tags t on s.user_id = t.id
        where s.month_id = '199806' and t.month_id = '199806' group by s.lac_ci, s.dn_flag""",
    "order_attributes": """
        select id, string_agg(distinct attribute, ',' order by attribute) labels
        from (select id, concat_ws('_', lac_ci, label_412, label_411) attribute from order_visit_tags where month_id = '199806')
        group by id""",
    "run_events": """
        select cast(user_id as varchar) job_id, event_type job_name, 'run ' || event_id job_desc,
               strftime(ts, '%Y%m') || 'w' || cast(floor(day(ts) / 8) as integer) job_period, 'p' || event_id % 3 project,
               ts, event_id, case when value < 1 then '2' when value < 40 then '1' else '0' end status
        from events""",
    "market_lists": """
        select userid, string_agg(distinct atid, ',' order by atid) markets
        from (select b.atid, unnest(string_split(b.userids, ',')) userid
              from campaign_batch b join reached_actions a on a.atid = b.atid) group by userid""",
    "gappy": """
        select id, coalesce(label_101, '') || ',' || coalesce(label_102, '') || ',' || coalesce(label_103, '')
               || ',' || coalesce(label_104, '') || ',' || coalesce(label_105, '') labels
        from profile_matrix""",
    "gappy_items": """
        select id, case when regexp_matches(labels, '^,+$') then cast([] as varchar[])
               else string_split(regexp_replace(labels, ',+$', ''), ',') end items
        from gappy""",
    "history": """
        select cast(o_custkey as varchar) id, o_orderpriority old_labels, o_orderstatus new_labels,
               strftime(o_orderdate, '%Y%m') month_id
        from orders""",
    "part_rules": """
        select cast(p_size as varchar) id, p_type kind, floor(p_retailprice / 100) * 100 low,
               floor(p_retailprice / 100) * 100 + 100 high
        from part where p_type <> 'PROMO'""",
    "narrow_rules": """
        select 'p' || (p_partkey % 997) id, p_type kind,
               cast(cast(p_retailprice as decimal(12, 2)) - cast(p_partkey % 10 + 1 as decimal(12, 2)) / 10 as double) low,
               cast(cast(p_retailprice as decimal(12, 2)) + cast(p_partkey % 10 + 1 as decimal(12, 2)) / 10 as double) high
        from part""",
    "order_documents": """
        select cast(o_custkey as varchar) id, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) labels,
               arg_max(o_orderstatus, (o_orderdate, o_orderkey)) state
        from orders group by 1""",
    "priority_labels": """
        select cast(o_custkey as varchar) id, strftime(o_orderdate, '%Y%m') month_id,
               string_agg(distinct o_orderpriority, ',' order by o_orderpriority) labels
        from orders group by 1, 2""",
    "labels_before": "select id, labels from priority_labels where month_id = '199805'",
    "labels_after": "select id, labels from priority_labels where month_id = '199806'",
    "station_members": """
        select distinct s.lac_ci, s.user_id, unnest(string_split(u.labels, ',')) "label"
        from station_live s join user_labels u on s.user_id = u.id where s.month_id = '202401' and u.labels <> ''""",
    "orders_before": "select * from orders_monthly where month_id = '199805'",
    "orders_after": "select * from orders_monthly where month_id = '199806'",
    "pushes": "select *, o_custkey || ',' || o_orderpriority member, o_orderstatus || ',' || o_orderpriority element from orders",
}


def _needed(sql: str, done: list[str]) -> list[str]:
    for name, body in VIEWS.items():
        if name not in done and re.search(rf"\b{name}\b", sql):
            _needed(body, done)
            done.append(name)
    return done


def _sql(select: str) -> str:
    views = _needed(select, [])
    if not views:
        return select
    return "with " + ",\n".join(f"{n} as ({VIEWS[n]})" for n in views) + "\n" + select


def _append(delta: str, appended: str) -> str:
    """Document state after a delta ``(id, delta, ...)``: insert, append, or leave alone."""
    return f"""
        select coalesce(s.id, d.id) id,
               case when s.id is null then d.delta
                    when s.labels is not null and d.delta is not null then {appended}
                    else s.labels end labels
        from docs s full join ({delta}) d on s.id = d.id"""


def _removed(keep: str) -> str:
    return f"select id, array_to_string(list_filter(string_split(labels, ','), lambda x: {keep}), ',') labels from docs"


def _dates(**columns: str) -> str:
    return "select o_orderkey, " + ", ".join(f'{sql} as "{name}"' for name, sql in columns.items()) + " from orders"


def _saved(dropped: str) -> str:
    return f"""
        select id, case when month_id = '199806' then new_labels else old_labels end labels, month_id
        from history where month_id <> '{dropped}'"""


_FLAG_IDS = ("101", "102", "103", "201", "202", "203", "302")
_LINE = "l_orderkey, l_linenumber, l_quantity, l_returnflag"
_YESTERDAY = "cast(o_orderdate as date) - 1"
_MONTH_BACK = f"cast({_YESTERDAY} - interval 1 month as date)"

ORACLES = {
    "period_scan": "select * from orders_monthly where month_id = '199806'",
    "default_period_scan": "select * from orders_monthly where month_id = '199806'",
    "table_scan": "select * from orders",
    "statement_scan": """
        select o_orderkey, o_custkey, 'it''s'' or ''1'' = ''1' note from orders
        where o_orderpriority = '1-URGENT' and o_orderdate >= date '1997-01-01' and o_totalprice > 1000""",
    "controlled_periods": """
        select id, old_labels labels, month_id from history
        where month_id in (select month_id from history group by month_id having count(*) % 2 = 0)""",
    "label_catalog": "select * from part_catalog where id = '10'",
    "label_tasks": "select * from part_tasks",
    "label_tasks_single": """
        select source_name, partition_field, string_agg(distinct id, '#' order by id) pids,
               string_agg(distinct source_label, '#' order by source_label) labels
        from part_catalog where length(trim("value")) > 0 and source_name = 'brand_7'
        group by source_name, partition_field""",
    "task_screen": "select * from part_tasks where source_name in ('brand_7', 'brand_21', 'brand_99')",
    "relational_ingest": "select distinct o_custkey, o_orderstatus, o_orderpriority from orders",
    "union_distinct": """
        select user_id, event_type what from events union select o_custkey, o_orderpriority from orders""",
    "rule_conditions": """
        select id, source_name, f.field, upper(json_extract_string("value", '$.' || f.field || '.type')) match_type,
               json_extract_string("value", '$.' || f.field || '.value') match_value, cast(null as varchar) error
        from part_catalog, (values ('price'), ('kind')) f(field) where "value" <> ''
        union all
        select id, source_name, null, null, null, 'unreadable rule body' from part_catalog where "value" = ''""",
    "match_single": f"""
        select {_LINE}, l_returnflag = 'R' returned, cast(l_quantity as varchar) = '23' whole,
               cast(l_quantity as varchar) = '23.0' "double" from lineitem""",
    "match_list": f"""
        select {_LINE}, l_returnflag in ('R', ' A', 'N') flags,
               cast(l_linenumber as varchar) in ('1', '3', '5') lines from lineitem""",
    "match_range": f"""
        select {_LINE}, l_quantity >= 10 and l_quantity <= 20 closed, l_quantity > 10 and l_quantity < 20 "open",
               l_quantity >= 10 and l_quantity < 20 from_low, l_quantity > 10 and l_quantity <= 20 to_high
        from lineitem""",
    "match_range_text": """
        with a as (select event_id, try_cast(case when event_type = 'error' then event_type
                     else cast(value as varchar) end as double) amount from events)
        select event_id, case when amount >= 10.5 and amount < 99.25 then 'in' end label from a""",
    "match_all_fields": """
        select user_id, segment, acctbal, label_104 from user_profile join profile_matrix on user_id = id""",
    "match_any_row": """
        select user_id, top_priority, max_price,
               case when top_priority = '5-LOW' or (max_price > 450000 and max_price <= 1000000) then '302' end label_302
        from user_spend""",
    "label_columns": "select * from profile_matrix",
    "label_tags": "select * from profile_tags",
    "part_labels": """
        select cast(p_partkey as varchar) id, coalesce(string_agg(distinct r.id, ',' order by r.id), '') labels
        from part left join part_rules r on p_type = r.kind and p_retailprice >= r.low and p_retailprice < r.high
        group by p_partkey""",
    "line_labels": """
        , pieces as (select l_orderkey, l_linenumber, l_extendedprice / l_quantity price, p_type kind
                     from lineitem join part on l_partkey = p_partkey),
        found as (
            select p.price, p.kind, cast(count(distinct r.id) as integer) n, min(r.id) first_id
            from (select distinct price, kind from pieces) p join narrow_rules r on p.kind = r.kind and p.price > r.low and p.price <= r.high
            group by all
        )
        select l_orderkey, l_linenumber, coalesce(n, 0) n_labels, first_id first_label
        from pieces left join found using (price, kind)""",
    "composite_attr": "select * from visit_attributes",
    "multi_hot": "select id, concat_ws(',', " + ", ".join(f"label_{i}" for i in _FLAG_IDS) + ") flags from user_flags",
    "multi_hot_wide": "select id, "
    + ", ".join(f"cast(label_{i} as varchar) label_{i}" for i in _FLAG_IDS)
    + " from user_flags",
    "labels_intersect": """
        select id, array_to_string(list_filter(string_split(labels, ','), lambda x: x in ('103', '302', '201')), ',') labels
        from user_labels""",
    "base_labels": "select id, labels from user_labels",
    "base_labels_repeated": """
        select p.id, concat_ws(',', nullif(p.labels, ''), nullif(v.labels, ''), nullif(s.labels, '')) labels
        from profile_tags p left join visit_tags v on p.id = v.id left join spend_tags s on p.id = s.id""",
    "base_labels_units": """
        select p.id, concat_ws(',', nullif(p.labels, ''), case when b.top_priority <= '3-MEDIUM' then '321' end,
               case when s.n_orders = 1 then '311' end, case when s.max_price > 200000 and s.max_price <= 1000000 then '312' end) labels
        from order_profile_tags p left join order_spend s on p.id = s.user_id and s.month_id = '199806'
             left join order_spend b on p.id = b.user_id and b.dt = '199806'
        where p.month_id = '199806'""",
    "base_labels_months": """
        select p.id, concat_ws(',', nullif(p.labels, ''), v.label_411, v.label_412) labels
        from order_profile_tags p left join order_visit_tags v on p.id = v.id and v.month_id = '199806'
        where p.month_id = '199806'""",
    "station_report_months": """
        select lac_ci, dn_flag, cast(to_json({'lac_ci': lac_ci, 'dn_flag': dn_flag, 'label_101': label_101,
               'label_102': label_102, 'label_103': label_103}) as varchar) result, '199806' month_id
        from order_station_counts""",
    "station_report_saved": """
        select lac_ci, dn_flag, cast(to_json({'lac_ci': lac_ci, 'dn_flag': dn_flag, 'label_101': label_101,
               'label_102': label_102, 'label_103': label_103}) as varchar) result, '199806' month_id
        from order_station_counts""",
    "resident_attributes_months": "select * from order_attributes",
    "resident_attributes_saved": "select id, labels, '199806' month_id from order_attributes",
    "labels_append_months": _append(
        """select id, string_agg(concat_ws(',', label_411, label_412), ',' order by concat_ws(',', label_411, label_412)) delta
           from order_visit_tags where month_id = '199806' and (label_411 is not null or label_412 is not null) group by id""",
        "s.labels || ',' || d.delta",
    ),
    "user_markets_documents": """
        , n as (select t.id, t.labels, m.markets from order_profile_tags t left join market_lists m on t.id = m.userid
                where t.month_id = '199806')
        select * from n union all
        select id, labels, null from docs where id not in (select id from n)""",
    "station_join": """
        select s.lac_ci, s.user_id, s.dn_flag, u.labels from station_live s join user_labels u on s.user_id = u.id
        where s.month_id = '202401'""",
    "station_label_counts": "select * from station_counts",
    "station_label_json": """
        select lac_ci, dn_flag, cast(to_json({'lac_ci': lac_ci, 'dn_flag': dn_flag, """
    + ", ".join(f"'label_{i}': label_{i}" for i in _FLAG_IDS)
    + """}) as varchar) result, '202401' month_id from station_counts""",
    "station_label_users": """select lac_ci, "label", count(distinct user_id) users from station_members group by all""",
    "station_label_overlap": """
        select a.lac_ci, a."label" "first", b."label" "second", count(distinct a.user_id) users
        from station_members a join station_members b on a.lac_ci = b.lac_ci and a.user_id = b.user_id and a."label" < b."label"
        where a."label" in ('101', '102', '103', '201', '202', '203', '302') and b."label" in ('101', '102', '103', '201', '202', '203', '302')
        group by all""",
    "action_filter": "select * from reached_actions",
    "batch_actions": """
        select distinct b.atid, b.userids from campaign_batch b join reached_actions a on a.atid = b.atid""",
    "invert_membership": """
        select userids, string_agg(distinct atid, ',' order by atid) atid
        from (select atid, unnest(string_split(userids, ',')) userids from campaign_batch) group by userids""",
    "user_markets": """
        select u.id, u.labels, m.markets from user_labels u left join market_lists m on u.id = m.userid""",
    "resident_attributes": """
        select id, string_agg(distinct labels, ',' order by labels) labels from visit_attributes group by id""",
    "docs_with_any_label": """
        select * from docs where list_has_any(string_split(labels, ','), ['201', '203'])""",
    "docs_with_label": "select * from docs where list_contains(string_split(labels, ','), '203')",
    "doc_upsert": """
        select * from order_documents
        union all select id, labels, null from docs where id not in (select id from order_documents)""",
    "doc_upsert_month": """
        , n as (select cast(o_custkey as varchar) id, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) labels,
                       arg_max(o_orderstatus, (o_orderdate, o_orderkey)) state
                from orders_monthly where month_id = '199806' group by 1)
        select * from n union all select id, labels, null from docs where id not in (select id from n)""",
    "doc_upsert_bucketed": """
        select * from order_documents
        union all select id, labels, null from docs where id not in (select id from order_documents)""",
    "label_changes": """
        select coalesce(o.id, n.id) id, case when o.id is null then 'inserted' when n.id is null then 'gone' else 'changed' end "change", n.labels
        from labels_before o full join labels_after n on o.id = n.id where o.labels is distinct from n.labels""",
    "label_changes_applied": "select * from labels_after",
    "document_sync": "select * from labels_after",
    "docs_with_label_indexed": "select * from labels_after where list_contains(string_split(labels, ','), '1-URGENT')",
    "docs_with_all_labels_indexed": "select id from labels_after where list_has_all(string_split(labels, ','), ['1-URGENT', '2-HIGH'])",
    "label_postings": """
        select id, "label" from (select id, unnest(string_split(labels, ',')) "label" from docs) where "label" in ('201', '202')""",
    "doc_projection": "select lac_ci, longitude, latitude, per_num from station_heat where month_id = '202401'",
    "doc_projection_id_only": "select lac_ci from station_heat where month_id = '202401'",
    "labels_append_one": _append(
        "select id, '103' delta from profile_tags where list_contains(string_split(labels, ','), '103')",
        "s.labels || ',103'",
    ),
    "labels_append": _append(
        "select id, labels delta from profile_tags where labels <> ''", "s.labels || ',' || d.delta"
    ),
    "labels_add": _append(
        """select id, list_sort(list(distinct label)) added, array_to_string(list_sort(list(distinct label)), ',') delta
           from (select id, unnest(string_split(labels, ',')) label
                 from (select * from profile_tags union all select * from activity_tags) where labels <> '')
           group by id""",
        """concat_ws(',', s.labels, nullif(array_to_string(
             list_filter(d.added, lambda x: not list_contains(string_split(s.labels, ','), x)), ','), ''))""",
    ),
    "labels_remove": _removed("x <> '203'"),
    "labels_remove_tail": _append(
        """select id, list_sort(list(label)) removed, array_to_string(list_sort(list(label)), ',') delta
           from (select id, unnest(string_split(labels, ',')) label
                 from (select * from profile_tags union all select * from activity_tags))
           where label in ('103', '202', '203') group by id""",
        """array_to_string(list_filter(string_split(s.labels, ','),
             lambda x, i: i = 1 or not list_contains(d.removed, x)), ',')""",
    ),
    "labels_remove_many": _removed("x not in ('201', '203')"),
    "labels_compact": """
        select id, array_to_string(list_filter(string_split(labels, ','), lambda x: x <> ''), ',') labels from gappy""",
    "save_period": _saved("199706"),
    "save_default_period": _saved("199707"),
    "publish_period": "select id, case when month_id = '199806' then new_labels else old_labels end labels, month_id from history",
    "rolling_append": """
        select id, old_labels labels, month_id from history where month_id <> '199804'
        union all select id, new_labels, month_id from history where month_id = '199806'""",
    "kv_string": """
        select cast(o_custkey as varchar) "key",
               arg_max(o_orderstatus || ',' || o_orderpriority, (o_orderdate, o_orderkey)) "value"
        from orders group by o_custkey""",
    "kv_hash": """
        select 'user_orders' "key", o_custkey || '_' || o_orderpriority field,
               arg_max(o_orderkey || '_' || o_orderstatus, (o_orderdate, o_orderkey)) "value"
        from orders group by 2""",
    "kv_set": """select distinct 'user_set' "key", member from pushes""",
    "kv_list": """
        select 'user_list' "key", count(*) over () - row_number() over (order by o_orderdate, element) pos, element
        from pushes""",
    "kv_zset": """
        select 'user_zset' "key", member, cast(max(i) as double) score
        from (select member, row_number() over (order by o_orderdate, member) - 1 i from pushes) group by member""",
    "kv_merge_string": """
        select cast(o_custkey as varchar) "key", arg_max(o_orderstatus || ',' || o_orderpriority, (month_id, o_orderdate, o_orderkey)) "value"
        from (select * from orders_before union all select * from orders_after) group by o_custkey""",
    "kv_merge_hash": """
        select 'user_orders' "key", cast(o_custkey as varchar) field, arg_max(o_orderkey || '_' || o_orderstatus, (month_id, o_orderdate, o_orderkey)) "value"
        from (select * from orders_before union all select * from orders_after) group by o_custkey""",
    "kv_merge_set": """
        select distinct 'user_set' "key", o_custkey || ',' || o_orderpriority member
        from (select * from orders_before union all select * from orders_after)""",
    "kv_merge_list": """
        select 'user_list' "key", count(*) over () - row_number() over (order by month_id, o_orderdate, element) pos, element
        from (select month_id, o_orderdate, o_orderstatus || ',' || o_orderpriority element
              from (select * from orders_before union all select * from orders_after))""",
    "kv_merge_zset": """
        select 'user_zset' "key", member, cast(arg_max(i, (month_id, i)) as double) score
        from (select month_id, cast(o_custkey as varchar) member,
                     row_number() over (partition by month_id order by o_orderdate, cast(o_custkey as varchar)) - 1 i
              from (select * from orders_before union all select * from orders_after)) group by member""",
    "run_log_latest": """
        select job_id, job_name, arg_max(job_desc, (ts, event_id)) filter (where status = '0') job_desc, job_period,
               arg_max(project, (ts, event_id)) filter (where status = '0') project,
               strftime(min(ts) filter (where status = '0'), '%Y-%m-%d %H:%M:%S') create_time,
               case when arg_max(status, (ts, event_id)) <> '0' then strftime(max(ts), '%Y-%m-%d %H:%M:%S') end end_time,
               arg_max(status, (ts, event_id)) status, 'it"s ' || job_name result
        from run_events group by job_id, job_name, job_period having count(*) filter (where status = '0') > 0""",
    "run_log_compacted": """
        select job_id, job_name, arg_max(job_desc, (ts, event_id)) filter (where status = '0') job_desc, job_period,
               arg_max(project, (ts, event_id)) filter (where status = '0') project,
               strftime(min(ts) filter (where status = '0'), '%Y-%m-%d %H:%M:%S') create_time,
               case when arg_max(status, (ts, event_id)) <> '0' then strftime(max(ts), '%Y-%m-%d %H:%M:%S') end end_time,
               arg_max(status, (ts, event_id)) status, 'it"s ' || job_name result
        from run_events group by job_id, job_name, job_period having count(*) filter (where status = '0') > 0""",
    "csv_split": "select id, cast(len(items) as integer) n, array_to_string(items, '|') items from gappy_items",
    "csv_join": "select user_id, segment || ',' || nation joined from user_profile",
    "csv_clean_split": "select user_id, 2 n, segment || '|' || nation items from user_profile",
    "csv_prefix": """
        select id, array_to_string(list_transform(items, lambda x: 'label_' || x), ',') prefixed from gappy_items""",
    "csv_quote": """
        select id, array_to_string(list_transform(items, lambda x: '"' || x || '"'), ',') quoted from gappy_items""",
    "csv_alias_list": """
        select id, ' ' || array_to_string(list_transform(items, lambda x: '''' || x || ''' as label_' || x), ',') aliased
        from gappy_items""",
    "str_map": "select o_orderkey, 2 n, substr(o_orderpriority, 1, 1) status, o_orderpriority priority from orders",
    "template_fill": "select event_id, user_id || ' 202402: ' || event_type || ' of ' || user_id filled from events",
    "json_field": "select event_id, json_extract_string(props, '$.k') k from events",
    "fmt_datetime": """
        select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') long_form, strftime(ts, '%Y%m%d%H%M%S') short_form from events""",
    "month_of": _dates(month="strftime(o_orderdate, '%Y%m')"),
    "year_ago_month": _dates(month="strftime(o_orderdate - interval 1 year, '%Y%m')"),
    "last_month_day": _dates(day="strftime(date_trunc('month', o_orderdate) - interval 1 day, '%Y%m%d')"),
    "last_month_id": _dates(month="strftime(date_trunc('month', o_orderdate) - interval 1 day, '%Y%m')"),
    "next_month": _dates(month="strftime(date_trunc('month', o_orderdate) + interval 1 month, '%Y%m')"),
    "months_before": _dates(
        year_before="strftime(date_trunc('month', o_orderdate) - interval 12 month, '%Y%m')",
        by_line="strftime(date_trunc('month', o_orderdate) - to_months(cast(substr(o_orderpriority, 1, 1) as integer)), '%Y%m')",
    ),
    "n_months_ago_day": _dates(
        day="strftime(o_orderdate - interval 6 month, '%Y%m%d')",
        short="strftime(o_orderdate - interval 1 month, '%Y%m%d')",
    ),
    "comparison_dates": _dates(
        base_day=f"strftime({_YESTERDAY}, '%Y%m%d')",
        base_month=f"strftime({_YESTERDAY}, '%Y%m')",
        day_before="strftime(cast(o_orderdate as date) - 2, '%Y%m%d')",
        prev_month=f"strftime({_MONTH_BACK}, '%Y%m')",
        prev_month_day=f"strftime({_MONTH_BACK}, '%Y%m%d')",
    ),
}


def oracle_sql() -> dict[str, str]:
    return {name: _sql(" ".join(sql.split("\n"))) for name, sql in ORACLES.items()}
