"""The same results in plain SQL, written for an engine other than Spark."""

from __future__ import annotations

import re

from testbed.mapping import CUSTOMERS, HOME, TRANSACTIONS, WATCHLIST_ENTRIES


def _mapped(columns: dict[str, str], source: str) -> str:
    selected = ", ".join(f"{expression} as {name}" for name, expression in columns.items())
    return f"select {selected} from {source}"


# Named steps; a query gets those it refers to, in this order.
STEPS = {
    "raw_transactions": _mapped(TRANSACTIONS, "events"),
    "raw_customers": _mapped(CUSTOMERS, f"customer join nation on {HOME}"),
    "raw_watchlist": _mapped(WATCHLIST_ENTRIES, "supplier"),
    "transactions": """
        select * from raw_transactions
        where transaction_id is not null and customer_id is not null
          and card_number is not null and merchant_id is not null
          and transaction_timestamp is not null
    """,
    "customers": """
        select * replace (cast(try_strptime(account_open_date, '%Y-%m-%d') as date)
                          as account_open_date)
        from raw_customers where customer_id is not null
    """,
    "watchlist": """
        select * replace (upper(watchlist_id) as watchlist_id, upper(entity_id) as entity_id,
                          upper(action) as action, upper(risk_level) as risk_level,
                          try_strptime(effective_from, '%d-%b-%Y %H:%M:%S') as effective_from)
        from raw_watchlist
    """,
    "limit_alerts": """
        select 'ALERT-' || transaction_id as alert_id,
               'LIMIT_EXCEEDED_TRANSACTION' as alert_type,
               transaction_timestamp as alert_timestamp,
               transaction_id, t.customer_id, email as customer_email,
               concat_ws(' ', first_name, last_name) as customer_name,
               amount as transaction_amount, transaction_limit, currency, merchant_name,
               merchant_category, transaction_type, payment_channel, t.city, t.country,
               is_international, transaction_timestamp, status
        from transactions t left join customers c on t.customer_id = c.customer_id
        where amount > transaction_limit
    """,
    "card_alerts": """
        select concat_ws('-', 'FRAUD', transaction_id, watchlist_id) as alert_id,
               'FRAUD_WATCHLIST_MATCH' as alert_type,
               transaction_timestamp as alert_timestamp,
               transaction_id, t.customer_id, email as customer_email,
               concat_ws(' ', first_name, last_name) as customer_name,
               t.card_number, amount, currency, merchant_id, merchant_name, merchant_category,
               transaction_type, payment_channel, device_id, t.city as transaction_city,
               t.country as transaction_country, transaction_timestamp, is_international,
               t.status as transaction_status, watchlist_id, watch_type, risk_level, action,
               reason_code, reason_description, effective_from as watchlist_effective_from,
               reported_by, reported_source, w.city as watchlist_city,
               w.country as watchlist_country
        from transactions t
        join watchlist w on t.card_number = w.entity_id
        left join customers c on t.customer_id = c.customer_id
    """,
    "tumbling": """
        select date_trunc('minute', transaction_timestamp) as window_start,
               date_trunc('minute', transaction_timestamp) + interval 1 minute as window_end,
               count(*) as transaction_count
        from transactions group by 1, 2
    """,
    "sliding": """
        select date_trunc('minute', transaction_timestamp) - to_minutes(ago) as window_start,
               date_trunc('minute', transaction_timestamp) - to_minutes(ago)
                 + interval 5 minute as window_end,
               count(*) as transaction_count
        from transactions cross join (select unnest([0, 1, 2, 3, 4]) as ago) group by 1, 2
    """,
    "closing": """
        select date_trunc('milliseconds', max(transaction_timestamp)) - interval 5 minute
                 as watermark
        from transactions
    """,
}


def _time(column: str) -> str:
    return (
        f"coalesce(case when date_trunc('second', {column}) = {column} "
        f"then strftime({column}, '%Y-%m-%d %H:%M:%S') "
        f"else strftime({column}, '%Y-%m-%d %H:%M:%S.%f') end, 'None')"
    )


def _text(column: str) -> str:
    return f"coalesce(cast({column} as varchar), 'None')"


def _masked(column: str) -> str:
    return (
        f"case when length({column}) >= 4 then '**** **** **** ' || right({column}, 4) "
        "else '****' end"
    )


_COLOUR = """case upper(risk_level) when 'CRITICAL' then '#b91c1c' when 'HIGH' then '#d9534f'
             when 'MEDIUM' then '#f0ad4e' when 'LOW' then '#5cb85c' else '#6c757d' end"""
_ABROAD = "case when is_international then 'Yes' else 'No' end"


def _row(label: str, value: str) -> str:
    return f"'<tr><th>{label}</th><td>' || {value} || '</td></tr>'"


def _pair(name: str, detail: str) -> str:
    return f"{_text(name)} || ' (' || {_text(detail)} || ')'"


def _place(city: str, country: str) -> str:
    return f"{_text(city)} || ', ' || {_text(country)}"


def _price(column: str) -> str:
    return f"{_text('currency')} || ' ' || format('{{:,.2f}}', {column})"


def _table(heading: str, *rows: str) -> str:
    return f"'<h3>{heading}</h3><table>' || " + " || ".join(rows) + " || '</table>'"


def _body(title: str, tables: list[str], advice: str) -> str:
    return (
        f"'<html><body><h2>{title}</h2><p>Dear ' || {_text('customer_name')} || ',</p>' || "
        + " || ".join(tables)
        + f" || '<p>{advice}</p></body></html>'"
    )


STEPS["limit_mails"] = f"""
    select alert_id, customer_email as recipient,
           '⚠️ Limit-Exceeded Transaction Alert - ' || alert_id as subject,
           {_body(
               "A card payment went over your limit",
               [_table(
                   "Payment",
                   _row("Transaction", _text("transaction_id")),
                   _row("Amount", _price("transaction_amount")),
                   _row("Limit", _price("transaction_limit")),
                   _row("Merchant", _pair("merchant_name", "merchant_category")),
                   _row("Place", _place("city", "country")),
                   _row("Time", _time("transaction_timestamp")),
                   _row("Alert", _text("alert_id")),
               )],
               "Nothing needs doing if you made this payment. "
               "If you did not, call us at once.",
           )} as body,
           customer_email is not null and customer_email <> '' as deliverable
    from limit_alerts
"""

STEPS["card_mails"] = f"""
    select alert_id, customer_email as recipient,
           '🚨 Fraud Card Alert [' || {_text("risk_level")} || '] - ' || alert_id as subject,
           {_body(
               "A card on the watchlist was used",
               [
                   _table(
                       "Alert",
                       _row("Alert", _text("alert_id")),
                       _row("Kind", _text("alert_type")),
                       _row("Risk", f"'<b style=\"color:' || {_COLOUR} || '\">' || "
                            f"{_text('risk_level')} || '</b>'"),
                       _row("Raised", _time("alert_timestamp")),
                   ),
                   _table(
                       "Payment",
                       _row("Card", _masked("card_number")),
                       _row("Transaction", _text("transaction_id")),
                       _row("Amount", _price("amount")),
                       _row("Type", _text("transaction_type")),
                       _row("Channel", _text("payment_channel")),
                       _row("Merchant", _pair("merchant_name", "merchant_category")),
                       _row("Place", _place("transaction_city", "transaction_country")),
                       _row("Abroad", _ABROAD),
                       _row("Time", _time("transaction_timestamp")),
                       _row("Status", _text("transaction_status")),
                   ),
                   _table(
                       "Watchlist",
                       _row("Entry", _text("watchlist_id")),
                       _row("Watched", _text("watch_type")),
                       _row("Reason", _pair("reason_code", "reason_description")),
                       _row("Action", _text("action")),
                       _row("Reported by", _pair("reported_by", "reported_source")),
                       _row("In force since", _time("watchlist_effective_from")),
                   ),
               ],
               "Call us at once if you did not make this payment, and consider blocking the "
               "card. Ignore this mail if you made it.",
           )} as body,
           customer_email is not null and customer_email <> '' and amount is not null
             as deliverable
    from card_alerts
"""

_TRANSACTION_COLUMNS = """
    transaction_id, customer_id, card_number, merchant_id, merchant_name, merchant_category,
    amount, currency, transaction_type, payment_channel, device_id, city, country,
    cast(transaction_timestamp as varchar) as transaction_timestamp, is_international, status
"""

_FROM_KAFKA = f"""
    select {_TRANSACTION_COLUMNS}, 'transactions' as kafka_topic,
           cast(cast(substr(transaction_id, 2) as bigint) % 8 as int) as kafka_partition,
           cast(substr(transaction_id, 2) as bigint) as kafka_offset,
           cast(transactions.transaction_timestamp as varchar) as kafka_timestamp
    from transactions
"""

_WATCHLIST_COLUMNS = """
    * replace (cast(effective_from as varchar) as effective_from),
    cast(null as varchar) as _rescued_data
"""

_LIMIT_ALERTS = """
    select * exclude (alert_timestamp)
           replace (cast(transaction_timestamp as varchar) as transaction_timestamp)
    from limit_alerts
"""

_CARD_ALERTS = """
    select * exclude (alert_timestamp)
           replace (cast(transaction_timestamp as varchar) as transaction_timestamp,
                    cast(watchlist_effective_from as varchar) as watchlist_effective_from)
    from card_alerts
"""

_WINDOW_COLUMNS = """
    cast(window_start as varchar) as window_start, cast(window_end as varchar) as window_end,
    transaction_count
"""

_RULE_COUNTS = """
    select count(*) as "rows",
           count(*) - count(*) filter (where amount > 0) as valid_transaction_amount,
           count(*) - count(transaction_id) as valid_transaction_id,
           count(*) - count(customer_id) as valid_customer_id,
           count(*) - count(card_number) as valid_card_number,
           count(*) - count(merchant_id) as valid_merchant_id,
           count(*) - count(transaction_timestamp) as valid_transaction_timestamp
    from raw_transactions
"""


def _counted(label: str, table: str, count: str, top: int | None = None) -> str:
    limit = f" limit {top}" if top else ""
    return (
        f"select {label}, count(*) as {count} from {table} group by {label} "
        f"order by {count} desc, {label}{limit}"
    )


def _summed(label: str, count: str, dataset: str) -> str:
    return (
        f"select {label}, cast(sum({count}) as bigint) as sum_{count} "
        f"from ({dataset}) group by {label}"
    )


_STATS = """
    count(*) as total,
    count(*) filter (where deliverable) as succeeded,
    count(*) filter (where not deliverable) as failed
"""

_SCOPE = """
    select case when is_international then 'International' else 'Domestic' end
             as transaction_scope,
           count(*) as transaction_count
    from transactions group by is_international
"""

_MERCHANTS = _counted("merchant_category", "transactions", "transaction_count", 10)
_CITIES = _counted("city", "transactions", "transaction_count", 10)
_CHANNELS = _counted("payment_channel", "transactions", "transaction_count")
_REASONS = _counted("reason_code", "card_alerts", "alert_count")
_RISKS = _counted("risk_level", "card_alerts", "alert_count")

_MARK = "select max(cast(substr(watchlist_id, 3) as bigint)) as mark from raw_watchlist"

QUERIES = {
    "kafka_envelope": """
        select cast(event_id as varchar) as "key", props as value, 'transactions' as topic,
               cast(event_id % 8 as int) as "partition", event_id as "offset",
               cast(ts as varchar) as "timestamp", 0 as "timestampType"
        from events
    """,
    "kafka_batch_table": f"""
        select {_TRANSACTION_COLUMNS.replace("cast(transaction_timestamp",
                                             "cast(raw_transactions.transaction_timestamp")},
               transaction_id as "key", 'transactions' as topic,
               cast(cast(substr(transaction_id, 2) as bigint) % 8 as int) as "partition",
               cast(substr(transaction_id, 2) as bigint) as "offset",
               cast(raw_transactions.transaction_timestamp as varchar) as "timestamp",
               0 as "timestampType"
        from raw_transactions
    """,
    "silver_transactions": f"select {_TRANSACTION_COLUMNS} from transactions",
    "silver_transactions_from_json": _FROM_KAFKA,
    "silver_transactions_stream": _FROM_KAFKA,
    "expectation_metrics": _RULE_COUNTS,
    "expectation_metrics_customers": """
        select count(*) as "rows", count(*) - count(customer_id) as valid_customer_id
        from raw_customers
    """,
    "expectation_metrics_stream": _RULE_COUNTS,
    "silver_customers": """
        select * replace (cast(account_open_date as varchar) as account_open_date,
                          cast(update_timestamp as varchar) as update_timestamp)
        from customers
    """,
    "silver_watchlist": f"select {_WATCHLIST_COLUMNS} from watchlist",
    "watchlist_json_stream": f"""
        select {_WATCHLIST_COLUMNS}, true as from_json_file from watchlist
    """,
    "rescued_watchlist": """
        select watchlist_id, score,
               case when rest <> '' then '{' || rest || '}' end as _rescued_data
        from (select 'WL' || s_suppkey as watchlist_id,
                     case when s_acctbal >= 0 then cast(s_nationkey as double) end as score,
                     concat_ws(',',
                       case when s_acctbal < 0 then '"score":"overdrawn"' end,
                       case when s_nationkey > 12 then '"note":"' || s_name || '"' end,
                       case when s_nationkey > 18
                            then '"nation":"{\\"key\\":' || s_nationkey || '}"' end) as rest
              from supplier)
        union all select null, null, case s_nationkey % 3
            when 0 then '{"watchlist_id":"CUT' || s_suppkey else 'line ' || s_suppkey end
          from supplier where s_nationkey % 3 < 2
        union all select 'A' || s_suppkey, null, null from supplier where s_nationkey % 3 = 2
        union all select 'B' || s_suppkey, 2.5e0, null from supplier where s_nationkey % 3 = 2
    """,
    "inferred_schema": """
        select *, cast(null as varchar) as _rescued_data
        from (select s_suppkey, s_name, cast(s_nationkey as bigint) as s_nationkey, s_acctbal
              from supplier)
    """,
    "landed_watchlist_mark": _MARK,
    "export_new_watchlist": """
        select * replace (upper(watchlist_id) as watchlist_id) from raw_watchlist
        where cast(substr(watchlist_id, 3) as bigint) >
              (select avg(cast(substr(watchlist_id, 3) as bigint)) from raw_watchlist)
    """,
    "table_round_trip": f"""
        select {_TRANSACTION_COLUMNS.replace("cast(transaction_timestamp",
                                             "cast(raw_transactions.transaction_timestamp")},
               'silver' as quality
        from raw_transactions
    """,
    "table_inspection": """
        select count(*) as row_count,
               'transaction_id,customer_id,card_number,merchant_id,merchant_name,'
               || 'merchant_category,amount,currency,transaction_type,payment_channel,'
               || 'device_id,city,country,transaction_timestamp,is_international,status'
                 as column_names
        from transactions
    """,
    "limit_alerts_batch": _LIMIT_ALERTS,
    "limit_alerts_stream": _LIMIT_ALERTS,
    "card_alerts_batch": _CARD_ALERTS,
    "card_alerts_salted": _CARD_ALERTS,
    "card_alerts_stream": _CARD_ALERTS,
    "window_tumbling_batch": f"select {_WINDOW_COLUMNS} from tumbling",
    "window_sliding_batch": f"select {_WINDOW_COLUMNS} from sliding",
    "window_tumbling_stream": f"""
        select {_WINDOW_COLUMNS} from tumbling, closing where tumbling.window_end <= watermark
    """,
    "window_sliding_stream": f"""
        select {_WINDOW_COLUMNS} from sliding, closing where sliding.window_end <= watermark
    """,
    "limit_notifications": "select * from limit_mails",
    "card_notifications": "select * from card_mails",
    "notification_stats": f"select {_STATS} from card_mails",
    "outbox_stream": "select *, cast(0 as bigint) as batch_id from limit_mails",
    "outbox_stream_stats": f"select cast(0 as bigint) as batch_id, {_STATS} from limit_mails",
    "display_values": f"""
        select alert_id, {_masked("card_number")} as masked_card, {_COLOUR} as risk_colour,
               {_ABROAD} as abroad, format('{{:,.2f}}', amount) as money,
               {_text("customer_email")} as email,
               {_time("transaction_timestamp")} as paid_at,
               {_time("watchlist_effective_from")} as listed_from
        from card_alerts
    """,
    "txn_by_merchant": _MERCHANTS,
    "txn_by_minute": """
        select cast(window_start as varchar) as window_start, transaction_count
        from tumbling order by 1
    """,
    "fraud_card_alerts_count": "select count(*) as fraud_card_alerts from card_alerts",
    "fraud_by_reason": _REASONS,
    "intl_vs_domestic": _SCOPE,
    "top_cities": _CITIES,
    "fraud_by_risk": _RISKS,
    "limit_exceeded_count": "select count(*) as limit_exceeded_alerts from limit_alerts",
    "recent_limit_alerts": """
        select alert_id, cast(alert_timestamp as varchar) as alert_timestamp, customer_name,
               customer_email, round(transaction_amount, 2) as transaction_amount,
               transaction_limit, currency, merchant_name, merchant_category,
               payment_channel, city, status
        from limit_alerts order by limit_alerts.alert_timestamp desc, alert_id limit 50
    """,
    "recent_fraud_alerts": """
        select alert_id, cast(alert_timestamp as varchar) as alert_timestamp, customer_name,
               customer_email, card_number, round(amount, 2) as amount, currency,
               merchant_name, merchant_category, transaction_city, risk_level, reason_code,
               watch_type
        from card_alerts order by card_alerts.alert_timestamp desc, alert_id limit 50
    """,
    "total_transactions": "select count(*) as total_transactions from transactions",
    "txn_by_channel": _CHANNELS,
    "total_volume": "select round(sum(amount) / 1000000, 2) as total_volume_m from transactions",
    "widget_txn_by_merchant": _summed("merchant_category", "transaction_count", _MERCHANTS),
    "widget_txn_by_channel": _summed("payment_channel", "transaction_count", _CHANNELS),
    "widget_fraud_by_risk": _summed("risk_level", "alert_count", _RISKS),
    "widget_fraud_by_reason": _summed("reason_code", "alert_count", _REASONS),
    "widget_intl_vs_domestic": _summed("transaction_scope", "transaction_count", _SCOPE),
    "dashboard_overview": """
        select merchant_category, city, payment_channel, is_international,
               cast(grouping(merchant_category, city, payment_channel, is_international)
                    as bigint) as level,
               count(*) as transaction_count, round(sum(amount), 2) as amount
        from transactions
        group by grouping sets ((merchant_category), (city), (payment_channel),
                                (is_international), ())
    """,
    "dashboard_datasets": f"""
        select 'txn_by_merchant' as dataset,
               merchant_category || '|' || transaction_count as content from ({_MERCHANTS})
        union all select 'intl_vs_domestic', transaction_scope || '|' || transaction_count
          from ({_SCOPE})
        union all select 'top_cities', city || '|' || transaction_count from ({_CITIES})
        union all select 'txn_by_channel', payment_channel || '|' || transaction_count
          from ({_CHANNELS})
        union all select 'total_transactions', cast(count(*) as varchar) from transactions
        union all select 'total_volume', cast(round(sum(amount) / 1000000, 2) as varchar)
          from transactions
        union all select 'txn_by_minute', window_start || '|' || transaction_count from tumbling
        union all select 'fraud_card_alerts_count', cast(count(*) as varchar) from card_alerts
        union all select 'fraud_by_reason', reason_code || '|' || alert_count from ({_REASONS})
        union all select 'fraud_by_risk', risk_level || '|' || alert_count from ({_RISKS})
        union all select 'limit_exceeded_count', cast(count(*) as varchar) from limit_alerts
        union all select 'recent_limit_alerts', concat_ws('|', alert_id,
            alert_timestamp, customer_name, currency, merchant_name)
          from (select * from limit_alerts order by alert_timestamp desc, alert_id limit 50)
        union all select 'recent_fraud_alerts', concat_ws('|', alert_id,
            alert_timestamp, customer_name, currency, merchant_name)
          from (select * from card_alerts order by alert_timestamp desc, alert_id limit 50)
    """,
    "monitor_run_once": """
        select 'bronze.transactions' as table_name, concat_ws('|', transaction_id, 'transactions',
            cast(substr(transaction_id, 2) as bigint) % 8,
            cast(substr(transaction_id, 2) as bigint)) as content from raw_transactions
        union all select 'bronze.watchlist',
            concat_ws('|', watchlist_id, entity_id, effective_from, status) from raw_watchlist
        union all select 'silver.transactions', concat_ws('|', transaction_id, customer_id,
            card_number, merchant_name, currency, city, transaction_timestamp, is_international,
            status) from transactions
        union all select 'silver.watchlist',
            concat_ws('|', watchlist_id, entity_id, risk_level, effective_from) from watchlist
        union all select 'silver.customers',
            concat_ws('|', customer_id, card_number, email, account_open_date) from customers
        union all select 'gold.transaction_alerts', concat_ws('|', alert_id, customer_id,
            customer_name, customer_email, currency) from limit_alerts
        union all select 'gold.card_matches',
            concat_ws('|', transaction_id, card_number, watchlist_id, risk_level)
          from transactions join watchlist on card_number = entity_id
        union all select 'gold.fraud_card_alerts', concat_ws('|', alert_id, customer_id,
            customer_name, customer_email, risk_level) from card_alerts
        union all select 'gold.transaction_count_by_minute_tumbling_window',
            concat_ws('|', window_start, window_end, transaction_count)
          from tumbling, closing where tumbling.window_end <= watermark
        union all select 'gold.transaction_count_by_minute_sliding_window',
            concat_ws('|', window_start, window_end, transaction_count)
          from sliding, closing where sliding.window_end <= watermark
        union all select 'outbox.gold.transaction_alerts',
            concat_ws('|', alert_id, recipient, subject, body, deliverable) from limit_mails
        union all select 'outbox.gold.fraud_card_alerts',
            concat_ws('|', alert_id, recipient, subject, deliverable) from card_mails
    """,
}

QUERIES["card_alerts_history"] = QUERIES["card_alerts_stream"]
QUERIES["dashboard_incremental"] = QUERIES["dashboard_datasets"]


def statement(name: str) -> str:
    """A query with the steps it needs in front."""
    needed: list[str] = []

    def add(sql: str) -> None:
        for step in STEPS:
            if step not in needed and re.search(rf"\b{step}\b", sql):
                add(STEPS[step])
                needed.append(step)

    add(QUERIES[name])
    if not needed:
        return QUERIES[name]
    steps = ", ".join(f"{step} as ({STEPS[step]})" for step in needed)
    return f"with {steps} {QUERIES[name]}"
