"""Alerts as HTML mails, built by column expressions on the executors."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardinel.functions import mask_card, money, risk_colour, shown, shown_time, yes_no
from cardinel.streaming.batches import BATCH

# How the subject lines begin.
LIMIT_SUBJECT = "⚠️ Limit-Exceeded Transaction Alert - "
CARD_SUBJECT = "🚨 Fraud Card Alert ["
CARD_SUBJECT_END = "] - "

Facts = dict[str, Column]


def render_limit_notifications(alerts: DataFrame) -> DataFrame:
    facts = {
        "Transaction": shown("transaction_id"),
        "Amount": _price("transaction_amount"),
        "Limit": _price("transaction_limit"),
        "Merchant": _pair("merchant_name", "merchant_category"),
        "Place": F.concat(shown("city"), F.lit(", "), shown("country")),
        "Time": shown_time("transaction_timestamp"),
        "Alert": shown("alert_id"),
    }
    body = _mail(
        "A card payment went over your limit",
        [("Payment", facts)],
        "Nothing needs doing if you made this payment. If you did not, call us at once.",
    )
    subject = F.concat(F.lit(LIMIT_SUBJECT), shown("alert_id"))
    return _notification(alerts, subject, body, ["transaction_amount", "transaction_limit"])


def render_card_notifications(alerts: DataFrame) -> DataFrame:
    badge = F.concat(
        F.lit('<b style="color:'),
        risk_colour("risk_level"),
        F.lit('">'),
        shown("risk_level"),
        F.lit("</b>"),
    )
    alert = {
        "Alert": shown("alert_id"),
        "Kind": shown("alert_type"),
        "Risk": badge,
        "Raised": shown_time("alert_timestamp"),
    }
    payment = {
        "Card": mask_card("card_number"),
        "Transaction": shown("transaction_id"),
        "Amount": _price("amount"),
        "Type": shown("transaction_type"),
        "Channel": shown("payment_channel"),
        "Merchant": _pair("merchant_name", "merchant_category"),
        "Place": F.concat(shown("transaction_city"), F.lit(", "), shown("transaction_country")),
        "Abroad": yes_no("is_international"),
        "Time": shown_time("transaction_timestamp"),
        "Status": shown("transaction_status"),
    }
    entry = {
        "Entry": shown("watchlist_id"),
        "Watched": shown("watch_type"),
        "Reason": _pair("reason_code", "reason_description"),
        "Action": shown("action"),
        "Reported by": _pair("reported_by", "reported_source"),
        "In force since": shown_time("watchlist_effective_from"),
    }
    body = _mail(
        "A card on the watchlist was used",
        [("Alert", alert), ("Payment", payment), ("Watchlist", entry)],
        "Call us at once if you did not make this payment, and consider blocking the card. "
        "Ignore this mail if you made it.",
    )
    subject = F.concat(
        F.lit(CARD_SUBJECT), shown("risk_level"), F.lit(CARD_SUBJECT_END), shown("alert_id")
    )
    return _notification(alerts, subject, body, ["amount"])


def notification_counts(notifications: DataFrame) -> DataFrame:
    """All, deliverable and undeliverable notifications, as one row."""
    return notifications.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("deliverable").alias("succeeded"),
        F.count_if(~F.col("deliverable")).alias("failed"),
    )


def _notification(
    alerts: DataFrame, subject: Column, body: Column, amounts: list[str]
) -> DataFrame:
    """The body is NULL if an amount is; without body or address it cannot go out.

    Whether it can is read from the amounts, so that counting renders nothing. The batch
    that raised an alert goes with it, if it is known.
    """
    complete = reduce(and_, [F.col(name).isNotNull() for name in amounts])
    addressed = F.coalesce(F.col("customer_email") != "", F.lit(False))
    return alerts.select(
        "alert_id",
        F.col("customer_email").alias("recipient"),
        subject.alias("subject"),
        body.alias("body"),
        (addressed & complete).alias("deliverable"),
        *[name for name in alerts.columns if name == BATCH],
    )


def _price(amount: str) -> Column:
    return F.concat(shown("currency"), F.lit(" "), money(amount))


def _pair(name: str, detail: str) -> Column:
    return F.concat(shown(name), F.lit(" ("), shown(detail), F.lit(")"))


def _mail(title: str, sections: list[tuple[str, Facts]], advice: str) -> Column:
    parts: list[Column | str] = [
        f"<html><body><h2>{title}</h2><p>Dear ",
        shown("customer_name"),
        ",</p>",
    ]
    for heading, facts in sections:
        parts.append(f"<h3>{heading}</h3><table>")
        for label, value in facts.items():
            parts += [f"<tr><th>{label}</th><td>", value, "</td></tr>"]
        parts.append("</table>")
    parts.append(f"<p>{advice}</p></body></html>")
    return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])
