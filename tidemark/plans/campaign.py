"""The monthly audience, feature, score and target tables of a notification campaign.

Every source is reduced to one row per customer in a single scan and a single shuffle on the
customer, whatever the number of windows; the joins that follow share that key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.periods import (
    TrailingWindow,
    period_end,
    period_start,
    shift_label,
    trailing_windows,
)
from tidemark.functions.scalars import NO, YES, as_int64, exclude_patterns, matches_any, month_flag
from tidemark.operators.audience import (
    audience,
    distinct_members,
    exclude_members,
    flag_unset_or_yes,
    not_blank,
    star_join,
)
from tidemark.operators.features import (
    amount_total,
    count_total,
    event_count,
    highest,
    latest_per_key,
    trailing_features,
)
from tidemark.operators.target import capped_count_target, unnest

KEY = "customer_id"

# Measure families of the feature table, and its categorical columns.
FAMILIES = (
    "SELLER", "FUNDER", "RECIEVER", "BORROWER", "COMPRAS_WEB", "COMPRAS_APP",
    "PRODUTOS_BANCARIOS", "TRANSFERENCIAS_DIFFTIT", "TRANSFERENCIAS_MSMTIT", "SAQUES",
)
CATEGORIES = ("CLUSTER", "PRINCIPALIDADE", "FLAG_DATA_OUT", "CICLO_DE_VIDA", "FLAG_CARTAO_CREDITO")
SUFFIXES = ("30", "60", "90")
TARGET_CAP = 10


@dataclass(frozen=True)
class Sources:
    """Source tables under neutral names; columns as used below."""

    consents: DataFrame  # customer_id, consent_type, consent_status, status_ts
    app_devices: DataFrame  # customer_id, marketplace, status, active, platform, site, token
    notifications: DataFrame  # customer_id, event_type, event_date, site, path, business, batch_id, campaign_id
    daily_balances: DataFrame  # customer_id, day, available_balance
    segments: DataFrame  # customer_id, segment, month_id, site
    employees: DataFrame  # customer_id, status, end_date
    lifecycle: DataFrame  # customer_id, stage, category, photo_id, site
    monthly_activity: DataFrame  # customer_id, month_id, site, measures
    card_accounts: DataFrame  # customer_id, status
    loyalty_log: DataFrame  # customer_id, level, level_from, site


@dataclass(frozen=True)
class Rules:
    """Values that a deployment filters by, and its measure columns per family."""

    site: str
    marketplaces: Sequence[str]
    platforms: Sequence[str]
    path: str
    business: str
    excluded_segment: str
    consent_in: str
    consent_out: str
    consent_statuses: Sequence[str]
    employee_status: str
    campaign_patterns: Sequence[str]
    batch_exclusions: Sequence[str]
    oldest_batch_exclusions: Sequence[str] = ()
    device_status: str = "ACTIVE"
    device_active: str = "YES"
    card_status: str = "ACTIVE"
    shown: str = "shown"
    opened: str = "open"
    amounts: Mapping[str, Sequence[str]] = field(default_factory=dict)
    counts: Mapping[str, Sequence[str]] = field(default_factory=dict)


def active_customers(src: Sources, rules: Rules) -> DataFrame:
    """Customers with a usable device."""
    return audience(
        src.app_devices,
        KEY,
        [
            F.col("marketplace").isin(list(rules.marketplaces)),
            F.col("status") == rules.device_status,
            F.col("active") == rules.device_active,
            F.col("platform").isin(list(rules.platforms)),
            F.col("site") == rules.site,
            not_blank(F.col("token")),
        ],
    )


def current_employees(src: Sources, rules: Rules) -> DataFrame:
    return distinct_members(
        src.employees, KEY, (F.upper("status") == rules.employee_status) & F.col("end_date").isNull()
    )


def consent_flags(src: Sources, rules: Rules, month: str) -> DataFrame:
    """Per customer: whether data goes out, and whether the latest data-in consent is of M-1.

    The flag depends on the latest timestamp alone, so a maximum stands for the latest row. Consents
    of the last day of M-1 are left out.
    """
    previous = shift_label(month, -1)
    first, last = period_start(previous), period_end(previous)
    comes_in = (
        (F.col("consent_type") == rules.consent_in)
        & F.col("consent_status").isin(list(rules.consent_statuses))
        & (F.col("status_ts") < F.lit(last))
    )
    goes_out = F.col("consent_type") == rules.consent_out
    per_customer = (
        src.consents.where(F.col(KEY).isNotNull() & (comes_in | goes_out))
        .groupBy(KEY)
        .agg(
            F.max(F.when(comes_in, F.col("status_ts"))).alias("__in"),
            F.max(F.when(goes_out, 1)).alias("__out"),
        )
    )
    return per_customer.select(
        KEY,
        F.when(F.col("__in").isNotNull(), month_flag(F.col("__in"), first, last)).alias("flag_in_month"),
        F.col("__out").isNotNull().alias("has_data_out"),
    )


def notification_counts(src: Sources, rules: Rules, month: str, full: bool = True) -> DataFrame:
    """Shown and opened notifications in M-1, M-2, M-3 and in the campaign to date, from one scan.

    ``full=False`` keeps M-1 only. The campaign window ends before the last day of M-1; the oldest
    month may have exclusions of its own.
    """
    windows = trailing_windows(month, suffixes=[f"_{s}" for s in SUFFIXES])
    predicates: dict[str, Column] = {}
    if full:
        to_date = TrailingWindow("_OPF", None, period_end(shift_label(month, -1)))
        windows = [to_date, *windows]
        predicates["_OPF"] = matches_any(F.col("campaign_id"), rules.campaign_patterns)
        if rules.oldest_batch_exclusions:
            predicates[windows[-1].suffix] = exclude_patterns(F.col("batch_id"), rules.oldest_batch_exclusions)
    else:
        windows = windows[:1]
    event = F.col("event_type")
    rows = src.notifications.where(
        (F.col("site") == rules.site)
        & (F.col("path") == rules.path)
        & (F.col("business") == rules.business)
        & event.isin([rules.opened, rules.shown])
        & exclude_patterns(F.col("batch_id"), rules.batch_exclusions)
    )
    measures = {"SHOWNS": event_count(event == rules.shown), "OPENS": event_count(event == rules.opened)}
    return trailing_features(rows, KEY, "event_date", windows, measures, predicates)


def current_segments(src: Sources, rules: Rules) -> DataFrame:
    mine = src.segments.where(F.col("site") == rules.site)
    return latest_per_key(mine, KEY, "month_id", "segment").select(KEY, F.col("segment").alias("CLUSTER"))


def _eligible(src: Sources, rules: Rules) -> DataFrame:
    """Active customers that are not employees and not in the excluded segment."""
    people = exclude_members(active_customers(src, rules), current_employees(src, rules), KEY)
    segments = current_segments(src, rules).where(F.col("CLUSTER") != rules.excluded_segment)
    return people.join(segments, KEY, "inner")


def campaign_audience(src: Sources, rules: Rules, month: str) -> DataFrame:
    """Customers to approach in a month: eligible, notified in M-1, consent unset or of M-1."""
    notified = notification_counts(src, rules, month, full=False)
    consents = consent_flags(src, rules, month)
    return (
        _eligible(src, rules)
        .join(notified.where(F.col("SHOWNS_30").isNotNull()).select(KEY), KEY, "left_semi")
        .join(consents, KEY, "left")
        .where(flag_unset_or_yes(F.col("flag_in_month")))
        .select(KEY)
    )


def activity_features(src: Sources, rules: Rules, month: str) -> DataFrame:
    """Amount and count families of M-1, M-2, M-3 from one scan."""
    measures = {f"TPN_{n}": count_total([F.col(c) for c in cols]) for n, cols in rules.counts.items()}
    measures |= {f"TPV_{n}": amount_total([F.col(c) for c in cols]) for n, cols in rules.amounts.items()}
    mine = src.monthly_activity.where(F.col("site") == rules.site)
    return trailing_features(mine, KEY, "month_id", trailing_windows(month), measures, month_ids=True)


def balance_features(src: Sources, month: str) -> DataFrame:
    """Largest balance of M-1, M-2, M-3 from one scan."""
    measures = {"SALDO_EM_CONTA": highest(F.col("available_balance"))}
    return trailing_features(src.daily_balances, KEY, "day", trailing_windows(month), measures)


def feature_columns(rules: Rules) -> list[str]:
    """Columns of the feature table after the key, in order."""
    names = ["CLUSTER", "CICLO_DE_VIDA", "PRINCIPALIDADE", "LOYALTY_LVL", "FLAG_DATA_OUT", "FLAG_CARTAO_CREDITO"]
    names += [f"SALDO_EM_CONTA{s}" for s in SUFFIXES]
    names += [f"TPN_{n}{s}" for s in SUFFIXES for n in rules.counts]
    names += [f"TPV_{n}{s}" for s in SUFFIXES for n in rules.amounts]
    return names + [f"{kind}_{s}" for s in ("OPF", *SUFFIXES) for kind in ("SHOWNS", "OPENS")]


def _features(base: DataFrame, src: Sources, rules: Rules, month: str) -> DataFrame:
    lifecycle = latest_per_key(src.lifecycle.where(F.col("site") == rules.site), KEY, "photo_id", ["stage", "category"])
    loyalty = latest_per_key(src.loyalty_log.where(F.col("site") == rules.site), KEY, "level_from", "level")
    cards = distinct_members(src.card_accounts, KEY, F.upper("status") == rules.card_status)
    tables = [
        lifecycle.select(KEY, F.col("stage").alias("CICLO_DE_VIDA"), F.col("category").alias("PRINCIPALIDADE")),
        loyalty.select(KEY, as_int64(F.col("level")).alias("LOYALTY_LVL")),
        cards.withColumn("__card", F.lit(True)),
        balance_features(src, month),
        activity_features(src, rules, month),
    ]
    # Every table above is grouped by the key, so it holds one row per customer.
    wide = star_join(base, tables, KEY, check_unique=False)
    return wide.withColumns(
        {
            "FLAG_DATA_OUT": F.when(F.col("has_data_out"), YES).otherwise(NO),
            "FLAG_CARTAO_CREDITO": F.when(F.col("__card"), YES).otherwise(NO),
        }
    ).select(KEY, *feature_columns(rules))


def customer_features(src: Sources, rules: Rules, month: str) -> DataFrame:
    """The feature table of the customers of :func:`campaign_audience`."""
    base = (
        _eligible(src, rules)
        .join(notification_counts(src, rules, month).where(F.col("SHOWNS_30").isNotNull()), KEY, "inner")
        .join(consent_flags(src, rules, month), KEY, "left")
        .where(flag_unset_or_yes(F.col("flag_in_month")))
    )
    return _features(base, src, rules, month)


def customer_scoring_base(src: Sources, rules: Rules, month: str) -> DataFrame:
    """The same features for all eligible customers: no notification and no consent condition."""
    base = (
        _eligible(src, rules)
        .join(notification_counts(src, rules, month), KEY, "left")
        .join(consent_flags(src, rules, month), KEY, "left")
    )
    return _features(base, src, rules, month)


def customer_target(
    external_cards: DataFrame, cap: int = TARGET_CAP, as_of: Column | None = None
) -> DataFrame:
    """Distinct external cards with a limit per customer, at most ``cap``.

    ``external_cards`` has customer_id, card_id and limits (an array of structs). ``as_of`` filters
    the rows first; without it the target does not depend on the month.
    """
    rows = external_cards if as_of is None else external_cards.where(as_of)
    return capped_count_target(unnest(rows.select(KEY, "card_id", "limits"), "limits"), KEY, "card_id", cap)
