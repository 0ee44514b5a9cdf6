"""Column functions on strings: sentinels and traffic channel grouping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Placeholders that the source writes instead of a missing value.
NOT_SET = "(not set)"
EMPTY_PLACEHOLDERS = ["(not set)", ""]
HIDDEN_PLACEHOLDERS = ["(none)", "(not set)", "(data deleted)"]
UNKNOWN = "unknown"

# Patterns and lists of the default channel definition.
SHOPPING_SITES = "alibaba|amazon|google shopping|shopify|etsy|ebay|stripe|walmart"
SEARCH_SITES = "baidu|bing|duckduckgo|ecosia|google|yahoo|yandex"
SOCIAL_SITES = "badoo|facebook|fb|instagram|linkedin|pinterest|tiktok|twitter|whatsapp"
VIDEO_SITES = "dailymotion|disneyplus|netflix|youtube|vimeo|twitch"
SHOP_CAMPAIGN = "^(.*(([^a-df-z]|^)shop|shopping).*)$"
PAID_MEDIUM = "^(.*cp.*|ppc|paid.*)$"
VIDEO_MEDIUM = "^(.*video.*)$"
EMAIL_SPELLINGS = "email|e-mail|e_mail|e mail"
PUSH_MEDIUM = "mobile|notification"
CROSS_NETWORK = "cross-network"
DIRECT_MEDIUMS = ["(not set)", "(none)"]
DISPLAY_MEDIUMS = ["display", "banner", "expandable", "interstitial", "cpm"]
SOCIAL_MEDIUMS = ["social", "social-network", "social-media", "sm", "social network", "social media"]
SINGLE_MEDIUM_CHANNELS = {"affiliate": "Affiliates", "referral": "Referral", "audio": "Audio", "sms": "SMS"}


def normalize_string(value: Column) -> Column:
    """Placeholder or empty string to NULL."""
    return F.when(value.isin(EMPTY_PLACEHOLDERS), F.lit(None)).otherwise(value)


def clean_string(value: Column) -> Column:
    """Placeholder to ``unknown``; NULL stays NULL, callers decide what it means."""
    return F.when(value.isin(HIDDEN_PLACEHOLDERS), F.lit(UNKNOWN)).otherwise(value)


def channel_grouping(source: Column, medium: Column, campaign: Column) -> Column:
    """Marketing channel of a visit; the first rule that holds wins, otherwise ``Unassigned``.

    Only built-in expressions, so the chain stays inside generated code. A rule over a NULL input
    is NULL and therefore does not fire.
    """
    paid = medium.rlike(PAID_MEDIUM)
    shopping = source.rlike(SHOPPING_SITES) | campaign.rlike(SHOP_CAMPAIGN)
    search = source.rlike(SEARCH_SITES)
    social = source.rlike(SOCIAL_SITES)
    video = source.rlike(VIDEO_SITES)

    rules: list[tuple[str, Column]] = [
        ("Direct", (source == "(direct)") & medium.isin(DIRECT_MEDIUMS)),
        ("Cross-network", campaign.contains(CROSS_NETWORK)),
        ("Paid Shopping", shopping & paid),
        ("Paid Search", search & paid),
        ("Paid Social", social & paid),
        ("Paid Video", video & paid),
        ("Display", medium.isin(DISPLAY_MEDIUMS)),
        ("Organic Shopping", shopping),
        ("Organic Social", social | medium.isin(SOCIAL_MEDIUMS)),
        ("Organic Video", video | medium.rlike(VIDEO_MEDIUM)),
        ("Organic Search", search | (medium == "organic")),
        ("Email", source.rlike(EMAIL_SPELLINGS) | medium.rlike(EMAIL_SPELLINGS)),
        *[(channel, medium == value) for value, channel in SINGLE_MEDIUM_CHANNELS.items()],
        ("Mobile Push Notifications", medium.endswith("push") | medium.rlike(PUSH_MEDIUM)),
    ]
    chain = F.when(rules[0][1], rules[0][0])
    for name, condition in rules[1:]:
        chain = chain.when(condition, name)
    return chain.otherwise("Unassigned")
