"""First-match channel classifier as one folded CASE expression.

Inputs are plain columns (source, medium, campaign_name, source_medium) plus
four boolean category flags produced by the category join
(``touchpath.operators.channels.with_category_flags``). Everything stays in
whole-stage codegen; the paid-medium regex is evaluated once per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Classification rules (must equal the reference for equal
# results). Regexes use Java syntax; ``\z`` anchors at the true end of text,
# as RE2's ``$`` does; ``(?d)`` lets ``.`` match every character but a newline,
# as RE2's does (Java's also stops at other line ends).
# ---------------------------------------------------------------------------
PAID_MEDIUM = r"(?d)^(.*cp.*|ppc|retargeting|paid.*)\z"
SHOPPING_CAMPAIGN = r"(?d)^(.*(([^a-df-z]|^)shop|shopping).*)\z"
VIDEO_MEDIUM = r"(?d)^(.*video.*)\z"
CROSS_NETWORK = "cross-network"
EMAIL = "e[-_ ]?mail"
SMS = "sms"
PUSH_MEDIUM = "push\\z|mobile|notification"
DIRECT_SOURCE = "(direct)"
DIRECT_MEDIUMS = ("(not set)", "(none)")
DISPLAY_MEDIUMS = ("display", "banner", "expandable", "interstitial", "cpm")
SOCIAL_MEDIUMS = ("social", "social-network", "social-media", "sm", "social network", "social media")
REFERRAL_MEDIUMS = ("referral", "app", "link")
FIREBASE_SOURCE = "firebase"

CATEGORY_SEARCH = "SOURCE_CATEGORY_SEARCH"
CATEGORY_SOCIAL = "SOURCE_CATEGORY_SOCIAL"
CATEGORY_VIDEO = "SOURCE_CATEGORY_VIDEO"
CATEGORY_SHOPPING = "SOURCE_CATEGORY_SHOPPING"
CATEGORIES = {
    "is_search": CATEGORY_SEARCH,
    "is_social": CATEGORY_SOCIAL,
    "is_video": CATEGORY_VIDEO,
    "is_shopping": CATEGORY_SHOPPING,
}
# ---------------------------------------------------------------------------


def channel_group(source: str = "source", medium: str = "medium", campaign: str = "campaign_name",
                  source_medium: str = "source_medium") -> Column:
    """Ordered first-match channel label; total (never NULL for non-NULL inputs)."""
    s, m, c, sm = F.col(source), F.col(medium), F.col(campaign), F.col(source_medium)
    search = F.coalesce(F.col("is_search"), F.lit(False))
    social = F.coalesce(F.col("is_social"), F.lit(False))
    video = F.coalesce(F.col("is_video"), F.lit(False))
    shopping = F.coalesce(F.col("is_shopping"), F.lit(False))
    paid = m.rlike(PAID_MEDIUM)
    shop_campaign = c.rlike(SHOPPING_CAMPAIGN)
    return (
        F.when((s == DIRECT_SOURCE) & m.isin(*DIRECT_MEDIUMS), "Direct")
        .when(c.contains(CROSS_NETWORK) & (m != "referral"), "Cross Network")
        .when(paid & (shop_campaign | shopping), "Paid Shopping")
        .when(paid & search, "Paid Search")
        .when(paid & social, "Paid Social")
        .when(paid & video, "Paid Video")
        .when(m.isin(*DISPLAY_MEDIUMS), "Display")
        .when(paid, "Paid Other")
        .when(shop_campaign | shopping, "Organic Shopping")
        .when(m.isin(*SOCIAL_MEDIUMS) | social, "Organic Social")
        .when(m.rlike(VIDEO_MEDIUM) | video, "Organic Video")
        .when((m == "organic") | search, "Organic Search")
        .when(m.isin(*REFERRAL_MEDIUMS), "Referral")
        .when(sm.rlike(EMAIL), "Email")
        .when(m == "affiliate", "Affiliates")
        .when(m == "audio", "Audio")
        .when(sm.contains(SMS), "SMS")
        .when((s == FIREBASE_SOURCE) | m.rlike(PUSH_MEDIUM), "Mobile Push Notifications")
        .otherwise("Unassigned")
    )
