"""The channel classifier is total and agrees with an independent rule check on random strings."""

import random
import re

from pyspark.sql import functions as F

from touchpath.operators.channels import classify_channels
from touchpath.sources.testdata import fixture_categories

FRAGMENTS = ["cp", "ppc", "paid", "shop", "ping", "video", "e-mail", "email", "e_mail", "sms", "push", "mobile",
             "notification", "\n", "\r", "\u0085", "\u2028", "\u2029", " ", "x", "social", "organic", "referral", "display", "cpm", "(direct)",
             "(none)", "(not set)", "cross-network", "a", "e", "retargeting", "app", "link", "audio", "affiliate",
             "google", "bing", "facebook.com", "youtube.com", "amazon.com", "IGShopping", "firebase", "b", "-"]
SEARCH, SOCIAL, VIDEO, SHOPPING = {"google", "bing"}, {"facebook.com", "linkedin.com"}, {"youtube.com"}, \
    {"amazon.com", "IGShopping"}


# The labels in rule order, and the rules below.
CHANNELS = {"Direct", "Cross Network", "Paid Shopping", "Paid Search", "Paid Social", "Paid Video", "Display", "Paid Other", "Organic Shopping",
            "Organic Social", "Organic Video", "Organic Search", "Referral", "Email", "Affiliates", "Audio", "SMS", "Mobile Push Notifications",
            "Unassigned"}


def reference_rules(source, medium, campaign):
    """Python ``re`` statement of the 19 first-match rules (``\\Z`` = end of text)."""
    sm = f"{source}/{medium}"
    paid = re.search(r"^(.*cp.*|ppc|retargeting|paid.*)\Z", medium) is not None
    shop = re.search(r"^(.*(([^a-df-z]|^)shop|shopping).*)\Z", campaign) is not None
    if source == "(direct)" and medium in ("(not set)", "(none)"):
        return "Direct"
    if "cross-network" in campaign and medium != "referral":
        return "Cross Network"
    if paid and (shop or source in SHOPPING):
        return "Paid Shopping"
    if paid and source in SEARCH:
        return "Paid Search"
    if paid and source in SOCIAL:
        return "Paid Social"
    if paid and source in VIDEO:
        return "Paid Video"
    if medium in ("display", "banner", "expandable", "interstitial", "cpm"):
        return "Display"
    if paid:
        return "Paid Other"
    if shop or source in SHOPPING:
        return "Organic Shopping"
    if medium in ("social", "social-network", "social-media", "sm", "social network", "social media") \
            or source in SOCIAL:
        return "Organic Social"
    if re.search(r"^(.*video.*)\Z", medium) or source in VIDEO:
        return "Organic Video"
    if medium == "organic" or source in SEARCH:
        return "Organic Search"
    if medium in ("referral", "app", "link"):
        return "Referral"
    if re.search(r"e[-_ ]?mail", sm):
        return "Email"
    if medium == "affiliate":
        return "Affiliates"
    if medium == "audio":
        return "Audio"
    if "sms" in sm:
        return "SMS"
    if source == "firebase" or re.search(r"push\Z|mobile|notification", medium):
        return "Mobile Push Notifications"
    return "Unassigned"


def test_classifier_total_and_matches_rules(spark):
    rnd = random.Random(7)

    def word():
        return "".join(rnd.choice(FRAGMENTS) for _ in range(rnd.randint(0, 3)))

    rows = [(f"s{i}", word(), word(), word()) for i in range(3000)]
    rows += [(f"f{i}", s, m, c) for i, (s, m, c) in enumerate(
        [("google", "cpc", ""), ("x", "ppc\n", ""), ("x", "cpc\r", ""), ("x", "paid\u2028x", ""), ("x", "\u0085video", ""), ("x", "y", "a\u2029shopping"), ("x", "paid\n", ""), ("x", "cpm", ""), ("(direct)", "(none)", ""),
         ("x", "video\n", ""), ("x", "web-push\n", ""), ("x", "y", "shop\n"), ("x", "y", "eshop"), ("x", "y", "-shop")])]
    df = spark.createDataFrame(rows, "session_id string, source string, medium string, campaign_name string")
    df = df.withColumn("source_medium", F.concat("source", F.lit("/"), "medium"))
    got = {r["session_id"]: r["channel_group"] for r in classify_channels(df, fixture_categories(spark)).collect()}
    assert set(got.values()) <= CHANNELS
    mismatches = [(sid, s, m, c, got[sid], reference_rules(s, m, c))
                  for sid, s, m, c in rows if got[sid] != reference_rules(s, m, c)]
    assert not mismatches, mismatches[:5]
