"""Request classifiers: device, browser, network, content, region, price, threat.

The labels, patterns and prices in the tables below are fixed values that results must
agree on. The functions under them only fold such a table into one CASE expression:
no lookup join, nothing to broadcast, and the expression stays inside codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: LIKE patterns per label, the first matching label wins -------------
DEVICE_3 = [
    ("Mobile", ["%Mobile%"]),
    ("Tablet", ["%Tablet%"]),
]
DEVICE_4 = [
    ("Mobile (5G)", ["%5G%"]),
    ("Mobile (4G)", ["%Mobile%", "%Android%", "%iPhone%"]),
    ("Tablet", ["%Tablet%", "%iPad%"]),
]
DESKTOP = "Desktop"
HANDHELD = ["%Mobile%", "%Android%", "%iPhone%"]
BOT_AGENTS = ["%bot%", "%crawler%"]

CONTENT = [
    ("Video", ["%.mp4", "%.m3u8"]),
    ("Images", ["%.jpg", "%.png", "%.gif"]),
    ("JavaScript", ["%.js"]),
    ("CSS", ["%.css"]),
    ("HTML", ["%.html", "%.htm"]),
]
ENDPOINT_PATTERN = [
    ("/static/images/*", ["/static/images/%"]),
    ("/api/products/*", ["/api/products/%"]),
    ("/api/user/*", ["/api/user/%"]),
    ("/static/css/*", ["/static/css/%"]),
    ("/api/search", ["/api/search%"]),
]
JOURNEY = [
    ("1. Homepage", ["/"]),
    ("2. Search", ["/search%"]),
    ("3. Product Detail", ["/product/%"]),
    ("4. Cart", ["/cart%"]),
    ("5. Checkout", ["/checkout%"]),
    ("6. Payment", ["/payment%"]),
    ("7. Confirmation", ["/confirmation%"]),
]
IMPACT = [
    ("Critical", ["/api/checkout%", "/api/payment%"]),
    ("High", ["/api/%"]),
    ("Medium", ["/static/%"]),
]
THREAT = [
    ("SQL Injection", ["%SQL%"]),
    ("XSS Attempts", ["%XSS%"]),
    ("Bot Attacks", ["%BOT%"]),
    ("DDoS Attempts", ["%DDOS%"]),
    ("Path Traversal", ["%PATH%"]),
    ("Rate Limit Exceeded", ["%RATE%"]),
]
# --- fixed values: throughput classes, "more than" this many bits per second ----------
NETWORK_SPEED = [
    (10_000_000, "Fast (>10Mbps)"),
    (5_000_000, "Medium (5-10Mbps)"),
    (1_000_000, "Slow (1-5Mbps)"),
]
SLOWEST_NETWORK = "Very Slow (<1Mbps)"
# --- fixed values: countries per region, and US dollars per GiB served ----------------
REGION = [
    ("North America", ["US", "CA", "MX"]),
    ("Europe", ["GB", "DE", "FR", "ES", "IT"]),
    ("Asia Pacific", ["CN", "JP", "IN", "SG", "AU"]),
    ("South America", ["BR", "AR", "CL"]),
]
PRICE_PER_GIB = [
    (0.085, ["US", "CA", "EU"]),
    (0.140, ["JP", "AU", "IN"]),
    (0.170, ["SA", "AF"]),
]
PRICE_ELSEWHERE = 0.200
OTHER = "Other"
# --------------------------------------------------------------------------------------


def like_any(col: Column, patterns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [col.like(p) for p in patterns])


def _case(branches: list[tuple[Column, object]], otherwise) -> Column:
    head, *tail = branches
    out = F.when(head[0], F.lit(head[1]))
    for cond, value in tail:
        out = out.when(cond, F.lit(value))
    return out.otherwise(F.lit(otherwise))


def label_like(col: str, table, otherwise: str = OTHER) -> Column:
    c = F.col(col)
    return _case([(like_any(c, patterns), label) for label, patterns in table], otherwise)


def device_class(ua: str = "user_agent") -> Column:
    return label_like(ua, DEVICE_3, DESKTOP)


def device_network_class(ua: str = "user_agent") -> Column:
    return label_like(ua, DEVICE_4, DESKTOP)


def is_chrome(ua: str = "user_agent") -> Column:
    return F.col(ua).like("%Chrome%")


def is_safari(ua: str = "user_agent") -> Column:
    return F.col(ua).like("%Safari%") & ~is_chrome(ua)


def is_firefox(ua: str = "user_agent") -> Column:
    return F.col(ua).like("%Firefox%")


def browser_class(ua: str = "user_agent") -> Column:
    return _case(
        [(is_chrome(ua), "Chrome"), (is_safari(ua), "Safari"), (is_firefox(ua), "Firefox")],
        OTHER,
    )


def is_handheld(ua: str = "user_agent") -> Column:
    return like_any(F.col(ua), HANDHELD)


def is_bot(ua: str = "user_agent") -> Column:
    return like_any(F.col(ua), BOT_AGENTS)


def network_speed(bps: str = "throughput_bps") -> Column:
    return _case([(F.col(bps) > low, label) for low, label in NETWORK_SPEED], SLOWEST_NETWORK)


def content_class(path: str = "req_path") -> Column:
    return label_like(path, CONTENT)


def endpoint_pattern(path: str = "req_path") -> Column:
    return label_like(path, ENDPOINT_PATTERN)


def journey_step(path: str = "req_path") -> Column:
    return label_like(path, JOURNEY)


def impact_class(path: str = "req_path") -> Column:
    return label_like(path, IMPACT, "Low")


def threat_class(rules: str = "security_rules") -> Column:
    return label_like(rules, THREAT)


def region_of(country: str = "country") -> Column:
    c = F.col(country)
    return _case([(c.isin(codes), region) for region, codes in REGION], OTHER)


def price_per_gib(country: str = "country") -> Column:
    c = F.col(country)
    return _case([(c.isin(codes), usd) for usd, codes in PRICE_PER_GIB], PRICE_ELSEWHERE)


def risk_level(threats: Column, medium_from: int = 10, high_above: int = 100) -> Column:
    return _case(
        [(threats > high_above, "High Risk"), (threats >= medium_from, "Medium Risk")],
        "Low Risk",
    )


def traffic_type(
    ua: Column, requests: Column, paths: Column, mean_bps: Column,
    requests_per_path: int = 2, high_speed_bps: int = 50_000_000,
) -> Column:
    """Bot verdict from a user agent and its aggregates. The requests-per-path ratio is
    an integer division, so it is a whole number before it is compared."""
    return _case(
        [
            (like_any(ua, BOT_AGENTS), "Known Bot"),
            (F.floor(requests / F.nullif(paths, F.lit(0))) < requests_per_path, "Scraper"),
            (mean_bps > high_speed_bps, "High-Speed Bot"),
        ],
        "Likely Human",
    )


def age_tier(age_days: Column, hot_days: int = 7, warm_days: int = 90) -> Column:
    return _case([(age_days <= hot_days, "hot"), (age_days <= warm_days, "warm")], "cold")
