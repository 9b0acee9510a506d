"""Names, codes and lookup tables that results must agree on.

Everything here is data, not logic. Anything that belongs to one brand or one
campaign (tag prefix, brand lists, account overrides) is an argument instead;
see ``postlens.settings``.
"""

# Columns of a landed snapshot record, in published order.
IDENTITY = ["country", "network", "username", "profile_id", "social_network_id"]
POST_FIELDS = ["post_id", "created_at", "format", "copy", "source_link", "thumbnail_url"]
COUNTERS = [
    "comments", "engagement", "likes", "reach", "saves", "shares", "views", "video_views",
    "follows", "exits", "taps_back", "taps_forward", "profile_activity", "profile_visits",
    "posts_count",
]
RATES = [
    "engagement_rate", "roi", "ig_reels_avg_watch_time", "ig_reels_video_view_total_time",
    "average_time_watched", "total_time_watched", "full_video_watched_rate",
]

# The cumulative counters that also get a day-over-day delta.
DELTA_COUNTERS = [
    "reach", "views", "video_views", "comments", "likes", "shares", "saves", "engagement",
    "follows", "profile_visits", "profile_activity",
]

# Network code -> name of its per-network view.
NETWORK_VIEWS = {
    "INSTAGRAMBUSINESS": "instagram",
    "FACEBOOKPAGE": "facebook",
    "TWITTER": "twitter",
    "TIKTOKBUSINESS": "tiktok",
    "YOUTUBECHANNEL": "youtube",
}

# Network code -> display name.
NETWORK_NAMES = {
    "INSTAGRAMBUSINESS": "Instagram",
    "TIKTOKBUSINESS": "TikTok",
    "YOUTUBECHANNEL": "YouTube",
    "FACEBOOKPAGE": "Facebook",
    "TWITTER": "X",
    "TWITTERV2": "X",
    "LINKEDIN": "LinkedIn",
    "LINKEDINCOMPANY": "LinkedIn",
}

# Business region -> ISO country codes.
REGION_COUNTRIES = {
    "namer": ["US", "CA"],
    "latam": [
        "MX", "GT", "HN", "SV", "NI", "CR", "PA", "CO", "VE", "EC", "PE", "BO", "CL", "AR", "PY", "UY", "BR", "DO",
        "PR", "JM", "TT", "HT",
    ],
    "emea": [
        "ES", "GB", "UK", "FR", "DE", "IT", "PT", "NL", "BE", "CH", "AT", "IE", "SE", "NO", "DK", "FI", "PL", "CZ",
        "RO", "GR", "TR", "IL", "AE", "SA", "EG", "ZA", "NG", "KE", "MA",
    ],
}

# Commercial market -> ISO country codes.
MARKET_COUNTRIES = {
    "mexico": ["MX"],
    "andino": ["CO", "EC", "PE", "VE", "BO"],
    "carcam": ["CR", "DO", "GT", "JM", "PA", "PR", "SV", "HN", "NI", "TT", "HT"],
}

# Spellings used in the register, the paid sheet and the target sheet.
COLLABORATION = "Colaboración"
ORGANIC_RAW, PAID_RAW = "Orgánico", "Pagado"
TARGET_MARKETS = {"MEXICO": "mexico", "CARCAM": "carcam", "ANDINO": "andino", "TOTAL": "total"}
TARGET_PAUTAS = {"ORGANICO": "organic", "PAGADO": "paid", "TOTAL": "total"}

# Where post keys sit inside register links.
IG_KEY_PATTERN = r"instagram\.com/(?:reel|p|tv)/([^/?]+)"
TIKTOK_KEY_PATTERN = r"/video/(\d+)"
IG_STORY_PATTERN = r"instagram\.com/s/"
TIKTOK_SHORT_PATTERN = r"tiktok\.com/t/"

# Target-sheet metrics as
# (column, metric_id, section, label, display_order, format_type).
SHEET_METRICS = [
    ("reach", "reach", "Reach", "Accounts Reached", 1, "compact"),
    ("views_platform", "views_2_3s", "Reach", "Views (2-3s)", 2, "compact"),
    ("impressions", "impressions", "Reach", "Impressions", 3, "compact"),
    ("ave_impressions", "ave_impressions", "Reach", "Ave. Impressions", 4, "compact"),
    ("ave_views", "ave_views", "Reach", "Ave. Views", 5, "compact"),
    ("vtr", "vtr", "Recall", "View Through Rate (%)", 6, "percent"),
    ("comments", "total_comments", "Recall", "Total Comments", 7, "compact"),
    ("er", "er", "Engagement", "Engagement Rate (%)", 9, "percent"),
    ("likes", "total_likes", "Engagement", "Total Likes", 11, "compact"),
    ("shares", "shares", "Engagement", "Shares", 12, "compact"),
    ("shares_rate", "shares_rate", "Engagement", "Shares Rate (%)", 13, "percent"),
    ("saves", "saves", "Engagement", "Saves", 14, "compact"),
    ("saves_rate", "saves_rate", "Engagement", "Saves Rate (%)", 15, "percent"),
]

# Brand-level targets that no sheet holds, as
# (metric_id, section, label, display_order, target_value, format_type).
BRAND_METRICS = [
    ("sov", "Engagement", "SOV vs Competidores (%)", 8, 0.041, "percent"),
    ("total_mentions", "Engagement", "Total Mentions", 10, 86938.0, "compact"),
    ("positive_sentiment", "Engagement", "Positive Sentiment (%)", 16, 0.25, "percent"),
    ("sov_sponsors", "Engagement", "SOV entre Sponsors (%)", 17, 0.034, "percent"),
]

# Scorecard metrics read as sum(num) / sum(den).
RATIO_METRICS = [
    "vtr", "er", "ave_impressions", "ave_views", "shares_rate", "saves_rate",
    "sov", "sov_sponsors", "positive_sentiment",
]

# The characters after which a word starts, besides whitespace.
WORD_BREAKS = r"""[](){}/|\<>!?@"^#$&~_,.:;*%+-"""

# Unicode White_Space characters.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
