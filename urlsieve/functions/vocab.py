"""Word lists the features are defined by."""

PHISH_HINT_WORDS = (
    "secure", "account", "login", "signin", "update", "verify", "confirm",
    "banking", "password", "webscr", "ebayisapi", "suspend", "billing",
    "wallet", "recover", "unlock", "validate",
)

SHORTENERS = (
    "bit.ly", "goo.gl", "tinyurl.com", "ow.ly", "t.co", "is.gd", "buff.ly",
    "cutt.ly", "rebrand.ly", "shorturl.at", "tiny.cc", "rb.gy", "bitly.com",
)

BUILTIN_BRANDS = (
    "paypal", "apple", "microsoft", "amazon", "google", "facebook", "netflix",
    "instagram", "whatsapp", "linkedin", "dropbox", "adobe", "chase", "wellsfargo",
    "ebay", "steam", "binance", "coinbase", "outlook", "office365",
)

SUSPICIOUS_TLDS = (
    "tk", "ml", "ga", "cf", "gq", "xyz", "top", "work", "click", "link",
    "country", "stream", "download", "racing", "win", "bid", "loan", "zip",
)

COMMON_TLDS = ("com", "net", "org", "gov", "edu")

# Schemes whose last path segment may carry ";params" (RFC 1808 list of the Python standard library).
PARAM_SCHEMES = (
    "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps", "rtspu",
    "sip", "sips", "mms", "sftp", "tel",
)

NO_BRAND_DISTANCE = 99
MIN_TOKEN_LENGTH = 4
BRAND_LIST_SIZE = 500
MIN_BRAND_LENGTH = 5
BRAND_CUTOFF = 2
